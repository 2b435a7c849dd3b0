"""Repeated passages inside other text, at every offset."""

from __future__ import annotations

import random

import pytest

from tickmacro.llm import sentence_dedup


def _words(rng, n):
    return [rng.choice("bcdfghkl") + rng.choice("aeiou") * rng.randint(1, 3) + str(rng.randrange(500)) for _ in range(n)]


def _hashes(text):
    return {h for _, _, h in sentence_dedup.spans(sentence_dedup.sentences(text))}


@pytest.mark.parametrize("stops", [(), (30, 54), (20, 44), (7, 19, 40)])
def test_passages_of_over_fifty_words_meet_at_every_offset(stops):
    rng = random.Random(3)
    for offset in range(60):
        passage = _words(rng, 54 if 54 in stops else 51)
        for at in stops:
            passage[at - 1] += "."
        one = " ".join(_words(rng, 5) + passage + _words(rng, 9))
        two = " ".join(_words(rng, offset) + passage + _words(rng, offset % 17))
        assert _hashes(one) & _hashes(two)
        assert not _hashes(one) & _hashes(" ".join(_words(rng, 80)))


def test_scripts_without_spaces_are_counted_by_characters(make_docs):
    rng = random.Random(4)
    line = lambda: "".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(30))
    page = "\n".join(line() for _ in range(20))
    passage = line() + line()
    rows = [(1, page), (2, page), (3, line() + passage + line()), (4, passage), (5, line() + "。" + line() + "।")]
    clean = {r.row.doc_id: r.text for r in sentence_dedup.dedup(make_docs(rows)).collect()}
    assert clean[1] == page and clean[2] == "" and clean[3] == rows[2][1] and clean[5] == rows[4][1]
    assert 0 < len(clean[4]) < 35 and len(sentence_dedup.sentences("一。二।三")) == 3


@pytest.mark.parametrize("length", range(2, 40))
def test_passages_of_sentences_of_any_length_meet(length):
    """51 words in sentences of ``length`` words, begun at every word of the first."""
    rng = random.Random(length)
    for offset in range(min(length, 14)):
        passage = _words(rng, 51)
        for at in range(length - offset, 51, length):
            passage[at - 1] += "."
        one = " ".join(_words(rng, 5) + passage + _words(rng, 9))
        two = " ".join([*_words(rng, 3), "End.", *passage, *_words(rng, 4)])
        assert _hashes(one) & _hashes(two)


def test_stops_without_words_cost_their_length(make_docs):
    text = "… " * 200_000 + " ".join(f"w{k}" for k in range(40)) + ". " * 200_000
    parts = sentence_dedup.sentences(text)
    assert len(parts) < 20 and "".join(text[p[0] : p[1]] for p in parts) == text
    assert sum(p[2] for p in parts) == 40
    clean = {r.row.doc_id: len(r.text) for r in sentence_dedup.dedup(make_docs([(1, text), (2, text)])).collect()}
    assert clean[1] == len(text) and clean[2] < len(text)
