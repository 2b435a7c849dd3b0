"""The contracts again, one document at a time."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from zlib import crc32

import xxhash

SPACE = " \t\n\x0b\x0c\r"
UPPER = {c: c + 32 for c in range(65, 91)}


def lower(text: str | None) -> str:
    return (text or "").translate(UPPER)


def words(text: str | None) -> list[str]:
    return [w for w in re.split(f"[{SPACE}]+", text or "") if w]


def joined(spans: list[tuple]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, _, end, kind in sorted(spans))


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def secrets(text: str | None) -> list[tuple]:
    text = text or ""
    assign = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    out = [(m.start(), 0, m.end(), "assign") for m in re.finditer(assign, text, re.A) if len(m[2]) >= 8]
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    return out + [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]


def _digits(text: str) -> str:
    return re.sub("[^0-9]", "", text)


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        total += int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10))
    return total % 10 == 0


def personal(text: str | None) -> list[tuple]:
    text = text or ""
    find = lambda p: re.finditer(p, text)
    out = [(m.start(), 0, m.end(), "email") for m in find(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")]
    for m in find(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"):
        if all(int(part) <= 255 for part in m[0].split(".")):
            out.append((m.start(), 1, m.end(), "ip"))
    for m in find(r"[0-9]([\x20-]?[0-9])+"):
        if 14 <= len(_digits(m[0])) <= 19 and _luhn(_digits(m[0])):
            out.append((m.start(), 2, m.end(), "card"))
    for m in find(r"\+[0-9][\x20().0-9-]+[0-9]"):
        if 10 <= len(_digits(m[0])) <= 15:
            out.append((m.start(), 3, m.end(), "phone"))
    return out


def contamination(docs: list[str | None], items: list[tuple]) -> list[tuple]:
    """(n_words, n_hit, n_items, items_sha256, contaminated) of each document."""
    tokens = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
    windows: dict[tuple, set] = {}
    for item, text in items:
        w = tokens(text)
        size = min(10, len(w))
        for k in range(len(w) - size + 1 if w else 0):
            windows.setdefault(tuple(w[k : k + size]), set()).add(str(item))
    out = []
    for text in docs:
        w, hit, found = tokens(text), set(), set()
        for size in {len(key) for key in windows}:
            for k in range(len(w) - size + 1):
                if tuple(w[k : k + size]) in windows:
                    hit.update(range(k, k + size))
                    found |= windows[tuple(w[k : k + size])]
        out.append((len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)))
    return out


def quality(text: str | None) -> tuple:
    w = words(text)
    runs = [tuple(w[k : k + 5]) for k in range(len(w) - 4)]
    often, covered = Counter(runs), set()
    for k, run in enumerate(runs):
        if often[run] > 1:
            covered.update(range(k, k + 5))
    lines = [line for line in (text or "").split("\n") if words(line)]
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    failed = len(w) < 10 or 100 * len(covered) > 20 * len(w)
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered), failed


def fingerprint(text: str | None) -> int:
    w = words(lower(text))
    if not w:
        return 0
    runs = [" ".join(w[k : k + 3]) for k in range(len(w) - 2)] or [" ".join(w)]
    hashes = [xxhash.xxh64_intdigest(r.encode(), seed=42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(prints: list[int], distance: int = 2) -> list[int]:
    """The smallest place that each place is linked to."""
    root = list(range(len(prints)))

    def find(i: int) -> int:
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= distance:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(prints))]


def unigrams(docs: list[tuple]) -> list[tuple]:
    """(held_out, n_tokens, n_known, train_tokens, base_score) of (doc_id, text)."""
    texts = [(crc32(("" if i is None else str(i)).encode()) % 7 == 2, words(lower(t)) + ["\n"]) for i, t in docs]
    counts: Counter[str] = Counter()
    for held, w in texts:
        if not held:
            counts.update(w)
    total, distinct = sum(counts.values()), len(counts)
    return [
        (held, len(w), sum(x in counts for x in w), total,
         sum(math.log10((counts[x] + 1) / (total + distinct + 1)) for x in w))
        for held, w in texts
    ]


STOPS = ".!?\n\u3002\uff01\uff1f\uff61\uff0e\u2026\u061f\u06d4\u0964\u0965\u0589\u1362"


def sentence_ends(text: str) -> list[int]:
    """Where sentences end, character by character: after stops and the spaces behind them.
    What has no word belongs to the sentence before, or to the first."""
    ends, worded = [], False
    for k, c in enumerate(text):
        behind = k and (text[k - 1] in STOPS or text[k - 1].isspace())
        if behind and c not in STOPS and not c.isspace() and worded:
            at = k
            while at and text[at - 1].isspace():
                at -= 1
            if at and text[at - 1] in STOPS or any(x in STOPS for x in text[at:k]):
                ends.append(k)
        worded |= not c.isspace() and c not in STOPS
    return [*ends, len(text)] if text else []


def words_around(text: str, place: int) -> int:
    """The words of the sentence that a place lies in."""
    ends = [0, *sentence_ends(text)]
    lo, hi = max(e for e in ends if e <= place), min(e for e in ends if e > place)
    return len("".join(" " if c in STOPS else c for c in text[lo:hi]).split())


def _pieces(text: str) -> list[tuple[int, int]]:
    """Sentences, those of more than 14 words cut before the words that are the least of twelve."""
    out, start = [], 0
    for end in sentence_ends(text):
        found = list(re.finditer(r"\S+", "".join(" " if c in STOPS else c for c in text[start:end])))
        cuts = set()
        if len(found) > 14:
            w = [crc32(m[0].lower().encode()) for m in found]
            factor = 0x9E3779B97F4A7C15
            h = [((w[k] * factor + w[k + 1]) * factor) % 2**64 for k in range(len(w) - 1)]
            for k in range(len(h) - 11):
                cuts.add(min(range(k, k + 12), key=lambda i: (h[i], i)))
        at = [start, *(start + found[k].start() for k in sorted(cuts - {0})), end]
        out += list(zip(at, at[1:]))
        start = end
    return out


def repeated_sentences(docs: list[tuple]):
    """(doc_id, text, places that go) of (doc_id, text) in order of ids, ids distinct."""
    seen: set[str] = set()
    for doc_id, text in docs:
        text, gone, new = text or "", set(), []
        pieces = _pieces(text)
        sizes = [len("".join(" " if c in STOPS else c for c in text[s:e]).split()) for s, e in pieces]
        runs, last = [], 0
        for first in range(len(pieces)):
            past = first + 2
            while past <= len(pieces) and sum(sizes[first:past]) < 25:
                past += 1
            if past > len(pieces):
                break
            runs.append((first, past))
            last = first
        if runs and runs[-1][1] < len(pieces):
            runs.append((last, len(pieces)))
        for first, past in runs:
            run = "\n".join(" ".join(text[s:e].lower().split()) for s, e in pieces[first:past])
            if run in seen:
                gone.update(range(pieces[first][0], pieces[past - 1][1]))
            seen.add(run)
        yield doc_id, text, gone
