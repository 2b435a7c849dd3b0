"""Language-model scoring: a hashed maximum-entropy model with class-factored softmax."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickmacro.llm.common import packed, staged

#: Stands for the end of a text; no word has a line break.
END = b"\n"
#: History before the first word.
_START = 0xFFFF
#: Distinct words a task counts before it hands them on.
_FLUSH = 200_000
#: Texts that a task works on at once.
_ROWS = 1024


@dataclass(frozen=True)
class Shape:
    """Sizes of the model, all fixed, whatever the corpus.

    The most frequent words are units of their own; the others share ``width`` units
    by hash, the last class. Units fall into ``width`` classes of ``width`` members in
    order of frequency. ``features`` and ``member_features`` are hash buckets for each
    kind of history. ``head`` words have their counts held by every task, the counts
    of the rest are joined. ``batch`` tokens make one update at rate ``rate``.
    """

    width: int = 32
    features: int = 4096
    member_features: int = 256
    head: int = 65536
    batch: int = 8192
    rate: float = 0.2
    workers: int = 4096

    @property
    def own_units(self) -> int:
        return self.width * (self.width - 1)


def tokens_of(text: bytes | None) -> list[bytes]:
    """Lower-cased words and the end."""
    out = (text or b"").lower().split()
    out.append(END)
    return out


def held_out(doc_id: Column) -> Column:
    """True for the documents that nothing is learnt from; a null id counts as empty."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 7 == 2


def vocabulary(rows: DataFrame) -> DataFrame:
    """(token, c): the count of every distinct token of the training texts, staged.

    Tasks count before they shuffle, in pieces of bounded size.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()
        for batch in batches:
            for value in batch.column(0).cast(pa.binary()):
                counts.update(tokens_of(value.as_py()))
                if len(counts) >= _FLUSH:
                    yield _counted(counts)
                    counts.clear()
        if counts:
            yield _counted(counts)

    found = rows.where(~F.col("held")).select("text").mapInArrow(run, "token binary, n long")
    return staged(found.groupBy("token").agg(F.sum("n").alias("c")), "vocabulary")


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in small batches, which bound what a task holds at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, _ROWS):
            yield batch.slice(at, _ROWS)


def _counted(counts: Counter[bytes]) -> pa.RecordBatch:
    arrays = [pa.array(counts.keys(), pa.binary()), pa.array(counts.values(), pa.int64())]
    return pa.RecordBatch.from_arrays(arrays, ["token", "n"])


@dataclass
class Words:
    """What tasks know about words: totals, the head of the vocabulary, unit totals."""

    total: int
    distinct: int
    counts: dict[bytes, int]
    units: dict[bytes, int]
    rest_counts: np.ndarray
    rest_distinct: np.ndarray

    def base(self, count: int) -> float:
        return math.log10((count + 1) / (self.total + self.distinct + 1))


def known_words(vocab: DataFrame, shape: Shape) -> Words:
    """The totals and the ``head`` most frequent words: bounded by ``shape``."""
    total = vocab.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    # Counts fall into fixed bins; the head is all words of as many top bins as fit.
    step = F.floor(F.log2("c") * 8).cast("int")
    left, lowest = shape.head, None
    for r in vocab.groupBy(step.alias("bin")).agg(F.count("*").alias("v")).orderBy(F.desc("bin")).collect():
        left -= r["v"]
        if left < 0:
            break
        lowest = r["bin"]
    head = [] if lowest is None else vocab.where(step >= lowest).collect()
    head = sorted(((bytes(r["token"]), r["c"]) for r in head), key=lambda x: (-x[1], x[0]))
    counts = dict(head)
    units = {token: unit for unit, token in enumerate(list(counts)[: shape.own_units])}
    unit = F.crc32("token") % shape.width
    rest = vocab.groupBy(unit.alias("unit")).agg(F.sum("c").alias("c"), F.count("*").alias("v")).collect()
    rest_counts, rest_distinct = np.zeros(shape.width, np.int64), np.zeros(shape.width, np.int64)
    for r in rest:
        rest_counts[r["unit"]], rest_distinct[r["unit"]] = r["c"], r["v"]
    for token in units:
        rest_counts[crc32(token) % shape.width] -= counts[token]
        rest_distinct[crc32(token) % shape.width] -= 1
    return Words(total["n"], total["v"], counts, units, rest_counts, rest_distinct)


def encode(rows: DataFrame, words: Words, shape: Shape) -> DataFrame:
    """(row, rid, held, n_tokens, known, base, inner, units, hashes, rest), staged.

    Each text as unit numbers and word hashes of two bytes. ``base`` and ``inner`` have
    the log10 chances of its head words: alone, and within their unit. ``rest`` lists
    the other words with their numbers, for the join with the vocabulary.
    """
    spark = rows.sparkSession
    held = spark.sparkContext.broadcast(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = held.value
        counts, units, width, own = w.counts, w.units, shape.width, shape.own_units
        # All that is known of a head word, by its place; one lookup for each token finds it.
        place = {t: k for k, t in enumerate(counts)}
        head_hash = np.fromiter(map(crc32, counts), np.uint32, len(counts))
        head_unit = np.fromiter((units.get(t, own + crc32(t) % width) for t in counts), np.uint16, len(counts))
        base = np.array([w.base(c) for c in counts.values()])
        inner = np.array([0.0 if t in units else _inside(w, crc32(t) % width, c) for t, c in counts.items()])
        for batch in _slices(batches):
            out: list[list] = [[] for _ in range(6)]
            rest_tokens, rest_counts, rest_ends = [], [], [0]
            for value in batch.column(3).cast(pa.binary()):
                tokens = tokens_of(value.as_py())
                at = np.fromiter(map(place.get, tokens, repeat(-1)), np.int64, len(tokens))
                on = at >= 0
                known, off = at[on], np.flatnonzero(~on).tolist()
                hashes, unit = np.empty(len(at), np.uint32), np.empty(len(at), np.uint16)
                hashes[on], unit[on] = head_hash[known], head_unit[known]
                if off:
                    rare = [tokens[k] for k in off]
                    hashes[off] = np.fromiter(map(crc32, rare), np.uint32, len(rare))
                    unit[off] = own + hashes[off] % width
                    each = Counter(rare)
                    rest_tokens.extend(each)
                    rest_counts.extend(each.values())
                rest_ends.append(len(rest_tokens))
                cells = (
                    len(tokens),
                    len(known),
                    float(base[known].sum()),
                    float(inner[known].sum()),
                    unit.astype("<u2").tobytes(),
                    (hashes & 0xFFFF).astype("<u2").tobytes(),
                )
                for column, cell in zip(out, cells):
                    column.append(cell)
            kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary(), pa.binary())
            arrays = [batch.column(k) for k in range(3)]
            arrays += [pa.array(column, kind) for column, kind in zip(out, kinds)]
            pairs = [pa.array(rest_tokens, pa.binary()), pa.array(rest_counts, pa.int64())]
            rest = pa.StructArray.from_arrays(pairs, ["token", "n"])
            arrays.append(pa.ListArray.from_arrays(pa.array(rest_ends, pa.int32()), rest))
            yield pa.RecordBatch.from_arrays(arrays, names)

    names = ["row", "rid", "held", "n_tokens", "known", "base", "inner", "units", "hashes", "rest"]
    row_type = rows.schema["row"].dataType.simpleString()
    out = rows.select("row", "rid", "held", "text").mapInArrow(
        run,
        f"row {row_type}, rid long, held boolean, n_tokens long, known long, base double, inner double,"
        " units binary, hashes binary, rest array<struct<token: binary, n: long>>",
    )
    return staged(out, "encoded")


def _inside(words: Words, unit: int, count: int) -> float:
    return math.log10((count + 1) / (words.rest_counts[unit] + words.rest_distinct[unit] + 1))


class Model:
    """Weights of the two softmax layers.

    log P(class | history) adds a bias and the weights of three hashed features: the
    last word, the one before it (a skip), and both together. log P(member | class,
    history) adds a bias and the weights of the class with the last word.
    """

    def __init__(self, words: Words, shape: Shape) -> None:
        width = shape.width
        counts = np.full(width * width, 0.5)
        for token, unit in words.units.items():
            counts[unit] += words.counts[token]
        counts[shape.own_units :] += words.rest_counts + words.rest_distinct
        grid = counts.reshape(width, width)
        self.shape = shape
        self.class_bias = np.log(grid.sum(axis=1) / grid.sum()).astype(np.float32)
        self.member_bias = np.log(grid / grid.sum(axis=1, keepdims=True)).astype(np.float32)
        self.classes = np.zeros((3 * shape.features, width), np.float32)
        self.members = np.zeros((width * shape.member_features, width), np.float32)

    def features(self, hashes: np.ndarray, starts: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        """Buckets of the three features of each token, and of the last word for members."""
        last, skip = np.full(len(hashes), _START, np.uint32), np.full(len(hashes), _START, np.uint32)
        last[1:], skip[2:] = hashes[:-1], hashes[:-2]
        last[starts] = skip[starts] = _START
        second = starts[starts + 1 < len(hashes)] + 1
        skip[second] = _START
        size = np.uint32(self.shape.features)
        both = (last * np.uint32(0x9E3779B1) ^ skip * np.uint32(0x85EBCA77)) >> np.uint32(12)
        return [last % size, size + skip % size, np.uint32(2) * size + both % size], last % np.uint32(self.shape.member_features)

    def chances(self, feats: list[np.ndarray], inner: np.ndarray, units: np.ndarray) -> tuple[np.ndarray, ...]:
        """Class and member probabilities, and the rows of member weights."""
        by_class = np.take(self.classes, feats[0], axis=0)
        for f in feats[1:]:
            by_class += np.take(self.classes, f, axis=0)
        by_class += self.class_bias
        own = units // self.shape.width
        rows = own.astype(np.uint32) * np.uint32(self.shape.member_features) + inner
        by_member = np.take(self.members, rows, axis=0)
        by_member += np.take(self.member_bias, own, axis=0)
        return _softmax(by_class), _softmax(by_member), rows

    def log10(self, feats: list[np.ndarray], inner: np.ndarray, units: np.ndarray) -> np.ndarray:
        classes, members, _ = self.chances(feats, inner, units)
        at = np.arange(len(units))
        width = self.shape.width
        return np.log10(classes[at, units // width].astype(np.float64) * members[at, units % width])


def _softmax(scores: np.ndarray) -> np.ndarray:
    """Chances of each row; halves and products are much faster here than numpy's sums and
    maxima along short rows."""
    most = scores
    while most.shape[1] > 1:
        half = (most.shape[1] + 1) // 2
        most = np.maximum(most[:, :half], most[:, -half:])
    scores -= most
    np.exp(scores, out=scores)
    scores /= (scores @ np.ones(scores.shape[1], scores.dtype))[:, None]
    return scores


def _streams(batches: Iterator[pa.RecordBatch], units: int, hashes: int) -> Iterator[tuple]:
    """Batches of texts as (batch, unit numbers, word hashes, where texts begin)."""
    for batch in _slices(batches):
        flat = [np.frombuffer(b"".join(batch.column(k).to_pylist()), "<u2") for k in (units, hashes)]
        lengths = np.array([len(x.as_py()) // 2 for x in batch.column(units)], np.int64)
        starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
        yield batch, flat[0].astype(np.int64), flat[1].astype(np.uint32), starts, lengths


class _Learner:
    """Adaptive gradient steps on one task's copy of the weights."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.power = [np.full(len(w), 1e-6, np.float32) for w in (model.classes, model.members)]
        self.seen = [np.zeros(len(w), np.int64) for w in (model.classes, model.members)]

    def learn(self, feats: list[np.ndarray], inner: np.ndarray, units: np.ndarray) -> None:
        model, width = self.model, self.model.shape.width
        classes, members, rows = model.chances(feats, inner, units)
        at = np.arange(len(units))
        classes[at, units // width] -= 1
        members[at, units % width] -= 1
        for f in feats:
            self._step(0, model.classes, f, classes)
        self._step(1, model.members, rows, members)

    def _step(self, layer: int, weights: np.ndarray, rows: np.ndarray, slope: np.ndarray) -> None:
        # Numbers of two bytes are sorted by their digits.
        order = np.argsort(rows.astype(np.uint16) if len(weights) <= 1 << 16 else rows, kind="stable")
        ordered = rows[order]
        first = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
        which = ordered[first]
        total = np.add.reduceat(np.take(slope, order, axis=0), first, axis=0)
        self.seen[layer][which] += np.diff(np.append(first, len(rows)))
        self.power[layer][which] += np.square(total).mean(axis=1)
        weights[which] -= self.model.shape.rate * total / np.sqrt(self.power[layer][which])[:, None]


def train(encoded: DataFrame, model: Model, rounds: int = 1) -> Model:
    """``model`` after ``rounds`` of distributed gradient updates over all training texts.

    In a round every task starts from the common weights and takes a step for each
    batch of its tokens; then each row of weights becomes the mean over the tasks,
    weighted by how often they met its feature. The sums are ordinary aggregates with
    one row for each weight row and task; the model that comes back has a fixed size.
    """
    shape, spark = model.shape, encoded.sparkSession
    columns = [f"x{k}" for k in range(shape.width)]
    for _ in range(rounds):
        given = spark.sparkContext.broadcast(model)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            learner = None
            for _, units, hashes, starts, _ in _streams(batches, 0, 1):
                learner = learner or _Learner(_copied(given.value))
                feats, inner = learner.model.features(hashes, starts)
                for at in range(0, len(units), shape.batch):
                    part = slice(at, at + shape.batch)
                    learner.learn([f[part] for f in feats], inner[part], units[part])
            if learner is None:
                return
            for layer, weights in enumerate((learner.model.classes, learner.model.members)):
                rows = np.flatnonzero(learner.seen[layer])
                times = learner.seen[layer][rows]
                sums = weights[rows].astype(np.float64) * times[:, None]
                arrays = [pa.array(np.full(len(rows), layer, np.int32)), pa.array(rows.astype(np.int32)), pa.array(times)]
                arrays += [pa.array(np.ascontiguousarray(sums[:, k])) for k in range(shape.width)]
                yield pa.RecordBatch.from_arrays(arrays, ["layer", "i", "n", *columns])

        texts = encoded.where(~F.col("held")).select("units", "hashes").coalesce(shape.workers)
        out = texts.mapInArrow(run, "layer int, i int, n long, " + ", ".join(f"{c} double" for c in columns))
        means = out.groupBy("layer", "i").agg(*[(F.sum(c) / F.sum("n")).alias(c) for c in columns]).toArrow()
        model = _copied(model)
        where = means["layer"].to_numpy(), means["i"].to_numpy()
        values = np.column_stack([means[c].to_numpy() for c in columns]).astype(np.float32)
        for layer, weights in enumerate((model.classes, model.members)):
            chosen = where[0] == layer
            weights[where[1][chosen]] = values[chosen]
    return model


def _copied(model: Model) -> Model:
    out = object.__new__(Model)
    out.__dict__.update(model.__dict__)
    out.classes, out.members = model.classes.copy(), model.members.copy()
    return out


def rate(encoded: DataFrame, model: Model) -> DataFrame:
    """(row, rid, held, n_tokens, known, base, score): the head words' part of ``base``
    and ``score``; ``score`` has the units of all words."""
    given = encoded.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = given.value
        for batch, units, hashes, starts, lengths in _streams(batches, 7, 8):
            feats, inner = m.features(hashes, starts)
            logs = np.concatenate(
                [
                    m.log10([f[at : at + m.shape.batch] for f in feats], inner[at : at + m.shape.batch], units[at : at + m.shape.batch])
                    for at in range(0, len(units), m.shape.batch)
                ]
            )
            sums = np.bincount(np.repeat(np.arange(len(starts)), lengths), logs, len(starts))
            total = pa.array(sums + batch.column(6).to_numpy())
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(6)), total], names)

    names = ["row", "rid", "held", "n_tokens", "known", "base", "score"]
    row_type = encoded.schema["row"].dataType.simpleString()
    given_columns = encoded.select(*names[:6], "inner", "units", "hashes")
    return given_columns.mapInArrow(
        run, f"row {row_type}, rid long, held boolean, n_tokens long, known long, base double, score double"
    )


def rest_sums(encoded: DataFrame, vocab: DataFrame, words: Words, shape: Shape) -> DataFrame:
    """(rid, known, base, inner) of the words that tasks do not hold.

    Words are counted for each text before the join, so what is shuffled is one row
    for a text and a rare word; no frequent word is among them.
    """
    rest = encoded.select("rid", F.explode("rest").alias("r")).select("rid", "r.token", "r.n")
    joined = rest.join(vocab, "token", "left").withColumn("c", F.coalesce("c", F.lit(0)))
    unit = (F.crc32("token") % shape.width).cast("int")
    spare = (words.rest_counts + words.rest_distinct + 1).tolist()
    whole = F.get(F.array(*map(F.lit, spare)), unit)
    everything = F.lit(words.total + words.distinct + 1)
    return joined.groupBy("rid").agg(
        F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("more_known"),
        F.sum(F.col("n") * F.log10((F.col("c") + 1) / everything)).alias("more_base"),
        F.sum(F.col("n") * F.log10((F.col("c") + 1) / whole)).alias("more_score"),
    )


def score_texts(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    keep: list[str] | None = None,
    shape: Shape = Shape(),
    rounds: int = 1,
) -> DataFrame:
    """(row, held, n_tokens, n_known, train_tokens, base_score, score) for every text.

    The chance of a word is P(class | history) P(unit | class, history) P(word | unit),
    the last from counts and 1 for frequent words, with room for unseen ones. A null
    text is empty and has its end alone. Repeated rows are scored and learnt from each
    by itself. Without training texts all words are unseen.
    """
    rows = packed(
        docs,
        keep or docs.columns,
        rid=F.monotonically_increasing_id(),
        held=held_out(docs[f"`{doc_id}`"]),
        text=docs[f"`{text}`"].cast("string"),
    )
    vocab = vocabulary(rows)
    words = known_words(vocab, shape)
    encoded = encode(rows, words, shape)
    model = train(encoded, Model(words, shape), rounds) if words.total else Model(words, shape)
    joined = rate(encoded, model).join(rest_sums(encoded, vocab, words, shape), "rid", "left")
    plus = lambda a, b: F.col(a) + F.coalesce(b, F.lit(0))
    return joined.select(
        "row",
        "held",
        "n_tokens",
        plus("known", "more_known").alias("n_known"),
        F.lit(words.total).cast("long").alias("train_tokens"),
        plus("base", "more_base").alias("base_score"),
        plus("score", "more_score").alias("score"),
    )
