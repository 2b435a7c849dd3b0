"""Quality rules whose cutoffs are certified on labelled documents."""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickmacro.llm.common import held, let, packed, staged, words

WINDOW = 5
#: Characters that count as symbols.
SYMBOLS = r"[#*$%&|<>]"
#: A document is rejected by a rule where its measure exceeds a cutoff. Each step lowers the
#: cutoff of one rule and keeps the others, so the sets of rules are nested, from lenient to
#: strict. The order is fixed before any label is seen: first what prose has least of.
STEPS: tuple[tuple[str, float], ...] = (
    *(("symbols", cut) for cut in (1.0, 0.5, 0.3, 0.2, 0.1)),
    *(("word_length", cut) for cut in (20.0, 15.0, 12.0, 10.0)),
    *(("capitals", cut) for cut in (0.5, 0.3, 0.2)),
    ("repeats", 0.2),
    ("dup_lines", 0.5),
    ("word_length", 8.0),
    ("capitals", 0.1),
    ("dup_lines", 0.3),
    ("repeats", 0.15),
    ("dup_lines", 0.2),
    ("repeats", 0.1),
    ("dup_lines", 0.1),
    ("repeats", 0.05),
)
RULES = tuple(dict.fromkeys(rule for rule, _ in STEPS))


def cutoffs_after(steps: int) -> dict[str, float]:
    """The cutoff of each rule after so many steps; rules without one reject nothing."""
    return dict(STEPS[:steps])


@dataclass(frozen=True)
class Risk:
    """At most ``false_rejects`` of the good documents of a stratum are rejected, by
    all rules together, with probability ``1 - failure`` for all strata at once."""

    false_rejects: float = 0.02
    failure: float = 0.05


def _repeat_words(tokens: Column) -> Column:
    """Words in windows that occur twice or more, the first occurrence included."""
    n = F.size(tokens)
    hashes = F.transform(
        F.sequence(F.lit(0), n - WINDOW),
        lambda i: F.xxhash64(*[F.get(tokens, i + j) for j in range(WINDOW)]),
    )

    def covered(ordered: Column) -> Column:
        again = F.filter(
            ordered,
            lambda x, j: (F.get(ordered, j - 1)["h"] == x["h"]) | (F.get(ordered, j + 1)["h"] == x["h"]),
        )
        places = F.array_sort(F.transform(again, lambda x: x["i"]))
        return F.aggregate(
            places,
            F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")),
            lambda acc, i: F.struct(
                (acc["n"] + F.least(F.lit(WINDOW), i - acc["last"])).alias("n"), i.alias("last")
            ),
            lambda acc: acc["n"],
        )

    def count(h: Column) -> Column:
        ordered = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) < F.size(h), let(ordered, covered)).otherwise(0)

    return F.when(n >= WINDOW, let(hashes, count)).otherwise(0)


def measured(
    docs: DataFrame,
    text: str = "text",
    stratum: str = "lang",
    keep: list[str] | None = None,
    beside: dict[str, Column] | None = None,
) -> DataFrame:
    """``docs`` as (row, rid, stratum, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, rules...).

    A null text has no words, a null stratum is one of its own. All counting is done
    in arrays inside the row, so a long text costs its length and nothing is shuffled.
    ``rid`` also keeps later filters from being pushed below, where they would count
    once more for each measure they name. ``beside`` adds columns.
    """
    beside = beside or {}
    rows = packed(
        docs,
        keep or docs.columns,
        text=F.coalesce(docs[f"`{text}`"], F.lit("")),
        stratum=docs[f"`{stratum}`"],
        **beside,
    )
    lines = F.filter(F.split("text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    by_words = let(
        words(F.col("text")),
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            _repeat_words(w).cast("long").alias("n_repeat_words"),
        ),
    )
    by_lines = let(
        lines,
        lambda ls: F.struct(
            F.size(ls).alias("n"), (F.size(ls) - F.size(F.array_distinct(ls))).cast("long").alias("n_dup_lines")
        ),
    )
    out = rows.select(
        "row",
        *beside,
        "stratum",
        by_words.alias("w"),
        by_lines.alias("l"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.regexp_count("text", F.lit("[A-Z]")).alias("n_upper"),
    )
    share = lambda part, whole: F.when(whole > 0, part / whole).otherwise(0.0)
    n_words, chars = F.col("w.n_words"), F.col("w.word_chars")
    out = out.select(
        "row",
        *beside,
        "stratum",
        n_words.alias("n_words"),
        chars.alias("word_chars"),
        "n_symbols",
        F.col("l.n_dup_lines").alias("n_dup_lines"),
        F.col("w.n_repeat_words").alias("n_repeat_words"),
        ((n_words < 10) | (100 * F.col("w.n_repeat_words") > 20 * n_words)).alias("base_failed"),
        share(F.col("n_symbols"), n_words).alias("symbols"),
        share(F.col("w.n_repeat_words"), n_words).alias("repeats"),
        share(F.col("l.n_dup_lines"), F.col("l.n")).alias("dup_lines"),
        share(chars, n_words).alias("word_length"),
        share(F.col("n_upper"), chars).alias("capitals"),
    )
    return out.withColumn("rid", F.monotonically_increasing_id())


def measure(docs: DataFrame, keep: list[str], text: str = "text", stratum: str = "lang") -> DataFrame:
    """``measured`` with the columns ``keep`` of each row, staged."""
    return staged(measured(docs, text, stratum, keep), "measured")


def binomial_cdf(x: Column, n: Column, p: float) -> Column:
    """P(X <= x) of n trials with probability p, summed term by term in logarithms."""
    odds = math.log(p / (1 - p))
    start = n * F.lit(math.log(1 - p))
    step = lambda acc, i: let(
        acc["log"] + F.log((n - i + 1) / i) + F.lit(odds),
        lambda term: F.struct(term.alias("log"), (acc["sum"] + F.exp(term)).alias("sum")),
    )
    first = F.struct(start.alias("log"), F.exp(start).alias("sum"))
    rest = F.when(x > 0, F.sequence(F.lit(1).cast("long"), x)).otherwise(F.array().cast("array<bigint>"))
    return F.aggregate(rest, first, step, lambda acc: acc["sum"])


def cutoffs(rows: DataFrame, labels: DataFrame, doc_id: str = "doc_id", risk: Risk = Risk()) -> DataFrame:
    """(stratum, n, steps, one column for each rule): how many steps are certified, and the
    cutoffs they end at, null where a rule has none.

    Held out are all labelled good documents that pass the base rules; a document
    labelled twice is good if any label says so, null labels say nothing. The sets of
    rules are tested in their order, each as a whole: it is certified if rejecting as few
    of the ``n`` documents as it does would have a chance below ``failure`` under a true
    rate of ``false_rejects``, the exact one-sided binomial bound. The first set that
    fails ends the sequence; as nothing is tested after it, the sets of a stratum share
    its chance whole (fixed-sequence testing), and only the strata divide it (Bonferroni).
    Few labels certify nothing, so nothing is rejected. Only counts for each stratum
    leave the tasks.
    """
    good = labels.groupBy("doc_id").agg(F.max("quality").alias("quality")).where("quality = 1")
    passed = rows.where(~F.col("base_failed"))
    out = passed.withColumn("doc_id", F.col(f"row.`{doc_id}`")).drop("row")
    out = out.join(good, "doc_id", "left_semi")
    counts = [
        F.sum(_rejected(cutoffs_after(k)).cast("long")).alias(f"x{k}") for k in range(1, len(STEPS) + 1)
    ]
    per = staged(out.groupBy("stratum").agg(F.count("*").alias("n"), *counts), "held")
    strata = per.select(F.count("*").alias("strata"))
    per = per.withColumn("strata", strata.scalar())
    allowed, n = F.lit(risk.failure) / F.col("strata"), F.col("n")

    def fails(k: int) -> Column:
        x = F.col(f"x{k}")
        chance = F.when(x < n * risk.false_rejects, binomial_cdf(x, n, risk.false_rejects)).otherwise(1.0)
        return F.when(chance > allowed, F.lit(k - 1))

    failed = [fails(k) for k in range(1, len(STEPS) + 1)]
    steps = F.coalesce(F.array_min(F.array(*failed)), F.lit(len(STEPS)))
    per = per.select("stratum", "n", steps.alias("steps"))
    ends = [
        F.get(F.array(*[F.lit(cutoffs_after(k).get(rule)).cast("double") for k in range(len(STEPS) + 1)]), F.col("steps"))
        .alias(f"cut_{rule}")
        for rule in RULES
    ]
    return staged(per.select("stratum", "n", "steps", *ends), "cutoffs")


def _rejected(cuts: dict[str, float]) -> Column:
    return reduce(or_, [F.col(rule) > cut for rule, cut in cuts.items()])


def judge(rows: DataFrame, certified: DataFrame) -> DataFrame:
    """``measured`` rows with ``kept``: false if the base rules or a certified cutoff reject."""
    certified = certified.select(F.col("stratum").alias("of"), *[f"cut_{rule}" for rule in RULES])
    joined = rows.join(certified, F.col("stratum").eqNullSafe(F.col("of")), "left")
    rejects = [F.coalesce(F.col(rule) > F.col(f"cut_{rule}"), F.lit(False)) for rule in RULES]
    return joined.withColumn("kept", ~F.col("base_failed") & ~reduce(or_, rejects))


def keep_good(
    docs: DataFrame, labels: DataFrame, text: str = "text", stratum: str = "lang", doc_id: str = "doc_id"
) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns, each text measured once.

    A verdict depends on text and stratum alone, so rejected rows are known again by two
    hashes of them, 128 bits in all. Rows that are surely kept are not shuffled.
    """
    of = [docs[f"`{text}`"].cast("string"), docs[f"`{stratum}`"]]
    key = {"k1": F.xxhash64(*of), "k2": F.xxhash64(F.lit("2"), *reversed(of))}
    rows = staged(measured(docs, text, stratum, [doc_id], key), "measured")
    judged = judge(rows, cutoffs(rows, labels, doc_id))
    gone = staged(judged.where("not kept").select(*key).distinct(), "rejected")
    maybe = held(gone, "k1")
    named = packed(docs, docs.columns, **key)
    some = named.where(maybe(F.col("k1"))).join(gone, list(key), "left_anti").select("row.*")
    return named.where(~maybe(F.col("k1"))).select("row.*").unionByName(some)
