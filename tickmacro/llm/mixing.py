"""Mixing sources to target weights by hash-random order and exact budgets."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickmacro.llm.common import packed, staged, words

#: Weights of the sources in order, repeating.
WEIGHTS = (1, 2, 3)
#: No document is taken more often than this.
EPOCHS = 3
#: Documents for each range of hash keys, about.
RANGE_DOCS = 1024


def sized(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    source: str = "source",
    keep: list[str] | None = None,
) -> DataFrame:
    """``docs`` as (row, rid, id, source, size, key), staged.

    ``size`` is the number of words, 0 for null. ``key`` in [0, 1) comes from the hash
    of the id alone, so reruns agree; a null id counts as the empty one.
    """
    rows = packed(
        docs,
        keep or docs.columns,
        id=docs[f"`{doc_id}`"],
        source=docs[f"`{source}`"].cast("string"),
        size=F.size(words(docs[f"`{text}`"])).cast("long"),
    )
    digest = F.md5(F.coalesce(F.col("id").cast("string"), F.lit("")).cast("binary"))
    key = F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") / F.lit(float(16**13))
    return staged(rows.withColumn("key", key).withColumn("rid", F.monotonically_increasing_id()), "sized")


def targets(sizes: DataFrame) -> DataFrame:
    """(sid, source, docs, source_size, target) for every source of ``sized`` rows.

    Sources are numbered by code point, null last, and weighted 1, 2, 3, repeating.
    Targets share the total size by weight and stop at three times their source's
    size; the excess is shared again by weight until none is above. In order of cap
    per unit of weight the capped sources come first, so running sums decide it
    in one pass over one row for each source.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs"))
    rank = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source"))
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("sid") - 1) % len(WEIGHTS) + 1)
    per = per.withColumn("sid", rank).withColumn("w", weight).withColumn("cap", EPOCHS * F.col("source_size"))
    everything = Window.partitionBy()
    upto = Window.orderBy(F.col("cap") / F.col("w"), "sid").rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(upto), F.lit(0))
    weights = F.sum("w").over(everything) - F.coalesce(F.sum("w").over(upto), F.lit(0))
    per = per.withColumn("capped", left * F.col("w") >= F.col("cap") * weights)
    free = F.sum("source_size").over(everything) - F.sum(F.when(F.col("capped"), F.col("cap")).otherwise(0)).over(everything)
    free_w = F.sum(F.when(F.col("capped"), 0).otherwise(F.col("w"))).over(everything)
    target = F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(
        free.cast("double") * F.col("w") / F.greatest(free_w, F.lit(1))
    )
    return staged(per.withColumn("target", target).select("sid", "source", "docs", "source_size", "target"), "targets")


def take(sizes: DataFrame) -> DataFrame:
    """``sized`` rows with ``source_size``, ``target`` and ``taken``, the words to take.

    Each source is cut into ranges of its hash keys, as many as it has documents for;
    sums for each range give where it starts, and a window inside the range the rest.
    So a source with most of the rows is spread like any other. A source is taken
    whole as often as its target holds it, then its documents in key order up to the
    exact budget; the last one is taken in part. Empty documents take nothing.
    """
    per = targets(sizes)
    of = per.select(F.col("source").alias("of"), "sid", "docs", "source_size", "target")
    rows = sizes.join(of, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    ranges = F.ceil(F.col("docs") / RANGE_DOCS)
    rows = rows.withColumn("range", F.floor(F.col("key") * ranges))
    sums = rows.groupBy("sid", "range").agg(F.sum("size").alias("range_size"))
    upto = Window.partitionBy("sid").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("start", F.coalesce(F.sum("range_size").over(upto), F.lit(0))).drop("range_size")
    inside = (
        Window.partitionBy("sid", "range").orderBy("key", "id", "size").rowsBetween(Window.unboundedPreceding, -1)
    )
    rows = rows.join(staged(sums, "ranges"), ["sid", "range"])
    before = F.col("start") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    budget = F.floor("target")
    epochs = F.when(F.col("source_size") > 0, F.expr("floor(target) div source_size")).otherwise(0)
    rest = budget - epochs * F.col("source_size")
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest - before))
    return rows.withColumn("taken", (epochs * F.col("size") + part).cast("long"))


def mixed(docs: DataFrame, **names: str) -> DataFrame:
    """The rows of ``docs``, each as many times as the mix takes it, whole.

    The document at the edge of the budget, taken in part, is given whole, so a
    source exceeds its target by less than one document. Documents not taken go.
    """
    sizes = sized(docs, **names)
    taken = take(sizes.drop("row")).where("taken > 0")
    times = taken.select("rid", F.ceil(F.col("taken") / F.col("size")).cast("int").alias("times"))
    # Both sides are dealt by row number at every size, the texts evenly.
    rows = sizes.select("rid", "row").join(staged(times, "times").hint("merge"), "rid")
    return rows.select("row", F.explode(F.array_repeat(F.lit(0), F.col("times")))).select("row.*")
