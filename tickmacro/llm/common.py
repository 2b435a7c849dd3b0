"""Parts the text operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickmacro.files import delete
from tickmacro.session import new_dir

#: What separates words in most contracts.
SPACES = r"[\x20\x09-\x0D]+"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    It cuts the lineage: a lost executor costs a re-read, not a new text pass, and
    ids drawn while writing stay what they are. Spark knows the size of the table
    it reads back and decides on joins by it.
    """
    spark = df.sparkSession
    path = new_dir(spark, name)
    if _scratch:
        _scratch[-1].append((name, path))
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_scratch: list[list[tuple[str, str]]] = []


@contextmanager
def scratch(spark: SparkSession, keep: tuple[str, ...]) -> Iterator[None]:
    """Delete what is staged inside, but for the names in ``keep``, at the end: for tables
    that nothing reads once those are written. What is kept goes with the block around."""
    _scratch.append([])
    try:
        yield
    finally:
        for name, path in _scratch.pop():
            if name not in keep:
                delete(spark, path)
            elif _scratch:
                _scratch[-1].append((name, path))


def packed(docs: DataFrame, keep: list[str], **columns: Column) -> DataFrame:
    """The columns ``keep`` as one column ``row``, so that no name can clash."""
    row = F.struct(*[docs[f"`{name}`"] for name in keep]).alias("row")
    return docs.select(row, *[column.alias(name) for name, column in columns.items()])


def words(text: Column, separators: str = SPACES) -> Column:
    """The words of a text, an empty array for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), separators), "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once.

    What a lambda captures is computed anew for every element; its own parameter
    is not, so the value becomes the one element of an array.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())


def _added(values: Column, start: Column) -> Column:
    """The sums of ``start`` and the values up to each."""
    step = lambda acc, x: let(
        acc["sum"] + x, lambda total: F.struct(total.alias("sum"), F.array_append(acc["all"], total).alias("all"))
    )
    first = F.struct(start.cast("long").alias("sum"), F.array().cast("array<bigint>").alias("all"))
    return F.aggregate(values, first, step, lambda acc: acc["all"])


def running(values: Column, block: int = 512) -> Column:
    """Running sums of an array of longs.

    An append copies what is there, so the array is summed in blocks: tens of
    thousands of values cost little more than their number.
    """

    def by_block(blocks: Column) -> Column:
        sums = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0).cast("long"), lambda acc, x: acc + x))
        starts = F.concat(F.array(F.lit(0).cast("long")), _added(sums, F.lit(0)))
        starts = F.slice(starts, 1, F.size(blocks))
        return F.flatten(F.zip_with(blocks, starts, _added))

    def cut(v: Column) -> Column:
        last = F.floor((F.size(v) - 1) / block).cast("int")
        blocks = F.transform(F.sequence(F.lit(0), last), lambda k: F.slice(v, k * block + 1, F.lit(block)))
        return F.when(F.size(v) > 0, let(blocks, by_block)).otherwise(F.array().cast("array<bigint>"))

    return let(values, cut)


def matches(text: Column, kind: str, pattern: str | Column) -> Column:
    """Every leftmost match as a struct of kind, start, end and value.

    Starts and ends are code points, the end exclusive. The pieces between the
    matches have all other characters, so running lengths give the positions and
    a long text is read once. ``pattern`` must not match the empty string.
    """
    pattern = F.lit(pattern) if isinstance(pattern, str) else pattern

    def spans(found: Column) -> Column:
        pieces = F.slice(F.split(text, pattern, -1), 1, F.size(found))
        lengths = F.zip_with(pieces, found, lambda piece, value: (F.length(piece) + F.length(value)).cast("long"))
        return F.zip_with(
            found,
            running(lengths),
            lambda value, end: F.struct(
                F.lit(kind).alias("kind"),
                (end - F.length(value)).alias("start"),
                end.alias("end"),
                value.alias("value"),
            ),
        )

    none = F.array().cast("array<struct<kind:string,start:bigint,end:bigint,value:string>>")
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    return F.when(F.rlike(text, pattern), let(found, spans)).otherwise(none)


def spans_text(spans: Column, rank: dict[str, int]) -> Column:
    """``kind:start:end`` of spans by start, then by ``rank``, joined by commas."""
    ranks = F.create_map(*[F.lit(x) for pair in rank.items() for x in pair])
    keyed = F.transform(
        spans,
        lambda s: F.struct(
            s["start"].alias("start"),
            F.element_at(ranks, s["kind"]).alias("rank"),
            s["end"].alias("end"),
            s["kind"].alias("kind"),
        ),
    )
    return F.array_join(
        F.transform(
            F.array_sort(keyed),
            lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def masked(text: Column, spans: Column, marks: dict[str, str]) -> Column:
    """``text`` with each span replaced by the mark of its kind, ``[kind]`` by default.

    Of spans that overlap the first is replaced.
    """
    table = F.create_map(*[F.lit(x) for pair in marks.items() for x in pair])
    mark = lambda kind: F.coalesce(table[kind], F.concat(F.lit("["), kind, F.lit("]")))
    ordered = F.array_sort(
        F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    )

    def step(acc: Column, s: Column) -> Column:
        between = F.substring(text, acc["at"] + 1, (s["start"] - acc["at"]).cast("int"))
        more = F.struct(
            F.concat(acc["out"], between, mark(s["kind"])).alias("out"), s["end"].cast("int").alias("at")
        )
        return F.when(s["start"] >= acc["at"], more).otherwise(acc)

    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    return F.aggregate(
        ordered, start, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text)))
    )


#: Slots of a map of held numbers: a quarter of a megabyte, whatever the number of rows.
HELD = 1 << 21


def held(ids: DataFrame, column: str = "rid") -> Callable[[Column], Column]:
    """A test for numbers, true for all of a column of ``ids`` and few others.

    It is a bit for each of ``HELD`` hashes, which travels with the plan, so rows that it
    rules out are not shuffled. With more numbers it lets more others through: work, not
    results, as an exact join follows where that matters. The bits are a subquery's one
    value: the driver's Python has none of them, nor does any text of a plan.
    """
    slot = lambda x: F.pmod(F.xxhash64(x), F.lit(HELD)).cast("int")
    bits = ids.select(slot(F.col(column)).alias("s")).select(
        F.shiftright("s", 5).alias("i"), F.expr("shiftleft(1, s & 31)").alias("b")
    )
    none = ids.sparkSession.range(HELD // 32).select(F.col("id").cast("int").alias("i"), F.lit(0).alias("b"))
    words = bits.union(none).groupBy("i").agg(F.bit_or("b").alias("b"))
    table = words.agg(F.sort_array(F.collect_list(F.struct("i", "b")))["b"].alias("bits")).scalar()

    def test(x: Column) -> Column:
        at = slot(x)
        return F.call_function("shiftright", F.get(table, F.shiftright(at, 5)), at.bitwiseAND(31)).bitwiseAND(1) == 1

    return test
