"""Secret scans: fixed forms, and character Markov models for the rest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickmacro.llm.common import let, masked, matches, packed, spans_text, staged

#: The forms of secrets that are found by pattern.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
RANKS = {"assign": 0, "access": 1, "hex": 2, "random": 3}
#: Tokens that the models judge, and those of them that count as ordinary identifiers.
TOKEN = r"[A-Za-z0-9+/_=-]{16,}"
ORDINARY = r"^([0-9]+|[A-Z]++|[A-Z]?[a-z]++)(?:[_-](?:[0-9]+|[A-Z]++|[A-Z]?[a-z]++))*+$"
#: Character codes; 0 stands for the start and the end of a token.
CODES = 128


def scan(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` as (row, base, tokens), staged: spans of the fixed forms, and of tokens
    that touch none of them. Spans have kind, start, end and value; a null text has none.

    Shorter matches than the forms ask for are left out by the patterns: a match that
    is too short has no longer one inside it.
    """
    rows = packed(docs, keep or docs.columns, text=F.coalesce(docs[f"`{text}`"].cast("string"), F.lit("")))
    assign = F.filter(
        matches(F.col("text"), "assign", ASSIGN), lambda s: F.length(F.regexp_extract(s["value"], ASSIGN, 2)) >= 8
    )
    base = F.concat(assign, matches(F.col("text"), "access", ACCESS), matches(F.col("text"), "hex", HEX))
    out = rows.select("row", base.alias("base"), matches(F.col("text"), "random", TOKEN).alias("tokens"))
    free = lambda s: ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
    return staged(out.select("row", "base", F.filter("tokens", free).alias("tokens")), "secrets")


def labelled(scanned: DataFrame) -> DataFrame:
    """(token, random): the samples that a scan itself labels.

    Values of the fixed forms are random strings; tokens made of words and
    numbers alone are ordinary identifiers; all other tokens are left to the models.
    """
    value = lambda s: F.when(s["kind"] == "assign", F.regexp_extract(s["value"], ASSIGN, 2)).otherwise(s["value"])
    secret = scanned.select(F.explode(F.transform("base", value)).alias("token"), F.lit(True).alias("random"))
    words = F.filter("tokens", lambda s: s["value"].rlike(ORDINARY))
    plain = scanned.select(F.explode(F.transform(words, lambda s: s["value"])).alias("token"), F.lit(False).alias("random"))
    return secret.union(plain)


def _codes(token: Column) -> Column:
    return F.transform(F.split(token, ""), lambda c: F.least(F.ascii(c), F.lit(CODES - 1)))


def train(samples: DataFrame, smoothing: float = 0.5) -> DataFrame:
    """One row (ratio, cut) from samples (token, random); no row without both labels.

    ``ratio`` holds log P(next | last, random) - log P(next | last, ordinary) for every
    pair of characters at ``last * CODES + next``: additively smoothed first-order
    Markov models, flattened into one array of fixed size. ``cut`` is halfway between
    the mean log-likelihood ratios for a character of the two kinds of samples.
    Only pair counts leave the tasks.
    """
    pairs = lambda c: F.zip_with(
        F.concat(F.array(F.lit(0)), c), F.concat(c, F.array(F.lit(0))), lambda a, b: a * CODES + b
    )
    counts = samples.select("random", F.explode(let(_codes(F.col("token")), pairs)).alias("at"))
    counts = counts.groupBy("at").agg(
        F.count(F.when(F.col("random"), 1)).alias("n1"), F.count(F.when(~F.col("random"), 1)).alias("n0")
    )
    counts = staged(counts, "pairs")
    spark = samples.sparkSession
    grid = spark.range(CODES * CODES).select(F.col("id").cast("int").alias("at"))
    grid = grid.withColumn("last", F.floor(F.col("at") / CODES))
    seen = counts.groupBy(F.floor(F.col("at") / CODES).alias("last")).agg(F.sum("n1").alias("t1"), F.sum("n0").alias("t0"))
    grid = grid.join(counts, "at", "left").join(seen, "last", "left").fillna(0)
    log = lambda n, t: F.log((F.col(n) + smoothing) / (F.col(t) + smoothing * CODES))
    cell = F.struct("at", (log("n1", "t1") - log("n0", "t0")).alias("v"))
    ratio = grid.agg(F.transform(F.array_sort(F.collect_list(cell)), lambda x: x["v"]).alias("ratio"))
    ratio = staged(ratio, "ratio")
    rated = samples.withColumn("ratio", ratio.scalar())
    rated = rated.select("random", score(F.col("token"), F.col("ratio")).alias("s"))
    means = rated.agg(
        F.avg(F.when(F.col("random"), F.col("s"))).alias("m1"), F.avg(F.when(~F.col("random"), F.col("s"))).alias("m0")
    )
    means = staged(means.where("m1 > m0").select(((F.col("m1") + F.col("m0")) / 2).alias("cut")), "cut")
    return means.withColumn("ratio", ratio.scalar())


def score(token: Column, ratio: Column) -> Column:
    """The log-likelihood ratio of a token for each of its steps."""
    step = lambda acc, c: F.struct(
        c.alias("last"), (acc["sum"] + F.get(ratio, acc["last"] * CODES + c)).alias("sum")
    )
    start = F.struct(F.lit(0).alias("last"), F.lit(0.0).alias("sum"))
    return F.aggregate(
        _codes(token), start, step, lambda acc: acc["sum"] + F.get(ratio, acc["last"] * CODES)
    ) / (F.length(token) + 1)


def find_secrets(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """(row, base, spans): spans of the fixed forms, and with them those of tokens that
    the models call random. Without samples of both kinds the models add none.

    Repeated rows are judged alike, each by itself. Nothing but the pair counts is
    shuffled; the models are two constants to the tasks.
    """
    scanned = scan(docs, text, keep)
    model = staged(train(labelled(scanned)), "model")
    rated = scanned.withColumns({"ratio": model.select("ratio").scalar(), "cut": model.select("cut").scalar()})
    random = F.filter("tokens", lambda s: F.coalesce(score(s["value"], F.col("ratio")) > F.col("cut"), F.lit(False)))
    return rated.select("row", "base", F.concat("base", random).alias("spans"))


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every secret replaced by ``[secret]``."""
    found, body = find_secrets(docs, text), F.col(f"row.`{text}`")
    clean = F.when(F.size("spans") > 0, masked(body, F.col("spans"), dict.fromkeys(RANKS, "[secret]")))
    return found.select(*[clean.otherwise(body).alias(c) if c == text else F.col(f"row.`{c}`") for c in docs.columns])


def digest(spans: Column) -> Column:
    return spans_text(spans, RANKS)
