"""URL filters: host and path rules, and a character language-model ratio for the rest."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickmacro.llm.common import let, lower_ascii, packed, staged

#: Characters with a code of their own, from 1 on; digits share one. 0 stands for the
#: edge of a URL, the last code for all others.
ALPHABET = "abcdefghijklmnopqrstuvwxyz0./-_?=&#%:~+@"
CODES = len(ALPHABET) + 2
#: Scores are told apart to a thousandth; one that is further out counts as 30.
STEPS, FURTHEST = 1000, 30.0


@dataclass(frozen=True)
class Rule:
    """``host`` with its subdomains, and paths that begin with ``path``."""

    host: str
    path: str
    allow: bool

    @property
    def name(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        of_host = (host == self.host) | host.endswith("." + self.host)
        return of_host & path.startswith(self.path)


def host_of(url: Column) -> Column:
    """What lies between the first ``://`` and ``/``, ``?``, ``#`` or the end, A-Z
    lower-cased; empty for null or without ``://``."""
    return lower_ascii(F.regexp_extract(_after_scheme(url), "^[^/?#]*", 0))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after_scheme(url), "^[^/?#]*([^?#]*)", 1)


def tail_of(url: Column) -> Column:
    """Query and fragment: what follows host and path."""
    return F.regexp_extract(_after_scheme(url), r"(?s)^[^?#]*(.*)$", 1)


def _after_scheme(url: Column) -> Column:
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def apply_rules(pages: DataFrame, rules: list[Rule], url: str = "url", keep: list[str] | None = None) -> DataFrame:
    """``pages`` as (row, host, path, tail, rule, allowed): the longest rule that fits wins,
    both null where none does. Rules are settings, so they are part of the plan."""
    rows = packed(pages, keep or pages.columns, url=pages[f"`{url}`"].cast("string"))
    rows = rows.select("row", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), tail_of(F.col("url")).alias("tail"))
    rule, allowed = F.lit(None).cast("string"), F.lit(None).cast("boolean")
    for r in sorted(rules, key=lambda r: len(r.name)):
        fits = r.fits(F.col("host"), F.col("path"))
        rule, allowed = F.when(fits, r.name).otherwise(rule), F.when(fits, r.allow).otherwise(allowed)
    return rows.select("*", rule.alias("rule"), allowed.alias("allowed"))


def _grams(*parts: Column) -> Column:
    """Codes of all runs of three characters, two edges before and one after the URL."""
    text = F.translate(lower_ascii(F.concat(*parts)), "123456789", "000000000")
    chars = F.filter(F.split(text, ""), lambda c: c != "")
    code = lambda c: let(F.instr(F.lit(ALPHABET), c), lambda i: F.when(i > 0, i).otherwise(CODES - 1))
    edge = F.lit(0)

    def runs(x: Column) -> Column:
        before2 = F.slice(F.concat(F.array(edge, edge), x), 1, F.size(x) + 1)
        before1 = F.slice(F.concat(F.array(edge), x), 1, F.size(x) + 1)
        pairs = F.zip_with(before2, before1, lambda a, b: a * CODES + b)
        return F.zip_with(pairs, F.concat(x, F.array(edge)), lambda ab, c: ab * CODES + c)

    return let(F.transform(chars, code), runs)


def train(labelled: DataFrame, smoothing: float = 2.0) -> DataFrame:
    """One row (ratio) from (grams, allowed).

    For accepted and for rejected URLs alike, the chance of a character after two
    others falls back on that after one, and that on the character's own, each shorter
    context weighing as much as ``smoothing`` observations. ``ratio`` has
    log P(accepted) - log P(rejected) of every run of three, so orders 0 to 2 are one
    array of fixed size. Counts cover all labelled rows; only they leave the tasks.
    """
    counts = labelled.select("allowed", F.explode("grams").alias("at")).groupBy("at").agg(
        F.count(F.when(F.col("allowed"), 1)).alias("y"), F.count(F.when(~F.col("allowed"), 1)).alias("n")
    )
    counts = staged(counts, "grams")
    keys = {
        "ab": F.floor(F.col("at") / CODES),
        "bc": F.col("at") % (CODES * CODES),
        "b": F.floor(F.col("at") / CODES) % CODES,
        "c": F.col("at") % CODES,
    }
    grid = labelled.sparkSession.range(CODES**3).select(F.col("id").cast("int").alias("at"))
    grid = grid.withColumns(keys).join(counts, "at", "left")
    for name, key in keys.items():
        sums = counts.groupBy(key.alias(name)).agg(F.sum("y").alias(f"y_{name}"), F.sum("n").alias(f"n_{name}"))
        grid = grid.join(sums, name, "left")
    grid = grid.fillna(0)
    total = counts.agg(F.sum("y").alias("y"), F.sum("n").alias("n"))

    def chance(of: str) -> Column:
        own = (F.col(f"{of}_c") + 1) / (total.select(of).scalar() + CODES)
        after_one = (F.col(f"{of}_bc") + smoothing * own) / (F.col(f"{of}_b") + smoothing)
        return (F.col(of) + smoothing * after_one) / (F.col(f"{of}_ab") + smoothing)

    known = grid.where((total.select("y").scalar() > 0) & (total.select("n").scalar() > 0))
    known = known.select("at", (F.log(chance("y")) - F.log(chance("n"))).alias("v"))
    cells = F.array_sort(F.collect_list(F.struct("at", "v")))
    ratio = known.agg(F.transform(cells, lambda x: x["v"]).alias("ratio"))
    return staged(ratio.where(F.size("ratio") > 0), "ratio")


def step_of(grams: Column, ratio: Column) -> Column:
    """The log-likelihood difference for each character, in whole steps."""
    mean = F.aggregate(grams, F.lit(0.0), lambda acc, g: acc + F.get(ratio, g)) / F.size(grams)
    return F.floor(F.greatest(F.least(mean, F.lit(FURTHEST)), F.lit(-FURTHEST)) * STEPS)


def calibrate(held: DataFrame, false_rejects: float = 0.01) -> DataFrame:
    """One row (cut) from held-out (step, allowed): URLs at or below are rejected.

    Of the cuts that reject no more than ``false_rejects`` of the accepted URLs, the
    one that tells both kinds apart best, the lowest of equals, moved halfway to the
    next step that was seen. The steps are bounded,
    so the running sums are over a fixed number of rows at most.
    """
    per = held.groupBy("step").agg(
        F.count(F.when(F.col("allowed"), 1)).alias("y"), F.count(F.when(~F.col("allowed"), 1)).alias("n")
    )
    upto, all_rows = Window.orderBy("step").rowsBetween(Window.unboundedPreceding, 0), Window.partitionBy()
    share = lambda c: F.try_divide(F.sum(c).over(upto), F.sum(c).over(all_rows))
    next_step = F.lead("step").over(Window.orderBy("step"))
    halfway = F.floor((F.col("step") + F.coalesce(next_step, "step")) / 2).alias("halfway")
    cuts = per.select("step", halfway, share("y").alias("wrong"), share("n").alias("right"))
    cuts = cuts.where((F.col("wrong") <= false_rejects) & F.col("right").isNotNull())
    order = F.struct((F.col("right") - F.col("wrong")).alias("gain"), (-F.col("step")).alias("low"), "halfway")
    best = cuts.agg(F.max(order).alias("best"))
    return staged(best.select(F.col("best.halfway").alias("cut")).where("cut is not null"), "cut")


def filter_urls(
    pages: DataFrame,
    rules: list[Rule],
    url: str = "url",
    keep: list[str] | None = None,
    folds: int = 5,
    false_rejects: float = 0.01,
) -> DataFrame:
    """(row, host, path, rule, verdict) for every page.

    Rules look at host and path; the models at these and at query and fragment as well.
    Pages with a rule have its verdict and are the labels: all but one fold, by hash
    of host and path, train the models, the last sets the cut. Without labels of both
    kinds, or without a cut, the other pages are allowed. Null URLs are judged as empty.
    """
    judged = apply_rules(pages, rules, url, keep)
    judged = staged(judged.withColumn("grams", _grams(F.col("host"), F.col("path"), F.col("tail"))), "urls")
    labelled = judged.where("allowed is not null")
    digest = F.md5(F.concat("host", "path").cast("binary"))
    fold = F.conv(F.substring(digest, 1, 4), 16, 10).cast("int") % folds
    ratio = train(labelled.where(fold != 0))
    held = labelled.where(fold == 0).withColumn("ratio", ratio.scalar())
    cut = calibrate(held.select("allowed", step_of(F.col("grams"), F.col("ratio")).alias("step")).where("step is not null"), false_rejects)
    rated = judged.withColumns({"ratio": ratio.scalar(), "cut": cut.scalar()})
    bad = F.coalesce(step_of(F.col("grams"), F.col("ratio")) <= F.col("cut"), F.lit(False))
    verdict = F.when(F.coalesce("allowed", ~bad), "allow").otherwise("block")
    return rated.select("row", "host", "path", "rule", verdict.alias("verdict"))
