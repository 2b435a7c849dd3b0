"""Main text of pages: templates deduced per host from tokens that occur alike, and what
is left in their slots."""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickmacro.llm.common import packed, staged
from tickmacro.llm.markup import Page, Run, parse
from tickmacro.llm.url_filter import host_of

#: A host shows a template from so many different pages on; a token of it is on this share
#: of them at least, and a class has so many tokens.
PAGES, SUPPORT, TOKENS = 8, 0.8, 3
#: Elements that may stand around an article; the first is the page itself.
_CONTAINERS = {"", "html", "body", "div", "section", "td", "center"}


def token_counts(pages: DataFrame, html: str = "html", url: str = "url") -> DataFrame:
    """(host, page, tokens), one row for each different page of a host.

    ``page`` is a hash of the whole page, so copies count once; ``tokens`` are structs of
    token, count and first place, with token 0, which is once in every page.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, tokens, counts, places = [0], [], [], []
            for value in batch.column(2).cast(pa.binary()):
                order = parse(value.as_py().decode("utf-8", "replace")).tokens
                count = Counter(order)
                first = {t: len(order) - at for at, t in enumerate(reversed(order))}
                tokens.append(0)
                tokens.extend(count)
                counts.append(1)
                counts.extend(count.values())
                places.append(0)
                places.extend(first[t] for t in count)
                sizes.append(len(tokens))
            each = pa.StructArray.from_arrays(
                [pa.array(tokens, pa.int64()), pa.array(counts, pa.int32()), pa.array(places, pa.int32())], ["t", "c", "at"]
            )
            lists = pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), each)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists], ["host", "page", "tokens"])

    body = pages[f"`{html}`"].cast("string")
    given = pages.select(host_of(pages[f"`{url}`"].cast("string")).alias("host"), F.xxhash64(body).alias("page"), body.alias("html"))
    given = given.where("host <> '' and html <> ''")
    counted = given.mapInArrow(run, "host string, page long, tokens array<struct<t: long, c: int, at: int>>")
    return counted.groupBy("host", "page").agg(F.first("tokens").alias("tokens"))


def templates(counted: DataFrame) -> DataFrame:
    """(host, classes), staged: the equivalence classes of each host, the most frequent and
    largest first, each the tokens in template order.

    Two tokens are in one class if their occurrence vectors, the counts over all different
    pages of the host, are equal. A vector is known by two hashes, summed by exclusive or,
    so it is one row for each token and task however many pages the host has. Classes
    keep the tokens that are frequent: those of a page or two, whatever the host.
    """
    each = counted.select("host", "page", F.explode("tokens").alias("k")).select("host", "page", "k.*")
    vectors = each.groupBy("host", "t").agg(
        F.count("*").alias("n"),
        F.bit_xor(F.xxhash64("page", "c")).alias("v1"),
        F.bit_xor(F.xxhash64("c", "page", F.lit(1))).alias("v2"),
        F.sum("at").alias("at"),
    )
    frequent = staged(vectors.where(F.col("n") >= PAGES), "vectors")
    hosts = frequent.where("t = 0").select("host", F.col("n").alias("pages"))
    wide = frequent.where("t <> 0").join(hosts, "host").where(F.col("n") >= SUPPORT * F.col("pages"))
    classes = wide.groupBy("host", "v1", "v2").agg(
        F.max("n").alias("n"), F.array_sort(F.collect_list(F.struct("at", "t"))).alias("tokens")
    )
    classes = classes.where(F.size("tokens") >= TOKENS)
    ranked = F.array_sort(F.collect_list(F.struct(-F.col("n"), -F.size("tokens"), F.col("tokens.t").alias("t"))))
    return staged(classes.groupBy("host").agg(ranked["t"].alias("classes")), "templates")


def valid(order: list[int], classes: list[list[int]]) -> set[int]:
    """The tokens of the classes that are valid on a page: each comes whole and in order,
    and classes lie inside or beside each other, never across. Where two cross, the less
    frequent one goes."""
    place = {t: (c, k) for c, tokens in enumerate(classes) for k, t in enumerate(tokens)}
    met = [place[t] for t in order if t in place]
    alive = {c for c, _ in met}
    while True:
        stack, bad = [], None
        for c, k in met:
            if c not in alive:
                continue
            if k == 0:
                stack.append([c, 0])
            elif stack and stack[-1] == [c, k - 1]:
                stack[-1][1] = k
            else:
                bad = max(c, stack[-1][0]) if stack else c
                break
            if k == len(classes[c]) - 1:
                stack.pop()
        if bad is None and stack:
            bad = stack[-1][0]
        if bad is None:
            return {t for c in alive for t in classes[c]}
        alive.discard(bad)


def _size(runs: list[Run]) -> int:
    return sum(len(r.text.strip()) for r in runs)


def _region(page: Page, runs: list[Run], template: set[int]) -> list[Run]:
    """The runs of the article: of the largest article element, else of the main element,
    else of the largest one named so, else of the element around the largest slot."""
    for rank in (2, 1, 0):
        inside: dict[int, list[Run]] = defaultdict(list)
        for r in runs:
            inside[page.main[r.element][rank]].append(r)
        inside.pop(-1, None)
        found = max(inside.values(), key=_size, default=[])
        if _size(found):
            return found
    once = {t for t, n in Counter(page.tokens).items() if n == 1 and t in template}
    slots: dict[int, list[Run]] = defaultdict(list)
    slot, ordered = 0, iter([r for r in page.runs if r.token])
    run = next(ordered, None)
    for t in page.tokens:
        if run is not None and t == run.token:
            if t not in template and not page.dropped[run.element]:
                slots[slot].append(run)
            run = next(ordered, None)
        slot += t in once
    best = max(slots.values(), key=lambda s: _size([r for r in s if page.name[r.element] != "a"]), default=[])
    if not _size(best):
        return []
    # Elements are numbered as they begin, so those inside one follow it without a gap.
    last = list(range(len(page.parent)))
    for e in range(len(last) - 1, 0, -1):
        last[page.parent[e]] = max(last[page.parent[e]], last[e])
    around = min(r.element for r in best)
    end = max(r.element for r in best)
    while last[around] < end or page.name[around] not in _CONTAINERS:
        around = page.parent[around]
    return [r for r in runs if around <= r.element <= last[around]]


def _blocks(runs: list[Run]) -> list[list[Run]]:
    out: list[list[Run]] = []
    for r in runs:
        if not out or out[-1][0].block != r.block:
            out.append([])
        out[-1].append(r)
    return out


def main_text(html: str, classes: list[list[int]] | None = None) -> str:
    """The main text of a page under the classes of its host.

    A block of which the template has every word goes, unless the template had most of
    the article: then its pages are near copies, and the article stays. The only headline
    of a page belongs to its article wherever it stands.
    """
    page = parse(html)
    template = valid(page.tokens, classes) if classes else set()
    runs = [r for r in page.runs if not page.dropped[r.element]]
    region = _region(page, runs, template)
    heads = [r for r in runs if page.name[r.element] == "h1"]
    if region and len({r.element for r in heads}) == 1 and not any(r.element == heads[0].element for r in region):
        region = heads + region if heads[0].block < region[0].block else region
    blocks = [b for b in _blocks(region) if any(r.token for r in b)]
    fixed = [all(r.token in template for r in b if r.token) for b in blocks]
    if 2 * sum(_size(b) for b, f in zip(blocks, fixed) if f) <= _size(region):
        blocks = [b for b, f in zip(blocks, fixed) if not f]
    lines = (" ".join("".join(r.text for r in b).split()) for b in blocks)
    return "\n".join(line for line in lines if line)


def extract(pages: DataFrame, html: str = "html", url: str = "url", keep: list[str] | None = None) -> DataFrame:
    """``pages`` as (row, text), ``row`` with the columns ``keep``, all of them by default.

    A first pass counts the tokens of all different pages; the templates are a few
    hundred bytes for each host, and Spark ships them or shuffles by host as their size
    says. The second pass reads each page with its host's template. Hosts of fewer than
    ``PAGES`` different pages, and pages without a host, have none: elements and their
    names alone decide there. Null and empty pages have an empty text; copies come out
    alike. No rows give none.
    """
    found = templates(token_counts(pages, html, url))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known: dict[str, list[list[int]] | None] = {}
            texts = []
            for host, value, classes in zip(batch.column(1), batch.column(2).cast(pa.binary()), batch.column(3)):
                host = host.as_py()
                if host not in known:
                    known[host] = classes.as_py()
                texts.append(main_text((value.as_py() or b"").decode("utf-8", "replace"), known[host]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["row", "text"])

    rows = packed(
        pages, keep or pages.columns, host=host_of(pages[f"`{url}`"].cast("string")), html=pages[f"`{html}`"].cast("string")
    )
    joined = rows.join(found, "host", "left").select("row", "host", "html", "classes")
    row_type = rows.schema["row"].dataType.simpleString()
    return joined.mapInArrow(run, f"row {row_type}, text string")
