"""HTML main text by a site style tree (Yi, Liu and Li, "Eliminating Noisy
Information in Web Pages for Data Mining").

The DOMs of a host's pages are merged from the top: a branch has the same place in
the site's tree when its parent has, with the same sequence of children (tag, class,
id).  A place is therefore a hash of the path to it, made page by page, and merging
is counting:

* presentation: over the m pages with a branch, the entropy (base m) of its child
  sequences; a branch always laid out alike tells nothing;
* content of a leaf: 1 minus the mean entropy of its contents' occurrence, so text
  that many pages of the site repeat has little;
* importance of a branch with l child sequences: (1 - g^l) presentation + g^l content
  of the leaves below, g = 0.9.

Branches below THRESHOLD go.  What a page names itself bounds the importance: nav,
footer, aside, form, script ... and classes such as ad from above (out), article and
main from below, but for what is named noise inside; on a page with an article or
main the rest is bounded from above too.  Readers' comments are out whatever their
size.  A name never makes html, body, main, article or a branch around a main element
noise; a named branch other than comments that holds more than half of a page's text is left to
the counts.  Hosts of fewer than FEW pages are judged by the tree of all pages.

The site decides inside main parts too, where places differ with the number of
paragraphs: a block that stands word for word, on the same path of labels, on more
than half of a host's distinct pages (and on REPEATED or more) is the site's, such as
a notice in every article.  It stays where such blocks are most of a page's text: then
the page is a copy.  Branches that no name tells are noise where the page itself or the site shows
it: two or more siblings of one label that each open with a name and a date are comments,
and so is what stands on their path on other pages (CARDS pages must show it);
undecided branches of LINKS links or more that make most of their text are menus.

Counts are partial aggregations over (host, place); where they meet their host's
number of pages, a host's rows are dealt to SPREAD tasks.  What goes is a list of keys, and
tasks drop the blocks by it: broadcast up to SMALL keys, joined beyond.
"""

from __future__ import annotations

import struct
from collections.abc import Container, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelens.llm.frames import checkpointed, column, free_name, texts_in_small_batches
from storelens.llm.html_tree import Branch, cards, has_main, link_shares, parse

THRESHOLD = 0.5
DECAY = 0.9
FEW = 20
DEEPEST = 24                         # branches below this depth count as part of their parent
REPEATED = 10                        # pages of a host on which a block inside a main part stands before it can go
CARDS = 2                            # pages that show comments on a path before it counts on the others
LINKS = 2
SPREAD = 32
SMALL = 2_000_000                    # keys, 16 MB
PLACE, CONTENT, COMMENT, PAGE = range(4)


def _hash(*parts: object) -> int:
    return xxhash.xxh64_intdigest("\x1f".join(map(str, parts)).encode("utf-8", "surrogatepass")) - (1 << 63)


def _content(branch: Branch) -> str:
    return "\n".join(c if isinstance(c, str) else _content(c) for c in branch.children)


def places(root: Branch) -> list[tuple[int, int, int | None, list[int]]]:
    """(place, style, content, places above) of every branch outside named parts of a page.

    style is a hash of the child sequence; content, for branches without child
    branches and for named parts, one of the text.
    """
    out: list[tuple[int, int, int | None, list[int]]] = []
    todo: list[tuple[Branch, int, list[int]]] = [(root, 0, [])]
    while todo:
        branch, place, above = todo.pop()
        below = [c for c in branch.children if isinstance(c, Branch)]
        style = _hash(*[c.label for c in below])
        decided = branch.kind == "noise" or branch.kind == "main" and not branch.asks
        if decided or not below or len(above) >= DEEPEST:
            out.append((place, 0, _hash(_content(branch)), above))
            continue
        out.append((place, style, None, above))
        todo += [(c, _hash(place, style, i, c.label), [*above, place]) for i, c in enumerate(below)]
    return out


def _spark_hash(value: bytes, seed: int) -> int:
    return struct.unpack("<q", struct.pack("<Q", xxhash.xxh64_intdigest(value, seed % (1 << 64))))[0]


def place_key(host: str, place: int) -> int:
    """What Spark's xxhash64 makes of (xxhash64(host), place)."""
    site = _spark_hash(host.encode("utf-8", "surrogatepass"), 42)
    return _spark_hash(struct.pack("<q", place), _spark_hash(struct.pack("<q", site), 42))


def main_blocks(root: Branch, host: str = "", shown: set[int] | None = None) -> list[tuple[list[int], int, str]]:
    """Text blocks in page order that the page itself doesn't rule out: (keys that rule one out if
    the site has any of them, key of its content on its path, block).  Keys of the label paths on
    which the page shows comments are added to ``shown``."""
    outside = "out" if has_main(root) else "ask"
    shares = link_shares(root) if outside == "ask" else {}
    out: list[tuple[list[int], int, str]] = []

    def walk(branch: Branch, place: int, depth: int, state: str, path: int, paths: list[int]) -> None:
        """state: "keep" (a main part), "ask" (the counts decide) or "out" (beside a main part)."""
        below = [c for c in branch.children if isinstance(c, Branch)]
        style = _hash(*[c.label for c in below]) if below else 0
        i, comments = 0, cards(branch) if len(below) > 1 and state != "out" else ()
        if id(branch) in comments:
            if shown is not None:
                shown.add(paths[-1])
            return
        for child in branch.children:
            if isinstance(child, str):
                if state != "out":
                    asked = [place_key(host, place)] if state == "ask" else []
                    out.append(([*asked, *paths], _hash("block", host, path, child), child))
                continue
            links, linked, size = shares.get(id(child), (0, 0, 0)) if state == "ask" else (0, 0, 0)
            menu = links >= LINKS and 2 * linked > size
            if child.kind != "noise" and not menu:
                there = _hash(path, child.label)
                if id(child) in comments:
                    if shown is not None:
                        shown.add(_hash("comments", host, there))
                else:
                    inner = place if depth >= DEEPEST else _hash(place, style, i, child.label)
                    walk(child, inner, depth + 1, "keep" if child.kind == "main" else
                         "ask" if child.kind == "open" and state == "keep" else state,
                         there, [*paths, _hash("comments", host, there)] if not child.kind and state != "out" else paths)
            i += 1

    walk(root, 0, 0, outside, 0, [])
    return out


def kept_text(blocks: list[tuple[list[int], int, str]], low: Container[int]) -> str:
    """The blocks that no key of ``low`` rules out, joined; blocks the site repeats stay where they are
    most of what is left."""
    left = [(content in low, block) for keys, content, block in blocks if not any(k in low for k in keys)]
    repeated = sum(len(b) for again, b in left if again)
    copy = 2 * repeated > sum(len(b) for _, b in left)
    return "\n\n".join(b for again, b in left if copy or not again)


def _with_host(rows: DataFrame, hosts: DataFrame) -> DataFrame:
    """Join by host, a host's rows dealt to SPREAD tasks."""
    dealt = hosts.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))
    return rows.withColumn("part", F.pmod(F.xxhash64("place"), F.lit(SPREAD)).cast("int")).join(
        dealt, ["host", "part"]).drop("part")


def branch_importance(counted: DataFrame, *, decay: float = DECAY, few: int = FEW) -> DataFrame:
    """(host, place, importance) from counted (host, place, style, content, above, n)."""
    pages = counted.where("place = 0").groupBy("host").agg(F.sum("n").alias("pages"))
    sited = _with_host(counted, pages).withColumn(
        "site", F.when(F.col("pages") >= few, F.concat(F.lit("host:"), "host")).otherwise(F.lit("all")))
    # the tree of all pages holds every host's pages, the small hosts' too
    small = sited.withColumn("site", F.lit("all"))
    everywhere = sited.where("site <> 'all'").unionAll(small)
    merged = everywhere.groupBy("site", "place", "style", "content").agg(
        F.sum("n").alias("n"), F.first("above").alias("above"))
    log_n = F.col("n") * F.log(F.col("n"))
    stats = merged.groupBy("site", "place").agg(
        F.sum("n").alias("m"), F.sum(log_n).alias("nlogn"), F.avg(F.log(F.col("n"))).alias("logn"),
        F.count("*").alias("l"), F.max(F.col("content").isNotNull()).alias("leaf"), F.first("above").alias("above"))
    log_m = F.log(F.col("m"))
    scored = stats.withColumn("own", F.when(F.col("m") == 1, F.lit(1.0)).when(
        F.col("leaf"), 1 - F.col("logn") / log_m).otherwise((log_m - F.col("nlogn") / F.col("m")) / log_m))
    content = scored.where("leaf").select("site", "m", "own", F.explode("above").alias("place")).groupBy(
        "site", "place").agg((F.sum(F.col("m") * F.col("own")) / F.sum("m")).alias("content"))
    fade = F.pow(F.lit(decay), F.col("l"))
    judged = scored.join(content, ["site", "place"], "left").select("site", "place", F.when(
        F.col("leaf"), F.col("own")).otherwise(
        (1 - fade) * F.col("own") + fade * F.coalesce("content", F.lit(0.0))).alias("importance"))
    of_host = sited.select("host", "site", "place").distinct()
    return of_host.join(judged, ["site", "place"]).select("host", "place", "importance")


def low_keys(counted: DataFrame, threshold: float, decay: float, few: int) -> DataFrame:
    """(key) of what goes: places of low importance, contents that a host repeats, paths of comments."""
    places = branch_importance(counted.where(F.col("kind") == PLACE).drop("pages"), decay=decay, few=few).where(
        F.col("importance") < threshold).select(F.xxhash64("host", "place").alias("key"))
    pages = counted.where(F.col("kind") == PAGE).select("host", "pages")
    repeated = counted.where(F.col("kind") == CONTENT).select("host", "place", F.col("pages").alias("n"))
    contents = _with_host(repeated, pages).where(2 * F.col("n") > F.col("pages")).select(F.col("place").alias("key"))
    comments = counted.where((F.col("kind") == COMMENT) & (F.col("pages") >= CARDS)).select(F.col("place").alias("key"))
    return places.unionAll(contents).unionAll(comments).distinct()


def _host(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def extract(pages: DataFrame, *, page_id: str = "page_id", url: str = "url", html: str = "html",
            threshold: float = THRESHOLD, decay: float = DECAY, few: int = FEW) -> DataFrame:
    """Every page with text (main text, '' if none) instead of html, and n_chars.

    Blocks are joined by an empty line; white space inside one is one space.  A null
    or empty html gives ''.  Rows may repeat; null urls are the host ''.  Columns
    text and n_chars are replaced; others pass.
    """
    names = [c for c in pages.columns if c != html and c.lower() not in ("text", "n_chars")]

    def branches(host: str, html: str | None) -> list[tuple]:
        root, shown = parse(html or ""), set()
        blocks = main_blocks(root, host, shown)
        page = _hash(*[content for _, content, _ in blocks])
        return [*((PLACE, p, s, c, a) for p, s, c, a in places(root)),
                *((CONTENT, k, page, None, None) for k in {content for _, content, _ in blocks}),
                *((COMMENT, k, page, None, None) for k in shown),
                (PAGE, 0, page, None, None)]

    @F.pandas_udf("array<struct<kind:int,place:bigint,style:bigint,content:bigint,above:array<bigint>>>")
    def tree(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        keys = ("kind", "place", "style", "content", "above")
        for hosts, rows in batches:
            yield pd.Series([[dict(zip(keys, b, strict=True)) for b in branches(h, r)]
                             for h, r in zip(hosts, rows, strict=True)], dtype=object)

    texts_in_small_batches(pages.sparkSession)
    at, source = free_name(pages, "site_host", "site_html")
    given = pages.select(*[column(pages, c) for c in names], _host(column(pages, url)).alias(at),
                         column(pages, html).alias(source))
    seen = given.select(F.xxhash64(at).alias("host"), F.explode(tree(at, source)).alias("b")).select("host", "b.*")
    once = seen.groupBy("host", "kind", "place", "style", "content").agg(
        F.count("*").alias("n"), F.first("above").alias("above"))
    # of all but places, whose style is the page, the number of distinct pages counts; few contents stand on many
    counted = checkpointed(once.withColumn("style", F.when(F.col("kind") == PLACE, F.col("style"))).groupBy(
        "host", "kind", "place", "style", "content").agg(
        F.sum("n").alias("n"), F.count("*").alias("pages"), F.first("above").alias("above")).where(
        (F.col("kind") != CONTENT) | (F.col("pages") >= REPEATED)))
    low = checkpointed(low_keys(counted, threshold, decay, few))
    if low.limit(SMALL + 1).count() <= SMALL:
        found = np.sort(low.toArrow().column(0).to_numpy())
        shared = pages.sparkSession.sparkContext.broadcast(found)

        @F.pandas_udf("string")
        def cleaned(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
            known = frozenset(shared.value.tolist())
            for hosts, rows in batches:
                yield pd.Series([kept_text(main_blocks(parse(r or ""), h), known)
                                 for h, r in zip(hosts, rows, strict=True)], dtype=object)

        out = given.select(*[f"`{c}`" for c in names], cleaned(at, source).alias("text"))
    else:
        out = _joined(given, low, names, at, source)
    return out.withColumn("n_chars", F.length("text").cast("bigint"))


def _joined(given: DataFrame, low: DataFrame, names: list[str], at: str, source: str) -> DataFrame:
    """The same for any number of keys: a page's keys meet ``low`` in a join, then its own row again.
    Equal rows are one page and stand again as often afterwards."""
    @F.pandas_udf("array<bigint>")
    def keys(hosts: pd.Series, rows: pd.Series) -> pd.Series:
        return pd.Series([sorted({k for own, content, _ in main_blocks(parse(r or ""), h) for k in (*own, content)})
                          for h, r in zip(hosts, rows, strict=True)], dtype=object)

    @F.pandas_udf("string")
    def cleaned(hosts: pd.Series, rows: pd.Series, low: pd.Series) -> pd.Series:
        return pd.Series([kept_text(main_blocks(parse(r or ""), h), frozenset(() if x is None else x))
                          for h, r, x in zip(hosts, rows, low, strict=True)], dtype=object)

    row = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)])
    page = ["row", "host", "html"]
    pages = given.select(row.alias("row"), F.col(at).alias("host"), F.col(source).alias("html")).groupBy(
        F.xxhash64(*page).alias("id1"), F.xxhash64(F.lit(1), *page).alias("id2")).agg(
        F.count("*").alias("times"), *[F.first(c).alias(c) for c in page])
    ruled = pages.select("id1", "id2", F.explode(keys("host", "html")).alias("key")).join(low, "key").groupBy(
        "id1", "id2").agg(F.collect_set("key").alias("low"))
    joined = pages.join(ruled, ["id1", "id2"], "left").withColumn("time", F.explode(F.sequence(F.lit(1), F.col("times"))))
    return joined.select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(names)],
                         cleaned("host", "html", "low").alias("text"))
