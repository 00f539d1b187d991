"""Mixing sources to target weights with Efraimidis-Spirakis sampling.

Every document gets the key -ln(u) / w: u is a pseudo-random number from its id
and text, w its quality weight.  Taking documents by ascending key is a weighted sample
without replacement, the same on every run.  Per source, whole epochs come
first; the rest of the target is filled by the documents with the smallest keys,
found by a prefix sum of sizes.

A hot source is no single sort: keys are cut into ranges of about ROWS_A_BIN documents
(by their number), sums per range give each range its offset, and only inside a range
are documents sorted.  Targets need all sources in one order, which is one task of one
row a source: at most MAX_SOURCES.  DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storelens.llm.frames import checkpointed, column

WEIGHTS = (3, 1, 2)
SHARE = 1.5
LIMIT = 2
ROWS_A_BIN = 1000
MAX_BINS = 1 << 20
MAX_SOURCES = 1_000_000
_WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(_WORD)), F.lit(0)).cast("bigint")


def quality(text: Column) -> Column:
    """Quality weight in [0.25, 1.25]: more, the more of the text is letters of words
    (ASCII digits, punctuation and white space are not)."""
    chars = F.length(text)
    rest = F.length(F.regexp_replace(text, r"[\x00-\x40\x5B-\x60\x7B-\x7F]+", ""))
    return F.coalesce(F.when(chars > 0, F.lit(0.25) + rest / chars), F.lit(0.25))


def uniform(doc_id: Column, text: Column) -> Column:
    """In (0, 1), from the first 13 hex digits of the MD5 of id and text (nulls count as '')."""
    row = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.coalesce(text, F.lit("")))
    digits = F.substring(F.md5(row.cast("binary")), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / float(1 << 52)


def source_targets(sizes: DataFrame, *, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE,
                   limit: float = LIMIT) -> DataFrame:
    """(source, source_size) -> also target, one row per source.

    Sources in code point order (null last) weigh ``weights``, repeating.  They
    share ``share`` of all sizes by weight; a target stops at ``limit`` times its
    source's size and the excess is shared again by weight until none is above.
    That is target = min(cap, level * weight) for one level: with the sources in
    order of cap / weight, that of the first source that reaches its cap only above
    the level it and those after it would share; levels rise up to it and fall after.
    """
    by_code_point = Window.orderBy(F.col("source").asc_nulls_last())
    order = F.array(*[F.lit(float(w)) for w in weights])
    place = F.row_number().over(by_code_point) - 1
    ranked = sizes.withColumn("weight", F.element_at(order, (place % len(weights) + 1).cast("int"))) \
        .withColumn("cap", F.col("source_size").cast("double") * limit)
    rising = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    whole = Window.partitionBy()
    budget = F.sum(F.col("source_size").cast("double")).over(whole) * share
    before = F.coalesce(F.sum("cap").over(rising.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    after = F.sum("weight").over(rising.rowsBetween(0, Window.unboundedFollowing))
    levels = ranked.withColumn("level", (budget - before) / after)
    # where every source stands at its cap no level is found and the caps are the targets
    level = F.max(F.when(F.col("cap") / F.col("weight") >= F.col("level"), F.col("level"))).over(whole)
    return levels.withColumn("found", level).select("source", "source_size", F.coalesce(
        F.least("cap", F.col("found") * F.col("weight")), F.col("cap")).alias("target"))


def mix(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", source: str = "source",
        weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, limit: float = LIMIT,
        bins: int | None = None) -> DataFrame:
    """(doc_id, size, source, source_size, target, taken) for every row.

    size counts words (null: 0); taken is size times the copies the mix takes:
    whole epochs of the source, and one copy more for the documents of smallest
    key while that brings the source nearer to its target.  Equal keys go by
    size, then by id; rows of one id, source and text are interchangeable.  ``bins``: ranges
    of keys, by default as many as the documents need.  More than MAX_SOURCES sources are refused.
    """
    key = -F.log(uniform(column(docs, doc_id), column(docs, text))) / quality(column(docs, text))
    sized = checkpointed(docs.select(column(docs, doc_id).alias("doc_id"), column(docs, source).alias("source"),
                                     word_count(column(docs, text)).alias("size"), key.alias("key")))
    sizes = checkpointed(sized.groupBy("source").agg(F.sum("size").alias("source_size")))
    if sizes.limit(MAX_SOURCES + 1).count() > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources; one task could not order them")
    if bins is None:
        bins = min(MAX_BINS, 1 + sized.count() // ROWS_A_BIN)
    targets = source_targets(sizes, weights=weights, share=share, limit=limit)
    targets = checkpointed(targets.withColumn("epochs", F.when(
        F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)))
        .withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size")))
    # 1 - exp(-key) runs over (0, 1) evenly for weight 1, so the ranges are about even
    binned = sized.withColumn("bin", F.least(F.lit(bins - 1), F.floor(
        (1 - F.exp(-F.col("key"))) * bins)).cast("int"))
    ahead = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    offsets = binned.groupBy("source", "bin").agg(F.sum("size").alias("binned")).select(
        F.col("source").alias("s"), F.col("bin").alias("b"), "binned",
        F.coalesce(F.sum("binned").over(ahead), F.lit(0)).alias("offset"))
    placed = targets.withColumnRenamed("source", "t").join(
        offsets, F.col("s").eqNullSafe(F.col("t"))).drop("t")
    inside = Window.partitionBy("source", "bin").orderBy(
        "key", "size", F.col("doc_id").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    ranked = binned.withColumn("within", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    joined = ranked.join(placed, F.col("source").eqNullSafe(F.col("s")) & (F.col("bin") == F.col("b")))
    # one copy more while at least half of it still fits the rest
    more = (F.col("offset") + F.col("within") + F.col("size") / 2) <= F.col("rest")
    return joined.select("doc_id", "size", "source", "source_size", "target",
                         (F.col("size") * (F.col("epochs") + more.cast("bigint"))).cast("bigint").alias("taken"))
