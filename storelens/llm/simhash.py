"""SimHash near-duplicates found by pigeonring filtering.

A fingerprint's 64 bits are a ring of four 16-bit segments.  If two fingerprints
differ in at most 3 bits, some segment starts a chain whose cumulative
differences stay within the proportional budgets 0.75, 1.5, 2.25 and 3: at most
0, 1, 2 and 3 bits after one, two, three and four segments (the pigeonring
principle, Qin and Xiao).  Candidates are pairs that meet the first two links of
the chain, found by an equi-join: one side offers each pair of neighbouring
segments, the other the same and every value one bit away in the second.  The
rest of the chain prunes before the full Hamming check.

Where more than ``hot`` fingerprints share one pair of segments, the chain's
third link goes into the join key as well; at most 2**16 different fingerprints
then share a key, so work per fingerprint is bounded at any corpus size, and no
link is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelens.llm.components import components
from storelens.llm.frames import checkpointed, column, free_name, texts_in_small_batches

SHINGLE = 3
MAX_BITS = 3
SEED = 42
HOT = 512

# Of each byte value, its eight bits (highest first) as eight one-byte counters in a
# long: up to 255 such longs add up without one counter running over into the next.
_LANES = np.array([sum((b >> (7 - i) & 1) << (8 * i) for i in range(8)) for b in range(256)], np.uint64)


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """Signed 64 bits: bit set where over half of the shingle hashes set it; no word: 0."""
    words = (text or b"").lower().split()          # bytes.lower() folds A-Z alone
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    n = max(1, len(words) - shingle + 1)
    lows = np.concatenate(([0], ends[:-1] + 1))[:n].tolist()
    highs = ends[min(shingle, len(words)) - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(line[a:b], SEED) for a, b in zip(lows, highs, strict=True)),
                         dtype=">u8", count=n)
    lanes = _LANES[hashes.view(np.uint8).reshape(-1, 8)]
    sums = np.add.reduceat(lanes, np.arange(0, n, 255), axis=0)
    ones = sums.view(np.uint8).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big", signed=True)


def fingerprint_column(text: Column, shingle: int = SHINGLE) -> Column:
    @F.pandas_udf("bigint")
    def fingerprints(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")

    return fingerprints(text.cast("binary"))


def hex_digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _segment(name: str, ring: str, i: int) -> str:
    return f"(shiftrightunsigned({name}, 48 - 16 * cast(({ring} + {i}) % 4 as int)) & 65535)"


def _offers(fps: DataFrame) -> DataFrame:
    """Four rows a fingerprint: ring start r and the values of its first three segments."""
    rows = fps.select("fp", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("r"))
    return rows.select("fp", "r", *[F.expr(_segment("fp", "r", i)).cast("int").alias(f"s{i}") for i in range(3)])


def _two(rows: DataFrame, second: Column) -> Column:
    """Ring start and two segments in one long."""
    return (F.col("r").cast("bigint") * (1 << 32) + F.col("s0").cast("bigint") * (1 << 16) + second.cast("bigint"))


def _set_bits_free(value: str) -> str:
    """The value and every value with one more bit set: of two values one bit apart,
    the one that lacks the bit offers the other."""
    return (f"concat(array({value}), transform(filter(sequence(0, 15), j -> shiftright({value}, j) & 1 = 0), "
            f"j -> {value} | shiftleft(1, j)))")


def _within_chain(pairs: DataFrame, max_bits: int) -> DataFrame:
    x = "(p.fp ^ q.fp)"
    bits = [f"bit_count({_segment(x, 'p.r', i)})" for i in range(4)]
    return pairs.where(F.expr(f"{bits[0]} = 0 and {bits[0]} + {bits[1]} <= 1 "
                              f"and {bits[0]} + {bits[1]} + {bits[2]} <= 2")).where(
        F.expr(f"bit_count({x}) between 1 and {max_bits}")).select(
        F.expr("greatest(p.fp, q.fp)").alias("a"), F.expr("least(p.fp, q.fp)").alias("b"))


def links(fps: DataFrame, *, max_bits: int = MAX_BITS, hot: int = HOT) -> DataFrame:
    """(a, b), a > b: all pairs of the distinct longs in ``fp`` at 1 to ``max_bits`` differing bits.

    ``max_bits`` is at most 3, for which the four segments' budgets are made.
    """
    if not 0 <= max_bits <= 3:
        raise ValueError("max_bits: 0 to 3")
    offers = _offers(fps)
    crowded = checkpointed(offers.select(_two(offers, F.col("s1")).alias("key")).groupBy("key")
                           .agg(F.count("*").alias("n")).where(F.col("n") > hot).select("key"))
    held = offers.withColumn("key", _two(offers, F.col("s1")))
    asked = offers.withColumn("t1", F.explode(F.expr(_set_bits_free("s1"))))
    asked = asked.withColumn("key", _two(asked, F.col("t1")))
    if crowded.isEmpty():
        pairs = asked.select("key", "fp", "r").alias("p").join(held.select("key", "fp").alias("q"), "key")
        return _within_chain(pairs, max_bits).distinct()
    plain = asked.join(crowded, "key", "left_anti").select("key", "fp", "r").alias("p").join(
        held.join(crowded, "key", "left_anti").select("key", "fp").alias("q"), "key")
    # crowded keys: the third segment too, up to the two bits that the chain still allows;
    # here both sides offer, as a third segment may gain a bit and lose another
    near = F.expr("""concat(array(s2), transform(sequence(0, 15), j -> s2 ^ shiftleft(1, j)),
        case when t1 = s1 then transform(sequence(0, 119), j -> s2 ^ element_at(pairs, j + 1)) else array() end)""")
    masks = [(1 << i) | (1 << j) for i in range(16) for j in range(i)]
    third = asked.join(crowded, "key", "left_semi").withColumn("pairs", F.array(*map(F.lit, masks)))
    third = third.withColumn("t2", F.explode(near)).select("key", F.col("t2").alias("s2"), "fp", "r").alias("p").join(
        held.join(crowded, "key", "left_semi").select("key", "s2", "fp").alias("q"), ["key", "s2"])
    return _within_chain(plain, max_bits).unionAll(_within_chain(third, max_bits)).distinct()


def near_duplicates(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                    max_bits: int = MAX_BITS, hot: int = HOT, keep_text: bool = True) -> DataFrame:
    """Every row with fingerprint (16 hex digits), component_id and near_group.

    component_id is the smallest doc_id that links of at most ``max_bits`` bits
    reach (null if all of them are null); near_group, the smallest fingerprint of
    the component, tells components apart whatever the ids.  Texts without a word
    have fingerprint zero and are linked like any other.  Other columns pass;
    columns of these three names are replaced.  Without ``keep_text`` the text is
    left out, and the slim rows are written once instead of fingerprinted twice.
    """
    if shingle < 1:
        raise ValueError("shingle: at least 1")
    names = [c for c in docs.columns if c.lower() not in ("fingerprint", "component_id", "near_group")]
    texts_in_small_batches(docs.sparkSession)
    fp, root, low = free_name(docs, "fp", "root", "low")
    keyed = docs.select(*[column(docs, c) for c in names],
                        fingerprint_column(column(docs, text), shingle).alias(fp))
    if not keep_text:
        names.remove(text)
        keyed = checkpointed(keyed.drop(column(keyed, text)))
    found = checkpointed(keyed.groupBy(F.col(fp).alias("fp")).agg(F.min(column(keyed, doc_id)).alias("low")))
    tree = components(links(found.select("fp"), max_bits=max_bits, hot=hot))
    rooted = found.join(tree.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "low", F.coalesce("root", "fp").alias("root"))
    lowest = rooted.groupBy("root").agg(F.min("low").alias("low"))
    classes = checkpointed(rooted.select("fp", "root").join(lowest, "root").select(
        F.col("fp").alias(fp), F.col("root").alias(root), F.col("low").alias(low)))
    return keyed.join(classes, fp).select(
        *[f"`{c}`" for c in names], hex_digits(F.col(fp)).alias("fingerprint"),
        F.col(low).alias("component_id"), F.col(root).alias("near_group"))


def one_of_each(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with one row of each near-duplicate group: the smallest id
    (nulls last), then the smallest row by its other columns."""
    names = docs.columns
    grouped = near_duplicates(docs, doc_id=doc_id, text=text)
    rank = [column(grouped, doc_id).isNull().alias("a"), column(grouped, doc_id).alias("b")]
    row = F.struct(*rank, *[column(grouped, c).alias(f"c{i}") for i, c in enumerate(names)])
    kept = grouped.groupBy("near_group").agg(F.min(row).alias("kept"))
    return kept.select(*[F.col(f"kept.c{i}").alias(c) for i, c in enumerate(names)])
