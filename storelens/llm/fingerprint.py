"""Document fingerprints: one-permutation MinHash with optimal densification.

Each 5-word shingle of a text is hashed once; the hash's top byte is its bin, and
every one of the 256 bins keeps its smallest hash.  An empty bin borrows from the
first filled bin on a walk of its own: a full cycle through all bins with a start
and an odd stride made from the bin's number, the same in every text (optimal
densification, Shrivastava 2017).  Of each bin the lowest four bits stay, one hex
digit, so a fingerprint is 256 hex digits.  Two texts of Jaccard similarity J agree
in a share J + (1 - J) / 16 of the digits, which ``likeness`` corrects for.

DataFrame functions only: all steps are array expressions on the text's own row.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelens.llm.frames import column, free_name
from storelens.llm.neighbours import with_next
from storelens.llm.words import mix

SHINGLE = 5
BINS = 256
BITS = 4
PROBES = 8                           # steps of the walk before it is solved directly
_REST = (1 << 56) - 1                # a hash without its bin
_SPACE = "\x20\x09\x0a\x0b\x0c\x0d"


def walks() -> tuple[list[int], list[int], list[int]]:
    """Per bin: start, odd stride, and the stride's inverse modulo BINS."""
    noise = [int(x) for x in mix(np.arange(1, BINS + 1, dtype=np.uint64))]
    starts = [x >> 8 & 255 for x in noise]
    strides = [x >> 16 & 255 | 1 for x in noise]
    return starts, strides, [pow(s, -1, BINS) for s in strides]


def words(text: Column) -> Column:
    bare = F.trim(F.coalesce(text, F.lit("")), F.lit(_SPACE))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, r"[\x20\x09-\x0D]+"))


def with_fingerprint(df: DataFrame, text: str, name: str) -> DataFrame:
    """Add the fingerprint of ``text``: 256 hex digits; '' if the text is null or has no word.

    A text of one to four words is one shingle.
    """
    given, whole, lowest, digit, filled = free_name(df, "w", "h", "m", "d", "f")
    start, stride, inverse = (F.array(*map(F.lit, x)) for x in walks())
    w = F.col(given)
    shingles = F.when(F.size(w) == 0, F.array().cast("array<bigint>")) \
        .when(F.size(w) < SHINGLE, F.array(F.xxhash64(w))) \
        .otherwise(F.transform(F.slice(w, 1, F.greatest(F.size(w) - SHINGLE + 1, F.lit(0))), lambda x, i: F.xxhash64(
            x, *[F.get(w, i + k) for k in range(1, SHINGLE)])))
    # with the largest hash of each bin put in, every bin has a smallest one
    largest = F.array(*[F.lit((b << 56) | _REST) for b in range(-BINS // 2, BINS // 2)])
    h = F.col(whole)
    bin_of = F.shiftright
    firsts = F.filter(h, lambda x, i: (i == 0) | (bin_of(x, 56) != bin_of(F.get(h, i - 1), 56)))
    digits = F.transform(F.col(lowest), lambda x: F.when(x.bitwiseAND(F.lit(_REST)) != _REST,
                                                         x.bitwiseAND(F.lit((1 << BITS) - 1)).cast("int")))
    d, f = F.col(digit), F.col(filled)

    def place(b: Column, t: int) -> Column:
        return (F.get(start, b) + F.get(stride, b) * t) % BINS

    def solved(b: Column) -> Column:
        """The digit of the filled bin that bin b's walk reaches first."""
        steps = F.transform(f, lambda e: F.pmod((F.shiftright(e, BITS) - F.get(start, b)) * F.get(inverse, b), F.lit(BINS))
                            * (1 << BITS) + e.bitwiseAND(F.lit((1 << BITS) - 1)))
        return F.array_min(steps).bitwiseAND(F.lit((1 << BITS) - 1))

    dense = F.transform(d, lambda x, b: F.coalesce(x, *[F.get(d, place(b, t)) for t in range(PROBES)], solved(b)))
    spelled = F.array_join(F.transform(dense, lambda x: F.lower(F.hex(x))), "")
    return df.withColumn(given, F.transform(words(F.col(text)), lambda x: F.xxhash64(x))) \
        .withColumn(whole, F.sort_array(F.concat(shingles, largest))) \
        .withColumn(lowest, firsts).withColumn(digit, digits) \
        .withColumn(filled, F.filter(F.transform(d, lambda x, b: b * (1 << BITS) + x), lambda e: e.isNotNull())) \
        .withColumn(name, F.when(F.size(F.col(given)) == 0, F.lit("")).otherwise(spelled)) \
        .drop(given, whole, lowest, digit, filled)


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of two fingerprints, 0 to 1; two empty texts are equal,
    an empty and another text have nothing in common."""
    same = F.size(F.filter(F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: x == y), lambda e: e)) / BINS
    chance = 1.0 / (1 << BITS)
    corrected = F.greatest(F.lit(0.0), (same - chance) / (1 - chance))
    return F.when(a == b, F.lit(1.0)).when((a == "") | (b == ""), F.lit(0.0)).otherwise(corrected)


def with_edited(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text, n_chars, fingerprint, edited, edited_fingerprint, near_edited, near_next).

    edited: the text with its last floor(n_chars / 2) code points replaced by the
    first as many (or all) of the next document's, by ascending doc_id (null
    first; rows of one id by a hash of their text); after the last row comes the
    first.  A null text is empty.
    """
    own = docs.select(column(docs, doc_id).alias("doc_id"), F.coalesce(column(docs, text), F.lit("")).alias("text"))
    own = with_fingerprint(own, "text", "fingerprint").withColumn("tie", F.xxhash64("text"))
    paired = with_next(own, "doc_id", "tie", {"next_text": "text", "next_fingerprint": "fingerprint"})
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = paired.withColumn("n_chars", F.length("text").cast("bigint")).withColumn("edited", F.concat(
        F.substring("text", F.lit(1), (F.col("n_chars") - half).cast("int")), F.substring("next_text", F.lit(1), half)))
    done = with_fingerprint(edited, "edited", "edited_fingerprint")
    return done.select("doc_id", "text", "n_chars", "fingerprint", "edited", "edited_fingerprint",
                       likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
                       likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"))
