"""Benchmark decontamination: size-partitioned MinHash containment search.

A test item is short and a document long, so their Jaccard similarity says
little.  The search therefore works by size, as in LSH Ensemble (Zhu et al.):
items are parted into classes by their number of words, and for a class of up to
Q words a document is cut into blocks of 2Q words that overlap by Q, so any
passage of up to Q words lies whole in one block.  Between an item of that class
and the block that contains it the Jaccard similarity has a lower bound, and from
it follows the number of hash functions the class needs to miss such a block
with probability under MISS.  A block whose minimum agrees with an item's under
any of them makes the document a candidate for that item.  Items of so few distinct
shingles for their length that they would need more than MAX_FUNCTIONS are looked up
exactly, shingle by shingle, so one repetitive item does not raise the number for all.

Every candidate is verified: the share of the item's distinct shingles that occur
anywhere in the whole document must reach the threshold.

A benchmark of up to SLICE_CHARS characters (checked before) is one index, broadcast to
the tasks, and documents are read once.  A larger one stays in DataFrames: items and
blocks give keys of (class, function, minimum), and candidates are their join.  What
the driver gets then is the list of size classes and a bit map of the items' keys,
of 2**SIEVE bits whatever their number, by which tasks leave out the keys of
blocks that no item has.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.llm.frames import checkpointed, column, free_name, texts_in_small_batches
from storelens.llm.words import Rolling, mix, plain_words, shingle_hashes, word_hashes

SHINGLE = 5
THRESHOLD = 0.8
MISS = 1e-7
MAX_FUNCTIONS = 128
SLICE_CHARS = 8_000_000
GRANULE = 4                          # block edges are multiples of so many words
_CHUNK = 1 << 13                     # words whose minima are taken at a time
_SIEVE_BITS = 20
SIEVE = 26
TOGETHER = 1000                      # candidates of one text that one row verifies


def size_classes(longest: int) -> list[int]:
    """Upper bounds 8, 12, 16, 24, 32, 48, ... up to ``longest`` words."""
    out = [8]
    while out[-1] < longest:
        out.append(out[-1] * 3 // 2 if out[-1] & (out[-1] - 1) == 0 else out[-1] * 4 // 3)
    return out


def hash_count(least: int, upper: int, threshold: float, shingle: int) -> int:
    """Hash functions for a class whose items have ``least`` shingles or more and ``upper`` words or fewer."""
    shared = max(1, int(np.ceil(threshold * least)))
    similarity = min(0.999, shared / (2 * upper + least - shared))
    return int(np.ceil(np.log(MISS) / np.log1p(-similarity)))


def lower_words(text: str | None) -> list[bytes]:
    return plain_words((text or "").lower())


class ItemIndex:
    """Signatures of one slice of items: per size class a sorted table of minima, and one
    sorted table of the shingles of repetitive items."""

    def __init__(self, ids: list, texts: list[str | None], shingle: int, threshold: float):
        self.ids, self.shingle, self.threshold = ids, shingle, threshold
        words = [word_hashes(lower_words(t)) for t in texts]
        self.sets = [np.unique(shingle_hashes(w, shingle)) for w in words]
        self.short: dict[int, dict[int, list[int]]] = {}
        groups: dict[int, list[int]] = {}
        bounds = size_classes(max(map(len, words), default=0))
        repetitive: list[int] = []
        for i, w in enumerate(words):
            if len(w) >= shingle:
                upper = bounds[int(np.searchsorted(bounds, len(w)))]
                if hash_count(len(self.sets[i]), upper, threshold, shingle) > MAX_FUNCTIONS:
                    repetitive.append(i)
                else:
                    groups.setdefault(upper, []).append(i)
            elif len(w):
                self.short.setdefault(len(w), {}).setdefault(int(self.sets[i][0]), []).append(i)
        values = np.concatenate([self.sets[i] for i in repetitive] or [np.empty(0, np.uint64)])
        owner = np.repeat(np.array(repetitive, np.int64), [len(self.sets[i]) for i in repetitive])
        order = np.argsort(values, kind="stable")
        self.exact = values[order], owner[order], self._sieve(values)
        self.classes = []
        most = 0
        for upper, members in sorted(groups.items()):
            count = hash_count(min(len(self.sets[i]) for i in members), upper, threshold, shingle)
            most = max(most, count)
            self.classes.append((upper, count, members))
        # odd multipliers permute the 64-bit hashes
        self.odd = mix(np.arange(1, most + 1, dtype=np.uint64)) | np.uint64(1)
        self.tables = []
        for upper, count, members in self.classes:
            minima = np.stack([(self.sets[i][:, None] * self.odd[:count]).min(axis=0) for i in members])
            owner = np.repeat(np.array(members), count)
            order = np.argsort(minima.ravel(), kind="stable")
            self.tables.append((upper, count, minima.ravel()[order], owner[order], self._sieve(minima.ravel())))

    @staticmethod
    def _sieve(values: np.ndarray) -> np.ndarray:
        sieve = np.zeros(1 << _SIEVE_BITS, bool)
        sieve[values >> np.uint64(64 - _SIEVE_BITS)] = True
        return sieve

    def _repetitive(self, shingles: np.ndarray) -> set[int]:
        """The repetitive items of whose shingles the threshold or more are there."""
        values, owner, sieve = self.exact
        if not len(values):
            return set()
        there = np.unique(shingles[sieve[shingles >> np.uint64(64 - _SIEVE_BITS)]])
        lo, hi = np.searchsorted(values, there, "left"), np.searchsorted(values, there, "right")
        times = hi - lo
        at = np.arange(times.sum()) + np.repeat(lo - (np.cumsum(times) - times), times)
        items, shared = np.unique(owner[at], return_counts=True)
        return {i for i, n in zip(items.tolist(), shared.tolist(), strict=True) if n >= self.threshold * len(self.sets[i])}

    def _candidates(self, shingles: np.ndarray) -> set[int]:
        found = self._repetitive(shingles)
        if not self.tables:
            return found
        longest = max((upper for upper, *_ in self.tables), default=0)
        step = max(_CHUNK, 4 * longest)
        step -= step % GRANULE
        for at in range(0, len(shingles), step):
            # a chunk carries on for one block of the largest class, so no block is cut
            part = shingles[at:at + step + 2 * longest]
            minima = np.minimum.reduceat(part[:, None] * self.odd, np.arange(0, len(part), GRANULE), axis=0)
            for upper, count, values, owner, sieve in self.tables:
                half = np.minimum.reduceat(minima[:, :count], np.arange(0, len(minima), upper // GRANULE), axis=0)
                block = np.minimum(half[:-1], half[1:]) if len(half) > 1 else half
                hit = block[sieve[block >> np.uint64(64 - _SIEVE_BITS)]]
                lo, hi = np.searchsorted(values, hit, "left"), np.searchsorted(values, hit, "right")
                for a, b in zip(lo[hi > lo], hi[hi > lo], strict=True):
                    found.update(owner[a:b].tolist())
        return found

    def _verified(self, shingles: np.ndarray, some: Iterable[int]) -> Iterator[tuple[int, float, int]]:
        for i in some:
            shared = int(np.isin(self.sets[i], shingles).sum())
            if shared >= self.threshold * len(self.sets[i]):
                yield i, shared / len(self.sets[i]), shared

    def verify(self, text: str | None, some: Iterable[int]) -> list[tuple]:
        """As ``contained``, for the items of these numbers alone, whatever their signatures say."""
        hashes = word_hashes(lower_words(text))
        short = {i: n for n, items in self.short.items() for found in items.values() for i in found}
        out = []
        for i in some:
            n = short.get(i, self.shingle)
            if len(self.sets[i]) and n <= len(hashes):
                out += self._verified(np.unique(Rolling(hashes).windows(n)) if n < self.shingle
                                      else shingle_hashes(hashes, self.shingle), [i])
        return [(self.ids[i], c, n) for i, c, n in out]

    def contained(self, text: str | None) -> list[tuple]:
        """(item id, containment, shared shingles) of every item found in the text."""
        hashes = word_hashes(lower_words(text))
        if not len(hashes):
            return []
        out = []
        if (self.tables or len(self.exact[0])) and len(hashes) >= self.shingle:
            shingles = shingle_hashes(hashes, self.shingle)
            out += self._verified(shingles, self._candidates(shingles))
        for length, items in self.short.items():
            if length <= len(hashes):
                for h in set(Rolling(hashes).windows(length).tolist()) & items.keys():
                    out += [(i, 1.0, 1) for i in items[h]]
        return [(self.ids[i], c, n) for i, c, n in sorted(out)]


# The classes of the search by joins go by an item's size alone, so that no item depends on the others.
_SHORT, _EXACT = 1, 2


def _salts(upper: int, count: int) -> np.ndarray:
    return mix((np.uint64(upper) << np.uint64(20)) + np.arange(1, count + 1, dtype=np.uint64))


def _odd(count: int) -> np.ndarray:
    return mix(np.arange(1, count + 1, dtype=np.uint64)) | np.uint64(1)


def item_keys(text: str | None, shingle: int, threshold: float) -> tuple[int, int, np.ndarray]:
    """(class, number of functions, keys) of an item.  class is the upper bound of its words, or tells that
    its distinct shingles are keys themselves: of a repetitive item, or the one of a short item (then the
    number is its length)."""
    words = word_hashes(lower_words(text))
    found = np.unique(shingle_hashes(words, shingle))
    if len(words) < shingle:
        return _SHORT, len(words), mix(found ^ _salts(_SHORT, 1 + len(words))[-1])
    upper = size_classes(len(words))[-1]
    bounds = [1, 2, 3, 4, 6, *size_classes(len(found))]
    least = max(b for b in bounds if b <= len(found))
    count = hash_count(least, upper, threshold, shingle)
    if count > MAX_FUNCTIONS:
        return _EXACT, 0, mix(found ^ _salts(_EXACT, 1)[0])
    return upper, count, mix((found[:, None] * _odd(count)).min(axis=0) ^ _salts(upper, count))


class Sieve:
    """Which keys of a text an item may have: the classes there are and a bit map of all items' keys."""

    def __init__(self, classes: dict[int, int], shorts: list[int], exact: bool, bits: np.ndarray, shingle: int):
        self.classes, self.shorts, self.exact, self.bits, self.shingle = classes, shorts, exact, bits, shingle

    def _there(self, keys: np.ndarray) -> np.ndarray:
        at = keys >> np.uint64(64 - SIEVE)
        return keys[(self.bits[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1]

    def keys(self, text: str | None) -> np.ndarray:
        words = word_hashes(lower_words(text))
        out = [self._there(mix(Rolling(words).windows(n) ^ _salts(_SHORT, 1 + n)[-1]))
               for n in self.shorts if 0 < n <= len(words)]
        if len(words) >= self.shingle:
            shingles = shingle_hashes(words, self.shingle)
            if self.exact:
                out.append(self._there(mix(shingles ^ _salts(_EXACT, 1)[0])))
            if self.classes:
                out += self._minima(shingles)
        return np.unique(np.concatenate(out)) if out else np.empty(0, np.uint64)

    def _minima(self, shingles: np.ndarray) -> Iterator[np.ndarray]:
        odd, longest = _odd(max(self.classes.values())), max(self.classes)
        step = max(_CHUNK, 4 * longest)
        step -= step % GRANULE
        for at in range(0, len(shingles), step):
            # a chunk carries on for one block of the largest class, so no block is cut
            part = shingles[at:at + step + 2 * longest]
            minima = np.minimum.reduceat(part[:, None] * odd, np.arange(0, len(part), GRANULE), axis=0)
            for upper, count in self.classes.items():
                half = np.minimum.reduceat(minima[:, :count], np.arange(0, len(minima), upper // GRANULE), axis=0)
                block = np.minimum(half[:-1], half[1:]) if len(half) > 1 else half
                yield np.unique(self._there(mix(block ^ _salts(upper, count)).ravel()))


def _sieve(signed: DataFrame, shingle: int) -> Sieve:
    """From (class, functions, key): the classes and a bit map reach the driver."""
    kinds = signed.groupBy("class").agg(F.max("functions").alias("most"), F.collect_set("functions").alias("all")).collect()
    place = F.shiftrightunsigned("key", 64 - SIEVE)
    words = signed.groupBy(F.shiftright(place, 6).cast("int").alias("word")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned(key, {64 - SIEVE}) & 63 as int))")).alias("bits")).toArrow()
    bits = np.zeros(1 << (SIEVE - 6), np.uint64)
    bits[words.column(0).to_numpy()] = words.column(1).to_numpy().view(np.uint64)
    return Sieve({r["class"]: r.most for r in kinds if r["class"] > _EXACT},
                 sorted(n for r in kinds if r["class"] == _SHORT for n in r["all"]),
                 any(r["class"] == _EXACT for r in kinds), bits, shingle)


def _find_by_joins(docs: DataFrame, items: DataFrame, text: str, shingle: int, threshold: float) -> DataFrame:
    """(t1, t2, items) for the texts that contain items; t1 and t2 are two hashes of a text.

    Equal texts are one, and so are equal items, which are listed as often as they stand.  A text's
    candidates are verified TOGETHER at a time, so that a text with very many is no single row.
    """
    spark = docs.sparkSession
    one = items.groupBy("item_id", "t").agg(F.count("*").alias("times")).withColumn(
        "i", F.xxhash64(F.col("item_id").isNull(), "item_id", F.col("t").isNull(), "t"))

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(i, *item_keys(t, shingle, threshold)) for i, t in zip(batch["i"], batch["t"], strict=True)]
            yield pd.DataFrame([(i, c, n, k) for i, c, n, keys in rows for k in keys.view(np.int64).tolist()],
                               columns=["i", "class", "functions", "key"])

    one = checkpointed(one)
    signed = checkpointed(one.select("i", "t").mapInPandas(sign, "i bigint, class int, functions int, key bigint"))
    sieve = spark.sparkContext.broadcast(_sieve(signed, shingle))
    whole = docs.select(column(docs, text).alias("text")).where("text is not null").select(
        F.xxhash64("text").alias("t1"), F.xxhash64(F.lit(1), "text").alias("t2"), "text")

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keys = [sieve.value.keys(t).view(np.int64) for t in batch["text"]]
            times = [len(k) for k in keys]
            yield pd.DataFrame({"t1": np.repeat(batch["t1"].to_numpy(), times), "t2": np.repeat(batch["t2"].to_numpy(), times),
                                "key": np.concatenate([*keys, np.empty(0, np.int64)])})

    ids = ["t1", "t2"]
    met = whole.mapInPandas(emit, "t1 bigint, t2 bigint, key bigint").distinct().join(signed.select("i", "key"), "key")
    candidates = checkpointed(met.select(*ids, "i").distinct())
    many = candidates.groupBy(*ids).agg(F.ceil(F.count("*") / TOGETHER).alias("parts"))
    listed = candidates.join(many, ids).join(one.select("i", "t"), "i").groupBy(
        *ids, F.pmod(F.xxhash64("i"), F.col("parts")).alias("part")).agg(
        F.collect_list(F.struct("i", "t")).alias("wanted"))
    texts = whole.join(many.select(*ids), ids, "left_semi").groupBy(*ids).agg(F.first("text").alias("text"))

    @F.pandas_udf("array<struct<i:bigint,containment:double,n_shared:bigint>>")
    def verified(texts: pd.Series, wanted: pd.Series) -> pd.Series:
        out = []
        for value, some in zip(texts, wanted, strict=True):
            index = ItemIndex([w["i"] for w in some], [w["t"] for w in some], shingle, threshold)
            out.append([{"i": i, "containment": c, "n_shared": n} for i, c, n in index.verify(value, range(len(some)))])
        return pd.Series(out, dtype=object)

    held = listed.join(texts, ids).select(*ids, F.explode(verified("text", "wanted")).alias("v")).select(*ids, "v.*")
    each = held.join(one.select("i", "item_id", "t", "times"), "i").withColumn(
        "again", F.explode(F.sequence(F.lit(1), F.col("times"))))
    row = F.struct(F.col("item_id").isNull().alias("z"), "item_id", F.coalesce("t", F.lit("")).alias("t"),
                   F.struct("item_id", "containment", "n_shared").alias("row"))
    return each.groupBy(*ids).agg(F.transform(F.sort_array(F.collect_list(row)), lambda r: r["row"]).alias("items"))


def _search(shared: Broadcast, shape: str):
    @F.pandas_udf(shape)
    def contained(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for rows in batches:
            yield pd.Series([[{"item_id": i, "containment": c, "n_shared": n}
                              for i, c, n in shared.value.contained(t)] for t in rows], dtype=object)

    return contained


def find_items(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", item_id: str = "item_id",
               item_text: str = "text", shingle: int = SHINGLE, threshold: float = THRESHOLD,
               into: str = "items") -> DataFrame:
    """Add ``items`` (or ``into``): array of (item_id, containment, n_shared) of every benchmark item
    of whose distinct shingles the document holds ``threshold`` or more.

    Words ignore case and ASCII punctuation.  An item of fewer words than a
    shingle is one shingle of its own length: found where its words stand
    consecutively.  Items and documents without a word (null texts too) match
    nothing.  Repeated items are listed each.  A column ``items`` is replaced.
    """
    spark = docs.sparkSession
    texts_in_small_batches(spark)
    kind = benchmark.schema[item_id].dataType.simpleString()
    names = [c for c in docs.columns if c.lower() != into.lower()]
    items = benchmark.select(column(benchmark, item_id).alias("item_id"), column(benchmark, item_text).alias("t"))
    shape = f"array<struct<item_id:{kind},containment:double,n_shared:bigint>>"
    if (items.agg(F.sum(F.length("t") + 16)).first()[0] or 0) <= SLICE_CHARS:
        rows = sorted(items.collect(), key=lambda r: (r.item_id is None, r.item_id, r.t or ""))
        index = spark.sparkContext.broadcast(ItemIndex([r.item_id for r in rows], [r.t for r in rows], shingle, threshold))
        return docs.select(*[column(docs, c) for c in names], _search(index, shape)(column(docs, text)).alias(into))
    found = _find_by_joins(docs, items, text, shingle, threshold)
    t1, t2, hits = free_name(docs, "t1", "t2", "hits")
    own = docs.withColumns({t1: F.xxhash64(column(docs, text)), t2: F.xxhash64(F.lit(1), column(docs, text))})
    joined = own.join(found.select(F.col("t1").alias(t1), F.col("t2").alias(t2), F.col("items").alias(hits)), [t1, t2], "left")
    return joined.select(*[f"`{c}`" for c in names], F.coalesce(hits, F.array().cast(shape)).alias(into))


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents that contain no benchmark item, unchanged."""
    (held,) = free_name(docs, "items")
    return find_items(docs, benchmark, into=held, **options).where(F.size(held) == 0).select(
        *[f"`{c}`" for c in docs.columns])
