"""Spelling variants: words one inserted, deleted or replaced code point apart.

The search runs on bit sets over vocabulary words.  A position index holds, for
each (position, letter), the set of words with that letter there, one bit a word.
A query walks its letters once and keeps four sets: the words equal so far, and
those one replaced, inserted or deleted letter off, which are compared at the
same position, one further or one before.  Every step is a handful of operations
on whole words of bits, whatever the number of candidates (Python's integers are
the bit sets).

One index over the whole vocabulary would make the work quadratic in it.  Two
near words, the longer of l letters, agree in their first l // 2 letters or in
their last l // 2.  So the vocabulary is dealt by (l, half of the word), each word
to four groups, and a pair is counted in the group of its first half if it agrees
there, else in that of its last: once, since the walk knows which words were equal
after l // 2 letters.  A group with more words than a task should hold is dealt as
a grid: its candidates in blocks, its queries in parts, each part meets each block.

Candidates enter an index by falling count, then by code point: the lowest bit of
a result is the commonest near word.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelens.llm.frames import checkpointed, column, texts_in_small_batches

MIN_LETTERS = 5
MIN_TIMES = 3
RATIO = 2
TYPO = 97
BLOCK = 4096                         # candidates of one position index
PART = 1 << 18                       # queries that one block meets in one task
_RUN = re.compile("[A-Za-zÀ-ÿ]+")
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
_FLUSH = 1 << 17


def _lowered(run: str) -> str:
    return run.lower() if run.isascii() else run.translate(_LOWER)


def text_words(doc_id: object, text: str | None, typo: int = TYPO) -> Iterator[tuple[str, int]]:
    """(word, times) of a text: maximal letter runs with A-Z lower-cased.  Where ``typo`` divides the
    CRC-32 of ``doc_id:run``, one code point is missing (at the CRC modulo the length)."""
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode("utf-8", "surrogatepass"))
    for run, times in Counter(map(itemgetter(0), _RUN.finditer(text or ""))).items():
        word = _lowered(run)
        h = zlib.crc32(word.encode("utf-8"), start)
        if h % typo == 0:
            at = h % len(word)
            word = word[:at] + word[at + 1:]
        yield word, times


def vocabulary(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", min_letters: int = MIN_LETTERS,
               min_times: int = MIN_TIMES, typo: int = TYPO) -> DataFrame:
    """(word, n): the words of ``min_letters`` code points or more with ``min_times`` occurrences or more.

    Null texts have no words; a null id counts as empty; repeated rows count each.
    Counts are added up in the tasks before the shuffle.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: Counter[str] = Counter()

        def rows() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(totals), pa.string()), pa.array(totals.values(), pa.int64())],
                                             names=["word", "n"])
            totals.clear()
            return out

        for batch in batches:
            for key, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                for word, times in text_words(key, value.as_py(), typo):
                    if len(word) >= min_letters:
                        totals[word] += times
                if len(totals) >= _FLUSH:
                    yield rows()
        yield rows()

    texts_in_small_batches(docs.sparkSession)
    given = docs.select(column(docs, doc_id).cast("string").alias("id"), column(docs, text).alias("text"))
    return given.mapInArrow(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n")).where(
        F.col("n") >= min_times)


class PositionIndex:
    """Bit sets over the words added, in that order: by (position, letter), and by length."""

    def __init__(self) -> None:
        self.words: list[tuple[str, int]] = []
        self.at: list[dict[str, int]] = []
        self.of_length: dict[int, int] = {}

    def add(self, word: str, n: int) -> None:
        bit = 1 << len(self.words)
        self.words.append((word, n))
        while len(self.at) <= len(word):
            self.at.append({})
        for letters, letter in zip(self.at, word, strict=False):
            letters[letter] = letters.get(letter, 0) | bit
        self.of_length[len(word)] = self.of_length.get(len(word), 0) | bit

    def near(self, word: str, longest: int, first_half: bool) -> int:
        """The words one edit from ``word`` where the longer of the two has ``longest`` letters, and
        that agree in the first longest // 2 letters, or (not first_half) don't."""
        half, positions = longest // 2, len(self.at)
        equal, agree = (1 << len(self.words)) - 1, 0
        replaced = inserted = deleted = 0
        shorter = len(word) < longest        # the candidates have a letter more
        for i, letter in enumerate(word):
            here = self.at[i].get(letter, 0) if i < positions else 0
            if shorter:
                after = self.at[i + 1].get(letter, 0) if i + 1 < positions else 0
                inserted = (inserted | equal) & after
            else:
                before = self.at[i - 1].get(letter, 0) if 0 < i <= positions else 0
                deleted = deleted & before | equal
                replaced = replaced & here | equal & ~here
            equal &= here
            if i == half - 1:
                agree = equal
            if not (equal or replaced or inserted or deleted):
                return 0
        if shorter:
            found = (inserted | equal) & self.of_length.get(longest, 0)
        else:
            found = replaced & self.of_length.get(longest, 0) | deleted & self.of_length.get(longest - 1, 0)
        return found & agree if first_half else found & ~agree


def _searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by cell, a cell's candidates first -> (word, n_near, form_n, form) of its queries."""
    found: list[tuple[str, int, int, str]] = []
    cell: tuple | None = None
    index, waiting = PositionIndex(), []

    def ask(word: str, longest: int, first_half: bool) -> None:
        near = index.near(word, longest, first_half)
        if near:
            best, n = index.words[(near & -near).bit_length() - 1]
            found.append((word, near.bit_count(), n, best))

    def answer() -> None:
        if len(index.words) > 1:
            for query in waiting:
                ask(*query)
        waiting.clear()

    def rows() -> pa.RecordBatch:
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
        columns = zip(*found, strict=True) if found else ((),) * 4
        out = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                         names=["word", "n_near", "form_n", "form"])
        found.clear()
        return out

    for batch in batches:
        for longest, first_half, half, block, part, listed, asks, word, n in zip(
                *[c.to_pylist() for c in batch.columns], strict=True):
            here = (longest, first_half, half, block, part)
            if here != cell:
                answer()
                cell, index = here, PositionIndex()
            if listed:
                index.add(word, n)
                if asks:
                    waiting.append((word, longest, first_half))
            elif asks:                       # the index is complete: candidates come first
                ask(word, longest, first_half)
        yield rows()
    answer()
    yield rows()


def _dealt(words: DataFrame, block: int, part: int) -> DataFrame:
    """Every word in its cells: (longest, first_half, half, block, part) with listed (a candidate) and asks (a query)."""
    def group(longest: Column, first_half: bool) -> Column:
        size = F.floor(longest / 2).cast("int")
        letters = F.substr("word", F.lit(1), size) if first_half else F.right("word", size)
        return F.struct(longest.alias("longest"), F.lit(first_half).alias("first_half"),
                        F.xxhash64(letters).alias("half"))

    length = F.length("word")
    members = words.select("word", "n", F.explode(F.array(
        *[group(longest, side) for longest in (length, length + 1) for side in (True, False)])).alias("g")).select(
        "word", "n", "g.*")
    key = ["longest", "first_half", "half"]
    large = members.groupBy(*key).agg(F.count("*").alias("members")).where(F.col("members") > block)
    grid = members.join(large, key, "left").withColumns({
        "blocks": F.coalesce(F.ceil(F.col("members") / block), F.lit(1)).cast("int"),
        "parts": F.coalesce(F.ceil(F.col("members") / part), F.lit(1)).cast("int")})
    own = grid.withColumns({"block": F.pmod(F.xxhash64("word", F.lit(1)), "blocks").cast("int"),
                            "part": F.pmod(F.xxhash64("word", F.lit(2)), "parts").cast("int")})

    def cell(b: Column, p: Column, listed: Column, asks: bool) -> Column:
        return F.struct(b.alias("block"), p.alias("part"), listed.alias("listed"), F.lit(asks).alias("asks"))

    def upto(n: str) -> Column:
        return F.sequence(F.lit(0), F.col(n) - 1)

    asked = F.transform(upto("blocks"), lambda b: cell(b, F.col("part"), b == F.col("block"), True))
    listed = F.transform(F.filter(upto("parts"), lambda p: p != F.col("part")),
                         lambda p: cell(F.col("block"), p, F.lit(True), False))
    return own.select(*key, F.explode(F.concat(asked, listed)).alias("c"), "word", "n").select(
        *key, "c.*", "word", "n")


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the words with a form: pointers are followed and doubled until none moves.
    Counts at least double along a form, so chains are short."""
    at = checkpointed(forms.select("word", F.col("form").alias("root")))
    while True:
        onward = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = checkpointed(at.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"),
                                                                    F.col("next").isNotNull().alias("on")))
        at = moved.select("word", "root")
        if moved.where("on").isEmpty():
            return at


def group_variants(words: DataFrame, *, ratio: int = RATIO, block: int = BLOCK, part: int = PART) -> DataFrame:
    """(word, form, root, n, n_near, form_n) from distinct words with counts (word, n), words of two letters or more.

    n_near counts the words one edit away.  form is the commonest of them (equal counts: the first by
    code point) if it stands ``ratio`` times as often or more, else null; root is the end of the chain
    of forms, the word itself if it has none.  No words give no rows.
    """
    words = checkpointed(words.select("word", "n"))
    cells = ["longest", "first_half", "half", "block", "part"]
    dealt = _dealt(words, block, part).repartition(*cells).sortWithinPartitions(
        *cells, F.desc("listed"), F.desc("n"), "word")
    found = dealt.mapInArrow(_searched, "word string, n_near bigint, form_n bigint, form string")
    best = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct(
        (-F.col("form_n")).alias("less"), "form")).alias("best"))
    near = checkpointed(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
        F.when(-F.col("best.less") >= ratio * F.col("n"), F.col("best")).alias("best")).select(
        "word", F.col("best.form").alias("form"), "n", "n_near", (-F.col("best.less")).alias("form_n")))
    roots = _roots(near.where(F.col("form").isNotNull()))
    return near.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
