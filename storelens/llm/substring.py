"""Substring dedup: repeated word windows found by level-wise doubling.

A window of the asked length (35 words) can only repeat if the shorter windows
inside it repeat.  The levels double up to the asked length (18, 35): windows
that repeat at one length alone are extended to twice that length, until the
asked length is reached or no candidate survives.  Longer repeats need no level
of their own, for their 35-word windows cover the same words.

* First level.  Of all short windows inside a long one, the one with the
  smallest hash stands for it (winnowing).  Equal long windows have the same
  words, so the same representative at the same place: counting the
  representatives alone, a tenth of all positions, loses no repeat.
* Every level sends a hash and a place for each candidate and keeps, from one
  partial aggregation, the places whose hash stands once.  Those come back to
  their documents as what does *not* repeat; so a passage that a third of all
  documents share is summed up before the shuffle, and no join meets it.
* Last level.  Windows are compared by 96 bits of two independent hashes.

The texts themselves are shuffled once, by row key, and that exchange serves
both later levels.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.llm.frames import column, row_key, texts_in_small_batches
from storelens.llm.words import Rolling, mix, sliding_argmin, word_hashes

WINDOW = 35
_ROWS = 1 << 17                      # candidates sent in one Arrow batch


def _signed(hashes: np.ndarray) -> np.ndarray:
    return hashes.view(np.int64)


def level_lengths(window: int, first: int) -> list[int]:
    """Lengths of the levels: doubled back from ``window`` until ``first`` is reached."""
    lengths = [window]
    while lengths[0] > first:
        lengths.insert(0, -(-lengths[0] // 2))
    return lengths


class _Text:
    """Words of one text and the long windows that may still repeat."""

    def __init__(self, raw: bytes | None, window: int):
        self.words, self.window = (raw or b"").split(), window
        self.hashes = word_hashes(self.words) if len(self.words) >= window else np.empty(0, np.uint64)

    def representatives(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Place of the smallest short window inside each long one; the short windows' hashes."""
        short = Rolling(self.hashes).windows(length)
        return sliding_argmin(mix(short), self.window - length + 1), short

    def survivors(self, once: list[tuple[int, np.ndarray]]) -> np.ndarray:
        """Starts of the long windows none of whose representatives stands once;
        ``once``: per finished level its length and the places that stand once."""
        alive = np.ones(max(0, len(self.hashes) - self.window + 1), bool)
        for length, places in once:
            if len(alive) and len(places):
                at = np.arange(len(alive)) if length == self.window else self.representatives(length)[0]
                alive &= ~np.isin(at, places)
        return np.flatnonzero(alive)


def _batches(rows: Iterator[tuple], keys: int, names: list[str]) -> Iterator[pa.RecordBatch]:
    """(key longs ..., columns ...) per text -> Arrow batches of bounded size."""
    held: list[list[np.ndarray]] = [[] for _ in names]
    size = 0
    for row in rows:
        n = len(row[keys])
        for at in range(0, n, _ROWS):
            part = [np.full(min(_ROWS, n - at), k, np.int64) for k in row[:keys]]
            part += [c[at:at + _ROWS] for c in row[keys:]]
            for h, p in zip(held, part, strict=True):
                h.append(p)
            size += len(part[0])
            if size >= _ROWS:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(h)) for h in held], names)
                held, size = [[] for _ in names], 0
    if size:
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(h)) for h in held], names)


def _candidates(length: int, window: int, done: list[int], keys: list[str]):
    """Arrow function: texts and the places that stand once at the levels ``done``
    -> places and hashes of the candidates of this level."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            once = [batch.column(f"once{n}") for n in done]
            for i, key in enumerate(zip(*[batch.column(k).to_pylist() for k in keys], strict=True)):
                body = _Text(batch.column("raw")[i].as_py(), window)
                at = body.survivors([(n, _array(c[i].as_py())) for n, c in zip(done, once, strict=True)])
                if len(at) and length < window:
                    places, short = body.representatives(length)
                    at = np.unique(places[at])
                    yield *key, at, _signed(short[at])
                elif len(at):
                    h1, h2 = [_signed(Rolling(body.hashes, w).windows(length)[at]) for w in (0, 1)]
                    yield *key, at, h1, (h2 >> 32).astype(np.int32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(rows(batches), len(keys), [*keys, "at", "h1", "h2"][:len(keys) + 2 + (length == window)])
    return run


def _standing_once(rows: DataFrame, hashes: list[str], keys: list[str]) -> DataFrame:
    """Per text, the places whose hash stands nowhere else: one list per text, no longer
    than the text.  Of a hash that stands once the maxima are its only row."""
    single = rows.groupBy(*hashes).agg(F.count("*").alias("n"), *[F.max(c).alias(c) for c in (*keys, "at")])
    return single.where("n = 1").groupBy(*keys).agg(F.collect_list("at").alias("once"))


def dedup_substrings(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
                     window: int = WINDOW, first: int | None = None, keep_space: bool = False) -> DataFrame:
    """Every row with n_words, n_removed, kept_text and removed_spans.

    A word goes if a window of ``window`` consecutive words covers it whose words
    also start anywhere else, the same text included; windows are judged on the
    input.  kept_text joins the kept words by one space, or with ``keep_space`` is
    the text as it was without the removed words and the white space before them;
    removed_spans are word ranges [start, end).  A null text has no words and kept_text ''.  Rows that
    agree in id and text count as two texts (so they repeat each other) and give
    two rows.  Columns of the four names are replaced; ids may be null.
    """
    lengths = level_lengths(window, -(-window // 2) if first is None else first)
    names = [c for c in docs.columns if c.lower() not in ("n_words", "n_removed", "kept_text", "removed_spans")]
    texts_in_small_batches(docs.sparkSession)
    key = row_key(docs, doc_id, text)
    keys = list(key)
    # the text goes along once, as bytes
    alive = docs.select(*[column(docs, c).alias(f"c{i}") for i, c in enumerate(names) if c != text],
                        *[c.alias(k) for k, c in key.items()], column(docs, text).cast("binary").alias("raw"))
    for i, length in enumerate(lengths):
        # every level hands all columns on, so that all levels share one exchange of the texts
        hashes = ["h1", "h2"] if length == window else ["h1"]
        shape = ", ".join([*[f"{k} bigint" for k in keys], "at bigint, h1 bigint"]) + ", h2 int" * (length == window)
        found = (alive if i else alive.select(*keys, "raw")).mapInArrow(
            _candidates(length, window, lengths[:i], keys), shape)
        alive = alive.join(_standing_once(found, hashes, keys).withColumnRenamed("once", f"once{length}"), keys, "left")

    @F.pandas_udf("n_words bigint, n_removed bigint, kept_text string, "
                  "removed_spans array<struct<start:bigint,end:bigint>>")
    def cut(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        for raws, *once in batches:
            out = []
            for raw, *places in zip(raws, *once, strict=True):
                body = _Text(raw, window)
                at = body.survivors([(n, _array(p)) for n, p in zip(lengths, places, strict=True)])
                n, gone, kept, spans = _kept(body.words, at, window)
                out.append((n, gone, _cut_out(raw, spans) if keep_space else kept, spans))
            yield pd.DataFrame(out, columns=["n_words", "n_removed", "kept_text", "removed_spans"])

    judged = alive.select(*[f"c{i}" for i, c in enumerate(names) if c != text], "raw",
                          cut("raw", *[f"once{n}" for n in lengths]).alias("cut"))
    return judged.select(*[F.col("raw").cast("string").alias(c) if c == text else F.col(f"c{i}").alias(c)
                           for i, c in enumerate(names)], "cut.*")


def _array(places) -> np.ndarray:
    return np.empty(0, np.int64) if places is None else np.asarray(places, np.int64)


def _kept(words: list[bytes], starts: np.ndarray, window: int) -> tuple:
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + window, -1)
    gone = np.cumsum(edge[:-1]) > 0
    turns = np.flatnonzero(np.diff(np.concatenate(([0], gone.astype(np.int8), [0])))).tolist()
    spans = [{"start": a, "end": b} for a, b in zip(turns[::2], turns[1::2], strict=True)]
    kept = words if not spans else [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
    return len(words), int(gone.sum()), b" ".join(kept).decode("utf-8", "replace"), spans


def _cut_out(raw: bytes | None, spans: list[dict[str, int]]) -> str:
    """The text without the given word ranges and the white space before each word."""
    raw, at, out = raw or b"", 0, []
    if spans:
        ends = [m.end() for m in re.finditer(rb"[^\x20\x09-\x0D]+", raw)]
        for span in spans:
            out.append(raw[at:ends[span["start"] - 1] if span["start"] else 0])
            at = ends[span["end"] - 1]
    return b"".join([*out, raw[at:]]).decode("utf-8", "replace")
