"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts every n-gram of every labelled text in one distributed pass:
each task keeps one count vector per language and Spark adds them up.  What
reaches the driver is languages x BUCKETS numbers, whatever the corpus size; the
matrix of log-probabilities made from it is broadcast; tasks count the n-grams of
several texts into one sparse matrix, whose product with it in numpy scores them.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelens.llm.frames import checkpointed, column, free_name, texts_in_small_batches

ORDERS = (2, 3)            # lengths of the n-grams; a word's edge counts as one character
BUCKETS = 1 << 15
SMOOTHING = 0.5
MAX_LANGUAGES = 500        # the broadcast matrix has at most MAX_LANGUAGES x BUCKETS doubles
UNKNOWN = "und"

BATCH = 1 << 20            # counters, or n-grams, of texts that are scored together
_SLICE = 1 << 16
_letters: np.ndarray | None = None


def _is_letter(codes: np.ndarray) -> np.ndarray:
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)
    return _letters[codes]


def ngram_buckets(text: str | None) -> np.ndarray:
    """Bucket of each n-gram of the lower-cased text; empty if it has no letter.

    Every run of other characters than letters, and either end, is one edge (0).
    """
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
    letter = _is_letter(codes)
    if not letter.any():
        return np.empty(0, np.int64)
    codes = np.concatenate(([0], np.where(letter, codes, 0), [0])).astype(np.uint64)
    codes = codes[np.concatenate(([True], (codes[1:] != 0) | (codes[:-1] != 0)))]
    out = []
    for n in ORDERS:
        count = len(codes) - n + 1
        if count > 0:
            key = np.full(count, n, np.uint64)
            for i in range(n):
                key = key * np.uint64(0x9E3779B97F4A7C15) + codes[i:i + count]
            key = (key ^ (key >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            out.append((key >> np.uint64(32)).astype(np.int64) % BUCKETS)
    return np.concatenate(out)


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    prior: np.ndarray                # log share of the learned documents, by language
    log_prob: np.ndarray             # BUCKETS x languages

    def predict(self, text: str | None) -> tuple[str, float]:
        return self.predict_all([text])[0]

    def predict_all(self, texts: Iterable[str | None]) -> list[tuple[str, float]]:
        """Language and posterior of each text.  The n-grams of up to BATCH characters are counted into
        one sparse matrix (text, bucket), which meets the log-probabilities in one product."""
        out: list[tuple[str, float]] = []
        waiting: list[np.ndarray] = []
        for text in texts:
            if waiting and (len(waiting) + 1) * BUCKETS > BATCH or sum(map(len, waiting)) > BATCH:
                out += self._scored(waiting)
                waiting = []
            waiting.append(ngram_buckets(text))
        return out + self._scored(waiting)

    def _scored(self, found: list[np.ndarray]) -> list[tuple[str, float]]:
        if not found or not self.languages:
            return [(UNKNOWN, 0.0)] * len(found)
        flat = np.concatenate([b + i * BUCKETS for i, b in enumerate(found)])
        counts = np.bincount(flat, minlength=len(found) * BUCKETS)
        cells = np.flatnonzero(counts)                   # in order of text, then bucket
        some, starts = np.unique(cells // BUCKETS, return_index=True)
        total = np.tile(self.prior, (len(found), 1))
        if len(some):
            total[some] += np.add.reduceat(counts[cells][:, None] * self.log_prob[cells % BUCKETS], starts, axis=0)
        best = total.argmax(axis=1)
        share = 1.0 / np.exp(total - total.max(axis=1)[:, None]).sum(axis=1)
        return [(self.languages[k], float(p)) if len(b) else (UNKNOWN, 0.0)
                for k, p, b in zip(best.tolist(), share.tolist(), found, strict=True)]


def train(docs: DataFrame, *, text: str = "text", lang: str = "lang") -> LanguageModel:
    """Learn from every row with a language; texts without a letter only count for the prior."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals: dict[str, np.ndarray] = {}
        waiting: dict[str, list[np.ndarray]] = {}
        held: dict[str, int] = {}

        def add(name: str) -> None:
            if not waiting[name]:
                return
            totals[name][:BUCKETS] += np.bincount(np.concatenate(waiting[name]), minlength=BUCKETS)
            waiting[name], held[name] = [], 0

        for batch in batches:
            for name, value in zip(batch["lang"], batch["text"], strict=True):
                if name not in totals:
                    totals[name] = np.zeros(BUCKETS + 1, np.int64)
                    waiting[name], held[name] = [], 0
                totals[name][BUCKETS] += 1
                waiting[name].append(found := ngram_buckets(value))
                held[name] += len(found)
                if held[name] > _SLICE * 8:
                    add(name)
        for name, total in totals.items():
            add(name)
            at = np.flatnonzero(total)
            yield pd.DataFrame({"lang": name, "bucket": at.astype(np.int32), "n": total[at]})

    texts_in_small_batches(docs.sparkSession)
    rows = docs.where(column(docs, lang).isNotNull()).select(
        column(docs, lang).cast("string").alias("lang"), column(docs, text).alias("text"))
    counts = checkpointed(rows.mapInPandas(count, "lang string, bucket int, n bigint")
                          .groupBy("lang", "bucket").agg(F.sum("n").alias("n")))
    # the prior's bucket has one row per language
    found = counts.where(F.col("bucket") == BUCKETS).limit(MAX_LANGUAGES + 1).count()
    if found > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages; the model would not be bounded")
    cells = counts.toArrow().to_pandas()
    names = sorted(set(cells["lang"]))
    matrix = np.zeros((BUCKETS + 1, len(names)))
    if names:
        matrix[cells["bucket"], cells["lang"].map({n: i for i, n in enumerate(names)})] = cells["n"]
    grams, docs_of = matrix[:BUCKETS], matrix[BUCKETS]
    with np.errstate(divide="ignore", invalid="ignore"):
        prior = np.log(docs_of / docs_of.sum())
    log_prob = np.log(grams + SMOOTHING) - np.log(grams.sum(axis=0) + SMOOTHING * BUCKETS)
    return LanguageModel(tuple(names), prior, log_prob)


def identify(docs: DataFrame, model: LanguageModel, *, text: str = "text") -> DataFrame:
    """Add lang_pred and score, the posterior probability (columns of these names are replaced).

    ``und`` with score 0: the text is null or has no letter, or nothing was
    learned.  Equal posteriors: the first language by code point.
    """
    texts_in_small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame(shared.value.predict_all(texts), columns=["lang_pred", "score"])

    names = [c for c in docs.columns if c.lower() not in ("lang_pred", "score")]
    (held,) = free_name(docs, "told")
    out = docs.select(*[column(docs, c) for c in names], predict(column(docs, text)).alias(held))
    return out.select(*[f"`{c}`" for c in names], F.col(held)["lang_pred"].alias("lang_pred"),
                      F.col(held)["score"].alias("score"))


def held_out(doc_id: Column) -> Column:
    """The fold kept from training: crc32 of the id as text leaves 2 modulo 4 (a null id: not held out)."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def train_on_fold(docs: DataFrame) -> LanguageModel:
    return train(docs.where(~held_out(column(docs, "doc_id"))))
