"""Toxicity: maximum-scoring segments of token log-odds with extreme-value calibration.

Tokens are words.  Their log-odds between toxic and clean documents come from
smoothed shares: a word's share of toxic documents is drawn, with a Dirichlet
prior of PRIOR pseudo-counts, towards that of the other words with its first eight
letters, this one towards that of the first seven, and so on to three letters and to
all documents.  Rare or unseen inflections thus take after their stem.  Counts are
kept in hashed buckets, so the model's size doesn't depend on the corpus.

A text's score sequence is the log-odds less MARGIN.  Words come in bursts, so the
j-th time a text uses a word counts 1/j of its positive log-odds, and a document
counts a word once.  One linear pass (Ruzzo and Tompa) finds all maximal scoring
segments.  Their chance among clean texts follows Karlin and Altschul: a clean text of n words holds K n exp(-lambda s) segments of
score s or more on average; lambda and K are fitted to the best segments of the
clean training texts.  A segment that clean texts hold less than SIGNIFICANT times
is a toxic passage.  Several passages are aggregated by the sum statistic of the r
best (the most telling r counts, each further one at a cost of ln 2), and a
logistic curve over that evidence gives the probability.

Training texts are scored without their own counts (leave one out), so what the
calibration sees is what unseen texts get.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.llm.frames import checkpointed, column, free_name, texts_in_small_batches
from storelens.llm.words import mix, plain_words

STEMS = (3, 4, 5, 6, 7, 8)           # letters of the stems a word takes after
BUCKETS = 1 << 20
PRIOR = 4.0
MARGIN = 0.5
SIGNIFICANT = 0.05
TOXIC = 0.3                          # score from which a document is predicted toxic
SMALL_LABELS = 2_000_000             # labels up to this number are broadcast, 16 bytes each
KNOWN = 1 << 18                      # words whose log-odds a task keeps
_SLICE = 1 << 20
_NONE = BUCKETS                      # bucket of a stem that a short word lacks
_SPACE = re.compile(r"[\x09-\x0D\x20]")


def chains(words: Sequence[bytes]) -> np.ndarray:
    """A row a word: buckets of its stems (rising length) and of the word itself."""
    out = np.full((len(words), len(STEMS) + 1), _NONE, np.int64)
    if not len(words):
        return out
    out[:, -1] = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)) >> np.uint64(44)
    # words hold no space, so one line has all letters and where each word starts
    letters = np.frombuffer(b" ".join(words).decode("utf-8", "replace").encode("utf-32-le"), "<u4").astype(np.uint64)
    ends = np.append(np.flatnonzero(letters == 0x20), len(letters))
    starts = np.concatenate(([0], ends[:-1] + 1))
    size = ends - starts
    stem = np.zeros(len(words), np.uint64)
    for k in range(max(STEMS)):
        longer = size > k
        stem[longer] = stem[longer] * np.uint64(0x9E3779B97F4A7C15) + letters[starts[longer] + k]
        if k + 1 in STEMS:
            has = size > k + 1
            out[has, STEMS.index(k + 1)] = mix(stem[has] + np.uint64(k)) >> np.uint64(44)
    return out


def text_words(text: str | None) -> Iterator[list[bytes]]:
    """The words of a text, a slice of about a million characters at a time."""
    text, at = text or "", 0
    while at < len(text):
        cut = _SPACE.search(text, at + _SLICE)
        end = cut.end() if cut else len(text)
        yield plain_words(text[at:end].lower())
        at = end


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score) in order, in linear time.

    Runs of positive scores are taken as one.  A segment on the list knows the nearest one before
    it whose left sum is lower, so the search for a partner skips what can't be one.
    """
    up = scores > 0
    edge = np.flatnonzero(np.diff(np.concatenate(([False], up, [False])).astype(np.int8)))
    total = np.concatenate(([0.0], np.cumsum(scores)))
    listed: list[tuple[int, int, float, float, int]] = []        # start, end, left sum, right sum, lower before
    for start, end in edge.reshape(-1, 2).tolist():
        left, right = float(total[start]), float(total[end])
        while True:
            j = len(listed) - 1
            while j >= 0 and listed[j][2] >= left:
                j = listed[j][4]
            if j < 0 or listed[j][3] >= right:
                listed.append((start, end, left, right, j))
                break
            start, left = listed[j][0], listed[j][2]
            del listed[j:]
    return [(a, b, r - lo) for a, b, lo, r, _ in listed]


@dataclass
class ToxicityModel:
    counts: np.ndarray               # 2 x (BUCKETS + 1): clean and toxic documents with a word or stem
    documents: tuple[int, int]       # clean and toxic documents
    rate: float = 1.0                # lambda
    log_k: float = 0.0
    curve: tuple[float, float] = (0.0, 0.0)

    @property
    def learned(self) -> bool:
        return min(self.documents) > 0

    def log_odds(self, buckets: np.ndarray, without: int | None = None) -> np.ndarray:
        """Of words by their chains of buckets; ``without`` leaves one document of that label out, which has them all."""
        clean, toxic = (n - (without == y) for y, n in enumerate(self.documents))
        base = (toxic + 0.5) / (clean + toxic + 1)
        # documents with a stem, but not with the longer one after it: each counts at one place of the chain
        apart, after = [], np.zeros((2, len(buckets)), np.int64)
        for at in buckets.T[::-1]:
            found = self.counts[:, at]
            apart.append(np.where(at == _NONE, 0, np.maximum(found - after, 0)))
            after = np.where(at == _NONE, after, found)
        if without is not None:
            apart[0][without] -= 1
        share = np.full(len(buckets), base)
        for n0, n1 in reversed(apart):
            share = (n1 + PRIOR * share) / (n0 + n1 + PRIOR)
        return np.log(share / (1 - share)) - math.log(base / (1 - base))

    def evidence(self, scores: np.ndarray, words: int) -> float:
        """Minus log chance that a clean text of so many words holds segments of these falling scores."""
        apart = self.rate * scores - self.log_k - math.log(max(words, 1))
        if not len(apart):
            return -self.log_k - math.log(max(words, 1))
        apart = apart[:max(1, int((apart > -math.log(SIGNIFICANT)).sum()))]
        r = np.arange(1, len(apart) + 1)
        log_r = np.log(r)
        total = np.cumsum(apart)
        chance = total - (r - 1) * np.log(np.maximum(total, 1)) + 2 * np.cumsum(log_r) - log_r - (r - 1) * math.log(2)
        return float(chance.max())

    def probability(self, evidence: float) -> float:
        a, b = self.curve
        return float(1 / (1 + math.exp(-max(-500.0, min(500.0, a + b * bent(evidence))))))


def bent(evidence: float) -> float:
    return math.copysign(math.log1p(abs(evidence)), evidence)


class Odds(dict):
    """Word -> log-odds, worked out when first met; about KNOWN words are kept.  ``without``: as if one
    document of that label that has the word had not been counted."""

    def __init__(self, model: ToxicityModel, without: int | None = None):
        super().__init__()
        self.model, self.without = model, without

    def meet(self, words: set[bytes]) -> None:
        new = [w for w in words if w not in self]
        if len(self) + len(new) > KNOWN:
            self.clear()
            new = list(words)
        self.update(zip(new, self.model.log_odds(chains(new), self.without).tolist(), strict=True))


def token_scores(parts: Iterable[list[bytes]], odds: Odds) -> np.ndarray:
    """The score sequence of a text in parts."""
    out, times = [], {}
    for words in parts:
        if not all(map(odds.__contains__, words)):
            odds.meet(set(words))
        part = np.fromiter(map(odds.__getitem__, words), float, len(words))
        for i in np.flatnonzero(part > 0).tolist():
            times[words[i]] = j = times.get(words[i], 0) + 1
            part[i] /= j
        out.append(part - MARGIN)
    return np.concatenate(out) if out else np.empty(0)


def scored_texts(texts: Iterable[str | None], odds: Callable[[int], Odds]) -> Iterator[np.ndarray]:
    """The score sequence of each text; ``odds`` gives those for its place.  The words of several texts, up to a
    slice of characters, are met at once."""
    waiting: list[tuple[Odds, list[list[bytes]]]] = []
    size = 0

    def done() -> Iterator[np.ndarray]:
        for known in {id(o): o for o, _ in waiting}.values():
            known.meet({w for o, parts in waiting if o is known for part in parts for w in part})
        yield from [token_scores(parts, known) for known, parts in waiting]
        waiting.clear()

    for i, text in enumerate(texts):
        if len(text or "") > _SLICE:                     # a part at a time, not all its words at once
            yield from done()
            yield token_scores(text_words(text), odds(i))
            continue
        waiting.append((odds(i), list(text_words(text))))
        size += len(text or "")
        if size > _SLICE:
            yield from done()
            size = 0
    yield from done()


def _labelled(docs: DataFrame, labels: DataFrame, text: str, doc_id: str, toxic: str) -> DataFrame:
    """(text, toxic) of the documents with a mark; any positive one counts."""
    marks = checkpointed(labels.select(column(labels, doc_id).alias("id"), column(labels, toxic).alias("toxic")).where(
        "id is not null and toxic is not null").groupBy("id").agg((F.max("toxic") > 0).cast("int").alias("toxic")))
    if marks.limit(SMALL_LABELS + 1).count() <= SMALL_LABELS:
        marks = F.broadcast(marks)
    return docs.select(column(docs, doc_id).alias("id"), column(docs, text).alias("text")).join(marks, "id").select(
        "text", "toxic")


def _gumbel(n: np.ndarray, words: np.ndarray, best: np.ndarray) -> tuple[float, float]:
    """Maximum likelihood (lambda, ln K) of best segment scores over n texts of so many words."""
    total = n.sum()

    def log_k(rate: float) -> float:
        return math.log(total) - math.log((n * words * np.exp(-rate * best)).sum())

    def slope(rate: float) -> float:
        weight = n * words * np.exp(-rate * best)
        return 1 / rate - (n * best).sum() / total + (weight * best).sum() / weight.sum()

    low, high = 1e-3, 20.0
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if slope(middle) > 0 else (low, middle)
    return low, log_k(low)


def _logistic(x: np.ndarray, n0: np.ndarray, n1: np.ndarray) -> tuple[float, float]:
    """Weighted logistic fit (a, b) by Newton steps with a slight pull to zero."""
    w, design = np.zeros(2), np.stack([np.ones_like(x), x], axis=1)
    pull = np.diag([1e-3, 1e-2])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        slope = design.T @ (n1 - (n0 + n1) * p) - pull @ w
        bend = (design * ((n0 + n1) * p * (1 - p))[:, None]).T @ design + pull
        step = np.linalg.solve(bend, slope)
        w = w + step * min(1.0, 2.0 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(w[1])


def train(docs: DataFrame, labels: DataFrame, *, text: str = "text", doc_id: str = "doc_id",
          toxic: str = "toxic") -> ToxicityModel:
    """Learn from every document with a non-null mark (one marked twice: any positive mark counts).

    The driver gets at most 2 x BUCKETS counts and two histograms.
    """
    spark = docs.sparkSession
    texts_in_small_batches(spark)
    marked = _labelled(docs, labels, text, doc_id, toxic)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals = np.zeros((2, BUCKETS + 1), np.int32)
        documents = [0, 0]
        for batch in batches:
            for value, label in zip(batch["text"], batch["toxic"], strict=True):
                documents[label] += 1
                totals[label, np.unique(chains(list({w for words in text_words(value) for w in words})))] += 1
        for label in (0, 1):
            totals[label, _NONE] = 0
            at = np.flatnonzero(totals[label])
            yield pd.DataFrame({"toxic": label, "bucket": np.append(at, -1),
                                "n": np.append(totals[label, at].astype(np.int64), documents[label])})

    added = marked.mapInPandas(count, "toxic int, bucket int, n bigint").groupBy("toxic", "bucket").agg(
        F.sum("n").alias("n")).toArrow()
    label, bucket, n = (added.column(c).to_numpy() for c in ("toxic", "bucket", "n"))
    counts = np.zeros((2, BUCKETS + 1), np.int64)
    counts[label[bucket >= 0], bucket[bucket >= 0]] = n[bucket >= 0]
    model = ToxicityModel(counts, tuple(int(n[(label == y) & (bucket < 0)].sum()) for y in (0, 1)))
    if not model.learned:
        return model
    shared = spark.sparkContext.broadcast(model)

    def segments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        odds = [Odds(shared.value, without=y) for y in (0, 1)]
        for batch in batches:
            rows, labels = [], batch["toxic"].tolist()
            for y, scores in zip(labels, scored_texts(batch["text"], lambda i: odds[labels[i]]), strict=True):
                if len(scores):
                    rows.append((y, len(scores), sorted((s for _, _, s in maximal_segments(scores)), reverse=True)))
            yield pd.DataFrame(rows, columns=["toxic", "words", "scores"])

    found = checkpointed(marked.mapInPandas(segments, "toxic int, words bigint, scores array<double>"))
    fine = 50.0                                          # bins a unit
    cells = found.where("toxic = 0").groupBy(
        F.round(F.log("words") * 20).alias("size"),
        F.round(F.coalesce(F.get("scores", F.lit(0)), F.lit(0.0)) * fine).alias("best")).agg(F.count("*").alias("n"))
    clean = cells.toPandas()
    if len(clean):
        model.rate, model.log_k = _gumbel(clean["n"].to_numpy(float), np.exp(clean["size"].to_numpy() / 20),
                                          clean["best"].to_numpy() / fine)
    fitted = ToxicityModel(np.zeros((2, 1)), model.documents, model.rate, model.log_k)

    def judged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            at = [round(bent(fitted.evidence(np.asarray(s, float), n)) * fine)
                  for s, n in zip(batch["scores"], batch["words"], strict=True)]
            yield pd.DataFrame({"toxic": batch["toxic"], "bin": at})

    bins = found.mapInPandas(judged, "toxic int, bin bigint").groupBy("bin").agg(
        F.sum(1 - F.col("toxic")).alias("n0"), F.sum("toxic").alias("n1")).toPandas()
    if len(bins):
        model.curve = _logistic(bins["bin"].to_numpy() / fine, bins["n0"].to_numpy(float), bins["n1"].to_numpy(float))
    return model


def score_toxicity(docs: DataFrame, model: ToxicityModel, *, text: str = "text") -> DataFrame:
    """Add score (probability of toxicity), toxic_words (words in toxic passages) and toxic_passages: an array of
    (start, end, score, expected), words [start, end) and how often a clean text of the length holds the like.

    Columns of these names are replaced, others pass.  A text without words (null, empty) gets the share
    of toxic training documents, or what the curve gives no evidence if that is less; a model that
    has not seen both kinds gives every text that share (0 if nothing was learned).
    """
    texts_in_small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    marked = sum(model.documents)
    base = model.documents[1] / marked if marked else 0.0
    shape = ("score double, toxic_words bigint, "
             "toxic_passages array<struct<start:bigint,end:bigint,score:double,expected:double>>")

    def judge(m: ToxicityModel, scores: np.ndarray) -> tuple:
        if not m.learned or not len(scores):
            return (min(base, m.probability(0.0)) if m.learned else base), 0, []
        found = maximal_segments(scores)
        values = np.array(sorted((s for _, _, s in found), reverse=True))
        expected = [math.exp(min(700.0, m.log_k + math.log(len(scores)) - m.rate * s)) for _, _, s in found]
        passages = [{"start": a, "end": b, "score": s, "expected": e}
                    for (a, b, s), e in zip(found, expected, strict=True) if e < SIGNIFICANT]
        return (m.probability(m.evidence(values, len(scores))), sum(p["end"] - p["start"] for p in passages), passages)

    @F.pandas_udf(shape)
    def judged(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = Odds(shared.value)
        for texts in batches:
            found = scored_texts(texts, lambda i: known)
            yield pd.DataFrame([judge(known.model, s) for s in found], columns=["score", "toxic_words", "toxic_passages"])

    new = ("score", "toxic_words", "toxic_passages")
    names = [c for c in docs.columns if c.lower() not in new]
    (held,) = free_name(docs, "judged")
    out = docs.select(*[column(docs, c) for c in names], judged(column(docs, text)).alias(held))
    return out.select(*[f"`{c}`" for c in names], *[F.col(held)[c].alias(c) for c in new])
