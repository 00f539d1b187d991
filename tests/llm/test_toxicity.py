"""Toxicity: segments against brute force, the model's parts, held-out accuracy."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from storelens.llm import language_id, registry, toxicity
from tests.llm.cases import documents

MIDDLE = "/root/testdata/sf0.1"
SMALL = "/root/testdata/sf0.001"


def plain_segments(x, low=0, high=None):
    """The best run (longest sum; the shortest of equals), then the same left and right of it."""
    high = len(x) if high is None else high
    best = None
    for a in range(low, high):
        for b in range(a + 1, high + 1):
            s = sum(x[a:b])
            if s > 0 and (best is None or s > best[2] or s == best[2] and b - a < best[1] - best[0]):
                best = (a, b, s)
    if best is None:
        return []
    return [*plain_segments(x, low, best[0]), best, *plain_segments(x, best[1], high)]


def test_segments_equal_brute_force():
    rng = random.Random(1)
    for n in [0, 1, 2, 3, *[rng.randint(4, 22) for _ in range(150)]]:
        # distinct powers make every sum different, so the best run is unique
        x = [rng.choice([-1, -1, 1]) * (rng.randint(1, 8) + 2.0 ** -(i + 4)) for i in range(n)]
        got = toxicity.maximal_segments(np.array(x, float))
        want = plain_segments(x)
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in want]
        assert all(math.isclose(g[2], w[2]) for g, w in zip(got, want, strict=True))


def test_segments_take_linear_time():
    rng = np.random.default_rng(2)
    x = rng.normal(-0.1, 1, 1_000_000)
    falling = np.tile([1.0, -1.5], 500_000)
    assert len(toxicity.maximal_segments(falling)) == 500_000
    found = toxicity.maximal_segments(x)
    assert all(a[1] <= b[0] for a, b in zip(found, found[1:], strict=False))


def test_gumbel_and_logistic_fits():
    rng = np.random.default_rng(3)
    words = rng.integers(20, 5000, 40_000).astype(float)
    best = (np.log(0.2 * words) - np.log(-np.log(rng.random(len(words))))) / 1.3
    rate, log_k = toxicity._gumbel(np.ones_like(words), words, best)
    assert abs(rate - 1.3) < 0.03 and abs(log_k - math.log(0.2)) < 0.15
    x = np.linspace(-3, 3, 61)
    p = 1 / (1 + np.exp(-(0.5 + 2 * x)))
    a, b = toxicity._logistic(x, 1000 * (1 - p), 1000 * p)
    assert abs(a - 0.5) < 0.01 and abs(b - 2) < 0.01
    a, b = toxicity._logistic(np.array([-1.0, 1.0]), np.array([9.0, 0.0]), np.array([0.0, 9.0]))
    assert math.isfinite(a) and b > 1


def scored(spark, sf_dir):
    out = registry.QUERIES["op13_toxicity"](spark, sf_dir)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"]
    return out


def test_held_out_documents(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{MIDDLE}/labels.parquet").collect()}
    rows = scored(spark, MIDDLE).collect()
    assert len(rows) == spark.read.parquet(f"{MIDDLE}/documents.parquet").count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    held = [(r.score, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    right = sum((s >= 0.3) == bool(y) for s, y in held)
    toxic, clean = [s for s, y in held if y], [s for s, y in held if not y]
    wins = sum((t > c) + 0.5 * (t == c) for t in toxic for c in clean) / (len(toxic) * len(clean))
    assert len(toxic) > 80 and right / len(held) > 0.96 and wins > 0.95


def test_held_out_labels_ids_and_other_columns_change_nothing(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    fold = language_id.held_out(F.col("doc_id"))
    docs.withColumns({"lang": F.lit("xx"), "source": F.lit(None).cast("string")}).write.parquet(
        f"{tmp_path}/documents.parquet")
    labels.withColumn("toxic", F.when(fold, 1 - F.col("toxic")).otherwise(F.col("toxic"))).write.parquet(
        f"{tmp_path}/labels.parquet")
    a, b = ({r.doc_id: r.score for r in scored(spark, d).collect()} for d in (SMALL, str(tmp_path)))
    assert a.keys() == b.keys() and all(math.isclose(a[k], b[k], abs_tol=1e-12) for k in a)


def trained(spark, n=120):
    rng = random.Random(5)
    words = ["".join(rng.choice("bcdfgaeiou") for _ in range(rng.randint(2, 7))) for _ in range(200)]

    def text(bad, k):
        return " ".join(rng.choice(["vilest", "vilely", "vileness"]) if bad and rng.random() < 0.15 else rng.choice(words)
                        for _ in range(k))

    rows = [(i, text(i % 4 == 0, 60)) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i, _ in rows], "doc_id bigint, toxic int")
    return docs, labels, text


def test_passages_and_stems(spark):
    docs, labels, text = trained(spark)
    model = toxicity.train(docs, labels)
    clean = text(False, 300)
    unseen = "vilenessless vilestest vilelyly"
    given = [(1, f"{clean} {unseen} {clean}"), (2, clean), (3, f"{unseen} {clean} {unseen}"), (4, ""), (5, None)]
    out = {r.doc_id: r for r in toxicity.score_toxicity(
        spark.createDataFrame(given, "doc_id bigint, text string"), model).collect()}
    (one,) = out[1].toxic_passages
    assert 295 <= one["start"] <= 300 and 303 <= one["end"] <= 308 and one["expected"] < toxicity.SIGNIFICANT
    assert len(out[3].toxic_passages) == 2 and out[3].score > out[1].score > 0.3 > out[2].score
    assert out[2].toxic_passages == [] and out[2].toxic_words == 0
    assert out[4].score == out[5].score <= 0.3 and out[4].toxic_passages == out[5].toxic_passages == []


def test_a_burst_of_one_mild_word_is_no_passage(spark):
    docs, labels, text = trained(spark)
    model = toxicity.train(docs, labels)
    odds = toxicity.Odds(model)
    words = text(False, 400).encode().split()
    odds.meet(set(words))
    mild = next(w for w in words if 0 < odds[w] < 1.5)
    assert toxicity.token_scores([[mild] * 50], odds).sum() < 0


def test_awkward_rows_and_slices(spark, monkeypatch):
    docs, labels, text = trained(spark)
    odd = labels.unionAll(labels).unionAll(spark.createDataFrame(
        [(None, 1), (0, None), (1, 0), (9999, 1)], labels.schema)).selectExpr("*", "1 as TEXT", "2 as id")
    model = toxicity.train(docs.selectExpr("*", "3 as toxic", "4 as Id"), odd)
    same = toxicity.train(docs, labels)
    assert model.documents == same.documents and (model.counts == same.counts).all()
    given = documents(spark).selectExpr("*", "1 as Score", "2 as judged", "3 as toxic_PASSAGES")
    out = toxicity.score_toxicity(given, model)
    assert out.columns == [c for c in given.columns if c not in ("Score", "toxic_PASSAGES")] + [
        "score", "toxic_words", "toxic_passages"]
    rows = out.collect()
    assert len(rows) == given.count() and all(0 <= r.score <= 1 for r in rows)
    long, odds = " ".join([text(False, 500), text(True, 500)]), toxicity.Odds(model)
    given = [long, None, "", text(True, 30), long]
    whole = list(toxicity.scored_texts(given, lambda i: odds))
    assert [len(x) for x in whole] == [1000, 0, 0, 30, 1000]
    for name, small in (("_SLICE", 7), ("_SLICE", 2000), ("KNOWN", 5)):
        with monkeypatch.context() as m:
            m.setattr(toxicity, name, small)
            cut = list(toxicity.scored_texts(given, lambda i: toxicity.Odds(model)))
        assert all(np.allclose(a, b) for a, b in zip(whole, cut, strict=True))


def test_more_labels_than_fit_a_broadcast(spark, monkeypatch):
    docs, labels, _ = trained(spark, 40)
    want = toxicity.train(docs, labels)
    monkeypatch.setattr(toxicity, "SMALL_LABELS", 3)
    got = toxicity.train(docs, labels)
    assert (got.counts == want.counts).all() and got.documents == want.documents
    assert math.isclose(got.rate, want.rate) and np.allclose(got.curve, want.curve)


def test_chains_of_stems():
    words = [b"abc", b"abcd", "äöüßéx".encode(), b"abcdefghij", b"a", b"abcdx"]
    got = toxicity.chains(words)
    assert got.shape == (6, len(toxicity.STEMS) + 1) and toxicity.chains([]).shape == (0, len(toxicity.STEMS) + 1)
    none = toxicity.BUCKETS
    assert [int((r == none).sum()) for r in got] == [6, 5, 3, 0, 6, 4]        # stems are shorter than the word
    assert got[1, 0] == got[3, 0] == got[5, 0] and got[3, 1] == got[5, 1] and got[0, 0] == none
    assert (toxicity.chains(words[::-1]) == got[::-1]).all() and (got[:, -1] < none).all()


@pytest.mark.parametrize("toxic", [None, 0, 1])
def test_nothing_or_one_kind_learned(spark, toxic):
    docs, labels, _ = trained(spark, 12)
    model = toxicity.train(docs, labels.limit(0) if toxic is None else labels.withColumn("toxic", F.lit(toxic)))
    got = toxicity.score_toxicity(docs, model).collect()
    assert {r.score for r in got} == {float(toxic or 0)} and len(got) == 12
    assert toxicity.score_toxicity(docs.limit(0), model).count() == 0
