"""Registered corpus queries against their SQL, and the pipeline against plain Python."""

from __future__ import annotations

import hashlib
import math
from collections import Counter

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from storelens.llm import language_id, registry
from tests.llm.test_table_operators import SPACE, plain_targets
from tests.llm.test_text_operators import grouped, plain_fingerprint, plain_items, removed

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("key", sorted(registry.ORACLE))
def test_query_equals_sql(spark, key):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    rel = con.execute(registry.ORACLE[key])
    names = [d[0] for d in rel.description]
    df = registry.QUERIES[key](spark, SMALL)
    cols = sorted(df.columns)
    assert cols == sorted(names)

    def norm(rows):
        return Counter(tuple(round(r[c], 9) if isinstance(r[c], float) else r[c] for c in cols) for r in rows)

    assert norm(df.collect()) == norm(dict(zip(names, r, strict=True)) for r in rel.fetchall())


def test_every_operator_is_registered():
    assert [k.split("_")[0] for k in registry.QUERIES] == [f"op{n}" for n in range(1, 14)]


def plain_buckets(text):
    """Buckets of all 2- and 3-grams, letter by letter; every other run of characters is one edge."""
    letters = [0]
    for c in (text or "").lower():
        if c.isalpha():
            letters.append(ord(c))
        elif letters[-1]:
            letters.append(0)
    if len(letters) == 1:
        return []
    if letters[-1]:
        letters.append(0)
    out = []
    for n in (2, 3):
        for i in range(len(letters) - n + 1):
            key = n
            for code in letters[i:i + n]:
                key = (key * 0x9E3779B97F4A7C15 + code) % (1 << 64)
            key = (key ^ (key >> 29)) * 0xBF58476D1CE4E5B9 % (1 << 64)
            out.append((key >> 32) % language_id.BUCKETS)
    return out


def plain_languages(docs):
    """Naive Bayes from dictionaries: the predicted language and its posterior."""
    names = sorted({d["lang"] for d in docs if d["lang"] is not None})
    grams = {n: Counter() for n in names}
    for d in docs:
        if d["lang"] is not None:
            grams[d["lang"]].update(plain_buckets(d["text"]))
    prior = Counter(d["lang"] for d in docs if d["lang"] is not None)
    totals = {n: sum(grams[n].values()) + 0.5 * language_id.BUCKETS for n in names}
    out = []
    for d in docs:
        found = Counter(plain_buckets(d["text"]))
        if not found:
            out.append(("und", 0.0))
            continue
        logs = {n: math.log(prior[n] / sum(prior.values())) + sum(
            k * math.log((grams[n][g] + 0.5) / totals[n]) for g, k in found.items()) for n in names}
        best = max(names, key=lambda n: logs[n])
        out.append((best, 1 / sum(math.exp(v - logs[best]) for v in logs.values())))
    return out


def plain_pipeline(docs, items):
    docs = [d for d, (lang, score) in zip(docs, plain_languages(docs), strict=True) if lang != "und" and score >= 0.5]
    ids = [d["doc_id"] for d in docs]
    low = grouped([plain_fingerprint(d["text"]) for d in docs], ids)
    docs = [d for d, c in zip(docs, low, strict=True) if d["doc_id"] == c]
    cut = removed([d["text"] for d in docs])
    docs = [{**d, "words": SPACE.findall(d["text"]) if not gone else kept.split(), "gone": gone}
            for d, (n, gone, kept) in zip(docs, cut, strict=True) if not gone or gone < n]
    leaks = {d for d, _, _ in plain_items([(d["doc_id"], " ".join(d["words"])) for d in docs], items)}
    return [d for d in docs if d["doc_id"] not in leaks]


def test_pipeline_equals_brute_force(spark):
    docs = [r.asDict() for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    want = plain_pipeline(docs, items)
    sizes = Counter()
    for d in want:
        sizes[d["source"]] += len(d["words"])
    targets = plain_targets(sizes)
    stage = spark.read.parquet(f"{SMALL}/documents.parquet")
    for _, step in corpus_pipeline.STAGES[:-1]:
        before = stage.columns
        stage = step(spark, stage, SMALL)
        assert stage.columns == before
    left = {r.doc_id: r for r in stage.collect()}
    assert sorted(left) == sorted(d["doc_id"] for d in want) and 0 < len(left) < len(docs)
    for d in want:
        r = left[d["doc_id"]]
        assert SPACE.findall(r.text) == d["words"]
        assert (r.text, r.n_chars) == (d["text"], d["n_chars"]) if not d["gone"] else r.n_chars == len(r.text)

    taken = {}
    for name in sizes:
        t, of = targets[name], [left[d["doc_id"]] for d in want if d["source"] == name]
        epochs = math.floor(t / sizes[name] + 1e-12)

        def key(r):
            u = (int(hashlib.md5(f"{r.doc_id}:{r.text}".encode()).hexdigest()[:13], 16) + 0.5) / (1 << 52)
            letters = sum(c.isalpha() or ord(c) > 127 for c in r.text)
            return -math.log(u) / (0.25 + letters / len(r.text))

        ahead = 0
        for r in sorted(of, key=key):
            n = len(SPACE.findall(r.text))
            taken[r.doc_id] = n * (epochs + (ahead + n / 2 <= t - epochs * sizes[name] + 1e-9))
            ahead += n
    got = {r.doc_id: r.taken for r in corpus_pipeline.run(spark, SMALL).collect()}
    assert got == {k: v for k, v in taken.items() if v > 0}


def test_pipeline_on_awkward_rows(spark):
    from tests.llm.cases import documents
    docs = documents(spark).select("doc_id", "text", "lang", "source", "n_chars")
    for some in (docs, docs.limit(0)):
        stage = some
        for name, step in corpus_pipeline.STAGES:
            stage = step(spark, stage, SMALL)
            if name != "mixing":
                assert stage.columns == some.columns
        assert stage.where("taken <= 0").count() == 0
        assert np.isfinite(stage.toPandas()["target"]).all()
