"""Every operator on tables with columns that clash with its own, inside and out."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from storelens.llm import (
    centroids,
    chat,
    contamination,
    fingerprint,
    language_id,
    license_scan,
    mixing,
    simhash,
    site_tree,
    spelling,
    substring,
    toxicity,
    url_filter,
)
from tests.llm.cases import CLASHES, documents

OUT = {"n_words", "n_removed", "kept_text", "removed_spans", "text", "n_chars", "host", "path", "rule", "verdict", "lang_pred", "score",
       "items", "fingerprint", "component_id", "near_group", "toxic_words", "toxic_passages", "n_common", "prompt", "chosen",
       "rejected", "chosen_mask", "rejected_mask", *license_scan.COLUMNS}


def clashing(df):
    here = {c.lower() for c in df.columns}
    return df.select("*", *[F.expr(v).alias(c) for c, v in CLASHES.items() if c.lower() not in here])


def operators(spark):
    docs = documents(spark)
    labels = spark.createDataFrame([(1, 1), (4, 0), (5, 0), (11, 1)], "doc_id bigint, toxic int")
    items = spark.createDataFrame([(1, "one two"), (2, None)], "item_id bigint, text string")
    pages = spark.createDataFrame([(1, "http://a.com/x", "<p>a b</p>"), (None, None, None)], "page_id int, url string, html string")
    turn = "array<struct<role:string,text:string>>"
    pairs = spark.createDataFrame([(1, [("user", "a")], [("user", "b")])], f"id int, chosen {turn}, rejected {turn}")
    vectors = spark.createDataFrame([(1, [1.0, 2.0]), (2, [0.0, 1.0])], "vec_id bigint, embedding array<float>")
    turns = spark.createDataFrame([(1, 0, "user", "a"), (1, 1, "assistant", "b")], "conv_id int, turn int, role string, text string")
    return {
        "substring": (docs, lambda d: substring.dedup_substrings(d)),
        "site_tree": (pages, lambda d: site_tree.extract(d)),
        "url_filter": (pages, lambda d: url_filter.filter_urls(d, [("a.com", "/", "block")])),
        "language_id": (docs, lambda d: language_id.identify(d, language_id.train(docs))),
        "fingerprint": (docs, lambda d: fingerprint.with_edited(d)),
        "mixing": (docs, lambda d: mixing.mix(d)),
        "contamination": (docs, lambda d: contamination.find_items(d, clashing(items))),
        "license_scan": (docs, lambda d: license_scan.scan_licenses(d)),
        "chat": (pairs, lambda d: chat.format_preferences(d)),
        "conversations": (turns, lambda d: chat.format_preferences(chat.reply_pairs(chat.conversations(d)))),
        "simhash": (docs, lambda d: simhash.near_duplicates(d)),
        "centroids": (vectors, lambda d: centroids.cluster_vectors(d, dims=2)),
        "spelling": (docs, lambda d: spelling.group_variants(spelling.vocabulary(d))),
        "toxicity": (docs, lambda d: toxicity.score_toxicity(d, toxicity.train(clashing(docs), clashing(labels)))),
    }


@pytest.mark.parametrize("name", ["substring", "site_tree", "url_filter", "language_id", "fingerprint", "mixing", "contamination",
                                  "license_scan", "chat", "conversations", "simhash", "centroids", "spelling", "toxicity"])
def test_clashing_columns_change_nothing(spark, name):
    df, run = operators(spark)[name]
    plain, clashed = run(df), run(clashing(df))
    lower = [c.lower() for c in clashed.columns]
    assert len(set(lower)) == len(lower) and set(plain.columns) <= set(clashed.columns)
    own = [c for c in plain.columns]
    assert sorted(map(str, clashed.select(*[f"`{c}`" for c in own]).collect())) == sorted(map(str, plain.select(*own).collect()))
    # what is no output passes
    if name not in ("fingerprint", "mixing", "conversations", "centroids", "spelling"):
        assert all(c in clashed.columns for c in CLASHES if c.lower() not in OUT | {x.lower() for x in own})
