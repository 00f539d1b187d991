"""Substring dedup, language id, license scan, SimHash and decontamination against plain Python."""

from __future__ import annotations

import collections
import random
import re

import pytest
import xxhash

from storelens.llm import contamination, language_id, license_scan, simhash, substring
from storelens.llm.components import components
from storelens.llm.words import plain_words, sliding_argmin
from tests.llm.cases import DOC_SCHEMA, document_rows, documents, prose, vocabulary

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def removed(texts, window=35):
    words = [SPACE.findall(t or "") for t in texts]
    seen = collections.Counter(tuple(w[i:i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i:i + window])] > 1:
                gone[i:i + window] = [True] * window
        out.append((len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g)))
    return out


@pytest.mark.parametrize("first", [None, 5, 35])
def test_substring_dedup_equals_brute_force(spark, first):
    rows = document_rows()
    got = substring.dedup_substrings(documents(spark), first=first).select(
        "doc_id", "n_words", "n_removed", "kept_text").collect()
    want = [(r[0], *x) for r, x in zip(rows, removed([r[1] for r in rows]), strict=True)]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_substring_dedup_other_windows_and_unique_ids(spark):
    vocab = vocabulary(3, 6)                       # few words: many repeats, periodic runs
    rows = [(i, prose(i, random.Random(i).randint(0, 40), vocab)) for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    for window in (1, 2, 4, 7):
        got = substring.dedup_substrings(df, window=window).select("doc_id", "n_words", "n_removed", "kept_text")
        want = [(r[0], *x) for r, x in zip(rows, removed([r[1] for r in rows], window), strict=True)]
        assert sorted(map(tuple, got.collect())) == sorted(want)


def test_substring_dedup_keeps_columns_and_space(spark):
    out = substring.dedup_substrings(documents(spark), keep_space=True)
    assert out.columns[:11] == [c.split()[0] for c in DOC_SCHEMA.split(", ")]
    for r in out.collect():
        if r.n_removed == 0:
            assert r.kept_text == (r.text or "")
        assert SPACE.findall(r.kept_text) == SPACE.findall(removed_words(r))
    assert substring.dedup_substrings(documents(spark, [])).count() == 0


def removed_words(row):
    words = SPACE.findall(row.text or "")
    gone = {i for s in row.removed_spans for i in range(s["start"], s["end"])}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def test_sliding_argmin():
    import numpy as np
    values = np.random.default_rng(1).integers(0, 1 << 63, 500).astype(np.uint64)
    values[100:140] = values[100]
    for width in (1, 2, 5, 18, 500):
        key = [(int(v) >> 24) for v in values]
        want = [min(range(i, i + width), key=lambda j: (key[j], j)) for i in range(500 - width + 1)]
        assert sliding_argmin(values, width).tolist() == want
    assert sliding_argmin(values[:3], 5).tolist() == []


def plain_fingerprint(text):
    w = SPACE.findall((text or "").translate(FOLD))
    if not w:
        return 0
    shingles = [" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def grouped(fingerprints, ids, bits=3):
    at = list(range(len(ids)))

    def find(i):
        while at[i] != i:
            i = at[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if (fingerprints[i] ^ fingerprints[j]).bit_count() <= bits:
                a, b = find(i), find(j)
                at[max(a, b)] = min(a, b)
    low = {}
    for i, d in enumerate(ids):
        if d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
    return [low.get(find(i)) for i in range(len(ids))]


def test_simhash_equals_brute_force(spark):
    rows = document_rows()
    fps = [plain_fingerprint(r[1]) for r in rows]
    want = [(r[0], f"{f:016x}", c) for r, f, c in
            zip(rows, fps, grouped(fps, [r[0] for r in rows]), strict=True)]
    for keep in (True, False):
        got = simhash.near_duplicates(documents(spark), keep_text=keep)
        assert sorted(map(tuple, got.select("doc_id", "fingerprint", "component_id").collect()), key=repr) \
            == sorted(want, key=repr)
    assert simhash.near_duplicates(documents(spark, [])).count() == 0


@pytest.mark.parametrize("hot", [512, 2, 0])
def test_simhash_links_lose_nothing(spark, hot):
    rng = random.Random(4)
    fps = {0, (1 << 64) - 1}
    for _ in range(12):                            # dense clouds: everything near a centre
        centre = rng.getrandbits(64)
        for _ in range(25):
            x = centre
            for b in rng.sample(range(64), rng.randint(0, 4)):
                x ^= 1 << b
            fps.add(x)
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    got = simhash.links(spark.createDataFrame([(f,) for f in signed], "fp bigint"), hot=hot)
    want = {(max(a, b), min(a, b)) for i, a in enumerate(signed) for b in signed[:i]
            if 1 <= ((a ^ b) & ((1 << 64) - 1)).bit_count() <= 3}
    got = [(r.a, r.b) for r in got.collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_components_of_chains_and_hubs(spark):
    links = [(i, i + 1) for i in range(100, 140)] + [(7, x) for x in range(200, 230)] + [(5, 5), (3, 2), (2, 3)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {**{i: 100 for i in range(101, 141)}, **{x: 7 for x in range(200, 230)}, 3: 2}


def test_one_of_each(spark):
    kept = simhash.one_of_each(documents(spark))
    assert kept.columns == documents(spark).columns
    rows = document_rows()
    fps = [plain_fingerprint(r[1]) for r in rows]
    assert kept.count() == len(set(grouped(fps, list(range(len(rows))))))


def test_language_id_learns_and_abstains(spark):
    vocabs = {k: vocabulary(i + 50) for i, k in enumerate(("aa", "bb", "cc"))}
    rng = random.Random(2)
    rows = [(i, prose(i, rng.randint(1, 60), vocabs[k]).replace("e", chr(100 + ord(k[0]))), k)
            for i in range(300) for k in [rng.choice(list(vocabs))]]
    rows += [(1000, None, "aa"), (1001, "123 ...", "aa"), (1002, prose(1, 5), None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = language_id.train_on_fold(df)
    got = {r.doc_id: r for r in language_id.identify(df, model).collect()}
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got.values())
    assert (got[1000].lang_pred, got[1000].score) == ("und", 0.0)
    assert got[1001].lang_pred == "und" and got[1002].lang_pred in vocabs
    import zlib
    held = [r for r in rows if r[0] < 300 and zlib.crc32(str(r[0]).encode()) % 4 == 2]
    assert sum(got[r[0]].lang_pred == r[2] for r in held) > 0.9 * len(held)


def test_language_id_counts_by_hand(spark):
    df = spark.createDataFrame([(1, "ab", "x"), (2, "ab ab", "x"), (3, "zz", "y")],
                               "doc_id bigint, text string, lang string")
    model = language_id.train(df)
    assert model.languages == ("x", "y")
    import numpy as np
    counts = np.zeros((language_id.BUCKETS, 2))
    for text, k in (("ab", 0), ("ab ab", 0), ("zz", 1)):
        np.add.at(counts[:, k], language_id.ngram_buckets(text), 1)
    want = np.log((counts + 0.5) / (counts.sum(axis=0) + 0.5 * language_id.BUCKETS))
    assert np.allclose(model.log_prob, want) and np.allclose(np.exp(model.prior), [2 / 3, 1 / 3])


def test_language_id_counts_texts_of_any_length(spark, monkeypatch):
    # the last text of a task fills its buffer to the brim
    text = "ab" * language_id._SLICE * 5
    model = language_id.train(spark.createDataFrame([(1, text, "x"), (2, None, "x"), (3, "", "y")],
                                                    "doc_id bigint, text string, lang string").coalesce(1))
    assert model.predict(text)[0] == "x" and model.languages == ("x", "y")
    alone = language_id.train(spark.createDataFrame([(1, text, "x")], "doc_id bigint, text string, lang string"))
    assert alone.predict("abab") == ("x", 1.0)


def test_language_id_without_any_label(spark):
    model = language_id.train(documents(spark, []))
    got = language_id.identify(documents(spark), model).select("lang_pred", "score").distinct().collect()
    assert [tuple(r) for r in got] == [("und", 0.0)]


BASE = [("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"),
        ("mit license", "mit")]


def test_license_base_columns_equal_brute_force(spark):
    texts = ["Licensed under CC BY-NC 4.0.", "the MIT-License, the mit license; MIT license", None, "", "cc",
             "GNU general\npublic license GNU General Public License cc by cc by by", "xmit license cc bye",
             "Apache Licenseé apache license", "MIT LICENSE " * 50] + [r[1] for r in document_rows()]
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    got = license_scan.scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string"))
    for r in got.collect():
        w = word.findall((texts[r.doc_id] or "").translate(FOLD))
        at = [(i, label) for phrase, label in BASE for i in range(len(w))
              if w[i:i + len(phrase.split())] == phrase.split()]
        assert (r.n_words, r.n_base) == (len(w), len(at))
        assert (r.first_word, r.last_word) == ((min(at)[0], max(at)[0]) if at else (None, None))
        assert r.base_labels == ",".join(sorted({x for _, x in at}))
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
        assert 0 <= r.score <= 1


def test_license_templates(spark):
    scan = license_scan.Scanner(license_scan.PHRASES, license_scan.TEMPLATES).scan
    labels = lambda t: scan(t)[5].split(",")
    assert labels("This work is licensed under the GNU General Public License, version 3.") == \
        ["gpl", "gpl-3.0", "gpl-notice"]
    assert "gpl-notice" in labels("licensed under the terms of the GNU General Public License, version 2 "
                                  "or any later version")
    assert labels("Licensed under the Apache License, Version 2.0") == ["apache", "apache-2.0"]
    assert labels("Licensed under the Apache License, Version 3.0") == ["apache"]      # mandatory wording differs
    assert labels("Licensed under CC BY-NC 4.0.") == ["cc-by", "cc-by-nc-4.0"]
    # the opening of a grant tells no license
    assert labels("Permission is hereby granted, free of charge, to any person obtaining a copy of this font software and "
                  "associated documentation files (the \"Font\"), to deal in the Font Software without restriction") == [""]
    with pytest.raises(ValueError):
        license_scan.compile_template("a ]] b")
    with pytest.raises(ValueError):
        license_scan.compile_template("[[a]]")


@pytest.mark.parametrize(("markup", "pattern"), [
    ("a [[b {{x:1-2}}]] c {{y:0-3}} d", r"a (?:b (?:\w+ ){1,2})?c (?:\w+ ){0,3}d "),
    ("a {{x}} b [[{{y}} c]] a", r"a (?:\w+ )*b (?:(?:\w+ )*c )?a "),
    ("[[a]] [[b]] c {{x:0-1}} {{y}} c", r"(?:a )?(?:b )?c (?:\w+ )?(?:\w+ )*c ")])
def test_license_automaton_equals_regex(markup, pattern):
    rng = random.Random(1)
    machine, regex = license_scan.compile_template(markup), re.compile(pattern)
    for _ in range(3000):
        words = [rng.choice("abcde") for _ in range(rng.randint(1, 9))]
        # every accepted span is one, each end is found, with its latest start and none longer from there
        line = [w.encode() for w in words]
        all_spans = [(i, e) for i in range(len(words)) for e in range(i + 1, len(words) + 1)
                     if regex.fullmatch("".join(w + " " for w in words[i:e]))]
        latest = {e: max(i for i, f in all_spans if f == e) for _, e in all_spans}
        starts = [i for i, w in enumerate(line) if w in machine.first]
        assert machine.spans(line, starts) == sorted({i: max(e for e, j in latest.items() if j == i)
                                                      for i in latest.values()}.items())
        text = "".join(w + " " for w in words)
        ends = [e for e in range(1, len(words) + 1) if regex.fullmatch("".join(w + " " for w in words[:e]))]
        got = machine.accepts_at([w.encode() for w in words], 0)
        assert got == (max(ends) if ends else None), text


def filled(label, words="Some One"):
    """A whole wording with its replaceable regions filled in and its optional ones left out."""
    text = license_scan.TEMPLATES[label]
    while "[[" in text:
        text = re.sub(r"\[\[(?:(?!\[\[|\]\]).)*\]\]", " ", text, flags=re.S)
    return re.sub(r"\{\{[^{}]*\}\}", lambda m: words if ":" not in m[0] else "Software", text)


LONG_HOLDER = "THE AUTHORS OR COPYRIGHT HOLDERS OR ANY OF THE MANY CONTRIBUTORS NAMED IN THE FILE AUTHORS OR ELSEWHERE"


def license_rows():
    """Openings alone, whole wordings, near variants, wordings inside and beside each other."""
    whole = {label: filled(label) for label in license_scan.TEXTS}
    mit = filled("mit-license", LONG_HOLDER)
    rows = [f"intro {t} outro" for t in whole.values()] + [
        mit, mit.replace("sublicense", "relicense"), mit.replace("WITHOUT WARRANTY OF ANY KIND,", ""),
        mit[:mit.index("without restriction")] + "for research only", mit[:mit.index("THE AUTHORS")],
        license_scan._BSD_OPENING, f"{license_scan._BSD_OPENING}: none", whole["bsd-2-clause"].replace("BINARY", "binary"),
        whole["x11"], f"{mit} {whole['x11']}", f"{whole['x11']}\n{mit}", f"{whole['gpl-3.0-text']} {whole['gpl-3.0-notice']}",
        "released under the MIT License", "is released under the terms of the MIT License. CC BY 4.0", "cc by " * 30, "", None]
    return [(i, t) for i, t in enumerate(rows)]


def test_license_whole_wordings_and_near_variants(spark):
    rows = license_rows()
    out = {r.doc_id: r for r in license_scan.scan_licenses(spark.createDataFrame(rows, "doc_id int, text string")).collect()}
    labels = [set(filter(None, out[i].labels.split(","))) - {"gpl", "mit", "apache", "cc-by"} for i, _ in rows]
    for i, label in enumerate(license_scan.TEXTS):
        assert label in labels[i] and out[i].score == 1.0
    mit, relicense, cut, research, half, opening, none, bsd, x11, both, turned, gpl = labels[len(license_scan.TEXTS):][:12]
    assert mit == {"mit-license"} and relicense == cut == research == half == opening == none == set()
    assert bsd == {"bsd-2-clause"} and x11 == {"x11"} and both == turned == {"mit-license", "x11"}
    assert {"gpl-3.0-text", "gpl-3.0-notice"} <= gpl
    assert out[len(license_scan.TEXTS) + 3].score == 0.0


def test_license_sql_agrees_on_literal_rows(spark, tmp_path):
    import duckdb

    from storelens.llm import registry
    spark.createDataFrame(license_rows(), "doc_id int, text string").write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    rel = con.execute(registry.ORACLE["op8_license_scan"])
    names = [d[0] for d in rel.description]
    want = sorted((tuple(sorted(zip(names, r, strict=True))) for r in rel.fetchall()), key=repr)
    got = registry.QUERIES["op8_license_scan"](spark, str(tmp_path)).collect()
    assert sorted((tuple(sorted(r.asDict().items())) for r in got), key=repr) == want


def test_license_scan_time_is_linear():
    """Automaton steps and phrase finds a megabyte don't grow with the text."""
    import time
    scan = license_scan.Scanner(license_scan.PHRASES, license_scan.TEMPLATES).scan
    opening = license_scan.TEMPLATES["mit-license"].split("{{holders}}")[0].replace("{{software:1-4}}", "software") \
        .replace("{{notice:1-1}}", "notice").replace("{{name:1-3}}", "Software").replace("[[", "").replace("]]", "")
    tail = "is cc by released is noninfringement licensed under furnished redistributions permission " * 1000
    seconds = {}
    for times in (2, 24):                                # 0.2 and 2.1 MB, an open {{holders}} region throughout
        text = opening + " " + tail * times
        start = time.process_time()
        got = scan(text)
        seconds[times] = (time.process_time() - start) / len(text)
        assert got[1] == 1000 * times and "mit-license" not in got[5]
    assert seconds[24] < 3 * seconds[2]


def plain_items(docs, items, threshold=0.8):
    def shingles(words, n):
        return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)}

    out = []
    for d, text in docs:
        w = plain_words((text or "").lower())
        for i, item in items:
            v = plain_words((item or "").lower())
            if not v or not w:
                continue
            n = min(5, len(v))
            s = shingles(v, n)
            share = len(s & shingles(w, n)) / len(s)
            if share >= threshold:
                out.append((d, i, round(share, 9)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("chars", [8_000_000, 1000])
def test_decontamination_equals_brute_force(spark, monkeypatch, chars):
    """As one broadcast index, and, for a benchmark beyond its size, by joins."""
    monkeypatch.setattr(contamination, "SLICE_CHARS", chars)
    monkeypatch.setattr(contamination, "TOGETHER", 3)
    rng = random.Random(3)
    items = [(i, prose(1000 + i, rng.choice([1, 2, 3, 4, 5, 6, 8, 13, 20, 40, 90, 200]))) for i in range(80)]
    items += [(900, None), (901, ""), (902, "..."), (None, prose(77, 30)), (903, prose(77, 30))]
    docs = []
    for d in range(150):
        parts = [prose(5000 + d, rng.randint(0, 3000))]
        for _ in range(rng.randint(0, 3)):
            text = rng.choice(items)[1] or ""
            w = text.split()
            if len(w) > 12 and rng.random() < 0.5:          # a word changed, or the passage cut
                w[rng.randrange(len(w))] = "changed"
            parts += [" ".join(w).upper() if rng.random() < 0.3 else " ".join(w), prose(9000 + d, rng.randint(0, 50))]
        docs.append((d, "\n".join(parts)))
    docs += [(1000, None), (1001, ""), (None, items[5][1]), (1002, "la " * 700), (1003, " ".join(t or "" for _, t in items)),
             docs[3], docs[3]]
    items += [(904, "la " * 800), (905, "la la la"), items[40], items[40]]
    df = spark.createDataFrame([(d, t, "x") for d, t in docs], "doc_id bigint, text string, items string")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    rows = contamination.find_items(df, bench).collect()
    got = sorted(((r.doc_id, h.item_id, round(h.containment, 9)) for r in rows for h in r["items"]), key=repr)
    assert got == plain_items(docs, items) and len(got) > 50
    clean = contamination.decontaminate(df, bench)
    assert clean.columns == df.columns and clean.count() == sum(not r["items"] for r in rows)
    assert {(r.doc_id, r["items"]) for r in clean.collect()} <= {(d, "x") for d, _ in docs}
    assert contamination.find_items(df.limit(0), bench).count() == 0
    assert all(r["items"] == [] for r in contamination.find_items(df, bench.limit(0)).collect())


def test_decontamination_in_slices(spark, monkeypatch):
    items = [(i, prose(i, 20)) for i in range(30)]
    df = spark.createDataFrame([(i, prose(99, 300) + " " + t) for i, t in items], "doc_id bigint, text string")
    monkeypatch.setattr(contamination, "SLICE_CHARS", 500)
    found = contamination.find_items(df, spark.createDataFrame(items, "item_id bigint, text string")).collect()
    assert all([h.item_id for h in r["items"]] == [r.doc_id] for r in found)
