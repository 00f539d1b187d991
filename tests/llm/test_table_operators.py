"""URL filter, site tree, fingerprints, mixing, chat formatting, neighbours and the pipeline."""

from __future__ import annotations

import hashlib
import html as htmllib
import math
import random
import re
import struct

import pytest
import xxhash
from pyspark.sql import functions as F

from storelens.llm import chat, fingerprint, html_tree, mixing, neighbours, registry, site_tree, url_filter
from tests.llm.cases import document_rows, documents, prose

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
URLS = ["http://example.com/en/1", "https://www.example.com/en/x?y=/fr/", "http://a.b.net/es/", "http://net/fr/#a",
        "HTTP://WWW.EXAMPLE.COM/en/", "http://example.com", "http://example.com/EN/", "no scheme", None, "", "://",
        "http://xn.com?q", "http://u:p@h.com:80/p/q", "http://notexample.com/en/", "http://example.com.net/fr/x",
        "http://ÀB.com/é/", "a://b://c.com/", "http://com/", "http://.com/", "http://x.net/es", "http://\n.com/a\nb?c"]


def plain_verdict(url, rules, default="allow"):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split("[/?#]", rest)[0]
        path = re.split("[?#]", rest[len(host):])[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, 0, None, default))
    return host, path, best[2], best[3]


def test_url_filter_equals_brute_force(spark):
    rules = registry.URL_RULES + [("example.com", "/en", "allow"), ("b.net", "", "block"), ("xn.com", "/a/b", "block")]
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(URLS)], "page_id int, url string, host string")
    for chosen in (registry.URL_RULES, rules):
        got = url_filter.filter_urls(pages, chosen).orderBy("page_id").collect()
        for r in got:
            assert (r.host, r.path, r.rule, r.verdict) == plain_verdict(r.url, chosen), r.url
    assert url_filter.filter_urls(pages.limit(0), rules).count() == 0
    with pytest.raises(ValueError):
        url_filter.filter_urls(pages, rules, max_rules=2)


def test_url_trie_precedence_at_random():
    rng = random.Random(1)
    hosts = ["com", "a.com", "b.a.com", "net", "a.net"]
    for _ in range(300):
        rules = {(rng.choice(hosts), rng.choice(["", "/", "/x", "/x/", "/x/y", "/xy/"])): rng.choice(["allow", "block"])
                 for _ in range(6)}
        rules = [(h, p, v) for (h, p), v in rules.items()]
        url = "http://" + rng.choice(["", "w."]) + rng.choice(hosts) + rng.choice(["", "/", "/x", "/x/y/z", "/xy/", "/xyz"])
        host, path, rule, verdict = plain_verdict(url, rules, None)
        assert url_filter.Trie(rules).find(host, path) == (rule, verdict)


def test_html_blocks():
    blocks = lambda h: [b for *_, b in site_tree.main_blocks(html_tree.parse(h or ""))]
    page = ('<html><head><title>T</title><script>var t="</p>";</script></head><body><nav>Menu</nav><div class="ad">Buy'
            '</div><article><h1>A &amp; B</h1><p>one\n two<br>three<p><b>four <i>fi</i>ve<ul><li>x<li>y</ul>'
            '<div class="comments"><p>first!</div><aside>more</aside></article><footer>f</footer>')
    assert blocks(page) == ["A & B", "one two three", "four five", "x", "y"]
    assert blocks("plain &lt;b&gt; text") == ["plain <b> text"]
    assert blocks(None) == blocks("") == blocks("<p") == blocks("<script>x") == []
    assert blocks("<p>a<!-- <p>b</p> -->c</p>d") == ["ac", "d"]
    assert blocks("<p title='a>b'>t &#233;&eacute; &am") == ["t éé &am"]
    assert blocks("<table><tr><td>1<td>2<tr><td>3</table><pre> a\n b </pre>") == ["1", "2", "3", "a b"]
    assert blocks("<article><header><h1>T</h1></header><p>x</article><header>H</header>") == ["T", "x"]
    assert blocks("<div>" * 3000 + "deep" + "</div>" * 3000) == ["deep"]
    assert html_tree.parse("<p>a</div>b").children[0].children == ["ab"]


def test_site_tree_removes_what_a_site_repeats(spark):
    rng = random.Random(1)
    rows = []
    for i in range(60):
        body = "".join(f"<p>{prose(i * 100 + k, 12)}</p>" for k in range(rng.randint(1, 4)))
        html = (f"<body><div class=x>{rng.choice(['Home News', 'Home Sport'])}</div><div class=y>{body}</div>"
                f"<div class=z>All rights &copy; us</div></body>")
        rows.append((i, f"http://{'big.com' if i < 50 else f'small{i}.com'}/{i}", html, body))
    rows.append((1000, None, None, ""))
    rows.append((0, *rows[0][1:]))                        # a repeated row
    df = spark.createDataFrame([(a, b, c, "t") for a, b, c, _ in rows], "page_id int, url string, html string, text string")
    got = site_tree.extract(df).collect()
    assert len(got) == len(rows)
    want = {a: "\n\n".join(re.findall("<p>(.*?)</p>", " ".join(d.split()))) for a, _, _, d in rows}
    for r in got:
        assert r.text == want[r.page_id] and r.n_chars == len(r.text), r
    assert site_tree.extract(df.limit(0)).count() == 0


def test_site_tree_on_given_pages(spark):
    """Article blocks only, whatever the host's size (a plain reading of the same pages)."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r.text for r in registry.op2_html_extraction(spark, "/root/testdata/sf0.01").collect()}
    for r in pages.collect():
        body = r.html.split("<article>", 1)[1].split("</article>")[0] if "<article>" in r.html else ""
        body = re.sub(r"<(?!/?[bp]>|br>|/?h1>)[^>]*$", "", body)
        parts = [re.sub(r"<[^>]*>?", " ", x) for x in re.split(r"</?(?:p|h1)>", body)]
        parts = [" ".join(htmllib.unescape(x).split()) for x in parts]
        assert got[r.page_id] == "\n\n".join(x for x in parts if x), r.page_id


MASK = (1 << 64) - 1


def xx(values, seed=42):
    """Spark's xxhash64 over longs."""
    for v in values:
        seed = xxhash.xxh64_intdigest(struct.pack("<q", v), seed)
    return seed


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def plain_oph(text):
    words = [signed(xxhash.xxh64_intdigest(w.encode(), 42)) for w in SPACE.findall(text or "")]
    if not words:
        return ""
    n = max(1, len(words) - 4)
    hashes = [signed(xx(words[i:i + 5])) for i in range(n)]
    best = {}
    for h in hashes:
        b = (h >> 56) + 128
        best[b] = min(best.get(b, h), h)
    starts, strides, _ = fingerprint.walks()
    out = []
    for b in range(256):
        t = 0
        at = b
        while at not in best:
            at = (starts[b] + t * strides[b]) % 256
            t += 1
        out.append("0123456789abcdef"[best[at] & 15])
    return "".join(out)


def test_fingerprints_equal_brute_force(spark):
    rows = document_rows() + [(100 + i, prose(i, 3 ** (i % 8)), "en", "a", 1, "", "", "", "", "", 0) for i in range(40)]
    df = documents(spark, rows)
    got = fingerprint.with_edited(df).collect()
    order = sorted(((r[0], r[1] or "") for r in rows),
                   key=lambda x: (x[0] is not None, x[0] or 0, signed(xxhash.xxh64_intdigest(x[1].encode(), 42))))
    want = []
    for i, (d, t) in enumerate(order):
        nxt = order[(i + 1) % len(order)][1]
        half = len(t) // 2
        edited = t[:len(t) - half] + nxt[:half]
        a, b, c = plain_oph(t), plain_oph(edited), plain_oph(nxt)

        def near(x, y):
            if x == y:
                return 1.0
            if not x or not y:
                return 0.0
            return max(0.0, (sum(p == q for p, q in zip(x, y, strict=True)) / 256 - 1 / 16) / (15 / 16))

        want.append((d, len(t), hashlib.sha256(edited.encode()).hexdigest(), a, b, round(near(a, b), 9), round(near(a, c), 9)))
    have = [(r.doc_id, r.n_chars, hashlib.sha256(r.edited.encode()).hexdigest(), r.fingerprint, r.edited_fingerprint,
             round(r.near_edited, 9), round(r.near_next, 9)) for r in got]
    assert sorted(have, key=repr) == sorted(want, key=repr)
    assert fingerprint.with_edited(documents(spark, [])).count() == 0
    one = fingerprint.with_edited(documents(spark, rows[:1])).first()
    assert one.edited == rows[0][1][:-(len(rows[0][1]) // 2)] + rows[0][1][:len(rows[0][1]) // 2]


def test_fingerprint_estimates_similarity(spark):
    words = prose(1, 4000).split()
    pairs = [(k, " ".join(words[:2000]), " ".join(words[:k] + words[2000:4000 - k])) for k in (0, 500, 1000, 1500, 2000)]
    df = spark.createDataFrame(pairs, "k int, a string, b string")
    df = fingerprint.with_fingerprint(fingerprint.with_fingerprint(df, "a", "fa"), "b", "fb")
    for r in df.withColumn("j", fingerprint.likeness(F.col("fa"), F.col("fb"))).collect():
        a, b = ({tuple(t[i:i + 5]) for i in range(len(t) - 4)} for t in (r.a.split(), r.b.split()))
        assert abs(r.j - len(a & b) / len(a | b)) < 0.12


def test_next_row_over_ties_and_nulls(spark):
    rng = random.Random(5)
    rows = [(rng.choice([None, rng.randint(0, 40), 7]), i) for i in range(400)]
    got = neighbours.with_next(spark.createDataFrame(rows, "id bigint, tie bigint"), "id", "tie",
                               {"nid": "id", "ntie": "tie"}).collect()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    want = [(*r, *order[(i + 1) % len(order)]) for i, r in enumerate(order)]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def plain_targets(sizes, weights=(3, 1, 2)):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    target, free, budget = {}, set(names), 1.5 * sum(sizes.values())
    while free:
        left = budget - sum(target.values())
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 2 * sizes[s]]
        if not over:
            return {**target, **share}
        for s in over:
            target[s] = 2.0 * sizes[s]
            free.discard(s)
    return target


def test_mixing(spark):
    rng = random.Random(3)
    rows = [(i, prose(i, rng.randint(0, 60)), "en", rng.choice(["a", "a", "a", "b", "c", "é", "\U0001f600", None, ""]),
             0, "", "", "", "", "", 0) for i in range(900)] + document_rows()
    got = mixing.mix(documents(spark, rows)).collect()
    again = mixing.mix(documents(spark, rows).repartition(5), bins=7).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, again), key=repr)
    assert len(got) == len(rows)
    sizes, taken, largest = {}, {}, {}
    for r in got:
        sizes[r.source] = sizes.get(r.source, 0) + r["size"]
        taken[r.source] = taken.get(r.source, 0) + r.taken
        largest[r.source] = max(largest.get(r.source, 0), r["size"])
        assert r.taken in (0, r["size"], 2 * r["size"])
    target = plain_targets(sizes)
    assert sum(target.values()) == pytest.approx(1.5 * sum(sizes.values()))
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(target[r.source])
        assert r.taken >= r["size"] * math.floor(r.target / r.source_size + 1e-12) if r.source_size else r.taken == 0
    for s in sizes:
        assert abs(taken[s] - target[s]) <= largest[s] / 2 + 1e-6
    by_id = {}
    for r in rows:
        by_id.setdefault(r[0], []).append(len(SPACE.findall(r[1] or "")))
    assert sorted(r["size"] for r in got) == sorted(x for v in by_id.values() for x in v)
    assert mixing.mix(documents(spark, [])).count() == 0


def test_mixing_bins_follow_the_rows_and_sources_are_bounded(spark, monkeypatch):
    want = sorted(map(tuple, mixing.mix(documents(spark)).collect()), key=repr)
    monkeypatch.setattr(mixing, "ROWS_A_BIN", 2)
    assert sorted(map(tuple, mixing.mix(documents(spark)).collect()), key=repr) == want
    monkeypatch.setattr(mixing, "MAX_SOURCES", 2)
    with pytest.raises(ValueError, match="more than 2 sources"):
        mixing.mix(documents(spark))


def test_mixing_prefers_quality(spark):
    rows = [(i, ("word " if i % 2 else "12 3 ") * 20, "en", "a" if i < 2000 else f"b{i}", 0, *[""] * 5, 0)
            for i in range(2000)]
    rows += [(5000 + i, "x " * 60000, "en", f"z{i}", 0, *[""] * 5, 0) for i in range(2)]
    got = [r for r in mixing.mix(documents(spark, rows)).collect() if r.source == "a"]
    mean = [sum(r.taken / r["size"] for r in got if r.doc_id % 2 == k) / 1000 for k in (0, 1)]
    assert got[0].target < 2 * got[0].source_size or mean == [2, 2]
    assert mean[1] >= mean[0]


def turn_rows():
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "a <|end|> b"), (1, 2, "user", "more"),
            (2, 0, "system", "s"), (2, 1, "user", "q"), (2, 2, "assistant", "é\U0001f600"), (2, 2, "assistant", "é\U0001f600"),
            (3, 0, "user", "only"), (4, 1, "assistant", None), (4, 0, None, "x"), (None, 0, "assistant", "n"),
            (5, None, "user", "u"), (5, 3, "assistant", ""), (6, 0, "user", "hi"), (6, 1, "assistant", "")]
    return rows


def test_chat_pairs_equal_brute_force(spark):
    df = spark.createDataFrame([(*r, "x") for r in turn_rows()],
                               "conv_id bigint, turn bigint, role string, text string, prompt string")
    want = plain_preferences(turn_rows())
    got = chat.format_preferences(chat.reply_pairs(chat.conversations(df)))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    assert chat.format_preferences(chat.reply_pairs(chat.conversations(df.limit(0)))).count() == 0


def plain_preferences(rows):
    talks, alone = {}, []
    for c, n, role, text in rows:
        turn = ((n is not None, n or 0), role or "", text or "")
        if c is None:
            alone.append((None, [turn]))
        elif n is None or turn not in talks.setdefault(c, []):
            talks.setdefault(c, []).append(turn)
    parted = []
    for c, turns in [*alone, *talks.items()]:
        t = [x[1:] for x in sorted(turns)]
        replies = [i for i, x in enumerate(t) if x[0] == "assistant"]
        if not replies:
            parted.append((c, t, []))
            continue
        cut = max((i + 1 for i, x in enumerate(t[:replies[-1]]) if x[0] == "user"), default=0)
        parted.append((c, t[:cut], t[cut:]))
    tails = [x for x in parted if x[2]]
    tails.sort(key=lambda x: (x[0] is not None, x[0] or 0, int(hashlib.md5("\n".join(
        f"{r}:{w}" for r, w in x[2]).encode()).hexdigest()[:15], 16)))

    def render(turns):
        at, out, spans = 0, "", []
        for role, text in turns:
            head = f"<|{role}|>\n"
            piece = head + text.replace("<|", "< |") + "<|end|>\n"
            if role == "assistant":
                spans.append(f"{at + len(head)}-{at + len(piece)}")
            out, at = out + piece, at + len(piece)
        return out, ",".join(spans)

    pairs = [(c, before + tail, before + tails[(i + 1) % len(tails)][2]) for i, (c, before, tail) in enumerate(tails)]
    pairs += [(c, before, before) for c, before, tail in parted if not tail]
    out = []
    for c, a, b in pairs:
        n = 0
        while n < min(len(a), len(b)) and a[n] == b[n]:
            n += 1
        out.append((c, n, render(a[:n])[0], render(a[n:])[0], render(b[n:])[0], render(a[n:])[1], render(b[n:])[1]))
    return out


def test_chat_sql_agrees_on_literal_rows(spark, tmp_path):
    """Null ids, numbers, roles and texts, repeats, replies in several turns that begin alike."""
    import duckdb

    from storelens.llm import registry
    rng = random.Random(8)
    rows = turn_rows() + [
        (10, None, "user", "hm"), (10, None, "user", "hm"), (10, 1, "assistant", "r"), (10, 1, "assistant", "r"),
        (11, 0, "user", "q"), (11, 1, "assistant", "look"), (11, 2, "tool", "t"), (11, 3, "assistant", "done"), (11, 4, "user", "ty"),
        (12, 0, "user", "p"), (12, 1, "assistant", "look"), (12, 2, "tool", "t"), (12, 3, "assistant", "failed"),
        (13, 0, "assistant", "look"), (14, 0, "user", "x"), (14, 1, "user", "y"), (None, None, None, None), (None, 3, "user", "z"),
        (None, 1, "assistant", "n"), (None, 1, "assistant", "n"), (15, None, None, None)]
    rows += [(20 + i // 5, rng.choice([None, 0, 1, 2, 3]), rng.choice(["user", "assistant", "tool", None]),
              rng.choice(["a", "b", "<|x", None])) for i in range(200)]
    spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").write.parquet(
        f"{tmp_path}/conversations.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    rel = con.execute(registry.ORACLE["op9_chat_preferences"])
    names = [d[0] for d in rel.description]
    sql = sorted(map(tuple, rel.fetchall()), key=repr)
    got = registry.QUERIES["op9_chat_preferences"](spark, str(tmp_path))
    assert got.columns == names
    assert sorted(map(tuple, got.collect()), key=repr) == sql == sorted(plain_preferences(rows), key=repr)
    assert len(sql) == len({r[0] for r in rows if r[0] is not None}) + sum(r[0] is None for r in rows)
    assert any(r[3].count("<|end|>") > 1 and r[1] > 1 for r in sql)


def test_chat_prefix_is_the_longest(spark):
    kind = "array<struct<role:string,text:string>>"
    rng = random.Random(2)
    rows = [(i, [(rng.choice("ua"), rng.choice("xy")) for _ in range(rng.randint(0, 4))],
             [(rng.choice("ua"), rng.choice("xy")) for _ in range(rng.randint(0, 4))]) for i in range(200)]
    df = spark.createDataFrame(rows, f"id int, chosen {kind}, rejected {kind}")
    got = {r.id: r.n_common for r in chat.format_preferences(df).collect()}
    for i, a, b in rows:
        n = 0
        while n < min(len(a), len(b)) and a[n] == b[n]:
            n += 1
        assert got[i] == n
