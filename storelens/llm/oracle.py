"""DuckDB SQL of the corpus queries that SQL can express, from their definitions.

Language id, the site style tree, SimHash and one-permutation MinHash rest on
hashes or floating-point models that DuckDB has no equal of; tests/llm holds those
against brute-force versions in Python.
"""

from __future__ import annotations

import re

from storelens.llm.license_scan import TEMPLATES

SPACE_WORD = r"'[^\x20\x09-\x0D]+'"
PLAIN_WORD = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
FOLDED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SUBSTRING_DEDUP = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id,
                     regexp_extract_all(coalesce(text, ''), {SPACE_WORD}) AS w FROM documents),
windows AS (SELECT r, i, md5(array_to_string(w[i:i + 34], ' ')) AS h
            FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS i FROM docs WHERE len(w) >= 35) t),
starts AS (SELECT r, i FROM windows WHERE h IN (SELECT h FROM windows GROUP BY h HAVING count(*) > 1)),
gone AS (SELECT DISTINCT r, i + k AS i FROM starts, range(35) AS o(k)),
kept AS (SELECT t.r, string_agg(word, ' ' ORDER BY t.i) AS text, count(*) AS n
         FROM (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM docs) t
         ANTI JOIN gone g ON t.r = g.r AND t.i = g.i GROUP BY t.r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k.text, '')) AS kept_sha256
FROM docs LEFT JOIN kept k USING (r)"""

URL_FILTER = r"""
WITH rules(rule_host, rule_path, effect) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
    ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
cut AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
               regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path FROM pages),
fits AS (SELECT page_id, host, path, rule_host || rule_path AS rule, effect
         FROM cut LEFT JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host))
                                 AND starts_with(path, rule_path))
SELECT page_id, host, path, rule, coalesce(effect, 'allow') AS verdict FROM fits
QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(rule) DESC NULLS LAST) = 1"""

MIXING = rf"""
WITH docs AS (
    SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), {SPACE_WORD})) AS BIGINT) AS size,
           -ln((CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')), 1, 13)
                     AS BIGINT) + 0.5) / 4503599627370496.0)
           / (0.25 + coalesce(length(regexp_replace(text, '[\x00-\x40\x5B-\x60\x7B-\x7F]+', '', 'g'))
                              / NULLIF(length(text), 0), 0)) AS key
    FROM documents),
sources AS (SELECT source, CAST(sum(size) AS DOUBLE) AS s FROM docs GROUP BY source),
weighed AS (SELECT source, s, 2 * s AS cap,
                   [3.0, 1.0, 2.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS w
            FROM sources),
levels AS (SELECT *, (1.5 * sum(s) OVER () - coalesce(sum(cap) OVER (up ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                     / sum(w) OVER (up ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
           FROM weighed WINDOW up AS (ORDER BY cap / w, source NULLS LAST)),
targets AS (SELECT source, s, coalesce(least(cap, w * max(CASE WHEN cap / w >= level THEN level END) OVER ()), cap) AS target
            FROM levels)
SELECT doc_id, size, CAST(s AS BIGINT) AS source_size, target,
       CAST(size * (CASE WHEN s > 0 THEN floor(target / s) ELSE 0 END
            + CASE WHEN coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY key, size, doc_id
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + size / 2.0
                        <= target - CASE WHEN s > 0 THEN floor(target / s) ELSE 0 END * s THEN 1 ELSE 0 END)
            AS BIGINT) AS taken
FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source"""

DECONTAMINATION = f"""
WITH docs AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), {PLAIN_WORD}) AS w FROM documents),
items AS (SELECT item_id, regexp_extract_all(lower(coalesce(text, '')), {PLAIN_WORD}) AS w FROM benchmark),
wanted AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS s
           FROM (SELECT item_id, w, least(5, len(w)) AS n, unnest(range(1, len(w) - least(5, len(w)) + 2)) AS i
                 FROM items WHERE len(w) > 0) t),
there AS (SELECT DISTINCT doc_id, n, array_to_string(w[i:i + n - 1], ' ') AS s
          FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
                FROM docs, (SELECT DISTINCT n FROM wanted) lengths WHERE len(w) >= n) t),
shared AS (SELECT doc_id, item_id, count(*) AS n_shared FROM there JOIN wanted USING (n, s) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, n_shared / total AS containment, CAST(n_shared AS BIGINT) AS n_shared
FROM shared JOIN (SELECT item_id, count(*) AS total FROM wanted GROUP BY item_id) sizes USING (item_id)
WHERE n_shared >= 0.8 * total"""



def _wording(markup: str) -> str:
    """A license template as a pattern over words with a space of their own on either side."""
    out = []
    for piece in re.findall(r"\[\[|\]\]|\{\{[^{}]*\}\}|[0-9A-Za-z]+", markup):
        region = re.fullmatch(r"\{\{\w+(?::(\d+)-(\d+))?\}\}", piece)
        if piece in ("[[", "]]"):
            out.append("(?:" if piece == "[[" else ")?")
        elif region:
            out.append("(?: [^ ]+ )" + (f"{{{region[1]},{region[2]}}}?" if region[1] else "*?"))
        else:
            out.append(f" {piece.lower()} ")
    return "".join(out)


# Wordings that hold another one whole, which then counts only where it stands more often.
_AROUND = {"mit-license": "x11", "mpl-2.0-notice": "mpl-2.0-text"}


def _stands(label: str) -> str:
    line = "' ' || array_to_string(w, '  ') || ' '"
    if label not in _AROUND:
        return f"regexp_matches({line}, '{_wording(TEMPLATES[label])}')"
    many, around = (f"len(regexp_extract_all({line}, '{_wording(TEMPLATES[x])}'))" for x in (label, _AROUND[label]))
    return f"{many} > {around}"

LICENSE_SCAN = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({FOLDED}, {PLAIN_WORD}) AS w FROM documents),
phrases(p, label) AS (VALUES (['gnu', 'general', 'public', 'license'], 'gpl'), (['apache', 'license'], 'apache'),
                             (['cc', 'by'], 'cc-by'), (['mit', 'license'], 'mit')),
places AS (SELECT r, i - 1 AS spot, label
           FROM (SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM docs) t JOIN phrases ON w[i] = p[1]
           WHERE w[i:i + len(p) - 1] = p),
base AS (SELECT r, count(*) AS n, min(spot) AS a, max(spot) AS b, list(DISTINCT label) AS labels FROM places GROUP BY r),
own AS (SELECT r, list_filter([{", ".join(f"CASE WHEN {_stands(k)} THEN '{k}' END" for k in TEMPLATES)}],
                              lambda x: x IS NOT NULL) AS labels FROM docs)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_base,
       CAST(a AS BIGINT) AS first_word, CAST(b AS BIGINT) AS last_word,
       array_to_string(list_sort(coalesce(base.labels, [])), ',') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(own.labels, [])))), ',')
           AS labels,
       CAST(CASE WHEN len(own.labels) > 0 THEN 1 WHEN base.r IS NOT NULL THEN 0.5 ELSE 0 END AS DOUBLE) AS score
FROM docs LEFT JOIN base USING (r) LEFT JOIN own USING (r)"""

CHAT_PREFERENCES = r"""
WITH rows AS (SELECT row_number() OVER () AS r, conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
              FROM conversations),
-- a numbered turn stands once, one without a number as often as it is said; no conv_id: a conversation a row
told AS (SELECT conv_id, role, text, turn, min(r) AS r, CASE WHEN conv_id IS NULL THEN min(r) END AS alone
         FROM rows GROUP BY conv_id, turn, role, text, CASE WHEN conv_id IS NULL OR turn IS NULL THEN r END),
talks AS (SELECT conv_id, alone, list({'role': role, 'text': text} ORDER BY turn NULLS FIRST, role, text) AS t
          FROM told GROUP BY conv_id, alone),
replied AS (SELECT *, coalesce(list_max(list_filter(range(1, len(t) + 1), lambda i: t[i].role = 'assistant')), 0) AS reply
            FROM talks),
parted AS (SELECT *, t[1:cut] AS before, t[cut + 1:] AS tail FROM (
           SELECT *, CASE WHEN reply = 0 THEN len(t) ELSE coalesce(list_max(list_filter(
                      range(1, reply + 1), lambda i: t[i].role = 'user')), 0) END AS cut FROM replied) x),
tied AS (SELECT *, CASE WHEN conv_id IS NULL THEN CAST('0x' || substr(md5(array_to_string(list_transform(
                tail, lambda x: x.role || ':' || x.text), chr(10))), 1, 15) AS BIGINT) ELSE 0 END AS tie
         FROM parted WHERE len(tail) > 0),
pairs AS (SELECT conv_id, before || tail AS a, before || coalesce(
                 lead(tail) OVER (ORDER BY conv_id NULLS FIRST, tie),
                 first_value(tail) OVER (ORDER BY conv_id NULLS FIRST, tie)) AS b FROM tied
          UNION ALL SELECT conv_id, before, before FROM parted WHERE len(tail) = 0),
alike AS (SELECT *, len(list_filter(range(1, least(len(a), len(b)) + 1), lambda i: a[1:i] = b[1:i])) AS n FROM pairs),
spoken AS (SELECT conv_id, n, list_transform(a, lambda x: {'role': x.role, 't': '<|' || x.role || '|>' || chr(10)
                  || replace(x.text, '<|', '< |') || '<|end|>' || chr(10)}) AS a,
                  list_transform(b, lambda x: {'role': x.role, 't': '<|' || x.role || '|>' || chr(10)
                  || replace(x.text, '<|', '< |') || '<|end|>' || chr(10)}) AS b FROM alike),
cut AS (SELECT conv_id, n, a[1:n] AS p, a[n + 1:] AS a, b[n + 1:] AS b FROM spoken),
ends AS (SELECT *, list_transform(range(1, len(a) + 1), lambda i: CAST(list_sum(list_transform(a[1:i], lambda x: length(x.t))) AS BIGINT)) AS ea,
                   list_transform(range(1, len(b) + 1), lambda i: CAST(list_sum(list_transform(b[1:i], lambda x: length(x.t))) AS BIGINT)) AS eb
         FROM cut)
SELECT conv_id, CAST(n AS INTEGER) AS n_common,
       array_to_string(list_transform(p, lambda x: x.t), '') AS prompt,
       array_to_string(list_transform(a, lambda x: x.t), '') AS chosen,
       array_to_string(list_transform(b, lambda x: x.t), '') AS rejected,
       array_to_string(list_transform(list_filter(range(1, len(a) + 1), lambda i: a[i].role = 'assistant'),
           lambda i: (ea[i] - length(a[i].t) + length(a[i].role) + 5) || '-' || ea[i]), ',') AS chosen_mask,
       array_to_string(list_transform(list_filter(range(1, len(b) + 1), lambda i: b[i].role = 'assistant'),
           lambda i: (eb[i] - length(b[i].t) + length(b[i].role) + 5) || '-' || eb[i]), ',') AS rejected_mask
FROM ends"""

_SQUARED = "list_sum(list_transform(range(1, 65), lambda i: (v.q[i] - c.q[i]) * (v.q[i] - c.q[i])))"


def _centroid_clusters(rounds: int) -> str:
    """Lloyd's rounds written out: a<r> deals the vectors to the centroids c<r>, c<r + 1> moves these."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
a{r} AS MATERIALIZED (SELECT r, vec_id, v.q, c.c, {_SQUARED} AS far FROM kept v, c{r} c
       QUALIFY row_number() OVER (PARTITION BY r ORDER BY far, c.c) = 1)""")
        if r < rounds:
            steps.append(f"""
c{r + 1} AS MATERIALIZED (SELECT c.c, coalesce(m.q, c.q) AS q FROM c{r} c LEFT JOIN (
    SELECT c, list((total - ((total % n) + n) % n) // n ORDER BY i) AS q FROM (
        SELECT c, i, sum(x) AS total, count(*) AS n
        FROM (SELECT c, unnest(q) AS x, unnest(range(1, 65)) AS i FROM a{r}) t GROUP BY c, i) s GROUP BY c) m USING (c))""")
    return f"""
WITH kept AS MATERIALIZED (
    SELECT row_number() OVER () AS r, vec_id,
           list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
    FROM embeddings WHERE len(embedding) = 64
         AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND coalesce(isfinite(x), false)))),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('2:' || coalesce(CAST(vec_id AS VARCHAR), '')), q) - 1 AS c, q
       FROM kept QUALIFY c < 40),{",".join(steps)}
SELECT vec_id, CAST(a.c AS INTEGER) AS cluster, CAST(far AS BIGINT) AS distance,
       CAST(sum(far) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia, CAST(sum(far) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c.q, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} c USING (c)"""


CENTROID_CLUSTERS = _centroid_clusters(5)

ORACLE: dict[str, str] = {
    "op1_substring_dedup": SUBSTRING_DEDUP,
    "op3_url_filter": URL_FILTER,
    "op6_mixing": MIXING,
    "op7_decontamination": DECONTAMINATION,
    "op8_license_scan": LICENSE_SCAN,
    "op9_chat_preferences": CHAT_PREFERENCES,
    "op11_centroid_clusters": CENTROID_CLUSTERS,
}
