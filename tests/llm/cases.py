"""Small tables with the awkward rows every operator has to stand."""

from __future__ import annotations

import random

DOC_SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, "
              "raw string, k1 string, host string, fp string, items string, start int")
# columns that operators use inside, and outputs in other letters
CLASHES = {name: "'x'" for name in (
    "__host", "__blocks", "__judged", "__lang", "__items0", "__scan", "__a", "__b", "scanned", "judged", "judged_", "told", "site_host",
    "site_html", "one", "other", "cut", "at", "key", "c0", "row", "h1", "N_WORDS", "Kept_Text", "Host", "VERDICT", "Lang_Pred",
    "SCORE", "Items", "Fingerprint", "COMPONENT_ID", "Labels", "Chosen_Mask", "N_Common", "Toxic_Words", "Size", "TAKEN")}


def vocabulary(seed: int, n: int = 400) -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choice("abcdefgéöñ") for _ in range(rng.randint(2, 7))) for _ in range(n)]


def prose(seed: int, n: int, words: list[str] | None = None) -> str:
    rng = random.Random(seed)
    words = words or vocabulary(1)
    return "".join(rng.choice(words) + rng.choice([" ", " ", " ", "\n", "\t "]) for _ in range(n)).strip()


def document_rows() -> list[tuple]:
    """Nulls in every column, empty and blank texts, a very long one, copies, near copies,
    shared passages, repeats inside one text, repeated rows, ids that stand twice."""
    passage = prose(5, 60)
    long = prose(6, 30_000)
    base = prose(7, 120)
    texts = [
        (1, base, "en", "a"), (2, base, "en", "a"), (3, base + " extra", "en", "a"),
        (4, prose(8, 40) + " " + passage + " " + prose(9, 30), "de", "b"),
        (5, prose(10, 10) + "\n" + passage, "de", "b"),
        (6, passage + " " + passage, None, "c"),
        (7, "", "en", None), (8, None, "en", "c"), (9, " \t\n ", "de", "a"), (10, "...!? 123", "de", "a"),
        (11, long, "en", "b"), (12, "x", "en", "c"), (13, "one two", "en", "c"),
        (14, "la " * 200, "fr", "c"), (None, base, "en", "a"), (None, None, None, None),
        (15, prose(11, 300), "en", "a"), (15, prose(11, 300), "en", "a"), (15, prose(12, 50), "en", "a"),
        (16, "ÀÉ ß 漢字 \U0001f600 ok", "fr", ""), (17, base.replace("a", "b", 1), "en", "a"),
        (18, "word " * 34, "en", "b"), (19, "word " * 35, "en", "b"),
    ]
    return [(i, t, la, s, None if t is None else len(t), "raw", None, "h", "f", "it", 1) for i, t, la, s in texts]


def documents(spark, rows=None):
    return spark.createDataFrame(document_rows() if rows is None else rows, DOC_SCHEMA)
