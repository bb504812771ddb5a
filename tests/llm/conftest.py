import random

import pytest

CLASHING = ["id", "row", "h", "body", "key", "node", "root", "doc", "kept", "line", "place", "token", "n", "words", "spans", "score", "label", "_row", "_removed"]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, columns whose names the operators use."""
    draw = random.Random(5)
    words = ["der", "die", "und", "haus", "the", "and", "house", "of", "le", "la", "maison", "été", "x1", "straße", "a.", "b,"]
    prose = [" ".join(draw.choice(words) for _ in range(draw.randint(1, 90))) for _ in range(40)]
    prose = [p.replace(" x1 ", "\n") for p in prose]
    shared = " ".join(draw.choice(words) for _ in range(60))
    long_text = " ".join(draw.choice(words) + str(draw.randint(0, 999)) for _ in range(30_000))
    rows = [(i, p, draw.choice(["de", "en", None]), f"site{i % 12}") for i, p in enumerate(prose)]
    rows += [
        (100, None, "en", "site1"), (101, "", "en", "site2"), (102, " \t\n ", None, None), (103, long_text, "en", "site3"), (104, long_text, "de", "site4"),
        (105, shared, "en", "site5"), (106, shared, "en", "site6"), (107, "vor " + shared + " nach", "de", "site7"), (107, "vor " + shared + " nach", "de", "site7"),
        (108, "!!! 123 ...", "en", "site8"), (None, shared, "en", "site9"), (None, "ohne id " + shared, None, None), (109, "a" * 5000, "en", "site1"),
        (110, "日本語のテキスト" * 60, "ja", "site2"), (111, "\x00 \x1f \x85 x", "en", "site3"), (112, prose[0], None, None), (105, "andere zeile", "de", None),
    ]
    full = [(i, t, lang, site, None if t is None else len(t), *["clash"] * len(CLASHING)) for i, t, lang, site in rows]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHING)
    return spark.createDataFrame(full, schema).repartition(3)


@pytest.fixture(scope="session")
def none_of(odd):
    return odd.filter("doc_id < -1")


@pytest.fixture(scope="session")
def odd_rows(odd):
    return [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
