import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, part int, row string, `_row` int, least int, score double, fingerprint string"


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls, empty and long texts, ties, repeated rows, and columns named like the operators' own."""
    words = "the quick brown fox jumps over a lazy dog while seven wizards calmly vex the jumbo pack of quartz liquor".split()
    plain = " ".join(words[(i * i + i // 19) % len(words)] + (str(i) if i % 3 == 0 else "") for i in range(260))
    texts = [
        (1, None), (2, ""), (3, " \n\t "), (4, plain), (4, plain), (None, plain), (5, plain + " end"), (6, "a"), (6, "b"),
        (7, "long " * 30_000), (8, "token = abcdef123456 mail a.b@c-d.org +49 (30) 1234-5678 10.0.0.255 4111 1111 1111 1111"),
        (9, "x" * 50_000), (10, "é ß 漢字 ｶﾅ \x1c end\r\n\r\n  two  spaces "), (11, "İstanbul don't. 12,5% (a)b'c"), (None, None),
    ]
    return spark.createDataFrame([(d, t, "en" if i % 2 else None, "s", 1, 2, "r", 3, 4, 0.5, "f") for i, (d, t) in enumerate(texts)], SCHEMA)


@pytest.fixture(scope="session")
def no_rows(awkward):
    return awkward.filter("false")


def rows_of(docs):
    return [(r["doc_id"], r["text"] or "") for r in docs.select("doc_id", "text").collect()]
