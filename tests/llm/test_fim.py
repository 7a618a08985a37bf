import hashlib

from pyspark.sql import functions as F

from tidepost.llm import fim, queries


def brute(doc_id, text):
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i : 8 * i + 8], 16) for i in range(4))
    n = len(text)
    lo, hi = sorted((h1 % (n + 1), h2 % (n + 1)))
    pre, mid, suf = text[:lo], text[lo:hi], text[hi:]
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    if h4 % 100 < 20:
        return n, "spm", lo, hi - lo, "<S>" + suf + "<P>" + pre + "<M>" + mid
    return n, "psm", lo, hi - lo, "<P>" + pre + "<S>" + suf + "<M>" + mid


def run(docs):
    done = fim.fill_in_middle(docs)
    return done.select(
        "row.doc_id", "row.text", "fim.n", "fim.form", "fim.prefix_chars", "fim.middle_chars", "fim.output",
        fim.restore(F.col("fim.output"), F.col("fim.form")).alias("restored"),
    ).collect()


def test_matches_brute_force_on_awkward_rows(spark, awkward):
    rows = run(awkward)
    assert len(rows) == awkward.count()
    for r in rows:
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) == brute(r["doc_id"], r["text"])
        assert r["restored"] == (r["text"] or "")


def test_every_form_and_sentinels(spark):
    texts = [(i, "abc <x> déf 漢字 " * (i % 7) + str(i)) for i in range(300)] + [(1000, "has <S> inside"), (1001, "<M>"), (1002, "<")]
    rows = run(spark.createDataFrame(texts, "doc_id long, text string"))
    assert {r["form"] for r in rows} == {"plain", "psm", "spm"}
    for r in rows:
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) == brute(r["doc_id"], r["text"])
        assert r["restored"] == r["text"]
    assert all(r["form"] == "plain" for r in rows if r["doc_id"] in (1000, 1001))


def test_unit_of_ones_own(spark):
    """Graphemes as units: a letter with its combining mark is never cut apart."""
    text = "e\u0301" * 40
    docs = spark.createDataFrame([(i, text) for i in range(60)], "doc_id long, text string")
    rows = fim.fill_in_middle(docs, unit=r"\X").select("fim.n", "fim.form", "fim.prefix_chars", "fim.middle_chars").collect()
    assert {r["n"] for r in rows} == {40}
    assert all(r["prefix_chars"] % 2 == 0 and r["middle_chars"] % 2 == 0 for r in rows if r["form"] != "plain")
    partial = fim.fill_in_middle(spark.createDataFrame([(1, "ab1")], "doc_id long, text string"), unit="[a-z]")
    assert partial.select("fim.n", "fim.form").first() == (None, "plain")


def test_empty_table_and_query(spark, no_rows, tables):
    assert run(no_rows) == []
    got = queries.op11_fim(spark, tables).collect()
    docs = spark.read.parquet(f"{tables}/documents.parquet").select("doc_id", "text").collect()
    want = {}
    for d, t in docs:
        n, form, p, m, out = brute(d, t)
        want[d] = (n, form, p, m, hashlib.sha256(out.encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())
    assert {r["doc_id"]: tuple(r[1:]) for r in got} == want
