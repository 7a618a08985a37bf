from contextlib import redirect_stdout
from io import StringIO

from pyspark.sql import functions as F

from tidepost.functions import text as T
from tidepost.functions.stem import stem_portuguese
from tidepost.operators import tfidf as X


def plan_of(df):
    with redirect_stdout(StringIO()) as out:
        df.explain()
    return out.getvalue()


def test_rows_are_stemmed_without_a_regular_expression_for_each_token(spark):
    tokens = [["Falando", None, "iremos"], [], None, ["a\x01b", "casas"], ["", "gatos"], ["iremos"]]
    df = spark.createDataFrame(list(enumerate(tokens)), "i int, t array<string>").select("i", stem_portuguese(F.col("t")).alias("s"))
    assert [r.s for r in df.orderBy("i").collect()] == [["fal", None, "irem"], [], None, ["a\x01b", "cas"], ["", "gat"], ["irem"]]
    assert "regexp_replace" not in plan_of(df) and "rlike" not in plan_of(df).lower()


def test_tokens_are_folded_at_once(spark):
    df = spark.createDataFrame([(["ΣΑΣ", "Straße"],), ([None, "A\x01"],)], "t array<string>")
    rows = [r[0] for r in df.select(T.over_tokens(F.col("t"), T.casefold)).collect()]
    assert rows == [["σασ", "strasse"], [None, "a\x01"]]


def test_normalized_text_is_made_once(spark):
    df = spark.createDataFrame([(1, "casa casa azul"), (2, "casa verde"), (3, "azul mar"), (4, None)], "row_id int, stemmed_text string")
    done = X.normalize_corpus(df)
    rows = {r.row_id: r for r in done.collect()}
    assert rows[4].tfidf == {} and set(rows[1].tfidf) == {"casa", "azul"} and rows[1].normalized_text == "casa casa azul"
    plan = plan_of(done)
    assert "regexp_replace" not in plan and "vector_to_array" not in plan.lower()
