import pytest
from pyspark.sql import functions as F

from tidepost.functions import text as T, vectors as V
from tidepost.functions.stem import stem_portuguese
from tidepost.operators.clean import clean_corpus, stem_tokens


def apply(spark, function, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.out for r in df.select("i", function(F.col("v")).alias("out")).orderBy("i").collect()]


def test_truncate_date(spark):
    assert apply(spark, T.truncate_date, ["2026-01-02T03:04:05", "Tue Dec 10 07:00:30", None]) == [
        "2026-01-02", "Tue Dec 10", ""]


def test_split_pipe(spark):
    assert apply(spark, T.split_pipe, ["a||b|", "", None]) == [["a", "b"], [], []]


def test_redact_text(spark):
    values = ["see https://x.y/z @a_b #c  d", "m@x.org", "WWW.x.y #fé fim", "  "]
    assert apply(spark, T.redact_text, values) == [
        "see [url] [mention] [hashtag] d", "m[mention].org", "[url] [hashtag] fim", ""]


def test_bucketize_metric(spark):
    values = ["-5", "0", "1", "10", "11", "100", "1000", "10000", "10001", None, "abc", "1.5"]
    assert apply(spark, T.bucketize_metric, values) == [
        "1-10", "0", "1-10", "1-10", "11-100", "11-100", "101-1000", "1001-10000", "10000+", "0", "0", "0"]
    assert apply(spark, T.bucketize_metric, [12.9, -0.5], "double") == ["11-100", "0"]


def test_decorations_and_tokens(spark):
    assert apply(spark, T.remove_decorations, ["@user_name https://t.co/A"]) == ["@user name https   t.co A"]
    tokens = lambda c: T.tokenize_post(T.remove_decorations(c))
    assert apply(spark, tokens, ["☆．。 olá", "não-sei d'água fim.Agora 3,5 #t-x x.comé 🙂"]) == [
        ["olá"], ["não-sei", "d'água", "fim.Agora", "3,5", "#t-x", "x", "comé"]]


def test_long_runs_of_accents_are_shortened(spark):
    assert apply(spark, T.tokenize_post, ["ééééé aaaaa"]) == [["ééé", "aaaaa"]]


def test_remove_numeric_chunks(spark):
    assert apply(spark, T.remove_numeric_chunks, ["16 a 17, 3kg", "1 2 x", ""]) == ["a 17, 3kg", "x", ""]


def test_remove_stopwords_folds_case(spark):
    assert apply(spark, lambda c: T.remove_stopwords(c, ["não", "de"]), [["NÃO", "De", "Sim"]], "array<string>") == [["Sim"]]
    assert "não" in T.default_stop_words()


def test_normalize_text(spark):
    assert apply(spark, T.normalize_text, ["#Fé @ana oi!", "Straße https://a.b/c", "…"]) == ["fé oi", "strasse", ""]


def test_tokenize_w2v(spark):
    assert apply(spark, T.tokenize_w2v, ["nãooooo 16 a1"]) == [["nãooo", "a1"]]


def test_encoder_input(spark):
    df = spark.createDataFrame([("oi", " a | |b"), ("oi", ""), ("oi ", None)], "t string, h string")
    assert [r[0] for r in df.select(T.encoder_input(F.col("t"), F.col("h"))).collect()] == ["oi a b", "oi", "oi "]


def test_snippet(spark):
    assert apply(spark, lambda c: T.snippet(c, 3, True), ["a\nbcd", "abc"]) == ["a b...", "abc"]


def test_round_vector_is_half_even(spark):
    assert apply(spark, V.round_vector, [[5e-7, 1.5e-6, 2.5e-6]], "array<double>") == [[0.0, 2e-6, 2e-6]]


def test_parse_cells(spark):
    assert apply(spark, V.parse_vector, ["[1,2]", "oops", None]) == [[1.0, 2.0], None, None]
    assert apply(spark, V.parse_tokens, ['["a","b"]', "oops", None, '{"a":1}']) == [["a", "b"], [], [], []]


def test_json_text(spark):
    df = spark.sql("SELECT map('b', 1, 'a', 2) AS m, array('é') AS a")
    assert tuple(df.select(V.to_sorted_json_text(F.col("m")), V.to_json_text(F.col("a"))).first()) == (
        '{"a":2,"b":1}', '["é"]')


# Word and stem as published with the algorithm's description.
STEMS = {
    "boa": "boa", "boainha": "boainh", "boas": "boas", "bôas": "bôas", "bobagem": "bobag",
    "química": "químic", "quilométricas": "quilométr", "quimicamente": "quimic",
    "felicidade": "felic", "população": "popul", "revolução": "revolu", "inteligência": "inteligent",
    "rapidamente": "rapid", "positivamente": "posit", "psicologia": "psicolog", "primeiras": "primeir",
    "cantávamos": "cant", "comer": "com", "pegue": "peg", "almoço": "almoc", "corações": "coraçõ",
}


def test_stems(spark):
    stems = apply(spark, stem_portuguese, [list(STEMS)], "array<string>")[0]
    assert dict(zip(STEMS, stems)) == STEMS


def test_stem_map_replaces_the_rules(spark):
    df = spark.createDataFrame([(1, ["Foo", "bar", "foo"]), (2, [])], "row_id int, tokens array<string>")
    known = spark.createDataFrame([("foo", "f")], "token string, stem string")
    rows = stem_tokens(df, "tokens", "row_id", known).orderBy("row_id").collect()
    assert [r.stemmed_text for r in rows] == ["f bar f", ""]


def test_clean_corpus_can_strip_urls_first(spark):
    df = spark.createDataFrame([(1, "veja https://t.co/A agora"), (2, None)], "row_id int, text string")
    kept = clean_corpus(df, stop_words=[]).orderBy("row_id").collect()
    assert kept[0].tokens == ["veja", "https", "t.co", "A", "agora"] and kept[1].tokens == []
    assert clean_corpus(df, stop_words=[], strip_urls_first=True).orderBy("row_id").first().tokens == ["veja", "agora"]
    with pytest.raises(ValueError, match="missing columns"):
        clean_corpus(df.drop("text"))


@pytest.mark.parametrize("unit", ["a.", "a@", "x@a.", "a-", "1 ", "#a'", "http://", "@", ".", "a"])
def test_tokenizers_stay_linear_on_long_runs(spark, unit):
    text = "x@a" + ".a" * 50_000 + "bb" if unit == "x@a." else unit * (100_000 // len(unit))
    df = spark.createDataFrame([(text + " fim",)], "t string")
    row = df.select(T.tokenize_post(F.col("t")).alias("a"), T.tokenize_w2v(F.col("t")).alias("b")).first()
    assert row.a[-1] == "fim" and row.b[-1] == "fim"
