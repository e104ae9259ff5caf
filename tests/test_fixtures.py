"""Inline fixtures with exact answers (the reference's own unit values)."""

import math

import pytest
from pyspark.sql import functions as F

from tessera.functions.clf import parse_clf
from tessera.functions.text import simple_tokenize, tokenize
from tessera.operators import ratings as R
from tessera.operators import relational as P
from tessera.operators import text as E
from tessera.sources.tables import range_table


def one_col(spark, values, name="value", typ="string"):
    return spark.createDataFrame([(v,) for v in values], f"{name} {typ}")


def test_sum_range(spark):
    df = range_table(spark, 0, 100000, num_partitions=8)
    assert P.sum_all(df, "id").first()["total"] == 4999950000
    sevens = df.where(F.col("id") % 7 == 0)
    assert P.sum_all(sevens, "id").first()["total"] == 714264285


LINE = ('127.0.0.1 - - [01/Aug/1995:00:00:01 -0400] '
        '"GET /images/launch-logo.gif HTTP/1.0" 200 1839')


def test_clf_parse_line(spark):
    r = parse_clf(one_col(spark, [LINE])).first()
    assert r["parse_status"] == "parsed"
    assert (r["host"], r["client_identd"], r["user_id"]) == ("127.0.0.1", "-", "-")
    assert str(r["date_time"]) == "1995-08-01 00:00:01"
    assert (r["method"], r["endpoint"], r["protocol"]) == ("GET", "/images/launch-logo.gif",
                                                           "HTTP/1.0")
    assert (r["response_code"], r["content_size"]) == (200, 1839)


def test_clf_parse_edge_cases(spark):
    lines = [
        LINE.replace('HTTP/1.0"', 'HTTP/1.0 "'),          # blank before the quote
        LINE.replace(" HTTP/1.0", ""),                    # no protocol
        LINE.replace("1839", "-"),                        # size '-' → 0
        LINE.replace("Aug", "Foo"),                       # impossible month
        LINE.replace("1839", "12x"),                      # size not a number
        "garbage line",
        LINE.replace("127.0.0.1", "a\u0001b"),            # separator char in the line
    ]
    rows = parse_clf(one_col(spark, lines)).collect()
    st = [r["parse_status"] for r in rows]
    assert st == ["parsed", "parsed", "parsed", "failed", "failed", "failed", "parsed"]
    assert rows[0]["protocol"] == "HTTP/1.0"
    assert rows[1]["protocol"] == "" and rows[1]["endpoint"] == "/images/launch-logo.gif"
    assert rows[2]["content_size"] == 0
    assert rows[6]["host"] == "a\u0001b" and rows[6]["content_size"] == 1839


@pytest.mark.parametrize("text,expected", [
    ("A quick brown fox jumps over the lazy dog.",
     ["a", "quick", "brown", "fox", "jumps", "over", "the", "lazy", "dog"]),
    (" ", []),
    ("!!!!123A/456_B/789C.123A", ["123a", "456_b", "789c", "123a"]),
    ("fox fox", ["fox", "fox"]),
])
def test_simple_tokenize(spark, text, expected):
    r = one_col(spark, [text]).select(simple_tokenize(F.col("value")).alias("t")).first()
    assert list(r["t"]) == expected


@pytest.mark.parametrize("text,expected", [
    ("Why a the?", []),
    ("Being at the_?", ["the_"]),
    ("A quick brown fox jumps over the lazy dog.",
     ["quick", "brown", "fox", "jumps", "lazy", "dog"]),
])
def test_tokenize_stopwords(spark, text, expected):
    r = one_col(spark, [text]).select(tokenize(F.col("value")).alias("t")).first()
    assert list(r["t"]) == expected


def tf_of(spark, text):
    docs = spark.createDataFrame([(1, text)], "id long, text string")
    tf = E.term_frequency(E.doc_tokens(docs))
    return {r["token"]: r["tf"] for r in tf.collect()}


def test_term_frequency(spark):
    tf = tf_of(spark, "A quick brown fox jumps over the lazy dog.")
    assert tf == {t: 1 / 6 for t in ["quick", "brown", "fox", "jumps", "lazy", "dog"]}
    tf = tf_of(spark, "one_ one_ two!")
    assert tf == pytest.approx({"one_": 2 / 3, "two": 1 / 3})


def vec(spark, d):
    return spark.createDataFrame([(k, float(v)) for k, v in d.items()], "token string, w double")


def test_dot_norm_cosine(spark):
    a = vec(spark, {"foo": 2, "bar": 3, "baz": 5})
    b = vec(spark, {"foo": 1, "bar": 0, "baz": 20})
    assert E.sparse_dot(a, b).first()["dot"] == 102
    norm = a.agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("n")).first()["n"]
    assert abs(norm - 6.16441400297) < 1e-7
    c = E.cosine_of(a, b).first()["cosine"]
    assert c == pytest.approx(102 / (math.sqrt(38) * math.sqrt(401)))


def test_invert(spark):
    w = spark.createDataFrame([(1, "foo", 2.0)], "id long, token string, w double")
    assert [tuple(r) for r in E.inverted_index(w).collect()] == [("foo", 1)]


def test_count_and_mean(spark):
    rows = ([(1, 0, float(x)) for x in (1, 2, 3, 4)] + [(100, 0, x) for x in (10.0, 20.0, 30.0)]
            + [(110, 0, float(x)) for x in range(20)])
    df = spark.createDataFrame(rows, "item int, user int, rating double")
    got = {r["item"]: (r["n_ratings"], r["avg_rating"])
           for r in R.item_rating_stats(df).collect()}
    assert got == {1: (4, 2.5), 100: (3, 20.0), 110: (20, 9.5)}


def test_total_order_sort(spark):
    t1 = [(1, "alpha"), (2, "alpha"), (2, "beta"), (3, "alpha"), (1, "epsilon"), (1, "delta")]
    t2 = [(1, "delta"), (2, "alpha"), (2, "beta"), (3, "alpha"), (1, "epsilon"), (1, "alpha")]
    out = []
    for t in (t1, t2):
        df = spark.createDataFrame([(i, float(k), w) for i, (k, w) in enumerate(t)],
                                   "item int, avg_rating double, title string")
        out.append([(r["avg_rating"], r["title"]) for r in
                    R.sort_total_order(df.drop("item").withColumn("item", F.lit(0)),
                                       ascending=True).collect()])
    assert out[0] == out[1]
    assert out[0][0] == (1.0, "alpha") and out[0][-1] == (3.0, "alpha")


def ratings_df(spark, rows):
    return spark.createDataFrame(rows, "user int, item int, rating double")


def test_rmse(spark):
    pred = ratings_df(spark, [(1, 1, 5.0), (1, 2, 3.0), (1, 3, 4.0), (2, 1, 3.0), (2, 2, 2.0),
                              (2, 3, 4.0)])
    actual = ratings_df(spark, [(1, 2, 3.0), (1, 3, 5.0), (2, 1, 5.0), (2, 2, 1.0)])
    pred2 = ratings_df(spark, [(2, 2, 5.0), (1, 2, 5.0)])
    e1 = R.rmse(pred, actual, "rating").first()["rmse"]
    e2 = R.rmse(pred2, actual, "rating").first()["rmse"]
    e3 = R.rmse(actual, actual, "rating").first()["rmse"]
    assert abs(e1 - 1.22474487139) < 1e-8
    assert abs(e2 - 3.16227766017) < 1e-8
    assert abs(e3) < 1e-8


def test_count_by_value(spark):
    df = one_col(spark, [1, 2, 3, 1, 2, 3, 1, 2, 1, 2, 3, 3, 3, 4, 5, 4, 6], "v", "int")
    got = {r["v"]: r["n"] for r in P.count_by_value(df, "v").collect()}
    assert got == {1: 4, 2: 4, 3: 5, 4: 2, 5: 1, 6: 1}


def test_sum_by_key(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "k string, v int")
    assert {r["k"]: r["total"] for r in P.sum_by_key(df, "k", "v").collect()} == {"a": 3, "b": 1}


def test_flat_map(spark):
    words = one_col(spark, ["cat", "elephant", "rat", "rat", "cat"], "word")
    assert P.flat_map_plural(words).count() == 10
    nested = P.map_nested_plural(words).collect()
    assert len(nested) == 5 and list(nested[0]["forms"]) == ["cat", "cats"]


def test_flat_map_range(spark):
    df = one_col(spark, [2, 3, 4, 1, 0], "x", "int")
    got = sorted((r["x"], r["k"]) for r in P.flat_map_range(df, "x").collect())
    assert got == [(2, 1), (3, 1), (3, 2), (4, 1), (4, 2), (4, 3)]


def test_regex_lookbehind(spark):
    r = one_col(spark, ["abcdef"]).select(
        F.regexp_extract("value", "(?<=abc)def", 0).alias("m")).first()
    assert r["m"] == "def"
