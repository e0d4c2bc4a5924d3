"""Column profile (A11-A18, X16), dedup (W1, W2, P19) and tokens."""

from pyspark.sql import functions as F

from slotwise.operators.dedup import first_per_key, match_or
from slotwise.operators.profile import column_profile, group_count, profile_report, value_frequency
from slotwise.operators.tokens import token_sort, total_count, word_counts


def test_profile_blank_null_lengths(spark):
    vals = [None, "", " ", "\t", " ", "x"]
    df = spark.createDataFrame([(v, i) for i, v in enumerate(vals)], "v string, i int")
    p = {r.column_name: r for r in column_profile(df, "db", "t").collect()}
    v = p["v"]
    assert (v.row_count, v.distinct_count, v.is_distinct, v.has_blanks, v.has_nulls, v.max_length, v.min_length) == \
        (6, 6, True, True, True, 4, 0)
    i = p["i"]
    assert (i.is_distinct, i.has_blanks, i.has_nulls, i.max_length, i.min_length) == (True, False, False, 1, 1)
    approx = {r.column_name: r for r in column_profile(df, approx=True).collect()}
    assert approx["v"].distinct_count == 6 and approx["v"].has_blanks and approx["v"].is_distinct is None


def test_profile_duplicates_and_null_as_value(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (None,)], "a int")
    r = column_profile(df).collect()[0]
    assert (r.row_count, r.distinct_count, r.is_distinct) == (4, 2, False)
    assert column_profile(df, null_length=None).collect()[0].max_length == 1


def test_profile_empty_table(spark):
    df = spark.createDataFrame([], "a int, b string")
    rows = column_profile(df, "db", "t").orderBy("column_name").collect()
    assert [(r.column_name, r.row_count, r.is_distinct, r.max_length) for r in rows] == [
        ("a", 0, True, None), ("b", 0, True, None)]


def test_report_fields(spark):
    df = spark.createDataFrame([("x",), ("y",)], "c string")
    r = profile_report(column_profile(df, "db", "t")).collect()[0]
    assert tuple(r) == ("db", "t", "c", "TRUE", "FALSE", "FALSE", 1, 1)


def test_value_frequency(spark):
    df = spark.createDataFrame([(None,), (1,), (1,)], "a int")
    assert [tuple(r) for r in value_frequency(df, "a").collect()] == [(1, 2), (None, 0)]
    assert [tuple(r) for r in value_frequency(df, "a", count_nulls=True).collect()] == [(1, 2), (None, 1)]
    g = group_count(df, "a").collect()[0]
    assert (g.n_groups, g.several) == (2, True)


def test_value_frequency_top_ties(spark):
    df = spark.createDataFrame([(k,) for k in [3, 3, 1, 2, 5, 4]], "a int")
    assert [tuple(r) for r in value_frequency(df, "a", n=3).collect()] == [(3, 2), (1, 1), (2, 1)]


def test_dedup_methods_agree(spark):
    rows = [(1, "b", 2), (1, "a", 5), (2, None, 1), (2, "c", 0), (None, "z", 1), (None, "y", 2)]
    df = spark.createDataFrame(rows, "k int, o string, v int")
    agg = {tuple(r) for r in first_per_key(df, "k", ["o"]).collect()}
    win = {tuple(r) for r in first_per_key(df, "k", ["o"], method="window").collect()}
    assert agg == win == {(1, "a", 5), (2, None, 1), (None, "y", 2)}
    last = {r.k: r.o for r in first_per_key(df, "k", ["o"], ascending=False).collect()}
    assert last == {1: "b", 2: "c", None: "z"}
    assert first_per_key(df, ["k"]).count() == 3


def test_match_or(spark):
    df = spark.createDataFrame([("x", "x"), ("x", "y"), (None, "y")], "a string, b string")
    assert [r[0] for r in df.select(match_or("a", "b")).collect()] == ["x", "no match", "no match"]


def test_word_counts_and_total(spark):
    df = spark.createDataFrame([("a b a",), ("b  c",)], "value string")
    c = word_counts(df)
    assert {r.word: r.cnt for r in c.collect()} == {"a": 2, "b": 2, "": 1, "c": 1}
    assert total_count(c).collect()[0].total == 6
    assert total_count(c.where("false")).collect()[0].total is None


def test_token_sort(spark):
    df = spark.createDataFrame([("10 2 33",), ("2",)], "value string")
    assert [tuple(r) for r in token_sort(df).collect()] == [(2, 1), (2, 1), (10, 1), (33, 1)]


def test_token_sort_spreads_a_hot_value(spark):
    df = spark.range(4000).select(F.lit("7").alias("value"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = token_sort(df.repartition(8))
        parts = out.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(r["count"] for r in parts) == 4000
    assert len(parts) > 1


def test_profile_nan_null_and_signed_zero(spark):
    df = spark.createDataFrame([(float("nan"),), (float("nan"),), (1.5,), (None,), (0.0,), (-0.0,)], "d double")
    r = column_profile(df).collect()[0]
    # NaN is one value, NULL is one value, and -0.0 equals 0.0 (as in Python)
    assert (r.row_count, r.distinct_count, r.is_distinct, r.has_nulls) == (6, 4, False, True)
    assert (r.max_length, r.min_length) == (4, 3)


def test_value_frequencies_all_columns(spark):
    from slotwise.operators.profile import value_frequencies
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "b"), (None, "b")], "x int, s string")
    got = {(r.column_name, r.value, r.cnt, r.rank) for r in value_frequencies(df, n=2).collect()}
    # NULL's count(col) is 0, so it ranks after '2' (count 1) and drops out of the top 2
    assert got == {("x", "1", 2, 1), ("x", "2", 1, 2), ("s", "b", 3, 1), ("s", "a", 1, 2)}


def test_group_count_of_an_empty_table(spark):
    r = group_count(spark.createDataFrame([], "a string"), "a").first()
    assert (r.n_groups, r.several) == (0, False)
