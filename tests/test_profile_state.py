from pyspark.sql import functions as F

from slotwise.operators import profile_state as ps
from slotwise.operators.profile import column_profile
from slotwise.sources.tables import read_table
from tests.conftest import SF_SMALL

EXACT = ["column_name", "row_count", "has_blanks", "has_nulls", "max_length", "min_length"]


def _rows(df, cols):
    return sorted(map(repr, df.select(*cols).collect()))


def test_merged_days_equal_the_whole(spark, tmp_dir):
    df = read_table(spark, "events", SF_SMALL).withColumn("neg", F.col("user_id").cast("int") - 20).withColumn(
        "gap", F.when(F.col("event_id") % 3 == 0, F.col("event_id")))
    days = [r[0] for r in df.select((F.col("event_id") % 4).alias("d")).distinct().collect()]
    for d in days:
        ps.write_state(df.where(F.col("event_id") % 4 == d), tmp_dir, str(d))
    whole, merged = column_profile(df), ps.merged_profile(spark, tmp_dir)
    assert _rows(whole, EXACT) == _rows(merged, EXACT)
    want = {r.column_name: (r.distinct_count, r.is_distinct) for r in whole.collect()}
    seen = {r.column_name: r for r in merged.collect()}
    assert {c for c, r in seen.items() if r.exact} == {"event_id", "user_id", "neg", "gap"}
    for c, r in seen.items():
        if r.exact:
            assert (r.distinct_count, r.is_distinct) == want[c]
        else:
            assert r.is_distinct is None and abs(r.distinct_count - want[c][0]) <= 4 * ps.error_of() * want[c][0] + 1


def test_a_rerun_replaces_its_part_and_backfill_equals_days(spark, tmp_dir):
    df = spark.range(3000).selectExpr("id", "cast(id % 7 as int) k", "if(id % 5 = 0, null, concat('v', id)) t", "cast(id % 3 as string) day")
    ps.write_states(df, f"{tmp_dir}/a", "day")
    for d in ("0", "1", "2", "1"):
        ps.write_state(df.where(F.col("day") == d).drop("day"), f"{tmp_dir}/b", d)
    cols = [*EXACT, "distinct_count", "exact"]
    a, b = ps.merged_profile(spark, f"{tmp_dir}/a"), ps.merged_profile(spark, f"{tmp_dir}/b")
    assert _rows(a, cols) == _rows(b, cols)
    one = ps.merged_profile(spark, f"{tmp_dir}/a", parts=["1"])
    assert _rows(one, EXACT) == _rows(column_profile(df.where("day = '1'").drop("day")), EXACT)


def test_sparse_columns_keep_sketches_only(spark, tmp_dir):
    df = spark.range(500).selectExpr("id * 1000003 AS far", "id AS near")
    ps.write_state(df, tmp_dir, "x")
    got = {r.column_name: (r.exact, r.distinct_count) for r in ps.merged_profile(spark, tmp_dir).collect()}
    assert got["near"] == (True, 500) and got["far"][0] is False and abs(got["far"][1] - 500) < 20
