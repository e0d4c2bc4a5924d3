import random

import pytest
from pyspark.sql import functions as F

from slotwise.operators.interval_join import interval_join, segments
from tests.conftest import SF_SMALL
from tests.test_plans import SMALL, plan_text

NO_BROADCAST = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}


@pytest.fixture()
def shuffles_only(spark):
    old = {k: spark.conf.get(k, None) for k in NO_BROADCAST}
    for k, v in NO_BROADCAST.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _layout(spark, tmp_dir, **kw):
    from slotwise.plans.catalog import _params
    from slotwise.plans.interval_job import account_layout, enriched_readings, fixture_inputs
    inp = fixture_inputs(spark, SF_SMALL)
    layout = account_layout(inp, _params(), "t_layout", tmp_dir, **kw)
    return layout, lambda extra: enriched_readings(inp, _params(extra=extra), SMALL)


def test_bucketed_join_shuffles_no_reading(spark, tmp_dir, shuffles_only):
    layout, enriched = _layout(spark, tmp_dir, buckets=8, rows_per_split=10**9)
    got = enriched({"layout": layout})
    assert sorted(map(repr, got.collect())) == sorted(map(repr, enriched({}).collect()))
    plan = plan_text(got)
    assert "hashpartitioning(_account" not in plan and "hashpartitioning(_acct" not in plan
    join = [x for x in plan.splitlines() if "SortMergeJoin" in x and "_account" in x]
    assert len(join) == 1


def test_hot_accounts_are_split_in_the_layout(spark, tmp_dir, shuffles_only):
    layout, enriched = _layout(spark, tmp_dir, buckets=8, rows_per_split=3)
    r = spark.table(layout.readings)
    per_key = r.groupBy("_account", "_salt").count()
    assert r.agg(F.max("_salt")).first()[0] > 0
    assert per_key.agg(F.max("count")).first()[0] < r.groupBy("_account").count().agg(F.max("count")).first()[0]
    got = enriched({"layout": layout})
    assert sorted(map(repr, got.collect())) == sorted(map(repr, enriched({}).collect()))


def _rows(seed, keys=4, facts=300, ranges=60):
    rng = random.Random(seed)
    key = lambda: rng.choice([None, *range(keys)])
    num = lambda: rng.choice([None] + [rng.randint(0, 60)] * 9)
    f = [(i, key(), num()) for i in range(facts)]
    r = []
    for i in range(ranges):
        a = num()
        r.append((key(), a, None if a is None or rng.random() < 0.05 else a + rng.randint(-1, 12), f"r{i}"))
    return f, r + r[:3]


@pytest.mark.parametrize("seed, closed, how, split", [(1, False, "inner", 10**9), (2, True, "inner", 20), (3, False, "left", 7), (4, True, "left", 10**9)])
def test_matches_the_residual_join(spark, seed, closed, how, split):
    f, r = _rows(seed)
    facts = spark.createDataFrame(f, "id int, fk int, at int")
    ranges = spark.createDataFrame(r, "rk int, lo int, hi int, name string")
    got = interval_join(facts, ranges, [("fk", "rk")], "at", "lo", "hi", closed, how, split)
    end = F.col("at") <= F.col("hi") if closed else F.col("at") < F.col("hi")
    want = facts.join(ranges, (F.col("fk") == F.col("rk")) & (F.col("at") >= F.col("lo")) & end & (F.col("lo") <= F.col("hi")), how)
    assert got.columns == want.columns
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_several_keys_text_positions_and_empty_sides(spark):
    parts = spark.createDataFrame([("a", 1, "00:00", "07:59", "OFF"), ("a", 1, "07:59", "12:00", "MID"), ("b", 1, "10:00", "10:00", "X")],
                                  "plan string, day int, t0 string, t1 string, part string")
    slots = spark.createDataFrame([("a", 1, "07:59"), ("a", 1, "12:00"), ("a", 2, "01:00"), ("b", 1, "10:00"), ("a", 1, "12:01")],
                                  "p string, d int, t string")
    on = [("p", "plan"), ("d", "day")]
    got = interval_join(slots, parts, on, "t", "t0", "t1", closed=True, how="left").select("p", "d", "t", "part").collect()
    assert sorted(map(tuple, got), key=repr) == sorted([("a", 1, "07:59", "OFF"), ("a", 1, "07:59", "MID"), ("a", 1, "12:00", "MID"),
                                                        ("a", 2, "01:00", None), ("b", 1, "10:00", "X"), ("a", 1, "12:01", None)], key=repr)
    assert interval_join(slots.limit(0), parts, on, "t", "t0", "t1").collect() == []
    assert interval_join(slots, parts.limit(0), on, "t", "t0", "t1", how="left").count() == 5
    with pytest.raises(ValueError):
        interval_join(slots, parts.withColumnRenamed("part", "t"), on, "t", "t0", "t1")


def test_rows_before_the_filter_are_linear(spark):
    """One key with r facts and k disjoint ranges: r + k rows are ordered, not r * k."""
    ranges = spark.range(400).selectExpr("1 AS rk", "id * 10 AS lo", "id * 10 + 7 AS hi")
    facts = spark.range(4000).selectExpr("1 AS fk", "id AS at")
    seg = segments(ranges, ["rk"], "lo", "hi")
    assert seg.count() == 400
    got = interval_join(facts, ranges, [("fk", "rk")], "at", "lo", "hi")
    got.collect()
    plan = plan_text(got)
    made = [x for x in plan.splitlines() if "Join" in x and "at" in x and ("lo" in x or "_from" in x) and "_bkey" not in x and "_hot" not in x]
    assert not made, made                                                       # no join compares positions of facts and ranges
    assert got.count() == 2800


def test_sorts_of_the_interval_join_grow_in_number_not_in_size(spark, monkeypatch):
    from slotwise.operators import interval_join as ij
    monkeypatch.setattr(ij, "ROWS_PER_TASK", 100, raising=False)
    facts = spark.range(900).select((F.col("id") % 90).alias("k"), F.col("id").alias("at"))
    ranges = spark.range(300).select((F.col("id") % 90).alias("rk"), F.col("id").alias("lo"), (F.col("id") + 120).alias("hi"))
    out = ij.interval_join(facts, ranges, [("k", "rk")], "at", "lo", "hi", how="left")
    assert out.rdd.getNumPartitions() >= 15                         # 900 facts, 300 ranges and their segments
    expected = [(f % 90, f, r) for f in range(900)
                for r in [r for r in range(300) if r % 90 == f % 90 and r <= f < r + 120] or [None]]
    got = [tuple(r) for r in out.select("k", "at", "lo").collect()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
