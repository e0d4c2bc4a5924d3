"""Plan shape: pushdown, pruning, broadcast of proven-small dimensions, one
aggregation per pivot, no cartesian products."""

import os

from slotwise.operators.normalise import normalise_readings
from slotwise.operators.outputs import peak_pivot, reading_pivot
from slotwise.plans.catalog import _enriched
from tests.conftest import SF_SMALL
from tests.test_normalise_dimensions import raw_rows, row


def plan_text(df):
    """Physical plan text; for an executed adaptive plan, the final plan only."""
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_reading_filter_reaches_scan(spark, tmp_dir):
    path = os.path.join(tmp_dir, "raw")
    raw_rows(spark, [row(), row(day="2017-03-02")]).write.parquet(path)
    out = normalise_readings(spark.read.parquet(path), "2017-03-01", "2017-03-01", 15)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        p = plan_text(out)
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = p.split("PushedFilters: [", 1)[1].split("], ReadSchema", 1)[0]
    for f in ("GreaterThanOrEqual(pcfc_day_per_dt,2017-03-01)", "LessThanOrEqual(pcfc_day_per_dt,2017-03-01)",
              "EqualTo(interval_measure,15)", "In(rdng_chnl_num, [1101,1102,1103,9104])"):
        assert f in pushed, (f, pushed)
    assert out.count() == 1


def test_enrich_plan(spark):
    e = _enriched(spark, SF_SMALL)
    p = e._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in p
    assert "NestedLoopJoin" not in p               # seasons meet the calendar day by day
    assert "BroadcastHashJoin" in p


SMALL = frozenset({"plans", "seasons", "calendar", "dayparts"})


def test_building_the_enrichment_runs_no_job(spark):
    from slotwise.plans.catalog import _params
    from slotwise.plans.interval_job import enriched_readings, fixture_inputs
    inp = fixture_inputs(spark, SF_SMALL)
    spark.sparkContext.setJobGroup("enrich-build", "no job expected")
    try:
        enriched_readings(inp, _params(), SMALL)
        assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("enrich-build")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_one_shuffle_of_the_fact_without_automatic_broadcasts(spark):
    from slotwise.plans.catalog import _params
    from slotwise.plans.interval_job import enriched_readings, fixture_inputs
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        want = sorted(map(repr, _enriched(spark, SF_SMALL).collect()))      # every join a shuffle
        e = enriched_readings(fixture_inputs(spark, SF_SMALL), _params(), SMALL)
        p = e._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in p and "CartesianProduct" not in p
        fact = [x for x in p.splitlines() if "Exchange hashpartitioning(_account" in x]
        assert len(fact) == 1, fact
        assert p.count("SortMergeJoin") <= 2                                # the fact's one, and accounts with assignments
        assert sorted(map(repr, e.collect())) == want
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_profile_groups_values_in_their_own_types(spark):
    from slotwise.operators.profile import _distinct_counts
    from slotwise.sources.tables import read_table
    for table in ("documents", "lineitem", "events"):
        df = read_table(spark, table, SF_SMALL)
        p = _distinct_counts(df, df.columns)._jdf.queryExecution().optimizedPlan().toString()
        numbers = [f.name for f in df.schema.fields if f.dataType.simpleString() != "string"]
        assert not [c for c in numbers if f"cast({c}#" in p]
        assert ("sha2(" in p) == any(f.dataType.simpleString() == "string" for f in df.schema.fields)
        kinds = {f.dataType.simpleString() for f in df.schema.fields}
        assert p.count("Generate inline") == len(kinds)                     # a narrow scan per type


def test_pivot_plans(spark):
    e = _enriched(spark, SF_SMALL)
    pv = reading_pivot(e, prefix="s")
    pv.collect()
    p = plan_text(pv)
    # numeric values: two-phase pivot (per key and slot, then PivotFirst per key)
    assert "pivotfirst" in p.lower()
    assert "SortMergeJoin" not in p and "CartesianProduct" not in p
    # text values with a closed code set take the same plan
    pk = peak_pivot(e, prefix="s")
    pk.collect()
    assert "pivotfirst" in plan_text(pk).lower()
    assert "SortAggregate" not in plan_text(pk)


def test_interval_job_shuffles_the_fact_once(spark):
    """With shuffle joins (as at scale) the enriched base is hash-partitioned
    by account; all seven outputs aggregate inside those partitions."""
    from slotwise.plans.catalog import _params
    from slotwise.plans.interval_job import outputs
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        from slotwise.plans.interval_job import enriched_readings, fixture_inputs
        e = enriched_readings(fixture_inputs(spark, SF_SMALL), _params(), SMALL, keep_account=True).persist()
        e.count()
        for name, df in outputs(e, _params()).items():
            df.write.format("noop").mode("overwrite").save()
            above_cache = plan_text(df).split("InMemoryRelation")[0]
            assert "Exchange" not in above_cache, name
        e.unpersist()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_top_values_limit_before_shuffle(spark):
    from slotwise.operators.profile import value_frequencies
    df = spark.range(5000).selectExpr("id", "id % 7 AS k")
    top = value_frequencies(df, n=3)
    top.collect()
    p = plan_text(top)
    assert p.count("WindowGroupLimit") >= 2      # partial (map side) and final
