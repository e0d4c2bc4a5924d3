"""Enrichment joins (J1-J6, X2-X5) and output records."""

import datetime as dt

from pyspark.sql import functions as F

from slotwise.operators import outputs as O
from slotwise.operators.enrich import enrich
from slotwise.operators.normalise import READING_FIELDS

D = dt.date


def reading(spark, pfd="2017-03-01", slot="1200", slot_time="12:00:00", rm="1.5", sa="11", sp="7", uom="kd",
            st="ACTUAL", oi=0, extra=()):
    base = dict(sp=sp, sa=sa, rsc="complete", im="15", rm=rm, chnl="1101", rd=pfd.replace("-", ""), pfd=pfd,
                rdng_dttm=None, qtr_intr=slot, hr_intr=slot[:2], qtr_intr_10=slot_time, pc="96", uom=uom, st=st,
                oi=oi, demand_factor="4")
    rows = [base] + [dict(base, **e) for e in extra]
    schema = ", ".join(f"{c} {'int' if c == 'oi' else 'string'}" for c in READING_FIELDS)
    return spark.createDataFrame([tuple(r[c] for c in READING_FIELDS) for r in rows], schema)


def dims(spark, cal_days=(D(2017, 3, 1),), parts=(("ON", "08:00:00", "12:00:00"),), day_type="WD"):
    accounts = spark.createDataFrame([(11, "RES", 5)], "account_id bigint, plan_code string, plan_id int")
    plans = spark.createDataFrame([(5, "A")], "plan_id int, use_type string")
    assignments = spark.createDataFrame([(11, D(2017, 1, 1), D(2018, 1, 1))],
                                        "account_id bigint, assign_start date, assign_end date")
    seasons = spark.createDataFrame([("A", D(2017, 1, 1), D(2017, 5, 31), "W")],
                                    "use_type string, season_start date, season_end date, si string")
    calendar = spark.createDataFrame([(d, day_type) for d in cal_days], "cal_date date, day_type string")
    dayparts = spark.createDataFrame([(p, 5, a, b, day_type, "W") for p, a, b in parts],
                                     "pi string, plan_id int, t0 string, t1 string, day_type string, season string")
    return accounts, plans, assignments, seasons, calendar, dayparts


def test_multi_day_window_fans_out(spark):
    r = reading(spark)
    d = dims(spark, cal_days=(D(2017, 3, 1), D(2017, 3, 2), D(2017, 3, 3)))
    assert enrich(r, *d).count() == 3
    assert enrich(r, *d, calendar_match="day").count() == 1


def test_shared_bound_duplicates(spark):
    d = dims(spark, parts=(("MID", "08:00:00", "12:00:00"), ("ON", "12:00:00", "16:00:00")))
    got = sorted(x.pi for x in enrich(reading(spark), *d).collect())
    assert got == ["MID", "ON"]


def test_duplicate_dayparts_removed_on_request(spark):
    d = dims(spark, parts=(("ON", "08:00:00", "12:00:00"), ("ON", "08:00:00", "12:00:00")))
    assert enrich(reading(spark), *d).count() == 2
    assert enrich(reading(spark), *d, dayparts_unique=True).count() == 1


def test_midnight_part(spark):
    r = reading(spark, slot="2300", slot_time="23:00:00")
    d = dims(spark, parts=(("OFF", "22:00:00", "06:00:00"),))
    assert [x.pi for x in enrich(r, *d).collect()] == [None]
    assert [x.pi for x in enrich(r, *d, wrap_midnight=True).collect()] == ["OFF"]


def test_fraction_in_slot_text(spark):
    r = reading(spark, slot_time="12:00:00.0")
    d = dims(spark)
    assert [x.pi for x in enrich(r, *d).collect()] == [None]
    assert [x.pi for x in enrich(r, *d, normalise_times=True).collect()] == ["ON"]


def test_assignment_end_is_exclusive_and_unmatched_dropped(spark):
    r = reading(spark, extra=[dict(pfd="2018-01-01", rd="20180101"), dict(sa="99")])
    d = dims(spark)
    assert enrich(r, *d).count() == 1


def test_small_dimensions_and_window_change_nothing(spark):
    from slotwise.operators.enrich import small_dimensions
    r = reading(spark)
    d = dims(spark, cal_days=(D(2017, 3, 1), D(2017, 3, 2)))
    want = sorted(tuple(x) for x in enrich(r, *d).collect())
    small = small_dimensions(dict(zip(("plans", "seasons", "calendar", "dayparts"), (d[1], d[3], d[4], d[5]))))
    assert small == {"plans", "seasons", "calendar", "dayparts"}
    for kw in ({"small": small}, {"small": small, "window": ("2017-03-01", "2017-03-02")}, {"window": ("2017-02-01", "2017-03-01")}):
        assert sorted(tuple(x) for x in enrich(r, *d, **kw).collect()) == want
    assert len(want) == 2


def test_sizes_are_measured_in_bytes(spark):
    from slotwise.operators.joins import measured, small_enough
    df = spark.createDataFrame([("x" * 5000, 1, None), (None, 2, [1, 2])], "s string, n int, a array<int>")
    rows, size = measured({"df": df, "none": df.limit(0)})["df"]
    assert rows == 2 and 5000 < size < 6000
    assert small_enough((rows, size)) and not small_enough((rows, size), max_bytes=1000) and not small_enough((rows, size), max_rows=1)


def test_parts_that_meet_at_a_bound(spark):
    r = reading(spark, slot_time="12:00:00")
    d = dims(spark, parts=(("MID", "08:00:00", "12:00:00"), ("ON", "12:00:00", "16:00:00"), ("ON", "12:00:00", "16:00:00")))
    assert sorted(x.pi for x in enrich(r, *d).collect()) == ["MID", "ON", "ON"]
    assert [x.pi for x in enrich(r, *d, dayparts_unique=True).collect()] == ["ON"]


def test_slots_outside_the_list(spark):
    import pytest
    r = reading(spark, extra=[dict(qtr_intr="0807", qtr_intr_10="08:07:00"), dict(qtr_intr=None, qtr_intr_10=None, uom="kn")])
    e = enrich(r, *dims(spark))
    text = e.withColumn("rm", e.rm.cast("string"))
    for frame, empty in ((e.withColumn("rm", e.rm.cast("double")), 0), (text, None)):
        wide = {x.uom: x for x in O.status_pivot(frame).collect()}
        assert [c for c in O.status_pivot(frame).columns if c[0].isdigit()] == ["0807", "1200"]
        assert (wide["kd"]["0807"], wide["kn"]["0807"], wide["kn"]["1200"]) == ("ACTUAL", None, None)
        rows = O.reading_pivot(frame).collect()
        assert len(rows) == 2 and sorted(x["0807"] is None or x["0807"] == 0 for x in rows) == [False, True]
        assert [x["1200"] for x in rows if x.uom == "kn"] == [empty]
        with pytest.raises(Exception, match="0807"):
            O.reading_pivot(frame, slots=["1200"]).collect()
    filled = O.reading_pivot(text, fill_strings="0").collect()
    assert all(x["0807"] is not None and x["1200"] is not None for x in filled)


def test_no_slots_keep_the_keys(spark):
    from pyspark.sql import functions as F
    e = enrich(reading(spark), *dims(spark)).withColumns({c: F.lit(None).cast("string") for c in ("qtr_intr", "hr_intr")})
    assert O.reading_pivot(e).count() == O.status_pivot(e).count() == O.hourly_pivot(e).count() == 1


def test_malformed_slots_are_named(spark):
    import pytest
    df = spark.createDataFrame([(f"{i:04d}",) for i in range(10)] + [("x!",)], "qtr_intr string")
    with pytest.raises(ValueError, match="x!"):
        O.observed_values(df, "qtr_intr", 5)


def test_lenient_values(spark):
    import pytest
    e = enrich(reading(spark, rm="x1", extra=[dict(rm="2.5")]), *dims(spark))
    assert [x.ds for x in O.daily_sum(e, lenient=True).collect()] == ["2.5"]
    with pytest.raises(Exception):
        O.daily_sum(e).collect()


def test_text_max_versus_numeric(spark):
    r = reading(spark, rm="9.5", extra=[dict(rm="10.25")])
    e = enrich(r, *dims(spark))
    text = O.reading_pivot(e, slots=["1200"]).collect()[0]
    num = O.reading_pivot(e, slots=["1200"], compare="numeric").collect()[0]
    assert text["1200"] == "9.5" and num["1200"] == 10.25


def test_fill_numeric_only(spark):
    e = enrich(reading(spark), *dims(spark))
    out = O.outage_pivot(e, slots=["1200", "1215"]).collect()[0]
    assert (out["1200"], out["1215"]) == (0, 0)
    st = O.status_pivot(e, slots=["1200", "1215"]).collect()[0]
    assert (st["1200"], st["1215"]) == ("ACTUAL", None)


def test_status_and_peak_max(spark):
    r = reading(spark, extra=[dict(st="ESTIMATED", uom="kd"), dict(qtr_intr="1215", qtr_intr_10="12:15:00")])
    d = dims(spark, parts=(("MID", "08:00:00", "12:00:00"), ("ON", "12:00:00", "16:00:00")))
    e = enrich(r, *d)
    st = O.status_pivot(e, slots=["1200", "1215"]).collect()[0]
    assert (st["1200"], st["1215"]) == ("ESTIMATED", "ACTUAL")
    pk = O.peak_pivot(e, slots=["1200", "1215"]).collect()[0]
    assert (pk["1200"], pk["1215"]) == ("ON", "ON")


def test_observed_slots_and_lists(spark):
    r = reading(spark, extra=[dict(qtr_intr="0815", qtr_intr_10="08:15:00", hr_intr="08")])
    e = enrich(r, *dims(spark))
    assert O.observed_values(e, "qtr_intr") == ["0815", "1200"]
    assert sorted(x[0] for x in O.distinct_values(e, "hr_intr").collect()) == ["08", "12"]
    assert len(O.QUARTER_SLOTS) == 96 and len(O.HOUR_SLOTS) == 24 and O.slots_for(60) == O.HOUR_SLOTS


def test_sums_and_demand(spark):
    r = reading(spark, rm="1.25", extra=[dict(rm="2.5", qtr_intr="1215", qtr_intr_10="12:15:00"),
                                         dict(rm="3", uom="kv")])
    e = enrich(r, *dims(spark))
    daily = {x.uom: x.ds for x in O.daily_sum(e).collect()}
    assert daily == {"kd": "3.75", "kv": "3.0"}
    hourly = O.hourly_pivot(e, O.HOURS).where("uom = 'kd'").collect()[0]
    assert hourly["12"] == "3.75" and hourly["11"] is None
    dm = O.daily_demand(e).collect()
    assert [(x.dmkd, x.mstkd, x.metkd, x.rec_type) for x in dm] == [
        ("10.0", "2017-03-01 00:00:00", "2017-03-02 00:00:00", "daily_max")]
    typed = O.daily_demand(e, as_string=False).collect()[0]
    assert typed.dmkd == 10.0


def test_invariants_on_fixture(spark):
    from tests.conftest import SF_SMALL
    from slotwise.plans.catalog import _enriched
    e = _enriched(spark, SF_SMALL)
    hourly = O.hourly_sum(e, as_string=False).agg(F.sum("hs")).collect()[0][0]
    daily = O.daily_sum(e, as_string=False).agg(F.sum("ds")).collect()[0][0]
    assert abs(hourly - daily) < 1e-6
    pivot = O.reading_pivot(e, O.QUARTER_SLOTS, prefix="s")
    non_null = sum(pivot.select(*[F.count(F.when(F.col(f"s{s}") != 0, 1)) for s in O.QUARTER_SLOTS]).collect()[0])
    cells = e.where("rm != 0").select(*O.READING_KEYS, "qtr_intr").distinct().count()
    assert non_null == cells
    day = _enriched(spark, SF_SMALL, calendar_match="day").count()
    assert day <= e.count()


def test_text_pivot_edges(spark):
    df = spark.createDataFrame([("k", "0000", "9.5"), ("k", "0000", "10.25"), ("k", None, "7"),
                                ("j", "0015", None), ("n", None, "1")], "k string, s string, v string")
    rows = {r.k: r for r in O.slot_pivot(df, ["k"], "s", "v", ["0000", "0015"], tag="t").collect()}
    assert (rows["k"]["0000"], rows["k"]["0015"], rows["k"].rec_type) == ("9.5", None, "t")
    assert (rows["j"]["0000"], rows["j"]["0015"]) == (None, None)
    assert (rows["n"]["0000"], rows["n"]["0015"]) == (None, None)


def test_long_slot_lists_keep_no_field_per_slot_in_the_aggregation(spark):
    from slotwise.operators.outputs import slot_pivot
    slots = [f"{h:02d}{m:02d}" for h in range(24) for m in range(60)]
    rows = [(f"k{i % 7}", slots[i * 37 % 1440] if i % 5 else None, ("ACTUAL", "ESTIMATED")[i % 3 % 2], float(i)) for i in range(200)]
    df = spark.createDataFrame(rows, "k string, slot string, st string, v double")
    for value, codes, empty in (("st", ("ACTUAL", "ESTIMATED"), None), ("v", None, 0.0), ("st", None, None)):
        out = slot_pivot(df, ["k"], "slot", value, slots, prefix="s", codes=codes)
        plan = out._jdf.queryExecution().optimizedPlan().toString().lower()
        assert "pivotfirst" not in plan
        expected = {}
        for k, slot, st, v in rows:
            cells = expected.setdefault(k, {})
            if slot:
                cells[slot] = max(cells[slot], {"st": st, "v": v}[value]) if slot in cells else {"st": st, "v": v}[value]
        got = {r.k: r for r in out.collect()}
        assert {k: [r[f"s{s}"] for s in slots] for k, r in got.items()} == {k: [c.get(s, empty) for s in slots] for k, c in expected.items()}
