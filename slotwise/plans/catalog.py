"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per
operator of the survey's inventory. Every query reads the driver tables (or
frames Spark derives from them) in full."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, TimestampNTZType, TimestampType

from slotwise.operators import dimensions as dims
from slotwise.session import apply_runtime_conf
from slotwise.operators import outputs as out
from slotwise.plans.interval_job import IntervalParams, enriched_readings, fixture_inputs
from slotwise.sources import fixtures
from slotwise.operators.normalise import normalise_readings

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# Fixed parameters of the registered interval queries (FIXTURES.md).
START, END = fixtures.WINDOW
AS_OF_EARLY, AS_OF_LATE = "2024-01-05", "2024-01-15"


def query(name: str):
    def deco(fn):
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            # Date / time keys are computed on the UTC wall clock.
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            apply_runtime_conf(spark)
            return portable(fn(spark, sf_dir))
        QUERIES[name] = run
        return run
    return deco


def portable(df: DataFrame) -> DataFrame:
    """Render date / timestamp columns as ISO text (the form the records take
    in JSON) and decimals as doubles, so results compare across engines."""
    cols, changed = [], False
    for f in df.schema.fields:
        changed = changed or isinstance(f.dataType, (DateType, TimestampType, TimestampNTZType, DecimalType))
    if not changed:
        return df
    for f in df.schema.fields:
        if isinstance(f.dataType, DateType):
            cols.append(F.date_format(F.col(f.name), "yyyy-MM-dd").alias(f.name))
        elif isinstance(f.dataType, (TimestampType, TimestampNTZType)):
            cols.append(F.date_format(F.col(f.name), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(f.name))
        elif isinstance(f.dataType, DecimalType):
            cols.append(F.col(f.name).cast("double").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def _params(**kw) -> IntervalParams:
    base = dict(start=START, end=END, interval=fixtures.INTERVAL, excluded_plan=fixtures.EXCLUDED_PLAN,
                typed=True, slots="fixed", prefix="s", hour_prefix="h")
    base.update(kw)
    return IntervalParams(**base)


def _enriched(spark, base, **kw) -> DataFrame:
    return enriched_readings(fixture_inputs(spark, base), _params(**kw))


# ---- interval job: normaliser and dimensions --------------------------------------------

@query("reading_normalise")
def reading_normalise(spark, base):
    src = fixtures.readings_src(spark, base)
    return normalise_readings(src, START, END, fixtures.INTERVAL, typed=True)


@query("reading_normalise_text")
def reading_normalise_text(spark, base):
    src = fixtures.readings_src(spark, base)
    return normalise_readings(src, START, END, fixtures.INTERVAL, typed=False)


@query("reading_scan_sql")
def reading_scan_sql(spark, base):
    from slotwise.sources.tables import scan_sql
    fixtures.readings_src(spark, base).createOrReplaceTempView("readings_src")
    return scan_sql(spark, "readings_src", "*",
                    "pcfc_day_per_dt BETWEEN :lo AND :hi AND interval_measure = :im "
                    "AND rdng_chnl_num IN (1101, 1102, 1103, 9104)",
                    {"lo": START, "hi": END, "im": fixtures.INTERVAL})


@query("accounts_filter")
def accounts_filter(spark, base):
    return dims.clean_accounts(fixtures.accounts_src(spark, base), fixtures.EXCLUDED_PLAN)


@query("plans_clean")
def plans_clean(spark, base):
    return dims.clean_plans(fixtures.plans_src(spark, base))


@query("seasons_clean")
def seasons_clean(spark, base):
    return dims.clean_seasons(fixtures.seasons_src(spark, base))


@query("calendar_filter")
def calendar_filter(spark, base):
    return dims.clean_calendar(fixtures.calendar_src(spark, base), START, END)


@query("daypart_asof")
def daypart_asof(spark, base):
    return dims.clean_dayparts(fixtures.dayparts_src(spark, base), as_of=AS_OF_EARLY)


@query("daypart_asof_late")
def daypart_asof_late(spark, base):
    return dims.clean_dayparts(fixtures.dayparts_src(spark, base), as_of=AS_OF_LATE)


# ---- interval job: enrichment ------------------------------------------------------------

@query("enrich_range_calendar")
def enrich_range_calendar(spark, base):
    return _enriched(spark, base)


@query("enrich_day_calendar")
def enrich_day_calendar(spark, base):
    return _enriched(spark, base, calendar_match="day")


@query("enrich_split_hot_accounts")
def enrich_split_hot_accounts(spark, base):
    # Hot-account split forced on: every account above 10 readings is spread
    # over several join tasks (the fixture's busiest account has ~100).
    return _enriched(spark, base, extra={"skew": "split", "rows_per_split": 10})


@query("enrich_bucketed")
def enrich_bucketed(spark, base):
    """The account join over bucketed tables; accounts above 20 readings are split."""
    import uuid
    from slotwise.plans.interval_job import account_layout
    from slotwise.session import scratch_path
    layout = account_layout(fixture_inputs(spark, base), _params(), f"layout_{uuid.uuid4().hex[:12]}",
                            scratch_path(spark, "account-layout"), buckets=16, rows_per_split=20)
    return _enriched(spark, base, extra={"layout": layout})


@query("enrich_ordered_ranges")
def enrich_ordered_ranges(spark, base):
    return _enriched(spark, base, extra={"ranges": "ordered", "rows_per_split": 20})


@query("orders_in_periods")
def orders_in_periods(spark, base):
    """Interval join by ordering over ranges that overlap: every order with the
    customer's order periods (120 days from an order) that hold its date."""
    from slotwise.operators.interval_join import interval_join
    from slotwise.sources.tables import read_table
    orders = read_table(spark, "orders", base).select(
        "o_custkey", "o_orderkey", F.to_date("o_orderdate").alias("o_orderdate"))
    periods = orders.select(F.col("o_custkey").alias("cust"), F.col("o_orderkey").alias("period_key"),
                            F.col("o_orderdate").alias("opens"), F.date_add("o_orderdate", 120).alias("closes"))
    return interval_join(orders, periods, [("o_custkey", "cust")], "o_orderdate", "opens", "closes",
                         how="left").select("o_orderkey", "o_orderdate", "period_key", "closes")


@query("slot_list")
def slot_list(spark, base):
    return out.distinct_values(_enriched(spark, base), "qtr_intr")


@query("hour_list")
def hour_list(spark, base):
    return out.distinct_values(_enriched(spark, base), "hr_intr")


# ---- interval job: outputs ---------------------------------------------------------------

@query("reading_pivot")
def reading_pivot(spark, base):
    return out.reading_pivot(_enriched(spark, base), out.QUARTER_SLOTS, prefix="s")


@query("reading_pivot_text")
def reading_pivot_text(spark, base):
    e = _enriched(spark, base).withColumn("rm", F.col("rm").cast("string"))
    return out.reading_pivot(e, out.QUARTER_SLOTS, prefix="s")


@query("reading_pivot_text_numeric")
def reading_pivot_text_numeric(spark, base):
    e = _enriched(spark, base).withColumn("rm", F.col("rm").cast("string"))
    return out.reading_pivot(e, out.QUARTER_SLOTS, compare="numeric", prefix="s")


@query("hourly_sum")
def hourly_sum(spark, base):
    return out.hourly_sum(_enriched(spark, base), as_string=False)


@query("hourly_pivot")
def hourly_pivot(spark, base):
    return out.hourly_pivot(_enriched(spark, base), out.HOURS, as_string=False, prefix="h")


@query("daily_sum")
def daily_sum(spark, base):
    return out.daily_sum(_enriched(spark, base), as_string=False)


@query("daily_sum_day_calendar")
def daily_sum_day_calendar(spark, base):
    return out.daily_sum(_enriched(spark, base, calendar_match="day"), as_string=False)


@query("daily_demand")
def daily_demand(spark, base):
    return out.daily_demand(_enriched(spark, base), as_string=False)


@query("peak_pivot")
def peak_pivot(spark, base):
    return out.peak_pivot(_enriched(spark, base), out.QUARTER_SLOTS, prefix="s")


@query("outage_pivot")
def outage_pivot(spark, base):
    return out.outage_pivot(_enriched(spark, base), out.QUARTER_SLOTS, prefix="s")


@query("status_pivot")
def status_pivot(spark, base):
    return out.status_pivot(_enriched(spark, base), out.QUARTER_SLOTS, prefix="s")


# ---- column profile, frequencies, dedup -------------------------------------------------

def _profile(spark, base, table):
    from slotwise.operators.profile import column_profile
    from slotwise.sources.tables import read_table
    return column_profile(read_table(spark, table, base), db="testdata", table=table)


@query("column_profile")
def column_profile_customer(spark, base):
    return _profile(spark, base, "customer")


@query("column_profile_events")
def column_profile_events(spark, base):
    return _profile(spark, base, "events")


@query("column_profile_documents")
def column_profile_documents(spark, base):
    return _profile(spark, base, "documents")


@query("column_profile_lineitem")
def column_profile_lineitem(spark, base):
    return _profile(spark, base, "lineitem")


@query("profile_merged_months")
def profile_merged_months(spark, base):
    """The events' profile merged from monthly states: exact measures, and the
    distinct counts of the columns whose values the states hold exactly."""
    from slotwise.operators.profile_state import merged_profile, write_states
    from slotwise.session import scratch_path
    from slotwise.sources.tables import read_table
    events = read_table(spark, "events", base)
    path = scratch_path(spark, "profile-states")
    write_states(events.withColumn("month", F.date_format("ts", "yyyy-MM")), path, "month", exact=["event_id", "user_id"])
    got = merged_profile(spark, path, db="testdata", table="events")
    return got.withColumn("distinct_count", F.when(F.col("exact"), F.col("distinct_count")))


@query("value_frequency")
def value_frequency_event_type(spark, base):
    from slotwise.operators.profile import value_frequency
    from slotwise.sources.tables import read_table
    return value_frequency(read_table(spark, "events", base), "event_type")


@query("value_frequency_top")
def value_frequency_user(spark, base):
    from slotwise.operators.profile import value_frequency
    from slotwise.sources.tables import read_table
    return value_frequency(read_table(spark, "events", base), "user_id")


@query("value_frequency_all_columns")
def value_frequency_all_columns(spark, base):
    from slotwise.operators.profile import value_frequencies
    from slotwise.sources.tables import read_table
    return value_frequencies(read_table(spark, "customer", base))


@query("value_frequency_nulls")
def value_frequency_nulls(spark, base):
    from slotwise.operators.profile import value_frequency
    return value_frequency(fixtures.readings_src(spark, base), "status")


@query("value_frequency_nulls_counted")
def value_frequency_nulls_counted(spark, base):
    from slotwise.operators.profile import value_frequency
    return value_frequency(fixtures.readings_src(spark, base), "status", count_nulls=True)


@query("group_count")
def group_count_status(spark, base):
    from slotwise.operators.profile import group_count
    return group_count(fixtures.readings_src(spark, base), "status")


@query("dedup_first")
def dedup_first(spark, base):
    from slotwise.operators.dedup import first_per_key
    from slotwise.sources.tables import read_table
    return first_per_key(read_table(spark, "orders", base), "o_custkey", ["o_orderdate", "o_orderkey"])


@query("dedup_first_window")
def dedup_first_window(spark, base):
    from slotwise.operators.dedup import first_per_key
    from slotwise.sources.tables import read_table
    return first_per_key(read_table(spark, "orders", base), "o_custkey", ["o_orderdate", "o_orderkey"],
                         method="window")


@query("dedup_last")
def dedup_last(spark, base):
    from slotwise.operators.dedup import first_per_key
    from slotwise.sources.tables import read_table
    return first_per_key(read_table(spark, "orders", base), "o_custkey", ["o_totalprice", "o_orderkey"],
                         ascending=False)


@query("dedup_any")
def dedup_any(spark, base):
    from slotwise.operators.dedup import first_per_key
    from slotwise.sources.tables import read_table
    return first_per_key(read_table(spark, "orders", base), "o_custkey").select("o_custkey")


@query("column_match")
def column_match(spark, base):
    from slotwise.operators.dedup import match_or
    from slotwise.sources.tables import read_table
    li = read_table(spark, "lineitem", base)
    od = read_table(spark, "orders", base)
    j = li.join(od, li.l_orderkey == od.o_orderkey)
    return j.select("l_orderkey", "l_linenumber", match_or("o_orderstatus", "l_linestatus").alias("status_match"))


# ---- tokens and streams ------------------------------------------------------------------

def _number_lines(spark, base):
    from slotwise.operators.frames import spread
    from slotwise.sources.tables import read_table
    ev = spread(read_table(spark, "events", base).select("props"))
    return ev.select(F.trim(F.regexp_replace("props", "[^0-9]+", " ")).alias("value"))


@query("token_sort")
def token_sort(spark, base):
    from slotwise.operators.tokens import token_sort as sort_tokens
    return sort_tokens(_number_lines(spark, base))


@query("word_count")
def word_count(spark, base):
    from slotwise.operators.frames import spread
    from slotwise.operators.tokens import word_counts
    from slotwise.sources.tables import read_table
    return word_counts(spread(read_table(spark, "documents", base).select("text")), "text")


def _stream_documents(spark, base):
    from slotwise.plans.stream_job import run_files
    from slotwise.sources.tables import read_table
    schema = read_table(spark, "documents", base).schema
    return run_files(spark, f"{base.rstrip('/')}/documents.parquet", fmt="parquet", schema=schema, value_col="text")


@query("stream_batch_words")
def stream_batch_words(spark, base):
    return _stream_documents(spark, base)[1]


@query("stream_batch_total")
def stream_batch_total(spark, base):
    return _stream_documents(spark, base)[2]


# ---- sinks, catalog, partitions ----------------------------------------------------------

@query("json_round_trip")
def json_round_trip(spark, base):
    from pyspark.sql.types import DoubleType, StringType, StructField, StructType
    from slotwise.session import scratch_path
    from slotwise.sinks.files import read_records, write_records
    daily = out.daily_sum(_enriched(spark, base), as_string=False)
    path = scratch_path(spark, "records")
    write_records(daily, path, dt=START, im=fixtures.INTERVAL)
    schema = StructType([StructField(n, StringType()) for n in ("sa", "sp", "rd", "uom")]
                        + [StructField("ds", DoubleType())]
                        + [StructField(n, StringType()) for n in ("rec_type", "dt", "im")])
    return read_records(spark, path, schema, rec_type="daily_sum").drop("dt")


@query("text_lines")
def text_lines(spark, base):
    """Texts written as lines and read back: the word counts of all lines."""
    from slotwise.operators.tokens import word_counts
    from slotwise.session import scratch_path
    from slotwise.sources.tables import read_lines, read_table
    path = scratch_path(spark, "lines")
    read_table(spark, "documents", base).select(F.regexp_replace("text", "[\r\n]+", " ").alias("value")).write.text(path)
    lines = read_lines(spark, path)
    return word_counts(lines, lines.columns[0])


@query("json_max_files")
def json_max_files(spark, base):
    """K2: the number of files of an output, capped."""
    from slotwise.session import scratch_path
    from slotwise.sinks.files import write_records
    daily = out.daily_sum(_enriched(spark, base), as_string=False).repartition(8)
    path = scratch_path(spark, "capped-records")
    write_records(daily, path, "daily_sum", dt=START, im=fixtures.INTERVAL, max_files=3)
    rows = spark.read.json(f"{path}/rec_type=daily_sum").select("*", F.col("_metadata.file_path").alias("file"))
    return rows.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("file").alias("files"))


@query("report_round_trip")
def report_round_trip(spark, base):
    from slotwise.plans.profile_job import profile_table, read_profile_report
    from slotwise.session import scratch_path
    from slotwise.sources.tables import read_table
    path = scratch_path(spark, "report")
    profile_table(spark, "testdata", "customer", df=read_table(spark, "customer", base), report_path=path)
    return read_profile_report(spark, path)


@query("partition_rows")
def partition_rows(spark, base):
    from slotwise.operators.frames import partition_rows as rows_per_partition
    from slotwise.sources.tables import read_table
    per_partition = rows_per_partition(read_table(spark, "events", base))
    return per_partition.agg(F.sum("rows").alias("rows"))


@query("interval_job_status_records")
def interval_job_status_records(spark, base):
    """The whole interval job (seven record types over one reused enriched
    frame, written as partitioned JSON), then the status records read back."""
    from pyspark.sql.types import StringType, StructField, StructType
    from slotwise.plans.interval_job import run
    from slotwise.session import scratch_path
    from slotwise.sinks.files import read_records
    path = scratch_path(spark, "interval-job")
    run(fixture_inputs(spark, base), _params(), path)
    names = ["sa", "sp", "uom", "rd"] + [f"s{x}" for x in out.QUARTER_SLOTS] + ["rec_type", "dt", "im"]
    schema = StructType([StructField(n, StringType()) for n in names])
    return read_records(spark, path, schema, rec_type="status").drop("dt")


# ---- whole event range (day-matched calendar), interval 60 -------------------------------

ALL_DAYS = ("2024-01-01", "2024-12-31")


def _all_days(spark, base, interval=fixtures.INTERVAL):
    return _enriched(spark, base, start=ALL_DAYS[0], end=ALL_DAYS[1], interval=interval, calendar_match="day")


@query("enrich_all_days")
def enrich_all_days(spark, base):
    return _all_days(spark, base)


@query("daily_sum_all_days")
def daily_sum_all_days(spark, base):
    return out.daily_sum(_all_days(spark, base), as_string=False)


@query("hourly_pivot_all_days")
def hourly_pivot_all_days(spark, base):
    return out.hourly_pivot(_all_days(spark, base), out.HOURS, as_string=False, prefix="h")


@query("reading_pivot_interval60")
def reading_pivot_interval60(spark, base):
    return out.reading_pivot(_all_days(spark, base, interval=60), slots=out.HOUR_SLOTS, prefix="s")


@query("status_pivot_interval60")
def status_pivot_interval60(spark, base):
    return out.status_pivot(_all_days(spark, base, interval=60), slots=out.HOUR_SLOTS, prefix="s")


# ---- observed slots, text mode, malformed values, raw day parts, reruns --------------------

ONE_DAY = (START, START)


def _offgrid_inputs(spark, base):
    """Fixture inputs whose readings also have off-grid slots and no slots."""
    inp = fixture_inputs(spark, base)
    inp.readings = fixtures.readings_src(spark, base, offgrid=True)
    return inp


def _long(wide: DataFrame, keys, prefix: str, cell_type: str) -> DataFrame:
    """The pivot's cells as rows (slot, cell): its columns are data."""
    slots = [c for c in wide.columns if c not in keys and c != "rec_type"]
    cells = F.array(*[F.struct(F.lit(c[len(prefix):]).alias("slot"), F.col(c).cast(cell_type).alias("cell")) for c in slots])
    return wide.select(*keys, F.inline(cells))


@query("reading_pivot_offgrid")
def reading_pivot_offgrid(spark, base):
    e = enriched_readings(_offgrid_inputs(spark, base), _params(start=ONE_DAY[0], end=ONE_DAY[1]))
    return _long(out.reading_pivot(e, prefix="s"), out.READING_KEYS, "s", "double")


@query("reading_pivot_offgrid_text")
def reading_pivot_offgrid_text(spark, base):
    e = enriched_readings(_offgrid_inputs(spark, base), _params(start=ONE_DAY[0], end=ONE_DAY[1], typed=False))
    return _long(out.reading_pivot(e, prefix="s"), out.READING_KEYS, "s", "string")


@query("status_pivot_offgrid")
def status_pivot_offgrid(spark, base):
    e = enriched_readings(_offgrid_inputs(spark, base), _params(start=ONE_DAY[0], end=ONE_DAY[1]))
    return _long(out.status_pivot(e, prefix="s"), out.STATUS_KEYS, "s", "string")


@query("peak_pivot_filled")
def peak_pivot_filled(spark, base):
    return out.peak_pivot(_enriched(spark, base), out.QUARTER_SLOTS, prefix="s", fill_strings="-")


# Keys of the record types, in the order of their text form below.
RECORD_KEYS = {"rdng_meas": out.READING_KEYS, "hrly_sum": out.HOURLY_KEYS, "daily_sum": out.DAILY_KEYS,
               "daily_max": out.DEMAND_KEYS, "peak_ind": out.INDICATOR_KEYS, "outage_ind": out.INDICATOR_KEYS,
               "status": out.STATUS_KEYS}


@query("interval_job_all_records")
def interval_job_all_records(spark, base):
    """The whole job in its defaults (text values, observed slots) over one day
    with off-grid and missing slots; all seven record types read back, one row
    per stored field: numbers in ``num``, other texts in ``txt``."""
    from slotwise.plans.interval_job import run
    from slotwise.session import scratch_path
    path = scratch_path(spark, "interval-job-text")
    p = IntervalParams(start=ONE_DAY[0], end=ONE_DAY[1], excluded_plan=fixtures.EXCLUDED_PLAN)
    run(_offgrid_inputs(spark, base), p, path, keep_fields=True,
        sort_by={t: ["sa", "sp"] for t in RECORD_KEYS})
    parts = []
    for rec_type, keys in RECORD_KEYS.items():
        df = spark.read.option("primitivesAsString", "true").json(f"{path}/rec_type={rec_type}/dt={ONE_DAY[0]}/im={p.interval}")
        key = F.concat_ws("|", *[F.col(k) for k in keys])
        fields = [c for c in df.columns if c not in keys and c != "rec_type"]
        cells = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("cell")) for c in fields])
        parts.append(df.select("rec_type", key.alias("key"), F.inline(cells)).where("cell is not null"))
    rows = functools.reduce(DataFrame.unionByName, parts)
    text = F.col("rec_type").isin("peak_ind", "status") | F.col("name").isin("mstkd", "metkd")
    return rows.select("rec_type", "key", "name", F.when(~text, F.col("cell").try_cast("double")).alias("num"),
                       F.when(text, F.col("cell")).alias("txt"))


@query("sums_by_grain")
def sums_by_grain(spark, base):
    """Hour, day and month sums from one aggregation of the readings."""
    from slotwise.session import scratch_path
    path = scratch_path(spark, "hour-partials")
    out.hour_partials(_all_days(spark, base)).write.parquet(path)
    partials = spark.read.parquet(path)
    hour = out.sums_from(partials, "hour", as_string=False).select("sa", "sp", "im", "uom", F.concat("rd", "hr_intr").alias("period"), F.col("hs").alias("total"))
    day = out.sums_from(partials, "day", as_string=False).select("sa", "sp", "im", "uom", F.col("rd").alias("period"), F.col("ds").alias("total"))
    month = out.sums_from(partials, "month", as_string=False).select("sa", "sp", "im", "uom", F.col("month").alias("period"), F.col("ms").alias("total"))
    return hour.unionByName(day).unionByName(month)


@query("readings_quarantine")
def readings_quarantine(spark, base):
    """Readings with malformed values, split: the good ones' normalised sum per
    unit, and the malformed ones' reasons and raw texts."""
    from slotwise.operators.quarantine import quarantine
    q = quarantine(fixtures.readings_src(spark, base, malformed=True))
    good = normalise_readings(q.good, START, END, fixtures.INTERVAL, typed=True)
    sums = good.groupBy("uom").agg(F.sum("rm").cast("double").alias("total"), F.count(F.lit(1)).alias("rows"))
    bad = q.bad.select(F.inline("malformed")).groupBy("reason", "raw").agg(F.count(F.lit(1)).alias("rows"))
    return sums.select(F.lit("good").alias("side"), F.col("uom").alias("name"), F.lit(None).cast("string").alias("raw"), "total", "rows").unionByName(
        bad.select(F.lit("malformed").alias("side"), F.col("reason").alias("name"), "raw", F.lit(None).cast("double").alias("total"), "rows"))


@query("daily_sum_in_order")
def daily_sum_in_order(spark, base):
    """The daily sums written in global order (O2): reading the files by name
    gives them by account, point, day and unit."""
    from slotwise.session import scratch_path
    from slotwise.sinks.files import read_in_order, write_ordered
    daily = out.daily_sum(_all_days(spark, base), as_string=False)
    path = scratch_path(spark, "ordered")
    write_ordered(daily, path, ["sa", "sp", "rd", "uom"], files=5)
    return read_in_order(spark, path, daily.schema)


@query("published_rerun")
def published_rerun(spark, base):
    """Daily sums published twice (K1): the second run's records are in force."""
    from slotwise.session import scratch_path
    from slotwise.sinks.published import publish_records, read_published_records
    daily = out.daily_sum(_enriched(spark, base), as_string=False)
    path = scratch_path(spark, "published")
    publish_records(daily.limit(3), path, "daily_sum", START, fixtures.INTERVAL)
    publish_records(daily, path, "daily_sum", START, fixtures.INTERVAL, max_files=2)
    schema = daily.drop("rec_type", "im").schema
    return read_published_records(spark, path, schema, "daily_sum", START, fixtures.INTERVAL).drop("dt").select(*daily.columns)


@query("stream_compacted")
def stream_compacted(spark, base):
    """Word counts of a stream over the documents in six batches, the folders of the
    first batches folded: every batch is read once."""
    from pyspark.sql.types import LongType, StringType, StructField, StructType
    from slotwise.session import scratch_path
    from slotwise.sources.tables import read_table
    from slotwise.streaming.compaction import batch_ids, compact, read_batches
    from slotwise.streaming.words import process_batch
    docs = read_table(spark, "documents", base).select("doc_id", F.col("text").alias("value"))
    path = scratch_path(spark, "word-batches")
    for b in range(6):
        process_batch(docs.where(F.pmod("doc_id", F.lit(6)) == b), b, path)
    schema = StructType([StructField("word", StringType()), StructField("cnt", LongType())])
    for through in (1, 4):
        compact(spark, f"{path}/counts", schema, through)
    assert batch_ids(spark, f"{path}/counts") == [5]
    return read_batches(spark, f"{path}/counts", schema)


@query("dedup_across_runs")
def dedup_across_runs(spark, base):
    """First order per customer over two runs (orders before 1996, then the rest):
    the second run keeps the customers that the first has not seen."""
    from slotwise.operators.dedup_store import KeyStore
    from slotwise.session import scratch_path
    from slotwise.sources.tables import read_table
    orders = read_table(spark, "orders", base)
    early = F.to_date("o_orderdate") < F.lit("1996-01-01")
    store = KeyStore(scratch_path(spark, "key-store"), ranges=8, bits=1 << 15)
    path, parts = scratch_path(spark, "kept-orders"), []
    for run, rows in (("1", orders.where(early)), ("2", orders.where(~early))):
        store.unseen(rows, "o_custkey", run, ["o_orderdate", "o_orderkey"]).write.parquet(f"{path}/{run}")
        parts.append(spark.read.parquet(f"{path}/{run}"))
        store.add(parts[-1], "o_custkey", run)
    return parts[0].unionByName(parts[1])


@query("value_frequency_bounded")
def value_frequency_bounded(spark, base):
    """Most ordered parts by mergeable summaries, one per shipping year."""
    from slotwise.operators.frequent import frequent_values, value_states
    from slotwise.sources.tables import read_table
    li = read_table(spark, "lineitem", base).withColumn("year", F.year("l_shipdate"))
    return frequent_values(li, "l_partkey", 20, states=value_states(li, "l_partkey", by="year"))


@query("hourly_sum_lenient")
def hourly_sum_lenient(spark, base):
    inp = fixture_inputs(spark, base)
    inp.readings = fixtures.readings_src(spark, base, malformed=True)
    e = enriched_readings(inp, _params(typed=False, lenient=True))
    return out.hourly_sum(e, as_string=False, lenient=True)


@query("daily_sum_lenient_typed")
def daily_sum_lenient_typed(spark, base):
    inp = fixture_inputs(spark, base)
    inp.readings = fixtures.readings_src(spark, base, malformed=True)
    return out.daily_sum(enriched_readings(inp, _params(lenient=True)), as_string=False)


def _raw_dayparts(spark, base, **kw):
    """Raw day parts through clean-up and joins, over all event days."""
    inp = fixture_inputs(spark, base)
    inp.dayparts, inp.dayparts_clean = fixtures.dayparts_src(spark, base, fixtures.DAYPART_RAW_ROWS), False
    p = _params(start=ALL_DAYS[0], end=ALL_DAYS[1], calendar_match="day", as_of=AS_OF_EARLY, **kw)
    e = enriched_readings(inp, p)
    return e.groupBy("rd", "qtr_intr", "si", "pi").agg(F.count(F.lit(1)).alias("readings"))


@query("raw_dayparts")
def raw_dayparts(spark, base):
    return _raw_dayparts(spark, base)


@query("raw_dayparts_unique")
def raw_dayparts_unique(spark, base):
    return _raw_dayparts(spark, base, dayparts_unique=True, normalise_times=True)


@query("raw_dayparts_wrap")
def raw_dayparts_wrap(spark, base):
    return _raw_dayparts(spark, base, wrap_midnight=True, normalise_times=True)


@query("json_rerun_empties")
def json_rerun_empties(spark, base):
    """Two days written, the first one again without rows: the second is left."""
    from pyspark.sql.types import DoubleType, StringType, StructField, StructType
    from slotwise.session import scratch_path
    from slotwise.sinks.files import read_records, write_records
    daily = out.daily_sum(_enriched(spark, base), as_string=False)
    path = scratch_path(spark, "rerun")
    for dt, rows in ((START, daily), (END, daily), (START, daily.limit(0))):
        write_records(rows, path, rec_type="daily_sum", dt=dt, im=fixtures.INTERVAL)
    schema = StructType([StructField(n, StringType()) for n in ("sa", "sp", "rd", "uom")]
                        + [StructField("ds", DoubleType())]
                        + [StructField(n, StringType()) for n in ("rec_type", "dt", "im")])
    return read_records(spark, path, schema)


STREAM_PARTS = 3


@query("stream_part_words")
def stream_part_words(spark, base):
    """The documents arrive in parts, one batch each, then an empty file. Each
    part's own counts (batches are told apart by the part's marker word), and
    the number of batches."""
    from slotwise.plans.stream_job import run_files
    from slotwise.session import scratch_path
    from slotwise.sources.tables import read_table
    docs = read_table(spark, "documents", base)
    folder, counts_at = scratch_path(spark, "stream-parts"), scratch_path(spark, "stream-part-counts")
    part = F.pmod("doc_id", F.lit(STREAM_PARTS))
    marked = docs.select(part.alias("p"), F.concat(F.lit("<part"), part.cast("string"), F.lit("> "), F.col("text")).alias("text"))
    counts = totals = None
    for k in range(STREAM_PARTS + 1):
        marked.where(F.col("p") == k).select("text").write.mode("append").parquet(folder)
        _, counts, totals = run_files(spark, folder, fmt="parquet", schema="text string", value_col="text", out=counts_at)
    marker = counts.where(F.col("word").rlike("^<part[0-9]+>$")).select("batch_id", F.regexp_extract("word", "[0-9]+", 0).cast("int").alias("part"))
    rows = counts.join(F.broadcast(marker), "batch_id").where(~F.col("word").rlike("^<part[0-9]+>$"))
    batches = totals.select(F.lit(-1).alias("part"), F.lit("batches").alias("word"), F.lit(1).alias("cnt"))
    return rows.select("part", "word", "cnt").unionByName(batches.groupBy("part", "word").agg(F.sum("cnt").alias("cnt")))
