"""The interval job (section 3.1 of the survey): raw readings + six raw
dimensions -> enriched readings -> seven record types -> partitioned JSON.

Each step is a ``DataFrame -> DataFrame`` function. Jobs run in :func:`run`: one
that measures the four small dimensions, the slot discovery (unless slots are
listed) and the seven writes.
"""

from __future__ import annotations

import warnings
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from slotwise.operators import dimensions as dims
from slotwise.operators.enrich import enrich, small_dimensions
from slotwise.operators.frames import reused
from slotwise.operators.normalise import normalise_readings
from slotwise.operators.outputs import HOURS, PEAK_CODES, REC_TYPES, SlotsSeen, all_outputs, daily_sum, slots_for
from slotwise.session import apply_runtime_conf
from slotwise.sinks.files import write_records
from slotwise.sources import fixtures


@dataclass
class IntervalInputs:
    """Raw inputs with the reference's column names."""
    readings: DataFrame
    accounts: DataFrame
    plans: DataFrame
    assignments: DataFrame
    seasons: DataFrame
    calendar: DataFrame
    dayparts: DataFrame          # raw billing day parts, or already clean ones
    dayparts_clean: bool = False


@dataclass
class IntervalParams:
    start: str
    end: str
    interval: int = 15
    excluded_plan: str = dims.EXCLUDED_PLAN
    as_of: str | None = None
    typed: bool = False
    lenient: bool = False            # malformed values: NULL instead of a failure (X15)
    calendar_match: str = "range"
    dayparts_unique: bool = False
    wrap_midnight: bool = False
    normalise_times: bool = False
    compare: str = "native"
    slots: object = "observed"       # "observed", "fixed" (the aligned ones) or an explicit list
    peak_codes: tuple | None = None  # closed list of clean day-part codes; None for any text
    fill_strings: str | None = None  # filler of empty text cells (X8); None leaves them NULL
    prefix: str = ""
    hour_prefix: str = ""
    extra: dict = field(default_factory=dict)


def fixture_inputs(spark: SparkSession, base: str) -> IntervalInputs:
    """Raw inputs derived from the driver tables (see :mod:`fixtures`)."""
    return IntervalInputs(
        readings=fixtures.readings_src(spark, base), accounts=fixtures.accounts_src(spark, base),
        plans=fixtures.plans_src(spark, base), assignments=fixtures.assignments_src(spark, base),
        seasons=fixtures.seasons_src(spark, base), calendar=fixtures.calendar_src(spark, base),
        dayparts=fixtures.dayparts_clean(spark, base), dayparts_clean=True)


def clean_dimensions(inp: IntervalInputs, p: IntervalParams) -> dict[str, DataFrame]:
    """The six dimensions as the enrichment takes them."""
    return {
        "accounts": dims.clean_accounts(inp.accounts, p.excluded_plan),
        "plans": dims.clean_plans(inp.plans),
        "assignments": dims.clean_assignments(inp.assignments),
        "seasons": dims.clean_seasons(inp.seasons),
        "calendar": dims.clean_calendar(inp.calendar, p.start, p.end),
        "dayparts": inp.dayparts if inp.dayparts_clean else dims.clean_dayparts(
            inp.dayparts, as_of=p.as_of, normalise_times=p.normalise_times),
    }


def enriched_readings(inp: IntervalInputs, p: IntervalParams, small: frozenset[str] = frozenset(),
                      keep_account: bool = False) -> DataFrame:
    """Normalise, clean the dimensions and join them (steps 1-2 of the job).
    Runs no job; ``small`` names the dimensions measured as small."""
    if p.calendar_match == "range" and p.start != p.end:
        warnings.warn(f"calendar_match='range' over {p.start}..{p.end}: each reading is repeated once per "
                      "calendar day of its season in the window (quirk X2); use calendar_match='day' "
                      "for multi-day loads", stacklevel=2)
    readings = normalise_readings(inp.readings, p.start, p.end, p.interval, typed=p.typed, lenient=p.lenient, keep_keys=True)
    return enrich(
        readings, **clean_dimensions(inp, p),
        calendar_match=p.calendar_match, dayparts_unique=p.dayparts_unique,
        wrap_midnight=p.wrap_midnight, normalise_times=p.normalise_times,
        **{"small": small, "window": (p.start, p.end), "keep_account": keep_account, **p.extra})


def account_layout(inp: IntervalInputs, p: IntervalParams, name: str, path: str, **kw):
    """The run's readings and account frame as bucketed tables, for
    ``extra={"layout": ...}`` of this and later runs over the same readings."""
    from slotwise.operators.layout import write_account_layout
    d = clean_dimensions(inp, p)
    readings = normalise_readings(inp.readings, p.start, p.end, p.interval, typed=p.typed, lenient=p.lenient, keep_keys=True)
    return write_account_layout(readings, d["accounts"], d["plans"], d["assignments"], name, path, **kw)


def measured_readings(inp: IntervalInputs, p: IntervalParams) -> DataFrame:
    """:func:`enriched_readings` for a run: the four small dimensions are
    measured first (one job), and those within the bounds are broadcast."""
    d = clean_dimensions(inp, p)
    small = small_dimensions({k: d[k] for k in ("plans", "seasons", "calendar", "dayparts")})
    return enriched_readings(inp, p, small, keep_account=True)


def outputs(enriched: DataFrame, p: IntervalParams, peak_codes: tuple | None = None,
            found: tuple[list[str], list[str]] | None = None) -> dict[str, DataFrame]:
    """The seven record frames over one enriched frame. Observed slots and
    hours are ``found`` already, or else by two bounded jobs here."""
    observed = p.slots == "observed"
    slots = None if observed else slots_for(p.interval) if p.slots == "fixed" else tuple(p.slots)
    hours = None if observed else HOURS
    if observed and found is not None:
        slots, hours = found
    return all_outputs(enriched, slots, hours, as_string=not p.typed, compare=p.compare,
                       prefix=p.prefix, hour_prefix=p.hour_prefix, peak_codes=peak_codes,
                       fill_strings=p.fill_strings, lenient=p.lenient)


def write_concurrently(frames: dict, write, threads: int = 4) -> list[str]:
    """Run one write action per frame, up to ``threads`` at a time (Spark
    schedules concurrent jobs from driver threads; each retries on its own).
    Errors are raised after all submitted writes finish."""
    if threads <= 1:
        for name, df in frames.items():
            write(name, df)
        return list(frames)
    with ThreadPoolExecutor(max_workers=threads) as pool:
        futures = {name: pool.submit(write, name, df) for name, df in frames.items()}
        for f in futures.values():
            f.result()
    return list(futures)


def write_all(frames: dict, write, threads: int = 4) -> list[str]:
    """The first write alone, so that it fills the cache under the frames, then
    the others at a time."""
    first, *rest = frames
    write(first, frames[first])
    return [first, *write_concurrently({k: frames[k] for k in rest}, write, threads)]


def run(inp: IntervalInputs, p: IntervalParams, path: str, max_files: dict | None = None,
        partition_by_reading_date: bool = False, reuse: str = "persist", threads: int = 4,
        sort_by: dict | None = None, keep_fields: bool = False) -> list[str]:
    """Run the whole job and write every record type under ``path`` as
    ``rec_type=<t>/dt=<d>/im=<n>/`` JSON, replacing only those partitions.

    The enriched frame feeds seven aggregations, so it is computed once and
    reused (``reuse="persist"`` keeps it in executor memory / disk and is
    recomputed from lineage for lost blocks; ``"checkpoint"`` writes it to
    the shared folder first and removes it in the end). The first write fills
    the cache; the other six are independent jobs over it and run ``threads``
    at a time. ``sort_by`` orders the rows inside the files, by record type
    (O2); ``keep_fields`` also stores the partition columns in the records."""
    apply_runtime_conf(inp.readings.sparkSession)
    enriched = measured_readings(inp, p)
    # parts cleaned here have known codes only
    peak_codes = p.peak_codes if inp.dayparts_clean else PEAK_CODES
    dt = None if partition_by_reading_date else p.start

    def write(rec_type, df):
        write_records(df, path, rec_type, dt=dt, im=p.interval, max_files=(max_files or {}).get(rec_type),
                      sort_by=(sort_by or {}).get(rec_type), keep_fields=keep_fields)

    if p.slots != "observed":
        with reused(enriched, reuse) as base:
            return write_all(outputs(base, p, peak_codes), write, threads)
    # The daily sums need no slots: writing them fills the cache, and that pass sees
    # which slots and hours there are.
    seen = SlotsSeen(enriched)
    with reused(seen.frame, reuse) as base:
        daily = REC_TYPES["daily"]
        write(daily, daily_sum(base, as_string=not p.typed, lenient=p.lenient))
        frames = outputs(base, p, peak_codes, seen.found())
        write_concurrently({k: v for k, v in frames.items() if k != daily}, write, threads)
        return list(frames)
