"""Enrichment of readings with the six dimensions (J1-J6, quirks X2-X5).

Plan shape (one shuffle of the fact at most):

* account-sized dimensions (accounts, plan assignments) are joined with each
  other first, on the dimension side;
* the fact meets that account frame once, in an equi join on the account id
  with the assignment range as residual predicate. Both sides are
  shuffled right under the join, so AQE can split a hot account's
  partition (skew join) or switch to a broadcast when the account side turns
  out small at runtime;
* seasons become their days, joined with the run-window calendar, and meet the
  fact in an equi join on use type and day: no range join, no nested loop;
* day parts are a left join on plan, day type and season with the
  time-of-day range as residual.

Building the plan runs no job. A caller that has measured the dimensions
(:func:`small_dimensions`, once per run) names those that may be broadcast;
otherwise the planner and AQE decide.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.operators.joins import ROWS_PER_SPLIT, measured, salted_join, small_enough
from slotwise.operators.normalise import READING_FIELDS

ENRICHED_FIELDS = READING_FIELDS + ("si", "cal_date", "pi")


def _maybe_broadcast(df: DataFrame, small: bool) -> DataFrame:
    return F.broadcast(df) if small else df


def small_dimensions(frames: dict[str, DataFrame]) -> frozenset[str]:
    """Names of the dimensions (``plans``, ``seasons``, ``calendar``,
    ``dayparts``) whose measured rows and bytes allow a broadcast. One job."""
    return frozenset(k for k, size in measured(frames).items() if small_enough(size))


def account_frame(accounts: DataFrame, plans: DataFrame, assignments: DataFrame,
                  plans_small: bool = False) -> DataFrame:
    """J2 + the equality part of J3 on the dimension side: one row per
    (account, assignment) with the plan's use type."""
    acct = accounts.join(_maybe_broadcast(plans, plans_small), "plan_id").join(assignments, "account_id")
    return acct.select(F.col("account_id").alias("_acct"), "plan_id",
                       F.col("use_type").alias("_use_type"), "assign_start", "assign_end")


def season_days(seasons: DataFrame, calendar: DataFrame, match: str, window: tuple[str, str] | None = None,
                calendar_small: bool = False) -> DataFrame:
    """J4 + J5 on the dimension side: (use type, reading day, season, calendar
    day, day type), one row per reading day and matching calendar day.

    Seasons are expanded to their days (inside ``window``, when given), and the
    calendar is joined on the day. ``match="range"`` pairs each reading day
    with every calendar day of its season, ``"day"`` with itself."""
    start, end = F.to_date("season_start"), F.to_date("season_end")
    if window:
        start, end = F.greatest(start, F.to_date(F.lit(window[0]))), F.least(end, F.to_date(F.lit(window[1])))
    days = F.when(start <= end, F.sequence(start, end)).otherwise(F.array().cast("array<date>"))
    # the calendar's days are not cut to the window: it has its own
    all_days = F.when(F.to_date("season_start") <= F.to_date("season_end"),
                      F.sequence(F.to_date("season_start"), F.to_date("season_end"))).otherwise(F.array().cast("array<date>"))
    if match == "day":
        s = seasons.select("use_type", "si", F.explode(days).alias("_on")).withColumn("cal_date", F.col("_on"))
    else:
        # calendar first: few of a season's days are in it
        s = seasons.select("use_type", "si", days.alias("_days"), F.explode(all_days).alias("cal_date"))
    s = s.join(_maybe_broadcast(calendar, calendar_small), "cal_date")
    if match == "range":
        s = s.withColumn("_on", F.explode("_days"))
    return s.select(F.col("use_type").alias("_season_use"), "_on", "si", "cal_date", "day_type")


def unique_dayparts(dp: DataFrame) -> DataFrame:
    """No duplicate parts, and where one part ends at the time at which
    another of its plan, day type and season begins, that time belongs to the
    one that begins (``_open``: the part's end is left out)."""
    dp = dp.dropDuplicates()
    key = ("_dp_plan", "_dp_day_type", "_dp_season")
    starts = dp.select(*[F.col(k).alias(f"_s{k}") for k in key], F.col("t0").alias("_start")).distinct()
    cond = (dp.t1 == starts._start) & (dp.t0 != dp.t1)
    for k in key:
        cond = cond & (dp[k] == starts[f"_s{k}"])
    return dp.join(starts, cond, "left").withColumn("_open", F.col("_start").isNotNull()).select(*dp.columns, "_open")


def enrich(readings: DataFrame, accounts: DataFrame, plans: DataFrame, assignments: DataFrame,
           seasons: DataFrame, calendar: DataFrame, dayparts: DataFrame,
           calendar_match: str = "range", dayparts_unique: bool = False,
           wrap_midnight: bool = False, normalise_times: bool = False, skew: str = "aqe",
           rows_per_split: int = ROWS_PER_SPLIT, small: frozenset[str] = frozenset(),
           window: tuple[str, str] | None = None, keep_account: bool = False, layout=None,
           ranges: str = "residual") -> DataFrame:
    """Join normalised readings with clean dimensions (see :mod:`dimensions`).

    ``calendar_match="range"`` reproduces the reference: every calendar day
    of the run window that lies in the reading's season matches, so over an
    n-day window each reading appears once per such day (quirk X2).
    ``"day"`` matches the reading's own day only.
    ``dayparts_unique`` drops duplicate day-part rows and settles parts that
    meet at a bound (X3); ``wrap_midnight`` lets a part whose UTC bounds cross
    midnight match (X4); ``normalise_times`` compares 'HH:mm:ss' on both sides
    (X5).

    ``small`` names the dimensions proven small (:func:`small_dimensions`);
    ``window`` (first and last reading day) bounds the days a season is expanded
    to. ``skew="aqe"`` leaves hot accounts to AQE's skew-join split (both sides
    are shuffled right under the join); ``skew="split"`` splits every account
    with more than ``rows_per_split`` readings over several tasks itself
    (:func:`salted_join`), independent of runtime statistics.

    Readings with the columns of ``JOIN_KEYS`` are joined on the account id and
    day in their own types; without them on their text forms. ``keep_account``
    leaves the account id in the result: the outputs group by it beside its text
    form, so they aggregate inside the join's partitions.

    ``layout`` (an :class:`~slotwise.operators.layout.AccountLayout` of these
    readings and account-sized dimensions) takes J1 and J3 from the bucketed
    tables, without a shuffle of the fact; ``readings``, ``accounts``, ``plans``
    and ``assignments`` are not read then. ``ranges="ordered"`` joins assignment
    ranges by ordering (:func:`~slotwise.operators.interval_join.interval_join`):
    for accounts with many assignments, where the residual form would make every
    pair of an account's readings and assignments.
    """
    if ranges not in ("residual", "ordered"):
        raise ValueError("ranges must be 'residual' or 'ordered'")
    if calendar_match not in ("range", "day"):
        raise ValueError("calendar_match must be 'range' or 'day'")
    r = readings if "_day" in readings.columns else readings.withColumn("_day", F.to_date("pfd"))
    native = "_account" in readings.columns

    dp = dayparts.select(F.col("pi"), F.col("plan_id").alias("_dp_plan"), F.col("t0"), F.col("t1"),
                         F.col("day_type").alias("_dp_day_type"), F.col("season").alias("_dp_season"))
    dp = unique_dayparts(dp) if dayparts_unique else dp.withColumn("_open", F.lit(False))

    # J1 + J3: fact x account frame (single shuffle join of the fact).
    if layout is not None:
        j = layout.joined(dayparts.sparkSession)
        native = True
    else:
        acct = account_frame(accounts, plans, assignments, "plans" in small)
        key = "_account" if native else "sa"
        if not native:
            acct = acct.withColumn("_acct", F.col("_acct").cast("string"))
        if ranges == "ordered":
            from slotwise.operators.interval_join import interval_join
            j = interval_join(r, acct, [(key, "_acct")], "_day", "assign_start", "assign_end", rows_per_split=rows_per_split)
        elif skew == "split":
            j = salted_join(r, acct, key, "_acct",
                            lambda b, s: (b._day >= s.assign_start) & (b._day < s.assign_end),
                            rows_per_split=rows_per_split)
        else:
            j = r.join(acct, (r[key] == acct._acct) & (r._day >= acct.assign_start) & (r._day < acct.assign_end))

    # J4 + J5: fact x season days, equi on use type and day.
    sd = season_days(seasons, calendar, calendar_match, window, "calendar" in small)
    bounded = calendar_match == "day" or window is not None
    sd = _maybe_broadcast(sd, bounded and {"seasons", "calendar"} <= set(small))
    j = j.join(sd, (j._use_type == sd._season_use) & (j._day == sd._on))

    # Left join of day parts on plan, day type, season and time of day.
    dp = _maybe_broadcast(dp, "dayparts" in small)
    slot = F.substring(j.qtr_intr_10, 1, 8) if normalise_times else j.qtr_intr_10
    before_end = F.when(dp["_open"], slot < dp.t1).otherwise(slot <= dp.t1) if dayparts_unique else slot <= dp.t1
    inside = (slot >= dp.t0) & before_end
    if wrap_midnight:
        inside = F.when(dp.t0 <= dp.t1, inside).otherwise((slot >= dp.t0) | before_end)
    j = j.join(dp, (dp._dp_plan == j.plan_id) & (dp._dp_day_type == j.day_type)
               & (dp._dp_season == j.si) & inside, "left")
    return j.select(*ENRICHED_FIELDS, *(["_account"] if keep_account and native else []))
