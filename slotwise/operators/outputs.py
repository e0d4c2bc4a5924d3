"""Output records of the interval job.

Every output is one aggregation over the enriched readings with partial
(map-side) aggregation, so a hot key is combined inside each map task before
the shuffle. Pivots have one column per slot that the readings show, as the
reference's do (one bounded job finds them), or per slot of an explicit list; a
reading outside such a list fails the job, and a reading without a slot keeps
its key with empty cells. Both rules hold for text and numeric values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slotwise.functions.readings import day_bounds

# Slot names for each supported interval: 96 quarter-hours 'HHMM', 24 hour
# starts 'HH00'; hour keys 'HH'.
QUARTER_SLOTS = tuple(f"{h:02d}{m:02d}" for h in range(24) for m in (0, 15, 30, 45))
HOUR_SLOTS = tuple(f"{h:02d}00" for h in range(24))
HOURS = tuple(f"{h:02d}" for h in range(24))
# Largest number of distinct slot keys a day can have ('HHMM').
MAX_SLOTS = 24 * 60
# Slots up to which an aggregation keeps one field per slot for each key.
MAX_BUFFERED = 96

READING_KEYS = ("sa", "sp", "im", "uom", "pc", "pfd", "rd", "si", "rsc")
HOURLY_KEYS = ("sa", "sp", "uom", "rd", "im")
DAILY_KEYS = ("sa", "sp", "rd", "im", "uom")
DEMAND_KEYS = ("sa", "sp", "rd", "pfd", "im", "demand_factor")
INDICATOR_KEYS = ("sa", "sp", "rd", "im")
STATUS_KEYS = ("sa", "sp", "uom", "rd", "im")

# Closed value sets of the text pivots: statuses made by the normaliser, and
# day-part codes kept by the day-part clean-up ('' from its coalesce).
STATUS_CODES = ("ACTUAL", "ESTIMATED")
PEAK_CODES = ("", "MID", "OFF", "ON", "SOF")

# Record type tags (directory names of the JSON output).
REC_TYPES = {"reading": "rdng_meas", "hourly": "hrly_sum", "daily": "daily_sum", "demand": "daily_max",
             "peak": "peak_ind", "outage": "outage_ind", "status": "status"}


def _grouped(df: DataFrame, keys):
    """Grouped by the keys, and by the account id where the frame carries it
    (the account's text follows from it, so the groups are the same)."""
    return df.groupBy(*keys, *[c for c in df.columns if c == "_account"])


def slots_for(interval: int) -> tuple[str, ...]:
    """Fixed slot list of an interval length (15 -> 96 names, 60 -> 24)."""
    return {15: QUARTER_SLOTS, 60: HOUR_SLOTS}[int(interval)]


def observed_values(df: DataFrame, col: str, max_values: int = MAX_SLOTS) -> list[str]:
    """Sorted distinct non-NULL values of a key column, as the
    reference discovers its pivot columns. The distinct is a partial
    aggregation; at most ``max_values`` names (all that 'HHMM' can spell) reach
    the driver. More means malformed keys, which the error names."""
    rows = (df.select(col).where(F.col(col).isNotNull()).distinct()
            .orderBy(F.col(col).rlike(r"^([01]\d|2[0-3])([0-5]\d)?$"), col).limit(max_values + 1).collect())
    if len(rows) > max_values:
        raise ValueError(f"more than {max_values} distinct values in {col}, such as {[r[0] for r in rows[:5]]}")
    return sorted(r[0] for r in rows)


class SlotsSeen:
    """Slots and hours that a frame's rows show, collected by the pass that computes
    it (``Observation``): two bitmaps of 4 KB, one bit per minute and hour of the day,
    so the size is fixed whatever the rows hold. Keys that spell no time of day are
    counted; a frame that has some needs :func:`observed_values`."""

    def __init__(self, df: DataFrame):
        self._seen = Observation("slots")
        slot, hour = F.col("qtr_intr"), F.col("hr_intr")
        is_slot, is_hour = slot.rlike(r"^([01]\d|2[0-3])[0-5]\d$"), hour.rlike(r"^([01]\d|2[0-3])$")
        minute = F.when(is_slot, F.substring(slot, 1, 2).cast("bigint") * 60 + F.substring(slot, 3, 2).cast("bigint"))
        odd = F.coalesce(~is_slot, F.lit(False)) | F.coalesce(~is_hour, F.lit(False))
        # a bit that no row means (32767) takes the rows without a key
        self.frame = df.observe(self._seen,
                                F.bitmap_construct_agg(F.coalesce(minute, F.lit(32767).cast("bigint"))).alias("slots"),
                                F.bitmap_construct_agg(F.when(is_hour, hour.cast("bigint")).otherwise(F.lit(32767).cast("bigint"))).alias("hours"),
                                F.sum(odd.cast("bigint")).alias("odd"))

    def found(self) -> tuple[list[str], list[str]] | None:
        """(slots, hours), sorted, once an action has computed the frame; None if
        some key spells no time of day."""
        got = self._seen.get
        if got["odd"]:
            return None

        def bits(b):
            return [i for i in range(MAX_SLOTS) if b is not None and b[i // 8] >> (i % 8) & 1]
        return [f"{m // 60:02d}{m % 60:02d}" for m in bits(got["slots"])], [f"{h:02d}" for h in bits(got["hours"])]


def _listed(key: Column, names) -> Column:
    """``key`` if NULL or listed; any other value fails the job."""
    return F.when(key.isNull() | key.isin(list(names)), key).otherwise(
        F.raise_error(F.concat(F.lit("key outside the pivot's list: "), key)))


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """A1/A4/D1 as a frame: distinct non-NULL values of ``col``."""
    return df.select(col).where(F.col(col).isNotNull()).distinct()


def slot_pivot(df: DataFrame, keys, slot_col: str, value: Column | str, slots,
               agg=F.max, prefix: str = "", fill=0, codes=None, tag: str | None = None,
               fill_strings: str | None = None) -> DataFrame:
    """P15 + A2-style pivot: one row per key, one column per slot holding
    ``agg(value)`` of that slot's rows (NULL when none).

    Rows are never filtered: a NULL slot keeps its key, with no cell; a slot
    outside ``slots`` fails the job.

    For numeric values Catalyst plans ``groupBy().pivot(slot, slots)`` in two
    aggregation phases (per key and slot, then one hash lookup per row to
    place the value), both with map-side partial aggregation. Text values are
    aggregated per (key, slot) cell and the at most ``len(slots)`` cells of a
    key are gathered into a map, read out per slot (Catalyst's own text pivot
    keeps one text buffer per slot in a sort-based aggregation). So are numeric
    values with more than ``MAX_BUFFERED`` slots.

    ``codes``: the closed set of values a text column can hold. The pivot
    then aggregates each value's rank in text order (same max / min) and
    decodes it afterwards, so the text pivot also gets the numeric plan. A
    value outside ``codes`` fails the job instead of being dropped.

    ``fill`` replaces NULL in numeric slot columns like the reference's
    ``na.fill(0)``; text columns stay NULL (quirk X8) unless ``fill_strings``
    gives their filler. ``fill=None`` keeps every NULL. ``tag`` adds a
    constant ``rec_type`` column."""
    v = F.col(value) if isinstance(value, str) else value
    slots = list(slots)
    names = [f"{prefix}{x}" for x in slots]
    text_fill = None if fill_strings is None else "'" + fill_strings.replace("'", "''") + "'"
    if codes is not None:
        ordered = sorted(set(codes))
        dictionary = F.array(*[F.lit(c) for c in ordered])
        pos = F.array_position(dictionary, v).cast("int")
        v = F.when(pos == 0, F.raise_error(F.concat(F.lit(f"value outside {ordered}: "), v.cast("string")))) \
             .otherwise(pos)
    account = [c for c in df.columns if c == "_account"]
    narrow = df.select(*keys, *account, _listed(F.col(slot_col), slots).alias("_slot"), v.alias("_v"))
    exprs = [f"`{k}`" for k in keys]
    end = [] if tag is None else [f"'{tag}' AS rec_type"]
    if not slots:
        return _grouped(narrow, keys).agg(F.max("_slot")).selectExpr(*exprs, *end)     # no slot seen: keys only
    wide_list = len(slots) > MAX_BUFFERED
    kind = narrow.schema["_v"].dataType
    dictionary_sql = None if codes is None else "array(" + ", ".join("'" + c.replace("'", "''") + "'" for c in ordered) + ")"
    if wide_list or (codes is None and isinstance(kind, T.StringType)):
        # Text values: one aggregate per (key, slot) cell, then the cells of a
        # key gathered into a map (at most one entry per slot, so bounded)
        # and read out per slot. Each row updates one buffer instead of one
        # per slot. Long lists too: a buffer of one field per slot for each key
        # would take memory for slots that the key does not have.
        cells = narrow.groupBy(*keys, *account, "_slot").agg(agg("_v").alias("_v"))
        if wide_list:
            # few bytes here become many per key below: not to be merged by their bytes
            cells = cells.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys, *account)
        cell = F.when(F.col("_slot").isNotNull(), F.struct("_slot", "_v"))      # collect_list leaves NULLs out
        wide = _grouped(cells, keys).agg(F.map_from_entries(F.collect_list(cell)).alias("_m"))
        for x, n in zip(slots, names):
            if codes is not None:
                one = _filled(f"get({dictionary_sql}, _m['{x}'] - 1)", text_fill)
            elif isinstance(kind, T.NumericType):
                one = _filled(f"_m['{x}']", None if fill is None else str(fill))
            else:
                one = _filled(f"_m['{x}']", text_fill if isinstance(kind, T.StringType) else None)
            exprs.append(f"{one} AS `{n}`")
        return wide.selectExpr(*exprs, *end)
    wide = _grouped(narrow, keys).pivot("_slot", slots).agg(agg("_v"))
    # One projection for renaming, decoding / filling and the tag (a single
    # analysis of the wide plan instead of one per step).
    if codes is not None:
        # rank -> code (0-based lookup; an empty cell stays NULL)
        exprs += [_filled(f"get({dictionary_sql}, `{x}` - 1)", text_fill) + f" AS `{n}`" for x, n in zip(slots, names)]
    else:
        numeric = fill is not None and isinstance(wide.schema[str(slots[0])].dataType, T.NumericType)
        exprs += [(f"coalesce(`{x}`, {fill}) AS `{n}`" if numeric else f"`{x}` AS `{n}`")
                  for x, n in zip(slots, names)]
    return wide.selectExpr(*exprs, *end)


def _filled(sql: str, filler: str | None) -> str:
    return sql if filler is None else f"coalesce({sql}, {filler})"


def _tag(df: DataFrame, kind: str) -> DataFrame:
    return df.withColumn("rec_type", F.lit(REC_TYPES[kind]))


def _is_text(df: DataFrame, col: str) -> bool:
    return df.schema[col].dataType.typeName() == "string"


def _slots(enriched: DataFrame, slots) -> list[str]:
    """The given slots, or those that the readings show."""
    return observed_values(enriched, "qtr_intr") if slots is None else list(slots)


def _number(df: DataFrame, lenient: bool) -> Column:
    """The reading value as a number; malformed text fails, or is NULL where
    ``lenient`` (quirk X15)."""
    v = F.col("rm")
    if not _is_text(df, "rm"):
        return v
    return v.try_cast("double") if lenient else v.cast("double")


def reading_pivot(enriched: DataFrame, slots=None, compare: str = "native", prefix: str = "",
                  fill_strings: str | None = None, lenient: bool = False) -> DataFrame:
    """A2: reading value per slot, ``max`` per cell.

    With text values the maximum is by text order ('9.5' > '10.25'), as in
    the reference (quirk X1); ``compare="numeric"`` compares numbers."""
    v = _number(enriched, lenient) if compare == "numeric" else F.col("rm")
    return slot_pivot(enriched, READING_KEYS, "qtr_intr", v, _slots(enriched, slots), prefix=prefix, tag=REC_TYPES["reading"],
                      fill_strings=fill_strings)


def hourly_sum(enriched: DataFrame, as_string: bool = True, lenient: bool = False) -> DataFrame:
    """A3: round(sum(value), 4) per account, point, unit, day, hour, interval."""
    return _grouped(enriched, ("sa", "sp", "uom", "rd", "hr_intr", "im")).agg(
        _round_sum(_number(enriched, lenient), as_string).alias("hs")).drop("_account")


def _round_sum(v: Column, as_string: bool) -> Column:
    s = F.round(F.sum(v), 4)
    return s.cast("string") if as_string else s.cast("double")


def hourly_pivot(enriched: DataFrame, hours=None, as_string: bool = True, prefix: str = "",
                 fill_strings: str | None = None, lenient: bool = False) -> DataFrame:
    """A5: the hourly sums of A3 pivoted by hour, as one pivot over the
    readings (Catalyst's two-phase pivot: round(sum) per key and hour, then
    placed per key). The reference computes A3, then pivots it with ``max``
    over one value per cell, which is the same table. Hours as in
    :func:`slot_pivot`: those that the readings show, or a list."""
    hours = observed_values(enriched, "hr_intr", 24) if hours is None else list(hours)
    keyed = enriched.withColumn("_hour", _listed(F.col("hr_intr"), hours)).withColumn("_n", _number(enriched, lenient))
    keys = [f"`{k}`" for k in HOURLY_KEYS]
    tag = f"'{REC_TYPES['hourly']}' AS rec_type"
    if not hours:
        return _grouped(keyed, HOURLY_KEYS).agg(F.max("_hour")).selectExpr(*keys, tag)
    wide = _grouped(keyed, HOURLY_KEYS).pivot("_hour", hours).agg(_round_sum(F.col("_n"), as_string))
    # na.fill(0) fills numbers only
    filler = ("0" if fill_strings is None else None) if not as_string else (
        None if fill_strings is None else "'" + fill_strings.replace("'", "''") + "'")
    return wide.selectExpr(*keys, *[_filled(f"`{h}`", filler) + f" AS `{prefix}{h}`" for h in hours], tag)


def daily_sum(enriched: DataFrame, as_string: bool = True, lenient: bool = False) -> DataFrame:
    """round(sum(value), 4) per account, point, day, interval, unit."""
    out = _grouped(enriched, DAILY_KEYS).agg(_round_sum(_number(enriched, lenient), as_string).alias("ds"))
    return _tag(out.drop("_account"), "daily")


def hour_partials(enriched: DataFrame, lenient: bool = False) -> DataFrame:
    """Exact sums per account, point, unit, day, hour and interval: one aggregation
    of the readings from which the sums of every coarser grain follow. Numbers that
    are not decimals are summed as ``decimal(38,4)`` of their four-digit rounding."""
    v = _number(enriched, lenient)
    if not isinstance(enriched.select(v.alias("v")).schema[0].dataType, T.DecimalType):
        v = F.round(v.cast("decimal(38,6)"), 4).cast("decimal(38,4)")
    return _grouped(enriched, ("sa", "sp", "uom", "rd", "hr_intr", "im")).agg(F.sum(v).alias("_sum")).drop("_account")


def sums_from(partials: DataFrame, grain: str, as_string: bool = True) -> DataFrame:
    """A3 ("hour"), A6 ("day") or sums per month and point ("month") from
    :func:`hour_partials`, by regrouping them: the readings are not read again."""
    text = lambda c: F.round(c, 4).cast("string" if as_string else "double")
    if grain == "hour":
        return partials.select("sa", "sp", "uom", "rd", "hr_intr", "im", text(F.col("_sum")).alias("hs"))
    if grain == "day":
        return _tag(partials.groupBy(*DAILY_KEYS).agg(text(F.sum("_sum")).alias("ds")), "daily")
    if grain == "month":
        month = F.substring("rd", 1, 6).alias("month")
        return partials.groupBy("sa", "sp", "im", "uom", month).agg(text(F.sum("_sum")).alias("ms"))
    raise ValueError("grain must be 'hour', 'day' or 'month'")


def daily_demand(enriched: DataFrame, as_string: bool = True, unit: str = "kd", lenient: bool = False) -> DataFrame:
    """A7 + F8 + P17: peak demand of a day = max(value) x demand factor over
    the rows of unit ``unit``, with the day's start and end texts."""
    dm = F.max(_number(enriched, lenient).cast("double")) * F.col("demand_factor").cast("int")
    out = (_grouped(enriched.where(F.col("uom") == F.lit(unit)), DEMAND_KEYS)
           .agg((dm.cast("string") if as_string else dm.cast("double")).alias("dmkd")).drop("_account"))
    start, end = day_bounds("pfd")
    return _tag(out, "demand").withColumn("mstkd", start).withColumn("metkd", end)


def peak_pivot(enriched: DataFrame, slots=None, prefix: str = "", codes=PEAK_CODES,
               fill_strings: str | None = None) -> DataFrame:
    """Day-part code per slot; max by text order (SOF > ON > OFF > MID).
    ``codes``: the day-part codes the enriched rows can carry (those kept by
    the day-part clean-up, plus '' from its ``coalesce``); ``None`` for any
    text."""
    return slot_pivot(enriched, INDICATOR_KEYS, "qtr_intr", "pi", _slots(enriched, slots), prefix=prefix, codes=codes,
                      tag=REC_TYPES["peak"], fill_strings=fill_strings)


def outage_pivot(enriched: DataFrame, slots=None, prefix: str = "") -> DataFrame:
    """Outage flag per slot, max per cell, numeric NULL -> 0."""
    return slot_pivot(enriched, INDICATOR_KEYS, "qtr_intr", "oi", _slots(enriched, slots), prefix=prefix, tag=REC_TYPES["outage"])


def status_pivot(enriched: DataFrame, slots=None, prefix: str = "", codes=STATUS_CODES,
                 fill_strings: str | None = None) -> DataFrame:
    """A10: reading status per slot; ESTIMATED wins over ACTUAL (the only two
    statuses the normaliser produces; ``codes=None`` for any text)."""
    return slot_pivot(enriched, STATUS_KEYS, "qtr_intr", "st", _slots(enriched, slots), prefix=prefix, codes=codes,
                      tag=REC_TYPES["status"], fill_strings=fill_strings)


def all_outputs(enriched: DataFrame, slots=None, hours=None, as_string: bool = True,
                compare: str = "native", prefix: str = "", hour_prefix: str = "", peak_codes=PEAK_CODES,
                fill_strings: str | None = None, lenient: bool = False) -> dict[str, DataFrame]:
    """The seven record types of the interval job, keyed by record type."""
    slots = _slots(enriched, slots)
    text = {"fill_strings": fill_strings}
    return {
        REC_TYPES["reading"]: reading_pivot(enriched, slots, compare, prefix, lenient=lenient, **text),
        REC_TYPES["hourly"]: hourly_pivot(enriched, hours, as_string, hour_prefix, lenient=lenient, **text),
        REC_TYPES["daily"]: daily_sum(enriched, as_string, lenient),
        REC_TYPES["demand"]: daily_demand(enriched, as_string, lenient=lenient),
        REC_TYPES["peak"]: peak_pivot(enriched, slots, prefix, peak_codes, **text),
        REC_TYPES["outage"]: outage_pivot(enriched, slots, prefix),
        REC_TYPES["status"]: status_pivot(enriched, slots, prefix, **text),
    }
