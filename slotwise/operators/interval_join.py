"""Interval join by ordering (J3, J6): facts meet the ranges that hold them in
time linear in both.

An equi join on the key with the range as residual makes every pair of a key's
facts and ranges before it drops most of them. Here the ranges of a key become
disjoint segments, each with the list of the ranges that cover it; facts and
segments are put in one order of (key, position), and every fact carries the last
segment that began (``last(..., ignorenulls)`` over the running frame). A fact
inside its segment is joined with the segment's list; one row per fact and segment
goes through the order, nothing else.

Segments: ranges that overlap nothing are their own. Others are cut at all their
bounds, inside the run of ranges that overlap each other, so the work on the range
side is bounded by the overlaps there.

Positions are (value, side): a closed end lies just behind its value, a half-open
one just before it, and facts in between, so both kinds of range, and facts on a
bound, are exact. A key with more than ``rows_per_split`` facts is dealt over
several salts by a hash of the row, and its segments are repeated per salt.

Sorts run in partitions of a number that follows from the measured rows and bytes
(``ROWS_PER_TASK``, ``BYTES_PER_TASK``), so a task's memory does not grow with the
tables. Partitions merged by their shuffled bytes could hold far more: these rows
compress to a twentieth.

Ranges with a null key or bound, and empty ones, match nothing. Facts with a null
key or position match nothing and stay in a left join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from slotwise.operators.joins import ROWS_PER_SPLIT, measured, small_enough
from slotwise.operators.layout import hot_keys

_BEFORE, _AT, _AFTER = 0, 1, 2
ROWS_PER_TASK, BYTES_PER_TASK = 200_000, 32 << 20


def partitions(*sizes: tuple[int, int]) -> int:
    """Partitions for frames of these (rows, bytes)."""
    rows, size = (sum(s[i] or 0 for s in sizes) for i in (0, 1))
    return max(1, -(-rows // ROWS_PER_TASK), -(-size // BYTES_PER_TASK))


def _key(keys) -> "F.Column":
    return F.struct(*[F.col(f"`{k}`").alias(f"k{i}") for i, k in enumerate(keys)])


def segments(ranges: DataFrame, keys, start: str, end: str, closed: bool = False, parts: int | None = None) -> DataFrame:
    """(_key, _from, _to, _held): disjoint segments of each key's ranges, from a
    position (inclusive) to one (exclusive), with the covering ranges' rows.
    ``parts``: partitions of the sorts (the session's number if not given)."""
    dealt = [] if parts is None else [parts]
    side = F.lit(_AFTER if closed else _BEFORE)
    kinds = {f.name: f.dataType for f in ranges.schema.fields}
    some = F.lit(True)
    for k in keys:
        some = some & F.col(f"`{k}`").isNotNull()
    r = ranges.select(_key(keys).alias("_key"), F.struct(F.col(f"`{start}`").alias("v"), F.lit(_BEFORE).alias("s")).alias("_a"),
                      F.struct(F.col(f"`{end}`").cast(kinds[start]).alias("v"), side.alias("s")).alias("_z"),
                      F.struct(*[F.col(f"`{c}`") for c in ranges.columns]).alias("_row"),
                      (some & F.col(f"`{start}`").isNotNull() & F.col(f"`{end}`").isNotNull()).alias("_ok"))
    r = r.where(F.col("_ok") & (F.col("_a") < F.col("_z"))).drop("_ok")
    r = r.repartition(*dealt, "_key")
    # runs of ranges that overlap each other
    order = Window.partitionBy("_key").orderBy("_a", "_z")
    reach = F.max("_z").over(order.rowsBetween(Window.unboundedPreceding, -1))
    r = r.withColumn("_new", (reach.isNull() | (F.col("_a") >= reach)).cast("int"))
    r = r.withColumn("_run", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    alone = F.count(F.lit(1)).over(Window.partitionBy("_key", "_run")) == 1
    r = r.withColumn("_alone", alone)
    single = r.where("_alone").select("_key", F.col("_a").alias("_from"), F.col("_z").alias("_to"), F.array("_row").alias("_held"))
    many = r.where("NOT _alone").repartition(*dealt, "_key", "_run")
    bounds = many.select(F.col("_key").alias("_bkey"), F.col("_run").alias("_brun"), F.explode(F.array("_a", "_z")).alias("_from")).distinct()
    bounds = bounds.withColumn("_to", F.lead("_from").over(Window.partitionBy("_bkey", "_brun").orderBy("_from"))).where("_to IS NOT NULL")
    cover = bounds.join(many, (F.col("_bkey") == F.col("_key")) & (F.col("_brun") == F.col("_run"))
                        & (F.col("_a") <= F.col("_from")) & (F.col("_z") > F.col("_from")))
    cut = cover.groupBy("_key", "_from", "_to").agg(F.collect_list("_row").alias("_held"))     # the overlap's depth
    return single.unionByName(cut)


def interval_join(facts: DataFrame, ranges: DataFrame, on, at: str, start: str, end: str, closed: bool = False,
                  how: str = "inner", rows_per_split: int = ROWS_PER_SPLIT) -> DataFrame:
    """Facts with each range of their key that holds their position: the facts'
    columns, then the ranges' (NULL where none holds it and ``how`` is "left").

    ``on``: pairs (fact column, range column). ``at`` is compared with ``start``
    and ``end`` in the type of ``start``; ``closed`` includes the end. The names of
    facts and ranges must differ. Counting keys, rows and bytes takes jobs that run when this
    function is called."""
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    clash = {c.lower() for c in facts.columns} & {c.lower() for c in ranges.columns}
    if clash:
        raise ValueError(f"columns in both facts and ranges: {sorted(clash)}")
    kinds = {f.name: f.dataType for f in ranges.schema.fields}
    key = F.struct(*[F.col(f"`{f}`").cast(kinds[r]).alias(f"k{i}") for i, (f, r) in enumerate(on)])
    f = facts.select(key.alias("_key"), F.struct(F.col(f"`{at}`").cast(kinds[start]).alias("v"), F.lit(_AT).alias("s")).alias("_from"),
                     F.struct(*[F.col(f"`{c}`") for c in facts.columns]).alias("_fact"))
    hot = hot_keys(f, "_key", rows_per_split).persist()
    sizes = measured({"hot": hot, "facts": facts, "ranges": ranges})
    side = F.broadcast(hot) if small_enough(sizes["hot"]) else hot
    seg = segments(ranges, [r for _, r in on], start, end, closed, partitions(sizes["ranges"]))
    salt = F.when(F.col("_splits").isNull(), 0).otherwise(F.pmod(F.xxhash64("_fact"), F.col("_splits"))).cast("int")
    f = f.join(side, F.col("_key") == F.col("_hot"), "left").select("_key", "_from", salt.alias("_salt"), "_fact")
    seg = seg.join(side, F.col("_key") == F.col("_hot"), "left").select(
        "_key", "_from", F.explode(F.sequence(F.lit(0), F.coalesce("_splits", F.lit(1)) - 1)).alias("_salt"),
        F.struct("_to", "_held").alias("_seg"))
    both = f.unionByName(seg, allowMissingColumns=True).repartition(partitions(sizes["facts"], sizes["ranges"], sizes["ranges"]), "_key", "_salt")
    order = Window.partitionBy("_key", "_salt").orderBy(F.asc_nulls_first("_from")).rowsBetween(Window.unboundedPreceding, 0)
    carried = both.withColumn("_last", F.last("_seg", ignorenulls=True).over(order)).where("_fact IS NOT NULL")
    inside = F.when(F.col("_from.v").isNotNull() & (F.col("_from") < F.col("_last._to")), F.col("_last._held"))
    explode = F.explode if how == "inner" else F.explode_outer
    return carried.select("_fact", explode(inside).alias("_row")).select(
        *[F.col("_fact").getField(c).alias(c) for c in facts.columns], *[F.col("_row").getField(c).alias(c) for c in ranges.columns])
