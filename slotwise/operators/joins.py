"""Join helpers: broadcast a side only behind a check of its measured size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Upper bounds for broadcasting a dimension. Beyond them the join is left to the
# planner (shuffle join, re-planned by AQE from runtime sizes).
MAX_BROADCAST_ROWS = 2_000_000
MAX_BROADCAST_BYTES = 256 * 1024 * 1024

# In-memory bytes of a value of fixed size, by type.
_WIDTH = {T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.LongType: 8,
          T.FloatType: 4, T.DoubleType: 8, T.DateType: 4, T.TimestampType: 8,
          T.TimestampNTZType: 8, T.NullType: 1}


def row_bytes(df: DataFrame) -> Column:
    """Bytes of a row: fixed widths, and the length of what varies (nested
    values by their JSON text)."""
    size = F.lit(16)
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        t = f.dataType
        if isinstance(t, T.DecimalType):
            size = size + 16
        elif isinstance(t, (T.StringType, T.BinaryType)):
            size = size + 16 + F.coalesce(F.octet_length(c), F.lit(0))
        elif type(t) in _WIDTH:
            size = size + _WIDTH[type(t)]
        else:
            size = size + 16 + 2 * F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0))
    return size.cast("bigint")


def measured(frames: dict) -> dict[str, tuple[int, int]]:
    """(rows, bytes) of several frames in one job, with partial sums in the
    tasks. The caller decides when this job runs."""
    parts = [df.select(F.lit(i).alias("_t"), row_bytes(df).alias("_b")) for i, df in enumerate(frames.values())]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionAll(p)
    got = {r["_t"]: (r["n"], r["b"]) for r in u.groupBy("_t").agg(F.count(F.lit(1)).alias("n"), F.sum("_b").alias("b")).collect()}
    return {k: got.get(i, (0, 0)) for i, k in enumerate(frames)}


def small_enough(size: tuple[int, int], max_rows: int | None = None, max_bytes: int | None = None) -> bool:
    """Whether a measured frame may be broadcast."""
    rows, size_bytes = size
    return rows <= (MAX_BROADCAST_ROWS if max_rows is None else max_rows) and (
        size_bytes <= (MAX_BROADCAST_BYTES if max_bytes is None else max_bytes))


# Rows of one key that one join task should handle at most before the key is
# split into several tasks.
ROWS_PER_SPLIT = 2_000_000


def salted_join(big: DataFrame, small: DataFrame, big_key: str, small_key: str, condition=None,
                how: str = "inner", rows_per_split: int = ROWS_PER_SPLIT) -> DataFrame:
    """Equi join that splits hot keys of ``big`` over several tasks.

    1. Exact row counts per key of ``big`` (the key column alone, partially
       aggregated) give every key with more than ``rows_per_split`` rows a
       bucket count ``ceil(rows / rows_per_split)``. There are at most
       ``rows(big) / rows_per_split`` such keys. The list is computed once
       and saved with ``checkpoint()`` in the shared checkpoint folder (which
       the session's cleaner empties when the frame is no longer used). It is
       joined by key: as a broadcast if its measured size allows, else as the
       planner sees fit. The split holds for a list of any size.
    2. Rows of a hot key get a salt ``pmod(xxhash64(row), buckets)`` (a pure
       function of the row, so a retried task salts identically); other rows
       get salt 0. Rows of ``small`` for a hot key are repeated once per
       bucket, all other rows once.
    3. The join runs on (key, salt) plus ``condition``: every row of
       ``big`` still meets every matching row of ``small`` exactly once.

    ``condition`` is a function ``(big_df, small_df) -> Column`` for residual
    predicates. ``how`` is "inner" or "left" (``big`` on the left). Counting the
    keys is a job that runs when this function is called."""
    from slotwise.session import shared_dir
    shared_dir(big.sparkSession)
    hot = (big.groupBy(F.col(big_key).alias("_hk")).agg(F.count(F.lit(1)).alias("_hn"))
           .where(F.col("_hn") > rows_per_split)
           .select("_hk", F.ceil(F.col("_hn") / F.lit(rows_per_split)).cast("int").alias("_hb"))
           .checkpoint(eager=True))
    if small_enough(measured({"hot": hot})["hot"]):
        hot = F.broadcast(hot)
    b = big.join(hot, big[big_key] == hot["_hk"], "left")
    salt = F.when(F.col("_hb").isNull(), F.lit(0)).otherwise(
        F.pmod(F.xxhash64(*[F.col(c) for c in big.columns]), F.col("_hb")))
    b = b.withColumn("_salt", salt.cast("int")).drop("_hk", "_hb")
    s = small.join(hot, small[small_key] == hot["_hk"], "left")
    s = s.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_hb"), F.lit(1)) - 1))) \
         .drop("_hk", "_hb").withColumnRenamed("_salt", "_salt_s")
    cond = (b[big_key] == s[small_key]) & (b["_salt"] == s["_salt_s"])
    if condition is not None:
        cond = cond & condition(b, s)
    return b.join(s, cond, how).drop("_salt", "_salt_s")
