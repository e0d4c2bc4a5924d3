"""Mergeable column profile (A14, A18): per-day states instead of rescans.

A state holds, per part (a day, say) and column, what merges without the rows:

* rows, blanks, NULLs, longest and shortest printed length;
* a HyperLogLog sketch of the values' text (``hll_sketch_agg``), merged by
  ``hll_union_agg``; the relative standard error is about 1.04 / sqrt(2**lg_k);
* for integer columns the exact set of values as bitmaps of 32,768 neighbours
  (``bitmap_construct_agg``), merged by ``bitmap_or_agg``. Bitmaps pay where values
  lie densely, as keys and codes do. A column is stored this way if it is named in
  ``exact``; by default those integer columns of a part are whose range holds at
  most ``sparse`` numbers per distinct value (estimated by the sketch).

A new part adds its own state in one or two scans of its own rows; merging reads
states only. A part is replaced by writing its state again, so a rerun does not
count twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slotwise.functions.text import any_length, is_blank

LG_K = 12
SPARSE = 64
_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def measure_state(df: DataFrame, columns=None, null_length: int | None = 4, lg_k: int = LG_K, by: str | None = None) -> DataFrame:
    """One row per column: position, name, counts, lengths, sketch, and the least
    and the largest value of integer columns; with ``by``, per value of that
    column (as ``part``). One scan."""
    cols = list(columns or [c for c in df.columns if c != by])
    aggs = [F.count(F.lit(1)).alias("rows")]
    for i, c in enumerate(cols):
        raw = F.col(f"`{c}`")
        v, whole = raw.cast("string"), isinstance(df.schema[c].dataType, _INTEGERS)
        length = any_length(v, null_length)
        aggs.append(F.struct(
            F.sum(F.coalesce(is_blank(v), F.lit(False)).cast("bigint")).alias("blanks"), F.sum(v.isNull().cast("bigint")).alias("nulls"),
            F.max(length).cast("int").alias("max_length"), F.min(length).cast("int").alias("min_length"),
            F.hll_sketch_agg(v, lg_k).alias("sketch"),
            (F.min(raw) if whole else F.max(F.lit(None))).cast("bigint").alias("least"),
            (F.max(raw) if whole else F.max(F.lit(None))).cast("bigint").alias("largest")).alias(f"_{i}"))
    fields = F.array(*[F.struct(F.lit(i).alias("ci"), F.lit(c).alias("column_name"), F.col("rows").alias("row_count"),
                                F.col(f"_{i}").alias("m")) for i, c in enumerate(cols)])
    part = [] if by is None else ["part"]
    one = df.agg(*aggs) if by is None else df.groupBy(F.col(f"`{by}`").cast("string").alias("part")).agg(*aggs)
    return one.select(*part, F.inline(fields)).select(*part, "ci", "column_name", "row_count", "m.*")


def dense_columns(measures: DataFrame, sparse: int = SPARSE) -> list[str]:
    """Integer columns whose values lie densely enough for bitmaps in every
    state."""
    spread = F.col("largest").cast("double") - F.col("least").cast("double") + 1
    dense = spread <= F.lit(sparse) * F.greatest(F.hll_sketch_estimate("sketch"), F.lit(512))
    rows = measures.where("least IS NOT NULL").groupBy("column_name").agg(F.every(dense).alias("dense")).where("dense").collect()
    return sorted(r["column_name"] for r in rows)                               # a row per column


def value_bitmaps(df: DataFrame, columns, by: str | None = None) -> DataFrame:
    """(column_name, bucket, bitmap): the values of integer columns, exactly."""
    part = [] if by is None else [F.col(f"`{by}`").cast("string").alias("part")]
    keys = [] if by is None else ["part"]
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("bigint").alias("v")) for c in columns])
    rows = df.select(*part, F.inline(cells)).where("v IS NOT NULL")
    return (rows.groupBy(*keys, "column_name", F.bitmap_bucket_number("v").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("v")).alias("bitmap")))


def write_state(df: DataFrame, path: str, part: str, columns=None, exact=None, **kw) -> None:
    """Write (or replace) the state of one part's rows under ``path``."""
    write_states(df.withColumn("_part", F.lit(part)), path, "_part", columns or df.columns, exact, **kw)


def write_states(df: DataFrame, path: str, by: str, columns=None, exact=None, null_length: int | None = 4,
                 lg_k: int = LG_K, sparse: int = SPARSE) -> None:
    """Write (or replace) the states of all parts in ``df``, told apart by its
    column ``by``; states of other parts under ``path`` stay as they are. A part
    without rows has no state."""
    spark, base = df.sparkSession, path.rstrip("/")
    cols = list(columns or [c for c in df.columns if c != by])

    def put(rows, kind):
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(f"{base}/{kind}")

    measures = measure_state(df, cols, null_length, lg_k, by).persist()
    try:
        dense = dense_columns(measures, sparse) if exact is None else [c for c in cols if c in exact]
        if dense:
            put(value_bitmaps(df, dense, by), "bitmaps")
        # written last: what names the exact columns of a part stands for its bitmaps
        put(measures.withColumn("exact", F.col("column_name").isin(dense)), "measures")
    finally:
        measures.unpersist()


def merged_profile(spark: SparkSession, path: str, parts=None, db: str = "", table: str = "") -> DataFrame:
    """The profile over the states under ``path`` (all, or the named parts), with
    the columns of :func:`column_profile`, then ``exact``: whether the distinct
    count is exact. It is if every part stored the column's bitmaps; else it is an
    estimate with the error of :func:`error_of`, and uniqueness is NULL."""
    base = path.rstrip("/")

    def read(kind, schema):
        df = spark.read.schema(schema + ", part string").parquet(f"{base}/{kind}")
        return df if parts is None else df.where(F.col("part").isin([str(p) for p in parts]))

    measures = read("measures", "ci int, column_name string, row_count bigint, blanks bigint, nulls bigint, max_length int, "
                                "min_length int, sketch binary, exact boolean")
    one = measures.groupBy("column_name").agg(
        F.min("ci").alias("ci"), F.sum("row_count").alias("row_count"), F.sum("blanks").alias("blanks"), F.sum("nulls").alias("nulls"),
        F.max("max_length").alias("max_length"), F.min("min_length").alias("min_length"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate"), F.every("exact").alias("exact"))
    if one.where("exact").isEmpty():
        values = spark.createDataFrame([], "of string, values bigint")
    else:
        sets = read("bitmaps", "column_name string, bucket bigint, bitmap binary")
        values = (sets.groupBy(F.col("column_name").alias("of"), "bucket").agg(F.bitmap_count(F.bitmap_or_agg("bitmap")).alias("n"))
                  .groupBy("of").agg(F.sum("n").alias("values")))
    both = one.join(F.broadcast(values), F.col("column_name") == F.col("of"), "left")          # a row per column
    some = F.when(F.col("exact"), F.coalesce("values", F.lit(0))).otherwise(F.col("estimate"))
    distinct = (F.coalesce(some, F.lit(0)) + (F.col("nulls") > 0).cast("bigint")).cast("bigint")
    return both.orderBy("ci").select(
        F.lit(db).alias("db"), F.lit(table).alias("table_name"), "column_name",
        F.when(F.col("exact"), F.col("row_count") == distinct).alias("is_distinct"),
        (F.col("blanks") > 0).alias("has_blanks"), (F.col("nulls") > 0).alias("has_nulls"),
        "max_length", "min_length", "row_count", distinct.alias("distinct_count"), "exact")


def error_of(lg_k: int = LG_K) -> float:
    """Relative standard error of an estimated distinct count."""
    return 1.04 / (1 << lg_k) ** 0.5
