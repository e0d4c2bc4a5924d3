"""Frame-level helpers: reuse of a shared intermediate (U1) and partition
sizes (U2)."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@contextmanager
def reused(df: DataFrame, how: str = "persist", level: StorageLevel = StorageLevel.MEMORY_AND_DISK):
    """Use ``df`` several times inside the block, computing it once.

    ``"persist"``: cached blocks; a lost executor's blocks are recomputed
    from lineage. ``"checkpoint"``: written as Parquet under the shared
    checkpoint folder (``spark.checkpoint.dir``), cutting the lineage.
    ``"none"``: recompute. Cache and files are released in the end, also on
    error."""
    if how == "none":
        yield df
        return
    if how == "checkpoint":
        from slotwise.session import remove_path, scratch_path
        path = scratch_path(df.sparkSession, "reused")
        try:
            df.write.parquet(path)
            yield df.sparkSession.read.parquet(path)
        finally:
            remove_path(df.sparkSession, path)
        return
    df.persist(level)
    try:
        yield df
    finally:
        df.unpersist()


def partition_rows(df: DataFrame) -> DataFrame:
    """Rows per partition (partition count = rows of the result; shows skew)."""
    return df.groupBy(F.spark_partition_id().alias("partition")).agg(F.count(F.lit(1)).alias("rows"))


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin repartition a scan that arrives in fewer splits than the
    cluster's default parallelism (a small or unsplittable file), ahead of
    row-multiplying work such as tokenising. Scans with at least that many
    splits, as at any real scale, are returned unchanged: no shuffle. For scans
    only: counting the splits of a frame with a shuffle would run it."""
    want = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= want:
        return df
    return df.repartition(want)
