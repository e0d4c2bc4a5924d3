"""Frame helpers: checkpoints, batch size, and connected components of a link
table as DataFrame joins."""

from __future__ import annotations

import gc
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotwise.session import shared_dir

BATCH_ROWS = 2000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from there."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def release(spark: SparkSession) -> None:
    """Between two passes: shuffle and checkpoint files of frames that are no
    longer used go when the driver collects its garbage, which a driver with little
    to do puts off until disks are full. Python's references end in the background,
    so a second round finds what the first has let go."""
    for _ in range(2):
        gc.collect()
        spark._jvm.System.gc()
        time.sleep(0.5)


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, with Arrow batches of ``BATCH_ROWS`` rows in its session unless
    that sets a size itself: texts are long, and Spark's default of 10,000 rows
    is tens of megabytes a batch on either side."""
    conf = df.sparkSession.conf
    if conf.get(_BATCH, None) is None:
        conf.set(_BATCH, str(BATCH_ROWS))
    return df


def most_frequent(counts: DataFrame, size: int, col: str = "n") -> DataFrame:
    """The rows with the largest counts, ``size`` at most. Counts are put in
    buckets (sixteen to a doubling, so small counts have their own) and the
    largest buckets that fit are kept whole: one small aggregation and a filter,
    nothing is sorted or merged in one task. ``counts`` is read twice."""
    bucket = F.floor(F.log2(col) * 16)
    left, least = size, None
    for r in counts.groupBy(bucket.alias("bucket")).count().orderBy(F.desc("bucket")).collect():    # about a thousand rows
        if r["count"] > left:
            break
        left, least = left - r["count"], r["bucket"]
    return counts.where(bucket >= least) if least is not None else counts.limit(0)


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node that links reach, for every node
    with a link. Labels take the smallest label among the neighbours, then jump
    to their label's label; both steps are joins and minimum aggregations, so a
    node with many links is pre-aggregated in the tasks. Rounds grow with the
    logarithm of the longest chain in practice."""
    pairs = links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    edges = cut(pairs.union(pairs.select("v", "u")).toDF("u", "v").distinct())
    label = cut(edges.groupBy(F.col("u").alias("node")).agg(F.least("node", F.min("v")).alias("component")))
    while True:
        near = (edges.join(label, edges.v == label.node).groupBy("u").agg(F.min("component").alias("near")))
        step = (label.join(near, label.node == near.u)
                .select("node", F.col("component").alias("old"), F.least("component", "near").alias("new")))
        top = label.select(F.col("node").alias("root"), F.col("component").alias("above"))
        step = cut(step.join(top, step.new == top.root)
                   .select("node", "old", F.least("new", "above").alias("component")))
        label = step.select("node", "component")
        if step.where("old <> component").isEmpty():
            return label
