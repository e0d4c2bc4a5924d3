"""Per-batch word counts of a message stream.

The reference counts words of each 1-second micro-batch separately
(``reduceByKey`` per batch RDD, no carry-over) and then sums the batch's
counts through a temp view and SQL. A streaming ``groupBy`` would keep a
running count across batches instead, so the per-batch semantics are built
with ``foreachBatch``: each batch is an ordinary DataFrame, counted with a
partial + final aggregation on the executors; only the sink call runs on
the driver.

``foreachBatch`` is at-least-once; every batch writes to folders keyed by
its ``batch_id`` in overwrite mode, so a replayed batch replaces its own
output instead of adding to it. Offsets and commits live in the query
checkpoint on shared storage, so a restart neither skips nor recounts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from slotwise.operators.tokens import word_counts

# Micro-batch clock of the reference's stream.
BATCH_INTERVAL = "1 second"


def batch_words(batch: DataFrame, col: str = "value", sep: str = " ") -> DataFrame:
    """Word counts of one batch."""
    return word_counts(batch, col, sep)


def process_batch(batch: DataFrame, batch_id: int, out: str, col: str = "value", sep: str = " ",
                  show: bool = False) -> None:
    """T3 for one batch: counts -> temp view ``words`` -> ``SELECT SUM(cnt)``;
    both results written under ``<out>/counts|totals/batch_id=<id>``."""
    spark = batch.sparkSession
    counts = batch_words(batch, col, sep).persist()
    try:
        counts.write.mode("overwrite").parquet(f"{out}/counts/batch_id={batch_id}")
        counts.createOrReplaceTempView("words")
        total = spark.sql("SELECT SUM(cnt) AS total FROM words")
        total.write.mode("overwrite").parquet(f"{out}/totals/batch_id={batch_id}")
        if show:
            print(f"========= batch {batch_id} =========")
            counts.show()
            total.show()
    finally:
        counts.unpersist()


def start_word_counts(stream: DataFrame, out: str, checkpoint: str, col: str = "value", sep: str = " ",
                      trigger: str | None = BATCH_INTERVAL, available_now: bool = False,
                      show: bool = False, name: str | None = None) -> StreamingQuery:
    """T1 + T4: start the per-batch word count; every ``trigger`` interval (or
    once over all available input with ``available_now``) a batch is counted.
    Returns the running query (``awaitTermination`` / ``stop`` on it)."""
    w = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        lambda df, bid: process_batch(df, bid, out, col, sep, show))
    if name:
        w = w.queryName(name)
    if available_now:
        w = w.trigger(availableNow=True)
    elif trigger:
        w = w.trigger(processingTime=trigger)
    return w.start()
