"""The stream job (section 3.3 of the survey): messages -> per-batch word
counts and totals, written per batch id."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from slotwise.session import scratch_path
from slotwise.sources.streams import file_stream, kafka_stream
from slotwise.streaming.words import start_word_counts


def run_files(spark: SparkSession, path: str, fmt: str = "text", schema=None, value_col: str | None = None,
              glob: str | None = None, max_files_per_trigger: int | None = None,
              out: str | None = None, timeout: float | None = None) -> tuple[str, DataFrame, DataFrame]:
    """Count words of every file present in ``path`` (one batch per
    ``max_files_per_trigger`` files) and stop. Returns the output folder and
    the per-batch counts and totals read back from it. A later call with the
    same ``out`` counts the files that are new since.

    With ``timeout`` (seconds), a run that is not done by then is stopped and
    raises ``TimeoutError``; its finished batches stay in ``out``."""
    out = out or scratch_path(spark, "word-counts")
    stream = file_stream(spark, path, fmt, schema, value_col, glob, max_files_per_trigger)
    q = start_word_counts(stream, out, checkpoint=out + "/_checkpoint", available_now=True)
    if timeout is None:
        q.awaitTermination()
    elif not q.awaitTermination(timeout):
        q.stop()
        raise TimeoutError(f"the stream was not done after {timeout} s; finished batches are in {out}")
    if q.exception():
        raise q.exception()
    return out, spark.read.parquet(out + "/counts"), spark.read.parquet(out + "/totals")


def run_kafka(spark: SparkSession, brokers: str, topic: str, out: str, checkpoint: str, **kw):
    """Per-batch counts of a Kafka topic every second until stopped."""
    return start_word_counts(kafka_stream(spark, brokers, topic), out, checkpoint, **kw)
