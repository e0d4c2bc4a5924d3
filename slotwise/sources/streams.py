"""Stream sources giving one text ``value`` column per message.

The reference reads a Kafka topic through a ZooKeeper receiver and keeps the
message value. Structured Streaming's Kafka source replaces it (brokers
instead of ZooKeeper, offsets in the query checkpoint). A file stream gives
the same frame shape for offline runs and tests.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def kafka_options(brokers: str, topic: str, starting_offsets: str = "latest",
                  max_offsets_per_trigger: int | None = None, **extra) -> dict:
    """Option map of the Kafka source for one topic. The reference's
    ``{topic: 1}`` (one receiver thread) has no counterpart: Spark reads every
    topic partition in parallel; ``max_offsets_per_trigger`` bounds a batch."""
    opts = {"kafka.bootstrap.servers": brokers, "subscribe": topic,
            "startingOffsets": starting_offsets}
    if max_offsets_per_trigger is not None:
        opts["maxOffsetsPerTrigger"] = str(int(max_offsets_per_trigger))
    opts.update({k: str(v) for k, v in extra.items()})
    return opts


def kafka_stream(spark: SparkSession, brokers: str, topic: str, **kw) -> DataFrame:
    """Message values of a Kafka topic as text (needs the Kafka connector on
    the class path)."""
    reader = spark.readStream.format("kafka").options(**kafka_options(brokers, topic, **kw))
    return reader.load().select(F.col("value").cast("string").alias("value"))


def file_stream(spark: SparkSession, path: str, fmt: str = "text", schema: StructType | None = None,
                value_col: str | None = None, glob: str | None = None,
                max_files_per_trigger: int | None = None) -> DataFrame:
    """Files arriving in ``path`` as a stream of text values. For ``parquet`` /
    ``json`` sources give the schema and the column holding the text. Where ``path``
    is one file, the stream is of that file alone (Spark streams folders, so its
    folder is listed for its name)."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(where) and fs.getFileStatus(where).isFile():
        path, glob = where.getParent().toString(), re.sub(r"([\\*?\[\]{}])", r"\\\1", where.getName())
    reader = spark.readStream.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(int(max_files_per_trigger)))
    df = reader.load(path)
    col = value_col or ("value" if fmt == "text" else df.columns[0])
    return df.select(F.col(col).cast("string").alias("value"))
