"""Publication of folders without a hole (K1), and what builds on it.

Replacing a folder by deleting and writing it leaves readers without data in
between, and a crash leaves them without it for good. Here a new version is written
beside the old one, and a pointer file, replaced in one atomic rename, names the
version that readers see:

    <path>/v=<id>/part-...      a version, complete before it is named
    <path>/_current             the id of the version in force

A writer that dies leaves an unnamed version, which the next publication removes.
A reader that has resolved the pointer keeps its version until the second
publication after that: a version goes when it has not been in force for one whole
publication.

The rename uses the file system's own overwrite, through Hadoop's ``FileContext``:
atomic on HDFS and local disks. Object stores have no rename; a table format serves
them better.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

POINTER = "_current"


def _fs(spark: SparkSession, path: str):
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, conf, p, p.getFileSystem(conf)


def current(spark: SparkSession, path: str) -> dict | None:
    """The pointer's content, or None before the first publication."""
    jvm, conf, p, fs = _fs(spark, f"{path.rstrip('/')}/{POINTER}")
    if not fs.exists(p):
        return None
    with_open = fs.open(p)
    try:
        return json.loads(bytes(with_open.readAllBytes()).decode())
    finally:
        with_open.close()


def point(spark: SparkSession, path: str, content: dict) -> None:
    """Replace the pointer in one rename."""
    base = path.rstrip("/")
    jvm, conf, p, fs = _fs(spark, f"{base}/{POINTER}")
    aside = jvm.org.apache.hadoop.fs.Path(f"{base}/{POINTER}-{uuid.uuid4().hex}")
    out = fs.create(aside, True)
    try:
        out.write(bytearray(json.dumps(content).encode()))
    finally:
        out.close()
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri(), conf).rename(fs.makeQualified(aside), fs.makeQualified(p), options)


def versions(spark: SparkSession, path: str) -> list[str]:
    """Ids of the versions under ``path``, named or not."""
    jvm, conf, p, fs = _fs(spark, path)
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]
    return sorted(n[2:] for n in names if n.startswith("v="))


def publish(spark: SparkSession, path: str, write: Callable[[str], None], **more) -> str:
    """Write a version with ``write(folder)``, then name it. ``more`` is kept in the
    pointer. An error in ``write`` leaves the old version in force."""
    base, before = path.rstrip("/"), current(spark, path)
    keep = {before["version"]} if before else set()
    for old in versions(spark, path):
        if old not in keep:                                                     # replaced long ago, or never named
            _remove(spark, f"{base}/v={old}")
    version = uuid.uuid4().hex
    write(f"{base}/v={version}")
    point(spark, path, {**more, "version": version, "before": before["version"] if before else None})
    return version


def _remove(spark: SparkSession, path: str) -> None:
    from slotwise.session import remove_path
    remove_path(spark, path)


def folder(spark: SparkSession, path: str) -> str | None:
    """The folder of the version in force."""
    now = current(spark, path)
    return f"{path.rstrip('/')}/v={now['version']}" if now else None


def publish_records(df: DataFrame, path: str, rec_type: str, dt: str, im: int | str, **kw) -> str:
    """K1 for one record type and run: as :func:`~slotwise.sinks.files.write_records`
    for a fixed partition, replaced without a hole."""
    from slotwise.sinks.files import write_folder
    where = f"{path.rstrip('/')}/rec_type={rec_type}/dt={dt}/im={im}"
    out = df.drop("rec_type", "dt", "im")
    return publish(df.sparkSession, where, lambda f: write_folder(out, f, **kw))


def read_published_records(spark: SparkSession, path: str, schema: StructType, rec_type: str, dt: str, im: int | str) -> DataFrame:
    """The records in force of one type and run; none before its publication."""
    from pyspark.sql import functions as F
    where = folder(spark, f"{path.rstrip('/')}/rec_type={rec_type}/dt={dt}/im={im}")
    rows = spark.read.schema(schema).json(where) if where else spark.createDataFrame([], schema)
    return rows.withColumns({"rec_type": F.lit(rec_type), "dt": F.lit(dt), "im": F.lit(str(im))})
