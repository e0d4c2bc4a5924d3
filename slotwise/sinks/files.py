"""File and session sinks (K1-K5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

PARTITION_COLUMNS = ("rec_type", "dt", "im")


def write_records(df: DataFrame, path: str, rec_type: str | None = None, dt: str | None = None,
                  im: int | str | None = None, max_files: int | None = None,
                  max_records_per_file: int | None = None, sort_by=None, keep_fields: bool = False) -> None:
    """K1/K2: write a record frame as JSON under Hive-style directories
    ``rec_type=<t>/dt=<d>/im=<n>/``. Runs for other days or record types are
    kept. With ``rec_type``, ``dt`` and ``im`` given, that one partition is
    replaced, also by nothing when there are no rows; else the partitions that
    get rows are (dynamic partition overwrite).

    The partition columns are stored once, in the path, unless ``keep_fields``
    also leaves ``rec_type`` and ``im`` in the records (quirk X9).
    ``dt`` defaults to each row's reading date; pass the run's start date
    for the reference's layout (quirk X10). ``max_files`` coalesces to that
    many files per output like the reference (it also caps the final
    stage's parallelism, so leave it unset for large runs);
    ``max_records_per_file`` bounds file size instead. ``sort_by`` orders rows
    inside each file (O2)."""
    out = df
    whole = None not in (rec_type, dt, im)
    if whole:
        out = out.drop("dt")
        if keep_fields:
            out = out.withColumns({"rec_type": F.lit(rec_type), "im": F.lit(str(im))})
        else:
            out = out.drop("rec_type", "im")
        w = _writer(out, max_files, max_records_per_file, sort_by).mode("overwrite")
        w.json(f"{path.rstrip('/')}/rec_type={rec_type}/dt={dt}/im={im}")
        return
    if keep_fields:
        raise ValueError("keep_fields needs rec_type, dt and im")
    if rec_type is not None:
        out = out.withColumn("rec_type", F.lit(rec_type))
    if dt is not None:
        out = out.withColumn("dt", F.lit(str(dt)))
    elif "dt" not in out.columns:
        out = out.withColumn("dt", F.date_format(F.to_date(F.col("rd"), "yyyyMMdd"), "yyyy-MM-dd"))
    if im is not None:
        out = out.withColumn("im", F.lit(str(im)))
    w = _writer(out, max_files, max_records_per_file, sort_by).mode("overwrite")
    w.option("partitionOverwriteMode", "dynamic").partitionBy(*PARTITION_COLUMNS).json(path)


def write_folder(df: DataFrame, folder: str, max_files: int | None = None, max_records_per_file: int | None = None,
                 sort_by=None, order_by=None) -> None:
    """Write ``df`` as JSON into a new folder; ``order_by`` as in :func:`write_ordered`."""
    if order_by:
        df = ordered(df, order_by, max_files)
        max_files = None
    _writer(df, max_files, max_records_per_file, sort_by).json(folder)


def ordered(df: DataFrame, order_by, files: int | None = None) -> DataFrame:
    """O2: ``df`` range-partitioned and sorted by ``order_by`` (names, ascending,
    NULL first), so that partitions in their order hold the rows in theirs. A hash
    of the row is the last key: it makes the order total up to equal rows, and lets
    the partitioner cut a value that holds many rows."""
    keys = [F.col(f"`{c}`").asc_nulls_first() for c in order_by]
    tie = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    return (df.repartitionByRange(*([int(files)] if files else []), *keys, tie)
            .sortWithinPartitions(*keys, tie))


def write_ordered(df: DataFrame, folder: str, order_by, files: int | None = None) -> None:
    """O2: JSON files whose names, in their order, give the rows in the order of
    ``order_by``, as the reference's globally sorted outputs do. ``files`` is their
    number (the shuffle's partitions if not given)."""
    ordered(df, order_by, files).write.mode("overwrite").json(folder)


def read_in_order(spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
    """The rows of a folder with ``position``, their place (from 1) when its files
    are read one after the other by name. One window per file; the files' row
    counts are summed in one row per file."""
    rows = (spark.read.schema(schema).option("multiLine", "false").json(folder)
            .select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
                    F.monotonically_increasing_id().alias("_row")))
    # a file's blocks come in their own partitions; inside one, rows keep their order
    rows = rows.withColumn("_in_file", F.row_number().over(Window.partitionBy("_file").orderBy("_block", "_row")))
    size = rows.groupBy(F.col("_file").alias("_name")).agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_name").rowsBetween(Window.unboundedPreceding, -1))
    size = size.select("_name", F.coalesce(before, F.lit(0)).alias("_before"))
    return (rows.join(F.broadcast(size), F.col("_file") == F.col("_name"))      # a row per file
            .withColumn("position", F.col("_before") + F.col("_in_file")).select(*schema.names, "position"))


def _writer(df: DataFrame, max_files, max_records_per_file, sort_by):
    if max_files:
        df = df.coalesce(int(max_files))
    if sort_by:
        df = df.sortWithinPartitions(*sort_by)
    return df.write.option("maxRecordsPerFile", str(int(max_records_per_file))) if max_records_per_file else df.write


def read_records(spark: SparkSession, path: str, schema: StructType, rec_type: str | None = None) -> DataFrame:
    """Read record JSON back with an explicit schema (partition columns take
    the types given there, e.g. ``dt`` as text). Filtering on ``rec_type``
    prunes directories."""
    df = spark.read.schema(schema).json(path)
    return df.where(F.col("rec_type") == rec_type) if rec_type else df


def write_report(df: DataFrame, path: str, sep: str = "|", single_file: bool = True) -> None:
    """K3: delimited text report without header, one line per row. The
    report is small (one line per profiled column), so one file is the
    default."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("sep", sep).option("header", "false").csv(path)


def read_report(spark: SparkSession, path: str, schema: StructType, sep: str = "|") -> DataFrame:
    return spark.read.schema(schema).option("sep", sep).option("header", "false").csv(path)


def console(df: DataFrame, n: int = 20, truncate: bool | int = True) -> None:
    """K4: print the first ``n`` rows (the driver receives only those rows)."""
    df.show(n, truncate)


def as_view(df: DataFrame, name: str) -> DataFrame:
    """K5: register ``df`` as a session temp view and return the view."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)
