"""Batch sources: catalog tables, parquet folders, parameterised SQL scans,
table listing and text lines (S1, S2, S3, S5, S6)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Driver tables shipped with the test data (one parquet file each).
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def read_table(spark: SparkSession, name: str, base: str | None = None) -> DataFrame:
    """A table by catalog name, or ``<base>/<name>.parquet`` when ``base``
    is given. Either way the scan stays lazy, so Catalyst prunes columns and
    pushes filters into the parquet reader. Files are listed on every call, so
    a table that has grown is read whole."""
    return spark.table(name) if base is None else spark.read.parquet(f"{base.rstrip('/')}/{name}.parquet")


def register_tables(spark: SparkSession, base: str, names=TABLES) -> list[str]:
    """Register ``<base>/<name>.parquet`` as temp views (the Hive tables of the
    reference become views; no metastore is needed)."""
    for n in names:
        read_table(spark, n, base).createOrReplaceTempView(n)
    return list(names)


def scan_sql(spark: SparkSession, table: str, select: str, where: str | None = None,
             args: dict | None = None) -> DataFrame:
    """Scan through SQL text with the table name and the bounds passed as
    parameters (``IDENTIFIER(:tbl)``, ``:lo``) instead of being spliced into
    the text. ``select`` and ``where`` are SQL fragments written by the
    caller; values go through ``args``."""
    text = f"SELECT {select} FROM IDENTIFIER(:tbl)"
    if where:
        text += f" WHERE {where}"
    return spark.sql(text, args={"tbl": table, **(args or {})})


def list_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    """S3: ``SHOW TABLES [IN db]`` as a DataFrame (namespace, tableName, isTemporary)."""
    if database:
        return spark.sql("SHOW TABLES IN IDENTIFIER(:db)", args={"db": database})
    return spark.sql("SHOW TABLES")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text-file lines as a ``value`` column."""
    return spark.read.text(path)


def columns_of(df: DataFrame) -> list[str]:
    """Column list of a table (schema metadata, no job)."""
    return list(df.columns)
