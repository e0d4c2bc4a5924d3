"""Bucketed layout of the account join (J1, J3): no shuffle of the fact per run.

The normalised readings and the account frame are written once as tables bucketed
by (account, salt). Both sides of the enrichment's account join then come out of
their scans in the join's partitioning, so a run over the layout plans neither an
exchange nor (within the buckets) a sort of the fact, however often it is read.

A bucketed join cannot be split by AQE, so a hot account is split here: an account
with more than ``rows_per_split`` readings gets salts 0 .. ceil(rows /
rows_per_split) - 1, dealt by a hash of the row, and its account rows are repeated
per salt. All other rows have salt 0. The counts come from the account column
alone, with partial aggregation.

The files are written under the shared folder; a table is replaced as a whole.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotwise.operators.enrich import account_frame
from slotwise.operators.joins import ROWS_PER_SPLIT, measured, small_enough

BUCKETS = 256


@dataclass(frozen=True)
class AccountLayout:
    """Names of the two bucketed tables."""
    readings: str
    accounts: str

    def joined(self, spark: SparkSession) -> DataFrame:
        """J1 + J3 over the layout: readings with the account frame's columns."""
        r, a = spark.table(self.readings), spark.table(self.accounts)
        cond = ((r["_account"] == a["_acct"]) & (r["_salt"] == a["_salt_of"])
                & (r["_day"] >= a["assign_start"]) & (r["_day"] < a["assign_end"]))
        # the merge join keeps the scans' partitioning; a broadcast would be as good, but is the planner's to choose
        return r.join(a.hint("merge"), cond).drop("_salt", "_salt_of")


def hot_keys(df: DataFrame, key: str, rows_per_split: int) -> DataFrame:
    """(key, splits) of the keys with more than ``rows_per_split`` rows."""
    n = F.count(F.lit(1))
    return (df.groupBy(F.col(key).alias("_hot")).agg(n.alias("_n")).where(F.col("_n") > rows_per_split)
            .select("_hot", F.ceil(F.col("_n") / F.lit(rows_per_split)).cast("int").alias("_splits")))


def write_account_layout(readings: DataFrame, accounts: DataFrame, plans: DataFrame, assignments: DataFrame,
                         name: str, path: str, buckets: int = BUCKETS, rows_per_split: int = ROWS_PER_SPLIT) -> AccountLayout:
    """Write both sides. ``readings``: normalised, with the columns of
    ``JOIN_KEYS``; the others as :func:`enrich` takes them. ``path`` is a folder
    of shared storage; the tables are ``<name>_readings`` and ``<name>_accounts``."""
    spark = readings.sparkSession
    layout = AccountLayout(f"{name}_readings", f"{name}_accounts")
    hot = hot_keys(readings, "_account", rows_per_split).persist()
    try:
        side = F.broadcast(hot) if small_enough(measured({"hot": hot})["hot"]) else hot
        salt = F.when(F.col("_splits").isNull(), 0).otherwise(F.pmod(F.xxhash64(*readings.columns), F.col("_splits")))
        r = readings.join(side, F.col("_account") == F.col("_hot"), "left").withColumn("_salt", salt.cast("int")).drop("_hot", "_splits")
        _write(r, layout.readings, f"{path.rstrip('/')}/readings", buckets, ("_account", "_salt"), ("_account", "_salt", "_day"))
        a = account_frame(accounts, plans, assignments).join(side, F.col("_acct") == F.col("_hot"), "left")
        a = a.withColumn("_salt_of", F.explode(F.sequence(F.lit(0), F.coalesce("_splits", F.lit(1)) - 1))).drop("_hot", "_splits")
        _write(a, layout.accounts, f"{path.rstrip('/')}/accounts", buckets, ("_acct", "_salt_of"), ("_acct", "_salt_of"))
    finally:
        hot.unpersist()
    spark.catalog.refreshTable(layout.readings)
    spark.catalog.refreshTable(layout.accounts)
    return layout


def _write(df: DataFrame, table: str, path: str, buckets: int, keys, order) -> None:
    """One file per bucket and task; brought together by the keys first, so that
    there is one file per bucket in all and its order needs no sort when read."""
    df.sparkSession.sql(f"DROP TABLE IF EXISTS {table}")
    (df.repartition(buckets, *keys).write.mode("overwrite").format("parquet").option("path", path)
     .bucketBy(buckets, *keys).sortBy(*order).saveAsTable(table))
