"""Token operators: word counts (P22, P23, A19, A20) and numeric token sort."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.functions.text import tokens


def word_counts(df: DataFrame, col: str = "value", sep: str = " ") -> DataFrame:
    """Occurrences of each token of ``col`` split on one separator
    (empty tokens included). ``count(*)`` per word with map-side partial
    aggregation, so frequent words are combined before the shuffle. A scan in
    few splits can be passed through :func:`~slotwise.operators.frames.spread`
    first, since every text turns into many rows."""
    words = df.select(F.explode(tokens(col, sep)).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))


def total_count(counts: DataFrame) -> DataFrame:
    """``SUM(cnt)`` over word counts (NULL for no rows)."""
    return counts.agg(F.sum("cnt").alias("total"))


def token_sort(df: DataFrame, col: str = "value", sep: str = " ") -> DataFrame:
    """Integer tokens of each line, each with count 1, sorted by value
    (a distributed range-partitioned sort). A token that is not an integer, or
    beyond 64 bits, fails the cast, as the reference's ``int()`` does for the
    former.

    The sort key carries a per-row tiebreaker (row id, stable for a given
    input split), so the range partitioner can cut a value that holds a large
    share of all rows across several partitions instead of sending all its
    rows to one task."""
    t = df.select(F.explode(tokens(col, sep)).alias("t"))
    nums = t.select(F.col("t").cast("bigint").alias("num"), F.lit(1).alias("unit_count"),
                    F.monotonically_increasing_id().alias("_tb"))
    return nums.orderBy("num", "_tb").drop("_tb")
