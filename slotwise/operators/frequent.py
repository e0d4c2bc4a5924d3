"""Frequent values with a bound (A11, O3): mergeable summaries, exact counts.

The exact top-n counts every distinct value. Here each task (or day) keeps a
frequent-items summary of at most ``tracked`` values (``approx_top_k_accumulate``),
summaries merge (``approx_top_k_combine``), and a second narrow pass counts the
summary's values exactly. What the summary leaves out is bounded: a value outside it
has at most ``MISS * rows / tracked`` rows, so every reported value above that is
certainly in its place (``certain``); below, a value outside could have as many. If
the summary's values make up all rows by their exact counts, nothing is left out and
the result is certain throughout.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

TRACKED = 10_000
#: The summary's map has tracked / 0.75 places or more, and its error is 3.5 / places
#: of the rows. It gives the values whose certain part exceeds the error, so one that
#: it does not give has two errors at most.
MISS = 2 * 3.5 * 0.75


def value_states(df: DataFrame, col: str, by: str | None = None, tracked: int = TRACKED) -> DataFrame:
    """(state, rows, [by]): summaries of the non-NULL values' text, one per value of
    ``by`` (a day, say) or one in all. Small, storable and mergeable."""
    rows = df.select(F.col(f"`{col}`").cast("string").alias("_v"), *([F.col(f"`{by}`")] if by else [])).where("_v IS NOT NULL")
    return rows.groupBy(*([f"`{by}`"] if by else [])).agg(
        F.expr(f"approx_top_k_accumulate(_v, {int(tracked)})").alias("state"), F.count(F.lit(1)).alias("rows"))


def candidates(states: DataFrame, tracked: int = TRACKED) -> DataFrame:
    """(value, rows): the values that the merged summaries give, with the number of
    rows behind them. At most ``tracked`` rows."""
    one = states.agg(F.expr(f"approx_top_k_combine(state, {int(tracked)})").alias("state"), F.sum("rows").alias("rows"))
    items = one.where("rows > 0").select("rows", F.expr(f"approx_top_k_estimate(state, {int(tracked)})").alias("items"))
    return items.select("rows", F.explode("items.item").alias("value")).where("value IS NOT NULL")


def frequent_values(df: DataFrame, col: str, n: int = 10, tracked: int = TRACKED, states: DataFrame | None = None) -> DataFrame:
    """The ``n`` most frequent non-NULL values of ``col`` (as text) among the
    summary's, ties by value: value, cnt (exact), rank, certain. ``states`` are
    stored summaries of all rows of ``df``; without them they are made here."""
    found = candidates(value_states(df, col, tracked=tracked) if states is None else states, tracked)
    rows = df.select(F.col(f"`{col}`").cast("string").alias("_v"))
    counted = (rows.join(F.broadcast(found), F.col("_v") == F.col("value"))              # ``tracked`` rows at most
               .groupBy("value").agg(F.count(F.lit(1)).alias("cnt"), F.first("rows").alias("rows")))
    whole = F.sum("cnt").over(Window.partitionBy()) == F.col("rows")
    certain = whole | (F.col("cnt") > F.lit(MISS) * F.col("rows") / F.lit(tracked))
    place = F.row_number().over(Window.orderBy(F.desc("cnt"), "value"))
    return (counted.withColumn("certain", certain).orderBy(F.desc("cnt"), "value").limit(n)
            .select("value", "cnt", place.alias("rank"), "certain"))
