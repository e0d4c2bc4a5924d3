"""First row per key (W1, W2, F9) and the column-equality case."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(xs) -> list[Column]:
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def first_per_key(df: DataFrame, keys, order_by=None, ascending: bool = True,
                  method: str = "aggregate") -> DataFrame:
    """Keep one row per key.

    Without ``order_by`` any row of the key survives, as in the reference
    (whose window orders by the key itself). With ``order_by`` the first row
    by that order wins (NULL first when ascending, last when descending,
    like ``row_number``).

    ``method="aggregate"`` (default) is a ``min_by``/``max_by`` aggregation. Its
    buffers hold whole rows, so Spark sorts each task's rows by key, keeps one
    row per key and task before the shuffle, and sorts once more after it.
    ``method="window"`` is the reference's ``row_number() = 1``; Catalyst sorts
    each task's rows by key and order and puts a ``WindowGroupLimit`` before the
    shuffle. Either way a key that holds a third of the table sends one row per
    task."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    if not order_by:
        return df.dropDuplicates(keys)
    order = _cols([order_by] if isinstance(order_by, (str, Column)) else order_by)
    if method == "window":
        o = [c.asc_nulls_first() if ascending else c.desc_nulls_last() for c in order]
        w = Window.partitionBy(*keys).orderBy(*o)
        return (df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn"))
    rest = [c for c in df.columns if c not in keys]
    pick = F.min_by if ascending else F.max_by
    best = df.groupBy(*keys).agg(pick(F.struct(*rest), F.struct(*order)).alias("_row"))
    return best.select(*keys, "_row.*").select(*df.columns)


def match_or(a, b, otherwise: str = "no match") -> Column:
    """``b`` where ``a == b``, else the text ``otherwise``."""
    ca, cb = _cols([a, b])
    return F.when(ca == cb, cb).otherwise(F.lit(otherwise))
