"""Column profiling.

The reference runs six actions per column over Python RDDs. Here one scan
aggregates rows, blanks, NULLs and lengths of all columns in the tasks, with
nothing but one row per task to merge. Distinct values are counted exactly by one
narrow scan per value type: cells become (column index, value in its own type) and
are grouped with partial aggregation, so a hot value costs one row per map task, a
number its eight bytes and a long text its digest. ``approx=True`` replaces these
scans with HyperLogLog++ sketches inside the first.

Values that print alike are one value (-0.0 as 0.0 in the exact mode).
:mod:`slotwise.operators.profile_state` keeps a profile per day and merges days.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slotwise.functions.text import any_length, is_blank

PROFILE_FIELDS = ("db", "table_name", "column_name", "is_distinct", "has_blanks", "has_nulls",
                  "max_length", "min_length", "row_count", "distinct_count")


_UNGROUPABLE = tuple(x for x in (T.MapType, getattr(T, "VariantType", None)) if x is not None)


def _groupable(t: T.DataType) -> bool:
    """Whether Spark can group by values of this type."""
    if isinstance(t, _UNGROUPABLE):
        return False
    if isinstance(t, T.ArrayType):
        return _groupable(t.elementType)
    if isinstance(t, T.StructType):
        return all(_groupable(f.dataType) for f in t.fields)
    return True


def _typed_groups(df: DataFrame, cols) -> dict:
    """Column indexes grouped by the type their values are compared in
    (native type; text for types Spark cannot group by)."""
    groups: dict = {}
    for i, c in enumerate(cols):
        t = df.schema[c].dataType
        key = t.simpleString() if _groupable(t) else "string"
        groups.setdefault(key, []).append((i, c))
    return groups


def _value_counts(df: DataFrame, cols) -> DataFrame:
    """(column index, value text, rows) for every distinct value of every
    column. One scan, narrow unpivot and aggregation per value type, each
    grouping native values (map-side partial aggregation first); only the
    distinct values are turned into text. The values themselves are the grouping
    keys, since ties between counts are ordered by value."""
    parts = []
    for key, members in _typed_groups(df, cols).items():
        cells = F.array(*[F.struct(F.lit(i).alias("ci"),
                                   (F.col(c) if key != "string" else F.col(c).cast("string")).alias("v"))
                          for i, c in members])
        counted = df.select(F.inline(cells)).groupBy("ci", "v").agg(F.count(F.lit(1)).alias("n"))
        parts.append(counted.select("ci", F.col("v").cast("string").alias("v"), "n"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


#: Text from this length on is grouped by its SHA-256, whose 64 hexadecimal
#: digits are no shorter text.
DIGEST_FROM = 64


def _distinct_counts(df: DataFrame, cols) -> DataFrame:
    """(ci, distinct_count): exact, NULL as one value. One narrow scan per value
    type, each grouping values in their own type (Spark's grouping takes -0.0 as
    0.0 and NaN as one value) with partial aggregation; of text, long values are
    grouped by digest. Types that print alike, such as nested ones, are grouped
    by the digest of their text."""
    parts = []
    for key, members in _typed_groups(df, cols).items():
        nested = isinstance(df.schema[members[0][1]].dataType, (T.BinaryType, T.ArrayType, T.StructType, T.MapType))

        def identity(c):
            col = F.col(f"`{c}`")
            if key != "string" and not nested:
                return col
            text = col.cast("string")
            return F.when(F.char_length(text) < DIGEST_FROM, text).otherwise(F.sha2(text, 256))

        cells = F.array(*[F.struct(F.lit(i).alias("ci"), identity(c).alias("v")) for i, c in members])
        parts.append(df.select(F.inline(cells)).groupBy("ci", "v").agg(F.lit(1).alias("one"))
                     .groupBy("ci").agg(F.count(F.lit(1)).alias("distinct_count")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def column_profile(df: DataFrame, db: str = "", table: str = "", columns=None,
                   null_length: int | None = 4, approx: bool = False) -> DataFrame:
    """One row per column with row count, distinct count (NULL counts as
    one value), uniqueness, blank and NULL presence, and the longest and
    shortest printed length (NULL prints as 'None', length 4, unless
    ``null_length`` says otherwise). Values are compared by their text form.

    ``approx=True`` estimates the distinct count; uniqueness is NULL then, as an
    estimate cannot decide it. An empty table still yields one row per column,
    with NULL lengths (quirk X16)."""
    cols = list(columns or df.columns)
    aggs = [F.count(F.lit(1)).alias("rows")]
    for i, c in enumerate(cols):
        v = F.col(f"`{c}`").cast("string")
        length = any_length(v, null_length)
        aggs.append(F.struct(
            F.max(is_blank(v)).alias("has_blanks"), F.max(v.isNull()).alias("has_nulls"),
            F.max(length).cast("int").alias("max_length"), F.min(length).cast("int").alias("min_length"),
            *([(F.approx_count_distinct(v) + F.max(v.isNull().cast("int"))).alias("distinct_count")] if approx else []),
        ).alias(f"_{i}"))
    one = df.agg(*aggs)
    fields = F.array(*[F.struct(F.lit(i).alias("ci"), F.lit(c).alias("column_name"), F.col("rows").alias("row_count"),
                                F.col(f"_{i}").alias("m")) for i, c in enumerate(cols)])
    per_col = one.select(F.inline(fields)).select("ci", "column_name", "row_count", "m.*")
    if not approx:
        exact = _distinct_counts(df, cols).withColumnRenamed("ci", "_ci")       # a row per column
        per_col = per_col.join(F.broadcast(exact), F.col("ci") == F.col("_ci"), "left")
    distinct = F.coalesce(F.col("distinct_count"), F.lit(0)).cast("bigint")
    unique = F.lit(None).cast("boolean") if approx else F.col("row_count") == distinct
    return per_col.select(
        F.lit(db).alias("db"), F.lit(table).alias("table_name"), "column_name", unique.alias("is_distinct"),
        F.coalesce("has_blanks", F.lit(False)).alias("has_blanks"),
        F.coalesce("has_nulls", F.lit(False)).alias("has_nulls"),
        "max_length", "min_length", "row_count", distinct.alias("distinct_count"))


def profile_report(profile: DataFrame) -> DataFrame:
    """The reference's report line fields: db, table, column, three
    'TRUE'/'FALSE' flags, max and min length."""
    def flag(c):
        return F.when(F.col(c), F.lit("TRUE")).otherwise(F.lit("FALSE")).alias(c)
    return profile.select("db", "table_name", "column_name", flag("is_distinct"), flag("has_blanks"),
                          flag("has_nulls"), "max_length", "min_length")


def value_frequency(df: DataFrame, col: str, n: int | None = 10, count_nulls: bool = False) -> DataFrame:
    """A11 + O3: most frequent values of ``col`` first, ties by value
    (NULL first). The count is ``count(col)`` like the reference, so the NULL
    group shows 0; ``count_nulls=True`` counts its rows. ``n`` keeps the top
    n (a top-k report: each task keeps its own top n before the merge);
    ``n=None`` returns every group."""
    cnt = F.count(F.lit(1)) if count_nulls else F.count(F.col(col))
    out = df.groupBy(col).agg(cnt.alias("cnt")).orderBy(F.desc("cnt"), F.asc_nulls_first(col))
    return out.limit(n) if n else out


def group_count(df: DataFrame, col: str) -> DataFrame:
    """Number of value groups of ``col`` (NULL is a group) and whether
    there is more than one."""
    g = F.count_distinct(F.col(col)) + F.coalesce(F.max(F.col(col).isNull().cast("int")), F.lit(0))
    return df.agg(g.cast("bigint").alias("n_groups")).withColumn("several", F.col("n_groups") > 1)


def value_frequencies(df: DataFrame, n: int = 10, columns=None, count_nulls: bool = False) -> DataFrame:
    """A11 + O3 for every column: the ``n`` most frequent values of
    each column (as text), ties by value, NULL first; ``cnt`` is
    ``count(col)`` (0 for the NULL group) unless ``count_nulls``.

    Per-value counts come from the profile's native grouping; the per-column
    ranking is ``row_number() <= n``, which Catalyst plans with a partial
    ``WindowGroupLimit`` before the shuffle, so a column with millions of
    distinct values sends at most ``n`` rows per task to the final ranking."""
    cols = list(columns or df.columns)
    counts = _value_counts(df, cols)
    cnt = F.col("n") if count_nulls else F.when(F.col("v").isNull(), F.lit(0)).otherwise(F.col("n"))
    counts = counts.select("ci", "v", cnt.cast("bigint").alias("cnt"))
    w = Window.partitionBy("ci").orderBy(F.desc("cnt"), F.asc_nulls_first("v"))
    top = counts.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)
    names = df.sparkSession.createDataFrame([(i, c) for i, c in enumerate(cols)], "ci int, column_name string")
    return top.join(F.broadcast(names), "ci").select("column_name", F.col("v").alias("value"), "cnt", "rank")
