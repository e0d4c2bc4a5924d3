"""Quarantine of malformed readings (X15, P2): good rows go on, bad rows are kept
aside with their reasons instead of failing the load or turning into NULL.

A reading is malformed if a field that the interval job reads as a number, a date
or a time is present and cannot be read as such. NULL fields are no fault. One pass
tags every row; good and malformed rows are two filters over it, and counts come
with the pass that writes them (``Observation``), so nothing is scanned again to
report them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from slotwise.operators.normalise import ReadingColumns

#: The column that holds a row's reasons (empty for good rows).
REASONS = "malformed"


def checks(cols: ReadingColumns = ReadingColumns()) -> dict[str, tuple[str, str]]:
    """Reason -> (column, type its text must be readable as)."""
    return {"value": (cols.value, "decimal(18,4)"), "period count": (cols.period_count, "int"),
            "interval": (cols.interval, "int"), "day": (cols.day, "date"),
            "quarter start": (cols.quarter_start, "timestamp"), "hour start": (cols.hour_start, "timestamp")}


def tag(src: DataFrame, cols: ReadingColumns = ReadingColumns(), rules: dict | None = None) -> DataFrame:
    """``src`` with ``malformed``: an array of (reason, raw text), empty if the row
    is good. Columns already of the type in question are not read."""
    kinds = dict(src.dtypes)
    faults: list[Column] = []
    for reason, (c, kind) in (rules or checks(cols)).items():
        if kinds[c] == kind or (kinds[c] != "string" and kind != "decimal(18,4)"):
            continue                                                            # not text: cannot be malformed
        v = F.col(f"`{c}`")
        faults.append(F.when(v.isNotNull() & v.try_cast(kind).isNull(),
                             F.struct(F.lit(reason).alias("reason"), v.cast("string").alias("raw"))))
    none = F.array().cast("array<struct<reason:string,raw:string>>")
    return src.withColumn(REASONS, F.array_compact(F.array(*faults)) if faults else none)


@dataclass
class Quarantined:
    """The two sides of one tagged frame, and the counts of the pass over it."""
    good: DataFrame
    bad: DataFrame
    observation: Observation

    @property
    def counts(self) -> dict:
        """rows, malformed and rows per reason, once an action has run over the
        tagged frame (``good`` and ``bad`` are filters above it)."""
        return dict(self.observation.get)


def quarantine(src: DataFrame, cols: ReadingColumns = ReadingColumns(), rules: dict | None = None,
               name: str = "readings") -> Quarantined:
    """Split ``src``. ``good`` has its columns; ``bad`` has them and ``malformed``.
    Good and malformed rows are all rows of ``src``, each once."""
    rules = rules or checks(cols)
    tagged = tag(src, cols, rules)
    seen = Observation(name)
    some = F.size(REASONS) > 0
    per = [F.sum(F.array_contains(F.col(f"{REASONS}.reason"), r).cast("bigint")).alias(f"malformed {r}") for r in rules]
    tagged = tagged.observe(seen, F.count(F.lit(1)).alias("rows"), F.sum(some.cast("bigint")).alias("malformed"), *per)
    return Quarantined(tagged.where(~some).drop(REASONS), tagged.where(some), seen)


def write_quarantine(bad: DataFrame, path: str, run: str) -> None:
    """Malformed rows as JSON under ``<path>/run=<run>``; a rerun replaces its own.
    Reasons and raw texts are kept beside the row."""
    bad.write.mode("overwrite").json(f"{path.rstrip('/')}/run={run}")
