"""First row per key across runs (W2): a stored table of key digests.

A run keeps the rows whose key no earlier run has kept. Digests of kept keys are
stored in hash ranges, one folder per run and range, and beside them a Bloom filter
per range: bitmaps in which a key's hash sets one bit. A new key whose bit is not
set has certainly not been seen and skips the join; the rest (seen keys, and a few
that share a bit) are anti-joined with the digests of their own ranges, so the scan
of the store is pruned to those.

With ``bits`` bits per range and n keys in it, a share of about n / bits of the new
keys is joined needlessly; results do not depend on it. A run that is repeated
ignores and replaces what it stored itself.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotwise.operators.dedup import first_per_key
from slotwise.operators.joins import measured, small_enough

DIGESTS = "range int, digest binary, run string"
FILTERS = "range int, bucket bigint, bitmap binary, run string"


@dataclass(frozen=True)
class KeyStore:
    """The digests of all runs under ``path`` (shared storage)."""
    path: str
    ranges: int = 64
    bits: int = 1 << 22

    def digest(self, keys) -> Column:
        """16 bytes per key; NULL fields count as a value."""
        return F.unhex(F.md5(F.to_json(F.struct(*[F.col(f"`{k}`").alias(f"k{i}") for i, k in enumerate(keys)]))))

    def _place(self, digest: str) -> dict[str, Column]:
        """Range, and the place of the key's bit in its filter."""
        bit = F.pmod(F.xxhash64(digest, F.lit(1)), F.lit(self.bits)) + 1
        return {"_range": F.pmod(F.xxhash64(digest), F.lit(self.ranges)).cast("int"),
                "_bucket": F.bitmap_bucket_number(bit), "_bit": F.bitmap_bit_position(bit)}

    def _read(self, spark, kind: str, schema: str, run: str) -> DataFrame:
        from slotwise.sinks import published
        where = f"{self.path.rstrip('/')}/{kind}"
        _, _, p, fs = published._fs(spark, where)
        df = spark.read.schema(schema).parquet(where) if fs.exists(p) else spark.createDataFrame([], schema)
        return df.where(F.col("run") != F.lit(run))

    def unseen(self, df: DataFrame, keys, run: str, order_by=None, ascending: bool = True) -> DataFrame:
        """The first row of each key (as :func:`first_per_key`) that no other run has
        stored."""
        spark, keys = df.sparkSession, [keys] if isinstance(keys, str) else list(keys)
        first = first_per_key(df, keys, order_by, ascending).withColumn("_digest", self.digest(keys))
        first = first.withColumns(self._place("_digest"))
        filters = (self._read(spark, "filters", FILTERS, run).groupBy(F.col("range").alias("_r"), F.col("bucket").alias("_b"))
                   .agg(F.bitmap_or_agg("bitmap").alias("_map")))
        if small_enough(measured({"filters": filters})["filters"]):
            filters = F.broadcast(filters)
        marked = first.join(filters, (F.col("_range") == F.col("_r")) & (F.col("_bucket") == F.col("_b")), "left")
        byte = F.expr("cast(conv(hex(substring(_map, cast(_bit div 8 as int) + 1, 1)), 16, 10) as int)")
        set_ = F.coalesce(F.getbit(byte, (F.col("_bit") % 8).cast("int")) == 1, F.lit(False))
        marked = marked.withColumn("_maybe", set_)
        held = self._read(spark, "digests", DIGESTS, run).select(F.col("range").alias("_hr"), F.col("digest").alias("_hd"))
        maybe = marked.where("_maybe").join(held, (F.col("_range") == F.col("_hr")) & (F.col("_digest") == F.col("_hd")), "left_anti")
        cols = [F.col(f"`{c}`") for c in df.columns]
        return marked.where("NOT _maybe").select(*cols).unionByName(maybe.select(*cols))

    def add(self, df: DataFrame, keys, run: str) -> None:
        """Store the keys of the rows that a run has kept."""
        keys = [keys] if isinstance(keys, str) else list(keys)
        rows = df.select(self.digest(keys).alias("digest")).distinct().withColumns(self._place("digest"))
        base = self.path.rstrip("/")
        filters = rows.groupBy(F.col("_range").alias("range"), F.col("_bucket").alias("bucket")).agg(
            F.bitmap_construct_agg("_bit").alias("bitmap"))
        # the filter first: a digest without its bit would be taken for unseen
        filters.write.mode("overwrite").parquet(f"{base}/filters/run={run}")
        rows.select(F.col("_range").alias("range"), "digest").write.mode("overwrite").partitionBy("range").parquet(f"{base}/digests/run={run}")
