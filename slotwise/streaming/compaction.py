"""Compaction of per-batch folders.

A stream that writes one folder per micro-batch leaves tens of thousands of small
folders a day. Compaction folds those of committed batches into one version of a
few files, published by pointer (:mod:`slotwise.sinks.published`): the pointer names
the version and the last batch in it, so one rename moves a batch from its folder
into the version, and a reader sees every batch exactly once at any moment.

A killed compaction leaves an unnamed version and all folders; running it again
does the same work. Folders of folded batches are removed after the pointer moved;
one that is left (or written again by a replay of a folded batch) is not read, as
its id is not above the pointer's.

Batch ids grow by one per batch; only batches up to ``through`` that the query has
committed may be folded (``committed`` reads that from the query's checkpoint).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from slotwise.operators.joins import measured
from slotwise.sinks import published

FILE_BYTES = 64 << 20       # of rows in memory


def batch_ids(spark: SparkSession, path: str) -> list[int]:
    """Ids of the batch folders under ``path``."""
    _, _, p, fs = published._fs(spark, path)
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]
    return sorted(int(n[9:]) for n in names if n.startswith("batch_id=") and n[9:].isdigit())


def committed(spark: SparkSession, checkpoint: str) -> int:
    """The last batch that a streaming query has committed, -1 if none."""
    _, _, p, fs = published._fs(spark, f"{checkpoint.rstrip('/')}/commits")
    if not fs.exists(p):
        return -1
    names = [s.getPath().getName() for s in fs.listStatus(p) if s.isFile()]
    return max([int(n) for n in names if n.isdigit()], default=-1)


def _store(path: str) -> str:
    return f"{path.rstrip('/')}/compacted"


def folded_through(spark: SparkSession, path: str) -> int:
    now = published.current(spark, _store(path))
    return now["through"] if now else -1


def read_batches(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All batches under ``path``, folded or not, each once, with ``batch_id``."""
    full = StructType(list(schema.fields)).add("batch_id", LongType())
    through = folded_through(spark, path)
    parts = [f"{path.rstrip('/')}/batch_id={b}" for b in batch_ids(spark, path) if b > through]
    rows = spark.read.schema(full).option("basePath", path).parquet(*parts) if parts else spark.createDataFrame([], full)
    where = published.folder(spark, _store(path))
    return spark.read.schema(full).parquet(where).unionByName(rows) if where else rows


def compact(spark: SparkSession, path: str, schema: StructType, through: int, files: int | None = None) -> int:
    """Fold the batches up to ``through`` into the store; the number of folders
    folded. The rows are not changed; they are clustered by batch. Each file is
    sorted by one task; without ``files`` there is one per ``FILE_BYTES`` of the
    rows' measured size."""
    done = folded_through(spark, path)
    fold = [b for b in batch_ids(spark, path) if done < b <= through]
    if fold:
        rows = read_batches(spark, path, schema).where(F.col("batch_id") <= max(fold))

        if files is None:
            files = max(1, -(-(measured({"rows": rows})["rows"][1] or 0) // FILE_BYTES))

        def write(folder: str) -> None:
            tie = F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns])          # a large batch can be cut
            rows.repartitionByRange(files, "batch_id", tie).sortWithinPartitions("batch_id").write.parquet(folder)

        published.publish(spark, _store(path), write, through=max(fold))
    from slotwise.session import remove_path
    for b in batch_ids(spark, path):
        if b <= folded_through(spark, path):
            remove_path(spark, f"{path.rstrip('/')}/batch_id={b}")
    return len(fold)
