"""Corpus pipeline: five stages over ``documents``, each calling one operator of
:mod:`slotwise.llm` on all that its predecessor kept. Each stage's result is
written as Parquet to the shared folder and read again, so a lost executor
repeats one stage's tasks at most.

Stages but the last return the columns they were given. Null, empty and repeated
rows are treated as the operators' docstrings say; an empty table passes all
stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotwise.session import remove_path, scratch_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality rules: documents that they reject go."""
    from slotwise.llm.quality import keep_good
    return keep_good(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join: of each group of near duplicates (word 5-grams,
    similarity 0.8 or more) the document with the smallest id stays. Rows that
    repeat a doc_id with another text are judged by their own text; rows with a
    null doc_id all stay."""
    from slotwise.llm.ngram_join import one_per_group
    return one_per_group(docs, percent=80, n=5)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: documents that hold a benchmark window go."""
    from slotwise.llm.decontaminate import keep_clean
    return keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced in the texts; ``n_chars`` follows."""
    from slotwise.llm.pii import sanitise
    clean = sanitise(docs)
    if "n_chars" not in docs.columns:
        return clean
    n = F.coalesce(F.length("text").cast(docs.schema["n_chars"].dataType), F.col("n_chars"))
    return clean.withColumn("n_chars", n).select(*[F.col(f"`{c}`") for c in docs.columns])


def pieces_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SentencePiece encoding: doc_id, ``n_pieces``, ``ids``, and ``text`` as
    decoded from them."""
    import public_tokenizers
    from slotwise.llm.pieces import encode
    encoded = encode(docs, public_tokenizers.path("piece_bpe_32k.model"), decoded_col="text")
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_pieces"), "ids", "text")


STAGES = [
    ("quality rules", quality_stage),
    ("n-gram jaccard join", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("pii", pii_stage),
    ("sentencepiece", pieces_stage),
]

# Rolling hashes, link components and shortest paths are beyond SQL on whole
# tables; tests/llm/test_pipeline.py holds the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of the last stage over the whole ``documents`` table. A stage's
    files go when its successor's are written; the last stage's stay with the
    result."""
    docs, held = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = scratch_path(spark, "pipeline-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if held:
            remove_path(spark, held)
        held = path
    return docs
