"""Registered queries of the subpackage, ``(spark, sf_dir) -> DataFrame``, and
their DuckDB SQL where SQL can express them in reasonable time."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op6_quality_rules(spark, sf_dir):
    from slotwise.llm.quality import quality
    return quality(table(spark, sf_dir, "documents"))


# The rules of the registered query.
URL_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


@query
def op2_url_filter(spark, sf_dir):
    from slotwise.llm.urls import filter_urls
    return filter_urls(table(spark, sf_dir, "pages"), URL_RULES)


ORACLE["op2_url_filter"] = f"""
WITH rules(verdict, rhost, rpath) AS (VALUES {", ".join(map(str, URL_RULES))}),
split AS (
  SELECT page_id,
         coalesce(translate(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') AS path,
         row_number() OVER () AS row_id
  FROM pages),
fit AS (
  SELECT row_id, rhost || rpath AS rule, verdict,
         row_number() OVER (PARTITION BY row_id ORDER BY length(rhost) DESC, length(rpath) DESC, verdict DESC) AS place
  FROM split JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM split LEFT JOIN (SELECT * FROM fit WHERE place = 1) f USING (row_id)
"""


@query
def op5_token_counts(spark, sf_dir):
    import public_tokenizers
    from slotwise.llm.token_counts import count_tokens
    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


@query
def op8_decontamination(spark, sf_dir):
    from pyspark.sql import functions as F
    from slotwise.llm.decontaminate import contamination
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.sort_array("items")), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


@query
def op7_sentencepiece(spark, sf_dir):
    import public_tokenizers
    from pyspark.sql import functions as F
    from slotwise.llm.pieces import encode
    encoded = encode(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), decoded_col="decoded")
    return encoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_pieces"),
        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))


@query
def op1_ngram_jaccard_join(spark, sf_dir):
    from slotwise.llm.ngram_join import jaccard_components
    return jaccard_components(table(spark, sf_dir, "documents"))


@query
def op3_suffix_dedup(spark, sf_dir):
    from pyspark.sql import functions as F
    from slotwise.llm.suffix_dedup import remove_repeats
    cut = remove_repeats(table(spark, sf_dir, "documents"))
    return cut.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        (F.size("ranges") / 2).cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
        "n_passage_words")


@query
def op9_pii(spark, sf_dir):
    from pyspark.sql import functions as F
    from slotwise.llm.pii import PATTERNS, find_pii, span_text
    found = find_pii(table(spark, sf_dir, "documents").select("doc_id", "text"))

    def of_kind(k):
        return lambda s: s["rank"] == k        # F.filter hands a second argument, also a default one, the index

    counts = [F.size(F.filter("base", of_kind(k))).cast("long").alias(f"n_{kind}") for k, kind in enumerate(PATTERNS)]
    return found.select("doc_id", *counts, F.sha2(span_text(F.col("base")), 256).alias("base_sha256"),
                        span_text(F.col("spans")).alias("spans"))


@query
def op4_lm_scoring(spark, sf_dir):
    from slotwise.llm.lm import score
    return score(table(spark, sf_dir, "documents"))


@query
def op10_quote_linking(spark, sf_dir):
    from pyspark.sql import functions as F
    from slotwise.llm.quotes import format_chat, link_quotes
    chat = format_chat(link_quotes(table(spark, sf_dir, "conversations")))
    return chat.withColumn("reply_path", F.array_join(F.col("reply_path").cast("array<string>"), "/"))


@query
def op12_spelling_variants(spark, sf_dir):
    from pyspark.sql import functions as F
    from slotwise.llm.spelling import count_words, runs, variants, without_one
    run = F.col("run")
    h = F.crc32(F.concat(F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    found = runs(table(spark, sf_dir, "documents")).withColumn("h", h)
    cut = F.when(F.col("h") % 97 == 0, without_one(run, (F.col("h") % F.char_length(run)).cast("int"))).otherwise(run)
    return variants(count_words(found.select(cut.alias("word"))))


@query
def op13_minhash_dedup(spark, sf_dir):
    from slotwise.llm.minhash import near_duplicates
    return near_duplicates(table(spark, sf_dir, "documents"))


@query
def op11_hard_negatives(spark, sf_dir):
    from pyspark.sql import functions as F
    from slotwise.llm.hard_negatives import hard_negatives
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.select("vec_id", label.alias("label"), "embedding"))


# ---- SQL ---------------------------------------------------------------------------------

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words_sql(table_name: str, key: str, pattern: str) -> str:
    """(key, ws): the lower-cased words of every text, null texts without words."""
    return f"""SELECT {key}, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{pattern}') AS ws,
    row_number() OVER () AS row_id FROM {table_name}"""


def _components_sql(n: int, columns: str) -> str:
    """Components of the links between sets of word ``n``-grams."""
    return f"""
WITH RECURSIVE words AS ({_words_sql("documents", "doc_id", "[^\\x20\\x09-\\x0D]+")}),
grams AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + {n - 1}], ' ') AS gram
  FROM words, unnest(range(1, greatest(len(ws) - {n - 1}, 1) + 1)) AS t(i) WHERE len(ws) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM grams a JOIN grams b ON a.gram = b.gram AND a.doc_id <> b.doc_id
  JOIN sizes s ON s.doc_id = a.doc_id JOIN sizes t ON t.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, s.n, t.n HAVING 100 * count(*) >= 85 * (s.n + t.n - count(*))),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, l.y FROM reach r JOIN links l ON l.x = r.other)
SELECT w.doc_id, coalesce(n, 0) AS n_shingles, {columns}
FROM words w LEFT JOIN sizes s ON s.doc_id = w.doc_id
JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) c ON c.doc_id = w.doc_id
"""


ORACLE["op1_ngram_jaccard_join"] = _components_sql(4, "component_id")
ORACLE["op13_minhash_dedup"] = _components_sql(5, "component_id, w.doc_id = component_id AS kept")

ORACLE["op8_decontamination"] = f"""
WITH words AS ({_words_sql("documents", "doc_id", "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+")}),
item_words AS ({_words_sql("benchmark", "item_id", "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+")}),
windows AS (
  SELECT DISTINCT CAST(item_id AS VARCHAR) AS item_id, least(len(ws), 10) AS size, array_to_string(ws[i:i + 9], ' ') AS win
  FROM item_words, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS t(i) WHERE len(ws) > 0 AND item_id IS NOT NULL),
hits AS (
  SELECT row_id, i, size, item_id
  FROM (SELECT row_id, i, size, array_to_string(ws[i:i + size - 1], ' ') AS win
        FROM words, (SELECT DISTINCT size FROM windows) s, unnest(range(1, len(ws) - size + 2)) AS t(i)) d
  JOIN windows USING (size, win)),
hit_words AS (
  SELECT row_id, count(DISTINCT k) AS n FROM hits, unnest(range(i, i + size)) AS t(k) GROUP BY row_id),
hit_items AS (
  SELECT row_id, count(DISTINCT item_id) AS n, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS ids FROM hits GROUP BY row_id)
SELECT doc_id, len(ws) AS n_words, coalesce(h.n, 0) AS n_hit, coalesce(t.n, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(h.n, 0) > 0 AS contaminated
FROM words LEFT JOIN hit_words h USING (row_id) LEFT JOIN hit_items t USING (row_id)
"""

ORACLE["op11_hard_negatives"] = """
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
         CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM rows a JOIN rows b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, positive_id, CAST(place AS INTEGER) AS rank, other_id AS negative_id, positive_score, score AS negative_score
FROM (SELECT p.*, n.other_id, n.score,
             row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id) AS place
      FROM positives p JOIN scores n ON n.anchor_id = p.anchor_id AND NOT n.same
       AND 100 * n.score BETWEEN 30 * positive_score AND 90 * positive_score) p
WHERE place <= 10
"""
