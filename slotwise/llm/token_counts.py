"""Token counts: a two-tier lookup of pre-token lengths in the map task.

Texts are cut into pre-tokens; byte-pair merges never cross a pre-token, so a
text's token count is the sum over its pre-tokens. Tier one is a compact table
(pre-token -> number of tokens) of the corpus' frequent pre-tokens, broadcast;
tier two is each worker's cache, filled by encoding what the table misses with
the tokenizer library, one call for a group of texts. Pre-tokens are never shuffled:
the tasks count those of a sample of ``SAMPLE_TEXTS`` texts (a parameter) and send
their most frequent ones, ``SENT`` together at most, to the driver, which adds them up.
The table affects speed, never the result; what it lacks is in the worker's cache after
its first use.

Pre-tokens are cut by the tokenizer's pattern for texts whose characters all lie
below U+0250, where the pattern's classes are the same in every Unicode version;
other texts are cut by the library itself, and texts that hold an added token
are encoded whole by the library, which gives its default handling of them.

Null texts count as empty: no bytes, no tokens. Very long texts are cut like
others; repeated rows are counted one by one; other columns are never read.
"""

from __future__ import annotations

import os
from collections import Counter

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.llm import bytewords as bw
from slotwise.llm.graph import small_batches

TABLE_SIZE = 1 << 17        # pre-tokens in the broadcast table
SAMPLE_TEXTS = 1 << 14      # texts, about, that the table is made from
SENT = 1 << 19              # pre-tokens that all tasks together report
COUNTER_SIZE = 1 << 18      # entries at which a task's counter drops its rare half
CACHE_SIZE = 1 << 20        # entries of a worker's cache
TABLE_BYTES = 64            # longest pre-token in the table
GROUP = 256                 # texts whose misses are encoded in one call
_SAFE = regex.compile(r"[ɐ-\U0010ffff]")
_WORKER: dict[str, "Encoder"] = {}


class Encoder:
    """The tokenizer library with a cache of pre-token lengths."""

    def __init__(self, path: str, pattern: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.cut = regex.compile(pattern).findall
        added = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.added = regex.compile("|".join(map(regex.escape, added))) if added else None
        self.cache: dict[str, int] = {}

    def whole(self, text: str) -> int:
        return len(self.tok.encode(text, add_special_tokens=False).ids)

    def special(self, text: str) -> bool:
        return self.added is not None and self.added.search(text) is not None

    def pretokens(self, text: str) -> list[str]:
        if _SAFE.search(text) is None:
            return self.cut(text)
        return [text[a:b] for _, (a, b) in self.tok.pre_tokenizer.pre_tokenize_str(text)]

    def lengths(self, words: list[str]) -> list[int]:
        return [len(e.ids) for e in self.tok.encode_batch(words, add_special_tokens=False)]

    def counts(self, texts: list[str], table: dict[str, int]) -> list[int]:
        """Tokens per text: the table and the cache in one dictionary, what both
        miss encoded once for all the texts."""
        known, out, todo = self.cache, [], []
        if len(known) < len(table) or len(known) > len(table) + CACHE_SIZE:
            known = self.cache = dict(table)
        for k, text in enumerate(texts):
            if not text or self.special(text):
                out.append(self.whole(text) if text else 0)
                continue
            words = self.pretokens(text)
            found = list(map(known.get, words))
            out.append(sum(filter(None, found)))
            if None in found:
                todo.append((k, [w for w, n in zip(words, found) if n is None]))
        new = list({w: None for _, missing in todo for w in missing})
        if new:
            known.update(zip(new, self.lengths(new)))
        for k, missing in todo:
            out[k] += sum(map(known.get, missing))
        return out


def encoder(path: str, pattern: str) -> Encoder:
    if path not in _WORKER:
        _WORKER[path] = Encoder(path, pattern)
    return _WORKER[path]


def frequent_pretokens(docs: DataFrame, path: str, pattern: str, text_col: str = "text",
                       size: int = TABLE_SIZE, sample_texts: int = SAMPLE_TEXTS) -> dict[str, int]:
    """The broadcast table, from a sample of the texts. Every task counts the
    pre-tokens of its sampled texts (in bounded memory: an overfull counter drops its
    rare half) and reports its share of ``SENT`` at most."""
    total = docs.count()
    if not total:
        return {}
    texts = docs.select(docs[text_col])
    texts = texts.sample(sample_texts / total, seed=7) if sample_texts < total else texts
    most = max(1, SENT // max(1, texts.rdd.getNumPartitions()))

    @bw.tidy
    def run(batches):
        enc = encoder(path, pattern)
        counts: Counter = Counter()
        for b in batches:
            for text in b.column(0).to_pylist():
                if text and not enc.special(text):
                    counts.update(enc.pretokens(text))
                    if len(counts) > COUNTER_SIZE:
                        counts = Counter(dict(counts.most_common(COUNTER_SIZE // 2)))
        top = [(w, n) for w, n in counts.most_common(most) if len(w) <= TABLE_BYTES]
        yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())],
                                         names=["pretoken", "n"])

    found: Counter = Counter()
    for b in texts.mapInArrow(run, "pretoken string, n long").toArrow().to_batches():       # SENT rows at most
        for w, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            found[w] += n
    words = [w for w, n in found.most_common(size)]
    return dict(zip(words, encoder(path, pattern).lengths(words)))


def count_tokens(docs: DataFrame, path: str, pattern: str, limit: int = 512, id_col: str = "doc_id",
                 text_col: str = "text", table_size: int = TABLE_SIZE, sample_texts: int = SAMPLE_TEXTS) -> DataFrame:
    """One row per input row: id, ``n_bytes``, ``n_tokens``, ``over_limit``."""
    src = small_batches(docs).select(docs[id_col].alias(id_col), docs[text_col].alias("_text"))
    table = src.sparkSession.sparkContext.broadcast(
        frequent_pretokens(src, path, pattern, "_text", table_size, sample_texts) if table_size else {})
    id_type = src.schema[0].dataType.simpleString()

    @bw.tidy
    def run(batches):
        enc, known = encoder(path, pattern), table.value
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            n = [x for k in range(0, len(texts), GROUP) for x in enc.counts(texts[k:k + GROUP], known)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(t.encode()) for t in texts], pa.int64()),
                 pa.array(n, pa.int64())], names=[id_col, "n_bytes", "n_tokens"])

    return (src.mapInArrow(run, f"`{id_col}` {id_type}, n_bytes long, n_tokens long")
            .withColumn("over_limit", F.col("n_tokens") > limit))
