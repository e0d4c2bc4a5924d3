"""Benchmark decontamination by a prefix-filtered set join.

Every run of ``window`` consecutive words of a benchmark item (the whole item if
it has fewer) is a window; a document is hit where a window occurs in it word by
word. Each window is a set of placed word shingles that must be contained whole,
so one shingle is a sufficient prefix: the rarest, by the shingles' counts over
all documents. Documents are probed with the prefix shingles only; the shingle's
place in the window gives the one start that is possible (positional bound), the
document's words must reach far enough (length bound), and what is left is
verified word by word over the window.

The benchmark is cut into blocks of a stated size (its total size is measured
first); each block is one broadcast index and two narrow passes over the
documents, one that counts shingles and one that joins. Documents are never
shuffled or grouped.

Null or empty documents have no words and no hits. Items with a null id, and
items without words, are ignored; repeated items count once. Repeated document
rows are judged one by one. An empty benchmark hits nothing.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.llm import bytewords as bw
from slotwise.llm.graph import small_batches

WINDOW = 10
SHINGLE = 3
BLOCK_BYTES = 4 << 20       # benchmark text per broadcast index, which takes about thirty times that


@dataclass
class Index:
    """Windows of one benchmark block. ``rows``: per shingle length, the sorted
    prefix shingles with their (window, place) lists."""

    words: np.ndarray           # windows x WINDOW word hashes, zero-padded
    length: np.ndarray          # words per window
    ids: list[str]              # item ids, sorted
    held: np.ndarray            # items (places in ids) per window, one list after the other
    head: np.ndarray            # where each window's list starts, and the end
    shingles: dict[int, np.ndarray]                     # length -> sorted distinct hashes
    prefix: dict[int, tuple[np.ndarray, ...]]           # length -> (hashes, list starts, window, place)


def build_index(items: list[tuple[str, str]], window: int, shingle: int) -> Index:
    """The windows of (id, text) pairs, without prefixes. Arrays throughout: a
    window is a row of word hashes and its length, equal rows are one."""
    ids = sorted({i for i, _ in items})
    place = {i: k for k, i in enumerate(ids)}
    texts = [t.encode() for _, t in items]
    grids, owners = [np.zeros((0, window + 1), np.uint64)], [np.empty(0, np.int32)]
    for lo, hi in bw.chunk_ranges(texts):
        c = bw.parse(texts[lo:hi], bw.ALNUM, lower=True)
        own = np.array([place[i] for i, _ in items[lo:hi]], np.int32)
        words, doc = np.diff(c.first), c.doc
        for size in range(1, window + 1):
            if size < window:
                t = np.flatnonzero(words == size)
                at = c.first[t]
            else:
                at = np.flatnonzero(doc[:max(len(doc) - window + 1, 0)] == doc[window - 1:])
                t = doc[at]
            grid = np.zeros((len(at), window + 1), np.uint64)
            for j in range(size):
                grid[:, j] = c.word[at + j]
            grid[:, window] = size
            grids.append(grid)
            owners.append(own[t])
    grid, owner = np.concatenate(grids), np.concatenate(owners)
    del grids, owners
    order = np.lexsort((owner, *grid.T))
    grid, owner = grid[order], owner[order]
    new = np.ones(len(grid), bool)
    new[1:] = (grid[1:] != grid[:-1]).any(axis=1)
    again = np.zeros(len(grid), bool)
    again[1:] = ~new[1:] & (owner[1:] == owner[:-1])            # a window that an item holds twice
    number = (np.cumsum(new) - 1)[~again]
    held, grid = owner[~again], grid[new]
    head = np.searchsorted(number, np.arange(len(grid) + 1))
    length, grid = grid[:, window].astype(np.int64), np.ascontiguousarray(grid[:, :window])
    parts: dict[int, list[np.ndarray]] = {}
    for size in range(1, window + 1):
        rows = np.flatnonzero(length == size)
        s = min(shingle, size)
        flat = grid[rows].reshape(-1)
        for place in range(size - s + 1):
            parts.setdefault(s, []).append(bw.gram_hash(flat, np.arange(len(rows)) * window + place, s))
    shingles = {s: np.unique(np.concatenate(p)) for s, p in parts.items() if sum(map(len, p))}
    return Index(grid, length, ids, held, head, shingles, {})


def choose_prefixes(ix: Index, counts: dict[int, np.ndarray], shingle: int) -> None:
    """Each window's rarest shingle (ties: the first place) becomes its prefix."""
    for s, table in ix.shingles.items():
        rows = np.flatnonzero(np.minimum(ix.length, shingle) == s)
        flat = ix.words.reshape(-1)
        best = np.full(len(rows), np.iinfo(np.int64).max)
        place, key = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.uint64)
        for p in range(ix.words.shape[1] - s + 1):
            fits = ix.length[rows] >= p + s
            h = bw.gram_hash(flat, rows[fits] * ix.words.shape[1] + p, s)
            n = counts[s][np.searchsorted(table, h)]
            better = n < best[fits]
            at = np.flatnonzero(fits)[better]
            best[at], place[at], key[at] = n[better], p, h[better]
        order = np.argsort(key, kind="stable")
        keys, starts = np.unique(key[order], return_index=True)
        ix.prefix[s] = keys, np.append(starts, len(order)), rows[order], place[order]


def find_hits(c: bw.Chunk, ix: Index) -> tuple[np.ndarray, np.ndarray]:
    """(first word, window) of all window occurrences in a chunk."""
    doc, starts, windows = c.doc, [], []
    for s, (keys, lists, window, place) in ix.prefix.items():
        h, at = c.ngrams(s)
        i, k = bw.lookup(keys, h)
        n = lists[k + 1] - lists[k]
        entry = np.repeat(lists[k] - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
        start, w = np.repeat(at[i], n) - place[entry], window[entry]
        d = np.repeat(doc[at[i]], n)
        ok = (start >= c.first[d]) & (start + ix.length[w] <= c.first[d + 1])
        starts.append(start[ok])
        windows.append(w[ok])
    start, w = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (starts, windows))
    for j in range(ix.words.shape[1]):
        inside = ix.length[w] > j
        same = c.word[np.minimum(start + j, len(c.word) - 1)] == ix.words[w, j] if len(w) else inside
        start, w = start[~inside | same], w[~inside | same]
    return start, w


def _blocks(docs: DataFrame, text_col: str, benchmark: DataFrame, id_col: str, item_text: str, window: int,
            shingle: int, block_bytes: int):
    """Broadcast index of every benchmark block, prefixes chosen."""
    small_batches(docs)
    items = benchmark.select(benchmark[id_col].cast("string").alias("id"), benchmark[item_text].alias("text"))
    items = items.where("id is not null and text is not null")
    total = items.agg(F.sum(F.octet_length("text") + 32)).first()[0] or 0
    n = math.ceil(total / block_bytes)
    for k in range(n):
        part = items.where(F.pmod(F.xxhash64("id"), F.lit(n)) == k) if n > 1 else items
        ix = build_index([(r.id, r.text) for r in part.collect()], window, shingle)
        sc = docs.sparkSession.sparkContext
        counts = _count_shingles(docs.select(docs[text_col]), sc.broadcast(ix.shingles))
        choose_prefixes(ix, {s: counts.get(s, np.zeros(len(t), np.int64)) for s, t in ix.shingles.items()}, shingle)
        yield sc.broadcast(ix)


def _count_shingles(texts: DataFrame, shingles) -> dict[int, np.ndarray]:
    """Occurrences of the block's shingles over all documents."""
    @bw.tidy
    def run(batches):
        counts = {s: np.zeros(len(t), np.int64) for s, t in shingles.value.items()}
        for b in batches:
            for _, _, c in bw.chunks(b.column(0), bw.ALNUM, lower=True):
                for s, t in shingles.value.items():
                    _, k = bw.lookup(t, c.ngrams(s)[0])
                    counts[s] += np.bincount(k, minlength=len(t))
        for s, n in counts.items():
            k = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(k), s), pa.int32()), pa.array(k), pa.array(n[k])], names=["size", "k", "n"])

    got = texts.mapInArrow(run, "size int, k long, n long").groupBy("size", "k").agg(F.sum("n").alias("n"))
    out = {s: np.zeros(len(t), np.int64) for s, t in shingles.value.items()}
    for r in got.collect():       # a row per shingle of the block at most
        out[r["size"]][r["k"]] = r["n"]
    return out


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE,
                  id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text",
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document row: id, ``n_words``, ``n_hit`` (words inside any
    window), ``items`` (ids of the items that occur, distinct), ``spans``
    (merged hit ranges as word indices: start, end, start, end ...)."""
    src = docs.select(docs[id_col].alias(id_col), docs[text_col].alias("_text"))
    id_type = src.schema[0].dataType.simpleString()
    found = src.withColumns({"n_words": F.lit(0).cast("long"), "n_hit": F.lit(0).cast("long"),
                             "items": F.array().cast("array<string>"), "spans": F.array().cast("array<long>")})
    kept = f"`{id_col}` {id_type}, _text string, n_words long, n_hit long, items array<string>, spans array<long>"
    blocks = list(_blocks(src, "_text", benchmark, item_id, item_text, window, shingle, block_bytes))
    if not blocks:
        blocks = [src.sparkSession.sparkContext.broadcast(build_index([], window, shingle))]
    for ix in blocks:
        found = found.mapInArrow(_join(ix), kept)
    return found.drop("_text")


def _join(index):
    @bw.tidy
    def run(batches):
        ix = index.value
        for b in batches:
            n_hit, items, spans = (b.column(k).to_pylist() for k in (3, 4, 5))
            n_words = [np.empty(0, np.int64)]
            for lo, _, c in bw.chunks(b.column(1), bw.ALNUM, lower=True):
                n_words.append(np.diff(c.first))
                start, w = find_hits(c, ix)
                doc = np.searchsorted(c.first, start, side="right") - 1
                order = np.argsort(doc, kind="stable")
                for mine in np.split(order, np.flatnonzero(np.diff(doc[order])) + 1) if len(order) else ():
                    d = doc[mine[0]]
                    i, base = lo + d, int(c.first[d])
                    got = {ix.ids[x] for k in np.unique(w[mine]) for x in ix.held[ix.head[k]:ix.head[k + 1]]}
                    items[i] = sorted(got.union(items[i]))
                    runs = [(int(s) - base, int(s + n) - base) for s, n in zip(start[mine], ix.length[w[mine]])]
                    spans[i] = _merge(runs + list(zip(spans[i][0::2], spans[i][1::2])))
                    n_hit[i] = sum(spans[i][1::2]) - sum(spans[i][0::2])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(np.concatenate(n_words)), pa.array(n_hit, pa.int64()),
                 pa.array(items, pa.list_(pa.string())), pa.array(spans, pa.list_(pa.int64()))], names=b.schema.names)
    return run


def _merge(runs: list[tuple[int, int]]) -> list[int]:
    out: list[int] = []
    for a, z in sorted(runs):
        if out and a <= out[-1]:
            out[-1] = max(out[-1], z)
        else:
            out += [a, z]
    return out


def keep_clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE,
               text_col: str = "text", item_id: str = "item_id", item_text: str = "text",
               block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows without any window, with all their columns (no join)."""
    at = docs.columns.index(text_col)

    def clean(index):
        @bw.tidy
        def run(batches):
            for b in batches:
                for lo, hi, c in bw.chunks(b.column(at), bw.ALNUM, lower=True):
                    start, _ = find_hits(c, index.value)
                    ok = np.ones(hi - lo, bool)
                    ok[np.searchsorted(c.first, start, side="right") - 1] = False
                    yield b.slice(lo, hi - lo).filter(pa.array(ok))
        return run

    out = docs
    for ix in _blocks(docs, text_col, benchmark, item_id, item_text, window, shingle, block_bytes):
        out = out.mapInArrow(clean(ix), docs.schema)
    return out
