"""Suffix-array dedup: removes bytes covered by long strings that repeat.

A byte goes if a string of ``length`` bytes that covers it also starts anywhere
else, in the same text or another. The strings of that length are all windows of
the texts; equal ones have to meet.

1. Each window has one anchor: the place of the smallest hash among its grams of
   ``gram`` bytes (leftmost on ties). Anchor and offset depend on the window's
   content alone, so equal windows share the anchor's gram and the offset to it.
   Neighbouring windows share an anchor: such a run is one row (gram, hash of the
   run's bytes, place), about one per 170 bytes.
2. A run whose bytes occur twice repeats as a whole. Runs that repeat inside a
   chunk of texts (a text over and over the same phrase, copies side by side) are
   one row with their number, and their ranges are merged there; the others are
   counted with partial sums in the tasks.
3. Grams with several different runs keep one run of each kind, with its bytes.
   The runs' suffixes from the anchor on, and the reversed prefixes before it, are
   ordered by deep-shallow sorting (:mod:`slotwise.llm.suffix_sort`); from the
   common prefixes of both orders follows how far each run agrees with any other
   over ``length`` bytes or more. A gram with more than ``BLOCK_RUNS`` runs is
   split into blocks, and every pair of blocks is one task.
4. The ranges found are merged per text and cut out.

Passages are found the same way on the texts' word codes: ``CODE_BYTES`` bytes of
each word's hash. A run of more than ``passage_words`` words that stands anywhere
else too is counted in ``n_passage_words``, whatever its length in bytes; such
words are reported and not cut out.

Null texts are empty; texts shorter than ``length`` keep all bytes. Repeated rows
are copies of each other. Other columns are never read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.llm import bytewords as bw
from slotwise.llm.graph import cut, release, small_batches
from slotwise.llm.suffix_sort import deep_shallow

LENGTH = 400
GRAM = 64
BLOCK_RUNS = 1024           # runs of a block; a task holds two blocks
FLUSH_BYTES = 8 << 20       # run bytes that a task gathers before it sorts them
BROADCAST_BYTES = 32 << 20  # counted bytes up to which a per-text table is broadcast
ROW_BYTES = 96              # what a broadcast row takes beside its values
PASSAGE_WORDS = 50          # passages are longer than this
CODE_BYTES = 3
CODE_GRAM = 8               # words of an anchor's gram
SIFT_BITS = 26              # bits (as a power of two) of the map of repeated grams, 8 MB at any size


def window_runs(c: bw.Chunk, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """(text, first window start in the chunk, windows, anchor, gram hash, hash
    of the run's bytes) for all runs of a chunk."""
    n, width = len(c.raw), length - gram + 1
    empty = np.empty(0, np.int64)
    if n < length:
        return (empty,) * 4 + (np.empty(0, np.uint64),) * 2
    at = np.arange(n - gram + 1)
    h = c.range_hash(at, at + gram)
    anchor = _leftmost_min(h, width)                            # per window start
    size = np.diff(c.doc_start) - 1
    valid = np.zeros(n + 1, np.int32)
    long = np.flatnonzero(size >= length)
    valid[c.doc_start[long]] += 1
    valid[c.doc_start[long] + size[long] - length + 1] -= 1
    ok = np.cumsum(valid[:len(anchor)]) > 0
    new = np.ones(len(anchor), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | ~ok[:-1]
    edge = np.append(np.flatnonzero(new | ~ok), len(anchor))
    start = np.flatnonzero(new & ok)
    end = edge[np.searchsorted(edge, start) + 1]
    place = anchor[start]
    text = np.searchsorted(c.doc_start, start, side="right") - 1
    # the offset to the anchor is part of what a run is
    whole = bw.mix(c.range_hash(start, end - 1 + length) + (place - start).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return text, start, end - start, place, h[place], whole


def _leftmost_min(h: np.ndarray, width: int) -> np.ndarray:
    """Place of the leftmost minimum of every ``width`` neighbours: the better of
    a block's suffix minimum and the next block's prefix minimum."""
    n = len(h) - width + 1
    x = np.full(-(-len(h) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    x[:len(h)] = h
    x = x.reshape(-1, width)
    block = np.arange(len(x))[:, None] * width
    step = np.arange(width)
    least, at = np.minimum.accumulate(x, axis=1), np.zeros(x.shape, np.int64)
    at[:, 1:] = np.where(x[:, 1:] < least[:, :-1], step[1:], 0)         # strictly less: the left one stays
    before, before_at = least.ravel(), (np.maximum.accumulate(at, axis=1) + block).ravel()
    y = x[:, ::-1]
    least, at = np.minimum.accumulate(y, axis=1), np.zeros(x.shape, np.int64)
    at[:, 1:] = np.where(y[:, 1:] <= least[:, :-1], step[1:], 0)        # from the right: ties move left
    after = least[:, ::-1].ravel()
    after_at = (width - 1 - np.maximum.accumulate(at, axis=1)[:, ::-1] + block).ravel()
    end = slice(width - 1, width - 1 + n)
    return np.where(after[:n] <= before[end], after_at[:n], before_at[end])


def _view(texts: list[bytes], words: bool) -> list[bytes]:
    """The bytes that are searched: the texts', or their word codes."""
    return word_codes(texts) if words else texts


def _grams(length: int, gram: int, words: bool):
    """(g, n): the anchors' grams of a chunk; n is 2 where one stands there twice."""
    @bw.tidy
    def run(batches):
        for b in batches:
            texts = bw.blobs(b.column(0))
            for lo, hi in bw.chunk_ranges(texts):
                part = [t for t in _view(texts[lo:hi], words) if len(t) >= length]
                if part:
                    g, n = np.unique(window_runs(bw.parse(part, bw.SPACED, lower=False), length, gram)[4], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(g.view(np.int64)), pa.array(np.minimum(n, 2), pa.int64())], names=["g", "n"])
    return run


def repeated_grams(texts: DataFrame, length: int, gram: int, words: bool = False) -> np.ndarray:
    """A bit per anchor gram that occurs twice or more, as bytes. Of fixed size: where
    there are more grams than bits, fewer runs are sifted out."""
    twice = (small_batches(texts).mapInArrow(_grams(length, gram, words), "g long, n long")
             .groupBy("g").agg(F.sum("n").alias("n")).where("n > 1"))
    bit = F.col("g").bitwiseAND(F.lit((1 << SIFT_BITS) - 1)) + 1
    maps = twice.select(bit.alias("bit")).groupBy(F.bitmap_bucket_number("bit").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits")).toArrow()       # 2 ** (SIFT_BITS - 15) rows of 4 KB
    out = np.zeros(((1 << SIFT_BITS) >> 15, 4096), np.uint8)
    for k, b in zip(maps.column("bucket").to_pylist(), maps.column("bits").to_pylist()):
        out[k - 1] = np.frombuffer(b, np.uint8)
    return out.reshape(-1)


def _sifted(g: np.ndarray, bits: np.ndarray) -> np.ndarray:
    at = (g & np.uint64((1 << SIFT_BITS) - 1)).astype(np.int64)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


def _runs(length: int, gram: int, known=None, words: bool = False):
    """``known``: broadcast bits of the repeated grams; other runs are left out."""
    @bw.tidy
    def run(batches):
        for b in batches:
            texts = bw.blobs(b.column(0))
            for lo, hi in bw.chunk_ranges(texts):
                long = [(t, x) for t, x in zip(texts[lo:hi], _view(texts[lo:hi], words)) if len(x) >= length]
                if not long:
                    continue
                part = [t for t, _ in long]
                c = bw.parse([x for _, x in long], bw.SPACED, lower=False)
                text, start, windows, place, g, whole = window_runs(c, length, gram)
                if known is not None:
                    some = _sifted(g, known.value)
                    text, start, windows, place, g, whole = (v[some] for v in (text, start, windows, place, g, whole))
                digest = pa.array([hashlib.md5(t).digest() for t in part], pa.binary())
                at = start - c.doc_start[text]
                key = bw.mix(g ^ bw.mix(whole))
                same = np.flatnonzero(bw.repeated(key))
                _, one, count = np.unique(key[same], return_index=True, return_counts=True)
                row = np.append(np.setdiff1d(np.arange(len(key)), same), same[one])
                n = np.append(np.ones(len(row) - len(one), np.int64), count)
                yield _rows(n, digest.take(pa.array(text[row])), at[row], windows[row], (place - start)[row],
                            g[row].view(np.int64), whole[row].view(np.int64))
                # runs come in order, so their ranges only grow
                a, z = at[same], at[same] + windows[same] - 1 + length
                new = np.ones(len(same), bool)
                new[1:] = (text[same][1:] != text[same][:-1]) | (a[1:] > z[:-1])
                first = np.flatnonzero(new)
                if len(first):
                    last = np.append(first[1:], len(same)) - 1
                    zero = np.zeros(len(first), np.int64)
                    yield _rows(zero, digest.take(pa.array(text[same][first])), a[first], z[last], zero, zero, zero)
    return run


def _rows(n, text_id, start, windows, off, g, whole) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(n), text_id, *(pa.array(x.astype(np.int32)) for x in (start, windows, off)), pa.array(g), pa.array(whole)],
        names=["n", "text_id", "start", "windows", "off", "g", "whole"])


#: n: how often the run occurs in its chunk; 0 marks a range that repeats, from
#: ``start`` to ``windows``.
_RUN_ROW = "n long, text_id binary, start int, windows int, off int, g long, whole long"


def agreement(runs: list[bytes], off: list[int], block: list[int] | None, length: int) -> list[tuple[int, int] | None]:
    """Per run of one gram: how many bytes before and after its anchor agree
    with some other run, over ``length`` bytes together or more. ``block``: runs
    are only held against runs of the other block."""
    n = len(runs)
    after = [r[o:] for r, o in zip(runs, off)]
    before = [r[:o][::-1] for r, o in zip(runs, off)]
    if n == 2:
        r, le = deep_shallow(after)[1][1], deep_shallow(before)[1][1]
        return [(le, r)] * 2 if le + r >= length else [None] * 2
    right, right_lcp = deep_shallow(after)
    left, left_lcp = deep_shallow(before)
    rank_r, rank_l = np.empty(n, np.int64), np.empty(n, np.int64)
    rank_r[right], rank_l[left] = np.arange(n), np.arange(n)
    right_lcp, left_lcp = np.array(right_lcp), np.array(left_lcp)
    most = [(-1, -1)] * n
    best_l, best_r = np.full(n, -1), np.full(n, -1)
    # offsets at which the classes of equal prefixes or suffixes change
    steps = np.unique(np.concatenate(([0], left_lcp + 1, length - right_lcp, left_lcp, length - right_lcp - 1)))
    for a in steps[(steps >= 0) & (steps <= min(length, max(off)))]:
        x = np.cumsum(left_lcp < a)[rank_l]
        y = np.cumsum(right_lcp < length - a)[rank_r]
        fits = (np.array(off) >= a) & (np.array([len(s) for s in after]) >= length - a)
        key = x * (n + 2) + y
        key = np.where(fits, key, -1 - np.arange(n))            # too short for this window
        same = bw.repeated(key)
        if block is not None:
            _, k = np.unique(key, return_inverse=True)
            sides = np.bincount(k, weights=block) % np.bincount(k)
            same &= sides[k] > 0                                # both blocks hold it
        best_l[same] = np.maximum(best_l[same], a)
        best_r[same] = np.maximum(best_r[same], length - a)
    return [(int(le), int(r)) if le >= 0 else None for le, r in zip(best_l, best_r)]


def _sort_runs(length: int):
    """Streams rows ordered by task key; one group of a gram at a time."""
    def ranges(rows):
        group: dict[tuple, list] = {}
        for key, single, text_id, start, off, data, block in rows:
            group.setdefault(key, []).append((single, text_id, start, off, data, block))
        out = []
        for (_, i, j), g in group.items():
            if len(g) < 2:
                continue
            got = agreement([x[4] for x in g], [x[3] for x in g], None if i == j else [int(x[5] == j) for x in g], length)
            for (single, text_id, start, off, *_), m in zip(g, got):
                if m and single:
                    at = start + off
                    out.append((text_id, at - m[0], at + m[1]))
        return pa.RecordBatch.from_arrays(
            [pa.array([x[0] for x in out], pa.binary()), pa.array([x[1] for x in out], pa.int32()),
             pa.array([x[2] for x in out], pa.int32())], names=["text_id", "a", "z"])

    @bw.tidy
    def run(batches):
        held, size, last = [], 0, None
        for b in batches:
            g, i, j, block, single, text_id, start, off, data = (c.to_pylist() for c in b.columns)
            for row in zip(zip(g, i, j), single, text_id, start, off, data, block):
                if row[0] != last and size > FLUSH_BYTES:
                    yield ranges(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[5])
                last = row[0]
        if held:
            yield ranges(held)
    return run


def small(df: DataFrame, row_bytes: str) -> DataFrame:
    """``df`` marked for broadcast if its measured size is within the bound."""
    size = df.agg(F.sum(F.expr(row_bytes) + ROW_BYTES)).first()[0] or 0
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


def repeated_ranges(texts: DataFrame, length: int = LENGTH, gram: int = GRAM, block_runs: int = BLOCK_RUNS,
                    sift: bool = False, words: bool = False) -> DataFrame:
    """(text_id, ranges): per distinct text (md5) with repeated bytes, their
    merged byte ranges as start, end, start, end ... ``texts`` has a column
    ``text``. ``sift`` finds the repeated anchors first, in a pass of its own, and
    keeps runs of these only: less disk for more work. ``words`` searches the texts'
    word codes instead of their bytes; lengths and ranges are in bytes of codes then."""
    known = texts.sparkSession.sparkContext.broadcast(repeated_grams(texts, length, gram, words)) if sift else None
    rows = cut(small_batches(texts).mapInArrow(_runs(length, gram, known, words), _RUN_ROW))
    near = rows.where("n = 0").select("text_id", F.col("start").alias("a"), F.col("windows").alias("z"))
    kinds = cut(rows.where("n > 0").groupBy("g", "whole").agg(
        F.sum("n").alias("n"), F.min(F.struct("text_id", "start", "windows", "off")).alias("one")))
    twice = kinds.where("n > 1").select(F.col("g").alias("tg"), F.col("whole").alias("tw"))
    whole = (rows.where("n = 1").join(twice, (F.col("g") == F.col("tg")) & (F.col("whole") == F.col("tw")), "left_semi")
             .select("text_id", F.col("start").alias("a"), (F.col("start") + F.col("windows") - 1 + length).alias("z")))

    several = kinds.groupBy(F.col("g").alias("sg")).agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1")
    sent = cut(kinds.join(several, F.col("g") == F.col("sg"))
               .select("g", (F.col("n") == 1).alias("single"), "one.*", F.ceil(F.col("kinds") / block_runs).alias("blocks")))
    wanted = cut(sent.groupBy(F.col("text_id").alias("wanted")).agg(
        F.collect_list(F.struct("g", "single", "start", "windows", "off", "blocks")).alias("runs")))
    source = texts.select(F.unhex(F.md5("text")).alias("text_id"), "text").where(F.octet_length("text") >= (2 * (length // CODE_BYTES) - 1 if words else length))
    fetched = each_once(source, wanted).join(small(wanted, "16 + 32 * size(runs)"), F.col("text_id") == F.col("wanted"))
    fetched = fetched.mapInArrow(_fetch(length, words), "g long, single boolean, blocks long, text_id binary, start int, off int, data binary")
    block = F.pmod(F.xxhash64("text_id", "start"), F.col("blocks"))
    tasks = (fetched.withColumn("block", block)
             .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
             .select("g", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block",
                     "single", "text_id", "start", "off", "data")
             .repartition("g", "i", "j").sortWithinPartitions("g", "i", "j"))
    partly = tasks.mapInArrow(_sort_runs(length), "text_id binary, a int, z int")
    found = near.union(whole).union(partly).groupBy("text_id").agg(F.array_sort(F.collect_set(F.struct("a", "z"))).alias("found"))
    return found.mapInArrow(_merge_ranges, "text_id binary, ranges array<int>")


def each_once(source: DataFrame, wanted: DataFrame) -> DataFrame:
    """The wanted texts, each in one row however many hold it. Only texts that
    stand in several rows are aggregated, in the tasks first."""
    ids = wanted.select("wanted")
    copied = cut(source.select("text_id").join(small(ids, "16"), F.col("text_id") == F.col("wanted"), "left_semi")
                 .groupBy(F.col("text_id").alias("copied")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("copied"))
    marked = small(copied, "16")
    alone = source.join(marked, F.col("text_id") == F.col("copied"), "left_anti")
    first = source.join(marked, F.col("text_id") == F.col("copied"), "left_semi").groupBy("text_id").agg(F.first("text").alias("text"))
    return alone.union(first)


def _fetch(length: int, words: bool):
    """The bytes of the wanted runs."""
    @bw.tidy
    def run(batches):
        for b in batches:
            text_id, texts = b.column(0).to_pylist(), bw.blobs(b.column(1))
            texts = [x for lo, hi in bw.chunk_ranges(texts) for x in _view(texts[lo:hi], words)]
            out = [(r["g"], r["single"], r["blocks"], t, r["start"], r["off"], x[r["start"]:r["start"] + r["windows"] - 1 + length])
                   for t, x, runs in zip(text_id, texts, b.column(3).to_pylist()) for r in runs]
            cols = list(zip(*out)) if out else [()] * 7
            kinds = (pa.int64(), pa.bool_(), pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(cols, kinds)],
                                             names=["g", "single", "blocks", "text_id", "start", "off", "data"])
    return run


def _merge_ranges(batches):
    for b in batches:
        out = []
        for found in b.column(1).to_pylist():
            merged: list[int] = []
            for r in found:
                if merged and r["a"] <= merged[-1]:
                    merged[-1] = max(merged[-1], r["z"])
                else:
                    merged += [r["a"], r["z"]]
            out.append(merged)
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.list_(pa.int32()))], names=["text_id", "ranges"])


def word_codes(texts: list[bytes]) -> list[bytes]:
    c = bw.parse(texts, bw.SPACED, lower=False)
    code = c.word.view(np.uint8).reshape(-1, 8)[:, :CODE_BYTES]
    return [code[c.first[k]:c.first[k + 1]].tobytes() for k in range(c.n)]


def passage_counts(texts: DataFrame, passage_words: int = PASSAGE_WORDS, block_runs: int = BLOCK_RUNS) -> DataFrame:
    """(passage_id, n_passage_words): per distinct text (md5) the words inside
    passages of more than ``passage_words`` words that repeat."""
    gram = min(CODE_GRAM, passage_words // 2 + 1)
    found = repeated_ranges(texts, CODE_BYTES * (passage_words + 1), CODE_BYTES * gram, block_runs, sift=True, words=True)
    # ranges come as start, end, ...; words that lie in them as a whole count
    words = F.expr(f"""aggregate(transform(sequence(0, size(ranges) - 2, 2),
        k -> (ranges[k + 1] div {CODE_BYTES}) - ((ranges[k] + {CODE_BYTES - 1}) div {CODE_BYTES})),
        0L, (n, w) -> n + if(w > {passage_words}, w, 0L))""")
    return found.where(F.size("ranges") > 0).select(F.col("text_id").alias("passage_id"), words.alias("n_passage_words"))


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, block_runs: int = BLOCK_RUNS,
                   passage_words: int = PASSAGE_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, ``n_bytes``, ``ranges`` (removed byte ranges:
    start, end, ...), ``kept`` (the remaining bytes), ``n_passage_words`` (words
    inside repeated passages of more than ``passage_words`` words)."""
    src = docs.select(docs[id_col].alias("id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    found = cut(repeated_ranges(src.select("text"), length, gram, block_runs)).withColumnRenamed("text_id", "found_id")
    release(docs.sparkSession)
    passages = cut(passage_counts(src.select("text"), passage_words, block_runs))
    release(docs.sparkSession)

    # one table per text, so that the texts themselves are joined once
    marks = cut(found.join(passages, F.col("found_id") == F.col("passage_id"), "full")
                .select(F.coalesce("found_id", "passage_id").alias("marked_id"), "ranges", "n_passage_words"))
    kind = src.schema[0].dataType.simpleString()
    both = (src.withColumn("text_id", F.unhex(F.md5("text")))
            .join(small(marks, "28 + 4 * greatest(coalesce(size(ranges), 0), 0)"), F.col("text_id") == F.col("marked_id"), "left")
            .select("id", "text", "ranges", F.coalesce("n_passage_words", F.lit(0)).alias("n_passage_words")))

    @bw.tidy
    def run(batches):
        for b in batches:
            texts, ranges = bw.blobs(b.column(1)), b.column(2).to_pylist()
            kept = []
            for t, r in zip(texts, ranges):
                places = [0, *(r or ()), len(t)]
                kept.append(b"".join(t[a:z] for a, z in zip(places[0::2], places[1::2])))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(t) for t in texts], pa.int64()),
                 pa.array([r or [] for r in ranges], pa.list_(pa.int32())), pa.array(kept, pa.binary()), b.column(3)],
                names=[id_col, "n_bytes", "ranges", "kept", "n_passage_words"])

    return both.mapInArrow(run, f"`{id_col}` {kind}, n_bytes long, ranges array<int>, kept binary, n_passage_words long")
