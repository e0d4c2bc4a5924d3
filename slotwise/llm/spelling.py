"""Spelling variant grouping: words one edit apart, by sorted-list dynamic
programming.

A word is near another if they differ by exactly one inserted, deleted or
replaced code point. Each word's form is its near word with the largest count
(ties: smallest in code-point order), if that is ``ratio`` times its own count
or more; its root is where the chain of forms ends.

1. One edit leaves the first or the last half of the shorter word as it is.
   Words of m and of m + 1 code points that share their first m // 2 code points
   (or last, then they are read backwards) make a group; each near pair is in one
   at least. Groups are keys of a shuffle; one of more than ``BLOCK_WORDS`` words
   is split into blocks, and each pair of blocks is one task key, so no task
   holds more than two blocks of a group.
2. In a task the groups' words are one sorted list. Its longest common prefixes
   cut it, depth by depth, into ranges that share a prefix. Every query goes
   through the ranges with the edit matrix' band of three cells: a range's row is
   made once from the row of the range around it and holds for all its words,
   and a range whose cells all exceed one edit is skipped with all its words.
   All queries of a task take each step together, in numpy.
3. Per task each word's near words are reduced to their number and the best one,
   then summed by shuffle. Counts at least double along a chain of forms, so the
   chains are short; pointer jumping by joins follows them.

A pair that shares both halves is found in the first half's group only. Null
texts and texts without letters have no words; repeated rows count again; an
empty table gives an empty result. Other columns are never read. Words may be of
any length (the operator makes no use of their bytes beyond U+0000, which ends a
word in the matrix and cannot be part of one).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotwise.llm import bytewords as bw
from slotwise.llm.graph import cut

# Letters of a word, and A-Z folded to a-z.
LETTERS = "[a-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

MIN_LENGTH = 5
MIN_COUNT = 3
RATIO = 2
BLOCK_WORDS = 1 << 14       # words of a group's block; a task key holds two blocks
FLUSH_ROWS = 1 << 15        # words that a task gathers before it scans them
FLUSH_CHARS = 1 << 20       # and their code points
STATES = 1 << 18            # (query, range) states that a step starts from


def runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH) -> DataFrame:
    """(id, run): every maximal run of letters with ``min_length`` code points
    or more, A-Z folded; one row per occurrence."""
    text = F.translate(docs[text_col], UPPER, LOWER)
    found = docs.select(docs[id_col].alias("id"), F.explode(F.regexp_extract_all(text, F.lit(LETTERS), F.lit(0))).alias("run"))
    return found.where(F.char_length("run") >= min_length)


def without_one(run: Column, place: Column) -> Column:
    """``run`` without its code point at ``place`` (from 0)."""
    return F.concat(F.substring(run, F.lit(1), place), F.substring(run, place + 2, F.char_length(run)))


def count_words(words: DataFrame, col: str = "word", min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of the words with the given length and number of occurrences."""
    return (words.where(F.char_length(col) >= min_length).groupBy(F.col(col).alias("word"))
            .agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count))


def grouped(counts: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per word, group and task key: m, rev (read backwards), prefix, i,
    j, w (the word as read), n, query and member (its parts in the task)."""
    size = F.char_length("word")
    shortest = counts.agg(F.min(size)).first()[0]
    roles = F.array(*[F.struct((size - less).cast("int").alias("m"), F.lit(rev).alias("rev")) for less in (0, 1) for rev in (False, True)])
    rows = (counts.select("word", "n", F.explode(roles).alias("r")).select("word", "n", "r.*")
            .where(F.col("m") >= (shortest or 1))
            .withColumn("w", F.when(F.col("rev"), F.reverse("word")).otherwise(F.col("word")))
            .withColumn("prefix", F.substring("w", F.lit(1), (F.col("m") / 2).cast("int")))
            .select("m", "rev", "prefix", "w", "n"))
    key = ["m", "rev", "prefix"]
    groups = rows.groupBy(*[F.col(k).alias(f"g_{k}") for k in key]).agg(F.count(F.lit(1)).alias("words"))
    split = cut(groups.where(F.col("words") > block_words).withColumn("blocks", F.ceil(F.col("words") / block_words).cast("int")))
    rows = rows.join(split, [F.col(k) == F.col(f"g_{k}") for k in key], "left")
    query = F.char_length("w") == F.col("m")
    block = F.pmod(F.xxhash64("w"), F.col("blocks")).cast("int")
    every = F.sequence(F.lit(0), F.col("blocks") - 1)

    def at(i, j, q, m):
        return F.struct(i.alias("i"), j.alias("j"), q.alias("query"), m.alias("member"))

    one = F.array(at(F.lit(0), F.lit(0), query, F.lit(True)))
    as_member = F.transform(every, lambda o: at(o, block, F.lit(False), F.lit(True)))
    as_query = F.transform(every, lambda o: at(block, o, F.lit(True), F.lit(False)))
    places = F.when(F.col("blocks").isNull(), one).when(query, F.concat(as_query, as_member)).otherwise(as_member)
    return rows.select("m", "rev", "prefix", "w", "n", F.explode(places).alias("p")).select("m", "rev", "prefix", "w", "n", "p.*")


def matrix(words: list[str], width: int) -> np.ndarray:
    """Code points, one row per word, zeros behind its end."""
    text = "".join(w.ljust(width, "\0") for w in words)
    return np.frombuffer(text.encode("utf-32-le"), np.uint32).reshape(len(words), width)


def common_prefix(x: np.ndarray) -> np.ndarray:
    """Code points that each row shares with the row before (0 for the first)."""
    differ = x[1:] != x[:-1]
    return np.concatenate(([0], np.where(differ.any(axis=1), differ.argmax(axis=1), x.shape[1]))).astype(np.int64)


def near_pairs(x: np.ndarray, m: int, query: np.ndarray, member: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row of a query, row of a member): all pairs one edit apart that share
    m // 2 code points. Rows of ``x`` are sorted words of m or m + 1 code
    points; queries have m."""
    depth = m // 2
    edge = np.append(np.flatnonzero(common_prefix(x) < depth), len(x))
    if not len(edge) or edge[0] != 0:
        edge = np.concatenate(([0], edge))
    group = np.searchsorted(edge, np.arange(len(x)), side="right") - 1
    before = np.concatenate(([0], np.cumsum(member)))
    rows = np.flatnonzero(member)
    y = x[rows]
    lcp = common_prefix(y) if len(y) else np.empty(0, np.int64)
    q = np.flatnonzero(query)
    lo, hi = before[edge[group[q]]], before[edge[group[q] + 1]]
    other = hi - lo > member[q]                     # someone else is in the group
    q, lo, hi = q[other], lo[other], hi[other]
    found_q, found_r = [], []
    begin = 0
    while begin < len(q):                           # slices of queries bound a step's states
        end = begin + max(1, int(np.searchsorted(np.cumsum(np.minimum(hi[begin:] - lo[begin:], 64)), STATES)))
        a, b = _scan(x, y, lcp, m, depth, q[begin:end], lo[begin:end], hi[begin:end])
        found_q.append(a)
        found_r.append(rows[b])
        begin = end
    if not found_q:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(found_q), np.concatenate(found_r)


def _scan(x, y, lcp, m, depth, q, lo, hi) -> tuple[np.ndarray, np.ndarray]:
    """Queries ``q`` (rows of x) through the ranges lo..hi of the sorted y.
    before, on, after: the band's cells, edits between the range's prefix of d
    code points and the query's first d - 1, d and d + 1."""
    before, on, after = np.ones(len(q), np.int8), np.zeros(len(q), np.int8), np.ones(len(q), np.int8)
    out_q, out_r = [], []
    for d in range(depth, m + 1):
        heads = np.flatnonzero(lcp <= d)                                    # ranges of d + 1 common code points
        first, last = np.searchsorted(heads, lo), np.searchsorted(heads, hi)
        count = last - first
        k = np.repeat(np.arange(len(q)), count)
        child = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first, count)
        q, before, on, after = q[k], before[k], on[k], after[k]
        lo, hi = heads[child], np.append(heads, len(y))[child + 1]
        c = y[lo, d]
        if d == m:                                                          # words of m end here, others have one more
            ends = c == 0
            last_cell = np.where(ends, on, np.minimum(before + (x[q, m - 1] != c), on + 1))
            hit = last_cell == 1
            out_q.append(q[hit])
            out_r.append(lo[hit])
            break
        before = np.minimum(before + (x[q, d - 1] != c), on + 1)
        on = np.minimum(np.minimum(on + (x[q, d] != c), after + 1), before + 1)
        after = np.minimum(after + (x[q, d + 1] != c), on + 1) if d + 2 <= m else np.full(len(q), 9, np.int8)
        keep = np.minimum(np.minimum(before, on), after) <= 1
        q, lo, hi, before, on, after = (v[keep] for v in (q, lo, hi, before, on, after))
        before, on, after = (np.minimum(v, 2).astype(np.int8) for v in (before, on, after))
    return np.concatenate(out_q), np.concatenate(out_r)


def _shares_other_end(x: np.ndarray, m: int, q: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Whether the pairs' last m // 2 code points agree as well."""
    h = m // 2
    end = m + (x[r, m] != 0)
    back = np.arange(1, h + 1)
    return (x[q[:, None], m - back] == x[r[:, None], end[:, None] - back]).all(axis=1)


def _reduce(words: list[str], n: np.ndarray, m: int, rev: bool, query: np.ndarray, member: np.ndarray) -> pa.RecordBatch:
    """The near words of one sorted list: per word their number and the best."""
    x = matrix(words, m + 1)
    q, r = near_pairs(x, m, query, member)
    if rev:
        new = ~_shares_other_end(x, m, q, r)
        q, r = q[new], r[new]
    longer = x[r, m] != 0                           # words of m are queries themselves
    word, near = np.concatenate((q, r[longer])), np.concatenate((r, q[longer]))
    if rev:
        named = [w[::-1] for w in words]
        place = np.empty(len(words), np.int64)
        place[sorted(range(len(words)), key=named.__getitem__)] = np.arange(len(words))
    else:
        named, place = words, np.arange(len(words))
    order = np.lexsort((place[near], -n[near], word))
    word, near = word[order], near[order]
    first = np.flatnonzero(np.append(True, word[1:] != word[:-1])) if len(word) else np.empty(0, np.int64)
    count = np.diff(np.append(first, len(word)))
    return pa.RecordBatch.from_arrays(
        [pa.array([named[k] for k in word[first]], pa.string()), pa.array(count, pa.int64()),
         pa.array(n[near[first]], pa.int64()), pa.array([named[k] for k in near[first]], pa.string())],
        names=["word", "n_near", "best_n", "best"])


def _scan_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by m, rev, i, j, w. Lists of one (m, rev, i, j) are
    scanned together, cut between groups."""
    held: list[tuple] = []
    chars, last = 0, None

    def flush():
        words, n, query, member = zip(*((h[5], h[6], h[7], h[8]) for h in held))
        m, rev = held[0][0], held[0][1]
        return _reduce(list(words), np.array(n), m, rev, np.array(query), np.array(member))

    for b in batches:
        for row in zip(*(b.column(c).to_pylist() for c in ("m", "rev", "i", "j", "prefix", "w", "n", "query", "member"))):
            group = row[:5]
            if held and group != last and (group[:4] != last[:4] or len(held) >= FLUSH_ROWS or chars >= FLUSH_CHARS):
                if len(held) > 1:
                    yield flush()
                held, chars = [], 0
            held.append(row)
            chars += len(row[5])
            last = group
    if len(held) > 1:
        yield flush()


def near_words(counts: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(word, n_near, best_n, best) of every word with a near word."""
    rows = grouped(counts, block_words)
    rows = rows.repartition("m", "rev", "prefix", "i", "j").sortWithinPartitions("m", "rev", "i", "j", "w")
    found = rows.mapInArrow(bw.tidy(_scan_lists), "word string, n_near long, best_n long, best string")
    best = found.groupBy("word").agg(F.sum("n_near").alias("n_near"),
                                     F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("w"))).alias("b"))
    return best.select("word", "n_near", (-F.col("b.n")).alias("best_n"), F.col("b.w").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for the words of ``forms`` (word, form): chains followed to
    their end by pointer jumping."""
    at = cut(forms.select("word", F.col("form").alias("root")))
    while True:
        above = at.select(F.col("word").alias("from"), F.col("root").alias("to"))
        step = cut(at.join(above, at.root == above["from"], "left").select("word", F.coalesce("to", "root").alias("root"), "to"))
        at = step.select("word", "root")
        if step.where("to IS NOT NULL").isEmpty():
            return at


def variants(counts: DataFrame, ratio: int = RATIO, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per word of ``counts`` (word, n; distinct words of two code
    points or more): word, form, root, n, n_near, form_n."""
    counts = cut(counts.select("word", "n"))
    best = near_words(counts, block_words).withColumnRenamed("word", "of")
    fits = F.col("best_n") >= ratio * F.col("n")
    known = cut(counts.join(best, F.col("word") == F.col("of"), "left").select(
        "word", F.when(fits, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(fits, F.col("best_n")).alias("form_n")))
    ends = roots(known.where("form IS NOT NULL")).withColumnRenamed("word", "of")
    return known.join(ends, F.col("word") == F.col("of"), "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
