"""N-gram Jaccard join: T-occurrence search over inverted lists (DivideSkip).

A document is the set of its word n-grams. Two documents link when their sets'
Jaccard similarity reaches a percentage. A set of size s can only link with sets
that hold at least T = ceil(s * percent) of its grams, so the question per
document is: which others occur T times or more on its s inverted lists?

DivideSkip sets the longest lists apart (T - l of them) and merges the rest:
whoever links must occur on l of the short lists at least. Lists are ordered by
length (counts of the corpus' frequent grams, then hash). The merge of the short
lists is a shuffle: postings are brought together by gram and the occurrences
of each pair are counted; lists of one document end there. What reaches l is
probed: the long lists' grams are looked up in the candidate's sorted set by
binary search, which gives the exact overlap.

Only components are asked for, so work inside large groups is spared without
losing links. Equal sets become one class first. Then each document is probed
against one centre only (of the lists' smallest documents the one that it shares
most lists with), and lists whose members are one component by then are done.
What is left goes two ways:

* lists of up to ``SHORT_LIST`` members: all pairs in different components that
  reach l occurrences and pass the screen are probed;
* longer lists (near copies, mostly): documents that share one form a group. A
  group is split into blocks of bounded size that are ranges of set sizes, each
  pair of blocks with sizes similar enough is one task that runs the search with
  the blocks' own inverted lists, and only links leave it. Pairs are never rows
  here, and a hot group is many tasks.

The screen is exact: a set's grams are counted in buckets by hash, about 8 grams each,
one byte a count. The sum of the smaller counts of two sets is an upper bound of
their overlap, at about a 64th of the bytes.

Pairs, of documents or of blocks, can grow faster than the input. What they send
through shuffles is measured first and goes in rounds that each send about as much as the
sets (or lists) themselves hold; shuffle files go between rounds and phases.

The broadcast is a table of the most frequent grams, at most ``FREQUENT`` of
them; it only orders the lists. Which grams are frequent is found in the tasks
from grams that repeat inside a task, over all documents.

Null, empty and wordless texts have an empty set and link with nothing; texts
with fewer than n words are one gram. Rows that repeat a doc_id are one node of
the link graph. Rows with a null doc_id take no part and have a null component.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from slotwise.llm import bytewords as bw
from slotwise.llm.graph import components, cut, most_frequent, release, small_batches

GRAM = 4
PERCENT = 85
OCCURRENCES = 3             # l: occurrences on short lists that a pair must reach
FREQUENT = 1 << 17          # grams in the broadcast table of list lengths
TASK_GRAMS = 1 << 20        # grams that a task counts at once
SHORT_LIST = 256            # members up to which a list's pairs become rows
BLOCK_GRAMS = 1 << 19       # grams of a block; a task holds two blocks
BROADCAST_IDS = 1 << 19     # documents to probe up to which their ids are broadcast
ROUND_GRAMS = 1 << 27       # grams that a round sends at least, if there are so many
ROUND_PAIRS = 16            # pairs that a round makes for each entry of the short lists
SIZE_BINS = 32              # bins of set sizes to a doubling
BUCKET_GRAMS = 8            # grams to a bucket of the screen, on average


def gram_sets(c: bw.Chunk, n: int, lengths: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(text, gram) of all texts' distinct grams, each text's in list order:
    shortest lists first."""
    h, at = c.ngrams(n)
    doc = c.doc[at] if len(at) else at
    words = np.diff(c.first)
    few = np.flatnonzero((words > 0) & (words < n))
    for size in np.unique(words[few]):
        t = few[words[few] == size]
        h = np.concatenate((h, bw.gram_hash(c.word, c.first[t], int(size))))
        doc = np.concatenate((doc, t))
    length = np.zeros(len(h), np.int64)
    i, k = bw.lookup(lengths[0], h)
    length[i] = lengths[1][k]
    order = np.lexsort((h, length, doc))
    h, doc = h[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    return doc[new], h[new]


def bucket_counts(doc: np.ndarray, h: np.ndarray, size: np.ndarray) -> pa.Array:
    """Per text: counts of its grams by leading bits of their hash, one byte each.
    If a count does not fit, all of the text's are 255, so that sums of smaller
    counts stay upper bounds."""
    bits = np.ceil(np.log2(np.maximum(size / BUCKET_GRAMS, 8))).astype(np.int64)
    start = np.concatenate(([0], np.cumsum(1 << bits)))
    at = start[doc] + (h >> (64 - bits[doc]).astype(np.uint64)).astype(np.int64)
    count = np.bincount(at, minlength=start[-1])
    over = np.searchsorted(start, np.flatnonzero(count > 255), side="right") - 1
    for k in np.unique(over):
        count[start[k]:start[k + 1]] = 255
    return pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(start.astype(np.int32)), pa.py_buffer(count.astype(np.uint8))])


NO_LENGTHS = (np.empty(0, np.uint64), np.empty(0, np.int64))


def frequent_grams(texts: DataFrame, n: int, size: int = FREQUENT) -> tuple[np.ndarray, np.ndarray]:
    """Hashes (sorted) and counts of the most frequent grams; counts leave out
    grams that are rare inside a task."""
    def report(kept):
        g, count = np.unique(np.concatenate(kept), return_counts=True)
        g, count = g[count > 1], count[count > 1]
        return pa.RecordBatch.from_arrays([pa.array(g.view(np.int64)), pa.array(count, pa.int64())], names=["g", "n"])

    @bw.tidy
    def run(batches):
        kept, held = [], 0
        for b in batches:
            for _, _, c in bw.chunks(b.column(0), bw.SPACED, lower=True):
                h, _ = c.ngrams(n)
                kept.append(h)
                held += len(h)
                if held >= TASK_GRAMS:
                    yield report(kept)
                    kept, held = [], 0
        if kept:
            yield report(kept)

    counts = cut(texts.mapInArrow(run, "g long, n long").groupBy("g").agg(F.sum("n").alias("n")))
    top = most_frequent(counts, size).toArrow()
    g = np.asarray(top.column("g").to_numpy(), np.int64).view(np.uint64)
    count = np.asarray(top.column("n").to_numpy(), np.int64)
    order = np.argsort(g)
    return g[order], count[order]


def _short_lists(lengths, n: int, percent: int, occurrences: int):
    """Per document: set size, fingerprints of the set, grams of its short lists,
    counts for the screen."""
    @bw.tidy
    def run(batches):
        for b in batches:
            for lo, hi, c in bw.chunks(b.column(1), bw.SPACED, lower=True):
                doc, h = gram_sets(c, n, lengths.value)
                size = np.bincount(doc, minlength=hi - lo)
                first = np.concatenate(([0], np.cumsum(size)))
                need = -(-percent * size // 100)
                short = size - need + np.minimum(need, occurrences)
                keep = np.arange(len(h)) - first[doc] < short[doc]
                prints = []
                for v in (h, bw.mix(h)):
                    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(v, dtype=np.uint64)))
                    prints.append(pa.array((total[first[1:]] - total[first[:-1]]).view(np.int64)))
                offsets = np.concatenate(([0], np.cumsum(short))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo), pa.array(size, pa.int64()), *prints,
                     pa.ListArray.from_arrays(pa.array(offsets), pa.array(h[keep].view(np.int64))), bucket_counts(doc, h, size)],
                    names=["id", "size", "f1", "f2", "short", "counts"])
    return run


def _sets(n: int):
    @bw.tidy
    def run(batches):
        for b in batches:
            for lo, hi, c in bw.chunks(b.column(1), bw.SPACED, lower=True):
                doc, h = gram_sets(c, n, NO_LENGTHS)
                first = np.searchsorted(doc, np.arange(hi - lo + 1))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo),
                     pa.array([h[first[k]:first[k + 1]].tobytes() for k in range(hi - lo)], pa.binary())],
                    names=["id", "grams"])
    return run


def _probe(percent: int):
    """Keeps the pairs whose exact overlap suffices."""
    @bw.tidy
    def run(batches):
        for b in batches:
            ok = []
            for x, y in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                both = int((y[at] == x).sum())
                ok.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["a", "b"]).filter(pa.array(ok, pa.bool_()))
    return run


def _screen(percent: int):
    """Keeps the pairs whose overlap can suffice by their bucket counts."""
    @bw.tidy
    def run(batches):
        for b in batches:
            ok = []
            for sx, sy, x, y in zip(*(b.column(c).to_pylist() for c in range(2, 6))):
                x, y = (np.frombuffer(v, np.uint8).astype(np.int64) for v in (x, y))
                least = min(len(x), len(y))
                both = int(np.minimum(x.reshape(least, -1).sum(axis=1), y.reshape(least, -1).sum(axis=1)).sum())
                ok.append(100 * both >= percent * (sx + sy - both))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["a", "b"]).filter(pa.array(ok, pa.bool_()))
    return run


def screened(pairs: DataFrame, counts: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that ``counts`` (id, size, counts) do not rule out."""
    both = pairs.join(counts.toDF("a", "sx", "x"), "a").join(counts.toDF("b", "sy", "y"), "b")
    return both.select("a", "b", "sx", "sy", "x", "y").mapInArrow(_screen(percent), "a long, b long")


def sets_of(ids: DataFrame, texts: DataFrame, n: int) -> DataFrame:
    """(id, grams) of the wanted documents (column ``need``)."""
    return texts.join(_sized(ids), texts.id == F.col("need"), "left_semi").mapInArrow(_sets(n), "id long, grams binary")


def rounds(sent: int | None, held: int | None, least: int) -> int:
    """Rounds of at most about ``held`` or ``least`` each for ``sent``."""
    return max(1, -(-(sent or 0) // max(held or 0, least)))


def in_rounds(spark, parts) -> DataFrame:
    """The union of ``parts``, made one after the other; a part's shuffle files
    go when it is written."""
    done = []
    for part in parts:
        if done:
            release(spark)
        done.append(cut(part))
        del part
    return functools.reduce(DataFrame.union, done)


def probe(pairs: DataFrame, texts: DataFrame, n: int, percent: int, round_grams: int = ROUND_GRAMS) -> DataFrame:
    """The pairs (a, b) that link. Only texts of documents in a pair are read
    into sets; each pair brings its two sets together."""
    pairs = cut(pairs)
    need = cut(pairs.select(F.col("a").alias("need")).union(pairs.select("b")).distinct())
    sets = cut(sets_of(need, texts, n))
    if need.count() > BROADCAST_IDS:        # all texts went through a shuffle
        release(texts.sparkSession)
    sizes = sets.select(F.col("id").alias("a"), (F.octet_length("grams") / 8).cast("long").alias("grams"))
    held = sizes.agg(F.sum("grams")).first()[0]
    sent = pairs.join(sizes, "a").agg(F.sum("grams")).first()[0]
    n_rounds = rounds(sent, held, round_grams)

    def part(k):
        own = pairs.where(F.pmod(F.xxhash64("a", "b"), F.lit(n_rounds)) == k)
        left = own.join(sets.toDF("a", "x"), "a")
        return left.join(sets.toDF("b", "y"), "b").select("a", "b", "x", "y").mapInArrow(_probe(percent), "a long, b long")

    return in_rounds(texts.sparkSession, map(part, range(n_rounds)))


def _similar_size(a: str, b: str, percent: int):
    return f"100 * least({a}, {b}) >= {percent} * greatest({a}, {b})"


def centre_pairs(lists: DataFrame, seed: int, percent: int) -> DataFrame:
    """One pair per document at most: with the centre it shares most lists with."""
    centre = lists.groupBy(F.col("g").alias("cg")).agg(
        F.min_by(F.struct("id", "size"), F.xxhash64("id", F.lit(seed))).alias("c"))
    votes = (lists.join(centre, F.col("g") == F.col("cg")).where("id <> c.id")
             .where(_similar_size("size", "c.size", percent))
             .groupBy("id", F.col("c.id").alias("c")).agg(F.count(F.lit(1)).alias("n")))
    best = votes.groupBy("id").agg(F.max(F.struct("n", "c")).alias("best"))
    return best.where("best.n >= 2").select(F.col("best.c").alias("a"), F.col("id").alias("b"))


def labelled(lists: DataFrame, links: DataFrame) -> DataFrame:
    """``lists`` with each document's component."""
    comp = components(links)
    got = lists.join(comp.withColumnRenamed("component", "found"), F.col("id") == F.col("node"), "left")
    return got.select("g", "id", "size", F.coalesce("found", "id").alias("comp"))


def open_pairs(lists: DataFrame, counts: DataFrame, percent: int, occurrences: int, round_pairs: int = ROUND_PAIRS) -> DataFrame:
    """All pairs on short lists (with their ``members``) that are in different
    components, occur together often enough and pass the screen. A round makes the pairs of a part
    of the documents with all others."""
    entries, pairs = lists.agg(F.count(F.lit(1)), F.sum((F.col("members") - 1) / 2)).first()
    n_rounds = rounds(int(pairs or 0), entries * round_pairs, 1)
    x = lists.select("g", F.col("id").alias("a"), F.col("size").alias("sa"), F.col("comp").alias("ca"))
    y = lists.select("g", F.col("id").alias("b"), F.col("size").alias("sb"), F.col("comp").alias("cb"))
    need = F.least(F.lit(occurrences), F.ceil(F.least("sa", "sb") * percent / 100))

    def part(k):
        own = x.where(F.pmod(F.xxhash64("a"), F.lit(n_rounds)) == k)
        both = own.join(y, "g").where("a < b and ca <> cb").where(_similar_size("sa", "sb", percent))
        counted = both.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"), F.first(need).alias("need"))
        return screened(counted.where("n >= need").select("a", "b"), counts, percent)

    return in_rounds(lists.sparkSession, map(part, range(n_rounds)))


def in_blocks(member: DataFrame, block_grams: int) -> DataFrame:
    """``member`` with a ``block``: ranges of set sizes of about ``block_grams``
    each, inside a group. Sizes that fill several blocks are dealt by hash."""
    sized = member.withColumn("bin", F.floor(F.log2("size") * SIZE_BINS))
    bins = sized.groupBy(F.col("group").alias("g"), F.col("bin").alias("b")).agg(F.sum("size").alias("fill"))
    up_to = Window.partitionBy("g").orderBy("b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    bins = cut(bins.withColumn("end", F.sum("fill").over(up_to)))       # a few hundred rows a group at most
    place = F.pmod(F.xxhash64("id"), F.lit(1 << 20)) / (1 << 20)
    return (sized.join(_sized(bins, 4), (F.col("group") == F.col("g")) & (F.col("bin") == F.col("b")))
            .withColumn("block", F.floor((F.col("end") - F.col("fill") * (1 - place)) / block_grams))
            .select("group", "block", "id", "size", "comp"))


def block_pairs(placed: DataFrame, percent: int) -> DataFrame:
    """(group, i, j, sent): pairs of blocks, also of one with itself, that hold
    documents of similar size; ``sent`` are their grams."""
    blocks = cut(placed.groupBy("group", "block").agg(F.sum("size").alias("grams"), F.min("size").alias("lo"), F.max("size").alias("hi")))
    x = blocks.toDF("group", "i", "gi", "lo_i", "hi_i")
    y = blocks.toDF("group", "j", "gj", "lo_j", "hi_j")
    near = f"i <= j and 100 * hi_i >= {percent} * lo_j and 100 * hi_j >= {percent} * lo_i"
    return cut(x.join(y, "group").where(near).select("group", "i", "j", F.expr("if(i = j, gi, gi + gj)").alias("sent")))


def group_links(lists: DataFrame, texts: DataFrame, n: int, percent: int, occurrences: int,
                block_grams: int = BLOCK_GRAMS, round_grams: int = ROUND_GRAMS) -> DataFrame:
    """Links between different components on long lists, by blocks."""
    stars = lists.join(lists.groupBy(F.col("g").alias("sg")).agg(F.min("id").alias("star")), F.col("g") == F.col("sg"))
    group = components(stars.select(F.col("star").alias("a"), F.col("id").alias("b")).distinct())
    docs = lists.select("id", "size", "comp").distinct()
    member = docs.join(group, F.col("id") == F.col("node")).select("id", "size", "comp", F.col("component").alias("group"))
    placed = cut(in_blocks(cut(member), block_grams))
    pairs = block_pairs(placed, percent)
    held = placed.agg(F.sum("size")).first()[0]
    sent = pairs.agg(F.sum("sent")).first()[0]
    n_rounds = rounds(sent, held, round_grams)
    sets = sets_of(cut(placed.select(F.col("id").alias("need"))), texts, n)
    sets = cut(placed.join(sets.withColumnRenamed("id", "sid"), F.col("id") == F.col("sid")).select("group", "block", "id", "comp", "grams"))
    if n_rounds > 1 or placed.count() > BROADCAST_IDS:
        release(texts.sparkSession)

    def part(k):
        own = pairs.where(F.pmod(F.xxhash64("group", "i", "j"), F.lit(n_rounds)) == k).select("group", "i", "j")
        sides = own.withColumn("block", F.col("i")).union(own.where("i < j").withColumn("block", F.col("j")))
        tasks = sets.join(_sized(sides, 4), ["group", "block"]).select("group", "i", "j", "block", "id", "comp", "grams")
        return tasks.groupBy("group", "i", "j").applyInArrow(_divide_skip(percent, occurrences), "a long, b long")

    return in_rounds(texts.sparkSession, map(part, range(n_rounds)))


def _divide_skip(percent: int, occurrences: int):
    """T-occurrence search between two blocks (or inside one)."""
    def run(t: pa.Table) -> pa.Table:
        i, j = t.column("i")[0].as_py(), t.column("j")[0].as_py()
        ids, comp, block = (t.column(c).to_numpy() for c in ("id", "comp", "block"))
        sets = [np.frombuffer(x, np.uint64) for x in t.column("grams").to_pylist()]
        a, b = search(sets, comp.copy(), block, i == j, percent, occurrences)
        return pa.table({"a": pa.array(ids[a], pa.int64()), "b": pa.array(ids[b], pa.int64())})
    return run


def search(sets, comp, block, inside: bool, percent: int, occurrences: int) -> tuple[list[int], list[int]]:
    """Links that join components: (query, found) places. ``comp`` is updated;
    pairs already in one component are passed over."""
    size = np.array([len(x) for x in sets])
    owner = np.repeat(np.arange(len(sets)), size)
    names, gram = np.unique(np.concatenate(sets), return_inverse=True)
    order = np.argsort(gram, kind="stable")
    posting = owner[order]                                  # documents per gram, ascending
    head = np.concatenate(([0], np.cumsum(np.bincount(gram, minlength=len(names)))))
    length = np.diff(head)
    begin = np.concatenate(([0], np.cumsum(size)))
    a, b = [], []
    for q in range(len(sets)):
        lists = gram[begin[q]:begin[q + 1]]
        lists = lists[np.argsort(length[lists], kind="stable")]
        need = -(-percent * size[q] // 100)
        least = min(need, occurrences)
        short, long = lists[:size[q] - need + least], lists[size[q] - need + least:]
        seen = np.bincount(np.concatenate([posting[head[g]:head[g + 1]] for g in short]), minlength=len(sets))
        ok = (seen > 0) & (comp != comp[q]) & (100 * np.minimum(size, size[q]) >= percent * np.maximum(size, size[q]))
        ok &= np.arange(len(sets)) > q if inside else block != block[q]
        ok &= seen >= np.minimum(least, -(-percent * size // 100))
        found = np.flatnonzero(ok)
        if not len(found):
            continue
        total = seen[found]
        if len(long) <= len(found):
            for g in long:                                  # candidates looked up in the long list
                p = posting[head[g]:head[g + 1]]
                total += p[np.minimum(np.searchsorted(p, found), len(p) - 1)] == found
        else:
            wanted = np.sort(long)
            for k, d in enumerate(found):                   # the long lists' grams looked up in the candidate
                own = gram[begin[d]:begin[d + 1]]
                at = np.minimum(np.searchsorted(own, wanted), len(own) - 1)
                total[k] += (own[at] == wanted).sum()
        for d in found[100 * total >= percent * (size[found] + size[q] - total)]:
            if comp[d] != comp[q]:
                a.append(q)
                b.append(int(d))
                comp[comp == comp[d]] = comp[q]
    return a, b


def jaccard_components(docs: DataFrame, percent: int = PERCENT, n: int = GRAM, id_col: str = "doc_id",
                       text_col: str = "text", occurrences: int = OCCURRENCES, short_list: int = SHORT_LIST,
                       block_grams: int = BLOCK_GRAMS, round_grams: int = ROUND_GRAMS, round_pairs: int = ROUND_PAIRS) -> DataFrame:
    """One row per input row: id, ``n_shingles`` (set size), ``component_id``
    (smallest id that links reach, itself included). Ids are integers."""
    texts = small_batches(docs).select(docs[id_col].cast("long").alias("id"), docs[text_col].alias("text"))
    spark = texts.sparkSession
    lengths = spark.sparkContext.broadcast(frequent_grams(texts.select("text"), n))
    rows = cut(texts.mapInArrow(_short_lists(lengths, n, percent, occurrences),
                                "id long, size long, f1 long, f2 long, short array<long>, counts binary"))
    key = ["size", "f1", "f2"]
    classes = cut(rows.where("size > 0 and id is not null").groupBy(*key)
                  .agg(F.min("id").alias("rep"), F.first("short").alias("short"), F.first("counts").alias("counts")))
    counts = cut(classes.select("rep", "size", "counts"))
    # written first, so that both sides of the join are plain shuffles and Spark can split a class of many copies
    reps = cut(classes.select(*[F.col(k).alias(f"c_{k}") for k in key], "rep"))
    rep = cut(rows.select("id", *key).join(reps, [F.col(k) == F.col(f"c_{k}") for k in key], "left").select("id", "size", "rep"))
    del rows, reps
    postings = classes.select(F.explode("short").alias("g"), F.col("rep").alias("id"), "size")
    shared = postings.groupBy(F.col("g").alias("sg")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("sg")
    lists = cut(postings.join(shared, F.col("g") == F.col("sg"), "left_semi"))
    del classes, postings, shared
    release(spark)

    # a doc_id with several texts joins their classes
    several = rep.groupBy(F.col("id").alias("sid")).agg(F.min("rep").alias("a"), F.max("rep").alias("z")).where("a < z")
    links = rep.join(several, F.col("id") == F.col("sid")).select("a", F.col("rep").alias("b"))

    near_centre = screened(centre_pairs(lists, 0, percent), counts, percent)
    links = cut(links.union(probe(near_centre, texts, n, percent, round_grams)))
    del near_centre
    release(spark)
    current = labelled(lists, links)
    mixed = (current.groupBy(F.col("g").alias("mg"))
             .agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count(F.lit(1)).alias("members")).where("lo < hi"))
    current = cut(current.join(mixed.select("mg", "members"), F.col("g") == F.col("mg")).drop("mg"))
    del lists, mixed
    by_pairs = open_pairs(current.where(F.col("members") <= short_list), counts, percent, occurrences, round_pairs)
    by_pairs = probe(by_pairs, texts, n, percent, round_grams)
    release(spark)
    by_groups = group_links(current.where(F.col("members") > short_list), texts, n, percent, occurrences, block_grams, round_grams)
    del current
    links = cut(links.union(by_pairs).union(by_groups))
    del by_pairs, by_groups, counts
    comp = components(links)
    out = rep.join(comp, F.col("rep") == F.col("node"), "left")
    return out.select(F.col("id").alias(id_col), F.col("size").alias("n_shingles"),
                      F.coalesce("component", "rep", "id").alias("component_id"))


def one_per_group(docs: DataFrame, percent: int = PERCENT, n: int = GRAM, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """One row of each group of near duplicates, with all columns: the smallest
    id's (then the smallest text digest's). Texts are told apart, not ids: rows
    that repeat an id with different texts are judged text by text, and only
    equal rows (id and text) or near duplicates collapse. Rows with a null id all
    stay. Columns may have any names."""
    fresh = unused(docs.columns)
    node, digest = fresh("node"), fresh("digest")
    keyed = docs.withColumn(digest, F.coalesce(F.md5(F.col(f"`{text_col}`")), F.lit("")))
    ids = keyed.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(digest).alias("digest")).where("id is not null")
    twice = ids.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("id").alias("twice"))
    least = ids.agg(F.min("id")).first()[0] or 0
    # texts under a repeated id get numbers of their own, below all ids
    own = cut(ids.join(_sized(cut(twice)), F.col("id") == F.col("twice"), "left_semi").distinct()
              .select(F.col("id").alias("own_id"), F.col("digest").alias("own_digest"),
                      (F.lit(least - 1) - F.monotonically_increasing_id()).alias("own_node")))
    of_id, of_digest, of_node, off = (fresh(x) for x in ("of_id", "of_digest", "of_node", "off"))
    marked = (keyed.join(_sized(own.toDF(of_id, of_digest, of_node)),
                         (F.col(f"`{id_col}`").cast("long") == F.col(of_id)) & (F.col(digest) == F.col(of_digest)), "left")
              .withColumn(node, F.coalesce(of_node, F.col(f"`{id_col}`").cast("long")))
              .select(*[F.col(f"`{c}`") for c in docs.columns], node, F.col(of_node).isNotNull().alias(digest)))
    found = jaccard_components(marked.select(F.col(node).alias("node"), F.col(f"`{text_col}`").alias("text")), percent, n, "node", "text")
    found = cut(found.where("node is not null").select("node", "component_id").distinct())
    groups = found.groupBy(F.col("component_id").alias("group")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("group")
    member = cut(found.join(groups, F.col("component_id") == F.col("group")).join(own, F.col("node") == F.col("own_node"), "left")
                 .select("node", "group", F.struct(F.coalesce("own_id", "node").alias("id"), F.coalesce("own_digest", F.lit("")).alias("d")).alias("rank")))
    first = member.groupBy(F.col("group").alias("of")).agg(F.min_by("node", "rank").alias("first"))
    gone = cut(member.join(first, F.col("group") == F.col("of")).where("node <> first").select(F.col("node").alias(off)))
    rest = marked.join(_sized(gone), F.col(node) == F.col(off), "left_anti")
    once = rest.where(F.col(digest)).dropDuplicates([node])
    return rest.where(~F.col(digest)).unionByName(once).drop(node, digest)


def unused(columns):
    """A maker of column names that are not among ``columns``."""
    taken = {c.lower() for c in columns}

    def fresh(name: str) -> str:
        while name in taken:
            name = "_" + name
        taken.add(name)
        return name
    return fresh


def _sized(ids: DataFrame, columns: int = 1) -> DataFrame:
    """A table of ids, marked for broadcast if its count is within the bound."""
    return F.broadcast(ids) if ids.count() * columns <= BROADCAST_IDS else ids
