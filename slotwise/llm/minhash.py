"""MinHash near-dedup by fast similarity sketching, banding and exact verification.

A document is the set of its word n-grams; two link when their sets' Jaccard
similarity reaches a percentage.

Sketch: ``bins`` coordinates filled in rounds. In round i < bins every gram is
hashed to one bin, with the value (i, hash); in round bins + k every gram goes to
bin k, so after 2 * bins rounds no coordinate of a non-empty set is empty. A bin
keeps its smallest value, so earlier rounds win, and a set stops at the first
round after which all its bins are filled: large sets take one or two passes over
their grams, not one per coordinate. The share of equal coordinates estimates the
similarity with the concentration of independent samples or better.

Banding: coordinates are cut into bands of ``rows``; documents that agree in
``SHARED`` bands or more are candidates. With 160 bins, bands of 4 and similarity
0.85, a pair misses that with probability 7e-12; a lower ``percent`` takes shorter
bands (see ``band_rows``). Every candidate pair is decided on the whole sets.

Only components are asked for, so work inside large groups is spared without
losing links:

1. Equal sets become one class, kept by its smallest id.
2. Per round, each document is verified against one centre: of its bands' centres
   (one random member each) the one it shares most bands with. Links join
   components; bands whose members are one component by then are done.
3. Bands of up to ``PAIR_MEMBERS`` members: the pairs in different components
   are counted and verified.
4. Larger bands: their members form groups, a group is split into blocks of
   bounded size, and each pair of blocks is one task that looks for candidates by
   the bands and by whole sketches (see ``agreement_floor``), decides them on the
   sets, and passes over pairs that are in one component already. Only links leave
   it.

Null, empty and wordless texts have an empty set and link with nothing; texts
with fewer than n words are one gram. Rows that repeat an id are one node of the
link graph, with the links of all their texts. Rows with a null id take no part
and have a null component. Extra columns are never read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.llm import bytewords as bw
from slotwise.llm.graph import components, cut, small_batches

GRAM = 5
PERCENT = 85
BINS = 160
SHARED = 2                  # bands that a pair must share to be a candidate
ROUNDS = 1                  # rounds against centres
MISS = 1e-10                # probability with which an estimate may fall below its floor
PAIR_MEMBERS = 48           # members up to which a band's pairs become rows
BLOCK_GRAMS = 1 << 19       # grams of a block; a task holds two blocks
BROADCAST_IDS = 1 << 19     # documents up to which a list of ids is broadcast

_SEED = 0xD6E8FEB86659FD93
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def band_rows(percent: int, bins: int = BINS) -> int:
    """The longest band (a divisor of ``bins``, 8 at most) with which a pair at
    ``percent`` shares fewer than ``SHARED`` bands with probability ``MISS`` at most."""
    j = percent / 100
    for rows in range(8, 0, -1):
        if bins % rows == 0:
            bands, p = bins // rows, j ** rows
            if (1 - p) ** bands + bands * p * (1 - p) ** (bands - 1) <= MISS:
                return rows
    return 1


def agreement_floor(percent: int, bins: int = BINS) -> int:
    """Equal coordinates that a pair at ``percent`` falls short of with
    probability ``MISS`` at most, were the coordinates independent samples."""
    j, total = percent / 100, 0.0
    for equal in range(bins + 1):
        total += math.comb(bins, equal) * j ** equal * (1 - j) ** (bins - equal)
        if total > MISS:
            return equal
    return bins


def shingles(c: bw.Chunk, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, gram hash): each text's distinct grams, sorted by both."""
    h, at = c.ngrams(n)
    doc = c.doc[at] if len(at) else at
    words = np.diff(c.first)
    for size in range(1, n):
        t = np.flatnonzero(words == size)
        h = np.concatenate((h, bw.gram_hash(c.word, c.first[t], size)))
        doc = np.concatenate((doc, t))
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    return doc[new], h[new]


def sketch(doc: np.ndarray, h: np.ndarray, texts: int, bins: int = BINS) -> np.ndarray:
    """One row of ``bins`` values per text; texts without grams keep empty bins."""
    out = np.full((texts, bins), _EMPTY)
    at, doc = np.unique(doc, return_inverse=True)               # texts that still have an empty bin
    part = np.full((len(at), bins), _EMPTY)
    for i in range(2 * bins):
        if not len(at):
            break
        g = bw.mix(h + np.uint64(_SEED * (i + 1) % (1 << 64)))
        bin_ = ((g >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64) if i < bins else i - bins
        np.minimum.at(part.reshape(-1), doc * bins + bin_, (np.uint64(i) << np.uint64(32)) | (g & np.uint64(0xFFFFFFFF)))
        full = (part != _EMPTY).all(axis=1)
        if full.any():
            out[at[full]] = part[full]
            left = ~full[doc]
            place = np.cumsum(~full) - 1
            doc, h, at, part = place[doc[left]], h[left], at[~full], np.ascontiguousarray(part[~full])
    return out


def bands(s: np.ndarray, rows: int) -> np.ndarray:
    """One key per band of each sketch; the band's number is part of it."""
    n = s.shape[1] // rows
    parts = s.reshape(len(s), n, rows)
    key = np.zeros((len(s), n), np.uint64)
    for k in range(rows):
        key = bw.mix(key + parts[:, :, k]) * np.uint64(0x9E3779B97F4A7C15)
    return bw.mix(key + np.arange(1, n + 1, dtype=np.uint64))


def _sketches(n: int, bins: int, rows: int):
    """Per document: set size, fingerprints of the set, band keys."""
    @bw.tidy
    def run(batches):
        for b in batches:
            for lo, hi, c in bw.chunks(b.column(1), bw.SPACED, lower=True):
                doc, h = shingles(c, n)
                size = np.bincount(doc, minlength=hi - lo)
                first = np.concatenate(([0], np.cumsum(size)))
                prints = []
                for v in (h, bw.mix(h)):
                    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(v, dtype=np.uint64)))
                    prints.append(pa.array((total[first[1:]] - total[first[:-1]]).view(np.int64)))
                some = np.flatnonzero(size)
                keys = bands(sketch(doc, h, hi - lo, bins)[some], rows)
                offsets = np.concatenate(([0], np.cumsum(np.where(size > 0, bins // rows, 0)))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo), pa.array(size, pa.int64()), *prints,
                     pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.reshape(-1).view(np.int64)))],
                    names=["id", "size", "f1", "f2", "bands"])
    return run


def _sets(n: int):
    @bw.tidy
    def run(batches):
        for b in batches:
            for lo, hi, c in bw.chunks(b.column(1), bw.SPACED, lower=True):
                doc, h = shingles(c, n)
                first = np.searchsorted(doc, np.arange(hi - lo + 1))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo),
                     pa.array([h[first[k]:first[k + 1]].tobytes() for k in range(hi - lo)], pa.binary())],
                    names=["id", "grams"])
    return run


def overlap(x: np.ndarray, y: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(x) > len(y):
        x, y = y, x
    return int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum()) if len(x) else 0


def linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    both = overlap(x, y)
    return 100 * both >= percent * (len(x) + len(y) - both)


def _verify(percent: int):
    """Keeps the pairs whose sets link."""
    @bw.tidy
    def run(batches):
        for b in batches:
            ok = [linked(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), percent)
                  for x, y in zip(b.column(2).to_pylist(), b.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["a", "b"]).filter(pa.array(ok, pa.bool_()))
    return run


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that link; each pair brings its two sets together."""
    both = pairs.join(sets.toDF("xa", "x"), F.col("a") == F.col("xa")).join(sets.toDF("yb", "y"), F.col("b") == F.col("yb"))
    return both.select("a", "b", "x", "y").mapInArrow(_verify(percent), "a long, b long")


def _similar_size(a: str, b: str, percent: int):
    return F.expr(f"100 * least({a}, {b}) >= {percent} * greatest({a}, {b})")


def centre_pairs(lists: DataFrame, seed: int, percent: int) -> DataFrame:
    """One pair per document at most, with a centre of another component."""
    centre = lists.groupBy(F.col("key").alias("at")).agg(
        F.min_by(F.struct("id", "size", "comp"), F.xxhash64("id", F.lit(seed))).alias("c"))
    votes = (lists.join(centre, F.col("key") == F.col("at")).where("comp <> c.comp")
             .where(_similar_size("size", "c.size", percent))
             .groupBy("id", F.col("c.id").alias("c")).agg(F.count(F.lit(1)).alias("n")))
    best = votes.groupBy("id").agg(F.max(F.struct("n", "c")).alias("best"))
    return best.where(F.col("best.n") >= SHARED).select(F.col("best.c").alias("a"), F.col("id").alias("b"))


def still_mixed(lists: DataFrame, links: DataFrame) -> DataFrame:
    """``lists`` with the components that ``links`` make, without the bands whose
    members are one component."""
    comp = components(links)
    now = lists.select("key", "id", "size").join(comp, F.col("id") == F.col("node"), "left")
    now = now.select("key", "id", "size", F.coalesce("component", "id").alias("comp"))
    mixed = (now.groupBy(F.col("key").alias("at")).agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count(F.lit(1)).alias("members"))
             .where("lo < hi").select("at", "members"))
    return cut(now.join(mixed, F.col("key") == F.col("at")).select("key", "id", "size", "comp", "members"))


def open_pairs(lists: DataFrame, percent: int) -> DataFrame:
    """All candidate pairs in different components."""
    x = lists.select("key", F.col("id").alias("a"), F.col("size").alias("sa"), F.col("comp").alias("ca"))
    y = lists.select("key", F.col("id").alias("b"), F.col("size").alias("sb"), F.col("comp").alias("cb"))
    both = x.join(y, "key").where("a < b and ca <> cb").where(_similar_size("sa", "sb", percent))
    return both.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= SHARED).select("a", "b")


def group_links(lists: DataFrame, sets: DataFrame, percent: int, bins: int, rows: int, block_grams: int) -> DataFrame:
    """Links between different components whose members share large bands."""
    stars = lists.join(lists.groupBy(F.col("key").alias("at")).agg(F.min("id").alias("star")), F.col("key") == F.col("at"))
    group = components(stars.select(F.col("star").alias("a"), F.col("id").alias("b")).distinct())
    member = cut(lists.select("id", "size", "comp").distinct().join(group, F.col("id") == F.col("node"))
                 .select("id", "size", "comp", F.col("component").alias("group")))
    blocks = member.groupBy(F.col("group").alias("of")).agg(F.ceil(F.sum("size") / block_grams).alias("blocks"))
    placed = (member.join(blocks, F.col("group") == F.col("of"))
              .withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")))
              .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
              .select("group", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "id", "comp"))
    tasks = placed.join(sets.toDF("sid", "grams"), F.col("id") == F.col("sid"))
    tasks = tasks.select("group", "i", "j", "block", "id", "comp", "grams")
    return tasks.groupBy("group", "i", "j").applyInArrow(_block_links(percent, bins, rows), "a long, b long")


def _block_links(percent: int, bins: int, rows: int):
    def run(t: pa.Table) -> pa.Table:
        i, j = t.column("i")[0].as_py(), t.column("j")[0].as_py()
        ids, comp, block = (t.column(c).to_numpy() for c in ("id", "comp", "block"))
        sets = [np.frombuffer(x, np.uint64) for x in t.column("grams").to_pylist()]
        a, b = search(sets, comp, block, i == j, percent, bins, rows)
        return pa.table({"a": pa.array(ids[a], pa.int64()), "b": pa.array(ids[b], pa.int64())})
    return run


def search(sets, comp, block, inside: bool, percent: int, bins: int = BINS, rows: int = 4) -> tuple[list[int], list[int]]:
    """Links that join components, as places: inside one block, or between two."""
    size = np.array([len(x) for x in sets])
    s = sketch(np.repeat(np.arange(len(sets)), size), np.concatenate(sets), len(sets), bins)
    _, band = np.unique(bands(s, rows), return_inverse=True)
    band = band.reshape(len(sets), -1)
    owner = np.repeat(np.arange(len(sets)), band.shape[1])
    order = np.argsort(band.reshape(-1), kind="stable")
    owner = owner[order]
    head = np.concatenate(([0], np.cumsum(np.bincount(band.reshape(-1)))))
    names, comp = np.unique(comp, return_inverse=True)
    parent = np.arange(len(names))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    floor = agreement_floor(percent, bins)
    a, b = [], []
    for q in range(len(sets)):
        other = np.concatenate([owner[head[g]:head[g + 1]] for g in band[q]])
        shared = np.bincount(other, minlength=len(sets))
        ok = shared >= SHARED
        ok &= np.arange(len(sets)) > q if inside else block != block[q]
        ok &= 100 * np.minimum(size, size[q]) >= percent * np.maximum(size, size[q])
        found = np.flatnonzero(ok)
        equal = (s[found] == s[q]).sum(axis=1)
        found, equal = found[equal >= floor], equal[equal >= floor]
        for d in found[np.argsort(-equal, kind="stable")]:
            x, y = root(comp[q]), root(comp[d])
            if x != y and linked(sets[q], sets[d], percent):
                parent[x] = y
                a.append(q)
                b.append(int(d))
    return a, b


def near_duplicates(docs: DataFrame, percent: int = PERCENT, n: int = GRAM, id_col: str = "doc_id", text_col: str = "text",
                    bins: int = BINS, rounds: int = ROUNDS, pair_members: int = PAIR_MEMBERS,
                    block_grams: int = BLOCK_GRAMS) -> DataFrame:
    """One row per input row: id, ``n_shingles`` (set size), ``component_id``
    (smallest id that links reach, itself included), ``kept`` (id is its
    component's). Ids are integers; ``kept`` is true for a null id. ``rounds`` is
    1 at least."""
    rows = band_rows(percent, bins)
    texts = small_batches(docs).select(docs[id_col].cast("long").alias("id"), docs[text_col].alias("text"))
    known = cut(texts.mapInArrow(_sketches(n, bins, rows), "id long, size long, f1 long, f2 long, bands array<long>"))
    whole = known.where("size > 0 and id is not null")
    key = ["size", "f1", "f2"]
    classes = whole.groupBy(*key).agg(F.min("id").alias("rep"), F.first("bands").alias("bands"))
    members = classes.select(F.explode("bands").alias("key"), F.col("rep").alias("id"), "size", F.col("rep").alias("comp"))
    common = members.groupBy(F.col("key").alias("at")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("at")
    lists = cut(members.join(common, F.col("key") == F.col("at"), "left_semi"))
    wanted = lists.select(F.col("id").alias("wanted")).distinct()
    sets = cut(texts.join(_sized(cut(wanted)), F.col("id") == F.col("wanted"), "left_semi")
               .mapInArrow(_sets(n), "id long, grams binary"))

    # written first, so that both sides of the join are plain shuffles and Spark can split a class of many copies
    reps = cut(classes.select(*[F.col(k).alias(f"c_{k}") for k in key], "rep"))
    rep = cut(known.select("id", *key).join(reps, [F.col(k) == F.col(f"c_{k}") for k in key], "left").select("id", "size", "rep"))
    # an id with several texts joins their classes
    several = rep.groupBy(F.col("id").alias("of")).agg(F.min("rep").alias("a"), F.max("rep").alias("z")).where("a < z")
    links = cut(rep.join(several, F.col("id") == F.col("of")).select("a", F.col("rep").alias("b")))

    for seed in range(rounds):
        links = cut(links.union(verified(centre_pairs(lists, seed, percent), sets, percent)))
        lists = still_mixed(lists, links)
    by_pairs = verified(open_pairs(lists.where(F.col("members") <= pair_members), percent), sets, percent)
    by_groups = group_links(lists.where(F.col("members") > pair_members), sets, percent, bins, rows, block_grams)
    comp = components(cut(links.union(by_pairs).union(by_groups)))
    out = rep.join(comp, F.col("rep") == F.col("node"), "left")
    component = F.coalesce("component", "rep", "id")
    return out.select(F.col("id").alias(id_col), F.col("size").alias("n_shingles"), component.alias("component_id"),
                      F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def _sized(ids: DataFrame) -> DataFrame:
    """A table of ids, marked for broadcast if its count is within the bound."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
