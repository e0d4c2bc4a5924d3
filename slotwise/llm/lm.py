"""Language-model scoring: a hashed maximum-entropy model with class-factored
softmax.

Tokens are the words of a text and one end. Training words are ranked by count.
The first ``CLASSES * WIDTH`` of them form classes of ``WIDTH`` neighbours in
rank; the rest falls into rank bands, each one class more. A token's probability
is

    P(class | history) * P(word | class, history).

Both factors are softmax over sums of weights, one weight row per feature: the
last word, the last two words, and the word before the last alone (a skip), each
hashed into a table of ``ROWS`` rows (for the second factor together with the
class). A band has too many words for one softmax: its second factor is a product of
two-way ones down a tree over its ranks, each a sum of a log ratio of counts and of
one weight per feature, hashed together with the node into a table of ``NODES``.
The last band's tree follows the leading bits of the words' hashes to groups, up to
``TAIL_BITS`` deep and of about one word while the vocabulary allows it. In its group
a word has its share of the counts, one added to each, and one share is left for
unseen words. So probabilities add up to one.

Training is local gradient ascent in the tasks over all training documents, from
the same start; each task reports the rows that it moved, Spark adds them up, and
the weights become the means by use. Each round takes its own part of the
documents; the rounds together are one pass. Scoring is one pass of numpy batches.

The vocabulary is a shuffled count of all training words and grows with the
corpus. Tasks hold its ``FREQUENT`` most frequent words; counts of all other words
reach the documents by a join. Only tables of fixed size pass the driver.

Null texts count as empty: one token, the end. Repeated rows are scored one by
one. Other columns are never read. Without training documents every word is
unseen.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.llm import bytewords as bw
from slotwise.llm.graph import cut, most_frequent, release, small_batches

CLASSES, WIDTH = 16, 20             # classes of single words; words per class
BANDS = (2_000, 16_000)             # last ranks of the bands; then FREQUENT, then all others
N_CLASSES = CLASSES + len(BANDS) + 2
assert N_CLASSES == WIDTH           # both weight tables have the same width
FREQUENT = 1 << 19                  # words whose counts the tasks hold
ROWS = 1 << 15                      # rows of each weight table, 65,536 at most
LOGIT = 60.0                        # logits are kept within
NODES = 1 << 16                     # weights of the trees
TAIL_BITS = 20                      # depth of the last band's tree, at most
ROUNDS = 2
RATE, DAMP = 1.5, 8.0               # step, and the use below which steps shrink
FLUSH_WORDS = 1 << 20
END, START = (bw.mix(np.array([k], np.uint64))[0] for k in (0xE11D, 0x57A27))
_SALT = [bw.mix(np.array([k], np.uint64))[0] | np.uint64(1) for k in range(7001, 7006)]
FEATURES = 3


@dataclass
class Model:
    """What every task gets: bounded tables."""

    word: np.ndarray        # sorted hashes of the frequent words
    count: np.ndarray
    rank: np.ndarray
    total: int              # N, training tokens
    types: int              # V
    bias: np.ndarray        # log P(class)
    word_bias: np.ndarray   # classes x WIDTH, log P(word | class)
    split: np.ndarray       # by the rank that a node of a band's tree splits at: log P(right) / P(left)
    tail: np.ndarray        # the same by node of the last band's tree
    group: np.ndarray       # counts per group of the last band, with one more per type and one
    weights: np.ndarray     # 2 x ROWS x WIDTH
    nodes: np.ndarray       # NODES


def held_out(ids: list) -> np.ndarray:
    """Remainders of crc32 of the ids as text, modulo 7."""
    return np.array([zlib.crc32(("" if i is None else str(i)).encode()) % 7 for i in ids], np.int64)


def round_of(ids: list) -> np.ndarray:
    return np.array([zlib.crc32(("" if i is None else str(i)).encode()) // 7 % ROUNDS for i in ids], np.int64)


def tokens(c: bw.Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes with an end after each text, and each text's first place."""
    return np.insert(c.word, c.first[1:], END), c.first + np.arange(len(c.first))


def vocabulary(docs: DataFrame, fold: int) -> DataFrame:
    """(w, n): counts of all training tokens. ``docs``: id, text."""
    def report(kept):
        w, n = np.unique(np.concatenate(kept), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(w.view(np.int64)), pa.array(n, pa.int64())], names=["w", "n"])

    @bw.tidy
    def run(batches):
        kept, size = [], 0
        for b in batches:
            train = b.filter(pa.array(held_out(b.column(0).to_pylist()) != fold))
            for _, _, c in bw.chunks(train.column(1), bw.SPACED, lower=True):
                t, _ = tokens(c)
                kept.append(t)
                size += len(t)
                if size >= FLUSH_WORDS:
                    yield report(kept)
                    kept, size = [], 0
        if kept:
            yield report(kept)

    return docs.mapInArrow(run, "w long, n long").groupBy("w").agg(F.sum("n").alias("n"))


def group_counts(vocab: DataFrame, word: np.ndarray, count: np.ndarray, types: int) -> np.ndarray:
    """Counts per group of the words outside the frequent ones, with one more per
    type and one; as many groups as types, 2 ** TAIL_BITS at most."""
    bits = min(TAIL_BITS, int(types - len(word)).bit_length())
    total = np.ones(1 << bits)
    of = F.shiftrightunsigned("w", 64 - bits) if bits else F.lit(0).cast("long")
    found = vocab.groupBy(of.alias("g")).agg(F.sum(F.col("n") + 1).alias("n")).toArrow()
    total[found.column("g").to_numpy()] += found.column("n").to_numpy()
    return total - np.bincount(_group(word, bits), weights=count + 1.0, minlength=1 << bits)


def _group(word: np.ndarray, bits: int) -> np.ndarray:
    return (word >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(word), np.int64)


def rank_splits(count: np.ndarray) -> np.ndarray:
    """Per node of the bands' trees (by the rank where it splits) the log ratio of
    the counts right and left of it."""
    total = np.concatenate(([0.0], np.cumsum(count, dtype=np.float64)))
    split = np.zeros(len(count) + 1, np.float32)
    lo, hi = band_edges(len(count))
    while len(lo):
        live = hi - lo > 1
        lo, hi = lo[live], hi[live]
        mid = (lo + hi) >> 1
        split[mid] = np.log(total[hi] - total[mid]) - np.log(total[mid] - total[lo])
        lo, hi = np.concatenate((lo, mid)), np.concatenate((mid, hi))
    return split


def band_edges(words: int) -> tuple[np.ndarray, np.ndarray]:
    """First and end ranks of the bands but the last."""
    edges = np.minimum([CLASSES * WIDTH, *BANDS, FREQUENT], words)
    return edges[:-1], edges[1:]


def start_model(vocab: DataFrame) -> Model:
    """The model before training: every class and word by its count."""
    n, v = vocab.agg(F.sum("n"), F.count(F.lit(1))).first()
    n = n or 0
    top = most_frequent(vocab, FREQUENT).toArrow()
    word = np.asarray(top.column("w").to_numpy(), np.int64).view(np.uint64)
    count = np.asarray(top.column("n").to_numpy(), np.int64)
    order = np.lexsort((word.view(np.int64), -count))
    word, count = word[order], count[order]
    rank = np.arange(len(word))
    named = CLASSES * WIDTH
    per_word = np.full(named, 0.5)
    per_word[:min(named, len(word))] = count[:named]
    group = group_counts(vocab, word, count, v)
    band = [float(count[a:z].sum()) for a, z in zip(*band_edges(len(word)))]
    band.append(float(n - count.sum() + v - len(word) + 1))
    heap = [np.empty(0), group]
    while len(heap[1]) > 1:
        heap.insert(1, heap[1].reshape(-1, 2).sum(axis=1))
    tail = np.concatenate([np.zeros(1), *(np.log(x[1::2]) - np.log(x[::2]) for x in heap[2:])])
    by_class = np.concatenate((per_word.reshape(CLASSES, WIDTH).sum(axis=1), np.maximum(band, 0.5)))
    sort = np.argsort(word)
    word_bias = np.zeros((N_CLASSES, WIDTH))
    word_bias[:CLASSES] = np.log(per_word.reshape(CLASSES, WIDTH) / by_class[:CLASSES, None])
    return Model(word[sort], count[sort], rank[sort], n, v, np.log(by_class / by_class.sum()).astype(np.float32),
                 word_bias.astype(np.float32), rank_splits(count), tail.astype(np.float32), group,
                 np.zeros((2, ROWS, WIDTH), np.float32), np.zeros(NODES, np.float32))


@dataclass
class Batch:
    """Tokens of a chunk as the model sees them."""

    first: np.ndarray
    token: np.ndarray
    count: np.ndarray       # 0 where the frequent words lack it
    rank: np.ndarray        # -1 there
    cls: np.ndarray
    features: np.ndarray    # FEATURES x tokens


def read(c: bw.Chunk, m: Model) -> Batch:
    t, first = tokens(c)
    rank, count = np.full(len(t), -1), np.zeros(len(t), np.int64)
    i, k = bw.lookup(m.word, t)
    rank[i], count[i] = m.rank[k], m.count[k]
    cls = CLASSES + np.searchsorted(np.array([*BANDS, FREQUENT]), rank, side="right")
    named = (rank >= 0) & (rank < CLASSES * WIDTH)
    cls[named] = rank[named] // WIDTH
    cls[rank < 0] = N_CLASSES - 1
    one, two = np.empty_like(t), np.empty_like(t)
    one[1:], two[2:] = t[:-1], t[:-2]
    two[:2] = START
    one[first[:-1]] = START
    two[first[:-1]] = START
    short = first[:-1][np.diff(first) > 1]
    two[short + 1] = START
    f = np.stack((bw.mix(one * _SALT[0]), bw.mix(one * _SALT[1] + two * _SALT[2]), bw.mix(two * _SALT[3])))
    return Batch(first, t, count, rank, cls, f)


def _logits(weights: np.ndarray, rows: np.ndarray, bias: np.ndarray) -> np.ndarray:
    x = weights[rows[0]]
    for r in rows[1:]:
        x += weights[r]
    x += bias
    return x


def _softmax(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(logits, their exponentials, sums of these by row)."""
    np.clip(x, -LOGIT, LOGIT, out=x)
    e = np.exp(x)
    return x, e, e @ np.ones(e.shape[1], e.dtype)


def factors(b: Batch, m: Model):
    """For both factors: (tokens, weight rows, softmax of all choices, the choice
    made). Bands' second factor: see ``choices``."""
    mask = np.uint64(ROWS - 1)
    rows = (b.features & mask).view(np.int64)
    yield np.arange(len(b.token)), rows, _softmax(_logits(m.weights[0], rows, m.bias)), b.cls
    at = np.flatnonzero(b.cls < CLASSES)
    rows = (bw.mix(b.features[:, at] + b.cls[at].astype(np.uint64) * _SALT[4]) & mask).view(np.int64)
    yield at, rows, _softmax(_logits(m.weights[1], rows, m.word_bias[b.cls[at]])), b.rank[at] % WIDTH


def _node_rows(features: np.ndarray, node: np.ndarray) -> np.ndarray:
    h = features + node.astype(np.uint64) * _SALT[4]
    h *= _SALT[3]
    h >>= np.uint64(64 - (NODES.bit_length() - 1))
    return h.view(np.int64)


def choices(b: Batch, m: Model):
    """Steps down the bands' trees: (tokens, weights' places, biases, whether the
    token's word is on the right)."""
    at = np.flatnonzero((b.cls >= CLASSES) & (b.rank >= 0))
    lo, hi = (x[b.cls[at] - CLASSES] for x in band_edges(len(m.word)))
    rank, f = b.rank[at], b.features[:, at]
    while len(at):
        live = np.flatnonzero(hi - lo > 1)
        if len(live) < len(at):
            at, lo, hi, rank, f = at[live], lo[live], hi[live], rank[live], f[:, live]
        mid = (lo + hi) >> 1
        right = rank >= mid
        yield at, _node_rows(f, mid), m.split[mid], right
        lo, hi = np.where(right, mid, lo), np.where(right, hi, mid)
    at = np.flatnonzero(b.rank < 0)
    f, bits = b.features[:, at], len(m.group).bit_length() - 1
    leaf = _group(b.token[at], bits) + len(m.group)
    for k in range(bits if len(at) else 0):
        node = leaf >> (bits - k)
        yield at, _node_rows(f, -node), m.tail[node], (leaf >> (bits - k - 1) & 1) == 1


def _odds(places: np.ndarray, bias: np.ndarray, right: np.ndarray, m: Model) -> tuple[np.ndarray, np.ndarray]:
    """(sign of the step not taken, odds against the one taken)."""
    x = m.nodes[places[0]]
    for r in places[1:]:
        x += m.nodes[r]
    x += bias
    sign = 1 - 2 * right.astype(np.float32)
    x *= sign
    return sign, np.exp(np.clip(x, -LOGIT, LOGIT, out=x), out=x)


def train_trees(b: Batch, m: Model, used: np.ndarray) -> None:
    """One gradient step on the trees' weights."""
    places, grads = [], []
    for _, rows, bias, right in choices(b, m):
        sign, against = _odds(rows, bias, right, m)
        places.append(rows)
        grads.append(-sign * (against / (1 + against)))
    if places:
        at = np.concatenate(places, axis=1)
        g = np.concatenate(grads).astype(np.float64)
        n = np.bincount(at.ravel(), minlength=NODES)
        step = sum(np.bincount(x, weights=g, minlength=NODES) for x in at)
        m.nodes += (step * (RATE / FEATURES / (n + DAMP))).astype(np.float32)
        used += n


def train_chunk(b: Batch, m: Model, used: np.ndarray) -> None:
    """One gradient step on a chunk; ``used`` counts the uses of each row."""
    for k, (_, rows, (_, e, total), made) in enumerate(factors(b, m)):
        if not len(made):
            continue
        e *= (-1 / total)[:, None]
        e[np.arange(len(made)), made] += 1
        g = e.T.astype(np.float64)
        for r in rows:
            n = np.bincount(r, minlength=ROWS)
            step = np.stack([np.bincount(r, weights=x, minlength=ROWS) for x in g], axis=1)
            step *= (RATE / FEATURES / (n + DAMP))[:, None]
            m.weights[k] += step
            used[k] += n


def _as_rows(x: np.ndarray) -> np.ndarray:
    return np.append(x, np.zeros(-len(x) % WIDTH, x.dtype)).reshape(-1, WIDTH)


def train(docs: DataFrame, m: Model, fold: int) -> Model:
    """Distributed training; ``docs``: id, text."""
    sc = docs.sparkSession.sparkContext
    cols = [f"x{i}" for i in range(WIDTH)]
    for k in range(ROUNDS):
        shared = sc.broadcast(m)

        @bw.tidy
        def run(batches, k=k, shared=shared):
            start = shared.value
            own = Model(**{**vars(start), "weights": start.weights.copy(), "nodes": start.nodes.copy()})
            used, used_nodes = np.zeros((2, ROWS), np.float32), np.zeros(NODES, np.float32)
            for b in batches:
                ids = b.column(0).to_pylist()
                part = b.filter(pa.array((held_out(ids) != fold) & (round_of(ids) == k)))
                for _, _, c in bw.chunks(part.column(1), bw.SPACED, lower=True):
                    t = read(c, own)
                    train_chunk(t, own, used)
                    train_trees(t, own, used_nodes)
            at = np.flatnonzero(used.ravel())
            n = used.ravel()[at]
            move = (own.weights - start.weights).reshape(-1, WIDTH)[at] * n[:, None]
            # the trees' weights in rows of WIDTH: moves by use, then uses
            trees = np.stack((_as_rows((own.nodes - start.nodes) * used_nodes), _as_rows(used_nodes))).reshape(-1, WIDTH)
            some = np.flatnonzero(trees.any(axis=1))
            at = np.concatenate((at, some + 2 * ROWS))
            n = np.concatenate((n, np.ones(len(some), np.float32)))
            move = np.concatenate((move, trees[some]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(at.astype(np.int32)), pa.array(n), *(pa.array(move[:, i]) for i in range(WIDTH))], names=["at", "n", *cols])

        moved = docs.mapInArrow(run, "at int, n float, " + ", ".join(f"{c} float" for c in cols))
        # a task's rows differ, so they are sent as they are and not as partial sums of twice the size
        total = moved.repartition("at").groupBy("at").agg(F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in cols]).toArrow()   # rows of both tables and the trees' at most
        del moved
        release(docs.sparkSession)
        at = total.column("at").to_numpy()
        sums = np.stack([total.column(c).to_numpy() for c in cols], axis=1)
        flat = at < 2 * ROWS
        weights = m.weights.reshape(-1, WIDTH).copy()
        weights[at[flat]] += (sums[flat] / total.column("n").to_numpy()[flat, None]).astype(np.float32)
        trees = np.zeros((2 * -(-NODES // WIDTH), WIDTH))
        trees[at[~flat] - 2 * ROWS] = sums[~flat]
        move, uses = trees.reshape(2, -1)[:, :NODES]
        nodes = m.nodes + (move / np.maximum(uses, 1)).astype(np.float32)
        m = Model(**{**vars(m), "weights": weights.reshape(2, ROWS, WIDTH), "nodes": nodes})
    return m


def score_chunk(b: Batch, m: Model) -> tuple[np.ndarray, ...]:
    """Per text: known words among the frequent, base score and score without
    the words outside the frequent ones; those words' places."""
    log10 = np.log(10.0)
    score = np.zeros(len(b.token))
    for at, _, (x, _, total), made in factors(b, m):
        score[at] += (x[np.arange(len(made)), made] - np.log(total)).astype(np.float64) / log10
    for at, places, bias, right in choices(b, m):
        score[at] -= np.log1p(_odds(places, bias, right, m)[1]) / log10
    rest = b.rank < 0
    score[rest] -= np.log10(m.group[_group(b.token[rest], len(m.group).bit_length() - 1)])
    base = np.where(rest, 0.0, np.log10(b.count + 1.0)) - np.log10(m.total + m.types + 1.0)
    sums = [np.add.reduceat(x, b.first[:-1]) for x in (~rest, base, score)]
    return (*sums, np.flatnonzero(rest))


def score(docs: DataFrame, fold: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, ``held_out``, ``n_tokens``, ``n_known``,
    ``train_tokens``, ``base_score``, ``score`` (log10 probabilities)."""
    src = small_batches(docs).select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    id_type = src.schema[0].dataType.simpleString()
    vocab = cut(vocabulary(src, fold))
    model = train(src, start_model(vocab), fold)
    shared = src.sparkSession.sparkContext.broadcast(model)

    @bw.tidy
    def run(batches):
        m = shared.value
        for b in batches:
            for lo, hi, c in bw.chunks(b.column(1), bw.SPACED, lower=True):
                t = read(c, m)
                known, base, total, rest = score_chunk(t, m)
                ends = np.searchsorted(rest, t.first).astype(np.int32)
                ids = b.column(0).slice(lo, hi - lo)
                out = held_out(ids.to_pylist()) == fold
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(out), pa.array(np.diff(t.first)), pa.array(known.astype(np.int64)), pa.array(base), pa.array(total),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(t.token[rest].view(np.int64)))],
                    names=["id", "held_out", "n_tokens", "known", "base", "total", "rest"])

    part = src.mapInArrow(run, f"id {id_type}, held_out boolean, n_tokens long, known long, base double, total double, rest array<long>")
    part = cut(part.withColumn("row", F.monotonically_increasing_id()))     # row numbers stay as written
    # words outside the frequent ones get their counts by a join
    rest = part.select("row", F.explode("rest").alias("word")).groupBy("row", "word").agg(F.count(F.lit(1)).alias("k"))
    more = (rest.join(vocab, F.col("word") == F.col("w"), "left").groupBy(F.col("row").alias("r"))
            .agg(F.sum(F.when(F.col("n") > 0, F.col("k")).otherwise(0)).alias("seen"),
                 F.sum(F.col("k") * F.log10(F.coalesce("n", F.lit(0)) + 1)).alias("gain")))
    both = part.drop("rest").join(more, F.col("row") == F.col("r"), "left")
    seen, gain = F.coalesce("seen", F.lit(0)), F.coalesce("gain", F.lit(0.0))
    return both.select(F.col("id").alias(id_col), "held_out", "n_tokens", (F.col("known") + seen).alias("n_known"),
                       F.lit(model.total).cast("long").alias("train_tokens"),
                       (F.col("base") + gain).alias("base_score"), (F.col("total") + gain).alias("score"))
