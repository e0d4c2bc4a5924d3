"""Hard-negative mining over Hilbert-ordered Parquet blocks with zone maps.

Every row with a vector is a candidate; rows whose id is divisible by ``every``
are anchors. A row's score is its inner product with the anchor, on integer
components floor(scale * x). An anchor's positives are its best rows of the same
label; for each, the best rows of another label whose score lies in a window
between ``low`` and ``high`` percent of the positive's are returned.

1. Candidates are range-partitioned and sorted by their place on a Hilbert curve
   through all dimensions (four bits each, by the components' signs and sizes) and
   written as Parquet, one row per block of ``BLOCK_ROWS``, with a zone map: the
   least and the largest value per dimension, and of the labels. The zone columns
   are read without the blocks.
2. Interval arithmetic over a zone map bounds the scores in a block from both
   sides. A search first reads each anchor's own block; the k-th best score found
   there raises the lower end of the anchor's window. The blocks whose bounds meet
   a window are then chosen: blocks of zone maps and packs of anchors meet by
   shuffle, on a grid of cells, so neither side is collected or broadcast.
3. Chosen blocks are joined with the anchors that read them, and scored exactly by
   matrix products; a task keeps the best k per window as it goes, and raises the
   window with them.

The search runs twice, for positives and for negatives. Bounds only spare reads:
any number of blocks can be chosen, and all results are exact.

Rows with a null id, label or vector, or a null or non-finite component, take no
part. Of rows that repeat an id, the one with the smallest label (then vector)
counts. Vectors of different lengths are never compared; empty vectors score 0.
Ties go to the smaller id. Scores beyond a long are an error. An empty table gives
an empty result; other columns are never read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from slotwise.llm import bytewords as bw
from slotwise.llm.graph import cut
from slotwise.session import remove_path, scratch_path

SCALE = 256
EVERY = 100
POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90          # percent of the positive's score
BITS = 4                    # Hilbert bits per dimension
BLOCK_ROWS = 256
CELL_BLOCKS = 64            # zone maps that one choosing task holds
PACK_ANCHORS = 256          # and anchors
HELD = 1 << 20              # scores that a task holds before it keeps the best
BATCH_BYTES = 8 << 20       # Arrow batches: rows are whole blocks
_FLOOR, _CEIL = -(1 << 62), 1 << 62


def hilbert(x: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place on the Hilbert curve of each row (coordinates below 2**bits), as
    bytes that sort like it. After J. Skilling's transpose form."""
    n, dim = x.shape
    if dim == 0:
        return np.zeros((n, 0), np.uint8)
    a = np.ascontiguousarray(x.T).astype(np.uint32)
    for b in range(bits - 1, 0, -1):
        bit, low = np.uint32(1 << b), np.uint32((1 << b) - 1)
        for i in range(dim):
            high = (a[i] & bit) != 0
            swap = np.where(high, 0, (a[0] ^ a[i]) & low).astype(np.uint32)
            a[0] = np.where(high, a[0] ^ low, a[0] ^ swap)
            a[i] ^= swap
    for i in range(1, dim):
        a[i] ^= a[i - 1]
    t = np.zeros(n, np.uint32)
    for b in range(bits - 1, 0, -1):
        t ^= np.where(a[-1] & np.uint32(1 << b), np.uint32((1 << b) - 1), 0).astype(np.uint32)
    a ^= t
    planes = [((a >> np.uint32(b)) & np.uint32(1)).T for b in range(bits - 1, -1, -1)]
    return np.packbits(np.concatenate(planes, axis=1).astype(np.uint8), axis=1)


def coordinates(v: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Components as curve coordinates: zero in the middle, one step per doubling."""
    half = 1 << (bits - 1)
    size = np.minimum(np.ceil(np.log2(np.abs(v.astype(np.float64)) + 1)), half - 1)
    return (half + np.sign(v) * size).astype(np.int64)


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer a @ b.T; by floating point while every sum is exact in it."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    most = np.abs(a.astype(np.float64)).max() * np.abs(b.astype(np.float64)).max() * a.shape[1]
    if most < 1 << 52:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if most >= 1 << 61:
        raise OverflowError("inner products of these vectors do not fit in a long")
    return a @ b.T


def _ints(column: pa.Array, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.int64).reshape(len(column), dim)


def _by_length(v: pa.Array):
    """(length, rows, matrix) per vector length of a list column."""
    length = np.asarray(v.value_lengths())
    for dim in np.unique(length):
        at = np.flatnonzero(length == dim)
        yield int(dim), at, np.asarray(v.take(pa.array(at)).flatten(), np.int64).reshape(len(at), dim)


def _keys(bits: int):
    def run(batches):
        for b in batches:
            for dim, at, x in _by_length(b.column(2)):
                rows = pa.array(at)
                key = hilbert(coordinates(x, bits), bits)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(rows), b.column(1).take(rows), pa.array([r.tobytes() for r in x], pa.binary()),
                     pa.array(np.full(len(at), dim, np.int32)), pa.array([r.tobytes() for r in key], pa.binary())],
                    names=["id", "label", "v", "dim", "key"])
    return run


def _pack(block_rows: int):
    """Sorted rows into blocks with their zone maps."""
    def block(dim, rows):
        ids, labels, v = zip(*rows)
        x, label = np.frombuffer(b"".join(v), np.int64).reshape(len(v), dim), np.array(labels, np.int64)
        return (dim, len(rows), x.min(axis=0).tobytes(), x.max(axis=0).tobytes(), int(label.min()), int(label.max()),
                np.array(ids, np.int64).tobytes(), label.tobytes(), x.tobytes())

    def batch(blocks):
        kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
        names = ["dim", "n", "lo", "hi", "label_lo", "label_hi", "ids", "labels", "vectors"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*blocks), kinds)], names=names)

    @bw.tidy
    def run(batches):
        held, last = [], None
        for b in batches:
            out = []
            for i, label, v, dim in zip(*(b.column(c).to_pylist() for c in ("id", "label", "v", "dim"))):
                if held and (dim != last or len(held) == block_rows):
                    out.append(block(last, held))
                    held = []
                held.append((i, label, v))
                last = dim
            if out:
                yield batch(out)
        if held:
            yield batch([block(last, held)])
    return run


_BLOCK = ("dim int, n int, lo binary, hi binary, label_lo long, label_hi long, "
          "ids binary, labels binary, vectors binary")


def write_blocks(rows: DataFrame, path: str, block_rows: int = BLOCK_ROWS, bits: int = BITS) -> DataFrame:
    """``rows`` (id, label, v: integer components) as Hilbert-ordered blocks."""
    keyed = rows.select("id", "label", "v").mapInArrow(_keys(bits), "id long, label long, v binary, dim int, key binary")
    keyed = keyed.withColumn("salt", F.xxhash64("id"))              # equal vectors can be parted
    ordered = keyed.repartitionByRange("dim", "key", "salt").sortWithinPartitions("dim", "key", "id")
    packed = ordered.select("id", "label", "v", "dim").mapInArrow(_pack(block_rows), _BLOCK)
    packed.select(F.monotonically_increasing_id().alias("block"), "*").write.parquet(path)
    return rows.sparkSession.read.parquet(path)


def _anchors(every: int):
    """The anchors of each block."""
    def run(batches):
        for b in batches:
            for block, dim, ids, labels, v in zip(*(b.column(c).to_pylist() for c in ("block", "dim", "ids", "labels", "vectors"))):
                ids, labels = np.frombuffer(ids, np.int64), np.frombuffer(labels, np.int64)
                at = np.flatnonzero(ids % every == 0)
                if len(at):
                    x = np.frombuffer(v, np.int64).reshape(len(ids), dim)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids[at]), pa.array(labels[at]), pa.array(np.full(len(at), dim, np.int32)),
                         pa.array(np.full(len(at), block, np.int64)), pa.array([x[k].tobytes() for k in at], pa.binary())],
                        names=["id", "label", "dim", "home", "v"])
    return run


#: An anchor as it travels: its windows are lows[i] to highs[i].
_ANCHOR = "struct<id: bigint, label: bigint, v: binary, lows: array<bigint>, highs: array<bigint>>"


def _unpack(a: pa.StructArray, dim: int):
    """(ids, labels, vectors, lows, highs) of an array of anchors."""
    ids, labels = (np.asarray(a.field(c)) for c in ("id", "label"))
    lows, highs = (np.asarray(a.field(c).flatten(), np.int64).reshape(len(a), -1) for c in ("lows", "highs"))
    return ids, labels, _ints(a.field("v"), dim), lows, highs


def _choose(same: bool):
    """Blocks whose score bounds meet a window, with the anchors that read them."""
    schema = pa.schema([("block", pa.int64()), ("anchors", pa.list_(pa.struct(
        [("id", pa.int64()), ("label", pa.int64()), ("v", pa.binary()), ("lows", pa.list_(pa.int64())), ("highs", pa.list_(pa.int64()))])))])

    def run(zones: pa.Table, packs: pa.Table) -> pa.Table:
        if not len(zones) or not len(packs):
            return schema.empty_table()
        dim = zones.column("dim")[0].as_py()
        a = packs.column("a").combine_chunks()
        a = a.chunk(0) if isinstance(a, pa.ChunkedArray) else a
        _, label, x, lows, highs = _unpack(a, dim)
        lo, hi = (_ints(zones.column(c), dim) for c in ("lo", "hi"))
        first, last = (zones.column(c).to_numpy() for c in ("label_lo", "label_hi"))
        up, down = np.maximum(x, 0), np.minimum(x, 0)
        most = product(up, hi) + product(down, lo)
        least = product(up, lo) + product(down, hi)
        meet = np.zeros(most.shape, bool)
        for w in range(lows.shape[1]):
            meet |= (most >= lows[:, w, None]) & (least <= highs[:, w, None]) & (lows[:, w] <= highs[:, w])[:, None]
        if same:
            meet &= (label[:, None] >= first) & (label[:, None] <= last)
        else:
            meet &= ~((label[:, None] == first) & (first == last))
        block, who = np.nonzero(meet.T)
        offsets = np.searchsorted(block, np.arange(len(zones) + 1)).astype(np.int32)
        read = np.flatnonzero(np.diff(offsets))
        got = pa.ListArray.from_arrays(pa.array(offsets), a.take(pa.array(who))).take(pa.array(read))
        return pa.table([zones.column("block").combine_chunks().take(pa.array(read)), got], names=["block", "anchors"]).cast(schema)
    return run


class _Best:
    """The best ``k`` scores per (anchor, window) seen by a task."""

    def __init__(self, k: int):
        self.k, self.parts, self.held = k, [], 0
        self.floor: dict[tuple[int, int], int] = {}

    def add(self, anchor, window, score, cand):
        self.parts.append((anchor, np.full(len(anchor), window, np.int64), score, cand))
        self.held += len(anchor)
        if self.held > HELD:
            self.parts = [self.best()]
            self.held = len(self.parts[0][0])

    def best(self) -> tuple[np.ndarray, ...]:
        anchor, window, score, cand = (np.concatenate(c) for c in zip(*self.parts))
        order = np.lexsort((cand, -score, window, anchor))
        anchor, window, score, cand = anchor[order], window[order], score[order], cand[order]
        new = np.append(True, (anchor[1:] != anchor[:-1]) | (window[1:] != window[:-1]))
        place = np.arange(len(anchor)) - np.flatnonzero(new)[np.cumsum(new) - 1]
        full = place == self.k - 1
        self.floor.update(zip(zip(anchor[full].tolist(), window[full].tolist()), score[full].tolist()))
        keep = place < self.k
        return anchor[keep], window[keep], score[keep], cand[keep]


def _score(same: bool, k: int):
    @bw.tidy
    def run(batches):
        best = _Best(k)
        for b in batches:
            anchors = b.column(1)
            for r, (dim, ids, labels, v) in enumerate(zip(*(b.column(c).to_pylist() for c in ("dim", "ids", "labels", "vectors")))):
                ids, labels = np.frombuffer(ids, np.int64), np.frombuffer(labels, np.int64)
                who, label, x, lows, highs = _unpack(anchors.slice(r, 1).flatten(), dim)
                s = product(x, np.frombuffer(v, np.int64).reshape(len(ids), dim))
                fits = (label[:, None] == labels) & (who[:, None] != ids) if same else label[:, None] != labels
                for w in range(lows.shape[1]):
                    low = np.array([max(a, best.floor.get((i, w), a)) for i, a in zip(who.tolist(), lows[:, w].tolist())], np.int64)
                    q, c = np.nonzero(fits & (s >= low[:, None]) & (s <= highs[:, w, None]))
                    if len(q):
                        best.add(who[q], w, s[q, c], ids[c])
        if best.parts:
            anchor, window, score, cand = best.best()
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (anchor, window, score, cand)], names=["id", "window", "score", "cand"])
    return run


def _scored(wants: DataFrame, blocks: DataFrame, same: bool, k: int) -> DataFrame:
    """(id, window, score, cand, place): the best ``k`` per anchor and window."""
    read = wants.withColumnRenamed("block", "want").join(blocks, F.col("want") == F.col("block"))
    found = read.select("block", "anchors", "dim", "ids", "labels", "vectors").mapInArrow(
        _score(same, k), "id long, window long, score long, cand long")
    order = Window.partitionBy("id", "window").orderBy(F.desc("score"), "cand")
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def search(blocks: DataFrame, anchors: DataFrame, same: bool, k: int, cell_blocks: int = CELL_BLOCKS,
           pack_anchors: int = PACK_ANCHORS) -> DataFrame:
    """Per anchor and window the best ``k`` rows with the anchor's label, or with
    another. ``anchors``: id, label, dim, home, v, lows, highs; written already."""
    a = F.struct("id", "label", "v", "lows", "highs").alias("a")
    homes = anchors.groupBy(F.col("home").alias("block")).agg(F.collect_list(a).alias("anchors"))     # a block's rows at most
    near = _scored(homes, blocks, same, k).where(F.col("place") == k)
    floors = near.groupBy(F.col("id").alias("of")).agg(F.map_from_entries(F.collect_list(F.struct("window", "score"))).alias("floors"))
    raised = F.transform("lows", lambda x, i: F.greatest(x, F.coalesce(F.col("floors")[i.cast("long")], x)))
    anchors = cut(anchors.join(floors, F.col("id") == F.col("of"), "left").withColumn("lows", raised).drop("of", "floors"))
    return cut(_scored(chosen(blocks, anchors, same, cell_blocks, pack_anchors), blocks, same, k))


def chosen(blocks: DataFrame, anchors: DataFrame, same: bool, cell_blocks: int = CELL_BLOCKS,
           pack_anchors: int = PACK_ANCHORS) -> DataFrame:
    """(block, anchors): the blocks to read, with the anchors that read them; one
    row per block and pack. Reads the zone columns alone."""
    cells = max(1, -(-blocks.count() // cell_blocks))
    packs = max(1, -(-anchors.count() // pack_anchors))
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    zones = (blocks.select("block", "dim", "lo", "hi", "label_lo", "label_hi")
             .withColumn("cell", F.pmod(F.xxhash64("block"), F.lit(cells)).cast("int")).withColumn("pack", spread(packs)))
    sides = (anchors.select("dim", F.struct("id", "label", "v", "lows", "highs").alias("a"))
             .withColumn("pack", F.pmod(F.xxhash64("a.id"), F.lit(packs)).cast("int")).withColumn("cell", spread(cells)))
    key = ["dim", "cell", "pack"]
    return zones.groupBy(*key).cogroup(sides.groupBy(*key)).applyInArrow(_choose(same), f"block long, anchors array<{_ANCHOR}>")


def _once(rows: DataFrame) -> DataFrame:
    """One row per id."""
    twice = cut(rows.groupBy(F.col("id").alias("twice")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("twice"))
    if twice.isEmpty():
        return rows
    least = (rows.join(twice, F.col("id") == F.col("twice"), "left_semi").groupBy("id")
             .agg(F.min(F.struct("label", "v")).alias("r")).select("id", "r.label", "r.v"))
    return rows.join(twice, F.col("id") == F.col("twice"), "left_anti").union(least)


def hard_negatives(rows: DataFrame, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding",
                   every: int = EVERY, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH,
                   scale: int = SCALE, block_rows: int = BLOCK_ROWS, cell_blocks: int = CELL_BLOCKS,
                   pack_anchors: int = PACK_ANCHORS) -> DataFrame:
    """One row per anchor, positive and negative: anchor_id, positive_id, rank,
    negative_id, positive_score, negative_score. ``low`` and ``high`` are whole
    percentages; ids and labels are integers."""
    spark = rows.sparkSession
    if spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) is None:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    vector = rows[vector_col]
    finite = F.forall(vector, lambda x: F.abs(x.cast("double")) <= 1.7976931348623157e308)
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * scale))
    usable = rows[id_col].isNotNull() & rows[label_col].isNotNull() & vector.isNotNull() & finite
    src = _once(rows.where(usable).select(rows[id_col].cast("long").alias("id"), rows[label_col].cast("long").alias("label"), whole.alias("v")))
    path = scratch_path(spark, "candidate-blocks")
    try:
        blocks = write_blocks(src, path, block_rows)
        anchors = blocks.select("block", "dim", "ids", "labels", "vectors").mapInArrow(
            _anchors(every), "id long, label long, dim int, home long, v binary")
        anchors = cut(anchors.withColumns({"lows": F.array(F.lit(_FLOOR)), "highs": F.array(F.lit(_CEIL))}))
        found = search(blocks, anchors, True, positives, cell_blocks, pack_anchors)
        ranked = F.array_sort(F.collect_list(F.struct("place", "cand", "score")))                       # ``positives`` at most
        found = found.groupBy(F.col("id").alias("of")).agg(ranked.alias("p"))
        floor_div = lambda x, by: (x - F.pmod(x, F.lit(by))).cast("decimal(38,0)") / by
        none = F.lit(positives) - F.size("p")                                                           # windows that nothing meets
        windows = anchors.drop("lows", "highs").join(found, F.col("id") == F.col("of")).withColumns({
            "lows": F.concat(F.transform("p", lambda p: -floor_div(p["score"] * -low, 100).cast("long")), F.array_repeat(F.lit(_CEIL), none)),
            "highs": F.concat(F.transform("p", lambda p: floor_div(p["score"] * high, 100).cast("long")), F.array_repeat(F.lit(_FLOOR), none))})
        windows = cut(windows.drop("of"))
        got = search(blocks, windows.drop("p"), False, negatives, cell_blocks, pack_anchors)
    finally:
        remove_path(spark, path)
    sides = windows.select(F.col("id").alias("of"), F.posexplode("p").alias("at", "p"))
    both = got.join(sides, (F.col("id") == F.col("of")) & (F.col("window") == F.col("at")))
    return both.select(F.col("id").alias("anchor_id"), F.col("p.cand").alias("positive_id"), F.col("place").alias("rank"),
                       F.col("cand").alias("negative_id"), F.col("p.score").alias("positive_score"), F.col("score").alias("negative_score"))
