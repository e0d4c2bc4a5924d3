import math

import numpy as np
import pytest

from slotwise.llm import hard_negatives as hn
from slotwise.llm.queries import QUERIES
from tests.conftest import SF_SMALL

ROW = "vec_id long, label int, embedding array<double>"


def brute(rows, every=100, positives=5, negatives=10, low=30, high=90):
    kept = {}
    for i, label, v in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        whole = tuple(math.floor(256 * float(x)) for x in v)
        kept[i] = min(kept.get(i, (label, whole)), (label, whole))
    out = []
    for a, (label, v) in kept.items():
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, other) for i, (other, w) in kept.items() if i != a and len(w) == len(v))
        for s, p, _ in [x for x in scored if x[2] == label][:positives]:
            fits = [x for x in scored if x[2] != label and low * -s <= 100 * -x[0] <= high * -s][:negatives]
            out += [(a, p, k + 1, i, -s, -t) for k, (t, i, _) in enumerate(fits)]
    return sorted(out)


def run(df, **kw):
    return sorted(tuple(r) for r in hn.hard_negatives(df, **kw).collect())


def clustered(seed, n=600, dim=6, labels=4):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(8, dim))
    v = centre[rng.integers(0, 8, n)] + rng.normal(scale=0.3, size=(n, dim))
    return [(int(i), int(rng.integers(0, labels)), [round(float(x), 1) for x in r]) for i, r in enumerate(v)]


@pytest.mark.parametrize("kw", [{}, {"block_rows": 9, "cell_blocks": 5, "pack_anchors": 4, "every": 20},
                                {"every": 50, "positives": 2, "negatives": 3, "low": 0, "high": 100}])
def test_clustered_rows(spark, kw):
    rows = clustered(1)
    want = brute(rows, **{k: v for k, v in kw.items() if k in ("every", "positives", "negatives", "low", "high")})
    assert run(spark.createDataFrame(rows, ROW).repartition(3), **kw) == want != []


def test_task_keeps_the_best(spark, monkeypatch):
    b = hn._Best(2)
    monkeypatch.setattr(hn, "HELD", 3)
    for k in range(6):
        b.add(np.array([7, 7]), 0, np.array([k, k]), np.array([10 + k, 3 + k]))
    assert [x.tolist() for x in b.best()] == [[7, 7], [0, 0], [5, 5], [8, 15]] and b.floor == {(7, 0): 5}


def test_bounds_spare_blocks(spark, tmp_dir):
    rows = [(i, i % 3, [math.cos(i / 100), math.sin(i / 100)]) for i in range(700)]
    src = spark.createDataFrame(rows, "id long, label long, x array<double>").selectExpr("id", "label", "transform(x, v -> floor(256 * v)) v")
    blocks = hn.write_blocks(src, f"{tmp_dir}/blocks", block_rows=20)
    anchors = spark.createDataFrame([(0, 0, 2, 0, np.array([256, 0]).tobytes(), [60000], [1 << 62])],
                                    "id long, label long, dim int, home long, v binary, lows array<long>, highs array<long>")
    read = hn.chosen(blocks, anchors, False)
    assert 0 < read.count() < blocks.count() / 3
    held = blocks.join(read.select("block"), "block", "left_anti").select("ids", "vectors").collect()
    for r in held:
        assert (np.frombuffer(r.vectors, np.int64).reshape(-1, 2) @ np.array([256, 0]) < 60000).all()


def test_hilbert_curve_steps():
    side = np.array([(x, y, z) for x in range(8) for y in range(8) for z in range(8)])
    key = [r.tobytes() for r in hn.hilbert(side, 3)]
    walk = side[sorted(range(len(side)), key=key.__getitem__)]
    assert len(set(key)) == 512 and (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_product_is_exact():
    rng = np.random.default_rng(0)
    a, b = (rng.integers(-(1 << 27), 1 << 27, (5, 9)) for _ in range(2))
    assert (hn.product(a, b) == np.array([[sum(int(x) * int(y) for x, y in zip(r, s)) for s in b] for r in a])).all()
    with pytest.raises(OverflowError):
        hn.product(a << 5, b << 5)


def test_odd_rows(spark):
    rows = clustered(2, n=320, dim=3)
    odd = [(None, 1, [0.1, 0.2, 0.3]), (1000, None, [0.1, 0.2, 0.3]), (1100, 1, None), (1200, 1, [0.1, None, 0.3]),
           (1300, 1, [float("nan"), 0.0, 0.0]), (1400, 1, [float("inf"), 0.0, 0.0]), (1500, 1, []), (1501, 1, []), (1502, 2, []),
           (1600, 2, [0.5, 0.5]), (1601, 2, [0.5, 0.25]), (1602, 3, [0.25, 0.25]), (100, 0, [9.0, 9.0, 9.0]), (100, 3, [0.0, 0.0, 0.0]),
           (1700, 1, [1.0, 1.0, 1.0]), (1700, 1, [1.0, 1.0, 1.0])]
    rows = rows + odd + [(2000 + i, i % 2, [0.5, -0.5, 0.25]) for i in range(60)]
    df = spark.createDataFrame(rows, ROW).selectExpr("*", "label AS id", "'x' AS v", "1 AS block", "2 AS score")
    assert run(df, block_rows=16) == brute(rows)
    assert run(df.limit(0)) == []


def test_query(spark):
    got = QUERIES["op11_hard_negatives"](spark, SF_SMALL)
    assert dict(got.dtypes) == {"anchor_id": "bigint", "positive_id": "bigint", "rank": "int", "negative_id": "bigint",
                                "positive_score": "bigint", "negative_score": "bigint"}
    rows = [(r.vec_id, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label, r.embedding)
            for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()]
    assert sorted(tuple(r) for r in got.collect()) == brute(rows) != []
