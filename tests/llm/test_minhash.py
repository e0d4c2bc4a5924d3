import numpy as np
import pytest

from slotwise.llm import minhash as mh
from slotwise.llm.queries import QUERIES
from tests.conftest import SF_SMALL
from tests.llm.helpers import DOC, documents, odd_rows
from tests.llm.test_ngram_join import brute, near_copies


def run(df, **kw):
    return sorted(((r[0], r[1], r[2]) for r in mh.near_duplicates(df, **kw).collect()), key=repr)


def test_sketch_fills_every_bin_and_estimates():
    rng = np.random.default_rng(1)
    for size in (1, 3, 40, 900, 5000):
        for share in (0.5, 0.85):
            both = int(size * 2 * share / (1 + share)) or 1
            x = rng.integers(0, 1 << 62, 2 * size - both).astype(np.uint64)
            a, b = x[:size], x[size - both:]
            doc = np.repeat([0, 1], [len(a), len(b)])
            got = mh.sketch(doc, np.concatenate((a, b)), 3)
            assert (got[:2] != mh._EMPTY).all() and (got[2] == mh._EMPTY).all()
            j = both / len(x)
            assert abs((got[0] == got[1]).mean() - j) < 5 * np.sqrt(j * (1 - j) / mh.BINS) + 1e-9


def test_sketch_is_a_function_of_the_set():
    rng = np.random.default_rng(2)
    h = [rng.integers(0, 1 << 62, k).astype(np.uint64) for k in (1, 7, 300)]
    alone = [mh.sketch(np.zeros(len(x), int), x, 1)[0] for x in h]
    together = mh.sketch(np.repeat([2, 0, 1], [1, 7, 300]), np.concatenate(h), 3)
    assert (together[[2, 0, 1]] == np.array(alone)).all()


def test_band_rows():
    assert [mh.band_rows(p) for p in (95, 85, 30)] == [5, 4, 1]


@pytest.mark.parametrize("kw", [{}, {"pair_members": 3, "block_grams": 200}, {"pair_members": 0, "block_grams": 10**6},
                                {"rounds": 3}, {"rounds": 1, "pair_members": 10**6}])
def test_near_copies(spark, kw):
    rows = near_copies(3, groups=5)
    assert run(spark.createDataFrame(rows, DOC).repartition(4), **kw) == brute(rows, n=5)


def test_short_sets(spark):
    words = [" ".join(f"w{k}" for k in range(a, z)) for a in range(3) for z in range(a, 24)]
    rows = list(enumerate(words * 2))
    assert run(spark.createDataFrame(rows, DOC).repartition(3)) == brute(rows, n=5)


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in documents(spark, SF_SMALL).collect()]
    got = QUERIES["op13_minhash_dedup"](spark, SF_SMALL)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    got = got.collect()
    assert sorted(((r[0], r[1], r[2]) for r in got), key=repr) == brute(rows, n=5)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_other_thresholds(spark):
    rows = [(r.doc_id, r.text) for r in documents(spark, SF_SMALL).collect()]
    assert run(documents(spark, SF_SMALL), percent=50, n=2) == brute(rows, 50, 2)


def test_odd_rows(spark):
    df = odd_rows(spark)
    assert run(df) == brute([(r.doc_id, r.text) for r in df.collect()], n=5)
    assert run(df.limit(0)) == []


def test_several_texts_of_one_id(spark):
    a, b = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(30))
    rows = [(5, a), (5, b), (7, a), (3, b), (9, "other words of its own here")]
    assert run(spark.createDataFrame(rows, DOC)) == brute(rows, n=5)


def test_search_between_blocks():
    rng = np.random.default_rng(0)
    base = rng.integers(0, 1 << 60, 60).astype(np.uint64)
    sets = [np.unique(np.concatenate((base[rng.permutation(60)[:58]], rng.integers(0, 1 << 60, 1).astype(np.uint64)))) for _ in range(12)]
    block = np.array([0, 1] * 6)
    a, b = mh.search(sets, np.arange(12), block, False, 80)
    assert a and all(block[x] != block[y] for x, y in zip(a, b)) and len(a) <= 11
