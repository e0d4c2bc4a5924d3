import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from slotwise.llm import ngram_join as nj
from slotwise.llm.graph import components, most_frequent
from tests.conftest import SF_SMALL
from tests.llm.helpers import DOC, WORD, documents, lower, odd_rows


def brute(rows, percent=85, n=4):
    sets, parent = [], {}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, t in rows:
        w = WORD.findall(lower(t))
        sets.append((i, {tuple(w[k:k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())))
        if i is not None:
            parent[i] = i
    lists = defaultdict(list)
    for k, (i, g) in enumerate(sets):
        for x in g if i is not None else ():
            lists[x].append(k)
    both = Counter((v[q], v[p]) for v in lists.values() for p in range(len(v)) for q in range(p))
    for (p, q), c in both.items():
        if 100 * c >= percent * (len(sets[p][1]) + len(sets[q][1]) - c):
            a, b = sorted((root(sets[p][0]), root(sets[q][0])))
            parent[b] = a
    return sorted(((i, len(g), None if i is None else root(i)) for i, g in sets), key=repr)


def run(df, **kw):
    return sorted((tuple(r) for r in nj.jaccard_components(df, **kw).collect()), key=repr)


def near_copies(seed, groups=6, copies=12, words=30):
    rng = random.Random(seed)
    rows = []
    for g in range(groups):
        base = [f"g{g}w{rng.randint(0, 200)}" for _ in range(words)]
        for _ in range(copies):
            w = list(base)
            for _ in range(rng.randint(0, 3)):
                w[rng.randrange(words)] = f"e{rng.randint(0, 10**6)}"
            rows.append(" ".join(w))
    common = " ".join(f"line{i}" for i in range(12))
    rows += [common + " " + " ".join(f"u{k}_{i}" for i in range(rng.randint(0, 8))) for k in range(30)]
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("kw", [{}, {"short_list": 3, "block_grams": 200}, {"short_list": 1, "block_grams": 10**6}, {"occurrences": 1}])
def test_near_copies(spark, kw):
    rows = near_copies(1)
    assert run(spark.createDataFrame(rows, DOC).repartition(4), **kw) == brute(rows)


@pytest.mark.parametrize("kw", [{"round_pairs": 1}, {"short_list": 1, "block_grams": 60, "round_grams": 1, "round_pairs": 1}])
def test_rounds_find_the_same(spark, monkeypatch, kw):
    sent = []
    in_rounds = nj.in_rounds
    monkeypatch.setattr(nj, "in_rounds", lambda spark, parts: in_rounds(spark, sent.append(list(parts)) or sent[-1]))
    rows = near_copies(2)
    assert run(spark.createDataFrame(rows, DOC).repartition(4), **kw) == brute(rows)
    assert max(map(len, sent)) > 1


def test_blocks_of_other_sizes_do_not_meet(spark):
    """What a group's blocks send grows with the documents of similar size, not with all pairs of blocks."""
    member = spark.createDataFrame([(0, i, 20 + i, i) for i in range(2000)], "group long, id long, size long, comp long")
    placed = nj.in_blocks(member, 20_000).cache()
    held = sum(r.size for r in placed.collect())
    pairs = nj.block_pairs(placed, 85).collect()
    blocks = {r.block for r in placed.collect()}
    assert len(blocks) > 90 and sum(r.sent for r in pairs) < 0.4 * len(blocks) * held
    met = {(r.i, r.j) for r in pairs}
    at = {r.size: r.block for r in placed.collect()}
    assert all(tuple(sorted((at[x], at[y]))) in met for x in range(20, 2020, 7) for y in range(x, 2020) if 100 * x >= 85 * y)


def test_corpus(spark):
    df = documents(spark, SF_SMALL)
    rows = [(r.doc_id, r.text) for r in df.collect()]
    assert run(df) == brute(rows)
    assert run(df, percent=50, n=2) == brute(rows, 50, 2)


def test_odd_rows(spark):
    df = odd_rows(spark)
    assert run(df) == brute([(r.doc_id, r.text) for r in df.collect()])
    assert run(df.limit(0)) == []
    kept = nj.one_per_group(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id or -1 for r in kept.collect()) == [-1, 1, 2, 3, 4, 5, 6]


def test_several_texts_of_one_id(spark):
    a, b = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(30))
    rows = [(5, a), (5, b), (7, a), (3, b), (9, "other words of its own here")]
    df = spark.createDataFrame(rows, DOC)
    assert run(df) == brute(rows)
    assert sorted(r.doc_id for r in nj.one_per_group(df).collect()) == [3, 5, 9]        # (5, a) and (3, b) stand for their groups


def test_texts_under_one_id_are_kept_apart(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(30)) for x in "abc")
    rows = [(1, a), (2, a), (2, b), (3, c), (3, c), (3, None), (3, ""), (None, a), (None, a), (-7, c + " tail")]
    names = ["_id", "_rows", "_component", "node", "digest", "own_id", "own_node", "gone", "group", "first", "rank"]
    df = spark.createDataFrame([(*r, *range(len(names))) for r in rows], f"{DOC}, " + ", ".join(f"{x} int" for x in names))
    out = nj.one_per_group(df)
    assert out.columns == df.columns
    assert all(tuple(r)[2:] == tuple(range(len(names))) for r in out.collect())
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=repr) == sorted(
        [(1, a), (2, b), (-7, c + " tail"), (3, None), (3, ""), (None, a), (None, a)], key=repr)


def test_bucket_counts_bound_the_overlap():
    rng = np.random.default_rng(3)
    base = np.unique(rng.integers(0, 1 << 63, 900).astype(np.uint64) << np.uint64(1))
    sets = [base[:500], base[20:520], base[:470], base[400:], base[:3], base[1:2], base[:0], np.arange(2000, dtype=np.uint64)]
    sets += [np.concatenate((base[:100], sets[-1]))]
    size = np.array([len(x) for x in sets])
    counts = nj.bucket_counts(np.repeat(np.arange(len(sets)), size), np.concatenate(sets), size).to_pylist()
    bound = {}
    for p, q in [(p, q) for p in range(len(sets)) for q in range(len(sets))]:
        row = pa.RecordBatch.from_pydict({"a": [p], "b": [q], "sx": [len(sets[p])], "sy": [len(sets[q])], "x": [counts[p]], "y": [counts[q]]})
        both = len(np.intersect1d(sets[p], sets[q]))
        for percent in (20, 50, 85, 95):
            kept = sum(x.num_rows for x in nj._screen(percent)([row]))
            assert kept or 100 * both < percent * (len(sets[p]) + len(sets[q]) - both)
            bound[p, q, percent] = kept
    assert bound[0, 1, 85] and bound[0, 2, 85] and not bound[0, 3, 85] and not bound[1, 3, 50]


def test_search_between_blocks():
    rng = np.random.default_rng(0)
    base = rng.integers(0, 1 << 60, 60).astype(np.uint64)
    sets = [np.unique(np.concatenate((base[rng.permutation(60)[:57]], rng.integers(0, 1 << 60, 2).astype(np.uint64)))) for _ in range(12)]
    block = np.array([0, 1] * 6)
    a, b = nj.search(sets, np.arange(12), block, False, 80, 3)
    assert a and all(block[x] != block[y] for x, y in zip(a, b))


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 90), (90, 90)], "a long, b long")
    got = {r.node: r.component for r in components(links).collect()}
    assert got == {**{i: 0 for i in range(41)}, 90: 90, 100: 90}


def test_most_frequent(spark):
    counts = spark.createDataFrame([(i, n) for i, n in enumerate([1] * 50 + [2] * 5 + [3, 7, 1000, 1001])], "w long, n long")
    assert sorted(r.n for r in most_frequent(counts, 4).collect()) == [3, 7, 1000, 1001]
    assert most_frequent(counts, 10).count() == 9 and most_frequent(counts, 100).count() == 59
    assert most_frequent(counts, 1).count() <= 1 and most_frequent(counts.limit(0), 5).count() == 0
