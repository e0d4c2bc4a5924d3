import os
import random
from collections import Counter

import numpy as np
import pytest

from slotwise.llm import suffix_dedup as sd
from slotwise.llm.suffix_sort import common, deep_shallow
from tests.conftest import SF_SMALL
from tests.llm.helpers import DOC, WORD, documents, odd_rows


def brute(rows, length):
    texts = [(i, (t or "").encode()) for i, t in rows]
    count = Counter(b[k:k + length] for _, b in texts for k in range(len(b) - length + 1))
    out = []
    for i, b in texts:
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - length + 1):
            if count[b[k:k + length]] > 1:
                gone[k:k + length] = True
        edge = np.flatnonzero(np.diff(np.concatenate(([0], gone.astype(int), [0])))).tolist()
        out.append((i, len(b), edge, bytes(np.frombuffer(b, np.uint8)[~gone])))
    return sorted(out, key=repr)


def run(df, **kw):
    return sorted(((r.doc_id, r.n_bytes, r.ranges, bytes(r.kept)) for r in sd.remove_repeats(df, **kw).collect()), key=repr)


def test_deep_shallow_sorts_with_common_prefixes():
    rng = random.Random(4)
    for _ in range(600):
        letters = b"ab"[:rng.randint(1, 2)]
        s = [bytes(rng.choice(letters) for _ in range(rng.choice([0, 1, 5, 30, 200]))) for _ in range(rng.randint(1, 12))]
        s = [b"x" * 20 + x for x in s] if rng.random() < 0.5 else s
        order, lcp = deep_shallow(s, shallow=rng.choice([0, 8, 16, 64]))
        assert [s[i] for i in order] == sorted(s)
        assert lcp[1:] == [len(os.path.commonprefix([s[a], s[b]])) for a, b in zip(order, order[1:])]
    assert common(b"abc", b"abd") == 2 and common(b"", b"a") == 0


def test_leftmost_minimum():
    h = np.random.default_rng(0).integers(0, 6, 500).astype(np.uint64)
    for w in (1, 3, 7, 50):
        assert sd._leftmost_min(h, w).tolist() == [int(i + np.argmin(h[i:i + w])) for i in range(len(h) - w + 1)]


@pytest.mark.parametrize("seed,block", [(1, 2), (2, 5), (3, 1000)])
def test_random_texts(spark, seed, block):
    rng = random.Random(seed)
    pool = ["".join(rng.choice(["ab", "c", "é", "x y", "zz"]) for _ in range(rng.randint(5, 60))) for _ in range(12)]
    rows = [(i % 35, None if rng.random() < 0.05 else "".join(
        rng.choice(pool) + rng.choice(["", "q", "w" * rng.randint(0, 3), str(i)]) for _ in range(rng.randint(0, 6)))) for i in range(40)]
    rows += [rows[3], rows[3], (50, "ab" * 300), (51, "ab" * 100 + "c"), (52, "")]
    df = spark.createDataFrame(rows, DOC).repartition(3)
    assert run(df, length=40, gram=8, block_runs=block) == brute(rows, 40)


def test_corpus(spark):
    df = documents(spark, SF_SMALL)
    assert run(df) == brute([(r.doc_id, r.text) for r in df.collect()], sd.LENGTH)


def test_hot_passage(spark):
    """Many texts share a passage between words of their own."""
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    passage = " ".join(word() for _ in range(12))
    rows = [(i, " ".join(word() for _ in range(rng.randint(0, 9))) + passage + " ".join(word() for _ in range(rng.randint(0, 9)))) for i in range(80)]
    df = spark.createDataFrame(rows, DOC).repartition(5)
    assert run(df, length=60, gram=16, block_runs=7) == brute(rows, 60)


def test_odd_rows(spark):
    df = odd_rows(spark)
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect() if len(r.text or "") < 10_000]
    small = df.where("text is null or length(text) < 10000")
    assert run(small, length=8, gram=2) == brute(rows, 8)
    long = run(df.where("length(text) > 10000"))[0]
    assert long[1] == 330_000 and long[2] == [0, 330_000]       # one phrase over and over
    assert run(df.limit(0)) == []


def test_copies_are_sent_once(spark, monkeypatch):
    rng = random.Random(12)
    word = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    shared, ends = word(300), [word(60) for _ in range(2)]
    rows = [(i, shared + ends[0]) for i in range(200)] + [(300, ends[1] + shared), (301, word(400))]
    df = spark.createDataFrame(rows, DOC).repartition(4)
    sent, made = spark.sparkContext.accumulator(0), sd._sort_runs

    def counted(length):
        inner = made(length)

        def run(batches):
            def see():
                for b in batches:
                    sent.add(b.num_rows)
                    yield b
            return inner(see())
        return run

    monkeypatch.setattr(sd, "_sort_runs", counted)
    got = run(df, length=40, gram=8)
    assert got == brute(rows, 40)
    assert 0 < sent.value < 200


def brute_passages(rows, words):
    """Words in runs of ``words`` + 1 or more that stand twice; runs that touch count together."""
    split = [WORD.findall(t or "") for _, t in rows]
    seen = Counter(tuple(w[k:k + words + 1]) for w in split for k in range(len(w) - words))
    out = []
    for (i, _), w in zip(rows, split):
        hit = [False] * len(w)
        for k in range(len(w) - words):
            if seen[tuple(w[k:k + words + 1])] > 1:
                hit[k:k + words + 1] = [True] * (words + 1)
        out.append((i, sum(hit)))
    return sorted(out, key=repr)


def test_passages(spark):
    rng = random.Random(4)
    word = lambda: rng.choice("abcdefghij") * rng.randint(1, 4)
    pool = [" ".join(word() for _ in range(n)) for n in (5, 6, 7, 12, 30)]
    rows = [(i, "\n".join(rng.choice(pool) if rng.random() < 0.3 else " ".join(word() for _ in range(rng.randint(0, 9)))
                          for _ in range(rng.randint(0, 5)))) for i in range(60)] + [(70, None), (71, ""), (72, "a b " * 40)]
    df = spark.createDataFrame(rows, DOC).repartition(3)
    got = sd.remove_repeats(df, passage_words=5).select("doc_id", "n_passage_words").collect()
    assert sorted(((r[0], r[1]) for r in got), key=repr) == brute_passages(rows, 5)


def test_passages_of_the_corpus(spark):
    df = documents(spark, SF_SMALL)
    got = sd.remove_repeats(df).select("doc_id", "n_passage_words").collect()
    want = brute_passages([(r.doc_id, r.text) for r in df.collect()], sd.PASSAGE_WORDS)
    assert sorted((tuple(r) for r in got), key=repr) == want and any(n for _, n in want)


def test_sifting_changes_no_range(spark):
    df = documents(spark, SF_SMALL).select("text").where("text is not null")
    got = [sorted((bytes(r.text_id), r.ranges) for r in sd.repeated_ranges(df, 200, 32, sift=s).collect()) for s in (False, True)]
    assert got[0] == got[1] and len(got[0]) > 20
    bits = sd.repeated_grams(df, 200, 32)
    assert len(bits) == (1 << sd.SIFT_BITS) // 8 and 0 < np.unpackbits(bits).sum() < 200_000
