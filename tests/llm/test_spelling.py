import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from slotwise.llm import spelling as sp
from slotwise.llm.queries import QUERIES
from tests.conftest import SF_SMALL
from tests.llm.helpers import DOC, documents, lower, odd_rows


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def brute(counts, ratio=2):
    near = {w: [] for w in counts}
    names = set(counts)
    letters = {c for w in names for c in w}
    for w in names:                                     # deletions and replacements reach every pair from one side
        for k in range(len(w)):
            for v in {w[:k] + w[k + 1:]} | {w[:k] + c + w[k + 1:] for c in letters}:
                if v in names and v != w:
                    near[w].append(v)
                    if len(v) < len(w):
                        near[v].append(w)
    out = {}
    for w, n in counts.items():
        both = set(near[w])
        best = min(both, key=lambda v: (-counts[v], v), default=None)
        form = best if best is not None and counts[best] >= ratio * n else None
        out[w] = (form, n, len(both), None if form is None else counts[form])
    rows = []
    for w, (form, n, k, fn) in out.items():
        root = w
        while out[root][0] is not None:
            root = out[root][0]
        rows.append((w, form, root, n, k, fn))
    return sorted(rows, key=repr)


def run(spark, counts, **kw):
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    return sorted((tuple(r) for r in sp.variants(df, **kw).collect()), key=repr)


def dense(seed, alphabet, low, high, size):
    rng = random.Random(seed)
    words = {"".join(rng.choice(alphabet) for _ in range(rng.randint(low, high))) for _ in range(size)}
    for w in sorted(words)[: size // 3]:
        k = rng.randrange(len(w))
        words.add(w[:k] + rng.choice(alphabet) + w[k + 1:])
        words.add(w[:k] + rng.choice(alphabet) + w[k:])
    return {w: rng.choice((3, 3, 4, 7, 15, 40, 40, 200)) for w in words if len(w) >= low}


@pytest.mark.parametrize("block_words", [sp.BLOCK_WORDS, 40, 7])
@pytest.mark.parametrize("alphabet, low, high", [("ab", 5, 8), ("abcéÿ", 5, 6), ("abcdefgh", 2, 9)])
def test_dense_vocabularies(spark, alphabet, low, high, block_words):
    counts = dense(1, alphabet, low, high, 300)
    assert run(spark, counts, block_words=block_words) == brute(counts)


def test_slices_and_flushes(spark, monkeypatch):
    counts = dense(2, "abc", 5, 8, 400)
    x = sp.matrix(sorted(w for w in counts if len(w) in (6, 7)), 7)
    yes = np.ones(len(x), bool)
    whole = sorted(zip(*(v.tolist() for v in sp.near_pairs(x, 6, x[:, 6] == 0, yes))))
    monkeypatch.setattr(sp, "STATES", 5)
    assert sorted(zip(*(v.tolist() for v in sp.near_pairs(x, 6, x[:, 6] == 0, yes)))) == whole != []


def contract(rows):
    counts = Counter()
    for i, t in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = lower(w)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % 97 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            counts[w] += 1
    return brute({w: n for w, n in counts.items() if len(w) >= 5 and n >= 3})


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in documents(spark, SF_SMALL).collect()]
    got = QUERIES["op12_spelling_variants"](spark, SF_SMALL)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == contract(rows)


def test_odd_rows(spark, tmp_dir):
    df = odd_rows(spark).unionByName(spark.createDataFrame(
        [(7, "straße Straße STRASSE strasse 3straße", "n", 1), (8, "x" * 30_000 + " " + "x" * 29_999 + "y", "n", 1)] * 3, odd_rows(spark).schema))
    df.write.parquet(f"{tmp_dir}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in df.collect()]
    got = QUERIES["op12_spelling_variants"](spark, tmp_dir)
    small = {w: n for w, n in ((r.word, r.n) for r in got.collect()) if len(w) < 100}
    counts = Counter(w for i, t in rows for w in re.findall("[a-zÀ-ÿ]{5,}", lower(t)) if len(w) < 100
                     and zlib.crc32(f"{'' if i is None else i}:{w}".encode()) % 97)
    assert small == {w: n for w, n in counts.items() if n >= 3} and "straße" in small
    assert {r.word[-1]: r.n_near for r in got.collect() if len(r.word) > 100} == {"x": 1, "y": 1}
    assert sp.variants(sp.count_words(sp.runs(df.limit(0)).withColumnRenamed("run", "word"))).collect() == []


def test_long_words_one_edit_apart(spark):
    a = "ab" * 6000
    counts = {a: 9, a[:7000] + "x" + a[7000:]: 3, "c" + a[1:]: 4, a + "qq": 5}
    assert run(spark, counts) == brute_pairs(counts)


def brute_pairs(counts):
    rows = []
    for w, n in counts.items():
        near = [v for v in counts if v != w and one_edit(v, w)]
        best = min(near, key=lambda v: (-counts[v], v), default=None)
        form = best if best is not None and counts[best] >= 2 * n else None
        rows.append((w, form, form or w, n, len(near), None if form is None else counts[form]))
    return sorted(rows, key=repr)


def test_counts_and_deletions(spark):
    df = spark.createDataFrame([(1, "Abcde ABCDE abcdé× xabcd"), (2, None)], DOC)
    assert sorted((r.word, r.n) for r in sp.count_words(sp.runs(df), "run", min_count=1).collect()) == [("abcde", 2), ("abcdé×", 1), ("xabcd", 1)]
