import numpy as np
import random

import pytest

from slotwise.llm.decontaminate import contamination, keep_clean
from tests.conftest import SF_SMALL
from tests.llm.helpers import ALNUM, DOC, documents, lower, odd_rows

ITEM = "item_id long, text string"


def brute(texts, items):
    windows = {}
    for i, t in items:
        w = ALNUM.findall(lower(t))
        for k in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[k:k + 10]), set()).add(str(i))
    out = []
    for t in texts:
        w, hit, found = ALNUM.findall(lower(t)), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if got := windows.get(tuple(w[k:k + n])):
                    hit.update(range(k, k + n))
                    found |= got
        out.append((len(w), len(hit), sorted(found)))
    return out


def run(df, bench, **kw):
    return {r.doc_id: (r.n_words, r.n_hit, r["items"]) for r in contamination(df, bench, **kw).collect()}


def test_corpus(spark):
    df, bench = documents(spark, SF_SMALL), spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    rows, items = df.collect(), [(r.item_id, r.text) for r in bench.collect()]
    want = dict(zip([r.doc_id for r in rows], brute([r.text for r in rows], items)))
    assert run(df, bench) == want
    assert run(df, bench, block_bytes=1000) == want         # many benchmark blocks
    clean = {r.doc_id for r in keep_clean(df, bench, block_bytes=4000).collect()}
    assert clean == {i for i, x in want.items() if not x[1]} and len(clean) < len(want)


@pytest.mark.parametrize("seed", range(4))
def test_random(spark, seed):
    rng = random.Random(seed)
    letters = ["a", "b", "cd", "É", "x1"][:2 + seed]
    text = lambda n: rng.choice([" ", ", "]).join(rng.choice(letters) for _ in range(n))
    docs = [(i, None if i == 7 else text(rng.randint(0, 60))) for i in range(60)]
    items = [(i % 9, text(rng.choice([0, 1, 2, 3, 5, 9, 10, 12, 20]))) for i in range(12)]
    got = run(spark.createDataFrame(docs, DOC).repartition(3), spark.createDataFrame(items, ITEM), block_bytes=200)
    assert got == dict(enumerate(brute([t for _, t in docs], items)))


def test_spans_are_word_ranges(spark):
    words = [f"w{i}" for i in range(30)]
    bench = spark.createDataFrame([(1, " ".join(words[5:15])), (2, " ".join(words[14:24])), (2, None), (None, "w0")], ITEM)
    r = contamination(spark.createDataFrame([(1, " ".join(words))], DOC), bench).first()
    assert (r.spans, r["items"], r.n_hit) == ([5, 24], ["1", "2"], 19)


def test_odd_rows(spark):
    df = odd_rows(spark)
    bench = spark.createDataFrame([(1, "one"), (2, "")], ITEM)
    assert sorted(r.n_hit for r in contamination(df, bench).collect())[-2:] == [1, 1]
    assert keep_clean(df, bench).columns == df.columns
    assert keep_clean(df, bench).count() == df.count() - 2
    assert contamination(df, bench.limit(0)).where("n_hit > 0").count() == 0
    assert contamination(df.limit(0), bench).count() == 0 and keep_clean(df, bench.limit(0)).count() == df.count()


def test_a_block_fits_the_driver():
    """Memory of an index, by the byte of benchmark text."""
    import random
    import tracemalloc
    from slotwise.llm import decontaminate as dc
    rng = random.Random(1)
    items = [(f"i{k}", " ".join(f"w{rng.randint(0, 50_000)}" for _ in range(150))) for k in range(1500)]
    size = sum(len(t) for _, t in items)
    tracemalloc.start()
    ix = dc.build_index(items, dc.WINDOW, dc.SHINGLE)
    dc.choose_prefixes(ix, {s: np.zeros(len(t), np.int64) for s, t in ix.shingles.items()}, dc.SHINGLE)
    held, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert len(ix.words) > 200_000
    assert held / size * dc.BLOCK_BYTES < 250 << 20 and peak / size * dc.BLOCK_BYTES < 500 << 20
