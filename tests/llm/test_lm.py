import math
import zlib
from collections import Counter

import numpy as np

from slotwise.llm import bytewords as bw
from slotwise.llm import lm
from tests.conftest import SF_CHECK, SF_SMALL
from tests.llm.helpers import DOC, WORD, documents, lower, odd_rows


def brute(rows):
    words = [(i, [*WORD.findall(lower(t)), None], zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2) for i, t in rows]
    c = Counter(w for _, ws, out in words if not out for w in ws)
    n, v = sum(c.values()), len(c)
    return [(i, out, len(ws), sum(c[w] > 0 for w in ws), n, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws)) for i, ws, out in words]


def check(df):
    got = sorted(([*r] for r in lm.score(df).collect()), key=repr)
    want = sorted(([*r] for r in brute([(r.doc_id, r.text) for r in df.collect()])), key=repr)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:5] == w[:5] and abs(g[5] - w[5]) <= 1e-9 * abs(w[5]) + 1e-12
        assert math.isfinite(g[6]) and g[6] <= 0


def test_base_matches_brute_force(spark):
    check(documents(spark, SF_SMALL))


def test_words_outside_the_frequent_ones(spark, monkeypatch):
    monkeypatch.setattr(lm, "FREQUENT", 400)
    monkeypatch.setattr(lm, "BANDS", (350, 380))
    check(documents(spark, SF_SMALL))


def test_model_beats_base_on_held_out_texts(spark):
    rows = lm.score(documents(spark, SF_CHECK)).where("held_out").collect()
    assert sum(r.score for r in rows) > 0.985 * sum(r.base_score for r in rows)
    assert sum(r.score > r.base_score for r in rows) > 0.9 * len(rows)


def test_probabilities_add_up_to_one(spark):
    docs = documents(spark, SF_SMALL).select("doc_id", "text").toDF("id", "text")
    vocab = lm.vocabulary(docs, 2).cache()
    m = lm.train(docs, lm.start_model(vocab), 2)
    assert np.abs(m.weights).max() > 0
    words = np.array([r.w for r in vocab.collect()], np.int64).view(np.uint64)
    b = lm.read(bw.parse([b"the and"], bw.SPACED, True), m)
    # the same history for every word of the vocabulary and one unseen
    every = np.append(words, np.uint64(12345))
    n = len(every)
    rank, count = np.full(n, -1), np.zeros(n, np.int64)
    i, k = bw.lookup(m.word, every)
    rank[i], count[i] = m.rank[k], m.count[k]
    cls = lm.CLASSES + np.searchsorted(np.array([*lm.BANDS, lm.FREQUENT]), rank, side="right")
    named = (rank >= 0) & (rank < lm.CLASSES * lm.WIDTH)
    cls[named] = rank[named] // lm.WIDTH
    cls[rank < 0] = lm.N_CLASSES - 1
    batch = lm.Batch(np.arange(n + 1), every, count, rank, cls, np.repeat(b.features[:, 1:2], n, axis=1))
    _, _, score, _ = lm.score_chunk(batch, m)
    assert abs((10 ** score).sum() - 1) < 1e-4


def each_token(b, token=None, cls=None, rank=None, count=None, at=None):
    """The batch with every token a text of its own."""
    n = len(b.token if token is None else token)
    features = b.features if at is None else np.repeat(b.features[:, at:at + 1], n, axis=1)
    return lm.Batch(np.arange(n + 1), *(y if x is None else x for x, y in ((token, b.token), (count, b.count), (rank, b.rank), (cls, b.cls))), features)


def test_history_tells_the_words_of_a_band_apart(spark):
    filler = " ".join(f"f{i} f{i} f{i}" for i in range(400))
    text = filler + " " + " ".join(f"x{k} y{k}" for k in range(40))
    docs = spark.createDataFrame([(i, text) for i in range(60)], "id long, text string").repartition(2)
    m = lm.train(docs, lm.start_model(lm.vocabulary(docs, 2)), 2)
    pairs = [(k, (k + 7) % 40) for k in range(40)]
    b = lm.read(bw.parse([f"x{k} y{j}".encode() for p in pairs for k, j in ((p[0], p[0]), p)], bw.SPACED, True), m)
    assert b.rank[1::3].min() >= lm.CLASSES * lm.WIDTH and len(set(b.cls[1::3])) == 1 and len(set(b.count[1::3])) == 1
    score = lm.score_chunk(each_token(b), m)[2][1::3]
    assert (score[::2] > score[1::2]).all()      # the word that follows, against another of the same band and count


def test_tail_adds_up_to_one_and_depends_on_history(spark, monkeypatch):
    monkeypatch.setattr(lm, "FREQUENT", 400)
    monkeypatch.setattr(lm, "BANDS", (400, 400))
    docs = documents(spark, SF_SMALL).select("doc_id", "text").toDF("id", "text")
    vocab = lm.vocabulary(docs, 2).cache()
    m = lm.train(docs, lm.start_model(vocab), 2)
    rows = vocab.collect()
    words, counts = np.array([r.w for r in rows], np.int64).view(np.uint64), np.array([r.n for r in rows])
    bits = len(m.group).bit_length() - 1
    assert len(words) - len(m.word) > 1000 and len(m.group) >= len(words) - len(m.word)
    unseen = (np.arange(len(m.group), dtype=np.uint64) << np.uint64(64 - bits)) + np.uint64(12345)
    every = np.append(words, unseen)
    rank = np.full(len(every), -1)
    i, k = bw.lookup(m.word, every)
    rank[i] = m.rank[k]
    cls = np.where(rank < 0, lm.N_CLASSES - 1, lm.CLASSES)
    named = (rank >= 0) & (rank < lm.CLASSES * lm.WIDTH)
    cls[named] = rank[named] // lm.WIDTH
    b = lm.read(bw.parse([b"the and of"], bw.SPACED, True), m)
    found = []
    for at in (1, 2):
        _, _, score, _ = lm.score_chunk(each_token(b, every, cls, rank, np.zeros(len(every), np.int64), at), m)
        tail = rank[:len(words)] < 0
        score[:len(words)][tail] += np.log10(counts[tail] + 1)
        assert abs((10 ** score).sum() - 1) < 1e-4
        found.append(score[:len(words)][tail])
    shift = found[0] - found[1]
    assert shift.std() > 1e-3


def test_odd_rows(spark):
    check(odd_rows(spark))
    assert lm.score(spark.createDataFrame([], DOC)).count() == 0
