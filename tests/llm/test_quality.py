import random
from collections import Counter

from slotwise.llm.quality import QualityRules, keep_good, quality
from tests.conftest import SF_SMALL
from tests.llm.helpers import DOC, WORD, documents, odd_rows


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    grams = Counter(tuple(words[k:k + 8]) for k in range(len(words) - 7))
    hit = {i for k in range(len(words) - 7) if grams[tuple(words[k:k + 8])] > 1 for i in range(k, k + 8)}
    failed = len(words) < 20 or 100 * len(hit) > 30 * len(words)
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(hit), failed


def check(df):
    got = {r.doc_id: tuple(r)[1:7] for r in quality(df).collect()}
    assert got == {r.doc_id: brute(r.text) for r in df.collect()}


def test_counts_match_brute_force(spark):
    check(documents(spark, SF_SMALL))


def test_random_texts(spark):
    rng = random.Random(1)
    rows = [(i, "".join(rng.choice(["a ", "b ", "c", "\n", "é ", "# ", "a b c d e f g h\n"]) for _ in range(rng.randint(0, 80)))) for i in range(200)]
    check(spark.createDataFrame(rows, DOC))


def test_odd_rows(spark):
    df = odd_rows(spark)
    rows = quality(df).collect()
    assert len(rows) == df.count()
    assert all(not r.kept for r in rows if r.n_words < 20)
    assert keep_good(df).columns == df.columns
    assert quality(df.limit(0)).count() == 0 and keep_good(df.limit(0)).count() == 0


def test_repetition_rejects_and_prose_stays(spark):
    prose = " ".join(f"w{i}" for i in range(200))
    line = " ".join(f"x{i}" for i in range(5))
    rows = [(1, prose), (2, "\n".join([line] * 20) + " " + prose[:100]), (3, "a | b | " * 30 + prose[:40])]
    kept = {r.doc_id for r in keep_good(spark.createDataFrame(rows, DOC)).collect()}
    assert kept == {1}


def test_ceilings_are_parameters(spark):
    line = " ".join(f"x{i}" for i in range(6))
    text = "\n".join([line, " ".join(f"y{i}" for i in range(60)), line])
    df = spark.createDataFrame([(1, text)], DOC)
    assert keep_good(df).count() == 1
    assert keep_good(df, QualityRules(ngram_ceilings={5: 0.01})).count() == 0
