import random

import public_tokenizers as P
from tokenizers import Tokenizer

from slotwise.llm.token_counts import Encoder, count_tokens
from tests.conftest import SF_SMALL
from tests.llm.helpers import DOC, documents, odd_rows

PATH = P.path("byte_bpe_50k.json")


def library(texts):
    t = Tokenizer.from_file(PATH)
    return [len(e.ids) for e in t.encode_batch(texts, add_special_tokens=False)]


def test_corpus_matches_library(spark):
    df = documents(spark, SF_SMALL)
    rows = df.select("doc_id", "text").collect()
    want = dict(zip([r.doc_id for r in rows], library([r.text or "" for r in rows])))
    for size in (0, 1 << 10):
        got = count_tokens(df, PATH, P.PATTERN, table_size=size).collect()
        assert {r.doc_id: r.n_tokens for r in got} == want
        assert all(r.over_limit == (r.n_tokens > 512) for r in got)


def test_every_low_character_cuts_alike():
    e = Encoder(PATH, P.PATTERN)
    texts = [s for cp in range(0x250) for s in (f"a{chr(cp)}b", f"  {chr(cp)}1{chr(cp)} x", f"{chr(cp)}{chr(cp)} ")]
    assert e.counts(texts, {}) == library(texts)


def test_random_texts_with_special_strings():
    rng = random.Random(3)
    alphabet = list(" \n\t'sdre1é漢🙂\x1c\x85\xa0!?") + ["<|endoftext|>"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 14))) for _ in range(3000)]
    assert Encoder(PATH, P.PATTERN).counts(texts, {}) == library(texts)


def test_odd_rows(spark):
    df = odd_rows(spark)
    got = count_tokens(df, PATH, P.PATTERN).collect()
    assert sorted((r.n_bytes, r.n_tokens) for r in got) == sorted(
        (len((r.text or "").encode()), library([r.text or ""])[0]) for r in df.collect())
    assert count_tokens(df.limit(0), PATH, P.PATTERN).count() == 0
    assert count_tokens(spark.createDataFrame([(1, None)], DOC), PATH, P.PATTERN).first().n_tokens == 0
