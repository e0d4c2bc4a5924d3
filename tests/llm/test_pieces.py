import random

import public_tokenizers as P
import sentencepiece

from slotwise.llm.pieces import Transducer, decode, encode
from tests.conftest import SF_SMALL
from tests.llm.helpers import documents, odd_rows

MODEL = P.path("piece_bpe_32k.model")
LIB = sentencepiece.SentencePieceProcessor(model_file=MODEL)
ALPHABETS = [" ab\nthe▁", list(" ▁"), "the quick brown fox over 123 éüß漢字🙂\n\t  ", "abcdefghijklmnopqrstuvwxyz "]


def test_random_texts_match_library_and_return():
    t, rng = Transducer(MODEL), random.Random(3)
    for k in range(4000):
        s = "".join(rng.choice(ALPHABETS[k % 4]) for _ in range(rng.randint(0, 40)))
        ids = t.encode(s).tolist()
        assert ids == LIB.encode(s)
        assert t.decode(ids) == LIB.decode(ids)
        if "▁" not in s:
            assert t.decode(ids) == s


def test_batches_of_new_words():
    t, rng = Transducer(MODEL), random.Random(5)
    texts = ["".join(rng.choice("  aeinrstlou,.ABé\n") for _ in range(200)) for _ in range(300)] + ["", " ", "▁▁ a"]
    for _ in range(2):          # solved together, then from the cache
        assert [x.tolist() for x in t.encode_batch(texts)] == LIB.encode(texts)


def test_long_word_and_broken_bytes():
    t = Transducer(MODEL)
    s = "".join(random.Random(4).choice("etaoinshr") for _ in range(5000))
    assert t.encode(s).tolist() == LIB.encode(s)
    broken = [t.byte[0xE6], t.byte[0x41]]
    assert t.decode(broken) == LIB.decode(broken)
    assert t.decode([1, *t.encode("a b").tolist(), 2]) == "a b"


def test_corpus(spark):
    df = documents(spark, SF_SMALL)
    texts = {r.doc_id: r.text for r in df.collect()}
    for r in decode(encode(df, MODEL, decoded_col="same_pass"), MODEL).collect():
        assert r.ids == LIB.encode(texts[r.doc_id]) and r.decoded == r.same_pass == texts[r.doc_id]


def test_odd_rows(spark):
    df = odd_rows(spark)
    rows = decode(encode(df, MODEL), MODEL).collect()
    assert sorted(r.decoded for r in rows) == sorted(r.text or "" for r in df.collect())
    assert encode(df.limit(0), MODEL).count() == 0
