from collections import Counter

import public_tokenizers as P
import pytest
import sentencepiece

import __spark_entry__ as E
import corpus_pipeline
from slotwise.llm.quality import QualityRules
from tests.conftest import SF_SMALL
from tests.llm import test_decontaminate, test_ngram_join, test_pii, test_quality
from tests.llm.helpers import WORD, documents, odd_rows

LIB = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))


def good(text):
    rules = QualityRules()
    n_words, chars, symbols, _, _, failed = test_quality.brute(text)
    if failed or symbols > rules.symbol_ceiling * n_words:
        return False
    words = WORD.findall(text)
    for n, ceiling in rules.ngram_ceilings.items():
        grams = Counter(tuple(words[k:k + n]) for k in range(len(words) - n + 1))
        hit = {i for k in range(len(words) - n + 1) if grams[tuple(words[k:k + n])] > 1 for i in range(k, k + n)}
        if sum(len(words[i]) for i in hit) > ceiling * chars:
            return False
    seen, again = set(), 0
    for line in text.split("\n"):
        w = WORD.findall(line)
        if w:
            again += sum(map(len, w)) if line in seen else 0
            seen.add(line)
    return again <= rules.line_ceiling * chars


def clean(text):
    out, at = [], 0
    for span in filter(None, test_pii.brute(text).split(",")):
        kind, a, z = span.split(":")
        if int(a) >= at:
            out.append(text[at:int(a)] + f"<{kind.upper()}>")
        at = max(at, int(z))
    return "".join(out) + text[at:]


def test_pipeline_matches_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in documents(spark, SF_SMALL).collect()]
    rows = [(i, t) for i, t in rows if good(t)]
    smallest = {i for i, _, c in test_ngram_join.brute(rows, 80, 5) if c == i}
    rows = [(i, t) for i, t in rows if i in smallest]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    hits = test_decontaminate.brute([t for _, t in rows], items)
    rows = [(i, clean(t)) for (i, t), h in zip(rows, hits) if not h[1]]
    got = corpus_pipeline.run(spark, SF_SMALL)
    assert got.columns == ["doc_id", "n_pieces", "ids", "text"]
    want = sorted((i, LIB.encode(t), t) for i, t in rows)
    assert sorted((r.doc_id, r.ids, r.text) for r in got.collect()) == want
    assert 100 < len(want) < 200


def test_stages_keep_columns_and_take_odd_rows(spark):
    docs = odd_rows(spark)
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        for df in (docs, docs.limit(0)):
            out = stage(spark, df, SF_SMALL)
            assert k == len(corpus_pipeline.STAGES) - 1 or out.columns == docs.columns
            out.collect()


def test_registered():
    names = E.queries()
    for n in range(1, 14):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert "pipeline" in names
    assert set(E.oracle_sql()) <= set(names)


@pytest.mark.parametrize("name", ["op1_ngram_jaccard_join", "op2_url_filter", "op8_decontamination", "op11_hard_negatives", "op13_minhash_dedup"])
def test_sql(spark, name):
    import duckdb
    from scripts.check_oracle import digest
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    df = E.queries()[name](spark, SF_SMALL)
    rel = con.sql(E.oracle_sql()[name])
    assert digest([tuple(r) for r in df.collect()], df.columns)[0] == digest(rel.fetchall(), rel.columns)[0]
