import hashlib
import math
import random
import re
from collections import defaultdict

from pyspark.sql import functions as F

from slotwise.llm import pii
from slotwise.llm.pii import Disclosure, base_spans, find_pii, sanitise, span_text
from tests.conftest import SF_SMALL
from tests.llm.helpers import DOC, documents, odd_rows

BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(d):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def brute(text):
    out = []
    for k, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text or ""):
            v, d = m.group(), re.sub("[^0-9]", "", m.group())
            if {"email": True, "ip": kind != "ip" or all(int(x) <= 255 for x in v.split(".")),
                    "card": 12 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]:
                out.append((m.start(), k, m.end()))
    return ",".join(f"{list(BASE)[k]}:{a}:{z}" for a, k, z in sorted(out))


def spans(df):
    return dict(base_spans(df, "text", "base").select("doc_id", span_text(F.col("base"))).collect())


def test_random_texts(spark):
    rng = random.Random(6)
    parts = ["a", "b.", "@", "x.y", "1", "23", ".", "-", " ", "+", "(", ")", "é", "4", "411", "10.0.0.1", "0256.1.1.001", "+1 (988) 555-2485",
             "4041894974608795", "a@b.co", "_", "%", "🙂", "\n", "0"]
    texts = [None, "", "a" * 20000, "1" * 20000, "1 " * 8000, "1-2" * 5000, "a@" * 3000]
    texts += ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(1500)]
    got = spans(spark.createDataFrame(list(enumerate(texts)), DOC))
    assert got == {i: brute(t) for i, t in enumerate(texts)}


def test_corpus(spark):
    df = documents(spark, SF_SMALL)
    assert spans(df) == {r.doc_id: brute(r.text) for r in df.collect()}


def test_query_counts_each_kind(spark, tmp_dir):
    from slotwise.llm.queries import QUERIES
    texts = ["", None, "a@b.co", "x@y.z then a@b.co, 1.2.3.4", "+1 (988) 555-2485", "4041894974608795 1.1.1.1 2.2.2.2 a@b.co",
             "1.1.1.1 and +1 (988) 555-2485 and +1 (988) 555-2486"]
    spark.createDataFrame(list(enumerate(texts)), DOC).write.parquet(f"{tmp_dir}/documents.parquet")
    got = {r.doc_id: r for r in QUERIES["op9_pii"](spark, tmp_dir).collect()}
    assert sorted(got) == list(range(len(texts)))
    for i, text in enumerate(texts):
        kinds = [s.split(":")[0] for s in brute(text).split(",")]
        assert [got[i][f"n_{k}"] for k in BASE] == [kinds.count(k) for k in BASE]
        assert got[i].base_sha256 == hashlib.sha256(brute(text).encode()).hexdigest()


def corpus(spark):
    """A nickname that gives one address away, and near copies around another."""
    rng = random.Random(7)
    words = lambda n: " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(n))
    rows = [(i, f"{words(20)} Zorbinak, writes from zor@acme.org {words(20)}") for i in range(8)]
    rows += [(10 + i, f"{words(10)} quote ZORBINAK here {words(10)}") for i in range(2)]
    rows += [(100 + i, f"{words(30)} writes from {words(30)}") for i in range(300)]
    near = words(40).split()
    for i in range(30):
        w = list(near)
        w[rng.randrange(40)] = f"edit{i}"
        rows.append((500 + i, " ".join(w[:20]) + " copy@acme.org " + " ".join(w[20:])))
    return spark.createDataFrame(rows, DOC)


def test_terms_that_disclose(spark):
    found = {r.doc_id: r.s for r in find_pii(corpus(spark)).select("doc_id", F.filter("spans", lambda s: s["rank"] == 4)["value"].alias("s")).collect()}
    assert all(found[i] == ["generalised"] for i in [*range(8), 10, 11])        # also where the address is absent
    assert not any(v for i, v in found.items() if i >= 100)                     # copies are one context
    rows = {r.doc_id: r.text for r in sanitise(corpus(spark)).collect()}
    assert " <NAME>, writes from <EMAIL> " in rows[0] and "quote <NAME> here" in rows[10]
    removed = {r.doc_id: r.text for r in sanitise(corpus(spark), Disclosure(remove_share=0.7)).collect()}
    assert "<REMOVED>, writes" in removed[0]


def copies(spark):
    """A nickname in independent texts, and many copies of one of them and of a
    text that holds the nickname alone."""
    rng = random.Random(8)
    words = lambda n: " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(n))
    rows = [(i, f"{words(20)} Zorbinak, writes from zor@acme.org {words(20)}") for i in range(10)]
    rows += [(100 + i, f"{words(30)} writes from {words(30)}") for i in range(300)]
    rows += [(1000 + i, rows[0][1]) for i in range(40)]
    alone = f"{words(10)} quote ZORBINAK here {words(10)}"
    rows += [(2000 + i, alone) for i in range(40)]
    return spark.createDataFrame(rows, DOC)


def test_copies_do_not_switch_a_term_off(spark):
    found = {r.doc_id: r.s for r in find_pii(copies(spark)).select("doc_id", F.filter("spans", lambda s: s["rank"] == 4)["value"].alias("s")).collect()}
    assert all(v == (["removed"] if i < 10 or i >= 1000 else []) for i, v in found.items())     # 10 of 11 texts


def brute_terms(texts, rule=Disclosure()):
    """term: largest share, over whole distinct texts. Texts have no e-mail but their mentions."""
    words = lambda t: [w for w in re.split(r"[^\w]+", t.lower()) if len(w) >= 3]
    held, mention, contexts = defaultdict(set), defaultdict(set), defaultdict(list)
    texts = sorted(set(texts))
    for k, t in enumerate(texts):
        for w in words(re.sub(BASE["email"], " ", t)):
            held[w].add(k)
        for m in re.finditer(BASE["email"], t):
            mention[m.group().lower()].add(k)
            contexts[m.group().lower()].append((k, frozenset(words(t[:m.start()])[-6:] + words(t[m.end():])[:6])))
    out = {}
    for w, in_texts in held.items():
        for e, docs in mention.items():
            joint = len(in_texts & docs)
            different = len({c - {w} for k, c in contexts[e] if k in in_texts})
            share = joint / len(in_texts)
            if (joint and different >= rule.min_contexts and different >= rule.independent * joint and share >= rule.min_share
                    and math.log2(share * len(texts) / len(docs)) >= rule.min_bits):
                out[w] = max(out.get(w, 0), share)
    return out


def letters(rng):
    """Letters whose salutation names the writer, far from the address."""
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(3))
    some = lambda n: " ".join(word() for _ in range(n))
    names = ["Zorbinak", "Quellith", "Vrandor", "Oskupel"]
    texts = []
    for name in names:
        for i in range(rng.randint(4, 9)):
            texts.append(f"{name} greets you. {some(20)} {rng.choice(names) if i % 4 == 3 else ''} {some(8)} mail {name[:3]}@acme.org {some(15)}")
    texts += [f"{some(12)} {rng.choice(names)} {some(12)}" for _ in range(6)] + [some(30) for _ in range(400)]
    return texts + texts[:5] * 6


def test_terms_of_whole_texts_match_brute_force(spark):
    texts = letters(random.Random(9))
    want = brute_terms(texts)
    assert {"zorbinak", "quellith", "vrandor", "oskupel"} & set(want)
    found = base_spans(spark.createDataFrame(list(enumerate(texts)), DOC), "text", "base")
    got = {r.term: r.share for r in pii.disclosing_terms(found, "text", "base", Disclosure()).collect()}
    assert got == want


def test_short_and_joined_names(spark):
    rng = random.Random(10)
    some = lambda n: " ".join(rng.choice("bcdfgh") + rng.choice("aeiou") + rng.choice("klmnp") for _ in range(n))
    names = ["Li", "O'Brien", "Jean-Luc", "王伟", "김"]
    rows = [(10 * k + i, f"{some(10)} {name} {some(10)} mail to{k}@acme.org {some(10)}") for k, name in enumerate(names) for i in range(8)]
    rows += [(90, f"Brien's, {some(9)} Jean-Lucs"), (91, f"{some(9)} xJean-Luc's and lix")]
    rows += [(1000 + i, some(30)) for i in range(300)]
    df = spark.createDataFrame(rows, DOC)
    texts = dict(rows)
    found = {r.doc_id: [texts[r.doc_id][x.start:x.end] for x in r.s]
             for r in find_pii(df).select("doc_id", F.filter("spans", lambda s: s["rank"] == 4).alias("s")).collect()}
    for k, name in enumerate(names):
        assert all(name in found[10 * k + i] and not set(found[10 * k + i]) & {"Brien", "Jean", "Luc"} for i in range(8))
    assert found[90] == ["Brien", "Jean"] and not any(n in found[91] for n in names)
    rows = {r.doc_id: r.text for r in sanitise(df).collect()}
    assert " <REMOVED> " in rows[0] and all(n not in rows[10 * k] for k, n in enumerate(names))


def test_sanitise_leaves_the_rest(spark):
    df = spark.createDataFrame([(1, "mail a@b.co or +1 (988) 555-2485, 1.2.3.4.", "x"), (2, None, "y"), (3, "nothing here", "z")],
                               "doc_id long, text string, spans string")
    rows = {r.doc_id: (r.text, r.spans) for r in sanitise(df.withColumnRenamed("spans", "extra")).withColumnRenamed("extra", "spans").collect()}
    assert rows == {1: ("mail <EMAIL> or <PHONE>, <IP>.", "x"), 2: (None, "y"), 3: ("nothing here", "z")}


def test_odd_rows(spark):
    df = odd_rows(spark)
    out = sanitise(df)
    assert out.columns == df.columns
    assert sorted(map(repr, out.collect())) == sorted(map(repr, df.collect()))
    assert sanitise(df.limit(0)).count() == 0


def test_any_column_names(spark):
    names = ["base", "spans", "row", "_key", "_held", "_terms", "_free", "doc", "term", "word", "share", "_base_email", "_base_ip", "t"]
    rows = letters(random.Random(3))
    plain = spark.createDataFrame(list(enumerate(rows)), DOC)
    wide = spark.createDataFrame([(*r, *names) for r in enumerate(rows)], f"{DOC}, " + ", ".join(f"{c} string" for c in names))
    out = sanitise(wide)
    assert out.columns == wide.columns and out.select(*names).distinct().collect() == [tuple(names)]
    assert sorted(out.select("doc_id", "text").collect()) == sorted(sanitise(plain).collect())
    found = find_pii(wide)
    assert found.columns == [c for c in wide.columns if c not in ("base", "spans")] + ["base", "spans"]


def test_no_python_in_the_plan(spark):
    plan = find_pii(corpus(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    assert pii.KINDS[:4] == tuple(BASE)
