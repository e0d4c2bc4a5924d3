"""Personal data: pattern spans, and terms that give protected entities away.

Only DataFrame functions run here. Base spans are e-mail addresses, IPv4
addresses, payment cards (Luhn) and international phone numbers. The values
found are the protected entities. A term (a run of letters of any length, or
several joined by single apostrophes or hyphens, such as O'Brien, which counts
beside its parts) discloses an entity
if seeing the term tells much about the entity's presence. From the corpus come

* joint(t, e): texts that mention e and hold t, anywhere, and the number of
  different contexts there (the ``CONTEXT_WORDS`` words on either side of a
  mention, without t),
* n(t): texts that hold t; n(e): texts that mention e; N: texts; each different
  text (digest) counts once, so copies neither add to nor take from the evidence;
  the letters of e-mail addresses are mentions, not words that a text holds,

and t is held to disclose e if P(e|t) = joint / n(t) reaches ``min_share``, the
information log2(P(e|t) / P(e)) reaches ``min_bits``, and the contexts are
independent: at least ``min_contexts``, and at least ``independent`` of the
texts (near copies, whose texts differ, repeat a few contexts). Occurrences of
such terms become spans of the kind ``term`` in every document.

Pairs that cannot pass are left out before they are made: an entity needs
``min_contexts`` mentions, and as joint is at most n(e) and n(t) at least the
number of texts with such an entity that hold t, that number bounds n(e).

Sanitised text carries ``<EMAIL>``, ``<IP>``, ``<CARD>`` and ``<PHONE>`` for base
spans; terms are removed (``<REMOVED>``) where P(e|t) reaches ``remove_share``
and generalised (``<NAME>``) below.

Statistics are partial aggregations; terms are looked up by joins on the term, or on the text's
digest, as broadcasts where the table's measured size allows. Nothing is collected
but sizes.

Null texts count as empty: no spans; in sanitised output they stay null. Repeated
rows are scanned one by one. Other columns pass by untouched.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotwise.llm.graph import cut
from slotwise.operators.joins import measured, small_enough

KINDS = ("email", "ip", "card", "phone", "term")
# Each pattern is the given one, with the start tied to the run it begins in and
# with possessive repeats, which give the same matches in linear time.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]+\.[0-9]+\.[0-9]+",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
OCTET = "^0*(?:[0-9]|[1-9][0-9]|1[0-9][0-9]|2[0-4][0-9]|25[0-5])$"
LETTERS = r"\p{L}\p{M}"         # what terms are made of
JOINS = "['’-]"                 # what stands between the parts of a joined term
JOINED = rf"(?<![{LETTERS}])(?<![{LETTERS}]{JOINS})[{LETTERS}]++(?:{JOINS}[{LETTERS}]++)++"
CONTEXT_WORDS = 6
CONTEXT_CHARS = 240
BROADCAST_BYTES = 16 << 20      # measured size up to which a table of terms is broadcast


@dataclass(frozen=True)
class Disclosure:
    min_contexts: int = 3
    independent: float = 0.5
    min_share: float = 0.5
    min_bits: float = 4.0
    remove_share: float = 0.9


def _valid(kind: str, m: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(m, r"\."), lambda p: p.rlike(OCTET))
    if kind == "phone":
        return F.length(F.regexp_replace(m, "[^0-9]", "")).between(9, 15)
    if kind == "card":
        digits = F.regexp_replace(m, "[^0-9]", "")
        places = F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
            F.pmod(d.cast("int") * 2, F.lit(10)) + F.floor(d.cast("int") * 2 / 10).cast("int")))
        luhn = F.aggregate(places, F.lit(0), lambda s, d: s + F.coalesce(d, F.lit(0)))
        return F.when(F.length(digits).between(12, 19), luhn % 10 == 0).otherwise(False)
    return F.lit(True)


def _places(found: Column, gaps: Column, rank: int) -> Column:
    """Matches with their places: the lengths of gaps and matches add up."""
    empty = F.expr("named_struct('at', 0, 'out', cast(array() as array<struct<start:int,rank:int,end:int,value:string>>))")

    def step(acc, pair):
        start = acc["at"] + F.length(pair["gap"])
        end = start + F.length(pair["value"])
        one = F.struct(start.alias("start"), F.lit(rank).alias("rank"), end.alias("end"), pair["value"].alias("value"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))

    pairs = F.zip_with(found, F.slice(gaps, F.lit(1), F.size(found)), lambda m, g: F.struct(m.alias("value"), g.alias("gap")))
    return F.aggregate(pairs, empty, step, lambda acc: acc["out"])


_SPANS = "array<struct<start:int,rank:int,end:int,value:string>>"


def base_spans(docs: DataFrame, text_col: str = "text", out: str = "spans") -> DataFrame:
    """``docs`` with the base spans, ordered by start, then kind."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    hint = {"email": text.contains("@"), "phone": text.contains("+"), "ip": text.rlike("[0-9]"), "card": text.rlike("[0-9]{2}|[0-9][ -][0-9]")}
    names = {k: f"_{out}_{k}" for k in PATTERNS}
    none = F.array().cast("array<string>")
    found = docs.withColumns({names[k]: F.when(hint[k], F.regexp_extract_all(text, F.lit(p), F.lit(0))).otherwise(none)
                              for k, p in PATTERNS.items()})
    spans = []
    for rank, (kind, p) in enumerate(PATTERNS.items()):
        m = F.col(names[kind])
        at = _places(m, F.split(text, p, -1), rank)
        spans.append(F.when(F.size(m) > 0, F.filter(at, lambda s: _valid(kind, s["value"]))).otherwise(F.array().cast(_SPANS)))
    return found.withColumn(out, F.array_sort(F.concat(*spans))).drop(*names.values())


def span_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(kinds, s["rank"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def _digest(text_col: str) -> Column:
    return F.unhex(F.md5(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))))


def _words(text: Column) -> Column:
    """Lower-case runs of letters."""
    return F.filter(F.split(F.lower(text), f"[^{LETTERS}]+"), lambda w: w != "")


def _outside(text_col: str) -> Column:
    """The distinct words of a text, without those in e-mail addresses (other base spans hold no letters)."""
    text = F.col(f"`{text_col}`")
    bare = F.when(text.contains("@"), F.regexp_replace(text, F.lit(PATTERNS["email"]), F.lit(" "))).otherwise(text)
    return _terms(bare)


def _terms(text: Column) -> Column:
    """The distinct terms of a text: runs of letters, and joined ones."""
    joined = F.regexp_extract_all(F.lower(text), F.lit(JOINED), F.lit(0))
    return F.array_distinct(F.concat(_words(text), joined))


def mentions(found: DataFrame, text_col: str, spans: str) -> DataFrame:
    """(doc, entity, words): one row per base span, with the words around it.
    ``doc`` is the text's digest; copies of a text repeat its rows."""
    text = F.col(f"`{text_col}`")
    one = found.where(F.size(spans) > 0).select(_digest(text_col).alias("doc"), text.alias("t"), F.col(spans).alias("all"))
    one = one.select("doc", "t", F.explode("all").alias("s"))
    before = F.substring("t", F.greatest(F.lit(1), F.col("s.start") - CONTEXT_CHARS + 1), F.least(F.lit(CONTEXT_CHARS), F.col("s.start")))
    after = F.substring("t", F.col("s.end") + 1, F.lit(CONTEXT_CHARS))
    entity = F.concat_ws(":", F.col("s.rank").cast("string"), F.lower(F.when(
        F.col("s.rank") >= 2, F.regexp_replace("s.value", "[^0-9]", "")).otherwise(F.col("s.value"))))
    one = one.select("doc", entity.alias("entity"), F.reverse(_words(before)).alias("l"), _words(after).alias("r"))
    return one.select("doc", "entity", F.array_distinct(F.concat(
        F.slice("l", 1, CONTEXT_WORDS), F.slice("r", 1, CONTEXT_WORDS))).alias("words"))


def joint_terms(found: DataFrame, seen: DataFrame, text_col: str, spans: str, rule: Disclosure) -> DataFrame:
    """(entity, term, joint, contexts) over whole texts, of all pairs that can
    reach ``min_contexts`` and ``min_share``. ``seen``: distinct mentions."""
    often = seen.groupBy(F.col("entity").alias("often")).agg(F.count(F.lit(1)).alias("places"), F.count_distinct("doc").alias("n_often"))
    kept = cut(seen.join(often, F.col("entity") == F.col("often")).where(F.col("places") >= rule.min_contexts)
               .select("doc", "entity", "words", "n_often"))
    docs = kept.groupBy(F.col("doc").alias("kept_doc")).agg(F.max("n_often").alias("most"))
    held = cut(found.where(F.size(spans) > 0).select(_digest(text_col).alias("held_doc"), F.explode(_outside(text_col)).alias("term"))
               .distinct().join(docs, F.col("held_doc") == F.col("kept_doc")).select("held_doc", "term", "most"))
    around = held.groupBy(F.col("term").alias("near_term")).agg(F.count(F.lit(1)).alias("n_near"))
    rare = (held.join(around, F.col("term") == F.col("near_term")).where(F.col("most") >= rule.min_share * F.col("n_near"))
            .select("held_doc", "term", "n_near"))
    pairs = kept.join(rare, (F.col("doc") == F.col("held_doc")) & (F.col("n_often") >= rule.min_share * F.col("n_near")))
    return pairs.groupBy("entity", "term").agg(
        F.count_distinct("doc").alias("joint"),
        F.count_distinct(F.xxhash64(F.array_sort(F.array_remove("words", F.col("term"))))).alias("contexts"),
        F.first("n_near").alias("n_near")).where(F.col("joint") >= rule.min_share * F.col("n_near"))


def disclosing_terms(found: DataFrame, text_col: str, spans: str, rule: Disclosure) -> DataFrame | None:
    """(term, share): terms that exceed the disclosure thresholds, with their
    largest P(e|t). None if no term has enough independent contexts."""
    seen = cut(mentions(found, text_col, spans).distinct())
    joint = joint_terms(found, seen, text_col, spans, rule)
    likely = joint.where((F.col("contexts") >= rule.min_contexts) & (F.col("contexts") >= rule.independent * F.col("joint")))
    likely = cut(likely.select("entity", "term", "joint"))
    if likely.isEmpty():
        return None
    entities = seen.groupBy("entity").agg(F.count_distinct("doc").alias("n_e"))
    wanted = _sized(cut(likely.select(F.col("term").alias("t")).distinct()))
    n_t = (found.select(_digest(text_col).alias("doc"), F.explode(_outside(text_col)).alias("word"))
           .join(wanted, F.col("word") == F.col("t"), "left_semi").groupBy("word").agg(F.count_distinct("doc").alias("n_t")))
    n_texts = found.select(_digest(text_col).alias("doc")).distinct().count()
    scored = (likely.join(entities, "entity").join(n_t, F.col("term") == F.col("word"))
              .withColumn("share", F.least(F.lit(1.0), F.col("joint") / F.col("n_t")))
              .withColumn("bits", F.log2(F.col("share") * n_texts / F.col("n_e"))))
    return cut(scored.where((F.col("share") >= rule.min_share) & (F.col("bits") >= rule.min_bits))
               .groupBy("term").agg(F.max("share").alias("share")))


def _sized(df: DataFrame) -> DataFrame:
    """``df``, marked for broadcast if its measured size is within the bound."""
    return F.broadcast(df) if small_enough(measured({"df": df})["df"], max_bytes=BROADCAST_BYTES) else df


def find_pii(docs: DataFrame, rule: Disclosure = Disclosure(), text_col: str = "text") -> DataFrame:
    """``docs`` with ``base`` (base spans) and ``spans`` (with the terms'),
    arrays of (start, rank in ``KINDS``, end, value); a term's value is
    ``removed`` or ``generalised``. Columns of ``docs`` with these two names are
    replaced; all other names are free."""
    found = _find(_packed(docs, text_col), rule, "text")
    kept = [F.col("row").getField(c).alias(c) for c in docs.columns if c.lower() not in ("base", "spans")]
    return found.select(*kept, "base", "spans")


def _packed(docs: DataFrame, text_col: str) -> DataFrame:
    """(row, text): all columns in one struct, so that no name can clash."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{text_col}`").alias("text"))


def _find(docs: DataFrame, rule: Disclosure, text_col: str) -> DataFrame:
    found = base_spans(docs, text_col, "base")
    terms = disclosing_terms(found, text_col, "base", rule)
    if terms is None:
        return found.withColumn("spans", F.col("base"))
    text = F.col(f"`{text_col}`")
    keyed = found.withColumn("_key", F.md5(F.coalesce(text, F.lit(""))))
    words = docs.select(F.md5(F.coalesce(text, F.lit(""))).alias("_key"), F.explode(_terms(text)).alias("word"))
    held = cut(words.join(_sized(terms), F.col("word") == F.col("term")).groupBy(F.col("_key").alias("_held"))
               .agg(F.collect_set(F.struct("term", "share")).alias("_terms")))
    both = keyed.join(_sized(held), F.col("_key") == F.col("_held"), "left")

    def occurrences(t):
        before, after = rf"(?iu)(?<![{LETTERS}])", rf"(?![{LETTERS}])"
        joined = t["term"].rlike(JOINS)
        edge = F.concat(F.lit(before), F.when(joined, rf"(?<![{LETTERS}]{JOINS})").otherwise(""), F.lit(r"\Q"), t["term"],
                        F.lit(r"\E" + after), F.when(joined, rf"(?!{JOINS}[{LETTERS}])").otherwise(""))
        value = F.when(t["share"] >= rule.remove_share, "removed").otherwise("generalised")
        at = _places(F.regexp_extract_all(text, edge, F.lit(0)), F.split(text, edge, F.lit(-1)), KINDS.index("term"))
        return F.transform(at, lambda s: F.struct(s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end"), value.alias("value")))

    more = F.when(F.col("_terms").isNotNull(), F.flatten(F.transform("_terms", occurrences))).otherwise(F.array().cast(_SPANS))
    free = F.filter(more, lambda s: ~F.exists("base", lambda b: (s["start"] < b["end"]) & (b["start"] < s["end"])))
    # a part of a joined term's occurrence is no span of its own
    whole = F.filter("_free", lambda s: ~F.exists("_free", lambda b: (b["start"] <= s["start"]) & (s["end"] <= b["end"])
                                                 & (b["end"] - b["start"] > s["end"] - s["start"])))
    spans = F.array_sort(F.concat("base", F.when(F.exists("_terms", lambda t: t["term"].rlike(JOINS)), whole).otherwise(F.col("_free"))))
    return both.withColumn("_free", free).withColumn("spans", spans).drop("_key", "_held", "_terms", "_free")


def sanitise(docs: DataFrame, rule: Disclosure = Disclosure(), text_col: str = "text") -> DataFrame:
    """``docs`` with the spans replaced in its text; the same columns, whatever
    their names."""
    found = _find(_packed(docs, text_col), rule, "text")
    text = F.col("text")

    def mark(s):
        out = F.when(s["value"] == "removed", "<REMOVED>").otherwise("<NAME>")
        for rank, kind in enumerate(KINDS[:4]):
            out = F.when(s["rank"] == rank, f"<{kind.upper()}>").otherwise(out)
        return out

    def step(acc, s):
        gap = F.substring(text, acc["at"] + 1, s["start"] - acc["at"])
        return F.when(s["start"] >= acc["at"], F.struct(s["end"].alias("at"), F.concat(acc["out"], gap, mark(s)).alias("out"))).otherwise(
            F.struct(F.greatest(acc["at"], s["end"]).alias("at"), acc["out"].alias("out")))

    clean = F.aggregate("spans", F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step,
                        lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
    kept = [F.when(F.size("spans") > 0, clean).otherwise(text).alias(c) if c == text_col else F.col("row").getField(c).alias(c)
            for c in docs.columns]
    return found.select(*kept)
