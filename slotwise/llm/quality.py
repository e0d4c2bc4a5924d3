"""Quality rules: repetition coverage from rolling n-gram hashes.

Every text is read as words ``[^\\x20\\x09-\\x0D]+``. Rolling hashes of several
n-gram lengths mark the characters that lie inside n-grams found twice or more
in the same text (overlaps once) and inside lines equal to an earlier line;
their shares of the text's word characters are compared with one ceiling per
length. The work is one pass of numpy inside ``mapInArrow``: no shuffle, and
memory bounded by a chunk of texts.

Null or empty texts have no words: counts of 0, and the word-count rule rejects
them. Repeated rows are judged one by one. Other columns are never read.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from slotwise.llm import bytewords as bw
from slotwise.llm.graph import small_batches

SYMBOLS = b"#*$%&|<>"


@dataclass(frozen=True)
class QualityRules:
    """``ngram_ceilings``: n-gram length -> largest share of word characters
    inside n-grams of that length that repeat. ``line_ceiling``: the same for
    lines that repeat an earlier one. ``symbol_ceiling``: symbols per word."""

    min_words: int = 20
    window: int = 8
    repeat_percent: int = 30
    ngram_ceilings: dict[int, float] = field(default_factory=lambda: {5: 0.45, 6: 0.40, 8: 0.32, 10: 0.30})
    line_ceiling: float = 0.35
    symbol_ceiling: float = 0.3


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def measure(chunk: bw.Chunk, rules: QualityRules) -> dict[str, np.ndarray]:
    """Counts, coverages and verdicts for the texts of one chunk."""
    raw, start, end, first, n = chunk.raw, chunk.start, chunk.end, chunk.first, chunk.n
    doc = chunk.doc
    lead = (raw & 0xC0) != 0x80                       # first byte of each code point
    points = np.concatenate(([0], np.cumsum(lead)))
    chars = points[end] - points[start]               # code points per word
    symbol = np.zeros(256, bool)
    symbol[list(SYMBOLS)] = True
    out = {"n_words": np.diff(first), "word_chars": bw.per_doc(chars, first),
           "n_symbols": bw.per_doc(symbol[raw], chunk.doc_start)}

    line_end = np.flatnonzero(raw == 0x0A)
    line_start = np.concatenate(([0], line_end[:-1] + 1))
    w0, w1 = np.searchsorted(start, line_start), np.searchsorted(start, line_end)
    full = w1 > w0
    line_start, line_end, w0, w1 = line_start[full], line_end[full], w0[full], w1[full]
    line_doc = np.searchsorted(chunk.doc_start, line_start, side="right") - 1
    copy = bw.later_copy(bw.salted(chunk.range_hash(line_start, line_end), line_doc))
    out["n_dup_lines"] = np.bincount(line_doc[copy], minlength=n).astype(np.int64)
    word_points = np.concatenate(([0], np.cumsum(chars)))
    line_chars = (word_points[w1] - word_points[w0]) * copy
    total = np.maximum(out["word_chars"], 1)
    out["dup_line_share"] = np.bincount(line_doc, weights=line_chars, minlength=n) / total

    rejected = out["dup_line_share"] > rules.line_ceiling
    rejected |= out["n_symbols"] > rules.symbol_ceiling * np.maximum(out["n_words"], 1)
    for size in sorted({*rules.ngram_ceilings, rules.window}):
        h, at = chunk.ngrams(size)
        hit = bw.covered(at[bw.repeated(bw.salted(h, doc[at]))], size, len(start))
        if size == rules.window:
            out["n_repeat_words"] = bw.per_doc(hit, first)
        if size in rules.ngram_ceilings:
            out[f"dup_{size}gram_share"] = bw.per_doc(chars * hit, first) / total
            rejected |= out[f"dup_{size}gram_share"] > rules.ngram_ceilings[size]
    out["base_failed"] = (out["n_words"] < rules.min_words) | (
        100 * out["n_repeat_words"] > rules.repeat_percent * out["n_words"])
    out["kept"] = ~out["base_failed"] & ~rejected
    return out


def share_columns(rules: QualityRules) -> list[str]:
    return ["dup_line_share"] + [f"dup_{n}gram_share" for n in sorted(rules.ngram_ceilings)]


def quality(docs: DataFrame, rules: QualityRules = QualityRules(), id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """One row per input row: id, counts, ``base_failed``, ``kept``, then the
    coverage shares."""
    src = small_batches(docs).select(docs[id_col], docs[text_col])
    shares = share_columns(rules)
    id_type = src.schema[0].dataType.simpleString()
    schema = f"`{id_col}` {id_type}, " + ", ".join(f"{c} long" for c in COUNTS) + (
        ", base_failed boolean, kept boolean, ") + ", ".join(f"{c} double" for c in shares)
    names = [*COUNTS, "base_failed", "kept", *shares]

    @bw.tidy
    def run(batches):
        for b in batches:
            for lo, hi, c in bw.chunks(b.column(1), bw.SPACED, lower=False):
                m = measure(c, rules)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo)] + [pa.array(m[x]) for x in names], names=[id_col, *names])

    return src.mapInArrow(run, schema)


def keep_good(docs: DataFrame, rules: QualityRules = QualityRules(), text_col: str = "text") -> DataFrame:
    """The rows whose text is kept, with all their columns (no join)."""
    at = docs.columns.index(text_col)

    @bw.tidy
    def run(batches):
        for b in batches:
            for lo, hi, c in bw.chunks(b.column(at), bw.SPACED, lower=False):
                yield b.slice(lo, hi - lo).filter(pa.array(measure(c, rules)["kept"]))

    return small_batches(docs).mapInArrow(run, docs.schema)
