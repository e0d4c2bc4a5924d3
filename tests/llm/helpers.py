"""Word splitting and documents shared by the brute-force tests."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

DOC = "doc_id long, text string"


def lower(text):
    return (text or "").translate(_LOWER)


def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def odd_rows(spark):
    """Nulls, empty and long texts, repeated rows, clashing extra columns."""
    long = "word salad " * 30_000
    rows = [(1, None, "x", 1), (2, "", "y", None), (3, " \n\t ", None, 2), (4, "one", "z", 3), (4, "one", "z", 3),
            (5, long, "z", 4), (None, "no id here but some words", "z", 5), (6, "Ünïcödé 漢字 🙂 wörds", "q", 6)]
    return spark.createDataFrame(rows, "doc_id long, text string, n_words string, component_id int")
