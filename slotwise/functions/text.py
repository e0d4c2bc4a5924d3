"""Text expressions: printable length, blank test and single-space tokens."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text a missing value prints as in the reference's length measure (len(str(None)) == 4).
NULL_TEXT = "None"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def any_length(value, null_length: int | None = 4) -> Column:
    """Character length of the value's string form. NULL counts as the
    text 'None' (length 4) by default; ``null_length=None`` leaves it NULL."""
    s = _c(value).cast("string")
    if null_length is None:
        return F.length(s)
    if null_length == len(NULL_TEXT):
        return F.length(F.coalesce(s, F.lit(NULL_TEXT)))
    return F.coalesce(F.length(s), F.lit(null_length))


def is_blank(value) -> Column:
    """the string form is empty after stripping (Unicode) white space.
    NULL prints as 'None', so it is never blank."""
    return F.coalesce(_c(value).cast("string").rlike(r"(?U)^\s*$"), F.lit(False))


def tokens(text, sep: str = " ") -> Column:
    """Split on one separator character, keeping empty tokens
    (leading, repeated and trailing separators)."""
    return F.split(_c(text), re.escape(sep), -1)
