"""Small text rules shared by several operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python's str.isspace() also counts U+001C..U+001F as white space; Java's Unicode \s does not.
_NON_SPACE = r"(?U)[^\s\x{1C}-\x{1F}]"
# Runs of letters and of non-letters; title case works run by run.
_RUNS = r"(?U)\p{L}+|\P{L}+"


def non_blank(text: Column) -> Column:
    """True when the text holds at least one non-white-space character (null -> False).

    Python's ``str.strip()`` strips Unicode white space, not only spaces, so ``trim`` is
    not the same test; a regex find over Unicode white space is.
    """
    return F.coalesce(text.rlike(_NON_SPACE), F.lit(False))


def python_title(s: Column) -> Column:
    """Python ``str.title()``: a letter after a non-letter is upper case, other letters lower.

    ``initcap`` alone only restarts words after spaces (``Stage 0a``); applying it to each
    run of letters gives ``Stage 0A`` and ``Stage\\tIvc`` like Python.
    """
    runs = F.regexp_extract_all(s, F.lit(_RUNS), 0)
    return F.when(s.isNull(), F.lit(None)).otherwise(
        F.array_join(F.transform(runs, lambda r: F.initcap(r)), ""))


def estimated_tokens(length: Column, chars_per_token: float = 3.5) -> Column:
    """``int(len / chars_per_token)`` as a bigint (truncation toward zero, lengths are >= 0)."""
    return F.floor(length.cast("double") / F.lit(chars_per_token)).cast("bigint")
