"""Column expressions over text. All of them stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The whitespace that Python's str.strip removes. Java's Unicode \s lacks
# the four separators U+001C to U+001F.
_SPACE = r"\s\x1c-\x1f"
# Fixed value: sentence terminators.
_TERMINATORS = ".!?"


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def strip(text: Column | str) -> Column:
    """Remove leading and trailing whitespace, Unicode whitespace included."""
    return F.regexp_replace(_column(text), rf"(?U)^[{_SPACE}]+|[{_SPACE}]+$", "")


def contains_text(text: Column | str) -> Column:
    """True if the stripped text is not empty. NULL for NULL, so a filter drops it.

    The match ends at the first character that is not whitespace; no stripped copy of
    the text is made.
    """
    return _column(text).rlike(rf"(?U)[^{_SPACE}]")


def sentence_count(text: Column | str, longer_than: int = 10) -> Column:
    """Fragments between terminators whose stripped length exceeds ``longer_than``.

    One pass over the text: a fragment counts if it holds a non-blank character, then
    enough further characters, then a non-blank character. The greedy match runs to the
    last non-blank character of the fragment, so each fragment matches at most once.
    """
    if longer_than < 1:
        raise ValueError("longer_than must be at least 1")
    edge = rf"[^{_TERMINATORS}{_SPACE}]"
    pattern = rf"(?U){edge}[^{_TERMINATORS}]{{{longer_than - 1},}}{edge}"
    return F.regexp_count(_column(text), F.lit(pattern)).cast("bigint")


def whitespace_tokens(text: Column | str) -> Column:
    """Runs of non-whitespace characters, in order."""
    return F.regexp_extract_all(_column(text), F.lit(rf"(?U)[^{_SPACE}]+"), F.lit(0))


def word_tokens(text: Column | str) -> Column:
    """Runs of letters, of digits, or of other visible characters, in order."""
    pattern = rf"(?U)\p{{L}}+|\p{{N}}+|[^{_SPACE}\p{{L}}\p{{N}}]+"
    return F.regexp_extract_all(_column(text), F.lit(pattern), F.lit(0))


def array_digest(values: Column | str) -> Column:
    """md5 of the space-joined array: a compact value to compare across engines."""
    return F.md5(F.array_join(_column(values).cast("array<string>"), " "))
