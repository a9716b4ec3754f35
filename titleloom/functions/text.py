"""Text expressions. All of them are native Spark columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Title texts that a CSV reader with default settings takes as missing.
NA_TITLES = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Fixed value: the label of a title that is missing.
NO_TITLE = "Sin Título"

# Unicode white space plus the four ASCII separators that Python also splits on.
_SPACE = r"[\s\x1c-\x1f]"


def tokens(text: Column) -> Column:
    """Set of lower-case, white-space separated words; empty for blank or NULL text."""
    words = F.filter(F.split(F.lower(text), f"(?U){_SPACE}+"), lambda w: w != "")
    return F.coalesce(F.array_distinct(words), F.array().cast("array<string>"))


def has_tokens(text: Column) -> Column:
    """Same as a non-empty :func:`tokens`, without splitting."""
    return F.coalesce(text.rlike(r"(?U)[^\s\x1c-\x1f]"), F.lit(False))


def has_title(title: Column) -> Column:
    """False for NULL and for texts that stand for a missing value (case-sensitive)."""
    return title.isNotNull() & ~title.isin(NA_TITLES)


def strip(text: Column) -> Column:
    """Remove Unicode white space from both ends."""
    return F.regexp_replace(text, rf"(?U)\A{_SPACE}+|{_SPACE}+\z", "")


def unix_newlines(text: Column) -> Column:
    """Read text in text mode: CRLF and lone CR become LF."""
    return F.regexp_replace(text, r"\r\n?", "\n")


def printable_char(ch: Column) -> Column:
    """A quoted character for code listings, with newline and tab made visible."""
    shown = F.when(ch == "\n", F.lit(r"\n")).when(ch == "\t", F.lit(r"\t")).otherwise(ch)
    return F.concat(F.lit("'"), shown, F.lit("'"))


def result_label(similarity: Column, title: Column) -> Column:
    """Heading of one search hit, such as ``[97.3%] some title``; ties round to even."""
    return F.format_string("[%.1f%%] %s", F.bround(similarity * 100, 1), F.coalesce(title, F.lit(NO_TITLE)))
