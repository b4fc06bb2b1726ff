"""Text key expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Letters and digits of any script.
ALNUM_RUN = r"[\p{IsAlphabetic}\p{IsDigit}]+"
ALL_ZERO = r"^0+$"


def strip(col: Column) -> Column:
    """Trim all white space at both ends."""
    return F.regexp_replace(col, r"^\s+|\s+$", "")


def pad_left(col: Column, width: int, fill: str = "0") -> Column:
    """Left pad that never shortens a longer value."""
    text = col.cast("string")
    return F.when(F.length(text) < width, F.lpad(text, width, fill)).otherwise(text)


def first_match(col: Column, pattern: str) -> Column:
    """First match of ``pattern``, NULL when there is none."""
    return F.regexp_substr(col, F.lit(pattern))


def first_alnum(col: Column) -> Column:
    return first_match(col, ALNUM_RUN)


def contains_ci(col: Column, text: str) -> Column:
    """Case-insensitive test; ``text`` is a pattern, as in the job parameter it comes from."""
    return col.rlike("(?i)" + text)


def like(col: Column, pattern: str, ci: bool = False) -> Column:
    return F.lower(col).like(pattern.lower()) if ci else col.like(pattern)


def text_equal(col: Column, value: str, ci: bool = False) -> Column:
    return F.lower(col) == value.lower() if ci else col == value


def contract_key(raw: Column, width: int = 12) -> Column:
    """Contract text: trimmed, one leading apostrophe dropped, cut to ``width``."""
    return F.substring(F.regexp_replace(strip(raw), "^'", ""), 1, width)


def key_status(key: Column) -> Column:
    """``zero`` / ``blank`` / ``valid``; a missing key counts as ``valid``."""
    return (
        F.when(key.rlike(ALL_ZERO), "zero")
        .when(F.length(strip(key)) == 0, "blank")
        .otherwise("valid")
    )
