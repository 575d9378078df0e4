"""Text normalisation and number parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from subrev.specs import ID_NULL_WORDS, MISSING_WORDS, TRUE_WORDS

def is_blank(c: Column) -> Column:
    return c.isNull() | (F.trim(c.cast("string")) == "")


def nonblank(c: Column) -> Column:
    """The value, or null when it is null or blank."""
    return F.when(F.trim(c) != "", c)


def lowered(c: Column) -> Column:
    return F.lower(F.trim(c.cast("string")))


def normalize_id(c: Column) -> Column:
    """Trimmed id; the null words become null."""
    t = F.trim(c.cast("string"))
    return F.when(~F.lower(t).isin(*ID_NULL_WORDS), t)


def is_missing_word(c: Column) -> Column:
    """Null, blank, or a text that means "no value" ("unknown" included)."""
    return c.isNull() | lowered(c).isin(*MISSING_WORDS)


def is_missing_value(c: Column) -> Column:
    """Null, blank or a null word; "unknown" counts as a value."""
    return c.isNull() | lowered(c).isin(*ID_NULL_WORDS)


def is_true(c: Column) -> Column:
    return F.coalesce(lowered(c).isin(*TRUE_WORDS), F.lit(False))


def signed_number(c: Column) -> Column:
    """Number in a text: thousands commas and currency signs dropped, "(" read as minus."""
    digits = F.regexp_replace(F.translate(c, "(", "-"), r"[^0-9.\-]", "")
    return digits.try_cast("double")


def bare_number(c: Column) -> Column:
    """The number, or the number left after dropping every character but digits, point and minus."""
    stripped = F.regexp_replace(c.cast("string"), r"[^0-9.\-]", "").try_cast("double")
    return F.coalesce(c.try_cast("double"), stripped)


def strict_number(c: Column) -> Column:
    """Number only when the whole trimmed text is one."""
    return F.trim(c.cast("string")).try_cast("double")
