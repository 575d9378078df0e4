"""Row flags, reason lists and per-cell corrections.

A cleaner collects its rules in a :class:`RuleLog` and applies them in one
projection: three columns appear on the table, ``dirty_row_flag``,
``dirty_row_reason`` (array, rule order, no repeats) and ``corrections``
(array of structs, one per corrected or flagged cell).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FLAG = "dirty_row_flag"
REASONS = "dirty_row_reason"
CORRECTIONS = "corrections"
CORRECTION_TYPE = ("struct<column_name:string,original_value:string,corrected_value:string,"
                   "reason_code:string>")
REASONS_TYPE = "array<string>"


def empty_reasons() -> Column:
    return F.array().cast(REASONS_TYPE)


def _listed(cells: Sequence[tuple[Column, Column]], element: str) -> Column:
    """The values whose condition holds, in order. Lists of one are joined, as that is compiled; dropping nulls from a list is not."""
    none = F.array().cast(f"array<{element}>")
    return F.concat(none, *[F.when(cond, F.array(value)).otherwise(none) for cond, value in cells])


def append_reasons(existing: Column | None, *rules: tuple[Column, str]) -> Column:
    """Existing list plus the code of every rule that holds, each code once."""
    fired = _listed([(cond, F.lit(code)) for cond, code in rules], "string")
    if existing is None:
        return F.array_distinct(fired)
    return F.array_distinct(F.concat(F.coalesce(existing, empty_reasons()), fired))


def parse_reasons(c: Column) -> Column:
    """Reason list from text: a bracketed list with or without quotes, or words split at , or ;."""
    inner = F.regexp_replace(F.trim(c), r"^\[|\]$", "")
    parts = F.transform(F.split(inner, "[,;]"), lambda p: F.trim(F.regexp_replace(F.trim(p), r"[\"']", "")))
    words = F.array_distinct(F.filter(parts, lambda p: p != ""))
    return F.when(c.isNull() | F.lower(F.trim(c)).isin("", "nan"), empty_reasons()).otherwise(words)


def reason_count(c: Column) -> Column:
    return F.coalesce(F.size(F.coalesce(c, empty_reasons())), F.lit(0)).cast("bigint")


def reasons_json(c: Column) -> Column:
    """JSON text for a sink."""
    return F.to_json(F.coalesce(c, empty_reasons()))


class RuleLog:
    """Ordered rules of one cleaner."""

    def __init__(self) -> None:
        self.rules: list[tuple[Column, str]] = []
        self.cells: list[tuple[Column, Column]] = []

    def flag(self, when: Column, code: str) -> None:
        """Flag the row, without a cell correction."""
        self.rules.append((when, code))

    def correct(self, when: Column, code: str, column: str, original: Column | None = None,
                corrected: Column | None = None) -> None:
        """Flag the row and log the cell."""
        self.rules.append((when, code))
        cell = F.struct(
            F.lit(column).alias("column_name"),
            (F.lit(None) if original is None else original).cast("string").alias("original_value"),
            (F.lit(None) if corrected is None else corrected).cast("string").alias("corrected_value"),
            F.lit(code).alias("reason_code"),
        ).cast(CORRECTION_TYPE)
        self.cells.append((when, cell))

    def apply(self, df: DataFrame) -> DataFrame:
        prior = F.col(REASONS) if REASONS in df.columns else None
        cells = _listed(self.cells, CORRECTION_TYPE)
        if CORRECTIONS in df.columns:
            cells = F.concat(F.col(CORRECTIONS), cells)
        reasons = append_reasons(prior, *self.rules)
        return df.withColumns({REASONS: reasons, CORRECTIONS: cells}).withColumn(FLAG, F.size(REASONS) > 0)
