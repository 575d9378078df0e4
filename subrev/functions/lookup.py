"""Lookup joins whose row side may carry many rows that need no lookup."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPREAD = 8192


def text_key(*parts: Column) -> Column:
    """One text key from several parts; null when any part is null."""
    return F.concat(*[F.concat(p.cast("string"), F.lit("\x1f")) for p in parts])


def spread_key(needed: Column, key: Column, row_id: Column) -> Column:
    """Join key of a row that may not need the lookup.

    Rows that need it keep ``key``; all others get one of ``SPREAD`` keys that
    match nothing, so they are not sent to the one task that null keys go to.
    """
    off = F.concat(F.lit("\x1e"), F.pmod(F.xxhash64(row_id), F.lit(SPREAD)).cast("string"))
    return F.coalesce(F.when(needed, key), off)
