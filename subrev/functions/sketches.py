"""Sketches that are kept per key and merged upward: distinct counts (HLL) and quantiles (KLL).

A sketch is a binary column of bounded size.  Sketches of finer keys (a month, a
cohort) are written or held once and merged into those of any coarser key, so a coarser
report never reads the rows again.  Both are estimates with a stated error; the exact
forms remain the default everywhere.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: log2 of the buckets of a distinct sketch: a standard error of about 1.04 / sqrt(2 ** 14), 0.8 %.
DISTINCT_BITS = 14
#: Size parameter of a quantile sketch, and the normalized rank error it keeps to in 99 of 100 cases, rounded up.
RANK_SIZE = 800
RANK_ERROR = 0.005


def distinct_sketch(key: Column, bits: int = DISTINCT_BITS) -> Column:
    """Aggregate: sketch of the different non-null values."""
    return F.hll_sketch_agg(key, F.lit(bits))


def merged_distinct(sketch: Column) -> Column:
    """Aggregate: sketch of the union."""
    return F.hll_union_agg(sketch)


def distinct_estimate(sketch: Column) -> Column:
    return F.coalesce(F.hll_sketch_estimate(sketch), F.lit(0).cast("bigint"))


def quantile_sketch(value: Column, size: int = RANK_SIZE) -> Column:
    """Aggregate: sketch of the values; null and NaN are left out."""
    v = value.cast("double")
    return F.kll_sketch_agg_double(F.when(~F.isnan(v), v), F.lit(size))


def merged_quantiles(sketch: Column) -> Column:
    """Aggregate: sketch of all rows behind the sketches."""
    return F.kll_merge_agg_double(sketch)


def estimated_quantiles(sketched: DataFrame, sketch: str, probs: Sequence[float]) -> list[Column]:
    """Columns q0, q1, ... of a table of sketches; null where a sketch has seen no value."""
    some = F.kll_sketch_get_n_double(sketch) > 0
    return [F.when(some, F.kll_sketch_get_quantile_double(sketch, F.lit(float(p)))).alias(f"q{i}") for i, p in enumerate(probs)]


def approx_quantiles(df: DataFrame, columns: Mapping[str, Column], probs: Sequence[float], size: int = RANK_SIZE) -> DataFrame:
    """One row ``(name, q0, q1, ...)`` per column with values, from one scan and one aggregate."""
    wide = df.agg(*[quantile_sketch(c, size).alias(f"s{i}") for i, c in enumerate(columns.values())])
    cells = [F.struct(F.lit(name).alias("name"), F.col(f"s{i}").alias("s")) for i, name in enumerate(columns)]
    rows = wide.select(F.inline(F.array(*cells))).where(F.kll_sketch_get_n_double("s") > 0)
    return rows.select("name", *estimated_quantiles(rows, "s", probs))
