"""Running sums over hot keys: within a bucket by a window, across buckets from one row each."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Buckets that one window adds up; above it their groups are added up first.
FAN = 4096


def _same(a: DataFrame, b: DataFrame, keys: list[str]) -> Column:
    return reduce(lambda x, y: x & y, (a[k].eqNullSafe(b[k]) for k in keys))


def _join(a: DataFrame, b: DataFrame, keys: list[str], *, take: str) -> DataFrame:
    """``a`` with a column of ``b``, equal keys or both null."""
    right = b.select(*[F.col(k).alias(f"_{k}") for k in keys], take)
    return a.join(right, reduce(lambda x, y: x & y, (a[k].eqNullSafe(right[f"_{k}"]) for k in keys))).drop(*[f"_{k}" for k in keys])


def bucket_starts(totals: DataFrame, keys: list[str], bucket: str, value: str, name: str) -> DataFrame:
    """``totals`` (one row per keys and bucket) with the sum of ``value`` in the lesser buckets of the same keys."""
    rows = totals.withColumn("_high", F.floor(F.col(bucket) / FAN))
    high = rows.groupBy(*keys, "_high").agg(F.sum(value).alias("_sum"))
    before = Window.partitionBy(*keys).orderBy("_high").rowsBetween(Window.unboundedPreceding, -1)
    high = high.select(*keys, "_high", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_base"))
    inner = Window.partitionBy(*keys, "_high").orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_in", F.coalesce(F.sum(value).over(inner), F.lit(0)))
    return _join(rows, high, [*keys, "_high"], take="_base").withColumn(name, F.col("_base") + F.col("_in")).drop("_base", "_in", "_high")


def running_sum(rows: DataFrame, keys: list[str], bucket: str, order: list[str], value: str, name: str) -> DataFrame:
    """``rows`` with the sum of ``value`` over the rows before each, by bucket and then ``order``, among equal keys.

    A key may hold any share of the rows; a bucket has to be of bounded size.
    """
    totals = rows.groupBy(*keys, bucket).agg(F.sum(value).alias("_total"))
    starts = bucket_starts(totals, keys, bucket, "_total", "_start")
    within = Window.partitionBy(*keys, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_within", F.coalesce(F.sum(value).over(within), F.lit(0)))
    return _join(rows, starts, [*keys, bucket], take="_start").withColumn(name, F.col("_start") + F.col("_within")).drop("_start", "_within")
