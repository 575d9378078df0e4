"""Connected components of a link table, by alternating large and small stars.

Every step is a minimum per vertex (partial aggregation, so a hub costs one row
per task) and a join back; the links of a step are written before the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subrev.llm.common import Scratch


def _star(links: DataFrame, large: bool) -> DataFrame:
    """``links`` (a, b) with a < b.  Each vertex hands its neighbours (large: the greater, small: the lesser) to their minimum."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large \
        else links.select(F.col("b").alias("a"), F.col("a").alias("b"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    rows = both.join(least, "a")
    if large:
        out = rows.where(F.col("b") > F.col("a")).select(F.col("m").alias("a"), "b")
    else:
        out = rows.select(F.col("m").alias("a"), "b").unionByName(least.select(F.col("m").alias("a"), F.col("a").alias("b")))
    return out.where(F.col("a") < F.col("b")).distinct()


def components(links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(vertex, component): each vertex of a link (a, b) with the least vertex it reaches, itself left out."""
    now = scratch.keep(f"{name}-0", links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                       .where(F.col("a") < F.col("b")).distinct())
    state, step = None, 0
    while True:
        sums = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if sums == state or not sums[0]:
            return now.select(F.col("b").alias("vertex"), F.col("a").alias("component"))
        state, step = sums, step + 1
        now = scratch.keep(f"{name}-{step}", _star(_star(now, large=True), large=False))
        scratch.drop(f"{name}-{step - 1}")
