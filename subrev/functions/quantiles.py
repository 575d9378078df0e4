"""Exact quantiles and describe() that stay distributed.

The built-in exact ``percentile`` gathers every distinct value of the column in
one task.  Here a sketch proposes a narrow band of values around each wanted rank (its
rank error is bounded, so the rank lies inside), and a second scan counts the rows below
the band and the different values inside it, combined map-side.  Only the values of
the band, a share of ``4 / accuracy`` of the rows, are sorted.  A small column is one
band.  The sketch decides how much is sorted, never the result: a rank outside its band
would be an error, not another value.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from subrev.functions import sketches

DESCRIBE_ROWS = ("count", "mean", "std", "min", "25%", "50%", "75%", "max")
QUARTILES = (0.25, 0.5, 0.75)
#: A column of up to so many times ``accuracy`` rows is sorted whole.
WHOLE = 10


def _long(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    cells = [F.struct(F.lit(name).alias("name"), c.cast("double").alias("v")) for name, c in columns.items()]
    return df.select(F.inline(F.array(*cells))).where(F.col("v").isNotNull() & ~F.isnan("v"))


def _sketch(values: DataFrame, probs: Sequence[float], accuracy: int, more: Column | None = None) -> DataFrame:
    """Rows, proposed band ends and a struct of ``more`` aggregates per column: one row each."""
    margin = 2.0 / accuracy
    ends = [max(p - margin, 0.0) for p in probs] + [min(p + margin, 1.0) for p in probs]
    return values.groupBy("name").agg(
        F.count(F.lit(1)).alias("total"), F.percentile_approx("v", F.array(*[F.lit(x) for x in ends]), accuracy).alias("cuts"),
        (F.lit(0) if more is None else more).alias("more"))


def _by_bands(values: DataFrame, sketch: DataFrame, probs: Sequence[float], accuracy: int) -> DataFrame:
    whole = F.col("total") <= WHOLE * accuracy
    bands = F.array(*[
        F.struct(F.lit(i).alias("i"), (F.lit(float(p)) * (F.col("total") - 1)).alias("pos"),
                 F.when(~whole, F.col("cuts")[i]).alias("lo"), F.when(~whole, F.col("cuts")[i + len(probs)]).alias("hi"))
        for i, p in enumerate(probs)])
    # One row per column and quantile: sizes fixed by the call.
    bands = F.broadcast(sketch.select("name", "total", "more", F.inline(bands)))
    key = ["name", "i", "pos", "total", "more"]
    v, lo, hi, pos = F.col("v"), F.col("lo"), F.col("hi"), F.col("pos")
    inside = (values.join(bands, "name").where(hi.isNull() | (v <= hi))
              .groupBy(*key, F.when(lo.isNull() | (v >= lo), v).alias("v")).agg(F.count(F.lit(1)).alias("n")))
    # The rows below the band are one row without a value, which comes first.
    run = Window.partitionBy(*key).orderBy(v.asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    reached = inside.withColumn("reached", F.sum("n").over(run))
    first, second = F.floor(pos), F.least(F.floor(pos) + 1, F.col("total") - 1)
    missed = F.coalesce(F.max(F.when(v.isNull(), F.col("reached") > first)), F.lit(False))
    ends = reached.groupBy(*key).agg(
        F.min(F.when(F.col("reached") > first, v)).alias("a"), F.min(F.when(F.col("reached") > second, v)).alias("b"), missed.alias("missed"))
    weight = pos - first
    q = F.when(F.col("missed") | F.col("a").isNull(), F.raise_error(F.lit("rank outside its band")).cast("double")).when(
        weight == 0, F.col("a")).otherwise(F.col("a") + (F.col("b") - F.col("a")) * weight)
    return ends.withColumn("q", q).groupBy("name", "more").agg(
        *[F.max(F.when(F.col("i") == i, F.col("q"))).alias(f"q{i}") for i in range(len(probs))])


def exact_quantiles(df: DataFrame, columns: Mapping[str, Column], probs: Sequence[float],
                    accuracy: int = 10000) -> DataFrame:
    """Linear-interpolated quantiles: one row ``(name, q0, q1, ...)`` per column with values.

    ``accuracy`` only sets how narrow the sorted bands are.
    """
    values = _long(df, columns)
    return _by_bands(values, _sketch(values, probs, accuracy), probs, accuracy).drop("more")


def quantiles(df: DataFrame, columns: Mapping[str, Column], probs: Sequence[float], approx: bool = False) -> DataFrame:
    """One row ``(name, q0, q1, ...)`` per column with values: exact, or from sketches of one scan."""
    return (sketches.approx_quantiles if approx else exact_quantiles)(df, columns, probs)


def describe(df: DataFrame, column: Column, name: str, approx: bool = False, accuracy: int = 10000) -> DataFrame:
    """Long describe of one column: rows ``(index, <name>)``; std is the sample one, quartiles are estimates with ``approx``.

    Moments and sketch come from one scan.  A column without values has a count of 0.
    """
    v = column.cast("double")
    values = df.select(F.lit(name).alias("name"), v.alias("v")).where(F.col("v").isNotNull() & ~F.isnan("v"))
    moments = (F.count("v").cast("double").alias("count"), F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"),
               F.min("v").alias("min"), F.max("v").alias("max"))
    if approx:
        one = values.agg(*moments, sketches.quantile_sketch(F.col("v")).alias("s"))
        wide = one.select("*", *[q.alias(r) for q, r in zip(sketches.estimated_quantiles(one, "s", QUARTILES), DESCRIBE_ROWS[4:7])])
    else:
        found = _by_bands(values, _sketch(values, QUARTILES, accuracy, F.struct(*moments)), QUARTILES, accuracy)
        found = found.select("name", "more.*", F.col("q0").alias("25%"), F.col("q1").alias("50%"), F.col("q2").alias("75%"))
        nothing = df.sparkSession.createDataFrame([(name, 0.0)], "name string, count double")
        both = found.unionByName(nothing, allowMissingColumns=True)
        wide = both.groupBy("name").agg(*[F.max(f"`{r}`").alias(r) for r in DESCRIBE_ROWS])
    cells = [F.struct(F.lit(r).alias("index"), F.col(f"`{r}`").alias(name)) for r in DESCRIBE_ROWS]
    return wide.select(F.inline(F.array(*cells)))


def describe_days(df: DataFrame, key: str, days: Column) -> DataFrame:
    """Wide describe of a day count per group.

    The built-in exact percentile is safe here: it keeps one counter per
    distinct value, and a day count has at most the days of the calendar.
    """
    d = days.cast("double")
    q = F.percentile(d, F.array(*[F.lit(x) for x in QUARTILES]))
    return df.groupBy(key).agg(
        F.count(d).alias("count"), F.avg(d).alias("mean"), F.stddev_samp(d).alias("std"),
        F.min(d).alias("min"), q.alias("q"), F.max(d).alias("max")).select(
        key, "count", "mean", "std", "min", F.col("q")[0].alias("25%"), F.col("q")[1].alias("50%"),
        F.col("q")[2].alias("75%"), "max")
