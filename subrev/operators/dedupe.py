"""Duplicate handling before and after cleaning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from subrev.functions.reasons import RuleLog
from subrev.functions.text import normalize_id


def completeness_score(columns: Sequence[str]) -> Column:
    """Number of non-null cells of a row."""
    score = F.lit(0)
    for c in columns:
        score = score + F.col(c).isNotNull().cast("int")
    return score


def keep_most_complete(df: DataFrame, pk: str, tiebreak: Sequence[str] | None = None) -> DataFrame:
    """One row per key: most non-null cells first, then ``tiebreak`` ascending (default: all columns).

    Null keys form one group.  The rank filter is pushed below the exchange by
    the optimizer (one row per key leaves each map task), so a hot key costs a
    reducer one row per map task.
    """
    cols = df.columns
    order = [completeness_score(cols).desc(), *[F.col(c).asc_nulls_first() for c in (tiebreak or cols)]]
    rank = F.row_number().over(Window.partitionBy(pk).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def dropped_duplicates(df: DataFrame, pk: str) -> DataFrame:
    """Keys that lose rows to :func:`keep_most_complete`, with the number of rows each loses."""
    return (df.groupBy(pk).agg((F.count(F.lit(1)) - 1).alias("rows_dropped"))
            .where(F.col("rows_dropped") > 0))


def dedupe_counts(df: DataFrame, pk: str) -> DataFrame:
    """One row: rows_in, rows_after_raw_dedupe, duplicates_raw_removed."""
    per_key = df.groupBy(pk).agg(F.count(F.lit(1)).alias("n"))
    total = F.coalesce(F.sum("n"), F.lit(0))
    return per_key.agg(total.alias("rows_in"), F.count(F.lit(1)).alias("rows_after_raw_dedupe"),
                       (total - F.count(F.lit(1))).alias("duplicates_raw_removed"))


def validate_key(df: DataFrame, pk: str) -> DataFrame:
    """Add ``<pk>_norm``; a blank key is flagged and logged."""
    df = df.withColumn(f"{pk}_norm", normalize_id(F.col(pk)))
    log = RuleLog()
    log.correct(F.col(f"{pk}_norm").isNull(), "blank_pk", pk, F.col(pk))
    return log.apply(df)


def signature(columns: Sequence[str]) -> Column:
    """Text of the cleaned cells, nulls kept apart from the text "null"."""
    return F.to_json(F.struct(*[F.coalesce(F.col(c).cast("string"), F.lit("\x00")).alias(c)
                                for c in sorted(columns)]))


def identical_groups(df: DataFrame, pk: str, columns: Sequence[str], by: str = "key") -> DataFrame:
    """Groups of rows that are the same after cleaning, with their size.

    ``by="key"``: same key and one signature over ``columns`` (never after a
    dedupe on that key).  ``by="signature"``: same cleaned cells whatever the key.
    """
    if by == "key":
        sig = F.xxhash64(signature(columns))
        groups = df.groupBy(pk).agg(F.count(F.lit(1)).alias("copies"), F.min(sig).alias("lo"), F.max(sig).alias("hi"))
        return groups.where((F.col("copies") > 1) & (F.col("lo") == F.col("hi"))).select(pk, "copies")
    # Rows meet by a digest of fixed width; the cells behind equal digests are compared, and only theirs are moved.
    rows = df.select(signature(columns).alias("signature")).withColumns({
        "_a": F.xxhash64("signature"), "_b": F.xxhash64(F.lit(1), F.col("signature"))})
    met = rows.groupBy("_a", "_b").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1).select("_a", "_b")
    return (rows.join(met, ["_a", "_b"], "left_semi").groupBy("signature").agg(F.count(F.lit(1)).alias("copies"))
            .where(F.col("copies") > 1))


def identical_count(df: DataFrame, pk: str, columns: Sequence[str], by: str = "key") -> DataFrame:
    """One row: surplus rows of all groups of :func:`identical_groups`."""
    return identical_groups(df, pk, columns, by).agg(
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicates_identical_after_cleaning_detected"))


def flag_identical(df: DataFrame, pk: str, columns: Sequence[str], by: str = "key") -> DataFrame:
    """Flag and log every member of the groups of :func:`identical_groups`.

    Signatures meet by their SHA-256, so that neither exchange moves the cells.
    """
    code = "duplicate_after_cleaning_detected"
    mine = F.col(pk) if by == "key" else F.unhex(F.sha2(signature(columns), 256))
    if by == "key":
        groups = identical_groups(df, pk, columns, by).select(F.col(pk).alias("_group"), F.lit(True).alias("_same"))
    else:
        groups = (df.groupBy(mine.alias("_group")).agg(F.count(F.lit(1)).alias("_copies")).where(F.col("_copies") > 1)
                  .select("_group", F.lit(True).alias("_same")))
    out = df.withColumn("_mine", mine).join(groups, F.col("_mine").eqNullSafe(F.col("_group")), "left")
    log = RuleLog()
    log.correct(F.coalesce(F.col("_same"), F.lit(False)), code, "")
    return log.apply(out).drop("_mine", "_group", "_same")
