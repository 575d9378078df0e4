"""Imputation lookups. "First" and "last" follow an explicit tiebreak, never file order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subrev.functions.lookup import spread_key, text_key
from subrev.functions.text import is_blank, normalize_id, strict_number


def _order(columns: Sequence[str]) -> Column:
    return F.struct(*[F.col(c) for c in columns])


def asked(df: DataFrame, key: Column, needed: Column) -> DataFrame:
    """The different keys of the rows that need a lookup."""
    return df.where(needed).select(key.alias("_ask")).where(F.col("_ask").isNotNull()).distinct()


def only_asked(df: DataFrame, key: str, asks: DataFrame | None) -> DataFrame:
    """Rows whose key is asked for: what nobody asks for is neither shuffled nor aggregated."""
    return df if asks is None else df.join(asks, F.col(key) == F.col("_ask"), "left_semi")


def first_values(df: DataFrame, key: Column, columns: Sequence[str], tiebreak: Sequence[str] | None = None,
                 asks: DataFrame | None = None) -> DataFrame:
    """Per key (of those asked for), the first non-blank value of every column in tiebreak order."""
    order = _order(tiebreak or df.columns)
    some = None
    for c in columns:
        some = ~is_blank(F.col(c)) if some is None else some | ~is_blank(F.col(c))
    return (only_asked(df.withColumn("_key", key).where(F.col("_key").isNotNull() & some), "_key", asks)
            .groupBy("_key").agg(*[F.min_by(F.when(~is_blank(F.col(c)), F.col(c)),
                                            F.when(~is_blank(F.col(c)), order)).alias(c) for c in columns]))


def mode_values(df: DataFrame, key: Column, columns: Sequence[str]) -> DataFrame:
    """Per key, the most frequent non-blank value of every column (smallest on ties)."""
    counts = None
    out = None
    for c in columns:
        value = F.col(c)
        counts = (df.withColumn("_key", key).where(F.col("_key").isNotNull() & ~is_blank(value))
                  .groupBy("_key", c).agg(F.count(F.lit(1)).alias("n"))
                  .groupBy("_key").agg(F.min_by(c, F.struct(-F.col("n"), value)).alias(c)))
        out = counts if out is None else out.join(counts, "_key", "full")
    return out


def impute_accounts(df: DataFrame, raw: DataFrame, columns: Sequence[str], strategy: str = "cascade",
                    tiebreak: Sequence[str] | None = None) -> DataFrame:
    """Fill blank cells into ``<column>_clean``.

    ``cascade``: first value of the same id among the raw rows, else first value
    of the same lower-cased name, else "Unknown".  ``mode``: most frequent value
    of the same id among ``df`` itself, else "Unknown".  Only rows with a blank
    cell take part in the joins; a null name matches nothing.
    """
    blank = is_blank(F.col(columns[0]))
    for c in columns[1:]:
        blank = blank | is_blank(F.col(c))
    pk = F.coalesce(F.col("account_id"), F.lit(""))
    id_key, name_key = normalize_id(F.col("account_id")), F.lower(F.col("account_name"))
    lookups = ([("id", id_key, mode_values(df, id_key, columns))] if strategy == "mode" else
               [(label, key, first_values(raw, key, columns, tiebreak, asked(df, key, blank)))
                for label, key in (("id", id_key), ("name", name_key))])
    out = df
    for label, key, found in lookups:
        found = found.select(F.col("_key").alias(f"_{label}_key"), *[F.col(c).alias(f"_{label}_{c}") for c in columns])
        out = (out.withColumn("_key", spread_key(blank, key, pk))
               .join(found, F.col("_key") == F.col(f"_{label}_key"), "left").drop("_key", f"_{label}_key"))
    filled = {f"{c}_clean": F.when(~is_blank(F.col(c)), F.col(c)).otherwise(F.coalesce(
        *[F.col(f"_{label}_{c}") for label, _, _ in lookups], F.lit("Unknown"))) for c in columns}
    return out.withColumns(filled).drop(*[f"_{label}_{c}" for label, _, _ in lookups for c in columns])


def priced_rows(subs: DataFrame) -> DataFrame:
    """Rows with a positive monthly and yearly price, as numbers, with trimmed plan and seats."""
    return subs.select(
        "*", strict_number(F.col("mrr_amount")).alias("_mrr"), strict_number(F.col("arr_amount")).alias("_arr"),
        F.when(~is_blank(F.col("plan_tier")), F.trim("plan_tier")).alias("_plan"),
        F.when(~is_blank(F.col("seats")), F.trim("seats")).alias("_seats"),
    ).where((F.col("_mrr") > 0) & (F.col("_arr") > 0))


def plan_by_price(subs: DataFrame, tiebreak: Sequence[str], asks: DataFrame | None = None) -> DataFrame:
    """(mrr, arr) to plan, of the prices asked for; the last row in tiebreak order wins."""
    rows = priced_rows(subs).where(F.col("_plan").isNotNull()).withColumn("price_key", text_key(F.col("_mrr"), F.col("_arr")))
    return only_asked(rows, "price_key", asks).groupBy("price_key").agg(F.max_by("_plan", _order(tiebreak)).alias("price_plan"))


def price_by_seats_plan(subs: DataFrame, tiebreak: Sequence[str]) -> DataFrame:
    """(seats, plan) to (mrr, arr); the last row in tiebreak order wins."""
    return (priced_rows(subs).where(F.col("_plan").isNotNull() & F.col("_seats").isNotNull())
            .groupBy("_seats", "_plan")
            .agg(F.max_by(F.struct("_mrr", "_arr"), _order(tiebreak)).alias("price"))
            .select(F.col("_seats").alias("seats"), F.col("_plan").alias("plan_tier"),
                    F.col("price._mrr").alias("mrr"), F.col("price._arr").alias("arr")))


def plan_by_seats(prices: DataFrame) -> DataFrame:
    """Seats to plan, only where one single plan is sold with that number of seats."""
    return (prices.groupBy("seats").agg(F.min("plan_tier").alias("seat_plan"), F.max("plan_tier").alias("_other"))
            .where(F.col("seat_plan") == F.col("_other")).select(F.col("seats").alias("seat_key"), "seat_plan"))
