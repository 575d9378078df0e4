"""Checks on the feature tables and their documentation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subrev.functions import numeric

# Columns every table must have, the missing-share limit, derived-column names.
REQUIRED_COLUMNS = {
    "accounts": ("account_id",),
    "subscriptions": ("subscription_id", "account_id"),
    "usage_monthly": ("subscription_id", "usage_month"),
    "support_events": ("ticket_id", "submitted_at"),
}
MISSING_LIMIT = 0.2
MISSINGNESS_TABLES = ("subscriptions", "accounts", "usage_monthly", "feature_month", "first_use", "support_events")
CONSTANT_TABLES = ("subscriptions", "accounts", "usage_monthly")
DERIVED_PREFIXES = ("mrr_", "arr_")
DERIVED_COLUMNS = (
    "lifetime_mrr", "subscription_age_days", "subscription_age_months", "rev_change_flag", "is_new", "is_upgrade",
    "is_downgrade", "plan_category", "seat_bucket", "usage_intensity", "duration_per_use", "beta_adopter",
    "account_feature_rank")


def missing_columns(tables: Mapping[str, DataFrame]) -> list[tuple[str, str]]:
    """Required columns a table lacks, from the schemas alone."""
    return [(t, c) for t, cols in REQUIRED_COLUMNS.items() for c in cols if t in tables and c not in tables[t].columns]


def orphan_subscriptions(subs_fe: DataFrame, accounts_fe: DataFrame) -> DataFrame:
    keys = accounts_fe.select(F.col("account_id").alias("_acct"))
    return subs_fe.join(keys, F.col("account_id") == F.col("_acct"), "left_anti")


def _count(cond: Column) -> Column:
    return F.count_if(F.coalesce(cond, F.lit(False)))


def _long(wide: DataFrame, severity: Mapping[str, str]) -> DataFrame:
    cells = [F.struct(F.lit(c).alias("check"), F.lit(severity[c]).alias("severity"),
                      F.col(c).cast("bigint").alias("violations")) for c in wide.columns]
    return wide.select(F.inline(F.array(*cells)))


def validation_checks(tables: Mapping[str, DataFrame], accounts: DataFrame | None = None) -> DataFrame:
    """Checks with their number of violating rows: orphans, date order, negative amounts, required columns.

    Only subscriptions and account ids are read, of the other tables the schema.  ``accounts`` are rows that hold the ids
    of the account table, for a caller that has only planned that table.
    """
    subs = tables["subscriptions"]
    orphans = orphan_subscriptions(subs, tables["accounts"] if accounts is None else accounts).agg(F.count(F.lit(1)).alias("orphan_account_id"))
    rows = subs.agg(
        _count(F.col("start_date") > F.col("end_date")).alias("start_after_end"),
        _count(F.col("churn_date") < F.col("start_date")).alias("churn_before_start"),
        _count(F.col("mrr_clean") < 0).alias("negative_mrr"), _count(F.col("arr_clean") < 0).alias("negative_arr"))
    lacking = len(missing_columns(tables))
    schema = subs.sparkSession.createDataFrame([("missing_required_columns", "error", lacking)],
                                               "check string, severity string, violations bigint")
    info = dict.fromkeys(("orphan_account_id", "negative_mrr", "negative_arr"), "error")
    info |= {"start_after_end": "error", "churn_before_start": "warning"}
    return schema.unionByName(_long(orphans, info)).unionByName(_long(rows, info))


def verdict(checks: DataFrame) -> DataFrame:
    """PASS when no check of severity error has a violation."""
    failed = F.coalesce(F.sum(F.when(F.col("severity") == "error", F.col("violations"))), F.lit(0))
    return checks.agg(failed.alias("error_rows")).select(
        F.when(F.col("error_rows") == 0, "PASS").otherwise("FAIL").alias("verdict"), "error_rows")


def missingness(tables: Mapping[str, DataFrame], limit: float = MISSING_LIMIT,
                names: Sequence[str] = MISSINGNESS_TABLES) -> DataFrame:
    """Columns whose share of nulls is above ``limit``."""
    parts = []
    for n in names:
        df = tables[n]
        one = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(F.col(c)).alias(c) for c in df.columns])
        cells = [F.struct(F.lit(c).alias("column_name"),
                          numeric.ratio(F.col("_rows") - F.col(c), F.col("_rows")).alias("missing_pct"))
                 for c in df.columns]
        parts.append(one.select(F.lit(n).alias("table_name"), F.inline(F.array(*cells))))
    return reduce(DataFrame.unionByName, parts).where(F.col("missing_pct") > limit)


def constant_columns(tables: Mapping[str, DataFrame], names: Sequence[str] = CONSTANT_TABLES) -> DataFrame:
    """Numeric columns with at most one distinct value (min equals max, or all null)."""
    parts = []
    for n in names:
        df = tables[n]
        cols = [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]
        one = df.agg(*[F.coalesce(F.min(c) == F.max(c), F.lit(True)).alias(c) for c in cols],
                     F.count(F.lit(1)).alias("_rows"))
        cells = [F.struct(F.lit(c).alias("column_name"), (F.col(c) & (F.col("_rows") > 0)).alias("_same")) for c in cols]
        parts.append(one.select(F.lit(n).alias("table_name"), F.inline(F.array(*cells))).where("_same").drop("_same"))
    return reduce(DataFrame.unionByName, parts)


def is_derived(column: str) -> bool:
    return column.startswith(DERIVED_PREFIXES) or column in DERIVED_COLUMNS


def schema_doc(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table and column: type, derived or not, nulls, a sample (the smallest non-null value)."""
    parts = []
    for n, df in tables.items():
        aggs = [F.count(F.lit(1)).alias("_rows")]
        for i, f in enumerate(df.schema):
            shown = F.min(F.to_json(f.name) if isinstance(f.dataType, T.ArrayType) else F.col(f.name)).cast("string")
            aggs += [F.count(F.col(f.name)).alias(f"_n{i}"), shown.alias(f"_s{i}")]
        cells = [F.struct(
            F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("dtype"),
            F.lit(is_derived(f.name)).alias("synthetic"), (F.col("_rows") - F.col(f"_n{i}")).alias("null_count"),
            F.coalesce(F.bround(numeric.ratio((F.col("_rows") - F.col(f"_n{i}")) * 100, F.col("_rows")), 2),
                       F.lit(0.0)).alias("null_pct"),
            F.coalesce(F.col(f"_s{i}"), F.lit("NULL")).alias("sample")) for i, f in enumerate(df.schema)]
        parts.append(df.agg(*aggs).select(F.lit(n).alias("table_name"), F.col("_rows").alias("rows"),
                                          F.inline(F.array(*cells))))
    return reduce(DataFrame.unionByName, parts)


# ------------------------------------------------------------- deep validation
def churned_without_date(subs_fe: DataFrame) -> DataFrame:
    return subs_fe.where(F.col("is_churned") & F.col("churn_date").isNull())


def active_with_churn_date(subs_fe: DataFrame) -> DataFrame:
    return subs_fe.where(~F.col("is_churned") & F.col("churn_date").isNotNull())


def churn_after_end(subs_fe: DataFrame) -> DataFrame:
    return subs_fe.where(F.col("churn_date") > F.col("end_date"))


def unique_right(right: DataFrame, key: str, *columns: str) -> DataFrame:
    """``key`` and ``columns`` of the right side of a many-to-one join, which fails on an executor when a key occurs twice.

    The check is part of the aggregate that brings the rows of a key together; the
    error names the key.  Null keys match nothing and are left out.
    """
    held = F.count(F.lit(1))
    broken = F.raise_error(F.concat(F.lit(f"many-to-one join: {key} "), F.col(key).cast("string"), F.lit(" occurs "),
                                    held.cast("string"), F.lit(" times on the right side")))
    kinds = dict(right.dtypes)
    return right.where(F.col(key).isNotNull()).groupBy(key).agg(
        *[F.when(held == 1, F.any_value(c)).otherwise(broken.cast(kinds[c])).alias(c) for c in columns])


def first_use_before_signup(fu: DataFrame, accounts_fe: DataFrame) -> DataFrame:
    """First uses earlier than the signup date of their account; an account that the account table holds twice is an error."""
    signup = unique_right(accounts_fe, "account_id", "signup_date").toDF("_acct", "_signup")
    return (fu.join(signup, F.col("account_id") == F.col("_acct"), "inner")
            .where(F.col("first_use_date") < F.col("_signup")).drop("_acct", "_signup"))


def negative_cohort_months(cohorts: DataFrame) -> DataFrame:
    return cohorts.where(F.col("months_since_signup") < 0)


def deep_validation(subs_fe: DataFrame, accounts_fe: DataFrame, fu: DataFrame, cohorts: DataFrame) -> DataFrame:
    """Counts of the deep checks A1 to C1."""
    subs = subs_fe.agg(
        _count(F.col("is_churned") & F.col("churn_date").isNull()).alias("B1_churned_without_date"),
        _count(~F.col("is_churned") & F.col("churn_date").isNotNull()).alias("B2_active_with_churn_date"),
        _count(F.col("churn_date") > F.col("end_date")).alias("B3_churn_after_end"))
    a1 = fu.agg(_count(F.col("days_to_adopt") == 0).alias("A1_zero_days_to_adopt"))
    a2 = first_use_before_signup(fu, accounts_fe).agg(F.count(F.lit(1)).alias("A2_first_use_before_signup"))
    c1 = cohorts.agg(_count(F.col("months_since_signup") < 0).alias("C1_negative_months"))
    parts = []
    for wide in (a1, a2, subs, c1):
        cells = [F.struct(F.lit(c).alias("check"), F.col(c).cast("bigint").alias("violations")) for c in wide.columns]
        parts.append(wide.select(F.inline(F.array(*cells))))
    return reduce(DataFrame.unionByName, parts)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per output table."""
    return reduce(DataFrame.unionByName, [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("table_name"), "rows")
        for n, df in tables.items()])
