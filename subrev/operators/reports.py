"""Metric reports: feature tables to small report frames."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from subrev import specs
from subrev.functions import cases, dates, numeric, sketches
from subrev.functions.quantiles import describe, describe_days, exact_quantiles
from subrev.operators import ledger


# --------------------------------------------------------------- subscriptions
def trial_conversion(subs_fe: DataFrame, accounts_fe: DataFrame) -> DataFrame:
    """Accounts that ever had a trial, how many of them ever paid, and the rate."""
    trial = (subs_fe.where((F.col("subscription_status") == "trial") | (F.col("plan_tier") == "Trial"))
             .groupBy("account_id").agg(F.lit(1).alias("_trial")))
    paid = (accounts_fe.where(F.col("lifetime_gross_mrr") > 0)
            .groupBy(F.col("account_id").alias("_acct")).agg(F.lit(True).alias("_paid")))
    both = trial.join(paid, F.col("account_id") == F.col("_acct"), "left").agg(
        F.count(F.lit(1)).cast("double").alias("total_trial_accounts"),
        F.count("_paid").cast("double").alias("converted_to_paid"))
    both = both.withColumn("conversion_rate", numeric.ratio_or_zero(
        F.col("converted_to_paid"), F.col("total_trial_accounts")))
    return both.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("metric"), F.col(c).alias("value")) for c in both.columns])))


def _days_median(c: str) -> Column:
    """Median of a day count: its exact aggregate keeps one counter per day of the calendar at most."""
    return F.median(F.col(c).cast("double"))


def subs_churn_summary(subs_fe: DataFrame) -> DataFrame:
    return subs_fe.groupBy("is_churned").agg(
        F.count("subscription_id").alias("subscriptions"), F.avg("mrr_clean").alias("avg_mrr"),
        _days_median("subscription_age_days").alias("median_age"))


def subs_mrr_stats(subs_fe: DataFrame, approx: bool = False) -> DataFrame:
    return describe(subs_fe, F.col("mrr_clean"), "mrr_clean", approx)


def subs_top_decile_stats(subs_fe: DataFrame) -> DataFrame:
    """Subscriptions at or above the 90th percentile of revenue against the rest."""
    limit = exact_quantiles(subs_fe, {"m": F.col("mrr_clean")}, (0.9,)).select("q0").scalar()
    return subs_fe.groupBy(F.coalesce(F.col("mrr_clean") >= limit, F.lit(False)).alias("is_top_decile")).agg(
        F.count("subscription_id").alias("subscriptions"), numeric.sum_or_zero(F.col("mrr_clean")).alias("total_mrr"),
        F.avg(F.col("is_churned").cast("double")).alias("churn_rate"))


def subs_plan_tier_distribution(subs_fe: DataFrame) -> DataFrame:
    return subs_fe.where(F.col("plan_tier").isNotNull()).groupBy("plan_tier").agg(
        F.count("subscription_id").alias("subscriptions"), numeric.sum_or_zero(F.col("mrr_clean")).alias("total_mrr"),
        F.avg("mrr_clean").alias("avg_mrr"))


def subs_status_distribution(subs_fe: DataFrame) -> DataFrame:
    return subs_fe.groupBy("subscription_status").agg(
        F.count("subscription_id").alias("subscriptions"), F.avg("mrr_clean").alias("avg_mrr"),
        _days_median("subscription_age_days").alias("median_age"))


def subs_tenure_stats(subs_fe: DataFrame) -> DataFrame:
    return describe_days(subs_fe, "is_churned", F.col("subscription_age_days"))


# -------------------------------------------------------------------- accounts
def acct_mrr_stats_global(accounts_fe: DataFrame, approx: bool = False) -> DataFrame:
    return describe(accounts_fe, F.coalesce("total_mrr", F.lit(0.0)), "total_mrr", approx)


def acct_mrr_stats_paying_only(accounts_fe: DataFrame, approx: bool = False) -> DataFrame:
    return describe(accounts_fe.where(F.col("total_mrr") > 0), F.col("total_mrr"), "total_mrr", approx)


def acct_churn_comparison(accounts_fe: DataFrame) -> DataFrame:
    return accounts_fe.groupBy(F.col("churn_date").isNotNull().alias("is_account_churned")).agg(
        F.count("account_id").alias("accounts"), F.avg("total_mrr").alias("avg_current_mrr"),
        F.avg("lifetime_gross_mrr").alias("avg_lifetime_value"), F.avg("health_score").alias("avg_health"))


def acct_segment_distribution(accounts_fe: DataFrame) -> DataFrame:
    return accounts_fe.groupBy("customer_segment").agg(
        F.count("account_id").alias("accounts"), numeric.sum_or_zero(F.col("total_mrr")).alias("total_mrr"),
        F.avg("health_score").alias("avg_health"))


def acct_paying_aov_stats(accounts_fe: DataFrame, approx: bool = False) -> DataFrame:
    """Describe of lifetime revenue per subscription, accounts that ever paid."""
    payers = accounts_fe.where(F.col("lifetime_gross_mrr") > 0)
    n = F.col("num_subscriptions_lifetime")
    return describe(payers, F.col("lifetime_gross_mrr") / F.when(n == 0, 1).otherwise(n), "lifetime_aov", approx)


def ltv_proxy_by_segment(accounts_fe: DataFrame) -> DataFrame:
    return accounts_fe.groupBy("customer_segment").agg(
        F.avg("lifetime_gross_mrr").alias("avg_lifetime_gross_mrr"),
        F.avg(F.col("lifetime_days") / 30.0).alias("avg_months_active"), F.count("account_id").alias("account_count"))


DEPTH_LABELS = ("Low", "Med-Low", "Med-High", "High")


def feature_depth_vs_churn(accounts_fe: DataFrame) -> DataFrame:
    """Quartile bins (lo, hi] of feature depth against churn. Equal edges merge bins into the lower label;
    a bin without accounts is reported with 0."""
    depth = F.col("avg_monthly_active_features")
    edges = exact_quantiles(accounts_fe, {"d": depth}, (0.25, 0.5, 0.75)).select(F.struct("q0", "q1", "q2")).scalar()
    binned = accounts_fe.where(depth.isNotNull()).select("churn_date", depth.alias("_d")).withColumn("_e", edges)
    label = F.when(F.col("_d") <= F.col("_e")["q0"], DEPTH_LABELS[0])
    for i in (1, 2):
        label = label.when(F.col("_d") <= F.col("_e")[f"q{i}"], DEPTH_LABELS[i])
    counted = binned.groupBy(label.otherwise(DEPTH_LABELS[3]).alias("feature_depth_bin")).agg(
        F.count(F.lit(1)).alias("total_accounts"), F.count("churn_date").alias("churned_accounts"))
    empty = accounts_fe.sparkSession.createDataFrame(
        [(x, 0, 0) for x in DEPTH_LABELS], "feature_depth_bin string, total_accounts bigint, churned_accounts bigint")
    return (counted.unionByName(empty).groupBy("feature_depth_bin")
            .agg(F.sum("total_accounts").alias("total_accounts"), F.sum("churned_accounts").alias("churned_accounts"))
            .withColumn("churn_rate", numeric.ratio(F.col("churned_accounts"), F.col("total_accounts"))))


# -------------------------------------------------------------------- features
def adoption_sketches(fm: DataFrame) -> DataFrame:
    """Accounts per feature and month, as sketches to keep and merge."""
    return fm.where(F.col("feature_name").isNotNull()).groupBy("feature_name", "usage_month").agg(
        sketches.distinct_sketch(F.col("account_id")).alias("accounts"))


def feature_adoption(fm: DataFrame, approx: bool = False) -> DataFrame:
    """Accounts per feature. Pairs are reduced before they are counted; ``approx`` merges the sketches of the months."""
    if approx:
        merged = adoption_sketches(fm).groupBy("feature_name").agg(sketches.merged_distinct(F.col("accounts")).alias("accounts"))
        return merged.select("feature_name", sketches.distinct_estimate(F.col("accounts")).alias("accounts_used"))
    return (fm.where(F.col("feature_name").isNotNull()).select("feature_name", "account_id").distinct()
            .groupBy("feature_name").agg(F.count("account_id").alias("accounts_used")))


def feature_usage_distribution(fm: DataFrame) -> DataFrame:
    return fm.where(F.col("feature_name").isNotNull()).groupBy("feature_name").agg(
        numeric.sum_or_zero(F.col("usage_count")).alias("total_usage"))


def feature_first_use_stats(fu: DataFrame, approx: bool = False) -> DataFrame:
    return describe(fu, F.col("days_to_adopt"), "days_to_adopt", approx)


def usage_monthly_trends(monthly: DataFrame) -> DataFrame:
    return monthly.where(F.col("usage_month").isNotNull()).groupBy("usage_month").agg(
        numeric.sum_or_zero(F.col("usage_count_month")).alias("total_usage"),
        F.avg("usage_intensity").alias("avg_intensity"))


# --------------------------------------------------------------------- cohorts
# From the cohort table, which has one row per subscription and month.
def cohort_sketches(cohorts: DataFrame) -> DataFrame:
    """Active and churned subscriptions per cohort and month, as sketches to keep and merge."""
    gone = F.when(F.col("is_churned_month"), F.col("subscription_id"))
    return cohorts.groupBy("cohort_month", "months_since_signup").agg(
        sketches.distinct_sketch(F.col("subscription_id")).alias("active"), sketches.distinct_sketch(gone).alias("churned"))


def cohort_retention(cohorts: DataFrame, approx: bool = False) -> DataFrame:
    """Subscriptions per cohort and month; ``approx`` also holds for rows that repeat a subscription in a month."""
    if approx:
        return cohort_sketches(cohorts).select("cohort_month", "months_since_signup", sketches.distinct_estimate(F.col("active")).alias("active_subs"))
    return cohorts.groupBy("cohort_month", "months_since_signup").agg(F.count("subscription_id").alias("active_subs"))


def cohort_churn_lifecycle(cohorts: DataFrame, approx: bool = False) -> DataFrame:
    """Subscriptions that churn per month of their life; ``approx`` merges the sketches of the cohorts."""
    if approx:
        merged = cohort_sketches(cohorts).groupBy("months_since_signup").agg(sketches.merged_distinct(F.col("churned")).alias("churned"))
        return merged.select("months_since_signup", sketches.distinct_estimate(F.col("churned")).alias("churned_subs")).where("churned_subs > 0")
    return cohorts.where("is_churned_month").groupBy("months_since_signup").agg(
        F.count("subscription_id").alias("churned_subs"))


def _with_baseline(curve: DataFrame, key: str) -> DataFrame:
    """Month-0 revenue beside every month; a group has one row per month."""
    first = F.max(F.when(F.col("months_since_signup") == 0, F.col("mrr"))).over(Window.partitionBy(key))
    return curve.withColumn("starting_mrr", first).withColumn(
        "nrr_pct", numeric.ratio(F.col("mrr"), F.col("starting_mrr")))


def cohort_nrr_curve(cohorts: DataFrame) -> DataFrame:
    curve = cohorts.groupBy("cohort_month", "months_since_signup").agg(
        numeric.sum_or_zero(F.col("mrr")).alias("mrr"))
    return _with_baseline(curve, "cohort_month")


# From the subscriptions (each id once): same reports without the monthly rows.
def retention_from_subs(subs_fe: DataFrame, as_of: date | str, active_only: bool = False) -> DataFrame:
    """``active_only`` leaves out the month in which a subscription drops to 0."""
    rows = ledger.expand_spans(ledger.cohort_spans(subs_fe, as_of))
    subs = "paying_subs" if active_only else "subs"
    out = rows.groupBy("cohort_month", "months_since_signup").agg(F.sum(subs).alias("active_subs"))
    return out.where(F.col("active_subs") > 0) if active_only else out


def churn_lifecycle_from_subs(subs_fe: DataFrame, as_of: date | str) -> DataFrame:
    rows = ledger.expand_spans(ledger.cohort_spans(subs_fe, as_of))
    return (rows.groupBy("months_since_signup").agg(F.sum("churned").alias("churned_subs"))
            .where(F.col("churned_subs") > 0))


def nrr_from_subs(subs_fe: DataFrame, as_of: date | str) -> DataFrame:
    rows = ledger.expand_spans(ledger.cohort_spans(subs_fe, as_of))
    curve = rows.groupBy("cohort_month", "months_since_signup").agg(F.sum("mrr").alias("mrr"))
    return _with_baseline(curve, "cohort_month")


def saas_quick_ratio(changes: DataFrame) -> DataFrame:
    """Monthly gains over losses; 999.0 without losses, 0 with neither."""
    size = F.abs("change_amount")
    kind = F.col("change_type")
    return changes.groupBy("month").agg(
        F.coalesce(F.sum(F.when(kind.isin("new", "expansion"), size)), F.lit(0.0)).alias("gains"),
        F.coalesce(F.sum(F.when(kind.isin("contraction", "churn", "loss"), size)), F.lit(0.0)).alias("losses"),
    ).withColumn("quick_ratio", cases.quick_ratio(F.col("gains"), F.col("losses")))


# ----------------------------------------------------------------- opportunity
def cohort_nrr_by_segment(subs_fe: DataFrame, accounts_fe: DataFrame, as_of: date | str,
                          months: int | None = None) -> DataFrame:
    """Revenue kept by segment over the months from the start, all of them or the first ``months``.

    A subscription runs to its churn date, else to the newest end date of the
    data (else ``as_of``); one whose churn month is before its start has no
    month.  Subscriptions are folded to (segment, months) before they are
    expanded.
    """
    df = subs_fe.where(F.lower(F.trim("subscription_status")).isin(*specs.VALID_STATUSES))
    segments = accounts_fe.select(F.col("account_id").alias("_acct"), "customer_segment")
    newest = df.agg(F.max("end_date")).scalar()
    df = df.select("account_id", "start_date", "churn_date", "mrr_clean").withColumn(
        "_end", F.coalesce("churn_date", newest, dates.as_date_lit(as_of)))
    span = F.when(F.col("start_date").isNull(), 1).otherwise(
        F.greatest(F.lit(0), dates.months_between(F.col("start_date"), F.col("_end")) + 1))
    folded = (df.where(F.col("mrr_clean") != 0)
              .withColumn("months", span if months is None else F.least(span, F.lit(months)))
              .where(F.col("months") > 0)
              .groupBy("account_id", "months").agg(F.sum("mrr_clean").alias("mrr"))
              .join(segments, F.col("account_id") == F.col("_acct"), "left")
              .groupBy(F.coalesce("customer_segment", F.lit("SMB")).alias("customer_segment"), "months")
              .agg(F.sum("mrr").alias("mrr")))
    each = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("months") - 1))
    curve = (folded.withColumn("months_since_signup", each)
             .groupBy("customer_segment", "months_since_signup").agg(F.sum("mrr").alias("mrr")))
    return _with_baseline(curve, "customer_segment")


def support_segment_stats(accounts_fe: DataFrame, unique_keys: bool = True, approx: bool = False) -> DataFrame:
    """Tickets per account and revenue per ticket, by segment; ``approx`` estimates the different accounts by a sketch."""
    accounts = (sketches.distinct_estimate(sketches.distinct_sketch(F.col("account_id"))) if approx
                else F.count("account_id") if unique_keys else F.countDistinct("account_id"))
    stats = accounts_fe.groupBy("customer_segment").agg(
        F.sum("ticket_count").cast("double").alias("total_tickets"), accounts.alias("active_accounts"),
        numeric.sum_or_zero(F.col("total_mrr")).alias("total_revenue"))
    return stats.withColumns({
        "tickets_per_account": F.bround(numeric.ratio(F.col("total_tickets"), F.col("active_accounts")), 1),
        "revenue_per_ticket": F.bround(numeric.ratio_or_zero(F.col("total_revenue"), F.col("total_tickets")), 2)})
