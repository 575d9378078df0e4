"""Feature tables built from the clean tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from subrev import specs
from subrev.functions import cases, dates, numeric, text
from subrev.functions.quantiles import exact_quantiles
from subrev.functions.reasons import FLAG, REASONS, append_reasons, empty_reasons, reason_count


def _keys(column: str, unique: bool) -> Column:
    """Number of different keys. Where the input holds each key once, a count is the same and needs
    no second exchange."""
    return F.count(column) if unique else F.countDistinct(column)


# ------------------------------------------------------------------- load step
def load_inputs(clean: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Typed inputs of the feature stage from the five clean tables (texts are parsed once, here).

    Cleaned columns are used wherever one exists.
    """
    return {name: load_input(name, clean) for name in clean}


ID_COLUMNS = ("account_id", "subscription_id", "usage_id", "ticket_id", "churn_event_id")


def text_ids(df: DataFrame) -> DataFrame:
    """Ids as text, whatever type the table was stored with, so that joins compare like with like; "None" is no id."""
    ids = {c: F.col(c).cast("string") for c in ID_COLUMNS if c in df.columns}
    return df.withColumns({c: F.when(v != "None", v) for c, v in ids.items()})


def load_input(name: str, clean: Mapping[str, DataFrame]) -> DataFrame:
    if name == "subscriptions":
        return _load_subscriptions(text_ids(clean["subscriptions"]), load_input("accounts", clean))
    return _LOADERS[name](text_ids(clean[name]))


def _load_accounts(acc: DataFrame) -> DataFrame:
    return acc.select(
        "account_id", "account_name", "industry_clean", "country_clean",
        dates.parse_day_first(F.col("signup_date")).alias("signup_date"),
        dates.parse_day_first(F.col("account_churn_date_clean")).alias("churn_date"), FLAG, REASONS)


def _load_subscriptions(sub: DataFrame, accounts: DataFrame) -> DataFrame:
    churn_of = accounts.where(F.col("churn_date").isNotNull()).select(F.col("account_id").alias("_acct"), "churn_date")
    return sub.select(
        "subscription_id", "account_id",
        dates.parse_day_first(F.col("start_date")).alias("start_date"),
        dates.parse_day_first(F.col("end_date_clean")).alias("end_date"),
        "plan_tier", "plan_tier_imputed", "seats", "mrr_amount_clean", "arr_amount_clean", "is_trial",
        text.is_true(F.col("upgrade_flag")).alias("upgrade_flag"),
        text.is_true(F.col("downgrade_flag")).alias("downgrade_flag"),
        text.is_true(F.col("churn_flag")).alias("churn_flag"), FLAG, REASONS,
    ).join(churn_of, F.col("account_id") == F.col("_acct"), "left").drop("_acct")


def _load_usage(use: DataFrame) -> DataFrame:
    return use.select(
        "usage_id", "subscription_id", dates.parse_day_first(F.col("usage_date")).alias("usage_date"),
        F.col("feature_name_imputed").alias("feature_name"),
        F.col("usage_count_clean").cast("bigint").alias("usage_count"),
        F.col("usage_duration_secs_clean").cast("bigint").alias("usage_duration_secs"),
        text.strict_number(F.col("error_count")).cast("bigint").alias("error_count"),
        text.is_true(F.col("is_beta_feature")).alias("is_beta_feature"))


def _load_tickets(tic: DataFrame) -> DataFrame:
    return tic.select(
        "ticket_id", "account_id", dates.parse_day_first_time(F.col("submitted_at")).alias("submitted_at"),
        dates.parse_day_first_time(F.col("closed_at")).alias("closed_at"),
        F.col("resolution_hours_clean").alias("resolution_time_hours"),
        F.coalesce(text.signed_number(F.col("resolution_time_hours")) < 0, F.lit(False)).alias("was_negative"),
        text.nonblank(F.col("priority")).alias("priority"),
        text.is_true(F.col("escalation_flag")).alias("escalation_flag"),
        text.strict_number(F.col("satisfaction_score")).alias("satisfaction_score"), FLAG, REASONS)


def _load_events(chu: DataFrame) -> DataFrame:
    return chu.select("churn_event_id", "account_id", dates.parse_day_first(F.col("churn_date")).alias("churn_date"))


_LOADERS = {"accounts": _load_accounts, "feature_usage": _load_usage, "support_tickets": _load_tickets,
            "churn_events": _load_events}


# --------------------------------------------------------------- subscriptions
# The columns of the table, in their order.
SUBSCRIPTION_COLUMNS = (
    "subscription_id", "account_id", "start_date", "end_date", "start_month", "end_month",
    "subscription_age_days", "subscription_age_months", "mrr_clean", "arr_clean", "lifetime_mrr", "churned_mrr",
    "is_churned", "churn_date", "churn_month", "plan_tier", "seat_bucket", "seats", "rev_change_flag",
    "subscription_status", "is_new", "is_upgrade", "is_downgrade", FLAG, REASONS, "dirty_row_reason_count")


def subscription_features(subs: DataFrame, churn: DataFrame, as_of: date | str) -> DataFrame:
    """One row per subscription, 26 columns.

    Per-account facts (first start, first churn event) are aggregated with
    map-side combine and joined back, so that an account with very many
    subscriptions never sits in one window partition.
    """
    first_event = churn.where(F.col("account_id").isNotNull()).groupBy("account_id").agg(
        F.min_by("churn_date", F.when(F.col("churn_date").isNotNull(), F.col("churn_event_id"))).alias("_event_date"))
    first_start = subs.where(F.col("account_id").isNotNull()).groupBy("account_id").agg(
        F.min("start_date").alias("_first_start"))
    facts = first_start.join(first_event, "account_id", "left").withColumnRenamed("account_id", "_acct")
    df = subs.join(facts, F.col("account_id") == F.col("_acct"), "left")

    today = dates.as_date_lit(as_of)
    df = df.withColumns({
        "mrr_clean": F.coalesce(F.col("mrr_amount_clean"), F.lit(0.0)),
        "churn_date": F.coalesce("churn_date", "_event_date"),
        "plan_tier": cases.first_nonblank(F.col("plan_tier_imputed"), F.col("plan_tier")),
        "_end": F.coalesce(F.col("end_date"), today)})
    df = df.withColumns({
        "arr_clean": F.coalesce(F.col("arr_amount_clean"), numeric.money(F.col("mrr_clean") * 12.0)),
        "is_churned": F.coalesce("churn_flag", F.lit(False)) | F.col("churn_date").isNotNull(),
        "subscription_age_days": F.greatest(F.lit(0), dates.days_between(F.col("start_date"), F.col("_end"))),
        "subscription_age_months": F.greatest(F.lit(0), dates.months_between(F.col("start_date"), F.col("_end")))})
    no_start = F.col("start_date").isNull()
    df = df.withColumns({
        "subscription_age_days": F.when(~no_start, F.col("subscription_age_days")),
        "subscription_age_months": F.when(~no_start, F.col("subscription_age_months"))})
    df = df.withColumns({
        "lifetime_mrr": numeric.money(F.col("mrr_clean") * F.coalesce("subscription_age_months", F.lit(0))),
        "churned_mrr": F.when(F.col("is_churned"), F.col("mrr_clean")).otherwise(0.0),
        "start_month": dates.month_key(F.col("start_date")), "end_month": dates.month_key(F.col("end_date")),
        "churn_month": dates.month_key(F.col("churn_date")),
        "seat_bucket": cases.seat_bucket(F.col("seats")),
        "seats": text.strict_number(F.col("seats")).cast("bigint"),
        "rev_change_flag": cases.revenue_change_flag(F.col("upgrade_flag"), F.col("downgrade_flag")),
        "subscription_status": cases.subscription_status(F.col("is_churned"), F.col("is_trial"), F.col("end_date")),
        "is_new": F.coalesce(F.col("start_date") == F.col("_first_start"), F.lit(False)),
        "is_upgrade": F.col("upgrade_flag"), "is_downgrade": F.col("downgrade_flag"),
        "dirty_row_reason_count": reason_count(F.col(REASONS))})
    return df.select(*SUBSCRIPTION_COLUMNS)


# ----------------------------------------------------------------------- usage
def usage_with_account(usage: DataFrame, subs_fe: DataFrame) -> DataFrame:
    """Usage rows with month and account; a native account id wins over the subscription's."""
    owner = subs_fe.select(F.col("subscription_id").alias("_sub"), F.col("account_id").alias("_owner"))
    df = usage.join(owner, F.col("subscription_id") == F.col("_sub"), "left")
    account = F.coalesce("account_id", "_owner") if "account_id" in usage.columns else F.col("_owner")
    return df.withColumns({"account_id": account, "usage_month": dates.month_key(F.col("usage_date"))}).drop(
        "_sub", "_owner")


def usage_monthly(usage: DataFrame, keep: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Subscription x month. "Heavy" means above the median month of all subscriptions.

    The usage rows are moved once: the different features of a month are a set, which holds no more than
    the features there are.  ``keep`` may write the monthly rows before the median
    reads them, so that the usage rows are scanned once.
    """
    monthly = usage.groupBy("subscription_id", dates.month_key(F.col("usage_date")).alias("usage_month")).agg(
        numeric.sum_or_zero(F.col("usage_count")).alias("usage_count_month"),
        numeric.sum_or_zero(F.col("usage_duration_secs")).cast("double").alias("usage_duration_month"),
        F.size(F.collect_set("feature_name")).cast("bigint").alias("unique_features_month"),
        numeric.sum_or_zero(F.col("error_count")).alias("error_count_month"),
        F.coalesce(F.max(dates.days_in_month(F.col("usage_date"))), F.lit(0)).cast("bigint").alias("days_in_month"))
    monthly = monthly.withColumns({
        "duration_per_use": numeric.ratio(F.col("usage_duration_month"), F.col("usage_count_month")),
        "usage_intensity": numeric.ratio(F.col("usage_count_month"), F.col("days_in_month"))})
    if keep is not None:
        monthly = keep(monthly)
    median = exact_quantiles(monthly, {"m": F.col("usage_count_month")}, (0.5,)).select("q0").scalar()
    return monthly.withColumn("is_heavy_user_month", F.col("usage_count_month") > F.coalesce(median, F.lit(0.0)))


def feature_month(usage: DataFrame, keep: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Subscription x account x feature x month with the feature's dense rank in the account-month.

    The rank is taken over the distinct counts of an account-month, then joined
    back, so that the rows of one very large account are not sorted in one task.
    ``keep`` may write the rows before the ranks read them again.
    """
    fm = usage.groupBy("subscription_id", "account_id", "feature_name", "usage_month").agg(
        numeric.sum_or_zero(F.col("usage_count")).alias("usage_count"),
        numeric.sum_or_zero(F.col("usage_duration_secs")).alias("usage_duration_secs"),
        F.min("usage_date").alias("first_use_date"), F.max("usage_date").alias("last_use_date"),
        numeric.sum_or_zero(F.col("error_count")).alias("error_count"),
        F.max("is_beta_feature").alias("is_beta_feature"))
    fm = fm.withColumn("duration_per_use", F.when(
        F.col("usage_count") > 0, numeric.ratio(F.col("usage_duration_secs"), F.col("usage_count"))))
    if keep is not None:
        fm = keep(fm)
    return dense_rank_by_group(fm, ("account_id", "usage_month"), "usage_count", "account_feature_rank")


#: Values that one bucket of a dense rank spans.
RANK_SPAN = 1 << 16


def dense_rank_by_group(df: DataFrame, group: tuple[str, ...], value: str, out: str, span: int = RANK_SPAN) -> DataFrame:
    """Dense rank of a whole number ``value`` (descending, null last) in a group, computed on the distinct values only.

    Two levels: the rank inside a bucket of values, and the count of different values in
    the greater buckets of the group, so that a group of very many values is not sorted in one task.
    """
    keys = [f"_g_{g}" for g in group]
    levels = df.select(*[F.col(g).alias(k) for g, k in zip(group, keys)], F.col(value).alias("_v")).distinct()
    levels = levels.withColumn("_span", F.floor(F.col("_v") / span))
    inside = F.row_number().over(Window.partitionBy(*keys, "_span").orderBy(F.col("_v").desc()))
    sizes = levels.groupBy(*keys, "_span").agg(F.count(F.lit(1)).alias("_n"))
    greater = Window.partitionBy(*keys).orderBy(F.col("_span").desc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    above = sizes.select(*[F.col(k).alias(f"_a{k}") for k in keys], F.col("_span").alias("_of"), F.coalesce(F.sum("_n").over(greater), F.lit(0)).alias("_above"))
    same = F.col("_span").eqNullSafe(F.col("_of"))
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_a{k}"))
    ranks = levels.withColumn("_inside", inside).join(above, same)
    ranks = ranks.select(*keys, "_v", (F.col("_inside") + F.col("_above")).alias(out))
    on = F.col(value) == F.col("_v")
    for g in group:
        on = on & F.col(g).eqNullSafe(F.col(f"_g_{g}"))
    return df.join(ranks, on, "left").drop("_v", *[f"_g_{g}" for g in group])


def first_use(fm: DataFrame, accounts: DataFrame) -> DataFrame:
    """Account x feature: first use, days from signup to it, beta adopter (beta and within 14 days).

    Built from :func:`feature_month` output, which is already reduced.
    """
    both = F.col("account_id").isNotNull() & F.col("feature_name").isNotNull()
    fu = fm.groupBy("account_id", "feature_name").agg(
        F.min("first_use_date").alias("first_use_date"),
        F.max(F.when(both, F.col("is_beta_feature"))).alias("is_beta_feature"))
    signup = accounts.select(F.col("account_id").alias("_acct"), "signup_date")
    fu = fu.join(signup, F.col("account_id") == F.col("_acct"), "left").drop("_acct")
    raw_days = dates.days_between(F.col("signup_date"), F.col("first_use_date"))
    fu = fu.withColumns({
        "is_beta_feature": F.coalesce("is_beta_feature", F.lit(False)),
        REASONS: append_reasons(None, (raw_days < 0, "negative_days_to_adopt_adjusted")),
        "days_to_adopt": F.when(raw_days.isNotNull(), F.greatest(raw_days, F.lit(0)))})
    fu = fu.withColumns({
        FLAG: F.size(REASONS) > 0,
        "beta_adopter": F.coalesce(F.col("is_beta_feature")
                                   & (F.col("days_to_adopt") <= specs.BETA_ADOPTION_DAYS), F.lit(False))})
    return fu.select("account_id", "feature_name", "first_use_date", "days_to_adopt", "is_beta_feature",
                     "beta_adopter", "signup_date", FLAG, REASONS)


# --------------------------------------------------------------------- support
def support_events(tickets: DataFrame, subs_fe: DataFrame | None = None,
                   scores: Mapping[float, tuple[str, ...]] | None = None, hours_per_row: bool = False) -> DataFrame:
    """One row per ticket: score, bucket and four more dirty reasons.

    When no ticket at all has resolution hours they are taken from the two
    timestamps (with ``hours_per_row`` for every ticket without hours of its own); when none has an
    account, from its subscription.
    """
    df = tickets
    no_hours = (F.col("resolution_time_hours").isNull() if hours_per_row
                else tickets.agg(F.count("resolution_time_hours") == 0).scalar())
    df = df.withColumn("resolution_time_hours", F.when(
        no_hours, dates.hours_between(F.col("submitted_at"), F.col("closed_at"))).otherwise(
        F.col("resolution_time_hours")))
    if subs_fe is not None and "subscription_id" in tickets.columns:
        no_account = tickets.agg(F.count("account_id") == 0).scalar()
        owner = subs_fe.select(F.col("subscription_id").alias("_sub"), F.col("account_id").alias("_owner"))
        df = df.join(owner, F.col("subscription_id") == F.col("_sub"), "left").withColumn(
            "account_id", F.when(no_account, F.col("_owner")).otherwise(F.col("account_id"))).drop("_sub", "_owner")
    negative = F.col("resolution_time_hours") < 0
    if "was_negative" in df.columns:
        negative = negative | F.col("was_negative")
    df = df.withColumns({
        REASONS: append_reasons(
            F.col(REASONS) if REASONS in df.columns else None,
            (F.col("submitted_at").isNull(), "missing_submitted_at"),
            (F.col("priority").isNull(), "missing_priority"),
            (F.col("satisfaction_score").isNull(), "missing_satisfaction_score"),
            (negative, "resolution_time_negative_corrected")),
        "resolution_time_hours": F.abs("resolution_time_hours"),
        "priority_score": cases.priority_score(F.col("priority"), scores)})
    df = df.withColumns({FLAG: F.size(REASONS) > 0,
                         "resolution_bucket": cases.resolution_bucket(F.col("resolution_time_hours"))})
    return df.select("ticket_id", "account_id", "submitted_at", "closed_at", "resolution_time_hours", "priority",
                     "priority_score", "resolution_bucket", "escalation_flag", "satisfaction_score", FLAG, REASONS)


def support_by_account(events: DataFrame, unique_keys: bool = False) -> DataFrame:
    """Tickets per account; "90 days" counts back from the newest ticket of the data."""
    newest = events.agg(F.max("submitted_at")).scalar()
    cut = newest - F.make_dt_interval(F.lit(specs.RECENT_TICKET_DAYS))
    df = events.where(F.col("account_id").isNotNull()).withColumn(
        "_recent", F.when(F.col("submitted_at") >= cut, F.col("ticket_id")))
    return df.groupBy("account_id").agg(
        _keys("ticket_id", unique_keys).alias("ticket_count"),
        F.coalesce(F.count_if("escalation_flag"), F.lit(0)).alias("escalated_tickets"),
        F.avg("resolution_time_hours").alias("avg_resolution_hours"),
        F.avg("satisfaction_score").alias("avg_satisfaction"), F.avg("priority_score").alias("avg_priority_score"),
        _keys("_recent", unique_keys).alias("tickets_90_days"))


# -------------------------------------------------------------------- accounts
# The columns of the table, in their order.
ACCOUNT_COLUMNS = (
    "account_id", "account_name", "industry_clean", "country_clean", "signup_date", "churn_date", "total_mrr",
    "total_arr", "avg_mrr", "max_mrr", "lifetime_gross_mrr", "total_churned_mrr", "num_subscriptions_lifetime",
    "num_active_subscriptions", "num_churns", "lifetime_days", "total_usage_count", "avg_monthly_active_features",
    "ticket_count", "tickets_90_days", "avg_resolution_hours", "avg_satisfaction", "avg_priority_score",
    "escalated_tickets", "escalation_rate", "tickets_per_active_subscription", "usage_score", "support_score",
    "revenue_score", "health_score", "customer_segment", FLAG, REASONS, "daily_usage_rate")


def revenue_by_account(subs_fe: DataFrame, unique_keys: bool = False) -> DataFrame:
    """Lifetime and current (not churned) revenue per account in one aggregate."""
    live = ~F.col("is_churned")
    mrr = F.col("mrr_clean")
    df = subs_fe.where(F.col("account_id").isNotNull()).withColumn(
        "_live_id", F.when(live, F.col("subscription_id")))
    return df.groupBy("account_id").agg(
        numeric.sum_or_zero(mrr).alias("lifetime_gross_mrr"),
        _keys("subscription_id", unique_keys).alias("num_subscriptions_lifetime"),
        F.count_if("is_churned").alias("num_churns"), numeric.sum_or_zero(F.col("churned_mrr")).alias("total_churned_mrr"),
        numeric.sum_or_zero(F.when(live, mrr)).alias("total_mrr"),
        numeric.sum_or_zero(F.when(live, F.col("arr_clean"))).alias("total_arr"),
        F.coalesce(F.avg(F.when(live, mrr)), F.lit(0.0)).alias("avg_mrr"),
        F.coalesce(F.max(F.when(live, mrr)), F.lit(0.0)).alias("max_mrr"),
        _keys("_live_id", unique_keys).alias("num_active_subscriptions"))


def account_revenue(accounts: DataFrame, subs_fe: DataFrame, unique_keys: bool = False) -> DataFrame:
    """Account rows with their current revenue alone, as in :func:`account_base`."""
    paid = revenue_by_account(subs_fe, unique_keys).select(F.col("account_id").alias("_acct"), "total_mrr")
    return (accounts.select("account_id").join(paid, F.col("account_id") == F.col("_acct"), "left")
            .select("account_id", F.coalesce("total_mrr", F.lit(0)).alias("total_mrr")))


def usage_by_account(fm: DataFrame) -> DataFrame:
    """Total usage, and the mean over months of the number of different features used.

    Three reductions of shrinking size (feature, month, account), each combined
    map-side, in place of distinct counts.
    """
    per_feature = fm.where(F.col("account_id").isNotNull()).groupBy("account_id", "usage_month", "feature_name").agg(
        F.sum("usage_count").alias("c"))
    per_month = per_feature.groupBy("account_id", "usage_month").agg(
        F.sum("c").alias("c"), F.count("feature_name").alias("features"))
    return per_month.groupBy("account_id").agg(
        F.sum("c").alias("total_usage_count"),
        F.avg(F.when(F.col("usage_month").isNotNull(), F.col("features"))).alias("avg_monthly_active_features"))


def account_base(accounts: DataFrame, subs_fe: DataFrame, support: DataFrame, fm: DataFrame, as_of: date | str,
                 unique_keys: bool = False) -> DataFrame:
    """Account rows with revenue, support and usage figures; missing figures are 0."""
    df = accounts
    for part in (revenue_by_account(subs_fe, unique_keys), support, usage_by_account(fm)):
        part = part.withColumnRenamed("account_id", "_acct")
        df = df.join(part, F.col("account_id") == F.col("_acct"), "left").drop("_acct")
    zero = ("total_mrr", "total_arr", "avg_mrr", "max_mrr", "num_subscriptions_lifetime", "num_active_subscriptions",
            "num_churns", "total_churned_mrr", "total_usage_count", "ticket_count", "avg_satisfaction",
            "avg_priority_score", "tickets_90_days", "avg_monthly_active_features")
    days = dates.days_between(F.col("signup_date"), dates.as_date_lit(as_of))
    df = df.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in zero})
    df = df.withColumn("lifetime_days", F.coalesce(days, F.lit(0)))
    return df.withColumns({
        "daily_usage_rate": F.col("total_usage_count") / F.greatest("lifetime_days", F.lit(1)),
        "escalation_rate": numeric.ratio_or_zero(F.col("escalated_tickets"), F.col("ticket_count")),
        "tickets_per_active_subscription": numeric.ratio_or_zero(
            F.col("ticket_count"), F.col("num_active_subscriptions"))})


def account_features(accounts: DataFrame, subs_fe: DataFrame, support: DataFrame, fm: DataFrame, as_of: date | str,
                     no_ticket_hours: float = 0.0, segment_basis: str = "total_mrr", unique_keys: bool = False,
                     keep: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """One row per account with scores and segment.

    Scores are relative to the 95th percentile of all accounts (0 counts as 1).
    ``no_ticket_hours`` is what an account without tickets is scored with,
    ``segment_basis`` the column the segment is taken from.  ``keep`` may write
    the account rows before the percentiles read them again.
    """
    base = account_base(accounts, subs_fe, support, fm, as_of, unique_keys)
    hours = F.coalesce("avg_resolution_hours", F.lit(float(no_ticket_hours)))
    base = base.withColumn("_hours", hours)
    if keep is not None:
        base = keep(base)
    caps = exact_quantiles(base, {"usage": F.col("daily_usage_rate"), "hours": F.col("_hours"),
                                  "mrr": F.col("total_mrr")}, (0.95,))
    caps = caps.agg(*[F.max(F.when(F.col("name") == n, F.col("q0"))).alias(n) for n in ("usage", "hours", "mrr")])
    cap = caps.select(F.struct("usage", "hours", "mrr")).scalar()
    df = base.withColumn("_cap", cap)

    def share(value: Column, name: str) -> Column:
        limit = F.col("_cap")[name]
        return numeric.cap_one(value / F.when(limit == 0, 1.0).otherwise(limit))

    df = df.withColumns({
        "usage_score": share(F.col("daily_usage_rate"), "usage"),
        "support_score": 1.0 - share(F.col("_hours"), "hours"),
        "revenue_score": share(F.col("total_mrr"), "mrr"),
        "avg_resolution_hours": F.coalesce("avg_resolution_hours", F.lit(0.0)),
        "customer_segment": cases.segment(F.col(segment_basis))})
    df = df.withColumn("health_score", F.col("usage_score") * 0.7 + F.col("support_score") * 0.3)
    df = df.withColumn(REASONS, F.coalesce(REASONS, empty_reasons()))
    return df.select(*ACCOUNT_COLUMNS)
