"""The five cleaners.

Each takes a raw table (all text) and returns the annotated clean table: native
columns untouched, ``*_clean`` / ``*_imputed`` siblings, ``*_norm`` helper keys,
``dirty_row_flag``, ``dirty_row_reason`` and ``corrections``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subrev import specs
from subrev.functions import dates, lookup, text
from subrev.functions.reasons import RuleLog
from subrev.operators import dedupe, impute


def _distinct_keys(df: DataFrame, key: str, *carried: str) -> DataFrame:
    """One row per non-null key; a key can repeat only when two raw keys differ in spaces."""
    rows = df.where(F.col(key).isNotNull())
    if not carried:
        return rows.select(key).distinct()
    return rows.groupBy(key).agg(*[F.max(c).alias(c) for c in carried])


def _prepare(raw: DataFrame, spec: specs.TableSpec, tiebreak: Sequence[str] | None) -> DataFrame:
    return dedupe.validate_key(dedupe.keep_most_complete(raw, spec.pk, tiebreak), spec.pk)


# ---------------------------------------------------------------- churn events
def clean_churn_events(raw: DataFrame, tiebreak: Sequence[str] | None = None) -> DataFrame:
    df = _prepare(raw, specs.CHURN_EVENTS, tiebreak)
    refund = F.col("refund_amount_usd")
    signed = text.signed_number(refund)
    df = df.withColumns({"account_id_norm": text.normalize_id(F.col("account_id")),
                         "refund_amount_clean": F.abs(signed)})
    log = RuleLog()
    log.correct(F.coalesce(signed < 0, F.lit(False)), "negative_refund_amount_usd", "refund_amount_usd", refund,
                F.col("refund_amount_clean"))
    log.correct(signed.isNull() & ~text.is_blank(refund), "invalid_numeric_parsed", "refund_amount_usd", refund)
    log.correct(text.is_blank(F.col("reason_code")), "blank_reason_code", "reason_code", F.col("reason_code"))
    log.correct(text.is_blank(F.col("feedback_text")), "blank_feedback_text", "feedback_text", F.col("feedback_text"))
    return log.apply(df)


def account_churn(churn: DataFrame, tiebreak: Sequence[str] = ("churn_event_id",)) -> DataFrame:
    """Account to churn date: the latest readable date, else the first unreadable text."""
    parsed = dates.parse_date(F.col("churn_date"))
    first_text = F.min_by("churn_date", F.struct(*tiebreak))
    return (churn.where(F.col("account_id_norm").isNotNull() & ~text.is_blank(F.col("churn_date")))
            .groupBy("account_id_norm").agg(F.max(parsed).alias("churn_day"), first_text.alias("_raw"))
            .select("account_id_norm", "churn_day",
                    F.coalesce(dates.format_date(F.col("churn_day")), F.col("_raw")).alias("churn_text")))


# -------------------------------------------------------------------- accounts
def clean_accounts(raw: DataFrame, churned: DataFrame, tiebreak: Sequence[str] | None = None,
                   strategy: str = "cascade", truthy_text: bool = False) -> DataFrame:
    """``truthy_text=True`` reads any native churn flag text, "False" included, as true
    (what a reader that never parses the text does); by default the text is parsed."""
    df = _prepare(raw, specs.ACCOUNTS, tiebreak)
    df = impute.impute_accounts(df, raw, ("country", "industry"), strategy, tiebreak)
    df = df.withColumns({"account_id_norm": text.normalize_id(F.col("account_id")),
                         "account_name_norm": F.lower("account_name")})
    known = churned.select(F.col("account_id_norm").alias("_acct"), F.col("churn_text").alias("account_churn_date_clean"))
    df = df.join(known, F.col("account_id_norm") == F.col("_acct"), "left")
    has_event = F.col("_acct").isNotNull()
    df = df.withColumn("churn_flag_clean", has_event)
    native = (F.coalesce(F.col("churn_flag") != "", F.lit(True)) if truthy_text
              else text.is_true(F.col("churn_flag")))
    log = RuleLog()
    for column in ("country", "industry"):
        log.correct(text.is_blank(F.col(column)), f"{column}_imputed", column, None, F.col(f"{column}_clean"))
    log.flag(has_event & ~native, "native_churn_flag_false_but_event_exists")
    log.flag(~has_event & native, "native_churn_flag_true_but_no_event")
    return log.apply(df).drop("_acct")


# --------------------------------------------------------------- subscriptions
def repair_start_end(df: DataFrame, start: str = "start_date", end: str = "end_date_clean") -> DataFrame:
    """Start after end by less than 30 days: swap the texts; by more: flag only."""
    s, e = dates.parse_date(F.col(start)), dates.parse_date(F.col(end))
    gap = dates.days_between(e, s)
    swap = F.coalesce((gap > 0) & (gap < specs.SWAP_GAP_DAYS), F.lit(False))
    log = RuleLog()
    log.flag(swap, "start_end_swapped_due_to_small_gap")
    log.flag(F.coalesce(gap >= specs.SWAP_GAP_DAYS, F.lit(False)), "start_after_end_flagged")
    swapped = {start: F.when(swap, F.col(end)).otherwise(F.col(start)),
               end: F.when(swap, F.col(start)).otherwise(F.col(end))}
    return log.apply(df).withColumns(swapped)


def _impute_plan(subs: DataFrame, prices: DataFrame, price_order: Sequence[str]) -> DataFrame:
    """``plan_tier_imputed``: native, else by price, else by seats when only one plan is sold with them.

    Rows with a plan, and trials, pass by the lookups: only those that ask are joined, and
    only the prices they ask for are aggregated.
    """
    no_plan, trial = text.is_blank(F.col("plan_tier")), text.is_true(F.col("is_trial"))
    ask = no_plan & ~trial
    mrr, arr = F.abs(text.signed_number(F.col("mrr_amount"))), F.abs(text.signed_number(F.col("arr_amount")))
    price = F.when((mrr > 0) & (arr > 0), lookup.text_key(mrr, arr))
    by_price = impute.plan_by_price(subs, price_order, impute.asked(subs, price, ask))
    pk = F.coalesce(F.col("subscription_id"), F.lit(""))
    seats = F.when(~text.is_blank(F.col("seats")), F.trim("seats"))
    asking = subs.where(ask).withColumn("_price_key", lookup.spread_key(F.lit(True), price, pk))
    asking = asking.join(by_price, F.col("_price_key") == F.col("price_key"), "left")
    asking = asking.withColumn("_seat_key", lookup.spread_key(F.col("price_plan").isNull(), seats, pk))
    asking = asking.join(impute.plan_by_seats(prices), F.col("_seat_key") == F.col("seat_key"), "left")
    found = asking.select(*subs.columns, F.coalesce("price_plan", "seat_plan", F.lit("Unknown")).alias("plan_tier_imputed"))
    rest = subs.where(~ask).select("*", F.when(~no_plan, F.col("plan_tier")).otherwise("Trial").alias("plan_tier_imputed"))
    return rest.unionByName(found)


def clean_subscriptions(raw: DataFrame, accounts: DataFrame, as_of: date | str,
                        tiebreak: Sequence[str] | None = None,
                        price_order: Sequence[str] = ("subscription_id",),
                        only_when_missing: bool = False, keep: Callable[[str, DataFrame], DataFrame] | None = None) -> DataFrame:
    """``keep`` may write the deduplicated rows and the price lists, which are used several times.  ``price_order`` decides which of several prices of the same (seats, plan) wins (the last).
    ``only_when_missing`` keeps a native price and uses the lookup for missing ones only."""
    keep = keep or (lambda _, table: table)
    df = keep("subscriptions_unique", _prepare(raw, specs.SUBSCRIPTIONS, tiebreak))
    churn_days = _distinct_keys(accounts.withColumn("_churn_day", dates.parse_date(F.col("account_churn_date_clean"))),
                                "account_id_norm", "_churn_day").withColumnRenamed("account_id_norm", "_acct")
    prices = keep("prices", impute.price_by_seats_plan(df, price_order))
    df = _impute_plan(df, prices, price_order)

    # End date: from the account's churn date, then the 30-day rule of free trials.
    df = df.withColumns({"subscription_id_norm": text.normalize_id(F.col("subscription_id")),
                         "account_id_norm": text.normalize_id(F.col("account_id"))})
    df = df.join(churn_days, F.col("account_id_norm") == F.col("_acct"), "left")
    mrr = F.abs(text.signed_number(F.col("mrr_amount")))
    arr = F.abs(text.signed_number(F.col("arr_amount")))
    df = df.withColumns({"_start": dates.parse_date(F.col("start_date")), "_trial": text.is_true(F.col("is_trial")),
                         "_mrr": mrr, "_arr": arr})
    no_end = text.is_blank(F.col("end_date"))
    derived = F.coalesce(no_end & (F.col("_churn_day") >= F.col("_start")), F.lit(False))
    cutoff = F.date_add(F.col("_start"), specs.TRIAL_DAYS)
    capped = F.coalesce(no_end & ~derived & F.col("_trial") & (F.coalesce(F.col("_mrr"), F.lit(0.0)) == 0)
                        & (cutoff < dates.as_date_lit(as_of)), F.lit(False))
    df = df.withColumns({"_derived": derived, "_capped": capped})
    df = df.withColumn("end_date_clean",
                       F.when(F.col("_derived"), dates.format_date(F.col("_churn_day")))
                       .when(F.col("_capped"), dates.format_date(cutoff)).otherwise(F.col("end_date")))

    no_plan = text.is_blank(F.col("plan_tier"))
    ask = no_plan & ~F.col("_trial")
    pk = F.coalesce(F.col("subscription_id"), F.lit(""))
    seats = F.when(~text.is_blank(F.col("seats")), F.trim("seats"))

    # Prices: trials are free; (seats, plan) lookup; else the other price times or over 12.
    df = df.withColumn("_plan_key", lookup.spread_key(
        ~F.col("_trial"), lookup.text_key(seats, F.trim("plan_tier_imputed")), pk))
    found = prices.select(lookup.text_key(F.col("seats"), F.col("plan_tier")).alias("_sold_key"),
                          F.col("mrr").alias("_sold_mrr"), F.col("arr").alias("_sold_arr"))
    df = df.join(found, F.col("_plan_key") == F.col("_sold_key"), "left")
    has_mrr, has_arr = F.coalesce(F.col("_mrr") != 0, F.lit(False)), F.coalesce(F.col("_arr") != 0, F.lit(False))
    sold = F.col("_sold_key").isNotNull()
    if only_when_missing:
        sold = sold & ~(has_mrr & has_arr)
    zero = (~has_mrr & ~has_arr) & (F.col("_mrr").isNotNull() | F.col("_arr").isNotNull())
    df = df.withColumn("_sold", sold & ~F.col("_trial"))
    df = df.withColumns({
        "mrr_amount_clean": F.when(F.col("_trial"), 0.0).when(F.col("_sold"), F.col("_sold_mrr"))
        .when(has_arr & ~has_mrr, F.col("_arr") / 12).when(zero, 0.0).otherwise(F.col("_mrr")),
        "arr_amount_clean": F.when(F.col("_trial"), 0.0).when(F.col("_sold"), F.col("_sold_arr"))
        .when(has_mrr & ~has_arr, F.col("_mrr") * 12).when(zero, 0.0).otherwise(F.col("_arr")),
    })

    log = RuleLog()
    end = F.col("end_date_clean")
    log.correct(F.col("_derived"), "end_date_derived", "end_date", None, end)
    log.correct(F.col("_capped"), "trial_capped_at_30_days", "end_date", None, end)
    log.flag(F.col("_trial") & no_plan, "trial_tier_set_to_trial")
    log.correct(ask, "plan_tier_imputed_from_lookup", "plan_tier", F.col("plan_tier"), F.col("plan_tier_imputed"))
    log.flag(F.col("_sold"), "mrr_arr_imputed_from_lookup")
    df = log.apply(df).drop(
        "_acct", "_churn_day", "_start", "_trial", "_mrr", "_arr", "_derived", "_capped", "_plan_key", "_sold_key", "_sold_mrr", "_sold_arr", "_sold")
    return repair_start_end(df)


# --------------------------------------------------------------- feature usage
def clean_feature_usage(raw: DataFrame, subscriptions: DataFrame, tiebreak: Sequence[str] | None = None) -> DataFrame:
    """Rows of an unknown subscription are flagged as orphans and get no other rule."""
    df = _prepare(raw, specs.FEATURE_USAGE, tiebreak)
    df = df.withColumn("subscription_id_norm", text.normalize_id(F.col("subscription_id")))
    known = _distinct_keys(subscriptions, "subscription_id_norm").withColumnRenamed("subscription_id_norm", "_sub")
    df = df.join(known, F.col("subscription_id_norm") == F.col("_sub"), "left")
    orphan = F.col("_sub").isNull()
    known_row = ~orphan
    count, secs = text.signed_number(F.col("usage_count")), text.signed_number(F.col("usage_duration_secs"))
    name, day = F.col("feature_name"), F.col("usage_date")
    df = df.withColumns({
        "usage_count_clean": F.when(known_row, F.abs(count)),
        "usage_duration_secs_clean": F.when(known_row, F.abs(secs)),
        "feature_name_imputed": F.when(known_row & text.is_blank(name), "Unknown").otherwise(name)})
    log = RuleLog()
    log.correct(orphan, "orphan_usage", "subscription_id", F.col("subscription_id"))
    log.correct(known_row & text.is_blank(name), "feature_name_imputed", "feature_name", None, F.lit("Unknown"))
    log.flag(known_row & (count < 0), "negative_usage_count")
    log.flag(known_row & (secs < 0), "negative_usage_duration")
    log.correct(known_row & ~text.is_blank(day) & ~dates.has_date_format(day), "invalid_date_format", "usage_date",
                day, day)
    return log.apply(df).drop("_sub")


def orphan_usage(usage: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """Usage rows whose subscription does not exist."""
    keys = subscriptions.select(text.normalize_id(F.col("subscription_id")).alias("_sub"))
    return usage.join(keys, text.normalize_id(F.col("subscription_id")) == F.col("_sub"), "left_anti")


# ------------------------------------------------------------- support tickets
def clean_support_tickets(raw: DataFrame, tiebreak: Sequence[str] | None = None) -> DataFrame:
    df = _prepare(raw, specs.SUPPORT_TICKETS, tiebreak)
    hours = text.signed_number(F.col("resolution_time_hours"))
    rating, priority = F.col("satisfaction_score"), F.col("priority")
    df = df.withColumns({
        "resolution_hours_clean": F.abs(hours),
        "satisfaction_imputed": F.when(text.is_blank(rating), "Unknown").otherwise(rating)})
    log = RuleLog()
    log.flag(hours < 0, "negative_resolution_time")
    log.correct(text.is_blank(priority), "priority_missing_flagged", "priority", priority)
    log.correct(text.is_blank(rating), "satisfaction_imputed", "satisfaction_score", None, F.lit("Unknown"))
    return log.apply(df)
