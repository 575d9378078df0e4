"""Monthly revenue ledger, cohort rows and revenue changes.

A subscription has one price, so its ledger follows from the row itself: the
months from start to end (or ``as_of``), one more month with revenue 0 when it
ended, and the previous month's revenue is known without looking at another
row.  No operator here shuffles unless a price table is given.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subrev.functions import cases, dates, numeric


def _span(as_of: date | str) -> tuple[Column, Column, Column]:
    """Start month, number of paid months (0 or less: end before start), ended."""
    start = F.trunc("start_date", "MM")
    last = F.coalesce(F.col("end_date"), dates.as_date_lit(as_of))
    paid = dates.months_between(F.col("start_date"), last) + 1
    return start, paid, F.col("end_date").isNotNull()


def ledger(subs_fe: DataFrame, as_of: date | str, *carried: str) -> DataFrame:
    """Subscription x month with ``mrr`` and ``prev_mrr``, and the ``carried`` columns. An end before the start gives no row."""
    start, paid, ended = _span(as_of)
    df = subs_fe.select("subscription_id", "account_id", "mrr_clean", start.alias("_start"), paid.alias("_paid"),
                        ended.alias("_ended"), *carried).where(F.col("_start").isNotNull() & (F.col("_paid") > 0))
    last = F.col("_paid") - 1 + F.col("_ended").cast("bigint")
    df = df.withColumn("_i", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
    i = F.col("_i")
    month = F.add_months("_start", i.cast("int"))
    return df.select(
        "subscription_id", "account_id", month.alias("month_start"), dates.month_key(month).alias("month"),
        F.when(i < F.col("_paid"), F.col("mrr_clean")).otherwise(0.0).alias("mrr"),
        F.when(i > 0, F.col("mrr_clean")).otherwise(0.0).alias("prev_mrr"),
        dates.month_key(F.col("_start")).alias("cohort_month"), i.alias("months_since_signup"), *carried)


def ledger_with_prices(subs_fe: DataFrame, prices: DataFrame, as_of: date | str) -> DataFrame:
    """Ledger in which ``prices(subscription_id, month, mrr)``, one row per subscription and month, replaces the price of single months.

    The prices of a subscription, at most one per month, are folded to a map that its row meets before its months
    are expanded; so a month and the month before it follow from one row, and ledger rows are not moved.
    """
    one = F.struct("month", F.col("mrr").cast("double").alias("mrr"))
    p = (prices.where(F.col("subscription_id").isNotNull() & F.col("month").isNotNull())
         .groupBy(F.col("subscription_id").alias("_sub")).agg(F.map_from_entries(F.collect_list(one)).alias("_prices")))
    base = ledger(subs_fe.join(p, F.col("subscription_id") == F.col("_sub"), "left"), as_of, "_prices")

    def priced(usual: Column, month: Column) -> Column:
        return F.when(usual != 0, F.coalesce(F.col("_prices")[month], usual)).otherwise(0.0)

    before = dates.month_key(F.add_months("month_start", -1))
    return base.withColumns({"mrr": priced(F.col("mrr"), F.col("month")),
                             "prev_mrr": priced(F.col("prev_mrr"), before)}).drop("_prices")


def with_changes(rows: DataFrame) -> DataFrame:
    return rows.withColumns({"change_amount": F.col("mrr") - F.col("prev_mrr"),
                             "change_type": cases.change_type(F.col("mrr"), F.col("prev_mrr"))})


COHORT_COLUMNS = ("subscription_id", "account_id", "month", "mrr", "is_churned_month", "cohort_month",
                  "months_since_signup")
CHANGE_COLUMNS = ("subscription_id", "account_id", "month", "change_type", "change_amount", "mrr", "prev_mrr")


def cohort_rows(rows: DataFrame) -> DataFrame:
    """Ledger rows with revenue in this or the previous month."""
    kept = rows.where(~((F.col("mrr") == 0) & (F.col("prev_mrr") == 0)))
    churned = cases.change_type(F.col("mrr"), F.col("prev_mrr")) == "churn"
    return kept.withColumn("is_churned_month", churned).select(*COHORT_COLUMNS)


def change_rows(rows: DataFrame) -> DataFrame:
    """Ledger rows whose revenue changed: new, expansion, contraction, churn."""
    changed = with_changes(rows).where(F.col("change_type").isin("new", "expansion", "contraction", "churn"))
    return changed.select(*CHANGE_COLUMNS)


def revenue_changes(subs_fe: DataFrame, as_of: date | str) -> DataFrame:
    """Same rows as ``change_rows(ledger(...))``, from the only two months in which one price can change."""
    start, paid, ended = _span(as_of)
    mrr = F.col("mrr_clean")
    zero = F.lit(0.0)

    def event(month: Column, now: Column, before: Column) -> Column:
        return F.struct(dates.month_key(month).alias("month"), now.alias("mrr"), before.alias("prev_mrr"))

    first = event(F.col("_start"), mrr, zero)
    final = event(F.add_months("_start", F.col("_paid").cast("int")), zero, mrr)
    rows = (subs_fe.select("subscription_id", "account_id", "mrr_clean", start.alias("_start"), paid.alias("_paid"),
                           ended.alias("_ended"))
            .where(F.col("_start").isNotNull() & (F.col("_paid") > 0) & ~numeric.same_amount(mrr))
            .select("subscription_id", "account_id",
                    F.inline(F.when(F.col("_ended"), F.array(first, final)).otherwise(F.array(first)))))
    return change_rows(rows)


def cohort_spans(subs_fe: DataFrame, as_of: date | str) -> DataFrame:
    """Subscriptions folded to (cohort month, paid months, ended): number and revenue of each.

    The cohort reports expand this frame, which has at most months x months x 2
    rows, in place of one row per subscription and month.  ``churns`` counts the
    ones whose drop to 0 is a churn (at least one cent).
    """
    start, paid, ended = _span(as_of)
    mrr = F.col("mrr_clean")
    return (subs_fe.select("subscription_id", mrr, dates.month_key(start).alias("cohort_month"), paid.alias("paid"),
                           ended.alias("ended"))
            .where(F.col("cohort_month").isNotNull() & (F.col("paid") > 0) & (mrr != 0))
            .groupBy("cohort_month", "paid", "ended")
            .agg(F.count("subscription_id").alias("subs"), F.sum(mrr).alias("mrr"),
                 F.count(F.when((mrr > 0) & ~numeric.same_amount(mrr), F.col("subscription_id"))).alias("churns")))


def expand_spans(spans: DataFrame) -> DataFrame:
    """Spans to (cohort month, months since signup): subs, mrr, churned subs."""
    last = F.col("paid") - 1 + F.col("ended").cast("bigint")
    rows = spans.withColumn("months_since_signup", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
    paying = F.col("months_since_signup") < F.col("paid")
    return rows.select("cohort_month", "months_since_signup", "subs",
                       F.when(paying, F.col("mrr")).otherwise(0.0).alias("mrr"),
                       F.when(paying, 0).otherwise(F.col("churns")).alias("churned"),
                       F.when(paying, F.col("subs")).otherwise(0).alias("paying_subs"))
