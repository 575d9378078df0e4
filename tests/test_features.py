from datetime import date

from conftest import by_key
from pyspark.sql import functions as F

from subrev.operators import features, ledger, reports

AS_OF = "2024-06-15"
SUBS = ("subscription_id string, account_id string, start_date date, end_date date, mrr_clean double, arr_clean double, "
        "is_churned boolean, churn_date date, plan_tier string, subscription_status string, subscription_age_days bigint")


def d(text):
    return date.fromisoformat(text) if text else None


def subs_fe(spark, *rows):
    full = [(i, acct, d(s), d(e), float(m), m * 12.0, c is not None, d(c), plan, "churned" if c else "active", 10)
            for i, acct, s, e, m, c, plan in rows]
    return spark.createDataFrame(full, SUBS)


def sample(spark):
    return subs_fe(
        spark, ("S1", "A1", "2024-01-31", "2024-03-01", 100, "2024-03-01", "Pro"), ("S2", "A1", "2024-02-10", None, 50, None, "Basic"),
        ("S3", "A2", "2024-03-05", "2024-03-20", 10, None, "Pro"), ("S4", "A2", "2024-05-01", "2024-03-20", 10, None, None),
        ("S5", "A3", "2024-04-01", "2024-05-01", 0, None, "Trial"), ("S6", "A3", None, None, 5, None, "Pro"),
        ("S7", "A3", "2024-04-01", "2024-05-01", 0.005, None, "Pro"))


def test_ledger_months(spark):
    got = {}
    for r in ledger.ledger(sample(spark), AS_OF).collect():
        got.setdefault(r.subscription_id, []).append((r.month, r.mrr, r.prev_mrr, r.months_since_signup))
    assert sorted(got["S1"]) == [("2024-01", 100.0, 0.0, 0), ("2024-02", 100.0, 100.0, 1), ("2024-03", 100.0, 100.0, 2),
                                 ("2024-04", 0.0, 100.0, 3)]
    assert sorted(got["S2"])[-1] == ("2024-06", 50.0, 50.0, 4)
    assert sorted(got["S3"]) == [("2024-03", 10.0, 0.0, 0), ("2024-04", 0.0, 10.0, 1)]
    assert "S4" not in got and "S6" not in got


def test_ledger_needs_no_exchange(spark):
    for df in (ledger.cohort_rows(ledger.ledger(sample(spark), AS_OF)), ledger.revenue_changes(sample(spark), AS_OF)):
        assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()


def test_changes_follow_from_the_ledger(spark):
    a = ledger.change_rows(ledger.ledger(sample(spark), AS_OF)).collect()
    b = ledger.revenue_changes(sample(spark), AS_OF).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))
    assert {r.change_type for r in b} == {"new", "churn"}


def test_priced_ledger_gives_all_classes(spark):
    prices = spark.createDataFrame([("S2", "2024-03", 80.0), ("S2", "2024-04", 20.0)], "subscription_id string, month string, mrr double")
    rows = ledger.change_rows(ledger.ledger_with_prices(sample(spark), prices, AS_OF)).where("subscription_id = 'S2'")
    assert [(r.month, r.change_type, r.change_amount) for r in rows.orderBy("month").collect()] == [
        ("2024-02", "new", 50.0), ("2024-03", "expansion", 30.0), ("2024-04", "contraction", -60.0), ("2024-05", "expansion", 30.0)]


def test_cohort_reports_from_rows_and_from_subscriptions(spark):
    s = sample(spark)
    rows = ledger.cohort_rows(ledger.ledger(s, AS_OF))
    for one, two in ((reports.cohort_retention(rows), reports.retention_from_subs(s, AS_OF)),
                     (reports.cohort_churn_lifecycle(rows), reports.churn_lifecycle_from_subs(s, AS_OF)),
                     (reports.cohort_nrr_curve(rows), reports.nrr_from_subs(s, AS_OF))):
        assert sorted(map(tuple, one.select(*two.columns).collect())) == sorted(map(tuple, two.collect()))
    assert sum(r.active_subs for r in reports.cohort_retention(rows).collect()) == rows.count()
    active = {(r.cohort_month, r.months_since_signup): r.active_subs
              for r in reports.retention_from_subs(s, AS_OF, active_only=True).collect()}
    assert ("2024-03", 1) not in active and active["2024-03", 0] == 1


def test_quick_ratio_months(spark):
    got = by_key(reports.saas_quick_ratio(ledger.revenue_changes(sample(spark), AS_OF)), "month")
    assert got["2024-01"]["quick_ratio"] == 999.0
    assert got["2024-04"] == {"month": "2024-04", "gains": 0.0, "losses": 110.0, "quick_ratio": 0.0}


def test_segment_curve(spark):
    acc = spark.createDataFrame([("A1", "Enterprise")], "account_id string, customer_segment string")
    got = {(r.customer_segment, r.months_since_signup): r.nrr_pct for r in
           reports.cohort_nrr_by_segment(sample(spark), acc, AS_OF).collect()}
    # newest end is 2024-05-01: S2 runs 4 months, S1 to its churn month; unknown accounts are SMB
    assert got["Enterprise", 0] == 1.0 and abs(got["Enterprise", 3] - 50 / 150) < 1e-12 and ("Enterprise", 4) not in got
    assert ("SMB", 0) in got


def test_top_decile_takes_ties(spark):
    s = subs_fe(spark, *[(f"S{i}", "A", "2024-01-01", None, m, None, "Pro") for i, m in enumerate([1, 1, 1, 1, 1, 1, 1, 1, 9, 9])])
    got = by_key(reports.subs_top_decile_stats(s), "is_top_decile")
    assert got[True]["subscriptions"] == 2 and got[False]["total_mrr"] == 8.0


def test_depth_bins_with_equal_edges(spark):
    acc = spark.createDataFrame([(v, None) for v in (0.0, 0.0, 0.0, 0.0, 5.0, 6.0)], "avg_monthly_active_features double, churn_date date")
    got = by_key(reports.feature_depth_vs_churn(acc), "feature_depth_bin")
    assert {k: v["total_accounts"] for k, v in got.items()} == {"Low": 4, "Med-Low": 0, "Med-High": 0, "High": 2}
    assert got["Med-Low"]["churn_rate"] is None


def test_trial_conversion(spark):
    s = sample(spark).withColumn("subscription_status", F.when(F.col("subscription_id") == "S2", "trial").otherwise("active"))
    acc = spark.createDataFrame([("A1", 10.0), ("A3", 0.0), ("A9", 5.0)], "account_id string, lifetime_gross_mrr double")
    got = {r.metric: r.value for r in reports.trial_conversion(s, acc).collect()}
    assert got == {"total_trial_accounts": 2.0, "converted_to_paid": 1.0, "conversion_rate": 0.5}


USAGE = ("usage_id string, subscription_id string, account_id string, usage_date date, usage_month string, feature_name string, "
         "usage_count bigint, usage_duration_secs bigint, error_count bigint, is_beta_feature boolean")


def usage(spark):
    rows = [("1", "S1", "A1", "2024-01-05", "f", 4, 40, 1, True), ("2", "S1", "A1", "2024-01-06", "g", 4, 10, 0, False),
            ("3", "S2", "A1", "2024-01-07", "f", 9, 9, None, False), ("4", "S2", "A1", "2024-02-07", "f", None, None, None, None),
            ("5", None, None, None, None, 2, 2, 0, True)]
    return spark.createDataFrame([(i, s, a, d(x), x and x[:7], f, c, t, e, b) for i, s, a, x, f, c, t, e, b in rows], USAGE)


def test_usage_tables(spark):
    m = {(r.subscription_id, r.usage_month): r for r in features.usage_monthly(usage(spark)).collect()}
    assert m["S1", "2024-01"].usage_count_month == 8 and m["S1", "2024-01"].unique_features_month == 2
    assert m["S2", "2024-02"].usage_count_month == 0 and m["S2", "2024-02"].duration_per_use is None
    assert m["S2", "2024-02"].days_in_month == 29 and (None, None) in m
    assert {k for k, r in m.items() if r.is_heavy_user_month} == {("S1", "2024-01"), ("S2", "2024-01")}  # median 5
    fm = features.feature_month(usage(spark))
    ranks = {(r.subscription_id, r.feature_name, r.usage_month): r.account_feature_rank for r in fm.collect()}
    assert ranks["S2", "f", "2024-01"] == 1 and ranks["S1", "f", "2024-01"] == ranks["S1", "g", "2024-01"] == 2
    acc = spark.createDataFrame([("A1", d("2024-01-06"))], "account_id string, signup_date date")
    fu = {(r.account_id, r.feature_name): r for r in features.first_use(fm, acc).collect()}
    early = fu["A1", "f"]
    assert early.days_to_adopt == 0 and early.dirty_row_reason == ["negative_days_to_adopt_adjusted"] and early.beta_adopter
    assert fu["A1", "g"].days_to_adopt == 0 and not fu["A1", "g"].dirty_row_flag
    assert fu[None, None].days_to_adopt is None and not fu[None, None].is_beta_feature
    per = features.usage_by_account(fm).first()
    assert per.total_usage_count == 17 and per.avg_monthly_active_features == 1.5


TICKETS = ("ticket_id string, account_id string, submitted_at timestamp, closed_at timestamp, resolution_time_hours double, "
           "priority string, escalation_flag boolean, satisfaction_score double")


def test_support(spark):
    t0, t1 = "2024-01-01 00:00:00", "2024-06-01 12:00:00"
    rows = spark.createDataFrame([("T1", "A1", t0, None, 30.0, "high", True, 4.0), ("T2", "A1", t1, None, -2.0, "urgent", False, None),
                                  ("T3", None, None, None, None, None, None, None)],
                                 TICKETS.replace("timestamp", "string")).withColumns(
        {c: F.col(c).cast("timestamp") for c in ("submitted_at", "closed_at")})
    got = by_key(features.support_events(rows), "ticket_id")
    assert got["T2"]["resolution_time_hours"] == 2.0 and got["T2"]["resolution_bucket"] == "<24h" and got["T2"]["priority_score"] is None
    assert got["T2"]["dirty_row_reason"] == ["missing_satisfaction_score", "resolution_time_negative_corrected"]
    assert got["T3"]["resolution_bucket"] == "unknown" and len(got["T3"]["dirty_row_reason"]) == 3
    agg = features.support_by_account(features.support_events(rows)).collect()
    assert len(agg) == 1 and (agg[0].ticket_count, agg[0].tickets_90_days, agg[0].escalated_tickets) == (2, 1, 1)
    none = rows.withColumn("resolution_time_hours", F.lit(None).cast("double")).withColumn("closed_at", F.timestamp_add(
        "HOUR", F.lit(5), F.col("submitted_at")))
    assert by_key(features.support_events(none), "ticket_id")["T1"]["resolution_time_hours"] == 5.0


def test_account_scores(spark):
    acc = spark.createDataFrame([(f"A{i}", "n", "i", "c", d("2024-01-01"), None, False, None) for i in (1, 2, 3, 9)],
                                "account_id string, account_name string, industry_clean string, country_clean string, signup_date date, "
                                "churn_date date, dirty_row_flag boolean, dirty_row_reason array<string>")
    s = sample(spark).withColumn("churned_mrr", F.when(F.col("is_churned"), F.col("mrr_clean")).otherwise(0.0))
    sup = spark.createDataFrame([("A1", 4, 1, 10.0, 3.0, 2.0, 1)], "account_id string, ticket_count bigint, escalated_tickets bigint, "
                                "avg_resolution_hours double, avg_satisfaction double, avg_priority_score double, tickets_90_days bigint")
    out = features.account_features(acc, s, sup, features.feature_month(usage(spark)), AS_OF)
    got = by_key(out, "account_id")
    a1, a9 = got["A1"], got["A9"]
    assert len(out.columns) == 34 and set(got) == {"A1", "A2", "A3", "A9"}
    assert (a1["lifetime_gross_mrr"], a1["total_mrr"], a1["num_churns"], a1["num_active_subscriptions"]) == (150.0, 50.0, 1, 1)
    assert a1["escalation_rate"] == 0.25 and a1["tickets_per_active_subscription"] == 4.0
    assert a9["total_mrr"] == 0 and a9["lifetime_gross_mrr"] is None and a9["support_score"] == 1.0 and a9["customer_segment"] == "SMB"
    assert a1["usage_score"] == 1.0 and a1["support_score"] == 0.0 and abs(a1["health_score"] - 0.7) < 1e-12
    strict = by_key(features.account_features(acc, s, sup, features.feature_month(usage(spark)), AS_OF, no_ticket_hours=100.0,
                                              segment_basis="lifetime_gross_mrr"), "account_id")
    assert strict["A9"]["support_score"] == 0.0


def test_dense_rank_in_two_levels(spark):
    """One account-month holds half of all levels; small spans make many buckets of it."""
    rows = [("a", "m", v) for v in (*range(0, 600, 3), 5, 5, None)] + [("b", "m", v) for v in (7, 7, 1)] + [(None, None, 3), (None, None, 9)]
    df = spark.createDataFrame(rows, "g string, h string, v bigint").repartition(5)
    levels = {}
    for g, h, v in rows:
        levels.setdefault((g, h), set()).add(v)
    rank = {k: {v: i + 1 for i, v in enumerate(sorted(vs, key=lambda x: (x is None, -(x or 0))))} for k, vs in levels.items()}
    for span in (4, 1 << 16):
        got = features.dense_rank_by_group(df, ("g", "h"), "v", "r", span).where("v is not null").collect()
        assert len(got) == len(rows) - 1 and all(r.r == rank[r.g, r.h][r.v] for r in got)


def test_ids_are_text_after_the_load(spark):
    df = spark.createDataFrame([(7, "None", 1.5), (8, "A-1", None)], "ticket_id bigint, account_id string, x double")
    assert [tuple(r) for r in features.text_ids(df).collect()] == [("7", None, 1.5), ("8", "A-1", None)]


def test_ticket_account_through_its_subscription(spark):
    tickets = spark.createDataFrame(
        [("T1", None, None, None, 1.0, None, False, None, "S1"), ("T2", None, None, None, None, None, False, None, "S9")],
        "ticket_id string, account_id string, submitted_at timestamp, closed_at timestamp, resolution_time_hours double, priority string, "
        "escalation_flag boolean, satisfaction_score double, subscription_id string")
    got = {r.ticket_id: r.account_id for r in features.support_events(tickets, sample(spark)).collect()}
    assert got == {"T1": "A1", "T2": None}


def test_hours_from_timestamps_per_row(spark):
    from datetime import datetime

    rows = [("T1", "A", datetime(2024, 1, 1), datetime(2024, 1, 2), None), ("T2", "A", datetime(2024, 1, 1), datetime(2024, 1, 2), 3.0)]
    tickets = spark.createDataFrame(rows, "ticket_id string, account_id string, submitted_at timestamp, closed_at timestamp, resolution_time_hours double") \
        .withColumns({"priority": F.lit("high"), "escalation_flag": F.lit(False), "satisfaction_score": F.lit(1.0)})
    for per_row, want in ((False, {"T1": None, "T2": 3.0}), (True, {"T1": 24.0, "T2": 3.0})):
        got = {r.ticket_id: r.resolution_time_hours for r in features.support_events(tickets, hours_per_row=per_row).collect()}
        assert got == want
