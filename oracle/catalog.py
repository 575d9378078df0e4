"""Check SQL of every registered query."""

from __future__ import annotations

from oracle.ctes import (AS_OF, CTES, blank, day, dmy, iso, looks, loose_day, months, norm, num, rnd, stamp, strict, tf,
                         using, words, ym, yes)
from oracle.stages import stage_sql
from subrev.operators.faults import FAULTS, SIDES
from subrev.plans.catalog import DIE_FACTORS
from subrev.specs import FILE_NULL_WORDS, TABLES, classify_name

SQL: dict[str, str] = {}
FLAG = "reasons <> '' AS dirty_row_flag, reasons AS dirty_row_reason"


def r(*columns: str) -> str:
    """Columns on the four-decimal grid, under their own names."""
    return ", ".join(f"{rnd(c)} AS {c}" for c in columns)


def d(*columns: str) -> str:
    return ", ".join(f"{iso(c)} AS {c}" for c in columns)


def union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


# ------------------------------------------------------------------ expressions
SQL["parse_numeric"] = f"""SELECT churn_event_id, refund_amount_usd, {rnd(num('refund_amount_usd'))} AS signed,
  {rnd('abs(' + num('refund_amount_usd') + ')')} AS absolute FROM raw_churn_events"""
SQL["parse_dates"] = f"""SELECT usage_id, usage_date, {looks('usage_date')} AS has_format, {iso(day('usage_date'))} AS strict,
  {iso(loose_day('usage_date'))} AS lenient, {dmy(loose_day('usage_date'))} AS written FROM raw_feature_usage"""
SQL["ticket_times"] = f"""SELECT ticket_id, strftime(a, '%Y-%m-%d %H:%M:%S') AS submitted, strftime(b, '%Y-%m-%d %H:%M:%S') AS closed,
  strftime(b, '%Y-%m-%d') AS closed_day, {rnd("date_diff('second', a, b) / 3600.0")} AS hours
FROM (SELECT ticket_id, {stamp('submitted_at')} AS a, {stamp('closed_at')} AS b FROM raw_support_tickets)"""
SQL["month_arithmetic"] = f"""SELECT subscription_id, {d('a', 'b')}, b - a AS days, {months('a', 'b')} AS months, {ym('a')} AS month,
  CAST(day(last_day(a)) AS BIGINT) AS days_in_month, {iso("date_trunc('month', a)")} AS month_start, {iso('a + 30')} AS plus_30
FROM (SELECT subscription_id, {day('start_date')} AS a, {day('end_date')} AS b FROM raw_subscriptions)"""
SQL["seat_buckets"] = """SELECT CASE WHEN n IS NULL THEN 'unknown' WHEN n <= 10 THEN '01_to_10' WHEN n <= 25 THEN '11_to_25'
  WHEN n <= 50 THEN '26_to_50' ELSE '50+' END AS seat_bucket, count(*) AS accounts
FROM (SELECT TRY_CAST(seats AS DOUBLE) AS n FROM raw_accounts) GROUP BY 1"""
SQL["resolution_buckets"] = f"""SELECT CASE WHEN h IS NULL THEN 'unknown' WHEN h < 24 THEN '<24h' WHEN h < 72 THEN '24-72h' ELSE '>72h' END
  AS resolution_bucket, count(*) AS tickets FROM (SELECT abs({num('resolution_time_hours')}) AS h FROM raw_support_tickets) GROUP BY 1"""
SQL["priority_scores"] = """SELECT priority, CASE priority WHEN 'high' THEN 3.0 WHEN 'medium' THEN 2.0 WHEN 'low' THEN 1.0 END::DOUBLE
  AS priority_score, count(*) AS tickets FROM raw_support_tickets GROUP BY 1"""
SQL["plan_tier_coalesce"] = f"""SELECT CASE WHEN NOT {blank('plan_tier_imputed')} THEN plan_tier_imputed
  WHEN NOT {blank('plan_tier')} THEN plan_tier END AS tier, count(*) AS subscriptions FROM c_subscriptions GROUP BY 1"""
SQL["subscription_status"] = f"""SELECT subscription_status, rev_change_flag, is_churned, count(*) AS subscriptions,
  {rnd('sum(churned_mrr)')} AS churned_mrr FROM subs_fe GROUP BY 1, 2, 3"""
SQL["segment_case"] = f"""SELECT account, {r('spend')}, CASE WHEN spend < 2000 THEN 'SMB' WHEN spend < 10000 THEN 'Mid-Market'
  ELSE 'Enterprise' END AS segment FROM (SELECT o_custkey AS account, sum(floor(o_totalprice) / 1000) AS spend FROM orders GROUP BY 1)"""
SQL["guarded_arithmetic"] = f"""SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey,
  {iso('l_shipdate')} AS l_shipdate, {rnd('greatest(l_discount - l_tax, 0)')} AS clamped,
  {rnd('l_extendedprice / nullif(l_discount, 0)')} AS guarded, {rnd('coalesce(l_extendedprice / nullif(l_tax, 0), 0)')} AS filled,
  {rnd('least(l_quantity / 25, 1)')} AS capped, abs(l_discount - l_tax) < 0.01 AS same FROM lineitem"""
SQL["reason_lists"] = """SELECT ticket_id, CASE WHEN reasons = '' THEN '[]' ELSE '["' || replace(reasons, '|', '","') || '"]' END AS json,
  reasons, CASE WHEN reasons = '' THEN 0 ELSE len(string_split(reasons, '|')) END AS reason_count FROM c_support_tickets"""

# ---------------------------------------------------------------- audit, dedupe
SQL["dedupe_keep_most_complete"] = f"SELECT {', '.join(TABLES['feature_usage'].columns)} FROM one_feature_usage"
SQL["dedupe_counts"] = union([f"""SELECT '{n}' AS table_name, count(*) AS rows_in, (SELECT count(*) FROM one_{n}) AS rows_after_raw_dedupe,
  count(*) - (SELECT count(*) FROM one_{n}) AS duplicates_raw_removed FROM raw_{n}""" for n in TABLES])
SQL["pk_validation"] = union([f"""SELECT '{n}' AS table_name, count(*) AS rows, count(*) FILTER ({norm(s.pk)} IS NULL) AS pk_null_count
FROM raw_{n}""" for n, s in TABLES.items()])
SQL["dirty_reasons"] = union([f"""SELECT '{n}' AS table_name, reason, count(*) AS rows
FROM (SELECT unnest(string_split(reasons, '|')) AS reason FROM c_{n} WHERE reasons <> '') GROUP BY 2""" for n in TABLES])


def _cells(table: str, column: str, original: str, corrected: str, code: str, cond: str) -> str:
    pk = TABLES[table].pk
    return (f"""SELECT '{table}' AS table_name, '{{"{pk}":"' || {pk} || '"}}' AS primary_key, '{column}' AS column_name,
  {original} AS original_value, {corrected} AS corrected_value, '{code}' AS reason_code, 1::BIGINT AS rows FROM c_{table} WHERE {cond}""")


def _has(code: str) -> str:
    return f"list_contains(string_split(reasons, '|'), '{code}')"


_N = "NULL::VARCHAR"
_CELL_RULES = [
    ("churn_events", "refund_amount_usd", "refund_amount_usd", "CAST(refund_amount_clean AS VARCHAR)", "negative_refund_amount_usd"),
    ("churn_events", "refund_amount_usd", "refund_amount_usd", _N, "invalid_numeric_parsed"),
    ("churn_events", "reason_code", "reason_code", _N, "blank_reason_code"),
    ("churn_events", "feedback_text", "feedback_text", _N, "blank_feedback_text"),
    ("accounts", "country", _N, "country_clean", "country_imputed"),
    ("accounts", "industry", _N, "industry_clean", "industry_imputed"),
    ("subscriptions", "end_date", _N, "end_filled", "end_date_derived"),
    ("subscriptions", "end_date", _N, "end_filled", "trial_capped_at_30_days"),
    ("subscriptions", "plan_tier", "plan_tier", "plan_tier_imputed", "plan_tier_imputed_from_lookup"),
    ("feature_usage", "subscription_id", "subscription_id", _N, "orphan_usage"),
    ("feature_usage", "feature_name", _N, "'Unknown'", "feature_name_imputed"),
    ("feature_usage", "usage_date", "usage_date", "usage_date", "invalid_date_format"),
    ("support_tickets", "priority", "priority", _N, "priority_missing_flagged"),
    ("support_tickets", "satisfaction_score", _N, "'Unknown'", "satisfaction_imputed"),
]
CTES["corrections_t"] = union([
    f"""SELECT '{n}' AS table_name, '{{"{s.pk}":"' || {s.pk} || '"}}' AS primary_key, {_N} AS column_name, {_N} AS original_value,
  {_N} AS corrected_value, 'duplicate_raw_keep_max_completeness' AS reason_code, count(*) - 1 AS rows FROM raw_{n}
GROUP BY {s.pk} HAVING count(*) > 1""" for n, s in TABLES.items()]
    + [_cells(t, c, o, new, code, _has(code)) for t, c, o, new, code in _CELL_RULES])
SQL["corrections_log"] = "SELECT * FROM corrections_t"
SQL["validation_log"] = union([f"""SELECT '{n}' AS table_name, metric, value FROM (SELECT unnest([
  {{'metric': 'rows_in', 'value': (SELECT count(*) FROM raw_{n})}}, {{'metric': 'rows_initial', 'value': (SELECT count(*) FROM raw_{n})}},
  {{'metric': 'rows_after_raw_dedupe', 'value': (SELECT count(*) FROM one_{n})}},
  {{'metric': 'duplicates_raw_removed', 'value': (SELECT count(*) FROM raw_{n}) - (SELECT count(*) FROM one_{n})}},
  {{'metric': 'rows_out', 'value': (SELECT count(*) FROM c_{n})}},
  {{'metric': 'pk_null_count', 'value': (SELECT count(*) FROM c_{n} WHERE {norm(s.pk)} IS NULL)}},
  {{'metric': 'duplicates_identical_after_cleaning_detected', 'value': 0::BIGINT}}], recursive := true))""" for n, s in TABLES.items()])

# --------------------------------------------------------------------- cleaning
SQL["clean_churn"] = f"""SELECT churn_event_id, account_id, churn_date, reason_code, refund_amount_usd, feedback_text,
  {r('refund_amount_clean')}, {FLAG} FROM c_churn_events"""
SQL["account_churn_map"] = f"SELECT account_id_norm, {d('churn_day')}, churn_text FROM churn_map"
SQL["clean_accounts"] = f"""SELECT account_id, account_name, industry, country, signup_date, seats, churn_flag, country_clean,
  industry_clean, churn_flag_clean, account_churn_date_clean, {FLAG} FROM c_accounts"""


def _mode(col: str) -> str:
    return f"""(SELECT account_id AS k, {col} AS v FROM (SELECT account_id, {col}, row_number() OVER (PARTITION BY account_id
  ORDER BY count(*) DESC, {col}) AS r FROM raw_accounts WHERE NOT {blank(col)} GROUP BY 1, 2) WHERE r = 1)"""


SQL["impute_mode"] = f"""SELECT account_id, account_name, country, industry,
  CASE WHEN NOT {blank('country')} THEN country ELSE coalesce(c.v, 'Unknown') END AS country_clean,
  CASE WHEN NOT {blank('industry')} THEN industry ELSE coalesce(i.v, 'Unknown') END AS industry_clean
FROM raw_accounts LEFT JOIN {_mode('country')} c ON c.k = account_id LEFT JOIN {_mode('industry')} i ON i.k = account_id"""
SQL["price_lookup"] = f"SELECT seat AS seats, plan AS plan_tier, {rnd('m')} AS mrr, {rnd('a')} AS arr FROM seat_price"
SQL["seat_plan_lookup"] = "SELECT seat AS seat_key, plan AS seat_plan FROM seat_plan"
SQL["clean_subscriptions"] = f"""SELECT subscription_id, account_id, start_date, end_date, plan_tier, seats, mrr_amount, arr_amount,
  plan_tier_imputed, {r('mrr_amount_clean', 'arr_amount_clean')}, end_date_clean, {FLAG} FROM c_subscriptions"""
SQL["start_end_repair"] = f"""SELECT subscription_id, plan_tier, CASE WHEN g BETWEEN 1 AND 29 THEN end_date ELSE start_date END AS start_date,
  CASE WHEN g BETWEEN 1 AND 29 THEN start_date ELSE end_date END AS end_date,
  CASE WHEN g BETWEEN 1 AND 29 THEN 'start_end_swapped_due_to_small_gap' WHEN g >= 30 THEN 'start_after_end_flagged' ELSE '' END
    AS dirty_row_reason
FROM (SELECT *, coalesce({day('start_date')} - {day('end_date')}, 0) AS g FROM raw_subscriptions)"""
SQL["clean_usage"] = f"""SELECT usage_id, subscription_id, usage_date, {r('usage_count_clean', 'usage_duration_secs_clean')},
  feature_name_imputed, {FLAG} FROM c_feature_usage"""
SQL["orphan_usage"] = """SELECT * FROM raw_feature_usage WHERE subscription_id NOT IN (SELECT subscription_id FROM raw_subscriptions)"""
SQL["clean_tickets"] = f"""SELECT ticket_id, account_id, submitted_at, priority, {r('resolution_hours_clean')}, satisfaction_imputed,
  {FLAG} FROM c_support_tickets"""

# --------------------------------------------------------------------- features
SQL["load_inputs"] = f"""SELECT subscription_id, account_id, {d('start_date', 'end_date')}, plan_tier, plan_tier_imputed, seats,
  {r('mrr_amount_clean', 'arr_amount_clean')}, is_trial, up AS upgrade_flag, down AS downgrade_flag, gone AS churn_flag,
  {d('churn_date')}, {FLAG} FROM f_subscriptions"""
SQL["subscription_features"] = f"""SELECT subscription_id, account_id, {d('start_date', 'end_date', 'churn_date')}, start_month, end_month,
  churn_month, subscription_age_days, subscription_age_months, {r('mrr_clean', 'arr_clean', 'lifetime_mrr', 'churned_mrr')},
  is_churned, plan_tier, seat_bucket, seats, rev_change_flag, subscription_status, is_new, is_upgrade, is_downgrade, {FLAG},
  reason_count AS dirty_row_reason_count FROM subs_fe"""
SQL["usage_monthly"] = f"""SELECT subscription_id, usage_month, usage_count_month, {r('usage_duration_month')}, unique_features_month,
  error_count_month, days_in_month, {r('duration_per_use', 'usage_intensity')}, is_heavy_user_month FROM monthly_t"""
SQL["feature_month_rank"] = f"""SELECT subscription_id, account_id, feature_name, usage_month, usage_count, usage_duration_secs,
  {d('first_use_date', 'last_use_date')}, error_count, is_beta_feature, {r('duration_per_use')}, account_feature_rank FROM fmonth"""
SQL["first_use"] = f"""SELECT account_id, feature_name, {d('first_use_date', 'signup_date')}, days_to_adopt, is_beta_feature,
  beta_adopter, {FLAG} FROM fuse"""
SQL["support_events"] = f"""SELECT ticket_id, account_id, strftime(submitted_at, '%Y-%m-%d %H:%M:%S') AS submitted_at,
  strftime(closed_at, '%Y-%m-%d %H:%M:%S') AS closed_at, {rnd('h')} AS resolution_time_hours, priority, {r('priority_score')},
  resolution_bucket, escalation_flag, {r('satisfaction_score')}, {FLAG} FROM sevents"""
SQL["support_by_account"] = f"""SELECT account_id, ticket_count, escalated_tickets,
  {r('avg_resolution_hours', 'avg_satisfaction', 'avg_priority_score')}, tickets_90_days FROM sacct"""
SQL["account_features"] = f"""SELECT account_id, account_name, industry_clean, country_clean, {d('signup_date', 'churn_date')},
  {r('total_mrr', 'total_arr', 'avg_mrr', 'max_mrr', 'lifetime_gross_mrr', 'total_churned_mrr')}, num_subscriptions_lifetime
    AS num_subscriptions_lifetime, num_active_subscriptions, num_churns, lifetime_days, total_usage_count,
  {r('avg_monthly_active_features')}, ticket_count, tickets_90_days,
  {r('avg_resolution_hours', 'avg_satisfaction', 'avg_priority_score')}, escalated_tickets,
  {r('escalation_rate', 'tickets_per_active_subscription', 'usage_score', 'support_score', 'revenue_score', 'health_score')},
  customer_segment, {FLAG}, {r('daily_usage_rate')}
FROM (SELECT * REPLACE (coalesce(num_subscriptions_lifetime, 0) AS num_subscriptions_lifetime, coalesce(num_churns, 0) AS num_churns,
        coalesce(total_churned_mrr, 0) AS total_churned_mrr) FROM acct_fe)"""
SQL["account_scores"] = f"""SELECT account_id, {r('usage_score', 'support_score', 'revenue_score', 'health_score')}, customer_segment
FROM acct_fe"""

# ----------------------------------------------------------------------- ledger
SQL["revenue_ledger"] = f"""SELECT subscription_id, account_id, month, {r('mrr', 'prev_mrr', 'change_amount')}, change_type, cohort_month,
  months_since_signup FROM changes_t"""
SQL["revenue_changes"] = f"""SELECT subscription_id, account_id, month, change_type, {r('change_amount', 'mrr', 'prev_mrr')}
FROM changes_t WHERE change_type <> 'unchanged'"""
SQL["ledger_repriced"] = f"""SELECT subscription_id, account_id, month, change_type, {r('change_amount', 'mrr', 'prev_mrr')} FROM (
  SELECT *, mrr - prev_mrr AS change_amount, CASE WHEN abs(mrr - prev_mrr) < 0.01 THEN 'unchanged' WHEN prev_mrr = 0 AND mrr > 0 THEN 'new'
    WHEN prev_mrr > 0 AND mrr = 0 THEN 'churn' WHEN mrr > prev_mrr THEN 'expansion' ELSE 'contraction' END AS change_type
  FROM (SELECT *, lag(mrr, 1, 0) OVER (PARTITION BY subscription_id ORDER BY month_start) AS prev_mrr FROM (
    SELECT l.* REPLACE (CASE WHEN l.mrr = 0 THEN 0 ELSE coalesce(p.mrr, l.mrr) END AS mrr) FROM ledger_t l LEFT JOIN (
      SELECT 'S-' || l_orderkey AS subscription_id, {ym('l_shipdate')} AS month, sum(floor(l_extendedprice) / 100) AS mrr
      FROM lineitem GROUP BY 1, 2) p ON p.subscription_id = l.subscription_id AND p.month = l.month)))
WHERE change_type <> 'unchanged'"""
SQL["cohort_rows"] = f"SELECT subscription_id, account_id, month, {r('mrr')}, is_churned_month, cohort_month, months_since_signup FROM cohorts_t"
SQL["cohort_retention"] = SQL["cohort_retention_rows"] = """SELECT cohort_month, months_since_signup,
  count(DISTINCT subscription_id) AS active_subs FROM cohorts_t GROUP BY 1, 2"""
SQL["cohort_retention_active"] = """SELECT cohort_month, months_since_signup, count(DISTINCT subscription_id) AS active_subs
FROM cohorts_t WHERE mrr <> 0 GROUP BY 1, 2"""
SQL["cohort_churn_lifecycle"] = SQL["cohort_churn_lifecycle_rows"] = """SELECT months_since_signup,
  count(DISTINCT subscription_id) AS churned_subs FROM cohorts_t WHERE is_churned_month GROUP BY 1"""
SQL["cohort_nrr_curve"] = SQL["cohort_nrr_curve_rows"] = f"""SELECT cohort_month, months_since_signup, {r('mrr', 'starting_mrr')},
  {rnd('mrr / nullif(starting_mrr, 0)')} AS nrr_pct
FROM (SELECT cohort_month, months_since_signup, sum(mrr) AS mrr FROM cohorts_t GROUP BY 1, 2)
LEFT JOIN (SELECT cohort_month, sum(mrr) AS starting_mrr FROM cohorts_t WHERE months_since_signup = 0 GROUP BY 1) USING (cohort_month)"""
SQL["saas_quick_ratio"] = f"""SELECT month, {r('gains', 'losses')},
  {rnd('CASE WHEN losses > 0 THEN gains / losses WHEN gains = 0 THEN 0 ELSE 999 END')} AS quick_ratio
FROM (SELECT month, coalesce(sum(abs(change_amount)) FILTER (change_type IN ('new', 'expansion')), 0) AS gains,
  coalesce(sum(abs(change_amount)) FILTER (change_type IN ('contraction', 'churn')), 0) AS losses
  FROM changes_t WHERE change_type <> 'unchanged' GROUP BY 1)"""


# ---------------------------------------------------------------------- reports
def describe(table: str, column: str, name: str, where: str = "true") -> str:
    x = f"CAST({column} AS DOUBLE)"
    rows = (("count", f"count({x})"), ("mean", f"avg({x})"), ("std", f"stddev_samp({x})"), ("min", f"min({x})"),
            ("25%", f"quantile_cont({x}, 0.25)"), ("50%", f"quantile_cont({x}, 0.5)"), ("75%", f"quantile_cont({x}, 0.75)"),
            ("max", f"max({x})"))
    return union([f"SELECT '{label}' AS \"index\", {rnd(f'CAST({e} AS DOUBLE)')} AS {name} FROM {table} WHERE {where}"
                  for label, e in rows])


SQL["trial_conversion_metrics"] = union([f"SELECT '{m}' AS metric, {rnd(e)} AS value FROM (SELECT count(*) AS n, count(*) FILTER (paid) AS p FROM (SELECT DISTINCT account_id, account_id IN (SELECT account_id FROM acct_fe WHERE lifetime_gross_mrr > 0) AS paid FROM subs_fe WHERE subscription_status = 'trial' OR plan_tier = 'Trial'))"
                                         for m, e in (("total_trial_accounts", "n"), ("converted_to_paid", "p"),
                                                      ("conversion_rate", "coalesce(p / nullif(n, 0), 0)"))])
_AGE = "median(CAST(subscription_age_days AS DOUBLE))"
SQL["subs_churn_summary"] = f"""SELECT is_churned, count(subscription_id) AS subscriptions, {rnd('avg(mrr_clean)')} AS avg_mrr,
  {rnd(_AGE)} AS median_age FROM subs_fe GROUP BY 1"""
SQL["subs_mrr_stats"] = describe("subs_fe", "mrr_clean", "mrr_clean")
SQL["subs_top_decile_stats"] = f"""SELECT mrr_clean >= (SELECT quantile_cont(CAST(mrr_clean AS DOUBLE), 0.9) FROM subs_fe) AS is_top_decile,
  count(subscription_id) AS subscriptions, {rnd('sum(mrr_clean)')} AS total_mrr, {rnd('avg(CAST(is_churned AS INTEGER))')} AS churn_rate
FROM subs_fe GROUP BY 1"""
SQL["subs_plan_tier_distribution"] = f"""SELECT plan_tier, count(subscription_id) AS subscriptions, {rnd('sum(mrr_clean)')} AS total_mrr,
  {rnd('avg(mrr_clean)')} AS avg_mrr FROM subs_fe WHERE plan_tier IS NOT NULL GROUP BY 1"""
SQL["subs_status_distribution"] = f"""SELECT subscription_status, count(subscription_id) AS subscriptions, {rnd('avg(mrr_clean)')} AS avg_mrr,
  {rnd(_AGE)} AS median_age FROM subs_fe GROUP BY 1"""
_DAYS = "CAST(subscription_age_days AS DOUBLE)"
SQL["subs_tenure_stats"] = f"""SELECT is_churned, count({_DAYS}) AS count, {rnd(f'avg({_DAYS})')} AS mean,
  {rnd(f'stddev_samp({_DAYS})')} AS std, {rnd(f'min({_DAYS})')} AS min, {rnd(f'quantile_cont({_DAYS}, 0.25)')} AS "25%",
  {rnd(f'quantile_cont({_DAYS}, 0.5)')} AS "50%", {rnd(f'quantile_cont({_DAYS}, 0.75)')} AS "75%", {rnd(f'max({_DAYS})')} AS max
FROM subs_fe GROUP BY 1"""
SQL["acct_mrr_stats_global"] = describe("acct_fe", "total_mrr", "total_mrr")
SQL["acct_mrr_stats_paying_only"] = describe("acct_fe", "total_mrr", "total_mrr", "total_mrr > 0")
SQL["acct_churn_comparison"] = f"""SELECT churn_date IS NOT NULL AS is_account_churned, count(account_id) AS accounts,
  {rnd('avg(total_mrr)')} AS avg_current_mrr, {rnd('avg(lifetime_gross_mrr)')} AS avg_lifetime_value,
  {rnd('avg(health_score)')} AS avg_health FROM acct_fe GROUP BY 1"""
SQL["acct_segment_distribution"] = f"""SELECT customer_segment, count(account_id) AS accounts, {rnd('sum(total_mrr)')} AS total_mrr,
  {rnd('avg(health_score)')} AS avg_health FROM acct_fe GROUP BY 1"""
SQL["acct_paying_aov_stats"] = describe(
    "acct_fe", "lifetime_gross_mrr / CASE WHEN num_subscriptions_lifetime = 0 THEN 1 ELSE num_subscriptions_lifetime END",
    "lifetime_aov", "lifetime_gross_mrr > 0")
SQL["ltv_proxy_by_segment"] = f"""SELECT customer_segment, {rnd('avg(lifetime_gross_mrr)')} AS avg_lifetime_gross_mrr,
  {rnd('avg(lifetime_days / 30)')} AS avg_months_active, count(account_id) AS account_count FROM acct_fe GROUP BY 1"""
SQL["feature_depth_vs_churn"] = f"""SELECT feature_depth_bin, coalesce(n, 0) AS total_accounts, coalesce(c, 0) AS churned_accounts,
  {rnd('c / n')} AS churn_rate
FROM (SELECT unnest(['Low', 'Med-Low', 'Med-High', 'High']) AS feature_depth_bin) LEFT JOIN (
  SELECT CASE WHEN x <= q[1] THEN 'Low' WHEN x <= q[2] THEN 'Med-Low' WHEN x <= q[3] THEN 'Med-High' ELSE 'High' END AS b,
    count(*) AS n, count(churn_date) AS c
  FROM (SELECT churn_date, CAST(avg_monthly_active_features AS DOUBLE) AS x,
          (SELECT quantile_cont(CAST(avg_monthly_active_features AS DOUBLE), [0.25, 0.5, 0.75]) FROM acct_fe) AS q FROM acct_fe) GROUP BY 1)
  ON b = feature_depth_bin"""
SQL["feature_adoption"] = """SELECT feature_name, count(DISTINCT account_id) AS accounts_used FROM fmonth
WHERE feature_name IS NOT NULL GROUP BY 1"""
SQL["feature_usage_distribution"] = """SELECT feature_name, CAST(sum(usage_count) AS BIGINT) AS total_usage FROM fmonth
WHERE feature_name IS NOT NULL GROUP BY 1"""
SQL["feature_first_use_stats"] = describe("fuse", "days_to_adopt", "days_to_adopt")
SQL["usage_monthly_trends"] = f"""SELECT usage_month, CAST(sum(usage_count_month) AS BIGINT) AS total_usage,
  {rnd('avg(usage_intensity)')} AS avg_intensity FROM monthly_t WHERE usage_month IS NOT NULL GROUP BY 1"""
SQL["cohort_nrr_by_segment"] = f"""SELECT customer_segment, months_since_signup, {rnd('mrr')} AS mrr, {rnd('starting_mrr')} AS starting_mrr,
  {rnd('mrr / nullif(starting_mrr, 0)')} AS nrr_pct
FROM (SELECT *, first_value(mrr) OVER (PARTITION BY customer_segment ORDER BY months_since_signup) AS starting_mrr FROM (
  SELECT customer_segment, months_since_signup, sum(mrr_clean) AS mrr FROM (
    SELECT coalesce(a.customer_segment, 'SMB') AS customer_segment, mrr_clean, CAST(unnest(range(0, greatest(0,
      CASE WHEN start_date IS NULL THEN 1 ELSE {months('start_date', f'coalesce(s.churn_date, newest, {AS_OF})')} + 1 END))) AS BIGINT) AS months_since_signup
    FROM subs_fe s LEFT JOIN acct_fe a ON a.account_id = s.account_id
      LEFT JOIN (SELECT max(end_date) AS newest FROM subs_fe) ON true WHERE mrr_clean <> 0) GROUP BY 1, 2))"""
SQL["support_segment_stats"] = f"""SELECT customer_segment, {rnd('t')} AS total_tickets, n AS active_accounts, {rnd('m')} AS total_revenue,
  {rnd('round_even(t / n, 1)')} AS tickets_per_account, {rnd('round_even(coalesce(m / nullif(t, 0), 0), 2)')} AS revenue_per_ticket
FROM (SELECT customer_segment, CAST(sum(ticket_count) AS DOUBLE) AS t, count(DISTINCT account_id) AS n, sum(total_mrr) AS m FROM acct_fe GROUP BY 1)"""

# ---------------------------------------------------------------------- quality
_MISSING_WORDS = "('', 'unknown', 'nan', 'na', 'null', 'none')"


def _t(c: str) -> str:
    return f"trim(CAST({c} AS VARCHAR))"


def _missing_word(c: str) -> str:
    return f"({c} IS NULL OR lower({_t(c)}) IN {_MISSING_WORDS})"


def _no_value(c: str) -> str:
    return f"({c} IS NULL OR lower({_t(c)}) IN ('', 'nan', 'none', 'null'))"


def _bare(c: str) -> str:
    t = f"CAST({c} AS VARCHAR)"
    return f"coalesce(TRY_CAST({t} AS DOUBLE), TRY_CAST(regexp_replace({t}, '[^0-9.\\-]', '', 'g') AS DOUBLE))"


def _plus(conds: list[str]) -> str:
    return " + ".join(f"CAST({c} AS INTEGER)" for c in conds)


# Effective columns of the clean tables and their types.
EFFECTIVE = {
    "accounts": {"country_clean": "categorical", "industry_clean": "categorical", "churn_flag_clean": "categorical",
                 "account_churn_date_clean": "date", "account_id": "id", "account_name": "text", "signup_date": "date",
                 "referral_source": "categorical", "plan_tier": "categorical", "seats": "numeric", "is_trial": "categorical"},
    "subscriptions": {"plan_tier_imputed": "categorical", "mrr_amount_clean": "numeric", "arr_amount_clean": "numeric",
                      "end_date_clean": "date", "subscription_id": "id", "account_id": "id", "start_date": "date",
                      "seats": "numeric", "is_trial": "categorical", "upgrade_flag": "categorical",
                      "downgrade_flag": "categorical", "churn_flag": "categorical", "billing_frequency": "categorical",
                      "auto_renew_flag": "categorical"},
    "feature_usage": {"usage_count_clean": "numeric", "usage_duration_secs_clean": "numeric", "feature_name_imputed": "categorical",
                      "usage_id": "id", "subscription_id": "id", "usage_date": "date", "error_count": "numeric",
                      "is_beta_feature": "categorical"},
    "support_tickets": {"resolution_hours_clean": "numeric", "satisfaction_imputed": "categorical", "ticket_id": "id",
                        "account_id": "id", "submitted_at": "text", "closed_at": "text", "resolution_time_hours": "numeric",
                        "priority": "categorical", "first_response_time_minutes": "numeric",
                        "satisfaction_score": "categorical", "escalation_flag": "categorical"},
    "churn_events": {"refund_amount_clean": "numeric", "churn_event_id": "id", "account_id": "id", "churn_date": "date",
                     "reason_code": "categorical", "refund_amount_usd": "numeric", "preceding_upgrade_flag": "categorical",
                     "preceding_downgrade_flag": "categorical", "is_reactivation": "categorical", "feedback_text": "text"},
}


def _invalid(c: str, kind: str) -> str:
    return {"date": f"NOT {looks(c)}", "numeric": f"{_bare(c)} IS NULL", "id": _no_value(c), "categorical": _no_value(c),
            "text": f"coalesce(CAST({c} AS VARCHAR) = '', true)"}[kind]


SQL["completeness"] = union(
    [f"""SELECT '{n}' AS table_name, 'before' AS measure, {rnd(f"1 - sum({_plus([_missing_word(c) for c in s.columns])}) / (count(*) * {len(s.columns)})")}
  AS value FROM raw_{n}""" for n, s in TABLES.items()]
    + [f"""SELECT '{n}' AS table_name, 'effective' AS measure, {rnd(f"1 - sum({_plus([blank(c) for c in e])}) / (count(*) * {len(e)})")}
  AS value FROM c_{n}""" for n, e in EFFECTIVE.items()])

_DATE_COLUMNS = {"accounts": ("signup_date",), "subscriptions": ("start_date", "end_date"), "feature_usage": ("usage_date",),
                 "support_tickets": (), "churn_events": ("churn_date",)}
_NEG_COLUMNS = {"accounts": ("seats",), "subscriptions": ("seats", "mrr_amount", "arr_amount"),
                "feature_usage": ("usage_count", "usage_duration_secs", "error_count"),
                "support_tickets": ("resolution_time_hours", "first_response_time_minutes"),
                "churn_events": ("refund_amount_usd",)}


def _raw_issues(n: str) -> list[str]:
    s = TABLES[n]
    return ([blank(c) for c in s.columns] + [blank(s.pk)] + [f"coalesce({_bare(c)} < 0, false)" for c in _NEG_COLUMNS[n]]
            + [f"NOT {looks(c)}" for c in _DATE_COLUMNS[n]])


def _clean_issue(n: str) -> str:
    s = TABLES[n]
    bad = [_no_value(c) for c in s.required] + [f"(NOT {blank(c)} AND NOT {looks(c)})" for c in _DATE_COLUMNS[n]]
    if n == "subscriptions":
        bad.append(f"coalesce({day('start_date')} - {day('end_date_clean')} >= 30, false)")
    return " OR ".join(bad)


_INCONSISTENT = {
    "accounts": f"SELECT count(*) FROM c_accounts WHERE churn_flag_clean AND {blank('account_churn_date_clean')}",
    "subscriptions": f"SELECT count(*) FROM c_subscriptions WHERE {day('start_date')} > {day('end_date_clean')}",
    "feature_usage": f"""SELECT count(*) FROM c_feature_usage u LEFT JOIN c_subscriptions s ON s.subscription_id_norm = u.subscription_id_norm
      LEFT JOIN c_accounts a ON a.account_id_norm = s.account_id_norm
      WHERE {day('u.usage_date')} > {day('s.end_date_clean')} OR {day('u.usage_date')} > {day('a.account_churn_date_clean')}""",
    "support_tickets": "SELECT 0", "churn_events": "SELECT 0"}


def _summary(n: str) -> str:
    s, e = TABLES[n], EFFECTIVE[n]
    return f"""SELECT '{n}' AS table_name, * FROM (
  SELECT count(*) AS rows_before, sum({_plus(_raw_issues(n))})::BIGINT AS issues_before,
    count(*) FILTER ({' OR '.join(_raw_issues(n))}) AS rows_with_issues_before,
    1 - sum({_plus([_missing_word(c) for c in s.columns])}) / (count(*) * {len(s.columns)}) AS cb FROM raw_{n}), (
  SELECT count(*) AS rows_after, 1 - count(*) FILTER ({' OR '.join(_no_value(c) for c in s.required)}) / count(*) AS ca,
    count(DISTINCT {s.pk}) / count(*) AS un,
    1 - sum({_plus([_invalid(c, k) for c, k in e.items()])}) / (count(*) * {len(e)}) AS va,
    1 - ({_INCONSISTENT[n]}) / count(*) AS co, count(*) FILTER ({_clean_issue(n)}) AS issues_after FROM c_{n})"""


def _six(x: str) -> str:
    return f"floor(round_even({x}, 6) * 1000000 + 0.501) / 1000000"


SQL["dq_summary"] = f"""SELECT table_name, {_six('cb')} AS completeness_before, {_six('ca')} AS completeness_after,
  {_six('(ca - cb) / nullif(cb, 0)')} AS completeness_improvement_pct, {_six('un')} AS uniqueness, {_six('va')} AS validity,
  {_six('co')} AS consistency, {_six('0.3 * ca + 0.25 * un + 0.25 * va + 0.2 * co')} AS final_quality_score, rows_before,
  rows_after, issues_before, issues_after, {_six('(issues_before - issues_after) / nullif(issues_before, 0)')} AS issues_reduction_pct,
  rows_with_issues_before FROM ({union([_summary(n) for n in TABLES])})"""

_NUMERIC_CURATED = ("mrr_amount_clean", "arr_amount_clean", "usage_count_clean", "usage_duration_secs_clean", "resolution_hours_clean")
_DATE_CURATED = ("start_date", "end_date_clean", "usage_date", "churn_date")


def _long(n: str, c: str) -> str:
    if c in _DATE_CURATED:
        bad = f"NOT {_no_value(c)} AND NOT {looks(c)}"
    elif c in _NUMERIC_CURATED:
        bad = f"NOT {_no_value(c)} AND TRY_CAST({_t(c)} AS DOUBLE) IS NULL"
    else:
        bad = "false"
    missing = "0" if c == "end_date_clean" else f"count(*) FILTER ({_no_value(c)})"
    return f"""SELECT '{n}' AS table_name, '{c}' AS column_name, {missing} / count(*) AS m, count(*) FILTER ({bad}) / count(*) AS i,
  count(DISTINCT coalesce({_t(c)}, '')) / count(*) AS u FROM c_{n}"""


SQL["dq_long"] = f"""SELECT table_name, column_name, {rnd('m')} AS pct_missing, {rnd('i')} AS pct_invalid, {rnd('u')} AS pct_unique
FROM ({union([_long(n, c) for n, s in TABLES.items() for c in s.curated])})"""


def _profile(n: str, c: str) -> str:
    none_d, none_t = "NULL::DOUBLE", "NULL::VARCHAR"
    kind = "date" if c in _DATE_CURATED else "numeric" if c in _NUMERIC_CURATED else "text"
    lo, hi, avg, first, last = none_d, none_d, none_d, none_t, none_t
    if kind == "numeric":
        lo, hi, avg = (f"{f}(CAST({c} AS DOUBLE))" for f in ("min", "max", "avg"))
    if kind == "date":
        first, last = (dmy(f"{f}({day(c)})") for f in ("min", "max"))
    return f"""SELECT '{n}' AS table_name, '{c}' AS column_name, '{kind}' AS dtype, {rnd(lo)} AS min_number, {rnd(hi)} AS max_number,
  {first} AS min_date, {last} AS max_date, {rnd(avg)} AS avg_val, {rnd(f'count(*) FILTER ({blank(c)}) / count(*)')} AS missing_pct,
  {rnd(f'count(DISTINCT {c}) / count(*)')} AS unique_pct FROM c_{n}"""


SQL["dq_col_profile"] = union([_profile(n, c) for n, s in TABLES.items() for c in s.curated])


def _errors(n: str) -> str:
    s = TABLES[n]
    cells = []
    for c in s.curated:
        if c in _DATE_CURATED:
            e = f"CASE WHEN NOT {looks(c)} THEN 'invalid_date_format' END"
        elif c in _NUMERIC_CURATED:
            e = f"CASE WHEN CAST({c} AS DOUBLE) < 0 THEN 'negative_value' END"
        else:
            e = f"CASE WHEN lower({_t(c)}) IN ('nan', 'none', 'null') THEN 'unexpected_token' END"
        cells.append(f"""SELECT '{n}' AS table_name, {s.pk} AS primary_key, '{c}' AS column_name, {e} AS error_type,
      CAST({c} AS VARCHAR) AS original_value, NULL::VARCHAR AS cleaned_value FROM c_{n} WHERE NOT {blank(c)} AND lower({_t(c)}) <> 'unknown'""")
    return f"(SELECT * FROM ({union(cells)}) WHERE error_type IS NOT NULL)"


SQL["dq_errors"] = union([f"SELECT * FROM {_errors(n)}" for n in TABLES])
CTES["by_table_t"] = f"""SELECT v.*, coalesce(c.n, 0)::BIGINT AS corrections_applied, coalesce(c.i, 0)::BIGINT AS imputations_applied FROM ({union([f'''
SELECT '{n}' AS table_name, (SELECT count(*) FROM raw_{n}) AS rows_before, count(*) AS rows_after,
  (SELECT count(*) FROM raw_{n}) - count(*) AS duplicates_removed, count(*) FILTER ({_clean_issue(n)}) AS remaining_issues FROM c_{n}''' for n in TABLES])}) v
LEFT JOIN (SELECT table_name, sum(rows) AS n, sum(rows) FILTER (reason_code LIKE '%imput%') AS i FROM corrections_t GROUP BY 1) c
  ON c.table_name = v.table_name"""
SQL["dq_validation_by_table"] = "SELECT * FROM by_table_t"
SQL["dq_validation_totals"] = """SELECT 'totals' AS metric, sum(duplicates_removed)::BIGINT AS duplicates_removed,
  sum(corrections_applied)::BIGINT AS corrections_applied, sum(imputations_applied)::BIGINT AS imputations_applied,
  sum(remaining_issues)::BIGINT AS invalid_dates_remaining FROM by_table_t"""


def _metrics(n: str, c: str, kind: str) -> str:
    empty = f"({c} IS NULL OR {c} = '')"
    bad = {"numeric": f"{_bare(c)} IS NULL", "date": f"NOT {looks(c)}", "text": "false"}.get(kind, empty)
    neg, zero = ((f"coalesce({_bare(c)} < 0, false)", f"coalesce({_bare(c)} = 0, false)") if kind == "numeric" else ("false", "false"))
    shares = (("percent_missing", f"count(*) FILTER ({empty})"), ("percent_invalid", f"count(*) FILTER ({bad})"),
              ("percent_unique", f"count(DISTINCT {c})"), ("percent_negative", f"count(*) FILTER ({neg})"),
              ("percent_zero", f"count(*) FILTER ({zero})"))
    return (f"SELECT '{n}' AS table_name, '{c}' AS column_name, '{kind}' AS col_type, "
            + ", ".join(f"{_six(f'{e} / count(*)')} AS {p}" for p, e in shares) + f" FROM raw_{n}")


SQL["column_metrics"] = union([_metrics(n, c, s.kind(c)) for n, s in TABLES.items() for c in s.columns])
SQL["column_metrics_by_name"] = union([_metrics(n, c, classify_name(c)) for n, s in TABLES.items() for c in s.columns])


def _column_profile(n: str, c: str, kind: str) -> str:
    x = _bare(c)
    stats = [f"{rnd(f'{f}({x})')} AS {a}" if kind == "numeric" else f"NULL::DOUBLE AS {a}"
             for f, a in (("min", "min"), ("max", "max"), ("avg", "mean"))]
    return f"""SELECT '{n}' AS table_name, '{c}' AS column_name, '{kind}' AS col_type, count({c}) AS non_null_count,
  count(*) FILTER ({c} = '') AS blank_count, count(*) FILTER ({c} IS NULL) AS null_count, count(DISTINCT {c}) AS distinct_count,
  (SELECT '["' || string_agg(v, '","' ORDER BY v) || '"]' FROM (SELECT DISTINCT {c} AS v FROM raw_{n} WHERE {c} IS NOT NULL ORDER BY 1 LIMIT 10))
    AS sample_values, {', '.join(stats)} FROM raw_{n}"""


SQL["column_profile"] = union([_column_profile(n, c, s.kind(c)) for n, s in TABLES.items() for c in s.columns])

# ------------------------------------------------------------------- validation
CTES["checks_t"] = union([
    "SELECT 'missing_required_columns' AS check, 'error' AS severity, 0::BIGINT AS violations",
    "SELECT 'orphan_account_id', 'error', count(*) FROM subs_fe WHERE account_id NOT IN (SELECT account_id FROM acct_fe)",
    "SELECT 'start_after_end', 'error', count(*) FROM subs_fe WHERE start_date > end_date",
    "SELECT 'churn_before_start', 'warning', count(*) FROM subs_fe WHERE churn_date < start_date",
    "SELECT 'negative_mrr', 'error', count(*) FROM subs_fe WHERE mrr_clean < 0",
    "SELECT 'negative_arr', 'error', count(*) FROM subs_fe WHERE arr_clean < 0"])
SQL["validation_checks"] = "SELECT * FROM checks_t"
SQL["validation_verdict"] = """SELECT CASE WHEN sum(violations) = 0 THEN 'PASS' ELSE 'FAIL' END AS verdict,
  sum(violations)::BIGINT AS error_rows FROM checks_t WHERE severity = 'error'"""

# Output table to (check table, {output column: check column where the names differ}).
_REASON = {"dirty_row_flag": "reasons", "dirty_row_reason": "reasons"}
_SUBS = ("subscription_id account_id start_date end_date start_month end_month subscription_age_days subscription_age_months mrr_clean "
         "arr_clean lifetime_mrr churned_mrr is_churned churn_date churn_month plan_tier seat_bucket seats rev_change_flag "
         "subscription_status is_new is_upgrade is_downgrade dirty_row_flag dirty_row_reason dirty_row_reason_count").split()
_ACCT = ("account_id account_name industry_clean country_clean signup_date churn_date total_mrr total_arr avg_mrr max_mrr "
         "lifetime_gross_mrr lifetime_days total_usage_count avg_monthly_active_features ticket_count tickets_90_days "
         "num_active_subscriptions avg_resolution_hours avg_satisfaction avg_priority_score escalated_tickets escalation_rate "
         "tickets_per_active_subscription usage_score support_score revenue_score health_score customer_segment dirty_row_flag "
         "dirty_row_reason daily_usage_rate").split()
_ACCT_FILLED = ("total_churned_mrr", "num_subscriptions_lifetime", "num_churns")
_MONTH = ("subscription_id usage_month usage_count_month usage_duration_month unique_features_month error_count_month days_in_month "
          "duration_per_use usage_intensity is_heavy_user_month").split()
_FMONTH = ("subscription_id account_id feature_name usage_month usage_count usage_duration_secs first_use_date last_use_date error_count "
           "is_beta_feature duration_per_use account_feature_rank").split()
_FUSE = ("account_id feature_name first_use_date days_to_adopt is_beta_feature beta_adopter signup_date dirty_row_flag "
         "dirty_row_reason").split()
_SEV = ("ticket_id account_id submitted_at closed_at resolution_time_hours priority priority_score resolution_bucket escalation_flag "
        "satisfaction_score dirty_row_flag dirty_row_reason").split()
_SACCT = ("account_id ticket_count escalated_tickets avg_resolution_hours avg_satisfaction avg_priority_score tickets_90_days").split()
_CHANGE = "subscription_id account_id month change_type change_amount mrr prev_mrr".split()
_NAMES = {**_REASON, "dirty_row_reason_count": "reason_count", "resolution_time_hours": "h"}


def _share_null(out: str, table: str, columns: list[str]) -> list[str]:
    return [f"SELECT '{out}' AS table_name, '{c}' AS column_name, 1 - count({_NAMES.get(c, c) if table != 'sacct' else c}) / count(*) AS p FROM {table}"
            for c in columns]


SQL["missingness"] = f"""SELECT table_name, column_name, {rnd('p')} AS missing_pct FROM ({union(
    _share_null('subscriptions', 'subs_fe', _SUBS) + _share_null('accounts', 'acct_fe', _ACCT)
    + _share_null('usage_monthly', 'monthly_t', _MONTH) + _share_null('feature_month', 'fmonth', _FMONTH)
    + _share_null('first_use', 'fuse', _FUSE) + _share_null('support_events', 'sevents', _SEV))}) WHERE p > 0.2"""


def _constant(out: str, table: str, columns: list[str]) -> list[str]:
    return [f"SELECT '{out}' AS table_name, '{c}' AS column_name, count(DISTINCT {_NAMES.get(c, c)}) AS n FROM {table}" for c in columns]


_NUM_SUBS = ("subscription_age_days subscription_age_months mrr_clean arr_clean lifetime_mrr churned_mrr seats dirty_row_reason_count").split()
_NUM_ACCT = [c for c in _ACCT if c not in ("account_id", "account_name", "industry_clean", "country_clean", "signup_date", "churn_date",
                                           "customer_segment", "dirty_row_flag", "dirty_row_reason")]
_NUM_MONTH = [c for c in _MONTH if c not in ("subscription_id", "usage_month", "is_heavy_user_month")]
_FILLED_COUNTS = [f"SELECT 'accounts' AS table_name, '{c}' AS column_name, count(DISTINCT coalesce({c}, 0)) AS n FROM acct_fe" for c in _ACCT_FILLED]
SQL["constant_columns"] = f"""SELECT table_name, column_name FROM ({union(_constant('subscriptions', 'subs_fe', _NUM_SUBS)
    + _constant('accounts', 'acct_fe', _NUM_ACCT) + _FILLED_COUNTS + _constant('usage_monthly', 'monthly_t', _NUM_MONTH))}) WHERE n <= 1"""

SQL["deep_validation"] = union([
    "SELECT 'A1_zero_days_to_adopt' AS check, count(*) FILTER (days_to_adopt = 0) AS violations FROM fuse",
    """SELECT 'A2_first_use_before_signup', count(*) FROM fuse f JOIN acct_fe a ON a.account_id = f.account_id
WHERE f.first_use_date < a.signup_date""",
    "SELECT 'B1_churned_without_date', count(*) FROM subs_fe WHERE is_churned AND churn_date IS NULL",
    "SELECT 'B2_active_with_churn_date', count(*) FROM subs_fe WHERE NOT is_churned AND churn_date IS NOT NULL",
    "SELECT 'B3_churn_after_end', count(*) FROM subs_fe WHERE churn_date > end_date",
    "SELECT 'C1_negative_months', count(*) FROM cohorts_t WHERE months_since_signup < 0"])
SQL["churn_after_end_rows"] = f"SELECT subscription_id, {d('churn_date', 'end_date')} FROM subs_fe WHERE churn_date > end_date"
SQL["churned_without_date_rows"] = "SELECT subscription_id, account_id FROM subs_fe WHERE is_churned AND churn_date IS NULL"
SQL["active_with_churn_date_rows"] = "SELECT subscription_id, account_id FROM subs_fe WHERE NOT is_churned AND churn_date IS NOT NULL"
SQL["first_use_before_signup_rows"] = f"""SELECT f.account_id, feature_name, {d('first_use_date')} FROM fuse f JOIN acct_fe a ON a.account_id = f.account_id
WHERE f.first_use_date < a.signup_date"""
SQL["negative_cohort_rows"] = "SELECT subscription_id, month, months_since_signup FROM cohorts_t WHERE months_since_signup < 0"
SQL["reason_texts"] = f"""SELECT ticket_id, reasons, CAST(CASE WHEN reasons = '' THEN 0 ELSE len(string_split(reasons, '|')) END AS BIGINT) AS reason_count
FROM c_support_tickets"""
SQL["row_counts"] = union([f"SELECT '{n}' AS table_name, count(*) AS rows FROM {t}" for n, t in (
    ("subscriptions", "subs_fe"), ("usage_monthly", "monthly_t"), ("feature_month", "fmonth"), ("first_use", "fuse"),
    ("support_events", "sevents"), ("support_by_account", "sacct"), ("accounts", "acct_fe"), ("cohorts", "cohorts_t"),
    ("revenue_changes", "changes_t WHERE change_type <> 'unchanged'"))])

# ----------------------------------------------------------------------- faults
CTES["clean_customers"] = f"""SELECT c_custkey AS k, 'A-' || lpad(c_custkey::VARCHAR, 9, '0') AS account_id, c_name AS account_name,
  c_mktsegment AS industry, 'N' || c_nationkey AS country, {tf('c_acctbal < 0')} AS churn_flag FROM customer"""
CTES["damaged"] = """SELECT k, account_id, account_name, CASE WHEN hit0 AND pick = 0 THEN NULL ELSE industry END AS industry,
  CASE WHEN hit0 AND pick = 1 THEN NULL ELSE country END AS country,
  CASE WHEN hit1 THEN CASE WHEN churn_flag = 'True' THEN 'False' ELSE 'True' END ELSE churn_flag END AS churn_flag,
  coalesce(nullif(concat_ws('; ', CASE WHEN hit0 AND pick = 0 THEN 'null_industry' WHEN hit0 THEN 'null_country' END,
    CASE WHEN hit1 THEN 'inconsistent_churn_flag' END), ''), 'no_issue') AS messiness_description, k * 6271 % 1000 < 300 AS keep
FROM (SELECT *, k * 5281 % 1000 < 200 AS hit0, k * 3571 % 1000 % 2 AS pick, k * 4409 % 1000 < 150 AS hit1 FROM clean_customers)
WHERE k * 7919 % 1000 < 100"""
_MESSY = "account_id, account_name, industry, country, churn_flag, messiness_description"
SQL["fault_injection"] = f"SELECT {_MESSY} FROM damaged"
CTES["free_ids"] = """SELECT i AS new_id, row_number() OVER (ORDER BY c) AS idx FROM (
  SELECT c, 'A-' || lpad(lower(printf('%x', c)), 9, '0') AS i FROM (SELECT unnest(range(1, 3 * (SELECT count(*) FROM customer) + 2)) AS c))
WHERE i NOT IN (SELECT account_id FROM clean_customers)"""
CTES["messy_t"] = """SELECT account_id, account_name, industry, country, churn_flag, messiness_description FROM damaged WHERE keep
UNION ALL SELECT new_id, account_name, industry, country, churn_flag, messiness_description
FROM (SELECT *, row_number() OVER (ORDER BY k) AS n FROM damaged WHERE NOT keep) JOIN free_ids ON idx = n"""
SQL["new_ids"] = "SELECT * FROM messy_t"
SQL["new_ids_overflow"] = """SELECT 'A-' || CASE WHEN length(h) < 2 THEN lpad(h, 2, '0') ELSE h END AS account_id, account_name
FROM (SELECT *, lower(printf('%x', row_number() OVER (ORDER BY k))) AS h FROM clean_customers)"""

SQL["new_ids_in_gaps"] = """WITH taken AS (SELECT DISTINCT c_custkey * 3 AS t FROM customer WHERE c_custkey > 0),
free AS (SELECT c, row_number() OVER (ORDER BY c) AS i FROM (SELECT unnest(range(1, (SELECT count(*) FROM orders) + (SELECT count(*) FROM taken) + 1)) AS c)
  WHERE c NOT IN (SELECT t FROM taken))
SELECT 'A-' || CASE WHEN c < 256 THEN lpad(lower(printf('%x', c)), 3, '0') ELSE lower(printf('%x', c)) END AS id, o_orderkey AS was
FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS i FROM orders) JOIN free USING (i)"""


def _injected(n: str) -> str:
    """The fault rules of a table on its raw rows, dice from the digits of the key."""
    s = TABLES[n]
    die = lambda name: f"(k * {DIE_FACTORS[name]} % {SIDES})"
    new, labels = {c: c for c in s.columns}, []
    for i, fault in enumerate(FAULTS[n]):
        for j, c in enumerate(fault.columns):
            mine = f"({die(f'hit{i}')} < {round(fault.chance * SIDES)} AND {die(f'pick{i}')} % {len(fault.columns)} = {j})"
            value = {"null": "NULL", "minus_one": "'-1'", "flip": f"CASE WHEN {yes(c)} THEN 'False' ELSE 'True' END",
                     "negate": f"'-' || regexp_replace({c}, '^-', '')"}[fault.action]
            new[c] = f"CASE WHEN {mine} THEN {value} ELSE {new[c]} END"
            labels.append(f"CASE WHEN {mine} THEN '{fault.label.format(column=c)}' END")
    cells = ", ".join(f"{e} AS {c}" for c, e in new.items())
    return f"""SELECT {cells}, coalesce(nullif(concat_ws('; ', {', '.join(labels)}), ''), 'no_issue') AS messiness_description
FROM (SELECT *, CAST(regexp_replace({s.pk}, '[^0-9]', '', 'g') AS BIGINT) AS k FROM raw_{n}) WHERE {die('sample')} < 100"""


for _n in ("subscriptions", "feature_usage", "churn_events", "support_tickets"):
    SQL[f"fault_injection_{_n}"] = _injected(_n)

_FILE_NULL = ", ".join(f"'{w}'" for w in FILE_NULL_WORDS)
SQL["csv_round_trip"] = union([
    f"""SELECT '{n}' AS table_name, '{c}' AS column_name, count(*) AS rows, count(x) AS filled, count(DISTINCT x) AS values
FROM (SELECT CASE WHEN {c} NOT IN ({_FILE_NULL}) THEN {c} END AS x FROM raw_{n})""" for n, s in TABLES.items() for c in s.columns])
SQL["merge_raw"] = """SELECT count(*) AS rows, count(DISTINCT account_id) AS keys, count(*) FILTER (industry IS NULL) AS no_industry,
  count(*) FILTER (country IS NULL) AS no_country, count(*) FILTER (churn_flag = 'True') AS churned FROM (
  SELECT account_id, industry, country, churn_flag FROM clean_customers UNION ALL SELECT account_id, industry, country, churn_flag FROM messy_t)"""


SQL |= stage_sql(SQL)


def oracle_sql() -> dict[str, str]:
    return {name: using(sql) for name, sql in SQL.items()}
