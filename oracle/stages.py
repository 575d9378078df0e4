"""Check SQL of the queries over whole stages: jobs and files, sketches, schema document, checks with violations."""

from __future__ import annotations

from oracle.ctes import iso, months, rnd, stamp
from subrev.plans.catalog import CLEAN_CHECKED, COPIED, PROBS, RUN_AT, RUN_ID
from subrev.plans.jobs import SOURCE_OF
from subrev.plans.stages import REPORTS
from subrev.specs import REASON_CODES, TABLES
from subrev.operators.validate import is_derived


def union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


# Columns and types of the feature tables, and the table of the check SQL that holds each.
FEATURES = {
    "subscriptions": ("subs_fe", """subscription_id:string account_id:string start_date:date end_date:date start_month:string end_month:string
        subscription_age_days:bigint subscription_age_months:bigint mrr_clean:double arr_clean:double lifetime_mrr:double churned_mrr:double
        is_churned:boolean churn_date:date churn_month:string plan_tier:string seat_bucket:string seats:bigint rev_change_flag:string
        subscription_status:string is_new:boolean is_upgrade:boolean is_downgrade:boolean dirty_row_flag:boolean
        dirty_row_reason:array<string> dirty_row_reason_count:bigint"""),
    "usage_monthly": ("monthly_t", """subscription_id:string usage_month:string usage_count_month:bigint usage_duration_month:double
        unique_features_month:bigint error_count_month:bigint days_in_month:bigint duration_per_use:double usage_intensity:double
        is_heavy_user_month:boolean"""),
    "feature_month": ("fmonth", """subscription_id:string account_id:string feature_name:string usage_month:string usage_count:bigint
        usage_duration_secs:bigint first_use_date:date last_use_date:date error_count:bigint is_beta_feature:boolean
        duration_per_use:double account_feature_rank:bigint"""),
    "first_use": ("fuse", """account_id:string feature_name:string first_use_date:date days_to_adopt:bigint is_beta_feature:boolean
        beta_adopter:boolean signup_date:date dirty_row_flag:boolean dirty_row_reason:array<string>"""),
    "support_events": ("sevents", """ticket_id:string account_id:string submitted_at:timestamp closed_at:timestamp
        resolution_time_hours:double priority:string priority_score:double resolution_bucket:string escalation_flag:boolean
        satisfaction_score:double dirty_row_flag:boolean dirty_row_reason:array<string>"""),
    "support_by_account": ("sacct", """account_id:string ticket_count:bigint escalated_tickets:bigint avg_resolution_hours:double
        avg_satisfaction:double avg_priority_score:double tickets_90_days:bigint"""),
    "accounts": ("acct_fe", """account_id:string account_name:string industry_clean:string country_clean:string signup_date:date
        churn_date:date total_mrr:double total_arr:double avg_mrr:double max_mrr:double lifetime_gross_mrr:double total_churned_mrr:double
        num_subscriptions_lifetime:bigint num_active_subscriptions:bigint num_churns:bigint lifetime_days:bigint total_usage_count:bigint
        avg_monthly_active_features:double ticket_count:bigint tickets_90_days:bigint avg_resolution_hours:double avg_satisfaction:double
        avg_priority_score:double escalated_tickets:bigint escalation_rate:double tickets_per_active_subscription:double usage_score:double
        support_score:double revenue_score:double health_score:double customer_segment:string dirty_row_flag:boolean
        dirty_row_reason:array<string> daily_usage_rate:double"""),
    "cohorts": ("cohorts_t", """subscription_id:string account_id:string month:string mrr:double is_churned_month:boolean
        cohort_month:string months_since_signup:bigint"""),
    "revenue_changes": ("(SELECT * FROM changes_t WHERE change_type <> 'unchanged')", """subscription_id:string account_id:string
        month:string change_type:string change_amount:double mrr:double prev_mrr:double"""),
}
_COLUMNS = {n: [c.split(":") for c in columns.split()] for n, (_, columns) in FEATURES.items()}
_ELSEWHERE = {"dirty_row_flag": "(reasons <> '')", "dirty_row_reason_count": "reason_count",
              "dirty_row_reason": "(CASE WHEN reasons = '' THEN '[]' ELSE '[\"' || replace(reasons, '|', '\",\"') || '\"]' END)"}
_FILLED = ("total_churned_mrr", "num_subscriptions_lifetime", "num_churns")


def _value(table: str, c: str) -> str:
    if table == "support_events" and c == "resolution_time_hours":
        return "h"
    if table == "accounts" and c in _FILLED:
        return f"coalesce({c}, 0)"
    return _ELSEWHERE.get(c, c)


def _doc(n: str, c: str, kind: str) -> str:
    x = _value(n, c)
    null_pct = rnd(f"coalesce(round_even((count(*) - count({x})) * 100 / count(*), 2), 0)")
    sample = "NULL::VARCHAR" if kind == "double" else f"coalesce(CAST(min({x}) AS VARCHAR), 'NULL')"
    number = rnd(f"CAST(min({x}) AS DOUBLE)") if kind == "double" else "NULL::DOUBLE"
    return f"""SELECT '{n}' AS table_name, count(*) AS rows, '{c}' AS column_name, '{kind}' AS dtype, {str(is_derived(c)).lower()} AS synthetic,
  count(*) - count({x}) AS null_count, {null_pct} AS null_pct, {sample} AS sample, {number} AS sample_number FROM {FEATURES[n][0]}"""


def stage_sql(known: dict[str, str]) -> dict[str, str]:
    """SQL by query; ``known`` is the check SQL of the other queries."""
    out: dict[str, str] = {}

    def rows(query: str) -> str:
        return f"(SELECT count(*) FROM ({known[query]}))"

    def count(table: str) -> str:
        return f"(SELECT count(*) FROM {table})"

    def flagged(table: str) -> str:
        return f"(SELECT count(*) FROM {table} WHERE reasons <> '')"

    def summary(lines: list[tuple[str, str, str, str]]) -> str:
        return union([f"""SELECT '{RUN_ID}' AS run_id, '{RUN_AT}' AS run_at, '{artifact}' AS artifact, {given}::BIGINT AS rows_in,
  {n}::BIGINT AS rows_out, {bad}::BIGINT AS rows_flagged""" for artifact, given, n, bad in lines])

    none = "NULL"
    lines = []
    for t in TABLES:
        raw, clean, bad = count(f"raw_{t}"), count(f"c_{t}"), flagged(f"c_{t}")
        lines += [(f"raw/{t}", none, raw, none), (f"annotated/{t}", raw, clean, bad), (f"clean/{t}", raw, clean, bad)]
    curated = str(sum(len(s.curated) for s in TABLES.values()))
    out["clean_run_summary"] = summary([
        *lines, ("annotated/subscriptions_unique", none, count("one_subscriptions"), "0"), ("annotated/prices", none, count("seat_price"), none),
        ("logs/corrections_log", none, count("corrections_t"), none), ("logs/validation_summary_long", none, str(7 * len(TABLES)), none),
        ("logs/dirty_reason_lookup", none, str(len(REASON_CODES)), none), ("quality/data_quality_summary", none, str(len(TABLES)), none),
        ("quality/data_quality_long_curated", none, curated, none), ("quality/data_quality_col_profile_curated", none, curated, none),
        ("quality/data_quality_errors_curated", none, rows("dq_errors"), none), ("quality/validation_by_table", none, str(len(TABLES)), none),
        ("quality/dq_validation_summary_by_table", none, str(len(TABLES)), none), ("quality/dq_validation_summary_totals", none, "1", none)])
    tables = [(n, count(f"c_{SOURCE_OF[n]}"), count(t), flagged(t) if any(c == "dirty_row_flag" for c, _ in _COLUMNS[n]) else none)
              for n, (t, _) in FEATURES.items()]
    out["feature_run_summary"] = summary([
        *tables, ("usage_monthly_base", none, count("monthly_t"), none), ("accounts_base", none, count("acct_fe"), flagged("acct_fe")),
        ("_diagnostics/validation_checks", none, "6", none), ("_diagnostics/verdict", none, "1", none),
        ("_diagnostics/row_counts", none, str(len(FEATURES)), none), ("_diagnostics/missingness", none, rows("missingness"), none),
        ("_diagnostics/constant_columns", none, rows("constant_columns"), none),
        ("_diagnostics/schema", none, str(sum(len(c) for c in _COLUMNS.values())), none), ("_diagnostics/deep_validation", none, "6", none)])
    out["report_run_summary"] = summary([(n, none, rows(n), none) for n in REPORTS])
    out["report_files"] = union([f"SELECT '{n}' AS report, {rows(n)} AS rows" for n in REPORTS])
    out["clean_files"] = union([f"SELECT '{n}' AS table_name, count(*) AS rows, '{c}' AS column_name, count({c}) AS filled FROM c_{n}"
                                for n, s in TABLES.items() for c in s.columns if c in CLEAN_CHECKED])
    out["clean_csv"] = union([f"""SELECT '{n}' AS table_name, count(*) AS rows, count({s.pk}) AS keys, count(*) FILTER (reasons <> '') AS flagged,
  sum(CASE WHEN reasons = '' THEN 0 ELSE len(string_split(reasons, '|')) END)::BIGINT AS reasons FROM c_{n}""" for n, s in TABLES.items()])
    out["subscription_features_csv"] = known["subscription_features"]
    out["reason_lookup"] = f"SELECT reason, sum(rows)::BIGINT AS rows, true AS described FROM ({known['dirty_reasons']}) GROUP BY 1"
    out["load_numeric_ids"] = f"""SELECT n::VARCHAR AS ticket_id, CASE WHEN n % 10 <> 0 THEN account_id END AS account_id,
  strftime({stamp('submitted_at')}, '%Y-%m-%d %H:%M:%S') AS submitted_at
FROM (SELECT *, CAST(regexp_replace(ticket_id, '[^0-9]', '', 'g') AS BIGINT) AS n FROM c_support_tickets)"""
    out["support_events_by_subscription"] = """SELECT ticket_id, s.account_id, resolution_bucket, e.reasons AS dirty_row_reason
FROM sevents e LEFT JOIN subs_fe s ON s.subscription_id = 'S-' || regexp_replace(ticket_id, '[^0-9]', '', 'g')"""

    out["fault_sample_one_row"] = "SELECT account_id, account_name, industry, country, churn_flag FROM clean_customers ORDER BY greatest(k * 7919 % 1000, 100), account_id LIMIT 1"
    out["support_hours_per_row"] = f"""SELECT ticket_id, {rnd('x')} AS resolution_time_hours,
  CASE WHEN x IS NULL THEN 'unknown' WHEN x < 24 THEN '<24h' WHEN x < 72 THEN '24-72h' ELSE '>72h' END AS resolution_bucket
FROM (SELECT ticket_id, abs(CASE WHEN CAST(regexp_replace(ticket_id, '[^0-9]', '', 'g') AS BIGINT) % 3 <> 0 AND h IS NOT NULL THEN h
  ELSE date_diff('second', submitted_at, closed_at) / 3600.0 END) AS x FROM sevents)"""

    def exact(report: str, keys: list[str], n: str) -> str:
        key = " || '|' || ".join(f"coalesce(CAST({k} AS VARCHAR), '-')" for k in keys)
        return f"SELECT '{report}' AS report, {key} AS group_key, CAST({n} AS BIGINT) AS exact, true AS close FROM ({known[report]})"

    out["distinct_estimates"] = union([
        exact("feature_adoption", ["feature_name"], "accounts_used"), exact("cohort_retention", ["cohort_month", "months_since_signup"], "active_subs"),
        exact("cohort_churn_lifecycle", ["months_since_signup"], "churned_subs"), exact("support_segment_stats", ["customer_segment"], "active_accounts")])
    out["quantile_estimates"] = union([
        f"""SELECT '{measure}' AS measure, {rnd(str(p))} AS p, count({x}) AS n, {rnd(f'quantile_cont(CAST({x} AS DOUBLE), {p})')} AS exact, true AS close
FROM {table}""" for measure, table, x in (("mrr_clean", "subs_fe", "mrr_clean"), ("usage_count_month", "monthly_t", "usage_count_month"),
                                          ("resolution_time_hours", "sevents", "h")) for p in PROBS])
    out["schema_doc"] = union([_doc(n, c, kind) for n, columns in _COLUMNS.items() for c, kind in columns])
    numbers = [c for c, kind in _COLUMNS["subscriptions"] if kind in ("bigint", "double")]
    out["constant_columns_by_churn"] = union([
        f"""SELECT '{name}' AS table_name, '{c}' AS column_name FROM subs_fe WHERE {cond} HAVING count(DISTINCT {_value('subscriptions', c)}) <= 1 AND count(*) > 0"""
        for name, cond in (("active", "NOT is_churned"), ("churned", "is_churned")) for c in numbers])
    out["active_with_churn_date_native"] = f"SELECT subscription_id, {iso('churn_date')} AS churn_date FROM f_subscriptions WHERE NOT gone AND churn_date IS NOT NULL"
    out["negative_months_after_end"] = f"""SELECT * FROM (SELECT subscription_id, {months('end_date', 'churn_date')} AS months_since_signup FROM subs_fe
WHERE churn_date IS NOT NULL AND end_date IS NOT NULL) WHERE months_since_signup < 0"""
    for n, s in TABLES.items():
        if n != "feature_usage":
            out[f"dedupe_keep_most_complete_{n}"] = f"SELECT {', '.join(s.columns)} FROM one_{n}"
    out["dedupe_dropped_log"] = union([f"""SELECT '{n}' AS table_name, {s.pk} AS key, count(*) - 1 AS rows_dropped FROM raw_{n}
GROUP BY {s.pk} HAVING count(*) > 1""" for n, s in TABLES.items()])
    out["identical_by_key"] = union([f"""SELECT '{n}' AS table_name, copies, count(*) AS groups FROM (SELECT count(*) AS copies,
  count(DISTINCT {" || '|' || ".join(f"coalesce({c}, '~')" for c in COPIED[n])}) AS kinds FROM raw_{n} GROUP BY {s.pk})
WHERE copies > 1 AND kinds = 1 GROUP BY copies""" for n, s in TABLES.items()])
    out["post_clean_duplicates"] = union([f"""SELECT '{n}' AS table_name, copies, count(*) AS groups FROM (SELECT count(*) AS copies FROM c_{n}
  GROUP BY {', '.join(s.clean_columns)} HAVING count(*) > 1) GROUP BY copies""" for n, s in TABLES.items()])
    out["post_clean_flags"] = union([f"""SELECT '{n}' AS table_name, {s.pk} AS key, concat_ws('|', nullif(reasons, ''),
  CASE WHEN count(*) OVER (PARTITION BY {', '.join(s.clean_columns)}) > 1 THEN 'duplicate_after_cleaning_detected' END) AS dirty_row_reason
FROM c_{n}""" for n, s in TABLES.items()])
    return out
