"""Common table expressions of the check SQL: raw entities, clean tables, feature tables.

Written from the rules, in the most direct form (windows, built-in quantiles,
one row per month), not from the Spark plans.
"""

from __future__ import annotations

import re

from subrev.specs import TABLES

AS_OF = "DATE '2002-01-01'"
CTES: dict[str, str] = {}


# ------------------------------------------------------------------- snippets
def rnd(x: str) -> str:
    return f"floor(({x}) * 10000 + 0.501) / 10000"


def norm(c: str) -> str:
    return f"CASE WHEN lower(trim({c})) NOT IN ('', 'nan', 'none', 'null') THEN trim({c}) END"


def blank(c: str) -> str:
    return f"({c} IS NULL OR trim(CAST({c} AS VARCHAR)) = '')"


def yes(c: str) -> str:
    return f"coalesce(lower(trim({c})) IN ('true', '1', 'yes'), false)"


def num(c: str) -> str:
    return f"TRY_CAST(regexp_replace(replace({c}, '(', '-'), '[^0-9.\\-]', '', 'g') AS DOUBLE)"


def strict(c: str) -> str:
    return f"TRY_CAST(trim(CAST({c} AS VARCHAR)) AS DOUBLE)"


def looks(c: str) -> str:
    return f"coalesce(regexp_full_match(trim(CAST({c} AS VARCHAR)), '[0-9]{{2}}-[0-9]{{2}}-[0-9]{{4}}'), false)"


def day(c: str) -> str:
    return f"CASE WHEN {looks(c)} THEN CAST(try_strptime(trim({c}), '%d-%m-%Y') AS DATE) END"


def loose_day(c: str) -> str:
    return (f"CAST(coalesce(try_strptime(trim({c}), '%d-%m-%Y'), try_strptime(trim({c}), '%Y-%m-%d')) AS DATE)")


def stamp(c: str) -> str:
    forms = ("%d-%m-%Y %H:%M:%S", "%d-%m-%Y", "%Y-%m-%d %H:%M:%S", "%Y-%m-%d")
    return "coalesce(" + ", ".join(f"try_strptime(trim({c}), '{f}')" for f in forms) + ")"


def months(a: str, b: str) -> str:
    return f"CAST((year({b}) - year({a})) * 12 + month({b}) - month({a}) AS BIGINT)"


def iso(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%d')"


def dmy(c: str) -> str:
    return f"strftime({c}, '%d-%m-%Y')"


def ym(c: str) -> str:
    return f"strftime({c}, '%Y-%m')"


def words(*rules: tuple[str, str]) -> str:
    return "concat_ws('|', " + ", ".join(f"CASE WHEN {cond} THEN '{code}' END" for cond, code in rules) + ")"


def score(table: str) -> str:
    return " + ".join(f"CAST({c} IS NOT NULL AS INTEGER)" for c in TABLES[table].columns)


def cents(x: str) -> str:
    return f"(({x}) // 100)::VARCHAR || '.' || lpad((({x}) % 100)::VARCHAR, 2, '0')"


def tf(cond: str) -> str:
    return f"CASE WHEN {cond} THEN 'True' ELSE 'False' END"


def with_(*names: str) -> str:
    """WITH clause of the named expressions and everything they use."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for m in CTES:
            if m != n and re.search(rf"\b{m}\b", CTES[n]):
                visit(m)
        order.append(n)

    for n in names:
        visit(n)
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n]})" for n in order) + "\n"


def using(sql: str) -> str:
    """The query with the WITH clause its tables need."""
    names = [n for n in CTES if re.search(rf"\b{n}\b", sql)]
    return with_(*names) + sql if names else sql


# --------------------------------------------------------------- raw entities
CTES["raw_accounts"] = f"""
SELECT 'A-' || c_custkey AS account_id, c_name AS account_name,
  CASE WHEN c_custkey % 10 <> 3 THEN c_mktsegment END AS industry,
  CASE WHEN c_custkey % 7 <> 0 THEN n_name END AS country, {dmy('first_order')} AS signup_date,
  'region_' || n_regionkey AS referral_source,
  CASE WHEN c_acctbal < 0 THEN NULL WHEN c_acctbal < 3000 THEN 'Basic' WHEN c_acctbal < 7000 THEN 'Pro'
       ELSE 'Enterprise' END AS plan_tier,
  CAST(c_custkey % 60 + 1 AS VARCHAR) AS seats, {tf('c_acctbal < 0')} AS is_trial, {tf('c_custkey % 4 = 0')} AS churn_flag
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN (SELECT o_custkey, min(o_orderdate) AS first_order FROM orders GROUP BY 1) ON o_custkey = c_custkey
UNION ALL
SELECT 'E-' || user_id, upper(c_name), NULL, NULL, {dmy('min(ts)')}, 'events', NULL, NULL, 'False', 'False'
FROM events LEFT JOIN customer ON user_id = c_custkey WHERE event_type = 'signup' GROUP BY user_id, c_name
UNION ALL
SELECT 'A-' || user_id, c_name, c_mktsegment, n_name, NULL, NULL, NULL, NULL, NULL, NULL
FROM (SELECT user_id, bool_or(event_type = 'error') AS failed FROM events GROUP BY 1) LEFT JOIN customer ON user_id = c_custkey
  LEFT JOIN nation ON c_nationkey = n_nationkey WHERE failed OR c_custkey IS NULL"""

_SUB = """
SELECT 'S-' || o_orderkey AS subscription_id, 'A-' || o_custkey AS account_id, {start} AS start_date, {end} AS end_date,
  {plan} AS plan_tier,
  CAST(CASE WHEN o_orderpriority IN ('1-URGENT', '5-LOW') AND o_orderkey % 10 < 2 THEN o_orderkey % 10 + 100
       ELSE o_orderkey % 60 + 1 END AS VARCHAR) AS seats,
  {mrr} AS mrr_amount, {arr} AS arr_amount, {trial} AS is_trial, {up} AS upgrade_flag, {down} AS downgrade_flag,
  {gone} AS churn_flag, CASE WHEN o_orderkey % 3 = 0 THEN 'annual' ELSE 'monthly' END AS billing_frequency,
  {renew} AS auto_renew_flag
FROM orders LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS last_ship, max(l_quantity) AS top_quantity
                       FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey"""
_COMMON = dict(start=dmy("o_orderdate"), trial=tf("o_orderkey % 23 = 0"), up=tf("o_orderkey % 11 = 0"),
               down=tf("o_orderkey % 13 = 0"), gone=tf("o_orderstatus = 'F'"), renew=tf("o_orderkey % 5 <> 0"))
_PRICE = "CAST(floor(o_totalprice) AS BIGINT)"
CTES["raw_subscriptions"] = _SUB.format(
    end=f"CASE WHEN o_orderstatus = 'F' THEN {dmy('last_ship')} END",
    plan="""CASE o_orderpriority WHEN '1-URGENT' THEN 'Enterprise' WHEN '2-HIGH' THEN 'Enterprise'
       WHEN '3-MEDIUM' THEN 'Pro' WHEN '4-NOT SPECIFIED' THEN 'Basic' END""",
    mrr=f"CASE WHEN o_orderkey % 17 <> 0 THEN CASE WHEN o_orderkey % 46 = 0 THEN '0' ELSE {cents(_PRICE)} END END",
    arr=f"CASE WHEN o_orderkey % 19 <> 0 THEN CASE WHEN o_orderkey % 46 = 0 THEN '0' ELSE {cents(_PRICE + ' * 12')} END END",
    **_COMMON) + "\nUNION ALL" + _SUB.format(end="NULL", plan="NULL", mrr="NULL", arr="NULL", **_COMMON) + " WHERE top_quantity = 50"

CTES["raw_feature_usage"] = f"""
SELECT 'U-' || l_orderkey || '-' || l_linenumber AS usage_id,
  CASE WHEN l_tax = 0 AND l_discount = 0 THEN 'X-' ELSE 'S-' END || l_orderkey AS subscription_id,
  CASE WHEN l_suppkey % 37 = 0 THEN {iso('l_shipdate')} ELSE {dmy('l_shipdate')} END AS usage_date,
  CASE WHEN l_partkey % 29 <> 0 THEN p_brand END AS feature_name,
  CAST(CASE WHEN l_partkey % 31 = 0 THEN -1 ELSE 1 END * CAST(l_quantity AS BIGINT) AS VARCHAR) AS usage_count,
  CAST(CASE WHEN l_suppkey % 41 = 0 THEN -1 ELSE 1 END * CAST(floor(l_extendedprice) AS BIGINT) AS VARCHAR)
    AS usage_duration_secs,
  CASE WHEN l_returnflag = 'R' THEN '1' ELSE '0' END AS error_count, {tf('p_size <= 5')} AS is_beta_feature
FROM lineitem LEFT JOIN part ON l_partkey = p_partkey"""

_TICKET = """
SELECT 'T-' || event_id AS ticket_id, 'A-' || user_id AS account_id,
  CASE WHEN event_id % 53 <> 0 THEN strftime(ts, '%d-%m-%Y %H:%M:%S') END AS submitted_at,
  CASE WHEN event_type <> 'view' THEN strftime(date_trunc('second', ts) + to_seconds(CAST(floor(value * 3600) AS BIGINT)),
       '%d-%m-%Y %H:%M:%S') END AS closed_at,
  CASE WHEN event_id % 37 = 0 THEN '-' ELSE '' END || {hours} AS resolution_time_hours, {priority} AS priority,
  CAST(event_id % 240 AS VARCHAR) AS first_response_time_minutes, {rating} AS satisfaction_score,
  {esc} AS escalation_flag
FROM events"""
_HOURS = cents("CAST(round(value * 100) AS BIGINT)")
CTES["raw_support_tickets"] = _TICKET.format(
    hours=_HOURS, esc=tf("event_type = 'error'"),
    priority="""CASE event_id % 5 WHEN 0 THEN 'high' WHEN 1 THEN 'medium' WHEN 2 THEN 'low' WHEN 3 THEN 'urgent' END""",
    rating="CASE WHEN event_id % 6 <> 0 THEN CAST(event_id % 6 AS VARCHAR) END") + "\nUNION ALL" + _TICKET.format(
    hours=_HOURS, esc=tf("event_type = 'error'"), priority="NULL", rating="NULL") + " WHERE value < 1"

_CHURN = """
SELECT 'C-' || o_orderkey AS churn_event_id, 'A-' || o_custkey AS account_id,
  CASE WHEN o_orderstatus = 'F' AND c_acctbal < 2500 THEN
       CASE WHEN c_nationkey = 24 THEN strftime(CAST(o_orderdate AS DATE) + 30, '%Y-%m-%d')
            ELSE strftime(CAST(o_orderdate AS DATE) + 30, '%d-%m-%Y') END END AS churn_date,
  {reason} AS reason_code,
  CASE WHEN c_nationkey = 7 THEN 'pending'
       WHEN c_acctbal < 0 AND c_mktsegment = 'BUILDING' THEN '(' || format('{{:,.2f}}', -c_acctbal) || ')'
       ELSE format('{{:,.2f}}', c_acctbal) END AS refund_amount_usd,
  {up} AS preceding_upgrade_flag, {down} AS preceding_downgrade_flag, 'False' AS is_reactivation,
  {text} AS feedback_text
FROM orders LEFT JOIN customer ON o_custkey = c_custkey"""
CTES["raw_churn_events"] = _CHURN.format(
    reason="""CASE o_orderpriority WHEN '1-URGENT' THEN 'pricing' WHEN '2-HIGH' THEN 'support'
       WHEN '3-MEDIUM' THEN 'features' WHEN '5-LOW' THEN 'budget' END""",
    text="CASE WHEN c_mktsegment <> 'FURNITURE' THEN lower(c_mktsegment) || ' feedback' END",
    up=_COMMON["up"], down=_COMMON["down"]) + "\nUNION ALL" + _CHURN.format(
    reason="NULL", text="NULL", up=_COMMON["up"], down=_COMMON["down"]) + " WHERE o_totalprice < 50000"

for _t, _spec in TABLES.items():
    _ties = ", ".join(f"{c} ASC NULLS FIRST" for c in _spec.columns)
    CTES[f"one_{_t}"] = f"""
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {_spec.pk} ORDER BY {score(_t)} DESC, {_ties}) AS rn
  FROM raw_{_t}) WHERE rn = 1"""

# ---------------------------------------------------------------- clean tables
CTES["c_churn_events"] = f"""
SELECT *, {words((norm('churn_event_id') + ' IS NULL', 'blank_pk'), ('signed < 0', 'negative_refund_amount_usd'),
                 ('signed IS NULL AND NOT ' + blank('refund_amount_usd'), 'invalid_numeric_parsed'),
                 (blank('reason_code'), 'blank_reason_code'), (blank('feedback_text'), 'blank_feedback_text'))} AS reasons
FROM (SELECT *, {num('refund_amount_usd')} AS signed, abs({num('refund_amount_usd')}) AS refund_amount_clean,
        {norm('account_id')} AS account_id_norm, {norm('churn_event_id')} AS churn_event_id_norm FROM one_churn_events)"""
CTES["churn_map"] = f"""
SELECT account_id_norm, max(d) AS churn_day, coalesce({dmy('max(d)')}, arg_min(churn_date, churn_event_id)) AS churn_text
FROM (SELECT *, {day('churn_date')} AS d FROM c_churn_events)
WHERE account_id_norm IS NOT NULL AND NOT {blank('churn_date')} GROUP BY 1"""

_ACC_TIES = ", ".join(f"{c} ASC NULLS FIRST" for c in TABLES["accounts"].columns)


def _first(key: str, col: str) -> str:
    return f"""(SELECT k, {col} AS v FROM (SELECT {key} AS k, {col}, row_number() OVER (PARTITION BY {key} ORDER BY {_ACC_TIES}) AS r
      FROM raw_accounts WHERE NOT {blank(col)} AND {key} IS NOT NULL) WHERE r = 1)"""


_ID = norm("account_id")
CTES["c_accounts"] = f"""
SELECT a.* EXCLUDE (n), m.account_id_norm IS NOT NULL AS churn_flag_clean, m.churn_text AS account_churn_date_clean,
  {words(('a.n IS NULL', 'blank_pk'), (blank('country'), 'country_imputed'), (blank('industry'), 'industry_imputed'),
         ('m.account_id_norm IS NOT NULL AND NOT ' + yes('churn_flag'), 'native_churn_flag_false_but_event_exists'),
         ('m.account_id_norm IS NULL AND ' + yes('churn_flag'), 'native_churn_flag_true_but_no_event'))} AS reasons,
  a.n AS account_id_norm
FROM (SELECT o.*, {_ID} AS n,
        CASE WHEN NOT {blank('country')} THEN country ELSE coalesce(ci.v, cn.v, 'Unknown') END AS country_clean,
        CASE WHEN NOT {blank('industry')} THEN industry ELSE coalesce(ii.v, iname.v, 'Unknown') END AS industry_clean
      FROM one_accounts o
      LEFT JOIN {_first(_ID, 'country')} ci ON ci.k = {_ID}
      LEFT JOIN {_first('lower(account_name)', 'country')} cn ON cn.k = lower(account_name)
      LEFT JOIN {_first(_ID, 'industry')} ii ON ii.k = {_ID}
      LEFT JOIN {_first('lower(account_name)', 'industry')} iname ON iname.k = lower(account_name)) a
LEFT JOIN churn_map m ON m.account_id_norm = a.n"""

CTES["priced_t"] = f"""
SELECT subscription_id, m, a, plan, seat FROM (
  SELECT subscription_id, {strict('mrr_amount')} AS m, {strict('arr_amount')} AS a,
    CASE WHEN NOT {blank('plan_tier')} THEN trim(plan_tier) END AS plan,
    CASE WHEN NOT {blank('seats')} THEN trim(seats) END AS seat FROM one_subscriptions) WHERE m > 0 AND a > 0"""
CTES["price_plan"] = """
SELECT m, a, arg_max(plan, subscription_id) AS plan FROM priced_t WHERE plan IS NOT NULL GROUP BY 1, 2"""
CTES["seat_price"] = """
SELECT seat, plan, arg_max(m, subscription_id) AS m, arg_max(a, subscription_id) AS a FROM priced_t
WHERE plan IS NOT NULL AND seat IS NOT NULL GROUP BY 1, 2"""
CTES["seat_plan"] = "SELECT seat, min(plan) AS plan FROM seat_price GROUP BY 1 HAVING count(DISTINCT plan) = 1"
CTES["subs_ends"] = f"""
SELECT s.*, {norm('s.account_id')} AS account_id_norm, {norm('subscription_id')} AS subscription_id_norm,
  {yes('s.is_trial')} AS trial, abs({num('mrr_amount')}) AS m, abs({num('arr_amount')}) AS a,
  CASE WHEN NOT {blank('seats')} THEN trim(s.seats) END AS seat,
  coalesce({blank('end_date')} AND {day('c.account_churn_date_clean')} >= {day('start_date')}, false) AS derived,
  c.account_churn_date_clean AS churn_text, {day('start_date')} AS sd
FROM one_subscriptions s LEFT JOIN (SELECT account_id_norm AS k, account_churn_date_clean FROM c_accounts) c
  ON c.k = {norm('s.account_id')}"""
CTES["subs_plans"] = f"""
SELECT e.*, CASE WHEN derived THEN churn_text WHEN capped THEN {dmy('sd + 30')} ELSE end_date END AS end_filled,
  CASE WHEN NOT {blank('plan_tier')} THEN plan_tier WHEN trial THEN 'Trial'
       ELSE coalesce(p.plan, q.plan, 'Unknown') END AS plan_tier_imputed
FROM (SELECT *, coalesce({blank('end_date')} AND NOT derived AND trial AND coalesce(m, 0) = 0 AND sd + 30 < {AS_OF}, false)
        AS capped FROM subs_ends) e
LEFT JOIN price_plan p ON p.m = e.m AND p.a = e.a LEFT JOIN seat_plan q ON q.seat = e.seat"""
CTES["subs_prices"] = """
SELECT s.*, x.seat IS NOT NULL AND NOT trial AS sold,
  CASE WHEN trial THEN 0 WHEN x.seat IS NOT NULL THEN x.m WHEN coalesce(s.m, 0) = 0 AND coalesce(s.a, 0) <> 0 THEN s.a / 12
       WHEN s.m IS NULL AND s.a = 0 THEN 0 ELSE s.m END AS mrr_amount_clean,
  CASE WHEN trial THEN 0 WHEN x.seat IS NOT NULL THEN x.a WHEN coalesce(s.a, 0) = 0 AND coalesce(s.m, 0) <> 0 THEN s.m * 12
       WHEN s.a IS NULL AND s.m = 0 THEN 0 ELSE s.a END AS arr_amount_clean
FROM subs_plans s LEFT JOIN seat_price x ON x.seat = s.seat AND x.plan = trim(s.plan_tier_imputed)"""
CTES["c_subscriptions"] = f"""
SELECT * EXCLUDE (start_date, gap, swap), CASE WHEN swap THEN end_filled ELSE start_date END AS start_date,
  CASE WHEN swap THEN start_date ELSE end_filled END AS end_date_clean,
  {words(('subscription_id_norm IS NULL', 'blank_pk'), ('derived', 'end_date_derived'), ('capped', 'trial_capped_at_30_days'),
         ('trial AND ' + blank('plan_tier'), 'trial_tier_set_to_trial'),
         ('NOT trial AND ' + blank('plan_tier'), 'plan_tier_imputed_from_lookup'),
         ('sold', 'mrr_arr_imputed_from_lookup'), ('swap', 'start_end_swapped_due_to_small_gap'),
         ('gap >= 30', 'start_after_end_flagged'))} AS reasons
FROM (SELECT *, gap BETWEEN 1 AND 29 AS swap FROM (
  SELECT *, coalesce({day('start_date')} - {day('end_filled')}, 0) AS gap FROM subs_prices))"""

CTES["c_feature_usage"] = f"""
SELECT * EXCLUDE (known, cnt, secs), NOT known AS orphan, CASE WHEN known THEN abs(cnt) END AS usage_count_clean,
  CASE WHEN known THEN abs(secs) END AS usage_duration_secs_clean,
  CASE WHEN known AND {blank('feature_name')} THEN 'Unknown' ELSE feature_name END AS feature_name_imputed,
  {words(('usage_id_norm IS NULL', 'blank_pk'), ('NOT known', 'orphan_usage'),
         ('known AND ' + blank('feature_name'), 'feature_name_imputed'), ('known AND cnt < 0', 'negative_usage_count'),
         ('known AND secs < 0', 'negative_usage_duration'),
         ('known AND NOT ' + blank('usage_date') + ' AND NOT ' + looks('usage_date'), 'invalid_date_format'))} AS reasons
FROM (SELECT u.*, {norm('usage_id')} AS usage_id_norm, {norm('u.subscription_id')} AS subscription_id_norm,
        {norm('u.subscription_id')} IN (SELECT subscription_id_norm FROM c_subscriptions) AS known,
        {num('usage_count')} AS cnt, {num('usage_duration_secs')} AS secs FROM one_feature_usage u)"""
CTES["c_support_tickets"] = f"""
SELECT *, abs(signed) AS resolution_hours_clean,
  CASE WHEN {blank('satisfaction_score')} THEN 'Unknown' ELSE satisfaction_score END AS satisfaction_imputed,
  {words(('ticket_id_norm IS NULL', 'blank_pk'), ('signed < 0', 'negative_resolution_time'),
         (blank('priority'), 'priority_missing_flagged'), (blank('satisfaction_score'), 'satisfaction_imputed'))} AS reasons
FROM (SELECT *, {norm('ticket_id')} AS ticket_id_norm, {num('resolution_time_hours')} AS signed FROM one_support_tickets)"""

# -------------------------------------------------------------- feature tables
CTES["f_accounts"] = f"""
SELECT account_id, account_name, industry_clean, country_clean, {loose_day('signup_date')} AS signup_date,
  {loose_day('account_churn_date_clean')} AS churn_date, reasons FROM c_accounts"""
CTES["f_events"] = f"SELECT churn_event_id, account_id, {loose_day('churn_date')} AS churn_date FROM c_churn_events"
CTES["f_subscriptions"] = f"""
SELECT s.subscription_id, s.account_id, {loose_day('start_date')} AS start_date, {loose_day('end_date_clean')} AS end_date,
  plan_tier, plan_tier_imputed, seats, mrr_amount_clean, arr_amount_clean, is_trial, {yes('upgrade_flag')} AS up,
  {yes('downgrade_flag')} AS down, {yes('s.churn_flag')} AS gone, s.reasons, a.churn_date
FROM c_subscriptions s LEFT JOIN f_accounts a ON a.account_id = s.account_id"""
CTES["subs_fe"] = f"""
SELECT subscription_id, account_id, start_date, end_date, {ym('start_date')} AS start_month, {ym('end_date')} AS end_month,
  greatest(0, coalesce(end_date, {AS_OF}) - start_date) AS subscription_age_days,
  greatest(0, {months('start_date', f'coalesce(end_date, {AS_OF})')}) AS subscription_age_months,
  mrr AS mrr_clean, coalesce(arr_amount_clean, round(mrr * 12, 2)) AS arr_clean,
  round(mrr * coalesce(greatest(0, {months('start_date', f'coalesce(end_date, {AS_OF})')}), 0), 2) AS lifetime_mrr,
  CASE WHEN churned THEN mrr ELSE 0 END AS churned_mrr, churned AS is_churned, churn_date,
  {ym('churn_date')} AS churn_month, plan AS plan_tier,
  CASE WHEN seat_n IS NULL THEN 'unknown' WHEN seat_n <= 10 THEN '01_to_10' WHEN seat_n <= 25 THEN '11_to_25'
       WHEN seat_n <= 50 THEN '26_to_50' ELSE '50+' END AS seat_bucket, CAST(seat_n AS BIGINT) AS seats,
  CASE WHEN up THEN 'expansion' WHEN down THEN 'contraction' ELSE 'unchanged' END AS rev_change_flag,
  CASE WHEN churned THEN 'churned' WHEN lower(trim(is_trial)) NOT IN ('false', '0', 'nan', 'none', 'null', '') THEN 'trial'
       WHEN end_date IS NOT NULL THEN 'closed' ELSE 'active' END AS subscription_status,
  coalesce(account_id IS NOT NULL AND start_date = min(start_date) OVER (PARTITION BY account_id), false) AS is_new,
  up AS is_upgrade, down AS is_downgrade, reasons,
  CASE WHEN reasons = '' THEN 0 ELSE len(string_split(reasons, '|')) END AS reason_count
FROM (SELECT s.* EXCLUDE (churn_date), coalesce(s.churn_date, e.d) AS churn_date, coalesce(mrr_amount_clean, 0) AS mrr,
        gone OR coalesce(s.churn_date, e.d) IS NOT NULL AS churned,
        CASE WHEN NOT {blank('plan_tier_imputed')} THEN plan_tier_imputed WHEN NOT {blank('plan_tier')} THEN plan_tier END AS plan,
        {strict('seats')} AS seat_n
      FROM f_subscriptions s
      LEFT JOIN (SELECT account_id AS k, arg_min(churn_date, churn_event_id) AS d FROM f_events WHERE account_id IS NOT NULL GROUP BY 1) e
        ON e.k = s.account_id)"""
CTES["f_usage"] = f"""
SELECT usage_id, u.subscription_id, s.account_id, {loose_day('usage_date')} AS usage_date,
  {ym(loose_day('usage_date'))} AS usage_month, feature_name_imputed AS feature_name,
  CAST(usage_count_clean AS BIGINT) AS usage_count, CAST(usage_duration_secs_clean AS BIGINT) AS secs,
  CAST(error_count AS BIGINT) AS errors, {yes('is_beta_feature')} AS beta
FROM c_feature_usage u LEFT JOIN subs_fe s ON s.subscription_id = u.subscription_id"""
CTES["monthly_t"] = """
SELECT *, usage_duration_month / nullif(usage_count_month, 0) AS duration_per_use,
  usage_count_month / nullif(days_in_month, 0) AS usage_intensity,
  usage_count_month > (median(usage_count_month) OVER ()) AS is_heavy_user_month
FROM (SELECT subscription_id, usage_month, CAST(coalesce(sum(usage_count), 0) AS BIGINT) AS usage_count_month,
  CAST(coalesce(sum(secs), 0) AS DOUBLE) AS usage_duration_month, count(DISTINCT feature_name) AS unique_features_month,
  CAST(coalesce(sum(errors), 0) AS BIGINT) AS error_count_month,
  coalesce(max(day(last_day(usage_date))), 0) AS days_in_month FROM f_usage GROUP BY 1, 2)"""
CTES["fmonth"] = """
SELECT *, CASE WHEN usage_count > 0 THEN usage_duration_secs / usage_count END AS duration_per_use,
  dense_rank() OVER (PARTITION BY account_id, usage_month ORDER BY usage_count DESC) AS account_feature_rank
FROM (SELECT subscription_id, account_id, feature_name, usage_month, CAST(coalesce(sum(usage_count), 0) AS BIGINT) AS usage_count,
  CAST(coalesce(sum(secs), 0) AS BIGINT) AS usage_duration_secs, min(usage_date) AS first_use_date,
  max(usage_date) AS last_use_date, CAST(coalesce(sum(errors), 0) AS BIGINT) AS error_count, bool_or(beta) AS is_beta_feature
  FROM f_usage GROUP BY 1, 2, 3, 4)"""
CTES["fuse"] = """
SELECT f.account_id, feature_name, first_use_date, CASE WHEN raw_days IS NOT NULL THEN greatest(0, raw_days) END AS days_to_adopt, is_beta_feature,
  coalesce(is_beta_feature AND raw_days <= 14, false) AS beta_adopter, signup_date,
  CASE WHEN raw_days < 0 THEN 'negative_days_to_adopt_adjusted' ELSE '' END AS reasons
FROM (SELECT f.*, a.signup_date, CASE WHEN a.signup_date IS NOT NULL THEN first_use_date - a.signup_date END AS raw_days
      FROM (SELECT account_id, feature_name, min(usage_date) AS first_use_date,
              coalesce(bool_or(CASE WHEN account_id IS NOT NULL AND feature_name IS NOT NULL THEN beta END), false) AS is_beta_feature
            FROM f_usage GROUP BY 1, 2) f LEFT JOIN f_accounts a ON a.account_id = f.account_id) f"""
CTES["sevents"] = f"""
SELECT *, CASE WHEN h IS NULL THEN 'unknown' WHEN h < 24 THEN '<24h' WHEN h < 72 THEN '24-72h' ELSE '>72h' END AS resolution_bucket,
  concat_ws('|', nullif(base_reasons, ''), nullif({words(('submitted_at IS NULL', 'missing_submitted_at'),
    ('priority IS NULL', 'missing_priority'), ('satisfaction_score IS NULL', 'missing_satisfaction_score'),
    ('was_negative', 'resolution_time_negative_corrected'))}, '')) AS reasons
FROM (SELECT ticket_id, account_id, {stamp('submitted_at')} AS submitted_at, {stamp('closed_at')} AS closed_at,
  resolution_hours_clean AS h, signed < 0 AS was_negative, CASE WHEN NOT {blank('priority')} THEN priority END AS priority,
  CASE lower(trim(priority)) WHEN 'high' THEN 3.0 WHEN 'medium' THEN 2.0 WHEN 'low' THEN 1.0 END::DOUBLE AS priority_score,
  {yes('escalation_flag')} AS escalation_flag, {strict('satisfaction_score')} AS satisfaction_score, reasons AS base_reasons
  FROM c_support_tickets)"""
CTES["sacct"] = """
SELECT account_id, count(DISTINCT ticket_id) AS ticket_count, count(*) FILTER (escalation_flag) AS escalated_tickets,
  avg(h) AS avg_resolution_hours, avg(satisfaction_score) AS avg_satisfaction, avg(priority_score) AS avg_priority_score,
  count(DISTINCT ticket_id) FILTER (submitted_at >= (SELECT max(submitted_at) FROM sevents) - INTERVAL 90 DAY) AS tickets_90_days
FROM sevents WHERE account_id IS NOT NULL GROUP BY 1"""
CTES["acct_base"] = f"""
SELECT a.*, r.lifetime_gross_mrr, r.num_subscriptions_lifetime, r.num_churns, r.total_churned_mrr,
  coalesce(c.total_mrr, 0) AS total_mrr, coalesce(c.total_arr, 0) AS total_arr, coalesce(c.avg_mrr, 0) AS avg_mrr,
  coalesce(c.max_mrr, 0) AS max_mrr, coalesce(c.n, 0) AS num_active_subscriptions,
  coalesce(t.ticket_count, 0) AS ticket_count, t.escalated_tickets, coalesce(t.avg_resolution_hours, 0) AS avg_resolution_hours,
  coalesce(t.avg_satisfaction, 0) AS avg_satisfaction, coalesce(t.avg_priority_score, 0) AS avg_priority_score,
  coalesce(t.tickets_90_days, 0) AS tickets_90_days, coalesce(u.total, 0) AS total_usage_count,
  coalesce(d.depth, 0) AS avg_monthly_active_features, coalesce({AS_OF} - a.signup_date, 0) AS lifetime_days
FROM f_accounts a
LEFT JOIN (SELECT account_id, sum(mrr_clean) AS lifetime_gross_mrr, count(DISTINCT subscription_id) AS num_subscriptions_lifetime,
             count(*) FILTER (is_churned) AS num_churns, sum(churned_mrr) AS total_churned_mrr FROM subs_fe GROUP BY 1) r
  ON r.account_id = a.account_id
LEFT JOIN (SELECT account_id, sum(mrr_clean) AS total_mrr, sum(arr_clean) AS total_arr, avg(mrr_clean) AS avg_mrr,
             max(mrr_clean) AS max_mrr, count(DISTINCT subscription_id) AS n FROM subs_fe WHERE NOT is_churned GROUP BY 1) c
  ON c.account_id = a.account_id
LEFT JOIN sacct t ON t.account_id = a.account_id
LEFT JOIN (SELECT s.account_id, CAST(sum(usage_count_month) AS BIGINT) AS total FROM monthly_t m JOIN subs_fe s
             ON s.subscription_id = m.subscription_id GROUP BY 1) u ON u.account_id = a.account_id
LEFT JOIN (SELECT account_id, avg(n) AS depth FROM (SELECT account_id, usage_month, count(DISTINCT feature_name) AS n FROM fmonth
             WHERE account_id IS NOT NULL AND usage_month IS NOT NULL GROUP BY 1, 2) GROUP BY 1) d
  ON d.account_id = a.account_id"""
CTES["acct_fe"] = """
SELECT *, 0.7 * usage_score + 0.3 * support_score AS health_score,
  CASE WHEN total_mrr < 2000 THEN 'SMB' WHEN total_mrr < 10000 THEN 'Mid-Market' ELSE 'Enterprise' END AS customer_segment
FROM (SELECT *, coalesce(escalated_tickets / nullif(ticket_count, 0), 0) AS escalation_rate,
  coalesce(ticket_count / nullif(num_active_subscriptions, 0), 0) AS tickets_per_active_subscription,
  least(rate / CASE WHEN q_usage = 0 THEN 1 ELSE q_usage END, 1) AS usage_score,
  1 - least(avg_resolution_hours / CASE WHEN q_hours = 0 THEN 1 ELSE q_hours END, 1) AS support_score,
  least(total_mrr / CASE WHEN q_mrr = 0 THEN 1 ELSE q_mrr END, 1) AS revenue_score, rate AS daily_usage_rate
FROM (SELECT *, total_usage_count / greatest(lifetime_days, 1) AS rate,
        (SELECT quantile_cont(total_usage_count / greatest(lifetime_days, 1), 0.95) FROM acct_base) AS q_usage,
        (SELECT quantile_cont(CAST(avg_resolution_hours AS DOUBLE), 0.95) FROM acct_base) AS q_hours,
        (SELECT quantile_cont(CAST(total_mrr AS DOUBLE), 0.95) FROM acct_base) AS q_mrr FROM acct_base))"""

# ---------------------------------------------------------------------- ledger
CTES["ledger_t"] = f"""
SELECT subscription_id, account_id, m AS month_start, {ym('m')} AS month,
  CASE WHEN m <= coalesce(date_trunc('month', end_date), m) THEN mrr_clean ELSE 0 END AS mrr,
  {ym('start_date')} AS cohort_month, {months('start_date', 'm')} AS months_since_signup
FROM (SELECT *, CAST(unnest(generate_series(CAST(date_trunc('month', start_date) AS TIMESTAMP),
          CAST(date_trunc('month', coalesce(end_date, {AS_OF})) + CASE WHEN end_date IS NULL THEN INTERVAL 0 MONTH ELSE INTERVAL 1 MONTH END
          AS TIMESTAMP), INTERVAL 1 MONTH)) AS DATE) AS m
      FROM subs_fe WHERE date_trunc('month', start_date) <= date_trunc('month', coalesce(end_date, {AS_OF})))"""
CTES["changes_t"] = """
SELECT *, mrr - prev_mrr AS change_amount,
  CASE WHEN abs(mrr - prev_mrr) < 0.01 THEN 'unchanged' WHEN prev_mrr = 0 AND mrr > 0 THEN 'new'
       WHEN prev_mrr > 0 AND mrr = 0 THEN 'churn' WHEN mrr > prev_mrr THEN 'expansion' ELSE 'contraction' END AS change_type
FROM (SELECT *, lag(mrr, 1, 0) OVER (PARTITION BY subscription_id ORDER BY month_start) AS prev_mrr FROM ledger_t)"""
CTES["cohorts_t"] = """
SELECT subscription_id, account_id, month, mrr, change_type = 'churn' AS is_churned_month, cohort_month, months_since_signup
FROM changes_t WHERE NOT (mrr = 0 AND prev_mrr = 0)"""
