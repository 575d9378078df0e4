from conftest import by_key

import pytest
from pyspark.sql import functions as F

from subrev import specs
from subrev.operators import audit, clean, dedupe, impute

AS_OF = "2024-06-01"


def reasons(row):
    return row["dirty_row_reason"]


# ---------------------------------------------------------------------- dedupe
def test_keep_most_complete(spark, make):
    s = specs.CHURN_EVENTS
    df = make(s, {"churn_event_id": "C-1", "reason_code": "b"}, {"churn_event_id": "C-1", "reason_code": "a"},
              {"churn_event_id": "C-2"}, {"churn_event_id": "C-2", "reason_code": "x", "account_id": "A"},
              {"account_id": "A"}, {"account_id": "A", "reason_code": "z"}, {"churn_event_id": "C-3"})
    got = by_key(dedupe.keep_most_complete(df, s.pk), s.pk)
    assert {k: v["reason_code"] for k, v in got.items()} == {"C-1": "a", "C-2": "x", None: "z", "C-3": None}
    drops = {r[0]: r[1] for r in dedupe.dropped_duplicates(df, s.pk).collect()}
    assert drops == {"C-1": 1, "C-2": 1, None: 1}
    counts = dedupe.dedupe_counts(df, s.pk).first()
    assert (counts.rows_in, counts.rows_after_raw_dedupe, counts.duplicates_raw_removed) == (7, 4, 3)


def test_dedupe_reduces_before_the_exchange(spark, make):
    df = dedupe.keep_most_complete(make(specs.CHURN_EVENTS, {"churn_event_id": "C-1"}), "churn_event_id")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.rindex("WindowGroupLimit") > plan.index("Exchange hashpartitioning")


def test_empty_table_counts(spark, make):
    counts = dedupe.dedupe_counts(make(specs.ACCOUNTS), "account_id").first()
    assert tuple(counts) == (0, 0, 0)


def test_identical_rows_by_key_and_by_signature(spark, make):
    df = make(specs.CHURN_EVENTS, {"churn_event_id": "C-1", "reason_code": "r"}, {"churn_event_id": "C-1", "reason_code": "r"},
              {"churn_event_id": "C-2", "reason_code": "r"}, {"churn_event_id": "C-3", "reason_code": "q"})
    assert dedupe.identical_count(df, "churn_event_id", ["reason_code"]).first()[0] == 1
    assert dedupe.identical_count(df, "churn_event_id", ["reason_code"], "signature").first()[0] == 2
    flagged = dedupe.flag_identical(df, "churn_event_id", ["reason_code"])
    assert flagged.where("dirty_row_flag").count() == 2


# --------------------------------------------------------------------- cleaners
def test_clean_churn_events_and_account_map(spark, make):
    s = specs.CHURN_EVENTS
    df = make(s,
              {"churn_event_id": "C-1", "account_id": "A-1", "churn_date": "05-03-2024", "reason_code": "x", "feedback_text": "f",
               "refund_amount_usd": "(12.50)"},
              {"churn_event_id": "C-2", "account_id": "A-1", "churn_date": "06-01-2024", "refund_amount_usd": "abc"},
              {"churn_event_id": "C-3", "account_id": "A-2", "churn_date": "2024-01-06", "refund_amount_usd": ""},
              {"churn_event_id": " ", "account_id": "none", "churn_date": "06-01-2024"},
              {"churn_event_id": "C-4", "account_id": "A-3", "churn_date": "31-02-2024"})
    out = clean.clean_churn_events(df)
    got = by_key(out, "churn_event_id")
    assert got["C-1"]["refund_amount_clean"] == 12.5 and reasons(got["C-1"]) == ["negative_refund_amount_usd"]
    assert reasons(got["C-2"]) == ["invalid_numeric_parsed", "blank_reason_code", "blank_feedback_text"]
    assert reasons(got["C-3"]) == ["blank_reason_code", "blank_feedback_text"]
    assert reasons(got[" "])[0] == "blank_pk" and got[" "]["dirty_row_flag"]
    churned = by_key(clean.account_churn(out), "account_id_norm")
    assert churned["A-1"]["churn_text"] == "05-03-2024"
    assert churned["A-2"]["churn_day"] is None and churned["A-2"]["churn_text"] == "2024-01-06"
    assert churned["A-3"]["churn_text"] == "31-02-2024" and set(churned) == {"A-1", "A-2", "A-3"}
    log = audit.cell_corrections(out, s).collect()
    assert sorted(r.reason_code for r in log if "C-1" in r.primary_key) == ["negative_refund_amount_usd"]
    assert [r.corrected_value for r in log if r.reason_code == "negative_refund_amount_usd"] == ["12.5"]


def accounts_case(make):
    return make(specs.ACCOUNTS,
                {"account_id": "A-1", "account_name": "Acme", "industry": "Tech", "churn_flag": "False", "plan_tier": "Pro"},
                {"account_id": "A-1", "account_name": "Acme", "country": "DE"},
                {"account_id": "A-2", "account_name": "ACME", "churn_flag": "True"},
                {"account_id": "A-3", "churn_flag": "True", "country": "FR", "industry": "Retail"},
                {"account_id": "A-4", "country": ""})


def test_clean_accounts_cascade(spark, make):
    churned = spark.createDataFrame([("A-1", "05-03-2024")], "account_id_norm string, churn_text string")
    got = by_key(clean.clean_accounts(accounts_case(make), churned), "account_id")
    assert got["A-1"]["country_clean"] == "DE" and got["A-1"]["industry_clean"] == "Tech"      # same id
    assert got["A-2"]["country_clean"] == "DE" and got["A-2"]["industry_clean"] == "Tech"      # same name
    assert got["A-4"]["country_clean"] == "Unknown" and got["A-4"]["industry_clean"] == "Unknown"  # null name matches nothing
    assert reasons(got["A-1"]) == ["country_imputed", "native_churn_flag_false_but_event_exists"]
    assert got["A-1"]["churn_flag_clean"] and got["A-1"]["account_churn_date_clean"] == "05-03-2024"
    assert reasons(got["A-3"]) == ["native_churn_flag_true_but_no_event"]
    assert not got["A-4"]["churn_flag_clean"]
    loose = by_key(clean.clean_accounts(accounts_case(make), churned, truthy_text=True), "account_id")
    assert reasons(loose["A-1"]) == ["country_imputed"]
    assert reasons(loose["A-4"])[-1] == "native_churn_flag_true_but_no_event"


def test_impute_mode(spark, make):
    df = make(specs.ACCOUNTS, {"account_id": "A", "country": "US"}, {"account_id": "A", "country": "US"},
              {"account_id": "A", "country": "DE"}, {"account_id": "A"}, {"account_id": "B", "country": "FR"},
              {"account_id": "B", "country": "BR"}, {"account_id": "B"}, {"account_id": "C"})
    out = impute.impute_accounts(df, df, ("country",), strategy="mode").where("country IS NULL")
    assert {r.account_id: r.country_clean for r in out.collect()} == {"A": "US", "B": "BR", "C": "Unknown"}


def sub(i, **kw):
    base = {"subscription_id": f"S-{i}", "account_id": "A-0", "start_date": "01-01-2024", "is_trial": "False"}
    return {**base, **kw}


@pytest.fixture
def subs(spark, make):
    accounts = spark.createDataFrame(
        [("A-1", "10-02-2024"), ("A-2", "10-12-2023"), ("A-0", None)], "account_id_norm string, account_churn_date_clean string")
    raw = make(specs.SUBSCRIPTIONS,
               sub(10, plan_tier="Pro", seats="5", mrr_amount="100", arr_amount="1200"),
               sub(11, plan_tier="Pro", seats="5", mrr_amount="110", arr_amount="1320"),
               sub(12, plan_tier="Basic", seats="5", mrr_amount="50", arr_amount="600"),
               sub(13, plan_tier="Gold", seats="9", mrr_amount="900", arr_amount="10800"),
               sub(20, seats="77", mrr_amount="50", arr_amount="600"),        # plan by price
               sub(21, seats="9"),                                            # plan by seats
               sub(22, seats="5"),                                            # two plans with 5 seats
               sub(23, plan_tier="Pro", seats="5", mrr_amount="1", arr_amount="12"),   # lookup overwrites
               sub(24, plan_tier="Odd", seats="1", mrr_amount="10"),          # arr = 12 * mrr
               sub(25, plan_tier="Odd", seats="1", arr_amount="240"),         # mrr = arr / 12
               sub(26, plan_tier="Odd", seats="1", mrr_amount="0"),
               sub(27, plan_tier="Odd", seats="1"),
               sub(30, account_id="A-1"),                                     # end from churn
               sub(31, account_id="A-2"),                                     # churned before start
               sub(40, is_trial="True", mrr_amount="0"),                      # capped
               sub(41, is_trial="yes", start_date="15-05-2024"),              # too young to cap
               sub(42, is_trial="1", mrr_amount="80"),                        # paid trial
               sub(43, is_trial="True", account_id="A-1", plan_tier="Pro"),   # churn date comes first
               sub(50, start_date="30-01-2024", end_date="01-01-2024"),       # 29 days
               sub(51, start_date="31-01-2024", end_date="01-01-2024"),       # 30 days
               sub(52, start_date="01-02-2024", end_date="01-01-2024"),       # 31 days
               sub(53, start_date="bad", end_date="01-01-2024"))
    return raw, accounts


def test_clean_subscriptions(subs):
    raw, accounts = subs
    got = by_key(clean.clean_subscriptions(raw, accounts, AS_OF), "subscription_id")
    plan = {k: got[f"S-{k}"]["plan_tier_imputed"] for k in (20, 21, 22, 40, 43)}
    assert plan == {20: "Basic", 21: "Gold", 22: "Unknown", 40: "Trial", 43: "Pro"}
    price = {k: (got[f"S-{k}"]["mrr_amount_clean"], got[f"S-{k}"]["arr_amount_clean"]) for k in (10, 21, 23, 24, 25, 26, 27, 42)}
    # Of the prices of 5 seats of Pro the one of the last subscription id (S-23) wins, for S-10 too.
    assert price == {10: (1.0, 12.0), 21: (900.0, 10800.0), 23: (1.0, 12.0), 24: (10.0, 120.0),
                     25: (20.0, 240.0), 26: (0.0, 0.0), 27: (None, None), 42: (0.0, 0.0)}
    ends = {k: got[f"S-{k}"]["end_date_clean"] for k in (30, 31, 40, 41, 42, 43)}
    assert ends == {30: "10-02-2024", 31: None, 40: "31-01-2024", 41: None, 42: None, 43: "10-02-2024"}
    assert reasons(got["S-40"]) == ["trial_capped_at_30_days", "trial_tier_set_to_trial"]
    assert reasons(got["S-30"]) == ["end_date_derived", "plan_tier_imputed_from_lookup"]
    assert (got["S-50"]["start_date"], got["S-50"]["end_date_clean"]) == ("01-01-2024", "30-01-2024")
    assert reasons(got["S-50"])[-1] == "start_end_swapped_due_to_small_gap"
    assert got["S-51"]["start_date"] == "31-01-2024" and reasons(got["S-51"])[-1] == "start_after_end_flagged"
    assert reasons(got["S-52"])[-1] == "start_after_end_flagged"
    assert "start_after_end_flagged" not in reasons(got["S-53"])


def test_only_when_missing_keeps_native_prices(subs):
    raw, accounts = subs
    got = by_key(clean.clean_subscriptions(raw, accounts, AS_OF, only_when_missing=True), "subscription_id")
    assert got["S-10"]["mrr_amount_clean"] == 100.0 and got["S-21"]["mrr_amount_clean"] == 900.0


def test_result_does_not_depend_on_partitions_or_order(subs):
    raw, accounts = subs
    cols = ["subscription_id", "plan_tier_imputed", "mrr_amount_clean", "end_date_clean", "dirty_row_reason"]

    def run(df):
        return sorted(map(str, clean.clean_subscriptions(df, accounts, AS_OF).select(*cols).collect()))

    assert run(raw.coalesce(1)) == run(raw.orderBy(F.rand(3)).repartition(8)) == run(raw.unionByName(raw))


def test_clean_usage(spark, make):
    known = spark.createDataFrame([("S-1",), (None,)], "subscription_id_norm string")
    df = make(specs.FEATURE_USAGE,
              {"usage_id": "U-1", "subscription_id": " S-1", "usage_date": "2024-01-01", "usage_count": "-3", "usage_duration_secs": "-9"},
              {"usage_id": "U-2", "subscription_id": "S-9", "usage_count": "-3"},
              {"usage_id": "U-3", "subscription_id": "S-1", "feature_name": "f", "usage_date": "01-01-2024", "usage_count": "4",
               "usage_duration_secs": "8"},
              {"usage_id": "U-4"})
    got = by_key(clean.clean_feature_usage(df, known), "usage_id")
    assert reasons(got["U-1"]) == ["feature_name_imputed", "negative_usage_count", "negative_usage_duration", "invalid_date_format"]
    assert (got["U-1"]["usage_count_clean"], got["U-1"]["usage_duration_secs_clean"]) == (3.0, 9.0)
    assert reasons(got["U-2"]) == ["orphan_usage"] and got["U-2"]["usage_count_clean"] is None
    assert reasons(got["U-3"]) == [] and not got["U-3"]["dirty_row_flag"]
    assert reasons(got["U-4"]) == ["orphan_usage"]


def test_clean_tickets(spark, make):
    df = make(specs.SUPPORT_TICKETS, {"ticket_id": "T-1", "resolution_time_hours": "-4.5", "priority": "low", "satisfaction_score": "3"},
              {"ticket_id": "T-2", "resolution_time_hours": "x"})
    got = by_key(clean.clean_support_tickets(df), "ticket_id")
    assert got["T-1"]["resolution_hours_clean"] == 4.5 and reasons(got["T-1"]) == ["negative_resolution_time"]
    assert got["T-2"]["satisfaction_imputed"] == "Unknown" and got["T-2"]["resolution_hours_clean"] is None
    assert reasons(got["T-2"]) == ["priority_missing_flagged", "satisfaction_imputed"]


def test_every_emitted_reason_is_described(spark, subs):
    raw, accounts = subs
    codes = {c for r in clean.clean_subscriptions(raw, accounts, AS_OF).collect() for c in r.dirty_row_reason}
    assert codes <= set(specs.REASON_CODES) and len(specs.REASON_CODES) == 31
