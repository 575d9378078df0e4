"""Table specifications: keys, columns, and the fixed registries of the model."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


@dataclass(frozen=True)
class TableSpec:
    """One raw table. Raw columns are all text; ``types`` says what the text means."""

    name: str
    pk: str
    columns: tuple[str, ...]
    types: dict[str, str]
    required: tuple[str, ...]
    optional: tuple[str, ...]
    curated: tuple[str, ...]
    clean_columns: tuple[str, ...] = field(default=())

    @property
    def raw_schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, T.StringType()) for c in self.columns])

    def kind(self, column: str) -> str:
        """Declared type of a column, with the name classifier as fallback."""
        base = strip_suffix(column)
        return self.types.get(column) or self.types.get(base) or classify_name(column)


def strip_suffix(column: str) -> str:
    for suffix in ("_clean", "_imputed"):
        if column.endswith(suffix):
            return column[: -len(suffix)]
    return column


# --- fixed values: words in a column name that decide its type -------------
DATE_WORDS = ("date", "timestamp", "dt")
NUMERIC_WORDS = ("amount", "mrr", "arr", "count", "duration", "hours", "refund", "time")
CATEGORY_WORDS = ("flag", "priority", "tier", "status", "is_")
# ---------------------------------------------------------------------------


def classify_name(column: str) -> str:
    """Guess a type from a column name: id, date, numeric, categorical or text."""
    name = column.lower()
    if name.endswith("_id") or ("id" in name and len(name) <= 25):
        return "id"
    for kind, words in (("date", DATE_WORDS), ("numeric", NUMERIC_WORDS), ("categorical", CATEGORY_WORDS)):
        if any(w in name for w in words):
            return kind
    return "text"


# --- fixed values: tables, keys, required / optional / curated fields, reason codes and descriptions, weights, limits ---
ACCOUNTS = TableSpec(
    name="accounts",
    pk="account_id",
    columns=("account_id", "account_name", "industry", "country", "signup_date", "referral_source",
             "plan_tier", "seats", "is_trial", "churn_flag"),
    types={"account_id": "id", "account_name": "text", "industry": "categorical", "country": "categorical",
           "signup_date": "date", "referral_source": "categorical", "plan_tier": "categorical",
           "seats": "numeric", "is_trial": "categorical", "churn_flag": "categorical",
           "account_churn_date": "date"},
    required=("country_clean", "industry_clean"),
    optional=("account_churn_date_clean",),
    curated=("country_clean", "industry_clean", "churn_flag_clean"),
    clean_columns=("country_clean", "industry_clean", "churn_flag_clean", "account_churn_date_clean"),
)
SUBSCRIPTIONS = TableSpec(
    name="subscriptions",
    pk="subscription_id",
    columns=("subscription_id", "account_id", "start_date", "end_date", "plan_tier", "seats", "mrr_amount",
             "arr_amount", "is_trial", "upgrade_flag", "downgrade_flag", "churn_flag", "billing_frequency",
             "auto_renew_flag"),
    types={"subscription_id": "id", "account_id": "id", "start_date": "date", "end_date": "date",
           "plan_tier": "categorical", "seats": "numeric", "mrr_amount": "numeric", "arr_amount": "numeric",
           "is_trial": "categorical", "upgrade_flag": "categorical", "downgrade_flag": "categorical",
           "churn_flag": "categorical", "billing_frequency": "categorical", "auto_renew_flag": "categorical"},
    required=("start_date",),
    optional=("end_date_clean",),
    curated=("start_date", "end_date_clean", "plan_tier_imputed", "mrr_amount_clean", "arr_amount_clean"),
    clean_columns=("plan_tier_imputed", "mrr_amount_clean", "arr_amount_clean", "end_date_clean"),
)
FEATURE_USAGE = TableSpec(
    name="feature_usage",
    pk="usage_id",
    columns=("usage_id", "subscription_id", "usage_date", "feature_name", "usage_count",
             "usage_duration_secs", "error_count", "is_beta_feature"),
    types={"usage_id": "id", "subscription_id": "id", "usage_date": "date", "feature_name": "categorical",
           "usage_count": "numeric", "usage_duration_secs": "numeric", "error_count": "numeric",
           "is_beta_feature": "categorical"},
    required=("usage_date", "usage_count_clean", "usage_duration_secs_clean"),
    optional=(),
    curated=("usage_date", "usage_count_clean", "usage_duration_secs_clean"),
    clean_columns=("usage_count_clean", "usage_duration_secs_clean", "feature_name_imputed"),
)
SUPPORT_TICKETS = TableSpec(
    name="support_tickets",
    pk="ticket_id",
    columns=("ticket_id", "account_id", "submitted_at", "closed_at", "resolution_time_hours", "priority",
             "first_response_time_minutes", "satisfaction_score", "escalation_flag"),
    types={"ticket_id": "id", "account_id": "id", "submitted_at": "text", "closed_at": "text",
           "resolution_time_hours": "numeric", "resolution_hours": "numeric", "priority": "categorical",
           "first_response_time_minutes": "numeric", "satisfaction_score": "categorical",
           "satisfaction": "categorical", "escalation_flag": "categorical"},
    required=("resolution_hours_clean",),
    optional=("priority", "satisfaction_score"),
    curated=("resolution_hours_clean",),
    clean_columns=("resolution_hours_clean", "satisfaction_imputed"),
)
CHURN_EVENTS = TableSpec(
    name="churn_events",
    pk="churn_event_id",
    columns=("churn_event_id", "account_id", "churn_date", "reason_code", "refund_amount_usd",
             "preceding_upgrade_flag", "preceding_downgrade_flag", "is_reactivation", "feedback_text"),
    types={"churn_event_id": "id", "account_id": "id", "churn_date": "date", "reason_code": "categorical",
           "refund_amount_usd": "numeric", "refund_amount": "numeric", "preceding_upgrade_flag": "categorical",
           "preceding_downgrade_flag": "categorical", "is_reactivation": "categorical",
           "feedback_text": "text"},
    required=("churn_date",),
    optional=("feedback_text",),
    curated=("churn_date",),
    clean_columns=("refund_amount_clean",),
)
TABLES: dict[str, TableSpec] = {
    t.name: t for t in (ACCOUNTS, SUBSCRIPTIONS, FEATURE_USAGE, SUPPORT_TICKETS, CHURN_EVENTS)
}

# Reason codes with their descriptions.
REASON_CODES: dict[str, str] = {
    "duplicate_raw_keep_max_completeness": "Dropped duplicate raw row",
    "blank_pk": "Primary key blank",
    "country_imputed": "Country imputed (cross-ref or Unknown)",
    "industry_imputed": "Industry imputed (cross-ref or Unknown)",
    "native_churn_flag_true_but_no_event": "Native churn flag TRUE but no churn event",
    "native_churn_flag_false_but_event_exists": "Native churn flag FALSE but churn event exists",
    "blank_reason_code": "Churn reason_code blank",
    "blank_feedback_text": "Churn feedback blank",
    "negative_refund_amount_usd": "Refund amount negative (corrected to abs)",
    "invalid_numeric_parsed": "Numeric parse failed",
    "plan_tier_imputed_from_lookup": "Plan tier imputed using lookup",
    "mrr_arr_imputed_from_lookup": "MRR/ARR imputed from lookup or formula",
    "end_date_derived": "Subscription end_date derived from account churn",
    "start_end_swapped_due_to_small_gap": "Start/end swapped (gap < 30 days)",
    "start_after_end_flagged": "Start_date > end_date and large gap",
    "feature_name_imputed": "Feature name imputed as Unknown",
    "negative_usage_count": "Usage count negative (corrected to abs)",
    "negative_usage_duration": "Usage duration negative (corrected to abs)",
    "invalid_date_format": "Date invalid (kept original)",
    "orphan_usage": "Feature usage references missing subscription",
    "negative_resolution_time": "Negative resolution hours",
    "priority_missing_flagged": "Priority missing (flagged only)",
    "satisfaction_imputed": "Satisfaction imputed as Unknown",
    "duplicate_after_cleaning_detected": "Duplicate rows after cleaning",
    "trial_capped_at_30_days": "Free trial without end date closed 30 days after its start",
    "trial_tier_set_to_trial": "Blank plan tier of a trial set to Trial",
    "negative_days_to_adopt_adjusted": "First use before signup (days to adopt set to 0)",
    "missing_submitted_at": "Ticket without submission time",
    "missing_priority": "Ticket without priority",
    "missing_satisfaction_score": "Ticket without satisfaction score",
    "resolution_time_negative_corrected": "Negative resolution hours (corrected to abs)",
}

# Weights of the four quality dimensions.
QUALITY_WEIGHTS = {"completeness": 0.30, "uniqueness": 0.25, "validity": 0.25, "consistency": 0.20}

# Segment thresholds on monthly revenue, seat and resolution buckets, priority scores.
SEGMENT_LIMITS = ((2000.0, "SMB"), (10000.0, "Mid-Market"))
SEGMENT_TOP = "Enterprise"
SEAT_LIMITS = ((10, "01_to_10"), (25, "11_to_25"), (50, "26_to_50"))
SEAT_TOP = "50+"
RESOLUTION_LIMITS = ((24.0, "<24h"), (72.0, "24-72h"))
RESOLUTION_TOP = ">72h"
PRIORITY_SCORES = {3.0: ("high", "p1", "1"), 2.0: ("medium", "p2", "2", "med"), 1.0: ("low", "p3", "3")}
BETA_ADOPTION_DAYS = 14
TRIAL_DAYS = 30
SWAP_GAP_DAYS = 30
RECENT_TICKET_DAYS = 90
NO_LOSS_RATIO = 999.0
VALID_STATUSES = ("active", "churned", "trial", "closed", "canceled")

# Words that stand for "no value" (matched after trim and lower-casing).
ID_NULL_WORDS = ("", "nan", "none", "null")
MISSING_WORDS = ("", "unknown", "nan", "na", "null", "none")
TRUE_WORDS = ("true", "1", "yes")
# Texts a delimited-file reader turns into null, as pandas documents for na_values.
FILE_NULL_WORDS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
                   "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")
# ---------------------------------------------------------------------------
