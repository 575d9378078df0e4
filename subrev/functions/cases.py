"""Case expressions: buckets, scores, statuses, segments, change classes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from subrev import specs
from subrev.functions import numeric, text


def seat_bucket(seats: Column) -> Column:
    """Bucket of a seat count; a missing or unreadable count is "unknown"."""
    n = text.strict_number(seats)
    out = F.when(n.isNull() | F.isnan(n), "unknown")
    for limit, label in specs.SEAT_LIMITS:
        out = out.when(n <= limit, label)
    return out.otherwise(specs.SEAT_TOP)


def resolution_bucket(hours: Column) -> Column:
    out = F.when(hours.isNull(), "unknown")
    for limit, label in specs.RESOLUTION_LIMITS:
        out = out.when(hours < limit, label)
    return out.otherwise(specs.RESOLUTION_TOP)


def priority_score(priority: Column, scores: Mapping[float, Sequence[str]] | None = None) -> Column:
    """Score of a priority word; other texts count when numeric, else null ("urgent" is null)."""
    word = text.lowered(priority)
    out = None
    for score, words in (scores or specs.PRIORITY_SCORES).items():
        hit = word.isin(*words)
        out = F.when(hit, score) if out is None else out.when(hit, score)
    return out.otherwise(text.strict_number(priority))


def first_nonblank(*candidates: Column) -> Column:
    return F.coalesce(*[text.nonblank(c) for c in candidates])


def revenue_change_flag(upgraded: Column, downgraded: Column) -> Column:
    return F.when(upgraded, "expansion").when(downgraded, "contraction").otherwise("unchanged")


def subscription_status(is_churned: Column, is_trial: Column, end_date: Column) -> Column:
    """churned, else trial (any non-false trial text), else closed when it has an end, else active."""
    trial = ~text.lowered(is_trial).isin("false", "0", *specs.ID_NULL_WORDS)
    return (F.when(is_churned, "churned").when(trial, "trial")
            .when(end_date.isNotNull(), "closed").otherwise("active"))


def segment(mrr: Column) -> Column:
    out = None
    for limit, label in specs.SEGMENT_LIMITS:
        hit = mrr < limit
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return out.otherwise(specs.SEGMENT_TOP)


def change_type(mrr: Column, prev: Column) -> Column:
    diff = mrr - prev
    return (F.when(numeric.same_amount(diff), "unchanged")
            .when((prev == 0) & (mrr > 0), "new")
            .when((prev > 0) & (mrr == 0), "churn")
            .when(diff > 0, "expansion")
            .when(diff < 0, "contraction")
            .otherwise("unknown"))


def quick_ratio(gains: Column, losses: Column) -> Column:
    """gains / losses; 999.0 stands for gains without losses, 0 for neither."""
    return (F.when(losses > 0, numeric.ratio(gains, losses))
            .when(gains == 0, 0.0).otherwise(specs.NO_LOSS_RATIO))
