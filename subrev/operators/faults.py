"""Fault injection: turns a share of a clean table into labelled dirty copies.

Every random choice is a "die": a column with values 0..999 derived from the
row's key, so that a rerun, another partitioning or a lost executor gives the
same rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from subrev.functions import text
from subrev.specs import TableSpec

SIDES = 1000
LABEL_COLUMN = "messiness_description"
NO_LABEL = "no_issue"
Die = Callable[[str], Column]


@dataclass(frozen=True)
class Fault:
    """``action``: null, minus_one, flip or negate. One of ``columns`` is hit, with ``chance``."""

    action: str
    columns: tuple[str, ...]
    chance: float
    label: str


# The fault rules, the share of dirty rows and of kept keys.
FAULTS: dict[str, tuple[Fault, ...]] = {
    "subscriptions": (Fault("null", ("end_date", "plan_tier", "mrr_amount", "arr_amount"), 0.20, "null_{column}"),
                      Fault("flip", ("churn_flag",), 0.15, "flipped_churn_flag")),
    "feature_usage": (Fault("minus_one", ("usage_count", "usage_duration_secs"), 0.15, "negative_{column}"),
                      Fault("null", ("feature_name",), 0.10, "null_feature_name")),
    "accounts": (Fault("null", ("industry", "country"), 0.20, "null_{column}"),
                 Fault("flip", ("churn_flag",), 0.15, "inconsistent_churn_flag")),
    "churn_events": (Fault("null", ("reason_code",), 0.20, "null_reason_code"),
                     Fault("null", ("feedback_text",), 0.20, "null_feedback_text"),
                     Fault("negate", ("refund_amount_usd",), 0.15, "negative_refund")),
    "support_tickets": (Fault("null", ("satisfaction_score",), 0.20, "null_satisfaction_score"),
                        Fault("null", ("priority",), 0.20, "null_priority"),
                        Fault("negate", ("resolution_time_hours",), 0.15, "negative_resolution_time")),
}
FRACTION_DIRTY = 0.10
FRACTION_KEEP_KEY = 0.30


def hash_die(pk: str, seed: int = 42) -> Die:
    """Die per rule name from a hash of key, seed and name."""
    return lambda name: F.pmod(F.xxhash64(F.col(pk), F.lit(seed), F.lit(name)), F.lit(SIDES))


def sample_rows(df: DataFrame, die: Die, fraction: float = FRACTION_DIRTY) -> DataFrame:
    """The rows whose die falls in the fraction; if no die does, the row with the least (runs a small job)."""
    picked = df.where(die("sample") < int(round(fraction * SIDES)))
    if picked.isEmpty():
        return df.orderBy(die("sample"), *df.columns).limit(1)
    return picked


def _damaged(action: str, c: str) -> Column:
    value = F.col(c)
    if action == "null":
        return F.lit(None).cast("string")
    if action == "minus_one":
        return F.lit("-1")
    if action == "flip":
        return F.when(text.is_true(value), "False").otherwise("True")
    bare = F.regexp_replace(value, "^-", "")
    return F.when(value.isNotNull(), F.concat(F.lit("-"), bare))


def inject(df: DataFrame, table: str, die: Die) -> DataFrame:
    """Apply the fault rules of a table to every row and label what was done."""
    changes: dict[str, list[tuple[Column, Column]]] = {}
    labels = []
    for i, fault in enumerate(FAULTS[table]):
        hit = die(f"hit{i}") < int(round(fault.chance * SIDES))
        pick = F.pmod(die(f"pick{i}"), F.lit(len(fault.columns)))
        for j, c in enumerate(fault.columns):
            mine = hit & (pick == j)
            changes.setdefault(c, []).append((mine, _damaged(fault.action, c)))
            labels.append(F.when(mine, F.lit(fault.label.format(column=c))))
    new = {}
    for c, cases in changes.items():
        out = F.col(c)
        for mine, value in cases:
            out = F.when(mine, value).otherwise(out)
        new[c] = out
    label = F.concat_ws("; ", F.array_compact(F.array(*labels)))
    new[LABEL_COLUMN] = F.when(label == "", NO_LABEL).otherwise(label)
    return df.withColumns(new)


def infer_prefix_and_width(example: str) -> tuple[str, int]:
    """"A-503d5a" gives ("A-", 6); an id without a dash is all counter."""
    head, dash, tail = example.partition("-")
    return (head + dash, len(tail)) if dash else ("", len(example))


Keep = Callable[[str, DataFrame], DataFrame]


def number_rows(df: DataFrame, order: Column, bucket: Column, name: str = "row_index", keep: Keep | None = None) -> DataFrame:
    """Consecutive numbers 1.. over the whole frame.

    Rows are numbered inside buckets and shifted by the running total of the
    bucket sizes, so only the list of buckets is ever sorted in one task.
    ``bucket`` has to rise with ``order`` for the numbers to follow it.  ``keep`` may write
    the rows with their numbers inside the buckets, which are used twice.
    """
    inside = F.row_number().over(Window.partitionBy("_bucket").orderBy(order))
    rows = df.withColumn("_bucket", bucket).withColumn("_inside", inside)
    if keep is not None:
        rows = keep(f"numbered_{name}", rows)
    sizes = rows.groupBy("_bucket").agg(F.max("_inside").alias("_size"))
    before = F.sum("_size").over(Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1))
    shifts = sizes.select(F.col("_bucket").alias("_b"), F.coalesce(before, F.lit(0)).alias("_shift"))
    return (rows.join(shifts, F.col("_bucket") == F.col("_b"))
            .withColumn(name, F.col("_inside") + F.col("_shift")).drop("_bucket", "_b", "_inside", "_shift"))


#: Numbers that one bucket of the gap search spans.
SPAN = 1 << 16


def free_numbers(rows: DataFrame, index: str, taken: DataFrame, number: str, out: str, keep: Keep | None = None) -> DataFrame:
    """``rows`` with the ``index``-th positive number that is not in ``taken``, as ``out``.

    The i-th taken number t has t - i free ones before it, so the k-th free number is k plus the
    count of taken ones with fewer than k free ones before them.  Both sides meet in buckets of the
    index; what lies before a bucket comes from a running maximum over the buckets.
    """
    ranked = number_rows(taken.select(number).distinct(), F.col(number), F.floor(F.col(number) / SPAN), "_rank", keep)
    # Neighbours without a gap share one mark: from this index on, so many numbers are skipped.
    last = rows.agg(F.max(index)).scalar()
    marks = ranked.groupBy((F.col(number) - F.col("_rank") + 1).alias("_at")).agg(F.max("_rank").cast("bigint").alias("_skip"))
    marks = marks.where(F.col("_at") <= last)
    points = rows.select(F.col(index).cast("bigint").alias("_at"), F.lit(None).cast("bigint").alias("_skip"), F.struct(*rows.columns).alias("_row"))
    both = points.unionByName(marks.withColumn("_row", F.lit(None).cast(points.schema["_row"].dataType)))
    both = both.withColumn("_span", F.floor(F.col("_at") / SPAN))
    run = Window.partitionBy("_span").orderBy("_at", F.col("_row").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    here = both.withColumn("_here", F.max("_skip").over(run)).where(F.col("_row").isNotNull())
    per = marks.groupBy(F.floor(F.col("_at") / SPAN).alias("_of")).agg(F.max("_skip").alias("_most"))
    by_span = Window.orderBy("_of")
    steps = per.select("_of", F.max("_most").over(by_span.rowsBetween(Window.unboundedPreceding, 0)).alias("_most"), F.lead("_of").over(by_span).alias("_next"))
    # What a bucket of marks skips holds for the buckets after it, up to the next one that has marks.
    end = F.floor(last / SPAN)
    spread = steps.where(F.col("_of") < end).select("_most", F.explode(F.sequence(F.col("_of") + 1, F.coalesce("_next", end))).alias("_after"))
    found = here.join(spread, F.col("_span") == F.col("_after"), "left")
    skipped = F.greatest(F.coalesce("_here", F.lit(0)), F.coalesce("_most", F.lit(0)))
    return found.select("_row.*", (F.col("_at") + skipped).alias(out))


def new_ids(rows: DataFrame, existing: DataFrame, pk: str, example: str, order: Column | None = None,
            bucket: Column | None = None, buckets: int = 4096, keep: Keep | None = None) -> DataFrame:
    """Give every row a fresh key: prefix and zero-padded hex counter, taken keys skipped.

    A counter that outgrows the width is written in full, so no key is given twice.  ``rows`` and
    ``existing`` are read once each when ``keep`` writes what is numbered; the keys stay on the executors.
    """
    prefix, width = infer_prefix_and_width(example)
    key = F.col(pk)

    def made(counter: Column) -> Column:
        digits = F.lower(F.hex(counter))
        return F.concat(F.lit(prefix), F.when(F.length(digits) >= width, digits).otherwise(F.lpad(digits, width, "0")))

    # The default bucket hashes the whole row, so that one very frequent key is spread too.
    row_hash = F.xxhash64(*rows.columns)
    numbered = number_rows(rows, order if order is not None else F.struct(row_hash, key),
                           bucket if bucket is not None else F.pmod(row_hash, F.lit(buckets)), "_index", keep)
    # Only keys that a counter writes in just this form can be met again.
    digits = F.substring(key, len(prefix) + 1, 64)
    counter = F.when(digits.rlike("^[0-9a-f]{1,15}$"), F.conv(digits, 16, 10).try_cast("bigint"))
    taken = existing.where(key.startswith(prefix)).select(counter.alias("_number"), key.alias("_key"))
    taken = taken.where((F.col("_number") > 0) & (made(F.col("_number")) == F.col("_key"))).select("_number")
    out = free_numbers(numbered, "_index", taken, "_number", "_new", keep)
    return out.withColumn(pk, made(F.col("_new"))).select(*rows.columns)


def messy_copy(df: DataFrame, spec: TableSpec, example: str, die: Die | None = None, order: Column | None = None,
               bucket: Column | None = None, keep: Keep | None = None) -> DataFrame:
    """Sample, damage and label; 30 % of the copies keep their key, the rest get new ones."""
    die = die or hash_die(spec.pk)
    dirty = inject(sample_rows(df, die), spec.name, die).withColumn(
        "_keep", die("keep") < int(round(FRACTION_KEEP_KEY * SIDES)))
    kept = dirty.where("_keep").drop("_keep")
    fresh = new_ids(dirty.where(~F.col("_keep")).drop("_keep"), df, spec.pk, example, order, bucket, keep=keep)
    return kept.unionByName(fresh)


def merge_raw(base: DataFrame, messy: DataFrame) -> DataFrame:
    """Raw table: the base rows and the messy rows without their label."""
    return base.unionByName(messy.drop(LABEL_COLUMN))


