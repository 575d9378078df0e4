"""Data-quality metrics.

Counts, bounds and shares of all columns of a table come out of one aggregate over a generated list of
expressions; distinct values are counted by fixed-width digests, whose groups
combine map-side.  Only samples of values move cell texts, and no column is ever collected into one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from subrev import specs
from subrev.functions import dates, numeric, text
from subrev.functions.reasons import CORRECTIONS, FLAG, REASONS
from subrev.specs import TABLES, TableSpec, classify_name

HELPERS = (FLAG, REASONS, CORRECTIONS)
# Words in a curated column name that make it numeric there.
CURATED_NUMERIC_WORDS = ("mrr", "arr", "amount", "count", "duration", "hours", "resolution")
NEVER_INVALID = ("country_clean", "industry_clean")


def _total(parts: Sequence[Column]) -> Column:
    return reduce(add, parts)


def _any(parts: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, parts)


def _count(cond: Column) -> Column:
    return F.count_if(F.coalesce(cond, F.lit(False)))


def _hits(conditions: Sequence[Column]) -> Column:
    """Number of cells of a row that meet their condition."""
    return _total([F.coalesce(c, F.lit(False)).cast("int") for c in conditions])


def _cells(conditions: Sequence[Column]) -> Column:
    """Number of cells that meet their condition: added up in the row first, so it is one aggregate."""
    return F.coalesce(F.sum(_hits(conditions)), F.lit(0))


def native_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if not c.endswith(("_clean", "_imputed", "_norm")) and c not in HELPERS]


def effective_columns(df: DataFrame) -> dict[str, str]:
    """Base name to the column that carries it: the cleaned sibling where there is one."""
    out: dict[str, str] = {}
    for c in df.columns:
        if c.endswith(("_clean", "_imputed")):
            out[specs.strip_suffix(c)] = c
    for c in df.columns:
        if c not in HELPERS and not c.endswith(("_clean", "_imputed", "_norm")):
            out.setdefault(c, c)
    return out


def curated_kind(column: str) -> str:
    name = column.lower()
    if name in NEVER_INVALID:
        return "text"
    if "date" in name:
        return "date"
    return "numeric" if any(w in name for w in CURATED_NUMERIC_WORDS) else "text"


# ------------------------------------------------------------------ dimensions
def completeness_before(raw: DataFrame) -> DataFrame:
    """1 - missing cells / cells over the native columns; "unknown" counts as missing."""
    cols = native_columns(raw)
    missing = _cells([text.is_missing_word(F.col(c)) for c in cols])
    return raw.agg(missing.alias("missing"), F.count(F.lit(1)).alias("n")).select(
        numeric.unit(F.coalesce(1 - numeric.ratio(F.col("missing"), F.col("n") * len(cols)), F.lit(1.0)))
        .alias("completeness_before"))


def completeness_effective(df: DataFrame) -> DataFrame:
    """Completeness over the effective columns; "unknown" counts as a value."""
    cols = list(effective_columns(df).values())
    missing = _cells([text.is_blank(F.col(c)) for c in cols])
    return df.agg(missing.alias("missing"), F.count(F.lit(1)).alias("n")).select(
        numeric.unit(F.coalesce(1 - numeric.ratio(F.col("missing"), F.col("n") * len(cols)), F.lit(1.0)))
        .alias("completeness"))


def _required_missing(spec: TableSpec, df: DataFrame) -> Column:
    return _any([text.is_missing_value(F.col(c)) if c in df.columns else F.lit(True) for c in spec.required])


def _invalid(kind: str, c: Column) -> Column:
    """A cell that is empty or does not fit its type."""
    if kind == "date":
        return c.isNull() | ~dates.has_date_format(c)
    if kind == "numeric":
        return text.bare_number(c).isNull()
    if kind in ("id", "categorical"):
        return text.is_missing_value(c)
    return c.isNull() | (c.cast("string") == "")


def _issues_clean(spec: TableSpec, df: DataFrame) -> Column:
    """A clean row that still has an issue: required value missing, start 30 or more days after the end, or
    a malformed date in a column that is not optional."""
    bad = [_required_missing(spec, df)]
    if spec.name == "subscriptions":
        start, end = dates.parse_date(F.col("start_date")), dates.parse_date(F.col("end_date_clean"))
        bad.append(F.coalesce(dates.days_between(end, start) >= specs.SWAP_GAP_DAYS, F.lit(False)))
    for c in df.columns:
        if c not in HELPERS and c not in spec.optional and spec.kind(c) == "date":
            bad.append(~text.is_blank(F.col(c)) & ~dates.has_date_format(F.col(c)))
    return _any(bad)


def _issues_raw(spec: TableSpec, raw: DataFrame) -> tuple[Column, Column]:
    """(cells, rows) with an issue in a raw table.

    Cells: blanks, null keys once more, negative numbers, dates out of format
    (null dates count here too); which columns are numbers and dates is declared,
    not guessed from names.  Rows: rows with at least one of them.
    """
    checks = []
    for c in raw.columns:
        kind = spec.kind(c)
        checks.append(text.is_blank(F.col(c)))
        if c == spec.pk:
            checks.append(text.is_blank(F.col(c)))
        if kind == "numeric":
            checks.append(F.coalesce(text.bare_number(F.col(c)) < 0, F.lit(False)))
        if kind == "date":
            checks.append(~dates.has_date_format(F.col(c)))
    return _cells(checks), _count(_any(checks))


def _inconsistent(name: str, df: DataFrame, limits: DataFrame | None) -> tuple[DataFrame, Column]:
    """The rows joined to what they are checked against, and whether a row fails.

    accounts: churned without a date; subscriptions: start after end; usage:
    after the end of its subscription or after its account's churn date (``_key`` and ``_day`` hold what that takes).
    """
    if name == "accounts":
        return df, F.col("churn_flag_clean") & text.is_blank(F.col("account_churn_date_clean"))
    if name == "subscriptions":
        return df, dates.parse_date(F.col("start_date")) > dates.parse_date(F.col("end_date_clean"))
    if limits is not None:
        return df.join(limits, F.col("_key") == F.col("_sub"), "left"), F.col("_day") > F.col("_last_day")
    return df, F.lit(False)


def consistency_flags(annotated: Mapping[str, DataFrame], name: str) -> DataFrame:
    """The rows of one clean table with a boolean ``_bad``."""
    df, limits = annotated[name], None
    if name == "feature_usage":
        limits = usage_limits(annotated["accounts"], annotated["subscriptions"])
        df = df.withColumns({"_key": F.col("subscription_id_norm"), "_day": dates.parse_date(F.col("usage_date"))})
    df, bad = _inconsistent(name, df, limits)
    return df.withColumn("_bad", F.coalesce(bad, F.lit(False)))


def usage_limits(accounts: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """Subscription to the last day it can be used: the earlier of its end and its account's churn date."""
    churn = accounts.where(F.col("account_id_norm").isNotNull()).groupBy(F.col("account_id_norm").alias("_acct")).agg(
        F.max(dates.parse_date(F.col("account_churn_date_clean"))).alias("_churn"))
    ends = subscriptions.where(F.col("subscription_id_norm").isNotNull()).select(
        F.col("subscription_id_norm").alias("_sub"), F.col("account_id_norm").alias("_owner"),
        dates.parse_date(F.col("end_date_clean")).alias("_end"))
    both = ends.join(churn, F.col("_owner") == F.col("_acct"), "left")
    return both.groupBy("_sub").agg(F.max(F.least("_end", "_churn")).alias("_last_day"))


def _summary_parts(spec: TableSpec, raw: DataFrame, annotated: Mapping[str, DataFrame], unique_keys: bool = False) -> list[DataFrame]:
    """One-row frames with the counts a summary row is made of. ``unique_keys``: the rows are known to have a key each."""
    native = native_columns(raw)
    cells, rows = _issues_raw(spec, raw)
    n = F.count(F.lit(1))
    before = raw.agg(
        n.alias("rows_before"), cells.alias("issues_before"), rows.alias("rows_with_issues_before"),
        _cells([text.is_missing_word(F.col(c)) for c in native]).alias("missing_cells"),
        (n * len(native)).alias("raw_cells"))
    clean = annotated[spec.name]
    eff = effective_columns(clean)
    incomplete, issue = _required_missing(spec, clean), _issues_clean(spec, clean)
    invalid = [_invalid(spec.kind(b), F.col(c)) for b, c in eff.items()]
    limits = None
    if spec.name == "feature_usage":
        # A row meets its limit as the few numbers that are counted of it, not as its cells.
        limits = usage_limits(annotated["accounts"], annotated["subscriptions"])
        clean = clean.select(spec.pk, F.col("subscription_id_norm").alias("_key"), dates.parse_date(F.col("usage_date")).alias("_day"),
                             incomplete.alias("_incomplete"), issue.alias("_issue"), _hits(invalid).alias("_invalid"))
        incomplete, issue, bad_cells = F.col("_incomplete"), F.col("_issue"), F.coalesce(F.sum("_invalid"), F.lit(0))
    else:
        bad_cells = _cells(invalid)
    clean, inconsistent = _inconsistent(spec.name, clean, limits)
    counts = {"rows_after": n, "incomplete_rows": _count(incomplete), "invalid_cells": bad_cells,
              "inconsistent_rows": _count(inconsistent), "issues_after": _count(issue)}
    each = [c.alias(name) for name, c in counts.items()]
    if unique_keys:
        after = clean.agg(n.alias("keys"), *each)
    else:
        # Added up per key first, so that the keys are counted by the same scan.
        after = clean.groupBy(spec.pk).agg(*each).agg(
            n.alias("keys"), *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in counts])
    after = after.withColumn("clean_cells", F.col("rows_after") * len(eff))
    return [part.withColumn("table_name", F.lit(spec.name)) for part in (before, after)]


def _by_table(parts: Sequence[DataFrame]) -> DataFrame:
    """One-row frames of several tables side by side: one row per table."""
    rows = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), parts)
    return rows.groupBy("table_name").agg(*[F.max(c).alias(c) for c in rows.columns if c != "table_name"])


def summary_counts(raw: Mapping[str, DataFrame], annotated: Mapping[str, DataFrame], names: Sequence[str] | None = None,
                   unique_keys: bool = False) -> DataFrame:
    """One row per table: the counts that the summary and the validation of the tables are made of."""
    return _by_table([p for n in (names or annotated) for p in _summary_parts(TABLES[n], raw[n], annotated, unique_keys)])


def dq_summary(raw: Mapping[str, DataFrame], annotated: Mapping[str, DataFrame],
               names: Sequence[str] | None = None, counts: DataFrame | None = None) -> DataFrame:
    """One row per table: completeness before and after, uniqueness, validity, consistency, score, issue counts.

    ``issues_before`` counts cells, ``issues_after`` rows; ``rows_with_issues_before``
    is the raw count in the unit of the latter.  ``counts``: those of the tables, where they are there already.
    """
    counts = summary_counts(raw, annotated, names) if counts is None else counts

    def share(bad: str, whole: str) -> Column:
        return numeric.unit(F.coalesce(1 - numeric.ratio(F.col(bad), F.col(whole)), F.lit(1.0)))

    one = counts.withColumns({
        "completeness_before": share("missing_cells", "raw_cells"),
        "completeness_after": share("incomplete_rows", "rows_after"),
        "uniqueness": F.coalesce(numeric.ratio(F.col("keys"), F.col("rows_after")), F.lit(1.0)),
        "validity": share("invalid_cells", "clean_cells"),
        "consistency": share("inconsistent_rows", "rows_after")})
    gain = numeric.ratio(F.col("completeness_after") - F.col("completeness_before"), F.col("completeness_before"))
    drop = numeric.ratio(F.col("issues_before") - F.col("issues_after"), F.col("issues_before"))
    score = final_score(F.col("completeness_after"), F.col("uniqueness"), F.col("validity"), F.col("consistency"))
    return one.select(
        "table_name", F.bround("completeness_before", 6).alias("completeness_before"),
        F.bround("completeness_after", 6).alias("completeness_after"),
        F.bround(gain, 6).alias("completeness_improvement_pct"), F.bround("uniqueness", 6).alias("uniqueness"),
        F.bround("validity", 6).alias("validity"), F.bround("consistency", 6).alias("consistency"),
        F.bround(score, 6).alias("final_quality_score"), "rows_before", "rows_after", "issues_before", "issues_after",
        F.bround(drop, 6).alias("issues_reduction_pct"), "rows_with_issues_before")


def final_score(completeness: Column, uniqueness: Column, validity: Column, consistency: Column) -> Column:
    w = specs.QUALITY_WEIGHTS
    return numeric.unit(completeness * w["completeness"] + uniqueness * w["uniqueness"]
                        + validity * w["validity"] + consistency * w["consistency"])


# ------------------------------------------------------------- column profiles
def cell_counts(df: DataFrame, columns: Mapping[str, Mapping[str, Column]]) -> DataFrame:
    """One row per column: its aggregates, each column's the same names; all columns in one scan and one aggregate."""
    names = list(next(iter(columns.values())))
    wide = df.agg(*[agg.alias(f"_{i}_{name}") for i, aggs in enumerate(columns.values()) for name, agg in aggs.items()])
    cells = [F.struct(F.lit(c).alias("column_name"), *[F.col(f"_{i}_{name}").alias(name) for name in names])
             for i, c in enumerate(columns)]
    return wide.select(F.inline(F.array(*cells)))


def distinct_counts(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """(_c, distinct): different non-null values of every column.

    The exchange carries a column number and a 128-bit digest of the cell, whatever its length.
    """
    cells = [F.struct(F.lit(i).alias("i"), F.when(v.isNotNull(), F.struct(F.xxhash64(v).alias("a"), F.xxhash64(F.lit(1), v).alias("b"))).alias("digest"))
             for i, v in enumerate(columns.values())]
    each = df.select(F.inline(F.array(*cells))).where(F.col("digest").isNotNull()).select("i", "digest.a", "digest.b").distinct()
    counts = each.groupBy("i").agg(F.count(F.lit(1)).alias("distinct"))
    return counts.select(F.element_at(F.array(*[F.lit(c) for c in columns]), F.col("i") + 1).alias("_c"), "distinct")


def _with_distinct(counts: DataFrame, df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """``counts`` with the distinct values per column, 0 for a column of nulls; both sides have a row per column."""
    found = distinct_counts(df, columns)
    return counts.join(found, F.col("column_name") == F.col("_c"), "left").withColumn("distinct", F.coalesce("distinct", F.lit(0))).drop("_c")


def column_metrics(df: DataFrame, spec: TableSpec, by_name: bool = False) -> DataFrame:
    """Per column: shares of missing, invalid, unique, negative and zero cells."""
    cols = [c for c in df.columns if c not in HELPERS]
    aggs = {}
    for c in cols:
        kind = classify_name(c) if by_name else spec.kind(c)
        v = F.col(c).cast("string")
        empty = v.isNull() | (v == "")
        number = text.bare_number(v) if kind == "numeric" else F.lit(None).cast("double")
        invalid = {"numeric": number.isNull(), "date": ~dates.has_date_format(v), "id": empty, "categorical": empty}.get(kind, F.lit(False))
        aggs[c] = {"col_type": F.max(F.lit(kind)), "_rows": F.count(F.lit(1)), "missing": _count(empty), "invalid": _count(invalid),
                   "negative": _count(number < 0), "zero": _count(number == 0)}
    grouped = _with_distinct(cell_counts(df, aggs), df, {c: F.col(c).cast("string") for c in cols}).where("_rows > 0")
    share = {p: F.bround(numeric.ratio(F.col(c), F.col("_rows")), 6) for p, c in (
        ("percent_missing", "missing"), ("percent_invalid", "invalid"), ("percent_unique", "distinct"),
        ("percent_negative", "negative"), ("percent_zero", "zero"))}
    return grouped.select(F.lit(spec.name).alias("table_name"), "column_name", "col_type",
                          *[c.alias(p) for p, c in share.items()])


def first_distinct(df: DataFrame, columns: Sequence[str], n: int) -> DataFrame:
    """(_c, sample_values): the first ``n`` different values of every column in order, as JSON."""
    cells = [F.struct(F.lit(c).alias("_c"), F.col(c).cast("string").alias("value")) for c in columns]
    values = df.select(F.inline(F.array(*cells))).where(F.col("value").isNotNull()).distinct()
    rank = F.row_number().over(Window.partitionBy("_c").orderBy("value"))
    first = values.withColumn("_r", rank).where(F.col("_r") <= n)
    return first.groupBy("_c").agg(F.to_json(F.transform(
        F.array_sort(F.collect_list(F.struct("_r", "value"))), lambda x: x["value"])).alias("sample_values"))


def column_profile(df: DataFrame, spec: TableSpec, by_name: bool = False, samples: int = 10) -> DataFrame:
    """Per column: counts, its first ``samples`` distinct values in order, and min / max / mean of numeric ones.

    Only the samples move cell texts.
    """
    cols = [c for c in df.columns if c not in HELPERS]
    aggs = {}
    for c in cols:
        kind = classify_name(c) if by_name else spec.kind(c)
        v = F.col(c).cast("string")
        number = text.bare_number(v) if kind == "numeric" else F.lit(None).cast("double")
        aggs[c] = {"col_type": F.max(F.lit(kind)), "_rows": F.count(F.lit(1)), "non_null_count": F.count(v), "blank_count": _count(v == ""),
                   "null_count": _count(v.isNull()), "min": F.min(number), "max": F.max(number), "mean": F.avg(number)}
    stats = _with_distinct(cell_counts(df, aggs), df, {c: F.col(c).cast("string") for c in cols}).where("_rows > 0")
    return (stats.join(first_distinct(df, cols, samples), F.col("column_name") == F.col("_c"), "left")
            .select(F.lit(spec.name).alias("table_name"), "column_name", "col_type", "non_null_count", "blank_count",
                    "null_count", F.col("distinct").alias("distinct_count"), "sample_values", "min", "max", "mean"))


# --------------------------------------------------------------------- curated
def _curated(annotated: Mapping[str, DataFrame]) -> list[tuple[str, DataFrame, list[str]]]:
    """Table, rows, and the curated columns it has."""
    return [(n, df, cols) for n, df in annotated.items() if (cols := [c for c in TABLES[n].curated if c in df.columns])]


def _absent(annotated: Mapping[str, DataFrame]) -> list[tuple[str, str]]:
    return [(n, c) for n, df in annotated.items() for c in TABLES[n].curated if c not in df.columns]


def dq_long(annotated: Mapping[str, DataFrame], top: int | None = None) -> DataFrame:
    """Missing, invalid and unique shares of the curated columns; with ``top`` only the worst (names break ties).

    An end date is never missing, country and industry never invalid, "Unknown"
    is a value, and the empty text counts as one distinct value.
    """
    parts = []
    for n, df, cols in _curated(annotated):
        aggs, values = {}, {}
        for c in cols:
            v, kind = F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")), curated_kind(c)
            missing = text.is_missing_value(v)
            wrong = {"date": ~dates.has_date_format(v), "numeric": v.try_cast("double").isNull()}.get(kind, F.lit(False))
            aggs[c] = {"_rows": F.count(F.lit(1)), "m": F.lit(0) if c == "end_date_clean" else _count(missing), "i": _count(~missing & wrong)}
            values[c] = v
        parts.append(_with_distinct(cell_counts(df, aggs), df, values).where("_rows > 0").select(
            F.lit(n).alias("table_name"), "column_name", numeric.ratio(F.col("m"), F.col("_rows")).alias("pct_missing"),
            numeric.ratio(F.col("i"), F.col("_rows")).alias("pct_invalid"), numeric.ratio(F.col("distinct"), F.col("_rows")).alias("pct_unique")))
    out = reduce(DataFrame.unionByName, parts)
    gone = _absent(annotated)
    if gone:
        out = out.unionByName(out.sparkSession.createDataFrame(
            [(n, c, 1.0, 1.0, 0.0) for n, c in gone],
            "table_name string, column_name string, pct_missing double, pct_invalid double, pct_unique double"))
    if top is None:
        return out
    return out.orderBy(F.col("pct_missing").desc(), F.col("pct_invalid").desc(), "table_name", "column_name").limit(top)


def dq_col_profile(annotated: Mapping[str, DataFrame]) -> DataFrame:
    """Type, min, max, mean, missing and unique shares of the curated columns; an absent column is ``missing`` throughout."""
    parts = []
    for n, df, cols in _curated(annotated):
        aggs = {}
        for c in cols:
            v, kind = F.col(c).cast("string"), curated_kind(c)
            number = text.strict_number(v) if kind == "numeric" else F.lit(None).cast("double")
            day = dates.parse_date(v) if kind == "date" else F.lit(None).cast("date")
            aggs[c] = {"dtype": F.max(F.lit(kind)), "_rows": F.count(F.lit(1)), "_missing": _count(v.isNull() | (F.trim(v) == "")),
                       "_lo": F.min(number), "_hi": F.max(number), "avg_val": F.avg(number), "_first": F.min(day), "_last": F.max(day)}
        rows = _with_distinct(cell_counts(df, aggs), df, {c: F.col(c).cast("string") for c in cols}).where("_rows > 0")
        parts.append(rows.select(
            F.lit(n).alias("table_name"), "column_name", "dtype",
            F.coalesce(dates.format_date(F.col("_first")), F.col("_lo").cast("string")).alias("min_val"),
            F.coalesce(dates.format_date(F.col("_last")), F.col("_hi").cast("string")).alias("max_val"), "avg_val",
            numeric.ratio(F.col("_missing"), F.col("_rows")).alias("missing_pct"),
            numeric.ratio(F.col("distinct"), F.col("_rows")).alias("unique_pct")))
    out = reduce(DataFrame.unionByName, parts)
    gone = _absent(annotated)
    if gone:
        out = out.unionByName(out.sparkSession.createDataFrame(
            [(n, c, "missing", None, None, None, 1.0, 0.0) for n, c in gone], out.schema))
    return out


def table_errors(df: DataFrame, spec: TableSpec, cap: int | None = None) -> DataFrame:
    """Errors in the curated cells of one table; with ``cap`` only the first by key and column."""
    cells = []
    for c in [x for x in spec.curated if x in df.columns] or [spec.pk]:
        t = F.trim(F.col(c).cast("string"))
        kind = curated_kind(c)
        if kind == "date":
            error = F.when(~dates.has_date_format(t), "invalid_date_format")
        elif kind == "numeric":
            x = F.regexp_replace(t, ",", "").try_cast("double")
            error = F.when(x.isNull(), "numeric_parse_failed")
            if "refund" not in c:
                error = error.when(x < 0, "negative_value")
        else:
            error = F.when(F.lower(t).isin(*specs.ID_NULL_WORDS), "unexpected_token")
        skip = text.is_blank(F.col(c)) | (F.lower(t) == "unknown")
        cells.append(F.struct(F.lit(c).alias("column_name"), F.when(~skip, error).alias("error_type"),
                              F.col(c).cast("string").alias("original_value")))
    out = (df.select(F.lit(spec.name).alias("table_name"), F.col(spec.pk).alias("primary_key"),
                     F.inline(F.array(*cells)))
           .where(F.col("error_type").isNotNull()).withColumn("cleaned_value", F.lit(None).cast("string")))
    if cap is None:
        return out
    return out.orderBy("primary_key", "column_name").limit(cap)


def dq_errors(annotated: Mapping[str, DataFrame], cap: int | None = None) -> DataFrame:
    return reduce(DataFrame.unionByName, [table_errors(df, TABLES[n], cap) for n, df in annotated.items()])


# ------------------------------------------------------------------ validation
def dq_validation_by_table(raw: Mapping[str, DataFrame], annotated: Mapping[str, DataFrame],
                           corrections: DataFrame | None = None, counts: DataFrame | None = None) -> DataFrame:
    """Rows before and after, duplicates removed, remaining issues, corrections and imputations per table.

    ``counts``: those of :func:`summary_counts`, where they are there already."""
    parts = []
    for n, df in annotated.items() if counts is None else ():
        before = raw[n].agg(F.count(F.lit(1)).alias("rows_before"))
        after = df.agg(F.count(F.lit(1)).alias("rows_after"),
                       _count(_issues_clean(TABLES[n], df)).alias("remaining_issues"))
        parts += [part.withColumn("table_name", F.lit(n)) for part in (before, after)]
    rows = _by_table(parts) if counts is None else counts.withColumnRenamed("issues_after", "remaining_issues")
    rows = rows.withColumn("duplicates_removed", F.greatest(F.lit(0), F.col("rows_before") - F.col("rows_after")))
    out = rows.select("table_name", "rows_before", "rows_after", "duplicates_removed", "remaining_issues")
    if corrections is None:
        return out
    per = corrections.groupBy(F.col("table_name").alias("_c")).agg(
        F.sum("rows").alias("corrections_applied"),
        F.coalesce(F.sum(F.when(F.col("reason_code").contains("imput"), F.col("rows"))), F.lit(0))
        .alias("imputations_applied"))
    return (out.join(per, F.col("table_name") == F.col("_c"), "left").drop("_c")
            .withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in ("corrections_applied", "imputations_applied")}))


def dq_validation_totals(by_table: DataFrame) -> DataFrame:
    def total(c: str) -> Column:
        return F.coalesce(F.sum(c), F.lit(0))

    return by_table.agg(
        total("duplicates_removed").alias("duplicates_removed"), total("corrections_applied").alias("corrections_applied"),
        total("imputations_applied").alias("imputations_applied"),
        total("remaining_issues").alias("invalid_dates_remaining")).select(F.lit("totals").alias("metric"), "*")
