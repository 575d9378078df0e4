"""Jobs: run a stage and write it.

A stage reads what the stage before committed. Inside a stage every table is
written once and read back before something depends on it, so a lost executor
costs at most the current table and no table is computed twice; the raw tables
are landed first, as several outputs of the clean stage read them.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from subrev.operators import audit, quality, validate
from subrev.plans import runs
from subrev.plans.runs import StageRun
from subrev.plans.stages import REPORTS, CleanTables, FeatureTables
from subrev.session import tune
from subrev.sources import files
from subrev.specs import TABLES

#: The clean table whose rows a feature table is made from.
SOURCE_OF = {"subscriptions": "subscriptions", "usage_monthly": "feature_usage", "feature_month": "feature_usage", "first_use": "feature_usage",
             "support_events": "support_tickets", "support_by_account": "support_tickets", "accounts": "accounts",
             "cohorts": "subscriptions", "revenue_changes": "subscriptions"}
#: Written for the table that is made of it, and no artifact of the feature stage.
ASIDE = ("feature_month_base",)


def run_clean(spark: SparkSession, raw: Mapping[str, DataFrame], out: str, as_of: date | str, run_id: str,
              at: str) -> StageRun:
    """Clean stage: raw tables landed, annotated tables, clean tables, corrections and metric logs, quality reports."""
    tune(spark)
    run = StageRun(spark, out, run_id, at)
    landed = {name: run.keep(f"raw/{name}", raw[name]) for name in TABLES}

    def keep(name: str, df: DataFrame) -> DataFrame:
        return run.keep(f"annotated/{name}", df, run.rows(f"raw/{name}") if name in TABLES else None)

    done = CleanTables(landed, as_of, keep)
    for name in done:
        run.write(f"clean/{name}", files.clean_columns(done[name]), rows_in=run.rows(f"raw/{name}"))

    log = run.keep("logs/corrections_log", audit.stamp(audit.corrections_log(landed, done, TABLES), run_id, at))
    metrics = reduce(DataFrame.unionByName, [
        audit.table_metrics(landed[n], done[n], spec, rows=(run.rows(f"raw/{n}"), run.rows(f"annotated/{n}"))) for n, spec in TABLES.items()])
    run.write("logs/validation_summary_long", audit.stamp(metrics, run_id, at), files.write_report)
    run.write("logs/dirty_reason_lookup", files.reason_lookup(spark), files.write_report)
    write_quality(run, landed, done, log)
    run.commit()
    return run


def write_quality(run: StageRun, raw: Mapping[str, DataFrame], annotated: Mapping[str, DataFrame], log: DataFrame) -> None:
    # The dedupe leaves one row per key; the counts of the five tables are taken once, for two reports.
    counts = run.aside("quality/_counts", quality.summary_counts(raw, annotated, unique_keys=True))
    run.write("quality/data_quality_summary", quality.dq_summary(raw, annotated, counts=counts), files.write_report)
    run.write("quality/data_quality_long_curated", quality.dq_long(annotated), files.write_report)
    run.write("quality/data_quality_col_profile_curated", quality.dq_col_profile(annotated), files.write_report)
    run.write("quality/data_quality_errors_curated", quality.dq_errors(annotated))
    by_table = run.keep("quality/validation_by_table", quality.dq_validation_by_table(raw, annotated, log, counts))
    run.write("quality/dq_validation_summary_by_table", by_table, files.write_report)
    run.write("quality/dq_validation_summary_totals", quality.dq_validation_totals(by_table), files.write_report)


def run_features(spark: SparkSession, clean_root: str, out: str, as_of: date | str, run_id: str, at: str) -> StageRun:
    """Feature stage: nine tables, validation, deep validation with row dumps, schema document.

    ``clean_root`` is what a clean stage committed to, or a plain folder of clean tables.
    """
    tune(spark)
    run = StageRun(spark, out, run_id, at)
    base, known = runs.folder(spark, clean_root), runs.rows_of(spark, clean_root)
    inputs = {n: files.read_clean(spark, f"{base}/clean/{n}" if known else f"{base}/{n}") for n in TABLES}

    def keep(name: str, df: DataFrame) -> DataFrame:
        return run.aside(name, df) if name in ASIDE else run.keep(name, df, known.get(f"clean/{SOURCE_OF.get(name)}"))

    tables = FeatureTables(inputs, as_of, keep).all()
    checks = run.keep("_diagnostics/validation_checks", validate.validation_checks(tables))
    subs, cohorts = tables["subscriptions"], tables["cohorts"]
    for name, report in {
        "verdict": validate.verdict(checks), "row_counts": validate.row_counts(tables), "missingness": validate.missingness(tables),
        "constant_columns": validate.constant_columns(tables), "schema": validate.schema_doc(tables),
        "deep_validation": validate.deep_validation(subs, tables["accounts"], tables["first_use"], cohorts),
    }.items():
        run.write(f"_diagnostics/{name}", report, files.write_report)
    for name, rows in {
        "deep_first_use_negative_days": validate.first_use_before_signup(tables["first_use"], tables["accounts"]),
        "deep_subs_inconsistent_churn": validate.churned_without_date(subs),
        "deep_active_with_churn_date": validate.active_with_churn_date(subs),
        "deep_churn_after_end_date": validate.churn_after_end(subs),
        "deep_negative_months_since_signup": validate.negative_cohort_months(cohorts),
    }.items():
        files.write_if_any(rows, run.path(f"_diagnostics/{name}"))
    run.commit()
    return run


def run_reports(spark: SparkSession, feature_root: str, out: str, as_of: date | str, run_id: str, at: str) -> StageRun:
    """Report stage: every report as a small CSV."""
    tune(spark)
    run = StageRun(spark, out, run_id, at)
    base = runs.folder(spark, feature_root)
    write_reports(run, {n: spark.read.parquet(f"{base}/{n}") for n in FeatureTables.NAMES}, as_of)
    return run


def write_reports(run: StageRun, tables: FeatureTables | Mapping[str, DataFrame], as_of: date | str) -> None:
    """All reports from the feature tables, written ones or such as are made when a report asks for them; commits the run."""
    for name, report in REPORTS.items():
        run.write(name, report(tables, as_of), files.write_report)
    run.commit()


def run_all(spark: SparkSession, raw: Mapping[str, DataFrame], out: str, as_of: date | str, run_id: str,
            at: str) -> dict[str, StageRun]:
    """Clean, features and reports under one directory."""
    return {"clean": run_clean(spark, raw, f"{out}/clean_stage", as_of, run_id, at),
            "features": run_features(spark, f"{out}/clean_stage", f"{out}/features", as_of, run_id, at),
            "reports": run_reports(spark, f"{out}/features", f"{out}/reports", as_of, run_id, at)}
