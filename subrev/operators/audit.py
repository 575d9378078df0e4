"""Audit frames: the corrections log and the long metric log."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subrev.functions.reasons import CORRECTIONS
from subrev.operators import dedupe
from subrev.specs import TableSpec

LOG_COLUMNS = ("table_name", "primary_key", "column_name", "original_value", "corrected_value",
               "reason_code", "rows")


def key_json(pk: str) -> Column:
    return F.to_json(F.struct(F.col(pk)), {"ignoreNullFields": "false"})


def cell_corrections(annotated: DataFrame, spec: TableSpec) -> DataFrame:
    """One row per corrected or flagged cell of a cleaned, annotated table."""
    return (annotated.where(F.size(CORRECTIONS) > 0)
            .select(F.lit(spec.name).alias("table_name"), key_json(spec.pk).alias("primary_key"),
                    F.inline(CORRECTIONS))
            .withColumn("column_name", F.when(F.col("column_name") != "", F.col("column_name")))
            .withColumn("rows", F.lit(1).cast("bigint")).select(*LOG_COLUMNS))


def dropped_corrections(raw: DataFrame, spec: TableSpec) -> DataFrame:
    """Dropped duplicates: one row per key, ``rows`` says how many raw rows it stands for."""
    none = F.lit(None).cast("string")
    return dedupe.dropped_duplicates(raw, spec.pk).select(
        F.lit(spec.name).alias("table_name"), key_json(spec.pk).alias("primary_key"), none.alias("column_name"),
        none.alias("original_value"), none.alias("corrected_value"),
        F.lit("duplicate_raw_keep_max_completeness").alias("reason_code"),
        F.col("rows_dropped").alias("rows"))


def corrections_log(raw: Mapping[str, DataFrame], annotated: Mapping[str, DataFrame],
                    specs: Mapping[str, TableSpec]) -> DataFrame:
    """Corrections of all tables: dropped duplicates and cells."""
    out = None
    for name, df in annotated.items():
        part = dropped_corrections(raw[name], specs[name]).unionByName(cell_corrections(df, specs[name]))
        out = part if out is None else out.unionByName(part)
    return out


def stamp(df: DataFrame, run_id: str, at: str) -> DataFrame:
    """Run id and time in front, as the log files carry them."""
    return df.select(F.lit(run_id).alias("etl_run_id"), F.lit(at).alias("timestamp"), "*")


def metrics_long(wide: DataFrame, table: str) -> DataFrame:
    """One-row frame of counts to long form (table, metric, value)."""
    cells = [F.struct(F.lit(c).alias("metric"), F.col(c).cast("bigint").alias("value")) for c in wide.columns]
    return wide.select(F.lit(table).alias("table_name"), F.inline(F.array(*cells)))


def table_metrics(raw: DataFrame, annotated: DataFrame, spec: TableSpec, identical_by: str = "key",
                  rows: tuple[int, int] | None = None) -> DataFrame:
    """Long metric log of one table: rows in and out, duplicates, null keys, post-clean duplicates.

    ``rows``: of the raw and of the annotated table, where their writes counted them; the dedupe alone drops rows."""
    norm = f"{spec.pk}_norm"
    if rows is None:
        before = dedupe.dedupe_counts(raw, spec.pk)
    else:
        before = raw.sparkSession.range(1).select(
            F.lit(rows[0]).alias("rows_in"), F.lit(rows[1]).alias("rows_after_raw_dedupe"), F.lit(rows[0] - rows[1]).alias("duplicates_raw_removed"))
    before = before.withColumn("rows_initial", F.col("rows_in"))
    after = annotated.agg(F.count(F.lit(1)).alias("rows_out"), F.count_if(F.col(norm).isNull()).alias("pk_null_count"))
    same = dedupe.identical_count(annotated, spec.pk, spec.clean_columns, identical_by)
    return (metrics_long(before, spec.name).unionByName(metrics_long(after, spec.name))
            .unionByName(metrics_long(same, spec.name)))
