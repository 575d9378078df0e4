"""Shapes of the plans behind the stages, on tables that are not written in between."""

import pytest
from conftest import SF_DIR

from subrev.operators import impute
from subrev.plans.stages import CleanTables, FeatureTables
from subrev.sources import adapters
from subrev.specs import TABLES


@pytest.fixture(scope="module")
def plans(spark):
    clean = CleanTables(adapters.raw_tables(spark, SF_DIR), adapters.AS_OF)
    tables = FeatureTables(clean, adapters.AS_OF)
    out = {f"clean_{n}": clean[n] for n in TABLES} | {n: tables[n] for n in ("subscriptions", "first_use", "support_events", "revenue_changes", "cohorts")}
    return {n: df._jdf.queryExecution().executedPlan().toString() for n, df in out.items()}


def test_no_cross_join_and_no_python(plans):
    for name, plan in plans.items():
        for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "ArrowEval"):
            assert bad not in plan, name
        assert "Exchange" in plan and "FileScan parquet" in plan


def test_dedupe_ranks_below_its_exchange(plans):
    for name in ("clean_churn_events", "clean_support_tickets", "clean_feature_usage"):
        assert "WindowGroupLimit" in plans[name] and "Partial" in plans[name], name


def test_scans_read_only_what_is_used(plans):
    scans = [line for line in plans["clean_churn_events"].splitlines() if "FileScan" in line]
    assert scans and not any("o_comment" in s or "c_address" in s for s in scans)


def test_ledger_adds_no_exchange(plans):
    assert plans["revenue_changes"].count("Exchange hashpartitioning") <= plans["subscriptions"].count("Exchange hashpartitioning")


def test_lookups_aggregate_what_is_asked_for(spark, plans, tmp_path):
    """The keys that rows ask for reduce the raw side below its partial aggregate."""
    assert all("LeftSemi" in plans[n] for n in ("clean_accounts", "clean_subscriptions"))
    spec = TABLES["accounts"]
    spark.createDataFrame([], spec.raw_schema).write.parquet(str(tmp_path / "raw"))
    raw = spark.read.parquet(str(tmp_path / "raw"))
    lines = impute.impute_accounts(raw, raw, ("country", "industry"))._jdf.queryExecution().executedPlan().toString().splitlines()
    semi = [i for i, line in enumerate(lines) if "LeftSemi" in line]
    assert len(semi) == 2 and all(any("partial_min_by" in line for line in lines[i - 3: i]) for i in semi)
