"""What a query builds: a table that it does not need stays unwritten, and the result is that of the written tables."""

from __future__ import annotations

import time

import pytest

from pyspark.sql import functions as F

from subrev.functions.reasons import CORRECTION_TYPE, RuleLog
from subrev.operators import audit, dedupe, features, ledger, quality, validate
from subrev.plans import catalog, runs, stages
from subrev.specs import TABLES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def data(spark):
    d = catalog.Data(spark, SF_DIR)
    yield d
    d.store.close()


def rows(df):
    return sorted(map(str, df.collect()))


def test_validation_checks_write_the_subscriptions_only(data):
    got = rows(catalog._QUERIES["validation_checks"](data))
    assert set(data.features._made) == {"subscriptions"} and "feature_usage" not in data.clean._made
    assert got == rows(validate.validation_checks(data.features.all(catalog._VALIDATED)))


def test_deep_validation_writes_no_ranks_and_no_cohorts(data):
    got = rows(catalog._QUERIES["deep_validation"](data))
    assert set(data.features._made) == {"subscriptions", "first_use"}
    t = data.features.all()
    assert got == rows(validate.deep_validation(t["subscriptions"], t["accounts"], t["first_use"], t["cohorts"]))


@pytest.mark.parametrize("query, clean_made, features_made", [
    ("row_counts", {"churn_events", "accounts", "subscriptions", "feature_usage", "support_tickets"}, {"subscriptions"}),
    ("revenue_changes", {"churn_events", "accounts", "subscriptions"}, {"subscriptions"}),
    ("constant_columns", {"churn_events", "accounts", "subscriptions", "feature_usage", "support_tickets"},
     {"subscriptions", "support_events", "support_by_account", "accounts"}),
    ("schema_doc", {"churn_events", "accounts", "subscriptions", "feature_usage", "support_tickets"},
     {"subscriptions", "support_events", "support_by_account", "accounts"}),
    ("feature_usage_distribution", {"feature_usage"}, set()),
    ("acct_mrr_stats_global", {"churn_events", "accounts", "subscriptions"}, {"subscriptions"}),
    ("clean_usage", {"feature_usage"}, set())])
def test_tables_a_query_writes(data, query, clean_made, features_made):
    lazy = rows(catalog._QUERIES[query](data))
    assert (set(data.clean._made), set(data.features._made)) == (clean_made, features_made)
    data.features.all()
    assert lazy == rows(catalog._QUERIES[query](data))


@pytest.mark.parametrize("query", ["corrections_log", "dq_summary", "reason_lookup", "missingness"])
def test_no_raw_table_is_landed_and_no_job_is_run(data, query):
    assert catalog._QUERIES[query](data).count() > 0
    assert set(data.landed) == {"accounts"} and not data._stages
    assert not {"usage_monthly", "feature_month", "first_use"} & set(data.features._made)


def test_repriced_ledger_rows_stay_with_their_subscription(spark):
    subs = spark.sql("""select 's' subscription_id, 'a' account_id, 10.0D mrr_clean, date'2024-01-15' start_date, date'2024-03-01' end_date
                        union all select 't', 'a', 0.0D, date'2024-02-01', null""")
    prices = spark.sql("select 's' subscription_id, '2024-02' month, 25.0D mrr union all select 't', '2024-02', 5.0D")
    out = ledger.ledger_with_prices(subs, prices, "2024-03-31")
    got = sorted((r.subscription_id, r.month, r.mrr, r.prev_mrr) for r in out.collect())
    assert got == [("s", "2024-01", 10.0, 0.0), ("s", "2024-02", 25.0, 10.0), ("s", "2024-03", 10.0, 25.0), ("s", "2024-04", 0.0, 10.0),
                   ("t", "2024-02", 0.0, 0.0), ("t", "2024-03", 0.0, 0.0)]
    assert "Window" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_equal_rows_are_flagged_by_a_digest(spark):
    df = spark.sql("""select pk, x, array() dirty_row_reason, array() corrections from values ('a', 'u'), ('b', 'u'), ('c', null), ('d', null), ('e', 'v') t(pk, x)""")
    df = df.withColumns({"dirty_row_reason": df.dirty_row_reason.cast("array<string>"), "corrections": df.corrections.cast(f"array<{CORRECTION_TYPE}>")})
    out = dedupe.flag_identical(df, "pk", ("x",), "signature")
    assert sorted(r.pk for r in out.where("dirty_row_flag").collect()) == ["a", "b", "c", "d"] and out.count() == 5
    assert "sha2" in out._jdf.queryExecution().analyzed().toString()


def test_rule_lists_are_compiled(spark):
    log = RuleLog()
    log.correct(F.col("id") > 1, "big", "id", F.col("id"))
    log.flag(F.col("id") % 2 == 0, "even")
    out = log.apply(spark.range(4))
    assert [(r.dirty_row_reason, len(r.corrections)) for r in out.orderBy("id").collect()] == [(["even"], 0), ([], 0), (["big", "even"], 1), (["big"], 1)]
    assert "lambda" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_reports_run_no_other_job(data, monkeypatch):
    for job in ("run_clean", "run_features"):
        monkeypatch.setattr(catalog.jobs, job, lambda *_: pytest.fail("the reports need no other job"))
    got = [r.artifact for r in catalog._QUERIES["report_run_summary"](data).collect()]
    assert sorted(got) == sorted(stages.REPORTS) and set(data._stages) == {"reports"} and not data.landed.keys() - {"accounts"}


def test_a_scan_and_a_shuffle_are_cut_into_parts_that_sort_in_memory(spark, tmp_path):
    rows = spark.range(1_200_000).select(F.concat(F.lit("U-"), F.col("id")).alias("pk"), F.sha2(F.col("id").cast("string"), 256).alias("cell"))
    rows.coalesce(1).write.option("parquet.block.size", 1 << 20).parquet(str(tmp_path / "rows"))
    size = sum(f.stat().st_size for f in (tmp_path / "rows").glob("*.parquet"))
    back = spark.read.parquet(str(tmp_path / "rows"))
    assert back.rdd.getNumPartitions() >= size // (4 << 20) > 8
    dedupe.keep_most_complete(back, "pk").write.parquet(str(tmp_path / "one"))
    assert len(list((tmp_path / "one").glob("*.parquet"))) >= size // (16 << 20) > 2


def test_the_clean_job_takes_the_counts_of_its_tables_once(data, monkeypatch):
    checked, real = [], quality._issues_clean
    monkeypatch.setattr(quality, "_issues_clean", lambda spec, df: checked.append(spec.name) or real(spec, df))
    monkeypatch.setattr(dedupe, "dedupe_counts", lambda *_: pytest.fail("the writes have counted these rows"))
    base = runs.folder(data.spark, data.stage("clean"))
    assert sorted(checked) == sorted(TABLES)
    monkeypatch.undo()
    raw, done = ({n: data.spark.read.parquet(f"{base}/{kind}/{n}") for n in TABLES} for kind in ("raw", "annotated"))
    counts = quality.summary_counts(raw, done, unique_keys=True)
    assert rows(counts) == rows(quality.summary_counts(raw, done))
    assert rows(quality.dq_validation_by_table(raw, done, counts=counts)) == rows(quality.dq_validation_by_table(raw, done))
    spec = TABLES["feature_usage"]
    known = raw[spec.name].count(), done[spec.name].count()
    assert known[0] > known[1]
    assert rows(audit.table_metrics(raw[spec.name], done[spec.name], spec, rows=known)) == rows(audit.table_metrics(raw[spec.name], done[spec.name], spec))


def test_dq_summary_scans_usage_and_tickets_once_and_does_not_write_them(data):
    got = rows(catalog._QUERIES["dq_summary"](data))
    assert not {"feature_usage", "support_tickets"} & set(data.clean._made)
    written = {n: data.clean[n] for n in TABLES}
    assert got == rows(catalog.present(quality.dq_summary(data.once, written), digits=6))
    flagged = quality.consistency_flags(written, "feature_usage")
    counts = {r.table_name: r for r in quality.summary_counts(data.once, written).collect()}["feature_usage"]
    assert counts.inconsistent_rows == flagged.where("_bad").count() and counts.rows_after == flagged.count()


def test_shuffle_files_go_when_a_table_is_written(data):
    held = data.spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    before = held.getAllFiles().size()
    data.store.put("few", data.spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.count(F.lit(1)).alias("n")).repartition(3))
    for _ in range(50):
        if held.getAllFiles().size() <= before:
            break
        time.sleep(0.1)
    assert held.getAllFiles().size() <= before and data.store.get("few").count() == 7


def test_wide_rules_are_not_one_method_that_is_never_compiled(data):
    assert int(data.spark.conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000


def test_rows_meet_parts_and_lines_as_whole_numbers(data):
    for name in ("feature_usage", "subscriptions", "churn_events"):
        plan = data.raw[name]._jdf.queryExecution().optimizedPlan().toString()
        below = plan[plan.index("Join LeftOuter"):].split("\n+- ")[0]
        assert "cast(l_shipdate" in plan or "cast(o_orderdate" in plan, name
        assert "date_format(cast(o_orderdate" not in below and "date_format(l_shipdate" not in plan, name


def test_distinct_estimates_rank_no_feature_month(data):
    got = rows(catalog._QUERIES["distinct_estimates"](data))
    assert set(data.features._made) == {"subscriptions", "cohorts"}
    assert "feature_usage" not in data.clean._made
    data.features.all()
    assert got == rows(catalog._QUERIES["distinct_estimates"](data))


def test_usage_rows_are_moved_once_for_their_months(spark):
    usage = spark.sql("""select * from values ('s', date'2024-01-05', 'f', 2L, 3L, 0L), ('s', date'2024-01-09', 'f', 1L, null, 1L), ('s', date'2024-01-09', 'g', null, 1L, 0L),
                         ('s', date'2024-02-01', null, 4L, 4L, null), (null, null, 'f', 1L, 1L, 1L) t(subscription_id, usage_date, feature_name, usage_count, usage_duration_secs, error_count)""")
    seen = []
    out = features.usage_monthly(usage, lambda df: seen.append(df) or df)
    got = {(r.subscription_id, r.usage_month): tuple(r[c] for c in seen[0].columns[2:7]) for r in out.collect()}
    assert got == {("s", "2024-01"): (3, 4.0, 2, 1, 31), ("s", "2024-02"): (4, 4.0, 0, 0, 29), (None, None): (1, 1.0, 1, 1, 0)}
    assert seen[0]._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1


def test_feature_months_are_added_up_once_for_rows_and_ranks(data):
    kept = []
    tables = stages.FeatureTables(data.clean, catalog.AS_OF, lambda name, df: kept.append(name) or data.store.put(f"once/{name}", df))
    out = tables["feature_month"]
    assert "feature_month_base" in kept and rows(out) == rows(data.features.view("feature_month"))
