from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subrev import specs
from subrev.plans import jobs, runs
from subrev.plans.stages import REPORTS, FeatureTables
from subrev.sources import adapters, files


def test_raw_csv_scan(spark, tmp_path):
    p = tmp_path / "accounts.csv"
    p.write_text('account_name,account_id,country,seats\n"Acme, Inc",A-1,NA,007\nnull,A-2,DE,\n')
    got = files.read_raw(spark, str(p), specs.ACCOUNTS)
    assert got.columns == list(specs.ACCOUNTS.columns) and {f.dataType for f in got.schema} == {T.StringType()}
    rows = {r.account_id: r for r in got.collect()}
    assert rows["A-1"].account_name == "Acme, Inc" and rows["A-1"].country is None and rows["A-1"].seats == "007"
    assert rows["A-2"].account_name is None and rows["A-2"].seats is None and rows["A-2"].industry is None
    assert files.read_raw(spark, str(tmp_path / "none.csv"), specs.ACCOUNTS).count() == 0


def test_clean_csv_scan_drops_repeated_columns(spark, tmp_path):
    p = tmp_path / "t.csv"
    p.write_text("id,day,id,amount,tags\n1,05-02-2024,9,1.5,\"[\"\"a\"\"]\"\n2,2024-02-06,9,x,\n")
    assert files.read_clean(spark, str(p)).columns == ["id", "day", "amount", "tags"]
    schema = T.StructType.fromDDL("id bigint, day date, amount double, tags array<string>, extra string")
    got = files.read_clean(spark, str(p), schema).orderBy("id").collect()
    assert [str(r.day) for r in got] == ["2024-02-05", "2024-02-06"] and got[0].tags == ["a"]
    assert got[1].amount is None and got[0].extra is None


def test_repeated_columns_of_a_frame(spark):
    df = spark.range(2).select(F.col("id"), (F.col("id") + 1).alias("x"), F.lit(5).alias("id"))
    assert files.drop_repeated_columns(df).columns == ["id", "x"]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", ["x", "y"], "n")], "k string, r array<string>, k_norm string")
    files.write_report(df, str(tmp_path / "r"))
    text = next(Path(tmp_path / "r").glob("*.csv")).read_text()
    assert text.splitlines()[0] == "k,r,k_norm" and "x" in text
    files.write_clean(df, str(tmp_path / "c"))
    assert spark.read.parquet(str(tmp_path / "c")).columns == ["k", "r"]
    assert not files.write_if_any(df.where("k = 'none'"), str(tmp_path / "d")) and not (tmp_path / "d").exists()
    assert files.reason_lookup(spark).count() == 31


@pytest.fixture(scope="module")
def run(spark, sf_dir, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("run"))
    return jobs.run_all(spark, adapters.raw_tables(spark, sf_dir), out, adapters.AS_OF, "run-1", "2024-01-01T00:00:00Z")


def test_jobs_write_every_artifact(spark, run):
    folders = {stage: Path(runs.folder(spark, r.root)) for stage, r in run.items()}
    assert {stage: str(f) for stage, f in folders.items()} == {stage: r.folder for stage, r in run.items()}
    assert {p.name for p in folders["reports"].iterdir()} == set(REPORTS) and len(REPORTS) == 24
    assert {p.name for p in (folders["clean"] / "clean").iterdir()} == set(specs.TABLES)
    assert {p.name for p in (folders["clean"] / "logs").iterdir()} == {
        "corrections_log", "validation_summary_long", "dirty_reason_lookup"}
    assert set(FeatureTables.NAMES) <= {p.name for p in folders["features"].iterdir()}
    assert {"validation_checks", "verdict", "schema", "deep_validation"} <= {
        p.name for p in (folders["features"] / "_diagnostics").iterdir()}


def test_run_summary_counts_what_was_written(spark, run):
    clean = {r["artifact"]: r for r in runs.summary(spark, run["clean"].root).collect()}
    assert {r["run_id"] for r in clean.values()} == {"run-1"} and {r["at"] for r in clean.values()} == {"2024-01-01T00:00:00Z"}
    for n in specs.TABLES:
        table = spark.read.parquet(f"{run['clean'].folder}/clean/{n}")
        assert clean[f"clean/{n}"]["rows_in"] == spark.read.parquet(f"{run['clean'].folder}/raw/{n}").count()
        assert clean[f"clean/{n}"]["rows_out"] == table.count()
        assert clean[f"clean/{n}"]["rows_flagged"] == table.where("dirty_row_flag").count()
    features = {r["artifact"]: r for r in runs.summary(spark, run["features"].root).collect()}
    assert features["cohorts"]["rows_in"] == clean["clean/subscriptions"]["rows_out"] and features["cohorts"]["rows_flagged"] is None


def test_counts_cost_no_job(spark, tmp_path):
    spark.range(0, 1000, 1, 4).write.parquet(str(tmp_path / "in"))
    df = spark.read.parquet(str(tmp_path / "in"))
    stage = runs.StageRun(spark, str(tmp_path / "s"), "r", "t")
    spark.sparkContext.setJobGroup("counted", "")
    stage.write("x", df)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("counted")) == 1
    assert stage.counts["x"] == (None, 1000, None)


def test_a_killed_stage_leaves_the_former_one(spark, sf_dir, tmp_path, monkeypatch):
    root, raw = str(tmp_path / "clean"), adapters.raw_tables(spark, sf_dir)
    assert runs.folder(spark, root) == root and runs.summary(spark, root).count() == 0
    stage = runs.StageRun(spark, root, "first", "t1")
    for n in ("accounts", "churn_events"):
        stage.write(f"clean/{n}", raw[n])
    stage.commit()
    before = {r["artifact"]: r["rows_out"] for r in runs.summary(spark, root).collect()}

    def broken(*_):
        raise RuntimeError("executor lost for good")

    monkeypatch.setattr(jobs.audit, "corrections_log", broken)
    with pytest.raises(RuntimeError, match="lost"):
        jobs.run_clean(spark, raw, root, adapters.AS_OF, "second", "t2")
    assert runs.folder(spark, root) == stage.folder and len(list((tmp_path / "clean" / "runs").iterdir())) == 2
    assert {r["artifact"]: r["rows_out"] for r in runs.summary(spark, root).collect()} == before
    assert spark.read.parquet(f"{runs.folder(spark, root)}/clean/accounts").count() == before["clean/accounts"]
    again = runs.StageRun(spark, root, "third", "t3")
    again.write("clean/accounts", raw["accounts"])
    assert [r["run_id"] for r in again.commit().collect()] == ["third"]
    assert runs.newest(spark, root)["seq"] == 2
    gone = runs.remove_older(spark, root)
    assert len(gone) == 2 and [p.name for p in (tmp_path / "clean" / "runs").iterdir()] == [again.folder.rsplit("/", 1)[-1]]
    assert spark.read.parquet(f"{runs.folder(spark, root)}/clean/accounts").count() == before["clean/accounts"]


def test_features_read_plain_folders_too(spark, run, tmp_path):
    got = jobs.run_features(spark, f"{run['clean'].folder}/clean", str(tmp_path / "f"), adapters.AS_OF, "r", "t")
    assert got.counts["subscriptions"][1:] == run["features"].counts["subscriptions"][1:]
    assert got.counts["subscriptions"][0] is None


def test_clean_csv_for_readers_outside(spark, tmp_path):
    df = spark.createDataFrame([("a", ["x", 'y"z'], "n"), ("b", [], None)], "k string, r array<string>, k_norm string")
    files.write_clean_csv(df, str(tmp_path / "c.csv"))
    back = files.read_clean(spark, str(tmp_path / "c.csv"), T.StructType.fromDDL("k string, r array<string>"))
    assert sorted((r.k, r.r) for r in back.collect()) == [("a", ["x", 'y"z']), ("b", [])]


def test_invariants_of_a_run(spark, run):
    """Totals that must agree between the tables and the reports of one run."""
    def table(n):
        return spark.read.parquet(f"{run['features'].folder}/{n}")

    def report(n):
        return spark.read.option("header", True).csv(f"{run['reports'].folder}/{n}")

    def total(df, c):
        return float(df.agg(F.sum(F.col(c).cast("double"))).first()[0])

    cohorts, changes = table("cohorts"), table("revenue_changes")
    assert cohorts.count() == total(report("cohort_retention"), "active_subs")
    kinds = {r.change_type: r["count"] for r in changes.groupBy("change_type").count().collect()}
    assert set(kinds) == {"new", "churn"}
    assert kinds["new"] == total(report("cohort_retention").where("months_since_signup = 0"), "active_subs")
    assert kinds["churn"] == total(report("cohort_churn_lifecycle"), "churned_subs")
    gains = total(report("saas_quick_ratio"), "gains")
    assert abs(gains - total(report("cohort_nrr_curve").where("months_since_signup = 0"), "mrr")) < 0.01
    assert table("usage_monthly").agg(F.sum("usage_count_month")).first()[0] == table("feature_month").agg(
        F.sum("usage_count")).first()[0]
