from conftest import by_key

import pytest
from pyspark.sql import functions as F

from subrev import specs
from subrev.operators import clean, dedupe, faults, quality, validate
from subrev.plans.stages import CleanTables


@pytest.fixture
def small(spark, make):
    raw = {n: make(s) for n, s in specs.TABLES.items()}
    raw["accounts"] = make(specs.ACCOUNTS, {"account_id": "A-1", "account_name": "x", "signup_date": "01-01-2024", "country": "unknown"},
                           {"account_id": "A-1", "account_name": "x"}, {"account_id": "A-2", "signup_date": "bad", "seats": "-4"})
    raw["support_tickets"] = make(specs.SUPPORT_TICKETS, {"ticket_id": "T-1", "resolution_time_hours": "-5"},
                                  {"ticket_id": "T-2", "resolution_time_hours": "oops"})
    return raw, CleanTables(raw, "2024-06-01")


def test_summary(small):
    raw, done = small
    row = quality.dq_summary(raw, done, ["accounts"]).first()
    assert (row.rows_before, row.rows_after, row.uniqueness, row.consistency) == (3, 2, 1.0, 1.0)
    filled = 3 + 2 + 2 + 1  # of 30 cells: ids, names, signup dates, seats ("unknown" is missing)
    assert row.completeness_before == round(filled / 30, 6)
    # issues: 30 - 9 blank cells, one negative, one missing and one malformed date
    assert row.issues_before == (30 - 9) + 1 + 2
    assert row.rows_with_issues_before == 3 and row.issues_after == 1


def test_empty_tables(small):
    raw, done = small
    row = quality.dq_summary(raw, done, ["subscriptions"]).first()
    assert (row.completeness_before, row.completeness_after, row.validity, row.issues_reduction_pct) == (1.0, 1.0, 1.0, None)


def test_errors_cap_and_order(small):
    _, done = small
    tickets = done["support_tickets"].withColumn("resolution_hours_clean", F.lit("bad"))
    assert [r.error_type for r in quality.table_errors(tickets, specs.SUPPORT_TICKETS).collect()] == ["numeric_parse_failed"] * 2
    assert quality.table_errors(tickets, specs.SUPPORT_TICKETS, cap=1).first().primary_key == "T-1"


def test_long_report_and_absent_columns(small):
    _, done = small
    annotated = dict(done)
    annotated["churn_events"] = annotated["churn_events"].drop("churn_date")
    got = {(r.table_name, r.column_name): r for r in quality.dq_long(annotated, top=None).collect()}
    assert got["churn_events", "churn_date"].pct_missing == 1.0
    assert got["support_tickets", "resolution_hours_clean"].pct_missing == 0.5
    profile = {(r.table_name, r.column_name): r for r in quality.dq_col_profile(annotated).collect()}
    assert profile["churn_events", "churn_date"].dtype == "missing" and profile["churn_events", "churn_date"].missing_pct == 1.0
    assert got["accounts", "country_clean"].pct_invalid == 0.0


def test_profile_and_metrics(small):
    raw, _ = small
    p = by_key(quality.column_profile(raw["accounts"], specs.ACCOUNTS), "column_name")
    assert p["seats"]["min"] == -4.0 and p["account_id"]["distinct_count"] == 2
    assert p["account_id"]["sample_values"] == '["A-1","A-2"]' and p["industry"]["sample_values"] is None
    m = by_key(quality.column_metrics(raw["accounts"], specs.ACCOUNTS), "column_name")
    assert m["seats"]["percent_negative"] == 0.333333 and m["signup_date"]["percent_invalid"] == 0.666667


def test_validation_verdict(spark):
    checks = spark.createDataFrame([("a", "error", 0), ("b", "warning", 5)], "check string, severity string, violations bigint")
    assert validate.verdict(checks).first().verdict == "PASS"
    assert validate.verdict(checks.union(checks.selectExpr("'c'", "'error'", "2L"))).first().verdict == "FAIL"
    t = spark.createDataFrame([(1, 2.0, None), (1, 3.0, None)], "a int, b double, c string")
    assert [r.column_name for r in validate.constant_columns({"t": t}, ["t"]).collect()] == ["a"]
    assert [r.column_name for r in validate.missingness({"t": t}, names=["t"]).collect()] == ["c"]
    assert validate.missing_columns({"accounts": t}) == [("accounts", "account_id")]
    doc = by_key(validate.schema_doc({"t": t}), "column_name")
    assert doc["c"]["null_pct"] == 100.0 and doc["c"]["sample"] == "NULL" and doc["b"]["sample"] == "2.0"


# ----------------------------------------------------------------------- faults
def base(spark, spec, n=2000):
    cols = [F.format_string("A-%06x", F.col("id") * 3 + 1).alias(spec.pk)]
    cols += [F.lit("5").alias(c) if spec.kind(c) == "numeric" else F.lit("True").alias(c) for c in spec.columns if c != spec.pk]
    return spark.range(n).select(*cols).select(*spec.columns)


@pytest.mark.parametrize("name", list(specs.TABLES))
def test_messy_copies(spark, name):
    spec = specs.TABLES[name]
    df = base(spark, spec)
    messy = faults.messy_copy(df, spec, "A-000001").cache()
    n = messy.count()
    assert 140 < n < 260 and messy.select(spec.pk).distinct().count() == n
    kept = messy.join(df, spec.pk, "left_semi").count()
    assert 0.2 * n < kept < 0.4 * n
    labels = {w for r in messy.select(faults.LABEL_COLUMN).collect() for w in r[0].split("; ")}
    allowed = {f.label.format(column=c) for f in faults.FAULTS[name] for c in f.columns} | {"no_issue"}
    assert labels == allowed
    again = faults.messy_copy(df.repartition(7), spec, "A-000001")
    assert sorted(map(str, again.collect())) == sorted(map(str, messy.collect()))
    assert faults.merge_raw(df, messy).count() == 2000 + n


def test_new_ids_skip_taken_ones(spark):
    rows = spark.createDataFrame([(f"X-{i}", i) for i in range(5)], "pk string, v int")
    taken = spark.createDataFrame([("X-001",), ("X-003",), ("Y-002",)], "pk string")
    got = [r.pk for r in faults.new_ids(rows, taken, "pk", "X-abc").orderBy("pk").collect()]
    assert got == ["X-002", "X-004", "X-005", "X-006", "X-007"]
    assert faults.infer_prefix_and_width("1234") == ("", 4)


def test_number_rows_is_gapless(spark):
    got = faults.number_rows(spark.range(0, 5000, 1, 9), F.col("id"), F.floor(F.col("id") / 100)).collect()
    assert all(r.id + 1 == r.row_index for r in got)


def test_cleaner_finds_injected_faults(spark):
    """Labels of the injected faults and the reasons of the cleaner agree."""
    spec = specs.SUPPORT_TICKETS
    messy = faults.messy_copy(base(spark, spec), spec, "A-000001").cache()
    reasons = clean.clean_support_tickets(messy.drop(faults.LABEL_COLUMN)).select(spec.pk, "dirty_row_reason")
    both = messy.select(spec.pk, faults.LABEL_COLUMN).join(reasons, spec.pk)
    pairs = {"null_satisfaction_score": "satisfaction_imputed", "null_priority": "priority_missing_flagged",
             "negative_resolution_time": "negative_resolution_time"}
    for row in both.collect():
        for label, code in pairs.items():
            assert (label in row[1].split("; ")) == (code in row[2])


def test_new_keys_never_repeat_when_the_counter_outgrows_its_width(spark):
    rows = spark.range(300).select(F.concat(F.lit("A-"), F.lpad(F.col("id").cast("string"), 2, "0")).alias("account_id"))
    got = [r.account_id for r in faults.new_ids(rows, rows, "account_id", "A-00").collect()]
    taken = {r.account_id for r in rows.collect()}
    assert len(set(got)) == 300 and not taken & set(got)


def test_a_sample_holds_at_least_one_row(spark):
    df = spark.range(50).select(F.col("id").cast("string").alias("k"))
    none = lambda name: F.lit(999) - F.col("k").cast("int")
    assert [r.k for r in faults.sample_rows(df, none).collect()] == ["49"]


@pytest.mark.parametrize("span", [4, 1 << 16])
def test_fresh_keys_fill_the_gaps(spark, monkeypatch, span):
    monkeypatch.setattr(faults, "SPAN", span)
    numbers = [1, 2, 3, 7, 8, 20, 21, 22, 40, 300, 5000, 1 << 50]
    odd = ["X-00A", "X-1", "X-zz", "X-", "Y-00c", "X-000", None, "X-" + "f" * 30]
    taken = spark.createDataFrame([(f"X-{n:03x}",) for n in numbers + [7, 7]] + [(x,) for x in odd], "pk string").repartition(3)
    rows = spark.createDataFrame([(f"old-{i}", i) for i in range(60)], "pk string, i int").repartition(4)
    got = [r.pk for r in faults.new_ids(rows, taken, "pk", "X-abc", order=F.col("i"), bucket=F.floor(F.col("i") / 7)).orderBy("i").collect()]
    free = [n for n in range(1, 100) if n not in numbers][:60]
    assert got == [f"X-{n:03x}" for n in free]
    assert [r.pk for r in faults.new_ids(rows, taken.limit(0), "pk", "X-abc", order=F.col("i"), bucket=F.lit(0)).orderBy("i").collect()] == [
        f"X-{n:03x}" for n in range(1, 61)]
    assert faults.new_ids(rows.limit(0), taken, "pk", "X-abc").count() == 0


def test_fresh_keys_read_each_side_once(spark, tmp_path):
    spark.range(500).select(F.concat(F.lit("o"), F.col("id").cast("string")).alias("pk")).write.parquet(str(tmp_path / "rows"))
    spark.range(1, 400, 3).select(F.concat(F.lit("X-"), F.lpad(F.lower(F.hex("id")), 3, "0")).alias("pk")).write.parquet(str(tmp_path / "taken"))
    plans = []

    def keep(name, df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        df.write.parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name))

    out = faults.new_ids(spark.read.parquet(str(tmp_path / "rows")), spark.read.parquet(str(tmp_path / "taken")), "pk", "X-abc", keep=keep)
    plans.append(out._jdf.queryExecution().executedPlan().toString())
    for side in ("rows", "taken"):
        assert sum(p.count(f"{tmp_path}/{side}") for p in plans) == 1
    assert not any("Range (" in p for p in plans)
    assert out.distinct().count() == 500


def test_profiles_move_digests(spark):
    raw = {"accounts": spark.createDataFrame([("A-1", "x" * 50)], "account_id string, account_name string")}
    plan = quality.column_metrics(raw["accounts"], specs.ACCOUNTS)._jdf.queryExecution().executedPlan().toString()
    for line in plan.splitlines():
        assert not ("Exchange hashpartitioning" in line and "account_" in line)
    assert "xxhash64" in plan


def test_summary_reads_a_table_twice_at_most(spark, tmp_path):
    spec = specs.CHURN_EVENTS
    spark.createDataFrame([tuple(None for _ in spec.columns)], spec.raw_schema).write.parquet(str(tmp_path / "raw"))
    raw = {"churn_events": spark.read.parquet(str(tmp_path / "raw"))}
    CleanTables(raw, "2024-01-01")["churn_events"].write.parquet(str(tmp_path / "done"))
    done = {"churn_events": spark.read.parquet(str(tmp_path / "done"))}
    plan = quality.dq_summary(raw, done)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 2


def test_identical_groups_by_digest_and_by_key(spark):
    rows = [("k1", "a", 1), ("k2", "a", 1), ("k3", "b", None), ("k4", "b", None), ("k5", "c", 2), ("k1", "a", 1), ("k5", "d", 2)]
    df = spark.createDataFrame(rows, "pk string, x string, y int")
    by_signature = dedupe.identical_groups(df, "pk", ("x", "y"), "signature")
    assert sorted(r.copies for r in by_signature.collect()) == [2, 3]
    assert [(r.pk, r.copies) for r in dedupe.identical_groups(df, "pk", ("x", "y"), "key").collect()] == [("k1", 2)]


def test_many_to_one(spark):
    left = spark.createDataFrame([("a", "2024-01-01"), ("b", "2024-03-01"), (None, "2020-01-01")], "account_id string, d string")
    left = left.select("account_id", F.to_date("d").alias("first_use_date"))
    right = spark.createDataFrame([("a", "2024-02-01"), ("b", "2024-02-01"), (None, "2024-02-01"), (None, "2024-02-02")], "account_id string, d string")
    right = right.select("account_id", F.to_date("d").alias("signup_date"))
    assert [r.account_id for r in validate.first_use_before_signup(left, right).collect()] == ["a"]
    twice = right.unionByName(right.where("account_id = 'b'"))
    with pytest.raises(Exception, match="account_id b occurs 2 times"):
        validate.first_use_before_signup(left, twice).collect()
