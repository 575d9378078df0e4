from datetime import date

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from subrev.functions import cases, dates, numeric, reasons, text
from subrev.functions import sketches
from subrev.functions.quantiles import describe, exact_quantiles
from subrev.specs import ACCOUNTS, classify_name


def column(spark, values, expr, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}").coalesce(1)
    return [r.x for r in df.select("i", expr(F.col("v")).alias("x")).orderBy("i").collect()]


def test_signed_number(spark):
    got = column(spark, ["1,234.50", "(99)", "-1", "abc", "", "  ", None, "$ 5", "1.2.3", "--4", "-", "1,234,567"],
                 text.signed_number)
    assert got == [1234.5, -99.0, -1.0, None, None, None, None, 5.0, None, None, None, 1234567.0]


def test_ids_and_words(spark):
    assert column(spark, [" A-1 ", "", "NaN", "none", "NULL", None, "x"], text.normalize_id) == [
        "A-1", None, None, None, None, None, "x"]
    assert column(spark, ["unknown", "NA", "x", None, " "], text.is_missing_word) == [True, True, False, True, True]
    assert column(spark, ["unknown", "null", "x", None, " "], text.is_missing_value) == [False, True, False, True, True]
    assert column(spark, ["True", "1", "YES", "no", None], text.is_true) == [True, True, True, False, False]


def test_dates(spark):
    values = ["05-02-2024", "2024-02-05", "31-02-2024", "", None, " 05-02-2024 ", "5-2-2024"]
    d = date(2024, 2, 5)
    assert column(spark, values, dates.parse_date) == [d, None, None, None, None, d, None]
    assert column(spark, values, dates.parse_day_first)[:6] == [d, d, None, None, None, d]
    assert column(spark, values, dates.has_date_format) == [True, False, True, False, False, True, False]
    assert column(spark, ["05-02-2024 10:11:12"], dates.parse_date_part) == [d]
    assert column(spark, ["05-02-2024 10:11:12", "2024-02-05"], lambda c: dates.month_key(dates.parse_day_first_time(c))) == [
        "2024-02", "2024-02"]


def test_calendar_months_are_not_elapsed_months(spark):
    got = column(spark, ["31-01-2024"], lambda c: dates.months_between(dates.parse_date(c), dates.as_date_lit("2024-03-01")))
    assert got == [2]
    assert column(spark, ["10-02-2024"], lambda c: dates.days_in_month(dates.parse_date(c))) == [29]


def test_numeric_guards(spark):
    assert column(spark, [-1.0, 2.0, None], numeric.clamp_nonneg, "double") == [0.0, 2.0, None]
    assert column(spark, [0.0, 2.0, None], lambda c: numeric.ratio(F.lit(1), c), "double") == [None, 0.5, None]
    assert column(spark, [0.0, 4.0], lambda c: numeric.ratio_or_zero(F.lit(1), c), "double") == [0.0, 0.25]
    assert column(spark, [0.5, 1.5, None], numeric.cap_one, "double") == [0.5, 1.0, None]
    assert column(spark, [0.125, 0.135, 2.5], lambda c: numeric.money(c), "double") == [0.12, 0.14, 2.5]
    assert column(spark, [0.009, -0.009, 0.01], numeric.same_amount, "double") == [True, True, False]


def test_cases(spark):
    assert column(spark, ["10", "11", "50", "51", "x", None, "10.5"], cases.seat_bucket) == [
        "01_to_10", "11_to_25", "26_to_50", "50+", "unknown", "unknown", "11_to_25"]
    assert column(spark, [0.0, 23.9, 24.0, 72.0, None], cases.resolution_bucket, "double") == [
        "<24h", "<24h", "24-72h", ">72h", "unknown"]
    assert column(spark, [" High", "p2", "3", "urgent", "7.5", None], cases.priority_score) == [3.0, 2.0, 1.0, None, 7.5, None]
    assert column(spark, [0.0, 1999.9, 2000.0, 9999.0, 10000.0], cases.segment, "double") == [
        "SMB", "SMB", "Mid-Market", "Mid-Market", "Enterprise"]
    assert column(spark, [1.0, 0.0], lambda c: cases.quick_ratio(c, F.lit(0.0)), "double") == [999.0, 0.0]
    assert column(spark, [4.0, 0.0], lambda c: cases.quick_ratio(c, F.lit(2.0)), "double") == [2.0, 0.0]


@pytest.mark.parametrize("now,before,kind", [(5.0, 0.0, "new"), (0.0, 5.0, "churn"), (6.0, 5.0, "expansion"),
                                             (4.0, 5.0, "contraction"), (5.0, 5.001, "unchanged"), (0.0, 0.0, "unchanged")])
def test_change_type(spark, now, before, kind):
    assert column(spark, [now], lambda c: cases.change_type(c, F.lit(before)), "double") == [kind]


@pytest.mark.parametrize("churned,trial,end,status", [(True, "True", None, "churned"), (False, "True", None, "trial"),
                                                      (False, "False", "2024-01-01", "closed"), (False, None, None, "active"),
                                                      (False, "yes", "2024-01-01", "trial")])
def test_status(spark, churned, trial, end, status):
    df = spark.createDataFrame([(churned, trial, end)], "c boolean, t string, e string")
    assert df.select(cases.subscription_status(F.col("c"), F.col("t"), F.col("e").cast("date"))).first()[0] == status


def test_reason_lists(spark):
    assert column(spark, ['["a", "b"]', "a; b", "a,b", "[]", "", None, "nan"], reasons.parse_reasons) == [
        ["a", "b"], ["a", "b"], ["a", "b"], [], [], [], []]
    df = spark.createDataFrame([(["a"],), (None,)], "r array<string>")
    out = df.select(reasons.append_reasons(F.col("r"), (F.lit(True), "a"), (F.lit(True), "b"), (F.lit(None).cast("boolean"), "c"))
                    .alias("r"))
    assert sorted(tuple(r.r) for r in out.collect()) == [("a", "b"), ("a", "b")]


def test_declared_types_win_over_names():
    assert classify_name("country") == "numeric" and ACCOUNTS.kind("country_clean") == "categorical"
    assert [classify_name(c) for c in ("ticket_id", "start_date", "mrr_amount", "plan_tier", "note")] == [
        "id", "date", "numeric", "categorical", "text"]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.integers(-5, 5).map(float), st.floats(-1e6, 1e6, allow_nan=False)), min_size=1, max_size=60),
       st.sampled_from([3, 50, 10000]))
def test_quantiles_are_exact_whatever_the_sketch(spark, values, accuracy):
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(3)
    probs = (0.0, 0.25, 0.5, 0.9, 0.95, 1.0)
    row = exact_quantiles(df, {"x": F.col("v")}, probs, accuracy).first()
    present = [v for v in values if v is not None]
    if not present:
        assert row is None
        return
    want = np.quantile(present, probs)
    assert np.allclose([row[f"q{i}"] for i in range(len(probs))], want, rtol=1e-9, atol=1e-9)


def test_quantiles_of_several_columns_with_a_hot_value(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7.0).otherwise(F.col("id") * 1.0).alias("a"),
                                  (F.col("id") % 2).cast("double").alias("b"))
    rows = {r.name: r for r in exact_quantiles(df, {"a": F.col("a"), "b": F.col("b")}, (0.5, 0.95), 100).collect()}
    a = [7.0 if i % 3 == 0 else float(i) for i in range(3000)]
    assert np.isclose(rows["a"].q0, np.quantile(a, 0.5)) and np.isclose(rows["a"].q1, np.quantile(a, 0.95))
    assert rows["b"].q0 == 0.5 and rows["b"].q1 == 1.0


def test_describe(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,), (None,)], "v double")
    got = {r["index"]: r["v"] for r in describe(df, F.col("v"), "v").collect()}
    assert got["count"] == 4 and got["mean"] == 4.0 and got["min"] == 1.0 and got["max"] == 10.0
    assert np.isclose(got["std"], np.std([1, 2, 3, 10], ddof=1)) and got["75%"] == 4.75 and got["50%"] == 2.5


def test_describe_approx_and_without_values(spark):
    df = spark.range(20_000).select((F.col("id") % 9973).cast("double").alias("v"))
    exact = {r["index"]: r["v"] for r in describe(df, F.col("v"), "v").collect()}
    near = {r["index"]: r["v"] for r in describe(df, F.col("v"), "v", approx=True).collect()}
    for name in ("count", "mean", "min", "max"):
        assert np.isclose(exact[name], near[name])
    for name in ("25%", "50%", "75%"):
        assert abs(exact[name] - near[name]) <= 2 * sketches.RANK_ERROR * 9973
    for approx in (False, True):
        none = {r["index"]: r["v"] for r in describe(df.where("v < 0"), F.col("v"), "v", approx).collect()}
        assert none["count"] == 0 and none["50%"] is None


def test_quantiles_beyond_the_whole_sort(spark):
    """Bands of a sketch, among them one inside a value that most rows share."""
    df = spark.range(0, 5000, 1, 5).select(F.when(F.col("id") % 5 < 3, 7.0).otherwise(F.col("id") * 1.0).alias("v"))
    values = [7.0 if i % 5 < 3 else float(i) for i in range(5000)]
    probs = (0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 0.999, 1.0)
    row = exact_quantiles(df, {"x": F.col("v")}, probs, accuracy=20).first()
    assert np.allclose([row[f"q{i}"] for i in range(len(probs))], np.quantile(values, probs))


def test_quantile_plan_is_short(spark, tmp_path):
    spark.range(1000).withColumn("v", F.rand(1)).write.parquet(str(tmp_path / "t"))
    plan = describe(spark.read.parquet(str(tmp_path / "t")), F.col("v"), "v")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 7 and plan.count("FileScan parquet") <= 2


def test_sketches_merge_upward(spark):
    df = spark.range(0, 30_000, 1, 4).select((F.col("id") % 12).alias("month"), (F.col("id") % 7000).cast("string").alias("key"), F.col("id").alias("v"))
    kept = df.groupBy("month").agg(sketches.distinct_sketch(F.col("key")).alias("d"), sketches.quantile_sketch(F.col("v")).alias("q"))
    one = kept.agg(sketches.merged_distinct(F.col("d")).alias("d"), sketches.merged_quantiles(F.col("q")).alias("q"))
    row = one.select(sketches.distinct_estimate(F.col("d")).alias("n"), *sketches.estimated_quantiles(one, "q", (0.1, 0.5, 0.9))).first()
    assert abs(row.n - 7000) <= 0.03 * 7000
    for got, p in zip((row.q0, row.q1, row.q2), (0.1, 0.5, 0.9)):
        assert abs(got / 30_000 - p) <= 2 * sketches.RANK_ERROR
    empty = df.where("v < 0").agg(sketches.distinct_sketch(F.col("key")).alias("d"))
    assert empty.select(sketches.distinct_estimate(F.col("d"))).first()[0] == 0
