"""The driver tables seen as the five raw entities.

Every raw column is text, dates are dd-mm-yyyy, and the faults a cleaner must
handle come from the data itself or from its key (nulls, signs, formats,
duplicate copies).  Whole tables are read: no rule drops a row of its source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = "2002-01-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _id(prefix: str, c: Column) -> Column:
    return F.concat(F.lit(prefix), c.cast("string"))


def _day(c: Column) -> Column:
    return F.date_format(c, "dd-MM-yyyy")


def _yes(c: Column) -> Column:
    return F.when(c, "True").otherwise("False")


def _cents(c: Column) -> Column:
    """Whole cents as a text with two decimals."""
    return F.concat(F.floor(c / 100).cast("string"), F.lit("."), F.lpad((c % 100).cast("string"), 2, "0"))


def _none() -> Column:
    return F.lit(None).cast("string")


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers, plus what the event stream knows of every user.

    A user with a ``signup`` event is registered again under a new id and an
    upper-case name; one with an ``error`` event leaves a sparse copy under the
    same id, as does a user that is no customer.
    """
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    first = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.min("o_orderdate").alias("first_order"))
    cust = (table(spark, sf_dir, "customer")
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left"))
    key, bal = F.col("c_custkey"), F.col("c_acctbal")
    base = cust.join(first, F.col("o_custkey") == key, "left").select(
        _id("A-", key).alias("account_id"), F.col("c_name").alias("account_name"),
        F.when(key % 10 != 3, F.col("c_mktsegment")).alias("industry"),
        F.when(key % 7 != 0, F.col("n_name")).alias("country"),
        _day(F.col("first_order")).alias("signup_date"),
        _id("region_", F.col("n_regionkey")).alias("referral_source"),
        F.when(bal < 0, None).when(bal < 3000, "Basic").when(bal < 7000, "Pro").otherwise("Enterprise")
        .alias("plan_tier"),
        (key % 60 + 1).cast("string").alias("seats"), _yes(bal < 0).alias("is_trial"),
        _yes(key % 4 == 0).alias("churn_flag"))
    of = F.col("event_type")
    seen = (table(spark, sf_dir, "events").groupBy("user_id")
            .agg(F.min(F.when(of == "signup", F.col("ts"))).alias("first_seen"), F.max(of == "error").alias("failed"))
            .join(cust, F.col("user_id") == key, "left"))
    sparse = F.col("failed") | key.isNull()
    kinds = F.array_compact(F.array(F.when(F.col("first_seen").isNotNull(), F.lit(True)), F.when(sparse, F.lit(False))))
    seen = seen.withColumn("again", F.explode(kinds))
    again, key = F.col("again"), F.col("user_id")
    copies = seen.select(
        F.when(again, _id("E-", key)).otherwise(_id("A-", key)).alias("account_id"),
        F.when(again, F.upper("c_name")).otherwise(F.col("c_name")).alias("account_name"),
        F.when(~again, F.col("c_mktsegment")).alias("industry"),
        F.when(~again, F.col("n_name")).alias("country"),
        F.when(again, _day(F.col("first_seen"))).alias("signup_date"),
        F.when(again, "events").alias("referral_source"), _none().alias("plan_tier"), _none().alias("seats"),
        F.when(again, "False").alias("is_trial"), F.when(again, "False").alias("churn_flag"))
    return base.unionByName(copies)


def subscriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as subscriptions; an order with a 50-piece line also appears as a sparse copy."""
    lines = (table(spark, sf_dir, "lineitem").groupBy("l_orderkey")
             .agg(F.max(F.to_date("l_shipdate")).alias("last_ship"), F.max("l_quantity").alias("top_quantity")))
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", F.to_date("o_orderdate").alias("o_orderdate"),
        F.floor("o_totalprice").alias("price")).join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    key, prio = F.col("o_orderkey"), F.col("o_orderpriority")
    price = F.col("price")
    free = key % 46 == 0
    rare_seat = prio.isin("1-URGENT", "5-LOW") & (key % 10 < 2)
    copies = F.when(F.col("top_quantity") == 50, F.array(F.lit(False), F.lit(True))).otherwise(
        F.array(F.lit(False)))
    o = o.withColumn("sparse", F.explode(copies))
    full = ~F.col("sparse")
    return o.select(
        _id("S-", key).alias("subscription_id"), _id("A-", F.col("o_custkey")).alias("account_id"),
        _day(F.col("o_orderdate")).alias("start_date"),
        F.when(full & (F.col("o_orderstatus") == "F"), _day(F.col("last_ship"))).alias("end_date"),
        F.when(full & prio.isin("1-URGENT", "2-HIGH"), "Enterprise")
        .when(full & (prio == "3-MEDIUM"), "Pro")
        .when(full & (prio == "4-NOT SPECIFIED"), "Basic").alias("plan_tier"),
        F.when(rare_seat, key % 10 + 100).otherwise(key % 60 + 1).cast("string").alias("seats"),
        F.when(full & (key % 17 != 0), F.when(free, "0").otherwise(_cents(price))).alias("mrr_amount"),
        F.when(full & (key % 19 != 0), F.when(free, "0").otherwise(_cents(price * 12))).alias("arr_amount"),
        _yes(key % 23 == 0).alias("is_trial"), _yes(key % 11 == 0).alias("upgrade_flag"),
        _yes(key % 13 == 0).alias("downgrade_flag"), _yes(F.col("o_orderstatus") == "F").alias("churn_flag"),
        F.when(key % 3 == 0, "annual").otherwise("monthly").alias("billing_frequency"),
        _yes(key % 5 != 0).alias("auto_renew_flag"))


def feature_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as usage rows; line numbers repeat inside an order, so keys repeat too.

    A line meets its part as whole numbers, days and signs, which pack to half of what its doubles and timestamps take.
    """
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", (F.col("p_size") <= 5).alias("beta"))
    skey = F.col("l_suppkey")
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", F.to_date("l_shipdate").alias("day"), F.floor("l_extendedprice").alias("secs"),
        F.col("l_quantity").cast("bigint").alias("count"), ((F.col("l_tax") == 0) & (F.col("l_discount") == 0)).alias("unowned"),
        (skey % 37 == 0).alias("iso"), (skey % 41 == 0).alias("minus"), (F.col("l_returnflag") == "R").alias("returned"))
    li = li.join(part, F.col("l_partkey") == F.col("p_partkey"), "left")
    okey, pkey, secs, count = F.col("l_orderkey"), F.col("l_partkey"), F.col("secs"), F.col("count")
    return li.select(
        F.concat(F.lit("U-"), okey.cast("string"), F.lit("-"), F.col("l_linenumber").cast("string"))
        .alias("usage_id"),
        F.when(F.col("unowned"), _id("X-", okey)).otherwise(_id("S-", okey)).alias("subscription_id"),
        F.when(F.col("iso"), F.date_format("day", "yyyy-MM-dd")).otherwise(_day(F.col("day"))).alias("usage_date"),
        F.when(pkey % 29 != 0, F.col("p_brand")).alias("feature_name"),
        F.when(pkey % 31 == 0, -count).otherwise(count).cast("string").alias("usage_count"),
        F.when(F.col("minus"), -secs).otherwise(secs).cast("string").alias("usage_duration_secs"),
        F.when(F.col("returned"), "1").otherwise("0").alias("error_count"),
        _yes(F.col("beta")).alias("is_beta_feature"))


def support_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as tickets; one of less than an hour also appears as a sparse copy."""
    e = table(spark, sf_dir, "events")
    key, value = F.col("event_id"), F.col("value")
    copies = F.when(value < 1, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    e = e.withColumn("sparse", F.explode(copies))
    full = ~F.col("sparse")
    hours = _cents(F.round(value * 100).cast("bigint"))
    closed = F.timestamp_add("SECOND", F.floor(value * 3600).cast("int"), F.date_trunc("second", F.col("ts")))
    stamp = "dd-MM-yyyy HH:mm:ss"
    return e.select(
        _id("T-", key).alias("ticket_id"), _id("A-", F.col("user_id")).alias("account_id"),
        F.when(key % 53 != 0, F.date_format("ts", stamp)).alias("submitted_at"),
        F.when(F.col("event_type") != "view", F.date_format(closed, stamp)).alias("closed_at"),
        F.when(key % 37 == 0, F.concat(F.lit("-"), hours)).otherwise(hours).alias("resolution_time_hours"),
        F.when(full, F.element_at(F.array(*[F.lit(x) for x in ("high", "medium", "low", "urgent")]).cast(
            "array<string>"), F.when(key % 5 < 4, (key % 5 + 1).cast("int")))).alias("priority"),
        (key % 240).cast("string").alias("first_response_time_minutes"),
        F.when(full & (key % 6 != 0), (key % 6).cast("string")).alias("satisfaction_score"),
        _yes(F.col("event_type") == "error").alias("escalation_flag"))


def churn_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as churn events; cheap ones also as a sparse copy.

    Only a finished order of a customer with a balance under 2,500 has a date.
    """
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_mktsegment", "c_nationkey")
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderpriority", (F.col("o_orderstatus") == "F").alias("done"),
        F.to_date("o_orderdate").alias("o_orderdate"), (F.col("o_totalprice") < 50000).alias("cheap"))
    o = o.join(cust, F.col("o_custkey") == F.col("c_custkey"), "left")
    copies = F.when(F.col("cheap"), F.array(F.lit(False), F.lit(True))).otherwise(
        F.array(F.lit(False)))
    o = o.withColumn("sparse", F.explode(copies))
    full = ~F.col("sparse")
    bal, prio, seg = F.col("c_acctbal"), F.col("o_orderpriority"), F.col("c_mktsegment")
    gone = F.when(F.col("done") & (bal < 2500), F.date_add("o_orderdate", 30))
    return o.select(
        _id("C-", F.col("o_orderkey")).alias("churn_event_id"), _id("A-", F.col("o_custkey")).alias("account_id"),
        F.when(F.col("c_nationkey") == 24, F.date_format(gone, "yyyy-MM-dd")).otherwise(_day(gone))
        .alias("churn_date"),
        F.when(full & (prio == "1-URGENT"), "pricing").when(full & (prio == "2-HIGH"), "support")
        .when(full & (prio == "3-MEDIUM"), "features").when(full & (prio == "5-LOW"), "budget")
        .alias("reason_code"),
        F.when(F.col("c_nationkey") == 7, "pending")
        .when((bal < 0) & (seg == "BUILDING"), F.concat(F.lit("("), F.format_number(-bal, 2), F.lit(")")))
        .otherwise(F.format_number(bal, 2)).alias("refund_amount_usd"),
        _yes(F.col("o_orderkey") % 11 == 0).alias("preceding_upgrade_flag"),
        _yes(F.col("o_orderkey") % 13 == 0).alias("preceding_downgrade_flag"),
        F.lit("False").alias("is_reactivation"),
        F.when(full & (seg != "FURNITURE"), F.concat(F.lower(seg), F.lit(" feedback"))).alias("feedback_text"))


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "accounts": accounts(spark, sf_dir),
        "subscriptions": subscriptions(spark, sf_dir),
        "feature_usage": feature_usage(spark, sf_dir),
        "support_tickets": support_tickets(spark, sf_dir),
        "churn_events": churn_events(spark, sf_dir),
    }
