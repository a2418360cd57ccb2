"""Checks of truthiness (P5) and the date rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedline.functions.dates import iso_utc
from feedline.plans.checks.base import (
    ISO_Z,
    RUN_TS,
    check,
    run_ts,
    table,
)


@check(
    "first_truthy",
    """
SELECT event_id,
       CASE WHEN event_id % 3 = 2 THEN event_type
            WHEN event_id % 4 >= 2 THEN props
            WHEN event_id % 5 = 0 THEN ''
            ELSE CAST(user_id AS VARCHAR) END AS picked
FROM events
""",
)
def first_truthy_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    from feedline.functions.expr import first_truthy

    e = table(spark, sf_dir, "events")
    a = F.expr("CASE event_id % 3 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE event_type END")
    b = F.expr("CASE event_id % 4 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE props END")
    c = F.expr("CASE WHEN event_id % 5 = 0 THEN '' ELSE CAST(user_id AS STRING) END")
    return e.select("event_id", first_truthy(a, b, c).alias("picked"))


@check(
    "study_observed_at",
    f"""
SELECT l_orderkey, l_linenumber, strftime(CASE
    WHEN l_orderkey % 5 >= 2 THEN l_shipdate
    WHEN l_linenumber % 3 <> 0 THEN date_trunc('month', l_shipdate)
    WHEN l_orderkey % 7 <> 0 THEN l_shipdate + INTERVAL 2 DAY
    WHEN l_orderkey % 11 <> 0 THEN l_shipdate + INTERVAL 510 MINUTE
    WHEN l_orderkey % 13 <> 0 THEN l_shipdate + INTERVAL 3 DAY
    ELSE TIMESTAMP '{RUN_TS}' END, {ISO_Z}) AS observed_at
FROM lineitem
""",
)
def study_observed_at_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    from feedline.functions.dates import study_observed_at

    li = table(spark, sf_dir, "lineitem").withColumn("_d", F.col("l_shipdate").cast("timestamp"))
    d = F.col("_d")
    d1 = F.when(F.col("l_orderkey") % 5 == 0, F.lit(None)).when(F.col("l_orderkey") % 5 == 1, F.lit("not a date")) \
        .otherwise(F.date_format(d, "yyyy-MM-dd"))
    d2 = F.when(F.col("l_linenumber") % 3 == 0, F.lit("")).otherwise(F.date_format(d, "yyyy-MM"))
    d3 = F.when(F.col("l_orderkey") % 7 == 0, F.lit(None)).otherwise(
        F.date_format(d + F.expr("INTERVAL 2 DAYS"), "MMMM d, yyyy"))
    d4 = F.when(F.col("l_orderkey") % 11 == 0, F.lit(None)).otherwise(
        F.date_format(d, "yyyy-MM-dd'T'10:30:00+02:00"))
    d5 = F.when(F.col("l_orderkey") % 13 == 0, F.lit(None)).otherwise(
        F.concat(F.date_format(d + F.expr("INTERVAL 3 DAYS"), "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" +0000")))
    return li.select("l_orderkey", "l_linenumber",
                     iso_utc(study_observed_at([d1, d2, d3, d4, d5], run_ts())).alias("observed_at"))


@check(
    "recall_date",
    f"""
SELECT o_orderkey, strftime(CASE o_orderkey % 7
    WHEN 0 THEN o_orderdate
    WHEN 1 THEN o_orderdate - INTERVAL 3477 SECOND
    WHEN 6 THEN o_orderdate + INTERVAL 12 HOUR
    ELSE TIMESTAMP '{RUN_TS}' END, {ISO_Z}) AS observed_at
FROM orders
""",
)
def recall_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    from feedline.functions.dates import parse_recall_date

    o = table(spark, sf_dir, "orders").withColumn("_d", F.col("o_orderdate").cast("timestamp"))
    d, k = F.col("_d"), F.col("o_orderkey") % 7
    text = (
        F.when(k == 0, F.date_format(d, "yyyyMMdd"))
        .when(k == 1, F.date_format(d, "yyyy-MM-dd'T'01:02:03+02:00"))
        .when(k == 2, F.concat(F.date_format(d, "yyyy"), F.lit("13"), F.date_format(d, "dd")))
        .when(k == 3, F.lit("junk"))
        .when(k == 4, F.lit(""))
        .when(k == 5, F.lit(None))
        .otherwise(F.date_format(d, "yyyy-MM-dd'T'12:00:00"))
    )
    return o.select("o_orderkey", iso_utc(parse_recall_date(text, run_ts())).alias("observed_at"))


@check(
    "rss_date",
    f"""
SELECT event_id, strftime(CASE WHEN event_id % 10 = 4 THEN TIMESTAMP '{RUN_TS}'
                               ELSE date_trunc('second', ts) END, {ISO_Z}) AS observed_at
FROM events
""",
)
def rss_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    from feedline.functions.dates import parse_rss_date

    e = table(spark, sf_dir, "events").withColumn("_t", F.col("ts").cast("timestamp"))
    t, k = F.col("_t"), F.col("event_id") % 10
    rfc = "EEE, dd MMM yyyy HH:mm:ss"
    text = (
        F.when(k % 5 == 0, F.concat(F.date_format(t, rfc), F.lit(" +0000")))
        .when(k % 5 == 1, F.concat(F.date_format(t, rfc), F.lit(" GMT")))
        .when(k % 5 == 2, F.concat(F.date_format(t + F.expr("INTERVAL 90 MINUTES"), rfc), F.lit(" +0130")))
        .when(k % 5 == 3, F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(k == 4, F.lit("garbage"))
        .otherwise(F.concat(F.date_format(t, rfc), F.lit(" EST")))
    )
    return e.select("event_id", iso_utc(parse_rss_date(text, run_ts())).alias("observed_at"))
