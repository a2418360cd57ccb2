"""Checks of run metrics (A3, A4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedline.functions.dates import iso_utc
from feedline.operators.validate import validate
from feedline.plans.checks.base import (
    check,
    events_feed,
    run_ts,
    sql_list,
    table,
)


_SPIDERS = ("click", "error", "purchase", "signup", "view")


@check(
    "run_metrics",
    f"""
WITH r AS (SELECT event_type AS spider, CAST(count_if(event_id % 17 <> 0) AS BIGINT) AS passed, CAST(count_if(event_id % 17 = 0) AS BIGINT) AS failed
           FROM events GROUP BY event_type),
m AS (SELECT list_extract({sql_list(_SPIDERS)}, CAST(page_id % 5 + 1 AS INTEGER)) AS spider, count(*) AS req,
             CAST(count_if(page_id % 4 = 0) AS BIGINT) AS h304,
             CAST(count_if(page_id % 4 <> 0 AND page_id % 9 = 0) AS BIGINT) AS h500
      FROM pages GROUP BY 1)
SELECT 'spider_metrics' AS event, '2025-01-01T00:00:00+00:00' AS "timestamp",
       coalesce(r.spider, m.spider) AS spider,
       coalesce(passed, 0) AS items_scraped, coalesce(passed, 0) AS validation_passed,
       coalesce(failed, 0) AS validation_failed, coalesce(req, 0) AS requests_total,
       coalesce(req, 0) AS responses_total, coalesce(req - h304 - h500, 0) AS http_200,
       coalesce(h304, 0) AS http_304, coalesce(h500, 0) AS errors, 'finished' AS finish_reason
FROM r FULL OUTER JOIN m ON r.spider = m.spider
""",
)
def run_metrics_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3 per spider: validation counters from the records, response counters
    from a landing manifest (pages as fetches: 200, 304 or 500)."""
    from feedline.operators.metrics import record_counts, response_counts, run_metrics

    obs = F.when(F.col("event_id") % 17 == 0, F.lit(None).cast("timestamp")).otherwise(F.col("ts").cast("timestamp"))
    v = validate(events_feed(spark, sf_dir, observed=obs), "drop")
    pid = F.col("page_id")
    manifest = table(spark, sf_dir, "pages").select(
        F.element_at(F.array(*[F.lit(s) for s in _SPIDERS]), (pid % 5 + 1).cast("int")).alias("spider"),
        F.when(pid % 4 == 0, 304).when(pid % 9 == 0, 500).otherwise(200).alias("status"),
    )
    counts = record_counts(v.checked.withColumn("spider", F.col("source")),
                           v.accepted.withColumn("spider", F.col("source")))
    m = run_metrics(counts, response_counts(manifest), run_ts())
    return m.drop("elapsed_seconds").withColumn("timestamp", iso_utc("timestamp", zulu=False))
