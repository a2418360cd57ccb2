"""Checks of the fingerprint (N7) and the Kafka value frame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedline.operators.envelope import envelope, identifiers_map, normalized_struct
from feedline.operators.validate import validate
from feedline.plans.checks.base import (
    EVENT_LINK,
    EVENT_TITLE,
    ISO_Z,
    TITLE_RE,
    check,
    run_ts,
    table,
)


_PAGE_TITLE_SQL = (
    f"CASE WHEN page_id % 9 = 0 THEN NULL WHEN page_id % 13 = 0 THEN '' "
    f"ELSE regexp_extract(html, '{TITLE_RE}', 1) END"
)


@check(
    "fingerprint",
    f"""
WITH p AS (SELECT page_id, url, {_PAGE_TITLE_SQL} AS title,
                  TIMESTAMP '2024-01-01' + to_hours(page_id) AS obs FROM pages)
SELECT page_id, 'fp:' || sha256('{{"identifiers":{{"link":' || to_json(url)
    || '}},"normalized":{{"lead_sponsor":null,"link":' || to_json(url)
    || ',"status":null,"title":' || coalesce(to_json(title), 'null')
    || '}},"observed_at":"' || strftime(obs, {ISO_Z})
    || '","record_type":"regulatory_update","source":"fda"}}') AS fp
FROM p
""",
)
def fingerprint_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    from feedline.operators.dedup import record_fingerprint

    p = table(spark, sf_dir, "pages")
    title = F.expr(_PAGE_TITLE_SQL)
    obs = F.to_timestamp(F.lit("2024-01-01")) + F.make_dt_interval(hours=F.col("page_id").cast("int"))
    feed = p.select(
        "page_id",
        *envelope(
            source=F.lit("fda"), record_type=F.lit("regulatory_update"), observed_at=obs,
            raw=F.to_variant_object(F.struct("url")), normalized=normalized_struct(title=title, link=F.col("url")),
            identifiers=identifiers_map(link=F.col("url")), source_key=F.lit("fda_rss:feed"),
            page_no=F.col("page_id"), pos=F.lit(0),
        ),
    )
    return feed.select("page_id", record_fingerprint(feed, zulu=True).alias("fp"))


def events_rss_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as RSS items of one feed, 50 items per landed page, in id order."""
    e = table(spark, sf_dir, "events")
    pub = F.concat(F.date_format(F.col("ts").cast("timestamp"), "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" +0000"))
    return e.select(
        F.lit("ema_rss:feed").alias("source_key"),
        F.floor(F.col("event_id") / 50).cast("bigint").alias("page_no"),
        F.col("event_id").alias("pos"),
        F.expr(EVENT_TITLE.replace("VARCHAR", "STRING")).alias("title"),
        F.expr(EVENT_LINK.replace("VARCHAR", "STRING")).alias("link"),
        pub.alias("pubDate"),
    )


@check(
    "kafka_values",
    f"""
WITH e AS (SELECT event_id, {EVENT_TITLE} AS title, {EVENT_LINK} AS link,
                  strftime(ts, '%a, %d %b %Y %H:%M:%S') || ' +0000' AS pub, date_trunc('second', ts) AS obs
           FROM events)
SELECT event_id, '{{"source":"ema","record_type":"regulatory_update","observed_at":"' || strftime(obs, {ISO_Z})
    || '","ingested_at":"2025-01-01T00:00:00Z","raw":{{"link":' || to_json(link) || ',"pubDate":' || to_json(pub)
    || ',"title":' || to_json(title) || '}},"normalized":{{"title":' || to_json(title) || ',"link":' || to_json(link)
    || '}},"identifiers":{{"link":' || to_json(link) || '}}}}' AS value
FROM e
""",
)
def kafka_values_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    from feedline.operators.envelope import rss_envelope, stamp_ingested_at
    from feedline.sinks.writers import kafka_values

    rows = stamp_ingested_at(rss_envelope(events_rss_items(spark, sf_dir), "ema", run_ts()), run_ts())
    v = validate(rows, "drop")
    return kafka_values(v.accepted, keep=[F.col("_pos").alias("event_id")])


@check(
    "recall_jsonl",
    f"""
WITH e AS (SELECT event_id AS i, event_type, user_id, CAST(ts AS DATE) AS d FROM events),
f AS (SELECT *, CASE WHEN i % 4 = 1 THEN '' WHEN i % 4 >= 2 THEN strftime(d, '%Y%m%d') END AS report_date, strftime(d + 1, '%Y-%m-%d') AS initiation,
             CASE WHEN i % 3 = 0 THEN '' ELSE 'E' || i END AS event_id, CASE WHEN i % 5 <> 0 THEN 'R-' || i END AS recall_number,
             CASE WHEN i % 6 = 0 THEN '' ELSE event_type || ' product' END AS product, CASE WHEN i % 12 <> 0 THEN 'reason ' || user_id END AS reason,
             'Class ' || (i % 3 + 1) AS class FROM e),
g AS (SELECT *, coalesce(nullif(event_id, ''), nullif(recall_number, ''), 'S' || i) AS id, coalesce(nullif(product, ''), nullif(reason, ''), upper(event_type)) AS title,
             CASE WHEN i % 4 <= 1 THEN d + 1 ELSE d END AS obs FROM f)
SELECT '{{"source":"fda_openfda","record_type":"regulatory_update","observed_at":"' || strftime(obs, {ISO_Z}) || '","ingested_at":"2025-01-01T00:00:00Z","raw":{{"classification":"'
    || class || '","event_id":"' || event_id || '","openfda":{{"brand_name":["' || upper(event_type) || '"]}},"product_description":"' || product || '"'
    || coalesce(',"reason_for_recall":"' || reason || '"', '') || ',"recall_initiation_date":"' || initiation || '"' || coalesce(',"recall_number":"' || recall_number || '"', '')
    || coalesce(',"report_date":"' || report_date || '"', '') || ',"safetyreportid":"S' || i || '","status":"Ongoing"}},"normalized":{{"title":"' || title
    || '","status":"Ongoing","classification":"' || class || '","report_date":' || coalesce('"' || report_date || '"', 'null') || '}},"identifiers":{{"event_id":"' || id
    || '","recall_number":' || coalesce('"' || recall_number || '"', 'null') || '}}}}' AS line
FROM g
""",
)
def recall_jsonl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1 + P9 in full: recall result sets scanned, projected, validated, written
    as JSON lines and read back line by line."""
    from feedline.operators.envelope import recall_envelope, stamp_ingested_at
    from feedline.plans.checks.base import land_pages
    from feedline.plans.renders import recall_pages
    from feedline.session import scratch_path
    from feedline.sinks.writers import write_jsonl
    from feedline.sources.payloads import result_rows

    rows = recall_envelope(result_rows(land_pages(spark, recall_pages(spark, sf_dir), "jsonl")), run_ts())
    path = scratch_path(spark, "checks", "recall_jsonl")
    write_jsonl(validate(stamp_ingested_at(rows, run_ts()), "drop").accepted, path)
    return spark.read.text(path).select(F.col("value").alias("line"))
