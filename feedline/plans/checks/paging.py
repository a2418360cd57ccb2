"""Checks of the paging rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedline.plans.checks.base import (
    check,
    events_feed,
)


_PAGE_ANCHOR = "2024-02-01 00:00:00"


_PAGE_MICROS = 6 * 3600 * 1_000_000


_MARK_BEFORE = "2024-01-25 00:00:00"


def events_pages_desc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per event type, newest first (O1): a page is a 6-hour slice counted back
    from a fixed anchor, so page numbers come from the time alone (no ranking
    window). Every 97th event is dated 10 days later than its page suggests, so
    new rows also sit on old pages."""
    obs = F.when(F.col("event_id") % 97 == 0, F.col("ts").cast("timestamp") + F.expr("INTERVAL 10 DAYS")) \
        .otherwise(F.col("ts").cast("timestamp"))
    feed = events_feed(spark, sf_dir, observed=obs)
    back = F.unix_micros(F.to_timestamp(F.lit(_PAGE_ANCHOR))) - F.unix_micros("_ts")
    return feed.withColumn("_page_no", (F.floor(back / _PAGE_MICROS) + 1).cast("bigint"))


@check(
    "page_cutoff",
    """
WITH r AS (SELECT event_id, 'events:' || event_type AS sk, ts,
                  CASE WHEN event_id % 97 = 0 THEN ts + INTERVAL 10 DAY ELSE ts END AS obs,
                  (epoch_us(TIMESTAMP '{anchor}') - epoch_us(ts)) // {micros} + 1 AS page FROM events),
m AS (SELECT 'events:' || event_type AS sk, max(ts) AS mark FROM events
      WHERE ts < TIMESTAMP '{mark}' GROUP BY 1),
p AS (SELECT r.sk, page, bool_or(obs > mark) AS any_new FROM r JOIN m USING (sk) GROUP BY r.sk, page),
lp AS (SELECT sk, min(page) AS last_page FROM p WHERE NOT any_new GROUP BY sk)
SELECT r.sk AS source_key, event_id, page AS page_no
FROM r JOIN m USING (sk) LEFT JOIN lp USING (sk)
WHERE obs > mark AND (last_page IS NULL OR page <= last_page)
""".format(anchor=_PAGE_ANCHOR, micros=_PAGE_MICROS, mark=_MARK_BEFORE),
)
def page_cutoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F7 with A2 page facts: the first non-empty page without a new record is
    the last one used; new rows on later pages are never fetched."""
    from feedline.operators.pages import last_pages, on_usable_page, page_facts
    from feedline.operators.watermark import attach_state, is_new

    recs = events_pages_desc(spark, sf_dir)
    state = recs.where(F.col("_ts") < F.to_timestamp(F.lit(_MARK_BEFORE))).groupBy(
        F.col("_source_key").alias("source_key")).agg(F.max("_ts").alias("last_seen_ts"))
    marked = attach_state(recs, state)
    pages = marked.groupBy(F.col("_source_key").alias("source_key"), F.col("_page_no").alias("page_no")).agg(
        F.count(F.lit(1)).alias("n"))
    last_no = pages.groupBy("source_key").agg(F.max("page_no").alias("_last"))
    pages = pages.join(last_no, "source_key").withColumn(
        "next_token", F.when(F.col("page_no") < F.col("_last"), F.concat(F.lit("tok"), F.col("page_no").cast("string"))))
    last = last_pages(pages, page_facts(marked), incremental=True, cutoff_enabled=True,
                      sort_order="LastUpdatePostDate:desc")
    used = on_usable_page(marked, last).where(is_new(F.col("observed_at"), F.col("_prev_mark")))
    return used.select(F.col("_source_key").alias("source_key"), "event_id", F.col("_page_no").alias("page_no"))


_TOKEN_SQL = ("CASE WHEN page = mp OR page = 13 THEN NULL WHEN page = 6 + length(event_type) "
              "THEN 'tok' || CAST(page - 2 AS VARCHAR) ELSE 'tok' || CAST(page AS VARCHAR) END")


@check(
    "page_token_loop",
    f"""
WITH r AS (SELECT 'events:' || event_type AS sk, event_type, event_id // 250 + 1 AS page FROM events),
p AS (SELECT sk, event_type, page, count(*) AS n FROM r GROUP BY sk, event_type, page),
mx AS (SELECT sk, max(page) AS mp FROM p GROUP BY sk),
t AS (SELECT p.*, {_TOKEN_SQL} AS tok FROM p JOIN mx USING (sk)),
stops AS (SELECT sk, min(page) AS last_page FROM t
          WHERE tok IS NULL OR EXISTS (SELECT 1 FROM t t2 WHERE t2.sk = t.sk AND t2.tok = t.tok AND t2.page < t.page)
          GROUP BY sk)
SELECT t.sk AS source_key, page AS page_no, n AS n_records
FROM t LEFT JOIN stops USING (sk) WHERE last_page IS NULL OR page <= last_page
""",
)
def page_token_loop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F8: a page whose next token was already used is the last; so is one
    without. Pages are id ranges of 250 events, per event type."""
    from feedline.operators.pages import last_pages, on_usable_page

    feed = events_feed(spark, sf_dir).withColumn("_page_no", (F.floor(F.col("event_id") / 250) + 1).cast("bigint"))
    pages = feed.groupBy(F.col("_source_key").alias("source_key"), "event_type", F.col("_page_no").alias("page_no")) \
        .agg(F.count(F.lit(1)).alias("n_records"))
    mp = pages.groupBy("source_key").agg(F.max("page_no").alias("mp"))
    pages = pages.join(mp, "source_key").withColumn("page", F.col("page_no")) \
        .withColumn("next_token", F.expr(_TOKEN_SQL.replace("VARCHAR", "STRING")))
    last = last_pages(pages, None)
    kept = on_usable_page(pages.withColumnRenamed("source_key", "_source_key").withColumnRenamed("page_no", "_page_no"), last)
    return kept.select(F.col("_source_key").alias("source_key"), F.col("_page_no").alias("page_no"), "n_records")


@check(
    "newest_first",
    """
WITH r AS (SELECT event_id, 'events:' || event_type AS sk, CASE WHEN event_id % 23 = 0 THEN NULL ELSE date_trunc('hour', ts) END AS obs FROM events),
n AS (SELECT *, row_number() OVER (PARTITION BY sk ORDER BY obs DESC NULLS LAST, event_id) - 1 AS k FROM r),
p AS (SELECT sk, event_id, obs, k // 20 + 1 AS page_no, k % 20 AS pos FROM n),
lp AS (SELECT sk, min(page_no) AS last FROM (SELECT sk, page_no, bool_or(obs > TIMESTAMP '{mark}') AS any_new FROM p GROUP BY sk, page_no) WHERE NOT coalesce(any_new, false) GROUP BY sk)
SELECT sk AS source_key, event_id, page_no, pos FROM p JOIN lp USING (sk) WHERE page_no <= last
""".format(mark=_MARK_BEFORE),
)
def newest_first_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O1 with ties (times cut to the hour) and nulls: pages of 20 per event
    type, and the newest-first cutoff (F7) run on them."""
    from feedline.operators.order import newest_first
    from feedline.operators.pages import last_pages, on_usable_page, page_facts

    e = events_feed(spark, sf_dir)
    obs = F.when(F.col("event_id") % 23 != 0, F.date_trunc("hour", "observed_at"))
    feed = e.withColumn("observed_at", obs).select("_source_key", "_page_no", "_pos", "event_id", "observed_at")
    paged = newest_first(feed, 20).drop("_page_no", "_pos")
    paged = paged.withColumn("_prev_mark", F.to_timestamp(F.lit(_MARK_BEFORE)))
    facts = page_facts(paged, page="page_no")
    tokens = facts.select("source_key", "page_no", F.concat(F.lit("t"), F.col("page_no").cast("string")).alias("next_token"))
    last = last_pages(tokens, facts, sort_order="LastUpdatePostDate:desc")
    return on_usable_page(paged, last, page="page_no").select(F.col("_source_key").alias("source_key"), "event_id", "page_no", "pos")


_FETCHED_SQL = """
WITH p AS (SELECT 'events:' || event_type AS source_key, event_id // 100 AS seq, event_type FROM events GROUP BY ALL),
f AS (SELECT source_key, seq % 7 + 1 AS page_no, TIMESTAMP '2024-01-01 20:00:00' + to_minutes(CAST(seq * 3 AS INTEGER))
             + to_hours(CASE WHEN event_type = 'click' AND seq % 7 >= 4 THEN 2 ELSE 0 END) + to_hours(CAST(seq // 7 * 3 AS INTEGER)) AS fetched_at FROM p),
l AS (SELECT *, lag(fetched_at) OVER w AS bt, lag(page_no) OVER w AS bp FROM f WINDOW w AS (PARTITION BY source_key ORDER BY fetched_at, page_no)),
s AS (SELECT *, CASE WHEN bt IS NULL OR page_no <= bp OR fetched_at - bt > INTERVAL 1 HOUR THEN 1 ELSE 0 END AS start FROM l),
n AS (SELECT source_key, page_no, fetched_at, CAST(sum(start) OVER (PARTITION BY source_key ORDER BY fetched_at, page_no) AS BIGINT) AS "fetch" FROM s),
e AS (SELECT source_key, "fetch", min(page_no) AS last FROM n WHERE page_no = 6 OR page_no = 7 GROUP BY source_key, "fetch")"""


@check(
    "fetch_sessions",
    _FETCHED_SQL + """
SELECT n.source_key, n.page_no, strftime(fetched_at, '%Y-%m-%d %H:%M:%S') AS fetched_at, n."fetch"
FROM n LEFT JOIN e USING (source_key, "fetch") WHERE last IS NULL OR n.page_no <= last
""",
)
def fetch_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several fetches of a source key in one landing: page numbers that go back
    and long pauses tell them apart; tokens repeat from fetch to fetch, and each
    fetch ends by its own page rules (F8)."""
    from feedline.operators.pages import fetch_ids, last_pages, on_usable_page

    seq = F.floor(F.col("event_id") / 100)
    p = events_feed(spark, sf_dir).select(F.col("_source_key").alias("source_key"), "event_type", seq.alias("seq")).distinct()
    late = F.when((F.col("event_type") == "click") & (F.col("seq") % 7 >= 4), 120).otherwise(0) + F.floor(F.col("seq") / 7) * 180
    at = F.to_timestamp(F.lit("2024-01-01 20:00:00")) + F.make_dt_interval(mins=(F.col("seq") * 3 + late).cast("int"))
    pages = p.select("source_key", (F.col("seq") % 7 + 1).alias("page_no"), at.alias("fetched_at"))
    found = fetch_ids(pages).withColumn("key", F.struct("source_key", "fetch"))
    token = F.when(F.col("page_no") < 6, F.concat(F.lit("t"), F.col("page_no").cast("string")))
    last = last_pages(found.select(F.col("key").alias("source_key"), "page_no", token.alias("next_token")))
    used = on_usable_page(found, last, key="key", page="page_no")
    return used.select("source_key", "page_no", F.date_format("fetched_at", "yyyy-MM-dd HH:mm:ss").alias("fetched_at"), "fetch")
