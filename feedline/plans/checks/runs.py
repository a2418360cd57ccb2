"""Checks of whole runs: repeated run ids and the commit log (S4, K4, S7), the
key store (S5, K5, J2, U2), the manifest-pruned scan (S6), unreadable pages, the
metrics lines (K3), and streams with fixed survivors and metrics (T3, T4)."""

from __future__ import annotations

from unittest import mock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedline.functions.dates import iso_utc
from feedline.operators.envelope import envelope, identifiers_map, normalized_struct
from feedline.plans.checks.base import ISO_Z, RUN_TS, check, files_per_batch, land_pages, table
from feedline.session import scratch_path, stage

_RECALLS_SQL = """
WITH e AS (SELECT event_id, event_id // 100 + 1 AS page_no,
                  CASE WHEN event_id % 4 <= 1 THEN CAST(ts AS DATE) + 1 ELSE CAST(ts AS DATE) END AS obs FROM events),
x AS (SELECT max(page_no) AS last FROM e)"""


@check(
    "rerun_same_id",
    _RECALLS_SQL + f""",
m AS (SELECT max(obs) AS mark FROM e, x WHERE page_no * 2 <= last)
SELECT 'S' || event_id AS report, CASE WHEN page_no * 2 <= last THEN '0001~3' ELSE '0002' END AS run,
       strftime((SELECT max(obs) FROM e), {ISO_Z}) AS mark
FROM e, x, m WHERE page_no * 2 <= last OR obs > mark
""",
)
def rerun_same_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An incremental run repeated after its commit, a run that crashes before
    its commit and is repeated, and the first run repeated after that: every
    run id writes what it wrote the first time, only committed runs are read,
    and the newest state stays."""
    from feedline.plans import ingest
    from feedline.plans.renders import recall_pages
    from feedline.sources import commits
    from feedline.streaming.stream import read_written

    pages = land_pages(spark, recall_pages(spark, sf_dir), "rerun")
    last = pages.agg(F.max("page_no")).scalar()
    first = ingest.Landed(recalls=pages.where(F.col("page_no") * 2 <= last))
    every = ingest.Landed(recalls=pages)
    root = scratch_path(spark, "checks", "rerun")
    one, two = (ingest.IngestConfig(run_id=i, run_ts=RUN_TS) for i in ("0001", "0002"))
    for _ in range(2):
        ingest.run_ingest(spark, first, root, one)
    with mock.patch.object(commits, "commit", side_effect=RuntimeError("crash")):
        try:
            ingest.run_ingest(spark, every, root, two)
        except RuntimeError:
            pass
    ingest.run_ingest(spark, every, root, two)
    ingest.run_ingest(spark, first, root, one)
    state = ingest.read_version(spark, f"{root}/state", commits.newest(spark, root))
    mark = state.select(iso_utc("last_seen_ts").alias("mark")).scalar()  # one source key
    return read_written(spark, root).select(F.try_variant_get("raw", "$.safetyreportid", "string").alias("report"), F.col("run").cast("string").alias("run"),
                                            mark.alias("mark"))


@check(
    "seen_store",
    """
WITH k AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01')
SELECT 'c' || c_custkey AS dedup_key, 'compacted' AS store FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM k)
UNION ALL
SELECT 'c' || c_custkey, 'runs' FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderdate < TIMESTAMP '1996-01-01')
""",
)
def seen_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of one run per order year in bucketed folders; look-ups
    over the runs up to 1995 as they are, and over all after a compaction and
    one more run. The store is never shuffled."""
    from feedline.sources import commits, keystore

    root = scratch_path(spark, "checks", "keystore")
    key = F.concat(F.lit("c"), F.col("o_custkey").cast("string"))
    orders = table(spark, sf_dir, "orders").select(key.alias("dedup_key"), F.year("o_orderdate").alias("year"))
    wanted = table(spark, sf_dir, "customer").select(F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("dedup_key"))
    seen, out = f"{root}/seen", None
    for year in range(1992, 1998):
        if year == 1997:
            keystore.compact(spark, root, bucket_keys=500)
        run = commits.begin(spark, root, str(year))
        keystore.write_keys(orders.where(F.col("year") == year).select("dedup_key"), seen, run.token, bucket_keys=500)
        commits.commit(spark, root, run)
        if year == 1995:
            out = keystore.new_only(wanted, seen, keystore.store_tokens(spark, root)).select("dedup_key", F.lit("runs").alias("store"))
    tokens = keystore.store_tokens(spark, root)
    assert len(tokens) == 2, tokens  # the compaction and the run after it
    return out.unionByName(keystore.new_only(wanted, seen, tokens).select("dedup_key", F.lit("compacted").alias("store")))


_MANIFEST_SQL = """
WITH f AS (SELECT page_id // 10 AS f, sha256(string_agg(html, chr(10) ORDER BY page_id)) AS sha FROM pages GROUP BY page_id // 10),
w AS (SELECT * FROM f WHERE f % 7 <> 3 AND NOT (f % 2 = 0 AND f % 3 <> 0))"""


@check("manifest_scan", _MANIFEST_SQL + " SELECT 'feed:' || f AS source_key, f AS page_no, sha, (SELECT count(*) FROM w) AS files_read FROM w")
def manifest_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payload files of which the manifest says some failed and some are
    unchanged; the scan opens only the others."""
    from feedline.sources.manifest import read_changed

    p = table(spark, sf_dir, "pages").select(F.floor(F.col("page_id") / 10).alias("f"), "page_id", "html")
    bodies = p.groupBy("f").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page_id", "html"))), lambda x: x["html"]), "\n").alias("value"))
    root = scratch_path(spark, "checks", "payload files")  # a blank, as paths may have
    bodies.repartition("f").write.option("lineSep", "\x00").partitionBy("f").text(root)
    f = F.col("f")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").option("recursiveFileLookup", "true").load(root).select("path") \
        .withColumn("f", F.regexp_extract("path", r"/f=(\d+)/", 1).cast("bigint"))
    manifest = files.select(F.concat(F.lit("feed:"), f.cast("string")).alias("source_key"), f.alias("page_no"), "path", F.when(f % 7 == 3, 500).otherwise(200).alias("status"),
                            F.concat(F.lit("e"), f.cast("string")).alias("etag"), F.lit(None).cast("string").alias("last_modified"), F.lit(None).cast("timestamp").alias("fetched_at"))
    manifest = stage(manifest, scratch_path(spark, "checks", "manifest"))
    state = manifest.select("source_key", F.when(F.col("page_no") % 2 == 0, F.when(F.col("page_no") % 3 == 0, F.lit("old")).otherwise(F.col("etag"))).alias("etag"),
                                                 "last_modified")
    got = read_changed(spark, manifest, state)
    return got.select("source_key", "page_no", F.sha2(F.rtrim(F.col("payload"), F.lit("\x00")), 256).alias("sha"),
                      F.lit(sum(x.endswith(".txt") for x in got.inputFiles())).cast("bigint").alias("files_read"))


@check(
    "page_rejects",
    """
SELECT 'fda_openfda:https://api.example/drug/enforcement.json?limit=100' AS source_key, event_id // 100 + 1 AS page_no, 'bad JSON' AS reason, 0 AS n_written
FROM events WHERE (event_id // 100 + 1) % 3 = 0 GROUP BY event_id // 100
UNION ALL
SELECT 'ema_rss:https://feeds.example/news.xml', page_id // 50 + 1, 'bad XML', 0 FROM pages WHERE (page_id // 50 + 1) % 4 = 0 GROUP BY page_id // 50
UNION ALL
SELECT 'fda_openfda', 0, 'written', count(*) FROM events WHERE (event_id // 100 + 1) % 3 <> 0
UNION ALL
SELECT 'ema', 0, 'written', count(*) FROM pages WHERE (page_id // 50 + 1) % 4 <> 0
""",
)
def page_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads that cannot be read, through the job: every third result set and
    every fourth feed page is cut off; the rest is written."""
    from feedline.plans.ingest import IngestConfig, Landed, run_ingest
    from feedline.plans.renders import recall_pages, rss_pages

    cut = lambda every, text: F.when(F.col("page_no") % every == 0, F.regexp_replace("payload", text, "")).otherwise(F.col("payload"))
    recalls = land_pages(spark, recall_pages(spark, sf_dir).withColumn("payload", cut(3, r"\]\}$")), "rejects_recalls")
    rss = land_pages(spark, rss_pages(spark, sf_dir).withColumn("payload", cut(4, r"(?s)<channel>.*$")), "rejects_rss")
    res = run_ingest(spark, Landed(recalls=recalls, rss={"ema": rss}), scratch_path(spark, "checks", "rejects"), IngestConfig(run_id="0001", run_ts=RUN_TS))
    written = res.records.groupBy(F.col("source").alias("source_key")).agg(F.count(F.lit(1)).alias("n_written"))
    return res.page_rejects.select("source_key", "page_no", "reason", F.lit(0).cast("bigint").alias("n_written")).unionByName(
        written.select("source_key", F.lit(0).cast("bigint").alias("page_no"), F.lit("written").alias("reason"), "n_written"))


@check(
    "metrics_lines",
    f"""
WITH i AS (SELECT 'fda_openfda' AS spider, event_id // 100 + 1 AS page_no FROM events UNION ALL SELECT 'ema_rss', page_id // 50 + 1 FROM pages),
p AS (SELECT spider, page_no, count(*) AS n, CASE page_no % 5 WHEN 0 THEN 500 WHEN 1 THEN 304 WHEN 2 THEN NULL ELSE 200 END AS status FROM i GROUP BY spider, page_no)
SELECT 'spider_metrics' AS event, '2025-01-01T00:00:00+00:00' AS "timestamp", spider,
       CAST(coalesce(sum(n) FILTER (WHERE status = 200 OR status IS NULL), 0) AS BIGINT) AS items_scraped,
       CAST(coalesce(sum(n) FILTER (WHERE status = 200 OR status IS NULL), 0) AS BIGINT) AS validation_passed, CAST(0 AS BIGINT) AS validation_failed,
       count(*) AS requests_total, count(status) AS responses_total, count(*) FILTER (WHERE status = 200) AS http_200,
       count(*) FILTER (WHERE status = 304) AS http_304, count(*) FILTER (WHERE status IS NULL OR status >= 500) AS errors, 'finished' AS finish_reason, '0001' AS run
FROM p GROUP BY spider
""",
)
def metrics_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3: the metrics lines of a run with a manifest, read back. Pages of
    failed responses are not read."""
    from feedline.plans.ingest import IngestConfig, Landed, run_ingest
    from feedline.plans.renders import recall_pages, rss_pages
    from feedline.streaming.stream import read_metrics

    recalls = land_pages(spark, recall_pages(spark, sf_dir), "metrics_recalls")
    rss = land_pages(spark, rss_pages(spark, sf_dir), "metrics_rss")
    five = F.col("page_no") % 5
    none = F.lit(None).cast("string")
    manifest = recalls.unionByName(rss).select(
        "source_key", "page_no", none.alias("path"), F.when(five == 0, 500).when(five == 1, 304).when(five > 2, 200).alias("status"),
        none.alias("etag"), none.alias("last_modified"), F.lit(None).cast("timestamp").alias("fetched_at"))
    root = scratch_path(spark, "checks", "metrics")
    run_ingest(spark, Landed(recalls=recalls, rss={"ema": rss}, manifest=manifest), root, IngestConfig(run_id="0001", run_ts=RUN_TS))
    return read_metrics(spark, root).drop("elapsed_seconds")


def _events_envelope(batch: DataFrame) -> DataFrame:
    """Events as records that share a key per user and 300 ids (three users of four have one)."""
    user = F.col("user_id")
    key = F.concat(F.lit("u"), user.cast("string"), F.lit("-"), F.floor(F.col("event_id") / 300).cast("string"))
    return batch.select("event_id", *envelope(
        source=F.col("event_type"), record_type=F.lit("regulatory_update"),
        observed_at=F.when(F.col("event_id") % 19 != 0, F.col("ts").cast("timestamp")), raw=F.to_variant_object(F.struct("event_id")),
        normalized=normalized_struct(title=F.col("event_type")),
        identifiers=identifiers_map(nct_id=F.when(user % 4 != 0, key)),
        source_key=F.concat(F.lit("events:"), F.col("event_type")), page_no=F.floor(F.col("event_id") / 50), pos=F.col("event_id")))


def _events_in_three_landings(spark: SparkSession, sf_dir: str, out: str) -> None:
    """Three landings of several files, each taken by one ``availableNow`` run in
    one batch; the last one repeats the events of the first."""
    from feedline.streaming.stream import feed_batch_writer, run_available

    e = table(spark, sf_dir, "events")
    landing = scratch_path(spark, "checks", "event_landings")
    third, files = F.col("event_id") % 3, files_per_batch(spark, e.rdd.getNumPartitions(), 1)
    for part in (e.where(third == 1), e.where(third == 0), e.where(third != 2), e.where(third == 2)):
        part.repartition(files, "event_id").write.mode("append").parquet(landing)
        stream = spark.readStream.schema(e.schema).parquet(landing)
        run_available(stream, feed_batch_writer(out, _events_envelope, fallback=False, run_ts=F.to_timestamp(F.lit(RUN_TS))), f"{out}/_checkpoint")


@check(
    "stream_first_wins",
    """
WITH e AS (SELECT event_id, event_type, user_id, 'u' || user_id || '-' || event_id // 300 AS k,
                  CASE event_id % 3 WHEN 1 THEN 0 WHEN 0 THEN 1 ELSE 3 END AS landing FROM events WHERE event_id % 19 <> 0),
again AS (SELECT * FROM e UNION ALL SELECT * REPLACE (2 AS landing) FROM e WHERE event_id % 3 <> 2)
SELECT arg_min(event_id, (landing, event_type, event_id // 50, event_id)) AS event_id, k AS dedup_key FROM again WHERE user_id % 4 <> 0 GROUP BY k
UNION ALL SELECT event_id, NULL FROM again WHERE user_id % 4 = 0
""",
)
def stream_first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T3 with a fixed survivor: of the records of a key the first in arrival
    order inside the earliest batch; late copies are found in the key store,
    however long ago. Records without a key all pass."""
    from feedline.streaming.stream import read_written

    out = scratch_path(spark, "checks", "stream_first_wins")
    _events_in_three_landings(spark, sf_dir, out)
    return read_written(spark, out).select("event_id", "dedup_key")


@check(
    "stream_metrics",
    """
WITH b AS (SELECT event_id, CASE event_id % 3 WHEN 1 THEN 'b00000000' WHEN 0 THEN 'b00000001' ELSE 'b00000003' END AS run FROM events
      UNION ALL SELECT event_id, 'b00000002' FROM events WHERE event_id % 3 <> 2)
SELECT run, 'events' AS spider, '2025-01-01T00:00:00+00:00' AS "timestamp", count(*) FILTER (WHERE event_id % 19 <> 0) AS items_scraped,
       count(*) FILTER (WHERE event_id % 19 <> 0) AS validation_passed, count(*) FILTER (WHERE event_id % 19 = 0) AS validation_failed
FROM b GROUP BY run
""",
)
def stream_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T4: metrics lines of every batch of a stream, as a table."""
    from feedline.streaming.stream import read_metrics

    out = scratch_path(spark, "checks", "stream_metrics")
    _events_in_three_landings(spark, sf_dir, out)
    return read_metrics(spark, out).select("run", "spider", "timestamp", "items_scraped", "validation_passed", "validation_failed")
