"""Checks of de-duplication (P7, N7, W1, J2, U2, K5) and the every-N sample."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedline.operators.dedup import first_seen, with_dedup_key
from feedline.operators.envelope import envelope, identifiers_map, normalized_struct
from feedline.operators.validate import validate
from feedline.plans.checks.base import (
    check,
    documents_feed,
    events_feed,
    table,
)


@check(
    "dedup_first_seen",
    """
WITH r AS (SELECT doc_id, lang,
                  CASE WHEN doc_id % 3 = 0 THEN 'id:' || (n_chars % 97) ELSE 'tx:' || text END AS k
           FROM documents)
SELECT first(doc_id ORDER BY lang, doc_id) AS doc_id, first('documents:' || lang ORDER BY lang, doc_id) AS source_key
FROM r GROUP BY k
""",
)
def dedup_first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Id key where present (``identifiers.nct_id``), else the fingerprint."""
    feed = documents_feed(spark, sf_dir).withColumn(
        "identifiers",
        F.map_concat(
            F.col("identifiers"),
            F.create_map(F.lit("nct_id"), F.when(F.col("doc_id") % 3 == 0,
                                                 F.concat(F.lit("NCT"), F.lpad((F.col("n_chars") % 97).cast("string"), 8, "0")))),
        ),
    )
    v = validate(feed, "drop")
    kept = first_seen(with_dedup_key(v.accepted, "identifiers.nct_id", fallback=True))
    return kept.select("doc_id", F.col("_source_key").alias("source_key"))


def orders_feed(spark: SparkSession, sf_dir: str, key: F.Column) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        "o_orderkey",
        *envelope(
            source=F.lit("orders"), record_type=F.lit("regulatory_update"),
            observed_at=F.col("o_orderdate").cast("timestamp"),
            raw=F.to_variant_object(F.struct("o_orderkey", "o_custkey")),
            normalized=normalized_struct(title=F.col("o_orderstatus")),
            identifiers=identifiers_map(nct_id=key), source_key=F.lit("orders:feed"),
            page_no=F.floor(F.col("o_orderkey") / 100), pos=F.col("o_orderkey"),
        ),
    )


@check(
    "dedup_against_seen",
    """
WITH r AS (SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE 'c' || o_custkey END AS k FROM orders)
SELECT o_orderkey, k AS dedup_key FROM r WHERE k IS NULL
UNION ALL
SELECT min(o_orderkey) AS o_orderkey, k AS dedup_key FROM r
WHERE k IS NOT NULL AND k NOT IN (SELECT 'c' || c_custkey FROM customer WHERE c_custkey % 3 = 0)
GROUP BY k
""",
)
def dedup_against_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W1 + J2 with the key store of an earlier run (S5/K5); no fingerprint fallback."""
    from feedline.operators.dedup import dedup
    from feedline.session import scratch_path
    from feedline.sources.state import append_seen, read_seen

    key = F.when(F.col("o_orderkey") % 10 == 0, F.lit(None)).otherwise(
        F.concat(F.lit("c"), F.col("o_custkey").cast("string")))
    feed = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey").join(
        orders_feed(spark, sf_dir, key), "o_orderkey")
    cust = table(spark, sf_dir, "customer")
    earlier = cust.where(F.col("c_custkey") % 3 == 0).select(
        F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("dedup_key"))
    junk = spark.createDataFrame([("",), (None,)], "dedup_key string")
    store = scratch_path(spark, "checks", "seen")
    append_seen(earlier.unionByName(junk), f"{store}/run=r0001")
    keyed = with_dedup_key(validate(feed, "drop").accepted, "identifiers.nct_id", fallback=False)
    kept, new_keys = dedup(keyed, read_seen(spark, store, exclude_run="r0002"))
    return kept.select("o_orderkey", "dedup_key")


@check(
    "every_nth",
    """
SELECT event_id, event_type AS source, n AS items_processed
FROM (SELECT event_id, event_type, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS n FROM events)
WHERE n % 100 = 0
""",
)
def every_nth_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W2 with N = 100 per spider, in arrival order (pages of 50, position)."""
    from feedline.operators.metrics import every_nth

    accepted = validate(events_feed(spark, sf_dir), "drop").accepted
    return every_nth(accepted, 100, group="source").select("event_id", "source", "items_processed")
