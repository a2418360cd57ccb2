"""Checks of validation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedline.operators.validate import validate
from feedline.plans.checks.base import (
    check,
    documents_feed,
)


_BAD_SOURCE = "CASE doc_id % 7 WHEN 0 THEN '' WHEN 1 THEN '  documents ' WHEN 2 THEN '   ' ELSE 'documents' END"


_BAD_TYPE = "CASE doc_id % 11 WHEN 0 THEN NULL WHEN 1 THEN ' ' || chr(9) ELSE 'document' END"


_VALID_SQL = "(doc_id % 7 NOT IN (0, 2) AND doc_id % 11 NOT IN (0, 1) AND doc_id % 13 <> 0)"


def documents_to_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = documents_feed(spark, sf_dir)
    return (
        feed.withColumn("source", F.expr(_BAD_SOURCE))
        .withColumn("record_type", F.expr(_BAD_TYPE.replace("chr(9)", "char(9)")))
        .withColumn("observed_at", F.when(F.col("doc_id") % 13 == 0, F.lit(None)).otherwise(F.col("observed_at")))
    )


@check(
    "validate_drop",
    f"""
SELECT doc_id, trim({_BAD_SOURCE}) AS source, 'document' AS record_type
FROM documents WHERE {_VALID_SQL}
""",
)
def validate_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = validate(documents_to_validate(spark, sf_dir), "drop")
    return v.accepted.select("doc_id", "source", "record_type")


@check(
    "validate_warn",
    f"""
SELECT doc_id,
       CASE WHEN {_VALID_SQL} THEN trim({_BAD_SOURCE}) ELSE {_BAD_SOURCE} END AS source,
       {_BAD_TYPE} AS record_type,
       {_VALID_SQL} AS valid
FROM documents
""",
)
def validate_warn(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = validate(documents_to_validate(spark, sf_dir), " WARN ")
    return v.accepted.select("doc_id", "source", "record_type", F.col("_valid").alias("valid"))


@check(
    "validation_counts",
    f"""
SELECT m.mode,
       CAST(CASE WHEN m.mode = 'off' THEN 0 ELSE count_if({_VALID_SQL}) END AS BIGINT) AS passed,
       CAST(CASE WHEN m.mode = 'off' THEN 0 ELSE count_if(NOT {_VALID_SQL}) END AS BIGINT) AS failed,
       CAST(CASE WHEN m.mode = 'drop' THEN count_if({_VALID_SQL}) ELSE count(*) END AS BIGINT) AS written
FROM documents, (VALUES ('drop'), ('warn'), ('off')) m(mode)
GROUP BY m.mode
""",
)
def validation_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4 per mode; with validation off nothing is counted and all is written."""
    rows = documents_to_validate(spark, sf_dir)
    out = None
    for label, mode, enabled in (("drop", "drop", True), ("warn", "warn", True), ("off", "drop", False)):
        v = validate(rows, mode, enabled)
        written = v.accepted.agg(F.count(F.lit(1))).scalar()  # scalar subquery
        part = v.counts().select(
            F.lit(label).alias("mode"), F.col("validation_passed").alias("passed"),
            F.col("validation_failed").alias("failed"), written.alias("written"),
        )
        out = part if out is None else out.unionByName(part)
    return out


@check(
    "rejects",
    """
SELECT doc_id, 'source' AS field, 'empty' AS error, 'drop' AS mode FROM documents WHERE doc_id % 7 IN (0, 2)
UNION ALL SELECT doc_id, 'record_type', 'missing', 'drop' FROM documents WHERE doc_id % 11 = 0
UNION ALL SELECT doc_id, 'record_type', 'empty', 'drop' FROM documents WHERE doc_id % 11 = 1
UNION ALL SELECT doc_id, 'observed_at', 'missing', 'drop' FROM documents WHERE doc_id % 13 = 0
""",
)
def rejects_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    from feedline.operators.validate import rejects

    v = validate(documents_to_validate(spark, sf_dir), "drop")
    r = rejects(v)
    return r.select(F.col("_page_no").alias("doc_id"), "mode", F.explode("errors").alias("e")).select(
        "doc_id", F.col("e.field").alias("field"), F.col("e.error").alias("error"), "mode")
