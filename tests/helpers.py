"""Small envelope frames for unit tests."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from feedline.operators.envelope import NORMALIZED_FIELDS

_NORM_DDL = ", ".join(f"{n}: {t}" for n, t in NORMALIZED_FIELDS)
_NORM_DDL = f"struct<{_NORM_DDL}>"


def records(spark, rows):
    """Envelope rows from dicts: source, record_type, observed_at (text),
    ingested_at, raw (dict), normalized (dict), identifiers (dict), sk, page, pos."""
    data = []
    for i, r in enumerate(rows):
        data.append((
            r.get("source"), r.get("record_type"), r.get("observed_at"), r.get("ingested_at"),
            None if r.get("raw", {}) is None else json.dumps(r.get("raw", {})),
            None if r.get("normalized", {}) is None else json.dumps(r.get("normalized", {})),
            r.get("identifiers", {}), r.get("sk", "k"), r.get("page", 1), r.get("pos", i),
        ))
    df = spark.createDataFrame(
        data,
        "source string, record_type string, observed_at string, ingested_at string, raw string, "
        "normalized string, identifiers map<string,string>, sk string, page bigint, pos bigint",
    )
    return df.select(
        "source", "record_type",
        F.to_timestamp("observed_at").alias("observed_at"),
        F.to_timestamp("ingested_at").alias("ingested_at"),
        F.try_parse_json("raw").alias("raw"),
        F.from_json("normalized", _NORM_DDL).alias("normalized"),
        "identifiers",
        F.col("sk").alias("_source_key"), F.col("page").alias("_page_no"), F.col("pos").alias("_pos"),
    )


def one(spark, expr, value, typ="string"):
    """Evaluate a Column function on one value."""
    df = spark.createDataFrame([(value,)], f"x {typ}")
    return df.select(expr(F.col("x")).alias("y")).first()["y"]
