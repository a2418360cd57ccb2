"""F4/A5 drug sets, F3 company match, J4 against brute force, J6."""

import json

import pytest
from pyspark.sql import functions as F

from feedline.operators.drugs import canonical_drugs
from feedline.operators.match import canonical_target, match_targets, matches_company, prepare_targets


def test_drug_set_golden(spark):
    iv = [
        {"type": "DRUG", "name": "Aspirin 5 mg"},
        {"name": "Zinc tablet"},
        {"type": None, "name": "Nulltype"},
        {"type": "Device", "name": "D"},
        7,
        {"type": "  ", "name": "aspirin  5"},
    ]
    df = spark.createDataFrame([(json.dumps(iv),)], "j string")
    arr = F.try_variant_get(F.parse_json("j"), "$", "array<variant>")
    assert df.select(canonical_drugs(arr).alias("d")).first()["d"] == ["aspirin 5", "zinc"]


def test_drug_set_missing_is_empty(spark):
    df = spark.createDataFrame([(None,)], "j string")
    arr = F.try_variant_get(F.try_parse_json("j"), "$", "array<variant>")
    assert df.select(canonical_drugs(arr).alias("d")).first()["d"] == []


def _match(spark, target, title=None, sponsor=None, conditions=None):
    df = spark.createDataFrame([(title, sponsor, conditions or [])], "t string, s string, c array<string>")
    from feedline.functions.text import normalize_company

    hit = matches_company(target, F.col("t"), F.col("s"), F.col("c"), normalize_company("s"),
                          canonical_target(spark, target))
    return df.select(hit.alias("m")).first()["m"]


@pytest.mark.parametrize(
    "kwargs,expected",
    [
        (dict(title="Study by Novo", conditions=["Type 2"]), False),
        (dict(sponsor="b Nordisk novo"), True),
        (dict(title="Novo", sponsor="Nordisk"), False),
        (dict(sponsor="Novo Nordisk, Inc."), True),
        (dict(conditions=["x", "NOVONORDISK"]), True),
    ],
)
def test_company_match_golden(spark, kwargs, expected):
    assert _match(spark, "novo nordisk", **kwargs) is expected


def test_empty_target_keeps_all(spark):
    assert _match(spark, "  ", title="anything") is True


def test_many_targets_golden(spark):
    docs = [
        (1, "The quick brown fox", "Acme Corp", ["lorem ipsum", "dolor"]),
        (2, "Dolor sit", "Beta GmbH", ["quick fox jumps"]),
        (3, None, "acme", []),
        (4, "xy", "z", ["ab"]),
    ]
    targets = [(10, "quick fox"), (11, "ACME Inc"), (12, "x"), (13, "ipsum dolor"), (14, "zz top"), (15, "  ")]
    recs = spark.createDataFrame(docs, "id int, title string, lead_sponsor string, conditions array<string>")
    from feedline.functions.text import normalize_company

    recs = recs.withColumn("canonical_lead_sponsor", normalize_company("lead_sponsor"))
    got = {(r.id, r.target_id) for r in match_targets(recs, ["id"], prepare_targets(
        spark.createDataFrame(targets, "tid int, t string"), "tid", "t")).collect()}

    # Both words in one text; the sponsor's canonical name; one letter inside words.
    assert got == {(1, 10), (2, 10), (1, 11), (3, 11), (1, 12), (2, 12), (4, 12)}


def test_entity_join_explodes_arrays_and_summarises(spark):
    from feedline.operators.match import entity_join

    a = spark.createDataFrame([(1, ["x", "y"]), (2, ["z"])], "id int, drugs array<string>")
    b = spark.createDataFrame([("y", 5), ("y", 7), ("q", 1)], "d string, v int")
    got = entity_join(a, b, "drugs", "d", [F.count(F.lit(1)).alias("n"), F.max("v").alias("v")]).collect()
    rows = sorted((r["id"], r["_entity"], r["n"], r["v"]) for r in got)
    assert rows == [(1, "x", None, None), (1, "y", 2, 7), (2, "z", None, None)]
