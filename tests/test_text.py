"""Names and aliases, one row per rule."""

import pytest

from feedline.functions.text import normalize_company, normalize_drug, normalize_text, py_strip
from feedline.operators.alias import alias_table_from_json, with_canonical_company, with_canonical_drug
from tests.helpers import one


@pytest.mark.parametrize(
    "name,expected",
    [
        ("Mill & Reed, Corp.", "mill reed"),
        ("Lund B/V 7", "lund b v 7"),
        ("Co Ltd", "co ltd"),
        ("ACME co. LTD GmbH", "acme"),
        ("AG Foo AG", "ag foo"),
        ("Société Générale S.A.", "soci t g n rale s a"),
        ("Acme Incorporated", "acme"),
        ("Acme Inco", "acme inco"),
        (None, None),
        ("", None),
        ("  ", None),
        ("--", None),
    ],
)
def test_company(spark, name, expected):
    assert one(spark, normalize_company, name) == expected


@pytest.mark.parametrize(
    "name,expected",
    [
        ("Corvanol capsules", "corvanol"),
        ("Corvanol 0.5 ml solution", "corvanol 0 5"),
        ("oral tablet", "oral tablet"),
        ("IV solution of X", "of x"),
        (None, None),
    ],
)
def test_drug(spark, name, expected):
    assert one(spark, normalize_drug, name) == expected


def test_text_collapses_and_trims(spark):
    assert one(spark, normalize_text, "  Hello,\t\nWorld!! ") == "hello world"
    assert one(spark, normalize_text, "ÀÉÎ") is None


def test_py_strip_matches_python(spark):
    for s in [" a ", "\x1c\x1fa\x85", "　a ", "\ta b\n", "​a"]:
        assert one(spark, py_strip, s) == s.strip()


def _company_with(spark, alias_json, name):
    aliases = alias_table_from_json(spark, alias_json)
    df = spark.createDataFrame([(name,)], "n string")
    return with_canonical_company(df, "n", "c", aliases).first()["c"]


def _drug_with(spark, alias_json, name):
    aliases = alias_table_from_json(spark, alias_json)
    df = spark.createDataFrame([(name,)], "n string")
    return with_canonical_drug(df, "n", "c", aliases).first()["c"]


def test_company_alias(spark):
    assert _company_with(spark, '{"lund b/v 7":"lund"}', "Lund B/V 7") == "lund"


def test_company_alias_after_suffix_strip(spark):
    assert _company_with(spark, '{"acme":"Acme Group"}', "ACME, Inc.") == "acme group"


def test_drug_alias(spark):
    got = _drug_with(spark, '{"corvanol (cor-9)":"corvanol"}', "Corvanol (COR-9)")
    assert got == "corvanol"


@pytest.mark.parametrize("text", ["not json", "[1]", "", None, '"x"'])
def test_bad_alias_map_is_empty(spark, text):
    assert alias_table_from_json(spark, text).count() == 0


def test_alias_map_later_duplicate_wins(spark):
    rows = alias_table_from_json(spark, '{"ACME": "first", "acme": "second", "x": 7, "": "y"}').collect()
    got = {r["alias"]: r["canonical"] for r in rows}
    assert got == {"acme": "second", "x": "7"}


def test_first_truthy_golden(spark):
    from feedline.functions.expr import first_truthy

    df = spark.createDataFrame([("", None, "x"), (None, "", ""), ("a", "b", "c")], "a string, b string, c string")
    got = [r["v"] for r in df.select(first_truthy("a", "b", "c").alias("v")).collect()]
    assert got == ["x", "", "a"]  # the last value is returned as it is


def test_source_key(spark):
    from pyspark.sql import functions as F

    from feedline.functions.expr import source_key

    df = spark.createDataFrame([("diabetes", 50)], "q string, n int")
    got = df.select(source_key("clinicaltrials_api", F.col("q"), F.col("n"), "LastUpdatePostDate:desc").alias("k")).first()
    assert got["k"] == "clinicaltrials_api:diabetes:50:LastUpdatePostDate:desc"
