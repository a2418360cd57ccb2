"""Checks of name clean-up (N1-N4) and alias look-ups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedline.plans.checks.base import (
    TITLE_RE,
    check,
    sql_company,
    sql_drug,
    sql_n1,
    table,
)


@check(
    "norm_text",
    f"""
SELECT 'conversation' AS kind, conv_id AS id, CAST(turn AS BIGINT) AS turn, {sql_n1('text')} AS norm
FROM conversations
UNION ALL
SELECT 'page' AS kind, page_id AS id, CAST(0 AS BIGINT) AS turn,
       {sql_n1(f"regexp_extract(html, '{TITLE_RE}', 1)")} AS norm
FROM pages
""",
)
def norm_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from feedline.functions.text import normalize_text

    conv = table(spark, sf_dir, "conversations").select(
        F.lit("conversation").alias("kind"), F.col("conv_id").alias("id"), F.col("turn").cast("bigint").alias("turn"),
        normalize_text("text").alias("norm"),
    )
    pages = table(spark, sf_dir, "pages").select(
        F.lit("page").alias("kind"), F.col("page_id").alias("id"), F.lit(0).cast("bigint").alias("turn"),
        normalize_text(F.regexp_extract("html", TITLE_RE, 1)).alias("norm"),
    )
    return conv.unionByName(pages)


_CUSTOMER_SUFFIX = (
    "CASE c_custkey % 6 WHEN 0 THEN ', Inc.' WHEN 1 THEN ' Co Ltd' WHEN 2 THEN ' GmbH' "
    "WHEN 3 THEN ' A/S' WHEN 4 THEN '' ELSE ' S.A.' END"
)


@check(
    "norm_company",
    f"""
WITH n AS (SELECT c_custkey, {sql_n1(f"c_name || {_CUSTOMER_SUFFIX}")} AS n FROM customer)
SELECT c_custkey, {sql_company('n')} AS company FROM n
""",
)
def norm_company(spark: SparkSession, sf_dir: str) -> DataFrame:
    from feedline.functions.text import normalize_company

    c = table(spark, sf_dir, "customer")
    return c.select("c_custkey", normalize_company(F.concat("c_name", F.expr(_CUSTOMER_SUFFIX))).alias("company"))


_PART_FORM = (
    "CASE WHEN p_partkey % 10 = 9 THEN 'Oral Tablet' ELSE p_name || ' ' || CAST(p_size AS VARCHAR) || "
    "CASE p_partkey % 4 WHEN 0 THEN ' mg Oral Tablet' WHEN 1 THEN ' Injection Solution' "
    "WHEN 2 THEN ' (IV) mcg/ml' ELSE '' END END"
)


@check(
    "norm_drug",
    f"""
WITH n AS (SELECT p_partkey, {sql_n1(_PART_FORM)} AS n FROM part)
SELECT p_partkey, {sql_drug('n')} AS drug FROM n
""",
)
def norm_drug(spark: SparkSession, sf_dir: str) -> DataFrame:
    from feedline.functions.text import normalize_drug

    p = table(spark, sf_dir, "part")
    return p.select("p_partkey", normalize_drug(F.expr(_PART_FORM.replace("VARCHAR", "STRING"))).alias("drug"))


# Alias maps as users configure them (JSON object text).
COMPANY_ALIAS_JSON = (
    '{"Supplier#000000004": "Acme Pharma, Inc.", "supplier 000000005 gmbh": "Five Bio", '
    '"SUPPLIER#000000006": "Six A", "supplier 000000006": "Six B", "": "nobody", '
    '"Supplier#000000009": "", "supplier 000000001": "One", "Supplier#000000011 Holdings": 7}'
)


_COMPANY_ALIAS_SQL = (
    "VALUES ('supplier 000000004', 'acme pharma inc'), ('supplier 000000005 gmbh', 'five bio'), "
    "('supplier 000000006', 'six b'), ('supplier 000000001', 'one'), ('supplier 000000011 holdings', '7')"
)


_SUPPLIER_SUFFIX = "CASE s_suppkey % 4 WHEN 0 THEN ', Inc.' WHEN 1 THEN ' GmbH' WHEN 2 THEN '' ELSE ' Holdings' END"


@check(
    "alias_company",
    f"""
WITH a(alias, canonical) AS ({_COMPANY_ALIAS_SQL}),
n AS (SELECT s_suppkey, {sql_n1(f"s_name || {_SUPPLIER_SUFFIX}")} AS n FROM supplier),
k AS (SELECT s_suppkey, n, {sql_company('n')} AS k FROM n)
SELECT s_suppkey, coalesce(a1.canonical, a2.canonical, k.k) AS company
FROM k LEFT JOIN a a1 ON a1.alias = k.n LEFT JOIN a a2 ON a2.alias = k.k
""",
)
def alias_company(spark: SparkSession, sf_dir: str) -> DataFrame:
    from feedline.operators.alias import alias_table_from_json, with_canonical_company

    aliases = alias_table_from_json(spark, COMPANY_ALIAS_JSON)
    s = table(spark, sf_dir, "supplier").withColumn("_name", F.concat("s_name", F.expr(_SUPPLIER_SUFFIX)))
    return with_canonical_company(s, "_name", "company", aliases).select("s_suppkey", "company")


DRUG_ALIAS_JSON = '{"Blue Bolt Tablets": "Boltazine", "red widget": "Widgetol", "small ring 10": "Ringinex"}'


_DRUG_ALIAS_SQL = "VALUES ('blue bolt tablets', 'boltazine'), ('red widget', 'widgetol'), ('small ring 10', 'ringinex')"


_PART_DOSE = "CASE p_partkey % 3 WHEN 0 THEN ' Tablets' WHEN 1 THEN ' 10 mg' ELSE '' END"


@check(
    "alias_drug",
    f"""
WITH a(alias, canonical) AS ({_DRUG_ALIAS_SQL}),
n AS (SELECT p_partkey, {sql_n1(f"p_name || {_PART_DOSE}")} AS n FROM part),
k AS (SELECT p_partkey, n, {sql_drug('n')} AS k FROM n)
SELECT p_partkey, coalesce(a1.canonical, a2.canonical, k.k) AS drug
FROM k LEFT JOIN a a1 ON a1.alias = k.n LEFT JOIN a a2 ON a2.alias = k.k
""",
)
def alias_drug(spark: SparkSession, sf_dir: str) -> DataFrame:
    from feedline.operators.alias import alias_table_from_json, with_canonical_drug

    aliases = alias_table_from_json(spark, DRUG_ALIAS_JSON)
    p = table(spark, sf_dir, "part").withColumn("_name", F.concat("p_name", F.expr(_PART_DOSE)))
    return with_canonical_drug(p, "_name", "drug", aliases).select("p_partkey", "drug")
