"""Checks of drug sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedline.plans.checks.base import (
    LINE_DRUG_NAME,
    check,
    sql_drug,
    sql_n1,
    table,
)


@check(
    "canonical_drugs",
    f"""
WITH li AS (SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, {LINE_DRUG_NAME} AS name
            FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey),
k AS (SELECT l_orderkey,
             CASE WHEN l_partkey % 17 <> 0 AND l_linenumber % 6 IN (0, 2, 3, 4)
                  THEN {sql_drug(sql_n1('name'))} END AS drug
      FROM li)
SELECT o.o_orderkey, count(DISTINCT k.drug) AS n_drugs,
       coalesce(string_agg(DISTINCT k.drug, '|' ORDER BY k.drug), '') AS drugs
FROM orders o JOIN k ON k.l_orderkey = o.o_orderkey
GROUP BY o.o_orderkey
""",
)
def canonical_drugs_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    from feedline.operators.drugs import canonical_drugs

    from feedline.plans.renders import interventions

    iv = interventions(spark, sf_dir)
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    arr = F.try_variant_get(F.try_parse_json("interventions"), "$", "array<variant>")
    drugs = orders.join(iv, orders.o_orderkey == iv.l_orderkey).select("o_orderkey", canonical_drugs(arr).alias("d"))
    return drugs.select("o_orderkey", F.size("d").cast("bigint").alias("n_drugs"), F.array_join("d", "|").alias("drugs"))
