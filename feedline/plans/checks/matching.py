"""Checks of target-company matching (F3, J4) and entity joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedline.plans.checks.base import (
    LINE_DRUG_NAME,
    check,
    sql_company,
    sql_drug,
    sql_list,
    sql_n1,
    table,
)


def documents_as_trials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as trial-like records: title = first line, sponsor = source,
    conditions = every further line (the whole text is searched)."""
    from feedline.functions.text import normalize_company

    d = table(spark, sf_dir, "documents")
    lines = F.split("text", "\n")
    return d.select(
        "doc_id",
        F.substring_index("text", "\n", 1).alias("title"),
        F.col("source").alias("lead_sponsor"),
        F.slice(lines, F.lit(2), F.size(lines)).alias("conditions"),
        normalize_company("source").alias("canonical_lead_sponsor"),
    )


_DOC_HAY_SQL = """
d AS (SELECT doc_id, source,
             list_filter([lower(split_part(text, chr(10), 1)), lower(source)]
                         || list_transform(list_slice(string_split(text, chr(10)), 2, len(string_split(text, chr(10)))),
                                           lambda x: lower(x)),
                         lambda h: h IS NOT NULL AND h <> '') AS hay
      FROM documents),
dh AS (SELECT doc_id, unnest(hay) AS h FROM d)"""


TARGETS_ONE = ("The And", "SRC7 GmbH")


@check(
    "company_match",
    f"""
WITH {_DOC_HAY_SQL}
SELECT DISTINCT 'The And' AS target, doc_id FROM dh WHERE contains(h, 'the') AND contains(h, 'and')
UNION ALL
SELECT 'SRC7 GmbH' AS target, doc_id FROM documents WHERE source = 'src7'
""",
)
def company_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F3 for two configured targets: one matched through its terms, one through
    canonical equality with the sponsor."""
    from feedline.operators.match import canonical_target, matches_company

    trials = documents_as_trials(spark, sf_dir)
    out = None
    for target in TARGETS_ONE:
        hit = matches_company(target, F.col("title"), F.col("lead_sponsor"), F.col("conditions"),
                              F.col("canonical_lead_sponsor"), canonical_target(spark, target))
        part = trials.where(hit).select(F.lit(target).alias("target"), "doc_id")
        out = part if out is None else out.unionByName(part)
    return out


# Word lists the generated targets are built from (they occur in the prose).
_PAIRS = ("the and", "de la", "que les", "ing the", "tion ment", "ou en", "el los", "with for")


_WORDS = ("thhe", "ouvi", "anan", "ère", "ch", "x")


_TARGET_SQL = (
    "CASE c_custkey % 4 WHEN 0 THEN 'Src' || CAST(c_custkey % 20 AS VARCHAR) || ' Inc' "
    f"WHEN 1 THEN list_extract({sql_list(_PAIRS)}, CAST((c_custkey // 4) % 8 + 1 AS INTEGER)) "
    f"WHEN 2 THEN list_extract({sql_list(_WORDS)}, CAST((c_custkey // 4) % 6 + 1 AS INTEGER)) "
    "ELSE c_name END"
)


@check(
    "company_match_many",
    f"""
WITH {_DOC_HAY_SQL},
t AS (SELECT c_custkey, {_TARGET_SQL} AS target FROM customer),
tt AS (SELECT c_custkey,
              list_filter(string_split_regex(lower(trim(target)), '\\s+'), lambda x: x <> '') AS terms,
              {sql_company(sql_n1('target'))} AS canon
       FROM t),
m AS (SELECT tt.c_custkey, dh.doc_id FROM tt JOIN dh
        ON len(tt.terms) > 0 AND list_bool_and(list_transform(tt.terms, lambda x: contains(dh.h, x)))
      UNION
      SELECT tt.c_custkey, d.doc_id FROM tt JOIN d ON len(tt.terms) > 0
        AND tt.canon = {sql_company(sql_n1('d.source'))})
SELECT c_custkey, count(*) AS n_docs FROM m GROUP BY c_custkey
""",
)
def company_match_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer-derived target against every document, gram-blocked."""
    from feedline.operators.match import match_patterns, prepare_targets

    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    pairs = F.array(*[F.lit(x) for x in _PAIRS])
    words = F.array(*[F.lit(x) for x in _WORDS])
    target = (
        F.when(k % 4 == 0, F.concat(F.lit("Src"), (k % 20).cast("string"), F.lit(" Inc")))
        .when(k % 4 == 1, F.element_at(pairs, (F.floor(k / 4) % 8 + 1).cast("int")))
        .when(k % 4 == 2, F.element_at(words, (F.floor(k / 4) % 6 + 1).cast("int")))
        .otherwise(F.col("c_name"))
    )
    targets = prepare_targets(c.select("c_custkey", target.alias("target")), "c_custkey", "target")
    # Hits are counted per distinct pattern, then given to every target of it:
    # no (document, target) pair is ever materialised.
    hits = match_patterns(documents_as_trials(spark, sf_dir), ["doc_id"], targets)
    per_pattern = hits.groupBy("pattern_id").agg(F.count(F.lit(1)).alias("n_docs"))
    return targets.join(per_pattern, "pattern_id").select(F.col("target_id").alias("c_custkey"), "n_docs")


_NATION_TARGET_SQL = (
    "CASE n_nationkey % 5 WHEN 0 THEN 'Src' || CAST(n_nationkey AS VARCHAR) || ' Inc' "
    f"WHEN 1 THEN '  ' WHEN 2 THEN upper(list_extract({sql_list(_PAIRS)}, CAST((n_nationkey // 5) % 8 + 1 AS INTEGER))) "
    f"WHEN 3 THEN list_extract({sql_list(_WORDS)}, CAST((n_nationkey // 5) % 6 + 1 AS INTEGER)) || ' ' || n_name "
    f"ELSE list_extract({sql_list(_WORDS)}, CAST((n_nationkey // 5) % 6 + 1 AS INTEGER)) END"
)


@check(
    "match_targets",
    f"""
WITH {_DOC_HAY_SQL},
t AS (SELECT n_nationkey, {_NATION_TARGET_SQL} AS target FROM nation),
tt AS (SELECT n_nationkey, list_filter(string_split_regex(lower(trim(target)), '\\s+'), lambda x: x <> '') AS terms, {sql_company(sql_n1('target'))} AS canon FROM t)
SELECT tt.n_nationkey AS target_id, dh.doc_id FROM tt JOIN dh
    ON len(tt.terms) > 0 AND list_bool_and(list_transform(tt.terms, lambda x: contains(dh.h, x)))
UNION
SELECT tt.n_nationkey, d.doc_id FROM tt JOIN d ON len(tt.terms) > 0 AND tt.canon = {sql_company(sql_n1('d.source'))}
""",
)
def match_targets_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J4 pair by pair: a target per nation (also blank ones and ones that share
    a pattern) against every document, in portions of patterns."""
    from feedline.operators.match import match_targets, prepare_targets

    targets = table(spark, sf_dir, "nation").select(
        "n_nationkey", F.expr(_NATION_TARGET_SQL.replace("VARCHAR", "STRING").replace("list_extract", "element_at").replace("//", "div")
                              .replace("[", "array(").replace("]", ")")).alias("target"))
    prepared = prepare_targets(targets, "n_nationkey", "target")
    return match_targets(documents_as_trials(spark, sf_dir), ["doc_id"], prepared, portion=7).select("target_id", "doc_id")


@check(
    "entity_links",
    f"""
WITH li AS (SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, {LINE_DRUG_NAME} AS name
            FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey),
d AS (SELECT DISTINCT l_orderkey, {sql_drug(sql_n1('name'))} AS drug FROM li
      WHERE l_partkey % 17 <> 0 AND l_linenumber % 6 IN (0, 2, 3, 4)),
p AS (SELECT {sql_drug(sql_n1('p_name'))} AS drug, count(*) AS n_parts, max(p_size) AS max_size FROM part GROUP BY 1)
SELECT o_orderkey, d.drug AS entity, n_parts, CAST(max_size AS BIGINT) AS max_size
FROM orders LEFT JOIN d ON l_orderkey = o_orderkey AND d.drug IS NOT NULL LEFT JOIN p ON p.drug = d.drug
""",
)
def entity_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J6 row by row: every order (a trial) with each of its canonical drugs and
    what is known of the parts of that name; orders without drugs stay."""
    from feedline.functions.text import normalize_drug
    from feedline.operators.drugs import canonical_drugs
    from feedline.operators.match import entity_join
    from feedline.plans.renders import interventions

    iv = interventions(spark, sf_dir)
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    arr = F.try_variant_get(F.try_parse_json("interventions"), "$", "array<variant>")
    trials = orders.join(iv, orders.o_orderkey == iv.l_orderkey, "left").select("o_orderkey", canonical_drugs(arr).alias("drugs"))
    parts = table(spark, sf_dir, "part").select(normalize_drug("p_name").alias("drug"), "p_size")
    j = entity_join(trials, parts, "drugs", "drug", [F.count(F.lit(1)).alias("n_parts"), F.max("p_size").alias("max_size")])
    return j.select("o_orderkey", F.col("_entity").alias("entity"), "n_parts", F.col("max_size").cast("bigint").alias("max_size"))


@check(
    "entity_join",
    f"""
WITH c AS (SELECT {sql_company(sql_n1("n.n_name || CASE cu.c_custkey % 3 WHEN 0 THEN ', Inc.' WHEN 1 THEN ' Ltd' ELSE '' END"))} AS entity
           FROM customer cu JOIN nation n ON n.n_nationkey = cu.c_nationkey),
s AS (SELECT {sql_company(sql_n1("n.n_name || CASE su.s_suppkey % 2 WHEN 0 THEN ' GmbH' ELSE ' Corp' END"))} AS entity
      FROM supplier su JOIN nation n ON n.n_nationkey = su.s_nationkey),
ca AS (SELECT entity, count(*) AS n_customers FROM c GROUP BY entity),
sa AS (SELECT entity, count(*) AS n_suppliers FROM s GROUP BY entity)
SELECT coalesce(ca.entity, sa.entity) AS entity, coalesce(n_customers, 0) AS n_customers,
       coalesce(n_suppliers, 0) AS n_suppliers
FROM ca FULL OUTER JOIN sa ON ca.entity = sa.entity
""",
)
def entity_join_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers and suppliers meet on their canonical sponsor name. Each
    side is counted per entity before the join, so no pairs are produced."""
    from feedline.functions.text import normalize_company
    from feedline.operators.match import entity_join

    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    cu = table(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    su = table(spark, sf_dir, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    c_name = F.concat("n_name", F.expr("CASE c_custkey % 3 WHEN 0 THEN ', Inc.' WHEN 1 THEN ' Ltd' ELSE '' END"))
    s_name = F.concat("n_name", F.expr("CASE s_suppkey % 2 WHEN 0 THEN ' GmbH' ELSE ' Corp' END"))
    ca = cu.groupBy(normalize_company(c_name).alias("c_entity")).agg(F.count(F.lit(1)).alias("n_customers"))
    s_rows = su.select(normalize_company(s_name).alias("s_entity"))
    j = entity_join(ca, s_rows, "c_entity", "s_entity", [F.count(F.lit(1)).alias("n_suppliers")], "full_outer")
    return j.select(
        F.col("_entity").alias("entity"),
        F.coalesce("n_customers", F.lit(0)).cast("bigint").alias("n_customers"),
        F.coalesce("n_suppliers", F.lit(0)).cast("bigint").alias("n_suppliers"),
    )
