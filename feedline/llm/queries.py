"""Registered queries of the ten operators and their DuckDB oracles.

The tokenizer files' place comes from ``public_tokenizers.path``; it is a
parameter of the operators.
"""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedline.llm import decontaminate, lexical_search, line_dedup, mixing, near_dedup, pii, quality, secret_scan, source_audit, token_counts, token_files, toxicity, url_filter
from feedline.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn

    return register


@query("op1_toxicity")
def op1_toxicity(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = toxicity.score(docs, toxicity.train(docs, labels), threshold=0.7)
    return scored.select("doc_id", (toxicity.crc_fold(F.col("doc_id")) == 1).alias("held_out"), "score", "predicted", "n_matches")


OP2_SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
common AS (SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE drop) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT drop), '')) AS kept_sha256
FROM (SELECT k.*, k.key IN (SELECT key FROM common) AS drop FROM keyed k) GROUP BY doc_id
"""


@query("op2_line_dedup", OP2_SQL)
def op2_line_dedup(spark, sf_dir):
    kept = line_dedup.drop_common_lines(table(spark, sf_dir, "documents"), min_docs=10, min_chars=1)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query("op3_minhash_near_dedup")
def op3_minhash_near_dedup(spark, sf_dir):
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), words=5, similarity=0.8)


@query("op4_token_counts")
def op4_token_counts(spark, sf_dir):
    got = token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), budget=1024, table=False)
    return got.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 1024).alias("over_limit"), "fits_chars")


@query("op5_quality_rules")
def op5_quality_rules(spark, sf_dir):
    return quality.quality(table(spark, sf_dir, "documents")).drop("reasons")


@query("op6_token_files")
def op6_token_files(spark, sf_dir):
    return token_files.token_files(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=1)


OP7_SQL = r"""
WITH rest AS (SELECT page_id, url, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) END AS r FROM pages),
parts AS (
  SELECT page_id, url,
         translate(coalesce(regexp_extract(r, '^([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(r, '^[^/?#]*([^?#]*)', 1), '') AS path FROM rest),
listed AS (SELECT host FROM parts WHERE host <> '' GROUP BY host
           HAVING sum(CASE WHEN url LIKE '%utm_source=%' THEN 1 ELSE 0 END) > 0.2 * count(*)),
ruled AS (
  SELECT *, CASE
    WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
    WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
    WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
    WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/de/') THEN 'com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/') THEN 'org/' END AS rule FROM parts)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN host IN (SELECT host FROM listed) THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""


@query("op7_url_filter", OP7_SQL)
def op7_url_filter(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return url_filter.judge_urls(pages, url_filter.tracking_hosts(pages))


@query("op8_source_mixing")
def op8_source_mixing(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents"), weights=(3, 1, 2), share=1.5, max_epochs=2).select(
        "doc_id", "size", "source_size", "target", "taken")


@query("op9_secret_scan")
def op9_secret_scan(spark, sf_dir):
    got = secret_scan.secrets(table(spark, sf_dir, "documents"))
    base = F.col("base")
    return got.select("doc_id", *[secret_scan.kind_count(base, k).alias(f"n_{k}") for k in ("assign", "access", "hex")],
                      F.sha2(secret_scan.span_text(base), 256).alias("base_sha256"), secret_scan.span_text(F.col("spans")).alias("spans"))


OP10_SQL = r"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                             '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w FROM documents),
b AS (
  SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
dw AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)),
occ AS (SELECT doc_id, item_id, i, bw.n FROM dw JOIN bw ON dw.win = bw.win AND dw.n = bw.n),
hit AS (SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, i, n FROM occ)) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM occ WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@query("op10_decontamination", OP10_SQL)
def op10_decontamination(spark, sf_dir):
    got = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10)
    return got.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


@query("op11_pii")
def op11_pii(spark, sf_dir):
    got = pii.personal_data(table(spark, sf_dir, "documents"))
    base = F.col("base")
    return got.select("doc_id", *[pii.kind_count(base, k).alias(f"n_{k}") for k in pii.KINDS],
                      F.sha2(pii.span_text(base), 256).alias("base_sha256"), pii.span_text(F.col("spans")).alias("spans"))


OP12_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS d, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
size AS (SELECT count(*) AS n_docs, sum(len(w))::BIGINT AS n_terms FROM d WHERE len(w) > 0),
tf AS (SELECT d, doc_id, n, term, count(*) AS tf FROM (SELECT d, doc_id, len(w) AS n, unnest(w) AS term FROM d)
       WHERE term IN (SELECT term FROM q) GROUP BY ALL),
weight AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, size GROUP BY term, n_docs),
part AS (SELECT d, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * n_docs) // n_terms))) AS part FROM tf JOIN weight USING (term), size),
total AS (SELECT item_id, d, doc_id, CAST(sum(part) AS BIGINT) AS score FROM q JOIN part USING (term) GROUP BY item_id, d, doc_id HAVING sum(part) > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM total) WHERE rank <= 10
"""


@query("op12_lexical_search", OP12_SQL)
def op12_lexical_search(spark, sf_dir):
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), top=10)


OP13_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
w AS (SELECT d, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term, CAST(count(*) AS HUGEINT) AS n FROM w GROUP BY lang, term HAVING count(DISTINCT d) >= 30),
l AS (SELECT lang, sum(n) AS total, count(*) AS v FROM kept GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS n FROM w JOIN kept USING (lang, term) GROUP BY lang, source, term),
g AS (SELECT lang, source, coalesce(total, 0) AS total FROM (SELECT DISTINCT lang, source FROM d)
      LEFT JOIN (SELECT lang, source, sum(n) AS total FROM c GROUP BY lang, source) USING (lang, source)),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
             1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (g.total + 5 * l.v)::HUGEINT AS p,
             1 + (1000000000::HUGEINT * (k.n + 5)) // (l.total + 5 * l.v)::HUGEINT AS q
      FROM g JOIN kept k ON g.lang = k.lang JOIN l ON l.lang = g.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
s AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
      GROUP BY a.lang, a.source, b.source),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(s.value, 0) AS BIGINT) AS value
          FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, CAST(p - q AS BIGINT) AS value FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value, CAST(rank AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM (FROM pairs UNION ALL FROM terms))
WHERE part = 'pair' OR rank <= 50
"""


@query("op13_source_divergence", OP13_SQL)
def op13_source_divergence(spark, sf_dir):
    return source_audit.source_divergence(table(spark, sf_dir, "documents"), min_docs=30, top=50)


@query("pipeline")
def pipeline(spark, sf_dir):
    return corpus_pipeline.run(spark, sf_dir)
