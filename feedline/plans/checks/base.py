"""Registry, table access and helpers shared by the checks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedline.functions.dates import run_timestamp
from feedline.operators.envelope import envelope, identifiers_map, normalized_struct
from feedline.session import prepare


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


ORACLES: dict[str, str] = {}


# Run time used by every check (a job argument, so runs repeat).
RUN_TS = "2025-01-01 00:00:00"


def check(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return fn

    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def run_ts() -> F.Column:
    return run_timestamp(RUN_TS)


def ts_text(c) -> F.Column:
    """Timestamp as text for comparison with DuckDB (microseconds always)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")


# DuckDB spelling of ``ts_text``.
def sql_ts(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S.%f')"


def documents_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as feed records: one per document, arrival order = doc_id."""
    d = table(spark, sf_dir, "documents")
    title = F.substring_index("text", "\n", 1)
    link = F.concat(F.lit("doc://"), F.sha2("text", 256))
    observed = F.to_timestamp(F.date_add(F.to_date(F.lit("2024-01-01")), (F.col("n_chars") % 365).cast("int")))
    return d.select(
        "doc_id",
        "n_chars",
        *envelope(
            source=F.lit("documents"),
            record_type=F.lit("regulatory_update"),
            observed_at=observed,
            raw=F.to_variant_object(F.struct("doc_id", "lang", "source")),
            normalized=normalized_struct(title=title, link=link),
            identifiers=identifiers_map(link=link),
            source_key=F.concat(F.lit("documents:"), F.col("lang")),
            page_no=F.col("doc_id"),
            pos=F.lit(0),
        ),
    )


SQL_N1 = "nullif(trim(regexp_replace(lower({x}), '[^a-z0-9]+', ' ', 'g')), '')"


SQL_SUFFIX = (
    "'(?:(?:^| )(?:inc|incorporated|corp|corporation|co|company|ltd|limited|llc|plc|sa|ag|gmbh|bv))+$'"
)


SQL_FORMS = "('tablet','tablets','capsule','capsules','injection','solution','oral','iv','mg','mcg','ml')"


def sql_n1(x: str) -> str:
    return SQL_N1.format(x=x)


def sql_company(n: str) -> str:
    return f"coalesce(nullif(regexp_replace({n}, {SQL_SUFFIX}, ''), ''), {n})"


def sql_drug(n: str) -> str:
    return (
        f"coalesce(nullif(array_to_string(list_filter(string_split({n}, ' '), "
        f"lambda t: t NOT IN {SQL_FORMS}), ' '), ''), {n})"
    )


TITLE_RE = "<title>(.*?)</title>"


ISO_Z = "'%Y-%m-%dT%H:%M:%SZ'"


EVENT_TITLE = "event_type || ' #' || CAST(event_id AS VARCHAR)"


EVENT_LINK = "'https://feed.example/e/' || CAST(event_id AS VARCHAR)"


def events_feed(spark: SparkSession, sf_dir: str, observed: F.Column | None = None) -> DataFrame:
    """Events as feed records: spider = event type, source key ``events:<type>``,
    pages of 50 in id order."""
    e = table(spark, sf_dir, "events")
    obs = observed if observed is not None else F.col("ts").cast("timestamp")
    link = F.expr(EVENT_LINK.replace("VARCHAR", "STRING"))
    return e.select(
        "event_id",
        "event_type",
        F.col("ts").cast("timestamp").alias("_ts"),
        *envelope(
            source=F.col("event_type"), record_type=F.lit("regulatory_update"), observed_at=obs,
            raw=F.to_variant_object(F.struct("event_id", "props")),
            normalized=normalized_struct(title=F.col("event_type"), link=link),
            identifiers=identifiers_map(event_id=F.col("event_id")),
            source_key=F.concat(F.lit("events:"), F.col("event_type")),
            page_no=F.floor(F.col("event_id") / 50), pos=F.col("event_id"),
        ),
    )


LINE_DRUG_NAME = (
    "p_name || CASE l_linenumber % 3 WHEN 0 THEN ' tablet' "
    "WHEN 1 THEN ' ' || CAST(p_size AS VARCHAR) || ' mg' ELSE '' END"
)


def sql_list(xs) -> str:
    return "[" + ", ".join(f"'{x}'" for x in xs) + "]"


def files_per_batch(spark: SparkSession, files: int, batches: int) -> int:
    """Files of each of ``batches`` micro-batches over a landing that is to have
    ``files`` or more: as many as there are cores at least, so that no batch
    waits for a few tasks, and more where there are more files to take."""
    return max(spark.sparkContext.defaultParallelism, -(-files // batches))


def land_pages(spark: SparkSession, landed: DataFrame, name: str) -> DataFrame:
    """Write landed pages as Parquet to a fresh shared folder and read them back.
    The files follow the data: at least about one per core, none much over the
    advisory partition size, however many pages there are."""
    from feedline.session import scratch_path, write_packed
    from feedline.sources.payloads import read_landed

    path = scratch_path(spark, "checks", name)
    write_packed(landed.hint("rebalance"), path)
    return read_landed(spark, path)


def land_studies(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The registry pages of :func:`study_pages`, landed. The interventions are
    staged for it, so that their shuffle files are gone when the pages move."""
    from feedline.plans.renders import interventions, study_pages
    from feedline.session import discard, scratch_path, stage_packed

    path = scratch_path(spark, "checks", "interventions")
    pages = land_pages(spark, study_pages(spark, sf_dir, stage_packed(interventions(spark, sf_dir), path)), name)
    discard(spark, path)
    return pages
