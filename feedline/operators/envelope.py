"""The common record envelope and the per-source projections.

Envelope columns::

    source STRING, record_type STRING, observed_at TIMESTAMP, ingested_at TIMESTAMP,
    raw VARIANT, normalized STRUCT<...>, identifiers MAP<STRING,STRING>,
    _source_key STRING, _page_no BIGINT, _pos BIGINT

``identifiers`` is a map because the set of id keys belongs to the source and
is part of the fingerprint; ``normalized`` is the union of every source's
fields. ``_source_key, _page_no, _pos`` carry arrival order, which first-wins
de-dup and the every-N sample need.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedline.functions.dates import iso_utc, parse_recall_date, parse_rss_date, study_observed_at
from feedline.functions.expr import first_truthy
from feedline.functions.text import normalize_company
from feedline.operators.drugs import canonical_drugs

NORMALIZED_FIELDS: list[tuple[str, str]] = [
    ("title", "string"),
    ("link", "string"),
    ("status", "string"),
    ("classification", "string"),
    ("report_date", "string"),
    ("trial_id", "string"),
    ("phase", "string"),
    ("conditions", "array<string>"),
    ("lead_sponsor", "string"),
    ("canonical_lead_sponsor", "string"),
    ("canonical_drugs", "array<string>"),
]

# --- fixed values (must equal the reference's for equal results) -----------
# Source names, record types and the keys each source writes in its
# ``normalized`` and ``identifiers`` objects.
REGISTRY = "clinicaltrials.gov"
RECALLS = "fda_openfda"
RSS_SOURCES = ("ema", "fda")
CLINICAL_TRIAL = "clinical_trial"
REGULATORY_UPDATE = "regulatory_update"
NORMALIZED_KEYS = {
    "clinicaltrials.gov": ["trial_id", "title", "phase", "status", "conditions",
                           "lead_sponsor", "canonical_lead_sponsor", "canonical_drugs"],
    "fda_openfda": ["title", "status", "classification", "report_date"],
    "ema": ["title", "link"],
    "fda": ["title", "link"],
}
IDENTIFIER_KEYS = {
    "clinicaltrials.gov": ["nct_id"],
    "fda_openfda": ["event_id", "recall_number"],
    "ema": ["link"],
    "fda": ["link"],
}
# -----------------------------------------------------------------------------

ENVELOPE_COLUMNS = [
    "source", "record_type", "observed_at", "ingested_at", "raw", "normalized",
    "identifiers", "_source_key", "_page_no", "_pos", "_undated",
]


def normalized_struct(**fields: Column) -> Column:
    """The ``normalized`` struct; fields not given are typed nulls."""
    unknown = set(fields) - {n for n, _ in NORMALIZED_FIELDS}
    if unknown:
        raise ValueError(f"unknown normalized fields: {sorted(unknown)}")
    return F.struct(
        *[
            (fields[n].cast(t) if n in fields else F.lit(None).cast(t)).alias(n)
            for n, t in NORMALIZED_FIELDS
        ]
    )


def identifiers_map(**ids: Column) -> Column:
    """The ``identifiers`` map: every given key is present, values as text."""
    parts: list[Column] = []
    for k, v in ids.items():
        parts += [F.lit(k), v.cast("string")]
    return F.create_map(*parts) if parts else F.create_map().cast("map<string,string>")


def envelope(
    source: Column,
    record_type: Column,
    observed_at: Column,
    raw: Column,
    normalized: Column,
    identifiers: Column,
    source_key: Column,
    page_no: Column,
    pos: Column,
    undated: Column | None = None,
) -> list[Column]:
    """Envelope columns; ``undated`` marks rows whose ``observed_at`` is the run
    time because no date could be read."""
    return [
        source.alias("source"),
        record_type.alias("record_type"),
        observed_at.alias("observed_at"),
        F.lit(None).cast("timestamp").alias("ingested_at"),
        raw.alias("raw"),
        normalized.alias("normalized"),
        identifiers.alias("identifiers"),
        source_key.alias("_source_key"),
        page_no.cast("bigint").alias("_page_no"),
        pos.cast("bigint").alias("_pos"),
        (undated if undated is not None else F.lit(False)).alias("_undated"),
    ]


def _get(v: Column, path: str, typ: str = "string") -> Column:
    return F.try_variant_get(v, path, typ)


def _truthy_variant(v: Column) -> Column:
    """Whether a JSON value says something: null, '', [], {}, 0 and false do not,
    the texts '0' and 'false' do."""
    text = v.cast("string")
    blank = F.when(F.schema_of_variant(v) == "STRING", text == "").otherwise(text.isin("[]", "{}", "0", "0.0", "false"))
    return v.isNotNull() & ~F.is_variant_null(v) & ~F.coalesce(blank, F.lit(True))


def _no_ts() -> Column:
    return F.lit(None).cast("timestamp")


def study_envelope(studies: DataFrame, run_ts: Column, study_col: str = "study", naive_tz: str = "UTC",
                   keep: list[Column] | None = None) -> DataFrame:
    """One registry study (VARIANT) -> envelope.

    ``studies`` has ``source_key, page_no, pos`` and the study variant.
    Missing objects on the way to a field give null (P6).
    """
    s = F.col(study_col)
    ps = "$.protocolSection"
    st = f"{ps}.statusModule"
    phase = _get(s, f"{st}.phase", "variant")
    phases = _get(s, f"{st}.phases", "variant")
    phase_v = F.when(_truthy_variant(phase), phase).otherwise(phases)
    conditions = F.coalesce(
        _get(s, f"{ps}.conditionsModule.conditions", "array<string>"),
        F.array().cast("array<string>"),
    )
    sponsor = _get(s, f"{ps}.sponsorCollaboratorsModule.leadSponsor.name")
    nct_id = _get(s, f"{ps}.identificationModule.nctId")
    dates = [
        _get(s, f"{st}.{m}.date")
        for m in (
            "lastUpdatePostDateStruct",
            "lastUpdateSubmitDateStruct",
            "studyFirstPostDateStruct",
            "resultsFirstPostDateStruct",
            "completionDateStruct",
        )
    ]
    interventions = _get(s, f"{ps}.armsInterventionsModule.interventions", "array<variant>")
    dated = study_observed_at(dates, _no_ts(), naive_tz)
    return studies.select(
        *envelope(
            source=F.lit(REGISTRY),
            record_type=F.lit(CLINICAL_TRIAL),
            observed_at=F.coalesce(dated, run_ts),
            raw=s,
            normalized=normalized_struct(
                trial_id=nct_id,
                title=_get(s, f"{ps}.identificationModule.briefTitle"),
                phase=phase_v.cast("string"),
                status=_get(s, f"{st}.overallStatus"),
                conditions=conditions,
                lead_sponsor=sponsor,
                canonical_lead_sponsor=normalize_company(sponsor),
                canonical_drugs=canonical_drugs(interventions),
            ),
            identifiers=identifiers_map(nct_id=nct_id),
            source_key=F.col("source_key"),
            page_no=F.col("page_no"),
            pos=F.col("pos"),
            undated=dated.isNull(),
        ),
        *(keep or []),
    )


def recall_envelope(results: DataFrame, run_ts: Column, result_col: str = "result", naive_tz: str = "UTC",
                    keep: list[Column] | None = None) -> DataFrame:
    """One recall result (VARIANT) -> envelope."""
    r = F.col(result_col)
    report_date = _get(r, "$.report_date")
    recall_number = _get(r, "$.recall_number")
    event_id = first_truthy(
        _get(r, "$.event_id"), recall_number, _get(r, "$.safetyreportid"), _get(r, "$.application_number")
    )
    title = first_truthy(
        _get(r, "$.product_description"), _get(r, "$.reason_for_recall"), _get(r, "$.openfda.brand_name[0]")
    )
    dated = parse_recall_date(first_truthy(report_date, _get(r, "$.recall_initiation_date")), _no_ts(), naive_tz)
    return results.select(
        *envelope(
            source=F.lit(RECALLS),
            record_type=F.lit(REGULATORY_UPDATE),
            observed_at=F.coalesce(dated, run_ts),
            raw=r,
            normalized=normalized_struct(
                title=title,
                status=_get(r, "$.status"),
                classification=_get(r, "$.classification"),
                report_date=report_date,
            ),
            identifiers=identifiers_map(event_id=event_id, recall_number=recall_number),
            source_key=F.col("source_key"),
            page_no=F.col("page_no"),
            pos=F.col("pos"),
            undated=dated.isNull(),
        ),
        *(keep or []),
    )


def rss_envelope(items: DataFrame, source: str, run_ts: Column, naive_tz: str = "UTC",
                 keep: list[Column] | None = None) -> DataFrame:
    """RSS item (title, link, pubDate text) -> envelope; ``source`` is ema or fda."""
    title, link, pub = F.col("title"), F.col("link"), F.col("pubDate")
    raw = F.to_variant_object(F.struct(title.alias("title"), link.alias("link"), pub.alias("pubDate")))
    dated = parse_rss_date(pub, _no_ts(), naive_tz)
    return items.select(
        *envelope(
            source=F.lit(source),
            record_type=F.lit(REGULATORY_UPDATE),
            observed_at=F.coalesce(dated, run_ts),
            raw=raw,
            normalized=normalized_struct(title=title, link=link),
            identifiers=identifiers_map(link=link),
            source_key=F.col("source_key"),
            page_no=F.col("page_no"),
            pos=F.col("pos"),
            undated=dated.isNull(),
        ),
        *(keep or []),
    )


def stamp_ingested_at(df: DataFrame, run_ts: Column) -> DataFrame:
    """``ingested_at`` = the run time (overwrites)."""
    return df.withColumn("ingested_at", run_ts)


def _list_or_text(c: Column) -> Column:
    """A value kept as text that is a JSON list goes out as that list."""
    return F.when(c.startswith("["), F.coalesce(F.try_parse_json(c), c.cast("variant"))).otherwise(c.cast("variant"))


def _keys_json(col: Column, keys_by_source: dict[str, list[str]], source: Column) -> Column:
    """JSON of a struct restricted to the source's own keys (others: non-null fields)."""
    branches = None
    for src, keys in keys_by_source.items():
        parts = [(_list_or_text(col[k]) if k == "phase" else col[k]).alias(k) for k in keys]
        js = F.to_json(F.struct(*parts), {"ignoreNullFields": "false"})
        branches = (F.when(source == src, js) if branches is None else branches.when(source == src, js))
    fallback = F.to_json(col)
    return branches.otherwise(fallback) if branches is not None else fallback


def record_json(df: DataFrame, zulu: bool = True) -> Column:
    """JSON text of an envelope row as the sink writes it.

    Keys in the validated record's order; timestamps as ISO text (``Z`` after
    validation); ``normalized`` with only the source's keys (nulls kept; other
    sources: non-null fields). ``raw`` is written as the JSON it came from.
    """
    src = F.col("source")
    ident = F.map_from_entries(F.array_sort(F.map_entries(F.col("identifiers"))))
    # Build through one struct so Spark does all string escaping.
    body = F.to_json(
        F.struct(
            src.alias("source"),
            F.col("record_type").alias("record_type"),
            iso_utc("observed_at", zulu).alias("observed_at"),
            iso_utc("ingested_at", zulu).alias("ingested_at"),
        ),
        {"ignoreNullFields": "false"},
    )
    raw_json = F.coalesce(F.to_json(F.col("raw")), F.lit("null"))
    norm_json = _keys_json(F.col("normalized"), NORMALIZED_KEYS, src)
    ident_json = F.coalesce(F.to_json(ident), F.lit("{}"))
    return F.concat(
        body.substr(F.lit(1), F.length(body) - 1),
        F.lit(',"raw":'), raw_json,
        F.lit(',"normalized":'), norm_json,
        F.lit(',"identifiers":'), ident_json,
        F.lit("}"),
    )
