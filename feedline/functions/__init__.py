"""Column -> Column functions (all built-in Spark expressions, no UDFs)."""

from feedline.functions.dates import (
    iso_utc,
    parse_lenient,
    parse_recall_date,
    parse_rss_date,
    study_observed_at,
)
from feedline.functions.expr import first_truthy, null_safe_max, null_safe_min, source_key, text_key
from feedline.functions.fingerprint import fingerprint
from feedline.functions.text import (
    normalize_company,
    normalize_drug,
    normalize_text,
    py_strip,
    strip_company_suffixes,
    strip_drug_forms,
)

__all__ = [
    "first_truthy",
    "fingerprint",
    "iso_utc",
    "normalize_company",
    "normalize_drug",
    "normalize_text",
    "null_safe_max",
    "null_safe_min",
    "parse_lenient",
    "parse_recall_date",
    "parse_rss_date",
    "py_strip",
    "source_key",
    "strip_company_suffixes",
    "strip_drug_forms",
    "study_observed_at",
    "text_key",
]
