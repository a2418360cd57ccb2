"""Name clean-up (N1-N3) as Column expressions.

All three run JVM-side inside whole-stage codegen: one regex replace, one trim,
and for drugs a higher-order ``filter`` over the token array.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values (must equal the reference's for equal results) -----------
# Company suffix tokens, removed repeatedly from the end of a name.
COMPANY_SUFFIXES = (
    "inc", "incorporated", "corp", "corporation", "co", "company", "ltd",
    "limited", "llc", "plc", "sa", "ag", "gmbh", "bv",
)
# Drug form tokens, removed wherever they occur in a name.
DRUG_FORM_TOKENS = (
    "tablet", "tablets", "capsule", "capsules", "injection", "solution",
    "oral", "iv", "mg", "mcg", "ml",
)
# -----------------------------------------------------------------------------

# One or more suffix tokens that reach the end of the text.
_SUFFIX_TAIL = "(?:(?:^| )(?:" + "|".join(COMPANY_SUFFIXES) + "))+$"
# Characters Python's str.strip() removes: Java \s, the separators \x1c-\x1f,
# NEL and every Unicode separator (Zs, Zl, Zp).
_PY_SPACE = r"[\s\x{1c}-\x{1f}\x{85}\p{Z}]"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_text(c: Column | str) -> Column:
    """Lower, every run of characters outside a-z0-9 -> one blank, trim.

    Empty or null -> null. Non-ASCII letters become blanks.
    """
    cleaned = F.trim(F.regexp_replace(F.lower(_c(c)), "[^a-z0-9]+", " "))
    return F.nullif(cleaned, F.lit(""))


def strip_company_suffixes(normalized: Column) -> Column:
    """Drop trailing suffix tokens; if nothing is left keep the input."""
    stripped = F.regexp_replace(normalized, _SUFFIX_TAIL, "")
    return F.coalesce(F.nullif(stripped, F.lit("")), normalized)


def strip_drug_forms(normalized: Column) -> Column:
    """Drop form tokens anywhere; if nothing is left keep the input."""
    kept = F.array_join(
        F.filter(F.split(normalized, " "), lambda t: ~t.isin(*DRUG_FORM_TOKENS)), " "
    )
    return F.coalesce(F.nullif(kept, F.lit("")), normalized)


def normalize_company(c: Column | str) -> Column:
    """N2 without an alias table (see operators.alias for the look-ups)."""
    return strip_company_suffixes(normalize_text(c))


def normalize_drug(c: Column | str) -> Column:
    """N3 without an alias table."""
    return strip_drug_forms(normalize_text(c))


def py_strip(c: Column | str) -> Column:
    """Strip white space at both ends the way Python's ``str.strip`` does."""
    return F.regexp_replace(_c(c), f"^{_PY_SPACE}+|{_PY_SPACE}+$", "")
