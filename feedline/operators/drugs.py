"""Drug interventions: keep drug-typed objects (F4), canonical set (A5)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedline.functions.text import normalize_drug, py_strip


def is_object(v: Column) -> Column:
    """True for a JSON object; a cast to the empty struct reads only the type tag."""
    return F.try_variant_get(v, "$", "struct<>").isNotNull()


def intervention_type_text(x: Column) -> Column:
    """The type as the reference compares it: missing -> '', JSON null -> 'none'."""
    t = F.try_variant_get(x, "$.type", "variant")
    return (
        F.when(t.isNull(), F.lit(""))
        .when(F.is_variant_null(t), F.lit("none"))
        .otherwise(F.lower(py_strip(t.cast("string"))))
    )


def is_drug_intervention(x: Column) -> Column:
    """an object whose type is missing/blank or contains 'drug' (any case)."""
    t = intervention_type_text(x)
    return is_object(x) & ((t == "") | t.contains("drug"))


def drug_names(interventions: Column) -> Column:
    """Raw names of the kept interventions (array<string>)."""
    kept = F.filter(interventions, is_drug_intervention)
    return F.transform(kept, lambda x: F.try_variant_get(x, "$.name", "string"))


def canonical_drugs(interventions: Column) -> Column:
    """A5: distinct, sorted canonical names (nulls dropped); no interventions -> []."""
    names = F.transform(drug_names(F.coalesce(interventions, F.array().cast("array<variant>"))), normalize_drug)
    return F.sort_array(F.array_distinct(F.filter(names, lambda n: n.isNotNull())))
