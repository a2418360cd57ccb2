"""Record validation (F5), modes (F6), rejects (F9) and counters (A4).

Rules: ``source`` and ``record_type`` are present and not blank (returned
stripped as Python strips); ``observed_at`` is present; ``raw``,
``normalized`` and ``identifiers`` are present (``raw`` must be an object).
The envelope is typed, so type errors cannot occur; ``ingested_at`` may be null.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import VariantType

from feedline.functions.text import py_strip

MODES = ("drop", "strict", "warn")
ERRORS_TYPE = "array<struct<field:string,error:string>>"


class ValidationFailed(Exception):
    """Strict mode found invalid records; nothing was written."""


def normalize_mode(mode: str | None) -> str:
    m = (mode or "drop").strip().lower()
    if m not in MODES:
        raise ValueError(f"unknown validation mode {mode!r}; expected one of {MODES}")
    return m


def _err(field: str, error: str, cond: Column) -> Column:
    return F.when(cond, F.struct(F.lit(field).alias("field"), F.lit(error).alias("error")))


def _text_errors(df: DataFrame, field: str) -> list[Column]:
    c = F.col(field)
    return [
        _err(field, "missing", c.isNull()),
        _err(field, "empty", c.isNotNull() & (py_strip(c) == "")),
    ]


def validation_errors(df: DataFrame) -> Column:
    """array of (field, error); empty array = valid."""
    checks = _text_errors(df, "source") + _text_errors(df, "record_type")
    checks.append(_err("observed_at", "missing", F.col("observed_at").isNull()))
    raw = F.col("raw")
    checks.append(_err("raw", "missing", raw.isNull()))
    if isinstance(df.schema["raw"].dataType, VariantType):
        from feedline.operators.drugs import is_object

        checks.append(_err("raw", "not_object", raw.isNotNull() & ~is_object(raw)))
    for field in ("normalized", "identifiers"):
        checks.append(_err(field, "missing", F.col(field).isNull()))
    return F.array_compact(F.array(*checks)).cast(ERRORS_TYPE)


@dataclass
class Validation:
    """Result of ``validate``: frames are lazy; ``checked`` carries ``_errors``."""

    mode: str
    enabled: bool
    checked: DataFrame
    accepted: DataFrame
    rejected: DataFrame

    def counts(self) -> DataFrame:
        """A4: passed / failed (both 0 when validation is off)."""
        if not self.enabled:
            return self.checked.sparkSession.range(1).select(
                F.lit(0).cast("bigint").alias("validation_passed"),
                F.lit(0).cast("bigint").alias("validation_failed"),
            )
        ok = F.size("_errors") == 0
        return self.checked.agg(
            F.count_if(ok).alias("validation_passed"), F.count_if(~ok).alias("validation_failed")
        )

    def raise_if_strict(self) -> None:
        """F6 strict: fail before anything is written if one record is invalid."""
        if self.enabled and self.mode == "strict" and self.rejected.limit(1).count() > 0:
            raise ValidationFailed("strict validation: invalid records present, nothing written")


def annotate(df: DataFrame) -> DataFrame:
    """Adds ``_errors`` and ``_valid``; valid rows get ``source``/``record_type``
    stripped, invalid rows stay as they came. Row-local, so it can run once
    before a frame is staged and every later mode reuses it."""
    checked = df.withColumn("_errors", validation_errors(df))
    ok = F.size("_errors") == 0
    return (
        checked.withColumn("source", F.when(ok, py_strip("source")).otherwise(F.col("source")))
        .withColumn("record_type", F.when(ok, py_strip("record_type")).otherwise(F.col("record_type")))
        .withColumn("_valid", ok)
    )


def validate(df: DataFrame, mode: str = "drop", enabled: bool = True) -> Validation:
    """split into accepted and rejected rows.

    drop/strict: accepted = valid rows with ``source``/``record_type`` stripped.
    warn: also forwards invalid rows unmodified. Off: all rows, nothing counted.
    Accepted rows carry ``_valid`` (True for rows that passed). A frame that
    already went through ``annotate`` is not checked again.
    """
    m = normalize_mode(mode)
    if not enabled:
        base = df.drop("_errors", "_valid")
        checked = base.withColumn("_errors", F.array().cast(ERRORS_TYPE))
        return Validation(m, False, checked, base.withColumn("_valid", F.lit(False)), checked.limit(0))
    checked = df if "_errors" in df.columns and "_valid" in df.columns else annotate(df)
    ok = F.col("_valid")
    accepted = checked if m == "warn" else checked.where(ok)
    rejected = checked.where(~ok)
    return Validation(m, True, checked, accepted.drop("_errors"), rejected.drop("_valid"))


def rejects(v: Validation) -> DataFrame:
    """one row per failing record with source, record type, mode and errors."""
    return v.rejected.select(
        F.lit("validation_failed").alias("event"),
        "source",
        "record_type",
        F.lit(v.mode).alias("mode"),
        F.col("_errors").alias("errors"),
        "_source_key",
        "_page_no",
        "_pos",
    )
