"""F5/F6/F9/A4 validation and W1/J2/N7 de-duplication."""

import pytest
from pyspark.sql import functions as F

from feedline.operators.dedup import dedup, first_seen, record_fingerprint, record_path, with_dedup_key
from feedline.operators.validate import ValidationFailed, validate
from tests.helpers import records

VALID = dict(source="harbour\t", record_type="\n tide table", observed_at="2023-02-28 23:59:30.25", ingested_at="2023-03-01 00:00:00",
             raw={"gauge": [4, 7], "unit": "m"}, normalized={"link": "tides/4", "status": "open"}, identifiers={"nct_id": "NCT77700042", "event_id": "g4-0059", "link": "tides/4"})


def test_valid_record_is_trimmed(spark):
    v = validate(records(spark, [VALID]), "drop")
    r = v.accepted.first()
    assert (r["source"], r["record_type"], r["normalized"]["status"]) == ("harbour", "tide table", "open")
    assert v.counts().first().asDict() == {"validation_passed": 1, "validation_failed": 0}


@pytest.mark.parametrize("change", [dict(source=None), dict(record_type="   "), dict(observed_at=None),
                                    dict(raw=None), dict(normalized=None)])
def test_invalid_records(spark, change):
    v = validate(records(spark, [{**VALID, **change}]), "drop")
    assert v.accepted.count() == 0
    assert v.counts().first()["validation_failed"] == 1


INVALID = dict(source="", record_type="regulatory_update", observed_at="2026-04-14 00:00:00", raw={}, normalized={},
               identifiers={})


def test_modes(spark):
    df = records(spark, [INVALID])
    assert validate(df, "drop").accepted.count() == 0
    warn = validate(df, "warn")
    assert warn.accepted.first()["source"] == ""
    assert warn.counts().first()["validation_failed"] == 1
    with pytest.raises(ValidationFailed):
        validate(df, "strict").raise_if_strict()
    off = validate(records(spark, [{**INVALID, "source": "fda_openfda"}]), "drop", enabled=False)
    assert off.accepted.count() == 1
    assert off.counts().first().asDict() == {"validation_passed": 0, "validation_failed": 0}
    with pytest.raises(ValueError):
        validate(df, "loud")


def test_rejects_list_fields(spark):
    from feedline.operators.validate import rejects

    r = rejects(validate(records(spark, [{**INVALID, "record_type": None}]), "drop")).first()
    assert r["mode"] == "drop"
    assert sorted((e["field"], e["error"]) for e in r["errors"]) == [("record_type", "missing"), ("source", "empty")]


def test_fingerprint_is_fixed(spark):
    rec = dict(source="ema", record_type="regulatory_update", observed_at="2026-04-14 10:00:00",
               raw={"a": 1}, normalized={"title": 'Über "quoted" / slash', "link": "https://x/é"},
               identifiers={"link": "https://x/é", "b": None})
    df = records(spark, [rec])
    got = df.select(record_fingerprint(df).alias("fp")).first()["fp"]
    assert got == "fp:79b402d8b267a6f7f58cb5138aea0bc4a8ce847014ba6e81cf403caf7e223515"


def test_fingerprint_ignores_ingested_and_raw_not_observed(spark):
    base = dict(source="ema", record_type="r", observed_at="2026-04-14 10:00:00", normalized={"title": "t"})
    df = records(spark, [base, {**base, "ingested_at": "2026-01-01 00:00:00", "raw": {"x": 2}},
                         {**base, "observed_at": "2026-04-15 10:00:00"}])
    fps = [r["fp"] for r in df.select(record_fingerprint(df).alias("fp")).orderBy("_pos").collect()]
    assert fps[0] == fps[1] != fps[2]


def test_key_path_falls_back_to_fingerprint(spark):
    df = records(spark, [dict(VALID, identifiers={"nct_id": ""}), dict(VALID, identifiers={"nct_id": None}),
                         dict(VALID)])
    keys = [r["dedup_key"] for r in with_dedup_key(df).orderBy("_pos").collect()]
    assert keys[0].startswith("fp:") and keys[1].startswith("fp:") and keys[2] == "NCT77700042"


def test_record_path_not_object(spark):
    df = records(spark, [VALID])
    assert df.select(record_path(df, "source.x").alias("k")).first()["k"] is None
    assert df.select(record_path(df, "raw.unit").alias("k")).first()["k"] == "m"
    assert df.select(record_path(df, "").alias("k")).first()["k"] is None


def test_first_wins_then_later_run(spark, scratch):
    from feedline.sources.state import append_seen, read_seen

    df = records(spark, [dict(VALID, page=1, pos=0), dict(VALID, page=1, pos=1, normalized={"title": "later"}),
                         dict(VALID, identifiers={}, page=2, pos=0), dict(VALID, identifiers={}, page=2, pos=1)])
    keyed = with_dedup_key(df, fallback=False)
    store = scratch("seen")
    kept, new_keys = dedup(keyed, read_seen(spark, store))
    rows = kept.orderBy("_page_no", "_pos").collect()
    assert [(r["_page_no"], r["_pos"]) for r in rows] == [(1, 0), (2, 0), (2, 1)]
    assert rows[0]["normalized"]["status"] == "open"
    append_seen(new_keys, f"{store}/run=r1")
    again, _ = dedup(keyed, read_seen(spark, store))
    assert again.where(F.col("dedup_key").isNotNull()).count() == 0
    assert again.count() == 2


def test_first_seen_hot_key_spreads(spark):
    rows = [dict(VALID, page=p, pos=i) for p in range(3) for i in range(5)]
    df = with_dedup_key(records(spark, rows), fallback=False)
    kept = first_seen(df).collect()
    assert [(r["_page_no"], r["_pos"]) for r in kept] == [(0, 0)]
