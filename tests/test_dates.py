"""N5, N6a, N6b, N9."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from feedline.functions.dates import iso_utc, parse_recall_date, parse_rss_date, run_timestamp, study_observed_at

RUN = "2030-01-01 00:00:00"


def _ts(spark, col_fn, value):
    df = spark.createDataFrame([(value,)], "x string")
    return df.select(F.date_format(col_fn(F.col("x")), "yyyy-MM-dd HH:mm:ss").alias("y")).first()["y"]


@pytest.mark.parametrize(
    "text,expected",
    [
        ("20240501", "2024-05-01 00:00:00"),
        ("2024-05-01T01:02:03+02:00", "2024-04-30 23:02:03"),
        ("2024-05-01T01:02:03", "2024-05-01 01:02:03"),
        ("20241399", RUN),
        ("20240230", RUN),
        ("2024-05", RUN),
        ("junk", RUN),
        ("", RUN),
        (None, RUN),
    ],
)
def test_recall_date(spark, text, expected):
    assert _ts(spark, lambda c: parse_recall_date(c, run_timestamp(RUN)), text) == expected


@pytest.mark.parametrize(
    "text,expected",
    [
        ("Tue, 14 Apr 2026 10:00:00 +0200", "2026-04-14 08:00:00"),
        ("Tue, 14 Apr 2026 10:00:00 GMT", "2026-04-14 10:00:00"),
        ("14 Apr 2026 10:00 +0000", "2026-04-14 10:00:00"),
        ("Tue, 14 Apr 2026 10:00:00 EST", "2026-04-14 10:00:00"),
        ("2026-04-14T10:00:00Z", "2026-04-14 10:00:00"),
        ("May 1, 2024", "2024-05-01 00:00:00"),
        ("2024-05", "2024-05-01 00:00:00"),
        ("nonsense", RUN),
        (None, RUN),
    ],
)
def test_rss_date(spark, text, expected):
    assert _ts(spark, lambda c: parse_rss_date(c, run_timestamp(RUN)), text) == expected


def test_study_date_first_parsable(spark):
    df = spark.createDataFrame([(None, "bad", "2024-05-01", "2020-01-01", None)], "a string, b string, c string, d string, e string")
    got = df.select(F.date_format(study_observed_at([F.col(c) for c in "abcde"], run_timestamp(RUN)), "yyyy-MM-dd").alias("y")).first()["y"]
    assert got == "2024-05-01"


def test_study_date_none_is_run_time(spark):
    df = spark.createDataFrame([(None, "", "x")], "a string, b string, c string")
    got = df.select(F.date_format(study_observed_at([F.col(c) for c in "abc"], run_timestamp(RUN)), "yyyy-MM-dd HH:mm:ss").alias("y")).first()["y"]
    assert got == RUN


def test_iso_utc_forms(spark):
    df = spark.createDataFrame([(dt.datetime(2026, 4, 14), dt.datetime(2026, 4, 14, 0, 0, 0, 120000))], "a timestamp, b timestamp")
    r = df.select(iso_utc("a").alias("a"), iso_utc("b").alias("b"), iso_utc("a", zulu=False).alias("c")).first()
    assert r["a"] == "2026-04-14T00:00:00Z"
    assert r["b"] == "2026-04-14T00:00:00.120000Z"
    assert r["c"] == "2026-04-14T00:00:00+00:00"


@pytest.mark.parametrize(
    "text,expected",
    [
        ("Tue, 14 Apr 2026 10:00:00 EST", "2026-04-14 14:00:00"),  # zone name dropped, read in naive_tz
        ("Tue, 14 Apr 2026 10:00:00 +0200", "2026-04-14 08:00:00"),  # offsets win
        ("2026-04-14T10:00:00", "2026-04-14 14:00:00"),
        ("2026-04-14T10:00:00Z", "2026-04-14 10:00:00"),
        ("2026-04-14", "2026-04-14 04:00:00"),
    ],
)
def test_naive_time_zone(spark, text, expected):
    assert _ts(spark, lambda c: parse_rss_date(c, run_timestamp(RUN), naive_tz="America/New_York"), text) == expected
