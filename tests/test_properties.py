"""Property tests of the expressions on random (often hostile) text."""

import datetime as dt
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from feedline.functions.text import COMPANY_SUFFIXES, DRUG_FORM_TOKENS, normalize_company, normalize_drug, normalize_text

ALPHABET = st.characters(blacklist_categories=("Cs",))
TEXT = st.text(alphabet=ALPHABET, max_size=40) | st.sampled_from(
    ["Pfizer, Inc.", "  ACME co. LTD GmbH ", "oral tablet", "Société Générale S.A.", "x\x1fy z", "--", ""])
WORDS = st.lists(st.sampled_from(list(COMPANY_SUFFIXES + DRUG_FORM_TOKENS) + ["acme", "x1", "Bio", ",", "."]),
                 max_size=6).map(" ".join)


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(TEXT | WORDS, min_size=30, max_size=60))
def test_name_properties(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    got = df.select("v", normalize_text("v").alias("t"), normalize_company("v").alias("c"), normalize_drug("v").alias("d"))
    got = got.select("*", normalize_text("t").alias("t2"), normalize_company("c").alias("c2"), normalize_drug("d").alias("d2"))
    for r in got.collect():
        assert (r["t"], r["c"], r["d"]) == (r["t2"], r["c2"], r["d2"])  # cleaning twice changes nothing
        for name in (r["t"], r["c"], r["d"]):
            assert name is None or re.fullmatch(r"[a-z0-9]+( [a-z0-9]+)*", name)
        assert (r["t"] is None) == (r["c"] is None) == (r["d"] is None)
        if r["t"] is not None:
            all_suffixes = set(r["t"].split()) <= set(COMPANY_SUFFIXES)
            all_forms = set(r["t"].split()) <= set(DRUG_FORM_TOKENS)
            assert all_suffixes or r["c"].split()[-1] not in COMPANY_SUFFIXES
            assert all_forms or not set(r["d"].split()) & set(DRUG_FORM_TOKENS)


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(st.text(alphabet=ALPHABET, max_size=15) | st.none(), st.text(max_size=10, alphabet=ALPHABET)),
                     min_size=10, max_size=20, unique=True))
def test_fingerprints_tell_records_apart(spark, rows):
    from feedline.functions.fingerprint import fingerprint

    df = spark.createDataFrame([(t, link) for t, link in rows * 2], "title string, link string")
    fp = fingerprint(F.lit("ema"), F.lit("regulatory_update"), F.lit("2026-04-14T00:00:00Z"),
                     F.create_map(F.lit("link"), F.col("link")), F.col("title"), F.col("link"),
                     F.lit(None).cast("string"), F.lit(None).cast("string"))
    got = [r["fp"] for r in df.select(fp.alias("fp")).collect()]
    assert all(re.fullmatch(r"fp:[0-9a-f]{64}", g) for g in got)
    assert len(set(got)) == len(rows)


WORD = st.sampled_from(["ab", "abc", "b", "zz", "cab", "xyz", "a", "bca", "q"])


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(docs=st.lists(st.tuples(st.lists(WORD, max_size=5).map(" ".join), st.lists(WORD, max_size=3).map(" ".join),
                               st.lists(st.lists(WORD, max_size=4).map(" ".join), max_size=3)),
                     min_size=5, max_size=15),
       targets=st.lists(st.lists(WORD, min_size=1, max_size=3).map(" ".join), min_size=3, max_size=12))
def test_many_targets_equal_brute_force(spark, docs, targets):
    from feedline.operators.match import match_targets, prepare_targets

    recs = spark.createDataFrame([(i, t, s, c) for i, (t, s, c) in enumerate(docs)],
                                 "id int, title string, lead_sponsor string, conditions array<string>")
    recs = recs.withColumn("canonical_lead_sponsor", normalize_company("lead_sponsor"))
    tdf = spark.createDataFrame(list(enumerate(targets)), "tid int, t string")
    got = {(r.id, r.target_id) for r in match_targets(recs, ["id"], prepare_targets(tdf, "tid", "t")).collect()}
    # The single-target match of the same library, target by target.
    from feedline.operators.match import canonical_target, matches_company

    want = set()
    for tid, t in enumerate(targets):
        hit = matches_company(t, F.col("title"), F.col("lead_sponsor"), F.col("conditions"),
                              F.col("canonical_lead_sponsor"), canonical_target(spark, t))
        want |= {(r.id, tid) for r in recs.where(hit).select("id").collect()}
    assert got == want


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(points=st.lists(st.tuples(
    st.datetimes(min_value=dt.datetime(1971, 1, 1), max_value=dt.datetime(2099, 12, 31)),
    st.integers(min_value=-14 * 60, max_value=14 * 60)), min_size=10, max_size=25))
def test_dates_round_trip(spark, points):
    from email.utils import format_datetime

    from feedline.functions.dates import parse_recall_date, parse_rss_date, run_timestamp

    rows, want = [], []
    for i, (naive, minutes) in enumerate(points):
        naive = naive.replace(microsecond=0)
        zone = dt.timezone(dt.timedelta(minutes=minutes))
        aware = naive.replace(tzinfo=zone)
        utc = aware.astimezone(dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
        rows.append((i, format_datetime(aware), aware.isoformat(), naive.strftime("%Y%m%d")))
        want.append((utc, utc, naive.strftime("%Y-%m-%d 00:00:00")))
    df = spark.createDataFrame(rows, "i int, rfc string, iso string, ymd string")
    run = run_timestamp("1900-01-01 00:00:00")
    fmt = "yyyy-MM-dd HH:mm:ss"
    got = df.select(
        "i",
        F.date_format(parse_rss_date("rfc", run), fmt).alias("a"),
        F.date_format(parse_rss_date("iso", run), fmt).alias("b"),
        F.date_format(parse_recall_date("ymd", run), fmt).alias("c"),
    ).orderBy("i").collect()
    assert [(r["a"], r["b"], r["c"]) for r in got] == want
