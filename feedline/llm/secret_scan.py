r"""Secret scan: fixed patterns, and character Markov models.

Base spans come from three patterns (assignments, access keys, hex runs). The
method adds tokens of at least ``least_chars`` characters, or what base spans
leave of them if that is as long, that look random: two first-order Markov models over
bytes, one of random strings and one of ordinary identifiers, compared by the
mean log-likelihood ratio per step. Labelled samples come from the corpus: the
values of base spans are the random strings, other ASCII runs of all documents
the identifiers.

Native DataFrame functions only. Positions follow from splitting at a pattern
and adding up lengths. One scan stages narrow rows: base spans and candidate
tokens per document; training and scoring read those. The model is one row of
128 x 128 ratios, read as a scalar subquery.

Edge cases: a null text is empty and has no spans; without any base span the
method adds nothing; positions are code points, whatever the script; very long
texts are scanned whole; equal rows get equal results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedline.llm.common import staged, with_text

# Kinds in order, with the pattern as stated by the contract. Access and hex
# runs are maximal, so their least length may stand in the pattern.
ASSIGN = r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9+/_.=-]+"
ASSIGN_VALUE = r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "markov")
TOKEN = r"[A-Za-z0-9+/_=-]"
LONG_RUN = TOKEN + "{20,}"  # no example of an ordinary identifier
LEAST_CHARS = 16  # of a token that is scored, and of a base value that is an example of a random one
IDENTIFIER = r"[A-Za-z0-9_]{6,}"
MIN_VALUE = 6
CODES = 128


def found(text: Column, pattern: str) -> Column:
    """All leftmost non-overlapping matches as ``struct(start, end, s)``."""
    between, hits = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    none = F.array().cast("array<struct<start:int,end:int,s:string>>")
    pairs = F.arrays_zip(F.slice(between, 1, F.size(hits)).alias("gap"), hits.alias("s"))
    pairs = F.transform(pairs, lambda p: F.struct(F.length(p["gap"]).alias("gap"), p["s"].alias("s")))
    zero = F.struct(F.lit(0).alias("at"), none.alias("out"))

    def step(a, p):
        start = a["at"] + p["gap"]
        end = start + F.length(p["s"])
        return F.struct(end.alias("at"), F.concat(a["out"], F.array(F.struct(start.alias("start"), end.alias("end"), p["s"].alias("s")))).alias("out"))

    return F.when(F.size(hits) == 0, none).otherwise(F.aggregate(pairs, zero, step, lambda a: a["out"]))


def uncovered(token: Column, base: Column, least_chars: int) -> Column:
    """The parts of a token between the base spans (sorted by start) that are
    long enough."""
    part = lambda a, b: F.struct(a.alias("start"), b.alias("end"), F.substring(token["s"], a - token["start"] + 1, b - a).alias("s"))
    none = F.array().cast("array<struct<start:int,end:int,s:string>>")
    add = lambda out, a, b: F.when(b - a >= least_chars, F.concat(out, F.array(part(a, b)))).otherwise(out)
    on = F.filter(base, lambda b: (b["start"] < token["end"]) & (token["start"] < b["end"]))
    zero = F.struct(token["start"].alias("at"), none.alias("out"))
    step = lambda a, b: F.struct(F.greatest(a["at"], b["end"]).alias("at"), add(a["out"], a["at"], b["start"]).alias("out"))
    return F.when(F.size(on) == 0, F.array(token)).otherwise(F.aggregate(on, zero, step, lambda a: add(a["out"], a["at"], token["end"])))


def scan(docs: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """doc_id, ``base`` (kind number, start, end, value) and ``tokens`` (runs
    of at least ``least_chars`` outside all base spans)."""
    d = with_text(docs)
    t = F.col("text")
    value = lambda s: F.regexp_extract(s, ASSIGN_VALUE, 1)
    tag = lambda kind, spans, val: F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), F.lit(kind).alias("kind"), s["end"].alias("end"), val(s["s"]).alias("s")))
    assign = F.filter(tag(0, found(t, ASSIGN), value), lambda s: F.length(s["s"]) >= MIN_VALUE)
    base = F.sort_array(F.concat(assign, tag(1, found(t, ACCESS), lambda s: s), tag(2, found(t, HEX), lambda s: s)))
    d = d.select("doc_id", base.alias("base"), found(t, f"{TOKEN}{{{least_chars},}}").alias("tokens"))
    return d.select("doc_id", "base", F.flatten(F.transform("tokens", lambda x: uncovered(x, F.col("base"), least_chars))).alias("tokens"))


def steps(s: Column) -> Column:
    """Numbers ``128 * this + next`` of a string's neighbouring ASCII codes."""
    codes = F.transform(F.filter(F.split(s, ""), lambda c: c != ""), lambda c: F.least(F.ascii(c), F.lit(CODES - 1)))
    return F.zip_with(F.slice(codes, 1, F.greatest(F.size(codes) - 1, F.lit(0))), F.slice(codes, 2, F.greatest(F.size(codes) - 1, F.lit(1))),
                      lambda a, b: a * CODES + b)


def step_counts(strings: DataFrame) -> DataFrame:
    """``step, n`` of a column ``s`` of strings; every distinct string is taken
    apart once."""
    counted = strings.groupBy("s").agg(F.count(F.lit(1)).alias("times"))
    at = counted.select("times", F.explode(F.filter(steps(F.col("s")), lambda x: x.isNotNull())).alias("step"))
    return at.groupBy("step").agg(F.sum("times").alias("n"))


def log_ratio(random: DataFrame, ordinary: DataFrame, smooth: float = 0.5) -> DataFrame:
    """One row: the array of log P_random(next | this) - log P_ordinary(next |
    this) for all pairs of codes, both smoothed over the printable codes."""
    from pyspark.sql import Window as W

    spark = random.sparkSession
    grid = spark.range(CODES * CODES).select(F.col("id").cast("int").alias("step"))
    row = W.partitionBy(F.floor(F.col("step") / CODES))
    total = 95 * smooth
    g = grid.join(random.withColumnRenamed("n", "a"), "step", "left").join(ordinary.withColumnRenamed("n", "b"), "step", "left").fillna(0, ["a", "b"])
    p = lambda c: F.log((F.col(c) + smooth) / (F.sum(c).over(row) + total))
    g = g.select("step", (p("a") - p("b")).alias("r"))
    return g.agg(F.sort_array(F.collect_list(F.struct("step", "r"))).alias("x")).select(F.col("x.r").alias("ratios"))


def identifiers(docs: DataFrame) -> DataFrame:
    """ASCII runs of the documents, none of a base kind."""
    plain = F.regexp_replace(F.regexp_replace("text", ASSIGN, " "), f"{ACCESS}|{HEX}|{LONG_RUN}", " ")
    return with_text(docs).select(F.explode(F.regexp_extract_all(plain, F.lit(IDENTIFIER), F.lit(0))).alias("s"))


def secrets(docs: DataFrame, least: float = 0.5, least_chars: int = LEAST_CHARS) -> DataFrame:
    """Per input row: doc_id and ``spans`` (start, kind, end, s), sorted by
    start, then kind in the order of ``KINDS``; base spans always, and tokens
    whose mean ratio per step is at least ``least``."""
    rows = staged(scan(docs, least_chars), "secret-spans")
    random = rows.select(F.explode("base").alias("b")).select("b.s").where(F.length("s") >= LEAST_CHARS)
    model = staged(log_ratio(step_counts(random), step_counts(identifiers(docs))), "markov")
    trained = staged(random.limit(1).agg((F.count(F.lit(1)) > 0).alias("any")), "trained").select("any").scalar()
    rows = rows.withColumn("ratios", F.when(trained, model.select("ratios").scalar()))

    def looks_random(t: Column) -> Column:
        each = F.transform(steps(t["s"]), lambda k: F.get(F.col("ratios"), k))
        return F.aggregate(each, F.lit(0.0), lambda a, x: a + x) / F.size(each) >= least

    added = F.transform(F.filter("tokens", looks_random), lambda t: F.struct(
        t["start"].alias("start"), F.lit(3).alias("kind"), t["end"].alias("end"), t["s"].alias("s")))
    return rows.select("doc_id", "base", F.sort_array(F.concat("base", added)).alias("spans"))


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def kind_count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("long")
