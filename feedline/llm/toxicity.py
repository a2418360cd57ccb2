r"""Toxicity: a weighted lexicon matched by Aho-Corasick.

Texts are folded first: compatibility forms, look-alike letters of other
scripts and digit substitutions become plain Latin letters, punctuation becomes
a blank. The lexicon holds word beginnings (an entry matches at the start of a
word) with weights; exception phrases mask the entries inside them. The summed
weights, also per 100 words, go through a logistic curve. Exception phrases are
learned: up to three words around an entry that are clearly rarer in toxic rows
than in others.

Training uses a bounded sample of labelled rows (``max_rows``, lowest hash of
doc_id first) of the training fold. Entry and phrase counts are summed in the
tasks and in Spark; only the chosen entries (``max_entries``), the chosen
phrases (``max_exceptions``) and three numbers per sampled row reach the driver. Scoring is per document in Arrow batches without any
shuffle.

Edge cases: null and empty texts score like texts without a match; without
labelled rows the lexicon is empty and every score is the prior of 0.5 rounded
down by the intercept; whole texts are folded and searched; rows that repeat
are scored independently.
"""

from __future__ import annotations

import math
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedline.llm.common import staged, texts, with_text

# Look-alikes (fixed by the scripts' shapes), then digits and signs used as letters.
LOOKALIKES = dict(zip("аеорсхуіјѕһԁոѵԛԝгкмтвнАЕОРСХУІЈЅНВМТКαορνικτυχβηεωο", "aeopcxyijshdnvqwrkmtbhaeopcxyijshbmtkaopviktuxbnewo"))
SIGNS = dict(zip("013457@$", "oieastas"))
PREFIXES = range(3, 11)  # letters of an entry


def fold_table() -> dict[int, str]:
    table: dict[int, str] = {}
    for c in map(chr, range(128)):
        if not c.isalnum():
            table[ord(c)] = " "
    for a, b in [*LOOKALIKES.items(), *SIGNS.items()]:
        table[ord(a)] = b
    table[ord("l")] = "i"  # l, 1 and i look the same
    for c in "​‌‍­﻿":
        table[ord(c)] = ""
    return table


TABLE = fold_table()
UPPER_TABLE = {**{ord(c): c.lower().replace("l", "i") for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}, **TABLE}


def fold(text: str) -> str:
    """The folded text between blanks. Accented letters stay: they are letters
    of their language, not disguises."""
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text).lower()
    return f" {text.translate(UPPER_TABLE)} "


def entries_of(text: str) -> set[str]:
    """Candidate entries: the beginnings of the words."""
    words = set(fold(text).split())
    return {w[:k] for w in words for k in PREFIXES if len(w) >= k}


def phrases_of(text: str, weights: dict[str, float]) -> set[str]:
    """Candidate exceptions: one to three folded words that hold an entry."""
    words = fold(text).split()
    begins = {w: any(w[:k] in weights for k in PREFIXES) for w in set(words)}
    return {" ".join(words[a:a + n]) for i, w in enumerate(words) if begins[w] for n in (1, 2, 3)
            for a in range(max(0, i - n + 1), i + 1) if a + n <= len(words)}


@dataclass
class Lexicon:
    weights: dict[str, float]
    exceptions: list[str] = field(default_factory=list)
    curve: tuple[float, float, float] = (0.0, 0.0, 0.0)

    def matcher(self) -> "Matcher":
        return Matcher(self)


class Matcher:
    def __init__(self, lexicon: Lexicon):
        self.lexicon = lexicon
        self.automaton = ahocorasick.Automaton()
        for e, w in lexicon.weights.items():
            self.automaton.add_word(" " + e, (len(e), w))
        self.phrases = {" " + " ".join(fold(e).split()) + " " for e in lexicon.exceptions}
        for p in self.phrases:
            self.automaton.add_word(p, (0, len(p)))
        self.empty = not len(self.automaton)
        if not self.empty:
            self.automaton.make_automaton()

    def strength(self, text: str) -> tuple[float, float, int]:
        """(summed weight, weight per 100 words, matches)."""
        folded = fold(text)
        if self.phrases:
            folded = f" {' '.join(folded.split())} "
        found, spans = [], []
        if not self.empty:
            for end, (n, w) in self.automaton.iter(folded):
                if n:
                    found.append((end - n + 1, end, w))
                else:
                    spans.append((end - w + 1, end))
        if spans and found:
            found = [f for f in found if not any(a <= f[0] and f[1] <= b for a, b in spans)]
        total = sum(f[2] for f in found)
        words = len(folded.split()) if found else 1
        return total, 100.0 * total / max(words, 20), len(found)

    def score(self, text: str) -> tuple[float, int]:
        total, dense, n = self.strength(text)
        a, b, c = self.lexicon.curve
        z = a + b * math.log1p(total) + c * math.log1p(dense)
        return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, z)))), n


def crc_fold(doc_id: Column) -> Column:
    """crc32 of the doc_id's text mod 3; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3


def choose_entries(counts: list[tuple[str, int, int]], n_pos: int, n_neg: int, min_docs: int, min_log_odds: float, max_entries: int) -> dict[str, float]:
    """Weights (smoothed log-odds) of the strongest entries; of those that
    begin alike the strongest, at equal counts the longest, stands alone."""
    rated = []
    for e, pos, neg in counts:
        w = math.log((pos + 0.5) / (n_pos + 1)) - math.log((neg + 0.5) / (n_neg + 1))
        if pos >= min_docs and w >= min_log_odds:
            rated.append((w, len(e), e))
    rated.sort(key=lambda r: (-r[0], -r[1], r[2]))
    chosen: dict[str, float] = {}
    closed: set[str] = set()  # all beginnings of chosen entries
    for w, _, e in rated:
        if len(chosen) >= max_entries:
            break
        if e in closed or any(e[:k] in chosen for k in PREFIXES):
            continue
        chosen[e] = w
        closed.update(e[:k] for k in range(1, len(e) + 1))
    return chosen


def choose_exceptions(phrases: list[str]) -> list[str]:
    """The phrases, in order, without those that hold another one."""
    short = {f" {p} " for p in phrases}
    parts = lambda w: {f" {' '.join(w[a:b])} " for a in range(len(w)) for b in range(a + 1, len(w) + 1) if b - a < len(w)}
    return [p for p in phrases if not parts(p.split(" ")) & short]


def fit_curve(x: np.ndarray, y: np.ndarray, ridge: float = 0.05) -> tuple[float, float, float]:
    """Logistic regression by Newton steps, classes weighted alike."""
    if not len(y) or y.min() == y.max():
        return (-1.0, 1.0, 0.0)
    a = np.column_stack([np.ones(len(y)), np.log1p(x)])
    w = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    beta = np.zeros(3)
    penalty = np.diag([1e-6, ridge, ridge]) * len(y) / 1000
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ beta, -30, 30)))
        step = np.linalg.solve((a.T * (w * p * (1 - p))) @ a + penalty, a.T @ (w * (y - p)) - penalty @ beta)
        beta += step
        if np.abs(step).max() < 1e-6:
            break
    return tuple(float(b) for b in beta)


def train(docs: DataFrame, labels: DataFrame, max_rows: int = 20_000, min_docs: int = 5, min_log_odds: float = 3.0, max_entries: int = 4_096,
          exceptions: tuple[str, ...] = (), max_phrase_log_odds: float = -1.0, max_exceptions: int = 4_096) -> Lexicon:
    """Fit on at most ``max_rows`` labelled rows outside the held-out fold.
    ``exceptions`` are phrases besides the learned ones."""
    known = labels.where("toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    known = known.where(crc_fold(F.col("doc_id")) != 1).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    # At most max_rows rows of two numbers, so they are broadcast; the sample is staged once.
    sample = staged(with_text(docs).join(F.broadcast(known), "doc_id").select("text", "toxic"), "toxic-sample")

    def count(batches: Iterator[pa.RecordBatch], only: int) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for t, y in zip(texts(batch), batch.column("toxic").to_pylist()):
                if y == only:
                    seen.update(entries_of(t))
        yield pa.RecordBatch.from_arrays([pa.array(list(seen.keys()), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["entry", "n"])

    def counted(only: int, among: DataFrame | None) -> DataFrame:
        rows = sample.mapInArrow(lambda b: count(b, only), "entry string, n long")
        rows = rows if among is None else rows.join(among.select("entry"), "entry", "left_semi")
        return rows.groupBy("entry").agg(F.sum("n").alias("n"))

    size = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_pos, n_neg = size.get(1, 0), size.get(0, 0)
    # Entries of toxic rows that can reach the weight at all; then their counts elsewhere.
    least = max(min_docs, math.ceil(0.5 * math.exp(min_log_odds) * (n_pos + 1) / (n_neg + 1) - 0.5))
    pos = counted(1, None).where(F.col("n") >= least)
    both = pos.join(counted(0, pos).withColumnRenamed("n", "m"), "entry", "left").select("entry", "n", F.coalesce("m", F.lit(0)).alias("m"))
    odds = F.log((F.col("n") + 0.5) / (n_pos + 1)) - F.log((F.col("m") + 0.5) / (n_neg + 1))
    best = both.where(odds >= min_log_odds).orderBy(odds.desc(), F.length("entry").desc(), "entry").limit(16 * max_entries)
    lexicon = Lexicon(choose_entries([tuple(r) for r in best.collect()], n_pos, n_neg, min_docs, min_log_odds, max_entries), list(exceptions))

    def count_phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: tuple[Counter, Counter] = (Counter(), Counter())
        for batch in batches:
            for t, y in zip(texts(batch), batch.column("toxic").to_pylist()):
                seen[y == 1].update(phrases_of(t, lexicon.weights))
        keys = list(seen[0].keys() | seen[1].keys())
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array([seen[0][k] for k in keys], pa.int64()),
                                          pa.array([seen[1][k] for k in keys], pa.int64())], names=["phrase", "m", "n"])

    if lexicon.weights:
        phrases = sample.mapInArrow(count_phrases, "phrase string, m long, n long").groupBy("phrase").agg(F.sum("m").alias("m"), F.sum("n").alias("n"))
        harmless = phrases.where((F.col("m") >= min_docs) & (odds <= max_phrase_log_odds))
        # Short ones first: they stand for all that hold them.
        harmless = harmless.orderBy(F.size(F.split("phrase", " ")), F.col("m").desc(), "phrase").limit(max_exceptions)
        lexicon.exceptions += choose_exceptions([r["phrase"] for r in harmless.select("phrase").collect()])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = lexicon.matcher()
        for batch in batches:
            got = [m.strength(t) for t in texts(batch)]
            yield pa.RecordBatch.from_arrays([pa.array([g[0] for g in got], pa.float64()), pa.array([g[1] for g in got], pa.float64()),
                                              batch.column("toxic").cast(pa.int32())], names=["total", "dense", "toxic"])

    rows = sample.mapInArrow(measure, "total double, dense double, toxic int").toPandas()  # at most max_rows rows of numbers
    lexicon.curve = fit_curve(rows[["total", "dense"]].to_numpy(float), rows["toxic"].to_numpy(int))
    return lexicon


def score(docs: DataFrame, lexicon: Lexicon, threshold: float = 0.7) -> DataFrame:
    """Per input row: doc_id, score (0 to 1), predicted, n_matches."""
    d = with_text(docs)
    kind = d.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = lexicon.matcher()
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                part = batch.slice(i, 512)
                got = [m.score(t) for t in texts(part)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([g[0] for g in got], pa.float64()), pa.array([int(g[0] >= threshold) for g in got], pa.int32()),
                     pa.array([g[1] for g in got], pa.int64())], names=["doc_id", "score", "predicted", "n_matches"])

    return d.mapInArrow(run, f"doc_id {kind}, score double, predicted int, n_matches long")
