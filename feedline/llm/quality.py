r"""Quality rules by repetition coverage.

Base rules count words, symbols, repeated lines and words inside repeated
3-word windows. The method adds rolling hashes of several n-gram lengths: the
share of a document's characters inside n-grams that occur more than once (a
character counts once however many n-grams cover it) and inside repeated
lines. A document is rejected when a share passes the limit of its length, or
when symbols or shouted words dominate.

Per-document numpy work in Arrow batches: a polynomial rolling hash over word
hashes, duplicates by sorting, coverage by a difference array; linear (times
log) in the text, no shuffle, no state on the driver.

Edge cases: a null, empty or wordless text has zero counts and fails the base
rule; very long texts are processed whole; rows are independent; extra columns
are never read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from feedline.llm.common import released, small_batches, texts, with_text, word_hashes

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYMBOLS = "#*$%&|<>"
BASE = np.uint64(0x9E3779B97F4A7C15)
# n-gram words -> largest share of characters inside repeated n-grams.
GRAM_LIMITS = {5: 0.55, 6: 0.54, 7: 0.53, 8: 0.52, 9: 0.51, 10: 0.50}
LINE_LIMIT = 0.40  # share of characters in repeated lines
SYMBOL_LIMIT = 0.30  # symbols per word
SHOUT_LIMIT = 0.30  # share of words ending in an exclamation mark


def rolling(words: np.ndarray, n: int) -> np.ndarray:
    """Polynomial hashes of all n-word windows (mod 2^64), finally mixed."""
    if len(words) < n:
        return np.empty(0, np.uint64)
    h = np.zeros(len(words) - n + 1, np.uint64)
    for i in range(n):
        h = h * BASE + words[i:len(words) - n + 1 + i]
    h ^= h >> np.uint64(32)
    return h * np.uint64(0xD6E8FEB86659FD93)


def repeated(h: np.ndarray) -> np.ndarray:
    """Which windows occur more than once."""
    order = np.argsort(h, kind="stable")
    s = h[order]
    same = s[1:] == s[:-1]
    out = np.zeros(len(h), bool)
    out[order[1:]] |= same
    out[order[:-1]] |= same
    return out


def inside(dup: np.ndarray, n: int, words: int) -> np.ndarray:
    """Which words lie inside some marked n-word window."""
    edge = np.zeros(words + 1, np.int64)
    at = np.flatnonzero(dup)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + n, -1)
    return np.cumsum(edge[:-1]) > 0


def repeated_lines(text: str) -> tuple[int, int, int]:
    """Lines with a word that equal an earlier one: how many and their
    characters; and the characters of all lines with a word."""
    seen, dup, dup_chars, chars = set(), 0, 0, 0
    for line in text.split("\n"):
        if WORD.search(line):
            chars += len(line)
            if line in seen:
                dup += 1
                dup_chars += len(line)
            seen.add(line)
    return dup, dup_chars, chars


def features(text: str) -> dict:
    """Base counts and coverage shares of one text."""
    words = WORD.findall(text)
    n = len(words)
    lengths = np.fromiter(map(len, words), np.int64, n)
    hashes = word_hashes(words)
    chars = int(lengths.sum())
    dup_lines, dup_chars, line_chars = repeated_lines(text)
    # Fewer than three words have no 3-word window.
    out = {"n_words": n, "word_chars": chars, "n_symbols": sum(map(text.count, SYMBOLS)), "n_dup_lines": dup_lines,
           "n_repeat_words": int(inside(repeated(rolling(hashes, 3)), 3, n).sum()) if n >= 3 else 0,
           "line_share": dup_chars / line_chars if line_chars else 0.0,
           "shout_share": sum(w.endswith("!") for w in words) / n if n else 0.0}
    more = out["n_repeat_words"] > 0  # a repeated n-gram repeats all shorter ones inside it
    for k in sorted(GRAM_LIMITS):
        share = 0.0
        if more and n > k:
            share = float(lengths[inside(repeated(rolling(hashes, k)), k, n)].sum()) / chars
            more = share > 0
        out[f"gram{k}_share"] = share
    return out


def base_failed(f: dict) -> bool:
    return f["n_words"] < 50 or 100 * f["n_repeat_words"] > 50 * f["n_words"]


def reasons(f: dict) -> list[str]:
    """The method's rules that reject a text."""
    out = [f"gram{k}" for k, limit in GRAM_LIMITS.items() if f[f"gram{k}_share"] > limit]
    if f["line_share"] > LINE_LIMIT:
        out.append("lines")
    if f["n_symbols"] > SYMBOL_LIMIT * f["n_words"]:
        out.append("symbols")
    if f["shout_share"] > SHOUT_LIMIT:
        out.append("shouting")
    return out


COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
SHARES = ["line_share", "shout_share", *[f"gram{k}_share" for k in GRAM_LIMITS]]


def judge(found: list[str]) -> dict[str, list]:
    rows = [features(t) for t in found]
    out = {c: [r[c] for r in rows] for c in COLUMNS + SHARES}
    out["base_failed"] = [base_failed(r) for r in rows]
    why = [reasons(r) for r in rows]
    out["reasons"] = why
    out["kept"] = [not b and not w for b, w in zip(out["base_failed"], why)]
    return out


SCHEMA = (", ".join(f"{c} long" for c in COLUMNS) + ", " + ", ".join(f"{c} double" for c in SHARES)
          + ", base_failed boolean, kept boolean, reasons array<string>")
ARROW = ([(c, pa.int64()) for c in COLUMNS] + [(c, pa.float64()) for c in SHARES]
         + [("base_failed", pa.bool_()), ("kept", pa.bool_()), ("reasons", pa.list_(pa.string()))])


def quality(docs: DataFrame) -> DataFrame:
    """Per input row: doc_id, the base counts, the shares, base_failed, kept
    and the reasons of the method's rules."""
    d = with_text(docs)
    kind = d.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                part = batch.slice(i, 512)
                got = judge(texts(part))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *[pa.array(got[c], t) for c, t in ARROW]],
                                                 names=["doc_id", *[c for c, _ in ARROW]])

    return d.mapInArrow(lambda batches: released(run(batches)), f"doc_id {kind}, {SCHEMA}")


def keep_good(docs: DataFrame) -> DataFrame:
    """Only the rows that pass, all columns unchanged; judged row by row where
    they are, so nothing is joined or shuffled."""
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                part = batch.slice(i, 512)
                kept = judge([t or "" for t in texts(part)])["kept"]
                yield part.filter(pa.array(kept, pa.bool_()))

    return small_batches(docs).mapInArrow(lambda batches: released(run(batches)), schema)
