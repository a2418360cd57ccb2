"""Line de-duplication: explode normalised lines, hash, count distinct
documents per hash, drop lines over the threshold, reassemble by position.

Native DataFrame functions only. Texts are split once into narrow
``(row key, position, line hash)`` rows, staged; counting and the list of
positions to drop work on those. A hot line is counted after a partial
aggregation, so it costs one row per map task. Texts move at most once, in the
join with the drop lists.

Edge cases: a null or empty text is one empty line and is kept; rows repeating
a doc_id count as one document but are all returned; an empty table gives an
empty result; other columns are never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedline.llm.common import ascii_lower, row_key, staged, with_text

BLANK = " \t\n\x0b\x0c\r"
SALTS = 32


def line_key(line: Column) -> Column:
    """The line without blanks at both ends, A-Z lower-cased."""
    return ascii_lower(F.btrim(line, F.lit(BLANK)))


def line_hashes(docs: DataFrame, min_chars: int = 1) -> DataFrame:
    """One row per line with a long enough key: doc_id, row key, 0-based
    position and a 128-bit hash of the key."""
    d = with_text(docs)
    keys = F.transform(F.split("text", "\n", -1), line_key)
    hashed = F.transform(keys, lambda k: F.struct(
        F.xxhash64(F.lit(1), k).alias("h1"), F.xxhash64(F.lit(2), k).alias("h2"), (F.length(k) >= min_chars).alias("ok")))
    return (d.select("doc_id", *row_key(d["doc_id"], d["text"]), F.posexplode(hashed).alias("pos", "h"))
            .where("h.ok").select("doc_id", "k1", "k2", "pos", "h.h1", "h.h2"))


def common_lines(lines: DataFrame, min_docs: int) -> DataFrame:
    """Hashes found in at least ``min_docs`` distinct documents. The struct
    makes a null doc_id count as a document."""
    return (lines.groupBy("h1", "h2").agg(F.count_distinct(F.struct("doc_id")).alias("n"))
            .where(F.col("n") >= min_docs).select("h1", "h2"))


def without(lines: Column, drops: Column) -> Column:
    """``lines`` without the (sorted, 0-based) positions, linear in both: the
    slices between consecutive dropped positions."""
    ends = F.concat(F.array(F.lit(-1)), drops, F.array(F.size(lines)))
    return F.flatten(F.transform(F.sequence(F.lit(1), F.size(ends) - 1), lambda j: F.slice(
        lines, F.get(ends, j - 1) + 2, F.get(ends, j) - F.get(ends, j - 1) - 1)))


def drop_common_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """``doc_id, text`` (what is kept, joined by newline), ``n_lines`` (before
    dropping) and ``n_dropped``; one row per input row."""
    lines = staged(line_hashes(docs, min_chars), "lines")
    # A line of very many documents is dealt to SALTS tasks by its document.
    common = common_lines(lines, min_docs).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    drops = (lines.withColumn("salt", F.pmod("k1", F.lit(SALTS)).cast("int")).join(common, ["h1", "h2", "salt"])
             .groupBy("k1", "k2").agg(F.sort_array(F.collect_set("pos")).alias("drops")))
    d = with_text(docs)
    d = d.select("doc_id", "text", *row_key(d["doc_id"], d["text"]))
    split = F.split("text", "\n", -1)
    kept = F.when(F.col("drops").isNull(), F.col("text")).otherwise(F.array_join(without(split, F.col("drops")), "\n"))
    return d.join(drops, ["k1", "k2"], "left").select(
        "doc_id", kept.alias("text"), F.size(split).cast("long").alias("n_lines"),
        F.coalesce(F.size("drops"), F.lit(0)).cast("long").alias("n_dropped"))
