r"""Benchmark decontamination: prefix-filtered set join.

Every window (10 consecutive words of an item; a shorter item is one window) is
a set of word shingles. Shingles are ordered by rarity in the documents; for
exact containment the necessary prefix of a window is its rarest shingle, so
only that one is joined. Length and positional bounds drop windows that would
leave the document, and the remaining candidates are verified against the
document's own shingles at every position that covers the window.

Native DataFrame functions only. Texts are split once; only positions whose
shingle occurs in some window are kept (a join with the benchmark's distinct
shingles, which Spark broadcasts when its measured size allows) and staged.
All later joins run on those rows, keyed by document and position, so a
passage found in a third of the documents spreads over all partitions.

Edge cases: a null or wordless text has no words and no hits; a null or
wordless item has no window; equal windows of several items count for each
item, equal item rows once; rows repeating a doc_id are judged separately; a
null item_id marks words but is no item.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedline.llm.common import ascii_lower, row_key, staged, text_of, with_text

NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Runs of digits, letters and non-ASCII code points, A-Z lower-cased."""
    return F.array_remove(F.split(ascii_lower(text), NOT_WORD), "")


def benchmark_windows(benchmark: DataFrame, size: int = 10) -> DataFrame:
    """``window`` (words joined by a space), its words, length and item_id;
    distinct."""
    b = benchmark.select(benchmark["item_id"].alias("item_id"), words_of(text_of(benchmark)).alias("w"))
    b = b.where("size(w) > 0").withColumn("len", F.least(F.lit(size), F.size("w")))
    at = F.explode(F.sequence(F.lit(1), F.size("w") - F.col("len") + 1))
    b = b.select("item_id", "len", "w", at.alias("at")).withColumn("ws", F.slice("w", F.col("at"), F.col("len")))
    return b.select("item_id", F.array_join("ws", " ").alias("window"), "ws", "len").distinct()


def shingle(words: Column, at: Column, size: int) -> Column:
    """The ``size`` words from 0-based position ``at``, joined by a space."""
    return F.concat_ws(" ", *[F.get(words, at + i) for i in range(size)])


def document_hits(docs: DataFrame, wanted: DataFrame, sizes: list[int]) -> DataFrame:
    """Document positions that hold a wanted shingle: row key, pos, shingle,
    n_words. Positions without one are dropped before anything is shuffled."""
    d = with_text(docs)
    d = d.select(*row_key(d["doc_id"], d["text"]), words_of(d["text"]).alias("w"))
    out = None
    for size in sizes:
        at = d.where(F.size("w") >= size).select("k1", "k2", F.size("w").alias("n_words"), "w", F.posexplode("w").alias("pos", "_"))
        at = at.where(F.col("pos") + size <= F.col("n_words"))
        at = at.select("k1", "k2", "n_words", "pos", shingle(F.col("w"), F.col("pos"), size).alias("shingle"))
        hits = at.join(wanted.where(F.col("size") == size).select("shingle"), "shingle")
        out = hits if out is None else out.unionByName(hits)
    return out


def find_windows(docs: DataFrame, benchmark: DataFrame, window: int = 10, shingle_words: int = 3) -> tuple[DataFrame, DataFrame]:
    """(occurrences: row key, start, len, window; windows with their items)."""
    windows = staged(benchmark_windows(benchmark, window), "windows")
    texts = windows.select("window", "ws", "len").distinct()
    size = F.least(F.lit(shingle_words), F.col("len"))
    texts = texts.withColumn("size", size)
    parts = texts.select("window", "len", "size", F.col("ws"), F.explode(F.sequence(F.lit(0), F.col("len") - F.col("size"))).alias("at"))
    parts = parts.select("window", "len", "size", "at", F.array_join(F.slice("ws", F.col("at") + 1, F.col("size")), " ").alias("shingle"))
    parts = staged(parts, "window-shingles")
    sizes = sorted(r[0] for r in parts.select("size").distinct().collect())  # at most shingle_words values
    if not sizes:
        empty = windows.limit(0).select(F.lit(0).cast("long").alias("k1"), F.lit(0).cast("long").alias("k2"),
                                        F.lit(0).alias("start"), "len", "window")
        return empty, windows
    # Staged, so that its real size decides how it is joined.
    wanted = staged(parts.select("size", "shingle").distinct(), "wanted")
    hits = staged(document_hits(docs, wanted, sizes).distinct(), "hits")
    # Rarity: occurrences in the documents; the necessary prefix is the rarest shingle.
    seen = hits.groupBy("shingle").agg(F.count(F.lit(1)).alias("seen"))
    rank = F.struct(F.coalesce("seen", F.lit(0)).alias("seen"), F.col("shingle"), F.col("at"))
    prefix = (parts.join(seen, "shingle", "left").groupBy("window", "len", "size").agg(F.min(rank).alias("r"))
              .where("r.seen > 0").select("window", "len", "size", "r.shingle", F.col("r.at").alias("offset")))
    # Staged too: no more rows than windows, so the documents' hits need not be
    # dealt by shingle (a common passage would fill one task) to meet them.
    prefix = staged(prefix, "prefixes")
    cand = hits.join(prefix, "shingle").withColumn("start", F.col("pos") - F.col("offset"))
    cand = cand.where("start >= 0 AND start + len <= n_words").select("k1", "k2", "start", "window", "len")
    # The shingles at 0, size, 2 size, ... and at the end cover every word of the window.
    cover = parts.where("at % size = 0 OR at = len - size").select("window", "at", "shingle")
    need = cover.groupBy("window").agg(F.count(F.lit(1)).alias("need"))
    wanted = cand.join(cover, "window").select("k1", "k2", "start", "window", "len", (F.col("start") + F.col("at")).alias("pos"), "shingle")
    got = wanted.join(hits.select("k1", "k2", "pos", "shingle"), ["k1", "k2", "pos", "shingle"])
    got = got.groupBy("k1", "k2", "start", "window", "len").agg(F.count(F.lit(1)).alias("got")).join(need, "window")
    return got.where("got = need").select("k1", "k2", "start", "len", "window"), windows


def covered(spans: Column) -> Column:
    """Words inside the union of sorted ``struct(start, end)``."""
    zero = F.struct(F.lit(0).alias("to"), F.lit(0).cast("long").alias("n"))
    step = lambda a, s: F.struct(F.greatest(a["to"], s["end"]).alias("to"),
                                 (a["n"] + F.greatest(F.lit(0), s["end"] - F.greatest(a["to"], s["start"]))).cast("long").alias("n"))
    return F.aggregate(spans, zero, step, lambda a: a["n"])


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """Per input row: doc_id, n_words, n_hit (words inside an occurring
    window) and the sorted ``items`` (text of item_id) whose windows occur."""
    found, windows = find_windows(docs, benchmark, window)
    found = staged(found, "occurrences")
    spans = (found.groupBy("k1", "k2").agg(F.sort_array(F.collect_set(F.struct("start", (F.col("start") + F.col("len")).alias("end")))).alias("spans"))
             .select("k1", "k2", covered(F.col("spans")).alias("n_hit")))
    items = (found.select("k1", "k2", "window").distinct().join(windows.where("item_id IS NOT NULL").select("window", "item_id"), "window")
             .select("k1", "k2", F.col("item_id").cast("string").alias("item")).distinct()
             .groupBy("k1", "k2").agg(F.sort_array(F.collect_list("item")).alias("items")))
    d = with_text(docs)
    d = d.select("doc_id", *row_key(d["doc_id"], d["text"]), F.size(words_of(d["text"])).cast("long").alias("n_words"))
    out = d.join(spans.join(items, ["k1", "k2"], "left"), ["k1", "k2"], "left")
    none = F.array().cast("array<string>")
    return out.select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("items", none).alias("items"))


def keep_clean(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """The rows without any benchmark window, all columns unchanged."""
    found, _ = find_windows(docs, benchmark, window)
    dirty = staged(found.select("k1", "k2").distinct(), "contaminated")
    keyed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), *row_key(docs["doc_id"], text_of(docs)))
    return keyed.join(dirty, ["k1", "k2"], "left_anti").select("row.*")
