r"""Mixing sources to target weights by Sainte-Laguë apportionment.

Sources get weights, weights become target sizes (water-filling under a cap of
``max_epochs`` times each source), and the targets become integer numbers of
equal blocks by highest quotients ``target / (2k - 1)``. One block size holds
for all sources: at most ``block`` words, and at most an eighth of the smallest
target, so a tiny source gets its share too. Each source's blocks are handed on
the same way to groups of shards and to their shards (by size). A shard's
documents lie in seeded order as one cyclic stream of words; from a seeded
block on, exactly its quota of blocks is taken, so documents stay whole but for
those at the ends of the run. Words beyond a full pass start the second pass;
none is taken more than ``max_epochs`` times.

Scale: only numbers are shuffled, one row of them per document, to shards of
about ``shard_words`` words dealt by hash, so a source holding a third of all
rows is spread over many groups (rows without words count as one word there).
One row per source, one per group of shards, and one per shard of a group meet
in a task; a group has at most ``GROUP_SHARDS`` shards.

Edge cases: a null text has size 0 and nothing taken; a null source is a
source of its own, sorted last; rows that repeat a doc_id have places by their
texts and each is taken by itself; no words at all gives targets of 0; reruns
agree because order and start depend on the seed and the rows only.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from feedline.llm.common import staged, text_of

WORD = r"[^\x20\x09-\x0D]+"
GROUP_SHARDS = 4096


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def targets(sizes: DataFrame, weights: Sequence[float], share: float, max_epochs: float) -> DataFrame:
    """One row per source (``source, source_size``) -> ``weight, target``:
    ``min(max_epochs * source_size, level * weight)`` with one level for all,
    such that the targets add up to ``share`` of all sizes."""
    order = W.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    rank = F.row_number().over(order) - 1
    s = sizes.withColumn("weight", F.get(cycle, rank % len(weights)))
    # Sources reach their cap in the order of cap / weight; the level is fixed
    # by those before a row being capped and the others sharing what is left.
    cap = F.col("source_size") * F.lit(float(max_epochs))
    by_cap = W.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before, after = by_cap.rowsBetween(W.unboundedPreceding, -1), by_cap.rowsBetween(0, W.unboundedFollowing)
    s = s.withColumn("cap", cap).withColumn("all", F.sum("source_size").over(W.partitionBy()))
    rest = F.col("all") * F.lit(float(share)) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    s = s.withColumn("level", rest / F.sum("weight").over(after)).withColumn("nth", F.row_number().over(by_cap))
    fits = F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct("nth", "level"))
    s = s.withColumn("at", F.min(fits).over(W.partitionBy())["level"])  # the first that is not capped fixes it
    return s.select("source", "source_size", "weight", F.coalesce(F.least("cap", F.col("at") * F.col("weight")), F.col("cap")).alias("target"))


def apportion(votes: np.ndarray, seats: int, most: np.ndarray) -> np.ndarray:
    """Sainte-Laguë: seats by highest quotients votes / (2k - 1), at most
    ``most`` each; ties to the earlier row. A divisor found by bisection gives
    all but the last few seats; those are dealt by quotient."""
    votes, most = np.asarray(votes, float), np.asarray(most, np.int64)
    seats = int(min(seats, most.sum()))
    got = np.zeros(len(votes), np.int64)
    if seats <= 0 or not (votes > 0).any():
        return got
    # Seats are capped before they become integers: a small divisor gives more than 64 bits hold.
    at = lambda d: np.minimum(most, np.floor(votes / d + 0.5)).astype(np.int64)
    low, high = 1e-12, votes.max() * 4
    for _ in range(200):
        mid = (low * high) ** 0.5
        low, high = (mid, high) if at(mid).sum() > seats else (low, mid)
    got = at(high)
    while (left := seats - int(got.sum())) > 0:
        quotient = np.where((got < most) & (votes > 0), votes / (2 * got + 1), -1.0)
        best = np.argsort(-quotient, kind="stable")[:left]
        best = best[quotient[best] > 0]
        if not len(best):
            break
        # Only equal quotients may share a round; the highest goes first.
        best = best[quotient[best] >= quotient[best[0]] * (1 - 1e-12)]
        got[best] += 1
    return got


def mixed_hash(ids: np.ndarray, seed: int) -> np.ndarray:
    x = ids.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def taken_before(x: np.ndarray, size: int, words: int, start: int) -> np.ndarray:
    """Words taken of the first ``x`` of a shard's stream: ``words // size``
    full passes and ``words % size`` words from ``start`` on (cyclic)."""
    passes, more = divmod(words, size)
    end = start + more
    extra = np.clip(x, start, min(end, size)) - start + (np.minimum(x, end - size) if end > size else 0)
    return passes * x + extra


def shard_spans(size: np.ndarray, order: tuple[np.ndarray, ...], words: int, block: int, seed: int):
    """Per document of one shard: words taken, and where it lies in the stream;
    the full passes, and the partial pass as runs of the stream."""
    by = np.lexsort((size, *order))
    ends = np.cumsum(size[by])
    total = int(ends[-1]) if len(ends) else 0
    offset = np.zeros(len(size), np.int64)
    offset[by] = ends - size[by]
    if not total or not words:
        return np.zeros(len(size), np.int64), offset, 0, []
    start = int(mixed_hash(np.array([total], np.uint64), seed)[0] % np.uint64(-(-total // block))) * block
    taken = taken_before(offset + size, total, words, start) - taken_before(offset, total, words, start)
    passes, more = divmod(words, total)
    end = start + more
    return taken, offset, passes, [(start, min(end, total)), (0, max(0, end - total))]


def sized(docs: DataFrame, nr: Column, seed: int) -> DataFrame:
    """What the mix needs of the rows: numbers and hashes."""
    place = F.xxhash64(F.lit(seed + 1), docs["doc_id"], text_of(docs))
    return docs.select(nr.alias("nr"), docs["doc_id"].alias("doc_id"), docs["source"].cast("string").alias("source"), word_count(text_of(docs)).alias("size"),
                       place.alias("place"))


def placed(d: DataFrame, weights: Sequence[float], share: float, max_epochs: int, block: int, shard_words: int, seed: int) -> DataFrame:
    """The mix over the rows of :func:`sized`."""
    d = staged(d, "sizes")
    per_source = d.groupBy("source").agg(F.sum("size").alias("source_size"), F.sum(F.greatest("size", F.lit(1))).alias("rows_size"))
    sources = staged(targets(per_source, weights, share, max_epochs), "targets")
    smallest = sources.where("target > 0").agg(F.min("target")).first()[0]
    block = max(1, min(block, int((smallest or 1) / 8)))
    shards = F.ceil(F.col("rows_size") / F.lit(shard_words)).cast("long")
    sources = sources.join(per_source.select(F.col("source").alias("of"), "rows_size"), F.col("source").eqNullSafe(F.col("of")))
    sources = sources.select("source", "source_size", "target", F.greatest(shards, F.lit(1)).alias("shards"))
    same = lambda a, b, *on: a["source"].eqNullSafe(b["source"]) if not on else a["source"].eqNullSafe(b["source"]) & (a[on[0]] == b[on[0]])
    d = d.join(sources, same(d, sources)).select("nr", "doc_id", d["source"], "size", "place", "source_size", "target", "shards")
    d = d.withColumn("shard", F.pmod(F.xxhash64(F.lit(seed), "doc_id", "place"), F.col("shards")))
    sizes = staged(d.groupBy("source", "shard").agg(F.sum("size").alias("shard_size")).withColumn("group", F.expr(f"shard div {GROUP_SHARDS}"))
                   .withColumn("most", F.expr(f"shard_size * {max_epochs} div {block}")), "shards")
    groups = sizes.groupBy("source", "group").agg(F.sum("shard_size").alias("group_size"), F.sum("most").alias("most"))
    caps = groups.groupBy("source").agg(F.sum("most").alias("most"))

    def seat_sources(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("source", na_position="last", kind="stable")
        return pdf.assign(quota=apportion(pdf["target"].to_numpy(), round(float(pdf["target"].sum()) / block), pdf["most"].to_numpy()))[["source", "quota"]]

    def seat(by: str, votes: str):
        def run(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values(by)
            got = apportion(pdf[votes].to_numpy(), int(pdf["quota"].iloc[0]), pdf["most"].to_numpy())
            return pdf[["source", by]].assign(quota=got)
        return run

    # One row per source; then one per group of shards; then one per shard of a group.
    quotas = sources.join(caps, same(sources, caps)).select(sources["source"], "target", "most").withColumn("all", F.lit(True))
    quotas = quotas.groupBy("all").applyInPandas(lambda pdf: seat_sources(pdf.drop(columns="all")), "source string, quota long")
    of_group = groups.join(quotas, same(groups, quotas)).select(groups["source"], "group", "group_size", "most", "quota")
    of_group = of_group.groupBy("source").applyInPandas(seat("group", "group_size"), "source string, group long, quota long")
    of_shard = sizes.join(of_group, same(sizes, of_group, "group")).select(sizes["source"], sizes["group"], "shard", "shard_size", "most", "quota")
    seats = staged(of_shard.groupBy("source", "group").applyInPandas(seat("shard", "shard_size"), "source string, shard long, quota long"), "seats")
    d = d.join(seats, same(d, seats, "shard")).select("nr", "doc_id", d["source"], "size", "source_size", "target", d["shard"], "quota", "place")

    def take(pdf: pd.DataFrame) -> pd.DataFrame:
        size, words = pdf["size"].to_numpy(np.int64), int(pdf["quota"].iloc[0]) * block
        order = (pdf["nr"].to_numpy(np.int64), pdf["place"].to_numpy(np.int64))
        taken, offset, passes, runs = shard_spans(size, order, words, block, seed + int(pdf["shard"].iloc[0]))
        cut_from, cut_to = [[] for _ in size], [[] for _ in size]
        for lo, hi in runs:
            f, t = np.clip(lo - offset, 0, size), np.clip(hi - offset, 0, size)
            for i in np.flatnonzero(t > f):
                cut_from[i].append(int(f[i]))
                cut_to[i].append(int(t[i]))
        return pdf[["nr", "doc_id", "size", "source_size", "target"]].assign(
            taken=taken, passes=np.int64(passes), cut_from=cut_from, cut_to=cut_to)

    kind = d.schema["doc_id"].dataType.simpleString()
    return d.groupBy("source", "shard").applyInPandas(take, f"nr long, doc_id {kind}, size long, source_size long, target double, taken long, "
                                                      "passes long, cut_from array<long>, cut_to array<long>")


def mix(docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, max_epochs: int = 2, block: int = 256,
        shard_words: int = 500_000, seed: int = 17) -> DataFrame:
    """Per input row: doc_id, size, source_size, target (of its source), taken,
    and where it lies: ``passes`` full passes plus the words ``[cut_from[i],
    cut_to[i])`` of one further, partial pass."""
    return placed(sized(docs, F.monotonically_increasing_id(), seed), weights, share, max_epochs, block, shard_words, seed).drop("nr")


def mixed_documents(docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, max_epochs: int = 2, block: int = 256,
                    shard_words: int = 500_000, seed: int = 17) -> DataFrame:
    """The mix as rows with the columns of ``docs``: a document once for each
    full pass over it, and once more with the words of the partial pass. Text
    and ``n_chars`` of a cut row are those of its words; the rest is unchanged."""
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), F.monotonically_increasing_id().alias("nr"))
    rows = staged(rows, "numbered")  # the number names a row in both uses
    read = rows.select("nr", "row.doc_id", "row.text", "row.source")
    cuts = placed(sized(read, F.col("nr"), seed), weights, share, max_epochs, block, shard_words, seed)
    cuts = cuts.where("taken > 0").select(F.col("nr").alias("at"), "size", "passes", "cut_from", "cut_to")
    d = rows.join(cuts, rows["nr"] == cuts["at"]).select("row", "size", "passes", "cut_from", "cut_to")
    whole = (F.size("cut_from") == 1) & (F.get("cut_from", F.lit(0)) == 0) & (F.get("cut_to", F.lit(0)) == F.col("size"))
    text = F.col("row.text")
    words, blanks = F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), F.split(text, WORD, -1)
    run = F.zip_with("cut_from", "cut_to", lambda a, b: F.array_join(F.flatten(F.zip_with(
        F.slice(words, (a + 1).cast("int"), (b - a).cast("int")), F.slice(blanks, (a + 2).cast("int"), (b - a).cast("int")), lambda w, g: F.array(w, g))), ""))
    cut = F.when(whole, text).otherwise(F.array_join(F.transform(run, lambda r: F.rtrim(r)), "\n"))
    full = F.transform(F.array_repeat(text, F.col("passes").cast("int")), lambda t: t)
    copies = d.select("row", F.explode(F.when(F.size("cut_from") > 0, F.concat(full, F.array(cut))).otherwise(full)).alias("new"))
    cols = [F.col("new").alias("text") if c == "text" else F.when(F.col("new") == text, F.col(f"row.{c}")).otherwise(F.length("new")).cast(docs.schema[c].dataType).alias(c)
            if c == "n_chars" else F.col(f"row.`{c}`").alias(c) for c in docs.columns]
    return copies.select(*cols)
