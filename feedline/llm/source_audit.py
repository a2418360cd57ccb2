r"""Source divergence audit: how far the sources of a language differ in the
terms they use, counted by chunk factorization.

A chunk is a run of text between ASCII blanks, A-Z lower-cased. Documents are
read in blocks of bounded size; a block keeps every document as counts of
chunk numbers, and its distinct chunks once. The chunks of all blocks are made
distinct across the corpus, each is tokenized once (a chunk without any
separator is its own term and needs no look-up), and the terms are joined back
to the blocks' chunk numbers. From them a block yields, per (lang, source,
term), the distinct documents and the occurrences, which Spark adds up.

Terms found in at least ``min_docs`` documents of a language are kept. With
``p = 1 + (10**9 * (count + 5)) div (N + 5 * V)`` per group and term, two
sources differ by the sum of ``|p - q|`` over the kept terms of their language
(:func:`source_pairs`), and a source stands out by the terms it uses more
than its language does (:func:`source_terms`).

Scale: the texts are read twice (once for the groups, which needs two columns
only), held in slices of a block and never shuffled; what moves are blocks of chunk counts, chunks that
need tokenizing, and partial counts. A frequent chunk or term costs one row a
block. Kept terms are compared in blocks of (lang, terms), a dense matrix of
terms by sources of bounded size each; all sources of one language meet there,
as the result has a row for each two of them.

Edge cases: a null text, lang or source is read as ''; a group without any
term, or a language that keeps none, still has its pairs (with the prior alone,
or 0); every row is a document, also if rows repeat a doc_id; no rows give no
result; very long texts are blocks of their own; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from feedline.llm.common import chunks, small_batches, staged

TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
SEPARATOR = r"[\x00-\x40\x5B-\x60\x7B-\x7F]"
BLOCK_BYTES = 20 << 20
SLICE_BYTES = 4 << 20  # of a block's texts, held at once
SLICE_COUNTS = 1 << 18  # of a block's counts, spread at once
CELLS = 4_000_000  # of a matrix of terms by sources
BLOCK_TERMS = 8192
BROADCAST_TERMS = 500_000  # kept terms, of some ten bytes each

BLOCKS = "block long, langs array<string>, sources array<string>, plain array<string>, mixed array<string>, counts binary"


def pack(*arrays: np.ndarray) -> bytes:
    """Non-negative integer arrays as compressed bytes (four planes of bytes)."""
    sizes = np.array([len(arrays), *map(len, arrays)], "<u4")
    planes = np.concatenate(arrays).astype("<u4").view(np.uint8).reshape(-1, 4).T
    return sizes.tobytes() + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpack(data: bytes) -> list[np.ndarray]:
    n = int(np.frombuffer(data, "<u4", 1)[0])
    sizes = np.frombuffer(data, "<u4", n, 4).astype(np.int64)
    total = int(sizes.sum())
    raw = pa.decompress(data[4 * (n + 1):], decompressed_size=4 * total, codec="zstd", asbytes=True) if total else b""
    flat = np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, -1).T).view("<u4").ravel()
    return np.split(flat, np.cumsum(sizes)[:-1])


def strings(values: pa.Array) -> pa.Array:
    """One list of strings, as a column of one row."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values.cast(pa.string()))


def coded(values: pa.Array) -> tuple[pa.Array, np.ndarray]:
    d = values.dictionary_encode()
    d = d.combine_chunks() if isinstance(d, pa.ChunkedArray) else d
    return d.dictionary, d.indices.to_numpy(zero_copy_only=False).astype(np.int64)


def copied(values: pa.Array) -> pa.Array:
    """A slice on its own: it holds no longer the whole batch, and
    ``ascii_lower`` mixes up the texts of an array with an offset."""
    return pa.concat_arrays([values, values.slice(0, 0)])


class Block:
    """Documents of one block, read in slices: of each only the numbers of its
    chunks, its distinct chunks and its groups are held, not the texts."""

    def __init__(self):
        self.slices, self.size = [], 0

    def add(self, part: pa.RecordBatch) -> None:
        words = pc.ascii_split_whitespace(pc.ascii_lower(copied(part.column("text")).cast(pa.large_string())))
        size = pc.list_value_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
        distinct, code = coded(words.flatten())
        self.slices.append((size, distinct, code.astype(np.int32), copied(part.column("lang")), copied(part.column("source"))))

    def factor(self, block: int) -> pa.RecordBatch:
        """The block's groups, its distinct chunks, and per document the counts
        of its chunks."""
        distinct, code = coded(pa.concat_arrays([s[1] for s in self.slices]))
        own = np.split(code, np.cumsum([len(s[1]) for s in self.slices])[:-1])
        # Chunks without a separator first; the empty string at an edge is no chunk.
        empty = pc.equal(distinct, "").to_numpy(zero_copy_only=False)
        mixed = pc.match_substring_regex(distinct, SEPARATOR).to_numpy(zero_copy_only=False)
        place = np.full(len(distinct), -1, np.int64)
        first, second = np.flatnonzero(~mixed & ~empty), np.flatnonzero(mixed)
        place[first], place[second] = np.arange(len(first)), len(first) + np.arange(len(second))
        lengths, steps, numbers = [], [], []
        for (size, _, code, *_), number in zip(self.slices, own):
            code = place[number][code]
            key = (np.repeat(np.arange(len(size)), size) * (len(distinct) + 1) + code)[code >= 0]
            key, n = np.unique(key, return_counts=True)
            doc, code = np.divmod(key, len(distinct) + 1)
            per_doc = np.bincount(doc, minlength=len(size))
            begins = np.concatenate([[0], np.cumsum(per_doc)])[:-1]
            step = np.diff(code, prepend=0)
            step[begins[per_doc > 0]] = code[begins[per_doc > 0]]
            lengths.append(per_doc), steps.append(step.astype("<u4")), numbers.append(n.astype("<u4"))
        n = np.concatenate(numbers)
        often = np.flatnonzero(n > 1)  # most chunks occur once in a document
        lang_names, lang_code = coded(pa.concat_arrays([s[3] for s in self.slices]))
        source_names, source_code = coded(pa.concat_arrays([s[4] for s in self.slices]))
        groups, group = np.unique(lang_code * len(source_names) + source_code, return_inverse=True)
        counts = pack(np.concatenate(lengths), np.concatenate(steps), np.diff(often, prepend=0), n[often] - 1, group)
        return pa.RecordBatch.from_arrays(
            [pa.array([block], pa.int64()), strings(lang_names.take(pa.array(groups // len(source_names)))), strings(source_names.take(pa.array(groups % len(source_names)))),
             strings(distinct.take(pa.array(first))), strings(distinct.take(pa.array(second))), pa.array([counts], pa.binary())],
            names=["block", "langs", "sources", "plain", "mixed", "counts"])


def blocks_of(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """Documents in blocks of about ``limit`` bytes of text."""
    number, held = TaskContext.get().partitionId() << 32, Block()
    for batch in batches:
        lengths = pc.binary_length(batch.column("text").cast(pa.large_binary())).to_numpy(zero_copy_only=False)
        for lo, hi in chunks(range(batch.num_rows), lengths, min(limit, SLICE_BYTES)):
            held.add(batch.slice(lo, hi - lo))
            held.size += int(lengths[lo:hi].sum())
            if held.size >= limit:
                yield held.factor(number)
                number, held = number + 1, Block()
    if held.slices:
        yield held.factor(number)


def count_terms(found: pa.Table, block: pa.Table, slice_counts: int = SLICE_COUNTS) -> pa.Table:
    """Partial counts of one block: per (lang, source, term) the documents and
    the occurrences; ``found`` holds the terms of the chunks with separators."""
    per_doc, step, often, more, group = unpack(block.column("counts")[0].as_py())
    per_doc, group = per_doc.astype(np.int64), group.astype(np.int64)
    n = np.ones(len(step), np.uint32)
    n[np.cumsum(often, dtype=np.int64)] += more
    # The first step of a document is a chunk number, the others are distances;
    # sums beyond 32 bits wrap, their differences do not.
    begins = np.concatenate([[0], np.cumsum(per_doc)])[:-1]
    total = np.concatenate([np.zeros(1, np.uint32), np.cumsum(step, dtype=np.uint32)])
    code = total[1:] - np.repeat(total[begins], per_doc)
    plain = block.column("plain").combine_chunks().flatten()
    found = found.sort_by("pos")
    lists = found.column("terms").combine_chunks()
    sizes = np.concatenate([np.ones(len(plain), np.int64), pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)])
    terms, term = coded(pa.concat_arrays([plain.cast(pa.string()), lists.flatten().cast(pa.string())]))
    rank = pc.sort_indices(terms)  # neighbours alike, for the shuffle's compression
    place = np.empty(len(terms), np.int64)
    place[rank.to_numpy()] = np.arange(len(terms))
    terms, term = terms.take(rank), place[term]
    first = np.concatenate([[0], np.cumsum(sizes)])
    width = max(1, len(terms))
    # Documents in slices, those of a group together, to bound the arrays.
    order = np.argsort(group, kind="stable")
    parts = []
    for lo, hi in chunks(range(len(order)), per_doc[order].tolist(), slice_counts):
        docs = order[lo:hi]
        m = per_doc[docs]
        at = np.repeat(begins[docs] - (np.cumsum(m) - m), m) + np.arange(m.sum())
        c = code[at]
        each = sizes[c]
        doc, times = np.repeat(np.repeat(np.arange(len(docs)), m), each), np.repeat(n[at], each)
        which = term[np.repeat(first[c] - (np.cumsum(each) - each), each) + np.arange(each.sum())]
        own = group[docs]
        key, at = np.unique(own[doc] * width + which, return_inverse=True)
        in_docs = np.unique(doc * width + which)
        seen = np.searchsorted(key, own[in_docs // width] * width + in_docs % width)
        parts.append((key, np.bincount(seen, minlength=len(key)), np.bincount(at, weights=times, minlength=len(key))))
    key, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    added = lambda i: np.bincount(at, weights=np.concatenate([p[i] for p in parts]), minlength=len(key)).astype(np.int64)
    which = pa.array(key // width)
    return pa.table({
        "lang": block.column("langs").combine_chunks().flatten().take(which), "source": block.column("sources").combine_chunks().flatten().take(which),
        "term": terms.take(pa.array(key % width)), "docs": pa.array(added(1), pa.int64()), "n": pa.array(added(2), pa.int64())})


def groups_of(docs: DataFrame) -> DataFrame:
    blank = lambda c: F.coalesce(docs[c].cast("string"), F.lit(""))
    return docs.select(blank("lang").alias("lang"), blank("source").alias("source"), blank("text").alias("text"))


def term_counts(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``lang, source, term, docs, n``: documents and occurrences of every term
    of every group."""
    blocks = staged(small_batches(groups_of(docs)).mapInArrow(lambda batches: blocks_of(batches, block_bytes), BLOCKS), "blocks")
    words = blocks.select("block", F.posexplode("mixed").alias("pos", "chunk"))
    tokenized = words.select("chunk").distinct().select("chunk", F.regexp_extract_all("chunk", F.lit(TERM), F.lit(0)).alias("terms"))
    back = words.join(tokenized, "chunk").select(F.col("block").alias("home"), "pos", "terms")
    own = blocks.select("block", "langs", "sources", "plain", "counts")
    partial = back.groupBy("home").cogroup(own.groupBy("block")).applyInArrow(
        lambda found, block: count_terms(found, block), "lang string, source string, term string, docs long, n long")
    return partial.groupBy("lang", "source", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n"))


def probability(n: str, total: str, kept: str) -> Column:
    """``1 + (10**9 * (n + 5)) div (total + 5 * kept)`` of named columns, exact
    beyond 64 bits."""
    return F.expr(f"1 + (CAST(1000000000 AS DECIMAL(10,0)) * CAST({n} + 5 AS DECIMAL(19,0))) div CAST({total} + 5 * {kept} AS DECIMAL(19,0))")


class Audit:
    """Kept terms of every language and their counts, staged once.

    ``entries``: lang, source, term, n, lang_n (kept terms that occur in the
    group). ``groups``: lang, source, total (N of the group), lang_total, kept
    (V), for every occurring group."""

    def __init__(self, docs: DataFrame, min_docs: int = 30):
        counts = staged(term_counts(docs), "counts")
        kept = counts.groupBy("lang", "term").agg(F.sum("docs").alias("in_docs"), F.sum("n").alias("lang_n"))
        kept = staged(kept.where(F.col("in_docs") >= min_docs).select("lang", "term", "lang_n"), "kept")
        if kept.count() <= BROADCAST_TERMS:  # else the counts are shuffled to them
            kept = F.broadcast(kept)
        self.entries = staged(counts.join(kept, ["lang", "term"]).select("lang", "source", "term", "n", "lang_n"), "terms")
        langs = self.entries.groupBy("lang", "term").agg(F.first("lang_n").alias("lang_n"))
        langs = langs.groupBy("lang").agg(F.sum("lang_n").alias("lang_total"), F.count(F.lit(1)).alias("kept"))
        totals = self.entries.groupBy("lang", "source").agg(F.sum("n").alias("total"))
        every = groups_of(docs).select("lang", "source").distinct()
        self.groups = staged(every.join(totals, ["lang", "source"], "left").join(langs, "lang", "left").fillna(0, ["total", "lang_total", "kept"]), "groups")


def source_terms(audit: Audit, top: int = 50) -> DataFrame:
    """``lang, source, item, value, rank``: the terms a group uses more than
    its language, the ``top`` of them by difference."""
    e = audit.entries.join(audit.groups, ["lang", "source"])
    e = e.withColumn("value", probability("n", "total", "kept") - probability("lang_n", "lang_total", "kept")).where("value > 0")
    order = W.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("term"))
    return e.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select(
        "lang", "source", F.col("term").alias("item"), "value", "rank")


def compare(entries: pa.Table, groups: pa.Table) -> pa.Table:
    """Differences of every two groups of a language over one block of terms."""
    groups = groups.sort_by("source")
    sources = groups.column("source").combine_chunks()
    terms, term = coded(entries.column("term").combine_chunks())
    group = pc.index_in(entries.column("source"), value_set=sources).to_numpy().astype(np.int64)
    p = np.empty((len(terms), len(sources)), np.int64)
    p[:] = groups.column("prior").to_numpy()
    p[term, group] = entries.column("p").to_numpy()
    value = np.stack([np.abs(p - p[:, i:i + 1]).sum(axis=0) for i in range(len(sources))])
    a, b = np.nonzero(~np.eye(len(sources), dtype=bool))
    return pa.table({"lang": pa.array([groups.column("lang")[0].as_py()] * len(a), pa.string()), "source": sources.take(pa.array(a)),
                     "item": sources.take(pa.array(b)), "value": pa.array(value[a, b], pa.int64())})


def source_pairs(audit: Audit) -> DataFrame:
    """``lang, source, item, value, rank``: for every group each other source
    of its language and the sum of their differences over all kept terms."""
    g = audit.groups.join(audit.groups.groupBy("lang").agg(F.count(F.lit(1)).alias("width")), "lang")
    parts = F.ceil(F.col("kept") / F.greatest(F.lit(1), F.least(F.lit(BLOCK_TERMS), F.floor(F.lit(CELLS) / F.col("width")))))
    g = g.withColumn("parts", F.greatest(F.lit(1), parts).cast("long"))
    e = audit.entries.join(g, ["lang", "source"]).select(
        F.col("lang").alias("of_lang"), F.pmod(F.xxhash64("term"), F.col("parts")).alias("of_part"), "source", "term", probability("n", "total", "kept").alias("p"))
    g = g.select("lang", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"), "source",
                 F.when(F.col("kept") > 0, probability("0L", "total", "kept")).otherwise(0).alias("prior"))
    sums = e.groupBy("of_lang", "of_part").cogroup(g.groupBy("lang", "part")).applyInArrow(
        compare, "lang string, source string, item string, value long")
    sums = sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    order = W.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    return sums.withColumn("rank", F.row_number().over(order))


def source_divergence(docs: DataFrame, min_docs: int = 30, top: int = 50) -> DataFrame:
    """Both reports: ``lang, source, part, item, value, rank``."""
    audit = Audit(docs, min_docs)
    named = lambda df, part: df.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")
    return named(source_pairs(audit), "pair").unionByName(named(source_terms(audit, top), "term"))
