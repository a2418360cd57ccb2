r"""Ranked lexical search with per-term geometric blocking.

Documents are sparse vectors: per term its contribution to a score, a product
of the term's weight and a damped frequency, all integers. Every task indexes
its documents in shards of bounded size. In a shard, the posting list of a term
is cut into blocks of similar documents: their vectors are projected to a few
seeded random directions, some documents of the list serve as centres, and
every document of the list goes to the nearest one. A block stores the
coordinatewise maximum of its documents' vectors (over the coordinates that
some query asks for together with the term). The maximum bounds the score of
each document in the block, so a block is skipped only if its bound is below the
lowest score that still counts, and the ranking is exact. Whole lists are left
out in the same way: where the largest contributions of some of a query's terms
add up to less than that score, a document must be on the list of another term.

Queries are the given items, all of them against all documents. Their terms are
sent to the tasks in groups of items of at most ``group_terms`` terms.

Scale: one pass over the texts keeps, per document, its length and the counts
of the terms that occur in a query, staged once; statistics are sums over that
table, and the search reads it again. A task holds one shard and, per query,
the best ``top`` documents so far; those few rows per task are all that is
shuffled.

Edge cases: a null or empty text has no terms; an item without terms, or whose
terms occur nowhere, gets no rows; rows that repeat an item_id are one item
with the terms of all of them (null is such an id too); rows that repeat a
doc_id are ranked each by itself, a null doc_id last among equal scores; no
documents give no rows; very long texts count whole; extra columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from feedline.llm.common import ascii_lower, split_words, staged, text_of, with_text

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Separators to blanks and A-Z to lower case, byte by byte (UTF-8 beyond ASCII is kept).
FOLD = bytes(b if b > 127 else ord(chr(b).lower()) if chr(b).isalnum() else 0x20 for b in range(256))
SHARD_DOCS = 2048
CELLS = 8_000_000  # documents by terms of one shard
BLOCK_DOCS = 32
DIRECTIONS = 16
GROUP_TERMS = 500_000


def folded(column: pa.Array) -> pa.Array:
    """Texts with terms in lower case and single blanks for every separator byte."""
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    return pa.Array.from_buffers(pa.large_string(), len(column), [None, offsets, pa.py_buffer((data.to_pybytes() if data else b"").translate(FOLD))],
                                 offset=column.offset)


def count_query_terms(batch: pa.RecordBatch, vocabulary: pa.Array) -> pa.RecordBatch:
    """Per document: its number of terms, and which terms of the vocabulary it
    holds how often."""
    text = pa.record_batch([folded(batch.column("text"))], names=["text"])
    words, code, at = split_words(text)
    known = pc.index_in(pa.array(words, pa.large_string()), value_set=vocabulary).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
    term = known[code] if len(code) else code
    doc = np.repeat(np.arange(len(at) - 1), np.diff(at))
    width = len(vocabulary) + 1
    key, tf = np.unique(doc[term >= 0] * width + term[term >= 0], return_counts=True)
    doc, term = np.divmod(key, width)
    ends = np.searchsorted(doc, np.arange(len(at)))
    cut = lambda x: pa.array([x[a:b].astype("<u4").tobytes() for a, b in zip(ends[:-1], ends[1:])], pa.binary())
    return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.diff(at), pa.int64()), cut(term), cut(tf)], names=["doc_id", "n", "terms", "counts"])


class Shard:
    """The blocked posting lists of some documents.

    ``vectors`` is documents by terms (contributions, 0 where a term is
    absent); ``columns`` numbers the terms of the shard; ``near`` gives for a
    term the terms that stand with it in some query."""

    def __init__(self, vectors: np.ndarray, columns: dict[int, int], near: dict[int, np.ndarray]):
        self.vectors, self.columns, self.near = vectors, columns, near
        directions = np.empty((vectors.shape[1], DIRECTIONS))
        for term, column in columns.items():
            directions[column] = np.random.default_rng(term).standard_normal(DIRECTIONS)
        at = vectors @ directions
        self.at = at / np.maximum(np.linalg.norm(at, axis=1, keepdims=True), 1e-9)
        self.most = vectors.max(axis=0)
        self.lists: dict[int, tuple] = {}

    def posting_list(self, term: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, dict[int, int]]:
        """Documents in the order of their blocks, where blocks begin, and the
        summaries of the blocks with the place of each term in them."""
        if term in self.lists:
            return self.lists[term]
        values = self.vectors[:, self.columns[term]]
        docs = np.flatnonzero(values)
        begins = np.zeros(1, np.int64)
        if len(docs) > BLOCK_DOCS:
            # Centres spread over the list from high contributions to low.
            centres = docs[np.argsort(-values[docs], kind="stable")][::BLOCK_DOCS]
            nearest = np.argmax(self.at[docs] @ self.at[centres].T, axis=1)
            by = np.argsort(nearest, kind="stable")
            docs = docs[by]
            begins = np.flatnonzero(np.diff(nearest[by], prepend=-1))
        near = [t for t in self.near[term].tolist() if t in self.columns]
        held = self.vectors[np.ix_(docs, [self.columns[t] for t in near])]
        summaries = np.maximum.reduceat(held, begins, axis=0)
        self.lists[term] = found = docs, begins, summaries, {t: i for i, t in enumerate(near)}
        return found

    def search(self, terms: list[int], least: int, top: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents that may be among the ``top`` of a query, and their exact
        scores; none that scores at least ``least`` and is among the ``top`` of
        the shard is left out."""
        terms = sorted((t for t in terms if t in self.columns), key=lambda t: -self.most[self.columns[t]])
        own = [self.columns[t] for t in terms]
        rest = np.cumsum([0, *self.most[own][::-1]])[::-1]  # what the terms from here on can add at most
        docs, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        done = np.zeros(len(self.vectors), bool)
        waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for k, term in enumerate(terms):
            if rest[k] < max(least, 1):
                break  # documents on none of the lists so far score less than counts
            listed, begins, summaries, place = self.posting_list(term)
            bounds = summaries[:, [place[t] for t in terms]].sum(axis=1)
            ends = np.append(begins[1:], len(listed))
            order = np.argsort(-bounds, kind="stable")
            while len(order):
                live = order[bounds[order] >= max(least, 1)]
                now, order = live[:4 if len(scores) < top else len(live)], live[4 if len(scores) < top else len(live):]
                if not len(now):
                    break
                new = np.concatenate([listed[begins[b]:ends[b]] for b in now])
                new = new[~done[new]]
                done[new] = True
                found = self.vectors[np.ix_(new, own)].sum(axis=1)
                docs, scores = np.concatenate([docs, new]), np.concatenate([scores, found])
                if len(scores) >= top:
                    least = max(least, int(np.partition(scores, len(scores) - top)[len(scores) - top]))
                    keep = scores >= least
                    docs, scores = docs[keep], scores[keep]
        return docs, scores


class Searcher:
    """One task: the best documents of every query so far, shard by shard."""

    def __init__(self, queries: list[tuple], weights: np.ndarray, n_docs: int, n_terms: int, top: int):
        self.queries, self.weights, self.top = queries, weights, top
        self.n_docs, self.n_terms = n_docs, n_terms
        self.best: list[list[tuple]] = [[] for _ in queries]
        near: dict[int, set] = {}
        for _, terms in queries:
            for t in terms:
                near.setdefault(t, set()).update(terms)
        self.near = {t: np.array(sorted(s)) for t, s in near.items()}

    def add(self, batch: pa.RecordBatch) -> None:
        terms = [np.frombuffer(b, "<u4").astype(np.int64) for b in batch.column("terms").to_pylist()]
        counts = [np.frombuffer(b, "<u4").astype(np.int64) for b in batch.column("counts").to_pylist()]
        ids, size = batch.column("doc_id").to_pylist(), batch.column("n").to_numpy(zero_copy_only=False)
        held = [i for i, t in enumerate(terms) if len(t)]
        pending = [held[a:a + SHARD_DOCS] for a in range(0, len(held), SHARD_DOCS)]
        while pending:
            rows = pending.pop()
            used = np.unique(np.concatenate([terms[i] for i in rows]))
            if len(rows) > 1 and len(rows) * len(used) > CELLS:
                pending += [rows[:len(rows) // 2], rows[len(rows) // 2:]]
                continue
            vectors = np.zeros((len(rows), len(used)), np.int64)
            for k, i in enumerate(rows):
                damp = 8 * (100 - 90 + 90 * int(size[i]) * self.n_docs // self.n_terms)
                impact = 1_000_000_000 * counts[i] // (1000 * counts[i] + damp)
                vectors[k, np.searchsorted(used, terms[i])] = self.weights[terms[i]] * impact
            self.run(Shard(vectors, {t: c for c, t in enumerate(used.tolist())}, self.near), [ids[i] for i in rows])

    def run(self, shard: Shard, ids: list) -> None:
        order = np.empty(len(ids), np.int64)  # ascending ids, null last
        order[sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] if ids[i] is not None else 0))] = np.arange(len(ids))
        for q, (_, terms) in enumerate(self.queries):
            best = self.best[q]
            least = best[-1][0] if len(best) == self.top else 0
            docs, scores = shard.search(terms, least, self.top)
            if len(docs):
                first = np.lexsort((order[docs], -scores))[:self.top]
                best = best + [(int(scores[i]), ids[docs[i]]) for i in first]
                self.best[q] = sorted(best, key=lambda b: (-b[0], b[1] is None, b[1] if b[1] is not None else 0))[:self.top]

    def results(self, doc_type: pa.DataType, item_type: pa.DataType) -> pa.RecordBatch:
        rows = [(q, *b) for q, best in enumerate(self.best) for b in best]
        return pa.RecordBatch.from_arrays([pa.array([self.queries[r[0]][0] for r in rows], item_type), pa.array([r[2] for r in rows], doc_type),
                                           pa.array([r[1] for r in rows], pa.int64())], names=["item_id", "doc_id", "score"])


def item_terms(items: DataFrame) -> DataFrame:
    """``item_id, term``: the distinct terms of every item."""
    terms = F.regexp_extract_all(ascii_lower(F.col("text")), F.lit(TERM), F.lit(0))
    read = items.select(items["item_id"].alias("item_id"), text_of(items).alias("text"))
    return read.select("item_id", F.explode(terms).alias("term")).distinct()


def rank_group(docs: DataFrame, terms: DataFrame, top: int) -> DataFrame:
    """The best documents of every task for the items of one group."""
    from pyspark.sql.pandas.types import to_arrow_type

    listed = terms.groupBy("term").agg(F.collect_list("item_id").alias("items"), F.max(F.col("item_id").isNull()).alias("none"))
    words = sorted((r["term"], [*r["items"], *([None] if r["none"] else [])]) for r in listed.collect())
    vocabulary = pa.array([w for w, _ in words], pa.large_string())
    of_item: dict = {}
    for number, (_, ids) in enumerate(words):
        for i in ids:
            of_item.setdefault(i, []).append(number)
    queries = sorted(of_item.items(), key=lambda q: (q[0] is None, q[0] if q[0] is not None else 0))
    kind, item_kind = docs.schema["doc_id"].dataType, terms.schema["item_id"].dataType
    d = with_text(docs)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield count_query_terms(batch, vocabulary)

    vectors = staged(d.mapInArrow(count, f"doc_id {kind.simpleString()}, n long, terms binary, counts binary"), "vectors")

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            term, df = np.unique(np.frombuffer(b"".join(batch.column("terms").to_pylist()), "<u4"), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(term, pa.int64()), pa.array(df, pa.int64())], names=["term", "df"])

    n_docs, n_terms = vectors.where("n > 0").agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    # One row per term of the group's items.
    df = np.zeros(len(words), np.int64)
    for r in vectors.mapInArrow(frequencies, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        df[r["term"]] = r["df"]
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(k) + 1))) for k in df], np.int64)
    doc_type, item_type = to_arrow_type(kind), to_arrow_type(item_kind)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = Searcher(queries, weights, n_docs, n_terms, top)
        for batch in batches:
            task.add(batch)
        yield task.results(doc_type, item_type)

    return vectors.mapInArrow(search, f"item_id {item_kind.simpleString()}, doc_id {kind.simpleString()}, score long")


def search(docs: DataFrame, items: DataFrame, top: int = 10, group_terms: int = GROUP_TERMS) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``top`` documents of every item
    with a score above 0, equal scores by ascending doc_id."""
    terms = staged(item_terms(items), "item-terms")
    groups = max(1, math.ceil(terms.count() / group_terms))
    group = F.pmod(F.xxhash64("item_id"), F.lit(groups))
    found = None
    for g in range(groups):
        part = staged(rank_group(docs, terms.where(group == g), top), "best")
        found = part if found is None else found.unionByName(part)
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    # Hits of many tasks: first the best of every slice of an item.
    slices = W.partitionBy("item_id", F.pmod(F.hash("doc_id"), F.lit(64))).orderBy(*order)
    found = found.withColumn("nth", F.row_number().over(slices)).where(F.col("nth") <= top)
    ranked = found.withColumn("rank", F.row_number().over(W.partitionBy("item_id").orderBy(*order)))
    return ranked.where(F.col("rank") <= top).select("item_id", "rank", "doc_id", "score")
