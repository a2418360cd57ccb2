"""Helpers shared by the operators: table access, ASCII case folding, row keys."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedline.session import prepare, scratch_path, stage

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write once to the shared checkpoint folder and read back: later jobs
    re-read it, so a lost executor costs no recomputation and plans get its
    real size."""
    return stage(df, scratch_path(df.sparkSession, "llm", name))


def text_of(df: DataFrame, column: str = "text") -> Column:
    """The text as a string, a null as the empty text."""
    return F.coalesce(df[column].cast("string"), F.lit(""))


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z, every other code point unchanged (``lower`` would also fold
    accented letters; on pure ASCII it is the same and much faster)."""
    return F.when(F.octet_length(c) == F.length(c), F.lower(c)).otherwise(F.translate(c, UPPER, UPPER.lower()))


def row_key(doc_id: Column, text: Column) -> list[Column]:
    """A 128-bit key of one row, never null: rows that repeat a doc_id with
    another text stay apart, equal rows share it (and get equal results)."""
    return [F.xxhash64(F.lit(1), doc_id, text).alias("k1"), F.xxhash64(F.lit(2), text, doc_id).alias("k2")]


def small_batches(df: DataFrame) -> DataFrame:
    """Arrow batches of at most 2,048 rows and Parquet batches of at most 512
    from here on, so that batches of long texts stay within a worker's and an
    executor's memory."""
    conf = df.sparkSession.conf
    for name, rows, default in (("spark.sql.execution.arrow.maxRecordsPerBatch", 2048, "10000"), ("spark.sql.parquet.columnarReaderBatchSize", 512, "4096")):
        if int(conf.get(name, default)) > rows:
            conf.set(name, str(rows))
    return df


def released(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches; at their end Arrow gives back what it no longer uses, as a
    worker stays for later tasks."""
    yield from batches
    pa.default_memory_pool().release_unused()


def with_text(docs: DataFrame) -> DataFrame:
    """Only what the operators read: doc_id and text (null as ''), so extra
    columns of any name cannot clash."""
    return small_batches(docs).select(docs["doc_id"].alias("doc_id"), text_of(docs).alias("text"))


def texts(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    return batch.column(name).to_pylist()


def chunks(items: list, sizes, limit: int) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of a list whose sizes add up to about ``limit`` (at
    least one item each), to bound memory within a batch."""
    begin = total = 0
    for i, n in enumerate(sizes):
        if total and total + n > limit:
            yield begin, i
            begin, total = i, 0
        total += n
    if begin < len(items):
        yield begin, len(items)


def number_words(batch: pa.RecordBatch, name: str = "text") -> tuple[pa.LargeStringArray, np.ndarray, np.ndarray]:
    """The words of each text (runs without ASCII blanks) as ``(distinct
    words, their numbers in order, offsets of the texts)``; split and numbered
    by Arrow."""
    column = batch.column(name).cast(pa.large_string())
    lists = pc.ascii_split_whitespace(column)
    values = lists.flatten()
    offsets = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))]).astype(np.int64)
    filled = pc.greater(pc.binary_length(values), 0)
    kept = np.concatenate([[0], np.cumsum(filled.to_numpy(zero_copy_only=False))]).astype(np.int64)
    coded = values.filter(filled).dictionary_encode()
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.combine_chunks()
    return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), kept[offsets]


def split_words(batch: pa.RecordBatch, name: str = "text") -> tuple[list[str], np.ndarray, np.ndarray]:
    """:func:`number_words` with each distinct word as one Python string per batch."""
    words, numbers, offsets = number_words(batch, name)
    return words.to_pylist(), numbers, offsets


class WordHashes(dict):
    """Stable 64-bit hashes of words, remembered up to a bound."""

    def __missing__(self, word: str) -> int:
        if len(self) > 65_536:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return h


HASHES = WordHashes()


def word_hashes(words: list[str]) -> np.ndarray:
    return np.fromiter(map(HASHES.__getitem__, words), np.uint64, len(words))
