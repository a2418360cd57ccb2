r"""Token-id output in patched frame-of-reference blocks.

Ids are written in ascending doc_id order (nulls first, ties by text) as files
of segments, one binary payload each, through Spark's own writer, so any store
that Spark reaches will do and a lost executor only repeats its partition.
A segment holds about ``segment_ids`` ids of whole documents:

    header   "PFR1", format version, ids, documents, blocks (little endian u32)
    lengths  u32 ids of each document
    index    per block: u32 offset of its data, u32 minimum, u8 width, u16 exceptions
    data     per block: (id - minimum) packed at ``width`` bits, then the
             exceptions' u16 positions and u32 full values

A block is 1,024 ids. Its width is the number of bits that holds the chosen
percentile of the offsets; larger ones (outliers) leave zeros in the packed
part and are stored as exceptions. The block index allows reading from any id
without decoding what comes before.

Documents are range-partitioned by doc_id once (texts move once), encoded with
a bounded cache of pieces of words, and packed in numpy. Each segment stores its place
in its file; file totals (one row per file) give the global starts.

Edge cases: a null or empty text is one document of the end id alone; very
long texts make a larger segment; an empty table gives an empty result; rows
that repeat a doc_id are all written, in order of their texts.
"""

from __future__ import annotations

import json
import math
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from feedline.llm.common import number_words, released, scratch_path, with_text
from feedline.llm.token_counts import byte_alphabet

MAGIC = b"PFR1"
BLOCK = 1024
INDEX = np.dtype([("offset", "<u4"), ("low", "<u4"), ("width", "u1"), ("patches", "<u2")])
CACHE = 160_000
# Fixed by the tokenizer file: how it normalises and splits.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
CHAIN = [
    {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    {"type": "Sequence", "pretokenizers": [{"type": "Split", "pattern": {"Regex": SPLIT}, "behavior": "Removed", "invert": True},
                                           {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}]

# What a byte of a word of plain Latin letters is to SPLIT. An apostrophe may
# begin an ending of its own, and 0x97 and 0xB7 end the signs of multiplication
# and division, which are no letters: words with these are not cut by bytes.
LETTER, DIGIT, MARK, OTHER = 1, 2, 4, 8
KIND = np.full(256, OTHER, np.uint8)
KIND[0x21:0x7F] = MARK
KIND[0x30:0x3A] = DIGIT
KIND[0x41:0x5B] = KIND[0x61:0x7B] = KIND[0x80:0xC0] = KIND[0xC3] = LETTER
KIND[[0x27, 0x97, 0xB7]] = OTHER
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20
LOWER[0x80:0x9F] += 0x20  # second bytes of U+00C0 to U+00DE


def pack(values: np.ndarray, width: int) -> bytes:
    """Lowest ``width`` bits of each value, one after the other."""
    if not width:
        return b""
    bits = (values[:, None] >> np.arange(width, dtype=np.uint32)) & 1
    return np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack(data: bytes, width: int, n: int) -> np.ndarray:
    if not width:
        return np.zeros(n, np.uint32)
    bits = np.unpackbits(np.frombuffer(data, np.uint8), count=n * width, bitorder="little").reshape(n, width)
    return (bits.astype(np.uint32) << np.arange(width, dtype=np.uint32)).sum(axis=1, dtype=np.uint32)


def pack_blocks(blocks: np.ndarray, width: int) -> np.ndarray:
    """:func:`pack` of many full blocks of one width: rows of bytes. 64 values
    fill ``width`` 64-bit words."""
    lanes = np.ascontiguousarray(blocks.astype("<u8").reshape(-1, 64).T)
    out = np.zeros((width, lanes.shape[1]), "<u8")
    for i in range(64):
        word, shift = divmod(i * width, 64)
        out[word] |= lanes[i] << np.uint64(shift)
        if shift + width > 64:
            out[word + 1] |= lanes[i] >> np.uint64(64 - shift)
    return np.ascontiguousarray(out.T).reshape(len(blocks), -1).view(np.uint8)


def unpack_blocks(data: np.ndarray, width: int) -> np.ndarray:
    """The values of rows of packed bytes, a full block each."""
    words = np.ascontiguousarray(np.ascontiguousarray(data).view("<u8").reshape(-1, width).T)
    mask = np.uint64((1 << width) - 1)
    out = np.empty((64, words.shape[1]), np.uint32)
    for i in range(64):
        word, shift = divmod(i * width, 64)
        x = words[word] >> np.uint64(shift)
        if shift + width > 64:
            x = x | words[word + 1] << np.uint64(64 - shift)
        out[i] = x & mask
    return np.ascontiguousarray(out.T).reshape(len(data), BLOCK)


def encode_block(ids: np.ndarray, percentile: float) -> tuple[int, int, int, bytes]:
    """(minimum, width, number of exceptions, data)."""
    low = int(ids.min())
    above = (ids - np.uint32(low)).astype(np.uint32)
    width = int(np.percentile(above, percentile, method="higher")).bit_length()
    out = np.flatnonzero(above >> np.uint32(width)) if width < 32 else np.empty(0, np.int64)
    above[out] = 0
    return low, width, len(out), pack(above, width) + out.astype("<u2").tobytes() + ids[out].astype("<u4").tobytes()


def decode_block(data: bytes, low: int, width: int, patches: int, n: int) -> np.ndarray:
    size = (n * width + 7) // 8
    ids = unpack(data[:size], width, n) + np.uint32(low)
    at = np.frombuffer(data, "<u2", patches, size)
    ids[at] = np.frombuffer(data, "<u4", patches, size + 2 * patches)
    return ids


def encode_blocks(blocks: np.ndarray, percentile: float) -> list[tuple[int, int, int, bytes]]:
    """:func:`encode_block` of many full blocks, packed together by width."""
    low = blocks.min(axis=1)
    above = blocks - low[:, None]
    k = math.ceil(percentile / 100 * (BLOCK - 1))
    width = np.frexp(np.partition(above, k, axis=1)[:, k].astype(float))[1]  # bits of the percentile
    outlier = above.astype(np.uint64) >> width[:, None].astype(np.uint64) > 0
    above[outlier] = 0
    n = outlier.sum(axis=1)
    where, what = np.nonzero(outlier)[1].astype("<u2"), blocks[outlier].astype("<u4")
    ends = np.cumsum(n)
    packed: dict[int, bytes] = {}
    for w in np.unique(width):
        at = np.flatnonzero(width == w)
        for i, row in zip(at, pack_blocks(above[at], int(w)) if w else [np.empty(0, np.uint8)] * len(at)):
            packed[int(i)] = row.tobytes()
    return [(int(low[i]), int(width[i]), int(n[i]), packed[i] + where[e - n[i]:e].tobytes() + what[e - n[i]:e].tobytes())
            for i, e in enumerate(ends)]


def encode_segment(ids: np.ndarray, lengths: list[int], percentile: float = 90.0) -> bytes:
    ids = np.asarray(ids, np.uint32)
    full = len(ids) // BLOCK
    blocks = encode_blocks(ids[:full * BLOCK].reshape(full, BLOCK), percentile) if full else []
    if len(ids) % BLOCK:
        blocks.append(encode_block(ids[full * BLOCK:], percentile))
    index, at = [], 0
    for low, width, patches, body in blocks:
        index.append((at, low, width, patches))
        at += len(body)
    head = MAGIC + struct.pack("<4I", 1, len(ids), len(lengths), len(index))
    return head + np.array(lengths, "<u4").tobytes() + np.array(index, INDEX).tobytes() + b"".join(b[3] for b in blocks)


def read_head(payload: bytes) -> tuple[int, np.ndarray, np.ndarray, int]:
    """(number of ids, document lengths, block index, where the data begins)."""
    if payload[:4] != MAGIC:
        raise ValueError("not a segment of token ids")
    version, n, docs, blocks = struct.unpack_from("<4I", payload, 4)
    if version != 1:
        raise ValueError(f"unknown segment version {version}")
    lengths = np.frombuffer(payload, "<u4", docs, 20)
    index = np.frombuffer(payload, INDEX, blocks, 20 + 4 * docs)
    return n, lengths, index, 20 + 4 * docs + INDEX.itemsize * blocks


def read_ids(payload: bytes, begin: int = 0, end: int | None = None) -> np.ndarray:
    """Ids ``begin .. end`` of a segment; only the blocks that hold them are decoded."""
    n, _, index, base = read_head(payload)
    end = n if end is None else min(end, n)
    if begin >= end:
        return np.empty(0, np.uint32)
    first, last = begin // BLOCK, (end - 1) // BLOCK
    ends = np.append(index["offset"][1:].astype(np.int64), len(payload) - base) + base
    starts = index["offset"].astype(np.int64) + base
    out = np.empty((last - first + 1, BLOCK), np.uint32)
    full = np.arange(first, min(last + 1, n // BLOCK))
    raw = np.frombuffer(payload, np.uint8)
    for w in np.unique(index["width"][full]):
        at = full[index["width"][full] == w].astype(np.int64)
        size = BLOCK * int(w) // 8
        values = unpack_blocks(raw[starts[at][:, None] + np.arange(size)], int(w)) if w else np.zeros((len(at), BLOCK), np.uint32)
        out[at - first] = values + index["low"][at][:, None]
    for b in full[index["patches"][full] > 0]:
        k, at = int(index["patches"][b]), int(starts[b]) + BLOCK * int(index["width"][b]) // 8
        out[b - first, np.frombuffer(payload, "<u2", k, at)] = np.frombuffer(payload, "<u4", k, at + 2 * k)
    if last >= n // BLOCK:
        tail = n - last * BLOCK
        out[last - first, :tail] = decode_block(payload[starts[last]:ends[last]], int(index["low"][last]), int(index["width"][last]), int(index["patches"][last]), tail)
    return out.ravel()[begin - first * BLOCK:end - first * BLOCK]


def u4_bytes(ids: list[int]) -> bytes:
    """Few ids as little-endian u32."""
    return struct.pack(f"<{len(ids)}I", *ids)


def cut_words(words: pa.LargeStringArray) -> tuple[pa.LargeStringArray, np.ndarray, np.ndarray]:
    """Words (none empty) of plain Latin letters lower-cased and cut as SPLIT
    cuts them, other words whole, as ``(distinct pieces, their numbers in
    order, offsets of the words)``."""
    if not len(words):
        return words, np.empty(0, np.int64), np.zeros(1, np.int64)
    offsets = np.frombuffer(words.buffers()[1], np.int64)[words.offset:words.offset + len(words) + 1]
    data = np.frombuffer(words.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
    offsets = offsets - offsets[0]
    kind = KIND[data]
    kind[:-1][(data[:-1] == ord("<")) & (data[1:] == ord("|"))] = OTHER  # may be a special token
    other = np.bitwise_or.reduceat(kind, offsets[:-1]) >= OTHER
    lower = LOWER[data]
    if other.any():
        whole = np.repeat(other, np.diff(offsets))
        kind[whole], lower[whole] = OTHER, data[whole]
    edge = kind == DIGIT
    edge[1:] |= kind[1:] != kind[:-1]
    edge[offsets[:-1]] = True
    at = np.flatnonzero(edge)
    pieces = pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(np.append(at, len(data))), pa.py_buffer(lower))
    coded = pieces.dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), np.searchsorted(at, offsets)


def gather(flat: np.ndarray, ends: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs ``numbers`` of those that lie one after the other in ``flat``, and
    where each begins in the result (and its end)."""
    size = np.diff(ends)[numbers]
    at = np.concatenate([[0], np.cumsum(size)])
    return flat[np.repeat(ends[numbers] - at[:-1], size) + np.arange(at[-1])], at


class WordEncoder:
    """Ids of texts. The tokenizer drops white space and never looks across it,
    so texts are cut at ASCII blanks and the ids are gathered by word number.

    Words of plain Latin letters need no normalising but lower case: they are
    lower-cased and cut into the pieces of the tokenizer file's own pattern,
    all distinct words of a batch at once, and each distinct piece is merged by
    the library's model, which is several times faster than its whole chain.
    Other words are encoded by the library. Both are remembered (bounded cache
    of two generations)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        tokenizer = Tokenizer.from_file(path)
        self.encode, self.merge = tokenizer.encode_batch_fast, tokenizer.model.tokenize
        self.known = [spec.get("normalizer"), spec.get("pre_tokenizer")] == CHAIN
        self.plain = re.compile(r"[!-~À-ÿ]+").fullmatch if self.known else lambda w: None
        stand_in = {b: c for c, b in byte_alphabet().items()}
        self.bytes = str.maketrans({chr(b): stand_in[b] for b in range(256)})
        self.split = regex.compile(SPLIT).findall
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def piece(self, piece: str) -> bytes:
        if (ids := self.words.get(piece)) is None:
            letters = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.bytes)
            ids = self.words[piece] = u4_bytes([t.id for t in self.merge(letters)])
        return ids

    def ids_of(self, words: list[str]) -> list[bytes]:
        if len(self.words) > CACHE:
            self.words, self.older = {}, self.words
        found = list(map(self.words.get, words))
        rest = []
        for i, ids in enumerate(found):
            if ids is None:
                w = words[i]
                if (ids := self.older.get(w)) is None:
                    if not self.plain(w) or "<|" in w:
                        rest.append(i)
                        continue
                    ids = self.piece(w.lower()) if w.isalpha() else b"".join(map(self.piece, self.split(w.lower())))
                found[i] = self.words[w] = ids
        for i in range(0, len(rest), 4096):
            part = rest[i:i + 4096]
            for j, e in zip(part, self.encode([words[j] for j in part], add_special_tokens=False)):
                found[j] = self.words[words[j]] = u4_bytes(e.ids)
        return found

    def encode_batch(self, batch: pa.RecordBatch, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a batch of texts, each text followed by ``end_id``, and
        the number of ids of each text."""
        words, numbers, offsets = number_words(batch)
        pieces, order, first = cut_words(words) if self.known else (words, np.arange(len(words)), np.arange(len(words) + 1))
        ids = self.ids_of(pieces.to_numpy(zero_copy_only=False).tolist())
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        flat, ends = gather(np.frombuffer(b"".join(ids), "<u4"), np.concatenate([[0], np.cumsum(size)]), order)
        gathered, ends = gather(flat, ends[first], numbers)
        at = ends[offsets]
        return np.insert(gathered, at[1:], end_id), np.diff(at) + 1


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One per worker process and tokenizer file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = 1, segment_ids: int = 500_000, percentile: float = 90.0) -> None:
    """Encode, append ``end_id`` to each document, and write the segments to
    ``path`` (Parquet rows: file_no, first (ids of the file before it), n_ids,
    doc_ids, payload). Overwrites what is there."""
    # Spark samples the range keys on the driver, so they hold the beginning of
    # a text only; it splits rows that share a doc_id, whole texts order them.
    d = with_text(docs).repartitionByRange(F.col("doc_id").asc_nulls_first(), F.substring("text", 1, 64)).sortWithinPartitions(
        F.col("doc_id").asc_nulls_first(), "text")
    d = d.select(F.spark_partition_id().alias("file_no"), "doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    id_type = d.select("doc_id").schema
    from pyspark.sql.pandas.types import to_arrow_type

    id_arrow = to_arrow_type(id_type[0].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, first = encoder(tokenizer), 0
        ids, lengths, names, held, file_no = [], [], [], 0, 0

        def segment() -> pa.RecordBatch:
            nonlocal ids, lengths, names, held, first
            out = pa.RecordBatch.from_arrays(
                [pa.array([file_no], pa.int32()), pa.array([first], pa.int64()), pa.array([held], pa.int64()),
                 pa.array([names], pa.list_(id_arrow)), pa.array([encode_segment(np.concatenate(ids), lengths, percentile)], pa.binary())],
                names=["file_no", "first", "n_ids", "doc_ids", "payload"])
            first, ids, lengths, names, held = first + held, [], [], [], 0
            return out

        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                part = batch.slice(i, 512)
                file_no = part.column("file_no")[0].as_py()
                flat, sizes = enc.encode_batch(part, end_id)
                ids.append(flat)
                lengths += sizes.tolist()
                names += part.column("doc_id").to_pylist()
                held += len(flat)
                if held >= segment_ids:
                    yield segment()
        if names:
            yield segment()

    out = d.mapInArrow(lambda batches: released(run(batches)), f"file_no int, first long, n_ids long, doc_ids array<{kind}>, payload binary")
    out.write.mode("overwrite").parquet(path)


def read_token_files(spark, path: str) -> DataFrame:
    """From the files, per document: doc_id, start (ids of all documents before
    it), n_tokens, ids_crc32 (of its ids as little-endian u32)."""
    files = spark.read.parquet(path)
    kind = files.schema["doc_ids"].dataType.elementType.simpleString()
    totals = files.groupBy("file_no").agg(F.sum("n_ids").alias("n"))
    before = F.sum("n").over(W.orderBy("file_no").rowsBetween(W.unboundedPreceding, -1))
    totals = totals.select("file_no", F.coalesce(before, F.lit(0)).alias("before"))  # one row per file
    # Broadcast: a row per file, of which there are as many as write tasks.
    placed = files.join(F.broadcast(totals), "file_no").select((F.col("before") + F.col("first")).alias("start"), "doc_ids", "payload")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                payload = batch.column("payload")[i].as_py()
                data = read_ids(payload).astype("<u4").tobytes()
                lengths = read_head(payload)[1].astype(np.int64)
                ends = np.cumsum(lengths)
                crc = [zlib.crc32(data[4 * (e - n):4 * e]) for e, n in zip(ends.tolist(), lengths.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_ids")[i].values, pa.array(ends - lengths + batch.column("start")[i].as_py(), pa.int64()),
                     pa.array(lengths, pa.int64()), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return placed.mapInArrow(lambda batches: released(run(batches)), f"doc_id {kind}, start long, n_tokens long, ids_crc32 long")


def token_files(docs: DataFrame, tokenizer: str, path: str | None = None, **how) -> DataFrame:
    """Write the files (to a fresh shared folder unless given) and read them back."""
    path = path or scratch_path(docs.sparkSession, "llm", "token-files")
    write_token_files(docs, path, tokenizer, **how)
    return read_token_files(docs.sparkSession, path)
