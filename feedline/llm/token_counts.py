r"""Token counts: prefix dynamic programming stores the exact token count of
every prefix of a text.

For byte-pair encoding, the encoding of a prefix ends in exactly one token t
such that the rest is the encoding of the shorter prefix and t can follow its
last token (the pair encodes to itself). So ``count(i) = count(i - |t|) + 1``,
filled in from left to right over the bytes of a piece of pre-tokenised text.
Texts are cut at single spaces between other characters, where pre-tokenising
cannot look across. The pieces of a batch are numbered by Arrow; the table of
each distinct piece is computed once per worker (bounded store) and kept in one
flat array, so totals, budgets and whole tables are gathered by piece number.
The table of a text answers truncation and budget questions
(:func:`count_at`, :func:`longest_prefix`) without encoding again.

Per-document work in Arrow batches, no shuffle; nothing is kept on the driver.

Edge cases: a null or empty text has the table of the empty prefix only and
0 tokens; special strings are one token when complete and ordinary text before
(the library's default); very long texts without any space work, in time
linear in their length; rows are independent, so repeats get equal results.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from feedline.llm.common import chunks, with_text

# Fixed by the tokenizer family: the pattern that splits text before merges.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CACHE = 500_000  # distinct pieces kept per worker
PART_BYTES = 1 << 23  # texts handled at once


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def by_char(data: bytes, count: list[int], chars: int) -> list[int]:
    """Counts per byte as counts per code point."""
    return count if len(data) == chars else [count[i] for i in range(len(data) + 1) if i == len(data) or data[i] & 0xC0 != 0x80]


class PrefixCounter:
    """Exact token counts of all prefixes (in code points) of a text."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, to_byte = spec["model"], byte_alphabet()
        raw = lambda s: bytes(to_byte[c] for c in s)
        specials = [t["content"] for t in spec.get("added_tokens", [])]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        # Own ids in order of rank: single bytes, then one per merge.
        self.vocab = {bytes([i]): i for i in range(256)}
        self.joined: dict[tuple[int, int], int] = {}
        self.parts = [(i, i) for i in range(256)]
        for x, y in pairs:
            x, y = raw(x), raw(y)
            self.joined[self.vocab[x], self.vocab[y]] = self.vocab[x + y] = len(self.parts)
            self.parts.append((self.vocab[x], self.vocab[y]))
        # Longest token by its last three bytes: bounds the search to the left.
        self.reach: dict[bytes, int] = {}
        for t in self.vocab:
            self.reach[t[-3:]] = max(len(t), self.reach.get(t[-3:], 0))
        self.split = regex.compile(PATTERN).findall
        self.cut = re.compile(r"(?<=\S) (?=\S)").split
        self.blank = regex.compile(r"\s+").fullmatch
        self.blanks = re.compile(r" \s|\s ").search
        self.specials = regex.compile("|".join(map(regex.escape, sorted(specials, key=len, reverse=True)))) if specials else None
        self.follows: dict[int, bool] = {}
        self.words: dict[str, bytes] = {}

    def stay_apart(self, a: int, b: int) -> bool:
        """Whether the tokens a, b next to each other are the encoding of their
        bytes. Undoing merges from the latest on, walk down the right edge of a
        and the left edge of b; they do not stay apart if parts that face each
        other could have been merged before the step that used one of them up."""
        used = len(self.parts) + 1
        while True:
            if self.joined.get((a, b), used) < used:
                return False
            if a > b:
                used, a = a, self.parts[a][1]
                if a != used:
                    continue
                used, b = b + 1, self.parts[b][0]
                if b + 1 == used:
                    return True
            else:
                used, b = b + 1, self.parts[b][0]
                if b + 1 != used:
                    continue
                used, a = a, self.parts[a][1]
                if a == used:
                    return True

    def can_follow(self, a: int, b: int) -> bool:
        if len(self.follows) > 2 * CACHE:
            self.follows.clear()
        known = self.follows[a << 20 | b] = self.stay_apart(a, b)
        return known

    def fill(self, data: bytes, last: list[int], count: list[int]) -> None:
        """Carry the last token and the token count of the prefixes of ``data``
        on to its end; the lists hold those of some shorter prefix's prefixes."""
        vocab, follows, reach = self.vocab, self.follows, self.reach
        for end in range(len(count), len(data) + 1):
            begin = end - (reach.get(data[end - 3:end], 2) if end > 2 else end)
            for begin in range(begin if begin > 0 else 0, end):
                if (token := vocab.get(data[begin:end])) is not None:
                    if begin and not (ok := follows.get(last[begin] << 20 | token)) and (ok is not None or not self.can_follow(last[begin], token)):
                        continue
                    last.append(token)
                    count.append(count[begin] + 1)
                    break

    def dynamic(self, piece: str) -> list[int]:
        """Token counts of the prefixes of one pre-tokenised piece, by code point, the empty one first."""
        data = piece.encode("utf-8", "surrogatepass")
        last, count = [-1], [0]
        self.fill(data, last, count)
        return by_char(data, count, len(piece))

    def learn(self, words: list[str]) -> None:
        """Compute the pieces of many words at once, in order, so that the
        common prefixes of neighbours are computed only once."""
        pieces = set()
        for w in words:
            pieces.update((w,) if w.isalpha() or w[0] == " " and w[1:].isalpha() else self.split(w))
        last, count, before = [-1], [0], b""
        for piece in sorted(p for p in pieces if len(p) <= 64 and p not in self.words):
            data = piece.encode("utf-8", "surrogatepass")
            same = 0
            for x, y in zip(data, before):
                if x != y:
                    break
                same += 1
            del last[same + 1:], count[same + 1:]
            self.fill(data, last, count)
            counts = by_char(data, count, len(piece))
            self.keep(piece, array("h", map(int.__sub__, counts[1:], counts)).tobytes())
            before = data

    def piece(self, piece: str) -> bytes:
        """The counts of :meth:`dynamic` as int16 steps, cached unless long."""
        if (known := self.words.get(piece)) is not None:
            return known
        counts = self.dynamic(piece)
        steps = array("h", map(int.__sub__, counts[1:], counts)).tobytes()
        return self.keep(piece, steps)

    def keep(self, text: str, steps: bytes) -> bytes:
        if len(text) <= 64:
            if len(self.words) > CACHE:
                self.words.clear()
            self.words[text] = steps
        return steps

    def total(self, piece: str) -> int:
        return sum(array("h", self.piece(piece)))

    def word(self, word: str) -> bytes:
        """Steps of the prefix counts of a text between cuts.

        Where a prefix is split otherwise than the whole text this is put
        right: one that ends inside a contraction (``'r`` of ``'re``), and one
        that ends with a whole run of blanks, of which the complete text gives
        the last one to the next piece."""
        if (known := self.words.get(word)) is not None:
            return known
        pieces = self.split(word)
        if len(pieces) == 1 and word[0] != "'":
            return self.piece(word)
        out = [array("h", self.piece(p)) for p in pieces]
        for k, p in enumerate(pieces):
            if p in ("'re", "'ve", "'ll"):
                a, b = self.total("'"), self.total(p[1])
                out[k] = array("h", [a, b, self.total(p) - a - b])
        flat = array("h", b"".join(out))
        at, blank = 0, self.blank
        for k, p in enumerate(pieces):
            if k and blank(p[0]) and blank(pieces[k - 1]):
                more = self.total(pieces[k - 1] + p[0]) - self.total(pieces[k - 1]) - flat[at]
                flat[at] += more
                if at + 1 < len(flat):
                    flat[at + 1] -= more
            at += len(p)
        return self.keep(word, flat.tobytes()) if word[0] != "'" else flat.tobytes()

    def ordinary(self, text: str) -> bytes:
        if not text:
            return b""
        # Cut at single spaces between other characters.
        plain = text[0] != " " and text[-1] != " " and not self.blanks(text)
        first, *rest = text.split(" ") if plain else self.cut(text)
        known, slow = self.words.get, self.word
        return b"".join([slow(first), *[known(w) or slow(w) for w in map(" ".__add__, rest)]])

    def steps(self, text: str) -> bytes:
        """The prefix table of a text: int16 steps of the count, one per code point."""
        if not self.specials or not (found := list(self.specials.finditer(text))):
            return self.ordinary(text)
        out, at = [], 0
        for m in found:
            # Until it is complete the special string is ordinary text.
            part = text[at:m.end() - 1]
            steps = np.frombuffer(self.ordinary(part), "<i2").astype(np.int64)
            n = m.start() - at
            out.append(steps)
            out.append(np.array([steps[:n].sum() + 1 - steps.sum()]))
            at = m.end()
        out.append(np.frombuffer(self.ordinary(text[at:]), "<i2").astype(np.int64))
        return np.concatenate(out).astype("<i2").tobytes()


def table_of(steps: bytes) -> np.ndarray:
    """Token count of every prefix, the empty one first."""
    return np.concatenate([[0], np.cumsum(np.frombuffer(steps, "<i2"), dtype=np.int64)])


def count_at(steps: bytes, chars: int) -> int:
    """Tokens of the first ``chars`` code points."""
    return int(table_of(steps)[chars])


def longest_prefix(steps: bytes, budget: int) -> int:
    """Code points of the longest prefix of at most ``budget`` tokens."""
    return int(np.flatnonzero(table_of(steps) <= budget)[-1])


_COUNTERS: dict[str, PrefixCounter] = {}


def counter(path: str) -> PrefixCounter:
    """One per worker process and tokenizer file."""
    if path not in _COUNTERS:
        _COUNTERS[path] = PrefixCounter(path)
    return _COUNTERS[path]


class PieceTables:
    """The prefix tables of the distinct pieces met so far by a worker: one
    flat array of steps, and per piece where its steps begin, how many there
    are, their sum and the least count of any of its prefixes."""

    def __init__(self, counter: PrefixCounter):
        self.counter = counter
        self.clear()

    def clear(self) -> None:
        self.number: dict[bytes, int] = {}
        self.flat = array("h")
        self.begin, self.total, self.least = array("q", [0]), array("q"), array("q")

    def numbers(self, pieces: list[bytes]) -> np.ndarray:
        """A number per piece; unknown ones are computed."""
        if len(self.number) > CACHE or len(self.flat) > 40 * CACHE:
            self.clear()
        known = self.number
        new = [p for p in pieces if p not in known]
        words = [p.decode("utf-8", "surrogatepass") for p in new]
        self.counter.learn(words)
        for p, word in zip(new, words):
            steps = array("h", self.counter.word(word))
            known[p] = len(self.total)
            self.flat.extend(steps)
            self.begin.append(len(self.flat))
            self.total.append(sum(steps))
            self.least.append(min(accumulate(steps)))
        return np.fromiter(map(known.__getitem__, pieces), np.int64, len(pieces))

    def arrays(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        view = lambda a, t: np.frombuffer(a, t) if len(a) else np.zeros(0, t)
        return view(self.flat, "i2"), view(self.begin, "i8"), view(self.total, "i8"), view(self.least, "i8")


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an Arrow column of texts and the offsets of the texts."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    raw = np.frombuffer(data, np.uint8)[at[0]:at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, at - at[0]


# Byte classes: ASCII letters 1, ASCII punctuation without the apostrophe (it
# may begin a contraction) 2, all else 0.
CLASS = np.zeros(256, np.uint8)
CLASS[[b for b in range(128) if chr(b).isalpha()]] = 1
CLASS[[b for b in range(33, 127) if not chr(b).isalnum() and chr(b) != "'"]] = 2


def cuts(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Byte positions of the pieces of the texts: the begin of every text,
    single spaces between two visible characters, and ASCII punctuation after a
    Latin letter. Where a wider blank might stand beside a space nothing is cut
    (a longer piece is as good)."""
    space = np.flatnonzero(raw == 0x20)
    space = space[(space > 0) & (space < len(raw) - 1)]
    before, after = raw[space - 1], raw[space + 1]
    wide = lambda b: (b == 0xC2) | ((b >= 0xE1) & (b <= 0xE3))
    odd = (before >= 0x80) & (wide(raw[space - 2]) | ((space > 2) & wide(raw[space - 3])))
    space = space[(before > 0x20) & (after > 0x20) & ~odd & ~wide(after)]
    mark = np.flatnonzero(CLASS[raw] == 2)
    mark = mark[mark > 1]
    latin = (raw[mark - 2] == 0xC3) & (raw[mark - 1] >= 0x80) & (raw[mark - 1] != 0x97) & (raw[mark - 1] != 0xB7)
    mark = mark[latin | (CLASS[raw[mark - 1]] == 1)]
    edge = at[np.searchsorted(at, space)]  # a space that begins a text is no cut, nor one that ends it
    ends = at[np.minimum(np.searchsorted(at, space + 1), len(at) - 1)]
    mark = mark[at[np.searchsorted(at, mark)] != mark]
    return np.sort(np.concatenate([at[:-1][at[1:] > at[:-1]], space[(edge != space) & (ends != space + 1)], mark]), kind="stable")


def count_batch(tables: PieceTables, column: pa.Array, budget: int, with_table: bool):
    """Per text ``(n_tokens, fits_chars, table)`` of a batch of texts without
    special strings. Every distinct piece is looked up once; totals and the
    places where the budget runs out follow by adding up pieces."""
    raw, at = bytes_of(column)
    begin = cuts(raw, at)
    n = len(at) - 1
    if not len(begin):
        return np.zeros(n, np.int64), np.zeros(n, np.int64), [b""] * n
    offsets = np.append(begin, len(raw)).astype(np.int64)
    pieces = pa.Array.from_buffers(pa.large_binary(), len(begin), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(raw))]).dictionary_encode()
    numbers = tables.numbers(pieces.dictionary.to_pylist())[pieces.indices.to_numpy(zero_copy_only=False)]
    flat, first, total, least = tables.arrays()
    upto = np.concatenate([[0], np.cumsum(total[numbers])])
    chars = np.concatenate([[0], np.cumsum(first[numbers + 1] - first[numbers])])
    of = np.searchsorted(begin, at)  # the first piece of each text
    n_tokens = upto[of[1:]] - upto[of[:-1]]
    fits = chars[of[1:]] - chars[of[:-1]]
    for i in np.flatnonzero(n_tokens > budget):
        a, b = of[i], of[i + 1]
        # The last piece with a prefix within the budget, and its longest one.
        inside = np.flatnonzero(upto[a:b] - upto[a] + least[numbers[a:b]] <= budget)
        fits[i] = 0
        if len(inside):
            k = a + inside[-1]
            steps = np.cumsum(flat[first[numbers[k]]:first[numbers[k] + 1]], dtype=np.int64)
            fits[i] = chars[k] - chars[a] + 1 + np.flatnonzero(upto[k] - upto[a] + steps <= budget)[-1]
    if not with_table:
        return n_tokens, fits, [None] * n
    size = first[numbers + 1] - first[numbers]
    where = np.repeat(first[numbers] - chars[:-1], size) + np.arange(chars[-1])
    steps = flat[where]
    return n_tokens, fits, [steps[chars[a]:chars[b]].astype("<i2").tobytes() for a, b in zip(of[:-1], of[1:])]


_TABLES: dict[str, PieceTables] = {}


def tables_of(path: str) -> PieceTables:
    """One per worker process and tokenizer file."""
    if path not in _TABLES:
        _TABLES[path] = PieceTables(counter(path))
    return _TABLES[path]


def token_counts(docs: DataFrame, tokenizer: str, budget: int = 1024, table: bool = True) -> DataFrame:
    """Per input row: doc_id, n_bytes, n_tokens (the last entry of the prefix
    table), ``fits_chars`` (code points of the longest prefix within ``budget``
    tokens) and, if ``table``, ``prefix_steps`` (the prefix table itself)."""
    d = with_text(docs)
    kind = d.schema["doc_id"].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = tables_of(tokenizer)
        c = found.counter
        special = c.specials.pattern if c.specials else None
        for batch in batches:
            size = pc.binary_length(batch.column("text").cast(pa.large_binary())).to_numpy(zero_copy_only=False)
            for lo, hi in chunks(range(batch.num_rows), size, PART_BYTES):
                part = batch.slice(lo, hi - lo)
                column = part.column("text")
                held = np.flatnonzero(pc.match_substring_regex(column, special).to_numpy(zero_copy_only=False)) if special else []
                if len(held):
                    rest = np.ones(len(column), bool)
                    rest[held] = False
                    column = pc.if_else(pa.array(rest), column, "")
                n_tokens, fits, steps = count_batch(found, column, budget, table)
                for i in held:
                    known = c.steps(part.column("text")[i].as_py())
                    n_tokens[i], fits[i], steps[i] = table_of(known)[-1], longest_prefix(known, budget), known
                out = {"doc_id": part.column("doc_id"), "n_bytes": pa.array(size[lo:hi], pa.int64()),
                       "n_tokens": pa.array(n_tokens, pa.int64()), "fits_chars": pa.array(fits, pa.int64())}
                if table:
                    out["prefix_steps"] = pa.array(steps, pa.binary())
                yield pa.RecordBatch.from_pydict(out)

    return d.mapInArrow(count, f"doc_id {kind}, n_bytes long, n_tokens long, fits_chars long" + (", prefix_steps binary" if table else ""))
