r"""Personal data: fixed patterns, and candidates judged by boosted trees.

Base spans come from four patterns (e-mail, IP address, payment card, phone).
The method adds spans: generators of high recall propose overlapping spans that
may be personal data in another form (``name (at) host (dot) org``, defanged
addresses, numbers grouped otherwise, two cards in a row, phones without plus).
Gradient-boosted trees, one ensemble a kind, judge a proposal by features of
its format and its context; a threshold per kind, calibrated on held-out
proposals to a stated precision, selects what is added. Of overlapping accepted
proposals the likeliest is kept, none that touches a base span.

Examples, all there are: base spans in their place and rewritten into the other
forms are positive; proposals outside base spans that fail their kind's own
check, and numbers of other meanings (dates, amounts, versions, ids, failing
check digits) put in the place of base spans, are negative. The trees of all
kinds grow together: each level is one job over the staged examples, whose tasks
sum gradients per node, feature and bin; the driver sees these sums only and
picks the splits.

Scale: one scan of the texts stages narrow rows (spans and features of the few
proposals) and one more the examples; no shuffle but of exact quantiles and
counts. A task hands the driver 32 kB a kind, however many examples. Texts without a digit, an ``@``
or a spelled-out *at* are passed over in Arrow.

Edge cases: a null text is empty and has no spans; without any base span of a
kind the method adds none of it; positions are code points; very long texts are
scanned whole in linear time; equal rows get equal results; rows are
independent, so repeated doc_ids do not matter; no rows give no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedline.llm.common import staged, with_text

# Fixed by the contract: kinds in order and their patterns.
KINDS = ("email", "ip", "card", "phone")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
# A match that begins inside a run of digits would fail as the one at its begin did.
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Proposals.
SPELLED = re.compile(r"[A-Za-z0-9._%+-]{1,64}+\s{0,2}(?:@|[(\[{<]\s?(?:at|@)\s?[)\]}>]|\bat\b)\s{0,2}[A-Za-z0-9-]{1,63}"
                     r"(?:\s{0,2}(?:\.|[(\[{<]\s?(?:dot|\.)\s?[)\]}>]|\bdot\b)\s{0,2}[A-Za-z0-9-]{1,63}){1,5}", re.I)
PLACE = re.compile(r"(?:@|[(\[{<]\s?(?:at|@)\s?[)\]}>]|\bat\b)", re.I)
NUMBER = re.compile(r"(?<![0-9])\+?\(?[0-9](?:[\x20()./\[\]-]{0,3}+[0-9])++")
GROUP = re.compile(r"[0-9]+")
MAY_HOLD = r"(?i)[0-9@]|[(\[{<]\s?at\s?[)\]}>]|\sat\s+\S+\s+dot\s"
MAX_GROUPS = 8

# Words that tell the meaning of what stands near, by kind; the last two speak against.
CUES = (("mail", "contact", "write to", "correo", "courriel", "kontakt"), ("ip", "host", "server", "addr", "ping", "from"),
        ("card", "visa", "credit", "tarjeta", "carte", "karte", "pay"), ("phone", "tel", "call", "mobile", "fax", "llama", "ruf", "appel"),
        ("version", "license", "isbn", "page", "chapter", "year", "$", "€", "%"), ("token", "key", "sha", "hash", "id", "order", "no.", "nr"))


def luhn(digits: str) -> bool:
    d = [int(c) for c in reversed(digits)]
    return sum(d[0::2] + [sum(divmod(2 * x, 10)) for x in d[1::2]]) % 10 == 0


def small_part(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or len(part) == 3 and part <= "255"


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the base spans, sorted."""
    out, end = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            end = m.end()
            out.append((start, 0, end))
        at = text.find("@", max(at + 1, end))
    for m in IP.finditer(text):
        if all(map(small_part, m[0].split("."))):
            out.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "") if m.end() - m.start() < 40 else ""
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    for m in PHONE.finditer(text):
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def proposals(text: str) -> list[tuple[int, int, int]]:
    """Overlapping spans that may be personal data, ``(start, kind, end)``."""
    out = set()
    for m in PLACE.finditer(text):
        # The longest local part before the place, then the pattern from there.
        start = len(text[max(0, m.start() - 2):m.start()].rstrip()) + max(0, m.start() - 2)
        first = start
        while first > max(0, start - 64) and text[first - 1] in LOCAL:
            first -= 1
        if first < start and (found := SPELLED.match(text, first)):
            out.add((first, 0, found.end()))
    for run in NUMBER.finditer(text):
        groups = [(g.start(), g.end()) for g in GROUP.finditer(text, run.start(), run.end())]
        for a in range(len(groups)):
            digits = 0
            for b in range(a, min(len(groups), a + MAX_GROUPS)):
                digits += groups[b][1] - groups[b][0]
                if digits > 19:
                    break
                start = groups[a][0] if a else run.start()
                if b - a == 3 and all(small_part(text[x:y]) for x, y in groups[a:b + 1]) and digits <= 12:
                    out.add((groups[a][0], 1, groups[b][1]))
                if 12 <= digits <= 19:
                    out.add((groups[a][0], 2, groups[b][1]))
                if 7 <= digits <= 15:
                    out.add((start, 3, groups[b][1]))
    return sorted(out)


FEATURES = ("length", "digits", "groups", "longest_group", "shortest_group", "even_groups", "plus", "brackets", "hyphens", "dots", "spaces", "letters",
            "distinct_digits", "leading_zero", "check_digit", "small_parts", "known_issuer", "last_label", "whole_run", "word_before", "word_after",
            "mark_before", "mark_after", "digits_near", "line_begin", *(f"cue_{i}" for i in range(len(CUES))))


def features(text: str, start: int, end: int) -> list[float]:
    """Format and context of a span as numbers, in the order of ``FEATURES``."""
    s, before, after = text[start:end], text[max(0, start - 40):start], text[end:end + 24]
    groups = GROUP.findall(s)
    digits = "".join(groups)
    size = [len(g) for g in groups] or [0]
    near = (before + " " + after).lower()
    last, following = before[-1:], after[:1]
    label = re.split(r"[.\s()\[\]{}<>]+", s)[-1]
    return [float(v) for v in (
        len(s), len(digits), len(groups), max(size), min(size), len(set(size)) == 1, s[:1] == "+", "(" in s or "[" in s, s.count("-"), s.count("."), s.count(" "),
        sum(c.isalpha() for c in s), len(set(digits)), digits[:1] == "0", bool(digits) and luhn(digits), sum(map(small_part, groups)), digits[:1] in ("3", "4", "5", "6"),
        len(label) if label.isalpha() else 0, not (last.isdigit() or following.isdigit() or last in ("-", ".") and before[-2:-1].isdigit() or following in ("-", ".") and after[1:2].isdigit()),
        last.isalnum(), following.isalnum(), bool(last.strip()) and not last.isalnum(), bool(following.strip()) and not following.isalnum(),
        sum(c.isdigit() for c in before + after), "\n" in before[-2:] or not before, *(sum(w in near for w in cue) for cue in CUES))]


def pick(seed: int, *options):
    return options[seed % len(options)]


def other_forms(kind: int, s: str, seed: int) -> str:
    """A base span's text as people also write it."""
    groups = GROUP.findall(s)
    if kind == 0:
        user, host = s.rsplit("@", 1)
        at, dot = pick(seed, (" (at) ", " (dot) "), (" [at] ", "."), (" at ", " dot "), (" @ ", "."), ("[at]", "[dot]"))
        return user + at + host.replace(".", dot)
    if kind == 1:
        return pick(seed, "[.]", "(.)", " . ", "[.]").join(groups)
    digits = "".join(groups)
    if kind == 2:
        return pick(seed, "-", " ", ".", "/").join(digits[i:i + 4] for i in range(0, len(digits), 4))
    joint = pick(seed >> 3, " ", "-", ".")
    return pick(seed, "00" + digits[:1] + " ", "(" + digits[1:4] + ") " if len(digits) > 9 else "", "") + joint.join((digits[-10:-7], digits[-7:-4], digits[-4:]))


def other_meanings(kind: int, s: str, seed: int) -> str:
    """Text that looks like a base span and means something else."""
    digits = ("".join(GROUP.findall(s)) + "0123456789012345")[:16]
    a, b, c = digits[:2], digits[2:4], digits[4:6]
    if kind == 0:
        return pick(seed, "look at it. Now", "meet at noon. Then", f"at {a}.{b}", "arrived at home.He")
    if kind == 1:
        return pick(seed, f"{a}.{b}.{c}.{300 + int(digits[6:9])}", f"{a[0]}.{b[0]}.{c[0]}", f"{a}.{b}.20{c}", f"{a}, {b}, {c}, {digits[6:8]}")
    if kind == 2:
        wrong = next(digits[:-1] + d for d in "0918273645" if not luhn(digits[:-1] + d))
        new = pick(seed, wrong, wrong, digits[:13], f"20{a} 20{b} 20{c} 20{digits[6:8]}")
        return wrong if luhn(new.replace(" ", "")) else new
    return pick(seed, f"20{a}-{b[0]}1-{c[0]}2", f"1{a[0]}.0{b[0]}.20{c}", f"{a} {digits[2:5]} {digits[5:8]}", f"20{a}-20{b}", f"3.{digits[:9]}", f"{digits[:11]}", f"0{a[0]}/0{b[0]}/20{c}",
                f"978-{a[0]}-{b}-{digits[4:10]}-{digits[10]}", f"978-{a[0]}-{b}-{digits[4:10]}")


def passes(kind: int, s: str) -> bool:
    """Whether a proposal outside base spans passes its kind's own check, so
    that it may well be what it looks like: no example against it."""
    if kind == 0:
        return any(m[0].lower() != "at" for m in PLACE.finditer(s))
    if kind == 2:
        return luhn("".join(GROUP.findall(s)))
    return s.count(".") >= 3 if kind == 1 else s[:1] == "+"


def training_samples(text: str, base: list, found: list, seed: int) -> list[tuple[int, int, list[float]]]:
    """``(kind, label, features)`` of one text."""
    out = []
    for start, kind, end in base:
        out.append((kind, 1, features(text, start, end)))
        for label, form in ((1, other_forms), (0, other_meanings)):
            new = form(kind, text[start:end], seed + start)
            around = text[max(0, start - 200):start]
            changed = around + new + text[end:end + 200]
            out.append((kind, label, features(changed, len(around), len(around) + len(new))))
    for start, kind, end in found:
        if not passes(kind, text[start:end]) and not any(s < end and start < e and k == kind for s, k, e in base):
            out.append((kind, 0, features(text, start, end)))
    return out


class Trees:
    """Gradient-boosted trees of fixed depth for a yes-no label (log loss),
    grown level by level from sums of gradients (:meth:`sums`, which add up over
    parts of the examples). With examples given, grown from them at once."""

    def __init__(self, x: np.ndarray | None = None, y: np.ndarray | None = None, rounds: int = 40, depth: int = 3, rate: float = 0.25, bins: int = 16, ridge: float = 2.0):
        self.rounds, self.depth, self.rate, self.bins, self.ridge = rounds, depth, rate, bins, ridge
        self.trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if x is not None:
            self.begin(np.quantile(x, self.fractions(), axis=0).T, len(y), float(y.sum()))
            for _ in range(rounds * depth):
                self.grow(self.sums(x, y))

    def fractions(self) -> list[float]:
        return [float(f) for f in np.linspace(0, 1, self.bins + 1)[1:-1]]

    def begin(self, quantiles, n: int, positive: float) -> "Trees":
        """Bin edges of the features (their quantiles at ``fractions``) and the
        margin without trees."""
        self.edges = [np.unique(np.asarray(q, float)) for q in quantiles]
        self.base = float(np.log((positive + 1) / (n - positive + 1)))
        self._new_tree()
        return self

    def _new_tree(self) -> None:
        self.level = 0
        self.feature, self.cut = np.zeros(2**self.depth - 1, np.int64), np.full(2**self.depth - 1, np.inf)

    def sums(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Gradients and Hessians of some examples, added up per node of the
        level to grow, feature and bin."""
        p = 1 / (1 + np.exp(-self.margin(x)))
        grad, hess = y - p, p * (1 - p)
        node, rows, width = np.zeros(len(y), np.int64), np.arange(len(y)), 2**self.level
        for _ in range(self.level):
            node = 2 * node + 1 + (x[rows, self.feature[node]] > self.cut[node])
        out = np.zeros((2, len(self.edges), width, self.bins))
        for j, e in enumerate(self.edges):
            at = (node - (width - 1)) * self.bins + np.searchsorted(e, x[:, j], side="left")
            for k, v in enumerate((grad, hess)):
                out[k, j] = np.bincount(at, v, width * self.bins).reshape(width, -1)
        return out

    def grow(self, sums: np.ndarray) -> None:
        """The splits of one level from the sums over all examples; the last
        level ends the tree."""
        first, width, nodes = 2**self.level - 1, 2**self.level, np.arange(2**self.level)
        best = np.full(width, 1e-6)
        all_g, all_h = (s[0].sum(axis=1) for s in sums)
        left_g, left_h = all_g.copy(), all_h.copy()  # of a node that is not split
        for j, e in enumerate(self.edges):
            if not len(e):
                continue
            g, h = (np.cumsum(s[j], axis=1)[:, :len(e)] for s in sums)
            rest_g, rest_h = all_g[:, None] - g, all_h[:, None] - h
            gain = g**2 / (h + self.ridge) + rest_g**2 / (rest_h + self.ridge) - (all_g**2 / (all_h + self.ridge))[:, None]
            k = gain.argmax(axis=1)
            better = gain[nodes, k] > best
            best[better] = gain[nodes, k][better]
            left_g[better], left_h[better] = g[nodes, k][better], h[nodes, k][better]
            self.feature[first:first + width][better], self.cut[first:first + width][better] = j, e[k[better]]
        self.level += 1
        if self.level == self.depth:
            leaf_g, leaf_h = (np.column_stack([left, every - left]).ravel() for left, every in ((left_g, all_g), (left_h, all_h)))
            self.trees.append((self.feature, self.cut, self.rate * leaf_g / (leaf_h + self.ridge)))
            self._new_tree()

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, cut, value in self.trees:
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            out += value[node - (2**self.depth - 1)]
        return out


def threshold(margin: np.ndarray, y: np.ndarray, precision: float, n: np.ndarray | None = None) -> float:
    """The least margin at which held-out proposals from there on are right
    with ``precision`` (one wrong one added), halfway to the next lower margin;
    infinite if there is none. With ``n``, an entry stands for that many
    proposals, ``y`` of them right."""
    order = np.argsort(-margin, kind="stable")
    m = margin[order]
    right, n = np.cumsum(y[order]), np.cumsum(np.ones(len(y)) if n is None else n[order])
    ends = np.append(m[1:] != m[:-1], True) if len(y) else np.zeros(0, bool)
    good = np.flatnonzero(ends & (right / (n + 1) >= precision))
    if not len(good):
        return float("inf")
    k = int(good[-1])
    return max(0.0, float(m[k] if k + 1 == len(m) else (m[k] + m[k + 1]) / 2))


SPAN = "struct<start:int,kind:int,end:int>"
SCANNED = f"base array<{SPAN}>, found array<{SPAN}>, features array<array<float>>, samples array<struct<kind:int,label:int,features:array<float>>>"


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, base spans, proposals outside them with their features, and
    training samples."""
    d = with_text(docs)
    kind = d.schema["doc_id"].dataType.simpleString()
    span = pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())])
    sample = pa.struct([("kind", pa.int32()), ("label", pa.int32()), ("features", pa.list_(pa.float32()))])
    as_rows = lambda spans: [{"start": s, "kind": k, "end": e} for s, k, e in spans]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            base, found, feats, samples = ([[] for _ in range(n)] for _ in range(4))
            column = batch.column("text")
            for i in np.flatnonzero(pc.match_substring_regex(column, MAY_HOLD).to_numpy(zero_copy_only=False)):
                text = column[int(i)].as_py()
                spans, proposed = base_spans(text), proposals(text)
                base[i] = as_rows(spans)
                samples[i] = [{"kind": k, "label": y, "features": f} for k, y, f in training_samples(text, spans, proposed, xxhash.xxh32_intdigest(text.encode()))]
                free = outside(proposed, spans)
                found[i], feats[i] = as_rows(free), [features(text, s, e) for s, _, e in free]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(base, pa.list_(span)), pa.array(found, pa.list_(span)), pa.array(feats, pa.list_(pa.list_(pa.float32()))),
                 pa.array(samples, pa.list_(sample))], names=["doc_id", "base", "found", "features", "samples"])

    return d.mapInArrow(run, f"doc_id {kind}, {SCANNED}")


def outside(spans: list, taken: list) -> list:
    """The spans that touch none of the taken ones; both sorted by start."""
    ends = np.maximum.accumulate([e for _, _, e in taken]) if taken else np.zeros(0)
    starts = [s for s, _, _ in taken]
    out = []
    for s, k, e in spans:
        before = int(np.searchsorted(starts, e))  # those that begin before this one ends
        if not before or ends[before - 1] <= s:
            out.append((s, k, e))
    return out


def _arrays(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """kind, label and features of a batch of examples."""
    kind, label = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("kind", "label"))
    return kind, label.astype(float), batch.column("features").flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES)).astype(float)


def _all_sums(examples: DataFrame, growing: dict[int, Trees]) -> dict[int, np.ndarray]:
    """:meth:`Trees.sums` of every kind over all examples; a task adds up its own."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            kind, y, x = _arrays(batch)
            for k, trees in growing.items():
                own = kind == k
                if own.any():
                    total[k] = total.get(k, 0) + trees.sums(x[own], y[own])
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([t.ravel() for t in total.values()], pa.list_(pa.float64()))], names=["kind", "sums"])

    out = {k: np.zeros((2, len(FEATURES), 2**t.level, t.bins)) for k, t in growing.items()}
    for r in examples.mapInArrow(run, "kind int, sums array<double>").collect():  # 32 kB a task and kind at most
        out[r["kind"]] += np.array(r["sums"]).reshape(out[r["kind"]].shape)
    return out


def train(scanned: DataFrame, precision: float = 0.97) -> dict[int, tuple[Trees, float]]:
    """Trees and threshold per kind, from all examples: four fifths of them (by
    hash) fit the trees, the rest calibrates the threshold."""
    rows = scanned.select(F.explode("samples").alias("s")).select("s.*")
    held = F.pmod(F.xxhash64("kind", "label", "features"), F.lit(5)) == 0
    rows = staged(rows.withColumn("held", held).hint("rebalance"), "pii-examples")
    fit, rest = rows.where("NOT held").drop("held"), rows.where("held").drop("held")
    trees = Trees()
    fractions = F.array(*[F.lit(f) for f in trees.fractions()])
    quantiles = F.array(*[F.percentile(F.get("features", F.lit(j)), fractions) for j in range(len(FEATURES))])
    found = fit.groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("positive"), quantiles.alias("quantiles")).collect()  # a row per kind
    growing = {r["kind"]: Trees().begin(r["quantiles"], r["n"], r["positive"]) for r in found if r["n"] >= 16 and 0 < r["positive"] < r["n"]}
    if not growing:
        return {}
    for _ in range(trees.rounds * trees.depth):
        for kind, sums in _all_sums(fit, growing).items():
            growing[kind].grow(sums)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kind, y, x = _arrays(batch)
            margin = np.full(len(y), np.nan)
            for k, t in growing.items():
                margin[kind == k] = t.margin(x[kind == k])
            yield pa.RecordBatch.from_arrays([pa.array(kind, pa.int32()), pa.array(y.astype(np.int32)), pa.array(np.round(margin, 3))], names=["kind", "label", "margin"])

    # Margins to three places: at most some ten thousand rows a kind, with the counts of all.
    judged = rest.where(F.col("kind").isin(list(growing))).mapInArrow(judge, "kind int, label int, margin double")
    judged = judged.groupBy("kind", "margin").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("right")).collect()
    models = {}
    for kind, t in growing.items():
        m, right, n = (np.array([r[c] for r in judged if r["kind"] == kind], float) for c in ("margin", "right", "n"))
        models[kind] = (t, threshold(m, right, precision, n))
    return models


def accepted(spans: list[tuple[int, int, int]], x: np.ndarray, models: dict[int, tuple[Trees, float]]) -> list[tuple[int, int, int]]:
    """The proposals over their kind's threshold; of overlapping ones the one
    that exceeds it most, then the longest and first."""
    scored = []
    for kind, (trees, least) in models.items():
        own = [i for i, s in enumerate(spans) if s[1] == kind]
        if own:
            scored += [(float(m) - least, spans[i]) for m, i in zip(trees.margin(x[own]), own) if m >= least]
    out: list[tuple[int, int, int]] = []
    for _, span in sorted(scored, key=lambda a: (-a[0], a[1][0] - a[1][2], a[1])):
        if outside([span], out):
            out = sorted([*out, span])
    return out


def personal_data(docs: DataFrame, precision: float = 0.97) -> DataFrame:
    """Per input row: doc_id, ``base`` and ``spans`` (base and added ones), as
    arrays of (start, kind, end) sorted by start, then kind."""
    rows = staged(scan(docs), "pii")
    models = train(rows, precision)
    kind = rows.schema["doc_id"].dataType.simpleString()
    span = pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base = batch.column("base").to_pylist()
            for i, (found, x) in enumerate(zip(batch.column("found").to_pylist(), batch.column("features").to_pylist())):
                if found:
                    new = accepted([(f["start"], f["kind"], f["end"]) for f in found], np.array(x, float), models)
                    base[i] = sorted(base[i] + [{"start": s, "kind": k, "end": e} for s, k, e in new], key=lambda f: (f["start"], f["kind"], f["end"]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("base"), pa.array(base, pa.list_(span))], names=["doc_id", "base", "spans"])

    narrow = rows.select("doc_id", "base", "found", "features")
    return narrow.mapInArrow(judge, f"doc_id {kind}, base array<{SPAN}>, spans array<{SPAN}>")


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def kind_count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("long")


def redacted(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in brackets (spans that
    overlap an earlier one are covered by its replacement up to their end)."""
    kinds = F.array(*[F.lit(f"[{k}]") for k in KINDS])
    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(a, s):
        gap = F.substring(text, a["at"] + 1, F.greatest(s["start"] - a["at"], F.lit(0)))
        mark = F.when(s["start"] >= a["at"], F.get(kinds, s["kind"])).otherwise("")
        return F.struct(F.greatest(a["at"], s["end"]).alias("at"), F.concat(a["out"], gap, mark).alias("out"))

    return F.aggregate(spans, zero, step, lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.length(text))))
