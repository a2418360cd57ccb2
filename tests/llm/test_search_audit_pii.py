"""Personal data, lexical search and source audit against brute force: nulls,
empty and long texts, ties, repeated rows, clashing extra columns, empty tables."""

import math
import re
import tracemalloc
from collections import Counter, defaultdict
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from feedline.llm import lexical_search, pii, source_audit

SCHEMA = "doc_id long, text string, lang string, source string, term string, score double, rank int, block long, n long"
KINDS = (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
         ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"))


def lower(t):
    return "".join(c.lower() if c.isascii() else c for c in t or "")


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        v = int(c) * (1 + k % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def base(t):
    out = []
    for k, (_, pattern) in enumerate(KINDS):
        for m in re.finditer(pattern, t):
            digits = re.sub("[^0-9]", "", m[0])
            if (True, k == 1 and all(int(x) <= 255 for x in m[0].split(".")), 12 <= len(digits) <= 19 and luhn(digits), 9 <= len(digits) <= 15)[k]:
                out.append((m.start(), k, m.end()))
    return sorted(out)


def words(rng, n, size=300):
    return " ".join(f"{'wxyz'[k % 4]}{k}{rng.choice(['', ',', '.', '-a', 'É'])}" for k in (rng.zipf(1.3, n) % size))


@pytest.fixture(scope="module")
def docs(spark):
    rng = np.random.default_rng(11)
    rows = [(i, words(rng, int(rng.integers(1, 120))), ("en", "de")[i % 2], f"s{i % 5}") for i in range(150)]
    rows += [(200, None, "en", "s1"), (201, "", None, "s1"), (202, " \n", "fr", None), (203, "123 456 -- !", "fr", "only"), (204, "long W1 " * 30_000, "de", None),
             (205, "W1 w1, É é ÉW1", None, None), rows[3], rows[3], (3, "other text w1", "en", "s1"), (None, "x1 no id", "en", "s2"), (None, "x1 no id", "en", "s2")]
    return spark.createDataFrame([(*r, "t", 0.5, 1, 2, 3) for r in rows], SCHEMA).repartition(3).cache()


def test_search_equals_brute_force(spark, docs):
    items = [(1, "w1 x1 y2 not_there"), (2, "W1, w1 É"), (2, "z3 x5"), (3, None), (4, " .. "), (5, "absent"), (None, "x1 y2"), (7, "1"), (8, "w4 x9 y14 z19 w24 x29 w1")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    terms = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower(t))
    rows = [(r["doc_id"], Counter(terms(r["text"]))) for r in docs.collect()]
    n_docs, n_terms = sum(bool(c) for _, c in rows), sum(c.total() for _, c in rows)
    df = Counter(t for _, c in rows for t in c)
    query = defaultdict(set)
    for i, t in items:
        query[i] |= set(terms(t))
    want = []
    for i, ts in query.items():
        scored = []
        for d, c in rows:
            m = 100 - 90 + (90 * c.total() * n_docs) // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m)) for t in ts if c[t])
            if s > 0:
                scored.append((-s, d is None, d or 0))
        want += [(i, k + 1, None if none else d, -s) for k, (s, none, d) in enumerate(sorted(scored)[:10])]
    for group_terms in (1000, 4):
        got = [tuple(r) for r in lexical_search.search(docs, bench, group_terms=group_terms).collect()]
        assert sorted(map(repr, got)) == sorted(map(repr, want))
    assert {w[0] for w in want} == {1, 2, None, 8}
    assert lexical_search.search(docs.limit(0), bench).count() == 0 and lexical_search.search(docs, bench.limit(0)).count() == 0


def test_blocks_skip_exactly():
    rng = np.random.default_rng(2)
    vectors = rng.integers(1, 10**9, (700, 40)) * (rng.random((700, 40)) < 0.4)
    near = {t: np.arange(40) for t in range(40)}
    shard = lexical_search.Shard(vectors, {t: t for t in range(40)}, near)
    for _ in range(50):
        q = rng.choice(40, 6, replace=False).tolist()
        scores = vectors[:, q].sum(axis=1)
        least = int(np.sort(scores)[-3]) if rng.random() < 0.5 else 0
        docs, got = shard.search(q, least, 10)
        assert (scores[docs] == got).all() and len(set(docs)) == len(docs)
        top = np.sort(scores)[::-1][:10]
        assert np.sort(got)[::-1][:10][:np.sum(top >= max(least, 1))].tolist() == top[top >= max(least, 1)].tolist()
    for docs, begins, summaries, place in shard.lists.values():
        ends = [*begins[1:], len(docs)]
        assert len(begins) > 1 and sorted(docs) == sorted(set(docs.tolist()))
        assert all((vectors[docs[a:b]].max(axis=0) == s).all() for a, b, s in zip(begins, ends, summaries))


def audit_rows(rows, min_docs, top):
    terms = lambda t: re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower(t))
    counts, in_docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        groups.add((lang, source))
        counts[lang, source].update(terms(text))
        in_docs[lang].update(set(terms(text)))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in in_docs[lang].items() if n >= min_docs]
        of = {s: counts[lang, s] for (x, s) in groups if x == lang}
        prob = lambda c: {t: 1 + 10**9 * (c[t] + 5) // (sum(c[k] for k in kept) + 5 * len(kept)) for t in kept}
        p, q = {s: prob(c) for s, c in of.items()}, prob(sum(of.values(), Counter()))
        for s in of:
            pairs = sorted((-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode()) for o in of if o != s)
            out += [(lang, s, "pair", o.decode(), -v, k + 1) for k, (v, o) in enumerate(pairs)]
            own = sorted((q[t] - p[s][t], t.encode()) for t in kept if of[s][t] and p[s][t] > q[t])[:top]
            out += [(lang, s, "term", t.decode(), -v, k + 1) for k, (v, t) in enumerate(own)]
    return sorted(out)


@pytest.mark.parametrize("min_docs, top", [(2, 5), (20, 50), (10_000, 50)])
def test_source_audit_equals_brute_force(docs, min_docs, top):
    rows = [(r["text"] or "", r["lang"] or "", r["source"] or "") for r in docs.collect()]
    got = sorted(tuple(r) for r in source_audit.source_divergence(docs, min_docs, top).collect())
    assert got == audit_rows(rows, min_docs, top)


def test_source_audit_blocks_and_empty_table(docs):
    whole = sorted(tuple(r) for r in source_audit.term_counts(docs).collect())
    assert sorted(tuple(r) for r in source_audit.term_counts(docs, block_bytes=500).collect()) == whole and whole
    assert source_audit.source_divergence(docs.limit(0)).count() == 0
    arrays = [np.array([0, 5, 70_000]), np.zeros(0, np.int64), np.arange(3000)]
    assert all((a == b).all() for a, b in zip(source_audit.unpack(source_audit.pack(*arrays)), arrays))


def audit_block(monkeypatch, texts, limit):
    monkeypatch.setattr(source_audit.TaskContext, "get", staticmethod(lambda: SimpleNamespace(partitionId=lambda: 0)))
    batch = pa.RecordBatch.from_pydict({"lang": ["en"] * len(texts), "source": ["s%d" % (k % 3) for k in range(len(texts))], "text": texts})
    return [pa.table(b) for b in source_audit.blocks_of(iter([batch]), limit)]


def test_audit_block_of_one_long_text(monkeypatch):
    blocks = audit_block(monkeypatch, ["First Text " * 9, "Ünd So " * 30, "one MORE"], 50)
    assert [b.column("plain")[0].as_py() for b in blocks] == [["first", "text"], ["Ünd", "so"], ["one", "more"]]


def test_audit_counts_are_spread_in_slices(monkeypatch):
    rng = np.random.default_rng(2)
    names = [a + b for a in "abcdefghijklmnopqrst" for b in "abcdefghijklmnopqrst"]
    texts = [" ".join(names[k] for k in rng.integers(0, 400, 150)) for _ in range(8000)]
    [block] = audit_block(monkeypatch, texts, 1 << 30)
    none = pa.table({"home": pa.array([], pa.int64()), "pos": pa.array([], pa.int32()), "terms": pa.array([], pa.list_(pa.string()))})
    tracemalloc.start()
    got = source_audit.count_terms(none, block).to_pylist()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60 << 20
    want, in_docs = Counter(), Counter()
    for k, t in enumerate(texts):
        want.update((f"s{k % 3}", w) for w in t.split())
        in_docs.update((f"s{k % 3}", w) for w in set(t.split()))
    keys = {(r["source"], r["term"]): (r["docs"], r["n"]) for r in got}
    assert len(keys) == len(got) and keys == {k: (in_docs[k], n) for k, n in want.items()}


@pytest.fixture(scope="module")
def private(spark):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(300):
        card = "4" + "".join(map(str, rng.integers(0, 10, 14)))
        card += next(d for d in "0123456789" if luhn(card + d))
        found = (f"ann.{i}@mail{i % 7}.example.org", f"{i % 256}.{rng.integers(256)}.{rng.integers(256)}.7", card, f"+1 ({100 + i}) 555-{1000 + i}")[i % 4]
        rows.append((i, f"{words(rng, 30)} {found} {words(rng, 20)}"))
    rows += [(1000, None), (1001, ""), (1002, "clean words only, version 3.1 of 2004, page 12"), (1003, "é" * 5000 + " x@y.z 1.2.3.4"),
             (1004, "write to bob.smith (at) example (dot) org today"), (1005, "born 2001-02-03, 12 345 678 units, 3.2.1.4000"), (1006, "a@b.c a@b.c"), (1006, "a@b.c a@b.c"),
             (1007, "4111111111111111 4012888888881881"), (None, "1.2.3.4.5 +1 2 3 4 5 6 7 8 9 999.1.1.1")]
    return spark.createDataFrame([(*r, 1, "k") for r in rows], "doc_id long, text string, kind int, base string").repartition(3).cache()


def test_base_spans_and_added_ones(private):
    rows = private.collect()
    got = pii.personal_data(private, precision=0.9).select("doc_id", *[pii.kind_count(F.col("base"), k).alias(k) for k in pii.KINDS],
                                                          pii.span_text(F.col("base")).alias("b"), pii.span_text(F.col("spans")).alias("s")).collect()
    text = lambda spans: ",".join(f"{KINDS[k][0]}:{a}:{b}" for a, k, b in spans)
    assert Counter((r["doc_id"], r["b"]) for r in got) == Counter((r["doc_id"], text(base(r["text"] or ""))) for r in rows)
    by_id = {r["doc_id"]: r for r in got}
    assert all(set(filter(None, r["b"].split(","))) <= set(r["s"].split(",")) for r in got)
    assert [by_id[i]["s"] for i in (1000, 1001, 1002, 1005)] == ["", "", "", ""]
    assert by_id[1004]["s"] == "email:9:41" and by_id[1004]["b"] == ""
    assert by_id[1007]["s"] == "card:0:16,card:17:33" and by_id[1007]["b"] == ""
    assert sum(by_id[i]["s"] == by_id[i]["b"] for i in range(300)) >= 298
    assert pii.personal_data(private.limit(0)).count() == 0


def test_base_spans_of_hostile_texts():
    rng = np.random.default_rng(9)
    parts = [*"a.@-+ ()0123456789", "é", "x@y.z", "1.2.3.4", "+1 ", "256", "4111111111111111", "\n"]
    for _ in range(20_000):
        t = "".join(parts[k] for k in rng.integers(0, len(parts), rng.integers(0, 25)))
        assert pii.base_spans(t) == base(t)
        assert all(len(pii.features(t, s, e)) == len(pii.FEATURES) for s, _, e in pii.proposals(t))


def test_trees_learn_and_thresholds_hold_their_precision():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(4000, 6))
    y = ((x[:, 0] > 0.3) ^ (x[:, 1] * x[:, 2] > 0)).astype(float)
    trees = pii.Trees(x[:3000], y[:3000])
    margin = trees.margin(x[3000:])
    assert ((margin > 0) == y[3000:]).mean() > 0.9
    least = pii.threshold(margin, y[3000:], 0.97)
    assert y[3000:][margin >= least].mean() >= 0.97 and pii.threshold(margin, np.zeros(1000), 0.97) == float("inf")


def test_redaction(spark, private):
    got = pii.personal_data(private).where("doc_id = 1003").join(private.select("doc_id", "text"), "doc_id")
    assert got.select(pii.redacted(F.col("text"), F.col("spans"))).first()[0] == "é" * 5000 + " [email] [ip]"


def test_trees_are_fitted_to_all_examples(spark):
    f = lambda j: F.pmod(F.xxhash64("id", F.lit(j)), F.lit(50 if j < 8 else 2))
    label = (F.pmod(F.xxhash64("id", F.lit(0)), F.lit(50)) > 30).cast("int")
    sample = F.struct(F.lit(1).alias("kind"), label.alias("label"), F.array(*[f(j).cast("float") for j in range(len(pii.FEATURES))]).alias("features"))
    scanned = spark.range(0, 45_000, 1, 3).select(F.array(sample).alias("samples")).cache()
    rows = scanned.select(F.explode("samples").alias("s")).select("s.*")
    fit = rows.where(F.pmod(F.xxhash64("kind", "label", "features"), F.lit(5)) != 0)
    n, positive = fit.agg(F.count(F.lit(1)), F.sum("label")).first()
    trees, least = pii.train(scanned)[1]
    assert n > 35_000 and trees.base == pytest.approx(np.log((positive + 1) / (n - positive + 1)), abs=0)
    got = fit.collect()
    x, y = np.array([r["features"] for r in got], float), np.array([r["label"] for r in got], float)
    alone = pii.Trees(x, y)
    assert np.allclose(alone.margin(x[:500]), trees.margin(x[:500]))
    assert ((trees.margin(x) >= least) == (y == 1)).mean() > 0.97  # 16 bins of 50 values: one value shares its bin
    start = pii.Trees().begin(np.quantile(x, alone.fractions(), axis=0).T, n, positive)
    assert np.allclose(pii._all_sums(fit, {1: start})[1], start.sums(x, y))
