r"""Near-duplicates by ProbMinHash, banding and exact verification.

A text is the weighted set of its word shingles (weight ``1 + ln(count)``).
Every shingle is a Poisson process of its weight's rate whose arrivals fall on
random registers; a register keeps the shingle of its first arrival. A shingle
stops as soon as its next arrival is later than the text's latest register, so
the work is about one or two rounds per shingle. Two texts agree in a register
with the probability Jaccard similarity of their weights. ``rows`` registers
make a band; texts that share a band are candidates (a pair at 0.8 is missed by
all 32 bands of 5 with probability 3e-6) and are verified on their shingles:
they are linked when the probability Jaccard or the plain Jaccard similarity
reaches the threshold. A text that repeats shingles has bands of both, those
of its weights and those of equal weights (of the others the two are the same),
so the probability holds for either measure. A document's class is its
connected component.

Hot groups. Texts with equal shingles are one node from the start, so copies
cost nothing. Bands of up to ``small`` nodes are compared pair by pair. In
larger bands every node is compared with the band's most central node only
(the one that shares most bands), which joins a family of edited copies with
linear work. What that may leave apart is settled exactly by a prefix filter
over the nodes of large bands: shingles ordered by rarity, necessary prefixes,
length and positional bounds; only nodes of different components meet, and
heavily edited members have prefixes that no other node holds. The filter holds
for either measure: plain Jaccard is bounded by the number of shingles from a
shared one on, probability Jaccard by their share of the text's weight (with
shares P and Q in common it is at most PQ / (P + Q - PQ)).

Scale: texts move once, and only those of candidate nodes; the sketch is 32
band keys a document. Components are computed by label propagation with
pointer jumping on staged tables; nothing but counts reaches the driver.

Edge cases: null, empty and wordless texts have no shingles and stay alone;
texts shorter than a shingle are one shingle; rows that repeat a doc_id are
nodes of their own; extra columns are never read; an empty table works.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from feedline.llm.common import chunks, released, row_key, split_words, staged, with_text, word_hashes

BANDS, ROWS, SMALL = 32, 5, 16
CHUNK_WORDS = 100_000  # sketched at once, in a dozen arrays of 64-bit numbers
U = np.uint64
STEP = U(0x9E3779B97F4A7C15)


def mix64(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all windows of ``size`` words; a shorter text is one window."""
    n = min(size, len(words))
    if not n:
        return np.empty(0, np.uint64)
    h = np.full(len(words) - n + 1, U(n))
    for i in range(n):
        h = mix64(h * STEP + words[i:len(words) - n + 1 + i])
    return h


def weighted(words: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles, sorted, and how often each occurs."""
    return np.unique(shingle_hashes(words, size), return_counts=True)


def prob_minhash(shingles: np.ndarray, weights: np.ndarray, doc: np.ndarray, docs: int, registers: int) -> np.ndarray:
    """Signatures ``[docs, registers]`` (uint32 of the winning shingle) of many
    texts at once; ``doc`` (ascending) says whose a shingle is."""
    first = np.full((docs, registers), np.inf)
    winner = np.zeros((docs, registers), np.uint32)
    flat_first, flat_winner = first.ravel(), winner.ravel()
    t = np.zeros(len(shingles))
    h, w, d = shingles, weights, doc
    k = 0
    while len(h):
        k += 1
        r = mix64(h + U((k * int(STEP)) & 0xFFFFFFFFFFFFFFFF))
        t = t - np.log(((r >> U(11)).astype(np.float64) + 1) * 2.0**-53) / w
        slot = d * registers + ((mix64(r ^ STEP) >> U(32)) * U(registers) >> U(32)).astype(np.int64)
        better = t < flat_first[slot]
        at, when, who = slot[better], t[better], h[better]
        np.minimum.at(flat_first, at, when)
        won = flat_first[at] == when
        flat_winner[at[won]] = (who[won] >> U(32)).astype(np.uint32)
        # A text's shingles go on while they can still beat its latest register.
        open_docs = np.unique(d)
        latest = np.zeros(docs)
        latest[open_docs] = first[open_docs].max(axis=1)
        go = t < latest[d]
        h, w, d, t = h[go], w[go], d[go], t[go]
    return winner


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per band, different for equal values in other bands."""
    parts = signature.reshape(len(signature), bands, rows).astype(np.uint64)
    h = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * STEP, parts.shape[:2]).copy()
    for i in range(rows):
        h = mix64(h * STEP + parts[:, :, i])
    return h.view(np.int64)


def sketch_rows(batch: pa.RecordBatch, size: int, bands: int, rows: int) -> tuple[list[bytes | None], list]:
    """Per text: a 128-bit fingerprint of its weighted shingles (null without
    words) and its band keys."""
    words, numbers, offsets = split_words(batch)
    hashed = word_hashes(words)[numbers] if len(words) else np.empty(0, np.uint64)
    n = batch.num_rows
    prints: list[bytes | None] = [None] * n
    keys: list = [None] * n
    for begin, end in chunks(list(range(n)), np.diff(offsets).tolist(), CHUNK_WORDS):
        sets, who = [], []
        for i in range(begin, end):
            if offsets[i + 1] > offsets[i]:
                s, c = weighted(hashed[offsets[i]:offsets[i + 1]], size)
                prints[i] = hashlib.md5(s.tobytes() + c.tobytes()).digest()
                sets.append((s, c))
                who.append(i)
        if not who:
            continue
        doc = np.repeat(np.arange(len(who)), [len(s) for s, _ in sets])
        weights = 1 + np.log(np.concatenate([c for _, c in sets]))
        signature = prob_minhash(np.concatenate([s for s, _ in sets]), weights, doc, len(who), bands * rows)
        for i, k in zip(who, band_keys(signature, bands, rows)):
            keys[i] = k
        plain = [(i, s) for i, (s, c) in zip(who, sets) if c.max() > 1]
        if plain:
            flat = np.concatenate([s for _, s in plain])
            doc = np.repeat(np.arange(len(plain)), [len(s) for _, s in plain])
            signature = prob_minhash(flat, np.ones(len(flat)), doc, len(plain), bands * rows)
            for (i, _), k in zip(plain, band_keys(signature, bands, rows)):
                keys[i] = np.union1d(keys[i], k)
    return prints, keys


def sketch(docs: DataFrame, size: int = 5, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, row key, fp (fingerprint) and keys (one per band)."""
    d = with_text(docs)
    d = d.select("doc_id", *row_key(d["doc_id"], d["text"]), "text")
    kind = d.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 1024):
                part = batch.slice(i, 1024)
                prints, keys = sketch_rows(part, size, bands, rows)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("k1"), part.column("k2"), pa.array(prints, pa.binary()),
                                                  pa.array(keys, pa.list_(pa.int64()))], names=["doc_id", "k1", "k2", "fp", "keys"])

    return d.mapInArrow(lambda batches: released(run(batches)), f"doc_id {kind}, k1 long, k2 long, fp binary, keys array<long>")


def shingle_sets(texts_of_nodes: DataFrame, size: int) -> DataFrame:
    """fp, text -> fp, n, grams (sorted 64-bit hashes) and counts (u32)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 1024):
                part = batch.slice(i, 1024)
                words, numbers, offsets = split_words(part)
                hashed = word_hashes(words)[numbers]
                sets = [weighted(hashed[a:b], size) for a, b in zip(offsets[:-1], offsets[1:])]
                yield pa.RecordBatch.from_arrays(
                    [part.column("fp"), pa.array([len(s) for s, _ in sets], pa.int64()), pa.array([s.tobytes() for s, _ in sets], pa.binary()),
                     pa.array([c.astype("<u4").tobytes() for _, c in sets], pa.binary())], names=["fp", "n", "grams", "counts"])

    return texts_of_nodes.mapInArrow(lambda batches: released(run(batches)), "fp binary, n long, grams binary, counts binary")


def similarity_of(a: np.ndarray, ca: np.ndarray, b: np.ndarray, cb: np.ndarray) -> float:
    """The larger of the plain Jaccard and the probability Jaccard similarity
    (weights 1 + ln count), both exact."""
    _, ia, ib = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if not len(ia):
        return 0.0
    plain = len(ia) / (len(a) + len(b) - len(ia))
    if ca.max() == 1 and cb.max() == 1:
        return plain
    x, y = 1 + np.log(ca), 1 + np.log(cb)
    cx, cy = x[ia], y[ib]
    only_x, only_y = x.sum() - cx.sum(), y.sum() - cy.sum()
    pairs, n = np.unique(np.stack([cx, cy]), axis=1, return_counts=True)
    weighted_sum = 0.0
    for u, v, k in zip(pairs[0], pairs[1], n):
        weighted_sum += k / ((n * np.maximum(pairs[0] / u, pairs[1] / v)).sum() + only_x / u + only_y / v)
    return max(plain, weighted_sum)


def verify(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) of nodes whose similarity reaches the threshold."""
    side = lambda s: sets.select(F.col("fp").alias(s), F.col("grams").alias(f"g{s}"), F.col("counts").alias(f"c{s}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                part = batch.slice(i, 512)
                ga, gb = part.column("ga"), part.column("gb")
                ca, cb = part.column("ca"), part.column("cb")
                keep = [similarity_of(np.frombuffer(ga[j].as_buffer(), "<u8"), np.frombuffer(ca[j].as_buffer(), "<u4"),
                                      np.frombuffer(gb[j].as_buffer(), "<u8"), np.frombuffer(cb[j].as_buffer(), "<u4")) >= threshold
                        for j in range(part.num_rows)]
                yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "ga", "ca", "gb", "cb")
    return both.mapInArrow(lambda batches: released(run(batches)), "a binary, b binary")


def components(links: DataFrame) -> DataFrame:
    """Connected components: ``node, root`` (its component's least node)."""
    links = staged(links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = staged(links.select(F.col("a").alias("node")).distinct().withColumn("root", F.col("node")), "labels")
    while True:
        near = links.join(labels, links["b"] == labels["node"]).groupBy("a").agg(F.min("root").alias("m"))
        step = labels.join(near, labels["node"] == near["a"]).select("node", F.least("root", "m").alias("r"), F.col("root").alias("old"))
        roots = step.select(F.col("node").alias("via"), F.col("r").alias("beyond"))
        jump = step.join(roots, step["r"] == roots["via"]).select("node", F.least("r", "beyond").alias("root"), "old")
        jump = staged(jump, "labels")
        labels = jump.select("node", "root")
        if jump.where(F.col("root") != F.col("old")).isEmpty():
            return labels


def ordered(a, b) -> list:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def candidate_pairs(reps: DataFrame, small: int) -> tuple[DataFrame, DataFrame]:
    """(distinct candidate pairs; nodes of large bands)."""
    band = reps.select("fp", F.explode("keys").alias("key"))
    sizes = staged(band.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b")).where("n > 1"), "bands")
    members = staged(band.join(sizes.where("n > 2").select("key", "n"), "key"), "members")
    few, many = members.where(F.col("n") <= small), members.where(F.col("n") > small)
    pairs = sizes.where("n = 2").select("a", "b")
    left, right = few.select("key", F.col("fp").alias("x")), few.select("key", F.col("fp").alias("y"))
    pairs = pairs.union(left.join(right, "key").where("x < y").select(F.col("x").alias("a"), F.col("y").alias("b")))
    central = many.groupBy("fp").agg(F.sum("n").alias("c"))
    ranked = many.join(central, "fp")
    leader = ranked.groupBy("key").agg(F.max(F.struct("c", "fp")).alias("top")).select("key", F.col("top.fp").alias("y"))
    star = many.join(leader, "key").where("fp <> y").select(*ordered(F.col("fp"), F.col("y")))
    return pairs.union(star).distinct(), many.select("fp").distinct()


def residual_pairs(hot: DataFrame, sets: DataFrame, roots: DataFrame, threshold: float) -> DataFrame:
    """Candidate pairs between different components among the hot nodes, by an
    exact prefix filter: only prefixes of rare shingles are joined, under length
    and positional bounds on the plain Jaccard or, where a shingle repeats,
    under positional bounds on the probability Jaccard."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = batch.column("n").to_numpy()
            for i, end in chunks(list(range(batch.num_rows)), numbers.tolist(), 200_000):
                part = batch.slice(i, end - i)
                at = pa.array(np.repeat(np.arange(part.num_rows, dtype=np.int32), numbers[i:end]))
                weights = [1 + np.log(np.frombuffer(c.as_buffer(), "<u4")) for c in part.column("counts")]
                repeats = pa.array([bool(w.max() > 1) for w in weights], pa.bool_())
                grams = np.concatenate([np.frombuffer(g.as_buffer(), "<i8") for g in part.column("grams")])
                yield pa.RecordBatch.from_arrays(
                    [part.column("fp").take(at), part.column("n").take(at), repeats.take(at),
                     pa.array(np.concatenate([w / w.sum() for w in weights])), pa.array(grams)], names=["fp", "n", "repeats", "share", "gram"])

    rows = sets.join(hot, "fp", "left_semi").select("fp", "n", "grams", "counts")
    rows = staged(rows.mapInArrow(lambda batches: released(spread(batches)), "fp binary, n long, repeats boolean, share double, gram long"), "hot-shingles")
    shared = rows.groupBy("gram").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    rows = rows.join(shared, "gram")
    # A node's unshared shingles are its rarest: they fill the first positions.
    rarest = W.partitionBy("fp").orderBy("df", "gram")
    rows = rows.withColumn("p", F.row_number().over(rarest) + F.col("n") - F.count(F.lit(1)).over(W.partitionBy("fp")))
    # What a node can share by weight from here on.
    before = F.sum("share").over(rarest.rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("share")
    rows = rows.withColumn("s", F.sum("share").over(W.partitionBy("fp")) - before)
    least = F.ceil(F.col("n") * F.lit(threshold) - F.lit(1e-9))
    # A node without repeats may meet one that has some, and has one prefix by either measure.
    own = ["gram", "fp", "n", "p", "s", "repeats"]
    prefix = rows.where((F.col("p") <= F.col("n") - least + 1) | (F.col("s") >= threshold - 1e-9)).select(*own)
    prefix = prefix.join(roots, prefix["fp"] == roots["node"], "left").select(*own, F.coalesce("root", "fp").alias("root"))
    prefix = staged(prefix, "prefixes")
    groups = prefix.groupBy("gram", "root").agg(F.count(F.lit(1)).alias("c"))
    main = groups.groupBy("gram").agg(F.max(F.struct("c", "root")).alias("top"), F.count(F.lit(1)).alias("k"), F.sum("c").alias("all")).where("k > 1")
    # A gram of many nodes is dealt to several tasks.
    main = main.select("gram", F.col("top.root").alias("main"), (1 + F.floor(F.col("all") / 1000)).cast("int").alias("salts"))
    mixed = prefix.join(main, "gram")
    x = mixed.where("root <> main").withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
    x = x.select("gram", "salt", *[F.col(c).alias(f"{c}1") for c in [*own[1:], "root"]])
    y = mixed.withColumn("salt", F.pmod(F.hash("fp"), F.col("salts"))).select("gram", "salt", *[F.col(c).alias(f"{c}2") for c in [*own[1:], "root"]])
    t = threshold
    plain = ((F.least("n1", "n2") >= F.greatest("n1", "n2") * t - 1e-9)
             & (1 + F.least(F.col("n1") - F.col("p1"), F.col("n2") - F.col("p2")) >= (F.col("n1") + F.col("n2")) * (t / (1 + t)) - 1e-9))
    both = F.col("s1") * F.col("s2")
    by_weight = (F.col("repeats1") | F.col("repeats2")) & (both >= (F.col("s1") + F.col("s2") - both) * t - 1e-9)
    fits = (F.col("root1") != F.col("root2")) & (plain | by_weight)
    return x.join(y, (x["gram"] == y["gram"]) & (x["salt"] == y["salt"]) & fits).select(*ordered(F.col("fp1"), F.col("fp2"))).distinct()


def classes(docs: DataFrame, words: int = 5, similarity: float = 0.8, bands: int = BANDS, rows: int = ROWS, small: int = SMALL) -> DataFrame:
    """Per input row: doc_id, row key, class_id (least doc_id of the class) and
    the row key of the class's representative (r1, r2)."""
    sk = staged(sketch(docs, words, bands, rows), "sketch")
    first = F.min(F.struct("doc_id", "k1", "k2")).alias("r")
    reps = staged(sk.where("fp IS NOT NULL").groupBy("fp").agg(first, F.first("keys").alias("keys")), "nodes")
    pairs, hot = candidate_pairs(reps, small)
    pairs, hot = staged(pairs, "pairs"), staged(hot, "hot")
    needed = pairs.select(F.col("a").alias("fp")).union(pairs.select(F.col("b").alias("fp"))).union(hot).distinct()
    needed = needed.join(reps.select("fp", F.col("r.k1").alias("k1"), F.col("r.k2").alias("k2")), "fp")
    d = with_text(docs)
    nodes = d.select(*row_key(d["doc_id"], d["text"]), "text").join(needed, ["k1", "k2"]).select("fp", "text")
    sets = staged(shingle_sets(nodes, words).dropDuplicates(["fp"]), "sets")
    links = staged(verify(pairs, sets, similarity), "verified")
    roots = components(links)
    if not hot.isEmpty():
        more = staged(verify(staged(residual_pairs(hot, sets, roots, similarity), "residual"), sets, similarity), "verified")
        if not more.isEmpty():
            roots = components(links.union(more))
    joined = reps.select("fp", "r").join(roots, reps["fp"] == roots["node"]).select("fp", "r", "root")
    heads = joined.groupBy("root").agg(F.min("r").alias("head"))
    linked = joined.join(heads, "root").select("fp", "head")
    # Nodes without a link are their own class.
    nodes = reps.select("fp", "r").join(linked, "fp", "left").select("fp", F.coalesce("head", "r").alias("head"))
    out = sk.select("doc_id", "k1", "k2", "fp").join(nodes, "fp", "left")
    own = F.struct("doc_id", "k1", "k2")
    head = F.coalesce("head", own)
    return out.select("doc_id", "k1", "k2", head["doc_id"].alias("class_id"), head["k1"].alias("r1"), head["k2"].alias("r2"))


def near_duplicates(docs: DataFrame, words: int = 5, similarity: float = 0.8, **how) -> DataFrame:
    """Per input row: doc_id, class_id and whether it stands for its class."""
    got = classes(docs, words, similarity, **how)
    return got.select("doc_id", "class_id", ((F.col("k1") == F.col("r1")) & (F.col("k2") == F.col("r2"))).alias("representative"))


def keep_representatives(docs: DataFrame, words: int = 5, similarity: float = 0.8, **how) -> DataFrame:
    """One document of each class, all columns unchanged."""
    got = staged(classes(docs, words, similarity, **how), "classes")
    stay = got.where("k1 = r1 AND k2 = r2").groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("copies"))
    keyed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), *row_key(docs["doc_id"], F.coalesce(docs["text"], F.lit(""))))
    kept = keyed.join(stay, ["k1", "k2"])
    if not stay.where("copies > 1").isEmpty():  # rows with equal doc_id and text: the one of least hash
        kept = kept.groupBy("k1", "k2").agg(F.min_by("row", F.xxhash64("row")).alias("row"))
    return kept.select("row.*")
