r"""URL filters: allow and block rules, and for the rest a Bloom filter cascade.

Level 1 encodes the listed keys; level 2 the keys of the corpus that level 1
lets through wrongly; level 3 the listed keys that level 2 lets through; and so
on until a level has no false positives over the complete key universe.
Membership of any key of the universe is then exact and needs no join: the
first level that rejects the key decides. The filters are built by
aggregation (``bit_or`` of 64-bit words) and read back as scalar subqueries.

Size bound: level i holds ``bits_per_key`` bits for each of its keys; level 1
holds the list, each further level a false-positive share (under 1 %) of the
one before it or of the universe. What goes to the executors is that many
bits, whatever the number of pages.

Edge cases: a null url or one without ``://`` has empty host and path, fits no
rule and is never listed (verdict allow); an empty list or an empty table
works; ties between rules of equal length cannot fit one url unless the rules
are equal, then the first listed rule wins.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedline.llm.common import ascii_lower, staged

# (verdict, host, path prefix) of the contract.
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/"))


def url_rest(url: Column) -> Column:
    """What follows the first ``://``; null without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def url_host(url: Column) -> Column:
    return F.coalesce(ascii_lower(F.regexp_extract(url_rest(url), r"^([^/?#]*)", 1)), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> Column:
    """The longest rule that fits, as ``struct(rule, verdict)``; else null."""
    best = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rhost, rpath in sorted(rules, key=lambda r: len(r[1]) + len(r[2])):
        fits = ((host == rhost) | host.endswith("." + rhost)) & path.startswith(rpath)
        best = F.when(fits, F.struct(F.lit(rhost + rpath).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(best)
    return best


@dataclass
class Level:
    words: DataFrame  # one row: array of 64-bit words
    bits: int
    hashes: int
    seed: int


def positions(key: Column, level_seed: int, bits: int, hashes: int) -> Column:
    a, b = F.xxhash64(F.lit(level_seed), key), F.xxhash64(F.lit(-1 - level_seed), key)
    a, b = F.shiftrightunsigned(a, 2), F.shiftrightunsigned(b, 16)
    return F.array(*[(a + b * i) % F.lit(bits) for i in range(hashes)])


def build_level(keys: DataFrame, n: int, seed: int, bits_per_key: int) -> Level:
    """A Bloom filter of ``keys`` (column ``key``, ``n`` of them)."""
    words = max(1, math.ceil(n * bits_per_key / 64))
    bits, hashes = words * 64, max(1, round(bits_per_key * math.log(2)))
    spark = keys.sparkSession
    at = keys.select(F.explode(positions(F.col("key"), seed, bits, hashes)).alias("p"))
    one = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("p") % 64).cast("int"))
    rows = at.select(F.floor(F.col("p") / 64).alias("i"), one.alias("w"))
    dense = rows.union(spark.range(words).select(F.col("id").alias("i"), F.lit(0).cast("long").alias("w")))
    filled = dense.groupBy("i").agg(F.bit_or("w").alias("w"))
    packed = filled.agg(F.sort_array(F.collect_list(F.struct("i", "w"))).alias("a")).select(F.col("a.w").alias("words"))
    return Level(staged(packed, "bloom"), bits, hashes, seed)


def passes(level: Level, key: Column) -> Column:
    words = level.words.select("words").scalar()
    at = positions(key, level.seed, level.bits, level.hashes)
    read = [F.get(at, F.lit(i)) for i in range(level.hashes)]
    bits = [F.getbit(F.get(words, F.floor(p / 64).cast("int")), (p % 64).cast("int")) for p in read]
    return F.least(*bits, F.lit(1)) == 1


@dataclass
class Cascade:
    levels: list[Level]

    def contains(self, key: Column) -> Column:
        """Exact for every key of the universe it was built over. Passing all
        levels means what the last one encodes: listed keys in levels 1, 3, ..."""
        found = F.lit(len(self.levels) % 2 == 1)
        for i in range(len(self.levels) - 1, -1, -1):
            found = F.when(~passes(self.levels[i], key), F.lit(i % 2 == 1)).otherwise(found)
        return found


def build_cascade(listed: DataFrame, universe: DataFrame, bits_per_key: int = 10) -> Cascade:
    """``listed`` and ``universe`` have a column ``key``; listed keys outside
    the universe are encoded too. Nulls are ignored, repeats count once."""
    inside = staged(listed.select("key").where("key IS NOT NULL").distinct(), "listed")
    outside = staged(universe.select("key").where("key IS NOT NULL").distinct().join(inside, "key", "left_anti"), "unlisted")
    levels: list[Level] = []
    sides = [inside, outside]  # what the next level encodes, what must not pass it
    while (n := sides[0].count()) > 0:
        level = build_level(sides[0], n, len(levels) + 1, bits_per_key)
        levels.append(level)
        sides = [staged(sides[1].where(passes(level, F.col("key"))), "passed"), sides[0]]
    return Cascade(levels)


def tracking_hosts(pages: DataFrame, share: float = 0.2) -> DataFrame:
    """Default list: hosts of which more than ``share`` of the pages carry a
    ``utm_source`` tag."""
    tagged = F.coalesce(F.contains("url", F.lit("utm_source=")), F.lit(False))
    return (pages.select(url_host(F.col("url")).alias("key"), tagged.cast("int").alias("t")).where("key <> ''")
            .groupBy("key").agg(F.sum("t").alias("t"), F.count(F.lit(1)).alias("n"))
            .where(F.col("t") > F.col("n") * F.lit(share)).select("key"))


def judge_urls(pages: DataFrame, listed: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """``page_id, host, path, rule, verdict``; urls that no rule fits are
    blocked when the cascade holds their host."""
    hosts = pages.select(url_host(pages["url"]).alias("key")).where("key <> ''")
    cascade = build_cascade(listed, hosts)
    p = pages.select(pages["page_id"].alias("page_id"), url_host(pages["url"]).alias("host"), url_path(pages["url"]).alias("path"))
    p = p.withColumn("best", rule_for(F.col("host"), F.col("path"), rules))
    listed_host = (F.col("host") != "") & cascade.contains(F.col("host"))
    method = F.when(listed_host, "block").otherwise("allow")
    return p.select("page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", method).alias("verdict"))
