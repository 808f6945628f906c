"""URL filters: rule and host lists as Bloom filter cascades over the corpus's keys.

A key is a host suffix plus a path prefix. The universe is every key any URL
of the corpus can ask for. Level 1 encodes the listed keys; the universe's
unlisted keys that pass it are encoded in level 2, the listed keys that pass
that one in level 3, and so on until a level lets nothing wrong through. A key
is listed if the first level to reject it is an even one (or, if none rejects
it, the number of levels is odd): exact for every key of the universe, and a
page needs only its own URL and a few kilobytes of bits - no join.

Only DataFrame functions are used. Bits are aggregated by word with ``bit_or``
before the shuffle. A filter holds at most ``MAX_BITS``; longer lists are split
by key hash into shards of that size, applied in one pass each.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lower_ascii, pick, stored

BITS_PER_KEY = 8
HASHES = 4
MAX_BITS = 1 << 23
MAX_LEVELS = 64


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def key(self) -> str:
        return self.host + self.path


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lowered) and path; both empty for a null url or one without ``://``."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    text = F.coalesce(url, F.lit(""))
    return lower_ascii(F.regexp_extract(text, pattern, 1)), F.regexp_extract(text, pattern, 2)


def candidate_keys(shapes: list[tuple[int, int]]) -> Column:
    """All keys of the columns ``host`` and ``path`` that a listed key can equal.

    ``shapes`` are (labels of the host, length of the path) of the listed keys:
    a url asks for the last so many labels of its host with the first so many
    characters of its path, and for its bare full host. So the keys of a url
    are bounded by the list, however long its host is.
    """
    asked = [f"if(size(labels) >= {n} and length(path) >= {k}, concat(substring_index(host, '.', -{n}), substring(path, 1, {k})), null)"
             for n, k in sorted(set(shapes))]
    keys = ", ".join(["if(host = '', null, host)", *asked])
    keys = keys.replace("size(labels)", "(length(host) - length(replace(host, '.', '')) + 1)")
    return F.expr(f"array_distinct(filter(array({keys}), k -> k is not null and not startswith(k, '/')))")


def _position(key: str, j: int, seed: int, bits: int) -> str:
    return f"pmod(xxhash64({key}, {seed * 1000 + j}), {bits})"


def _filter_bits(keys: DataFrame, n: int, seed: int) -> tuple[bytes, int]:
    """A Bloom filter of the column ``key``: its bytes (little-endian words) and bit count."""
    bits = max(64, 64 * math.ceil(BITS_PER_KEY * n / 64))
    spots = F.explode(F.expr("array(" + ", ".join(_position("key", j, seed, bits) for j in range(HASHES)) + ")"))
    words = (
        keys.select(spots.alias("p")).groupBy(F.expr("p div 64").alias("w"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(p % 64 as int))")).alias("v")).collect()  # at most MAX_BITS / 64 rows
    )
    out = np.zeros(bits // 64, "<i8")
    for row in words:
        out[row.w] = row.v
    return out.tobytes(), bits


@dataclass
class Cascade:
    """Levels of one list (or one shard of it) as (bytes, bits, seed)."""

    levels: list[tuple[bytes, int, int]]

    def columns(self, name: str) -> dict[str, Column]:
        return {f"{name}{i}": F.lit(bytearray(raw)) for i, (raw, _, _) in enumerate(self.levels)}

    def test(self, name: str, key: str = "k") -> str:
        """SQL condition: is ``key`` (of the universe) listed?"""
        out = "true" if len(self.levels) % 2 else "false"
        for i in range(len(self.levels) - 1, -1, -1):
            _, bits, seed = self.levels[i]
            passed = " and ".join(
                f"cast(conv(hex(substring({name}{i}, cast({p} div 8 as int) + 1, 1)), 16, 10) as int) & shiftleft(1, cast({p} % 8 as int)) <> 0"
                for p in (_position(key, j, seed, bits) for j in range(HASHES)))
            reject = "false" if i % 2 == 0 else "true"
            out = f"if({passed}, {out}, {reject})"
        return out


class TooManyKeys(ValueError):
    """A level's filter would pass ``MAX_BITS``: its keys have to be split."""


def build_cascade(keys: DataFrame, seed: int = 0) -> Cascade:
    """From the whole universe: rows ``key string, listed boolean``, each key once."""
    levels: list[tuple[bytes, int, int]] = []
    sides = [keys.where("listed"), keys.where("not listed")]
    for depth in range(MAX_LEVELS):
        wrong = sides[depth % 2].select("key")
        n = wrong.count()
        if not n:
            return Cascade(levels)
        if n > MAX_BITS / BITS_PER_KEY:
            raise TooManyKeys(n)
        levels.append((*_filter_bits(wrong, n, seed + depth), seed + depth))
        level, other = Cascade(levels[-1:]), (depth + 1) % 2
        kept = sides[other].select("*", *[c.alias(k) for k, c in level.columns("f").items()])
        sides[other] = stored(kept.where(level.test("f", "key")).drop("f0"), "cascade")
    raise RuntimeError("the cascade did not end")


def listed_in(rows: DataFrame, listed: DataFrame, out: str) -> DataFrame:
    """Adds the array column ``out``: those of the column ``keys`` that are in ``listed(key)``.

    ``rows`` is stored once, as the universe and for each pass.
    """
    rows = stored(rows, "url-rows")
    universe = rows.select(F.explode("keys").alias("key")).distinct().select("key", F.lit(False).alias("listed"))
    both = stored(
        universe.union(listed.select("key", F.lit(True).alias("listed"))).groupBy("key").agg(F.max("listed").alias("listed")),
        "url-universe")
    size = both.where("listed").count()
    rows = rows.withColumn(out, F.expr("filter(keys, k -> false)"))
    first = max(1, math.ceil(2 * BITS_PER_KEY * size / MAX_BITS))
    shards, done = [(first, r) for r in range(first)], 0
    while shards:
        # Keys whose hash leaves rest r; a shard with a level too large (also of false positives) is halved.
        parts, rest = shards.pop()
        own = f"pmod(xxhash64({{}}, 77), {parts}) = {rest}"
        try:
            cascade = build_cascade(both.where(own.format("key")) if parts > 1 else both, seed=100 * (done + 1))
        except TooManyKeys:
            shards += [(2 * parts, rest), (2 * parts, rest + parts)]
            continue
        done += 1
        names = cascade.columns("f")
        hit = f"{own.format('k')} and {cascade.test('f')}" if parts > 1 else cascade.test("f")
        rows = rows.select("*", *[c.alias(k) for k, c in names.items()])
        rows = rows.withColumn(out, F.expr(f"concat({out}, filter(keys, k -> {hit}))")).drop(*names)
        if shards:
            rows = stored(rows, "url-rows")
    return rows


def _longest(rules: str) -> Column:
    return F.expr(f"array_max(transform({rules}, k -> named_struct('n', length(k), 'k', k))).k")


def judge_urls(pages: DataFrame, rules: list[Rule], blocked_hosts: DataFrame | None = None) -> DataFrame:
    """One row per page: ``page_id, host, path, rule, verdict``.

    The longest rule key that fits decides; a key in both lists is blocked.
    Without a rule, a page is blocked if its host is one of
    ``blocked_hosts(key)``, else allowed.

    Defined cases: a null url or one without ``://`` has empty host and path,
    fits no rule and is allowed; repeated rows are judged once each; null
    page_ids are carried; empty tables and empty rule lists are fine. Other
    columns are ignored.
    """
    if any("/" != r.path[:1] or "/" in r.host or not r.host for r in rules):
        raise ValueError("a rule needs a host and a path that begins with /")
    spark = pages.sparkSession
    rows = pick(pages, page_id="long", url="string")
    host, path = url_parts(F.col("url"))
    rows = rows.select("page_id", host.alias("host"), path.alias("path"))
    rows = rows.withColumn("keys", candidate_keys([(r.host.count(".") + 1, len(r.path)) for r in rules]))
    for verdict in ("allow", "block"):
        listed = spark.createDataFrame([(r.key,) for r in rules if r.verdict == verdict], "key string").distinct()
        if verdict == "block" and blocked_hosts is not None:
            listed = listed.union(blocked_hosts.select(F.col("key").cast("string"))).distinct()
        rows = listed_in(rows, listed, verdict)
    is_rule = "contains(k, '/')"
    return (
        rows.withColumn("a", _longest(f"filter(allow, k -> {is_rule})")).withColumn("b", _longest(f"filter(block, k -> {is_rule})"))
        .select("page_id", "host", "path", F.expr("if(b is null or (a is not null and (length(a) > length(b) or length(a) = length(b) and a > b)), a, b)").alias("rule"),
                F.expr("exists(block, k -> not contains(k, '/'))").alias("bad_host"), "b")
        .select("page_id", "host", "path", "rule",
                F.expr("case when rule is null then if(bad_host, 'block', 'allow') when rule = b then 'block' else 'allow' end").alias("verdict"))
    )


def mostly_blocked_hosts(pages: DataFrame, rules: list[Rule]) -> DataFrame:
    """``key``: hosts more of whose pages the rules block than allow."""
    host, path = url_parts(F.col("url"))
    rows = pick(pages, url="string").select(host.alias("host"), path.alias("path"))
    verdict = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.key), r.key)):
        fits = (F.concat(F.lit("."), "host").endswith("." + r.host)) & F.col("path").startswith(r.path)
        verdict = F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    vote = F.when(F.col("v") == "block", 1).when(F.col("v") == "allow", -1)
    return (
        rows.select("host", verdict.alias("v")).where("v is not null and host <> ''")
        .groupBy(F.col("host").alias("key")).agg(F.sum(vote).alias("s")).where("s > 0").select("key")
    )
