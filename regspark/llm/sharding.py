"""Reproducible shuffle into shards: a Feistel permutation of global row numbers.

The slim rows (id, size, checksum) are range-partitioned and sorted by id, so a
row's global number is its partition's offset plus its place there; texts are
never shuffled. Number n is split into (l, r) with a * b >= N cells and passed
through a Feistel network whose rounds add a keyed function of one half to the
other, modulo its size; a result outside 0..N-1 walks on along its cycle until
it falls inside. That is a permutation p of the row numbers: shard is p mod
shards, slot is p div shards, so counts differ by at most one and any row's
place can be computed from its number alone.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import pick, stored

ROUNDS = 8
_PRIME = 2147483647
_FACTOR = 1103515245
_FACTOR2 = 48271
MAX_WALK = 40


def grid(n: int) -> tuple[int, int]:
    """The two half sizes: a * b >= n with at most about sqrt(n) cells too many."""
    a = max(1, math.isqrt(max(0, n - 1)) + 1)
    return a, max(1, -(-n // a))


def round_key(seed: int, i: int) -> int:
    return (seed * 7919 + i * 104729 + 12345) % _PRIME


def feistel(column: str, n: int, seed: int) -> Column:
    """The permuted row number, as a column expression (see ``feistel_int`` for the plain form).

    A walk leaves at most ``a * b - n`` cells outside; it is followed for up to
    ``MAX_WALK`` steps, which all rows need with odds below 1e-60, else the job fails.
    """
    a, b = grid(n)
    walk = min(a * b - n, MAX_WALK)
    keys = ", ".join(f"{round_key(seed, i)}L" for i in range(ROUNDS))

    def mixed(x: str) -> str:
        first = f"((({x} + k.k) % {_PRIME}L) * {_FACTOR}L % {_PRIME}L)"
        return f"(({first} ^ shiftright({first}, 13)) * {_FACTOR2}L % {_PRIME}L)"

    once = (
        f"aggregate(transform(array({keys}), (k, i) -> named_struct('k', k, 'i', i)), "
        f"named_struct('l', x div {b}L, 'r', x % {b}L), (s, k) -> if(k.i % 2 = 0, "
        f"named_struct('l', (s.l + {mixed('s.r')}) % {a}L, 'r', s.r), "
        f"named_struct('l', s.l, 'r', (s.r + {mixed('s.l')}) % {b}L)), s -> s.l * {b}L + s.r)"
    )
    done = f"aggregate(sequence(0, {walk}), {column}, (x, step) -> if(step = 0 or x >= {n}L, {once}, x))"
    return F.expr(f"aggregate(array({done}), 0L, (z, x) -> if(x < {n}L, x, cast(raise_error('cycle walk did not end') as bigint)))")


def feistel_int(x: int, n: int, seed: int) -> int:
    """The same permutation on plain integers."""
    a, b = grid(n)
    while True:
        l, r = divmod(x, b)
        for i in range(ROUNDS):
            t = ((r if i % 2 == 0 else l) + round_key(seed, i)) % _PRIME * _FACTOR % _PRIME
            t = (t ^ t >> 13) * _FACTOR2 % _PRIME
            if i % 2 == 0:
                l = (l + t) % a
            else:
                r = (r + t) % b
        x = l * b + r
        if x < n:
            return x


def shard_rows(docs: DataFrame, shards: int = 8, seed: int = 1) -> DataFrame:
    """One row per document: ``doc_id, size, text_crc32, law, shard, slot, grown_shard, position``.

    Law ``rows``: shard counts are at most one apart. Rows are numbered by
    (doc_id, text_crc32, size), so the result does not depend on files or
    partitions; rows equal in all three are interchangeable.

    Defined cases: a null text has size 1 and the checksum of no bytes; null
    doc_ids come first; repeated rows each get their own slot; an empty table
    gives no rows. ``grown_shard`` is null (it belongs to the law ``key``).
    Other columns are ignored.
    """
    rows = pick(docs, doc_id="long", text="string")
    slim = rows.select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"))
    order = ["doc_id", "text_crc32", "size"]
    placed = stored(
        slim.repartitionByRange(*order).sortWithinPartitions(*order)
        .select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("place")), "shard-order")
    counts = placed.groupBy("part").agg(F.count("*").alias("n"))
    n = int(counts.agg(F.sum("n")).first()[0] or 0)
    # one row per partition of the sort: no more than spark.sql.shuffle.partitions
    offsets = counts.selectExpr("part", "coalesce(sum(n) over (order by part rows between unbounded preceding and 1 preceding), 0) AS base")
    number = F.col("base") + F.col("place").bitwiseAND(F.lit((1 << 33) - 1))  # low bits: place in the partition
    return (
        placed.join(F.broadcast(offsets), "part").select(*order, number.alias("number"))
        .withColumn("position", feistel("number", max(n, 1), seed))
        .select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"),
                (F.col("position") % shards).cast("int").alias("shard"),
                F.expr(f"position div {shards}").alias("slot"),
                F.lit(None).cast("int").alias("grown_shard"), "position")
    )
