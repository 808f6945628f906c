"""Near-duplicate groups of documents: SuperMinHash, banding, verification, union-find.

1. One pass over the texts gives each document's shingle-set size, a 128-bit
   fingerprint of the set and a SuperMinHash signature. Documents with equal
   sets collapse to one representative, so exact copies cost one row a task.
2. Bands of the signature are bucket keys. The smallest id of a bucket is its
   pivot; every (member, pivot) pair is verified on full shingle sets, and the
   links are grouped into components.
3. A bucket whose members beyond the pivot still lie in different components is
   compared completely: members are dealt by set size and hash into tiles of
   bounded weight, tile pairs are compared in numpy, and only links leave the
   task. Pairs that are already connected are skipped, never real links lost.

Nothing is capped: a hot bucket becomes more tiles, not a larger task.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pick, stored
from .components import connected_components
from .shingles import shingle_set, superminhash

TILE_DOCS = 512
TILE_SHINGLES = 1 << 18


def _signatures(width: int, slots: int):
    def run(batches):
        for batch in batches:
            sets = [shingle_set(t.as_py(), width) for t in batch.column(1)]
            sig = superminhash(sets, slots).astype("<u4")
            yield pa.RecordBatch.from_arrays([
                batch.column(0),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([xxhash.xxh3_128_hexdigest(s.tobytes()) if len(s) else None for s in sets], pa.string()),
                pa.array([row.tobytes() for row in sig], pa.binary()),
            ], names=["doc_id", "n", "fp", "sig"])
    return run


def _sets(width: int):
    def run(batches):
        for batch in batches:
            sets = [np.sort(shingle_set(t.as_py(), width).view(np.int64)) for t in batch.column(1)]
            ends = np.cumsum([0, *map(len, sets)])
            values = np.concatenate([np.empty(0, np.int64), *sets])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values))], names=["id", "shingles"])
    return run


class _Forest:
    """A small union-find over arbitrary labels."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def find(self, x: int) -> int:
        while (y := self.up.get(x, x)) != x:
            self.up[x] = self.up.get(y, y)
            x = y
        return x

    def join(self, x: int, y: int) -> None:
        x, y = self.find(x), self.find(y)
        self.up[max(x, y)] = min(x, y)


def _compare_tiles(percent: int, band_rows: int, agree: int):
    """One pair of tiles of a bucket (or one tile with itself): its verified links."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["side", "id"], kind="stable")
        sig = np.stack([np.frombuffer(s, "<u4") for s in pdf.sig])
        sets = list(pdf.shingles)
        size = np.array([len(s) for s in sets])
        side, comp, ids = pdf.side.to_numpy(), pdf.comp.to_numpy(), pdf.id.to_numpy()
        band = int(pdf.band.iloc[0])
        one_tile = bool(pdf.same.iloc[0])
        seen, out = _Forest(), []
        for i in range(len(pdf) if one_tile else int((side == 0).sum())):
            js = np.arange(i + 1, len(pdf)) if one_tile else np.flatnonzero(side == 1)
            low, high = np.minimum(size[i], size[js]), np.maximum(size[i], size[js])
            js = js[(comp[js] != comp[i]) & (100 * low >= percent * high)]
            if not len(js):
                continue
            equal = sig[js] == sig[i]
            ok = equal.sum(axis=1) >= agree
            # a pair that meets in several buckets is compared in its first common band only
            first = equal.reshape(len(js), -1, band_rows).all(axis=2).argmax(axis=1) == band
            js = js[ok & first]
            if not len(js):
                continue
            flat = np.concatenate([sets[j] for j in js])
            at = np.searchsorted(sets[i], flat)
            at[at == len(sets[i])] = 0
            both = np.add.reduceat((sets[i][at] == flat).astype(np.int64), np.cumsum(np.r_[0, size[js][:-1]]))
            for j in js[100 * both >= percent * (size[i] + size[js] - both)]:
                if seen.find(int(comp[i])) != seen.find(int(comp[j])):
                    seen.join(int(comp[i]), int(comp[j]))
                    out.append((ids[i], ids[j]))
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")
    return run


def _tile_pairs(members: DataFrame, percent: int) -> DataFrame:
    """Each member with the list of tile pairs it takes part in.

    Members of a bucket are dealt by set size into bands one ratio wide (a link
    joins equal or neighbouring bands) and by hash into tiles of bounded weight.
    """
    ratio = math.log(100 / percent) * (1 + 1e-9) if percent < 100 else 1e-9  # rounding must not skip a band
    m = members.withColumn("step", F.floor(F.log("n") / F.lit(ratio)).cast("long"))
    tiles = m.groupBy("key", "step").agg(
        F.ceil(F.greatest(F.count("*") / TILE_DOCS, F.sum("n") / TILE_SHINGLES)).cast("int").alias("parts"))
    near = (
        tiles.withColumn("of", F.explode(F.array(F.col("step") - 1, F.col("step"), F.col("step") + 1)))
        .groupBy("key", F.col("of").alias("step"))
        .agg(*[F.max(F.when(F.col("step") == F.col("of") + d, F.col("parts"))).alias(c)
               for d, c in ((-1, "before"), (0, "own"), (1, "after"))])
        .where("own is not null")
    )
    m = m.join(near, ["key", "step"]).withColumn("tile", F.pmod(F.xxhash64("id"), F.col("own")).cast("int"))
    others = "filter(sequence(0, {n} - 1), t -> {n} > 0)"
    pairs = F.expr(f"""
        concat(
          transform(sequence(0, own - 1), t -> named_struct('s1', step, 't1', least(t, tile), 's2', step,
            't2', greatest(t, tile), 'side', if(tile <= t, 0, 1))),
          transform({others.format(n='coalesce(after, 0)')}, t -> named_struct('s1', step, 't1', tile, 's2', step + 1, 't2', t, 'side', 0)),
          transform({others.format(n='coalesce(before, 0)')}, t -> named_struct('s1', step - 1, 't1', t, 's2', step, 't2', tile, 'side', 1)))
    """)
    return m.select("key", "band", "id", "comp", pairs.alias("pairs"))


def minhash_groups(
    docs: DataFrame, width: int = 5, percent: int = 80, band_rows: int = 4, missed: float = 1e-5,
) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept``.

    Two documents are linked when ``100 * |A & B| >= percent * |A | B|`` for
    their sets of distinct ``width``-word shingles; a component is everything
    reachable by links and is named by its smallest doc_id; ``kept`` marks that
    document. There are as many bands of ``band_rows`` slots as it takes to miss
    a link right at the threshold with odds below ``missed`` (16 bands at 0.85,
    22 at 0.80); every candidate is confirmed on full sets.

    Defined cases: a null or wordless text has an empty set and is linked with
    nothing; rows with a null doc_id are linked with nothing, have a null
    component and are kept; rows that repeat a doc_id count as one document.
    An empty table gives an empty result; other columns are ignored.
    """
    bands = max(1, math.ceil(math.log(missed) / math.log(1 - min(0.999, percent / 100) ** band_rows)))
    slots = bands * band_rows
    docs = pick(docs, doc_id="long", text="string")
    sigs = stored(docs.mapInArrow(_signatures(width, slots), "doc_id long, n long, fp string, sig binary"), "minhash-sig")
    reps = stored(
        sigs.where("doc_id is not null and n > 0").groupBy("fp", "n", "sig").agg(F.min("doc_id").alias("id")),
        "minhash-reps")

    members = reps.select(
        "id", "n", F.posexplode(F.expr(f"transform(sequence(0, {bands - 1}), b -> xxhash64(b, substring(sig, b * {4 * band_rows} + 1, {4 * band_rows})))"))
        .alias("band", "key"))
    pivots = members.groupBy("key").agg(F.min("id").alias("pivot"), F.count("*").alias("c")).where("c > 1").drop("c")
    hot = stored(members.join(pivots, "key"), "minhash-buckets")

    # merged, never broadcast: the list of ids grows with the corpus
    wanted = hot.select(F.col("id").alias("doc_id")).distinct()
    sets = stored(
        docs.where("doc_id is not null").join(wanted.hint("merge"), "doc_id", "left_semi").mapInArrow(_sets(width), "id long, shingles array<bigint>")
        .where("size(shingles) > 0"), "minhash-sets")

    first = hot.where("id <> pivot").select(F.col("id").alias("a"), F.col("pivot").alias("b")).distinct()
    both = first.join(sets.toDF("a", "sa"), "a").join(sets.toDF("b", "sb"), "b").withColumn("both", F.size(F.array_intersect("sa", "sb")))
    linked = both.where(F.expr(f"100 * both >= {percent} * (size(sa) + size(sb) - both)")).select("a", "b")
    grouped = stored(connected_components(stored(linked, "minhash-links")), "minhash-first")

    left = (
        hot.where("id <> pivot").join(grouped.withColumnRenamed("node", "id"), "id", "left")
        .select("key", "band", "id", "n", F.coalesce("component", "id").alias("comp"))
    )
    left = stored(left, "minhash-left")
    mixed = left.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("key")
    pairs = _tile_pairs(stored(left.join(mixed, "key"), "minhash-mixed"), percent)
    agree = max(band_rows, int(slots * percent / 100 - 5.2 * math.sqrt(slots * percent * (100 - percent)) / 100))
    second = (
        pairs.join(sets, "id").join(reps.select("id", "sig"), "id")
        .select("key", "band", "id", "comp", "sig", "shingles", F.explode("pairs").alias("pair"))
        .select("*", "pair.*", F.expr("pair.s1 = pair.s2 and pair.t1 = pair.t2").alias("same")).drop("pair")
        .groupBy("key", "s1", "t1", "s2", "t2").applyInPandas(_compare_tiles(percent, band_rows, agree), "a long, b long")
    )
    comp = connected_components(stored(grouped.toDF("a", "b").union(second), "minhash-links"))

    named = reps.join(comp.withColumnRenamed("node", "id"), "id", "left").select(
        "fp", F.coalesce("component", "id").alias("found"))
    return (
        sigs.join(named, "fp", "left")
        .select("doc_id", F.col("n").alias("n_shingles"),
                F.when(F.col("doc_id").isNotNull(), F.coalesce("found", "doc_id")).alias("component_id"))
        .withColumn("kept", F.coalesce(F.expr("doc_id = component_id"), F.lit(True)))
    )


def near_duplicates_dropped(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` without all but the smallest doc_id of every group; columns unchanged."""
    gone = minhash_groups(docs, width, percent).where("not kept").select(F.col("doc_id").alias("gone")).distinct()
    plain = docs.toDF(*[f"_c{i}" for i in range(len(docs.columns))])  # by position: names may clash
    key = plain[f"_c{docs.columns.index('doc_id')}"].cast("long")
    return plain.join(gone.hint("merge"), key == gone["gone"], "left_anti").toDF(*docs.columns)
