"""Near-duplicate vectors by cosine: PCA-ordered tiled comparison with early stopping.

Equal vectors of a label collapse to one representative with a count. The
principal axes of all unit vectors are found from second moments summed by
Spark. Representatives are range-partitioned by label and first axis and cut
into tiles of bounded size; a tile keeps the bounding box of its leading
coordinates. Two tiles whose boxes are farther apart than the threshold allows
are never paired. In a pair, dot products are accumulated over the leading
axes first; by Cauchy-Schwarz the rest adds at most the product of the suffix
norms, so a pair is dropped as soon as partial sum plus bound is below the
threshold. What is left is confirmed by the full cosine in double precision.
A tile pair returns each vector's link count and a spanning forest of its
links, so its output grows with its vectors and not with its pairs.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pick, stored
from .components import connected_components, local_roots

TILE = 1024
BOX = 8
MAX_PCA_DIM = 1024
_VALID = ("embedding is not null and label is not null and vec_id is not null "
          "and forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('infinity')) "
          "and exists(embedding, x -> x <> 0)")


def unit_rows(rows) -> np.ndarray:
    """Stacked vectors scaled to length one; scaling by the largest entry first avoids overflow."""
    x = np.stack([np.asarray(r, np.float64) for r in rows])
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _moments(batches):
    total = None
    for pdf in batches:
        if len(pdf):
            x = unit_rows(pdf.embedding)
            total = x.T @ x if total is None else total + x.T @ x
    if total is not None:
        yield pd.DataFrame({"i": np.arange(len(total)), "row": list(total)})


def principal_axes(vectors: DataFrame, dim: int) -> np.ndarray:
    """Columns: the axes of most to least second moment, from all vectors of this length.

    Only ``dim * dim`` sums reach the driver. Above ``MAX_PCA_DIM`` the plain
    axes are used: any orthogonal basis gives the same, exact result.
    """
    if dim > MAX_PCA_DIM:
        return np.eye(dim)
    sums = (
        vectors.where(F.size("embedding") == dim).select("embedding").mapInPandas(_moments, "i int, row array<double>")
        .select("i", F.posexplode("row").alias("j", "v")).groupBy("i", "j").agg(F.sum("v").alias("v")).toPandas()
    )
    second = np.zeros((dim, dim))
    second[sums.i, sums.j] = sums.v
    return np.linalg.eigh((second + second.T) / 2)[1][:, ::-1].copy()


def _first_axis(axes: dict[int, np.ndarray]):
    def run(batches):
        for pdf in batches:
            at = np.zeros(len(pdf))
            size = pdf.embedding.map(len).to_numpy()
            for dim in np.unique(size):
                rows = np.flatnonzero(size == dim)
                x = unit_rows(pdf.embedding.iloc[rows])
                at[rows] = x @ axes[dim][:, 0] if dim in axes else x[:, 0]
            yield pdf.assign(dim=size, at=at)
    return run


def _cut_tiles(axes: dict[int, np.ndarray], tile: int):
    """Sorted rows of a partition to tiles of one label, at most ``tile`` vectors each."""
    def emit(part: pd.DataFrame, pid: int, k: int) -> dict:
        x = unit_rows(part.embedding)
        lead = (x @ axes[x.shape[1]] if x.shape[1] in axes else x)[:, :BOX]
        return {
            "label": part.label.iloc[0], "dim": x.shape[1], "tile": (pid << 32) | k,
            "lo": lead.min(axis=0).tolist(), "hi": lead.max(axis=0).tolist(),
            "ids": part.id.to_numpy("<i8").tobytes(), "copies": part.copies.to_numpy("<i8").tobytes(),
            "raw": np.stack([np.asarray(r, "<f8") for r in part.embedding]).tobytes(),
        }

    def run(batches):
        from pyspark import TaskContext

        pid, k, held = TaskContext.get().partitionId(), 0, None
        for pdf in batches:
            held = pdf if held is None or not len(held) else pd.concat([held, pdf], ignore_index=True)
            out = []
            while len(held):
                same = (held.label == held.label.iloc[0]) & (held.dim == held.dim.iloc[0])
                n = len(held) if same.all() else int((~same).to_numpy().argmax())
                if n < tile and n == len(held):
                    break
                out.append(emit(held.iloc[: min(n, tile)], pid, k))
                held, k = held.iloc[min(n, tile):], k + 1
            if out:
                yield pd.DataFrame(out)
        if held is not None and len(held):
            yield pd.DataFrame([emit(held, pid, k)])
    return run


def linked_pairs(x: np.ndarray, y: np.ndarray, axes: np.ndarray | None, threshold: float, same: bool):
    """Index pairs with cosine >= threshold of raw rows ``x`` and ``y`` (``same``: i < j only)."""
    ux, uy = unit_rows(x), unit_rows(y)
    px, py = (ux @ axes, uy @ axes) if axes is not None else (ux, uy)
    d, slack = px.shape[1], 1e-9
    left = lambda p, k: np.sqrt(np.maximum((p[:, k:] ** 2).sum(axis=1), 0))
    k = min(d, 8)
    part = px[:, :k] @ py[:, :k].T
    part += left(px, k)[:, None] * left(py, k)[None, :]
    i, j = np.nonzero(part >= threshold - slack)
    if same:
        i, j = i[i < j], j[i < j]
    out_i, out_j = [], []
    for at in range(0, len(i), 1 << 16):
        a, b = i[at : at + (1 << 16)], j[at : at + (1 << 16)]
        done, acc = 0, np.zeros(len(a))
        while done < d and len(a):
            nxt = min(d, max(8, 2 * done))
            acc = acc + np.einsum("ij,ij->i", px[a, done:nxt], py[b, done:nxt])
            ok = acc + left(px, nxt)[a] * left(py, nxt)[b] >= threshold - slack
            a, b, acc, done = a[ok], b[ok], acc[ok], nxt
        cos = np.einsum("ij,ij->i", ux[a], uy[b])
        out_i.append(a[cos >= threshold])
        out_j.append(b[cos >= threshold])
    none = np.empty(0, np.int64)
    return np.concatenate([none, *out_i]), np.concatenate([none, *out_j])


def _compare(axes: dict[int, np.ndarray], threshold: float):
    def run(batches):
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                same = r.ta == r.tb
                x = np.frombuffer(r.raw_a, "<f8").reshape(-1, r.dim)
                y = np.frombuffer(r.raw_b, "<f8").reshape(-1, r.dim)
                i, j = linked_pairs(x, y, axes.get(r.dim), threshold, same)
                if not len(i):
                    continue
                ia, ib = np.frombuffer(r.ids_a, "<i8"), np.frombuffer(r.ids_b, "<i8")
                ca, cb = np.frombuffer(r.copies_a, "<i8"), np.frombuffer(r.copies_b, "<i8")
                ids = np.concatenate([ia, ib])
                if same:
                    j_at = j
                    ids = ia
                else:
                    j_at = j + len(ia)
                order = np.argsort(ids, kind="stable")
                rank = np.empty(len(ids), np.int64)
                rank[order] = np.arange(len(ids))
                links = np.bincount(i, cb[j], len(ids)) + np.bincount(j_at, ca[i], len(ids))
                root = ids[order][local_roots(len(ids), rank[i], rank[j_at])[rank]]
                on = np.flatnonzero(links)
                yield pd.DataFrame({"id": ids[on], "links": links[on].astype(np.int64), "root": root[on]})
    return run


def embedding_links(vectors: DataFrame, threshold: float = 0.93, tile: int = TILE) -> DataFrame:
    """One row per input row: ``vec_id, n_links, component_id, kept``.

    Vectors of equal label are linked when their cosine is at least
    ``threshold`` (which must be above 0). ``n_links`` counts the other rows
    linked directly, copies included; ``component_id`` is the smallest vec_id
    reachable by links.

    Defined cases: null label, null, zero or empty vectors and vectors with
    null, NaN or infinite entries link with nothing; vectors of different
    length are not compared; a row with a null vec_id links with nothing and
    has a null component and ``kept`` false. Other columns are ignored.
    """
    rows = pick(vectors, vec_id="long", label="string", embedding="array<double>")
    rows = rows.withColumn("embedding", F.when(F.expr(_VALID), F.expr("transform(embedding, x -> x + double(0))")))
    keys = [F.xxhash64("label", "embedding").alias("k1"), F.xxhash64(F.lit(1), "embedding", "label").alias("k2")]
    valid = rows.where("embedding is not null").select("vec_id", "label", "embedding", *keys)
    reps = stored(
        valid.groupBy("label", "k1", "k2", "embedding").agg(F.min("vec_id").alias("id"), F.count("*").alias("copies")),
        "vec-reps")
    dims = [r[0] for r in reps.groupBy(F.size("embedding")).count().orderBy(F.desc("count")).limit(4).collect()]
    axes = {dim: principal_axes(reps, dim) for dim in dims}

    placed = reps.select("id", "copies", "label", "embedding").mapInPandas(
        _first_axis(axes), "id long, copies long, label string, embedding array<double>, dim int, at double")
    tiles = stored(
        placed.repartitionByRange("label", "dim", "at").sortWithinPartitions("label", "dim", "at", "id")
        .mapInPandas(_cut_tiles(axes, tile), "label string, dim int, tile long, lo array<double>, hi array<double>, "
                     "ids binary, copies binary, raw binary"), "vec-tiles")

    box = tiles.select("label", "dim", "tile", "lo", "hi")
    gap = F.expr("aggregate(sequence(1, size(lo_a)), double(0), (s, i) -> s + power(greatest(double(0), "
                 "element_at(lo_a, i) - element_at(hi_b, i), element_at(lo_b, i) - element_at(hi_a, i)), 2))")
    pairs = stored(
        box.toDF("label", "dim", "ta", "lo_a", "hi_a").join(box.toDF("label", "dim", "tb", "lo_b", "hi_b"), ["label", "dim"])
        .where((F.col("ta") <= F.col("tb")) & (gap <= 2 - 2 * threshold + 1e-9)).select("dim", "ta", "tb"), "vec-pairs")
    load = tiles.select("tile", "ids", "copies", "raw")
    found = stored(
        pairs.join(load.toDF("ta", "ids_a", "copies_a", "raw_a"), "ta").join(load.toDF("tb", "ids_b", "copies_b", "raw_b"), "tb")
        .mapInPandas(_compare(axes, threshold), "id long, links long, root long"), "vec-links")

    comp = connected_components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    degree = found.groupBy("id").agg(F.sum("links").alias("links"))
    judged = stored(
        reps.select("k1", "k2", "id", "copies").join(degree, "id", "left")
        .join(comp.withColumnRenamed("node", "id"), "id", "left")
        .select("k1", "k2", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"),
                F.coalesce("component", "id").alias("component")), "vec-judged")
    slim = rows.select("vec_id", *[F.when(F.col("embedding").isNotNull(), k).alias(n) for k, n in zip(keys, ("k1", "k2"))])
    return (
        slim.join(judged, ["k1", "k2"], "left")
        .select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
                F.when(F.col("vec_id").isNotNull(), F.coalesce("component", "vec_id")).alias("component_id"))
        .withColumn("kept", F.coalesce(F.expr("vec_id = component_id"), F.lit(False)))
    )
