"""Audit of a filter chain: what every filter removes in every order, with exact duplicates found after a Bloom prepass.

Pass one hashes every text into a counting Bloom sketch (two-bit cells that stop
at two). Each task sends its own cells in blocks, blocks are merged by Spark, and
the merged sketch, bounded by ``MAX_CELLS``, goes to every task of pass two. A text
with a cell that was counted once stands nowhere else: it is cleared without
leaving its task. Only the other texts are shuffled, whole, for the exact
smallest id of each text, with a partial aggregate that collapses hot copies.

Every document then is a mask of the filters it fails. Which filter removes a
document in which order depends on its mask alone, so counts by (part, mask,
labels) are joined with the fixed table of orders and added up.
"""

from __future__ import annotations

import hashlib
import itertools
import math
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pick, stored

FILTERS = "ABCDE"
BLOCK_BITS = 14  # cells of one block: a merge step holds one block at a time
# The sketch has 4 to 8 cells a text up to this bound (2 bits a cell: 64 MB). With
# more texts fewer are cleared by it and more are shuffled; results stay exact.
MAX_CELLS = 1 << 28
HASHES = 2
_UPPER = re.compile(rb"[^A-Z]+")
_MARKS = re.compile(rb"[#$%&*|]")


def text_hash(text: bytes) -> bytes:
    return hashlib.blake2b(text, digest_size=16).digest()


def text_cells(digest: bytes, cells: int) -> list[int]:
    """The text's cells: ``HASHES`` different ones of a power-of-two count."""
    a, b = int.from_bytes(digest[:8], "little"), int.from_bytes(digest[8:], "little")
    return [a & (cells - 1), (a ^ (1 + b % (cells - 1))) & (cells - 1)]


def failed_filters(text: bytes, n_chars: int) -> int:
    """Bits of A to D that the text fails (A is bit 0)."""
    words = text.split()
    return ((len(words) < 100)
            | (100 * len(set(words)) < 80 * len(words)) << 1
            | (100 * len(_UPPER.sub(b"", text)) > 10 * n_chars) << 2
            | (_MARKS.search(text) is not None) << 3)


def _texts(batch):
    column = pc.fill_null(batch.column("text"), "")
    return column.cast(pa.binary()).to_pylist(), pc.utf8_length(column).to_pylist()


def sketch_cells(rows: int, limit: int | None = None) -> int:
    return min(limit or MAX_CELLS, 1 << max(BLOCK_BITS, math.ceil(math.log2(4 * max(rows, 1)))))


def counting_sketch(texts: DataFrame, cells: int) -> np.ndarray:
    """Merged sketch of ``texts(text)``: ``cells`` counters of 0, 1 or 2 (two and more)."""
    size = 1 << BLOCK_BITS

    def partial(batches):
        found: list[int] = []

        def blocks():
            at = np.sort(np.array(found, np.int64))
            cuts = np.flatnonzero(np.diff(at >> BLOCK_BITS, prepend=-1))
            names = at[cuts] >> BLOCK_BITS
            parts = np.split((at & (size - 1)).astype("<u2"), cuts[1:])
            found.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(names), pa.array([p.tobytes() for p in parts], pa.binary())], ["block", "cells"])

        for batch in batches:
            for text in _texts(batch)[0]:
                found += text_cells(text_hash(text), cells)
            if len(found) > 1 << 20:
                yield blocks()
        if found:
            yield blocks()

    def merged(batches):
        block, count = None, np.zeros(size, np.uint8)

        def packed():
            four = count.reshape(-1, 4)
            bits = four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6
            return pa.RecordBatch.from_arrays([pa.array([block]), pa.array([bits.tobytes()], pa.binary())], ["block", "cells"])

        for batch in batches:
            for name, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if name != block:
                    if block is not None:
                        yield packed()
                    block = name
                    count[:] = 0
                count = np.minimum(count + np.minimum(np.bincount(np.frombuffer(part, "<u2"), minlength=size), 2), 2).astype(np.uint8)
        if block is not None:
            yield packed()

    schema = "block long, cells binary"
    rows = texts.mapInArrow(partial, schema).repartition("block").sortWithinPartitions("block").mapInArrow(merged, schema)
    sketch = np.zeros((cells >> BLOCK_BITS, size // 4), np.uint8)
    for row in rows.toLocalIterator():
        sketch[row.block] = np.frombuffer(row.cells, np.uint8)
    return sketch.ravel()


def seen_once(sketch: np.ndarray, digest: bytes, cells: int) -> bool:
    """Is some cell of the text counted once only? Then no other text row has this text."""
    return any((sketch[c >> 2] >> 2 * (c & 3)) & 3 == 1 for c in text_cells(digest, cells))


def document_flags(docs: DataFrame, max_cells: int | None = None) -> DataFrame:
    """``doc_id, part, mask``: the filters each document fails, as bits A = 1 to E = 16."""
    rows = pick(docs, doc_id="long", text="string", lang="string")
    cells = sketch_cells(rows.count(), max_cells)
    sketch = counting_sketch(rows.select("text"), cells)
    bits = len(FILTERS) - 1

    def judge(batches):
        for batch in batches:
            texts, lengths = _texts(batch)
            digests = [text_hash(t) for t in texts]
            maybe = [not seen_once(sketch, d, cells) for d in digests]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pc.fill_null(batch.column("lang"), ""),
                pa.array([failed_filters(t, n) for t, n in zip(texts, lengths)], pa.int32()),
                pa.array([d if m else None for d, m in zip(digests, maybe)], pa.binary()),
                pa.array([t if m else None for t, m in zip(texts, maybe)], pa.binary()).cast(pa.string()),
            ], ["doc_id", "part", "mask", "digest", "text"])

    flags = stored(rows.mapInArrow(judge, "doc_id long, part string, mask int, digest binary, text string"), "filter-flags")
    maybe = flags.where("digest IS NOT NULL")
    # The whole text decides; its digest only leads the smallest id back to the rows.
    first = maybe.groupBy("text", "digest").agg(F.min("doc_id").alias("doc_id"))
    first = first.where("doc_id IS NOT NULL").select("doc_id", "digest", F.lit(True).alias("is_first")).distinct()
    later = maybe.select("doc_id", "part", "mask", "digest").join(first, ["doc_id", "digest"], "left").select(
        "doc_id", "part", F.when(F.col("is_first") | F.col("doc_id").isNull(), F.col("mask"))
        .otherwise(F.col("mask").bitwiseOR(F.lit(1 << bits))).alias("mask"))
    return flags.where("digest IS NULL").select("doc_id", "part", "mask").unionAll(later)


def order_table(spark, filters: str = FILTERS) -> DataFrame:
    """What happens to a document of each mask at each step of each order: a fixed table (120 x 5 x 32 rows).

    ``turns`` is the number of orders in which the step's filter is the one that removes the mask.
    """
    rows = []
    for order in itertools.permutations(range(len(filters))):
        name = "".join(filters[f] for f in order)
        for mask in range(1 << len(filters)):
            gone = next((i for i, f in enumerate(order) if mask >> f & 1), len(order))
            for i, f in enumerate(order):
                fails = mask >> f & 1
                turns = math.factorial(len(filters)) // mask.bit_count() if fails else 0
                rows.append((name, i + 1, mask, int(gone > i), int(gone == i), int(bool(fails) and gone < i), int(mask == 1 << f), turns))
    schema = "filter_order string, step int, mask int, keeps int, removes int, repeats int, alone int, turns int"
    return spark.createDataFrame(rows, schema)


def audit_filters(docs: DataFrame, labels: DataFrame, max_cells: int | None = None) -> DataFrame:
    """One row per part, order of the five filters and step, with the counts of the contract.

    ``part, filter_order, step`` and ``kept, removed, redundant, unique_fails,
    good_lost, toxic_lost, shapley`` (all long).

    Defined cases: a null text is the empty text (so two of them are copies); a
    null or empty lang is the part ``''``; a null doc_id is never a copy of a
    smaller one and has no labels; rows that repeat the smallest id of their text
    are all first; a document with several label rows is good (toxic) when one of
    them says so; labels without a document count nowhere; no documents give no
    rows. Other columns are ignored, also ones called ``part`` or ``mask``.
    """
    marks = pick(labels, doc_id="long", quality="int", toxic="int").where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.max(F.expr("quality <=> 1")).alias("good"), F.max(F.expr("toxic <=> 1")).alias("toxic"))
    masks = document_flags(docs, max_cells).join(marks, "doc_id", "left").groupBy("part", "mask").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("good").alias("n_good"), F.count_if("toxic").alias("n_toxic"))
    rows = stored(masks, "mask-counts").join(order_table(docs.sparkSession), "mask")
    def total(sign, n):
        return F.sum(F.col(sign) * F.col(n))

    return rows.groupBy("part", "filter_order", "step").agg(
        total("keeps", "n").alias("kept"), total("removes", "n").alias("removed"), total("repeats", "n").alias("redundant"),
        total("alone", "n").alias("unique_fails"), total("removes", "n_good").alias("good_lost"),
        total("removes", "n_toxic").alias("toxic_lost"), total("turns", "n").alias("shapley"))
