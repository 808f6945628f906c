"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regspark.session import scratch_path

U64 = np.uint64


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named input columns, each cast to the given type (``""`` keeps it).

    Columns are taken by position of their exact name, so extra columns of any
    name, also ones that differ in case only or repeat a name, cannot clash.
    """
    names = df.columns
    plain = df.toDF(*[f"_c{i}" for i in range(len(names))])
    out = []
    for name, kind in columns.items():
        if name not in names:
            raise ValueError(f"input has no column {name!r}; it has {names}")
        col = F.col(f"_c{names.index(name)}")
        out.append((col.cast(kind) if kind else col).alias(name))
    return plain.select(*out)


def map_rows(df: DataFrame, fn) -> DataFrame:
    """All columns of ``df`` as Arrow batches through ``fn``, which gives back the same columns.

    Columns go by position, so names may repeat or differ in case only.
    """
    plain = df.toDF(*[f"_c{i}" for i in range(len(df.columns))])
    return plain.mapInArrow(fn, plain.schema).toDF(*df.columns)


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df`` written to the shared scratch folder and read back.

    Cuts the lineage: a lost executor costs a read of the files, not a rerun.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def mix64(x: np.ndarray) -> np.ndarray:
    """SplitMix64 finaliser, elementwise on uint64 (wraps around)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def lower_ascii(col: Column) -> Column:
    """A-Z to a-z; every other character stays."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def process_cache(key: str, make):
    """``make()`` once per Python worker process, kept between its tasks."""
    import sys
    import types

    store = sys.modules.setdefault("regspark_worker_cache", types.ModuleType("regspark_worker_cache")).__dict__
    if key not in store:
        store[key] = make()
    return store[key]


def process_slot(slot: str, key: str, make):
    """Like :func:`process_cache`, but a process keeps only the latest key of a slot."""
    held = process_cache(slot, lambda: (None, None))
    if held[0] != key:
        import sys

        store = sys.modules["regspark_worker_cache"].__dict__
        store[slot] = held = None  # the old one goes before the new one is made
        store[slot] = held = (key, make())
    return held[1]
