"""One preferred row per key group (top-1 per group) and deterministic dedup.

Both are ``row_number() = 1`` over a window. Catalyst turns the filter into
a partial ``WindowGroupLimit`` that keeps one row per key in every input
partition *before* the shuffle, so a hot key (say a third of all rows)
reaches the reducer as at most one row per map task. Ties are broken by all
remaining columns, so the kept row is the same on every run (unlike
``dropDuplicates``, which keeps an arbitrary one).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

RANK_COL, HASH_COL = "__rn", "__key_hash"


def _orderable(dt: T.DataType) -> bool:
    if isinstance(dt, (T.MapType, T.VariantType)):
        return False
    if isinstance(dt, T.ArrayType):
        return _orderable(dt.elementType)
    if isinstance(dt, T.StructType):
        return all(_orderable(f.dataType) for f in dt.fields)
    return True


def tie_break(df: DataFrame, exclude: Sequence[str] = ()) -> list[Column]:
    """Ascending, nulls-last order over every orderable column not excluded."""
    skip = set(exclude)
    return [
        F.col(f.name).asc_nulls_last()
        for f in df.schema.fields
        if f.name not in skip and _orderable(f.dataType)
    ]


def ranked(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column | str],
    deterministic: bool = True,
    rank_col: str = RANK_COL,
) -> DataFrame:
    """Add ``rank_col`` = row_number over ``keys`` ordered by ``order``.

    A plain column name in ``order`` means ascending, nulls last.
    """
    named = [o for o in order if isinstance(o, str)]
    full = [F.col(o).asc_nulls_last() if isinstance(o, str) else o for o in order]
    if deterministic:
        full += tie_break(df, exclude=[*keys, *named])
    w = Window.partitionBy(*[F.col(k) for k in keys]).orderBy(*full)
    return df.withColumn(rank_col, F.row_number().over(w))


def preferred_row(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column | str],
    deterministic: bool = True,
) -> DataFrame:
    """First row of each ``keys`` group by ``order`` (then all columns)."""
    return ranked(df, keys, order, deterministic).where(F.col(RANK_COL) == 1).drop(RANK_COL)


def dedup(df: DataFrame, keys: Sequence[str], deterministic: bool = True) -> DataFrame:
    """One row per key. Deterministic: the smallest row by all other columns.

    The sort compares other columns only among rows of one key, so nearly
    unique keys cost no more than the keys. ``deterministic=False`` uses
    ``dropDuplicates`` (hash aggregate, any row). A key that is not a column raises.
    """
    unknown = [k for k in keys if k not in df.columns]
    if unknown:
        raise ValueError(f"deduplication keys {unknown} are not among the columns {df.columns}")
    if not keys:
        return df
    if not deterministic:
        return df.dropDuplicates(list(keys))
    # Sorted by one number first: whole keys are compared only where it is equal.
    hashed = df.withColumn(HASH_COL, F.xxhash64(*[F.col(k) for k in keys]))
    order = tie_break(df, exclude=keys)
    return preferred_row(hashed, [HASH_COL, *keys], order or [F.lit(0)], deterministic=False).drop(HASH_COL)


def flag_first(col: Column | str, value: str) -> Column:
    """Sort key putting rows whose ``col`` equals ``value`` first (0) else 1."""
    c = F.col(col) if isinstance(col, str) else col
    return F.when(c == F.lit(value), F.lit(0)).otherwise(F.lit(1))
