"""Left lookups of descriptions in code lists, and key-aligned attaches.

A lookup is a plain LEFT JOIN on a slim projection of the code list. Building
it starts no job: Catalyst broadcasts the list when its pruned size is under
``spark.sql.autoBroadcastJoinThreshold`` bytes, adaptive execution does so from
the measured size, and beyond that both sides shuffle on the code, where a hot
code is split by the skew-join rule. A NULL or
unmatched code keeps the fact row with NULL descriptions.
"""

from __future__ import annotations

import itertools
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_tags = itertools.count()


def lookup(
    fact: DataFrame,
    dim: DataFrame,
    on: Mapping[str, str] | Sequence[tuple[str, str]],
    columns: Mapping[str, str],
) -> DataFrame:
    """``fact LEFT JOIN dim ON fact[f] = dim[d] ...``, adding ``dim`` columns.

    on:       fact column -> dim column (all pairs ANDed).
    columns:  dim column -> output name.
    ``dim`` must be unique on its key columns (code lists are deduplicated
    by the silver layer), otherwise fact rows multiply.
    """
    pairs = list(on.items()) if isinstance(on, Mapping) else list(on)
    tag = f"__lk{next(_tags)}_"
    needed = {d for _, d in pairs} | set(columns)
    slim = dim.select([F.col(d).alias(tag + d) for d in sorted(needed)])
    cond = None
    for f, d in pairs:
        c = fact[f] == slim[tag + d]
        cond = c if cond is None else cond & c
    joined = fact.join(slim, cond, "left")
    return joined.select(
        *[fact[c] for c in fact.columns],
        *[F.col(tag + d).alias(out) for d, out in columns.items()],
    )


def attach(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Equi-join on same-named ``keys`` (USING form: one copy of each key)."""
    return left.join(right, list(keys), how)
