"""Month, year and state rollups, table sizes and months present.

Distinct counts are exact (``count(DISTINCT ...)``): Catalyst plans them as
a two-level aggregate whose first level groups by (group, key), so a hot
month is spread over reducers by the key hash as well.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MONTH = "data_version"


def year_of(month_col: str = MONTH) -> Column:
    """``LEFT(data_version, 4)``."""
    return F.substring(F.col(month_col), 1, 4)


def month_filter(month: str, month_col: str = MONTH) -> Column:
    """one month (prunes partitions when ``month_col`` is the partition column)."""
    return F.col(month_col) == F.lit(month)


def year_filter(year: str, month_col: str = MONTH) -> Column:
    """F2 as a range on the month text, so partition pruning applies."""
    return (F.col(month_col) >= F.lit(f"{year}-01")) & (F.col(month_col) <= F.lit(f"{year}-12"))


def _distinct(key: str, approximate: bool, rsd: float) -> Column:
    """Exact distinct count, or HyperLogLog++ (``approx_count_distinct``) when
    ``approximate``: one fixed-size sketch per group instead of a shuffle of
    every (group, key) pair."""
    return F.approx_count_distinct(key, rsd) if approximate else F.countDistinct(key)


def distinct_per_month(df: DataFrame, key: str, month_col: str = MONTH,
                       out: str = "distinct_companies", approximate: bool = False,
                       rsd: float = 0.01) -> DataFrame:
    """Distinct keys per month."""
    return df.groupBy(F.col(month_col)).agg(_distinct(key, approximate, rsd).alias(out))


def distinct_per_year_month(df: DataFrame, key: str, month_col: str = MONTH,
                            year: str | None = None, out: str = "distinct_companies",
                            approximate: bool = False, rsd: float = 0.01) -> DataFrame:
    """Distinct keys at (year, month) grain; optional F2 year filter."""
    if year is not None:
        df = df.where(year_filter(year, month_col))
    return df.groupBy(year_of(month_col).alias("year"), F.col(month_col)).agg(
        _distinct(key, approximate, rsd).alias(out)
    )


def distinct_per_year(df: DataFrame, key: str, month_col: str = MONTH,
                      out: str = "distinct_companies", approximate: bool = False,
                      rsd: float = 0.01) -> DataFrame:
    """A10: distinct keys per year; a key seen in several months counts once."""
    return df.groupBy(year_of(month_col).alias("year")).agg(
        _distinct(key, approximate, rsd).alias(out))


def month_slice_top(df: DataFrame, month: str, order: Sequence[str], n: int = 100,
                    month_col: str = MONTH) -> DataFrame:
    """F1 + O1: one month ordered by ``order`` (nulls last), first ``n`` rows.

    Planned as TakeOrderedAndProject: each task keeps its own top n, so the
    driver merges at most n rows per task, never the whole month.
    """
    return (
        df.where(month_filter(month, month_col))
        .orderBy(*[F.col(c).asc_nulls_last() for c in order])
        .limit(n)
    )


def state_rollup(df: DataFrame, state: str, key: str, score: str) -> DataFrame:
    """Rows, distinct keys and mean score per state.

    The mean is ``sum / count`` of the non-NULL scores as a double.
    """
    return df.groupBy(F.col(state)).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.countDistinct(key).alias("n_companies"),
        (F.sum(F.col(score)).cast("double") / F.count(F.col(score)).cast("double")).alias("mean_quality"),
    )


def table_sizes(tables: Mapping[str, DataFrame], name_col: str = "tabela",
                total_col: str = "total") -> DataFrame:
    """U1 + O3: one (name, row count) row per table, biggest first, then name.

    Every count is a separate aggregate over its own scan; the union holds one
    row per table.
    """
    parts = [
        df.agg(F.count(F.lit(1)).alias(total_col)).select(F.lit(name).alias(name_col), total_col)
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionAll, parts).orderBy(F.desc(total_col), F.asc(name_col))


def months_present(frames: Sequence[DataFrame], month_col: str = MONTH) -> DataFrame:
    """Distinct months over several tables (each deduplicated before the union)."""
    parts = [df.select(F.col(month_col).alias(MONTH)).distinct() for df in frames]
    return reduce(DataFrame.unionAll, parts).distinct()
