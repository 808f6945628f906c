"""Months clustered by several columns at once, with an index of their files.

Rows are ordered along a Z-order curve over the given columns (state, town,
activity): each column is cut at its own quantiles into 64 steps, the steps' bits are
interleaved, rows are range-partitioned by that number and sorted in each file. So
every file, and every row group of a file, covers a small range of *each* column,
and a question about any one of them skips most files. Directories can do that for
their first column only.

A file index (one row a file: smallest and largest value of each column, and whether
it holds nulls) is written beside the month; :func:`read_where` opens the files whose
range holds the value, and inside them Parquet's row-group statistics skip further.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regspark.sinks.lake import MONTH, TableNotFound, WriteResult, manifest_of, publish_month, read_table
from regspark.sinks.manifest import Month
from regspark.sources.text import as_pattern

FILE_INDEX = "fileindex"
STEP_BITS = 6
PREFIX_BYTES = 7
ROWS_PER_FILE = 1_000_000


def order_number(column: str) -> Column:
    """A long that grows with the first seven bytes of the column's text; 0 for null."""
    digits = F.rpad(F.substring(F.hex(F.col(column).cast("string").cast("binary")), 1, 2 * PREFIX_BYTES), 2 * PREFIX_BYTES, "0")
    return F.coalesce(F.conv(digits, 16, 10).cast("long"), F.lit(0))


def step_bounds(df: DataFrame, columns: Sequence[str]) -> list[list[int]]:
    """Each column's quantiles, at most 63 different numbers: one aggregate, 63 longs a column reach the driver."""
    shares = [i / (1 << STEP_BITS) for i in range(1, 1 << STEP_BITS)]
    row = df.agg(*[F.percentile_approx(order_number(c), shares).alias(f"q{i}") for i, c in enumerate(columns)]).first()
    return [sorted(set(q or [])) for q in row]


def curve_position(columns: Sequence[str], bounds: Sequence[Sequence[int]]) -> Column:
    """The row's place on the Z-order curve: the columns' steps with their bits interleaved.

    The steps of a column with few values are spread over all 64, so that it
    weighs as much in the leading bits as a column with many.
    """
    out = F.lit(0).cast("long")
    for k, (column, cuts) in enumerate(zip(columns, bounds)):
        number = order_number(column)
        step = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]).cast("array<bigint>"), lambda cut: cut <= number)).cast("long")
        step = F.floor(step * (1 << STEP_BITS) / (len(cuts) + 1)).cast("long")
        for bit in range(STEP_BITS):
            out = out.bitwiseOR(F.shiftleft(F.shiftright(step, bit).bitwiseAND(F.lit(1)), bit * len(columns) + k))
    return out


def clustered(df: DataFrame, columns: Sequence[str], files: int) -> DataFrame:
    """``df`` range-partitioned into ``files`` along the curve and sorted in each.

    A cell of the curve that holds a large part of the rows (one town, one
    activity) is spread over several files by a hash of the whole row.
    """
    place, spread = "__place", "__spread"
    out = df.withColumns({place: curve_position(columns, step_bounds(df, columns)), spread: F.xxhash64(*df.columns)})
    return out.repartitionByRange(files, place, spread).sortWithinPartitions(place, *columns).drop(place, spread)


def publish_clustered(df: DataFrame, root: str, layer: str, dataset: str, month: str, columns: Sequence[str],
                      files: int | None = None) -> WriteResult:
    """K1 + F1: publish a month clustered by ``columns``, then the index of its files.

    ``df`` is read three times (quantiles, range bounds, write), so it should be a
    table. ``files`` defaults to one a million rows. The index names the version
    of the month it describes; until it is published, readers open every file.
    """
    spark = df.sparkSession
    files = files or max(1, -(-df.count() // ROWS_PER_FILE))
    result = publish_month(clustered(df, columns, files), root, layer, dataset, month)
    entry = manifest_of(spark, root, layer, dataset).months[month]
    ranges = [f(c).alias(f"{name}_{c}") for c in columns for name, f in (("min", F.min), ("max", F.max), ("nulls", _nulls))]
    index = spark.read.parquet(result.path).groupBy(F.col("_metadata.file_path").alias("file_path")).agg(*ranges)
    publish_month(index.coalesce(1), root, FILE_INDEX, f"{layer}-{dataset}", month, facts={"of": entry.commit})
    return result


def _nulls(column: str) -> Column:
    return F.coalesce(F.max(F.col(column).isNull()), F.lit(False))


def _indexed(spark: SparkSession, root: str, layer: str, dataset: str, month: str) -> tuple[Month | None, bool]:
    entry = manifest_of(spark, root, layer, dataset).months.get(month)
    index = manifest_of(spark, root, FILE_INDEX, f"{layer}-{dataset}").months.get(month)
    return entry, bool(entry and index and entry.commit and index.metrics.get("of") == entry.commit)


def files_for(spark: SparkSession, root: str, layer: str, dataset: str, month: str, equals: Mapping[str, str | None]) -> list[str] | None:
    """Paths (for a reader, glob signs escaped) of the month's files that may hold rows with these values; None when the month has no current index.

    File names alone reach the driver, as with any listing of a table.
    """
    if not _indexed(spark, root, layer, dataset, month)[1]:
        return None
    index = read_table(spark, root, FILE_INDEX, f"{layer}-{dataset}", month)
    for column, value in equals.items():
        if f"min_{column}" in index.columns:
            held = F.col(f"nulls_{column}") if value is None else F.lit(value).between(F.col(f"min_{column}"), F.col(f"max_{column}"))
            index = index.where(held)
    return [as_pattern(unquote(r[0])) for r in index.select("file_path").collect()]


def read_where(spark: SparkSession, root: str, layer: str, dataset: str, month: str, equals: Mapping[str, str | None]) -> DataFrame:
    """rows of a month whose columns equal the given values (None: are null), from the files that may hold any.

    A month without a current index is read whole; the rows are the same.
    """
    entry, _ = _indexed(spark, root, layer, dataset, month)
    if entry is None:
        raise TableNotFound(f"{month} of {dataset} is not published in {layer}")
    whole, files = read_table(spark, root, layer, dataset, month), files_for(spark, root, layer, dataset, month, equals)
    rows = whole
    if files is not None:
        stored = [f for f in whole.schema.fields if f.name != MONTH]
        rows = (spark.read.schema(type(whole.schema)(stored)).parquet(*files).withColumn(MONTH, F.lit(month)).select(*whole.columns)
                if files else whole.where("false"))
    for column, value in equals.items():
        rows = rows.where(F.col(column).isNull() if value is None else F.col(column) == F.lit(value))
    return rows
