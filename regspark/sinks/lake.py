"""Month-partitioned Parquet tables: publish, replace, drop, read back.

Layout: ``{root}/{layer}/{dataset}/data_version=YYYY-MM/commit=<id>/part-*.parquet``
and one small manifest per table version (:mod:`regspark.sinks.manifest`). A month
is written once into a folder of its own and published by the next manifest when
the write, and any check of its counts, has succeeded: nothing is renamed, a
failing job or gate leaves the table as it was, and a reader sees the old or the
new month. An empty frame gives an empty month (not a stale one). Row counts come
from an ``Observation`` collected during the same write job: no cache and no
second pass. They stay in the manifest, so sizes and months need no scan.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regspark.layouts import MONTH_COLUMNS
from regspark.sinks.manifest import FOLDER, Folder, Month, PublishConflict, TableNotFound, commit, read_manifest

__all__ = ["Folder", "PublishConflict", "TableNotFound", "WriteResult", "append_part", "drop_month", "drop_month_all_layers", "expire_commits",
           "manifest_of", "month_rows", "publish_month", "publish_months", "read_parts", "read_table", "replace_buckets", "stamp_month", "table_path"]

COMMIT, BUCKET = "commit", "bucket"
MONTH = "data_version"
_TYPE_INFERENCE = "spark.sql.sources.partitionColumnTypeInference.enabled"


@dataclass(frozen=True)
class WriteResult:
    path: str
    rows: int
    metrics: dict = field(default_factory=dict)


def table_path(root: str, layer: str, dataset: str) -> str:
    return f"{root.rstrip('/')}/{layer}/{dataset}"


def month_path(root: str, layer: str, dataset: str, month: str) -> str:
    return f"{table_path(root, layer, dataset)}/{MONTH}={month}"


def stamp_month(df: DataFrame, month: str) -> DataFrame:
    """Set (overwrite) ``dataset_month`` and ``data_version`` to ``month``."""
    return df.withColumns({c: F.lit(month) for c in MONTH_COLUMNS})


def _observed(df: DataFrame, name: str, metrics: Mapping[str, Column]) -> tuple[DataFrame, Observation]:
    obs = Observation(f"{name}-{uuid.uuid4().hex}")
    return df.observe(obs, F.count(F.lit(1)).alias("rows"), *[c.alias(k) for k, c in metrics.items()]), obs


def manifest_of(spark: SparkSession, root: str, layer: str, dataset: str):
    """The table's latest manifest: months with their rows, commit and write metrics."""
    return read_manifest(spark, table_path(root, layer, dataset))


def commit_path(root: str, layer: str, dataset: str, month: str, commit_id: str) -> str:
    return f"{month_path(root, layer, dataset, month)}/{COMMIT}={commit_id}"


def publish_month(df: DataFrame, root: str, layer: str, dataset: str, month: str,
                  cluster_by: str | None = None, metrics: Mapping[str, Column] | None = None,
                  check: Callable[[dict], None] | None = None, meanwhile: Callable[[], None] = lambda: None,
                  facts: Mapping[str, str] | None = None) -> WriteResult:
    """K1/K2: replace one month of one dataset in one layer; returns the row count.

    The month columns are stamped first; ``data_version`` lives in the
    directory name, so it is dropped from the files. ``cluster_by`` adds a
    second directory level (e.g. state) below the month: rows are first
    rebalanced on it (AQE merges small and splits skewed groups, so a state
    holding a third of the rows is written by several tasks), and readers
    filtering on it read only their directories. The whole month is replaced.

    ``metrics`` are aggregates over the written rows, gathered by the write
    itself and kept in the manifest, with the given ``facts``; ``check`` gets them, with ``rows``, before
    the month is published and refuses it by raising. Of two publishers of one
    month the second to finish raises ``PublishConflict``; the folder it wrote
    is removed. The replaced folder stays for readers that hold the old version,
    until :func:`expire_commits`.
    """
    spark = df.sparkSession
    base, commit_id = manifest_of(spark, root, layer, dataset), uuid.uuid4().hex
    path = commit_path(root, layer, dataset, month, commit_id)
    stamped = stamp_month(df, month).drop(MONTH)
    if cluster_by:
        stamped = stamped.hint("rebalance", cluster_by)
    stamped, obs = _observed(stamped, f"publish-{layer}-{dataset}-{month}", metrics or {})
    writer = stamped.write.partitionBy(cluster_by) if cluster_by else stamped.write
    try:
        writer.parquet(path)
        got = dict(obs.get)
        if check is not None:
            check(got)
        levels = (cluster_by,) if cluster_by else ()
        entry = Month(commit_id, int(got.get("rows") or 0), stamped.schema.json(), levels,
                      {**{k: v for k, v in got.items() if k != "rows"}, **(facts or {})})
        commit(spark, table_path(root, layer, dataset), base, {month: entry}, meanwhile=meanwhile)
    except BaseException:
        Folder(spark, path).delete()
        raise
    return WriteResult(path, entry.rows, got)


def publish_months(df: DataFrame, root: str, layer: str, dataset: str) -> WriteResult:
    """Write a frame holding several months; only the months present are replaced,
    all of them by the one manifest that follows the one job."""
    spark = df.sparkSession
    path = table_path(root, layer, dataset)
    base, commit_id = manifest_of(spark, root, layer, dataset), uuid.uuid4().hex
    df, obs = _observed(df, f"publish-{layer}-{dataset}", {})
    df.withColumn(COMMIT, F.lit(commit_id)).write.mode("append").partitionBy(MONTH, COMMIT).parquet(path)
    schema = T.StructType([f for f in df.schema.fields if f.name != MONTH])
    months = [n.partition("=")[2] for n in Folder(spark, path).names() if n.startswith(f"{MONTH}=")
              and Folder(spark, f"{path}/{n}/{COMMIT}={commit_id}").exists()]
    try:
        written = _rows_by(spark, path, [commit_path(root, layer, dataset, m, commit_id) for m in months], MONTH)
        entries = {m: Month(commit_id, written[m], schema.json()) for m in months}
        commit(spark, path, base, entries)
    except BaseException:
        for m in months:
            Folder(spark, commit_path(root, layer, dataset, m, commit_id)).delete()
        raise
    return WriteResult(path, int(obs.get.get("rows") or 0))


def _rows_by(spark: SparkSession, path: str, folders: list[str], level: str) -> dict[str, int]:
    """Rows of written folders by one directory level: a count over file footers, no column is read."""
    if not folders:
        return {}
    with _text_levels(spark):
        found = spark.read.option("basePath", path).schema(f"{level} string").parquet(*folders)
    return {r[0]: r[1] for r in found.groupBy(level).count().collect()}


@contextmanager
def _text_levels(spark: SparkSession):
    """Directory levels are read as text, as they were written."""
    inferred = spark.conf.get(_TYPE_INFERENCE)
    spark.conf.set(_TYPE_INFERENCE, "false")
    try:
        yield
    finally:
        spark.conf.set(_TYPE_INFERENCE, inferred)


def append_part(df: DataFrame, root: str, layer: str, dataset: str, month: str, part: str) -> WriteResult:
    """Add one named part to a month; a part of that name that stands already is left as it is (a replay)."""
    spark, base = df.sparkSession, manifest_of(df.sparkSession, root, layer, dataset)
    entry = base.months.get(month)
    if entry is not None and part in entry.parts:
        return WriteResult(f"{month_path(root, layer, dataset, month)}/{entry.parts[part][0]}", entry.parts[part][1], {"replayed": True})
    if entry is not None and not entry.parts:
        raise PublishConflict(f"{month} of {dataset} in {layer} was published whole; drop it before parts are added")
    commit_id = uuid.uuid4().hex
    path = commit_path(root, layer, dataset, month, commit_id)
    stamped, obs = _observed(stamp_month(df, month).drop(MONTH), f"append-{layer}-{dataset}-{month}", {})
    try:
        stamped.write.parquet(path)
        rows = int(obs.get.get("rows") or 0)
        parts = {**(entry.parts if entry else {}), part: [f"{COMMIT}={commit_id}", rows]}
        new = Month("", sum(p[1] for p in parts.values()), stamped.schema.json(), (), entry.metrics if entry else {}, parts)
        commit(spark, table_path(root, layer, dataset), base, {month: new})
    except BaseException:
        Folder(spark, path).delete()
        raise
    return WriteResult(path, rows)


def replace_buckets(df: DataFrame, root: str, layer: str, dataset: str, month: str, base, metrics: dict,
                    counts: Mapping[str, Column] | None = None, check: Callable[[dict], None] | None = None,
                    buckets: Sequence[str] = ()) -> WriteResult:
    """Publish new contents of some buckets of a month; all other buckets stay as they are.

    ``df`` has the rows of those ``buckets`` with their column ``bucket``; ``base``
    is the manifest that the caller read the old rows from. ``metrics`` go into
    the manifest; ``counts`` are aggregates that add up over buckets, and
    ``check`` gets their sums over the whole month, with ``rows``, and refuses
    by raising.
    """
    spark, commit_id, entry = df.sparkSession, uuid.uuid4().hex, base.months.get(month)
    if entry is not None and not entry.parts:
        raise PublishConflict(f"{month} of {dataset} in {layer} was published whole; drop it before buckets are merged")
    path = commit_path(root, layer, dataset, month, commit_id)
    stamped = stamp_month(df, month).drop(MONTH)
    try:
        stamped.write.partitionBy(BUCKET).parquet(path)
        schema = T.StructType([f for f in stamped.schema.fields if f.name != BUCKET])
        with _text_levels(spark):
            written = spark.read.option("basePath", path).schema(T.StructType([*schema.fields, T.StructField(BUCKET, T.StringType())])).parquet(path)
        names = list(counts or {})
        got = {r[0]: [r["rows"], *(int(r[n] or 0) for n in names)] for r in written.groupBy(BUCKET).agg(
            F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in (counts or {}).items()]).collect()}
        parts = {k: v for k, v in (entry.parts if entry else {}).items() if k not in buckets}
        parts |= {b: [f"{COMMIT}={commit_id}/{BUCKET}={b}", *got.get(b, [0] * (1 + len(names)))] for b in buckets}
        sums = {n: sum(p[i + 1] for p in parts.values()) for i, n in enumerate(["rows", *names])}
        if check is not None:
            check(sums)
        new = Month("", sums["rows"], schema.json(), (BUCKET,), {**metrics, **sums}, parts)
        commit(spark, table_path(root, layer, dataset), base, {month: new})
    except BaseException:
        Folder(spark, path).delete()
        raise
    return WriteResult(path, sums["rows"], {**sums, "buckets": sorted(buckets)})


def read_parts(spark: SparkSession, root: str, layer: str, dataset: str, month: str, manifest, parts: Sequence[str]) -> DataFrame:
    """Rows of some parts of a month, as of ``manifest``, with the column ``bucket`` where parts are buckets."""
    entry, path = manifest.months[month], table_path(root, layer, dataset)
    fields = T.StructType.fromJson(json.loads(entry.schema)).fields
    levels = [MONTH, COMMIT, *entry.levels]
    schema = T.StructType([*fields, *(T.StructField(c, T.StringType()) for c in levels)])
    folders = [f"{month_path(root, layer, dataset, month)}/{entry.parts[p][0]}" for p in parts if p in entry.parts and entry.parts[p][1]]
    if not folders:
        return spark.createDataFrame([], schema).drop(COMMIT)
    with _text_levels(spark):
        return spark.read.option("basePath", path).schema(schema).parquet(*folders).drop(COMMIT)


def read_table(spark: SparkSession, root: str, layer: str, dataset: str, month: str | None = None,
               within: Mapping[str, str] | None = None, schema: T.StructType | None = None) -> DataFrame:
    """Read a layer table as of its latest manifest; with ``month`` only that month's folder is listed and read.

    ``within`` names values of the directory levels below the month, in order,
    and narrows listing and reading to their folder. The schema is the
    manifest's (or the given one), so no file is opened to plan a read.
    Partition columns are strings, as written: town code ``0075`` keeps its zeros.
    """
    path, manifest = table_path(root, layer, dataset), manifest_of(spark, root, layer, dataset)
    if not manifest.version:
        raise TableNotFound(f"no published version of {path}")
    if schema is None:
        known = manifest.schema()
        levels = dict.fromkeys(c for e in manifest.months.values() for c in e.levels if c != BUCKET)
        fields = [f for f in known.fields if f.name not in levels]
        schema = T.StructType([*fields, *(T.StructField(c, T.StringType()) for c in (MONTH, *levels))])
    # Months with the same directory levels are one scan.
    shapes: dict[tuple, list[str]] = {}
    for m, e in sorted(manifest.months.items()):
        if e.rows and month in (None, m):
            below = [p[0] for p in e.parts.values() if p[1]] or [f"{COMMIT}={e.commit}"]
            shapes.setdefault(e.levels, []).extend(
                "/".join([month_path(root, layer, dataset, m), b, *(f"{k}={v}" for k, v in (within or {}).items())]) for b in below)
    frames = []
    for levels, folders in shapes.items():
        if within:
            table = Folder(spark, path)
            folders = [f for f in folders if table.below(f).exists()]
        if folders:
            extra = [c for c in (COMMIT, *levels) if c not in schema.names]
            full = T.StructType([*schema.fields, *(T.StructField(c, T.StringType()) for c in extra)])
            with _text_levels(spark):
                frames.append(spark.read.option("basePath", path).schema(full).parquet(*folders).select(*schema.names))
    return reduce(DataFrame.unionAll, frames) if frames else spark.createDataFrame([], schema)


def month_rows(spark: SparkSession, root: str, layer: str, dataset: str, month: str) -> int:
    """K6 dry run: rows currently published for one month, from the manifest."""
    entry = manifest_of(spark, root, layer, dataset).months.get(month)
    return entry.rows if entry else 0


def drop_month(spark: SparkSession, root: str, layer: str, dataset: str, month: str,
               dry_run: bool = False) -> int:
    """K6/K7: a version of the table without one month; returns the rows it held.

    Other months are untouched, and the month's folder is removed once the
    version without it stands.
    """
    base = manifest_of(spark, root, layer, dataset)
    entry = base.months.get(month)
    if entry is None:
        return 0
    if not dry_run:
        commit(spark, table_path(root, layer, dataset), base, {month: None})
        for folder in [p[0] for p in entry.parts.values()] or [f"{COMMIT}={entry.commit}"]:
            Folder(spark, f"{month_path(root, layer, dataset, month)}/{folder.partition('/')[0]}").delete()
    return entry.rows


def drop_month_all_layers(spark: SparkSession, root: str, dataset: str, month: str,
                          layers: tuple[str, ...] = ("bronze", "silver", "gold"),
                          dry_run: bool = False) -> dict[str, int]:
    """K7: the same month drop applied to every layer."""
    return {layer: drop_month(spark, root, layer, dataset, month, dry_run) for layer in layers}


def expire_commits(spark: SparkSession, root: str, layer: str, dataset: str) -> int:
    """Remove commit folders and manifests that the latest version does not use; returns the folders removed.

    For a time without publishers and without readers of older versions.
    """
    path, manifest = table_path(root, layer, dataset), manifest_of(spark, root, layer, dataset)
    used = {(m, f) for m, e in manifest.months.items() for f in [p[0].partition("/")[0] for p in e.parts.values()] or [f"{COMMIT}={e.commit}"]}
    removed = 0
    for name in Folder(spark, path).names():
        month = name.removeprefix(f"{MONTH}=")
        if month != name:
            for folder in Folder(spark, f"{path}/{name}").names():
                if (month, folder) not in used:
                    removed += Folder(spark, f"{path}/{name}/{folder}").delete()
    for name in Folder(spark, f"{path}/{FOLDER}").names():
        if name.startswith("v") and name < f"v{manifest.version:012d}.json":
            Folder(spark, f"{path}/{FOLDER}/{name}").delete()
    return removed
