"""Bronze -> silver -> gold for one dataset and month, and the run around it.

Each layer is one Spark job that writes one month partition (see
:mod:`regspark.sinks.lake`); data crosses layers through storage, so a
layer can be re-run alone and an executor loss only repeats tasks of the
current write. The silver quality gate is judged on counts that the silver
write itself gathers, before its month is switched in, so a failing month
never replaces a good one and the month is scanned and shuffled once.
"""

from __future__ import annotations

import datetime as dt
import functools
import itertools
from collections.abc import Callable, Sequence
from contextlib import nullcontext
from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from regspark.functions.cleanse import cast_dataset, tidy_strings
from regspark.layouts import dataset_spec
from regspark.operators.preferred import dedup
from regspark.operators.quality import DEFAULT_THRESHOLD, enforce_gate
from regspark.sinks.lake import (
    BUCKET, Folder, WriteResult, drop_month_all_layers, manifest_of, month_path, month_rows, publish_month,
    read_parts, read_table, replace_buckets,
)
from regspark.sinks.manifest import Month
from regspark.sinks.runlog import RunLog
from regspark.sources.text import (
    DEFAULT_ENCODING, EncodingChoice, read_bronze, resolve_sources,
)

BRONZE, SILVER, GOLD = "bronze", "silver", "gold"
# Tables whose distinct keys are kept beside every gold month.
KEY_SET_TABLES = ("empresas",)


# --- frames (pure, lazy) ------------------------------------------------------------

def typed_frame(bronze: DataFrame, dataset: str) -> DataFrame:
    """P10 tidy and P11/P12/N1 casts."""
    spec = dataset_spec(dataset)
    return cast_dataset(tidy_strings(bronze), list(spec.money), list(spec.dates))


def silver_frame(bronze: DataFrame, dataset: str, keys: Sequence[str] | None = None,
                 deterministic: bool = True) -> DataFrame:
    """Typed rows, A1 deduplicated on the dataset's (or the given) keys.

    Keys that are not columns raise: deduplicating on what is left would
    drop rows that differ.
    """
    return dedup(typed_frame(bronze, dataset), list(keys or dataset_spec(dataset).keys),
                 deterministic)


def gold_frame(silver: DataFrame, dataset: str) -> DataFrame:
    """The dataset's business columns in layout order; an unknown dataset has no layout and stays whole."""
    present = set(silver.columns)
    layout = dataset_spec(dataset).layout
    return silver.select([c for c in layout if c in present]) if present & set(layout) else silver


# --- layer jobs ---------------------------------------------------------------------

@dataclass
class MonthResult:
    dataset: str
    month: str
    bronze: WriteResult | None = None
    silver: WriteResult | None = None
    gold: WriteResult | None = None
    encoding: EncodingChoice | None = None
    quality: dict = field(default_factory=dict)


def run_bronze(spark: SparkSession, source, dataset: str, month: str, root: str,
               encoding: str = DEFAULT_ENCODING, sep: str = ";") -> tuple[WriteResult, EncodingChoice]:
    name = dataset_spec(dataset).name
    df, choice = read_bronze(spark, source, name, month, encoding=encoding, sep=sep)
    return publish_month(df, root, BRONZE, name, month), choice


def gate_row(total: int, nulls: int, kept: int, kept_nulls: int, threshold: int | float) -> dict:
    """Q1/A5 numbers from the counts before and after deduplication, compared exactly."""
    limit = Decimal(100) - Decimal(str(threshold))
    return {
        "total_rows": total, "null_rows": nulls, "null_rate": nulls / total if total else None,
        "distinct_keys": kept, "null_keys": kept_nulls, "null_rate_dedup": kept_nulls / kept if kept else None,
        "threshold": threshold, "passed": Decimal(kept_nulls) * 100 <= limit * kept,
    }


def run_silver(spark: SparkSession, dataset: str, month: str, root: str,
               keys: Sequence[str] | None = None,
               threshold: int = DEFAULT_THRESHOLD) -> tuple[WriteResult, dict]:
    """Silver for one month: one scan, one shuffle, one write; the gate decides before the switch."""
    spec = dataset_spec(dataset)
    bronze = read_table(spark, root, BRONZE, spec.name, month).drop("data_version")
    resolved = list(keys or spec.keys)
    if not resolved:
        return publish_month(typed_frame(bronze, spec.name), root, SILVER, spec.name, month), {}
    typed = typed_frame(bronze, spec.name)
    before = Observation(f"silver-in-{spec.name}-{month}")
    missing = F.count_if(F.col(resolved[0]).isNull()) if resolved[0] in typed.columns else F.lit(0)
    typed = typed.observe(before, F.count(F.lit(1)).alias("rows"), missing.alias("nulls"))
    quality: dict = {}

    def gate(after: dict) -> None:
        seen = before.get
        quality.update(gate_row(seen["rows"], seen["nulls"], after["rows"], after["null_keys"], threshold))
        enforce_gate(quality, resolved[0], threshold)

    result = publish_month(
        dedup(typed, resolved), root, SILVER, spec.name, month,
        metrics={"null_keys": F.count_if(F.col(resolved[0]).isNull())}, check=gate)
    return result, quality


def run_gold(spark: SparkSession, dataset: str, month: str, root: str) -> WriteResult:
    name = dataset_spec(dataset).name
    silver = read_table(spark, root, SILVER, name, month)
    return publish_month(gold_frame(silver, name), root, GOLD, name, month)


def run_month(spark: SparkSession, source, dataset: str, month: str, root: str,
              keys: Sequence[str] | None = None, encoding: str = DEFAULT_ENCODING,
              sep: str = ";", threshold: int = DEFAULT_THRESHOLD,
              record_runs: bool = True, archive_to: str | None = None) -> MonthResult:
    """Bronze -> silver -> gold in one session, with a record of the run and of each stage.

    Any failure marks its stage and the run failed and re-raises. With
    ``archive_to`` the consumed files are moved there (K9) once gold is written;
    ``source`` must then be a path, a glob or alternatives.
    """
    name = dataset_spec(dataset).name
    files = resolve_sources(spark, source) if archive_to else []
    read = functools.partial(run_bronze, spark, source, name, month, root, encoding, sep)
    return _build_month(spark, read, name, str(source), month, root, keys, threshold, record_runs,
                        lambda: archive_files(spark, files, archive_to, name, month))


def run_arrivals(spark: SparkSession, source_dir: str, dataset: str, month: str, root: str,
                 archive_dir: str | None = None, keys: Sequence[str] | None = None,
                 encoding: str = DEFAULT_ENCODING, sep: str = ";", threshold: int = DEFAULT_THRESHOLD,
                 record_runs: bool = True, buckets: int = 64) -> MonthResult:
    """R1 + R3: take in the files that arrived since the last call and merge them into the month.

    Each batch of files becomes a part of the bronze month. Silver and gold are
    kept in ``buckets`` by key hash; only the buckets that new parts touch are
    read, merged and written. What a layer has merged stands in its manifest,
    so a call after a failure goes on where the last one stopped and a replayed
    batch changes nothing. The gate judges the whole month as it would be.
    """
    from regspark.streaming.archive import ingest_parts

    name = dataset_spec(dataset).name
    checkpoint = f"{root.rstrip('/')}/_arrivals/{name}/{month}/checkpoint"

    def take_in() -> tuple[WriteResult, EncodingChoice]:
        ingest_parts(spark, source_dir, name, month, root, BRONZE, checkpoint, archive_dir, encoding, sep)
        rows = month_rows(spark, root, BRONZE, name, month)
        return WriteResult(month_path(root, BRONZE, name, month), rows), EncodingChoice(name, encoding, encoding, 0, 0)

    return _build_month(spark, take_in, name, source_dir, month, root, keys, threshold, record_runs,
                        silver=lambda: merge_silver(spark, name, month, root, keys, threshold, buckets),
                        gold=lambda: merge_gold(spark, name, month, root))


def _unchanged(entry: Month, root: str, layer: str, name: str, month: str) -> WriteResult:
    return WriteResult(month_path(root, layer, name, month), entry.rows if entry else 0, {"buckets": []})


def merge_silver(spark: SparkSession, dataset: str, month: str, root: str, keys: Sequence[str] | None = None,
                 threshold: int = DEFAULT_THRESHOLD, buckets: int = 64) -> tuple[WriteResult, dict]:
    """Bronze parts that silver has not seen, merged into the buckets of their keys.

    The kept row of a key is the smallest by all columns, so merging the kept
    rows with the new ones gives what deduplicating all rows at once gives.
    """
    spec = dataset_spec(dataset)
    resolved = list(keys or spec.keys)
    if not resolved:
        raise ValueError(f"arrivals of {dataset!r} need keys to merge on")
    below, base = manifest_of(spark, root, BRONZE, spec.name), manifest_of(spark, root, SILVER, spec.name)
    parts, entry = below.months[month].parts if month in below.months else {}, base.months.get(month)
    known = entry.metrics if entry else {"merged": [], "rows_in": 0, "nulls_in": 0, "n_buckets": buckets}
    fresh = sorted(set(parts) - set(known["merged"]))
    if not fresh:
        return _unchanged(entry, root, SILVER, spec.name, month), {}
    arrived = typed_frame(read_parts(spark, root, BRONZE, spec.name, month, below, fresh).drop("data_version"), spec.name)
    missing = [k for k in resolved if k not in arrived.columns]
    if missing:
        raise ValueError(f"deduplication keys {missing} are not columns")
    place = F.lpad(F.pmod(F.xxhash64(*resolved), F.lit(known["n_buckets"])).cast("string"), 4, "0")
    arrived = arrived.withColumn(BUCKET, place)
    null_key = F.col(resolved[0]).isNull()
    seen = arrived.groupBy(BUCKET).agg(F.count(F.lit(1)).alias("rows"), F.count_if(null_key).alias("nulls")).collect()
    touched = sorted(r[0] for r in seen)  # at most n_buckets
    rows = arrived
    if entry is not None:
        old = read_parts(spark, root, SILVER, spec.name, month, base, touched).drop("data_version")
        rows = old.select(*arrived.columns).unionAll(arrived)
    total = {"rows_in": known["rows_in"] + sum(r["rows"] for r in seen), "nulls_in": known["nulls_in"] + sum(r["nulls"] for r in seen)}
    quality: dict = {}

    def gate(after: dict) -> None:
        quality.update(gate_row(total["rows_in"], total["nulls_in"], after["rows"], after["null_keys"], threshold))
        enforce_gate(quality, resolved[0], threshold)

    result = replace_buckets(
        dedup(rows, resolved), root, SILVER, spec.name, month, base,
        {**total, "merged": sorted([*known["merged"], *fresh]), "n_buckets": known["n_buckets"]},
        counts={"null_keys": F.count_if(null_key)}, check=gate, buckets=touched)
    return result, quality


def merge_gold(spark: SparkSession, dataset: str, month: str, root: str) -> WriteResult:
    """Gold buckets of the silver buckets that changed since gold was written."""
    name = dataset_spec(dataset).name
    below, base = manifest_of(spark, root, SILVER, name), manifest_of(spark, root, GOLD, name)
    parts, entry = below.months[month].parts if month in below.months else {}, base.months.get(month)
    made_from = dict(entry.metrics["made_from"]) if entry else {}
    changed = sorted(b for b, p in parts.items() if made_from.get(b) != p[0])
    if not changed:
        return _unchanged(entry, root, GOLD, name, month)
    rows = read_parts(spark, root, SILVER, name, month, below, changed)
    out = gold_frame(rows, name)
    out = rows.select(*out.columns, BUCKET) if BUCKET not in out.columns else out
    return replace_buckets(out, root, GOLD, name, month, base,
                           {"made_from": {b: p[0] for b, p in parts.items()}}, buckets=changed)


def archive_files(spark: SparkSession, files: Sequence[str], archive_root: str | None, dataset: str, month: str) -> list[str]:
    """K9: move consumed files below dataset and month; a name that is taken gets the UTC time as a suffix.

    Two files of one name and second get the next free second, so none is lost.
    """
    moved = []
    for path in files:
        folder, name = f"{archive_root.rstrip('/')}/{dataset}/{month}", path.rpartition("/")[2]
        stem, dot, suffix = name.rpartition(".")
        stem, suffix = (stem, dot + suffix) if stem else (name, "")
        now = dt.datetime.now(dt.timezone.utc)
        times = (now + dt.timedelta(seconds=k) for k in itertools.count())
        names = itertools.chain([name], (f"{stem}_{t:%Y%m%dT%H%M%SZ}{suffix}" for t in times))
        free = next(n for n in names if not Folder(spark, f"{folder}/{n}").exists())
        Folder(spark, path).move_to(Folder(spark, f"{folder}/{free}"))
        moved.append(f"{folder}/{free}")
    return moved


def _build_month(spark: SparkSession, read_in: Callable[[], tuple[WriteResult, EncodingChoice]], name: str, source: str,
                 month: str, root: str, keys: Sequence[str] | None, threshold: int | float, record_runs: bool,
                 afterwards: Callable[[], object] = lambda: None,
                 silver: Callable[[], tuple[WriteResult, dict]] | None = None,
                 gold: Callable[[], WriteResult] | None = None) -> MonthResult:
    silver = silver or (lambda: run_silver(spark, name, month, root, keys, threshold))
    gold = gold or (lambda: run_gold(spark, name, month, root))
    runs = RunLog(spark, root) if record_runs else None
    run = runs.start(f"registry_{name}", name, source, month) if runs else None
    result = MonthResult(name, month)

    def stage(which: str):
        return runs.stage(run, which) if runs else nullcontext({})

    def note(out: dict, written: WriteResult) -> None:
        out["records"], out["output_path"] = written.rows, written.path

    try:
        with stage(BRONZE) as out:
            result.bronze, result.encoding = read_in()
            note(out, result.bronze)
        if runs and result.encoding.from_encoding != result.encoding.to_encoding:
            # Only switches feed the fallback metrics; skip a write otherwise.
            runs.record_encoding(result.encoding, month)
        with stage(SILVER) as out:
            result.silver, result.quality = silver()
            note(out, result.silver)
        with stage(GOLD) as out:
            result.gold = gold()
            note(out, result.gold)
        if name in KEY_SET_TABLES:
            from regspark.plans.history import publish_key_set

            publish_key_set(spark, root, month, name)
        afterwards()
    except Exception as exc:
        if runs:
            runs.finish(run, "failed", failed=1, error=exc)
        raise
    if runs:
        runs.finish(run, "completed", result.gold.rows, output_path=result.gold.path)
    return result


def reingest_month(spark: SparkSession, source, dataset: str, month: str, root: str,
                   skip_cleanup: bool = False, skip_run: bool = False,
                   dry_run: bool = False, **kwargs) -> dict:
    """K8: rebuild one dataset and month in every layer, or only drop it.

    Each layer's month is replaced when its rebuild has succeeded, so a failing
    rebuild loses nothing; without a rebuild the month is dropped.
    """
    out: dict = {}
    if not skip_cleanup:
        rebuild = not skip_run and not dry_run
        out["dropped"] = drop_month_all_layers(spark, root, dataset_spec(dataset).name, month,
                                               dry_run=dry_run or rebuild)
    if not skip_run and not dry_run:
        out["result"] = run_month(spark, source, dataset, month, root, **kwargs)
    return out
