"""Views without a shuffle on the company key: reduced tables bucketed by it.

The windows and the partner count of the views reduce every dataset to one row
per company and month. :func:`publish_reduced` does that once a month and writes
the three results as Parquet tables hashed into the same number of buckets by
(cnpj_basico, data_version) and sorted in each; every later query joins them
bucket by bucket. A reduced table has one row a key, so no bucket is hot however
many branches or partners one company has.

Each is a table of the lake's layer ``reduced``: its files stay where they were
written, its manifest names the gold version they were made from, and a month whose
gold is newer is answered from gold until it is published again. Spark knows the
buckets of catalog tables only, so files are entered in the session's catalog
under a name made of their commit; a session that has no such entry makes one
from the manifest.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regspark.plans import views
from regspark.plans.history import made_of, lake_tables
from regspark.sinks.lake import Folder, commit_path, manifest_of, read_table, table_path
from regspark.sinks.manifest import Month, commit

REDUCED = "reduced"
ROWS_PER_BUCKET = 1_000_000

# Reduced table -> the gold dataset it is made from and how. Gold branches are unique by
# full identifier and gold companies by key, so the row preferred does not depend on the columns kept.
REDUCERS: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {
    views.ONE_COMPANY: ("empresas", lambda df: views.preferred_companies(df, views.CONTEXT_COMPANY)),
    views.ONE_BRANCH: ("estabelecimentos", lambda df: views.preferred_branches(
        df, list(dict.fromkeys([*views.CONSOLIDATED_BRANCH, *views.CONTEXT_BRANCH])))),
    views.PARTNER_COUNT: ("socios", views.partner_counts),
}


def bucket_count(rows: int) -> int:
    """A power of two, so that months of different size still divide into one another."""
    return 1 << max(3, (max(rows, 1) // ROWS_PER_BUCKET).bit_length())


def publish_reduced(spark: SparkSession, root: str, month: str, buckets: int | None = None) -> dict[str, int]:
    """Write the reduced tables of a month that are not current; returns their rows by name.

    A dataset without the month in gold gives no table. ``buckets`` defaults to
    one a million rows of the largest of the gold datasets; tables of one month
    that were made with different counts are made again.
    """
    gold = {name: manifest_of(spark, root, "gold", dataset).months.get(month) for name, (dataset, _) in REDUCERS.items()}
    buckets = buckets or bucket_count(max((e.rows for e in gold.values() if e), default=0))
    written = {}
    for name, entry in gold.items():
        base = manifest_of(spark, root, REDUCED, name)
        made = base.months.get(month)
        if entry is None or (made and _facts(made) == (made_of(entry), buckets)):
            continue
        dataset, reducer = REDUCERS[name]
        rows = reducer(read_table(spark, root, "gold", dataset, month))
        written[name] = _write(spark, rows, root, name, month, base, {"made_from": made_of(entry), "buckets": buckets})
        if made:
            spark.sql(f"DROP TABLE IF EXISTS {_table_name(name, made)}")
    return written


def _facts(entry: Month) -> tuple[str, int]:
    return entry.metrics["made_from"], int(entry.metrics["buckets"])


def _table_name(name: str, entry: Month) -> str:
    return f"regspark_{name}_{entry.commit}"


def _write(spark: SparkSession, df: DataFrame, root: str, name: str, month: str, base, facts: Mapping) -> int:
    entry = Month(uuid.uuid4().hex, 0, df.schema.json())
    path, n = commit_path(root, REDUCED, name, month, entry.commit), facts["buckets"]
    obs = Observation(f"reduce-{name}-{entry.commit}")
    rows = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    try:
        # one task a bucket, so a bucket is one file
        (rows.repartition(n, *views.KEY).write.format("parquet").bucketBy(n, *views.KEY).sortBy(*views.KEY)
         .option("path", path).saveAsTable(_table_name(name, entry)))
        entry = Month(entry.commit, int(obs.get.get("rows") or 0), entry.schema, (), dict(facts))
        commit(spark, table_path(root, REDUCED, name), base, {month: entry})
    except BaseException:
        spark.sql(f"DROP TABLE IF EXISTS {_table_name(name, entry)}")
        Folder(spark, path).delete()
        raise
    return entry.rows


def _enter(spark: SparkSession, root: str, name: str, month: str, entry: Month) -> DataFrame:
    """The catalog table of the month's files, entered when this session's catalog has none."""
    table = _table_name(name, entry)
    if not spark.catalog.tableExists(table):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in T.StructType.fromJson(json.loads(entry.schema)).fields)
        keys, path = ", ".join(views.KEY), commit_path(root, REDUCED, name, month, entry.commit)
        literal = path.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) "
                  f"INTO {entry.metrics['buckets']} BUCKETS LOCATION '{literal}'")
    return spark.table(table)


def reduced_tables(spark: SparkSession, root: str, month: str) -> dict[str, DataFrame]:
    """The month's reduced tables that are made from the gold version published now."""
    out = {}
    for name, (dataset, _) in REDUCERS.items():
        gold = manifest_of(spark, root, "gold", dataset).months.get(month)
        made = manifest_of(spark, root, REDUCED, name).months.get(month)
        if gold and made and made.metrics["made_from"] == made_of(gold):
            out[name] = _enter(spark, root, name, month, made)
    return out


def lake_view(spark: SparkSession, root: str, view: str, months: list[str] | None = None) -> DataFrame:
    """One of the five views over the published gold months (all of them by default).

    Months are answered one by one and put together, each from its reduced
    tables where they are current: companies, branches and counts then meet
    without an exchange on their key.
    """
    if months is None:
        months = sorted(manifest_of(spark, root, "gold", "empresas").months)
    parts = [views.VIEWS[view]({**lake_tables(spark, root, month=m), **reduced_tables(spark, root, m)}) for m in months]
    return reduce(DataFrame.unionByName, parts)
