"""Questions asked of the published lake: sizes, months present, slices,
month / year rollups and rule checks of the registry tables."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regspark.layouts import LAYOUTS
from regspark.operators import rollups
from regspark.operators.keysets import key_set, merged_count
from regspark.operators.lookup import lookup
from regspark.operators.quality import rule_alerts, score_rules, unique_key_rule
from regspark.sinks.lake import MONTH, TableNotFound, WriteResult, manifest_of, publish_month, read_table
from regspark.sinks.manifest import Month


def lake_tables(spark: SparkSession, root: str, layer: str = "gold",
                month: str | None = None) -> dict[str, DataFrame]:
    """Every published dataset of a layer (missing ones are skipped)."""
    out: dict[str, DataFrame] = {}
    for name in LAYOUTS:
        try:
            out[name] = read_table(spark, root, layer, name, month)
        except TableNotFound:
            continue
    return out


def _published(spark: SparkSession, root: str, layer: str) -> list[tuple[str, str, int]]:
    """(table, month, rows) of every published month, from the manifests: no data is scanned."""
    return [(name, month, entry.rows) for name in LAYOUTS
            for month, entry in manifest_of(spark, root, layer, name).months.items()]


def table_sizes(spark: SparkSession, root: str, layer: str = "gold",
                month: str | None = None) -> DataFrame:
    """U1 + O3 over the lake: rows per table, biggest first, from the manifests."""
    rows: dict[str, int] = {}
    for name, published, n in _published(spark, root, layer):
        if month in (None, published):
            rows[name] = rows.get(name, 0) + n
    return spark.createDataFrame(list(rows.items()), "tabela string, total long").orderBy(F.desc("total"), F.asc("tabela"))


def months_present(spark: SparkSession, root: str, layer: str = "gold") -> DataFrame:
    """U2 + F5: months that hold rows in at least one table (empty tables and
    emptied months contribute nothing), from the manifests."""
    months = sorted({month for _, month, n in _published(spark, root, layer) if n})
    return spark.createDataFrame([(m,) for m in months], "data_version string")


def month_slice(spark: SparkSession, root: str, dataset: str, month: str,
                n: int = 100) -> DataFrame:
    """F1 + O1: the first ``n`` rows of one month by company key (pruned read)."""
    return rollups.month_slice_top(read_table(spark, root, "gold", dataset), month,
                                   ["cnpj_basico"], n)


# --- A8-A10 from key sets kept beside the gold months ----------------------------------

KEY_SETS = "keysets"
COMPANY = "cnpj_basico"


def publish_key_set(spark: SparkSession, root: str, month: str, dataset: str = "empresas", key: str = COMPANY) -> WriteResult | None:
    """Write the distinct keys of one published gold month beside it, unless they stand for that gold already.

    The key set's manifest names the gold version of the month that it was made from.
    """
    gold = manifest_of(spark, root, "gold", dataset).months.get(month)
    made = manifest_of(spark, root, KEY_SETS, dataset).months.get(month)
    if gold is None or (made is not None and made.metrics.get("made_from") == made_of(gold)):
        return None
    rows = key_set(read_table(spark, root, "gold", dataset, month), key, [])
    return publish_month(rows, root, KEY_SETS, dataset, month, facts={"made_from": made_of(gold)})


def made_of(entry: Month) -> str:
    """Names the files a month is made of."""
    return entry.commit or " ".join(sorted(p[0] for p in entry.parts.values()))


def _company_keys(spark: SparkSession, root: str, year: str | None = None) -> DataFrame:
    """Key sets of the gold months (of a year): as written, or made here where a month has none that is current."""
    gold = {m: e for m, e in manifest_of(spark, root, "gold", "empresas").months.items() if e.rows and m.startswith(year or "")}
    made = manifest_of(spark, root, KEY_SETS, "empresas").months
    current = [m for m, e in gold.items() if m in made and made[m].metrics.get("made_from") == made_of(e)]
    columns = [MONTH, "key_bucket", "key_bits", "other_key"]
    frames = []
    if current:
        frames.append(read_table(spark, root, KEY_SETS, "empresas").where(F.col(MONTH).isin(current)).select(*columns))
        empty = [m for m in current if not made[m].rows]  # months with NULL keys only
        if empty:
            frames.append(spark.createDataFrame([(m, None, None, None) for m in empty], "data_version string, key_bucket long, key_bits binary, other_key string"))
    left = sorted(set(gold) - set(current))
    if left:
        rows = read_table(spark, root, "gold", "empresas").where(F.col(MONTH).isin(left))
        frames.append(key_set(rows, COMPANY, [MONTH]).select(*columns))
    if not frames:
        return spark.createDataFrame([], "data_version string, key_bucket long, key_bits binary, other_key string")
    return reduce(DataFrame.unionAll, frames)


def companies_per_month(spark: SparkSession, root: str) -> DataFrame:
    """A8 on the company table, from its key sets."""
    return merged_count(_company_keys(spark, root), {MONTH: F.col(MONTH)}, "distinct_companies")


def companies_per_year_month(spark: SparkSession, root: str, year: str | None = None) -> DataFrame:
    """A9 (+ F2 when ``year`` is given: only that year's key sets are read)."""
    return merged_count(_company_keys(spark, root, year), {"year": rollups.year_of(), MONTH: F.col(MONTH)}, "distinct_companies")


def companies_per_year(spark: SparkSession, root: str) -> DataFrame:
    """A10: a company present in several months of a year counts once; bitmaps of the months are merged."""
    return merged_count(_company_keys(spark, root), {"year": rollups.year_of()}, "distinct_companies")


def branches_by_state(spark: SparkSession, root: str, scores: DataFrame | None = None) -> DataFrame:
    """A11 on the branch table: branches, companies and mean score per state."""
    est = read_table(spark, root, "gold", "estabelecimentos")
    if scores is not None:
        est = est.join(scores, ["cnpj_basico", "cnpj_ordem", "cnpj_dv", "data_version"], "left")
    else:
        est = est.withColumn("quality_score", F.lit(None).cast("double"))
    return rollups.state_rollup(est, "uf", "cnpj_basico", "quality_score")


# --- Q6 rule checks of the branch table -----------------------------------------------

BRANCH_KEY = ["cnpj_basico", "cnpj_ordem", "cnpj_dv", "data_version"]
# Head-office flag domain and the CEP layout (12345678 or 12345-678).
FLAG_DOMAIN = ("1", "2")
CEP_PATTERN = "^[0-9]{5}-?[0-9]{3}$"


def branch_rules(branches: DataFrame, towns: DataFrame) -> tuple[DataFrame, dict[str, Column]]:
    """Required id, CEP format, valid start date, known town code of the same
    month, flag domain and unique key. Returns the frame with helper columns
    and the rule expressions."""
    df = lookup(branches, towns, {"municipio": "codigo", "data_version": "data_version"},
                {"codigo": "__town_found"})
    df = unique_key_rule(df, BRANCH_KEY, "__unique")
    rules = {
        "required_id": F.col("cnpj_basico").isNotNull() & F.col("cnpj_ordem").isNotNull()
        & F.col("cnpj_dv").isNotNull(),
        "cep_format": F.col("cep").rlike(CEP_PATTERN),
        "start_date_valid": F.col("data_inicio_atividade").isNotNull(),
        "valid_town": F.col("__town_found").isNotNull(),
        "flag_domain": F.col("identificador_matriz_filial").isin(*FLAG_DOMAIN),
        "unique_key": F.col("__unique"),
    }
    return df, rules


def branch_scores(branches: DataFrame, towns: DataFrame) -> DataFrame:
    """Q4: per branch, rules passed, score and band."""
    df, rules = branch_rules(branches, towns)
    return score_rules(df, rules).select(
        *BRANCH_KEY, "rules_passed", "rules_total", "quality_score", "quality_band"
    )


RULE_FIELDS: Mapping[str, tuple[str, str]] = {
    "required_id": ("cnpj_basico", "CRITICAL"),
    "cep_format": ("cep", "WARNING"),
    "start_date_valid": ("data_inicio_atividade", "WARNING"),
    "valid_town": ("municipio", "ERROR"),
    "flag_domain": ("identificador_matriz_filial", "ERROR"),
    "unique_key": ("cnpj_basico", "CRITICAL"),
}


def branch_alerts(branches: DataFrame, towns: DataFrame, line_col: str) -> DataFrame:
    """Q6 alert rows (alert table shape) for every failed branch rule."""
    df, rules = branch_rules(branches, towns)
    spec = {name: (rules[name], *RULE_FIELDS[name]) for name in rules}
    return rule_alerts(df, spec, line_col)
