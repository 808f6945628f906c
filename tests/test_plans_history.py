"""Plan shape (top-1 before the shuffle, bounded broadcasts, pruning, pushdown),
skew handling and the lake-level rollups."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from conftest import write_lines
from regspark.operators.lookup import lookup
from regspark.operators.preferred import flag_first, preferred_row
from regspark.plans import history
from regspark.plans.layers import run_month

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_top1_is_limited_before_the_shuffle(spark):
    df = spark.read.parquet(f"{SF}/orders.parquet")
    pref = preferred_row(df, ["o_custkey"], [flag_first("o_orderpriority", "1-URGENT"), "o_orderkey"])
    plan = _plan(pref)
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_hot_key_top1_is_exact(spark):
    # One key holds a third of all rows; the result is still exact.
    rows = [(0 if i % 3 == 0 else i, i) for i in range(3000)]
    df = spark.createDataFrame(rows, "k long, v long").repartition(8)
    pref = {r.k: r.v for r in preferred_row(df, ["k"], [F.col("v").desc()]).collect()}
    assert pref[0] == 2997 and len(pref) == 2001


def test_lookup_joins_without_a_probe(spark, tmp_path):
    """A 60-month town list joins without shuffling the fact, and building it starts no job."""
    towns = spark.range(5570 * 60).selectExpr(
        "lpad(id % 5570, 4, '0') AS codigo", "concat('TOWN ', id % 5570) AS descricao", "string(id div 5570) AS data_version")
    towns.write.parquet(f"{tmp_path}/towns")
    towns = spark.read.parquet(f"{tmp_path}/towns")
    fact = spark.range(1000).selectExpr("lpad(id, 4, '0') AS municipio", "'7' AS data_version")
    spark.sparkContext.setJobGroup("lookup", "building a lookup")
    out = lookup(fact, towns, {"municipio": "codigo", "data_version": "data_version"}, {"descricao": "town"})
    plan = _plan(out)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("lookup")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert out.where("town is not null").count() == 1000


def test_views_read_only_their_columns(spark, tmp_path):
    from regspark.plans import views
    from regspark.queries.registry import registry_tables

    tables = {}
    for name, df in registry_tables(spark, SF).items():
        df.write.parquet(f"{tmp_path}/{name}")
        tables[name] = spark.read.parquet(f"{tmp_path}/{name}")
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    spark.sparkContext.setJobGroup("views", "building views")
    plans = {name: _plan(fn(tables)) for name, fn in views.VIEWS.items()}
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("views")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    branch = re.search(r"ReadSchema: struct<(cnpj_basico:string,cnpj_ordem[^>]*)>", plans["vw_empresas_com_uf"])[1]
    assert {c.split(":")[0] for c in branch.split(",")} == {
        "cnpj_basico", "cnpj_ordem", "cnpj_dv", "identificador_matriz_filial", "uf", "municipio", "data_version"}


def test_unique_key_rule_keeps_every_row(spark):
    from regspark.operators.quality import rule_alerts, unique_key_rule

    df = spark.createDataFrame([("1", "a"), ("1", "b"), ("2", "c"), (None, "d"), (None, "e")], "k string, v string")
    got = {r.v: r.ok for r in unique_key_rule(df, ["k"], "ok").collect()}
    assert got == {"a": False, "b": False, "c": True, "d": False, "e": False}
    alerts = rule_alerts(df, {"r": (F.col("v") != "a", "v", "ERROR")}, "v").collect()
    assert [r.record_line for r in alerts] == [None]  # a text key is no line number


def test_cep_in_both_forms(spark):
    from regspark.plans.history import CEP_PATTERN

    df = spark.createDataFrame([("12345678",), ("12345-678",), ("1234-5678",), ("12345",)], "cep string")
    assert [r[0] for r in df.select(F.col("cep").rlike(CEP_PATTERN)).collect()] == [True, True, False, False]


def test_scan_prunes_columns_and_pushes_filters(spark):
    plan = _plan(entry.queries()["year_filtered_distinct"](spark, SF))
    assert "ReadSchema: struct<o_custkey:bigint,o_orderdate:timestamp" in plan
    df = spark.read.parquet(f"{SF}/customer.parquet").where("c_mktsegment <> 'FURNITURE'").select("c_custkey")
    assert "PushedFilters: [IsNotNull(c_mktsegment), Not(EqualTo(c_mktsegment,FURNITURE))" in _plan(df)


def test_entry_contract(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "c_custkey" and df.count() > 0
    qs, sqls = entry.queries(), entry.oracle_sql()
    assert set(sqls) <= set(qs)
    own = {n for n in qs if not re.match(r"op\d+_|pipeline$", n)}
    assert own - set(sqls) == set()   # every query of the registry part has an oracle


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("hist"))
    root = f"{base}/lake"
    for month, rows in {
        "2025-11": ['1;"A";1;1;1,00;01;', '2;"B";1;1;1,00;01;'],
        "2025-12": ['1;"A";1;1;1,00;01;'],
        "2026-01": ['1;"A";1;1;1,00;01;', '3;"C";1;1;1,00;01;'],
    }.items():
        src = write_lines(f"{base}/{month}/Empresas.txt", rows)
        run_month(spark, src, "empresas", month, root, record_runs=False)
    src = write_lines(f"{base}/mun/Municipios.txt", ["7107;SAO PAULO"])
    run_month(spark, src, "municipios", "2026-01", root, record_runs=False)
    return root


def test_lake_rollups(spark, lake):
    per_month = {r.data_version: r.distinct_companies for r in history.companies_per_month(spark, lake).collect()}
    assert per_month == {"2025-11": 2, "2025-12": 1, "2026-01": 2}
    per_year = {r.year: r.distinct_companies for r in history.companies_per_year(spark, lake).collect()}
    assert per_year == {"2025": 2, "2026": 2}
    ym = history.companies_per_year_month(spark, lake, year="2025")
    assert sorted((r.year, r.data_version) for r in ym.collect()) == [("2025", "2025-11"), ("2025", "2025-12")]
    for counted in (ym, history.companies_per_month(spark, lake), history.companies_per_year(spark, lake)):
        plan = _plan(counted)
        assert "/keysets/empresas" in plan and "/gold/" not in plan  # no gold scan
    sizes = [(r.tabela, r.total) for r in history.table_sizes(spark, lake).collect()]
    assert sizes == [("empresas", 5), ("municipios", 1)]
    months = sorted(r.data_version for r in history.months_present(spark, lake).collect())
    assert months == ["2025-11", "2025-12", "2026-01"]
    top = history.month_slice(spark, lake, "empresas", "2026-01", n=1).collect()
    assert [r.cnpj_basico for r in top] == ["1"]


def test_key_sets_count_exactly_and_follow_gold(spark, workdir):
    from regspark.operators.keysets import key_set, merged_count
    from regspark.sinks.lake import publish_month

    rows = [("a", "00000001"), ("a", "1"), ("a", "00000001"), ("a", "99999999"), ("a", None), ("b", "00000001"), ("b", "N0000001"),
            ("b", "٣٣٣٣٣٣٣٣"), ("b", " 0000001"), ("b", "00032768"), ("b", "00032767"), ("b", ""), ("c", "7")]
    df = spark.createDataFrame(rows, "g string, k string")
    keys = key_set(df, "k", ["g"])
    assert {r.g: r.n for r in merged_count(keys, {"g": F.col("g")}, "n").collect()} == {"a": 3, "b": 7, "c": 1}
    assert merged_count(keys, {"one": F.lit(1)}, "n").first().n == len({k for _, k in rows if k is not None})
    root = f"{workdir}/keys"
    gold = df.selectExpr("k AS cnpj_basico")
    publish_month(gold, root, "gold", "empresas", "2026-01")
    publish_month(gold.limit(2), root, "gold", "empresas", "2026-02")
    assert history.publish_key_set(spark, root, "2026-01") and history.publish_key_set(spark, root, "2026-01") is None
    # A month without a key set, and one whose gold was replaced, are counted from gold.
    assert {r.data_version: r.distinct_companies for r in history.companies_per_month(spark, root).collect()} == {"2026-01": 10, "2026-02": 2}
    publish_month(gold.limit(1), root, "gold", "empresas", "2026-01")
    publish_month(gold.where("cnpj_basico IS NULL"), root, "gold", "empresas", "2026-03")
    history.publish_key_set(spark, root, "2026-03")
    assert {r.data_version: r.distinct_companies for r in history.companies_per_month(spark, root).collect()} == {
        "2026-01": 1, "2026-02": 2, "2026-03": 0}
    assert [tuple(r) for r in history.companies_per_year(spark, root).collect()] == [("2026", 2)]


def test_branch_rules_and_alerts(spark):
    cols = ["cnpj_basico", "cnpj_ordem", "cnpj_dv", "identificador_matriz_filial", "cep",
            "data_inicio_atividade", "municipio", "data_version"]
    est = spark.createDataFrame([
        ("1", "0001", "10", "1", "01310100", "2020-01-01", "7107", "2026-01"),
        ("1", "0001", "10", "1", "01310100", "2020-01-01", "7107", "2026-01"),   # duplicate key
        ("2", "0001", "20", "3", "0131-010", None, "9999", "2026-01"),
    ], ", ".join(f"{c} string" for c in cols)).withColumn("data_inicio_atividade", F.to_date("data_inicio_atividade"))
    towns = spark.createDataFrame([("7107", "SAO PAULO", "2026-01")], "codigo string, descricao string, data_version string")
    scores = {(r.cnpj_basico, r.rules_passed, r.quality_band) for r in history.branch_scores(est, towns).collect()}
    assert scores == {("1", 5, "minor_alerts"), ("2", 2, "held")}
    alerts = history.branch_alerts(est.withColumn("line", F.monotonically_increasing_id()), towns, "line")
    types = sorted(r.alert_type for r in alerts.collect())
    assert types == ["cep_format", "flag_domain", "start_date_valid", "unique_key", "unique_key", "valid_town"]
    assert set(alerts.columns) == {"alert_type", "alert_message", "record_line", "severity", "field_name", "created_at"}


def test_approximate_distinct_is_close(spark):
    from regspark.operators.rollups import distinct_per_month

    df = spark.range(0, 20000).selectExpr("id % 7000 AS k", "CASE WHEN id % 2 = 0 THEN '2026-01' ELSE '2026-02' END AS data_version")
    exact = {r.data_version: r.distinct_companies for r in distinct_per_month(df, "k").collect()}
    approx = {r.data_version: r.distinct_companies for r in distinct_per_month(df, "k", approximate=True).collect()}
    assert exact == {"2026-01": 3500, "2026-02": 3500}
    assert all(abs(approx[m] - exact[m]) / exact[m] < 0.05 for m in exact)


def test_unique_key_rule_groups_null_keys(spark):
    from regspark.operators.quality import unique_key_rule

    df = spark.createDataFrame([(None, "a"), (None, "b"), ("1", "c"), ("2", "d"), ("2", "e")],
                               "k string, v string")
    got = {r.v: r.unique_key for r in unique_key_rule(df, ["k"]).collect()}
    assert got == {"a": False, "b": False, "c": True, "d": False, "e": False}
    one_null = spark.createDataFrame([(None, "a"), ("1", "b")], "k string, v string")
    assert {r.v: r.unique_key for r in unique_key_rule(one_null, ["k"]).collect()} == {"a": True, "b": True}
