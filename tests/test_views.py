"""The five views on small registry fixtures over two months."""

from __future__ import annotations

import pytest

from regspark.layouts import LAYOUTS
from regspark.plans import views


def _frame(spark, dataset, rows, month):
    cols = LAYOUTS[dataset]
    full = []
    for r in rows:
        rec = {c: None for c in cols}
        rec.update(r)
        full.append(tuple(rec[c] for c in cols) + (month, month))
    schema = ", ".join(f"{c} string" for c in cols) + ", dataset_month string, data_version string"
    return spark.createDataFrame(full, schema)


def _union(spark, dataset, per_month):
    out = None
    for month, rows in per_month.items():
        df = _frame(spark, dataset, rows, month)
        out = df if out is None else out.unionByName(df)
    return out


@pytest.fixture(scope="module")
def tables(spark):
    m1, m2 = "2026-03", "2026-04"
    return {
        "empresas": _union(spark, "empresas", {
            m1: [
                {"cnpj_basico": "A", "razao_social": "ALFA"},
                {"cnpj_basico": "B", "razao_social": "BETA"},
                {"cnpj_basico": "C", "razao_social": "GAMA"},
                {"cnpj_basico": "D", "razao_social": "DELTA 2"},   # duplicate company rows
                {"cnpj_basico": "D", "razao_social": "DELTA 1"},
            ],
            m2: [{"cnpj_basico": "A", "razao_social": "ALFA NOVA"}],
        }),
        "estabelecimentos": _union(spark, "estabelecimentos", {
            m1: [
                # A: two branches, head office flag on the second.
                {"cnpj_basico": "A", "cnpj_ordem": "0001", "cnpj_dv": "10",
                 "identificador_matriz_filial": "2", "uf": "SP", "municipio": "7107",
                 "cnae_fiscal_principal": "4711"},
                {"cnpj_basico": "A", "cnpj_ordem": "0002", "cnpj_dv": "20",
                 "identificador_matriz_filial": "1", "uf": "RJ", "municipio": "6001",
                 "cnae_fiscal_principal": "9999", "motivo_situacao_cadastral": "01"},
                # B: only filial branches -> lowest cnpj_ordem; unknown town, NULL activity.
                {"cnpj_basico": "B", "cnpj_ordem": "0005", "cnpj_dv": "55",
                 "identificador_matriz_filial": "2", "uf": "MG", "municipio": "0000"},
                {"cnpj_basico": "B", "cnpj_ordem": "0003", "cnpj_dv": "33",
                 "identificador_matriz_filial": "2", "uf": "BA", "municipio": "0000"},
                {"cnpj_basico": "D", "cnpj_ordem": "0001", "cnpj_dv": None,
                 "identificador_matriz_filial": "1", "uf": "PR", "municipio": "7107"},
            ],
            m2: [
                {"cnpj_basico": "A", "cnpj_ordem": "0009", "cnpj_dv": "90",
                 "identificador_matriz_filial": "1", "uf": "AM", "municipio": "7107",
                 "cnae_fiscal_principal": "4711"},
            ],
        }),
        "socios": _union(spark, "socios", {
            m1: [
                {"cnpj_basico": "A", "nome_socio": "S1", "qualificacao_socio": "49", "pais": "105"},
                {"cnpj_basico": "A", "nome_socio": "S2", "qualificacao_socio": "22", "pais": None},
            ],
            m2: [{"cnpj_basico": "A", "nome_socio": "S1", "qualificacao_socio": "49", "pais": "105"}],
        }),
        "municipios": _union(spark, "municipios", {
            m1: [{"codigo": "7107", "descricao": "SAO PAULO"}, {"codigo": "6001", "descricao": "RIO"}],
            m2: [{"codigo": "7107", "descricao": "SAO PAULO (NOVO)"}],
        }),
        "cnaes": _union(spark, "cnaes", {
            m1: [{"codigo": "4711", "descricao": "COMERCIO"}],
            m2: [{"codigo": "4711", "descricao": "COMERCIO VAREJISTA"}],
        }),
        "motivos": _union(spark, "motivos", {m1: [{"codigo": "01", "descricao": "EXTINCAO"}]}),
        "qualificacoes": _union(spark, "qualificacoes", {m1: [{"codigo": "49", "descricao": "SOCIO-ADMINISTRADOR"}]}),
        "paises": _union(spark, "paises", {m1: [{"codigo": "105", "descricao": "BRASIL"}]}),
    }


def _by(df, *keys):
    return {tuple(r[k] for k in keys): r for r in df.collect()}


def test_v1_keeps_duplicate_companies(tables):
    v1 = views.companies_with_state(tables)
    assert len(v1.columns) == 11
    rows = v1.collect()
    assert sum(1 for r in rows if r.cnpj_basico == "D") == 2            # C20
    by = {(r.cnpj_basico, r.data_version, r.razao_social): r for r in rows}
    assert by[("A", "2026-03", "ALFA")].uf == "RJ"                      # head office wins
    assert by[("B", "2026-03", "BETA")].uf == "BA"                      # lowest cnpj_ordem
    assert by[("C", "2026-03", "GAMA")].uf is None                      # no branch
    assert by[("A", "2026-04", "ALFA NOVA")].uf == "AM"                 # C19: per month


def test_v2_company_context(tables):
    v2 = views.company_context(tables)
    assert len(v2.columns) == 21
    rows = _by(v2, "cnpj_basico", "data_version")
    assert len([k for k in rows if k[0] == "D"]) == 1                   # W2 keeps one
    assert rows[("D", "2026-03")].razao_social == "DELTA 1"
    assert rows[("A", "2026-03")].municipio_nome == "RIO"
    assert rows[("A", "2026-03")].cnae_principal_descricao is None     # code 9999 unknown
    assert rows[("A", "2026-04")].municipio_nome == "SAO PAULO (NOVO)"  # same-month list
    assert rows[("A", "2026-04")].cnae_principal_descricao == "COMERCIO VAREJISTA"
    assert rows[("B", "2026-03")].municipio_nome is None                # C18


def test_v3_branch_context(tables):
    v3 = views.branch_context(tables)
    assert len(v3.columns) == 29
    rows = _by(v3, "cnpj_basico", "cnpj_ordem", "data_version")
    r = rows[("A", "0002", "2026-03")]
    assert r.cnpj_completo == "A000220" and r.motivo_situacao_cadastral_descricao == "EXTINCAO"
    assert rows[("D", "0001", "2026-03")].cnpj_completo is None         # NULL part -> NULL id
    assert v3.count() == 6


def test_v4_partner_context(tables):
    v4 = views.partner_context(tables)
    assert len(v4.columns) == 15
    rows = _by(v4, "nome_socio", "data_version")
    assert rows[("S1", "2026-03")].qualificacao_socio_descricao == "SOCIO-ADMINISTRADOR"
    assert rows[("S1", "2026-03")].pais_nome == "BRASIL"
    assert rows[("S2", "2026-03")].pais_nome is None
    assert rows[("S1", "2026-04")].pais_nome is None                    # no list that month


def test_v5_consolidated(tables):
    v5 = views.consolidated(tables)
    assert len(v5.columns) == 17
    rows = _by(v5, "cnpj_basico", "data_version")
    assert rows[("A", "2026-03")].quantidade_socios == 2                # C21
    assert rows[("B", "2026-03")].quantidade_socios == 0
    assert rows[("A", "2026-04")].quantidade_socios == 1
    assert rows[("A", "2026-03")].cnpj_ordem == "0002"
    assert len(rows) == 5


def test_register_views(spark, tables):
    views.register_views(tables)
    n = spark.sql("SELECT count(*) FROM vw_agente_cnpj_consolidado").first()[0]
    assert n == 5


def test_publish_view_partitions_by_state(spark, tables, tmp_path):
    from regspark.sinks.lake import read_table

    root = str(tmp_path / "lake")
    res = views.publish_view(tables, "vw_empresas_com_uf", root, "2026-03")
    assert res.rows == 5
    mart = read_table(spark, root, "mart", "vw_empresas_com_uf", "2026-03")
    rj = mart.where("uf = 'RJ'")
    assert [r.cnpj_basico for r in rj.collect()] == ["A"]
    plan = rj._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "(uf#" in plan.split("PartitionFilters")[1].split("]")[0] + "]"
    assert mart.count() == 5 and mart.where("uf IS NULL").count() == 1
