"""The five consumption views over the gold tables, as DataFrame functions.

``tables`` maps dataset name -> gold DataFrame (with ``dataset_month`` and
``data_version``). All joins are LEFT joins on (key, data_version) from the
fact side. The windows, the partner count and the company/branch join all
partition on (cnpj_basico, data_version), so Spark reuses one hash
partitioning for them; code lists are plain lookups that start no job.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regspark.functions.cleanse import full_id
from regspark.operators.lookup import attach, lookup
from regspark.operators.preferred import flag_first, preferred_row

KEY = ["cnpj_basico", "data_version"]
# Fixed value: head-office flag of a branch.
HEAD_OFFICE = "1"

Tables = Mapping[str, DataFrame]

# Reduced tables: one row per company and month, under these names of ``tables``.
ONE_COMPANY, ONE_BRANCH, PARTNER_COUNT = "one_company", "one_branch", "partner_count"

STATE_BRANCH = ["uf", "municipio"]
CONTEXT_COMPANY = [
    "razao_social", "natureza_juridica", "qualificacao_responsavel", "capital_social",
    "porte_empresa", "ente_federativo_responsavel", "dataset_month",
]
CONTEXT_BRANCH = [
    "identificador_matriz_filial", "nome_fantasia", "situacao_cadastral",
    "data_inicio_atividade", "uf", "municipio", "cnae_fiscal_principal", "ddd1",
    "telefone1", "correio_eletronico",
]
CONSOLIDATED_COMPANY = ["razao_social", "natureza_juridica", "porte_empresa", "dataset_month"]
CONSOLIDATED_BRANCH = [
    "cnpj_ordem", "cnpj_dv", "identificador_matriz_filial", "nome_fantasia",
    "situacao_cadastral", "uf", "municipio", "cnae_fiscal_principal",
]


BRANCH_ORDER = ["identificador_matriz_filial", "cnpj_ordem", "cnpj_dv"]


def preferred_branches(branches: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per company and month, the head office first, then the lowest
    cnpj_ordem, cnpj_dv (nulls last), then the wanted columns.

    Only the key, the order columns and ``columns`` are read and sorted."""
    wanted = list(dict.fromkeys([*KEY, *BRANCH_ORDER, *columns]))
    first = preferred_row(
        branches.select(*wanted), KEY,
        [flag_first("identificador_matriz_filial", HEAD_OFFICE), "cnpj_ordem", "cnpj_dv"],
    )
    return first.select(*KEY, *columns)


def preferred_companies(companies: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One company row per key and month, first by razao_social, then the wanted columns."""
    wanted = list(dict.fromkeys([*KEY, "razao_social", *columns]))
    return preferred_row(companies.select(*wanted), KEY, ["razao_social"]).select(*KEY, *columns)


def partner_counts(partners: DataFrame) -> DataFrame:
    """Partners per company and month (map-side partial count)."""
    return partners.groupBy(*KEY).agg(F.count(F.lit(1)).alias("quantidade_socios"))


def _companies(t: Tables, columns: Sequence[str]) -> DataFrame:
    return t[ONE_COMPANY].select(*KEY, *columns) if ONE_COMPANY in t else preferred_companies(t["empresas"], columns)


def _branches(t: Tables, columns: Sequence[str]) -> DataFrame:
    return t[ONE_BRANCH].select(*KEY, *columns) if ONE_BRANCH in t else preferred_branches(t["estabelecimentos"], columns)


def _partners(t: Tables) -> DataFrame:
    return t[PARTNER_COUNT] if PARTNER_COUNT in t else partner_counts(t["socios"])


def _code(fact: DataFrame, dim: DataFrame, code_col: str, out: str) -> DataFrame:
    """Description of ``code_col`` from a code list of the same month."""
    return lookup(fact, dim, {code_col: "codigo", "data_version": "data_version"},
                  {"descricao": out})


def companies_with_state(t: Tables) -> DataFrame:
    """V1: every company row (no W2) with its preferred branch's state and town."""
    est = _branches(t, STATE_BRANCH)
    emp = t["empresas"]
    out = attach(emp, est, KEY)
    return out.select(
        "cnpj_basico", "razao_social", "natureza_juridica", "qualificacao_responsavel",
        "capital_social", "porte_empresa", "ente_federativo_responsavel", "uf", "municipio",
        "dataset_month", "data_version",
    )


def company_context(t: Tables) -> DataFrame:
    """V2: one row per company and month with branch, town and activity text."""
    out = attach(_companies(t, CONTEXT_COMPANY), _branches(t, CONTEXT_BRANCH), KEY)
    out = _code(out, t["municipios"], "municipio", "municipio_nome")
    out = _code(out, t["cnaes"], "cnae_fiscal_principal", "cnae_principal_descricao")
    return out.select(
        "cnpj_basico", "razao_social", "natureza_juridica", "qualificacao_responsavel",
        "capital_social", "porte_empresa", "ente_federativo_responsavel",
        "identificador_matriz_filial", "nome_fantasia", "situacao_cadastral",
        "data_inicio_atividade", "uf", F.col("municipio").alias("municipio_codigo"),
        "municipio_nome", "cnae_fiscal_principal", "cnae_principal_descricao", "ddd1",
        "telefone1", "correio_eletronico", "dataset_month", "data_version",
    )


def branch_context(t: Tables) -> DataFrame:
    """V3: one row per branch with full id, reason, activity and town text."""
    est = t["estabelecimentos"].withColumn(
        "cnpj_completo", full_id("cnpj_basico", "cnpj_ordem", "cnpj_dv")
    )
    out = _code(est, t["motivos"], "motivo_situacao_cadastral",
                "motivo_situacao_cadastral_descricao")
    out = _code(out, t["cnaes"], "cnae_fiscal_principal", "cnae_principal_descricao")
    out = _code(out, t["municipios"], "municipio", "municipio_nome")
    return out.select(
        "cnpj_basico", "cnpj_ordem", "cnpj_dv", "cnpj_completo", "identificador_matriz_filial",
        "nome_fantasia", "situacao_cadastral", "data_situacao_cadastral",
        "motivo_situacao_cadastral", "motivo_situacao_cadastral_descricao",
        "data_inicio_atividade", "cnae_fiscal_principal", "cnae_principal_descricao", "uf",
        F.col("municipio").alias("municipio_codigo"), "municipio_nome", "tipo_logradouro",
        "logradouro", "numero", "complemento", "bairro", "cep", "ddd1", "telefone1", "ddd2",
        "telefone2", "correio_eletronico", "dataset_month", "data_version",
    )


def partner_context(t: Tables) -> DataFrame:
    """V4: one row per partner with qualification and country text."""
    out = _code(t["socios"], t["qualificacoes"], "qualificacao_socio",
                "qualificacao_socio_descricao")
    out = _code(out, t["paises"], "pais", "pais_nome")
    return out.select(
        "cnpj_basico", "identificador_socio", "nome_socio", "cnpj_cpf_socio",
        "qualificacao_socio", "qualificacao_socio_descricao", "data_entrada_sociedade",
        F.col("pais").alias("pais_codigo"), "pais_nome", "representante_legal",
        "nome_representante", "qualificacao_representante_legal", "faixa_etaria",
        "dataset_month", "data_version",
    )


def consolidated(t: Tables) -> DataFrame:
    """V5: one row per company and month with its preferred branch, town and
    activity text and its partner count (0 when it has none)."""
    out = attach(_companies(t, CONSOLIDATED_COMPANY), _branches(t, CONSOLIDATED_BRANCH), KEY)
    out = attach(out, _partners(t), KEY)
    out = _code(out, t["municipios"], "municipio", "municipio_nome")
    out = _code(out, t["cnaes"], "cnae_fiscal_principal", "cnae_principal_descricao")
    return out.select(
        "cnpj_basico", "razao_social", "natureza_juridica", "porte_empresa", "cnpj_ordem",
        "cnpj_dv", "identificador_matriz_filial", "nome_fantasia", "situacao_cadastral", "uf",
        F.col("municipio").alias("municipio_codigo"), "municipio_nome", "cnae_fiscal_principal",
        "cnae_principal_descricao",
        F.coalesce(F.col("quantidade_socios"), F.lit(0).cast("bigint")).alias("quantidade_socios"),
        "dataset_month", "data_version",
    )


# The published view names.
VIEWS = {
    "vw_empresas_com_uf": companies_with_state,
    "vw_agente_empresas_contexto": company_context,
    "vw_agente_estabelecimentos_contexto": branch_context,
    "vw_agente_socios_contexto": partner_context,
    "vw_agente_cnpj_consolidado": consolidated,
}


def register_views(t: Tables) -> None:
    """Register every view as a temp view of the tables' session."""
    for name, fn in VIEWS.items():
        fn(t).createOrReplaceTempView(name)


def publish_view(t: Tables, view: str, root: str, month: str,
                 cluster_by: str | None = "uf") -> "WriteResult":
    """Materialize one month of a view into the ``mart`` layer.

    The month filter reaches every input scan as a partition filter (it is a
    window partition key and a join key, so Catalyst pushes it down). The
    result is written below ``data_version=<month>/<cluster_by>=<value>/`` so
    state queries read one directory instead of recomputing the view.
    """
    from regspark.sinks.lake import publish_month

    month_tables = {k: v.where(F.col("data_version") == month) for k, v in t.items()}
    df = VIEWS[view](month_tables)
    cluster = cluster_by if cluster_by in df.columns else None
    return publish_month(df, root, "mart", view, month, cluster_by=cluster)
