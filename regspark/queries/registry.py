"""Registered queries that run the registry code paths on the test tables.

* The five views of :mod:`regspark.plans.views` over registry-shaped gold
  tables that Spark derives from the test tables (company <- customer,
  branch <- orders, partner <- lineitem via orders, code lists <- nation /
  region).
* The full text ingest (bronze -> silver -> gold of
  :mod:`regspark.plans.layers`) over ``;``-delimited extract files that Spark
  writes from ``customer`` and ``lineitem`` into the shared scratch folder.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regspark.layouts import LAYOUTS
from regspark.plans import views
from regspark.queries.catalog import register
from regspark.queries.tables import table

# Months of the derived registry tables; single-month jobs use the first.
MONTHS = ("2026-03", "2026-04")
REGISTRY_MONTH = MONTHS[0]


def _s(c: Column) -> Column:
    return c.cast("string")


def _shape(df: DataFrame, dataset: str, values: dict[str, str], in_second_month: str) -> DataFrame:
    """Project to the dataset layout (missing columns NULL) for both months.

    ``values`` holds SQL expressions; the second month has the rows that
    ``in_second_month`` keeps. The whole projection is one selectExpr.
    """
    cols = [f"{values.get(c, 'CAST(NULL AS STRING)')} AS {c}" for c in LAYOUTS[dataset]]
    both = df.withColumn("__month", F.explode(F.array(*[F.lit(m) for m in MONTHS])))
    both = both.where(f"__month = '{MONTHS[0]}' OR ({in_second_month})")
    return both.selectExpr(*cols, "__month AS dataset_month", "__month AS data_version")


def registry_tables(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """Two months: repeated companies (W2), companies without branch or partner,
    codes that no list of the month has."""
    customer = table(spark, d, "customer")
    orders = table(spark, d, "orders")
    nation = table(spark, d, "nation")
    region = table(spark, d, "region")
    company = "lpad(CAST(c_custkey AS STRING), 8, '0')"
    people = customer.withColumn("kind", F.explode(F.expr(
        "filter(array('own', if(c_custkey % 10 = 0, 'new', NULL), if(c_custkey % 15 = 0, 'twin', NULL)), x -> x IS NOT NULL)")))
    empresas = _shape(people, "empresas", {
        "cnpj_basico": f"if(kind = 'new', concat('N', {company}), {company})",
        "razao_social": "if(kind = 'twin', concat('A ', c_name), c_name)",
        "natureza_juridica": "CAST(c_nationkey AS STRING)",
        "qualificacao_responsavel": "c_mktsegment",
        "capital_social": "CAST(c_acctbal AS DECIMAL(18, 2))",
        "porte_empresa": "'01'",
    }, "c_custkey % 3 <> 0")
    estabelecimentos = _shape(orders, "estabelecimentos", {
        "cnpj_basico": "lpad(CAST(o_custkey AS STRING), 8, '0')",
        "cnpj_ordem": "lpad(CAST(o_orderkey AS STRING), 8, '0')",
        "cnpj_dv": "lpad(CAST(o_orderkey % 97 AS STRING), 2, '0')",
        "identificador_matriz_filial": "CASE WHEN o_orderpriority = '1-URGENT' THEN '1' ELSE '2' END",
        "nome_fantasia": "o_orderpriority",
        "situacao_cadastral": "o_orderstatus",
        "data_situacao_cadastral": "CAST(o_orderdate AS DATE)",
        "motivo_situacao_cadastral": "CAST(o_orderkey % 7 AS STRING)",
        "data_inicio_atividade": "CAST(o_orderdate AS DATE)",
        "cnae_fiscal_principal": "CAST(o_custkey % 7 AS STRING)",
        "uf": "substring(o_orderstatus, 1, 1)",
        "municipio": "CAST(o_custkey % 29 AS STRING)",
        "ddd1": "'11'",
        "telefone1": "CAST(o_orderkey AS STRING)",
        "cep": "CASE WHEN o_orderkey % 13 = 0 THEN '0000-000' "
               "WHEN o_orderkey % 13 = 1 THEN concat(lpad(CAST(o_custkey AS STRING), 5, '0'), '-001') "
               "ELSE lpad(CAST(o_custkey AS STRING), 8, '0') END",
    }, "o_orderkey % 4 <> 0")
    lines = table(spark, d, "lineitem").join(
        orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    socios = _shape(lines, "socios", {
        "cnpj_basico": "lpad(CAST(o_custkey AS STRING), 8, '0')",
        "identificador_socio": "CAST(l_linenumber AS STRING)",
        "nome_socio": "concat('SOCIO ', CAST(l_suppkey AS STRING))",
        "cnpj_cpf_socio": "CAST(l_partkey AS STRING)",
        "qualificacao_socio": "CAST(l_linenumber AS STRING)",
        "data_entrada_sociedade": "CAST(l_shipdate AS DATE)",
        "pais": "CAST(l_suppkey % 30 AS STRING)",
        "faixa_etaria": "CAST(CAST(l_quantity AS INT) AS STRING)",
    }, "l_linenumber <= 2")

    def code(df: DataFrame, key: str, desc: str) -> DataFrame:
        return _shape(df, "cnaes", {"codigo": f"CAST({key} AS STRING)", "descricao": desc}, f"{key} < 20")

    return {
        "empresas": empresas,
        "estabelecimentos": estabelecimentos,
        "socios": socios,
        "municipios": code(nation, "n_nationkey", "n_name"),
        "paises": code(nation, "n_nationkey", "concat('PAIS ', n_name)"),
        "qualificacoes": code(nation, "n_nationkey", "concat('QUALIF ', n_name)"),
        "cnaes": code(region, "r_regionkey", "r_name"),
        "motivos": code(region, "r_regionkey", "concat('MOTIVO ', r_name)"),
    }


@register
def registry_companies_with_state(spark: SparkSession, d: str) -> DataFrame:
    return views.companies_with_state(registry_tables(spark, d))


@register
def registry_company_context(spark: SparkSession, d: str) -> DataFrame:
    return views.company_context(registry_tables(spark, d))


@register
def registry_branch_context(spark: SparkSession, d: str) -> DataFrame:
    return views.branch_context(registry_tables(spark, d))


@register
def registry_partner_context(spark: SparkSession, d: str) -> DataFrame:
    return views.partner_context(registry_tables(spark, d))


@register
def registry_consolidated(spark: SparkSession, d: str) -> DataFrame:
    return views.consolidated(registry_tables(spark, d))


def _reduced_lake(spark: SparkSession, d: str) -> str:
    """Gold of both months with their reduced tables; the second month's companies are published
    again afterwards, so that its reduced companies are behind their gold."""
    from regspark.plans.keyed import publish_reduced
    from regspark.session import scratch_path
    from regspark.sinks.lake import publish_month, publish_months

    root, tables = scratch_path(spark, "reduced"), registry_tables(spark, d)
    for name, rows in tables.items():
        if name == "empresas":
            publish_month(rows.where(F.col("data_version") == MONTHS[0]), root, "gold", name, MONTHS[0])
            publish_month(rows.where((F.col("data_version") == MONTHS[1]) & (F.col("cnpj_basico") > "00000100")),
                          root, "gold", name, MONTHS[1])
        else:
            publish_months(rows, root, "gold", name)
    for month in MONTHS:
        publish_reduced(spark, root, month)
    publish_month(tables["empresas"].where(F.col("data_version") == MONTHS[1]), root, "gold", "empresas", MONTHS[1])
    return root


@register
def reduced_consolidated(spark: SparkSession, d: str) -> DataFrame:
    """V5 from reduced tables bucketed on the company key."""
    from regspark.plans.keyed import lake_view

    return lake_view(spark, _reduced_lake(spark, d), "vw_agente_cnpj_consolidado")


@register
def reduced_company_context(spark: SparkSession, d: str) -> DataFrame:
    """V2 from reduced tables bucketed on the company key."""
    from regspark.plans.keyed import lake_view

    return lake_view(spark, _reduced_lake(spark, d), "vw_agente_empresas_contexto")


@register
def registry_branch_quality(spark: SparkSession, d: str) -> DataFrame:
    from regspark.plans.history import branch_scores

    t = registry_tables(spark, d)
    return branch_scores(t["estabelecimentos"], t["municipios"])


# --- text extracts derived from the test tables -------------------------------------

def _money_text(x: Column) -> Column:
    return F.translate(F.format_number(x, 2), ",.", ".,")


def company_lines(spark: SparkSession, d: str) -> DataFrame:
    """``Empresas`` extract lines from customer: quoted names, null markers,
    Brazilian money, and every company twice (the copy's name sorts later,
    so deterministic dedup keeps the original)."""
    c = table(spark, d, "customer")
    quoted = F.col("c_custkey") % 2 == 0

    def line(name: Column) -> Column:
        return F.concat_ws(
            ";",
            _s(F.col("c_custkey")),
            F.when(quoted, F.concat(F.lit('" '), name, F.lit(' "'))).otherwise(name),
            _s(F.col("c_nationkey")),
            F.when(F.col("c_custkey") % 11 == 0, F.lit("N/A")).otherwise(F.col("c_mktsegment")),
            F.when(quoted, F.concat(F.lit('"'), _money_text(F.col("c_acctbal")), F.lit('"')))
            .otherwise(_money_text(F.col("c_acctbal"))),
            F.lit("01"),
            F.lit(""),
        ).alias("value")

    main = c.select(line(F.col("c_name")))
    dups = c.select(line(F.concat(F.col("c_name"), F.lit(" LTDA"))))
    return main.unionByName(dups)


def partner_lines(spark: SparkSession, d: str) -> DataFrame:
    """``Socios`` extract lines from lineitem (one partner per line item)."""
    li = table(spark, d, "lineitem")
    return li.select(F.concat_ws(
        ";",
        _s(F.col("l_orderkey")),
        _s(F.col("l_linenumber")),
        F.concat(F.lit("SOCIO "), _s(F.col("l_suppkey"))),
        _s(F.col("l_partkey")),
        F.col("l_returnflag"),
        F.date_format("l_shipdate", "yyyyMMdd"),
        F.when(F.col("l_linestatus") == "O", F.lit("105")).otherwise(F.lit("na")),
        F.lit(""),
        F.lit(""),
        F.lit("00"),
        _s(F.col("l_quantity").cast("int")),
    ).alias("value"))


def write_landing(spark: SparkSession, lines: DataFrame, dataset: str, file_name: str) -> str:
    """Write ``lines`` as extract files (Latin-1 is a superset of this ASCII
    text) under the scratch folder; returns the folder."""
    from regspark.session import scratch_path

    base = scratch_path(spark, f"ingest-{dataset}")
    lines.write.mode("overwrite").text(f"{base}/landing/{file_name}")
    return base


def ingest_landing(spark: SparkSession, base: str, dataset: str, file_name: str) -> DataFrame:
    """Run bronze -> silver -> gold over the written files, return gold."""
    from regspark.plans.layers import run_month
    from regspark.sinks.lake import read_table

    run_month(spark, f"{base}/landing/{file_name}/part-*", dataset, REGISTRY_MONTH, f"{base}/lake")
    return read_table(spark, f"{base}/lake", "gold", dataset)


def ingest_derived(spark: SparkSession, lines: DataFrame, dataset: str, file_name: str) -> DataFrame:
    return ingest_landing(spark, write_landing(spark, lines, dataset, file_name), dataset, file_name)


@register
def text_ingest_companies(spark: SparkSession, d: str) -> DataFrame:
    return ingest_derived(spark, company_lines(spark, d), "empresas", "Empresas")


@register
def text_ingest_partners(spark: SparkSession, d: str) -> DataFrame:
    return ingest_derived(spark, partner_lines(spark, d), "socios", "Socios")


@register
def stream_ingest_companies(spark: SparkSession, d: str) -> DataFrame:
    """Available-now streaming ingest of the derived ``Empresas`` extract
    (bronze rows, duplicates kept), with archiving of consumed files."""
    from regspark.session import scratch_path
    from regspark.streaming.archive import ingest_available

    base = scratch_path(spark, "stream-empresas")
    company_lines(spark, d).write.mode("overwrite").text(f"{base}/landing/Empresas")
    ingest_available(spark, f"{base}/landing/Empresas", "empresas", REGISTRY_MONTH,
                     f"{base}/bronze", f"{base}/checkpoint", f"{base}/archive")
    return spark.read.parquet(f"{base}/bronze").select(
        *LAYOUTS["empresas"], "_layout_status", "file_type", "dataset_month", "data_version"
    )


@register
def stream_to_gold(spark: SparkSession, d: str) -> DataFrame:
    """R1 + R3: arriving files through all layers, in two calls; the second
    brings the other half and rebuilds the month from both."""
    from regspark.plans.layers import run_arrivals
    from regspark.session import scratch_path
    from regspark.sinks.lake import read_table

    base = scratch_path(spark, "arrivals")
    lines = company_lines(spark, d)
    for half in (0, 1):
        part = lines.where(F.crc32(F.col("value").cast("binary")) % 2 == half)
        part.write.mode("append").text(f"{base}/landing")
        run_arrivals(spark, f"{base}/landing", "empresas", REGISTRY_MONTH, f"{base}/lake", f"{base}/archive")
    return read_table(spark, f"{base}/lake", "gold", "empresas")


def branch_lines(spark: SparkSession, d: str) -> DataFrame:
    """``Estabelecimentos`` extract lines from orders (all 32 fields): quoted
    street names, null markers, an invalid start date for some branches."""
    o = table(spark, d, "orders")
    ymd = F.date_format("o_orderdate", "yyyyMMdd")
    fields = [
        _s(F.col("o_custkey")),
        F.lpad(_s(F.col("o_orderkey")), 8, "0"),
        F.lpad(_s(F.col("o_orderkey") % 97), 2, "0"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("1")).otherwise(F.lit("2")),
        F.col("o_orderpriority"),
        F.col("o_orderstatus"),
        ymd,
        _s(F.col("o_orderkey") % 7),
        F.lit(""),
        F.lit(""),
        F.when(F.col("o_orderkey") % 11 == 0, F.lit("00000000")).otherwise(ymd),
        _s(F.col("o_custkey") % 5),
        F.lit(""),
        F.lit("RUA"),
        F.concat(F.lit('"RUA '), _s(F.col("o_orderkey")), F.lit('"')),
        _s(F.col("o_orderkey") % 1000),
        F.lit("N/A"),
        F.lit("CENTRO"),
        F.lpad(_s(F.col("o_custkey")), 8, "0"),
        F.concat(F.lit("U"), F.lpad(_s(F.col("o_custkey") % 27), 2, "0")),
        _s(F.col("o_custkey") % 25),
        F.lit("11"),
        _s(F.col("o_orderkey")),
        F.lit(""), F.lit(""), F.lit(""), F.lit(""),
        F.lit(""),
        F.lit(""),
        F.lit(""),
        F.lit(""), F.lit(""),
    ]
    return o.select(F.concat_ws(";", *fields).alias("value"))


@register
def text_ingest_branches(spark: SparkSession, d: str) -> DataFrame:
    return ingest_derived(spark, branch_lines(spark, d), "estabelecimentos", "Estabelecimentos")


@register
def published_state_view(spark: SparkSession, d: str) -> DataFrame:
    """V1 of the first month materialized into the mart layer (partitioned by
    state) and read back whole."""
    from regspark.session import scratch_path
    from regspark.sinks.lake import read_table

    root = scratch_path(spark, "mart")
    views.publish_view(registry_tables(spark, d), "vw_empresas_com_uf", root, REGISTRY_MONTH)
    back = read_table(spark, root, "mart", "vw_empresas_com_uf", REGISTRY_MONTH)
    return back.select(
        "cnpj_basico", "razao_social", "natureza_juridica", "qualificacao_responsavel",
        "capital_social", "porte_empresa", "ente_federativo_responsavel",
        F.col("uf").cast("string").alias("uf"), "municipio", "dataset_month", "data_version",
    )


@register
def clustered_lookup(spark: SparkSession, d: str) -> DataFrame:
    """F1 on a month clustered by state, town and activity at once: the branches
    of one state, of one town and of one activity, each from the files that may hold them."""
    from regspark.session import scratch_path
    from regspark.sinks.clustered import publish_clustered, read_where
    from regspark.sinks.lake import publish_month, read_table

    root, by = scratch_path(spark, "clustered"), ["uf", "municipio", "cnae_fiscal_principal"]
    branches = registry_tables(spark, d)["estabelecimentos"].where(F.col("data_version") == REGISTRY_MONTH)
    publish_month(branches, root, "silver", "estabelecimentos", REGISTRY_MONTH)
    publish_clustered(read_table(spark, root, "silver", "estabelecimentos", REGISTRY_MONTH), root, "gold", "estabelecimentos",
                      REGISTRY_MONTH, by, files=16)
    asked = [("uf", "F"), ("municipio", "7"), ("cnae_fiscal_principal", "3")]
    parts = [read_where(spark, root, "gold", "estabelecimentos", REGISTRY_MONTH, {c: v}).select(
        F.lit(c).alias("asked"), "cnpj_basico", "cnpj_ordem", *by, "data_version") for c, v in asked]
    return parts[0].union(parts[1]).union(parts[2])


# --- replace, drop and empty on a state-partitioned mart ------------------------------

@register
def mart_replace_drop(spark: SparkSession, d: str) -> DataFrame:
    """K1/K2/K6 on a table with a second partition level: both months are
    published by town, the first is replaced by its state F, the second dropped
    and a third left empty; town codes keep their leading zeros."""
    from regspark.session import scratch_path
    from regspark.sinks.lake import drop_month, publish_month, read_table

    root = scratch_path(spark, "mart")
    branches = registry_tables(spark, d)["estabelecimentos"].select(
        "cnpj_basico", "cnpj_ordem", "uf", F.lpad("municipio", 4, "0").alias("municipio"), "data_version")
    for month in MONTHS:
        rows = branches.where(F.col("data_version") == month)
        publish_month(rows, root, "mart", "branches", month, cluster_by="municipio")
    kept = branches.where((F.col("data_version") == MONTHS[0]) & (F.col("uf") == "F"))
    written = publish_month(kept, root, "mart", "branches", MONTHS[0], cluster_by="municipio").rows
    publish_month(kept.where("false"), root, "mart", "branches", "2026-05", cluster_by="municipio")
    dropped = drop_month(spark, root, "mart", "branches", MONTHS[1])
    return read_table(spark, root, "mart", "branches").groupBy("data_version", "municipio").agg(
        F.count(F.lit(1)).alias("n_rows")).select("*", F.lit(written).alias("rows_written"), F.lit(dropped).alias("rows_dropped"))


# --- bronze audits over files that Spark writes ----------------------------------------

def _uneven_lines(spark: SparkSession, d: str) -> DataFrame:
    """Company lines of 3, 7 and 9 fields; some names are quoted cells of 100,000 characters."""
    k = F.col("c_custkey")
    name = F.when(k % 500 == 1, F.concat(F.lit('"'), F.rpad("c_name", 99_999, ";"), F.lit('."'))).otherwise(F.col("c_name"))
    short = F.concat_ws(";", _s(k), name, _s(F.col("c_nationkey")))
    full = F.concat_ws(";", short, F.lit("49"), F.lit("10,00"), F.lit("01"), F.lit('"a;b"'))
    return table(spark, d, "customer").select(
        F.when(k % 3 == 0, short).when(k % 3 == 1, full).otherwise(F.concat(full, F.lit(";x;y"))).alias("value"))


@register
def layout_audit(spark: SparkSession, d: str) -> DataFrame:
    """Every row judged by its own width, in a batch and in a stream."""
    from regspark.session import scratch_path
    from regspark.sources.text import read_bronze
    from regspark.streaming.archive import ingest_available

    base = scratch_path(spark, "audit")
    _uneven_lines(spark, d).write.text(f"{base}/landing")
    batch, _ = read_bronze(spark, f"{base}/landing/part-*", "empresas", REGISTRY_MONTH)
    ingest_available(spark, f"{base}/landing", "empresas", REGISTRY_MONTH, f"{base}/bronze", f"{base}/checkpoint")
    cols = ["cnpj_basico", "razao_social", "porte_empresa", "ente_federativo_responsavel", "_column_count",
            "_layout_expected", "_layout_status"]
    stream = spark.read.parquet(f"{base}/bronze")
    return batch.select(F.lit("batch").alias("mode"), *cols).union(stream.select(F.lit("stream").alias("mode"), *cols))


@register
def generic_columns(spark: SparkSession, d: str) -> DataFrame:
    """A dataset without a layout gets as many columns as its widest row."""
    from regspark.session import scratch_path
    from regspark.sources.text import read_bronze

    base = scratch_path(spark, "generic")
    _uneven_lines(spark, d).write.text(f"{base}/landing")
    df, _ = read_bronze(spark, f"{base}/landing/part-*", "simples", REGISTRY_MONTH)
    return df.select(*[f"col_{i}" for i in range(1, 10)], "_column_count")


@register
def source_selection(spark: SparkSession, d: str) -> DataFrame:
    """S2-S4 + P6: the first alternative with files wins, blanks in its path
    included; every row carries its file, time, type and month."""
    from regspark.session import scratch_path
    from regspark.sources.text import read_bronze

    base = scratch_path(spark, "sources")
    customer = table(spark, d, "customer")
    for folder, first in (("Paises 01 [a]", "A"), ("Paises 02", "B")):
        customer.select(F.concat_ws(";", _s(F.col("c_custkey")), F.concat(F.lit(first), "c_name")).alias("value")).write.text(f"{base}/{folder}")
    alternatives = f"{base}/none/*.CSV|{base}/Paises 01 \\[a\\]/part-*|{base}/Paises 02/part-*"
    df, _ = read_bronze(spark, alternatives, "paises", REGISTRY_MONTH)
    return df.select(
        "codigo", "descricao", "file_type", "dataset_month", "data_version",
        F.col("source_file").rlike("Paises(%20| )01.*/part-").alias("has_source"),
        (F.col("ingestion_ts") <= F.current_timestamp()).alias("has_time"))


@register
def encoding_switch(spark: SparkSession, d: str) -> DataFrame:
    """Q5 + A19: Latin-1 files read with a UTF-8 default switch; the audit counts cells."""
    from regspark.operators.runs import encoding_fallbacks
    from regspark.plans.layers import run_month
    from regspark.session import scratch_path
    from regspark.sinks.runlog import RunLog

    base = scratch_path(spark, "switch")
    accent = F.when(F.col("c_custkey") % 2 == 0, F.concat("c_name", F.lit(" é"))).otherwise(F.col("c_name"))
    code = F.when(F.col("c_custkey") % 4 == 0, F.concat(_s(F.col("c_custkey")), F.lit("ã"))).otherwise(_s(F.col("c_custkey")))
    table(spark, d, "customer").select(code.alias("a"), accent.alias("b")).write.csv(
        f"{base}/landing", sep=";", quote="", encoding="ISO-8859-1")
    run_month(spark, f"{base}/landing/part-*", "paises", REGISTRY_MONTH, f"{base}/lake", encoding="utf-8")
    return encoding_fallbacks(RunLog(spark, f"{base}/lake").encoding_audit())


def _mixed_lines(spark: SparkSession, d: str) -> DataFrame:
    """Code-list lines from customer as bytes (a text of no valid UTF-8), a third of them in each encoding."""
    kind = F.element_at(F.array(F.lit("utf"), F.lit("win"), F.lit("latin")), (F.col("c_custkey") % 3 + 1).cast("int"))
    # the sign for windows-1252 is one Latin-1 has as a control character, the one for Latin-1 is undefined in windows-1252
    line = F.concat_ws(";", _s(F.col("c_custkey")), F.concat("c_name", F.lit(" São é")))
    raw = (F.when(F.col("kind") == "utf", F.encode(F.concat("line", F.lit("€")), "UTF-8"))
           .when(F.col("kind") == "win", F.encode(F.concat("line", F.lit("\x80")), "ISO-8859-1"))
           .otherwise(F.encode(F.concat("line", F.lit("\x81")), "ISO-8859-1")))
    return table(spark, d, "customer").select(kind.alias("kind"), line.alias("line")).select("kind", raw.cast("string").alias("value"))


@register
def mixed_encoding_files(spark: SparkSession, d: str) -> DataFrame:
    """Q5 + Q2 by file: a folder of files in three encodings read in one scan, with each file's choice."""
    from regspark.session import scratch_path
    from regspark.sources.encodings import read_bronze_mixed

    base = scratch_path(spark, "mixed")
    _mixed_lines(spark, d).write.partitionBy("kind").text(base)
    rows, choices = read_bronze_mixed(spark, f"{base}/kind=*/part-*", "paises", REGISTRY_MONTH)
    rows = rows.join(choices.withColumnRenamed("file_path", "source_file"), "source_file", "left")
    return rows.select(F.regexp_extract("source_file", "kind=([^/]*)/", 1).alias("kind"), "encoding", "codigo", "descricao")


@register
def reingest_companies(spark: SparkSession, d: str) -> DataFrame:
    """K7 + K8: a month is ingested, then rebuilt from other files; a second
    month is dropped from every layer. Returns what is left, with the counts."""
    from regspark.plans.layers import reingest_month, run_month
    from regspark.session import scratch_path
    from regspark.sinks.lake import drop_month_all_layers, read_table

    base = scratch_path(spark, "reingest")
    lines = company_lines(spark, d)
    lines.write.text(f"{base}/first")
    lines.where(~F.contains("value", F.lit(" LTDA"))).write.text(f"{base}/second")
    for month in MONTHS:
        run_month(spark, f"{base}/first/part-*", "empresas", month, f"{base}/lake", record_runs=False)
    had = reingest_month(spark, f"{base}/second/part-*", "empresa", MONTHS[0], f"{base}/lake", record_runs=False)["dropped"]
    dropped = drop_month_all_layers(spark, f"{base}/lake", "empresas", MONTHS[1])
    rows = [read_table(spark, f"{base}/lake", layer, "empresas").groupBy("data_version").agg(F.count(F.lit(1)).alias("n_rows"))
            .select(F.lit(layer).alias("layer"), "data_version", "n_rows", F.lit(had[layer]).alias("had"),
                    F.lit(dropped[layer]).alias("dropped")) for layer in ("bronze", "silver", "gold")]
    return rows[0].union(rows[1]).union(rows[2])


@register
def lake_distinct_companies(spark: SparkSession, d: str) -> DataFrame:
    """A8-A10 at lake level: key sets written beside three months of two years,
    one of them behind its gold, merged into month and year counts."""
    from regspark.plans import history
    from regspark.session import scratch_path
    from regspark.sinks.lake import publish_month

    root = scratch_path(spark, "keysets")
    companies = registry_tables(spark, d)["empresas"].where(F.col("data_version") == MONTHS[0])
    for month, kept in (("2025-12", "true"), ("2026-01", "cnpj_basico LIKE '%3'"), ("2026-02", "porte_empresa = '01'")):
        publish_month(companies.where(kept), root, "gold", "empresas", month)
        history.publish_key_set(spark, root, month)
    publish_month(companies.where("cnpj_basico LIKE 'N%'"), root, "gold", "empresas", "2026-02")
    by_month = history.companies_per_year_month(spark, root)
    by_year = history.companies_per_year(spark, root)
    return by_month.unionByName(by_year.withColumn("data_version", F.lit(None).cast("string")))


def _logged_runs(spark: SparkSession, d: str) -> DataFrame:
    """Current states of two ingests' runs and stages: one's events compacted, the other's as files."""
    from regspark.operators.runs import current_runs
    from regspark.plans.layers import run_month
    from regspark.session import scratch_path
    from regspark.sinks.runlog import RunLog

    base = scratch_path(spark, "runlog")
    company_lines(spark, d).write.text(f"{base}/landing")
    log = RunLog(spark, f"{base}/lake")
    run_month(spark, f"{base}/landing/part-*", "empresas", REGISTRY_MONTH, f"{base}/lake")
    log.compact()
    run_month(spark, f"{base}/landing/part-*", "empresas", MONTHS[1], f"{base}/lake")  # its events are still files
    return current_runs(log.events(), ["run_id", "stage"])


@register
def runlog_stages(spark: SparkSession, d: str) -> DataFrame:
    """K10 + A15: runs and records by stage, dataset, status and month."""
    from regspark.operators.runs import runs_by

    by = runs_by(_logged_runs(spark, d), ["stage", "dataset", "status", "data_version"])
    return by.drop("mean_duration", "max_duration")


@register
def runlog_record_rates(spark: SparkSession, d: str) -> DataFrame:
    """K10 + A12: record-level rates by stage."""
    from regspark.operators.runs import record_rates

    return record_rates(_logged_runs(spark, d), ["stage"])


@register
def runlog_rates(spark: SparkSession, d: str) -> DataFrame:
    """K10 + A12 + A14: totals and rates of finished runs."""
    from regspark.operators.runs import run_rates

    return run_rates(_logged_runs(spark, d))
