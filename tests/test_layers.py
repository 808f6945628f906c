"""Text ingest and the three layers on generated ``;`` files."""

from __future__ import annotations

import os
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import write_lines
from regspark.operators.quality import QualityGateError
from regspark.plans.layers import gold_frame, reingest_month, run_month, silver_frame
from regspark.sinks.lake import drop_month, publish_month, read_table
from regspark.sinks.mart import jdbc_options, mart_projection, replace_month
from regspark.sources.text import choose_encoding, read_bronze, resolve_sources


def test_code_list_bronze_month_columns(spark, workdir):
    src = write_lines(f"{workdir}/in/Cnaes.txt", ["01;Comercio"])
    df, _ = read_bronze(spark, src, "cnaes", "2026-03")
    row = df.first()
    assert (row.codigo, row.descricao) == ("01", "Comercio")
    assert row.dataset_month == row.data_version == "2026-03"
    assert row.source_file == "Cnaes.txt" and row.file_type == "cnaes"
    assert row._layout_status == "ok"


def test_company_bronze_row(spark, workdir):
    src = write_lines(f"{workdir}/in/Empresas.txt", ['123;" ACME LTDA ";2062;49;120000,00;01;'])
    df, _ = read_bronze(spark, src, "empresa", "2026-03")
    row = df.first()
    assert row.cnpj_basico == "123"
    assert row.razao_social == "ACME LTDA"          # CSV quotes stripped, then trimmed
    assert row.capital_social == "120000,00"        # still text in bronze
    assert row.ente_federativo_responsavel is None
    assert (row._column_count, row._layout_expected, row._layout_status) == (7, 7, "ok")


def test_short_branch_line_is_padded(spark, workdir):
    fields = ['"{}"'.format(i) for i in range(30)]
    src = write_lines(f"{workdir}/in/Estabele.txt", [";".join(fields)])
    df, _ = read_bronze(spark, src, "estabelecimentos", "2026-03")
    row = df.first()
    assert row.extra_col_1 is None and row.extra_col_2 is None
    assert (row._column_count, row._layout_expected, row._layout_status) == (30, 32, "mismatch")


def test_every_row_has_its_own_width(spark, workdir):
    first = "1;ACME;2062"
    full = '2;"BETA;B";2062;49;"10,00";01;'
    long = "3;GAMA;1;2;3,00;05;;x;y"
    src = write_lines(f"{workdir}/rw/Empresas.txt", [first, full, "", long])
    df, _ = read_bronze(spark, src, "empresas", "2026-03")
    rows = {r.cnpj_basico: r for r in df.collect()}
    assert {k: (r._column_count, r._layout_status) for k, r in rows.items()} == {
        "1": (3, "mismatch"), "2": (7, "ok"), "3": (9, "mismatch")}
    # the short first line costs the others nothing
    assert rows["2"].capital_social == "10,00" and rows["2"].porte_empresa == "01" and rows["2"].razao_social == "BETA;B"


def test_very_long_quoted_fields(spark, workdir):
    big = "x;" * 500_000
    lines = [f'1;"{big}";2062;49;"10,00";01;', f'2;"A ""{big}"" B";1;2;3,00;05;', f'3;"open;{big}']
    src = write_lines(f"{workdir}/big/Empresas.txt", lines)
    df, _ = read_bronze(spark, src, "empresas", "2026-03")
    rows = {r.cnpj_basico: r for r in df.collect()}
    assert rows["1"].razao_social == big and rows["2"].razao_social == f'A "{big}" B'
    assert [rows[k]._column_count for k in "123"] == [7, 7, 500_003]
    assert [rows[k]._layout_status for k in "123"] == ["ok", "ok", "mismatch"]


def test_stream_and_batch_give_equal_rows(spark, workdir):
    from regspark.streaming.archive import ingest_available

    lines = ["1;Com\ufffdrcio", "2", "3;x;y", '4;"a;b"', "5;N/A"]
    write_lines(f"{workdir}/sb/in/Cnaes.txt", lines, encoding="utf-8")
    batch, _ = read_bronze(spark, f"{workdir}/sb/in/Cnaes.txt", "cnaes", "2026-03", encoding="latin1")
    ingest_available(spark, f"{workdir}/sb/in", "cnaes", "2026-03", f"{workdir}/sb/out", f"{workdir}/sb/ckpt")
    strip = lambda df: sorted((tuple(r) for r in df.drop("ingestion_ts").collect()), key=str)
    stream = spark.read.parquet(f"{workdir}/sb/out").select(batch.columns)
    assert strip(batch) == strip(stream) and len(strip(batch)) == 5


def test_unknown_dataset_generic_names(spark, workdir):
    src = write_lines(f"{workdir}/in/x.txt", ["a;b;c"])
    df, _ = read_bronze(spark, src, "simples", "2026-03")
    assert df.columns[:4] == ["col_1", "col_2", "col_3", "_column_count"]


def test_source_selection(spark, workdir):
    write_lines(f"{workdir}/b/K3241.EMPRECSV", ["1;x"])
    write_lines(f"{workdir}/b/.hidden", ["1;x"])
    with open(f"{workdir}/b/pack.zip", "wb") as fh:
        fh.write(b"PK")
    files = resolve_sources(spark, f"{workdir}/none/*.txt|{workdir}/b/*")
    assert [os.path.basename(f) for f in files] == ["K3241.EMPRECSV"]
    with pytest.raises(FileNotFoundError):
        resolve_sources(spark, f"{workdir}/none/*|{workdir}/none2/*")
    write_lines(f"{workdir}/c/Empresas 01%.txt", ['7;"X";1;1;1,00;01;'])
    write_lines(f"{workdir}/c/Empresas [2].txt", ['8;"Y";1;1;1,00;01;'])
    df, _ = read_bronze(spark, f"{workdir}/c/*.txt", "empresas", "2026-03")
    assert sorted(r.cnpj_basico for r in df.collect()) == ["7", "8"]


def test_encoding_choice_for_code_lists(spark, workdir):
    src = write_lines(f"{workdir}/enc/Paises.txt", ["105;BRASIL", "023;ALEMANHA", "160;ÇATALÃO"],
                      encoding="latin-1")
    choice = choose_encoding(spark, [src], "paises", default="utf-8")
    assert (choice.from_encoding, choice.to_encoding, choice.bad_before) == ("utf-8", "latin1", 1)
    assert choose_encoding(spark, [src], "paises", default="latin1").to_encoding == "latin1"
    # valid windows-1252 stays; its undefined bytes switch; cells count, not lines
    good = write_lines(f"{workdir}/enc/Good.txt", ["1;CAFÉ – €", "2;x"], encoding="cp1252")
    assert choose_encoding(spark, [good], "paises", default="cp1252").to_encoding == "cp1252"
    df, _ = read_bronze(spark, good, "paises", "2026-03", encoding="cp1252")
    assert sorted(r.descricao for r in df.collect()) == ["CAFÉ – €", "x"]
    bad = write_lines(f"{workdir}/enc/Bad.txt", ["\x81;\x8d", "2;x"])
    choice = choose_encoding(spark, [bad], "paises", default="cp1252")
    assert (choice.to_encoding, choice.bad_before) == ("latin1", 2)
    df, _ = read_bronze(spark, src, "paises", "2026-03", encoding="utf-8")
    assert sorted(r.descricao for r in df.collect()) == ["ALEMANHA", "BRASIL", "ÇATALÃO"]


def test_encoding_audit_feeds_fallback_metrics(spark, workdir):
    from regspark.operators.runs import encoding_fallbacks
    from regspark.sinks.runlog import RunLog

    root = f"{workdir}/lake-enc"
    src = write_lines(f"{workdir}/enc2/Paises.txt", ["105;BRASIL", "160;ÇATALÃO", "161;SÃO TOMÉ"],
                      encoding="latin-1")
    res = run_month(spark, src, "paises", "2026-03", root, encoding="utf-8")
    assert res.encoding.to_encoding == "latin1"
    names = sorted(r.descricao for r in read_table(spark, root, "gold", "paises").collect())
    assert names == ["BRASIL", "SÃO TOMÉ", "ÇATALÃO"]
    fb = encoding_fallbacks(RunLog(spark, root).encoding_audit()).collect()
    assert [(r.dataset, r.from_encoding, r.to_encoding, r.switches, r.recovered_cells) for r in fb] == [
        ("paises", "utf-8", "latin1", 1, 2)]


def _empresas(workdir, name, lines):
    return write_lines(f"{workdir}/{name}/Empresas.txt", lines)


def test_three_layers_and_month_replace(spark, workdir):
    root = f"{workdir}/lake"
    src = _empresas(workdir, "m1", [
        '1;"ACME";2062;49;"1.234.567,89";01;',
        '1;"ACME SA";2062;49;"10,00";01;',           # duplicate key
        '2;\'JOAO\';2135;50;0,00;05;N/A',
    ])
    res = run_month(spark, src, "empresas", "2026-03", root)
    assert res.bronze.rows == 3 and res.silver.rows == 2 and res.gold.rows == 2
    gold = read_table(spark, root, "gold", "empresas", "2026-03")
    rows = {r.cnpj_basico: r for r in gold.collect()}
    assert rows["1"].razao_social == "ACME"        # smallest row by all columns wins
    assert rows["1"].capital_social == Decimal("1234567.89")
    assert rows["2"].razao_social == "JOAO" and rows["2"].ente_federativo_responsavel is None
    assert gold.columns[:7] == ["cnpj_basico", "razao_social", "natureza_juridica",
                                "qualificacao_responsavel", "capital_social", "porte_empresa",
                                "ente_federativo_responsavel"]
    assert set(gold.columns) >= {"dataset_month", "data_version"}
    assert "_column_count" not in gold.columns
    # Same run twice gives the same rows (deterministic dedup).
    again = run_month(spark, src, "empresas", "2026-03", root)
    assert again.gold.rows == 2
    # Another month is independent; an empty month replaces.
    src2 = _empresas(workdir, "m2", ['3;"NOVA";2062;49;1,00;01;'])
    run_month(spark, src2, "empresas", "2026-04", root)
    assert read_table(spark, root, "gold", "empresas").count() == 3
    dropped = drop_month(spark, root, "gold", "empresas", "2026-03")
    assert dropped == 2
    left = read_table(spark, root, "gold", "empresas")
    assert [r.cnpj_basico for r in left.collect()] == ["3"]
    from regspark.operators.runs import current_runs, run_rates, runs_by
    from regspark.sinks.runlog import RunLog

    states = current_runs(RunLog(spark, root).events(), ["run_id", "stage"])
    assert states.count() == 12 and run_rates(states).first().success_rate == 100.0
    by = {r.stage: r for r in runs_by(states, ["stage"]).collect()}
    assert (by["bronze"].records, by["silver"].records, by["gold"].records, by["run"].runs) == (7, 5, 5, 3)


def test_quality_gate_exact_boundary(spark, workdir):
    root = f"{workdir}/lake"
    # Two-column key, 10 rows: exactly 1 NULL first key (10 %) passes threshold 90.
    lines = [f";{i};nome;{i};49;20200101;105;;;;" for i in range(1)]
    lines += [f"{i};S{i};nome;{i};49;20200101;105;;;;" for i in range(1, 10)]
    src = write_lines(f"{workdir}/s1/Socios.txt", lines)
    res = run_month(spark, src, "socios", "2026-03", root, keys=["cnpj_basico", "identificador_socio"])
    assert res.quality["null_keys"] == 1 and res.quality["distinct_keys"] == 10
    assert res.quality["passed"] is True
    # 2 of 10 NULL (20 %) fails, and the failed month is not written.
    lines2 = [f";{i};nome;{i};49;20200101;105;;;;" for i in range(2)]
    lines2 += [f"{i};S{i};nome;{i};49;20200101;105;;;;" for i in range(2, 10)]
    src2 = write_lines(f"{workdir}/s2/Socios.txt", lines2)
    with pytest.raises(QualityGateError):
        run_month(spark, src2, "socios", "2026-04", root, keys=["cnpj_basico", "identificador_socio"])
    assert read_table(spark, root, "silver", "socios").where("data_version = '2026-04'").count() == 0
    from regspark.sinks.runlog import RunLog

    failed = RunLog(spark, root).events().where(F.col("status") == "failed").collect()
    assert sorted(r.stage for r in failed) == ["run", "silver"]
    assert all(r.error_message.startswith("QualityGateError: ") for r in failed)
    # A month that fails the gate later keeps what it had.
    with pytest.raises(QualityGateError):
        run_month(spark, src2, "socios", "2026-03", root, keys=["cnpj_basico", "identificador_socio"])
    assert read_table(spark, root, "silver", "socios", "2026-03").count() == 10
    assert len(os.listdir(f"{root}/silver/socios/data_version=2026-03")) == 1
    assert os.listdir(f"{root}/silver/socios/data_version=2026-04") == []


def test_unknown_key_raises(spark):
    df = spark.createDataFrame([("1", "1", "1"), ("1", "2", "1")], "cnpj_basico string, cnpj_ordem string, cnpj_dv string")
    with pytest.raises(ValueError, match="cnpj_ordm"):
        silver_frame(df, "estabelecimentos", ["cnpj_basico", "cnpj_ordm"])


def test_failing_write_keeps_the_old_month(spark, workdir):
    root = f"{workdir}/atomic"
    df = spark.range(5).selectExpr("string(id) AS x")
    publish_month(df, root, "gold", "t", "2026-01")
    broken = df.selectExpr("if(x = '3', raise_error('disk'), x) AS x")
    with pytest.raises(Exception, match="disk"):
        publish_month(broken, root, "gold", "t", "2026-01")
    assert read_table(spark, root, "gold", "t", "2026-01").count() == 5
    assert len(os.listdir(f"{root}/gold/t/data_version=2026-01")) == 1  # the broken write left nothing


def test_readers_see_the_old_or_the_new_month(spark, workdir):
    from regspark.sinks.lake import expire_commits, manifest_of, publish_months

    root = f"{workdir}/manifest"
    df = spark.range(6).selectExpr("string(id) AS x", "if(id < 4, '2026-01', '2026-02') AS data_version")
    publish_months(df, root, "gold", "t")
    held = read_table(spark, root, "gold", "t")  # planned before the next publish
    files = {f for f in held.inputFiles()}
    seen = []
    publish_month(df.limit(1), root, "gold", "t", "2026-01",
                  meanwhile=lambda: seen.append(read_table(spark, root, "gold", "t", "2026-01").count()))
    assert seen == [4] and read_table(spark, root, "gold", "t", "2026-01").count() == 1
    assert held.count() == 6 and set(held.inputFiles()) == files  # nothing it reads was moved
    manifest = manifest_of(spark, root, "gold", "t")
    assert manifest.version == 2 and {m: e.rows for m, e in manifest.months.items()} == {"2026-01": 1, "2026-02": 2}
    assert expire_commits(spark, root, "gold", "t") == 1
    assert read_table(spark, root, "gold", "t").count() == 3 and manifest_of(spark, root, "gold", "t") == manifest


def test_two_publishers_cannot_both_win(spark, workdir):
    from regspark.sinks.lake import PublishConflict, manifest_of

    root = f"{workdir}/race"
    df = spark.range(3).selectExpr("string(id) AS x")
    publish_month(df, root, "gold", "t", "2026-01")

    def rival(month, rows):
        done = []
        return lambda: done or done.append(publish_month(df.limit(rows), root, "gold", "t", month))

    with pytest.raises(PublishConflict):
        publish_month(df.limit(2), root, "gold", "t", "2026-01", meanwhile=rival("2026-01", 1))
    assert read_table(spark, root, "gold", "t", "2026-01").count() == 1  # the rival's
    # Another month's publisher costs a second attempt only; both months stand.
    publish_month(df.limit(2), root, "gold", "t", "2026-01", meanwhile=rival("2026-02", 3))
    assert {m: e.rows for m, e in manifest_of(spark, root, "gold", "t").months.items()} == {"2026-01": 2, "2026-02": 3}
    assert len(os.listdir(f"{root}/gold/t/data_version=2026-01")) == 3  # the loser's folder is gone


def test_manifest_file_is_created_once_and_whole(spark, workdir):
    from regspark.sinks.manifest import Folder

    place = Folder(spark, f"{workdir}/once/v1.json")
    place.fs.mkdirs(place.path.getParent())
    assert place.create_whole("a") and not place.create_whole("b") and place.read_text() == "a"
    assert [n for n in os.listdir(f"{workdir}/once") if not n.endswith(".crc")] == ["v1.json"]
    # The branch for other file systems: a rename that refuses to overwrite.
    from regspark.sinks.manifest import _no_overwrite

    context = place.jvm.org.apache.hadoop.fs.FileContext.getFileContext(place.fs.getUri(), place.conf)
    draft = Folder(spark, f"{workdir}/once/draft")
    draft.write_text("c")
    with pytest.raises(Exception, match="FileAlreadyExists"):
        context.rename(draft.path, place.path, _no_overwrite(place.jvm))
    free = Folder(spark, f"{workdir}/once/v2.json")
    context.rename(draft.path, free.path, _no_overwrite(place.jvm))
    assert free.read_text() == "c" and place.read_text() == "a"


def test_month_drop_on_a_clustered_table(spark, workdir):
    root = f"{workdir}/clustered"
    df = spark.createDataFrame([("a", "0075"), ("b", "0001"), ("c", None)], "x string, town string")
    for month in ("2026-01", "2026-02"):
        publish_month(df, root, "mart", "t", month, cluster_by="town")
    assert drop_month(spark, root, "mart", "t", "2026-01", dry_run=True) == 3
    assert drop_month(spark, root, "mart", "t", "2026-01") == 3
    back = read_table(spark, root, "mart", "t")
    assert sorted((r.x, r.town) for r in back.where("town is not null").collect()) == [("a", "0075"), ("b", "0001")]
    february = read_table(spark, root, "mart", "t", "2026-02")
    assert february.count() == 3
    one = read_table(spark, root, "mart", "t", "2026-02", {"town": "0075"}, february.schema)
    assert [tuple(r) for r in one.collect()] == [tuple(r) for r in february.where("town = '0075'").collect()] and one.count() == 1
    assert read_table(spark, root, "mart", "t", "2026-02", {"town": "none"}).count() == 0
    assert read_table(spark, root, "mart", "t", "2026-01").count() == 0


def test_no_private_folder_off_a_local_master():
    from types import SimpleNamespace as Fake

    from regspark import session

    def fake(master, named=None):
        context = Fake(master=master, getCheckpointDir=lambda: None, setCheckpointDir=lambda path: None)
        return Fake(conf=Fake(get=lambda key, default: named), sparkContext=context)

    assert session.checkpoint_root(fake("spark://host:7077", "hdfs://x/y/")) == "hdfs://x/y"
    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            session.checkpoint_root(fake(master))


def test_silver_dates_keep_raw(spark):
    bronze = spark.createDataFrame(
        [("123", "2", "nome", "x", "49", "18991231", "105", None, None, None, None)],
        ",".join(f"{c} string" for c in [
            "cnpj_basico", "identificador_socio", "nome_socio", "cnpj_cpf_socio",
            "qualificacao_socio", "data_entrada_sociedade", "pais", "representante_legal",
            "nome_representante", "qualificacao_representante_legal", "faixa_etaria"]),
    )
    row = silver_frame(bronze, "socios").first()
    assert row.data_entrada_sociedade_raw == "18991231"
    assert str(row.data_entrada_sociedade) == "1899-12-31"
    cols = silver_frame(bronze, "socios").columns
    assert cols.index("data_entrada_sociedade_raw") + 1 == cols.index("data_entrada_sociedade")


def test_gold_projection_and_mart(spark):
    df = spark.createDataFrame([("01", "Comercio", 2, "2026-03", "2026-03")],
                               "codigo string, descricao string, _column_count int, dataset_month string, data_version string")
    g = gold_frame(df, "cnaes")
    assert g.columns == ["codigo", "descricao"]
    mart = mart_projection(df, ["codigo", "descricao", "dataset_month", "data_version", "id"])
    assert mart.columns == ["codigo", "descricao", "dataset_month", "data_version"]
    with pytest.raises(ValueError):
        mart_projection(df, ["nothing"])
    opts = jdbc_options("mart.codes", {"url": "jdbc:postgresql://db/x", "user": "u",
                                       "password": "p", "driver": "org.postgresql.Driver"})
    assert opts["dbtable"] == "mart.codes" and opts["driver"] == "org.postgresql.Driver"


def test_mart_replace_deletes_before_it_appends(spark):
    """Statement order only: no database is started here."""
    df = spark.createDataFrame([("01", "2026-03")], "codigo string, data_version string")
    calls = []
    run = lambda sql, params: calls.append((sql, params))
    append = lambda out, table, conn: calls.append((table, out.columns)) or 1
    assert replace_month(df, "mart.codes", ["codigo", "data_version"], {"url": "x"}, "2026-03", run, append) == 1
    assert calls == [("DELETE FROM mart.codes WHERE dataset_month = ? OR data_version = ?", ["2026-03", "2026-03"]),
                     ("mart.codes", ["codigo", "data_version"])]
    with pytest.raises(ValueError):
        replace_month(df, "mart.codes", ["other"], {"url": "x"}, "2026-03", run, append)
    assert len(calls) == 2


def test_publish_month_empty_replaces(spark, workdir):
    root = f"{workdir}/lake2"
    df = spark.createDataFrame([("a",), ("b",)], "x string")
    assert publish_month(df, root, "gold", "t", "2026-01").rows == 2
    assert publish_month(df.limit(1), root, "gold", "t", "2026-02").rows == 1
    assert publish_month(df.where("false"), root, "gold", "t", "2026-01").rows == 0
    back = read_table(spark, root, "gold", "t")
    assert [(r.x, r.data_version) for r in back.collect()] == [("a", "2026-02")]


def test_reingest_dry_run_counts(spark, workdir):
    root = f"{workdir}/lake3"
    src = _empresas(workdir, "r1", ['9;"X";1;1;1,00;01;'])
    run_month(spark, src, "empresas", "2026-05", root, record_runs=False)
    out = reingest_month(spark, src, "empresas", "2026-05", root, dry_run=True)
    assert out["dropped"] == {"bronze": 1, "silver": 1, "gold": 1}
    out = reingest_month(spark, src, "empresas", "2026-05", root, record_runs=False)
    assert out["result"].gold.rows == 1
    with pytest.raises(FileNotFoundError):
        reingest_month(spark, f"{workdir}/none", "empresas", "2026-05", root, record_runs=False)
    assert read_table(spark, root, "gold", "empresas", "2026-05").count() == 1
    assert reingest_month(spark, src, "empresas", "2026-05", root, skip_run=True)["dropped"]["gold"] == 1
    assert read_table(spark, root, "gold", "empresas").count() == 0


def test_archive_after_gold_with_a_suffix_on_a_clash(spark, workdir):
    root, archive = f"{workdir}/lake-a", f"{workdir}/archive"
    for k in range(2):
        src = _empresas(workdir, "arch", [f'{k};"X";1;1;1,00;01;'])
        run_month(spark, src, "empresa", "2026-03", root, archive_to=archive, record_runs=False)
        assert not os.path.exists(src)
    kept = sorted(f for f in os.listdir(f"{archive}/empresas/2026-03") if not f.startswith("."))
    assert kept[0] == "Empresas.txt" and re.fullmatch(r"Empresas_\d{8}T\d{6}Z\.txt", kept[1]) and len(kept) == 2
    bad = _empresas(workdir, "arch", [';"X";1;1;1,00;01;'])
    with pytest.raises(QualityGateError):
        run_month(spark, bad, "empresas", "2026-03", root, archive_to=archive, record_runs=False)
    assert os.path.exists(bad)  # not consumed


def test_alerts_of_a_run_feed_its_summary(spark, workdir):
    from regspark.operators.quality import rule_alerts
    from regspark.operators.runs import current_runs, run_summary
    from regspark.sinks.runlog import RunLog

    log = RunLog(spark, f"{workdir}/lake-r")
    run = log.start("registry_x", "x", "f", "2026-03")
    df = spark.createDataFrame([(1, None), (2, "v")], "line long, v string")
    log.record_alerts(run, rule_alerts(df, {"required": (F.col("v").isNotNull(), "v", "CRITICAL")}, "line"))
    log.finish(run, "completed", 2)
    got = run_summary(current_runs(log.events(), ["run_id", "stage"]), log.alerts()).first()
    assert (got.status, got.alert_count, got.critical_alerts) == ("completed", 1, 1)


def test_arrivals_merge_only_touched_buckets(spark, workdir):
    from regspark.plans.layers import merge_silver, run_arrivals
    from regspark.sinks.lake import append_part, manifest_of

    root, src = f"{workdir}/inc", f"{workdir}/landing"
    first = [f'{k:08d};"NOME {k}";2062;49;1,00;01;' for k in range(200)]
    write_lines(f"{src}/Empresas1.txt", first)
    one = run_arrivals(spark, src, "empresas", "2026-03", root, buckets=16)
    assert one.gold.rows == one.silver.rows == 200 and len(one.gold.metrics["buckets"]) == 16
    old = {layer: manifest_of(spark, root, layer, "empresas").months["2026-03"] for layer in ("silver", "gold")}
    # An older name of one company, and a name that sorts after the kept one.
    write_lines(f"{src}/Empresas2.txt", ['00000007;"ALFA";2062;49;1,00;01;', '00000007;"ZETA";2062;49;1,00;01;'])
    two = run_arrivals(spark, src, "empresas", "2026-03", root, buckets=99)  # the month keeps its number of buckets
    assert two.bronze.rows == 202 and two.gold.rows == 200
    for layer in ("silver", "gold"):
        new = manifest_of(spark, root, layer, "empresas").months["2026-03"]
        changed = [b for b in new.parts if new.parts[b] != old[layer].parts[b]]
        assert len(changed) == 1 and two.silver.metrics["buckets"] == two.gold.metrics["buckets"] == changed
    rows = {r.cnpj_basico: r.razao_social for r in read_table(spark, root, "gold", "empresas", "2026-03").collect()}
    assert len(rows) == 200 and rows["00000007"] == "ALFA" and rows["00000008"] == "NOME 8"
    assert two.quality["total_rows"] == 202 and two.quality["distinct_keys"] == 200
    # Nothing new, and a replayed batch: nothing is written.
    three = run_arrivals(spark, src, "empresas", "2026-03", root)
    assert three.gold.metrics["buckets"] == [] and three.gold.rows == 200
    bronze = read_table(spark, root, "bronze", "empresas").drop("data_version")
    assert append_part(bronze, root, "bronze", "empresas", "2026-03", "batch-000000000").metrics == {"replayed": True}
    assert merge_silver(spark, "empresas", "2026-03", root)[0].metrics == {"buckets": []}
    # The same rows at once give the same gold.
    write_lines(f"{workdir}/whole/Empresas.txt", first + ['00000007;"ALFA";2062;49;1,00;01;', '00000007;"ZETA";2062;49;1,00;01;'])
    run_month(spark, f"{workdir}/whole/Empresas.txt", "empresas", "2026-03", f"{workdir}/whole-lake", record_runs=False)
    whole = read_table(spark, f"{workdir}/whole-lake", "gold", "empresas")
    assert whole.exceptAll(read_table(spark, root, "gold", "empresas")).count() == 0
    # A gate that fails leaves silver as it was; the next good call would take the batch again.
    write_lines(f"{src}/Empresas3.txt", [f';"X{k}";2062;49;1,00;01;' for k in range(3)])
    with pytest.raises(QualityGateError):
        run_arrivals(spark, src, "empresas", "2026-03", root, threshold=100)
    assert read_table(spark, root, "silver", "empresas").count() == 200


def test_run_log_starts_no_job_and_compacts_safely(spark, workdir, monkeypatch):
    from regspark.operators.runs import current_runs
    from regspark.sinks import runlog

    tracker = spark.sparkContext.statusTracker()
    log = runlog.RunLog(spark, f"{workdir}/runs")
    assert log.events().count() == 0 and log.compact() == 0
    spark.sparkContext.setJobGroup("events", "")
    run = log.start("p", "empresas", "f", "2026-03")
    with pytest.raises(ValueError), log.stage(run, "bronze"):
        raise ValueError("no 'space' left ü")
    log.finish(run, "failed", failed=1, error=RuntimeError("x" * 9000))
    assert not tracker.getJobIdsForGroup("events")
    spark.sparkContext.setJobGroup("other", "")

    def states():
        rows = current_runs(log.events(), ["run_id", "stage"]).drop("event_id").collect()
        return sorted(map(tuple, rows), key=str)

    before = states()
    assert [r.error_message for r in log.events().where("stage = 'bronze' AND status = 'failed'").collect()] == ["ValueError: no 'space' left ü"]
    assert run["started_at"] in {r.started_at for r in log.events().collect()} and log.events().count() == 4
    # Interrupted after the Parquet folder, then after its manifest entry.
    monkeypatch.setattr(runlog, "commit", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        log.compact()
    assert log.events().count() == 4 and states() == before
    monkeypatch.undo()
    monkeypatch.setattr(runlog.Folder, "delete", lambda self: 1 / 0 if "/events/" in self.path.toString() and "draft" not in self.path.toString() else self.fs.delete(self.path, True))
    with pytest.raises(ZeroDivisionError):
        log.compact()
    assert log.events().count() == 4 and states() == before  # in both places, once in the table
    monkeypatch.undo()
    log.finish(log.start("p", "socios", "g", "2026-03"), "completed", 5)
    assert log.compact() == 6 and log.compact() == 0
    assert log.events().count() == 6 and [s for s in states() if s in before] == before
