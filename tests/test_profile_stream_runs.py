"""Encoding scorer (C22), layout profiler (C23), streaming archive (R1), run metrics."""

from __future__ import annotations

import datetime as dt
import os
import re

from pyspark.sql import functions as F

from conftest import write_lines
from regspark.operators.profile import (
    ACCENTED, TERMS, best_encoding, encoding_scores, encoding_vote, file_encodings, file_profile, folder_profile,
)
from regspark.operators.runs import (
    current_runs, duration_histogram, encoding_fallbacks, run_rates, run_summary,
)
from regspark.streaming.archive import ingest_available


def test_encoding_scorer_picks_each_file(spark, workdir):
    line = "CAFÉ;AÇÚCAR;PÃO DE AÇÚCAR;SÃO JOÃO"
    write_lines(f"{workdir}/enc/utf8.txt", [line] * 3, encoding="utf-8")
    write_lines(f"{workdir}/enc/latin.txt", [line] * 3, encoding="latin-1")
    write_lines(f"{workdir}/enc/ascii.txt", ["CAFE;ACUCAR"] * 3, encoding="ascii")
    files = spark.read.format("binaryFile").load(f"{workdir}/enc/*.txt")
    best = best_encoding(files.select(F.col("path"), F.col("content")), "content")
    got = {os.path.basename(r.path): r.encoding for r in best.collect()}
    assert got == {"utf8.txt": "utf-8", "latin.txt": "latin1", "ascii.txt": "latin1"}
    # the file-level form: whole files line by line, every candidate ranked
    ranked = file_encodings(spark.read.text(f"{workdir}/enc")).collect()
    assert len(ranked) == 12
    assert {os.path.basename(r.file_path): r.encoding for r in ranked if r.rank == 1} == got
    vote = encoding_vote(best.withColumn("g", F.lit(1)), "g").first()
    assert vote.encoding == "latin1" and vote.wins == 2


def _plain_terms(raw: bytes, encoding: str) -> tuple:
    text = raw.decode({"latin1": "latin-1", "utf-8-sig": "utf-8"}.get(encoding, encoding), errors="replace")
    errors = text.count("\ufffd")
    mojibake = len(re.findall("Ã[^\n]", text)) + len(re.findall("Â[^\n]", text)) + errors
    control, accents = (sum(c in chars for c in text) for chars in (set(map(chr, range(32))) - set("\n\r\t"), ACCENTED))
    return 100 * errors + 10 * mojibake + 5 * control - accents, errors, mojibake, control, accents


def test_encoding_terms_by_hand_and_texts_made_once(spark, workdir):
    raws = [b"", b"plain\x01\x00\x1f\t\r\n", b"\x80\x81\x8d\x8f\x90\x9d", "Ã©Â© Ã\n ÂÂ ÃÃ".encode(), "\ufeffé".encode(),
            "ação € \U0001f600".encode(), "ação".encode("latin-1"), b"\xe9", b"\xe9A\x02", b"\xc3", "\ufffdx".encode(), b"a\xc2\xa0"]
    df = spark.createDataFrame([(k, bytearray(r)) for k, r in enumerate(raws)] + [(99, None)], "k int, raw binary")
    got = {(r.k, r.encoding): (r.score, *[r[t] for t in TERMS]) for r in encoding_scores(df, "raw").collect()}
    for k, raw in [*enumerate(raws), (99, b"")]:
        for encoding in ("latin1", "cp1252", "utf-8", "utf-8-sig"):
            assert got[k, encoding] == _plain_terms(raw, encoding), (raw, encoding)
    # Every text of a line is made once and counted once; candidates are laid out after the sums by file.
    write_lines(f"{workdir}/once/a.txt", ["ação", "x"])
    plan = file_encodings(spark.read.text(f"{workdir}/once"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate") < plan.index("Aggregate") and "translate(" not in plan
    assert len(re.findall(r"\b(?:decode|StaticInvoke)\(.*?ISO-8859-1", plan)) <= 1 and plan.count("ISO-8859-1") == 1


def test_layout_profile(spark, workdir):
    write_lines(f"{workdir}/prof/a.txt", ["1;2", "3;4", "1;2;3;4;5"])
    write_lines(f"{workdir}/prof/B", ["x"])
    write_lines(f"{workdir}/prof2/a.txt", ["9;9", "8;8", "1;2;3;4;5"])  # same name and size, another file
    prof = file_profile(spark.read.text([f"{workdir}/prof", f"{workdir}/prof2"]))
    assert prof.count() == 3
    rows = {r.file_name: r for r in prof.where("folder not like '%prof2'").collect()}
    assert rows["a.txt"].first_line == "1;2"
    assert {r.folder[-5:]: (r.n_files, r.n_lines) for r in folder_profile(prof).collect()} == {"/prof": (2, 4), "prof2": (1, 3)}
    a = rows["a.txt"]
    assert (a.n_lines, a.min_fields, a.max_fields, a.distinct_fields) == (3, 2, 5, "2,5")
    assert a.extension == ".txt" and rows["B"].extension == "none"
    assert a.size_bytes == os.path.getsize(f"{workdir}/prof/a.txt")


def test_streaming_ingest_archives_files(spark, workdir):
    src = f"{workdir}/landing"
    write_lines(f"{src}/Cnaes1.txt", ["01;Comercio", "02;N/A"])
    target, ckpt, archive = f"{workdir}/bronze", f"{workdir}/ckpt", f"{workdir}/archive"
    assert ingest_available(spark, src, "cnaes", "2026-03", target, ckpt, archive) == 2
    rows = {r.codigo: r for r in spark.read.parquet(target).collect()}
    assert rows["02"].descricao is None and rows["01"].source_file == "Cnaes1.txt"
    # Nothing new: nothing re-read.
    assert ingest_available(spark, src, "cnaes", "2026-03", target, ckpt, archive) == 0
    # A new file is processed once, and the previous batch's file is archived.
    write_lines(f"{src}/Cnaes2.txt", ["03;Industria"])
    assert ingest_available(spark, src, "cnaes", "2026-03", target, ckpt, archive) == 1
    assert spark.read.parquet(target).count() == 3
    assert not os.path.exists(f"{src}/Cnaes1.txt")
    archived = [os.path.join(d, f) for d, _, fs in os.walk(archive) for f in fs]
    assert any(p.endswith("Cnaes1.txt") for p in archived)


def test_run_metrics(spark):
    t = dt.datetime(2026, 3, 1, 12, 0, 0)
    runs = spark.createDataFrame(
        [("r1", "bronze", "completed", t, t + dt.timedelta(seconds=0.4), 0.4),
         ("r2", "bronze", "failed", t, t + dt.timedelta(seconds=61.9), 61.9),
         ("r3", "silver", "completed", t, t + dt.timedelta(seconds=3600), 3600.0),
         ("r4", "silver", "completed", t, t + dt.timedelta(seconds=4000), 4000.0)],
        "run_id string, stage string, status string, started_at timestamp, "
        "finished_at timestamp, duration_seconds double",
    )
    r = run_rates(runs).first()
    assert (r.total_runs, r.successes, r.failures, r.success_rate, r.error_rate) == (4, 3, 1, 75.0, 25.0)
    empty = run_rates(runs.where("false")).first()
    assert empty.success_rate == 0.0 and empty.error_rate == 0.0
    hist = {(x.stage, x.le): x.runs_le for x in duration_histogram(runs, ["stage"]).collect()}
    assert hist[("bronze", "0.5")] == 1 and hist[("bronze", "60")] == 1 and hist[("bronze", "120")] == 2
    assert hist[("silver", "3600")] == 1 and hist[("silver", "+Inf")] == 2
    alerts = spark.createDataFrame([("r2", "CRITICAL"), ("r2", "WARNING"), ("r1", "INFO")],
                                   "run_id string, severity string")
    s = {x.run_id: x for x in run_summary(runs, alerts).collect()}
    assert (s["r2"].duration_seconds, s["r2"].alert_count, s["r2"].critical_alerts) == (61, 2, 1)
    assert s["r3"].alert_count == 0
    ev = spark.createDataFrame(
        [("r1", "running", t), ("r1", "completed", t + dt.timedelta(seconds=5)), ("r2", "running", t)],
        "run_id string, status string, event_ts timestamp")
    cur = {x.run_id: x.status for x in current_runs(ev).collect()}
    assert cur == {"r1": "completed", "r2": "running"}
    audit = spark.createDataFrame(
        [("paises", "utf-8", "latin1", 5, 0), ("paises", "utf-8", "latin1", 2, 3),
         ("cnaes", "latin1", "latin1", 0, 0)],
        "dataset string, from_encoding string, to_encoding string, bad_before int, bad_after int")
    fb = encoding_fallbacks(audit).collect()
    assert [(x.dataset, x.switches, x.recovered_cells) for x in fb] == [("paises", 2, 5)]


def test_alert_listing(spark):
    from regspark.operators.runs import alerts_by, recent_alerts

    t = dt.datetime(2026, 3, 1)
    alerts = spark.createDataFrame(
        [("unique_key", "CRITICAL", 1, t), ("cep_format", "WARNING", 2, t + dt.timedelta(seconds=1)),
         ("unique_key", "CRITICAL", 3, t + dt.timedelta(seconds=2))],
        "alert_type string, severity string, record_line long, created_at timestamp")
    assert [r.record_line for r in recent_alerts(alerts, 2).collect()] == [3, 2]
    assert [r.record_line for r in recent_alerts(alerts, 5, severity="CRITICAL").collect()] == [3, 1]
    counts = {(r.alert_type, r.severity): r.alerts for r in alerts_by(alerts).collect()}
    assert counts == {("unique_key", "CRITICAL"): 2, ("cep_format", "WARNING"): 1}
