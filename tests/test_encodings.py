"""Folders of files in different encodings."""

from __future__ import annotations

import os

from regspark.sources.encodings import choose_file_encodings, read_bronze_mixed, scan_mixed_lines


def _write(folder, files):
    os.makedirs(folder, exist_ok=True)
    for name, raw in files.items():
        with open(f"{folder}/{name}", "wb") as fh:
            fh.write(raw)
    return folder


FILES = {
    "utf8.csv": "01;São Paulo – é\n02;ação\n".encode(),
    "bom.csv": b"\xef\xbb\xbf" + "03;Água\n".encode(),
    "win.csv": "04;São “x” €\n\n05;plain\n".encode("cp1252"),
    "latin.csv": "06;Ação\x81\n".encode("latin-1"),
    "ascii.csv": b"07;plain\n",
    "long.csv": b"08;" + ("é" * 200_000).encode("latin-1") + b"\n",
    "empty.csv": b"",
}


def test_every_file_by_its_own_encoding(spark, workdir):
    base = _write(f"{workdir}/in 1", FILES)
    rows, choices = read_bronze_mixed(spark, f"{base}/*.csv", "paises", "2026-03")
    got = {r.codigo: r for r in rows.collect()}
    assert {k: got[k].descricao for k in ("01", "02", "03", "04", "05", "06", "07")} == {
        "01": "São Paulo – é", "02": "ação", "03": "Água", "04": "São “x” €", "05": "plain", "06": "Ação\x81", "07": "plain"}
    assert got["08"].descricao == "é" * 200_000 and len(got) == 8
    assert not any("�" in (r.descricao or "") for r in got.values())
    chosen = {os.path.basename(r.file_path): (r.encoding, r.decode_errors) for r in choices.collect()}
    assert chosen == {"utf8.csv": ("utf-8-sig", 0), "bom.csv": ("utf-8-sig", 0), "win.csv": ("cp1252", 0),
                      "latin.csv": ("latin1", 0), "ascii.csv": ("utf-8-sig", 0), "long.csv": ("cp1252", 0)}
    assert {r.source_file for r in got.values()} == {r.file_path for r in choices.collect()}  # lineage and audit agree


def test_choices_reach_the_scan_without_shuffling_lines(spark, workdir):
    base = _write(f"{workdir}/in", FILES)
    lines = scan_mixed_lines(spark, [base], choose_file_encodings(spark, [base]))
    plan = lines._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_a_file_without_a_choice_is_latin1_and_empty_folders_give_no_rows(spark, workdir):
    base = _write(f"{workdir}/in", {"a.csv": "1;é\n".encode("latin-1")})
    choices = choose_file_encodings(spark, [base])
    _write(base, {"b.csv": "2;ã\n".encode("latin-1")})
    assert {r[0] for r in scan_mixed_lines(spark, [base], choices).collect()} == {"1;é", "2;ã"}
    empty = _write(f"{workdir}/none", {"a.csv": b""})
    rows, choices = read_bronze_mixed(spark, [empty], "paises", "2026-03")
    assert rows.count() == 0 and choices.count() == 0
