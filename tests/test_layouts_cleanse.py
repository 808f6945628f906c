"""Layouts, aliases and the column rules (cases C4-C8, C10, C12-C14)."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from regspark.functions.cleanse import (
    full_id, null_marker, parse_date, parse_money, strip_replacement, tidy,
)
from regspark.layouts import LAYOUTS, dataset_spec


def test_dataset_specs():
    for asked, name in {"empresa": "empresas", "SOCIOS": "socios", " Municipio ": "municipios", "pais": "paises",
                        "qualificacao": "qualificacoes", "Outro": "outro", None: ""}.items():
        assert dataset_spec(asked).name == name
    est = dataset_spec("estabelecimento")
    assert len(est.layout) == 32 and est.layout[-2:] == ("extra_col_1", "extra_col_2")
    assert est.keys == ("cnpj_basico", "cnpj_ordem", "cnpj_dv") and not est.code_list
    unknown = dataset_spec("desconhecido")
    assert unknown.layout == unknown.keys == () and dataset_spec("paises").code_list
    assert len(LAYOUTS["socios"]) == 11 and len(LAYOUTS["empresas"]) == 7
    assert dataset_spec("socios").keys[0] == "cnpj_basico" and len(dataset_spec("socios").keys) == 6
    assert dataset_spec("empresas").money == ("capital_social",)


def _col(spark, values, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("v"))).collect()]


def test_null_markers(spark):
    values = ["", "   ", "null", "N/A", "na", "NaN", "nao aplicavel", "não aplicável",
              "NÃO APLICÁVEL", " x ", None]
    out = _col(spark, values, null_marker)
    assert out == [None] * 9 + ["x", None]


def test_tidy_trims_then_removes_quotes(spark):
    out = _col(spark, [' "ACME LTDA" ', "'JOAO'", ' " ACME " ', ' 01 ', ' "Comercio" ', '""'], tidy)
    assert out == ["ACME LTDA", "JOAO", " ACME ", "01", "Comercio", ""]


def test_money(spark):
    values = ["0,00", "120000,00", "1.234.567,89", '"45,10"', "1.234.567", "12-3",
              "1234.567", "99999999999999999,00", "R$ 1.000,50", None]
    out = _col(spark, values, parse_money)
    assert out == [
        Decimal("0.00"), Decimal("120000.00"), Decimal("1234567.89"), Decimal("45.10"),
        None, None, Decimal("1234.57"), None, Decimal("1000.50"), None,
    ]


def test_dates(spark):
    values = ["18991231", "20260315", "00000000", "20200231", "2020-01-01", "20200101x", "2020101", None]
    out = _col(spark, values, parse_date)
    assert out == [dt.date(1899, 12, 31), dt.date(2026, 3, 15), None, None, None, None, None, None]


def test_strip_replacement_and_full_id(spark):
    assert _col(spark, ["Com\ufffdrcio", "ok"], strip_replacement) == ["Comrcio", "ok"]
    df = spark.createDataFrame([("12345678", "0001", "95"), ("1", None, "2")], "a string, b string, c string")
    out = [r[0] for r in df.select(full_id("a", "b", "c")).collect()]
    assert out == ["12345678000195", None]


def test_markers_in_every_spelling_and_dedup_sorted_by_one_number(spark):
    from regspark.functions.cleanse import NULL_MARKERS, null_marker
    from regspark.operators.preferred import dedup

    cells = [s for m in NULL_MARKERS for s in (m, m.lower(), m.title(), f"  {m} ", m + "x")] + ["N", "n", "", " ", "nb", "x", None]
    df = spark.createDataFrame([(k, c) for k, c in enumerate(cells)], "k int, c string")
    want = {k: None if c is None or c.strip(" ") == "" or c.strip(" ").upper() in NULL_MARKERS else c.strip(" ") for k, c in enumerate(cells)}
    marked = df.select("k", null_marker("c").alias("c"))
    assert {r.k: r.c for r in marked.collect()} == want
    # usual spellings are looked up without a copy in upper case
    assert marked._jdf.queryExecution().optimizedPlan().toString().count("INSET") == 2

    rows = [("a", None, 2, "y"), ("a", None, 1, "z"), ("a", "b", 1, "z"), (None, None, 3, "q"), (None, None, 3, None), ("a", "b", 1, "z")]
    kept = dedup(spark.createDataFrame(rows, "a string, b string, n int, t string"), ["a", "b"])
    assert kept.columns == ["a", "b", "n", "t"]
    assert sorted(map(tuple, kept.collect()), key=str) == sorted([("a", None, 1, "z"), ("a", "b", 1, "z"), (None, None, 3, "q")], key=str)
    # the sorts compare a number before the keys
    sorts = [line for line in kept._jdf.queryExecution().executedPlan().toString().splitlines() if "Sort [" in line]
    assert sorts and all(line.split("Sort [")[1].startswith("__key_hash") for line in sorts)
    only_keys = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    assert dedup(only_keys, ["k"]).count() == 2
