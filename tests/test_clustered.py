"""Months clustered by several columns, read by any of them."""

from __future__ import annotations

import random

import pytest

from regspark.sinks.clustered import files_for, publish_clustered, read_where
from regspark.sinks.lake import TableNotFound, publish_month

MONTH, BY = "2026-03", ["uf", "municipio", "cnae"]
FILES = 32


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    out = []
    for i in range(6000):
        town = rng.randrange(200)
        uf = None if i % 500 == 0 else f"U{town // 20}"
        # a third of all rows in one town and activity
        town, cnae = (77, 4711000) if i % 3 == 0 else (town, 1000000 + 3571 * rng.randrange(300))
        out.append((f"{i:08d}", uf, f"{town:04d}", str(cnae)))
    return out


@pytest.fixture(scope="module")
def lake(spark, rows, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("clustered"))
    df = spark.createDataFrame(rows, "id string, uf string, municipio string, cnae string")
    assert publish_clustered(df, root, "gold", "t", MONTH, BY, files=FILES).rows == len(rows)
    return root


@pytest.mark.parametrize("column, value, at_most", [
    ("uf", "U3", 12), ("municipio", "0150", 12), ("cnae", str(1000000 + 3571 * 100), 14), ("municipio", "9999", 0), ("uf", None, FILES)])
def test_each_column_skips_files(spark, lake, rows, column, value, at_most):
    k = 1 + BY.index(column)
    expected = {r for r in rows if r[k] == value}
    got = read_where(spark, lake, "gold", "t", MONTH, {column: value})
    assert {(r.id, r.uf, r.municipio, r.cnae) for r in got.collect()} == expected
    assert got.count() == len(expected) and {r.data_version for r in got.collect()} <= {MONTH}
    files = files_for(spark, lake, "gold", "t", MONTH, {column: value})
    assert len(files) <= at_most
    if files:
        assert len(got.inputFiles()) == len(files)


def test_two_columns_skip_more(spark, lake, rows):
    one = files_for(spark, lake, "gold", "t", MONTH, {"municipio": "0150"})
    two = files_for(spark, lake, "gold", "t", MONTH, {"municipio": "0150", "cnae": rows[1][3]})
    assert len(two) < len(one)


def test_a_hot_cell_is_spread(spark, lake):
    hot = read_where(spark, lake, "gold", "t", MONTH, {"municipio": "0077", "cnae": "4711000"})
    sizes = [r["count"] for r in hot.selectExpr("input_file_name() AS f").groupBy("f").count().collect()]
    assert sum(sizes) == 2000 and max(sizes) < 600


def test_a_month_with_a_newer_version_is_read_whole(spark, rows, workdir):
    workdir += "/lake of 1 %20"
    df = spark.createDataFrame(rows[:300], "id string, uf string, municipio string, cnae string")
    publish_clustered(df, workdir, "gold", "t", MONTH, BY, files=4)
    assert read_where(spark, workdir, "gold", "t", MONTH, {"uf": "U3"}).count() == sum(r[1] == "U3" for r in rows[:300])
    publish_month(df.where("id < '00000010'"), workdir, "gold", "t", MONTH)
    assert files_for(spark, workdir, "gold", "t", MONTH, {"uf": "U3"}) is None
    assert read_where(spark, workdir, "gold", "t", MONTH, {}).count() == 10
    publish_clustered(df.where("false"), workdir, "gold", "t", MONTH, BY)
    assert read_where(spark, workdir, "gold", "t", MONTH, {"uf": "U3"}).count() == 0
    with pytest.raises(TableNotFound):
        read_where(spark, workdir, "gold", "t", "2026-04", {"uf": "U3"})
