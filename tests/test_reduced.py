"""Views from reduced tables bucketed on the company key."""

from __future__ import annotations

import pytest

from regspark.plans import views
from regspark.plans.keyed import REDUCED, REDUCERS, bucket_count, lake_view, publish_reduced, reduced_tables
from regspark.sinks.lake import manifest_of, publish_months, read_table
from tests.test_views import tables  # noqa: F401  (fixture)

MONTHS = ("2026-03", "2026-04")
NAMES = ["vw_empresas_com_uf", "vw_agente_empresas_contexto", "vw_agente_cnpj_consolidado"]


@pytest.fixture()
def lake(spark, tables, workdir):  # noqa: F811
    for name, df in tables.items():
        publish_months(df, workdir, "gold", name)
    return workdir


def _rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_views_from_reduced_tables_equal_views_from_gold(spark, lake, tables):  # noqa: F811
    written = {m: publish_reduced(spark, lake, m, buckets=4) for m in MONTHS}
    assert all(set(w) == set(REDUCERS) for w in written.values())
    assert written["2026-03"][views.ONE_COMPANY] == 4  # D stands twice in gold
    for name in NAMES:
        assert _rows(lake_view(spark, lake, name)) == _rows(views.VIEWS[name](tables))
    assert publish_reduced(spark, lake, MONTHS[0], buckets=4) == {}  # current: nothing is written


def test_no_exchange_on_the_company_key(spark, lake):
    publish_reduced(spark, lake, MONTHS[0], buckets=4)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in NAMES[1:]:
            reduced = _plan(lake_view(spark, lake, name, [MONTHS[0]]))
            assert "hashpartitioning(cnpj_basico" not in reduced and "Window" not in reduced
            assert "Bucketed: true" in reduced and "SelectedBucketsCount: 4 out of 4" in reduced
        plain = views.consolidated({n: read_table(spark, lake, "gold", n, MONTHS[0])
                                    for n in ("empresas", "estabelecimentos", "socios", "municipios", "cnaes")})
        assert "hashpartitioning(cnpj_basico" in _plan(plain)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_newer_gold_is_answered_from_gold(spark, lake, tables):  # noqa: F811
    publish_reduced(spark, lake, MONTHS[0], buckets=4)
    newer = tables["socios"].unionByName(tables["socios"])
    publish_months(newer, lake, "gold", "socios")
    assert set(reduced_tables(spark, lake, MONTHS[0])) == {views.ONE_COMPANY, views.ONE_BRANCH}
    expected = views.consolidated({**tables, "socios": newer})
    assert _rows(lake_view(spark, lake, NAMES[2])) == _rows(expected)
    assert set(publish_reduced(spark, lake, MONTHS[0], buckets=4)) == {views.PARTNER_COUNT}
    assert _rows(lake_view(spark, lake, NAMES[2])) == _rows(expected)


def test_a_catalog_without_entries_is_filled_from_the_manifest(spark, lake, tables):  # noqa: F811
    publish_reduced(spark, lake, MONTHS[0], buckets=4)
    for name in REDUCERS:
        spark.sql(f"DROP TABLE regspark_{name}_{manifest_of(spark, lake, REDUCED, name).months[MONTHS[0]].commit}")
    assert _rows(lake_view(spark, lake, NAMES[2])) == _rows(views.consolidated(tables))


def test_a_failed_write_leaves_the_reduced_table(spark, lake, monkeypatch):
    from regspark.plans import keyed

    publish_reduced(spark, lake, MONTHS[0], buckets=4)
    before = manifest_of(spark, lake, REDUCED, views.ONE_COMPANY)

    def refuse(*args, **kwargs):
        raise OSError("no manifest")

    monkeypatch.setattr(keyed, "commit", refuse)
    with pytest.raises(OSError):
        publish_reduced(spark, lake, MONTHS[0], buckets=8)
    assert manifest_of(spark, lake, REDUCED, views.ONE_COMPANY) == before
    assert reduced_tables(spark, lake, MONTHS[0])[views.ONE_COMPANY].count() == 4


def test_bucket_counts_are_powers_of_two():
    assert [bucket_count(n) for n in (0, 1, 8_000_000, 60_000_000)] == [8, 8, 16, 64]
