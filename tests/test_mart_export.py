"""Staged export to a mart, against a connection that records statements and keeps rows in dictionaries."""

from __future__ import annotations

import re

import pytest

from regspark.sinks.mart import LEDGER, ExportMismatch, export_month, staging_name

COLUMNS = ["codigo", "descricao", "dataset_month", "data_version"]


class Recording:
    """As much of a DB-API connection as the export uses; ``fail_at`` raises on the first statement that starts so."""

    def __init__(self, tables):
        self.tables, self.log, self.fail_at = tables, [], None
        self.saved = self._copy()

    def _copy(self):
        return {k: [dict(r) for r in v] for k, v in self.tables.items()}

    def cursor(self):
        return self

    def close(self):
        pass

    def commit(self):
        self.log.append("COMMIT")
        self.saved = self._copy()

    def rollback(self):
        self.log.append("ROLLBACK")
        self.tables = {k: [dict(r) for r in v] for k, v in self.saved.items()}

    def execute(self, sql, params=()):
        self.log.append(sql.split(" (")[0] if sql.startswith("CREATE TABLE IF") else sql)
        if self.fail_at and sql.startswith(self.fail_at):
            self.fail_at = None
            raise OSError("connection lost")
        first, name = sql.split()[0], re.search(r"(?:TABLE IF EXISTS|TABLE IF NOT EXISTS|TABLE|FROM|INTO) ([\w.]+)", sql).group(1)
        if sql.startswith("CREATE TABLE IF"):
            self.tables.setdefault(LEDGER, [])
        elif first == "CREATE":
            assert name not in self.tables
            self.tables[name] = []
        elif first == "DROP":
            self.tables.pop(name, None)
        elif first == "DELETE":
            self.tables[name] = [r for r in self.tables[name] if params[0] not in (r["dataset_month"], r["data_version"])]
        elif sql.startswith(f"INSERT INTO {LEDGER}"):
            self.tables[LEDGER].append(dict(zip(("target", "month", "run_id", "row_count"), params)))
        elif first == "INSERT":
            self.tables[name] += self.tables[sql.rsplit(" ", 1)[1]]
        elif "COUNT(*)" in sql:
            self.answer = (len(self.tables[name]),)
        else:
            self.answer = next(((r["row_count"],) for r in self.tables[LEDGER]
                                if [r["target"], r["month"], r["run_id"]] == list(params)), None)

    def fetchone(self):
        return self.answer


@pytest.fixture()
def mart():
    old = [{"codigo": "9", "descricao": "old", "dataset_month": m, "data_version": m} for m in ("2026-02", "2026-03")]
    return Recording({"codes": old})


@pytest.fixture()
def month(spark):
    return spark.createDataFrame([(1, "a", "2026-03", "2026-03"), (2, None, "2026-03", "2026-03")],
                                 "codigo int, descricao string, dataset_month string, data_version string")


def appender(db, calls=None, twice=False):
    def append(df, table, conn):
        rows = [r.asDict() for r in df.collect()]
        db.tables[table] += rows + (rows[:1] if twice else [])  # executors have connections and commits of their own
        db.saved[table] = list(db.tables[table])
        if calls is not None:
            calls.append(table)
        return len(rows)

    return append


def run(df, db, run_id="r1", **kw):
    return export_month(df, "codes", COLUMNS, {"url": "x"}, "2026-03", run_id, db, append=appender(db, **kw))


def codes(db, month="2026-03"):
    return [r["codigo"] for r in db.tables["codes"] if r["data_version"] == month]


def test_statement_order(mart, month):
    assert run(month, mart) == 2
    stage, names = "codes__stage_r1", "codigo, descricao, dataset_month, data_version"
    assert [s for s in mart.log if not s.startswith("SELECT row_count")] == [
        f"CREATE TABLE IF NOT EXISTS {LEDGER}", f"DROP TABLE IF EXISTS {stage}",
        f"CREATE TABLE {stage} AS SELECT {names} FROM codes WHERE 1 = 0", "COMMIT",
        f"SELECT COUNT(*) FROM {stage}", "DELETE FROM codes WHERE dataset_month = ? OR data_version = ?",
        f"INSERT INTO codes ({names}) SELECT {names} FROM {stage}",
        f"INSERT INTO {LEDGER} (target, month, run_id, row_count) VALUES (?, ?, ?, ?)", "COMMIT",
        f"DROP TABLE IF EXISTS {stage}", "COMMIT"]
    assert codes(mart) == ["1", "2"] and codes(mart, "2026-02") == ["9"] and set(mart.tables) == {"codes", LEDGER}


def test_a_repeated_run_does_nothing_and_a_new_run_replaces(mart, month):
    calls = []
    assert run(month, mart, calls=calls) == 2
    assert run(month.limit(1), mart, calls=calls) == 2 and calls == ["codes__stage_r1"] and codes(mart) == ["1", "2"]
    assert run(month.where("codigo = 2"), mart, "r2", calls=calls) == 1 and codes(mart) == ["2"]
    assert run(month.where("false"), mart, "r3", calls=calls) == 0 and codes(mart) == []


@pytest.mark.parametrize("at", ["CREATE TABLE codes__stage", "SELECT COUNT", "DELETE FROM codes", "INSERT INTO codes", f"INSERT INTO {LEDGER}"])
def test_a_failure_at_any_statement_keeps_the_old_month_and_can_be_repeated(mart, month, at):
    mart.fail_at = at
    with pytest.raises(OSError):
        run(month, mart)
    assert codes(mart) == ["9"] and mart.log[-1] == "ROLLBACK" and not mart.tables.get(LEDGER)
    assert run(month, mart) == 2 and codes(mart) == ["1", "2"]


def test_a_failed_drop_of_the_staging_table_is_behind_the_published_month(mart, month):
    mart.fail_at = "DROP TABLE IF EXISTS codes__stage_r1"
    with pytest.raises(OSError):  # the first drop, before anything is staged
        run(month, mart)
    assert codes(mart) == ["9"] and run(month, mart) == 2


def test_rows_appended_twice_are_noticed(mart, month):
    with pytest.raises(ExportMismatch):
        run(month, mart, twice=True)
    assert codes(mart) == ["9"]
    assert run(month, mart) == 2 and codes(mart) == ["1", "2"]


def test_a_failed_append_keeps_the_old_month(mart, month):
    def broken(df, table, conn):
        raise OSError("executor lost")

    with pytest.raises(OSError):
        export_month(month, "codes", COLUMNS, {"url": "x"}, "2026-03", "r1", mart, append=broken)
    assert codes(mart) == ["9"]


def test_names(mart, month):
    with pytest.raises(ValueError):
        staging_name("codes", "r1; DROP TABLE codes")
    with pytest.raises(ValueError):
        export_month(month, "codes", ["other"], {"url": "x"}, "2026-03", "r1", mart)
    assert mart.log == []
