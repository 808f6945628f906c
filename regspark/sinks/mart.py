"""Export of gold tables to a relational mart over JDBC (optional).

The lake partition written by :mod:`regspark.sinks.lake` is the source of
truth; the mart is a copy. Export errors raise (they are never only logged).
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from regspark.layouts import MONTH_COLUMNS


def target_columns(spark: SparkSession, table: str, jdbc: dict[str, str] | None = None) -> list[str]:
    """Ordered column names of the target table (catalog table or JDBC)."""
    if jdbc is None:
        return spark.table(table).columns
    opts = jdbc_options(table, jdbc)
    opts.pop("dbtable")
    opts["query"] = f"SELECT * FROM {table} WHERE 1 = 0"
    return spark.read.format("jdbc").options(**opts).load().columns


def mart_projection(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """K3 + K4: what ``df`` has of the target's columns, in the target's order, as text.

    A frame that shares no column with its target is a wiring mistake and raises.
    """
    shared = [name for name in columns if name in df.columns]
    if not shared:
        raise ValueError(f"the mart table {list(columns)} and the frame {df.columns} share no column")
    return df.select(*(df[name].cast("string").alias(name) for name in shared))


def jdbc_options(table: str, conn: dict[str, str]) -> dict[str, str]:
    """Options map of a JDBC write (K5)."""
    opts = {"url": conn["url"], "dbtable": table}
    for key in ("user", "password", "driver"):
        if conn.get(key):
            opts[key] = conn[key]
    return opts


def delete_statement(table: str, month_cols: Sequence[str] = MONTH_COLUMNS, mark: str = "?") -> str:
    """Statement that removes one month from the mart (one parameter per column)."""
    return f"DELETE FROM {table} WHERE " + " OR ".join(f"{c} = {mark}" for c in month_cols)


def append_rows(df: DataFrame, table: str, conn: dict[str, str]) -> int:
    """K5: one distributed JDBC append; returns the rows it wrote."""
    obs = Observation(f"append-{table}")
    out = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    out.write.format("jdbc").options(**jdbc_options(table, conn)).mode("append").save()
    return int(obs.get.get("rows") or 0)


def replace_month(df: DataFrame, table: str, columns: Sequence[str], conn: dict[str, str], month: str,
                  execute: Callable[[str, list[str]], None],
                  append: Callable[[DataFrame, str, dict[str, str]], int] = append_rows,
                  month_cols: Sequence[str] = MONTH_COLUMNS) -> int:
    """K2 + K5 on the mart: delete the month, then append its rows; a second call gives the same mart.

    ``execute`` runs a statement with parameters on the caller's own database
    connection (any DB-API cursor's ``execute`` fits). Nothing is deleted
    when the frame does not fit the table. The delete stands alone: when the
    append may fail or be repeated, :func:`export_month` keeps the old month.
    """
    out = mart_projection(df, columns)
    execute(delete_statement(table, month_cols), [month] * len(month_cols))
    return append(out, table, conn)


# --- staged export: a failed or repeated append never shows in the mart -----------------

LEDGER = "mart_exports"
LEDGER_COLUMNS = ("target", "month", "run_id", "row_count")


class ExportMismatch(RuntimeError):
    """The staging table does not hold the rows that the job reports to have written."""


@contextmanager
def _transaction(connection):
    """One DB-API transaction: committed when the block ends, rolled back when it raises."""
    cursor = connection.cursor()
    try:
        yield cursor
        connection.commit()
    except BaseException:
        connection.rollback()
        raise
    finally:
        cursor.close()


def staging_name(table: str, run_id: str) -> str:
    """The staging table of one run; the run id becomes part of an SQL name, so it is letters, digits and ``_`` only."""
    if not re.fullmatch(r"[A-Za-z0-9_]+", run_id):
        raise ValueError(f"run id {run_id!r} is not made of letters, digits and underscores")
    return f"{table}__stage_{run_id}"


def exported_rows(cursor, table: str, month: str, run_id: str, mark: str = "?") -> int | None:
    """Rows that this run has exported for the month already; None when it has not finished."""
    cursor.execute(f"SELECT row_count FROM {LEDGER} WHERE target = {mark} AND month = {mark} AND run_id = {mark}", [table, month, run_id])
    row = cursor.fetchone()
    return None if row is None else int(row[0])


def export_month(df: DataFrame, table: str, columns: Sequence[str], conn: dict[str, str], month: str, run_id: str, connection,
                 append: Callable[[DataFrame, str, dict[str, str]], int] = append_rows,
                 month_cols: Sequence[str] = MONTH_COLUMNS, mark: str = "?") -> int:
    """K2 + K5: replace one month of a mart table by way of a staging table; returns the rows of the month.

    Executors append to a staging table named by the run. Then one transaction
    deletes the month, moves the staged rows and enters the run in the ledger
    ``mart_exports`` (made when missing), so readers see the old or the new
    month and a failure at any point leaves the old one. A run that stands in
    the ledger does nothing; one that failed starts again with an empty staging
    table. A task that is repeated after its rows were committed would append
    them twice: the staged rows are counted, and a count that differs from the
    rows the job wrote raises before the month is touched.

    ``connection`` is the caller's DB-API connection (autocommit off) and ``mark``
    its parameter sign. A frame that shares no column with the table raises
    before any statement. An empty frame empties the month.
    """
    out, stage = mart_projection(df, columns), staging_name(table, run_id)
    names = ", ".join(out.columns)
    with _transaction(connection) as cursor:
        cursor.execute(f"CREATE TABLE IF NOT EXISTS {LEDGER} (target VARCHAR(255) NOT NULL, month VARCHAR(16) NOT NULL, "
                       "run_id VARCHAR(128) NOT NULL, row_count BIGINT NOT NULL, PRIMARY KEY (target, month, run_id))")
        done = exported_rows(cursor, table, month, run_id, mark)
        if done is None:
            cursor.execute(f"DROP TABLE IF EXISTS {stage}")
            cursor.execute(f"CREATE TABLE {stage} AS SELECT {names} FROM {table} WHERE 1 = 0")
    if done is not None:
        return done
    written = append(out, stage, conn)
    with _transaction(connection) as cursor:
        cursor.execute(f"SELECT COUNT(*) FROM {stage}")
        staged = int(cursor.fetchone()[0])
        if staged != written:
            raise ExportMismatch(f"{stage} holds {staged} rows, the job wrote {written}")
        cursor.execute(delete_statement(table, month_cols, mark), [month] * len(month_cols))
        cursor.execute(f"INSERT INTO {table} ({names}) SELECT {names} FROM {stage}")
        cursor.execute(f"INSERT INTO {LEDGER} ({', '.join(LEDGER_COLUMNS)}) VALUES ({', '.join([mark] * len(LEDGER_COLUMNS))})",
                       [table, month, run_id, written])
    with _transaction(connection) as cursor:
        cursor.execute(f"DROP TABLE IF EXISTS {stage}")
    return written
