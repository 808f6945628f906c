"""Aggregations over the run table (stage runs of the monthly jobs).

Run table columns used here, as ``sinks.runlog`` writes them: run_id, stage,
dataset, status, data_version, started_at, finished_at, duration_seconds
(double), records and records_failed (bigint). Metrics take current states
(:func:`current_runs`), of which totals and rates count the finished ones.
All metrics are grouped aggregates with map-side partial aggregation; the
duration histogram has a fixed, tiny number of buckets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regspark.operators.preferred import preferred_row

# ---------------------------------------------------------------------------
# Upper bounds (seconds) of the stage-duration histogram, and
# the run states.
# ---------------------------------------------------------------------------
DURATION_BOUNDS = (0.5, 1, 2, 5, 10, 30, 60, 120, 300, 600, 1200, 1800, 3600)
STATUS_RUNNING = "running"
STATUS_COMPLETED = "completed"
STATUS_FAILED = "failed"
SEVERITY_CRITICAL = "CRITICAL"


def _pct(part: Column, total: Column) -> Column:
    """100 * part / total as double, 0 when total is 0 (zero-safe rate)."""
    return F.when(total == 0, F.lit(0.0)).otherwise(
        part.cast("double") * 100.0 / total.cast("double")
    )


def finished_runs(runs: DataFrame) -> DataFrame:
    """Runs that ended, well or not."""
    return runs.where(F.col("status").isin(STATUS_COMPLETED, STATUS_FAILED))


def run_rates(runs: DataFrame) -> DataFrame:
    """A12 + A14: finished runs, successes, failures, success and error rate."""
    agg = finished_runs(runs).agg(
        F.count(F.lit(1)).alias("total_runs"),
        F.count_if(F.col("status") == STATUS_COMPLETED).alias("successes"),
        F.count_if(F.col("status") == STATUS_FAILED).alias("failures"),
    )
    return agg.select(
        "total_runs", "successes", "failures",
        _pct(F.col("successes"), F.col("total_runs")).alias("success_rate"),
        _pct(F.col("failures"), F.col("total_runs")).alias("error_rate"),
    )


def record_rates(runs: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """A12 by record: processed and failed records of finished runs over their total."""
    zero = F.lit(0).cast("bigint")
    agg = finished_runs(runs).groupBy(*keys).agg(
        F.coalesce(F.sum("records"), zero).cast("bigint").alias("processed"),
        F.coalesce(F.sum("records_failed"), zero).cast("bigint").alias("failed"),
    )
    total = F.col("processed") + F.col("failed")
    return agg.select(
        *keys, "processed", "failed",
        _pct(F.col("processed"), total).alias("record_success_rate"),
        _pct(F.col("failed"), total).alias("record_error_rate"),
    )


def runs_by(runs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A15 + A16: runs, records, mean and max duration per group.

    The mean is sum / count (the dashboard panel's expression); max is given too.
    """
    return runs.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("runs"),
        F.sum("records").cast("bigint").alias("records"),
        (F.sum("duration_seconds").cast("double")
         / F.count("duration_seconds").cast("double")).alias("mean_duration"),
        F.max("duration_seconds").alias("max_duration"),
    )


def duration_histogram(runs: DataFrame, keys: Sequence[str] = (),
                       bounds: Sequence[float] = DURATION_BOUNDS) -> DataFrame:
    """Cumulative histogram: runs with duration <= each bound (and +Inf).

    One grouped aggregate computes every cumulative count as a ``count_if``
    column (map-side partial aggregation), then ``unpivot`` turns the columns
    into one row per bound.
    """
    d = F.col("duration_seconds")
    labels = [str(b) for b in bounds] + ["+Inf"]
    values = [float(b) for b in bounds] + [float("inf")]
    cols = [F.count_if(d <= F.lit(float(b))).alias(f"le_{i}") for i, b in enumerate(bounds)]
    cols.append(F.count(F.lit(1)).alias(f"le_{len(bounds)}"))
    wide = runs.groupBy(*keys).agg(*cols)
    long = wide.unpivot(
        list(keys), [f"le_{i}" for i in range(len(labels))], "bucket", "runs_le"
    )
    label = F.element_at(F.array(*[F.lit(x) for x in labels]),
                         F.substring("bucket", 4, 3).cast("int") + 1)
    value = F.element_at(F.array(*[F.lit(x) for x in values]),
                         F.substring("bucket", 4, 3).cast("int") + 1)
    return long.select(*keys, label.alias("le"), value.alias("le_value"),
                       F.col("runs_le").cast("bigint").alias("runs_le"))


def latest_run(runs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Time of the latest finished run per group."""
    return runs.groupBy(*keys).agg(F.max("finished_at").alias("last_finished_at"))


def recent_runs(runs: DataFrame, n: int = 20, status: str | None = None) -> DataFrame:
    """O2: the newest ``n`` runs (optionally of one status), newest first."""
    if status is not None:
        runs = runs.where(F.col("status") == status)
    return runs.orderBy(F.desc_nulls_last("finished_at"), F.desc("run_id")).limit(n)


def recent_alerts(alerts: DataFrame, n: int = 20, severity: str | None = None) -> DataFrame:
    """O2 + F5: the newest ``n`` alert rows (optionally of one severity)."""
    if severity is not None:
        alerts = alerts.where(F.col("severity") == severity)
    return alerts.orderBy(F.desc_nulls_last("created_at"), F.desc_nulls_last("record_line")).limit(n)


def alerts_by(alerts: DataFrame, keys: Sequence[str] = ("alert_type", "severity")) -> DataFrame:
    """Alert counts per type and severity (map-side partial count)."""
    return alerts.groupBy(*keys).agg(F.count(F.lit(1)).alias("alerts"))


def run_summary(runs: DataFrame, alerts: DataFrame) -> DataFrame:
    """Per run: status, duration in whole seconds, alerts, critical alerts.

    ``alerts`` has run_id and severity; it is counted per run first
    (pre-aggregated) and joined on the run key.
    """
    per_run = alerts.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("alert_count"),
        F.count_if(F.col("severity") == SEVERITY_CRITICAL).alias("critical_alerts"),
    )
    out = runs.join(per_run, ["run_id"], "left")
    return out.select(
        "run_id", "status",
        F.expr("timestampdiff(SECOND, started_at, finished_at)").alias("duration_seconds"),
        F.coalesce("alert_count", F.lit(0).cast("bigint")).alias("alert_count"),
        F.coalesce("critical_alerts", F.lit(0).cast("bigint")).alias("critical_alerts"),
    )


def current_runs(events: DataFrame, keys: Sequence[str] = ("run_id",)) -> DataFrame:
    """K10 read side: the latest event of every run is its current state.

    On the library's own run table the keys are ``("run_id", "stage")``.
    """
    return preferred_row(events, list(keys), [F.col("event_ts").desc_nulls_last()])


def encoding_fallbacks(audit: DataFrame) -> DataFrame:
    """Encoding switches and recovered cells per (dataset, from, to).

    ``audit`` rows: dataset, from_encoding, to_encoding, bad_before, bad_after
    (cells holding U+FFFD under the first and the second encoding).
    """
    switched = audit.where(F.col("from_encoding") != F.col("to_encoding"))
    return switched.groupBy("dataset", "from_encoding", "to_encoding").agg(
        F.count(F.lit(1)).alias("switches"),
        F.sum(F.greatest(F.col("bad_before") - F.col("bad_after"), F.lit(0))).cast("bigint")
        .alias("recovered_cells"),
    )
