"""Run records (K10) as an append-only table of events.

Every stage of a run (and the run as a whole, stage ``run``) writes a
``running`` event when it starts and a ``completed`` or ``failed`` event when it
ends; its current state is its latest event
(:func:`regspark.operators.runs.current_runs`). An event is one small JSON file,
created whole through the file system: recording starts no Spark job, and
concurrent runs do not conflict. :meth:`RunLog.compact` folds the files into one
Parquet folder; every event has an id, so a compaction that stops half-way
leaves events twice on disk and once in the table.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from regspark.sinks.manifest import Folder, Month, commit, read_manifest

RUN_EVENT_SCHEMA = (
    "run_id string, pipeline_name string, stage string, dataset string, source_file string, "
    "data_version string, dataset_month string, status string, started_at timestamp, "
    "finished_at timestamp, duration_seconds double, records bigint, records_failed bigint, "
    "output_path string, event_ts timestamp, error_message string, event_id string"
)
# Characters of an error kept in its event: messages of a job can hold a whole plan.
ERROR_CHARS = 2000
ENCODING_AUDIT_SCHEMA = (
    "dataset string, data_version string, from_encoding string, to_encoding string, "
    "bad_before bigint, bad_after bigint, event_ts timestamp, event_id string"
)
# The alert table, with the run it belongs to.
ALERT_SCHEMA = (
    "run_id string, alert_type string, alert_message string, record_line bigint, severity string, "
    "field_name string, created_at timestamp"
)
WHOLE_RUN = "run"


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


class RunLog:
    """Appends run events, alerts and encoding switches under ``{root}``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _append(self, schema: str, table: str, row: dict) -> None:
        event_id = uuid.uuid4().hex
        values = {**{c: row.get(c) for c in _names(schema)}, "event_id": event_id}
        body = json.dumps({k: v.isoformat(timespec="microseconds") if isinstance(v, dt.datetime) else v
                           for k, v in values.items() if v is not None})
        if not Folder(self.spark, f"{self.root}/{table}/events/{event_id}.json").create_whole(body):
            raise FileExistsError(f"event {event_id} of {table} exists")

    def _events(self, schema: str, table: str) -> DataFrame:
        path = f"{self.root}/{table}"
        compacted = [f"{path}/{e.commit}" for e in read_manifest(self.spark, path).months.values()]
        files = Folder(self.spark, f"{path}/events")
        frames = [self.spark.read.schema(schema).json(f"{path}/events")] if files.exists() else []
        if compacted:
            frames.append(self.spark.read.schema(schema).parquet(*compacted))
        if not frames:
            return self.spark.createDataFrame([], schema)
        return frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1]).dropDuplicates(["event_id"])

    def compact(self, table: str = "_runs") -> int:
        """Fold the event files of ``_runs`` or ``_encoding_audit`` into Parquet; returns the events folded.

        The Parquet folder counts once its manifest entry stands; only then are
        its event files deleted. Events that are written meanwhile stay files.
        """
        schema = {"_runs": RUN_EVENT_SCHEMA, "_encoding_audit": ENCODING_AUDIT_SCHEMA}[table]
        path, part = f"{self.root}/{table}", uuid.uuid4().hex
        names = [n for n in Folder(self.spark, f"{path}/events").names() if n.endswith(".json")]
        if not names:
            return 0
        base = read_manifest(self.spark, path)
        folder = f"compacted/{part}"
        rows = self.spark.read.schema(schema).json([f"{path}/events/{n}" for n in names])
        rows.coalesce(1).write.parquet(f"{path}/{folder}")
        commit(self.spark, path, base, {part: Month(folder, len(names), rows.schema.json())})
        for name in names:
            Folder(self.spark, f"{path}/events/{name}").delete()
        return len(names)

    def start(self, pipeline_name: str, dataset: str, source_file: str, month: str,
              stage: str = WHOLE_RUN, run_id: str | None = None) -> dict:
        began = _now()
        run = {
            "run_id": run_id or uuid.uuid4().hex, "pipeline_name": pipeline_name, "stage": stage,
            "dataset": dataset, "source_file": source_file, "data_version": month,
            "dataset_month": month, "status": "running", "started_at": began, "event_ts": began,
        }
        self._append(RUN_EVENT_SCHEMA, "_runs", run)
        return run

    def finish(self, run: dict, status: str, records: int = 0, failed: int = 0,
               output_path: str | None = None, error: BaseException | None = None) -> None:
        """The run's last event; a failure's reason is its type and message."""
        end = _now()
        reason = f"{type(error).__name__}: {error}"[:ERROR_CHARS] if error is not None else None
        self._append(RUN_EVENT_SCHEMA, "_runs", {
            **run, "status": status, "finished_at": end,
            "duration_seconds": (end - run["started_at"]).total_seconds(),
            "records": records, "records_failed": failed, "output_path": output_path, "event_ts": end,
            "error_message": reason,
        })

    @contextmanager
    def stage(self, run: dict, stage: str):
        """Record one stage of ``run``; the body puts the written rows and path into the given dict."""
        own = self.start(run["pipeline_name"], run["dataset"], run["source_file"], run["data_version"],
                         stage, run["run_id"])
        out: dict = {"records": 0, "output_path": None}
        try:
            yield out
        except Exception as exc:
            self.finish(own, "failed", failed=1, error=exc)
            raise
        self.finish(own, "completed", out["records"], output_path=out["output_path"])

    def events(self) -> DataFrame:
        return self._events(RUN_EVENT_SCHEMA, "_runs")

    # --- alerts of a run (input of A13) ------------------------------------------

    def record_alerts(self, run: dict, alerts: DataFrame) -> None:
        """Append alert rows (``quality.rule_alerts``) linked to their run."""
        from pyspark.sql import functions as F

        linked = alerts.withColumn("run_id", F.lit(run["run_id"]))
        linked.select(*_names(ALERT_SCHEMA)).write.mode("append").parquet(f"{self.root}/_alerts")

    def alerts(self) -> DataFrame:
        return self.spark.read.schema(ALERT_SCHEMA).parquet(f"{self.root}/_alerts")

    # --- encoding audit (input of the A19 fallback metrics) -------------------

    def record_encoding(self, choice, month: str) -> None:
        """One audit row per switch: dataset, encodings, U+FFFD cells before and after."""
        self._append(ENCODING_AUDIT_SCHEMA, "_encoding_audit", {
            "dataset": choice.dataset, "data_version": month, "from_encoding": choice.from_encoding,
            "to_encoding": choice.to_encoding, "bad_before": int(choice.bad_before),
            "bad_after": int(choice.bad_after), "event_ts": _now(),
        })

    def encoding_audit(self) -> DataFrame:
        return self._events(ENCODING_AUDIT_SCHEMA, "_encoding_audit")
