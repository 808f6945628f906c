"""Pick up new extract files once, ingest them, archive them.

A Structured Streaming file source with ``trigger(availableNow=True)``
processes every file not yet seen (tracked in the checkpoint) and stops.
``cleanSource=archive`` moves the files of a committed batch below
``sourceArchiveDir``. Spark does that when the *next non-empty* batch runs,
so the newest batch's files stay in the landing folder until more files
arrive; they are never read twice, because the checkpoint records them.
The sink is the Parquet file sink, whose commit log makes the folder
exactly-once across retries and executor loss. Rows are parsed by the same
code as a batch ingest, so both give equal rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from regspark.layouts import dataset_spec
from regspark.sinks.manifest import Folder
from regspark.sources.text import DEFAULT_ENCODING, add_lineage, bronze_rows, decoded_lines


def stream_frame(spark: SparkSession, source_dir: str, dataset: str, month: str,
                 archive_dir: str | None, encoding: str = DEFAULT_ENCODING,
                 sep: str = ";", max_files: int | None = None) -> DataFrame:
    """Streaming bronze frame of one known dataset: layout, null markers, audit, lineage.

    The encoding is given, not chosen: a stream has no whole input to judge.
    """
    spec = dataset_spec(dataset)
    if not spec.layout:
        raise ValueError(f"a stream needs a known dataset, not {dataset!r}")
    reader = spark.readStream
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    lines = decoded_lines(reader.text(source_dir), encoding)
    return add_lineage(bronze_rows(lines, spec.name, len(spec.layout), sep), spec.name, month, full_path=False)


def ingest_parts(spark: SparkSession, source_dir: str, dataset: str, month: str, root: str, layer: str,
                 checkpoint_dir: str, archive_dir: str | None = None, encoding: str = DEFAULT_ENCODING, sep: str = ";") -> int:
    """Run the available-now ingest into a month's parts, one a batch; returns the rows it added.

    A batch is published under its id, so a batch that is replayed after a
    failure finds its part and changes nothing.
    """
    from regspark.sinks.lake import append_part

    name, added = dataset_spec(dataset).name, []

    def take(batch: DataFrame, batch_id: int) -> None:
        result = append_part(batch, root, layer, name, month, f"batch-{batch_id:09d}")
        added.append(0 if result.metrics.get("replayed") else result.rows)

    q = (stream_frame(spark, source_dir, dataset, month, archive_dir, encoding, sep)
         .writeStream.foreachBatch(take).option("checkpointLocation", checkpoint_dir).trigger(availableNow=True).start())
    q.awaitTermination()
    return sum(added)


def ingest_available(spark: SparkSession, source_dir: str, dataset: str, month: str,
                     target_dir: str, checkpoint_dir: str, archive_dir: str | None = None,
                     encoding: str = DEFAULT_ENCODING, sep: str = ";") -> int:
    """Run the available-now ingest into Parquet files; returns the rows that this call wrote.

    The sink's commit log names each batch's files; the rows are those of the
    files that are new, counted from their footers.
    """
    def files() -> set[str]:
        return set(spark.read.parquet(target_dir).inputFiles()) if (log.exists() and log.names()) else set()

    log = Folder(spark, f"{target_dir}/_spark_metadata")
    before = files()
    q = (
        stream_frame(spark, source_dir, dataset, month, archive_dir, encoding, sep)
        .writeStream.format("parquet")
        .option("path", target_dir)
        .option("checkpointLocation", checkpoint_dir)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    new = sorted(files() - before)
    return spark.read.parquet(*new).count() if new else 0
