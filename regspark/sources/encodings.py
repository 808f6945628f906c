"""Folders of files in different encodings: every file is read by its own.

One pass scores each file whole under every candidate (:mod:`regspark.operators.profile`).
The winners, one row a file, are written to the shared scratch folder, so their
size is known: Catalyst sends them to the scan's tasks when they are under the
session's broadcast threshold and shuffles otherwise. The second scan decodes
each line by the winner of its file; no file is read by a driver, and a folder
costs two passes however many encodings it holds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regspark.operators.profile import TERMS, file_encodings
from regspark.session import scratch_path
from regspark.sources.text import DEFAULT_ENCODING, add_lineage, as_pattern, bronze_rows, decoded, resolve_sources, scan_width

# Best first among equals: plain ASCII counts as UTF-8, and bytes that windows-1252 defines as its own.
MIXED_CANDIDATES = ("utf-8-sig", "cp1252", "latin1")


def choose_file_encodings(spark: SparkSession, paths: Sequence[str], candidates: Sequence[str] = MIXED_CANDIDATES) -> DataFrame:
    """Q5 by file: ``file_path, encoding, score`` and the score's terms, one row for every file that has a line."""
    target = scratch_path(spark, "file-encodings")
    best = file_encodings(spark.read.text(list(paths)), candidates).where("rank = 1")
    best.select("file_path", "encoding", "score", *TERMS).write.parquet(target)
    return spark.read.parquet(target)


def _decoded_by(raw: Column, encoding: Column, candidates: Sequence[str]) -> Column:
    """Text of ``raw`` by the encoding its row names; only that branch is evaluated."""
    out = F.when(F.lit(False), F.lit(""))
    for name in candidates:
        out = out.when(encoding == name, decoded(raw, name))
    return out.otherwise(decoded(raw, DEFAULT_ENCODING))


def scan_mixed_lines(spark: SparkSession, paths: Sequence[str], choices: DataFrame,
                     candidates: Sequence[str] = MIXED_CANDIDATES) -> DataFrame:
    """``__line`` and ``_metadata`` of a text scan, every file decoded by its choice, blank lines left out.

    A file without a choice (it came after they were made) is read as Latin-1.
    """
    lines = spark.read.text(list(paths)).select("value", "_metadata")
    chosen = choices.select(F.col("file_path").alias("__file"), F.col("encoding").alias("__encoding"))
    lines = lines.join(chosen, lines["_metadata.file_path"] == chosen["__file"], "left")
    text = lines.select(_decoded_by(F.col("value"), F.col("__encoding"), candidates).alias("__line"), "_metadata")
    return text.where(F.trim("__line") != "")


def read_bronze_mixed(spark: SparkSession, source: str | Sequence[str], dataset: str, month: str, sep: str = ";",
                      candidates: Sequence[str] = MIXED_CANDIDATES) -> tuple[DataFrame, DataFrame]:
    """S3 + Q5: files of one dataset and month, each in its own encoding, as a bronze frame,
    and the audit of the choices by file. Lineage holds full URIs, which the audit's ``file_path`` equals."""
    paths = [as_pattern(p) for p in resolve_sources(spark, source)] if isinstance(source, str) else list(source)
    choices = choose_file_encodings(spark, paths, candidates)
    lines = scan_mixed_lines(spark, paths, choices, candidates)
    df = bronze_rows(lines, dataset, scan_width(lines, dataset, sep), sep)
    return add_lineage(df, dataset, month, full_path=True), choices
