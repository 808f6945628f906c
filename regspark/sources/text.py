"""Delimited text scan of the monthly extracts (bronze input).

One parser serves single files, globs and streams: lines are read as raw
bytes, decoded, split by ``from_csv`` into the dataset's layout and counted, so
every row's own width is known. Missing trailing fields become NULL, fields
beyond the layout are dropped, and both are reported in that row's audit
columns; no row is judged by another one's width. Every cell goes through the
null-marker rule.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regspark.functions.cleanse import (
    ident, null_marker_sql, strip_replacement_sql,
)
from regspark.layouts import MONTH_COLUMNS, dataset_spec
from regspark.operators.quality import replacement_cells

# ---------------------------------------------------------------------------
# Python-style encoding names accepted by the jobs and the
# Spark charset each maps to (Spark 4 rejects the Python names, and never
# accepts a BOM-stripping charset).
# ---------------------------------------------------------------------------
CHARSETS = {
    "latin1": "ISO-8859-1",
    "latin-1": "ISO-8859-1",
    "iso-8859-1": "ISO-8859-1",
    "iso8859-1": "ISO-8859-1",
    "utf-8": "UTF-8",
    "utf8": "UTF-8",
    "utf-8-sig": "UTF-8",
    "cp1252": "windows-1252",
    "windows-1252": "windows-1252",
}
DEFAULT_ENCODING = "latin1"
SKIPPED_SUFFIXES = (".zip",)


def spark_charset(encoding: str) -> str:
    key = (encoding or "").strip().lower()
    return CHARSETS.get(key, encoding)


# The characters of bytes 0x80 to 0x9F in windows-1252 (U+FFFD: undefined).
CP1252_UPPER = "€\ufffd‚ƒ„…†‡ˆ‰Š‹Œ\ufffdŽ\ufffd\ufffd‘’“”•–—˜™š›œ\ufffdžŸ"
LATIN1_UPPER = "".join(map(chr, range(0x80, 0xA0)))
BOM = "\ufeff"


def decoded(raw: Column, encoding: str = DEFAULT_ENCODING) -> Column:
    """Text of the bytes ``raw``; what the encoding does not define becomes U+FFFD.

    windows-1252 is Latin-1 with another upper control block, so it needs no
    charset beyond Spark's own; a byte order mark is dropped.
    """
    charset = spark_charset(encoding)
    if charset == "UTF-8":
        text = F.make_valid_utf8(raw.cast("string"))
        return F.when(text.startswith(BOM), F.substr(text, F.lit(2))).otherwise(text)
    if charset == "windows-1252":
        return F.translate(F.decode(raw.cast("binary"), "ISO-8859-1"), LATIN1_UPPER, CP1252_UPPER)
    return F.decode(raw.cast("binary"), charset)


def row_field_count(line: Column, sep: str = ";") -> Column:
    """Fields of one delimited line, quote-aware: quoted segments are removed
    before the separators are counted. A doubled quote ends one segment and
    starts the next, so a plain character class (matched in a loop, at any
    length) is enough."""
    bare = F.when(F.contains(line, F.lit('"')), F.regexp_replace(line, '"[^"]*"', "")).otherwise(line)
    return ((F.length(bare) - F.length(F.replace(bare, F.lit(sep), F.lit("")))) / F.lit(len(sep)) + 1).cast("int")


def decoded_lines(lines: DataFrame, encoding: str = DEFAULT_ENCODING) -> DataFrame:
    """``__line`` and ``_metadata`` of a text scan (batch or stream), blank lines left out."""
    text = lines.select(decoded(F.col("value"), encoding).alias("__line"), F.col("_metadata"))
    return text.where(F.trim("__line") != "")


def parse_lines(lines: DataFrame, width: int, sep: str = ";") -> DataFrame:
    """``_c0.._c{width-1}`` and the row's own ``_column_count``; no header,
    ``"`` quotes with doubled-quote escape, one record per line, PERMISSIVE."""
    schema = ", ".join(f"_c{i} STRING" for i in range(width))
    opts = {"sep": sep, "quote": '"', "escape": '"', "mode": "PERMISSIVE"}
    return lines.select(
        F.from_csv("__line", schema, opts).alias("__r"),
        row_field_count(F.col("__line"), sep).alias("_column_count"),
        "_metadata",
    ).select("__r.*", "_column_count", "_metadata")


def scan_lines(spark: SparkSession, paths: str | Sequence[str], encoding: str = DEFAULT_ENCODING) -> DataFrame:
    return decoded_lines(spark.read.text([paths] if isinstance(paths, str) else list(paths)), encoding)


def scan_width(lines: DataFrame, dataset: str, sep: str = ";") -> int:
    """Columns to parse: the layout's, or for an unknown dataset the widest row of the whole input."""
    layout = dataset_spec(dataset).layout
    return len(layout) or int(lines.agg(F.max(row_field_count(F.col("__line"), sep))).first()[0] or 1)


def resolve_sources(spark: SparkSession, spec: str) -> list[str]:
    """Paths of the first of the ``|``-separated alternatives that lists at
    least one usable file. Hidden files (Spark skips ``.`` and ``_`` names) and
    ``.zip`` archives do not count. Only file names reach the driver."""
    for alt in [a.strip() for a in spec.split("|") if a.strip()]:
        try:
            files = spark.read.format("text").load(alt).inputFiles()
        except Exception as exc:  # noqa: BLE001 - no match for this alternative
            if "PATH_NOT_FOUND" in str(exc) or "does not exist" in str(exc):
                continue
            raise
        usable = sorted(
            f for f in map(unquote, files)
            if not f.rsplit("/", 1)[-1].startswith((".", "_"))
            and not f.lower().endswith(SKIPPED_SUFFIXES)
        )
        if usable:
            return usable
    raise FileNotFoundError(f"no input file matches {spec!r}")


def as_pattern(path: str) -> str:
    """A listed file's path for the reader, which takes patterns: glob signs escaped."""
    return re.sub(r"([\\*?{}\[\]])", r"\\\1", path)


def apply_layout(raw: DataFrame, dataset: str) -> DataFrame:
    """Layout names by position with null markers, plus the row's audit columns.

    Known dataset: its layout columns, then ``_column_count`` (fields of this
    row), ``_layout_expected`` and ``_layout_status`` (ok / mismatch).
    Unknown dataset: ``col_1..col_n`` and ``_column_count``.
    """
    layout = dataset_spec(dataset).layout
    source = [c for c in raw.columns if c.startswith("_c") and c != "_column_count"]
    names = layout or [f"col_{i}" for i in range(1, len(source) + 1)]
    cells = dict(zip(names, source))
    # One selectExpr for the whole layout (a single call into the JVM).
    cols = [f"{null_marker_sql(cells[n]) if n in cells else 'CAST(NULL AS STRING)'} AS {ident(n)}" for n in names]
    audit = ["_column_count"]
    if layout:
        audit += [f"{len(layout)} AS _layout_expected",
                  f"CASE WHEN _column_count = {len(layout)} THEN 'ok' ELSE 'mismatch' END AS _layout_status"]
    return raw.selectExpr(*cols, *audit, "_metadata")


def add_lineage(df: DataFrame, dataset: str, month: str, full_path: bool) -> DataFrame:
    """Ingestion time, source file (bare name or full URI), type, month."""
    src = F.col("_metadata.file_path") if full_path else F.col("_metadata.file_name")
    out = df.select(
        *[c for c in df.columns if c != "_metadata"],
        F.current_timestamp().alias("ingestion_ts"),
        src.alias("source_file"),
        F.lit(dataset_spec(dataset).name).alias("file_type"),
        *[F.lit(month).alias(c) for c in MONTH_COLUMNS],
    )
    return out


def strip_code_list(df: DataFrame, dataset: str) -> DataFrame:
    """Code lists lose every U+FFFD in their layout columns."""
    spec = dataset_spec(dataset)
    if not spec.code_list:
        return df
    return df.selectExpr(*[f"{strip_replacement_sql(c)} AS {ident(c)}" if c in spec.layout else ident(c)
                           for c in df.columns])


@dataclass(frozen=True)
class EncodingChoice:
    dataset: str
    from_encoding: str
    to_encoding: str
    bad_before: int
    bad_after: int


def choose_encoding(spark: SparkSession, paths: Sequence[str], dataset: str,
                    default: str = DEFAULT_ENCODING, sep: str = ";") -> EncodingChoice:
    """Q5: the encoding to read a code list with, in at most one pass.

    Counts the cells that hold U+FFFD under the default (bytes the encoding
    does not define, or the character itself). Latin-1 defines every byte, so a
    Latin-1 default is never checked, and it takes over where any cell is bad.
    """
    spec = dataset_spec(dataset)
    if not spec.code_list or spark_charset(default) == "ISO-8859-1":
        return EncodingChoice(spec.name, default, default, 0, 0)
    cells = parse_lines(scan_lines(spark, paths, default), len(spec.layout), sep)
    bad = cells.agg(replacement_cells([f"_c{i}" for i in range(len(spec.layout))])).first()[0] or 0
    return EncodingChoice(spec.name, default, "latin1" if bad else default, int(bad), 0)


def bronze_rows(lines: DataFrame, dataset: str, width: int, sep: str = ";") -> DataFrame:
    """Layout, null markers and code-list cleaning of decoded lines (batch or stream)."""
    return strip_code_list(apply_layout(parse_lines(lines, width, sep), dataset), dataset)


def read_bronze(spark: SparkSession, source: str | Sequence[str], dataset: str, month: str,
                encoding: str = DEFAULT_ENCODING, sep: str = ";",
                full_path: bool | None = None) -> tuple[DataFrame, EncodingChoice]:
    """Text files of one dataset and month as a bronze frame (lazy).

    ``source`` is a path, a glob, ``|``-separated alternatives, or a list.
    Lineage holds the bare file name for a single file and the full URI for
    several, as the two ingest modes of the registry jobs do.
    """
    paths = [as_pattern(p) for p in resolve_sources(spark, source)] if isinstance(source, str) else list(source)
    if full_path is None:
        full_path = len(paths) > 1 or (isinstance(source, str) and any(ch in source for ch in "*?[|"))
    choice = choose_encoding(spark, paths, dataset, encoding, sep)
    lines = scan_lines(spark, paths, choice.to_encoding)
    df = bronze_rows(lines, dataset, scan_width(lines, dataset, sep), sep)
    return add_lineage(df, dataset, month, full_path), choice
