"""Input profiling: field counts per line and encoding scoring.

Both work on whole texts with built-in expressions (higher-order functions,
``regexp_count``, ``decode``, ``make_valid_utf8``) row by row, so they need
no shuffle per document; per-file rollups are one small aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regspark.functions.cleanse import REPLACEMENT_CHAR, regex_literal
from regspark.sources.text import CP1252_UPPER, LATIN1_UPPER

# ---------------------------------------------------------------------------
# Fixed values of the encoding scorer: candidate order (ties keep this order),
# term weights, mojibake patterns and the accented letters that count as a
# sign of correct decoding.
# ---------------------------------------------------------------------------
CANDIDATES = ("latin1", "cp1252", "utf-8", "utf-8-sig")
WEIGHT_DECODE_ERROR = 100
WEIGHT_MOJIBAKE = 10
WEIGHT_CONTROL = 5
# The second character is written as "not a line feed": the dot of Java's
# patterns also skips other line ends, which would miss some mojibake.
MOJIBAKE_PATTERNS = ("Ã[^\n]", "Â[^\n]", REPLACEMENT_CHAR)
ACCENTED = "áàâãäéèêëíìîïóòôõöúùûüçÁÀÂÃÄÉÈÊËÍÌÎÏÓÒÔÕÖÚÙÛÜÇ"

# --- Q3: field counts per line ------------------------------------------------------

def line_field_counts(text: Column, delimiter: str = ";") -> Column:
    """Array with the number of ``delimiter``-separated fields of each line."""
    pattern = regex_literal(delimiter)
    return F.transform(F.split(text, "\n"), lambda line: F.size(F.split(line, pattern, -1)))


def text_profile(df: DataFrame, text_col: str, delimiter: str = ";") -> DataFrame:
    """Per row: line count and min / max / distinct field counts (no shuffle)."""
    counts = line_field_counts(F.col(text_col), delimiter)
    return df.withColumn("__fc", counts).withColumns({
        "n_lines": F.size("__fc").cast("bigint"),
        "min_fields": F.array_min("__fc"),
        "max_fields": F.array_max("__fc"),
        "distinct_fields": F.array_join(F.array_sort(F.array_distinct("__fc")), ","),
    }).drop("__fc")


def file_profile(lines: DataFrame, delimiter: str = ";") -> DataFrame:
    """Q3 over ``spark.read.text`` output (all files, all lines).

    Per file (by its full path): folder, name, extension, size in bytes, lines,
    min / max / distinct field counts and the first line. The distinct set holds
    field *counts*, so it stays tiny; the first line is the one at the smallest
    offset, kept by a map-side partial aggregate.
    """
    pattern = regex_literal(delimiter)
    path = F.col("_metadata.file_path")
    per_line = lines.select(
        path.alias("file_path"),
        F.col("_metadata.file_size").alias("size_bytes"),
        # lines of a split come in order, and splits of a file by their start
        F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line")).alias("__at"),
        "value",
        F.size(F.split(F.col("value"), pattern, -1)).alias("n_fields"),
    )
    out = per_line.groupBy("file_path", "size_bytes").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.min("n_fields").alias("min_fields"),
        F.max("n_fields").alias("max_fields"),
        F.array_join(F.array_sort(F.collect_set("n_fields")), ",").alias("distinct_fields"),
        F.min_by("value", "__at").alias("first_line"),
    )
    name = F.element_at(F.split("file_path", "/"), -1)
    ext = F.regexp_extract(name, r"(\.[^./]+)$", 1)
    return out.select(
        F.regexp_extract("file_path", r"^(.*)/[^/]*$", 1).alias("folder"), name.alias("file_name"),
        F.when(ext == "", F.lit("none")).otherwise(ext).alias("extension"), *out.columns[1:], "file_path")


def folder_profile(files: DataFrame) -> DataFrame:
    """Q3 rolled up: per folder, its files, lines and smallest and largest field counts."""
    return files.groupBy("folder").agg(
        F.count(F.lit(1)).alias("n_files"), F.sum("n_lines").alias("n_lines"),
        F.min("min_fields").alias("min_fields"), F.max("max_fields").alias("max_fields"))


# --- Q2: encoding scoring ------------------------------------------------------------

CONTROL_PATTERN = r"[\x00-\x08\x0B\x0C\x0E-\x1F]"
# The bytes that windows-1252 does not define, as their Latin-1 reading shows them.
CP1252_UNDEFINED = "".join(a for a, b in zip(LATIN1_UPPER, CP1252_UPPER) if b == REPLACEMENT_CHAR)
TERMS = ("decode_errors", "mojibake_hits", "control_chars", "accented_chars")
_COUNTS = ("control", "undefined", "latin1_mojibake", "latin1_accents", "utf8_errors", "utf8_mojibake", "utf8_accents")


def _count(text: Column, pattern: str) -> Column:
    """Non-overlapping regex matches (0 for NULL)."""
    return F.coalesce(F.regexp_count(text, F.lit(pattern)), F.lit(0)).cast("bigint")


def _count_if_present(text: Column, pattern: str, lead: str) -> Column:
    """Regex count, skipped when the pattern's first character is absent."""
    return F.when(F.instr(text, lead) > 0, _count(text, pattern)).otherwise(F.lit(0).cast("bigint"))


def _mojibake(text: Column) -> Column:
    """Matches of the two patterns that are no replacement character."""
    first, second, _ = MOJIBAKE_PATTERNS
    return _count_if_present(text, first, first[0]) + _count_if_present(text, second, second[0])


def _counted(df: DataFrame, raw_col: str) -> DataFrame:
    """``df`` without ``raw_col`` and with the counts that every candidate's terms are sums of.

    Only two texts of the bytes are made, once a row, and none for plain ASCII,
    which has control characters only. latin1 maps every byte; utf-8 turns what
    it does not define into U+FFFD, utf-8-sig too (a leading BOM is counted by
    no term); cp1252 reads bytes like latin1 but for 0x80 to 0x9F, where no
    pattern and no accented or control character lies, so it differs by its
    undefined bytes. Control characters are single bytes in all of them.
    """
    rest = [c for c in df.columns if c != raw_col]
    text = F.col(raw_col).cast("string")
    plain = F.coalesce(F.is_valid_utf8(text) & (F.length(text) == F.octet_length(text)), F.lit(True))
    texts = df.withColumn("__plain", plain).select(
        *rest, text.alias("__text"),
        F.when(~F.col("__plain"), F.decode(F.col(raw_col).cast("binary"), "ISO-8859-1")).alias("__latin1"),
        F.when(~F.col("__plain"), F.make_valid_utf8(text)).alias("__utf8"))
    latin1, utf8 = F.col("__latin1"), F.col("__utf8")
    counts = (_count(F.col("__text"), CONTROL_PATTERN), _count(latin1, f"[{CP1252_UNDEFINED}]"),
              _mojibake(latin1), _count(latin1, f"[{ACCENTED}]"),
              _count_if_present(utf8, REPLACEMENT_CHAR, REPLACEMENT_CHAR), _mojibake(utf8), _count(utf8, f"[{ACCENTED}]"))
    return texts.select(*rest, *[c.alias(f"__{n}") for n, c in zip(_COUNTS, counts)])


def _candidate_terms(candidates: Sequence[str]) -> list[tuple[str, dict[str, Column]]]:
    """Score and terms of each candidate, from the counts of a row or their sums over rows."""
    unknown = set(candidates) - set(CANDIDATES)
    if unknown:
        raise ValueError(f"unknown candidate encodings {sorted(unknown)}")
    n = {name: F.col(f"__{name}") for name in _COUNTS}
    none = F.lit(0).cast("bigint")
    utf8 = (n["utf8_errors"], n["utf8_mojibake"], n["utf8_accents"])
    parts = {"latin1": (none, n["latin1_mojibake"], n["latin1_accents"]),
             "cp1252": (n["undefined"], n["latin1_mojibake"], n["latin1_accents"]),
             "utf-8": utf8, "utf-8-sig": utf8}
    out = []
    for name in candidates:
        errors, mojibake, accents = parts[name]
        mojibake = mojibake + errors  # the third pattern is the replacement character itself
        score = errors * WEIGHT_DECODE_ERROR + mojibake * WEIGHT_MOJIBAKE + n["control"] * WEIGHT_CONTROL - accents
        out.append((name, {"score": score, **dict(zip(TERMS, (errors, mojibake, n["control"], accents)))}))
    return out


def _by_candidate(counted: DataFrame, candidates: Sequence[str]) -> DataFrame:
    """Per row of counts one row per candidate: ``pos``, ``encoding``, ``score`` and its terms."""
    rest = [c for c in counted.columns if c not in {f"__{n}" for n in _COUNTS}]
    structs = [F.struct(F.lit(pos).alias("pos"), F.lit(name).alias("encoding"), *[c.alias(k) for k, c in m.items()])
               for pos, (name, m) in enumerate(_candidate_terms(candidates))]
    return counted.select(*rest, F.explode(F.array(*structs)).alias("__c")).select(*rest, "__c.*")


def encoding_scores(df: DataFrame, raw_col: str, candidates: Sequence[str] = CANDIDATES) -> DataFrame:
    """Per row one row per candidate: ``pos``, ``encoding``, ``score`` and its terms."""
    return _by_candidate(_counted(df, raw_col), candidates)


def best_encoding(df: DataFrame, raw_col: str, candidates: Sequence[str] = CANDIDATES) -> DataFrame:
    """Per row: the candidate with the lowest score; ties keep candidate order.

    All candidates are scored in one pass over the row; the winner is the
    minimum of an array of structs ordered (score, candidate position).
    """
    structs = [F.struct(m["score"].alias("score"), F.lit(pos).alias("pos"), F.lit(name).alias("encoding"),
                        *[m[t].alias(t) for t in TERMS])
               for pos, (name, m) in enumerate(_candidate_terms(candidates))]
    out = _counted(df.withColumn("__raw", F.col(raw_col)), "__raw").withColumn("__best", F.array_min(F.array(*structs)))
    return out.select(*df.columns, *[F.col(f"__best.{c}").alias(c) for c in ("encoding", "score", *TERMS)])


def file_encodings(lines: DataFrame, candidates: Sequence[str] = CANDIDATES) -> DataFrame:
    """Q2 per file over ``spark.read.text`` output, whole files line by line.

    One row per file and candidate with the summed score and terms and its
    ``rank`` (1 is the file's winner; ties keep candidate order). The counts are
    summed map-side, so a file of any size is one partial row a task; candidates
    are laid out after that, from one row a file.
    """
    raw = lines.select(F.col("_metadata.file_path").alias("file_path"), F.col("value").alias("raw"))
    per_file = _counted(raw, "raw").groupBy("file_path").agg(*[F.sum(f"__{n}").alias(f"__{n}") for n in _COUNTS])
    order = Window.partitionBy("file_path").orderBy("score", "pos")
    return _by_candidate(per_file, candidates).withColumn("rank", F.row_number().over(order)).drop("pos")


def encoding_vote(best: DataFrame, group_col: str, candidates: Sequence[str] = CANDIDATES) -> DataFrame:
    """Majority vote of the per-file winners within each group.

    Ties go to the earlier candidate. One aggregate (group, encoding) then a
    top-1 per group over that tiny result.
    """
    from regspark.operators.preferred import preferred_row

    order = F.array_position(F.array(*[F.lit(c) for c in candidates]), F.col("encoding"))
    votes = best.groupBy(group_col, "encoding").agg(F.count(F.lit(1)).alias("wins"))
    top = preferred_row(votes, [group_col], [F.col("wins").desc(), order.asc()])
    return top.select(group_col, "encoding", "wins")
