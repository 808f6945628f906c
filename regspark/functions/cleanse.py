"""Column expressions of the cleansing rules.

All are built-in Spark expressions, so they run inside whole-stage codegen;
none of them needs a UDF.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Cell contents (after trim, compared upper-cased) that mean
# "no value" in the registry extracts.
# ---------------------------------------------------------------------------
NULL_MARKERS = ["NULL", "N/A", "NA", "NAN", "NAO APLICAVEL", "NÃO APLICÁVEL"]

# Fixed value: the Unicode replacement character left by failed decoding.
REPLACEMENT_CHAR = "\ufffd"

# Fixed value: date layout of the extracts.
DATE_FORMAT = "yyyyMMdd"

MONEY_TYPE = T.DecimalType(18, 2)


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


# Rules applied to a *named* column are built as one SQL expression: a single
# call into the JVM instead of one per function, which matters when a rule is
# applied to every column of a wide layout. Results are identical.

def regex_literal(text: str) -> str:
    """``text`` escaped for use as a literal inside a Java regex."""
    return "".join("\\" + ch if ch in r".^$*+?()[]{}|\/" else ch for ch in text)


def ident(name: str) -> str:
    """Back-quoted SQL identifier."""
    return "`" + name.replace("`", "``") + "`"


def sql_str(value: str) -> str:
    """SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def null_marker_sql(name: str) -> str:
    t = f"trim({ident(name)})"
    leads = " OR ".join(f"startswith({t}, {sql_str(ch)})" for ch in _MARKER_LEADS)
    # The usual spellings are looked up as they stand; ``upper`` is left to the rest.
    markers = ", ".join(sql_str(m) for m in (*NULL_MARKERS, *map(str.lower, NULL_MARKERS)))
    return (f"CASE WHEN {t} IN ('', {markers}) OR (({leads}) AND length({t}) > 1 AND upper({t}) IN ('', {markers})) "
            f"THEN CAST(NULL AS STRING) ELSE {t} END")


def tidy_sql(name: str) -> str:
    return f"replace(replace(trim({ident(name)}), {sql_str(chr(34))}, ''), {sql_str(chr(39))}, '')"


def strip_replacement_sql(name: str) -> str:
    return f"replace({ident(name)}, {sql_str(REPLACEMENT_CHAR)}, '')"


def parse_date_sql(name: str) -> str:
    q = ident(name)
    return (f"CASE WHEN {q} RLIKE '^[0-9]{{8}}$' THEN try_cast(concat_ws('-', substring({q}, 1, 4), "
            f"substring({q}, 5, 2), substring({q}, 7, 2)) AS DATE) END")


# First characters a marker can start with in any case (all markers start
# with N; only "N" and "n" upper-case to "N").
_MARKER_LEADS = sorted({m[0] for m in NULL_MARKERS} | {m[0].lower() for m in NULL_MARKERS})


def null_marker(col: Column | str) -> Column:
    """Trimmed value, or NULL when empty or a null marker (any case).

    ``upper`` (a copy of the cell) is only evaluated for cells starting with a
    possible marker letter; the result is the same as testing every cell.
    """
    if isinstance(col, str):
        return F.expr(null_marker_sql(col))
    trimmed = F.trim(_c(col))
    lead = None
    for ch in _MARKER_LEADS:
        cond = trimmed.startswith(ch)
        lead = cond if lead is None else lead | cond
    return F.when(
        (trimmed == "") | (lead & F.upper(trimmed).isin(NULL_MARKERS)), F.lit(None).cast("string")
    ).otherwise(trimmed)


def _delete(col: Column, ch: str) -> Column:
    # replace() hands back the input unchanged when ``ch`` is absent (no copy),
    # which makes it several times cheaper than translate() on clean data.
    return F.replace(col, F.lit(ch), F.lit(""))


def strip_replacement(col: Column | str) -> Column:
    """Delete every U+FFFD character."""
    if isinstance(col, str):
        return F.expr(strip_replacement_sql(col))
    return _delete(_c(col), REPLACEMENT_CHAR)


def tidy(col: Column | str) -> Column:
    """Trim plain blanks, then delete every double and single quote."""
    if isinstance(col, str):
        return F.expr(tidy_sql(col))
    return _delete(_delete(F.trim(_c(col)), '"'), "'")


def has_replacement(col: Column | str) -> Column:
    """True when the value holds at least one U+FFFD (NULL stays NULL)."""
    return F.instr(_c(col), REPLACEMENT_CHAR) > 0


def parse_money(col: Column | str) -> Column:
    """Brazilian or plain money text to decimal(18,2); malformed gives NULL.

    Keep digits, ``,`` ``.`` ``-`` only. With a comma present, dots are
    thousands separators (deleted) and the comma is the decimal point.
    """
    kept = F.regexp_replace(F.trim(_c(col)), r"[^0-9,.\-]", "")
    normalized = F.when(F.instr(kept, ",") > 0, F.translate(kept, ",.", ".")).otherwise(kept)
    return normalized.try_cast(MONEY_TYPE)


def parse_money_sql(name: str) -> str:
    kept = f"regexp_replace(trim({ident(name)}), '[^0-9,.-]', '')"
    return (f"try_cast(CASE WHEN instr({kept}, ',') > 0 THEN translate({kept}, ',.', '.') "
            f"ELSE {kept} END AS DECIMAL(18, 2))")


def parse_date(col: Column | str) -> Column:
    """``yyyyMMdd`` text to date; anything but 8 digits or an invalid day is NULL.

    Same result as ``try_to_date(c, 'yyyyMMdd')`` on 8-digit input, but the
    digits are re-laid as ``yyyy-MM-dd`` and cast, which avoids the formatter
    (about 1.6x faster); the calendar check is the cast's.
    """
    if isinstance(col, str):
        return F.expr(parse_date_sql(col))
    c = _c(col)
    iso = F.concat_ws("-", F.substring(c, 1, 4), F.substring(c, 5, 2), F.substring(c, 7, 2))
    return F.when(c.rlike(r"^[0-9]{8}$"), iso.try_cast("date"))


def full_id(*cols: Column | str) -> Column:
    """Concatenation of the parts; NULL as soon as one part is NULL."""
    return F.concat(*[_c(c) for c in cols])


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def tidy_strings(df: DataFrame) -> DataFrame:
    """Apply :func:`tidy` to every string column, leave the others (one select)."""
    strings = set(string_columns(df))
    return df.selectExpr(*[f"{tidy_sql(c)} AS {ident(c)}" if c in strings else ident(c)
                           for c in df.columns])


def cast_dataset(df: DataFrame, money: list[str], dates: list[str]) -> DataFrame:
    """Typed casts: money columns to decimal, date columns to date.

    Each date column keeps its text in ``<name>_raw`` (placed just before it)
    unless such a column exists already. One select, order preserved.
    """
    if not money and not dates:
        return df
    out: list[str] = []
    existing = set(df.columns)
    for name in df.columns:
        if name in dates:
            if f"{name}_raw" not in existing:
                out.append(f"{ident(name)} AS {ident(name + '_raw')}")
            out.append(f"{parse_date_sql(name)} AS {ident(name)}")
        elif name in money:
            out.append(f"{parse_money_sql(name)} AS {ident(name)}")
        else:
            out.append(ident(name))
    return df.selectExpr(*out)
