"""Quality checks: key null rate and gate, replacement-character counts,
rule checks with a per-row score and bands, orphan codes, alert rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regspark.functions.cleanse import has_replacement

# ---------------------------------------------------------------------------
# Score bands of the documented quality rules (percent of rules
# passed; lower bounds inclusive) and the default gate threshold.
# ---------------------------------------------------------------------------
BAND_READY = 90
BAND_MINOR = 70
BAND_NAMES = ("ready", "minor_alerts", "held")
DEFAULT_THRESHOLD = 90


class QualityGateError(ValueError):
    """Raised when the NULL rate of the first key column is above the limit."""


# --- Q1 / A5: key null rate --------------------------------------------------------

def key_null_stats(df: DataFrame, keys: Sequence[str],
                   threshold: int | float = DEFAULT_THRESHOLD) -> DataFrame:
    """One row: NULL rate of the first key column before and after dedup on ``keys``.

    Post-dedup numbers count distinct key tuples (NULLs group together, as
    ``dropDuplicates`` does). ``passed`` compares exactly in integers:
    rate <= 1 - threshold/100  <=>  nulls * 100 <= (100 - threshold) * total,
    so a rate of exactly 10 % passes threshold 90. Two aggregation levels,
    both with map-side partial aggregation; only key columns are shuffled.
    """
    first = keys[0]
    per_key = df.groupBy(*[F.col(k) for k in keys]).agg(F.count(F.lit(1)).alias("__n"))
    stats = per_key.agg(
        F.sum("__n").cast("bigint").alias("total_rows"),
        F.sum(F.when(F.col(first).isNull(), F.col("__n")).otherwise(0)).cast("bigint").alias("null_rows"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.count_if(F.col(first).isNull()).alias("null_keys"),
    )
    # Exact decimal limit, so a fractional threshold (e.g. 92.5) is exact too.
    limit = Decimal(100) - Decimal(str(threshold))
    return stats.select(
        "total_rows", "null_rows",
        (F.col("null_rows").cast("double") / F.col("total_rows").cast("double")).alias("null_rate"),
        "distinct_keys", "null_keys",
        (F.col("null_keys").cast("double") / F.col("distinct_keys").cast("double")).alias("null_rate_dedup"),
        F.lit(threshold).alias("threshold"),  # as given (int stays int)
        (F.coalesce(F.col("null_keys"), F.lit(0)).cast("decimal(38,0)") * 100
         <= F.lit(limit) * F.coalesce(F.col("distinct_keys"), F.lit(0)).cast("decimal(38,0)"))
        .alias("passed"),
    )


def enforce_gate(stats_row, key: str, threshold: int) -> None:
    """Raise :class:`QualityGateError` when the post-dedup gate failed."""
    if stats_row and stats_row["distinct_keys"] and not stats_row["passed"]:
        raise QualityGateError(
            f"{stats_row['null_keys']} of {stats_row['distinct_keys']} rows have no '{key}'; "
            f"the gate asks for at least {threshold} % with one"
        )


# --- A3 / A4: replacement characters ---------------------------------------------

def replacement_flags(columns: Sequence[str]) -> list[Column]:
    """A3: per column, 1 when any value holds U+FFFD, else 0 (aggregate exprs)."""
    return [F.coalesce(F.bool_or(has_replacement(c)), F.lit(False)).cast("int").alias(f"bad_{c}") for c in columns]


def replacement_cells(columns: Sequence[str], alias: str = "bad_cells") -> Column:
    """A4: number of *cells* holding U+FFFD over all ``columns`` (aggregate expr)."""
    return reduce(add, [F.count_if(has_replacement(c)) for c in columns]).alias(alias)


# --- Q4 / Q6: rules, score, bands, alerts ------------------------------------------

def score_rules(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Add ``rules_passed``, ``rules_total``, ``quality_score`` and ``quality_band``.

    A rule passes only when its expression is TRUE (NULL fails). The score is
    the share of passed rules in percent (double); bands are >= 90 ready,
    >= 70 minor alerts, else held.
    """
    checks = [F.coalesce(expr, F.lit(False)).cast("int") for expr in rules.values()]
    passed = checks[0]
    for c in checks[1:]:
        passed = passed + c
    n = len(checks)
    out = df.withColumn("rules_passed", passed).withColumn("rules_total", F.lit(n))
    out = out.withColumn(
        "quality_score", F.col("rules_passed").cast("double") * 100.0 / F.lit(float(n))
    )
    # Integer comparison keeps the band boundaries exact.
    ready = F.col("rules_passed") * 100 >= F.lit(BAND_READY * n)
    minor = F.col("rules_passed") * 100 >= F.lit(BAND_MINOR * n)
    return out.withColumn(
        "quality_band",
        F.when(ready, BAND_NAMES[0]).when(minor, BAND_NAMES[1]).otherwise(BAND_NAMES[2]),
    )


def rule_alerts(df: DataFrame, rules: Mapping[str, tuple[Column, str, str]],
                line_col: str, created_at: Column | None = None) -> DataFrame:
    """Q6 alert rows for every failed rule of every record.

    rules: name -> (check, field_name, severity). Output columns follow the
    alert table: alert_type, alert_message, record_line, severity,
    field_name, created_at.
    """
    created = created_at if created_at is not None else F.current_timestamp()
    entries = [
        F.when(
            ~F.coalesce(check, F.lit(False)),
            F.struct(
                F.lit(name).alias("alert_type"),
                F.lit(f"rule {name} failed on {field}").alias("alert_message"),
                F.lit(severity).alias("severity"),
                F.lit(field).alias("field_name"),
            ),
        )
        for name, (check, field, severity) in rules.items()
    ]
    exploded = df.select(
        F.col(line_col).try_cast("bigint").alias("record_line"),
        F.explode(F.filter(F.array(*entries), lambda e: e.isNotNull())).alias("a"),
    )
    return exploded.select(
        "a.alert_type", "a.alert_message", "record_line", "a.severity", "a.field_name",
        created.alias("created_at"),
    )


def unique_key_rule(df: DataFrame, keys: Sequence[str], name: str = "unique_key") -> DataFrame:
    """Add boolean ``name``: the record's key occurs exactly once.

    Only keys that occur more than once are joined back: counts are
    pre-aggregated map-side, and the side that comes back is nearly empty, so
    AQE broadcasts it and the table itself is not shuffled for the join. NULL
    keys group together (null-safe join), as they do in a GROUP BY.
    """
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__key_n")).where("__key_n > 1")
    repeated = repeated.select(*[F.col(k).alias(f"__key_{i}") for i, k in enumerate(keys)], "__key_n")
    cond = None
    for i, k in enumerate(keys):
        c = df[k].eqNullSafe(repeated[f"__key_{i}"])
        cond = c if cond is None else cond & c
    out = df.join(repeated, cond, "left").select(*[df[c] for c in df.columns], repeated["__key_n"])
    return out.withColumn(name, F.col("__key_n").isNull()).drop("__key_n")


def orphans(fact: DataFrame, dim: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """Q6 valid-code check: fact rows whose code has no match in ``dim`` (left anti)."""
    cond = None
    for f, d in on.items():
        c = fact[f] == dim[d]
        cond = c if cond is None else cond & c
    return fact.join(dim, cond, "left_anti")
