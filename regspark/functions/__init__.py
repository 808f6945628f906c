"""Scalar column expressions (built-in Spark functions only)."""

from regspark.functions.cleanse import (  # noqa: F401
    NULL_MARKERS,
    REPLACEMENT_CHAR,
    cast_dataset,
    full_id,
    has_replacement,
    null_marker,
    parse_date,
    parse_money,
    strip_replacement,
    tidy,
    tidy_strings,
)
