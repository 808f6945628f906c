"""Exact distinct counts that merge: bitmaps over 8-digit keys, and the few other keys as text.

A key of exactly eight digits is a number below 10^8 and one bit of its bucket's
bitmap; every other key (shorter, with letters) stays as text, so that ``1`` and
``00000001`` are two keys. A month has at most 3,052 bitmaps of 4 KB, whatever its
number of rows; counts of several months OR them instead of rescanning the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the layout of a company id.
DIGITS = "^[0-9]{8}$"


def key_set(df: DataFrame, key: str, by: list[str]) -> DataFrame:
    """``by.., key_bucket, key_bits, other_key``: the distinct keys of every group; NULL is none.

    Bitmaps are partial aggregates of the map side, so a hot group costs its
    reducer one bitmap a task and bucket.
    """
    text = F.col(key).cast("string")
    number = F.when(text.rlike(DIGITS), text.cast("long"))
    rows = df.where(text.isNotNull()).select(*by, number.alias("__n"), F.when(number.isNull(), text).alias("other_key"))
    bits = rows.where("__n IS NOT NULL").groupBy(*by, F.expr("bitmap_bucket_number(__n)").alias("key_bucket")).agg(
        F.expr("bitmap_construct_agg(bitmap_bit_position(__n))").alias("key_bits"))
    others = rows.where("__n IS NULL").select(*by, "other_key").distinct()
    return bits.select(*by, "key_bucket", "key_bits", F.lit(None).cast("string").alias("other_key")).unionAll(
        others.select(*by, F.lit(None).cast("long"), F.lit(None).cast("binary"), "other_key"))


def merged_count(keys: DataFrame, by: dict[str, Column], out: str) -> DataFrame:
    """Distinct keys per group of key sets, merged exactly."""
    groups = list(by)
    rows = keys.select(*[c.alias(n) for n, c in by.items()], "key_bucket", "key_bits", "other_key")
    bits = rows.where("key_bits IS NOT NULL").groupBy(*groups, "key_bucket").agg(F.expr("bitmap_count(bitmap_or_agg(key_bits))").alias("n"))
    others = rows.where("other_key IS NOT NULL").groupBy(*groups).agg(F.countDistinct("other_key").alias("n"))
    # Groups that hold NULL keys only count zero: they come from the empty rows of the key sets.
    none = rows.select(*groups).distinct().withColumn("n", F.lit(0).cast("long"))
    return bits.select(*groups, "n").unionAll(others).unionAll(none).groupBy(*groups).agg(F.sum("n").alias(out))
