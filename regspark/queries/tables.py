"""Access to the driver's test tables and the registry roles they play.

company <-> customer, branch <-> orders, partner <-> lineitem,
code lists <-> nation / region / part / supplier,
month <-> ``yyyy-MM`` of the order date, run table <-> events,
raw text <-> documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def order_month(col: str = "o_orderdate") -> Column:
    """Month version ``yyyy-MM`` of a timestamp column."""
    return F.date_format(F.col(col), "yyyy-MM")
