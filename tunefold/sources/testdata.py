"""Reading the driver's parquet tables with only the columns a query needs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """``spark.read.parquet`` of one table, projected so the scan's ReadSchema is pruned."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df
