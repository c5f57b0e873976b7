"""Column-pruned parquet scans.

``read_table`` names the columns it needs so the scan's ReadSchema holds only
those; filters applied afterwards reach the scan as PushedFilters.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str,
               columns: Iterable[str] | None = None) -> DataFrame:
    df = spark.read.parquet(table_path(sf_dir, name))
    if columns is not None:
        df = df.select(*columns)
    return df


def rename_ids(df: DataFrame, new_name: str, old_name: str = "id") -> DataFrame:
    """``withColumnRenamed('id', 'ctaid')`` as used before joining tables
    that all carry an ``id`` column."""
    return df.withColumnRenamed(old_name, new_name)
