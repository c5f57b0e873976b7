"""JDBC scans.

The jobs read each table with ``option("query", ...)``, which gives one
partition per table: a single connection fetches every row.  At scale a
table is read with ``dbtable`` plus ``partitionColumn`` / ``lowerBound`` /
``upperBound`` / ``numPartitions`` (Spark issues one range query per
partition; ``query`` and ``partitionColumn`` exclude each other), and only
the needed columns are selected so the pushed query is narrow.  Filters on
the returned DataFrame are pushed to the database as WHERE clauses.

Credentials and URLs are the caller's; nothing is read from the environment.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(url: str, *, table: str | None = None, query: str | None = None,
                 partition_column: str | None = None, lower_bound: int | None = None,
                 upper_bound: int | None = None, num_partitions: int | None = None,
                 fetch_size: int = 10000, driver: str | None = None,
                 extra: Mapping[str, str] | None = None) -> dict[str, str]:
    if (table is None) == (query is None):
        raise ValueError("give exactly one of table or query")
    opts = {"url": url, "fetchsize": str(fetch_size)}
    if table is not None:
        opts["dbtable"] = table
    else:
        opts["query"] = query
    if partition_column is not None:
        if query is not None:
            raise ValueError("partition_column needs table, not query")
        if None in (lower_bound, upper_bound, num_partitions):
            raise ValueError("partition_column needs lower_bound, upper_bound and num_partitions")
        opts.update(partitionColumn=partition_column, lowerBound=str(lower_bound),
                    upperBound=str(upper_bound), numPartitions=str(num_partitions))
    if driver is not None:
        opts["driver"] = driver
    opts.update(extra or {})
    return opts


def read_jdbc(spark: SparkSession, url: str, columns: Iterable[str] | None = None,
              **kwargs) -> DataFrame:
    """A JDBC table (or query) as a DataFrame, optionally column-pruned."""
    df = spark.read.format("jdbc").options(**jdbc_options(url, **kwargs)).load()
    return df.select(*columns) if columns is not None else df


def read_jdbc_parts(spark: SparkSession, url: str, predicates: list[str], columns: Iterable[str] | None = None,
                    *, table: str, **kwargs) -> DataFrame:
    """A JDBC table read through one connection per condition; the conditions
    must not overlap, and rows that meet none are not read."""
    opts = jdbc_options(url, table=table, **kwargs)
    rest = {k: v for k, v in opts.items() if k not in ("url", "dbtable")}
    df = spark.read.jdbc(url, table, predicates=predicates, properties=rest)
    return df.select(*columns) if columns is not None else df


def load_tables(spark: SparkSession, url: str, tables: Mapping[str, Mapping],
                **common) -> dict[str, DataFrame]:
    """name → DataFrame for several tables; a failing table raises at once
    instead of being left out."""
    return {name: read_jdbc(spark, url, **{**common, **spec}) for name, spec in tables.items()}
