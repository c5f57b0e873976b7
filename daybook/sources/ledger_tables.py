"""Load the ledger's source tables with the columns the jobs read.

The table and column lists are those of the extract jobs' source queries;
every scan selects only them (column pruning reaches the parquet reader or
the pushed JDBC query).  Tables come from parquet folders or from a JDBC
database; a missing table raises at once (the original logged the error and
failed later on a missing key).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from daybook.params import AttributeKeys, Ledger
from daybook.sources.jdbc import read_jdbc, read_jdbc_parts

# Source table and the columns read from it, per Ledger field.
TABLES = {
    "trx": ("savingstransaction", ["transactionid", "encodedkey", "parentaccountkey", "balance",
                                   "amount", "details_encodedkey_oid"]),
    "cta": ("savingsaccount", ["id", "accountstate", "encodedkey", "producttypekey", "blockedbalance",
                               "lockeddate", "closeddate", "accountholderkey", "activationdate",
                               "holdbalance"]),
    "prod": ("savingsproduct", ["id", "name", "encodedkey"]),
    "cli": ("client", ["encodedkey"]),
    "trxdet": ("transactiondetails", ["encodedkey", "transactionchannelkey"]),
    "trxch": ("transactionchannel", ["id", "encodedkey"]),
    "cfv": ("customfieldvalue", ["encodedkey", "parentkey", "customfieldkey", "value"]),
    "hld": ("holiday", ["isannualyrecurring", "monthofyear", "dayofmonth", "year", "name"]),
    "ahold": ("authorizationhold", ["externalreferenceid", "amount", "state", "cardreferencetoken"]),
}


def load_ledger_parquet(spark: SparkSession, base: str, keys: AttributeKeys | None = None,
                        paths: Mapping[str, str] | None = None) -> Ledger:
    """Tables from ``<base>/<table name>`` parquet folders (or ``paths``)."""
    out = {}
    for field, (table, cols) in TABLES.items():
        path = (paths or {}).get(field, f"{base.rstrip('/')}/{table}")
        out[field] = spark.read.parquet(path).select(*cols)
    return Ledger(keys=keys or AttributeKeys(), **out)


def load_ledger_jdbc(spark: SparkSession, url: str, keys: AttributeKeys | None = None,
                     bounds: Mapping[str, tuple[str, int, int, int]] | None = None,
                     predicates: Mapping[str, list[str]] | None = None, **options) -> Ledger:
    """Tables over JDBC.  ``bounds``: field → (partition column, lower,
    upper, partitions) for tables read in parallel ranges of a numeric
    column — at least the ledger (``trx`` on ``transactionid``).
    ``predicates``: field → conditions, one connection each (for the attribute
    table, one per attribute key; rows of other keys are not read).  A table
    without either is read through a single connection."""
    out = {}
    for field, (table, cols) in TABLES.items():
        kw = dict(options)
        if predicates and field in predicates:
            out[field] = read_jdbc_parts(spark, url, predicates[field], columns=cols, table=table, **kw)
            continue
        if bounds and field in bounds:
            col, lo, hi, n = bounds[field]
            kw.update(partition_column=col, lower_bound=lo, upper_bound=hi, num_partitions=n)
        out[field] = read_jdbc(spark, url, columns=cols, table=table, **kw)
    return Ledger(keys=keys or AttributeKeys(), **out)


def write_ledger_parquet(led: Ledger, base: str) -> None:
    """Write a ledger's tables as ``<base>/<table name>`` parquet folders."""
    for field, (table, _) in TABLES.items():
        getattr(led, field).write.mode("overwrite").parquet(f"{base.rstrip('/')}/{table}")


# Join keys of the two large tables: ledger rows meet attribute rows on them.
BUCKET_KEYS = {"trx": "encodedkey", "cfv": "parentkey"}


def _qualified(table: str, database: str | None) -> str:
    return f"{database}.{table}" if database else table


def write_ledger_tables(led: Ledger, database: str | None = None, buckets: int | None = None) -> None:
    """Save the tables in the session catalog under their source names.

    With ``buckets``, the ledger is bucketed by ``encodedkey`` and the
    attribute table by ``parentkey`` (same count, sorted within buckets), and
    the attribute table is partitioned by ``customfieldkey``: ledger ⋈
    attribute joins then read matching buckets side by side with no shuffle,
    and key filters prune partitions.  The catalog's warehouse must be on
    shared storage.
    """
    for field, (table, cols) in TABLES.items():
        w = getattr(led, field).select(*cols).write.mode("overwrite")
        if field == "cfv":
            w = w.partitionBy("customfieldkey")
        if buckets and field in BUCKET_KEYS:
            # dealt by the bucket key first: one file per bucket (and attribute key)
            w = getattr(led, field).select(*cols).repartition(buckets, BUCKET_KEYS[field]).write.mode("overwrite")
            if field == "cfv":
                w = w.partitionBy("customfieldkey")
            w = w.bucketBy(buckets, BUCKET_KEYS[field]).sortBy(BUCKET_KEYS[field])
        w.saveAsTable(_qualified(table, database))


def load_ledger_catalog(spark: SparkSession, database: str | None = None,
                        keys: AttributeKeys | None = None) -> Ledger:
    """Tables from the session catalog (``spark.table``), bucketing kept."""
    out = {field: spark.table(_qualified(table, database)).select(*cols)
           for field, (table, cols) in TABLES.items()}
    return Ledger(keys=keys or AttributeKeys(), **out)


def build_dated(led: Ledger) -> DataFrame:
    """Ledger rows joined to their accounting-date attribute: one row per
    (transaction, distinct accounting date), the date in ``accounting_date``.
    A repeated date row of a transaction is folded here, once, so a read of
    one date sees each transaction at most once without further work."""
    from pyspark.sql import functions as F

    from daybook.operators.ledger import DATED_COLUMN
    fc = (led.cfv.filter(F.col("customfieldkey") == led.keys.fechcontab)
          .select(F.col("parentkey").alias("__pk"), F.col("value").alias(DATED_COLUMN)).distinct())
    t = led.trx
    return t.join(fc, t["encodedkey"] == fc["__pk"], "inner").drop("__pk")


def write_dated_ledger(led: Ledger, path: str, dates=None, per_date: int = 16) -> None:
    """Write the dated layout partitioned by accounting date; a date is dealt to
    up to ``per_date`` tasks by the transaction's id.

    Without ``dates`` the whole layout is replaced, so dates that no longer exist
    go.  ``dates``: only these dates' partitions are replaced; when a transaction
    has been re-dated, its old date belongs into the list as well as its new one.
    A listed date without rows is emptied.
    """
    from pyspark.sql import functions as F

    from daybook.operators.ledger import DATED_COLUMN
    df = build_dated(led)
    if dates is not None:
        df = df.filter(F.col(DATED_COLUMN).isin(list(dates)))
    part = F.pmod(F.xxhash64("transactionid"), F.lit(per_date))
    w = (df.repartition(F.col(DATED_COLUMN), part).sortWithinPartitions(DATED_COLUMN, "transactionid")
         .write.mode("overwrite").partitionBy(DATED_COLUMN))
    if dates is None:
        w.option("partitionOverwriteMode", "static").parquet(path)
        return
    w.option("partitionOverwriteMode", "dynamic").parquet(path)
    spark = led.trx.sparkSession
    left = {r[0] for r in df.select(DATED_COLUMN).distinct().collect()}   # at most the listed dates
    for date in set(dates) - left:
        old = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{DATED_COLUMN}={date}")
        old.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(old, True)


def load_dated(spark: SparkSession, path: str, ledger_schema) -> DataFrame:
    """The dated layout with the ledger's own column types and the date kept
    as text (no partition-type guessing)."""
    from pyspark.sql import types as T

    from daybook.operators.ledger import DATED_COLUMN
    schema = T.StructType(list(ledger_schema.fields) + [T.StructField(DATED_COLUMN, T.StringType(), True)])
    return spark.read.schema(schema).parquet(path)


def with_dated(led: Ledger, spark: SparkSession, path: str) -> Ledger:
    """The same ledger with its dated layout read from ``path``."""
    import dataclasses
    return dataclasses.replace(led, dated=load_dated(spark, path, led.trx.schema))
