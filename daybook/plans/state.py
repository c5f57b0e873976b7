"""The snapshot's state kept up to date, one day's ledger rows at a time.

A snapshot needs, per account key, the latest transaction under the date's
cut-off and the retention sums up to it (``operators.ledger.account_state``).
``SnapshotState`` keeps these as a table and merges only the rows between two
cut-offs into it, instead of reading the whole history each day.

Layout of the folder: ``v<n>/bucket=<k>`` holds bucket k (by hash of the account
key, rows sorted by it) as version n wrote it; ``manifest/v<n>`` names the version
of each bucket and the cut-off reached, and is written last, so a failed run leaves
the former version whole.  A day rewrites the buckets that it touches.  A state is
carried on from its latest version, by one writer at a time.

The cut-off of a date is the highest id with that date in any attribute.  It may
fall below an earlier day's, for instance when the one transaction that carried it
gets another date: then the accounts with transactions beyond the new cut-off are
computed again from the ledger, the others stay.  The ledger is append-only in its
ids: rows that arrive later under ids already passed, and retention types given to
them later, need ``SnapshotState.create``.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.operators.ledger import STATE_COLS, account_state, max_id_any_attribute, merge_states, money
from daybook.params import Ledger, RunParams
from daybook.plans.snapshot import q1_columns, snapshot_base

_MANIFEST = "bucket int, version int, upto long"


class SnapshotState:
    """One version of the state: which version holds each bucket, and the cut-off."""

    def __init__(self, spark: SparkSession, path: str, version: int, buckets: dict[int, int], upto: int):
        self.spark, self.path, self.version, self.buckets, self.upto = spark, path.rstrip("/"), version, buckets, upto

    # ------------------------------------------------------------------ make, load

    @classmethod
    def create(cls, led: Ledger, date: str, path: str, buckets: int = 64) -> SnapshotState:
        """The state at ``date`` from the whole history.  ``buckets`` should keep a
        bucket's accounts within one task."""
        spark = led.trx.sparkSession
        upto = cls._cutoff(led, date)
        empty = cls(spark, path, 0, dict.fromkeys(range(buckets), 0), upto)
        return empty._commit(account_state(led, F.lit(upto)), range(buckets), upto)

    @staticmethod
    def exists(spark: SparkSession, path: str) -> bool:
        p = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/manifest")
        return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> SnapshotState:
        """The latest version in a folder."""
        rows = spark.read.schema(_MANIFEST + ", v string").option("basePath", f"{path}/manifest").parquet(f"{path}/manifest")
        last = rows.agg(F.max(F.col("v").cast("int")).alias("v")).first().v
        own = rows.filter(F.col("v").cast("int") == last).collect()     # a row per bucket
        return cls(spark, path, last, {r.bucket: r.version for r in own}, own[0].upto)

    @staticmethod
    def _cutoff(led: Ledger, date: str) -> int:
        upto = max_id_any_attribute(led, date).first().cutoff_id
        if upto is None:
            raise ValueError(f"no transaction has an attribute with the date {date}, so it has no cut-off")
        return upto

    # ------------------------------------------------------------------ read

    def _bucket(self, key: str = "parentaccountkey"):
        return F.pmod(F.xxhash64(key), F.lit(len(self.buckets))).cast("int")

    def _read(self, buckets, columns: str) -> DataFrame:
        paths = [f"{self.path}/v{self.buckets[b]}/bucket={b}" for b in buckets if self.buckets[b]]
        if not paths:
            return self.spark.createDataFrame([], columns)
        return self.spark.read.schema(columns).parquet(*paths)

    def frame(self, led: Ledger) -> DataFrame:
        """``STATE_COLS`` of every account key."""
        return self._read(self.buckets, self._columns(led))

    @staticmethod
    def _columns(led: Ledger) -> str:
        kind, balance = money(led.trx), led.trx.schema["balance"].dataType.simpleString()
        return f"parentaccountkey string, transactionid long, trx_key string, balance {balance}, r1 {kind}, r2 {kind}, rn {kind}"

    def base(self, led: Ledger, p: RunParams, products=None, states=None) -> DataFrame:
        """``snapshot_base`` from the state; its cut-off must be that of ``p.run_date``."""
        if self._cutoff(led, p.run_date) != self.upto:
            raise ValueError(f"the state stands at another cut-off than {p.run_date}: apply that day first")
        return snapshot_base(led, p, products, states, state=self.frame(led))

    def balance_snapshot(self, led: Ledger, p: RunParams) -> DataFrame:
        return q1_columns(self.base(led, p, p.products, p.states), p)

    # ------------------------------------------------------------------ a day

    def apply(self, led: Ledger, date: str) -> SnapshotState:
        """The state at ``date``, as a new version."""
        upto, now, kind = self._cutoff(led, date), self.upto, money(led.trx)
        if upto == now:
            return self
        between = F.col("transactionid").between(F.lit(min(upto, now) + 1), F.lit(max(upto, now)))
        rows = led.trx.filter(between)
        keys = rows.select("parentaccountkey").distinct()
        touched = sorted(r.b for r in keys.select(self._bucket().alias("b")).distinct().collect())  # at most all buckets
        old = self._read(touched, self._columns(led))
        if upto > now:
            new = merge_states(old.unionByName(account_state(replace(led, trx=rows)).select(*STATE_COLS)), kind)
        else:
            own = led.trx.join(keys, "parentaccountkey", "left_semi").filter(F.col("transactionid") <= upto).select(*led.trx.columns)
            new = old.join(keys, "parentaccountkey", "left_anti").select(*STATE_COLS).unionByName(account_state(replace(led, trx=own)))
        return self._commit(new, touched, upto)

    def _commit(self, rows: DataFrame, touched, upto: int) -> SnapshotState:
        """Write the touched buckets as a new version, then its manifest."""
        version, touched = self.version + 1, list(touched)
        out = rows.withColumn("bucket", self._bucket())
        (out.repartition("bucket").sortWithinPartitions("bucket", "parentaccountkey")
         .write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/v{version}"))   # what a failed run left
        buckets = {**self.buckets, **dict.fromkeys(touched, version)}
        written = {r.bucket for r in self.spark.read.schema(_MANIFEST).parquet(f"{self.path}/v{version}")
                   .select("bucket").distinct().collect()} if touched else set()
        buckets = {b: 0 if b in touched and b not in written else v for b, v in buckets.items()}  # 0: an empty bucket
        manifest = [(b, v, upto) for b, v in sorted(buckets.items())]
        self.spark.createDataFrame(manifest, _MANIFEST).coalesce(1).write.mode("overwrite").parquet(
            f"{self.path}/manifest/v={version}")
        return SnapshotState(self.spark, self.path, version, buckets, upto)

    def prune(self) -> None:
        """Delete the versions that this one no longer reads."""
        jvm, held = self.spark._jvm, {*self.buckets.values(), self.version}
        for v in range(1, self.version):
            for name in [f"manifest/v={v}"] + ([] if v in held else [f"v{v}"]):
                p = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
                p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)
