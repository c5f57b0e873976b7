"""Balances of every accounting date from one pass over the ledger.

One snapshot per date would read the ledger's history once per date.  Here ledger
rows and one marker per cut-off stand in one id order; the next cut-off at or after
each row is carried backwards over it (``operators.ordered.carry``), which says for
which dates the row is the first to count.  Per account and cut-off the last row
stays (partial aggregates, so a hot account costs a row per task and cut-off), and
holds for all dates from its cut-off to the account's next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daybook.operators.ledger import accounts
from daybook.operators.ordered import carry
from daybook.params import Ledger
from daybook.session import Scope


def cutoffs(led: Ledger) -> DataFrame:
    """(fecha, cutoff_id) of every accounting date: the highest transaction id that has
    the date in any attribute (``max_id_any_attribute`` for all dates at once)."""
    dates = led.cfv.filter(F.col("customfieldkey") == led.keys.fechcontab).select(F.col("value").alias("fecha")).distinct()
    rows = led.cfv.select("parentkey", "value").join(dates, F.col("value") == F.col("fecha"), "left_semi").distinct()
    t = led.trx.select("transactionid", "encodedkey")
    return (t.join(rows, t["encodedkey"] == rows["parentkey"], "inner")
            .groupBy(F.col("value").alias("fecha")).agg(F.max("transactionid").alias("cutoff_id")))


def balances_by_date(led: Ledger, scope: Scope) -> DataFrame:
    """(fecha, numcta, transaccion, saldo): each account's last transaction under the
    cut-off of each accounting date; accounts without one give no row for it."""
    dates = scope.save(cutoffs(led), "cutoffs")
    ranks = dates.select("cutoff_id").distinct().withColumn("rank", F.row_number().over(Window.orderBy("cutoff_id")))  # a row per date at most
    ranks = scope.save(ranks, "cutoff-ranks")
    rows = led.trx.select("transactionid", F.lit(0).alias("marker"), "parentaccountkey", "balance", F.lit(None).cast("int").alias("at"))
    marks = ranks.select(F.col("cutoff_id").alias("transactionid"), F.lit(1).alias("marker"), F.lit(None).cast("string").alias("parentaccountkey"),
                         F.lit(None).cast(led.trx.schema["balance"].dataType).alias("balance"), F.col("rank").alias("at"))
    placed = carry(rows.unionByName(marks), ["transactionid", "marker"], "at", "first", scope, backwards=True)
    last = F.max_by(F.struct("transactionid", "balance"), "transactionid").alias("t")
    own = (placed.filter((F.col("marker") == 0) & F.col("first").isNotNull())
           .groupBy("parentaccountkey", "first").agg(last).select("parentaccountkey", "first", "t.*"))
    acc = accounts(led, how="left").select("numcta", "account_key")
    own = (own.join(acc, own["parentaccountkey"] == acc["account_key"], "inner")
           .groupBy("numcta", "first").agg(last).select("numcta", "first", "t.*"))
    until = F.lead("first").over(Window.partitionBy("numcta").orderBy("first"))     # at most a row per date
    end = ranks.agg(F.max("rank")).scalar()
    held = own.withColumn("until", F.coalesce(until - 1, end)).withColumn("rank", F.explode(F.sequence("first", "until")))
    return (held.join(ranks, "rank").join(dates, "cutoff_id")
            .select("fecha", "numcta", F.col("transactionid").alias("transaccion"), F.col("balance").alias("saldo")))
