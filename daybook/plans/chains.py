"""Whole-ledger summaries: join chains and transaction channels.

Both aggregate the transactions first (per account key, per channel key) on
the map side and join the small dimension tables afterwards, so the ledger is
shuffled once, already reduced, and never joined row by row to accounts.
Joins distribute over the sums, so the result equals join-then-aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.operators.ledger import accounts, money
from daybook.params import Ledger


def ledger_chain(led: Ledger, inner: bool = True) -> DataFrame:
    """Transactions per (product, account state): count and sum.

    ``inner``: transaction → account → product → client, all inner.
    Otherwise transaction ⟕ account ⟕ product: transactions of missing
    accounts or products fall into NULL groups.
    """
    lvl1 = led.trx.groupBy("parentaccountkey").agg(
        F.count(F.lit(1)).alias("__n"), F.sum("amount").alias("__s"))
    acc = accounts(led, how="inner" if inner else "left", require_client=inner)
    acc = acc.select("account_key", "producto", "accountstate")
    j = lvl1.join(acc, lvl1["parentaccountkey"] == acc["account_key"], "inner" if inner else "left")
    return j.groupBy("producto", F.col("accountstate").alias("estado")).agg(
        F.sum("__n").cast("bigint").alias("n_trx"), F.sum("__s").cast(money(led.trx)).alias("total_amount"))


def trx_channel(led: Ledger) -> DataFrame:
    """Transactions per channel: transaction ⟕ details ⟕ channel.

    Transactions are joined to their details (the one join of two large
    tables), aggregated per channel key, and only the aggregate meets the
    channel table.
    """
    t = led.trx.select("details_encodedkey_oid", "amount")
    det = led.trxdet.select(F.col("encodedkey").alias("__det"), "transactionchannelkey")
    j = t.join(det, t["details_encodedkey_oid"] == det["__det"], "left")
    per_key = j.groupBy("transactionchannelkey").agg(
        F.count(F.lit(1)).alias("__n"), F.sum("amount").alias("__s"))
    ch = led.trxch.select(F.col("id").alias("channel"), F.col("encodedkey").alias("__ch"))
    k = per_key.join(ch, per_key["transactionchannelkey"] == ch["__ch"], "left")
    return k.groupBy("channel").agg(F.sum("__n").cast("bigint").alias("n_trx"),
                                    F.sum("__s").cast(money(led.trx)).alias("total_amount"))
