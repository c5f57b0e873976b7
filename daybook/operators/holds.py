"""Authorisation holds: matching to transactions and retained amounts.

A hold names its transaction by an external reference ``<id>-<suffix>``;
the number in front of the first '-' is the transaction id.  A reference
without that shape matches nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.functions.codes import reference_number
from daybook.operators.attributes import attach_attributes
from daybook.operators.ledger import money
from daybook.params import RETENTION_1DAY, RETENTION_2DAYS, RETENTION_NDAYS, Ledger
from daybook.session import Scope


def holds_to_transactions(led: Ledger, state: str | None = None) -> DataFrame:
    """Holds joined to the transaction their reference names (equi join on
    the extracted number)."""
    h = led.ahold
    if state is not None:
        h = h.filter(F.col("state") == state)
    h = h.withColumn("__ref", reference_number("externalreferenceid"))
    t = led.trx.select("transactionid", F.col("encodedkey").alias("trx_key"))
    return h.join(t, h["__ref"] == t["transactionid"], "inner").drop("__ref")


def hold_retentions(led: Ledger, run_date: str, scope: Scope | None = None) -> DataFrame:
    """Pending holds per card reference: sums by the retention type of the
    held transaction — ``'1'``; ``'2'``, ``'3'``; ``'N'`` or no type value —
    for transactions whose accounting date is on or before ``run_date``
    (both attributes mandatory).  ``fechacontab`` is the latest accounting
    date of the group (the SQL selects it without grouping by it).
    With a ``scope`` the held transactions, which the attribute lookup reads for its
    keys and joins, are saved there: holds and ledger are read once.
    """
    k = led.keys
    j = holds_to_transactions(led, "PENDING").select("cardreferencetoken", "amount", "trx_key")
    if scope is not None:
        j = scope.save(j, "held-transactions")
    j = attach_attributes(j, "trx_key", led.cfv, {"__tipo": k.tiporetencion, "__fc": k.fechcontab},
                          required=("__tipo", "__fc"), restrict=True)
    j = j.filter(F.try_to_date(F.col("__fc")) <= F.lit(run_date).cast("date"))
    kind = money(led.ahold)
    zero = F.lit(0).cast(kind)
    tipo = F.col("__tipo")

    def bucket(cond):
        return F.sum(F.when(cond, F.col("amount")).otherwise(zero)).cast(kind)

    return j.groupBy(F.col("cardreferencetoken").alias("nro_cta")).agg(
        bucket(tipo.isin(list(RETENTION_1DAY))).alias("retencion_1dia"),
        bucket(tipo.isin(list(RETENTION_2DAYS))).alias("retencion_2dias"),
        bucket(tipo.isin(list(RETENTION_NDAYS)) | tipo.isNull()).alias("retencion_ndias"),
        F.max("__fc").alias("fechacontab"))
