"""Reconciliation of the snapshot balance with the next-day movement.

For every account in the CASE-filtered snapshot that also has a non-zero
next-day movement (cut-off variant): balance − movement, as text with three decimals
left-padded with '0' to 15 characters.

The job broadcasts the movement side.  That side has one row per account
moving on N but not on D and so grows with the number of accounts; here the
join is left to Spark, which broadcasts only under
``spark.sql.autoBroadcastJoinThreshold`` (estimated size) or, with AQE, when
the shuffled size measured at run time is small — a checked size with a
sort-merge join beyond it.

The large side is reduced first: only accounts that moved can meet, so with a
``scope`` the movements are saved, all account keys of the moved numbers become a
key set, and the snapshot semi-joins ledger and accounts with it before it
aggregates them (a broadcast or a runtime bloom filter below the shuffle, as the
key set's size allows).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.functions.text import pad_left
from daybook.plans.movements import movements_nonzero
from daybook.plans.snapshot import snapshot_case_filter
from daybook.params import Ledger, RunParams
from daybook.session import Scope


def difference_text(saldo, amount, width: int = 15) -> F.Column:
    """``saldo - amount`` with three decimals, filled up with '0' to ``width``
    characters.  A longer difference stays whole (``decimal(38,3)``), neither
    cut nor NULL."""
    diff = (F.col(saldo) - F.col(amount)).cast("decimal(38,3)")
    return pad_left(diff, width)


def reconcile(main: DataFrame, mov: DataFrame) -> DataFrame:
    """Snapshot rows (``numcta2``, ``saldo``) meeting next-day movements
    (``numcta``, ``amount``): numcta, amount, saldo, numcta2, resta."""
    main = main.select("numcta2", "saldo")
    mov = mov.select("numcta", "amount")
    j = main.join(mov, main["numcta2"] == mov["numcta"], "inner")
    return j.select("numcta", "amount", "saldo", "numcta2",
                    difference_text("saldo", "amount").alias("resta"))


def keys_of(led: Ledger, numbers: DataFrame) -> DataFrame:
    """All account keys (``only_key``) of the account numbers in ``numbers`` (``numcta``)."""
    wanted = numbers.select(F.col("numcta").alias("__number"))
    return led.cta.join(wanted, led.cta["id"] == wanted["__number"], "left_semi").select(F.col("encodedkey").alias("only_key"))


def day_after_reconcile(led: Ledger, p: RunParams, scope: Scope | None = None) -> DataFrame:
    if scope is None:
        return reconcile(snapshot_case_filter(led, p, retentions=False), movements_nonzero(led, p))
    mov = scope.save(movements_nonzero(led, p, scope=scope), "movements")
    keys = scope.save(keys_of(led, mov), "moved-keys")
    return reconcile(snapshot_case_filter(led, p, retentions=False, only=keys), mov)
