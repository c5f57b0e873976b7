"""Ledger building blocks: accounts, cut-offs, latest transaction, sums.

Conventions
-----------
``accounts(led)`` renames the account table's columns so that joins never
clash: ``numcta`` (account number, ``cta.id``), ``account_key``
(``cta.encodedkey``), ``producto`` (``prod.id``), plus the account's own
columns.  Transaction columns keep their names (``transactionid``,
``encodedkey``, ``parentaccountkey``, ``balance``, ``amount``).

Aggregations over transactions are done in two levels: first per
``parentaccountkey`` straight on the transaction table (map-side partial
aggregation, before any join, so a hot account costs one row per map task),
then per account number after joining the — much smaller — account table.
The second level keeps the SQL's semantics even if one account number were
shared by two account keys.

Attribute conditions on transactions (accounting date, adjustment state)
are semi joins against the attribute rows: a transaction counts once even if
its attribute row were duplicated (the SQL's join would count it twice).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.params import (BLOCK_CODE_EXCLUDED, RETENTION_1DAY, RETENTION_2DAYS,
                            RETENTION_NDAYS, Ledger)
from daybook.operators.anti import not_in
from daybook.operators.attributes import lookup_join


def money(df: DataFrame, col: str = "amount") -> str:
    """The type of sums of ``df[col]``: its own scale, all digits Spark has."""
    kind = df.schema[col].dataType
    if isinstance(kind, T.DecimalType):
        return f"decimal(38,{kind.scale})"
    return "double" if isinstance(kind, (T.DoubleType, T.FloatType)) else "decimal(38,0)"


ACCOUNT_COLS = ["numcta", "account_key", "accountstate", "producttypekey", "blockedbalance",
                "lockeddate", "closeddate", "accountholderkey", "activationdate", "holdbalance"]


# --------------------------------------------------------------------------- accounts

def accounts(led: Ledger, products: Sequence[str] | None = None,
             states: Sequence[str] | None = None, how: str = "inner",
             require_client: bool = False) -> DataFrame:
    """Accounts joined to their product (``producto``).

    ``products`` / ``states``: IN-list filters (pushed to the scans).
    ``how='left'`` keeps accounts whose product is missing (``product_key``
    NULL).
    ``require_client``: keep only accounts whose holder exists in ``client``.
    """
    cta = led.cta.select(F.col("id").alias("numcta"), F.col("encodedkey").alias("account_key"),
                         *[c for c in ACCOUNT_COLS[2:] if c in led.cta.columns])
    if states is not None:
        cta = cta.filter(F.col("accountstate").isin(list(states)))
    prod = led.prod.select(F.col("id").alias("producto"), F.col("encodedkey").alias("product_key"))
    if products is not None:
        prod = prod.filter(F.col("producto").isin(list(products)))
        how = "inner"
    out = cta.join(prod, cta["producttypekey"] == prod["product_key"], how)
    if require_client:
        cli = led.cli.select(F.col("encodedkey").alias("__cli"))
        out = out.join(cli, out["accountholderkey"] == cli["__cli"], "left_semi")
    return out


# --------------------------------------------------------------------------- attribute conditions

DATED_COLUMN = "accounting_date"


def dated_day(led: Ledger, date: str) -> DataFrame:
    """The ledger rows whose accounting date is ``date``, read from the dated
    layout (``led.dated``): only that date's partition is scanned.  The
    layout holds each (transaction, date) once, so a transaction whose date
    attribute was repeated still appears once."""
    return led.dated.filter(F.col(DATED_COLUMN) == date).select(*led.trx.columns)


def trx_with(led: Ledger, conditions: Mapping[str, str], where: Column | None = None) -> DataFrame:
    """Transactions whose attributes satisfy ``conditions`` (key → value),
    restricted by the predicate ``where`` (e.g. an id cut-off).

    The accounting-date condition reads the dated layout when the ledger has
    one (partition pruning: one date's rows, not the whole history).  Every
    other condition — and the date itself without the layout — is a semi
    join against the filtered attribute slice, in the order given, so Spark
    can prune the large side with a runtime bloom filter before shuffling.
    """
    conds = dict(conditions)
    fc = led.keys.fechcontab
    if led.dated is not None and fc in conds:
        t = dated_day(led, conds.pop(fc))
    else:
        t = led.trx
    if where is not None:
        t = t.filter(where)
    for key, value in conds.items():
        keys = led.cfv.filter((F.col("customfieldkey") == key) & (F.col("value") == value)).select("parentkey")
        t = t.join(keys, t["encodedkey"] == keys["parentkey"], "left_semi")
    return t


def trx_with_any_attribute(led: Ledger, value: str, trx: DataFrame | None = None) -> DataFrame:
    """Transactions having *some* attribute equal to ``value`` (no key test)."""
    trx = led.trx if trx is None else trx
    keys = led.cfv.filter(F.col("value") == value).select("parentkey")
    return trx.join(keys, trx["encodedkey"] == keys["parentkey"], "left_semi")


def trx_on_accounting_date(led: Ledger, date: str, where: Column | None = None) -> DataFrame:
    return trx_with(led, {led.keys.fechcontab: date}, where)


def id_between(bounds: DataFrame) -> Column:
    """``transactionid BETWEEN min AND max`` with bounds from a 1-row frame
    (``id_transaction_min``, ``id_transaction_max``) as one scalar subquery."""
    b = bounds.select(F.struct("id_transaction_min", "id_transaction_max")).scalar()
    return F.col("transactionid").between(b.getField("id_transaction_min"),
                                          b.getField("id_transaction_max"))


def id_at_most(cutoff: Column) -> Column:
    """``transactionid <= cutoff``; a NULL cut-off keeps no row."""
    return F.col("transactionid") <= cutoff


def up_to(trx: DataFrame, cutoff: Column | None) -> DataFrame:
    """``transactionid <= cutoff``; a NULL cut-off (no transaction on the
    date) keeps no row."""
    return trx if cutoff is None else trx.filter(F.col("transactionid") <= cutoff)


# --------------------------------------------------------------------------- cut-offs (1-row frames)

def id_bounds_on_date(led: Ledger, date: str) -> DataFrame:
    """MIN and MAX transaction id with accounting date ``date``: one pass."""
    t = trx_on_accounting_date(led, date)
    return t.agg(F.min("transactionid").alias("id_transaction_min"),
                 F.max("transactionid").alias("id_transaction_max"))


def max_id_any_attribute(led: Ledger, date: str) -> DataFrame:
    """Cut-off of the snapshot SQL: the highest transaction id having any
    attribute equal to ``date``."""
    return trx_with_any_attribute(led, date).agg(F.max("transactionid").alias("cutoff_id"))


def max_id_accounting_date(led: Ledger, date: str) -> DataFrame:
    return trx_on_accounting_date(led, date).agg(F.max("transactionid").alias("cutoff_id"))


def day_activity(led: Ledger, date: str, where: Column | None = None) -> DataFrame:
    """Per account key, the lowest and highest id among its transactions with
    accounting date ``date``: ``(parentaccountkey, min_id, max_id)``.

    One semi join of the ledger with the date's attribute rows and one hash
    aggregate.  The id bounds and the cut-off of the date and the list of
    accounts that moved on it are all defined on this frame, which callers save
    in a scope: Spark would plan each use separately and read the ledger for each.
    """
    t = trx_on_accounting_date(led, date, where)
    return t.groupBy("parentaccountkey").agg(F.min("transactionid").alias("min_id"), F.max("transactionid").alias("max_id"))


def activity_bounds(activity: DataFrame) -> DataFrame:
    """``id_bounds_on_date`` of a day's activity."""
    return activity.agg(F.min("min_id").alias("id_transaction_min"), F.max("max_id").alias("id_transaction_max"))


def _max_id_via_accounts(activity: DataFrame, acc: DataFrame) -> DataFrame:
    j = activity.join(acc, activity["parentaccountkey"] == acc["account_key"], "inner")
    return j.agg(F.max("max_id").alias("id_transaction_max"))


def max_id_by_product(led: Ledger, date: str, products: Sequence[str],
                      activity: DataFrame | None = None) -> DataFrame:
    """Highest id with accounting date ``date`` among accounts of ``products``
    (the left joins of the SQL are inner through its WHERE)."""
    activity = day_activity(led, date) if activity is None else activity
    return _max_id_via_accounts(activity, accounts(led, products))


def max_id_unblocked(led: Ledger, date: str, products: Sequence[str]) -> DataFrame:
    """As ``max_id_by_product`` with a mandatory block code and
    ``NOT (codblq = '99' AND accountstate = 'LOCKED')``."""
    acc = lookup_join(accounts(led, products), "account_key", led.cfv, "codblq",
                      led.keys.codblq, how="inner")
    acc = acc.filter(~((F.col("codblq") == BLOCK_CODE_EXCLUDED) & (F.col("accountstate") == "LOCKED")))
    return _max_id_via_accounts(day_activity(led, date), acc)


# --------------------------------------------------------------------------- latest transaction

def latest_per_account(led: Ledger, cutoff: Column | None = None,
                       acc: DataFrame | None = None) -> DataFrame:
    """Last transaction (highest id, ``<= cutoff``) per account number.

    Level 1: ``max_by(struct(id, key, balance), id)`` per
    ``parentaccountkey`` on the transactions alone.  The struct holds a
    string, so Spark aggregates by sorting — but the partial step sorts only
    each task's own input split, locally, and ships one row per account per
    task; the ledger is read once and never shuffled.  (Fetching the rows by
    id after a hash-aggregated ``max(id)`` would read the ledger twice and
    shuffle all of it once the id list is too large to broadcast.)
    Level 2: after joining the accounts, the same per ``numcta``.
    Output: the account columns plus ``transactionid``, ``trx_key``,
    ``balance``.
    """
    acc = accounts(led) if acc is None else acc
    t = up_to(led.trx, cutoff)
    lvl1 = (t.groupBy("parentaccountkey")
            .agg(F.max_by(F.struct("transactionid", F.col("encodedkey").alias("trx_key"), "balance"),
                          "transactionid").alias("__t"))
            .select("parentaccountkey", "__t.*"))
    j = acc.join(lvl1, acc["account_key"] == lvl1["parentaccountkey"], "inner").drop("parentaccountkey")
    rest = [c for c in j.columns if c != "numcta"]
    return (j.groupBy("numcta")
            .agg(F.max_by(F.struct(*rest), "transactionid").alias("__r"))
            .select("numcta", "__r.*"))


def latest_per_account_window(led: Ledger, cutoff: Column | None = None,
                              acc: DataFrame | None = None) -> DataFrame:
    """Same result with ``row_number`` windows.

    ``row_number() = 1`` lets Spark put a per-partition group limit before the
    shuffle, so a hot account contributes one row per map task, not all of its
    transactions.
    """
    from pyspark.sql import Window
    acc = accounts(led) if acc is None else acc
    t = up_to(led.trx, cutoff).select(
        "parentaccountkey", "transactionid", F.col("encodedkey").alias("trx_key"), "balance")
    w1 = Window.partitionBy("parentaccountkey").orderBy(F.col("transactionid").desc())
    lvl1 = t.withColumn("__rn", F.row_number().over(w1)).filter(F.col("__rn") == 1).drop("__rn")
    j = acc.join(lvl1, acc["account_key"] == lvl1["parentaccountkey"], "inner").drop("parentaccountkey")
    w2 = Window.partitionBy("numcta").orderBy(F.col("transactionid").desc())
    return j.withColumn("__rn", F.row_number().over(w2)).filter(F.col("__rn") == 1).drop("__rn")


# --------------------------------------------------------------------------- retentions

def retention_buckets(led: Ledger, cutoff: Column | None = None,
                      acc: DataFrame | None = None) -> DataFrame:
    """Per account number: sums of amount by retention type of the
    transaction (``'1'``; ``'2'``, ``'3'``; ``'N'``), transactions up to the
    cut-off that carry a retention-type attribute (its value may be NULL:
    such a transaction adds 0 to every bucket)."""
    acc = accounts(led) if acc is None else acc
    t = up_to(led.trx, cutoff).select("encodedkey", "parentaccountkey", "amount")
    r = (led.cfv.filter(F.col("customfieldkey") == led.keys.tiporetencion)
         .select(F.col("parentkey").alias("__pk"), F.col("value").alias("__tipo")))
    j = t.join(r, t["encodedkey"] == r["__pk"], "inner")
    kind = money(led.trx)
    zero = F.lit(0).cast(kind)

    def bucket(vals):
        return F.sum(F.when(F.col("__tipo").isin(list(vals)), F.col("amount")).otherwise(zero))

    lvl1 = j.groupBy("parentaccountkey").agg(
        bucket(RETENTION_1DAY).alias("r1"), bucket(RETENTION_2DAYS).alias("r2"),
        bucket(RETENTION_NDAYS).alias("rn"))
    j2 = acc.select("numcta", "account_key").join(
        lvl1, F.col("account_key") == F.col("parentaccountkey"), "inner")
    return j2.groupBy(F.col("numcta").alias("nro_cta")).agg(
        F.sum("r1").cast(kind).alias("retencion_1dia"),
        F.sum("r2").cast(kind).alias("retencion_2dias"),
        F.sum("rn").cast(kind).alias("retencion_ndias"))


def latest_with_retentions(led: Ledger, cutoff: Column | None = None,
                           acc: DataFrame | None = None) -> DataFrame:
    """``latest_per_account`` and ``retention_buckets`` in one pass over the
    ledger.

    The transactions up to the cut-off are left-joined once to their
    retention-type attribute (the one shuffle of the ledger, on its unique
    key) and aggregated once per account key: the latest row
    (``max_by``) and the three bucket sums.  A bucket is NULL when the
    account has no transaction with a retention type — the SQL's LEFT JOIN
    to its retention subquery.  Level 2 per account number.  Output: account
    columns, ``transactionid``, ``trx_key``, ``balance``, ``retencion_1dia``,
    ``retencion_2dias``, ``retencion_ndias``.
    """
    acc = accounts(led) if acc is None else acc
    return states_by_number(account_state(led, cutoff), acc, money(led.trx))


#: The columns of an account's state, by its key.
STATE_COLS = ["parentaccountkey", "transactionid", "trx_key", "balance", "r1", "r2", "rn"]


def account_state(led: Ledger, cutoff: Column | None = None) -> DataFrame:
    """Per account key, ``STATE_COLS``: the latest transaction up to the cut-off and the
    retention sums (NULL when no transaction has a retention type)."""
    t = up_to(led.trx, cutoff).select("transactionid", "encodedkey", "parentaccountkey", "balance", "amount")
    r = (led.cfv.filter(F.col("customfieldkey") == led.keys.tiporetencion)
         .select(F.col("parentkey").alias("__pk"), F.col("value").alias("__tipo")))
    j = t.join(r, t["encodedkey"] == r["__pk"], "left")
    has = F.col("__pk").isNotNull()
    kind = money(led.trx)
    zero = F.lit(0).cast(kind)

    def bucket(vals):
        return F.sum(F.when(has, F.when(F.col("__tipo").isin(list(vals)), F.col("amount")).otherwise(zero))).cast(kind)

    row = F.struct("transactionid", F.col("encodedkey").alias("trx_key"), "balance")
    return j.groupBy("parentaccountkey").agg(
        F.max_by(row, "transactionid").alias("__t"), bucket(RETENTION_1DAY).alias("r1"),
        bucket(RETENTION_2DAYS).alias("r2"), bucket(RETENTION_NDAYS).alias("rn")).select(
        "parentaccountkey", "__t.*", "r1", "r2", "rn")


def merge_states(states: DataFrame, kind: str) -> DataFrame:
    """States of disjoint sets of transactions folded into one row per account key."""
    row = F.struct("transactionid", "trx_key", "balance")
    return states.groupBy("parentaccountkey").agg(
        F.max_by(row, "transactionid").alias("__t"), *[F.sum(c).cast(kind).alias(c) for c in ("r1", "r2", "rn")]).select(
        "parentaccountkey", "__t.*", "r1", "r2", "rn")


def states_by_number(state: DataFrame, acc: DataFrame, kind: str) -> DataFrame:
    """The state of each account number: the latest transaction and the summed
    retentions of its keys, with the account columns of the latest one's key."""
    own = state.select("parentaccountkey", F.struct("transactionid", "trx_key", "balance").alias("__t"),
                       *[F.col(c).alias(f"__{c}") for c in ("r1", "r2", "rn")])
    j2 = acc.join(own, acc["account_key"] == own["parentaccountkey"], "inner").drop("parentaccountkey")
    rest = [c for c in j2.columns if c not in ("numcta", "__r1", "__r2", "__rn")]
    return (j2.groupBy("numcta")
            .agg(F.max_by(F.struct(*rest), F.col("__t.transactionid")).alias("__x"),
                 F.sum("__r1").cast(kind).alias("retencion_1dia"),
                 F.sum("__r2").cast(kind).alias("retencion_2dias"),
                 F.sum("__rn").cast(kind).alias("retencion_ndias"))
            .select("numcta", "__x.*", "retencion_1dia", "retencion_2dias", "retencion_ndias")
            .select(*[c for c in acc.columns], "__t.*", "retencion_1dia", "retencion_2dias",
                    "retencion_ndias"))


# --------------------------------------------------------------------------- movements

def moved_accounts(led: Ledger, date: str, products: Sequence[str] | None,
                   states: Sequence[str] | None = None,
                   where: Column | None = None,
                   activity: DataFrame | None = None) -> DataFrame:
    """Account numbers with a transaction of accounting date ``date``
    (matching ``where``; column ``numcta``; may repeat — callers use it as a
    NOT IN list)."""
    activity = day_activity(led, date, where) if activity is None else activity
    acc = accounts(led, products, states)
    return acc.join(activity, acc["account_key"] == activity["parentaccountkey"], "left_semi").select("numcta")


def sum_per_account(t: DataFrame, acc: DataFrame, not_moved: DataFrame | None = None,
                    group_product: bool = True) -> DataFrame:
    """``SUM(amount) GROUP BY numcta, producto`` of transactions ``t`` whose
    account is in ``acc`` and, if given, ``numcta NOT IN not_moved``."""
    kind = money(t)
    lvl1 = t.groupBy("parentaccountkey").agg(F.sum("amount").alias("__s"))
    j = acc.select("numcta", "account_key", "producto").join(
        lvl1, F.col("account_key") == F.col("parentaccountkey"), "inner")
    if not_moved is not None:
        j = not_in(j, "numcta", not_moved, "numcta")
    if group_product:
        return j.groupBy("numcta", "producto").agg(F.sum("__s").cast(kind).alias("amount"))
    return j.groupBy("numcta").agg(F.sum("__s").cast(kind).alias("amount"),
                                   F.any_value("producto").alias("producto"))
