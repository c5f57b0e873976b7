"""Balance snapshot as of the run date, and the account extracts around it.

The snapshot SQL joins the ledger to its accounts, products and clients,
looks up nine attributes with one join each, joins the last transaction per
account under a cut-off (a self join on ``MAX(id) GROUP BY account``) and the
retention sums.  Here:

* cut-off: a scalar subquery (``DataFrame.scalar``), never collected;
* last transaction and retention sums: one aggregation over the ledger
  (``latest_with_retentions``): partial ``max_by`` per account key, the
  ledger read once;
* attributes: one pivot per level — transaction attributes only for the
  selected last transactions, account attributes, client attributes.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.functions.dates import date_prefix
from daybook.operators.attributes import attach_attributes, attach_by_join, lookup_join
from daybook.operators.ledger import (accounts, latest_per_account, latest_with_retentions, max_id_any_attribute,
                                      money, states_by_number)
from daybook.params import ALL_STATES, BLOCK_CODE_EXCLUDED, Ledger, RunParams


def _account_names(led: Ledger, extra: dict | None = None) -> dict[str, str]:
    k = led.keys
    return {"tipocliente": k.tipocliente, "numctabech": k.numctabech, "fechaaperut": k.fechaperut,
            "oficina": k.ofiprod, "rut_tutor": k.ruttutor, **(extra or {})}


def _account_attrs(led: Ledger, df: DataFrame, extra: dict | None = None,
                   required=()) -> DataFrame:
    return attach_attributes(df, "account_key", led.cfv, _account_names(led, extra), required)


def _client_attrs(led: Ledger, df: DataFrame, required: bool = False) -> DataFrame:
    return attach_attributes(df, "accountholderkey", led.cfv, {"rut": led.keys.rut},
                             required=("rut",) if required else ())


def only_accounts(led: Ledger, keys: DataFrame) -> Ledger:
    """The ledger of the accounts in ``keys`` (column ``only_key``): accounts and
    transactions semi-joined before anything is aggregated."""
    return replace(led, cta=led.cta.join(keys, led.cta["encodedkey"] == keys["only_key"], "left_semi"),
                   trx=led.trx.join(keys, led.trx["parentaccountkey"] == keys["only_key"], "left_semi"))


def _lookups(led: Ledger, df: DataFrame) -> DataFrame:
    """Every attribute by an optional join of its own, as the SQL has them: an attribute
    row given twice makes two snapshot rows."""
    k = led.keys
    for entity, names in (("trx_key", {"fecha_contable_real": k.fechcontab, "adjuststate": k.adjust_state}),
                          ("account_key", _account_names(led, {"codblq": k.codblq})), ("accountholderkey", {"rut": k.rut})):
        for name, key in names.items():
            df = lookup_join(df, entity, led.cfv, name, key)
    return df


def snapshot_base(led: Ledger, p: RunParams, products=None, states=None, retentions: bool = True,
                  only: DataFrame | None = None, state: DataFrame | None = None, every_row: bool = False) -> DataFrame:
    """Last transaction under the cut-off per account number, with every
    attribute the snapshots read; filters applied after the latest pick,
    as the SQL applies them after its self join.

    ``retentions=False`` leaves the three retention sums NULL and with them the
    join of the whole ledger to its retention types, for outputs that do not
    show them.
    ``only``: the account keys (``only_key``, all keys of each number) that the caller
    goes on with; ledger and attribute rows of others are left out before they are
    aggregated.
    ``state``: the accounts' state at the date's cut-off (``operators.ledger.account_state``,
    kept up to date by ``plans.state``), read instead of the ledger.
    ``every_row``: repeated attribute rows multiply the snapshot's rows, as the SQL's
    joins do, instead of being folded."""
    k = led.keys
    if state is not None:
        latest = states_by_number(state, accounts(led, how="left"), money(led.trx))
    else:
        cutoff = max_id_any_attribute(led, p.run_date).select("cutoff_id").scalar()
        own = led if only is None else only_accounts(led, only)
        # the SQL's subqueries join transactions to accounts only
        all_acc = accounts(own, how="left")
        if retentions:
            latest = latest_with_retentions(own, cutoff, all_acc)
        else:
            none = F.lit(None).cast(money(led.trx))
            latest = latest_per_account(own, cutoff, all_acc).withColumns(
                {c: none for c in ("retencion_1dia", "retencion_2dias", "retencion_ndias")})
    # the outer query requires the product and the client
    cli = led.cli.select(F.col("encodedkey").alias("__cli"))
    latest = (latest.filter(F.col("product_key").isNotNull())
              .join(cli, F.col("accountholderkey") == cli["__cli"], "left_semi"))
    if products is not None:
        latest = latest.filter(F.col("producto").isin(list(products)))
    if states is not None:
        latest = latest.filter(F.col("accountstate").isin(list(states)))
    if every_row:
        return _lookups(led, latest)
    latest = attach_by_join(latest, "numcta", "trx_key", led.cfv,
                            {"fecha_contable_real": k.fechcontab, "adjuststate": k.adjust_state})
    if only is not None:    # few accounts: their attribute rows are joined, then folded
        latest = attach_by_join(latest, "numcta", "account_key", led.cfv, _account_names(led, {"codblq": k.codblq}))
        return attach_by_join(latest, "numcta", "accountholderkey", led.cfv, {"rut": k.rut})
    latest = _account_attrs(led, latest, {"codblq": k.codblq})
    return _client_attrs(led, latest)


def q1_columns(base: DataFrame, p: RunParams) -> DataFrame:
    """Q1's products/states filter and 19 columns over a snapshot base."""
    b = base.filter(F.col("producto").isin(list(p.products)) & F.col("accountstate").isin(list(p.states)))
    return b.select(
        "rut", "tipocliente", F.col("balance").alias("saldo"), "numcta",
        F.lit("00000").alias("numtrx"), "numctabech", F.col("accountstate").alias("estado"),
        "fechaaperut", F.col("activationdate").alias("fechaactiv"),
        F.col("closeddate").alias("fechacierre"), F.col("blockedbalance").alias("saldo_bloqueado"),
        F.col("transactionid").alias("transaccion"), "oficina", "retencion_1dia",
        "retencion_2dias", "retencion_ndias", "rut_tutor", "fecha_contable_real", "producto")


def balance_snapshot(led: Ledger, p: RunParams, retentions: bool = True, every_row: bool = False) -> DataFrame:
    """Q1: 19 columns, products P, open states (filtered before the
    attribute lookups)."""
    return q1_columns(snapshot_base(led, p, p.products, p.states, retentions, every_row=every_row), p)


def q2_columns(base: DataFrame, p: RunParams) -> DataFrame:
    """Q2's CASE filter and 20 columns over a snapshot base (see
    ``snapshot_case_filter``)."""
    state = F.col("accountstate")
    locked_today = date_prefix("lockeddate") == F.lit(p.run_date)
    then_ = F.col("producto").isin(list(p.products)) & state.isin(list(p.states)) & \
        (F.col("adjuststate") == "0")
    else_ = state.isin(list(p.states)) & ~((F.col("codblq") == BLOCK_CODE_EXCLUDED) & (state == "LOCKED"))
    b = base.filter(F.when(locked_today, then_).otherwise(else_))
    return b.select(
        "rut", "tipocliente", F.col("balance").alias("saldo"), F.col("numcta").alias("numcta2"),
        F.lit("00000").alias("numtrx"), "numctabech", F.col("accountstate").alias("estado"),
        "fechaaperut", F.col("activationdate").alias("fechaactiv"),
        F.col("closeddate").alias("fechacierre"), F.col("blockedbalance").alias("saldo_bloqueado"),
        F.col("transactionid").alias("id_trx"), "oficina", "retencion_1dia", "retencion_2dias",
        "retencion_ndias", "rut_tutor", "fecha_contable_real", "producto",
        F.col("codblq").alias("causal_blq"))


def snapshot_case_filter(led: Ledger, p: RunParams, retentions: bool = True, only: DataFrame | None = None) -> DataFrame:
    """Q2: 20 columns; the WHERE is a CASE used as a predicate.

    Locked on the run date → product in P, open state and adjustment state
    '0'; otherwise → open state and ``NOT (codblq = '99' AND LOCKED)`` (no
    product test in that branch).  A NULL branch value drops the row, as SQL
    does: a LOCKED account without block code fails the ELSE branch.
    """
    return q2_columns(snapshot_base(led, p, retentions=retentions, only=only), p)


def snapshot_preview(led: Ledger, p: RunParams, n: int = 5) -> DataFrame:
    """The first ``n`` snapshot rows by account number (a top-n report)."""
    return balance_snapshot(led, p).orderBy("numcta").limit(n)


def client_account_pairs(led: Ledger, p: RunParams) -> DataFrame:
    """Distinct (rut, account) pairs of the snapshot with a known rut, with
    the constant column the job adds by aggregating ``lit('new_col')``."""
    s = balance_snapshot(led, p, retentions=False)
    return (s.select("rut", "numcta").filter(F.col("rut").isNotNull())
            .groupBy("rut", "numcta").agg(F.lit("new_col").alias("new_col")))


def account_general_data(led: Ledger, p: RunParams) -> DataFrame:
    """Q7: every account of the products in any state, with its client and
    attributes.  rut, tipocliente, numctabech, fechaperut and ofiprod are
    mandatory; ruttutor, codblq and causalcierre optional (codblq and
    causalcierre never coexist, so mandatory lookups of all would be empty).
    """
    k = led.keys
    acc = accounts(led, p.products, ALL_STATES, require_client=True)
    acc = _account_attrs(led, acc, {"codbloqueo": k.codblq, "causalcierre": k.causalcierre},
                         required=("tipocliente", "numctabech", "fechaaperut", "oficina"))
    acc = _client_attrs(led, acc, required=True)
    return acc.select(
        "rut", "tipocliente", "numcta", "numctabech", F.col("accountstate").alias("estado"),
        "fechaaperut", F.col("activationdate").alias("fechaactiv"),
        F.col("closeddate").alias("fechacierre"), F.col("blockedbalance").alias("saldo_bloqueado"),
        "oficina", "rut_tutor", "producto", F.col("holdbalance").alias("saldo_retenido"),
        "codbloqueo", "causalcierre")


def balances_on_date(led: Ledger, p: RunParams) -> DataFrame:
    """Q8: account, id and running balance of every transaction whose
    accounting date is the run date."""
    from daybook.operators.ledger import trx_on_accounting_date
    t = trx_on_accounting_date(led, p.run_date)
    acc = accounts(led, how="left").select("numcta", "account_key")
    return (t.join(acc, t["parentaccountkey"] == acc["account_key"], "inner")
            .select("numcta", "transactionid", "balance"))
