"""Next-day movements: accounts that move on day N = D + 1 but not on D.

Three variants of the same question exist in the jobs; all are kept:

* ``next_day_movements`` — accounting date N, adjustment state '0', product
  in P; accounts that moved on D (same products) excluded.  No state filter,
  no id cut-off.
* ``next_day_movements_cutoff`` — accounting date N, id at most the highest
  id of D among the products, open states, product in P; accounts of those
  products and states that moved on D excluded.
* ``movements_in_id_range`` — both sides restricted to ids between the
  lowest and highest id of D, adjustment state '0', product in P.

Each is: a semi join of the transactions with the attribute rows of the
date (broadcast by AQE only when that slice is small, checked at run time),
a per-account partial sum, the account join, a null-aware ``NOT IN`` and the
final sum per account and product.  Day D's activity per account
(``day_activity``) feeds the id bounds, the cut-off and the ``NOT IN`` list;
with a ``scope`` it is saved there once, so that the ledger is read once for D and
once for N, and so is the ``NOT IN`` list, which is read for its NULLs and for the
match.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.operators.ledger import (accounts, activity_bounds, day_activity, id_at_most, id_between,
                                      max_id_by_product, moved_accounts, sum_per_account, trx_with)
from daybook.params import Ledger, RunParams
from daybook.session import Scope


def _once(df: DataFrame, scope: Scope | None, name: str) -> DataFrame:
    return df if scope is None else scope.save(df, name)


def _day_d(led: Ledger, p: RunParams, activity: DataFrame | None, scope: Scope | None) -> DataFrame:
    return _once(day_activity(led, p.run_date), scope, "day-activity") if activity is None else activity


def next_day_movements(led: Ledger, p: RunParams, scope: Scope | None = None) -> DataFrame:
    k = led.keys
    t = trx_with(led, {k.fechcontab: p.next_day, k.adjust_state: "0"})
    moved = _once(moved_accounts(led, p.run_date, p.products), scope, "moved")
    return sum_per_account(t, accounts(led, p.products), moved)


def cutoff_for(led: Ledger, p: RunParams, activity: DataFrame | None = None):
    """Highest id of D among the products, as a scalar-subquery Column."""
    return max_id_by_product(led, p.run_date, p.products, activity).select("id_transaction_max").scalar()


def next_day_movements_cutoff(led: Ledger, p: RunParams, group_product: bool = True, activity: DataFrame | None = None,
                              scope: Scope | None = None) -> DataFrame:
    """``activity``: day D's activity per account (``day_activity``), e.g.
    already written once by the caller; computed here when not given."""
    day_d = _day_d(led, p, activity, scope)
    t = trx_with(led, {led.keys.fechcontab: p.next_day}, id_at_most(cutoff_for(led, p, day_d)))
    moved = _once(moved_accounts(led, p.run_date, p.products, p.states, activity=day_d), scope, "moved")
    return sum_per_account(t, accounts(led, p.products, p.states), moved, group_product)


def movements_nonzero(led: Ledger, p: RunParams, activity: DataFrame | None = None, scope: Scope | None = None) -> DataFrame:
    """The cut-off variant without accounts whose movements sum to zero."""
    return next_day_movements_cutoff(led, p, activity=activity, scope=scope).filter(F.col("amount") != 0)


def movements_loose_group(led: Ledger, p: RunParams, scope: Scope | None = None) -> DataFrame:
    """The cut-off variant grouped by account only; the product is any value
    of the group (one product per account, so deterministic)."""
    return next_day_movements_cutoff(led, p, group_product=False, scope=scope)


def movements_in_id_range(led: Ledger, p: RunParams, scope: Scope | None = None) -> DataFrame:
    """Day D's own transactions lie between D's bounds by their definition, so its
    activity needs no second pass for them."""
    k = led.keys
    day_d = _day_d(led, p, None, scope)
    t = trx_with(led, {k.fechcontab: p.next_day, k.adjust_state: "0"}, id_between(activity_bounds(day_d)))
    moved = _once(moved_accounts(led, p.run_date, p.products, activity=day_d), scope, "moved")
    return sum_per_account(t, accounts(led, p.products), moved)
