"""The snapshot's state, day by day, against the snapshot from the whole history."""

from __future__ import annotations

import random
from dataclasses import replace

import pytest
from conftest import account, attr, make_ledger, trx

from daybook.params import RunParams
from daybook.plans.history import balances_by_date
from daybook.plans.snapshot import balance_snapshot, snapshot_base
from daybook.plans.state import SnapshotState
from daybook.session import Scope

DAYS = [f"2024-01-{d:02d}" for d in range(10, 15)]


def history(seed, days=DAYS, per_day=12, accounts=7):
    rng, rows, attrs, i = random.Random(seed), [], [], 0
    for day in days:
        for _ in range(per_day):
            i += 1
            rows.append(trx(i, rng.randrange(1, accounts + 1), rng.randrange(-50, 50), balance=rng.randrange(1000)))
            attrs.append(attr(f"trx-{i}", "fechcontab", day))
            if rng.random() < 0.5:
                attrs.append(attr(f"trx-{i}", "tiporetencion", rng.choice(["1", "2", "3", "N", None])))
    return rows, attrs


def people(n=7):
    # account numbers 6 and 7 share one number through two keys
    out = [account(i, state="LOCKED" if i % 3 == 0 else "ACTIVE") for i in range(1, n + 1)]
    out[6] = (out[5][0], *out[6][1:])
    return out, [attr(f"cta-{i}", "tipocliente", "N") for i in range(1, n + 1)] + [attr(f"cli-{i}", "rut", f"{i}-K") for i in range(1, n + 1)]


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def params(day):
    return RunParams(day, ("P0", "P1"))


def same(state, led, day):
    assert rows(state.balance_snapshot(led, params(day))) == rows(balance_snapshot(led, params(day)))
    return state


@pytest.mark.parametrize("seed", [1, 2])
def test_days_one_by_one_equal_the_whole_history(spark, tmp_path, seed):
    trxs, attrs = history(seed)
    cta, more = people()
    led = make_ledger(spark, trxs, cta, attrs + more)
    state = SnapshotState.create(led, DAYS[0], str(tmp_path / "s"), buckets=4)
    for day in DAYS[1:]:
        state = same(state.apply(led, day), led, day)
    again = SnapshotState.load(spark, str(tmp_path / "s"))
    assert (again.version, again.upto, again.buckets) == (state.version, state.upto, state.buckets)
    again.prune()
    same(SnapshotState.load(spark, str(tmp_path / "s")), led, DAYS[-1])
    assert again.apply(led, DAYS[-1]) is again      # a day that is there already


def test_only_touched_buckets_are_rewritten(spark, tmp_path):
    cta, more = people()
    rows_, attrs = history(3)
    last = [trx(100, 1, 5, balance=5)]
    led = make_ledger(spark, rows_ + last, cta, attrs + more + [attr("trx-100", "fechcontab", "2024-01-20")])
    state = SnapshotState.create(led, DAYS[-1], str(tmp_path / "s"), buckets=16)
    after = same(state.apply(led, "2024-01-20"), led, "2024-01-20")
    changed = [b for b in state.buckets if state.buckets[b] != after.buckets[b]]
    assert len(changed) == 1


def test_a_transaction_with_another_date_moves_the_cutoffs(spark, tmp_path):
    """The one transaction that carried day 13's cut-off gets day 11: the cut-off of 11
    rises above, that of 13 falls below what the state has seen."""
    trxs, attrs = history(5)
    cta, more = people()
    led = make_ledger(spark, trxs, cta, attrs + more)
    state = SnapshotState.create(led, DAYS[0], str(tmp_path / "s"), buckets=4)
    for day in DAYS[1:4]:
        state = same(state.apply(led, day), led, day)
    top = max(int(a[1][4:]) for a in attrs if a[2] == "fechcontab" and a[3] == DAYS[3])
    moved = [attr(a[1], a[2], DAYS[1]) if (a[1], a[2]) == (f"trx-{top}", "fechcontab") else a for a in attrs]
    led2 = replace(led, cfv=make_ledger(spark, (), (), moved + more).cfv)
    lower = same(state.apply(led2, DAYS[3]), led2, DAYS[3])
    assert lower.upto < state.upto
    state = same(lower.apply(led2, DAYS[1]), led2, DAYS[1])
    same(state.apply(led2, DAYS[4]), led2, DAYS[4])


def test_a_state_at_another_cutoff_is_refused(spark, tmp_path):
    trxs, attrs = history(6)
    cta, more = people()
    led = make_ledger(spark, trxs, cta, attrs + more)
    state = SnapshotState.create(led, DAYS[0], str(tmp_path / "s"), buckets=2)
    with pytest.raises(ValueError, match="apply that day first"):
        state.balance_snapshot(led, params(DAYS[1]))
    with pytest.raises(ValueError, match="no transaction"):
        state.apply(led, "1999-01-01")


def test_balances_by_date_are_those_of_each_snapshot(spark):
    trxs, attrs = history(7)
    trxs.append(trx(999, 99, 1))                    # an account that no number has
    cta, more = people()
    led = make_ledger(spark, trxs, cta, attrs + more + [attr("trx-999", "fechcontab", DAYS[2])])
    with Scope(spark, "test") as scope:
        got = balances_by_date(led, scope).collect()
        for day in DAYS:
            want = {(r.numcta, r.transactionid, r.balance) for r in snapshot_base(led, params(day), retentions=False).collect()}
            assert {(r.numcta, r.transaccion, r.saldo) for r in got if r.fecha == day} == want
    assert len({r.fecha for r in got}) == len(DAYS)


def test_command_line_keeps_the_state(spark, tmp_path):
    from daybook.__main__ import main
    from daybook.sources.ledger_tables import write_ledger_parquet

    trxs, attrs = history(8)
    cta, more = people()
    led = make_ledger(spark, trxs, cta, attrs + more)
    write_ledger_parquet(led, str(tmp_path / "tables"))
    for day in (DAYS[0], DAYS[2], DAYS[3]):
        run = ["--date", day.replace("-", ""), "--products", "'P0', 'P1'", "--tables", str(tmp_path / "tables"), "--single-file", "--index"]
        assert main([*run, "--out", str(tmp_path / "with"), "--state", str(tmp_path / "state")], spark=spark) == 0
        assert main([*run, "--out", str(tmp_path / "without")], spark=spark) == 0
        for part in ("reconciliation", "extract"):
            got, want = ((tmp_path / x / part / "part-00000").read_bytes() for x in ("with", "without"))
            assert got == want and got
    assert SnapshotState.load(spark, str(tmp_path / "state")).version == 3
