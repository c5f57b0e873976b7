"""Core ledger operators against plain-Python brute force on random ledgers.

One account is hot (most transactions), attributes may be missing or NULL,
accounts have mixed products and states.
"""

from __future__ import annotations

from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import account, attr, make_ledger, money, trx
from daybook.operators.ledger import accounts, latest_with_retentions
from daybook.params import RunParams
from daybook.plans.movements import next_day_movements_cutoff

D, N, PREV = "2024-01-22", "2024-01-23", "2024-01-21"
P = RunParams(D, ("P0",))
ACCTS = {1: ("ACTIVE", "prd-0"), 2: ("LOCKED", "prd-0"), 3: ("CLOSED", "prd-0"), 4: ("ACTIVE", "prd-1")}
ABSENT = "absent"

tx = st.tuples(
    st.sampled_from([1, 1, 1, 1, 2, 3, 4]),                     # account 1 is hot
    st.integers(-50, 80),                                       # amount
    st.sampled_from([PREV, D, N, ABSENT]),                      # accounting date
    st.sampled_from(["1", "2", "3", "N", None, "x", ABSENT]))   # retention type

SETTINGS = settings(max_examples=10, deadline=None, derandomize=True,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


def _ledger(spark, txs):
    cta = [account(a, state, prod) for a, (state, prod) in ACCTS.items()]
    trx_rows, cfv = [], []
    for i, (a, amt, fc, tipo) in enumerate(txs, start=1):
        trx_rows.append(trx(i, a, amt))
        if fc != ABSENT:
            cfv.append(attr(f"trx-{i}", "fechcontab", fc))
        if tipo != ABSENT:
            cfv.append(attr(f"trx-{i}", "tiporetencion", tipo))
    return make_ledger(spark, trx_rows=trx_rows, cta_rows=cta, cfv_rows=cfv)


@SETTINGS
@given(txs=st.lists(tx, max_size=25), cut=st.integers(0, 26))
def test_latest_with_retentions_brute_force(spark, txs, cut):
    from pyspark.sql import functions as F
    led = _ledger(spark, txs)
    got = {r.numcta: (r.transactionid, r.retencion_1dia, r.retencion_2dias, r.retencion_ndias)
           for r in latest_with_retentions(led, F.lit(cut), accounts(led, how="left")).collect()}
    want = {}
    for a in ACCTS:
        ids = [i for i, t in enumerate(txs, start=1) if t[0] == a and i <= cut]
        if not ids:
            continue
        typed = [(i, txs[i - 1][3]) for i in ids if txs[i - 1][3] != ABSENT]
        if typed:
            def s(vals):
                return money(sum(Decimal(txs[i - 1][1]) for i, v in typed if v in vals))
            buckets = (s({"1"}), s({"2", "3"}), s({"N"}))
        else:
            buckets = (None, None, None)
        want[f"{a:014d}"] = (max(ids),) + buckets
    assert got == want


@SETTINGS
@given(txs=st.lists(tx, max_size=25))
def test_next_day_movements_cutoff_brute_force(spark, txs):
    led = _ledger(spark, txs)
    got = {r.numcta: (r.amount, r.producto) for r in next_day_movements_cutoff(led, P).collect()}
    in_p = {a for a, (_, prod) in ACCTS.items() if prod == "prd-0"}
    open_p = {a for a in in_p if ACCTS[a][0] in ("ACTIVE", "LOCKED")}
    d_ids = [i for i, t in enumerate(txs, start=1) if t[2] == D and t[0] in in_p]
    cut = max(d_ids) if d_ids else None
    moved = {t[0] for t in txs if t[2] == D and t[0] in open_p}
    want = {}
    for a in open_p - moved:
        amts = [Decimal(t[1]) for i, t in enumerate(txs, start=1)
                if t[0] == a and t[2] == N and cut is not None and i <= cut]
        if amts:
            want[f"{a:014d}"] = (money(sum(amts)), "P0")
    assert got == want


hold = st.tuples(
    st.integers(1, 8),                                          # referenced transaction
    st.sampled_from(["{}-1", "{}", "x{}-1", "{}-2-3"]),         # reference shape
    st.integers(0, 90),                                         # amount
    st.sampled_from(["PENDING", "PENDING", "SETTLED"]),
    st.sampled_from(["C1", "C1", "C2"]))                        # card, C1 hot


@SETTINGS
@given(txs=st.lists(tx, min_size=1, max_size=8), holds=st.lists(hold, max_size=12))
def test_hold_retentions_brute_force(spark, txs, holds):
    from daybook.operators.holds import hold_retentions
    led = _ledger(spark, txs)
    rows = [(shape.format(t), money(a), state, card) for t, shape, a, state, card in holds]
    led.ahold = spark.createDataFrame(rows, "externalreferenceid string, amount decimal(18,2), "
                                            "state string, cardreferencetoken string")
    got = {r.nro_cta: (r.retencion_1dia, r.retencion_2dias, r.retencion_ndias, r.fechacontab)
           for r in hold_retentions(led, D).collect()}
    want = {}
    for t, shape, a, state, card in holds:
        ref = shape.format(t)
        head = ref.split("-")[0] if "-" in ref else ""
        if state != "PENDING" or not head.isdigit() or not 1 <= int(head) <= len(txs):
            continue
        _, _, fc, tipo = txs[int(head) - 1]
        if fc == ABSENT or tipo == ABSENT or fc > D:          # both attributes mandatory; date <= D
            continue
        r1, r2, rn, last = want.get(card, (Decimal(0), Decimal(0), Decimal(0), None))
        amt = Decimal(a)
        r1 += amt if tipo == "1" else 0
        r2 += amt if tipo in ("2", "3") else 0
        rn += amt if tipo in ("N", None) else 0
        want[card] = (r1, r2, rn, fc if last is None or fc > last else last)
    want = {k: (money(a), money(b), money(c), d) for k, (a, b, c, d) in want.items()}
    assert got == want


tx_adj = st.tuples(st.sampled_from([1, 1, 1, 2, 3, 4]), st.integers(-50, 80),
                   st.sampled_from([PREV, D, N, ABSENT]), st.sampled_from(["0", "0", "1", None, ABSENT]))


@SETTINGS
@given(txs=st.lists(tx_adj, max_size=25))
def test_next_day_movements_brute_force(spark, txs):
    from daybook.plans.movements import next_day_movements
    cta = [account(a, state, prod) for a, (state, prod) in ACCTS.items()]
    trx_rows, cfv = [], []
    for i, (a, amt, fc, adj) in enumerate(txs, start=1):
        trx_rows.append(trx(i, a, amt))
        if fc != ABSENT:
            cfv.append(attr(f"trx-{i}", "fechcontab", fc))
        if adj != ABSENT:
            cfv.append(attr(f"trx-{i}", "adjust_state", adj))
    led = make_ledger(spark, trx_rows=trx_rows, cta_rows=cta, cfv_rows=cfv)
    got = {r.numcta: (r.amount, r.producto) for r in next_day_movements(led, P).collect()}
    in_p = {a for a, (_, prod) in ACCTS.items() if prod == "prd-0"}       # any state
    moved = {t[0] for t in txs if t[2] == D and t[0] in in_p}
    want = {}
    for a in in_p - moved:
        amts = [Decimal(t[1]) for t in txs if t[0] == a and t[2] == N and t[3] == "0"]
        if amts:
            want[f"{a:014d}"] = (money(sum(amts)), "P0")
    assert got == want


acct = st.tuples(st.sampled_from(["ACTIVE", "LOCKED", "CLOSED"]), st.sampled_from(["prd-0", "prd-1"]),
                 st.sampled_from(["today", "before", None]), st.sampled_from(["99", "01", ABSENT]),
                 st.sampled_from(["0", "1", ABSENT]), st.integers(1, 3))


@SETTINGS
@given(accts=st.lists(acct, min_size=1, max_size=6))
def test_snapshot_case_filter_brute_force(spark, accts):
    import datetime as dt
    from daybook.plans.snapshot import snapshot_case_filter
    lock = {"today": dt.datetime(2024, 1, 22, 9), "before": dt.datetime(2023, 12, 1, 9), None: None}
    cta, trx_rows, cfv, want = [], [], [], set()
    i = 0
    for n, (state, prod, locked, blq, adj, k) in enumerate(accts, start=1):
        cta.append(account(n, state, prod, locked=lock[locked]))
        if blq != ABSENT:
            cfv.append(attr(f"cta-{n}", "codblq", blq))
        for _ in range(k):
            i += 1
            trx_rows.append(trx(i, n, 10))
            cfv.append(attr(f"trx-{i}", "fechcontab", D))
        if adj != ABSENT:
            cfv.append(attr(f"trx-{i}", "adjust_state", adj))       # on the latest transaction
        opn = state in ("ACTIVE", "LOCKED")
        if locked == "today":
            ok = prod == "prd-0" and opn and adj == "0"
        else:
            # NOT (codblq = '99' AND LOCKED) under three-valued logic
            if blq == ABSENT:
                inner = False if state != "LOCKED" else None
            else:
                inner = blq == "99" and state == "LOCKED"
            ok = opn and inner is not None and not inner
        if ok:
            want.add((f"{n:014d}", i))
    led = make_ledger(spark, trx_rows=trx_rows, cta_rows=cta, cfv_rows=cfv)
    got = {(r.numcta2, r.id_trx) for r in snapshot_case_filter(led, P).collect()}
    assert got == want


@SETTINGS
@given(accts=st.lists(acct, min_size=1, max_size=6), dates=st.lists(st.sampled_from([PREV, D, N]), max_size=18))
def test_max_id_unblocked_brute_force(spark, accts, dates):
    from daybook.operators.ledger import max_id_unblocked
    cta, trx_rows, cfv, best = [], [], [], None
    for n, (state, prod, _, blq, _, _) in enumerate(accts, start=1):
        cta.append(account(n, state, prod))
        if blq != ABSENT:
            cfv.append(attr(f"cta-{n}", "codblq", blq))
    for i, fc in enumerate(dates, start=1):
        n = (i % len(accts)) + 1
        trx_rows.append(trx(i, n, 1))
        cfv.append(attr(f"trx-{i}", "fechcontab", fc))
        state, prod, _, blq, _, _ = accts[n - 1]
        # product P0, block code present (inner lookup), NOT (99 AND LOCKED)
        if fc == D and prod == "prd-0" and blq != ABSENT and not (blq == "99" and state == "LOCKED"):
            best = i if best is None else max(best, i)
    led = make_ledger(spark, trx_rows=trx_rows, cta_rows=cta, cfv_rows=cfv)
    assert max_id_unblocked(led, D, P.products).collect()[0][0] == best


@SETTINGS
@given(rows=st.lists(st.tuples(st.integers(1, 6), st.integers(-20, 50)), max_size=20))
def test_ledger_chains_brute_force(spark, rows):
    """Accounts 1–4 exist (4 with a missing product, 3 without a client);
    transactions of accounts 5–6 have no account."""
    from daybook.plans.chains import ledger_chain
    accts = {1: ("ACTIVE", "prd-0"), 2: ("LOCKED", "prd-1"), 3: ("ACTIVE", "prd-0"), 4: ("CLOSED", "prd-9")}
    cta = [account(a, s, p) for a, (s, p) in accts.items()]
    cli = [(f"cli-{a}",) for a in (1, 2, 4)]
    led = make_ledger(spark, cta_rows=cta, cli_rows=cli,
                      trx_rows=[trx(i, a, amt) for i, (a, amt) in enumerate(rows, start=1)])
    prods = {"prd-0": "P0", "prd-1": "P1"}

    def expect(inner):
        out = {}
        for a, amt in rows:
            if a in accts:
                state, pk = accts[a]
                prod = prods.get(pk)
                if inner and (prod is None or a == 3):
                    continue
            elif inner:
                continue
            else:
                state, prod = None, None
            n, s = out.get((prod, state), (0, Decimal(0)))
            out[(prod, state)] = (n + 1, s + Decimal(amt))
        return {k: (n, Decimal(s).quantize(Decimal("0.01"))) for k, (n, s) in out.items()}

    for inner in (True, False):
        got = {(r.producto, r.estado): (r.n_trx, r.total_amount) for r in ledger_chain(led, inner).collect()}
        assert got == expect(inner)


@SETTINGS
@given(rows=st.lists(st.tuples(st.integers(-20, 50), st.sampled_from(["web", "atm", "zzz", ABSENT])), max_size=20))
def test_trx_channel_brute_force(spark, rows):
    """Details rows may be missing, or name a channel that does not exist:
    both land in the NULL channel, as the SQL's left joins put them."""
    from daybook.plans.chains import trx_channel
    led = make_ledger(spark, cta_rows=[account(1)],
                      trx_rows=[trx(i, 1, amt) for i, (amt, _) in enumerate(rows, start=1)])
    led.trxdet = spark.createDataFrame([(f"det-{i}", f"ch-{ch}") for i, (_, ch) in enumerate(rows, start=1)
                                        if ch != ABSENT], "encodedkey string, transactionchannelkey string")
    led.trxch = spark.createDataFrame([("WEB", "ch-web"), ("ATM", "ch-atm")], "id string, encodedkey string")
    names = {"web": "WEB", "atm": "ATM"}
    want = {}
    for amt, ch in rows:
        k = names.get(ch)
        n, s = want.get(k, (0, Decimal(0)))
        want[k] = (n + 1, s + Decimal(amt))
    want = {k: (n, s.quantize(Decimal("0.01"))) for k, (n, s) in want.items()}
    got = {r.channel: (r.n_trx, r.total_amount) for r in trx_channel(led).collect()}
    assert got == want


@SETTINGS
@given(txs=st.lists(tx_adj, max_size=25))
def test_movements_in_id_range_brute_force(spark, txs):
    from daybook.plans.movements import movements_in_id_range
    cta = [account(a, state, prod) for a, (state, prod) in ACCTS.items()]
    trx_rows, cfv = [], []
    for i, (a, amt, fc, adj) in enumerate(txs, start=1):
        trx_rows.append(trx(i, a, amt))
        if fc != ABSENT:
            cfv.append(attr(f"trx-{i}", "fechcontab", fc))
        if adj != ABSENT:
            cfv.append(attr(f"trx-{i}", "adjust_state", adj))
    led = make_ledger(spark, trx_rows=trx_rows, cta_rows=cta, cfv_rows=cfv)
    got = {r.numcta: (r.amount, r.producto) for r in movements_in_id_range(led, P).collect()}
    d_ids = [i for i, t in enumerate(txs, start=1) if t[2] == D]          # bounds over all accounts
    want = {}
    if d_ids:
        lo, hi = min(d_ids), max(d_ids)
        in_p = {a for a, (_, prod) in ACCTS.items() if prod == "prd-0"}
        moved = {t[0] for i, t in enumerate(txs, start=1) if t[2] == D and t[0] in in_p and lo <= i <= hi}
        for a in in_p - moved:
            amts = [Decimal(t[1]) for i, t in enumerate(txs, start=1)
                    if t[0] == a and t[2] == N and t[3] == "0" and lo <= i <= hi]
            if amts:
                want[f"{a:014d}"] = (money(sum(amts)), "P0")
    assert got == want
