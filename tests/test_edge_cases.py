"""Hand-made frames for null logic, duplicates, references, holidays, amounts."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from conftest import account, attr, make_ledger, money, trx
from daybook.functions.codes import reference_number
from daybook.operators import attributes as A
from daybook.operators.anti import not_in
from daybook.operators.holds import hold_retentions
from daybook.operators.ledger import (accounts, latest_per_account, latest_per_account_window,
                                      max_id_any_attribute, retention_buckets)
from daybook.params import RunParams
from daybook.plans import calendar as C
from daybook.plans.movements import next_day_movements_cutoff
from daybook.operators.ledger import sum_per_account
from daybook.plans.reconcile import difference_text
from daybook.plans.snapshot import balance_snapshot, snapshot_case_filter

D = "2024-01-22"
P = RunParams(D, ("P0",))


def _rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_lock_filter_three_valued(spark):
    # LOCKED without code → NULL → dropped; LOCKED '99' dropped; LOCKED '01' kept;
    # ACTIVE without code kept.
    led = make_ledger(spark, cta_rows=[account(1, "LOCKED"), account(2, "LOCKED"),
                                       account(3, "LOCKED"), account(4, "ACTIVE")],
                      cfv_rows=[attr("cta-2", "codblq", "99"), attr("cta-3", "codblq", "01")])
    df = A.lookup_join(accounts(led), "account_key", led.cfv, "codblq", "codblq")
    kept = df.filter(~((F.col("codblq") == "99") & (F.col("accountstate") == "LOCKED")))
    assert _rows(kept, "numcta") == [("00000000000003",), ("00000000000004",)]


def test_case_filter_null_lock_date_takes_else(spark):
    locked_today = dt.datetime(2024, 1, 22, 9)
    led = make_ledger(
        spark,
        cta_rows=[account(1, "LOCKED", locked=locked_today),      # THEN: P0, adjust '0' → kept
                  account(2, "LOCKED", "prd-1", locked=locked_today),  # THEN: product P1 → dropped
                  account(3, "ACTIVE", "prd-1"),                  # ELSE (NULL date), no product test → kept
                  account(4, "LOCKED", locked=dt.datetime(2023, 12, 1, 9))],  # ELSE, no code → dropped
        trx_rows=[trx(1, 1, 10), trx(2, 2, 20), trx(3, 3, 30), trx(4, 4, 40)],
        cfv_rows=[attr(f"trx-{i}", "fechcontab", D) for i in range(1, 5)]
        + [attr(f"trx-{i}", "adjust_state", "0") for i in range(1, 5)])
    got = _rows(snapshot_case_filter(led, P), "numcta2")
    assert got == [("00000000000001",), ("00000000000003",)]


def test_not_in_with_null_empties_result(spark):
    left = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    right_plain = spark.createDataFrame([("a",)], "k string")
    right_null = spark.createDataFrame([("a",), (None,)], "k string")
    right_empty = spark.createDataFrame([], "k string")
    assert _rows(not_in(left, "k", right_plain, "k"), "k") == [("b",)]
    assert not_in(left, "k", right_null, "k").count() == 0
    # an empty list keeps every row, NULL keys included
    assert not_in(left, "k", right_empty, "k").count() == 3
    # same as Spark SQL's own NOT IN
    left.createOrReplaceTempView("l")
    right_null.createOrReplaceTempView("r")
    assert spark.sql("SELECT * FROM l WHERE k NOT IN (SELECT k FROM r)").count() == 0


def test_duplicate_attribute_join_doubles_pivot_takes_max(spark):
    led = make_ledger(spark, cta_rows=[account(1)],
                      cfv_rows=[attr("cta-1", "ofiprod", "001"), ("x2", "cta-1", "ofiprod", "007")])
    joined = A.lookup_join(accounts(led), "account_key", led.cfv, "oficina", "ofiprod")
    assert joined.count() == 2
    piv = A.attach_attributes(accounts(led), "account_key", led.cfv, {"oficina": "ofiprod"})
    assert _rows(piv, "oficina") == [("007",)]


def test_unkeyed_attribute_fanout(spark):
    # 3 attributes, 2 unkeyed lookups → 9 rows; an account without attributes → 1
    led = make_ledger(spark, cta_rows=[account(1), account(2)],
                      cfv_rows=[attr("cta-1", k, "v") for k in ("a", "b", "c")])
    f = A.attribute_fanout(accounts(led), "account_key", led.cfv, lookups=2)
    assert _rows(f, "numcta", "n_rows") == [("00000000000001", 9), ("00000000000002", 1)]
    # equals the join it replaces
    c = led.cfv.select(F.col("parentkey").alias("pk"))
    a = accounts(led)
    pairs = a.join(c.alias("x"), a["account_key"] == F.col("x.pk"), "left") \
             .join(c.alias("y"), a["account_key"] == F.col("y.pk"), "left")
    assert pairs.count() == 10


def test_reference_numbers(spark):
    df = spark.createDataFrame([("12-34",), ("1234",), ("ab-3",), ("",), (None,), ("007-x-y",)], "r string")
    got = [r[0] for r in df.select(reference_number("r")).collect()]
    assert got == [12, None, None, None, None, 7]


def test_retention_types_and_hold_buckets(spark):
    types = ["1", "2", "3", "N", None, "other"]
    trx_rows = [trx(i + 1, 1, 10 * (i + 1)) for i in range(len(types))]
    cfv = [attr(f"trx-{i + 1}", "tiporetencion", t) for i, t in enumerate(types)]
    cfv += [attr(f"trx-{i + 1}", "fechcontab", D) for i in range(len(types))]
    holds = [(f"{i + 1}-1", money(10 * (i + 1)), "PENDING", "ACC1") for i in range(len(types))]
    led = make_ledger(spark, cta_rows=[account(1)], trx_rows=trx_rows, cfv_rows=cfv, ahold_rows=holds)
    r = retention_buckets(led).collect()[0]
    assert (r.retencion_1dia, r.retencion_2dias, r.retencion_ndias) == (money(10), money(50), money(40))
    h = hold_retentions(led, D).collect()[0]
    # N bucket of holds also takes the NULL type
    assert (h.retencion_1dia, h.retencion_2dias, h.retencion_ndias) == (money(10), money(50), money(90))
    assert h.fechacontab == D


def test_holiday_calendar_impossible_and_short_dates(spark):
    hld = spark.createDataFrame([(1, 2, 29, 2020, "leap"), (0, 1, 5, 2024, "one digit"),
                                 (0, 2, 30, 2021, "impossible")],
                                "isannualyrecurring int, monthofyear int, dayofmonth int, year int, name string")
    common = _rows(C.holiday_calendar(hld, 2023), "name", "holidays")
    assert common == [("impossible", None), ("leap", None), ("one digit", "2024-01-05")]
    leap = _rows(C.holiday_calendar(hld, 2024), "name", "holidays")
    assert ("leap", "2024-02-29") in leap


def test_next_business_day_against_brute_force(spark):
    hld_rows = [(1, 1, 1, 2020, "ny"), (0, 1, 23, 2024, "x"), (0, 1, 24, 2024, "y"),
                (1, 12, 25, 2020, "xmas"), (1, 12, 26, 2020, "boxing")]
    hld = spark.createDataFrame(hld_rows, "isannualyrecurring int, monthofyear int, dayofmonth int, "
                                          "year int, name string")
    days = [dt.date(2023, 12, 22) + dt.timedelta(days=i) for i in range(45)]
    dates = spark.createDataFrame([(d,) for d in days], "fecha date")
    got = dict((r.fecha, r.next_business_day) for r in C.next_business_day(dates, hld).collect())

    def is_holiday(d):
        for rec, m, dd, y, _ in hld_rows:
            if (rec == 1 and (d.month, d.day) == (m, dd)) or (rec != 1 and (d.year, d.month, d.day) == (y, m, dd)):
                return True
        return False

    for d in days:
        n = d + dt.timedelta(days=1)
        while n.weekday() >= 5 or is_holiday(n):
            n += dt.timedelta(days=1)
        assert got[d.isoformat()] == n.isoformat(), d


def test_amount_edges_in_difference_text(spark):
    df = spark.createDataFrame([(money(1128513), money(-900)), (money(4697713), money(202)),
                                (money(0), money(0)), (money(-12.5), money(0)), (None, money(1)),
                                (money(9999999999999), money(-9999999))],
                               "saldo decimal(18,2), amount decimal(18,2)")
    got = [r[0] for r in df.select(difference_text("saldo", "amount")).collect()]
    # golden values from the reconciliation output of a past run
    assert got[0] == "00001129413.000"
    assert got[1] == "00004697511.000"
    assert got[2] == "00000000000.000"
    assert got[3] == "00000000-12.500"
    assert got[4] is None
    assert got[5] == "10000009999998.000"  # longer than 15 characters: whole


def test_empty_cutoff_gives_no_rows(spark):
    led = make_ledger(spark, cta_rows=[account(1)], trx_rows=[trx(1, 1, 10)],
                      cfv_rows=[attr("trx-1", "fechcontab", "2024-01-20")])
    assert max_id_any_attribute(led, D).collect()[0][0] is None
    assert balance_snapshot(led, P).count() == 0
    assert next_day_movements_cutoff(led, P).count() == 0


def test_latest_aggregate_equals_window(spark):
    trx_rows = [trx(i, (i % 3) + 1, i) for i in range(1, 30)]
    led = make_ledger(spark, cta_rows=[account(1), account(2), account(3)], trx_rows=trx_rows)
    cut = F.lit(20)
    a = _rows(latest_per_account(led, cut), "numcta", "transactionid")
    w = _rows(latest_per_account_window(led, cut), "numcta", "transactionid")
    assert a == w == [("00000000000001", 18), ("00000000000002", 19), ("00000000000003", 20)]


def test_shared_account_number_keeps_one_latest_row(spark):
    # two account keys with the same number: the SQL groups by the number
    a1 = account(1)
    a2 = ("00000000000001",) + account(2)[1:]
    led = make_ledger(spark, cta_rows=[a1, a2], trx_rows=[trx(1, 1, 5), trx(2, 2, 7), trx(3, 1, 9)])
    got = _rows(latest_per_account(led), "numcta", "transactionid")
    assert got == [("00000000000001", 3)]
    assert Decimal(latest_per_account(led).collect()[0].balance) == money(9)


def test_combined_latest_and_retentions_equal_separate_operators(spark):
    from daybook.operators.ledger import latest_with_retentions
    trx_rows = [trx(i, (i % 3) + 1, i * 10) for i in range(1, 25)]
    # account 3 has no retention-type attribute at all → NULL buckets
    cfv = [attr(f"trx-{i}", "tiporetencion", ["1", "2", "N", None][i % 4])
           for i in range(1, 25) if (i % 3) + 1 != 3]
    led = make_ledger(spark, cta_rows=[account(1), account(2), account(3)], trx_rows=trx_rows, cfv_rows=cfv)
    cut = F.lit(20)
    comb = {r.numcta: (r.transactionid, r.retencion_1dia, r.retencion_2dias, r.retencion_ndias)
            for r in latest_with_retentions(led, cut).collect()}
    lat = {r.numcta: r.transactionid for r in latest_per_account(led, cut).collect()}
    ret = {r.nro_cta: (r.retencion_1dia, r.retencion_2dias, r.retencion_ndias)
           for r in retention_buckets(led, cut).collect()}
    assert set(comb) == set(lat)
    for k, v in comb.items():
        assert v[0] == lat[k]
        assert v[1:] == ret.get(k, (None, None, None))
    assert comb["00000000000003"][1:] == (None, None, None)


def test_bucketed_running_balance_equals_window(spark):
    from pyspark.sql import Window
    from daybook.sources.fixtures import running_balance
    df = spark.range(0, 3000).select(F.col("id").alias("i"), (F.col("id") % 3 == 0).cast("int").alias("a"),
                                     ((F.col("id") * 7) % 11 - 5).cast("decimal(18,2)").alias("x"))
    w = Window.partitionBy("a").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    ref = df.withColumn("r", F.sum("x").over(w))
    got = running_balance(df, "a", "i", "x", bucket=64)
    assert got.count() == 3000
    assert ref.join(got, ["i"]).filter(F.col("r") != F.col("__running")).count() == 0


def test_dated_layout_equals_semi_join_path(spark, tmp_path):
    """Date filters through the dated layout give the semi-join results,
    also when a transaction's accounting-date row is duplicated."""
    from daybook.operators.ledger import day_activity, trx_with
    from daybook.plans.movements import movements_in_id_range, next_day_movements
    from daybook.sources.ledger_tables import with_dated, write_dated_ledger
    N = "2024-01-23"
    trx_rows = [trx(i, (i % 3) + 1, i * 10) for i in range(1, 13)]
    cfv = [attr(f"trx-{i}", "fechcontab", [D, N][i % 2]) for i in range(1, 13)]
    cfv += [("dup", "trx-4", "fechcontab", N)]                     # duplicated date row
    cfv += [attr(f"trx-{i}", "adjust_state", "0") for i in range(1, 13)]
    led = make_ledger(spark, cta_rows=[account(1), account(2), account(3)], trx_rows=trx_rows, cfv_rows=cfv)
    path = str(tmp_path / "dated")
    write_dated_ledger(led, path)
    dated = with_dated(led, spark, path)
    for f in (lambda x: trx_with(x, {"fechcontab": N, "adjust_state": "0"}, F.col("transactionid") <= 9),
              lambda x: day_activity(x, D),
              lambda x: next_day_movements(x, P),
              lambda x: movements_in_id_range(x, P)):
        assert sorted(tuple(r) for r in f(led).collect()) == sorted(tuple(r) for r in f(dated).collect())
    # the duplicated row does not count transaction 4 twice
    assert trx_with(dated, {"fechcontab": N}).filter(F.col("transactionid") == 4).count() == 1


def test_dated_layout_rewrites_only_the_given_dates(spark, tmp_path):
    from daybook.sources.ledger_tables import load_dated, write_dated_ledger
    N = "2024-01-23"
    cfv = [attr(f"trx-{i}", "fechcontab", [D, N][i % 2]) for i in range(1, 7)]
    led = make_ledger(spark, cta_rows=[account(1)], trx_rows=[trx(i, 1, i) for i in range(1, 7)], cfv_rows=cfv)
    path = str(tmp_path / "dated")
    write_dated_ledger(led, path)
    # the next day's run rewrites N only: D keeps its rows, N gets the new ones
    later = make_ledger(spark, cta_rows=[account(1)], trx_rows=[trx(i, 1, i) for i in range(1, 9)],
                        cfv_rows=cfv + [attr("trx-7", "fechcontab", N), attr("trx-8", "fechcontab", D)])
    write_dated_ledger(later, path, dates=[N])
    back = load_dated(spark, path, led.trx.schema)
    got = {(r.accounting_date, r.transactionid) for r in back.collect()}
    assert got == {(D, 2), (D, 4), (D, 6), (N, 1), (N, 3), (N, 5), (N, 7)}


def test_sums_keep_the_scale_of_the_tables(spark):
    """decimal(38,10) amounts: nothing is rounded, and a sum below a cent is not zero."""
    led = make_ledger(spark, cta_rows=[account(1)], trx_rows=[trx(1, 1, 10), trx(2, 1, 20)],
                      cfv_rows=[attr("trx-1", "fechcontab", "2024-01-23"), attr("trx-2", "fechcontab", "2024-01-23")])
    wide = led.trx.withColumn("amount", F.lit("0.0012345678").cast("decimal(38,10)"))
    got = sum_per_account(wide, accounts(led)).first()
    assert str(got.amount) == "0.0024691356"
    assert wide.groupBy().agg(F.sum("amount")).schema[0].dataType.scale == 10


def test_dated_layout_clears_vanished_and_re_dated_rows(spark, tmp_path):
    from daybook.sources.ledger_tables import load_dated, write_dated_ledger
    N = "2024-01-23"
    rows = [trx(i, 1, i) for i in range(1, 5)]
    led = make_ledger(spark, cta_rows=[account(1)], trx_rows=rows,
                      cfv_rows=[attr(f"trx-{i}", "fechcontab", [D, N][i % 2]) for i in range(1, 5)])
    path = str(tmp_path / "dated")
    write_dated_ledger(led, path)
    moved = make_ledger(spark, cta_rows=[account(1)], trx_rows=rows, cfv_rows=[attr(f"trx-{i}", "fechcontab", N) for i in range(1, 5)])
    for dates in ([D, N], None):
        write_dated_ledger(moved, path, dates=dates)
        back = load_dated(spark, path, led.trx.schema).collect()
        assert sorted((r.transactionid, r.accounting_date) for r in back) == [(i, N) for i in range(1, 5)]
