"""Physical-plan properties the design relies on at scale."""

from __future__ import annotations

import contextlib
import io

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from daybook.operators.anti import not_in
from daybook.operators.ledger import accounts, latest_per_account
from daybook.sources.fixtures import materialized_fixture_ledger

SF = "/root/testdata/sf0.001"


def plan(df, mode: str = "formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


@pytest.fixture(scope="module")
def led(spark):
    return materialized_fixture_ledger(spark, SF)


def test_latest_rows_read_the_ledger_once_without_shuffling_it(spark, led):
    # partial max_by per account key before the exchange; no join back on id
    p = plan(latest_per_account(led, F.lit(500), accounts(led, how="left")))
    assert "partial_max_by(" in p
    assert p.count("/trx]") == 1                               # one ledger scan
    assert "keys [1]: [transactionid" not in p                 # no join back on id


def test_not_in_is_not_a_forced_null_aware_broadcast(spark, led):
    acc = accounts(led, how="left")
    p = plan(not_in(acc, "numcta", acc.select("numcta"), "numcta"), "simple")
    assert "LeftAnti" in p
    assert "LeftAnti, BuildRight, true" not in p      # Spark's null-aware form
    assert "BroadcastNestedLoopJoin" not in p
    # Spark's own NOT IN is the null-aware broadcast join this replaces
    acc.createOrReplaceTempView("__acc")
    sql = spark.sql("SELECT * FROM __acc WHERE numcta NOT IN (SELECT numcta FROM __acc)")
    assert "LeftAnti, BuildRight, true" in plan(sql, "simple")


def test_cutoff_and_key_filters_reach_the_scans(spark):
    p = plan(entry.queries()["balance_snapshot"](spark, SF))
    assert "LessThanOrEqual(transactionid,ScalarSubquery" in p
    assert "PartitionFilters: [isnotnull(customfieldkey" in p or "PartitionFilters: [customfieldkey" in p


def test_attribute_scan_reads_only_needed_columns(spark):
    p = plan(entry.queries()["attributes_pivot"](spark, SF))
    assert "ReadSchema: struct<parentkey:string,value:string>" in p


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_no_cartesian_or_nested_loop_joins(spark, name):
    p = plan(entry.queries()[name](spark, SF))
    assert "CartesianProduct" not in p
    assert "BroadcastNestedLoopJoin" not in p


def test_date_filters_read_one_partition_of_the_dated_layout(spark, led):
    from daybook.operators.ledger import trx_on_accounting_date
    from daybook.session import new_output_path
    from daybook.sources.ledger_tables import with_dated, write_dated_ledger
    path = new_output_path(spark, "test-dated")
    write_dated_ledger(led, path)
    dated = with_dated(led, spark, path)
    p = plan(trx_on_accounting_date(dated, "2024-01-22"))
    assert "PartitionFilters: [isnotnull(accounting_date" in p
    assert "/trx]" not in p                                    # the history is not scanned


def test_hot_account_join_is_split_by_aqe(spark):
    """Ledger ⋈ accounts with one account holding 90 % of the rows: AQE's
    skew handling splits that account's partition (thresholds lowered to
    the test's size)."""
    from conftest import account, make_ledger
    from daybook.plans.extract import padded_columns
    confs = {"spark.sql.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
             "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
             "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in confs}
    try:
        for k, v in confs.items():
            spark.conf.set(k, v)
        hot = F.when(F.col("id") % 10 == 0, F.col("id") % 97).otherwise(F.lit(1))
        trx = spark.range(0, 60000).select(
            F.col("id").alias("transactionid"), F.concat(F.lit("cta-"), hot.cast("string")).alias("parentaccountkey"),
            F.lit(1).cast("decimal(18,2)").alias("amount"))
        led = make_ledger(spark, cta_rows=[account(i) for i in range(97)])
        acc = led.cta.select(F.col("id").alias("numcta"), F.col("encodedkey").alias("__ak"))
        df = padded_columns(trx.join(acc, F.col("parentaccountkey") == F.col("__ak"), "inner"))
        assert len(df.collect()) == 60000
        assert "SortMergeJoin(skew=true)" in plan(df, "simple")
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def scans(monkeypatch, spark, name: str, *tables: str) -> list[int]:
    """How often a registered query scans the tables: in its result's plan and in the
    plans of all frames that it saves on the way."""
    from daybook.session import Scope
    plans, save = [], Scope.save
    monkeypatch.setattr(Scope, "save", lambda self, df, *a: plans.append(plan(df)) or save(self, df, *a))
    plans.append(plan(entry.queries()[name](spark, SF)))
    return [sum(p.count(f"/{t}]") for p in plans) for t in tables]


@pytest.mark.parametrize("name,most", [("movements_in_id_range", 2), ("next_day_movements_cutoff", 2), ("movements_nonzero", 2),
                                       ("anti_null_aware", 1), ("hold_retentions", 1), ("next_day_movements", 2)])
def test_frames_used_twice_are_computed_once(spark, led, monkeypatch, name, most):
    assert scans(monkeypatch, spark, name, "trx")[0] <= most


def test_next_business_day_reads_each_table_once(spark, led, monkeypatch):
    assert scans(monkeypatch, spark, "next_business_day", "hld", "customfieldkey=fechcontab", "cfv") in ([1, 0, 1], [1, 1, 0])


def test_balances_of_all_dates_read_the_ledger_twice(spark, led, monkeypatch):
    assert scans(monkeypatch, spark, "balances_by_date", "trx") == [2]     # for the cut-offs, and for the balances


def test_reconciliation_reduces_the_ledger_before_it_is_aggregated(spark, led):
    p = plan(entry.queries()["day_after_reconcile"](spark, SF), "simple")
    lines = p.split("\n")
    depth = {i: len(x) - len(x.lstrip(" :+-|")) for i, x in enumerate(lines)}
    semi = [i for i, x in enumerate(lines) if "LeftSemi" in x and "parentaccountkey" in x and "only_key" in x]
    first = [i for i, x in enumerate(lines) if "partial_max_by(" in x and "parentaccountkey" in x]
    assert semi and first
    assert any(f < s and depth[f] < depth[s] for f in first for s in semi)      # the semi join stands below


def test_scopes_leave_nothing_behind(spark, led, tmp_path):
    import os

    from daybook.plans.daily import daily_extract
    from daybook.session import Scope, shared_dir
    shared = shared_dir(spark)
    before = set(os.listdir(shared.removeprefix("file:")))
    out = daily_extract(led, "20240122", "'P0', 'P1'", str(tmp_path / "out"), index=True)
    with Scope(spark, "one") as scope:
        kept = scope.save(spark.range(5), "five")
        assert kept.count() == 5 and os.path.isdir(scope.path.removeprefix("file:"))
    assert set(os.listdir(shared.removeprefix("file:"))) == before
    assert out.written.lines == spark.read.text(out.extract).count() - 1
