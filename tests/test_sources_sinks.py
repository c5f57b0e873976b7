"""Sources and sinks: product dump CSV, JDBC options, ordered text output."""

from __future__ import annotations

import glob
import os

import pytest
from pyspark.sql import functions as F

from daybook.plans.extract import control_trailer, lines_with_trailer
from daybook.session import new_output_path
from daybook.sinks import write_text
from daybook.sources.jdbc import jdbc_options
from daybook.sources.product_csv import N_FIELDS, PRODUCT_SCHEMA, read_product_dump


def _record(key: str, text: str, null: str = "") -> str:
    f = [null] * N_FIELDS
    f[0] = key
    for pos in (1, 2, 7, 8, 9, 15, 29, 30, 36, 41, 43):
        f[pos] = "True"
    f[3] = f[16] = "2021-05-06 07:08:09"
    f[6] = text
    f[10] = "PRX0001"
    f[23] = "Name 2"
    f[20] = "1234567.0000000000"
    f[22] = "0E-10"
    f[18] = "1.5"
    return ",".join(f)


def test_product_dump_multiline_and_doubled_quotes(spark, tmp_path):
    text = '"<p>one ""two"",\tthree, four</p>\n<p>five</p>"'
    path = tmp_path / "dump.csv"
    path.write_text(_record("a" * 32, text) + "\n" + _record("b" * 32, "plain") + "\n")
    df = read_product_dump(spark, str(path))
    rows = sorted(df.collect(), key=lambda r: r.encodedkey)
    assert len(rows) == 2
    assert rows[0].c06 == '<p>one "two",\tthree, four</p>\n<p>five</p>'
    assert rows[0].c01 is True and rows[0].c04 is None
    assert str(rows[0].c22) in ("0E-10", "0E-10".lower()) or rows[0].c22 == 0
    assert rows[1].c06 == "plain"
    assert df.schema == PRODUCT_SCHEMA


def test_product_dump_none_text_is_null(spark, tmp_path):
    path = tmp_path / "dump_none.csv"
    path.write_text(_record("c" * 32, "x", null="None") + "\n")
    row = read_product_dump(spark, str(path), null_text="None").collect()[0]
    assert row.c04 is None and row.c13 is None and row.c06 == "x"


def test_product_dump_of_one_row_group_is_read_by_many_tasks(spark, tmp_path):
    """A multi-line file is read whole by one task: no written file holds more than
    FILE_RECORDS, from a single task, too; all records come back."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    from __spark_entry__ import queries
    from daybook.sources.fixtures import build_product_dump
    from daybook.sources.product_csv import write_product_dump

    n, most = 50_000, 20_000
    pq.write_table(pa.table({
        "p_partkey": pa.array(range(n), pa.int64()), "p_name": [None if i % 7 == 0 else f"part {i}" for i in range(n)],
        "p_brand": ["Brand#1"] * n, "p_type": [f'"T", {i % 3}' for i in range(n)],
        "p_size": pa.array([i % 50 for i in range(n)], pa.int32()), "p_retailprice": [i / 4 for i in range(n)]}),
        tmp_path / "part.parquet", row_group_size=n)
    records = build_product_dump(spark.read.parquet(str(tmp_path / "part.parquet")))
    path = new_output_path(spark, "one-task-dump")
    write_product_dump(records.coalesce(1), path)
    for got in (queries()["scan_product_csv"](spark, str(tmp_path)), read_product_dump(spark, path)):
        per_file = got.groupBy(F.input_file_name()).count().collect()
        assert sum(r["count"] for r in per_file) == n and max(r["count"] for r in per_file) <= most
        assert got.schema == PRODUCT_SCHEMA and records.exceptAll(got).isEmpty()


def test_jdbc_options_rules():
    o = jdbc_options("jdbc:x://h/db", table="t", partition_column="id", lower_bound=0,
                     upper_bound=100, num_partitions=4)
    assert o["dbtable"] == "t" and o["numPartitions"] == "4" and "query" not in o
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x://h/db", query="select 1", partition_column="id", lower_bound=0,
                     upper_bound=1, num_partitions=2)
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x://h/db")


def test_control_trailer_golden(spark):
    df = spark.range(42)
    assert control_trailer(df, "20230922").collect()[0].line == "099, 20230922, 00000042"


def test_text_sink_orders_lines_and_puts_trailer_last(spark):
    lines = spark.range(0, 500, numPartitions=7).select(
        F.format_string("%05d", "id").alias("numcta"), F.format_string("L%05d", "id").alias("line"))
    out = lines_with_trailer(lines, "20240122")
    path = new_output_path(spark, "test-text")
    write_text(out, path, order_by=["rec_order", "numcta"])
    parts = sorted(glob.glob(os.path.join(path, "part-*")))
    text = "".join(open(p).read() for p in parts).splitlines()
    assert len(text) == 501
    assert text[-1] == "099, 20240122, 00000500"
    assert text[:-1] == [f"L{i:05d}" for i in range(500)]


def test_daily_extract_end_to_end(spark):
    """Source tables written under their own names, loaded with the jobs'
    column lists, run for one date: outputs equal the registered queries."""
    from daybook.plans.daily import daily_extract
    from daybook.plans.reconcile import day_after_reconcile
    from daybook.registry import RUN
    from daybook.sources.fixtures import materialized_fixture_ledger
    from daybook.sources.ledger_tables import load_ledger_parquet, write_ledger_parquet

    base = new_output_path(spark, "test-ledger")
    write_ledger_parquet(materialized_fixture_ledger(spark, "/root/testdata/sf0.001"), base)
    led = load_ledger_parquet(spark, base)
    out = daily_extract(led, "20240122", "'P0', 'P1', 'P2', 'P3'", new_output_path(spark, "test-daily"))
    rec = spark.read.option("header", True).csv(out.reconciliation)
    want = day_after_reconcile(led, RUN)
    assert sorted(rec.select("numcta", "resta").collect()) == \
        sorted(want.select("numcta", "resta").collect())
    parts = sorted(glob.glob(os.path.join(out.extract, "part-*")))
    lines = "".join(open(p).read() for p in parts).splitlines()
    assert lines[-1].startswith("099, 20240122, ")
    assert int(lines[-1].split(", ")[2]) == len(lines) - 1
    assert len({len(x) for x in lines[:-1]}) == 1
    from daybook.plans.snapshot import balance_snapshot
    assert len(lines) - 1 == balance_snapshot(led, RUN).count()


def test_bucketed_catalog_tables_join_without_shuffles(spark):
    """Ledger bucketed by transaction key, attributes by parent key: the
    snapshot equals the parquet run and the key joins need no exchange."""
    import contextlib
    import io

    from daybook.operators.ledger import trx_with
    from daybook.plans.snapshot import balance_snapshot
    from daybook.registry import RUN
    from daybook.sources.fixtures import materialized_fixture_ledger
    from daybook.sources.ledger_tables import load_ledger_catalog, write_ledger_tables

    src = materialized_fixture_ledger(spark, "/root/testdata/sf0.001")
    spark.sql("CREATE DATABASE IF NOT EXISTS bucketed_ledger")
    write_ledger_tables(src, "bucketed_ledger", buckets=8)
    led = load_ledger_catalog(spark, "bucketed_ledger")
    a = sorted(tuple(r) for r in balance_snapshot(led, RUN).collect())
    b = sorted(tuple(r) for r in balance_snapshot(src, RUN).collect())
    assert a == b and len(a) > 0
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            trx_with(led, {"fechcontab": RUN.next_day, "adjust_state": "0"}).explain()
        assert "Exchange hashpartitioning" not in buf.getvalue()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_command_line_runs_the_daily_job(spark, capsys):
    from daybook.__main__ import main
    from daybook.sources.fixtures import materialized_fixture_ledger
    from daybook.sources.ledger_tables import write_ledger_parquet

    base = new_output_path(spark, "cli-ledger")
    write_ledger_parquet(materialized_fixture_ledger(spark, "/root/testdata/sf0.001"), base)
    out = new_output_path(spark, "cli-out")
    assert main(["--date", "20240122", "--products", "'P0', 'P1', 'P2', 'P3'", "--tables", base,
                 "--out", out], spark=spark) == 0
    assert "reconciliation:" in capsys.readouterr().out
    assert spark.read.option("header", True).csv(f"{out}/reconciliation").count() >= 1
    assert spark.read.text(f"{out}/extract").count() >= 1


def test_damaged_product_dump_is_detected_and_split(spark, tmp_path):
    from daybook.sources.product_csv import split_product_dump
    good = _record("a" * 32, "plain")
    extra_comma = _record("b" * 32, "one, two")          # unquoted comma: 47 fields
    cut = '"' + "c" * 32 + '",True'                        # record cut short
    path = tmp_path / "damaged.csv"
    path.write_text("\n".join([good, extra_comma, cut]) + "\n")
    with pytest.raises(Exception):
        read_product_dump(spark, str(path)).collect()
    records, damaged = split_product_dump(spark, str(path))
    assert [r.encodedkey for r in records.collect()] == ["a" * 32]
    assert damaged.count() == 2


def test_command_line_with_the_keys_of_an_environment(spark, tmp_path):
    """Attribute keys that are ids, not names: the run reads them from a file."""
    import hashlib
    import json

    from daybook.__main__ import main, parse_args
    from daybook.params import ATTRIBUTE_NAMES
    from daybook.sources.fixtures import materialized_fixture_ledger
    from daybook.sources.ledger_tables import load_ledger_parquet, write_ledger_parquet

    keys = {n: hashlib.md5(n.encode()).hexdigest() for n in ATTRIBUTE_NAMES}
    plain = materialized_fixture_ledger(spark, "/root/testdata/sf0.001")
    base, out, named = (new_output_path(spark, f"cli-{x}") for x in ("hex", "hex-out", "named-out"))
    write_ledger_parquet(plain, base)
    hexed = plain.cfv.replace(keys, subset=["customfieldkey"])
    hexed.write.parquet(f"{base}/hexed")
    spark.read.parquet(f"{base}/hexed").write.mode("overwrite").parquet(f"{base}/customfieldvalue")
    file = tmp_path / "keys.json"
    file.write_text(json.dumps(keys))
    run = ["--date", "20240122", "--products", "'P0', 'P1', 'P2', 'P3'", "--tables", base]
    assert main([*run, "--out", out, "--keys", str(file)], spark=spark) == 0
    assert load_ledger_parquet(spark, base).cfv.filter("customfieldkey = 'rut'").isEmpty()
    from daybook.plans.daily import daily_extract
    daily_extract(plain, "20240122", "'P0', 'P1', 'P2', 'P3'", named)
    for part in ("reconciliation", "extract"):
        rows = [sorted(r.value for r in spark.read.text(f"{x}/{part}").collect()) for x in (out, named)]
        assert rows[0] == rows[1] and rows[0]
    with pytest.raises(SystemExit):
        parse_args([*run[:4], "--jdbc-url", "jdbc:x", "--out", out, "--jdbc-partitions", "8"])
