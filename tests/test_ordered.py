"""Row numbers, carried values, joined part files, rejects: against plain Python."""

from __future__ import annotations

import os
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from daybook.operators.ordered import carry, row_numbers
from daybook.plans.extract import checked_lines, rejected_fields, write_extract
from daybook.session import Scope
from daybook.sinks import join_parts, part_files, write_csv, write_text


@pytest.fixture
def scope(spark):
    with Scope(spark, "test") as s:
        yield s


@pytest.mark.parametrize("n,ranges", [(0, 4), (1, 4), (200, 1), (200, 7)])
def test_row_numbers_have_no_gaps(spark, scope, n, ranges):
    rng = random.Random(n)
    ids = rng.sample(range(10 * n + 1), n)
    df = spark.createDataFrame([(i, f"t{i}") for i in ids], "id int, __id string").repartition(5)
    got = row_numbers(df, ["id"], scope, "row", start=3, ranges=ranges).collect() if n != 1 else \
        row_numbers(df, [F.col("id").desc()], scope, "row", start=3, ranges=ranges).collect()
    assert sorted((r.id, r.row) for r in got) == [(x, k + 3) for k, x in enumerate(sorted(ids))]


def test_row_numbers_are_not_made_in_one_task(spark, scope):
    df = row_numbers(spark.range(1000), ["id"], scope)
    text = df._jdf.queryExecution().executedPlan().toString()
    assert text.count("Window") == 1 and "count" in text.lower()    # the one over the ranges' counts


@pytest.mark.parametrize("backwards", [False, True])
@pytest.mark.parametrize("known", [0.0, 0.02, 0.5, 1.0])
def test_carry_is_that_of_plain_python(spark, scope, backwards, known):
    rng = random.Random(int(known * 100) + backwards)
    rows = [(i, rng.randrange(100) if rng.random() < known else None) for i in range(150)]
    got = carry(spark.createDataFrame(rows, "id int, v int").repartition(3), ["id"], "v", "c", scope, backwards, ranges=6).collect()
    want, last = {}, None
    for i, v in reversed(rows) if backwards else rows:
        last = v if v is not None else last
        want[i] = last
    assert {r.id: r.c for r in got} == want and len(got) == 150
    assert {r.id: r.v for r in got} == dict(rows)


def test_one_file_is_the_part_files_in_order(spark, tmp_path):
    df = spark.range(500).select(F.format_string("%05d ü", "id").alias("line"))
    write_text(df.repartitionByRange(5, "line").sortWithinPartitions("line"), str(tmp_path / "parts"))
    parts = part_files(spark, str(tmp_path / "parts"))
    assert len(parts) > 1
    whole = b"".join(open(p.removeprefix("file:"), "rb").read() for p, _ in parts)
    join_parts(spark, str(tmp_path / "parts"), str(tmp_path / "one"), b"head\n", b"end")
    assert (tmp_path / "one").read_bytes() == b"head\n" + whole + b"end"
    write_text(df, str(tmp_path / "single"), order_by=["line"], single_file=True)
    assert [f for f in os.listdir(tmp_path / "single") if not f.startswith(".")] == ["part-00000"]
    assert (tmp_path / "single" / "part-00000").read_bytes() == whole


def test_csv_index_is_unnamed_and_in_order(spark, tmp_path):
    rows = [(f"a{i:03d}", 1000 - i, 'say "x", y' if i % 3 else None) for i in range(60)]
    df = spark.createDataFrame(rows, "numcta string, n int, t string").repartition(4)
    write_csv(df, str(tmp_path / "one"), order_by=["numcta"], index=True, single_file=True)
    import csv
    import io
    got = list(csv.reader(io.StringIO((tmp_path / "one" / "part-00000").read_text())))
    assert got[0] == ["", "numcta", "n", "t"]
    assert got[1:] == [[str(i), a, str(n), t or ""] for i, (a, n, t) in enumerate(rows)]
    write_csv(df, str(tmp_path / "many"), order_by=["numcta"], index=True)
    back = spark.read.schema("i int, numcta string, n int, t string").option("header", True).option("escape", '"').csv(str(tmp_path / "many"))
    assert sorted(map(tuple, back.collect())) == [(i, *r) for i, r in enumerate(rows)]
    with pytest.raises(ValueError):
        write_csv(df, str(tmp_path / "x"), index=True)


SNAP = ("numcta string, oficina string, estado string, producto string, fechacierre date, rut string, fechaaperut string, "
        "saldo decimal(18,2), saldo_bloqueado decimal(18,2)")


@pytest.mark.parametrize("single", [False, True])
def test_rejects_do_not_stop_the_run(spark, tmp_path, single):
    rows = [(f"{i:014d}", "001", "ACTIVE", "P0", None, f"{i}-1" if i % 10 else "123456789012", "2020-01-02", Decimal(i), None) for i in range(1, 41)]
    rows.append(("9" * 31, "0" * 11, "ACTIVE", "P0", None, "1-9", None, None, None))
    df = spark.createDataFrame(rows, SNAP).repartition(4)
    checked = checked_lines(df, "2024-01-22")
    out, rej = str(tmp_path / "extract"), str(tmp_path / "rejects")
    got = write_extract(checked, out, rej, "20240122", single)
    assert (got.lines, got.rejected) == (36, 5)
    names = sorted(f for f in os.listdir(out) if not f.startswith((".", "_")))
    lines = "".join(open(f"{out}/{f}").read() for f in names).splitlines()
    good = [r[0] for r in rows if len(r[5]) < 12 and len(r[0]) == 14]
    assert lines[-1] == "099, 20240122, 00000036" and len({len(x) for x in lines[:-1]}) == 1
    assert [next(a for a in good if f"{a} " in x) for x in lines[:-1]] == sorted(good)
    bad = spark.read.json(rej).collect()
    assert sorted(r.numcta for r in bad) == sorted({r[0] for r in rows} - set(good))
    assert {(r.numcta, r.field, r.length, r.width) for r in rejected_fields(checked).collect()} == {
        *((f"{i:014d}", "resp_rut", 12, 11) for i in (10, 20, 30, 40)), ("9" * 31, "nro_cta", 31, 30), ("9" * 31, "of_cta", 11, 10), ("9" * 31, "cc", 11, 10)}
    assert not [f for f in os.listdir(out) if f.startswith("kind=")]


@pytest.mark.parametrize("single", [False, True])
def test_an_extract_without_lines_has_a_trailer(spark, tmp_path, single):
    checked = checked_lines(spark.createDataFrame([], SNAP), "2024-01-22")
    got = write_extract(checked, str(tmp_path / "e"), str(tmp_path / "r"), "20240122", single)
    assert (got.lines, got.rejected) == (0, 0)
    assert [r.value for r in spark.read.text(str(tmp_path / "e")).collect()] == ["099, 20240122, 00000000"]
