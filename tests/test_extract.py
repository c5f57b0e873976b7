"""Fixed-width record: constant length, quirk switch, padding rules."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from daybook.plans.extract import (LAYOUT, attribute_dump, control_trailer, fixed_width_lines, padded_columns,
                                   record_columns)

SRC = ("numcta string, oficina string, estado string, producto string, fechacierre timestamp_ntz, "
       "rut string, fechaaperut string, saldo decimal(18,2), saldo_bloqueado decimal(18,2)")


def _frame(spark):
    rows = [
        ("00000000000001", "001", "ACTIVE", "P0", None, "10000001-1", "2020-01-02", Decimal("1234.50"), None),
        ("00000000000002", None, "LOCKED", "P1", None, None, None, Decimal("-12.50"), Decimal("-3.00")),
        ("00000000000003", "002", "CLOSED", "P2", dt.datetime(2023, 11, 30, 18), "1-9", "bad date",
         Decimal("0.00"), Decimal("99999999999999.99")),
        ("00000000000004", "003", "OTHER", "P3", None, "12345678901", "2020-1-2", None, Decimal("1.00")),
    ]
    return spark.createDataFrame(rows, SRC)


def test_lines_have_constant_length(spark):
    lines = [r.line for r in fixed_width_lines(_frame(spark), "2024-01-22").collect()]
    assert all(line is not None for line in lines)
    assert len({len(line) for line in lines}) == 1


def test_fields_and_fixes(spark):
    cols = {r["numcta"]: r for r in record_columns(_frame(spark), "2024-01-22").collect()}
    a, b, c, d = (cols[f"0000000000000{i}"] for i in range(1, 5))
    assert a.fec_cont == "20240122" and a.state == "A".ljust(10) and c.state == "C".ljust(10)
    assert d.state == " " * 10
    assert b.of_cta == " " * 10 and b.cc == " " * 10 and a.cc == "001".ljust(10)
    assert b.sig == "-" and b.amount == "12.50".rjust(20, "0")        # absolute after the sign
    assert c.sig == "-" and d.amount == "0" * 20                      # zero gives '-', NULL zeros
    assert a.resp_rut == "010000001-1".ljust(25)
    assert d.resp_rut == "12345678901".ljust(25)
    assert a.fec_ini == "20200102" and c.fec_ini == " " * 8          # unparseable date → blank
    assert c.lst_accr_dt == "20231130"
    assert b.balAvl == "-3.00".rjust(20, "0")                         # no sign field: sign kept
    assert a.prod == "CBC P0".ljust(16)
    assert a.pool_rt_cod == "    0" and a.nat_con_no == "  12"


def test_strict_reproduces_original_quirks(spark):
    cols = {r["numcta"]: r for r in record_columns(_frame(spark), "2024-01-22", strict=True).collect()}
    a, b = cols["00000000000001"], cols["00000000000002"]
    assert a.open_dt is None and b.open_dt == " " * 8
    assert b.cc is None
    assert b.amount == "-12.50".rjust(20, "0")
    assert a.fec_cont == "20240101"
    lines = {r.numcta: r.line for r in fixed_width_lines(_frame(spark), "2024-01-22", strict=True).collect()}
    assert lines["00000000000001"] is None


def test_a_value_beyond_its_field_stops_the_run(spark):
    wide = _frame(spark).withColumn("rut", F.lit("123456789012"))
    with pytest.raises(Exception, match="does not fit its field of 11"):
        fixed_width_lines(wide, "2024-01-22").collect()


def test_a_trailer_count_beyond_eight_digits_stays_whole(spark):
    line = control_trailer(spark.range(100_000_001), "20240122").first().line
    assert line == "099, 20240122, 100000001"


def test_padded_and_dumped_values_stay_whole(spark):
    df = spark.createDataFrame([("1" * 16, 7, Decimal("123456789012345.67"))], "numcta string, transactionid long, amount decimal(18,2)")
    assert tuple(padded_columns(df).first()) == ("1" * 16, "7".rjust(14, "0"), "123456789012345.67")
    long = spark.createDataFrame([("v" * 40, "k", "e", None)], "value string, customfieldkey string, encodedkey string, parentkey string")
    assert attribute_dump(long).first().line == "+".join(["v" * 40, "k".rjust(35, "0"), "e".rjust(35, "0")])


def test_layout_has_121_fields():
    assert len(LAYOUT) == 121
    assert len({n for n, _ in LAYOUT}) == 121
