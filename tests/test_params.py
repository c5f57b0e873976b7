"""Run parameters, settings parsing, cluster sizing, date-text functions."""

from __future__ import annotations

from daybook.functions.dates import first_of_month, iso_from_yyyymmdd, next_calendar_day
from daybook.params import AttributeKeys, RunParams, parse_product_list
from daybook.session import cluster_conf


def test_run_params_from_job_argument():
    p = RunParams.from_yyyymmdd("20240229", "'P0', 'P1'")
    assert p.run_date == "2024-02-29" and p.next_day == "2024-03-01"
    assert p.first_of_month == "2024-02-01" and p.yyyymmdd == "20240229"
    assert p.products == ("P0", "P1") and p.states == ("ACTIVE", "LOCKED")
    assert RunParams.from_yyyymmdd("20231231", ["X"]).next_day == "2024-01-01"


def test_product_list_setting():
    assert parse_product_list("'CC1', 'CC2',  \"CC3\" ,") == ("CC1", "CC2", "CC3")
    assert parse_product_list("CC1") == ("CC1",)
    assert parse_product_list("") == ()


def test_attribute_keys_defaults_and_overrides():
    k = AttributeKeys({"rut": "k-rut"})
    assert k.rut == "k-rut" and k["fechcontab"] == "fechcontab"
    assert len(k.keys) == 12


def test_cluster_conf_sizes_from_input():
    c = cluster_conf(100 * 1024 ** 4, total_cores=4000)
    assert int(c["spark.sql.shuffle.partitions"]) == 100 * 1024 ** 4 // (256 * 1024 ** 2)
    assert c["spark.sql.adaptive.skewJoin.enabled"] == "true"
    small = cluster_conf(1024, total_cores=16)
    assert int(small["spark.sql.shuffle.partitions"]) == 32


def test_run_date_text_functions(spark):
    df = spark.createDataFrame([("20240122",), ("20230229",), ("2024-01-22",), (None,)], "d string")
    rows = df.select(iso_from_yyyymmdd("d").alias("iso")).collect()
    assert [r.iso for r in rows] == ["2024-01-22", None, None, None]
    iso = spark.createDataFrame([("2024-01-31",), ("2024-02-29",), ("bad",)], "d string")
    got = iso.select(next_calendar_day("d").alias("n"), first_of_month("d").alias("f")).collect()
    assert [(r.n, r.f) for r in got] == [("2024-02-01", "2024-01-01"), ("2024-03-01", "2024-02-01"),
                                         (None, None)]


def test_shared_dir_reads_the_session_setting(spark):
    from daybook.session import new_output_path, shared_dir
    configured = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark) == configured
    a, b = new_output_path(spark, "x"), new_output_path(spark, "x")
    assert a != b and a.startswith(configured.replace("file:", "")) and b.startswith(configured.replace("file:", ""))
