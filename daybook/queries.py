"""Query registrations: one entry per operator / composite query.

Each function takes the ledger (fixture views over the test tables) and the
run parameters and returns a DataFrame whose column names match the oracle.
"""

from __future__ import annotations

import datetime
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook import sinks as SK
from daybook.functions.codes import state_code
from daybook.functions.dates import date_prefix, yyyymmdd
from daybook.operators import attributes as A
from daybook.operators import ledger as L
from daybook.operators.anti import not_in
from daybook.operators.holds import hold_retentions as _hold_retentions
from daybook.operators.holds import holds_to_transactions
from daybook.params import Ledger, RunParams, parse_product_list
from daybook.plans import calendar as C
from daybook.plans import chains as CH
from daybook.plans import extract as X
from daybook.plans import history as H
from daybook.plans import movements as M
from daybook.plans import reconcile as R
from daybook.plans import snapshot as S
from daybook.plans.state import SnapshotState
from daybook.registry import RUN, query, raw_query
from daybook.session import Scope, program_scope
from daybook.sources.ledger_tables import TABLES
from daybook.sources import product_csv as PC
from daybook.sources import product_repair as PR
from daybook.sources.fixtures import build_product_dump, materialized_fixture_ledger
from daybook.sources.parquet import read_table, rename_ids


# ------------------------------------------------------------------ cut-offs

@query("trx_id_bounds")
def trx_id_bounds(led: Ledger, p: RunParams) -> DataFrame:
    """MIN and MAX id with accounting date D in one aggregate."""
    return L.id_bounds_on_date(led, p.run_date)


@query("max_trx_id_by_product")
def max_trx_id_by_product(led: Ledger, p: RunParams) -> DataFrame:
    return L.max_id_by_product(led, p.run_date, p.products)


@query("max_trx_id_unblocked")
def max_trx_id_unblocked(led: Ledger, p: RunParams) -> DataFrame:
    return L.max_id_unblocked(led, p.run_date, p.products)


@query("cutoff_any_attribute")
def cutoff_any_attribute(led: Ledger, p: RunParams) -> DataFrame:
    return L.max_id_any_attribute(led, p.run_date)


@query("cutoff_accounting_date")
def cutoff_accounting_date(led: Ledger, p: RunParams) -> DataFrame:
    return L.max_id_accounting_date(led, p.run_date)


# ------------------------------------------------------------------ latest per account

def _latest_cols(df: DataFrame) -> DataFrame:
    return df.select("numcta", F.col("transactionid").alias("transaccion"),
                     F.col("balance").alias("saldo"))


@query("latest_trx_per_account")
def latest_trx_per_account(led: Ledger, p: RunParams) -> DataFrame:
    """Last transaction under the any-attribute cut-off, two-level max_by."""
    cut = L.max_id_any_attribute(led, p.run_date).select("cutoff_id").scalar()
    return _latest_cols(L.latest_per_account(led, cut, L.accounts(led, how="left")))


@query("latest_trx_window")
def latest_trx_window(led: Ledger, p: RunParams) -> DataFrame:
    """Same as latest_trx_per_account through row_number windows."""
    cut = L.max_id_any_attribute(led, p.run_date).select("cutoff_id").scalar()
    return _latest_cols(L.latest_per_account_window(led, cut, L.accounts(led, how="left")))


@query("retention_buckets")
def retention_buckets(led: Ledger, p: RunParams) -> DataFrame:
    cut = L.max_id_any_attribute(led, p.run_date).select("cutoff_id").scalar()
    return L.retention_buckets(led, cut, L.accounts(led, how="left"))


# ------------------------------------------------------------------ snapshots

query("balance_snapshot")(S.balance_snapshot)
query("snapshot_case_filter")(S.snapshot_case_filter)
query("snapshot_preview")(S.snapshot_preview)
query("client_account_pairs")(S.client_account_pairs)


@query("balance_snapshot_every_row")
def balance_snapshot_every_row(led: Ledger, p: RunParams) -> DataFrame:
    """The balance snapshot with a row for each repeated attribute row."""
    return S.balance_snapshot(led, p, every_row=True)


@query("snapshot_by_days")
def snapshot_by_days(led: Ledger, p: RunParams, scope: Scope) -> DataFrame:
    """The balance snapshot from a state made two days before D and then kept up to
    date, one day's ledger rows at a time."""
    d = datetime.date.fromisoformat(p.run_date)
    before = [(d - datetime.timedelta(days=n)).isoformat() for n in (2, 1)]
    state = SnapshotState.create(led, before[0], scope.new_path("state"), buckets=16)
    for day in (before[1], p.run_date):
        state = state.apply(led, day)
    return state.balance_snapshot(led, p)


@query("balances_by_date")
def balances_by_date(led: Ledger, p: RunParams, scope: Scope) -> DataFrame:
    return H.balances_by_date(led, scope)


# ------------------------------------------------------------------ movements

query("next_day_movements")(M.next_day_movements)
query("next_day_movements_cutoff")(M.next_day_movements_cutoff)
query("movements_nonzero")(M.movements_nonzero)
query("movements_loose_group")(M.movements_loose_group)
query("movements_in_id_range")(M.movements_in_id_range)


@query("accounts_moved_on_date")
def accounts_moved_on_date(led: Ledger, p: RunParams) -> DataFrame:
    return L.moved_accounts(led, p.run_date, p.products).distinct()


# ------------------------------------------------------------------ reconciliation (flagship)

query("day_after_reconcile")(R.day_after_reconcile)


# ------------------------------------------------------------------ attributes


_ACCOUNT_ATTRS = [("tipocliente", "tipocliente"), ("numctabech", "numctabech"),
                  ("fechaaperut", "fechaperut"), ("oficina", "ofiprod"), ("rut_tutor", "ruttutor"),
                  ("codblq", "codblq"), ("causalcierre", "causalcierre")]


def _plain_accounts(led: Ledger) -> DataFrame:
    return led.cta.select(F.col("id").alias("numcta"), F.col("encodedkey").alias("account_key"),
                          "accountholderkey")


@query("attributes_left_join")
def attributes_left_join(led: Ledger, p: RunParams) -> DataFrame:
    """Seven account attributes and the client's rut, one optional lookup
    join each (the SQL's form)."""
    df = A.lookup_join(_plain_accounts(led), "accountholderkey", led.cfv, "rut", led.keys.rut)
    for name, key in _ACCOUNT_ATTRS:
        df = A.lookup_join(df, "account_key", led.cfv, name, led.keys[key])
    return df.drop("account_key", "accountholderkey")


@query("attributes_pivot")
def attributes_pivot(led: Ledger, p: RunParams) -> DataFrame:
    """The same columns through one aggregation per entity level."""
    df = A.attach_attributes(_plain_accounts(led), "account_key", led.cfv,
                             {name: led.keys[key] for name, key in _ACCOUNT_ATTRS})
    df = A.attach_attributes(df, "accountholderkey", led.cfv, {"rut": led.keys.rut})
    return df.drop("account_key", "accountholderkey")


@query("attributes_inner_join")
def attributes_inner_join(led: Ledger, p: RunParams) -> DataFrame:
    """Mandatory lookups: accounts having rut, tipocliente, numctabech,
    fechaperut, ofiprod and ruttutor."""
    names = {name: led.keys[key] for name, key in _ACCOUNT_ATTRS[:5]}
    df = A.attach_attributes(_plain_accounts(led), "account_key", led.cfv, names, required=list(names))
    df = A.attach_attributes(df, "accountholderkey", led.cfv, {"rut": led.keys.rut}, required=["rut"])
    return df.drop("account_key", "accountholderkey")


@query("attribute_fanout_count")
def attribute_fanout_count(led: Ledger, p: RunParams) -> DataFrame:
    """Rows two unkeyed attribute joins would give per account number."""
    f = A.attribute_fanout(_plain_accounts(led), "account_key", led.cfv, lookups=2)
    return f.groupBy("numcta").agg(F.sum("n_rows").cast("bigint").alias("n_rows"))


# ------------------------------------------------------------------ join chains and channels

@query("ledger_inner_chain")
def ledger_inner_chain(led: Ledger, p: RunParams) -> DataFrame:
    return CH.ledger_chain(led, inner=True)


@query("ledger_left_chain")
def ledger_left_chain(led: Ledger, p: RunParams) -> DataFrame:
    return CH.ledger_chain(led, inner=False)


query("trx_channel")(lambda led, p: CH.trx_channel(led))


# ------------------------------------------------------------------ holds

@query("hold_to_trx_join")
def hold_to_trx_join(led: Ledger, p: RunParams) -> DataFrame:
    return holds_to_transactions(led).select(
        "externalreferenceid", "transactionid", "amount", "state", "cardreferencetoken")


@query("hold_retentions")
def hold_retentions(led: Ledger, p: RunParams, scope: Scope) -> DataFrame:
    return _hold_retentions(led, p.run_date, scope)


# ------------------------------------------------------------------ account filters

@query("accounts_by_state_product")
def accounts_by_state_product(led: Ledger, p: RunParams) -> DataFrame:
    return L.accounts(led, p.products, p.states).select(
        "numcta", "producto", F.col("accountstate").alias("estado"))


@query("product_list_filter")
def product_list_filter(led: Ledger, p: RunParams) -> DataFrame:
    """Products given as the quoted, comma-separated setting text."""
    setting = ", ".join(f"'{x}'" for x in p.products)
    return L.accounts(led, parse_product_list(setting)).select("numcta", "producto")


@query("lock_filter")
def lock_filter(led: Ledger, p: RunParams) -> DataFrame:
    """``NOT (codblq = '99' AND accountstate = 'LOCKED')`` with the block
    code looked up optionally: a LOCKED account without code is dropped."""
    df = A.lookup_join(L.accounts(led, how="left"), "account_key", led.cfv, "codblq", led.keys.codblq)
    df = df.filter(~((F.col("codblq") == "99") & (F.col("accountstate") == "LOCKED")))
    return df.select("numcta", F.col("accountstate").alias("estado"), "codblq")


@query("locked_on_date")
def locked_on_date(led: Ledger, p: RunParams) -> DataFrame:
    acc = L.accounts(led, how="left")
    return acc.filter(date_prefix("lockeddate") == F.lit(p.run_date)).select("numcta", "lockeddate")


@query("state_code_map")
def state_code_map(led: Ledger, p: RunParams) -> DataFrame:
    acc = L.accounts(led, how="left")
    return acc.select("numcta", F.col("accountstate").alias("estado"),
                      state_code("accountstate").alias("state_code"))


@query("anti_null_aware")
def anti_null_aware(led: Ledger, p: RunParams, scope: Scope) -> DataFrame:
    """Accounts NOT IN the accounts moved on D, twice: against their plain
    numbers (no NULL) and against the numbers seen through the optional tutor
    lookup (NULL where a moved account has no tutor, which empties NOT IN)."""
    acc = L.accounts(led, how="left")
    keys = L.day_activity(led, p.run_date).select("parentaccountkey")
    moved = scope.save(acc.join(keys, acc["account_key"] == F.col("parentaccountkey"), "left_semi").select("numcta", "account_key"), "moved")
    tutor = A.lookup_join(moved, "account_key", led.cfv, "__tutor", led.keys.ruttutor)
    nullable = tutor.select(F.when(F.col("__tutor").isNotNull(), F.col("numcta")).alias("numcta"))
    a = not_in(acc, "numcta", moved.select("numcta"), "numcta").agg(F.count(F.lit(1)).alias("n_not_in"))
    b = not_in(acc, "numcta", nullable, "numcta").agg(F.count(F.lit(1)).alias("n"))
    return a.select("n_not_in", b.select("n").scalar().alias("n_not_in_nullable"))


# ------------------------------------------------------------------ account extracts

query("account_general_data")(S.account_general_data)
query("balances_on_date")(S.balances_on_date)


# ------------------------------------------------------------------ calendar

def _accounting_dates(led: Ledger) -> DataFrame:
    return (led.cfv.filter(F.col("customfieldkey") == led.keys.fechcontab)
            .select(F.try_to_date("value").alias("fecha")).distinct())


@query("holiday_calendar")
def holiday_calendar(led: Ledger, p: RunParams) -> DataFrame:
    return C.holiday_calendar(led.hld, int(p.run_date[:4]))


@query("date_params")
def date_params(led: Ledger, p: RunParams) -> DataFrame:
    """Run parameters for every accounting date of the ledger, each given as
    the job's ``yyyymmdd`` argument."""
    return C.date_params(_accounting_dates(led).select(yyyymmdd("fecha").alias("run_date")))


@query("next_business_day")
def next_business_day(led: Ledger, p: RunParams, scope: Scope) -> DataFrame:
    """The next business day after every accounting date of the ledger."""
    return C.next_business_day(_accounting_dates(led), led.hld, scope=scope)


# ------------------------------------------------------------------ output records

def _trx_accounts(led: Ledger) -> DataFrame:
    acc = led.cta.select(F.col("id").alias("numcta"), F.col("encodedkey").alias("__ak"))
    return led.trx.join(acc, F.col("parentaccountkey") == F.col("__ak"), "inner")


@query("lpad_columns")
def lpad_columns(led: Ledger, p: RunParams) -> DataFrame:
    return X.padded_columns(_trx_accounts(led))


@query("delimited_lines")
def delimited_lines(led: Ledger, p: RunParams) -> DataFrame:
    return X.delimited_lines(X.padded_columns(_trx_accounts(led)), ";")


@query("attribute_dump")
def attribute_dump(led: Ledger, p: RunParams) -> DataFrame:
    return X.attribute_dump(led.cfv)


@query("fixed_width_extract")
def fixed_width_extract(led: Ledger, p: RunParams) -> DataFrame:
    """The lines of the records that fit the layout (``extract_rejects`` has the others)."""
    return X.good_lines(S.balance_snapshot(led, p, retentions=False), p.run_date)


@query("control_trailer")
def control_trailer(led: Ledger, p: RunParams) -> DataFrame:
    return X.control_trailer(S.balance_snapshot(led, p, retentions=False), p.yyyymmdd)


@query("extract_with_trailer")
def extract_with_trailer(led: Ledger, p: RunParams, scope: Scope) -> DataFrame:
    lines = X.good_lines(S.balance_snapshot(led, p, retentions=False), p.run_date)
    return X.lines_with_trailer(lines, p.yyyymmdd, scope.new_path("extract-lines"))


@query("extract_rejects")
def extract_rejects(led: Ledger, p: RunParams, scope: Scope) -> DataFrame:
    """What one pass writes when some records do not fit: accounts with a tutor name
    both ruts, too long for the field.  Good lines with the trailer that counts them,
    and the rejected fields, read back from the two outputs."""
    snap = S.balance_snapshot(led, p, retentions=False).withColumn("rut", F.concat_ws("/", "rut", "rut_tutor"))
    good, bad = scope.new_path("extract"), scope.new_path("rejects")
    X.write_extract(X.checked_lines(snap, p.run_date), good, bad, p.yyyymmdd)
    spark, text = led.trx.sparkSession, F.lit(None).cast("string")
    lines = spark.read.text(good).select(F.lit("line").alias("kind"), text.alias("numcta"), text.alias("field"),
                                         F.lit(None).cast("int").alias("length"), F.lit(None).cast("int").alias("width"), F.col("value").alias("line"))
    fields = spark.read.schema("numcta string, fields array<struct<field:string,length:int,width:int>>").json(bad)
    return lines.union(fields.select("numcta", F.explode("fields").alias("f")).select(
        F.lit("reject"), "numcta", "f.field", "f.length", "f.width", text))


@query("scan_pruned")
def scan_pruned(led: Ledger, p: RunParams) -> DataFrame:
    """Six transaction columns, the id renamed as the jobs do before joins."""
    return rename_ids(_columns(led, "trx"), "trxid", "transactionid")


def _columns(led: Ledger, field: str) -> DataFrame:
    return getattr(led, field).select(*TABLES[field][1])


def _register_scans() -> None:
    """``scan_<source table>``: the columns that the jobs read of each other table."""
    for field, (table, _) in TABLES.items():
        if field != "trx":
            def scan(led: Ledger, p: RunParams, field=field) -> DataFrame:
                return _columns(led, field)

            scan.__doc__ = f"The columns that the jobs read of {table}."
            query(f"scan_{table}")(scan)


_register_scans()

# ------------------------------------------------------------------ sources and sinks (write, read back)


@raw_query("scan_product_csv")
def scan_product_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product records (from ``part``) written in the dump's CSV format to
    the shared folder and read back with the declared 46-field schema and
    multi-line quoting."""
    part = read_table(spark, sf_dir, "part",
                      ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"])
    path = program_scope(spark).new_path("product-dump")
    # part rows are narrow and may be one row group: dealt out before they become records
    PC.write_product_dump(build_product_dump(part.hint("rebalance")), path)
    return PC.read_product_dump(spark, path)


@raw_query("product_dump_repaired")
def product_dump_repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product records (from ``part``) in a dump damaged in three ways, repaired: records
    with their 46 typed fields; of rejects, the key only."""
    scope = program_scope(spark)
    part = read_table(spark, sf_dir, "part", ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"])
    records = build_product_dump(part)
    plain = F.regexp_replace(F.regexp_replace("c06", '"|</?div>', ""), "\n", " ")
    records = records.withColumn("c06", F.when(F.regexp_extract("id", r"(\d+)", 1).cast("long") % 4 == 2, plain).otherwise(F.col("c06")))
    path = scope.new_path("damaged-dump")
    SK.write_text(PR.damaged_lines(records), path)
    good, bad = PR.repair_product_dump(spark, path, scope)
    return good.unionByName(bad.select(F.substring("record", 1, 32).alias("encodedkey")), allowMissingColumns=True)


def _reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.day_after_reconcile(materialized_fixture_ledger(spark, sf_dir), RUN, program_scope(spark))


@raw_query("sink_csv_roundtrip")
def sink_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reconciliation rows written as CSV with header and an unnamed first column of
    row numbers in account order, read back (that column as ``index``)."""
    df = _reconcile(spark, sf_dir)
    path = program_scope(spark).new_path("reconcile-csv")
    SK.write_csv(df, path, order_by=["numcta"], index=True)
    schema = "index long, " + ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return spark.read.schema(schema).option("header", True).option("enforceSchema", True).csv(path)


@raw_query("sink_delimited_roundtrip")
def sink_delimited_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reconciliation rows written with header and ';' separator, read back."""
    df = _reconcile(spark, sf_dir)
    path = program_scope(spark).new_path("reconcile-semicolon")
    SK.write_csv(df, path, sep=";")
    return spark.read.schema(df.schema).option("header", True).option("delimiter", ";").csv(path)


@raw_query("sink_text_roundtrip")
def sink_text_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extract lines and trailer written as ordered text part files (a global
    sort on the account, no single-file funnel), read back as lines."""
    led = materialized_fixture_ledger(spark, sf_dir)
    lines = X.checked_lines(S.balance_snapshot(led, RUN, retentions=False), RUN.run_date)
    scope = program_scope(spark)
    path = scope.new_path("extract-text")
    X.write_extract(lines, path, scope.new_path("rejects"), RUN.yyyymmdd)
    return spark.read.text(path).withColumnRenamed("value", "line")


@raw_query("sink_text_single_file")
def sink_text_single_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The attribute dump written as ordered part files and joined to one file by byte
    offsets, read back as lines."""
    path = program_scope(spark).new_path("dump-text")
    dump = X.attribute_dump(materialized_fixture_ledger(spark, sf_dir).cfv)
    SK.write_text(dump, path, order_by=["line"], single_file=True)
    return spark.read.text(path).withColumnRenamed("value", "line")


@query("holiday_calendar_sql")
def holiday_calendar_sql(led: Ledger, p: RunParams) -> DataFrame:
    """holiday_calendar through temp views and parameterised Spark SQL."""
    spark, prefix = led.hld.sparkSession, f"ledger_{uuid.uuid4().hex}_"
    views = led.register_views(prefix)
    out = C.holiday_calendar_sql(spark, int(p.run_date[:4]), prefix + "holiday")
    for view in views:      # the result no longer needs the names
        spark.catalog.dropTempView(view)
    return out


@query("dated_ledger")
def dated_ledger(led: Ledger, p: RunParams) -> DataFrame:
    """The rows of the dated ledger layout (ledger ⋈ distinct accounting
    dates), built here from the plain tables by ``build_dated``."""
    from daybook.sources.ledger_tables import build_dated
    return build_dated(led)
