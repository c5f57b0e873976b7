"""Fixture views: the banking tables built from the driver's test tables.

The test tables carry no banking schema, so the nine source tables of the
ledger jobs are derived from ``events``, ``customer``, ``region`` and
``orders`` (mapping in FIXTURES.md).  This module only produces rows in the
schema the jobs expect; every job in ``daybook.operators`` / ``daybook.plans``
works on any data of that schema and takes nothing from how these rows are
made.

The same mapping is written in SQL for the DuckDB oracle
(``daybook.oracle.FIXTURE_CTES``); both must produce identical rows.
"""

from __future__ import annotations

import threading
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from daybook.params import AttributeKeys, Ledger
from daybook.sources.parquet import read_table

MONEY = "decimal(18,2)"

# Fixed values of the fixture: the run date D the lock dates refer to.
FIXTURE_RUN_DATE = "2024-01-22"


def _s(c) -> F.Column:
    return F.col(c).cast("string") if isinstance(c, str) else c.cast("string")


def _money(c) -> F.Column:
    return F.col(c).cast(MONEY)


def _ts(text: str) -> F.Column:
    return F.to_timestamp_ntz(F.lit(text))


# Ids per bucket of the running-balance prefix sums.
BALANCE_BUCKET = 4096


def running_balance(df: DataFrame, account: str, order: str, amount: str,
                    bucket: int = BALANCE_BUCKET) -> DataFrame:
    """Running sum of ``amount`` per ``account`` in ``order`` (a unique,
    increasing id), as two-level prefix sums.

    A window over a whole account would put an account holding a third of
    all rows into one task.  Instead: running sums inside (account, id
    bucket) groups of at most ``bucket`` ids, plus the total of the earlier
    buckets of the account, from a per-bucket aggregate that is ``bucket``
    times smaller than the ledger.
    """
    b = F.floor(F.col(order) / bucket)
    d = df.withColumn("__b", b)
    w_in = (Window.partitionBy(account, "__b").orderBy(order)
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    d = d.withColumn("__in", F.sum(amount).over(w_in))
    totals = d.groupBy(account, "__b").agg(F.sum(amount).alias("__t"))
    w_b = (Window.partitionBy(account).orderBy("__b")
           .rowsBetween(Window.unboundedPreceding, -1))
    offs = totals.select(account, "__b", F.coalesce(F.sum("__t").over(w_b), F.lit(0)).alias("__off"))
    return (d.join(offs, [account, "__b"], "inner")
            .withColumn("__running", F.col("__in") + F.col("__off"))
            .drop("__b", "__in", "__off"))


def _accounting_date() -> F.Column:
    """Purchases and sign-ups are accounted on the day after."""
    return F.when(F.col("event_type").isin("purchase", "signup"), F.date_add(F.to_date("ts"), 1)).otherwise(F.to_date("ts"))


def build_trx(events: DataFrame) -> DataFrame:
    """One transaction per event.  Every 7th user's movements of the day after the run
    date are zero, every 97th transaction has an account that does not exist, every
    37th has no details."""
    idle = (F.col("user_id") % 7 == 3) & (_accounting_date() == F.date_add(F.lit(FIXTURE_RUN_DATE).cast("date"), 1))
    amount = F.when(idle, F.lit(0).cast(MONEY)).when(F.col("event_type") == "error", -_money("value")).otherwise(_money("value"))
    ev = running_balance(events.select("event_id", "user_id", amount.alias("amount")),
                         "user_id", "event_id", "amount")
    return ev.select(
        F.col("event_id").alias("transactionid"),
        F.concat(F.lit("trx-"), _s("event_id")).alias("encodedkey"),
        F.concat(F.when(F.col("event_id") % 97 == 0, "gone-").otherwise("cta-"), _s("user_id")).alias("parentaccountkey"),
        F.col("__running").cast(MONEY).alias("balance"),
        F.col("amount"),
        F.when(F.col("event_id") % 37 != 0, F.concat(F.lit("det-"), _s("event_id"))).alias("details_encodedkey_oid"))


def build_cta(customer: DataFrame, run_date: str = FIXTURE_RUN_DATE) -> DataFrame:
    seg = F.col("c_mktsegment")
    locked = seg == "BUILDING"
    closed = seg == "MACHINERY"
    state = F.when(locked, "LOCKED").when(closed, "CLOSED").otherwise("ACTIVE")
    lockdate = F.when(locked, F.when(F.col("c_custkey") % 3 == 0, _ts(f"{run_date} 09:00:00"))
                      .otherwise(_ts("2023-12-01 09:00:00")))
    return customer.select(
        F.lpad(_s("c_custkey"), 14, "0").alias("id"),
        state.alias("accountstate"),
        F.concat(F.lit("cta-"), _s("c_custkey")).alias("encodedkey"),
        F.concat(F.lit("prd-"), F.when(F.col("c_custkey") % 13 == 5, "gone").otherwise(_s(F.col("c_custkey") % 5))).alias("producttypekey"),
        F.when(locked, _money("c_acctbal")).alias("blockedbalance"),
        lockdate.alias("lockeddate"),
        F.when(closed, _ts("2023-11-30 18:00:00")).alias("closeddate"),
        F.concat(F.lit("cli-"), _s("c_custkey")).alias("accountholderkey"),
        _ts("2020-01-02 08:00:00").alias("activationdate"),
        _money("c_acctbal").alias("holdbalance"))


def build_prod(region: DataFrame) -> DataFrame:
    return region.select(
        F.concat(F.lit("P"), _s("r_regionkey")).alias("id"),
        F.col("r_name").alias("name"),
        F.concat(F.lit("prd-"), _s("r_regionkey")).alias("encodedkey"))


def build_cli(customer: DataFrame) -> DataFrame:
    return customer.select(F.concat(F.lit("cli-"), _s("c_custkey")).alias("encodedkey"))


def build_trxdet(events: DataFrame) -> DataFrame:
    return events.select(
        F.concat(F.lit("det-"), _s("event_id")).alias("encodedkey"),
        F.when(F.col("event_id") % 31 != 0, F.concat(F.lit("ch-"), F.col("event_type"))).alias("transactionchannelkey"))


def build_trxch(events: DataFrame) -> DataFrame:
    return events.select(
        F.upper("event_type").alias("id"),
        F.concat(F.lit("ch-"), F.col("event_type")).alias("encodedkey")).distinct()


def build_ahold(events: DataFrame) -> DataFrame:
    ref = F.when(F.col("event_id") % 9 == 0, _s("event_id")).otherwise(
        F.concat(_s("event_id"), F.lit("-1")))
    return events.select(
        ref.alias("externalreferenceid"),
        _money("value").alias("amount"),
        F.when(F.col("event_id") % 3 == 0, "SETTLED").otherwise("PENDING").alias("state"),
        F.lpad(_s("user_id"), 14, "0").alias("cardreferencetoken"))


def build_hld(orders: DataFrame) -> DataFrame:
    """One holiday row per order, so the calendar grows with the data.

    ``o_orderkey % 8`` picks the kind of row: recurring new year, Christmas,
    29 February and 1 May; a one-off on 23 January 2024; a one-off on the
    impossible 30 February 2021; a recurring 18 September; and a one-off on the
    order date itself (1995–2001).
    """
    k = F.col("o_orderkey") % 8
    od = F.col("o_orderdate")

    def pick(values, last):
        expr = None
        for i, v in enumerate(values):
            expr = F.when(k == i, F.lit(v)) if expr is None else expr.when(k == i, F.lit(v))
        return expr.otherwise(last)

    # Fixed values of the fixture: (recurring, month, day, year, name) per kind 0..6.
    kinds = [
        (1, 1, 1, 2020, "new year"),
        (1, 12, 25, 2020, "xmas"),
        (1, 2, 29, 2020, "leap"),
        (1, 5, 1, 2020, "labour"),
        (0, 1, 23, 2024, "one-off"),
        (0, 2, 30, 2021, "impossible"),
        (1, 9, 18, 2020, "national"),
    ]
    return orders.select(
        pick([x[0] for x in kinds], F.lit(0)).cast("int").alias("isannualyrecurring"),
        pick([x[1] for x in kinds], F.month(od)).cast("int").alias("monthofyear"),
        pick([x[2] for x in kinds], F.dayofmonth(od)).cast("int").alias("dayofmonth"),
        pick([x[3] for x in kinds], F.year(od)).cast("int").alias("year"),
        pick([x[4] for x in kinds], F.col("o_orderpriority")).alias("name"))


def build_cfv(events: DataFrame, customer: DataFrame, keys: AttributeKeys) -> DataFrame:
    """The attribute table: one row per (entity, attribute)."""
    ev = F.col("event_type")
    post_next = ev.isin("purchase", "signup")
    tdate = F.to_date("ts")
    trx_key = F.concat(F.lit("trx-"), _s("event_id"))
    cli_key = F.concat(F.lit("cli-"), _s("c_custkey"))
    cta_key = F.concat(F.lit("cta-"), _s("c_custkey"))
    ck = F.col("c_custkey")
    ret = (F.when(F.col("event_id") % 6 == 1, "1").when(F.col("event_id") % 6 == 2, "2")
           .when(F.col("event_id") % 6 == 3, "3").when(F.col("event_id") % 6 == 4, "N"))

    def rows(df, parent, name, value, cond=None):
        if cond is not None:
            df = df.filter(cond)
        return df.select(parent.alias("parentkey"), F.lit(keys[name]).alias("customfieldkey"),
                         _s(value).alias("value"))

    parts = [
        rows(events, trx_key, "fechcontab", _accounting_date()),
        rows(events, trx_key, "adjust_state",
             F.when(F.col("event_id") % 10 == 0, "1").otherwise("0")),
        rows(events, trx_key, "fechamov", tdate, post_next),
        rows(events, trx_key, "tiporetencion", ret, F.col("event_id") % 6 != 0),
        rows(customer, cli_key, "rut",
             F.concat(_s(ck + 10000000), F.lit("-"), _s(ck % 10))),
        rows(customer, cta_key, "tipocliente",
             F.when(F.col("c_nationkey") % 2 == 0, "N").otherwise("J")),
        rows(customer, cta_key, "numctabech", F.lpad(_s(ck * 7), 11, "0")),
        rows(customer, cta_key, "fechaperut", F.lit("2020-01-02")),
        rows(customer, cta_key, "ofiprod", F.lpad(_s("c_nationkey"), 3, "0"), ck % 7 != 0),
        # a second office: repeated (parent, key) pairs
        rows(customer, cta_key, "ofiprod", F.lit("001"), ck % 17 == 3),
        rows(customer, cta_key, "ruttutor", _s(ck + 20000000), ck % 11 == 0),
        rows(customer, cta_key, "codblq", F.when(ck % 2 == 0, "99").otherwise("01"),
             (F.col("c_mktsegment") == "BUILDING") & (ck % 4 != 3)),
        rows(customer, cta_key, "causalcierre", F.lit("C1"), F.col("c_mktsegment") == "MACHINERY"),
    ]
    cfv = reduce(DataFrame.unionAll, parts)
    return cfv.select(
        F.concat(F.lit("cfv-"), F.col("customfieldkey"), F.lit("-"), F.col("parentkey")).alias("encodedkey"),
        "parentkey", "customfieldkey", "value")


def load_fixture_ledger(spark: SparkSession, sf_dir: str,
                        keys: AttributeKeys | None = None) -> Ledger:
    keys = keys or AttributeKeys()
    events = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "value"])
    customer = read_table(spark, sf_dir, "customer",
                          ["c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment"])
    region = read_table(spark, sf_dir, "region", ["r_regionkey", "r_name"])
    orders = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_orderdate", "o_orderpriority"])
    return Ledger(
        trx=build_trx(events), cta=build_cta(customer), prod=build_prod(region),
        cli=build_cli(customer), cfv=build_cfv(events, customer, keys),
        trxdet=build_trxdet(events), trxch=build_trxch(events),
        hld=build_hld(orders), ahold=build_ahold(events), keys=keys)


def build_product_dump(part: DataFrame) -> DataFrame:
    """Product-dump records (46 fields) from ``part``: one per part, with a
    description holding a comma, doubled quotes, markup and a line break."""
    from daybook.functions.text import pad_left
    from daybook.sources.product_csv import PRODUCT_SCHEMA
    k, s, price = F.col("p_partkey"), F.col("p_size"), F.col("p_retailprice")
    ks = _s("p_partkey")
    dec = "decimal(38,10)"

    def ts(base):
        return F.timestamp_add("MINUTE", k, _ts(base))

    null = F.lit(None).cast("string")
    fields = {
        0: F.md5(F.concat(F.lit("prd-"), ks)), 1: s % 2 == 0, 2: s % 3 != 0,
        3: ts("2020-01-01 00:00:00"), 4: null, 5: null,
        6: F.concat(F.lit("<div>"), F.col("p_name"), F.lit(', "'), F.col("p_brand"),
                    F.lit('"</div>\n<div>'), F.col("p_type"), F.lit("</div>")),
        7: F.lit(True), 8: s % 5 != 0, 9: F.lit(True),
        10: F.concat(F.lit("PRD"), pad_left(ks, 5)),
        11: F.when(s % 2 == 0, "END_OF_DAY").otherwise("AVERAGE"),
        12: F.when(s % 3 == 0, "FIRST_DAY_OF_MONTH").when(s % 3 == 1, "DAILY").otherwise("ANNUALLY"),
        13: null, 14: F.when(s % 4 == 0, F.md5(F.concat(F.lit("key-"), ks))),
        15: s % 7 != 0, 16: ts("2021-06-01 12:00:00"), 17: F.lit("MONTHS"),
        18: F.when(s % 2 == 0, price), 19: null,
        20: F.when(s % 3 == 0, price.cast(dec)), 21: F.when(s % 4 == 1, price / 4),
        22: F.lit(0).cast(dec), 23: F.col("p_name"), 24: F.lit("CURRENT_ACCOUNT"),
        25: F.when(s % 2 == 1, F.lit(0).cast(dec)), 26: null, 27: null,
        28: (k * 1000).cast(dec), 29: s % 2 == 1, 30: F.lit(False), 31: F.lit("RANDOM_PATTERN"),
        32: F.when(s % 2 == 0, "AAA-000").otherwise("9-000000"), 33: F.lit("NONE"),
        34: F.when(s % 5 != 0, price), 35: F.when(s % 2 == 0, "ACTUAL_365_FIXED"),
        36: s % 3 == 0, 37: F.when(s % 3 == 1, F.md5(F.concat(F.lit("opt-"), ks))),
        38: F.lit("OPTIONAL"), 39: F.lit("NONE"), 40: F.lit("ACTUAL_365_FIXED"), 41: F.lit(False),
        42: F.when(s % 2 == 0, k.cast(dec)), 43: s % 4 == 0, 44: F.lit("END_OF_DAY"),
        45: F.lit("PERSONAL_DEPOSIT"),
    }
    return part.select(*[fields[i].cast(f.dataType).alias(f.name)
                         for i, f in enumerate(PRODUCT_SCHEMA.fields)])


_MATERIALIZED: dict[tuple[str, str, str], Ledger] = {}
_LOCK = threading.Lock()


def materialized_fixture_ledger(spark: SparkSession, sf_dir: str,
                                keys: AttributeKeys | None = None) -> Ledger:
    """The fixture views written once per session as parquet tables in the
    shared folder and read back, so queries scan tables as they would in
    production (pushed filters, column pruning, file statistics) instead of
    re-deriving the views from the test tables on every reference.

    The attribute table is written partitioned by ``customfieldkey``: the
    jobs always filter it by key, and a key filter then prunes whole
    directories.  Transactions are written in id order, as an append-only
    ledger grows, so each file covers an id range and id filters (cut-offs,
    id ranges) skip files and row groups by their statistics.  No derived
    layout (dated ledger, buckets) is built here: those would do part of the
    queries' own work ahead of them.
    """
    from daybook.session import program_scope
    keys = keys or AttributeKeys()
    try:
        app = spark.sparkContext.applicationId
    except Exception:  # noqa: BLE001 — sessions without a local SparkContext
        app = str(id(spark))
    cache_key = (app, sf_dir.rstrip("/"), repr(sorted(keys.keys.items())))
    with _LOCK:
        if cache_key in _MATERIALIZED:
            return _MATERIALIZED[cache_key]
        led = load_fixture_ledger(spark, sf_dir, keys)
        base = program_scope(spark).new_path("fixture")

        def write(name: str) -> tuple[str, DataFrame]:
            df = getattr(led, name)
            path = f"{base}/{name}"
            if name == "trx":
                df = df.orderBy("transactionid")     # id order, as an append-only ledger
            w = df.write.mode("overwrite")
            if name == "cfv":
                w = w.partitionBy("customfieldkey")
            w.parquet(path)
            return name, spark.read.parquet(path).select(*df.columns)

        # nine independent write jobs, submitted side by side
        names = ("trx", "cfv", "hld", "ahold", "trxdet", "cta", "cli", "prod", "trxch")
        with ThreadPoolExecutor(max_workers=4) as pool:
            out = dict(pool.map(write, names))
        mat = Ledger(keys=keys, **out)
        _MATERIALIZED[cache_key] = mat
        return mat
