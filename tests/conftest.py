from __future__ import annotations

import datetime as dt
import os
import sys
import tempfile
from decimal import Decimal

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pyspark.sql import SparkSession  # noqa: E402

from daybook.params import AttributeKeys, Ledger  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = (SparkSession.builder.master("local[*]")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="daybook-test-"))
         .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="daybook-warehouse-"))
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    yield s


TRX = "transactionid bigint, encodedkey string, parentaccountkey string, balance decimal(18,2), " \
      "amount decimal(18,2), details_encodedkey_oid string"
CTA = "id string, accountstate string, encodedkey string, producttypekey string, " \
      "blockedbalance decimal(18,2), lockeddate timestamp_ntz, closeddate timestamp_ntz, " \
      "accountholderkey string, activationdate timestamp_ntz, holdbalance decimal(18,2)"
PROD = "id string, name string, encodedkey string"
CLI = "encodedkey string"
CFV = "encodedkey string, parentkey string, customfieldkey string, value string"
HLD = "isannualyrecurring int, monthofyear int, dayofmonth int, year int, name string"
AHOLD = "externalreferenceid string, amount decimal(18,2), state string, cardreferencetoken string"


def money(x):
    return None if x is None else Decimal(str(x)).quantize(Decimal("0.01"))


def account(n, state="ACTIVE", product="prd-0", locked=None, blocked=None):
    return (f"{n:014d}", state, f"cta-{n}", product, money(blocked),
            locked, None, f"cli-{n}", dt.datetime(2020, 1, 2, 8), money(100))


def trx(i, acct, amount, balance=None):
    return (i, f"trx-{i}", f"cta-{acct}", money(balance if balance is not None else amount),
            money(amount), f"det-{i}")


def attr(parent, key, value):
    return (f"cfv-{key}-{parent}", parent, key, value)


def make_ledger(spark, trx_rows=(), cta_rows=(), cfv_rows=(), prod_rows=None, cli_rows=None,
                hld_rows=(), ahold_rows=()) -> Ledger:
    prod_rows = prod_rows if prod_rows is not None else [("P0", "zero", "prd-0"), ("P1", "one", "prd-1")]
    cli_rows = cli_rows if cli_rows is not None else [(r[7],) for r in cta_rows]
    return Ledger(
        trx=spark.createDataFrame(list(trx_rows), TRX),
        cta=spark.createDataFrame(list(cta_rows), CTA),
        prod=spark.createDataFrame(list(prod_rows), PROD),
        cli=spark.createDataFrame(list(cli_rows), CLI),
        cfv=spark.createDataFrame(list(cfv_rows), CFV),
        trxdet=spark.createDataFrame([], "encodedkey string, transactionchannelkey string"),
        trxch=spark.createDataFrame([], "id string, encodedkey string"),
        hld=spark.createDataFrame(list(hld_rows), HLD),
        ahold=spark.createDataFrame(list(ahold_rows), AHOLD),
        keys=AttributeKeys())
