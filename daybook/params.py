"""Run parameters, attribute dictionary and the ledger bundle.

The attribute dictionary maps a logical attribute name to the key stored in
``customfieldvalue.customfieldkey``.  Keys differ per environment, so callers
pass their own mapping; the default maps every name to itself, which is the
convention of the fixture views built from the test tables.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

# Logical attribute names read by the extract jobs.
# Transaction level: fechcontab (accounting date), adjust_state, fechamov,
# tiporetencion.  Client level: rut.  Account level: tipocliente, numctabech,
# fechaperut, ofiprod, ruttutor, codblq, causalcierre.
ATTRIBUTE_NAMES = (
    "adjust_state", "codblq", "fechaperut", "fechcontab", "fechamov",
    "numctabech", "ofiprod", "rut", "ruttutor", "tipocliente",
    "tiporetencion", "causalcierre",
)

# Account states that count as open, and all states of an
# account that can appear in the general-data extract.
OPEN_STATES = ("ACTIVE", "LOCKED")
ALL_STATES = ("ACTIVE", "LOCKED", "CLOSED")

# Retention buckets by retention type.
RETENTION_1DAY = ("1",)
RETENTION_2DAYS = ("2", "3")
RETENTION_NDAYS = ("N",)

# Fixed value: block code that excludes a LOCKED account.
BLOCK_CODE_EXCLUDED = "99"


@dataclass(frozen=True)
class AttributeKeys:
    """Logical attribute name → ``customfieldkey`` value.

    Names not given keep the default key (the name itself).
    """

    keys: dict = field(default_factory=dict)

    def __post_init__(self):
        object.__setattr__(self, "keys", {**{n: n for n in ATTRIBUTE_NAMES}, **dict(self.keys)})

    def __getitem__(self, name: str) -> str:
        return self.keys[name]

    def __getattr__(self, name: str) -> str:
        keys = object.__getattribute__(self, "keys")
        if name in keys:
            return keys[name]
        raise AttributeError(name)


def parse_product_list(text: str) -> tuple[str, ...]:
    """Parse a setting such as ``"'P0', 'P1'"`` into ``('P0', 'P1')``."""
    out = []
    for part in text.split(","):
        p = part.strip().strip("'").strip('"').strip()
        if p:
            out.append(p)
    return tuple(out)


@dataclass(frozen=True)
class RunParams:
    """Run date D (ISO text), its next calendar day N and the product list.

    ``from_yyyymmdd`` mirrors the job argument ``--date yyyymmdd``.
    """

    run_date: str
    products: tuple[str, ...]
    states: tuple[str, ...] = OPEN_STATES

    @classmethod
    def from_yyyymmdd(cls, text: str, products, states=OPEN_STATES) -> "RunParams":
        d = _dt.datetime.strptime(text, "%Y%m%d").date()
        if isinstance(products, str):
            products = parse_product_list(products)
        return cls(d.isoformat(), tuple(products), tuple(states))

    @property
    def next_day(self) -> str:
        d = _dt.date.fromisoformat(self.run_date)
        return (d + _dt.timedelta(days=1)).isoformat()

    @property
    def first_of_month(self) -> str:
        return _dt.date.fromisoformat(self.run_date).replace(day=1).isoformat()

    @property
    def yyyymmdd(self) -> str:
        return self.run_date.replace("-", "")


@dataclass
class Ledger:
    """The source tables of one environment, as DataFrames.

    trx    savingstransaction(transactionid, encodedkey, parentaccountkey,
           balance, amount, details_encodedkey_oid)
    cta    savingsaccount(id, accountstate, encodedkey, producttypekey,
           blockedbalance, lockeddate, closeddate, accountholderkey,
           activationdate, holdbalance)
    prod   savingsproduct(id, name, encodedkey)
    cli    client(encodedkey)
    cfv    customfieldvalue(encodedkey, parentkey, customfieldkey, value)
    trxdet transactiondetails(encodedkey, transactionchannelkey)
    trxch  transactionchannel(id, encodedkey)
    hld    holiday(isannualyrecurring, monthofyear, dayofmonth, year, name)
    ahold  authorizationhold(externalreferenceid, amount, state,
           cardreferencetoken)
    dated  optional layout: ledger rows with their accounting date
           (``accounting_date``), partitioned by it — date filters then read
           one partition instead of the whole history
           (``sources.ledger_tables.write_dated_ledger``)
    """

    trx: DataFrame
    cta: DataFrame
    prod: DataFrame
    cli: DataFrame
    cfv: DataFrame
    trxdet: DataFrame | None = None
    trxch: DataFrame | None = None
    hld: DataFrame | None = None
    ahold: DataFrame | None = None
    keys: AttributeKeys = field(default_factory=AttributeKeys)
    dated: DataFrame | None = None

    def register_views(self, prefix: str = "") -> list[str]:
        """Register the tables under ``prefix`` and the names the SQL text uses;
        a prefix keeps two ledgers of one session apart.  Returns the view names."""
        names = {
            "savingstransaction": self.trx, "savingsaccount": self.cta,
            "savingsproduct": self.prod, "client": self.cli,
            "customfieldvalue": self.cfv, "transactiondetails": self.trxdet,
            "transactionchannel": self.trxch, "holiday": self.hld,
            "authorizationhold": self.ahold,
        }
        made = []
        for name, df in names.items():
            if df is not None:
                df.createOrReplaceTempView(prefix + name)
                made.append(prefix + name)
        return made
