"""Independent SQL oracle (DuckDB dialect) for every registered query.

Each oracle is the fixture mapping as common table expressions over the
driver's test tables, followed by the query written by other means than the Spark
code (``daybook.oracle_queries``).  The Spark side computes the same result with the DataFrame
operators of this package, so agreement checks those operators.
"""

from __future__ import annotations

# Fixed values of the fixture run (FIXTURES.md): run date, next day, products.
D = "2024-01-22"
N = "2024-01-23"
D_YYYYMMDD = "20240122"
PRODUCTS_SQL = "('P0', 'P1', 'P2', 'P3')"

FIXTURE_CTES = r"""
ev AS (
  SELECT event_id, ts, user_id, event_type, value,
         CASE WHEN user_id % 7 = 3 AND CAST(ts AS DATE) + CASE WHEN event_type IN ('purchase', 'signup') THEN 1 ELSE 0 END = DATE '2024-01-23'
              THEN CAST(0 AS DECIMAL(18,2))
              WHEN event_type = 'error' THEN -CAST(value AS DECIMAL(18,2))
              ELSE CAST(value AS DECIMAL(18,2)) END AS amt
  FROM events
),
trx AS (
  SELECT event_id AS transactionid,
         'trx-' || CAST(event_id AS VARCHAR) AS encodedkey,
         CASE WHEN event_id % 97 = 0 THEN 'gone-' ELSE 'cta-' END || CAST(user_id AS VARCHAR) AS parentaccountkey,
         CAST(SUM(amt) OVER (PARTITION BY user_id ORDER BY event_id
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DECIMAL(18,2)) AS balance,
         amt AS amount,
         CASE WHEN event_id % 37 <> 0 THEN 'det-' || CAST(event_id AS VARCHAR) END AS details_encodedkey_oid
  FROM ev
),
cta AS (
  SELECT lpad(CAST(c_custkey AS VARCHAR), 14, '0') AS id,
         CASE c_mktsegment WHEN 'BUILDING' THEN 'LOCKED' WHEN 'MACHINERY' THEN 'CLOSED'
              ELSE 'ACTIVE' END AS accountstate,
         'cta-' || CAST(c_custkey AS VARCHAR) AS encodedkey,
         'prd-' || CASE WHEN c_custkey % 13 = 5 THEN 'gone' ELSE CAST(c_custkey % 5 AS VARCHAR) END AS producttypekey,
         CASE WHEN c_mktsegment = 'BUILDING' THEN CAST(c_acctbal AS DECIMAL(18,2)) END AS blockedbalance,
         CASE WHEN c_mktsegment = 'BUILDING' THEN
              CASE WHEN c_custkey % 3 = 0 THEN TIMESTAMP '2024-01-22 09:00:00'
                   ELSE TIMESTAMP '2023-12-01 09:00:00' END END AS lockeddate,
         CASE WHEN c_mktsegment = 'MACHINERY' THEN TIMESTAMP '2023-11-30 18:00:00' END AS closeddate,
         'cli-' || CAST(c_custkey AS VARCHAR) AS accountholderkey,
         TIMESTAMP '2020-01-02 08:00:00' AS activationdate,
         CAST(c_acctbal AS DECIMAL(18,2)) AS holdbalance
  FROM customer
),
prod AS (
  SELECT 'P' || CAST(r_regionkey AS VARCHAR) AS id, r_name AS name,
         'prd-' || CAST(r_regionkey AS VARCHAR) AS encodedkey
  FROM region
),
cli AS (SELECT 'cli-' || CAST(c_custkey AS VARCHAR) AS encodedkey FROM customer),
trxdet AS (
  SELECT 'det-' || CAST(event_id AS VARCHAR) AS encodedkey,
         CASE WHEN event_id % 31 <> 0 THEN 'ch-' || event_type END AS transactionchannelkey
  FROM events
),
trxch AS (SELECT DISTINCT upper(event_type) AS id, 'ch-' || event_type AS encodedkey FROM events),
ahold AS (
  SELECT CASE WHEN event_id % 9 = 0 THEN CAST(event_id AS VARCHAR)
              ELSE CAST(event_id AS VARCHAR) || '-1' END AS externalreferenceid,
         CAST(value AS DECIMAL(18,2)) AS amount,
         CASE WHEN event_id % 3 = 0 THEN 'SETTLED' ELSE 'PENDING' END AS state,
         lpad(CAST(user_id AS VARCHAR), 14, '0') AS cardreferencetoken
  FROM events
),
hld AS (
  SELECT CAST(CASE o_orderkey % 8 WHEN 0 THEN 1 WHEN 1 THEN 1 WHEN 2 THEN 1 WHEN 3 THEN 1
                   WHEN 4 THEN 0 WHEN 5 THEN 0 WHEN 6 THEN 1 ELSE 0 END AS INTEGER) AS isannualyrecurring,
         CAST(CASE o_orderkey % 8 WHEN 0 THEN 1 WHEN 1 THEN 12 WHEN 2 THEN 2 WHEN 3 THEN 5
                   WHEN 4 THEN 1 WHEN 5 THEN 2 WHEN 6 THEN 9 ELSE month(o_orderdate) END AS INTEGER) AS monthofyear,
         CAST(CASE o_orderkey % 8 WHEN 0 THEN 1 WHEN 1 THEN 25 WHEN 2 THEN 29 WHEN 3 THEN 1
                   WHEN 4 THEN 23 WHEN 5 THEN 30 WHEN 6 THEN 18 ELSE day(o_orderdate) END AS INTEGER) AS dayofmonth,
         CAST(CASE o_orderkey % 8 WHEN 0 THEN 2020 WHEN 1 THEN 2020 WHEN 2 THEN 2020 WHEN 3 THEN 2020
                   WHEN 4 THEN 2024 WHEN 5 THEN 2021 WHEN 6 THEN 2020 ELSE year(o_orderdate) END AS INTEGER) AS year,
         CASE o_orderkey % 8 WHEN 0 THEN 'new year' WHEN 1 THEN 'xmas' WHEN 2 THEN 'leap'
              WHEN 3 THEN 'labour' WHEN 4 THEN 'one-off' WHEN 5 THEN 'impossible'
              WHEN 6 THEN 'national' ELSE o_orderpriority END AS name
  FROM orders
),
cfv0 AS (
  SELECT 'trx-' || CAST(event_id AS VARCHAR) AS parentkey, 'fechcontab' AS customfieldkey,
         CAST(CAST(ts AS DATE) + CASE WHEN event_type IN ('purchase', 'signup') THEN 1 ELSE 0 END AS VARCHAR) AS value
  FROM events
  UNION ALL
  SELECT 'trx-' || CAST(event_id AS VARCHAR), 'adjust_state',
         CASE WHEN event_id % 10 = 0 THEN '1' ELSE '0' END FROM events
  UNION ALL
  SELECT 'trx-' || CAST(event_id AS VARCHAR), 'fechamov', CAST(CAST(ts AS DATE) AS VARCHAR)
  FROM events WHERE event_type IN ('purchase', 'signup')
  UNION ALL
  SELECT 'trx-' || CAST(event_id AS VARCHAR), 'tiporetencion',
         CASE event_id % 6 WHEN 1 THEN '1' WHEN 2 THEN '2' WHEN 3 THEN '3' WHEN 4 THEN 'N' END
  FROM events WHERE event_id % 6 <> 0
  UNION ALL
  SELECT 'cli-' || CAST(c_custkey AS VARCHAR), 'rut',
         CAST(10000000 + c_custkey AS VARCHAR) || '-' || CAST(c_custkey % 10 AS VARCHAR) FROM customer
  UNION ALL
  SELECT 'cta-' || CAST(c_custkey AS VARCHAR), 'tipocliente',
         CASE WHEN c_nationkey % 2 = 0 THEN 'N' ELSE 'J' END FROM customer
  UNION ALL
  SELECT 'cta-' || CAST(c_custkey AS VARCHAR), 'numctabech', lpad(CAST(c_custkey * 7 AS VARCHAR), 11, '0')
  FROM customer
  UNION ALL
  SELECT 'cta-' || CAST(c_custkey AS VARCHAR), 'fechaperut', '2020-01-02' FROM customer
  UNION ALL
  SELECT 'cta-' || CAST(c_custkey AS VARCHAR), 'ofiprod', lpad(CAST(c_nationkey AS VARCHAR), 3, '0')
  FROM customer WHERE c_custkey % 7 <> 0
  UNION ALL
  SELECT 'cta-' || CAST(c_custkey AS VARCHAR), 'ofiprod', '001' FROM customer WHERE c_custkey % 17 = 3
  UNION ALL
  SELECT 'cta-' || CAST(c_custkey AS VARCHAR), 'ruttutor', CAST(20000000 + c_custkey AS VARCHAR)
  FROM customer WHERE c_custkey % 11 = 0
  UNION ALL
  SELECT 'cta-' || CAST(c_custkey AS VARCHAR), 'codblq',
         CASE WHEN c_custkey % 2 = 0 THEN '99' ELSE '01' END
  FROM customer WHERE c_mktsegment = 'BUILDING' AND c_custkey % 4 <> 3
  UNION ALL
  SELECT 'cta-' || CAST(c_custkey AS VARCHAR), 'causalcierre', 'C1'
  FROM customer WHERE c_mktsegment = 'MACHINERY'
),
cfv AS (
  SELECT 'cfv-' || customfieldkey || '-' || parentkey AS encodedkey, parentkey, customfieldkey, value
  FROM cfv0
)"""


def with_fixture(body: str) -> str:
    """``WITH <fixture views>[, more CTEs] SELECT ...``.

    ``body`` either starts with ``SELECT`` or with ``, name AS (...)``.
    """
    body = body.strip()
    sep = "\n" if body.startswith(",") else "\n"
    return f"WITH {FIXTURE_CTES.strip()}{sep}{body}"


_QUERIES: dict[str, str] = {}


def register(name: str, body: str) -> None:
    _QUERIES[name] = with_fixture(body)


def all_oracles() -> dict[str, str]:
    # the query bodies live in daybook.oracle_queries; importing it fills _QUERIES
    import daybook.oracle_queries  # noqa: F401
    return dict(_QUERIES)
