"""daybook — daily ledger extracts on the PySpark DataFrame API.

From an account ledger whose descriptive attributes live in a long
entity–attribute–value table, the package computes balances as of an
accounting date, next-day movements, retained amounts, a holiday and
business-day calendar, the reconciliation of balance and next-day movement,
and a fixed-width extract with a control trailer.

Layout:
    params      run parameters and fixed attribute / product settings
    session     session helper and the shared output folder
    sources/    parquet, CSV and JDBC readers; fixture views over test tables
    functions/  Column-expression helpers (padding, dates, codes)
    operators/  DataFrame → DataFrame building blocks (attributes, cut-offs,
                latest-per-account, null-aware anti join, retentions, ...)
    plans/      composite queries (snapshot, movements, reconcile, extract)
    sinks/      CSV / delimited / text writers
    streaming/  (empty: the reference has no streaming work)
    __main__    command line for the daily run (python -m daybook ...)
"""

from daybook.params import AttributeKeys, RunParams, Ledger  # noqa: F401
