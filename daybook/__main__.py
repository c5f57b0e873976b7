"""Command line for the daily run.

    python -m daybook --date 20240122 --products "'P0', 'P1'" \
        --tables /data/ledger --out /data/extracts/2024-01-22

or on a cluster ``spark-submit --py-files daybook.zip daybook/__main__.py ...``
with the same arguments.

``--tables`` is a folder of parquet tables named after the source tables
(``savingstransaction``, ``customfieldvalue``, ...).  With ``--jdbc-url``
the tables are read over JDBC instead; the ledger is then read in
``--jdbc-partitions`` ranges of ``transactionid`` and the attribute table in
one range per attribute and one for all others (the other tables are read whole).  ``--keys`` names the
attribute keys of the environment, which differ between databases.  The session is whatever
``spark-submit`` configured; nothing here sets cluster resources.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession


def parse_args(argv):
    ap = argparse.ArgumentParser(prog="daybook", description="Daily ledger extract for one accounting date.")
    ap.add_argument("--date", required=True, help="accounting date, yyyymmdd")
    ap.add_argument("--products", required=True, help="product list, e.g. \"'P0', 'P1'\"")
    ap.add_argument("--out", required=True, help="output folder (reconciliation/, extract/ and rejects/ inside)")
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--tables", help="folder of parquet source tables")
    src.add_argument("--jdbc-url", help="JDBC URL of the source database")
    ap.add_argument("--jdbc-options", metavar="FILE",
                    help="JSON object of JDBC options, such as user, password, driver (not shown in the process list)")
    ap.add_argument("--jdbc-partitions", type=int, default=0,
                    help="id-range partitions for the ledger (0: one partition per table); needs --max-transaction-id")
    ap.add_argument("--max-transaction-id", type=int, help="upper bound of transaction ids for the range partitions")
    ap.add_argument("--keys", metavar="FILE",
                    help="JSON object from logical attribute names to this database's keys; without it the names are the keys")
    ap.add_argument("--dated", help="folder of the dated ledger layout (write_dated_ledger); "
                                    "date filters then read one partition")
    ap.add_argument("--strict-layout", action="store_true", help="reproduce the original record quirks")
    ap.add_argument("--index", action="store_true", help="reconciliation with an unnamed first column of row numbers")
    ap.add_argument("--single-file", action="store_true", help="one file per output instead of part files")
    ap.add_argument("--state", metavar="DIR", help="folder of the snapshot's state: made there by the first run, then brought "
                                                    "to the date by its new ledger rows instead of the whole history")
    args = ap.parse_args(argv)
    if args.jdbc_partitions and args.max_transaction_id is None:
        ap.error("--jdbc-partitions needs --max-transaction-id")
    return args


def _json(path: str | None) -> dict[str, str]:
    if path is None:
        return {}
    with open(path, encoding="utf-8") as f:
        return json.load(f)


def main(argv=None, spark: SparkSession | None = None) -> int:
    from daybook.params import AttributeKeys, RunParams
    from daybook.plans.daily import daily_extract
    from daybook.plans.state import SnapshotState
    from daybook.sources.ledger_tables import load_ledger_jdbc, load_ledger_parquet, with_dated

    args = parse_args(sys.argv[1:] if argv is None else argv)
    spark = spark or SparkSession.builder.appName(f"daybook-{args.date}").getOrCreate()
    keys = AttributeKeys(_json(args.keys)) if args.keys else AttributeKeys()
    if args.tables:
        led = load_ledger_parquet(spark, args.tables, keys)
    else:
        # the attribute table, the largest, in one range per attribute that the run reads and one for the rest
        known = ["'" + k.replace("'", "''") + "'" for k in sorted(set(keys.keys.values()))]
        parts = [f"customfieldkey = {k}" for k in known]
        parts.append(f"customfieldkey IS NULL OR customfieldkey NOT IN ({', '.join(known)})")
        split = {"cfv": parts} if args.jdbc_partitions else None
        bounds = None
        if args.jdbc_partitions:
            bounds = {"trx": ("transactionid", 0, args.max_transaction_id, args.jdbc_partitions)}
        led = load_ledger_jdbc(spark, args.jdbc_url, keys, bounds=bounds,
                               predicates=split, extra=_json(args.jdbc_options))
    if args.dated:
        led = with_dated(led, spark, args.dated)
    state = None
    if args.state:
        day = RunParams.from_yyyymmdd(args.date, args.products).run_date
        state = SnapshotState.load(spark, args.state) if SnapshotState.exists(spark, args.state) else None
        state = state.apply(led, day) if state else SnapshotState.create(led, day, args.state)
    out = daily_extract(led, args.date, args.products, args.out, strict_layout=args.strict_layout,
                        index=args.index, single_file=args.single_file, state=state)
    print(f"reconciliation: {out.reconciliation}\nextract: {out.extract} ({out.written.lines} lines)\n"
          f"rejects: {out.rejects} ({out.written.rejected} records)")
    return 0


if __name__ == "__main__":
    sys.exit(main())
