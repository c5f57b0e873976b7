"""The daily run: reconciliation file and fixed-width extract for one date.

``daily_extract`` is what the extract job's ``main(--date yyyymmdd)`` does,
as one function: run parameters from the date text, the reconciliation of
snapshot balance and next-day movement written as CSV with header, the fixed-width
extract of the balance snapshot with its control trailer written as ordered text,
and the records that do not fit the layout as rejects.  The snapshot base (last
transaction, attributes and retentions of every account — one row per account) feeds
the outputs; it is saved once in a scope in the shared folder named by
``spark.checkpoint.dir``, so it is computed once and a lost executor does not
send the run back to the ledger.  Day D's activity per account, which the
movements' cut-off and ``NOT IN`` list both read, is saved the same way, and the
scope deletes both at the end.  All outputs are written by the executors as part
files; nothing passes through the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

from daybook.params import Ledger, RunParams
from daybook.plans.extract import Written, checked_lines, write_extract
from daybook.plans.movements import movements_nonzero
from daybook.plans.reconcile import reconcile
from daybook.plans.snapshot import q1_columns, q2_columns, snapshot_base
from daybook.plans.state import SnapshotState
from daybook.session import Scope
from daybook.sinks import write_csv


@dataclass(frozen=True)
class DailyOutputs:
    reconciliation: str
    extract: str
    rejects: str
    written: Written


def daily_extract(led: Ledger, date_yyyymmdd: str, products, out_dir: str, strict_layout: bool = False,
                  index: bool = False, single_file: bool = False, state: SnapshotState | None = None) -> DailyOutputs:
    """Run one accounting date; return the output folders and counts.

    ``index``: the reconciliation gets the unnamed index column, in account order.
    ``single_file``: each output is one file.  ``state``: the snapshot's state at the
    date (``plans.state``), read instead of the ledger's history."""
    p = RunParams.from_yyyymmdd(date_yyyymmdd, products)
    rec_path, ext_path, rej_path = (f"{out_dir.rstrip('/')}/{x}" for x in ("reconciliation", "extract", "rejects"))
    with Scope(led.trx.sparkSession, "daily") as scope:
        base = snapshot_base(led, p, retentions=False) if state is None else state.base(led, p)
        base = scope.save(base, "snapshot-base")
        write_csv(reconcile(q2_columns(base, p), movements_nonzero(led, p, scope=scope)), rec_path,
                  order_by=["numcta"], index=index, single_file=single_file)
        lines = checked_lines(q1_columns(base, p), p.run_date, strict=strict_layout)
        written = write_extract(lines, ext_path, rej_path, p.yyyymmdd, single_file)
    return DailyOutputs(rec_path, ext_path, rej_path, written)
