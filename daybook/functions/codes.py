"""Code maps: account state code, amount sign, external reference number."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from daybook.functions.text import blanks, fit_right


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# Account state → one-letter state code of the extract.
STATE_CODES = (("ACTIVE", "A"), ("LOCKED", "A"), ("CLOSED", "C"))


def state_code(state, width: int = 10) -> Column:
    """ACTIVE / LOCKED → 'A', CLOSED → 'C', anything else blank; width 10."""
    s = _c(state)
    expr = None
    for name, code in STATE_CODES:
        v = fit_right(F.lit(code), width)
        expr = F.when(s == name, v) if expr is None else expr.when(s == name, v)
    return expr.otherwise(blanks(width))


def sign(x) -> Column:
    """'+' for a positive amount, '-' otherwise (zero and NULL give '-')."""
    return F.when(_c(x) > 0, F.lit("+")).otherwise(F.lit("-"))


def reference_number(ref) -> Column:
    """The number in front of the first '-' of an external reference.

    Anchored: a reference without '-' or with a non-digit prefix gives NULL
    and so matches no transaction.
    """
    return F.regexp_extract(_c(ref), r"^([0-9]+)-", 1).try_cast("bigint")
