"""Padding and text helpers for fixed-width and delimited records.

No helper shortens a value.  In a fixed-width field a longer value stops the
run with the field's width and the value's length (``fit_left``,
``fit_right``), unless the record is built under ``collecting_faults``: then it is
noted as a fault of the record, which the caller rejects.  Where a longer text does
no harm (delimited lines, counts) it is written in full (``pad_left``).  A NULL
input stays NULL.
"""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def pad_left(x, width: int, fill: str = "0") -> Column:
    """Filled up on the left to ``width`` with one character; a longer text stays whole."""
    x = _c(x).cast("string")
    return F.concat(F.repeat(F.lit(fill), F.lit(width) - F.length(x)), x)


_faults: list[tuple[Column, int]] | None = None


@contextlib.contextmanager
def collecting_faults() -> Iterator[list[tuple[Column, int]]]:
    """While open, fields that are built note (length of the value, width) here instead
    of stopping the run; an over-long value makes its field NULL."""
    global _faults
    before, _faults = _faults, []
    try:
        yield _faults
    finally:
        _faults = before


def _fitting(x: Column, width: int) -> Column:
    x = x.cast("string")
    if _faults is not None:
        _faults.append((F.length(x), width))
        return F.when(F.length(x) <= width, x)
    told = F.concat(F.lit(f"a value does not fit its field of {width} characters; it has "), F.length(x).cast("string"))
    return F.when(F.length(x) > width, F.raise_error(told)).otherwise(x)


def fit_left(x, width: int, fill: str = "0") -> Column:
    """A field of ``width`` filled up on the left; a longer value is an error."""
    return F.lpad(_fitting(_c(x), width), width, fill)


def fit_right(x, width: int) -> Column:
    """A field of ``width`` filled up with blanks on the right; a longer value is an error."""
    return F.rpad(_fitting(_c(x), width), width, " ")


def blanks(width: int) -> Column:
    """``B(n)``: n blanks."""
    return F.lit(" " * width)


def zeros_text(text: str, width: int) -> Column:
    """A constant text left-padded with '0' (``Z('0.00', 20)``)."""
    if len(text) > width:
        raise ValueError(f"{text!r} does not fit {width} characters")
    return F.lit(text.rjust(width, "0"))


def blank_if_null(x, width: int, expr: Column | None = None) -> Column:
    """Blanks for NULL, else the (checked) field of ``expr`` or ``x``."""
    x = _c(x)
    return F.when(x.isNull(), blanks(width)).otherwise(fit_right(expr if expr is not None else x, width))


def join_fields(sep: str, *cols) -> Column:
    """``concat_ws``: NULL fields are skipped, not written."""
    return F.concat_ws(sep, *[_c(c) for c in cols])
