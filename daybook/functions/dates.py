"""Date helpers: run-date text, next day, first of month, date prefixes.

Dates held as text (attribute values) are compared as text where the jobs do
so, and parsed with ``try_to_date`` where a date comparison is meant, so that a
malformed value gives NULL instead of failing the job under ANSI mode.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def iso_from_yyyymmdd(x) -> Column:
    """``'20240122'`` → ``'2024-01-22'`` (NULL for impossible dates)."""
    return F.date_format(F.try_to_date(_c(x), "yyyyMMdd"), "yyyy-MM-dd")


def next_calendar_day(x) -> Column:
    """ISO text → ISO text of the following calendar day."""
    return F.date_format(F.date_add(F.try_to_date(_c(x)), 1), "yyyy-MM-dd")


def first_of_month(x) -> Column:
    return F.date_format(F.trunc(F.try_to_date(_c(x)), "MM"), "yyyy-MM-dd")


def text_date(x) -> Column:
    """A date stored as text, parsed leniently (NULL if not a date)."""
    return F.try_to_date(_c(x))


def date_prefix(ts, n: int = 10) -> Column:
    """``LEFT(ts, 10)``: the first characters of the timestamp's text."""
    return F.left(_c(ts).cast("string"), F.lit(n))


def calendar_date(year, month, day) -> Column:
    """The date ``year-month-day``; NULL when it does not exist (30 February,
    29 February of a common year, month 13, day 0).

    The day is checked against the last day of its month before
    ``make_date`` runs (``CASE`` evaluates its branch only for valid rows), so
    ANSI mode raises nothing — about ten times cheaper than formatting and
    parsing a text per row.
    """
    y, m, d = _c(year), _c(month), _c(day)
    valid = m.between(1, 12) & (d >= 1) & (d <= F.dayofmonth(F.last_day(F.make_date(y, m, F.lit(1)))))
    return F.when(valid, F.make_date(y, m, d))


def yyyymmdd(x) -> Column:
    return F.date_format(_c(x), "yyyyMMdd")
