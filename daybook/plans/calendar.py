"""Holiday calendar, run-date parameters and the next business day.

Holiday rows: (isannualyrecurring, monthofyear, dayofmonth, year, name).  A
recurring holiday falls on its month and day in every year; any other row on
its own date.  Impossible dates (30 February, 29 February of a common year)
give NULL rather than failing under ANSI mode.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.functions.dates import calendar_date, first_of_month, iso_from_yyyymmdd, next_calendar_day
from daybook.operators.ordered import carry
from daybook.session import Scope, program_scope


def holiday_calendar(hld: DataFrame, run_year: int) -> DataFrame:
    """The concrete date of each holiday row: recurring ones in ``run_year``.

    Columns: holidays, name, is_recurring, date_platform (dates as
    ``yyyy-MM-dd`` text; ``date_platform`` is the row's own year).
    """
    recurring = F.col("isannualyrecurring") == 1
    own = calendar_date("year", "monthofyear", "dayofmonth")
    in_run_year = calendar_date(F.lit(run_year), F.col("monthofyear"), F.col("dayofmonth"))
    return hld.select(
        F.when(recurring, in_run_year).otherwise(own).cast("string").alias("holidays"),
        F.col("name").alias("name"),
        F.col("isannualyrecurring").alias("is_recurring"),
        own.cast("string").alias("date_platform"))


def date_params(run_dates: DataFrame, col: str = "run_date") -> DataFrame:
    """For run-date texts ``yyyymmdd``: ISO date, next calendar day, first
    day of the month."""
    iso = iso_from_yyyymmdd(col)
    return run_dates.select(
        F.col(col).alias("run_date"), iso.alias("fecha"),
        next_calendar_day(iso).alias("next_day"), first_of_month(iso).alias("first_of_month"))


def _is_weekend(d: Column) -> Column:
    return F.dayofweek(d).isin(1, 7)          # Spark: 1 = Sunday, 7 = Saturday


def _horizon(closed: DataFrame, after: Column) -> Column:
    """Days after the date ``after`` within which a business day must exist.

    With R distinct recurring (month, day) pairs and O distinct one-off dates
    on or after the date, a window of W days (a multiple of
    7) holds 5W/7 weekdays and at most R·(W/365 + 2) + O holidays, so it
    holds a business day once 5W/7 > R·(W/365 + 2) + O, which needs
    W > (2R + O + 1) / (5/7 − R/365) while R < 260.  For R ≥ 260: a
    (month, day) that is not a recurring holiday falls on a weekday at least
    once in any 28 consecutive years (29 February included), so
    28·366·(O + 1) days suffice unless every (month, day) is a holiday (then
    there is no business day at all and the result is NULL).  The bound comes
    from the data; nothing is capped.
    """
    # a recurring 29 February counts as a (month, day) pair of leap years
    pair_ok = calendar_date(F.lit(2000), F.col("m"), F.col("d")).isNotNull()
    stats = closed.agg(F.struct(F.count_if(F.col("m").isNotNull() & pair_ok).alias("r"), F.count_if(F.col("day") >= after).alias("o")))
    s = stats.scalar()                      # one 1-row subquery
    r, o = s.getField("r"), s.getField("o")
    small = F.ceil((F.lit(2) * r + o + 1) / (F.lit(5.0 / 7.0) - r / F.lit(365.0)))
    w = F.when(r < 260, F.ceil(small / 7) * 7 + 7).otherwise(F.lit(28 * 366) * (o + 1))
    return w.cast("int")


def closed_days(hld: DataFrame) -> DataFrame:
    """The distinct holidays: (m, d) of recurring ones, or the one-off ``day``."""
    rec = F.coalesce(F.col("isannualyrecurring") == 1, F.lit(False))
    none = F.lit(None).cast("int")
    out = hld.select(F.when(rec, F.col("monthofyear")).otherwise(none).alias("m"), F.when(rec, F.col("dayofmonth")).otherwise(none).alias("d"),
                     F.when(~rec, calendar_date("year", "monthofyear", "dayofmonth")).alias("day"))
    return out.filter(F.coalesce("m", "d").isNotNull() | F.col("day").isNotNull()).distinct()


def next_business_day(dates: DataFrame, hld: DataFrame, col: str = "fecha", scope: Scope | None = None) -> DataFrame:
    """For each date in ``dates[col]`` (a date column), the first later day
    that is neither Saturday, Sunday nor a holiday.

    One calendar runs from the first date to ``_horizon`` days after the last, a row
    per day whatever the number of dates and holiday rows; open days are marked by
    joining the distinct holidays, the next open day is carried backwards over it
    (``operators.ordered.carry``), and every date looks up the day after it.  The
    distinct dates and the distinct holidays are saved in ``scope`` (by default the
    program's), so each table is read once.
    """
    scope = scope or program_scope(hld.sparkSession)
    d = scope.save(dates.select(F.col(col).alias("__d")).filter(F.col("__d").isNotNull()).distinct(), "dates")
    closed = scope.save(closed_days(hld), "closed-days")
    span = d.agg(F.min("__d").alias("lo"), F.max("__d").alias("hi"))
    last = d.agg(F.max("__d")).scalar()
    days = span.select(F.explode(F.sequence(F.date_add("lo", 1), F.date_add("hi", 1 + _horizon(closed, last)))).alias("__c"))
    yearly = closed.filter(F.col("m").isNotNull()).select("m", "d", F.lit(True).alias("__yearly"))
    once = closed.filter(F.col("day").isNotNull()).select("day", F.lit(True).alias("__once"))
    marked = (days.join(yearly, (F.month("__c") == F.col("m")) & (F.dayofmonth("__c") == F.col("d")), "left")
              .join(once, F.col("__c") == F.col("day"), "left"))
    is_open = ~_is_weekend(F.col("__c")) & F.col("__yearly").isNull() & F.col("__once").isNull()
    marked = marked.select("__c", F.when(is_open, F.col("__c")).alias("__open"))
    nxt = carry(marked, ["__c"], "__open", "__n", scope, backwards=True)
    out = d.join(nxt, F.date_add("__d", 1) == nxt["__c"], "left")
    return out.select(F.date_format("__d", "yyyy-MM-dd").alias("fecha"),
                      F.date_format("__n", "yyyy-MM-dd").alias("next_business_day"))


HOLIDAY_SQL = """
WITH h AS (
  SELECT name, isannualyrecurring, monthofyear, dayofmonth, year,
         monthofyear BETWEEN 1 AND 12 AND dayofmonth >= 1
           AND dayofmonth <= day(last_day(make_date(year, monthofyear, 1))) AS own_ok,
         monthofyear BETWEEN 1 AND 12 AND dayofmonth >= 1
           AND dayofmonth <= day(last_day(make_date(:run_year, monthofyear, 1))) AS run_ok
  FROM IDENTIFIER(:view)
)
SELECT CAST(CASE WHEN isannualyrecurring = 1
                 THEN CASE WHEN run_ok THEN make_date(:run_year, monthofyear, dayofmonth) END
                 ELSE CASE WHEN own_ok THEN make_date(year, monthofyear, dayofmonth) END
            END AS STRING) AS holidays,
       name AS name,
       isannualyrecurring AS is_recurring,
       CAST(CASE WHEN own_ok THEN make_date(year, monthofyear, dayofmonth) END AS STRING) AS date_platform
FROM h
"""


def holiday_calendar_sql(spark, run_year: int, view: str = "holiday") -> DataFrame:
    """The calendar as Spark SQL over a registered view; the run year and the
    view are named parameters, not text pasted into the statement."""
    return spark.sql(HOLIDAY_SQL, args={"run_year": run_year, "view": view})
