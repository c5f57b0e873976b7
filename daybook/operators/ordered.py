"""Global order without a one-task window: row numbers and carried values.

``Window.orderBy`` without a partition puts every row into one task.  Here the
rows are range-partitioned and sorted once and saved with their place: the number
of the range (``__part``) and the place in it (``__pos``).  What crosses a range's
border is one row per range, a table as long as there are ranges, and only that
one is put into a single order.

* ``row_numbers``: rows before a range by prefix sums of the ranges' counts.
* ``carry``: the last known value in the order (or, backwards, the next one): inside
  a range by a window over that range, from outside by the ranges' last values.

Ranges come from sampled order keys, so rows with one key share a range: the order
columns should tell rows apart, or nearly so.  Ties stand as they were saved.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.session import Scope

#: ``monotonically_increasing_id``: the partition above this bit, the place below it.
_PLACE_BITS = 33


def in_order(df: DataFrame, order: Sequence[str | Column], scope: Scope, ranges: int | None = None) -> DataFrame:
    """``df`` saved in ``order``, with ``__part`` and ``__pos``; the rows of range 0
    come first.  ``ranges``: by default the session's shuffle partitions."""
    n = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = (df.repartitionByRange(n, *order).sortWithinPartitions(*order)
              .withColumn("__order_id", F.monotonically_increasing_id()))
    return scope.save(placed, "in-order").withColumns({
        "__part": F.shiftright("__order_id", _PLACE_BITS).cast("int"),
        "__pos": F.col("__order_id").bitwiseAND((1 << _PLACE_BITS) - 1)}).drop("__order_id")


def row_numbers(df: DataFrame, order: Sequence[str | Column], scope: Scope, name: str = "index", start: int = 0,
                ranges: int | None = None) -> DataFrame:
    """``df`` with its row numbers in ``order``, from ``start`` on, without gaps."""
    placed = in_order(df, order, scope, ranges)
    counts = placed.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)    # a row per range
    base = counts.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__base"))
    return placed.join(base, "__part").withColumn(name, F.col("__base") + F.col("__pos") + start).select(name, *df.columns)


def carry(df: DataFrame, order: Sequence[str | Column], value: str, name: str, scope: Scope, backwards: bool = False,
          ranges: int | None = None) -> DataFrame:
    """``df`` with ``name``: the last value of ``value`` that is not NULL at or before a
    row in ``order``; with ``backwards``, the first at or after it.  NULL if none."""
    placed = in_order(df, order, scope, ranges)
    pos = F.col("__pos").desc() if backwards else F.col("__pos")
    part = F.col("__part").desc() if backwards else F.col("__part")
    inside = Window.partitionBy("__part").orderBy(pos).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    known = F.struct(F.col("__pos"), F.col(value).alias("v"))
    last = (F.min_by if backwards else F.max_by)(known, F.when(F.col(value).isNotNull(), F.col("__pos")))
    ends = placed.groupBy("__part").agg(last["v"].alias("__end"))
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)        # a row per range
    outside = ends.select("__part", F.last("__end", ignorenulls=True).over(before).alias("__outside"))
    own = placed.withColumn("__inside", F.last(value, ignorenulls=True).over(inside))
    return own.join(outside, "__part").withColumn(name, F.coalesce("__inside", "__outside")).select(*df.columns, name)
