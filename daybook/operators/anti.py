"""``NOT IN`` with SQL's null semantics, without a forced broadcast.

``x NOT IN (SELECT y ...)`` is

* TRUE for every row when the subquery is empty (even when x is NULL);
* otherwise NULL — the row is dropped — when x is NULL or any y is NULL;
* otherwise TRUE exactly when x equals no y.

Spark plans SQL ``NOT IN`` as a null-aware anti join that must broadcast the
subquery side, which does not hold when that side grows with the data.  Here
the subquery's row count and NULL count come from one scalar subquery (a
one-row aggregate), and the matching is a plain
``left_anti`` join that Spark may run as a sort-merge or hash join as sizes
require.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def not_in(left: DataFrame, left_col: str, right: DataFrame, right_col: str) -> DataFrame:
    """Rows of ``left`` with ``left[left_col] NOT IN (right[right_col])``."""
    sub = right.select(F.col(right_col).alias("__v"))
    stats = sub.agg(F.struct(F.count(F.lit(1)).alias("n"),
                             F.count_if(F.col("__v").isNull()).alias("n_null")).alias("s"))
    s = stats.scalar()                      # one 1-row subquery
    n_rows, n_null = s.getField("n"), s.getField("n_null")
    keys = sub.filter(F.col("__v").isNotNull())
    kept = left.join(keys, left[left_col] == keys["__v"], "left_anti")
    return kept.filter((n_rows == 0) | ((n_null == 0) & F.col(left_col).isNotNull()))
