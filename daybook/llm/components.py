"""Connected components of an edge table, with Spark joins only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import save


def _mark(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first())


def components(edges: DataFrame) -> DataFrame:
    """(id, root) of every id in ``edges`` (a, b): root is the smallest id that
    links reach.

    Large-star and small-star steps in turn: each hangs neighbours below the
    smallest id they see, until the edges are stars.  Every step is a minimum
    per id (combined before its shuffle) and a join with that saved minimum,
    whose hot keys adaptive execution can split; nothing goes to the driver but
    a count and a checksum.
    """
    e = save(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
             .filter("u <> v").distinct(), "edges")
    before = _mark(e)
    while before[0]:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = save(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "large-min")
        large = save(both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(),
                     "large-star")
        least = save(large.groupBy("u").agg(F.min("v").alias("m")), "small-min")
        moved = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = save(moved.union(least.select("u", F.col("m").alias("v"))).distinct(), "small-star")
        after = _mark(e)
        if after == before:
            break
        before = after
    return e.select(F.col("u").alias("id"), F.col("v").alias("root")).union(
        e.select(F.col("v").alias("id"), F.col("v").alias("root")).distinct())
