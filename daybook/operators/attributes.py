"""Entity–attribute–value lookups on ``customfieldvalue``.

The attribute table holds one row per (entity, attribute); an entity is a
transaction, an account or a client, told apart only by which key its
``parentkey`` refers to.

Two ways to turn attributes into columns:

* ``lookup_join`` — one join per attribute on (parentkey, customfieldkey), as
  the SQL jobs write it.  Optional (``left``) or mandatory (``inner``).  A
  duplicated (parent, key) pair multiplies rows, as the SQL does.
* ``pivot_attributes`` — all wanted attributes of one level in a single
  aggregation: filter by key (pushed to the scan), group by ``parentkey``
  (one shuffle, partial aggregation on the map side), ``max(when(...))`` per
  attribute.  A duplicated pair yields the larger value, not two rows.  When
  (parent, key) is unique both give the same columns.

At scale the pivot replaces n self-joins of the largest table with one
shuffle of the rows that carry the wanted keys; ``restrict_to`` first keeps
only rows of the entities at hand (a semi join whose partitioning the
aggregation and the final join reuse).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rows_for_keys(cfv: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Attribute rows whose key is one of ``keys`` (filter before shuffling)."""
    keys = list(dict.fromkeys(keys))
    cond = F.col("customfieldkey") == keys[0] if len(keys) == 1 else F.col("customfieldkey").isin(keys)
    return cfv.select("parentkey", "customfieldkey", "value").filter(cond)


def lookup_join(entities: DataFrame, entity_key: str | Column, cfv: DataFrame,
                name: str, key: str, how: str = "left") -> DataFrame:
    """``JOIN customfieldvalue x ON x.parentkey = <entity key> AND
    x.customfieldkey = '<key>'``; the value becomes column ``name``."""
    pk = f"__pk_{name}"
    look = rows_for_keys(cfv, [key]).select(F.col("parentkey").alias(pk), F.col("value").alias(name))
    ek = entities[entity_key] if isinstance(entity_key, str) else entity_key
    return entities.join(look, ek == look[pk], how).drop(pk)


def pivot_attributes(cfv: DataFrame, names: Mapping[str, str],
                     required: Sequence[str] = (),
                     restrict_to: DataFrame | None = None,
                     restrict_key: str | None = None) -> DataFrame:
    """One row per ``parentkey``, one column per attribute in ``names``
    (column name → customfieldkey).

    ``required``: attribute names that must be present (mandatory lookups);
    parents lacking one are dropped.  Presence is tested on the key, so an
    attribute row with a NULL value still counts as present, as an inner join
    would count it.
    ``restrict_to`` / ``restrict_key``: keep only attribute rows whose parent
    is in that frame's key column.
    """
    rows = rows_for_keys(cfv, list(names.values()))
    if restrict_to is not None:
        ents = restrict_to.select(F.col(restrict_key).alias("parentkey"))
        rows = rows.join(ents, "parentkey", "left_semi")
    k = F.col("customfieldkey")
    aggs = [F.max(F.when(k == key, F.col("value"))).alias(name) for name, key in names.items()]
    aggs += [F.bool_or(k == names[name]).alias(f"__has_{name}") for name in required]
    out = rows.groupBy("parentkey").agg(*aggs)
    if required:
        cond = None
        for name in required:
            c = F.col(f"__has_{name}")
            cond = c if cond is None else cond & c
        out = out.filter(cond).drop(*[f"__has_{n}" for n in required])
    return out


def attach_attributes(entities: DataFrame, entity_key: str, cfv: DataFrame,
                      names: Mapping[str, str], required: Sequence[str] = (),
                      restrict: bool = False) -> DataFrame:
    """Pivot the attributes of ``entities`` and join them on ``entity_key``.

    Without ``required`` the join is ``left`` (entities without attributes
    keep NULLs); with it, ``inner`` (the mandatory lookups drop entities).
    ``restrict=True`` limits the pivot to the entities' own rows first — worth
    it when the entities are a small part of their level (e.g. one
    transaction per account out of the whole ledger).
    """
    piv = pivot_attributes(cfv, names, required,
                           restrict_to=entities if restrict else None,
                           restrict_key=entity_key if restrict else None)
    piv = piv.withColumnRenamed("parentkey", "__parentkey")
    how = "inner" if required else "left"
    return entities.join(piv, entities[entity_key] == piv["__parentkey"], how).drop("__parentkey")


def attach_by_join(entities: DataFrame, unique: str, entity_key: str, cfv: DataFrame,
                   names: Mapping[str, str]) -> DataFrame:
    """``attach_attributes`` for few entities with a ``unique`` column: their
    attribute rows are joined first and folded per entity afterwards, so
    ``entities`` is computed once and the attribute table is never grouped as a
    whole.  Repeated rows fold by ``max``, as in the pivot."""
    rows = rows_for_keys(cfv, list(names.values()))
    j = entities.join(rows, entities[entity_key] == rows["parentkey"], "left")
    rest = [c for c in entities.columns if c != unique]
    k = F.col("customfieldkey")
    return (j.groupBy(unique)
            .agg(F.any_value(F.struct(*rest)).alias("__e"),
                 *[F.max(F.when(k == key, F.col("value"))).alias(name) for name, key in names.items()])
            .select(unique, "__e.*", *names))


def attribute_fanout(entities: DataFrame, entity_key: str, cfv: DataFrame,
                     lookups: int = 2) -> DataFrame:
    """Rows that ``lookups`` unkeyed left joins (``ON x.parentkey = key``
    with no attribute-key condition) would produce per entity: n**lookups
    for n attribute rows, 1 when the entity has none.

    Computed from a count per parent; the pairs themselves are never built.
    """
    owners = entities.select(F.col(entity_key).alias("parentkey"))
    own = cfv.select("parentkey").join(owners, "parentkey", "left_semi")     # not the transactions' rows
    counts = own.groupBy(F.col("parentkey").alias("__pk")).agg(F.count(F.lit(1)).alias("__n"))
    j = entities.join(counts, entities[entity_key] == counts["__pk"], "left")
    n = F.coalesce(F.col("__n"), F.lit(1)).cast("bigint")
    fan = n
    for _ in range(lookups - 1):
        fan = fan * n
    return j.withColumn("n_rows", fan).drop("__pk", "__n")
