"""Mixing sources to target weights, in DataFrame functions only.

Every document gets a hash-random key.  Within each source the keys are cut
into ranges; per-range word sums give prefix sums over the ranges, which find
the one range of a source where its budget ends; only there are documents
sorted and summed one by one.  The cut is then one row per source (a key and
the words still to take at it), which joins the documents without moving their
texts.  A budget beyond a source's size first takes whole passes over it.

Targets: ``share`` times all words are dealt to the sources by weight; a target
stops at ``most`` times its source's size and the excess goes to the others by
weight until none is above.

Defined results: null and empty texts have size 0 and take 0 words; a null
source is a source of its own; rows that agree in id and text share one key and
split the words that are left at the cut evenly (rounded down); a source of
size 0 has target 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from daybook.llm.common import save

_WS = r"[\x20\x09-\x0D]"
_BLACK = r"[^\x20\x09-\x0D]"


def size_of(text: str = "text") -> Column:
    """Words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(_BLACK + "+")), F.lit(0)).cast("long")


def order_key(seed: str) -> Column:
    """60 hash-random bits of a document, the same in every run."""
    text = F.concat_ws("|", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def targets(sizes: DataFrame, share: tuple[int, int] = (3, 2), most: int = 2) -> DataFrame:
    """``sizes`` (source, weight, source_size) with ``target``.

    ``share`` is a fraction, so sums stay whole numbers until one division.
    Water-filling: a level per unit of weight rises from round to round as full
    sources leave; each round is one aggregate over the sources.
    """
    num, den = share
    total = sizes.agg(F.sum("source_size")).first()[0] or 0
    if not total:
        return sizes.withColumn("target", F.lit(0.0))
    if num > den * most:
        raise ValueError("the share asks for more than every source may give")
    cap = F.col("source_size") * most
    weights = sizes.agg(F.sum("weight")).first()[0]
    up, down = num * total, den * weights
    while True:
        # full: cap <= weight * level, with level = up / down
        full = sizes.filter(cap.cast("decimal(38,0)") * F.lit(down).cast("decimal(38,0)")
                            <= F.col("weight").cast("decimal(38,0)") * F.lit(up).cast("decimal(38,0)"))
        caps, used = full.agg(F.sum(cap), F.sum("weight")).first()
        left = den * (weights - (used or 0))
        if not left:
            return sizes.withColumn("target", cap.cast("double"))
        if (num * total - den * (caps or 0), left) == (up, down):
            break
        up, down = num * total - den * (caps or 0), left
    return sizes.withColumn("target", F.least(cap.cast("double"), (F.col("weight") * up).cast("double") / F.lit(float(down))))


def _cuts(rows: DataFrame, plan: DataFrame, per_range: int) -> DataFrame:
    """(source, passes, cut_key, cut_tie, cut_take): whole passes over a source,
    then rows before the cut in full and ``cut_take`` words of each row at it."""
    n = rows.count()
    ranges = max(256, 1 << max(0, (n // per_range - 1).bit_length()))
    at = F.shiftright("key", 60 - (ranges.bit_length() - 1))
    goal = plan.select(
        "source", F.when(F.col("source_size") > 0, F.floor(F.floor("target") / F.col("source_size"))).otherwise(0).cast("long").alias("passes"),
        "source_size", F.floor("target").cast("long").alias("budget"),
    ).withColumn("rest", F.col("budget") - F.col("passes") * F.col("source_size"))
    sums = rows.groupBy("source", at.alias("range")).agg(F.sum("size").alias("words"))
    w = W.partitionBy("source").orderBy("range")
    sums = sums.withColumn("before", F.sum("words").over(w) - F.col("words"))
    g, s = goal.alias("g"), sums.alias("s")
    hit = s.join(g, F.col("s.source").eqNullSafe(F.col("g.source"))).filter(
        (F.col("before") <= F.col("rest")) & (F.col("rest") < F.col("before") + F.col("words"))).select(
        F.col("s.source").alias("source"), "range", (F.col("rest") - F.col("before")).alias("rest"))
    hit = save(hit, "mix-ranges").alias("h")
    inside = rows.withColumn("range", at).alias("r").join(
        hit, F.col("r.source").eqNullSafe(F.col("h.source")) & (F.col("r.range") == F.col("h.range"))).select(
        "r.source", "key", "tie", "size", "rest")
    # rows with one key and text stand together
    units = inside.groupBy("source", "key", "tie", "rest").agg(F.sum("size").alias("words"), F.count("*").alias("n"))
    w = W.partitionBy("source").orderBy("key", "tie")
    units = units.withColumn("before", F.sum("words").over(w) - F.col("words")).filter(
        "before <= rest and rest < before + words").select(
        "source", F.col("key").alias("cut_key"), F.col("tie").alias("cut_tie"), F.expr("(rest - before) div n").alias("cut_take"))
    g, u = goal.alias("g"), units.alias("u")
    return save(g.join(u, F.col("g.source").eqNullSafe(F.col("u.source")), "left").select(
        F.col("g.source").alias("source"), "passes", "cut_key", "cut_tie", "cut_take"), "mix-cuts")


def weighted(rows: DataFrame, cycle: tuple[int, ...]) -> DataFrame:
    """(source, weight, source_size): weights of a repeating cycle over the
    sources in code-point order, a null source last.

    Ranks come from prefix sums over sorted partitions, so that no task holds
    all sources.
    """
    sizes = save(rows.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-sizes")
    parts = int(sizes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("source").isNull(), F.col("source")]
    sorted_ = save(sizes.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id()), "mix-sorted")
    counts = sorted_.groupBy("part").agg(F.count("*").alias("n"))
    base = counts.select("part", (F.sum("n").over(W.orderBy("part")) - F.col("n")).alias("base"))
    rank = F.col("base") + F.row_number().over(W.partitionBy("part").orderBy(*order)) - 1
    weight = F.element_at(F.array(*map(F.lit, cycle)), (rank % len(cycle) + 1).cast("int"))
    return save(sorted_.join(base, "part").select("source", weight.cast("long").alias("weight"), "source_size"), "mix-weights")


def narrow(docs: DataFrame, seed: str) -> DataFrame:
    """What the plan needs of a document, saved once: no texts."""
    return save(docs.select("doc_id", F.col("source").cast("string").alias("source"), size_of().alias("size"),
                            order_key(seed).alias("key"), F.md5(F.coalesce(F.col("text"), F.lit(""))).alias("tie")), "mix-rows")


def take_of(size: str) -> Column:
    """Words to take of a row joined with its source's cut."""
    before = (F.col("key") < F.col("cut_key")) | ((F.col("key") == F.col("cut_key")) & (F.col("tie") < F.col("cut_tie")))
    at = (F.col("key") == F.col("cut_key")) & (F.col("tie") == F.col("cut_tie"))
    return F.col("passes") * F.col(size) + F.when(before, F.col(size)).when(at, F.col("cut_take")).otherwise(F.lit(0))


def mix(docs: DataFrame, cycle: tuple[int, ...] = (3, 1, 2), share: tuple[int, int] = (3, 2), most: int = 2,
        seed: str = "mix", per_range: int = 100_000) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken) of each document."""
    rows = narrow(docs, seed)
    plan = save(targets(weighted(rows, cycle), share, most), "mix-plan")
    cuts = _cuts(rows, plan, per_range)
    p, c = plan.alias("p"), cuts.alias("c")
    both = p.join(c, F.col("p.source").eqNullSafe(F.col("c.source"))).select("p.*", "passes", "cut_key", "cut_tie", "cut_take").alias("b")
    r = rows.alias("r")
    out = r.join(both, F.col("r.source").eqNullSafe(F.col("b.source")))
    return out.select("r.doc_id", "r.source", "r.size", "b.source_size", "b.target", take_of("size").alias("taken"))


def mixed_documents(docs: DataFrame, cycle: tuple[int, ...] = (3, 1, 2), share: tuple[int, int] = (3, 2), most: int = 2,
                    seed: str = "mix", per_range: int = 100_000) -> DataFrame:
    """The mix itself: the rows of ``docs``, all columns, once for each whole
    time they are taken, and the one document per source at its cut shortened
    to its first words, spacing kept."""
    rows = narrow(docs, seed)
    plan = save(targets(weighted(rows, cycle), share, most), "mix-plan")
    cuts = _cuts(rows, plan, per_range)
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    wide = docs.select(own.alias("doc"), F.col("source").cast("string").alias("source"), F.col("text").alias("text"),
                       F.col("doc_id").alias("doc_id")).select(
        "doc", "source", "text", size_of().alias("size"), order_key(seed).alias("key"), F.md5(F.coalesce("text", F.lit(""))).alias("tie"))
    d, c = wide.alias("d"), cuts.alias("c")
    both = d.join(c, F.col("d.source").eqNullSafe(F.col("c.source")))
    taken = take_of("size")
    whole = F.when(F.col("size") > 0, F.floor(taken / F.col("size"))).otherwise(F.lit(0)).cast("int")
    # pieces of white space and one word each; joined again they are the text's beginning
    words = F.split("text", f"(?<={_BLACK})(?={_WS})")
    rest = (taken - whole * F.col("size")).cast("int")
    cut = F.array_join(F.slice(words, F.lit(1), rest), "")
    texts = F.concat(F.array_repeat(F.col("text"), whole), F.when(rest > 0, F.array(cut)).otherwise(F.array().cast("array<string>")))
    out = both.select("doc", F.explode(texts).alias("part"))
    return out.select(*[(F.col("part") if n == "text" else F.col("doc")[n]).alias(n) for n in docs.columns])
