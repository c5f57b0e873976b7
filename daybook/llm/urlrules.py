"""URL filter by association rules.

A URL is a set of tokens: its host's suffixes, the labels of its host and their
parts between hyphens (but for the last label, which is a suffix), its path segments
(digits as #), the ending of its last segment, the names in its query, and whether
it has a fragment.  Tokens that stand on exactly the same labelled pages are one
class: no rule can tell them apart, and FP-growth would enumerate all their subsets.
FP-growth over the bad pages' classes finds those that come together; how many
labelled pages have such a set, good ones included, is counted by a join.  Rules of
too few bad pages (one count at every size of input) or too low confidence, and rules
that a shorter one makes redundant, are pruned.  Matching is by inverted index: a rule
stands under its rarest class, so a URL meets only the rules of its own classes (it
has a class if it has a token of it), and is checked for their others.  URLs with one
token set are matched once.  A class is named by its smallest token.

Fixed rules (verdict, host, path) come first: one fits its host and all its
subdomains when the path starts with its path; the longest decides.

Defined results: a null URL or one without ``://`` has an empty host and path,
no tokens and no rule match, so it is allowed; repeated rows are judged each;
labels that contradict each other count as bad; without labels of both kinds
there are no mined rules.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import save

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BAD = "=bad"


def host_and_path(urls: DataFrame) -> DataFrame:
    """``urls`` with host, path and the query and fragment after them (``tail``)."""
    rest = F.expr("case when instr(url, '://') > 0 then substring(url, instr(url, '://') + 3) end")
    empty = F.lit("")
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _LOWER)
    return urls.withColumns({
        "host": F.coalesce(host, empty), "path": F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), empty),
        "tail": F.coalesce(F.regexp_extract(rest, r"^[^?#]*([\s\S]*)", 1), empty)})


def tokens() -> Column:
    """The sorted distinct tokens of (host, path, tail)."""
    labels = F.split("host", r"\.")
    hosts = F.transform(F.sequence(F.lit(1), F.size(labels)),
                        lambda i: F.concat(F.lit("h:"), F.array_join(F.slice(labels, -i, i), ".")))
    names_of = F.filter(F.slice(labels, 1, F.size(labels) - 1), lambda s: s != "")
    parts = F.filter(F.flatten(F.transform(names_of, lambda s: F.split(s, "-"))), lambda s: s != "")
    own = F.transform(F.concat(names_of, parts), lambda s: F.concat(F.lit("l:"), s))
    segments = F.filter(F.split("path", "/"), lambda s: s != "")
    steps = F.transform(segments, lambda s: F.concat(F.lit("p:"), F.regexp_replace(s, "[0-9]+", "#")))
    ending = F.regexp_extract("path", r"\.([A-Za-z0-9]{1,8})$", 1)
    query = F.regexp_extract("tail", r"^\?([^#]*)", 1)
    names = F.transform(F.filter(F.split(query, "&"), lambda s: s != ""),
                        lambda s: F.concat(F.lit("q:"), F.substring_index(s, "=", 1)))
    none = F.array().cast("array<string>")
    return F.array_sort(F.array_distinct(F.concat(
        F.when(F.col("host") != "", F.concat(hosts, own)).otherwise(none), steps, names,
        F.when(ending != "", F.array(F.concat(F.lit("e:"), ending))).otherwise(none),
        F.when(F.instr("tail", "#") > 0, F.array(F.lit("f:"))).otherwise(none))))


def fixed_verdict(rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest of a short list of fixed rules; null if none fits."""
    every = F.array(*[F.when(
        ((F.col("host") == h) | F.endswith("host", F.lit("." + h))) & F.startswith("path", F.lit(p)),
        F.struct(F.lit(len(h + p)).alias("length"), F.lit(h + p).alias("rule"), F.lit(v).alias("verdict"))) for v, h, p in rules])
    best = F.array_max(every)
    return best["rule"], best["verdict"]


def token_classes(sets: DataFrame) -> DataFrame:
    """(token, rep) of each token of (row, tokens): tokens of the same rows, told by their
    number and two 64-bit sums of the rows' hashes, share the smallest token."""
    marks = sets.select("row", F.explode("tokens").alias("token")).groupBy("token").agg(
        F.count("*").alias("n"), F.bit_xor(F.xxhash64("row", F.lit(1))).alias("a"), F.bit_xor(F.xxhash64("row", F.lit(2))).alias("b"))
    reps = marks.groupBy("n", "a", "b").agg(F.min("token").alias("rep"))
    return save(marks.join(reps, ["n", "a", "b"]).select("token", "rep"), "token-classes")


def with_classes(sets: DataFrame, classes: DataFrame, *key: str) -> DataFrame:
    """(key, classes) of each row of (key, tokens) that has a known token."""
    each = sets.select(*key, F.explode("tokens").alias("token")).join(classes, "token")
    return each.groupBy(*key).agg(F.array_sort(F.collect_set("rep")).alias("classes"))


def _under_rarest(rules: DataFrame, sets: DataFrame, *keep: str) -> DataFrame:
    """(keep, rep) of each rule: the class of ``items`` that fewest of the sets have."""
    common = sets.select(F.explode("classes").alias("rep")).groupBy("rep").agg(F.count("*").alias("n"))
    held = rules.select(*keep, F.explode("items").alias("rep")).join(common, "rep")
    return held.groupBy(*keep).agg(F.min(F.struct("n", "rep")).alias("rarest")).select(*keep, F.col("rarest.rep").alias("rep"))


def _met(index: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs of a rule of ``index`` and a set that has all its classes."""
    return sets.withColumn("rep", F.explode("classes")).join(index, "rep").filter(F.size(F.array_except("items", "classes")) == 0)


def mine(sets: DataFrame, min_confidence: float, min_count: int = 20) -> tuple[DataFrame, DataFrame]:
    """((rule_id, items, confidence, support), (token, rep)) from (tokens, bad) rows: the
    pruned rules over classes of tokens, and these classes.

    A rule has at least ``min_count`` bad rows however many rows there are: few
    labels make no rules of chance, and a rare host is judged alike in a large table.
    """
    spark = sets.sparkSession
    told = save(sets.withColumn("row", F.monotonically_increasing_id()), "labelled-sets")
    classes = token_classes(told)
    baskets = save(with_classes(told, classes, "row", "bad").groupBy("classes").agg(
        F.count("*").alias("n"), F.count_if("bad").alias("n_bad")), "baskets")
    size = told.agg(F.count("*").alias("n"), F.count_if("bad").alias("n_bad")).first()
    if size.n < min_count or size.n_bad < min_count:
        rules = spark.createDataFrame([], "items array<string>, confidence double, support double")
    else:
        # as many baskets as bad rows; a row per row, since FP-growth takes no weights
        bad = baskets.filter("n_bad > 0").select(F.explode(F.array_repeat("classes", F.col("n_bad").cast("int"))).alias("items"))
        bad = save(bad, "bad-baskets")
        model = FPGrowth(itemsCol="items", minSupport=(min_count - 0.5) / bad.count(), minConfidence=1.0,
                         numPartitions=int(spark.conf.get("spark.sql.shuffle.partitions"))).fit(bad)
        found = save(model.freqItemsets.select(F.array_sort("items").alias("items"), F.col("freq").alias("n_bad")), "bad-sets")
        total = _met(_under_rarest(found, baskets, "items", "n_bad"), baskets.select("classes", "n")).groupBy("items", "n_bad").agg(
            F.sum("n").alias("n"))
        rules = total.select("items", (F.col("n_bad") / F.col("n")).alias("confidence"), (F.col("n_bad") / size.n).alias("support")).filter(
            F.col("confidence") >= min_confidence)
    rules = save(rules.withColumn("rule_id", F.xxhash64("items")), "rules")
    # redundant: a rule with one token less is as sure (found by its token set, no all-pairs join)
    shorter = rules.select("rule_id", "confidence", F.explode("items").alias("token"), "items").select(
        "rule_id", "confidence", F.array_remove("items", F.col("token")).alias("less"))
    general = rules.select(F.col("items").alias("less"), F.col("confidence").alias("sure"))
    idle = shorter.join(general, "less").filter("sure >= confidence").select("rule_id").distinct()
    return save(rules.join(idle, "rule_id", "left_anti"), "pruned-rules"), classes


def judge(pages: DataFrame, labels: DataFrame, fixed: list[tuple[str, str, str]],
          min_confidence: float = 0.6, min_count: int = 20) -> DataFrame:
    """(page_id, host, path, rule, verdict, mined_rule, confidence) of each page."""
    urls = host_and_path(pages.select("page_id", F.col("url").cast("string").alias("url"))).withColumn("tokens", tokens())
    bad = F.max((F.col("quality") == 0) | (F.col("toxic") > 0))
    told = labels.groupBy(F.col("doc_id").alias("page_id")).agg(bad.alias("bad")).filter("bad is not null")
    rules, classes = mine(urls.join(told, "page_id").select("tokens", "bad"), min_confidence, min_count)
    sets = save(with_classes(urls.select("tokens").distinct(), classes, "tokens"), "token-sets")
    index = save(_under_rarest(rules, sets, "rule_id", "items", "confidence"), "rule-index")
    best = save(_met(index, sets).groupBy("tokens").agg(F.max(F.struct("confidence", "items")).alias("best")), "matched-sets")
    rule, verdict = fixed_verdict(fixed)
    out = urls.join(best, "tokens", "left")
    return out.select("page_id", "host", "path", rule.alias("rule"),
                      F.coalesce(verdict, F.when(F.col("best").isNotNull(), "block").otherwise("allow")).alias("verdict"),
                      F.array_join("best.items", " ").alias("mined_rule"), F.col("best.confidence").alias("confidence"))
