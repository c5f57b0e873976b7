"""One thin query for each operator: its whole table, production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm.common import real_id

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its views' scores, the combined score and the verdict."""
    from daybook.llm.quality import classify

    got = classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return got.select(real_id().alias("doc_id"), "p_text", "p_meta", "score", "keep")


def op2_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the words of windows that start earlier elsewhere."""
    from daybook.llm.substrings import remove_repeats

    got = remove_repeats(_table(spark, sf_dir, "documents"))
    return got.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


#: Fixed rules of the URL filter: (verdict, host, path).
URL_RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


def op3_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's host, path, fixed rule and verdict."""
    from daybook.llm.urlrules import judge

    return judge(_table(spark, sf_dir, "pages"), _table(spark, sf_dir, "labels"), URL_RULES)


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place and checksum, read back from the written files."""
    from daybook.llm.tokens import token_files

    return token_files(_table(spark, sf_dir, "documents"), tokenizer_path())


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the class of its near copies."""
    from daybook.llm.minhash import near_duplicates

    return near_duplicates(_table(spark, sf_dir, "documents"))


def op6_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its size and the words that the mix takes of it."""
    from daybook.llm.mixing import mix

    return mix(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op7_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that contain items of the benchmark, with the share covered."""
    from daybook.llm.tiling import contaminated

    return contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op8_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every licence notice found in the documents."""
    from daybook.llm.licences import licences

    return licences(_table(spark, sf_dir, "documents"))


def op9_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector with its links and the component that they make."""
    from daybook.llm.pivots import linked

    return linked(_table(spark, sf_dir, "embeddings"))


def op10_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without its often repeated long lines."""
    from daybook.llm.linedup import dedup_lines

    got = dedup_lines(_table(spark, sf_dir, "documents"))
    return got.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's periodic runs, their strongest one, and the text without repeats."""
    from daybook.llm.runs import find_runs, planted, strongest

    got = find_runs(planted(_table(spark, sf_dir, "documents")))
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return got.withColumn("top", strongest()).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "top.start", "top.length", "top.period",
        F.floor(F.lit(1000) * F.col("top.length") / F.col("top.period")).alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"), F.sha2("kept", 256).alias("collapsed_sha256"))


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of the documents with its place in a sequence."""
    from daybook.llm.packing import packed

    got = packed(_table(spark, sf_dir, "documents"), tokenizer_path())
    return got.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


def op13_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector; every seventh has the next label."""
    from daybook.llm.negatives import hard_negatives

    other = (F.col("label").cast("long") + 1) % 10
    rows = _table(spark, sf_dir, "embeddings").withColumn("label", F.when(F.col("vec_id") % 7 == 0, other).otherwise(F.col("label")))
    return hard_negatives(rows, F.col("vec_id") % 100 == 0)


def all_queries() -> dict[str, Query]:
    return {f.__name__: f for f in (
        op1_quality, op2_substrings, op3_url_rules, op4_token_files, op5_minhash, op6_mix, op7_tiling, op8_licences,
        op9_pivots, op10_lines, op11_runs, op12_packing, op13_negatives)}
