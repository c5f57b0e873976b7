"""A training corpus from `documents`: five stages, each an operator of ``daybook.llm``.

Every stage is a function (spark, docs, sf_dir) -> DataFrame over what the one
before it kept; all but the last return the columns of `documents`.  ``run``
applies them in order and writes each result as a table in the shared folder.

SQL cannot express the classifier, the sketches or the tokenizer, so there is
no ``ORACLE_SQL``; ``tests/llm`` hold the stages against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from daybook.llm.common import save
from daybook.llm.minhash import one_of_each
from daybook.llm.mixing import mixed_documents
from daybook.llm.quality import keep_good
from daybook.llm.queries import tokenizer_path
from daybook.llm.tiling import without_contaminated
from daybook.llm.tokens import token_files

ORACLE_SQL: str | None = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier does not reject."""
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest doc_id of each class of near copies."""
    return one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: sources in code-point order weigh 3, 1, 2, repeating; 150 % of
    all words, no source more than twice."""
    return mixed_documents(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' places in the written token files, read back from them."""
    return token_files(docs, tokenizer_path())


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("decontaminate", decontaminate),
          ("mix_sources", mix_sources), ("token_output", token_output)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = save(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
