"""Line dedup over levelled sorted runs.

A run is a table of line keys, bucketed and sorted by their 128-bit hash, with
the documents that hold each (``n``) and the largest of their ids (``top``).
Batches of documents come in descending id.  Each new batch is counted, merge
anti-joined with the keys that the runs have already settled (``n`` has reached
``least_docs``; ``top`` is final, as later ids are smaller), and what is left
becomes a run of level 0.  ``fanout`` runs of a level are compacted into one of
the next.  All runs merged at the end tell the keys that documents lose.

A key is the line stripped of the six ASCII white-space characters, A-Z in lower
case.  Keys of at least ``least_chars`` code points found in at least
``least_docs`` documents lose all lines but those of the largest doc_id.

Defined results: a null or empty text is one empty line; rows with one doc_id
count as one document but give a row each; a null doc_id counts as the
smallest and comes back as null.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm.common import delete, doc_rows, id_key, map_arrow, parts_for, real_id, save, scratch, slices

_BLANK = b" \t\n\x0b\x0c\r"


def _key(line: bytes) -> bytes:
    return line.strip(_BLANK).lower()  # bytes.lower folds A-Z only


def _print(key: bytes, least_chars: int) -> bytes | None:
    """The key's 128-bit hash; None for a short one."""
    if len(key) < least_chars or (not key.isascii() and len(key.decode()) < least_chars):
        return None
    return hashlib.blake2b(key, digest_size=16).digest()


def _long(b: bytes) -> int:
    return int.from_bytes(b, "little", signed=True)


def line_keys(rows: DataFrame, least_chars: int) -> DataFrame:
    """(doc_id, h1, h2) of each document's distinct long lines."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            ids, one, two = [], [], []
            for doc, text in zip(b.column("doc_id").to_pylist(), b.column("text").cast(pa.binary()).to_pylist(), strict=True):
                found = {_print(_key(line), least_chars) for line in text.split(b"\n") if len(line) >= least_chars}
                found.discard(None)
                ids += [doc] * len(found)
                one += [_long(h[:8]) for h in found]
                two += [_long(h[8:]) for h in found]
            yield pa.RecordBatch.from_pydict({k: pa.array(v, pa.int64()) for k, v in (("doc_id", ids), ("h1", one), ("h2", two))})

    return map_arrow(rows, run, "doc_id long, h1 long, h2 long")


class LineRuns:
    """The levelled runs; ``add`` takes one batch of (doc_id, h1, h2), whose ids
    are all below those added before."""

    def __init__(self, spark: SparkSession, buckets: int, least_docs: int = 5, fanout: int = 4):
        self.spark, self.buckets, self.least_docs, self.fanout = spark, buckets, least_docs, fanout
        self.levels: list[list[str]] = []
        self.paths: dict[str, str] = {}

    def _write(self, run: DataFrame, level: int) -> None:
        name = f"line_run_{uuid.uuid4().hex}"
        self.paths[name] = scratch(self.spark, name)
        (run.write.option("path", self.paths[name]).bucketBy(self.buckets, "h1", "h2").sortBy("h1", "h2")
            .format("parquet").saveAsTable(name))
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(name)

    def _merged(self, names: list[str]) -> DataFrame:
        # read as plain files: Spark 4.1 takes a union of bucketed tables for bucketed and
        # then leaves out the exchange that its groups need
        every = [self.spark.read.schema("h1 long, h2 long, n long, top long").parquet(self.paths[n]) for n in names]
        merged = reduce(DataFrame.union, every).groupBy("h1", "h2").agg(F.sum("n").alias("n"), F.max("top").alias("top"))
        return merged.repartition(self.buckets, "h1", "h2")

    def _drop(self, names: list[str]) -> None:
        for n in names:
            self.spark.sql(f"drop table {n}")
            delete(self.spark, self.paths.pop(n))

    def add(self, keys: DataFrame) -> None:
        once = keys.groupBy("h1", "h2", "doc_id").agg(F.lit(1).alias("one"))
        new = once.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.max("doc_id").alias("top"))
        new = new.repartition(self.buckets, "h1", "h2")
        for name in (n for level in self.levels for n in level):
            settled = self.spark.table(name).filter(F.col("n") >= self.least_docs)
            new = new.hint("merge").join(settled.select("h1", "h2").hint("merge"), ["h1", "h2"], "left_anti")
        self._write(new, 0)
        for level, names in enumerate(self.levels):
            if len(names) >= self.fanout:
                old = list(names)
                self._write(self._merged(old), level + 1)
                names.clear()
                self._drop(old)

    def frequent(self) -> DataFrame:
        """(h1, h2, top) of the keys in at least ``least_docs`` documents; ends the runs."""
        names = [n for level in self.levels for n in level]
        if not names:
            return self.spark.createDataFrame([], "h1 long, h2 long, top long")
        out = save(self._merged(names).filter(F.col("n") >= self.least_docs).select("h1", "h2", "top"), "frequent-lines")
        self._drop(names)
        self.levels = []
        return out


def dedup_lines(docs: DataFrame, least_chars: int = 40, least_docs: int = 5, batches: int = 6, fanout: int = 4,
                bucket_bytes: int = 64 << 20) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept) of each row of ``docs``; ``kept`` is the text that stays."""
    spark = docs.sparkSession
    rows = doc_rows(docs).select("doc_id", "text")
    shares = [i / batches for i in range(1, batches)]
    cuts = docs.agg(F.percentile_approx(id_key(), shares, 10_000)).first()[0] or []
    # batch 0 has the largest ids
    batch = reduce(lambda a, b: a + b, [(F.col("doc_id") < int(c)).cast("int") for c in cuts], F.lit(0))
    keys = save(line_keys(rows, least_chars).withColumn("batch", batch), "line-keys", "batch")
    runs = LineRuns(spark, parts_for(docs, bucket_bytes), least_docs, fanout)
    for i in range(len(cuts) + 1):
        runs.add(keys.filter(F.col("batch") == i).drop("batch"))
    lost = keys.join(runs.frequent(), ["h1", "h2"]).filter("doc_id <> top").select("doc_id", "h1", "h2")
    lost = lost.groupBy("doc_id").agg(F.collect_set(F.struct("h1", "h2")).alias("lost"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            n_lines, n_dropped, kept = [], [], []
            for text, lost in zip(b.column("text").cast(pa.binary()).to_pylist(), b.column("lost").to_pylist(), strict=True):
                lines = text.split(b"\n")
                stay = lines
                if lost:
                    gone = {r["h1"].to_bytes(8, "little", signed=True) + r["h2"].to_bytes(8, "little", signed=True) for r in lost}
                    stay = [x for x in lines if _print(_key(x), least_chars) not in gone]
                n_lines.append(len(lines))
                n_dropped.append(len(lines) - len(stay))
                kept.append(text if stay is lines else b"\n".join(stay))
            yield pa.RecordBatch.from_pydict({"doc_id": b.column("doc_id"), "n_lines": pa.array(n_lines, pa.int64()),
                                              "n_dropped": pa.array(n_dropped, pa.int64()), "kept": pa.array(kept, pa.binary()).cast(pa.string())})

    out = map_arrow(rows.join(lost, "doc_id", "left"), run, "doc_id long, n_lines long, n_dropped long, kept string")
    return out.withColumn("doc_id", real_id())
