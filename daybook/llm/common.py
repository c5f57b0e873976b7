"""Helpers shared by the operators: saved tables, document rows, batch slicing."""

from __future__ import annotations

import contextlib
import ctypes
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.session import program_scope

#: Words of a text: maximal runs of anything but these six ASCII characters.
WORD = r"[^\x20\x09-\x0D]+"
LONG_MIN = -(1 << 63)
BATCH_ROWS = 1000


def delete(spark: SparkSession, path: str) -> None:
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(p, True)


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder in the shared folder; the file system deletes it when the
    program ends, also after ``spark.stop()``."""
    return program_scope(spark).new_path(f"llm-{name}")


def save(df: DataFrame, name: str, *by: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: cuts the
    lineage, survives lost executors, and gives the planner true sizes."""
    spark = df.sparkSession
    path = scratch(spark, name)
    w = df.write
    (w.partitionBy(*by) if by else w).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_shipped: set[str] = set()
_remembered: dict[str, dict] = {}


def remembered(name: str) -> dict:
    """What a worker keeps between tasks under a name."""
    return _remembered.setdefault(name, {})


def forget(but: str | None) -> None:
    """Drop what a worker keeps under other names."""
    for name, kept in _remembered.items():
        if name != but:
            kept.clear()


def map_arrow(df: DataFrame, run: Callable, schema: str, memory: str | None = None) -> DataFrame:
    """``df.mapInArrow`` with this package sent to the executors first (once per
    application), so that they need no installation of it.

    Memory: batches hold ``BATCH_ROWS`` rows unless the session says otherwise,
    and a worker gives back what it has freed when a task ends.  Between tasks it
    keeps only what ``remembered`` has under ``memory``.
    """
    conf = df.sparkSession.conf
    if conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":  # Spark's default
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))

    def tidy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from daybook.llm.common import forget  # the worker's own module, not a copy

        forget(memory)
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):  # not every C library can
            ctypes.CDLL(None).malloc_trim(0)

    sc = df.sparkSession.sparkContext
    if sc.applicationId not in _shipped:
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        path = os.path.join(tempfile.mkdtemp(prefix="daybook-py-"), "daybook.zip")
        with zipfile.ZipFile(path, "w") as z:
            for folder, _, names in os.walk(package):
                for name in names:
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        z.write(full, os.path.relpath(full, os.path.dirname(package)))
        sc.addPyFile(path)
        _shipped.add(sc.applicationId)
    return df.mapInArrow(tidy, schema)


def id_key(col: str = "doc_id") -> Column:
    """A document id that joins and sorts: a null id counts as the smallest."""
    return F.coalesce(F.col(col).cast("long"), F.lit(LONG_MIN))


def doc_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, text, rk): null texts as empty; ``rk`` tells rows apart that
    share an id but not a text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(id_key().alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("rk"))


def real_id(col: str = "doc_id") -> Column:
    """Back from ``id_key``: the smallest long means null."""
    return F.when(F.col(col) == F.lit(LONG_MIN), F.lit(None).cast("long")).otherwise(F.col(col))


def parts_for(df: DataFrame, part_bytes: int, least: int = 8) -> int:
    """How many partitions of ``part_bytes`` of input files ``df`` is read from;
    the session's shuffle partitions where the planner knows no size."""
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    size = sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    if size >= 1 << 60:  # the planner's stand-in for an unknown size
        return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, size // part_bytes)


def slices(batches: Iterator[pa.RecordBatch], text: str = "text",
           limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Batches cut so that each holds about ``limit`` bytes of text (one text
    at least, 4096 at most), which bounds what numpy makes of it."""
    for batch in batches:
        n, col = batch.num_rows, batch.column(batch.schema.get_field_index(text))
        if n == 0:
            continue
        width = 8 if pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type) else 4
        off = np.frombuffer(col.buffers()[1], f"<i{width}")[col.offset:col.offset + n + 1]
        at = 0
        while at < n:
            to = int(np.searchsorted(off, off[at] + limit, "right")) - 1
            to = min(n, at + 4096, max(at + 1, to))
            yield batch.slice(at, to - at)
            at = to
