"""Writers: CSV with header, delimited text, plain text lines.

The jobs collect results into pandas on the driver and write one CSV there,
or ``coalesce(1)`` before writing one text file.  Both put the whole output
through one process.  Here every writer is a distributed DataFrameWriter:
each task writes its own part file; ordered output (data lines, then trailer)
comes from a global sort, which range-partitions the rows so that part files in
name order are in order.  ``single_file=True`` joins the part files to one by the
file system (``join_parts``), still without a task that sees all rows.
"""

from __future__ import annotations

import io
import re
from collections.abc import Iterator, Sequence
from csv import writer

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from daybook.operators.ordered import row_numbers
from daybook.session import Scope


def _file_system(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def part_files(spark: SparkSession, folder: str) -> list[tuple[str, int]]:
    """(path, bytes) of a written folder's part files, in the order of their tasks."""
    fs, p = _file_system(spark, folder)
    found = []
    for f in fs.listStatus(p):
        if m := re.match(r"part-(\d+)", f.getPath().getName()):
            found.append((int(m[1]), f.getPath().getName(), f.getPath().toString(), f.getLen()))
    return [(path, size) for _, _, path, size in sorted(found)]


def join_parts(spark: SparkSession, folder: str, target: str, first: bytes = b"", last: bytes = b"") -> None:
    """One file ``target`` of ``first``, the part files of ``folder`` in order, and ``last``.

    The driver handles names and sizes only.  On a file system that all executors
    mount, each part is copied by a task of its own to its byte offset (prefix sums of
    the sizes), so a task that runs again writes the same bytes; elsewhere the file
    system appends the parts itself (``concat``), and one that cannot says so.
    """
    parts = part_files(spark, folder)
    fs, p = _file_system(spark, target)
    if fs.getScheme() != "file":
        (bare := fs.create(p, True)).write(bytearray(first))
        bare.close()
        (tail := fs.create(end := p.suffix(".end"), True)).write(bytearray(last))
        tail.close()
        names = [spark._jvm.org.apache.hadoop.fs.Path(x) for x, size in parts if size] + ([end] if last else [])
        sources = spark._sc._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Path, len(names))
        for i, x in enumerate(names):
            sources[i] = x
        fs.concat(p, sources)
        return
    local = p.toUri().getPath()
    jobs, at = [], len(first)
    for path, size in parts:
        jobs.append((path.removeprefix("file:"), at, size))
        at += size
    with open(local, "wb") as out:
        out.write(first)
        out.truncate(at)
        out.seek(at)
        out.write(last)

    def copy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for x in b.to_pylist():
                with open(x["path"], "rb") as src, open(local, "r+b") as out:
                    out.seek(x["at"])
                    while chunk := src.read(1 << 22):
                        out.write(chunk)
            yield pa.RecordBatch.from_pydict({"n": pa.array([b.num_rows], pa.int64())})

    if jobs:
        rows = spark.createDataFrame(jobs, "path string, at long, size long").repartition(len(jobs))
        rows.mapInArrow(copy, "n long").collect()       # a number per part file


def _write_parts(df: DataFrame, path: str, single_file: bool, write, first: bytes = b"") -> None:
    """``write(df, folder)`` to ``path``, or to a folder of its own and then joined into
    ``path/part-00000``."""
    if not single_file:
        return write(df, path)
    spark = df.sparkSession
    with Scope(spark, "parts") as scope:
        folder = scope.new_path("parts")
        write(df, folder)
        fs, p = _file_system(spark, path)
        fs.delete(p, True)
        fs.mkdirs(p)
        join_parts(spark, folder, f"{path.rstrip('/')}/part-00000", first)


def _csv_line(names: Sequence[str], sep: str) -> bytes:
    out = io.StringIO()
    writer(out, delimiter=sep, lineterminator="\n").writerow(names)
    return out.getvalue().encode()


def write_csv(df: DataFrame, path: str, sep: str = ",", header: bool = True, order_by: Sequence[str] | None = None,
              single_file: bool = False, index: bool = False) -> None:
    """CSV part files (or one).  ``index``: a first column without a name holds the row
    numbers in ``order_by`` from 0 on, as a file written from a pandas frame has; an
    empty text is then written as nothing, as such a file has it, too."""
    spark = df.sparkSession

    def write(rows: DataFrame, folder: str) -> None:
        w = rows.write.mode("overwrite").option("header", header and not single_file).option("delimiter", sep)
        if index:           # the empty name of the index column stays empty
            w = w.option("emptyValue", "")
        w.option("quote", '"').option("escape", '"').csv(folder)

    def go(rows: DataFrame) -> None:
        _write_parts(rows, path, single_file, write, _csv_line(rows.columns, sep) if header else b"")

    if index:
        if not order_by:
            raise ValueError("an index needs an order")
        with Scope(spark, "csv-index") as scope:
            numbered = row_numbers(df, order_by, scope, "__index")
            go(numbered.orderBy("__index").withColumnRenamed("__index", ""))
    else:
        go(df.orderBy(*order_by) if order_by else df)


def write_text(df: DataFrame, path: str, column: str = "line",
               order_by: Sequence[str] | None = None, single_file: bool = False) -> None:
    """One line per row from the string column ``column``."""
    out = (df.orderBy(*order_by) if order_by else df).select(column)
    _write_parts(out, path, single_file, lambda rows, folder: rows.write.mode("overwrite").text(folder))
