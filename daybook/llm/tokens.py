"""Token ids as flat binary files with document offsets.

Format, one pair of files per shard in one folder:

* ``ids-NNNNN.bin``: the ids of the shard's documents one after another, as
  little-endian unsigned integers, 16 bits if the vocabulary allows, else 32;
* ``ids-NNNNN.idx``: little-endian 64-bit values: the number n of documents,
  n + 1 offsets (in ids, from the shard's begin), n document ids.

The table ``manifest`` beside them has a row per shard: its names, documents,
ids, width, and ``base``, the ids of all shards before it (prefix sums over the
shards).  Shards ascend in doc_id, and so do the documents inside.  Both files
can be memory-mapped; ``read_files`` does so where the folder is a local path and
else reads through the store's own client.

A shard is written under a name of its own attempt and then renamed, so a task
that runs twice leaves one whole file.

Defined results: a null or empty text has only the end id; rows with one doc_id
stand in the order of their texts' hashes; a null doc_id counts as the smallest and
comes back as null; no documents make no shard.
"""

from __future__ import annotations

import contextlib
import os
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from daybook.llm.common import doc_rows, map_arrow, real_id, save, scratch, slices
from daybook.llm.encoding import encoder, id_type


def encode(docs: DataFrame, tokenizer: str, end_id: int, dtype: str) -> DataFrame:
    """(doc_id, rk, ids, n_tokens): each document's ids with the end id, compressed
    for the way to its shard."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, end = encoder(tokenizer, dtype), np.array([end_id], dtype).tobytes()
        pack = zstandard.ZstdCompressor(3).compress
        for b in slices(batches):
            ids, ptr = enc.batch(b.column("text"))
            packed = [pack(ids[x:y].tobytes() + end) for x, y in zip(ptr[:-1].tolist(), ptr[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_pydict({"doc_id": b.column("doc_id"), "rk": b.column("rk"), "ids": pa.array(packed, pa.binary()),
                                              "n_tokens": np.diff(ptr) + 1})

    return map_arrow(doc_rows(docs), run, "doc_id long, rk long, ids binary, n_tokens long", memory="tokenizers")


def _store(folder: str):
    """The file system of a folder and the path in it."""
    from pyarrow import fs

    if "://" not in folder and not folder.startswith("file:"):
        return fs.LocalFileSystem(), folder
    if folder.startswith("file:"):
        return fs.LocalFileSystem(), "/" + folder[len("file:"):].lstrip("/")
    return fs.FileSystem.from_uri(folder)


def _put(store, path: str, chunks) -> None:
    tried = f"{path}.{uuid.uuid4().hex}"
    with store.open_output_stream(tried) as out:
        for c in chunks:
            out.write(c)
    with contextlib.suppress(FileNotFoundError, OSError):  # of an earlier attempt of the same task
        store.delete_file(path)
    store.move(tried, path)


def write_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 1,
                shard_ids: int = 8_000_000) -> DataFrame:
    """Write the files and return the manifest (shard, bin, idx, n_docs, n_ids,
    dtype, base)."""
    dtype = id_type(tokenizer, end_id)
    encoded = save(encode(docs, tokenizer, end_id, dtype), "encoded")
    total = encoded.agg(F.sum("n_tokens")).first()[0]
    shards = max(1, -(-(total or 0) // shard_ids))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        store, root = _store(folder)
        doc_ids, sizes = [], []
        unpack = zstandard.ZstdDecompressor().decompress

        def blobs():
            for b in batches:
                doc_ids.append(b.column("doc_id").to_numpy(zero_copy_only=False).astype("<i8"))
                sizes.append(b.column("n_tokens").to_numpy(zero_copy_only=False).astype("<i8"))
                for x in b.column("ids").to_pylist():
                    yield unpack(x)

        store.create_dir(root, recursive=True)
        name = f"ids-{shard:05d}"
        _put(store, f"{root}/{name}.bin", blobs())
        ids = np.concatenate([*doc_ids, np.zeros(0, "<i8")])
        offsets = np.concatenate([np.zeros(1, "<i8"), np.cumsum(np.concatenate([*sizes, np.zeros(0, "<i8")]))]).astype("<i8")
        _put(store, f"{root}/{name}.idx", [np.array([len(ids)], "<i8").tobytes(), offsets.tobytes(), ids.tobytes()])
        if len(ids):
            yield pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int64()), "bin": [f"{name}.bin"], "idx": [f"{name}.idx"],
                                              "n_docs": pa.array([len(ids)], pa.int64()), "n_ids": pa.array([int(offsets[-1])], pa.int64())})

    ordered = encoded.repartitionByRange(int(shards), "doc_id", "rk").sortWithinPartitions("doc_id", "rk")
    written = save(map_arrow(ordered.select("doc_id", "n_tokens", "ids"), run,
                             "shard long, bin string, idx string, n_docs long, n_ids long"), "shards")
    # a row per shard, which is bounded by shard_ids: their prefix sums fit one task
    base = F.coalesce(F.sum("n_ids").over(W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    manifest = written.select("*", F.lit(dtype).alias("dtype"), base.alias("base"))
    manifest.write.parquet(f"{folder}/manifest")
    return docs.sparkSession.read.schema(manifest.schema).parquet(f"{folder}/manifest")


def read_files(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, root = _store(folder)

        def values(name: str, dtype: str) -> np.ndarray:
            path = f"{root}/{name}"
            if isinstance(store, fs.LocalFileSystem):
                return np.memmap(path, dtype, "r") if os.path.getsize(path) else np.zeros(0, dtype)
            with store.open_input_file(path) as f:
                return np.frombuffer(f.read(), dtype)

        for b in batches:
            for r in b.to_pylist():
                ids, idx = values(r["bin"], r["dtype"]), values(r["idx"], "<i8")
                n = int(idx[0])
                off, doc = idx[1:n + 2], idx[n + 2:]
                for at in range(0, n, 4096):
                    to = min(n, at + 4096)
                    crc = [zlib.crc32(ids[off[i]:off[i + 1]].astype("<u4").tobytes()) for i in range(at, to)]
                    yield pa.RecordBatch.from_pydict({
                        "doc_id": np.array(doc[at:to]), "start": np.array(off[at:to]) + r["base"],
                        "n_tokens": np.diff(off[at:to + 1]), "ids_crc32": pa.array(crc, pa.int64())})

    manifest = spark.read.schema("shard long, bin string, idx string, n_docs long, n_ids long, dtype string, base long") \
        .parquet(f"{folder}/manifest")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    out = map_arrow(manifest.repartition(tasks, "shard"), run, "doc_id long, start long, n_tokens long, ids_crc32 long")
    return out.withColumn("doc_id", real_id())


def token_files(docs: DataFrame, tokenizer: str, end_id: int = 1, folder: str | None = None, **write) -> DataFrame:
    """Write the files of ``docs`` (to a scratch folder if none is given) and
    read them back."""
    spark = docs.sparkSession
    folder = folder or scratch(spark, "tokens")
    write_files(docs, folder, tokenizer, end_id, **write)
    return read_files(spark, folder)
