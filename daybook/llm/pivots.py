"""Embedding near-dedup by a pivot-permutation index.

A vector is described by its ``nearest`` reference points (pivots), in order.
The index has an inverted list for each pair of pivots, per label and dimension:
a vector is in the lists of all pairs of its pivots, so two vectors meet if and
only if they share two pivots or more.  In a list all vectors are compared by
cosine in double precision; a pair counts in the first list that both are in.
Lists beyond ``block`` vectors are cut into blocks, and every pair of blocks is a
cell of its own, so no cell has more than 2 x ``block`` vectors.  Of a cell
only link counts and a spanning set of links are returned, no pairs.

The pivots are a bounded sample: up to ``pivots`` vectors in hash order, of which
none is within ``apart`` (cosine) of another, so that a dense cluster owns few of
them and its members, whose other pivots lie far off, name the same ones.  Every
vector is indexed.  Vectors equal in label and bits are one entry with a multiplicity.

Defined results: vectors that are null, zero, hold a null or non-finite component
or have a null label link with nothing; so do rows with a null vec_id, whose
component is null and which are kept.  Vectors of different length do not link.
Repeated rows are vectors of their own.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import map_arrow, save
from daybook.llm.components import components


def _packed(rows: DataFrame) -> DataFrame:
    """(vec_id, label, dim, v): little-endian doubles of the vectors that may link."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            col = b.column("embedding")
            off = np.asarray(col.offsets)
            flat = col.values.to_numpy(zero_copy_only=False).astype("<f8")  # a null becomes NaN
            out, keep = [], []
            for i in range(len(col)):
                v = flat[off[i]:off[i + 1]]
                if col[i].is_valid and len(v) and np.isfinite(v).all() and np.any(v != 0):
                    keep.append(i)
                    out.append(v)
            at = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_pydict({"vec_id": b.column("vec_id").take(at), "label": b.column("label").take(at),
                                              "dim": pa.array([len(v) for v in out], pa.int32()),
                                              "v": pa.array([v.tobytes() for v in out], pa.binary())})

    kind = rows.schema["label"].dataType.simpleString()
    return map_arrow(rows, run, f"vec_id long, label {kind}, dim int, v binary")


def _unit(v: np.ndarray) -> np.ndarray:
    v = v / np.abs(v).max(1, keepdims=True)  # keeps very small and very large vectors exact enough
    return v / np.sqrt((v * v).sum(1, keepdims=True))


def _rows_of(col: pa.Array, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(col.to_pylist()), "<f8").reshape(-1, dim)


def _spread(candidates: np.ndarray, most: int, apart: float) -> np.ndarray:
    """The first ``most`` unit vectors that are not within ``apart`` of one taken before."""
    taken = np.zeros((0, candidates.shape[1]))
    for v in candidates:
        if len(taken) < most and not (taken @ v >= apart).any():
            taken = np.vstack([taken, v])
    return taken


def _postings(vectors: DataFrame, pivots: dict[int, np.ndarray], nearest: int) -> DataFrame:
    """A row for each vector and each pair of its nearest pivots; its pivots in
    ascending order go along.  A dimension with fewer than two pivots has one list."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dims = b.column("dim").to_numpy()
            for dim in np.unique(dims):
                own = b.filter(pa.array(dims == dim))
                p = pivots.get(int(dim))
                n = own.num_rows
                if p is None or len(p) < 2:
                    near = np.tile(np.array([0, 1]), (n, 1))
                else:
                    near = np.sort(np.argsort(-(_unit(_rows_of(own.column("v"), dim)) @ p.T), 1, kind="stable")[:, :nearest], 1)
                pairs = list(combinations(range(near.shape[1]), 2))
                at = pa.array(np.repeat(np.arange(n), len(pairs)))
                key = np.stack([near[:, i] * (1 << 20) + near[:, j] for i, j in pairs], 1).reshape(-1)
                out = {c: own.column(c).take(at) for c in ("rep", "label", "dim", "n", "v")}
                out["pair"] = pa.array(key.astype(np.int64))
                out["near"] = pa.array([x.tobytes() for x in near.astype("<i4")], pa.binary()).take(at)
                for i in range(0, len(at), 4096):
                    yield pa.RecordBatch.from_pydict(out).slice(i, 4096)

    kind = vectors.schema["label"].dataType.simpleString()
    return map_arrow(vectors, run, f"rep long, label {kind}, dim int, n long, v binary, pair long, near binary")


def _cell(rows: list[tuple], least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rep, links to add, smallest rep reached) of the linked vectors of a cell."""
    rep = np.array([r[0] for r in rows])
    n = np.array([r[1] for r in rows])
    v = _unit(np.stack([np.frombuffer(r[2], "<f8") for r in rows]))
    near = np.stack([np.frombuffer(r[3], "<i4") for r in rows])
    pair, side_i, side_j = rows[0][4], np.array([r[5] for r in rows]), np.array([r[6] for r in rows])
    links, root = np.zeros(len(rep), np.int64), np.arange(len(rep))
    found = []
    for a in range(0, len(rep), 512):
        i, j = np.nonzero(v[a:a + 512] @ v.T >= least)
        i = i + a
        ok = i < j
        # a pair of blocks compares across them; a block with itself, all
        ok &= (side_i[i] & side_j[j]) | (side_j[i] & side_i[j])
        i, j = i[ok], j[ok]
        for c in range(0, len(i), 1 << 16):
            x, y = i[c:c + (1 << 16)], j[c:c + (1 << 16)]
            both = (near[x][:, :, None] == near[y][:, None, :]).any(2)
            rank = np.cumsum(both, 1)
            low = np.where(both & (rank == 1), near[x], 0).sum(1) * (1 << 20) + np.where(both & (rank == 2), near[x], 0).sum(1)
            mine = low == pair
            found.append(np.stack([x[mine], y[mine]]))
    if not found:
        return rep[:0], links[:0], rep[:0]
    x, y = np.concatenate(found, 1)
    np.add.at(links, x, n[y])
    np.add.at(links, y, n[x])
    order = np.argsort(rep, kind="stable")
    place = np.empty(len(rep), np.int64)
    place[order] = np.arange(len(rep))
    root = place.copy()
    while True:
        before = root.copy()
        np.minimum.at(root, x, root[y])
        np.minimum.at(root, y, root[x])
        if (root == before).all():
            break
    hit = links > 0
    return rep[hit], links[hit], rep[order][root[hit]]


def linked(embeddings: DataFrame, least: float = 0.93, pivots: int = 128, nearest: int = 8, block: int = 1024,
           apart: float = 0.9) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of each row."""
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"), "label")
    packed = save(_packed(rows.filter("vec_id is not null and label is not null")).withColumn("h", F.unhex(F.md5("v"))), "vectors")
    reps = save(packed.groupBy("label", "dim", "h").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n")), "vector-copies")
    vectors = save(packed.join(reps.withColumn("vec_id", F.col("rep")), ["label", "dim", "h", "vec_id"])
                   .dropDuplicates(["label", "dim", "h"]).select("rep", "label", "dim", "n", "v"), "vector-reps")
    sample: dict[int, list[bytes]] = {}
    for r in vectors.orderBy(F.xxhash64("rep"), "rep").limit(16 * pivots).collect():
        sample.setdefault(r.dim, []).append(bytes(r.v))
    points = {d: _spread(_unit(np.frombuffer(b"".join(x), "<f8").reshape(-1, d)), pivots, apart) for d, x in sample.items()}
    posts = save(_postings(vectors, points, nearest), "postings")
    lists = save(posts.groupBy("label", "dim", "pair").agg(F.count("*").alias("size")).filter("size > 1"), "lists")
    blocks = F.ceil(F.col("size") / block).cast("int")
    own = F.pmod(F.xxhash64("rep"), blocks).cast("int")
    cells = F.transform(F.sequence(F.lit(0), blocks - 1),
                        lambda o: F.struct(F.least(own, o).alias("i"), F.greatest(own, o).alias("j")))
    dealt = posts.join(lists, ["label", "dim", "pair"]).withColumn("own", own).withColumn("cell", F.explode(cells)).select(
        "label", "dim", "pair", F.col("cell.i").alias("i"), F.col("cell.j").alias("j"), "rep", "n", "v", "near",
        (F.col("own") == F.col("cell.i")).alias("left"), (F.col("own") == F.col("cell.j")).alias("right"))
    group = ["label", "dim", "pair", "i", "j"]
    parts = int(embeddings.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, own = None, []

        def done() -> pa.RecordBatch:
            rep, links, root = _cell(own, least) if len(own) > 1 else (np.zeros(0, np.int64),) * 3
            return pa.RecordBatch.from_pydict({"rep": rep, "links": links, "root": root})

        for b in batches:
            cols = [b.column(c).to_pylist() for c in (*group, "rep", "n", "v", "near", "left", "right")]
            for r in zip(*cols, strict=True):
                if r[:5] != key:
                    if own:
                        yield done()
                    key, own = r[:5], []
                own.append((r[5], r[6], r[7], r[8], r[2], r[9], r[10]))
        if own:
            yield done()

    met = save(map_arrow(dealt.repartition(parts, *group).sortWithinPartitions(*group), run, "rep long, links long, root long"), "cells")
    links = met.groupBy("rep").agg(F.sum("links").alias("links"))
    roots = components(met.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    known = save(reps.join(links, "rep", "left").join(roots.withColumnRenamed("id", "rep"), "rep", "left").select(
        F.col("label").alias("l"), F.col("dim").alias("d"), F.col("h").alias("k"),
        (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("root", "rep").alias("component_id")), "vector-links")
    able = packed.join(known, (packed.label == known.l) & (packed.dim == known.d) & (packed.h == known.k)).select(
        "vec_id", "n_links", "component_id")
    # rows that cannot link: told by the same rule, without leaving the JVM
    bad = F.col("embedding").isNull() | F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) \
        | ~F.exists(F.coalesce("embedding", F.array().cast("array<double>")), lambda x: x != 0)
    alone = rows.filter(F.col("vec_id").isNull() | F.col("label").isNull() | F.coalesce(bad, F.lit(True)))
    out = able.union(alone.select("vec_id", F.lit(0).cast("long"), "vec_id"))
    return out.select("vec_id", "n_links", "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)).alias("kept"))
