"""Packing documents into sequences: hierarchical residual best fit.

Leaves: each task encodes its documents, cuts those longer than ``capacity``
tokens and packs the pieces by best fit, longest first, a block of ``block_tokens``
tokens at a time.  Nearly full bins are emitted: they are sequences.  The underfull
ones become items, each as long as it is full, and climb a tree: every round deals
the items over an eighth as many nodes, which pack them by best fit in blocks of
``block_items``; nearly full bins leave again.  At the root, or when a round of the
fewest nodes that the items need saves under one per cent, what is left is emitted.
Only the items (two numbers each) travel; the ids stay where the leaf wrote them.

Defined results: a null or empty text is one piece that holds the end id; a null
doc_id stays null; repeated rows are pieces of their own; no documents, no rows;
other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import map_arrow, save, slices
from daybook.llm.encoding import encoder, id_type

#: Bits of a bin's number below its leaf.
_LEAF = 36


def best_fit(sizes: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """The bin and the place in it of each size: longest first, into the fullest
    bin that has room."""
    bins, places = [0] * len(sizes), [0] * len(sizes)
    with_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, made = 0, 0  # bit r: some bin has room r
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        size = sizes[i]
        fits = rooms >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            own = with_room[room].pop()
            if not with_room[room]:
                rooms ^= 1 << room
        else:
            own, room, made = made, capacity, made + 1
        bins[i], places[i] = own, capacity - room
        if room > size:
            with_room[room - size].append(own)
            rooms |= 1 << (room - size)
    return bins, places


def _leaves(docs: DataFrame, tokenizer: str, end_id: int, capacity: int, block_tokens: int) -> DataFrame:
    """(doc_id, piece, start, length, ids, bin, at): ids packed for the disk."""
    dtype = id_type(tokenizer, end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, end = encoder(tokenizer, dtype), np.array([end_id], dtype)
        pack, leaf, made = zstandard.ZstdCompressor(1).compress, TaskContext.get().partitionId() << _LEAF, 0
        held: list[tuple] = []
        tokens = 0

        def emit() -> Iterator[pa.RecordBatch]:
            nonlocal held, tokens, made
            bins, at = best_fit([x[3] for x in held], capacity)
            cols = list(zip(*held, strict=True))
            out = pa.RecordBatch.from_pydict({
                "doc_id": pa.array(cols[0], pa.int64()), "piece": pa.array(cols[1], pa.int32()),
                "start": pa.array(cols[2], pa.int64()), "length": pa.array(cols[3], pa.int64()),
                "ids": pa.array(cols[4], pa.binary()), "bin": np.array(bins, np.int64) + (leaf + made),
                "at": pa.array(at, pa.int64())})
            made += max(bins) + 1
            held, tokens = [], 0
            for i in range(0, out.num_rows, 1000):
                yield out.slice(i, 1000)

        for b in slices(batches):
            ids, ptr = enc.batch(b.column("text"))
            for doc, x, y in zip(b.column("doc_id").to_pylist(), ptr[:-1].tolist(), ptr[1:].tolist(), strict=True):
                own = np.concatenate([ids[x:y], end])
                for piece, start in enumerate(range(0, len(own), capacity)):
                    part = own[start:start + capacity]
                    held.append((doc, piece, start, len(part), pack(part.tobytes())))
                    tokens += len(part)
                if tokens >= block_tokens:
                    yield from emit()
        if held:
            yield from emit()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return map_arrow(rows, run, "doc_id long, piece int, start long, length long, ids binary, bin long, at long", memory="tokenizers")


def _round(items: DataFrame, nodes: int, turn: int, capacity: int, block_items: int) -> DataFrame:
    """(bin, into, at, fill) of each item (bin, fill): packed by best fit at its node.
    A new bin has the number of the first item in it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed(bins: list[int], fills: list[int]) -> pa.RecordBatch:
            own, at = best_fit(fills, capacity)
            head = {b: bins[i] for i, b in enumerate(own) if at[i] == 0}
            return pa.RecordBatch.from_pydict({"bin": pa.array(bins, pa.int64()), "into": pa.array([head[b] for b in own], pa.int64()),
                                               "at": pa.array(at, pa.int64()), "fill": pa.array(fills, pa.int64())})

        bins, fills = [], []
        for b in batches:
            bins += b.column("bin").to_pylist()
            fills += b.column("fill").to_pylist()
            while len(bins) >= block_items:
                yield packed(bins[:block_items], fills[:block_items])
                bins, fills = bins[block_items:], fills[block_items:]
        if bins:
            yield packed(bins, fills)

    order = F.xxhash64("bin", F.lit(turn))
    dealt = items.withColumn("node", F.pmod(order, F.lit(nodes))).repartition(nodes, "node").sortWithinPartitions(order, "bin")
    return save(map_arrow(dealt.select("bin", "fill"), run, "bin long, into long, at long, fill long"), f"packing-round-{turn}")


def _climb(items: DataFrame, leaves: int, capacity: int, full: int, block_items: int) -> DataFrame | None:
    """(bin, sequence, shift) of the underfull bins (bin, fill): where each ends up."""
    items = save(items.filter(F.col("fill") < full), "packing-items")
    left, nodes, turn, where = items.count(), leaves, 0, None
    while left:
        turn, fewest = turn + 1, -(-left // block_items)
        nodes = max(-(-nodes // 8), fewest)
        got = _round(items, nodes, turn, capacity, block_items)
        if where is None:
            where = got.select("bin", F.col("into").alias("sequence"), F.col("at").alias("shift"))
        else:
            step = got.select(F.col("bin").alias("sequence"), "into", F.col("at").alias("more"))
            where = save(where.join(step, "sequence", "left").select(
                "bin", F.coalesce("into", "sequence").alias("sequence"), (F.col("shift") + F.coalesce("more", F.lit(0))).alias("shift")),
                "packing-places")
        merged = got.groupBy(F.col("into").alias("bin")).agg(F.sum("fill").alias("fill"))
        items = save(merged.filter(F.col("fill") < full), "packing-items")
        now = items.count()
        if nodes == 1 or (nodes == fewest and now > 0.99 * left):
            break
        left = now
    return where


def packed(docs: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = 4096, nearly: float = 0.998,
           block_tokens: int = 4_000_000, block_items: int = 65_536) -> DataFrame:
    """(doc_id, piece, start, length, ids, sequence_id, offset) of each piece: ``ids``
    are little-endian unsigned 32-bit integers; ``start`` counts the document's ids
    before the piece, ``offset`` the sequence's."""
    dtype = id_type(tokenizer, end_id)
    pieces = save(_leaves(docs, tokenizer, end_id, capacity, block_tokens), "packing-pieces")
    bins = pieces.groupBy("bin").agg(F.sum("length").alias("fill"))
    where = _climb(bins, pieces.rdd.getNumPartitions(), capacity, max(1, round(nearly * capacity)), block_items)
    if where is None:
        placed = pieces.select("*", F.col("bin").alias("sequence"), F.lit(0).alias("shift"))
    else:
        placed = pieces.join(where, "bin", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for b in batches:
            ids = [np.frombuffer(unpack(x), dtype).astype("<u4").tobytes() for x in b.column("ids").to_pylist()]
            yield b.set_column(b.schema.get_field_index("ids"), "ids", pa.array(ids, pa.binary()))

    out = placed.select("doc_id", "piece", "start", "length", "ids", F.coalesce("sequence", "bin").alias("sequence_id"),
                        (F.col("at") + F.coalesce("shift", F.lit(0))).alias("offset"))
    return map_arrow(out, run, "doc_id long, piece int, start long, length long, ids binary, sequence_id long, offset long")


def sequences(pieces: DataFrame) -> DataFrame:
    """(sequence_id, length, n_pieces, ids) of each sequence of ``packed``: its ids in
    a row, ready to be written."""
    own = F.array_sort(F.collect_list(F.struct("offset", "length", "ids")))
    return pieces.groupBy("sequence_id").agg(F.sum("length").alias("length"), F.count(F.lit(1)).alias("n_pieces"), own.alias("own")).select(
        "sequence_id", "length", "n_pieces",
        F.unhex(F.array_join(F.transform("own", lambda x: F.hex(x["ids"])), "")).alias("ids"))
