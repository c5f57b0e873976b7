"""Benchmark decontamination by greedy string tiling.

A test item and a document are compared as word sequences (case and
punctuation folded by Unicode; in scripts written without blanks, such as Chinese,
Japanese and Thai, each letter is a word).  Runs of ``least`` words that an item and a document share
are seeds; for every pair with seeds, tiles are laid: the longest common run of
words not yet covered in either is marked, again and again, down to ``least``
words (running Karp-Rabin: equal hashes of runs of the current length are
looked up, extended, and marked from the longest).  Tiles may lie in any order,
so a reordered passage is covered as well.  A document is contaminated by an
item when tiles cover at least ``coverage`` of the item's words.  An item of fewer
than ``least`` words has no seeds: it contaminates a document that holds all its
words in a row.

The items go to the tasks in blocks of at most ``block_words`` words (one item
at least), so what is broadcast is bounded; each block meets all documents.

Defined results: null and empty texts and items match nothing; repeated items and documents give a row each;
a null doc_id or item_id stays null.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import map_arrow, save, slices
from daybook.llm.words import FOLD, Words, folded, rolling, split_words


def _free_runs(free: np.ndarray, size: int) -> np.ndarray:
    """Where runs of ``size`` uncovered words begin."""
    total = np.concatenate([np.zeros(1, np.int64), np.cumsum(free)])
    return np.flatnonzero(total[size:] - total[:-size] == size) if len(free) >= size else np.zeros(0, np.int64)


def _length(same: np.ndarray) -> int:
    """How many leading values are true."""
    off = np.flatnonzero(~same)
    return int(off[0]) if len(off) else len(same)


def _matches(a: np.ndarray, b: np.ndarray, free_a: np.ndarray, free_b: np.ndarray, size: int) -> list[tuple[int, int, int]]:
    """Common runs (length, start in a, start in b) of at least ``size``
    uncovered words that cannot be longer at either end."""
    at_a, at_b = _free_runs(free_a, size), _free_runs(free_b, size)
    if not len(at_a) or not len(at_b):
        return []
    ha, hb = rolling(a, size)[at_a], rolling(b, size)[at_b]
    order = np.argsort(ha, kind="stable")
    ha, at_a = ha[order], at_a[order]
    lo, hi = np.searchsorted(ha, hb, "left"), np.searchsorted(ha, hb, "right")
    hit = np.flatnonzero(hi > lo)
    found = []
    for q in hit:
        j = int(at_b[q])
        for i in at_a[lo[q]:hi[q]].tolist():
            if i and j and free_a[i - 1] and free_b[j - 1] and a[i - 1] == b[j - 1]:
                continue
            most = min(len(a) - i, len(b) - j)
            n = _length((a[i:i + most] == b[j:j + most]) & free_a[i:i + most] & free_b[j:j + most])
            if n >= size:
                found.append((n, i, j))
    return found


def tiles(a: np.ndarray, b: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Greedy tiles (length, start in a, start in b) of two word-hash sequences."""
    free_a, free_b, out = np.ones(len(a), bool), np.ones(len(b), bool), []
    size = max(least, min(len(a), len(b)))
    while True:
        found = _matches(a, b, free_a, free_b, size)
        if found:
            longest = max(m[0] for m in found)
            for n, i, j in sorted(m for m in found if m[0] == longest):
                if free_a[i:i + n].all() and free_b[j:j + n].all():
                    free_a[i:i + n] = free_b[j:j + n] = False
                    out.append((n, i, j))
            continue  # what is left of a match cut by a tile may still be the longest
        if size == least:
            return out
        size = max(least, size // 2)


class _Seeds:
    """The sorted hashes of some runs, with the item and place of each."""

    def __init__(self, runs: list[np.ndarray]):
        item = np.repeat(np.arange(len(runs)), [len(s) for s in runs])
        place = np.concatenate([np.arange(len(s)) for s in runs])
        seed = np.concatenate(runs)
        order = np.argsort(seed, kind="stable")
        self.hash, self.item, self.place = seed[order], item[order], place[order]
        self.near = np.zeros(1 << 20, bool)
        self.near[self.hash & np.uint64((1 << 20) - 1)] = True


@dataclass
class Block:
    """Some items: their words, and the sorted hashes of their seeds."""

    ids: list
    words: list[np.ndarray]
    least: int

    def __post_init__(self) -> None:
        # runs of ``least`` words, or of all words of a shorter item, by their length
        self.seeds = {k: _Seeds([rolling(w, k) if len(w) >= k and (k == self.least or len(w) == k) else w[:0] for w in self.words])
                      for k in sorted({min(len(w), self.least) for w in self.words})}

    def search(self, texts: pa.Array, coverage: float) -> Iterator[tuple[int, int, int, int]]:
        """(text, item, words covered, tiles) of the pairs that reach the coverage."""
        w = split_words(folded(texts), FOLD)
        h, doc = w.hashes(), w.doc()
        for k, seeds in self.seeds.items():
            yield from self._of_length(k, seeds, w, h, doc, coverage)

    def _of_length(self, k: int, seeds: _Seeds, w: Words, h: np.ndarray, doc: np.ndarray, coverage: float):
        run = rolling(h, k)
        at = np.flatnonzero(seeds.near[run & np.uint64((1 << 20) - 1)])
        at = at[doc[at] == doc[at + k - 1]]
        lo, hi = np.searchsorted(seeds.hash, run[at], "left"), np.searchsorted(seeds.hash, run[at], "right")
        at, lo, n = at[hi > lo], lo[hi > lo], (hi - lo)[hi > lo]
        if not len(at):
            return
        # join: each distinct seed of a document with all items that have it
        each, one = np.unique(np.stack([doc[at], lo], 1), axis=0, return_index=True)
        n = n[one]
        mine = np.repeat(each[:, 0], n)
        which = np.repeat(each[:, 1] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        seen = np.unique(np.stack([mine, seeds.item[which], seeds.place[which]], 1), axis=0)
        new = np.flatnonzero(np.any(seen[1:, :2] != seen[:-1, :2], axis=1)) + 1
        for part in np.split(seen, new):
            text, item = int(part[0, 0]), int(part[0, 1])
            words = self.words[item]
            if k < self.least:
                yield text, item, k, 1
                continue
            most = np.zeros(len(words) + 1, np.int64)
            np.add.at(most, part[:, 2], 1)
            np.add.at(most, np.minimum(part[:, 2] + self.least, len(words)), -1)
            if (np.cumsum(most)[:-1] > 0).sum() < coverage * len(words):
                continue  # even all seeds together cover too little
            laid = tiles(words, h[w.ptr[text]:w.ptr[text + 1]], self.least)
            covered = sum(t[0] for t in laid)
            if covered >= coverage * len(words):
                yield text, item, covered, len(laid)


def _blocks(items: DataFrame, least: int, block_words: int) -> Iterator[Block]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            w = split_words(folded(b.column("text")), FOLD)
            h = w.hashes()
            yield pa.RecordBatch.from_pydict({"item_id": b.column("item_id"), "words": pa.array(
                [h[i:j].tobytes() for i, j in zip(w.ptr[:-1], w.ptr[1:], strict=True)], pa.binary())})

    rows = items.select("item_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    words = map_arrow(rows, run, f"item_id {items.schema['item_id'].dataType.simpleString()}, words binary")
    ids, own, size = [], [], 0
    for r in save(words.filter(F.length("words") > 0), "items").toLocalIterator():
        w = np.frombuffer(bytes(r.words), np.uint64)
        if own and size + len(w) > block_words:
            yield Block(ids, own, least)
            ids, own, size = [], [], 0
        ids.append(r.item_id)
        own.append(w)
        size += len(w)
    if own:
        yield Block(ids, own, least)


def contaminated(docs: DataFrame, benchmark: DataFrame, least: int = 5, coverage: float = 0.5,
                 block_words: int = 1_000_000) -> DataFrame:
    """(doc_id, item_id, item_words, covered, tiles, coverage) of each document
    and item whose tiles reach the coverage."""
    spark = docs.sparkSession
    kind = benchmark.schema["item_id"].dataType.simpleString()
    schema = f"doc_id long, item_id {kind}, item_words int, covered int, tiles int, coverage double"
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    parts = []
    for block in _blocks(benchmark, least, block_words):
        sent = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for b in slices(batches):
                got = list(sent.value.search(b.column("text"), coverage))
                size = [len(sent.value.words[g[1]]) for g in got]
                yield pa.RecordBatch.from_arrays([
                    b.column("doc_id").take(pa.array([g[0] for g in got], pa.int64())),
                    pa.array([sent.value.ids[g[1]] for g in got], pa.int64() if kind == "bigint" else None),
                    pa.array(size, pa.int32()), pa.array([g[2] for g in got], pa.int32()), pa.array([g[3] for g in got], pa.int32()),
                    pa.array([g[2] / n for g, n in zip(got, size, strict=True)], pa.float64())],
                    ["doc_id", "item_id", "item_words", "covered", "tiles", "coverage"])

        parts.append(map_arrow(rows, run, schema))
    return reduce(DataFrame.union, parts) if parts else spark.createDataFrame([], schema)


def without_contaminated(docs: DataFrame, benchmark: DataFrame, least: int = 5, coverage: float = 0.5,
                         block_words: int = 1_000_000) -> DataFrame:
    """The rows of ``docs`` that no item contaminates, all columns; no shuffle."""
    for block in _blocks(benchmark, least, block_words):
        sent = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for b in slices(batches):
                keep = np.ones(b.num_rows, bool)
                keep[[g[0] for g in sent.value.search(b.column("text"), coverage)]] = False
                yield b.filter(pa.array(keep))

        docs = map_arrow(docs, run, docs.schema)
    return docs
