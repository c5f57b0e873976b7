"""Substring dedup by super-k-mer partitioning.

A window is ``k`` consecutive words of one document.  Its minimiser is the
smallest hash among its runs of ``m`` words.  Neighbouring windows mostly share
it, so they travel together, as one packed string of their words (a super-k-mer),
to the minimiser's bucket; equal windows have equal minimisers and so meet there.
In a bucket all windows are sorted by hash and compared word for word; every one
but the earliest (smallest doc_id, then start) marks its words for removal.

Hot spots: super-k-mers that are equal within a slice of a task leave only the
earliest to travel (the others are marked at once), and a task remembers those
that come often, so a passage of very many documents travels about once per
task.  Minimisers are counted first, in classes whose number grows with the input, so
that an average class stays well below the limit; windows of those with more than
``hot_windows`` windows (distinct texts that share a phrase) travel one by one,
dealt by the window's own hash instead, and equal ones again about once per task.
Packed strings that go from one slice to
one bucket range are sent as one compressed block.

Defined results: a null or empty text has no words; rows with one doc_id and one
text are the same place, so none is a repeat of the other; rows with one
doc_id and different texts stand in the order of their texts' hashes; a null
doc_id counts as the smallest and comes back as null.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import doc_rows, id_key, map_arrow, parts_for, real_id, save, slices
from daybook.llm.words import Words, mix, rolling, span_hashes, split_words

#: Parts of a partition that are sorted one after the other, which bounds a task's memory.
_FINE = 6
_HEAD = 4  # numbers that go with a packed string: doc_id, rk, first word, bytes


def _smallest(x: np.ndarray, n: int) -> np.ndarray:
    """The minimum of each ``n`` neighbours, by doubling."""
    out, span = x, 1
    while span < n:
        step = min(span, n - span)
        out = np.minimum(out[:-step], out[step:])
        span += step
    return out


@dataclass
class Runs:
    """Super-k-mers of a slice: words ``lo:hi`` of text ``doc``, and their minimiser."""

    w: Words
    h: np.ndarray
    doc: np.ndarray
    lo: np.ndarray
    hi: np.ndarray
    low: np.ndarray


def super_kmers(texts: pa.Array, k: int, m: int) -> Runs:
    w = split_words(texts)
    h, doc = w.hashes(), w.doc()
    low = _smallest(mix(rolling(h, m)), k - m + 1)
    if not len(low):
        none = np.zeros(0, np.int64)
        return Runs(w, h, none, none, none, np.zeros(0, np.uint64))
    at = np.flatnonzero(doc[:len(low)] == doc[k - 1:])
    low = low[at]
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1] + 1) | (low[1:] != low[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at)) - 1
    return Runs(w, h, doc[at[first]], at[first], at[last] + k, low[first])


def _bucket(low: np.ndarray, parts: int) -> np.ndarray:
    return (mix(low + np.uint64(1)) % np.uint64(parts)).astype(np.int64)


class Packer:
    """Packs the slices of one task."""

    def __init__(self, k: int, m: int, parts: int, hot: np.ndarray, hot_parts: int):
        self.k, self.m, self.parts, self.hot, self.hot_parts = k, m, parts, hot, hot_parts
        self.often: dict[tuple[int, int], tuple[int, int, int]] = {}

    def _first(self, one: np.ndarray, two: np.ndarray, ids: np.ndarray, rks: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of strings with two hashes and a place: those that travel, the earliest of each
        kind unless an earlier one has travelled before, and those that repeat one."""
        order = np.lexsort((start, rks, ids, two, one))
        o, t = one[order], two[order]
        new = np.ones(len(o), bool)
        new[1:] = (o[1:] != o[:-1]) | (t[1:] != t[:-1])
        begin = np.flatnonzero(new)
        lead = order[begin[np.cumsum(new) - 1]] if len(o) else order
        repeat = ~((ids[order] == ids[lead]) & (rks[order] == rks[lead]) & (start[order] == start[lead]))
        marks = [order[repeat]]
        # those that came often: later ones need not travel again
        many = np.diff(np.append(begin, len(o)))
        send = np.ones(len(begin), bool)
        if self.often or (many > 2).any():
            for q in np.flatnonzero(many > 2) if not self.often else range(len(begin)):
                x = order[begin[q]]
                key, place = (int(one[x]), int(two[x])), (int(ids[x]), int(rks[x]), int(start[x]))
                seen = self.often.get(key)
                if seen is not None and seen < place:
                    send[q] = False
                    marks.append(np.array([x]))
                elif seen is None and many[q] > 2 and len(self.often) < 100_000:
                    self.often[key] = place
        return order[begin[send]], np.concatenate(marks)

    def _marks(self, ids: np.ndarray, rks: np.ndarray, start: np.ndarray, words: np.ndarray) -> Iterator[tuple[int, bool, bytes]]:
        if len(ids):
            block = np.stack([ids, rks, start, start + words], 1).astype("<i8")
            yield int(ids[0]) % self.parts * _FINE, True, zstandard.compress(block.tobytes(), 1)

    def pack(self, batch: pa.RecordBatch) -> Iterator[tuple[int, bool, bytes]]:
        """(part of a partition, whether marks, block)."""
        r = super_kmers(batch.column("text"), self.k, self.m)
        ids = batch.column("doc_id").to_numpy(zero_copy_only=False)[r.doc]
        rks = batch.column("rk").to_numpy(zero_copy_only=False)[r.doc]
        start = r.lo - r.w.ptr[r.doc]
        lead, gone = self._first(*span_hashes(r.h, r.lo, r.hi), ids, rks, start)
        yield from self._marks(ids[gone], rks[gone], start[gone], (r.hi - r.lo)[gone])
        if not len(lead):
            return
        hot = np.isin(_bucket(r.low[lead], self.hot_parts), self.hot)
        lo, hi, low = r.lo[lead], r.hi[lead], r.low[lead]
        ids, rks, start = ids[lead], rks[lead], start[lead]
        if hot.any():  # windows of hot minimisers, one by one, equal ones once
            n = (hi - lo - self.k + 1)[hot]
            each = np.repeat(np.flatnonzero(hot), n)
            step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            at, place = lo[each] + step, start[each] + step
            lead, gone = self._first(*span_hashes(r.h, at, at + self.k), ids[each], rks[each], place)
            yield from self._marks(ids[each][gone], rks[each][gone], place[gone], np.full(len(gone), self.k))
            at, place, each = at[lead], place[lead], each[lead]
            own = rolling(r.h, self.k)[at]
            lo, hi = np.concatenate([lo[~hot], at]), np.concatenate([hi[~hot], at + self.k])
            low = np.concatenate([low[~hot], own])
            ids, rks = (np.concatenate([v[~hot], v[each]]) for v in (ids, rks))
            start = np.concatenate([start[~hot], place])
            if not len(lo):
                return
        part = _bucket(low, self.parts * _FINE)
        order = np.argsort(part, kind="stable")
        edge = np.flatnonzero(np.diff(part[order], prepend=-1))
        left, right = r.w.start[lo], r.w.end[hi - 1]
        raw = r.w.buf.tobytes()
        head = np.stack([ids, rks, start, right - left], 1).astype("<i8")
        for a, b in zip(edge, np.append(edge[1:], len(order)), strict=True):
            own = order[a:b]
            text = b"".join([raw[i:j] for i, j in zip(left[own].tolist(), right[own].tolist(), strict=True)])
            block = np.array([b - a], "<i8").tobytes() + np.ascontiguousarray(head[own].T).tobytes() + text
            yield int(part[own[0]]), False, zstandard.compress(block, 3)


def _repeats(blocks: list[bytes], k: int) -> np.ndarray:
    """Marks (doc_id, rk, first word, end) of the windows in the packed strings
    of some buckets that start earlier elsewhere."""
    heads, texts = [], []
    for raw in map(zstandard.decompress, blocks):
        n = int(np.frombuffer(raw, "<i8", 1)[0])
        heads.append(np.frombuffer(raw, "<i8", _HEAD * n, 8).reshape(_HEAD, n))
        texts.append(raw[8 + 8 * _HEAD * n:])
    head, buf = np.concatenate(heads, 1), b"".join(texts)
    ids, rks, first, size = head
    texts = pa.Array.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(
        np.concatenate([np.zeros(1, "<i8"), np.cumsum(size)]).astype("<i8").tobytes()), pa.py_buffer(buf)])
    w = split_words(texts)
    h, own = w.hashes(), w.doc()
    run = rolling(h, k)
    at = np.flatnonzero(own[:len(run)] == own[k - 1:])
    own, start = own[at], (at - w.ptr[own[at]]) + first[own[at]]
    key = run[at]
    order = np.lexsort((start, rks[own], ids[own], key))
    key, at, own, start = key[order], at[order], own[order], start[order]
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    lead = np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))
    rest = np.flatnonzero(~new)
    # windows of equal hash are compared word for word; a stranger among them leads its own group
    for a in range(0, len(rest), 1 << 18):
        part = rest[a:a + (1 << 18)]
        span = np.arange(k)
        odd = part[(h[at[part][:, None] + span] != h[at[lead[part]][:, None] + span]).any(1)]
        for x in odd.tolist():
            for y in range(lead[x], x + 1):
                if (h[at[x]:at[x] + k] == h[at[y]:at[y] + k]).all():
                    lead[x] = y
                    break
    same = (ids[own] == ids[own[lead]]) & (rks[own] == rks[own[lead]]) & (start == start[lead])
    gone = np.flatnonzero(~same)
    # neighbouring windows of one packed string make one mark
    gone = gone[np.lexsort((start[gone], own[gone]))]
    o, s = own[gone], start[gone]
    new = np.ones(len(gone), bool)
    new[1:] = (o[1:] != o[:-1]) | (s[1:] != s[:-1] + 1)
    a = np.flatnonzero(new)
    b = np.append(a[1:], len(gone)) - 1
    if not len(a):
        return np.zeros((0, 4), np.int64)
    return np.stack([ids[o[a]], rks[o[a]], s[a], s[b] + k], 1)


def _hot(rows: DataFrame, k: int, m: int, hot_windows: int, hot_parts: int) -> np.ndarray:
    """Minimiser classes (of ``hot_parts``) with too many windows for a task:
    counted over all documents; there are at most windows / ``hot_windows`` of them."""
    dense = hot_parts <= 1 << 20

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(hot_parts if dense else 0, np.int64)
        for b in slices(batches):
            r = super_kmers(b.column("text"), k, m)
            one, two = span_hashes(r.h, r.lo, r.hi)
            _, once = np.unique(np.stack([one, two], 1), axis=0, return_index=True)  # as many as will travel
            own, n = _bucket(r.low[once], hot_parts), (r.hi - r.lo - k + 1)[once]
            if dense:
                np.add.at(total, own, n)
            else:  # too many classes for an array: the aggregation below adds them up
                at, which = np.unique(own, return_inverse=True)
                yield pa.RecordBatch.from_pydict({"class": at, "n": np.bincount(which, n, len(at)).astype(np.int64)})
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"class": at, "n": total[at]})

    counted = map_arrow(rows.select("text"), run, "class long, n long").groupBy("class").agg(F.sum("n").alias("n"))
    return np.array(sorted(r[0] for r in counted.filter(F.col("n") > hot_windows).select("class").collect()), np.int64)


def _told_apart(docs: DataFrame) -> DataFrame:
    """``doc_rows`` whose ``rk`` is 0 (which packs to nothing) but for ids that have several rows."""
    rows = doc_rows(docs)
    twice = save(docs.groupBy(id_key().alias("doc_id")).agg(F.count("*").alias("rows")).filter("rows > 1").select("doc_id"), "repeated-ids")
    if twice.isEmpty():
        return rows.withColumn("rk", F.lit(0).cast("long"))
    return rows.join(twice.withColumn("again", F.lit(True)), "doc_id", "left").select(
        "doc_id", "text", F.when(F.col("again"), F.col("rk")).otherwise(0).cast("long").alias("rk"))


def remove_repeats(docs: DataFrame, k: int = 20, m: int = 3, part_bytes: int = 8 << 20, hot_windows: int = 2_000_000,
                   hot_parts: int | None = None) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) of each row of ``docs``; ``kept`` are
    the words that stay, joined by one space."""
    rows = _told_apart(docs)
    parts = parts_for(docs, part_bytes)
    # a window has four bytes of input at least: an average class holds an eighth of the limit
    hot_parts = hot_parts or max(1 << 16, 1 << (2 * parts * part_bytes // hot_windows).bit_length())
    hot = _hot(rows, k, m, hot_windows, hot_parts)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(k, m, parts, hot, hot_parts)
        for b in slices(batches):
            out = list(packer.pack(b))
            if out:
                yield pa.RecordBatch.from_pydict({"part": pa.array([x[0] // _FINE for x in out], pa.int32()),
                                                  "fine": pa.array([x[0] for x in out], pa.int64()), "marks": [x[1] for x in out],
                                                  "block": pa.array([x[2] for x in out], pa.binary())})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: dict[int, list[bytes]] = {}
        for b in batches:
            for part, marks, block in zip(*(b.column(c).to_pylist() for c in ("fine", "marks", "block")), strict=True):
                if marks:
                    yield table(np.frombuffer(zstandard.decompress(block), "<i8").reshape(-1, 4))
                else:
                    blocks.setdefault(part, []).append(block)
        for part in list(blocks):
            yield table(_repeats(blocks.pop(part), k))

    def table(marks: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"doc_id": marks[:, 0], "rk": marks[:, 1], "lo": marks[:, 2], "hi": marks[:, 3]})

    packed = map_arrow(rows, pack, "part int, fine long, marks boolean, block binary").repartition(parts, "part")
    marks = map_arrow(packed, count, "doc_id long, rk long, lo long, hi long")
    marks = marks.groupBy("doc_id", "rk").agg(F.collect_list(F.struct("lo", "hi")).alias("marks"))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            w = split_words(b.column("text"))
            gone = np.zeros(len(w) + 1, np.int64)
            for i, own in enumerate(b.column("marks").to_pylist()):
                if own:
                    span = np.array([(x["lo"], x["hi"]) for x in own]) + w.ptr[i]
                    np.add.at(gone, span[:, 0], 1)
                    np.add.at(gone, span[:, 1], -1)
            stay = np.cumsum(gone)[:-1] == 0
            raw, kept = w.buf.tobytes(), []
            for i, j in zip(w.ptr[:-1].tolist(), w.ptr[1:].tolist(), strict=True):
                at = i + np.flatnonzero(stay[i:j])
                kept.append(b" ".join([raw[x:y] for x, y in zip(w.start[at].tolist(), w.end[at].tolist(), strict=True)]))
            total = np.concatenate([np.zeros(1, np.int64), np.cumsum(~stay)])
            yield pa.RecordBatch.from_pydict({
                "doc_id": b.column("doc_id"), "n_words": np.diff(w.ptr), "n_removed": total[w.ptr[1:]] - total[w.ptr[:-1]],
                "kept": pa.array(kept, pa.binary()).cast(pa.string())})

    out = map_arrow(rows.join(marks, ["doc_id", "rk"], "left").select("doc_id", "text", "marks"), apply,
                    "doc_id long, n_words long, n_removed long, kept string")
    return out.withColumn("doc_id", real_id())
