"""Periodic runs of words, found with a recompressed grammar.

The words of a batch of texts become numbers, one sequence with a separator of its
own before, between and after the texts.  **Recompression** builds a grammar over
it bottom-up: in turn, blocks of one symbol become a symbol for (symbol, length),
and pairs of a symbol of the left and one of the right half of a random split of
the alphabet become a symbol, until every text is one symbol.  Equal stretches are
parsed alike but for a symbol at their ends on each level, so the longest common
extension (LCE) of two places, to the right or to the left, is found by climbing
while both stand at the begin of a symbol and coming down where symbols differ: a
few steps a level, thousands of queries at a time with numpy.

A run of period q and length L >= max(6, 4q) holds, for q = 1, 2, ..., a place of the
**harmonic grid** (every max(6, 4q) - q words) together with the place q words on.
Both extensions of such a candidate pair give the run exactly.  A run found with a
multiple of its period has the same begin and end; the smallest period stays.

All symbols are given exactly (no hashing decides), and a text is never split.
Defined results: a null or empty text has no words and no runs; every row of
``docs``, repeated or with a null id, gives one row; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import map_arrow, slices
from daybook.llm.encoding import word_codes
from daybook.llm.words import Words, mix, split_words


def _ranks(x: np.ndarray) -> np.ndarray:
    return np.unique(x, return_inverse=True)[1]


@dataclass
class Grammar:
    """All levels in one row of nodes.  ``symbol[v]``: equal on one level only for
    equal expansions; ``first[v]``: the first node below (``first[v + 1]`` ends it);
    ``up[v]``: the node above, -1 on the top level; ``block[v]``: whether that one is
    a block of equal nodes.  Nodes 0 to n - 1 are the sequence itself."""

    symbol: np.ndarray
    first: np.ndarray
    up: np.ndarray
    block: np.ndarray

    @classmethod
    def build(cls, seq: np.ndarray, ends: np.ndarray) -> Grammar:
        """``ends``: whether a place holds a separator, a symbol that occurs once."""
        symbols, firsts, ups, blocks = [], [np.full(len(seq) + 1, -1)], [], []
        base, now, end, turn = 0, seq.astype(np.int64), ends, 0
        while True:
            n = len(now)
            # blocks, if there are any, else pairs
            head = np.ones(n, bool)
            head[1:] = now[1:] != now[:-1]
            is_block = not head.all()
            if not is_block:
                half = (mix((now + 1).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(turn)) & np.uint64(1)).astype(bool)
                a, b = ~half & ~end, half & ~end
                right, left = a[:-1] & b[1:], b[:-1] & a[1:]
                pair = right if right.sum() >= left.sum() else left
                turn += 1
                if not pair.any():
                    if not ((~end[1:]) & (~end[:-1])).any():
                        break  # every text is one symbol
                    continue
                head[1:] = ~pair
            at = np.flatnonzero(head)
            size = np.diff(np.append(at, n))
            top = now[at].copy()
            many = np.flatnonzero(size > 1)
            other = size[many] if is_block else now[at[many] + 1]
            top[many] = now.max() + 1 + _ranks(now[at[many]] * (max(n, int(now.max())) + 2) + other)
            symbols.append(np.append(now, -1))
            ups.append(np.append(base + n + 1 + np.cumsum(head) - 1, -1))
            blocks.append(np.full(n + 1, is_block))
            firsts.append(base + np.append(at, n))
            base += n + 1
            now, end = _ranks(top), end[at]
        symbols.append(np.append(now, -1))
        ups.append(np.full(len(now) + 1, -1))
        blocks.append(np.zeros(len(now) + 1, bool))
        return cls(*map(np.concatenate, (symbols, firsts, ups, blocks)))

    def extension(self, i: np.ndarray, j: np.ndarray, left: bool = False) -> np.ndarray:
        """How many symbols from ``i`` and from ``j`` on are equal, to the right, or to
        the left with ``i`` and ``j`` themselves."""
        out = np.zeros(len(i), np.int64)
        live, x, y, climbing, begin = np.arange(len(i)), i.copy(), j.copy(), np.ones(len(i), bool), i
        symbol, first, up, block = self.symbol, self.first, self.up, self.block
        way = -1 if left else 1
        while len(live):
            same = symbol[x] == symbol[y]
            done = ~same & (first[x] < 0)
            if done.any():
                out[live[done]] = np.abs(x[done] - begin[live[done]])
                stay = ~done
                live, x, y, climbing, same = live[stay], x[stay], y[stay], climbing[stay], same[stay]
            ux, uy = up[x], up[y]
            if left:
                edge_x, edge_y = first[ux + 1] - 1, first[uy + 1] - 1
            else:
                edge_x, edge_y = first[ux], first[uy]
            rise = same & climbing & (ux >= 0) & (edge_x == x) & (edge_y == y)
            # equal, but not to be left together: on by what is left of the shorter block
            if left:
                rest = np.minimum(x - first[ux], y - first[uy]) + 1
            else:
                rest = np.minimum(first[ux + 1] - x, first[uy + 1] - y)
            pace = np.where((ux >= 0) & block[x], rest, 1)
            fall = ~same
            climbing = climbing & ~fall
            if left:
                down_x, down_y = first[x + 1] - 1, first[y + 1] - 1
            else:
                down_x, down_y = first[x], first[y]
            x, y = (np.where(fall, down_x, np.where(rise, ux, x + way * pace)),
                    np.where(fall, down_y, np.where(rise, uy, y + way * pace)))
        return out


def _candidates(n: np.ndarray, least: int, exponent: int, most: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text, place, period) of the harmonic grids of texts of ``n`` words, about ``most`` at a time."""
    longest = np.where(n >= least, n // exponent, 0)
    text = np.repeat(np.arange(len(n)), longest)
    period = np.arange(len(text)) - np.repeat(np.cumsum(longest) - longest, longest) + 1
    step = np.maximum(least, exponent * period) - period
    count = (n[text] - period - 1) // step + 1
    total = np.cumsum(count)
    cuts = np.unique(np.concatenate([[0], np.searchsorted(total, np.arange(most, total[-1] + 1 if len(total) else 0, most)), [len(text)]]))
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        c = count[a:b]
        k = np.arange(c.sum()) - np.repeat(np.cumsum(c) - c, c)
        yield np.repeat(text[a:b], c), k * np.repeat(step[a:b], c), np.repeat(period[a:b], c)


def _of_batch(w: Words, least: int, exponent: int, most: int = 1 << 20) -> np.ndarray:
    """(text, start, length, period) of all runs, in this order."""
    n = np.diff(w.ptr)
    codes, _ = word_codes(w)
    # one sequence: separators around each text, numbered beyond the words
    place = np.arange(len(codes)) + np.repeat(np.arange(len(n)), n) + 1
    seq = np.full(len(codes) + len(n) + 1, -1, np.int64)
    seq[place] = codes
    ends = seq < 0
    seq[ends] = len(codes) + np.arange(ends.sum())
    base = np.cumsum(n + 1) - n
    grammar, found = None, []
    for text, at, period in _candidates(n, least, exponent, most):
        i = base[text] + at
        hit = np.flatnonzero(seq[i] == seq[i + period])
        if not len(hit):
            continue
        grammar = grammar or Grammar.build(seq, ends)
        i, text, period = i[hit], text[hit], period[hit]
        after = grammar.extension(i, i + period)
        before = grammar.extension(i, i + period, left=True) - 1
        length = before + after + period
        run = length >= np.maximum(least, exponent * period)
        start = (i - before - base[text])[run]
        found.append(np.unique(np.stack([text[run], start, length[run], period[run]], 1), axis=0))
    if not found:
        return np.zeros((0, 4), np.int64)
    rows = np.unique(np.concatenate(found), axis=0)
    first = np.ones(len(rows), bool)
    first[1:] = (rows[1:, :3] != rows[:-1, :3]).any(1)  # of one stretch, the smallest period
    rows = rows[first]
    return rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]


def _kept(w: Words, stay: np.ndarray) -> pa.Array:
    """Each text's words that stay, joined by one space."""
    at = np.flatnonzero(stay)
    size = w.end[at] - w.start[at]
    to = np.cumsum(size + 1) - size - 1
    out = np.full(int((size + 1).sum()), 32, np.uint8)
    for a in range(0, len(at), 1 << 18):  # bounds the index arrays
        s = size[a:a + (1 << 18)]
        inside = np.arange(s.sum()) - np.repeat(np.cumsum(s) - s, s)
        out[np.repeat(to[a:a + (1 << 18)], s) + inside] = w.buf[np.repeat(w.start[at[a:a + (1 << 18)]], s) + inside]
    cut = np.append(to, len(out))[np.searchsorted(at, w.ptr)]
    raw = out.tobytes()
    return pa.array([raw[x:max(x, y - 1)] for x, y in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)], pa.binary()).cast(pa.string())


def find_runs(docs: DataFrame, least: int = 6, exponent: int = 4) -> DataFrame:
    """(doc_id, n_words, runs, kept) of each row of ``docs`` (doc_id, text).

    ``runs``: all runs (start, length, period) of at least ``least`` words and
    ``exponent`` periods (3 at least), by start, then period.  ``kept``: the words
    that no run contains after its first period, joined by one space.
    """
    if exponent < 3 or least < 3:
        raise ValueError("runs of under three periods or three words are not covered by the grid")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            w = split_words(b.column("text"))
            rows = _of_batch(w, least, exponent)
            gone = np.zeros(len(w) + 1, np.int64)
            np.add.at(gone, w.ptr[rows[:, 0]] + rows[:, 1] + rows[:, 3], 1)
            np.add.at(gone, w.ptr[rows[:, 0]] + rows[:, 1] + rows[:, 2], -1)
            ptr = np.searchsorted(rows[:, 0], np.arange(b.num_rows + 1))
            own = pa.StructArray.from_arrays([pa.array(rows[:, c]) for c in (1, 2, 3)], ["start", "length", "period"])
            yield pa.RecordBatch.from_pydict({
                "doc_id": b.column("doc_id"), "n_words": np.diff(w.ptr),
                "runs": pa.ListArray.from_arrays(pa.array(ptr, pa.int32()), own), "kept": _kept(w, np.cumsum(gone)[:-1] == 0)})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return map_arrow(rows, run, "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, kept string")


def strongest(runs: str = "runs") -> F.Column:
    """The run of the greatest length / period, exactly; ties: smallest start, then period."""
    def better(a, b):
        return (b["length"] * a["period"] > a["length"] * b["period"]) | (
            (b["length"] * a["period"] == a["length"] * b["period"]) & (
                (b["start"] < a["start"]) | ((b["start"] == a["start"]) & (b["period"] < a["period"]))))

    return F.aggregate(runs, F.get(F.col(runs), F.lit(0)), lambda a, b: F.when(better(a, b), b).otherwise(a))


def planted(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) with periodic tails in one of ten documents, by
    h = crc32 of the decimal doc_id: see the query's contract."""
    words = F.regexp_extract_all(F.coalesce(F.col("text").cast("string"), F.lit("")), F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g, n = F.floor(h / 10), F.size("words").cast("long")
    a = F.pmod(g, n)
    p = F.lit(1) + F.floor((n - a) / (F.lit(3) + F.pmod(g, F.lit(8))))
    tail = F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.element_at(
        "words", (F.when(i < F.col("a"), i).otherwise(F.col("a") + F.pmod(i - F.col("a"), F.col("p"))) + 1).cast("int")))
    out = docs.select("doc_id", "text", F.when(F.pmod(h, F.lit(10)) == 0, words).alias("words"))
    out = out.withColumn("a", F.when(n > 0, a)).withColumn("p", F.when(n > 0, p))
    return out.select("doc_id", F.when(n > 0, F.array_join(tail, " ")).otherwise(F.col("text")).alias("text"))
