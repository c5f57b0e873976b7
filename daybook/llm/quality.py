"""Quality classifier by co-training.

Two classifiers see disjoint views of a document: its *text* (words, character
classes, repetition) and its *metadata* (source, language, length, lines).
Both start from the labelled rows; over ``rounds`` each scores every
unlabelled document, and the documents of which it is surest join the
**other** one's training set as pseudo-labels.  Labelled rows held out of
training then calibrate both views and the weights that combine them.

Fitting takes a bounded sample: at most ``label_sample`` labelled rows, and at
most ``exchange`` pseudo-labels per view, class and round (picked over all
documents without a label, each text once).  Scoring covers every document.

Defined results: a null or empty text is scored on its (empty) features; null
source, language or length are values of their own; a row repeated in
`documents` is scored each time; several label rows of one document count as
bad when one of them says so; a null label says nothing.  Without both classes
among the labels nothing can be learned: every score is null and every
document is kept.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from daybook.llm.common import id_key, map_arrow, real_id, save, slices
from daybook.llm.words import FOLD, split_words, text_buffer

_CLASSES = [[*range(65, 91)], [*range(97, 123)], [*range(48, 58)], [0x21], [0x7C], [ord(c) for c in "#$%&*@^~<>=+_\\/"],
            [ord(c) for c in ".,;:?"]]


#: Bytes of a longer word that count as its stem.
_STEM = 5


@dataclass
class Features:
    """Sparse ids (``ids[ptr[i]:ptr[i+1]]``, distinct) and dense values of rows."""

    ptr: np.ndarray
    ids: np.ndarray
    dense: np.ndarray


def _distinct(doc: np.ndarray, ids: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    key = np.unique((doc.astype(np.uint64) << np.uint64(32)) | ids.astype(np.uint64))
    ptr = np.searchsorted(key >> np.uint64(32), np.arange(n + 1, dtype=np.uint64))
    return ptr, key.astype(np.uint32)


def _sums(mask: np.ndarray, off: np.ndarray) -> np.ndarray:
    total = np.concatenate([np.zeros(1, np.int64), np.cumsum(mask)])
    return (total[off[1:]] - total[off[:-1]]).astype(float)


def text_view(batch: pa.RecordBatch, wanted: np.ndarray | None = None) -> Features:
    """Words and their first bytes (case and punctuation folded), and shares of
    character classes and of repeated words.  ``wanted``: sorted ids to which words are limited."""
    texts = batch.column("text")
    buf, off = text_buffer(texts)
    w = split_words(texts, FOLD)
    n, h = len(texts), w.hashes()
    doc = w.doc()
    size = np.maximum(np.diff(off), 1)
    count = np.maximum(np.diff(w.ptr), 1)
    again = np.zeros(len(h), bool)
    again[1:] = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
    dense = [_sums(np.isin(buf, np.array(c, np.uint8)), off) / size for c in _CLASSES]
    dense += [_sums(w.end - w.start, w.ptr) / count, _sums(again, w.ptr) / count]
    longer = np.flatnonzero(w.end - w.start > _STEM)
    stems = replace(w, start=w.start[longer], end=w.start[longer] + _STEM).hashes() ^ np.uint64(1 << 40)
    ids = np.concatenate([h >> np.uint64(32), stems >> np.uint64(32)]).astype(np.uint32)
    doc = np.concatenate([doc, doc[longer]])
    if wanted is not None:
        near = np.zeros(1 << 16, bool)
        near[wanted & 0xFFFF] = True
        hit = np.flatnonzero(near[ids & 0xFFFF])
        ids, doc = ids[hit], doc[hit]
        at = np.minimum(np.searchsorted(wanted, ids), max(len(wanted) - 1, 0))
        ids, doc = (ids[ok], doc[ok]) if len(wanted) and (ok := wanted[at] == ids) is not None else (ids[:0], doc[:0])
    ptr, ids = _distinct(doc, ids, n)
    return Features(ptr, ids, np.stack(dense, 1) if n else np.zeros((0, len(_CLASSES) + 2)))


def _name_id(name: str) -> int:
    return int.from_bytes(hashlib.blake2b(name.encode(), digest_size=4).digest(), "little")


def meta_view(batch: pa.RecordBatch, wanted: np.ndarray | None = None) -> Features:
    """Source, language, both together; length and line figures."""
    n = batch.num_rows
    src, lang = batch.column("source").to_pylist(), batch.column("lang").to_pylist()
    memo: dict[tuple, list[int]] = {}
    rows = [memo.get(k) or memo.setdefault(k, [_name_id(f"s={k[0]}"), _name_id(f"l={k[1]}"), _name_id(f"sl={k}")])
            for k in zip(src, lang, strict=True)]
    ids = np.array(rows, np.uint32).reshape(-1)
    ptr, ids = _distinct(np.repeat(np.arange(n), 3), ids, n)
    buf, off = text_buffer(batch.column("text"))
    chars = np.array([-1 if x is None else x for x in batch.column("n_chars").to_pylist()], float)
    lines = 1 + _sums(buf == 10, off)
    dense = np.stack([np.log1p(np.maximum(chars, -0.5)), np.log1p(lines), np.log1p(np.diff(off) / lines)], 1) \
        if n else np.zeros((0, 3))
    return Features(ptr, ids, dense)


@dataclass
class View:
    """Logistic regression over the ids and dense values of one view."""

    extract: Callable
    words: int = 4000
    wanted: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint32))
    edges: np.ndarray | None = None
    weight: np.ndarray | None = None
    #: logit after calibration: slope * raw + shift
    slope: float = 1.0
    shift: float = 0.0

    def columns(self, f: Features) -> tuple[np.ndarray, np.ndarray]:
        """(row, column) of the ones of the design matrix: words, then one bin
        per dense value, then the constant."""
        n, d, bins = len(f.ptr) - 1, f.dense.shape[1], self.edges.shape[1] + 1
        row = np.repeat(np.arange(n), np.diff(f.ptr))
        at = np.searchsorted(self.wanted, f.ids)
        ok = np.zeros(len(f.ids), bool)
        inside = at < len(self.wanted)
        ok[inside] = self.wanted[at[inside]] == f.ids[inside]
        parts = [(row[ok], at[ok])]
        for j in range(d):
            parts.append((np.arange(n), len(self.wanted) + j * bins + np.searchsorted(self.edges[j], f.dense[:, j])))
        parts.append((np.arange(n), np.full(n, len(self.wanted) + d * bins)))
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])

    def raw(self, f: Features) -> np.ndarray:
        row, col = self.columns(f)
        return np.bincount(row, self.weight[col], len(f.ptr) - 1)

    def logit(self, f: Features) -> np.ndarray:
        return self.slope * self.raw(f) + self.shift

    def fit(self, f: Features, bad: np.ndarray, weight: np.ndarray, steps: int = 250, ridge: float = 1.0) -> View:
        n = len(bad)
        row = np.repeat(np.arange(n), np.diff(f.ptr))
        ids, inverse = np.unique(f.ids, return_inverse=True)
        of_bad = np.bincount(inverse, bad[row], len(ids))
        of_all = np.bincount(inverse, minlength=len(ids))
        p, share = bad.mean(), of_bad / np.maximum(of_all, 1)
        gain = of_all * (share - p) ** 2 * (of_all >= 3)
        best = np.argsort(-gain, kind="stable")[:self.words]
        self.wanted = ids[np.sort(best[gain[best] > 0])]
        self.edges = np.quantile(f.dense, np.linspace(0.05, 0.95, 15), axis=0).T
        row, col = self.columns(f)
        size = int(len(self.wanted) + f.dense.shape[1] * (self.edges.shape[1] + 1) + 1)
        w, seen, pace = np.zeros(size), np.zeros(size), np.full(size, 1e-8)
        for _ in range(steps):
            score = np.bincount(row, w[col], n)
            g = weight * (1 / (1 + np.exp(-np.clip(score, -30, 30))) - bad)
            grad = np.bincount(col, g[row], size) + ridge * w
            seen = 0.8 * seen + 0.2 * grad
            pace = 0.98 * pace + 0.02 * grad ** 2
            w = w - 0.05 * seen / np.sqrt(pace)
        self.weight = w
        return self


def _logistic(x: np.ndarray, y: np.ndarray, steps: int = 60) -> np.ndarray:
    """Weights of a small logistic regression with intercept, by Newton's method."""
    x = np.concatenate([x, np.ones((len(x), 1))], 1)
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hess = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(len(w))
        w = w - np.linalg.solve(hess, x.T @ (p - y) + 1e-2 * w)
    return w


@dataclass
class Rows:
    """Training rows on the driver (bounded by the parameters)."""

    key: np.ndarray
    text: list[tuple[np.ndarray, np.ndarray]]
    meta: list[tuple[np.ndarray, np.ndarray]]

    def view(self, name: str, pick: np.ndarray) -> Features:
        rows = [getattr(self, name)[i] for i in pick]
        ptr = np.concatenate([np.zeros(1, np.int64), np.cumsum([len(r[0]) for r in rows], dtype=np.int64)])
        return Features(ptr, np.concatenate([r[0] for r in rows]), np.stack([r[1] for r in rows]))


def _features(docs: DataFrame) -> Rows:
    """Both views' features of a bounded set of documents, to the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            out = {"doc_id": b.column("doc_id"), "rk": b.column("rk")}
            for name, f in (("t", text_view(b)), ("m", meta_view(b))):
                out[f"{name}_ids"] = pa.array([f.ids[i:j].tobytes() for i, j in zip(f.ptr[:-1], f.ptr[1:], strict=True)], pa.binary())
                out[f"{name}_dense"] = pa.array([x.tobytes() for x in f.dense], pa.binary())
            yield pa.RecordBatch.from_pydict(out)

    got = map_arrow(docs, run, "doc_id long, rk long, t_ids binary, t_dense binary, m_ids binary, m_dense binary").collect()
    got.sort(key=lambda r: (r.doc_id, r.rk))
    two = [[(np.frombuffer(r[a], np.uint32), np.frombuffer(r[b])) for r in got]
           for a, b in (("t_ids", "t_dense"), ("m_ids", "m_dense"))]
    return Rows(np.array([(r.doc_id, r.rk) for r in got], np.int64).reshape(-1, 2), *two)


@dataclass
class Model:
    """Both views and the weights of their calibrated logits."""

    text: View
    meta: View
    blend: np.ndarray

    def chances(self, batch: pa.RecordBatch) -> list[np.ndarray]:
        """The chance of being bad: by text, by metadata, by both."""
        t, m = self.text.logit(text_view(batch, self.text.wanted)), self.meta.logit(meta_view(batch))
        both = self.blend[0] * t + self.blend[1] * m + self.blend[2]
        return [1 / (1 + np.exp(-np.clip(x, -30, 30))) for x in (t, m, both)]


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(
        id_key().alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.col("source").cast("string"), F.col("lang").cast("string"), F.col("n_chars").cast("long"),
    ).withColumn("rk", F.xxhash64("text"))


def _scored(rows: DataFrame, model: Model) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            t, m, both = model.chances(b)
            yield pa.RecordBatch.from_pydict({"doc_id": b.column("doc_id"), "rk": b.column("rk"),
                                              "p_text": t, "p_meta": m, "p_bad": both})

    return map_arrow(rows, run, "doc_id long, rk long, p_text double, p_meta double, p_bad double")


def surest(scored: DataFrame, told: DataFrame, taken: set[int], col: str, y: float, sure: float, exchange: int,
           turn: int) -> list[tuple[int, int]]:
    """(doc_id, rk) of the at most ``exchange`` documents that the view ``col`` is surest to
    be bad (``y`` 1) or good (0), ``sure`` at least: none of a labelled document, one for
    each text (its smallest id), and none of a text that has been ``taken`` before."""
    spark = scored.sparkSession
    chance = F.col(col) if y else 1 - F.col(col)
    free = scored.filter(chance >= sure).join(told, "doc_id", "left_anti")
    if taken:  # at most four times exchange in a round
        free = free.join(F.broadcast(spark.createDataFrame([(x,) for x in taken], "rk long")), "rk", "left_anti")
    texts = free.groupBy("rk").agg(F.min(F.struct("doc_id", col)).alias("d")).select("rk", "d.doc_id", f"d.{col}")
    order = [chance.desc(), F.xxhash64("doc_id", F.lit(turn)), "doc_id", "rk"]
    return [(r.doc_id, r.rk) for r in texts.orderBy(*order).limit(exchange).collect()]


def co_train(docs: DataFrame, labels: DataFrame, rounds: int = 2, label_sample: int = 10000, exchange: int = 400,
             sure: float = 0.97) -> Model | None:
    """The model; None when the labels lack a class."""
    rows = _rows(docs)
    told = labels.filter("doc_id is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.when((F.col("quality") == 0) | (F.col("toxic") > 0), 1.0)
         .when((F.col("quality") > 0) & (F.col("toxic") == 0), 0.0).alias("bad"))
    told = told.filter("bad is not null").groupBy("doc_id").agg(F.max("bad").alias("bad"))
    sample = told.orderBy(F.xxhash64(F.lit("fit"), "doc_id"), "doc_id").limit(label_sample).collect()
    bad_of = {r.doc_id: r.bad for r in sample}
    if len(set(bad_of.values())) < 2:
        return None
    spark = docs.sparkSession

    def features_of(keys: list[tuple], cols: str, on: list[str]) -> Rows:
        few = F.broadcast(spark.createDataFrame(keys, cols))  # at most label_sample or exchange rows
        first = F.row_number().over(W.partitionBy(*on).orderBy("rk"))  # one row for each key, however often it occurs
        return _features(rows.join(few, on, "left_semi").withColumn("place", first).filter("place = 1").drop("place"))

    base = features_of([(k,) for k in bad_of], "doc_id long", ["doc_id"])
    bad = np.array([bad_of[k] for k in base.key[:, 0]])
    held = np.array([hashlib.blake2b(str(k).encode(), digest_size=1).digest()[0] % 4 == 0 for k in base.key[:, 0]], bool)
    if len(set(bad[~held])) < 2 or len(set(bad[held])) < 2:  # too few labels to hold some out
        held = np.zeros(len(bad), bool)
    if len(set(bad)) < 2:
        return None
    fit_on, calibrate = np.flatnonzero(~held), np.flatnonzero(held) if held.any() else np.arange(len(bad))
    extra: dict[str, list[tuple[Rows, np.ndarray]]] = {"text": [], "meta": []}
    taken: set[int] = set()

    def train(name: str, view: View) -> View:
        sets = [(base.view(name, fit_on), bad[fit_on], np.ones(len(fit_on)))]
        for got, y in extra[name]:
            sets.append((got.view(name, np.arange(len(y))), y, np.full(len(y), 0.5)))
        ptr = np.concatenate([np.zeros(1, np.int64), np.cumsum(np.concatenate([np.diff(s[0].ptr) for s in sets]))])
        f = Features(ptr, np.concatenate([s[0].ids for s in sets]), np.concatenate([s[0].dense for s in sets]))
        view = replace(view, slope=1.0, shift=0.0).fit(f, *(np.concatenate([s[i] for s in sets]) for i in (1, 2)))
        a, b = _logistic(view.raw(base.view(name, calibrate))[:, None], bad[calibrate])
        return replace(view, slope=float(a), shift=float(b))

    text, meta = View(text_view), View(meta_view, words=300)
    for turn in range(rounds + 1):
        text, meta = train("text", text), train("meta", meta)
        if turn == rounds:
            break
        scored = save(_scored(rows, Model(text, meta, np.array([1.0, 0.0, 0.0]))), "quality-round")
        for col, other in (("p_text", "meta"), ("p_meta", "text")):
            for y in (1.0, 0.0):
                pick = surest(scored, told, taken, col, y, sure, exchange, turn)
                if pick:
                    got = features_of(sorted(pick), "doc_id long, rk long", ["doc_id", "rk"])
                    extra[other].append((got, np.full(len(got.key), y)))
                    taken |= {rk for _, rk in pick}
    t, m = text.logit(base.view("text", calibrate)), meta.logit(base.view("meta", calibrate))
    return Model(text, meta, _logistic(np.stack([t, m], 1), bad[calibrate]))


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, **fit) -> DataFrame:
    """(doc_id, rk, p_text, p_meta, score, keep) of every document.

    ``score`` is the combined chance that the document is good; a document
    whose chance of being bad reaches ``threshold`` is not kept.  ``rk`` is the
    hash of its text; ``fit`` goes to ``co_train``.
    """
    model = co_train(docs, labels, **fit)
    if model is None:
        return _rows(docs).select(real_id().alias("doc_id"), "rk", *(F.lit(None).cast("double").alias(c) for c in ("p_text", "p_meta", "score")),
                                  F.lit(True).alias("keep"))
    return _scored(_rows(docs), model).select(
        real_id().alias("doc_id"), "rk", "p_text", "p_meta", (1 - F.col("p_bad")).alias("score"), (F.col("p_bad") < threshold).alias("keep"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, **fit) -> DataFrame:
    """The rows of ``docs`` that are kept, all columns; no shuffle of the texts."""
    model = co_train(docs, labels, **fit)
    if model is None:
        return docs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            yield b.filter(pa.array(model.chances(b)[2] < threshold))

    return map_arrow(docs, run, docs.schema)
