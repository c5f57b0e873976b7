"""Hard negatives by anchor-clustered shared lists.

Anchors are clustered by angle.  Each cluster shares one list of all rows, sorted by
an upper bound on the score that any of its anchors can reach: with the row's angle
t to the cluster's centre and the widest angle w of an anchor to it, a row scores at
most |row| cos(max(0, t - w)) for an anchor of length one.  Every member walks its
list from the top and stops when the bound of what is left lies below the worst
score that it still needs; that certifies its answer as exact.

The lists are not built whole.  They are cut by bound into segments (``cuts``), and a
segment into cells of about ``cell_rows`` rows, dealt by hash.  A cell holds its rows
in list order and lets the open anchors of the cluster walk them, a few hundred at a
time.  After a segment the anchors' best rows are merged; anchors certified by the
segment's lowest bound are done, the others go on to the next segment.  A first walk
finds each anchor's positives, a second one all its bands of negatives at once.

Bounded samples: centres and cuts come from at most ``sample`` anchors and rows in
hash order; any centres and cuts give the same result.

Scores are exact integers.  Defined results: rows with a null vec_id, label or
vector, a null or non-finite component, or components (after scaling and rounding
down) whose squares sum to 2^55 or more, whose scores a long need not hold, take no
part; vectors of different length do not meet; rows equal in vec_id, label and vector
count once, and no row of an anchor's vec_id is its positive or negative; anchors
without positives, and positives without negatives in their band, give no row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from daybook.llm.common import map_arrow, save

_LOW = -(1 << 62)
#: Squares of a row's integers sum to less than this.
_MOST = float(1 << 55)
#: A row of a cell: its own columns, or an anchor's with its bands.
_CELL = "dim int, cluster int, cell long, kind int, bound double, vec_id long, rk long, label string, v binary, need array<long>, most array<long>"


def _packed(rows: DataFrame, scale: float) -> DataFrame:
    """(vec_id, rk, label, dim, v, norm, anchor): vectors as little-endian 32-bit integers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            col = b.column("embedding")
            off = np.asarray(col.offsets)
            flat = np.floor(scale * col.values.to_numpy(zero_copy_only=False).astype("<f8"))  # a null becomes NaN
            keep, out, norm = [], [], []
            for i in range(len(col)):
                x = flat[off[i]:off[i + 1]]
                with np.errstate(over="ignore", invalid="ignore"):
                    square = float((x * x).sum())
                if col[i].is_valid and square < _MOST:  # not for NaN
                    keep.append(i)
                    out.append(x.astype("<i4").tobytes())
                    norm.append(square ** 0.5)
            at = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_pydict({
                "vec_id": b.column("vec_id").take(at), "label": b.column("label").take(at), "anchor": b.column("anchor").take(at),
                "dim": pa.array([len(x) // 4 for x in out], pa.int32()), "v": pa.array(out, pa.binary()), "norm": pa.array(norm, pa.float64())})

    out = map_arrow(rows, run, "vec_id long, label string, anchor boolean, dim int, v binary, norm double")
    return out.dropDuplicates(["vec_id", "label", "v"]).withColumn("rk", F.xxhash64("vec_id", "label", "v"))


def _ints(packed: list[bytes], dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(packed), "<i4").reshape(len(packed), dim) if dim else np.zeros((len(packed), 0), "<i4")


def _unit(v: np.ndarray) -> np.ndarray:
    v = v.astype(np.float64)
    n = np.sqrt((v * v).sum(1, keepdims=True))
    return v / np.where(n > 0, n, 1)


def _centres(v: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means from spread-out starts."""
    v = _unit(v)
    centres = v[:1]
    while len(centres) < k:
        near = (v @ centres.T).max(1)
        if near.min() > 1 - 1e-9:
            break
        centres = np.vstack([centres, v[near.argmin()]])
    for _ in range(rounds):
        own = (v @ centres.T).argmax(1)
        centres = _unit(np.stack([v[own == c].sum(0) if (own == c).any() else centres[c] for c in range(len(centres))]))
    return centres


def _angles(v: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(_unit(v) @ centres.T, -1, 1))


class Lists:
    """What the lists need: for each dimension of the sample, the clusters' centres,
    widest angles and segment cuts.  Another dimension has one cluster whose bound is
    the row's length and one segment."""

    def __init__(self, centres: dict[int, np.ndarray]):
        self.centres, self.wide, self.cuts = centres, {}, {}

    def cluster(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each anchor's cluster and its angle to the centre."""
        dim = v.shape[1]
        if dim not in self.centres:
            return np.zeros(len(v), np.int64), np.full(len(v), np.pi)
        angles = _angles(v, self.centres[dim])
        own = angles.argmin(1)
        return own, angles[np.arange(len(v)), own]

    def bounds(self, v: np.ndarray, norm: np.ndarray) -> np.ndarray:
        """A row's bound in each cluster's list, rounded up beyond all rounding errors."""
        dim = v.shape[1]
        if dim not in self.centres:
            return norm[:, None] * (1 + 1e-9)
        slack = np.maximum(_angles(v, self.centres[dim]) - self.wide[dim] - 1e-6, 0)
        return norm[:, None] * (np.cos(slack) + 1e-9)

    def segments(self, bounds: np.ndarray, dim: int) -> np.ndarray:
        """The segment of each row in each list; a cut belongs to the segment above it."""
        cuts = self.cuts.get(dim)
        return np.zeros(bounds.shape, np.int64) if cuts is None else (bounds[:, :, None] < cuts[None]).sum(2)

    def lowest(self, dim: int, cluster: int, segment: int) -> float:
        """No row beyond the segment has a bound above this."""
        cuts = self.cuts.get(dim)
        return -np.inf if cuts is None or segment >= cuts.shape[1] else float(cuts[cluster, segment])


def _by_dim(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, int, np.ndarray]]:
    for b in batches:
        dims = b.column("dim").to_numpy()
        for dim in np.unique(dims).tolist():
            own = b.filter(pa.array(dims == dim))
            yield own, dim, _ints(own.column("v").to_pylist(), dim)


def _scores(a: np.ndarray, v: np.ndarray, exact: bool) -> np.ndarray:
    """Inner products as integers; in doubles where these hold every partial sum."""
    return (a @ v.T).astype(np.int64) if exact else a.astype(np.int64) @ v.astype(np.int64).T


def _walk(anchors: list[tuple], rows: dict, take: int, same: bool, block: int = 2048) -> Iterator[tuple[np.ndarray, ...]]:
    """(anchor, band, score, row) of the best ``take`` rows of each band of each anchor
    (vec_id, rk, label, vector, need, most): rows of its label (or of others) that score
    ``need`` to ``most``; rows come in list order."""
    a = _ints([x[3] for x in anchors], rows["v"].shape[1])
    own, label = np.array([x[0] for x in anchors]), np.array([rows["labels"].get(x[2], -1) for x in anchors])
    wide = max(len(x[4]) for x in anchors)
    need = np.array([[*x[4], *[1] * (wide - len(x[4]))] for x in anchors], np.int64)
    most = np.array([[*x[5], *[0] * (wide - len(x[5]))] for x in anchors], np.int64)
    norm = np.sqrt((a.astype(np.float64) ** 2).sum(1))
    exact = norm.max() * rows["norm"].max() < 1 << 53
    a, v = (a.astype(np.float64), rows["f"]) if exact else (a, rows["v"])
    best = np.zeros((0, 3), np.int64)  # walker, score, row
    for lo in range(0, len(v), block):
        going = (need <= most) & (need <= (norm * rows["bound"][lo])[:, None])
        live = np.flatnonzero(going.any(1))
        if not len(live):
            break
        hi = min(len(v), lo + block)
        s = _scores(a[live], v[lo:hi], exact)
        able = (rows["label"][lo:hi] == label[live, None]) == same
        able &= rows["vec_id"][lo:hi] != own[live, None]
        for band in range(wide):
            i, j = np.nonzero(able & going[live, band, None] & (s >= need[live, band, None]) & (s <= most[live, band, None]))
            if not len(i):
                continue
            walker = live[i] * wide + band
            new = np.stack([walker, s[i, j], rows["vec_id"][lo + j]], 1)
            touched = np.isin(best[:, 0], walker)
            own_best = np.concatenate([best[touched], new])
            own_best = own_best[np.lexsort((own_best[:, 2], -own_best[:, 1], own_best[:, 0]))]
            begin = np.searchsorted(own_best[:, 0], own_best[:, 0])
            place = np.arange(len(own_best)) - begin
            own_best = own_best[place < take]
            last = own_best[(place[place < take]) == take - 1]
            need[last[:, 0] // wide, band] = last[:, 1]
            best = np.concatenate([best[~touched], own_best])
    yield best[:, 0] // wide, best[:, 0] % wide, best[:, 1], best[:, 2]


def _segment(rows: DataFrame, anchors: DataFrame, lists: Lists, counts: DataFrame, segment: int, take: int, same: bool,
             cell_rows: int) -> DataFrame:
    """(vec_id, rk, band, score, other): the best rows of each band of the open anchors
    (vec_id, rk, label, dim, v, cluster, need, most) in one segment of their lists."""
    clusters = anchors.select("dim", "cluster").distinct()
    known = list(lists.centres)
    going = {(r.dim, r.cluster) for r in clusters.filter(F.col("dim").isin(known)).collect()}  # at most centres

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, dim, v in _by_dim(batches):
            bounds = lists.bounds(v, b.column("norm").to_numpy())
            mine = lists.segments(bounds, dim) == segment
            if dim in lists.centres:
                mine &= np.array([(dim, c) in going for c in range(bounds.shape[1])])
            i, c = np.nonzero(mine)
            for x in range(0, len(i), 8192):
                at = pa.array(i[x:x + 8192])
                yield pa.RecordBatch.from_pydict({
                    **{name: b.column(name).take(at) for name in ("dim", "vec_id", "rk", "label", "v")},
                    "cluster": pa.array(c[x:x + 8192], pa.int32()), "bound": bounds[i[x:x + 8192], c[x:x + 8192]]})

    kinds = "dim int, vec_id long, rk long, label string, v binary, cluster int, bound double"
    cells = counts.filter(F.col("segment") == segment).join(clusters, ["dim", "cluster"], "left_semi").select(
        "dim", "cluster", F.ceil(F.col("n") / cell_rows).alias("cells"))
    none = F.lit(None).cast("array<long>")
    dealt = map_arrow(rows, deal, kinds).join(cells, ["dim", "cluster"]).select(
        "dim", "cluster", F.pmod("rk", "cells").alias("cell"), F.lit(0).alias("kind"), "bound", "vec_id", "rk", "label", "v",
        none.alias("need"), none.alias("most"))
    walkers = anchors.join(cells, ["dim", "cluster"]).select(
        "dim", "cluster", F.explode(F.sequence(F.lit(0).cast("long"), F.col("cells") - 1)).alias("cell"), F.lit(1).alias("kind"),
        F.lit(0.0).alias("bound"), "vec_id", "rk", "label", "v", "need", "most")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, loaded, waiting = None, [], None, []

        def load() -> dict:
            codes: dict[str, int] = {}
            v = _ints([x[3] for x in held], key[0])
            f = v.astype(np.float64)
            return {"v": v, "f": f, "norm": np.sqrt((f * f).sum(1)), "vec_id": np.array([x[1] for x in held]),
                    "bound": np.array([x[0] for x in held]), "labels": codes,
                    "label": np.array([codes.setdefault(x[2], len(codes)) for x in held])}

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal loaded, waiting
            if held and waiting:
                loaded = loaded or load()
                for i, band, score, other in _walk(waiting, loaded, take, same):
                    yield pa.RecordBatch.from_pydict({
                        "vec_id": pa.array([waiting[x][0] for x in i], pa.int64()), "rk": pa.array([waiting[x][1] for x in i], pa.int64()),
                        "band": pa.array(band, pa.int32()), "score": score, "other": other})
            waiting = []

        for b in batches:
            for r in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if r[:3] != key:
                    yield from flush()
                    key, held, loaded = r[:3], [], None
                if r[3] == 0:
                    held.append((r[4], r[5], r[7], r[8]))
                else:
                    waiting.append((r[5], r[6], r[7], r[8], r[9], r[10]))
                    if len(waiting) == 256:
                        yield from flush()
        yield from flush()

    size = cells.agg(F.sum("cells")).first()[0] or 0
    parts = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), int(size))
    cellwise = dealt.unionByName(walkers).repartition(parts, "dim", "cluster", "cell").sortWithinPartitions(
        "dim", "cluster", "cell", "kind", F.col("bound").desc(), "vec_id").select(*[x.split()[0] for x in _CELL.split(", ")])
    return map_arrow(cellwise, run, "vec_id long, rk long, band int, score long, other long")


def _search(rows: DataFrame, anchors: DataFrame, lists: Lists, counts: DataFrame, take: int, same: bool, cell_rows: int,
            segments: int, name: str) -> DataFrame:
    """(vec_id, rk, band, score, other, place): the first ``take`` rows of each band of
    each anchor (vec_id, rk, label, dim, v, norm, cluster, lows, highs)."""
    order = W.partitionBy("vec_id", "rk", "band").orderBy(F.col("score").desc(), "other")
    left = anchors.select("*", F.col("lows").alias("need"), F.col("highs").alias("most"))
    found = None
    for segment in range(segments):
        got = _segment(rows, left, lists, counts, segment, take, same, cell_rows)
        found = got if found is None else found.drop("place").unionByName(got)
        found = save(found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= take), f"{name}-{segment}")
        if segment == segments - 1:
            break
        lowest = {(d, c): lists.lowest(d, c, segment) for d, x in lists.centres.items() for c in range(len(x))}
        beyond = F.create_map(*[y for (d, c), x in lowest.items() for y in (F.lit(f"{d}:{c}"), F.lit(x))]) if lowest else None
        bound = F.lit(float("-inf")) if beyond is None else \
            F.coalesce(F.try_element_at(beyond, F.concat_ws(":", "dim", "cluster")), F.lit(float("-inf")))
        # a full band needs its worst score or better from now on
        full = found.filter(F.col("place") == take).groupBy("vec_id", "rk").agg(
            F.map_from_entries(F.collect_list(F.struct("band", "score"))).alias("worst"))
        need = F.transform("lows", lambda x, i: F.greatest(x, F.coalesce(F.try_element_at("worst", i), x)))
        left = anchors.join(full, ["vec_id", "rk"], "left").withColumn("need", need).withColumn("most", F.col("highs"))
        still = F.exists(F.arrays_zip("need", "most"), lambda x: (x["need"] <= x["most"]) & (x["need"] <= F.col("norm") * F.col("__beyond")))
        left = save(left.withColumn("__beyond", bound).filter(still).drop("__beyond", "worst"), f"{name}-open-{segment}")
        if left.isEmpty():
            break
    return found


def hard_negatives(rows: DataFrame, anchor: Column, scale: float = 256.0, positives: int = 5, negatives: int = 10, low: int = 30,
                   high: int = 90, clusters: int = 4, cuts: tuple[float, ...] = (1 / 64, 1 / 8),
                   cell_rows: int = 16_384, sample: int = 2048) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``rows``: (vec_id, label, embedding); ``anchor`` tells the anchors.  Components
    become floor(scale * x); scores are inner products, ties go by vec_id.  An anchor's
    positives are its first ``positives`` rows of its label; a positive's negatives are
    the anchor's first ``negatives`` rows of other labels that score ``low`` to ``high``
    per cent of the positive.

    ``clusters``: each list that is walked to its end copies every row once, so their
    number stays the same at every size; more of them pay where anchors lie so close
    together that walks end early.
    """
    packed = save(_packed(rows.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"),
        F.col("embedding").cast("array<double>").alias("embedding"), F.coalesce(anchor, F.lit(False)).alias("anchor"))
        .filter("vec_id is not null and label is not null"), scale), "negatives-rows")
    anchors = packed.filter("anchor")

    def sampled(df: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        got: dict[int, list] = {}
        for r in df.orderBy("rk", "vec_id").select("dim", "v", "norm").limit(sample).collect():
            got.setdefault(r.dim, []).append((bytes(r.v), r.norm))
        return {d: (_ints([x for x, _ in own], d), np.array([n for _, n in own])) for d, own in got.items() if d}

    lists = Lists({d: _centres(v, clusters) for d, (v, _) in sampled(anchors).items()})

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, _, v in _by_dim(batches):
            own, angle = lists.cluster(v)
            yield pa.RecordBatch.from_pydict({**{c: b.column(c) for c in ("vec_id", "rk", "label", "dim", "v", "norm")},
                                              "cluster": pa.array(own, pa.int32()), "angle": angle})

    placed = save(map_arrow(anchors, assign, "vec_id long, rk long, label string, dim int, v binary, norm double, cluster int, angle double"),
                  "negatives-anchors")
    lists.wide = {d: np.zeros(len(c)) for d, c in lists.centres.items()}
    for r in placed.filter(F.col("dim").isin(list(lists.centres))).groupBy("dim", "cluster").agg(F.max("angle").alias("w")).collect():
        lists.wide[r.dim][r.cluster] = r.w
    for d, (v, norm) in sampled(packed).items():
        if d in lists.centres:
            lists.cuts[d] = np.quantile(lists.bounds(v, norm), [1 - x for x in cuts], axis=0).T.copy()
    segments = len(cuts) + 1

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, dim, v in _by_dim(batches):
            own = lists.segments(lists.bounds(v, b.column("norm").to_numpy()), dim)
            key, n = np.unique((np.arange(own.shape[1]) * segments + own).ravel(), return_counts=True)
            yield pa.RecordBatch.from_pydict({"dim": pa.array([dim] * len(key), pa.int32()), "cluster": pa.array(key // segments, pa.int32()),
                                              "segment": pa.array(key % segments, pa.int32()), "n": n})

    counts = save(map_arrow(packed, count, "dim int, cluster int, segment int, n long").groupBy("dim", "cluster", "segment")
                  .agg(F.sum("n").alias("n")), "negatives-cells")
    any_score = {"lows": F.array(F.lit(_LOW)), "highs": F.array(F.lit(-_LOW))}
    pos = _search(packed, placed.withColumns(any_score), lists, counts, positives, True, cell_rows, segments, "positives")
    bands = pos.groupBy("vec_id", "rk").agg(F.array_sort(F.collect_list(F.struct("place", "score"))).alias("own")).select(
        "vec_id", "rk", F.transform("own", lambda x: F.ceil((x["score"] * low).cast("decimal(38,0)") / 100).cast("long")).alias("lows"),
        F.transform("own", lambda x: F.floor((x["score"] * high).cast("decimal(38,0)") / 100).cast("long")).alias("highs"))
    seeking = save(placed.join(bands, ["vec_id", "rk"]), "negatives-bands")
    neg = _search(packed, seeking, lists, counts, negatives, False, cell_rows, segments, "negatives")
    first = pos.select("vec_id", "rk", (F.col("place") - 1).alias("band"), F.col("other").alias("positive_id"), F.col("score").alias("positive_score"))
    return neg.join(first, ["vec_id", "rk", "band"]).select(
        F.col("vec_id").alias("anchor_id"), "positive_id", F.col("place").cast("int").alias("rank"), F.col("other").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"))
