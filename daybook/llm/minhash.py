"""MinHash near-dedup by ProbMinHash.

A document is the bag of its runs of five words, weighted by how often they
occur.  Similarity is probability Jaccard: the sum over common shingles i of
1 / sum_j max(x_j / x_i, y_j / y_i), which for equal weights is plain Jaccard.

Signature: every shingle sends Poisson arrivals at a rate equal to its weight
to random registers; a register keeps the first to arrive.  A shingle stops as
soon as its next arrival is later than all registers of its document, so a
document costs about (shingles + m log m) arrivals.  Two registers agree with
a probability equal to the similarity.

Candidates: registers are cut into bands; equal bands are a bucket.  In each
bucket the members are verified against the smallest id, which joins most of
them into classes.  Buckets whose members are still in several classes are then
searched whole, in cells of at most 2 x ``block`` members (every pair of a large
bucket's blocks is a cell): the members' registers are compared with each other,
pairs of one class or in an earlier common bucket are left out, and the others are
verified, the most alike first; a pair that a verified link has meanwhile joined
needs no look.  A cell returns only the links that join classes, never pairs.
Pairs whose registers agree in less than ``screen`` (four standard deviations
below the threshold) count as too different.

Defined results: rows with one doc_id are one document and share its class; a
document of one to four words has all its words as its one shingle; null and
empty texts have no shingles and link with nothing; rows without a doc_id take part
under a number from their text (``own_id``), so equal texts without an id are one
document, and a class of such rows only is named by the smallest of these numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from daybook.llm.common import map_arrow, save, slices
from daybook.llm.components import components
from daybook.llm.words import mix, rolling, span_hashes, split_words

_STEP = 0x9E3779B97F4A7C15
_BITS = np.uint64(52)
_LOW = np.uint64((1 << 52) - 1)


def shingles(texts: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each of up to 4096 texts: (text, 52-bit hash,
    count), and two hashes of the whole word sequence of each text."""
    w = split_words(texts)
    h, doc = w.hashes(), w.doc()
    run = rolling(h, k)
    ok = doc[:len(run)] == doc[k - 1:]
    whole = span_hashes(h, w.ptr[:-1], w.ptr[1:])
    size = np.diff(w.ptr)
    short = np.flatnonzero((size > 0) & (size < k))
    doc = np.concatenate([doc[:len(run)][ok], short])
    run = np.concatenate([run[ok], whole[0][short]])
    # text (12 bits) above hash (52 bits): one sort of plain integers
    both = np.sort((doc.astype(np.uint64) << _BITS) | (run >> np.uint64(12)))
    new = np.ones(len(both), bool)
    new[1:] = both[1:] != both[:-1]
    at = np.flatnonzero(new)
    key = both[at]
    return (key >> _BITS).astype(np.int64), key & _LOW, np.diff(np.append(at, len(both))), *whole


def probminhash(doc: np.ndarray, h: np.ndarray, weight: np.ndarray, n: int, m: int) -> np.ndarray:
    """n x m registers: the shingle that arrives first in each.  ``doc`` ascends."""
    best, who = np.full(n * m, np.inf), np.zeros(n * m, np.uint64)
    t, k = np.zeros(len(h)), 0
    doc = doc.astype(np.int64)
    while len(h):
        k += 1
        u = mix(h + np.uint64(k * _STEP & 0xFFFFFFFFFFFFFFFF))
        # 40 bits tell the waiting time, 24 the register
        t = t - np.log(((u >> np.uint64(24)) + 0.5) * 2.0 ** -40) / weight
        at = doc * m + (((u & np.uint64(0xFFFFFF)) * np.uint64(m)) >> np.uint64(24)).astype(np.int64)
        np.minimum.at(best, at, t)
        won = t == best[at]
        who[at[won]] = h[won]
        new = np.ones(len(doc), bool)
        new[1:] = doc[1:] != doc[:-1]
        go = t < best.reshape(n, m)[doc[new]].max(1)[np.cumsum(new) - 1]
        doc, h, weight, t = doc[go], h[go], weight[go], t[go]
    return who.reshape(n, m)


def similarity(pair: np.ndarray, x: np.ndarray, y: np.ndarray, n: int) -> np.ndarray:
    """Probability Jaccard of n pairs from rows (pair, weight in one, in the
    other), zero where a shingle is missing."""
    with np.errstate(divide="ignore"):
        ratio = np.where(y > 0, x / np.maximum(y, 1e-300), np.inf)
    order = np.lexsort((ratio, pair))
    pair, ratio, x, y = pair[order], ratio[order], x[order], y[order]
    first = np.searchsorted(pair, np.arange(n + 1))
    new = np.ones(len(pair), bool)
    new[1:] = (pair[1:] != pair[:-1]) | (ratio[1:] != ratio[:-1])
    begin = np.maximum.accumulate(np.where(new, np.arange(len(pair)), 0))
    cx, cy = (np.concatenate([[0.0], np.cumsum(v)]) for v in (x, y))
    both = (x > 0) & (y > 0)
    lower, upper = cy[begin] - cy[first[pair]], cx[first[pair + 1]] - cx[begin]
    part = np.zeros(len(pair))
    part[both] = 1 / (upper[both] / x[both] + lower[both] / y[both])
    return np.bincount(pair, part, n)


def _alike(da, ha, ca, db, hb, cb, n: int) -> np.ndarray:
    """Similarity of n pairs from the shingles (pair, hash, count) of both sides."""
    pair, h = np.concatenate([da, db]), np.concatenate([ha, hb])
    x = np.concatenate([ca, np.zeros(len(cb))]).astype(float)
    y = np.concatenate([np.zeros(len(ca)), cb]).astype(float)
    order = np.lexsort((h, pair))
    pair, h, x, y = pair[order], h[order], x[order], y[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (pair[1:] != pair[:-1])
    at = np.flatnonzero(new)
    if not len(at):
        return np.zeros(n)
    return similarity(pair[at], np.add.reduceat(x, at), np.add.reduceat(y, at), n)


def pair_similarity(a: pa.Array, b: pa.Array, k: int) -> np.ndarray:
    return _alike(*shingles(a, k)[:3], *shingles(b, k)[:3], len(a))


def _cell(rows: list[dict], k: int, least: float, screen: float) -> list[tuple[int, int]]:
    """Links that join the classes of a cell's members."""
    ids = np.array([r["doc_id"] for r in rows])
    sig = np.stack([np.frombuffer(r["sig"], "<u2") for r in rows])
    bands = np.array([r["bands"] for r in rows])
    here = int(np.flatnonzero(bands[0] == rows[0]["key"])[0])
    left, right = (np.array([r[c] for r in rows]) for c in ("left", "right"))
    root = {r["label"]: r["label"] for r in rows}
    label = [r["label"] for r in rows]

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    found, step = [], max(1, (1 << 25) // sig.size)
    for a in range(0, len(rows), step):
        agree = (sig[a:a + step, None, :] == sig[None, :, :]).mean(2)
        i, j = np.nonzero(agree >= screen)
        ok = (i + a < j) & ((left[i + a] & right[j]) | (right[i + a] & left[j]))
        share, i, j = agree[i, j][ok], i[ok] + a, j[ok]
        ok = ~(bands[i, :here] == bands[j, :here]).any(1)  # met in an earlier bucket otherwise
        found.append(np.stack([share[ok], i[ok], j[ok]]))
    found = np.concatenate(found, 1)
    pairs = found[1:, np.argsort(-found[0], kind="stable")].astype(np.int64).T.tolist()
    own: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def bag(i: int) -> tuple[np.ndarray, np.ndarray]:
        if i not in own:
            own[i] = shingles(pa.array([rows[i]["text"]]), k)[1:3]
        return own[i]

    links, at = [], 0
    while at < len(pairs):
        # a few pairs of different classes at a time, so that their links spare others
        some = []
        while at < len(pairs) and len(some) < 64:
            i, j = pairs[at]
            if find(label[i]) != find(label[j]):
                some.append((i, j))
            at += 1
        if not some:
            break
        sides = []
        for side in (0, 1):
            bags = [bag(p[side]) for p in some]
            sides += [np.repeat(np.arange(len(some)), [len(x[0]) for x in bags]), *(np.concatenate([x[c] for x in bags]) for c in (0, 1))]
        for (i, j), s in zip(some, _alike(*sides, len(some)).tolist(), strict=True):
            x, y = find(label[i]), find(label[j])
            if s >= least - 1e-12 and x != y:
                root[max(x, y)] = min(x, y)
                links.append((int(ids[i]), int(ids[j])))
    return links


def _search(members: DataFrame, prints: DataFrame, rows: DataFrame, k: int, least: float, screen: float, block: int) -> DataFrame:
    """Links between classes inside the buckets of (key, doc_id, label, n)."""
    # for each id one signature and one text; an id with several of them brings each pair
    wide = members.join(prints.select("doc_id", "h1", "h2", "sig", "bands"), ["doc_id", "h1", "h2"])
    ids = save(members.select("doc_id").distinct(), "search-ids")
    texts = save(rows.join(ids, "doc_id", "left_semi"), "search-texts")
    blocks = F.ceil(F.col("n") / block).cast("int")
    own = F.pmod(F.xxhash64("doc_id"), blocks).cast("int")
    cells = F.transform(F.sequence(F.lit(0), blocks - 1),
                        lambda o: F.struct(F.least(own, o).alias("i"), F.greatest(own, o).alias("j")))
    dealt = wide.join(texts, "doc_id").withColumn("own", own).withColumn("cell", F.explode(cells)).select(
        "key", F.col("cell.i").alias("i"), F.col("cell.j").alias("j"), "doc_id", "label", "sig", "bands", "text",
        (F.col("own") == F.col("cell.i")).alias("left"), (F.col("own") == F.col("cell.j")).alias("right"))
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, own = None, []

        def done() -> pa.RecordBatch:
            got = _cell(own, k, least, screen) if len(own) > 1 else []
            return pa.RecordBatch.from_pydict({"a": pa.array([g[0] for g in got], pa.int64()), "b": pa.array([g[1] for g in got], pa.int64())})

        for b in batches:
            for r in b.to_pylist():
                if (r["key"], r["i"], r["j"]) != key:
                    if own:
                        yield done()
                    key, own = (r["key"], r["i"], r["j"]), []
                own.append(r)
        if own:
            yield done()

    sorted_ = dealt.repartition(parts, "key", "i", "j").sortWithinPartitions("key", "i", "j")
    return save(map_arrow(sorted_, run, "a long, b long"), "class-links")


def signatures(rows: DataFrame, k: int, bands: int, width: int) -> DataFrame:
    """(doc_id, h1, h2, bands, sig) of each row with words: two hashes of its word
    sequence, the band hashes of its registers, and 16 bits of each register."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            doc, h, count, h1, h2 = shingles(b.column("text"), k)
            has = np.unique(doc)
            # copies inside the batch need no second signature
            _, first, of = np.unique(np.stack([h1[has], h2[has]], 1), axis=0, return_index=True, return_inverse=True)
            of = of.reshape(-1)
            slot = np.full(b.num_rows, -1)
            slot[has[first]] = np.arange(len(first))
            use = slot[doc] >= 0
            by = np.argsort(slot[doc[use]], kind="stable")
            reg = probminhash(slot[doc[use]][by], h[use][by], count[use][by], len(first), bands * width)
            key = np.broadcast_to(mix(np.arange(1, bands + 1, dtype=np.uint64)), (len(first), bands))
            for j in range(width):
                key = mix(key * np.uint64(_STEP) + reg[:, j::width][:, :bands])
            key = key.view(np.int64)[of]
            sig = [x.tobytes() for x in (mix(reg) & np.uint64(0xFFFF)).astype("<u2")]
            yield pa.RecordBatch.from_pydict({
                "doc_id": b.column("doc_id").take(pa.array(has)), "h1": h1.view(np.int64)[has], "h2": h2.view(np.int64)[has],
                "bands": pa.ListArray.from_arrays(pa.array(np.arange(len(has) + 1) * bands, pa.int32()), pa.array(key.reshape(-1))),
                "sig": pa.array(sig, pa.binary()).take(pa.array(of))})

    return map_arrow(rows, run, "doc_id long, h1 long, h2 long, bands array<long>, sig binary")


def verify(pairs: DataFrame, rows: DataFrame, k: int, least: float) -> DataFrame:
    """The pairs (a, b) whose texts reach the similarity, with it."""
    ids = save(pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct(), "pair-ids")
    texts = save(rows.join(ids, "doc_id", "left_semi").select("doc_id", "text"), "pair-texts")
    both = (pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("ta")), "a")
            .join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("tb")), "b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "ta", 2 << 20):
            s = pair_similarity(b.column("ta"), b.column("tb"), k)
            ok = np.flatnonzero(s >= least - 1e-12)
            yield pa.RecordBatch.from_pydict({"a": b.column("a").take(pa.array(ok)), "b": b.column("b").take(pa.array(ok)), "sim": s[ok]})

    return save(map_arrow(both, run, "a long, b long, sim double"), "links")


def own_id(doc_id: str = "doc_id", text: str = "text") -> Column:
    """A document's id; without one, a number of 2^62 or more from its text, so that a
    class with ids is still named by the smallest of them."""
    from_text = F.xxhash64(F.coalesce(F.col(text).cast("string"), F.lit(""))).bitwiseAND((1 << 62) - 1) + F.lit(1 << 62)
    return F.coalesce(F.col(doc_id).cast("long"), from_text)


def near_duplicates(docs: DataFrame, k: int = 5, least: float = 0.8, bands: int = 26, width: int = 5,
                    screen: float = 0.66, block: int = 1024) -> DataFrame:
    """(doc_id, class_id) of each document; ``class_id`` is the smallest doc_id of its
    class of linked documents.  Documents without an id take part under ``own_id``: one
    row for each of their distinct texts."""
    out = _classes(docs, k, least, bands, width, screen, block)
    return out.select(F.when(F.col("doc_id") < F.lit(1 << 62), F.col("doc_id")).alias("doc_id"), "class_id")


def _classes(docs: DataFrame, k: int = 5, least: float = 0.8, bands: int = 26, width: int = 5, screen: float = 0.66,
             block: int = 1024) -> DataFrame:
    """(doc_id, class_id) with ``own_id`` as doc_id."""
    rows = docs.select(own_id().alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    prints = save(signatures(rows, k, bands, width), "signatures")
    copies = save(prints.groupBy("h1", "h2").agg(F.min("doc_id").alias("rep")), "copies")
    same = save(prints.select("doc_id", "h1", "h2").join(copies, ["h1", "h2"]).filter("doc_id <> rep")
                .select(F.col("doc_id").alias("a"), F.col("rep").alias("b")).distinct(), "same")
    # one member for each text: the row of its smallest id
    reps = save(prints.join(copies.withColumnRenamed("rep", "doc_id"), ["h1", "h2", "doc_id"], "left_semi")
                .dropDuplicates(["h1", "h2"]), "one-of-copies")
    keyed = reps.select("doc_id", "h1", "h2", F.explode("bands").alias("key"))
    shared = save(keyed.groupBy("key").agg(F.count("*").alias("n"), F.min("doc_id").alias("pivot")).filter("n > 1"), "buckets")
    members = save(keyed.join(shared, "key"), "members")
    pairs = save(members.filter("doc_id <> pivot").select(F.col("pivot").alias("a"), F.col("doc_id").alias("b")).distinct(), "pairs")
    links = verify(pairs, rows, k, least).select("a", "b")
    roots = save(components(links), "roots")
    labelled = save(members.join(roots, members.doc_id == roots.id, "left").select(
        "key", "n", "doc_id", "h1", "h2", F.coalesce("root", "doc_id").alias("label")), "labelled")
    mixed = save(labelled.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"))
                 .filter("low <> high").select("key"), "mixed")
    more = _search(labelled.join(mixed, "key"), reps, rows, k, least, screen, block)
    roots = save(components(links.union(more).union(same)), "roots")
    ids = rows.select("doc_id").distinct()
    return ids.join(roots, ids.doc_id == roots.id, "left").select("doc_id", F.coalesce("root", "doc_id").alias("class_id"))


def one_of_each(docs: DataFrame, **params) -> DataFrame:
    """The rows of ``docs``, all columns, that stand for their class: those of its
    smallest ``own_id`` (of several rows with that id, the one whose text has the
    smallest hash)."""
    gone = save(_classes(docs, **params).filter("doc_id <> class_id").select(F.col("doc_id").alias("id")), "gone")

    def matching(rows: DataFrame, ids: DataFrame, how: str) -> DataFrame:
        return rows.alias("d").join(ids.alias("i"), own_id("d.doc_id", "d.text") == F.col("i.id"), how)

    kept = matching(docs, gone, "left_anti")
    twice = save(docs.groupBy(own_id().alias("id")).agg(F.count("*").alias("rows")).filter("rows > 1").select("id"), "repeated-ids")
    if twice.isEmpty():
        return kept
    # the ids that have several rows
    whole = F.struct(*[F.col(f"d.`{c}`") for c in docs.columns]).alias("row")
    rank = F.row_number().over(W.partitionBy(own_id("row.doc_id", "row.text")).orderBy(F.xxhash64("row.text"), "row.text"))
    rare = matching(kept, twice, "left_semi").select(whole).select("row", rank.alias("rank")).filter("rank = 1").select("row.*")
    return matching(kept, twice, "left_anti").unionByName(rare)
