"""Periodic runs, packing and hard negatives, against plain Python on small inputs."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from daybook.llm import encoding, negatives, packing, runs
from daybook.llm.queries import op11_runs, tokenizer_path
from daybook.llm.words import split_words

DOC = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
MANY = settings(max_examples=150, deadline=None, phases=[Phase.generate], suppress_health_check=list(HealthCheck))
BYTES_BPE = tokenizer_path().replace("word_bpe_49k", "byte_bpe_50k")


def documents(spark, texts):
    return spark.createDataFrame([(i, t, "en", f"s{i % 3}", None) for i, t in enumerate(texts)], DOC)


# --- periodic runs

def plain_runs(words, least=6, exponent=4):
    found = {}
    for q in range(1, len(words) // exponent + 1):
        i = 0
        while i + q < len(words):
            s = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i - s + q >= max(least, exponent * q):
                found.setdefault((s, i - s + q), q)
            i += i == s
    return sorted((s, n, q) for (s, n), q in found.items())


def fibonacci(n):
    a, b = "a", "ab"
    while len(b) < n:
        a, b = b, b + a
    return list(b[:n])


def runs_of(texts, least=6, exponent=4):
    got = defaultdict(list)
    for t, *run in runs._of_batch(split_words(pa.array(texts)), least, exponent, most=50).tolist():
        got[t].append(tuple(run))
    return [got[i] for i in range(len(texts))]


WORDS = st.lists(st.sampled_from(["a", "b", "c"]), max_size=60)
REPEATS = st.builds(lambda u, k, cut, pre, post: pre + (u * k)[:len(u) * k - cut] + post,
                    st.lists(st.sampled_from("abcd"), min_size=1, max_size=9), st.integers(2, 9), st.integers(0, 4), WORDS, WORDS)


@MANY
@given(st.lists(st.one_of(WORDS, REPEATS), max_size=6))
def test_runs_are_those_of_a_plain_search(texts):
    assert runs_of([" ".join(t) for t in texts]) == [plain_runs(t) for t in texts]


@MANY
@given(st.lists(REPEATS, min_size=1, max_size=3))
def test_runs_of_three_periods(texts):
    assert runs_of([" ".join(t) for t in texts], 3, 3) == [plain_runs(t, 3, 3) for t in texts]


def test_runs_in_highly_periodic_texts():
    rng = random.Random(5)
    nested = ["x"] * 7 + ["y"]
    texts = [fibonacci(300), ["a"] * 5, ["a"] * 6, ["a"] * 500, nested * 9, (nested * 4 + ["z"]) * 5, [],
             [str(i % 37) for i in range(400)], [rng.choice("ab") for _ in range(500)]]
    assert runs_of([" ".join(t) for t in texts]) == [plain_runs(t) for t in texts]


def test_extensions_of_the_grammar():
    rng = random.Random(7)
    seq = np.array([100, *(rng.choice([0, 0, 0, 1, 2]) for _ in range(400)), 101], np.int64)
    g = runs.Grammar.build(seq, seq >= 100)
    i = np.array([rng.randrange(1, 400) for _ in range(2000)])
    j = np.array([rng.randrange(x + 1, 402) for x in i])

    def plain(x, y, step):
        n = 0
        while seq[x] == seq[y]:
            x, y, n = x + step, y + step, n + 1
        return n

    assert g.extension(i, j).tolist() == [plain(x, y, 1) for x, y in zip(i, j, strict=True)]
    assert g.extension(i, j, left=True).tolist() == [plain(x, y, -1) for x, y in zip(i, j, strict=True)]


def test_find_runs_rows_and_kept_words(spark):
    long_text = " ".join(f"w{i % 7}" for i in range(150_000))
    rows = [(1, "a a a a a a b", None, None, None), (1, "a a a a a a b", None, None, None), (None, None, None, None, None), (3, "", None, None, None),
            (4, " x\ty z\nx y z x y z x y\rz q ", None, None, None), (5, long_text, None, None, None), (6, "ü ü ü ü ü ü", None, None, None)]
    docs = spark.createDataFrame(rows, DOC).selectExpr("*", "'k' as kept", "1 as runs", "2 as n_words")
    got = Counter((r.doc_id, r.n_words, tuple(map(tuple, r.runs)), r.kept) for r in runs.find_runs(docs).collect())
    assert got == Counter([(1, 7, ((0, 6, 1),), "a b")] * 2 + [(None, 0, (), ""), (3, 0, (), ""), (4, 13, ((0, 12, 3),), "x y z q"),
                                                             (5, 150_000, ((0, 150_000, 7),), "w0 w1 w2 w3 w4 w5 w6"), (6, 6, ((0, 6, 1),), "ü")])
    assert runs.find_runs(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        runs.find_runs(docs, exponent=2)


def plain_planted(doc_id, text):
    words, h = WORD.findall(text or ""), zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i if i < a else a + (i - a) % p] for i in range(n)]


def test_runs_query_is_that_of_plain_python(spark, tmp_path):
    rng = random.Random(11)
    rows = [(i, " ".join(rng.choice(["a", "b", f"w{rng.randrange(40)}"]) for _ in range(rng.randrange(120))), "en", "s", 1) for i in range(150)]
    rows += [(None, "a a a a a a", "en", None, None), (-7, None, None, None, None)]
    spark.createDataFrame(rows, DOC).write.parquet(f"{tmp_path}/documents.parquet")
    want = []
    for d, t, *_ in rows:
        words = plain_planted(d, t)
        own = plain_runs(words)
        top = min(own, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
        gone = {i for s, n, q in own for i in range(s + q, s + n)}
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in (
            "".join(f"{s},{n},{q}\n" for s, n, q in own), " ".join(w for i, w in enumerate(words) if i not in gone))]
        want.append((d, len(own), *(top or (None,) * 3), top and 1000 * top[1] // top[2], *sha))
    got = op11_runs(spark, str(tmp_path))
    assert Counter(map(tuple, got.collect())) == Counter(want)
    assert any(r[1] for r in want)


# --- encoding

FUZZ = st.lists(st.sampled_from([*"ab'sS tT1 2.,-_dmrelLvV\n\té×÷Éßij̇́ Ω“”—<|>\x1c\x7f\x85\xa0İǅ日ก", "<|endoftext|>", "<|ENDOFTEXT|>", "'s", "'Ll"]),
                max_size=30).map("".join)


@MANY
@given(st.lists(FUZZ, max_size=8))
def test_ids_are_the_librarys(texts):
    from tokenizers import Tokenizer

    for path in (tokenizer_path(), BYTES_BPE):
        lib = Tokenizer.from_file(path)
        ids, ptr = encoding.encoder(path, "<u2").batch(pa.array(texts, pa.string()))
        assert [ids[a:b].tolist() for a, b in zip(ptr[:-1], ptr[1:], strict=True)] == [lib.encode(t, add_special_tokens=False).ids for t in texts]


def test_rules_and_types_come_from_the_file():
    assert encoding.by_pieces(tokenizer_path()) and not encoding.by_pieces(BYTES_BPE)
    assert encoding.id_type(tokenizer_path(), 1) == "<u2" and encoding.id_type(tokenizer_path(), 70_000) == "<u4"


def test_words_of_one_hash_get_codes_of_their_own(monkeypatch):
    w = split_words(pa.array(["a b a ccccccccccc b", "b ccccccccccd a" + " x" * 3 + " " + "y" * 100 + " " + "y" * 99 + "z"]))
    words = [bytes(w.buf[a:b]) for a, b in zip(w.start, w.end, strict=True)]
    for hashes in (None, lambda self: np.zeros(len(self), np.uint64)):
        if hashes:
            monkeypatch.setattr(type(w), "hashes", hashes)
        codes, first = encoding.word_codes(w)
        assert len(first) == len(set(words)) and all(words[first[c]] == x for c, x in zip(codes, words, strict=True))


# --- packing

def check_packing(spark, docs, texts, path, capacity, **params):
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(path)
    want = Counter(tuple([*lib.encode(t or "", add_special_tokens=False).ids, 1]) for t in texts)
    got = packing.packed(docs, path, capacity=capacity, **params).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in got:
        ids = np.frombuffer(bytes(r.ids), "<u4").tolist()
        assert len(ids) == r.length and r.start == r.piece * capacity
        by_doc[r.doc_id].append((r.piece, ids))
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for own in by_sequence.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    if None not in by_doc and len(by_doc) == len(texts):
        for d, own in by_doc.items():
            assert [p for p, _ in sorted(own)] == list(range(len(own)))
            assert [x for _, part in sorted(own) for x in part] == [*lib.encode(texts[d] or "", add_special_tokens=False).ids, 1]
    assert sum(len(x) * n for x, n in want.items()) == sum(r.length for r in got)
    return len(by_sequence), [r.length for r in got]


def plain_first_fit_decreasing(sizes, capacity):
    bins = []
    for s in sorted(sizes, reverse=True):
        for i, room in enumerate(bins):
            if room >= s:
                bins[i] -= s
                break
        else:
            bins.append(capacity - s)
    return len(bins)


@pytest.mark.parametrize("path", [tokenizer_path(), BYTES_BPE])
def test_packing_places_every_piece_once(spark, path):
    rng = random.Random(3)
    texts = [None, "", "one", *(" ".join(rng.choice(["be", "to", "or", "not"]) for _ in range(rng.choice([3, 20, 60, 200]))) for _ in range(120))]
    docs = documents(spark, texts).repartition(7).selectExpr("*", "1 as piece", "2 as bin", "3 as ids", "4 as node")
    n, sizes = check_packing(spark, docs, texts, path, 64, block_tokens=500, block_items=16)
    assert n <= math.ceil(sum(sizes) / 64) * 1.05 + 1
    n, sizes = check_packing(spark, docs, texts, path, 64)
    assert n <= plain_first_fit_decreasing(sizes, 64) + 1


def test_packing_of_items_that_do_not_fit_together(spark):
    texts = [" ".join(["to"] * 35)] * 90  # 36 ids of 64: two never share a bin
    n, _ = check_packing(spark, documents(spark, texts).repartition(5), texts, tokenizer_path(), 64, block_items=8, block_tokens=200)
    assert n == 90


def test_packing_null_ids_repeated_rows_empty_table_long_text(spark):
    long_text = "to be " * 60_000
    rows = [(None, "a b", None, None, None), (2, "c", None, None, None), (2, "c", None, None, None), (3, long_text, None, None, None)]
    docs = spark.createDataFrame(rows, DOC)
    n, sizes = check_packing(spark, docs, [r[1] for r in rows], tokenizer_path(), 4096)
    assert n == math.ceil(sum(sizes) / 4096) and max(sizes) == 4096
    assert packing.packed(docs.limit(0), tokenizer_path()).count() == 0


def test_sequences_hold_their_pieces_in_order(spark):
    texts = [" ".join(["to"] * k) for k in (3, 10, 30, 5, 17)]
    pieces = packing.packed(documents(spark, texts), tokenizer_path(), capacity=24)
    own = defaultdict(dict)
    for r in pieces.collect():
        own[r.sequence_id][r.offset] = bytes(r.ids)
    for r in packing.sequences(pieces).collect():
        assert bytes(r.ids) == b"".join(own[r.sequence_id][k] for k in sorted(own[r.sequence_id]))
        assert r.length * 4 == len(r.ids) and r.n_pieces == len(own[r.sequence_id])


@MANY
@given(st.lists(st.integers(1, 20), max_size=40))
def test_best_fit_wastes_little(sizes):
    bins, at = packing.best_fit(sizes, 20)
    held = defaultdict(list)
    for s, b, x in zip(sizes, bins, at, strict=True):
        held[b].append((x, s))
    for own in held.values():
        assert all(x == sum(s for y, s in own if y < x) for x, _ in own) and sum(s for _, s in own) <= 20
    assert len(held) <= math.ceil(11 / 9 * math.ceil(sum(sizes) / 20)) + 4 or len(held) <= plain_first_fit_decreasing(sizes, 20)


# --- hard negatives

VEC = "vec_id long, embedding array<double>, label long"


def plain_negatives(rows, every, positives=5, negatives=10, low=30, high=90):
    ok = {(i, l, tuple(math.floor(256 * x) for x in v)) for i, v, l in rows
          if None not in (i, v, l) and all(x is not None and math.isfinite(x) for x in v)}
    ok = {r for r in ok if sum(x * x for x in r[2]) < 1 << 55}
    out = set()
    for a in ok:
        if a[0] % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(a[2], b[2], strict=True)), b[0], b[1]) for b in ok if b[0] != a[0] and len(b[2]) == len(a[2]))
        for p, pid, _ in [x for x in scored if x[2] == a[1]][:positives]:
            fit = [x for x in scored if x[2] != a[1] and 30 * -p <= 100 * -x[0] <= 90 * -p][:negatives]
            out |= {(a[0], pid, k + 1, i, -p, -s) for k, (s, i, _) in enumerate(fit)}
    return out


def clustered(seed, n, dim, groups, spread):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, dim))
    return [(int(i), (centres[i % groups] + spread * rng.normal(size=dim)).tolist(), int(rng.integers(3))) for i in range(n)]


@pytest.mark.parametrize("seed,spread,params", [(1, 0.1, {}), (2, 1.0, {"clusters": 1, "cell_rows": 40}),
                                                (3, 0.3, {"clusters": 12, "cell_rows": 64, "sample": 30, "cuts": (0.05, 0.3)})])
def test_negatives_are_those_of_a_plain_search(spark, seed, spread, params):
    rows = clustered(seed, 400, 6, 5, spread)
    rows += [(1000 + i, rows[0][1], i % 3) for i in range(30)]  # ties
    got = {tuple(r) for r in negatives.hard_negatives(spark.createDataFrame(rows, VEC), F.col("vec_id") % 9 == 0, **params).collect()}
    assert got == plain_negatives(rows, 9)
    assert got


def test_negatives_of_odd_rows(spark):
    good = clustered(4, 60, 3, 2, 0.4)
    odd = [(100, None, 1), (101, [1.0, None, 2.0], 1), (102, [1.0, float("nan"), 2.0], 1), (103, [float("inf"), 1.0, 2.0], 1), (104, [1.0, 2.0, 3.0], None),
           (None, [1.0, 2.0, 3.0], 1), (105, [1e300, 1.0, 1.0], 1), (106, [0.0, 0.0, 0.0], 1), (108, [0.0, 0.0, 0.0], 2), (110, [], 1), (114, [], 2), (116, [], 1),
           (107, [1.0, 2.0], 1), (112, [1.5, 2.0], 2), (109, [2.0, 2.0], 1), (111, [1e5, 2e5, 1e5], 1), (113, [1e5, 2e5, 0.5e5], 2), (115, [1e5, 2.2e5, 1e5], 1)]
    rows = good + odd + good[:20]
    df = spark.createDataFrame(rows, VEC).selectExpr("*", "1 as rk", "2 as v", "3 as dim", "4 as anchor", "5 as cluster")
    got = {tuple(r) for r in negatives.hard_negatives(df, F.col("vec_id") % 2 == 0, clusters=6).collect()}
    assert got == plain_negatives(rows, 2)
    assert negatives.hard_negatives(df.limit(0), F.col("vec_id") % 2 == 0).count() == 0
    assert negatives.hard_negatives(df, F.lit(False)).count() == 0


def test_walks_end_before_the_list_where_anchors_lie_close(spark, monkeypatch):
    rows = clustered(6, 1500, 8, 10, 0.02)
    seen = []
    plain = negatives._scores
    monkeypatch.setattr(negatives, "_scores", lambda a, v, exact: seen.append(len(a) * len(v)) or plain(a, v, exact))
    cell = {"v": np.array([np.floor(256 * np.array(r[1])) for r in rows], np.int32)}
    lists = negatives.Lists({8: negatives._centres(cell["v"][:200], 10)})
    own, angle = lists.cluster(cell["v"][:200])
    lists.wide[8] = np.array([angle[own == c].max(initial=0) for c in range(len(lists.centres[8]))])
    f = cell["v"].astype(float)
    norm = np.sqrt((f * f).sum(1))
    bound = lists.bounds(cell["v"], norm)[:, own[0]]
    order = np.argsort(-bound)
    held = {"v": cell["v"][order], "f": f[order], "norm": norm[order], "vec_id": order, "bound": bound[order], "labels": {"x": 0}, "label": np.zeros(len(rows), int)}
    anchor = (0, 0, "x", cell["v"][0].tobytes(), [-1 << 62], [1 << 62])
    (_, _, score, other), = negatives._walk([anchor], held, 5, True, block=50)
    assert sum(seen) < len(rows) / 3
    want = sorted((-int(x), i) for i, x in enumerate(f @ f[0]) if i)[:5]
    assert sorted((-int(s), int(o)) for s, o in zip(score, other, strict=True)) == want
