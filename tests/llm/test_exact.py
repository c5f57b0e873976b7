"""Operators with an exact contract, against plain Python on small inputs."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st

from daybook.llm import linedup, mixing, substrings, tokens
from daybook.llm.queries import tokenizer_path

DOC = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SMALL = settings(max_examples=5, deadline=None, phases=[Phase.generate], suppress_health_check=list(HealthCheck))


def table(spark, rows, schema=DOC):
    return spark.createDataFrame(rows, schema)


def documents(spark, texts):
    return table(spark, [(i, t, "en", f"s{i % 3}", None) for i, t in enumerate(texts)])


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


# --- substring dedup

def plain_repeats(rows, k):
    first, out = {}, []
    split = [WORD.findall(t or "") for _, t in rows]
    places = sorted(((-1 << 63 if d is None else d), i) for i, (d, _) in enumerate(rows))
    for d, i in places:
        for s in range(len(split[i]) - k + 1):
            first.setdefault(tuple(split[i][s:s + k]), (d, s))
    for i, (d, _) in enumerate(rows):
        d, w, gone = -1 << 63 if d is None else d, split[i], set()
        for s in range(len(w) - k + 1):
            if first[tuple(w[s:s + k])] < (d, s):
                gone.update(range(s, s + k))
        out.append((len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone)))
    return out


def check_repeats(spark, texts, k, **params):
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept)
           for r in substrings.remove_repeats(documents(spark, texts), k=k, **params).collect()}
    assert got == dict(enumerate(plain_repeats(list(enumerate(texts)), k)))


@SMALL
@given(st.lists(st.lists(st.sampled_from(["a", "b", "c\t", "d\n", "é"]), max_size=40).map(" ".join), min_size=1, max_size=8))
def test_repeats_of_few_words(spark, texts):
    check_repeats(spark, texts, 5, m=2, part_bytes=64)


@pytest.mark.parametrize("hot", [3, 10**9])
def test_repeats_across_documents_with_hot_minimisers(spark, hot):
    base = [f"w{i}" for i in range(120)]
    texts = [" ".join(base[i:i + 60] + [f"x{i}"] + base[:25]) for i in range(0, 60, 3)] + [None, "", " \n", "one", "y" * 5000]
    check_repeats(spark, texts * 2, 20, hot_windows=hot)


def test_repeats_with_many_minimiser_classes(spark):
    rng = random.Random(6)
    texts = [" ".join(rng.choice("abcd") for _ in range(60)) for _ in range(12)]
    check_repeats(spark, texts * 2, 20, hot_windows=3, hot_parts=1 << 21)


def test_a_passage_between_different_words_travels_about_once_per_task(spark):
    """One 20-word passage in many documents with other words around it: of a hot
    minimiser, equal windows leave a task once."""
    shared = " ".join(f"s{i}" for i in range(20))
    texts = [f"a{i} b{i} c{i} {shared} d{i} e{i} f{i}" for i in range(3000)]
    got = substrings.remove_repeats(documents(spark, texts), hot_windows=500).collect()
    assert {r.doc_id: r.n_removed for r in got} == {i: 20 * (i > 0) for i in range(3000)}
    batch = pa.RecordBatch.from_pydict({"doc_id": range(3000), "rk": [0] * 3000, "text": texts})
    runs = substrings.super_kmers(batch.column("text"), 20, 3)
    hot = np.unique(substrings._bucket(runs.low, 1 << 16))
    packer = substrings.Packer(20, 3, 1, hot, 1 << 16)
    sent = {}
    for at in range(0, 3000, 100):
        for _, marks, block in packer.pack(batch.slice(at, 100)):
            if not marks:
                raw = zstandard.decompress(block)
                n = int(np.frombuffer(raw, "<i8", 1)[0])
                sent[at] = sent.get(at, 0) + raw[8 + 32 * n:].count(shared.encode())
    assert sent[0] == 1 and not any(sent[at] for at in sent if at)


def test_repeats_null_ids_and_repeated_rows(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(None, text), (3, text), (3, text), (4, "z " + text)]
    docs = table(spark, [(d, t, None, None, None) for d, t in rows]).selectExpr("*", "'x' as rk", "1 as part")
    got = sorted(((r.doc_id is not None, r.doc_id or 0), r.n_removed) for r in substrings.remove_repeats(docs).collect())
    assert got == [((False, 0), 0), ((True, 3), 30), ((True, 3), 30), ((True, 4), 30)]


# --- line dedup

def plain_lines(rows, least_chars, least_docs):
    def key(line):
        return line.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})
    held = defaultdict(set)
    for d, t in rows:
        for line in (t or "").split("\n"):
            held[key(line)].add(d)
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        stay = [x for x in lines if len(key(x)) < least_chars or len(held[key(x)]) < least_docs or max(held[key(x)]) == d]
        out.append((d, len(lines), len(lines) - len(stay), "\n".join(stay)))
    return sorted(out)


@SMALL
@given(st.lists(st.lists(st.sampled_from(["aaaa", " AAAA\r", "ééééé", "bbbbbb\t", "c", "", "ÉÉÉÉé"]), max_size=6).map("\n".join),
                min_size=1, max_size=14))
def test_lines(spark, texts):
    got = linedup.dedup_lines(documents(spark, texts), least_chars=4, least_docs=3, batches=3, fanout=2)
    assert sorted(map(tuple, got.collect())) == plain_lines(list(enumerate(texts)), 4, 3)


def test_line_runs_are_compacted(spark):
    runs = linedup.LineRuns(spark, 4, least_docs=2, fanout=2)
    for doc in (9, 8, 7, 6, 5):
        runs.add(spark.createDataFrame([(doc, 1, 1), (doc, doc, 0)], "doc_id long, h1 long, h2 long"))
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    assert [tuple(r) for r in runs.frequent().collect()] == [(1, 1, 9)]


def test_lines_null_text_empty_table_extra_columns(spark):
    docs = documents(spark, [None, ""]).selectExpr("*", "1 as h1", "2 as lost", "3 as batch")
    assert sorted(map(tuple, linedup.dedup_lines(docs).collect())) == [(0, 1, 0, ""), (1, 1, 0, "")]
    assert linedup.dedup_lines(docs.limit(0)).count() == 0


# --- token files

ODD = ["", None, "It's DON'T we'll 'tis ''s !'s", "a b c", "<|endoftext|> x<|startoftext|>y", "ÀÉÎ é ΣΑΣ İx ß ﬁ",
       "日本語 テスト 12", "x\x1cy \x85z", "a" * 300, "hi!?! “q” – ’s 3² ½", "\tfoo\x0bbar\r\nbaz", "_a_b__ 1_2 $3.50", "same", "same"]


def test_token_files_round_trip(spark):
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(tokenizer_path())
    ids = {i: [*lib.encode(t or "", add_special_tokens=False).ids, 1] for i, t in enumerate(ODD)}
    got = tokens.token_files(documents(spark, ODD), tokenizer_path(), shard_ids=20).orderBy("doc_id").collect()
    start = 0
    for i, r in enumerate(got):
        crc = zlib.crc32(b"".join(x.to_bytes(4, "little") for x in ids[i]))
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (i, start, len(ids[i]), crc), ODD[i]
        start += len(ids[i])
    assert len(got) == len(ODD)


def test_token_files_null_ids_and_empty_table(spark):
    docs = table(spark, [(None, "a b", None, None, None), (2, "c", None, None, None), (2, "c", None, None, None)])
    got = [(r.doc_id, r.start, r.n_tokens) for r in tokens.token_files(docs, tokenizer_path()).orderBy("start").collect()]
    assert got == [(None, 0, 3), (2, 3, 2), (2, 5, 2)]
    assert tokens.token_files(docs.limit(0), tokenizer_path()).count() == 0


# --- mixing

def plain_targets(sizes, weights, share=1.5, most=2):
    full, left = set(), share * sum(sizes.values())
    while True:
        live = {s for s in sizes if s not in full}
        level = (left - sum(most * sizes[s] for s in full)) / sum(weights[s] for s in live)
        over = {s for s in live if level * weights[s] >= most * sizes[s]}
        if not over:
            return {s: most * sizes[s] if s in full else level * weights[s] for s in sizes}
        full |= over


@SMALL
@given(st.lists(st.tuples(st.sampled_from(["a", "B", "é", None, "c", "d", "e"]), st.integers(0, 30)), min_size=1, max_size=25))
def test_mix_targets_and_cuts(spark, spec):
    docs = table(spark, [(i, " ".join(["w"] * n) if n else None, "en", s, None) for i, (s, n) in enumerate(spec)])
    got = mixing.mix(docs, per_range=4).collect()
    assert sorted((r.doc_id, r.size) for r in got) == [(i, n) for i, (_, n) in enumerate(spec)]
    sizes = defaultdict(int)
    for s, n in spec:
        sizes[s] += n
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weights = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    want = plain_targets(sizes, weights) if sum(sizes.values()) else dict.fromkeys(sizes, 0)
    taken = defaultdict(int)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    for s in sizes:
        assert taken[s] == int(want[s] + 1e-9)


def test_mixed_documents_keep_columns_and_words(spark):
    docs = documents(spark, [f" {i}a  {i}b\n{i}c {i}d " for i in range(30)]).selectExpr("*", "'k' as key", "1 as rest")
    plan = {r.doc_id: r.taken for r in mixing.mix(docs).collect()}
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    words = defaultdict(int)
    original = {r.doc_id: r.text for r in docs.collect()}
    for r in out.collect():
        words[r.doc_id] += len(WORD.findall(r.text))
        assert original[r.doc_id].startswith(r.text)
    assert {k: v for k, v in plan.items() if v} == dict(words)


def test_mix_without_rows(spark):
    docs = documents(spark, ["a"]).limit(0)
    assert mixing.mix(docs).count() == 0 and mixing.mixed_documents(docs).count() == 0
