"""The pipeline's stages on the smallest tables, against plain Python."""

from __future__ import annotations

from collections import Counter, defaultdict

import corpus_pipeline as pipe
from daybook.llm.common import save

SF = "/root/testdata/sf0.001"


def shingles(text, k=5):
    w = text.split()
    return Counter(tuple(w[i:i + k]) for i in range(len(w) - k + 1))


def test_stages_one_by_one(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    source = {r.doc_id: r.text for r in docs.collect()}
    tables = {}
    for name, stage in pipe.STAGES:
        out = stage(spark, docs, SF)
        if name != "token_output":
            assert out.columns == docs.columns
        docs = save(out, f"test-{name}")
        tables[name] = docs.collect()
    good = {r.doc_id for r in tables["quality"]}
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    clean = [r.doc_id for r in labels if r.quality == 1 and r.toxic == 0]
    assert sum(i in good for i in clean) >= 0.9 * len(clean)

    kept = {r.doc_id: shingles(r.text) for r in tables["near_dedup"]}
    bags = {i: shingles(source[i]) for i in good}

    def alike(x, y):
        return sum((x & y).values()) / max(1, sum((x | y).values()))

    ids = sorted(kept)
    assert not any(alike(kept[a], kept[b]) >= 0.85 for i, a in enumerate(ids) for b in ids[:i])
    for i in good - kept.keys():
        same = [j for j in good if j != i and (len(bags[i].keys() & bags[j].keys()) >= 0.7 * len(bags[i].keys() | bags[j].keys())
                                               if bags[i] else source[i].split() == source[j].split())]
        assert same, i

    items = [r.text.split() for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    whole = {i for i in kept if any(len(t) >= 5 and " ".join(t) in " ".join(source[i].split()) for t in items)}
    left = {r.doc_id for r in tables["decontaminate"]}
    assert not whole & left
    seeds = {tuple(w.lower() for w in t[i:i + 5]) for t in items for i in range(len(t) - 4)}
    free = {i for i in kept if not seeds & {tuple(x.lower() for x in s) for s in kept[i]}}
    assert free <= left

    words, size = defaultdict(int), defaultdict(int)
    for r in tables["decontaminate"]:
        size[r.source] += len(r.text.split())
    for r in tables["mix_sources"]:
        assert source[r.doc_id].startswith(r.text)
        words[r.source] += len(r.text.split())
    assert all(words[s] <= 2 * size[s] for s in words)
    assert abs(sum(words.values()) - 1.5 * sum(size.values())) <= len(size)

    tokens = sorted(tables["token_output"], key=lambda r: r.start)
    assert [r.doc_id for r in tokens] == sorted(r.doc_id for r in tables["mix_sources"])
    assert [r.start for r in tokens] == [sum(x.n_tokens for x in tokens[:i]) for i in range(len(tokens))]
