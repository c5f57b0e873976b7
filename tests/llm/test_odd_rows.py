"""Null ids, repeated rows, very long texts, extra columns, reruns: one small table through
the operators that other tests do not show it to."""

from __future__ import annotations

import zlib
from collections import Counter

import pytest

import corpus_pipeline
from daybook.llm import linedup, minhash, mixing, pivots, tiling, tokens
from daybook.llm.queries import tokenizer_path

DOC = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "to be or not to be that is the question " * 12_000          # 120,000 words
LINE = "a line of more than forty characters, which stands in many documents"
ROWS = [(None, f"{LINE}\nnull one", None, None, None), (None, f"{LINE}\nnull one", None, None, None), (1, "x", "en", "a", 1), (1, "x", "en", "a", 1),
        (2, LONG + LINE, "en", "b", 5), (3, f"{LINE.upper()}\n", "de", None, None), (4, None, None, "a", None), (5, "", "en", "b", 0),
        (6, f"b\n {LINE}\t\nc", "en", "b", 9), (7, LINE, "en", "a", 9)]


@pytest.fixture(scope="module")
def docs(spark):
    extra = "1 as rk, 'k' as key, 2 as n_tokens, 3 as ids, 4 as size, 5 as target, 6 as line, 7 as class_id, 8 as id, 9 as d".split(", ")
    return spark.createDataFrame(ROWS, DOC).selectExpr("*", *extra).repartition(3).cache()


def test_token_files(docs):
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(tokenizer_path())
    crc = [zlib.crc32(b"".join(x.to_bytes(4, "little") for x in [*lib.encode(t or "", add_special_tokens=False).ids, 1])) for _, t, *_ in ROWS]
    got = tokens.token_files(docs, tokenizer_path()).collect()
    assert Counter((r.doc_id, r.ids_crc32) for r in got) == Counter((d, c) for (d, *_), c in zip(ROWS, crc, strict=True))


def test_mix_gives_the_same_again(spark, docs):
    once, again = (Counter(map(tuple, mixing.mix(d).collect())) for d in (docs, docs.repartition(7)))
    assert once == again and sum(once.values()) == len(ROWS)
    assert Counter(map(tuple, mixing.mixed_documents(docs).collect())) == Counter(map(tuple, mixing.mixed_documents(docs.repartition(2)).collect()))


def test_lines(docs):
    got = Counter((r.doc_id, r.n_lines, r.n_dropped, len(r.kept)) for r in linedup.dedup_lines(docs).collect())
    # five documents at least must hold a line; rows without an id are one document
    want = Counter((d, len((t or "").split("\n")), 0, len(t or "")) for d, t, *_ in ROWS)
    held = {d for d, t, *_ in ROWS if any(x.strip(" \t\n\v\f\r").lower() == LINE for x in (t or "").split("\n"))}
    assert len(held) == 4 and got == want                               # four: nothing goes
    more = docs.union(docs.filter("doc_id = 7").selectExpr("8 as doc_id", *[c for c in docs.columns if c != "doc_id"]))
    dropped = Counter((r.doc_id, r.n_dropped) for r in linedup.dedup_lines(more).collect())
    assert dropped == Counter({(None, 1): 2, (1, 0): 2, (2, 0): 1, (3, 1): 1, (4, 0): 1, (5, 0): 1, (6, 1): 1, (7, 1): 1, (8, 0): 1})


def test_near_copies_of_a_long_text(docs):
    twice = docs.union(docs.filter("doc_id = 2").selectExpr("20 as doc_id", "concat(text, ' end')", *[c for c in docs.columns if c not in ("doc_id", "text")]))
    got = {r.doc_id: r.class_id for r in minhash.near_duplicates(twice).collect()}
    assert got[20] == got[2] == 2
    assert Counter(r.doc_id for r in minhash.one_of_each(twice).collect())[1] == 1


def test_tiling(spark, docs):
    bench = spark.createDataFrame([("i", LINE), ("i", LINE), (None, LINE.upper()), ("n", None), ("long", LONG)], "item_id string, text string")
    got = Counter((r.doc_id, r.item_id) for r in tiling.contaminated(docs, bench).collect())
    lines = {None: 2, 2: 1, 3: 1, 6: 1, 7: 1}
    assert got == Counter({**{(d, "i"): 2 * n for d, n in lines.items()}, **{(d, None): n for d, n in lines.items()}, (2, "long"): 1})
    assert sorted(r.doc_id for r in tiling.without_contaminated(docs, bench).collect()) == [1, 1, 4, 5]


def test_vectors_repeated(spark):
    rows = [(1, [1.0, 0.0], 3)] * 3 + [(2, [1.0, 0.001], 3), (3, [0.0, 1.0], 3), (4, [1.0, 0.0], None)]
    got = Counter(map(tuple, pivots.linked(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()))
    assert got == Counter({(1, 3, 1, True): 3, (2, 3, 1, False): 1, (3, 0, 3, True): 1, (4, 0, 4, True): 1})


@pytest.mark.parametrize("stage", ["near_dedup", "decontaminate", "mix_sources"])
def test_stages_keep_columns_and_bear_odd_rows(spark, docs, tmp_path, stage):
    spark.createDataFrame([(1, "nothing of this stands anywhere at all")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    run = dict(corpus_pipeline.STAGES)[stage]
    for rows in (docs, docs.limit(0)):
        out = run(spark, rows, str(tmp_path))
        assert out.columns == docs.columns and (out.count() > 0) == (rows is docs)
