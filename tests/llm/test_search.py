"""Classifier, near copies, tiling, licences, URL rules and vectors, against
brute force or held-out labels on small inputs."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from daybook.llm import licences, minhash, pivots, quality, tiling, urlrules
from daybook.llm.queries import URL_RULES

DOC = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts, start=0):
    return spark.createDataFrame([(i + start, t, "en", "s", len(t or "")) for i, t in enumerate(texts)], DOC)


def words(rng, n, base=2000):
    return [f"w{rng.randrange(base)}" for _ in range(n)]


# --- quality classifier

def test_classifier_on_held_out_labels(spark):
    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    told = {r.doc_id: int(r.quality == 0 or r.toxic == 1) for r in labels.collect()}
    fit = labels.filter("doc_id % 3 <> 0")
    got = {r.doc_id: r for r in quality.classify(docs, fit, rounds=1).collect()}
    assert len(got) == docs.count()
    held = [(y, got[i].keep) for i, y in told.items() if i % 3 == 0]
    assert sum(keep != bool(y) for y, keep in held) / len(held) > 0.93
    assert sum(keep for y, keep in held if not y) / sum(not y for y, _ in held) > 0.96


def test_pseudo_labels_are_new_texts_without_a_label(spark):
    rng = random.Random(15)
    rows = [(i, i % 40, rng.random(), rng.random(), 0.5) for i in range(200)]     # 40 texts, five copies each
    p_of = {rk: (p, q) for _, rk, p, q, _ in rows}
    rows = [(i, rk, *p_of[rk], 0.5) for i, rk, *_ in rows]
    scored = spark.createDataFrame(rows, "doc_id long, rk long, p_text double, p_meta double, p_bad double")
    told = spark.createDataFrame([(i, 1.0) for i in range(0, 200, 3)], "doc_id long, bad double")
    for y in (1.0, 0.0):
        for taken in (set(), {3, 5, 8, 13, 21}):
            chance = {rk: p if y else 1 - p for rk, (p, _) in p_of.items()}
            want = sorted((-c, rk) for rk, c in chance.items() if c >= 0.2 and rk not in taken)[:12]
            got = quality.surest(scored, told, taken, "p_text", y, 0.2, 12, 0)
            assert [rk for _, rk in got] == [rk for _, rk in want]
            assert all(i == min(j for j in range(rk, 200, 40) if j % 3) for i, rk in got)
    assert len(quality.surest(scored, told, set(), "p_meta", 1.0, 0.0, 1000, 0)) == 40


def test_classifier_with_repeated_rows_and_contradicting_labels(spark):
    docs = documents(spark, ["good words here now"] * 20 + ["BAD!!! $$$ buy||"] * 20)
    docs = docs.union(docs).union(spark.createDataFrame([(None, "x", None, None, None)], DOC))
    labels = spark.createDataFrame([(i, int(i < 20), 0) for i in range(40)] + [(3, 0, 0)], "doc_id long, quality int, toxic int")
    got = quality.classify(docs, labels, rounds=1).collect()
    assert len(got) == 81 and [r.doc_id for r in got].count(None) == 1
    assert {r.keep for r in got if r.doc_id is not None and r.doc_id >= 20} == {False}


def test_classifier_without_labels_and_with_nulls(spark):
    docs = documents(spark, [None, "", "x" * 10000]).selectExpr("*", "1 as rk", "2 as p_text")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [(r.score, r.keep) for r in quality.classify(docs, none).collect()] == [(None, True)] * 3
    assert quality.keep_good(docs, none).count() == 3
    labels = spark.createDataFrame([(0, 1, 0), (1, 0, 0), (2, None, None), (None, 1, 0)], "doc_id long, quality int, toxic int")
    assert quality.classify(docs, labels, rounds=1).count() == 3
    assert quality.keep_good(docs, labels, rounds=1).columns == docs.columns
    assert quality.classify(docs.limit(0), labels).count() == 0


# --- near copies

def jaccard(a, b, k=5):
    """Probability Jaccard, straight from its definition."""
    x, y = (Counter(tuple(t[i:i + k]) for i in range(len(t) - k + 1)) for t in (a, b))
    return sum(1 / sum(max(x[j] / x[i], y[j] / y[i]) for j in x | y) for i in x.keys() & y.keys())


def test_similarity_is_probability_jaccard():
    rng = random.Random(1)
    pairs = []
    for _ in range(12):
        a = words(rng, 40, 6)
        b = a[:rng.randrange(41)] + words(rng, rng.randrange(20), 6)
        if len(b) >= 5:
            pairs.append((a, b))
    got = minhash.pair_similarity(*(pa.array([" ".join(p[i]) for p in pairs]) for i in (0, 1)), 5)
    assert got == pytest.approx([jaccard(a, b) for a, b in pairs])


def test_registers_agree_as_often_as_texts_are_alike():
    rng = random.Random(2)
    base = words(rng, 200)
    texts = [base, base[:170] + words(rng, 30), base[:100] + words(rng, 100)]
    doc, h, count, *_ = minhash.shingles(pa.array([" ".join(t) for t in texts]), 5)
    reg = minhash.probminhash(doc, h, count, 3, 4000)
    for i in (1, 2):
        assert (reg[0] == reg[i]).mean() == pytest.approx(jaccard(texts[0], texts[i]), abs=0.04)


def test_near_duplicates_against_brute_force(spark):
    rng = random.Random(3)
    texts = []
    for _ in range(12):
        base = words(rng, 150)
        texts.append(base)
        for changes in (0, 1, 2, 3, 4, 8):
            copy = list(base)
            for _ in range(changes):
                copy[rng.randrange(150)] = f"n{rng.randrange(10**6)}"
            texts.append(copy)
    rng.shuffle(texts)
    link = [(i, j) for i in range(len(texts)) for j in range(i) if texts[i][:1] and jaccard(texts[i], texts[j]) >= 0.8]
    root = list(range(len(texts)))
    for _ in texts:
        for i, j in link:
            root[i] = root[j] = min(root[i], root[j])
    extra = [None, "", " ", "one two", "one two", "one  two\n"]
    want = root + [len(texts) + k for k in (0, 1, 2, 3, 3, 3)]
    docs = documents(spark, [" ".join(t) for t in texts] + extra).selectExpr("*", "1 as key", "2 as id", "3 as label")
    got = {r.doc_id: r.class_id for r in minhash.near_duplicates(docs).collect()}
    assert got == dict(enumerate(want))
    assert sorted(r.doc_id for r in minhash.one_of_each(docs).select("doc_id").collect()) == sorted(set(want))


def test_near_duplicates_repeated_rows_and_null_ids(spark):
    rng = random.Random(4)
    text = " ".join(words(rng, 50))
    docs = spark.createDataFrame([(1, text, "a", "s", 1), (1, text, "a", "s", 1), (2, text, "a", "s", 1), (None, text, "a", "s", 1)], DOC)
    # a row without an id takes part, too
    assert sorted((r.doc_id or 0, r.class_id) for r in minhash.near_duplicates(docs).collect()) == [(0, 1), (1, 1), (2, 1)]
    kept = minhash.one_of_each(docs)
    assert kept.columns == docs.columns and [r.doc_id for r in kept.collect()] == [1]
    assert minhash.near_duplicates(docs.limit(0)).count() == 0 and minhash.one_of_each(docs.limit(0)).count() == 0


def test_many_classes_in_a_bucket_lose_no_link(spark):
    """Pairs that do not meet their bucket's pivot are still verified."""
    rng = random.Random(5)
    common = words(rng, 100)
    texts = []
    for _ in range(8):
        own = words(rng, 40)
        texts += [common + own, common + own[:-1] + ["z"]]
    got = {r.doc_id: r.class_id for r in minhash.near_duplicates(documents(spark, [" ".join(t) for t in texts]), block=4).collect()}
    assert got == {i: i - i % 2 for i in range(16)}


# --- greedy string tiling

def plain_tiles(a, b, least):
    free_a, free_b, out = [True] * len(a), [True] * len(b), []
    while True:
        best = None
        for i in range(len(a)):
            for j in range(len(b)):
                n = 0
                while i + n < len(a) and j + n < len(b) and free_a[i + n] and free_b[j + n] and a[i + n] == b[j + n]:
                    n += 1
                if n >= least and (best is None or (-n, i, j) < (-best[0], best[1], best[2])):
                    best = (n, i, j)
        if best is None:
            return out
        n, i, j = best
        out.append(best)
        free_a[i:i + n] = [False] * n
        free_b[j:j + n] = [False] * n


def test_tiles_against_plain_greedy():
    rng = np.random.default_rng(6)
    for _ in range(40):
        a, b = (rng.integers(0, 3, rng.integers(0, 40)).astype(np.uint64) for _ in "ab")
        got, want = tiling.tiles(a, b, 3), plain_tiles(a.tolist(), b.tolist(), 3)
        assert sum(t[0] for t in got) == sum(t[0] for t in want) and sorted(t[0] for t in got) == sorted(t[0] for t in want)


def test_near_copies_among_rows_without_an_id(spark):
    rng = random.Random(14)
    text, other = words(rng, 120), " ".join(words(rng, 60))
    near = " ".join([*text[:60], "changed", *text[61:]])
    docs = spark.createDataFrame([(None, " ".join(text), "a", "s", 1), (None, near, "b", "s", 1), (None, near, "c", "s", 1), (None, other, "d", "s", 1),
                                  (7, other, "e", "s", 1), (None, None, "f", "s", 1)], DOC)
    got = minhash.near_duplicates(docs).collect()
    assert sorted(Counter(r.class_id for r in got).values()) == [1, 2, 2] and {r.class_id for r in got if r.doc_id == 7} == {7}
    kept = [(r.doc_id, r.text) for r in minhash.one_of_each(docs).collect()]
    assert len(kept) == 3 and (7, other) in kept and (None, None) in kept


def test_short_items_are_searched_whole(spark):
    bench = spark.createDataFrame([(1, "Deep, blue"), (2, "one"), (3, "sea of green grass"), (4, "a deep blue sea now"), (None, "deep blue")], "item_id long, text string")
    docs = documents(spark, ["the deep blue sea", "deep the blue", "ONE more", "sea of green", "x sea of green grass y", "a deep blue sea now", ""])
    got = sorted((r.doc_id, r.item_id or 0, r.item_words, r.covered) for r in tiling.contaminated(docs, bench).collect())
    assert got == [(0, 0, 2, 2), (0, 1, 2, 2), (2, 2, 1, 1), (4, 3, 4, 4), (5, 0, 2, 2), (5, 1, 2, 2), (5, 4, 5, 5)]
    assert sorted(r.doc_id for r in tiling.without_contaminated(docs, bench).collect()) == [1, 3, 6]


def test_a_phrase_of_many_items_repeated_in_a_document(spark):
    """One phrase in 3,000 items and 300 times in one document: each pair is looked at
    once, not once for each place."""
    bench = spark.createDataFrame([(i, f"start{i} all share this same phrase end{i} and more{i} words{i} here{i}") for i in range(3000)], "item_id long, text string")
    docs = documents(spark, ["all share this same phrase and " * 300 + "start7 all share this same phrase end7 and more7 words7 here7"])
    assert [r.item_id for r in tiling.contaminated(docs, bench).collect()] == [7]


def test_contaminated_finds_reordered_passages(spark):
    rng = random.Random(7)
    items = [words(rng, 40) for _ in range(6)]
    noise = lambda n: words(rng, n, 10**6)
    texts = [noise(30) + items[0] + noise(30), noise(10) + items[1][20:] + noise(5) + items[1][:20], noise(50) + items[2][:12],
             noise(80), [w.upper() + "," for w in items[3]], items[4][:30] + noise(30)]
    docs = documents(spark, [" ".join(t) for t in texts] + [None, ""]).selectExpr("*", "1 as item_id")
    bench = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)] + [(9, None), (10, "two words")], "item_id long, text string")
    for block in (10**6, 50):
        got = {(r.doc_id, r.item_id): r.covered for r in tiling.contaminated(docs, bench, block_words=block).collect()}
        assert got == {(0, 0): 40, (1, 1): 40, (4, 3): 40, (5, 4): 30}
    left = tiling.without_contaminated(docs, bench)
    assert left.columns == docs.columns and sorted(r.doc_id for r in left.collect()) == [2, 3, 6, 7]
    assert tiling.contaminated(docs, bench.limit(0)).count() == 0 and tiling.contaminated(docs.limit(0), bench).count() == 0


def test_contaminated_folds_by_unicode(spark):
    items = ["¿Dónde está la próxima estación según él? Mañana volveré aquí también.", "Die größte Straße führt über Österreich nach Ungarn, schön!",
             "Ο δρόμος προς την Αθήνα είναι μακρύς", "Большая дорога ведёт через лес к морю", "北京是中国的首都，人口众多。", "plain words only in this one here"]
    quoted = [f"“{t.upper()}” — " for t in items]
    texts = [f"noise ünd more {q} end" for q in quoted] + ["«" + items[0].replace("ó", "o\u0301").replace(" ", "\u00a0") + "»", "我们说过北京是中国的首都。", "東京"]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.coverage for r in tiling.contaminated(documents(spark, texts + [None]), bench).collect()}
    assert got == {**{(i, i): 1.0 for i in range(6)}, (6, 0): 1.0, (7, 4): 8 / 12}
    assert sorted(r.doc_id for r in tiling.without_contaminated(documents(spark, texts + [None]), bench).collect()) == [8, 9]


# --- licences

def test_licences_with_typographic_quotes(spark):
    mit = "\n".join(licences.SENTENCES[s] for s in ("mit-permission", "mit-notice", "mit-as-is", "mit-liability"))
    texts = [mit.replace('"Software"', "“Software”").replace('"AS IS"', "“AS IS”"),
             "Prólogo… «Released under the MIT License.»"]
    got = sorted((r.doc_id, r.licence, r.n_sentences) for r in licences.licences(documents(spark, texts)).collect())
    assert got == [(0, "MIT", 4), (1, "MIT", 1)]


def test_licences(spark):
    mit = "\n".join(licences.SENTENCES[s] for s in ("mit-permission", "mit-notice", "mit-as-is", "mit-liability"))
    texts = ["Some prose\nReleased under the MIT License.\nMore.", "x. " + mit.replace(" copies", "\ncopies") + " End.",
             "not Released under the MIT License at all", None, "", "Licensed under CC BY-NC 4.0.", "licensed under the apache license, version 2.0"]
    docs = documents(spark, texts).selectExpr("*", "'r' as rule")
    got = sorted((r.doc_id, r.licence, r.n_sentences) for r in licences.licences(docs).collect())
    assert got == [(0, "MIT", 1), (1, "MIT", 4), (5, "CC-BY-NC-4.0", 1), (6, "Apache-2.0", 1)]
    assert licences.licences(docs.limit(0)).count() == 0


def test_licences_of_the_common_kinds_parts_and_tags(spark):
    say = licences.SENTENCES
    texts = {say["mit-permission"]: ["MIT"], say["gpl-hope"]: ["GNU"], say["gpl-details"]: ["GPL"], say["apache-may-not"]: ["Apache-2.0"], say["bsd-source"]: ["BSD"],
             say["gpl-without"]: ["GNU"], say["unlicense-free"]: ["Unlicense"], say["isc-permission"]: ["ISC"], say["epl2-available"]: ["EPL-2.0"],
             " ".join(say[s] for s in ("gpl2-free-program", "gpl-hope", "gpl-without", "gpl-details")): ["GPL-2.0-or-later"],
             " ".join(say[s] for s in ("lgpl2.1-free-library", "gpl-hope-library", "gpl-without", "lgpl-details")): ["LGPL-2.1-or-later"],
             " ".join(say[s] for s in ("mpl2-subject", "mpl2-copy-https")): ["MPL-2.0"], say["agpl3-free-program"]: ["AGPL-3.0-or-later"],
             "This project is licensed under the GPLv3.": ["GPL-3.0-only"], "Licensed under CC BY-NC-SA 3.0.": ["CC-BY-NC-SA-3.0"],
             "/* SPDX-License-Identifier: MIT */": ["MIT"], "# SPDX-License-Identifier: (MIT OR Zlib) AND 0BSD\nx": ["0BSD", "MIT", "Zlib"],
             "é spdx-license-identifier: gpl-2.0+.": ["GPL-2.0+"], "SPDX-License-Identifier: Apache-2.0+": ["Apache-2.0+"],
             "SPDX-License-Identifier: GPL-2.0-only WITH Classpath-exception-2.0": ["GPL-2.0-only WITH Classpath-exception-2.0"],
             "SPDX-License-Identifier: LicenseRef-Own": ["LicenseRef-Own"], "SPDX-License-Identifier: see below": []}
    rows = licences.licences(documents(spark, list(texts))).collect()
    assert [sorted(r.licence for r in rows if r.doc_id == i) for i in range(len(texts))] == list(texts.values())
    assert [(r.first_word, r.end_word) for r in rows if r.licence == "GPL-2.0+"] == [(1, 7)]
    known = spark.createDataFrame([("own", "Our own words only.")], "id string, text string")
    rules = spark.createDataFrame([("Own", ["own"])], "licence string, ids array<string>")
    got = licences.licences(documents(spark, ["Our own words only.", "MIT License"]), known, rules).collect()
    assert [(r.doc_id, r.licence) for r in got] == [(0, "Own")]


# --- URL rules

def test_hosts_paths_and_fixed_rules(spark):
    urls = {"http://A.Example.net/en/1?q#f": ("a.example.net", "/en/1", "example.net/en/", "allow"),
            "https://example.net/de/": ("example.net", "/de/", "net/", "block"), "http://net/": ("net", "/", "net/", "block"),
            "http://x.net": ("x.net", "", None, "allow"), "http://xexample.com/de/": ("xexample.com", "/de/", None, "allow"),
            "ftp://www.example.com/de/a": ("www.example.com", "/de/a", "example.com/de/", "block"),
            "http://a.org/fr/x#y": ("a.org", "/fr/x", "org/fr/", "allow"), "no url": ("", "", None, "allow"), None: ("", "", None, "allow"),
            "x://": ("", "", None, "allow"), "a://É.NET/p\nq://b?c": ("É.net", "/p\nq://b", "net/", "block")}
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").selectExpr("*", "'t' as tokens", "'h' as host")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urlrules.judge(pages, none, URL_RULES).collect()}
    assert got == dict(enumerate(urls.values()))
    assert urlrules.judge(pages.limit(0), none, URL_RULES).count() == 0


def test_mined_rules_against_brute_force(spark):
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(400):
        host, step = rng.choice(["a.com", "b.com", "c.com"]), rng.choice(["x", "y"])
        rows.append((i, f"http://{host}/{step}/{i}"))
        labels.append((i, 0 if (host, step) == ("a.com", "x") and rng.random() < 0.9 or rng.random() < 0.05 else 1, 0))
    pages = spark.createDataFrame(rows, "page_id long, url string")
    told = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {
        r.page_id: r for r in urlrules.judge(pages, told, URL_RULES, min_confidence=0.6).collect()}
    group = Counter((u.split("/")[2], u.split("/")[3]) for _, u in rows)
    bad = Counter((u.split("/")[2], u.split("/")[3]) for (_, u), (_, q, _) in zip(rows, labels, strict=True) if q == 0)
    for i, u in rows:
        key = (u.split("/")[2], u.split("/")[3])
        assert (got[i].verdict == "block") == (bad[key] / group[key] >= 0.6)
        if got[i].verdict == "block":
            assert got[i].confidence == pytest.approx(bad[key] / group[key])


def test_long_urls_do_not_make_all_their_subsets(spark):
    """A URL of 40 segments on 25 bad pages: one class of tokens, not 2^40 item sets; a
    page with some of these segments is judged as all the subsets' rules would judge it."""
    long = "/".join(f"seg{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(40))
    rows = [(i, f"http://ok.com/fine/{i}") for i in range(370)] + [(370 + i, f"http://ok.com/{long}") for i in range(25)]
    rows += [(395 + i, f"http://ok.com/{long}/x") for i in range(5)] + [(400, "http://new.org/a/segba/b"), (401, "http://new.org/a/b")]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    told = spark.createDataFrame([(i, int(not 370 <= i < 395), 0) for i in range(400)], "doc_id long, quality int, toxic int")
    got = {r.page_id: r for r in urlrules.judge(pages, told, [("allow", "no.example", "/")]).collect()}
    assert {i for i, r in got.items() if r.verdict == "block"} == {*range(370, 401)}
    assert got[400].confidence == pytest.approx(25 / 30)


def test_urls_repeated_long_null_and_tied(spark):
    rows = [(1, "http://a.com/x")] * 2 + [(2, "http://a.com/" + "y/" * 20000), (3, None), (None, "http://a.net/")]
    pages = spark.createDataFrame(rows, "page_id long, url string").selectExpr("*", "1 as tokens", "2 as rep", "3 as classes", "4 as bad")
    labels = spark.createDataFrame([(1, 0, 0), (1, 1, 0), (2, 1, 0), (None, 0, 1)], "doc_id long, quality int, toxic int")
    ties = [("block", "a.com", "/x"), ("allow", "com", "/x")]
    got = urlrules.judge(pages, labels, ties, min_confidence=0.9, min_count=1)
    assert sorted((r.page_id or 0, r.verdict, r.rule or "") for r in got.collect()) == [
        (0, "allow", ""), (1, "block", "a.com/x"), (1, "block", "a.com/x"), (2, "allow", ""), (3, "allow", "")]


def test_rare_bad_names_are_blocked_in_a_large_table(spark):
    """A host with 30 of 20,000 labelled pages, and a bad name spread over domains."""
    urls = [f"http://site{i % 97}.com/p/{i}" for i in range(20000)]
    urls[100:130] = [f"http://rare.example/{i}" for i in range(30)]
    for k, end in enumerate(("com", "net", "org")):
        urls[200 + 8 * k:208 + 8 * k] = [f"http://casino-win{k}.site{k}.{end}/{i}" for i in range(8)]
    bad = {*range(100, 130), *range(200, 224)}
    pages = spark.createDataFrame([*enumerate(urls), (20000, "http://best-casino.info/")], "page_id long, url string")
    told = spark.createDataFrame([(i, int(i not in bad), 0) for i in range(20000)], "doc_id long, quality int, toxic int")
    got = {r.page_id: r.verdict for r in urlrules.judge(pages, told, [("allow", "no.example", "/")]).collect()}
    assert {i for i, v in got.items() if v == "block"} == bad | {20000}


def test_rules_against_brute_force():
    """The longest rule at a place wins, from the left; neighbours at most ``gap`` words apart."""
    rng = random.Random(16)
    sentences = {n: f"sentence {n} of a licence." for n in "abcd"}
    rules = [("one", ["a", "b", "c"]), ("two", ["b", "c"]), ("three", ["a", "b"]), ("four", ["d"])]
    scanner = licences.Scanner(sentences, rules)
    every = {tuple(order): name for name, order in licences.with_parts(rules)}
    for _ in range(300):
        at, found = 0, []
        for _ in range(rng.randrange(8)):
            at += rng.choice([0, 5, 20])
            found.append((at, 5, "abcd".index(rng.choice("abcd"))))
            at += 5
        want, i = [], 0
        while i < len(found):
            for n in range(len(found) - i, 0, -1):
                own = found[i:i + n]
                key = tuple("abcd"[f[2]] for f in own)
                if key in every and all(y[0] - x[0] - x[1] <= 10 for x, y in zip(own, own[1:], strict=False)):
                    want.append((every[key], " ".join(key), n, own[0][0], own[-1][0] + own[-1][1]))
                    i += n - 1
                    break
            i += 1
        assert list(scanner.match(found, 10)) == want


def test_sentences_far_apart_are_not_one_notice(spark):
    known, order = {"x": "First known sentence here.", "y": "Second known sentence there."}, [("L", ["x", "y"])]
    texts = [f"First known sentence here. {'word ' * n}. Second known sentence there." for n in (0, 150, 10_000)]
    docs = documents(spark, [*texts, None, texts[0]]).union(spark.createDataFrame([(None, texts[0], None, None, None)] * 2, DOC))
    got = Counter((r.doc_id, r.licence, r.n_sentences) for r in licences.licences(docs, known, order).collect())
    assert got == {(0, "L", 2): 1, (1, "L", 2): 1, (2, "L", 1): 2, (4, "L", 2): 1, (None, "L", 2): 2}


# --- vectors

def test_vectors_against_brute_force(spark):
    rng = np.random.default_rng(9)
    rows, seeds = [], rng.normal(size=(30, 16))
    for i in range(500):
        v = seeds[i % 30] + rng.normal(size=16) * rng.choice([0, 0.02, 0.1, 0.3])
        rows.append((i, [float(np.float32(x)) for x in v], i % 4 if i % 50 else None))
    rows += [(500, None, 1), (501, [0.0] * 16, 1), (502, [float("nan")] * 16, 1), (503, [None] * 16, 1), (504, [1.0, 2.0], 1),
             (505, [2.0, 4.0], 1), (None, [1.0, 2.0], 1), (506, [float("inf")] + [1.0] * 15, 1), (507, [], 1)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").selectExpr("*", "1 as n", "2 as rep")
    n = 510
    links, root = [set() for _ in range(n)], list(range(n))
    ok = [(i, np.array(v), lab) for i, v, lab in rows if i is not None and v and lab is not None and None not in v
          and np.isfinite(v).all() and any(v)]
    for i, a, la in ok:
        for j, b, lb in ok:
            if j < i and la == lb and len(a) == len(b) and a @ b / np.sqrt((a @ a) * (b @ b)) >= 0.93:
                links[i].add(j)
                links[j].add(i)
    for _ in range(60):
        for i in range(n):
            root[i] = min([root[i], *(root[j] for j in links[i])])
    for block in (1024, 8):
        got = {r.vec_id: r for r in pivots.linked(table, block=block).collect()}
        assert len(got) == len(rows)
        found, real = sum(got[i].n_links for i in range(508)), sum(map(len, links))
        assert 0.9 * real <= found <= real
        assert all(got[i].n_links <= len(links[i]) and got[i].component_id >= root[i] for i in range(508))
        assert sum(got[i].component_id != root[i] for i in range(508)) <= 5
        assert all(got[i].kept == (got[i].component_id == i) for i in range(508))
        assert got[None].n_links == 0 and got[None].component_id is None and got[None].kept
    assert pivots.linked(table.limit(0)).count() == 0


def test_links_inside_a_hot_cluster(spark):
    """A third of the rows in one cluster of distinct vectors."""
    for seed, mean in ((2, 0.95), (3, 0.97)):
        rng = np.random.default_rng(seed)
        centre = rng.normal(size=64)
        near = centre / np.linalg.norm(centre) + np.sqrt((1 / mean - 1) / 64) * rng.normal(size=(800, 64))
        v = np.concatenate([near, rng.normal(size=(1600, 64))])
        unit = v / np.linalg.norm(v, axis=1, keepdims=True)
        real = int((unit @ unit.T >= 0.93).sum()) - len(v)
        table = spark.createDataFrame([(i, x.tolist(), 1) for i, x in enumerate(v)], "vec_id long, embedding array<double>, label int")
        found = sum(r.n_links for r in pivots.linked(table).collect())
        assert 0.9 * real <= found <= real
