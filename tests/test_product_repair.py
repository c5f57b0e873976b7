"""Repair of damaged product dumps against plain Python."""

from __future__ import annotations

import itertools
import random
import re

import pytest

from daybook.session import Scope
from daybook.sources import product_repair as R
from daybook.sources.product_csv import N_FIELDS, PRODUCT_SCHEMA

BOOL, NUMBER, TEXT = re.compile("true|false"), re.compile(r"\d+"), None


def plain_align(pieces, null, patterns):
    """All ways to deal the pieces, the cheapest; earlier merges first."""
    n, k, best = len(pieces), len(patterns), None
    empty = [not q and x in ("", null) for x, q in pieces]
    for used in range(k, n + 1):
        if not all(empty[used:]):
            continue
        for cuts in itertools.combinations(range(1, used), k - 1):
            ends, cost = [0, *cuts, used], 0
            for f, p in enumerate(patterns):
                own = range(ends[f], ends[f + 1])
                if not (empty[own[0]] or p is None or p.fullmatch(pieces[own[0]][0])) or (len(own) > 1 and p is not None):
                    break
                for i in own[1:]:
                    cost += R._WITH_EMPTY if empty[i] or empty[i - 1] else R._AT_BLANK if pieces[i][0].startswith(" ") else R._AT_COMMA
            else:
                best = cost if best is None else min(best, cost)
    return best


def cost_of(fields, pieces, null):
    """The cost of a dealing, found again from the fields' texts."""
    at, cost = 0, 0
    empty = [not q and x in ("", null) for x, q in pieces]
    for t in fields:
        text, first = pieces[at][0], at
        if t is None:
            assert empty[at]
        else:
            while text != t:
                at += 1
                text += "," + pieces[at][0]
                cost += R._WITH_EMPTY if empty[at] or empty[at - 1] else R._AT_BLANK if pieces[at][0].startswith(" ") else R._AT_COMMA
        assert at >= first
        at += 1
    assert all(empty[at:])
    return cost


def test_alignment_is_the_cheapest(monkeypatch):
    patterns = [TEXT, BOOL, TEXT, NUMBER, TEXT, BOOL]
    monkeypatch.setattr(R, "_PATTERNS", patterns)
    monkeypatch.setattr(R, "N_FIELDS", len(patterns))
    rng, found = random.Random(1), 0
    for _ in range(600):
        pieces = [(rng.choice(["true", "7", "x", " y", "None", ""]), rng.random() < 0.1) for _ in range(rng.randrange(4, 10))]
        if rng.random() < 0.7:      # one that fits, with a few more pieces
            pieces = [("a", False), ("true", False), ("b", False), ("12", False), ("c", False), ("false", False)]
            for _ in range(rng.randrange(4)):
                pieces.insert(rng.randrange(1, len(pieces) + 1), (rng.choice([" z", "w", "None"]), False))
        got, want = R.align(pieces, "None"), plain_align(pieces, "None", patterns)
        assert (got is None) == (want is None), pieces
        if got is not None:
            found += 1
            assert cost_of(got, pieces, "None") == want, (pieces, got)
    assert found > 200


@pytest.mark.parametrize("text,want", [
    ('a,b', [("a", False), ("b", False)]), ('', [("", False)]), (',', [("", False), ("", False)]), ('"x, ""y""",z', [('x, "y"', True), ("z", False)]),
    ('"a"b,c', [("ab", True), ("c", False)]), ('say "x,y', [('say "x', False), ("y", False)]), ('"",q', [("", True), ("q", False)]),
    ('a"b"c,d', [('a"b"c', False), ("d", False)])])
def test_pieces_between_commas(text, want):
    assert R.split_pieces(text) == want


def record(rng, key, text):
    f = ["None"] * N_FIELDS
    for i, field in enumerate(PRODUCT_SCHEMA.fields):
        kind = field.dataType.simpleString()
        if rng.random() < 0.8:
            f[i] = {"boolean": "True", "timestamp_ntz": "2021-05-06 07:08:09", "double": "2.5", "decimal(38,10)": "0E-10"}.get(kind, f"v{i}")
    f[0], f[6], f[7], f[10] = key, text, "False", f"id{key[:4]}"
    return f


def as_fields(f):
    return [None if x == "None" else x for x in f]


def test_a_dump_of_many_splits_is_put_together(spark, tmp_path):
    """Small splits, two files, all kinds of damage: the records are those written."""
    rng, want, bad = random.Random(2), {}, []
    for name in ("one", "two"):
        out = ["lost piece of another file,None,None"] if name == "two" else []
        for i in range(120):
            key = f"{rng.getrandbits(128):032x}"
            kind = rng.randrange(5)
            text = ["plain", 'two\nlines, "said"\n\nend', "one, two, three", "True, 5", "x\ny"][kind]
            f = record(rng, key, text)
            if kind in (1, 4):
                f[6] = '"' + text.replace('"', '""') + '"'
                line = ",".join(f).replace("\n", ",None" * 39 + "\n") + ",None" * 6
            else:
                line = ",".join(f)
            if i % 30 == 7:
                line = ",".join(f[:30])
                bad.append(key)
            else:
                want[key] = as_fields([*f[:6], text, *f[7:]])
            out.append(line)
        (tmp_path / name).write_text("\n".join(out) + "\n" + ("099, 20240122, 00000240\n" if name == "two" else ""))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
        with Scope(spark, "test") as scope:
            records, rejects = R.repair_product_dump(spark, str(tmp_path), scope)
            assert records.schema == PRODUCT_SCHEMA
            got = {r.encodedkey: r for r in records.collect()}
            assert sorted(r.record[:32] for r in rejects.collect()) == sorted([*bad, "lost piece of another file,None,"])
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got.keys() == want.keys()
    for key, f in want.items():
        assert got[key].c06 == f[6] and got[key].c07 is False and got[key].id == f[10] and got[key].c45 == f[45]
        assert [got[key][i] is None for i in range(N_FIELDS)] == [x is None for x in f]


def test_empty_dump(spark, tmp_path):
    (tmp_path / "d").write_text("")
    with Scope(spark, "test") as scope:
        records, rejects = R.repair_product_dump(spark, str(tmp_path / "d"), scope)
        assert records.count() == 0 and rejects.count() == 0
