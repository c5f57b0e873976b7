"""Property tests on small random frames (few examples: each runs Spark jobs)."""

from __future__ import annotations

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from daybook.operators import attributes as A
from daybook.operators.anti import not_in
from daybook.plans import calendar as C

SETTINGS = settings(max_examples=12, deadline=None, derandomize=True,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

keys = st.one_of(st.none(), st.sampled_from(["a", "b", "c", "d"]))


@SETTINGS
@given(left=st.lists(keys, max_size=6), right=st.lists(keys, max_size=4))
def test_not_in_equals_sql_not_in(spark, left, right):
    l_df = spark.createDataFrame([(k,) for k in left], "k string")
    r_df = spark.createDataFrame([(k,) for k in right], "k string")
    l_df.createOrReplaceTempView("pl")
    r_df.createOrReplaceTempView("pr")
    want = sorted(r.k or "" for r in spark.sql("SELECT k FROM pl WHERE k NOT IN (SELECT k FROM pr)").collect())
    got = sorted(r.k or "" for r in not_in(l_df, "k", r_df, "k").collect())
    assert got == want


holiday = st.tuples(st.integers(0, 1), st.integers(1, 12), st.integers(1, 31), st.integers(2023, 2025))


@SETTINGS
@given(rows=st.lists(holiday, max_size=12), start=st.integers(0, 360))
def test_next_business_day_equals_brute_force(spark, rows, start):
    hld = spark.createDataFrame([(r, m, d, y, "h") for r, m, d, y in rows],
                                "isannualyrecurring int, monthofyear int, dayofmonth int, year int, name string")
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=start + i) for i in range(0, 20, 3)]
    got = {r.fecha: r.next_business_day for r in
           C.next_business_day(spark.createDataFrame([(d,) for d in days], "fecha date"), hld).collect()}

    def is_holiday(x):
        for r, m, d, y in rows:
            if r == 1 and (x.month, x.day) == (m, d):
                return True
            if r != 1 and (x.year, x.month, x.day) == (y, m, d):
                return True
        return False

    for d in days:
        n = d + dt.timedelta(days=1)
        while n.weekday() >= 5 or is_holiday(n):
            n += dt.timedelta(days=1)
        assert got[d.isoformat()] == n.isoformat()


attr_rows = st.dictionaries(st.tuples(st.integers(1, 5), st.sampled_from(["k1", "k2", "k3"])),
                            st.one_of(st.none(), st.text("xyz", min_size=1, max_size=3)), max_size=12)


@SETTINGS
@given(attrs=attr_rows)
def test_pivot_equals_lookup_joins_when_pairs_are_unique(spark, attrs):
    ents = spark.createDataFrame([(f"e{i}",) for i in range(1, 6)], "ek string")
    cfv = spark.createDataFrame([(f"e{e}", k, v) for (e, k), v in attrs.items()],
                                "parentkey string, customfieldkey string, value string")
    names = {"k1": "k1", "k2": "k2", "k3": "k3"}
    joined = ents
    for n, k in names.items():
        joined = A.lookup_join(joined, "ek", cfv, n, k)
    piv = A.attach_attributes(ents, "ek", cfv, names)
    cols = ["ek", "k1", "k2", "k3"]
    a = sorted(tuple(r[c] or "" for c in cols) for r in joined.collect())
    b = sorted(tuple(r[c] or "" for c in cols) for r in piv.select(*cols).collect())
    assert a == b
    # mandatory lookups: present keys count even with a NULL value
    req = A.attach_attributes(ents, "ek", cfv, {"k1": "k1"}, required=["k1"])
    want = sorted(f"e{e}" for (e, k) in attrs if k == "k1")
    assert sorted(r.ek for r in req.collect()) == want
