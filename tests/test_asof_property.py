"""Property test: the multi-slot forward as-of search equals brute force."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from yoyflow.operators.asof import first_on_or_after

D0 = dt.date(2021, 3, 1)
key = st.sampled_from(["a", "b", "c"])
day = st.integers(min_value=0, max_value=12).map(lambda i: D0 + dt.timedelta(days=i))
slot = st.one_of(st.none(), st.integers(min_value=0, max_value=50))
cands_st = st.lists(st.tuples(key, day, slot, slot), min_size=0, max_size=40)
probes_st = st.lists(st.tuples(key, day), min_size=1, max_size=15)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(cands=cands_st, probes=probes_st)
def test_first_on_or_after_slots(spark, cands, probes):
    c = spark.createDataFrame(cands or [("z", D0, None, None)], "k string, d date, v0 int, v1 int")
    p = spark.createDataFrame(probes, "k string, d date")
    got = {(r.k, r.d): (r.f_v0, r.f_v1) for r in first_on_or_after(p, c, ["k"], "d", ["v0", "v1"], found="f").collect()}
    for k, d in set(probes):
        want = []
        for i in (2, 3):
            # smallest value of the earliest day on or after d that has a value in this slot
            days = sorted({cd for ck, cd, *vals in cands if ck == k and cd >= d and vals[i - 2] is not None})
            want.append(min(vals[i - 2] for ck, cd, *vals in cands if ck == k and cd == days[0] and vals[i - 2] is not None) if days else None)
        assert got[(k, d)] == tuple(want)
