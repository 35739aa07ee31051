"""Operator properties, checked against brute force on small random fixtures."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from yoyflow.operators.asof import count_on_or_after, first_on_or_after
from yoyflow.operators.audit import assert_unique, conservation, duplicate_keys, fanout_report
from yoyflow.operators.groups import distinct_indicator, group_flag, parent_hop
from yoyflow.operators.match import CASE_ORDER, best_match, candidate_counts
from yoyflow.operators.patch import update_from
from yoyflow.operators.temporal import first_event, year_offset_join

D0 = dt.date(2020, 1, 1)


def _day(i):
    return D0 + dt.timedelta(days=i)


# --- as-of ------------------------------------------------------------------------------


def test_first_on_or_after_matches_brute_force(spark):
    rnd = random.Random(7)
    cands = [(rnd.choice("ab"), _day(rnd.randint(0, 30)), rnd.randint(0, 5)) for _ in range(200)]
    probes = [(rnd.choice("abc"), _day(rnd.randint(-3, 33))) for _ in range(60)] + [("a", None)]
    c = spark.createDataFrame(cands, "k string, d date, v int")
    p = spark.createDataFrame(probes, "k string, d date")
    got = {(r.k, r.d): r.found for r in first_on_or_after(p, c, ["k"], "d", "v").collect()}
    for k, d in set(probes):
        if d is None:
            assert (k, d) not in got
            continue
        ok = [(cd, v) for ck, cd, v in cands if ck == k and cd >= d]
        want = min(ok)[1] if ok else None
        assert got[(k, d)] == want


def test_count_on_or_after_matches_brute_force(spark):
    rnd = random.Random(3)
    cands = [(rnd.choice("ab"), _day(rnd.randint(0, 20))) for _ in range(100)]
    probes = [(rnd.choice("ab"), _day(rnd.randint(0, 22))) for _ in range(40)]
    c = spark.createDataFrame(cands, "k string, d date")
    p = spark.createDataFrame(probes, "k string, d date")
    got = {(r.k, r.d): r.n for r in count_on_or_after(p, c, ["k"], "d", found="n").collect()}
    for k, d in set(probes):
        assert got[(k, d)] == sum(1 for ck, cd in cands if ck == k and cd >= d)


# --- tiered best match -----------------------------------------------------------------


def _label(probe, cand):
    _, acct, cls, own_c, own_p, day = probe
    c_acct, c_cls, c, prior, phx, prog, start, sub = cand
    eq = lambda a, b: a is not None and b is not None and a == b
    if eq(own_c, c) and eq(own_p, prog):
        return CASE_ORDER[0]
    if eq(own_c, c):
        return CASE_ORDER[1]
    if eq(own_c, prior) and eq(own_p, prog):
        return CASE_ORDER[2]
    if eq(own_c, phx) and eq(own_p, prog):
        return CASE_ORDER[3]
    if eq(own_c, prior):
        return CASE_ORDER[4]
    if eq(own_c, phx):
        return CASE_ORDER[5]
    if eq(own_p, prog) and day == start:
        return CASE_ORDER[6]
    if eq(own_p, prog):
        return CASE_ORDER[7]
    return CASE_ORDER[8]


def _brute_best(probes, cands):
    best = {}
    for pr in probes:
        pid, acct, cls, _, _, day = pr
        if day is None:
            continue
        for ca in cands:
            if ca[0] != acct or ca[1] != cls or ca[6] is None or ca[6] < day:
                continue
            key = (_label(pr, ca), ca[6], ca[2] is None, ca[2] or "", ca[7] is None, ca[7] or "")
            if pid not in best or key < best[pid][0]:
                best[pid] = (key, ca[2])
    return {pid: (v[0][0], v[1]) for pid, v in best.items()}


@pytest.mark.parametrize("seed", [1, 2, 3, 4, 5, 6, 7, 8])
def test_best_match_matches_brute_force(spark, seed):
    rnd = random.Random(seed)
    contracts = ["C1", "C2", "C3", "C4", None]
    progs = ["P1", "P2", None]
    cands = [
        (rnd.choice("xy"), rnd.choice("AB"), rnd.choice(contracts), rnd.choice(contracts), rnd.choice(contracts),
         rnd.choice(progs), _day(rnd.randint(0, 12)), rnd.choice([f"S{i}" for i in range(30)] + [None]))
        for _ in range(120)
    ]
    probes = [
        (f"R{rnd.randint(0, 25)}", rnd.choice("xy"), rnd.choice("AB"), rnd.choice(contracts), rnd.choice(progs),
         rnd.choice([_day(rnd.randint(0, 12)), None]))
        for _ in range(60)
    ]
    cdf = spark.createDataFrame(cands, "account string, class string, contract string, prior string, prior_phx string, program string, start date, sub string")
    pdf = spark.createDataFrame(probes, "probe_id string, account string, class string, own_contract string, own_program string, day date")
    got = {r.probe_id: (r.match_label, r.contract) for r in best_match(pdf, cdf).collect()}
    assert got == _brute_best(probes, cands)
    # one row per probe id, independent of partitioning
    again = {r.probe_id: (r.match_label, r.contract) for r in best_match(pdf.repartition(3), cdf.repartition(5)).collect()}
    assert again == got
    counts = {r.probe_id: r.n_candidates for r in candidate_counts(pdf, cdf).collect()}
    brute = {}
    for pid, acct, cls, _, _, day in probes:
        if day is None:
            continue
        n = sum(1 for ca in cands if ca[0] == acct and ca[1] == cls and ca[6] >= day)
        brute[pid] = brute.get(pid, 0) + n
    assert counts == {k: v for k, v in brute.items() if v > 0}


# --- update_from ------------------------------------------------------------------------


def test_update_from_changes_only_listed_columns(spark):
    target = spark.createDataFrame([(1, "a", "x"), (2, "b", "y"), (3, "c", "z"), (None, "d", "w")], "k int, v string, w string")
    source = spark.createDataFrame([(1, "A"), (2, None), (9, "Q"), (None, "N")], "k int, nv string")
    out = update_from(target, source, ["k"], {"v": "nv"})
    rows = sorted(out.collect(), key=lambda r: (r.k is None, r.k))
    assert [(r.k, r.v, r.w) for r in rows] == [(1, "A", "x"), (2, None, "y"), (3, "c", "z"), (None, "d", "w")]
    assert out.columns == target.columns


def test_update_from_duplicate_source_key(spark):
    target = spark.createDataFrame([(1, "a")], "k int, v string")
    source = spark.createDataFrame([(1, "B"), (1, "A")], "k int, nv string")
    with pytest.raises(Exception, match="duplicate key"):
        update_from(target, source, ["k"], {"v": "nv"}).collect()
    assert update_from(target, source, ["k"], {"v": "nv"}, on_duplicate="smallest").collect()[0].v == "A"


# --- year offsets, first events, groups -----------------------------------------------------


def test_year_offset_join_equals_per_offset_joins(spark):
    lines = spark.createDataFrame([("a", 2020), ("a", 2021), ("b", 2021), (None, 2021)], "acct string, fy int")
    snap = spark.createDataFrame([("a", 2019, 10), ("a", 2020, 11), ("a", 2021, 12), ("a", 2022, 13), ("b", 2022, 20)], "acct string, fy int, t int")
    attrs = {-1: {"t_prev": "t"}, 0: {"t_now": "t"}, 1: {"t_next": "t"}}
    fast = year_offset_join(lines, snap, [("acct", "acct")], "fy", "fy", attrs)
    slow = year_offset_join(lines, snap, [("acct", "acct")], "fy", "fy", attrs, on_duplicate="keep")
    key = lambda r: (r.acct or "", r.fy)
    assert sorted(fast.collect(), key=key) == sorted(slow.select(*fast.columns).collect(), key=key)
    got = {(r.acct, r.fy): (r.t_prev, r.t_now, r.t_next) for r in fast.collect()}
    assert got[("a", 2021)] == (11, 12, 13) and got[("b", 2021)] == (None, None, 20)
    assert got[(None, 2021)] == (None, None, None)


def test_year_offset_join_rejects_duplicate_snapshot(spark):
    lines = spark.createDataFrame([("a", 2020)], "acct string, fy int")
    snap = spark.createDataFrame([("a", 2020, 1), ("a", 2020, 2)], "acct string, fy int, t int")
    with pytest.raises(Exception, match="duplicate key"):
        year_offset_join(lines, snap, [("acct", "acct")], "fy", "fy", {0: {"t": "t"}}).collect()


def test_first_event_and_group_flag_null_keys(spark):
    df = spark.createDataFrame(
        [("a", 2024, _day(3)), ("a", 2024, _day(1)), ("a", 2023, _day(0)), (None, 2024, _day(2))], "k string, fy int, d date"
    )
    out = first_event(df, ["k"], "d", F.col("fy") == 2024, "first")
    got = sorted((r.k or "", r.fy, r.first) for r in out.collect())
    assert got == [("", 2024, None), ("a", 2023, _day(1)), ("a", 2024, _day(1)), ("a", 2024, _day(1))]
    flagged = group_flag(df, ["k"], {"n": F.count(F.lit(1))})
    assert sorted((r.k or "", r.n) for r in flagged.collect()) == [("", None), ("a", 3), ("a", 3), ("a", 3)]


def test_distinct_indicator_never_fans_out(spark):
    df = spark.createDataFrame([("a", 1), ("b", 1), ("a", 2)], "k string, y int")
    members = spark.createDataFrame([("a", 1), ("a", 1), ("a", 1)], "mk string, my int")
    out = distinct_indicator(df, members, ["k", "y"], ["mk", "my"], "flag")
    assert out.count() == 3
    assert sorted((r.k, r.y, r.flag) for r in out.collect()) == [("a", 1, 1), ("a", 2, None), ("b", 1, None)]


def test_parent_hop(spark):
    opps = spark.createDataFrame([("o1", "C0", None), ("o2", "C1", "o1"), ("o3", "C2", "o9")], "id string, c string, parent string")
    out = parent_hop(opps, "parent", opps, "id", {"parent_c": "c"})
    assert sorted((r.id, r.parent_c) for r in out.collect()) == [("o1", None), ("o2", "C0"), ("o3", None)]


# --- audits ---------------------------------------------------------------------------------


def test_audits(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (2, 1)], "a int, b int")
    assert [(r.a, r.b, r.n_rows) for r in duplicate_keys(df, ["a", "b"]).collect()] == [(1, 1, 2)]
    with pytest.raises(ValueError):
        assert_unique(df, ["a", "b"])
    assert_unique(df.distinct(), ["a", "b"])
    right = spark.createDataFrame([(1,), (1,), (3,)], "a int")
    rep = {r.right_matches: r.n_left_rows for r in fanout_report(df, right, ["a"], ["a"]).collect()}
    assert rep == {2: 3, 0: 1}
    pool = spark.createDataFrame([("u", 10.0), ("v", 5.0)], "k string, x double")
    alloc = spark.createDataFrame([("u", 4.0), ("u", 4.0), ("w", 1.0)], "k string, x double")
    res = {r.k: r.residual for r in conservation(pool, alloc, ["k"], "x", "x").collect()}
    assert res == {"u": 2.0, "v": 5.0, "w": -1.0}


def test_best_match_relations_and_null_ids(spark):
    cand = "account string, class string, contract string, prior string, prior_phx string, program string, start date, sub string"
    probe = "probe_id string, account string, class string, own_contract string, own_program string, day date"
    cdf = spark.createDataFrame(
        [
            ("x", "A", "K", "K", "K", "P", _day(5), "S1"),  # one relation to K: own
            ("x", "A", "N", "K", "K", "P", _day(4), "S2"),  # prior hides the migrated prior
            ("x", "A", None, None, "M", "Q", _day(4), "S3"),
            ("x", "A", "Z", None, None, "P", _day(9), "S4"),
        ],
        cand,
    )
    pdf = spark.createDataFrame(
        [
            ("a", "x", "A", "K", "P", _day(1)),
            ("b", "x", "A", "M", "P", _day(1)),
            ("c", "x", "A", None, "P", _day(9)),
            ("d", "x", "A", "none", "R", _day(6)),
            (None, "x", "A", "K", "P", _day(5)),
            (None, "x", "A", None, "P", _day(9)),
            ("gone", "x", "A", "K", "P", _day(10)),
            ("no day", "x", "A", "K", "P", None),
        ],
        probe,
    )
    got = {r.probe_id: (r.match_label[:2], r.sub, r.start) for r in best_match(pdf, cdf).collect()}
    assert got == {"a": ("1A", "S1", _day(5)), "b": ("2B", "S3", _day(4)), "c": ("3A", "S4", _day(9)), "d": ("3C", "S4", _day(9)), None: ("1A", "S1", _day(5))}
    assert best_match(pdf, cdf).count() == len(got)
    assert best_match(pdf, cdf.limit(0)).count() == 0


@pytest.mark.parametrize("seed", [11, 12, 13])
def test_tier_pair_counts_match_brute_force(spark, seed):
    from yoyflow.operators.match import tier_pair_counts

    rnd = random.Random(seed)
    contracts = ["C1", "C2", "C3", None]
    progs = ["P1", "P2", None]
    cands = [
        (rnd.choice("xy"), "A", rnd.choice(contracts), rnd.choice(contracts), rnd.choice(contracts),
         rnd.choice(progs), _day(rnd.randint(0, 8)), f"S{i}")
        for i in range(150)
    ]
    probes = [
        (f"R{i}", rnd.choice("xy"), "A", rnd.choice(contracts), rnd.choice(progs), _day(rnd.randint(0, 8)))
        for i in range(50)
    ]
    cdf = spark.createDataFrame(cands, "account string, class string, contract string, prior string, prior_phx string, program string, start date, sub string")
    pdf = spark.createDataFrame(probes, "probe_id string, account string, class string, own_contract string, own_program string, day date")
    got = {r.MatchCat: r.n_pairs for r in tier_pair_counts(pdf, cdf).collect()}
    want = {}
    for pr in probes:
        for ca in cands:
            if ca[0] == pr[1] and ca[1] == pr[2] and ca[6] >= pr[5]:
                lab = _label(pr, ca)
                want[lab] = want.get(lab, 0) + 1
    assert got == want


@pytest.mark.parametrize("few", [0, 12, 1000])
def test_match_of_small_and_large_groups(spark, monkeypatch, few):
    """Groups of up to FEW candidates are joined, larger ones searched by keys; a probe id may have rows of both."""
    from yoyflow.operators import match

    monkeypatch.setattr(match, "FEW", few)
    rnd = random.Random(few)
    contracts, progs = ["C1", "C2", "C3", None], ["P1", "P2", None]
    accounts = ["big"] * 6 + ["x", "y", "z", None]
    cands = [
        (rnd.choice(accounts), rnd.choice("AB"), rnd.choice(contracts), rnd.choice(contracts), rnd.choice(contracts),
         rnd.choice(progs), _day(rnd.randint(0, 9)), rnd.choice([f"S{i}" for i in range(30)] + [None]))
        for _ in range(90)
    ]
    probes = [
        (rnd.choice([f"R{i}" for i in range(25)] + [None]), rnd.choice(accounts), rnd.choice("AB"), rnd.choice(contracts), rnd.choice(progs),
         rnd.choice([_day(rnd.randint(0, 9)), None]))
        for _ in range(60)
    ]
    sizes = {}
    for ca in cands:
        sizes[ca[:2]] = sizes.get(ca[:2], 0) + 1
    assert few != 12 or min(sizes.values()) <= few < max(sizes.values())
    cdf = spark.createDataFrame(cands, "account string, class string, contract string, prior string, prior_phx string, program string, start date, sub string")
    pdf = spark.createDataFrame(probes, "probe_id string, account string, class string, own_contract string, own_program string, day date")
    pairs = [(pr, ca) for pr in probes for ca in cands if pr[5] and pr[1] and ca[:2] == pr[1:3] and ca[6] >= pr[5]]
    got = {r.probe_id: (r.match_label, r.contract) for r in best_match(pdf, cdf).collect()}
    assert got == _brute_best([p for p in probes if p[1]], cands)
    counts, tiers = {}, {}
    for pr, ca in pairs:
        counts[pr[0]] = counts.get(pr[0], 0) + 1
        tiers[_label(pr, ca)] = tiers.get(_label(pr, ca), 0) + 1
    assert {r.probe_id: r.n_candidates for r in candidate_counts(pdf, cdf).collect()} == counts
    assert {r.MatchCat: r.n_pairs for r in match.tier_pair_counts(pdf, cdf).collect()} == tiers
