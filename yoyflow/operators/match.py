"""Tiered best-match linking of a renewal to a later contract (``best_match``).

Problem.  Each probe (a pool row seen through its own subscription) has an
account, a class, its own contract, its own program and a period start day.
Every candidate subscription of the same account and class that starts on or
after that day is a possible renewal.  A candidate gets the label of the first
condition it meets, in this order (the source's CASE order):

    1  same contract and same program        1A: same contract + program
    2  same contract                         1B: same contract
    3  own contract = candidate's prior
       contract, same program                2A: prior contract + program
    4  own contract = candidate's migrated
       prior contract, same program          2A: prior contract (PHX) + program
    5  own contract = candidate's prior      2B: prior contract + program
    6  own contract = migrated prior         2B: prior contract (PHX) + program
    7  same program, same start day          3A: same account + program + date
    8  same program                          3B: same account + program
    9  otherwise                             3C: same account

and the best candidate is the one with the smallest *label text* (binary
order -- so the migrated "(PHX)" variants outrank the direct ones), ties broken
by candidate start day, contract id, subscription id (ascending, NULLs last).

Plan.  Listing all (probe, candidate) pairs is quadratic per account.  Instead
every pair's label is read from keys.  For a contract k, a candidate is related
to k in at most one way, the first that holds of: its contract is k, its prior
contract is k, its migrated prior is k.  So a candidate has at most three rows
(k, relation), and with the probe's own contract as k the relation and "same
program" give the label of the pair:

    key (contract, program)   own 1A, prior 2A, migrated 2A (PHX)
    key (contract)            own 1B, prior 2B, migrated 2B (PHX), if no better
    key (program)             3A on the probe's own day, else 3B, if no better
    key ()                    3C, if no better

Under each key a probe needs, per relation, the first candidate on or after its
day: keyed forward as-of searches, which run together as one (see ``asof``) with
one value slot per relation, and whose work per key is bounded by the calendar
rather than by the group size.  The least (rank, start, contract, subscription)
found is the winner.

Small groups.  Nearly every account has a handful of candidates of a class; there
listing a probe's pairs is less work than six keys a candidate.  Groups (account,
class) of at most ``FEW`` candidates are joined and labelled pair by pair, so a
probe meets ``FEW`` candidates at most and the work stays linear; one equi-join
between shuffles, split where many probes share a group.  Larger groups, a hot
account among them, go by the keys below.  The groups' sizes are counted first, and
probes and candidates are stored before that, as they are read three times.

Cascade (large groups).  Contracts are looked up first.  Candidate rows under a contract that
no probe owns leave before the search (a semi-join on the key; the table of the
probes' keys is broadcast only if adaptive execution finds it small), and only
probes that found nothing go on to the keys by program and account.

Keys are named by 128 bits (two differently seeded 64-bit hashes of account,
class, shape and the rest of the key), so rows and sorts carry two longs instead
of five texts; among 10^12 keys two share a name with probability below 1e-14.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yoyflow.functions.rules import Rule, classify
from yoyflow.operators.asof import count_on_or_after, first_on_or_after, pair_totals
from yoyflow.session import cut_lineage

# --- fixed values (labels of the match tiers, in the source's CASE order) -----
LABEL_1A = "1A: same contract + program"
LABEL_1B = "1B: same contract"
LABEL_2A = "2A: prior contract + program"
LABEL_2A_PHX = "2A: prior contract (PHX) + program"
LABEL_2B = "2B: prior contract + program"
LABEL_2B_PHX = "2B: prior contract (PHX) + program"
LABEL_3A = "3A: same account + program + date"
LABEL_3B = "3B: same account + program"
LABEL_3C = "3C: same account"
CASE_ORDER = [LABEL_1A, LABEL_1B, LABEL_2A, LABEL_2A_PHX, LABEL_2B, LABEL_2B_PHX, LABEL_3A, LABEL_3B, LABEL_3C]
# candidates of an account and class up to which its pairs are listed
FEW = 64
# -------------------------------------------------------------------------------

# Ranking is by label text (binary order).
RANKED = sorted(CASE_ORDER)
# The per-rank keys below rely on this order; fail loudly if labels change.
assert RANKED == [LABEL_1A, LABEL_1B, LABEL_2A_PHX, LABEL_2A, LABEL_2B_PHX, LABEL_2B, LABEL_3A, LABEL_3B, LABEL_3C]
RANK_OF = {label: i + 1 for i, label in enumerate(RANKED)}

# Key shapes, and the relations of a candidate to the key's contract (value slots).
SHAPE_CP, SHAPE_C, SHAPE_P, SHAPE_A = 1, 2, 3, 4
OWN, PRIOR, MIGRATED = 0, 1, 2
SLOTS = ("_v0", "_v1", "_v2")
# shape -> labels of its slots; a key by program or account has one slot
SLOT_LABELS = {SHAPE_CP: (LABEL_1A, LABEL_2A, LABEL_2A_PHX), SHAPE_C: (LABEL_1B, LABEL_2B, LABEL_2B_PHX)}
_KEYS = ["_h1", "_h2", "_shape"]


def _rank_label(rank: Column) -> Column:
    expr = F.when(rank == 1, F.lit(RANKED[0]))
    for i, label in enumerate(RANKED[1:], start=2):
        expr = expr.when(rank == i, F.lit(label))
    return expr


def _named(shape: int, ok: Column, *parts: Column, slot: int = 0) -> Column:
    """(shape, slot, name of the key), or NULL unless ``ok`` and no part is NULL."""
    for p in parts:
        ok = ok & p.isNotNull()
    key = [F.lit(shape), F.col("_acct"), F.col("_cls"), *parts]
    return F.when(
        ok,
        F.struct(
            F.lit(shape).cast("tinyint").alias("_shape"),
            F.lit(slot).cast("tinyint").alias("_slot"),
            F.xxhash64(*key).alias("_h1"),
            F.xxhash64(F.lit("second"), *key).alias("_h2"),
        ),
    )


def _exploded(df: DataFrame, entries: list[Column], *keep: str) -> DataFrame:
    rows = F.filter(F.array(*entries), lambda x: x.isNotNull())
    return df.select(*keep, F.explode(rows).alias("_t")).select(*keep, "_t._shape", "_t._slot", "_t._h1", "_t._h2")


def _usable(df: DataFrame, day: str) -> DataFrame:
    """Rows that can be in a pair."""
    return df.where(F.col("account").isNotNull() & F.col("class").isNotNull() & F.col(day).isNotNull())


def _ids() -> list[Column]:
    """A candidate's ids in the order of their tie-break, NULLs last."""
    return [F.col("contract").isNull().alias("c_null"), F.col("contract"), F.col("sub").isNull().alias("s_null"), F.col("sub")]


def _probe_base(probes: DataFrame) -> DataFrame:
    return probes.select(
        "probe_id", F.col("account").alias("_acct"), F.col("class").alias("_cls"), F.col("day").alias("_day"), "own_contract", "own_program"
    )


def _candidate_base(candidates: DataFrame) -> DataFrame:
    return candidates.select(
        F.col("account").alias("_acct"),
        F.col("class").alias("_cls"),
        F.col("start").alias("_day"),
        "contract",
        "prior",
        "prior_phx",
        "program",
        F.struct(*_ids()).alias("_val"),
    )


def _probe_contract_keys() -> list[Column]:
    c, yes = F.col, F.lit(True)
    return [_named(SHAPE_CP, yes, c("own_contract"), c("own_program")), _named(SHAPE_C, yes, c("own_contract"))]


def _candidate_contract_keys() -> list[Column]:
    """A candidate's keys by contract: one relation per distinct contract value."""
    c = F.col

    def differ(a: str, b: str) -> Column:
        return ~F.coalesce(c(a) == c(b), F.lit(False))

    relations = [
        (OWN, "contract", F.lit(True)),
        (PRIOR, "prior", differ("prior", "contract")),
        (MIGRATED, "prior_phx", differ("prior_phx", "contract") & differ("prior_phx", "prior")),
    ]
    out = []
    for slot, field, ok in relations:
        out += [_named(SHAPE_CP, ok, c(field), c("program"), slot=slot), _named(SHAPE_C, ok, c(field), slot=slot)]
    return out


def _account_keys(program: str) -> list[Column]:
    return [_named(SHAPE_P, F.lit(True), F.col(program)), _named(SHAPE_A, F.lit(True))]


def _wanted(rows: DataFrame, probe_rows: DataFrame) -> DataFrame:
    """Candidate rows under a key that some probe has."""
    return rows.join(probe_rows.select(*_KEYS).distinct(), _KEYS, "left_semi")


def _first_hits(probe_rows: DataFrame, candidate_rows: DataFrame, slots: int) -> DataFrame:
    """``probe_id`` and the best (rank, start, contract, subscription) over its rows, NULL ids last."""
    names = list(SLOTS[:slots])
    values = [F.when(F.col("_slot") == i, F.col("_val")).alias(n) for i, n in enumerate(names)]
    found = first_on_or_after(probe_rows, candidate_rows.select(*_KEYS, "_day", *values), _KEYS, "_day", names, found="_f", with_day=True)
    hits = probe_rows.select("probe_id", *_KEYS, "_day").join(found, [*_KEYS, "_day"], "inner")

    def ranked(slot: int) -> Column:
        f = F.col(f"_f_{names[slot]}")
        start = F.col(f"_f_{names[slot]}_day")
        fields = [f[n].alias(n) for n in ("c_null", "contract", "s_null", "sub")]
        return F.when(f.isNotNull(), F.struct(_slot_rank(slot, start).alias("rank"), start.alias("start"), *fields))

    best = F.least(*map(ranked, range(slots))) if slots > 1 else ranked(0)
    rows = hits.select("probe_id", best.alias("_best")).where(F.col("_best").isNotNull())
    return rows.groupBy("probe_id").agg(F.min("_best").alias("_best"))


def _possible(candidates: DataFrame, probes: DataFrame, earliest: Column | None) -> DataFrame:
    """Drop candidates that start before every probe: they can match nothing.

    ``earliest`` is any lower bound of the probe days -- callers pass a cheap
    one (a scalar subquery over the table the probe days come from); without
    it the bound is taken from the probes themselves.  The filter runs before
    the explosion; with years of subscription history and a pool of a few
    years it removes most candidates.
    """
    if earliest is None:
        earliest = probes.select(F.min("day")).scalar()
    return candidates.where(F.col("start") >= earliest)


def _group_name() -> Column:
    """A long for (account, class).  Groups that share one are at worst both taken for large."""
    return F.xxhash64("account", "class")


def _by_group_size(probes: DataFrame, candidates: DataFrame, materialize: str) -> tuple[tuple[DataFrame, DataFrame], tuple[DataFrame, DataFrame]]:
    """(probes, candidates) of the groups of at most ``FEW`` candidates, and of the larger ones."""
    probes, candidates = cut_lineage(probes, materialize), cut_lineage(candidates, materialize)
    sizes = candidates.groupBy(_group_name().alias("_large")).agg(F.count(F.lit(1)).alias("_n"))
    # stored, so that its joins are planned by its real size: at most 1 / FEW of the candidates, mostly next to none
    large = cut_lineage(sizes.where(F.col("_n") > FEW).select("_large"), materialize)

    def part(df: DataFrame, how: str) -> DataFrame:
        return df.join(large, _group_name() == F.col("_large"), how)

    return (part(probes, "left_anti"), part(candidates, "left_anti")), (part(probes, "left_semi"), part(candidates, "left_semi"))


def _pairs(probes: DataFrame, candidates: DataFrame) -> DataFrame:
    """Every probe beside every candidate of its account and class on or after its day."""
    cand = candidates.select(F.col("account").alias("_c_acct"), F.col("class").alias("_c_cls"), *[c for c in candidates.columns if c not in ("account", "class")])
    same = (F.col("account") == F.col("_c_acct")) & (F.col("class") == F.col("_c_cls")) & (F.col("start") >= F.col("day"))
    return probes.join(cand, same, "inner")


def _pair_label() -> Column:
    """The label of a listed pair: the first condition it meets, in the source's CASE order."""
    own, same_program = F.col("own_contract"), F.col("own_program") == F.col("program")
    conditions = [
        (own == F.col("contract")) & same_program,
        own == F.col("contract"),
        (own == F.col("prior")) & same_program,
        (own == F.col("prior_phx")) & same_program,
        own == F.col("prior"),
        own == F.col("prior_phx"),
        same_program & (F.col("start") == F.col("day")),
        same_program,
    ]
    return classify([Rule(cond, label) for cond, label in zip(conditions, CASE_ORDER)], LABEL_3C)


def _label_rank(label: Column) -> Column:
    return F.array_position(F.array(*map(F.lit, RANKED)), label).cast("int")


def _slot_rank(slot: int, start: Column) -> Column:
    """Rank of a candidate found in value slot ``slot`` of the row's shape."""
    shape = F.col("_shape")
    expr = F.when(shape == SHAPE_P, F.when(start == F.col("_day"), RANK_OF[LABEL_3A]).otherwise(RANK_OF[LABEL_3B])).when(
        shape == SHAPE_A, RANK_OF[LABEL_3C]
    )
    for of, labels in SLOT_LABELS.items():
        expr = expr.when(shape == of, RANK_OF[labels[slot]])
    return expr


def best_match(probes: DataFrame, candidates: DataFrame, earliest: Column | None = None, materialize: str = "table") -> DataFrame:
    """Best candidate per probe id.

    probes:     probe_id, account, class, own_contract, own_program, day
    candidates: account, class, contract, prior, prior_phx, program, start, sub

    Returns probe_id, contract, sub, start, match_rank, match_label -- one row
    per probe id that has at least one candidate.  Several probe rows may share
    an id (the best over all of them is returned).
    """
    small, large = _by_group_size(_usable(probes, "day"), _usable(_possible(candidates, probes, earliest), "start"), materialize)
    listed = _pairs(*small).select("probe_id", F.struct(_label_rank(_pair_label()).alias("rank"), "start", *_ids()).alias("_best"))
    best = listed.unionByName(_best_by_keys(*large)).groupBy("probe_id").agg(F.min("_best").alias("_best"))
    return best.select(
        "probe_id",
        F.col("_best.contract").alias("contract"),
        F.col("_best.sub").alias("sub"),
        F.col("_best.start").alias("start"),
        F.col("_best.rank").alias("match_rank"),
        _rank_label(F.col("_best.rank")).alias("match_label"),
    )


def _best_by_keys(probes: DataFrame, candidates: DataFrame) -> DataFrame:
    """``probe_id`` and its best (rank, start, contract, subscription), by keyed searches."""
    cand, prob = _candidate_base(candidates), _probe_base(probes)
    by_contract = _exploded(prob, _probe_contract_keys(), "probe_id", "_day")
    linked = _wanted(_exploded(cand, _candidate_contract_keys(), "_day", "_val"), by_contract)
    first = _first_hits(by_contract, linked, len(SLOTS))
    # a probe id that found a contract has its winner: every label by contract outranks the rest
    left = prob.join(first.select(F.col("probe_id").alias("_id")), F.col("probe_id").eqNullSafe(F.col("_id")), "left_anti")
    rest = _exploded(left, _account_keys("own_program"), "probe_id", "_day")
    others = _first_hits(rest, _exploded(cand, _account_keys("program"), "_day", "_val"), 1)
    return first.unionByName(others)


def candidate_counts(probes: DataFrame, candidates: DataFrame, earliest: Column | None = None, materialize: str = "table") -> DataFrame:
    """Number of (probe, candidate) pairs per probe id; pairs are listed in small groups only.

    The pair condition is: same account and class, candidate start on or after
    the probe's day.  Probe ids with no candidate are omitted (as an inner
    range join would omit them).
    """
    prob = _usable(probes, "day").select("probe_id", "account", "class", "day")
    cand = _usable(_possible(candidates, probes, earliest), "start").select("account", "class", "start")
    small, large = _by_group_size(prob, cand, materialize)
    listed = _pairs(*small).select("probe_id", F.lit(1).cast("bigint").alias("_n"))
    keys = ["_kh", "account", "class"]
    many_probes, many = (df.withColumn("_kh", _group_name()) for df in large)
    counts = count_on_or_after(many_probes, many.withColumnRenamed("start", "day"), keys, "day", found="_n")
    counted = many_probes.join(counts, [*keys, "day"], "inner").select("probe_id", "_n")
    return listed.unionByName(counted).groupBy("probe_id").agg(F.sum("_n").alias("n_candidates")).where(F.col("n_candidates") > 0)


# --- pairs per tier, without listing the pairs of large groups ------------------------
#
# The key rows of ``best_match`` count pairs as well: a pair of equal contract key has
# one relation, so pairs under (contract, program) are 1A / 2A / 2A (PHX); those
# under (contract) less these are 1B / 2B / 2B (PHX); pairs of the same program, or
# of the account, that have no relation are what is left of their totals.


def tier_pair_counts(probes: DataFrame, candidates: DataFrame, earliest: Column | None = None, materialize: str = "table") -> DataFrame:
    """Number of (probe, candidate) pairs per tier label -- the histogram of the
    full pair table -- from the pairs of small groups and keyed counts of the others.

    Returns (MatchCat, n_pairs) for labels with at least one pair.
    """
    prob = _usable(probes, "day").drop("probe_id")
    cand = _usable(_possible(candidates, probes, earliest), "start").drop("sub")
    small, large = _by_group_size(prob, cand, materialize)
    listed = _pairs(*small).groupBy(_pair_label().alias("MatchCat")).agg(F.count(F.lit(1)).alias("n_pairs"))
    both = listed.unionByName(_pairs_by_keys(*large))
    return both.groupBy("MatchCat").agg(F.sum("n_pairs").alias("n_pairs"))


def _pairs_by_keys(probes: DataFrame, candidates: DataFrame) -> DataFrame:
    """(MatchCat, n_pairs) by keyed counts."""
    cand = _exploded(_candidate_base(candidates.withColumn("sub", F.lit(None).cast("string"))), [*_candidate_contract_keys(), *_account_keys("program")], "_day")
    prob = _exploded(_probe_base(probes.withColumn("probe_id", F.lit(None).cast("string"))), [*_probe_contract_keys(), *_account_keys("own_program")], "_day")
    counts = cand.select(*_KEYS, "_day", *[F.when(F.col("_slot") == i, 1).otherwise(0).alias(n) for i, n in enumerate(SLOTS)])
    totals = pair_totals(prob, counts, _KEYS, "_day", SLOTS, ["_shape"])

    def total(shape: int, name: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("_shape") == shape, F.col(name))), F.lit(0)).cast("bigint")

    names = [(shape, f"{v}_{end}") for shape in (SHAPE_CP, SHAPE_C, SHAPE_P, SHAPE_A) for v in SLOTS for end in ("from", "at")]
    wide = totals.agg(*[total(shape, n).alias(f"{n}{shape}") for shape, n in names])  # one row

    def at(shape: int, slot: int, end: str = "from") -> Column:
        return F.col(f"{SLOTS[slot]}_{end}{shape}")

    pairs: dict[str, Column] = {}
    for slot, (same, other) in enumerate(zip(SLOT_LABELS[SHAPE_CP], SLOT_LABELS[SHAPE_C])):
        pairs[same] = at(SHAPE_CP, slot)
        pairs[other] = at(SHAPE_C, slot) - at(SHAPE_CP, slot)
    related = sum((at(SHAPE_C, s) for s in range(3)), F.lit(0))
    with_program = at(SHAPE_P, 0) - sum((at(SHAPE_CP, s) for s in range(3)), F.lit(0))
    pairs[LABEL_3A] = at(SHAPE_P, 0, "at") - sum((at(SHAPE_CP, s, "at") for s in range(3)), F.lit(0))
    pairs[LABEL_3B] = with_program - pairs[LABEL_3A]
    pairs[LABEL_3C] = at(SHAPE_A, 0) - related - with_program
    rows = F.array(*[F.struct(F.lit(label).alias("MatchCat"), n.cast("bigint").alias("n_pairs")) for label, n in pairs.items()])
    return wide.select(F.explode(rows).alias("_r")).select("_r.MatchCat", "_r.n_pairs").where(F.col("n_pairs") > 0)
