"""Operator 1: n-gram Jaccard join with Bayesian candidate pruning.

Two texts are linked if the Jaccard similarity of their sets of word 5-grams
is at least 0.8.  Words are runs of a-z, 0-9 and non-ASCII characters after
lower-casing A-Z; a text of fewer words is one n-gram, a text without words
has no links.  N-grams are compared by 64-bit hashes.

1. Texts with equal sets are one class of copies; only one of them goes on.
2. MinHash values: ``BANDS`` bands of ``ROWS`` values.  Sets that share a band
   are candidates; a pair at the threshold shares none with probability
   (1 - 0.8^6)^48 < 5e-7.  Sets connected by shared bands form a component.
3. Within a component, sets are compared in blocks.  For all pairs of a block
   the values are compared ``STEP`` at a time; with m of n equal, the posterior
   of the similarity (uniform prior) is Beta(m + 1, n - m + 1), and the pair is
   dropped when that leaves less than ``TOLERANCE`` for 0.8 and more.  What
   remains is verified by the exact intersection.
4. A block returns per set its number of links and a root within the block;
   the roots are joined to near-duplicate classes.  No list of pairs is made,
   and a class of copies counts as often as it has members.

Scale: shuffled are one row of digest and values per document (copies combined
in the map task), ``BANDS`` pairs of longs per distinct set and, for sets that
share a band, their n-grams.  Those are fetched by a second scan that a
bounded Bloom filter thins out (a full filter only costs speed).  A component is cut into blocks of about ``BLOCK`` n-grams by a hash
of the set, and every pair of blocks is a task's group, so no group grows with
the data.  Stages are written to the shared folder.

Repeated rows are copies of each other.  Null ids stay null; an empty table
gives no rows.
"""

from __future__ import annotations

import hashlib
from math import comb

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from yoyflow.llm import bloom
from yoyflow.llm.common import slices, table
from yoyflow.llm.components import components
from yoyflow.llm.decontaminate import split_words, word_hashes
from yoyflow.operators.joins import hashed_join
from yoyflow.session import cut_lineage

WORDS = 5
THRESHOLD = 0.8
BANDS, ROWS = 48, 6
VALUES, STEP = 96, 16
TOLERANCE = 1e-7
BLOCK = 1 << 16
_PAIRS = 1 << 20
_FACTOR = 0x100000001B3
_MULTIPLIERS = np.random.default_rng(20).integers(1, 1 << 63, BANDS * ROWS, dtype=np.uint64) | np.uint64(1)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def ngram_sets(raw: list[bytes], n: int = WORDS) -> list[np.ndarray]:
    """The sorted hashes of each text's distinct n-grams."""
    words = split_words(raw)
    h = _mix(word_hashes(words, _FACTOR))
    count = np.bincount(words.text, minlength=words.texts)
    out = []
    rolled = np.zeros(max(0, len(h) - n + 1), np.uint64)
    for k in range(n):
        rolled = rolled * np.uint64(0x9E3779B97F4A7C15) + h[k : len(h) - n + 1 + k]
    rolled = _mix(rolled)
    for a, c in zip((np.cumsum(count) - count).tolist(), count.tolist(), strict=True):
        if c >= n:
            out.append(np.unique(rolled[a : a + c - n + 1]))
        elif c:
            short = np.uint64(c)
            with np.errstate(over="ignore"):
                for x in h[a : a + c]:
                    short = short * np.uint64(0x9E3779B97F4A7C15) + x
            out.append(_mix(np.array([short])))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _bytes(batch: pa.RecordBatch) -> list[bytes]:
    return pc.fill_null(batch.column("_text").cast(pa.binary()), b"").to_pylist()


def _digest(grams: np.ndarray) -> bytes:
    return hashlib.blake2b(grams.tobytes(), digest_size=16).digest()


def min_hashes(sets: list[np.ndarray]) -> np.ndarray:
    """16 bits of the least hash of each (non-empty) set under each of the functions."""
    flat = np.concatenate(sets)
    begin = np.cumsum([0, *(len(s) for s in sets[:-1])])
    out = np.empty((len(sets), len(_MULTIPLIERS)), np.uint16)
    for k, m in enumerate(_MULTIPLIERS):
        out[:, k] = np.minimum.reduceat((flat * m) >> np.uint64(24), begin).astype(np.uint16)
    return out


def _signatures(docs: DataFrame, keep: list[str]) -> DataFrame:
    """One row per document: row, id, digest of its set, size, band keys, values, and the columns ``keep``."""

    def run(batches):
        at = TaskContext.get().partitionId() << 33
        for batch in batches:
            for part in slices(batch, "_text"):
                sets = ngram_sets(_bytes(part))
                some = [i for i, s in enumerate(sets) if len(s)]
                keys: list = [None] * len(sets)
                values: list = [None] * len(sets)
                if some:
                    v = min_hashes([sets[i] for i in some])
                    band = np.zeros((len(some), BANDS), np.uint64)
                    for r in range(ROWS):
                        band = band * np.uint64(_FACTOR) + v[:, r::ROWS][:, :BANDS].astype(np.uint64) + np.uint64(1)
                    band = _mix(band + np.arange(BANDS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)
                    for j, i in enumerate(some):
                        keys[i], values[i] = band[j], v[j, :VALUES].tobytes()
                n = len(sets)
                yield pa.record_batch(
                    {
                        "row": pa.array(np.arange(at, at + n)),
                        "doc_id": part.column("doc_id"),
                        "digest": pa.array([_digest(s) if len(s) else None for s in sets], pa.binary()),
                        "size": pa.array([len(s) for s in sets], pa.int32()),
                        "keys": pa.array(keys, pa.list_(pa.int64())),
                        "min_values": pa.array(values, pa.binary()),
                        **{c: part.column(c) for c in keep},
                    }
                )
                at += n

    also = "".join(f", `{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return docs.mapInArrow(run, f"row long, doc_id long, digest binary, size int, keys array<long>, min_values binary{also}")


def least_matches(threshold: float, tolerance: float, values: int = VALUES, step: int = STEP) -> dict[int, int]:
    """After n compared values: the fewest equal ones with which a pair stays."""
    out = {}
    for n in range(step, values + 1, step):
        at_least = 0.0
        for m in range(n + 1):  # P(Beta(m + 1, n - m + 1) >= t) is a binomial sum
            at_least += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if at_least >= tolerance:
                out[n] = m
                break
    return out


def linked_pairs(values: np.ndarray, sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> tuple[np.ndarray, np.ndarray]:
    """Of the given pairs of places, those whose sets reach the threshold."""
    size = np.array([len(s) for s in sets])
    near = np.minimum(size[left], size[right]) >= threshold * np.maximum(size[left], size[right]) - 1e-9
    left, right = left[near], right[near]
    equal = np.zeros(len(left), np.int32)
    for n, least in least_matches(threshold, tolerance).items():
        equal += (values[left, n - STEP : n] == values[right, n - STEP : n]).sum(1, dtype=np.int32)
        stay = equal >= least
        left, right, equal = left[stay], right[stay], equal[stay]
    if not len(left):
        return left, right
    # n-grams of one set only are in no intersection; the others become bits
    used = np.unique(np.concatenate([left, right]))
    flat = np.concatenate([sets[i] for i in used.tolist()])
    grams, place, times = np.unique(flat, return_inverse=True, return_counts=True)
    shared = np.flatnonzero(times > 1)
    rank = np.full(len(grams), -1)
    rank[shared] = np.arange(len(shared))
    owner, place = np.repeat(np.arange(len(used)), size[used]), rank[place]
    owner, place = owner[place >= 0], place[place >= 0]
    bits = np.zeros((len(used), len(shared) // 64 + 1), np.uint64)
    np.bitwise_or.at(bits, (owner, place >> 6), np.uint64(1) << (place & 63).astype(np.uint64))
    a, b = np.searchsorted(used, left), np.searchsorted(used, right)
    common = np.empty(len(a), np.int64)
    step = max(1, (4 << 20) // bits.shape[1])
    for i in range(0, len(a), step):
        common[i : i + step] = np.bitwise_count(bits[a[i : i + step]] & bits[b[i : i + step]]).sum(1, dtype=np.int64)
    total = size[left] + size[right] - common
    ok = common >= threshold * total - 1e-9
    return left[ok], right[ok]


def _block_pairs(block: np.ndarray, i: int, j: int):
    """All pairs of places, one of block i and one of block j, in runs of bounded length."""
    first, second = np.flatnonzero(block == i), np.flatnonzero(block == j)
    rows = max(1, _PAIRS // max(1, len(second)))
    for k in range(0, len(first), rows):
        left, right = np.repeat(first[k : k + rows], len(second)), np.tile(second, len(first[k : k + rows]))
        if i == j:
            ok = left < right
            left, right = left[ok], right[ok]
        yield left, right


def _compare(group: pa.Table) -> pa.Table:
    """A pair of blocks of one component: links and copies linked per set, and a root."""
    ids = group.column("set_id").to_numpy()
    _, once = np.unique(ids, return_index=True)  # repeated rows of one document came twice
    group = group.take(pa.array(once))
    ids, block, copies = (group.column(c).to_numpy() for c in ("set_id", "block", "copies"))
    i, j = group.column("i")[0].as_py(), group.column("j")[0].as_py()
    values = np.frombuffer(b"".join(group.column("min_values").to_pylist()), np.uint16).reshape(len(ids), -1)
    sets = [np.frombuffer(g, np.uint64) for g in group.column("grams").to_pylist()]
    links, linked, root = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64), np.arange(len(ids))
    edges = []
    for left, right in _block_pairs(block, i, j):
        left, right = linked_pairs(values, sets, left, right)
        links += np.bincount(left, minlength=len(ids)) + np.bincount(right, minlength=len(ids))
        linked += np.bincount(left, copies[right], len(ids)).astype(np.int64) + np.bincount(right, copies[left], len(ids)).astype(np.int64)
        edges.append(_forest(left, right, len(ids)))
    root = _roots(edges, len(ids))
    return pa.table({"set_id": ids, "links": links, "linked": linked, "root": ids[root]})


def _forest(left: np.ndarray, right: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """At most n edges that connect what the given ones connect."""
    root = _roots([(left, right)], n)
    at = np.arange(n)
    return at[root != at], root[root != at]


def _roots(edges: list[tuple[np.ndarray, np.ndarray]], n: int) -> np.ndarray:
    left, right = (np.concatenate(x) for x in zip(*edges, strict=True)) if edges else (np.zeros(0, int), np.zeros(0, int))
    root = np.arange(n)
    while True:
        before = root.copy()
        least = np.minimum(root[left], root[right])
        np.minimum.at(root, left, least)
        np.minimum.at(root, right, least)
        np.minimum.at(root, before[left], least)
        np.minimum.at(root, before[right], least)
        root = root[root]
        if (root == before).all():
            return root


def _ngrams_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``(digest, doc_id, grams binary)`` of the documents whose id may be wanted."""
    shared = docs.sparkSession.sparkContext.broadcast(bloom.build(wanted, bloom.bit("doc_id")))
    hashed = docs.withColumn("_bit", bloom.bit("doc_id"))

    def run(batches):
        for batch in batches:
            batch = batch.filter(pa.array(bloom.passes(shared.value, batch.column("_bit").to_numpy())))
            for part in slices(batch, "_text"):
                sets = ngram_sets(_bytes(part))
                yield pa.record_batch({"digest": pa.array([_digest(s) for s in sets], pa.binary()), "doc_id": part.column("doc_id"), "grams": pa.array([s.tobytes() for s in sets], pa.binary())})

    return hashed.mapInArrow(run, "digest binary, doc_id long, grams binary")


def jaccard_join(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", block: int = BLOCK, keep: list[str] | None = None) -> DataFrame:
    """One row per document, with its columns ``keep`` (names that clash with the following are not allowed):

    doc_id; ``copy_of``, the least id with the same set of n-grams; ``n_copies``,
    documents with that set, itself included; ``n_text_links``, different sets
    linked to it; ``n_links``, documents linked to it, copies included;
    ``class_id``, the least id of all documents that links connect with it;
    ``class_no``, a number of the class within this result, null without n-grams
    (ids may be shared by documents of several classes, numbers are not).
    """
    keep = keep or []
    given = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("_text"), *keep)
    every = cut_lineage(_signatures(given, keep))
    with_words = every.where("digest is not null")
    sets = cut_lineage(with_words.groupBy("digest").agg(F.min("row").alias("set_id"), F.min("doc_id").alias("first_id"), F.count("*").alias("copies"), F.first("size").alias("size"), F.first("keys").alias("keys"), F.first("min_values").alias("min_values")))
    keyed = sets.select("set_id", F.explode("keys").alias("key"))
    shared_keys = cut_lineage(keyed.groupBy("key").agg(F.min("set_id").alias("least"), F.max("set_id").alias("most")).where("least < most").drop("most"))
    candidates = keyed.join(shared_keys, "key").select("set_id", "least").where("set_id != least")
    component = cut_lineage(components(candidates, "set_id", "least"))

    member = hashed_join(sets.drop("keys").withColumnRenamed("set_id", "node"), component, ["node"], how="inner").withColumnRenamed("node", "set_id")
    member = cut_lineage(member)
    blocks = member.groupBy("component").agg(F.ceil(F.sum("size") / F.lit(block)).alias("blocks"))
    placed = hashed_join(member, blocks, ["component"], how="inner").withColumn("block", F.pmod(F.xxhash64("set_id"), F.col("blocks")))
    grams = _ngrams_of(given.select("doc_id", "_text"), member.select(F.col("first_id").alias("doc_id")))
    same = [placed["digest"] == grams["digest"], placed["first_id"].eqNullSafe(grams["doc_id"])]
    loaded = placed.join(grams, same).select("set_id", "component", "copies", "blocks", "block", "min_values", "grams")
    other = loaded.withColumn("o", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    dealt = other.select("set_id", "component", "copies", "block", "min_values", "grams", F.least("block", "o").alias("i"), F.greatest("block", "o").alias("j"))
    compared = cut_lineage(dealt.groupBy("component", "i", "j").applyInArrow(_compare, "set_id long, links long, linked long, root long"))

    links = compared.groupBy("set_id").agg(F.sum("links").alias("links"), F.sum("linked").alias("linked"))
    classes = components(compared.where("set_id != root"), "set_id", "root").withColumnRenamed("node", "set_id")
    found = hashed_join(hashed_join(sets.select("digest", "set_id", "first_id", "copies"), links, ["set_id"]), classes, ["set_id"])
    found = cut_lineage(found.withColumn("class", F.coalesce("component", "set_id")).drop("component"))
    name = found.groupBy("class").agg(F.min("first_id").alias("class_id"))
    result = hashed_join(found, name, ["class"])
    rows = hashed_join(every.select("doc_id", "digest", *keep), cut_lineage(result), ["digest"], scatter=["doc_id"])
    zero = F.lit(0)
    return rows.select(
        "doc_id",
        F.coalesce("first_id", "doc_id").alias("copy_of"),
        F.coalesce("copies", F.lit(1)).cast("long").alias("n_copies"),
        F.coalesce("links", zero).cast("long").alias("n_text_links"),
        (F.coalesce("linked", zero) + F.coalesce("copies", F.lit(1)) - 1).cast("long").alias("n_links"),
        F.coalesce("class_id", "doc_id").alias("class_id"),
        F.col("class").alias("class_no"),
        *keep,
    )


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and classes of all ``documents``."""
    return jaccard_join(table(spark, sf_dir, "documents")).drop("class_no")
