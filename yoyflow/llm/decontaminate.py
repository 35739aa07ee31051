"""Operator 5: benchmark passages in documents, by Wu-Manber search over words.

Words are runs of a-z, 0-9 and non-ASCII characters after lower-casing A-Z.
The patterns are all windows of ``WINDOW`` consecutive words of the benchmark
items (an item with fewer words is one shorter pattern).  Patterns of one
length are searched together, as Wu and Manber do with bytes: a table over
hashed blocks of two words says how far the search may jump, because no
pattern has that block any nearer to its end; where the jump is 0, the bucket
of patterns with that suffix block is compared word by word, and the words
themselves are compared byte by byte.  Many stretches of text are searched at
once, each with its own position.

Scale: documents are searched in the scan, without a shuffle.  The patterns
are dealt into passes of at most ``PATTERNS`` windows, so that what a pass
broadcasts is bounded; results of several passes are joined by the digest of
the text they belong to (equal texts have equal results).

Null texts and texts without words have no hits; benchmark rows without id or
words are no items; rows of one item_id are searched apart and named once;
repeated documents stay repeated; empty tables on either side give no hits.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from yoyflow.llm.common import map_slices, name_long_words, table
from yoyflow.operators.joins import hashed_join
from yoyflow.session import cut_lineage

WINDOW = 10
PATTERNS = 1_000_000
_SHIFT_BITS = 20
_STRETCH = 128  # end positions that one cursor searches
_LOWER = np.zeros(256, np.uint8)
_LOWER[0x80:] = np.arange(0x80, 0x100)
for _a, _b in ((b"09", 0), (b"az", 0), (b"AZ", 32)):
    _LOWER[_a[0] : _a[1] + 1] = np.arange(_a[0], _a[1] + 1) + _b


@dataclass
class Words:
    """The words of many texts: normalised bytes, bounds, and the text each is in."""

    data: np.ndarray
    first: np.ndarray
    last: np.ndarray
    text: np.ndarray
    texts: int

    def word(self, i: int) -> bytes:
        return self.data[self.first[i] : self.last[i]].tobytes()


def split_words(raw: list[bytes]) -> Words:
    data = _LOWER[np.frombuffer(b"\0".join([*raw, b""]), np.uint8)]
    inside = np.concatenate([[False], data != 0, [False]])
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    first, last = edge[::2], edge[1::2]
    begins = np.cumsum([0, *(len(r) + 1 for r in raw)])
    return Words(data, first, last, np.searchsorted(begins, first, "right") - 1, len(raw))


def word_hashes(words: Words, factor: int) -> np.ndarray:
    """A hash of each word: a polynomial modulo 2**64, BLAKE2b for long words."""
    if not len(words.first):
        return np.zeros(0, np.uint64)
    size = words.last - words.first
    powers = np.full(int(size.max()), factor, np.uint64)
    powers[0] = 1
    powers = np.cumprod(powers, dtype=np.uint64)
    letters = words.data[words.data != 0].astype(np.uint64)
    begin = np.cumsum(size) - size
    place = np.arange(len(letters)) - np.repeat(begin, size)
    return name_long_words(np.add.reduceat(letters * powers[place], begin), words.data, words.first, words.last)


@dataclass
class Group:
    """The patterns of one length."""

    length: int
    block: int
    shift: np.ndarray
    patterns: np.ndarray  # word numbers, ordered by hashed suffix block
    bucket: np.ndarray  # first pattern of each hashed suffix block, and the end
    numbers: np.ndarray  # of the patterns


@dataclass
class Patterns:
    factor: int
    hashes: np.ndarray  # of the benchmark's words, sorted
    words: list[bytes]
    items: list[list[str]]  # by pattern number
    groups: list[Group] = field(default_factory=list)


def _block_hash(ids: np.ndarray, at: np.ndarray, block: int) -> np.ndarray:
    h = ids[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    if block == 2:
        h ^= (ids[at - 1].astype(np.uint64) + np.uint64(1)) * np.uint64(0xC2B2AE3D27D4EB4F)
    return (h >> np.uint64(64 - _SHIFT_BITS)).astype(np.int64)


def compile_patterns(windows: list[tuple[bytes, list[str]]]) -> Patterns:
    """Tables for windows given as words joined by a space, with the items they are in."""
    split = [w.split(b" ") for w, _ in windows]
    words = sorted({x for s in split for x in s})
    factor = 0x100000001B3
    while True:  # until no two of the benchmark's words share a hash
        hashes = word_hashes(split_words(words), factor)
        if len(np.unique(hashes)) == len(words):
            break
        factor += 2
    order = np.argsort(hashes)
    words, hashes = [words[i] for i in order.tolist()], hashes[order]
    number = {w: i + 1 for i, w in enumerate(words)}  # 0: not a word of the benchmark
    out = Patterns(factor, hashes, words, [items for _, items in windows])
    for length in sorted({len(s) for s in split}):
        numbers = np.array([i for i, s in enumerate(split) if len(s) == length])
        ids = np.array([[number[w] for w in split[i]] for i in numbers.tolist()])
        block = min(2, length)
        flat, n = ids.reshape(-1), len(ids)
        shift = np.full(1 << _SHIFT_BITS, length - block + 1, np.int16)
        for end in range(block - 1, length):
            np.minimum.at(shift, _block_hash(flat, np.arange(n) * length + end, block), length - 1 - end)
        suffix = _block_hash(flat, np.arange(n) * length + length - 1, block)
        order = np.argsort(suffix, kind="stable")
        bucket = np.searchsorted(suffix[order], np.arange((1 << _SHIFT_BITS) + 1)).astype(np.int32)
        out.groups.append(Group(length, block, shift, ids[order], bucket, numbers[order]))
    return out


def _positions(words: Words, ids: np.ndarray, group: Group) -> np.ndarray:
    """Places of last words where the shift table says a pattern may end."""
    count = np.bincount(words.text, minlength=words.texts)
    begin = np.cumsum(count) - count
    long = np.flatnonzero(count >= group.length)
    low, high = begin[long] + group.length - 1, begin[long] + count[long]
    stretches = -(-(high - low) // _STRETCH)
    at = np.repeat(low, stretches) + _STRETCH * (np.arange(stretches.sum()) - np.repeat(np.cumsum(stretches) - stretches, stretches))
    stop = np.minimum(at + _STRETCH, np.repeat(high, stretches))
    found = []
    while len(at):
        jump = group.shift[_block_hash(ids, at, group.block)]
        found.append(at[jump == 0])
        at = at + np.maximum(jump, 1)
        inside = at < stop
        at, stop = at[inside], stop[inside]
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def find(patterns: Patterns, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, length and pattern number of every occurrence."""
    none = np.zeros(0, np.int64)
    if not len(words.first) or not len(patterns.hashes):
        return none, none, none
    hashes = word_hashes(words, patterns.factor)
    near = np.minimum(np.searchsorted(patterns.hashes, hashes), len(patterns.hashes) - 1)
    ids = np.where(patterns.hashes[near] == hashes, near + 1, 0)
    found = [(none, none, none)]
    for g in patterns.groups:
        end = _positions(words, ids, g)
        suffix = _block_hash(ids, end, g.block)
        a, b = g.bucket[suffix], g.bucket[suffix + 1]
        for k in range(0, len(end), 4096):  # bounds the compared candidates
            n = (b - a)[k : k + 4096].astype(np.int64)
            first = np.repeat(end[k : k + 4096], n) - g.length + 1
            candidate = np.repeat(a[k : k + 4096], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            for j in range(g.length):
                same = ids[first + j] == g.patterns[candidate, j]
                first, candidate = first[same], candidate[same]
            found.append((first, np.full(len(first), g.length), g.numbers[candidate]))
    first, length, number = (np.concatenate(x) for x in zip(*found, strict=True))
    if len(first):
        covered = np.zeros(len(ids) + 1, np.int64)
        np.add.at(covered, first, 1)
        np.add.at(covered, first + length, -1)
        wrong = np.array([words.word(i) != patterns.words[ids[i] - 1] for i in np.flatnonzero(np.cumsum(covered)[:-1]).tolist()])
        if wrong.any():
            bad = np.zeros(len(ids) + 1, np.int64)
            bad[1:][np.flatnonzero(np.cumsum(covered)[:-1])[wrong]] = 1
            bad = np.cumsum(bad)
            right = bad[first + length] == bad[first]
            first, length, number = first[right], length[right], number[right]
    return first, length, number


def benchmark_windows(benchmark: DataFrame, item: str = "item_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """``(words binary, items array<string>)``, the distinct windows with their items."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        words = split_words(pc.fill_null(batch.column("text").cast(pa.binary()), b"").to_pylist())
        names = batch.column("item").to_pylist()
        count = np.bincount(words.text, minlength=words.texts)
        out: list[tuple[bytes, str]] = []
        for i, (begin, n) in enumerate(zip((np.cumsum(count) - count).tolist(), count.tolist(), strict=True)):
            own = [words.word(j) for j in range(begin, begin + n)]
            out += [(b" ".join(own[k : k + window]), names[i]) for k in range(max(1, n - window + 1)) if own]
        return pa.record_batch({"words": pa.array([w for w, _ in out], pa.binary()), "item": pa.array([x for _, x in out], pa.string())})

    items = benchmark.select(F.col(item).cast("string").alias("item"), F.col(text).alias("text")).where("item is not null")
    return map_slices(items, run, "words binary, item string").groupBy("words").agg(F.collect_set("item").alias("items"))


def search(docs: DataFrame, benchmark: DataFrame, text: str = "text", keep: list[str] | None = None, window: int = WINDOW, patterns: int = PATTERNS) -> DataFrame:
    """The columns ``keep`` of ``docs`` (default: all) with ``n_words``, ``n_hit`` and
    ``items`` (sorted item ids with an occurring window); clashing input columns
    are replaced.  A document word inside any occurrence is hit."""
    made = ("n_words", "n_hit", "items")
    listed = [c for c in (docs.columns if keep is None else keep) if c not in made]
    back = text if text in listed else None  # the text is sent once
    kept = docs.select(*(c for c in listed if c != text), F.col(text).alias("_text"))
    windows = cut_lineage(benchmark_windows(benchmark, window=window))
    passes = max(1, -(-windows.count() // patterns))
    if passes == 1:
        return _scan(kept, _collect(windows), "n_words long, n_hit long, items array<string>", _summary, back).select(*listed, *made)
    digest = F.sha2(F.coalesce("_text", F.lit("")).cast("binary"), 256)
    rows = _scan(kept.withColumn("_digest", digest), [], "n_words long, n_hit long, items array<string>", _summary, back).drop("n_hit", "items")
    found = None
    for k in range(passes):
        part = windows.where(F.pmod(F.xxhash64("words"), F.lit(passes)) == k)
        hits = cut_lineage(_scan(kept.select(digest.alias("_digest"), "_text"), _collect(part), "hit array<int>, items array<string>", _hits).where("size(hit) > 0"))
        hits = hits.groupBy("_digest").agg(F.first("hit").alias("hit"), F.first("items").alias("items"))
        found = hits if found is None else found.union(hits)
    by_text = found.groupBy("_digest").agg(F.size(F.array_distinct(F.flatten(F.collect_list("hit")))).cast("long").alias("n_hit"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    names = listed
    joined = hashed_join(rows, by_text, ["_digest"], how="left")
    return joined.select(*names, "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def _collect(windows: DataFrame) -> list[tuple[bytes, list[str]]]:
    return [(bytes(r.words), r["items"]) for r in windows.toLocalIterator()]


def _summary(words: Words, covered: np.ndarray, items: list[list[str]]) -> list[pa.Array]:
    count = np.bincount(words.text, minlength=words.texts)
    hit = np.bincount(words.text[covered], minlength=words.texts)
    return [pa.array(count, pa.int64()), pa.array(hit, pa.int64()), pa.array(items, pa.list_(pa.string()))]


def _hits(words: Words, covered: np.ndarray, items: list[list[str]]) -> list[pa.Array]:
    count = np.bincount(words.text, minlength=words.texts)
    place = (np.cumsum(count) - count)[words.text]
    which = [[] for _ in range(words.texts)]
    for i in np.flatnonzero(covered).tolist():
        which[words.text[i]].append(i - int(place[i]))
    return [pa.array(which, pa.list_(pa.int32())), pa.array(items, pa.list_(pa.string()))]


def _scan(docs: DataFrame, windows: list[tuple[bytes, list[str]]], made: str, give, back: str | None = None) -> DataFrame:
    """``docs`` with what ``give`` makes of the hits; the text comes back only under the name ``back``."""
    shared = docs.sparkSession.sparkContext.broadcast(compile_patterns(windows))
    names = [c for c in docs.columns if c != "_text"]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        patterns = shared.value
        words = split_words(pc.fill_null(batch.column("_text").cast(pa.binary()), b"").to_pylist())
        first, length, number = find(patterns, words)
        delta = np.zeros(len(words.first) + 1, np.int64)
        np.add.at(delta, first, 1)
        np.add.at(delta, first + length, -1)
        items: list[set] = [set() for _ in range(words.texts)]
        for i, p in zip(words.text[first].tolist(), number.tolist(), strict=True):
            items[i].update(patterns.items[p])
        columns = give(words, np.cumsum(delta)[:-1] > 0, [sorted(s) for s in items])
        own = [*(batch.column(c) for c in names), *([batch.column("_text")] if back else [])]
        return pa.RecordBatch.from_arrays([*own, *columns], names=[*names, *([back] if back else []), *(c.split()[0] for c in made.split(", "))])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != "_text"), *([f"`{back}` string"] if back else []), made])
    return map_slices(docs, run, schema, "_text")


def contaminated() -> Column:
    return F.col("n_hit") > 0


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits of the windows of ``benchmark`` in ``documents``."""
    found = search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    names = F.sha2(F.concat_ws(",", "items").cast("binary"), 256)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), names.alias("items_sha256"), contaminated().alias("contaminated"))
