"""Operator 9: long repeats across documents, by recompression.

A word is removed if it lies in a window of ``WINDOW`` consecutive words that
also occurs in a document with a smaller id.

Parsing.  Starting from words, rounds of recompression replace runs of one
symbol and then pairs of neighbours (first symbol of the round's left half of
the alphabet, second of its right half, halves by hash) by new symbols.  A
symbol's name is a fingerprint of what it stands for, so all tasks name equal
runs and pairs alike, and equal stretches of text get equal symbols in their
interior.  Symbols longer than the round's limit stay as they are, which makes
the parsing local: whether a symbol ends at a place depends on at most
``REACH`` words on either side of it.  Among the ends of high-level symbols
the least by hash within ``SPREAD`` places are anchors; an anchor's key is the
fingerprint of the ``REACH`` words on either side.

Spark rounds.  (1) Documents with equal words are one class; only the one with
the least id goes on, the others are repeats as a whole.  (2) Keys of anchors
are matched over all documents.  Equal windows hold equal anchors, so a window
can only be a repeat if every anchor that lies in it with all its words is
shared (a window without one, inside a long run, stays a candidate).
(3) Candidate windows are matched by a 128-bit fingerprint of all their words,
which verifies them, and the least document of each is found.

Scale: the first shuffle carries each distinct document's keys (one for about
seven words), the second and third a few longs for each key and each candidate
window.  Counts and minima are combined in the map task; the joins back start
from shuffles on both sides, so that adaptive execution can split a passage
that many documents share.  Text is shuffled only for documents that hold
repeats (thinned out by a bounded Bloom filter).  Stages are stored.

A null text has no words.  Rows of equal id are one document's versions:
neither is smaller.  Null ids are no document's smaller ones and lose nothing.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from yoyflow.llm import bloom
from yoyflow.llm.common import name_long_words, slices, table
from yoyflow.operators.joins import hashed_join
from yoyflow.session import cut_lineage

WINDOW = 50
RUN_LIMIT = 1
PAIR_LIMITS = (1, 2)  # longest symbol that a round of pairs still joins
NAME_LIMIT = 4  # longest symbol whose name counts for an anchor
SPREAD = 12
REACH = RUN_LIMIT + sum(PAIR_LIMITS) + NAME_LIMIT + SPREAD - 1  # 19
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[9, 10, 11, 12, 13, 32]] = True
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_LAST = np.uint64(0xFFFFFFFFFFFFFFFF)
_SALTS = np.random.default_rng(9).integers(1, 1 << 63, len(PAIR_LIMITS), dtype=np.uint64)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def word_names(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit fingerprint of every word of all texts, and the number of words of each."""
    data = np.frombuffer(b"\n".join([*raw, b""]), np.uint8)
    inside = np.concatenate([[False], ~_SEPARATOR[data], [False]])
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    first, last = edge[::2], edge[1::2]
    begins = np.cumsum([0, *(len(r) + 1 for r in raw)])
    count = np.diff(np.searchsorted(first, begins))
    if not len(first):
        return np.zeros(0, np.uint64), count
    size = last - first
    powers = np.full(int(size.max()), 0x100000001B3, np.uint64)
    powers[0] = 1
    powers = np.cumprod(powers, dtype=np.uint64)
    begin = np.cumsum(size) - size
    place = np.arange(int(size.sum())) - np.repeat(begin, size)
    letters = data[inside[1:-1]].astype(np.uint64) + np.uint64(1)
    return _mix(name_long_words(np.add.reduceat(letters * powers[place], begin), data, first, last)), count


def stretch_names(h: np.ndarray, length: int, factor: np.uint64) -> np.ndarray:
    """A fingerprint of each ``length`` consecutive names (modulo 2**64, by a rolling sum)."""
    if len(h) < length:
        return np.zeros(0, np.uint64)
    inverse = np.uint64(pow(int(factor), -1, 1 << 64))
    up = np.concatenate([[np.uint64(1)], np.full(len(h) - 1, factor)]).cumprod(dtype=np.uint64)
    down = np.concatenate([[np.uint64(1)], np.full(len(h) - 1, inverse)]).cumprod(dtype=np.uint64)
    total = np.concatenate([[np.uint64(0)], np.cumsum(h * up, dtype=np.uint64)])
    return _mix((total[length:] - total[: len(total) - length]) * down[: len(h) - length + 1])


def parse(h: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Recompression: name, first word and length of each high-level symbol.

    ``own`` numbers the text of each word; no symbol reaches across texts.
    """
    name, start, size = h, np.arange(len(h)), np.ones(len(h), np.int64)
    # runs of one symbol
    same = np.concatenate([[False], (name[1:] == name[:-1]) & (own[1:] == own[:-1]) & (size[1:] <= RUN_LIMIT) & (size[:-1] <= RUN_LIMIT)])
    head = np.flatnonzero(~same)
    times = np.diff(np.append(head, len(name))).astype(np.uint64)
    name = np.where(times > 1, _mix(name[head] * _A + times), name[head])
    start, size = start[head], size[head] * times.astype(np.int64)
    # pairs
    for level, limit in enumerate(PAIR_LIMITS):
        right = (_mix(name ^ _SALTS[level]) & np.uint64(1)).astype(bool)
        small = size <= limit
        text = own[start]
        joined = np.flatnonzero(small[:-1] & small[1:] & ~right[:-1] & right[1:] & (text[:-1] == text[1:]))
        name, size = name.copy(), size.copy()
        name[joined] = _mix(name[joined] * _A + _mix(name[joined + 1] + np.uint64(level + 1)))
        size[joined] += size[joined + 1]
        keep = np.ones(len(name), bool)
        keep[joined + 1] = False
        name, start, size = name[keep], start[keep], size[keep]
    return name, start, size


def anchors(h: np.ndarray, own: np.ndarray, first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places (in ``h``) and keys of the anchors that have ``REACH`` words on either side."""
    if len(h) < 2 * REACH:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    name, start, size = parse(h, own)
    shown = np.where(size <= NAME_LIMIT, name, np.uint64(0))
    value = np.full(len(h), _LAST)
    value[start[1:]] = _mix(shown[:-1] * _A + shown[1:]) >> np.uint64(1)
    value[first[count > 0]] = _LAST
    # the leftmost least of some SPREAD places: distance to the next as small before and smaller after
    before, after = np.full(len(h), SPREAD), np.full(len(h), SPREAD)
    for k in range(SPREAD - 1, 0, -1):
        before[k:][value[:-k] <= value[k:]] = k
        after[:-k][value[k:] < value[:-k]] = k
    place = np.flatnonzero((before + after > SPREAD) & (value != _LAST))
    text = own[place]
    place = place[(place - first[text] >= REACH) & (place + REACH <= first[text] + count[text])]
    return place, stretch_names(h, 2 * REACH, _A)[place - REACH]


def _bytes(batch: pa.RecordBatch) -> list[bytes]:
    return pc.fill_null(batch.column("_text").cast(pa.binary()), b"").to_pylist()


def _digests(h: np.ndarray, first: np.ndarray, count: np.ndarray) -> list[bytes]:
    return [hashlib.blake2b(h[a : a + n].tobytes(), digest_size=16).digest() for a, n in zip(first.tolist(), count.tolist(), strict=True)]


def _per_window(flags: np.ndarray, windows: int) -> np.ndarray:
    """For each window the number of flagged anchors that lie in it with all their words."""
    total = np.concatenate([[0], np.cumsum(flags)])
    at = np.arange(windows)
    return total[at + WINDOW - REACH + 1] - total[at + REACH]


def _keys_of(docs: DataFrame) -> DataFrame:
    """``(digest, doc_id, bare, places, keys)`` of each document that has a window;
    ``bare``: some window holds no anchor."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, "_text"):
                h, count = word_names(_bytes(part))
                first = np.cumsum(count) - count
                place, key = anchors(h, np.repeat(np.arange(len(count)), count), first, count)
                cut = np.searchsorted(place, np.append(first, len(h)))
                rows = []
                for i in np.flatnonzero(count >= WINDOW).tolist():
                    own = place[cut[i] : cut[i + 1]] - first[i]
                    flags = np.zeros(count[i] + 1, bool)
                    flags[own] = True
                    bare = bool((_per_window(flags, count[i] - WINDOW + 1) == 0).any())
                    rows.append((i, bare, own.astype(np.int32), key[cut[i] : cut[i + 1]].view(np.int64)))
                which, bare, places, keys = zip(*rows, strict=True) if rows else ((),) * 4
                digest = _digests(h, first[list(which)], count[list(which)])
                yield pa.record_batch(
                    {
                        "digest": pa.array(digest, pa.binary()),
                        "doc_id": part.column("doc_id").take(pa.array(which, pa.int32())),
                        "bare": pa.array(bare, pa.bool_()),
                        "places": pa.array(places, pa.list_(pa.int32())),
                        "keys": pa.array(keys, pa.list_(pa.int64())),
                    }
                )

    return docs.mapInArrow(run, "digest binary, doc_id long, bare boolean, places array<int>, keys array<long>")


def _texts_of(docs: DataFrame, digests: DataFrame) -> DataFrame:
    """``(doc_id, digest, n_words, sha, text)`` of every document; the text only where
    its digest may be among ``digests``, ``sha`` that of all words joined by a space."""
    shared = docs.sparkSession.sparkContext.broadcast(bloom.build(digests, bloom.digest_bit("digest")))

    def run(batches):
        for batch in batches:
            for part in slices(batch, "_text"):
                raw = _bytes(part)
                h, count = word_names(raw)
                digest = _digests(h, np.cumsum(count) - count, count)
                may = bloom.passes(shared.value, bloom.digest_bits(digest)).tolist()
                sha = [hashlib.sha256(b" ".join(r.split())).hexdigest() for r in raw]
                yield pa.record_batch(
                    {
                        "doc_id": part.column("doc_id"),
                        "digest": pa.array(digest, pa.binary()),
                        "n_words": pa.array(count, pa.int64()),
                        "sha": pa.array(sha, pa.string()),
                        "text": pa.array([r if m else None for r, m in zip(raw, may, strict=True)], pa.binary()),
                    }
                )

    return docs.mapInArrow(run, "doc_id long, digest binary, n_words long, sha string, text binary")


def _candidates(texts: DataFrame) -> DataFrame:
    """``(a, b, doc_id, pid, at)`` of every candidate window of ``(text, doc_id, pid, shared)``:
    two fingerprints and the place; of equal windows in one document, one."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                h, count = word_names(part.column("text").to_pylist())
                first = np.cumsum(count) - count
                place, _ = anchors(h, np.repeat(np.arange(len(count)), count), first, count)
                cut = np.searchsorted(place, np.append(first, len(h)))
                a, b = stretch_names(h, WINDOW, _A), stretch_names(h, WINDOW, _B)
                found = []
                for i, (shared, n) in enumerate(zip(part.column("shared").to_pylist(), count.tolist(), strict=True)):
                    every, hit = np.zeros(n + 1, np.int64), np.zeros(n + 1, np.int64)
                    every[place[cut[i] : cut[i + 1]] - first[i]] = 1
                    hit[shared or []] = 1
                    at = np.flatnonzero(_per_window(every, n - WINDOW + 1) == _per_window(hit, n - WINDOW + 1))
                    _, once = np.unique(a[first[i] + at], return_index=True)
                    at = at[once]
                    found.append((a[first[i] + at], b[first[i] + at], np.full(len(at), i), at))
                fa, fb, row, at = (np.concatenate(x) for x in zip(*found, strict=True))
                yield pa.record_batch({"a": fa.view(np.int64), "b": fb.view(np.int64), "doc_id": part.column("doc_id").take(pa.array(row)), "pid": part.column("pid").take(pa.array(row)), "at": at.astype(np.int32)})

    return texts.mapInArrow(run, "a long, b long, doc_id long, pid long, at int")


def _kept(text: bytes, at: list[int]) -> tuple[int, bytes]:
    """Words lost to the windows at the given places and all equal ones, and the text that stays."""
    words = text.split()
    a = stretch_names(word_names([text])[0], WINDOW, _A)
    starts = np.flatnonzero(np.isin(a, a[at]))  # of equal windows of a document one was looked up
    gone = np.zeros(len(words) + 1, np.int64)
    np.add.at(gone, starts, 1)
    np.add.at(gone, starts + WINDOW, -1)
    gone = np.cumsum(gone)[:-1] > 0
    return int(gone.sum()), b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g])


def _clean(rows: DataFrame) -> DataFrame:
    """The result for ``(doc_id, n_words, sha, text, first_id, at)``."""

    def run(batches):
        for batch in batches:
            n, sha = batch.column("n_words").to_pylist(), batch.column("sha").to_pylist()
            removed, kept = [0] * len(n), [None] * len(n)
            for i, (doc_id, first_id) in enumerate(zip(batch.column("doc_id").to_pylist(), batch.column("first_id").to_pylist(), strict=True)):
                if doc_id is None or first_id is None or n[i] < WINDOW:
                    continue
                if doc_id > first_id:
                    removed[i], kept[i] = n[i], b""
                elif at := batch.column("at")[i].as_py():
                    removed[i], kept[i] = _kept(batch.column("text")[i].as_py(), at)
                if kept[i] is not None:
                    sha[i] = hashlib.sha256(kept[i]).hexdigest()
            text = [None if k is None else k.decode("utf-8", "replace") for k in kept]
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "n_words": batch.column("n_words"), "n_removed": pa.array(removed, pa.int64()), "kept_sha256": pa.array(sha, pa.string()), "kept": pa.array(text, pa.string())})

    return rows.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string")


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256 (of the kept words
    joined by one space) and, for a document that lost a word, those words as ``kept``."""
    given = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("_text"))
    # (1) classes of equal documents
    classes = _keys_of(given).groupBy("digest").agg(F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"), *(F.first(c).alias(c) for c in ("bare", "places", "keys")))
    classes = cut_lineage(classes.withColumn("pid", F.monotonically_increasing_id()))
    # (2) anchors that different documents share
    keyed = classes.select("pid", F.explode(F.arrays_zip("places", "keys")).alias("x")).select("pid", F.col("x.places").alias("place"), F.col("x.keys").alias("key"))
    shared = cut_lineage(keyed.groupBy("key").agg(F.min("pid").alias("least"), F.max("pid").alias("most")).where("least < most").select("key"))
    hits = keyed.join(shared, "key").groupBy("pid").agg(F.collect_list("place").alias("shared"))
    marked = hashed_join(classes.select("pid", "digest", "first_id", "bare"), hits, ["pid"])
    suspects = cut_lineage(marked.where("(shared is not null or bare) and first_id is not null").select("pid", "digest", "first_id", "shared"))
    # (3) their candidate windows
    stored = cut_lineage(_texts_of(given, suspects))
    texts = hashed_join(stored.where("text is not null"), suspects, ["digest", ("doc_id", "first_id")], how="inner")
    windows = cut_lineage(_candidates(texts.select("pid", "doc_id", "text", "shared")))
    known = cut_lineage(windows.groupBy("a", "b").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).where("least < most").drop("most"))
    repeated = windows.join(known, ["a", "b"]).where("least < doc_id").groupBy("pid").agg(F.collect_list("at").alias("at"))
    found = hashed_join(classes.select("pid", "digest", "first_id", "last_id"), repeated, ["pid"])
    found = cut_lineage(found.where("at is not null or first_id < last_id").select("digest", "first_id", "at"))
    return _clean(hashed_join(stored, found, ["digest"]))


def op9_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeats of 50 words removed from ``documents``."""
    return remove_repeats(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")
