"""Helpers shared by the corpus operators."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# About what a generation of a worker's memo may hold, and an entry of it without its word.
MEMO_BYTES, ENTRY_BYTES = 64 << 20, 200
# Text bytes handed to one vectorised step; bounds the memory of a Python worker.
SLICE_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_mod(column: str, m: int) -> Column:
    """crc32 of the id written as text, modulo ``m`` (null ids count as '')."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % F.lit(m)


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows holding about ``limit`` bytes of ``column``."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    start = total = 0
    for i, n in enumerate(sizes.tolist()):
        if total and total + n > limit:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield batch.slice(start)


def pooled(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """The rows of batches, anew in batches holding about ``limit`` bytes of ``column``
    (a row counts for eight more, so that empty ones end a batch, too)."""
    held, total = [], 0
    for batch in batches:
        for part in slices(batch, column, limit):
            n = 8 * part.num_rows + (pc.sum(pc.binary_length(part.column(column))).as_py() or 0)
            if held and total + n > limit:
                yield pa.concat_batches(held)
                held, total = [], 0
            held.append(part)
            total += n
    if held:
        yield pa.concat_batches(held)


def map_slices(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str, column: str = "text", limit: int = SLICE_BYTES) -> DataFrame:
    """``df.mapInArrow`` with ``fn`` applied to slices of bounded text size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, column, limit):
                out = fn(part)
                if out is not None and out.num_rows:
                    yield out

    return df.mapInArrow(run, schema)


def texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The strings of a column, null as ''."""
    return pc.fill_null(batch.column(column), "").to_pylist()


LONG_WORD = 128


def name_long_words(h: np.ndarray, data: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """``h``, the words' polynomial hashes modulo 2**64, with BLAKE2b in place of those of
    long words: such a polynomial gives some pairs of long, regular words the same value."""
    for i in np.flatnonzero(last - first > LONG_WORD).tolist():
        h[i] = int.from_bytes(hashlib.blake2b(data[first[i] : last[i]].tobytes(), digest_size=8).digest(), "little")
    return h


_slot: dict[str, object] = {}


def worker_state(name: str, make: Callable[[], object]):
    """What an operator keeps in a Python worker between tasks, under its ``name``.

    Spark reuses workers, so a session that runs many operators would gather all
    their memos.  There is one place: another name's state is dropped, and its
    memory is handed back to the machine, before ``make`` builds the new one.
    """
    if name not in _slot:
        if _slot:
            _slot.clear()
            gc.collect()
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):  # glibc only
                ctypes.CDLL(None).malloc_trim(0)
        _slot[name] = make()
    return _slot[name]


class Memo(dict):
    """A worker's results by word, in two generations of at most ``limit`` words
    or about ``most`` bytes each.

    Most words of a corpus come back many times, so the costly per-word step
    runs about once per word and worker.  When the young generation is full it
    becomes the old one, and words still in use move over from there: the
    worker's memory stays flat.  With ``two=False`` a full generation is dropped;
    ``compute`` then sees an empty memo and may drop what it holds, too.
    """

    def __init__(self, compute: Callable[[list[str]], list], limit: int = 300_000, two: bool = True, most: int = MEMO_BYTES):
        super().__init__()
        self._compute, self._limit, self._two, self._most, self._old, self._bytes = compute, limit, two, most, {}, 0

    def ensure(self, parts: list[list]) -> None:
        """Afterwards all words of the given lists can be looked up."""
        words = set().union(*parts)
        missing = words.difference(self)
        if missing:
            self._add(missing, words)

    def lookup(self, parts: list[list]) -> list[list]:
        """The results for lists of words (no result may be None)."""
        out = [list(map(self.get, p)) for p in parts]
        holes = [[i for i, x in enumerate(found) if x is None] for found in out]
        missing = set().union(*([p[i] for i in at] for p, at in zip(parts, holes, strict=True)))
        if missing:
            new = self._add(missing, missing)
            for p, found, at in zip(parts, out, holes, strict=True):
                for i in at:
                    found[i] = new[p[i]]
        return out

    def _add(self, missing: set, needed: set) -> dict:
        """Enter the missing words; when that fills a generation, all needed ones enter the next."""
        size = sum(map(len, missing))
        if len(self) + len(missing) > self._limit or self._bytes + size + ENTRY_BYTES * (len(self) + len(missing)) > self._most:
            self._old = dict(self) if self._two else {}
            self.clear()
            missing, self._bytes = needed, 0
            size = sum(map(len, missing))
        self._bytes += 2 * size  # the word, and a result that grows with it
        old = self._old
        found = {w: old[w] for w in missing if w in old}
        new = [w for w in missing if w not in found]
        found.update(zip(new, self._compute(new), strict=True))
        self.update(found)
        return found
