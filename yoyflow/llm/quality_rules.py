"""Operator 11: quality rules and divergence from language references.

Every text is counted in one pass (words, symbols, repeated lines, words in
repeated three-word windows).  Its two histograms, of character classes and of
common words, are then compared with the references of all languages by the
Jensen-Shannon distance (square root of the divergence in bits, 0 to 1); the
nearest reference counts, so the language need not be known.

References: learned by language from all labelled texts that pass the plain
rules.  A class's share is its median over texts (in thousandths, so that the
median is exact and counted in parts), as a tenth of junk would shift a mean.
The common words are the ``COMMON`` most frequent of each
language (ties by word), all other words are one further bin; words here are
runs of a-z, 0-9 and non-ASCII characters after lower-casing A-Z.  Character
classes are ranges of code points (``CLASSES``), told by the first byte of a
character.

Guards: a histogram of few counts is far from any reference by chance, so
classes are judged from ``LEAST_CHARS`` characters on and common words from
``LEAST_WORDS`` words on; below, that verdict is "keep".  From there on the
greatest distance allowed falls with the square root of the length.  Without any reference
(no labelled text) only the plain rules count.

Scale: texts are counted in the scan, without a shuffle; learning shuffles
word counts added up by task.  What is broadcast are the references: at most
``LANGUAGES`` labels (those with the most words) times ``COMMON`` words and the
classes.  A very long text is held by one task together with its words, as its
repeats are counted over the whole text.

Null and empty texts have no words and fail the length rule, as do texts of
white space.  Repeated rows stay repeated.  Texts equally near to two
references get the same verdict from either.  Columns other than doc_id, text
and lang are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from yoyflow.llm.common import map_slices, table
from yoyflow.session import cut_lineage

LEAST_LENGTH = 50  # words
REPEAT_SHARE = 50  # percent of words in repeated three-word windows
COMMON, LANGUAGES = 40, 256
PARTS = 1000  # a text's class shares are counted in thousandths
LEAST_CHARS, LEAST_WORDS = 200, 50
# greatest distance of a long text, and what chance adds for n characters or words (divided by sqrt(n))
CLASS_DISTANCE, CLASS_CHANCE = 0.15, 2.2
WORD_DISTANCE, WORD_CHANCE = 0.335, 0.7
SYMBOLS = b"#*$%&|<>"
# first code point of each class; the class ends where the next begins
CLASSES = {
    "control": 0x00, "space": 0x20, "sign": 0x21, "digit": 0x30, "sign_2": 0x3A, "upper": 0x41, "sign_3": 0x5B, "lower": 0x61, "sign_4": 0x7B,
    "latin_mark": 0x80, "latin": 0xC0, "other_letter": 0x240, "symbol": 0x2000, "east_asian": 0x3000, "private": 0xE000, "supplement": 0x10000,
}
JOINED = {"sign_2": "sign", "sign_3": "sign", "sign_4": "sign"}  # parts of one class
SENTENCE = b"!\"'(),-.:;?"  # a class of their own among the signs
NAMES = [c for c in CLASSES if c not in JOINED] + ["sentence"]
_FLUSH = 200_000  # distinct words that a task holds before it passes their counts on
_SPACES = b"\t\n\x0b\x0c\r "


def _byte_classes() -> np.ndarray:
    """Class of each first byte of a character, len(NAMES) for the other bytes."""
    out = np.full(256, len(NAMES), np.uint8)
    begins = list(CLASSES.values())
    of = lambda point: NAMES.index(JOINED.get(n := list(CLASSES)[int(np.searchsorted(begins, point, "right")) - 1], n))
    for byte in range(256):
        if byte < 0x80:
            out[byte] = of(byte)
        elif 0xC2 <= byte < 0xE0:
            out[byte] = of((byte & 0x1F) << 6)
        elif 0xE0 <= byte < 0xF0:
            out[byte] = of(max((byte & 0x0F) << 12, 0x800))
        elif 0xF0 <= byte < 0xF5:
            out[byte] = of(0x10000)
    out[list(SENTENCE)] = NAMES.index("sentence")
    return out


_CLASS = _byte_classes()
_PLAIN = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or 48 <= b <= 57 or b >= 128 else 32 for b in range(256))


def class_counts(raw: list[bytes]) -> np.ndarray:
    """Characters of each class (columns) in each text (rows)."""
    sizes = np.fromiter(map(len, raw), np.int64, len(raw))
    kinds = _CLASS[np.frombuffer(b"".join(raw), np.uint8)].astype(np.int64)
    width = len(NAMES) + 1
    at = np.repeat(np.arange(len(raw)) * width, sizes) + kinds
    return np.bincount(at, minlength=len(raw) * width).reshape(len(raw), width)[:, : len(NAMES)]


def repeat_words(words: list[list[bytes]]) -> np.ndarray:
    """Words of each text in three-word windows that the text holds twice or more."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    out = np.zeros(len(words), np.int64)
    names: dict[bytes, int] = {}
    ids = np.fromiter((names.setdefault(w, len(names)) for ws in words for w in ws), np.int64, int(sizes.sum()))
    text = np.repeat(np.arange(len(words)), sizes)
    if len(ids) < 3:
        return out
    start = np.flatnonzero(text[2:] == text[:-2])
    key = text[start]
    for k in range(3):  # (text, words so far) by rank: exact at any number of words
        key = np.unique(key * np.int64(len(names)) + ids[start + k], return_inverse=True)[1] if len(start) else key
    twice = start[np.bincount(key)[key] > 1] if len(start) else start
    held = np.zeros(len(ids), bool)
    for k in range(3):
        held[twice + k] = True
    np.add.at(out, text[held], 1)
    return out


def plain_counts(batch: pa.RecordBatch) -> tuple[dict[str, np.ndarray], list[bytes], np.ndarray]:
    """The counts of the plain rules, the texts as bytes, and their class counts."""
    raw = [t.encode() if t else b"" for t in batch.column("text").to_pylist()]
    words = [r.split() for r in raw]  # bytes split at exactly these white spaces
    classes = class_counts(raw)
    n_words = np.fromiter(map(len, words), np.int64, len(raw))
    spaces = np.fromiter((len(r) - len(r.translate(None, _SPACES)) for r in raw), np.int64, len(raw))
    symbols = np.fromiter((len(r) - len(r.translate(None, SYMBOLS)) for r in raw), np.int64, len(raw))
    lines = [[x for x in r.split(b"\n") if x.strip(_SPACES)] if b"\n" in r else [] for r in raw]
    dup = np.fromiter((len(x) - len(set(x)) for x in lines), np.int64, len(raw))
    repeats = repeat_words(words)
    out = {"n_words": n_words, "word_chars": classes.sum(1) - spaces, "n_symbols": symbols, "n_dup_lines": dup, "n_repeat_words": repeats}
    out["base_failed"] = (n_words < LEAST_LENGTH) | (100 * repeats > REPEAT_SHARE * n_words)
    return out, raw, classes


@dataclass
class References:
    words: dict[bytes, int]  # the common words, numbered
    word_shares: np.ndarray  # languages x (common words and one further bin)
    class_shares: np.ndarray  # languages x classes, 0 where no text was long enough


def fit(docs: DataFrame) -> References:
    """References from the labelled texts that pass the plain rules."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()

        def out() -> pa.RecordBatch:
            keys = list(found)
            columns = [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32()), pa.array([k[2] for k in keys], pa.binary()), pa.array([k[3] for k in keys], pa.int32()), pa.array(list(found.values()), pa.int64())]
            return pa.RecordBatch.from_arrays(columns, ["lang", "kind", "word", "part", "n"])

        for batch in batches:
            counts, raw, classes = plain_counts(batch)
            langs = batch.column("lang").to_pylist()
            sizes = classes.sum(1)
            bins = (2 * PARTS * classes + sizes[:, None]) // np.maximum(2 * sizes[:, None], 1)
            for i in np.flatnonzero(~counts["base_failed"]).tolist():
                lang = langs[i]
                for word, n in Counter(raw[i].translate(_PLAIN).split()).items():
                    found[lang, -1, word, 0] += n
                if sizes[i] >= LEAST_CHARS:
                    for kind, part in enumerate(bins[i].tolist()):
                        found[lang, kind, b"", part] += 1
                if len(found) > _FLUSH:
                    yield out()
                    found.clear()
        if found:
            yield out()

    def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from yoyflow.llm.common import slices

        yield from count(part for batch in batches for part in slices(batch, "text"))

    counted = docs.where("lang is not null and text is not null").select("lang", "text").mapInArrow(sliced, "lang string, kind int, word binary, part int, n long")
    counted = cut_lineage(counted.groupBy("lang", "kind", "word", "part").agg(F.sum("n").alias("n")))
    words = counted.where("kind = -1")
    total = words.groupBy("lang").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "lang").limit(LANGUAGES).collect()  # bounded
    langs = {r["lang"]: i for i, r in enumerate(total)}
    by_count = Window.partitionBy("lang").orderBy(F.desc("n"), "word")  # limited in every task before the shuffle
    top = words.withColumn("_k", F.row_number().over(by_count)).where(F.col("_k") <= COMMON).select("lang", "word")
    common = sorted({bytes(r["word"]) for r in top.where(F.col("lang").isin(list(langs))).collect()}) if langs else []  # at most LANGUAGES x COMMON
    number = {w: i for i, w in enumerate(common)}
    word_counts, medians = np.zeros((len(langs), len(common) + 1)), np.zeros((len(langs), len(NAMES)))
    if langs:
        chosen = F.broadcast(top.select("word").distinct())  # at most languages x COMMON
        for r in words.join(chosen, "word").collect():
            if r["lang"] in langs and bytes(r["word"]) in number:
                word_counts[langs[r["lang"]], number[bytes(r["word"])]] = r["n"]
        for r in total:
            word_counts[langs[r["lang"]], -1] = r["n"] - word_counts[langs[r["lang"]], :-1].sum()
        upto, of = Window.partitionBy("lang", "kind").orderBy("part"), Window.partitionBy("lang", "kind")
        parts = counted.where("kind >= 0").withColumn("_upto", F.sum("n").over(upto)).withColumn("_all", F.sum("n").over(of))
        for r in parts.where("2 * _upto >= _all").groupBy("lang", "kind").agg(F.min("part").alias("part")).collect():  # languages x classes
            if r["lang"] in langs:
                medians[langs[r["lang"]], r["kind"]] = r["part"]
    shares = [x / np.maximum(x.sum(1, keepdims=True), 1) for x in (word_counts, medians)]
    return References(number, *shares)


def distances(row: np.ndarray, column: np.ndarray, share: np.ndarray, rows: int, references: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance of each histogram (given by its bins above 0) to its nearest reference."""
    best = np.full(rows, np.inf)
    for q in references[references.sum(1) > 0]:
        other = q[column]
        both = share + other
        with np.errstate(divide="ignore", invalid="ignore"):
            theirs = np.where(other > 0, other * np.log2(2 * other / both), 0.0)
        terms = share * np.log2(2 * share / both) + theirs - other
        best = np.minimum(best, np.bincount(row, terms, rows) + q.sum())  # bins that the text lacks give all of q's share
    return np.sqrt(np.clip(np.where(np.isfinite(best), best, np.nan) / 2, 0, 1))


def _sparse(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    row, column = np.nonzero(counts)
    return row, column, counts[row, column] / counts.sum(1)[row]


def _word_bins(raw: list[bytes], refs: References) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sparse histograms of common words, and the words of each text."""
    width = len(refs.words) + 1
    keys, sizes = [], np.zeros(len(raw), np.int64)
    for i, r in enumerate(raw):
        words = r.translate(_PLAIN).split()
        sizes[i] = len(words)
        at = Counter(refs.words.get(w, width - 1) for w in words)
        keys += [(i, k, n) for k, n in at.items()]
    row, column, n = (np.array(x, np.int64) for x in zip(*keys, strict=True)) if keys else (np.zeros(0, np.int64),) * 3
    return row, column, n / np.maximum(sizes[row], 1), sizes


def judge(docs: DataFrame, refs: References) -> DataFrame:
    """doc_id, the plain counts, base_failed, kept, class_distance, word_distance (null where a guard holds or the plain rules fail)."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts, raw, classes = plain_counts(batch)
        n = len(raw)
        class_distance, word_distance, common = np.full(n, np.nan), np.full(n, np.nan), np.ones(n, np.int64)
        chars = np.maximum(classes.sum(1), 1)
        if len(refs.class_shares):
            at = np.flatnonzero(~counts["base_failed"] & (classes.sum(1) >= LEAST_CHARS))
            if len(at):
                class_distance[at] = distances(*_sparse(classes[at]), len(at), refs.class_shares)
            at = np.flatnonzero(~counts["base_failed"])
            row, column, share, sizes = _word_bins([raw[i] for i in at], refs)
            d = distances(row, column, share, len(at), refs.word_shares)
            word_distance[at], common[at] = np.where(sizes >= LEAST_WORDS, d, np.nan), np.maximum(sizes, 1)
        far = (class_distance > CLASS_DISTANCE + CLASS_CHANCE / np.sqrt(chars)) | (word_distance > WORD_DISTANCE + WORD_CHANCE / np.sqrt(common))
        kept = ~counts["base_failed"] & ~far
        columns = [batch.column("doc_id"), *(pa.array(x) for x in counts.values()), pa.array(kept), *(pa.array(np.round(x, 6), from_pandas=True) for x in (class_distance, word_distance))]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", *counts, "kept", "class_distance", "word_distance"])

    schema = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, class_distance double, word_distance double"
    return map_slices(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, schema)


def clean() -> Column:
    return F.col("kept")


def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return judge(docs, fit(docs))
