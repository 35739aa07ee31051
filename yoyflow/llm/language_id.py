"""Operator 4: language of texts, and of the spans of mixed ones.

A word's script (by Unicode ranges) leaves the languages that write it; each
of these gets a score from the byte n-grams of the word (orders 1 to 4, hashed,
log probabilities, divided by the number of orders since they overlap).  A
Viterbi path over the words of a text, with a fixed price for each change of
language, labels spans.  A text's language is the one with most letters in its
spans (ties: the first in order of name), its score their share of all letters.

Learning: n-gram counts of labelled rows, summed by Spark.  At most about
``SAMPLE`` rows are used, chosen by a hash of their text when there are more.

Prediction runs in the scan; what is broadcast is one table of languages by
``BUCKETS``.  Scores are found once per distinct word and worker.  Most texts
have one language: if no stretch of words favours another language by more
than half the price, the constant path is the best one, which cumulative sums
show without a step per word; only the others are walked word by word, all of
a slice side by side.

Null texts and texts without a letter are ``und`` with score 0.  Without any
labelled row every text is ``und``.  Repeated rows stay; clashing columns of
the input are replaced.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from yoyflow.llm.common import Memo, crc_mod, map_slices, slices, table, texts, worker_state

BUCKETS = 1 << 16
SAMPLE = 100_000
ORDERS = (1, 2, 3, 4)
SMOOTHING = 0.5
SWITCH = 16.0
FALL = 1e9  # more than any text's sum of scores
LEAST_SHARE = 0.001  # of a language's letters: it writes the script
UNKNOWN = "und"
_WORD = re.compile(r"[^\W\d_]+")

# First code points of Unicode blocks, with the script's name.
SCRIPTS = (
    (0x0000, "Latin"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"), (0x0590, "Hebrew"), (0x0600, "Arabic"),
    (0x0900, "Devanagari"), (0x0980, "Bengali"), (0x0A00, "Gurmukhi"), (0x0A80, "Gujarati"), (0x0B00, "Oriya"), (0x0B80, "Tamil"),
    (0x0C00, "Telugu"), (0x0C80, "Kannada"), (0x0D00, "Malayalam"), (0x0D80, "Sinhala"), (0x0E00, "Thai"), (0x0E80, "Lao"),
    (0x0F00, "Tibetan"), (0x1000, "Myanmar"), (0x10A0, "Georgian"), (0x1100, "Hangul"), (0x1200, "Ethiopic"), (0x1E00, "Latin"),
    (0x1F00, "Greek"), (0x2000, "Latin"), (0x2E80, "Han"), (0x3040, "Kana"), (0x3100, "Han"), (0x3130, "Hangul"), (0x3200, "Han"),
    (0xA000, "Other"), (0xAC00, "Hangul"), (0xD800, "Other"), (0xF900, "Han"), (0xFB00, "Latin"), (0xFB1D, "Hebrew"), (0xFB50, "Arabic"),
    (0xFE00, "Other"), (0xFF00, "Latin"), (0xFF66, "Kana"), (0xFFA0, "Hangul"), (0x10000, "Other"), (0x20000, "Han"), (0x40000, "Other"),
)
_STARTS = np.array([s for s, _ in SCRIPTS])
_NAMES = sorted({n for _, n in SCRIPTS})
_SCRIPT = np.array([_NAMES.index(n) for _, n in SCRIPTS])


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def scripts_of(words: list[str]) -> np.ndarray:
    """The script of each word's first letter, as a place in ``_NAMES``."""
    first = np.array([ord(w[0]) for w in words], np.int64)
    return _SCRIPT[np.searchsorted(_STARTS, first, "right") - 1]


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every byte n-gram of `` word ``, and the word each is of."""
    data = np.frombuffer((" " + "  ".join(words) + " ").encode("utf-8", "replace"), np.uint8)
    edge = data == 32
    which = np.cumsum(edge & np.concatenate([[True], edge[:-1]])) - 1  # a word's first space follows a space
    h = np.zeros(len(data), np.uint64)
    buckets, owner = [], []
    for n in range(1, max(ORDERS) + 1):
        if n > len(data):
            break
        h = h[: len(data) - n + 1] * np.uint64(0x100000001B3) + data[n - 1 :] + np.uint64(1)
        if n not in ORDERS:
            continue
        ok = which[: len(h)] == which[n - 1 :]
        if n == 1:
            ok &= ~edge
        mixed = (h[ok] ^ np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
        buckets.append((mixed >> np.uint64(64 - 16)).astype(np.int64) % BUCKETS)
        owner.append(which[: len(h)][ok])
    return np.concatenate(buckets), np.concatenate(owner)


@dataclass
class LanguageModel:
    languages: list[str]
    scores: np.ndarray  # buckets x languages
    writes: np.ndarray  # scripts x languages

    def word_scores(self, words: list[str]) -> np.ndarray:
        """Words x languages; languages that do not write a word's script get a
        score no context makes up for (if none writes it, all stay)."""
        bucket, owner = features(words)
        out = np.stack([np.bincount(owner, self.scores[bucket, k], len(words)) for k in range(len(self.languages))], 1) / len(ORDERS)
        out -= out.max(1, keepdims=True)
        writes = self.writes[scripts_of(words)]
        out[~writes & writes.any(1, keepdims=True)] = -1e6
        return out - out.max(1, keepdims=True)


def fit(labelled: DataFrame, sample: int = SAMPLE) -> LanguageModel:
    """Learn from ``(text, lang)``; rows without a label or text teach nothing."""
    rows = labelled.select("text", "lang").where("text is not null and lang is not null")
    n = rows.count()
    if n > sample:
        share = int(sample / n * (1 << 30))
        rows = rows.where(F.xxhash64("text").bitwiseAND(F.lit((1 << 30) - 1)) < share)

    def run(batches):
        buckets: dict[str, np.ndarray] = {}
        scripts: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in slices(batch, "text"):
                by_lang: dict[str, dict[str, int]] = {}
                for text, lang in zip(texts(part), part.column("lang").to_pylist(), strict=True):
                    counted = by_lang.setdefault(lang, {})
                    for w in words_of(text):
                        counted[w] = counted.get(w, 0) + 1
                for lang, counted in by_lang.items():
                    if not counted:
                        continue
                    words, times = list(counted), np.array(list(counted.values()), float)
                    bucket, owner = features(words)
                    buckets[lang] = buckets.get(lang, 0) + np.bincount(bucket, times[owner], BUCKETS)
                    scripts[lang] = scripts.get(lang, 0) + np.bincount(scripts_of(words), times * np.array([len(w) for w in words]), len(_NAMES))
        for lang in buckets:
            both = np.concatenate([buckets[lang], scripts[lang]])
            used = np.flatnonzero(both)
            yield pa.record_batch({"lang": pa.array([lang] * len(used), pa.string()), "at": pa.array(used, pa.int32()), "n": pa.array(both[used], pa.float64())})

    counts = rows.mapInArrow(run, "lang string, at int, n double").groupBy("lang", "at").agg(F.sum("n").alias("n"))
    found: dict[str, np.ndarray] = {}
    for r in counts.toLocalIterator():  # languages x (buckets + scripts) at most
        found.setdefault(r.lang, np.zeros(BUCKETS + len(_NAMES)))[r["at"]] = r.n
    languages = sorted(found)
    if not languages:
        return LanguageModel([], np.zeros((BUCKETS, 0)), np.zeros((len(_NAMES), 0), bool))
    both = np.stack([found[x] for x in languages], 1)
    grams, scripts = both[:BUCKETS] + SMOOTHING, both[BUCKETS:]
    return LanguageModel(languages, np.log(grams / grams.sum(0)), scripts >= LEAST_SHARE * scripts.sum(0))


def label(scores: np.ndarray, first: np.ndarray, count: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """The language of each word on the best path of its text.

    ``scores`` are words x languages; text d has ``count[d]`` words from ``first[d]``.
    """
    words, languages = scores.shape
    out = np.zeros(words, np.int64)
    texts_ = np.flatnonzero(count)
    if not len(texts_):
        return out
    first, count = first[texts_], count[texts_]
    best = np.add.reduceat(scores, first, axis=0).argmax(1)
    own = np.repeat(np.arange(len(first)), count)
    out[:] = best[own]
    ahead = scores - scores[np.arange(words), best[own]][:, None]
    # (what is nearly impossible counts as far below the price, which keeps the sums exact)
    ahead = np.maximum(ahead, -1e3)
    # the largest gain of any stretch over the constant path is a sum minus the least sum
    # before it; each text's sums lie below those of the text before, so no minimum reaches back
    total = np.cumsum(ahead, 0)
    before = total - ahead
    level = before[first][own] + FALL * own[:, None]
    gain = total - level - np.minimum.accumulate(before - level, 0)
    worst = np.maximum.reduceat(gain.max(1), first)
    walk = np.flatnonzero(worst > switch / 2)
    if len(walk):
        walk = walk[np.argsort(-count[walk], kind="stable")]
        f, n = first[walk], count[walk]
        value = scores[f].copy()
        came = np.zeros((words, languages), np.int16)
        came[f] = np.arange(languages)
        for t in range(1, int(n[0])):
            k = int(np.searchsorted(-n, -t, "left"))  # texts with more than t words
            v = value[:k]
            top = v.argmax(1)
            jump = v[np.arange(k), top][:, None] - switch
            stay = v >= jump
            came[f[:k] + t] = np.where(stay, np.arange(languages), top[:, None])
            value[:k] = np.where(stay, v, jump) + scores[f[:k] + t]
        state = value.argmax(1)
        for t in range(int(n[0]) - 1, -1, -1):
            k = int(np.searchsorted(-n, -t, "left"))
            at = f[:k] + t
            out[at] = state[:k]
            state[:k] = came[at, state[:k]]
    return out


class _Scores:
    """A worker's word scores as rows that a text's words index."""

    def __init__(self, model: LanguageModel):
        self.model, self.rows, self.letters, self.size = model, np.zeros((1 << 16, len(model.languages))), np.zeros(1 << 16, np.int64), 0
        self.memo = Memo(self._add, 300_000, two=False)

    def _add(self, words: list[str]) -> list[int]:
        if not self.memo:
            self.size = 0
        a, b = self.size, self.size + len(words)
        while b > len(self.rows):
            self.rows, self.letters = np.concatenate([self.rows, np.zeros_like(self.rows)]), np.concatenate([self.letters, np.zeros_like(self.letters)])
        self.rows[a:b] = self.model.word_scores(words)
        self.letters[a:b] = [sum(map(str.isalpha, w)) for w in words]
        self.size = b
        return list(range(a, b))


def predict(docs: DataFrame, model: LanguageModel, text: str = "text", keep: list[str] | None = None, switch: float = SWITCH) -> DataFrame:
    """The columns ``keep`` of ``docs`` (default: all) with ``lang_pred``, ``score`` and
    ``spans``: array of (first_word, words, lang), words being runs of letters."""
    made = ("lang_pred", "score", "spans")
    sc = docs.sparkSession.sparkContext
    shared = sc.broadcast(model)
    name = f"language:{sc.applicationId}:{shared._jbroadcast.id()}"
    names = [c for c in (docs.columns if keep is None else keep) if c not in made]
    kept = docs.select(*(c for c in names if c != text), F.col(text).alias("_text"))  # the text is sent once
    spans_type = pa.list_(pa.struct([("first_word", pa.int32()), ("words", pa.int32()), ("lang", pa.string())]))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        scores, languages = worker_state(name, lambda: _Scores(shared.value)), shared.value.languages
        parts = [words_of(t) for t in texts(batch, "_text")] if languages else [[] for _ in range(batch.num_rows)]
        scores.memo.ensure(parts)
        count = np.array([len(p) for p in parts], np.int64)
        first = np.cumsum(count) - count
        ix = np.fromiter((scores.memo[w] for p in parts for w in p), np.int64, int(count.sum()))
        labels = label(scores.rows[ix], first, count, switch)
        own = np.repeat(np.arange(len(parts)), count)
        letters = np.bincount(own * max(1, len(languages)) + labels, scores.letters[ix], len(parts) * max(1, len(languages))).reshape(len(parts), -1)
        total = letters.sum(1)
        top = letters.argmax(1)
        turn = np.concatenate([[True], (labels[1:] != labels[:-1]) | (own[1:] != own[:-1])]) if len(ix) else np.zeros(0, bool)
        begin = np.flatnonzero(turn)
        size = np.diff(np.append(begin, len(ix)))
        spans: list[list[dict]] = [[] for _ in parts]
        for b, s, d, x in zip(begin.tolist(), size.tolist(), own[begin].tolist(), labels[begin].tolist(), strict=True):
            spans[d].append({"first_word": b - int(first[d]), "words": s, "lang": languages[x]})
        known = total > 0
        lang = [languages[t] if k else UNKNOWN for t, k in zip(top.tolist(), known.tolist(), strict=True)]
        score = np.where(known, letters.max(1) / np.maximum(total, 1), 0.0)
        columns = [pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(spans, spans_type)]
        return pa.RecordBatch.from_arrays([*(batch.column("_text" if c == text else c) for c in names), *columns], names=[*names, *made])

    schema = ", ".join([*(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in names), "lang_pred string, score double, spans array<struct<first_word: int, words: int, lang: string>>"])
    return map_slices(kept, run, schema, "_text", 1 << 20)


def training_rows() -> Column:
    return crc_mod("doc_id", 3) != 1


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents``, learning from labelled ones whose crc32(doc_id) mod 3 is not 1."""
    docs = table(spark, sf_dir, "documents")
    found = predict(docs, fit(docs.where(training_rows())), keep=["doc_id"])
    return found.select("doc_id", (~training_rows()).alias("held_out"), "lang_pred", "score", F.size("spans").alias("n_spans"))
