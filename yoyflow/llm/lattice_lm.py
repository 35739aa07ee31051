"""Operator 8: document likelihood over a subword lattice.

A text is spelled word by word from the pieces of an existing unigram
vocabulary, and then ends.  A word's probability is the sum over all its
segmentations, by a log-space forward recursion over its lattice of pieces; a
text's score is the sum of these logs and that of the end, which is one more
symbol of the vocabulary.  No word goes round the lattice, however often the
training documents hold it.

The vocabulary's scores weight the segmentations.  Starting from them, the
expected piece counts over all training words (forward-backward, a stated
number of rounds) re-weight the pieces, with ``PRIOR`` pseudo-counts spread by
the existing scores; the end counts once a training document, and has the prior
of the least likely byte.  ``base_score`` is the plain score by whole words.

Spark's part: words are counted over all documents (combined in the map task,
one shuffle by word) and stored; expected counts come from one pass over the
distinct words.  A word is scored where it stands, by the broadcast pieces;
for the plain score documents meet the counts of their words in two ways.  The
most frequent words, at most ``HOT_WORDS``, are broadcast; every other word
occurs at most (all tokens / ``HOT_WORDS``) times, and is joined by a shuffle.
Frequency is taken over all documents, so a word that only unseen documents
repeat is also among the hot ones, and no join key is hot.

A null text is empty (just the end); an empty table gives no rows; without
training documents the vocabulary's own scores and the end's prior hold.
Repeated rows stay apart, and equal texts get equal scores.  A very long text is
scored whole, word by word; a word of any length has a lattice of its own, whose
memory grows with the word.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from yoyflow.llm.common import Memo, crc_mod, slices, table, worker_state
from yoyflow.llm.pieces import PieceModel, expected_counts, marginals
from yoyflow.session import cut_lineage

HOT_WORDS = 250_000
ROUNDS = 2
PRIOR = 1_000.0
LONGEST_KEY = 64
END = b" end"  # no word holds a space
LOG10 = math.log(10)
_FLUSH = 300_000


def words_of(text: bytes) -> list[bytes]:
    """Lower-cased (A-Z only) runs of anything but ASCII white space."""
    return text.lower().split()


def key_of(word: bytes) -> bytes:
    """The word itself, or a digest that no word can equal."""
    return word if len(word) <= LONGEST_KEY else b" " + hashlib.sha256(word).digest()


def _byte_texts(batch: pa.RecordBatch) -> list[bytes]:
    return pc.fill_null(batch.column("text").cast(pa.binary()), b"").to_pylist()


def word_counts(docs: DataFrame) -> DataFrame:
    """``(key, word, n_train, n_all)`` of every distinct token of ``(text, train)``."""

    def run(batches):
        kept: dict[bool, Counter] = {True: Counter(), False: Counter()}

        def flush() -> pa.RecordBatch:
            words = [w for c in kept.values() for w in c]
            every = np.array([n for c in kept.values() for n in c.values()], np.int64)
            train = every.copy()
            train[len(kept[True]) :] = 0
            for c in kept.values():
                c.clear()
            return pa.record_batch({"word": pa.array(words, pa.binary()), "n_train": pa.array(train), "n_all": pa.array(every)})

        for batch in batches:
            for part in slices(batch, "text"):
                for text, train in zip(_byte_texts(part), part.column("train").to_pylist(), strict=True):
                    kept[train].update(words_of(text))
                    kept[train][END] += 1
                if sum(map(len, kept.values())) > _FLUSH:
                    yield flush()
        yield flush()

    parts = docs.select("text", "train").mapInArrow(run, "word binary, n_train long, n_all long")
    sums = parts.groupBy("word").agg(F.sum("n_train").alias("n_train"), F.sum("n_all").alias("n_all"))
    # as ``key_of``; the end is short, too
    key = F.when(F.length("word") <= LONGEST_KEY, F.col("word")).otherwise(F.concat(F.lit(b" "), F.unhex(F.sha2("word", 256))))
    return sums.select(key.alias("key"), "word", "n_train", "n_all")


def _text_of(word: bytes) -> str:
    return word.decode("utf-8", "replace")


def fit_pieces(counts: DataFrame, model: PieceModel, rounds: int = ROUNDS, ends: int = 0) -> tuple[PieceModel, float]:
    """Re-weight the pieces by their expected counts over the distinct training words,
    and the end by ``ends``: the model and the natural log of the end's probability."""
    spark = counts.sparkSession
    prior = np.exp(model.scores)
    end = float(prior[model.byte_ids].min())
    end_weight, all_weights = end, float(prior.sum()) + end
    for _ in range(rounds):
        now = spark.sparkContext.broadcast(model)

        def run(batches, now=now):
            total = np.zeros(len(now.value.scores))
            for batch in batches:
                for part in slices(batch, "word"):
                    words = [_text_of(w) for w in part.column("word").to_pylist()]
                    total += expected_counts(now.value, words, part.column("n_train").to_numpy())
            used = np.flatnonzero(total)
            yield pa.record_batch({"id": pa.array(used, pa.int32()), "n": pa.array(total[used], pa.float64())})

        training = counts.where((F.col("n_train") > 0) & (F.col("key") != F.lit(END))).select("word", "n_train")
        summed = training.mapInArrow(run, "id int, n double").groupBy("id").agg(F.sum("n").alias("n"))
        found = np.zeros(len(model.scores))
        for row in summed.toLocalIterator():  # one row per piece of the vocabulary at most
            found[row.id] = row.n
        weight, end_weight = found + PRIOR * prior, ends + PRIOR * end
        all_weights = float(weight.sum()) + end_weight
        with np.errstate(divide="ignore"):
            model = PieceModel(model.trie, model.ids, model.byte_ids, model.text, np.log(weight / all_weights), None, model.key + "+")
        now.destroy()
    return model, math.log(end_weight / all_weights)


def hot_words(counts: DataFrame, most: int = HOT_WORDS) -> dict[bytes, int]:
    """The words whose counts reach a bound that at most ``most`` words reach, with n_train."""
    step = F.floor(F.log2("n_all") * 4).cast("int")  # a few hundred values at any size
    sizes = sorted(((r.step, r.n) for r in counts.groupBy(step.alias("step")).agg(F.count("*").alias("n")).collect()), reverse=True)
    bound, total = None, 0
    for at, n in sizes:
        if total + n > most:
            break
        bound, total = at, total + n
    if bound is None:
        return {}
    return {bytes(r.key): r.n_train for r in counts.where(step >= bound).select("key", "n_train").toLocalIterator()}


class _Scorer:
    """A worker's scores by word, as columns that a document's words index.

    The broadcast words have columns of their own, first, which stay once they are
    filled; those of the other words are dropped together when the memo is full."""

    def __init__(self, model: PieceModel, hot: dict[bytes, int], n: int, v: int):
        self.model, self.hot, self.n, self.v = model, hot, n, v
        self.memo = Memo(self._add, 250_000, two=False)
        self.kept: dict[bytes, int] = {}
        self.size = len(hot)
        self.score, self.base = np.zeros(1 << 16), np.zeros(1 << 16)
        self.known, self.rare = (np.zeros(1 << 16, bool) for _ in range(2))

    def _add(self, words: list[bytes]) -> list[int]:
        if not self.memo:
            self.size = len(self.hot)
        new = [w for w in words if w not in self.kept]
        c = np.array([self.hot.get(key_of(w), -1) for w in new], np.int64)
        rare = c < 0
        n_rare = int(rare.sum())
        at = np.where(rare, self.size - 1 + np.cumsum(rare), len(self.kept) - 1 + np.cumsum(~rare))
        self.size += n_rare
        while self.size > len(self.score):
            for name in ("score", "base", "known", "rare"):
                setattr(self, name, np.concatenate([getattr(self, name), np.zeros_like(getattr(self, name))]))
        self.rare[at], self.known[at] = rare, c > 0
        self.score[at] = np.array(marginals(self.model, [_text_of(w) for w in new])) / LOG10
        self.base[at] = np.log10((np.maximum(c, 0) + 0.5) / (self.n + 0.5 * (self.v + 1)))
        found = dict(zip(new, at.tolist(), strict=True))
        self.kept.update((new[i], int(at[i])) for i in np.flatnonzero(~rare).tolist())
        return [found[w] if w in found else self.kept[w] for w in words]


def score_documents(docs: DataFrame, model_path: str, train) -> DataFrame:
    """The columns of ``docs`` but its text, then n_tokens, n_known, train_tokens,
    base_score and score; ``train`` is the condition for training rows.
    Clashing input columns are replaced."""
    made = ("n_tokens", "n_known", "train_tokens", "base_score", "score")
    sc = docs.sparkSession.sparkContext
    counts = cut_lineage(word_counts(docs.select("text", train.alias("train"))))
    n, v = counts.where("n_train > 0").agg(F.coalesce(F.sum("n_train"), F.lit(0)), F.count("*")).first()
    end = counts.where(F.col("key") == F.lit(END)).agg(F.coalesce(F.sum("n_train"), F.lit(0))).first()[0]
    model, end_log = fit_pieces(counts, PieceModel.load(model_path), ends=end)
    hot, end_score = hot_words(counts), end_log / LOG10
    end_base = math.log10((end + 0.5) / (n + 0.5 * (v + 1)))
    shared = sc.broadcast((model, hot, n, v))
    name = f"{sc.applicationId}:{shared._jbroadcast.id()}"
    others = [c for c in docs.columns if c not in (*made, "text")]

    def run(batches):
        scorer, at = worker_state(f"lattice:{name}", lambda: _Scorer(*shared.value)), TaskContext.get().partitionId() << 33
        for batch in batches:
            for part in slices(batch, "text"):
                split = [words_of(t) for t in _byte_texts(part)]
                scorer.memo.ensure(split)
                rows = []
                for ws in split:
                    ix = np.fromiter(map(scorer.memo.__getitem__, ws), np.int64, len(ws))
                    score = float(scorer.score[ix].sum()) + end_score
                    places = np.flatnonzero(scorer.rare[ix])
                    named = ix[places].tolist()
                    rare, names = Counter(named), dict(zip(named, map(ws.__getitem__, places.tolist()), strict=True))
                    ix = np.delete(ix, places)
                    rows.append((at, len(ws) + 1, int(scorer.known[ix].sum()) + (end > 0), float(scorer.base[ix].sum()) + end_base, score, [{"key": key_of(names[i]), "n": c} for i, c in rare.items()]))
                    at += 1
                columns = list(zip(*rows, strict=True))
                types = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.list_(pa.struct([("key", pa.binary()), ("n", pa.int64())]))]
                own = [part.column(c) for c in others]
                yield pa.RecordBatch.from_arrays([*own, *(pa.array(c, t) for c, t in zip(columns, types, strict=True))], names=[*others, "_row", "n_tokens", "_known", "_base", "_score", "_rare"])

    kept = docs.select(*others, "text")
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema if f.name != "text"), "_row long, n_tokens long, _known long, _base double, _score double, _rare array<struct<key: binary, n: long>>"])
    hot_part = cut_lineage(kept.mapInArrow(run, schema))
    rare = hot_part.select("_row", F.explode("_rare").alias("r")).select("_row", "r.*")
    joined = rare.join(counts.select("key", "n_train"), "key", "left")
    c = F.coalesce("n_train", F.lit(0))
    base = F.log10((c + 0.5) / F.lit(n + 0.5 * (v + 1)))
    sums = joined.groupBy("_row").agg(F.sum(F.when(c > 0, F.col("n")).otherwise(0)).alias("_k"), F.sum(F.col("n") * base).alias("_b"))
    zero = F.lit(0.0)
    return hot_part.drop("_rare").join(sums, "_row", "left").select(
        *others,
        "n_tokens",
        (F.col("_known") + F.coalesce("_k", F.lit(0))).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("_base") + F.coalesce("_b", zero)).alias("base_score"),
        F.col("_score").alias("score"),
    )


def op8_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents``, learning from those whose crc32(doc_id) mod 5 is not 1."""
    import public_tokenizers

    held_out = crc_mod("doc_id", 5) == 1
    docs = table(spark, sf_dir, "documents").select("doc_id", held_out.alias("held_out"), "text")
    return score_documents(docs, public_tokenizers.path("piece_bpe_32k.model"), ~F.col("held_out"))
