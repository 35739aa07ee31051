"""Operator 3: token counts through a digest cache.

A count is a function of the text and of the tokenizer's file.  Texts are
joined by the SHA-256 of their normalised content and of that file to a table
of stored counts; only the distinct contents that are not in it are encoded,
and their counts are appended.

The cache is a Parquet table ``(content_digest binary, n_tokens long)`` below
``<path>/tokenizer=<digest>/``.  Two runs that append the same content leave
two equal rows, which reading reduces to one.

Scale: what is shuffled is one row per document of digest and sizes, and once
the text of the distinct contents (combined in the map task first, so copies
of a text that fills a third of the rows send one row per task).  The join of
documents to counts starts from two shuffles, so adaptive execution can split
a content that many documents share.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from yoyflow.llm import tokenizers as tk
from yoyflow.llm.common import Memo, map_slices, table, texts, worker_state
from yoyflow.operators.joins import hashed_join
from yoyflow.session import new_stage

CONTEXT = 4096


def null_as_empty(text: Column) -> Column:
    """The normalisation that keeps every count: both libraries see all other differences."""
    return F.coalesce(text, F.lit(""))


class _PieceCounter:
    """Counts by SentencePiece, each distinct word encoded about once."""

    def __init__(self, path: str):
        model = tk.sentence_piece(path)
        self._memo = Memo(lambda words: [len(ids) for ids in model.encode(words, num_threads=1)])

    def __call__(self, given: list[str]) -> list[int]:
        return [sum(found) for found in self._memo.lookup([tk.piece_chunks(t) for t in given])]


class _ByteLevelCounter:
    """Counts by a tokenizers file."""

    def __init__(self, path: str):
        self._coder = tk.ByteLevelCoder(path, "<u4")

    def __call__(self, given: list[str]) -> list[int]:
        return [len(ids) // 4 for ids in self._coder(given)]


def _count_slice(path: str):
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        count = worker_state(f"counter:{path}", lambda: _PieceCounter(path) if path.endswith(".model") else _ByteLevelCounter(path))
        return pa.record_batch({"content_digest": batch.column("content_digest"), "n_tokens": pa.array(count(texts(batch)), pa.int64())})

    return run


class TokenCountCache:
    """Stored token counts of one tokenizer file below ``path``."""

    schema = "content_digest binary, n_tokens long"

    def __init__(self, spark: SparkSession, path: str, tokenizer_path: str):
        self.spark, self.tokenizer_path = spark, tokenizer_path
        self.path = f"{path.rstrip('/')}/tokenizer={tk.digest(tokenizer_path)}"

    def read(self) -> DataFrame:
        """One row per stored content; no rows if nothing is stored yet."""
        target = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        if not target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(target):
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(self.path).groupBy("content_digest").agg(F.max("n_tokens").alias("n_tokens"))

    def add_missing(self, contents: DataFrame) -> None:
        """Encode the distinct rows of ``(content_digest, text)`` that are not stored."""
        distinct = contents.groupBy("content_digest").agg(F.first("text").alias("text"))
        missing = distinct.join(self.read(), "content_digest", "left_anti")
        map_slices(missing, _count_slice(self.tokenizer_path), self.schema).write.mode("append").parquet(self.path)


def token_counts(docs: DataFrame, tokenizer_path: str, cache_path: str, text: str = "text", keep: list[str] | None = None, normalise: Callable[[Column], Column] = null_as_empty) -> DataFrame:
    """The columns ``keep`` of ``docs`` (default: all) with ``n_bytes`` and ``n_tokens``.

    Input columns of those two names are replaced.  A null text counts as
    empty (0 tokens), repeated rows stay repeated, an empty table gives no
    rows.  The missing counts are stored when this is called; the result is
    lazy.  Only kept columns travel through the join, so leave the text out
    where it isn't needed.
    """
    cache = TokenCountCache(docs.sparkSession, cache_path, tokenizer_path)
    content = normalise(F.col(text))
    digest = F.unhex(F.sha2(content.cast("binary"), 256))
    cache.add_missing(docs.select(digest.alias("content_digest"), content.alias("text")))
    kept = [c for c in (docs.columns if keep is None else keep) if c not in ("n_bytes", "n_tokens")]
    rows = docs.select(*kept, F.octet_length(content).cast("long").alias("n_bytes"), digest.alias("_content"))
    stored = cache.read().withColumnRenamed("content_digest", "_content")
    return hashed_join(rows, stored, ["_content"], how="left").drop("_content")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of ``documents`` by piece_bpe_32k.model, from an empty cache on each call."""
    import public_tokenizers

    counted = token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), new_stage(spark), keep=["doc_id"])
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > CONTEXT).alias("over_limit"))
