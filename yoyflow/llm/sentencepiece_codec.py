"""Operator 2: SentencePiece encoding and decoding, unigram kind.

A text gets the whitespace marker put before it and in place of its spaces;
Viterbi over the lattice of pieces (``pieces.py``) finds the best path.  No
piece holds the marker after another character, so the best path of a text is
made of the best paths of its words, and each distinct word is searched once
per worker.  Decoding joins the pieces' bytes, with the marker as a space and
byte pieces as they are, and drops the one space put before.

Both run inside the scan: no shuffle, no driver step, and the vocabulary (its
size is fixed by the file) is the only thing broadcast.

Nulls and empty texts have no ids and decode to ''; a text with the marker
character itself comes back with spaces in its place; row order and repeated
rows are kept; clashing output names replace the input's columns.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from yoyflow.llm.common import Memo, map_slices, table, texts, worker_state
from yoyflow.llm.pieces import PieceModel, best_paths
from yoyflow.llm.tokenizers import MARKER, piece_chunks


def encode_texts(model: PieceModel, batch: list[str]) -> tuple[list[bytes], list[float]]:
    """Little-endian int32 ids and natural-log score of each text's best path."""
    memo = worker_state(f"pieces:{model.key}", lambda: Memo(lambda words: best_paths(model, words), 150_000))
    found = memo.lookup([_words(t) for t in batch])
    return [b"".join([x[0] for x in f]) for f in found], [sum(x[1] for x in f) for f in found]


def _words(text: str) -> list[str]:
    if not text:
        return []
    return piece_chunks(text.replace(MARKER, " ") if MARKER in text else text)


def decode_ids(model: PieceModel, ids: np.ndarray) -> str:
    """The text of a sequence of ids; bytes that are no UTF-8 become U+FFFD."""
    raw = b"".join(map(model.text.__getitem__, ids.tolist()))
    return raw.decode("utf-8", "replace").removeprefix(" ")


def _without(docs: DataFrame, names: tuple[str, ...]) -> list[str]:
    return [c for c in docs.columns if c not in names]


def encode(docs: DataFrame, model_path: str, text: str = "text") -> DataFrame:
    """``docs`` with ``piece_ids`` (array of int) and ``piece_score`` (natural log)."""
    model = docs.sparkSession.sparkContext.broadcast(PieceModel.load(model_path))
    kept = docs.select(*_without(docs, ("piece_ids", "piece_score")))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, scores = encode_texts(model.value, texts(batch, text))
        ends = np.cumsum([0, *(len(i) // 4 for i in ids)])
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(ids), "<i4")))
        return pa.RecordBatch.from_arrays([*batch.columns, lists, pa.array(scores, pa.float64())], names=[*batch.schema.names, "piece_ids", "piece_score"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema), "piece_ids array<int>", "piece_score double"])
    return map_slices(kept, run, schema, text)


def decode(encoded: DataFrame, model_path: str, ids: str = "piece_ids") -> DataFrame:
    """``encoded`` with ``decoded`` (string), the text of the column ``ids``; null ids give ''."""
    model = encoded.sparkSession.sparkContext.broadcast(PieceModel.load(model_path))
    kept = encoded.select(*_without(encoded, ("decoded",)))

    def run(batches):
        for batch in batches:
            found = [decode_ids(model.value, np.array(x or [], np.int64)) for x in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string())], names=[*batch.schema.names, "decoded"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema), "decoded string"])
    return kept.mapInArrow(run, schema)


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text of ``documents`` encoded and decoded again.

    doc_id, n_pieces, n_byte_pieces (pieces given as bytes), ids_crc32 (of the
    ids as little-endian int32), score, decoded_crc32 (of the decoded UTF-8)
    and round_trip (the decoded text is the text, the marker taken as a space).
    """
    import public_tokenizers

    model = spark.sparkContext.broadcast(PieceModel.load(public_tokenizers.path("piece_bpe_32k.model")))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        m, given = model.value, texts(batch)
        is_byte = np.zeros(len(m.scores), bool)
        is_byte[m.byte_ids] = True
        ids, scores = encode_texts(m, given)
        arrays = [np.frombuffer(i, "<i4") for i in ids]
        decoded = [decode_ids(m, a) for a in arrays]
        return pa.record_batch(
            {
                "doc_id": batch.column("doc_id"),
                "n_pieces": pa.array([len(a) for a in arrays], pa.int64()),
                "n_byte_pieces": pa.array([int(is_byte[a].sum()) for a in arrays], pa.int64()),
                "ids_crc32": pa.array([zlib.crc32(i) for i in ids], pa.int64()),
                "score": pa.array(scores, pa.float64()),
                "decoded_crc32": pa.array([zlib.crc32(d.encode()) for d in decoded], pa.int64()),
                "round_trip": pa.array([d == t.replace(MARKER, " ") for d, t in zip(decoded, given, strict=True)], pa.bool_()),
            }
        )

    schema = "doc_id long, n_pieces long, n_byte_pieces long, ids_crc32 long, score double, decoded_crc32 long, round_trip boolean"
    return map_slices(table(spark, sf_dir, "documents").select("doc_id", "text"), run, schema)
