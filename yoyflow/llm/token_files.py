"""Operator 7: token ids in files of byte-aligned variable-length codes.

Ids are replaced by their frequency rank (rank 0: the most frequent id), and a
rank takes one to four bytes.  The byte counts stand apart from the bytes: a
control byte holds four two-bit lengths (minus one), lowest bits first, so a
block is decoded without branches: a 256-row table gives the four lengths of
each control byte, a running sum the offsets, and the bytes are gathered.

A data set is a folder with two Parquet tables, written by Spark's committer
(a lost executor's half-written files never show):

* ``ranks``: (rank, id), the vocabulary by descending frequency, ties by id;
* ``blocks``: (shard, block, start, n_tokens, doc_ids, sizes, control, data).
  Shards are contiguous, ascending ranges of doc_id and a block holds whole
  documents; ``doc_ids`` is an array (a null id stands first), ``sizes`` are
  little-endian uint32 and ``start`` counts the ids of the shard that stand
  before the block.

Scale: each text is encoded once, in the scan (cut into words and looked up among the
worker's known words in Arrow, only new words go to the library); its ids (two bytes each where
the vocabulary allows) are stored, with the frequencies summed per task.  The documents' codes are dealt by
ranges of doc_id: a
partition is a share of the documents, and rows of equal doc_id are dealt by
the checksum of their ids too.  The driver sees the vocabulary and one row per
shard.  A null text is empty; documents without id come first; rows with equal
doc_id stay in order of their checksum; an empty table gives empty files.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from yoyflow.llm import tokenizers as tk
from yoyflow.llm.common import pooled, table, worker_state
from yoyflow.session import new_stage

BLOCK_TOKENS = 1 << 18
CODE_BYTES = 8 << 20  # text handed to the coder at once
_LENGTHS = np.array([[1 + (c >> 2 * k & 3) for k in range(4)] for c in range(256)], np.uint8)


def pack(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control and data bytes of a sequence of ranks below 2**32."""
    r = ranks.astype("<u4")
    wide = 1 + (r > 0xFF).astype(np.uint8) + (r > 0xFFFF) + (r > 0xFFFFFF)
    two = np.zeros(-(-len(r) // 4) * 4, np.uint8)
    two[: len(r)] = wide - 1
    two = two.reshape(-1, 4)
    control = two[:, 0] | two[:, 1] << 2 | two[:, 2] << 4 | two[:, 3] << 6
    each = r.view(np.uint8).reshape(-1, 4)
    return control.tobytes(), each[np.arange(4, dtype=np.uint8) < wide[:, None]].tobytes()


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ``n`` ranks of a block."""
    wide = _LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    at = np.cumsum(wide, dtype=np.int64) - wide
    raw = np.frombuffer(data + b"\0\0\0", np.uint8)
    out = raw[at].astype(np.uint32)
    for k in (1, 2, 3):
        more = np.flatnonzero(wide > k)
        if not len(more):
            break
        out[more] |= raw[at[more] + k].astype(np.uint32) << np.uint32(8 * k)
    return out



def encode_documents(docs: DataFrame, tokenizer_path: str, end_id: int | None) -> tuple[DataFrame, str]:
    """``(doc_id, ids binary, crc long, counts binary)``, ids as little-endian integers of
    the returned type; the last row of each task holds no document but ``counts``, how
    often each id occurs in the task's documents (int64 by id)."""
    size = tk.byte_level(tokenizer_path).get_vocab_size(with_added_tokens=True)
    dtype = "<u2" if size <= 1 << 16 else "<u4"
    end = pa.scalar(b"" if end_id is None else np.array([end_id], dtype).tobytes(), pa.binary())
    kinds = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary()), ("crc", pa.int64()), ("counts", pa.binary())])

    def run(batches):
        coder = worker_state(f"coder:{tokenizer_path}:{dtype}", lambda: tk.ByteLevelCoder(tokenizer_path, dtype))
        total = np.zeros(size, np.int64)
        for part in pooled(batches, "text", CODE_BYTES):
            ids = pc.binary_join_element_wise(coder.encode(pc.fill_null(part.column("text"), "")), end, pa.scalar(b"", pa.binary()))
            raw = ids.to_pylist()
            total += np.bincount(np.frombuffer(b"".join(raw), dtype), minlength=size)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), ids, pa.array(map(zlib.crc32, raw), pa.int64()), pa.nulls(len(raw), pa.binary())], schema=kinds)
        yield pa.RecordBatch.from_pylist([{"counts": total.astype("<i8").tobytes()}], kinds)

    columns = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return columns.mapInArrow(run, "doc_id long, ids binary, crc long, counts binary"), dtype


def frequencies(encoded: DataFrame) -> DataFrame:
    """``(id, n)``, every id that occurs with its frequency."""

    def run(batches):
        total = np.zeros(0, np.int64)
        for batch in batches:
            for raw in batch.column("counts").to_pylist():
                found = np.frombuffer(raw, "<i8")
                total = found + total if len(total) else found
        used = np.flatnonzero(total)
        yield pa.record_batch({"id": pa.array(used, pa.int64()), "n": pa.array(total[used], pa.int64())})

    return encoded.select("counts").where("counts is not null").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, end_id: int | None = None, block_tokens: int = BLOCK_TOKENS) -> None:
    """Encode ``(doc_id, text)`` and write the data set ``path`` (see the module's text)."""
    spark = docs.sparkSession
    fresh, dtype = encode_documents(docs, tokenizer_path, end_id)
    stage = new_stage(spark)
    fresh.write.option("compression", "zstd").parquet(stage)
    stored = spark.read.parquet(stage)
    encoded = stored.where("counts is null").drop("counts")
    frequency = frequencies(stored).orderBy(F.desc("n"), "id").collect()  # one row per id of the vocabulary
    ids = [r.id for r in frequency]
    spark.createDataFrame([(i, x) for i, x in enumerate(ids)], "rank long, id long").coalesce(1).write.parquet(f"{path}/ranks")
    rank_of = np.zeros(max(ids, default=0) + 1, np.uint32)
    rank_of[ids] = np.arange(len(ids))
    ranks = spark.sparkContext.broadcast(rank_of)

    def blocks(batches):
        shard, block, start = TaskContext.get().partitionId(), 0, 0
        doc_ids: list[int | None] = []
        parts: list[np.ndarray] = []
        held = 0

        def flush() -> pa.RecordBatch:
            flat = np.concatenate(parts) if parts else np.zeros(0, dtype)
            control, data = pack(ranks.value[flat])
            row = {"shard": shard, "block": block, "start": start, "n_tokens": len(flat), "doc_ids": list(doc_ids), "sizes": np.array([len(p) for p in parts], "<u4").tobytes(), "control": control, "data": data}
            return pa.RecordBatch.from_pylist([row], pa.schema([("shard", pa.int64()), ("block", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("sizes", pa.binary()), ("control", pa.binary()), ("data", pa.binary())]))

        for batch in batches:
            for doc_id, raw in zip(batch.column("doc_id").to_pylist(), batch.column("ids"), strict=True):
                part = np.frombuffer(raw.as_py(), dtype)
                if parts and held + len(part) > block_tokens:
                    yield flush()
                    block, start, held = block + 1, start + held, 0
                    doc_ids.clear()
                    parts.clear()
                doc_ids.append(doc_id)
                parts.append(part)
                held += len(part)
        if parts:
            yield flush()

    dealt = encoded.repartitionByRange("doc_id", "crc").sortWithinPartitions("doc_id", "crc", "ids").select("doc_id", "ids")
    dealt.mapInArrow(blocks, "shard long, block long, start long, n_tokens long, doc_ids array<long>, sizes binary, control binary, data binary").write.parquet(f"{path}/blocks")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids binary)`` of every stored document: ``start``
    counts the ids of all documents before it, ``ids`` are little-endian uint32."""
    id_of = np.zeros(0, np.uint32)
    if rows := spark.read.parquet(f"{path}/ranks").orderBy("rank").collect():
        id_of = np.array([r.id for r in rows], np.uint32)
    stored = spark.read.parquet(f"{path}/blocks")
    shards = stored.groupBy("shard").agg(F.sum("n_tokens").alias("n")).orderBy("shard").collect()  # one row per file
    before, total = {}, 0
    for r in shards:
        before[r.shard], total = total, total + r.n
    shared = spark.sparkContext.broadcast((id_of, before))

    def run(batches):
        to_id, offsets = shared.value
        for batch in batches:
            for row in range(batch.num_rows):
                b = {c: batch.column(c)[row].as_py() for c in batch.schema.names}
                ids = to_id[unpack(b["control"], b["data"], b["n_tokens"])].astype("<u4")
                sizes = np.frombuffer(b["sizes"], "<u4").astype(np.int64)
                ends = np.cumsum(sizes)
                flat = ids.tobytes()
                yield pa.record_batch(
                    {
                        "doc_id": pa.array(b["doc_ids"], pa.int64()),
                        "start": pa.array(offsets[b["shard"]] + b["start"] + ends - sizes),
                        "n_tokens": pa.array(sizes),
                        "ids": pa.array([flat[4 * (e - n) : 4 * e] for e, n in zip(ends.tolist(), sizes.tolist(), strict=True)], pa.binary()),
                    }
                )

    return stored.mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` by byte_bpe_50k.json, written with id 0 after each text, and read back."""
    import public_tokenizers

    path = new_stage(spark)
    write_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"), end_id=0)
    return read_tokens(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
