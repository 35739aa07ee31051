"""Operator 12: hard negatives by angular triangle filtering.

Components are scaled to integers, so scores are exact integer inner products.
For a few reference directions every row stores its angles to them.  By the
triangle inequality the angle between an anchor a and a row x lies between
``max |A_r(a) - A_r(x)|`` and ``min(A_r(a) + A_r(x), 2 pi - A_r(a) - A_r(x))``;
the cosines of both, times the two norms, bound their score.  The bounds are
widened by more than all rounding (stored angles are 32-bit floats), so a row
outside a window can be left out unseen, and only rows whose bounds overlap a
window get integer scoring:

* positives: the window is open above and begins at the least score that the
  anchor's best rows of the same label are sure to reach;
* negatives: the windows are 80 to 100 % of each positive's score, and each
  closes further to what the best rows found so far leave open.

Before single rows, whole runs of rows are held against the windows: rows are
sorted by their angle to the first reference, and only the stretch whose angle
can reach a window is looked at.

Scale: the stated anchors meet all rows in blocks.  Rows are dealt by a hash of
vec_id into groups of about ``ROWS``, anchors into blocks of about ``ANCHORS``;
one task holds one group and one block, and returns at most ``positives`` or
``negatives`` rows an anchor or pair, which partial top-k windows merge.  No
pair of rows is ever a row of a table, a hot label or a vector that thousands
share falls into many groups, and nothing is sent to the driver but the
reference rows (``REFERENCES`` of at most ``SAMPLE`` rows) and two counts.

Rows with a null label, a null vector or a null or non-finite component take no
part.  Scores exist between vectors of one length only: every length is a space
of its own, and lengths without a reference have open bounds.  Rows alike in
vec_id, label and scaled vector count once; rows that share only the vec_id are
rows of their own.  Equal scores go by smaller vec_id, null ids last.  Components
from 2**23 on are refused (an inner product could leave 64 bits).  Empty tables
give no rows; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from yoyflow.llm.common import table
from yoyflow.session import cut_lineage

SCALE = 256
EVERY = 100  # anchors are rows whose vec_id is divisible by this
POSITIVES = NEGATIVES = 5
LOW, HIGH = 80, 100  # percent of the positive's score
ROWS, ANCHORS = 4096, 1024
REFERENCES, SAMPLE = 8, 2048
_WIDER = 2e-6  # of the product of norms: more than angles in 32 bits and arccos near 1 can be off
_NO_ID = np.iinfo(np.int64).max


def scaled(embeddings: DataFrame) -> DataFrame:
    """vec_id, label, q (scaled integers) of the rows that take part."""
    vec = F.col("embedding")
    label = F.col("label").cast("long")
    fine = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = embeddings.where(label.isNotNull() & vec.isNotNull() & fine)
    far = F.exists(vec, lambda x: F.abs(x) >= 2.0**23)
    return rows.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"),
        F.when(far, F.raise_error(F.lit("a component is 2**23 or more"))).otherwise(F.transform(vec, lambda x: F.floor(x.cast("double") * SCALE).cast("int"))).alias("q"),
    )


def references(rows: DataFrame) -> dict[int, np.ndarray]:
    """Unit reference directions by vector length: rows of a bounded sample (least hashes), each far from those before."""
    sample = rows.orderBy(F.xxhash64("vec_id", "q"), "vec_id").limit(SAMPLE).select("q").toArrow().column("q").to_pylist()
    out = {}
    for size in sorted({len(q) for q in sample} - {0}):
        m = np.array(sorted(q for q in sample if len(q) == size), np.float64)
        norms = np.linalg.norm(m, axis=1)
        m = m[norms > 0] / norms[norms > 0, None]
        if not len(m):
            continue
        at, nearest = 0, np.full(len(m), -2.0)
        picked = []
        for _ in range(min(REFERENCES, len(m))):
            picked.append(at)
            nearest = np.maximum(nearest, m @ m[at])
            at = int(np.argmin(nearest))
        out[size] = m[picked]
    return out


def with_angles(rows: DataFrame, refs: dict[int, np.ndarray]) -> DataFrame:
    """Adds norm and angles (one for each reference of the row's length)."""

    def add(batches):
        for batch in batches:
            column = batch.column("q")
            flat, offsets = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64), np.asarray(column.offsets)
            offsets = offsets - offsets[0]
            sizes = np.diff(offsets)
            norms, angles = np.zeros(len(sizes)), [np.zeros(0, np.float32)] * len(sizes)
            for size in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == size)
                m = flat[(offsets[at][:, None] + np.arange(size)).reshape(-1)].reshape(len(at), size)
                norms[at] = np.sqrt((m * m).sum(1))
                if size in refs:
                    cos = (m @ refs[size].T) / np.maximum(norms[at], 1e-300)[:, None]
                    theta = np.arccos(np.clip(cos, -1, 1)).astype(np.float32)
                    for i, t in zip(at.tolist(), theta, strict=True):
                        angles[i] = t
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(norms), pa.array(angles, pa.list_(pa.float32()))], [*batch.schema.names, "norm", "angles"])

    return rows.select("vec_id", "label", "q").mapInArrow(add, "vec_id long, label long, q array<int>, norm double, angles array<float>")


class Block:
    """The distinct rows of one length in a group, sorted by their angle to the first reference."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, q: np.ndarray, norms: np.ndarray, angles: np.ndarray):
        first = angles[:, 0] if angles.shape[1] else np.zeros(len(ids), np.float32)
        order = np.lexsort((ids, first))
        self.ids, self.labels, self.q, self.norms, self.first = ids[order], labels[order], q[order], norms[order], first[order]
        self.angles = angles[order]
        self.most = float(norms.max(initial=0.0))

    def bounds(self, norm: float, angles: np.ndarray, at: slice) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest possible scores of the rows ``at`` with an anchor."""
        product = self.norms[at] * norm
        slack = product * _WIDER + 1
        theirs = self.angles[at].astype(np.float64)
        if not theirs.shape[1]:
            return -product - slack, product + slack
        near = np.abs(theirs - angles).max(1)
        both = theirs + angles
        far = np.minimum(both, 2 * np.pi - both).min(1)
        return product * np.cos(np.clip(far, 0, np.pi)) - slack, product * np.cos(np.clip(near, 0, np.pi)) + slack

    def stretch(self, norm: float, angles: np.ndarray, least: float) -> slice:
        """The rows whose angle to the first reference leaves a score of ``least`` possible."""
        product = norm * self.most
        if not len(angles) or least <= 0 or product == 0:
            return slice(0, len(self.ids)) if least <= 1 or product > 0 else slice(0, 0)
        cos = (least - 1) / product - _WIDER
        if cos > 1:
            return slice(0, 0)
        width = np.arccos(max(cos, -1.0)) + 1e-6
        return slice(int(np.searchsorted(self.first, angles[0] - width)), int(np.searchsorted(self.first, angles[0] + width, "right")))

    def scores(self, q: np.ndarray, norm: float, at: np.ndarray) -> np.ndarray:
        """Exact integer inner products."""
        if norm * self.most < 2.0**52:  # every partial sum is an exact double
            return (self.q[at].astype(np.float64) @ q.astype(np.float64)).astype(np.int64)
        if norm * self.most >= 2.0**62:
            raise OverflowError("an inner product could leave 64 bits")
        return self.q[at].astype(np.int64) @ q.astype(np.int64)


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, -scores))[:k]


def _list(column: pa.ChunkedArray, rows: np.ndarray, size: int, kind) -> np.ndarray:
    """The rows of a list column that all have ``size`` elements, as a matrix."""
    one = column.combine_chunks().take(pa.array(rows))
    return one.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(rows), size)


def _blocks(rows: pa.Table) -> dict[int, Block]:
    if not rows.num_rows:
        return {}
    ids = rows.column("vec_id").combine_chunks().fill_null(_NO_ID).to_numpy()
    labels = rows.column("label").to_numpy()
    norms = rows.column("norm").to_numpy()
    sizes = rows.column("q").combine_chunks().value_lengths().to_numpy()
    depth = rows.column("angles").combine_chunks().value_lengths().to_numpy()
    out = {}
    for size in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == size)
        q = _list(rows.column("q"), at, size, np.int32)
        # equal rows lie in one group, as groups go by vec_id: keep one of them
        _, once = np.unique(np.column_stack([ids[at], labels[at], q.astype(np.int64)]), axis=0, return_index=True)
        angles = _list(rows.column("angles"), at, int(depth[at[0]]), np.float32)
        out[size] = Block(ids[at][once], labels[at][once], q[once], norms[at][once], angles[once])
    return out


def _positives(rows: pa.Table, anchors: pa.Table, k: int) -> pa.Table:
    blocks, out = _blocks(rows), []
    for a in anchors.to_pylist():
        b, q = blocks.get(len(a["q"])), np.array(a["q"], np.int32)
        if b is None:
            continue
        me = (b.ids == (_NO_ID if a["anchor_id"] is None else a["anchor_id"])) & (b.labels == a["label"])
        me[me] = (b.q[me] == q).all(1)
        angles = np.array(a["angles"], np.float64)
        low, high = b.bounds(a["norm"], angles, slice(None))
        own = np.flatnonzero((b.labels == a["label"]) & ~me)
        if len(own) > k:  # at least k rows reach this score
            own = own[high[own] >= np.partition(low[own], len(own) - k)[len(own) - k]]
        score = b.scores(q, a["norm"], own)
        for i in _best(b.ids[own], score, k).tolist():
            out.append((a["anchor_id"], a["anchor_no"], None if b.ids[own[i]] == _NO_ID else int(b.ids[own[i]]), int(score[i])))
    columns = list(zip(*out, strict=True)) or [()] * 4
    return pa.table([pa.array(c, pa.int64()) for c in columns], names=["anchor_id", "anchor_no", "positive_id", "positive_score"])


def _negatives(rows: pa.Table, anchors: pa.Table, k: int) -> pa.Table:
    blocks, out = _blocks(rows), []
    for a in anchors.to_pylist():
        b, q = blocks.get(len(a["q"])), np.array(a["q"], np.int32)
        # 80 * positive <= 100 * negative <= 100 * positive, as a window of whole scores
        windows = [(p, -(-LOW * p["positive_score"] // HIGH), p["positive_score"]) for p in a["positives"] if p["positive_score"] >= 0]
        if b is None or not windows:
            continue
        angles = np.array(a["angles"], np.float64)
        part = b.stretch(a["norm"], angles, min(low for _, low, _ in windows))
        at = np.arange(part.start, part.stop)
        low, high = b.bounds(a["norm"], angles, part)
        other = b.labels[part] != a["label"]
        scored = np.full(len(at), False)
        score = np.zeros(len(at), np.int64)
        for p, least, most in windows:
            held = np.flatnonzero(other & (high >= least) & (low <= most))
            inside = held[(low[held] >= least) & (high[held] <= most)]
            if len(inside) > k:  # the best of the rows sure to be inside close the window
                least = max(least, int(np.floor(np.partition(low[inside], len(inside) - k)[len(inside) - k])))
                held = held[high[held] >= least]
            new = held[~scored[held]]
            score[new], scored[new] = b.scores(q, a["norm"], at[new]), True
            held = held[(score[held] >= least) & (score[held] <= most)]
            for i in held[_best(b.ids[at[held]], score[held], k)].tolist():
                out.append((a["anchor_id"], a["anchor_no"], p["place"], p["positive_id"], p["positive_score"], None if b.ids[at[i]] == _NO_ID else int(b.ids[at[i]]), int(score[i])))
    columns = list(zip(*out, strict=True)) or [()] * 7
    return pa.table([pa.array(c, pa.int64()) for c in columns], names=["anchor_id", "anchor_no", "place", "positive_id", "positive_score", "negative_id", "negative_score"])


def _meet(rows: DataFrame, anchors: DataFrame, groups: int, fn, schema: str) -> DataFrame:
    """``fn`` over every group of rows with every block of anchors."""
    blocks = max(1, -(-anchors.count() // ANCHORS))
    n_of = F.pmod(F.xxhash64("vec_id"), F.lit(groups))
    left = rows.withColumn("_group", n_of).withColumn("_block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    right = anchors.withColumn("_block", F.pmod(F.xxhash64("anchor_id", "anchor_no"), F.lit(blocks)).cast("int"))
    right = right.withColumn("_group", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))))
    return left.groupBy("_group", "_block").cogroup(right.groupBy("_group", "_block")).applyInArrow(fn, schema)


def mine(embeddings: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    base = scaled(embeddings)
    rows = cut_lineage(with_angles(base, references(base)))
    groups = max(1, -(-rows.count() // ROWS))
    twins = Window.partitionBy("vec_id").orderBy("label", "q")
    anchors = rows.where(F.col("vec_id") % EVERY == 0).groupBy("vec_id", "label", "q").agg(F.first("norm").alias("norm"), F.first("angles").alias("angles"))
    anchors = cut_lineage(anchors.withColumn("anchor_no", F.row_number().over(twins).cast("long")).withColumnRenamed("vec_id", "anchor_id"))
    found = _meet(rows, anchors, groups, lambda r, a: _positives(r, a, positives), "anchor_id long, anchor_no long, positive_id long, positive_score long")
    own = Window.partitionBy("anchor_id", "anchor_no").orderBy(F.col("positive_score").desc(), F.col("positive_id").asc_nulls_last())
    found = found.withColumn("place", F.row_number().over(own).cast("long")).where(F.col("place") <= positives)
    found = found.groupBy("anchor_id", "anchor_no").agg(F.collect_list(F.struct("place", "positive_id", "positive_score")).alias("positives"))  # at most `positives`
    windows = cut_lineage(anchors.join(found, ["anchor_id", "anchor_no"], "inner"))
    schema = "anchor_id long, anchor_no long, place long, positive_id long, positive_score long, negative_id long, negative_score long"
    found = _meet(rows, windows, groups, lambda r, a: _negatives(r, a, negatives), schema)
    pair = Window.partitionBy("anchor_id", "anchor_no", "place").orderBy(F.col("negative_score").desc(), F.col("negative_id").asc_nulls_last())
    found = found.withColumn("rank", F.row_number().over(pair)).where(F.col("rank") <= negatives)
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine(table(spark, sf_dir, "embeddings"))
