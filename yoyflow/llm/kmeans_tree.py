"""Operator 6: nearest neighbours by inner product in a hierarchical k-means tree.

The tree is fitted in numpy on a sample of at most ``SAMPLE`` vectors (the
first by hash of the id); every row is then assigned to a leaf, so all rows
are indexed.  A query walks the tree best bin first: a priority queue holds
nodes by the inner product of their centre with the query, and the best one is
opened until enough leaves are visited (and these hold enough rows).  How many
leaves that takes is calibrated: for ``CALIBRATION`` queries the exact result
is found by a scan of all rows, and the visits are widened until the mean
recall reaches ``RECALL``.

Scores are sums over the components in order, in double precision, of the
original vectors, so equal vectors have equal scores; ties go to the smaller
id.  Equal vectors are scored once per block.

Scale: the tree (at most ``LEAVES`` leaves) is broadcast.  Neighbouring small
leaves form a group of at most ``BLOCK`` rows; the rows of a larger leaf are cut
into blocks of about that size by a hash, a group's queries into parts of about
``PART``.  A task's work is one block with one part, so neither a common vector
nor a favourite leaf grows it.  It scores only the leaves that a query visits
and returns at most k rows a query; the last step ranks these.

Null and zero vectors and those with null or non-finite components take no
part, nor do rows without id.  Vectors of different lengths are searched apart.
Rows of equal id count once (the vector with the least hash).  With fewer candidates than k, all are
returned.  An empty table gives no rows.
"""

from __future__ import annotations

import heapq
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from yoyflow.llm.common import table
from yoyflow.session import cut_lineage

SAMPLE = 20_000
LEAVES = 4_096
LEAF_ROWS = 256
BRANCH = 16
CALIBRATION = 128
RECALL = 0.95
BLOCK, PART = 8_192, 4_096


def kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 8) -> np.ndarray:
    """The centre that each row is nearest to, after Lloyd's rounds from distinct random rows."""
    centres = np.unique(x[rng.permutation(len(x))[: 4 * k]], axis=0)
    centres = centres[rng.permutation(len(centres))[:k]]
    for _ in range(rounds):
        nearest = _nearest(x, centres)
        count = np.bincount(nearest, minlength=len(centres))
        total = np.zeros_like(centres)
        np.add.at(total, nearest, x)
        centres = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], centres)
    return _nearest(x, centres)


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (x @ centres.T - (centres**2).sum(1) / 2).argmax(1)


class Tree:
    """Nodes with centres; a leaf has a number, an inner node children."""

    def __init__(self, sample: np.ndarray, leaves: int, seed: int = 6):
        rng = np.random.default_rng(seed)
        self.centre = [sample.mean(0)]
        self.children: list[list[int]] = [[]]
        most = max(1, -(-len(sample) // leaves))
        todo = [(0, sample)]
        while todo:
            node, rows = todo.pop()
            if len(rows) <= most:
                continue
            part = kmeans(rows, min(BRANCH, -(-len(rows) // most) + 1), rng)
            if part.min() == part.max():
                continue  # equal vectors
            for p in np.unique(part).tolist():
                own = rows[part == p]
                self.children[node].append(len(self.centre))
                todo.append((len(self.centre), own))
                self.centre.append(own.mean(0))
                self.children.append([])
        self.centre = np.array(self.centre)
        self.leaf = np.full(len(self.children), -1)
        ends = [i for i, c in enumerate(self.children) if not c]
        self.leaf[ends] = np.arange(len(ends))
        self.leaves = len(ends)
        self.rows = np.zeros(self.leaves, np.int64)  # of the whole table, by leaf
        self.group = np.arange(self.leaves)

    def form_groups(self, block: int) -> None:
        """Number the groups: runs of neighbouring leaves with at most ``block`` rows."""
        number, held = 0, 0
        for i, n in enumerate(self.rows.tolist()):
            if held and held + n > block:
                number, held = number + 1, 0
            self.group[i], held = number, held + n

    def assign(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row, by the nearest centre on every level."""
        node = np.zeros(len(x), np.int64)
        open_ = [0]
        while open_:
            n = open_.pop()
            if self.children[n]:
                here = np.flatnonzero(node == n)
                if len(here):
                    kids = np.array(self.children[n])
                    node[here] = kids[_nearest(x[here], self.centre[kids])]
                    open_ += kids.tolist()
        return self.leaf[node]

    def visit(self, query: np.ndarray, visits: int, rows: int) -> list[int]:
        """Leaves, best bin first: at least ``visits``, holding at least ``rows`` rows."""
        score = self.centre @ query
        queue, out, held = [(-score[0], 0)], [], 0
        while queue and (len(out) < visits or held < rows):
            _, node = heapq.heappop(queue)
            if self.children[node]:
                for c in self.children[node]:
                    heapq.heappush(queue, (-score[c], c))
            else:
                out.append(int(self.leaf[node]))
                held += int(self.rows[self.leaf[node]])
        return out


def _matrix(column: pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def inner_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of rows of equal place: sums in the order of the components."""
    out = np.zeros(len(a))
    for d in range(a.shape[1]):
        out += a[:, d] * b[:, d]
    return out


def nearest(
    query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int, leaf: np.ndarray | None = None, visited: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place of the query, id and score of each query's k nearest other rows; with
    ``leaf`` (of each row) only among rows whose leaf the query has ``visited``."""
    order = np.argsort(ids, kind="stable")
    ids, x = ids[order], np.ascontiguousarray(x[order])
    _, first, which = np.unique(x.view(np.dtype((np.void, x.dtype.itemsize * x.shape[1]))).ravel(), return_index=True, return_inverse=True)
    distinct = x[first]
    if leaf is not None:
        leaf = leaf[order][first]  # equal vectors are in one leaf
    by_vector = np.argsort(which, kind="stable")  # rows of each distinct vector, by id
    begin = np.searchsorted(which[by_vector], np.arange(len(first) + 1))
    size = np.minimum(np.diff(begin), k + 1)
    rows_q, rows_i, rows_s = [], [], []
    for a in range(0, len(queries), 256):
        score = queries[a : a + 256] @ distinct.T
        if visited is not None:
            score[~visited[a : a + 256][:, leaf]] = -np.inf
        best = min(k + 1, len(distinct))
        bound = np.partition(score, len(distinct) - best, axis=1)[:, len(distinct) - best]
        q, v = np.nonzero((score >= (bound - 1e-9 * (1 + np.abs(bound)))[:, None]) & (score > -np.inf))
        exact = inner_products(queries[a + q], distinct[v])
        n = size[v]
        q, s = np.repeat(q, n), np.repeat(exact, n)
        i = ids[by_vector[np.repeat(begin[v], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]]
        other = i != query_ids[a + q]
        q, i, s = q[other], i[other], s[other]
        order = np.lexsort((i, -s, q))
        q, i, s = q[order], i[order], s[order]
        start = np.searchsorted(q, np.arange(len(score)))
        keep = np.arange(len(q)) - start[q] < k
        rows_q.append(a + q[keep])
        rows_i.append(i[keep])
        rows_s.append(s[keep])
    return tuple(np.concatenate(r) for r in (rows_q, rows_i, rows_s))


def valid_vectors(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``(vec_id, v array<double>)`` of the rows that take part, one per id."""
    v = F.col(vector).cast("array<double>")
    finite = F.forall(v, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
    some = rows.select(F.col(vec_id).cast("long").alias("vec_id"), v.alias("v")).where(F.col("vec_id").isNotNull() & finite & F.exists("v", lambda e: e != 0))
    return some.groupBy("vec_id").agg(F.min_by("v", F.xxhash64("v")).alias("v"))


def _best(found: DataFrame, k: int) -> DataFrame:
    by_query = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(by_query)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def build(rows: DataFrame, sample: int = SAMPLE) -> tuple[Tree, DataFrame]:
    """The tree and ``(leaf, vec_id, v)`` of every row (stored)."""
    n = rows.count()
    share = int(min(1.0, sample / max(n, 1)) * (1 << 30))
    picked = rows.where(F.xxhash64("vec_id", F.lit(6)).bitwiseAND(F.lit((1 << 30) - 1)) < share).orderBy("vec_id").limit(2 * sample)
    x = _matrix(picked.select("v").toArrow().column("v"))
    tree = Tree(x if len(x) else np.zeros((1, 1)), max(1, min(LEAVES, n // LEAF_ROWS)))
    shared = rows.sparkSession.sparkContext.broadcast(tree)

    def run(batches):
        for batch in batches:
            yield pa.record_batch({"leaf": pa.array(shared.value.assign(_matrix(batch.column("v"))), pa.int32()), "vec_id": batch.column("vec_id"), "v": batch.column("v")})

    index = cut_lineage(rows.select("vec_id", "v").mapInArrow(run, "leaf int, vec_id long, v array<double>"))
    for r in index.groupBy("leaf").count().collect():  # one row per leaf
        tree.rows[r.leaf] = r["count"]
    return tree, index


def exact(index: DataFrame, ids: np.ndarray, queries: np.ndarray, k: int) -> DataFrame:
    """``(query_id, rank, vec_id, score, leaf)`` of a few queries against all rows, by a scan."""
    shared = index.sparkSession.sparkContext.broadcast((ids, queries))

    def run(batches):
        for batch in batches:
            own, q = shared.value
            rows, x = batch.column("vec_id").to_numpy(), _matrix(batch.column("v"))
            at, found, score = nearest(own, q, rows, x, k)
            place = np.argsort(rows)
            leaf = batch.column("leaf").to_numpy()[place[np.searchsorted(rows, found, sorter=place)]]
            yield pa.record_batch({"query_id": own[at], "vec_id": found, "score": score, "leaf": leaf})

    found = index.mapInArrow(run, "query_id long, vec_id long, score double, leaf int")
    by_query = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(by_query)).where(F.col("rank") <= k)


def calibrate(tree: Tree, index: DataFrame, queries: DataFrame, k: int, recall: float = RECALL, most: int = CALIBRATION) -> int:
    """The least number of visits with which the calibration queries' mean recall reaches ``recall``."""
    some = queries.orderBy(F.xxhash64("vec_id", F.lit(1)), "vec_id").limit(most).toArrow()
    if not some.num_rows:
        return 1
    ids, q = some.column("vec_id").to_numpy(), _matrix(some.column("v"))
    true: dict[int, list[int]] = {}
    for r in exact(index, ids, q, k).select("query_id", "leaf").collect():  # most * k rows
        true.setdefault(r.query_id, []).append(r.leaf)
    need: list[np.ndarray] = []  # for each query, the visits after which each true neighbour is found
    for i, own in zip(ids.tolist(), q, strict=True):
        place = np.full(tree.leaves, tree.leaves)
        order = tree.visit(own, tree.leaves, 0)
        place[order] = np.arange(1, len(order) + 1)
        if i in true:
            need.append(np.sort(place[true[i]]))
    visits = 1
    while need and np.mean([(n <= visits).mean() for n in need]) < recall and visits < tree.leaves:
        visits += 1
    return visits


def search(rows: DataFrame, is_query: Column, k: int = 20, block: int = BLOCK, part: int = PART) -> DataFrame:
    """``(query_id, rank, vec_id, score)`` for the rows of ``valid_vectors`` that are queries, against all of them.

    Vectors of different lengths have no inner product: each length has a tree and
    a search of its own, so no row is left out.
    """
    size = F.size("v")
    lengths = [r.n for r in rows.groupBy(size.alias("n")).count().orderBy("n").collect()]  # one row per length
    if len(lengths) < 2:
        return _search(rows, is_query, k, block, part)
    rows = cut_lineage(rows)
    return reduce(DataFrame.unionByName, [_search(rows.where(size == n), is_query, k, block, part) for n in lengths])


def _search(rows: DataFrame, is_query: Column, k: int, block: int, part: int) -> DataFrame:
    spark = rows.sparkSession
    tree, index = build(rows)
    tree.form_groups(block)
    queries = index.where(is_query)
    visits = calibrate(tree, index, queries.select("vec_id", "v"), k)
    shared = spark.sparkContext.broadcast(tree)

    def walk(batches):
        for batch in batches:
            row, group, leaves = [], [], []
            for i, q in enumerate(_matrix(batch.column("v"))):
                own: dict[int, list[int]] = {}
                for leaf in shared.value.visit(q, visits, k + 1):
                    own.setdefault(int(shared.value.group[leaf]), []).append(leaf)
                row += [i] * len(own)
                group += own.keys()
                leaves += own.values()
            at = pa.array(row, pa.int32())
            yield pa.record_batch({"group": pa.array(group, pa.int32()), "leaves": pa.array(leaves, pa.list_(pa.int32())), "vec_id": batch.column("vec_id").take(at), "v": batch.column("v").take(at)})

    asked = cut_lineage(queries.select("vec_id", "v").mapInArrow(walk, "group int, leaves array<int>, vec_id long, v array<double>"))
    # numbers of pieces: one row per group, at most one group per leaf
    group_of = F.broadcast(spark.createDataFrame([(i, int(g)) for i, g in enumerate(tree.group)], "leaf int, group int"))
    held = np.bincount(tree.group, tree.rows, int(tree.group.max(initial=0)) + 1)
    blocks = spark.createDataFrame([(g, max(1, -(-int(n) // block))) for g, n in enumerate(held.tolist())], "group int, blocks long")
    parts = asked.groupBy("group").agg(F.ceil(F.count("*") / F.lit(part)).alias("parts"))
    cut = F.broadcast(blocks.join(parts, "group"))

    def every(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))

    left = asked.join(cut, "group").withColumn("part", F.pmod(F.xxhash64("vec_id"), F.col("parts"))).withColumn("block", every("blocks"))
    right = index.join(group_of, "leaf").join(cut, "group").withColumn("block", F.pmod(F.xxhash64("vec_id"), F.col("blocks"))).withColumn("part", every("parts"))
    keys = ["group", "block", "part"]

    def score(q: pa.Table, x: pa.Table) -> pa.Table:
        if not q.num_rows or not x.num_rows:
            return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        own, leaf = q.column("vec_id").to_numpy(), x.column("leaf").to_numpy()
        asked_leaves = q.column("leaves").combine_chunks()
        low = min(int(leaf.min()), int(pc.min(asked_leaves.flatten()).as_py()))
        visited = np.zeros((q.num_rows, max(int(leaf.max()), int(pc.max(asked_leaves.flatten()).as_py())) - low + 1), bool)
        visited[asked_leaves.value_parent_indices().to_numpy(), asked_leaves.flatten().to_numpy() - low] = True
        at, found, value = nearest(own, _matrix(q.column("v")), x.column("vec_id").to_numpy(), _matrix(x.column("v")), k, leaf - low, visited)
        return pa.table({"query_id": own[at], "vec_id": found, "score": value})

    left, right = left.select(*keys, "vec_id", "v", "leaves"), right.select(*keys, "vec_id", "v", "leaf")
    return _best(left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(score, "query_id long, vec_id long, score double"), k)


def op6_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of each row of ``embeddings`` whose vec_id is divisible by 20."""
    return search(valid_vectors(table(spark, sf_dir, "embeddings")), F.col("vec_id") % 20 == 0)
