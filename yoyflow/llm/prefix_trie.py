"""Operator 13: prefix trie of conversations, rolled up by centroid decomposition.

Every distinct sequence of first d turns is a node, from the textless root
(d = 0).  A node is named by its depth and four sums of 32-bit chunks of
SHA-256 over (position, role, text): sums of a prefix are running sums, so no
task ever holds a whole conversation, and a prefix's parent is its sum without
the last turn.

Subtree totals (``n_leaves``, ``saved_tokens``) come from a centroid
decomposition of the parent edges.  A component is a connected part of the tree
with one top.  Its centroid is the deepest node under which more than half of
the component's weight lies (the weight of a node is its number of members, so
subtree weights are plain sums over conversations and need no rollup to start
with).  In one round, every large component

1. finds its centroid (two partial aggregates by component),
2. tells which nodes lie under it: the node's own conversation is looked up one
   turn below the centroid's depth and must have the centroid as parent there;
   the key found is the top of the node's next component,
3. adds up what lies under the centroid and adds it along the path from the
   centroid to the component's top, whose turns are read off the centroid's
   conversation; the path's weights are lowered by the centroid's,
4. gives the centroid its final totals and goes on with its parts.

Every part weighs at most half, so rounds grow with the logarithm of the table,
not with the length of a conversation.  Components of at most ``SMALL`` nodes
are finished by the same recursion within one task.

Scale: a hot turn or conversation is one node, and nodes are partial aggregates;
running sums split a conversation over as many range partitions as it fills;
joins that meet a hot component are between shuffles, so adaptive execution can
split them.  The ids of a node's ends are joined to text in range partitions and
then hashed in order, piece by piece: SHA-256 itself cannot be split.

Rows without conv_id take no part.  Null turns come first; equal turns go by the
SHA-256 of role and text; repeated rows stay repeated turns.  Null role or text
counts as empty.  Very long texts are only hashed and counted.  An empty table
has no nodes.  Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from yoyflow.llm.common import table
from yoyflow.operators.joins import hashed_join
from yoyflow.session import cut_lineage

SMALL = 512  # nodes of a component that one task finishes
PIECE = 16_384  # ids joined to one piece of text
BLOCK = 20  # conversations that share their first turns with the block's first one
WORD = r"[^\x20\x09-\x0D]+"
CHUNKS = ("s0", "s1", "s2", "s3")


def _key(depth: Column, sums: list[Column]) -> Column:
    return F.unhex(F.md5(F.concat_ws(".", depth, *sums)))


def running(df: DataFrame, group: str, order: list[Column], sums: dict[str, Column]) -> DataFrame:
    """``df`` with, by name, sums over the rows of the group up to each row.

    The rows are dealt by ranges of (group, order), so a group may fill many
    partitions; a range adds what its first group had in earlier ranges (at most
    one row a range, hence the broadcast).
    """
    dealt = df.repartitionByRange(F.col(group), *order).withColumn("_range", F.spark_partition_id())
    dealt = cut_lineage(dealt.withColumns({f"_{n}": c for n, c in sums.items()}))
    upto = Window.partitionBy("_range", group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    parts = dealt.groupBy(group, "_range").agg(*[F.sum(f"_{n}").alias(f"_{n}") for n in sums])
    carry = parts.select(group, "_range", *[F.sum(f"_{n}").over(before).alias(f"_c_{n}") for n in sums]).where(f"_c_{next(iter(sums))} is not null")
    local = dealt.withColumns({n: F.sum(f"_{n}").over(upto) for n in sums})
    out = local.join(F.broadcast(carry), [group, "_range"], "left")
    return out.select(*df.columns, *[(F.col(n) + F.coalesce(f"_c_{n}", F.lit(0))).alias(n) for n in sums])


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id, k (place of the turn from 1), digest of role and text, words of the text."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256).alias("digest"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
    )
    order = [F.col("turn").asc_nulls_first(), F.col("digest").asc()]
    return running(rows, "conv_id", order, {"k": F.lit(1).cast("long")}).drop("turn")


def rebuilt(original: DataFrame) -> DataFrame:
    """conv_id, pos, digest, words of the rebuilt conversations; pos 0 once for each of them."""
    conv = F.col("conv_id")
    convs = original.groupBy("conv_id").agg(F.lit(1).alias("_one")).select(
        "conv_id", (conv - conv % BLOCK).alias("block"), (F.crc32(conv.cast("string").cast("binary")) % 4).alias("h")
    )
    heads = original.where("k <= 3").select(F.col("conv_id").alias("block"), "k", "digest", "words")
    shared = hashed_join(convs, heads, ["block"], "inner").where("k <= h")
    lent = shared.groupBy("conv_id").agg(F.count("*").alias("lent"))
    lent = hashed_join(convs, lent, ["conv_id"]).select("conv_id", "h", F.coalesce("lent", F.lit(0)).alias("lent"))
    own = hashed_join(original, lent, ["conv_id"], "inner").where("k > h")
    out = own.select("conv_id", (F.col("k") - F.col("h") + F.col("lent")).alias("pos"), "digest", "words")
    out = out.unionByName(shared.select("conv_id", F.col("k").alias("pos"), "digest", "words"))
    return out.unionByName(convs.select("conv_id", F.lit(0).cast("long").alias("pos"), F.lit("").alias("digest"), F.lit(0).cast("long").alias("words")))


def members(turns_of: DataFrame) -> DataFrame:
    """One row for each conversation and depth: conv_id, depth, key and parent_key of its node, words, length."""
    mixed = F.sha2(F.concat(F.col("pos").cast("string"), F.lit(":"), F.col("digest")), 256)
    rows = turns_of.withColumn("_mixed", mixed)
    own = {c: F.when(F.col("pos") == 0, F.lit(0)).otherwise(F.conv(F.substring("_mixed", 8 * i + 1, 8), 16, 10).cast("long")) for i, c in enumerate(CHUNKS)}
    rows = rows.select("conv_id", "pos", "words", *[x.cast("long").alias(f"o_{c}") for c, x in own.items()])
    summed = running(rows, "conv_id", [F.col("pos").asc()], {c: F.col(f"o_{c}") for c in CHUNKS})
    length = rows.groupBy("conv_id").agg(F.max("pos").alias("length"))
    pos = F.col("pos")
    return hashed_join(summed, length, ["conv_id"], "inner").select(
        "conv_id",
        pos.alias("depth"),
        _key(pos, [F.col(c) for c in CHUNKS]).alias("key"),
        F.when(pos > 0, _key(pos - 1, [F.col(c) - F.col(f"o_{c}") for c in CHUNKS])).alias("parent_key"),
        "words",
        "length",
    )


def nodes(rows: DataFrame) -> DataFrame:
    """One row a node: key, parent_key, depth, conv_id, n_convs, words, weight under it, n_children, parent_conv_id."""
    own = rows.groupBy("key").agg(
        F.first("parent_key").alias("parent_key"),
        F.first("depth").alias("depth"),
        F.min("conv_id").alias("conv_id"),
        F.count("*").alias("n_convs"),
        F.first("words").alias("words"),
        F.sum(F.col("length") - F.col("depth") + 1).alias("weight"),
    )
    own = cut_lineage(own)
    children = own.where("parent_key is not null").groupBy(F.col("parent_key").alias("key")).agg(F.count("*").alias("n_children"))
    above = own.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    out = hashed_join(own, children, ["key"]).withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    return hashed_join(out, above, [("parent_key", "parent_key")])


def ends(rows: DataFrame) -> DataFrame:
    """key, ends_sha256 of the nodes at which conversations end."""
    last = rows.where("depth = length").select("key", "conv_id")
    dealt = cut_lineage(last.repartitionByRange("key", "conv_id").withColumn("_range", F.spark_partition_id()))
    at = Window.partitionBy("_range", "key").orderBy("conv_id")
    numbered = dealt.withColumn("_piece", F.floor((F.row_number().over(at) - 1) / PIECE))
    ids = F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda x: x.cast("string")), ",")
    pieces = numbered.groupBy("key", "_range", "_piece").agg(ids.alias("ids"))
    pieces = pieces.repartition("key").sortWithinPartitions("key", "_range", "_piece")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            done = []
            for k, text in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                if k == key:
                    state.update(b"," + text.encode())
                    continue
                if key is not None:
                    done.append((key, state.hexdigest()))
                key, state = k, hashlib.sha256(text.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in done], pa.binary()), pa.array([s for _, s in done])], ["key", "ends_sha256"])
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([state.hexdigest()])], ["key", "ends_sha256"])

    return pieces.select("key", "ids").mapInArrow(digest, "key binary, ends_sha256 string")


def subtree_sums(parent: list[int], weight: list[int], values: list[list[int]]) -> list[list[int]]:
    """Subtree sums of each list of ``values`` over a forest, by centroid decomposition.

    ``parent`` holds the place of the parent, which comes before its children, or -1.
    """
    total = [[0] * len(parent) for _ in values]
    label = list(range(len(parent)))  # of each node: the top of its component
    for i, p in enumerate(parent):
        if p >= 0:
            label[i] = label[p]
    by_top: dict[int, list[int]] = {}
    for i, top in enumerate(label):
        by_top.setdefault(top, []).append(i)
    todo = list(by_top.values())
    while todo:
        part = todo.pop()  # in order: parents first
        top, heavy = part[0], {i: weight[i] for i in part}
        for i in reversed(part[1:]):
            heavy[parent[i]] += heavy[i]
        centroid, half = top, heavy[top]
        for i in part:  # the nodes over half form a path down from the top
            if 2 * heavy[i] > half:
                centroid = i
        under: dict[int, list[int]] = {}
        label[centroid] = centroid
        sums = [v[centroid] for v in values]
        rest, below = [], {centroid}
        for i in part:
            if i == centroid:
                continue
            if i > centroid and parent[i] in below:
                below.add(i)
                label[i] = i if parent[i] == centroid else label[parent[i]]
                under.setdefault(label[i], []).append(i)
                sums = [s + v[i] for s, v in zip(sums, values, strict=True)]
            else:
                rest.append(i)
        at = centroid
        while True:  # from the centroid to the top
            for t, s in zip(total, sums, strict=True):
                t[at] += s
            if at == top:
                break
            at = parent[at]
        todo += under.values()
        if rest:
            todo.append(rest)
    return total


_ROLLED = "key binary, n_leaves long, saved_tokens long"


def _finish(active: DataFrame) -> DataFrame:
    """Totals of components that fit one task: dealt by component, parents before children."""
    columns = ["comp", "depth", "key", "parent_key", "weight", "leaf", "saved", "add_leaves", "add_saved"]

    def solve(rows: list[tuple]) -> tuple[list, list, list]:
        place: dict[bytes, int] = {}
        parent = []
        for i, r in enumerate(rows):  # a key belongs to one component, so several can be solved at once
            p = place.get(r[3], -1)
            parent.append(p if p >= 0 and rows[p][0] == r[0] else -1)
            place[r[2]] = i
        leaves, saved = subtree_sums(parent, [r[4] for r in rows], [[r[5] for r in rows], [r[6] for r in rows]])
        return [r[2] for r in rows], [a + r[7] for a, r in zip(leaves, rows, strict=True)], [a + r[8] for a, r in zip(saved, rows, strict=True)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            held += zip(*(batch.column(c).to_pylist() for c in columns), strict=True)
            cut = len(held)
            while cut and held[cut - 1][0] == held[-1][0]:  # the last component may go on in the next batch
                cut -= 1
            if cut:
                ready, held = held[:cut], held[cut:]
                yield _rolled(solve(ready))
        if held:
            yield _rolled(solve(held))

    def _rolled(out: tuple[list, list, list]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(out[0], pa.binary()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64())], ["key", "n_leaves", "saved_tokens"])

    dealt = active.select(columns).repartition("comp").sortWithinPartitions("comp", "depth", "key")
    return dealt.mapInArrow(run, _ROLLED)


def rollup(tree: DataFrame, paths: DataFrame) -> DataFrame:
    """key, n_leaves, saved_tokens of every node.

    tree:  key, parent_key, depth, conv_id, n_convs, words, weight, n_children
    paths: conv_id, depth, key, parent_key of every node on a conversation's way
    """
    paths = paths.select("conv_id", "depth", "key", "parent_key")
    root = F.unhex(F.md5(F.concat_ws(".", F.lit(0), *[F.lit(0)] * len(CHUNKS))))
    active = tree.select(
        root.alias("comp"),
        "key",
        "parent_key",
        "depth",
        "conv_id",
        F.col("n_convs").alias("weight"),
        F.col("weight").alias("heavy"),
        F.when(F.col("n_children") == 0, F.lit(1)).otherwise(F.lit(0)).cast("long").alias("leaf"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved"),
        F.lit(0).cast("long").alias("add_leaves"),
        F.lit(0).cast("long").alias("add_saved"),
    )
    active = cut_lineage(active)
    small, done = [], []
    while True:
        sizes = active.groupBy("comp").agg(F.count("*").alias("_n"), F.max("heavy").alias("_all"), F.min("depth").alias("_top"))
        large = cut_lineage(sizes.where(F.col("_n") > SMALL))
        if not large.limit(1).count():
            small.append(active)
            break
        joined = cut_lineage(hashed_join(active, large, ["comp"]))
        small.append(joined.where("_n is null").select(active.columns))
        inside = joined.where("_n is not null")
        place = F.struct("depth", "key", "conv_id", "heavy")
        centroid = inside.where("2 * heavy > _all").groupBy("comp").agg(F.max(place).alias("_c"), F.first("_top").alias("_top"))
        centroid = cut_lineage(centroid.select("comp", "_top", *[F.col(f"_c.{c}").alias(f"c_{c}") for c in ("depth", "key", "conv_id", "heavy")]))
        inside = hashed_join(inside.drop("_n", "_all", "_top"), centroid.drop("_top", "c_conv_id"), ["comp"], "inner")
        below = paths.select(F.col("conv_id"), (F.col("depth") - 1).alias("c_depth"), F.col("key").alias("_next"), F.col("parent_key").alias("_over"))
        deeper = inside.where("depth > c_depth")
        deeper = hashed_join(deeper, below, ["conv_id", "c_depth"], "inner")
        told = deeper.withColumn("_next", F.when(F.col("_over") == F.col("c_key"), F.col("_next"))).drop("_over")
        told = told.unionByName(inside.where("depth <= c_depth").withColumn("_next", F.lit(None).cast("binary")))
        told = cut_lineage(told.withColumn("_is", F.col("key") == F.col("c_key")))
        sums = told.where("_is or _next is not null").groupBy("comp").agg(F.sum("leaf").alias("_leaves"), F.sum("saved").alias("_saved"))
        above = centroid.where("_top < c_depth").select("comp", "_top", "c_depth", F.col("c_conv_id").alias("conv_id"), F.col("c_heavy").alias("_less"))
        above = hashed_join(above, sums, ["comp"], "inner")
        above = hashed_join(above, paths.drop("parent_key"), ["conv_id"], "inner").where("depth >= _top and depth < c_depth")
        above = above.select("key", "_leaves", "_saved", "_less")
        final = hashed_join(told.where("_is"), sums, ["comp"], "inner")
        done.append(final.select("key", (F.col("add_leaves") + F.col("_leaves")).alias("n_leaves"), (F.col("add_saved") + F.col("_saved")).alias("saved_tokens")))
        parts = told.where("_next is not null").withColumn("comp", F.col("_next")).select(active.columns)
        upper = hashed_join(told.where("not _is and _next is null"), above, ["key"])
        more = {"heavy": F.col("heavy") - F.coalesce("_less", F.lit(0)), "add_leaves": F.col("add_leaves") + F.coalesce("_leaves", F.lit(0)), "add_saved": F.col("add_saved") + F.coalesce("_saved", F.lit(0))}
        active = cut_lineage(parts.unionByName(upper.withColumns(more).select(active.columns)))
    out = small[0]
    for more_small in small[1:]:
        out = out.unionByName(more_small)
    out = _finish(out)
    for one in done:
        out = out.unionByName(one)
    return out


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row a node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    original = cut_lineage(turns(conversations))
    rows = cut_lineage(members(rebuilt(original)))
    tree = cut_lineage(nodes(rows))
    out = hashed_join(tree, rollup(tree, rows), ["key"], "inner")
    out = hashed_join(out, ends(rows), ["key"])
    none = hashlib.sha256(b"").hexdigest()
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))
