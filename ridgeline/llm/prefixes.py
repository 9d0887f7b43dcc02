"""Prefix trie of conversations, rolled up by centroid decomposition.

A conversation is rebuilt from the first turns of the head of its block and its
own later turns. Two conversations share a node of depth d if their first d
turns are equal, so a node is named by its smallest member and its depth, and
its ancestors are the nodes on the path of that member: the table of steps
(conversation, depth, node) holds the ancestors of all nodes.

Equal prefixes are found by sums: a turn at a place has a digest of place, role
and text, and a prefix is the sum of the digests of its turns in four limbs,
which running sums give in stretches of ``STRETCH`` turns. No sequence is ever
collected, however long a conversation is.

Totals of subtrees: every component of the forest of parent edges is split at
its centroid, the deepest node under which more than half of its steps lie. The
total of what lies under the centroid is added to the nodes on the path from the
centroid to the top of the component; the centroid is done, its children's parts
and the part above go on. Components halve, so a long chain takes as few rounds
as a bush. Rounds are joins over all components at once while a component has more
than ``LOCAL`` steps; smaller ones are finished in tasks that take many, in
the same way. Joins on keys that may hold a large part of all rows broadcast those
keys, of which there are at most ``SHARES``, and sort the rest.

The digest of a node's ends is one SHA-256, which is sequential by nature: ids are
sorted and written out in pieces by all tasks, and a node's pieces are then only
streamed through the hash.

Defined cases: rows without a conv_id belong to no conversation; null roles and
texts are empty; a null turn comes first; rows of one turn are in order of a
digest of role and text; repeated rows are turns of their own. A conversation
that is rebuilt without turns ends at the root. An empty table has no node, not
even a root. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridgeline.llm.common import write_step
from ridgeline.llm.ranks import placed, ranked

#: Conversations of a block, whose first turns may come from the block's first one; and how many may, at most.
BLOCK, HEAD = 100, 5
#: Turns over which prefixes are summed at a time.
STRETCH = 1024
#: Steps of a component that a task finishes, and steps that go to a task together, as an average.
LOCAL, TOGETHER = 16_384, 131_072
#: Keys that hold this share of all rows are broadcast; there are no more of them.
SHARES = 4096
#: Depths of a path that are joined as one key, and ids in a piece of a node's list.
REACH, PIECE = 4096, 8192

_LIMBS = [f"limb{i}" for i in range(4)]


def join_hot(rows: DataFrame, table: DataFrame, keys: list[str], weight: str, total: int) -> DataFrame:
    """Inner join to ``table`` (one row a key; ``weight``, at least the rows of the key, adds up to ``total`` at most)."""
    heavy = F.col(weight) * SHARES >= F.lit(total)
    few, many = table.filter(heavy), table.filter(~heavy)
    light = rows.join(F.broadcast(few.select(*keys)), keys, "left_anti")
    return rows.join(F.broadcast(few), keys).unionByName(light.join(many, keys))


def _turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    rows = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"),
        F.sha2(whole.cast("binary"), 256).alias("digest"), F.length(text).cast("long").alias("points"),
    )
    return ranked(rows, "conv", [F.col("turn").asc_nulls_first(), F.col("digest"), F.col("points")], "turns")


def head_length() -> Column:
    """How many first turns conversation ``conv`` takes from its block."""
    return (F.crc32(F.col("conv").cast("string").cast("binary")) % (HEAD + 1)).cast("int")


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv, place, digest, points, size) of every rebuilt turn, and (conv, size) of every conversation."""
    turns, spans = _turns(conversations)
    turns = turns.drop("turn")
    first = placed(turns.filter(f"conv % {BLOCK} = 0"), spans, "conv").filter(f"pos < {HEAD}")
    heads = first.groupBy(F.col("conv").alias("block")).agg(F.array_sort(F.collect_list(F.struct("pos", "digest", "points"))).alias("head"))
    convs = spans.select("conv", "size").distinct().withColumn("wanted", head_length()).withColumn("block", F.col("conv") - F.col("conv") % BLOCK)
    convs = convs.join(heads, "block", "left").withColumn("taken", F.least("wanted", F.coalesce(F.size("head"), F.lit(0))))
    own = F.greatest(F.col("size") - F.col("wanted"), F.lit(0))
    convs = write_step(convs.select("conv", "wanted", "taken", F.slice(F.coalesce("head", F.array()), F.lit(1), F.col("taken")).alias("head"), (F.col("taken") + own).alias("total")), "conversations")
    from_head = convs.select("conv", "total", F.inline("head")).select("conv", F.col("pos").alias("place"), "digest", "points", "total")
    spans = spans.join(convs.select(F.col("conv").alias("c"), "wanted", "taken", "total"), F.col("conv") == F.col("c")).drop("c", "size")
    later = placed(turns, spans, "conv").filter("pos >= wanted")
    later = later.select("conv", (F.col("taken") + F.col("pos") - F.col("wanted")).alias("place"), "digest", "points", "total")
    return from_head.union(later), convs.select("conv", "total")


def steps_of(turns: DataFrame) -> DataFrame:
    """(conv, depth, key, points, under): a key for each prefix, and the steps of the conversation from there on."""
    limbs = F.sha2(F.concat(F.col("place").cast("string"), F.lit(":"), F.col("digest")).cast("binary"), 256)
    rows = turns.withColumn("limbs", limbs).withColumn("stretch", F.floor(F.col("place") / STRETCH))
    rows = rows.select("conv", "place", "stretch", "points", "total", *[F.conv(F.substring("limbs", 1 + 8 * i, 8), 16, 10).cast("long").alias(x) for i, x in enumerate(_LIMBS)])
    inside = Window.partitionBy("conv", "stretch").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = rows.filter(f"total > {STRETCH}").groupBy("conv", "stretch").agg(*[F.sum(x).alias(x) for x in _LIMBS])
    ahead = Window.partitionBy("conv").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("conv", "stretch", *[F.coalesce(F.sum(x).over(ahead), F.lit(0)).alias(f"{x}_ahead") for x in _LIMBS])
    rows = rows.select("conv", "stretch", "place", "points", "total", *[F.sum(x).over(inside).alias(x) for x in _LIMBS]).join(sums, ["conv", "stretch"], "left")
    key = F.sha2(F.concat_ws(",", "place", *[F.col(x) + F.coalesce(F.col(f"{x}_ahead"), F.lit(0)) for x in _LIMBS]).cast("binary"), 256)
    return rows.select("conv", (F.col("place") + 1).alias("depth"), F.unhex(F.substring(key, 1, 32)).alias("key"), "points", (F.col("total") - F.col("place")).alias("under"))


# Ends ------------------------------------------------------------------------


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (node, depth, conv) to (node, depth, first, ids): lists of ids as text."""
    for batch in batches:
        node, depth, conv = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
        cut = np.flatnonzero((np.diff(node) != 0) | (np.diff(depth) != 0)) + 1
        cut = np.unique(np.concatenate([cut, np.arange(0, len(node), PIECE)])) if len(node) else cut
        text = [",".join(map(str, conv[a:b].tolist())) for a, b in zip(cut, [*cut[1:], len(node)])]
        yield pa.RecordBatch.from_arrays([pa.array(node[cut]), pa.array(depth[cut]), pa.array(conv[cut]), pa.array(text, pa.string())], names=["node", "depth", "first", "ids"])


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted pieces to (node, depth, ends_sha256), one piece in memory at a time."""
    now, state, out = None, None, ([], [], [])

    def put() -> None:
        if now is not None:
            for column, value in zip(out, (*now, state.hexdigest())):
                column.append(value)

    def batch_of() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.string())], names=["node", "depth", "ends_sha256"])
        for column in out:
            column.clear()
        return batch

    for batch in batches:
        for node, depth, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3).to_pylist()):
            if (node, depth) == now:
                state.update(b",")
            else:
                put()
                now, state = (node, depth), hashlib.sha256()
            state.update(ids.encode())
        yield batch_of()
    put()
    yield batch_of()


def end_digests(ends: DataFrame) -> DataFrame:
    """(node, depth, ends_sha256) of (node, depth, conv)."""
    by = ["node", "depth", "conv"]
    pieces = ends.select(*by).repartitionByRange(*by).sortWithinPartitions(*by).mapInArrow(_pieces, "node long, depth long, first long, ids string")
    pieces = pieces.repartition("node", "depth").sortWithinPartitions("node", "depth", "first")
    return pieces.mapInArrow(_hashes, "node long, depth long, ends_sha256 string")


# Rollup ----------------------------------------------------------------------


def decompose(parent: list[int], weight: list[int], values: list[list[int]], components: list[list[int]]) -> list[list[int]]:
    """Totals of ``values`` over the subtrees of each component: its nodes by ascending depth, ``weight`` of the steps under each.

    The parent of a component's first node is outside of it. Splits at centroids
    until nothing is left; ``weight`` and ``components`` are used up.
    """
    totals, stack = [[0] * len(v) for v in values], components
    while stack:
        part = stack.pop()
        top = part[0]
        whole, centre = weight[top], top
        for v in part:
            if 2 * weight[v] > whole:
                centre = v
        owner, below, above = {centre: centre}, {}, []
        for v in part:
            if v == centre:
                continue
            p = parent[v]
            if p == centre:
                owner[v] = v
                below[v] = [v]
            elif p in owner:
                owner[v] = owner[p]
                below[owner[v]].append(v)
            else:
                above.append(v)
        sums, taken = [sum(value[v] for v in owner) for value in values], weight[centre]
        u = centre
        while True:
            for total, s in zip(totals, sums):
                total[u] += s
            if u == top:
                break
            u = parent[u]
            weight[u] -= taken
        stack.extend(below.values())
        if above:
            stack.append(above)
    return totals


def _finish(table: pa.Table) -> pa.Table:
    """All components of a bucket of tasks: (node, depth, n_leaves, saved_tokens)."""
    node, depth, top, top_depth, weight, up, leaf, saved = (table.column(c).to_pylist() for c in ("node", "depth", "top", "top_depth", "weight", "parent", "leaf", "saved"))
    place = {pair: i for i, pair in enumerate(zip(node, depth))}
    parent = [-1 if (n, d) == (t, k) else place[p, d - 1] for n, d, t, k, p in zip(node, depth, top, top_depth, up)]
    parts: dict[tuple[int, int], list[int]] = {}
    for i in sorted(range(len(node)), key=depth.__getitem__):
        parts.setdefault((top[i], top_depth[i]), []).append(i)
    totals = [table.column("n_leaves").to_pylist(), table.column("saved_tokens").to_pylist()]
    inside = decompose(parent, weight, [leaf, saved], list(parts.values()))
    totals = [[a + b for a, b in zip(x, y)] for x, y in zip(totals, inside)]
    return pa.table({"node": table.column("node"), "depth": table.column("depth"), "n_leaves": pa.array(totals[0], pa.int64()), "saved_tokens": pa.array(totals[1], pa.int64())})


def rollup(nodes: DataFrame, paths: DataFrame, root: int | None, total: int, local: int = LOCAL) -> DataFrame:
    """(node, depth, n_leaves, saved_tokens) of every node: sums of ``leaf`` and ``saved`` over its subtree.

    ``nodes`` (node, depth, parent, weight, leaf, saved) form one tree under (``root``, 0);
    ``paths`` (conv, depth, node) has the nodes on the way of each conversation.
    ``weight`` counts the steps at or under a node, ``total`` those of the root.
    Runs two jobs a round; rounds follow the logarithm of ``total / local``.
    """
    start = {"top": root, "top_depth": 0, "size": total, "n_leaves": 0, "saved_tokens": 0}
    state = nodes.withColumns({name: F.lit(value).cast("long") for name, value in start.items()})
    if total > local:
        state = write_step(state, "components")  # written, so that the first round's keys are columns and no constants
    reach = F.floor(F.col("depth") / REACH).alias("reach")
    paths = paths.select("conv", "depth", "node")
    following = paths.select("conv", (F.col("depth") - 1).alias("depth"), F.col("node").alias("next"))
    ways = write_step(paths.join(following, ["conv", "depth"], "left").select("*", reach), "ways") if total > local else None
    done, small = [], [state.filter(F.col("size") <= local)]
    large = state.filter(F.col("size") > local)
    while not large.isEmpty():
        key = ["top", "top_depth"]
        centres = large.filter(2 * F.col("weight") > F.col("size")).groupBy(*key).agg(F.min(F.struct("weight", "depth", "node")).alias("c"), F.max("size").alias("size"))
        centres = centres.select(*key, "size", F.col("c.weight").alias("c_weight"), F.col("c.depth").alias("c_depth"), F.col("c.node").alias("c_node"))
        centres = write_step(centres, "centroids")
        rows = join_hot(large.drop("size"), centres, key, "size", total).drop("size")
        # Where does the way of each node's conversation pass the centroid's depth? Asked once for each conversation and depth.
        asked = rows.filter("depth >= c_depth and node <> c_node").groupBy("node", "c_depth").agg(F.count("*").alias("n"))
        at = asked.join(ways.select(F.col("conv").alias("node"), F.col("depth").alias("c_depth"), F.col("node").alias("passes"), "next"), ["node", "c_depth"])
        at = write_step(at, "passes")
        # The centroid's own conversation passes it, and goes on to a node of its own.
        own = (F.col("node") == F.col("c_node")) | (F.col("depth") < F.col("c_depth"))
        passed = join_hot(rows.filter(~own), at, ["node", "c_depth"], "n", total).drop("n")
        passed = rows.filter(own).withColumn("passes", F.when(F.col("depth") >= F.col("c_depth"), F.col("c_node"))).withColumn("next", F.col("c_node")).unionByName(passed)
        under = F.coalesce(F.col("passes") == F.col("c_node"), F.lit(False))
        marked = write_step(passed.withColumn("under", under).drop("passes"), "marked")
        sums = marked.filter("under").groupBy(*key).agg(F.sum("leaf").alias("s_leaf"), F.sum("saved").alias("s_saved"))
        split = centres.join(sums, key)
        span = split.withColumn("reach", F.explode(F.sequence(F.floor(F.col("top_depth") / REACH), F.floor(F.col("c_depth") / REACH))))
        way = ways.select(F.col("conv").alias("c_node"), "reach", F.col("depth").alias("at"), F.col("node").alias("on"))
        path = span.join(way, ["c_node", "reach"]).filter("at between top_depth and c_depth")
        path = path.select(F.col("on").alias("node"), F.col("at").alias("depth"), "s_leaf", "s_saved", F.col("c_weight").alias("gone"))
        added = marked.join(path, ["node", "depth"], "left")
        centre = (F.col("node") == F.col("c_node")) & (F.col("depth") == F.col("c_depth"))
        child = F.col("under") & ~centre
        added = added.select(
            "node", "depth", "parent", "leaf", "saved", centre.alias("centre"),
            (F.col("weight") - F.coalesce("gone", F.lit(0))).alias("weight"),
            (F.col("n_leaves") + F.coalesce("s_leaf", F.lit(0))).alias("n_leaves"), (F.col("saved_tokens") + F.coalesce("s_saved", F.lit(0))).alias("saved_tokens"),
            F.when(child, F.col("next")).otherwise(F.col("top")).alias("top"), F.when(child, F.col("c_depth") + 1).otherwise(F.col("top_depth")).alias("top_depth"),
        )
        added = write_step(added, "split")
        done.append(added.filter("centre").select("node", "depth", "n_leaves", "saved_tokens"))
        left = added.filter("not centre").drop("centre")
        # The weight of a component is that of its top.
        sizes = left.filter("node = top and depth = top_depth").select("top", "top_depth", F.col("weight").alias("size"))
        state = write_step(join_hot(left, sizes, key, "size", total), "components")
        small.append(state.filter(F.col("size") <= local))
        large = state.filter(F.col("size") > local)
    rest = small[0]
    for part in small[1:]:
        rest = rest.unionByName(part)
    buckets = max(1, ceil(2 * total / TOGETHER))
    rest = rest.withColumn("bucket", F.pmod(F.xxhash64("top", "top_depth"), F.lit(buckets)))
    out = rest.groupBy("bucket").applyInArrow(_finish, "node long, depth long, n_leaves long, saved_tokens long")
    for part in done:
        out = out.unionByName(part)
    return out


def trie(conversations: DataFrame, local: int = LOCAL) -> DataFrame:
    """One row for each node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    turns, convs = rebuilt(conversations)
    steps = write_step(steps_of(turns), "steps")
    root = convs.agg(F.min("conv").alias("node"), F.count("*").alias("n_convs"), (F.count("*") + F.coalesce(F.sum("total"), F.lit(0))).alias("weight"))
    root = write_step(root, "trie_root")
    first, members, total = root.first()
    nodes = steps.groupBy("depth", "key").agg(F.min("conv").alias("node"), F.count("*").alias("n_convs"), F.sum("under").alias("weight"), F.max("points").alias("points"))
    nodes = write_step(nodes, "prefixes")
    # Each step's node; a prefix that many conversations share is one key.
    paths = join_hot(steps.select("conv", "depth", "key", "under"), nodes.select("depth", "key", "node", "n_convs"), ["depth", "key"], "n_convs", total)
    start = convs.select("conv", F.lit(0).cast("long").alias("depth"), F.lit(first).cast("long").alias("node"), (F.col("total") + 1).alias("under"))
    paths = write_step(paths.select("conv", "depth", "node", "under").union(start), "paths")
    above = paths.select(F.col("conv").alias("node"), (F.col("depth") + 1).alias("depth"), F.col("node").alias("parent"))
    nodes = nodes.drop("key").join(above, ["node", "depth"])
    top = root.filter("node is not null").select("node", F.lit(0).cast("long").alias("depth"), "n_convs", "weight", F.lit(0).cast("long").alias("points"), F.lit(None).cast("long").alias("parent"))
    nodes = nodes.unionByName(top)
    children = nodes.filter("depth > 0").groupBy(F.col("parent").alias("node"), (F.col("depth") - 1).alias("depth")).agg(F.count("*").alias("n_children"))
    nodes = nodes.join(children, ["node", "depth"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
    nodes = nodes.withColumn("leaf", (F.col("n_children") == 0).cast("long")).withColumn("saved", (F.col("n_convs") - 1) * F.col("points"))
    nodes = write_step(nodes, "trie_nodes")
    totals = rollup(nodes.select("node", "depth", "parent", "weight", "leaf", "saved"), paths, first, total, local)
    ends = end_digests(paths.filter("under = 1"))
    out = nodes.join(totals, ["node", "depth"]).join(ends, ["node", "depth"], "left")
    nothing = hashlib.sha256(b"").hexdigest()
    return out.select(
        F.col("node").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"),
    )
