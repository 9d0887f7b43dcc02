"""Embedding near-dedup: exact threshold pairs by dual traversal of a cover tree.

On unit vectors a cosine of c is a distance of ``sqrt(2 - 2c)``. The tree has
nested levels of halving radii; every node knows the greatest distance from its
centre to a vector below it. A pair of nodes is left out when the distance of
their centres exceeds both covering radii and the threshold together, and counted
as a whole when it stays below the threshold even with both radii.

The top of the tree comes from a bounded sample (``SAMPLE`` vectors) and routes
every vector to a centre; the vectors of a centre are dealt into chunks of about
``CHUNK``. A chunk is one row that holds its own lower levels. Pairs of centres are
pruned first, the chunks of the others meet in pairs of rows, so a crowded centre
is many tasks. Links are counted where they are found and handed on as a spanning
forest of the block, never as all pairs.

Equal vectors are one class and take part once. Vectors that are null, empty or
zero or hold null or non-finite components link with nothing; vectors of different
lengths do not link. Repeated rows are copies of each other. A null vec_id ranks
after all others. Empty tables give empty results, other columns are ignored.
"""

from __future__ import annotations

import hashlib
from math import ceil, sqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgeline.llm.common import NO_ID, components, write_step

#: Vectors that shape the top of the tree, vectors of a chunk, centres of the top at most.
SAMPLE, CHUNK, CENTRES = 4096, 4096, 1024
#: Radii of the levels inside a chunk.
RADII = (1.0, 0.5, 0.25, 0.125)
_SLACK = 1e-9


def _rows(vectors: DataFrame) -> DataFrame:
    """vec_id, key (128-bit digest of the usable vector, else null), dim, vec (its bytes)."""
    kind = dict(vectors.dtypes)["embedding"]
    size = "f4" if kind == "array<float>" else "f8"
    picked = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<float>" if size == "f4" else "array<double>").alias("embedding"))

    def run(batches):
        for t in batches:
            keys, dims, raw = [], [], []
            for v in t.column(1):
                x = None
                if v.is_valid and len(v.values) and not v.values.null_count:
                    x = np.asarray(v.values.to_numpy(zero_copy_only=False), size) + 0.0  # one zero
                    if not np.isfinite(x).all() or not x.any():
                        x = None
                raw.append(None if x is None else x.tobytes())
                dims.append(None if x is None else len(x))
                keys.append(None if x is None else hashlib.blake2b(x.tobytes(), digest_size=16).digest())
            yield pa.RecordBatch.from_arrays([t.column(0), pa.array(keys, pa.binary()), pa.array(dims, pa.int32()), pa.array(raw, pa.binary())], ["vec_id", "key", "dim", "vec"])

    return picked.mapInArrow(run, "vec_id long, key binary, dim int, vec binary").withColumn("size", F.lit(size))


def unit(raw: list[bytes], kind: str) -> np.ndarray:
    x = np.frombuffer(b"".join(raw), kind).reshape(len(raw), -1).astype(float)
    x /= np.abs(x).max(axis=1, keepdims=True)  # squares neither overflow nor vanish
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _gap(cosine: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * cosine))


def net(x: np.ndarray, radius: float) -> tuple[np.ndarray, list[int]]:
    """The node of each vector and the centres of a greedy net: centres lie more than ``radius`` apart."""
    node, centres, rest = np.zeros(len(x), np.int64), [], np.arange(len(x))
    near = 1.0 - radius * radius / 2.0
    while len(rest):
        close = x[rest] @ x[rest[0]] >= near
        close[0] = True
        node[rest[close]] = len(centres)
        centres.append(int(rest[0]))
        rest = rest[~close]
    return node, centres


class Tree:
    """A chunk in the order of its leaves; nodes of each level are ranges of it, nested in those above."""

    def __init__(self, ids: np.ndarray, weights: np.ndarray, x: np.ndarray, starts: list[np.ndarray], centres: list[np.ndarray]):
        self.ids, self.weights, self.x, self.starts, self.centres = ids, weights, x, starts, centres
        self.radii = []
        for s, c in zip(starts, centres, strict=True):
            far = _gap(np.einsum("ij,ij->i", x, x[np.repeat(c, np.diff(s))]))
            self.radii.append(np.maximum.reduceat(far, s[:-1]) if len(x) else far)

    @staticmethod
    def order(x: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
        """The order of the vectors and, for each level, the starts of the nodes and their centres."""
        order = np.arange(len(x))
        bounds, starts, centres = np.array([0, len(x)]), [], []
        for radius in RADII:
            cuts, own = [0], []
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                if b - a == 1:
                    cuts.append(b)
                    own.append(a)
                    continue
                inside = order[a:b]
                node, heads = net(x[inside], radius)
                # A node begins with its centre.
                rank = np.lexsort((np.arange(b - a) != np.array(heads)[node], node))
                order[a:b] = inside[rank]
                sizes = np.bincount(node)
                cuts += (a + np.cumsum(sizes)).tolist()
                own += (a + np.cumsum(sizes) - sizes).tolist()
            bounds = np.array(cuts)
            starts.append(bounds)
            centres.append(np.array(own))
        return order, starts, centres


class Links:
    """Counts of links by vector and a spanning forest of them, of one pair of chunks."""

    def __init__(self, a: Tree, b: Tree, same: bool, cosine: float):
        self.a, self.b, self.same, self.cosine = a, b, same, cosine
        self.reach = sqrt(2.0 - 2.0 * cosine)
        self.na, self.nb = np.zeros(len(a.x), np.int64), np.zeros(len(b.x), np.int64)
        self.edges: list[np.ndarray] = []
        if len(a.x) and len(b.x):
            self._level(0, np.arange(len(a.centres[0])), np.arange(len(b.centres[0])))

    def _edge(self, i: np.ndarray, j: np.ndarray) -> None:
        self.edges.append(np.stack([self.a.ids[i], self.b.ids[j]]))

    def _level(self, level: int, i: np.ndarray, j: np.ndarray) -> None:
        """All pairs of the given nodes of one level, in strips of bounded size."""
        a, b = self.a, self.b
        for s in range(0, len(i), 1024):
            part = i[s : s + 1024]
            cosine = a.x[a.centres[level][part]] @ b.x[b.centres[level][j]].T
            far, radii = _gap(cosine), a.radii[level][part][:, None] + b.radii[level][j][None, :]
            near = np.nonzero(far <= radii + self.reach + _SLACK)
            ni, nj = part[near[0]], j[near[1]]
            sa, sb = np.diff(a.starts[level])[ni], np.diff(b.starts[level])[nj]
            single = (sa == 1) & (sb == 1)
            hit = single & (cosine[near] >= self.cosine)
            self._pairs(a.starts[level][ni[hit]], b.starts[level][nj[hit]])
            whole = ~single & (far[near] + radii[near] <= self.reach - _SLACK)
            small = ~single & ~whole & (sa * sb <= 256)
            self._small(a.starts[level][ni[small]], sa[small], b.starts[level][nj[small]], sb[small])
            for k in np.flatnonzero(~single & ~small):
                self._nodes(level, int(ni[k]), int(nj[k]), bool(whole[k]))

    def _small(self, a0: np.ndarray, sa: np.ndarray, b0: np.ndarray, sb: np.ndarray) -> None:
        """The vectors of many pairs of small nodes at once, in strips of bounded size."""
        for s in range(0, len(a0), 512):
            cut = slice(s, s + 512)
            sizes = sa[cut] * sb[cut]
            pair = np.repeat(np.arange(len(sizes)), sizes)
            at = np.arange(len(pair)) - (np.cumsum(sizes) - sizes)[pair]
            i, j = a0[cut][pair] + at // sb[cut][pair], b0[cut][pair] + at % sb[cut][pair]
            hit = np.einsum("ij,ij->i", self.a.x[i], self.b.x[j]) >= self.cosine
            self._pairs(i[hit], j[hit])

    def _pairs(self, i: np.ndarray, j: np.ndarray) -> None:
        if self.same:
            i, j = i[i != j], j[i != j]
        np.add.at(self.na, i, self.b.weights[j])
        np.add.at(self.nb, j, self.a.weights[i])
        if len(i):
            self._edge(i, j)

    def _nodes(self, level: int, i: int, j: int, whole: bool) -> None:
        a, b = self.a, self.b
        (a0, a1), (b0, b1) = a.starts[level][i : i + 2], b.starts[level][j : j + 2]
        if whole and not (self.same and a0 < b1 and b0 < a1):
            self.na[a0:a1] += b.weights[b0:b1].sum()
            self.nb[b0:b1] += a.weights[a0:a1].sum()
            self._edge(np.arange(a0, a1), np.full(a1 - a0, b0))
            self._edge(np.full(b1 - b0, a0), np.arange(b0, b1))
            return
        if level + 1 < len(RADII):
            ca = np.arange(*np.searchsorted(a.starts[level + 1], (a0, a1)))
            cb = np.arange(*np.searchsorted(b.starts[level + 1], (b0, b1)))
            # Children that hold few vectors each cost more than the vectors themselves.
            if 8 * len(ca) * len(cb) <= (a1 - a0) * (b1 - b0):
                self._level(level + 1, ca, cb)
                return
        for s in range(a0, a1, 1024):
            e = min(s + 1024, a1)
            self._dense(int(s), int(e), int(b0), int(b1))

    def _dense(self, a0: int, a1: int, b0: int, b1: int) -> None:
        linked = self.a.x[a0:a1] @ self.b.x[b0:b1].T >= self.cosine
        if self.same:
            i = np.arange(max(a0, b0), min(a1, b1))
            linked[i - a0, i - b0] = False
        self.na[a0:a1] += linked @ self.b.weights[b0:b1]
        self.nb[b0:b1] += self.a.weights[a0:a1] @ linked
        i, j = np.nonzero(linked)
        if len(i) <= a1 - a0 + b1 - b0:
            if len(i):
                self._edge(a0 + i, b0 + j)
            return
        # Least row label that reaches each row and column; then every one points at that row's own link.
        rows, big = np.arange(a1 - a0), a1 - a0
        while True:
            cols = np.full(b1 - b0, big)
            np.minimum.at(cols, j, rows[i])
            new = rows.copy()
            np.minimum.at(new, i, cols[j])
            if (new == rows).all():
                break
            rows = new
        first = np.full(big, b1 - b0)
        np.minimum.at(first, i, j)
        used = np.flatnonzero(first < b1 - b0)
        heads = cols < big
        # rows -> the column that their root row is linked with; columns -> their root row.
        self._edge(a0 + used, b0 + first[rows[used]])
        self._edge(a0 + cols[heads], b0 + np.flatnonzero(heads))


def _chunk_row(kind: str):
    def build(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        x = unit(rows["vec"].tolist(), kind)
        order, starts, centres = Tree.order(x)
        rows = rows.iloc[order]
        pack = lambda arrays: b"".join(np.asarray([len(s)], np.int32).tobytes() + s.astype(np.int32).tobytes() for s in arrays)
        return pd.DataFrame({
            "chunk": [int(rows["chunk"].iloc[0])], "centre": [int(rows["centre"].iloc[0])],
            "ids": [rows["node"].to_numpy(np.int64).tobytes()], "weights": [rows["weight"].to_numpy(np.int64).tobytes()],
            "vecs": [b"".join(rows["vec"])], "starts": [pack(starts)], "centres": [pack(centres)],
        })

    return build


def _unpack(data: bytes) -> list[np.ndarray]:
    out, flat, at = [], np.frombuffer(data, np.int32), 0
    for _ in RADII:
        out.append(flat[at + 1 : at + 1 + flat[at]].astype(np.int64))
        at += 1 + int(flat[at])
    return out


def _tree(t: dict, side: str, kind: str) -> Tree:
    ids = np.frombuffer(t[f"ids_{side}"], np.int64)
    n = len(ids)
    raw = t[f"vecs_{side}"]
    x = unit([raw[i * len(raw) // n : (i + 1) * len(raw) // n] for i in range(n)], kind)
    return Tree(ids, np.frombuffer(t[f"weights_{side}"], np.int64), x, _unpack(t[f"starts_{side}"]), _unpack(t[f"centres_{side}"]))


def _routed(nodes: DataFrame, kind: str, dim: int, cosine: float) -> tuple[DataFrame, list[tuple[int, int]]]:
    """Classes of one length with the centre they are nearest to, and the pairs of centres that can have links."""
    spark, n = nodes.sparkSession, nodes.count()
    want = min(CENTRES, ceil(n / CHUNK))
    sample = [r["vec"] for r in nodes.orderBy(F.xxhash64("key")).limit(SAMPLE).select("vec").collect()] if want > 1 else [nodes.first()["vec"]]
    x = unit(sample, kind)
    heads, radius = [0], 1.0
    while len(heads) < want and radius > 1e-3:
        heads, radius = net(x, radius)[1], radius / 2
    top = x[heads[:want]]

    def run(batches):
        for t in batches:
            if t.num_rows:
                cosines = unit(t.column("vec").to_pylist(), kind) @ top.T
                best = cosines.argmax(axis=1)
                far = _gap(cosines[np.arange(len(best)), best])
                yield pa.RecordBatch.from_arrays([*(t.column(c) for c in ("node", "weight", "vec")), pa.array(best, pa.int32()), pa.array(far)], ["node", "weight", "vec", "centre", "far"])

    routed = write_step(nodes.select("node", "weight", "vec").mapInArrow(run, "node long, weight long, vec binary, centre int, far double"), "routed")
    # One row for each centre, of which there are at most CENTRES.
    found = {r["centre"]: (r["n"], r["far"]) for r in routed.groupBy("centre").agg(F.count("*").alias("n"), F.max("far").alias("far")).collect()}
    reach, ids = sqrt(2.0 - 2.0 * cosine), sorted(found)
    gaps = _gap(top[ids] @ top[ids].T)
    radii = np.array([found[c][1] for c in ids])
    near = np.argwhere(np.triu(gaps <= radii[:, None] + radii[None, :] + reach + _SLACK))
    parts = spark.createDataFrame([(c, ceil(found[c][0] / CHUNK)) for c in ids], "centre int, parts int")
    routed = routed.join(F.broadcast(parts), "centre").withColumn("chunk", F.col("centre").cast("long") * (1 << 32) + F.pmod(F.xxhash64("node"), F.col("parts")))
    return routed, [(ids[i], ids[j]) for i, j in near]


def _links(nodes: DataFrame, kind: str, dim: int, cosine: float) -> DataFrame:
    """(a, b, n): n links of class a to others where b is null, else a and b are of one component."""
    spark = nodes.sparkSession
    routed, near = _routed(nodes, kind, dim, cosine)
    schema = "chunk long, centre int, ids binary, weights binary, vecs binary, starts binary, centres binary"
    chunks = write_step(routed.groupBy("chunk").applyInPandas(_chunk_row(kind), schema), "chunks")
    names = chunks.select("chunk", "centre")
    pairs = spark.createDataFrame(near, "ca int, cb int")
    pairs = pairs.join(names.toDF("a", "ca"), "ca").join(names.toDF("b", "cb"), "cb").filter("ca <> cb or a <= b")
    # Each chunk stands left in about half of its pairs.
    swap = F.pmod(F.xxhash64("a", "b"), F.lit(2)) == 0
    pairs = pairs.select(F.when(swap, F.col("a")).otherwise(F.col("b")).alias("x"), F.when(swap, F.col("b")).otherwise(F.col("a")).alias("y"))
    side = lambda s: chunks.drop("centre").toDF(s, *(f"{c}_{s}" for c in ("ids", "weights", "vecs", "starts", "centres")))
    both = pairs.join(side("x"), "x").join(side("y"), "y")

    def run(batches):
        for t in batches:
            for row in range(t.num_rows):
                one = {c: t.column(c)[row].as_py() for c in t.schema.names}
                same = one["x"] == one["y"]
                a = _tree(one, "x", kind)
                b = a if same else _tree(one, "y", kind)
                found = Links(a, b, same, cosine)
                sides = [(a.ids, found.na)] if same else [(a.ids, found.na), (b.ids, found.nb)]
                counted = [np.stack([i[n > 0], n[n > 0]]) for i, n in sides]
                counts = np.concatenate(counted, axis=1)
                edges = np.unique(np.concatenate([np.zeros((2, 0), np.int64), *found.edges], axis=1), axis=1)
                nc, ne = counts.shape[1], edges.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([counts[0], edges[0]])), pa.array(np.concatenate([np.zeros(nc, np.int64), edges[1]]), mask=np.arange(nc + ne) < nc), pa.array(np.concatenate([counts[1], np.zeros(ne, np.int64)]))],
                    ["a", "b", "n"],
                )

    return both.select("x", "y", *(f"{c}_{s}" for s in "xy" for c in ("ids", "weights", "vecs", "starts", "centres"))).mapInArrow(run, "a long, b long, n long")


def near_duplicates(vectors: DataFrame, cosine: float = 0.95) -> DataFrame:
    """One row for each row: vec_id, n_links, component_id, kept."""
    rows = write_step(_rows(vectors).withColumn("row", F.monotonically_increasing_id()), "vectors")
    ids = F.coalesce("vec_id", F.lit(NO_ID))
    nodes = rows.filter("key is not null").groupBy("key", "dim", "vec", "size").agg(F.min(ids).alias("least"), F.count("*").alias("weight"))
    nodes = write_step(nodes.withColumn("node", F.monotonically_increasing_id()), "classes")
    found = None
    # One job for each length of vectors, as a rule a single one.
    for kind in nodes.groupBy("dim", "size").count().orderBy("dim").toLocalIterator():
        part = write_step(_links(nodes.filter(F.col("dim") == kind["dim"]), kind["size"], kind["dim"], cosine), "links")
        found = part if found is None else found.union(part)
    if found is None:
        found = rows.sparkSession.createDataFrame([], "a long, b long, n long")
    counts = found.filter("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    roots = components(found.filter("b is not null").select("a", "b"))
    classes = nodes.select("key", "node", "least", "weight").join(counts, "node", "left").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    classes = write_step(classes.withColumn("links", F.col("weight") - 1 + F.coalesce("n", F.lit(0))).select("key", "root", "least", "links"), "counted")
    groups = classes.groupBy("root").agg(F.min("least").alias("first"))
    classes = classes.join(groups, "root").select("key", "root", "links", "first")
    owners = rows.join(classes, "key").filter(ids == F.col("first")).groupBy("root").agg(F.min("row").alias("keep_row"))
    out = rows.drop("vec").join(classes.join(owners, "root"), "key", "left")
    alone = F.col("key").isNull()
    return out.select(
        "vec_id",
        F.coalesce("links", F.lit(0)).alias("n_links"),
        F.when(alone, F.col("vec_id")).otherwise(F.nullif("first", F.lit(NO_ID))).alias("component_id"),
        (alone | (F.col("row") == F.col("keep_row"))).alias("kept"),
    )
