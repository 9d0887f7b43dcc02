"""MinHash near-dedup by an inverted join over signature coordinates.

1. Every text becomes the set of its 5-word shingles (64-bit hashes) and a MinHash
   signature. Equal sets are one class, so copies take part once.
2. A class is posted under its (coordinate, value) pairs. Two sets that share T of
   K coordinates share one among the first K - T + 1, so only this prefix is posted.
3. Classes of a list are compared with a few centres of the list, the best matches
   are confirmed on the full sets, and what is linked becomes one component.
4. Then the lists that still hold several components are merged: all classes
   outside a list's largest component are counted against the whole list. A list
   with too many of them is first cut by a second shared coordinate, then a third
   and so on, which skips pairs that share too little. Pairs with enough matching
   coordinates are confirmed on the full sets in the same task, and only links that
   join components leave it, so a crowd of similar texts is never listed by pairs.

Every link between components is looked for, and a pair drops out only for one of
three reasons: it is inside a component already, it matches in too few coordinates,
or its full sets are too different. At a similarity of 0.75 fewer than 20 of 48
coordinates match for 1 pair in 10 million, fewer than 68 of 128 for 1 in 50 million.

Null and empty texts and texts without words have empty sets and link with
nothing. A null doc_id ranks after all others. Rows with one doc_id are judged
each by its own text; repeated rows are copies. Empty tables give empty results.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ridgeline.llm.common import NO_ID, ODD, U64, arrow_map, components, documents, keep_rows, mix, ngram_hashes, text_key, word_hashes, write_step

#: Posted coordinates and the matches among them that a pair must have.
POSTED, LEAST_POSTED = 48, 20
#: All coordinates and the matches that a pair must have before full sets are read.
ALL, LEAST_ALL = 128, 68
#: Classes of a list that one task compares. A longer list is dealt into chunks, or cut by a further
#: coordinate if more classes than this lie outside its largest component.
LIST = 8192
_A = mix(ODD[:ALL] * U64(0x9E3779B97F4A7C15)) | U64(1)
_B = mix(_A)


def shingle_sets(texts: list[str | None], words: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    hashes, starts = word_hashes(texts, lower=True)
    grams = ngram_hashes(hashes, words)
    out = []
    for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
        if b - a >= words:
            out.append(np.unique(grams[a : b - words + 1]))
        elif b > a:
            out.append(mix(ngram_hashes(hashes[a:b], b - a) + U64(b - a)))
        else:
            out.append(np.zeros(0, U64))
    return out


def signature(values: np.ndarray) -> np.ndarray:
    """The least 32-bit hash of a non-empty set under each of ``ALL`` functions."""
    out = np.full(ALL, np.iinfo(U64).max, U64)
    for start in range(0, len(values), 2048):
        part = values[start : start + 2048]
        np.minimum(out, (part[None, :] * _A[:, None] + _B[:, None]).min(axis=1), out=out)
    return (out >> U64(32)).astype(np.uint32)


def sketches(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, n_shingles, set_key, posted coordinates, all coordinates (those not posted in 16 bits each), text_key."""

    def each(batch: pa.RecordBatch) -> dict[str, object]:
        sets = shingle_sets(batch.column(1).to_pylist(), words)
        signs = [signature(s) if len(s) else None for s in sets]
        return {
            "doc_id": batch.column(0),
            "n_shingles": [len(s) for s in sets],
            "set_key": [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets],
            "posted": [None if g is None else g[:POSTED].view(np.int32) for g in signs],
            "text_key": batch.column(2),
            "coordinates": [None if g is None else g[:POSTED].tobytes() + g[POSTED:].astype(np.uint16).tobytes() for g in signs],
        }

    schema = "doc_id long, n_shingles long, set_key binary, posted array<int>, coordinates binary, text_key long"
    return arrow_map(documents(docs, text_key().alias("text_key")), each, schema)


def _coordinates(packed: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Posted and other coordinates of each class."""
    rows = np.frombuffer(b"".join(packed), np.uint8).reshape(len(packed), -1)
    return rows[:, : 4 * POSTED].copy().view(np.uint32), rows[:, 4 * POSTED :].copy().view(np.uint16)


def _matches(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs (a, b) with enough matching coordinates, and how many."""
    own = nodes.select("node", "coordinates")
    both = pairs.join(own.toDF("a", "ca"), "a").join(own.toDF("b", "cb"), "b")

    def run(batches):
        for t in batches:
            if t.num_rows:
                (pa_, ra), (pb, rb) = _coordinates(t.column("ca").to_pylist()), _coordinates(t.column("cb").to_pylist())
                n = (pa_ == pb).sum(axis=1) + (ra == rb).sum(axis=1)
                keep = pa.array(n >= LEAST_ALL)
                yield pa.RecordBatch.from_arrays([t.column("a").filter(keep), t.column("b").filter(keep), pa.array(n, pa.int32()).filter(keep)], ["a", "b", "n"])

    return both.mapInArrow(run, "a long, b long, n int")


def _sets(docs: DataFrame, nodes: DataFrame, words: int) -> DataFrame:
    """(node, set) of the given nodes (node, doc_id, set_key), from the texts."""
    texts = documents(docs).withColumn("id", F.coalesce("doc_id", F.lit(NO_ID)))
    texts = texts.join(nodes.select(F.col("doc_id").alias("id"), "node", "set_key"), "id")

    def each(batch: pa.RecordBatch) -> dict[str, object]:
        sets = [s.tobytes() for s in shingle_sets(batch.column("text").to_pylist(), words)]
        keys = [hashlib.blake2b(s, digest_size=16).digest() for s in sets]
        right = pa.array([k == own for k, own in zip(keys, batch.column("set_key").to_pylist(), strict=True)])
        return {"node": batch.column("node").filter(right), "set": pa.array(sets, pa.binary()).filter(right)}

    return arrow_map(texts.select("node", "text", "set_key"), each, "node long, set binary")


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets are similar enough."""
    both = pairs.join(sets.toDF("a", "sa"), "a").join(sets.toDF("b", "sb"), "b")

    def run(batches):
        for t in batches:
            keep = []
            for x, y in zip(t.column("sa").to_pylist(), t.column("sb").to_pylist(), strict=True):
                inside = len(np.intersect1d(np.frombuffer(x, U64), np.frombuffer(y, U64), assume_unique=True))
                keep.append(100 * inside >= percent * ((len(x) + len(y)) // 8 - inside))
            yield pa.RecordBatch.from_arrays([t.column("a").filter(pa.array(keep, pa.bool_())), t.column("b").filter(pa.array(keep, pa.bool_()))], ["a", "b"])

    return both.select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long")


def _centre_pairs(postings: DataFrame) -> DataFrame:
    """Each class of a list with three centres of the list: the least, the greatest and one by hash."""
    lists = postings.groupBy("key").agg(
        F.min("node").alias("x"), F.max("node").alias("y"), F.min_by("node", F.xxhash64("node")).alias("z"), F.count("*").alias("size")
    ).filter("size > 1")
    pairs = postings.join(lists, "key").select("node", F.explode(F.array_distinct(F.array("x", "y", "z"))).alias("centre")).filter("node <> centre")
    return pairs.select(F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b")).distinct()


def _lists(postings: DataFrame) -> DataFrame:
    """The postings (key, at, path, node, root) of lists with several components, with the list's size, its largest component and that one's size."""
    counts = postings.groupBy("key", "root").agg(F.count("*").alias("n"))
    lists = counts.groupBy("key").agg(F.sum("n").alias("size"), F.max("n").alias("most"), F.max_by("root", "n").alias("major"), F.count("*").alias("roots"))
    return postings.join(lists.filter("roots > 1").drop("roots"), "key")


def _mixed_lists(postings: DataFrame, nodes: DataFrame) -> DataFrame:
    """Classes (list, at, path, node, root, asks, told) of all lists that could join components, each list short enough for a task.

    All but the largest component of a list ask, and all are told. A long list is
    dealt into chunks, and those that ask go to each of them. If too many ask, the
    list is cut by the next coordinate that classes share, as often as it takes.
    """
    found, depth = None, 1
    while True:
        mixed = write_step(_lists(postings), "lists")
        crowded = F.lit(depth < LEAST_POSTED) & (F.col("size") > LIST) & (F.col("size") - F.col("most") > LIST)
        chunks = F.ceil(F.col("size") / F.lit(LIST)).cast("int")
        few = F.col("root") != F.col("major")
        own = F.struct(F.pmod(F.xxhash64("node"), chunks).cast("int").alias("chunk"), ((chunks == 1) & few).alias("asks"), F.lit(True).alias("told"))
        ask = F.transform(F.sequence(F.lit(0), chunks - 1), lambda c: F.struct(c.alias("chunk"), F.lit(True).alias("asks"), F.lit(False).alias("told")))
        rows = mixed.filter(~crowded).withColumn("x", F.explode(F.when((chunks > 1) & few, F.concat(F.array(own), ask)).otherwise(F.array(own))))
        rows = rows.select(F.xxhash64("key", "x.chunk").alias("list"), "at", "path", "node", "root", "x.asks", "x.told")
        found = rows if found is None else found.union(rows)
        postings = mixed.filter(crowded)
        if postings.isEmpty():
            return found
        # A pair's next shared coordinate lies at most here, or too few are left.
        last = POSTED - LEAST_POSTED + depth
        longer = postings.join(nodes.select("node", "posted"), "node").select("key", "path", "at", "node", "root", F.posexplode(F.slice("posted", 1, last + 1)).alias("c", "v"))
        path = F.col("path").bitwiseOR(F.expr("shiftleft(1L, c)"))
        postings = longer.filter("c > at").select(F.xxhash64("key", "c", "v").alias("key"), F.col("c").alias("at"), path.alias("path"), "node", "root")
        depth += 1


def _by_list(rows: DataFrame, each, schema: str) -> DataFrame:
    """Call ``each`` with the rows of some whole lists at a time; a list is in one task, in one piece."""

    def run(batches):
        held = None
        for t in batches:
            held = t if held is None else pa.concat_batches([held, t])
            key = held.column("list").to_numpy()
            cut = int(np.searchsorted(key, key[-1])) if len(key) else 0
            if cut:
                yield each(held.slice(0, cut))
                held = held.slice(cut)
        if held is not None and held.num_rows:
            yield each(held)

    return rows.repartition("list").sortWithinPartitions("list").mapInArrow(run, schema)


def _candidates(t: pa.RecordBatch):
    """For each class that asks: its place, and the places of the classes of other components to confirm it with.

    A pair that shares several lists is taken up in the one that its first shared
    coordinates lead to.
    """
    key, root = t.column("list").to_numpy(), t.column("root").to_numpy()
    asks, told = (t.column(c).to_numpy(zero_copy_only=False) for c in ("asks", "told"))
    at, path = t.column("at").to_numpy(), t.column("path").to_numpy()
    posted, rest = _coordinates(t.column("coordinates").to_pylist())
    bit = np.int64(1) << np.arange(POSTED, dtype=np.int64)
    begin = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    for a, b in zip(begin.tolist(), [*begin[1:].tolist(), len(key)], strict=True):
        listed = a + np.flatnonzero(told[a:b])
        before = int(at[a]) + 1
        for i in (a + np.flatnonzero(asks[a:b])).tolist():
            j = listed[root[listed] != root[i]]
            # Of two that ask one does, where both are told.
            j = j[~(asks[j] & told[i]) | (j > i)]
            same = posted[j] == posted[i]
            good = (same[:, :before] @ bit[:before]) == path[a]
            j, same = j[good], same[good]
            n = same.sum(axis=1)
            far = n + rest.shape[1] >= LEAST_ALL
            j, n = j[far], n[far]
            n = n + (rest[j] == rest[i]).sum(axis=1)
            if (n >= LEAST_ALL).any():
                yield i, j[n >= LEAST_ALL]


def _joined(t: pa.RecordBatch, percent: int) -> list[tuple[int, int]]:
    """Confirmed pairs of some lists that join components not joined so far here."""
    node, root, raw = t.column("node").to_numpy(), t.column("root").to_numpy(), t.column("set").to_pylist()
    sizes = np.array([len(x) // 8 for x in raw])
    starts = np.cumsum(sizes) - sizes
    known, flat = np.unique(np.frombuffer(b"".join(raw), U64), return_inverse=True)
    mark, parent, out = np.zeros(len(known), bool), {}, []

    def top(x: int) -> int:
        while parent.get(x, x) != x:
            x = parent[x] = parent.get(parent[x], parent[x])
        return x

    for i, found in _candidates(t):
        own = flat[starts[i] : starts[i] + sizes[i]]
        mark[own] = True
        for s in range(0, len(found), 256):
            j = found[s : s + 256]
            n = sizes[j]
            first = np.cumsum(n) - n
            shared = np.add.reduceat(mark[flat[np.repeat(starts[j] - first, n) + np.arange(n.sum())]].astype(np.int64), first)
            for k in j[100 * shared >= percent * (sizes[i] + n - shared)].tolist():
                x, y = top(int(root[i])), top(int(root[k]))
                if x != y:
                    parent[x] = y
                    out.append((int(node[i]), int(node[k])))
        mark[own] = False
    return out


def _cross_links(lists: DataFrame, nodes: DataFrame, sets_of, percent: int) -> DataFrame:
    """Links (a, b) that join all components between which a pair of some list is similar enough."""
    rows = write_step(lists, "mixed")
    coordinates = nodes.select("node", "coordinates")

    def need(t: pa.RecordBatch) -> pa.RecordBatch:
        used = np.zeros(t.num_rows, bool)
        for i, found in _candidates(t):
            used[i] = used[found] = True
        return pa.RecordBatch.from_arrays([t.column(c).filter(pa.array(used)) for c in rows_kept], rows_kept)

    def confirm(t: pa.RecordBatch) -> pa.RecordBatch:
        found = np.array(_joined(t, percent), np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], ["a", "b"])

    rows_kept = ["list", "at", "path", "node", "root", "asks", "told"]
    schema = "list long, at int, path long, node long, root long, asks boolean, told boolean"
    needed = write_step(_by_list(rows.join(coordinates, "node").select(*rows_kept, "coordinates"), need, schema), "needed")
    sets = sets_of(needed.select("node").distinct())
    return _by_list(needed.join(coordinates, "node").join(sets, "node").select(*rows_kept, "coordinates", "set"), confirm, "a long, b long")


def _with_roots(nodes: DataFrame, roots: DataFrame, name: str, into: str) -> DataFrame:
    return nodes.join(roots.select(F.col("node").alias(name), F.col("root").alias("_top")), name, "left").withColumn(into, F.coalesce("_top", name)).drop("_top")


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 75) -> DataFrame:
    """One row for each row: doc_id, n_shingles, component_id, kept, text_key.

    ``percent`` is 75 at least: pairs of less similarity match in fewer coordinates than are asked for here.
    """
    if percent < 75:
        raise ValueError("LEAST_POSTED and LEAST_ALL lose pairs below 75 percent")
    rows = write_step(sketches(docs, words).withColumn("row", F.monotonically_increasing_id()), "sketches")
    ids = F.coalesce("doc_id", F.lit(NO_ID))
    classes = rows.filter("n_shingles > 0").groupBy("set_key", "posted", "coordinates").agg(F.min(ids).alias("doc_id"))
    nodes = write_step(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    prefix = nodes.select("node", F.posexplode(F.slice("posted", 1, POSTED - LEAST_POSTED + 1)).alias("at", "value"))
    prefix = prefix.select(F.xxhash64("at", "value").alias("key"), "at", F.expr("shiftleft(1L, at)").alias("path"), "node")
    shared = prefix.groupBy("key").count().filter("count > 1").select("key")
    postings = write_step(prefix.join(shared, "key", "left_semi"), "postings")

    # Centres first: most of a group is joined here.
    near = write_step(_matches(_centre_pairs(postings), nodes), "centre_pairs")
    ends = near.select(F.col("a").alias("x"), "a", "b", "n").union(near.select("b", "a", "b", "n"))
    best = Window.partitionBy("x").orderBy(F.desc("n"), "a", "b")
    first = ends.withColumn("k", F.row_number().over(best)).filter("k <= 2").select("a", "b").distinct()
    first = write_step(first, "first_pairs")

    def sets_of(used: DataFrame) -> DataFrame:
        return write_step(_sets(docs, nodes.select("node", "doc_id", "set_key").join(used, "node", "left_semi"), words), "sets")

    sets = sets_of(first.select(F.col("a").alias("node")).union(first.select("b")).distinct())
    links = write_step(_confirm(first, sets, percent), "links")
    roots = components(links)

    # Then everything that could still join two components.
    lists = _mixed_lists(_with_roots(postings, roots, "node", "root"), nodes)
    more = write_step(_cross_links(lists, nodes, sets_of, percent), "links")
    roots = components(links.union(more))

    classed = _with_roots(nodes.select("node", "doc_id", "set_key"), roots, "node", "root")
    least = classed.groupBy("root").agg(F.min("doc_id").alias("least"))
    decided = write_step(classed.join(least, "root").select("set_key", "root", "least"), "components")
    # One row of a component stays, also where its least doc_id is repeated.
    owners = rows.join(decided, "set_key").filter(ids == F.col("least")).groupBy("root").agg(F.min("row").alias("keep_row"))
    out = rows.join(decided.join(owners, "root"), "set_key", "left")
    alone = F.col("least").isNull()
    return out.select(
        "doc_id",
        "n_shingles",
        F.when(alone, F.col("doc_id")).otherwise(F.nullif("least", F.lit(NO_ID))).alias("component_id"),
        (alone | (F.col("row") == F.col("keep_row"))).alias("kept"),
        "text_key",
    )


def dedup(docs: DataFrame, words: int = 5, percent: int = 75) -> DataFrame:
    """One row of each component, with all its columns; texts without words all stay."""
    return keep_rows(docs, near_duplicates(docs, words, percent))
