"""Operator 1 beside all pairs."""

import numpy as np
import pytest

from ridgeline.llm import embeddings


def vectors(seed=4):
    rng = np.random.default_rng(seed)
    rows = []
    for g in range(25):
        centre = rng.normal(size=16)
        rows += [centre * rng.uniform(0.1, 9) + rng.normal(size=16) * s for s in (0, 0, 0.1, 0.2, 0.3, 0.5)]
    crowd = rng.normal(size=16)
    rows += [crowd + rng.normal(size=16) * 0.12 for _ in range(150)]
    rows += [rows[3], rows[3], rows[7] * 2]
    return [np.asarray(r, np.float32).tolist() for r in rows]


def expected(rows):
    usable = [i for i, v in rows if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    table = dict(rows)
    links = {i: set() for i, _ in rows}
    for a in usable:
        for b in usable:
            if a != b and len(table[a]) == len(table[b]):
                x, y = (np.asarray(table[k], np.float32).astype(float) for k in (a, b))
                x, y = x / np.abs(x).max(), y / np.abs(y).max()
                if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.95:
                    links[a].add(b)
    label = {i: i for i, _ in rows}
    changed = True
    while changed:
        changed = False
        for a, others in links.items():
            least = min([label[a], *(label[b] for b in others)])
            if least < label[a]:
                label[a], changed = least, True
    return {i: (len(links[i]), label[i], label[i] == i) for i, _ in rows}


@pytest.mark.parametrize("chunk", [4096, 20])
def test_all_links(spark, monkeypatch, chunk):
    monkeypatch.setattr(embeddings, "CHUNK", chunk)
    rows = [(7 * i % 1009, v) for i, v in enumerate(vectors())]
    rows += [(2000, None), (2001, []), (2002, [0.0] * 16), (2003, [None] + [1.0] * 15), (2004, [float("nan")] * 16), (2005, [float("inf")] + [0.0] * 15), (2006, [1e30] * 16),
             (2007, [1e-30] * 16), (2008, [1.0] * 8), (2009, [2.0] * 8)]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id bigint, embedding array<float>, label int, key string").repartition(5)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embeddings.near_duplicates(df).collect()}
    assert got == expected(rows)


def test_repeated_rows_and_null_ids(spark):
    df = spark.createDataFrame([(4, [1.0, 2.0]), (4, [1.0, 2.0]), (None, [1.0, 2.0]), (None, None)], "vec_id bigint, embedding array<double>")
    got = sorted((r.vec_id or -1, r.n_links, r.component_id or -1, r.kept) for r in embeddings.near_duplicates(df).collect())
    assert got == [(-1, 0, -1, True), (-1, 2, 4, False), (4, 2, 4, False), (4, 2, 4, True)]


def test_empty(spark):
    assert embeddings.near_duplicates(spark.createDataFrame([], "vec_id bigint, embedding array<float>")).count() == 0


def test_nodes_are_nested_and_covered():
    x = embeddings.unit([np.asarray(v, np.float32).tobytes() for v in vectors()], "f4")
    order, starts, centres = embeddings.Tree.order(x)
    t = embeddings.Tree(np.arange(len(x)), np.ones(len(x), np.int64), x[order], starts, centres)
    assert sorted(order.tolist()) == list(range(len(x)))
    for level, radius in enumerate(embeddings.RADII):
        assert (t.radii[level] <= radius + 1e-9).all()
        if level:
            assert {*t.starts[level - 1].tolist()} <= {*t.starts[level].tolist()}
