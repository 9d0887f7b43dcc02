"""The prefix trie beside a trie of dictionaries."""

import hashlib
import random
import zlib

import pytest

from ridgeline.llm import prefixes

SCHEMA = "conv_id long, turn long, role string, text string, node long, depth int, parent string, size int, top double"


def frame(spark, rows, partitions=3):
    return spark.createDataFrame([(*r, 1, 2, "p", 3, 4.0) for r in rows], SCHEMA).repartition(partitions)


def brute(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [r[2:] for r in sorted(v)] for c, v in own.items()}
    members = {}
    whole = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        base = c - int(c / 100) * 100
        seq = tuple(own.get(c - base, [])[:h] + own[c][h:])
        whole[c] = seq
        for d in range(len(seq) + 1):
            members.setdefault(seq[:d], []).append(c)
    out = []
    kids = {}
    for p in members:
        if p:
            kids.setdefault(p[:-1], []).append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        below = kids.get(p, [])
        leaves[p] = sum(leaves[k] for k in below) if below else 1
        saved[p] = (len(members[p]) - 1) * (len(p[-1][1]) if p else 0) + sum(saved[k] for k in below)
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in m if whole[c] == p))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids.get(p, [])), leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return out


def same(spark, rows, partitions=3, **options):
    got = [tuple(r) for r in prefixes.trie(frame(spark, rows, partitions), **options).collect()]
    key = lambda r: r[:2]
    assert sorted(got, key=key) == sorted(brute(rows), key=key)
    return got


def bush(seed=5, convs=260):
    """Shared first turns, shared whole conversations, odd ids, gaps in blocks, null and repeated turns."""
    rng, rows = random.Random(seed), []
    for c in [*range(-130, -90), *range(0, convs), *range(1000, 1003), 1301, 1399]:
        if c % 7 == 3:
            script = [("user", "hello"), ("assistant", "hi é"), ("user", f"bye {c % 2}")]
        else:
            script = [(rng.choice(["user", "assistant"]), rng.choice(["a", "b", "", "ünï", "long text " * 5])) for _ in range(rng.randint(1, 9))]
        for i, (role, text) in enumerate(script):
            rows.append((c, i if i % 4 else i * 2 - 9 * (i > 0), role if c % 5 else None, text or None))
    rows += [(None, 1, "user", "nobody"), (7, None, "user", "first of all"), (1301, 50, "user", None)]
    rng.shuffle(rows)
    return rows


def test_in_tasks(spark):
    same(spark, bush())


def test_in_rounds(spark, monkeypatch):
    monkeypatch.setattr(prefixes, "REACH", 2)
    monkeypatch.setattr(prefixes, "STRETCH", 2)
    monkeypatch.setattr(prefixes, "PIECE", 3)
    monkeypatch.setattr(prefixes, "TOGETHER", 64)
    same(spark, bush(8, 120), 7, local=60)


def test_long_chain(spark, monkeypatch):
    """One conversation far deeper than the others: rounds halve it."""
    rows = [(4, i, "user", f"t{i % 3}") for i in range(3000)] + [(c, 0, "user", "x") for c in range(5, 9)]
    same(spark, rows, 3, local=700)


def test_hot_keys_are_split(spark, monkeypatch):
    """With few shares every key goes by the sorted join, with many all are broadcast."""
    rows = bush(9, 90)
    for shares in (1, 1 << 40):
        monkeypatch.setattr(prefixes, "SHARES", shares)
        same(spark, rows, 3)


def test_decompose_beside_plain_sums():
    rng = random.Random(1)
    for shape in ("chain", "star", "random"):
        n = 200
        parent = [-1] + [{"chain": i - 1, "star": 0, "random": rng.randrange(i)}[shape] for i in range(1, n)]
        value, weight = [rng.randint(0, 9) for _ in range(n)], [1] * n
        want = list(value)
        for i in range(n - 1, 0, -1):
            want[parent[i]] += want[i]
            weight[parent[i]] += weight[i]
        depth = [0] * n
        for i in range(1, n):
            depth[i] = depth[parent[i]] + 1
        assert prefixes.decompose(parent, weight, [value], [sorted(range(n), key=depth.__getitem__)]) == [want]


def test_turnless_and_single(spark):
    # A conversation whose own turns are all replaced and whose block has no head ends at the root.
    lone = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 >= 1)
    got = same(spark, [(lone, 0, "user", "gone")])
    assert got == [(lone, 0, None, 1, 0, 1, 0, hashlib.sha256(str(lone).encode()).hexdigest())]
    same(spark, [(100, 0, "user", "x" * 100_000), (100, 0, "user", "x" * 100_000), (lone, 9, None, None)])


@pytest.mark.parametrize("rows", [[], [(None, 1, "user", "x")]])
def test_empty(spark, rows):
    assert prefixes.trie(frame(spark, rows)).collect() == []
