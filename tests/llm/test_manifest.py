"""The Merkle manifest beside a plain rebuild of the tree."""

import hashlib
import zlib

import pytest

from ridgeline.llm import manifest


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def enc(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def up(nodes):
    """Levels of runs until one node is left; (root, proof of each node as a list)."""
    proofs, groups = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        parents, merged = [], []
        for a in range(0, len(nodes), 8):
            run = nodes[a : a + 8]
            for j in range(len(run)):
                for i in groups[a + j]:
                    proofs[i].append((j, run))
            parents.append(h(*run))
            merged.append([i for g in groups[a : a + 8] for i in g])
        nodes, groups = parents, merged
    return nodes[0], proofs


def brute(rows):
    lower = str.maketrans(manifest.UPPER, manifest.LOWER)
    tree = {}
    for doc, source, lang, n, text in rows:
        leaf = h(*map(enc, (doc, source, lang, n, text)))
        held = leaf
        if doc is not None and zlib.crc32(str(doc).encode()) % 3 == 0 and text is not None:
            held = h(*map(enc, (doc, source, lang, n, text.translate(lower))))
        tree.setdefault(lang, []).append((doc, leaf, held))
    langs = sorted(tree, key=lambda x: (x is not None, (x or "").encode()))
    subs = []
    for x in langs:
        tree[x].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        subs.append(up([r[1] for r in tree[x]]))
    root, tops = up([s[0] for s in subs])
    out = []
    for x, (sub, proofs), top in zip(langs, subs, tops):
        for (doc, leaf, held), proof in zip(tree[x], proofs):
            folded, others = held, []
            for j, run in proof + top:
                others += run[:j] + run[j + 1 :]
                folded = h(*run[:j], folded, *run[j + 1 :])
            out.append((doc, leaf, sub, root, h(*others), folded, folded == root))
    return out


def result(spark, rows, partitions=3):
    schema = "doc_id bigint, source string, lang string, n_chars bigint, text string, hash string, tree int, pos int, run string, members int, at double"
    docs = spark.createDataFrame([(*r, "x", 1, 2, "y", 3, 4.0) for r in rows], schema).repartition(partitions)
    built = manifest.build(docs, {"text": manifest.tampered_text()})
    return [tuple(r) for r in manifest.verify(built, docs).collect()]


def same(got, want):
    key = lambda r: tuple("" if v is None else str(v) for v in r)
    assert sorted(got, key=key) == sorted(want, key=key)


def rows_of(n, langs):
    return [(i * 7 % n, f"src{i % 3}", langs[i * i % len(langs)], i if i % 5 else None, f"Text Été {i} " * (i % 4) if i % 6 else None) for i in range(n)]


def test_three_levels_and_nulls(spark):
    rows = rows_of(600, ["en"] * 9 + ["de", None, "fr"])
    rows += [(None, None, None, None, None), (None, "a", "en", 3, "Null Id"), (5, "src0", "en", 1, "again"), rows[7], rows[7], (9_999, "s", "lone", 1, "ONE"), (10_000, "s", "", 2, "")]
    same(result(spark, rows), brute(rows))


def test_sizes_around_a_full_level(spark):
    rows, i = [], 0
    for n in (1, 2, 7, 8, 9, 64, 65):
        for _ in range(n):
            rows.append((i, "s", f"l{n}é", i, f"Row {i}"))
            i += 1
    rows += [(i + j, "s", c, 1, "T") for j, c in enumerate([chr(0x10348), "é", "z", "Z", ""])]
    same(result(spark, rows, 5), brute(rows))


@pytest.mark.parametrize("rows", [[(3, "s", None, 1, "Only")], [(i, "s", "en", 1, "T") for i in range(65)]])
def test_one_language(spark, rows):
    same(result(spark, rows), brute(rows))


def test_each_language_alone(spark):
    rows = [(i, "s", f"l{i}", 1, "T") for i in range(9)]
    same(result(spark, rows), brute(rows))


def test_long_text_and_untouched_claim(spark):
    rows = [(1, "s", "en", 1, "Ab" * 500_000), (2, "s", "en", 1, "x"), (3, "s", "en", 1, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, lang string, n_chars bigint, text string")
    assert all(r["verified"] for r in manifest.verify(manifest.build(docs), docs).collect())


def test_empty(spark):
    assert result(spark, []) == []


def test_no_row_limit(spark):
    """The recursion may return more rows than Spark's guard allows."""
    spark.conf.set("spark.sql.cteRecursionRowLimit", 10)
    try:
        rows = rows_of(300, ["en", "de"])
        same(result(spark, rows), brute(rows))
        assert spark.conf.get("spark.sql.cteRecursionRowLimit") == "10"
    finally:
        spark.conf.unset("spark.sql.cteRecursionRowLimit")
