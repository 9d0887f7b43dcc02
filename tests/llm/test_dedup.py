"""Operators 5, 6, 7 and 9 beside brute force, and on the cases their docstrings define."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from ridgeline.llm import blocks, common, exact_dedup, minhash, substrings, suffixes
from ridgeline.llm.common import golomb_decode, golomb_encode, ngram_hashes, word_hashes

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def sha(data):
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def components(nodes, links):
    parent = {n: n for n in nodes}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = sorted((top(a), top(b)))
        parent[y] = x
    return {n: top(n) for n in nodes}


@pytest.mark.parametrize("bits", [40, 64])
@pytest.mark.parametrize("n", [0, 1, 2, 1000])
def test_golomb_round_trip(bits, n):
    rng = np.random.default_rng(n)
    values = np.unique(rng.integers(0, 1 << min(bits, 63), n, dtype=np.uint64))
    if n:
        values = np.unique(np.r_[values, np.uint64(0), np.uint64(2**bits - 1)])
    assert (golomb_decode(golomb_encode(values, bits)) == values).all()


def test_word_hashes_see_words_only():
    h, starts = word_hashes(["Aa  b", "", None, "\x0baa\nB ", "aab"], lower=True)
    assert starts.tolist() == [0, 2, 2, 2, 4, 5]
    assert h[0] == h[2] and h[1] == h[3] and len({*h.tolist()}) == 3
    assert len(ngram_hashes(h, 6)) == 0 and len(ngram_hashes(h, 5)) == 1


# Exact dedup -----------------------------------------------------------------


def exact(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((-len(t or ""), i))
    out = {}
    for text, members in groups.items():
        keep = min(members)[1]
        for _, i in members:
            out[i] = (keep, len(members), i == keep, sha(text))
    return out


def test_exact_dedup(docs_of, corpus):
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in exact_dedup.decide(docs_of(corpus)).collect()}
    assert got == exact(corpus)


def test_exact_dedup_repeated_rows_and_null_ids(docs_of):
    rows = [(5, "a b"), (5, "a b"), (None, "ab"), (None, None), (2, ""), (5, "c"), (9, "a  b")]
    docs = docs_of(rows)
    found = exact_dedup.decide(docs).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.kept) for r in found) == Counter(
        [(5, 9, 4, False), (5, 9, 4, False), (None, 9, 4, False), (9, 9, 4, True), (None, 2, 2, False), (2, 2, 2, True), (5, 5, 1, True)]
    )
    kept = exact_dedup.dedup(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == [(2, ""), (5, "c"), (9, "a  b")]
    again = exact_dedup.dedup(docs_of([(1, "x y"), (1, "x y"), (2, "z")])).collect()
    assert sorted((r.doc_id, r.text) for r in again) == [(1, "x y"), (2, "z")]


# Near dedup ------------------------------------------------------------------


def shingles(text, n=5):
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[k : k + n]) for k in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


def near(rows):
    sets = {i: shingles(t) for i, t in rows}
    ids = sorted(sets)
    links = [
        (a, b) for k, a in enumerate(ids) for b in ids[:k]
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    ]
    return {i: (len(sets[i]), c, i == c) for i, c in components(ids, links).items()}


def test_near_dedup(docs_of, corpus):
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(docs_of(corpus)).collect()}
    assert got == near(corpus)


def test_near_dedup_crowd_of_chains(docs_of, monkeypatch):
    """Each text differs a little from the one before it, so few centres see the whole group; lists are cut and chunked."""
    monkeypatch.setattr(minhash, "LIST", 8)
    words = [f"w{i}" for i in range(120)]
    rows = [(1000, " ".join(words))]
    for k in range(60):
        words[(k * 7) % 120] = f"v{k}"
        rows.append((1000 - 3 * k if k % 2 else 1001 + k, " ".join(words)))
    rows += [(5000 + k, " ".join([f"u{k}_{i}" for i in range(40)] + words[20:50])) for k in range(30)]
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(docs_of(rows)).collect()}
    assert got == near(rows)


def test_near_dedup_keeps_one_row(docs_of):
    same = "a b c d e f g h i j"
    docs = docs_of([(3, same), (3, same), (None, same), (3, "p q r s t u"), (4, ""), (None, None), (4, "")])
    kept = minhash.dedup(docs)
    assert kept.columns == docs.columns
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == Counter([(3, same), (3, "p q r s t u"), (4, ""), (4, ""), (None, None)])


# Substrings ------------------------------------------------------------------


def words_removed(rows, n):
    first = {}
    for i, t in sorted(rows, key=lambda r: r[0]):
        w = WORD.findall(t or "")
        for k in range(len(w) - n + 1):
            first.setdefault(tuple(w[k : k + n]), i)
    out = {}
    for i, t in rows:
        w = WORD.findall(t or "")
        gone = set()
        for k in range(len(w) - n + 1):
            if first[tuple(w[k : k + n])] < i:
                gone.update(range(k, k + n))
        out[i] = (len(w), len(gone), sha(" ".join(x for k, x in enumerate(w) if k not in gone)))
    return out


@pytest.mark.parametrize("window, size", [(13, 1 << 23), (13, 2000), (5, 700)])
def test_substrings(docs_of, corpus, monkeypatch, window, size):
    monkeypatch.setattr(blocks, "BLOCK_BYTES", size)
    monkeypatch.setattr(substrings, "OWNER_BYTES", size * 2)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substrings.digest(substrings.dedup(docs_of(corpus), window)).collect()}
    assert got == words_removed(corpus, window)


def test_substrings_same_id_and_null_id(docs_of):
    text = " ".join(f"w{i}" for i in range(20))
    got = Counter((r.doc_id, r.n_removed) for r in substrings.dedup(docs_of([(1, text), (1, text), (None, text), (None, text + " x")])).collect())
    assert got == Counter([(1, 0), (1, 0), (None, 20), (None, 20)])
    with pytest.raises(ValueError, match="odd"):
        substrings.dedup(docs_of([(1, text)]), 12)


# Suffixes --------------------------------------------------------------------


def bytes_removed(rows, n):
    first = {}
    for i, t in sorted(rows, key=lambda r: r[0]):
        b = (t or "").encode()
        for k in range(len(b) - n + 1):
            first.setdefault(b[k : k + n], i)
    out = {}
    for i, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b) + 1, bool)
        for k in range(len(b) - n + 1):
            if first[b[k : k + n]] < i:
                gone[k : k + n] = True
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        out[i] = (len(b), int(gone.sum()), spans, sha(bytes(x for x, g in zip(b, gone) if not g)))
    return out


@pytest.mark.parametrize("span, size", [(50, 1 << 23), (50, 3000), (24, 1000)])
def test_suffixes(docs_of, corpus, monkeypatch, span, size):
    monkeypatch.setattr(blocks, "BLOCK_BYTES", size)
    monkeypatch.setattr(suffixes, "OWNER_BYTES", size * 3)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffixes.digest(suffixes.dedup(docs_of(corpus), span)).collect()}
    assert got == bytes_removed(corpus, span)


def test_suffixes_same_id_and_null_id(docs_of):
    text = "".join(f"{i:04d}" for i in range(30))
    got = Counter((r.doc_id, r.n_removed, r.n_spans) for r in suffixes.dedup(docs_of([(1, text), (1, text), (None, text), (None, "")])).collect())
    assert got == Counter([(1, 0, 0), (1, 0, 0), (None, 120, 1), (None, 0, 0)])


def test_segments_cut_long_texts(monkeypatch):
    """Entries of a text that is scanned in segments cover all its windows."""
    monkeypatch.setattr(suffixes, "SEGMENT", 100)
    rng = np.random.default_rng(1)
    texts = [bytes(rng.integers(97, 100, n).astype(np.uint8)) for n in (0, 49, 50, 51, 777)]
    e = suffixes.Entries(texts, 50)
    seen = Counter((int(t), int(p) + k) for t, p, n in zip(e.text, e.place, e.windows) for k in range(n))
    assert seen == Counter((t, p) for t, x in enumerate(texts) for p in range(max(0, len(x) - 49)))
    text, place, hashes = e.open_windows(texts, np.ones(len(e.text), bool))
    strings = [texts[t][p : p + 50] for t, p in zip(text, place)]
    assert len({*strings}) == len({*hashes.tolist()}) == len({*zip(strings, hashes.tolist())})


def test_family_levels_are_geometric_and_right():
    rng = np.random.default_rng(2)
    n, size = 40, 30
    keys, covers = rng.integers(0, 60, n * size).astype(np.uint64), rng.integers(0, 3, n * size).astype(np.uint64)
    reps = np.repeat(np.arange(n), size)
    family = suffixes.Family(keys, covers, reps)
    numbers = []
    for b in range(n):
        own = np.arange(b * size, (b + 1) * size)
        pair = keys[own] * np.uint64(10) + covers[own]
        batch = own[np.unique(pair, return_index=True)[1]]
        numbers += batch.tolist()
        family.add(batch)
        sizes = [s for s, _ in family.levels]
        assert sizes == sorted(set(sizes), reverse=True) and sum(sizes) == b + 1
    first = {}
    for i in numbers:
        first.setdefault((keys[i], covers[i]), reps[i])
    kinds = defaultdict(set)
    for i in numbers:
        kinds[keys[i]].add(covers[i])
    for i in numbers:
        assert family.late[i] == (first[keys[i], covers[i]] < reps[i])
        if not family.late[i]:
            assert family.other[i] == (len(kinds[keys[i]]) > 1)


@pytest.mark.parametrize("run", [
    exact_dedup.decide, exact_dedup.dedup, minhash.near_duplicates, minhash.dedup, substrings.dedup, suffixes.dedup,
])
def test_empty_tables(docs_of, run):
    assert run(docs_of([])).count() == 0


def test_near_dedup_refuses_similarities_it_would_lose(docs_of):
    for job in (minhash.near_duplicates, minhash.dedup):
        with pytest.raises(ValueError, match="75 percent"):
            job(docs_of([(1, "a b c d e f")]), percent=74)


def thue_morse(n):
    """A word and its complement, alike to any polynomial modulo 2**64."""
    bits = [bin(i).count("1") % 2 for i in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


@pytest.mark.parametrize("size", [64, 1024, 4096])
def test_words_that_polynomials_confuse(docs_of, size):
    one, other = thue_morse(size)
    assert common.word_hashes([one])[0] != common.word_hashes([other])[0]
    rest = " ".join(f"w{i}" for i in range(12))
    rows = [(1, f"{one} {rest}"), (2, f"{other} {rest}"), (3, " ".join([one] * 5)), (4, " ".join([other] * 5))]
    got = {r.doc_id: r.n_removed for r in substrings.dedup(docs_of(rows)).collect()}
    assert got == {1: 0, 2: 0, 3: 0, 4: 0}
    near = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs_of(rows[2:])).collect()}
    assert near == {3: 3, 4: 4}


def test_bytes_that_polynomials_confuse(docs_of):
    """Windows and covers are too short for such a pair, wherever it lies in the text."""
    one, other = thue_morse(2048)
    rows = [(i, "x" * i + w) for i, w in enumerate([one, other, one[3:], "ab" * 40 + other])]
    got = {r.doc_id: (r.n_removed, r.kept_sha256) for r in suffixes.dedup(docs_of(rows)).collect()}
    seen = set()
    for i, text in rows:
        data = text.encode()
        own = [data[a : a + 50] for a in range(len(data) - 49)]
        gone = {b for a, w in enumerate(own) if w in seen for b in range(a, a + 50)}
        seen.update(own)
        kept = bytes(x for b, x in enumerate(data) if b not in gone)
        assert got[i] == (len(gone), hashlib.sha256(kept).hexdigest())
