"""Operators 8 and 10: round trips, constraints and deviations."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as files
import pytest
from tokenizers import Tokenizer

from ridgeline.llm import mixing, packing

PATH = files.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return t


def test_ids_are_those_of_the_whole_text(tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 500)
    rng = random.Random(1)
    alphabet = " \n\t ab'sé1. 　\x1c\x85\r-the<|endoftext|>漢"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 14))) for _ in range(4000)]
    texts += ["a \nb", "a\nb c", "\n", "", " ", "it's\ndon't 's", "Hello there\nGeneral word. " * 200, "x" * 5000]
    words = packing.Words(PATH)
    got = [i for k in range(0, len(texts), 100) for i in words.ids(texts[k : k + 100])]
    want = [np.array(e.ids, "<u4").tobytes() for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert got == want


def check_sequences(rows, size):
    held = defaultdict(list)
    for r in rows:
        held[r.sequence_id].append((r.offset, r.length))
    for items in held.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at <= size
    return held


def test_round_trip(docs_of, corpus, tokenizer):
    rows = packing.pack(docs_of(corpus), PATH, size=256).collect()
    by_doc = defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
    for i, text in corpus:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        own = sorted(by_doc.pop(i), key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(len(own))) and len(own) == -(-len(ids) // 256)
        assert [r.start for r in own] == [0, *np.cumsum([r.length for r in own])[:-1]] and sum(r.length for r in own) == len(ids)
        assert all(r.length == 256 for r in own[1:])
        for r in own:
            assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes())
    assert not by_doc
    held = check_sequences(rows, 256)
    assert len(held) <= 1.01 * sum(r.length for r in rows) / 256 + 1


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_every_capacity_holds(rule):
    rng = np.random.default_rng(3)
    lengths = rng.integers(1, 1025, 3000)
    caps = (1024.0, 3.0, 700_000.0)
    some = lengths[lengths**2 <= caps[2]]
    bins, offsets = packing.fill(some, caps, (1.0, 0.5, 0.5), rule)
    for b in np.unique(bins):
        own = some[bins == b]
        assert own.sum() <= caps[0] and len(own) <= caps[1] and (own.astype(float) ** 2).sum() <= caps[2]
        assert sorted(offsets[bins == b]) == np.concatenate([[0], np.cumsum(own[np.argsort(offsets[bins == b])])[:-1]]).tolist()
    bins, _ = packing.fill(lengths, (1024.0, 1024.0, 1024.0**2), (1.0, 0.02, 0.02), rule)
    assert len(np.unique(bins)) <= 1.03 * lengths.sum() / 1024 + 1


def test_repeated_rows_groups_and_stretches(spark, docs_of):
    from pyspark.sql import functions as F

    docs = docs_of([(1, "a b c")] * 40 + [(None, None)] * 3)
    rows = packing.pack(docs, PATH, size=16, group_items=7).collect()
    assert len(rows) == 43
    check_sequences(rows, 16)
    docs = docs_of([(i, "word " * (i % 9)) for i in range(200)])
    rows = packing.pack(docs, PATH, size=32, group_items=50, stretch=F.format_string("%03d", F.col("doc_id"))).collect()
    check_sequences(rows, 32)
    group = {r.doc_id: r.sequence_id >> 32 for r in rows if r.sequence_id >= 0}
    assert [group[i] for i in sorted(group)] == sorted(group.values()) and len({*group.values()}) > 2
    with pytest.raises(ValueError, match="most_cost"):
        packing.pack(docs, PATH, size=32, most_cost=10)
    assert packing.pack(docs_of([]), PATH).count() == 0


# Mixing ----------------------------------------------------------------------


@pytest.mark.parametrize("weights", [{"a": 1, "b": 1}, {"a": 5, "b": 3, "c": 2}, {"a": 0.7, "b": 0.2, "c": 0.06, "d": 0.04}, {f"s{i}": i + 1 for i in range(12)}])
def test_schedule_is_pfair(weights):
    k = mixing.whole_weights(weights, 200)
    assert sum(k.values()) == 200
    rows = mixing.schedule(k)
    assert [slot for _, _, slot in rows] == list(range(200))
    done = dict.fromkeys(k, 0)
    for source, block, slot in rows:
        assert block == done[source]
        done[source] += 1
        for s in k:
            assert abs(done[s] - k[s] * (slot + 1) / 200) < 1
    assert done == k


def test_phases_place_all_blocks():
    k = {"a": 5, "b": 3, "c": 2}
    for blocks in ({"a": 100, "b": 7, "c": 1}, {"a": 1, "b": 1, "c": 1}, {"a": 0, "b": 50, "c": 20}, {"b": 9}):
        total, ends = dict.fromkeys(blocks, 0), 0
        for sources, first, periods, slot in mixing.phases(blocks, k):
            assert slot == ends
            ends += periods * sum(k[s] for s in sources)
            for s in sources:
                assert first[s] == total[s]
                total[s] += k[s] * periods
        assert all(total[s] >= n for s, n in blocks.items())


def test_mix(docs_of, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 40)
    rng = random.Random(2)
    rows = [(i, "x" * rng.choice([0, 10, 50, 120])) for i in range(900)] + [(5000, "y" * 3000), (None, None), (None, "z"), (7, "xx"), (7, "xx")]
    weights = {"src0": 0.5, "src1": 0.3, "src2": 0.15}
    docs = docs_of(rows)
    got = mixing.mix(docs, weights, block=500, slots=40).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_chars) for r in got) == sorted((i is None, i or 0, len(t or "")) for i, t in rows)
    at = defaultdict(list)
    for r in got:
        at[r.source_key].append(r)
    for own in at.values():
        own.sort(key=lambda r: (r.before, r.n_chars > 0))
        assert all(a.before + a.n_chars == b.before or a.before == b.before for a, b in zip(own, own[1:]))
        assert all(r.block == r.before // 500 for r in own)
        slots = {r.block: r.slot for r in own}
        assert [slots[b] for b in sorted(slots)] == sorted(slots.values()) and len({*slots.values()}) == len(slots)
    used = defaultdict(set)
    for r in got:
        used[r.slot].add((r.source_key, r.block))
    assert all(len(x) == 1 for x in used.values())
    k = mixing.whole_weights({"other": 0.15} | weights, 40)
    end = max(r.slot for r in got if r.on_target)
    # A long text holds the slots of the blocks it fills, so blocks are counted by their own slots.
    place = {(s, j): slot for s, j, slot in mixing.schedule(k)}
    slot_of = {s: [b // k[s] * 40 + place[s, b % k[s]] for b in range(max(r.block for r in at[s]) + 1)] for s in k}
    assert all(slot_of[s][r.block] == r.slot for s in k for r in at[s] if r.on_target)
    for slot in range(end + 1):
        for s in k:
            assert abs(sum(x <= slot for x in slot_of[s]) - k[s] * (slot + 1) / 40) < 1
    assert mixing.mix(docs_of([]), weights).count() == 0


def test_on_target_ends_with_the_first_source(docs_of):
    """Forty blocks of one source, two of the other: the target holds for as long as both have blocks."""
    rows = [(i * 4, "x" * 10) for i in range(40)] + [(i * 4 + 1, "x" * 10) for i in range(2)]
    got = mixing.mix(docs_of(rows), {"src0": 0.5, "src1": 0.5 - 1e-9}, block=10, slots=60).collect()
    until = mixing.target_slots({"src0": 40, "src1": 2}, mixing.whole_weights({"other": 0.5, "src0": 0.5, "src1": 0.5}, 60))
    assert sorted(r.slot for r in got if r.on_target) == [r for r in sorted(r.slot for r in got) if r < until]
    assert sum(r.on_target for r in got) in (4, 5) and sum(r.on_target and r.source_key == "src1" for r in got) == 2


def test_stream_is_in_order(spark, docs_of):
    weights = {"src0": 0.5, "src1": 0.3, "src2": 0.2}
    docs = docs_of([(i, "x" * (i % 50)) for i in range(400)] + [(3, "xxx"), (None, None)])
    out = mixing.stream(docs, weights, block=100, slots=20)
    assert out.columns == docs.columns
    rows = out.collect()
    assert len(rows) == 402
    slot = {(r.doc_id, r.n_chars): r.slot for r in mixing.mix(docs, weights, block=100, slots=20).collect()}
    order = [slot[r.doc_id, len(r.text or "")] for r in rows]
    assert order == sorted(order)
