"""Substring dedup over words by fixed-block anchors.

Every text is a reference: its words are cut into non-overlapping blocks of
``(window + 1) / 2`` words, and any window holds at least one whole block. Blocks
are indexed by a 40-bit hash; every rolling run of that many words of every text
probes the index. A hit that is also in another text is extended: of the windows
around it 64-bit hashes are exchanged, and a window that a smaller doc_id has, too,
is a repeat. Touching windows make up the maximal repeats, whose words are removed.

An owner of keys gets each block's distinct keys once, so a passage that a third
of all texts share is one key from each block. Null texts have no words. A null
doc_id ranks after all others; rows with one doc_id never remove words from each
other. Repeated rows give repeated rows, empty tables empty results.
"""

from __future__ import annotations

import hashlib
from math import ceil

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

from ridgeline.llm.blocks import BITS, SENT, asked, by_key, earlier, edge_flags, exchange, flag_bits, on_blocks, owner_sizes, sent, text_blocks
from ridgeline.llm.common import CHUNK_BYTES, NO_ID, U64, golomb_decode, ngram_hashes, word_hashes

#: Bytes of text whose keys one owner gets, about.
OWNER_BYTES = 12 << 20
_WIDTH = 40


class _Words:
    """The words of a block of texts: hashes, the text of each word and where texts begin and end."""

    def __init__(self, texts: list[bytes]):
        parts, starts, at, k = [], [0], 0, 0
        while k < len(texts):
            end, size = k + 1, len(texts[k])
            while end < len(texts) and size + len(texts[end]) <= CHUNK_BYTES:
                size += len(texts[end])
                end += 1
            hashes, first = word_hashes([t.decode("utf-8", "surrogatepass") for t in texts[k:end]])
            parts.append(hashes)
            starts += (at + first[1:]).tolist()
            at, k = at + len(hashes), end
        self.words = np.concatenate(parts) if parts else np.zeros(0, U64)
        self.starts = np.array(starts)
        sizes = np.diff(self.starts)
        self.text = np.repeat(np.arange(len(texts)), sizes)
        self.begin, self.end = np.repeat(self.starts[:-1], sizes), np.repeat(self.starts[1:], sizes)

    def at(self, n: int) -> np.ndarray:
        """Places where n words of one text begin."""
        places = np.arange(len(self.words))
        return places[places + n <= self.end]


class _Probes:
    """Step 1: the rolling runs of a block by key."""

    def __init__(self, w: _Words, ids: np.ndarray, window: int):
        self.size = (window + 1) // 2
        self.places = w.at(self.size)
        keys = ngram_hashes(w.words, self.size)[self.places] >> U64(64 - _WIDTH)
        self.order, self.begin = by_key(keys)
        self.keys = keys[self.order[self.begin]]
        owner = ids[w.text[self.places]]
        last = self.order[np.r_[self.begin[1:], len(keys)] - 1] if len(keys) else self.order
        several = owner[self.order[self.begin]] != owner[last]
        block = (self.places - w.begin[self.places]) % self.size == 0
        indexed = np.logical_or.reduceat(block[self.order], self.begin) if len(keys) else np.zeros(0, bool)
        self.flags = np.stack([indexed, several], axis=1)

    def hits(self, w: _Words, repeated: np.ndarray) -> np.ndarray:
        """Whether a run that begins at each word hit a block of another text."""
        out = np.zeros(len(w.words) + 1, bool)
        out[self.places[self.order]] = np.repeat(repeated, np.diff(np.r_[self.begin, len(self.order)]))
        return out


class _Windows:
    """Step 2: the windows around hits by key."""

    def __init__(self, w: _Words, ids: np.ndarray, window: int, hits: np.ndarray):
        size = (window + 1) // 2
        sums = np.concatenate([[0], np.cumsum(hits)])
        places = w.at(window)
        self.places = places[sums[places + window - size + 1] > sums[places]]
        keys = ngram_hashes(w.words, window)[self.places] if len(self.places) else np.zeros(0, U64)
        self.order, self.begin = by_key(keys)
        self.keys = keys[self.order[self.begin]]
        self.ids = ids[w.text[self.places]]
        self.first = self.ids[self.order[self.begin]]

    def repeats(self, late: np.ndarray) -> np.ndarray:
        """The places of windows that a smaller id has, too."""
        count = np.diff(np.r_[self.begin, len(self.order)])
        gone = np.zeros(len(self.places), bool)
        gone[self.order] = np.repeat(late, count) | (self.ids[self.order] > np.repeat(self.first, count))
        return self.places[gone]


def _indexed(step: int):
    """The owner's answer of step 1: keys that are a block of some text and occur in several texts or blocks of texts."""

    def answer(key: tuple, lists: pd.DataFrame) -> pd.DataFrame:
        each = [golomb_decode(x) for x in lists["keys"]]
        flags = np.concatenate([flag_bits(f, len(k), 2) for k, f in zip(each, lists["flags"], strict=True)], axis=1)
        keys = np.concatenate(each)
        order, begin = by_key(keys)
        count = np.diff(np.r_[begin, len(keys)])
        hit = np.logical_or.reduceat(flags[0][order], begin) & (np.logical_or.reduceat(flags[1][order], begin) | (count > 1))
        out = np.zeros(len(keys), bool)
        out[order] = np.repeat(hit, count)
        parts = np.split(out, np.cumsum([len(k) for k in each])[:-1])
        return pd.DataFrame({"blk": lists["blk"], "owner": lists["owner"], "step": np.int32(step), "bits": [np.packbits(p).tobytes() for p in parts]})

    return answer


def dedup(docs: DataFrame, window: int = 13) -> DataFrame:
    """One row for each row: doc_id, n_words, n_removed, kept_sha256, and kept_text (the words left, one blank between).

    ``window`` must be odd, so that two blocks of half a window leave no gap.
    """
    if window < 3 or window % 2 == 0:
        raise ValueError("window must be an odd number of words, 3 or more")
    blocks, total = text_blocks(docs)
    owners = max(1, ceil(total / OWNER_BYTES))

    def probe(blk: int, ids: np.ndarray, texts: list[bytes], _: list) -> pa.Table:
        p = _Probes(_Words(texts), ids, window)
        return sent(blk, ids, p.keys, _WIDTH, owners, p.flags)

    def found(ids: np.ndarray, texts: list[bytes], answer: pa.Table) -> tuple[_Words, _Windows]:
        w = _Words(texts)
        p = _Probes(w, ids, window)
        repeated = asked(answer, owner_sizes(p.keys, _WIDTH, owners), 1)[0]
        return w, _Windows(w, ids, window, p.hits(w, repeated))

    def extend(blk: int, ids: np.ndarray, texts: list[bytes], answers: list[pa.Table]) -> pa.Table:
        _, v = found(ids, texts, answers[0])
        return sent(blk, ids, v.keys, 64, owners, edge_flags(ids, v.first))

    def remove(blk: int, ids: np.ndarray, texts: list[bytes], answers: list[pa.Table]) -> pa.Table:
        w, v = found(ids, texts, answers[0])
        places = v.repeats(asked(answers[1], owner_sizes(v.keys, 64, owners), 1)[0])
        depth = np.zeros(len(w.words) + 1, np.int64)
        np.add.at(depth, places, 1)
        np.add.at(depth, places + window, -1)
        gone = np.cumsum(depth[:-1]) > 0
        removed, kept = [], []
        for k, text in enumerate(texts):
            own = gone[w.starts[k] : w.starts[k + 1]]
            words = text.split()
            removed.append(int(own.sum()))
            kept.append(b" ".join([x for x, g in zip(words, own.tolist(), strict=True) if not g] if removed[-1] else words))
        return pa.table({
            "doc_id": pa.array(ids, mask=ids == NO_ID), "n_words": np.diff(w.starts), "n_removed": pa.array(removed, pa.int64()),
            "kept_sha256": [hashlib.sha256(x).hexdigest() for x in kept], "kept_text": [x.decode("utf-8", "surrogatepass") for x in kept],
        })

    one = exchange(on_blocks(blocks, probe, SENT, []), _indexed(0), "probe_bits")
    two = exchange(on_blocks(blocks, extend, SENT, [one]), earlier(1), "window_bits")
    return on_blocks(blocks, remove, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string", [one, two])


def digest(done: DataFrame) -> DataFrame:
    return done.drop("kept_text")
