"""Best-fit packing of documents into sequences under several capacities at once.

A sequence has three capacities: tokens, documents and attention cost (the sum of
squared lengths). Items go in descending length to the open sequence that takes
them under every capacity and is best by a rule over the residuals, each as a
share of its capacity: the least weighted norm of what would be left (``norm``),
or the greatest weighted product of demand and residual (``dot``).

Texts are tokenized and cut in one pass over the table. Whole pieces fill a
sequence alone. The others are dealt by hash into groups of a bounded number of
items, each packed by one task, so work is even whatever the sources or copies.

Null texts are empty and still have the end token. Repeated rows are packed as
often as they occur. An empty table gives an empty result.
"""

from __future__ import annotations

import json
import re
import zlib
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridgeline.llm.common import arrow_map, documents, write_step

#: Words whose ids a worker remembers, twice over: bounded memory at any vocabulary.
REMEMBERED = 400_000
#: The pre-tokenizer pattern of byte-level BPE (fixed value).
_BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_OTHER_SPACE = re.compile(r"[^\S \n]")


def _ranked(path: str):
    """The same vocabulary for the faster encoder of single words, or None where its rule would differ.

    That encoder merges by the id of the merged token. It gives the same ids if
    the pre-tokenizer is the byte-level one and merges are listed by those ids.
    """
    with open(path, encoding="utf-8") as f:
        told = json.load(f)
    model, before = told["model"], told.get("pre_tokenizer") or {}
    merged = [model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model.get("merges", [])]
    if before.get("type") != "ByteLevel" or before.get("add_prefix_space") or told.get("normalizer") or merged != sorted(set(merged)):
        return None
    import tiktoken

    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(sorted({*range(256)} - {*shown}))}
    special = {t["content"] for t in told.get("added_tokens", [])}
    ranks = {bytes(byte[c] for c in token): i for token, i in model["vocab"].items() if token not in special}
    return tiktoken.Encoding("words", pat_str=_BYTE_LEVEL, mergeable_ranks=ranks, special_tokens={})


class Words:
    """Token ids of texts, by words that the worker remembers.

    The byte-level pre-tokenizer never joins a visible character with a white
    space that follows it, and a blank or line feed before a visible character
    always starts a new piece. So a text may be cut there and each part has the
    ids it has in the whole. Texts with other white space are encoded whole.
    """

    def __init__(self, path: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.words = _ranked(path)
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _encode(self, parts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch(parts, add_special_tokens=False)]

    def _encode_words(self, parts: list[str]) -> list[bytes]:
        if self.words is None:
            return self._encode(parts)
        return [np.array(self.words.encode_ordinary(p), "<u4").tobytes() for p in parts]

    def ids(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        cut = [self._cut(t) for t in texts]
        plain = set().union(*(c for c in cut if c is not None))
        if len(self.new) + len(plain) > REMEMBERED:
            self.old, self.new = self.new, {}
        known, missing = self.new, []
        for w in plain - known.keys():
            if w in self.old:
                known[w] = self.old[w]
            else:
                missing.append(w)
        known.update(zip(missing, self._encode_words([w[1:] if w[0] == "\r" else w if w[0] == "\n" else " " + w for w in missing]), strict=True))
        whole = iter(self._encode([t for t, c in zip(texts, cut, strict=True) if c is None]))
        return [next(whole) if c is None else b"".join([known[w] for w in c]) for c in cut]

    @staticmethod
    def _cut(text: str) -> list[str] | None:
        """Keys of the parts of a text, None if it must stay whole.

        A part after a line feed begins with it, the first part of a text with a
        carriage return (which stands for nothing), any other part follows a blank.
        """
        if not text:
            return []
        if text[0] in " \n" or text[-1] in " \n" or "  " in text or " \n" in text or "\n " in text or "\n\n" in text or _OTHER_SPACE.search(text):
            return None
        parts = text.replace("\n", " \n").split(" ")
        parts[0] = "\r" + parts[0]
        return parts


@lru_cache(maxsize=2)
def _words(path: str) -> Words:
    return Words(path)


def pieces(docs: DataFrame, tokenizer: str, size: int, end_id: int, stretch: Column) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, stretch: texts longer than ``size`` are cut, the first piece takes the remainder."""

    def each(batch: pa.RecordBatch) -> dict[str, object]:
        out: dict[str, list] = {"doc_id": [], "piece": [], "start": [], "length": [], "ids_crc32": [], "stretch": []}
        end = int(end_id).to_bytes(4, "little")
        doc_ids, texts, where = (c.to_pylist() for c in batch.columns)
        for doc, at, ids in zip(doc_ids, where, _words(tokenizer).ids(texts), strict=True):
            ids += end
            total = len(ids) // 4
            first = total - size * ((total - 1) // size)
            for k, (a, b) in enumerate(zip([0, *range(first, total, size)], [*range(first, total, size), total], strict=True)):
                for name, value in zip(out, (doc, k, a, b - a, zlib.crc32(ids[4 * a : 4 * b]), at), strict=True):
                    out[name].append(value)
        return out

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, stretch string"
    return arrow_map(documents(docs, stretch.cast("string").alias("stretch")), each, schema)


def fill(lengths: np.ndarray, capacity: tuple[float, float, float], weights: tuple[float, float, float], rule: str) -> tuple[np.ndarray, np.ndarray]:
    """The sequence and offset of each item of one group (longest first, ties in the order given)."""
    caps, w = np.array(capacity, float), np.array(weights, float)
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    left = np.zeros((3, len(lengths)))  # residual capacities of the open sequences, as shares
    number, used, opened, total = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64), 0, 0
    least = lengths.min() / caps[0] if len(lengths) else 0
    for step, i in enumerate(order):
        need = np.array([lengths[i], 1.0, float(lengths[i]) ** 2]) / caps
        if step % 256 == 255:  # sequences that take nothing more are closed
            keep = np.flatnonzero((left[0, :opened] >= least - 1e-12) & (left[1, :opened] >= 1 / caps[1] - 1e-12))
            for a in (number, used):
                a[: len(keep)] = a[keep]
            left[:, : len(keep)] = left[:, keep]
            opened = len(keep)
        now = left[:, :opened]
        fits = np.flatnonzero((now[0] >= need[0] - 1e-12) & (now[1] >= need[1] - 1e-12) & (now[2] >= need[2] - 1e-12))
        if len(fits):
            rest = now[:, fits]
            score = -(w * need) @ rest if rule == "dot" else w @ (rest - need[:, None]) ** 2
            j = fits[np.argmin(score)]
        else:
            if (need > 1 + 1e-12).any():
                raise ValueError(f"an item of {lengths[i]} tokens exceeds a capacity of an empty sequence")
            j = opened
            number[j], used[j], left[:, j] = total, 0, 1.0
            opened, total = opened + 1, total + 1
        bins[i], offsets[i] = number[j], used[j]
        used[j] += lengths[i]
        left[:, j] -= need
    return bins, offsets


def pack(
    docs: DataFrame,
    tokenizer: str,
    size: int = 1024,
    end_id: int = 2,
    most_documents: float | None = None,
    most_cost: float | None = None,
    weights: tuple[float, float, float] = (1.0, 0.02, 0.02),
    rule: str = "norm",
    group_items: int = 16384,
    stretch: Column | None = None,
) -> DataFrame:
    """Pieces with their sequence_id and offset.

    ``stretch`` orders the texts as a stream: items of neighbouring stretches are
    packed together, in groups of about ``group_items``, and their sequence ids
    ascend with the stream (whole pieces have negative ids). Without it groups are dealt by hash.

    Without limits of their own, documents and cost have the capacities that
    tokens imply (``size`` documents, ``size`` squared), so they never open a
    sequence that tokens alone would not.
    """
    capacity = (float(size), float(most_documents or size), float(most_cost or size * size))
    if capacity[2] < size * size:
        raise ValueError("a whole piece must fit into an empty sequence: most_cost is below size squared")
    found = pieces(docs, tokenizer, size, end_id, F.lit("") if stretch is None else stretch)
    all_pieces = write_step(found.withColumn("row", F.monotonically_increasing_id()), "pieces")
    part = all_pieces.filter(F.col("length") < size)
    if stretch is None:
        part = part.withColumn("group", F.pmod(F.xxhash64("row"), F.lit(max(1, -(-part.count() // group_items)))))
    else:
        # One row for each stretch: a short one joins the next, a long one is dealt by hash to the groups it spans.
        counts = part.groupBy("stretch").agg(F.count("*").alias("n"))
        before = F.sum("n").over(Window.orderBy("stretch")) - F.col("n")
        spans = write_step(counts.select("stretch", F.floor(before / group_items).alias("g"), F.ceil(F.col("n") / group_items).alias("span")), "stretches")
        part = part.join(spans, "stretch").withColumn("group", F.col("g") + F.pmod(F.xxhash64("row"), F.col("span")))
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]

    def one(key: tuple, items: pd.DataFrame) -> pd.DataFrame:
        items = items.sort_values(["length", "row"], ascending=[False, True], kind="stable")
        bins, offsets = fill(items["length"].to_numpy(), capacity, weights, rule)
        return items.assign(sequence_id=key[0] * (1 << 32) + bins, offset=offsets)[columns]

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    packed = part.groupBy("group").applyInPandas(one, schema)
    whole = all_pieces.filter(F.col("length") == size).select(*columns[:5], (-1 - F.col("row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return whole.unionByName(packed)
