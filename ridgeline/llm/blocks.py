"""Texts in blocks of neighbouring doc_ids, and exchanges of sorted keys between blocks.

A block holds about ``BLOCK_BYTES`` of text and is looked at as a whole by one
task. To learn what other blocks hold, a block sends each owner (a range of keys)
its sorted distinct keys, Golomb-Rice coded, with a few flag bits for each. The owner
answers every block with bitmaps over the keys that it was sent, so neither texts
nor document ids travel with the keys.
"""

from __future__ import annotations

from collections.abc import Callable
from math import ceil

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgeline.llm.common import NO_ID, U64, chunks, free_shuffles, golomb_decode, golomb_encode, write_step

BLOCK_BYTES = 1 << 23
SENT = "blk long, owner int, lo long, hi long, keys binary, flags binary, more binary"
_TEXTS = pa.schema([("id", pa.int64()), ("key", pa.int64()), ("text", pa.large_string())])
BITS = "blk long, owner int, step int, bits binary"


def text_blocks(docs: DataFrame) -> tuple[DataFrame, int]:
    """Written rows (blk, data) of ranges of id, and the bytes of all texts; data holds (id, key, text) of some rows, compressed.

    A null doc_id ranks last. Rows with the same id may lie in several blocks.
    """
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    total = int(rows.select(F.sum(F.octet_length("text"))).first()[0] or 0)
    rows = rows.withColumn("key", F.xxhash64("text")).repartitionByRange(max(1, ceil(total / BLOCK_BYTES)), "id", "key")

    def pack(batches):
        for t in batches:
            for part in chunks(t.select(["id", "key", "text", "blk"])):
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, _TEXTS, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                    out.write_batch(pa.RecordBatch.from_arrays([part.column(c).cast(_TEXTS.field(c).type) for c in _TEXTS.names], schema=_TEXTS))
                yield pa.RecordBatch.from_arrays([part.column("blk").slice(0, 1), pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["blk", "data"])

    blocks = write_step(rows.withColumn("blk", F.spark_partition_id().cast("long")).mapInArrow(pack, "blk long, data binary"), "blocks")
    free_shuffles(docs.sparkSession)
    return blocks, total


def on_blocks(blocks: DataFrame, each: Callable[[int, np.ndarray, list[bytes], list[pa.Table]], pa.Table], schema: str, bits: list[DataFrame]) -> DataFrame:
    """Call ``each`` with blk, the ids of a block (ascending), their UTF-8 texts and the answers of all steps so far, in order."""
    steps = len(bits)

    def run(rows: pa.Table, *answers: pa.Table) -> pa.Table:
        texts = pa.concat_tables([pa.ipc.open_stream(x).read_all() for x in rows.column("data").to_pylist()])
        texts = texts.combine_chunks().sort_by([("id", "ascending"), ("key", "ascending")])
        found = [a.filter(pc.equal(a.column("step"), step)).sort_by("owner") for a in answers for step in range(steps)]
        raw = texts.column("text").combine_chunks().cast(pa.large_binary()).to_pylist()
        return each(rows.column("blk")[0].as_py(), texts.column("id").to_numpy(), raw, found)

    if not bits:
        return blocks.groupBy("blk").applyInArrow(lambda rows: run(rows), schema)
    told = bits[0]
    for b in bits[1:]:
        told = told.unionByName(b)
    # A block without any key has no answers.
    return blocks.groupBy("blk").cogroup(told.groupBy("blk")).applyInArrow(lambda rows, answers: run(rows, answers), schema)


def sent(blk: int, ids: np.ndarray, keys: np.ndarray, width: int, owners: int, flags: np.ndarray, more: np.ndarray | None = None) -> pa.Table:
    """What a block sends: rows of one owner each, for ascending ``width``-bit keys with flag bits (n, k) and ``more`` bytes (n, m)."""
    owner = (keys >> U64(width - 32)) * U64(owners) >> U64(32)
    cuts = np.searchsorted(owner, np.arange(owners + 1, dtype=U64))
    out = []
    for o in np.flatnonzero(np.diff(cuts)).tolist():
        part = slice(cuts[o], cuts[o + 1])
        out.append((blk, o, int(ids[0]), int(ids[-1]), golomb_encode(keys[part], width), np.packbits(flags[part].T, axis=None).tobytes(), b"" if more is None else more[part].tobytes()))
    columns = list(zip(*out, strict=True)) if out else [[]] * 7
    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
    return pa.table([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=[x.split()[0] for x in SENT.split(", ")])


def flag_bits(data: bytes, n: int, kinds: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(data, np.uint8), count=n * kinds).reshape(kinds, n).astype(bool)


def asked(answer: pa.Table, sizes: list[int], kinds: int) -> np.ndarray:
    """The bits (kinds, n) of all keys of a block, owner after owner, as it sent them."""
    parts = [flag_bits(b, n, kinds) for b, n in zip(answer.column("bits").to_pylist(), sizes, strict=True)]
    return np.concatenate(parts, axis=1) if parts else np.zeros((kinds, 0), bool)


def owner_sizes(keys: np.ndarray, width: int, owners: int) -> list[int]:
    """How many keys went to each owner that got any."""
    owner = ((keys >> U64(width - 32)) * U64(owners) >> U64(32)).astype(np.int64)
    n = np.bincount(owner, minlength=1) if len(keys) else np.zeros(0, np.int64)
    return n[n > 0].tolist()


def by_key(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A stable order by key and where each key begins in it."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    return order, np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]]) if len(keys) else np.zeros(0, np.int64)


def edge_flags(ids: np.ndarray, first: np.ndarray) -> np.ndarray:
    """(n, 2): whether the least id of a key is the least or the greatest id of the block."""
    return np.stack([first == ids[0], first == ids[-1]], axis=1)


def stand_in(lo: int, hi: int, flags: np.ndarray) -> np.ndarray:
    """Ids that compare with those of other blocks as the least ids of the keys do (inside: between lo and hi)."""
    return np.where(flags[0], lo, np.where(flags[1], hi, lo + 1))


def earlier(step: int):
    """The owner's answer: whether a key also has a smaller id in another block."""

    def answer(key: tuple, lists: pd.DataFrame) -> pd.DataFrame:
        each = [golomb_decode(x) for x in lists["keys"]]
        ids = [stand_in(lo, hi, flag_bits(f, len(k), 2)) for k, f, lo, hi in zip(each, lists["flags"], lists["lo"], lists["hi"], strict=True)]
        keys, reps = np.concatenate(each), np.concatenate(ids)
        order, begin = by_key(keys)
        least = np.repeat(np.minimum.reduceat(reps[order], begin), np.diff(np.r_[begin, len(keys)]))
        late = np.zeros(len(keys), bool)
        late[order] = least < reps[order]
        parts = np.split(late, np.cumsum([len(k) for k in each])[:-1])
        return pd.DataFrame({"blk": lists["blk"], "owner": lists["owner"], "step": np.int32(step), "bits": [np.packbits(p).tobytes() for p in parts]})

    return answer


def exchange(lists: DataFrame, answer: Callable, name: str) -> DataFrame:
    out = write_step(lists.groupBy("owner").applyInPandas(answer, BITS), name)
    free_shuffles(lists.sparkSession)
    return out
