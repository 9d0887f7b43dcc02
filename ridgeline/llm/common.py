"""Helpers of the training-data operators: Arrow maps over texts, rolling hashes, written steps."""

from __future__ import annotations

import gc
import hashlib
import os
import time
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ridgeline.session import new_path

#: Bytes of text that a task looks at in one go; one longer text is still taken whole.
CHUNK_BYTES = 1 << 21
#: The id that stands for a null doc_id: larger than all others.
NO_ID = (1 << 63) - 1
U64 = np.uint64


def write_step(df: DataFrame, name: str) -> DataFrame:
    """Write a step to the shared folder, read it back, and let Spark drop the shuffles behind it.

    A lost executor costs tasks of the running step only. The tables go to a
    folder of their own under ``spark.checkpoint.dir``.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    return out


def free_shuffles(spark: SparkSession) -> None:
    """Let the driver forget shuffles of written steps now, so that executors delete their files before the next large one."""
    for _ in range(2):
        time.sleep(0.4)  # the listeners still hold the last query
        gc.collect()
        spark.sparkContext._jvm.System.gc()


def documents(docs: DataFrame, *more: str) -> DataFrame:
    """``doc_id`` and ``text`` (null: empty) and the named columns; all others are left behind."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"), *more)


def text_key() -> Column:
    """Tells apart the texts of rows that share a doc_id."""
    return F.xxhash64(F.coalesce("text", F.lit("")))


def unused(columns: list[str], *names: str) -> list[str]:
    """The names, each with underscores in front until no column has it."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def keep_rows(docs: DataFrame, decided: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``decided`` (doc_id, text_key, kept: one row each) keeps, with all their columns.

    Where rows are repeated as a whole, as many of them stay as were kept.
    Columns of any name are left as they are.
    """
    key_id, key, stay_n, rows_n, nth = unused(docs.columns, "_id", "_key", "_stay", "_rows", "_k")
    each = decided.groupBy(F.coalesce("doc_id", F.lit(NO_ID)).alias(key_id), F.col("text_key").alias(key))
    stay = write_step(each.agg(F.sum(F.col("kept").cast("long")).alias(stay_n), F.count("*").alias(rows_n)).filter(F.col(stay_n) > 0), "stay")
    marked = docs.withColumns({key_id: F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)), key: text_key()})
    some = write_step(stay.filter(F.col(stay_n) < F.col(rows_n)), "repeated")
    kept = marked.join(stay.filter(F.col(stay_n) == F.col(rows_n)).select(key_id, key), [key_id, key], "left_semi").select(*docs.columns)
    if some.isEmpty():
        return kept
    picked = marked.join(some, [key_id, key]).withColumn(nth, F.row_number().over(Window.partitionBy(key_id, key).orderBy(F.lit(0))))
    return kept.union(picked.filter(F.col(nth) <= F.col(stay_n)).select(*docs.columns))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shuffle_count(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def chunks(batch: pa.RecordBatch, text: str = "text", most: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``most`` bytes of text each."""
    if not batch.num_rows:
        return
    size = np.cumsum([len(x) if x else 0 for x in batch.column(batch.schema.get_field_index(text)).to_pylist()])
    start = 0
    while start < batch.num_rows:
        before = size[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(size, before + most, side="right")))
        yield batch.slice(start, end - start)
        start = end


def arrow_map(df: DataFrame, each: Callable[[pa.RecordBatch], dict[str, object]], schema: str, most: int = CHUNK_BYTES) -> DataFrame:
    """Apply ``each`` to slices of the batches of ``df``; it returns a column (list or array) for each name of ``schema``."""
    spark = df.sparkSession
    empty = spark.createDataFrame([], schema)
    names = empty.columns
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(empty.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, most=most):
                out = each(part)
                yield pa.RecordBatch.from_arrays([_column(out[n], arrow.field(n).type) for n in names], schema=arrow)

    return df.mapInArrow(run, schema)


def _column(values: object, kind: pa.DataType) -> pa.Array:
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    if isinstance(values, pa.Array):
        return values if values.type == kind else values.cast(kind)
    return pa.array(values, type=kind)


# Hashes ---------------------------------------------------------------------

_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=U64) * U64(2) + U64(1)
_BASE = int(_RNG.integers(1 << 40, 1 << 60)) * 8 + 5
_INVERSE = pow(_BASE, -1, 1 << 64)
ODD = _RNG.integers(1, 1 << 63, 256, dtype=U64) * U64(2) + U64(1)
_POWERS: dict[int, np.ndarray] = {}
#: Word ends of every contract that splits on white space: blank and 0x09 to 0x0D.
SPACE = np.zeros(256, bool)
#: Bytes of a word above which its hash is not the rolling one.
LONG_WORD = 32
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (xor-shift and multiply)."""
    h = h ^ (h >> U64(33))
    h = h * U64(0xFF51AFD7ED558CCD)
    h ^= h >> U64(33)
    h *= U64(0xC4CEB9FE1A85EC53)
    h ^= h >> U64(33)
    return h


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least n + 1 of them."""
    have = _POWERS.get(0)
    if have is None or len(have) <= n:
        size = max(1 << 16, 1 << int(n + 1).bit_length())
        for key, base in ((0, _BASE), (1, _INVERSE)):
            p = np.ones(size, U64)
            done, step = 1, base
            while done < size:
                p[done : 2 * done] = p[:done] * U64(step)
                done, step = 2 * done, step * step % (1 << 64)
            _POWERS[key] = p
    return _POWERS[0], _POWERS[1]


class Rolling:
    """Hashes of any substring of a byte array in constant time (a polynomial modulo 2**64, finalised)."""

    def __init__(self, data: np.ndarray, table: np.ndarray | None = None):
        power, self.inverse = _powers(len(data))
        self.sums = np.zeros(len(data) + 1, U64)
        np.cumsum((_BYTE if table is None else table)[data] * power[: len(data)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.inverse[start] + (end - start).astype(U64) * ODD[255])


def joined(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts with one blank after each, and where each text starts (one more entry: the end)."""
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    starts = np.zeros(len(raw) + 1, np.int64)
    np.cumsum([len(r) + 1 for r in raw], out=starts[1:])
    return np.frombuffer(b" ".join(raw) + b" ", np.uint8), starts


def word_hashes(texts: list[str | None], lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every word (maximal runs without white space) and the first word of each text (one more: the end)."""
    data, starts = joined(texts)
    if lower:
        data = LOWER[data]
    gap = SPACE[data]
    edge = np.diff(gap.astype(np.int8), prepend=1)
    first, last = np.flatnonzero(edge == -1), np.flatnonzero(edge[1:] == 1) + 1
    if len(first) and not len(last):
        last = np.array([len(data)])
    hashes = Rolling(data).of(first, last) if len(first) else np.zeros(0, U64)
    # Long words of two symbols can be built that agree modulo 2**64 whatever the base; these get a real digest.
    for i in np.flatnonzero(last - first > LONG_WORD).tolist():
        hashes[i] = int.from_bytes(hashlib.blake2b(data[first[i] : last[i]].tobytes(), digest_size=8).digest(), "little")
    return hashes, np.searchsorted(first, starts)


def ngram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """A hash of each run of n words; entry i covers words i to i + n - 1."""
    if len(words) < n:
        return np.zeros(0, U64)
    total = np.zeros(len(words) - n + 1, U64)
    for j in range(n):
        total += words[j : len(words) - n + 1 + j] * ODD[j]
    return mix(total)


# Sorted integers, compressed -------------------------------------------------


def golomb_encode(values: np.ndarray, bits: int) -> bytes:
    """Golomb-Rice code of ascending ``bits``-bit integers: unary quotients and fixed remainders, in two streams."""
    n = len(values)
    if not n:
        return b""
    gaps = np.diff(values, prepend=U64(0))
    rest = max(0, bits - int(n).bit_length())
    q = (gaps >> U64(rest)).astype(np.int64)
    stops = np.cumsum(q + 1) - 1
    unary = np.zeros(int(stops[-1]) + 1, np.uint8)
    unary[stops] = 1
    low = np.zeros((n, rest), np.uint8)
    for b in range(rest):
        low[:, b] = (gaps >> U64(b)) & U64(1)
    head, tail = np.packbits(unary).tobytes(), np.packbits(low.ravel()).tobytes()
    return np.array([n, rest, len(unary)], np.int64).tobytes() + head + tail


def golomb_decode(code: bytes) -> np.ndarray:
    if not code:
        return np.zeros(0, U64)
    n, rest, length = (int(x) for x in np.frombuffer(code, np.int64, 3))
    at = 24 + (length + 7) // 8
    stops = np.flatnonzero(np.unpackbits(np.frombuffer(code, np.uint8, at - 24, 24), count=length))
    gaps = (np.diff(stops, prepend=-1) - 1).astype(U64) << U64(rest)
    if rest:
        low = np.unpackbits(np.frombuffer(code, np.uint8, offset=at), count=n * rest).reshape(n, rest)
        for b in range(rest):
            gaps |= low[:, b].astype(U64) << U64(b)
    return np.cumsum(gaps, dtype=U64)


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true entries."""
    edge = np.diff(flags.astype(np.int8), prepend=0, append=0)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


# Components ------------------------------------------------------------------


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node of ``links`` (a, b): one root for each connected component.

    Each round joins every node to the neighbour that is least by a hash of its
    own, which shortens chains by a constant factor whatever the order of ids;
    links between the joined nodes go on to the next round. Only links and
    parents are shuffled, never the members of a component to one task.
    """
    parents: list[DataFrame] = []
    links = write_step(links.select("a", "b").filter("a <> b").distinct(), "links")
    while not links.isEmpty():
        rank = F.xxhash64(F.col("b"), F.lit(len(parents)))
        both = links.union(links.select("b", "a"))
        least = both.groupBy("a").agg(F.min_by("b", rank).alias("b"), F.min(rank).alias("rank"))
        up = least.select(F.col("a").alias("node"), F.when(F.col("rank") < F.xxhash64(F.col("a"), F.lit(len(parents))), F.col("b")).otherwise(F.col("a")).alias("root"))
        up = write_step(up, "parents")
        parents.append(up)
        moved = links.join(up.select(F.col("node").alias("a"), F.col("root").alias("x")), "a").join(up.select(F.col("node").alias("b"), F.col("root").alias("y")), "b")
        links = write_step(moved.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).filter("a <> b").distinct(), "links")
    if not parents:
        return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = parents.pop()
    while parents:
        up = parents.pop()
        roots = up.join(roots.select(F.col("node").alias("root"), F.col("root").alias("top")), "root", "left").select("node", F.coalesce("top", "root").alias("root"))
    return write_step(roots, "roots")


def ship(spark: SparkSession) -> None:
    """Let Python workers on this machine import the package from where the driver did. A cluster installs it or passes it with ``--py-files``."""
    root, env = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, env.get("PYTHONPATH")) if x)
