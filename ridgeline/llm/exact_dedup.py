"""Exact dedup: partitions exchange Golomb-coded fingerprints, then compare the bytes of suspects.

1. Each partition digests its texts (white space deleted), keeps a small row for
   each text, and sends every owner the sorted fingerprints that belong to it,
   Golomb-Rice coded.
2. An owner counts fingerprints over all lists and answers each partition with a
   bitmap of those that occur more than once.
3. Rows with a set bit are suspects. Only suspects enter the grouping by whole
   texts, which is the byte comparison; copies collapse before its shuffle.

Nulls count as empty texts, and all empty texts are equal. A null doc_id ranks
after all others. Repeated rows are copies: exactly one of them stays. An empty
table gives an empty result. Other columns are ignored here and kept by ``dedup``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgeline.llm.common import NO_ID, U64, arrow_map, documents, golomb_decode, golomb_encode, keep_rows, shuffle_count, text_key, write_step

_GAPS = b" \t\n\v\f\r"
_DELETE = "[\\x20\\x09-\\x0D]"


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_points (code points), sha (of the text without white space) and text_key of every row."""

    def each(batch: pa.RecordBatch) -> dict[str, object]:
        texts = batch.column(1).to_pylist()
        return {
            "doc_id": batch.column(0),
            "n_points": [len(t) for t in texts],
            "text_key": batch.column(2),
            "sha": [hashlib.sha256(t.encode("utf-8").translate(None, _GAPS)).digest() for t in texts],
        }

    return arrow_map(documents(docs, text_key().alias("text_key")), each, "doc_id long, n_points long, sha binary, text_key long", most=1 << 23)


def _lists(rows: DataFrame, owners: int) -> DataFrame:
    """For each part and owner the sorted distinct fingerprints of the part, coded, and a bitmap of those it has twice."""

    def send(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[np.ndarray]] = {}
        for b in parts:
            prints = np.frombuffer(b"".join(x[:8] for x in b.column("sha").to_pylist()), ">u8").astype(U64)
            part = b.column("part").to_numpy()
            for p in np.unique(part):
                held.setdefault(int(p), []).append(prints[part == p])
        out: list[tuple[int, int, bytes, bytes]] = []
        for p, found in held.items():
            prints, n = np.unique(np.concatenate(found), return_counts=True)
            owner = (prints % U64(owners)).astype(np.int64)
            for o in np.unique(owner):
                mine = owner == o
                out.append((p, int(o), golomb_encode(prints[mine], 64), np.packbits(n[mine] > 1).tobytes()))
        yield pa.RecordBatch.from_arrays(
            [pa.array([x[i] for x in out], t) for i, t in enumerate((pa.int32(), pa.int32(), pa.binary(), pa.binary()))],
            ["part", "owner", "prints", "twice"],
        )

    return rows.select("part", "sha").mapInArrow(send, "part int, owner int, prints binary, twice binary")


def _answer(key: tuple, lists: pd.DataFrame) -> pd.DataFrame:
    """Of one owner: for each list a bitmap of the fingerprints that occur more than once anywhere."""
    each = [golomb_decode(x) for x in lists["prints"]]
    everything, n = np.unique(np.concatenate(each), return_counts=True)
    repeated = everything[n > 1]
    twice = []
    for prints, local in zip(each, lists["twice"], strict=True):
        own = np.unpackbits(np.frombuffer(local, np.uint8), count=len(prints)).astype(bool)
        twice.append(np.packbits(own | np.isin(prints, repeated)).tobytes())
    return pd.DataFrame({"part": lists["part"], "owner": lists["owner"], "prints": lists["prints"], "twice": twice})


def _repeated(key: tuple, lists: pd.DataFrame) -> pd.DataFrame:
    """Of one part: the fingerprints whose bit is set."""
    found = [np.zeros(0, U64)]
    for code, bits in zip(lists["prints"], lists["twice"], strict=True):
        prints = golomb_decode(code)
        found.append(prints[np.unpackbits(np.frombuffer(bits, np.uint8), count=len(prints)).astype(bool)])
    prints = np.concatenate(found)
    return pd.DataFrame({"part": np.full(len(prints), key[0], np.int32), "print": prints.astype(np.int64)})


def decide(docs: DataFrame) -> DataFrame:
    """One row for each input row: doc_id, keep_id, group_size, kept, text_sha256, text_key."""
    spark = docs.sparkSession
    owners = shuffle_count(spark)
    rows = write_step(
        digests(docs).withColumn("part", F.spark_partition_id()).withColumn("row", F.monotonically_increasing_id()), "digests"
    )
    lists = _lists(rows, owners)
    answers = lists.groupBy("owner").applyInPandas(_answer, lists.schema)
    hits = answers.groupBy("part").applyInPandas(_repeated, "part int, print long")
    print_of = F.conv(F.hex(F.substring("sha", 1, 8)), 16, -10).cast("long")
    # A part has a fingerprint's row once, so the hot text is dealt out over the parts that hold it.
    suspects = write_step(
        rows.withColumn("print", print_of).join(hits, ["part", "print"], "left_semi").select("doc_id", "n_points", "sha", "row"), "suspects"
    )
    ids = suspects.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("id")).distinct()
    bare = F.regexp_replace("text", _DELETE, "")
    texts = documents(docs).withColumn("id", F.coalesce("doc_id", F.lit(NO_ID))).join(ids, "id")
    texts = texts.select("id", bare.alias("bare"), F.length("text").cast("long").alias("n_points"))
    # Whole texts are the grouping key: this is the comparison of bytes, after a combine in each task.
    sizes = texts.groupBy("bare", "n_points").agg(F.count("*").alias("n"), F.min("id").alias("id"))
    sizes = sizes.groupBy("bare").agg(F.sum("n").alias("group_size"), F.max(F.struct("n_points", (-F.col("id")).alias("id"))).alias("best"))
    groups = sizes.filter("group_size > 1").select(
        F.unhex(F.sha2(F.col("bare").cast("binary"), 256)).alias("sha"), "group_size", F.col("best.n_points").alias("most"), (-F.col("best.id")).alias("keep")
    )
    # Two texts with one SHA-256 would stop the job rather than be merged.
    groups = groups.groupBy("sha").agg(
        F.when(F.count("*") == 1, F.min("group_size")).otherwise(F.raise_error(F.lit("two texts have the same SHA-256")).cast("long")).alias("group_size"),
        F.min("most").alias("most"), F.min("keep").alias("keep"),
    )
    groups = write_step(groups, "groups")
    # The row that stays, where rows are repeated as a whole.
    first = suspects.join(groups, "sha").filter("n_points = most and coalesce(doc_id, {}) = keep".format(NO_ID))
    first = first.groupBy("sha").agg(F.min("row").alias("keep_row"))
    groups = write_step(groups.join(first, "sha").drop("most"), "decisions")
    return rows.join(groups, "sha", "left").select(
        "doc_id",
        F.when(F.col("keep").isNull(), F.col("doc_id")).otherwise(F.nullif("keep", F.lit(NO_ID))).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).alias("group_size"),
        F.coalesce(F.col("row") == F.col("keep_row"), F.lit(True)).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
        "text_key",
    )


def dedup(docs: DataFrame) -> DataFrame:
    """The rows that stay, with all their columns."""
    return keep_rows(docs, decide(docs))
