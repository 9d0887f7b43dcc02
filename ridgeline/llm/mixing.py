"""Mixing sources to target weights by Pfair scheduling.

Each source is cut into blocks of ``block`` characters in a seeded order. With
integer weights k of total K, block i of a source has release time
``floor((i - 1) * K / k)`` and deadline ``ceil(i * K / k)``; in each slot the
released block with the earliest deadline goes first. No source is ever a whole
block ahead of or behind its share, and the schedule repeats every K slots, so it
is made once for K slots and joined to the blocks by their number modulo k.

Nothing is dropped or repeated. When a source runs out, the others go on with
their weights among themselves (a new phase), so the stream has the target
weights up to the first slot for which a source has no block left (``on_target``).
Slots of blocks that a source no longer has stay empty.

Sources without a weight of their own, and a null source, share the weight
``other``. Empty and null texts have no length: they ride in the block they meet.
A text longer than a block takes the slot of its first character. Repeated rows
each have their place. An empty table gives an empty result.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridgeline.llm.common import unused, write_step

#: Documents of a source that one task numbers, as an average.
BUCKET_ROWS = 20_000


def whole_weights(weights: dict[str, float], slots: int) -> dict[str, int]:
    """Integer weights of total ``slots`` by largest remainders, at least one each."""
    if not weights or min(weights.values()) <= 0 or slots < len(weights):
        raise ValueError("weights must be positive and no more than slots")
    total = sum(weights.values())
    share = {s: w / total * slots for s, w in weights.items()}
    out = {s: max(1, int(x)) for s, x in share.items()}
    for s in sorted(share, key=lambda s: (int(share[s]) - share[s], s)):
        if sum(out.values()) < slots:
            out[s] += 1
    while sum(out.values()) > slots:
        out[max(out, key=lambda s: (out[s] - share[s], out[s], s))] -= 1
    return out


def schedule(k: dict[str, int]) -> list[tuple[str, int, int]]:
    """One period: (source, block 0 to k - 1, slot), earliest deadline first among released blocks."""
    total, done, out = sum(k.values()), dict.fromkeys(k, 0), []
    for slot in range(total):
        ready = [(-(-(done[s] + 1) * total // k[s]), s) for s in k if done[s] < k[s] and done[s] * total // k[s] <= slot]
        source = min(ready)[1]
        out.append((source, done[source], slot))
        done[source] += 1
    return out


def phases(blocks: dict[str, int], k: dict[str, int]) -> list[tuple[list[str], dict[str, int], int, int]]:
    """Phases (sources, their first block, periods, first slot).

    A phase has whole periods while every source in it has enough blocks left;
    a last period that a source cannot fill any more is a phase of its own, so
    there are at most two phases for each source.
    """
    left, slot, out = {s: n for s, n in sorted(blocks.items()) if n}, 0, []
    done = dict.fromkeys(left, 0)
    while left:
        periods = max(1, min(n // k[s] for s, n in left.items()))
        out.append((list(left), {s: done[s] for s in left}, periods, slot))
        slot += periods * sum(k[s] for s in left)
        for s in left:
            done[s] += k[s] * periods
        left = {s: blocks[s] - done[s] for s in left if blocks[s] > done[s]}
    return out


def target_slots(blocks: dict[str, int], k: dict[str, int]) -> int:
    """The first slot that belongs to a block which its source no longer has: up to there the stream has the target weights."""
    own = {s: k[s] for s, n in blocks.items() if n}
    total, at = sum(own.values()), {(s, j): slot for s, j, slot in schedule(own)}
    return min((blocks[s] // k[s] * total + at[s, blocks[s] % k[s]] for s in own), default=0)


def placed(docs: DataFrame, weights: dict[str, float], other: str, seed: int) -> DataFrame:
    """Every row with its source ``key`` and the characters of the source ``before`` it.

    Sources are summed by buckets of a seeded hash of the row, of even size
    whatever the source, so no task sees all rows of one.
    """
    named = [s for s in weights if s != other]
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.when(F.col("source").isin(named), F.col("source")).otherwise(F.lit(other)).alias("key"),
        F.length(F.coalesce("text", F.lit(""))).cast("long").alias("n_chars"),
        place_key(seed).alias("order"),
    )
    rows = write_step(rows.withColumn("row", F.monotonically_increasing_id()), "mix_rows")
    buckets = max(1, ceil(rows.count() / BUCKET_ROWS))
    rows = rows.withColumn("bucket", F.floor((F.col("order") / F.lit(2.0**64) + F.lit(0.5)) * F.lit(buckets)).cast("long"))
    sums = rows.groupBy("key", "bucket").agg(F.sum("n_chars").alias("sum"))
    # One row for each weight and bucket.
    sums = sums.withColumn("base", F.sum("sum").over(Window.partitionBy("key").orderBy("bucket")) - F.col("sum")).drop("sum")
    inside = Window.partitionBy("key", "bucket").orderBy("order", F.col("doc_id").asc_nulls_last(), "row")
    rows = rows.withColumn("sum", F.sum("n_chars").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    rows = rows.join(sums, ["key", "bucket"]).withColumn("before", F.col("base") + F.col("sum") - F.col("n_chars"))
    return rows.select("row", "doc_id", "order", "key", "n_chars", "before")


def place_key(seed: int) -> Column:
    """The seeded hash by which rows of a source are put in order."""
    return F.xxhash64(F.lit(seed), F.col("doc_id").cast("long"), "text")


def mix(docs: DataFrame, weights: dict[str, float], block: int = 65_536, slots: int = 1000, other: str = "other", seed: int = 7) -> DataFrame:
    """One row for each row: doc_id, source_key, n_chars, block, slot, before (characters of its source ahead of it), on_target, order."""
    spark = docs.sparkSession
    k = whole_weights({other: min(weights.values())} | weights, slots)
    rows = write_step(placed(docs, weights, other, seed), "mix_places").withColumn("block", F.floor(F.col("before") / F.lit(block)).cast("long"))
    # One row for each weight at most.
    blocks = {r["key"]: int(r["block"]) + 1 for r in rows.groupBy("key").agg(F.max("block").alias("block")).collect()}
    until, spans, slots_of = target_slots(blocks, k), [], []
    for p, (sources, first, periods, slot) in enumerate(phases(blocks, k)):
        own = {s: k[s] for s in sources}
        spans += [(s, p, first[s], first[s] + k[s] * periods, k[s], slot, sum(own.values())) for s in sources]
        slots_of += [(s, p, j, at) for s, j, at in schedule(own)]
    # Both tables are bounded by the parameters: two phases for each weight, ``slots`` rows a phase.
    span = spark.createDataFrame(spans, "key string, phase int, first long, last long, count long, slot0 long, period long")
    at = spark.createDataFrame(slots_of, "key string, phase int, j long, at long")
    rows = rows.join(F.broadcast(span), "key").filter("block >= first and block < last")
    rows = rows.withColumn("j", (F.col("block") - F.col("first")) % F.col("count")).join(F.broadcast(at), ["key", "phase", "j"])
    slot = F.col("slot0") + F.floor((F.col("block") - F.col("first")) / F.col("count")) * F.col("period") + F.col("at")
    return rows.select(
        "doc_id", F.col("key").alias("source_key"), "n_chars", "block", slot.cast("long").alias("slot"), "before", ((F.col("phase") == 0) & (slot < F.lit(until))).alias("on_target"), "order"
    )


def stream(docs: DataFrame, weights: dict[str, float], **options: object) -> DataFrame:
    """The rows with all their columns in the order of the schedule: sorted files, one stretch of slots each."""
    seed = int(options.get("seed", 7))
    key_id, order, own, slot, before = unused(docs.columns, "_id", "_order", "_own", "_slot", "_before")
    places = mix(docs, weights, **options).groupBy(F.col("doc_id").alias(key_id), F.col("order").alias(order)).agg(F.min("slot").alias(slot), F.min("before").alias(before))
    rows = docs.withColumn(own, place_key(seed))
    rows = rows.join(places, (F.col(own) == F.col(order)) & F.col("doc_id").cast("long").eqNullSafe(F.col(key_id)))
    return rows.repartitionByRange(slot, before).sortWithinPartitions(slot, before, key_id).select(*docs.columns)
