"""Merkle manifest of a dataset, verified by a recursive query that climbs from every leaf.

Every row of ``documents`` is a leaf: the SHA-256 of its fields, each written as
its length in bytes, a colon and the value, or as ``-`` if null. The leaves of a
language ascend by doc_id; every ``ARITY`` consecutive nodes become one node of
the next level until one is left, the subroot. The subroots, ordered by
language, are joined to the root in the same way.

Built levels are stored as rows of runs: the hashes of up to eight nodes side by
side and a link to the run and the slot in which their common parent stands. A
recursive common table expression starts from the runs of leaves and follows the
links: each step puts the hash that was climbed with in its slot, folds the run
to the parent, and appends the other hashes of the run to the proof. Leaves of
one run have all steps above their own in common, so one row climbs for up to
eight leaves, with a folded hash for each and one proof. Nothing grows with the
size of a language but the number of rows: places inside a language come from
ranges of (lang, doc_id), and a run never has more than eight nodes.

Defined cases: nulls are ``-`` in the leaf; a null language is a language of its
own and comes first; null doc_ids come first in their language and are verified
like others. Rows with one doc_id stand in order of their leaves; rows equal as a
whole have each their own leaf, with the same hash. Empty and very long texts are
hashed as they are. A language of one row has its leaf as subroot, a table of one
language its subroot as root. An empty table gives an empty result and no root.
Other columns are neither read nor returned.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridgeline.llm.common import write_step
from ridgeline.llm.ranks import placed, ranked

#: Nodes that share a parent.
ARITY = 8
#: Columns that make a leaf, in this order, and their types.
FIELDS = {"doc_id": "long", "source": "string", "lang": "string", "n_chars": "long", "text": "string"}
#: The tree above the subroots; languages are numbered from 0.
TOP = -1
RESULT = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


@dataclass(frozen=True)
class Manifest:
    """``runs`` of leaves, ``nodes`` above them (parent-linked runs), ``subroots`` by language, and the ``root``."""

    runs: DataFrame
    nodes: DataFrame
    subroots: DataFrame
    root: str | None


def field(value: Column) -> Column:
    """A value as it enters a leaf."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(columns: dict[str, Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*[field(columns[name].cast(kind)) for name, kind in FIELDS.items()]).cast("binary"), 256))


#: Digest of hashes side by side, as hex text; ``{}`` is an array of binaries.
_FOLD = "unhex(sha2(concat_ws('', transform({}, h -> lower(hex(h)))), 256))"


def _runs(nodes: DataFrame, *more: Column) -> DataFrame:
    """Nodes (tree, level, idx, count, hash) grouped to runs, with the hash of the run and the place of that hash one level up."""
    run = F.floor(F.col("idx") / ARITY).cast("long").alias("run")
    members = F.array_sort(F.collect_list(F.struct("idx", "hash", *more)))
    out = nodes.groupBy("tree", "level", run, "count").agg(members.alias("members")).withColumn("hashes", F.col("members.hash"))
    # A language of one leaf has no level of runs: the leaf itself goes up.
    return out.withColumn("hash", F.when(F.col("count") > 1, F.expr(_FOLD.format("hashes"))).otherwise(F.col("hashes")[0])).withColumn("above", F.ceil(F.col("count") / ARITY).cast("long"))


def _linked(runs: DataFrame, trees: int) -> DataFrame:
    """Runs with the link to the run and slot of their hash: in their own tree, in the top tree, or none at the root."""
    inner, outer = F.col("above") > 1, (F.col("tree") != TOP) & F.lit(trees > 1)

    def link(own: Column, top: Column) -> Column:
        return F.when(inner, own).when(outer, top)

    return runs.withColumns({
        "up_tree": link(F.col("tree"), F.lit(TOP).cast("long")),
        "up_level": link(F.col("level") + 1, F.lit(0)).cast("int"),
        "up_run": link(F.floor(F.col("run") / ARITY), F.floor(F.col("tree") / ARITY)).cast("long"),
        "up_slot": link(F.col("run") % ARITY, F.col("tree") % ARITY).cast("int"),
    })


def build(docs: DataFrame, claimed: dict[str, Column] | None = None) -> Manifest:
    """The manifest of ``docs``. ``claimed`` replaces fields in the leaves that ``verify`` will climb with.

    Runs one job for each level: the counts of the languages say how many there are.
    """
    own = {name: F.col(name) for name in FIELDS}
    held = own | (claimed or {})
    leaves = docs.select(
        F.col("lang").cast("string").alias("lang"), F.col("doc_id").cast("long").alias("doc_id"), leaf_hash(own).alias("hash"),
        *([] if claimed is None else [leaf_hash(held).alias("held")]),
    )
    if claimed is None:
        leaves = leaves.withColumn("held", F.col("hash"))
    leaves, spans = ranked(leaves, "lang", [F.col("doc_id").asc_nulls_first(), F.col("hash"), F.col("held")], "leaves")
    langs = spans.groupBy("lang").agg(F.max("size").alias("size")).withColumn("all", F.lit(0))
    langs = placed(*ranked(langs.withColumnRenamed("size", "leaves"), "all", [F.col("lang").asc_nulls_first()], "languages"), "all")
    langs = write_step(langs.select("lang", "leaves", F.col("pos").alias("tree")), "language_numbers")
    most, trees = langs.agg(F.max("leaves"), F.count("*")).first()
    spans = spans.join(langs.withColumnRenamed("lang", "_lang"), F.col("lang").eqNullSafe(F.col("_lang"))).drop("_lang")
    nodes = placed(leaves, spans, "lang").select("tree", F.lit(0).alias("level"), F.col("pos").alias("idx"), F.col("size").alias("count"), "doc_id", "hash", "held")
    runs = write_step(_linked(_runs(nodes, F.col("doc_id"), F.col("held")), trees).drop("count"), "leaf_runs")

    done, subroots, left = [], runs.filter("above = 1").select("tree", "hash"), -(-(most or 0) // ARITY)
    level = runs.filter("above > 1")
    while left > 1:
        above = level.select("tree", (F.col("level") + 1).alias("level"), F.col("run").alias("idx"), F.col("above").alias("count"), "hash")
        linked = write_step(_linked(_runs(above), trees).drop("members", "count"), "runs")
        done.append(linked)
        subroots = subroots.union(linked.filter("above = 1").select("tree", "hash"))
        level, left = linked.filter("above > 1"), -(-left // ARITY)
    subroots = write_step(subroots, "subroots")
    top, left = subroots.select(F.lit(TOP).cast("long").alias("tree"), F.lit(0).alias("level"), F.col("tree").alias("idx"), F.lit(trees).cast("long").alias("count"), "hash"), trees
    while left > 1:
        linked = write_step(_linked(_runs(top), trees).drop("members", "count"), "top_runs")
        done.append(linked)
        top, left = linked.select("tree", (F.col("level") + 1).alias("level"), F.col("run").alias("idx"), F.col("above").alias("count"), "hash"), -(-left // ARITY)
    nodes = runs.limit(0).drop("members")
    for part in done:
        nodes = nodes.unionByName(part)
    links = ["tree", "level", "run", "hashes", "up_tree", "up_level", "up_run", "up_slot"]
    root = top.select("hash").first() if trees else None
    return Manifest(runs, write_step(nodes.select(*links), "nodes"), subroots.join(langs.drop("leaves"), "tree"), root and root["hash"].hex())


_CLIMB = """
    with recursive climb(first_tree, first_run, tree, level, run, slot, folded, proof) as (
      select tree, run, up_tree, up_level, up_run, up_slot, folded, X'' from {start}
      union all
      select c.first_tree, c.first_run, n.up_tree, n.up_level, n.up_run, n.up_slot,
             transform(c.folded, f -> unhex(sha2(concat_ws('', transform(n.hashes, (h, i) -> lower(hex(if(i = c.slot, f, h))))), 256))),
             concat(c.proof, aggregate(filter(n.hashes, (h, i) -> i <> c.slot), X'', (a, h) -> concat(a, h)))
      from climb c join {nodes} n on c.tree = n.tree and c.level = n.level and c.run = n.run)
    select first_tree as tree, first_run as run, folded, proof from climb where tree is null
"""


def verify(manifest: Manifest, docs: DataFrame) -> DataFrame:
    """One row for each leaf: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    The folded root is climbed to from the claimed leaf; the proof lists the
    other hashes of the runs on the way, from the leaf's own run up.
    """
    spark = docs.sparkSession
    if manifest.root is None:
        return spark.createDataFrame([], RESULT)
    # The first fold needs no join: a run of leaves holds its own hashes.
    first = F.expr("transform(members, (m, j) -> unhex(sha2(concat_ws('', transform(hashes, (h, i) -> lower(hex(if(i = j, m.held, h))))), 256)))")
    lone = (F.size("hashes") == 1) & (F.col("above") == 1)
    start = manifest.runs.withColumn("folded", F.when(lone, F.col("members.held")).otherwise(first))
    start = start.select("tree", "run", "up_tree", "up_level", "up_run", "up_slot", "folded")
    key = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(key, None)
    spark.conf.set(key, -1)  # the guard against endless recursion counts rows; links only lead upwards
    try:
        climbed = write_step(spark.sql(_CLIMB, start=start, nodes=manifest.nodes), "climbed")
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)
    rows = manifest.runs.select("tree", "run", "members", "hashes").join(climbed, ["tree", "run"])
    rows = rows.join(manifest.subroots.select("tree", F.col("hash").alias("subroot")), "tree")
    rows = rows.select("*", F.posexplode("members").alias("slot", "member"))
    siblings = F.expr("concat(aggregate(filter(hashes, (h, i) -> i <> slot), X'', (a, h) -> concat(a, h)), proof)")
    as_hex = lambda c: F.lower(F.hex(c))
    return rows.select(
        F.col("member.doc_id").alias("doc_id"), as_hex(F.col("member.hash")).alias("leaf"), as_hex(F.col("subroot")).alias("subroot"),
        F.lit(manifest.root).alias("root"), F.sha2(as_hex(siblings).cast("binary"), 256).alias("proof_sha256"),
        as_hex(F.element_at("folded", F.col("slot") + 1)).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


#: A-Z and a-z.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def tampered_text(every: int = 3) -> Column:
    """The text, in lower case where ``every`` divides the CRC-32 of the doc_id."""
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary")) % every == 0, F.lit(False))
    return F.when(hit, F.translate("text", UPPER, LOWER)).otherwise(F.col("text"))
