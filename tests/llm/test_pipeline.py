"""The stages of the pipeline, each beside what its operator decides, and the registered queries."""

import os
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from ridgeline.llm import exact_dedup, minhash, mixing, toxicity
from ridgeline.llm.common import read_table
from ridgeline.llm.queries import WEIGHTS

SF = os.environ.get("SF", "/root/testdata/sf0.001")


def test_all_are_registered():
    names = entry.queries()
    assert [n for n in range(1, 14) if sum(k.startswith(f"op{n}_") for k in names) != 1] == []
    assert "pipeline" in names and ("pipeline" in entry.oracle_sql()) == (corpus_pipeline.ORACLE_SQL is not None)


def test_stages(spark, monkeypatch):
    fitted = toxicity.train(read_table(spark, SF, "documents"), read_table(spark, SF, "labels"))
    monkeypatch.setattr(toxicity, "train", lambda docs, labels: fitted)
    from ridgeline.llm.common import write_step

    docs = read_table(spark, SF, "documents")
    columns, found = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        found[name] = (docs, out := write_step(stage(spark, docs, SF), name))
        assert name == "packing" or out.columns == columns
        docs = out

    def ids(df):
        return sorted(r.doc_id for r in df.select("doc_id").collect())

    before, after = found["toxicity"]
    assert ids(after) == ids(toxicity.score(before, fitted).filter("predicted = 0"))
    before, after = found["exact_dedup"]
    assert ids(after) == ids(exact_dedup.decide(before).filter("kept")) and len(ids(after)) < len(ids(before))
    before, after = found["near_dedup"]
    assert ids(after) == ids(minhash.near_duplicates(before).filter("kept")) and len(ids(after)) < len(ids(before))
    before, after = found["source_mix"]
    assert ids(after) == ids(before)
    slot = {r.doc_id: r.slot for r in mixing.mix(before, WEIGHTS).collect()}
    order = [slot[r.doc_id] for r in corpus_pipeline.mixed(spark, before, SF).collect()]
    assert order == sorted(order)
    before, after = found["packing"]
    held = defaultdict(int)
    for r in after.collect():
        held[r.sequence_id] += r.length
    assert set(ids(after)) == set(ids(before)) and max(held.values()) <= 1024
    whole = corpus_pipeline.run(spark, SF)
    assert sorted(map(tuple, whole.select("doc_id", "piece", "ids_crc32").collect())) == sorted(map(tuple, after.select("doc_id", "piece", "ids_crc32").collect()))


def test_columns_of_any_name_stay(spark, docs_of):
    """Every name that the stages use inside, as a column of the documents."""
    names = ["_id", "_key", "_k", "_stay", "_rows", "_score", "_order", "_own", "_slot", "_before", "__id", "_KEY2", "id", "slot", "before", "order", "kept", "text_key"]
    texts = ["one two three four five six"] * 2 + [f"some other words number {i} and more of them" for i in range(20)] + [None, ""]
    docs = docs_of(list(enumerate(texts)) + [(3, texts[3])] * 2)
    for i, name in enumerate(names):
        docs = docs.withColumn(name, F.concat_ws(" ", F.lit(i), "doc_id"))
    rows = {tuple(map(str, r)) for r in docs.collect()}
    network = toxicity.Network(seed=1)
    stages = [
        lambda d: toxicity.keep_clean(d, network), exact_dedup.dedup, minhash.dedup,
        lambda d: mixing.stream(d, {"src0": 0.5, "src1": 0.5}, block=50, slots=10),
    ]
    for stage in stages:
        out = stage(docs)
        assert out.columns == docs.columns
        assert {tuple(map(str, r)) for r in out.collect()} <= rows


@pytest.mark.parametrize("name", [n for n in entry.oracle_sql() if n.startswith("op")])
def test_equal_to_sql(spark, name):
    from compare import compare, duck

    ok, message, _ = compare(spark, duck(SF), SF, entry.queries()[name], entry.oracle_sql()[name])
    assert ok, message


def test_held_out_is_the_remainder(spark):
    rows = read_table(spark, SF, "documents").select("doc_id", toxicity.held_out().alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
