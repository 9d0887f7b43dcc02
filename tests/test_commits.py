import pytest

from ridgeline.session import new_path
from ridgeline.sources import commits
from ridgeline.sources.commits import ConcurrentCommit, committed

SCHEMA = "day string, k int"


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def held(df):
    return sorted((r.day or "", r.k) for r in df.collect())


@pytest.fixture
def table(spark):
    return committed(spark, new_path(spark, "table"), SCHEMA, ["day"])


def test_add_replace_merge(spark, table):
    assert held(table.rows()) == [] and table.add(frame(spark)) == 0
    table.add(frame(spark, ("a", 1), ("b/c=%", 2), (None, 3)))
    table.add(frame(spark, ("a", 4)))
    assert held(table.rows()) == [("", 3), ("a", 1), ("a", 4), ("b/c=%", 2)]
    assert held(table.rows(frame(spark, ("a", 0), (None, 0)))) == [("", 3), ("a", 1), ("a", 4)]
    table.replace(frame(spark, ("a", 5), ("d", 6)), frame(spark, (None, 0)))
    assert held(table.rows()) == [("a", 5), ("b/c=%", 2), ("d", 6)]
    for _ in range(2):
        table.merge(frame(spark, ("d", 6), ("d", 7), ("d", 7), (None, 8)))
    assert held(table.rows()) == [("", 8), ("a", 5), ("b/c=%", 2), ("d", 6), ("d", 7)]
    assert {(r.day, r.n_rows) for r in table.manifest().collect()} == {(None, 1), ("a", 1), ("b/c=%", 1), ("d", 2)}


def test_readers_of_a_version_see_that_version(spark, table):
    first = table.add(frame(spark, ("a", 1), ("b", 2)))
    before = table.rows()
    table.replace(frame(spark, ("a", 9)))
    # What was opened before the change still reads what it was, whole.
    assert held(before) == held(table.rows(version=first)) == [("a", 1), ("b", 2)]
    assert held(table.rows()) == [("a", 9), ("b", 2)]


def test_a_stop_before_the_commit_changes_nothing(spark, table, monkeypatch):
    table.add(frame(spark, ("a", 1)))

    def stop(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(commits.CommittedTable, "_commit", stop)
        with pytest.raises(RuntimeError):
            table.replace(frame(spark, ("a", 2)))
    assert held(table.rows()) == [("a", 1)]
    table.replace(frame(spark, ("a", 2)))
    assert held(table.rows()) == [("a", 2)]
    assert table.vacuum() == 1  # the folder of the run that stopped; the first one is still named by version 1
    assert held(table.rows()) == [("a", 2)] and held(table.rows(version=1)) == [("a", 1)]


def test_two_writers(spark, table, monkeypatch):
    table.add(frame(spark, ("a", 1)))
    base = table._base()
    table.add(frame(spark, ("a", 2)))
    with monkeypatch.context() as m:
        m.setattr(commits.CommittedTable, "_base", lambda self: base)
        with pytest.raises(ConcurrentCommit):
            table.replace(frame(spark, ("a", 3)))
    assert held(table.rows()) == [("a", 1), ("a", 2)]


def test_old_manifests_go(spark, table, monkeypatch):
    monkeypatch.setattr(commits, "KEEP_VERSIONS", 2)
    for k in range(4):
        table.replace(frame(spark, ("a", k)))
    assert table.versions() == [3, 4] and table.vacuum() == 2 and held(table.rows()) == [("a", 3)]


def test_columns(spark):
    with pytest.raises(ValueError):
        committed(spark, "x", SCHEMA, ["other"])
