"""Versioned tables: what a change touches, what readers see, what a second writer meets."""

import pytest
from pyspark.sql import functions as F

from vanewright.sources import versions
from vanewright.sources.versions import Conflict, VersionedTable

SCHEMA = "unit int, cycle int, ts long, v string"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture
def table(spark, tmp_path):
    out = VersionedTable(spark, str(tmp_path), SCHEMA, ["unit"], 4)
    out.append(spark.createDataFrame([(u, c, 10 * c, f"{u}-{c}") for u in [1, 2, 3, 4, 5, None] for c in range(3)], SCHEMA))
    return out


def folders(table, version=None):
    return {f for fs in table.manifest(version).folders.values() for f in fs}


def test_append_and_versions(spark, table):
    first = rows(table.read())
    table.append(spark.createDataFrame([(9, 1, 1, "new")], SCHEMA))
    assert len(table.read().collect()) == 19 and rows(table.read(1)) == first and table.read(0).count() == 0
    again = VersionedTable(spark, table.root)
    assert (again.keys, again.buckets, rows(again.read())) == (["unit"], 4, rows(table.read()))
    assert len(folders(table) - folders(table, 1)) == 1
    with pytest.raises(ValueError):
        VersionedTable(spark, f"{table.root}/none")


def test_a_repeated_batch_adds_nothing(spark, table):
    batch = spark.createDataFrame([(7, 1, 1, "b")], SCHEMA)
    for number in (0, 0, 1, 1, 0):
        table.append(batch, "stream", number)
    assert table.read().where("unit = 7").count() == 2
    table.append(batch, "other", 0)
    table.append(batch, "stream", 1)
    assert table.read().where("unit = 7").count() == 3


def test_delete_rewrites_only_the_buckets_it_touches(spark, table):
    before = table.manifest()
    table.delete(spark.createDataFrame([(2,), (None,)], "unit int"))
    after = table.manifest()
    changed = {b for b in before.folders if before.folders[b] != after.folders.get(b)}
    hit = {r[0] for r in spark.createDataFrame([(2,), (None,)], "unit int").select(table._bucket()).collect()}
    assert changed == hit and {r[0] for r in rows(table.read())} == {1, 3, 4, 5}
    assert table.delete(spark.createDataFrame([], "unit int")).number == after.number


def test_upsert_and_replace(spark, table):
    new = spark.createDataFrame([(1, 1, 10, "same"), (1, 2, 5, "older"), (6, 0, 0, "added"), (None, 0, 99, "null")], SCHEMA)
    for _ in range(2):  # the second changes nothing
        table.upsert(new, ["unit", "cycle"], ["ts"])
        got = {(r["unit"], r["cycle"]): r["v"] for r in table.read().collect()}
        assert len(got) == table.read().count() == 19
        assert (got[1, 1], got[1, 2], got[6, 0], got[None, 0], got[3, 1]) == ("same", "1-2", "added", "null", "3-1")
    table.replace_units(spark.createDataFrame([(3, 7, 7, "only")], SCHEMA))
    assert rows(table.read().where("unit = 3")) == [(3, 7, 7, "only")]
    with pytest.raises(ValueError):
        table.upsert(new, ["cycle"], ["ts"])


def test_a_snapshot_copies_no_data(spark, table):
    data = table.store.names("data")
    held = rows(table.read())
    table.snapshot("monday")
    assert table.store.names("data") == data and table.snapshots() == {"monday": 1}
    reader = table.read()  # a reader of the version before
    table.delete(spark.createDataFrame([(u,) for u in (1, 2, 3)], "unit int"))
    assert rows(table.read("monday")) == held == rows(reader) and table.read().count() == 9


def test_compaction_and_vacuum(spark, table):
    for i in range(4):
        table.append(spark.createDataFrame([(1, i, i, "x")], SCHEMA))
    before = rows(table.read())
    table.snapshot("kept", 2)
    table.compact(3)
    assert rows(table.read()) == before and max(len(f) for f in table.manifest().folders.values()) <= 3
    gone = table.vacuum()
    assert gone and rows(table.read()) == before and table.read("kept").count() == 19
    assert table.versions() == [2, table.manifest().number]


def test_writers_that_meet(spark, table, monkeypatch):
    """One of two writers of a version wins; the other replaces nothing unseen, but may add."""
    base = table.manifest()
    one = spark.createDataFrame([(8, 0, 0, "one")], SCHEMA)
    other = VersionedTable(spark, table.root)
    stale = iter([base])
    monkeypatch.setattr(table, "manifest", lambda version=None: next(stale, None) or VersionedTable.manifest(table, version))
    other.append(one)
    with pytest.raises(Conflict):
        table.delete(spark.createDataFrame([(1,)], "unit int"))
    assert other.read().where("unit in (1, 8)").count() == 4
    stale = iter([base])
    monkeypatch.setattr(table, "manifest", lambda version=None: next(stale, None) or VersionedTable.manifest(table, version))
    table.append(spark.createDataFrame([(8, 1, 0, "two")], SCHEMA))
    assert other.read().where("unit = 8").count() == 2


def test_a_writer_that_died_blocks_nobody(spark, table, monkeypatch):
    table.store.fs.create(table.store._path(f"versions/{2:020}.json.taken"), False).close()
    monkeypatch.setattr(versions, "STALE_S", 0)
    table.append(spark.createDataFrame([(8, 0, 0, "one")], SCHEMA))
    assert table.read().count() == 19


def test_columns_are_those_of_the_table(spark, table):
    df = spark.createDataFrame([("x", 1, "5", "7", 3)], "v string, unit int, cycle string, ts string, extra int")
    table.append(df)
    assert rows(table.read().where(F.col("v") == "x")) == [(1, 5, 7, "x")]
