"""Snapshot tables, key registries and partition upserts: replays, crashes, null and odd partition values."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from mercato.sinks.snapshots import SnapshotTable, surrogate_keys
from mercato.sinks.writers import upsert_partitions

SCHEMA = "id int, part string, v int"
ODD = [(1, None, 1), (2, None, 1), (3, "x:y", 1), (4, "", 1), (5, "a/b=c%", 1), (6, "007", 1), (7, "plain", 1), (None, "plain", 1)]


def rows(df):
    return sorted(map(repr, (tuple(r) for r in df.select("id", "part", "v").collect())))


def image(*loads):
    held = {}
    for load in loads:
        for i, p, v in load:
            if i not in held or v >= held[i][2]:
                held[i] = (i, p, v)
    return sorted(map(repr, held.values()))


MOVES = [(1, "x:y", 2), (3, None, 2), (5, "plain", 2), (6, "7", 2), (None, "", 2), (8, None, 2)]


def test_upsert_moves_keys_between_odd_partitions(spark):
    table = SnapshotTable(spark, tempfile.mkdtemp(prefix="snap-"), "part")
    first, second = spark.createDataFrame(ODD, SCHEMA), spark.createDataFrame(MOVES, SCHEMA)
    table.upsert(first, ["id"], ["v"])
    assert rows(table.read()) == image(ODD)
    for _ in range(2):
        table.upsert(second, ["id"], ["v"])
        assert rows(table.read()) == image(ODD, MOVES)
    assert rows(table.read(1)) == image(ODD) and table.versions() == [1, 2, 3]
    table.expire(1)
    assert rows(table.read()) == image(ODD, MOVES) and table.versions() == [3]
    with pytest.raises(ValueError):
        table.upsert(spark.createDataFrame([(1, "x", "2")], "id int, part string, v string"), ["id"], ["v"])


def test_crash_before_the_commit_leaves_the_table(spark, monkeypatch):
    table = SnapshotTable(spark, tempfile.mkdtemp(prefix="snap-"), "part")
    table.replace(spark.createDataFrame(ODD, SCHEMA))
    second = spark.createDataFrame(MOVES, SCHEMA)
    for step in ("_stage", "_commit"):
        whole = getattr(SnapshotTable, step)

        def fail(self, *a, whole=whole, step=step):
            if step == "_stage":
                whole(self, *a)
            raise OSError("lost")

        with monkeypatch.context() as m:
            m.setattr(SnapshotTable, step, fail)
            with pytest.raises(OSError):
                table.upsert(second, ["id"], ["v"])
        assert rows(table.read()) == image(ODD)
    table.upsert(second, ["id"], ["v"])
    assert rows(table.read()) == image(ODD, MOVES)


def test_two_writers_of_one_version(spark, monkeypatch):
    table = SnapshotTable(spark, tempfile.mkdtemp(prefix="snap-"))
    table.replace(spark.createDataFrame(ODD, SCHEMA))
    monkeypatch.setattr(SnapshotTable, "versions", lambda self: [])
    with pytest.raises(RuntimeError):
        table.append(spark.createDataFrame(MOVES, SCHEMA))


def test_plain_upsert_with_odd_partitions(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="upsert-"), "t")
    first, second = spark.createDataFrame(ODD, SCHEMA), spark.createDataFrame(MOVES, SCHEMA)

    def seen():
        table = spark.read.schema("id int, v int, part string").parquet(path)
        return rows(table)

    def blank(load):
        return [(i, p or None, v) for i, p, v in load]

    upsert_partitions(first, path, ["id"], ["v"], "part")
    assert seen() == image(blank(ODD))
    for _ in range(2):
        upsert_partitions(second, path, ["id"], ["v"], "part")
        assert seen() == image(blank(ODD), blank(MOVES))
    upsert_partitions(spark.createDataFrame([(2, None, 5)], SCHEMA), path, ["id"], ["v"], "part")
    assert seen() == image(blank(ODD), blank(MOVES), [(2, None, 5)])


def test_surrogate_keys_are_dense_and_stable(spark):
    path = tempfile.mkdtemp(prefix="keys-")
    first = spark.createDataFrame([(f"c{i % 40:02d}",) for i in range(500)] + [(None,)], "color string")
    keys = {r["color"]: r["color_key"] for r in surrogate_keys(first, "color", path).collect()}
    assert keys == {f"c{i:02d}": i + 1 for i in range(40)}
    for _ in range(2):
        more = surrogate_keys(first.union(spark.createDataFrame([("a",), ("c05x",)], "color string")), "color", path)
        again = {r["color"]: r["color_key"] for r in more.collect()}
        assert again == keys | {"a": 41, "c05x": 42} and more.count() == 42
    assert surrogate_keys(first.filter(F.lit(False)), "color", tempfile.mkdtemp(prefix="keys-")).count() == 0


def test_replay_and_older_rows_move_nothing(spark):
    table = SnapshotTable(spark, tempfile.mkdtemp(prefix="snap-"), "part")
    table.upsert(spark.createDataFrame(ODD, SCHEMA), ["id"], ["v"])
    table.upsert(spark.createDataFrame(MOVES, SCHEMA), ["id"], ["v"])
    held = table._manifest()["parts"]
    older = spark.createDataFrame([(i, "old", 0) for i, _, _ in ODD], SCHEMA)
    for load in (spark.createDataFrame(MOVES, SCHEMA), older):
        table.upsert(load, ["id"], ["v"])
        assert table._manifest()["parts"] == held and rows(table.read()) == image(ODD, MOVES)
    table.upsert(older.unionByName(spark.createDataFrame([(7, None, 9)], SCHEMA)), ["id"], ["v"])
    assert rows(table.read()) == image(ODD, MOVES, [(7, None, 9)])
