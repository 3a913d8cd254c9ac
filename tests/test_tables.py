"""Parquet tables: replays, interrupted writes, what a merge writes, bases."""

import re

import pytest
from pyspark.sql import functions as F

from tests.helpers import rows
from tierstream.operators.merge import Clause, MergeError, Policy
from tierstream.sources import files
from tierstream.streaming.tables import AppendTable, MergeTable

SCHEMA = "id STRING, n BIGINT, open BOOLEAN"
UPSERT = Policy(
    on=(("id", "id"),),
    eligible="open",
    matched=(
        Clause("delete", when="s.n < 0"),
        Clause("update", when="s.n = 0", assign={"open": "false"}),
        Clause("update", when="s.n > t.n"),
    ),
)


def source(spark, *pairs):
    return spark.createDataFrame([(i, n, True) for i, n in pairs], SCHEMA)


@pytest.fixture
def table(spark, tmp_path):
    return MergeTable(
        spark, str(tmp_path / "t"), SCHEMA, bucket_by=("id",), buckets=4, change_feed=True
    ).create()


def state(table):
    return rows(table.read(), "id", "n", "open")


def test_append_table_publishes_each_batch_once(spark, tmp_path):
    table = AppendTable(spark, str(tmp_path / "a"), "id STRING, n BIGINT").create()
    assert table.read().count() == 0
    frame = spark.createDataFrame([("a", 1)], "id STRING, n BIGINT")
    assert table.append(frame, "w", 0)
    assert not table.append(frame, "w", 0)
    assert table.append(frame, "w", 1)
    assert table.append(frame, "other", 0)
    assert table.read().count() == 3


def test_unpublished_files_are_invisible(spark, tmp_path):
    table = AppendTable(spark, str(tmp_path / "a"), "id STRING, n BIGINT").create()
    frame = spark.createDataFrame([("a", 1)], "id STRING, n BIGINT")
    frame.write.parquet(f"{table.path}/_staging/left-behind")
    assert table.read().count() == 0
    table.append(frame, "w", 0)
    assert table.read().count() == 1
    found = table.stream().writeStream.format("memory").queryName("seen").trigger(availableNow=True).start()
    found.awaitTermination()
    assert spark.table("seen").count() == 1


def test_empty_table_reads_with_its_schema(table):
    assert table.read().schema.simpleString() == "struct<id:string,n:bigint,open:boolean>"
    assert state(table) == []


def test_rules_apply_in_order(spark, table):
    table.merge(source(spark, *[(f"k{i}", 5) for i in range(20)]), UPSERT, "w", 0)
    table.merge(source(spark, ("k0", -1), ("k1", 0), ("k2", 9), ("k3", 4), ("new", -1)), UPSERT, "w", 1)
    expected = {(f"k{i}", 5, True) for i in range(3, 20)} | {("k1", 5, False), ("k2", 9, True), ("new", -1, True)}
    assert set(state(table)) == expected


def written(table, version):
    """Rows in the files of one commit."""
    return table.spark.read.parquet(f"{table.path}/effects/v={version:020d}")


def test_a_merge_writes_its_effects_only(spark, table):
    table.merge(source(spark, *[(f"k{i}", 5) for i in range(50)]), UPSERT, "w", 0)
    table.merge(source(spark, ("k0", 6)), UPSERT, "w", 1)
    assert rows(written(table, 1), "id", "n", "_effect") == [("k0", 5, "update_preimage"), ("k0", 6, "update_postimage")]
    plain = MergeTable(spark, f"{table.path}-plain", SCHEMA, bucket_by=("id",)).create()
    plain.merge(source(spark, *[(f"k{i}", 5) for i in range(50)]), UPSERT, "w", 0)
    plain.merge(source(spark, ("k0", 6)), UPSERT, "w", 1)
    assert rows(written(plain, 1), "id", "n", "_effect") == [("k0", 6, "update_postimage")]
    assert state(plain) == state(table) and len(state(table)) == 50


def test_batch_without_effect_writes_nothing(spark, table):
    table.merge(source(spark, *[(f"k{i}", 5) for i in range(50)]), UPSERT, "w", 0)
    table.merge(source(spark, *[(f"k{i}", 5 + (i == 7)) for i in range(50)]), UPSERT, "w", 1)
    assert written(table, 1).count() == 2
    assert table.merge(source(spark, *[(f"k{i}", 3) for i in range(50)]), UPSERT, "w", 2)
    assert table.last_commit().version == 1
    assert files.children(spark, f"{table.path}/_staging") == []
    assert len(state(table)) == 50


def test_table_can_become_empty_and_fill_again(spark, table):
    table.merge(source(spark, ("a", 1)), UPSERT, "w", 0)
    table.merge(source(spark, ("a", -1)), UPSERT, "w", 1)
    assert state(table) == []
    table.rewrite_base()
    assert state(table) == []
    table.merge(source(spark, ("a", 2)), UPSERT, "w", 2)
    assert state(table) == [("a", 2, True)]


def test_rows_that_are_not_eligible_stay_and_do_not_match(spark, table):
    table.merge(source(spark, ("a", 1)), UPSERT, "w", 0)
    table.merge(source(spark, ("a", 0)), UPSERT, "w", 1)
    table.merge(source(spark, ("a", 2)), UPSERT, "w", 2)
    assert state(table) == [("a", 1, False), ("a", 2, True)]


@pytest.mark.parametrize("step", ["write_text", "publish"])
def test_failed_merge_leaves_nothing_behind(spark, table, monkeypatch, step):
    """Neither table nor feed show it, and a different batch may come next."""
    table.merge(source(spark, ("a", 1), ("b", 1)), UPSERT, "w", 0)
    with monkeypatch.context() as patch:
        def lost(*_):
            raise OSError("driver lost")

        patch.setattr(files, step, lost)
        with pytest.raises(OSError):
            table.merge(source(spark, ("a", 0), ("b", 5)), UPSERT, "w", 1)
    assert state(table) == [("a", 1, True), ("b", 1, True)] and table.changes.read().count() == 2
    assert table.merge(source(spark, ("b", 7), ("c", 1)), UPSERT, "w", 1)
    assert state(table) == [("a", 1, True), ("b", 7, True), ("c", 1, True)]
    kinds = rows(table.changes.read().filter("_commit_version = 1"), "id", "n", "_change_type")
    assert kinds == [("b", 1, "update_preimage"), ("b", 7, "update_postimage"), ("c", 1, "insert")]


def test_two_writers_at_once_are_noticed(spark, table, monkeypatch):
    table.merge(source(spark, ("a", 1)), UPSERT, "w", 0)
    before = table.last_commit()
    table.merge(source(spark, ("a", 2)), UPSERT, "w", 1)
    monkeypatch.setattr(MergeTable, "last_commit", lambda self: before)
    with pytest.raises(RuntimeError, match="another writer"):
        table.merge(source(spark, ("a", 3)), UPSERT, "other", 0)
    assert state(table) == [("a", 2, True)]


def test_contradicting_rows_are_refused_and_leave_nothing(spark, table):
    table.merge(source(spark, ("a", 1)), UPSERT, "w", 0)
    with pytest.raises(MergeError):
        table.merge(source(spark, ("a", 2), ("a", 3)), UPSERT, "w", 1)
    assert state(table) == [("a", 1, True)] and files.children(spark, f"{table.path}/_staging") == []


def test_new_writer_starts_its_own_count(spark, table):
    table.merge(source(spark, ("a", 1)), UPSERT, "first", 5)
    assert not table.merge(source(spark, ("a", 2)), UPSERT, "first", 5)
    assert table.merge(source(spark, ("a", 3)), UPSERT, "second", 0)
    assert state(table) == [("a", 3, True)]


def test_replay_after_another_writers_batch_is_refused(spark, table):
    table.merge(source(spark, ("a", 1)), UPSERT, "first", 5)
    table.merge(source(spark, ("a", -1)), UPSERT, "second", 0)
    assert not table.merge(source(spark, ("a", 1)), UPSERT, "first", 5)
    table.rewrite_base()
    assert not table.merge(source(spark, ("a", 1)), UPSERT, "first", 5)
    assert not table.merge(source(spark, ("a", 1)), UPSERT, "second", 0)
    assert state(table) == []


def test_commit_times_rise(spark, table):
    for number in range(3):
        table.merge(source(spark, ("a", number + 1)), UPSERT, "w", number)
    times = table.changes.read().groupBy("_commit_version").agg(F.max("_commit_timestamp").alias("at"))
    ordered = [r["at"] for r in times.orderBy("_commit_version").collect()]
    assert ordered == sorted(set(ordered))


def test_bases_keep_the_contents(spark, table):
    for number in range(4):
        table.merge(source(spark, ("a", number + 1), (f"k{number}", 1)), UPSERT, "w", 2 * number)
        table.merge(source(spark, (f"k{number}", 0)), UPSERT, "w", 2 * number + 1)
        before, feed = state(table), table.changes.read().count()
        table.rewrite_base()
        assert state(table) == before and table.changes.read().count() == feed
    assert len(files.children(spark, f"{table.path}/base")) == 2
    table.rewrite_base()  # nothing new
    assert table.merge(source(spark, ("a", 99), ("k0", 3)), UPSERT, "w", 8)
    assert {("a", 99, True), ("k0", 3, True), ("k0", 1, False)} <= set(state(table))


def test_a_merge_reads_only_its_buckets_of_the_base(spark, table):
    table.merge(source(spark, *[(f"k{i}", 5) for i in range(60)]), UPSERT, "w", 0)
    table.rewrite_base()
    text = table._rows(table._touched(source(spark, ("k0", 6))))._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[.*_bucket", text)
    got = table._rows(table._touched(source(spark, ("k0", 6)))).count()
    assert 0 < got < 60
    assert rows(table.read_like(source(spark, ("k0", 6), ("no", 1))), "id") == [("k0",)]


def test_a_base_is_rewritten_by_itself(spark, tmp_path):
    table = MergeTable(spark, str(tmp_path / "t"), SCHEMA, bucket_by=("id",), base_after=3).create()
    for number in range(8):
        table.merge(source(spark, ("a", number + 1), (f"k{number}", 1)), UPSERT, "w", number)
    assert [int(n[2:]) for n in files.children(spark, f"{table.path}/base")] == [2, 5]
    assert state(table) == [("a", 8, True)] + [(f"k{i}", 1, True) for i in range(8)]


def test_random_batches_agree_with_a_dictionary(spark, table):
    import random

    chance = random.Random(7)
    model = {}
    for number in range(6):
        batch = {f"k{chance.randrange(30)}": chance.randrange(-2, 9) or 1 for _ in range(20)}
        table.merge(source(spark, *batch.items()), UPSERT, "w", number)
        if number % 3 == 1:
            table.rewrite_base()
        for key, n in batch.items():
            if key not in model:
                model[key] = n
            elif n < 0:
                del model[key]
            elif n > model[key]:
                model[key] = n
    assert state(table) == sorted((k, n, True) for k, n in model.items())
