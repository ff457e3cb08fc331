"""Publishing against table versions, and the key index."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest
from helpers import bag, final_plan, plan
from pyspark.sql import functions as F

from branchlens.operators.merge import insert_only, upsert
from branchlens.sources import key_index, publish, tables
from branchlens.sources.files import path_exists

FIELDS = "k string, v long, p int"


def batch(spark, rows):
    return spark.createDataFrame(rows, FIELDS)


def merging(key="k", merge=upsert):
    return lambda target, source: merge(target, source, key)


class Table:
    def __init__(self, spark, folder):
        self.spark, self.path, self.work = spark, str(folder / "t"), str(folder / "work")

    def refresh(self, rows, name, merge=upsert):
        publish.refresh_partitions(
            self.spark, self.path, batch(self.spark, rows), "k", "p", merging(merge=merge), f"{self.work}/{name}"
        )

    def stage(self, rows, name):
        publish.stage_merge(
            self.spark, self.path, batch(self.spark, rows), "k", "p", merging(), f"{self.work}/{name}"
        )
        return f"{self.work}/{name}"

    def rows(self):
        return bag(self.spark.read.schema(FIELDS).parquet(self.path), "k", "v", "p")


@pytest.fixture
def table(spark, tmp_path):
    return Table(spark, tmp_path)


def as_bag(rows):
    return Counter(tuple(r) for r in rows)


def test_a_repeated_run_does_not_undo_later_ones(table, monkeypatch):
    """The run dies when half of its partitions are replaced."""
    table.refresh([("r0", 1, 1), ("r9", 9, 9)], "p0")
    write = publish.replace_partitions

    def died(df, path, partition_by):
        write(df.where("p = 1"), path, partition_by)
        raise OSError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(publish, "replace_partitions", died)
        with pytest.raises(OSError):
            table.refresh([("ra", 5, 1), ("rc", 6, 2)], "a")
    table.refresh([("r0", 99, 1), ("rb", 7, 1)], "b")
    want = [("r0", 99, 1), ("ra", 5, 1), ("rb", 7, 1), ("rc", 6, 2), ("r9", 9, 9)]
    assert table.rows() == as_bag(want)
    table.refresh([("ra", 5, 1), ("rc", 6, 2)], "a")
    assert table.rows() == as_bag(want)
    assert publish.table_version(table.spark, table.path) == 3


def test_staged_rows_of_an_older_version_are_merged_anew(table):
    table.refresh([("r0", 1, 1)], "p0")
    table.stage([("ra", 5, 1), (None, 0, 1)], "a")
    table.refresh([("r0", 99, 1), ("rb", 7, 1)], "b")
    for _ in range(2):
        table.refresh([("ra", 5, 1), (None, 0, 1)], "a")
    assert table.rows() == as_bag([("r0", 99, 1), ("ra", 5, 1), ("rb", 7, 1), (None, 0, 1)])


def test_a_claim_needs_the_version_it_was_merged_with(table):
    one, two = table.stage([("a", 1, 1)], "one"), table.stage([("b", 2, 1)], "two")
    assert publish.claim_publish(table.spark, table.path, one)
    assert not publish.claim_publish(table.spark, table.path, two)
    assert publish.unfinished_publish(table.spark, table.path) == one
    publish.release_staged(table.spark, table.path, one)  # still needed
    publish.finish_publish(table.spark, table.path)
    publish.finish_publish(table.spark, table.path)
    assert table.rows() == as_bag([("a", 1, 1)])
    publish.release_staged(table.spark, table.path, one)
    assert not path_exists(table.spark, one)
    assert not publish.claim_publish(table.spark, table.path, one)


def test_a_claim_without_its_staged_rows_stops_the_next_run(table):
    staged = table.stage([("a", 1, 1)], "one")
    publish.claim_publish(table.spark, table.path, staged)
    publish.drop_staged(table.spark, staged)
    with pytest.raises(RuntimeError, match="staged rows"):
        table.refresh([("b", 1, 1)], "b")


def test_an_empty_claim_counts_as_none(table):
    table.refresh([("a", 1, 1)], "one")
    publish.write_text(table.spark, publish._claim_path(table.path, 2), "")
    table.refresh([("b", 1, 1)], "two")
    assert table.rows() == as_bag([("a", 1, 1), ("b", 1, 1)])


def test_tables_without_index_or_version_get_one(table):
    """As written before there was an index; keys on several partitions, null partitions too."""
    rows = [("a", 1, 1), ("a", 2, 2), ("b", 3, None), (None, 4, 4), ("c", 5, 5)]
    tables.replace_table(batch(table.spark, rows), table.path, "p")
    table.refresh([("a", 9, 7), ("b", 8, 1)], "one")
    assert table.rows() == as_bag([("a", 9, 7), ("b", 8, 1), (None, 4, 4), ("c", 5, 5)])
    assert not path_exists(table.spark, f"{table.path}/p=2")
    assert not path_exists(table.spark, f"{table.path}/p=__HIVE_DEFAULT_PARTITION__")


@pytest.mark.parametrize("mode", [upsert, insert_only])
@pytest.mark.parametrize("deltas", [16, 2])
def test_many_publishes_equal_one_table_in_memory(table, monkeypatch, mode, deltas):
    monkeypatch.setattr(key_index, "DELTAS", deltas)
    monkeypatch.setattr(key_index, "RANGES", 2)
    rng = random.Random(deltas)
    want: dict[str, tuple] = {}
    for number in range(6):
        rows = [(f"k{k}", number, rng.choice([1, 2, 3, None])) for k in rng.sample(range(12), 4)]
        table.refresh(rows, f"b{number}", mode)
        for r in rows:
            if mode is upsert or r[0] not in want:
                want[r[0]] = r
    assert table.rows() == as_bag(want.values())
    index = [n for n in publish.folder_names(table.spark, f"{table.path}/_keys") if n.startswith("publish=")]
    assert len(index) <= deltas + 1 if deltas > 2 else len(index) <= 3


def test_only_touched_partitions_are_read(spark, tmp_path, monkeypatch):
    """The table itself is opened in the touched partitions alone; their list is a literal."""
    work = Table(spark, tmp_path)
    rows = [(f"k{i:03d}", i, i % 8) for i in range(40)]
    work.refresh(rows, "first")
    seen = []

    def merge(target, source):
        seen.append((plan(target), target.count()))
        return upsert(target, source, "k")

    publish.refresh_partitions(
        spark, work.path, batch(spark, [("k001", 5, 2)]), "k", "p", merge, f"{work.work}/second"
    )
    ((text, read),) = seen
    # k001 was in partition 1 and comes in partition 2.
    assert re.search(r"PartitionFilters: \[p#\d+ IN \(1,2\)\]", text)
    assert read == 10
    assert work.rows()[("k001", 5, 2)] == 1 and sum(work.rows().values()) == 40


def test_look_ups_push_key_ranges_down(spark, tmp_path):
    path = str(tmp_path / "t")
    target = spark.range(1000).selectExpr("printf('k%04d', id) k", "id v", "cast(id % 8 as int) p")
    key_index.build_index(target, path, 0, "k", "p")
    source = spark.createDataFrame([("k0004", 0, 1), ("k0990", 0, 2), (None, 0, 3)], FIELDS)
    own, ranges = key_index.batch_ranges(source, "k", "p")
    assert own == {1, 2, 3} and ranges == [("k0004", "k0004"), ("k0990", "k0990")]
    found = key_index.partitions_of_keys(spark, path, source, ranges, "k", "p")
    assert bag(found) == {(4,): 1, (6,): 1}
    assert "GreaterThanOrEqual(k,k0004)" in plan(found)
    assert "SortAggregate" not in final_plan(found)


def test_look_ups_read_entries_once(spark, tmp_path):
    """The last publish of a key counts, in one pass over the entries, also where it is in two partitions."""
    path = str(tmp_path / "t")
    for number, rows in enumerate([[("a", 0, 1), ("b", 0, 1), ("c", 0, 4)], [("a", 0, 2), ("a", 0, 3)]]):
        key_index.add_entries(batch(spark, rows).select("k", "p"), path, number, "k", "p")
    source = batch(spark, [("a", 5, 9), ("b", 5, 9), (None, 5, 9)])
    own, ranges = key_index.batch_ranges(source, "k", "p")
    found = key_index.partitions_of_keys(spark, path, source, ranges, "k", "p")
    assert bag(found) == {(1,): 1, (2,): 1, (3,): 1}
    text = final_plan(found)
    assert text.count("Scan parquet") == 1 and text.count("LeftSemi") == 1 and "Inner" not in text


def test_a_new_table_needs_no_join(table):
    """Rows and keys of the first batch are written as they come."""
    seen = []

    def merge(target, source):
        merged = upsert(target, source, "k")
        seen.append(final_plan(merged))
        return merged

    rows = [("a", 1, 1), ("a", 2, 1), ("b", 3, 2), (None, 4, 2)]
    publish.refresh_partitions(
        table.spark, table.path, batch(table.spark, rows), "k", "p", merge, f"{table.work}/first"
    )
    assert "Join" not in seen[0] and "Aggregate" not in seen[0]
    assert table.rows() == as_bag(rows)
    index = table.spark.read.parquet(f"{table.path}/_keys/publish=1")
    assert bag(index, "k", "p") == {("a", 1): 1, ("b", 2): 1}


@pytest.mark.parametrize("replaces", [False, True])
def test_index_after_keys_moved(table, replaces):
    """The batch tells where its keys are as well as the merged rows do."""
    table.refresh([("a", 1, 1), ("b", 1, 1), ("c", 1, 2)], "first")
    rows = batch(table.spark, [("a", 2, 3), ("c", 2, 2), ("d", 2, 1), (None, 2, 1)])
    publish.refresh_partitions(
        table.spark, table.path, rows, "k", "p", merging(), f"{table.work}/second", replaces
    )
    index = table.spark.read.parquet(f"{table.path}/_keys/publish=2")
    assert bag(index, "k", "p") == {("a", 3): 1, ("c", 2): 1, ("d", 1): 1}
    table.refresh([("a", 3, 2)], "third")
    assert table.rows() == as_bag([("a", 3, 2), ("b", 1, 1), ("c", 2, 2), ("d", 2, 1), (None, 2, 1)])


def test_ranges_are_joined(spark, monkeypatch):
    monkeypatch.setattr(key_index, "RANGES", 2)
    rows = [("a", 0, 1), ("c", 0, 1), ("b", 0, 2), ("d", 0, 2), ("m", 0, 3), ("p", 0, 4), ("z", 0, 5), (None, 0, 6)]
    own, ranges = key_index.batch_ranges(batch(spark, rows), "k", "p")
    assert own == {1, 2, 3, 4, 5, 6} and ranges == [("a", "m"), ("p", "z")]
    assert key_index.batch_ranges(batch(spark, rows).where(F.lit(False)), "k", "p") == (set(), [])
