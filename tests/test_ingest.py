from __future__ import annotations

import json

import pytest
from helpers import at, bag, plan
from pyspark.sql import functions as F

from branchlens import fixtures as fx
from branchlens import jobs, schemas
from branchlens.plans import ingest
from branchlens.sources import tables
from branchlens.sources.landing import read_envelopes


def land(folder, pages):
    folder.mkdir(exist_ok=True)
    name = f"part-{len(list(folder.iterdir()))}.json"
    (folder / name).write_text("\n".join(json.dumps(p) for p in pages))
    return str(folder)


RECEIPT = {
    "receipt_number": "R1",
    "created_at": "2024-01-02T03:04:05.000Z",
    "updated_at": "not a time",
    "total_money": 12,
    "points_earned": None,
    "line_items": [{"item_name": "Cake", "quantity": 2, "note": None}, "loose", 3],
    "payments": {"not": "a list"},
    "store_id": "1",
    "surprise": True,
}


def test_envelopes(spark, tmp_path):
    path = land(tmp_path / "in", [
        {"receipts": [{"receipt_number": "1"}, {"receipt_number": "2"}], "cursor": "n"},
        {"other": []}, {"receipts": []}, {"receipts": [{"receipt_number": "3"}]},
    ])
    record = schemas.landing_schema(schemas.RECEIPTS)
    got = read_envelopes(spark, path, "receipts", record)
    assert sorted(r.receipt_number for r in got.collect()) == ["1", "2", "3"]


def test_broken_pages_are_refused(spark, tmp_path):
    path = land(tmp_path / "in", [{"receipts": [{"receipt_number": "1", "total_money": "x"}]}])
    record = schemas.landing_schema(schemas.RECEIPTS)
    # One field of the wrong type is only lost itself.
    row = read_envelopes(spark, path, "receipts", record).first()
    assert (row.receipt_number, row.total_money) == ("1", None)
    (tmp_path / "in" / "cut.json").write_text('{"receipts": [{"receipt_number": "2"')
    with pytest.raises(Exception, match="landed page is no JSON"):
        read_envelopes(spark, path, "receipts", record).collect()


def test_whole_numbers_landed_as_decimals(spark, tmp_path):
    path = land(tmp_path / "in", [{"receipts": [dict(RECEIPT, points_earned=3.0), RECEIPT]}])
    staged, _ = ingest.stage(spark, "receipts", path, str(tmp_path / "staging"))
    assert sorted(str(r.points_earned) for r in staged.collect()) == ["3", "None"]


def test_stage_repairs_and_counts(spark, tmp_path):
    path = land(tmp_path / "in", [{"receipts": [RECEIPT, {"receipt_number": "R2"}]}])
    staged, rows = ingest.stage(spark, "receipts", path, str(tmp_path / "staging"))
    assert rows == 2
    assert staged.schema.fieldNames() == schemas.RECEIPTS.fieldNames()
    by_id = {r.receipt_number: r for r in staged.collect()}
    r = by_id["R1"]
    assert r.created_at == at("2024-01-02 03:04:05")
    assert r.updated_at is None
    assert r.total_money == 12.0
    assert [json.loads(x) for x in r.line_items] == RECEIPT["line_items"]
    assert r.payments == []
    assert by_id["R2"].line_items == [] and by_id["R2"].created_at is None
    # A second load replaces the first.
    again, rows = ingest.stage(
        spark, "receipts", land(tmp_path / "more", [{"receipts": [RECEIPT]}]),
        str(tmp_path / "staging"),
    )
    assert rows == again.count() == 1


def test_stage_window(spark, tmp_path):
    pages = [{"receipts": [dict(RECEIPT, receipt_number=str(d), created_at=f"2024-01-0{d}T00:00:00Z")
                           for d in range(1, 6)]}]
    window = (at("2024-01-02 00:00:00"), at("2024-01-04 00:00:00"))
    _, rows = ingest.stage(
        spark, "receipts", land(tmp_path / "in", pages), str(tmp_path / "staging"), window
    )
    assert rows == 3


def test_conform_keeps_order_and_types(spark):
    df = spark.sql("SELECT 'x' AS extra, '5' AS store_id, 'S1' AS id, 3 AS expected_cash")
    got = schemas.conform(df, schemas.SHIFTS)
    assert [(f.name, f.dataType) for f in got.schema] == [
        (f.name, f.dataType) for f in schemas.SHIFTS
    ]
    assert got.first().taxes == []


def receipts(spark, rows):
    df = spark.createDataFrame(rows, "receipt_number string, created_at string, total_money double")
    return schemas.conform(df, schemas.RECEIPTS)


def test_merge_days_touches_only_its_days(spark, tmp_path):
    target = str(tmp_path / "target")
    first = receipts(spark, [("a", "2024-01-01", 1.0), ("b", "2024-01-02", 2.0)])
    ingest.merge_days(spark, "receipts", first, target)
    untouched = sorted((tmp_path / "target" / "ds=2024-01-01").glob("*.parquet"))
    second = receipts(
        spark, [("b", "2024-01-02", 20.0), ("c", "2024-01-02", 3.0), ("d", "2024-01-03", 4.0),
                (None, "2024-01-03", 5.0), ("n", None, 6.0)],
    )
    ingest.merge_days(spark, "receipts", second, target)
    got = ingest.read_days(spark, "receipts", target)
    assert bag(got, "receipt_number", "total_money") == {
        ("a", 1.0): 1, ("b", 20.0): 1, ("c", 3.0): 1, ("d", 4.0): 1, (None, 5.0): 1, ("n", 6.0): 1,
    }
    assert sorted((tmp_path / "target" / "ds=2024-01-01").glob("*.parquet")) == untouched
    recent = ingest.read_days(spark, "receipts", target, at("2024-01-02 12:00:00"))
    assert "PartitionFilters: [isnotnull(ds" in plan(recent)
    assert ("a",) not in bag(recent, "receipt_number") and recent.count() == 4
    # Rows without a day are merged too.
    third = receipts(spark, [("n", None, 60.0)])
    ingest.merge_days(spark, "receipts", third, target)
    assert ("n", 60.0) in bag(ingest.read_days(spark, "receipts", target), "receipt_number", "total_money")
    assert ingest.read_days(spark, "receipts", target).count() == 6


def test_merge_days_insert_mode(spark, tmp_path):
    target = str(tmp_path / "target")
    ingest.merge_days(spark, "receipts", receipts(spark, [("a", "2024-01-01", 1.0)]), target)
    batch = receipts(spark, [("a", "2024-01-01", 9.0), ("b", "2024-01-01", 2.0)])
    ingest.merge_days(spark, "receipts", batch, target, mode="insert")
    got = ingest.read_days(spark, "receipts", target)
    assert bag(got, "receipt_number", "total_money") == {("a", 1.0): 1, ("b", 2.0): 1}


def test_replayed_batch_publishes_the_same_rows(spark, tmp_path):
    target, work = str(tmp_path / "target"), str(tmp_path / "work")
    batch = receipts(spark, [("a", "2024-01-01", 1.0), (None, "2024-01-01", 2.0)])
    for _ in range(2):
        ingest.merge_days(spark, "receipts", batch, target, work_path=work)
    # Null keys never match, so merging twice would have added the row again.
    assert ingest.read_days(spark, "receipts", target).count() == 2


@pytest.mark.parametrize("mode", ["upsert", "insert"])
def test_a_key_may_move_to_another_day(spark, tmp_path, mode):
    target = str(tmp_path / "target")
    ingest.merge_days(spark, "receipts", receipts(
        spark, [("a", "2024-01-01", 1.0), ("b", "2024-01-02", 2.0), ("c", "2024-01-03", 3.0),
                ("d", "2024-01-03", 4.0)],
    ), target)
    moved = receipts(spark, [("a", "2024-01-05", 10.0), ("c", "no time", 30.0)])
    ingest.merge_days(spark, "receipts", moved, target, mode)
    got = bag(ingest.read_days(spark, "receipts", target), "receipt_number", "total_money")
    new = {("a", 10.0): 1, ("c", 30.0): 1} if mode == "upsert" else {("a", 1.0): 1, ("c", 3.0): 1}
    assert got == {("b", 2.0): 1, ("d", 4.0): 1, **new}
    # A day that lost all its rows is gone.
    assert (tmp_path / "target" / "ds=2024-01-01").exists() == (mode == "insert")


def test_tables_of_another_layout_are_refused(spark, tmp_path):
    path = str(tmp_path / "flat")
    batch = receipts(spark, [("a", "2024-01-01", 1.0)])
    batch.write.parquet(path)
    with pytest.raises(ValueError, match="not partitioned by ds"):
        ingest.merge_days(spark, "receipts", batch, path)
    with pytest.raises(ValueError, match="not partitioned by ds"):
        ingest.read_days(spark, "receipts", path)


def test_nested_records_fill_flat_columns(spark, tmp_path):
    pages = [{"receipts": [
        {"receipt_number": "1", "customer": {"id": "C9"}, "total": {"money": 4.5},
         "points": {"earned": 3}, "line": {"items": [{"n": 1}]}},
        {"receipt_number": "2", "customer_id": "flat", "customer": {"id": "C9"}},
        {"receipt_number": "3", "customer": "text", "points": [1]},
    ]}]
    staged, _ = ingest.stage(spark, "receipts", land(tmp_path / "in", pages), str(tmp_path / "s"))
    got = {r.receipt_number: r for r in staged.collect()}
    assert (got["1"].customer_id, got["1"].total_money, got["1"].points_earned) == ("C9", 4.5, 3)
    assert got["1"].line_items == ['{"n":1}']
    assert (got["2"].customer_id, got["3"].customer_id) == ("flat", None)


def test_merge_table_creates_the_target(spark, tmp_path):
    batch = receipts(spark, [("a", "2024-01-01", 1.0)])
    merged = ingest.merge_table(
        spark, "receipts", batch, str(tmp_path / "absent"), str(tmp_path / "v1")
    )
    assert merged.count() == 1
    again = ingest.merge_table(
        spark, "receipts", batch, str(tmp_path / "v1"), str(tmp_path / "v2")
    )
    assert bag(again, "receipt_number") == {("a",): 1}


def test_shards_are_pruned_to_their_days(spark, small, tmp_path):
    table = tables.replace_table(fx.shards(spark, small), str(tmp_path / "shards"), "ds")
    fixed = ingest.fix_shards(table, "ds", "2024-01-03", "2024-01-04")
    days = {str(r[0]) for r in fixed.select("ds").distinct().collect()}
    assert days == {"2024-01-03", "2024-01-04"}
    assert "PartitionFilters: [isnotnull(ds" in plan(fixed)
    assert fixed.columns == [*schemas.SHIFTS_WIDE.fieldNames(), "ds"]


def test_normalise_moves_arrays_to_the_end(spark, small):
    got = ingest.normalise_shards(fx.shards(spark, small))
    assert got.columns[-2:] == ["cash_movements", "taxes"]
    row = got.first()
    assert set(json.loads(row.cash_movements[0])) == {"type", "money_amount", "comment"}
    assert all(isinstance(json.loads(t), int) for t in row.taxes)


def test_daily_shards_flow_into_the_shift_table(spark, tmp_path):
    def shift(number, day, **fields):
        return {"id": number, "opened_at": f"2024-01-0{day}T02:00:00Z", **fields}

    pages = [{"shifts": [
        shift("a", 1, cash_movements=[{"money_amount": 1, "note": None}], taxes=[1, 2]),
        shift("b", 1, cash_movements=[{"money_amount": 1}, 5], taxes="none"),
        shift("a", 2, cash_movements=None),
    ]}]
    path = str(tmp_path / "shards")
    shards = ingest.stage_shards(spark, land(tmp_path / "in", pages), path)
    by_id = {(r.id, str(r.ds)): r for r in shards.collect()}
    assert by_id["a", "2024-01-01"].taxes == [1, 2]
    assert by_id["b", "2024-01-01"].taxes == []
    assert by_id["b", "2024-01-01"].cash_movements == []  # not all of them objects

    # Staging a day again replaces it and leaves the others.
    redo = [{"shifts": [shift("c", 2)]}]
    shards = ingest.stage_shards(spark, land(tmp_path / "redo", redo), path)
    assert bag(shards, "id") == {("a",): 1, ("b",): 1, ("c",): 1}

    target = schemas.conform(spark.sql("SELECT 'b' AS id, 'kept' AS store_id"), schemas.SHIFTS)
    merged = ingest.backfill_shifts(target, shards, "ds", "2024-01-01", "2024-01-02")
    rows = {r.id: r for r in merged.collect()}
    assert sorted(rows) == ["a", "b", "c"] and rows["b"].store_id == "kept"
    assert json.loads(rows["a"].cash_movements[0]) == {"money_amount": 1, "note": None}
    assert rows["a"].taxes == ["1", "2"]


def test_append_keeps_duplicates(spark, tmp_path):
    df = spark.createDataFrame([("a",)], "k string")
    for _ in range(2):
        table = tables.append_table(df, str(tmp_path / "raw"))
    assert table.count() == 2


def test_a_table_is_never_written_over_itself(spark, tmp_path):
    path = str(tmp_path / "v1")
    batch = receipts(spark, [("a", "2024-01-01", 1.0)])
    ingest.merge_table(spark, "receipts", batch, str(tmp_path / "absent"), path)
    with pytest.raises(ValueError, match="being read"):
        ingest.merge_table(spark, "receipts", batch, path, path + "/")
    with pytest.raises(ValueError, match="being read"):
        ingest.merge_table(spark, "receipts", batch, path, "file:" + path)
    assert spark.read.parquet(path).count() == 1


def test_window_is_pushed_to_the_scan(spark, small):
    events = spark.read.parquet(f"{small}/events.parquet")
    got = ingest.window_filter(events, (at("2024-01-02 00:00:00"), at("2024-01-03 00:00:00")), "ts")
    assert "GreaterThanOrEqual(ts" in plan(got.select("event_id"))
    assert got.where(F.col("ts") < F.expr("TIMESTAMP_NTZ '2024-01-02 00:00:00'")).count() == 0


# --- shards whose days differ in type -------------------------------------


def mixed_days(spark, small, path):
    for part in fx.mixed_shards(spark, small):
        part.write.mode("append").partitionBy("ds").parquet(path)
    return path


def test_days_of_each_type_are_read_together(spark, small, tmp_path):
    path = mixed_days(spark, small, str(tmp_path / "shards"))
    frames = ingest.shard_frames(spark, path, "ds", "2024-01-03", "2024-01-09")
    assert sorted(f.schema["taxes"].dataType.simpleString() for f in frames) == [
        "array<bigint>", "array<string>", "array<struct<rate:bigint>>",
    ]
    days = {str(r.ds) for f in frames for r in f.select("ds").distinct().collect()}
    assert days == {f"2024-01-0{i}" for i in range(3, 10)}
    union = ingest.shard_union(spark, path, "ds", "2024-01-03", "2024-01-09", schemas.SHIFTS_WIDE)
    assert union.count() == sum(f.count() for f in frames)
    assert union.schema["taxes"].dataType.simpleString() == "array<string>"
    # A column that some days lack is null there.
    assert {r.ds.day % 3 for r in union.where("tip is null").select("ds").distinct().collect()} == {1}
    assert ingest.shard_frames(spark, path, "ds", "2023-01-01", "2023-02-01") == []
    with pytest.raises(FileNotFoundError):
        ingest.shard_frames(spark, str(tmp_path / "none"), "ds", "2024-01-01", "2024-01-02")


def test_backfill_and_fix_of_mixed_days(spark, small, tmp_path):
    path = mixed_days(spark, small, str(tmp_path / "shards"))
    for _ in range(2):
        jobs.run_backfill(spark, path, "2024-01-01", "2024-01-31", str(tmp_path / "shifts"))
    rows = ingest.read_days(spark, "shifts", str(tmp_path / "shifts")).collect()
    assert {r.id for r in rows} == {r.id for r in fx.shards(spark, small).select("id").distinct().collect()}
    assert any(r.taxes[0].startswith('{"rate":') for r in rows)
    jobs.run_fix_shards(spark, path, "2024-01-02", "2024-01-04", str(tmp_path / "fixed"))
    fixed = spark.read.parquet(str(tmp_path / "fixed"))
    assert {r.ds.day for r in fixed.select("ds").distinct().collect()} == {2, 3, 4}
    assert fixed.schema["cash_movements"].dataType.simpleString() == "array<string>"
    assert fixed.where("cash_movements[0] not like '%money_amount%'").count() == 0


def test_an_empty_range_adds_nothing(spark, small, tmp_path):
    path = mixed_days(spark, small, str(tmp_path / "shards"))
    jobs.run_backfill(spark, path, "2023-01-01", "2023-01-31", str(tmp_path / "shifts"))
    assert ingest.read_days(spark, "shifts", str(tmp_path / "shifts")).count() == 0
