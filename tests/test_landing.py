"""Broken landed lines, drift of landed fields, and streams that remember arrivals."""

from __future__ import annotations

import json

import pytest
from helpers import bag

from branchlens import jobs
from branchlens.plans import attendance, drift, ingest
from branchlens.sources.landing import Quarantine, TooManyBroken, read_quarantine
from branchlens.streaming import upsert as streaming


def land(folder, pull, *lines):
    path = folder / f"pull={pull}"
    path.mkdir(parents=True, exist_ok=True)
    (path / f"part-{len(list(path.iterdir()))}.json").write_text("\n".join(lines) + "\n")


def page(*records, key="receipts"):
    return json.dumps({key: list(records)})


def receipt(number, **fields):
    return {"receipt_number": number, "created_at": "2024-01-02T03:04:05Z", **fields}


@pytest.fixture
def folders(tmp_path):
    return {n: str(tmp_path / n) for n in ("in", "staging", "table", "aside", "work", "drift")}


def run(spark, folders, pull, **options):
    return jobs.run_ingest(
        spark, "receipts", folders["in"], folders["staging"], folders["table"], None, pull=pull, **options
    )


def test_broken_lines_go_aside_and_good_ones_on(spark, tmp_path, folders):
    land(tmp_path / "in", "p", page(receipt("a")), '{"receipts": [{"receipt_num', page(receipt("b", total_money="x")), "", "nonsense")
    aside = Quarantine(folders["aside"], limit=2)
    for _ in range(2):  # the second run finds the pull done
        run(spark, folders, "p", quarantine=aside)
    assert bag(ingest.read_days(spark, "receipts", folders["table"]), "receipt_number") == {("a",): 1, ("b",): 1}
    found = read_quarantine(spark, folders["aside"])
    assert bag(found, "line", "load") == {('{"receipts": [{"receipt_num', "p"): 1, ("nonsense", "p"): 1}
    (file,) = {r.file for r in found.collect()}
    assert file.endswith("/pull=p/part-0.json") and {r.offset for r in found.collect()} == {0}


def test_too_many_broken_lines_stop_the_run(spark, tmp_path, folders):
    land(tmp_path / "in", "p", page(receipt("a")), "x", "y")
    with pytest.raises(TooManyBroken, match="2 landed lines"):
        run(spark, folders, "p", quarantine=Quarantine(folders["aside"], limit=1))
    assert read_quarantine(spark, folders["aside"]).count() == 2  # there to be looked at
    assert ingest.read_days(spark, "receipts", folders["table"]).count() == 0


def test_nothing_broken_leaves_no_trace(spark, tmp_path, folders):
    land(tmp_path / "in", "p", page(receipt("a")), page())
    run(spark, folders, "p", quarantine=Quarantine(folders["aside"], limit=0))
    assert read_quarantine(spark, folders["aside"]).count() == 0


def test_time_entries_with_broken_lines(spark, tmp_path, folders):
    land(tmp_path / "in", "p", page({"startedAt": "2024-01-15T20:00:00Z"}, key="data"), "{")
    aside = Quarantine(folders["aside"])
    assert attendance.append_entries(spark, folders["in"], folders["table"], pull="p", quarantine=aside) == 1
    assert bag(read_quarantine(spark, folders["aside"]), "line") == {("{",): 1}


def stream(spark, folders, **options):
    streaming.stream_ingest(
        spark, "receipts", folders["in"], folders["table"], folders["work"], **options
    ).awaitTermination()


def test_stream_goes_on_past_broken_lines(spark, tmp_path, folders):
    for pull in ("one", "two"):
        land(tmp_path / "in", pull, page(receipt(pull)), f"broken {pull}")
        stream(spark, folders, quarantine=Quarantine(folders["aside"]))
    assert bag(ingest.read_days(spark, "receipts", folders["table"]), "receipt_number") == {("one",): 1, ("two",): 1}
    assert bag(read_quarantine(spark, folders["aside"]), "line", "load") == {
        ("broken one", "batch-0"): 1, ("broken two", "batch-1"): 1,
    }


def test_recently_arrived_keys_do_not_reach_the_table(spark, tmp_path, folders, monkeypatch):
    sizes = []
    refresh = streaming.refresh_partitions

    def counted(session, path, rows, *rest):
        sizes.append(rows.count())
        return refresh(session, path, rows, *rest)

    monkeypatch.setattr(streaming, "refresh_partitions", counted)
    options = dict(mode="insert", seen_within="2 days")
    land(tmp_path / "in", "one", page(receipt("a", total_money=1), receipt("b", total_money=1), receipt(None)))
    stream(spark, folders, **options)
    land(tmp_path / "in", "two", page(receipt("b", total_money=2), receipt("c", total_money=2), receipt(None)))
    stream(spark, folders, **options)
    assert [n for n in sizes if n] == [3, 2]
    got = bag(ingest.read_days(spark, "receipts", folders["table"]), "receipt_number", "total_money")
    assert got == {("a", 1.0): 1, ("b", 1.0): 1, ("c", 2.0): 1, (None, None): 2}


def test_keys_beyond_the_memory_are_found_in_the_table(spark, tmp_path, folders):
    options = dict(mode="insert", seen_within="0 seconds")
    for n in (1, 2, 3):
        land(tmp_path / "in", f"p{n}", page(receipt("a", total_money=n), receipt(f"k{n}", total_money=n)))
        stream(spark, folders, **options)
    got = bag(ingest.read_days(spark, "receipts", folders["table"]), "receipt_number", "total_money")
    assert got == {("a", 1.0): 1, ("k1", 1.0): 1, ("k2", 2.0): 1, ("k3", 3.0): 1}


def test_memory_is_for_inserts_without_quarantine(spark, folders):
    for options in (dict(mode="upsert"), dict(mode="insert", quarantine=Quarantine("q"))):
        with pytest.raises(ValueError, match="seen_within"):
            stream(spark, folders, seen_within="1 day", **options)


def test_drift_of_nested_and_retyped_fields(spark, tmp_path, folders):
    land(
        tmp_path / "in", "p",
        page(
            receipt("a", customer={"id": "c", "vip": True}, total={"money": 3, "tips": 1}, line_items=[1], points_earned=2),
            receipt("b", customer=None, employee={"id": 7}, line_items="none", points_earned=2.5, extra=[{"x": 1}]),
            receipt("c", total_money="4", updated_at=5, extra=[{"x": "y"}]),
        ),
    )
    for _ in range(2):
        found = drift.record_drift(spark, folders["in"], "receipts", folders["drift"], "p")
    rows = {r.field: (r.landed_type, r.expected_type, r.records) for r in drift.read_drift(spark, folders["drift"], "receipts").collect()}
    assert found == len(rows)
    assert rows == {
        "customer_vip": ("BOOLEAN", "none", 1),
        "total_tips": ("BIGINT", "none", 1),
        "employee_id": ("BIGINT", "string", 1),
        "line_items": ("VARIANT", "array<string>", 2),
        "total_money": ("VARIANT", "double", 2),
        "updated_at": ("BIGINT", "timestamp_ntz", 1),
        "extra": ("ARRAY<OBJECT<x: VARIANT>>", "none", 2),
    }


def test_ingest_notes_drift(spark, tmp_path, folders):
    land(tmp_path / "in", "one", page(receipt("a", new=1)))
    land(tmp_path / "in", "two", page(receipt("b")), "broken")
    run(spark, folders, "one", drift_path=folders["drift"])
    run(spark, folders, "two", drift_path=folders["drift"], quarantine=Quarantine(folders["aside"]))
    assert bag(drift.read_drift(spark, folders["drift"], "receipts"), "field", "pull") == {("new", "one"): 1}


def test_drift_of_nothing(spark, tmp_path, folders):
    land(tmp_path / "in", "p", page())
    assert drift.landed_drift(spark, folders["in"], "receipts", "p").count() == 0
    assert drift.record_drift(spark, folders["in"], "receipts", folders["drift"], "p") == 0
