from __future__ import annotations

import json

import pytest
from helpers import at, bag, largest_method

from branchlens import schemas
from branchlens.plans import attendance


def raw(spark, payloads):
    rows = [(json.dumps(p) if p is not None else None, at("2024-02-01 00:00:00")) for p in payloads]
    return spark.createDataFrame(rows, "payload string, load_dt timestamp_ntz")


ROW = {
    "Date": "01/06/2025", "Full Name": "Ann", "Group": "Floor", "EntryType": "In",
    "Time": "05:30:00", "Duration": "01:00:05", "Activity": "Bar", "Kiosk Name": "K1",
    "Created On": "2025-06-01T05:31:00+08:00", "Last Edited On": None,
}


def test_parse(spark):
    got = attendance.parse_payloads(raw(spark, [ROW, None]))
    assert [(f.name, f.dataType) for f in got.schema] == [
        (f.name, f.dataType) for f in schemas.ATTENDANCE
    ]
    row = got.collect()
    assert len(row) == 1  # null payloads are left out
    r = row[0]
    assert (str(r.date), r.time_ts, r.duration_sec) == ("2025-06-01", at("2025-05-31 21:30:00"), 3605)
    assert r.updated_at == at("2025-05-31 21:31:00")


def test_parsing_is_compiled(spark):
    """All columns at once, from a table; such a method runs some times slower if it is too long."""
    rows = spark.range(4).selectExpr(
        f"concat('{json.dumps(ROW)}', '') AS payload", "TIMESTAMP_NTZ '2024-02-01 00:00:00' AS load_dt"
    ).localCheckpoint()
    assert largest_method(attendance.parse_payloads(rows)) < 8000


def test_dates_in_both_layouts(spark):
    """Each date text with the day and the instant it gives."""
    days = {
        "2025-06-01": "2025-06-01", "2025-6-1": "2025-06-01", "1/6/2025": "2025-06-01", "01/06/2025": "2025-06-01",
        "31/02/2025": None, "2025/06/01": None, "a/b": None, "1/6/2025 ": None, "/": None, "": None,
    }
    parsed = attendance.parse_payloads(raw(spark, [dict(ROW, Date=d, Activity=d) for d in days]))
    got = {r.activity: (r.date and str(r.date), r.time_ts) for r in parsed.collect()}
    assert got == {d: (day, day and at("2025-05-31 21:30:00")) for d, day in days.items()}


def test_updated_at_falls_back(spark):
    edited = dict(ROW, **{"Last Edited On": "2025-06-02T00:00:00Z"})
    bare = {k: v for k, v in ROW.items() if k != "Created On"}
    got = [r.updated_at for r in attendance.parse_payloads(raw(spark, [edited, bare])).collect()]
    assert got == [at("2025-06-02 00:00:00"), at("2024-02-01 00:00:00")]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        attendance.parse_payloads(raw(spark, [dict(ROW, **{"Created On": "soon"})])).collect()


def test_upsert_policies(spark):
    target = attendance.parse_payloads(raw(spark, [ROW]))
    later = dict(ROW, Activity="Till", **{"Last Edited On": "2025-06-02T00:00:00Z"})
    nameless = {k: v for k, v in ROW.items() if k != "Full Name"}
    staged = attendance.stage_payloads(raw(spark, [ROW, later, nameless, nameless]))
    with pytest.raises(Exception, match="several source rows"):
        attendance.attendance_upsert(target, staged).collect()
    got = attendance.attendance_upsert(target, staged, "latest")
    assert bag(got, "full_name", "activity") == {("Ann", "Till"): 1, (None, "Bar"): 2}


def test_normalise_entries(spark, tmp_path):
    entries = [
        {"startedAt": "", "startAt": "2025-06-01T22:00:00Z", "person": {"name": "Ann", "id": 7},
         "type": "", "entryType": "In", "durationSeconds": 3605, "updatedAt": "",
         "lastEditedOn": "e", "createdAt": "c", "unknown": [1]},
        {"endedAt": "2025-06-01T05:00:00", "person": None},
        {},
    ]
    (tmp_path / "page.json").write_text(json.dumps({"data": entries}))
    got = attendance.normalise_entries(attendance.read_entries(spark, str(tmp_path))).collect()
    first, second, third = got
    assert (first.date, first.time, first.full_name) == ("2025-06-02", "06:00:00", "Ann")
    assert (first.entry_type, first.duration, first.last_edited_on) == ("In", "01:00:05", "e")
    # The raw record is kept whole.
    assert json.loads(first.raw_payload) == entries[0]
    assert (second.date, second.time, second.full_name) == ("2025-06-01", "05:00:00", None)
    assert (third.date, third.time, third.duration) == (None, None, None)
    assert list(first.asDict()) == [
        "date", "full_name", "group_name", "entry_type", "time", "duration", "activity_name",
        "kiosk_name", "created_on", "last_edited_on", "raw_payload",
    ]
