from __future__ import annotations

import json

import pytest
from helpers import at, bag
from pyspark.sql import functions as F

from branchlens import fixtures as fx
from branchlens import jobs, schemas
from branchlens.plans import attendance, ingest, reports
from branchlens.sources.report_sink import report_path, report_text, write_report


def test_reports_job(spark, small, tmp_path):
    written = jobs.run_reports(
        fx.shifts(spark, small), fx.receipts(spark, small), fx.stores(spark, small),
        str(tmp_path), fx.AS_OF,
    )
    assert written == {
        "Sales Dip Anomalies": True, "Ratio Anomalies": True, "Summary Sales": True,
        "Granular Sales": True,
    }
    dips = spark.read.option("header", True).csv(report_path(str(tmp_path), reports.SALES_DIP))
    assert dips.columns == reports.SALES_DIP_COLUMNS
    keys = [(r.store_name, r.shift_opening_time) for r in dips.collect()]
    assert len(keys) == 41 and len(keys[0][1]) == 19
    summary = spark.read.option("header", True).csv(report_path(str(tmp_path), reports.SUMMARY))
    assert summary.count() == 15


def test_report_files_are_sorted(spark, tmp_path):
    df = spark.createDataFrame(
        [("b", at("2024-01-01 05:00:00")), ("a", at("2024-01-02 05:00:00")),
         ("a", at("2024-01-01 05:00:00"))],
        "store_name string, shift_opening_time timestamp_ntz",
    )
    assert write_report(df, str(tmp_path), reports.SALES_DIP)
    folder = tmp_path / "sales_dip_anomalies"
    lines = []
    for file in sorted(folder.glob("*.csv")):
        lines += file.read_text().splitlines()[1:]
    assert lines == ["a,2024-01-01 05:00:00", "a,2024-01-02 05:00:00", "b,2024-01-01 05:00:00"]


def test_empty_report_keeps_the_old_one(spark, tmp_path):
    df = spark.createDataFrame([("a", 1.0)], "Branch string, x double")
    assert write_report(df, str(tmp_path), reports.SUMMARY)
    assert not write_report(df.where("x > 5"), str(tmp_path), reports.SUMMARY)
    kept = spark.read.option("header", True).csv(report_path(str(tmp_path), reports.SUMMARY))
    assert kept.count() == 1


def test_instants_in_reports(spark):
    df = spark.sql("SELECT TIMESTAMP_LTZ '2024-01-01 05:00:00.5Z' AS t, CAST(NULL AS timestamp_ntz) AS n")
    assert tuple(report_text(df).first()) == ("2024-01-01 05:00:00", None)


def test_ingest_job(spark, tmp_path):
    (tmp_path / "in").mkdir()
    page = {"shifts": [
        {"id": "s1", "opened_at": "2024-01-02T00:00:00Z", "payments": [{"money_amount": 5}],
         "taxes": [{"id": "t"}], "cash_movements": []},
    ]}
    (tmp_path / "in" / "p.json").write_text(json.dumps(page))

    def run(window):
        return jobs.run_ingest(
            spark, "shifts", str(tmp_path / "in"), str(tmp_path / "staging"),
            str(tmp_path / "shifts"), window,
        )

    assert run((at("2024-01-02 00:00:00"), at("2024-01-03 00:00:00"))) == 1
    assert run((at("2024-01-05 00:00:00"), at("2024-01-06 00:00:00"))) == 0
    assert run(None) == 1
    rows = ingest.read_days(spark, "shifts", str(tmp_path / "shifts")).collect()
    assert [(r.id, r.payments, r.taxes) for r in rows] == [
        ("s1", ['{"money_amount":5}'], ['{"id":"t"}'])
    ]


def test_attendance_job(spark, tmp_path):
    payload = {"Date": "2025-06-01", "Full Name": "Ann", "EntryType": "In", "Time": "05:00:00"}
    raw = spark.createDataFrame(
        [(json.dumps(payload), at("2025-06-01 00:00:00"))], "payload string, load_dt timestamp_ntz"
    )
    for _ in range(2):
        jobs.run_attendance(spark, raw, str(tmp_path / "final"))
    got = attendance.read_attendance(spark, str(tmp_path / "final"))
    assert got.columns == schemas.ATTENDANCE.fieldNames()
    assert bag(got, "full_name") == {("Ann",): 1}


def test_pull_windows():
    now = at("2024-01-16 01:30:00")
    assert jobs.pull_window("all", now, None, None) is None
    assert jobs.pull_window("rolling", now, None, None)[0] == at("2024-01-14 16:00:00")
    assert jobs.pull_window("previous-day", now, None, None)[1] == at("2024-01-15 15:59:59")
    assert jobs.pull_window("days", now, "2024-01-05", "2024-01-09")[0] == at("2024-01-04 16:00:00")


def test_granular_report_is_sorted(spark, tmp_path):
    df = spark.createDataFrame(
        [("b", 1.0, "2", at("2024-01-01 05:00:00")), ("c", 2.0, "1", at("2024-01-02 05:00:00")),
         ("a", 3.0, "1", at("2024-01-03 05:00:00"))],
        "`Branch Name` string, x double, _store_id string, _opened timestamp_ntz",
    )
    assert write_report(df, str(tmp_path), reports.GRANULAR)
    lines = []
    for file in sorted((tmp_path / "granular_sales").glob("*.csv")):
        lines += file.read_text().splitlines()[1:]
    assert lines == ["c,2.0", "a,3.0", "b,1.0"]


def page(folder, pull, key, *records):
    path = folder / f"pull={pull}"
    path.mkdir(parents=True)
    (path / "p.json").write_text(json.dumps({key: list(records)}))


def test_every_job_in_order_on_one_set_of_folders(spark, tmp_path):
    """The command lines of the README, in its order."""
    def run(job, **options):
        argv = ["--as-of", "2024-01-20T00:00:00", job]
        for name, value in options.items():
            path = name in ("staging", "target", "shards", "fixed", "raw", "stores", "out", "work",
                            "landing", "shifts", "receipts")
            argv += ["--" + name.replace("_", "-"), str(tmp_path / value) if path else value]
        jobs.main(argv)

    def shift(number, moment, amount):
        return {"id": number, "opened_at": moment, "store_id": "1",
                "payments": [{"money_amount": amount}], "cash_movements": [], "taxes": [1]}

    def ids():
        return bag(ingest.read_days(spark, "shifts", str(tmp_path / "shifts")), "id")

    # Opened after 16:00 UTC: another local day than UTC day.
    x, y = shift("x", "2024-01-15T20:00:00Z", 1), shift("y", "2024-01-16T01:00:00Z", 2)
    page(tmp_path / "landing", "s1", "shifts", x, y)
    run("shards", landing="landing", shards="shards", pull="s1", window="all")
    days = dict(first="2024-01-01", last="2024-01-31")
    run("backfill", shards="shards", target="shifts", **days)
    run("backfill", shards="shards", target="shifts", **days)
    assert ids() == {("x",): 1, ("y",): 1}
    page(tmp_path / "landing", "s2", "shifts", dict(x, opened_at="2024-01-15T21:00:00Z"),
         shift("w", "2024-01-15T22:00:00Z", 3), dict(shift("n", "2024-01-15T22:00:00Z", 3), id=None))
    for _ in range(2):
        run("ingest", entity="shifts", landing="landing", staging="staging", target="shifts",
            pull="s2")
    assert ids() == {("w",): 1, ("x",): 1, ("y",): 1, (None,): 1}

    receipt = {"receipt_number": "1", "created_at": "2024-01-16T02:00:00Z", "store_id": "1",
               "line_items": [{"item_name": "Americano", "quantity": 1}]}
    for pull in ("r1", "r2"):
        page(tmp_path / "in", pull, "receipts", receipt, dict(receipt, receipt_number=pull))
    for pull in ("r1", "r2"):
        jobs.main(["ingest", "--entity", "receipts", "--landing", str(tmp_path / "in"), "--staging",
                   str(tmp_path / "staging"), "--target", str(tmp_path / "receipts"), "--pull", pull])
    got = ingest.read_days(spark, "receipts", str(tmp_path / "receipts"))
    assert bag(got, "receipt_number") == {("1",): 1, ("r1",): 1, ("r2",): 1}
    jobs.main(["stream", "--entity", "receipts", "--landing", str(tmp_path / "in"), "--target",
               str(tmp_path / "streamed"), "--work", str(tmp_path / "work")])
    streamed = ingest.read_days(spark, "receipts", str(tmp_path / "streamed"))
    assert bag(streamed, "receipt_number") == {("1",): 1, ("r1",): 1, ("r2",): 1}

    entry = {"startedAt": "2024-01-15T20:00:00Z", "type": "In", "person": {"name": "Ann"}}
    outside = dict(entry, startedAt="2024-01-10T20:00:00Z")
    for pull in ("t1", "t2"):
        page(tmp_path / "entries", pull, "data", entry, outside)
        for _ in range(2):
            jobs.main(["time-entries", "--landing", str(tmp_path / "entries"), "--raw",
                       str(tmp_path / "raw"), "--pull", pull, "--first", "2024-01-16", "--last",
                       "2024-01-16"])
        for _ in range(2):
            jobs.main(["attendance", "--raw", str(tmp_path / "raw"), "--target",
                       str(tmp_path / "final"), "--pull", pull])
    assert attendance.read_raw(spark, str(tmp_path / "raw")).count() == 2
    final = attendance.read_attendance(spark, str(tmp_path / "final")).collect()
    assert [(str(r.date), r.full_name, r.time_ts) for r in final] == [
        ("2024-01-16", "Ann", at("2024-01-15 20:00:00"))
    ]
    # No entries in the window: nothing is added.
    page(tmp_path / "entries", "t3", "data")
    jobs.main(["time-entries", "--landing", str(tmp_path / "entries"), "--raw",
               str(tmp_path / "raw"), "--pull", "t3"])
    assert attendance.read_raw(spark, str(tmp_path / "raw")).count() == 2

    (tmp_path / "stores.csv").write_text("store_id,store_name\n1,Main\n")
    run("reports", shifts="shifts", receipts="receipts", stores="stores.csv", out="out")
    assert (tmp_path / "out" / "summary_sales").exists()
    jobs.main(["--as-of", "2024-01-20T00:00:00", "kept-reports", "--shifts", str(tmp_path / "shifts"),
               "--kept", str(tmp_path / "kept"), "--stores", str(tmp_path / "stores.csv"), "--out",
               str(tmp_path / "kept-out")])
    both = [
        sorted({x for f in (tmp_path / out / "summary_sales").glob("*.csv") for x in f.read_text().splitlines()})
        for out in ("out", "kept-out")
    ]
    assert both[0] == both[1] and len(both[0]) == 2


def test_a_report_that_fails_leaves_the_old_one(spark, tmp_path):
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "Branch string, x double")
    assert write_report(df, str(tmp_path), reports.SUMMARY) and write_report(df, str(tmp_path), reports.SUMMARY)
    broken = df.withColumn("x", F.when(F.col("Branch") == "b", F.raise_error(F.lit("lost"))).otherwise(1.0))
    with pytest.raises(Exception, match="lost"):
        write_report(broken, str(tmp_path), reports.SUMMARY)
    assert [p.name for p in tmp_path.iterdir()] == ["summary_sales"]
    assert len(list((tmp_path / "summary_sales").glob("*.csv"))) >= 1


def test_repeated_store_ids_are_refused(spark, small, tmp_path):
    stores = spark.createDataFrame([("1", "a"), ("1", "b")], jobs.STORE_COLUMNS)
    with pytest.raises(ValueError, match="store id repeats"):
        jobs.run_reports(
            fx.shifts(spark, small), fx.receipts(spark, small), stores, str(tmp_path), fx.AS_OF
        )


def test_a_failed_run_is_repeated_from_what_it_staged(spark, tmp_path, monkeypatch):
    record = {"id": None, "opened_at": "2024-01-02T00:00:00Z"}
    page(tmp_path / "in", "p", "shifts", record, dict(record, id="a"))

    def run():
        return jobs.run_ingest(
            spark, "shifts", str(tmp_path / "in"), str(tmp_path / "staging"),
            str(tmp_path / "shifts"), None, pull="p",
        )

    def died(*_):
        raise OSError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(jobs, "mark_pull", died)
        with pytest.raises(OSError):
            run()
    assert run() == 2 and run() == 0
    assert ingest.read_days(spark, "shifts", str(tmp_path / "shifts")).count() == 2
