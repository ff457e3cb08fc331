"""Batch entry points: ``python -m branchlens.jobs <job>``; ``--help`` lists the jobs."""

from __future__ import annotations

import argparse
import hashlib
import json
from collections.abc import Callable
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession

from branchlens import schemas
from branchlens.functions import clock
from branchlens.operators.lookup import store_bounds
from branchlens.plans import attendance, drift, ingest, moments, reports
from branchlens.plans.shift_fact import BASELINE_DAYS, shift_fact
from branchlens.session import build_session, fresh_path, shared_dir
from branchlens.sources.files import drop_staged, require_new_path
from branchlens.sources.landing import Quarantine
from branchlens.sources.report_sink import write_report
from branchlens.sources.tables import mark_pull, pull_is_done, replace_table
from branchlens.streaming.upsert import stream_ingest

STORE_COLUMNS = "store_id string, store_name string"


def run_reports(
    shifts: DataFrame, receipts: DataFrame, stores: DataFrame, folder: str, as_of: datetime
) -> dict[str, bool]:
    """Write the four reports; tells for each whether it had rows.

    The shift fact and the item table are written once to the shared folder. One ``as_of``
    serves every window.
    """
    spark = shifts.sparkSession
    store_rows, groups = store_bounds(stores)
    paths = {name: fresh_path(spark, name) for name in ("shift_fact", "shift_items")}
    try:
        facts = replace_table(
            shift_fact(shifts, stores, as_of, store_rows=store_rows), paths["shift_fact"]
        )
        sales = reports.receipt_items(receipts, as_of)
        sold = replace_table(reports.shift_items(shifts, sales, as_of), paths["shift_items"])
        built = reports.all_reports(facts, sold, stores, as_of, store_rows, groups)
        return {name: write_report(df, folder, name) for name, df in built.items()}
    finally:
        for path in paths.values():
            drop_staged(spark, path)


def run_kept_reports(
    spark: SparkSession, shifts: str, kept: str, stores: DataFrame, folder: str, as_of: datetime
) -> dict[str, bool]:
    """Refresh the kept moments of the shift table at ``shifts`` and write the three sales reports from them.

    Of the shifts only changed days, tested days and days that a window cuts are read.
    """
    moments.refresh_moments(spark, shifts, kept)
    store_rows, groups = store_bounds(stores)
    path = fresh_path(spark, "recent_facts")
    try:
        built = moments.KeptReports(spark, shifts, kept, stores, as_of, store_rows, groups)
        facts = replace_table(built.recent_facts(), path)
        written = {
            reports.SALES_DIP: built.sales_dip(facts=facts),
            reports.SUMMARY: built.summary(facts),
            reports.GRANULAR: built.granular(facts, ordered=True),
        }
        return {name: write_report(df, folder, name) for name, df in written.items()}
    finally:
        drop_staged(spark, path)


def work_path(spark: SparkSession, target: str, pull: str | None) -> str | None:
    """Where the merge of a named pull is staged; the same in every run of it."""
    if pull is None:
        return None
    table = hashlib.sha256(target.rstrip("/").encode()).hexdigest()[:16]
    return f"{shared_dir(spark)}/branchlens/work/{table}/{pull}"


def _merge_pull(
    spark: SparkSession, target: str, pull: str | None, merge: Callable[[str | None], None]
) -> None:
    """Merge a pull and note it as done, so that a repeated run adds nothing.

    A run that died is repeated: from what it staged if the table is still as it was then,
    else by merging anew, so later pulls are not undone.
    """
    work = work_path(spark, target, pull)
    merge(work)
    mark_pull(spark, target, pull)
    if work is not None:
        drop_staged(spark, work)


def run_ingest(
    spark: SparkSession,
    entity: str,
    landing: str,
    staging: str,
    target: str,
    window: tuple[datetime, datetime] | None,
    mode: str = "upsert",
    on_duplicate: str = "error",
    pull: str | None = None,
    quarantine: Quarantine | None = None,
    drift_path: str | None = None,
) -> int:
    """Stage landed records and merge them into the day-partitioned table.

    Returns the number of staged rows; an empty batch merges nothing, and so
    does a named pull that was merged before. ``quarantine`` takes broken lines, and
    the table at ``drift_path`` notes fields that differ from the schema.
    """
    if pull_is_done(spark, target, pull):
        return 0
    staged, rows = ingest.stage(
        spark, entity, landing, f"{staging}/{entity}", window, pull, quarantine
    )
    if drift_path is not None:
        drift.record_drift(spark, landing, entity, drift_path, pull, quarantine)
    if rows:
        _merge_pull(
            spark, target, pull,
            lambda work: ingest.merge_days(
                spark, entity, staged, target, mode, on_duplicate, work
            ),
        )
    return rows


def run_attendance(
    spark: SparkSession,
    raw: DataFrame,
    target: str,
    on_duplicate: str = "error",
    pull: str | None = None,
) -> None:
    """Parse raw attendance rows and upsert them into the final table, partitioned by date.

    Takes ``payload, load_dt`` rows or those of the raw time-entry table.
    """
    if pull_is_done(spark, target, pull):
        return
    if "payload" not in raw.columns:
        raw = attendance.entry_payloads(raw)
    path = fresh_path(spark, "attendance_staged")
    try:
        staged = attendance.stage_payloads(raw, path)
        _merge_pull(
            spark, target, pull,
            lambda work: attendance.merge_attendance(spark, staged, target, on_duplicate, work),
        )
    finally:
        drop_staged(spark, path)


def run_backfill(
    spark: SparkSession, shards: str, first: str, last: str, target: str
) -> None:
    """Add the shifts of a local day range of shards to the day-partitioned shift table.

    The days may differ in the types of their columns.
    """
    rows = ingest.shard_union(spark, shards, ingest.DAY, first, last, schemas.SHIFTS)
    ingest.backfill_days(spark, rows, ingest.DAY, first, last, target)


def run_fix_shards(spark: SparkSession, shards: str, first: str, last: str, fixed: str) -> None:
    """Write a day range of wide shards, repaired, to a table of its own.

    Days that differ in types are brought to the wide schema, their lists as JSON text.
    """
    require_new_path(spark, shards, fixed)
    frames = ingest.shard_frames(spark, shards, ingest.DAY, first, last)
    if len(frames) == 1:
        rows = frames[0]
    else:
        rows = ingest.shard_union(spark, shards, ingest.DAY, first, last, schemas.SHIFTS_WIDE)
    ingest.rewrite_shards(rows, ingest.DAY, first, last, fixed)


def pull_window(kind: str, now: datetime, first: str | None, last: str | None):
    if kind == "rolling":
        return clock.rolling_window(now)
    if kind == "previous-day":
        return clock.previous_day(now)
    if kind == "days":
        days = [date.fromisoformat(d) if d else None for d in (first, last)]
        return clock.day_range(now, *days)
    return None


WINDOWS = ["rolling", "previous-day", "days", "all"]


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--as-of", help="UTC moment in ISO form; now by default")
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(name: str, *required: str) -> argparse.ArgumentParser:
        added = jobs.add_parser(name)
        for option in required:
            added.add_argument(f"--{option}", required=True)
        return added

    def pulled(added: argparse.ArgumentParser, window: str | None = None) -> None:
        added.add_argument("--pull", help="read only <landing>/pull=<name>; merged once")
        if window is not None:
            added.add_argument("--window", choices=WINDOWS, default=window)
            added.add_argument("--first")
            added.add_argument("--last")

    def merging(added: argparse.ArgumentParser, on_duplicate: str) -> None:
        added.add_argument("--on-duplicate", choices=["error", "latest"], default=on_duplicate)

    def of_entity(added: argparse.ArgumentParser) -> None:
        added.add_argument("--entity", choices=sorted(schemas.SCHEMAS), required=True)
        added.add_argument("--mode", choices=["upsert", "insert"], default="upsert")

    def setting_aside(added: argparse.ArgumentParser) -> None:
        added.add_argument("--quarantine", help="table that takes lines which are no JSON")
        added.add_argument("--broken-limit", type=int, default=Quarantine.limit)

    job("reports", "shifts", "receipts", "stores", "out")
    job("kept-reports", "shifts", "kept", "stores", "out")
    added = job("ingest", "landing", "staging", "target")
    of_entity(added)
    merging(added, "error")
    pulled(added, "all")
    setting_aside(added)
    added.add_argument("--drift", help="table that notes fields which differ from the schema")
    added = job("stream", "landing", "target", "work")
    of_entity(added)
    merging(added, "latest")
    setting_aside(added)
    added.add_argument("--seen-within", help="with --mode insert: how long arrived keys are remembered")
    pulled(job("shards", "landing", "shards"), "previous-day")
    job("backfill", "shards", "target", "first", "last")
    job("fix-shards", "shards", "fixed", "first", "last")
    added = job("time-entries", "landing", "raw")
    pulled(added, "days")
    setting_aside(added)
    added = job("attendance", "raw", "target")
    merging(added, "error")
    pulled(added)
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    args = _arguments(argv)
    spark = build_session("branchlens")
    now = datetime.now(timezone.utc)
    as_of = datetime.fromisoformat(args.as_of) if args.as_of else now
    window = pull_window(args.window, as_of, args.first, args.last) if "window" in args else None
    aside = None
    if "quarantine" in args and args.quarantine:
        aside = Quarantine(args.quarantine, args.broken_limit)
    done: dict[str, object] = {"job": args.job}
    if args.job == "reports":
        horizon = clock.as_utc(as_of) - timedelta(days=BASELINE_DAYS)
        done["written"] = run_reports(
            ingest.read_days(spark, "shifts", args.shifts, horizon),
            ingest.read_days(spark, "receipts", args.receipts, horizon),
            spark.read.schema(STORE_COLUMNS).option("header", True).csv(args.stores),
            args.out,
            as_of,
        )
    elif args.job == "ingest":
        done["rows"] = run_ingest(
            spark, args.entity, args.landing, args.staging, args.target, window,
            args.mode, args.on_duplicate, args.pull, aside, args.drift,
        )
    elif args.job == "kept-reports":
        stores = spark.read.schema(STORE_COLUMNS).option("header", True).csv(args.stores)
        done["written"] = run_kept_reports(
            spark, args.shifts, args.kept, stores, args.out, as_of
        )
    elif args.job == "stream":
        stream_ingest(
            spark, args.entity, args.landing, args.target, args.work, args.mode,
            args.on_duplicate, quarantine=aside, seen_within=args.seen_within,
        ).awaitTermination()
    elif args.job == "shards":
        ingest.stage_shards(spark, args.landing, args.shards, window, pull=args.pull)
    elif args.job == "backfill":
        run_backfill(spark, args.shards, args.first, args.last, args.target)
    elif args.job == "fix-shards":
        run_fix_shards(spark, args.shards, args.first, args.last, args.fixed)
    elif args.job == "time-entries":
        done["rows"] = attendance.append_entries(
            spark, args.landing, args.raw, window, args.pull, as_of, aside
        )
    else:
        raw = attendance.read_raw(spark, args.raw, args.pull)
        run_attendance(spark, raw, args.target, args.on_duplicate, args.pull)
    print(json.dumps(done))


if __name__ == "__main__":
    main()
