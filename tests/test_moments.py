"""Kept baselines against those computed from all shifts."""

from __future__ import annotations

import json
import re
from datetime import timedelta

import pytest
from helpers import at, bag, plan
from pyspark.sql import functions as F

from branchlens import fixtures as fx
from branchlens.operators.baseline import slot_baseline
from branchlens.operators.lookup import store_bounds
from branchlens.plans import ingest, moments, reports
from branchlens.plans.shift_fact import shift_fact
from branchlens.sources.files import folder_names, path_exists

AS_OF = at("2024-01-28 13:30:00")  # cuts the first and the tested day


@pytest.fixture(scope="module")
def shifts(spark, small, tmp_path_factory):
    """Shifts of both halves of a quarter, so that the horizon leaves some out."""
    folder = str(tmp_path_factory.mktemp("shifts") / "all")
    rows = fx.shifts(spark, small)
    older = rows.withColumns(
        {
            "id": F.concat(F.lit("o"), F.col("id")),
            "opened_at": F.col("opened_at") - F.expr("INTERVAL 80 DAY"),
            "closed_at": F.col("closed_at") - F.expr("INTERVAL 80 DAY"),
        }
    )
    rows.unionByName(older).write.parquet(folder)
    return spark.read.parquet(folder)


def rounded(df):
    return bag(df.select(*[F.round(f.name, 6).alias(f.name) if f.dataType.typeName() == "double" else f.name for f in df.schema]))


def both(spark, small, table, kept, as_of=AS_OF):
    stores = fx.stores(spark, small)
    rows, groups = store_bounds(stores)
    facts = shift_fact(ingest.read_days(spark, "shifts", table), stores, as_of, store_rows=rows)
    return facts, moments.KeptReports(spark, table, kept, stores, as_of, rows, groups)


@pytest.mark.parametrize("as_of", [AS_OF, at("2024-01-30 00:00:00")])
def test_reports_equal_those_from_all_facts(spark, small, shifts, tmp_path, as_of):
    table, kept = str(tmp_path / "t"), str(tmp_path / "kept")
    ingest.merge_days(spark, "shifts", shifts, table)
    moments.refresh_moments(spark, table, kept)
    facts, built = both(spark, small, table, kept, as_of)
    horizon = as_of - timedelta(days=90)
    assert facts.count() < shift_fact(shifts, fx.stores(spark, small), as_of, 1000).count()
    assert facts.where(F.col("shift_opening_time") < F.lit(horizon + timedelta(hours=8))).count() == 0
    assert rounded(built.baseline()) == rounded(slot_baseline(facts))
    for k in (1.0, 0.3):
        assert rounded(built.sales_dip(k)) == rounded(reports.sales_dip_anomalies(facts, as_of, k_sigma=k))
    assert rounded(built.summary()) == rounded(reports.summary_sales(facts, as_of))
    assert rounded(built.granular()) == rounded(reports.granular_sales(facts, as_of))


def test_only_changed_days_are_computed_anew(spark, small, shifts, tmp_path):
    table, kept = str(tmp_path / "t"), str(tmp_path / "kept")
    ingest.merge_days(spark, "shifts", shifts, table)
    first = moments.refresh_moments(spark, table, kept)
    assert first == [n.partition("=")[2] for n in folder_names(spark, table) if n.startswith("ds=")]
    assert moments.refresh_moments(spark, table, kept) == []
    # All shifts of a day move to the next one: the day goes, the next one changes.
    day = F.to_date("opened_at") == F.lit("2024-01-12").cast("date")
    moved = shifts.where(day).withColumn("opened_at", F.col("opened_at") + F.expr("INTERVAL 1 DAY"))
    ingest.merge_days(spark, "shifts", moved, table)
    assert moments.refresh_moments(spark, table, kept) == ["2024-01-13"]
    assert not path_exists(spark, f"{kept}/ds=2024-01-12")
    facts, built = both(spark, small, table, kept)
    assert rounded(built.baseline()) == rounded(slot_baseline(facts))
    state = json.loads((tmp_path / "kept" / "_days.json").read_text())
    assert "2024-01-12" not in state and len(state) == len(first) - 1


def test_a_day_without_shifts_in_slot_hours_has_no_moments(spark, small, tmp_path):
    table, kept = str(tmp_path / "t"), str(tmp_path / "kept")
    one = fx.shifts(spark, small).orderBy("id").limit(1)
    rows = one.withColumn("opened_at", F.lit(at("2024-01-05 06:00:00")).cast("timestamp_ntz"))
    ingest.merge_days(spark, "shifts", rows, table)  # 14:00 local, between the slots
    assert moments.refresh_moments(spark, table, kept) == ["2024-01-05"]
    assert both(spark, small, table, kept)[1].baseline().count() == 0
    inside = rows.withColumn("opened_at", F.lit(at("2024-01-05 01:00:00")).cast("timestamp_ntz"))
    ingest.merge_days(spark, "shifts", inside, table)
    moments.refresh_moments(spark, table, kept)
    assert both(spark, small, table, kept)[1].baseline().count() == 1
    ingest.merge_days(spark, "shifts", rows, table)
    moments.refresh_moments(spark, table, kept)
    assert not path_exists(spark, f"{kept}/ds=2024-01-05")


def test_baselines_read_no_shifts_but_those_of_cut_days(spark, small, shifts, tmp_path):
    table, kept = str(tmp_path / "t"), str(tmp_path / "kept")
    ingest.merge_days(spark, "shifts", shifts, table)
    moments.refresh_moments(spark, table, kept)
    whole = both(spark, small, table, kept, at("2024-01-30 00:00:00"))[1].baseline()
    assert "payments" not in plan(whole)
    cut = both(spark, small, table, kept)[1].baseline()
    assert re.search(r"PartitionFilters: [^\]]*ds#\d+ (=|IN) \(?2023-10-30", plan(cut))
