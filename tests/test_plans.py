"""What the physical plans may not contain, and what must reach the scans."""

from __future__ import annotations

import pytest
from helpers import final_plan, plan

import __spark_entry__ as entry_point
from branchlens import fixtures as fx
from branchlens.operators import lookup
from branchlens.plans import reports
from branchlens.plans.shift_fact import shift_fact
from branchlens.sources.tables import replace_table

FORBIDDEN = ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython")


@pytest.mark.parametrize("name", sorted(entry_point.queries()))
def test_no_pair_joins_and_no_python(spark, small, name):
    text = plan(entry_point.queries()[name](spark, small))
    for operator in FORBIDDEN:
        assert operator not in text


def test_horizon_reaches_the_shift_scan(spark, small, tmp_path):
    shifts = replace_table(fx.shifts(spark, small), str(tmp_path / "shifts"))
    text = plan(shift_fact(shifts, fx.stores(spark, small), fx.AS_OF))
    assert "GreaterThanOrEqual(opened_at" in text
    scan = text[text.index("PushedFilters"):]
    assert "pos_device_id" not in scan  # pruned


def test_horizon_reaches_the_receipt_scan(spark, small, tmp_path):
    receipts = replace_table(fx.receipts(spark, small), str(tmp_path / "receipts"))
    text = plan(reports.receipt_items(receipts, fx.AS_OF))
    assert "GreaterThanOrEqual(created_at" in text
    assert "ReadSchema: struct<created_at:timestamp_ntz,line_items:array<string>,store_id:string>" in text


def test_recent_filter_reaches_the_fact_scan(spark, small, tmp_path):
    facts = shift_fact(fx.shifts(spark, small), fx.stores(spark, small), fx.AS_OF)
    staged = replace_table(facts, str(tmp_path / "facts"))
    recent = staged.where(reports.is_recent("shift_opening_time", fx.AS_OF))
    assert "GreaterThanOrEqual(shift_opening_time" in plan(recent)


def test_bounded_groups_leave_the_facts_unshuffled(spark, small, tmp_path):
    stores = fx.stores(spark, small)
    facts = shift_fact(fx.shifts(spark, small), stores, fx.AS_OF)
    staged = replace_table(facts, str(tmp_path / "facts"))
    _, groups = lookup.store_bounds(stores)
    text = final_plan(reports.sales_dip_anomalies(staged, fx.AS_OF, max_groups=groups))
    # The only shuffle is the baseline's own, on partial sums.
    assert text.count("Exchange hashpartitioning") == 1
    assert "SortMergeJoin" not in text


def test_unbounded_groups_are_salted(spark, small):
    facts = shift_fact(fx.shifts(spark, small), fx.stores(spark, small), fx.AS_OF)
    text = plan(reports.granular_sales(facts, fx.AS_OF))
    assert "_salt" in text


def test_summary_is_one_pass(spark, small, tmp_path):
    facts = shift_fact(fx.shifts(spark, small), fx.stores(spark, small), fx.AS_OF)
    staged = replace_table(facts, str(tmp_path / "facts"))
    text = plan(reports.summary_sales(staged, fx.AS_OF))
    assert text.split("Initial Plan")[0].count("FileScan") == 1
