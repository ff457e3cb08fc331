from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from helpers import at, bag
from pyspark.sql import functions as F

from branchlens import fixtures as fx
from branchlens.operators import baseline, lookup
from branchlens.plans import reports
from branchlens.plans.shift_fact import shift_fact, shift_fact_sql
from branchlens.schemas import RECEIPTS, SHIFTS, conform

AS_OF = datetime(2024, 1, 31)
STORES = "store_id string, store_name string"


def shifts_of(spark, rows):
    """rows: id, store, opened, closed, amounts"""
    data = [
        (i, s, at(o), at(c) if c else None, None if a is None else [f'{{"money_amount":{x}}}' for x in a])
        for i, s, o, c, a in rows
    ]
    schema = (
        "id string, store_id string, opened_at timestamp_ntz, closed_at timestamp_ntz, "
        "payments array<string>"
    )
    return conform(spark.createDataFrame(data, schema), SHIFTS)


def receipts_of(spark, rows):
    """rows: store, created, [(item, quantity)]"""
    import json

    data = [
        (s, at(t), [json.dumps({"item_name": n, "quantity": q}) for n, q in items])
        for s, t, items in rows
    ]
    schema = "store_id string, created_at timestamp_ntz, line_items array<string>"
    return conform(spark.createDataFrame(data, schema), RECEIPTS)


@pytest.fixture
def stores(spark):
    return spark.createDataFrame([("1", "One"), ("2", "Two")], STORES)


def weekly(store, sales, last="2024-01-29 21:00:00"):
    """One Tuesday 05:00 local shift a week, the last given first."""
    end = at(last)
    return [
        (f"{store}-{n}", store, str(end - timedelta(weeks=n)), None, [x])
        for n, x in enumerate(sales)
    ]


def test_fact_columns_zones_and_defaults(spark, stores):
    shifts = shifts_of(
        spark,
        [
            ("a", "1", "2024-01-06 20:30:00", "2024-01-07 04:00:00", [1.5, 2]),
            ("b", "9", "2024-01-07 08:00:00", None, None),
            ("noon", "1", "2024-01-07 05:00:00", None, [1]),  # 13:00 local
            ("old", "1", "2023-11-01 23:59:59", None, [1]),
            ("edge", None, "2023-11-02 00:00:00", None, []),
        ],
    )
    rows = {r.shift_number: r for r in shift_fact(shifts, stores, AS_OF).collect()}
    assert set(rows) == {"a", "b", "edge"}
    a = rows["a"]
    assert a.shift_opening_time == at("2024-01-07 04:30:00")  # local
    assert a.shift_closing_time == at("2024-01-07 04:00:00")  # UTC
    assert (a.day_of_week, a.hour_of_day, a.day_name) == (1, 4, "Sun")
    assert (a.total_sales, a.store_name, a.shift_slot) == (3.5, "One", "Sun-AM")
    b = rows["b"]
    assert (b.total_sales, b.store_name, b.shift_slot) == (0.0, "Unknown Store", "Sun-PM")
    assert rows["edge"].store_name == "Unknown Store"
    assert bag(shift_fact_sql(shifts, stores, AS_OF)) == bag(shift_fact(shifts, stores, AS_OF))


def test_store_names_from_a_mapping(spark):
    stores = lookup.store_dimension(spark, {"1": "One"})
    rows = spark.createDataFrame([("1",), ("2",), (None,)], "store_id string")
    for checked in (1, None):
        got = lookup.lookup_with_default(
            rows, stores, "store_id", "store_name", lookup.UNKNOWN_STORE, checked
        )
        assert bag(got) == {
            ("1", "One"): 1, ("2", "Unknown Store"): 1, (None, "Unknown Store"): 1,
        }


def test_fact_from_instants(spark, stores):
    shifts = shifts_of(spark, [("a", "1", "2024-01-06 20:30:00", "2024-01-07 04:00:00", [1])])
    instants = shifts.withColumn("opened_at", F.expr("TIMESTAMP_LTZ '2024-01-06 20:30:00Z'"))
    instants = instants.withColumn("closed_at", F.expr("TIMESTAMP_LTZ '2024-01-07 04:00:00Z'"))
    assert bag(shift_fact(instants, stores, AS_OF)) == bag(shift_fact(shifts, stores, AS_OF))


def facts_of(spark, stores, rows):
    return shift_fact(shifts_of(spark, rows), stores, AS_OF)


def test_single_shift_has_no_deviation(spark, stores):
    row = baseline.slot_baseline(facts_of(spark, stores, weekly("1", [10]))).first()
    assert (row.avg_sales, row.std_sales) == (10.0, 0.0)


def test_sample_deviation(spark, stores):
    row = baseline.slot_baseline(facts_of(spark, stores, weekly("1", [1, 3]))).first()
    assert row.std_sales == pytest.approx(2**0.5)


def test_stat_rule_needs_six_shifts(spark, stores):
    def flags(sales):
        df = reports.sales_dip_anomalies(facts_of(spark, stores, weekly("1", sales)), AS_OF, hard_ratio=0)
        return [r.is_stat_anomaly for r in df.collect()]

    # The tested shift is part of its own baseline.
    assert flags([1, 100, 100, 100, 100]) == []
    assert flags([1, 100, 100, 100, 100, 100]) == [True]


def test_baseline_includes_recent_days(spark, stores):
    facts = facts_of(spark, stores, weekly("1", [10, 100]))
    row = reports.sales_dip_anomalies(facts, AS_OF).first()
    assert row.avg_sales == 55.0  # 100 without the tested shift
    assert row.anomaly_threshold == pytest.approx(55 - 1.8 * row.std_sales)
    assert (row.is_stat_anomaly, row.is_hard_rule_anomaly, row.is_suspicious) == (False, True, True)
    assert list(row.asDict()) == reports.SALES_DIP_COLUMNS


def test_rules_are_strict(spark, stores):
    # 60 is exactly 0.6 of the mean of 60 and 140.
    facts = facts_of(spark, stores, weekly("1", [60, 140]))
    assert reports.sales_dip_anomalies(facts, AS_OF).count() == 0
    flat = facts_of(spark, stores, weekly("1", [50, 50]))
    assert reports.sales_dip_anomalies(flat, AS_OF, hard_ratio=0).count() == 0


def test_recent_window_start_is_inclusive(spark, stores):
    facts = facts_of(
        spark, stores,
        [("in", "1", "2024-01-24 00:00:00", None, [1]), ("out", "1", "2024-01-23 23:59:59", None, [1])],
    )
    recent = facts.where(reports.is_recent("shift_opening_time", AS_OF)).collect()
    assert [r.shift_number for r in recent] == ["in"]


def test_window_form_equals_join_form(spark, small):
    facts = shift_fact(fx.shifts(spark, small), fx.stores(spark, small), fx.AS_OF)

    def rounded(df):
        names = ["avg_sales", "std_sales", "anomaly_threshold", "total_sales"]
        return bag(df.withColumns({n: F.round(n, 6) for n in names}))

    for k in (1.8, 1.0):
        joined = reports.sales_dip_anomalies(facts, fx.AS_OF, k_sigma=k)
        windowed = reports.sales_dip_window(facts, fx.AS_OF, k_sigma=k)
        assert rounded(joined) == rounded(windowed)
        assert joined.count() > 0


def test_broadcast_and_salted_joins_agree(spark, small, monkeypatch):
    stores = fx.stores(spark, small)
    rows, groups = lookup.store_bounds(stores)
    assert (rows, groups) == (25, 26 * 14)
    plain = shift_fact(fx.shifts(spark, small), stores, fx.AS_OF)
    sent = shift_fact(fx.shifts(spark, small), stores, fx.AS_OF, store_rows=rows)
    assert bag(plain) == bag(sent)
    assert bag(reports.granular_sales(plain, fx.AS_OF)) == bag(
        reports.granular_sales(sent, fx.AS_OF, max_groups=groups)
    )
    monkeypatch.setattr(lookup, "BROADCAST_ROWS", 3)
    assert lookup.store_bounds(stores) == (None, None)


def test_summary(spark, stores):
    facts = facts_of(
        spark, stores,
        weekly("1", [10, 83, 83]) + weekly("2", [5])
        + [("gone", "9", "2024-01-01 21:00:00", None, [7])],
    )
    got = {r[0]: (r[1], r[2]) for r in reports.summary_sales(facts, AS_OF).collect()}
    assert got["One"] == (10.0, pytest.approx(166 / (83 / 7)))
    assert got["Two"] == (5.0, None)  # no history
    assert set(got) == {"One", "Two"}  # no recent shifts, no row
    assert reports.summary_sales(facts, AS_OF).columns == [
        "Branch", "Sales Amount (Past 7 Days)", "Sales Average per 7 Days",
    ]


def test_granular_leaves_recent_days_out(spark, stores):
    facts = facts_of(spark, stores, weekly("1", [10, 100, 50]) + weekly("2", [5]))
    got = bag(reports.granular_sales(facts, AS_OF))
    assert got == {("One", "Tue-AM", 10.0, 75.0): 1, ("Two", "Tue-AM", 5.0, None): 1}


def test_unmapped_stores_pool(spark, stores):
    facts = facts_of(spark, stores, weekly("7", [10, 20]) + weekly("8", [30, 40]))
    row = baseline.slot_baseline(facts).collect()
    assert [(r.store_name, r.avg_sales) for r in row] == [("Unknown Store", 25.0)]


# --- item ratio -----------------------------------------------------------

OPEN = [("s1", "1", "2024-01-29 21:00:00", "2024-01-30 03:00:00", [])]


def sales_of(spark, rows):
    return reports.receipt_items(receipts_of(spark, rows), AS_OF)


def ratio(spark, stores, shifts, receipts, **options):
    sold = reports.shift_items(shifts_of(spark, shifts), sales_of(spark, receipts), AS_OF)
    return reports.ratio_anomalies(sold, stores, AS_OF, **options)


def test_items_on_both_ends_count_and_outside_do_not(spark):
    receipts = [
        ("1", "2024-01-29 21:00:00", [("Americano", 1), ("Cake", 9)]),
        ("1", "2024-01-30 03:00:00", [("Spanish Latte", 2.5)]),
        ("1", "2024-01-30 03:00:01", [("Americano", 50)]),
        ("2", "2024-01-29 22:00:00", [("Americano", 50)]),
        ("1", "2024-01-29 22:00:00", [("americano", 50)]),
    ]
    sold = reports.shift_items(shifts_of(spark, OPEN), sales_of(spark, receipts), AS_OF)
    row = sold.collect()
    assert [(r["Americano"], r["Spanish Latte"]) for r in row] == [(1.0, 2.5)]


def test_item_in_overlapping_shifts_counts_in_each(spark):
    shifts = OPEN + [("s2", "1", "2024-01-29 22:00:00", None, [])]
    receipts = [("1", "2024-01-29 23:00:00", [("Americano", 3)])]
    sold = reports.shift_items(shifts_of(spark, shifts), sales_of(spark, receipts), AS_OF)
    assert bag(sold, "shift_number", "Americano", "Spanish Latte") == {
        ("s1", 3.0, 0.0): 1, ("s2", 3.0, 0.0): 1,
    }
    pairs = reports.shift_item_join(
        shifts_of(spark, shifts), sales_of(spark, receipts), AS_OF
    )
    assert pairs.count() == 2


def test_ratio_guards(spark, stores):
    def row(items):
        receipts = [("1", "2024-01-29 22:00:00", items)]
        got = ratio(spark, stores, OPEN, receipts).collect()
        return got[0] if got else None

    # The sentinel stands in for a missing denominator.
    high = row([("Americano", 2)])
    assert high["americano_vs_spanish_latte_pct"] == 9.99
    assert (high.is_ratio_anomaly, high.is_latte_dip_anomaly) == (True, False)
    assert high.Reason == "High Americano Ratio"
    assert high["Americano_std"] is None and high["std_spanish_latte"] == 0.0
    assert row([("Americano", 7), ("Spanish Latte", 10)]).is_ratio_anomaly
    # Exactly 0.6 is not above it, and 0 to 0 has no ratio.
    assert row([("Americano", 3), ("Spanish Latte", 5)]) is None
    assert row([("Americano", 0), ("Spanish Latte", 0)]) is None
    # A line without quantity counts as nothing, but the shift appears.
    assert row([("Americano", None), ("Spanish Latte", 4)]) is None


def test_pivot_leaves_out_shifts_without_id(spark):
    rows = [("s", "a", 1.0), ("s", "a", None), ("s", "c", 5.0), (None, "a", 7.0)]
    sold = spark.createDataFrame(rows, "shift string, name string, quantity double")
    got = baseline.item_pivot(sold, ["shift"], ("a", "b"))
    assert bag(got) == {("s", 1.0, 0.0): 1}


def test_scalar_texts_only(spark):
    # A nested value is no number: it fails, or counts as nothing when tolerated.
    receipts = [("1", "2024-01-29 22:00:00", [("Americano", {"n": 1})])]
    made = receipts_of(spark, receipts)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        reports.receipt_items(made, AS_OF).collect()
    assert reports.receipt_items(made, AS_OF, tolerant=True).first().quantity is None


def test_both_reasons(spark, stores):
    weeks = range(6)
    shifts, receipts = [], []
    for n in weeks:
        opened = at("2024-01-29 21:00:00") - timedelta(weeks=n)
        shifts.append((f"s{n}", "1", str(opened), str(opened + timedelta(hours=2)), []))
        latte = 1 if n == 0 else 100
        receipts.append(
            ("1", str(opened), [("Americano", 5), ("Spanish Latte", latte)])
        )
    got = ratio(spark, stores, shifts, receipts).collect()
    assert [r.Reason for r in got] == ["High Americano Ratio, Low Spanish Latte Sales"]
    assert got[0].avg_spanish_latte == pytest.approx(501 / 6)
    assert ratio(spark, stores, shifts, receipts).columns == [
        "shift_number", "shift_opening_time", "store_id", "Americano", "Spanish Latte",
        "store_name", "day_name", "time_slot", "shift_slot", "avg_americano", "Americano_std",
        "avg_spanish_latte", "std_spanish_latte", "americano_vs_spanish_latte_pct",
        "is_ratio_anomaly", "latte_anomaly_threshold", "is_latte_dip_anomaly", "Reason",
    ]


def test_open_shift_cap_is_optional(spark):
    shifts = shifts_of(spark, [("s", "1", "2024-01-10 21:00:00", None, [])])
    ends = [
        reports.open_intervals(shifts, AS_OF, max_open_days=d).first()["closed_at"]
        for d in (None, 1)
    ]
    assert ends == [AS_OF, at("2024-01-11 21:00:00")]


# Row counts of the derivation with 25 stores, 17 of them named, worked out
# independently in SQL.
def test_known_counts(spark, medium):
    shifts = fx.shifts(spark, medium, n_stores=25)
    named = fx.stores(spark, medium).where(F.col("store_id").cast("int") < 17)
    facts = shift_fact(shifts, named, fx.AS_OF).persist()
    sales = reports.receipt_items(fx.receipts(spark, medium, n_stores=25), fx.AS_OF)
    sold = reports.shift_items(shifts, sales, fx.AS_OF).persist()
    recent = reports.is_recent("shift_opening_time", fx.AS_OF)
    dips = {k: reports.sales_dip_anomalies(facts, fx.AS_OF, k_sigma=k) for k in (1.8, 1.0)}
    ratios = {k: reports.ratio_anomalies(sold, named, fx.AS_OF, k_sigma=k) for k in (1.8, 1.0)}
    assert shifts.count() == 2848
    assert facts.count() == 1499
    assert facts.where(recent).count() == 343
    assert [dips[k].where("is_stat_anomaly").count() for k in (1.8, 1.0)] == [0, 48]
    assert dips[1.8].where("is_hard_rule_anomaly").count() == 113
    assert sold.count() == 1241
    assert ratios[1.8].where("is_ratio_anomaly").count() == 186
    assert [ratios[k].where("is_latte_dip_anomaly").count() for k in (1.8, 1.0)] == [0, 27]
    assert reports.summary_sales(facts, fx.AS_OF).count() == 18
    facts.unpersist()
    sold.unpersist()
