"""The four branch reports.

Baselines differ on purpose: the sales-dip and ratio reports include the tested
days in their baseline, the summary and granular reports leave them out.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from branchlens.functions import clock
from branchlens.operators.baseline import (
    GROUP,
    sample_std,
    slot_baseline,
    slot_baseline_by_day,
)
from branchlens.operators.interval_join import interval_join, interval_totals
from branchlens.operators.lookup import UNKNOWN_STORE, lookup_with_default, with_group_stats
from branchlens.plans.shift_fact import (
    ANALYSIS_DAYS,
    BASELINE_DAYS,
    add_slot,
    recent_shifts,
)

# Thresholds, the two compared items (numerator, denominator),
# report names and reason texts.
K_SIGMA = 1.8
HARD_RATIO = 0.6
RATIO_LIMIT = 0.6
NO_DENOMINATOR = 9.99
ITEMS = ("Americano", "Spanish Latte")
REASON_RATIO = "High {} Ratio"
REASON_DIP = "Low {} Sales"
SALES_DIP, RATIO, SUMMARY, GRANULAR = (
    "Sales Dip Anomalies", "Ratio Anomalies", "Summary Sales", "Granular Sales",
)

SALES_DIP_COLUMNS = [
    "shift_number", "shift_opening_time", "shift_closing_time", "store_id", "total_sales",
    "day_of_week", "hour_of_day", "store_name", "day_name", "time_slot", "shift_slot",
    "avg_sales", "std_sales", "anomaly_threshold", "is_stat_anomaly", "is_hard_rule_anomaly",
    "is_suspicious",
]


def is_recent(
    local: str, as_of: datetime, analysis_days: int = ANALYSIS_DAYS, tz: str = clock.LOCAL_TZ
) -> Column:
    """Whether a local opening time lies in the tested window, its start included."""
    start = clock.ntz_literal(clock.as_utc(as_of) - timedelta(days=analysis_days))
    return F.col(local) >= clock.to_local(start, tz)


def _flag(condition: Column) -> Column:
    """Unknown counts as not flagged."""
    return F.coalesce(condition, F.lit(False))


def dip_flags(df: DataFrame, k_sigma: float, hard_ratio: float) -> DataFrame:
    """Facts with their slot's statistics: those that fall under one of the rules."""
    flagged = (
        df.withColumn("anomaly_threshold", F.col("avg_sales") - k_sigma * F.col("std_sales"))
        .withColumn(
            "is_stat_anomaly",
            _flag(
                (F.col("total_sales") < F.col("anomaly_threshold")) & (F.col("std_sales") > 0)
            ),
        )
        .withColumn(
            "is_hard_rule_anomaly",
            _flag(F.col("total_sales") < F.col("avg_sales") * hard_ratio),
        )
        .withColumn("is_suspicious", F.col("is_stat_anomaly") | F.col("is_hard_rule_anomaly"))
    )
    return flagged.where("is_suspicious").select(*SALES_DIP_COLUMNS)


def sales_dip_anomalies(
    facts: DataFrame,
    as_of: datetime,
    analysis_days: int = ANALYSIS_DAYS,
    k_sigma: float = K_SIGMA,
    hard_ratio: float = HARD_RATIO,
    tz: str = clock.LOCAL_TZ,
    max_groups: int | None = None,
) -> DataFrame:
    """Recent shifts far below their slot's usual sales.

    Since a tested shift is part of its own baseline, the deviation rule needs
    at least six shifts per slot before 1.8 deviations can be reached.
    """
    recent = facts.where(is_recent("shift_opening_time", as_of, analysis_days, tz))
    judged = with_group_stats(recent, slot_baseline(facts), GROUP, max_groups)
    return dip_flags(judged, k_sigma, hard_ratio)


def sales_dip_window(
    facts: DataFrame,
    as_of: datetime,
    analysis_days: int = ANALYSIS_DAYS,
    k_sigma: float = K_SIGMA,
    hard_ratio: float = HARD_RATIO,
    tz: str = clock.LOCAL_TZ,
) -> DataFrame:
    """The sales-dip report with its baseline computed by window functions."""
    by_day = facts.withColumn("_day", F.to_date("shift_opening_time"))
    recent = by_day.where(is_recent("shift_opening_time", as_of, analysis_days, tz))
    judged = with_group_stats(recent, slot_baseline_by_day(by_day, "_day"), [*GROUP, "_day"])
    return dip_flags(judged, k_sigma, hard_ratio)


def summary_sales(
    facts: DataFrame,
    as_of: datetime,
    baseline_days: int = BASELINE_DAYS,
    analysis_days: int = ANALYSIS_DAYS,
    tz: str = clock.LOCAL_TZ,
) -> DataFrame:
    """Last week's sales per store next to the average earlier week.

    One pass over the facts. The divisor is the constant number of weeks before
    the tested window, whatever the data covers. Stores without recent shifts
    are left out; stores without earlier ones have a null average.
    """
    weeks = (baseline_days - analysis_days) / 7.0
    recent = is_recent("shift_opening_time", as_of, analysis_days, tz)
    earlier = F.sum(F.when(~recent, F.col("total_sales")))
    usual = earlier / F.lit(weeks) if weeks > 0 else F.when(earlier.isNotNull(), F.lit(0.0))
    return (
        facts.groupBy(F.col("store_name").alias("Branch"))
        .agg(
            F.sum(F.when(recent, F.col("total_sales"))).alias("Sales Amount (Past 7 Days)"),
            usual.alias("Sales Average per 7 Days"),
            F.count(F.when(recent, 1)).alias("_recent"),
        )
        .where(F.col("_recent") > 0)
        .drop("_recent")
    )


GRANULAR_ORDER = {"_store_id": "store_id", "_opened": "shift_opening_time"}


def granular_sales(
    facts: DataFrame,
    as_of: datetime,
    analysis_days: int = ANALYSIS_DAYS,
    tz: str = clock.LOCAL_TZ,
    max_groups: int | None = None,
    ordered: bool = False,
) -> DataFrame:
    """Each recent shift next to its slot's average over earlier shifts.

    ``ordered`` keeps store id and opening time as columns that the report sink
    sorts by and does not write.
    """
    recent = is_recent("shift_opening_time", as_of, analysis_days, tz)
    usual = (
        facts.where(~recent)
        .groupBy(*GROUP)
        .agg(F.avg("total_sales").alias("Average Historic Sales"))
    )
    return granular_columns(with_group_stats(facts.where(recent), usual, GROUP, max_groups), ordered)


def granular_columns(compared: DataFrame, ordered: bool = False) -> DataFrame:
    return compared.select(
        F.col("store_name").alias("Branch Name"),
        F.col("shift_slot").alias("Shift"),
        F.col("total_sales").alias("Actual Sales"),
        "Average Historic Sales",
        *[F.col(source).alias(key) for key, source in GRANULAR_ORDER.items() if ordered],
    )


# --- item ratio -----------------------------------------------------------


def open_intervals(
    shifts: DataFrame,
    as_of: datetime,
    baseline_days: int = BASELINE_DAYS,
    tz: str = clock.LOCAL_TZ,
    am: tuple[int, int] = clock.AM_HOURS,
    pm: tuple[int, int] = clock.PM_HOURS,
    max_open_days: int | None = None,
) -> DataFrame:
    """AM and PM shifts of the horizon as UTC intervals; open ones end ``as_of``.

    ``max_open_days`` optionally ends a never-closed shift that long after its
    opening; off by default.
    """
    scanned = recent_shifts(shifts, as_of, baseline_days)
    opened = clock.utc_wall(shifts, "opened_at")
    still_open = clock.ntz_literal(as_of)
    if max_open_days is not None:
        still_open = F.least(still_open, opened + F.expr(f"INTERVAL '{max_open_days}' DAY"))
    return scanned.where(clock.in_slot(clock.to_local(opened, tz), am, pm)).select(
        F.col("id").alias("shift_number"),
        "store_id",
        opened.alias("opened_at"),
        F.coalesce(clock.utc_wall(shifts, "closed_at"), still_open).alias("closed_at"),
    )


def receipt_items(
    receipts: DataFrame,
    as_of: datetime,
    items: tuple[str, str] = ITEMS,
    baseline_days: int = BASELINE_DAYS,
    tolerant: bool = False,
) -> DataFrame:
    """Line items of the wanted names from receipts of the horizon."""
    start = clock.moment_literal(
        receipts, "created_at", clock.as_utc(as_of) - timedelta(days=baseline_days)
    )
    quantity = F.col("_quantity")
    return (
        receipts.where(F.col("created_at") >= start)
        .select(
            "store_id",
            clock.utc_wall(receipts, "created_at").alias("created_at"),
            F.explode("line_items").alias("_item"),
        )
        .select(
            "store_id",
            "created_at",
            F.json_tuple("_item", "item_name", "quantity").alias("name", "_quantity"),
        )
        .where(F.col("name").isin(*items))
        .select(
            "store_id",
            "created_at",
            "name",
            (quantity.try_cast("double") if tolerant else quantity.cast("double")).alias(
                "quantity"
            ),
        )
    )


def shift_item_join(
    shifts: DataFrame,
    sales: DataFrame,
    as_of: datetime,
    baseline_days: int = BASELINE_DAYS,
    tz: str = clock.LOCAL_TZ,
) -> DataFrame:
    """One row per item sold and shift it falls into; ``sales`` as of :func:`receipt_items`.

    The items are read twice, so stage them first.
    """
    joined = interval_join(
        sales,
        open_intervals(shifts, as_of, baseline_days, tz),
        key="store_id",
        at="created_at",
        start="opened_at",
        end="closed_at",
    )
    return joined.select(
        "shift_number",
        F.col("opened_at").alias("shift_opening_time"),
        "store_id",
        "name",
        "quantity",
    )


def shift_items(
    shifts: DataFrame,
    sales: DataFrame,
    as_of: datetime,
    items: tuple[str, str] = ITEMS,
    baseline_days: int = BASELINE_DAYS,
    tz: str = clock.LOCAL_TZ,
) -> DataFrame:
    """Quantity of each wanted item per shift, one column per item.

    ``sales`` as of :func:`receipt_items`; they are read once. Only shifts that sold at
    least one of the items appear; those without id or store are left out.
    """
    totals = interval_totals(
        sales,
        open_intervals(shifts, as_of, baseline_days, tz).where(F.col("shift_number").isNotNull()),
        key="store_id",
        at="created_at",
        start="opened_at",
        end="closed_at",
        group="name",
        value="quantity",
        groups=items,
        interval_columns=["shift_number", "opened_at", "store_id"],
    )
    return totals.withColumnRenamed("opened_at", "shift_opening_time")


def _slug(item: str) -> str:
    return item.lower().replace(" ", "_")


def ratio_columns(items: tuple[str, str]) -> dict[str, str]:
    """Report column names for a pair of items; only one deviation is renamed."""
    numerator, denominator = items
    top, bottom = _slug(numerator), _slug(denominator)
    short = bottom.rsplit("_", 1)[-1]
    return {
        "avg_top": f"avg_{top}",
        "std_top": f"{numerator}_std",
        "avg_bottom": f"avg_{bottom}",
        "std_bottom": f"std_{bottom}",
        "ratio": f"{top}_vs_{bottom}_pct",
        "threshold": f"{short}_anomaly_threshold",
        "dip": f"is_{short}_dip_anomaly",
    }


def ratio_anomalies(
    sold: DataFrame,
    stores: DataFrame,
    as_of: datetime,
    items: tuple[str, str] = ITEMS,
    analysis_days: int = ANALYSIS_DAYS,
    k_sigma: float = K_SIGMA,
    ratio_limit: float = RATIO_LIMIT,
    sentinel: float = NO_DENOMINATOR,
    tz: str = clock.LOCAL_TZ,
    store_rows: int | None = None,
    max_groups: int | None = None,
) -> DataFrame:
    """Recent shifts with too much of one item against the other, or too little of the other.

    ``sold`` is the table of :func:`shift_items`. It is read twice, once for the
    baseline and once for the tested shifts, so stage it first: otherwise the
    receipts are joined twice.
    """
    top, bottom = items
    names = ratio_columns(items)
    named = lookup_with_default(
        sold, stores, "store_id", "store_name", UNKNOWN_STORE, store_rows
    )
    local = named.withColumn("shift_opening_time", clock.to_local(F.col("shift_opening_time"), tz))
    facts = add_slot(local, "shift_opening_time").drop("day_of_week", "hour_of_day")

    usual = facts.groupBy(*GROUP).agg(
        F.avg(top).alias(names["avg_top"]),
        F.stddev_samp(top).alias(names["std_top"]),
        F.avg(bottom).alias(names["avg_bottom"]),
        sample_std(bottom).alias(names["std_bottom"]),
    )
    recent = facts.where(is_recent("shift_opening_time", as_of, analysis_days, tz))
    judged = with_group_stats(recent, usual, GROUP, max_groups)

    ratio, std = F.col(names["ratio"]), F.col(names["std_bottom"])
    flagged = (
        judged.withColumn(
            names["ratio"],
            F.when(F.col(bottom) > 0, F.col(top) / F.col(bottom)).when(
                (F.col(bottom) == 0) & (F.col(top) > 0), sentinel
            ),
        )
        .withColumn("is_ratio_anomaly", _flag(ratio > ratio_limit))
        .withColumn(names["threshold"], F.col(names["avg_bottom"]) - k_sigma * std)
        .withColumn(
            names["dip"], _flag((F.col(bottom) < F.col(names["threshold"])) & (std > 0))
        )
    )
    reason = F.concat_ws(
        ", ",
        F.when(F.col("is_ratio_anomaly"), REASON_RATIO.format(top)),
        F.when(F.col(names["dip"]), REASON_DIP.format(bottom)),
    )
    return (
        flagged.where(F.col("is_ratio_anomaly") | F.col(names["dip"]))
        .withColumn("Reason", reason)
        .select(
            "shift_number", "shift_opening_time", "store_id", top, bottom, "store_name",
            "day_name", "time_slot", "shift_slot",
            names["avg_top"], names["std_top"], names["avg_bottom"], names["std_bottom"],
            names["ratio"], "is_ratio_anomaly", names["threshold"], names["dip"], "Reason",
        )
    )


def all_reports(
    facts: DataFrame,
    sold: DataFrame,
    stores: DataFrame,
    as_of: datetime,
    store_rows: int | None = None,
    max_groups: int | None = None,
) -> dict[str, DataFrame]:
    """The four reports by name, from the staged shift fact and item table."""
    return {
        SALES_DIP: sales_dip_anomalies(facts, as_of, max_groups=max_groups),
        RATIO: ratio_anomalies(
            sold, stores, as_of, store_rows=store_rows, max_groups=max_groups
        ),
        SUMMARY: summary_sales(facts, as_of),
        GRANULAR: granular_sales(facts, as_of, max_groups=max_groups, ordered=True),
    }
