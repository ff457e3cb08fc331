"""Retail-shaped inputs derived from the test tables.

Everything here is row-local or an aggregate that combines on the map side:
event rows become receipts, their sums become shifts. No rows are left out.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from branchlens.functions import clock
from branchlens.functions.nested import KEEP_NULLS
from branchlens.schemas import RECEIPTS, SHIFTS, conform

AS_OF = datetime(2024, 1, 31)
# Users fall into 30 stores; the nation table names 25 of them.
STORES = 30
OPEN_SINCE = "2024-01-30"
EVENT_TYPES = ("signup", "purchase", "error", "view", "click")
ITEM_NAMES = {"click": "Americano", "purchase": "Spanish Latte"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def store_of(user: str = "user_id", stores: int = STORES) -> Column:
    return (F.col(user) % stores).cast("string")


def quantity() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("string").alias("store_id"), F.col("n_name").alias("store_name")
    )


def receipts(spark: SparkSession, sf_dir: str, n_stores: int = STORES) -> DataFrame:
    """One receipt per event, with the event's item and a bag."""
    name = F.col("event_type")
    for event_type, item in ITEM_NAMES.items():
        name = F.when(F.col("event_type") == event_type, item).otherwise(name)
    sold = F.to_json(F.struct(name.alias("item_name"), quantity().alias("quantity")))
    bag = F.to_json(F.struct(F.lit("Paper Bag").alias("item_name"), F.lit(1).alias("quantity")))
    rows = table(spark, sf_dir, "events").select(
        F.concat(F.lit("R"), F.col("event_id")).alias("receipt_number"),
        F.when(F.col("event_type") == "error", "REFUND").otherwise("SALE").alias("receipt_type"),
        F.lit("point of sale").alias("source"),
        F.col("ts").alias("created_at"),
        F.col("ts").alias("updated_at"),
        F.col("value").alias("total_money"),
        F.array(sold, bag).alias("line_items"),
        F.array(F.to_json(F.struct(F.col("value").alias("money_amount")))).alias("payments"),
        store_of(stores=n_stores).alias("store_id"),
    )
    return conform(rows, RECEIPTS)


def shifts(spark: SparkSession, sf_dir: str, n_stores: int = STORES) -> DataFrame:
    """One shift per store, local date and hour block, paid per event type.

    Shifts of the last two local days are still open.
    """
    local = clock.to_local(F.col("ts"))
    hour = F.hour(local)
    block = F.when(hour < 4, "N").when(hour.between(12, 15), "M").otherwise(clock.time_slot(hour))
    day = F.to_date(local)

    def paid(event_type: str) -> Column:
        if event_type == "other":
            wanted = ~F.col("event_type").isin(*EVENT_TYPES)
        else:
            wanted = F.col("event_type") == event_type
        return F.sum(F.when(wanted, F.col("value"))).alias(f"paid_{event_type}")

    kinds = (*EVENT_TYPES, "other")
    sums = (
        table(spark, sf_dir, "events")
        .groupBy(store_of(stores=n_stores).alias("store_id"), day.alias("day"), block.alias("block"))
        .agg(
            F.min("ts").alias("opened_at"), F.max("ts").alias("last_at"), *[paid(k) for k in kinds]
        )
    )
    payments = F.filter(
        F.array(
            *[
                F.when(
                    F.col(f"paid_{k}").isNotNull(),
                    F.to_json(
                        F.struct(F.lit(k).alias("name"), F.col(f"paid_{k}").alias("money_amount"))
                    ),
                )
                for k in kinds
            ]
        ),
        lambda text: text.isNotNull(),
    )
    return conform(
        sums.select(
            F.concat_ws("/", "store_id", F.col("day").cast("string"), "block").alias("id"),
            "store_id",
            "opened_at",
            F.when(F.col("day") < F.lit(OPEN_SINCE).cast("date"), F.col("last_at")).alias(
                "closed_at"
            ),
            payments.alias("payments"),
        ),
        SHIFTS,
    )


# --- merges ---------------------------------------------------------------


def history_and_batch(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Orders until 1999 as the table so far; orders since 1999, repriced, as the batch."""
    orders = table(spark, sf_dir, "orders")
    history = orders.where(F.col("o_orderdate") < F.expr("TIMESTAMP_NTZ '2000-01-01 00:00:00'"))
    batch = orders.where(
        F.col("o_orderdate") >= F.expr("TIMESTAMP_NTZ '1999-01-01 00:00:00'")
    ).withColumn("o_totalprice", F.col("o_totalprice") + 1)
    return history, batch


def shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide shift rows per event day; a user's shift id returns on many days."""
    value = F.col("value")

    def movement(kind: str, amount: Column) -> Column:
        return F.struct(
            F.lit(kind).alias("type"),
            amount.alias("money_amount"),
            F.lit(None).cast("string").alias("comment"),
        )

    amounts = [
        "starting_cash", "cash_payments", "cash_refunds", "paid_in", "paid_out",
        "expected_cash", "actual_cash", "gross_sales", "refunds", "discounts", "net_sales",
        "tip", "surcharge",
    ]
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("S"), F.col("user_id")).alias("id"),
        store_of().alias("store_id"),
        F.col("event_type").alias("pos_device_id"),
        F.col("ts").alias("opened_at"),
        F.col("ts").alias("closed_at"),
        F.lit(None).cast("string").alias("opened_by_employee"),
        F.lit(None).cast("string").alias("closed_by_employee"),
        *[(value + i).alias(name) for i, name in enumerate(amounts)],
        F.array(quantity().cast("bigint"), F.col("event_id")).alias("taxes"),
        F.array(F.to_json(F.struct(value.alias("money_amount")))).alias("payments"),
        F.array(movement("PAY_IN", value), movement("PAY_OUT", value * 2)).alias(
            "cash_movements"
        ),
        F.to_date("ts").alias("ds"),
    )


def mixed_shards(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """:func:`shards` by the day's number: taxes are numbers, objects or JSON texts."""
    wide = shards(spark, sf_dir)
    kind = F.dayofmonth("ds") % 3
    objects = F.transform("taxes", lambda x: F.struct(x.alias("rate")))
    texts = F.transform("taxes", lambda x: F.concat(F.lit('"'), x.cast("string"), F.lit('"')))
    moved = F.transform("cash_movements", lambda x: F.to_json(x, KEEP_NULLS))
    return [
        wide.where(kind == 0),
        wide.where(kind == 1).withColumn("taxes", objects).drop("tip"),
        wide.where(kind == 2).withColumns({"taxes": texts, "cash_movements": moved}),
    ]


def known_shifts(spark: SparkSession, sf_dir: str, like: DataFrame) -> DataFrame:
    """Shift table so far: one row per customer; every third user has such a shift."""
    known = table(spark, sf_dir, "customer").select(
        F.concat(F.lit("S"), F.col("c_custkey") * 3).alias("id"),
        F.col("c_name").alias("pos_device_id"),
    )
    return conform(known, like.schema)


# --- landed JSON ----------------------------------------------------------


def text_lines() -> Column:
    return F.split("text", "\n")


def conversation_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One receipts page per conversation turn, one record per line of its text."""
    record = lambda line, i: F.struct(
        F.concat_ws("-", F.col("conv_id"), F.col("turn"), i).alias("receipt_number"),
        F.concat(
            F.lit("2024-01-01T00:00:"), F.lpad(F.col("turn").cast("string"), 2, "0"), F.lit("Z")
        ).alias("created_at"),
        F.lit("not a time").alias("updated_at"),
        F.length(line).cast("double").alias("total_money"),
        F.struct(
            F.col("conv_id").cast("string").alias("id"),
            F.struct(F.col("role").alias("kind")).alias("group"),
        ).alias("customer"),
        F.array(
            F.struct(line.alias("item_name"), F.lit(None).cast("int").alias("quantity"))
        ).alias("line_items"),
        line.alias("note"),
        F.lit("dropped").alias("unknown_field"),
    )
    return table(spark, sf_dir, "conversations").select(
        F.to_json(
            F.struct(
                F.transform(text_lines(), record).alias("receipts"),
                F.col("conv_id").cast("string").alias("cursor"),
            ),
            KEEP_NULLS,
        ).alias("value")
    )


def receipt_pages(spark: SparkSession, sf_dir: str, added: int = 0) -> DataFrame:
    """One receipts page per event, its total raised by ``added``."""
    moment = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z"))
    record = F.struct(
        F.concat(F.lit("R"), F.col("event_id")).alias("receipt_number"),
        moment.alias("created_at"),
        moment.alias("updated_at"),
        (F.col("value") + added).alias("total_money"),
        F.array(
            F.struct(F.col("event_type").alias("item_name"), quantity().alias("quantity"))
        ).alias("line_items"),
        F.col("user_id").cast("string").alias("customer_id"),
        store_of().alias("store_id"),
    )
    return table(spark, sf_dir, "events").select(
        F.to_json(F.struct(F.array(record).alias("receipts"))).alias("value"), "ts"
    )


def shift_pages(spark: SparkSession, sf_dir: str, added: int = 0) -> DataFrame:
    """One shifts page per event; some movements are no list of objects."""
    movement = F.to_json(F.struct((F.col("value") + added).alias("money_amount")))
    movements = F.when(
        F.col("event_type") == "error", F.concat(F.lit("["), movement, F.lit(",1]"))
    ).otherwise(F.concat(F.lit("["), movement, F.lit(",{}]")))
    record = F.struct(
        F.concat(F.lit("S"), F.col("event_id")).alias("id"),
        store_of().alias("store_id"),
        F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z")).alias(
            "opened_at"
        ),
        F.parse_json(movements).alias("cash_movements"),
        F.array(quantity()).alias("taxes"),
    )
    return table(spark, sf_dir, "events").select(
        F.to_json(F.struct(F.array(record).alias("shifts"))).alias("value"), "ts"
    )


def time_entry_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One time-entry page per event, with alternate names and gaps."""
    started = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z"))
    third = F.col("event_id") % 3
    entry = F.struct(
        F.when(third == 0, started).when(third == 1, "").alias("startedAt"),
        F.when(third == 1, started).alias("startAt"),
        F.when(third == 2, started).alias("endedAt"),
        F.when(
            F.col("event_id") % 50 != 0, F.struct(customer_name().alias("name"))
        ).alias("person"),
        F.struct(store_of().alias("name")).alias("group"),
        F.when(F.col("event_id") % 2 == 0, F.col("event_type")).alias("type"),
        F.col("event_type").alias("entryType"),
        (quantity() * 613).alias("durationSeconds"),
        started.alias("createdAt"),
        F.when(third == 0, started).alias("lastEditedOn"),
    )
    return table(spark, sf_dir, "events").select(
        F.to_json(F.struct(F.array(entry).alias("data"))).alias("value"), "ts"
    )


# --- attendance -----------------------------------------------------------


def customer_name() -> Column:
    return F.concat(F.lit("Customer#"), F.lpad(F.col("user_id").cast("string"), 9, "0"))


def payload_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attendance texts per event: two date formats and junk, gaps in name and kiosk."""
    third = F.col("event_id") % 3
    return table(spark, sf_dir, "events").select(
        "event_id",
        "ts",
        F.when(third == 0, F.date_format("ts", "yyyy-MM-dd"))
        .when(third == 1, F.date_format("ts", "dd/MM/yyyy"))
        .otherwise(F.concat(F.lit("junk"), F.col("event_id")))
        .alias("date_text"),
        F.when(F.col("event_id") % 50 != 0, customer_name()).alias("full_name"),
        F.col("event_type").alias("entry_type"),
        F.date_format("ts", "HH:mm:ss.SSSSSS").alias("time_text"),
        F.when(F.col("event_id") % 7 == 0, "bad")
        .otherwise(F.date_format("ts", "HH:mm:ss"))
        .alias("duration_text"),
        F.when(
            F.col("event_id") % 4 != 0, F.concat(F.lit("K"), F.col("event_id") % 9)
        ).alias("kiosk"),
        F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+08:00")).alias("created"),
        F.when(
            F.col("event_id") % 2 == 0,
            F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")),
        ).alias("edited"),
    )


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw attendance rows: JSON payload and load time."""
    payload = F.to_json(
        F.struct(
            F.col("date_text").alias("Date"),
            F.col("full_name").alias("Full Name"),
            F.lit("Floor").alias("Group"),
            F.col("entry_type").alias("EntryType"),
            F.col("time_text").alias("Time"),
            F.col("duration_text").alias("Duration"),
            F.lit("Shift").alias("Activity"),
            F.col("kiosk").alias("Kiosk Name"),
            F.col("created").alias("Created On"),
            F.col("edited").alias("Last Edited On"),
        )
    )
    # Never null; said so, a test for null does not write the text a second time.
    return payload_texts(spark, sf_dir).select(
        F.coalesce(payload, F.lit("")).alias("payload"), F.col("ts").alias("load_dt")
    )
