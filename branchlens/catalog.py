"""Every operator as a query over the test tables.

Output is made comparable across engines: doubles at six decimals, times and
dates as text, whole numbers as bigint.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from branchlens import fixtures as fx
from branchlens import jobs
from branchlens.functions import clock, nested, parsing
from branchlens.functions.sql import LOCAL_TIMESTAMP, SECONDS, register_functions
from branchlens.operators import baseline, lookup, merge
from branchlens.plans import attendance, drift, ingest, moments, reports
from branchlens.plans.shift_fact import add_slot, shift_fact, shift_fact_sql
from branchlens.schemas import MERGE_KEYS, RECEIPTS, conform, landing_schema
from branchlens.session import fresh_path
from branchlens.sources import publish, report_sink
from branchlens.sources.landing import Quarantine, read_envelopes, read_quarantine
from branchlens.sources.tables import replace_table
from branchlens.streaming.upsert import batch_path, stream_ingest, stream_upsert

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# A moment before 16:00 local, one after, both inside the events' month.
MORNING = datetime(2024, 1, 16, 1, 30)
EVENING = datetime(2024, 1, 16, 15, 0)
SHARD_DAYS = ("2024-01-01", "2024-01-31")


def query(function: Query) -> Query:
    QUERIES[function.__name__.removeprefix("q_")] = function
    return function


def time_text(wall: Column) -> Column:
    text = wall.cast("string")
    dotted = F.when(F.length(text) == 19, F.concat(text, F.lit("."))).otherwise(text)
    return F.rpad(dotted, 26, "0")


def shown(df: DataFrame) -> DataFrame:
    def column(field: T.StructField) -> Column:
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DoubleType):
            value = F.round(value, 6)
        elif isinstance(field.dataType, T.TimestampNTZType):
            value = time_text(value)
        elif isinstance(field.dataType, T.DateType):
            value = value.cast("string")
        elif isinstance(field.dataType, T.IntegerType):
            value = value.cast("bigint")
        return value.alias(field.name)

    return df.select(*[column(f) for f in df.schema.fields])


def landed(pages: DataFrame) -> str:
    """Write page texts as a landing folder of JSON lines."""
    path = fresh_path(pages.sparkSession, "landing")
    pages.select("value").write.text(path)
    return path


# --- shift fact and reports -----------------------------------------------


def _stores(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, int | None, int | None]:
    """Store dimension, its checked size, and the bound on slot groups it implies."""
    stores = fx.stores(spark, sf_dir)
    return stores, *lookup.store_bounds(stores)


def _facts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, int | None]:
    stores, rows, groups = _stores(spark, sf_dir)
    return shift_fact(fx.shifts(spark, sf_dir), stores, fx.AS_OF, store_rows=rows), groups


def _staged_facts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, int | None]:
    """The shift fact as a written table, for reports that read it twice."""
    facts, groups = _facts(spark, sf_dir)
    return replace_table(facts, fresh_path(spark, "shift_fact")), groups


@query
def q_shift_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(_facts(spark, sf_dir)[0])



@query
def q_shift_fact_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    stores, rows, _ = _stores(spark, sf_dir)
    return shown(shift_fact_sql(fx.shifts(spark, sf_dir), stores, fx.AS_OF, store_rows=rows))



@query
def slot_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(baseline.slot_baseline(_facts(spark, sf_dir)[0]))


@query
def sales_dip_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts, groups = _staged_facts(spark, sf_dir)
    return shown(reports.sales_dip_anomalies(facts, fx.AS_OF, max_groups=groups))


@query
def sales_dip_anomalies_k1(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts, groups = _staged_facts(spark, sf_dir)
    return shown(reports.sales_dip_anomalies(facts, fx.AS_OF, k_sigma=1.0, max_groups=groups))


@query
def sales_dip_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(reports.sales_dip_window(_staged_facts(spark, sf_dir)[0], fx.AS_OF, k_sigma=1.0))


@query
def summary_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(reports.summary_sales(_facts(spark, sf_dir)[0], fx.AS_OF))


@query
def granular_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts, groups = _staged_facts(spark, sf_dir)
    return shown(reports.granular_sales(facts, fx.AS_OF, max_groups=groups))


def _sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wanted items as a written table: the receipts are read and parsed once."""
    items = reports.receipt_items(fx.receipts(spark, sf_dir), fx.AS_OF)
    return replace_table(items, fresh_path(spark, "sales"))


def _kept(spark: SparkSession, sf_dir: str, *batches: DataFrame) -> moments.KeptReports:
    """Reports from moments that are refreshed after each merged batch of shifts."""
    target, path = fresh_path(spark, "shifts"), fresh_path(spark, "moments")
    for batch in batches:
        ingest.merge_days(spark, "shifts", batch, target)
        moments.refresh_moments(spark, target, path)
    stores, rows, groups = _stores(spark, sf_dir)
    return moments.KeptReports(spark, target, path, stores, fx.AS_OF, rows, groups)


def _shift_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replace_table(fx.shifts(spark, sf_dir), fresh_path(spark, "shift_batch"))


@query
def kept_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The slot baseline from kept moments, after all shifts of a day have moved to the next one."""
    shifts = _shift_table(spark, sf_dir)
    later = F.expr("INTERVAL 1 DAY")
    moved = shifts.where(F.to_date("opened_at") == F.lit("2024-01-24").cast("date")).withColumns(
        {"opened_at": F.col("opened_at") + later, "closed_at": F.col("closed_at") + later}
    )
    return shown(_kept(spark, sf_dir, shifts, moved).baseline())


@query
def sales_dip_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(_kept(spark, sf_dir, _shift_table(spark, sf_dir)).sales_dip(k_sigma=1.0))


@query
def summary_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(_kept(spark, sf_dir, _shift_table(spark, sf_dir)).summary())


@query
def granular_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(_kept(spark, sf_dir, _shift_table(spark, sf_dir)).granular())


@query
def shift_item_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = _sales(spark, sf_dir)
    return shown(reports.shift_item_join(fx.shifts(spark, sf_dir), sales, fx.AS_OF))


def _sold(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = reports.receipt_items(fx.receipts(spark, sf_dir), fx.AS_OF)
    return reports.shift_items(fx.shifts(spark, sf_dir), items, fx.AS_OF)


@query
def item_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(_sold(spark, sf_dir))


def _ratio(spark: SparkSession, sf_dir: str, k_sigma: float) -> DataFrame:
    stores, rows, groups = _stores(spark, sf_dir)
    return shown(
        reports.ratio_anomalies(
            replace_table(_sold(spark, sf_dir), fresh_path(spark, "shift_items")),
            stores,
            fx.AS_OF,
            k_sigma=k_sigma,
            store_rows=rows,
            max_groups=groups,
        )
    )


@query
def ratio_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ratio(spark, sf_dir, reports.K_SIGMA)


@query
def ratio_anomalies_k1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ratio(spark, sf_dir, 1.0)


@query
def report_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sales-dip report through the report files."""
    facts, groups = _staged_facts(spark, sf_dir)
    report = shown_numbers(reports.sales_dip_anomalies(facts, fx.AS_OF, max_groups=groups))
    folder = fresh_path(spark, "reports")
    written = report_sink.write_report(report, folder, reports.SALES_DIP)
    text = report_sink.report_text(report)
    if not written:
        return shown(text)
    path = report_sink.report_path(folder, reports.SALES_DIP)
    return shown(spark.read.schema(text.schema).option("header", True).csv(path))


def shown_numbers(df: DataFrame) -> DataFrame:
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)]
    return df.withColumns({name: F.round(name, 6) for name in doubles})


@query
def json_array_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    shifts = fx.shifts(spark, sf_dir)
    return shown(
        shifts.select(
            F.col("id").alias("shift_number"),
            nested.json_array_sum(F.col("payments"), "money_amount").alias("total_sales"),
        )
    )


@query
def dim_lookup_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    stores, rows, _ = _stores(spark, sf_dir)
    events = fx.table(spark, sf_dir, "events").select("event_id", fx.store_of().alias("store_id"))
    return lookup.lookup_with_default(
        events, stores, "store_id", "store_name", lookup.UNKNOWN_STORE, rows
    )


@query
def local_slot_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = fx.table(spark, sf_dir, "events").select(
        "event_id", clock.to_local(F.col("ts")).alias("local_ts")
    )
    return shown(add_slot(events, "local_ts"))


# --- merges ---------------------------------------------------------------


@query
def upsert_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    history, batch = fx.history_and_batch(spark, sf_dir)
    return shown(merge.upsert(history, batch, "o_orderkey"))


@query
def insert_only_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    history, batch = fx.history_and_batch(spark, sf_dir)
    return shown(merge.insert_only(history, batch, "o_orderkey"))


@query
def load_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    history, batch = fx.history_and_batch(spark, sf_dir)
    return merge.merge_metrics(history, batch, "o_orderkey")


@query
def q_stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two landings, each followed by an available-now run, into a table by order year."""
    year = F.year("o_orderdate").cast("string")
    history, batch = fx.history_and_batch(spark, sf_dir)
    history, batch = history.withColumn("o_year", year), batch.withColumn("o_year", year)
    target, landing = fresh_path(spark, "orders"), fresh_path(spark, "landing")
    work = fresh_path(spark, "stream")
    replace_table(history, target, "o_year")
    since_2000 = F.col("o_orderdate") >= F.expr("TIMESTAMP_NTZ '2000-01-01 00:00:00'")
    for part in (batch.where(~since_2000), batch.where(since_2000)):
        part.drop("o_year").write.mode("append").json(landing)
        stream_upsert(
            spark,
            landing,
            part.drop("o_year").schema,
            target,
            "o_orderkey",
            "o_year",
            work,
            prepare=lambda df: df.withColumn("o_year", year),
        ).awaitTermination()
    return shown(spark.read.schema(history.schema).parquet(target).drop("o_year"))



@query
def merge_cast_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = fx.shards(spark, sf_dir)
    target = fx.known_shifts(spark, sf_dir, ingest.normalise_shards(shards).drop("ds"))
    merged = ingest.backfill_shifts(target, shards, "ds", *SHARD_DAYS)
    return shown(
        merged.select(
            "id",
            "pos_device_id",
            "store_id",
            "opened_at",
            "net_sales",
            F.size("cash_movements").alias("movements"),
            F.array_join("taxes", ",").alias("taxes"),
            nested.json_array_sum(F.col("cash_movements"), "money_amount").alias("moved"),
        )
    )


@query
def sharded_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day-partitioned shards, repaired into a second day-partitioned table."""
    source = replace_table(fx.shards(spark, sf_dir), fresh_path(spark, "shards"), "ds")
    fixed = ingest.rewrite_shards(source, "ds", *SHARD_DAYS)
    first = F.try_element_at("cash_movements", F.lit(1))
    return shown(
        fixed.select(
            "ds",
            "id",
            "opened_at",
            "starting_cash",
            "surcharge",
            F.get_json_object(first, "$.type").alias("first_type"),
            first.contains('"comment":null').alias("keeps_null"),
            nested.json_array_sum(F.col("cash_movements"), "money_amount").alias("moved"),
        )
    )


@query
def backfill_mixed_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Back-fill from daily shards whose list columns have three types."""
    shards, target = fresh_path(spark, "shards"), fresh_path(spark, "shifts")
    for part in fx.mixed_shards(spark, sf_dir):
        part.write.mode("append").partitionBy("ds").parquet(shards)
    jobs.run_backfill(spark, shards, *SHARD_DAYS, target)
    return shown(
        ingest.read_days(spark, "shifts", target).select(
            "id",
            "opened_at",
            F.array_join("taxes", ",").alias("taxes"),
            nested.json_array_sum(F.col("cash_movements"), "money_amount").alias("moved"),
        )
    )


@query
def shard_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily shift shards; a second load replaces the days since the 15th."""
    path = fresh_path(spark, "shift_shards")
    local_15th = F.lit("2024-01-14 16:00:00").cast("timestamp_ntz")
    ingest.stage_shards(spark, landed(fx.shift_pages(spark, sf_dir)), path)
    later = fx.shift_pages(spark, sf_dir, added=1).where(F.col("ts") >= local_15th)
    shards = ingest.stage_shards(spark, landed(later), path)
    return shown(
        shards.select(
            "id",
            "ds",
            "opened_at",
            F.size("cash_movements").alias("movements"),
            nested.json_array_sum(F.col("cash_movements"), "money_amount").alias("moved"),
            F.try_element_at("taxes", F.lit(1)).alias("tax"),
        )
    )


# --- landing and projection -----------------------------------------------


@query
def json_envelope_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    record = T.StructType.fromDDL("receipt_number string, note string")
    path = landed(fx.conversation_pages(spark, sf_dir))
    return read_envelopes(spark, path, "receipts", record)


@query
def struct_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    record = T.StructType.fromDDL(
        "receipt_number string, customer struct<id:string, group:struct<kind:string>>, "
        "line_items array<struct<item_name:string>>"
    )
    path = landed(fx.conversation_pages(spark, sf_dir))
    flat = nested.flatten_structs(read_envelopes(spark, path, "receipts", record))
    return shown(flat.withColumn("line_items", F.size("line_items")))


def _receipt_columns(staged: DataFrame) -> DataFrame:
    first = F.try_element_at("line_items", F.lit(1))
    return shown(
        staged.select(
            "receipt_number",
            "receipt_type",
            "created_at",
            "updated_at",
            "total_money",
            "points_earned",
            "customer_id",
            "note",
            F.size("line_items").alias("items"),
            F.size("payments").alias("payments"),
            F.get_json_object(first, "$.item_name").alias("item_name"),
            first.contains('"quantity":null').alias("keeps_null"),
        )
    )


@query
def schema_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = landed(fx.conversation_pages(spark, sf_dir))
    raw = read_envelopes(spark, path, "receipts", landing_schema(RECEIPTS))
    return _receipt_columns(conform(raw, RECEIPTS))


@query
def ingest_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = landed(fx.conversation_pages(spark, sf_dir))
    staged, _ = ingest.stage(spark, "receipts", path, fresh_path(spark, "staging"))
    return _receipt_columns(staged)


# Two overlapping pulls of the events' month.
PULLS = {
    "first": ("2024-01-01 00:00:00", "2024-01-20 00:00:00"),
    "second": ("2024-01-15 00:00:00", "2024-02-01 00:00:00"),
}


def between(column: str, first: str, last: str) -> Column:
    moment = F.col(column)
    return (moment >= F.expr(f"TIMESTAMP_NTZ '{first}'")) & (
        moment < F.expr(f"TIMESTAMP_NTZ '{last}'")
    )


def _movement_columns(shifts: DataFrame) -> DataFrame:
    return shown(
        shifts.select(
            "id",
            "store_id",
            "opened_at",
            nested.json_array_sum(F.col("cash_movements"), "money_amount").alias("moved"),
        )
    )


@query
def backfill_then_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily shards of the first pull back-filled, then the second pull upserted by the job."""
    target, landing = fresh_path(spark, "shifts"), fresh_path(spark, "landing")
    shards = fresh_path(spark, "shards")
    for pull, (first, last) in PULLS.items():
        pages = fx.shift_pages(spark, sf_dir, int(pull == "second")).where(
            between("ts", first, last)
        )
        pages.select("value").write.text(f"{landing}/pull={pull}")
    ingest.stage_shards(spark, landing, shards, pull="first")
    jobs.run_backfill(spark, shards, "2024-01-01", "2024-01-31", target)
    jobs.run_ingest(
        spark, "shifts", landing, fresh_path(spark, "staging"), target, None, pull="second"
    )
    return _movement_columns(ingest.read_days(spark, "shifts", target))


@query
def upsert_moved_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Receipts since the 20th come again: clicks a day later, errors without a moment."""
    target = fresh_path(spark, "receipts")
    late = F.col("event_type")
    receipts = fx.table(spark, sf_dir, "events").select(
        F.concat(F.lit("R"), F.col("event_id")).alias("receipt_number"),
        F.col("ts").alias("created_at"),
        F.col("value").alias("total_money"),
        late.alias("note"),
    )
    since = F.col("created_at") >= F.expr("TIMESTAMP_NTZ '2024-01-20 00:00:00'")
    moved = receipts.where(since).withColumns(
        {
            "created_at": F.when(F.col("note") == "click", F.col("created_at") + F.expr("INTERVAL 1 DAY"))
            .when(F.col("note") != "error", F.col("created_at")),
            "total_money": F.col("total_money") + 1,
        }
    )
    for batch in (receipts, moved):
        staged = replace_table(conform(batch, RECEIPTS), fresh_path(spark, "batch"))
        ingest.merge_days(spark, "receipts", staged, target)
    table = ingest.read_days(spark, "receipts", target)
    return shown(table.select("receipt_number", "created_at", "total_money"))


@query
def stream_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two overlapping pulls of receipt pages, each followed by an available-now run."""
    target, landing = fresh_path(spark, "receipts"), fresh_path(spark, "landing")
    work = fresh_path(spark, "stream")
    for pull, (first, last) in PULLS.items():
        pages = fx.receipt_pages(spark, sf_dir, int(pull == "second")).where(
            between("ts", first, last)
        )
        pages.select("value").write.text(f"{landing}/pull={pull}")
        stream_ingest(spark, "receipts", landing, target, work, on_duplicate="error").awaitTermination()
    table = ingest.read_days(spark, "receipts", target)
    return shown(table.select("receipt_number", "created_at", "total_money", "customer_id"))


@query
def attendance_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Time-entry pages of two overlapping pulls to the raw table and on, each job run twice."""
    landing, raw = fresh_path(spark, "landing"), fresh_path(spark, "raw_attendance")
    target = fresh_path(spark, "attendance")
    for pull, (first, last) in PULLS.items():
        pages = fx.time_entry_pages(spark, sf_dir).where(between("ts", first, last))
        pages.select("value").write.text(f"{landing}/pull={pull}")
        for _ in range(2):
            attendance.append_entries(spark, landing, raw, pull=pull, loaded=fx.AS_OF)
            loaded = attendance.read_raw(spark, raw, pull)
            jobs.run_attendance(spark, loaded, target, "latest", pull)
    table = attendance.read_attendance(spark, target)
    return shown(
        table.select("attn_id", "date", "full_name", "group", "time_ts", "duration_sec")
    )


@query
def pos_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two overlapping pulls in one landing folder, each ingested by the job, the second twice."""
    target, landing = fresh_path(spark, "receipts"), fresh_path(spark, "landing")
    staging = fresh_path(spark, "staging")
    for pull, (first, last) in PULLS.items():
        pages = fx.receipt_pages(spark, sf_dir, int(pull == "second")).where(
            between("ts", first, last)
        )
        pages.select("value").write.text(f"{landing}/pull={pull}")
    for pull in ("first", "second", "second"):
        jobs.run_ingest(spark, "receipts", landing, staging, target, None, pull=pull)
    return shown(
        ingest.read_days(spark, "receipts", target).select(
            "receipt_number",
            "store_id",
            "created_at",
            "total_money",
            "customer_id",
            F.get_json_object(F.try_element_at("line_items", F.lit(1)), "$.item_name").alias(
                "item_name"
            ),
        )
    )


# Three overlapping pulls; the first two die, staged or while publishing, before the third runs.
REPEATED = {
    "staged": ("2024-01-01 00:00:00", "2024-01-16 00:00:00"),
    "claimed": ("2024-01-10 00:00:00", "2024-01-22 00:00:00"),
    "later": ("2024-01-18 00:00:00", "2024-02-01 00:00:00"),
}


def _land_receipts(spark: SparkSession, sf_dir: str, landing: str, pulls: dict) -> None:
    """Receipt pages of each pull, totals raised by the pull's number."""
    for number, (pull, (first, last)) in enumerate(pulls.items()):
        pages = fx.receipt_pages(spark, sf_dir, number).where(between("ts", first, last))
        pages.select("value").write.text(f"{landing}/pull={pull}")


@query
def repeat_after_later_pull(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A pull that died staged and one that died publishing are repeated after a later one."""
    target, landing = fresh_path(spark, "receipts"), fresh_path(spark, "landing")
    staging = fresh_path(spark, "staging")
    _land_receipts(spark, sf_dir, landing, REPEATED)
    for pull in ("staged", "claimed"):
        staged, _ = ingest.stage(spark, "receipts", landing, f"{staging}/{pull}", pull=pull)
        work = jobs.work_path(spark, target, pull)
        publish.stage_merge(
            spark, target, ingest.with_day(staged, "receipts"), MERGE_KEYS["receipts"],
            ingest.DAY, ingest.merge_of("receipts"), work,
        )
    publish.claim_publish(spark, target, work)
    for pull in ("later", "claimed", "staged"):
        jobs.run_ingest(spark, "receipts", landing, staging, target, None, pull=pull)
    table = ingest.read_days(spark, "receipts", target)
    return shown(table.select("receipt_number", "created_at", "total_money"))


@query
def repeat_stream_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first stream batch died while publishing; a pull is ingested, then the stream goes on."""
    target, work = fresh_path(spark, "receipts"), fresh_path(spark, "stream")
    streamed, pulled = fresh_path(spark, "landing"), fresh_path(spark, "landing")
    _land_receipts(spark, sf_dir, streamed, {"claimed": REPEATED["claimed"]})
    _land_receipts(spark, sf_dir, pulled, REPEATED)
    rows, _ = ingest.stage(spark, "receipts", streamed, fresh_path(spark, "staging"))
    publish.stage_merge(
        spark, target, ingest.with_day(rows, "receipts"), MERGE_KEYS["receipts"], ingest.DAY,
        ingest.merge_of("receipts"), batch_path(work, 0),
    )
    publish.claim_publish(spark, target, batch_path(work, 0))
    jobs.run_ingest(
        spark, "receipts", pulled, fresh_path(spark, "staging"), target, None, pull="later"
    )
    stream_ingest(spark, "receipts", streamed, target, work).awaitTermination()
    table = ingest.read_days(spark, "receipts", target)
    return shown(table.select("receipt_number", "created_at", "total_money"))


@query
def repeat_attendance_pull(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As attendance_pipeline, but the first pull died staged and is repeated after the second."""
    landing, raw = fresh_path(spark, "landing"), fresh_path(spark, "raw_attendance")
    target = fresh_path(spark, "attendance")
    for pull, (first, last) in PULLS.items():
        pages = fx.time_entry_pages(spark, sf_dir).where(between("ts", first, last))
        pages.select("value").write.text(f"{landing}/pull={pull}")
        attendance.append_entries(spark, landing, raw, pull=pull, loaded=fx.AS_OF)
    payloads = attendance.entry_payloads(attendance.read_raw(spark, raw, "first"))
    publish.stage_merge(
        spark, target, attendance.stage_payloads(payloads), MERGE_KEYS["attendance"], attendance.DATE,
        lambda table, batch: attendance.attendance_upsert(table, batch, "latest"),
        jobs.work_path(spark, target, "first"),
    )
    for pull in ("second", "first"):
        jobs.run_attendance(spark, attendance.read_raw(spark, raw, pull), target, "latest", pull)
    table = attendance.read_attendance(spark, target)
    return shown(
        table.select("attn_id", "date", "full_name", "group", "time_ts", "duration_sec")
    )


def _broken(pages: DataFrame) -> DataFrame:
    """Pages of which some are cut off."""
    cut = F.concat(F.lit('{"receipts": [cut '), F.col("ts").cast("string"))
    broken = F.get_json_object("value", "$.receipts[0].line_items[0].item_name") == "error"
    return pages.withColumn("value", F.when(broken, cut).otherwise(F.col("value")))


def _beside(table: DataFrame, aside: DataFrame) -> DataFrame:
    """Receipts of the table, and the lines set aside."""
    return shown(
        table.select(F.lit("table").alias("place"), F.col("receipt_number").alias("content")).unionByName(
            aside.select(F.lit("quarantine").alias("place"), F.col("line").alias("content"))
        )
    )


@query
def quarantine_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A pull with broken lines: these go to a side table, the others are merged."""
    target, landing = fresh_path(spark, "receipts"), fresh_path(spark, "landing")
    aside = Quarantine(fresh_path(spark, "quarantine"), limit=1 << 40)
    _broken(fx.receipt_pages(spark, sf_dir)).select("value").write.text(f"{landing}/pull=p")
    jobs.run_ingest(
        spark, "receipts", landing, fresh_path(spark, "staging"), target, None, pull="p", quarantine=aside
    )
    return _beside(ingest.read_days(spark, "receipts", target), read_quarantine(spark, aside.path))


@query
def quarantine_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as two landings of a stream."""
    target, landing = fresh_path(spark, "receipts"), fresh_path(spark, "landing")
    aside, work = Quarantine(fresh_path(spark, "quarantine"), limit=1 << 40), fresh_path(spark, "stream")
    middle = F.expr("TIMESTAMP_NTZ '2024-01-15 00:00:00'")
    for part in (F.col("ts") < middle, F.col("ts") >= middle):
        _broken(fx.receipt_pages(spark, sf_dir).where(part)).select("value").write.mode("append").text(landing)
        stream_ingest(spark, "receipts", landing, target, work, quarantine=aside).awaitTermination()
    return _beside(ingest.read_days(spark, "receipts", target), read_quarantine(spark, aside.path))


@query
def stream_insert_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two overlapping pulls streamed to insert only; keys of the overlap stop at the stream's state."""
    target, landing = fresh_path(spark, "receipts"), fresh_path(spark, "landing")
    work = fresh_path(spark, "stream")
    for pull, (first, last) in PULLS.items():
        pages = fx.receipt_pages(spark, sf_dir, int(pull == "second")).where(between("ts", first, last))
        pages.select("value").write.text(f"{landing}/pull={pull}")
        stream_ingest(
            spark, "receipts", landing, target, work, mode="insert", seen_within="2 days"
        ).awaitTermination()
    table = ingest.read_days(spark, "receipts", target)
    return shown(table.select("receipt_number", "created_at", "total_money"))


@query
def schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields of two pulls that the receipt schema lacks or has with another type."""
    landing, path = fresh_path(spark, "landing"), fresh_path(spark, "drift")
    number, kind = F.concat(F.lit("R"), F.col("event_id")), F.col("event_type")
    customer = F.struct(F.col("user_id").cast("string").alias("id"), F.lit(True).alias("vip"))
    loyalty = F.when(kind == "click", F.struct(F.col("user_id").alias("level")))
    records = {
        "first": F.struct(number.alias("receipt_number"), customer.alias("customer"), loyalty.alias("loyalty")),
        "second": F.struct(
            number.alias("receipt_number"),
            F.when(kind == "error", "none").alias("total_money"),
            (kind == "view").alias("points_earned"),
            F.col("user_id").alias("store_id"),
            F.array(F.lit(1)).alias("payments"),
        ),
    }
    for pull, (first, last) in PULLS.items():
        events = fx.table(spark, sf_dir, "events").where(between("ts", first, last))
        page = F.to_json(F.struct(F.array(records[pull]).alias("receipts")))
        events.select(page.alias("value")).write.text(f"{landing}/pull={pull}")
        drift.record_drift(spark, landing, "receipts", path, pull)
    return drift.read_drift(spark, path, "receipts")


@query
def array_to_json_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of struct lists, scalar lists, JSON lists and a non-list, per turn."""
    turns = fx.table(spark, sf_dir, "conversations")
    prepared = turns.select(
        "conv_id",
        "turn",
        F.transform(
            fx.text_lines(),
            lambda line: F.struct(line.alias("line"), F.lit(None).cast("string").alias("gap")),
        ).alias("structs"),
        F.array(F.col("turn"), F.col("conv_id")).alias("numbers"),
        F.to_json(F.struct(F.col("role"))).alias("document"),
        F.to_json(fx.text_lines()).alias("listed"),
    )
    types = {f.name: f.dataType for f in prepared.schema.fields}

    def texts(name: str) -> Column:
        return nested.array_to_json_strings(F.col(name), types[name])

    return shown(
        prepared.select(
            "conv_id",
            "turn",
            F.array_join(
                F.transform(texts("structs"), lambda x: F.get_json_object(x, "$.line")), "|"
            ).alias("lines"),
            F.forall(texts("structs"), lambda x: x.contains('"gap":null')).alias("keeps_null"),
            F.array_join(texts("numbers"), ",").alias("numbers"),
            F.size(texts("document")).alias("from_document"),
            F.size(texts("listed")).alias("from_list"),
        )
    )


def _mixed_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per turn a JSON list for users, and no list for anyone else."""
    length = F.length("text")
    user = F.col("role") == "user"
    number, quoted = length.cast("string"), F.col("turn").cast("string")
    return fx.table(spark, sf_dir, "conversations").select(
        "conv_id",
        "turn",
        F.when(user, F.concat(F.lit("["), number, F.lit(","), quoted, F.lit("]")))
        .otherwise(F.concat(F.lit('{"n":'), number, F.lit("}")))
        .alias("numbers"),
        F.when(
            F.col("turn") % 4 < 2,
            F.concat(F.lit('[{"n":'), number, F.lit('},{"n":'), quoted, F.lit("}]")),
        )
        .otherwise(F.concat(F.lit('[{"n":'), number, F.lit("},"), quoted, F.lit("]")))
        .alias("objects"),
    )


@query
def array_int_or_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = _mixed_lists(spark, sf_dir)
    numbers = nested.array_int_or_empty(F.col("numbers"), T.StringType())
    return shown(
        lists.select(
            "conv_id",
            "turn",
            F.size(numbers).alias("n"),
            F.aggregate(numbers, F.lit(0).cast("bigint"), lambda a, x: a + x).alias("total"),
        )
    )


@query
def array_struct_or_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = _mixed_lists(spark, sf_dir)
    objects = nested.array_struct_or_empty(F.col("objects"), T.StringType())
    return shown(
        lists.select(
            "conv_id",
            "turn",
            F.size(objects).alias("n"),
            nested.json_array_sum(objects, "n").alias("total"),
        )
    )


@query
def ingest_window_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events inside each kind of pull window."""
    windows = {
        "morning run": clock.rolling_window(MORNING),
        "evening run": clock.rolling_window(EVENING),
        "previous day": clock.previous_day(MORNING),
        "day range": clock.day_range(MORNING, date(2024, 1, 5), date(2024, 1, 9)),
    }
    events = fx.table(spark, sf_dir, "events").select("event_id", "ts")
    out: DataFrame | None = None
    for label, window in windows.items():
        part = ingest.window_filter(events, window, "ts").withColumn("pull", F.lit(label))
        out = part if out is None else out.unionByName(part)
    return shown(out)


# --- attendance -----------------------------------------------------------


@query
def time_entry_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = landed(fx.time_entry_pages(spark, sf_dir))
    rows = attendance.normalise_entries(attendance.read_entries(spark, path))
    return rows.withColumn(
        "raw_payload", F.get_json_object("raw_payload", "$.createdAt")
    )


@query
def append_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two overlapping loads; rows of the overlap appear twice."""
    pages = fx.time_entry_pages(spark, sf_dir)
    raw = fresh_path(spark, "raw_attendance")
    first = pages.where(F.col("ts") < F.expr("TIMESTAMP_NTZ '2024-01-20 00:00:00'"))
    second = pages.where(F.col("ts") >= F.expr("TIMESTAMP_NTZ '2024-01-15 00:00:00'"))
    for load in (first, second):
        attendance.append_entries(spark, landed(load), raw)
    return attendance.read_raw(spark, raw).select("date", "time", "full_name", "entry_type", "duration")


@query
def attendance_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows parsed until the 20th as the table so far, payloads since the 15th as the batch."""
    raw = fx.payloads(spark, sf_dir)
    first = raw.where(F.col("load_dt") < F.expr("TIMESTAMP_NTZ '2024-01-20 00:00:00'"))
    second = raw.where(F.col("load_dt") >= F.expr("TIMESTAMP_NTZ '2024-01-15 00:00:00'"))
    target = attendance.stage_payloads(first).withColumn("activity", F.lit("Earlier"))
    return shown(attendance.attendance_upsert(target, attendance.stage_payloads(second)))


@query
def attendance_upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As above with every payload loaded twice; the later update of a key is kept."""
    raw = fx.payloads(spark, sf_dir)
    again = raw.withColumn(
        "payload",
        F.replace("payload", F.lit('"Activity":"Shift"'), F.lit('"Activity":"Again"')),
    )
    target = attendance.stage_payloads(
        raw.where(F.col("load_dt") < F.expr("TIMESTAMP_NTZ '2024-01-20 00:00:00'"))
    )
    both = attendance.stage_payloads(raw.unionByName(again))
    return shown(attendance.attendance_upsert(target, both, on_duplicate="latest"))


@query
def sha_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = fx.payload_texts(spark, sf_dir)
    key = parsing.attendance_key(
        F.col("date_text"), F.col("full_name"), F.col("entry_type"), F.col("time_text"),
        F.col("kiosk"),
    )
    return texts.select("event_id", key.alias("attn_id"))


@query
def multi_format_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = fx.payload_texts(spark, sf_dir)
    return shown(
        texts.select("event_id", parsing.multi_format_date(F.col("date_text")).alias("date"))
    )


@query
def local_ts_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = fx.payload_texts(spark, sf_dir)
    parsed = parsing.local_text_timestamp(F.col("date_text"), F.col("time_text"))
    return shown(texts.select("event_id", parsed.alias("time_ts")))


@query
def hms_to_seconds(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = fx.payload_texts(spark, sf_dir)
    return texts.select(
        "event_id", parsing.hms_to_seconds(F.col("duration_text")).alias("duration_sec")
    )


@query
def sql_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both attendance conversions called from SQL."""
    register_functions(spark)
    return shown(
        spark.sql(
            f"""
            SELECT event_id, {LOCAL_TIMESTAMP}(date_text, time_text) AS time_ts,
                   {SECONDS}(duration_text) AS duration_sec
            FROM {{texts}}
            """,
            texts=fx.payload_texts(spark, sf_dir),
        )
    )


@query
def seconds_to_hms(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = fx.table(spark, sf_dir, "events")
    return events.select(
        "event_id", parsing.seconds_to_hms(fx.quantity() * 3671).alias("duration")
    )


@query
def ts_coerce(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zoned, zone-less and malformed texts to UTC."""
    kind = F.col("event_id") % 4
    base = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    text = (
        F.when(kind == 0, F.concat(base, F.lit("Z")))
        .when(kind == 1, F.concat(base, F.lit("+08:00")))
        .when(kind == 2, base)
        .otherwise(F.concat(F.lit("not a time "), F.col("event_id")))
    )
    events = fx.table(spark, sf_dir, "events")
    return shown(events.select("event_id", parsing.coerce_timestamp(text).alias("moment")))

