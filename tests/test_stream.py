from __future__ import annotations

import json

import pytest
from helpers import bag
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from branchlens.operators.merge import upsert
from branchlens.plans import ingest
from branchlens.sources.tables import replace_table
from branchlens.streaming.upsert import stream_ingest, stream_upsert

SCHEMA = "id string, day string, v int"


def test_available_now_equals_batch(spark, tmp_path):
    target_path, landing = str(tmp_path / "target"), str(tmp_path / "landing")
    history = spark.createDataFrame(
        [("a", "d1", 1), ("b", "d2", 2), (None, "d1", 3), ("z", "d9", 9)], SCHEMA
    )
    replace_table(history, target_path, "day")
    first = spark.createDataFrame([("a", "d1", 10), ("c", "d1", 30)], SCHEMA)
    second = spark.createDataFrame([("c", "d1", 31), ("d", "d3", 40), (None, "d3", 5)], SCHEMA)

    def run():
        stream_upsert(
            spark, landing, history.schema, target_path, "id", "day", str(tmp_path / "work"),
            files_per_batch=1,
        ).awaitTermination()
        return spark.read.schema(history.schema).parquet(target_path)

    want = history
    for batch in (first, second):
        batch.coalesce(1).write.mode("append").json(landing)
        want = upsert(want, batch, "id")
        assert bag(run(), "id", "day", "v") == bag(want, "id", "day", "v")
    # Nothing new, nothing changes.
    assert bag(run(), "id", "day", "v") == bag(want, "id", "day", "v")
    kept = spark.read.parquet(target_path).where(F.col("day") == "d9")
    assert kept.count() == 1


def test_insert_mode_leaves_rows_alone(spark, tmp_path):
    target_path, landing = str(tmp_path / "target"), str(tmp_path / "landing")
    history = spark.createDataFrame([("a", "d1", 1)], SCHEMA)
    replace_table(history, target_path, "day")
    spark.createDataFrame([("a", "d1", 9), ("n", "d1", 2), ("n", "d1", 2)], SCHEMA).coalesce(
        1
    ).write.json(landing)
    stream_upsert(
        spark, landing, history.schema, target_path, "id", "day", str(tmp_path / "work"),
        mode="insert",
    ).awaitTermination()
    got = spark.read.schema(history.schema).parquet(target_path)
    assert bag(got, "id", "v") == {("a", 1): 1, ("n", 2): 2}


def test_envelopes_stream_into_the_receipts_table(spark, tmp_path):
    landing, target = tmp_path / "landing", str(tmp_path / "target")
    record = {"receipt_number": "1", "created_at": "2024-01-02T00:00:00Z", "customer": {"id": "C"}}

    def run(pull, text):
        (landing / f"pull={pull}").mkdir(parents=True)
        (landing / f"pull={pull}" / "p.json").write_text(text)
        stream_ingest(
            spark, "receipts", str(landing), target, str(tmp_path / "work")
        ).awaitTermination()

    run("a", json.dumps({"receipts": [record, dict(record, receipt_number="2")]}))
    run("b", json.dumps({"receipts": [dict(record, created_at="2024-01-03T00:00:00Z")]}))
    got = ingest.read_days(spark, "receipts", target)
    assert bag(got, "receipt_number", "customer_id") == {("1", "C"): 1, ("2", "C"): 1}
    # A broken line stops the batch and adds nothing.
    with pytest.raises(StreamingQueryException, match="no JSON"):
        run("c", '{"receipts": [{"receipt_number": "9"}]}\n{broken')
    assert ingest.read_days(spark, "receipts", target).count() == 2
