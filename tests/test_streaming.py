"""A stream over many files equals the batch over all of them, below the final watermark."""

import os

from pyspark.sql import functions as F

from tidewatch.catalog import shaping as batch
from tidewatch.catalog.base import frame
from tidewatch.catalog.streams import DELAY, drain, events_stream
from tidewatch.catalog.shaping import GAP, HOLD, HOUR, KEYS, LIMIT
from tidewatch.operators import shaping
from tidewatch.streaming import coalesce_repeats_stream, dedup_stream, rate_limit_stream

SMALL = "/root/testdata/sf0.001"


def files(spark, tmp_path):
    """The events in six files of consecutive times, read one after the other."""
    spark.read.parquet(f"{SMALL}/events.parquet").repartitionByRange(6, "ts").write.parquet(str(tmp_path / "events"))
    for i, part in enumerate(sorted((tmp_path / "events").glob("*.parquet"))):
        os.utime(part, (1_700_000_000 + i, 1_700_000_000 + i))  # the source reads the oldest file first
    return events_stream(spark, str(tmp_path / "events"), "*.parquet", max_files=1)


def test_folding(spark, tmp_path):
    shown = ["source", "action", "arrival_seq", "occurred_at", F.col("amount").cast("decimal(18,2)").alias("amount"), "repeats",
             "repeated_until", "is_rollup", "admit_at"]
    got = drain(coalesce_repeats_stream(files(spark, tmp_path), KEYS, GAP, HOLD, ["amount"], delay=DELAY)).select(*shown)
    want = batch.fold(spark, SMALL).select(*shown)
    end = frame(spark, SMALL, "SELECT max(CAST(ts AS TIMESTAMP)) - INTERVAL 1 MINUTE AS w FROM $events").first().w
    firsts = lambda df: sorted(map(str, df.filter(~F.col("is_rollup")).collect()))
    totals = lambda df: sorted(map(str, df.filter(F.col("is_rollup") & (F.col("admit_at") < F.lit(end))).collect()))
    assert firsts(got) == firsts(want) and len(firsts(got)) > 100
    assert totals(got) == totals(want) and len(totals(got)) > 10


def test_ceiling(spark, tmp_path):
    rows = files(spark, tmp_path).withColumn("admit_at", F.col("received_at"))
    out = drain(rate_limit_stream(rows, LIMIT, 24 * HOUR, delay=DELAY))
    want = shaping.rate_limit(frame(spark, SMALL, batch.EVENTS), LIMIT, 24 * HOUR, source="source")
    assert sorted(r.arrival_seq for r in out.filter("dropped IS NULL").collect()) == sorted(r.arrival_seq for r in want.collect())
    report = shaping.rate_limit_report(frame(spark, SMALL, batch.EVENTS), LIMIT, 24 * HOUR, source="source", actor="arrival_seq")
    want = {(r.source, r.window_start): (r.dropped, r.actor) for r in report.collect()}
    got = {(r.source, r.window_start): (r.dropped, r.arrival_seq) for r in out.filter("dropped IS NOT NULL").collect()}
    assert got and all(want[k] == v for k, v in got.items())


def test_dedup(spark, tmp_path):
    rows = files(spark, tmp_path).withColumn("event_id", F.col("arrival_seq").cast("string"))
    twice = rows.withColumn("_n", F.explode(F.array(F.lit(0), F.lit(1)))).drop("_n")
    assert drain(dedup_stream(twice)).count() == 1000
