"""Folding and ceiling in one streaming query equal the batch operators, on rows out of order and with gaps."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from test_streamed_identity import streamed

from tidewatch.catalog.streams import drain
from tidewatch.operators import shaping
from tidewatch.operators.canonical import CANONICAL
from tidewatch.operators.identity import PARTY, party
from tidewatch.streaming import coalesce_repeats_stream, rate_limit_stream, shape_stream

START = datetime(2024, 1, 1)
RAW = "server_id string, arrival_seq long, received_at timestamp, occurred_at timestamp, source int, action string, amount int"


def raw_rows(seed):
    rnd = random.Random(seed)
    rows, t = [], 0.0
    for i in range(400):
        t += rnd.choice([0, 0.4, 1, 3, 12])
        player = rnd.choice([1, 1, 1, 2, 3, None])
        occurred = None if rnd.random() < 0.1 else START + timedelta(seconds=int(t))
        rows.append(("s", i, START + timedelta(seconds=t), occurred, player, rnd.choice(["cash_added", "cash_removed"]), rnd.randrange(100)))
    rows += [("s", 1000 + i, None, START, 1, "cash_added", 1) for i in range(3)]
    return rows, [("s", 5000, START + timedelta(hours=9), None, 9, "end", 0)]


def canonical(rows):
    made = {
        "event_id": F.concat(F.lit("e"), F.col("arrival_seq")), "category": F.lit("money"), "severity": F.lit("info"),
        "actor": party(source=F.col("source")),
        "target": F.lit(None).cast(PARTY), "context": F.create_map(F.lit("zone"), F.lit('"1"')),
        "data": F.create_map(F.lit("amount"), F.col("amount").cast("string")),
    }
    known = ("server_id", "arrival_seq", "received_at", "occurred_at", "action")
    return rows.select(*[(F.col(n) if n in known else made.get(n, F.lit(None).cast("string"))).alias(n) for n in CANONICAL])


def shown(df):
    text = lambda c: F.to_json(F.array_sort(F.map_entries(c)))
    return sorted(map(str, df.select(*[text(c).alias(c) if c in ("context", "data") else c for c in CANONICAL]).collect()))


@pytest.mark.parametrize("seed", [1, 2])
def test_chained_stream_equals_batch(spark, tmp_path, seed):
    rows, end = raw_rows(seed)
    stream = canonical(streamed(spark, str(tmp_path), rows + end, RAW, 2))
    got = drain(shape_stream(stream, gap=5, max_hold=20, limit=3, window=60, delay="1 minute"))
    batch = shaping.deliverable(*shaping.shape_events(canonical(spark.createDataFrame(rows, RAW)), 5, 20, 3, 60), 60)
    assert shown(got) == shown(batch)
    assert batch.filter("category = 'security'").count() > 3 and batch.filter("received_at IS NULL").count() == 3


def test_missing_times_do_not_end_single_streams(spark, tmp_path):
    rows, _ = raw_rows(3)
    (tmp_path / "a").mkdir()
    stream = streamed(spark, str(tmp_path / "a"), rows, RAW, 2)
    folded = drain(coalesce_repeats_stream(stream, ["server_id", "source", "action"], 5, 20, ["amount"]))
    assert folded.filter("received_at IS NULL AND admit_at IS NULL AND NOT is_rollup").count() == 3
    limited = drain(rate_limit_stream(stream.withColumn("admit_at", F.col("received_at")), 3, 60))
    assert limited.filter("received_at IS NULL").count() == 3
    assert limited.filter("source IS NULL AND dropped IS NULL").count() == sum(r[4] is None for r in rows)
