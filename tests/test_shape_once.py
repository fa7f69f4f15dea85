"""Shaping asks its input for every event once, and streams fold rows of unknown players like the batch does."""

from pyspark.sql import functions as F
from test_shape_stream import RAW, canonical, raw_rows
from test_streamed_identity import streamed

from tidewatch.catalog.streams import drain
from tidewatch.operators import shaping
from tidewatch.streaming import coalesce_repeats_stream


def test_shape_events_takes_its_input_once(spark):
    rows, _ = raw_rows(5)
    taken = spark.sparkContext.accumulator(0)

    def counted(frames):
        for frame in frames:
            taken.add(len(frame))
            yield frame

    raw = spark.createDataFrame(rows, RAW)
    admitted, report = shaping.shape_events(canonical(raw.mapInPandas(counted, RAW)), 5, 20, 3, 60, hot_rows=20)
    assert shaping.deliverable(admitted, report, 60).count() > 100
    assert taken.value == len(rows)


def test_null_keys_of_a_stream_fold_like_the_batch(spark, tmp_path):
    rows, end = raw_rows(7)
    rows = [(None if r[1] % 5 == 0 else r[0], *r[1:]) for r in rows if r[2] is not None]
    keys = ["server_id", "source", "action"]
    shown = [*keys, "arrival_seq", F.col("amount").cast("long").alias("amount"), "repeats", "is_rollup", "admit_at"]
    got = drain(coalesce_repeats_stream(streamed(spark, str(tmp_path), rows + end, RAW, 2), keys, 5, 20, ["amount"]))
    want = shaping.coalesce_repeats(spark.createDataFrame(rows, RAW), keys, 5, 20, ["amount"])
    table = lambda df: sorted(map(str, df.filter("action <> 'end' AND NOT is_rollup").select(*shown).collect()))
    assert table(got) == table(want) and len(table(want)) > 50
