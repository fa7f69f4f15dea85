"""Totals counted while a write runs, and the table of what streams dropped."""

import pytest
from pyspark.sql import functions as F
from test_null_keys import events

from tidewatch.operators import shaping
from tidewatch.streaming.health import Health, late_rows, read_health


@pytest.mark.parametrize("hot_rows", [None, 30])
def test_folding_is_watched(spark, tmp_path, monkeypatch, hot_rows):
    monkeypatch.setattr("tidewatch.plans.ordered._surely_small", lambda *_: False)
    df = events(spark, [("a" if i % 2 else None, None if i % 10 == 0 else i * 3) for i in range(200)])
    watch = shaping.Watch(["amount"])
    folded = shaping.coalesce_repeats(df, ["server_id", "who"], sums=["amount"], hot_rows=hot_rows, watch=watch)
    folded.write.parquet(str(tmp_path / "folded"))
    assert {name: tuple(map(int, pair)) for name, pair in watch.check().items()} == {"events": (200, 200), "amount": (200, 200)}
    assert spark.read.parquet(str(tmp_path / "folded")).count() < 200


def test_a_loss_is_seen(spark, tmp_path):
    watch = shaping.Watch(["amount"])
    rows = watch.offered(events(spark, [("a", i) for i in range(10)]))
    lost = rows.filter("arrival_seq <> 3").withColumns({"is_rollup": F.lit(False), "repeats": F.lit(None).cast("long")})
    watch.kept(lost).write.parquet(str(tmp_path / "rows"))
    with pytest.raises(ValueError, match="events.*10, 9.*amount"):
        watch.check()


def test_health_keeps_errors_and_appends_in_parts(spark, tmp_path):
    health = Health(spark, str(tmp_path / "health"), held=1)
    spark.range(5).write.parquet(str(tmp_path / "in"))
    spark.streams.addListener(health)
    try:
        rows = spark.readStream.schema("id long").parquet(str(tmp_path / "in"))
        broken = rows.select(F.assert_true(F.col("id") < 3), "id")
        for name, stream in (("whole", rows), ("broken", broken)):
            query = stream.writeStream.queryName(name).option("checkpointLocation", str(tmp_path / name))
            query = query.format("parquet").option("path", str(tmp_path / f"{name}-out")).trigger(availableNow=True).start()
            if name == "whole":
                query.awaitTermination()
            else:
                with pytest.raises(Exception, match="(?s)id < 3|USER_RAISED|STREAM_FAILED"):
                    query.awaitTermination()
        for _ in range(100):
            health.flush()
            found = read_health(spark, str(tmp_path / "health"))
            if found.filter("error IS NOT NULL").count():
                break
    finally:
        spark.streams.removeListener(health)
    assert found.filter("error IS NOT NULL").count() == 1
    shown = late_rows(found.filter("error IS NULL AND input_rows > 0")).filter("query = 'whole'").first()
    assert (shown.input_rows, shown.late_rows) == (5, 0)
