import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidewatch.operators import delivery

T0 = datetime(2024, 1, 1)


def greedy(sizes, most, room):
    batches, open_ = [], []
    for size in sizes:
        if open_ and (len(open_) >= most or sum(open_) + size > room):
            batches.append(open_)
            open_ = []
        open_.append(size)
    return batches + ([open_] if open_ else [])


@pytest.mark.parametrize("hot_rows", [None, 25])
def test_batches_equal_the_greedy_walk(spark, hot_rows):
    dice = random.Random(3)
    sizes = [dice.choice([1, 5, 40, 90, 150]) for _ in range(300)]
    df = spark.createDataFrame([("s", "b", i, size, str(i)) for i, size in enumerate(sizes)],
                               "server_id string, boot_id string, arrival_seq long, event_bytes long, payload string")
    got = delivery.pack_batches(df.repartition(4), order=["arrival_seq"], max_events=7, max_body=2048 + 120,
                                hot_rows=hot_rows).orderBy("seq").collect()
    want = greedy(sizes, 7, 120)
    assert [r.payload_bytes for r in got] == [sum(b) for b in want]
    assert [r.seq for r in got] == list(range(1, len(want) + 1))
    assert [p for r in got for p in r.events] == [str(i) for i in range(300)]


def test_newest_events_stay(spark):
    df = spark.createDataFrame([("s", i, T0, 10) for i in (1, 2, 3)],
                               "server_id string, arrival_seq long, received_at timestamp, event_bytes long")
    kept = delivery.trim_backlog(df, max_events=2)
    assert sorted(r.arrival_seq for r in kept.collect()) == [2, 3]
    assert delivery.backlog_dropped(df, kept).first().dropped == 1
    assert [r.arrival_seq for r in delivery.trim_backlog(df, max_bytes=10).collect()] == [3]


def attempts(spark, rows):
    """rows: (status, accepted, seconds to the answer)"""
    data = [("s", i, T0 + timedelta(minutes=i), None if wait is None else T0 + timedelta(minutes=i, seconds=wait),
             status, accepted, "0", "0", 1) for i, (status, accepted, wait) in enumerate(rows)]
    return spark.createDataFrame(data, "server_id string, attempt_seq long, sent_at timestamp, response_at timestamp, status int, "
                                       "accepted string, duplicates string, rejected string, event_count int")


def test_outcomes_streaks_and_status(spark):
    rows = [(503, None, 1), (401, None, 1), (413, None, 1), (0, None, 1), (202, "1", 15), (202, "1", 2), (200, "0.5", 1),
            (302, None, 1), (200, None, None), (404, None, 1)]
    out = delivery.failure_streaks(delivery.classify_attempts(attempts(spark, rows))).orderBy("attempt_seq").collect()
    assert [r.outcome for r in out] == ["retry", "retry", "discard", "retry", "retry", "ack", "retry", "retry", "retry", "retry"]
    assert [r.failures for r in out] == [1, 2, 2, 3, 4, 0, 1, 2, 3, 4]
    assert [r.delay_ms for r in out] == [1000, 60000, None, 4000, 8000, None, 1000, 2000, 4000, 8000]
    assert out[0].max_jitter_ms == 250
    status = delivery.delivery_status(delivery.failure_streaks(delivery.classify_attempts(attempts(spark, rows)))).first()
    assert (status.sent, status.dropped, status.failed, status.in_flight, status.failures) == (1, 1, 8, 1, 4)
    assert (status.last_success_at, status.last_error) == ("2024-01-01T00:05:02Z", "HTTP 404")


def test_dedup_is_idempotent(spark):
    df = spark.createDataFrame([("s", "a", T0, 2), ("s", "a", T0, 1), ("t", "a", T0, 3), ("s", "b", T0, 4)],
                               "server_id string, event_id string, received_at timestamp, arrival_seq long")
    once = delivery.dedup_events(df)
    assert sorted(r.arrival_seq for r in once.collect()) == [1, 3, 4]
    assert sorted(map(str, delivery.dedup_events(once).collect())) == sorted(map(str, once.collect()))


def test_missing_batches(spark):
    df = spark.createDataFrame([("s", "b", 1, 0), ("s", "b", 1, 0), ("s", "b", 4, 7)],
                               "server_id string, boot_id string, seq long, dropped_since_last long")
    row = delivery.loss_accounting(df).first()
    assert (row.batches, row.dropped_reported, row.missing_batches) == (2, 7, 2)
