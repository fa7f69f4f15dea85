import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidewatch.operators import shaping
from tidewatch.operators.canonical import CANONICAL
from tidewatch.operators.identity import party

START = datetime(2024, 1, 1)
SCHEMA = ("server_id string, who string, arrival_seq long, received_at timestamp, occurred_at timestamp, "
          "amount decimal(18,2), event_id string, transaction_id string")


def events(spark, rows):
    """rows: (who, seconds, amount)"""
    data = [("s", who, i, START + timedelta(seconds=s), START + timedelta(seconds=int(s)), Decimal(a), f"e{i}", f"t{i}")
            for i, (who, s, a) in enumerate(rows)]
    return spark.createDataFrame(data, SCHEMA)


def fold(df, **more):
    return shaping.coalesce_repeats(df, ["server_id", "who"], sums=["amount"], **more)


def by_hand(rows, gap, hold):
    """Row at a time, as one server would do it."""
    runs, out = {}, []
    for i, (who, s, amount) in sorted(enumerate(rows), key=lambda r: (r[1][1], r[0])):
        run = runs.get(who)
        if run and (s - run["last"] >= gap or s - run["opened"] >= hold):
            out += [("total", who, run["n"], run["sum"])] if run["n"] else []
            run = None
        if run:
            run["n"] += 1
            run["sum"] += amount
            run["last"] = s
        else:
            out.append(("first", who, None, amount))
            runs[who] = {"opened": s, "last": s, "n": 0, "sum": 0}
    out += [("total", who, r["n"], r["sum"]) for who, r in runs.items() if r["n"]]
    return sorted(out, key=repr)


def shown(df):
    return sorted((("total" if r.is_rollup else "first", r.who, r.repeats, int(r.amount)) for r in df.collect()), key=repr)


def test_first_passes_and_repeats_become_one_total(spark):
    rows = fold(events(spark, [("a", 0, 50), ("a", 2, 75), ("a", 4, 25), ("a", 6, 100)])).orderBy("is_rollup").collect()
    assert [(r.amount, r.repeats) for r in rows] == [(50, None), (200, 3)]
    assert rows[0].event_id != rows[1].event_id and rows[1].transaction_id is None and rows[0].transaction_id == "t0"
    assert rows[1].occurred_at == START + timedelta(seconds=2)
    assert rows[1].repeated_until == START + timedelta(seconds=6)
    assert rows[1].admit_at == START + timedelta(seconds=16)


def test_a_loop_that_never_pauses(spark):
    rows = fold(events(spark, [("a", s, 5) for s in range(130)])).collect()
    assert len(rows) == 6 and sum(r.amount for r in rows) == 650


def test_forty_players_paid_each_second(spark):
    rows = fold(events(spark, [(f"p{p}", s, 50) for p in range(40) for s in range(60)])).collect()
    assert len(rows) == 80 and sum(r.amount for r in rows) == 120_000


def test_gap_boundary_closes(spark):
    assert len(fold(events(spark, [("a", 0, 1), ("a", 10, 1)])).collect()) == 2
    assert [r.repeats for r in fold(events(spark, [("a", 0, 1), ("a", 9.999, 1)])).collect()] == [None, 1]


def test_zero_gap_disables(spark):
    assert len(fold(events(spark, [("a", 0, 1)] * 5), gap=0).collect()) == 5


def test_flush_closes_open_runs_early(spark):
    df = events(spark, [("a", 0, 1), ("a", 3, 1)])
    rollup = fold(df, flush_at="2024-01-01 00:00:05").filter("is_rollup").first()
    assert rollup.admit_at == START + timedelta(seconds=5)


@pytest.mark.parametrize("hot_rows", [None, 5, 37])
def test_any_split_equals_the_walk_by_hand(spark, hot_rows):
    dice = random.Random(7)
    rows, clock = [], 0
    for _ in range(400):
        clock += dice.choice([0, 1, 1, 2, 3, 12])
        rows.append((dice.choice("aaaab"), clock, dice.randint(1, 9)))
    df = events(spark, rows).repartition(5)
    assert shown(fold(df, hot_rows=hot_rows)) == by_hand(rows, 10, 60)
    assert shown(fold(df, gap=20, max_hold=25, hot_rows=hot_rows)) == by_hand(rows, 20, 25)


def test_conservation(spark):
    df = events(spark, [("ab"[i % 2], i % 50, i) for i in range(200)])
    assert shaping.conservation_check(df, fold(df), ["server_id", "who"], ["amount"]).count() == 0
    lost = fold(df).filter(~F.col("is_rollup"))
    assert shaping.conservation_check(df, lost, ["server_id", "who"], ["amount"]).count() == 2


def test_flooding_player_is_capped_and_reported_once(spark):
    data = [("s", 7, i, START + timedelta(milliseconds=i)) for i in range(350)]
    data += [("s", 8, 400, START), *[("s", None, 500 + i, START) for i in range(400)]]
    df = spark.createDataFrame(data, "server_id string, source int, arrival_seq long, received_at timestamp")
    kept = shaping.rate_limit(df, source="source")
    assert {r.source: r.n for r in kept.groupBy("source").agg(F.count("*").alias("n")).collect()} == {7: 300, 8: 1, None: 400}
    report = shaping.rate_limit_report(df, source="source", actor="arrival_seq").collect()
    assert [(r.source, r.dropped, r.actor, r.action) for r in report] == [(7, 50, 300, "rate_limit_triggered")]
    assert report[0].reason == "350 events in a minute; logging kept 300 and dropped the rest"
    assert shaping.rate_limit(df, limit=0, source="source").count() == 751
    assert shaping.rate_limit_report(df, limit=0, source="source", actor="arrival_seq").count() == 0


def test_group_limit_is_cut_before_the_shuffle(spark):
    df = spark.range(5000).selectExpr("'s' server_id", "1 source", "id arrival_seq", "timestamp_seconds(id) received_at")
    plan = shaping.rate_limit(df, source="source")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_volume_label(spark):
    df = spark.createDataFrame([(None, "money", "cash_added", START)] * 3 + [("shop", "money", "sold", START)],
                               "channel string, category string, action string, received_at timestamp")
    rows = shaping.top_volume(df, 5).collect()
    assert [(r.label, r.events) for r in rows] == [("money cash_added", 3), ("shop sold", 1)]


def test_report_as_event_is_stored_once(spark):
    data = [("s", 7, n, START + timedelta(seconds=n)) for n in range(80)]
    df = spark.createDataFrame(data, "server_id string, source int, arrival_seq long, received_at timestamp")
    df = df.withColumn("actor", party(source=F.col("source"), name=F.lit("Ada")))
    sent = [shaping.report_events(shaping.rate_limit_report(df, limit=30)).orderBy("received_at") for _ in range(2)]
    assert sent[0].columns == list(CANONICAL)
    first, again = (s.collect() for s in sent)
    assert first == again and len(first) == 1
    row = first[0]
    assert (row.actor.name, row.received_at, row.action) == ("Ada", START + timedelta(seconds=60), "rate_limit_triggered")
    assert row.data == {"dropped": "30", "reason": '"60 events in a minute; logging kept 30 and dropped the rest"'}
    assert row.context == {"resource": '"tidewatch"'} and len(row.event_id) == 32
