"""NULL keys and times, skew paths and callers' own data lose nothing."""

from collections import Counter
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidewatch.functions.text import lua_number, number_json, parse_money_text
from tidewatch.operators import delivery, shaping, validate
from tidewatch.plans.ordered import arrange
from tidewatch.sources import sinks

START = datetime(2024, 1, 1)
SCHEMA = ("server_id string, who string, arrival_seq long, received_at timestamp, occurred_at timestamp, "
          "amount decimal(18,2), event_id string, transaction_id string")


def events(spark, rows):
    """rows: (who, seconds or None)"""
    return spark.createDataFrame(
        [("s", who, i, None if s is None else START + timedelta(seconds=s), START, Decimal(1), f"e{i}", None)
         for i, (who, s) in enumerate(rows)], SCHEMA)


def conserved(df):
    return df.agg(F.sum(F.when(F.col("is_rollup"), F.col("repeats")).otherwise(1))).first()[0]


@pytest.mark.parametrize("hot_rows", [None, 30])
def test_null_keys_fold_alike_on_both_paths(spark, monkeypatch, hot_rows):
    monkeypatch.setattr("tidewatch.plans.ordered._surely_small", lambda *_: False)
    before = events(spark, [("a" if i % 2 else None, i * 3) for i in range(200)])
    after = shaping.coalesce_repeats(before, ["server_id", "who"], sums=["amount"], hot_rows=hot_rows)
    assert conserved(after) == 200
    shown = Counter((r.who, r.is_rollup, r.repeats) for r in after.collect())
    plain = shaping.coalesce_repeats(before, ["server_id", "who"], sums=["amount"], hot_rows=None)
    assert shown == Counter((r.who, r.is_rollup, r.repeats) for r in plain.collect())
    assert shaping.conservation_check(before, after, ["server_id", "who"], ["amount"]).count() == 0


def test_many_hot_keys(spark, monkeypatch):
    """More hot keys than any list on the driver should hold."""
    monkeypatch.setattr("tidewatch.plans.ordered._surely_small", lambda *_: False)
    df = spark.range(6000).select((F.col("id") % 1200).alias("k"), F.col("id").alias("t"))
    rows = arrange(df, ["k"], ["t"], hot_rows=3).running_sum(F.lit(1), "n")
    assert rows.sliced
    assert sorted(r.n for r in rows.df.collect()) == sorted(n for n in range(1, 6) for _ in range(1200))


def test_rows_without_a_time_pass(spark):
    got = shaping.coalesce_repeats(events(spark, [("a", 0), ("a", None), ("a", 2)]), ["server_id", "who"], sums=["amount"]).collect()
    assert len(got) == 3
    alone = [r for r in got if r.received_at is None]
    assert len(alone) == 1 and alone[0].repeats is None and not alone[0].is_rollup and alone[0].admit_at is None


def test_batches_of_a_null_boot(spark):
    rows = [("s", None if i % 2 else "b", START, 0, 10, f"p{i}") for i in range(20)]
    df = spark.createDataFrame(rows, "server_id string, boot_id string, received_at timestamp, arrival_seq long, event_bytes long, payload string")
    got = delivery.pack_batches(df, max_events=3).collect()
    assert sorted(e for r in got for e in r.events) == sorted(r[5] for r in rows)
    assert max(r.event_count for r in got) == 3


def test_replay_across_midnight_is_stored_once(spark, tmp_path):
    schema = "server_id string, event_id string, category string, received_at timestamp, arrival_seq long"
    for seq, at in enumerate((datetime(2024, 1, 1, 23, 59, 58), datetime(2024, 1, 2, 0, 0, 3))):
        sinks.write_canonical(spark.createDataFrame([("s", "a", "money", at, seq)], schema), str(tmp_path / "table"))
    assert [r.arrival_seq for r in sinks.read_canonical(spark, str(tmp_path / "table")).collect()] == [0]


def test_money_needs_the_whole_text(spark):
    rows = spark.createDataFrame([("$1,250",), ("$1,250\n",)], "t string").select(parse_money_text(F.col("t"))["number"].alias("n"))
    assert [r.n is None for r in rows.collect()] == [False, True]


def test_lists_match_names_beyond_ascii(spark):
    df = spark.createDataFrame([("BÄR", "bread"), ("other", "bread")], "resource string, item_name string")
    assert [r.resource for r in validate.drop_ignored_creators(df, ["BÄR"]).collect()] == ["other"]


def test_large_and_small_numbers(spark):
    texts = ["1e30", "12345678901234567890123", "0xFFFFFFFFFFFFFFFF", "0.0000001", "-0x10", "7"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("n", lua_number(F.col("t")))
    assert [int(r.n * 10**7) for r in df.collect()] == [10**37, 12345678901234567890123 * 10**7, (2**64 - 1) * 10**7, 1, -16 * 10**7, 7 * 10**7]
    assert [r.j for r in df.select(number_json(F.col("n")).alias("j")).collect()][2:] == ["18446744073709551615", "0.0000001", "-16", "7"]
    assert df.agg(F.sum("n")).first()[0] is not None


def test_callers_own_repeats_are_overwritten(spark):
    """Data that already holds `repeats` does not end the job."""
    rows = [("s", i, START + timedelta(seconds=i), START, f"e{i}", None, "cash_added", {"zone": '"1"'},
             {"amount": "5", "repeats": "9", "repeatedUntil": '"x"'}) for i in range(3)]
    df = spark.createDataFrame(rows, "server_id string, arrival_seq long, received_at timestamp, occurred_at timestamp, event_id string, "
                                     "transaction_id string, action string, context map<string,string>, data map<string,string>")
    none = ("channel", "category", "severity", "actor", "target", "correlation_id", "session_id", "entity_id")
    df = df.withColumns({name: F.lit(None).cast("string") for name in none})
    total = [r for r in shaping.fold_events(df).collect() if r.is_rollup]
    assert len(total) == 1 and total[0].data["repeats"] == "2" and total[0].data["amount"] == "10"


def test_rows_without_time_player_or_number_pass_the_ceiling(spark):
    rows = [("s", 1, None, None)] * 3 + [("s", None, START, i) for i in range(4)] + [("s", None, START, None)] * 3 + [("s", 2, START, None)] * 5
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "server_id string, source int, received_at timestamp, arrival_seq long, id int")
    kept = Counter((r.source, r.received_at is None) for r in shaping.rate_limit(df, 2, source="source").collect())
    assert kept == {(1, True): 3, (None, False): 7, (2, False): 2}
    report = shaping.rate_limit_report(df, 2, source="source", actor="id").collect()
    assert [(r.source, r.dropped) for r in report] == [(2, 3)] and report[0].window_start == START


def test_events_without_an_id_are_no_copies(spark):
    rows = [("s", None, START, i) for i in range(3)] + [("s", "a", START, 7), ("s", "a", START, 5)]
    df = spark.createDataFrame(rows, "server_id string, event_id string, received_at timestamp, arrival_seq long")
    assert sorted(r.arrival_seq for r in delivery.dedup_events(df).collect()) == [0, 1, 2, 5]
