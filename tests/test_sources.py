import hashlib
import json
import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidewatch.sources import raw, sinks, snapshots, spools
from tidewatch.sources.schemas import HOOKS, hook_schema


def test_broken_lines_are_kept_aside(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"server_id":"s","arrival_seq":1,"event":"add","amount":5,"account":"bank"}\n{"server_id":\n')
    rows = raw.read_raw(spark, str(tmp_path), "account_money").cache()
    assert [(r.server_id, int(r.amount)) for r in raw.intact(rows).collect()] == [("s", 5)]
    assert rows.filter(F.col("_corrupt_record").isNotNull()).count() == 1


def test_polymorphic_values_keep_their_json_type(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"server_id":"s","from_slot":{"name":"x"},"to_slot":4}\n')
    row = raw.read_raw(spark, str(tmp_path), "swap_items").first()
    assert (row.from_slot, row.to_slot) == ('{"name":"x"}', "4")


def test_every_hook_has_a_schema(spark):
    for hook in HOOKS:
        assert "server_id" in spark.createDataFrame([], hook_schema(hook)).columns


def snapshot(data, digest=None):
    text = data if isinstance(data, str) else json.dumps(data)
    return json.dumps({"data": text, "sha256": digest or hashlib.sha256(text.encode()).hexdigest()})


ITEM = {"payload": {"id": "stable", "at": "2026-09-05T00:00:00Z"}, "bytes": 40}
FLIGHT = {"body": json.dumps({"events": [{"id": "first"}, {"id": "second"}]}), "count": 2}


@pytest.mark.parametrize("content,reason", [
    (snapshot({"v": 1, "queued": [ITEM], "flight": FLIGHT, "dropped": 3}), None),
    (snapshot({"v": 1, "queued": []}), None),
    ("{broken", "unreadable"),
    (snapshot({"v": 1, "queued": []}, "0" * 64), "checksum"),
    (snapshot({"v": 2, "queued": []}), "version"),
    (snapshot({"v": 1, "queued": 4}), "queue"),
    (snapshot({"v": 1, "queued": [{"payload": {}, "bytes": "bad"}]}), "item"),
    (snapshot({"v": 1, "queued": [{"payload": 4, "bytes": 3}]}), "item"),
    (snapshot({"v": 1, "queued": [], "flight": {"body": "{}", "count": 1}}), "flight"),
    (snapshot({"v": 1, "queued": [], "dropped": -1}), "dropped"),
])
def test_snapshots(spark, tmp_path, content, reason):
    (tmp_path / "spool.json").write_text(content)
    events, bad = snapshots.read_snapshots(spark, str(tmp_path / "*.json"))
    refused = bad.collect()
    assert [r.reason for r in refused] == ([reason] if reason else [])
    if reason:
        assert refused[0].content == content and events.count() == 0


def test_snapshot_events_come_in_replay_order(spark, tmp_path):
    (tmp_path / "spool.json").write_text(snapshot({"v": 1, "queued": [ITEM], "flight": FLIGHT}))
    rows = snapshots.read_snapshots(spark, str(tmp_path / "*.json"))[0].orderBy("position").collect()
    assert [(r.part, json.loads(r.payload)["id"]) for r in rows] == [("flight", "first"), ("flight", "second"), ("queued", "stable")]
    assert rows[2].event_bytes == 40 and rows[2].recovered


def test_a_stream_of_spools_reads_each_file_once_and_again_when_written_anew(spark, tmp_path):
    place, state = tmp_path / "spools", str(tmp_path / "state")
    place.mkdir()
    (place / "a.json").write_text(snapshot({"v": 1, "queued": [ITEM], "flight": FLIGHT}))
    (place / "b.json").write_text(snapshot({"v": 1, "queued": []}, "0" * 64))
    (place / "_hidden").write_text("x")

    def run():
        rows = snapshots.read_snapshots_stream(spark, str(place), settle_seconds=0)
        query = rows.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", state)
        query.trigger(processingTime="0 seconds")
        running = query.start()
        running.processAllAvailable()
        running.stop()
        out = spark.read.schema(rows.schema).parquet(str(tmp_path / "out")).collect()
        return sorted((r.path.split("/")[-1], r.reason or r.part) for r in out)

    first = [("a.json", "flight"), ("a.json", "flight"), ("a.json", "queued"), ("b.json", "checksum")]
    assert run() == first
    assert run() == first
    time.sleep(0.01)
    (place / "c.json").write_text(snapshot({"v": 1, "queued": [ITEM]}))
    (place / "b.json").write_text(snapshot({"v": 1, "queued": [ITEM]}))
    assert run() == sorted(first + [("b.json", "queued"), ("c.json", "queued")])


def test_large_spools_are_not_loaded(spark, tmp_path):
    (tmp_path / "large.json").write_text(snapshot({"v": 1, "queued": [ITEM] * 100}))
    (tmp_path / "small.json").write_text(snapshot({"v": 1, "queued": [ITEM]}))
    spools.register(spark)
    rows = {r.path.split("/")[-1]: r for r in spark.read.format("spool").option("maxBytes", 1000).load(str(tmp_path)).collect()}
    assert (rows["large.json"].reason, rows["large.json"].content) == ("too_large", None)
    assert rows["small.json"].reason is None and rows["small.json"].length < 1000


def test_tasks_hold_files_up_to_a_size(monkeypatch):
    monkeypatch.setattr(spools, "TASK_BYTES", 100)
    sizes = [[f[2] for f in task.files] for task in spools._dealt([(0, str(i), n) for i, n in enumerate((40, 50, 20, 300, 10))])]
    assert sizes == [[40, 50], [20], [300], [10]]


def test_spools_of_many_characters_are_replayed(spark, tmp_path):
    # More than the 20,000,000 characters that Spark reads of a JSON string by default, less than the largest spool.
    items = [{"payload": {"id": k, "text": "x" * 900_000}, "bytes": 900_040} for k in range(25)]
    (tmp_path / "spool.json").write_text(snapshot({"v": 1, "queued": items}))
    events, bad = snapshots.read_snapshots(spark, str(tmp_path / "*.json"))
    assert [r.reason for r in bad.select("reason").collect()] == []
    rows = events.select("position", "event_bytes", F.get_json_object("payload", "$.id").alias("id")).collect()
    assert sorted(tuple(r) for r in rows) == [(k, 900_040, str(k)) for k in range(25)]


def test_a_filter_on_the_reason_does_not_parse_files_anew(spark, tmp_path):
    (tmp_path / "spool.json").write_text(snapshot({"v": 1, "queued": [ITEM]}))
    for rows in snapshots.read_snapshots(spark, str(tmp_path / "*.json")):
        plan = rows._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json(") == 1


def test_files_are_dealt_over_the_tasks_wanted(monkeypatch):
    monkeypatch.setattr(spools, "LEAST_TASK_BYTES", 20)
    files = [(0, str(i), n) for i, n in enumerate((40, 50, 5, 5, 5, 45))]
    assert [[f[2] for f in task.files] for task in spools._dealt(files, 3)] == [[40], [50], [5, 5, 5], [45]]
    assert [len(task.files) for task in spools._dealt(files[2:5], 3)] == [3]


@pytest.mark.parametrize("text,reason,payloads", [
    ("[1,2]", "version", []),
    ("null", "not_json", []),
    ('{"v":1,"queued":{}}', None, []),
    ('{"v":1,"queued":null}', "queue", []),
    ('{"v":1,"queued":[{"payload":{},"bytes":3},null]}', "item", []),
    ('{"v":1,"queued":[{"payload":{"b":1e5,"a":1.50},"bytes":2e1}]}', None, [('{"a":1.5,"b":100000}', 20)]),
    ('{"v":1,"queued":[],"flight":null}', None, []),
    ('{"v":1,"queued":[],"flight":{"body":{"events":[1]},"count":1}}', "flight", []),
    ('{"v":1,"queued":[],"flight":{"body":"{\\"events\\":[1e2,null]}","count":2}}', None, [("100", None), ("null", None)]),
])
def test_snapshots_of_unusual_json(spark, tmp_path, text, reason, payloads):
    (tmp_path / "spool.json").write_text(snapshot(text))
    events, bad = snapshots.read_snapshots(spark, str(tmp_path / "*.json"))
    assert [r.reason for r in bad.collect()] == ([reason] if reason else [])
    assert [(r.payload, r.event_bytes) for r in events.orderBy("position").collect()] == payloads


def test_writing_twice_stores_once(spark, tmp_path):
    at = datetime(2024, 1, 1)
    df = spark.createDataFrame([("s", "a", "money", at, 1), ("s", "a", "money", at, 2), ("s", "b", "staff", at, 3)],
                               "server_id string, event_id string, category string, received_at timestamp, arrival_seq long")
    path = str(tmp_path / "table")
    for _ in range(2):
        sinks.write_canonical(df, path)
    assert sorted(r.arrival_seq for r in sinks.read_canonical(spark, path).collect()) == [1, 3]


EVENT = "server_id string, event_id string, category string, received_at timestamp, arrival_seq long"


def day(spark, number, ids):
    return spark.createDataFrame([("s", i, "money", datetime(2024, 1, number), 100 * number + k) for k, i in enumerate(ids)], EVENT)


def test_a_batch_opens_only_files_that_may_hold_its_ids(spark, tmp_path):
    path = str(tmp_path / "table")
    for number in (1, 2, 3):
        sinks.write_canonical(day(spark, number, [f"d{number}-{k}" for k in range(50)]).coalesce(1), path, commit=f"day{number}")
    late = day(spark, 9, ["d2-7", "new", None])
    assert {name.split("/")[0] for name in sinks.may_hold(late, path)} == {"day2"}
    sinks.write_canonical(late, path, commit="late")
    stored = sinks.read_canonical(spark, path)
    assert stored.count() == 152 and stored.filter("event_id = 'd2-7'").first().arrival_seq == 207
    # Run again after a failure: the same commit, nothing twice, not even the event without an id.
    sinks.write_canonical(late, path, commit="late")
    assert sinks.read_canonical(spark, path).filter("event_id IS NULL").count() == 1
    sinks.compact(spark, path, 2)
    whole = sinks.read_canonical(spark, path)
    assert whole.count() == 152 and len(whole.inputFiles()) <= 2
    sinks.write_canonical(day(spark, 4, ["d1-1", "d4-0"]), path)
    assert sinks.read_canonical(spark, path).count() == 153
    sinks.write_canonical(day(spark, 5, ["only"]), path, mode="overwrite")
    assert [r.event_id for r in sinks.read_canonical(spark, path).collect()] == ["only"]


def test_more_ids_than_are_looked_up_singly(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sinks, "LOOKED_UP", 3)
    path = str(tmp_path / "table")
    for number in (1, 2):
        sinks.write_canonical(day(spark, number, [f"i{k}" for k in range(40 * number)]), path)
    assert sinks.read_canonical(spark, path).count() == 80


def test_a_killed_write_leaves_nothing_readable(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "table")
    sinks.write_canonical(day(spark, 1, ["a"]), path)

    def dies(*_):
        raise RuntimeError("killed")

    with monkeypatch.context() as patched:
        patched.setattr(sinks, "_commit", dies)
        with pytest.raises(RuntimeError):
            sinks.write_canonical(day(spark, 2, ["b"]), path, commit="second")
    assert [r.event_id for r in sinks.read_canonical(spark, path).collect()] == ["a"]
    sinks.write_canonical(day(spark, 2, ["b"]), path, commit="second")
    assert sorted(r.event_id for r in sinks.read_canonical(spark, path).collect()) == ["a", "b"]


def test_an_unreadable_table_is_not_taken_for_none(spark, tmp_path):
    (tmp_path / "table" / "commits").mkdir(parents=True)
    (tmp_path / "table" / "commits" / "part.parquet").write_text("not parquet")
    with pytest.raises(Exception, match="(?i)parquet"):
        sinks.write_canonical(day(spark, 1, ["a"]), str(tmp_path / "table"))


def test_quarantine(spark, tmp_path):
    df = spark.createDataFrame([(1, None), (2, "bad_data")], "i long, reason string")
    path = str(tmp_path / "rows")
    sinks.write_quarantine(df, path)
    assert [r.i for r in sinks.accepted(spark, path).collect()] == [1]
    assert [(r.i, r.reason) for r in sinks.refused(spark, path).collect()] == [(2, "bad_data")]
