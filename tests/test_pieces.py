import hashlib
import io
import json
import random

import pytest
from pyspark.sql import functions as F

from tidewatch import fixed
from tidewatch.sources import pieces, snapshots, spools

ITEM = {"payload": {"id": "stable", "text": 'a "quoted" \\ text},{ \U0001f600 \ud83d é'}, "bytes": 40}
FLIGHT = {"body": json.dumps({"events": [{"id": "first"}, {"id": "second"}]}), "count": 2}


def spool(data, digest=None, ascii_only=True):
    text = data if isinstance(data, str) else json.dumps(data)
    digest = digest or hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()
    return json.dumps({"data": text, "sha256": digest}, ensure_ascii=ascii_only)


def blocks(text, size):
    return pieces.blocks_of(io.BytesIO(text.encode()), size)


CASES = [
    spool({"v": 1, "queued": [ITEM] * 30, "flight": FLIGHT, "dropped": 3}),
    spool({"dropped": 0, "flight": None, "queued": [], "v": 1.0}),
    spool({"v": 1, "queued": [{"payload": [[{}, {}], 1], "bytes": 2.0}, {"payload": {"a": {}, "b": {}}, "bytes": 3}]}),
    "{broken", "", "[]", "{}", spool({"v": 1, "queued": []}) + "x", '{"data":7,"sha256":"x"}', '{"data":"x","sha256":null}',
    '{"data":"\\', '{"data":"abc', '{"data":"x"', '{"data":"x","sha256":tru}',
    spool({"v": 1, "queued": []}, "0" * 64), spool({"v": 2, "queued": []}), spool({"v": "1", "queued": []}), spool({"queued": []}),
    spool({"v": 1}), spool({"v": 1, "queued": 4}), spool({"v": 1, "queued": {}}), spool({"v": 1, "queued": {"a": 1}}),
    spool({"v": 1, "queued": [{"payload": {}, "bytes": "bad"}]}), spool({"v": 1, "queued": [ITEM, {"payload": 4, "bytes": 3}]}),
    spool({"v": 1, "queued": [ITEM] * 9 + [None]}), spool({"v": 1, "queued": [{"payload": {}, "bytes": True}]}),
    spool('{"v":1,"queued":[{"payload":{},"bytes":0}]}'), spool('{"v":1,"queued":[{"payload":{},"bytes":1e400}]}'),
    spool('{"v":1,"queued":[{"payload":{},"bytes":20.00000001},{"payload":{},"bytes":2e1}]}'),
    spool('{"v":1,"queued":[{"payload":{},"bytes":20.001}]}'), spool('{"v":1,"queued":[{"payload":{},"bytes":9007199254740992}]}'),
    spool('{"v":1,"queued":[{"payload":{"a":1,"a":2},"bytes":3}]}'), spool('{"v":2,"v":1,"queued":[null],"queued":[]}'),
    spool('{"v":1,"queued":{},"queued":[{"payload":{},"bytes":3}]}'), spool('{"v":1,"queued":[{"payload":{},"bytes":3}],"queued":{}}'),
    spool('{"v":1,"queued":[{"payload":{"a":NaN},"bytes":3}]}'), spool('{"v":1,"queued":[{"payload":{},"bytes":3},]}'),
    spool('{"v":1,"queued":[{"payload":{"b":1e5,"a":1.50},"bytes":2e1}]}'), spool('{"v":1,"queued":[]'), spool("not json"),
    spool("[1,2]"), spool("[1,2"), spool("null"), spool('"text"'), spool(' { "v" : 1 , "queued" : [ ] } '), spool('{"v":01,"queued":[]}'),
    spool('{"v":1,"queued":[]} x'), spool('{"v":1,"queued":[]} {}'), spool(""), spool("   "),
    spool({"v": 1, "queued": [], "dropped": -1}), spool({"v": 1, "queued": [], "dropped": 1.5}),
    spool({"v": 1, "queued": [], "flight": {"body": "{}", "count": 1}}), spool({"v": 1, "queued": [], "flight": []}),
    spool({"v": 1, "queued": [], "flight": {"body": '{"events":[1e2,null]}', "count": 2.0}}),
    spool({"v": 1, "queued": [], "flight": {"body": '{"events":[]}', "count": 0}}),
    spool({"v": 1, "queued": [], "flight": {"body": {"events": [1]}, "count": 1}}),
    '{"data":"old","sha256":"x",' + spool({"v": 1, "queued": [ITEM]})[1:], " \n" + spool({"v": 1, "queued": [ITEM]}) + "\n ",
]


def test_pieces_are_judged_and_replayed_like_whole_files(spark, tmp_path):
    for k, text in enumerate(CASES):
        (tmp_path / f"{k:02d}.json").write_text(text)
    spools.register(spark)

    def read(whole):
        files = spark.read.format("spool").option("wholeBytes", whole).load(str(tmp_path)).withColumnRenamed("reason", "found")
        rows = snapshots.snapshot_rows(files).select(F.regexp_extract("path", "([0-9]+).json", 1).alias("k"), "reason",
                                                     "position", "part", "payload", "event_bytes", "recovered", "content")
        return sorted(rows.collect(), key=str)

    at_once = read(1 << 30)
    assert read(-1) == at_once
    assert len([row for row in at_once if row.k == "00"]) == 32 and {row.reason for row in at_once} >= {
        None, "unreadable", "checksum", "not_json", "version", "queue", "item", "dropped", "flight"}


@pytest.mark.parametrize("block,piece", [(1, 1), (7, 40), (64, 300), (1 << 20, 1 << 20)])
def test_cuts_change_no_verdict_and_no_piece(block, piece):
    for text in CASES:
        whole = pieces.judged(blocks(text, 1 << 20))
        cut = pieces.judged(blocks(text, block), piece)
        assert (cut.reason, cut.flight, sum(n for *_, n in cut.queued)) == (
            whole.reason, whole.flight, sum(n for *_, n in whole.queued))
        if cut.reason is None:
            read = [(first, json.loads(json.loads(own)["data"])) for first, own in pieces.pieces(lambda: blocks(text, block), cut)]
            queued = [item for _, own in read for item in own["queued"]]
            data = json.JSONDecoder().raw_decode(json.loads(text)["data"].lstrip())[0]
            assert json.dumps(queued) == json.dumps(data["queued"] or [])
            at = 2 if data.get("flight") else 0
            assert [first for first, _ in read[1:]] == [at + sum(len(own["queued"]) for _, own in read[:k + 1]) for k in range(len(read) - 1)]


def test_escapes_are_cut_nowhere():
    rng = random.Random(3)
    for _ in range(200):
        text = "".join(rng.choice(["\\", '"', "\n", "u", "\ud83d", "\ude00", "\U0001f600", "d83d", "é", "x", "{}"]) for _ in range(40))
        for ascii_only in (True, False):
            if not ascii_only:
                text = text.encode("utf-16", "surrogatepass").decode("utf-16", "replace")
            found = pieces.judged(blocks(spool(json.dumps({"v": 1, "queued": [], "x": text}, ensure_ascii=ascii_only), ascii_only=ascii_only), rng.randint(1, 9)))
            assert found.reason is None


def test_spools_beyond_the_writers_limit_are_replayed(spark, tmp_path):
    # The logger writes none of more than 64 MiB; one that is there, joined or of another writer, is replayed all the same.
    item = '{"payload":{"id":%d,"text":"' + "x" * 40_000 + '"},"bytes":40040}'
    (tmp_path / "spool.json").write_text(spool('{"v":1,"queued":[' + ",".join(item % k for k in range(1750)) + "]}"))
    assert (tmp_path / "spool.json").stat().st_size > fixed.MAX_SPOOL_BYTES
    events, bad = snapshots.read_snapshots(spark, str(tmp_path / "*.json"))
    assert [row.reason for row in bad.collect()] == []
    rows = events.select("position", "event_bytes", F.get_json_object("payload", "$.id").alias("id")).collect()
    assert sorted(tuple(row) for row in rows) == [(k, 40_040, str(k)) for k in range(1750)]
