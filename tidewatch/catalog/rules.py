"""Source, validation and filter queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch.catalog.base import EVENTS, MOVES, Query, duck, frame, over, shared_folder, spread, sql_weapon
from tidewatch.catalog.collectors import (
    _IGNORED,
    CREATIONS,
    DOOR_STATES,
    MENU,
    MONEY,
    OPENS,
    SWITCHES,
    TX,
    USES,
    all_frames,
)
from tidewatch.functions import json_map
from tidewatch.operators import exports, validate
from tidewatch.sources import raw, sinks, snapshots
from tidewatch.sources.schemas import CORRUPT

RECORDS = """
SELECT o_orderkey AS arrival_seq, CASE o_orderkey % 16
  WHEN 0 THEN '"text"' WHEN 1 THEN '{"category":"money","action":"paid","context":"bad"}'
  WHEN 2 THEN '{"category":"money","action":"paid","data":42}' WHEN 3 THEN '{"category":"money","action":"paid","fields":false}'
  WHEN 4 THEN '{"category":"money"}' WHEN 5 THEN '{"category":"money","action":"!!!"}'
  WHEN 6 THEN '{"channel":"","action":"paid"}' WHEN 7 THEN '{"category":"money","channel":false,"action":"paid"}'
  WHEN 8 THEN '{"category":7,"action":"paid"}' WHEN 9 THEN '{"action":"orphan"}'
  WHEN 10 THEN '{"category":"' || lower(o_orderpriority) || '","action":"paid"}'
  WHEN 11 THEN '{"category":"anything","channel":"shop","action":"paid"}'
  WHEN 12 THEN '{"category":"money","action":7}' WHEN 13 THEN '{"channel":"shop.x","action":"Sold It","data":[1,2]}'
  WHEN 14 THEN '{"category":"staff","action":"x","context":{},"data":{},"fields":[]}'
  ELSE '{"category":"system","action":"started","extra":' || CAST(o_custkey AS STRING) || '}' END AS payload
FROM $orders
"""
REASONS = {0: "not_a_table", 1: "bad_context", 2: "bad_data", 3: "bad_fields", 4: "missing_action",
           5: "missing_action", 6: "bad_channel", 7: "bad_channel", 8: "bad_category", 9: "no_destination",
           10: "unknown_category", 12: "missing_action"}
_REASON_SQL = "CASE arrival_seq % 16 " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in REASONS.items()) + " END"

LINES = f"""
SELECT arrival_seq % 50 AS spoilt, '{{"server_id":"' || server_id || '","arrival_seq":' || CAST(arrival_seq AS STRING)
       || ',"event":"add","player_id":' || CAST(source AS STRING) || ',"account":"bank","amount":' || CAST(amount AS STRING)
       || ',"reason":"' || action || CASE WHEN arrival_seq % 50 = 0 THEN '' ELSE '"}}' END AS value,
       server_id, arrival_seq, source, amount, action
FROM ({EVENTS}) AS raw
"""

OVERSIZE = "SELECT CAST(doc_id % 4 AS STRING) AS server_id, doc_id AS arrival_seq, text AS encoded FROM $documents"


# One spool per server, of 45: those of five servers hold all their orders as queued events, some behind a flight
# of two, the others are broken in one of eight ways.
SPOOL_KINDS = 9
SPOOLS = """
SELECT server, CASE server % 9
  WHEN 0 THEN '{"v":1,"queued":[' || items || '],"flight":{"body":"{\\\\"events\\\\":[{\\\\"id\\\\":1},{\\\\"id\\\\":2}]}","count":2},"dropped":3}'
  WHEN 1 THEN '{"v":1,"queued":[' || items || ']}'
  WHEN 2 THEN '{"v":1,"queued":[{"payload":{},"bytes":"bad"}]}' WHEN 3 THEN '{"v":1,"queued":[],"dropped":-1}'
  WHEN 4 THEN '{"v":2,"queued":[]}' WHEN 5 THEN '{"v":1,"queued":7}' WHEN 6 THEN 'not json'
  WHEN 7 THEN '{"v":1,"queued":[],"flight":{"body":"{}","count":1}}' ELSE '{"v":1,"queued":[]}' END AS data
FROM (SELECT o_orderkey % 45 AS server, array_join(transform(array_sort(collect_list(struct(o_orderkey, o_custkey))),
        o -> '{"payload":{"id":' || o.o_custkey || '},"bytes":20}'), ',') AS items FROM $orders GROUP BY 1)
"""
SPOOL_REASONS = {2: "item", 3: "dropped", 4: "version", 5: "queue", 6: "not_json", 7: "flight", 8: "checksum"}


def _spools(spark, sf):
    """Spools written as files, one a server, and read back by the format of their own."""
    rows = frame(spark, sf, SPOOLS)
    tampered = F.col("server") % SPOOL_KINDS == 8
    digest = F.sha2(F.when(tampered, F.concat(F.col("data"), F.lit(" "))).otherwise(F.col("data")), 256)
    place = shared_folder(spark, "spools")
    files = rows.select("server", F.to_json(F.struct("data", digest.alias("sha256"))).alias("value"))
    files.repartition("server").write.partitionBy("server").text(place)
    server = F.regexp_extract("path", "server=([0-9]+)", 1).cast("bigint").alias("server")
    events, bad = snapshots.read_snapshots(spark, f"{place}/server=*/*.txt")
    good = events.select(server, F.lit(None).cast("string").alias("reason"), "position", "part", "payload", "event_bytes")
    nothing = {"position": "int", "part": "string", "payload": "string", "event_bytes": "bigint"}
    return good.unionByName(bad.select(server, "reason", *[F.lit(None).cast(t).alias(n) for n, t in nothing.items()]))


def _spools_sql() -> str:
    reasons = " ".join(f"WHEN {kind} THEN '{reason}'" for kind, reason in SPOOL_REASONS.items())
    flight = "(SELECT DISTINCT o_orderkey % 45 AS server FROM orders WHERE o_orderkey % 45 % 9 = 0)"
    return f"""
SELECT server, NULL AS reason, id - 1 AS position, 'flight' AS part, '{{"id":' || id || '}}' AS payload, NULL AS event_bytes
FROM {flight} AS f, (SELECT unnest([1, 2]) AS id)
UNION ALL
SELECT o_orderkey % 45, NULL, row_number() OVER (PARTITION BY o_orderkey % 45 ORDER BY o_orderkey) - 1
       + CASE WHEN o_orderkey % 45 % 9 = 0 THEN 2 ELSE 0 END, 'queued', '{{"id":' || o_custkey || '}}', 20
FROM orders WHERE o_orderkey % 45 % 9 IN (0, 1)
UNION ALL
SELECT DISTINCT o_orderkey % 45, CASE o_orderkey % 45 % 9 {reasons} END, NULL, NULL, NULL, NULL FROM orders WHERE o_orderkey % 45 % 9 > 1
"""


def raw_files(spark, sf):
    """Records as lines of files, every fiftieth broken off."""
    place = shared_folder(spark, "raw")
    spread(frame(spark, sf, LINES)).select("value").write.text(place)
    return place


def read_back(records):
    """Whole records by their columns, broken ones by their line."""
    return records.select(
        "server_id", "arrival_seq", "event", "player_id", "account",
        F.col("amount").cast("decimal(18,2)").alias("amount"), "reason", F.col(CORRUPT).alias("line"))


READ_BACK_SQL = duck(
    "SELECT CASE WHEN spoilt <> 0 THEN server_id END AS server_id, CASE WHEN spoilt <> 0 THEN arrival_seq END AS arrival_seq, "
    "CASE WHEN spoilt <> 0 THEN 'add' END AS event, CASE WHEN spoilt <> 0 THEN source END AS player_id, "
    "CASE WHEN spoilt <> 0 THEN 'bank' END AS account, CASE WHEN spoilt <> 0 THEN amount END AS amount, "
    f"CASE WHEN spoilt <> 0 THEN action END AS reason, CASE WHEN spoilt = 0 THEN value END AS line FROM ({LINES}) AS raw")


def _quarantined(spark, sf):
    """Records written by acceptance and read back from their folders."""
    place = shared_folder(spark, "quarantine")
    sinks.write_quarantine(validate.validate_event(spread(frame(spark, sf, RECORDS))), place)
    kept = sinks.accepted(spark, place).withColumn("reason", F.lit("accepted"))
    rows = kept.unionByName(sinks.refused(spark, place))
    return rows.groupBy("reason").agg(F.count(F.lit(1)).alias("records"), F.min("arrival_seq").alias("first_seq"))


def _seqs(df):
    return df.select("arrival_seq")


def _kept(raw_view: str, where: str) -> str:
    return duck(f"SELECT arrival_seq FROM ({raw_view}) AS raw WHERE {where}")


def _only_money(spark, sf):
    """Every collector is offered; the switches leave those of money."""
    frames = all_frames(spark, sf)
    off = {name: False for name in frames if name not in ("money", "balances")}
    return exports.all_collectors(frames, {**SWITCHES, **off}).groupBy("kind").agg(F.count(F.lit(1)).alias("events"))


def entries() -> dict[str, Query]:
    plain_from, plain_to = "trim(from_inventory, '\"')", "trim(to_inventory, '\"')"
    with_name = USES.replace("SELECT server_id,", "SELECT CASE part_key % 6 WHEN 0 THEN 'lockpick' WHEN 1 THEN 'bandage' "
                             "WHEN 2 THEN 'water' ELSE item END AS item_name, server_id,", 1)
    return {
        "src_raw_events": Query(
            lambda spark, sf: read_back(raw.read_raw(spark, raw_files(spark, sf), "account_money")), READ_BACK_SQL),
        "src_snapshot_recovery": Query(_spools, _spools_sql()),
        "sink_quarantine": Query(
            _quarantined,
            duck(f"SELECT coalesce({_REASON_SQL}, 'accepted') AS reason, count(*) AS records, "
                 f"min(arrival_seq) AS first_seq FROM ({RECORDS}) AS raw GROUP BY 1"),
        ),
        "validate_event": Query(
            over(RECORDS, lambda df: validate.validate_event(df).select("arrival_seq", "reason")),
            duck(f"SELECT arrival_seq, {_REASON_SQL} AS reason FROM ({RECORDS}) AS raw"),
        ),
        "trusted_source": Query(
            over(TX, lambda df: _seqs(validate.trusted_source(df, json_map(F.col("payload")).isNotNull()))),
            _kept(TX, "invoking_resource = 'monitor' AND arrival_seq % 23 <> 0"),
        ),
        "drop_slot_shuffles": Query(
            over(MOVES, lambda df: _seqs(validate.drop_slot_shuffles(df))),
            _kept(MOVES, f"{plain_from} IS NULL OR {plain_to} IS NULL OR {plain_from} <> {plain_to}"),
        ),
        "drop_ignored_creators": Query(
            over(CREATIONS, lambda df: _seqs(validate.drop_ignored_creators(df, ["SYNC_drugscreator", "shop_1"]))),
            _kept(CREATIONS, f"{sql_weapon('item_name')} OR coalesce(lower(resource), '') NOT IN "
                             "('sync_drugscreator', 'shop_1')"),
        ),
        "drop_account_echo": Query(
            over(CREATIONS, lambda df: _seqs(validate.drop_account_echo(df))),
            _kept(CREATIONS, "NOT (item_name = 'money' AND coalesce(resource, '') = 'es_extended')"),
        ),
        "use_watchlist": Query(
            over(with_name, lambda df: _seqs(validate.use_watchlist(df))),
            _kept(with_name, "item_name IN ('lockpick', 'armour', 'bandage', 'medikit')"),
        ),
        "drop_balance_resync": Query(
            over(MONEY, lambda df: _seqs(validate.drop_balance_resync(df))),
            _kept(MONEY, "reason IS DISTINCT FROM 'Sync account with item'"),
        ),
        "drop_autolocks": Query(
            over(DOOR_STATES, lambda df: _seqs(validate.drop_autolocks(df))),
            _kept(DOOR_STATES, "player_id IS NOT NULL"),
        ),
        "final_restart_only": Query(
            over(TX, lambda df: _seqs(validate.final_restart_only(
                df, F.get_json_object("payload", "$.secondsRemaining")))),
            _kept(TX, "arrival_seq % 23 = 0 OR o_custkey % 5 * 30 <= 60"),
        ),
        "committed_only": Query(
            over(MOVES, lambda df: _seqs(validate.committed_only(df))), _kept(MOVES, "success"),
        ),
        "drop_oversize": Query(
            over(OVERSIZE, lambda df: validate.drop_oversize(df).select(
                "arrival_seq", validate.event_bytes(F.col("encoded")).cast("bigint").alias("event_bytes"))),
            duck(f"SELECT arrival_seq, strlen(encoded) + 1 AS event_bytes FROM ({OVERSIZE}) AS raw "
                 "WHERE strlen(encoded) <= 32768"),
        ),
        "drop_oversize_report": Query(
            over(OVERSIZE, lambda df: validate.oversize_report(df, limit=2048)),
            duck("SELECT server_id, count(*) FILTER (strlen(encoded) > 2048) AS oversized, "
                 f"count(*) FILTER (encoded IS NULL) AS unencodable FROM ({OVERSIZE}) AS raw GROUP BY server_id"),
        ),
        "collector_switches": Query(
            _only_money,
            duck(f"SELECT 'money' AS kind, count(*) AS events FROM ({MONEY}) AS raw "
                 "WHERE event <> 'set' OR reason IS DISTINCT FROM 'Sync account with item'"),
        ),
        "drop_own_open": Query(
            over(OPENS, lambda df: _seqs(validate.drop_own_open(df))),
            _kept(OPENS, "NOT (inventory_type = 'player' AND inventory_id IS NULL)"),
        ),
        "drop_duplicate_announcement": Query(
            over(MENU, lambda df: _seqs(validate.drop_duplicate_announcement(df))),
            _kept(MENU, "action <> 'announcement'"),
        ),
    }
