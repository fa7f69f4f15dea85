"""Delivery queries: deduplication, batches, backlog and the accounting of attempts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch.catalog.base import ATTEMPTS, EVENTS, Query, duck, frame, over, sql_stamp, stamp
from tidewatch.operators import delivery

REPLAYED = f"""
SELECT server_id, arrival_seq, received_at, 'e' || CAST(arrival_seq AS STRING) AS event_id FROM ({EVENTS}) AS raw
UNION ALL
SELECT server_id, arrival_seq + 1000000000, received_at + INTERVAL 5 SECOND, 'e' || CAST(arrival_seq AS STRING)
FROM ({EVENTS}) AS again WHERE arrival_seq % 3 = 0
"""

# Every fourth event lost its id.
NAMELESS = f"""
SELECT server_id, arrival_seq, received_at, CASE WHEN CAST(substring(event_id, 2) AS BIGINT) % 4 <> 0 THEN event_id END AS event_id
FROM ({REPLAYED}) AS replayed
"""

QUEUE = """
SELECT CAST(doc_id % 4 AS STRING) AS server_id, 'b' || CAST(doc_id % 2 AS STRING) AS boot_id, doc_id AS arrival_seq,
       CAST(octet_length(encode(text, 'utf-8')) + 1 AS BIGINT) AS event_bytes, CAST(doc_id AS STRING) AS payload,
       doc_id % 3 AS lost
FROM $documents
"""
QUEUE_SQL = QUEUE.replace("octet_length(encode(text, 'utf-8'))", "strlen(text)")

SMALL = """
SELECT CAST(o_custkey % 7 AS STRING) AS server_id, CAST(o_custkey % 2 AS STRING) AS boot_id, o_orderkey AS arrival_seq,
       CAST(floor(o_totalprice) AS BIGINT) % 900 + 60 AS event_bytes, CAST(o_orderkey AS STRING) AS payload, 0 AS lost
FROM $orders
"""

BATCHES = """
SELECT CAST(o_custkey % 7 AS STRING) AS server_id, CAST(o_custkey % 14 AS STRING) AS boot_id,
       CAST(floor(o_orderkey / 40) AS BIGINT) + 1 AS seq, o_orderkey % 5 AS dropped_since_last
FROM $orders
"""


def packed_sql(raw: str, max_events: int, room: int) -> str:
    return f"""
WITH RECURSIVE e AS (SELECT *, row_number() OVER (PARTITION BY server_id, boot_id ORDER BY arrival_seq) AS rn FROM ({raw}) AS raw),
walk AS (
  SELECT server_id, boot_id, rn, arrival_seq, event_bytes, lost, 1 AS seq, 1 AS n, event_bytes AS filled FROM e WHERE rn = 1
  UNION ALL
  SELECT e.server_id, e.boot_id, e.rn, e.arrival_seq, e.event_bytes, e.lost,
         CASE WHEN w.n >= {max_events} OR w.filled + e.event_bytes > {room} THEN w.seq + 1 ELSE w.seq END,
         CASE WHEN w.n >= {max_events} OR w.filled + e.event_bytes > {room} THEN 1 ELSE w.n + 1 END,
         CASE WHEN w.n >= {max_events} OR w.filled + e.event_bytes > {room} THEN e.event_bytes ELSE w.filled + e.event_bytes END
  FROM walk w JOIN e ON e.server_id = w.server_id AND e.boot_id = w.boot_id AND e.rn = w.rn + 1)
SELECT server_id, boot_id, seq, count(*) AS event_count, CAST(sum(event_bytes) AS BIGINT) AS payload_bytes,
       CAST(sum(lost) AS BIGINT) AS dropped_since_last, string_agg(arrival_seq, ',' ORDER BY rn) AS events
FROM walk GROUP BY server_id, boot_id, seq
"""


def _packed(df, **limits):
    packed = delivery.pack_batches(df, order=["arrival_seq"], dropped="lost", **limits)
    return packed.drop("v").withColumn("events", F.array_join("events", ","))


def _trimmed(df):
    return delivery.trim_backlog(df, 150, 400_000, order=["arrival_seq"])


_OUTCOME = f"""
WITH a AS (SELECT *, (response_at IS NULL OR epoch_us(response_at) - epoch_us(sent_at) >= 15000000) AS late,
  (attempt_seq % 11 <> 0 AND attempt_seq % 13 <> 0 AND attempt_seq % 17 <> 0) AS valid FROM ({ATTEMPTS}) AS raw),
b AS (SELECT *, CASE WHEN late THEN 'retry' WHEN status IN (200, 202) AND valid THEN 'ack'
    WHEN status IN (400, 413, 415, 422) THEN 'discard' ELSE 'retry' END AS outcome,
  CASE WHEN late THEN 'HTTP timeout' WHEN status IN (200, 202) AND valid THEN NULL WHEN status IN (200, 202)
    THEN 'HTTP invalid_receipt' WHEN status IN (400, 413, 415, 422) THEN 'HTTP ' || status || ' rejected the batch'
    ELSE 'HTTP ' || status END AS error FROM a),
c AS (SELECT *, count(*) FILTER (outcome = 'ack') OVER (PARTITION BY server_id ORDER BY sent_at, attempt_seq
    ROWS UNBOUNDED PRECEDING) AS acks FROM b),
d AS (SELECT *, CAST(sum(CASE WHEN outcome = 'retry' THEN 1 ELSE 0 END) OVER (PARTITION BY server_id, acks
    ORDER BY sent_at, attempt_seq ROWS UNBOUNDED PRECEDING) AS BIGINT) AS failures FROM c),
s AS (SELECT *, CASE WHEN outcome = 'retry' THEN CASE WHEN status IN (401, 403) AND NOT late THEN 60000 ELSE
    least(60000, 1000 * CAST(pow(2, least(failures - 1, 20)) AS BIGINT)) END END AS delay_ms FROM d)
"""


def _streaks(df, hot_rows=delivery.HOT_ROWS):
    return delivery.failure_streaks(delivery.classify_attempts(df), hot_rows=hot_rows)


def entries() -> dict[str, Query]:
    streaks = duck(f"{_OUTCOME} SELECT attempt_seq, outcome, failures, delay_ms, CASE WHEN delay_ms IS NOT NULL "
                   "THEN greatest(1, CAST(floor(delay_ms * 0.25) AS BIGINT)) END AS max_jitter_ms FROM s")
    shown = lambda df: df.select("attempt_seq", "outcome", "failures", "delay_ms", "max_jitter_ms")
    return {
        "dedup_events": Query(
            over(REPLAYED, lambda df: delivery.dedup_events(df).select("server_id", "event_id", "arrival_seq")),
            duck(f"SELECT server_id, event_id, min(arrival_seq) AS arrival_seq FROM ({REPLAYED}) AS raw GROUP BY 1, 2"),
        ),
        "dedup_null_ids": Query(
            over(NAMELESS, lambda df: delivery.dedup_events(df).select("server_id", "event_id", "arrival_seq")),
            duck(f"SELECT server_id, event_id, min(arrival_seq) AS arrival_seq FROM ({NAMELESS}) AS raw WHERE event_id IS NOT NULL "
                 f"GROUP BY 1, 2 UNION ALL SELECT server_id, event_id, arrival_seq FROM ({NAMELESS}) AS raw WHERE event_id IS NULL"),
        ),
        "pack_batches": Query(over(QUEUE, _packed), duck(packed_sql(QUEUE_SQL, 200, 900000 - 2048))),
        "pack_batches_split": Query(
            over(SMALL, lambda df: _packed(df, max_events=30, max_body=2048 + 9000, hot_rows=500)),
            duck(packed_sql(SMALL, 30, 9000)),
        ),
        "pack_batches_null_boot": Query(
            over(SMALL.replace("CAST(o_custkey % 2 AS STRING)", "nullif(CAST(o_custkey % 2 AS STRING), '0')"),
                 lambda df: _packed(df, max_events=30, max_body=2048 + 9000, hot_rows=500)),
            duck(packed_sql(SMALL, 30, 9000).replace("SELECT server_id, boot_id, seq,", "SELECT server_id, nullif(boot_id, '0') AS boot_id, seq,")),
        ),
        "trim_backlog": Query(
            over(QUEUE, lambda df: _trimmed(df).select("server_id", "arrival_seq")),
            duck(f"""SELECT server_id, arrival_seq FROM (SELECT *, sum(event_bytes) OVER w AS total, count(*) OVER w AS n
                 FROM ({QUEUE_SQL}) AS raw WINDOW w AS (PARTITION BY server_id ORDER BY arrival_seq DESC
                 ROWS UNBOUNDED PRECEDING)) WHERE n <= 150 AND total <= 400000"""),
        ),
        "trim_backlog_dropped": Query(
            over(QUEUE, lambda df: delivery.backlog_dropped(df, _trimmed(df))),
            duck(f"""SELECT server_id, count(*) AS offered, count(*) FILTER (n <= 150 AND total <= 400000) AS kept,
                 count(*) FILTER (n > 150 OR total > 400000) AS dropped FROM (SELECT *, sum(event_bytes) OVER w AS total,
                 count(*) OVER w AS n FROM ({QUEUE_SQL}) AS raw WINDOW w AS (PARTITION BY server_id
                 ORDER BY arrival_seq DESC ROWS UNBOUNDED PRECEDING)) GROUP BY server_id"""),
        ),
        "classify_attempts": Query(
            over(ATTEMPTS, lambda df: delivery.classify_attempts(df).select("attempt_seq", "outcome", "error")),
            duck(f"{_OUTCOME} SELECT attempt_seq, outcome, error FROM b"),
        ),
        "validate_receipts": Query(
            over(ATTEMPTS, lambda df: delivery.validate_receipts(df).select("attempt_seq", "receipt_valid")),
            duck(f"{_OUTCOME} SELECT attempt_seq, valid AS receipt_valid FROM a"),
        ),
        "failure_streaks": Query(over(ATTEMPTS, lambda df: shown(_streaks(df))), streaks),
        "failure_streaks_split": Query(over(ATTEMPTS, lambda df: shown(_streaks(df, hot_rows=1000))), streaks),
        "delivery_status": Query(
            over(ATTEMPTS, lambda df: delivery.delivery_status(_streaks(df))),
            duck(f"""{_OUTCOME} SELECT server_id,
              CAST(sum(CASE WHEN outcome = 'ack' THEN CAST(accepted AS BIGINT) + CAST(duplicates AS BIGINT) ELSE 0 END) AS BIGINT) AS sent,
              CAST(sum(CASE WHEN outcome = 'ack' THEN CAST(rejected AS BIGINT) WHEN outcome = 'discard' THEN event_count ELSE 0 END) AS BIGINT) AS dropped,
              count(*) FILTER (outcome = 'retry') AS failed,
              CASE WHEN arg_max(outcome, (sent_at, attempt_seq)) = 'retry' THEN arg_max(event_count, (sent_at, attempt_seq)) ELSE 0 END AS in_flight,
              arg_max(failures, (sent_at, attempt_seq)) AS failures,
              strftime(arg_max(response_at, (sent_at, attempt_seq)) FILTER (outcome = 'ack'), '%Y-%m-%dT%H:%M:%SZ') AS last_success_at,
              arg_max_null(error, (sent_at, attempt_seq)) AS last_error FROM s GROUP BY server_id"""),
        ),
        "loss_accounting": Query(
            over(BATCHES, lambda df: delivery.loss_accounting(df)),
            duck(f"""SELECT server_id, boot_id, count(*) AS batches, CAST(sum(d) AS BIGINT) AS dropped_reported,
                 max(seq) - count(*) AS missing_batches FROM (SELECT server_id, boot_id, seq, max(dropped_since_last) AS d
                 FROM ({BATCHES}) AS raw GROUP BY 1, 2, 3) GROUP BY 1, 2"""),
        ),
    }
