"""Shaping queries: folding, the ceiling, volume and conservation."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch.catalog.base import EVENTS, Query, duck, frame, shared_folder, spread, sql_stamp, stamp
from tidewatch.functions.records import canonical_json
from tidewatch.functions.text import lua_number
from tidewatch.operators import shaping
from tidewatch.operators.canonical import canonical_project
from tidewatch.operators.exports import log_to_events
from tidewatch.operators.identity import party

# The test tables hold a few events per player and day, so windows are days instead of seconds.
HOUR = 3600
GAP, HOLD = 48 * HOUR, 120 * HOUR
LIMIT, WINDOW = 3, 72 * HOUR
KEYS = ["server_id", "source", "action"]

RECORDS = f"""
SELECT server_id, arrival_seq, received_at, source, 'script_' || CAST(source % 5 AS STRING) AS invoking_resource,
       '{{"action":"' || action || '","category":"' || category || '"'
       || CASE WHEN channel IS NULL THEN '' ELSE ',"channel":"' || channel || '"' END
       || ',"context":{{"zone":"' || CAST(source % 7 AS STRING) || '"}},"data":{{"amount":' || CAST(amount AS STRING)
       || '}},"actor":' || CAST(source AS STRING) || '}}' AS payload
FROM ({EVENTS}) AS raw
"""


def folded_sql(gap: int = GAP, hold: int = HOLD, raw: str = EVENTS) -> str:
    """Reference walk: row by row along each key, carrying the last and the opening time."""
    us = 1_000_000
    return f"""
WITH RECURSIVE e AS (
  SELECT *, row_number() OVER (PARTITION BY server_id, source, action ORDER BY received_at, arrival_seq) AS rn
  FROM ({raw}) AS raw),
walk AS (
  SELECT server_id, source, action, rn, received_at AS opened, received_at AS last_at FROM e WHERE rn = 1
  UNION ALL
  SELECT e.server_id, e.source, e.action, e.rn,
         CASE WHEN epoch_us(e.received_at) - epoch_us(w.last_at) >= {gap * us}
                OR epoch_us(e.received_at) - epoch_us(w.opened) >= {hold * us} THEN e.received_at ELSE w.opened END,
         e.received_at
  FROM walk w JOIN e ON e.server_id = w.server_id AND e.source = w.source AND e.action = w.action AND e.rn = w.rn + 1),
placed AS (
  SELECT e.*, w.opened, row_number() OVER (PARTITION BY e.server_id, e.source, e.action, w.opened ORDER BY e.rn) AS place
  FROM e JOIN walk w ON e.server_id = w.server_id AND e.source = w.source AND e.action = w.action AND e.rn = w.rn),
folded AS (
  SELECT server_id, source, action, category, channel, arrival_seq, occurred_at, amount,
         CAST(NULL AS BIGINT) AS repeats, CAST(NULL AS TIMESTAMP) AS repeated_until, false AS is_rollup,
         received_at AS admit_at
  FROM placed WHERE place = 1
  UNION ALL
  SELECT server_id, source, action, any_value(category), any_value(channel), arg_min(arrival_seq, place),
         min(occurred_at) FILTER (place = 2), sum(amount) FILTER (place > 1), count(*) - 1, arg_max(occurred_at, place),
         true, least(max(received_at) + to_seconds({gap}), opened + to_seconds({hold}))
  FROM placed GROUP BY server_id, source, action, opened HAVING count(*) > 1),
numbered AS (
  SELECT *, row_number() OVER (
      PARTITION BY server_id, source, floor(epoch_us(admit_at) / {WINDOW * us})
      ORDER BY admit_at, is_rollup DESC, arrival_seq) AS nth FROM folded)
"""


_FOLD_OUT = f"""SELECT server_id, source, action, arrival_seq, {sql_stamp('occurred_at')} AS occurred_at,
 CAST(amount AS DECIMAL(18,2)) AS amount, repeats, {sql_stamp('repeated_until')} AS repeated_until, is_rollup,
 {sql_stamp('admit_at')} AS admit_at"""


def _shown(folded):
    return folded.select(
        "server_id", "source", "action", "arrival_seq", stamp(F.col("occurred_at")).alias("occurred_at"),
        F.col("amount").cast("decimal(18,2)").alias("amount"), "repeats",
        stamp(F.col("repeated_until")).alias("repeated_until"), "is_rollup",
        stamp(F.col("admit_at")).alias("admit_at"),
    )


# Every fourth player is unknown; the reference walk gives them a number no player has.
NAMELESS = f"""
SELECT server_id, arrival_seq, received_at, occurred_at, CASE WHEN source % 4 <> 0 THEN source END AS source, action,
       category, channel, amount, props
FROM ({EVENTS}) AS raw
"""
_NAMELESS_SQL = NAMELESS.replace("source END", "source ELSE -1 END")


def fold_nameless(spark, sf, hot_rows=shaping.HOT_ROWS):
    return shaping.coalesce_repeats(
        frame(spark, sf, NAMELESS), KEYS, 24 * HOUR, 36 * HOUR, ["amount"], hot_rows=hot_rows)


def fold(spark, sf, gap=GAP, hold=HOLD, hot_rows=shaping.HOT_ROWS):
    return shaping.coalesce_repeats(frame(spark, sf, EVENTS), KEYS, gap, hold, ["amount"], hot_rows=hot_rows)


def canonical_events(spark, sf):
    """Canonical events of the given events table, with the user as the acting player."""
    return canonical_of(spread(frame(spark, sf, RECORDS)))


def canonical_of(records):
    """Script records as canonical events, a table's or a stream's."""
    drafts = log_to_events(records)
    return canonical_project(drafts.withColumn("actor", party(source=F.col("actor_ref"))), deep=False)


def shaped(spark, sf):
    return shaping.shape_events(canonical_events(spark, sf), GAP, HOLD, LIMIT, WINDOW)


def _admitted(spark, sf):
    admitted, _ = shaped(spark, sf)
    return admitted.select(
        "server_id", F.col("actor.source").cast("bigint").alias("source"), "action", "arrival_seq",
        F.col("amount").cast("decimal(18,2)").alias("amount"), "repeats", "is_rollup",
        stamp(F.col("admit_at")).alias("admit_at"),
        lua_number(F.element_at("data", "amount")).cast("decimal(18,2)").alias("data_amount"),
        F.element_at("data", "repeats").cast("bigint").alias("data_repeats"),
    )


def _delivered(spark, sf):
    """Whole way from script records to what is delivered: admitted events, totals and reports."""
    return delivered_view(shaping.deliverable(*shaped(spark, sf), WINDOW))


def delivered_view(sent):
    report = F.col("category") == "security"
    return sent.select(
        "server_id", F.col("actor.source").cast("bigint").alias("source"), "category", "action", "severity",
        F.when(report, F.col("event_id")).alias("report_id"),
        F.when(report, stamp(F.col("received_at"))).alias("reported_at"),
        stamp(F.col("occurred_at")).alias("occurred_at"),
        F.when(report, canonical_json(F.col("context"))).alias("report_context"),
        F.when(report, canonical_json(F.col("data"))).alias("report_data"),
        F.when(~report, lua_number(F.element_at("data", "amount")).cast("decimal(18,2)")).alias("amount"),
        F.element_at("data", "repeats").cast("bigint").alias("repeats"),
    )


_WINDOW_US = WINDOW * 1_000_000
_OVER = f"""over_limit AS (
  SELECT server_id, source, CAST(floor(epoch_us(admit_at) / {_WINDOW_US}) AS BIGINT) * {_WINDOW_US} AS began,
         count(*) - {LIMIT} AS dropped FROM numbered GROUP BY ALL HAVING count(*) > {LIMIT})"""
_ENDED = sql_stamp(f"make_timestamp(began + {_WINDOW_US})")
def delivered_sql(until: str = "TIMESTAMP '9999-01-01'") -> str:
    """What shaping sends up to a moment: admitted events, totals, and reports of windows that have ended."""
    return f"""{folded_sql()}, {_OVER}
SELECT server_id, source, category, action, NULL AS severity, NULL AS report_id, NULL AS reported_at,
       {sql_stamp("date_trunc('second', occurred_at)")} AS occurred_at, NULL AS report_context, NULL AS report_data,
       CAST(amount AS DECIMAL(18,2)) AS amount, repeats
FROM numbered WHERE nth <= {LIMIT} AND admit_at <= {until}
UNION ALL
SELECT server_id, source, 'security', 'rate_limit_triggered', 'warning',
       left(sha256(server_id || '|' || source || '|' || began || '|rate_limit_triggered'), 32), {_ENDED}, {_ENDED},
       '{{"resource":"tidewatch"}}',
       '{{"dropped":' || dropped || ',"reason":"' || (dropped + {LIMIT})
       || ' events in a minute; logging kept {LIMIT} and dropped the rest"}}', NULL, NULL
FROM over_limit WHERE make_timestamp(began + {_WINDOW_US}) <= {until}"""


DELIVERED_SQL = delivered_sql()


def _volume(spark, sf):
    admitted, _ = shaped(spark, sf)
    return shaping.top_volume(admitted, 15, at="admit_at")


def _plain(spark, sf):
    return frame(spark, sf, EVENTS)


def _limited(spark, sf):
    kept = shaping.rate_limit(_plain(spark, sf), LIMIT, 24 * HOUR, source="source")
    return kept.select("server_id", "source", "arrival_seq")


# Every seventh event has no time, every fifth no number, every fourth player is unknown; `id` tells rows apart.
GAPPY = f"""
SELECT server_id, arrival_seq AS id, CASE WHEN arrival_seq % 5 <> 0 THEN arrival_seq END AS arrival_seq,
       CASE WHEN arrival_seq % 7 <> 0 THEN received_at END AS received_at, CASE WHEN source % 4 <> 0 THEN source END AS source,
       action
FROM ({EVENTS}) AS raw
"""


def _limited_gappy(spark, sf):
    kept = shaping.rate_limit(frame(spark, sf, GAPPY), LIMIT, 24 * HOUR, source="source")
    return kept.select("server_id", "source", "id", "arrival_seq", stamp(F.col("received_at")).alias("received_at"))


def _report_gappy(spark, sf):
    report = shaping.rate_limit_report(frame(spark, sf, GAPPY), LIMIT, 24 * HOUR, source="source", actor="action")
    return report.select("server_id", "source", stamp(F.col("window_start")).alias("window_start"), "dropped", "actor")


def _report(spark, sf):
    report = shaping.rate_limit_report(_plain(spark, sf), LIMIT, 24 * HOUR, source="source",
                                       actor="action")
    return report.withColumn("window_start", stamp(F.col("window_start")))


def _status(spark, sf):
    folded = shaping.fold_events(canonical_events(spark, sf), GAP, HOLD)
    return shaping.shaping_status(folded, shaping.rate_limit_report(folded, LIMIT, WINDOW))


def _conserved(spark, sf):
    before, after = _plain(spark, sf), fold(spark, sf)
    changed = shaping.conservation_check(before, after, KEYS, ["amount"])
    offered = after.agg(
        F.sum(F.when(F.col("is_rollup"), F.col("repeats")).otherwise(F.lit(1).cast("bigint"))).alias("events"),
        F.sum("amount").cast("decimal(18,2)").alias("amount"))
    return offered.crossJoin(changed.agg(F.count(F.lit(1)).alias("changed_keys")))


def _observed(spark, sf):
    """Totals counted on both sides of folding while its rows are written."""
    watch = shaping.Watch(["amount"])
    folded = shaping.coalesce_repeats(_plain(spark, sf), KEYS, GAP, HOLD, ["amount"], watch=watch)
    folded.write.parquet(shared_folder(spark, "folded"))
    rows = [(name, str(before), str(after)) for name, (before, after) in watch.check().items()]
    totals = spark.createDataFrame(rows, "metric string, before string, after string")
    return totals.withColumns({side: F.col(side).cast("decimal(18,2)") for side in ("before", "after")})


DAY_US = 86_400_000_000
_DAYS = f"""
WITH placed AS (
  SELECT *, floor(epoch_us(received_at) / {DAY_US}) AS bucket,
         row_number() OVER (PARTITION BY server_id, source, floor(epoch_us(received_at) / {DAY_US})
                            ORDER BY received_at, arrival_seq) AS nth
  FROM ({EVENTS}) AS raw)
"""


_DAYS_GAPPY = _DAYS.replace(EVENTS, GAPPY)


def entries() -> dict[str, Query]:
    nameless = duck(f"{folded_sql(24 * HOUR, 36 * HOUR, _NAMELESS_SQL)} "
                    f"{_FOLD_OUT.replace(' source,', ' nullif(source, -1) AS source,')} FROM folded")
    return {
        "coalesce_repeats": Query(
            lambda spark, sf: _shown(fold(spark, sf)), duck(f"{folded_sql()} {_FOLD_OUT} FROM folded")),
        "coalesce_repeats_split": Query(
            # Every key above 40 rows counts as hot, so this takes the way of the skewed keys.
            lambda spark, sf: _shown(fold(spark, sf, 24 * HOUR, 36 * HOUR, hot_rows=40)),
            duck(f"{folded_sql(24 * HOUR, 36 * HOUR)} {_FOLD_OUT} FROM folded")),
        "coalesce_repeats_null_keys": Query(lambda spark, sf: _shown(fold_nameless(spark, sf)), nameless),
        "coalesce_repeats_null_keys_split": Query(
            lambda spark, sf: _shown(fold_nameless(spark, sf, hot_rows=40)), nameless),
        "rate_limit": Query(
            _limited, duck(f"{_DAYS} SELECT server_id, source, arrival_seq FROM placed WHERE nth <= {LIMIT}")),
        "rate_limit_null_time": Query(
            _limited_gappy,
            duck(f"{_DAYS_GAPPY} SELECT server_id, source, id, arrival_seq, {sql_stamp('received_at')} AS received_at FROM placed "
                 f"WHERE nth <= {LIMIT} OR source IS NULL OR received_at IS NULL")),
        "rate_limit_report_null_time": Query(
            _report_gappy,
            duck(f"{_DAYS_GAPPY} SELECT server_id, source, strftime(make_timestamp(CAST(bucket * {DAY_US} AS BIGINT)), "
                 f"'%Y-%m-%d %H:%M:%S.%f') AS window_start, count(*) - {LIMIT} AS dropped, "
                 f"arg_min(action, nth) FILTER (nth > {LIMIT}) AS actor FROM placed WHERE source IS NOT NULL AND bucket IS NOT NULL "
                 f"GROUP BY server_id, source, bucket HAVING count(*) > {LIMIT}")),
        "rate_limit_report": Query(
            _report,
            duck(f"{_DAYS} SELECT server_id, source, strftime(make_timestamp(CAST(bucket * {DAY_US} AS BIGINT)), "
                 "'%Y-%m-%d %H:%M:%S.%f') AS window_start, 'security' AS category, 'rate_limit_triggered' AS action, "
                 f"'warning' AS severity, arg_min(action, nth) FILTER (nth > {LIMIT}) AS actor, "
                 f"count(*) - {LIMIT} AS dropped, count(*) || ' events in a minute; logging kept {LIMIT} and dropped the rest' "
                 f"AS reason FROM placed GROUP BY server_id, source, bucket HAVING count(*) > {LIMIT}")),
        "top_volume": Query(
            _volume,
            duck(f"""{folded_sql()}, admitted AS (SELECT * FROM numbered WHERE nth <= {LIMIT}),
                 span AS (SELECT greatest(1, CAST(epoch(date_trunc('second', max(admit_at))) AS BIGINT)
                          - CAST(epoch(date_trunc('second', min(admit_at))) AS BIGINT)) AS seconds FROM admitted),
                 counted AS (SELECT coalesce(channel, category, '?') || ' ' || action AS label, count(*) AS events
                             FROM admitted GROUP BY 1)
                 SELECT label, events, seconds, round(events * 60 / seconds, 6) AS per_minute
                 FROM counted, span ORDER BY events DESC, label LIMIT 15""")),
        "shaping_status": Query(
            _status,
            duck(f"{folded_sql()} SELECT (SELECT CAST(sum(repeats) AS BIGINT) FROM folded) AS folded, "
                 f"(SELECT count(*) FROM numbered WHERE nth > {LIMIT}) AS limited")),
        "conservation_check": Query(
            _conserved,
            duck("SELECT count(*) AS events, CAST(sum(amount) AS DECIMAL(18,2)) AS amount, 0 AS changed_keys "
                 f"FROM ({EVENTS}) AS raw")),
        "conservation_observed": Query(
            _observed,
            duck(f"SELECT metric, CAST(total AS DECIMAL(18,2)) AS before, CAST(total AS DECIMAL(18,2)) AS after FROM ("
                 f"SELECT 'events' AS metric, CAST(count(*) AS DOUBLE) AS total FROM ({EVENTS}) AS a "
                 f"UNION ALL SELECT 'amount', CAST(sum(amount) AS DOUBLE) FROM ({EVENTS}) AS b)")),
        "shape_and_deliver": Query(_delivered, duck(DELIVERED_SQL)),
        "shape_events": Query(
            _admitted,
            duck(f"{folded_sql()} SELECT server_id, source, action, arrival_seq, CAST(amount AS DECIMAL(18,2)) AS amount, "
                 f"repeats, is_rollup, {sql_stamp('admit_at')} AS admit_at, CAST(amount AS DECIMAL(18,2)) AS data_amount, "
                 f"repeats AS data_repeats FROM numbered WHERE nth <= {LIMIT}")),
    }
