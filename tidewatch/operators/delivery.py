"""Deduplication, batch packing, backlog trimming and the accounting of delivery logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch import fixed
from tidewatch.functions.text import lua_number, utc_text
from tidewatch.plans.chains import OPENS, START, mark_chain
from tidewatch.plans.keys import join_on
from tidewatch.plans.ordered import HOT_ROWS, SLICE, arrange


def dedup_events(df: DataFrame, keys: Sequence[str] = ("server_id", "event_id"),
                 order: Sequence[str] = ("received_at", "arrival_seq")) -> DataFrame:
    """One row per event id, the first to arrive; rows without an id are no copies and all stay.

    "row_number = 1" is cut within each task before the shuffle, so an id replayed a billion times
    sends one row per map task. Only the last of `keys`, the id, is looked at for NULL.
    """
    named = F.col(keys[-1]).isNotNull()
    placed = Window.partitionBy(*keys).orderBy(*order)
    first = df.filter(named).withColumn("_place", F.row_number().over(placed)).filter(F.col("_place") == 1).drop("_place")
    return first.unionByName(df.filter(~named))


def pack_batches(df: DataFrame, keys: Sequence[str] = ("server_id", "boot_id"),
                 order: Sequence[str] = ("received_at", "arrival_seq"), size: str = "event_bytes",
                 payload: str = "payload", max_events: int = fixed.BATCH_EVENTS,
                 max_body: int = fixed.BODY_BYTES, dropped: str | None = None,
                 hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Greedy batches in arrival order: as many events as fit, at least one.

    A batch is bounded by construction (events and bytes), so only batches are ever collected into
    one row. `dropped` counts losses before an event since the one before it. A NULL key is a key.
    """
    keys = list(keys)
    limit = min(max_events, fixed.MAX_BATCH_EVENTS)
    room = min(max_body, fixed.MAX_BODY_BYTES) - fixed.ENVELOPE_BYTES
    lost = F.col(dropped) if dropped else F.lit(0)
    columns = df.select(*keys, *order, F.col(size).cast("bigint").alias("_size"),
                        F.col(payload).alias("_payload"), lost.cast("bigint").alias("_lost"))
    # Rows equal in `order` are numbered alike however often this is computed.
    columns = columns.withColumn("_tie", F.xxhash64("_payload", "_size", "_lost"))
    order = [*order, "_tie"]
    rows = arrange(columns, keys, order, hot_rows)
    rows = rows.running_sum(F.lit(1).cast("bigint"), "_at").running_sum(F.col("_size"), "_filled")
    # The chain reads three numbers per row; payloads stay in the JVM.
    lean = rows.df.select(*keys, SLICE, *order, "_at", "_filled", "_size")
    chained = mark_chain(lean, keys, list(order), meter="_at", step=limit, filled="_filled",
                         size="_size", room=room, sliced=rows.sliced, hot_rows=hot_rows)
    starts = chained.filter(OPENS).select(*keys, F.col("_at").alias("_first"))
    numbered = arrange(starts, keys, ["_first"], hot_rows).running_sum(F.lit(1).cast("bigint"), "seq")
    placed = join_on(
        chained.select(*keys, "_at", F.col(START).alias("_first")),
        numbered.df.select(*keys, "_first", "seq"), [*keys, "_first"],
    )
    members = join_on(
        rows.df.select(*keys, "_at", "_size", "_payload", "_lost"),
        placed.select(*keys, "_at", "seq"), [*keys, "_at"],
    )
    return members.groupBy(*keys, "seq").agg(
        F.count(F.lit(1)).alias("event_count"),
        F.sum("_size").alias("payload_bytes"),
        F.sum("_lost").alias("dropped_since_last"),
        F.array_sort(F.collect_list(F.struct("_at", "_payload"))).alias("_events"),
    ).select(
        *keys, "seq", F.lit(fixed.SCHEMA_VERSION).alias("v"), "event_count", "payload_bytes",
        "dropped_since_last", F.col("_events._payload").alias("events"),
    )


def trim_backlog(df: DataFrame, max_events: int = fixed.QUEUE_EVENTS,
                 max_bytes: int = fixed.QUEUE_BYTES, size: str = "event_bytes",
                 order: Sequence[str] = ("received_at", "arrival_seq")) -> DataFrame:
    """The newest events per server that fit the backlog.

    The count cap goes first and is cut before the shuffle; the byte total then runs over at most
    `max_events` rows of a server.
    """
    newest = Window.partitionBy("server_id").orderBy(*[F.col(name).desc() for name in order])
    counted = df.withColumn("_place", F.row_number().over(newest)).filter(F.col("_place") <= max_events)
    upto = newest.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        counted.withColumn("_total", F.sum(size).over(upto))
        .filter(F.col("_total") <= max_bytes).drop("_place", "_total")
    )


def backlog_dropped(df: DataFrame, kept: DataFrame) -> DataFrame:
    """Per server, how many events trimming dropped."""
    offered = df.groupBy("server_id").agg(F.count(F.lit(1)).alias("offered"))
    left = kept.groupBy("server_id").agg(F.count(F.lit(1)).alias("kept"))
    return offered.join(left, "server_id", "left").select(
        "server_id", "offered", F.coalesce("kept", F.lit(0)).alias("kept"),
        (F.col("offered") - F.coalesce("kept", F.lit(0))).alias("dropped"),
    )


RECEIPT = ("accepted", "duplicates", "rejected")


def validate_receipts(df: DataFrame) -> DataFrame:
    """Add `receipt_valid`: three whole numbers from 0 to 2^53-1 that account for the batch."""
    numbered = df.withColumns({f"_{name}": lua_number(F.col(name)) for name in RECEIPT})
    parts = [F.col(f"_{name}") for name in RECEIPT]
    whole = parts[0] + parts[1] + parts[2] == F.col("event_count")
    for part in parts:
        whole = whole & (part >= 0) & (part <= fixed.MAX_EXACT_INTEGER) & (part == F.floor(part))
    return numbered.withColumn("receipt_valid", F.coalesce(whole, F.lit(False))).drop(
        *[f"_{name}" for name in RECEIPT])


def classify_attempts(df: DataFrame, timeout: float = fixed.TIMEOUT_SECONDS) -> DataFrame:
    """Add `receipt_valid`, `outcome` (ack, retry or discard) and `error` of each attempt.

    An answer at or after the timeout never counts, not even a good one.
    """
    late = F.col("response_at").isNull() | (
        F.unix_micros("response_at") - F.unix_micros("sent_at") >= round(timeout * 1_000_000)
    )
    status = F.coalesce(F.col("status").cast("int"), F.lit(0))
    good = status.isin(*fixed.ACCEPT_STATUSES)
    final = status.isin(*fixed.DISCARD_STATUSES)
    acked = good & F.col("receipt_valid")
    outcome = F.when(late, "retry").when(acked, "ack").when(final, "discard").otherwise("retry")
    error = (
        F.when(late, "HTTP timeout").when(acked, F.lit(None)).when(good, "HTTP invalid_receipt")
        .when(final, F.format_string("HTTP %d rejected the batch", status))
        .otherwise(F.format_string("HTTP %d", status))
    )
    return validate_receipts(df).withColumns({"outcome": outcome, "error": error})


def failure_streaks(attempts: DataFrame, keys: Sequence[str] = ("server_id",),
                    order: Sequence[str] = ("sent_at", "attempt_seq"),
                    hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Consecutive retries since the last ack, and the delay planned after each.

    A discard does not end the streak. The jitter is a range, never drawn here.
    """
    retry = (F.col("outcome") == "retry").cast("bigint")
    rows = arrange(attempts, keys, order, hot_rows).running_sum(retry, "_retries")
    acked = F.when(F.col("outcome") == "ack", F.col("_retries"))
    rows = rows.last_known(acked, "_before")
    failures = F.col("_retries") - F.coalesce("_before", F.lit(0))
    exponent = F.least(failures - 1, F.lit(20))
    growing = F.least(F.lit(fixed.RETRY_MAX_MS),
                      F.lit(fixed.RETRY_BASE_MS) * F.pow(F.lit(2), exponent)).cast("bigint")
    refused = F.col("status").isin(*fixed.AUTH_STATUSES) & (F.col("error") != "HTTP timeout")
    delay = F.when(F.coalesce(refused, F.lit(False)), F.lit(fixed.RETRY_MAX_MS)).otherwise(growing)
    return rows.df.withColumn("failures", failures).withColumn(
        "delay_ms", F.when(F.col("outcome") == "retry", delay)
    ).withColumn(
        "max_jitter_ms", F.greatest(F.lit(1), F.floor(F.col("delay_ms") * 0.25))
    ).withColumn(
        "max_jitter_ms", F.when(F.col("delay_ms").isNotNull(), F.col("max_jitter_ms"))
    ).drop(SLICE, "_retries", "_before")


def delivery_status(streaks: DataFrame, order: Sequence[str] = ("sent_at", "attempt_seq")) -> DataFrame:
    """Per server: what was sent, dropped and failed, and where delivery stands now."""
    place = F.struct(*order)
    ack, discard = F.col("outcome") == "ack", F.col("outcome") == "discard"
    count = F.col("event_count").cast("bigint")
    accepted, duplicates, rejected = (
        lua_number(F.col(name)).cast("bigint") for name in ("accepted", "duplicates", "rejected")
    )
    last = F.max_by(F.struct("outcome", "event_count", "failures", "error"), place)
    status = streaks.groupBy("server_id").agg(
        F.sum(F.when(ack, accepted + duplicates).otherwise(0)).alias("sent"),
        F.sum(F.when(ack, rejected).when(discard, count).otherwise(0)).alias("dropped"),
        F.count_if(F.col("outcome") == "retry").alias("failed"),
        F.max_by(F.when(ack, F.col("response_at")), F.when(ack, place)).alias("_success"),
        last.alias("_last"),
    )
    waiting = F.when(F.col("_last.outcome") == "retry", F.col("_last.event_count")).otherwise(0)
    return status.select(
        "server_id", "sent", "dropped", "failed", waiting.cast("bigint").alias("in_flight"),
        F.col("_last.failures").alias("failures"), utc_text(F.col("_success")).alias("last_success_at"),
        F.col("_last.error").alias("last_error"),
    )


def loss_accounting(batches: DataFrame, keys: Sequence[str] = ("server_id", "boot_id")) -> DataFrame:
    """Per boot: losses its batches reported, and sequence numbers never seen.

    Retries repeat a sequence number, so a batch counts once however often it was tried; numbers
    start at 1.
    """
    once = batches.groupBy(*keys, "seq").agg(F.max("dropped_since_last").alias("dropped"))
    return once.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("batches"),
        F.sum("dropped").alias("dropped_reported"),
        (F.max("seq") - F.count(F.lit(1))).alias("missing_batches"),
    )
