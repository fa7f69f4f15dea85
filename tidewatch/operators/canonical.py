"""Drafts to canonical events, and canonical events to their JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.records import (
    bound_maps,
    canonical_json,
    event_id,
    fields_to_data,
    json_object,
    object_text,
)
from tidewatch.functions.text import let, normalise_action, normalise_severity, short_text, text_json, utc_text
from tidewatch.operators.identity import EXPLICIT_KEYS, PARTY, PARTY_TEXT, Reference, resolve_parties
from tidewatch.plans.ordered import HOT_ROWS

CANONICAL = ("server_id", "arrival_seq", "received_at", "event_id", "occurred_at", "channel",
             "category", "action", "severity", "actor", "target", "context", "data",
             "correlation_id", "transaction_id", "session_id", "entity_id")
SELF = "tidewatch"


def resolve_identities(drafts: DataFrame, sessions: DataFrame, characters: DataFrame,
                       inventories: DataFrame | None = None,
                       hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Drafts with `actor` and `target` parties as of their arrival."""
    leaving = F.coalesce(F.col("action") == "disconnect", F.lit(False))
    references = [Reference("actor_ref", "actor_lookup", "actor"),
                  Reference("target_ref", "target_lookup", "target", "target_net_id")]
    return resolve_parties(drafts, references, sessions, characters, inventories, closing=leaving, hot_rows=hot_rows)


def canonical_project(drafts: DataFrame, deep: bool = True) -> DataFrame:
    """Assemble the canonical event row. Without parties resolved, actor and target are NULL.

    `deep=False` promises that no context or data value is nested, and keeps Python out of it.
    """
    rows = bound_maps(
        drafts.withColumn("data", fields_to_data(F.col("fields"), F.col("data"))),
        ["context", "data"], deep=deep,
    )
    resource = short_text(F.coalesce("resource", F.lit(SELF)), 64)
    context = F.map_concat(
        F.coalesce(F.map_filter("context", lambda key, _: key != "resource"),
                   F.create_map().cast("map<string,string>")),
        json_object(resource=text_json(resource)),
    )
    given_at = F.try_to_timestamp(F.col("occurred_at"))

    def resolved(name: str) -> Column:
        return F.col(name) if name in drafts.columns else F.lit(None).cast(PARTY)

    return rows.select(
        "server_id", "arrival_seq", "received_at",
        event_id(F.col("event_id"), F.col("server_id"), F.col("arrival_seq"), F.col("kind")).alias("event_id"),
        F.coalesce(given_at, F.date_trunc("second", "received_at")).alias("occurred_at"),
        F.col("channel"), F.col("category"),
        normalise_action(F.col("action")).alias("action"),
        normalise_severity(F.col("severity")).alias("severity"),
        resolved("actor").alias("actor"), resolved("target").alias("target"),
        context.alias("context"),
        "data",
        *[short_text(F.col(name)).alias(name)
          for name in ("correlation_id", "transaction_id", "session_id", "entity_id")],
    )


def party_json(value: Column) -> Column:
    """The party as it would be sent; what an explicit identity had beside the known fields comes last."""
    members = {"source": value["source"].cast("string")}
    members.update({EXPLICIT_KEYS.get(n, n): text_json(value[n]) for n in PARTY_TEXT})

    def with_extra(known: Column) -> Column:
        joint = F.when(known == "{}", F.lit("")).otherwise(F.concat(F.substring(known, F.lit(1), F.length(known) - 1), F.lit(",")))
        inner = F.substring(value["extra"], F.lit(2), F.length(value["extra"]))
        return F.when(value["extra"].isNull(), known).otherwise(F.concat(F.when(known == "{}", F.lit("{")).otherwise(joint), inner))

    return F.when(value.isNotNull(), let(object_text(**members), with_extra))


def event_json(**columns: Column) -> Column:
    """The event as it would be sent: one JSON object, absent members left out."""
    at = {name: columns.get(name, F.col(name)) for name in CANONICAL}
    return object_text(
        eventId=text_json(at["event_id"]), occurredAt=text_json(utc_text(at["occurred_at"])),
        channel=text_json(at["channel"]), category=text_json(at["category"]),
        action=text_json(at["action"]), severity=text_json(at["severity"]),
        actor=party_json(at["actor"]), target=party_json(at["target"]),
        context=F.when(F.size(at["context"]) > 0, canonical_json(at["context"])),
        data=canonical_json(at["data"]),
        correlationId=text_json(at["correlation_id"]), transactionId=text_json(at["transaction_id"]),
        sessionId=text_json(at["session_id"]), entityId=text_json(at["entity_id"]),
    )
