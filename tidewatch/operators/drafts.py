"""Drafts: what a collector hands over, before identities are looked up and limits applied."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.records import FIELDS, TEXT_MAP

# `*_ref` is JSON (number, text or object). `*_lookup` says how a number or text is read: as a
# 'party' of a script, or as a 'player' inventory with its owner behind it. `target_net_id` names
# the target instead of `target_ref` while that player is connected.
DRAFT = {
    "server_id": "string", "arrival_seq": "bigint", "received_at": "timestamp", "kind": "string",
    "channel": "string", "category": "string", "action": "string", "severity": "string",
    "resource": "string", "actor_ref": "string", "actor_lookup": "string", "target_ref": "string",
    "target_lookup": "string", "target_net_id": "string", "event_id": "string",
    "occurred_at": "string", "context": TEXT_MAP, "data": TEXT_MAP, "fields": FIELDS,
    "correlation_id": "string", "transaction_id": "string", "session_id": "string",
    "entity_id": "string",
}


def draft(rows: DataFrame, kind: str, **columns: Column) -> DataFrame:
    """Project raw rows to draft columns; whatever is not given is NULL."""
    given = {
        "server_id": F.col("server_id"), "arrival_seq": F.col("arrival_seq"),
        "received_at": F.col("received_at"), "kind": F.lit(kind),
        "actor_lookup": F.lit("party"), "target_lookup": F.lit("party"),
    }
    given.update(columns)
    return rows.select(*[
        given.get(name, F.lit(None)).cast(kind_of).alias(name) for name, kind_of in DRAFT.items()
    ])


def transaction_id(kind: str) -> Column:
    """A transaction id that a replay of the same record yields again."""
    text = F.concat_ws("|", "server_id", F.col("arrival_seq").cast("string"), F.lit(kind), F.lit("tx"))
    return F.substring(F.sha2(text, 256), 1, 32)
