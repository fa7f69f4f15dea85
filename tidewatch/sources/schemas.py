"""Explicit schemas of the raw records; nothing is ever inferred."""

from __future__ import annotations

ENVELOPE = "server_id STRING, arrival_seq BIGINT, received_at TIMESTAMP, invoking_resource STRING"
CORRUPT = "_corrupt_record"

# Values that may be a number, text or an object are read as their JSON text.
HOOKS = {
    "export_log": "payload STRING",
    "export_channel": "channel STRING, action STRING, payload STRING",
    "export_inventory": "action STRING, payload STRING",
    "export_command": "source STRING, command STRING, args STRING, target STRING, data STRING",
    "swap_items": (
        "success BOOLEAN, source STRING, action STRING, from_type STRING, to_type STRING, "
        "drop_id STRING, from_inventory STRING, to_inventory STRING, count STRING, "
        "from_slot STRING, to_slot STRING"
    ),
    "create_item": (
        "success BOOLEAN, inventory_id STRING, resource STRING, count STRING, item_name STRING, "
        "item_label STRING, metadata STRING"
    ),
    "using_item": "source STRING, inventory_id STRING, item STRING, consume STRING",
    "open_inventory": "source STRING, inventory_id STRING, inventory_type STRING, slot STRING, net_id STRING",
    "buy_item": (
        "source STRING, item_name STRING, count STRING, total_price STRING, price STRING, "
        "payment STRING, currency STRING, shop_id STRING, shop_type STRING, to_inventory STRING, "
        "metadata STRING"
    ),
    "craft_item": "source STRING, recipe_name STRING, bench_id STRING, count STRING, to_inventory STRING",
    "account_money": (
        "event STRING, player_id INT, account STRING, amount DECIMAL(38,7), reason STRING, resource STRING"
    ),
    "set_job": (
        "player_id INT, job STRUCT<name: STRING, label: STRING, grade: INT, grade_label: STRING>, "
        "last_job STRUCT<name: STRING, label: STRING, grade: INT, grade_label: STRING>"
    ),
    "set_group": "player_id INT, group STRING, last_group STRING",
    "player_loaded": "player_id INT, is_new BOOLEAN",
    "connection": "event STRING, player_id INT, reason STRING",
    "door_state": "player_id INT, door_id STRING, locked BOOLEAN, used_item STRING",
    "tx_event": "name STRING, payload STRING",
    "tx_menu": "player_id INT, action STRING, allowed BOOLEAN, data STRING",
    "lifecycle": "logger_version STRING, inventory_adapter BOOLEAN, framework_adapter STRING",
}

DELIVERY_ATTEMPTS = (
    "server_id STRING, boot_id STRING, seq BIGINT, attempt INT, sent_at TIMESTAMP, "
    "response_at TIMESTAMP, status INT, accepted STRING, duplicates STRING, rejected STRING, "
    "event_count INT, dropped_since_last BIGINT"
)


def hook_schema(hook: str) -> str:
    """DDL of one hook's raw records."""
    if hook not in HOOKS:
        raise ValueError(f"unknown hook {hook!r}; known: {', '.join(sorted(HOOKS))}")
    return f"{ENVELOPE}, {HOOKS[hook]}"
