"""Keep-or-drop rules. Every one is a plain predicate, so Catalyst moves it toward the scan."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch import fixed
from tidewatch.functions.records import json_map
from tidewatch.functions.text import (
    ascii_lower,
    ascii_lower_name,
    json_scalar_text,
    let,
    lua_number,
    normalise_action,
    weapon_flag,
)


def _is_text(value: Column) -> Column:
    return value.startswith('"')


def _is_table(value: Column) -> Column:
    return value.startswith("{") | value.startswith("[")


def event_reason(members: Column) -> Column:
    """Why an export record (JSON members) is refused, or NULL; the first rule that fails."""
    names = ("context", "data", "fields", "action", "channel", "category")

    def rules(given: Column) -> Column:
        at = {name: F.element_at(given, name) for name in names}
        action = F.when(_is_text(at["action"]), normalise_action(json_scalar_text(at["action"])))
        channel, category = at["channel"], at["category"]
        no_channel = channel.isNull()
        known = json_scalar_text(category).isin(*fixed.CATEGORIES)
        return (
            F.when(given.isNull(), "not_a_table")
            .when(~_is_table(at["context"]), "bad_context")
            .when(~_is_table(at["data"]), "bad_data")
            .when(~_is_table(at["fields"]), "bad_fields")
            .when(action.isNull(), "missing_action")
            .when(~_is_text(channel) | (channel == '""'), "bad_channel")
            .when(~_is_text(category), "bad_category")
            .when(no_channel & category.isNull(), "no_destination")
            .when(no_channel & ~known, "unknown_category")
        )

    return let(members, rules)


def validate_event(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Add `reason`: NULL for records that may be logged."""
    return df.withColumn("reason", event_reason(json_map(F.col(payload))))


def trusted_source(df: DataFrame, content: Column) -> DataFrame:
    """Staff tool records count only when the tool itself sent them and the content is usable."""
    return df.filter((F.col("invoking_resource") == "monitor") & content)


def drop_slot_shuffles(df: DataFrame, log_shuffles: bool = False) -> DataFrame:
    """Drop moves that start and end in the same inventory, compared as text."""
    if log_shuffles:
        return df
    origin, end = json_scalar_text(F.col("from_inventory")), json_scalar_text(F.col("to_inventory"))
    return df.filter(origin.isNull() | end.isNull() | (origin != end))


def drop_ignored_creators(df: DataFrame, ignored: Iterable[str] = ()) -> DataFrame:
    """Drop creations by the listed scripts, but never weapons."""
    names = sorted({ascii_lower_name(name) for name in ignored})
    if not names:
        return df
    listed = F.coalesce(ascii_lower(F.col("resource")).isin(*names), F.lit(False))
    return df.filter(weapon_flag(F.col("item_name")) | ~listed)


def drop_account_echo(df: DataFrame, account_items: Iterable[str] = fixed.ACCOUNT_ITEMS,
                      money_collector: bool = True) -> DataFrame:
    """Drop cash items the framework creates for a payment the money collector already logs."""
    items = list(account_items)
    if not money_collector or not items:
        return df
    echo = F.col("item_name").isin(*items) & (F.col("resource") == "es_extended")
    return df.filter(~F.coalesce(echo, F.lit(False)))


def use_watchlist(df: DataFrame, all_uses: bool = False,
                  watchlist: Iterable[str] = fixed.USE_WATCHLIST) -> DataFrame:
    """Item uses worth logging: all, or those on the list; an empty list means none."""
    if all_uses:
        return df
    names = [ascii_lower_name(name) for name in watchlist]
    return df.filter(F.col("item_name").isin(*names)) if names else df.filter(F.lit(False))


def drop_balance_resync(df: DataFrame) -> DataFrame:
    return df.filter(~F.coalesce(F.col("reason") == fixed.RESYNC_REASON, F.lit(False)))


def drop_autolocks(df: DataFrame) -> DataFrame:
    """Door changes by timers have no player behind them."""
    return df.filter(F.col("player_id").isNotNull())


def final_restart_only(df: DataFrame, seconds: Column) -> DataFrame:
    """Of a restart countdown, the notices of the last minute."""
    return df.filter(F.coalesce(lua_number(seconds), F.lit(0)) <= 60)


def committed_only(df: DataFrame) -> DataFrame:
    return df.filter(F.col("success"))


def event_bytes(encoded: Column) -> Column:
    """Bytes an event takes in a batch: its JSON and a separator."""
    return F.octet_length(encoded) + 1


def drop_oversize(df: DataFrame, encoded: str = "encoded",
                  limit: int = fixed.MAX_EVENT_BYTES) -> DataFrame:
    """Drop events that could not be encoded or whose JSON is over the limit."""
    return df.filter(F.octet_length(encoded) <= limit)


def oversize_report(df: DataFrame, encoded: str = "encoded",
                    limit: int = fixed.MAX_EVENT_BYTES) -> DataFrame:
    """Per server, how many events `drop_oversize` drops, and why."""
    return df.groupBy("server_id").agg(
        F.count_if(F.octet_length(encoded) > limit).alias("oversized"),
        F.count_if(F.col(encoded).isNull()).alias("unencodable"),
    )


def drop_own_open(df: DataFrame) -> DataFrame:
    """Players opening their own inventory are not worth a row."""
    own = (F.col("inventory_type") == "player") & F.col("inventory_id").isNull()
    return df.filter(~F.coalesce(own, F.lit(False)))


def drop_duplicate_announcement(df: DataFrame) -> DataFrame:
    """The menu's announcement row repeats the announcement event."""
    return df.filter(F.col("action") != "announcement")
