"""Inventory hooks to drafts: moves, creations, opens, uses, purchases and crafts."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch import fixed
from tidewatch.functions.records import json_object, metadata_json, object_text, read_slot
from tidewatch.functions.text import (
    json_scalar_text,
    lua_number,
    number_json,
    plate_of,
    round_coords,
    short_text,
    text_json,
    weapon_flag,
)
from tidewatch.operators import validate
from tidewatch.operators.drafts import draft, transaction_id


def classify_move(action: Column, from_type: Column, to_type: Column, from_inventory: Column,
                  to_inventory: Column) -> Column:
    """Event action of an item move; the first rule that applies. Ids are JSON scalars, so a
    number and the same digits as text are different inventories here."""
    players = (from_type == "player") & (to_type == "player")
    return (
        F.when(action == "give", "player_to_player_transfer")
        .when(to_type.isin("newdrop", "drop"), "item_dropped")
        .when(from_type == "drop", "item_picked_up")
        .when(to_type == "stash", "stash_deposit")
        .when(from_type == "stash", "stash_withdrawal")
        .when(to_type == "trunk", "trunk_deposit")
        .when(from_type == "trunk", "trunk_withdrawal")
        .when(to_type == "glovebox", "glovebox_deposit")
        .when(from_type == "glovebox", "glovebox_withdrawal")
        .when(players & ~from_inventory.eqNullSafe(to_inventory), "player_to_player_transfer")
        .otherwise("item_transfer")
    )


def resolve_target(action: Column, to_type: Column, from_inventory: Column,
                   to_inventory: Column) -> Column:
    """The receiving inventory of a player-to-player move, else NULL."""
    received = json_scalar_text(to_inventory)
    given = json_scalar_text(from_inventory)
    return F.when(
        (action == "player_to_player_transfer") & (to_type == "player")
        & received.isNotNull() & ~received.eqNullSafe(given),
        to_inventory,
    )


def notice_if_weapon(item: Column) -> Column:
    return F.when(weapon_flag(item), "notice")


def inventory_json(inventory: Column, kind: Column | None = None) -> Column:
    members = {"id": text_json(short_text(inventory, 64))}
    if kind is not None:
        members["type"] = text_json(kind)
    return object_text(**members)


def coords_json(df: DataFrame, enabled: bool) -> Column:
    """`[x,y,z]` rounded down to hundredths, for rows that carry a position."""
    if not enabled or "ped_x" not in df.columns:
        return F.lit(None).cast("string")
    axes = [number_json(round_coords(F.col(name))) for name in ("ped_x", "ped_y", "ped_z")]
    return F.when(
        F.col("ped_x").isNotNull(), F.concat(F.lit("["), F.concat_ws(",", *axes), F.lit("]"))
    )


def moves_to_events(df: DataFrame, log_shuffles: bool = False, coords: bool = False,
                    metadata_keys: int = fixed.MAX_METADATA_KEYS) -> DataFrame:
    """Committed item moves. The moved item is the source slot's, else the target slot's."""
    rows = validate.drop_slot_shuffles(validate.committed_only(df), log_shuffles)
    rows = rows.withColumns({
        "_from": read_slot(F.col("from_slot"), max_keys=metadata_keys),
        "_to": read_slot(F.col("to_slot"), max_keys=metadata_keys),
        "_action": classify_move(F.col("action"), F.col("from_type"), F.col("to_type"),
                                 F.col("from_inventory"), F.col("to_inventory")),
        "_given": json_scalar_text(F.col("from_inventory")),
        "_received": json_scalar_text(F.col("to_inventory")),
    })
    item = F.when(F.col("_from.name").isNotNull(), F.col("_from")).otherwise(F.col("_to"))
    rows = rows.withColumn("_item", item)
    given, received = F.col("_given"), F.col("_received")
    vehicle = ("trunk", "glovebox")
    plate = plate_of(
        F.when(F.col("to_type").isin(*vehicle), F.coalesce(received, F.lit("")))
        .when(F.col("from_type").isin(*vehicle), F.coalesce(given, F.lit("")))
    )
    swapped = F.when(
        (F.col("action") == "swap") & F.col("_to.name").isNotNull()
        & ~F.col("_to.name").eqNullSafe(F.col("_from.name")),
        F.col("_to.name"),
    )
    return draft(
        rows, "move",
        category=F.lit("inventory"),
        action=F.col("_action"),
        severity=notice_if_weapon(F.col("_item.name")),
        resource=F.lit("ox_inventory"),
        actor_ref=F.col("source"), actor_lookup=F.lit("player"),
        target_ref=resolve_target(F.col("_action"), F.col("to_type"), F.col("from_inventory"),
                                  F.col("to_inventory")),
        target_lookup=F.lit("player"),
        transaction_id=transaction_id("move"),
        context=json_object(
            coords=coords_json(df, coords),
            fromInventory=inventory_json(given, F.col("from_type")),
            toInventory=inventory_json(F.coalesce(received, F.col("drop_id")), F.col("to_type")),
            vehicle=F.when(plate.isNotNull(), object_text(plate=text_json(plate))),
        ),
        data=json_object(
            item=text_json(F.col("_item.name")),
            itemLabel=text_json(F.col("_item.label")),
            quantity=number_json(F.coalesce(lua_number(F.col("count")), F.col("_item.count"))),
            slot=number_json(F.col("_from.slot")),
            toSlot=number_json(F.col("_to.slot")),
            metadata=F.col("_item.metadata"),
            swappedWith=text_json(swapped),
            moveKind=text_json(F.col("action")),
        ),
    )


def creations_to_events(df: DataFrame, ignored: Iterable[str] = (),
                        account_items: Iterable[str] = fixed.ACCOUNT_ITEMS,
                        money_collector: bool = True,
                        metadata_keys: int = fixed.MAX_METADATA_KEYS) -> DataFrame:
    """Committed item creations, attributed to the script that asked for the item."""
    rows = validate.committed_only(df).withColumns({
        "item_name": short_text(F.col("item_name"), 64),
        "resource": short_text(F.col("resource"), 64),
    })
    rows = validate.drop_ignored_creators(rows, ignored)
    rows = validate.drop_account_echo(rows, account_items, money_collector)
    weapon = weapon_flag(F.col("item_name"))
    return draft(
        rows, "creation",
        category=F.lit("inventory"),
        action=F.when(weapon, "weapon_added").otherwise("item_added"),
        severity=F.when(weapon, "notice"),
        resource=F.coalesce(F.col("resource"), F.lit("ox_inventory")),
        actor_ref=F.col("inventory_id"), actor_lookup=F.lit("player"),
        context=json_object(inventory=inventory_json(json_scalar_text(F.col("inventory_id")))),
        data=json_object(
            item=text_json(F.col("item_name")),
            itemLabel=text_json(short_text(F.col("item_label"), 64)),
            quantity=number_json(lua_number(F.col("count"))),
            metadata=metadata_json(F.col("metadata"), metadata_keys),
            createdBy=text_json(F.col("resource")),
        ),
    )


def opens_to_events(df: DataFrame, coords: bool = False) -> DataFrame:
    """Containers opened; a player's own inventory is not one."""
    rows = validate.drop_own_open(df)
    return draft(
        rows, "open",
        category=F.lit("inventory"), action=F.lit("container_open"),
        resource=F.lit("ox_inventory"),
        actor_ref=F.col("source"), actor_lookup=F.lit("player"),
        context=json_object(
            coords=coords_json(df, coords),
            inventory=inventory_json(json_scalar_text(F.col("inventory_id")),
                                     F.col("inventory_type")),
        ),
        data=json_object(slot=F.col("slot"), netId=F.col("net_id")),
    )


def uses_to_events(df: DataFrame, all_uses: bool = False,
                   watchlist: Iterable[str] = fixed.USE_WATCHLIST, coords: bool = False,
                   metadata_keys: int = fixed.MAX_METADATA_KEYS) -> DataFrame:
    """Item uses on the watchlist, attempted rather than completed."""
    rows = df.withColumn("_item", read_slot(F.col("item"), max_keys=metadata_keys))
    rows = rows.withColumn("item_name", F.col("_item.name"))
    rows = validate.use_watchlist(rows, all_uses, watchlist)
    return draft(
        rows, "use",
        category=F.lit("inventory"), action=F.lit("item_used"), resource=F.lit("ox_inventory"),
        actor_ref=F.col("source"), actor_lookup=F.lit("player"),
        context=json_object(
            coords=coords_json(df, coords),
            inventory=inventory_json(json_scalar_text(F.col("inventory_id"))),
        ),
        data=json_object(
            item=text_json(F.col("_item.name")),
            itemLabel=text_json(F.col("_item.label")),
            slot=number_json(F.col("_item.slot")),
            metadata=F.col("_item.metadata"),
            consumed=F.col("consume"),
        ),
    )


def purchases_to_events(df: DataFrame, coords: bool = False,
                        metadata_keys: int = fixed.MAX_METADATA_KEYS) -> DataFrame:
    """Shop purchases with their total price and the account charged."""
    name = short_text(F.col("item_name"), 64)
    amount = F.coalesce(lua_number(F.col("total_price")), lua_number(F.col("price")))
    return draft(
        df, "purchase",
        category=F.lit("inventory"), action=F.lit("item_purchased"),
        severity=notice_if_weapon(name), resource=F.lit("ox_inventory"),
        actor_ref=F.col("source"), actor_lookup=F.lit("player"),
        transaction_id=transaction_id("purchase"),
        context=json_object(
            coords=coords_json(df, coords),
            inventory=inventory_json(F.coalesce("shop_id", "shop_type"), F.lit("shop")),
            toInventory=inventory_json(json_scalar_text(F.col("to_inventory")), F.lit("player")),
        ),
        data=json_object(
            item=text_json(name),
            quantity=number_json(lua_number(F.col("count"))),
            amount=number_json(amount),
            account=text_json(short_text(F.coalesce("payment", "currency"), 32)),
            shop=text_json(short_text(F.col("shop_type"), 64)),
            metadata=metadata_json(F.col("metadata"), metadata_keys),
        ),
    )


def crafts_to_events(df: DataFrame, coords: bool = False) -> DataFrame:
    """Items crafted at a bench."""
    return draft(
        df, "craft",
        category=F.lit("inventory"), action=F.lit("item_crafted"), resource=F.lit("ox_inventory"),
        actor_ref=F.col("source"), actor_lookup=F.lit("player"),
        context=json_object(
            coords=coords_json(df, coords),
            inventory=inventory_json(json_scalar_text(F.col("to_inventory"))),
        ),
        data=json_object(
            item=text_json(short_text(F.col("recipe_name"), 64)),
            quantity=number_json(lua_number(F.col("count"))),
            benchId=text_json(short_text(F.col("bench_id"), 64)),
        ),
    )
