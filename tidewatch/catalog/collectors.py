"""Collector queries: raw hook records to drafts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch import fixed
from tidewatch.catalog.base import (
    BYTES_OF_CORE,
    EVENTS,
    LARGE_BYTES,
    MOVE_HOOKS,
    MOVES,
    Query,
    duck,
    frame,
    over,
    shared_folder,
    spread,
    sql_action,
    sql_number,
    sql_object,
    sql_text,
    sql_weapon,
)
from tidewatch.functions import canonical_json
from tidewatch.operators import exports, inventory, players, staff

SHOWN = ("category", "action", "severity", "resource", "actor_ref", "target_ref")


def shown(drafts: DataFrame) -> DataFrame:
    return drafts.select(
        "arrival_seq", *SHOWN,
        canonical_json(F.col("context")).alias("context"), canonical_json(F.col("data")).alias("data"),
    )


def expected(raw: str, where: str = "true", **columns: str) -> str:
    """SQL of the drafts: one expression per column, NULL for the rest."""
    parts = [f"{columns.get(name, 'NULL')} AS {name}" for name in (*SHOWN, "context", "data")]
    return duck(f"SELECT arrival_seq, {', '.join(parts)} FROM ({raw}) AS raw WHERE {where}")


def mapped(column: str, pairs: dict[str, str]) -> str:
    cases = " ".join(f"WHEN '{key}' THEN '{value}'" for key, value in pairs.items())
    return f"CASE {column} {cases} END"


PLAIN_FROM = "trim(from_inventory, '\"')"
PLAIN_TO = "trim(to_inventory, '\"')"
CLASSIFY_SQL = """CASE WHEN action = 'give' THEN 'player_to_player_transfer'
 WHEN to_type IN ('newdrop', 'drop') THEN 'item_dropped' WHEN from_type = 'drop' THEN 'item_picked_up'
 WHEN to_type = 'stash' THEN 'stash_deposit' WHEN from_type = 'stash' THEN 'stash_withdrawal'
 WHEN to_type = 'trunk' THEN 'trunk_deposit' WHEN from_type = 'trunk' THEN 'trunk_withdrawal'
 WHEN to_type = 'glovebox' THEN 'glovebox_deposit' WHEN from_type = 'glovebox' THEN 'glovebox_withdrawal'
 WHEN from_type = 'player' AND to_type = 'player' AND from_inventory IS DISTINCT FROM to_inventory
 THEN 'player_to_player_transfer' ELSE 'item_transfer' END"""

_SLOTTED = "line % 5 <> 0"
_SWAPPED = f"(line % 5 = 0 OR line % 3 = 0)"
_ITEM = f"CASE WHEN {_SLOTTED} THEN item ELSE label END"
_PLATE = (f"nullif(regexp_extract(CASE WHEN to_type IN ('trunk', 'glovebox') THEN coalesce({PLAIN_TO}, '') "
          f"WHEN from_type IN ('trunk', 'glovebox') THEN coalesce({PLAIN_FROM}, '') END, "
          "'^[A-Za-z]+-?([A-Za-z0-9]+)$', 1), '')")
MOVES_SQL = expected(
    MOVES, f"success AND ({PLAIN_FROM} IS NULL OR {PLAIN_TO} IS NULL OR {PLAIN_FROM} <> {PLAIN_TO})",
    category="'inventory'", action=CLASSIFY_SQL, resource="'ox_inventory'", actor_ref="source",
    severity=f"CASE WHEN {sql_weapon(_ITEM)} THEN 'notice' END",
    target_ref=f"CASE WHEN ({CLASSIFY_SQL}) = 'player_to_player_transfer' AND to_type = 'player' "
               f"AND to_inventory IS NOT NULL AND {PLAIN_TO} <> {PLAIN_FROM} THEN to_inventory END",
    context=sql_object(
        fromInventory=sql_object(id=sql_text(PLAIN_FROM), type=sql_text("from_type")),
        toInventory=sql_object(id=sql_text(f"coalesce({PLAIN_TO}, drop_id)"), type=sql_text("to_type")),
        vehicle=f"CASE WHEN {_PLATE} IS NOT NULL THEN '{{\"plate\":\"' || {_PLATE} || '\"}}' END",
    ),
    data=sql_object(
        item=sql_text(_ITEM),
        itemLabel=sql_text(f"CASE WHEN {_SLOTTED} THEN label END"),
        quantity=f"coalesce(count, CASE WHEN {_SLOTTED} THEN CAST(quantity AS VARCHAR) ELSE '1' END)",
        slot="CAST(line AS VARCHAR)", toSlot="CAST(part_size AS VARCHAR)",
        metadata=f"CASE WHEN {_SLOTTED} THEN '{{\"serial\":\"' || part_key || '\"}}' END",
        swappedWith=f"CASE WHEN action = 'swap' AND {_SWAPPED} AND label IS DISTINCT FROM "
                    f"CASE WHEN {_SLOTTED} THEN item END THEN '\"' || label || '\"' END",
        moveKind=sql_text("action"),
    ),
)

CREATIONS = f"""
SELECT server_id, arrival_seq, received_at, invoking_resource, success,
       CASE WHEN line % 2 = 0 THEN CAST(supp_key AS STRING) ELSE '"char1:' || CAST(part_key AS STRING) || '"' END
           AS inventory_id,
       CASE supp_key % 5 WHEN 0 THEN 'es_extended' WHEN 1 THEN 'Sync_DrugsCreator' WHEN 2 THEN NULL
            ELSE 'shop_' || CAST(supp_key % 3 AS STRING) END AS resource,
       CAST(quantity AS STRING) AS count,
       CASE WHEN part_key % 4 = 0 THEN 'money' ELSE item END AS item_name, label AS item_label,
       CASE WHEN line % 3 = 0 THEN '{{"quality":' || CAST(part_size AS STRING) || ',"by":"' || label || '"}}' END
           AS metadata
FROM ({MOVES}) AS moves
"""
_IGNORED = ["sync_drugscreator"]
CREATIONS_SQL = expected(
    CREATIONS,
    f"success AND ({sql_weapon('item_name')} OR coalesce(lower(resource), '') <> 'sync_drugscreator') "
    "AND NOT (item_name = 'money' AND coalesce(resource, '') = 'es_extended')",
    category="'inventory'",
    action=f"CASE WHEN {sql_weapon('item_name')} THEN 'weapon_added' ELSE 'item_added' END",
    severity=f"CASE WHEN {sql_weapon('item_name')} THEN 'notice' END",
    resource="coalesce(resource, 'ox_inventory')", actor_ref="inventory_id",
    context=sql_object(inventory=sql_object(id=sql_text("trim(inventory_id, '\"')"))),
    data=sql_object(
        item=sql_text("item_name"), itemLabel=sql_text("item_label"), quantity="count",
        metadata="regexp_replace(metadata, '\\{(\"quality\":[0-9]+),(\"by\":\"[^\"]*\")\\}', '{\\2,\\1}')",
        createdBy=sql_text("resource"),
    ),
)

OPENS = f"""
SELECT server_id, arrival_seq, received_at, source, to_type AS inventory_type,
       CASE WHEN to_type = 'player' AND line % 2 = 0 THEN NULL ELSE to_inventory END AS inventory_id,
       CAST(line AS STRING) AS slot, CASE WHEN to_type = 'trunk' THEN CAST(part_key AS STRING) END AS net_id
FROM ({MOVES}) AS moves
"""
OPENS_SQL = expected(
    OPENS, "NOT (inventory_type = 'player' AND inventory_id IS NULL)",
    category="'inventory'", action="'container_open'", resource="'ox_inventory'", actor_ref="source",
    context=sql_object(inventory=sql_object(id=sql_text("trim(inventory_id, '\"')"), type=sql_text("inventory_type"))),
    data=sql_object(slot="slot", netId="net_id"),
)

USES = f"""
SELECT server_id, arrival_seq, received_at, source, to_inventory AS inventory_id,
       '{{"name":"' || CASE part_key % 6 WHEN 0 THEN 'lockpick' WHEN 1 THEN 'bandage' WHEN 2 THEN 'water'
           ELSE item END || '","slot":' || CAST(line AS STRING) || '}}' AS item,
       CASE WHEN line % 2 = 0 THEN '1' ELSE '0.5' END AS consume,
       part_key, line, item AS raw_item
FROM ({MOVES}) AS moves
"""
USES_SQL = expected(
    USES, "part_key % 6 IN (0, 1)",
    category="'inventory'", action="'item_used'", resource="'ox_inventory'", actor_ref="source",
    context=sql_object(inventory=sql_object(id=sql_text("trim(inventory_id, '\"')"))),
    data=sql_object(item="CASE part_key % 6 WHEN 0 THEN '\"lockpick\"' ELSE '\"bandage\"' END",
                    slot="CAST(line AS VARCHAR)", consumed="consume"),
)

PURCHASES = f"""
SELECT server_id, arrival_seq, received_at, source, item AS item_name, CAST(quantity AS STRING) AS count,
       CASE WHEN line % 3 <> 0 THEN CAST(CAST(price AS DECIMAL(18,2)) AS STRING) END AS total_price,
       CAST(part_size AS STRING) AS price, CASE WHEN line % 2 = 0 THEN 'bank' END AS payment, 'money' AS currency,
       CASE WHEN supp_key % 2 = 0 THEN 'shop-' || CAST(supp_key AS STRING) END AS shop_id,
       'General' AS shop_type, source AS to_inventory, CAST(NULL AS STRING) AS metadata
FROM ({MOVES}) AS moves
"""
PURCHASES_SQL = expected(
    PURCHASES, category="'inventory'", action="'item_purchased'", resource="'ox_inventory'", actor_ref="source",
    severity=f"CASE WHEN {sql_weapon('item_name')} THEN 'notice' END",
    context=sql_object(
        inventory=sql_object(id=sql_text("coalesce(shop_id, shop_type)"), type="'\"shop\"'"),
        toInventory=sql_object(id=sql_text("to_inventory"), type="'\"player\"'")),
    data=sql_object(
        item=sql_text("item_name"), quantity="count",
        amount=sql_number("coalesce(CAST(total_price AS DECIMAL(18,2)), CAST(price AS DECIMAL(18,2)))"),
        account=sql_text("coalesce(payment, currency)"), shop=sql_text("shop_type")),
)

CRAFTS = f"""
SELECT server_id, arrival_seq, received_at, source, item AS recipe_name, CAST(quantity AS STRING) AS count,
       'bench_' || CAST(supp_key % 9 AS STRING) AS bench_id, source AS to_inventory
FROM ({MOVES}) AS moves
"""
CRAFTS_SQL = expected(
    CRAFTS, category="'inventory'", action="'item_crafted'", resource="'ox_inventory'", actor_ref="source",
    context=sql_object(inventory=sql_object(id=sql_text("to_inventory"))),
    data=sql_object(item=sql_text("recipe_name"), quantity="count", benchId=sql_text("bench_id")),
)

MONEY = f"""
SELECT server_id, arrival_seq, received_at, 'es_extended' AS invoking_resource,
       CASE arrival_seq % 3 WHEN 0 THEN 'add' WHEN 1 THEN 'remove' ELSE 'set' END AS event,
       source AS player_id,
       CASE source % 5 WHEN 0 THEN 'money' WHEN 1 THEN 'bank' WHEN 2 THEN 'black_money'
            WHEN 3 THEN 'Casino Chips' ELSE '!' END AS account,
       amount,
       CASE arrival_seq % 7 WHEN 0 THEN 'Paycheck' WHEN 1 THEN 'Welfare Check' WHEN 2 THEN 'Sync account with item'
            WHEN 3 THEN NULL ELSE action END AS reason,
       CASE WHEN arrival_seq % 2 = 0 THEN 'script_' || action END AS resource
FROM ({EVENTS}) AS raw
"""
_BASE = "CASE account WHEN 'money' THEN 'cash' WHEN 'bank' THEN 'bank' WHEN 'black_money' THEN 'dirty' WHEN '!' THEN 'account' ELSE 'casino_chips' END"
_MONEY_COLUMNS = dict(
    category="'money'", resource="coalesce(resource, invoking_resource)",
    actor_ref="CAST(player_id AS VARCHAR)",
    data=sql_object(account=sql_text("account"), amount=sql_number("amount"), reason=sql_text("reason")),
)
MONEY_SQL = expected(
    MONEY, "event IN ('add', 'remove')",
    action=f"CASE WHEN event = 'add' AND reason IN ('Paycheck', 'Welfare Check') THEN 'salary' ELSE {_BASE} || "
           "CASE event WHEN 'add' THEN '_added' ELSE '_removed' END END", **_MONEY_COLUMNS)
BALANCES_SQL = expected(
    MONEY, "event = 'set' AND coalesce(reason, '') <> 'Sync account with item'",
    action="'balance_set'", **_MONEY_COLUMNS)

ORDERS = """
SELECT CAST(o_custkey % 3 AS STRING) AS server_id, o_orderkey AS arrival_seq,
       CAST(o_orderdate AS TIMESTAMP) AS received_at, 'core' AS invoking_resource,
       o_custkey % 97 AS player_id, o_orderstatus AS status, o_orderpriority AS priority,
       c_mktsegment AS segment, c_nationkey AS nation, c_name AS name, o_custkey AS customer
FROM $orders JOIN $customer ON o_custkey = c_custkey
"""


def _jobs(df: DataFrame) -> DataFrame:
    label = F.when(F.col("nation") % 2 == 0, F.col("segment"))
    job = F.struct(F.lower("segment").alias("name"), label.alias("label"), F.col("nation").alias("grade"),
                   F.when(F.col("status") == "F", F.lit("Boss")).alias("grade_label"))
    last = F.struct(F.lit("unemployed").alias("name"), F.lit(None).cast("string").alias("label"),
                    F.lit(0).alias("grade"), F.lit("Jobless").alias("grade_label"))
    return players.jobs_to_events(df.withColumns({
        "job": F.when(F.col("arrival_seq") % 10 != 0, job),
        "last_job": F.when(F.col("arrival_seq") % 3 == 0, last),
    }))


JOBS_SQL = expected(
    ORDERS, "arrival_seq % 10 <> 0", category="'player'", action="'job_changed'", resource="'core'",
    actor_ref="CAST(player_id AS VARCHAR)",
    data=sql_object(
        job=sql_text("CASE WHEN nation % 2 = 0 THEN segment ELSE lower(segment) END || ' - ' || "
                     "CASE WHEN status = 'F' THEN 'Boss' ELSE CAST(nation AS VARCHAR) END"),
        jobName=sql_text("lower(segment)"), grade="CAST(nation AS VARCHAR)",
        previous="CASE WHEN arrival_seq % 3 = 0 THEN '\"unemployed - Jobless\"' END"),
)

CONNECTIONS = ORDERS.replace(
    "'core' AS invoking_resource",
    "'core' AS invoking_resource, CASE o_orderstatus WHEN 'F' THEN 'joining' "
    "WHEN 'O' THEN 'dropped' ELSE 'other' END AS event, o_orderpriority AS reason")

DOORS = "SELECT CAST(p_partkey % 3 AS STRING) AS server_id, CAST(p_partkey AS STRING) AS door_id, p_name AS name FROM $part"
DOOR_STATES = f"""
SELECT server_id, arrival_seq, received_at, CASE WHEN arrival_seq % 6 <> 0 THEN source END AS player_id,
       CAST(arrival_seq % 90 AS STRING) AS door_id, action = 'click' AS locked,
       CASE WHEN action = 'error' THEN 'lockpick' END AS used_item
FROM ({EVENTS}) AS raw
"""

TX = """
SELECT CAST(o_custkey % 3 AS STRING) AS server_id, o_orderkey AS arrival_seq,
       CAST(o_orderdate AS TIMESTAMP) AS received_at,
       CASE WHEN o_orderkey % 19 = 0 THEN 'cheat_menu' ELSE 'monitor' END AS invoking_resource,
       CASE o_orderkey % 17 WHEN 0 THEN 'playerBanned' WHEN 1 THEN 'playerKicked' WHEN 2 THEN 'playerWarned'
            WHEN 3 THEN 'actionRevoked' WHEN 4 THEN 'playerHealed' WHEN 5 THEN 'playerDirectMessage'
            WHEN 6 THEN 'announcement' WHEN 7 THEN 'serverShuttingDown' WHEN 8 THEN 'scheduledRestart'
            WHEN 9 THEN 'scheduledRestartSkipped' WHEN 10 THEN 'whitelistPlayer' WHEN 11 THEN 'whitelistPreApproval'
            WHEN 12 THEN 'whitelistRequest' WHEN 13 THEN 'consoleCommand' WHEN 14 THEN 'adminAuth'
            WHEN 15 THEN 'playerBanned' ELSE 'somethingElse' END AS name,
       o_custkey, o_orderstatus, o_orderpriority,
       CASE WHEN o_orderkey % 23 = 0 THEN '"text"' ELSE
       '{"author":"Staff ' || o_orderstatus || '","reason":"' || o_orderpriority || '","expiration":'
       || CASE WHEN o_orderkey % 2 = 0 THEN 'false' ELSE '1700000000' END || ',"durationTranslated":"2 days","actionId":"A'
       || CAST(o_orderkey AS STRING) || '","targetNetId":' || CASE WHEN o_orderkey % 4 = 0 THEN 'null' ELSE CAST(o_custkey % 97 AS STRING) END
       || ',"targetName":"Name ' || CAST(o_custkey AS STRING) || '","targetIds":["license:' || CAST(o_custkey AS STRING)
       || '","ip:1.2.3.4","discord:1","discord:' || CAST(o_custkey AS STRING) || '"],"target":'
       || CASE WHEN o_orderkey % 3 = 0 THEN '-1' ELSE CAST(o_custkey % 97 AS STRING) END
       || ',"actionType":"' || CASE WHEN o_orderkey % 5 = 0 THEN 'ban' ELSE 'warn' END || '","revokedBy":"Admin","playerName":"P",'
       || '"playerIds":["steam:' || CAST(o_custkey AS STRING) || '"],"actionReason":"why","actionAuthor":"who","message":"hello","delay":5000,'
       || '"secondsRemaining":' || CAST(o_custkey % 5 * 30 AS STRING) || ',"temporary":true,"adminName":"Boss","license":"license:z",'
       || '"action":"added","identifier":"steam:1","requestId":"R1","command":"status","isAdmin":' || CASE WHEN o_orderkey % 2 = 0 THEN 'true' ELSE 'false' END
       || ',"netid":' || CAST(o_custkey % 97 AS STRING) || ',"username":"root"}' END AS payload
FROM $orders
"""
_EVERY = "arrival_seq % 3 = 0"
STAFF_SQL = expected(
    TX,
    "invoking_resource = 'monitor' AND arrival_seq % 23 <> 0 AND name <> 'somethingElse' "
    "AND NOT (name = 'scheduledRestart' AND o_custkey % 5 * 30 > 60) AND NOT (name = 'adminAuth' AND arrival_seq % 2 = 1)",
    category="'staff'", resource="'txAdmin'",
    action=f"CASE WHEN name = 'actionRevoked' THEN CASE WHEN arrival_seq % 5 = 0 THEN 'unban' ELSE 'warning_revoked' END ELSE "
    + mapped("name", {
        "playerBanned": "ban", "playerKicked": "kick", "playerWarned": "warn", "playerHealed": "heal",
        "playerDirectMessage": "direct_message", "announcement": "announcement",
        "serverShuttingDown": "server_shutdown", "scheduledRestart": "server_restart",
        "scheduledRestartSkipped": "server_restart_skipped", "whitelistPlayer": "whitelist_changed",
        "whitelistPreApproval": "whitelist_changed", "whitelistRequest": "whitelist_changed",
        "consoleCommand": "console_command", "adminAuth": "admin_auth"}) + " END",
    severity="CASE WHEN name IN ('playerBanned', 'serverShuttingDown', 'consoleCommand') THEN 'notice' END",
    actor_ref="CASE WHEN name = 'actionRevoked' THEN '\"Admin\"' WHEN name LIKE 'whitelist%' THEN '\"Boss\"' "
              "WHEN name = 'adminAuth' THEN CAST(o_custkey % 97 AS VARCHAR) WHEN name = 'scheduledRestart' THEN NULL "
              "ELSE '\"Staff ' || o_orderstatus || '\"' END",
    target_ref="CASE WHEN name IN ('playerBanned', 'playerWarned') THEN '{\"discord\":\"discord:' || o_custkey || "
               "'\",\"license\":\"license:' || o_custkey || '\",\"name\":\"Name ' || o_custkey || '\"}' "
               "WHEN name = 'actionRevoked' THEN '{\"name\":\"P\",\"steam\":\"steam:' || o_custkey || '\"}' "
               "WHEN name LIKE 'whitelist%' THEN '{\"license\":\"license:z\",\"name\":\"P\"}' END",
    data="CASE name " + " ".join(f"WHEN '{name}' THEN {value}" for name, value in {
        "playerBanned": sql_object(reason=sql_text("o_orderpriority"), actionId=sql_text("'A' || arrival_seq"),
                                   duration="CASE WHEN arrival_seq % 2 = 0 THEN '\"permanent\"' ELSE '\"2 days\"' END"),
        "playerKicked": sql_object(reason=sql_text("o_orderpriority"), everyone=f"CASE WHEN {_EVERY} THEN 'true' END"),
        "playerWarned": sql_object(reason=sql_text("o_orderpriority"), actionId=sql_text("'A' || arrival_seq")),
        "actionRevoked": sql_object(reason="'\"why\"'", actionId=sql_text("'A' || arrival_seq"), originalAuthor="'\"who\"'"),
        "playerHealed": sql_object(everyone=f"CASE WHEN {_EVERY} THEN 'true' END"),
        "playerDirectMessage": sql_object(message="'\"hello\"'"),
        "announcement": sql_object(message="'\"hello\"'"),
        "serverShuttingDown": sql_object(message="'\"hello\"'", delay="'5000'"),
        "scheduledRestart": sql_object(secondsRemaining="CAST(o_custkey % 5 * 30 AS VARCHAR)"),
        "scheduledRestartSkipped": sql_object(secondsRemaining="CAST(o_custkey % 5 * 30 AS VARCHAR)", temporary="'true'"),
        "consoleCommand": sql_object(command="'\"status\"'"),
        "adminAuth": sql_object(account="'\"root\"'"),
    }.items()) + " ELSE " + sql_object(change="'\"added\"'", identifier="'\"steam:1\"'", requestId="'\"R1\"'") + " END",
)

_MENU = ("teleportWaypoint", "teleportCoords", "teleportPlayer", "summonPlayer", "healPlayer", "healSelf", "healAll",
         "spectatePlayer", "freezePlayer", "spawnVehicle", "deleteVehicle", "clearArea", "playerModeChanged",
         "drunkEffect", "setOnFire", "wildAttack", "announcement", "viewPlayer")
MENU = f"""
SELECT server_id, arrival_seq, received_at,
       CASE WHEN arrival_seq % 23 = 0 THEN 'cheat_menu' ELSE 'monitor' END AS invoking_resource,
       source AS player_id, name AS action, arrival_seq % 7 <> 0 AS allowed,
       CASE name WHEN 'teleportCoords' THEN '{{"x":' || CAST(source AS STRING) || ',"y":2,"z":3}}'
            WHEN 'playerModeChanged' THEN CASE WHEN source % 2 = 0 THEN '"noclip"' ELSE '"godmode"' END
            WHEN 'spawnVehicle' THEN '"adder"' ELSE CAST(source AS STRING) END AS data
FROM (SELECT *, CASE arrival_seq % {len(_MENU)} {' '.join(f"WHEN {i} THEN '{m}'" for i, m in enumerate(_MENU))} END AS name
      FROM ({EVENTS}) AS raw) AS named
"""
_ALLOWED = "arrival_seq % 7 <> 0"
_MENU_ACTION = ("CASE WHEN action = 'playerModeChanged' THEN CASE WHEN player_id % 2 = 0 THEN 'noclip' ELSE 'player_mode' END ELSE "
                + mapped("action", fixed.MENU_ACTIONS) + " END")
MENU_SQL = expected(
    MENU, "invoking_resource = 'monitor' AND action <> 'announcement'",
    category=f"CASE WHEN {_ALLOWED} THEN 'staff' ELSE 'security' END",
    action=f"CASE WHEN {_ALLOWED} THEN coalesce({_MENU_ACTION}, 'command_executed') ELSE 'unauthorized_event' END",
    severity=f"CASE WHEN NOT {_ALLOWED} THEN 'warning' WHEN action IN ('drunkEffect', 'setOnFire', 'wildAttack') THEN 'notice' END".replace("NOT arrival_seq % 7 <> 0", "arrival_seq % 7 = 0"),
    resource="'txAdmin'", actor_ref="CAST(player_id AS VARCHAR)",
    target_ref=f"CASE WHEN {_ALLOWED} AND action IN ('summonPlayer', 'healPlayer', 'spectatePlayer', 'freezePlayer', "
               "'drunkEffect', 'setOnFire', 'wildAttack') THEN data END",
    data=f"CASE WHEN {_ALLOWED} THEN " + sql_object(
        menu=sql_text("action"), mode="CASE WHEN action = 'playerModeChanged' THEN data END",
        model="CASE WHEN action = 'spawnVehicle' THEN data END",
        coords="CASE WHEN action = 'teleportCoords' THEN '[' || player_id || ',2,3]' END",
        radius="CASE WHEN action = 'clearArea' THEN data END",
        command=f"CASE WHEN {_MENU_ACTION} IS NULL THEN '\"txAdmin menu: ' || action || '\"' END",
    ) + " ELSE '{\"reason\":\"txAdmin menu action \\\"' || action || '\\\" without permission\"}' END",
)

_COMMANDS = list(fixed.COMMAND_ACTIONS) + ["clearinv", "Ban", ""]
COMMANDS = f"""
SELECT server_id, arrival_seq, received_at, 'es_extended' AS invoking_resource, CAST(source AS STRING) AS source,
       CASE WHEN arrival_seq % 2 = 0 THEN upper(cmd) ELSE cmd END AS command,
       CASE arrival_seq % 3 WHEN 0 THEN '"12 admin"' WHEN 1 THEN '["7","x"]' END AS args,
       CASE WHEN arrival_seq % 4 = 0 THEN '"char1:' || CAST(source AS STRING) || '"' END AS target,
       CASE WHEN arrival_seq % 5 = 0 THEN '{{"note":"n"}}' END AS data, cmd
FROM (SELECT *, CASE arrival_seq % {len(_COMMANDS)} {' '.join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(_COMMANDS))} END AS cmd
      FROM ({EVENTS}) AS raw) AS named
"""
COMMANDS_SQL = expected(
    COMMANDS, "cmd <> ''", category="'staff'",
    action="coalesce(" + mapped("lower(cmd)", fixed.COMMAND_ACTIONS) + ", 'command_executed')",
    resource="'es_extended'", actor_ref="source", target_ref="target",
    data=sql_object(
        command=sql_text("'/' || command || CASE arrival_seq % 3 WHEN 0 THEN ' 12 admin' WHEN 1 THEN ' 7 x' ELSE '' END"),
        note="CASE WHEN arrival_seq % 5 = 0 THEN '\"n\"' END"),
)

EXPORTS = """
SELECT 'srv' AS server_id, p_partkey AS arrival_seq, TIMESTAMP '2024-01-01 00:00:00' AS received_at,
       'shop' AS invoking_resource,
       CASE p_partkey % 6 WHEN 0 THEN '""' WHEN 1 THEN '42' ELSE '"' || lower(p_brand) || '.sales"' END AS channel,
       CASE p_partkey % 8 WHEN 0 THEN '"!!!"' WHEN 1 THEN 'false' ELSE '"Sold ' || p_name || '"' END AS action,
       CASE p_partkey % 5 WHEN 0 THEN NULL WHEN 1 THEN '{"data":"bad"}' WHEN 2 THEN '[1]'
            WHEN 3 THEN '{"severity":"success","data":{"quantity":' || CAST(p_size AS STRING) || '},"context":{"custom":"kept"}}'
            ELSE '{"actor":' || CAST(p_size AS STRING) || ',"resource":"own"}' END AS payload,
       p_name, p_size, p_brand
FROM $part
"""
_GOOD_ACTION = "arrival_seq % 8 NOT IN (0, 1)"
_EXPORT_COLUMNS = dict(
    action="'Sold ' || p_name", severity="CASE WHEN arrival_seq % 5 = 3 THEN 'success' END",
    resource="CASE WHEN arrival_seq % 5 = 4 THEN 'own' ELSE 'shop' END",
    actor_ref="CASE WHEN arrival_seq % 5 = 4 THEN CAST(p_size AS VARCHAR) END",
    context="CASE WHEN arrival_seq % 5 = 3 THEN '{\"custom\":\"kept\"}' END",
    data="CASE WHEN arrival_seq % 5 = 3 THEN '{\"quantity\":' || p_size || '}' END",
)

LIFECYCLE = """
SELECT CAST(s_suppkey AS STRING) AS server_id, s_suppkey AS arrival_seq, TIMESTAMP '2024-01-01 00:00:00' AS received_at,
       'tidewatch' AS invoking_resource, '1.' || CAST(s_nationkey AS STRING) AS logger_version,
       s_suppkey % 2 = 0 AS inventory_adapter, CASE WHEN s_suppkey % 3 = 0 THEN 'es_extended' END AS framework_adapter
FROM $supplier
"""


def _groups(df: DataFrame) -> DataFrame:
    return players.groups_to_events(df.select(
        "server_id", "arrival_seq", "received_at", "invoking_resource", "player_id",
        F.col("priority").alias("group"), F.when(F.col("status") == "F", "user").alias("last_group")))


raw_frame = frame


#: Joins that several collectors read, each with the columns that any of them takes.
JOINS = {
    "FROM $lineitem JOIN $part ON l_partkey = p_partkey":
        "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_returnflag, l_linestatus, l_shipdate, "
        "p_type, p_name, p_brand, p_size",
    "FROM $orders JOIN $customer ON o_custkey = c_custkey":
        "o_orderkey, o_custkey, o_orderdate, o_orderstatus, o_orderpriority, c_mktsegment, c_nationkey, c_name",
}


def _joined_once(spark, sf, large: int) -> dict[str, str]:
    """The joins, each written to the shared folder: one shuffle of a table instead of one a collector."""
    found = {}
    for join, columns in JOINS.items():
        place = shared_folder(spark, "records")
        rows = spread(raw_frame(spark, sf, f"SELECT {columns} {join}"), large)
        rows.write.option("compression", "zstd").parquet(place)
        found[join] = f"FROM parquet.`{place}`"
    return found


def all_frames(spark, sf, once: bool = False) -> dict[str, DataFrame]:
    """Every collector over the given tables; `once` if all of them will be read. Records are wide, with JSON among
    their columns, so those of large tables stay in the task that makes them.
    """
    large = min(BYTES_OF_CORE * spark.sparkContext.defaultParallelism, LARGE_BYTES)
    joined = _joined_once(spark, sf, large) if once else {}

    def frame(spark, sf, text):
        for join, written in joined.items():
            text = text.replace(join, written)
        return spread(raw_frame(spark, sf, text), large)

    money = frame(spark, sf, MONEY)
    orders = frame(spark, sf, ORDERS)
    return {
        "moves": inventory.moves_to_events(frame(spark, sf, MOVE_HOOKS)),
        "creations": inventory.creations_to_events(frame(spark, sf, CREATIONS), _IGNORED),
        "purchases": inventory.purchases_to_events(frame(spark, sf, PURCHASES)),
        "crafts": inventory.crafts_to_events(frame(spark, sf, CRAFTS)),
        "uses": inventory.uses_to_events(frame(spark, sf, USES)),
        "opens": inventory.opens_to_events(frame(spark, sf, OPENS)),
        "money": players.money_to_events(money),
        "balances": players.balances_to_events(money),
        "groups": _groups(orders),
        "characters": players.characters_to_events(orders.withColumn("is_new", F.col("status") == "F")),
        "staff": staff.staff_to_events(frame(spark, sf, TX)),
        "menu": staff.menu_to_events(frame(spark, sf, MENU)),
        "commands": staff.commands_to_events(frame(spark, sf, COMMANDS)),
        "lifecycle": exports.lifecycle_to_events(frame(spark, sf, LIFECYCLE)),
        "jobs": _jobs(orders),
        "connections": players.connections_to_events(frame(spark, sf, CONNECTIONS)),
        "doors": players.doors_to_events(frame(spark, sf, DOOR_STATES), raw_frame(spark, sf, DOORS)),
        "channels": exports.channels_to_events(frame(spark, sf, EXPORTS)),
        "inventory_export": exports.inventory_export_to_events(frame(spark, sf, EXPORTS)),
    }


# Container opens are off by default.
SWITCHES = {"opens": False}


# A digest that needs no order: the sum over a kind's rows of 60 bits of a hash of all that the row shows.
_TEXTS = ("arrival_seq", *SHOWN, "context", "data")


def _all(spark, sf):
    """Every collector's rows, context and data included, as one digest a kind of event."""
    drafts = exports.all_collectors(all_frames(spark, sf, once=True), SWITCHES)
    rows = drafts.select(
        "kind", "arrival_seq", *SHOWN, canonical_json(F.col("context")).alias("context"), canonical_json(F.col("data")).alias("data"))
    whole = F.concat_ws("|", *[F.coalesce(F.col(name).cast("string"), F.lit("~")) for name in _TEXTS])
    part = F.conv(F.substring(F.md5(whole), 1, 15), 16, 10).cast("decimal(20,0)")
    return rows.groupBy("kind", "category", "action", "severity").agg(
        F.count(F.lit(1)).alias("events"), F.sum(part).cast("string").alias("digest"))


def _kinds(parts: dict[str, str]) -> str:
    union = " UNION ALL ".join(
        f"SELECT '{kind}' AS kind, {', '.join(_TEXTS)} FROM ({text}) AS t{i}" for i, (kind, text) in enumerate(parts.items()))
    whole = ", ".join(f"coalesce(CAST({name} AS VARCHAR), '~')" for name in _TEXTS)
    return (f"SELECT kind, category, action, severity, count(*) AS events, CAST(sum(CAST(CAST('0x' || left(md5(concat_ws('|', {whole})), 15) "
            f"AS BIGINT) AS HUGEINT)) AS VARCHAR) AS digest FROM ({union}) AS u GROUP BY kind, category, action, severity")


GROUPS_SQL = expected(
    ORDERS, category="'player'", action="'group_changed'", resource="'core'",
    actor_ref="CAST(player_id AS VARCHAR)",
    data=sql_object(group=sql_text("priority"), previous="CASE WHEN status = 'F' THEN '\"user\"' END"))
CHARACTERS_SQL = expected(
    ORDERS, category="'player'", resource="'core'", actor_ref="CAST(player_id AS VARCHAR)",
    action="CASE WHEN status = 'F' THEN 'character_created' ELSE 'character_loaded' END")
LIFECYCLE_SQL = expected(
    LIFECYCLE, category="'system'", action="'logger_started'", severity="'notice'", resource="'tidewatch'",
    data=sql_object(loggerVersion=sql_text("logger_version"), schemaVersion="'1'",
                    inventoryAdapter="CASE WHEN inventory_adapter THEN 'true' ELSE 'false' END",
                    frameworkAdapter=sql_text("framework_adapter")))


CONNECTIONS_SQL = expected(
    CONNECTIONS, "event <> 'other'", category="'player'", resource="'core'",
    actor_ref="CAST(player_id AS VARCHAR)",
    action="CASE event WHEN 'joining' THEN 'connect' ELSE 'disconnect' END",
    data="CASE event WHEN 'dropped' THEN '{\"reason\":\"' || reason || '\"}' END")
DOORS_SQL = expected(
    f"SELECT s.*, d.name AS door_name FROM ({DOOR_STATES}) AS s LEFT JOIN ({DOORS}) AS d "
    "ON s.server_id = d.server_id AND s.door_id = d.door_id",
    "player_id IS NOT NULL", category="'property'", resource="'ox_doorlock'",
    actor_ref="CAST(player_id AS VARCHAR)",
    action="CASE WHEN locked THEN 'door_locked' ELSE 'door_unlocked' END",
    data=sql_object(door=sql_text("door_name"), doorId="door_id", item=sql_text("used_item")))
CHANNELS_SQL = expected(
    EXPORTS, f"arrival_seq % 6 > 1 AND {_GOOD_ACTION} AND arrival_seq % 5 <> 1", **_EXPORT_COLUMNS)
INVENTORY_EXPORT_SQL = expected(
    EXPORTS, f"{_GOOD_ACTION} AND arrival_seq % 5 <> 1", category="'inventory'", **_EXPORT_COLUMNS)


def entries() -> dict[str, Query]:
    return {
        "classify_move": Query(
            over(MOVES, lambda df: df.select("arrival_seq", inventory.classify_move(
                *[F.col(c) for c in ("action", "from_type", "to_type", "from_inventory", "to_inventory")]
            ).alias("result"))),
            duck(f"SELECT arrival_seq, {CLASSIFY_SQL} AS result FROM ({MOVES}) AS raw"),
        ),
        "moves_to_events": Query(over(MOVE_HOOKS, lambda df: shown(inventory.moves_to_events(df))), MOVES_SQL),
        "creations_to_events": Query(
            over(CREATIONS, lambda df: shown(inventory.creations_to_events(df, _IGNORED))), CREATIONS_SQL),
        "opens_to_events": Query(over(OPENS, lambda df: shown(inventory.opens_to_events(df))), OPENS_SQL),
        "uses_to_events": Query(over(USES, lambda df: shown(inventory.uses_to_events(df))), USES_SQL),
        "purchases_to_events": Query(
            over(PURCHASES, lambda df: shown(inventory.purchases_to_events(df))), PURCHASES_SQL),
        "crafts_to_events": Query(over(CRAFTS, lambda df: shown(inventory.crafts_to_events(df))), CRAFTS_SQL),
        "money_to_events": Query(over(MONEY, lambda df: shown(players.money_to_events(df))), MONEY_SQL),
        "balances_to_events": Query(over(MONEY, lambda df: shown(players.balances_to_events(df))), BALANCES_SQL),
        "jobs_to_events": Query(over(ORDERS, lambda df: shown(_jobs(df))), JOBS_SQL),
        "groups_to_events": Query(over(ORDERS, lambda df: shown(_groups(df))), GROUPS_SQL),
        "characters_to_events": Query(
            over(ORDERS, lambda df: shown(players.characters_to_events(
                df.withColumn("is_new", F.col("status") == "F")))), CHARACTERS_SQL),
        "connections_to_events": Query(
            over(CONNECTIONS, lambda df: shown(players.connections_to_events(df))), CONNECTIONS_SQL),
        "doors_to_events": Query(
            lambda spark, sf: shown(players.doors_to_events(frame(spark, sf, DOOR_STATES), frame(spark, sf, DOORS))), DOORS_SQL),
        "staff_to_events": Query(over(TX, lambda df: shown(staff.staff_to_events(df))), STAFF_SQL),
        "menu_to_events": Query(over(MENU, lambda df: shown(staff.menu_to_events(df))), MENU_SQL),
        "commands_to_events": Query(over(COMMANDS, lambda df: shown(staff.commands_to_events(df))), COMMANDS_SQL),
        "channels_to_events": Query(over(EXPORTS, lambda df: shown(exports.channels_to_events(df))), CHANNELS_SQL),
        "inventory_export_to_events": Query(
            over(EXPORTS, lambda df: shown(exports.inventory_export_to_events(df))), INVENTORY_EXPORT_SQL),
        "lifecycle_to_events": Query(
            over(LIFECYCLE, lambda df: shown(exports.lifecycle_to_events(df))), LIFECYCLE_SQL),
        "all_collectors": Query(_all, _kinds({
            "move": MOVES_SQL, "creation": CREATIONS_SQL, "purchase": PURCHASES_SQL, "craft": CRAFTS_SQL,
            "use": USES_SQL, "money": f"{MONEY_SQL} UNION ALL {BALANCES_SQL}", "group": GROUPS_SQL,
            "character": CHARACTERS_SQL, "staff": STAFF_SQL, "menu": MENU_SQL, "command": COMMANDS_SQL,
            "lifecycle": LIFECYCLE_SQL, "job": JOBS_SQL, "connection": CONNECTIONS_SQL, "door": DOORS_SQL,
            "channel": CHANNELS_SQL, "inventory": INVENTORY_EXPORT_SQL})),
    }
