import json

import pytest
from pyspark.sql import functions as F

from tidewatch.functions import canonical_json
from tidewatch.operators import exports, inventory, players, staff, validate
from tidewatch.operators.canonical import canonical_project
from tidewatch.sources.schemas import hook_schema


def raw(spark, hook, **row):
    row = {"server_id": "s", "arrival_seq": 1, "invoking_resource": "some_job", **row}
    lines = spark.createDataFrame([(json.dumps(row),)], "value string")
    return lines.select(F.from_json("value", hook_schema(hook)).alias("r")).select("r.*")


def one(drafts):
    rows = drafts.withColumns({"d": canonical_json(F.col("data")), "c": canonical_json(F.col("context"))}).collect()
    assert len(rows) <= 1
    if not rows:
        return None
    return {**rows[0].asDict(), "data": json.loads(rows[0].d or "{}"), "context": json.loads(rows[0].c or "{}")}


def tx(spark, name, invoking="monitor", **payload):
    return one(staff.staff_to_events(
        raw(spark, "tx_event", invoking_resource=invoking, name=name, payload=json.dumps(payload))))


def test_ban_names_admin_and_offline_player(spark):
    event = tx(spark, "playerBanned", author="StaffMember", reason="RDM", expiration=False, actionId="A1",
               targetName="Offender", targetIds=["license:abc", "discord:123", "ip:1.2.3.4"])
    assert (event["category"], event["action"], event["severity"], event["resource"]) == ("staff", "ban", "notice", "txAdmin")
    assert event["actor_ref"] == '"StaffMember"' and event["data"]["duration"] == "permanent"
    assert json.loads(event["target_ref"]) == {"name": "Offender", "license": "license:abc", "discord": "discord:123"}


def test_forged_staff_events_are_ignored(spark):
    assert tx(spark, "playerBanned", invoking="some_cheat_menu", author="x") is None


def test_only_the_final_minute_of_a_restart(spark):
    assert tx(spark, "scheduledRestart", secondsRemaining=600) is None
    assert tx(spark, "scheduledRestart", secondsRemaining=60)["action"] == "server_restart"
    assert tx(spark, "scheduledRestart")["action"] == "server_restart"


def menu(spark, action, allowed, data=None):
    return one(staff.menu_to_events(raw(spark, "tx_menu", invoking_resource="monitor", player_id=4, action=action,
                                        allowed=allowed, data=data)))


def test_menu(spark):
    event = menu(spark, "spawnVehicle", True, '"adder"')
    assert (event["action"], event["data"]["model"], event["actor_ref"]) == ("vehicle_spawn", "adder", "4")
    event = menu(spark, "setOnFire", True, "4")
    assert (event["action"], event["severity"], event["target_ref"]) == ("command_executed", "notice", "4")
    assert event["data"]["command"] == "txAdmin menu: setOnFire"
    event = menu(spark, "healAll", False)
    assert (event["category"], event["action"]) == ("security", "unauthorized_event")
    assert menu(spark, "announcement", True) is None


@pytest.mark.parametrize("account,reason,resource,action,named", [
    ("black_money", "sale", "vendor", "dirty_added", "vendor"),
    ("bank", "Paycheck", "es_extended", "salary", "es_extended"),
    ("Chips!", "x", None, "chips_added", "some_job"),
])
def test_money(spark, account, reason, resource, action, named):
    event = one(players.money_to_events(raw(spark, "account_money", event="add", player_id=4, account=account,
                                            amount=500, reason=reason, resource=resource)))
    assert (event["action"], event["resource"], event["data"]["amount"]) == (action, named, 500)


def test_resync_is_not_logged(spark):
    def balance(reason):
        return one(players.balances_to_events(raw(spark, "account_money", event="set", player_id=4, account="money",
                                                  amount=980, reason=reason)))
    assert balance("Sync account with item") is None
    assert balance("Government Grant")["action"] == "balance_set"


def test_doors_and_disconnects(spark):
    assert one(players.doors_to_events(raw(spark, "door_state", door_id="3", locked=True))) is None
    event = one(players.doors_to_events(raw(spark, "door_state", player_id=4, door_id="3", locked=False, used_item="lockpick")))
    assert (event["category"], event["action"], event["data"]) == ("property", "door_unlocked", {"doorId": 3, "item": "lockpick"})
    event = one(players.connections_to_events(raw(spark, "connection", event="dropped", player_id=4, reason="Exiting")))
    assert (event["action"], event["data"]) == ("disconnect", {"reason": "Exiting"})


def move(spark, recipient="2", sender="6", to_type="player", success=True, shuffles=False, **more):
    row = {"success": success, "source": "6", "action": "give", "from_inventory": sender, "to_inventory": recipient,
           "from_type": "player", "to_type": to_type, "count": "10000",
           "from_slot": '{"name":"money","label":"Money","slot":23}', **more}
    return one(inventory.moves_to_events(raw(spark, "swap_items", **row), log_shuffles=shuffles))


def test_moves(spark):
    event = move(spark)
    assert (event["action"], event["target_ref"], event["data"]["quantity"]) == ("player_to_player_transfer", "2", 10000)
    assert event["context"]["toInventory"] == {"id": "2", "type": "player"}
    assert move(spark, '"stash_test"', to_type="stash")["target_ref"] is None
    assert move(spark, success=False) is None
    for sender, recipient in (("6", '"6"'), ('"6"', "6"), ('"stash_a"', '"stash_a"')):
        assert move(spark, recipient, sender) is None
    assert move(spark, '"6"', shuffles=True)["target_ref"] is None
    event = move(spark, None, action="move", to_type="newdrop", drop_id="drop-1")
    assert event["action"] == "item_dropped" and event["context"]["toInventory"]["id"] == "drop-1"


def create(spark, by="Sync_DrugsCreator", item="drug_yerkys", success=True, ignored=()):
    return one(inventory.creations_to_events(
        raw(spark, "create_item", success=success, inventory_id="15", resource=by, count="3", item_name=item,
            item_label="Yerkys"), ignored))


def test_creations(spark):
    assert create(spark)["resource"] == "Sync_DrugsCreator"
    assert create(spark, by=None)["resource"] == "ox_inventory"
    assert create(spark, by="es_extended", item="money") is None
    assert create(spark, by="some_job", item="money")["resource"] == "some_job"
    assert create(spark, success=False) is None
    assert create(spark, ignored=["sync_drugscreator"]) is None
    assert create(spark, by="palms", ignored=["sync_drugscreator"]) is not None
    event = create(spark, item="WEAPON_PISTOL", ignored=["sync_drugscreator"])
    assert (event["action"], event["severity"]) == ("weapon_added", "notice")


def command(spark, name, args=None):
    return one(staff.commands_to_events(raw(spark, "export_command", source="0", command=name, args=args)))


def test_commands(spark):
    assert command(spark, "setgroup", '"12 admin"')["action"] == "permission_changed"
    assert command(spark, "setgroup", '"12 admin"')["data"]["command"] == "/setgroup 12 admin"
    assert command(spark, "clearinv", '["7"]')["data"]["command"] == "/clearinv 7"
    assert command(spark, "clearinv")["action"] == "command_executed"
    assert command(spark, "") is None


@pytest.mark.parametrize("record,reason", [
    ('{"category":"inventory","action":"test","context":"invalid"}', "bad_context"),
    ('{"category":"inventory","action":"test","data":false}', "bad_data"),
    ('"text"', "not_a_table"), ("42", "not_a_table"),
    ('{"category":"inventory","action":"test","channel":false}', "bad_channel"),
    ('{"channel":"","action":"test"}', "bad_channel"), ('{"category":"system"}', "missing_action"),
    ('{"action":"orphan"}', "no_destination"), ('{"category":"not_a_category","action":"test"}', "unknown_category"),
    ('{"channel":"drugs.sales","action":"sold"}', None), ('{"category":"vehicle","action":"x","fields":[]}', None),
])
def test_validation(spark, record, reason):
    df = spark.createDataFrame([(record,)], "payload string")
    assert validate.validate_event(df).first().reason == reason


def test_channel_export_overrides_and_keeps_context(spark):
    drafts = exports.channels_to_events(raw(
        spark, "export_channel", channel='"custom.events"', action='"New Vehicle Purchase"',
        payload='{"context":{"custom":"kept","resource":"forged","deep":{"a":[1,{"b":2}]}},"data":{"quantity":1},"category":"zzz"}'))
    row = canonical_project(drafts).first()
    assert (row.channel, row.action) == ("custom.events", "new_vehicle_purchase")
    assert row.context == {"custom": '"kept"', "resource": '"some_job"', "deep": '{"a":[1,{"b":2}]}'}
    assert row.data == {"quantity": "1"} and len(row.event_id) == 32


def test_switched_off_collectors_never_enter_the_plan(spark):
    groups = raw(spark, "set_group", player_id=1, group="admin")
    frames = {"groups": players.groups_to_events(groups), "loads": players.characters_to_events(raw(spark, "player_loaded", player_id=1))}
    assert [r.kind for r in exports.all_collectors(frames, {"loads": False}).collect()] == ["group"]


def test_payloads_are_parsed_once_to_be_checked_and_taken(spark):
    rows = spark.sql("""SELECT 's' AS server_id, id AS arrival_seq, TIMESTAMP '2024-01-01' AS received_at, 'r' AS invoking_resource,
        CASE id WHEN 0 THEN '{"action":"a","category":"money","data":{"n":1}}' WHEN 1 THEN '{"action":"a"}' WHEN 2 THEN 'x'
        WHEN 3 THEN '{}' WHEN 4 THEN NULL ELSE '{"action":"b","category":"money"}' END AS payload FROM range(7)""")
    drafts = exports.log_to_events(rows)
    assert sorted((row.arrival_seq, row.action) for row in drafts.collect()) == [(0, "a"), (5, "b"), (6, "b")]
    plan = drafts._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.splitlines() if "Filter" in line.split("(")[0] and "parsejson" in line.lower().replace("_", "")], plan
