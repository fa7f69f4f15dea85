from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidewatch.operators import identity
from tidewatch.operators.canonical import party_json

T0 = datetime(2024, 1, 1)


def at(minutes):
    return T0 + timedelta(minutes=minutes)


@pytest.fixture(scope="module")
def world(spark):
    """Id 6 is Account 6, then leaves and is given to Account 9; id 2 stays."""
    connections = spark.createDataFrame([
        ("s", 6, "joining", at(0), 1, "Account 6", ["license:6", "ip:1.1.1.1", "discord:a", "discord:b"]),
        ("s", 2, "joining", at(0), 2, "Account 2", ["license:2"]),
        ("s", 6, "dropped", at(10), 3, None, None),
        ("s", 6, "joining", at(20), 4, "Account 9", ["license:9"]),
    ], "server_id string, source int, event string, received_at timestamp, arrival_seq long, name string, identifiers array<string>")
    characters = spark.createDataFrame([
        ("s", 6, at(1), 1, "char1:player6", "CJ Jones", "bcso", "user"),
        ("s", 2, at(1), 2, "char1:player2", "Recipient Name", "bcso", "user"),
        ("s", 6, at(10), 3, None, None, None, None),
    ], "server_id string, source int, valid_from timestamp, seq long, identifier string, name string, job string, `group` string")
    inventories = spark.createDataFrame([("s", "15", "char1:player15"), ("s", "16", None)], "server_id string, id string, owner string")
    return identity.session_intervals(connections), characters, inventories


def resolve(spark, world, ref, lookup="party", minute=5, net_id=None, hot_rows=None):
    df = spark.createDataFrame([("s", 1, at(minute), ref, lookup, net_id)],
                               "server_id string, arrival_seq long, received_at timestamp, ref string, lookup string, net string")
    row = identity.resolve_party(df, "ref", "lookup", "p", *world, net_id="net", hot_rows=hot_rows).first().p
    return None if row is None else {k: v for k, v in row.asDict().items() if v is not None}


def test_sessions(world):
    rows = {(r.source, r.joined_at): r.ended_at for r in world[0].collect()}
    assert rows == {(6, at(0)): at(10), (6, at(20)): None, (2, at(0)): None}


@pytest.mark.parametrize("ref,want", [
    ("0", {"name": "Console"}), ('"AdminAccount"', {"name": "AdminAccount"}), ('""', None), (None, None),
    ('"char1:abc"', {"identifier": "char1:abc", "character_id": "char1:abc"}),
    ('"license:xyz"', {"license": "license:xyz"}), ("99", None), ("{}", None),
])
def test_shapes_scripts_pass(spark, world, ref, want):
    assert resolve(spark, world, ref) == want


def test_connected_player_and_recycled_id(spark, world):
    whole = resolve(spark, world, "6")
    assert whole == {"source": 6, "name": "CJ Jones (Account 6)", "identifier": "char1:player6", "character_id": "char1:player6",
                     "license": "license:6", "discord": "discord:b", "job": "bcso", "group": "user"}
    assert resolve(spark, world, '"6"') == whole
    assert resolve(spark, world, "6", minute=15) is None
    assert resolve(spark, world, "6", minute=25) == {"source": 6, "name": "Account 9", "license": "license:9"}


def test_identifier_finds_the_player_while_playing(spark, world):
    assert resolve(spark, world, '"char1:player2"')["name"] == "Recipient Name (Account 2)"
    assert resolve(spark, world, '"char1:player6"', minute=25) == {"identifier": "char1:player6", "character_id": "char1:player6"}


def test_explicit_fields_override(spark, world):
    got = resolve(spark, world, '{"source":2,"name":"Someone","characterId":"c9"}')
    assert (got["name"], got["character_id"], got["license"], got["source"]) == ("Someone", "c9", "license:2", 2)


def test_inventory_owners(spark, world):
    assert resolve(spark, world, "2", "player")["identifier"] == "char1:player2"
    for ref in ("15", '"15"'):
        assert resolve(spark, world, ref, "player") == {"identifier": "char1:player15", "character_id": "char1:player15"}
    assert resolve(spark, world, "16", "player") is None and resolve(spark, world, "99", "player") is None
    assert resolve(spark, world, '"char1:offline"', "player") == {"identifier": "char1:offline", "character_id": "char1:offline"}


def test_staff_target_prefers_the_connected_player(spark, world):
    offline = '{"name":"Offender","license":"license:abc"}'
    assert resolve(spark, world, offline, net_id="2")["name"] == "Recipient Name (Account 2)"
    assert resolve(spark, world, offline, net_id="99") == {"name": "Offender", "license": "license:abc"}


def test_leaving_event_still_belongs_to_the_player(spark, world):
    df = spark.createDataFrame([("s", 6, at(10), 9)], "server_id string, source int, received_at timestamp, arrival_seq long")
    assert identity.attach_session(df, world[0]).first().session is None
    assert identity.attach_session(df, world[0], closing=F.lit(True)).first().session.name == "Account 6"


def test_an_explicit_identity_keeps_all_its_members(spark, world):
    rows = [("s", 1, at(5), '{"name":"Ada","rank":3,"notes":{"a":[1]}}'), ("s", 2, at(5), '{"badge":"7"}'), ("s", 3, at(5), "{}")]
    df = spark.createDataFrame(rows, "server_id string, arrival_seq long, received_at timestamp, ref string").withColumn("lookup", F.lit("party"))
    found = identity.resolve_party(df, "ref", "lookup", "p", *world)
    got = {r.arrival_seq: (r.p, r.j) for r in found.withColumn("j", party_json(F.col("p"))).collect()}
    assert (got[1][0].name, got[1][0].extra) == ("Ada", '{"notes":{"a":[1]},"rank":3}')
    assert got[1][1] == '{"name":"Ada","notes":{"a":[1]},"rank":3}' and got[2][1] == '{"badge":"7"}' and got[3] == (None, None)
