"""Who was it: sessions, characters and owners as of the moment of each event."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch import fixed
from tidewatch.functions.records import canonical_json, json_map
from tidewatch.functions.text import NUMBER, json_scalar_text, lua_number, short_text
from tidewatch.plans.asof import State, as_of, spread_nulls
from tidewatch.plans.keys import join_on
from tidewatch.plans.ordered import HOT_ROWS, arrange

PARTY_TEXT = ("name", "character_id", "identifier", "license", "license2", "discord", "steam",
              "fivem", "job", "group")
# What an explicit identity has beside these, as the text of a JSON object, is its `extra`.
PARTY = "struct<source:int," + ",".join(f"{name}:string" for name in (*PARTY_TEXT, "extra")) + ">"


def party(**fields: Column) -> Column:
    """Party struct; fields not given are NULL."""
    return F.struct(
        fields.get("source", F.lit(None)).cast("int").alias("source"),
        *[fields.get(name, F.lit(None)).cast("string").alias(name) for name in (*PARTY_TEXT, "extra")],
    )


def pivot_identifiers(identifiers: Column) -> Column:
    """Identifier list as struct(license, license2, discord, steam, fivem); the last of a kind wins."""

    def last_of(kind: str) -> Column:
        found = F.filter(identifiers, lambda one: one.startswith(kind + ":"))
        return F.try_element_at(found, F.lit(-1))

    return F.struct(*[last_of(kind).alias(kind) for kind in fixed.IDENTIFIER_KINDS])


def session_intervals(connections: DataFrame, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Sessions [joined_at, ended_at) of recycled server ids.

    `connections` has server_id, source, event (joining or dropped), received_at, arrival_seq,
    name and identifiers.
    A join ends whatever was open under the id; a session without a later record is still open.
    """
    kept = connections.filter(F.col("event").isin("joining", "dropped"))
    rows = arrange(kept, ["server_id", "source"], ["received_at", "arrival_seq"], hot_rows)
    return rows.following(F.col("received_at"), "ended_at").df.filter(F.col("event") == "joining").select(
        "server_id", "source", "name", "identifiers", F.col("received_at").alias("joined_at"),
        F.col("arrival_seq").alias("joined_seq"), "ended_at",
    )


def _session_state(sessions: DataFrame, name: str) -> State:
    value = F.struct("name", "identifiers", "joined_at", "ended_at")
    seq = "joined_seq" if "joined_seq" in sessions.columns else None
    return State(sessions, ["server_id", "source"], "joined_at", value, name, seq)


def _character_state(characters: DataFrame, name: str) -> State:
    value = F.struct("identifier", "name", "job", "group")
    seq = "seq" if "seq" in characters.columns else None
    return State(characters, ["server_id", "source"], "valid_from", value, name, seq)


def _open_at(session: Column, at: Column, closing: Column | None) -> Column:
    """The session if it is still open at the time; rows that close it still belong to it."""
    is_open = session["ended_at"].isNull() | (at < session["ended_at"])
    if closing is not None:
        is_open = is_open | (closing & (at == session["ended_at"]))
    return F.when(is_open, session)


def attach_session(events: DataFrame, sessions: DataFrame, source: str = "source",
                   at: str = "received_at", seq: str = "arrival_seq",
                   closing: Column | None = None,
                   hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Add `session`, the session open under the event's server id when it arrived."""
    state = _session_state(sessions, "session")
    found = as_of(events, ["server_id", source], at, seq, [state], hot_rows)
    return found.withColumn("session", _open_at(F.col("session"), F.col(at), closing))


def attach_character(events: DataFrame, characters: DataFrame, source: str = "source",
                     at: str = "received_at", seq: str = "arrival_seq",
                     hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Add `character`, the latest character state; a state without identifier is a reset."""
    state = _character_state(characters, "character")
    found = as_of(events, ["server_id", source], at, seq, [state], hot_rows)
    playing = F.when(F.col("character.identifier").isNotNull(), F.col("character"))
    return found.withColumn("character", playing)


def source_by_identifier(events: DataFrame, characters: DataFrame, identifier: str = "identifier",
                         at: str = "received_at", seq: str = "arrival_seq",
                         name: str = "source_of", hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Add the server id last seen playing the character, whether or not it still does."""
    played = characters.filter(F.col("identifier").isNotNull())
    order = "seq" if "seq" in characters.columns else None
    state = State(played, ["server_id", "identifier"], "valid_from", F.struct("source"), name, order)
    found = as_of(events, ["server_id", identifier], at, seq, [state], hot_rows)
    return found.withColumn(name, F.col(f"{name}.source"))


def player_party(source: Column, session: Column, character: Column) -> Column:
    """Party of a connected player with the current character merged in; NULL if not connected."""
    account = session["name"]
    ids = pivot_identifiers(session["identifiers"])
    playing = character["identifier"].isNotNull()
    role = F.when(playing, F.coalesce(character["name"], account))
    name = (
        F.when(role.isNotNull() & account.isNotNull() & (role != account),
               F.concat(role, F.lit(" ("), account, F.lit(")")))
        .otherwise(F.coalesce(role, account))
    )
    whole = party(
        source=source, name=name, identifier=character["identifier"],
        character_id=character["identifier"],
        job=F.when(playing, character["job"]), group=F.when(playing, character["group"]),
        **{kind: ids[kind] for kind in fixed.IDENTIFIER_KINDS},
    )
    return F.when(session.isNotNull(), whole)


def owner_fallback(events: DataFrame, inventories: DataFrame, inventory_id: str,
                   seq: str = "arrival_seq", name: str = "owner") -> DataFrame:
    """Add the persistent owner of a numeric inventory id; text ids are owners themselves."""
    number = lua_number(F.col(inventory_id))
    looked_up = F.when(number.isNotNull(), number.cast("bigint").cast("string"))
    owners = inventories.filter(F.col("owner").isNotNull()).select(
        F.col("server_id").alias("_owner_server"),
        F.concat(F.lit("key:"), F.col("id").cast("string")).alias("_owner_id"),
        short_text(F.col("owner"), 64).alias("_owner_found"),
    ).dropDuplicates(["_owner_server", "_owner_id"])
    probed = events.withColumn("_owner_key", spread_nulls(looked_up, F.col(seq)))
    joined = probed.join(
        owners,
        (F.col("server_id") == F.col("_owner_server")) & (F.col("_owner_key") == F.col("_owner_id")),
        "left",
    )
    text_owner = F.nullif(F.col(inventory_id).cast("string"), F.lit(""))
    return joined.withColumn(
        name, F.when(number.isNotNull(), F.col("_owner_found")).otherwise(text_owner)
    ).drop("_owner_key", "_owner_server", "_owner_id", "_owner_found")


@dataclass(frozen=True)
class Reference:
    """A JSON reference in column `ref`, read by the rules of column `lookup` ('party' or 'player'), that
    becomes the party `name`; `net_id` is a column with a server id that goes first."""

    ref: str
    lookup: str
    name: str
    net_id: str | None = None


def resolve_party(events: DataFrame, ref: str, lookup: str, name: str, sessions: DataFrame,
                  characters: DataFrame, inventories: DataFrame | None = None,
                  net_id: str | None = None, at: str = "received_at", seq: str = "arrival_seq",
                  closing: Column | None = None, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Add party `name` behind the JSON reference `ref`: a server id, an identifier, a name or an
    explicit identity, read by the rules of `lookup` ('party' or 'player')."""
    return resolve_parties(events, [Reference(ref, lookup, name, net_id)], sessions, characters, inventories, at, closing, hot_rows)


def resolve_parties(events: DataFrame, references: Sequence[Reference], sessions: DataFrame, characters: DataFrame,
                    inventories: DataFrame | None = None, at: str = "received_at", closing: Column | None = None,
                    hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Add the parties behind several references of each event in one pass over them all.

    A party depends on the reference, the server and the moment alone. So the distinct combinations of
    these are resolved, as narrow rows with the references below one another, and joined back to the
    events, which are moved once. Events with the same references at the same moment are resolved once.
    """
    given = [name for one in references for name in (one.ref, one.lookup, one.net_id) if name]
    inputs = list(dict.fromkeys(["server_id", at, *given]))
    marked = events.withColumn("_closing", F.lit(False) if closing is None else F.coalesce(closing, F.lit(False)))
    keys = [*inputs, "_closing"]
    asked = marked.select(*keys).distinct()
    each = asked.select(*keys, F.explode(F.array(*[
        F.struct(F.lit(i).alias("_which"), F.col(one.ref).cast("string").alias("_ref"), F.col(one.lookup).alias("_lookup"),
                 (F.col(one.net_id).cast("string") if one.net_id else F.lit(None).cast("string")).alias("_net"))
        for i, one in enumerate(references)])).alias("_one")).select(*keys, "_one.*")
    # Nothing to look up: no party.
    each = each.filter(F.col("_ref").isNotNull() | F.col("_net").isNotNull())
    found = _resolved(each, sessions, characters, inventories, at, hot_rows)
    answers = found.groupBy(*keys).agg(*[
        F.first(F.when(F.col("_which") == i, F.col("_party")), ignorenulls=True).alias(one.name)
        for i, one in enumerate(references)])
    names = [one.name for one in references]
    kept = [c for c in events.columns if c not in names]
    return join_on(marked.select(*kept, "_closing"), answers, keys, "left").select(*kept, *names)


def _resolved(rows: DataFrame, sessions: DataFrame, characters: DataFrame, inventories: DataFrame | None, at: str,
              hot_rows: int | None) -> DataFrame:
    """Rows with `_party` behind `_ref`, `_lookup` and `_net`.

    One as-of pass finds who plays a named character, over the rows that name one; another finds session
    and character of every server id; references that need neither ride along in groups of their own.
    """
    columns = rows.columns
    is_object = F.col("_ref").startswith("{")
    rows = rows.withColumns({
        "_text": F.when(~is_object, json_scalar_text(F.col("_ref"))),
        "_members": json_map(F.when(is_object, F.col("_ref"))),
        "_preferred": lua_number(F.col("_net")),
        "_tie": F.xxhash64("_ref", "_which", at),
    })
    rows = rows.withColumns({
        "_number": lua_number(F.col("_text")),
        "_given": lua_number(json_scalar_text(F.element_at("_members", "source"))),
    })
    by_player = F.col("_lookup") == "player"
    coded = F.coalesce(F.col("_number").isNull() & ~by_player & F.col("_text").contains(":"), F.lit(False))
    rows = rows.withColumn("_coded", F.when(coded, F.col("_text")))
    named_rows = source_by_identifier(rows.filter(coded), characters, "_coded", at, "_tie", "_played", hot_rows)
    other_rows = rows.filter(~coded).withColumn("_played", F.lit(None).cast(named_rows.schema["_played"].dataType))
    rows = named_rows.unionByName(other_rows)

    source = F.coalesce("_preferred", "_number", "_given", F.col("_played").cast("bigint"))
    rows = rows.withColumn("_source", F.when(source > 0, source.cast("int")))
    states = [_session_state(sessions, "_session"), _character_state(characters, "_character")]
    rows = as_of(rows, ["server_id", "_source"], at, "_tie", states, hot_rows)
    rows = rows.withColumn("_session", _open_at(F.col("_session"), F.col(at), F.col("_closing")))
    rows = rows.withColumn(
        "_online", player_party(F.col("_source"), F.col("_session"), F.col("_character"))
    )
    offline = F.col("_online").isNull()
    if inventories is not None:
        rows = rows.withColumn("_inventory", F.when(by_player & offline, F.col("_text")))
        rows = owner_fallback(rows, inventories, "_inventory", "_tie", "_owner")
    else:
        named = F.when(F.col("_number").isNull(), F.nullif(F.col("_text"), F.lit("")))
        rows = rows.withColumn("_owner", named)

    # First what kind of party it is, then its fields: every field is one short CASE on the kind.
    playing = F.col("_coded").eqNullSafe(F.col("_online.identifier"))
    kind = (
        F.when(F.col("_preferred").isNotNull() & ~offline, "online")
        .when(F.col("_members").isNotNull(), "explicit")
        .when(by_player & (F.col("_number") > 0) & ~offline, "online")
        .when(by_player, F.when(F.col("_owner").isNotNull(), "owner"))
        .when(F.col("_number") == 0, "console")
        .when(F.col("_number").isNotNull(), F.when(~offline, "online"))
        .when(F.col("_text") == "", F.lit(None))
        .when(F.col("_coded").isNull(), F.when(F.col("_text").isNotNull(), "name"))
        .when(playing & ~offline, "online")
        .when(F.col("_text").startswith("license:"), "license")
        .otherwise("character")
    )
    rows = rows.withColumns({"_kind": kind, "_fields": _explicit_fields(), "_extra": _explicit_extra(), "_short": short_text(F.col("_text"))})
    return rows.select(*columns, _party_of_kind().alias("_party"))


#: Fields of an explicit identity that go by another name there.
EXPLICIT_KEYS = {"character_id": "characterId"}


def _explicit_extra() -> Column:
    """Members of an explicit identity that are no field of a party, as JSON; NULL if there are none."""
    known = ["source", *[EXPLICIT_KEYS.get(name, name) for name in PARTY_TEXT]]
    return F.nullif(canonical_json(F.map_filter("_members", lambda key, _: ~key.isin(*known))), F.lit("{}"))


def _explicit_fields() -> Column:
    """Texts of an explicit party in field order: its own, else those of the player it names."""
    keys = EXPLICIT_KEYS
    texts = F.array(*[
        F.coalesce(
            json_scalar_text(F.element_at("_members", keys.get(name, name))),
            F.when(F.col("_given").isNotNull(), F.col(f"_online.{name}")),
        ) for name in PARTY_TEXT
    ])
    return F.when(F.col("_members").isNotNull(), F.transform(texts, lambda text: short_text(text)))


def _party_of_kind() -> Column:
    kind = F.col("_kind")
    fields = {"source": F.when(kind == "online", F.col("_online.source")).when(
        kind == "explicit", F.coalesce(F.col("_given").cast("int"), F.col("_online.source")))}
    for i, name in enumerate(PARTY_TEXT):
        value = F.when(kind == "online", F.col(f"_online.{name}")).when(
            kind == "explicit", F.col("_fields")[i])
        if name == "name":
            value = value.when(kind == "console", "Console").when(kind == "name", F.col("_short"))
        elif name == "license":
            value = value.when(kind == "license", F.col("_short"))
        elif name in ("identifier", "character_id"):
            value = value.when(kind == "owner", F.col("_owner")).when(kind == "character", F.col("_short"))
        fields[name] = value
    fields["extra"] = F.when(kind == "explicit", F.col("_extra"))
    bare = F.col("_given").isNull() & F.forall("_fields", lambda text: text.isNull()) & F.col("_extra").isNull()
    absent = kind.isNull() | ((kind == "explicit") & bare)
    return F.when(~absent, party(**fields))
