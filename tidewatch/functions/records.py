"""JSON-shaped values: bounded copies, webhook fields, slots, fold keys and event ids.

A JSON object travels as MAP<STRING, STRING> whose values are JSON text, so `1`, `1.5` and `"1"`
stay distinct while single keys are cheap to read, add and drop.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch import fixed
from tidewatch.functions.text import (
    cut_bytes,
    json_scalar_text,
    let,
    lua_number,
    money_json,
    normalise_action,
    short_text,
    text_json,
)

TEXT_MAP = "map<string,string>"
FIELDS = "array<struct<name:string,key:string,value:string>>"


def json_map(text: Column) -> Column:
    """Top level of a JSON object, or of an array by position, as key -> JSON text.

    NULL for anything else; members that are JSON null are absent.
    """
    def top_level(parsed: Column) -> Column:
        members = F.transform_values(
            F.try_variant_get(parsed, "$", "map<string,variant>"), lambda _, value: F.to_json(value))
        items = F.map_from_entries(F.transform(
            F.try_variant_get(parsed, "$", "array<variant>"),
            lambda value, at: F.struct((at + 1).cast("string").alias("key"),
                                       F.to_json(value).alias("value")),
        ))
        return F.map_filter(
            F.coalesce(members, items), lambda _, value: value.isNotNull() & (value != "null")
        )

    return let(F.try_parse_json(text), top_level)


def json_object(**members: Column) -> Column:
    """Map of the members that are not NULL; the values are JSON text.

    Put together from arrays of one entry or none: a filter with a lambda would have Spark interpret the members, too.
    """
    if not members:
        return F.create_map().cast(TEXT_MAP)
    texts = {name: value.cast("string") for name, value in members.items()}
    return F.map_from_entries(F.concat(*[
        F.array_repeat(F.struct(F.lit(name).alias("key"), text.alias("value")), text.isNotNull().cast("int"))
        for name, text in texts.items()]))


def object_text(**members: Column) -> Column:
    """JSON text of an object whose keys are known: sorted here, so no map is built per row."""
    parts = [F.concat(F.lit(f'"{name}":'), members[name].cast("string")) for name in sorted(members)]
    return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))


def sorted_entries(values: Column) -> Column:
    return F.sort_array(F.map_entries(values))


def canonical_json(values: Column) -> Column:
    """JSON object text with keys in order; NULL for a NULL map.

    The size names the map a second time: a map that is computed then stays a step of its own, in compiled
    code, where Spark would else move it into the lambda's interpreted one.
    """
    parts = F.transform(
        sorted_entries(values),
        lambda entry: F.concat(text_json(entry["key"]), F.lit(":"), entry["value"]),
    )
    return F.when(
        F.size(values) >= 0, F.concat(F.lit("{"), F.array_join(parts, ","), F.lit("}"))
    )


def _bounded_value(value: Column) -> Column:
    # JSON text is never shorter than the string it stands for, so most values are done here.
    maybe_long = value.startswith('"') & (F.octet_length(value) > fixed.MAX_STRING_BYTES + 2)
    cut = let(json_scalar_text(value), lambda text: text_json(cut_bytes(text, fixed.MAX_STRING_BYTES)))
    return F.when(maybe_long, cut).otherwise(value)


def bounded_map(values: Column, max_keys: int = fixed.MAX_KEYS) -> Column:
    """First `max_keys` entries by key, long strings cut; nested values are left as they are."""
    kept = F.slice(sorted_entries(values), 1, max_keys)
    return F.transform_values(F.map_from_entries(kept), lambda _, value: _bounded_value(value))


def bounded_json(values: Column, max_keys: int = fixed.MAX_KEYS) -> Column:
    """`canonical_json(bounded_map(values))` without a map in between."""
    parts = F.transform(
        F.slice(sorted_entries(values), 1, max_keys),
        lambda entry: F.concat(text_json(entry["key"]), F.lit(":"), _bounded_value(entry["value"])),
    )
    return F.when(
        F.size(values) >= 0, F.concat(F.lit("{"), F.array_join(parts, ","), F.lit("}"))
    )


def _bounded_variant(value: Column, max_keys: int, depth: int) -> Column:
    """JSON text of a variant at a depth, NULL if it is dropped. One expression a level, for objects and
    arrays alike: both become entries, an array's without a key.

    Lambdas are interpreted, so what counts is how little is evaluated for a number or a short string: its JSON text.
    """
    if depth >= fixed.MAX_DEPTH:
        return F.lit(None).cast("string")

    def entries(members: Column, items: Column) -> Column:
        # Members mostly come in the order of their keys; looking each key up costs the square of their number.
        of_object = let(F.map_keys(members), lambda keys: let(F.sort_array(keys), lambda ordered: F.when(
            keys == ordered, F.map_entries(members)).otherwise(F.transform(ordered, lambda key: F.struct(
                key.alias("key"), F.element_at(members, key).alias("value"))))))
        of_array = F.transform(items, lambda item: F.struct(F.lit(None).cast("string").alias("key"), item.alias("value")))
        return F.coalesce(of_object, of_array)

    def bounded(members: Column, items: Column) -> Column:
        texts = F.transform(entries(members, items), lambda entry: F.concat(
            F.coalesce(F.concat(text_json(entry["key"]), F.lit(":")), F.lit("")), _bounded_variant(entry["value"], max_keys, depth + 1)))
        # Dropped values are no text and do not count among those kept.
        kept = F.array_join(F.slice(F.filter(texts, lambda text: text.isNotNull()), 1, max_keys), ",")
        return F.concat(F.when(members.isNotNull(), "{").otherwise("["), kept, F.when(members.isNotNull(), "}").otherwise("]"))

    def scalar(text: Column) -> Column:
        # JSON text is never shorter than the string it stands for.
        maybe_long = text.startswith('"') & ((F.octet_length(text) > fixed.MAX_STRING_BYTES + 2) | text.contains("\\"))
        cut = text_json(cut_bytes(F.try_variant_get(value, "$", "string"), fixed.MAX_STRING_BYTES))
        return F.when(maybe_long, cut).when(text != "null", text)

    return let(F.try_variant_get(value, "$", "map<string,variant>"), lambda members: let(
        F.try_variant_get(value, "$", "array<variant>"), lambda items: F.when(
            members.isNotNull() | items.isNotNull(), bounded(members, items)).otherwise(let(F.to_json(value), scalar))))


def bounded_copy(text: Column, max_keys: int = fixed.MAX_KEYS, depth: int = 0) -> Column:
    """JSON bounded by depth, entries per level and string bytes, keys sorted at every level.

    The levels are few and fixed, so they are written out as one expression over variants. Text that is no
    JSON is NULL.

    The length names the text a second time: a text that is computed then stays a step of its own, in compiled
    code, where Spark would else move it into the interpreted levels.
    """
    return F.when(F.octet_length(text) >= 0, let(F.try_parse_json(text), lambda value: _bounded_variant(value, max_keys, depth)))


def bound_maps(df: DataFrame, names: Sequence[str], max_keys: int = fixed.MAX_KEYS,
               deep: bool = True) -> DataFrame:
    """`df` with the named maps bounded, at every depth if `deep`.

    Only maps holding a nested value are taken apart; of the rest the values are cut as they are.
    """
    if not deep:
        return df.withColumns({name: bounded_map(F.col(name), max_keys) for name in names})
    columns = df.columns
    for name in names:
        nested = F.exists(F.map_values(name), lambda v: v.startswith("{") | v.startswith("["))
        df = df.withColumn(f"_nested_{name}", F.when(nested, canonical_json(F.col(name))))
    df = df.withColumns({f"_deep_{name}": bounded_copy(F.col(f"_nested_{name}"), max_keys)
                         for name in names})
    bounded = {
        name: F.when(F.col(f"_nested_{name}").isNotNull(), json_map(F.col(f"_deep_{name}")))
        .otherwise(bounded_map(F.col(name), max_keys))
        for name in names
    }
    return df.select(*[bounded[name].alias(name) if name in bounded else name for name in columns])


def first_entries(entries: Column) -> Column:
    """Map of key/value structs in which the first entry of a key wins."""
    def firsts(rows: Column, keys: Column) -> Column:
        return F.filter(rows, lambda entry, at: F.array_position(keys, entry["key"]) == at + 1)

    return let(entries, lambda rows: F.map_from_entries(let(
        F.transform(rows, lambda entry: entry["key"]), lambda keys: firsts(rows, keys))))


def merge_maps(base: Column, extra: Column) -> Column:
    """Keys of `extra` added to `base` where `base` has none."""
    empty = F.create_map().cast(TEXT_MAP)
    return let(F.coalesce(base, empty), lambda known: F.map_concat(known, F.map_filter(
        F.coalesce(extra, empty), lambda key, _: ~F.map_contains_key(known, key))))


def fields_to_data(fields: Column, data: Column) -> Column:
    """Webhook fields flattened into data: explicit data first, then earlier fields."""
    aliases = F.create_map(*[F.lit(p) for pair in fixed.FIELD_ALIASES.items() for p in pair])

    def assigned(key: Column, value: Column) -> Column:
        return F.array(
            F.struct(key.alias("key"), value.alias("value")),
            F.struct(F.element_at(aliases, key).alias("key"), value.alias("value")),
        )

    def assignments(field: Column) -> Column:
        return let(normalise_action(F.coalesce(field["name"], field["key"])),
                   lambda key: let(money_json(field["value"]), lambda value: assigned(key, value)))

    entries = F.filter(
        F.flatten(F.transform(fields, assignments)),
        lambda entry: entry["key"].isNotNull() & entry["value"].isNotNull(),
    )
    return F.when(fields.isNull(), data).otherwise(merge_maps(data, first_entries(entries)))


SLOT_SCHEMA = "struct<name:string,label:string,count:string,slot:string,metadata:string>"


def read_slot(slot: Column, include_metadata: bool = True,
              max_keys: int = fixed.MAX_METADATA_KEYS) -> Column:
    """struct(name, label, count, slot, metadata) of a slot object or a bare slot number."""
    def fields(parsed: Column) -> Column:
        metadata = F.lit(None).cast("string")
        if include_metadata and max_keys > 0:
            metadata = F.when(parsed["metadata"].isNotNull(), let(
                json_map(parsed["metadata"]), lambda known: F.when(F.size(known) > 0, bounded_json(known, max_keys))))
        return F.struct(
            short_text(parsed["name"], 64).alias("name"),
            short_text(parsed["label"], 64).alias("label"),
            lua_number(parsed["count"]).alias("count"),
            F.coalesce(lua_number(parsed["slot"]), lua_number(json_scalar_text(slot))).alias("slot"),
            metadata.alias("metadata"),
        )

    return let(F.from_json(F.when(F.ltrim(slot).startswith("{"), slot), SLOT_SCHEMA), fields)


def metadata_json(metadata: Column, max_keys: int = fixed.MAX_METADATA_KEYS) -> Column:
    """Metadata object of a creation or purchase, bounded; nothing when keys are turned off."""
    if max_keys <= 0:
        return F.lit(None).cast("string")
    return let(json_map(metadata), lambda known: bounded_json(known, max_keys))


SUMMED = ("amount", "count", "quantity")
UNKEYED_DATA = SUMMED + ("slot", "toSlot")
KEYED_COLUMNS = ("channel", "category", "action", "severity", "actor", "target",
                 "correlation_id", "session_id", "entity_id")


def fold_key(context: Column, data: Column, columns: Sequence[Column] | None = None) -> Column:
    """Digest shared by repeats of the same event.

    Amounts, counts, slots, coordinates, ids and times stay out of it. Named JSON members keep
    the parts apart, so no two different events can run together into one key.
    """
    keyed_context = F.map_filter(context, lambda key, _: key != "coords")
    keyed_data = F.map_filter(data, lambda key, _: ~key.isin(*UNKEYED_DATA))
    parts = list(columns) if columns is not None else [F.col(name) for name in KEYED_COLUMNS]
    return F.sha2(
        F.to_json(F.struct(
            *parts,
            canonical_json(keyed_context).alias("context"),
            canonical_json(keyed_data).alias("data"),
        )),
        256,
    )


def event_id(given: Column, server_id: Column, arrival_seq: Column, kind: Column) -> Column:
    """The caller's id, else 32 hex characters that a replay of the same record yields again."""
    derived = F.substring(
        F.sha2(F.concat_ws("|", server_id, arrival_seq.cast("string"), kind), 256), 1, 32
    )
    return F.coalesce(given, derived)
