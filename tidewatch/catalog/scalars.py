"""Scalar function queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch import functions as fn
from tidewatch.catalog.base import (
    EVENTS,
    MOVE_HOOKS,
    MOVES,
    Query,
    duck,
    over,
    sql_action,
    sql_number,
    sql_object,
    sql_short,
    sql_text,
    sql_weapon,
)
from tidewatch.functions.records import bound_maps
from tidewatch.functions.text import json_scalar_text
from tidewatch.operators.canonical import canonical_project, event_json
from tidewatch.operators.exports import log_to_events

TITLES = """
SELECT 'part' AS origin, p_partkey AS id, ' [' || upper(p_name) || '] ' AS title FROM $part
UNION ALL SELECT 'order', o_orderkey, o_orderpriority FROM $orders
UNION ALL SELECT 'document', doc_id, text FROM $documents
UNION ALL SELECT 'url', page_id, url FROM $pages
"""

LEVELS = """
SELECT o_orderkey AS id, CASE o_orderkey % 11 WHEN 0 THEN 'Debug' WHEN 1 THEN 'info' WHEN 2 THEN 'NOTICE'
       WHEN 3 THEN 'warning' WHEN 4 THEN 'critical' WHEN 5 THEN 'success' WHEN 6 THEN 'Warn'
       WHEN 7 THEN 'ERROR' WHEN 8 THEN 'danger' WHEN 9 THEN o_orderpriority END AS level
FROM $orders
"""

CENTS = "CAST(round(o_totalprice * 100) AS BIGINT)"
PRICE = f"""
SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority,
       '$' || CAST(CAST(floor({CENTS} / 100000) AS BIGINT) AS STRING) || ','
       || lpad(CAST(CAST(floor({CENTS} / 100) AS BIGINT) % 1000 AS STRING), 3, '0') || '.'
       || lpad(CAST({CENTS} % 100 AS STRING), 2, '0') AS price
FROM $orders
"""
MONEY = f"""
SELECT 'order' AS origin, o_orderkey AS id,
       CASE o_orderkey % 5 WHEN 0 THEN '**' || price || '**' WHEN 1 THEN '`' || price || '`'
            WHEN 2 THEN ',' WHEN 3 THEN '0' || CAST(o_custkey AS STRING) ELSE price || ' each' END AS label
FROM ({PRICE}) AS priced
UNION ALL SELECT 'part', p_partkey, p_name FROM $part
"""

NUMBERS = """
SELECT o_orderkey AS id, CASE o_orderkey % 10 WHEN 0 THEN ' ' || CAST(o_custkey AS STRING) || ' '
       WHEN 1 THEN CAST(o_custkey AS STRING) || '.5' WHEN 2 THEN CAST(o_custkey % 9 AS STRING) || 'e3'
       WHEN 3 THEN '0x1F' WHEN 4 THEN CAST(o_custkey AS STRING) || 'd' WHEN 5 THEN 'NaN'
       WHEN 6 THEN '-.25' WHEN 7 THEN '' WHEN 8 THEN '-' || CAST(o_custkey AS STRING) END AS txt
FROM $orders
"""
SQL_DECIMAL = r"'^[ \t-\r]*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?[ \t-\r]*$'"

FIELD_ROWS = f"""
SELECT o_orderkey AS id, o_custkey, o_orderstatus, o_orderpriority, price,
       CASE WHEN o_orderkey % 3 = 0 THEN '{{"plate":"KEPT"}}' END AS data
FROM ({PRICE}) AS priced
"""

COORDS = """
SELECT vec_id AS id, embedding[0] * 1000.0 AS x FROM $embeddings
"""


def _fields(df):
    def field(name, key, value):
        none = F.lit(None).cast("string")
        return F.struct((F.lit(name) if name else none).alias("name"),
                        (F.lit(key) if key else none).alias("key"), value.alias("value"))

    rank = F.struct(F.col("o_orderpriority").alias("name"), F.lit(None).cast("string").alias("key"),
                    F.col("o_orderstatus").alias("value"))
    fields = F.array(
        field("Total Cost", None, F.concat(F.lit("**"), F.col("price"), F.lit("**"))),
        field("Amount", None, F.col("o_custkey").cast("string")),
        rank,
        field(None, "Plate", F.concat(F.lit("AB "), F.col("o_custkey").cast("string"))),
        field("!!!", None, F.lit("dropped")),
    )
    merged = fn.fields_to_data(fields, fn.json_map(F.col("data")))
    return df.select("id", fn.canonical_json(merged).alias("data"))


FIELDS_SQL = f"""
SELECT id, '{{"amount":' || paid || CASE WHEN rank_key = 'urgent' THEN '' ELSE rank_part END
       || ',"plate":"' || plate || '","total_cost":' || paid
       || CASE WHEN rank_key = 'urgent' THEN rank_part ELSE '' END || '}}' AS data
FROM (SELECT id, {sql_number("replace(replace(price, '$', ''), ',', '')")} AS paid,
             {sql_action("o_orderpriority")} AS rank_key,
             ',"' || {sql_action("o_orderpriority")} || '":"' || o_orderstatus || '"' AS rank_part,
             CASE WHEN data IS NULL THEN 'AB ' || o_custkey ELSE 'KEPT' END AS plate
      FROM ({FIELD_ROWS}) AS field_rows)
"""

BOUNDED = """
SELECT doc_id AS id, text, CAST(n_chars % 100 AS INT) AS extra FROM $documents
"""


def _bounded(df):
    keys = F.transform(F.sequence(F.lit(1), F.col("extra") + 1),
                       lambda i: F.concat(F.lit("k"), F.lpad(i.cast("string"), 3, "0")))
    wide = F.map_from_arrays(
        F.concat(F.array(F.lit("body")), keys),
        F.concat(F.array(fn.text_json(F.col("text"))), F.transform(keys, lambda k: fn.text_json(k))),
    )
    kept = bound_maps(df.select("id", wide.alias("kept")), ["kept"])
    return kept.select(
        "id", F.size("kept").alias("entries"),
        F.array_join(F.array_sort(F.map_keys("kept")), ",").alias("names"),
        F.md5(json_scalar_text(F.element_at("kept", "body"))).alias("body"),
    )


# Eight equal levels of objects within one another: a text, some numbers, and the level below under the last key.
# Of the sixth, at depth 5, the members are at depth 6 and all dropped.
NESTED = "SELECT doc_id AS id, md5(text) AS digest, CAST(n_chars % 80 AS INT) AS extra FROM $documents WHERE text IS NOT NULL"


def _nested(df):
    numbers = F.array_join(F.transform(F.sequence(F.lit(1), F.col("extra") + 1), lambda i: F.concat(
        F.lit(',"k'), F.lpad(i.cast("string"), 3, "0"), F.lit('":'), i.cast("string"))), "")
    level = F.concat(F.lit('{"z":'), F.lit("#"), F.lit(',"a":"'), F.repeat("digest", 70), F.lit('"'), numbers, F.lit("}"))
    whole = F.lit("[null,7]")
    for _ in range(8):
        whole = F.replace(F.col("level"), F.lit("#"), whole)
    # Steps of their own, so that a level and the whole are made once for each row.
    texts = df.select("id", level.alias("level")).select("id", whole.alias("whole"))
    return texts.select("id", F.md5(fn.bounded_copy(F.col("whole"))).alias("bounded"))


NESTED_SQL = f"""
WITH l AS (
  SELECT id, extra, '"a":"' || left(repeat(digest, 70), 2048) || '"'
         || list_aggregate(list_transform(range(1, least(63, extra + 1) + 1), lambda i: ',"k' || lpad(CAST(i AS VARCHAR), 3, '0') || '":' || i),
                           'string_agg', '') AS own FROM ({NESTED}) AS nested)
SELECT id, md5(CASE WHEN extra + 1 >= 63 THEN '{{' || own || '}}'
  ELSE repeat('{{' || own || ',"z":', 5) || '{{}}' || repeat('}}', 5) END) AS bounded FROM l
"""


CANON = f"""
SELECT *, '{{"action":"' || upper(action) || '!","category":"' || category || '"'
       || CASE WHEN channel IS NULL THEN '' ELSE ',"channel":"' || channel || '"' END
       || ',"severity":"' || CASE WHEN action = 'error' THEN 'DANGER' ELSE 'success' END
       || '","context":{{"resource":"forged","zone":"' || CAST(source % 7 AS STRING)
       || '"}},"data":{{"amount":' || CAST(amount AS STRING) || ',"props":' || props || '}}}}' AS payload,
       'script_' || CAST(source % 5 AS STRING) AS invoking_resource
FROM ({EVENTS}) AS raw
"""


def _canonical(df):
    rows = canonical_project(log_to_events(df))
    return rows.select(
        "server_id", "arrival_seq", "event_id", fn.utc_text(F.col("occurred_at")).alias("occurred_at"),
        "channel", "category", "action", "severity",
        fn.canonical_json(F.col("context")).alias("context"),
        fn.canonical_json(F.col("data")).alias("data"),
        F.octet_length(event_json(**{"actor": F.col("actor")})).alias("bytes"),
    )


_CANON_DATA = f"""'{{"amount":' || {sql_number('amount')} || ',"props":{{"k":' || regexp_extract(props, '[0-9]+') || '}}}}'"""
_CANON_CONTEXT = sql_object(resource=sql_text("invoking_resource"), zone=sql_text("source % 7"))
_CANON_ID = "substr(sha256(server_id || '|' || arrival_seq || '|log'), 1, 32)"
CANON_SQL = f"""
SELECT server_id, arrival_seq, event_id, occurred_at, channel, category, action, severity, context, data,
       strlen('{{"action":"' || action || '"' || ',"category":"' || category || '"'
              || coalesce(',"channel":"' || channel || '"', '') || ',"context":' || context
              || ',"data":' || data || ',"eventId":"' || event_id || '","occurredAt":"' || occurred_at
              || '","severity":"' || severity || '"}}') AS bytes
FROM (SELECT server_id, arrival_seq, {_CANON_ID} AS event_id,
             strftime(received_at, '%Y-%m-%dT%H:%M:%SZ') AS occurred_at, channel, category, action,
             CASE WHEN action = 'error' THEN 'warning' ELSE 'info' END AS severity,
             {_CANON_CONTEXT} AS context, {_CANON_DATA} AS data
      FROM ({CANON}) AS canon)
"""


def _fold_key(df):
    parts = [F.col(name) for name in ("category", "action", "source")]
    context = F.create_map(F.lit("coords"), F.col("amount").cast("string"), F.lit("server"), F.col("server_id"))
    data = F.create_map(F.lit("amount"), F.col("amount").cast("string"), F.lit("props"), F.col("props"))
    keyed = df.withColumn("fold_key", fn.fold_key(context, data, parts))
    return keyed.groupBy("fold_key").agg(
        F.min("arrival_seq").alias("first_seq"), F.count(F.lit(1)).alias("events")
    ).select("first_seq", "events")


def entries() -> dict[str, Query]:
    slot = lambda df: df.select(
        "arrival_seq", fn.read_slot(F.col("from_slot")).alias("s")
    ).select("arrival_seq", "s.name", "s.label", fn.number_json(F.col("s.count")).alias("count"),
             fn.number_json(F.col("s.slot")).alias("slot"), "s.metadata")
    bare = "line % 5 = 0"
    return {
        "normalise_action": Query(
            over(TITLES, lambda df: df.select("origin", "id", fn.normalise_action(F.col("title")).alias("action"))),
            duck(f"SELECT origin, id, {sql_action('title')} AS action FROM ({TITLES}) AS titles"),
        ),
        "normalise_severity": Query(
            over(LEVELS, lambda df: df.select("id", fn.normalise_severity(F.col("level")).alias("severity"))),
            duck("SELECT id, CASE id % 11 WHEN 0 THEN 'debug' WHEN 1 THEN 'info' WHEN 2 THEN 'notice' "
                 "WHEN 3 THEN 'warning' WHEN 4 THEN 'critical' WHEN 5 THEN 'info' WHEN 6 THEN 'warning' "
                 f"WHEN 7 THEN 'warning' WHEN 8 THEN 'warning' END AS severity FROM ({LEVELS}) AS levels"),
        ),
        "short_text": Query(
            over("SELECT doc_id AS id, text FROM $documents",
                 lambda df: df.select("id", fn.short_text(F.col("text")).alias("short"))),
            f"SELECT doc_id AS id, {sql_short('text', 128)} AS short FROM documents",
        ),
        "bounded_copy": Query(
            over(BOUNDED, _bounded),
            duck("SELECT id, CAST(least(64, extra + 2) AS INT) AS entries, 'body' || list_aggregate(list_transform("
                 "range(1, least(63, extra + 1) + 1), lambda i: ',k' || lpad(CAST(i AS VARCHAR), 3, '0')), "
                 f"'string_agg', '') AS names, md5({sql_short('text', 2048)}) AS body FROM ({BOUNDED}) AS bounded"),
        ),
        "bounded_copy_nested": Query(over(NESTED, _nested), duck(NESTED_SQL)),
        "fields_to_data": Query(over(FIELD_ROWS, _fields), duck(FIELDS_SQL)),
        "parse_money_text": Query(
            over(MONEY, lambda df: df.select("origin", "id", fn.parse_money_text(F.col("label")).alias("m"))
                 .select("origin", "id", "m.text", F.col("m.number").cast("decimal(18,2)").alias("number"))),
            duck("SELECT origin, id, plain AS text, CASE WHEN regexp_matches(plain, '^\\$?[0-9,]+\\.?[0-9]*$') "
                 "THEN TRY_CAST(regexp_replace(plain, '[$,]', '', 'g') AS DECIMAL(18,2)) END AS number FROM "
                 f"(SELECT origin, id, regexp_replace(label, '[*`]', '', 'g') AS plain FROM ({MONEY}) AS money)"),
        ),
        "lua_number": Query(
            over(NUMBERS, lambda df: df.select("id", fn.lua_number(F.col("txt")).cast("decimal(18,3)").alias("number"))),
            duck(f"SELECT id, CASE WHEN txt = '0x1F' THEN 31 WHEN regexp_matches(txt, {SQL_DECIMAL}) "
                 f"THEN CAST(CAST(trim(txt) AS DOUBLE) AS DECIMAL(18,3)) END AS number FROM ({NUMBERS}) AS numbers"),
        ),
        "weapon_flag": Query(
            over("SELECT p_partkey AS id, CASE p_type WHEN 'PROMO' THEN 'WEAPON_' || p_name WHEN 'SMALL' "
                 "THEN 'ammo-' || p_name ELSE p_name END AS item FROM $part",
                 lambda df: df.select("id", fn.weapon_flag(F.col("item")).alias("weapon"))),
            "SELECT p_partkey AS id, p_type IN ('PROMO', 'SMALL') AS weapon FROM part",
        ),
        "read_slot": Query(
            over(MOVE_HOOKS, slot),
            duck(f"SELECT arrival_seq, CASE WHEN {bare} THEN NULL ELSE item END AS name, "
                 f"CASE WHEN {bare} THEN NULL ELSE label END AS label, "
                 f"CASE WHEN {bare} THEN NULL ELSE CAST(quantity AS VARCHAR) END AS count, "
                 f"CAST(line AS VARCHAR) AS slot, CASE WHEN {bare} THEN NULL ELSE "
                 "'{\"serial\":\"' || part_key || '\"}' END AS metadata "
                 f"FROM ({MOVES}) AS moves"),
        ),
        "fold_key": Query(
            over(EVENTS, _fold_key),
            duck("SELECT min(arrival_seq) AS first_seq, count(*) AS events "
                 f"FROM ({EVENTS}) AS raw GROUP BY source, action, props"),
        ),
        "event_id": Query(
            over(EVENTS, lambda df: df.select("arrival_seq", fn.event_id(
                F.when(F.col("arrival_seq") % 4 == 0, F.concat(F.lit("given-"), F.col("arrival_seq"))),
                F.col("server_id"), F.col("arrival_seq"), F.col("action")).alias("event_id"))),
            duck("SELECT arrival_seq, CASE WHEN arrival_seq % 4 = 0 THEN 'given-' || arrival_seq ELSE "
                 "substr(sha256(server_id || '|' || arrival_seq || '|' || action), 1, 32) END AS event_id "
                 f"FROM ({EVENTS}) AS raw"),
        ),
        "utc_text": Query(
            over(EVENTS, lambda df: df.select("arrival_seq", fn.utc_text(F.col("received_at")).alias("at"))),
            duck(f"SELECT arrival_seq, strftime(received_at, '%Y-%m-%dT%H:%M:%SZ') AS at FROM ({EVENTS}) AS raw"),
        ),
        "plate_of": Query(
            over("SELECT p_partkey AS id, CASE p_partkey % 4 WHEN 0 THEN 'trunkABC' || CAST(p_partkey AS STRING) "
                 "WHEN 1 THEN 'trunk-AB' || CAST(p_size AS STRING) WHEN 2 THEN p_name ELSE 'glove' END AS inv FROM $part",
                 lambda df: df.select("id", fn.plate_of(F.col("inv")).alias("plate"))),
            "SELECT p_partkey AS id, CASE p_partkey % 4 WHEN 0 THEN CAST(p_partkey AS VARCHAR) "
            "WHEN 1 THEN 'AB' || p_size WHEN 2 THEN NULL ELSE 'e' END AS plate FROM part",
        ),
        "round_coords": Query(
            over("SELECT o_orderkey AS id, o_totalprice / 7.0 - 30000.0 AS x FROM $orders",
                 lambda df: df.select("id", fn.round_coords(F.col("x")).alias("x"))),
            "SELECT o_orderkey AS id, floor((o_totalprice / 7.0 - 30000.0) * 100) / 100.0 AS x FROM orders",
        ),
        "job_label": Query(
            over("SELECT c_custkey AS id, c_mktsegment, c_nationkey FROM $customer", lambda df: df.select(
                "id", fn.job_label(F.when(F.col("id") % 5 != 0, F.struct(
                    F.lower("c_mktsegment").alias("name"),
                    F.when(F.col("id") % 2 == 0, F.col("c_mktsegment")).alias("label"),
                    F.col("c_nationkey").alias("grade"),
                    F.when(F.col("id") % 3 == 0, F.lit("Boss")).alias("grade_label"),
                ))).alias("job"))),
            "SELECT c_custkey AS id, CASE WHEN c_custkey % 5 <> 0 THEN CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment "
            "ELSE lower(c_mktsegment) END || ' - ' || CASE WHEN c_custkey % 3 = 0 THEN 'Boss' ELSE "
            "CAST(c_nationkey AS VARCHAR) END END AS job FROM customer",
        ),
        "command_text": Query(
            over("SELECT p_partkey AS id, p_brand, p_name FROM $part", lambda df: df.select(
                "id", fn.command_text(F.col("p_brand"), F.when(F.col("id") % 3 == 0, F.col("p_name"))
                                      .when(F.col("id") % 3 == 1, F.lit(""))).alias("command"))),
            "SELECT p_partkey AS id, '/' || p_brand || CASE WHEN p_partkey % 3 = 0 THEN ' ' || p_name ELSE '' END "
            "AS command FROM part",
        ),
        "canonical_project": Query(over(CANON, _canonical), duck(CANON_SQL)),
    }
