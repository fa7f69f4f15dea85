"""Helpers of the query catalogue: raw records out of the given tables, and SQL text for both sides.

Raw record views are SQL that Spark and DuckDB both read; `$name` stands for a table. The rules
themselves are written twice, once with the operators and once as plain SQL, and compared.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.session import configure, ensure_checkpoint_dir

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")
_NAME = re.compile(r"\$(" + "|".join(TABLES) + r")\b")


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


def duck(text: str) -> str:
    """The text with table names DuckDB knows."""
    return _NAME.sub(r"\1", text)


def frame(spark: SparkSession, sf: str, text: str) -> DataFrame:
    """The text run by Spark over the parquet files of a folder."""
    configure(spark)
    return spark.sql(_NAME.sub(lambda m: f"parquet.`{sf}/{m.group(1)}.parquet`", text))


#: A table of so many bytes for each core, or in all, has row groups enough for every core.
BYTES_OF_CORE, LARGE_BYTES = 32 << 20, 256 << 20


def spread(df: DataFrame, large: int | None = None) -> DataFrame:
    """The rows over all cores when the files behind them are fewer than those.

    The given tables are one file of one row group each, which is one task; a table of many files
    is left as it is, and with `large` one that has as many bytes.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if len(df.inputFiles()) >= cores or large is not None and _read_bytes(df) >= large:
        return df
    # By a row's number: hashing needs no sort, which round-robin does to be repeatable.
    return df.repartition(cores, next((c for c in ("arrival_seq", "id") if c in df.columns), df.columns[0]))


def _read_bytes(df: DataFrame) -> int:
    """The size of the largest table behind the rows."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return max(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def over(text: str, build: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """Query that applies an operator to one raw view."""
    return lambda spark, sf: build(spread(frame(spark, sf, text)))


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder every executor can reach, for queries that read files written from the given tables."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stamp(at: Column) -> Column:
    return F.date_format(at, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def sql_stamp(at: str) -> str:
    return f"strftime({at}, '%Y-%m-%d %H:%M:%S.%f')"


def sql_object(**members: str) -> str:
    """SQL for a JSON object with sorted keys whose member expressions are JSON text or NULL."""
    parts = ", ".join(
        f"CASE WHEN ({value}) IS NOT NULL THEN '\"{name}\":' || ({value}) END"
        for name, value in sorted(members.items())
    )
    return f"('{{' || concat_ws(',', {parts}) || '}}')"


def sql_text(value: str) -> str:
    """SQL for a JSON string of text without characters that need escaping."""
    return f"('\"' || ({value}) || '\"')"


def sql_number(value: str) -> str:
    """SQL for a JSON number without trailing zeros."""
    return f"regexp_replace(CAST(CAST(({value}) AS DECIMAL(28,6)) AS VARCHAR), '\\.?0+$', '')"


def sql_weapon(item: str) -> str:
    return f"coalesce(lower({item}) LIKE 'weapon\\_%' ESCAPE '\\' OR lower({item}) LIKE 'ammo-%', false)"


def sql_action(title: str) -> str:
    return (
        "nullif(left(regexp_replace(regexp_replace(regexp_replace(translate(" + title + ", "
        "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^a-z0-9]+', '_', 'g'), "
        "'^[^a-z]+', ''), '_+$', ''), 64), '')"
    )


def sql_short(text: str, limit: int) -> str:
    """Longest run of whole characters within `limit` bytes, NULL when empty."""
    return (
        f"nullif(CASE WHEN strlen({text}) <= {limit} THEN {text} ELSE left({text}, "
        f"list_max(list_filter(range({limit // 4}, {limit + 1}), lambda n: strlen(left({text}, n)) <= {limit}))"
        ") END, '')"
    )


# --- raw views -----------------------------------------------------------------------------------

EVENTS = """
SELECT CAST(user_id % 3 AS STRING) AS server_id, event_id AS arrival_seq,
       CAST(ts AS TIMESTAMP) AS received_at, CAST(ts AS TIMESTAMP) AS occurred_at,
       user_id AS source, event_type AS action,
       CASE event_type WHEN 'purchase' THEN 'money' WHEN 'signup' THEN 'player'
            WHEN 'error' THEN 'system' ELSE 'inventory' END AS category,
       CASE WHEN event_type = 'view' THEN 'shop.views' END AS channel,
       CAST(value AS DECIMAL(18,2)) AS amount, props
FROM $events
"""

MOVES = """
SELECT CAST(l_suppkey % 5 AS STRING) AS server_id,
       (l_orderkey * 1000000 + l_partkey) * 1000 + l_suppkey AS arrival_seq,
       CAST(l_shipdate AS TIMESTAMP) AS received_at, 'ox_inventory' AS invoking_resource,
       l_linenumber <> 7 AS success,
       CAST(l_orderkey % 97 AS STRING) AS source,
       CASE WHEN l_returnflag = 'R' AND l_linenumber = 1 THEN 'give'
            WHEN l_linestatus = 'F' THEN 'swap' ELSE 'move' END AS action,
       CASE l_partkey % 6 WHEN 0 THEN 'player' WHEN 1 THEN 'stash' WHEN 2 THEN 'trunk'
            WHEN 3 THEN 'glovebox' WHEN 4 THEN 'drop' ELSE 'player' END AS from_type,
       CASE l_suppkey % 7 WHEN 0 THEN 'player' WHEN 1 THEN 'stash' WHEN 2 THEN 'trunk'
            WHEN 3 THEN 'glovebox' WHEN 4 THEN 'newdrop' WHEN 5 THEN 'shop' ELSE 'player' END AS to_type,
       CASE WHEN l_partkey % 6 = 2 THEN '"trunk-AB' || CAST(l_orderkey % 50 AS STRING) || '"'
            WHEN l_orderkey % 2 = 0 THEN CAST(l_orderkey % 50 AS STRING)
            ELSE '"' || CAST(l_orderkey % 50 AS STRING) || '"' END AS from_inventory,
       CASE WHEN l_suppkey % 7 = 4 THEN NULL
            WHEN l_suppkey % 7 = 3 THEN '"gloveCD' || CAST(l_partkey % 50 AS STRING) || '"'
            ELSE CAST(l_partkey % 50 AS STRING) END AS to_inventory,
       CASE WHEN l_suppkey % 7 = 4 THEN 'drop-' || CAST(l_orderkey AS STRING) END AS drop_id,
       CASE WHEN l_linenumber % 2 = 0 THEN CAST(CAST(l_quantity AS BIGINT) AS STRING) END AS count,
       CASE WHEN p_type = 'PROMO' THEN 'weapon_' || replace(p_name, ' ', '_')
            ELSE p_name END AS item,
       p_brand AS label, CAST(l_quantity AS BIGINT) AS quantity, l_linenumber AS line,
       l_extendedprice AS price, l_orderkey AS order_key, l_partkey AS part_key,
       l_suppkey AS supp_key, p_type AS part_type, p_size AS part_size
FROM $lineitem JOIN $part ON l_partkey = p_partkey
"""

MOVE_HOOKS = f"""
SELECT *, CASE WHEN line % 5 = 0 THEN CAST(line AS STRING)
       ELSE '{{"name":"' || item || '","label":"' || label || '","count":' || CAST(quantity AS STRING)
            || ',"slot":' || CAST(line AS STRING) || ',"metadata":{{"serial":"' || CAST(part_key AS STRING)
            || '"}}}}' END AS from_slot,
       CASE WHEN line % 5 = 0 OR line % 3 = 0 THEN '{{"name":"' || label || '","count":1,"slot":'
            || CAST(part_size AS STRING) || '}}' ELSE CAST(part_size AS STRING) END AS to_slot
FROM ({MOVES}) AS moves
"""

CONNECTIONS = """
SELECT CAST(o_custkey % 3 AS STRING) AS server_id, o_custkey % 97 AS source, 'joining' AS event,
       CAST(o_orderdate AS TIMESTAMP) AS received_at, o_orderkey AS arrival_seq, c_name AS name,
       'license:' || CAST(o_custkey AS STRING) AS license, c_custkey AS customer
FROM $orders JOIN $customer ON o_custkey = c_custkey
UNION ALL
SELECT CAST(o_custkey % 3 AS STRING), o_custkey % 97, 'dropped',
       CAST(o_orderdate AS TIMESTAMP) + INTERVAL 36 HOUR, o_orderkey + 1000000000, c_name,
       'license:' || CAST(o_custkey AS STRING), c_custkey
FROM $orders JOIN $customer ON o_custkey = c_custkey
WHERE o_orderkey % 4 = 0
"""

PROBES = """
SELECT CAST(l_suppkey % 3 AS STRING) AS server_id,
       CASE WHEN l_linenumber = 7 THEN NULL ELSE l_partkey % 97 END AS source,
       CAST(l_shipdate AS TIMESTAMP) AS received_at,
       (l_orderkey * 1000000 + l_partkey) * 1000 + l_suppkey AS arrival_seq,
       l_linenumber AS line, l_orderkey AS order_key, l_partkey AS part_key
FROM $lineitem
"""

CHARACTERS = """
SELECT CAST(o_custkey % 3 AS STRING) AS server_id, o_custkey % 97 AS source,
       CAST(o_orderdate AS TIMESTAMP) + INTERVAL 6 HOUR AS valid_from, o_orderkey AS seq,
       CASE WHEN o_orderkey % 5 <> 0 THEN 'char1:' || CAST(o_custkey AS STRING) END AS identifier,
       CASE WHEN o_orderkey % 5 <> 0 AND o_orderkey % 3 = 0 THEN c_name
            WHEN o_orderkey % 5 <> 0 THEN c_mktsegment || ' ' || CAST(c_nationkey AS STRING) END AS name,
       CASE WHEN o_orderkey % 5 <> 0 THEN lower(c_mktsegment) END AS job,
       CASE WHEN o_orderkey % 5 <> 0 THEN 'user' END AS grp
FROM $orders JOIN $customer ON o_custkey = c_custkey
"""

INVENTORIES = """
SELECT CAST(s_suppkey % 3 AS STRING) AS server_id, CAST(s_suppkey AS STRING) AS id, 'player' AS type,
       CASE WHEN s_suppkey % 4 <> 0 THEN 'char1:owner' || CAST(s_suppkey AS STRING) END AS owner
FROM $supplier
"""

ATTEMPTS = """
SELECT CAST(o_custkey % 7 AS STRING) AS server_id, CAST(o_custkey % 14 AS STRING) AS boot_id,
       CAST(o_orderdate AS TIMESTAMP) AS sent_at,
       CASE WHEN o_orderkey % 29 = 0 THEN NULL
            WHEN o_orderkey % 31 = 0 THEN CAST(o_orderdate AS TIMESTAMP) + INTERVAL 15 SECOND
            ELSE CAST(o_orderdate AS TIMESTAMP) + INTERVAL 2 SECOND END AS response_at,
       o_orderkey AS attempt_seq,
       CASE WHEN o_orderstatus = 'F' THEN 202
            WHEN o_orderpriority = '1-URGENT' THEN 503 WHEN o_orderpriority = '2-HIGH' THEN 413
            WHEN o_orderpriority = '3-MEDIUM' THEN 401 WHEN o_orderpriority = '5-LOW' THEN 0
            ELSE 200 END AS status,
       CASE WHEN o_orderkey % 11 = 0 THEN '0.5' ELSE CAST(o_orderkey % 90 AS STRING) END AS accepted,
       CAST(o_orderkey % 7 AS STRING) AS duplicates,
       CASE WHEN o_orderkey % 13 = 0 THEN '-1' WHEN o_orderkey % 17 = 0 THEN NULL
            ELSE CAST(o_orderkey % 3 AS STRING) END AS rejected,
       CAST(o_orderkey % 90 + o_orderkey % 7 + o_orderkey % 3 AS INT) AS event_count,
       o_custkey AS customer
FROM $orders
"""
