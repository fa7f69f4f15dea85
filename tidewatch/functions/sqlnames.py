"""The pure scalars under SQL names, as session SQL functions.

Patterns, types and tables are those of the column functions and of `fixed`; a test holds both forms
against each other.
"""

from __future__ import annotations

import string

from pyspark.sql import SparkSession

from tidewatch import fixed
from tidewatch.functions.text import DECIMAL_TEXT, HEX_TEXT, MONEY_TEXT, NUMBER


def _raw(pattern: str) -> str:
    """A pattern as a SQL literal in which backslashes stand for themselves."""
    return f"r'{pattern}'"


def _lower(text: str) -> str:
    return f"translate({text}, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"


_BARE = f"regexp_replace(txt, {_raw('^[ \\t-\\r]+|[ \\t-\\r]+$')}, '')"
_CUTS = ", ".join(f"try_validate_utf8(CAST(left(CAST(txt AS BINARY), n - {back}) AS STRING))" for back in range(4))
_LEVELS = " ".join(f"WHEN '{known}' THEN '{level}'" for known, level in fixed.SEVERITIES.items())

# CREATE FUNCTION bodies are single SQL expressions, so Catalyst inlines them like built-ins.
_BODIES = {
    "tw_normalise_action": (
        "title STRING", "STRING",
        f"nullif(left(regexp_replace(regexp_replace(regexp_replace({_lower('title')}, "
        "'[^a-z0-9]+', '_'), '^[^a-z]+', ''), '_+$', ''), 64), '')",
    ),
    "tw_normalise_severity": ("level STRING", "STRING", f"CASE {_lower('level')} {_LEVELS} END"),
    "tw_number": (
        "txt STRING", NUMBER,
        f"CASE WHEN txt RLIKE {_raw('^-?[0-9]{1,18}\\z')} THEN CAST(CAST(txt AS BIGINT) AS {NUMBER}) "
        f"WHEN txt RLIKE {_raw(DECIMAL_TEXT)} THEN try_cast({_BARE} AS {NUMBER}) "
        f"WHEN txt RLIKE {_raw(HEX_TEXT)} THEN CAST(CAST(conv(regexp_replace({_BARE}, '^[+-]?0[xX]', ''), 16, 10) "
        f"AS DECIMAL(20,0)) * CASE WHEN startswith({_BARE}, '-') THEN -1 ELSE 1 END AS {NUMBER}) END",
    ),
    "tw_money_number": (
        "txt STRING", NUMBER,
        f"CASE WHEN regexp_replace(txt, '[*`]', '') RLIKE {_raw(MONEY_TEXT)} "
        "THEN tw_number(regexp_replace(txt, '[*`$,]', '')) END",
    ),
    "tw_plate_of": (
        "id STRING", "STRING", f"nullif(regexp_extract(id, {_raw('^[A-Za-z]+-?([A-Za-z0-9]+)\\z')}, 1), '')",
    ),
    "tw_short_text": (
        "txt STRING, n INT", "STRING", f"nullif(CASE WHEN octet_length(txt) <= n THEN txt ELSE coalesce({_CUTS}) END, '')",
    ),
    "tw_weapon_flag": (
        "item STRING", "BOOLEAN",
        f"coalesce(startswith({_lower('item')}, 'weapon_') OR startswith({_lower('item')}, 'ammo-'), false)",
    ),
    "tw_utc_text": ("moment TIMESTAMP", "STRING", "date_format(moment, \"yyyy-MM-dd'T'HH:mm:ss'Z'\")"),
    "tw_volume_label": (
        "channel STRING, category STRING, action STRING", "STRING", "concat(coalesce(channel, category, '?'), ' ', action)",
    ),
}


def register_sql_functions(spark: SparkSession) -> list[str]:
    """Make the scalars callable from SQL text; returns their names."""
    for name, (parameters, result, body) in _BODIES.items():
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {result} RETURN {body}"
        )
    return sorted(_BODIES)
