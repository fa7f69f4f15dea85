"""Scalar text and number normalisers, all native column expressions."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewatch import fixed

# Exact to seven decimals below 10^31; a sum beyond that is an error of the job, never a silent loss.
NUMBER = "decimal(38,7)"
DECIMAL_TEXT = r"^[ \t-\r]*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?[ \t-\r]*\z"
HEX_TEXT = r"^[ \t-\r]*[+-]?0[xX][0-9a-fA-F]{1,16}[ \t-\r]*\z"
# What JSON escapes, and the mark that stands for bytes which are no UTF-8.
JSON_ESCAPED = r'["\\\x00-\x1f\uFFFD]'
MONEY_TEXT = r"^\$?[0-9,]+\.?[0-9]*\z"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once per row, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only, so U+212A and friends never become ASCII letters."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def ascii_lower_name(name: str) -> str:
    """The same for a name of a list that such text is compared with."""
    return name.translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase))


def normalise_action(title: Column) -> Column:
    """Snake-case action of a display title, or NULL when nothing usable is left."""
    joined = F.regexp_replace(ascii_lower(title), "[^a-z0-9]+", "_")
    led = F.regexp_replace(joined, "^[^a-z]+", "")
    trimmed = F.regexp_replace(led, "_+$", "")
    return F.nullif(F.substring(trimmed, 1, 64), F.lit(""))


def normalise_severity(level: Column) -> Column:
    """One of the five levels, or NULL for a spelling nobody knows."""
    known = F.create_map(*[F.lit(part) for pair in fixed.SEVERITIES.items() for part in pair])
    return F.element_at(known, ascii_lower(level))


def cut_bytes(text: Column, limit: int) -> Column:
    """At most `limit` UTF-8 bytes; a character the cut would split is left out whole."""
    raw = text.cast("binary")
    cuts = [
        F.try_validate_utf8(F.substring(raw, 1, limit - back).cast("string"))
        for back in range(min(4, limit))
    ]
    return F.when(F.octet_length(text) <= limit, text).otherwise(F.coalesce(*cuts))


def short_text(text: Column, limit: int = fixed.MAX_TEXT_BYTES) -> Column:
    """Text cut to `limit` bytes; empty becomes NULL. Numbers are taken as their text."""
    text = text.cast("string")
    return F.when(text != "", cut_bytes(text, limit))


def lua_number(text: Column) -> Column:
    """Number behind text the way the game's scripts read it: decimal, exponent or hex."""
    text = text.cast("string")
    bare = F.regexp_replace(text, r"^[ \t-\r]+|[ \t-\r]+$", "")
    digits = F.regexp_replace(bare, "^[+-]?0[xX]", "")
    sign = F.when(bare.startswith("-"), -1).otherwise(1)
    return (
        F.when(text.rlike(r"^-?[0-9]{1,18}\z"), text.cast("bigint").cast(NUMBER))
        .when(text.rlike(DECIMAL_TEXT), bare.try_cast(NUMBER))
        .when(text.rlike(HEX_TEXT), (F.conv(digits, 16, 10).cast("decimal(20,0)") * sign).cast(NUMBER))
    )


def number_json(number: Column) -> Column:
    """JSON text of a number without trailing zeros."""
    return F.regexp_replace(number.cast(NUMBER).cast("string"), r"\.?0+$", "")


def text_json(text: Column) -> Column:
    """JSON text of a string, NULL kept. Most texts have nothing to escape and are quoted as they are."""
    quoted = F.to_json(F.array(text))
    return F.when(~text.rlike(JSON_ESCAPED), F.concat(F.lit('"'), text, F.lit('"'))).when(
        text.isNotNull(), F.substring(quoted, F.lit(2), F.length(quoted) - 2))


def boolean_json(flag: Column) -> Column:
    return flag.cast("string")


def parse_money_text(text: Column) -> Column:
    """struct(text, number): bold and code marks stripped; number only for money-looking text."""
    stripped = F.translate(text, "*`", "")
    money = F.when(stripped.rlike(MONEY_TEXT), lua_number(F.translate(stripped, "$,", "")))
    return F.struct(stripped.alias("text"), money.alias("number"))


def money_json(text: Column) -> Column:
    """JSON number for money-looking text, JSON string otherwise."""
    parsed = parse_money_text(text)
    return F.coalesce(number_json(parsed["number"]), text_json(parsed["text"]))


def weapon_flag(item: Column) -> Column:
    lowered = ascii_lower(item)
    return F.coalesce(lowered.startswith("weapon_") | lowered.startswith("ammo-"), F.lit(False))


def plate_of(inventory_id: Column) -> Column:
    """Plate inside a trunk or glovebox inventory id."""
    return F.nullif(
        F.regexp_extract(inventory_id, r"^[A-Za-z]+-?([A-Za-z0-9]+)\z", 1), F.lit("")
    )


def round_coords(axis: Column) -> Column:
    """A coordinate rounded down to hundredths."""
    return F.floor(axis * 100) / F.lit(100.0)


def utc_text(at: Column) -> Column:
    return F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def job_label(job: Column) -> Column:
    """`<label or name> - <grade label or grade>` of a job struct."""
    title = F.coalesce(job["label"], job["name"], F.lit("nil"))
    grade = F.coalesce(job["grade_label"], job["grade"].cast("string"), F.lit("nil"))
    return F.when(job.isNotNull(), F.concat(title, F.lit(" - "), grade))


def command_text(command: Column, arguments: Column) -> Column:
    """`/command arguments`; no space when there are no arguments."""
    tail = F.when(arguments != "", F.concat(F.lit(" "), arguments)).otherwise(F.lit(""))
    return F.concat(F.lit("/"), command, F.coalesce(tail, F.lit("")))


def json_scalar_text(value: Column) -> Column:
    """Plain text of a JSON number, string or object; NULL for JSON null."""
    escaped = F.get_json_object(F.concat(F.lit('{"v":'), value, F.lit("}")), "$.v")
    inner = F.substring(value, F.lit(2), F.length(value) - 2)
    return (
        F.when(value.startswith('"'), F.when(value.contains("\\"), escaped).otherwise(inner))
        .when(value != "null", value)
    )
