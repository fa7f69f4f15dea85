from tidewatch.functions.sqlnames import register_sql_functions
from tidewatch.functions.text import (
    command_text,
    job_label,
    lua_number,
    normalise_action,
    normalise_severity,
    number_json,
    parse_money_text,
    plate_of,
    round_coords,
    short_text,
    text_json,
    utc_text,
    weapon_flag,
)
from tidewatch.functions.records import (
    bounded_copy,
    bounded_map,
    canonical_json,
    event_id,
    fields_to_data,
    fold_key,
    json_map,
    read_slot,
)

__all__ = [
    "bounded_copy", "bounded_map", "canonical_json", "command_text", "event_id", "fields_to_data",
    "fold_key", "job_label", "json_map", "lua_number", "normalise_action", "normalise_severity",
    "number_json", "parse_money_text", "plate_of", "read_slot", "register_sql_functions",
    "round_coords", "short_text", "text_json", "utc_text", "weapon_flag",
]
