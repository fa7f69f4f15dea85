"""They must equal the logger's own for results to agree."""

CATEGORIES = ("inventory", "money", "player", "vehicle", "property", "staff", "security", "system")

SEVERITIES = {
    "debug": "debug", "info": "info", "notice": "notice", "warning": "warning",
    "critical": "critical", "success": "info", "warn": "warning", "error": "warning",
    "danger": "warning",
}

FIELD_ALIASES = {
    "amount_paid": "amount", "total_cost": "amount", "cost": "amount", "total": "amount",
    "quantity": "count", "vehicle": "model",
}

IDENTIFIER_KINDS = ("license", "license2", "discord", "steam", "fivem")

COMMAND_ACTIONS = {
    "tp": "teleport", "tpm": "teleport", "setcoords": "teleport", "goto": "goto",
    "bring": "bring", "noclip": "noclip", "heal": "heal", "revive": "revive",
    "freeze": "freeze", "unfreeze": "freeze", "car": "vehicle_spawn", "dv": "vehicle_delete",
    "cardel": "vehicle_delete", "giveaccountmoney": "money_adjustment",
    "removeaccountmoney": "money_adjustment", "setaccountmoney": "money_adjustment",
    "giveitem": "item_give", "additem": "item_give", "giveweapon": "item_give",
    "removeitem": "item_remove", "setitem": "item_give", "setjob": "character_modified",
    "setgroup": "permission_changed",
}

MENU_ACTIONS = {
    "teleportWaypoint": "teleport", "teleportCoords": "teleport", "teleportPlayer": "goto",
    "summonPlayer": "bring", "healPlayer": "heal", "healSelf": "heal", "healAll": "heal",
    "spectatePlayer": "spectate", "freezePlayer": "freeze", "spawnVehicle": "vehicle_spawn",
    "deleteVehicle": "vehicle_delete", "clearArea": "area_cleanup",
}
MENU_TARGETED = (
    "summonPlayer", "healPlayer", "spectatePlayer", "freezePlayer", "drunkEffect", "setOnFire",
    "wildAttack",
)
MENU_PRANKS = ("drunkEffect", "setOnFire", "wildAttack")

ACCOUNT_ACTIONS = {"money": "cash", "bank": "bank", "black_money": "dirty"}
SALARY_REASONS = ("Paycheck", "Welfare Check")
RESYNC_REASON = "Sync account with item"
LIMIT_REASON = "%d events in a minute; logging kept %d and dropped the rest"

ACCOUNT_ITEMS = ("money",)
USE_WATCHLIST = ("lockpick", "armour", "bandage", "medikit")

# Limits, in bytes or entries.
MAX_EVENT_BYTES = 32768
MAX_SPOOL_BYTES = 67108864
MAX_STRING_BYTES = 2048
MAX_TEXT_BYTES = 128
MAX_KEYS = 64
MAX_METADATA_KEYS = 12
MAX_DEPTH = 6
MAX_BATCH_EVENTS = 500
MAX_BODY_BYTES = 1048576
ENVELOPE_BYTES = 2048
SCHEMA_VERSION = 1
MAX_EXACT_INTEGER = 9007199254740991

# Defaults of the logger's configuration.
BATCH_EVENTS = 200
BODY_BYTES = 900000
QUEUE_EVENTS = 5000
QUEUE_BYTES = 8388608
GAP_SECONDS = 10
HOLD_SECONDS = 60
PLAYER_LIMIT = 300
LIMIT_SECONDS = 60
TIMEOUT_SECONDS = 15
RETRY_BASE_MS = 1000
RETRY_MAX_MS = 60000

ACCEPT_STATUSES = (200, 202)
DISCARD_STATUSES = (400, 413, 415, 422)
AUTH_STATUSES = (401, 403)
