"""Fixed values of the loading contract.

Everything in this module is a *fixed value*: the names and defaults below must stay exactly as
they are for loads to agree with tables that were produced by the original loading framework.
"""

from __future__ import annotations

# --- fixed values: metadata column names -------------------------------------------------------
ETL_UPDATED = "etl_updated_timestamp"
ETL_DELETED = "etl_deleted_flag"
ETL_INSERTED = "etl_inserted_timestamp"
ROW_EFFECTIVE = "row_effective_timestamp"
ROW_EXPIRY = "row_expiry_timestamp"
ROW_UPDATE = "row_update_timestamp"
ROW_CURRENT = "row_current_flag"
ORIGINATING_KEY_NAME = "originating_business_key_name"
ORIGINATING_SYSTEM = "originating_source_system_code"

# --- fixed values: keys table and key map table columns ----------------------------------------
KEYS_BUSINESS_KEY = "originating_source_business_key"
KEYS_KEY_NAME = "originating_business_key_name"
KEYS_SYSTEM = "originating_source_system_code"
KEYS_ACTIVE = "active_flag"
MAP_BUSINESS_KEY = "source_business_key"
MAP_KEY_NAME = "source_business_key_name"
MAP_SYSTEM = "source_system_code"

# --- fixed values: validity interval defaults ----------------------------------------------------
DEFAULT_START = "1970-01-01 00:00:00"
DEFAULT_END = "2400-01-01 00:00:00"
# The default end written as the legacy text form and its pattern: 01012400 / ddMMyyyy.
DEFAULT_END_TEXT = "01012400"
DEFAULT_END_PATTERN = "ddMMyyyy"

# --- fixed values: text form of timestamps inside derived keys (microsecond precision) ----------
KEY_TS_PATTERN = "yyyy-MM-dd HH:mm:ss.SSSSSS"
# Same format in strftime notation, used by the SQL oracles.
KEY_TS_STRFTIME = "%Y-%m-%d %H:%M:%S.%f"

# --- fixed values: local business time zone of the load stamps ----------------------------------
LOCAL_TZ = "Australia/Sydney"

# --- fixed values: load strategies ---------------------------------------------------------------
STRATEGIES = ("insert", "upsert", "refresh_by_keys", "full", "refresh")

# --- fixed values: type aliases accepted in column specs (alias -> Spark SQL type) -------------
TYPE_ALIASES = {
    "currency": "decimal(18,2)",
    "sap_currency": "decimal(18,2)",
    "epochsec": "timestamp_ntz",
    "epochms": "timestamp_ntz",
    "ticks": "timestamp_ntz",
    "ticks2aest": "timestamp_ntz",
    "highprecisionnumeric": "decimal(38,12)",
}
DEFAULT_SPEC_TYPE = "string"

# --- fixed values: name fragments that make a name-only spec column boolean ---------------------
BOOLEAN_NAME_FRAGMENTS = ("_ok", "_valid")

# --- fixed values: column names that must be quoted ----------------------------------------------
RESERVED_COLUMN_NAMES = ("time", "datetime", "timestamp", "user")

# --- fixed values: backfill horizon in days (production / other environments) -------------------
BACKFILL_DAYS_PROD = 30
BACKFILL_DAYS_OTHER = 2

# --- fixed values: delimited unload format and single-file size cap (bytes) ---------------------
UNLOAD_DELIMITER = ","
UNLOAD_ESCAPE = "/"
UNLOAD_NULL = "\\N"
UNLOAD_MAX_BYTES = 5_000_000_000

# --- fixed values: characters that a column name may hold -----------------------------------------
NAME_PATTERN = r'[^a-zA-Z0-9_"]'

# --- fixed values: compressed-file pattern (the dot is deliberately unescaped) -------------------
COMPRESSED_PATTERN = ".*(.gz)\\d*$"

# Metadata columns that never take part in column matching between a source and a target.
METADATA_COLUMNS = (
    ETL_UPDATED,
    ETL_DELETED,
    ETL_INSERTED,
    ROW_EFFECTIVE,
    ROW_EXPIRY,
    ROW_UPDATE,
    ROW_CURRENT,
)
