"""Declared schemas: raw snapshot records (read side) and target tables.

Raw fields that drift between days (ids, numbers, booleans, times, id
lists) are declared as strings: the JSON reader then hands back the text of
whatever arrived (numbers, arrays and objects as their JSON text), and the
normalizers parse each value with a ``try_*`` cast, so one bad row becomes
one quarantined row instead of a failed job or a re-typed column.
"""

from __future__ import annotations

from pyspark.sql.types import ArrayType, StructField, StructType, StringType

# ---------------------------------------------------------------------------
# Accepted ISO-4217 currency codes (163 codes, alphabetical).
# ---------------------------------------------------------------------------
CURRENCY_CODES = (
    "AED", "AFN", "ALL", "AMD", "ANG", "AOA", "ARS", "AUD", "AWG", "AZN", "BAM", "BBD", "BDT", "BGN",
    "BHD", "BIF", "BMD", "BND", "BOB", "BRL", "BSD", "BTN", "BWP", "BYN", "BZD", "CAD", "CDF", "CHF",
    "CLP", "CNY", "COP", "CRC", "CUC", "CUP", "CVE", "CZK", "DJF", "DKK", "DOP", "DZD", "EGP", "ERN",
    "ETB", "EUR", "FJD", "FKP", "GBP", "GEL", "GGP", "GHS", "GIP", "GMD", "GNF", "GTQ", "GYD", "HKD",
    "HNL", "HRK", "HTG", "HUF", "IDR", "ILS", "IMP", "INR", "IQD", "IRR", "ISK", "JEP", "JMD", "JOD",
    "JPY", "KES", "KGS", "KHR", "KMF", "KPW", "KRW", "KWD", "KYD", "KZT", "LAK", "LBP", "LKR", "LRD",
    "LSL", "LYD", "MAD", "MDL", "MGA", "MKD", "MMK", "MNT", "MOP", "MRU", "MUR", "MVR", "MWK", "MXN",
    "MYR", "MZN", "NAD", "NGN", "NIO", "NOK", "NPR", "NZD", "OMR", "PAB", "PEN", "PGK", "PHP", "PKR",
    "PLN", "PYG", "QAR", "RON", "RSD", "RUB", "RWF", "SAR", "SBD", "SCR", "SDG", "SEK", "SGD", "SHP",
    "SLL", "SOS", "SPL", "SRD", "STN", "SVC", "SYP", "SZL", "THB", "TJS", "TMT", "TND", "TOP", "TRY",
    "TTD", "TVD", "TWD", "TZS", "UAH", "UGX", "USD", "UYU", "UZS", "VEF", "VES", "VND", "VUV", "WST",
    "XAF", "XCD", "XDR", "XOF", "XPF", "YER", "ZAR", "ZMW", "ZWD",
)


def _strings(*names: str) -> list[StructField]:
    return [StructField(n, StringType()) for n in names]


def struct(*fields) -> StructType:
    return StructType(list(fields))


# ---------------------------------------------------------------------------
# Raw record schemas (one record = one element of ``results`` or a flat row)
# ---------------------------------------------------------------------------
CURRENCY_DATA = struct(*_strings("originalCurrencyAmount", "exponent", "originalCurrencyCode", "exchangeRate"))

TRANSACTION_RECORD = struct(
    *_strings(
        "id", "uuid", "occurredTime", "updatedTime", "userId", "userUuid", "userName",
        "merchantName", "rawMerchantName", "cardId", "cardUuid", "budgetId", "budgetUuid",
    ),
    StructField("currencyData", CURRENCY_DATA),
    *_strings("originalCurrencyAmount", "exponent", "originalCurrencyCode", "exchangeRate"),
)

CARD_PERIOD = struct(*_strings("limit", "spent"))
CARD_RECORD = struct(
    *_strings(
        "id", "uuid", "name", "userId", "userUuid", "budgetId", "budgetUuid", "lastFour",
        "validThru", "status", "type", "shareBudgetFunds", "recurring", "recurringLimit",
    ),
    StructField("currentPeriod", CARD_PERIOD),
    *_strings("createdTime", "updatedTime"),
)

BUDGET_SPENT = struct(*_strings("cleared", "pending", "total"))
BUDGET_PERIOD = struct(*_strings("limit", "overspendBuffer", "assigned"), StructField("spent", BUDGET_SPENT))
BUDGET_RECORD = struct(
    *_strings("id", "uuid", "name", "description", "retired", "startDate", "recurringInterval", "timezone"),
    StructField("currentPeriod", BUDGET_PERIOD),
)

CONTACT = struct(
    *_strings("email", "name", "job_title", "language", "mobile", "phone", "time_zone", "last_login_at")
)
AGENT_DETAIL_RECORD = struct(
    StructField("id", StringType()),
    StructField("contact", CONTACT),
    *_strings(
        "email", "name", "job_title", "language", "mobile", "phone", "time_zone", "last_login_at",
        "available", "available_since", "deactivated", "focus_mode", "agent_operational_status",
        "last_active_at", "created_at", "updated_at", "ticket_scope", "org_agent_id", "signature",
        "freshchat_agent", "role_ids", "group_ids",
    ),
)
ACTIVE_AGENT_RECORD = struct(*_strings("id"))

ROLE_FIELDS = ("name", "description", "default", "agent_type", "created_at", "updated_at")
ROLE_RECORD = struct(
    StructField("id", StringType()),
    StructField("role", struct(*_strings(*ROLE_FIELDS))),
    *_strings(*ROLE_FIELDS),
)

GROUP_RECORD = struct(*_strings("id", "name", "parent_group_id", "created_at", "updated_at", "agent_ids"))


# Column the JSON reader fills with the text of a document it could not read.
CORRUPT = "_corrupt_record"


def captured(record: StructType) -> StructType:
    """``record`` with the capture column. A document without a readable record
    becomes one record that holds only its text, so the required-field rules
    quarantine it with that text instead of dropping it."""
    return StructType([*record.fields, StructField(CORRUPT, StringType())])


def envelope(record: StructType, name: str = "results") -> StructType:
    """Read schema accepting both ``{"results": [...]}`` and flat records."""
    return StructType([StructField(name, ArrayType(record))] + list(record.fields))


def wrapped(record: StructType, wrapper: str) -> StructType:
    """Read schema accepting ``{"results": [...]}``, ``{wrapper: {...}}`` and flat rows."""
    return StructType(
        [StructField("results", ArrayType(record)), StructField(wrapper, record)] + list(record.fields)
    )


# ---------------------------------------------------------------------------
# Target (core) table schemas, DDL strings
# ---------------------------------------------------------------------------
TRANSACTIONS_DDL = (
    "transaction_id string, transaction_uuid string, occurred_time timestamp, updated_time timestamp, "
    "user_id string, user_uuid string, user_name string, merchant_name string, raw_merchant_name string, "
    "card_id string, card_uuid string, budget_id string, budget_uuid string, original_amount decimal(38,9), "
    "original_currency string, amount_usd decimal(38,9), exchange_rate double, fx_source string, "
    "idempotency_key string, raw_payload string, ingested_at timestamp"
)
CARDS_DDL = (
    "card_id string, card_uuid string, name string, user_id string, user_uuid string, budget_id string, "
    "budget_uuid string, last_four string, valid_thru string, status string, type string, "
    "share_budget_funds boolean, recurring boolean, recurring_limit decimal(38,9), current_limit decimal(38,9), "
    "current_spent decimal(38,9), created_time timestamp, updated_time timestamp, last_synced_day string, "
    "source string, ingested_at timestamp"
)
BUDGETS_DDL = (
    "budget_id string, budget_uuid string, name string, description string, retired boolean, "
    "start_date date, recurring_interval string, timezone string, limit_amount decimal(38,9), "
    "overspend_buffer decimal(38,9), assigned_amount decimal(38,9), spent_cleared decimal(38,9), spent_pending decimal(38,9), "
    "spent_total decimal(38,9), sync_day string, created_at timestamp, updated_at timestamp, source string"
)
AGENTS_DDL = (
    "agent_id bigint, email string, name string, job_title string, language string, mobile string, "
    "phone string, time_zone string, available boolean, available_since timestamp, deactivated boolean, "
    "status string, focus_mode string, agent_operational_status string, last_active_at timestamp, "
    "last_login_at timestamp, org_agent_id string, ticket_scope string, signature string, "
    "freshchat_agent string, created_at timestamp, updated_at timestamp"
)
ROLES_DDL = (
    "role_id bigint, name string, description string, is_default boolean, agent_type string, "
    "created_at timestamp, updated_at timestamp"
)
GROUPS_DDL = (
    "group_id bigint, name string, parent_group_id bigint, created_at timestamp, updated_at timestamp, "
    "inactive boolean"
)
MEMBERSHIP_DDL = "group_id bigint, agent_id bigint"
AGENT_ROLE_MAPPING_DDL = (
    "agent_id bigint, role_id bigint, status string, assigned_at timestamp, removed_at timestamp, "
    "updated_at timestamp"
)
AGENT_ROLE_HISTORY_DDL = "agent_id bigint, role_id bigint, action string, action_time timestamp"
AGENT_STATUS_HISTORY_DDL = "agent_id bigint, sync_date date, is_active boolean"
QUARANTINE_DDL = (
    "entity string, record_key string, error_type string, error_message string, raw_record string, "
    "sync_day string, created_at timestamp"
)
#: Columns that a scan adds to each record: the file it came from, and when that was written.
FILE, FILE_TIME = "_file", "_file_time"
PIPELINE_STATE_DDL = "pipeline_name string, last_processed_time timestamp"
PIPELINE_METRICS_DDL = (
    "flow_run_id string, task_name string, pipeline_name string, table_name string, day string, "
    "rows_inserted bigint, rows_updated bigint, rows_deleted bigint, rows_stale bigint, rows_kept bigint, "
    "rows_reassigned bigint, rows_recomputed bigint, rows_affected bigint, status string, "
    "error_message string, started_at timestamp, finished_at timestamp, duration_seconds double"
)
FX_RATES_DDL = "fx_date date, currency string, usd_quote double"
