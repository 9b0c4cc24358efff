"""Table schemas and the fixed values of the data model."""

from __future__ import annotations

from pyspark.sql import types as T

# Field data types as stored, and the kinds they collapse to.
DATA_TYPES = ("text", "number", "date", "select", "multi_select")
TEXT, NUMBER, DATE, SELECT = "TEXT", "NUMBER", "DATE", "SELECT"
KIND_OF_DATA_TYPE = {
    "text": TEXT,
    "number": NUMBER,
    "date": DATE,
    "select": SELECT,
    "multi_select": SELECT,
}
DATA_TYPE_OF_KIND = {TEXT: "text", NUMBER: "number", DATE: "date", SELECT: "select"}

# Record and change-log states.
CONTACT_STATES = ("active", "inactive")
CREATED, UPDATED, DELETED = "CONTACT_CREATED", "CONTACT_UPDATED", "CONTACT_DELETED"
PENDING, PROCESSING, DONE, FAILED = "PENDING", "PROCESSING", "DONE", "FAILED"
OUTBOX_STATES = (PENDING, PROCESSING, DONE, FAILED)
MAX_RETRIES = 5
CLAIM_BATCH = 100
RETRY_BATCH = 50
KEEP_DONE_DAYS = 7

# Patterns and limits of names, addresses and search words.
CUSTOM_SUFFIX = "__c"
API_NAME_PATTERN = r"^[a-z][a-z0-9_]*__c$"
EMAIL_PATTERN = r"^[^\s@]+@[^\s@]+\.[^\s@]+$"
DATE_PATTERN = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
MIN_GRAM, MAX_GRAM = 2, 10
BM25_K1, BM25_B = 1.2, 0.75
DEFAULT_PAGE, DEFAULT_PAGE_SIZE = 1, 20
DEFAULT_TERMS, GROUP_LIMIT = 10, 50

# The document fields a keyword is looked up in.
SEARCH_FIELDS = (
    "email",
    "name",
    "job_title__c",
    "department__c",
    "region__c",
    "tier__c",
    "lead_source__c",
    "notes__c",
)

CONTACTS = T.StructType(
    [
        T.StructField("id", T.StringType(), False),
        T.StructField("first_name", T.StringType(), False),
        T.StructField("last_name", T.StringType(), False),
        T.StructField("email", T.StringType()),
        T.StructField("phone", T.StringType()),
        T.StructField("account_id", T.StringType()),
        T.StructField("status", T.StringType(), False),
        T.StructField("created_at", T.TimestampNTZType(), False),
        T.StructField("updated_at", T.TimestampNTZType(), False),
    ]
)

DEFINITIONS = T.StructType(
    [
        T.StructField("id", T.StringType(), False),
        T.StructField("label", T.StringType(), False),
        T.StructField("api_name", T.StringType(), False),
        T.StructField("data_type", T.StringType(), False),
        T.StructField("options", T.ArrayType(T.StringType())),
        T.StructField("is_required", T.BooleanType(), False),
        T.StructField("is_active", T.BooleanType(), False),
        T.StructField("display_order", T.IntegerType(), False),
        T.StructField("created_at", T.TimestampNTZType()),
    ]
)

VALUES = T.StructType(
    [
        T.StructField("id", T.StringType(), False),
        T.StructField("record_id", T.StringType(), False),
        T.StructField("field_id", T.StringType(), False),
        T.StructField("value", T.StringType()),
        T.StructField("created_at", T.TimestampNTZType()),
        T.StructField("updated_at", T.TimestampNTZType()),
    ]
)

ACCOUNTS = T.StructType(
    [
        T.StructField("id", T.StringType(), False),
        T.StructField("name", T.StringType(), False),
        T.StructField("industry", T.StringType()),
        T.StructField("annual_revenue", T.DecimalType(15, 2)),
        T.StructField("created_at", T.TimestampNTZType(), False),
        T.StructField("updated_at", T.TimestampNTZType(), False),
    ]
)

OUTBOX = T.StructType(
    [
        T.StructField("id", T.StringType(), False),
        T.StructField("aggregate_type", T.StringType(), False),
        T.StructField("aggregate_id", T.StringType(), False),
        T.StructField("event_type", T.StringType(), False),
        T.StructField("payload", T.StringType()),
        T.StructField("status", T.StringType(), False),
        T.StructField("retry_count", T.IntegerType(), False),
        T.StructField("error_message", T.StringType()),
        T.StructField("created_at", T.TimestampNTZType(), False),
        T.StructField("processed_at", T.TimestampNTZType()),
    ]
)

# Base columns of a record that requests may name, and how their literals are read.
BASE_KINDS = {
    "id": "ID",
    "email": TEXT,
    "name": TEXT,
    "first_name": TEXT,
    "last_name": TEXT,
    "phone": TEXT,
    "account_id": "ID",
    "status": TEXT,
    "created_at": "TIMESTAMP",
    "updated_at": "TIMESTAMP",
}
# Base fields that every document has.
DOCUMENT_COLUMNS = ("id", "email", "name", "created_at", "updated_at")
REQUEST_ALIASES = {
    "createdAt": "created_at",
    "updatedAt": "updated_at",
    "firstName": "first_name",
    "lastName": "last_name",
    "accountId": "account_id",
}
