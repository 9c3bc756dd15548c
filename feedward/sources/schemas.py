"""Declared raw schemas. Types are never inferred."""

from __future__ import annotations

from pyspark.sql.types import (
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructType,
    TimestampNTZType,
)

_TEXT, _STAMP, _COUNT = StringType(), TimestampNTZType(), LongType()


def _schema(**columns) -> StructType:
    schema = StructType()
    for name, kind in columns.items():
        schema.add(name, kind)
    return schema


# Table and column names are the data contract of the feeds.
RAW_SCHEMAS: dict[str, StructType] = {
    "customers": _schema(
        customer_id=_TEXT,
        full_name=_TEXT,
        email=_TEXT,
        phone=_TEXT,
        state=_TEXT,
        created_at=_STAMP,
    ),
    "accounts": _schema(
        account_id=_TEXT,
        customer_id=_TEXT,
        data_holder=_TEXT,
        account_type=_TEXT,
        balance_aud=DoubleType(),
        currency=_TEXT,
        status=_TEXT,
        open_date=DateType(),
        last_updated=_STAMP,
    ),
    "consents": _schema(
        consent_id=_TEXT,
        customer_id=_TEXT,
        data_holder=_TEXT,
        status=_TEXT,
        scopes=_TEXT,
        created_at=_STAMP,
        expires_at=_STAMP,
        revoked_at=_STAMP,
        sharing_duration_days=IntegerType(),
    ),
    "transactions": _schema(
        transaction_id=_TEXT,
        account_id=_TEXT,
        transaction_type=_TEXT,
        amount_aud=DoubleType(),
        currency=_TEXT,
        merchant_name=_TEXT,
        transaction_date=_STAMP,
        posted_date=_STAMP,
        description=_TEXT,
        status=_TEXT,
    ),
    "feed_logs": _schema(
        feed_log_id=_TEXT,
        data_holder=_TEXT,
        feed_type=_TEXT,
        run_at=_STAMP,
        status=_TEXT,
        records_expected=_COUNT,
        records_received=_COUNT,
        latency_ms=_COUNT,
        error_code=_TEXT,
        ingestion_version=_TEXT,
    ),
}

RAW_TABLES = tuple(f"raw_{name}" for name in RAW_SCHEMAS)
