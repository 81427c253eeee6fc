"""Declared schemas of the six base tables and the five derived tables."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from basketlens.constants import CONTEXT_COLUMNS, PROCESSED_FEATURES

_TYPES: dict[str, DataType] = {
    "string": StringType(),
    "long": LongType(),
    "int": IntegerType(),
    "double": DoubleType(),
    "boolean": BooleanType(),
    "date": DateType(),
}


def _schema(columns: str, required: str = "") -> StructType:
    """Schema from ``name type`` pairs; ``required`` names the columns never null."""
    fields = []
    for column in columns.split(","):
        name, kind = column.split()
        fields.append(StructField(name, _TYPES[kind], name not in required.split()))
    return StructType(fields)


SCHEMAS: dict[str, StructType] = {
    "customer_master": _schema(
        "customer_id string, age_bracket string, region string, gender string, signup_date date",
        required="customer_id",
    ),
    "transactions": _schema(
        "transaction_id string, customer_id string, transaction_date date, amount double,"
        "category string, channel string, promo_flag boolean, discount_pct double",
        required="transaction_id customer_id",
    ),
    "web_events": _schema(
        "event_id string, customer_id string, session_id string, event_date date,"
        "page_type string, device string, search_flag long",
        required="event_id customer_id",
    ),
    "loyalty": _schema(
        "customer_id string, loyalty_tier string, points_balance long,"
        "enrollment_date date, last_activity_date date",
        required="customer_id",
    ),
    "old_segments": _schema(
        "customer_id string, old_segment_id long, segment_name string, assignment_date date",
        required="customer_id",
    ),
    "campaigns": _schema(
        "campaign_id string, campaign_name string, channel string, send_date date,"
        "segment_targeted long, customer_id string, opened long, clicked long,"
        "converted long, revenue double",
        required="customer_id",
    ),
    "customer_features": _schema(
        "customer_id string, region string, total_transactions long, txns_in_window long,"
        "weekly_purchase_frequency double, category_breadth long, avg_basket_size double,"
        "median_basket_size double, online_ratio double, project_category_txns long,"
        "maintenance_category_txns long, project_ratio double, is_project_buyer int,"
        "promo_purchase_ratio double, avg_discount_depth double, full_price_ratio double,"
        "days_since_last_purchase int, monthly_frequency double, frequency_trend double,"
        "q2_concentration double, weekend_ratio double, total_sessions long,"
        "avg_pages_per_session double, search_rate double, product_page_ratio double,"
        "cart_page_ratio double, mobile_ratio double, deep_browse_ratio double,"
        "loyalty_tier_numeric int, points_balance long",
        required="customer_id",
    ),
    "customer_features_processed": StructType(
        [StructField(name, StringType(), name != "customer_id") for name in CONTEXT_COLUMNS]
        + [StructField(name, DoubleType()) for name in PROCESSED_FEATURES]
    ),
    "segment_assignments": _schema(
        "customer_id string, segment_id long, segment_name string, assignment_date date",
        required="customer_id",
    ),
    "campaign_holdout_results": _schema(
        "campaign_id string, campaign_name string, campaign_channel string, send_date date,"
        "customer_id string, test_group string, segment_used string, new_segment string,"
        "opened long, clicked long, converted long, revenue double",
        required="customer_id",
    ),
    "segment_migration_log": _schema(
        "week long, customers_shifted long, migration_rate double, stability_pass boolean, "
        "refresh_date date"
    ),
}

BASE_TABLES = (
    "customer_master",
    "transactions",
    "web_events",
    "loyalty",
    "old_segments",
    "campaigns",
)


def required_columns(table: str) -> list[str]:
    return [field.name for field in SCHEMAS[table].fields if not field.nullable]


def date_columns(table: str) -> list[str]:
    return [f.name for f in SCHEMAS[table].fields if isinstance(f.dataType, DateType)]


def feature_columns() -> list[str]:
    """The 28 features, in table order."""
    return SCHEMAS["customer_features"].names[2:]
