"""Declared schemas and the raw-file catalogue.

Raw CSVs are bound by their headers to these columns, never inferred: inference costs one
extra pass per file and reads zip-code prefixes as numbers (losing leading zeros).
Columns are declared as strings at the CSV boundary where the source can hold bad
values; the silver cleaners convert them leniently (``try_cast``), so a bad value
becomes NULL instead of failing the job under ANSI mode.

Money is ``DECIMAL(18,2)`` from silver on: sums are exact and do not depend on
task order; results convert to double at the very end.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
# Totals of money use the widest decimal (what SQL engines give SUM of money), so a
# total cannot overflow at any data volume.
MONEY_TOTAL = T.DecimalType(38, 2)

S = T.StringType()


def _schema(*cols: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in cols])


# Raw (bronze) layouts. Everything is text at the raw boundary; typed in silver.
RAW_SCHEMAS: dict[str, T.StructType] = {
    "customers": _schema(
        ("customer_id", S), ("customer_unique_id", S), ("customer_zip_code_prefix", S),
        ("customer_city", S), ("customer_state", S),
    ),
    "orders": _schema(
        ("order_id", S), ("customer_id", S), ("order_status", S),
        ("order_purchase_timestamp", S), ("order_approved_at", S),
        ("order_delivered_carrier_date", S), ("order_delivered_customer_date", S),
        ("order_estimated_delivery_date", S),
    ),
    "order_items": _schema(
        ("order_id", S), ("order_item_id", S), ("product_id", S), ("seller_id", S),
        ("shipping_limit_date", S), ("price", S), ("freight_value", S),
    ),
    "payments": _schema(
        ("order_id", S), ("payment_sequential", S), ("payment_type", S),
        ("payment_installments", S), ("payment_value", S),
    ),
    "reviews": _schema(
        ("review_id", S), ("order_id", S), ("review_score", S),
        ("review_comment_title", S), ("review_comment_message", S),
        ("review_creation_date", S), ("review_answer_timestamp", S),
    ),
    "products": _schema(
        ("product_id", S), ("product_category_name", S), ("product_name_lenght", S),
        ("product_description_lenght", S), ("product_photos_qty", S),
        ("product_weight_g", S), ("product_length_cm", S), ("product_height_cm", S),
        ("product_width_cm", S),
    ),
    "sellers": _schema(
        ("seller_id", S), ("seller_zip_code_prefix", S), ("seller_city", S), ("seller_state", S),
    ),
    "geolocation": _schema(
        ("geolocation_zip_code_prefix", S), ("geolocation_lat", S), ("geolocation_lng", S),
        ("geolocation_city", S), ("geolocation_state", S),
    ),
    "category_translation": _schema(
        ("product_category_name", S), ("product_category_name_english", S),
    ),
}


@dataclass(frozen=True)
class DatasetSpec:
    """One raw table: its file name, declared layout, the columns that a file of it must
    have, and reader options."""

    table: str
    file: str
    schema: T.StructType
    required: tuple[str, ...] = ()
    multiline: bool = False
    options: dict = field(default_factory=dict)


# Raw file names of the nine source tables, as the source publishes them.
RAW_FILES = {
    "customers": "olist_customers_dataset.csv",
    "orders": "olist_orders_dataset.csv",
    "order_items": "olist_order_items_dataset.csv",
    "payments": "olist_order_payments_dataset.csv",
    "reviews": "olist_order_reviews_dataset.csv",
    "products": "olist_products_dataset.csv",
    "sellers": "olist_sellers_dataset.csv",
    "geolocation": "olist_geolocation_dataset.csv",
    "category_translation": "product_category_name_translation.csv",
}

# Columns without which a file of the table is of no use.
REQUIRED = {
    "customers": ("customer_id", "customer_unique_id"),
    "orders": ("order_id", "customer_id", "order_purchase_timestamp"),
    "order_items": ("order_id", "product_id", "price", "freight_value"),
    "payments": ("order_id", "payment_type", "payment_value"),
    "reviews": ("review_id", "order_id", "review_score"),
    "products": ("product_id", "product_category_name"),
    "sellers": ("seller_id",),
    "geolocation": ("geolocation_zip_code_prefix",),
    "category_translation": ("product_category_name", "product_category_name_english"),
}

# Silver primary keys (None = no single-column key).
SILVER_KEYS: dict[str, str | None] = {
    "customers": "customer_id",
    "orders": "order_id",
    "order_items": None,
    "payments": None,
    "products": "product_id",
    "sellers": "seller_id",
    "category_translation": "product_category_name",
    "reviews": "review_id",
    "geolocation": None,
}

CATALOGUE: dict[str, DatasetSpec] = {
    name: DatasetSpec(
        table=name,
        file=RAW_FILES[name],
        schema=RAW_SCHEMAS[name],
        required=REQUIRED[name],
        # review comments hold quoted newlines; a line reader would split them
        multiline=(name == "reviews"),
    )
    for name in RAW_FILES
}

# Gold numeric columns whose minimum must not be negative (quality check V4).
GOLD_METRICS: dict[str, tuple[str, ...]] = {
    "dim_date": (),
    "dim_customers": ("lifetime_orders", "lifetime_value"),
    "dim_products": (),
    "dim_sellers": (),
    "fact_sales": ("price", "freight_value"),
    "fact_orders": ("delivery_days", "total_payment_value", "avg_review_score"),
    "sales_mart": ("price", "freight_value", "payment_value", "delivery_days"),
    "dashboard_cube": ("revenue", "payment_value", "avg_delivery_days"),
    "sales_summary": ("total_revenue", "avg_order_value"),
    "revenue_by_state": ("total_revenue",),
    "top_customers": ("lifetime_value",),
    "product_performance": ("total_revenue",),
    "monthly_sales": ("monthly_revenue",),
    "category_performance": ("total_revenue",),
    "payment_mix": ("total_payment_value",),
    "delivery_performance": ("avg_delivery_days",),
    "customer_segments": ("lifetime_value",),
}
