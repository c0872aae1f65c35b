"""Silver layer: one cleaner per raw table, then ``build_silver``.

Each cleaner is a pure DataFrame -> DataFrame function in the reference's rule
order. Keys are kept in the type the source gives (text from CSV, integers from
the driver tables); all measures, coordinates and timestamps are converted.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.operators.columns import (
    conform,
    fill_defaults,
    filter_non_negative,
    standardize_columns,
)
from lakemart.operators.dedup import dedup, distinct_rows
from lakemart.sources.schemas import MONEY

TS = T.TimestampType()


def clean_customers(df: DataFrame, needed: Sequence[str] | None = None) -> DataFrame:
    df = dedup(standardize_columns(df), ["customer_id"], needed=needed)
    return fill_defaults(df, {"customer_city": "unknown", "customer_state": "unknown"})


def clean_orders(df: DataFrame, needed: Sequence[str] | None = None) -> DataFrame:
    stamps = (
        "order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
        "order_delivered_customer_date", "order_estimated_delivery_date",
    )
    return dedup(conform(standardize_columns(df), dict.fromkeys(stamps, TS)), ["order_id"], needed=needed)


AMOUNTS = ("price", "freight_value")


def _amounts_checked(df: DataFrame) -> tuple[DataFrame, Column]:
    """Items whose amounts, as parsed, are not negative (unparsable ones go), and whether
    all of them fit the money type."""
    df = standardize_columns(df)
    text = [c for c in AMOUNTS if isinstance(df.schema[c].dataType, T.StringType)]
    parsed = df.withColumns({f"__{c}": F.col(c).try_cast("double") for c in text})
    parsed = filter_non_negative(parsed, [f"__{c}" if c in text else c for c in AMOUNTS])
    fits = F.lit(True)
    for c in AMOUNTS:
        fits = fits & F.col(c).try_cast(MONEY).isNotNull()
    return parsed.drop(*[f"__{c}" for c in text]), fits


def clean_order_items(df: DataFrame) -> DataFrame:
    """Amounts are tested as they are parsed, before they are rounded to money; those too
    large for it are in ``rejected_order_items``."""
    kept, fits = _amounts_checked(df)
    types = {"order_item_id": T.IntegerType(), "shipping_limit_date": TS, "price": MONEY, "freight_value": MONEY}
    return conform(kept.where(fits), types)


def rejected_order_items(df: DataFrame) -> DataFrame:
    """Items with amounts that are numbers, not negative, but too large for the money type."""
    kept, fits = _amounts_checked(df)
    return kept.where(~fits)


def clean_payments(df: DataFrame) -> DataFrame:
    return conform(
        standardize_columns(df),
        {
            "payment_sequential": T.IntegerType(),
            "payment_installments": T.IntegerType(),
            "payment_value": MONEY,
        },
    )


def clean_products(df: DataFrame) -> DataFrame:
    return standardize_columns(df).select("product_id", "product_category_name")


def clean_category_translation(df: DataFrame) -> DataFrame:
    return standardize_columns(df)


def clean_sellers(df: DataFrame) -> DataFrame:
    return standardize_columns(df)


def clean_reviews(df: DataFrame, needed: Sequence[str] | None = None) -> DataFrame:
    # dedup comes before the casts, as in the reference
    df = dedup(standardize_columns(df), ["review_id"], needed=needed)
    df = conform(
        df,
        {"review_score": T.IntegerType(), "review_creation_date": TS, "review_answer_timestamp": TS},
    )
    return fill_defaults(df, {"review_comment_title": "", "review_comment_message": ""})


def clean_geolocation(df: DataFrame) -> DataFrame:
    numbers = dict.fromkeys(("geolocation_lat", "geolocation_lng"), T.DoubleType())
    return distinct_rows(conform(standardize_columns(df), numbers))


CLEANERS = {
    "customers": clean_customers,
    "orders": clean_orders,
    "order_items": clean_order_items,
    "payments": clean_payments,
    "products": clean_products,
    "category_translation": clean_category_translation,
    "sellers": clean_sellers,
    "reviews": clean_reviews,
    "geolocation": clean_geolocation,
}


def build_silver(raw: Mapping[str, DataFrame], needed: Mapping[str, Sequence[str]] | None = None) -> dict[str, DataFrame]:
    """Silver plans for every raw table present (lazy; nothing runs here). ``needed``: for
    tables without repeated keys, the columns that are read of them besides the key, so
    that the others aren't shuffled to find the repeats."""
    reads = {name: {"needed": columns} for name, columns in (needed or {}).items()}
    return {name: CLEANERS[name](df, **reads.get(name, {})) for name, df in raw.items() if name in CLEANERS}
