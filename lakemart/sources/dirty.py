"""The driver's logical tables with the faults that real sources have.

Which row gets which fault follows from its key, so the SQL oracle can name the rows
too. Faulty columns become text, as a CSV source gives them: unparsable dates and
numbers, negative amounts (one that would round to zero), amounts too large for the
money type, NULL keys, types, categories and cities, and repeated keys.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

#: Per table: the changed columns, as expressions over the clean ones.
FAULTS: dict[str, dict[str, str]] = {
    "customers": {
        "customer_id": "CASE WHEN customer_id % 97 = 0 THEN NULL ELSE customer_id END",
        "customer_city": "CASE WHEN customer_id % 7 = 0 THEN NULL ELSE customer_city END",
        "customer_state": "CASE WHEN customer_id % 11 = 0 THEN NULL ELSE customer_state END",
    },
    "orders": {
        "order_status": "CASE WHEN order_id % 23 = 0 THEN NULL ELSE order_status END",
        "order_purchase_timestamp": "CASE WHEN order_id % 17 = 0 THEN 'no date' ELSE CAST(order_purchase_timestamp AS STRING) END",
        "order_delivered_customer_date": (
            "CASE WHEN order_id % 19 = 0 THEN '2020-13-45' ELSE CAST(order_delivered_customer_date AS STRING) END"
        ),
    },
    "order_items": {
        "price": (
            "CASE WHEN (order_id + order_item_id) % 13 = 0 THEN '-5.00' WHEN (order_id + order_item_id) % 17 = 0 THEN '-0.004' "
            "WHEN (order_id + order_item_id) % 19 = 0 THEN '99999999999999999999' WHEN (order_id + order_item_id) % 23 = 0 THEN 'abc' "
            "WHEN (order_id + order_item_id) % 29 = 0 THEN '0.004' ELSE CAST(price AS STRING) END"
        ),
        "freight_value": "CASE WHEN (order_id + order_item_id) % 31 = 0 THEN NULL ELSE CAST(freight_value AS STRING) END",
    },
    "payments": {
        "payment_type": "CASE WHEN order_id % 7 = 0 THEN NULL ELSE payment_type END",
        "payment_value": "CASE WHEN order_id % 11 = 0 THEN 'n/a' ELSE CAST(payment_value AS STRING) END",
    },
    "reviews": {
        "review_score": "CASE WHEN review_id % 13 = 0 THEN 'five' ELSE CAST(review_score AS STRING) END",
        "review_comment_message": "CASE WHEN review_id % 5 = 0 THEN NULL ELSE review_comment_message END",
    },
    "products": {
        "product_category_name": "CASE WHEN product_id % 7 = 0 THEN NULL ELSE product_category_name END",
    },
    "geolocation": {"geolocation_lat": "CAST(geolocation_lat AS STRING)"},
}
#: Rows that come a second time: which, and what differs.
REPEATS: dict[str, tuple[str, dict[str, str]]] = {
    "customers": ("customer_id % 13 = 0", {"customer_city": "'zzz'"}),
    "orders": ("order_id % 29 = 0", {"order_status": "'Z'"}),
    "geolocation": ("TRUE", {"geolocation_lat": "concat(CAST(geolocation_lat AS STRING), '0')"}),
}


def _changed(df: DataFrame, changes: Mapping[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{changes[c]} AS {c}" if c in changes else c for c in df.columns])


def dirty_tables(raw: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """``raw`` with its faults; tables without any are as they were."""
    out = {}
    for name, df in raw.items():
        faults = FAULTS.get(name, {})
        out[name] = _changed(df, faults)
        if name in REPEATS:
            which, changes = REPEATS[name]
            again = _changed(df.where(which), {**faults, **changes})
            out[name] = out[name].unionByName(again)
    return out
