"""The README's keyed star: surrogate keys on dimensions, a payment dimension,
``fact_payments`` and ``fact_order_items`` with ``total_sales = price + freight``.

Surrogate keys are dense and follow natural-key order (``operators.keys``).
Facts carry the surrogate keys by joining the keyed dimensions on the natural
key; which side is broadcast is left to Spark's statistics and AQE, since every
dimension here except the payment types grows with the data.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.operators.keys import with_surrogate_key

#: Rows of a dimension up to which it is broadcast.
BROADCAST_ROWS = 10_000


def keyed_customers(dim_customers: DataFrame) -> DataFrame:
    return with_surrogate_key(dim_customers, "customer_id", "customer_key")


def keyed_products(dim_products: DataFrame) -> DataFrame:
    return with_surrogate_key(dim_products, "product_id", "product_key")


def keyed_sellers(dim_sellers: DataFrame) -> DataFrame:
    return with_surrogate_key(dim_sellers, "seller_id", "seller_key")


def dim_payment(payments: DataFrame) -> DataFrame:
    types = payments.select("payment_type").distinct()
    return with_surrogate_key(types, "payment_type", "payment_type_key")


def fact_payments(payments: DataFrame, dim_payment_df: DataFrame) -> DataFrame:
    """Every payment with the key of its type; a NULL type has a key too.

    The types are counted first: a dimension as small as theirs is broadcast, so that
    payments aren't shuffled by a handful of values; a larger one is left to Spark."""
    types = dim_payment_df.withColumnRenamed("payment_type", "type")
    if types.count() <= BROADCAST_ROWS:
        types = F.broadcast(types)
    joined = payments.join(types, payments["payment_type"].eqNullSafe(types["type"]), "left")
    return joined.select(
        "order_id", "payment_sequential", "payment_type_key", "payment_installments", "payment_value"
    )


def fact_order_items(
    fact_sales: DataFrame,
    customers_k: DataFrame,
    products_k: DataFrame,
    sellers_k: DataFrame,
) -> DataFrame:
    """Item grain with surrogate keys and ``total_sales``.

    Left joins keep an item whose dimension row is missing (its key is NULL).
    """
    return (
        fact_sales.join(customers_k.select("customer_id", "customer_key"), "customer_id", "left")
        .join(products_k.select("product_id", "product_key"), "product_id", "left")
        .join(sellers_k.select("seller_id", "seller_key"), "seller_id", "left")
        .select(
            "order_id", "order_item_id", "customer_key", "product_key", "seller_key", "date_key",
            "price", "freight_value",
            (F.col("price") + F.col("freight_value")).alias("total_sales"),
        )
    )


KEYED_TABLES = (
    "dim_customer", "dim_product", "dim_seller", "dim_payment", "fact_payments", "fact_order_items",
)


def build_keyed_table(
    name: str, silver: Mapping[str, DataFrame], gold: Mapping[str, DataFrame]
) -> DataFrame:
    """One keyed table; only the dimensions it needs are numbered (each numbering
    checkpoints once)."""
    if name == "dim_customer":
        return keyed_customers(gold["dim_customers"])
    if name == "dim_product":
        return keyed_products(gold["dim_products"])
    if name == "dim_seller":
        return keyed_sellers(gold["dim_sellers"])
    if name == "dim_payment":
        return dim_payment(silver["payments"])
    if name == "fact_payments":
        return fact_payments(silver["payments"], dim_payment(silver["payments"]))
    if name == "fact_order_items":
        return fact_order_items(
            gold["fact_sales"],
            keyed_customers(gold["dim_customers"]),
            keyed_products(gold["dim_products"]),
            keyed_sellers(gold["dim_sellers"]),
        )
    raise KeyError(name)


def build_keyed(silver: Mapping[str, DataFrame], gold: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """All keyed tables; each dimension is numbered once and shared with its facts."""
    ck = keyed_customers(gold["dim_customers"])
    pk = keyed_products(gold["dim_products"])
    sk = keyed_sellers(gold["dim_sellers"])
    dp = dim_payment(silver["payments"])
    return {
        "dim_customer": ck,
        "dim_product": pk,
        "dim_seller": sk,
        "dim_payment": dp,
        "fact_payments": fact_payments(silver["payments"], dp),
        "fact_order_items": fact_order_items(gold["fact_sales"], ck, pk, sk),
    }
