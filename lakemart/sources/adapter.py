"""Driver tables -> the nine logical raw tables of the retail lake.

The driver's test data is TPC-H-like (customer, orders, lineitem, part, supplier,
nation). Each logical table takes real columns where they fit and otherwise a
deterministic formula that the SQL oracle computes the same way:

  customers     id = c_custkey, person = c_custkey div 2, city = c_mktsegment,
                state = n_name
  orders        purchase = o_orderdate; delivered = purchase + (o_orderkey % 40)
                days unless status 'O' (open)
  order_items   price = l_extendedprice, freight = round(price * l_tax, 2)
  payments      one per order: value = o_totalprice, type = o_orderpriority
  reviews       one per line item, id = l_orderkey * 10 + l_linenumber (not
                unique, which exercises dedup); score R->1, A->3, N->5
  products      category = p_brand
  translation   english name for brands 1..20 only (exercises the fallback)
  sellers       s_suppkey, city = s_name, state = n_name
  geolocation   customer x nation attributes, full of exact duplicates

Everything is column expressions, so reading only some logical columns prunes
the Parquet scan. ``nation`` is tiny; whether it is broadcast is left to Spark's size
estimate of its file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.sources.schemas import MONEY

DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
)

LOGICAL_TABLES = (
    "customers", "orders", "order_items", "payments", "reviews", "products",
    "category_translation", "sellers", "geolocation",
)

# Review score for each line-item return flag.
SCORE_BY_RETURNFLAG = {"R": 1, "A": 3, "N": 5}
# Brands numbered up to this value get an English category name.
TRANSLATED_BRANDS_MAX = 20
DELIVERY_SPREAD_DAYS = 40


def read_driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _zip(col: str):
    return F.lpad(F.col(col).cast("string"), 5, "0")


def _nation(spark, sf_dir):
    return read_driver_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_driver_table(spark, sf_dir, "customer")
    return c.join(_nation(spark, sf_dir), c.c_nationkey == F.col("n_nationkey"), "left").select(
        F.col("c_custkey").alias("customer_id"),
        F.expr("c_custkey div 2").alias("customer_unique_id"),
        _zip("c_nationkey").alias("customer_zip_code_prefix"),
        F.col("c_mktsegment").alias("customer_city"),
        F.col("n_name").alias("customer_state"),
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_driver_table(spark, sf_dir, "orders")
    days = (F.col("o_orderkey") % DELIVERY_SPREAD_DAYS).cast("int")
    delivered = F.when(
        F.col("o_orderstatus") != "O", F.col("o_orderdate") + F.make_dt_interval(days=days)
    )
    return o.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_orderdate").alias("order_purchase_timestamp"),
        F.col("o_orderdate").alias("order_approved_at"),
        F.lit(None).cast(o.schema["o_orderdate"].dataType).alias("order_delivered_carrier_date"),
        delivered.alias("order_delivered_customer_date"),
        F.lit(None).cast(o.schema["o_orderdate"].dataType).alias("order_estimated_delivery_date"),
    )


def _price():
    return F.col("l_extendedprice").cast(MONEY)


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_driver_table(spark, sf_dir, "lineitem")
    freight = F.round(_price() * F.col("l_tax").cast("decimal(4,2)"), 2).cast(MONEY)
    return li.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        F.col("l_shipdate").alias("shipping_limit_date"),
        _price().alias("price"),
        freight.alias("freight_value"),
    )


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_driver_table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("order_id"),
        F.lit(1).alias("payment_sequential"),
        F.col("o_orderpriority").alias("payment_type"),
        (F.col("o_orderkey") % 10 + 1).cast("int").alias("payment_installments"),
        F.col("o_totalprice").cast(MONEY).alias("payment_value"),
    )


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_driver_table(spark, sf_dir, "lineitem")
    score = F.lit(None).cast("int")
    for flag, value in SCORE_BY_RETURNFLAG.items():
        score = F.when(F.col("l_returnflag") == flag, F.lit(value)).otherwise(score)
    return li.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("review_id"),
        F.col("l_orderkey").alias("order_id"),
        score.alias("review_score"),
        F.lit(None).cast("string").alias("review_comment_title"),
        F.col("l_linestatus").alias("review_comment_message"),
        F.col("l_shipdate").alias("review_creation_date"),
        F.col("l_shipdate").alias("review_answer_timestamp"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_driver_table(spark, sf_dir, "part")
    none = F.lit(None).cast("int")
    return p.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_brand").alias("product_category_name"),
        F.length("p_name").alias("product_name_lenght"),
        none.alias("product_description_lenght"),
        none.alias("product_photos_qty"),
        F.col("p_size").alias("product_weight_g"),
        none.alias("product_length_cm"),
        none.alias("product_height_cm"),
        none.alias("product_width_cm"),
    )


def brand_number(col: str = "product_category_name"):
    return F.regexp_extract(F.col(col), r"(\d+)$", 1).try_cast("int")


def category_translation(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_driver_table(spark, sf_dir, "part")
    brands = p.select(F.col("p_brand").alias("product_category_name")).distinct()
    return brands.where(brand_number() <= TRANSLATED_BRANDS_MAX).select(
        "product_category_name",
        F.concat(F.lit("brand_"), brand_number().cast("string")).alias("product_category_name_english"),
    )


def sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read_driver_table(spark, sf_dir, "supplier")
    return s.join(_nation(spark, sf_dir), s.s_nationkey == F.col("n_nationkey"), "left").select(
        F.col("s_suppkey").alias("seller_id"),
        _zip("s_nationkey").alias("seller_zip_code_prefix"),
        F.col("s_name").alias("seller_city"),
        F.col("n_name").alias("seller_state"),
    )


def geolocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_driver_table(spark, sf_dir, "customer")
    return c.join(_nation(spark, sf_dir), c.c_nationkey == F.col("n_nationkey"), "left").select(
        _zip("c_nationkey").alias("geolocation_zip_code_prefix"),
        F.col("n_regionkey").cast("double").alias("geolocation_lat"),
        F.col("c_nationkey").cast("double").alias("geolocation_lng"),
        F.col("c_mktsegment").alias("geolocation_city"),
        F.col("n_name").alias("geolocation_state"),
    )


_BUILDERS = {
    "customers": customers,
    "orders": orders,
    "order_items": order_items,
    "payments": payments,
    "reviews": reviews,
    "products": products,
    "category_translation": category_translation,
    "sellers": sellers,
    "geolocation": geolocation,
}


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All nine logical raw tables (lazy DataFrames) over the driver's Parquet."""
    return {name: build(spark, sf_dir) for name, build in _BUILDERS.items()}
