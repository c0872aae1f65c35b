"""The earlier gold layer: eleven summary marts built from silver.

``sales_mart`` is the wide item-grain table; the other marts aggregate it (or
silver directly). Where a mart needs an order-level measure in a cell that holds
several items of one order, it aggregates to (cell, order) first so the order's
payment or review is counted once, then to the cell.

A mart that needs what gold's facts hold is made from them.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemart.functions import scalar as S
from lakemart.params import Params
from lakemart.plans import gold as G
from lakemart.sources.schemas import MONEY_TOTAL

# Column names of the wide mart, as far as they are known.
SALES_MART_COLUMNS = (
    "order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date", "price",
    "freight_value", "customer_id", "order_status", "order_purchase_timestamp", "order_approved_at",
    "order_delivered_carrier_date", "order_delivered_customer_date", "order_estimated_delivery_date",
    "customer_unique_id", "customer_zip_code_prefix", "customer_city", "customer_state",
    "product_category_name", "product_category_name_english", "payment_value",
    "payment_installments_count", "review_score", "category_english", "delivery_days", "year", "month",
)


def _payments_by_order(payments: DataFrame) -> DataFrame:
    return payments.groupBy("order_id").agg(
        F.sum("payment_value").cast(MONEY_TOTAL).alias("payment_value"),
        F.count("payment_installments").alias("payment_installments_count"),
    )


def _reviews_by_order(reviews: DataFrame) -> DataFrame:
    return reviews.groupBy("order_id").agg(
        F.avg("review_score").alias("review_score"),
    )


def order_rows(silver: Mapping[str, DataFrame]) -> DataFrame:
    """Order grain: every order with its columns, its payments' total and count of
    installments, and its average review (NULL where there is none). An order has one row
    in silver already dealt by ``order_id``, and isn't shuffled again."""
    s = silver
    return (
        s["orders"]
        .join(_payments_by_order(s["payments"]), "order_id", "left")
        .join(_reviews_by_order(s["reviews"]), "order_id", "left")
    )


#: Columns beside the wide mart's own, in a stored one that is read by order counts.
MARKS = ("first_of_order", "first_in_category")


def _marked(items: DataFrame) -> DataFrame:
    """Items with the first of their order, and of their order in a category, marked. All
    of an order's items meet the same order row, so the marks hold in the mart too; where
    they are stored, orders are counted without bringing their rows together again."""
    rows = Window.partitionBy("order_id").orderBy("category_english")
    row = F.row_number().over(rows)
    return items.withColumns({"first_of_order": row == 1, "first_in_category": row == F.rank().over(rows)})


def sales_mart(
    silver: Mapping[str, DataFrame], orders: DataFrame | None = None, marked: bool = False
) -> DataFrame:
    """Item grain: items with their order, its customer, payments and reviews, and their
    product with its English category.

    Customers, payments and reviews meet the orders at order grain, and the translation
    the products at product grain, so item rows are shuffled twice only: by product, then
    by order, as the questions that count orders group them. ``orders``: the stored
    ``order_rows``, if they are. ``marked``: with the columns of ``MARKS``."""
    s = silver
    ts = "order_purchase_timestamp"
    orders = order_rows(s) if orders is None else orders
    english = F.col("product_category_name_english")
    products = (
        s["products"]
        .join(s["category_translation"], "product_category_name", "left")
        .select(
            "product_id",
            "product_category_name",
            F.coalesce(english, "product_category_name").alias("category_english"),
            english.isNotNull().alias("translated"),
        )
    )
    items = s["order_items"].join(products, "product_id", "left")
    joined = (_marked(items) if marked else items).join(orders.join(s["customers"], "customer_id"), "order_id")
    return joined.withColumns(
        {
            # not shuffled as a third text an item
            "product_category_name_english": F.when(F.col("translated"), F.col("category_english")),
            "delivery_days": S.calendar_days("order_delivered_customer_date", ts),
            "year": F.year(ts),
            "month": F.month(ts),
        }
    ).select(*SALES_MART_COLUMNS, *(MARKS if marked else ()))


def _has_marks(mart: DataFrame) -> bool:
    return set(MARKS) <= set(mart.columns)


def _orders(mart: DataFrame) -> Column:
    """Count of distinct orders, in groups that hold all rows of an order or none."""
    return F.count_if("first_of_order") if _has_marks(mart) else F.countDistinct("order_id")


CUBE_KEYS = ("year", "month", "customer_state", "category_english", "order_status")


def dashboard_cube(mart: DataFrame, params: Params = Params()) -> DataFrame:
    """(year, month, state, category, status) cells with orders and 4 measures."""
    if _has_marks(mart):
        of_order = {
            c: F.when(F.col("first_in_category"), F.col(c)) for c in ("payment_value", "review_score", "delivery_days")
        }
        return mart.groupBy(*CUBE_KEYS).agg(
            F.count_if("first_in_category").alias("orders"),
            S.as_double(F.sum(F.col("price") + F.col("freight_value"))).alias("revenue"),
            S.as_double(F.sum(of_order["payment_value"])).alias("payment_value"),
            F.round(F.avg(of_order["review_score"]), params.score_digits).alias("avg_review_score"),
            F.avg(of_order["delivery_days"]).alias("avg_delivery_days"),
        )
    per_order = mart.groupBy(*CUBE_KEYS, "order_id").agg(
        F.sum(F.col("price") + F.col("freight_value")).alias("revenue"),
        F.max("payment_value").alias("payment_value"),
        F.max("review_score").alias("avg_review_score"),
        F.max("delivery_days").alias("delivery_days"),
    )
    return per_order.groupBy(*CUBE_KEYS).agg(
        F.count(F.lit(1)).alias("orders"),
        S.as_double(F.sum("revenue")).alias("revenue"),
        S.as_double(F.sum("payment_value")).alias("payment_value"),
        F.round(F.avg("avg_review_score"), params.score_digits).alias("avg_review_score"),
        F.avg("delivery_days").alias("avg_delivery_days"),
    )


def sales_summary(mart: DataFrame) -> DataFrame:
    """Total item revenue, average per item (as the logged value is) and orders."""
    return mart.agg(
        S.as_double(F.sum("price")).alias("total_revenue"),
        S.safe_ratio(S.as_double(F.sum("price")), F.count(F.lit(1))).alias("avg_order_value"),
        _orders(mart).alias("total_orders"),
    )


def revenue_by_state(mart: DataFrame) -> DataFrame:
    return mart.groupBy("customer_state").agg(
        S.as_double(F.sum("price")).alias("total_revenue"),
        _orders(mart).alias("total_orders"),
    )


def top_customers(mart: DataFrame) -> DataFrame:
    """Every customer id ranked by item revenue (no limit; ties by id)."""
    out = mart.groupBy("customer_id").agg(
        F.sum("price").alias("lv"),
        _orders(mart).alias("total_orders"),
    )
    return out.orderBy(F.desc("lv"), "customer_id").select(
        "customer_id", S.as_double("lv").alias("lifetime_value"), "total_orders"
    )


def product_performance(mart: DataFrame) -> DataFrame:
    return mart.groupBy("product_id").agg(
        S.as_double(F.sum("price")).alias("total_revenue"),
        F.count(F.lit(1)).alias("items_sold"),
    )


def monthly_sales(mart: DataFrame) -> DataFrame:
    return mart.groupBy("year", "month").agg(
        S.as_double(F.sum("price")).alias("monthly_revenue")
    ).orderBy("year", "month")


def category_performance(mart: DataFrame) -> DataFrame:
    """An order is counted at the first of its rows in a category. Nearly every item is an
    (order, category) of its own, so a distinct count would keep nearly all rows of a task
    in a map, twice; sorted rows take a fraction of that, and spill."""
    if _has_marks(mart):
        first = F.col("first_in_category")
    else:
        cell = Window.partitionBy("order_id", "category_english").orderBy("order_id")
        first = F.col("order_id").isNotNull() & (F.row_number().over(cell) == 1)
    return mart.select("category_english", "price", first.alias("first")).groupBy("category_english").agg(
        S.as_double(F.sum("price")).alias("total_revenue"),
        F.count(F.lit(1)).alias("items_sold"),
        F.count_if("first").alias("total_orders"),
    )


def payment_mix(payments: DataFrame) -> DataFrame:
    return payments.groupBy("payment_type").agg(
        S.as_double(F.sum("payment_value")).alias("total_payment_value"),
        F.count(F.lit(1)).alias("payments"),
    )


def delivery_performance(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Per customer state: average delivery days over delivered orders (2 digits).

    Orders are summed per customer before the customers join (map-side combined),
    so the join sees one row per customer whatever a single customer's share.
    """
    per_customer = orders.select(
        "customer_id",
        S.calendar_days("order_delivered_customer_date", "order_purchase_timestamp").alias("dd"),
    ).groupBy("customer_id").agg(
        F.sum("dd").alias("s"), F.count("dd").alias("n"), F.count(F.lit(1)).alias("o")
    )
    per_state = per_customer.join(
        customers.select("customer_id", "customer_state"), "customer_id"
    ).groupBy("customer_state").agg(
        F.sum("s").alias("s"), F.sum("n").alias("n"), F.sum("o").alias("total_orders")
    )
    return per_state.select(
        "customer_state",
        S.round_ratio("s", "n", 2).alias("avg_delivery_days"),
        "total_orders",
    )


def customer_segments(
    sales: DataFrame,
    orders: DataFrame,
    customers: DataFrame,
    params: Params = Params(),
    lifetime: DataFrame | None = None,
) -> DataFrame:
    """Person grain: orders, value, average review over their orders, segment.

    ``sales`` and ``orders`` are gold's facts; ``lifetime``, if given, is their lifetime
    value already made. Review averages are summed per customer
    before the customers join (the same pre-aggregation as the lifetime value), so no
    hot customer reaches a join.
    """
    ltv = G.ltv(sales, customers) if lifetime is None else lifetime
    per_customer = orders.groupBy("customer_id").agg(
        F.sum("avg_review_score").alias("rs"), F.count("avg_review_score").alias("rn")
    )
    reviews = (
        per_customer.where("rn > 0")
        .join(customers.select("customer_id", "customer_unique_id"), "customer_id")
        .groupBy("customer_unique_id")
        .agg(S.safe_ratio(F.sum("rs"), F.sum("rn")).alias("avg_review_score"))
    )
    return ltv.join(reviews, "customer_unique_id", "left").select(
        "customer_unique_id",
        "lifetime_orders",
        S.as_double("lifetime_value").alias("lifetime_value"),
        F.round("avg_review_score", params.score_digits).alias("avg_review_score"),
        G.segment(params).alias("customer_segment"),
    )


def build_marts(
    silver: Mapping[str, DataFrame],
    params: Params = Params(),
    mart: DataFrame | None = None,
    gold: Mapping[str, DataFrame] | None = None,
    lifetime: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """All eleven marts; pass a stored ``sales_mart`` (with its marks or without), the gold
    facts and the lifetime values to derive the rest from them."""
    mart = sales_mart(silver) if mart is None else mart
    facts = gold or G.build_facts(silver)
    return {
        "sales_mart": mart.drop(*MARKS),
        "dashboard_cube": dashboard_cube(mart, params),
        "sales_summary": sales_summary(mart),
        "revenue_by_state": revenue_by_state(mart),
        "top_customers": top_customers(mart),
        "product_performance": product_performance(mart),
        "monthly_sales": monthly_sales(mart),
        "category_performance": category_performance(mart),
        "payment_mix": payment_mix(silver["payments"]),
        "delivery_performance": delivery_performance(silver["orders"], silver["customers"]),
        "customer_segments": customer_segments(
            facts["fact_sales"], facts["fact_orders"], silver["customers"], params, lifetime
        ),
    }
