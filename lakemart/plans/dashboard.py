"""Dashboard queries over the star (D1-D9) and the README's seller / region views.

Every query takes the item-grain ``star`` DataFrame and the optional filter
(state, year, category, status). Money is summed exactly (DECIMAL) and turned
into double at the end.

Distinct counts: a query with several COUNT(DISTINCT ...) over different
expressions makes Spark expand every input row once per expression. The KPI and
funnel queries instead aggregate to order grain first (map-side combined, one
row per order), then to person grain, then globally; every step shrinks the
data, and no step needs a distinct.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakemart.functions import scalar as S
from lakemart.functions.predicates import (
    freight_outlier,
    in_segments,
    severe_delay,
    star_filter,
    year_lifted,
)
from lakemart.params import Params

# The segments that count as repeat customers.
REPEAT_SEGMENTS = ("High Value", "Repeat")


def _revenue():
    return F.col("price") + F.col("freight_value")


def _filtered(star: DataFrame, state=None, year=None, category=None, status=None) -> DataFrame:
    return star.where(star_filter(state, year, category, status))


# D1 -------------------------------------------------------------------------------

def filter_states(gold) -> DataFrame:
    return (
        gold["dim_customers"].where(F.col("customer_state").isNotNull())
        .select("customer_state").distinct().orderBy("customer_state")
    )


def filter_years(gold) -> DataFrame:
    return (
        gold["dim_date"].where(F.col("year").isNotNull())
        .select("year").distinct().orderBy(F.desc("year"))
    )


def filter_categories(gold) -> DataFrame:
    return (
        gold["dim_products"].where(F.col("category_name").isNotNull())
        .select("category_name").distinct().orderBy("category_name")
    )


def filter_statuses(orders: DataFrame) -> DataFrame:
    """From silver's orders (``fact_orders`` keeps every one of them): no payments or
    reviews are read for a list of statuses."""
    return (
        orders.where(F.col("order_status").isNotNull())
        .select("order_status").distinct().orderBy("order_status")
    )


# D2 -------------------------------------------------------------------------------

def _order_grain(s: DataFrame) -> DataFrame:
    """One row per order; order-level attributes are functions of order_id."""
    return s.groupBy(
        "order_id", "customer_unique_id", "customer_segment", "order_status"
    ).agg(
        F.sum(_revenue()).alias("revenue"),
        F.count(F.lit(1)).alias("n_items"),
        F.count("delivery_days").alias("n_dd"),
        F.sum("delivery_days").alias("s_dd"),
        F.count("avg_review_score").alias("n_rv"),
        F.sum("avg_review_score").alias("s_rv"),
    )


def kpis(star: DataFrame, params: Params = Params(), **filt) -> DataFrame:
    """Revenue, orders, persons, item-grain averages, conversion and repeat rates."""
    per_order = _order_grain(_filtered(star, **filt))
    delivered = (F.col("order_status") == F.lit(params.delivered_status)).cast("int")
    per_person = per_order.groupBy("customer_unique_id", "customer_segment").agg(
        F.sum("revenue").alias("revenue"),
        F.count(F.lit(1)).alias("n_orders"),
        F.sum(delivered).alias("n_delivered"),
        F.sum("n_dd").alias("n_dd"),
        F.sum("s_dd").alias("s_dd"),
        F.sum("n_rv").alias("n_rv"),
        F.sum("s_rv").alias("s_rv"),
    )
    person = F.col("customer_unique_id").isNotNull()
    repeat = person & in_segments(REPEAT_SEGMENTS)
    total = per_person.agg(
        F.sum("revenue").alias("revenue"),
        F.sum("n_orders").alias("n_orders"),
        F.sum("n_delivered").alias("n_delivered"),
        F.count_if(person).alias("n_persons"),
        F.count_if(repeat).alias("n_repeat"),
        F.sum("n_dd").alias("n_dd"),
        F.sum("s_dd").alias("s_dd"),
        F.sum("n_rv").alias("n_rv"),
        F.sum("s_rv").alias("s_rv"),
    )
    return total.select(
        S.as_double("revenue").alias("total_revenue"),
        F.coalesce(F.col("n_orders"), F.lit(0)).cast("bigint").alias("total_orders"),
        F.col("n_persons").cast("bigint").alias("total_customers"),
        S.safe_ratio("s_dd", "n_dd").alias("avg_delivery_days"),
        F.round(S.safe_ratio("s_rv", "n_rv"), params.score_digits).alias("avg_review_score"),
        S.safe_pct("n_delivered", "n_orders").alias("conversion_rate"),
        S.safe_pct("n_repeat", "n_persons").alias("repeat_rate"),
    )


# D3 / D4 --------------------------------------------------------------------------

def monthly_trend(star: DataFrame, **filt) -> DataFrame:
    out = _filtered(star, **filt).groupBy("year", "month").agg(
        S.as_double(F.sum(_revenue())).alias("revenue"),
        F.countDistinct("order_id").alias("orders"),
    )
    return out.withColumn("month_label", S.month_label("year", "month")).orderBy("year", "month")


def year_over_year(star: DataFrame, state=None, year=None, category=None, status=None) -> DataFrame:
    out = star.where(year_lifted(state, year, category, status)).groupBy("year", "month").agg(
        S.as_double(F.sum(_revenue())).alias("revenue")
    )
    return out.orderBy("month", F.desc("year"))


# D5 / D6 --------------------------------------------------------------------------

def top_categories(star: DataFrame, params: Params = Params(), **filt) -> DataFrame:
    """The k categories with most revenue; ties broken by name."""
    out = (
        _filtered(star, **filt)
        .where(F.col("category_name").isNotNull())
        .groupBy("category_name")
        .agg(F.sum(_revenue()).alias("revenue"))
    )
    top = out.orderBy(F.desc("revenue"), F.asc("category_name")).limit(params.top_k)
    return top.select("category_name", S.as_double("revenue").alias("revenue"))


def segments(star: DataFrame, **filt) -> DataFrame:
    return _filtered(star, **filt).groupBy("customer_segment").agg(
        F.countDistinct("customer_unique_id").alias("customers")
    )


# D7 -------------------------------------------------------------------------------

# The stages' names.
FUNNEL_STAGES = ("Orders Created", "Payments Cleared", "Orders Delivered")


def funnel(star: DataFrame, **filt) -> DataFrame:
    """Created / paid / delivered orders in long form with share of created."""
    per_order = _filtered(star, **filt).groupBy("order_id").agg(
        F.max((F.col("total_payment_value") > 0).cast("int")).alias("paid"),
        F.max(F.col("delivery_days").isNotNull().cast("int")).alias("delivered"),
    )
    wide = per_order.agg(
        F.count(F.lit(1)).alias("s1"),
        F.coalesce(F.sum("paid"), F.lit(0)).alias("s2"),
        F.coalesce(F.sum("delivered"), F.lit(0)).alias("s3"),
    )
    long = wide.select(
        F.col("s1").alias("created"),
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(i + 1).alias("stage_no"),
                        F.lit(name).alias("stage"),
                        F.col(f"s{i + 1}").cast("bigint").alias("orders"),
                    )
                    for i, name in enumerate(FUNNEL_STAGES)
                ]
            )
        ).alias("st"),
    )
    return long.select(
        "st.stage_no", "st.stage", "st.orders",
        S.safe_pct("st.orders", "created").alias("pct_of_created"),
    )


# D8 / D9 --------------------------------------------------------------------------

def freight_outliers(star: DataFrame, params: Params = Params(), **filt) -> DataFrame:
    return (
        _filtered(star, **filt)
        .where(freight_outlier(params.freight_ratio))
        .agg(F.count("order_id").alias("high_freight_items"))
    )


def severe_delays(star: DataFrame, params: Params = Params(), **filt) -> DataFrame:
    """Counts items (as the reference's query does) and distinct orders."""
    late = _filtered(star, **filt).where(severe_delay(params.severe_delay_days))
    return late.agg(
        F.count("order_id").alias("severe_delay_items"),
        F.countDistinct("order_id").alias("severe_delay_orders"),
    )


# README views ----------------------------------------------------------------------

def seller_performance(star: DataFrame, **filt) -> DataFrame:
    return _filtered(star, **filt).groupBy("seller_id").agg(
        S.as_double(F.sum(_revenue())).alias("revenue"),
        F.count(F.lit(1)).alias("items"),
        F.countDistinct("order_id").alias("orders"),
    )


def headline_counts(star: DataFrame, **filt) -> DataFrame:
    """Revenue, orders, customers and sellers tiles in one row.

    No multi-distinct Expand: orders and persons come from the order -> person
    pre-aggregation, sellers from their own distinct; the two one-row results
    are stacked and folded into one row (no join).
    """
    s = _filtered(star, **filt)
    per_order = s.groupBy("order_id", "customer_unique_id").agg(F.sum(_revenue()).alias("rev"))
    per_person = per_order.groupBy("customer_unique_id").agg(
        F.sum("rev").alias("rev"), F.count(F.lit(1)).alias("n")
    )
    a = per_person.agg(
        F.sum("rev").alias("revenue"),
        F.sum("n").alias("orders"),
        F.count_if(F.col("customer_unique_id").isNotNull()).alias("customers"),
    )
    b = (
        s.where(F.col("seller_id").isNotNull())
        .select("seller_id").distinct()
        .agg(F.count(F.lit(1)).alias("sellers"))
    )
    both = a.unionByName(b, allowMissingColumns=True)
    return both.agg(
        S.as_double(F.max("revenue")).alias("revenue"),
        F.coalesce(F.max("orders"), F.lit(0)).cast("bigint").alias("orders"),
        F.coalesce(F.max("customers"), F.lit(0)).cast("bigint").alias("customers"),
        F.coalesce(F.max("sellers"), F.lit(0)).cast("bigint").alias("sellers"),
    )


def region_distribution(star: DataFrame, params: Params = Params(), **filt) -> DataFrame:
    """Revenue and orders per customer state with the state's share of revenue (in percent,
    to ``share_digits`` decimals).

    The share divides by a window total over the already aggregated rows (one
    per state), never over raw rows.
    """
    by_state = _filtered(star, **filt).groupBy("customer_state").agg(
        F.sum(_revenue()).alias("rev"),
        F.countDistinct("order_id").alias("orders"),
    )
    total = F.sum("rev").over(Window.partitionBy())
    return by_state.select(
        "customer_state",
        S.as_double("rev").alias("revenue"),
        "orders",
        F.round(S.safe_pct("rev", total), params.share_digits).alias("revenue_share_pct"),
    )


class Dashboard:
    """All dashboard questions over a stored gold layer.

    Reads ``<base>/gold/star`` (partitioned by year, month) and the gold tables
    behind the filter lists. ``cache=True`` keeps the star in executor memory and
    disk for repeated questions (the reference caches query results); leave it off
    when the star is larger than the cluster's storage memory, then every question
    is a pruned scan of the stored star. Filters: state, year, category, status
    (``None`` or ``"All"`` = no condition).
    """

    def __init__(self, spark, base: str, params: Params = Params(), cache: bool = False):
        from lakemart.sources.files import GOLD_TABLES, cached, read_layer

        self.params = params
        self.gold = {t: read_layer(spark, base, "gold", t) for t in GOLD_TABLES}
        star = read_layer(spark, base, "gold", "star")
        self.star = cached(star) if cache else star

    @classmethod
    def of(cls, gold: Mapping[str, DataFrame], params: Params = Params()) -> "Dashboard":
        """Over gold tables already read, ``star`` among them: those of a pinned
        version, say."""
        made = cls.__new__(cls)
        made.params, made.gold, made.star = params, dict(gold), gold["star"]
        return made

    def filters(self) -> dict[str, DataFrame]:
        return {
            "states": filter_states(self.gold),
            "years": filter_years(self.gold),
            "categories": filter_categories(self.gold),
            "statuses": filter_statuses(self.gold["fact_orders"]),  # stored: a scan of one column
        }

    def kpis(self, **filt) -> DataFrame:
        return kpis(self.star, self.params, **filt)

    def monthly_trend(self, **filt) -> DataFrame:
        return monthly_trend(self.star, **filt)

    def year_over_year(self, **filt) -> DataFrame:
        return year_over_year(self.star, **filt)

    def top_categories(self, **filt) -> DataFrame:
        return top_categories(self.star, self.params, **filt)

    def segments(self, **filt) -> DataFrame:
        return segments(self.star, **filt)

    def funnel(self, **filt) -> DataFrame:
        return funnel(self.star, **filt)

    def freight_outliers(self, **filt) -> DataFrame:
        return freight_outliers(self.star, self.params, **filt)

    def severe_delays(self, **filt) -> DataFrame:
        return severe_delays(self.star, self.params, **filt)

    def seller_performance(self, **filt) -> DataFrame:
        return seller_performance(self.star, **filt)

    def headline_counts(self, **filt) -> DataFrame:
        return headline_counts(self.star, **filt)

    def region_distribution(self, **filt) -> DataFrame:
        return region_distribution(self.star, self.params, **filt)

    def close(self) -> None:
        self.star.unpersist()
