"""Distinct counts from a stored cube: any dashboard filter without item rows.

A cell is (year, month, customer_state, category_name, order_status), the columns that
filters name. ``cells`` holds sums per cell. Distinct orders and persons can't be summed
over cells (an order has items of several categories, a person several orders), so each
cell keeps them as exact sets: bitmaps over dense numbers, 32,768 a bitmap. A question ORs
the bitmaps of the cells its filter leaves, bucket by bucket, and counts bits; sets merge,
so cells of further loads are added without touching those there.

``order_sets`` are split by what the funnel asks of an order (paid, delivered in time
known), ``person_sets`` by segment. Orders are numbered in the order of their cell and
persons in the order of state, so that a cell's numbers lie in few buckets: bitmaps are
full rather than many. With numbers from a ``KeyRegistry`` they stay over loads.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.functions import scalar as S
from lakemart.functions.predicates import in_segments, star_filter
from lakemart.operators.keys import with_surrogate_key
from lakemart.params import Params
from lakemart.plans.dashboard import FUNNEL_STAGES, REPEAT_SEGMENTS
from lakemart.sources.files import read_layer, write_layer

CELL = ("year", "month", "customer_state", "category_name", "order_status")
TABLES = ("cells", "order_sets", "person_sets")


def order_numbers(star: DataFrame) -> DataFrame:
    """order_id, order_no: dense, in the order of (year, month, state, status, order_id)."""
    where = ("year", "month", "customer_state", "order_status")
    # these are attributes of the order: one row an order
    orders = star.groupBy("order_id").agg(*[F.first(c).alias(c) for c in where])
    return with_surrogate_key(orders, [*where, "order_id"], "order_no").select("order_id", "order_no")


def person_numbers(star: DataFrame) -> DataFrame:
    """customer_unique_id, person_no: dense, in the order of the least state and id."""
    people = star.where(F.col("customer_unique_id").isNotNull()).groupBy("customer_unique_id")
    placed = people.agg(F.min("customer_state").alias("customer_state"))
    numbered = with_surrogate_key(placed, ["customer_state", "customer_unique_id"], "person_no")
    return numbered.select("customer_unique_id", "person_no")


def _sets(rows: DataFrame, number: str, *more: str) -> DataFrame:
    """Bitmaps of ``number`` a cell and what ``more`` names. Each number is set at its
    position by every item row that holds it: no distinct before. Rows meet their bucket
    before the bitmaps (4 KB each) are made: made first, each task would send one for
    nearly every row, as a task's orders lie in most cells. A bucket's rows are few."""
    bucket = F.bitmap_bucket_number(number).alias("bucket")
    place = F.bitmap_bit_position(number).alias("place")
    dealt = rows.select(*CELL, *more, bucket, place).repartition(*CELL, "bucket")
    return dealt.groupBy(*CELL, *more, "bucket").agg(F.bitmap_construct_agg("place").alias("bitmap"))


def build_cube(star: DataFrame, orders: DataFrame | None = None, persons: DataFrame | None = None) -> dict[str, DataFrame]:
    """The cube's tables from star rows; the numbers are made here unless given."""
    orders = order_numbers(star) if orders is None else orders
    persons = person_numbers(star) if persons is None else persons
    cells = star.groupBy(*CELL).agg(
        F.sum(F.col("price") + F.col("freight_value")).alias("revenue"),
        F.count(F.lit(1)).alias("items"),
        F.count("delivery_days").alias("n_dd"),
        F.sum("delivery_days").alias("s_dd"),
        F.count("avg_review_score").alias("n_rv"),
        F.sum("avg_review_score").alias("s_rv"),
    )
    by_order = star.select(
        "order_id", *CELL,
        F.coalesce(F.col("total_payment_value") > 0, F.lit(False)).alias("paid"),
        F.col("delivery_days").isNotNull().alias("delivered"),
    ).join(orders, "order_id")
    by_person = star.select("customer_unique_id", "customer_segment", *CELL).join(persons, "customer_unique_id", "left")
    return {
        "cells": cells,
        "order_sets": _sets(by_order, "order_no", "paid", "delivered"),
        "person_sets": _sets(by_person, "person_no", "customer_segment"),
    }


def store_cube(spark: SparkSession, star: DataFrame, base: str) -> dict[str, DataFrame]:
    """The cube written beside the other layers, a folder a month."""
    for name, df in build_cube(star).items():
        write_layer(df, base, "cube", name, partition_by=("year", "month"))
    return read_cube(spark, base)


def read_cube(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    return {name: read_layer(spark, base, "cube", name) for name in TABLES}


def _united(sets: DataFrame, *by: str) -> DataFrame:
    """Bits a group and bucket over all cells that hold it."""
    merged = sets.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    return merged.select(*by, F.bitmap_count("bitmap").alias("n"))


def kpis(cube: Mapping[str, DataFrame], params: Params = Params(), **filt) -> DataFrame:
    """As ``dashboard.kpis``."""
    chosen = star_filter(**filt)
    sums = cube["cells"].where(chosen).agg(*[F.sum(c).alias(c) for c in ("revenue", "n_dd", "s_dd", "n_rv", "s_rv")])
    # an order has one status: orders of different statuses never meet
    done = F.coalesce(F.col("order_status") == F.lit(params.delivered_status), F.lit(False))
    orders = _united(cube["order_sets"].where(chosen).withColumn("done", done), "done").agg(
        F.sum("n").alias("n_orders"), F.sum(F.when(F.col("done"), F.col("n")).otherwise(0)).alias("n_done")
    )
    repeat = F.coalesce(in_segments(REPEAT_SEGMENTS), F.lit(False))
    persons = _united(cube["person_sets"].where(chosen).withColumn("repeat", repeat), "repeat").agg(
        F.sum("n").alias("n_persons"), F.sum(F.when(F.col("repeat"), F.col("n")).otherwise(0)).alias("n_repeat")
    )
    stacked = sums.unionByName(orders, allowMissingColumns=True).unionByName(persons, allowMissingColumns=True)
    total = stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])  # three rows into one
    return total.select(
        S.as_double("revenue").alias("total_revenue"),
        F.coalesce(F.col("n_orders"), F.lit(0)).cast("bigint").alias("total_orders"),
        F.coalesce(F.col("n_persons"), F.lit(0)).cast("bigint").alias("total_customers"),
        S.safe_ratio("s_dd", "n_dd").alias("avg_delivery_days"),
        F.round(S.safe_ratio("s_rv", "n_rv"), params.score_digits).alias("avg_review_score"),
        S.safe_pct("n_done", "n_orders").alias("conversion_rate"),
        S.safe_pct("n_repeat", "n_persons").alias("repeat_rate"),
    )


def segments(cube: Mapping[str, DataFrame], **filt) -> DataFrame:
    """As ``dashboard.segments``."""
    per_bucket = _united(cube["person_sets"].where(star_filter(**filt)), "customer_segment")
    return per_bucket.groupBy("customer_segment").agg(F.sum("n").alias("customers"))


def monthly_trend(cube: Mapping[str, DataFrame], **filt) -> DataFrame:
    """As ``dashboard.monthly_trend``."""
    chosen, month = star_filter(**filt), ("year", "month")
    revenue = cube["cells"].where(chosen).groupBy(*month).agg(F.sum("revenue").alias("revenue"))
    orders = _united(cube["order_sets"].where(chosen), *month).groupBy(*month).agg(F.sum("n").alias("orders"))
    both = revenue.unionByName(orders, allowMissingColumns=True).groupBy(*month)
    out = both.agg(S.as_double(F.max("revenue")).alias("revenue"), F.max("orders").alias("orders"))
    return out.withColumn("month_label", S.month_label(*month)).orderBy(*month)


def funnel(cube: Mapping[str, DataFrame], **filt) -> DataFrame:
    """As ``dashboard.funnel``."""
    orders = _united(cube["order_sets"].where(star_filter(**filt)), "paid", "delivered")
    stages = [F.lit(True), F.col("paid"), F.col("delivered")]
    wide = orders.agg(*[F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0)).alias(f"s{i}") for i, c in enumerate(stages)])
    named = [
        F.struct(F.lit(i + 1).alias("stage_no"), F.lit(name).alias("stage"), F.col(f"s{i}").cast("bigint").alias("orders"))
        for i, name in enumerate(FUNNEL_STAGES)
    ]
    long = wide.select(F.col("s0").alias("created"), F.explode(F.array(*named)).alias("st"))
    return long.select("st.stage_no", "st.stage", "st.orders", S.safe_pct("st.orders", "created").alias("pct_of_created"))
