"""Column normalising, lenient conversion, filters, fills and dedup."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import types as T

from lakemart.operators.columns import (
    conform,
    fill_defaults,
    filter_non_negative,
    standardize_columns,
)
from lakemart.operators.dedup import dedup, distinct_rows
from lakemart.plans import silver as SV
from lakemart.sources.schemas import MONEY


def test_standardize_columns(spark):
    df = spark.createDataFrame([(1, 2, 3)], [" Review ID ", "Order  Id", "SCORE"])
    assert standardize_columns(df).columns == ["review_id", "order__id", "score"]


def test_standardize_columns_clash_raises(spark):
    df = spark.createDataFrame([(1, 2)], ["Review Id", "review_id"])
    with pytest.raises(ValueError):
        standardize_columns(df)


def test_conform_is_lenient(spark):
    df = spark.createDataFrame(
        [("abc", "not a date", "12.5"), ("", "", ""), ("4", "2018-01-02 10:00:00", "-1")],
        "score string, ts string, price string",
    )
    out = conform(df, {"score": T.IntegerType(), "ts": T.TimestampType(), "price": MONEY})
    rows = out.collect()
    assert [r.score for r in rows] == [None, None, 4]
    assert rows[0].ts is None and rows[1].ts is None
    assert rows[2].ts == dt.datetime(2018, 1, 2, 10, 0)
    assert [r.price for r in rows] == [Decimal("12.50"), None, Decimal("-1.00")]


def test_conform_keeps_typed_columns(spark):
    df = spark.createDataFrame([(dt.datetime(2020, 1, 1), 3)], "ts timestamp, n int")
    out = conform(df, {"ts": T.TimestampType(), "n": T.IntegerType(), "absent": T.IntegerType()})
    assert out.collect()[0].asDict() == {"ts": dt.datetime(2020, 1, 1), "n": 3}


def test_filter_non_negative_drops_null_and_negative(spark):
    df = spark.createDataFrame(
        [(1, -1.0, 0.0), (2, 0.0, 0.0), (3, None, 1.0), (4, 5.0, None), (5, 2.0, -0.5)],
        "id int, price double, freight_value double",
    )
    kept = [r.id for r in filter_non_negative(df, ["price", "freight_value"]).collect()]
    assert kept == [2]


def test_fill_defaults(spark):
    df = spark.createDataFrame([(None, "SP"), ("x", None)], "customer_city string, customer_state string")
    out = fill_defaults(df, {"customer_city": "unknown", "customer_state": "unknown", "zz": "q"})
    assert [tuple(r) for r in out.collect()] == [("unknown", "SP"), ("x", "unknown")]


def test_dedup_keeps_smallest_row_and_one_null_key(spark):
    df = spark.createDataFrame(
        [("r1", "b", 5), ("r1", "a", 3), ("r1", "a", 1), (None, "x", 1), (None, "y", 2), ("r2", "c", 4)],
        "review_id string, order_id string, score int",
    )
    out = {r.review_id: (r.order_id, r.score) for r in dedup(df, ["review_id"]).collect()}
    assert out == {"r1": ("a", 1), None: ("x", 1), "r2": ("c", 4)}
    ordered = {r.review_id: r.order_id for r in dedup(df, ["review_id"], order_by=["score"]).collect()}
    assert ordered["r1"] == "a"
    assert dedup(df, ["review_id"]).columns == df.columns


def test_distinct_rows(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "a")], "k int, v string")
    assert distinct_rows(df).count() == 2


def test_clean_reviews_dedup_before_cast(spark):
    raw = spark.createDataFrame(
        [
            ("R1", "o1", "5", None, None, "2018-01-01 00:00:00", "bad"),
            ("R1", "o1", "abc", "t", "m", "2018-01-02 00:00:00", "2018-01-03 00:00:00"),
            ("R2", "o2", "abc", None, "line1\nline2", "not a date", None),
        ],
        "review_id string, order_id string, review_score string, review_comment_title string, "
        "review_comment_message string, review_creation_date string, review_answer_timestamp string",
    )
    out = {r.review_id: r for r in SV.clean_reviews(raw).collect()}
    assert set(out) == {"R1", "R2"}
    # '5' < 'abc' as text: the survivor is chosen before the cast
    assert out["R1"].review_score == 5 and out["R1"].review_comment_title == ""
    assert out["R1"].review_answer_timestamp is None
    assert out["R2"].review_score is None and out["R2"].review_creation_date is None
    assert out["R2"].review_comment_message == "line1\nline2"


def test_clean_products_keeps_two_columns_no_dedup(spark):
    raw = spark.createDataFrame([("p1", "a", "1"), ("p1", "b", "2")], "product_id string, product_category_name string, x string")
    out = SV.clean_products(raw)
    assert out.columns == ["product_id", "product_category_name"] and out.count() == 2


def test_clean_customers_dedup_then_fill(spark):
    raw = spark.createDataFrame(
        [("c1", "p1", "01000", None, "SP"), ("c1", "p1", "01000", "rio", "RJ"), ("c2", "p2", "02000", "x", None)],
        "customer_id string, customer_unique_id string, customer_zip_code_prefix string, "
        "customer_city string, customer_state string",
    )
    out = {r.customer_id: (r.customer_city, r.customer_state) for r in SV.clean_customers(raw).collect()}
    # survivor is the first row in column order (NULL city sorts first), then filled
    assert out == {"c1": ("unknown", "SP"), "c2": ("x", "unknown")}


def test_clean_orders_parses_its_timestamps_and_dedups(spark):
    raw = spark.createDataFrame(
        [
            ("o1", "c1", "delivered", "2018-01-01 10:00:00", "2018-01-01 11:00:00", "y", "2018-01-03 09:00:00", "z"),
            ("o1", "c1", "delivered", "2018-01-01 10:00:00", "2018-01-01 11:00:00", "y", "bad", "z"),
            ("o2", "c2", "shipped", "not a date", None, None, None, None),
        ],
        ", ".join(f"{c} string" for c in [
            "order_id", "customer_id", "order_status", "order_purchase_timestamp", "order_approved_at",
            "order_delivered_carrier_date", "order_delivered_customer_date", "order_estimated_delivery_date",
        ]),
    )
    out = {r.order_id: r for r in SV.clean_orders(raw).collect()}
    assert len(out) == 2
    assert out["o2"].order_purchase_timestamp is None
    assert str(out["o1"].order_approved_at) == "2018-01-01 11:00:00"
    assert out["o1"].order_delivered_carrier_date is None and out["o1"].order_estimated_delivery_date is None
    # parsed before dedup: the unparsable delivered date is NULL, which sorts first
    assert out["o1"].order_delivered_customer_date is None


def test_clean_order_items_casts_and_filters(spark):
    raw = spark.createDataFrame(
        [("o1", "1", "p", "s", None, "10.5", "1"), ("o1", "2", "p", "s", None, "-1", "1"),
         ("o2", "x", "p", "s", None, "abc", "2")],
        "order_id string, order_item_id string, product_id string, seller_id string, "
        "shipping_limit_date string, price string, freight_value string",
    )
    out = SV.clean_order_items(raw).collect()
    assert [(r.order_item_id, float(r.price)) for r in out] == [(1, 10.5)]


def test_order_items_are_filtered_before_they_are_rounded(spark):
    amounts = ["-0.004", "0.004", "0", "1e3", "99999999999999999999.00", "-1e30", "", None, "NaN"]
    raw = spark.createDataFrame(
        [("o", str(i), "p", "s", None, a, "1") for i, a in enumerate(amounts)],
        "order_id string, order_item_id string, product_id string, seller_id string, "
        "shipping_limit_date string, price string, freight_value string",
    )
    kept = {r.order_item_id: float(r.price) for r in SV.clean_order_items(raw).collect()}
    assert kept == {1: 0.0, 2: 0.0, 3: 1000.0}
    # too large for the money type: set apart, not lost
    assert {r.order_item_id for r in SV.rejected_order_items(raw).collect()} == {"4", "8"}
    typed = raw.withColumn("price", raw.price.try_cast("double")).withColumn("freight_value", raw.freight_value.try_cast("double"))
    assert {r.order_item_id for r in SV.clean_order_items(typed).collect()} == {1, 2, 3}


def test_dedup_carries_map_columns(spark):
    df = spark.createDataFrame(
        [("k", 2, {"a": 1}), ("k", 1, {"b": 2}), ("j", 5, None)], "key string, n int, props map<string,int>"
    )
    out = {r.key: (r.n, r.props) for r in dedup(df, ["key"]).collect()}
    assert out == {"k": (1, {"b": 2}), "j": (5, None)}
