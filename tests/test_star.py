"""Gold star and dashboard semantics on a hand-made silver layer.

Persons: p1 owns two customer ids (c1, c2) and exactly 1000 of item value
(High Value on both ids); p3 has two orders worth 35 (Emerging); p4 never
ordered (NULL LTV, Emerging); p5 has exactly three orders (Repeat).
"""

import datetime as dt
from decimal import Decimal as Dec

import pytest

from lakemart.params import Params
from lakemart.plans import dashboard as D
from lakemart.plans.lake import Lake

T = dt.datetime
ORDERS_SCHEMA = (
    "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp, "
    "order_approved_at timestamp, order_delivered_carrier_date timestamp, "
    "order_delivered_customer_date timestamp, order_estimated_delivery_date timestamp"
)


def _o(oid, cid, status, bought, delivered):
    return (oid, cid, status, bought, None, None, delivered, None)


@pytest.fixture(scope="module")
def silver(spark):
    cf = spark.createDataFrame
    customers = cf(
        [
            ("c1", "p1", "01000", "sao paulo", "SP"),
            ("c2", "p1", "02000", "rio", "RJ"),
            ("c3", "p3", "01001", "sao paulo", "SP"),
            ("c4", "p4", "03000", "bh", "MG"),
            ("c5", "p5", "01002", "sao paulo", "SP"),
        ],
        "customer_id string, customer_unique_id string, customer_zip_code_prefix string, "
        "customer_city string, customer_state string",
    )
    orders = cf(
        [
            _o("o1", "c1", "delivered", T(2018, 1, 1, 23, 50), T(2018, 1, 2, 0, 10)),
            _o("o2", "c2", "delivered", T(2018, 1, 5, 10), T(2018, 1, 4, 9)),
            _o("o3", "c3", "shipped", T(2018, 2, 1), None),
            _o("o4", "c3", "canceled", None, None),
            _o("o5", "c1", "delivered", T(2018, 3, 1), T(2018, 3, 3)),
            _o("o6", "c5", "delivered", T(2018, 3, 2), T(2018, 3, 12)),
            _o("o7", "c5", "delivered", T(2018, 3, 3), T(2018, 3, 13)),
            _o("o8", "c5", "delivered", T(2018, 4, 1), T(2018, 5, 1)),
        ],
        ORDERS_SCHEMA,
    )
    items = cf(
        [
            ("o1", 1, "pa", "s1", None, Dec("400.00"), Dec("10.00")),
            ("o1", 2, "pb", "s1", None, Dec("300.00"), Dec("10.00")),
            ("o2", 1, "pa", "s2", None, Dec("300.00"), Dec("200.00")),
            ("o3", 1, "pc", "s1", None, Dec("10.00"), Dec("1.00")),
            ("o3", 2, "pc", "s1", None, Dec("10.00"), Dec("1.00")),
            ("o3", 3, "pc", "s1", None, Dec("10.00"), Dec("1.00")),
            ("o4", 1, "pa", "s1", None, Dec("5.00"), Dec("0.00")),
            ("o6", 1, "pb", "s2", None, Dec("1.00"), Dec("0.00")),
            ("o7", 1, "pb", "s2", None, Dec("1.00"), Dec("0.00")),
            ("o8", 1, "pz", "s2", None, Dec("1.00"), Dec("0.00")),
            ("ox", 1, "pa", "s1", None, Dec("99.00"), Dec("0.00")),
        ],
        "order_id string, order_item_id int, product_id string, seller_id string, "
        "shipping_limit_date timestamp, price decimal(18,2), freight_value decimal(18,2)",
    )
    payments = cf(
        [("o1", 1, "card", 1, Dec("100.00")), ("o1", 2, "voucher", 1, Dec("50.00")),
         ("o2", 1, "card", 2, Dec("500.00")), ("o3", 1, "card", 1, Dec("0.00"))],
        "order_id string, payment_sequential int, payment_type string, payment_installments int, "
        "payment_value decimal(18,2)",
    )
    reviews = cf(
        [("r1", "o1", 5, "", "", None, None), ("r2", "o1", 4, "", "", None, None),
         ("r3", "o2", 3, "", "", None, None), ("r4", None, 1, "", "", None, None)],
        "review_id string, order_id string, review_score int, review_comment_title string, "
        "review_comment_message string, review_creation_date timestamp, review_answer_timestamp timestamp",
    )
    products = cf(
        [("pa", "beleza"), ("pb", "cama"), ("pc", None)],
        "product_id string, product_category_name string",
    )
    translation = cf(
        [("beleza", "health_beauty")],
        "product_category_name string, product_category_name_english string",
    )
    sellers = cf([("s1", "1", "x", "SP"), ("s2", "2", "y", "RJ")],
                 "seller_id string, seller_zip_code_prefix string, seller_city string, seller_state string")
    return {
        "customers": customers, "orders": orders, "order_items": items, "payments": payments,
        "reviews": reviews, "products": products, "category_translation": translation,
        "sellers": sellers,
    }


@pytest.fixture(scope="module")
def lake(silver):
    lk = Lake({}, Params())
    lk.__dict__["silver"] = silver
    return lk


def test_dim_customers_segments(lake):
    rows = {r.customer_id: r for r in lake.gold["dim_customers"].collect()}
    assert rows["c1"].customer_segment == rows["c2"].customer_segment == "High Value"
    assert rows["c1"].lifetime_value == Dec("1000.00") and rows["c1"].lifetime_orders == 2
    assert rows["c3"].customer_segment == "Emerging" and rows["c3"].lifetime_orders == 2
    assert rows["c4"].lifetime_value is None and rows["c4"].customer_segment == "Emerging"
    assert rows["c5"].customer_segment == "Repeat" and rows["c5"].lifetime_orders == 3


def test_dim_products_translation(lake):
    rows = {r.product_id: r.category_name for r in lake.gold["dim_products"].collect()}
    assert rows == {"pa": "health_beauty", "pb": "cama", "pc": None}


def test_dim_date(lake):
    rows = {r.date_key: r for r in lake.gold["dim_date"].collect()}
    assert None not in rows and len(rows) == 7
    assert rows["2018-01-01"].day_of_week == "Mon" and rows["2018-01-01"].year == 2018


def test_fact_tables(lake):
    fs = lake.gold["fact_sales"]
    assert fs.count() == 10 and fs.where("order_id = 'ox'").count() == 0
    fo = {r.order_id: r for r in lake.gold["fact_orders"].collect()}
    assert len(fo) == 8
    assert fo["o1"].delivery_days == 1  # 23:50 -> 00:10 next day
    assert fo["o2"].delivery_days == -1
    assert fo["o3"].delivery_days is None and fo["o4"].delivery_days is None
    assert fo["o1"].total_payment_value == Dec("150.00") and fo["o1"].avg_review_score == 4.5
    assert fo["o5"].total_payment_value is None and fo["o5"].avg_review_score is None


def test_star_drops_null_date_and_missing_product(lake):
    ids = sorted(r.order_id for r in lake.star.collect())
    assert ids == ["o1", "o1", "o2", "o3", "o3", "o3", "o6", "o7"]


def test_kpis(lake):
    k = D.kpis(lake.star, Params()).collect()[0]
    assert k.total_revenue == pytest.approx(1000 + 20 + 200 + 30 + 3 + 2)
    assert k.total_orders == 5 and k.total_customers == 3
    # item grain: o1 twice (1), o2 (-1), o3 x3 (NULL), o6 and o7 (10)
    assert k.avg_delivery_days == pytest.approx((1 + 1 - 1 + 10 + 10) / 5)
    # reviews: o1 x2 (4.5), o2 (3.0)
    assert k.avg_review_score == pytest.approx((4.5 * 2 + 3.0) / 3)
    assert k.conversion_rate == pytest.approx(4 * 100 / 5)
    assert k.repeat_rate == pytest.approx(2 * 100 / 3)


def test_kpis_no_match_gives_null_ratios(lake):
    k = D.kpis(lake.star, Params(), state="NOWHERE").collect()[0]
    assert k.total_orders == 0 and k.total_revenue is None
    assert k.conversion_rate is None and k.repeat_rate is None and k.avg_delivery_days is None


def test_filters_and_year_lift(lake):
    t = D.monthly_trend(lake.star, state="SP").collect()
    assert [(r.month_label, r.orders) for r in t] == [("2018-01", 1), ("2018-02", 1), ("2018-03", 2)]
    yoy = D.year_over_year(lake.star, year=2017).collect()
    assert len(yoy) == 3  # the year condition is lifted


def test_top_categories_and_segments(lake):
    top = D.top_categories(lake.star, Params(top_k=1)).collect()
    assert [(r.category_name, r.revenue) for r in top] == [("health_beauty", 910.0)]
    seg = {r.customer_segment: r.customers for r in D.segments(lake.star).collect()}
    assert seg == {"High Value": 1, "Emerging": 1, "Repeat": 1}


def test_funnel_and_anomalies(lake):
    f = [(r.stage_no, r.orders) for r in D.funnel(lake.star).orderBy("stage_no").collect()]
    assert f == [(1, 5), (2, 2), (3, 4)]
    fr = D.freight_outliers(lake.star, Params(freight_ratio=0.5)).collect()[0]
    assert fr.high_freight_items == 1  # o2: 200 > 150
    late = D.severe_delays(lake.star, Params(severe_delay_days=5)).collect()[0]
    assert (late.severe_delay_items, late.severe_delay_orders) == (2, 2)


def test_customer_segments_with_only_null_review_scores(spark, silver):
    from lakemart.plans.gold import build_facts
    from lakemart.plans.marts import customer_segments

    reviews = spark.createDataFrame(
        [("r1", "o6", None, "", "", None, None)],
        "review_id string, order_id string, review_score int, review_comment_title string, "
        "review_comment_message string, review_creation_date timestamp, review_answer_timestamp timestamp",
    )
    facts = build_facts({**silver, "reviews": reviews})
    marts = customer_segments(facts["fact_sales"], facts["fact_orders"], silver["customers"])
    rows = {r.customer_unique_id: r for r in marts.collect()}
    assert rows["p5"].avg_review_score is None and rows["p5"].customer_segment == "Repeat"


def test_the_lazy_star_leaves_unread_columns_out_of_the_shuffles(spark):
    """Columns behind the last one read decide nothing; the rows are those of whole silver."""
    from lakemart.operators.dedup import dedup
    from lakemart.plans import gold as G
    from lakemart.plans.lake import Lake

    df = spark.createDataFrame(
        [(1, 5, "b", "x"), (1, 5, "a", "y"), (1, None, "z", "z"), (2, 7, None, "q"), (None, 1, "n", "n"), (2, 7, "c", "a")],
        "k int, a int, b string, c string",
    )
    for needed in (["a"], ["b"], ["a", "b"], ["c"], []):
        want = sorted(map(str, dedup(df, ["k"]).select("k", *needed).collect()))
        assert sorted(map(str, dedup(df, ["k"], needed=needed).collect())) == want
    lk = Lake.from_driver(spark, "/root/testdata/sf0.001")
    plan = lk.star._jdf.queryExecution().optimizedPlan().toString()
    assert "review_score" in plan and "review_comment_message" not in plan and "review_answer_timestamp" not in plan
    whole = G.build_gold(lk.silver, lk.params)
    joined = whole["fact_sales"].join(whole["fact_orders"].select("order_id", "order_status"), "order_id")
    assert lk.star.count() == joined.count()
    assert lk.star.exceptAll(G.star(whole)).isEmpty() and G.star(whole).exceptAll(lk.star).isEmpty()
    assert lk.gold["dim_customers"].exceptAll(
        G.dim_customers(lk.silver["customers"], G.ltv(whole["fact_sales"], lk.silver["customers"]), lk.params)
    ).isEmpty()


def test_category_performance_counts_orders_without_a_map_of_them(spark):
    """an order counts once a category, with NULL orders, NULL categories and repeats."""
    from lakemart.plans.marts import category_performance

    rows = [("o1", "a", Dec("1")), ("o1", "a", Dec("2")), ("o1", None, Dec("3")), ("o2", "a", Dec("4")),
            ("o2", None, None), (None, "a", Dec("5")), (None, None, Dec("6")), (None, "b", Dec("7"))]
    mart = spark.createDataFrame(rows, "order_id string, category_english string, price decimal(18,2)")
    got = category_performance(mart)
    assert {tuple(r) for r in got.collect()} == {("a", 12.0, 4, 2), (None, 9.0, 3, 2), ("b", 7.0, 1, 0)}
    plan = got._jdf.queryExecution().sparkPlan().toString()
    assert not [x for x in plan.splitlines() if "HashAggregate(" in x and "order_id" in x.split("functions=")[0]]


def test_gold_and_marts_over_stored_steps_are_those_of_the_lazy_plans(spark, silver, scratch):
    """the plans share stored order rows and a stored mart in which orders are marked;
    a product that comes twice, one of no category and two categories of one English name."""
    from lakemart.plans.build import gold_and_marts
    from lakemart.plans.marts import MARKS, build_marts, sales_mart

    cf = spark.createDataFrame
    raw = {
        **silver,
        "products": cf([("pa", "x"), ("pa", "y"), ("pb", "z"), ("pc", None), ("pd", "w")],
                       "product_id string, product_category_name string"),
        "category_translation": cf([("x", "toys"), ("z", "toys"), ("w", None)],
                                   "product_category_name string, product_category_name_english string"),
        "payments": cf([("o1", 1, "card", None, Dec("5.00")), ("o1", 2, "cash", 2, Dec("7.00")), ("o2", 1, None, 1, None),
                        (None, 1, "cash", 1, Dec("9.00"))],
                       "order_id string, payment_sequential int, payment_type string, payment_installments int, "
                       "payment_value decimal(18,2)"),
        "order_items": silver["order_items"].union(
            cf([("o1", 7, "pa", "s1", None, Dec("1.00"), Dec("2.00")), ("o6", 8, "pc", "s1", None, Dec("3.00"), Dec("0.00")),
                ("o6", 9, None, "s1", None, Dec("3.00"), Dec("0.00")), (None, 1, "pa", "s1", None, Dec("3.00"), Dec("0.00")),
                ("o6", 9, "pd", None, None, Dec("4.00"), Dec("0.00"))], silver["order_items"].schema)
        ),
    }
    lk = Lake(raw)
    want = {**lk.gold, **build_marts(lk.silver)}
    got = gold_and_marts(spark, raw, scratch)
    assert list(got) == list(want)
    for name, df in want.items():
        assert got[name].columns == df.columns, name
        assert sorted(map(str, got[name].collect())) == sorted(map(str, df.collect())), name
    shared = ("sales_mart", "dashboard_cube", "sales_summary", "revenue_by_state", "top_customers",
              "product_performance", "monthly_sales", "category_performance")
    for name in shared:  # no item is joined again, no order's rows are brought together again
        plan = got[name]._jdf.queryExecution().sparkPlan().toString()
        assert "Join" not in plan and "order_id" not in "".join(x.split("functions=")[0] for x in plan.splitlines() if "HashAggregate(" in x)
    marked = sales_mart(lk.silver, marked=True)
    assert marked.where("first_of_order").count() == marked.select("order_id").distinct().count()
    assert marked.where("first_in_category").count() == marked.select("order_id", "category_english").distinct().count()
    assert set(MARKS).isdisjoint(got["sales_mart"].columns)
