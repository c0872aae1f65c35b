"""Registered queries: name -> Spark query over the driver tables, and its SQL.

Every Spark query builds the whole lake lazily from the driver's Parquet files
(adapter -> silver -> gold -> star) and runs over complete tables. The matching
SQL in ``ORACLE`` restates the same computation for DuckDB.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as _F

from lakemart import oracle as O
from lakemart.params import DRIVER_PARAMS as P
from lakemart.plans import dashboard as D
from lakemart.plans.lake import Lake
from lakemart.session import scratch_root, shuffles_dropped

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def lake(spark: SparkSession, sf_dir: str) -> Lake:
    return Lake.from_driver(spark, sf_dir, P)


def star(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lake(spark, sf_dir).star


# Filter settings exercised by the filtered variants (values present in the data).
F_STATE_YEAR = {"state": "NATION_7", "year": 1997}
F_CAT_STATUS = {"category": "brand_3", "status": "F"}
F_ALL4 = {"state": "NATION_1", "year": 1998, "category": "Brand#22", "status": "F"}
F_NONE_MATCH = {"state": "NO_SUCH_STATE"}


# ---- D1 filter lists ---------------------------------------------------------------

def _choices(table: str, column: str, order: str = "") -> str:
    return O.with_base(f"SELECT {column} FROM {table} GROUP BY {column} HAVING {column} IS NOT NULL ORDER BY {column} {order}")


register("filter_states", _choices("s_customers", "customer_state"))(
    lambda spark, d: D.filter_states(lake(spark, d).gold)
)
register("filter_years", _choices("dim_date", "year", "DESC"))(lambda spark, d: D.filter_years(lake(spark, d).gold))
register("filter_categories", _choices("dim_products", "category_name"))(
    lambda spark, d: D.filter_categories(lake(spark, d).gold)
)
register("filter_statuses", _choices("s_orders", "order_status"))(
    lambda spark, d: D.filter_statuses(lake(spark, d).silver["orders"])
)


# ---- D2-D9: the SQL asks the orders in scope (O.scope), the plans ask the star -----

def _kpi_sql(**filt) -> str:
    return O.with_base(O.scope(**filt) + f""", persons AS (
  SELECT customer_unique_id, bool_or(customer_segment IN ('High Value', 'Repeat')) AS again
  FROM hit WHERE customer_unique_id IS NOT NULL GROUP BY customer_unique_id),
p AS (SELECT COUNT(*) AS n_persons, COUNT(*) FILTER (WHERE again) AS n_again FROM persons),
t AS (
  SELECT SUM(revenue) AS revenue, COUNT(*) AS n_orders,
         COUNT(*) FILTER (WHERE order_status = '{P.delivered_status}') AS n_delivered,
         SUM(delivery_days * n) AS days, SUM(n) FILTER (WHERE delivery_days IS NOT NULL) AS n_days,
         SUM(avg_review_score * n) AS score, SUM(n) FILTER (WHERE avg_review_score IS NOT NULL) AS n_score
  FROM hit)
SELECT CAST(revenue AS DOUBLE) AS total_revenue, n_orders AS total_orders, n_persons AS total_customers,
       CAST(days AS DOUBLE) / n_days AS avg_delivery_days, ROUND(score / n_score, {P.score_digits}) AS avg_review_score,
       n_delivered * 100.0 / NULLIF(n_orders, 0) AS conversion_rate,
       n_again * 100.0 / NULLIF(n_persons, 0) AS repeat_rate
FROM t, p""")


def _trend_sql(**filt) -> str:
    return O.with_base(O.scope(**filt) + """
SELECT year, month, CAST(SUM(revenue) AS DOUBLE) AS revenue, COUNT(*) AS orders,
       printf('%d-%02d', year, month) AS month_label
FROM hit GROUP BY year, month ORDER BY year, month""")


def _yoy_sql(state=None, category=None, status=None, year=None) -> str:
    # every year is compared, whatever year is chosen
    return O.with_base(O.scope(state=state, category=category, status=status) + """
SELECT year, month, CAST(SUM(revenue) AS DOUBLE) AS revenue
FROM hit GROUP BY year, month ORDER BY month, year DESC""")


def _topcat_sql(**filt) -> str:
    return O.with_base(O.scope(**filt) + f"""
SELECT category_name, CAST(total AS DOUBLE) AS revenue
FROM (SELECT category_name, SUM(paid) AS total FROM sold GROUP BY category_name)
WHERE category_name IS NOT NULL
QUALIFY ROW_NUMBER() OVER (ORDER BY total DESC, category_name) <= {P.top_k}""")


def _seg_sql(**filt) -> str:
    return O.with_base(O.scope(**filt) + """
SELECT customer_segment, COUNT(customer_unique_id) AS customers
FROM (SELECT customer_segment, customer_unique_id FROM hit GROUP BY ALL) GROUP BY customer_segment""")


def _funnel_sql(**filt) -> str:
    return O.with_base(O.scope(**filt) + """, f AS (
  SELECT COUNT(*) AS created, COUNT(*) FILTER (WHERE total_payment_value > 0) AS cleared,
         COUNT(delivery_days) AS delivered FROM hit)
SELECT stage_no, stage, orders, orders * 100.0 / NULLIF(created, 0) AS pct_of_created
FROM (SELECT created, unnest([
        {'stage_no': 1, 'stage': 'Orders Created', 'orders': created},
        {'stage_no': 2, 'stage': 'Payments Cleared', 'orders': cleared},
        {'stage_no': 3, 'stage': 'Orders Delivered', 'orders': delivered}], recursive := true) FROM f)""")


def _freight_sql(**filt) -> str:
    return O.with_base(O.scope(**filt) + f"""
SELECT COUNT(*) AS high_freight_items FROM sold
WHERE order_id IS NOT NULL AND freight_value > price * {P.freight_ratio}""")


def _delay_sql(**filt) -> str:
    return O.with_base(O.scope(**filt) + f"""
SELECT CAST(COALESCE(SUM(n), 0) AS BIGINT) AS severe_delay_items, COUNT(*) AS severe_delay_orders
FROM hit WHERE delivery_days > {P.severe_delay_days}""")


#: question: its SQL, its plan over the star, and the filter settings it is asked with
QUESTIONS = {
    "kpis": (_kpi_sql, lambda s, f: D.kpis(s, P, **f), {"": {}, "state_year": F_STATE_YEAR, "category_status": F_CAT_STATUS, "no_match": F_NONE_MATCH}),
    "monthly_trend": (_trend_sql, lambda s, f: D.monthly_trend(s, **f), {"": {}, "category_status": F_CAT_STATUS}),
    "year_over_year": (_yoy_sql, lambda s, f: D.year_over_year(s, **f), {"": {}, "state_year": F_STATE_YEAR}),
    "top_categories": (_topcat_sql, lambda s, f: D.top_categories(s, P, **f), {"": {}, "state_year": F_STATE_YEAR}),
    "segments": (_seg_sql, lambda s, f: D.segments(s, **f), {"": {}, "category_status": F_CAT_STATUS}),
    "funnel": (_funnel_sql, lambda s, f: D.funnel(s, **f), {"": {}, "all_filters": F_ALL4}),
    "freight_outliers": (_freight_sql, lambda s, f: D.freight_outliers(s, P, **f), {"": {}, "state_year": F_STATE_YEAR}),
    "severe_delays": (_delay_sql, lambda s, f: D.severe_delays(s, P, **f), {"": {}, "category_status": F_CAT_STATUS}),
}

for _question, (_sql_of, _plan_of, _settings) in QUESTIONS.items():
    for _setting, _filt in _settings.items():
        register(f"{_question}_{_setting}".rstrip("_"), _sql_of(**_filt))(
            lambda spark, d, _p=_plan_of, _f=_filt: _p(star(spark, d), _f)
        )


# ---- silver tables (T1-T9) and gold star tables (G1-G8) -------------------------------

SILVER_SQL = {
    "customers": "s_customers",
    "orders": "s_orders",
    "order_items": "s_items",
    "payments": "s_payments",
    "reviews": "s_reviews",
    "products": "s_products",
    "category_translation": "s_translation",
    "sellers": "s_sellers",
    "geolocation": "s_geolocation",
}

for _t, _cte in SILVER_SQL.items():
    register(f"silver_{_t}", O.with_base(f"SELECT * FROM {_cte}"))(
        lambda spark, d, _t=_t: lake(spark, d).silver[_t]
    )

GOLD_SQL = {
    "dim_date": "SELECT * FROM dim_date",
    "dim_customers": "SELECT * FROM dim_customers",
    "dim_products": "SELECT * FROM dim_products",
    "dim_sellers": "SELECT * FROM s_sellers",
    "fact_sales": "SELECT * FROM fact_sales",
    "fact_orders": "SELECT * FROM fact_orders",
}

for _t, _sql in GOLD_SQL.items():
    register(f"gold_{_t}", O.with_base(_sql))(lambda spark, d, _t=_t: lake(spark, d).gold[_t])

register(
    "gold_ltv",
    O.with_base("SELECT customer_unique_id, lifetime_orders, lifetime_value FROM ltv"),
)(lambda spark, d: _ltv(spark, d))


def _ltv(spark, d):
    from lakemart.plans.gold import ltv

    lk = lake(spark, d)
    return ltv(lk.gold["fact_sales"], lk.silver["customers"])


register("gold_star", O.with_base(O.scope() + """
SELECT order_id, order_item_id, product_id, seller_id, customer_id, date_key, price, freight_value,
       order_status, delivery_days, total_payment_value, avg_review_score, customer_unique_id,
       customer_state, customer_segment, category_name, year, month
FROM itm JOIN ord USING (order_id)"""))(lambda spark, d: star(spark, d))


# ---- summary marts (M1-M11) ----------------------------------------------------------

def marts(spark, d):
    from lakemart.plans.marts import build_marts

    return build_marts(lake(spark, d).silver, P)


MART_SQL = {
    "sales_mart": "SELECT * FROM sales_mart",
    "dashboard_cube": f"""
SELECT year, month, customer_state, category_english, order_status, COUNT(*) AS orders,
       CAST(SUM(revenue) AS DOUBLE) AS revenue, CAST(SUM(payment_value) AS DOUBLE) AS payment_value,
       ROUND(AVG(avg_review_score), {P.score_digits}) AS avg_review_score, AVG(delivery_days) AS avg_delivery_days
FROM (SELECT year, month, customer_state, category_english, order_status, order_id,
             SUM(price + freight_value) AS revenue, MAX(payment_value) AS payment_value,
             MAX(review_score) AS avg_review_score, MAX(delivery_days) AS delivery_days
      FROM sales_mart GROUP BY year, month, customer_state, category_english, order_status, order_id)
GROUP BY year, month, customer_state, category_english, order_status""",
    "sales_summary": """
SELECT CAST(SUM(price) AS DOUBLE) AS total_revenue,
       CAST(SUM(price) AS DOUBLE) / COUNT(*) AS avg_order_value,
       COUNT(DISTINCT order_id) AS total_orders FROM sales_mart""",
    "revenue_by_state": """
SELECT customer_state, CAST(SUM(price) AS DOUBLE) AS total_revenue,
       COUNT(DISTINCT order_id) AS total_orders FROM sales_mart GROUP BY customer_state""",
    "top_customers": """
SELECT customer_id, CAST(SUM(price) AS DOUBLE) AS lifetime_value,
       COUNT(DISTINCT order_id) AS total_orders
FROM sales_mart GROUP BY customer_id ORDER BY SUM(price) DESC, customer_id""",
    "product_performance": """
SELECT product_id, CAST(SUM(price) AS DOUBLE) AS total_revenue, COUNT(*) AS items_sold
FROM sales_mart GROUP BY product_id""",
    "monthly_sales": """
SELECT year, month, CAST(SUM(price) AS DOUBLE) AS monthly_revenue
FROM sales_mart GROUP BY year, month ORDER BY year, month""",
    "category_performance": """
SELECT category_english, CAST(SUM(price) AS DOUBLE) AS total_revenue, COUNT(*) AS items_sold,
       COUNT(DISTINCT order_id) AS total_orders FROM sales_mart GROUP BY category_english""",
    "payment_mix": """
SELECT payment_type, CAST(SUM(payment_value) AS DOUBLE) AS total_payment_value, COUNT(*) AS payments
FROM s_payments GROUP BY payment_type""",
    "delivery_performance": """
SELECT customer_state,
       sign(SUM(dd)) * floor((abs(SUM(dd)) * 200 + COUNT(dd)) / (2 * NULLIF(COUNT(dd), 0))) / 100.0
         AS avg_delivery_days,
       COUNT(*) AS total_orders
FROM (SELECT c.customer_state,
             CAST(date_diff('day', CAST(o.order_purchase_timestamp AS DATE),
                            CAST(o.order_delivered_customer_date AS DATE)) AS INTEGER) AS dd
      FROM s_orders o JOIN s_customers c ON o.customer_id = c.customer_id)
GROUP BY customer_state""",
    "customer_segments": f"""
SELECT l.customer_unique_id, l.lifetime_orders, CAST(l.lifetime_value AS DOUBLE) AS lifetime_value,
       ROUND(r.avg_review_score, {P.score_digits}) AS avg_review_score,
       CASE WHEN l.lifetime_value >= {P.high_value_ltv} THEN 'High Value'
            WHEN l.lifetime_orders >= {P.repeat_orders} THEN 'Repeat'
            ELSE 'Emerging' END AS customer_segment
FROM ltv l LEFT JOIN (
  SELECT customer_unique_id, AVG(avg_review_score) AS avg_review_score
  FROM fact_orders JOIN s_customers USING (customer_id)
  WHERE avg_review_score IS NOT NULL GROUP BY customer_unique_id) r ON l.customer_unique_id = r.customer_unique_id""",
}

for _t, _sql in MART_SQL.items():
    register(f"mart_{_t}", O.with_base(O.SALES_MART_CTE + _sql))(
        lambda spark, d, _t=_t: marts(spark, d)[_t]
    )


# ---- data-quality suites (V1-V5) ----------------------------------------------------

SILVER_COLUMNS = {
    "customers": O.CUSTOMER_COLS,
    "orders": O.ORDER_COLS,
    "order_items": ["order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date",
                    "price", "freight_value"],
    "payments": ["order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value"],
    "reviews": O.REVIEW_COLS,
    "products": ["product_id", "product_category_name"],
    "category_translation": ["product_category_name", "product_category_name_english"],
    "sellers": ["seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"],
    "geolocation": ["geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng",
                    "geolocation_city", "geolocation_state"],
}

GOLD_COLUMNS = {
    "dim_date": ["date_key", "year", "month", "day", "day_of_week"],
    "dim_customers": O.CUSTOMER_COLS + ["lifetime_orders", "lifetime_value", "customer_segment"],
    "dim_products": ["product_id", "category_name"],
    "dim_sellers": SILVER_COLUMNS["sellers"],
    "fact_sales": ["order_id", "order_item_id", "product_id", "seller_id", "customer_id", "date_key",
                   "price", "freight_value"],
    "fact_orders": ["order_id", "customer_id", "date_key", "order_status", "delivery_days",
                    "total_payment_value", "avg_review_score"],
}

MART_COLUMNS = {
    "sales_mart": None,  # filled from marts.SALES_MART_COLUMNS below
    "dashboard_cube": ["year", "month", "customer_state", "category_english", "order_status", "orders",
                       "revenue", "payment_value", "avg_review_score", "avg_delivery_days"],
    "sales_summary": ["total_revenue", "avg_order_value", "total_orders"],
    "revenue_by_state": ["customer_state", "total_revenue", "total_orders"],
    "top_customers": ["customer_id", "lifetime_value", "total_orders"],
    "product_performance": ["product_id", "total_revenue", "items_sold"],
    "monthly_sales": ["year", "month", "monthly_revenue"],
    "category_performance": ["category_english", "total_revenue", "items_sold", "total_orders"],
    "payment_mix": ["payment_type", "total_payment_value", "payments"],
    "delivery_performance": ["customer_state", "avg_delivery_days", "total_orders"],
    "customer_segments": ["customer_unique_id", "lifetime_orders", "lifetime_value", "avg_review_score",
                          "customer_segment"],
}


def _quality_silver(spark, d):
    from lakemart.operators.quality import validate_silver

    return validate_silver(lake(spark, d).silver)


def _quality_gold(spark, d):
    from lakemart.operators.quality import validate_gold
    from lakemart.plans.build import gold_and_marts

    return validate_gold(gold_and_marts(spark, lake(spark, d).raw, scratch_root(spark, "quality_gold", d), P))


def _quality_sql():
    from lakemart.plans.marts import SALES_MART_COLUMNS
    from lakemart.sources.schemas import GOLD_METRICS, SILVER_KEYS

    MART_COLUMNS["sales_mart"] = list(SALES_MART_COLUMNS)
    silver = "\nUNION ALL ".join(
        O.profile_sql(SILVER_SQL[t], t, cols, SILVER_KEYS[t]) for t, cols in SILVER_COLUMNS.items()
    )
    gold_cte = {**{t: t for t in GOLD_COLUMNS}, "dim_sellers": "s_sellers"}
    mart_ctes = "".join(
        f", mart_{t} AS ({MART_SQL[t]})\n" for t in MART_COLUMNS if t != "sales_mart"
    )
    gold = "\nUNION ALL ".join(
        [O.profile_sql(gold_cte[t], t, cols, None, GOLD_METRICS[t]) for t, cols in GOLD_COLUMNS.items()]
        + [
            O.profile_sql("sales_mart" if t == "sales_mart" else f"mart_{t}", t, cols, None, GOLD_METRICS[t])
            for t, cols in MART_COLUMNS.items()
        ]
    )
    return O.with_base(silver), O.with_base(O.SALES_MART_CTE + mart_ctes + gold)


_QS, _QG = _quality_sql()
register("quality_silver", _QS)(_quality_silver)
register("quality_gold", _QG)(_quality_gold)


# ---- README star: surrogate keys, payment dimension, keyed facts (R1-R4) -------------

def _keyed(spark, d, table):
    from lakemart.plans.keyed import build_keyed_table
    from lakemart.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(spark)  # only sets a scratch folder when the session has none
    lk = lake(spark, d)
    return build_keyed_table(table, lk.silver, lk.gold)


KEYED_CTES = """, dim_customer AS (
  SELECT *, ROW_NUMBER() OVER (ORDER BY customer_id NULLS FIRST) AS customer_key FROM dim_customers),
dim_product AS (SELECT *, ROW_NUMBER() OVER (ORDER BY product_id NULLS FIRST) AS product_key FROM dim_products),
dim_seller AS (SELECT *, ROW_NUMBER() OVER (ORDER BY seller_id NULLS FIRST) AS seller_key FROM s_sellers),
dim_payment AS (
  SELECT payment_type, ROW_NUMBER() OVER (ORDER BY payment_type NULLS FIRST) AS payment_type_key
  FROM (SELECT payment_type FROM s_payments GROUP BY payment_type))
"""

KEYED_SQL = {
    "dim_customer": "SELECT * FROM dim_customer",
    "dim_product": "SELECT * FROM dim_product",
    "dim_seller": "SELECT * FROM dim_seller",
    "dim_payment": "SELECT * FROM dim_payment",
    "fact_payments": """
SELECT p.order_id, p.payment_sequential, d.payment_type_key, p.payment_installments, p.payment_value
FROM s_payments p LEFT JOIN dim_payment d ON p.payment_type IS NOT DISTINCT FROM d.payment_type""",
    "fact_order_items": """
SELECT s.order_id, s.order_item_id, c.customer_key, p.product_key, se.seller_key, s.date_key,
       s.price, s.freight_value, s.price + s.freight_value AS total_sales
FROM fact_sales s
LEFT JOIN dim_customer c ON s.customer_id = c.customer_id
LEFT JOIN dim_product p ON s.product_id = p.product_id
LEFT JOIN dim_seller se ON s.seller_id = se.seller_id""",
}

for _t, _sql in KEYED_SQL.items():
    register(f"keyed_{_t}", O.with_base(KEYED_CTES + _sql))(
        lambda spark, d, _t=_t: _keyed(spark, d, _t)
    )


# ---- keys that stay over loads (W1, R1, R3): a stored registry ------------------------
# Two loads: first the customers who have ordered, then all; the second load's new keys
# follow the first one's, whose numbers stay. Facts are keyed after each load.

def _two_loads(spark, d, query):
    from lakemart.operators.registry import KeyRegistry

    lk = lake(spark, d)
    registry = KeyRegistry(spark, scratch_root(spark, query, d), "customer", "customer_id", "customer_key")
    customers, ordered = lk.silver["customers"], lk.silver["orders"].select("customer_id")
    registry.load(customers.join(ordered, "customer_id", "left_semi"))
    first = registry.numbers().withColumn("load", _F.lit(1))
    return registry, first, customers, lk


def _registry_customers(spark, d):
    """Every customer's key after the second load, and after the first where it had one."""
    registry, first, customers, _ = _two_loads(spark, d, "registry-customers")
    registry.load(customers)
    registry.load(customers)  # finds nothing new
    before = first.select("customer_id", _F.col("customer_key").alias("first_key"))
    return registry.keyed(customers.select("customer_id")).join(before, "customer_id", "left")


def _registry_facts(spark, d):
    """Items keyed after the first load still name the same customers after the second:
    revenue by state through the stored keys."""
    registry, _, customers, lk = _two_loads(spark, d, "registry-facts")
    items = registry.keyed(lk.gold["fact_sales"].select("customer_id", "price"))
    root = f"{registry.root}/facts"
    items.select("customer_key", "price").write.mode("overwrite").parquet(root)
    dim = registry.load_and_key(customers.select("customer_id", "customer_state"))
    return (
        spark.read.parquet(root).join(dim.select("customer_key", "customer_state"), "customer_key")
        .groupBy("customer_state").agg(_F.sum("price").alias("value"), _F.count("*").alias("items"))
    )


REGISTRY_CTES = """, numbered AS (
  SELECT customer_id, loaded, ROW_NUMBER() OVER (ORDER BY loaded, customer_id NULLS FIRST) AS customer_key
  FROM (SELECT customer_id, CASE WHEN customer_id IN (SELECT customer_id FROM s_orders) THEN 1 ELSE 2 END AS loaded
        FROM s_customers))
"""
register("keyed_registry_customers", O.with_base(REGISTRY_CTES + """
SELECT customer_id, customer_key, CASE WHEN loaded = 1 THEN customer_key END AS first_key FROM numbered"""))(
    _registry_customers
)
register("keyed_registry_facts", O.with_base("""
SELECT customer_state, SUM(price) AS value, COUNT(*) AS items
FROM fact_sales JOIN s_customers USING (customer_id) GROUP BY customer_state"""))(_registry_facts)


# ---- SCD type 2 on customers (R6) ----------------------------------------------------
# Scenario over the whole customer table: the first load holds the customers who
# have ordered; a later feed moves every customer with an open order to a new
# city, adds the customers never loaded, and lacks one state's customers (those
# stay open and unchanged). The same feed applied twice must change nothing.

SCD_TRACKED = ("customer_city", "customer_state")
SCD_FIRST, SCD_SECOND = "2020-01-01", "2020-02-01"
SCD_MISSING_STATE = "NATION_0"


def scd_inputs(silver):
    from pyspark.sql import functions as F

    cust = silver["customers"].select("customer_id", *SCD_TRACKED)
    orders = silver["orders"]
    first = cust.join(orders.select("customer_id"), "customer_id", "left_semi")
    moved = orders.where(F.col("order_status") == "O").select("customer_id")
    feed = (
        cust.where(F.col("customer_state") != SCD_MISSING_STATE)
        .join(moved.withColumn("_moved", F.lit(True)).dropDuplicates(["customer_id"]), "customer_id", "left")
        .select(
            "customer_id",
            F.when(F.col("_moved"), F.concat("customer_city", F.lit(" (moved)")))
            .otherwise(F.col("customer_city")).alias("customer_city"),
            "customer_state",
        )
    )
    return first, feed


def _scd(spark, d, runs=1):
    from lakemart.operators.scd import scd2_merge

    first, feed = scd_inputs(lake(spark, d).silver)
    hist = scd2_merge(None, first, "customer_id", SCD_TRACKED, SCD_FIRST)
    for _ in range(runs):
        hist = scd2_merge(hist, feed, "customer_id", SCD_TRACKED, SCD_SECOND)
    return hist


SCD_SQL = f"""
, first_load AS (
  SELECT customer_id, customer_city, customer_state, DATE '{SCD_FIRST}' AS valid_from,
         CAST(NULL AS DATE) AS valid_to, TRUE AS is_current
  FROM s_customers WHERE customer_id IN (SELECT customer_id FROM s_orders)),
feed AS (
  SELECT customer_id,
         CASE WHEN customer_id IN (SELECT customer_id FROM s_orders WHERE order_status = 'O')
              THEN customer_city || ' (moved)' ELSE customer_city END AS customer_city,
         customer_state
  FROM s_customers WHERE customer_state <> '{SCD_MISSING_STATE}'),
j AS (
  SELECT o.*, n.customer_id AS n_id, n.customer_city AS n_city, n.customer_state AS n_state,
         o.customer_id IS NOT NULL AS has_o, n.customer_id IS NOT NULL AS has_n,
         (o.customer_id IS NOT NULL AND n.customer_id IS NOT NULL AND
          (o.customer_city IS DISTINCT FROM n.customer_city OR
           o.customer_state IS DISTINCT FROM n.customer_state)) AS changed
  FROM first_load o FULL OUTER JOIN feed n ON o.customer_id = n.customer_id)
SELECT customer_id, customer_city, customer_state, valid_from,
       CASE WHEN changed THEN DATE '{SCD_SECOND}' ELSE valid_to END AS valid_to,
       NOT changed AS is_current
FROM j WHERE has_o
UNION ALL
SELECT n_id, n_city, n_state, DATE '{SCD_SECOND}', CAST(NULL AS DATE), TRUE
FROM j WHERE has_n AND (NOT has_o OR changed)"""

def _scd_three(spark, d):
    """A third feed, of the second one's day, takes the moves of one state back; a fourth,
    older than all, changes nothing of known customers."""
    from pyspark.sql import functions as F

    from lakemart.operators.scd import store_merge, stored_history

    root = scratch_root(spark, "scd2-three", d)
    first, feed = scd_inputs(lake(spark, d).silver)
    back = lake(spark, d).silver["customers"].where(F.col("customer_state") == SCD_BACK_STATE)
    for incoming, day in ((first, SCD_FIRST), (feed, SCD_SECOND), (back, SCD_SECOND), (first, SCD_BEFORE)):
        store_merge(spark, root, "customers", incoming, "customer_id", SCD_TRACKED, day)
    return stored_history(spark, root, "customers")


SCD_BACK_STATE, SCD_BEFORE = "NATION_3", "2019-01-01"

register("scd2_three_feeds", O.with_base(SCD_SQL.replace("SELECT customer_id, customer_city, customer_state, valid_from,", """, twice AS (
SELECT customer_id, customer_city, customer_state, valid_from,""", 1) + f""")
SELECT customer_id,
       CASE WHEN is_current AND valid_from = DATE '{SCD_SECOND}' AND customer_state = '{SCD_BACK_STATE}'
            THEN replace(customer_city, ' (moved)', '') ELSE customer_city END AS customer_city,
       customer_state, valid_from, valid_to, is_current
FROM twice"""))(_scd_three)

register("scd2_customers", O.with_base(SCD_SQL))(lambda spark, d: _scd(spark, d, runs=1))
register("scd2_customers_rerun", O.with_base(SCD_SQL))(lambda spark, d: _scd(spark, d, runs=2))


# ---- README views: seller performance, headline tiles, region distribution (R10, R11) --

register("seller_performance", O.with_base(O.scope() + """
SELECT seller_id, CAST(SUM(paid) AS DOUBLE) AS revenue, COUNT(*) AS items, COUNT(DISTINCT order_id) AS orders
FROM sold GROUP BY seller_id"""))(lambda spark, d: D.seller_performance(star(spark, d)))

register("headline_counts", O.with_base(O.scope() + """
SELECT CAST(SUM(revenue) AS DOUBLE) AS revenue, COUNT(*) AS orders,
       COUNT(DISTINCT customer_unique_id) AS customers,
       (SELECT COUNT(DISTINCT seller_id) FROM sold) AS sellers
FROM hit"""))(lambda spark, d: D.headline_counts(star(spark, d)))

REGION_SQL = O.scope() + f"""
SELECT customer_state, CAST(total AS DOUBLE) AS revenue, orders,
       ROUND(CAST(total AS DOUBLE) * 100.0 / CAST(SUM(total) OVER () AS DOUBLE), {P.share_digits}) AS revenue_share_pct
FROM (SELECT customer_state, SUM(revenue) AS total, COUNT(*) AS orders FROM hit GROUP BY customer_state)"""

register("region_distribution", O.with_base(REGION_SQL))(
    lambda spark, d: D.region_distribution(star(spark, d))
)


# ---- streaming: auto-load + continuously refreshed trend / region views (S10, S11, R7, R8)
# The star rows of the driver tables arrive as three waves of files (finished,
# open, then all other orders; every wave touches most months, so later waves
# revise months already published). Each wave is auto-loaded exactly once and
# the refresh stream recomputes the touched months of the cube.

def _live_cube(spark, d, name):
    from pyspark.sql import functions as F

    from lakemart.streaming.autoload import auto_load
    from lakemart.streaming.live import start_refresh

    root = scratch_root(spark, name, d)
    incoming, landed, cube = f"{root}/incoming", f"{root}/landed", f"{root}/cube"
    star(spark, d).select(
        "order_id", "order_item_id", "price", "freight_value", "customer_state", "year", "month",
        "order_status",
    ).write.parquet(f"{root}/source")
    rows = spark.read.parquet(f"{root}/source")  # stored once; the waves only filter it
    status = F.coalesce(F.col("order_status"), F.lit(""))
    waves = [status == "F", status == "O", ~status.isin("F", "O")]
    schema = rows.drop("order_status").schema
    for cond in waves:
        rows.where(cond).drop("order_status").write.mode("append").parquet(incoming)
        load = auto_load(
            spark, incoming, landed, schema, f"{root}/ck_load", partition_by=("year", "month")
        )
        load.awaitTermination()
        refresh = start_refresh(
            spark, spark.readStream.schema(schema).parquet(landed), landed, cube, f"{root}/ck_refresh"
        )
        refresh.awaitTermination()
    return spark.read.parquet(cube)


def _live_trend(spark, d):
    from lakemart.streaming.live import revenue_trend

    return revenue_trend(_live_cube(spark, d, "live-trend"))


def _live_region(spark, d):
    from lakemart.streaming.live import region_distribution

    return region_distribution(_live_cube(spark, d, "live-region"))


register("live_revenue_trend", _trend_sql())(_live_trend)
register("live_region_distribution", O.with_base(REGION_SQL))(_live_region)


# The same views kept by changes alone: item versions come in four waves, the first with
# wrong prices, states and further items, which later waves correct, take back and repeat.

def _kept_cube(spark, d, name):
    from lakemart.sources.files import delete_path
    from lakemart.streaming.deltas import compact, keep_cube, read_kept

    root = scratch_root(spark, name, d)
    status = _F.coalesce(_F.col("order_status"), _F.lit(""))
    item = ("order_item_id", "product_id", "seller_id", "listed")  # the number alone is not unique here
    rows = star(spark, d).withColumn("listed", _F.col("price")).select(
        "order_id", *item, "price", "freight_value", "customer_state", "year", "month",
        _F.lit(2).cast("long").alias("seq"), _F.lit(False).alias("removed"), status.alias("status"),
    )
    with shuffles_dropped(spark):
        rows.write.option("compression", "zstd").parquet(f"{root}/source")
    rows = spark.read.parquet(f"{root}/source")
    odd, moved = _F.col("order_id") % 7 == 0, _F.col("order_id") % 5 == 0
    first = rows.where(status_is(rows, "F")).withColumns({
        "price": _F.when(odd, _F.col("price") + 10).otherwise(_F.col("price")).cast("decimal(18,2)"),
        "customer_state": _F.when(moved, _F.lit("NATION_0")).otherwise(_F.col("customer_state")),
        "seq": _F.lit(1).cast("long"),
    })
    invented = first.withColumn("order_item_id", _F.col("order_item_id") + 100)
    waves = [
        first.unionByName(invented),
        rows.where(status_is(rows, "O")).unionByName(invented.withColumns({"removed": _F.lit(True), "seq": _F.lit(3).cast("long")})),
        rows.where(status_is(rows, "F")).unionByName(first),  # corrected, and the first wave again
        rows.where(~status_is(rows, "F") & ~status_is(rows, "O")).unionByName(rows.where(status_is(rows, "O"))),
    ]
    schema = rows.drop("status").schema
    for n, wave in enumerate(waves):
        wave.drop("status").write.mode("append").option("compression", "zstd").parquet(f"{root}/incoming")
        if n == len(waves) - 1:
            delete_path(spark, f"{root}/source")
        # files of the feed go once a batch after theirs begins
        stream = spark.readStream.schema(schema).option("cleanSource", "delete").parquet(f"{root}/incoming")
        keep_cube(spark, stream, f"{root}/cube", f"{root}/ck", item_keys=item).awaitTermination()
        if n == 1:
            compact(spark, f"{root}/cube")
    return read_kept(spark, f"{root}/cube")


def status_is(rows, status):
    return rows["status"] == _F.lit(status)


def _kept_trend(spark, d):
    from lakemart.streaming.live import revenue_trend

    return revenue_trend(_kept_cube(spark, d, "kept-trend"))


def _kept_region(spark, d):
    from lakemart.streaming.live import region_distribution

    return region_distribution(_kept_cube(spark, d, "kept-region"))


register("live_changes_trend", _trend_sql())(_kept_trend)
register("live_changes_region", O.with_base(REGION_SQL))(_kept_region)


# ---- CSV sources and raw -> bronze ingestion (S1, S2, S4, S5, S6) --------------------
# The logical raw tables are published as CSV files under the catalogue's file
# names, ingested to bronze (all text) and rebuilt from text through the lenient
# silver conversions. Results must equal the typed Parquet path.

def _shuffled(df):
    """Columns in reverse order, under names in mixed case with spaces, and one more."""
    from pyspark.sql import functions as F

    named = df.select(*[F.col(c).alias(f" {c.replace('_', ' ').title()}") for c in reversed(df.columns)])
    return named.withColumn("Extra Column", F.lit("x"))


def _csv_ingest(spark, d, query, change=lambda df: df, only=None):
    from lakemart.sources.adapter import raw_tables
    from lakemart.sources.files import write_csv
    from lakemart.sources.ingest import ingest_raw
    from lakemart.sources.schemas import RAW_FILES

    root = scratch_root(spark, query, d)
    for name, df in raw_tables(spark, d).items():
        if only in (None, name):
            write_csv(change(df), f"{root}/raw/{RAW_FILES[name]}")
    return root, ingest_raw(spark, f"{root}/raw", root)


def _csv_report(spark, d, query, change=lambda df: df):
    return _csv_ingest(spark, d, query, change)[1].drop("path")


def _csv_lake(spark, d, query, change=lambda df: df, only=None):
    from lakemart.sources.ingest import read_bronze

    root, _ = _csv_ingest(spark, d, query, change, only)
    return Lake(read_bronze(spark, root), P)


def _csv_bronze_quality(spark, d):
    from lakemart.operators.quality import validate_tables
    from lakemart.sources.ingest import read_bronze

    root, _ = _csv_ingest(spark, d, "csv-bronze-quality")
    return validate_tables(read_bronze(spark, root))


def _typed_ids(df):
    """Keys come from CSV as text; as numbers they compare with the typed path."""
    ids = ("order_id", "customer_id", "product_id", "seller_id", "review_id", "customer_unique_id")
    return df.select(*[df[c].cast("bigint").alias(c) if c in ids else df[c] for c in df.columns])


RAW_CTES = """, raw_items AS (
  SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id,
         l_suppkey AS seller_id, l_shipdate AS shipping_limit_date,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS price,
         CAST(ROUND(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(4,2)), 2)
              AS DECIMAL(18,2)) AS freight_value
  FROM lineitem),
raw_products AS (
  SELECT p_partkey AS product_id, p_brand AS product_category_name, length(p_name) AS product_name_lenght,
         CAST(NULL AS INTEGER) AS product_description_lenght, CAST(NULL AS INTEGER) AS product_photos_qty,
         p_size AS product_weight_g, CAST(NULL AS INTEGER) AS product_length_cm,
         CAST(NULL AS INTEGER) AS product_height_cm, CAST(NULL AS INTEGER) AS product_width_cm
  FROM part),
raw_geolocation AS (
  SELECT lpad(CAST(c.c_nationkey AS VARCHAR), 5, '0') AS geolocation_zip_code_prefix,
         CAST(n.n_regionkey AS DOUBLE) AS geolocation_lat, CAST(c.c_nationkey AS DOUBLE) AS geolocation_lng,
         c.c_mktsegment AS geolocation_city, n.n_name AS geolocation_state
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey)
"""

RAW_CTE_OF = {
    "customers": "raw_customers", "orders": "raw_orders", "order_items": "raw_items",
    "payments": "s_payments", "reviews": "raw_reviews", "products": "raw_products",
    "sellers": "s_sellers", "geolocation": "raw_geolocation", "category_translation": "s_translation",
}


def _csv_sql():
    from lakemart.sources.schemas import RAW_SCHEMAS

    def report(status):
        return "\nUNION ALL ".join(
            f"SELECT '{t}' AS \"table\", COUNT(*) AS rows, '{status}' AS status FROM {cte}"
            for t, cte in RAW_CTE_OF.items()
        )

    quality = "\nUNION ALL ".join(
        O.profile_sql(cte, t, list(RAW_SCHEMAS[t].names)) for t, cte in RAW_CTE_OF.items()
    )
    return (
        O.with_base(RAW_CTES + report("written")),
        O.with_base(RAW_CTES + report("written; extra: extra_column")),
        O.with_base(RAW_CTES + quality),
    )


_CSV_REPORT_SQL, _CSV_SHUFFLED_SQL, _CSV_QUALITY_SQL = _csv_sql()
register("csv_ingest_report", _CSV_REPORT_SQL)(lambda spark, d: _csv_report(spark, d, "csv-report"))
register("csv_bronze_quality", _CSV_QUALITY_SQL)(_csv_bronze_quality)
register("csv_kpis", _kpi_sql())(lambda spark, d: D.kpis(_csv_lake(spark, d, "csv-kpis").star, P))
register("csv_top_categories_state_year", _topcat_sql(**F_STATE_YEAR))(
    lambda spark, d: D.top_categories(_csv_lake(spark, d, "csv-top").star, P, **F_STATE_YEAR)
)
register("csv_shuffled_header_report", _CSV_SHUFFLED_SQL)(
    lambda spark, d: _csv_report(spark, d, "csv-shuffled-report", _shuffled)
)
register("csv_shuffled_header_kpis", _kpi_sql())(
    lambda spark, d: D.kpis(_csv_lake(spark, d, "csv-shuffled-kpis", _shuffled).star, P)
)
for _t, _cte in SILVER_SQL.items():
    register(f"csv_shuffled_header_{_t}", O.with_base(f"SELECT * FROM {_cte}"))(
        lambda spark, d, _t=_t: _typed_ids(
            _csv_lake(spark, d, f"csv-shuffled-{_t}", _shuffled, only=_t).silver[_t]
        )
    )


# ---- sources with faults: every rule of silver has rows that it must change -----------

def _dirty(spark, d):
    from lakemart.sources.adapter import raw_tables
    from lakemart.sources.dirty import dirty_tables

    return Lake(dirty_tables(raw_tables(spark, d)), P)


def _dirty_quality(spark, d):
    from lakemart.operators.quality import validate_silver

    return validate_silver(_dirty(spark, d).silver)


def _dirty_rejected(spark, d):
    from lakemart.plans.silver import rejected_order_items

    return rejected_order_items(_dirty(spark, d).raw["order_items"]).select("order_id", "order_item_id")


def _dirty_payments(spark, d):
    from lakemart.plans.keyed import build_keyed_table
    from lakemart.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(spark)
    lk = _dirty(spark, d)
    return build_keyed_table("fact_payments", lk.silver, lk.gold)


def _dirty_sql(sql: str) -> str:
    """The SQL of a clean query, over the tables with faults."""
    base = O.with_base("")
    assert sql.startswith(base)
    return O.with_dirty(sql[len(base) :])


for _t in SILVER_SQL:
    register(f"dirty_silver_{_t}", _dirty_sql(ORACLE[f"silver_{_t}"]))(
        lambda spark, d, _t=_t: _dirty(spark, d).silver[_t]
    )
for _t in GOLD_SQL:
    register(f"dirty_gold_{_t}", _dirty_sql(ORACLE[f"gold_{_t}"]))(lambda spark, d, _t=_t: _dirty(spark, d).gold[_t])
register("dirty_kpis", _dirty_sql(ORACLE["kpis"]))(lambda spark, d: D.kpis(_dirty(spark, d).star, P))
register("dirty_quality", _dirty_sql(ORACLE["quality_silver"]))(_dirty_quality)
register("dirty_fact_payments", _dirty_sql(ORACLE["keyed_fact_payments"]))(_dirty_payments)
register("dirty_rejected_items", """
SELECT l_orderkey AS order_id, l_linenumber AS order_item_id
FROM lineitem
WHERE (l_orderkey + l_linenumber) % 19 = 0 AND (l_orderkey + l_linenumber) % 13 <> 0
  AND (l_orderkey + l_linenumber) % 17 <> 0 AND (l_orderkey + l_linenumber) % 31 <> 0""")(_dirty_rejected)


# ---- published copies, SQL over named tables, kept results (S1, S6, S8, S9) ----------

def _published(spark, d, query):
    """The order table published as CSV and read back as raw text (S6, S1)."""
    from lakemart.sources.files import publish, read_raw

    root = scratch_root(spark, query, d)
    publish(spark, f"{d}/orders.parquet", f"{root}/orders.csv", "parquet", "csv", out_options={"header": True})
    return read_raw(spark, f"{root}/orders.csv")


register("published_raw_orders", """
SELECT o_orderstatus, COUNT(*) AS orders, SUM(CAST(o_orderkey AS BIGINT)) AS keys,
       MIN(length(CAST(o_custkey AS VARCHAR))) AS shortest
FROM orders GROUP BY o_orderstatus""")(
    lambda spark, d: _published(spark, d, "published").selectExpr(
        "o_orderstatus", "o_custkey", "cast(o_orderkey as bigint) as k"
    ).groupBy("o_orderstatus").agg(
        _F.count(_F.lit(1)).alias("orders"), _F.sum("k").alias("keys"), _F.min(_F.length("o_custkey")).alias("shortest")
    )
)


def _named_tables(spark, d):
    from lakemart.sources.files import cached, register_views, run_query

    gold = lake(spark, d).gold
    names = {"sql_orders": gold["fact_orders"], "sql_customers": cached(gold["dim_customers"])}
    register_views(names)
    return run_query(
        spark,
        "SELECT c.customer_state, COUNT(*) AS orders, CAST(SUM(o.total_payment_value) AS DOUBLE) AS payments "
        "FROM sql_orders o JOIN sql_customers c ON o.customer_id = c.customer_id "
        "WHERE o.order_status = :status GROUP BY c.customer_state",
        {"status": P.delivered_status},
    )


register("named_table_sql", O.with_base(f"""
SELECT customer_state, COUNT(*) AS orders, CAST(SUM(total_payment_value) AS DOUBLE) AS payments
FROM fact_orders SEMI JOIN (SELECT order_id FROM s_orders WHERE order_status = '{P.delivered_status}') USING (order_id)
     JOIN s_customers USING (customer_id)
GROUP BY customer_state"""))(_named_tables)


# ---- bulk load of staged gold files into raw landing tables (S10, R5) ----------------

def _raw_landing(spark, d, landing):
    from lakemart.streaming.autoload import RAW_LANDING, load_raw_landing

    root = scratch_root(spark, f"landing-{landing}", d)
    staged = RAW_LANDING[landing]
    _landing_source(spark, d, staged).write.parquet(f"{root}/stage/{staged}")
    tables = {landing: staged}
    load_raw_landing(spark, f"{root}/stage", root, tables)
    load_raw_landing(spark, f"{root}/stage", root, tables)  # a second run loads nothing new
    return spark.read.parquet(f"{root}/raw/{landing}")


def _landing_source(spark, d, table):
    gold = lake(spark, d).gold
    return gold[table] if table in gold else _keyed(spark, d, table)


LANDING_SQL = {
    "raw_dim_customer": KEYED_SQL["dim_customer"],
    "raw_dim_product": KEYED_SQL["dim_product"],
    "raw_dim_seller": KEYED_SQL["dim_seller"],
    "raw_dim_payment": KEYED_SQL["dim_payment"],
    "raw_dim_date": "SELECT * FROM dim_date",
    "raw_fact_order_items": KEYED_SQL["fact_order_items"],
    "raw_fact_payments": KEYED_SQL["fact_payments"],
    "raw_fact_orders": "SELECT * FROM fact_orders",
}

for _t, _sql in LANDING_SQL.items():
    register(f"landing_{_t}", O.with_base(KEYED_CTES + _sql))(lambda spark, d, _t=_t: _raw_landing(spark, d, _t))


# ---- the stored-layer path: build the lake into storage, query the stored star ------
# raw -> silver -> gold -> star written layer by layer (read back between layers),
# then the dashboard reads the stored, year/month-partitioned star (pruned scan).

def _stored_dashboard(spark, d, query):
    from lakemart.plans.build import build_lake
    from lakemart.plans.dashboard import Dashboard
    from lakemart.sources.adapter import raw_tables

    base = scratch_root(spark, query, d)
    build_lake(spark, raw_tables(spark, d), base, P)
    return Dashboard(spark, base, P)


register("stored_kpis_state_year", _kpi_sql(**F_STATE_YEAR))(
    lambda spark, d: _stored_dashboard(spark, d, "stored-kpis").kpis(**F_STATE_YEAR)
)
register("stored_monthly_trend_category_status", _trend_sql(**F_CAT_STATUS))(
    lambda spark, d: _stored_dashboard(spark, d, "stored-trend").monthly_trend(**F_CAT_STATUS)
)


# ---- distinct counts from the stored cube (A9, D2, D3, D6, D7) -----------------------

def _stored_cube(spark, d, query):
    from lakemart.plans.cube import store_cube

    root = scratch_root(spark, query, d)
    star(spark, d).write.parquet(f"{root}/star")  # stored once; five plans read it
    return store_cube(spark, spark.read.parquet(f"{root}/star"), root)


def _cube_question(question, filt):
    from lakemart.plans import cube as C

    return {
        "kpis": lambda c: C.kpis(c, P, **filt),
        "monthly_trend": lambda c: C.monthly_trend(c, **filt),
        "segments": lambda c: C.segments(c, **filt),
        "funnel": lambda c: C.funnel(c, **filt),
    }[question]


CUBE_SETTINGS = {
    "kpis": {"": {}, "category_status": F_CAT_STATUS, "none_match": F_NONE_MATCH},
    "monthly_trend": {"category_status": F_CAT_STATUS},
    "segments": {"": {}, "state_year": F_STATE_YEAR},
    "funnel": {"": {}, "category_status": F_CAT_STATUS},
}

for _question, _settings in CUBE_SETTINGS.items():
    for _setting, _filt in _settings.items():
        _name = f"cube_{_question}_{_setting}".rstrip("_")
        register(_name, QUESTIONS[_question][0](**_filt))(
            lambda spark, d, _n=_name, _q=_question, _f=_filt: _cube_question(_q, _f)(_stored_cube(spark, d, _n))
        )


# ---- versions of the lake: a build is seen whole or not at all (S4) -------------------

def _versions(spark, d, query):
    """Three builds: of all orders; one that stops between tables; of finished orders."""
    from lakemart.plans.build import build_published
    from lakemart.sources.adapter import raw_tables
    from lakemart.sources.versions import build, snapshot

    base, raw = scratch_root(spark, query, d), raw_tables(spark, d)
    finished = {**raw, "orders": raw["orders"].where(_F.col("order_status") == "F")}
    pinned = build_published(spark, raw, base, P)
    try:
        with build(spark, base) as stage:
            lake(spark, d).silver["customers"].limit(0).write.parquet(f"{stage.base}/silver/customers")
            raise InterruptedError
    except InterruptedError:
        kept = snapshot(spark, base)
    latest = build_published(spark, finished, base, P)
    return pinned, kept, latest


def _version_dashboard(which):
    from lakemart.plans.dashboard import Dashboard

    return Dashboard.of(which.layer("gold"), P)


register("versions_kept_kpis", _kpi_sql())(
    lambda spark, d: _version_dashboard(_versions(spark, d, "versions-kept")[1]).kpis()
)
register("versions_pinned_trend", _trend_sql())(
    lambda spark, d: _version_dashboard(_versions(spark, d, "versions-pinned")[0]).monthly_trend()
)
register("versions_latest_trend", _trend_sql(status="F"))(
    lambda spark, d: _version_dashboard(_versions(spark, d, "versions-latest")[2]).monthly_trend()
)


# ---- gold by changes: a new silver rewrites the months it touches (G6, G8, R9) --------
# The first load lacks the orders of two months; the second one has them all.

REFRESH_MONTHS = ("1996-03", "1997-07")


def _refreshed(spark, d, query, known=False):
    """The version after the second load; ``known``: the loader names the orders."""
    from lakemart.plans.build import build_silver_layer
    from lakemart.plans.refresh import refresh_gold
    from lakemart.sources.adapter import raw_tables

    base = scratch_root(spark, query, d)
    silver = build_silver_layer(spark, raw_tables(spark, d), base)
    late = _F.date_format("order_purchase_timestamp", "yyyy-MM").isin(*REFRESH_MONTHS)
    orders = silver["orders"]
    refresh_gold(spark, {**silver, "orders": orders.where(~_F.coalesce(late, _F.lit(False)))}, base, P)
    return refresh_gold(spark, silver, base, P, orders.where(late).select("order_id") if known else None)


def _refresh_folders(spark, d):
    from lakemart.plans.refresh import rewritten

    return rewritten(_refreshed(spark, d, "refresh-folders"), "fact_orders")


register("refresh_fact_orders", O.with_base(GOLD_SQL["fact_orders"]))(
    lambda spark, d: _refreshed(spark, d, "refresh-facts").read("gold", "fact_orders").drop("year", "month")
)
register("refresh_known_kpis", _kpi_sql())(
    lambda spark, d: _version_dashboard(_refreshed(spark, d, "refresh-known", known=True)).kpis()
)
register("refresh_segments", _seg_sql())(
    lambda spark, d: _version_dashboard(_refreshed(spark, d, "refresh-segments")).segments()
)
register("refresh_folders", O.with_base(f"""
SELECT DISTINCT year, month, strftime(make_date(year, month, 1), '%Y-%m') IN {REFRESH_MONTHS} AS rewritten
FROM dim_date"""))(_refresh_folders)


# ---- histories from feeds in any order, stored in parts (R6) ---------------------------
# The last feed comes first, the first one last: all customers as they are, those who moved,
# those who have ordered.

HISTORY_THIRD, HISTORY_DAY = "2020-03-01", "2020-02-15"


def _history(spark, d, query):
    from lakemart.operators import history as H
    from lakemart.plans.build import build_silver_layer
    from lakemart.sources.adapter import raw_tables

    base, raw = scratch_root(spark, query, d), raw_tables(spark, d)
    silver = build_silver_layer(spark, {t: raw[t] for t in ("customers", "orders")}, base)
    first, feed = scd_inputs(silver)
    for incoming, day in ((silver["customers"], HISTORY_THIRD), (first, SCD_FIRST), (feed, SCD_SECOND)):
        snap = H.store_feed(spark, base, "customers", incoming, "customer_id", SCD_TRACKED, day)
    return H.stored(snap, "customers")


HISTORY_SQL = SCD_SQL[: SCD_SQL.index("j AS (")].rstrip().rstrip(",") + f""",
observed AS (
  SELECT customer_id, customer_city, customer_state, DATE '{SCD_FIRST}' AS day FROM first_load
  UNION ALL SELECT customer_id, customer_city, customer_state, DATE '{SCD_SECOND}' FROM feed
  UNION ALL SELECT customer_id, customer_city, customer_state, DATE '{HISTORY_THIRD}' FROM s_customers),
told AS (
  SELECT *, ROW_NUMBER() OVER w = 1 OR customer_city IS DISTINCT FROM LAG(customer_city) OVER w
            OR customer_state IS DISTINCT FROM LAG(customer_state) OVER w AS starts
  FROM observed WINDOW w AS (PARTITION BY customer_id ORDER BY day)),
hist AS (
  SELECT customer_id, customer_city, customer_state, day AS valid_from,
         LEAD(day) OVER (PARTITION BY customer_id ORDER BY day) AS valid_to
  FROM told WHERE starts)
"""

register("history_any_order", O.with_base(HISTORY_SQL + "SELECT *, valid_to IS NULL AS is_current FROM hist"))(
    lambda spark, d: _history(spark, d, "history-any")
)


def _history_on(spark, d):
    from lakemart.operators.history import valid_on

    return valid_on(_history(spark, d, "history-on"), HISTORY_DAY).groupBy("customer_state").agg(
        _F.count(_F.lit(1)).alias("customers"), _F.count_if(~_F.col("is_current")).alias("changed_since")
    )


register("history_on_a_day", O.with_base(HISTORY_SQL + f"""
SELECT customer_state, COUNT(*) AS customers, COUNT(valid_to) AS changed_since FROM hist
WHERE valid_from <= DATE '{HISTORY_DAY}' AND (valid_to IS NULL OR valid_to > DATE '{HISTORY_DAY}')
GROUP BY customer_state"""))(_history_on)
