"""Gold by changes: a new silver rewrites the months it touches and equals a full build."""

from __future__ import annotations

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import types as T

from lakemart.params import Params
from lakemart.plans import gold as G
from lakemart.plans.refresh import refresh_gold, rewritten
from lakemart.sources import versions as V

PARAMS = Params(high_value_ltv=50, repeat_orders=3)
TABLES = ("dim_date", "dim_customers", "dim_products", "dim_sellers", "fact_sales", "fact_orders")
SCHEMAS = {
    "orders": "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp, order_delivered_customer_date timestamp",
    "customers": "customer_id string, customer_unique_id string, customer_state string",
    "order_items": "order_id string, order_item_id int, product_id string, seller_id string, price decimal(18,2), freight_value decimal(18,2)",
    "payments": "order_id string, payment_value decimal(18,2)",
    "reviews": "order_id string, review_score int",
    "products": "product_id string, product_category_name string",
    "category_translation": "product_category_name string, product_category_name_english string",
    "sellers": "seller_id string, seller_state string",
}


def made(seed=1, n=60):
    """Orders over six months (some undated), two customers a person, items, payments, reviews."""
    from decimal import Decimal as D

    rng = random.Random(seed)
    rows = {t: [] for t in SCHEMAS}
    for i in range(n):
        o = f"o{i}"
        when = None if i % 13 == 0 else dt.datetime(2020, 1 + i % 6, 1 + rng.randrange(28))
        done = None if when is None or i % 4 == 0 else when + dt.timedelta(days=rng.randrange(20))
        rows["orders"].append((o, f"c{i % 20}", rng.choice(["delivered", "shipped"]), when, done))
        for k in range(rng.randrange(3)):
            rows["order_items"].append((o, k, f"p{rng.randrange(5)}", "s1", D(rng.randrange(1, 9)), D(1)))
        rows["payments"] += [(o, D(rng.randrange(9)))] * (i % 3)
        rows["reviews"] += [(o, rng.choice([1, 5, None]))] * (i % 2)
    rows["payments"].append((None, D(5)))
    rows["order_items"].append(("nowhere", 0, "p1", "s1", D(3), D(1)))
    rows["customers"] = [(f"c{i}", f"u{i // 2}", "S" if i % 2 else "R") for i in range(20)]
    rows["products"] = [(f"p{i}", f"cat{i}" if i else None) for i in range(5)]
    rows["category_translation"] = [("cat1", "Cat one")]
    rows["sellers"] = [("s1", "S")]
    return rows


def frames(spark, rows):
    return {t: spark.createDataFrame(rows[t], SCHEMAS[t]) for t in SCHEMAS}


def counted(df):
    return Counter(tuple(r) for r in df.select(*sorted(df.columns)).collect())


def assert_full(spark, snap, rows):
    want = G.build_gold(frames(spark, rows), PARAMS)
    for table in TABLES:
        got = snap.read("gold", table)
        assert counted(got.select(*want[table].columns)) == counted(want[table]), table
    assert counted(snap.read("gold", "star")) == counted(G.star(want))


def fresh(snap, table):
    return {(r.year, r.month) for r in rewritten(snap, table).collect() if r.rewritten}


def test_two_of_six_months(spark, scratch):
    rows = made()
    first = refresh_gold(spark, frames(spark, rows), scratch, PARAMS)
    assert_full(spark, first, rows)
    assert (None, None) in fresh(first, "fact_orders") and len(fresh(first, "star")) == 6

    same = refresh_gold(spark, frames(spark, rows), scratch, PARAMS)
    assert_full(spark, same, rows)
    assert same.note["months"] == {"facts": [], "star": []}
    assert fresh(same, "fact_orders") == fresh(same, "fact_sales") == fresh(same, "star") == set()

    # a corrected status in March, one more review in May: segments stay
    march = next(i for i, o in enumerate(rows["orders"]) if o[3] and o[3].month == 3)
    may = next(o for o in rows["orders"] if o[3] and o[3].month == 5)
    o = rows["orders"][march]
    rows["orders"][march] = (o[0], o[1], "canceled", *o[3:])
    rows["reviews"].append((may[0], 3))
    third = refresh_gold(spark, frames(spark, rows), scratch, PARAMS)
    assert_full(spark, third, rows)
    for table in ("fact_orders", "fact_sales", "order_marks", "star"):
        assert fresh(third, table) <= {(2020, 3), (2020, 5)}
    assert third.note["months"]["facts"] == [202003, 202005]
    assert_full(spark, V.snapshot(spark, scratch, 1), made())  # readers of the first one


def test_orders_that_move_vanish_and_lose_their_date(spark, scratch):
    rows = made()
    refresh_gold(spark, frames(spark, rows), scratch, PARAMS)
    rows["orders"] = [o for o in rows["orders"] if not (o[3] and o[3].month == 2)]  # a month is gone
    i = next(i for i, o in enumerate(rows["orders"]) if o[3] and o[3].month == 4)
    rows["orders"][i] = (*rows["orders"][i][:3], dt.datetime(2021, 7, 1), None)
    j = next(j for j, o in enumerate(rows["orders"]) if o[3] and o[3].month == 6)
    rows["orders"][j] = (*rows["orders"][j][:3], None, None)
    snap = refresh_gold(spark, frames(spark, rows), scratch, PARAMS)
    assert_full(spark, snap, rows)
    assert snap.note["months"]["facts"] == [-1, 202002, 202004, 202006, 202107]
    months = {(r.year, r.month) for r in rewritten(snap, "fact_orders").collect()}
    assert (2020, 2) not in months and (2021, 7) in months


def test_a_segment_a_state_and_a_category_change_other_months(spark, scratch):
    from decimal import Decimal as D

    rows = made()
    refresh_gold(spark, frames(spark, rows), scratch, PARAMS)
    january = next(o for o in rows["orders"] if o[3] and o[3].month == 1)
    rows["order_items"].append((january[0], 9, "p2", "s1", D(500), D(1)))  # its person is of high value now
    snap = refresh_gold(spark, frames(spark, rows), scratch, PARAMS)
    assert_full(spark, snap, rows)
    assert fresh(snap, "fact_sales") == {(2020, 1)} < fresh(snap, "star")

    rows["category_translation"] = [("cat1", "Other")]
    rows["customers"][3] = ("c3", "u1", "moved")
    snap = refresh_gold(spark, frames(spark, rows), scratch, PARAMS)
    assert_full(spark, snap, rows)
    assert fresh(snap, "fact_sales") == set() != fresh(snap, "star")


def test_changed_members_of_kept_orders_join_no_items_anew(spark, scratch, monkeypatch):
    """stored star rows are copied with the new columns of a member; months are joined
    anew where a member comes, goes or is there twice."""
    joined, star = [], G.star

    def seen(gold):
        joined.append(gold["fact_sales"].count())
        return star(gold)

    monkeypatch.setattr(G, "star", seen)
    rows = made()
    refresh_gold(spark, frames(spark, rows), scratch, PARAMS)
    rows["customers"][3] = ("c3", "u1", "moved")
    rows["category_translation"] = [("cat1", "Other")]
    snap = refresh_gold(spark, frames(spark, rows), scratch, PARAMS)
    assert joined[0] > 0 and joined[1] == 0
    assert fresh(snap, "star") and snap.note["months"]["facts"] == []
    rows["products"].append(("p2", "cat9"))
    del rows["customers"][5]
    snap = refresh_gold(spark, frames(spark, rows), scratch, PARAMS)
    assert joined[2] > 0
    monkeypatch.undo()
    assert_full(spark, snap, rows)


def test_known_orders_need_no_comparison(spark, scratch):
    rows = made()
    refresh_gold(spark, frames(spark, rows), scratch, PARAMS)
    i = next(i for i, o in enumerate(rows["orders"]) if o[3] and o[3].month == 4)
    old = rows["orders"][i]
    rows["orders"][i] = (*old[:3], dt.datetime(2020, 6, 3), None)
    touched = spark.createDataFrame([(old[0],), (old[0],), ("unknown",), (None,)], "order_id string")
    snap = refresh_gold(spark, frames(spark, rows), scratch, PARAMS, touched)
    assert snap.note["months"]["facts"] == [202004, 202006]
    assert_full(spark, snap, rows)
    after = refresh_gold(spark, frames(spark, rows), scratch, PARAMS)
    assert after.note["months"] == {"facts": [], "star": []}  # the marks went with them


def test_empty_silver_before_and_after(spark, scratch):
    none = {t: [] for t in SCHEMAS}
    snap = refresh_gold(spark, frames(spark, none), scratch, PARAMS)
    assert_full(spark, snap, none)
    rows = made(n=20)
    assert_full(spark, refresh_gold(spark, frames(spark, rows), scratch, PARAMS), rows)
    assert_full(spark, refresh_gold(spark, frames(spark, none), scratch, PARAMS), none)


def test_a_year_filter_reads_its_folders(spark, scratch):
    rows = made()
    refresh_gold(spark, frames(spark, rows), scratch, PARAMS)
    rows["reviews"].append((rows["orders"][1][0], 2))
    snap = refresh_gold(spark, frames(spark, rows), scratch, PARAMS)
    plan = snap.read("gold", "star").where("year = 2020 AND month = 2")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2 and "PartitionFilters: [isnotnull(year" in plan


def test_a_stopped_refresh_is_not_seen_and_retired_parts_go(spark, scratch, monkeypatch):
    rows = made()
    refresh_gold(spark, frames(spark, rows), scratch, PARAMS)
    changed = made()
    changed["reviews"].append((rows["orders"][1][0], 2))
    with monkeypatch.context() as m:
        m.setattr(G, "star", lambda gold: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            refresh_gold(spark, frames(spark, changed), scratch, PARAMS)
    assert V.published(spark, scratch) == [1]
    assert_full(spark, V.snapshot(spark, scratch), rows)
    second = refresh_gold(spark, frames(spark, changed), scratch, PARAMS)
    assert V.retire(spark, scratch, keep=1) == [1]
    assert_full(spark, second, changed)  # the months kept of version 1 are still there
    held = V._part_folders(spark, f"{scratch}/versions/{1:09d}/gold/fact_orders", 2)
    kept = [p for p, v in second.parts["gold/fact_orders"].written.items() if v == 1]
    assert sorted(held) == sorted(kept) and len(kept) == 6


def test_rows_for_parts_that_stay_are_refused(spark, scratch):
    df = spark.createDataFrame([(1, 2020), (2, 2021)], T.StructType.fromDDL("v int, year int"))
    with V.build(spark, scratch) as stage:
        stage.write_parts(df, "gold/t", ["year"])
    with pytest.raises(ValueError), V.build(spark, scratch) as stage:
        stage.write_parts(df, "gold/t", ["year"], lambda part: part == "year=2021")
    assert V.published(spark, scratch) == [1]
    with V.build(spark, scratch) as stage:  # a table in parts becomes a whole one
        df.write.parquet(f"{stage.base}/gold/t")
    assert "gold/t" not in V.snapshot(spark, scratch).parts
    assert V.snapshot(spark, scratch).read("gold", "t").count() == 2
