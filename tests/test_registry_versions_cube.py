"""Keys that stay over loads, versions seen whole or not at all, distinct counts from sets."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from lakemart.operators.registry import KeyRegistry
from lakemart.params import Params
from lakemart.plans import cube as C
from lakemart.plans import dashboard as D
from lakemart.plans.build import build_keyed_layer
from lakemart.plans.gold import build_gold
from lakemart.sources import versions as V


# ---- registry ------------------------------------------------------------------------

def numbers(registry):
    return {tuple(r)[:-1]: r[-1] for r in registry.numbers().collect()}


def test_old_keys_stay_and_new_ones_follow(spark, scratch):
    reg = KeyRegistry(spark, scratch, "customer", "id", "id_key")
    assert reg.numbers() is None and reg.largest() == 0
    first = spark.createDataFrame([("m",), ("c",), ("x",), ("c",)], "id string")
    assert reg.load(first) == 3
    before = numbers(reg)
    assert before == {("c",): 1, ("m",): 2, ("x",): 3}
    second = spark.createDataFrame([("a",), (None,), ("m",), ("b",)], "id string")
    assert reg.load(second) == 3 and reg.load(second) == 0
    after = numbers(reg)
    assert {k: after[k] for k in before} == before
    assert sorted(after.values()) == list(range(1, 7)) and reg.largest() == 6
    assert after[(None,)] == 4  # null first, as in one load
    keyed = reg.keyed(second.withColumn("known_id", F.lit(1)).select("id")).collect()
    assert {r.id: r.id_key for r in keyed} == {k[0]: after[k] for k in [("a",), (None,), ("m",), ("b",)]}


def test_keys_of_several_columns_and_unknown(spark, scratch):
    reg = KeyRegistry(spark, scratch, "item", ["a", "b"], "key")
    reg.load(spark.createDataFrame([(1, "x"), (1, None), (None, None)], "a int, b string"))
    assert numbers(reg) == {(None, None): 1, (1, None): 2, (1, "x"): 3}
    got = reg.keyed(spark.createDataFrame([(1, None), (2, "x"), (2, "x")], "a int, b string")).collect()
    assert sorted((r.a, r.key or 0) for r in got) == [(1, 2), (2, 0), (2, 0)]
    empty = KeyRegistry(spark, scratch, "none", "a", "key")
    assert empty.load(spark.createDataFrame([], "a int")) == 0 and empty.numbers().count() == 0


def test_many_loads_have_no_gap(spark, scratch):
    rng = random.Random(1)
    reg, seen = KeyRegistry(spark, scratch, "many", "id", "k"), {}
    for _ in range(4):
        batch = [(rng.randint(1, 300),) for _ in range(120)]
        reg.load(spark.createDataFrame(batch, "id int"))
        now = numbers(reg)
        assert seen.items() <= now.items() and sorted(now.values()) == list(range(1, len(now) + 1))
        seen = now


def _silver(spark, customers):
    one = lambda rows, schema: spark.createDataFrame(rows, schema)
    stamp = "timestamp '2020-01-02 00:00:00'"
    orders = one([(c, c) for c in customers], "order_id string, customer_id string").selectExpr(
        "order_id", "customer_id", "'delivered' as order_status", f"{stamp} as order_purchase_timestamp",
        f"{stamp} as order_approved_at", f"{stamp} as order_delivered_carrier_date",
        f"{stamp} as order_delivered_customer_date", f"{stamp} as order_estimated_delivery_date",
    )
    return {
        "orders": orders,
        "customers": one([(c, c, "z", "city", "S") for c in customers], "customer_id string, customer_unique_id string, customer_zip_code_prefix string, customer_city string, customer_state string"),
        "order_items": orders.selectExpr("order_id", "1 as order_item_id", "'p' as product_id", "'s' as seller_id", "cast(5 as decimal(18,2)) as price", "cast(1 as decimal(18,2)) as freight_value"),
        "payments": orders.selectExpr("order_id", "1 as payment_sequential", "'card' as payment_type", "1 as payment_installments", "cast(6 as decimal(18,2)) as payment_value"),
        "reviews": orders.selectExpr("order_id", "5 as review_score"),
        "products": one([("p", "cat")], "product_id string, product_category_name string"),
        "category_translation": one([("cat", "Cat")], "product_category_name string, product_category_name_english string"),
        "sellers": one([("s", "z", "c", "S")], "seller_id string, seller_zip_code_prefix string, seller_city string, seller_state string"),
    }


def test_keyed_layer_keeps_keys_over_builds(spark, scratch):
    def run(customers):
        silver = _silver(spark, customers)
        tables = build_keyed_layer(spark, silver, build_gold(silver, Params()), scratch)
        facts = {r.order_id: r.customer_key for r in tables["fact_order_items"].collect()}
        dims = {r.customer_id: r.customer_key for r in tables["dim_customer"].collect()}
        assert facts == dims
        return dims

    assert run(["m", "x"]) == {"m": 1, "x": 2}
    assert run(["a", "m", "n", "x"]) == {"m": 1, "x": 2, "a": 3, "n": 4}
    assert run(["x"]) == {"x": 2}


# ---- versions ------------------------------------------------------------------------

def write(spark, stage, layer, table, rows):
    spark.createDataFrame([(r,) for r in rows], "v int").write.parquet(f"{stage.base}/{layer}/{table}")


def read(snap, layer, table):
    return sorted(r.v for r in snap.read(layer, table).collect())


def test_a_build_that_stops_is_not_seen(spark, scratch):
    assert V.snapshot(spark, scratch) is None
    with V.build(spark, scratch) as stage:
        write(spark, stage, "gold", "a", [1])
        write(spark, stage, "gold", "b", [1, 2])
    old = V.snapshot(spark, scratch)
    for _ in range(2):
        with pytest.raises(RuntimeError, match="killed"), V.build(spark, scratch) as stage:
            write(spark, stage, "gold", "a", [7])
            raise RuntimeError("killed")
    now = V.snapshot(spark, scratch)
    assert now.version == 1 and read(now, "gold", "a") == [1] and read(now, "gold", "b") == [1, 2]
    with V.build(spark, scratch) as stage:
        write(spark, stage, "gold", "a", [9])
        stage.note["why"] = "prices"
    new = V.snapshot(spark, scratch)
    assert (new.version, read(new, "gold", "a"), read(new, "gold", "b")) == (2, [9], [1, 2])
    assert new.note == {"why": "prices"} and read(old, "gold", "a") == [1]
    with pytest.raises(KeyError, match="no gold/c"):
        new.read("gold", "c")


def test_two_builds_from_one_version(spark, scratch):
    with pytest.raises(V.Conflict):
        with V.build(spark, scratch) as stage:
            write(spark, stage, "gold", "a", [1])
            V._write_new(spark, f"{V._manifests(scratch)}/{stage.version:09d}.json", '{"tables": {}, "note": {}, "at": 0}')
    assert V.snapshot(spark, scratch).tables == {}
    assert not [n for n in V._names(spark, V._manifests(scratch)) if n.endswith(".draft")]


def test_retired_versions_go_and_shared_tables_stay(spark, scratch):
    for n in range(4):
        with V.build(spark, scratch) as stage:
            if n == 0:
                write(spark, stage, "silver", "kept", [5])
            if n == 1:
                write(spark, stage, "gold", "dropped_later", [1])
            if n == 2:
                stage.dropped.add("gold/dropped_later")
            write(spark, stage, "gold", "a", [n])
    assert V.retire(spark, scratch, keep=2, seconds=3600) == []
    assert V.retire(spark, scratch, keep=2) == [1, 2]
    assert V.published(spark, scratch) == [3, 4]
    now = V.snapshot(spark, scratch)
    assert read(now, "silver", "kept") == [5] and read(now, "gold", "a") == [3]
    assert set(now.layer("gold")) == {"a"}
    assert read(V.snapshot(spark, scratch, 3), "gold", "a") == [2]
    assert V._names(spark, f"{scratch}/versions/000000002") == []
    with pytest.raises(ValueError):
        V.retire(spark, scratch, keep=0)


# ---- cube ----------------------------------------------------------------------------

STAR = (
    "order_id long, order_item_id int, price decimal(18,2), freight_value decimal(18,2), order_status string, "
    "delivery_days int, total_payment_value decimal(28,2), avg_review_score double, customer_unique_id string, "
    "customer_state string, customer_segment string, category_name string, year int, month int"
)


def star_rows(n, seed):
    from decimal import Decimal

    rng, people, orders = random.Random(seed), {}, {}
    rows = []
    for i in range(n):
        order = rng.randint(1, n // 3)
        if order not in orders:
            person = None if rng.random() < 0.05 else f"p{1 if rng.random() < 0.4 else rng.randint(1, n // 5)}"
            segment = people.setdefault(person, rng.choice(["High Value", "Repeat", "Emerging"]))
            orders[order] = (
                rng.choice(["delivered", "open", None]), rng.choice([None, 3, 30]), rng.choice([None, Decimal(0), Decimal(9)]),
                rng.choice([None, 4.0, 5.0]), person, rng.choice(["A", "B", None]), segment, rng.choice([2019, 2020]), rng.randint(1, 3),
            )
        status, days, paid, score, person, state, segment, year, month = orders[order]
        rows.append((order, i, Decimal(rng.randint(1, 500)) / 100, Decimal("0.25"), status, days, paid, score, person, state, segment, rng.choice(["x", "y", None]), year, month))
    return rows


FILTERS = [{}, {"state": "A"}, {"category": "x", "status": "delivered"}, {"year": 2020, "category": "y"}, {"state": "none"}]


def test_cube_equals_the_star_under_any_filter(spark, scratch):
    star = spark.createDataFrame(star_rows(900, 4), STAR).cache()
    cube = C.store_cube(spark, star, scratch)
    rows = lambda df: sorted((tuple(r) for r in df.collect()), key=str)
    for filt in FILTERS:
        for name in ("kpis", "segments", "funnel", "monthly_trend"):
            want = rows(getattr(D, name)(star, **filt).select(*getattr(C, name)(cube, **filt).columns))
            assert rows(getattr(C, name)(cube, **filt)) == want, (name, filt)
    star.unpersist()


def test_cube_over_many_buckets_and_merged_parts(spark):
    """Numbers beyond one bitmap; cells of two loads stand beside each other."""
    base = spark.range(1, 100_001).selectExpr(
        "id as order_id", "1 as order_item_id", "cast(1 as decimal(18,2)) as price", "cast(0 as decimal(18,2)) as freight_value",
        "'delivered' as order_status", "1 as delivery_days", "cast(1 as decimal(28,2)) as total_payment_value",
        "cast(5 as double) as avg_review_score", "concat('p', id % 70000) as customer_unique_id", "'A' as customer_state",
        "'Repeat' as customer_segment", "'x' as category_name", "2020 as year", "cast(1 + id % 2 as int) as month",
    )
    orders, persons = C.order_numbers(base), C.person_numbers(base)
    parts = [C.build_cube(base.where(F.col("month") == m), orders, persons) for m in (1, 2)]
    cube = {t: parts[0][t].unionByName(parts[1][t]) for t in C.TABLES}
    got = C.kpis(cube).first()
    assert (got.total_orders, got.total_customers, got.repeat_rate) == (100_000, 70_000, 100.0)


def test_bitmaps_are_made_where_their_rows_meet(spark):
    """No task sends bitmaps of a few bits for rows that others have as well."""
    star = spark.createDataFrame(
        [(1, 1, "S", "C", "F", n) for n in range(20)],
        "year int, month int, customer_state string, category_name string, order_status string, order_no long",
    )
    sets = C._sets(star.repartition(3), "order_no")
    plan = sets._jdf.queryExecution().executedPlan().toString()
    parts = plan.split("Exchange hashpartitioning")
    assert "bitmap_construct_agg" in parts[0] and not any("bitmap_construct_agg" in p for p in parts[1:])
    assert sets.selectExpr("sum(bitmap_count(bitmap)) AS n").first().n == 20
