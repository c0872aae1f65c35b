"""Quality checks, SCD-2 merge and dense surrogate keys."""

import datetime as dt
import os
import pathlib

import pytest

from lakemart.operators.keys import with_surrogate_key
from lakemart.operators.quality import check_path, profile, validate_tables
from lakemart.operators.scd import scd2_merge


def _checks(df):
    return {(r.check, r.column): (r.status, r.value, r.pct) for r in df.collect()}


def test_profile_nulls_key_and_metrics(spark):
    df = spark.createDataFrame(
        [("a", 1.0, None), ("a", -2.0, None), (None, 3.0, None), (None, None, None)],
        "id string, price double, empty double",
    )
    out = _checks(profile(df, "t", key="id", metrics=["price", "empty", "absent"]))
    assert out[("rows", None)] == ("PASS", 4.0, None)
    assert out[("columns", None)] == ("PASS", 3.0, None)
    assert out[("nulls", "id")] == ("WARN", 2.0, 50.0)
    assert out[("nulls", "price")] == ("WARN", 1.0, 25.0)
    # NULL counts as one key value: distinct {a, NULL} = 2 of 4 rows
    assert out[("key_unique", "id")] == ("WARN", 2.0, None)
    assert out[("min", "price")] == ("FAIL", -2.0, None)
    assert out[("min", "empty")] == ("PASS", None, None)  # all-NULL metric passes
    assert ("min", "absent") not in out


def test_profile_empty_table_fails_and_stops(spark):
    df = spark.createDataFrame([], "id string, v double")
    out = _checks(profile(df, "t", key="id", metrics=["v"]))
    assert out == {("rows", None): ("FAIL", 0.0, None)}


def test_unreadable_path(spark, scratch):
    (row,) = check_path(spark, f"{scratch}/missing", "ghost")
    assert row[1] == "readable" and row[3] == "FAIL" and "missing" in row[2]


@pytest.mark.parametrize("layer", ["silver", "gold"])
def test_stored_suite_isolates_bad_tables(spark, scratch, layer):
    from lakemart.operators.quality import validate_stored
    from lakemart.sources.files import GOLD_TABLES
    from lakemart.sources.schemas import CATALOGUE, SILVER_KEYS

    names = list(CATALOGUE) if layer == "silver" else [*GOLD_TABLES, "star"]
    absent, damaged, empty, *others = names
    for t in names[1:]:
        rows = [] if t == empty else [(1, 2.0)]
        key = SILVER_KEYS.get(t) or "id"
        spark.createDataFrame(rows, f"{key} int, price double").write.parquet(f"{scratch}/{layer}/{t}")
    for path in pathlib.Path(f"{scratch}/{layer}/{damaged}").glob("part-*"):
        path.write_bytes(b"PAR1 this is no parquet file PAR1")
    got = validate_stored(spark, scratch, layer).collect()
    failed = {(r.table, r.check) for r in got if r.status == "FAIL"}
    assert {(absent, "readable"), (damaged, "readable"), (empty, "rows")} <= failed
    for t in others:
        assert ("rows", "PASS") in {(r.check, r.status) for r in got if r.table == t}


def test_bronze_suite_isolates_bad_files(spark, scratch):
    from lakemart.operators.quality import validate_bronze_files
    from lakemart.sources.schemas import RAW_FILES

    os.makedirs(scratch, exist_ok=True)
    pathlib.Path(scratch, RAW_FILES["sellers"]).write_text("Seller ID,seller city\ns1,x\n")
    pathlib.Path(scratch, RAW_FILES["customers"]).write_text("customer_city\nx\n")  # no key column
    pathlib.Path(scratch, RAW_FILES["products"]).write_text("product_id,product_category_name\n")  # no rows
    got = validate_bronze_files(spark, scratch).collect()
    fails = {(r.table, r.check) for r in got if r.status == "FAIL"}
    assert ("customers", "readable") in fails and ("orders", "readable") in fails and ("products", "rows") in fails
    assert ("sellers", "rows") in {(r.table, r.check) for r in got if r.status == "PASS"}


def test_suite_over_no_tables_is_empty(spark):
    assert validate_tables({}).count() == 0


def test_suite_pct_rounding_is_exact(spark):
    # 1 null in 800 rows = 0.125 % -> 0.13 (half away from zero, not binary-float dependent)
    df = spark.range(800).selectExpr("IF(id = 0, NULL, id) AS x")
    out = _checks(validate_tables({"t": df}))
    assert out[("nulls", "x")] == ("WARN", 1.0, 0.13)


SCHEMA = "id string, city string, valid_from date, valid_to date, is_current boolean"
D1, D2 = dt.date(2020, 1, 1), dt.date(2020, 2, 1)


def test_scd2_merge(spark):
    current = spark.createDataFrame(
        [
            ("k1", "a", D1, None, True),       # unchanged
            ("k2", "b", D1, None, True),       # changes
            ("k3", None, D1, None, True),      # NULL -> value
            ("k4", "d", D1, None, True),       # missing from feed
            ("k2", "old", dt.date(2019, 1, 1), D1, False),  # closed history
        ],
        SCHEMA,
    )
    feed = spark.createDataFrame(
        [("k1", "a"), ("k2", "B"), ("k3", "c"), ("k5", "e")], "id string, city string"
    )
    out = scd2_merge(current, feed, "id", ["city"], "2020-02-01")
    rows = sorted(((r.id, r.city, r.valid_from, r.valid_to, r.is_current) for r in out.collect()), key=repr)
    assert rows == sorted(
        [
            ("k1", "a", D1, None, True),
            ("k2", "b", D1, D2, False),
            ("k2", "B", D2, None, True),
            ("k2", "old", dt.date(2019, 1, 1), D1, False),
            ("k3", None, D1, D2, False),
            ("k3", "c", D2, None, True),
            ("k4", "d", D1, None, True),
            ("k5", "e", D2, None, True),
        ],
        key=repr,
    )
    again = scd2_merge(out, feed, "id", ["city"], "2020-03-01")
    assert sorted(map(tuple, again.collect()), key=repr) == sorted(map(tuple, out.collect()), key=repr)


def test_scd2_older_and_same_day_feeds(spark):
    current = spark.createDataFrame(
        [("k1", "a", D2, None, True), ("k2", "b", D1, None, True), ("k2", "z", dt.date(2019, 1, 1), D1, False)], SCHEMA
    )
    feed = spark.createDataFrame([("k1", "A"), ("k2", "B")], "id string, city string")

    def merged(as_of):
        return {(r.id, r.city, r.valid_from, r.valid_to, r.is_current) for r in scd2_merge(current, feed, "id", ["city"], as_of).collect()}

    closed = ("k2", "z", dt.date(2019, 1, 1), D1, False)
    # older than both open rows: nothing changes
    assert merged("2019-06-01") == {("k1", "a", D2, None, True), ("k2", "b", D1, None, True), closed}
    # the day k1 opened: corrected in place; k2 moves on
    assert merged(D2) == {("k1", "A", D2, None, True), ("k2", "b", D1, D2, False), ("k2", "B", D2, None, True), closed}


def test_scd2_stored_versions(spark, scratch):
    from lakemart.operators.scd import store_merge, stored_history

    assert stored_history(spark, scratch, "c") is None
    for city, day in (("a", "2020-01-01"), ("b", "2020-02-01"), ("c", "2020-03-01")):
        store_merge(spark, scratch, "c", spark.createDataFrame([("k", city)], "id string, city string"), "id", ["city"], day)
    assert sorted((r.city, r.is_current) for r in stored_history(spark, scratch, "c").collect()) == [
        ("a", False), ("b", False), ("c", True),
    ]
    # a version without its pointer is not seen
    stored_history(spark, scratch, "c").limit(0).write.parquet(f"{scratch}/history/c/version=4")
    assert stored_history(spark, scratch, "c").count() == 3


def test_scd2_reads_the_history_once_a_merge(spark):
    hist = spark.createDataFrame([("k1", "a", D1, None, True)], SCHEMA)
    feed = spark.createDataFrame([("k1", "b")], "id string, city string")
    for n in range(1, 4):
        hist = scd2_merge(hist, feed, "id", ["city"], f"2021-0{n}-01")
        plan = hist._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("FullOuter") == n


def test_scd2_initial_load(spark):
    feed = spark.createDataFrame([("k1", "a"), ("k1", "a")], "id string, city string")
    out = scd2_merge(None, feed, "id", ["city"], dt.date(2020, 1, 1)).collect()
    assert [(r.id, r.valid_from, r.is_current) for r in out] == [("k1", D1, True)]


def test_surrogate_keys_dense_in_key_order(spark):
    df = spark.range(0, 1000).selectExpr("CAST((id * 7919) % 1000 AS STRING) AS k").repartition(5)
    out = with_surrogate_key(df, "k", "sk", num_partitions=4).collect()
    assert sorted(r.sk for r in out) == list(range(1, 1001))
    by_key = sorted(out, key=lambda r: r.k)
    assert [r.sk for r in by_key] == list(range(1, 1001))


def test_surrogate_keys_with_repeated_keys_are_dense_and_repeatable(spark):
    # a third of the rows share one key value; ties are numbered by the other columns
    df = spark.range(0, 3000).selectExpr(
        "IF(id % 3 = 0, 'HOT', CAST(id AS STRING)) AS k", "id % 17 AS v", "id"
    ).repartition(7)
    first = {r.id: r.sk for r in with_surrogate_key(df, "k", "sk", num_partitions=5).collect()}
    again = {r.id: r.sk for r in with_surrogate_key(df, "k", "sk", num_partitions=5).collect()}
    assert sorted(first.values()) == list(range(1, 3001))
    assert first == again
