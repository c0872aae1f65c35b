"""CSV sources, raw -> bronze ingestion, auto-load and the refreshed revenue cube."""

import os

from pyspark.sql import functions as F

from lakemart.sources.files import read_csv, read_raw, write_csv
from lakemart.sources.ingest import ingest_raw, read_bronze
from lakemart.sources.schemas import CATALOGUE, RAW_SCHEMAS
from lakemart.streaming.autoload import copy_into
from lakemart.streaming.live import cube_of, region_distribution, revenue_trend, start_refresh

REVIEWS_CSV = (
    "review_id,order_id,review_score,review_comment_title,review_comment_message,"
    "review_creation_date,review_answer_timestamp\n"
    'r1,o1,5,,"great, fast\nwould buy again",2018-01-01 00:00:00,2018-01-02 00:00:00\n'
    "r2,o2,abc,,,not a date,\n"
)


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write(text)


def test_multiline_csv_keeps_split_records(spark, scratch):
    path = f"{scratch}/reviews.csv"
    _write(path, REVIEWS_CSV)
    schema = RAW_SCHEMAS["reviews"]
    assert read_csv(spark, path, schema, multiline=True).count() == 2
    # a line reader splits the quoted newline into an extra record
    assert read_csv(spark, path, schema, multiline=False).count() == 3
    assert read_raw(spark, path).columns[0] == "review_id"


def test_ingest_skips_missing_and_counts(spark, scratch):
    raw = f"{scratch}/raw"
    _write(f"{raw}/{CATALOGUE['reviews'].file}", REVIEWS_CSV)
    _write(f"{raw}/{CATALOGUE['sellers'].file}", "seller_id,seller_zip_code_prefix,seller_city,seller_state\ns1,01000,x,SP\n")
    report = {r.table: (r.rows, r.status) for r in ingest_raw(spark, raw, scratch).collect()}
    assert report["reviews"] == (2, "written") and report["sellers"] == (1, "written")
    assert report["orders"][1].startswith("skipped")
    bronze = read_bronze(spark, scratch)
    assert set(bronze) == {"reviews", "sellers"}
    assert bronze["sellers"].first().seller_zip_code_prefix == "01000"  # leading zero kept


def test_copy_into_loads_each_file_once(spark, scratch):
    stage, dst, ck = f"{scratch}/stage", f"{scratch}/raw_table", f"{scratch}/ck"
    df = spark.range(10).selectExpr("id", "id * 2 AS v")
    df.write.parquet(f"{stage}/a")
    schema = df.schema
    assert copy_into(spark, f"{stage}/a", dst, schema, ck) == 10
    assert copy_into(spark, f"{stage}/a", dst, schema, ck) == 0  # nothing new
    spark.range(10, 15).selectExpr("id", "id * 2 AS v").write.mode("append").parquet(f"{stage}/a")
    assert copy_into(spark, f"{stage}/a", dst, schema, ck) == 5
    assert spark.read.parquet(dst).count() == 15


def test_copy_into_counts_every_batch(spark, scratch):
    schema = "k int"
    for i in range(6):
        spark.range(10).selectExpr("cast(id as int) k").coalesce(1).write.parquet(f"{scratch}/in/f={i}")
    from lakemart.streaming.autoload import auto_load  # noqa: F401

    before = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "3")
    try:
        from pyspark.sql import types as T

        fields = T.StructType([T.StructField("k", T.IntegerType())])
        n = copy_into(
            spark, f"{scratch}/in/*", f"{scratch}/out", fields, f"{scratch}/ck", max_files_per_trigger=1
        )
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", before)
    assert n == 60 == spark.read.schema(schema).parquet(f"{scratch}/out").count()


def test_csv_is_bound_by_its_header(spark, scratch):
    import pytest

    from lakemart.sources.files import header_differences

    spec = CATALOGUE["sellers"]
    os.makedirs(f"{scratch}/raw")
    with open(f"{scratch}/raw/{spec.file}", "w") as f:
        f.write("Seller State,seller_id,SELLER_CITY,extra\nSP,s1,x,9\n")
    path = f"{scratch}/raw/{spec.file}"
    (row,) = read_csv(spark, path, spec.schema, required=spec.required).collect()
    assert row.asDict() == {"seller_id": "s1", "seller_zip_code_prefix": None, "seller_city": "x", "seller_state": "SP"}
    assert header_differences(spark, path, spec.schema) == (["seller_zip_code_prefix"], ["extra"])
    status = {r.table: r.status for r in ingest_raw(spark, f"{scratch}/raw", scratch).collect()}
    assert status["sellers"] == "written; absent: seller_zip_code_prefix; extra: extra"
    with open(path, "w") as f:
        f.write("Seller Id,seller_id,seller_city\na,b,c\n")
    with pytest.raises(ValueError):
        read_csv(spark, path, spec.schema)
    with open(path, "w") as f:
        f.write("seller_city\nc\n")
    status = {r.table: r.status for r in ingest_raw(spark, f"{scratch}/raw", scratch).collect()}
    assert status["sellers"].startswith("failed: ") and status["orders"].startswith("skipped")
    # files of one folder with unlike headers are refused
    os.makedirs(f"{scratch}/two")
    for name, head in (("a.csv", "seller_id,seller_city"), ("b.csv", "seller_city,seller_id")):
        with open(f"{scratch}/two/{name}", "w") as f:
            f.write(f"{head}\n1,2\n")
    with pytest.raises(Exception):
        read_csv(spark, f"{scratch}/two", spec.schema).collect()


def test_null_payment_types_are_kept(spark):
    from lakemart.plans.keyed import dim_payment, fact_payments

    pay = spark.createDataFrame(
        [("o1", 1, None, 1, 5.0), ("o2", 1, "card", 1, 6.0)],
        "order_id string, payment_sequential int, payment_type string, payment_installments int, payment_value double",
    )
    keys = {r.order_id: r.payment_type_key for r in fact_payments(pay, dim_payment(pay)).collect()}
    assert keys == {"o1": 1, "o2": 2}


def test_scratch_folders_do_not_pile_up(spark):
    import glob

    from lakemart.queries import QUERIES
    from lakemart.session import scratch_root

    root = os.path.dirname(scratch_root(spark, "none", "x")).removeprefix("file:")
    for _ in range(2):
        QUERIES["landing_raw_dim_date"](spark, "/root/testdata/sf0.001").count()
    assert len(glob.glob(f"{root}/lakemart-landing-raw_dim_date-*")) == 1


def test_refreshed_cube_equals_batch(spark, scratch):
    rows = spark.createDataFrame(
        [
            ("o1", 1, 10.0, 1.0, "SP", 2018, 1), ("o1", 2, 5.0, 0.0, "SP", 2018, 1),
            ("o2", 1, 7.0, 1.0, "RJ", 2018, 1), ("o3", 1, 3.0, 0.0, "SP", 2018, 2),
        ],
        "order_id string, order_item_id int, price double, freight_value double, "
        "customer_state string, year int, month int",
    ).withColumn("price", F.col("price").cast("decimal(18,2)")).withColumn(
        "freight_value", F.col("freight_value").cast("decimal(18,2)")
    )
    landed, cube = f"{scratch}/landed", f"{scratch}/cube"
    first, late = rows.where("order_id <> 'o1' OR order_item_id = 1"), rows.where("order_id = 'o1' AND order_item_id = 2")
    for part in (first, late):  # the late item revises January
        part.write.mode("append").parquet(landed)
        q = start_refresh(spark, spark.readStream.schema(rows.schema).parquet(landed), landed, cube, f"{scratch}/ck")
        q.awaitTermination()
    got = {(r.year, r.month): (r.revenue, r.orders) for r in revenue_trend(spark.read.parquet(cube)).collect()}
    assert got == {(2018, 1): (24.0, 2), (2018, 2): (3.0, 1)}
    batch = {(r.year, r.month, r.customer_state): r.orders for r in cube_of(rows).collect()}
    stream = {(r.year, r.month, r.customer_state): r.orders for r in spark.read.parquet(cube).collect()}
    assert batch == stream
    reg = {r.customer_state: r.orders for r in region_distribution(spark.read.parquet(cube)).collect()}
    assert reg == {"SP": 2, "RJ": 1}


def test_write_csv_roundtrip(spark, scratch):
    df = spark.createDataFrame([("a", "x\ny")], "k string, v string")
    write_csv(df, f"{scratch}/out")
    back = read_csv(spark, f"{scratch}/out", df.schema, multiline=True).collect()
    assert [tuple(r) for r in back] == [("a", "x\ny")]


def test_bronze_file_suite(spark, scratch):
    from lakemart.operators.quality import validate_bronze_files

    raw = f"{scratch}/raw"
    _write(f"{raw}/{CATALOGUE['reviews'].file}", REVIEWS_CSV)
    out = validate_bronze_files(spark, raw).collect()
    by = {(r.table, r.check, r.column): r.status for r in out}
    assert by[("reviews", "rows", None)] == "PASS"
    assert by[("reviews", "nulls", "review_comment_title")] == "WARN"
    orders = [(check, status) for (table, check, _), status in by.items() if table == "orders"]
    assert orders == [("readable", "FAIL")]  # missing file


def test_publish_register_and_parameterised_sql(spark, scratch):
    from lakemart.sources.files import cached, publish, register_views, run_query

    src = f"{scratch}/src"
    spark.createDataFrame([("SP", 10.0), ("RJ", 5.0), ("SP", 1.0)], "state string, v double").write.parquet(src)
    publish(spark, src, f"{scratch}/lake/gold/t")
    df = cached(spark.read.parquet(f"{scratch}/lake/gold/t"))
    register_views({"t": df})
    out = run_query(spark, "SELECT SUM(v) AS s FROM t WHERE state = :state", {"state": "SP"}).collect()
    assert out[0].s == 11.0
    # a value that looks like SQL stays a value
    assert run_query(spark, "SELECT COUNT(*) AS n FROM t WHERE state = :state", {"state": "SP' OR '1'='1"}).first().n == 0
    df.unpersist()


def test_command_line_steps(spark, scratch):
    from lakemart.__main__ import main
    from lakemart.sources.adapter import raw_tables

    raw = f"{scratch}/raw"
    for name, df in raw_tables(spark, "/root/testdata/sf0.001").items():
        write_csv(df, f"{raw}/{CATALOGUE[name].file}")
    base = f"{scratch}/lake"
    for argv in (
        ["ingest", "--raw", raw, "--base", base],
        ["silver", "--base", base],
        ["gold", "--base", base, "--marts"],
        ["validate", "--base", base, "--layer", "gold"],
        ["validate", "--base", base, "--layer", "silver"],
        ["validate", "--base", base, "--layer", "bronze", "--raw", raw],
    ):
        assert main(argv) == 0
    assert spark.read.parquet(f"{base}/gold/star").count() > 0
    # six star-schema tables, the joined star and the eleven marts
    assert spark.read.parquet(f"{base}/quality/gold").where("check = 'rows'").count() == 18
    silver_q = spark.read.parquet(f"{base}/quality/silver")
    assert silver_q.where("check = 'key_unique'").count() == 6  # tables with a key
    bronze_q = spark.read.parquet(f"{base}/quality/bronze")
    assert bronze_q.where("check = 'rows' AND status = 'PASS'").count() == 9


def test_refresh_replay_is_idempotent(spark, scratch):
    from lakemart.streaming.live import months_filter, refresh_months, touched_months

    rows = spark.createDataFrame(
        [("o1", 1, 10.0, 1.0, "SP", 2018, 1), ("o2", 1, 7.0, 1.0, "RJ", 2018, 2)],
        "order_id string, order_item_id int, price double, freight_value double, "
        "customer_state string, year int, month int",
    )
    landed, cube = f"{scratch}/landed", f"{scratch}/cube"
    rows.write.partitionBy("year", "month").parquet(landed)
    batch = rows.where("month = 1")
    refresh_months(spark, batch, landed, cube)
    first = sorted(map(tuple, spark.read.parquet(cube).collect()))
    refresh_months(spark, batch, landed, cube)  # the same micro-batch replayed
    assert sorted(map(tuple, spark.read.parquet(cube).collect())) == first
    assert touched_months(batch) == [(2018, 1)]
    none_month = spark.createDataFrame([(2018, None)], "year int, month int")
    assert touched_months(none_month) == [(2018, None)]
    assert rows.where(months_filter([(2018, 2)])).count() == 1


def test_written_csv_is_compressed_and_in_files_of_bounded_rows(spark, scratch, monkeypatch):
    from lakemart.sources import files

    monkeypatch.setattr(files, "CSV_ROWS", 10)
    df = spark.range(0, 35, 1, 1).selectExpr("id", "concat('line\n', id, ',\"q') AS t")
    files.write_csv(df, f"{scratch}/csv")
    back = spark.read.options(header=True, multiLine=True, escape='"').csv(f"{scratch}/csv")
    assert len(back.inputFiles()) == 4 and all(f.endswith(".csv.gz") for f in back.inputFiles())
    assert sorted((int(r.id), r.t) for r in back.collect()) == sorted((r.id, r.t) for r in df.collect())


def test_a_partitioned_load_adds_few_files_a_folder(spark, tmp_path):
    """files land by folder, not by task and folder; every row lands once."""
    from pyspark.sql import functions as F

    from lakemart.streaming.autoload import auto_load

    src, dst = str(tmp_path / "in"), str(tmp_path / "out")
    rows = spark.range(4000).select("id", F.when(F.col("id") % 5 > 0, F.col("id") % 5).alias("month"))
    for wave in range(2):
        rows.where(F.col("id") % 2 == wave).repartition(6).write.mode("append").parquet(src)
        load = auto_load(spark, src, dst, rows.schema, str(tmp_path / "ck"), partition_by=("month",))
        load.awaitTermination()
        assert load.exception() is None
    assert sorted(map(tuple, spark.read.parquet(dst).select("id", "month").collect()), key=str) == sorted(
        map(tuple, rows.collect()), key=str
    )
    assert all(len(list(folder.glob("*.parquet"))) <= 4 for folder in (tmp_path / "out").glob("month=*"))
