"""Command line: run one lake step on the session spark-submit provides.

    python -m lakemart ingest   --raw RAW_URI --base LAKE_URI
    python -m lakemart silver   --base LAKE_URI
    python -m lakemart gold     --base LAKE_URI [--marts]
    python -m lakemart keyed    --base LAKE_URI
    python -m lakemart history  --base LAKE_URI --as-of DATE
    python -m lakemart validate --base LAKE_URI --layer {bronze,silver,gold} [--raw RAW_URI]

Each step reads the previous layer from storage and writes its own, so steps can
run as separate jobs (and a failed step is re-run alone). ``validate`` writes the
quality table to ``<base>/quality/<layer>`` and prints the number of non-passing rows
and the first ``--show`` of them. ``keyed`` stores the star with surrogate keys;
``history`` merges silver's customers into their history (SCD type 2) as of a day.
Segment thresholds and the delivered status are options (reference defaults).
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from lakemart.params import Params


def _params(ns) -> Params:
    return Params(
        high_value_ltv=ns.high_value_ltv,
        repeat_orders=ns.repeat_orders,
        delivered_status=ns.delivered_status,
    )


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="lakemart")
    ap.add_argument("step", choices=["ingest", "silver", "gold", "keyed", "history", "validate"])
    ap.add_argument("--base", required=True, help="lake root URI")
    ap.add_argument("--raw", help="folder of the raw CSV files")
    ap.add_argument("--layer", choices=["bronze", "silver", "gold"], default="silver")
    ap.add_argument("--marts", action="store_true", help="also build the summary marts")
    ap.add_argument("--as-of", help="day of the feed, for history")
    ap.add_argument("--show", type=int, default=200, help="rows that validate prints")
    ap.add_argument("--high-value-ltv", type=float, default=Params.high_value_ltv)
    ap.add_argument("--repeat-orders", type=int, default=Params.repeat_orders)
    ap.add_argument("--delivered-status", default=Params.delivered_status)
    ns = ap.parse_args(argv)

    spark = SparkSession.builder.appName(f"lakemart-{ns.step}").getOrCreate()
    from lakemart.plans import build as B
    from lakemart.session import ensure_checkpoint_dir
    from lakemart.sources.files import GOLD_TABLES, read_layer, write_layer
    from lakemart.sources.ingest import ingest_raw, read_bronze
    from lakemart.sources.schemas import CATALOGUE

    if ns.step == "ingest":
        if not ns.raw:
            ap.error("ingest needs --raw")
        ingest_raw(spark, ns.raw, ns.base).show(truncate=False)
    elif ns.step == "silver":
        B.build_silver_layer(spark, read_bronze(spark, ns.base), ns.base)
    elif ns.step == "gold":
        silver = {t: read_layer(spark, ns.base, "silver", t) for t in CATALOGUE}
        gold = B.build_gold_layer(spark, silver, ns.base, _params(ns))
        B.build_star(spark, gold, ns.base)
        if ns.marts:
            B.build_mart_layer(spark, silver, ns.base, _params(ns), gold)
    elif ns.step == "keyed":
        silver = {t: read_layer(spark, ns.base, "silver", t) for t in CATALOGUE}
        gold = {t: read_layer(spark, ns.base, "gold", t) for t in GOLD_TABLES}
        ensure_checkpoint_dir(spark)
        B.build_keyed_layer(spark, silver, gold, ns.base)
    elif ns.step == "history":
        if not ns.as_of:
            ap.error("history needs --as-of")
        from lakemart.operators.scd import store_merge

        feed = read_layer(spark, ns.base, "silver", "customers")
        tracked = ("customer_city", "customer_state")
        store_merge(spark, ns.base, "customers", feed, "customer_id", tracked, ns.as_of)
    else:
        from lakemart.operators import quality as Q

        if ns.layer == "bronze":
            if not ns.raw:
                ap.error("validate --layer bronze needs --raw")
            result = Q.validate_bronze_files(spark, ns.raw)
        else:
            result = Q.validate_stored(spark, ns.base, ns.layer)
        path = write_layer(result, ns.base, "quality", ns.layer)
        stored = spark.read.parquet(path)
        failing = stored.where(F.col("status") != "PASS")
        print(f"{failing.count()} rows do not pass")
        failing.show(ns.show, truncate=False)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
