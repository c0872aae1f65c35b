"""Layer-by-layer build of the lake into storage.

Each layer is written, then read back for the next one. The written tables cut
the lineage: a lost executor re-runs only the current layer's tasks, never the
whole chain from the raw files.

The joined ``star`` (item grain, the columns the dashboard reads) is stored
partitioned by ``year, month``, so a year filter prunes whole directories.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from lakemart.operators.registry import KeyRegistry
from lakemart.params import Params
from lakemart.plans import gold as G
from lakemart.plans.marts import build_marts
from lakemart.plans.silver import build_silver, rejected_order_items
from lakemart.sources import versions
from lakemart.sources.files import read_layer, write_layer, write_tables
from lakemart.sources.versions import Snapshot

STAR_PARTITIONS = ("year", "month")


def analyse(plans: Mapping[str, DataFrame]) -> None:
    """Resolve every plan (names, types) without running a job.

    Called before the first write, so a wrong column or type fails the build
    while the lake is still untouched instead of leaving half a layer written.
    """
    for df in plans.values():
        df.schema  # noqa: B018


def build_silver_layer(spark: SparkSession, raw: Mapping[str, DataFrame], base: str) -> dict[str, DataFrame]:
    """Silver, and beside it the item rows whose amounts the money type can't hold."""
    plans = build_silver(raw)
    write_tables(plans, base, "silver")
    if "order_items" in raw:
        write_tables({"order_items": rejected_order_items(raw["order_items"])}, base, "rejects")
    return {t: read_layer(spark, base, "silver", t) for t in plans}


def build_gold_layer(
    spark: SparkSession, silver: Mapping[str, DataFrame], base: str, params: Params = Params()
) -> dict[str, DataFrame]:
    """Facts first; dimensions that need a fact (LTV) read the stored fact."""
    lazy = G.build_gold(silver, params)
    analyse({**lazy, "star": G.star(lazy)})
    facts = G.build_facts(silver)
    write_tables(facts, base, "gold")
    stored = {t: read_layer(spark, base, "gold", t) for t in facts}
    dims = G.build_dims(silver, stored, params)
    write_tables(dims, base, "gold")
    return {**{t: read_layer(spark, base, "gold", t) for t in dims}, **stored}


def build_star(spark: SparkSession, gold: Mapping[str, DataFrame], base: str) -> DataFrame:
    write_layer(G.star(gold), base, "gold", "star", partition_by=STAR_PARTITIONS)
    return read_layer(spark, base, "gold", "star")


def build_mart_layer(
    spark: SparkSession,
    silver: Mapping[str, DataFrame],
    base: str,
    params: Params = Params(),
    gold: Mapping[str, DataFrame] | None = None,
) -> dict[str, DataFrame]:
    """Write the wide item-grain sales_mart once; derive the others from it and from the
    stored gold facts."""
    from lakemart.plans.marts import sales_mart

    write_layer(sales_mart(silver), base, "marts", "sales_mart")
    stored = read_layer(spark, base, "marts", "sales_mart")
    plans = build_marts(silver, params, mart=stored, gold=gold)
    del plans["sales_mart"]
    write_tables(plans, base, "marts")
    return {"sales_mart": stored, **{t: read_layer(spark, base, "marts", t) for t in plans}}


def gold_and_marts(
    spark: SparkSession, raw: Mapping[str, DataFrame], base: str, params: Params = Params()
) -> dict[str, DataFrame]:
    """Gold and the marts, for a suite that reads all of them once: as plans over two
    stored steps that most of them share, the order rows and the wide mart, so that repeated
    keys are removed and items joined once, not in each of the plans."""
    from lakemart.plans.marts import order_rows, sales_mart

    narrow = build_silver({"reviews": raw["reviews"]}, {"reviews": G.READS["reviews"]})
    silver = {**build_silver(raw), **narrow}
    columns = silver["orders"].columns
    write_layer(order_rows(silver), base, "steps", "order_rows")
    rows = read_layer(spark, base, "steps", "order_rows")
    silver["orders"] = rows.select(*columns)
    write_layer(sales_mart(silver, rows, marked=True), base, "steps", "sales_mart")
    mart = read_layer(spark, base, "steps", "sales_mart")
    gold = G.build_gold(silver, params, rows)
    lifetime = G.ltv_of_items(silver["order_items"], silver["orders"], silver["customers"])
    return {**gold, **build_marts(silver, params, mart, gold, lifetime)}


def build_keyed_layer(
    spark: SparkSession, silver: Mapping[str, DataFrame], gold: Mapping[str, DataFrame], base: str
) -> dict[str, DataFrame]:
    """The star with surrogate keys, stored beside gold: dimensions first, then the facts
    that read their keys from the stored dimensions.

    Keys come from the registries below ``base``: a further load numbers what is new and
    leaves every key given before, so facts stored earlier keep their meaning."""
    from lakemart.plans import keyed as K

    members = {
        "dim_customer": (gold["dim_customers"], "customer_id", "customer_key"),
        "dim_product": (gold["dim_products"], "product_id", "product_key"),
        "dim_seller": (gold["dim_sellers"], "seller_id", "seller_key"),
        "dim_payment": (silver["payments"].select("payment_type").distinct(), "payment_type", "payment_type_key"),
    }
    dims = {
        table: KeyRegistry(spark, base, table.removeprefix("dim_"), key, name).load_and_key(df)
        for table, (df, key, name) in members.items()
    }
    write_tables(dims, base, "keyed")
    d = {t: read_layer(spark, base, "keyed", t) for t in dims}
    facts = {
        "fact_payments": K.fact_payments(silver["payments"], d["dim_payment"]),
        "fact_order_items": K.fact_order_items(
            gold["fact_sales"], d["dim_customer"], d["dim_product"], d["dim_seller"]
        ),
    }
    write_tables(facts, base, "keyed")
    return {**d, **{t: read_layer(spark, base, "keyed", t) for t in facts}}


def build_published(
    spark: SparkSession,
    raw: Mapping[str, DataFrame],
    base: str,
    params: Params = Params(),
    marts: bool = False,
) -> Snapshot:
    """The lake as a new version: readers see all of it or the version before. Returns
    the version read anew."""
    with versions.build(spark, base) as stage:
        build_lake(spark, raw, stage.base, params, marts)
    return versions.snapshot(spark, base, stage.version)


def build_lake(
    spark: SparkSession,
    raw: Mapping[str, DataFrame],
    base: str,
    params: Params = Params(),
    marts: bool = False,
) -> dict[str, DataFrame]:
    """raw -> silver -> gold (+ star, + marts); returns the stored tables.

    All plans of all layers are analysed before anything is written.
    """
    lazy_silver = build_silver(raw)
    lazy_gold = G.build_gold(lazy_silver, params)
    analyse({**lazy_silver, **lazy_gold, "star": G.star(lazy_gold)})
    if marts:
        analyse(build_marts(lazy_silver, params))
    silver = build_silver_layer(spark, raw, base)
    gold = build_gold_layer(spark, silver, base, params)
    out = {**{f"silver.{k}": v for k, v in silver.items()}, **gold}
    out["star"] = build_star(spark, gold, base)
    if marts:
        out.update({f"marts.{k}": v for k, v in build_mart_layer(spark, silver, base, params, gold).items()})
    return out
