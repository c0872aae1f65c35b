"""Gold kept up to date by changes: a new silver rewrites the months it touches.

The facts and the star are kept in parts, a folder a month of purchase (orders without a
purchase date have one of their own), in a versioned lake (``sources/versions``).
``refresh_gold`` publishes the next version:

1. **Which orders changed.** Beside gold lies ``order_marks``: an order's month, and its number
   and the sum of 64-bit hashes of its rows in orders, items, payments and reviews (the columns
   gold reads; NULLs told apart from absent values; repeated rows counted). The stored marks
   meet the rows' hashes in the aggregate that sums those: new, corrected, removed and moved
   orders differ. A loader that knows the ids gives them as ``touched``
   instead, and no marks are compared.
2. **Which months.** Those of the changed orders, before and after (an order may move).
   Only months, never orders, come to the driver.
3. **Facts** of these months are built from silver rows of their orders and take the place
   of these folders; all others stay where they are.
4. **Dimensions** are written whole: a row a customer, product, seller or day. Lifetime
   values read the stored facts.
5. **Star.** A customer's segment, state or person, or a product's category, may have
   changed too, and stands in star rows of other months; those months are found by a join
   of the facts with the changed members and rewritten as well. Where no row comes or goes
   by it, the stored star's rows are copied with the members' new columns, month by month
   as they lie; only the other months are joined anew.

The result equals a full build. Silver without a change publishes a version that rewrites no
fact or star folder. An empty silver leaves empty tables.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.params import Params
from lakemart.plans import gold as G
from lakemart.sources import versions
from lakemart.sources.files import delete_path
from lakemart.sources.versions import Snapshot, Stage

MONTH = ("year", "month")
NO_DATE = -1

#: The columns that gold reads of what belongs to an order.
READ = {
    "orders": ("customer_id", "order_status", "order_purchase_timestamp", "order_delivered_customer_date"),
    "order_items": ("order_item_id", "product_id", "seller_id", "price", "freight_value"),
    "payments": ("payment_value",),
    "reviews": ("review_score",),
}
MARKS = ("mark_a", "mark_b", "n")
#: Rows up to which a side of a join is sent to every executor: counted before, so that the
#: other side (rows of all items) stays where it is.
FEW = 1_000_000


def _marked(df: DataFrame, tag: str, columns: Sequence[str], *more: str | Column) -> DataFrame:
    """Each row's 64-bit hash of ``columns`` as two halves, whose sums fit a long, beside
    the columns ``more``."""
    seen = [*[F.col(c) for c in columns], *[F.col(c).isNull() for c in columns]]
    mark = F.xxhash64(F.lit(tag), *seen)
    return df.select(*more, F.shiftright(mark, 32).alias("mark_a"), mark.bitwiseAND(0xFFFFFFFF).alias("mark_b"))


def _summed(rows: DataFrame, key: str, *more: Column) -> DataFrame:
    return rows.groupBy(key).agg(
        F.sum("mark_a").alias("mark_a"), F.sum("mark_b").alias("mark_b"), F.count("mark_a").alias("n"), *more
    )


def _differing(before: DataFrame, after: DataFrame, key: str, *more: Column, there: str = "n > 0") -> DataFrame:
    """Keys (a NULL one is one key) whose marks differ or that one side lacks. ``before`` is
    summed; it meets the rows of ``after`` in the one aggregate that sums those, so each
    side is shuffled once. ``there``: whether a key is in ``after``. Columns of ``before``
    are named ``before_*``."""
    held = before.select(key, *[F.col(c).alias(f"before_{c}") for c in before.columns if c != key])
    kept = [F.max(c).alias(c) for c in held.columns if c != key]
    both = _summed(after.unionByName(held, allowMissingColumns=True), key, *kept, *more).withColumn("there", F.expr(there))
    return both.where(" OR ".join(f"NOT if(there, {c}, NULL) <=> before_{c}" for c in MARKS))


def _few(df: DataFrame) -> DataFrame:
    """``df``, to be sent to every executor if it has few rows."""
    return F.broadcast(df) if df.count() <= FEW else df


def _order_rows(silver: Mapping[str, DataFrame]) -> DataFrame:
    """The marks of every row that belongs to an order, with the day of an order's own row."""
    def rows(table: str) -> DataFrame:
        own = table == "orders"
        day = F.to_date("order_purchase_timestamp") if own else F.lit(None).cast("date")
        return _marked(silver[table], table, READ[table], "order_id", day.alias("day"), F.lit(own).alias("own"))

    return reduce(DataFrame.unionByName, [rows(t) for t in READ])


def _of_order() -> list[Column]:
    return [F.max(c).alias(c) for c in ("day", "own")]


def order_marks(silver: Mapping[str, DataFrame]) -> DataFrame:
    """order_id, marks, year and month of purchase; a row for each order of silver."""
    summed = _summed(_order_rows(silver), "order_id", *_of_order()).where("own")
    return summed.select("order_id", *MARKS, F.year("day").alias("year"), F.month("day").alias("month"))


def _changed_months(before: DataFrame, silver: Mapping[str, DataFrame]) -> set[int]:
    """Months, before and after, of the orders whose marks differ from the stored ones."""
    changed = _differing(before, _order_rows(silver), "order_id", *_of_order(), there="coalesce(own, false)")
    was = F.when(F.col("before_n").isNotNull(), _code("before_year", "before_month"))
    now = F.when(F.col("there"), _code(F.year("day"), F.month("day")))
    months = changed.select(F.explode(F.array(was, now)).alias("m")).where("m IS NOT NULL").distinct()
    return {r.m for r in months.collect()}


def _code(year: str | Column, month: str | Column) -> Column:
    year, month = (F.col(c) if isinstance(c, str) else c for c in (year, month))
    return F.coalesce(year * 100 + month, F.lit(NO_DATE))


def _part_code(part: str) -> int:
    """The month of a folder ``year=../month=..``."""
    year, month = (value.partition("=")[2] for value in part.split("/"))
    return int(year) * 100 + int(month) if year.isdigit() and month.isdigit() else NO_DATE


def _months(df: DataFrame) -> set[int]:
    """The distinct months of rows with ``year`` and ``month``: a few hundred numbers."""
    return {r[0] for r in df.select(_code(*MONTH).alias("m")).distinct().collect()}


def _of_months(df: DataFrame, months: set[int] | None) -> DataFrame:
    return df if months is None else df.where(_code(*MONTH).isin(sorted(months)))


def _orders_with_month(silver: Mapping[str, DataFrame]) -> DataFrame:
    day = F.to_date("order_purchase_timestamp")
    return silver["orders"].withColumn("year", F.year(day)).withColumn("month", F.month(day))


def _touched_months(before: DataFrame, silver: Mapping[str, DataFrame], touched: DataFrame) -> set[int]:
    ids = touched.select("order_id").distinct()
    held = before.join(ids, before["order_id"].eqNullSafe(ids["order_id"]), "left_semi").select(*MONTH)
    orders = _orders_with_month(silver)
    now = orders.join(ids, orders["order_id"].eqNullSafe(ids["order_id"]), "left_semi").select(*MONTH)
    return _months(held.unionByName(now))


def _scoped(silver: Mapping[str, DataFrame], months: set[int] | None) -> dict[str, DataFrame]:
    """Silver rows of the orders of ``months``."""
    if months is None:
        return dict(silver)
    orders = _of_months(_orders_with_month(silver), months).drop(*MONTH)
    ids = _few(orders.select("order_id"))
    rest = {t: silver[t].join(ids, "order_id", "left_semi") for t in READ if t != "orders"}
    return {**silver, "orders": orders, **rest}


def _with_month(fact: DataFrame) -> DataFrame:
    day = F.col("date_key").try_cast("date")
    return fact.withColumn("year", F.year(day)).withColumn("month", F.month(day))


#: What the star has of its members: dimension, key, columns, the fact that names the key.
MEMBERS = (
    ("dim_customers", "customer_id", ("customer_unique_id", "customer_state", "customer_segment"), "fact_orders"),
    ("dim_products", "product_id", ("category_name",), "fact_sales"),
)


def _changed_members(before: Snapshot, stage: Stage) -> dict[str, DataFrame]:
    """By dimension, the keys whose columns of the star changed; ``same``: one row of the
    dimension has the key, before and after, so no star row comes or goes by it."""
    out = {}
    for dim, key, columns, _ in MEMBERS:
        old, new = (_marked(lake.read("gold", dim), dim, columns, key) for lake in (before, stage))
        same = F.expr("n <=> 1 AND before_n <=> 1").alias("same")
        path = f"{stage.base}/work/{dim}"
        _differing(_summed(old, key), new, key).select(key, same).write.parquet(path)
        out[dim] = stage.spark.read.parquet(path)
    return out


def _star_months(stage: Stage, members: Mapping[str, DataFrame]) -> dict[bool, set[int]]:
    """Months of facts with changed members: False, those where star rows may come or go;
    True, all others."""
    found: set[tuple[bool, int]] = set()
    for dim, key, _, fact in MEMBERS:
        hit = stage.read("gold", fact).join(_few(members[dim]), key)
        found |= {tuple(r) for r in hit.select("same", _code(*MONTH)).distinct().collect()}
    moved, kept = ({m for same, m in found if same is which and m != NO_DATE} for which in (False, True))
    return {False: moved, True: kept - moved}


def _members_renewed(star: DataFrame, stage: Stage, members: Mapping[str, DataFrame]) -> DataFrame:
    """Star rows with the columns that their changed members have now."""
    out = star
    for dim, key, columns, _ in MEMBERS:
        changed = _few(members[dim].where("same"))
        now = stage.read("gold", dim).join(changed, key, "left_semi").select(key, F.struct(*columns).alias("now"))
        renewed = {c: F.when(F.col("now").isNotNull(), F.col(f"now.{c}")).otherwise(F.col(c)) for c in columns}
        out = out.join(_few(now), key, "left").withColumns(renewed).drop("now")
    return out.select(*star.columns)


def refresh_gold(
    spark: SparkSession,
    silver: Mapping[str, DataFrame],
    base: str,
    params: Params = Params(),
    touched: DataFrame | None = None,
) -> Snapshot:
    """The next version of gold for ``silver``; the first one is a full build.

    ``touched`` (column ``order_id``): the orders that any of the feed's rows belong to, if
    the loader knows them; else they are found by their marks. The version's note says which
    months (``year * 100 + month``; -1: without a date) of facts and star were rewritten."""
    with versions.build(spark, base) as stage:
        before = stage.before
        kept = before.parts.get("gold/order_marks") if before else None
        first = kept is None or kept.schema["mark_a"].dataType != T.LongType()  # marks of another kind
        months: set[int] | None = None
        if not first:
            held = before.read("gold", "order_marks")
            months = _changed_months(held, silver) if touched is None else _touched_months(held, silver, touched)

        def in_scope(of: set[int] | None):
            return None if of is None else (lambda part: _part_code(part) in of)

        scoped = _scoped(silver, months)
        for name, fact in G.build_facts(scoped).items():
            stage.write_parts(_with_month(fact), f"gold/{name}", MONTH, in_scope(months))
        stage.write_parts(order_marks(scoped), "gold/order_marks", MONTH, in_scope(months))

        facts = {t: stage.read("gold", t) for t in ("fact_sales", "fact_orders")}
        for name, dim in G.build_dims(silver, facts, params).items():
            dim.write.mode("overwrite").parquet(f"{stage.base}/gold/{name}")
        star_months = rebuilt = months
        renewed = None
        if months is not None:
            members = _changed_members(before, stage)
            hit = _star_months(stage, members)
            rebuilt = (months - {NO_DATE}) | hit[False]
            star_months = rebuilt | hit[True]
            if hit[True] - rebuilt:
                old = _of_months(before.read("gold", "star"), hit[True] - rebuilt)
                renewed = _members_renewed(old, stage, members)
        gold = {t: _of_months(f, rebuilt).drop(*MONTH) for t, f in facts.items()}
        gold |= {t: stage.read("gold", t) for t in ("dim_date", "dim_customers", "dim_products", "dim_sellers")}
        stage.write_parts(G.star(gold), "gold/star", MONTH, in_scope(star_months), renewed)
        delete_path(spark, f"{stage.base}/work")
        stage.note["months"] = {
            "facts": None if months is None else sorted(months),
            "star": None if star_months is None else sorted(star_months),
        }
    return versions.snapshot(spark, base, stage.version)


def rewritten(snapshot: Snapshot, table: str) -> DataFrame:
    """Each folder of a gold table in parts: year, month, and whether this version wrote it."""
    kept = snapshot.parts[f"gold/{table}"]
    rows = [(_part_code(p), v == snapshot.version) for p, v in kept.written.items()]
    dated = [(c // 100 if c > 0 else None, c % 100 if c > 0 else None, new) for c, new in rows]
    return snapshot.spark.createDataFrame(dated, "year int, month int, rewritten boolean")
