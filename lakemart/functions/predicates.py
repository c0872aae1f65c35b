"""Predicates of the dashboard: the optional star filter and the anomaly rules.

Filters are built as Columns, never as spliced SQL text, so values cannot inject
SQL and Catalyst can push each conjunct to the scan (or prune partitions when the
star is stored partitioned by year/month).
"""

from __future__ import annotations

from decimal import Decimal
from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F

ALL = "All"


def _given(value) -> bool:
    return value is not None and value != ALL


def star_filter(state=None, year=None, category=None, status=None) -> Column:
    """Conjunction of the chosen conditions over star columns.

    ``None`` or ``"All"`` means "no condition" for that field. Columns used:
    ``customer_state``, ``year``, ``category_name``, ``order_status``.
    """
    conds: list[Column] = [F.lit(True)]
    if _given(state):
        conds.append(F.col("customer_state") == F.lit(state))
    if _given(year):
        conds.append(F.col("year") == F.lit(int(year)))
    if _given(category):
        conds.append(F.col("category_name") == F.lit(category))
    if _given(status):
        conds.append(F.col("order_status") == F.lit(status))
    return reduce(and_, conds)


def year_lifted(state=None, year=None, category=None, status=None) -> Column:
    """The same filter with the year condition removed (year-on-year view)."""
    return star_filter(state=state, year=None, category=category, status=status)


def freight_outlier(ratio: float = 0.5) -> Column:
    """Item whose freight exceeds ``ratio`` times its price.

    The ratio is an exact decimal literal, so a DECIMAL price is compared
    exactly (``0.05`` as a double would move items on the boundary).
    """
    return F.col("freight_value") > F.col("price") * F.lit(Decimal(repr(ratio)))


def severe_delay(days: int = 21) -> Column:
    """Order delivered more than ``days`` calendar days after purchase."""
    return F.col("delivery_days") > F.lit(days)


def in_segments(segments=("High Value", "Repeat")) -> Column:
    return F.col("customer_segment").isin(*segments)
