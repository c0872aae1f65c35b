"""Business parameters that the reference hard-codes.

Defaults are the reference's values. The driver's synthetic tables need other
values for some of them to produce non-trivial results (see README), so every
query takes a ``Params``.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Params:
    # customer segmentation (first match wins)
    high_value_ltv: float = 1000.0
    repeat_orders: int = 3
    # order status literal that counts as "delivered" in the conversion KPI
    delivered_status: str = "delivered"
    # anomaly thresholds
    freight_ratio: float = 0.5
    severe_delay_days: int = 21
    # top-k size of the category ranking
    top_k: int = 10
    # decimals of averages of averages and of shares: sums of doubles depend on the order
    # of the tasks in their last digits, so results are rounded to these
    score_digits: int = 6
    share_digits: int = 4


# Parameters used with the driver's TPC-H-like tables: there every person's
# lifetime value is above 1000, the finished status is 'F', and freight never
# exceeds half the price, so the defaults would give one-segment / empty answers.
DRIVER_PARAMS = Params(
    high_value_ltv=5_000_000.0,
    repeat_orders=19,
    delivered_status="F",
    freight_ratio=0.05,
    severe_delay_days=21,
    top_k=10,
)
