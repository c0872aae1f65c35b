"""A lazily built lake: raw -> silver -> gold -> star, over any raw source.

Nothing runs until a query result is written or collected; Catalyst sees the
whole plan from the raw scans, so column pruning and filter pushdown reach the
Parquet readers.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from lakemart.params import Params
from lakemart.plans import gold as G
from lakemart.plans.silver import build_silver


class Lake:
    def __init__(self, raw: Mapping[str, DataFrame], params: Params = Params()):
        self.raw = dict(raw)
        self.params = params

    @classmethod
    def from_driver(cls, spark: SparkSession, sf_dir: str, params: Params = Params()) -> "Lake":
        from lakemart.sources.adapter import raw_tables

        return cls(raw_tables(spark, sf_dir), params)

    @cached_property
    def silver(self) -> dict[str, DataFrame]:
        return build_silver(self.raw)

    @cached_property
    def _read_silver(self) -> dict[str, DataFrame]:
        """Silver's rows with the columns that gold reads."""
        narrow = build_silver({t: df for t, df in self.raw.items() if t in G.READS}, G.READS)
        return {**self.silver, **narrow}

    @cached_property
    def gold(self) -> dict[str, DataFrame]:
        return G.build_gold(self._read_silver, self.params)

    @cached_property
    def star(self) -> DataFrame:
        return G.star_of_items(self._read_silver["order_items"], self.gold)
