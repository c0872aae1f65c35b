"""Surrogate keys that stay: a stored registry of natural key -> number.

The first load numbers its keys 1, 2, 3, ... in natural-key order; each later one finds the
keys the registry lacks by an anti join and numbers only those, above the largest number
given so far, by the same range-and-offset method (``operators.keys``). Numbers have no
gap, and a number once given stays with its key, so stored facts keep pointing to the
right rows whatever is loaded later.

Every load's new keys are a table of their own in the registry's versions
(``sources.versions``): a load writes what is new, not the registry, and is seen whole or
not at all. The largest number is in the manifest, so no load scans for it. Two loads at
once: one of them gets ``Conflict`` and is run again. A null key is a key too.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.operators.keys import with_surrogate_key
from lakemart.sources.versions import Snapshot, build, snapshot

_LAYER = "keys"


class KeyRegistry:
    """Numbers of one entity's natural keys below ``base``."""

    def __init__(self, spark: SparkSession, base: str, entity: str, natural_key: Sequence[str] | str, name: str):
        self.spark, self.name = spark, name
        self.root = f"{base.rstrip('/')}/registry/{entity}"
        self.keys = [natural_key] if isinstance(natural_key, str) else list(natural_key)

    def _all(self, version: Snapshot | None) -> DataFrame | None:
        parts = list(version.layer(_LAYER).values()) if version else []
        return reduce(DataFrame.unionByName, parts) if parts else None

    def numbers(self) -> DataFrame | None:
        """Natural key and number of every key known; None before the first load."""
        return self._all(snapshot(self.spark, self.root))

    def largest(self) -> int:
        version = snapshot(self.spark, self.root)
        return int(version.note["largest"]) if version else 0

    def load(self, incoming: DataFrame) -> int:
        """Number the keys of ``incoming`` that have none; returns how many were new."""
        known = snapshot(self.spark, self.root)
        largest = int(known.note["largest"]) if known else 0
        keys = incoming.select(*self.keys).distinct()
        held = self._all(known)
        if held is not None:
            there = held.select(*[F.col(k).alias(f"known_{k}") for k in self.keys])
            same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"known_{k}")) for k in self.keys])
            keys = keys.join(there, same, "left_anti")
        numbered = with_surrogate_key(keys, self.keys, self.name)
        shifted = numbered.withColumn(self.name, F.col(self.name) + F.lit(largest))
        with build(self.spark, self.root) as stage:
            path = f"{stage.base}/{_LAYER}/load={stage.version:09d}"
            shifted.write.parquet(path)
            new = self.spark.read.parquet(path).count()  # from the files' footers
            stage.note["largest"] = largest + new
        return new

    def keyed(self, df: DataFrame) -> DataFrame:
        """``df`` with the numbers of its keys beside them (null where unknown)."""
        numbers = self.numbers()
        if numbers is None:
            return df.withColumn(self.name, F.lit(None).cast("bigint"))
        there = numbers.select(*[F.col(k).alias(f"known_{k}") for k in self.keys], self.name)
        same = reduce(lambda a, b: a & b, [df[k].eqNullSafe(there[f"known_{k}"]) for k in self.keys])
        return df.join(there, same, "left").drop(*[f"known_{k}" for k in self.keys])

    def load_and_key(self, df: DataFrame) -> DataFrame:
        """Number what is new in ``df``, then return it with all its numbers."""
        self.load(df)
        return self.keyed(df)
