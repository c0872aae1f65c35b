"""Operator 12: shards of near equal bytes by histogram sort, native.

Rows are ordered by a key of three words: a hash of the text (60 bits of its MD5), the id
and a number of the row's own, so equal texts lie side by side. A target is the byte count
that should lie below a shard's border. Rounds of probes look for it: the first counts the
exact bytes below the edges of 2^``CELL_BITS`` equal parts of the hash, in all partitions
at once; each further one only looks at the parts in which a target lies and cuts them
again, by ``PROBES`` edges in all, down to a single text's group. If one edge of the group lies within
``tolerance`` of a shard's size from the target, the border is there and the copies
stay together; else the probes go on within the group by id, and then by row. Counts per
round: 2^``CELL_BITS``, or ``PROBES`` or four a shard, whatever the input's size. With the
borders known, the narrow rows are exchanged once, by ranges of (shard, key), and numbered.

The law is ``bytes``: a shard's size differs from an equal share by the tolerance and the
largest row at most. The borders follow from the rows alone, not from probes, partitions
or the order of the input.

Null text counts as none (16 bytes, and a group of its own with empty texts). Null ids
come first among equal texts; repeated rows may be told apart only by their numbers, so
which of them is in which shard is arbitrary. Fewer rows than shards leave shards empty;
an empty table gives an empty table. Other columns are carried on request, whatever their
names, except the result's own, which are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import settled, shuffle_width

SHARDS = 40
OVERHEAD = 16
#: Of a shard's equal share; a border may lie that far from its target to spare a group.
TOLERANCE = 0.01
CELL_BITS = 12
HASH_BITS = 60
PROBES = 1 << 13
_LOWEST = -(1 << 63)
_POSITION = (1 << 33) - 1


def keyed(df: DataFrame, spark: SparkSession, id_col: str, text_col: str, carry: list[str]) -> DataFrame:
    """The rows with size, checksum and key words, checkpointed so that row numbers stay."""
    text = F.coalesce(df[text_col].cast("string"), F.lit(""))
    digest = F.conv(F.substring(F.md5(text.cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("long")
    rows = df.select(
        df[id_col].cast("long").alias("doc_id"),
        (F.octet_length(text) + F.lit(OVERHEAD)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        digest.alias("w1"),
        F.coalesce(df[id_col].cast("long"), F.lit(_LOWEST)).alias("w2"),
        F.struct(*[df[c] for c in carry] or [F.lit(0).alias("none")]).alias("carried"),
    )
    return settled(rows, spark).withColumn("w3", F.monotonically_increasing_id())


@dataclass
class Bracket:
    """Rows among which a target lies: words below ``level`` fixed to ``words``, the next
    one from ``low`` to ``high``; ``before`` bytes stand in front of them."""

    words: tuple[int, ...]
    low: int
    high: int
    before: int
    targets: list[int]

    def step(self, probes: int) -> int:
        return -(-(self.high - self.low + 1) // probes)

    @property
    def hash(self) -> int:
        return self.words[0] if self.words else self.low


_BRACKETS = T.StructType(
    [T.StructField("bracket", T.IntegerType())]
    + [T.StructField(c, T.LongType()) for c in ("cell", "level", "low", "high", "fixed1", "fixed2")]
    + [T.StructField("step", T.DecimalType(20, 0))]
)


def _cell(hash_: Column) -> Column:
    return F.shiftright(hash_, HASH_BITS - CELL_BITS)


def _counts(rows: DataFrame, *by: str) -> DataFrame:
    """Exact bytes and rows of each part, and the least and largest words there."""
    words = [f(w).alias(f"{name}_{w}") for w in ("w1", "w2", "w3") for name, f in (("low", F.min), ("high", F.max))]
    return rows.groupBy(*by).agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"), *words)


def _probed(rows: DataFrame, brackets: list[Bracket], spark: SparkSession) -> dict[int, list]:
    """By bracket, the counts of its parts in order."""
    probes = max(4, PROBES // len(brackets))
    width = HASH_BITS - CELL_BITS
    places = [
        (i, b.hash >> width, len(b.words), b.low, b.high, *(*b.words, 0, 0)[:2], Decimal(b.step(probes)))
        for i, b in enumerate(brackets)
    ]
    table = spark.createDataFrame(places, _BRACKETS)  # a row a shard at most
    word = F.when(F.col("level") == 0, F.col("w1")).when(F.col("level") == 1, F.col("w2")).otherwise(F.col("w3"))
    inside = (
        word.between(F.col("low"), F.col("high"))
        & ((F.col("level") == 0) | (F.col("w1") == F.col("fixed1")))
        & ((F.col("level") < 2) | (F.col("w2") == F.col("fixed2")))
    )
    met = rows.withColumn("cell", _cell(F.col("w1"))).join(F.broadcast(table), "cell").where(inside)
    far = word.cast("decimal(20,0)") - F.col("low").cast("decimal(20,0)")
    part = F.floor(far / F.col("step")).cast("long")
    found: dict[int, list] = {}
    for row in _counts(met.withColumn("probe", part), "bracket", "probe").collect():
        found.setdefault(row.bracket, []).append(row)
    return {i: sorted(parts, key=lambda r: r.probe) for i, parts in found.items()}


def splitters(rows: DataFrame, spark: SparkSession, shards: int, tolerance: float) -> list[tuple[int, int, int]]:
    """The key words from which each further shard's rows start, in order."""
    cells = _counts(rows.withColumn("cell", _cell(F.col("w1"))), "cell").orderBy("cell").collect()
    total = sum(c.bytes for c in cells)
    slack = tolerance * total / shards
    found: dict[int, tuple[int, int, int]] = {}
    # a target t stands for the border with t * total / shards bytes below it

    def descend(parts: list, words: tuple[int, ...], before: int, targets: list[int]) -> list[Bracket]:
        """The parts in which the targets lie, as brackets for the next round; targets
        that meet the tolerance, or a single row, are settled."""
        waiting: list[Bracket] = []
        open_ = list(targets)
        level = len(words)
        name = f"w{level + 1}"
        for part in parts:
            after = before + part.bytes
            here = [t for t in open_ if t * total <= after * shards]
            open_ = open_[len(here) :]
            low, high = part[f"low_{name}"], part[f"high_{name}"]
            if here and low < high:
                waiting.append(Bracket(words, low, high, before, here))
            elif here:
                inner = []
                for t in here:
                    aim = t * total / shards  # over before, and after at most
                    if level == 0 and min(aim - before, after - aim) <= slack:
                        found[t] = (low if aim - before <= after - aim else low + 1, _LOWEST, _LOWEST)
                    elif part.n == 1:
                        found[t] = (part.low_w1, part.low_w2, part.low_w3 + 1)
                    else:
                        inner.append(t)
                if inner:
                    deeper = f"w{level + 2}"
                    waiting.append(
                        Bracket((*words, low), part[f"low_{deeper}"], part[f"high_{deeper}"], before, inner)
                    )
            before = after
        return waiting

    brackets = descend(cells, (), 0, list(range(1, shards))) if cells else []
    while brackets:
        parts = _probed(rows, brackets, spark)
        brackets = [b for i, old in enumerate(brackets) for b in descend(parts[i], old.words, old.before, old.targets)]
    return [found[t] for t in sorted(found)]


def _shard(spark: SparkSession, rows: DataFrame, borders: list[tuple[int, int, int]]) -> DataFrame:
    """``rows`` with the number of borders at or below their key: those of lower cells by
    a table of the cells, those within the cell by comparison."""
    width = HASH_BITS - CELL_BITS
    table, below = [], 0
    for cell in range(1 << CELL_BITS):
        inside = [b for b in borders if min(b[0] >> width, (1 << CELL_BITS) - 1) == cell]
        table.append((cell, below, inside))
        below += len(inside)
    schema = "cell long, below int, inside array<struct<w1:long,w2:long,w3:long>>"
    cells = F.broadcast(spark.createDataFrame(table, schema))  # 2^CELL_BITS rows
    key = F.struct("w1", "w2", "w3")
    at_most = F.size(F.filter("inside", lambda b: b <= key))
    placed = rows.withColumn("cell", _cell(F.col("w1"))).join(cells, "cell")
    return placed.withColumn("shard", (F.col("below") + at_most).cast("int")).drop("cell", "below", "inside")


def sharded(
    df: DataFrame,
    spark: SparkSession,
    shards: int = SHARDS,
    tolerance: float = TOLERANCE,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: list[str] | None = None,
) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot (gapless from 0, in key order) and
    grown_shard (null) of every row, and the columns ``carry`` as they are."""
    if shards < 1 or not 0 <= tolerance:
        raise ValueError("at least one shard and no negative tolerance")
    results = ("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
    carry = [c for c in carry or [] if c not in results]
    rows = keyed(df, spark, id_col, text_col, carry)
    borders = splitters(rows, spark, shards, tolerance)
    order = ("shard", "w1", "w2", "w3")
    placed = _shard(spark, rows, borders)
    laid = settled(placed.repartitionByRange(shuffle_width(spark), *order).sortWithinPartitions(*order), spark)
    numbered = laid.withColumns(
        {"part": F.spark_partition_id(), "row": F.monotonically_increasing_id().bitwiseAND(F.lit(_POSITION))}
    )
    runs = numbered.groupBy("part", "shard").agg(F.count(F.lit(1)).alias("n"), F.min("row").alias("head"))
    earlier = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # a row a partition and shard that meet: fewer than partitions and shards together
    starts = runs.select("part", "shard", (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("head")).alias("shift"))
    out = numbered.join(F.broadcast(starts), ["part", "shard"])
    return out.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("row") + F.col("shift")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        *[F.col("carried")[c].alias(c) for c in carry],
    )


def written(df: DataFrame, spark: SparkSession, path: str, shards: int = SHARDS, **options) -> DataFrame:
    """The whole rows as Parquet, one folder a shard; returns what was written."""
    kept = sharded(df, spark, shards, carry=list(df.columns), **options)
    kept.write.mode("overwrite").partitionBy("shard").parquet(path)
    return spark.read.parquet(path)
