"""Operator 4: near copies by SimHash and multi-index hashing.

A fingerprint bit is the majority of that bit over the XXH64 hashes of a text's word
shingles. Equal fingerprints are taken together first. For the others each of the
``SEGMENTS`` segments of a fingerprint is varied within a Hamming ball of radius 1; the
table of codes so found holds a fingerprint under its own code and under each variation.
Two fingerprints differ in at most two bits exactly if they share an entry, and an
entry has at most 65 fingerprints, however large the group of near copies: each entry
links its fingerprints to its least one after a check of the whole distance, so there
are no pairs within a group. (An index by one segment's bits alone would list all pairs
of the fingerprints that agree there.) Every link is found: of three fingerprints in
one entry, all are within two bits of each other.

Components come from the links by repeated star contraction with a checkpoint each, until
every link runs from a node that has no other to one that is no node's follower.
Null text counts as empty: fingerprint zero, linked like any other. A null id takes no
part in the smallest id; a component of null ids only has a null one. Repeated rows get
the same answer each. An empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import blocks, id_text, rows, settled

WORDS = 3
RADIUS = 2
SEED = 42
SEGMENTS = 4
#: Shingles hashed at a time; bounds the memory for a long text.
_STEP = 1 << 16


def _lanes() -> np.ndarray:
    """For each byte, its eight bits in the eight bytes of a word."""
    bits = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")
    return np.ascontiguousarray(bits).view("<u8").ravel()


LANES = _lanes()


def shingle_hashes(text: str, words: int, seed: int = SEED) -> Iterator[bytes]:
    """The XXH64 hashes (big-endian, joined, some at a time) of a text's shingles."""
    import xxhash

    digest = xxhash.xxh64_digest
    found = text.encode().lower().split()  # for bytes: ASCII letters, ASCII white space
    if not found:
        return
    if len(found) < words:
        yield digest(b" ".join(found), seed)
        return
    joined = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    for at in range(0, len(found) - words + 1, _STEP):
        a = starts[at : min(at + _STEP, len(found) - words + 1)].tolist()
        b = ends[at + words - 1 : at + words - 1 + len(a)].tolist()
        yield b"".join([digest(joined[i:j], seed) for i, j in zip(a, b, strict=True)])


def fingerprints(texts: list[str], words: int = WORDS, seed: int = SEED) -> np.ndarray:
    """The fingerprint (uint64) of each text; zero without words."""
    counts = np.zeros((len(texts), 64), dtype=np.int64)
    sizes = np.zeros(len(texts), dtype=np.int64)
    for i, text in enumerate(texts):
        for hashed in shingle_hashes(text, words, seed):
            values = np.frombuffer(hashed, dtype=np.uint8).reshape(-1, 8)
            sizes[i] += len(values)
            # a lane of one byte counts to 255
            sums = np.add.reduceat(LANES[values], np.arange(0, len(values), 255), axis=0)
            counts[i] += sums.view(np.uint8).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    bits = (counts * 2 > sizes[:, None]).reshape(-1, 8, 8)
    packed = np.packbits(bits, axis=2, bitorder="little").reshape(-1, 8)
    return packed.copy().view(">u8").astype(np.uint64).ravel()


def fingerprinted(df: DataFrame, words: int = WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fp (the fingerprint as a signed long) and h (a hash of the text)."""
    schema = "doc_id long, fp long, h long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches):
            found = fingerprints(b.column(1).to_pylist(), words)
            columns = {"doc_id": b.column(0), "fp": found.view(np.int64)}
            yield rows(schema, {**columns, "h": b.column(2)})

    return id_text(df, id_col, text_col).withColumn("h", F.xxhash64("text")).mapInArrow(run, schema)


def links(codes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links (u, v), u over v, that join every two of the distinct codes ``fp`` that
    differ in ``radius`` bits at most (0 to 2)."""
    if not 0 <= radius <= 2:
        raise ValueError("the balls of radius 1 settle distances up to 2")
    size = 64 // SEGMENTS
    balls = [
        F.col("fp").bitwiseXOR(F.lit((1 << bit) - ((1 << 64) if bit == 63 else 0)).cast("long"))
        for segment in range(SEGMENTS)
        for bit in range(segment * size, (segment + 1) * size)
    ]
    entries = codes.select("fp", F.explode(F.array(F.col("fp"), *balls)).alias("code"))
    met = entries.withColumn("least", F.min("fp").over(Window.partitionBy("code")))
    if radius < 2:
        # codes of one entry may be two bits apart; only its own code is one from all
        met = met.withColumn("least", F.col("code"))
        there = codes.select(F.col("fp").alias("least"))
        met = met.join(there, "least", "left_semi")
    distance = F.bit_count(F.col("fp").bitwiseXOR(F.col("least")))
    near = met.where((F.col("fp") != F.col("least")) & (distance <= radius))
    return near.select(F.greatest("fp", "least").alias("u"), F.least("fp", "least").alias("v")).distinct()


def _stars(edges: DataFrame) -> bool:
    """Whether each node has one link at most and none both follows and is followed."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("into"))
    ends = ends.union(edges.select("v", F.lit(0), F.lit(1)))
    met = ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
    return met.where((F.col("out") > 1) | ((F.col("out") == 1) & (F.col("into") == 1))).isEmpty()


def components(edges: DataFrame, spark: SparkSession) -> DataFrame:
    """(u, v): each node with a link and the least node of its component, itself left out.

    Each round links the larger neighbours of a node to its least one, then the smaller
    ones; what remains are stars. Every round is checkpointed."""
    now = settled(edges.select("u", "v").where("u > v").distinct(), spark)
    while not _stars(now):
        both = now.union(now.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u > v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(joined.select("u", "m"))
        now = settled(small.where("u > v").distinct(), spark)
    return now


def grouped(found: DataFrame, spark: SparkSession, radius: int = RADIUS) -> DataFrame:
    """(fp, root): every fingerprint of ``found`` and the least one of its component."""
    codes = found.select("fp").distinct()
    stars = components(links(codes, radius), spark)
    roots = stars.select(F.col("u").alias("fp"), F.col("v").alias("root"))
    return codes.join(roots, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_copies(
    df: DataFrame,
    spark: SparkSession,
    words: int = WORDS,
    radius: int = RADIUS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, fingerprint (hexadecimal) and component_id of every row."""
    found = settled(fingerprinted(df, words, id_col, text_col).select("doc_id", "fp"), spark)
    least = found.groupBy("fp").agg(F.min("doc_id").alias("first"))
    roots = settled(grouped(found, spark, radius).join(least, "fp"), spark)
    named = roots.groupBy("root").agg(F.min("first").alias("component_id"))
    named = roots.join(named, "root").select("fp", "component_id")
    return found.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def one_of_each(
    df: DataFrame,
    spark: SparkSession,
    words: int = WORDS,
    radius: int = RADIUS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``df`` with one row of each component: the smallest id (null ids last; of equal
    ids the text with the least hash; of rows alike, one)."""
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h")
    found = settled(fingerprinted(df, words, id_col, text_col), spark)
    least = found.groupBy("fp").agg(F.min(rank).alias("least"))
    best = grouped(found, spark, radius).join(least, "fp").groupBy("root").agg(F.min("least").alias("least"))
    kept = best.select(
        F.coalesce("least.doc_id", F.lit(0)).alias("id"), F.col("least.none").alias("none"), F.col("least.h").alias("h")
    ).distinct()
    # the input's columns ride in one struct, so that no name of theirs can clash
    marked = df.select(
        F.struct(*[df[c] for c in df.columns]).alias("row"),
        F.coalesce(df[id_col].cast("long"), F.lit(0)).alias("id"),
        df[id_col].cast("long").isNull().alias("none"),
        F.xxhash64(F.coalesce(df[text_col].cast("string"), F.lit(""))).alias("h"),
    )
    keys = ["id", "none", "h"]
    alike = Window.partitionBy(*keys).orderBy(*keys)
    left = marked.join(kept, keys, "left_semi").withColumn("n", F.row_number().over(alike))
    return left.where("n = 1").select(*[F.col("row")[c].alias(c) for c in df.columns])
