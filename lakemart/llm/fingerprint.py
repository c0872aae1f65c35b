"""Operator 9: document fingerprints as bottom-k sketches of word shingles.

A fingerprint holds the ``K`` smallest distinct hashes of a text's shingles of five
words (lower-cased in ASCII, cut at ASCII white space; a shorter text is one shingle),
as base64 of 6 bytes each, ascending. Sketches of parts merge into the sketch of the
whole; two sketches estimate resemblance and containment, one the number of distinct
shingles. Below ``K`` distinct shingles all of that is exact.

``edits`` also fingerprints each text with its second half replaced by the start of the
next one, in descending order of the ids. The texts go through one shuffle by ranges of
ids; each range also gets the first text of the range after it.

Null text counts as empty: the empty fingerprint, like only another empty one. Rows of
one id follow by a hash of their texts, null ids come last; repeated rows stand one after
another. An empty table gives an empty table; other columns are ignored; texts are whole.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BLOCK_BYTES, blocks, id_text, rows, shuffle_width

K = 128
WORDS = 5
PRINTS = "doc_id long, n_chars long, fingerprint string"
EDITS = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)
_BITS = 48
_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> _U(29))) * _U(0xFF51AFD7ED558CCD)
    return x ^ (x >> _U(32))


@lru_cache(1)
def _codes() -> np.ndarray:
    return np.random.default_rng(9).integers(0, 1 << 64, 256, dtype=np.uint64)


def _powers(base: int, size: int) -> np.ndarray:
    return np.cumprod(np.full(size, base, dtype=np.uint64), dtype=np.uint64)


def word_hashes(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The place and the hash of each word of lower-cased bytes.

    The hash is the base's polynomial of the word's bytes, from running sums; the sums
    start anew in every stretch, so that the powers do for a text of any length."""
    space = _SPACE[raw]
    edge = np.flatnonzero(np.diff(np.concatenate([[True], space, [True]]).astype(np.int8)))
    start, end = edge[::2], edge[1::2]
    if not len(start):
        return start, np.zeros(0, dtype=np.uint64)
    sums = np.zeros(len(raw) + 1, dtype=np.uint64)
    powers = _powers(int(_BASE), len(raw))
    np.cumsum(_codes()[raw] * powers, out=sums[1:])
    inverse = _powers(pow(int(_BASE), -1, 1 << 64), len(raw))
    return start, _mixed((sums[end] - sums[start]) * inverse[start] + (end - start).astype(np.uint64))


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """The hashes of the word shingles of one text, cut to ``_BITS`` bits."""
    if not len(words):
        return words
    size = min(size, len(words))
    total = np.zeros(len(words) - size + 1, dtype=np.uint64)
    for k in range(size):
        total = (total + words[k : k + len(total)]) * _BASE
    return _mixed(total) >> _U(64 - _BITS)


def bottom(hashes: np.ndarray, k: int = K) -> np.ndarray:
    """The ``k`` smallest distinct hashes, ascending."""
    if len(hashes) > 8 * k:
        # those under a bound that holds k distinct ones; the bound grows if repeats fill it
        reach = 4 * k
        while reach < len(hashes):
            least = np.unique(np.partition(hashes, reach)[:reach])
            if len(least) >= k:
                return least[:k]
            reach *= 4
    return np.unique(hashes)[:k]


def sketches(texts: list[str], size: int = WORDS, k: int = K) -> list[np.ndarray]:
    """The sketch of each text; texts are hashed together up to a block's size."""
    out: list[np.ndarray] = []
    group: list[bytes] = []
    held = 0

    def flush() -> None:
        raw = np.frombuffer(b"\n".join(group), dtype=np.uint8)
        place, hashes = word_hashes(raw)
        ends = np.cumsum([len(x) + 1 for x in group])
        cuts = np.searchsorted(place, ends).tolist()
        for a, b in zip([0, *cuts[:-1]], cuts, strict=True):
            out.append(bottom(shingles(hashes[a:b], size), k))

    for text in texts:
        data = text.encode().lower()
        if group and held + len(data) > BLOCK_BYTES // 4:
            flush()
            group, held = [], 0
        group.append(data)
        held += len(data)
    if group:
        flush()
    return out


def packed(sketch: np.ndarray) -> str:
    return base64.b64encode(sketch.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 2:].tobytes()).decode()


def unpacked(text: str) -> np.ndarray:
    raw = np.frombuffer(base64.b64decode(text), dtype=np.uint8).reshape(-1, 6)
    return np.pad(raw, ((0, 0), (2, 0))).copy().view(">u8").ravel().astype(np.uint64)


def merge(parts: Iterable[np.ndarray], k: int = K) -> np.ndarray:
    """The sketch of all that the sketched parts hold."""
    parts = [*parts]
    return np.unique(np.concatenate(parts))[:k] if parts else np.zeros(0, dtype=np.uint64)


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Shared share of the distinct shingles of both: that of the union's sketch."""
    both = np.sort(np.concatenate([a, b]))
    if not len(both):
        return 1.0
    again = both[1:] == both[:-1]
    rank = np.cumsum(np.concatenate([[True], ~again]))
    return float(np.count_nonzero(again & (rank[1:] <= k)) / min(int(rank[-1]), k))


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Share of a's distinct shingles that b has, over the hashes that both cover."""
    reach = min([x[-1] for x in (a, b) if len(x) >= k], default=_U(1 << _BITS))
    own = a[a <= reach]
    return float(np.isin(own, b).mean()) if len(own) else 1.0


def distinct_shingles(a: np.ndarray, k: int = K) -> float:
    """The number of distinct shingles: exact below ``k``, else by the k-th least hash."""
    return float(len(a)) if len(a) < k else (k - 1) / ((int(a[-1]) + 1) / (1 << _BITS))


def fingerprinted(
    df: DataFrame, size: int = WORDS, k: int = K, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_chars and fingerprint of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches):
            texts = b.column(1).to_pylist()
            found = {
                "doc_id": b.column(0),
                "n_chars": [len(t) for t in texts],
                "fingerprint": [packed(x) for x in sketches(texts, size, k)],
            }
            yield rows(PRINTS, found)

    return id_text(df, id_col, text_col).mapInArrow(run, PRINTS)


def merged(prints: DataFrame, by: str, k: int = K) -> DataFrame:
    """(by, fingerprint): the sketch of all texts of a group; merged in each task first,
    so a group sends one sketch a task."""
    kind = dict(prints.dtypes)[by]
    schema = f"`{by}` {kind}, fingerprint string"

    def join(part: pd.DataFrame) -> pd.DataFrame:
        whole = merge((unpacked(x) for x in part["fingerprint"]), k)
        return pd.DataFrame({by: part[by].iloc[:1].to_list(), "fingerprint": [packed(whole)]})

    def here(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict = {}
        for b in batches:
            for key, text in zip(b[by], b["fingerprint"], strict=True):
                key = None if pd.isna(key) else key
                held[key] = merge([held.get(key, np.zeros(0, np.uint64)), unpacked(text)], k)
        yield pd.DataFrame({by: pd.Series([*held], dtype=object), "fingerprint": [packed(x) for x in held.values()]})

    return prints.select(by, "fingerprint").mapInPandas(here, schema).groupBy(by).applyInPandas(join, schema)


def _ranges(texts: DataFrame, spark: SparkSession) -> tuple[DataFrame, int]:
    """``texts`` by ranges of ids in descending order (column part), and the first row of
    each range once more (guest) in the range before it; the number of ranges.

    Only the cuts and the first rows' ids, one a range, pass the driver."""
    parts = 2 * shuffle_width(spark)
    shares = [i / parts for i in range(1, parts)]
    cuts = texts.agg(F.percentile_approx("doc_id", shares, 10_000)).first()[0] or []
    over = F.filter(F.array(*(F.lit(c) for c in sorted(set(cuts)))), lambda c: c > F.col("doc_id"))
    part = F.when(F.col("doc_id").isNull(), F.lit(len(cuts) + 1)).otherwise(F.size(over) if cuts else F.lit(0))
    texts = texts.withColumn("part", part.cast("int"))
    firsts = texts.groupBy("part").agg(
        F.max(F.struct(F.coalesce("doc_id", F.lit(-(1 << 63))).alias("first"), F.col("h").alias("fh"))).alias("f")
    )
    firsts = sorted(firsts.select("part", "f.first", "f.fh").collect())
    goes = [(r["first"], r["fh"], r["part"], firsts[i - 1]["part"]) for i, r in enumerate(firsts)]
    goes = spark.createDataFrame(goes, "first long, fh long, from int, to int")
    guests = texts.join(
        F.broadcast(goes),  # one row a range
        (F.col("part") == F.col("from"))
        & (F.coalesce("doc_id", F.lit(-(1 << 63))) == F.col("first"))
        & (F.col("h") == F.col("fh")),
    ).select("doc_id", "text", "h", F.col("to").alias("part"), F.lit(True).alias("guest"))
    return texts.withColumn("guest", F.lit(False)).unionByName(guests), parts


def edits(
    df: DataFrame, spark: SparkSession, size: int = WORDS, k: int = K, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Every row's fingerprint and that of its edited text, with its likeness to that and
    to the next row's."""
    texts = id_text(df, id_col, text_col).withColumn("h", F.xxhash64("text"))
    ranged, parts = _ranges(texts, spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last row, for want of its next: part, id, text, sketch, guest
        for b in blocks(batches):
            texts = b.column(1).to_pylist()
            own = sketches(texts, size, k)
            seen = [*zip(b.column(3).to_pylist(), b.column(0).to_pylist(), texts, own, b.column(4).to_pylist(), strict=True)]
            seen = [held, *seen] if held else seen
            held = seen[-1]
            pairs = [(x, y) for x, y in zip(seen[:-1], seen[1:], strict=True) if x[0] == y[0] and not x[4]]
            cut = [len(x[2]) // 2 for x, _ in pairs]
            edited = [x[2][: len(x[2]) - c] + y[2][:c] for c, (x, y) in zip(cut, pairs, strict=True)]
            other = sketches(edited, size, k)
            yield rows(
                EDITS,
                {
                    "doc_id": [x[1] for x, _ in pairs],
                    "n_chars": [len(x[2]) for x, _ in pairs],
                    "edited_sha256": [hashlib.sha256(t.encode()).hexdigest() for t in edited],
                    "fingerprint": [packed(x[3]) for x, _ in pairs],
                    "edited_fingerprint": [packed(s) for s in other],
                    "near_edited": [resemblance(x[3], s, k) for (x, _), s in zip(pairs, other, strict=True)],
                    "near_next": [resemblance(x[3], y[3], k) for x, y in pairs],
                },
            )

    dealt = ranged.repartition(parts, "part").sortWithinPartitions(
        "part", "guest", F.col("doc_id").desc_nulls_last(), F.col("h").desc()
    )
    return dealt.select("doc_id", "text", "h", "part", "guest").mapInArrow(run, EDITS)
