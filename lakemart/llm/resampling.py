"""Operator 11: importance resampling towards a target distribution.

Texts are lower-cased in A-Z and cut by a pre-tokenizer (a Regex Split, untrained) into
words with byte offsets. Windows of offset pairs make the features: runs of ``least`` to
``most`` consecutive words, joined by one space, repeats counted. A feature's bucket is its
bytes' crc32 modulo ``BUCKETS``. Histograms over all documents and over all texts of the
target give each bucket a gain, the logarithm of its smoothed shares' ratio; a document's
weight is the floored mean of its features' gains. A Gumbel value from the id's hash makes
the draw without replacement: of the documents long enough the highest scores are drawn.

Texts are cut into words once: their buckets are kept in a checkpoint (2 bytes a feature,
beside 6 or 7 of text). The histogram is summed within a task first, so a row a bucket and
task is shuffled. The draw needs no sort of all documents: a histogram of the scores
(integers within some 10^5 by the gains' range, whatever the input) gives the score down
to which all are drawn; only rows from there on are laid out by ranges and numbered.

Null texts have no words; a text without features has weight 0. A null id hashes as empty
text and comes last among equal scores. Equal (score, id) rows are told apart by their
hash and number. Texts of any length are cut by lines and blanks, without a loss: words
hold neither. An empty table gives an empty table; an empty target, gains from its
smoothing alone. Other columns are ignored, also if their names clash.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.operators.keys import with_surrogate_key

from .common import acyclic, blocks, id_text, names, rows, settled

#: Fixed by the contract: runs of characters that are digits, letters a-z or not ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BUCKETS = 10_000
LEAST, MOST = 1, 1
MIN_WORDS = 20
PERCENT = 10
SEED = 2024
#: Bytes of text that the pre-tokenizer takes at a time.
_STEP = 2048
#: Features whose bucket a task remembers.
REMEMBERED = 300_000


class Features:
    """Buckets of texts' features, by a pre-tokenizer's offsets."""

    def __init__(self, least: int, most: int, buckets: int):
        from tokenizers import PreTokenizedString, Regex, pre_tokenizers

        self.made = PreTokenizedString
        self.split = pre_tokenizers.Split(Regex(WORD), behavior="removed", invert=True)
        self.least, self.most, self.buckets = least, most, buckets
        self.known: dict[bytes, int] = {}

    def words(self, raw: bytes) -> list[tuple[int, int]]:
        """Offset pairs of the words, in bytes. The text goes to the pre-tokenizer in
        stretches that end at a blank or line end, which no word holds."""
        found: list[tuple[int, int]] = []
        at = 0
        while at < len(raw):
            end = len(raw)
            if end - at > _STEP:
                cut = _BLANK.search(raw, at + _STEP)
                end = cut.end() if cut else end
            text = self.made(raw[at:end].decode())
            self.split.pre_tokenize(text)
            found += [
                (at + a, at + b) for _, (a, b), _ in text.get_splits(offset_referential="original", offset_type="byte")
            ]
            at = end
        return found

    def of(self, text: str) -> tuple[int, np.ndarray]:
        """Words and the buckets of all features of a text."""
        raw = text.encode().lower()  # for bytes: A-Z only
        pairs = self.words(raw)
        found: list[int] = []
        known, buckets, crc = self.known, self.buckets, zlib.crc32
        single = [raw[a:b] for a, b in pairs]
        for n in range(self.least, self.most + 1):
            if n == 1:
                features = single
            else:
                features = [b" ".join(single[i : i + n]) for i in range(len(single) - n + 1)]
            for feature in features:
                bucket = known.get(feature)
                if bucket is None:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    bucket = known[feature] = crc(feature) % buckets
                found.append(bucket)
        return len(pairs), np.array(found, dtype=_kind(buckets))


_BLANK = re.compile(rb"[ \n\t\r]")


def _kind(buckets: int) -> str:
    return "<u2" if buckets <= 1 << 16 else "<u4"


def featured(
    df: DataFrame,
    least: int = LEAST,
    most: int = MOST,
    buckets: int = BUCKETS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, n_words, n_features and the features' buckets (little-endian) of each row."""
    schema = "doc_id long, n_words long, n_features long, buckets binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(least, most, buckets)
        with acyclic():
            for b in blocks(batches):
                out: dict[str, list] = {name: [] for name in names(schema)}
                for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                    n, found = features.of(text)
                    out["doc_id"].append(doc)
                    out["n_words"].append(n)
                    out["n_features"].append(len(found))
                    out["buckets"].append(found.tobytes())
                yield rows(schema, out)

    return id_text(df, id_col, text_col).mapInArrow(run, schema)


def histogram(features: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features a bucket over all rows; a row a bucket comes to the driver."""
    schema = "bucket int, n long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, dtype=np.int64)
        for b in batches:
            for raw in b.column(0).to_pylist():
                counts += np.bincount(np.frombuffer(raw, dtype=_kind(buckets)), minlength=buckets)
        met = np.flatnonzero(counts)
        yield rows(schema, {"bucket": met.astype(np.int32), "n": counts[met]})

    summed = features.select("buckets").mapInArrow(run, schema).groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, dtype=np.int64)
    for row in summed.collect():
        out[row.bucket] = row.n
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of each bucket's smoothed share in the target over
    that in the raw texts, floored."""
    s_all, t_all = float(int(raw.sum()) + len(raw)), float(int(target.sum()) + len(raw))
    pairs = zip(raw.tolist(), target.tolist(), strict=True)
    return np.array([math.floor(1000 * math.log((t + 1) * s_all / ((s + 1) * t_all))) for s, t in pairs], dtype=np.int64)


def gumbel(doc_id: int | None, seed: int) -> int:
    """A Gumbel value in thousandths, floored, from the hash of seed and id."""
    text = f"{seed}:{'' if doc_id is None else doc_id}"
    h = int(hashlib.sha256(text.encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(features: DataFrame, gained: np.ndarray, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight, score."""
    schema = "doc_id long, n_words long, n_features long, weight long, score long"
    kind = _kind(len(gained))
    table = features.sparkSession.sparkContext.broadcast(gained)  # 8 bytes a bucket

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = table.value
        for b in batches:
            ids = b.column(0).to_pylist()
            found = [np.frombuffer(raw, dtype=kind) for raw in b.column(3).to_pylist()]
            weights = [int(gain[x].sum()) // len(x) if len(x) else 0 for x in found]
            scores = [w + gumbel(i, seed) for w, i in zip(weights, ids, strict=True)]
            columns = {"doc_id": b.column(0), "n_words": b.column(1), "n_features": b.column(2)}
            yield rows(schema, {**columns, "weight": weights, "score": scores})

    return features.mapInArrow(run, schema)


def resampled(
    df: DataFrame,
    target: DataFrame,
    spark: SparkSession,
    least: int = LEAST,
    most: int = MOST,
    buckets: int = BUCKETS,
    min_words: int = MIN_WORDS,
    percent: int = PERCENT,
    seed: int = SEED,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_col: str = "text",
) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every row; rank is 1, 2, 3, ... by
    falling score for the ``percent`` drawn of those with ``min_words`` words, else null."""
    if not 1 <= least <= most:
        raise ValueError("features have one word at least")
    features = settled(featured(df, least, most, buckets, id_col, text_col), spark)
    aim = target.select(F.lit(0).alias("doc_id"), target[target_col].alias("text"))
    wanted = histogram(featured(aim, least, most, buckets), buckets)
    gained = gains(histogram(features, buckets), wanted)
    scores = settled(scored(features, gained, seed), spark)
    long_enough = F.col("n_words") >= min_words
    # integers between the least and the largest sum of a gain and a Gumbel value
    per_score = scores.where(long_enough).groupBy("score").count().collect()
    drawn = sum(x["count"] for x in per_score) * percent // 100
    floor_, so_far = None, 0
    for x in sorted(per_score, key=lambda x: -x["score"]):
        if so_far >= drawn:
            break
        floor_, so_far = x["score"], so_far + x["count"]
    columns = ("doc_id", "n_features", "weight", "score")
    if floor_ is None:
        return scores.select(*columns, F.lit(None).cast("long").alias("rank"))
    high = long_enough & (F.col("score") >= floor_)
    order = {"falling": -F.col("score"), "no_id": F.col("doc_id").isNull()}
    ranked = with_surrogate_key(scores.where(high).withColumns(order), ["falling", "no_id", "doc_id"], "rank")
    rank = F.when(F.col("rank") <= drawn, F.col("rank"))
    rest = scores.where(~high).select(*columns, F.lit(None).cast("long").alias("rank"))
    return ranked.select(*columns, rank.alias("rank")).unionByName(rest)
