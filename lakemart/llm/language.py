"""Operator 2: language identification by multinomial naive Bayes over hashed n-grams.

The features of a text are the n-grams of one to three characters that start at each
of its (lower-cased) characters, hashed into buckets. Counts per language come from
a sample of the labelled texts, of at most about ``per_lang`` texts a language; their
smoothed log-probabilities are a matrix of languages by buckets, of a fixed size, that
is broadcast. A text's score per language is the sum of its n-grams' rows.

A text that is null or has no letter is ``und`` with score 0; so is every text when
nothing is labelled. Ties go to the first language in alphabetical order. Repeated
rows get the same answer each; an empty table gives an empty table; only the named
columns are read. Texts are taken whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import blocks, id_remainder, rows

BUCKET_BITS = 16
#: Texts a language to learn from, about: bounds the work of fitting.
PER_LANG = 4000
UNKNOWN = "und"
SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double"
_MIX = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D))


def grams(texts: list[str]) -> tuple[list[np.ndarray], np.ndarray]:
    """For each order, the bucket of the n-gram at each character of the joined texts
    (two line ends close each), and the place where each text starts."""
    low = [t.lower() + "\n\n" for t in texts]
    starts = np.concatenate([[0], np.cumsum([len(t) for t in low])])
    chars = np.frombuffer("".join(low).encode("utf-32-le"), dtype=np.uint32)
    shift = np.uint32(32 - BUCKET_BITS)
    one = chars * _MIX[0]
    two = (one[:-1] ^ (one[:-1] >> np.uint32(15))) * _MIX[1] + chars[1:]
    three = (two[:-1] ^ (two[:-1] >> np.uint32(13))) * _MIX[2] + chars[2:]
    found = []
    for code in (one, two * _MIX[0], three * _MIX[1]):
        bucket = (code ^ (code >> np.uint32(16))) * _MIX[2] >> shift
        found.append(np.pad(bucket, (0, len(chars) - len(bucket))))
    return found, starts


@dataclass
class Model:
    langs: list[str]
    priors: np.ndarray
    #: languages by buckets, float32
    log_probs: np.ndarray

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        langs, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        told = [i for i, t in enumerate(texts) if t and any(map(str.isalpha, t))]
        if not self.langs or not told:
            return langs, scores
        found, starts = grams([texts[i] for i in told])
        # the closing line ends start no n-gram of the text
        inside = np.ones(starts[-1], dtype=bool)
        inside[starts[1:] - 1] = inside[starts[1:] - 2] = False
        total = np.empty((len(told), len(self.langs)))
        for k, row in enumerate(self.log_probs):
            at = row[found[0]]
            for bucket in found[1:]:
                at += row[bucket]
            at *= inside
            total[:, k] = np.add.reduceat(at, starts[:-1], dtype=np.float64)
        total += self.priors
        best = total.argmax(axis=1)
        chance = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
        for i, k, p in zip(told, best.tolist(), chance.tolist(), strict=True):
            langs[i], scores[i] = self.langs[k], p
        return langs, scores


def _counted(sample: DataFrame) -> DataFrame:
    """lang, counts (one int64 a bucket, as binary): summed in each task, then over tasks."""
    schema = "lang string, counts binary"

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for b in blocks(batches):
            langs = b.column(0).to_pylist()
            texts = b.column(1).to_pylist()
            for lang in set(langs):
                found, starts = grams([t for t, x in zip(texts, langs, strict=True) if x == lang])
                inside = np.ones(starts[-1], dtype=bool)
                inside[starts[1:] - 1] = inside[starts[1:] - 2] = False
                into = sums.setdefault(lang, np.zeros(1 << BUCKET_BITS, dtype=np.int64))
                for bucket in found:
                    into += np.bincount(bucket[inside], minlength=1 << BUCKET_BITS)
        yield rows(schema, {"lang": [*sums], "counts": [x.tobytes() for x in sums.values()]})

    def add(part: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(x, dtype=np.int64) for x in part["counts"])
        return pd.DataFrame({"lang": part["lang"][:1], "counts": [total.tobytes()]})

    return sample.mapInArrow(tally, schema).groupBy("lang").applyInPandas(add, schema)


def fit(
    df: DataFrame,
    training: Column | None = None,
    per_lang: int = PER_LANG,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> Model:
    """Learn from the rows with a language and a text (and ``training``, if given)."""
    known = df.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    known = known if training is None else known.where(training)
    known = known.select(
        F.col(lang_col).cast("string").alias("lang"),
        F.col(text_col).alias("text"),
        (F.pmod(F.xxhash64(F.col(id_col), F.lit("lang")), F.lit(1 << 20)) / (1 << 20)).alias("draw"),
    )
    seen = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    if not seen:
        return Model([], np.zeros(0), np.zeros((0, 1 << BUCKET_BITS), dtype=np.float32))
    share = F.create_map(*(F.lit(x) for k, n in seen.items() for x in (k, min(1.0, per_lang / n))))
    sample = known.where(F.col("draw") < share[F.col("lang")]).select("lang", "text")
    counts = {r["lang"]: np.frombuffer(r["counts"], np.int64) for r in _counted(sample).collect()}
    langs = sorted(counts)
    if not langs:
        return Model([], np.zeros(0), np.zeros((0, 1 << BUCKET_BITS), dtype=np.float32))
    smoothed = np.stack([counts[x] for x in langs]) + 0.5
    log_probs = np.log(smoothed / smoothed.sum(axis=1, keepdims=True)).astype(np.float32)
    numbers = np.array([seen[x] for x in langs], dtype=float)
    return Model(langs, np.log(numbers / numbers.sum()), log_probs)


def share_model(model: Model, spark: SparkSession) -> Broadcast:
    """The model for all tasks: 4 bytes a language and bucket."""
    return spark.sparkContext.broadcast(model)


def identified(
    df: DataFrame, shared: Broadcast, held_out: Column | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row."""
    held = F.lit(False) if held_out is None else held_out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches):
            langs, scores = shared.value.predict(b.column(2).to_pylist())
            yield rows(
                SCHEMA,
                {"doc_id": b.column(0), "held_out": b.column(1), "lang_pred": langs, "score": scores},
            )

    named = df.select(
        F.col(id_col).cast("long").alias("doc_id"),
        held.alias("held_out"),
        F.col(text_col).cast("string").alias("text"),
    )
    return named.mapInArrow(run, SCHEMA)


def recognised(df: DataFrame, shared: Broadcast, least: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of ``df``, all columns, whose text has a language with that score at least."""
    schema = df.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches, text=text_col):
            langs, scores = shared.value.predict(
                b.column(b.schema.get_field_index(text_col)).to_pylist()
            )
            keep = [x != UNKNOWN and s >= least for x, s in zip(langs, scores, strict=True)]
            yield b.filter(pa.array(keep))

    return df.mapInArrow(run, schema)


def in_training(id_col: str = "doc_id") -> Column:
    """Whether a row may be learned from: crc32 of its id modulo 5 is not 0."""
    return id_remainder(F.col(id_col), 5) != 0
