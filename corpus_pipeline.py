"""From raw documents to packed training sequences: five stages, each one operator.

Every stage takes all rows that the one before kept, as Parquet, and returns the columns
of ``documents`` again (``n_chars`` following the text); the last returns the pieces with
their sequences. Texts that are null or empty, repeated rows, further columns and empty
tables are treated as the operators' modules say.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.llm import language, packing, secrets, simhash, suffix_dedup
from lakemart.llm.common import Scratch, table

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def _counted(docs: DataFrame) -> DataFrame:
    if "n_chars" not in docs.columns:
        return docs
    kind = dict(docs.dtypes)["n_chars"]
    return docs.withColumn("n_chars", F.length("text").cast(kind))


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; those without letters or a clear one go."""
    model = language.fit(docs, language.in_training())
    return language.recognised(docs, language.share_model(model, spark))


def no_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that fingerprints of three-word shingles link at two
    differing bits or fewer: the smallest id."""
    return simhash.one_of_each(docs, spark, words=simhash.WORDS, radius=simhash.RADIUS)


def no_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that stand earlier in the corpus are cut out; documents stay."""
    return _counted(suffix_dedup.deduplicated(docs, spark))


def no_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets, also encoded ones, are masked; documents stay."""
    return _counted(secrets.redacted(docs))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces, packed into sequences."""
    return packing.packed(packing.pieces(docs, TOKENIZER), spark)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", known_language),
    ("near_copies", no_near_copies),
    ("passages", no_repeated_passages),
    ("secrets", no_secrets),
    ("packing", sequences),
]

#: Fingerprints, encodings and token ids can't be stated in SQL; tests/llm holds the
#: stages against brute-force versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are written before the next begins."""
    docs, scratch = table(spark, sf_dir, "documents"), Scratch(spark)
    for name, stage in STAGES[:-1]:
        docs = scratch.written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
