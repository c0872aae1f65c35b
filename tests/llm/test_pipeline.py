from __future__ import annotations

import glob
import os

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lakemart.llm import packing, secrets
from lakemart.session import ensure_checkpoint_dir

from .test_packing import assert_packed, expected
from .test_secrets import KEY, plain
from .test_simhash import expected as components
from .test_suffix_dedup import brute

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def steps(spark, documents):
    out, docs = [], documents
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, docs, SF)
        docs = got.cache()
        out.append((name, docs, docs.collect()))
    return out


def test_columns_of_documents_stay(documents, steps):
    for name, df, _ in steps[:-1]:
        assert df.columns == documents.columns and df.dtypes == documents.dtypes, name


def test_each_stage_against_brute_force(documents, steps):
    start = documents.collect()
    language, copies, passages, masked, packed = (rows for _, _, rows in steps)
    # every row with a language stays as it is
    assert {r for r in language} <= {r for r in start}
    assert all(r in set(language) for r in start if sum(c.isalpha() for c in r.text or "") > 100)
    # one row a group of near copies: the smallest id of each that brute force finds
    least = {i: component for i, _, component in components([(r.doc_id, r.text) for r in language])}
    kept = [r.doc_id for r in copies]
    assert sorted(kept) == sorted(set(least.values())) and {r for r in copies} <= {r for r in language}
    assert len(set(least.values())) < len(least)
    # passages: what is left of the texts
    want = {(i, sha) for i, _, _, _, sha in brute([(r.doc_id, r.text) for r in copies], 100)}
    kept = {r.doc_id: r for r in passages}
    assert len(kept) == len(want) == len(copies)
    removed = {i: n for i, _, n, _, _ in brute([(r.doc_id, r.text) for r in copies], 100)}
    for r in copies:
        size = len(kept[r.doc_id].text.encode())
        assert len(r.text.encode()) - removed[r.doc_id] - 6 <= size <= len(r.text.encode()) - removed[r.doc_id]
        assert kept[r.doc_id].n_chars == len(kept[r.doc_id].text)
    # secrets: masked, and nothing else changed
    after = {r.doc_id: r.text for r in masked}
    for r in passages:
        assert after[r.doc_id] == secrets.masked(r.text, secrets.scan(r.text)[1], "[SECRET]")
        if not plain(r.text):
            assert after[r.doc_id] == r.text
    # packing: every piece of every text
    got = sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed)
    assert got == sorted(expected([*after.items()], packing.CAPACITY).elements())
    assert_packed(packed, packing.CAPACITY)


def test_run_equals_its_stages_and_leaves_one_table(spark, steps):
    got = corpus_pipeline.run(spark, SF).select("doc_id", "piece", "ids_crc32")
    want = [(r.doc_id, r.piece, r.ids_crc32) for r in steps[-1][2]]
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)
    root = ensure_checkpoint_dir(spark).removeprefix("file:")
    assert all(len(os.listdir(p)) == 1 for p in glob.glob(f"{root}/steps-*"))


def test_odd_rows(spark, docs):
    more = docs.withColumn("lang", F.lit("en")).withColumn("n_chars", F.lit(0))
    for df in (more, more.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            df = stage(spark, df, SF)
        df.collect()


def test_secret_is_masked_in_the_pipeline(spark):
    text = "The words of this text are plain English, and then a key follows: "
    df = spark.createDataFrame([(1, text + KEY, "en")], "doc_id long, text string, lang string")
    assert corpus_pipeline.no_secrets(spark, df, SF).first().text == text + "[SECRET]"
