from __future__ import annotations

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakemart.llm import language

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_held_out_accuracy_and_columns(spark, documents):
    held = ~language.in_training()
    model = language.fit(documents, language.in_training())
    got = language.identified(documents, language.share_model(model, spark), held).collect()
    true = {r.doc_id: r.lang for r in documents.collect()}
    assert len(got) == len(true)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    out = [r for r in got if r.held_out]
    assert np.mean([r.lang_pred == true[r.doc_id] for r in out]) > 0.97
    assert all(0 <= r.score <= 1 for r in got)


def test_labels_of_held_out_rows_play_no_part(spark, documents):
    a = language.fit(documents, language.in_training())
    other = documents.withColumn("lang", F.when(language.in_training(), F.col("lang")).otherwise("xx"))
    b = language.fit(other, language.in_training())
    assert a.langs == b.langs and np.array_equal(a.log_probs, b.log_probs)


def test_scores_match_brute_force(spark, documents):
    model = language.fit(documents, language.in_training())
    texts = [r.text for r in documents.limit(20).collect()] + ["a", "ab", "É!", "İx"]
    langs, scores = model.predict(texts)
    for text, lang, score in zip(texts, langs, scores, strict=True):
        low = text.lower() + "\n\n"
        total = model.priors.copy()
        for i in range(len(low) - 2):
            found, _ = language.grams([low[i : i + 3]])
            total += sum(model.log_probs[:, f[0]].astype(float) for f in found)
        assert model.langs[int(total.argmax())] == lang
        chance = 1 / np.exp(total - total.max()).sum()
        assert abs(chance - score) < 1e-3


def test_odd_texts(spark, docs, documents):
    shared = language.share_model(language.fit(documents, language.in_training()), spark)
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.identified(docs, shared).collect()}
    for i in (1, 2, 3):
        assert got[i] == ("und", 0.0)
    assert got[8][0] in ("de", "en", "es", "fr")
    assert language.identified(docs, shared).count() == docs.count()
    assert language.identified(docs.limit(0), shared).count() == 0
    kept = language.recognised(docs, shared)
    assert kept.columns == docs.columns
    assert {1, 2, 3}.isdisjoint(r.doc_id for r in kept.collect())


def test_nothing_to_learn_from(spark, docs):
    model = language.fit(docs)
    assert model.langs == []
    got = language.identified(docs, language.share_model(model, spark)).collect()
    assert {(r.lang_pred, r.score) for r in got} == {("und", 0.0)}


def test_sample_is_bounded(spark, documents):
    few = language.fit(documents, per_lang=20)
    assert few.langs == ["de", "en", "es", "fr"]


def test_signs_that_are_no_letters():
    model = language.Model(["aa"], np.zeros(1), np.zeros((1, 1 << language.BUCKET_BITS), np.float32))
    assert model.predict(["½ ² ① 12 _", "½ a", None, "ª"])[0] == ["und", "aa", "und", "aa"]
