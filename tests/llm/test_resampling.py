from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

from lakemart.llm import resampling as R

SCHEMA = "doc_id long, text string"
A_Z = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def features(text, least, most):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(A_Z))
    return words, [" ".join(words[i : i + n]) for n in range(least, most + 1) for i in range(len(words) - n + 1)]


def brute(rows, target, least=1, most=1, buckets=10_000, min_words=20, percent=10):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    raw, aim = Counter(), Counter()
    for _, text in rows:
        raw.update(map(bucket, features(text, least, most)[1]))
    for text in target:
        aim.update(map(bucket, features(text, least, most)[1]))
    s_all, t_all = sum(raw.values()) + buckets, sum(aim.values()) + buckets

    def gain(b):
        return math.floor(1000 * math.log((aim[b] + 1) * s_all / ((raw[b] + 1) * t_all)))

    out = []
    for i, text in rows:
        words, found = features(text, least, most)
        weight = sum(gain(bucket(f)) for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(found), weight, score, None, len(words)])
    able = sorted((r for r in out if r[5] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for place, r in enumerate(able[: len(able) * percent // 100]):
        r[4] = place + 1
    return sorted((tuple(r[:5]) for r in out), key=str)


def found(spark, rows, target, schema=SCHEMA, **more):
    df = spark.createDataFrame(rows, schema).repartition(3)
    aim = spark.createDataFrame([(t, "x") for t in target], "text string, doc_id string")
    return sorted((tuple(r) for r in R.resampled(df, aim, spark, **more).collect()), key=str)


TARGET = ["word hello 你好 test", None, "", "the ing one THE"]


def test_odd_and_ordinary_texts(spark, doc_rows):
    rows = [(i, t) for n, (i, t) in enumerate(doc_rows) if (i, t) not in doc_rows[:n]]
    assert found(spark, rows, TARGET) == brute(rows, TARGET)


def test_runs_of_words_and_all_drawn(spark, doc_rows):
    rows = [(i, t) for n, (i, t) in enumerate(doc_rows) if (i, t) not in doc_rows[:n]]
    more = {"least": 1, "most": 3, "buckets": 100_003, "min_words": 1, "percent": 100}
    assert found(spark, rows, TARGET, **more) == brute(rows, TARGET, **more)
    more = {"least": 2, "most": 2, "buckets": 97, "min_words": 2, "percent": 33}
    assert found(spark, rows, TARGET, **more) == brute(rows, TARGET, **more)


def test_long_texts_without_blanks_and_with(spark):
    rows = [(1, "ab,é" * 30_000), (2, "Word\n" * 50_000), (3, "x" * 200_000), (4, "\x00\x1f~" * 4000)]
    assert found(spark, rows, TARGET, percent=50) == brute(rows, TARGET, percent=50)


def test_ties_and_repeated_rows(spark):
    rows = [(7, "one two " * 12)] * 20 + [(None, "one two " * 12)] * 20
    got = found(spark, rows, TARGET, percent=60)
    assert got == brute(rows, TARGET, percent=60)
    assert sorted(r[4] for r in got if r[4]) == list(range(1, 25))


def test_empty_tables(spark):
    assert found(spark, [], TARGET) == []
    rows = [(1, "a b"), (2, None)]
    assert found(spark, rows, []) == brute(rows, [])


def test_clashing_columns(spark):
    rows = [(i, "word hello " * 15, "a", "b", "c") for i in range(30)]
    schema = "doc_id long, text string, rank string, score string, buckets string"
    assert found(spark, rows, TARGET, schema) == brute([r[:2] for r in rows], TARGET)
