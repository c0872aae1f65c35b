from __future__ import annotations

import random
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from lakemart.llm import simhash


def slow_print(text, words=3):
    found = (text or "").encode().lower().split()
    if not found:
        return 0
    n = max(1, len(found) - words + 1)
    hashes = [xxhash.xxh64_intdigest(b" ".join(found[i : i + words]), 42) for i in range(n)]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > n)


def slow_components(prints, radius=2):
    parent = list(range(len(prints)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                parent[root(i)] = root(j)
    return [root(i) for i in range(len(prints))]


def expected(rows):
    prints = [slow_print(t) for _, t in rows]
    root = slow_components(prints)
    best = {}
    for (i, _), r in zip(rows, root, strict=True):
        if i is not None:
            best[r] = min(best.get(r, i), i)
    return Counter((i, f"{p:016x}", best.get(r)) for (i, _), p, r in zip(rows, prints, root, strict=True))


def near(rows, seed=3):
    rng = random.Random(seed)
    out = list(rows)
    for k in range(60):
        i, t = rng.choice(rows)
        w = (t or "").split()
        if len(w) > 40:
            w[rng.randrange(len(w))] = rng.choice(["x", "yy", "zzz"])
        out.append((5000 + k, " ".join(w).upper() if k % 3 else " ".join(w)))
    return out


def test_matches_brute_force(spark, doc_rows):
    rows = near(doc_rows)
    df = spark.createDataFrame([(i, t, 0, 0) for i, t in rows], "doc_id long, text string, fp int, h int")
    got = Counter(tuple(r) for r in simhash.near_copies(df, spark).collect())
    assert got == expected(rows)


@pytest.mark.parametrize("radius", [0, 1, 2])
def test_chains_of_codes(spark, radius):
    rng = random.Random(radius)
    codes = {rng.getrandbits(64) for _ in range(30)} | {0, 1 << 63, (1 << 64) - 1}
    for c in list(codes):
        for _ in range(12):
            c ^= 1 << rng.randrange(64)
            c ^= rng.choice([0, 1 << rng.randrange(64), (1 << 63) | (1 << rng.randrange(63))])
            codes.add(c)
    codes = sorted(codes)
    signed = [c - (1 << 64) if c >> 63 else c for c in codes]
    df = spark.createDataFrame([(c,) for c in signed], "fp long")
    got = {r.fp: r.root for r in simhash.grouped(df, spark, radius).collect()}
    root = slow_components(codes, radius)
    groups = {}
    for c, r in zip(signed, root, strict=True):
        groups.setdefault(r, []).append(c)
    assert got == {c: min(groups[r]) for c, r in zip(signed, root, strict=True)}


def test_hash_is_that_of_spark(spark):
    h = spark.range(1).select(F.xxhash64(F.lit("a b é"))).first()[0]
    assert h % (1 << 64) == xxhash.xxh64_intdigest("a b é".encode(), 42)


def test_one_of_each(spark, docs, doc_rows):
    kept = simhash.one_of_each(docs, spark)
    assert kept.columns == docs.columns
    want = expected(doc_rows)
    groups = {c for _, _, c in want if c is not None}
    got = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in got if i is not None) == sorted(groups)
    assert got.count(None) == len({p for i, p, c in want if c is None})


def test_empty_table(spark, docs):
    assert simhash.near_copies(docs.limit(0), spark).count() == 0
    assert simhash.one_of_each(docs.limit(0), spark).count() == 0


def jaccard(a, b):
    a, b = ({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for w in (a.lower().split(), b.lower().split()))
    return len(a & b) / len(a | b)


def test_one_of_each_keeps_columns_of_clashing_names(spark):
    rows = [(3, "a b c d", "x", 1, "p"), (1, "a b c d", "y", 2, "q"), (None, "a b c d", "z", 3, "r"), (5, "q w e r t", "v", 4, "s")]
    schema = "doc_id long, text string, id string, n int, row string"
    got = simhash.one_of_each(spark.createDataFrame(rows, schema), spark)
    assert got.columns == ["doc_id", "text", "id", "n", "row"]
    assert sorted(tuple(r) for r in got.collect()) == [rows[1], rows[3]]


def test_components_of_long_chains(spark):
    """Links in a chain, a star and a ring end as stars about their least node."""
    pairs = [(i + 1, i) for i in range(200)] + [(1000 + i, 999) for i in range(1, 50)]
    pairs += [(2000 + (i + 1) % 30, 2000 + i) for i in range(30)]
    edges = spark.createDataFrame([(max(p), min(p)) for p in pairs], "u long, v long")
    got = {r.u: r.v for r in simhash.components(edges, spark).collect()}
    want = {i: 0 for i in range(1, 201)} | {1000 + i: 999 for i in range(1, 50)} | {2000 + i: 2000 for i in range(1, 30)}
    assert got == want
    assert simhash.components(edges.limit(0), spark).count() == 0
