from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np

from lakemart.llm import fingerprint as fp


def shingle_set(text, size=5):
    w = text.encode().lower().split()
    return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def jaccard(a, b):
    a, b = shingle_set(a), shingle_set(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def test_edits_match_brute_force(spark):
    rng = random.Random(4)
    words = "the and ing er re on añ th st ou es ß keit 12 Blé".split()
    rows = [(i * 7, " ".join(rng.choices(words, k=rng.randint(0, 55)))) for i in range(150)]
    rows += [(10_000, None), (10_001, ""), (10_002, "one"), (None, "no id at all"), (10_003, rows[4][1])]
    rng.shuffle(rows)
    df = spark.createDataFrame([(i, t, 0, False) for i, t in rows], "doc_id long, text string, part int, guest boolean")
    got = fp.edits(df.repartition(5), spark).collect()
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    want = {}
    for k, (i, t) in enumerate(order):
        t, n = t or "", order[(k + 1) % len(order)][1] or ""
        c = len(t) // 2
        edited = t[: len(t) - c] + n[:c]
        sha = hashlib.sha256(edited.encode()).hexdigest()
        want[i] = (len(t), sha, jaccard(t, edited), jaccard(t, n))
    assert len(got) == len(rows)
    for r in got:
        chars, sha, near_edited, near_next = want[r.doc_id]
        assert (r.n_chars, r.edited_sha256) == (chars, sha)
        # under K distinct shingles the estimates are exact
        assert abs(r.near_edited - near_edited) < 1e-9 and abs(r.near_next - near_next) < 1e-9
    prints = {r.doc_id: r.fingerprint for r in got}
    assert prints[10_003] == prints[rows[[x[0] for x in rows].index(28)][0]] and prints[10_000] == ""


def test_one_row_and_repeated_rows(spark):
    one = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    (r,) = fp.edits(one, spark).collect()
    assert r.near_next == 1.0
    assert r.edited_sha256 == hashlib.sha256(b"a b c a b c"[:6] + b"a b c"[:5]).hexdigest()
    same = spark.createDataFrame([(1, "x y z")] * 5 + [(2, "x y z w")], "doc_id long, text string")
    assert Counter(r.doc_id for r in fp.edits(same, spark).collect()) == {1: 5, 2: 1}
    assert fp.edits(one.limit(0), spark).count() == 0


def test_estimates(doc_rows):
    rng = random.Random(1)
    vocab = [f"w{i}" for i in range(4000)]
    errors = []
    for share in (0.1, 0.5, 0.9):
        a = rng.choices(vocab, k=6000)
        b = a[: int(6000 * share)] + rng.choices(vocab, k=6000 - int(6000 * share))
        x, y = fp.sketches([" ".join(a), " ".join(b)])
        errors.append(abs(fp.resemblance(x, y) - jaccard(" ".join(a), " ".join(b))))
        assert abs(fp.containment(x, y) - share) < 0.15
        assert abs(fp.distinct_shingles(x) / 5996 - 1) < 0.3
    assert max(errors) < 0.15


def test_merge_of_parts_is_sketch_of_whole(spark):
    rng = np.random.default_rng(0)
    hashes = rng.integers(0, 1 << 48, 5000, dtype=np.uint64)
    whole = fp.bottom(np.concatenate([hashes, hashes[:900]]))
    assert np.array_equal(fp.merge([fp.bottom(hashes[:2000]), fp.bottom(hashes[1500:])]), whole)
    assert np.array_equal(whole, np.unique(hashes)[: fp.K])
    assert np.array_equal(fp.unpacked(fp.packed(whole)), whole)
    many = np.repeat(hashes[:50], 100)
    assert np.array_equal(fp.bottom(many), np.unique(many))
    df = spark.createDataFrame([(i, f"a{i % 3} b c d e f{i} g", i % 2) for i in range(40)], "doc_id long, text string, grp int")
    prints = fp.fingerprinted(df).join(df.select("doc_id", "grp"), "doc_id").repartition(4)
    got = {r.grp: r.fingerprint for r in fp.merged(prints, "grp").collect()}
    for g in (0, 1):
        parts = fp.sketches([r.text for r in df.where(df.grp == g).collect()])
        assert got[g] == fp.packed(fp.merge(parts))


def test_odd_texts(spark, docs):
    got = fp.fingerprinted(docs).collect()
    assert len(got) == docs.count()
    by_id = {r.doc_id: r for r in got}
    assert by_id[1].fingerprint == by_id[2].fingerprint == by_id[3].fingerprint == ""
    assert by_id[5].fingerprint == by_id[6].fingerprint
    assert fp.edits(docs, spark).count() == docs.count()
