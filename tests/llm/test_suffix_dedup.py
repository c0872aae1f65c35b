from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from lakemart.llm import suffix_dedup
from lakemart.llm.suffix_dedup import digests


def brute(rows, n):
    """Every string in order of (id, start); rows of one id are judged by start alone."""
    seen, out = {}, []
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0))
    for i in order:
        raw = (rows[i][1] or "").encode()
        for s in range(len(raw) - n + 1):
            at = (rows[i][0] is not None, rows[i][0] or 0, s)
            key = raw[s : s + n]
            seen[key] = min(seen.get(key, at), at)
    for doc, text in rows:
        raw = (text or "").encode()
        gone = np.zeros(len(raw) + 1, dtype=bool)
        for s in range(len(raw) - n + 1):
            if seen[raw[s : s + n]] < (doc is not None, doc or 0, s):
                gone[s : s + n] = True
        runs = int((gone[:-1] & ~np.concatenate([[False], gone[:-2]])).sum()) if len(raw) else 0
        left = bytes(b for b, g in zip(raw, gone[:-1], strict=False) if not g)
        out.append((doc, len(raw), int(gone.sum()), runs, hashlib.sha256(left).hexdigest()))
    return sorted(out, key=repr)


def frame(spark, rows):
    data = [(i, t, None, i) for i, t in rows]
    return spark.createDataFrame(data, "doc_id long, text string, part int, spans long").repartition(3)


def corpus(seed, count=60):
    rng = random.Random(seed)
    words = "the and ing er re on añ th st ou es ß keit 12".split()

    def text(n):
        return " ".join("".join(rng.choices(words, k=rng.randint(1, 4))) for _ in range(n))

    passages = [text(rng.randint(10, 60)) for _ in range(6)]
    rows = []
    for i in range(count):
        parts = [text(rng.randint(0, 40))]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            a = rng.randint(0, len(p) // 2)
            parts += [p[a:] if rng.random() < 0.5 else p, text(rng.randint(0, 30))]
        rows.append((i * 3, rng.choice(["", " "]).join(parts)))
    copies = [(1000 + i, rng.choice(rows)[1]) for i in range(15)]
    changed = [(2000 + i, t[: len(t) // 2] + "X" + t[len(t) // 2 + 1 :]) for i, (_, t) in enumerate(rows[:10])]
    runs = [(3000, "a" * 700), (3001, "ab" * 300), (3002, "a" * 99), (3003, "a" * 100), (3004, "abc" * 200)]
    odd = [(4000, None), (4001, ""), (4002, "é" * 200), (5000, rows[3][1]), (5000, rows[3][1]), (5000, rows[4][1]), (None, rows[5][1])]
    out = rows + copies + changed + runs + odd
    rng.shuffle(out)
    return out


@pytest.mark.parametrize(("seed", "n"), [(1, 100), (2, 100), (3, 24), (4, 16)])
def test_matches_brute_force(spark, monkeypatch, seed, n):
    monkeypatch.setattr(suffix_dedup, "GATHER", 300)
    rows = corpus(seed)
    got = sorted((tuple(r) for r in digests(frame(spark, rows), spark, n).collect()), key=repr)
    assert got == brute(rows, n)


def test_sections_of_long_texts():
    raw = np.random.default_rng(0).integers(0, 3, 9_000_000, dtype=np.uint8)
    offsets = np.array([0, 10, 10, 5_000_000, 5_000_050, 9_000_000])
    covered = np.zeros(len(raw), dtype=int)
    for part, starts, text, base in suffix_dedup.Sections(raw, offsets, 99):
        assert starts[-1] == len(part) <= suffix_dedup.SECTION + 99
        for k, (a, b) in enumerate(zip(starts[:-1], starts[1:], strict=True)):
            at = offsets[text[k]] + base[k]
            assert np.array_equal(part[a:b], raw[at : at + b - a])
            covered[at : at + b - a] += 1
    seams = sum(-(-int(n) // suffix_dedup.SECTION) - 1 for n in np.diff(offsets) if n)
    assert covered.min() == 1 and covered.sum() == len(raw) + 99 * seams


def test_long_text_against_its_copy(spark):
    rng = random.Random(9)
    long = "".join(rng.choices("abcdefgh ", k=2_300_000))
    rows = [(1, long), (2, "x" + long[2_000_000:2_200_000] + "y"), (3, long[100:300])]
    got = {r.doc_id: (r.n_removed, r.n_spans) for r in digests(frame(spark, rows), spark).collect()}
    assert got == {1: (0, 0), 2: (200_000, 1), 3: (200, 1)}


def test_texts_and_columns_stay(spark, docs):
    got = suffix_dedup.deduplicated(docs, spark)
    assert got.columns == docs.columns and got.count() == docs.count()
    assert digests(docs.limit(0), spark).count() == 0
    by_id = {r.doc_id: r.text for r in got.collect()}
    assert by_id[1] is None and by_id[2] == "" and by_id[8] == "word "
