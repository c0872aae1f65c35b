from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

from lakemart.llm import sharding as S

SCHEMA = "doc_id long, text string"


def brute(rows, shards, tolerance):
    """(doc_id, size, crc, shard, slot) by sums over the sorted rows."""
    keyed = []
    for doc, text in rows:
        raw = (text or "").encode()
        keyed.append((int(hashlib.md5(raw).hexdigest()[:15], 16), doc is not None, doc or 0, len(raw) + 16, zlib.crc32(raw)))
    keyed.sort()
    before, at = [], 0
    for r in keyed:
        before.append(at)
        at += r[3]
    total = at
    edges = defaultdict(lambda: [total, 0])
    for r, b in zip(keyed, before, strict=True):
        edges[r[0]] = [min(edges[r[0]][0], b), max(edges[r[0]][1], b + r[3])]
    borders = []
    for k in range(1, shards) if total else []:
        low, high = next(e for e in edges.values() if e[0] * shards < k * total <= e[1] * shards)
        aim = k * total / shards
        if min(aim - low, high - aim) <= tolerance * total / shards:
            borders.append(low if aim - low <= high - aim else high)
        else:
            borders.append(min([b for b in before if b * shards >= k * total], default=total))
    slots, out = Counter(), []
    for r, b in zip(keyed, before, strict=True):
        shard = sum(x <= b for x in borders)
        out.append((r[2] if r[1] else None, r[3], r[4], shard, slots[shard]))
        slots[shard] += 1
    return out


def found(spark, rows, shards=S.SHARDS, tolerance=S.TOLERANCE, schema=SCHEMA, **more):
    df = spark.createDataFrame(rows, schema).repartition(3)
    got = S.sharded(df, spark, shards, tolerance, **more).collect()
    assert {(r.law, r.grown_shard) for r in got} <= {("bytes", None)}
    return [(r.doc_id, r.size, r.text_crc32, r.shard, r.slot) for r in got]


def key(rows):
    return sorted(rows, key=str)


def test_odd_rows(spark, doc_rows):
    rows = [(i, t) for i, t in doc_rows]
    assert key(found(spark, rows)) == key(brute(rows, S.SHARDS, S.TOLERANCE))
    assert key(found(spark, rows, 7, 0.0)) == key(brute(rows, 7, 0.0))
    assert key(found(spark, rows, 1)) == key(brute(rows, 1, S.TOLERANCE))


def test_group_of_copies_is_split_only_if_it_must(spark):
    rng = random.Random(4)
    rows = [(i, "copy " * 20) for i in range(700)] + [(None, None)] * 300 + [(3, "same")] * 400
    rows += [(10_000 + i, "w" * rng.randint(1, 200)) for i in range(800)]
    got = found(spark, rows, 8)
    assert key(got) == key(brute(rows, 8, S.TOLERANCE))
    sizes = Counter()
    for _, size, _, shard, _ in got:
        sizes[shard] += size
    assert max(sizes.values()) - min(sizes.values()) <= 2 * (0.01 * sum(sizes.values()) / 8 + 216)
    slots = defaultdict(list)
    for *_, shard, slot in got:
        slots[shard].append(slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_small_groups_stay_together(spark):
    rng = random.Random(9)
    rows = [(i * 3 + k, f"text {i} " * rng.randint(1, 9)) for i in range(2000) for k in range(3)]
    got = found(spark, rows, 4)
    shards = defaultdict(set)
    text_of = dict(rows)
    for doc, _, _, shard, _ in got:
        shards[text_of[doc]].add(shard)
    assert all(len(s) == 1 for s in shards.values())


def test_empty_and_fewer_rows_than_shards(spark):
    assert found(spark, []) == []
    rows = [(1, "a"), (2, "bb")]
    assert key(found(spark, rows)) == key(brute(rows, S.SHARDS, S.TOLERANCE))


def test_carried_columns_and_written(spark, scratch):
    schema = "doc_id long, text string, size string, w1 string, part string, cell string, carried string"
    rows = [(i, f"text {i % 5}", "s", "a", "b", "c", "d") for i in range(60)]
    df = spark.createDataFrame(rows, schema)
    kept = S.sharded(df, spark, 3, carry=df.columns).collect()
    assert {(r.w1, r.part, r.cell, r.carried) for r in kept} == {("a", "b", "c", "d")}
    assert all(r["size"] == len(f"text {r.doc_id % 5}") + 16 for r in kept)
    back = S.written(df, spark, f"{scratch}/shards", 3)
    assert sorted((r.doc_id, r.text) for r in back.collect()) == [(r[0], r[1]) for r in rows]


def test_no_python_in_the_plan(spark, doc_rows):
    df = S.sharded(spark.createDataFrame([(i, t) for i, t in doc_rows], SCHEMA), spark)
    plan = df._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))
