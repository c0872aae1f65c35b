"""Operator 5: exact top-k by inner product, term at a time.

Each component x becomes the whole weight floor(64 x); a vector is the sparse row of its
non-zero weights. The rows stand in blocks, each inverted into postings: per term (the
component's place) the rows that have it and their weights. For a block of queries,
every query weight of a term is scattered, times the posting's weights, into a dense
array of scores, one column a query; no candidate is passed over. Each column's k best
are selected by partition and merged over the blocks.

The query set (ids divisible by a number) meets all rows in blocks: query blocks go to
every group of row blocks, which is the work that exhaustive search has.

Vectors that are null or hold null or non-finite components, and rows with a null id,
take no part. Vectors of unlike lengths share the terms both have; one without non-zero
weights scores 0. Ties go to the smaller id. A row is never its own candidate, while
others of the same id or vector are. Weights and scores are exact within 2**62 either way;
what does not fit a long is given as that limit. An empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import rows, settled, shuffle_width

K = 20
SCALE = 64
DIVISOR = 20
#: Weights and scores beyond it, either way, are given as it: they don't fit a long.
LIMIT = 1 << 62
#: Rows in a block, at most, and queries scored at a time.
BLOCK = 4096
COLUMNS = 64

#: ids (int64) ascending, weights (row by row, ``width`` each, of ``kind``).
ROWS = "block long, width int, kind string, ids binary, weights binary"
QUERIES = "block long, width int, kind string, places binary, ids binary, weights binary"
HITS = "query long, query_id long, vec_id long, score long"


def weights(vectors: pa.Array, scale: int = SCALE) -> tuple[np.ndarray, np.ndarray]:
    """The rows that take part, and their weights (shorter rows filled with zeros)."""
    vectors = vectors.cast(pa.list_(pa.float64()))
    flat = vectors.values
    values = flat.to_numpy(zero_copy_only=False)  # null: nan
    offsets = vectors.offsets.to_numpy().astype(np.int64)
    size = np.diff(offsets)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    valid = np.asarray(vectors.is_valid()) & (bad[offsets[1:]] == bad[offsets[:-1]])
    keep = np.flatnonzero(valid)
    width = int(size[keep].max()) if len(keep) else 0
    out = np.zeros((len(keep), width), dtype=np.int64)
    at = np.arange(width)
    inside = at < size[keep][:, None]
    picked = (offsets[keep][:, None] + at)[inside]
    out[inside] = np.clip(np.floor(values[picked] * scale), -LIMIT, LIMIT).astype(np.int64)
    return keep, out


def _narrow(w: np.ndarray) -> np.ndarray:
    most = int(np.abs(w).max()) if w.size else 0
    kinds = (np.int8, np.int16, np.int32)
    return w.astype(next((k for k in kinds if most <= np.iinfo(k).max), np.int64))


def _blocks(df: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block = TaskContext.get().partitionId() << 32
        for b in batches:
            for at in range(0, b.num_rows, BLOCK):
                part = b.slice(at, BLOCK)
                keep, w = weights(part.column(1), scale)
                ids = part.column(0).to_numpy()[keep]
                order = np.argsort(ids, kind="stable")
                w = _narrow(w[order])
                yield rows(
                    ROWS,
                    {
                        "block": [block],
                        "width": [w.shape[1]],
                        "kind": [w.dtype.str],
                        "ids": [ids[order].astype(np.int64).tobytes()],
                        "weights": [w.tobytes()],
                    },
                )
                block += 1

    known = df.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull())
    picked = known.select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector")
    )
    return picked.mapInArrow(run, ROWS)


def _queries(blocks: DataFrame, divisor: int) -> DataFrame:
    """The queries of each block, with their places there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                ids = np.frombuffer(r["ids"], np.int64)
                places = np.flatnonzero(ids % divisor == 0)
                if len(places):
                    w = np.frombuffer(r["weights"], r["kind"]).reshape(len(ids), r["width"])
                    found = {"places": places.astype(np.int64), "ids": ids[places], "weights": w[places]}
                    yield rows(
                        QUERIES,
                        {
                            **{x: [r[x]] for x in ("block", "width", "kind")},
                            **{x: [v.tobytes()] for x, v in found.items()},
                        },
                    )

    return blocks.mapInArrow(run, QUERIES)


def postings(w: np.ndarray, kind: type) -> list[tuple[slice | np.ndarray, np.ndarray]]:
    """Per term the rows that have it and their weights; a term that most rows have is
    listed for all rows, in one piece."""
    out = []
    for term in range(w.shape[1]):
        column = w[:, term].astype(kind)
        ids = np.flatnonzero(column)
        out.append((slice(None), column) if 2 * len(ids) > len(w) else (ids, column[ids]))
    return out


def accumulate(q: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Scores of all rows ``w`` (down) for the queries ``q`` (across), term at a time."""
    terms = min(q.shape[1], w.shape[1])
    reach = int(np.abs(q.astype(np.int64)).max(initial=0)) * int(np.abs(w.astype(np.int64)).max(initial=0))
    reach *= max(1, terms)
    # what may not fit longs is summed in Python's integers, so that only results are cut
    kind = np.int32 if reach < 1 << 31 else np.int64 if reach < LIMIT else object
    q = q.astype(kind)
    scores = np.zeros((len(w), len(q)), dtype=kind)
    product = np.empty_like(scores)
    for term, (ids, weight) in enumerate(postings(w[:, :terms], kind)):
        has = np.flatnonzero(q[:, term])
        if not len(has) or not len(weight):
            continue
        row = q[:, term]
        if 2 * len(has) <= len(row):
            scores[np.ix_(np.arange(len(w))[ids], has)] += weight[:, None] * row[has]
        elif isinstance(ids, slice):
            scores += np.multiply(weight[:, None], row, out=product)
        else:
            scores[ids] += weight[:, None] * row
    return np.clip(scores, -LIMIT, LIMIT).astype(np.int64) if kind is object else scores


def best(scores: np.ndarray, k: int) -> np.ndarray:
    """The places of the ``k`` highest scores of each row; ties go to the lower place."""
    n = scores.shape[1]
    if n <= k:
        return np.tile(np.arange(n), (len(scores), 1))
    low = int(scores.min())
    if (int(scores.max()) - low) < (1 << 62) // n:
        keys = (scores.astype(np.int64) - low) * n + np.arange(n - 1, -1, -1)
        return np.argpartition(keys, n - k, axis=1)[:, n - k :]
    return np.argsort(-scores, axis=1, kind="stable")[:, :k]


_OWN = np.iinfo(np.int64).min


def _scored(q: dict, c: dict, k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For the queries of ``q`` some at a time: their numbers, and ids and scores of the
    best candidates of ``c``."""
    ids = np.frombuffer(c["ids"], np.int64)
    w = np.frombuffer(c["weights"], c["kind"]).reshape(len(ids), c["width"])
    places = np.frombuffer(q["places"], np.int64)
    wanted = np.frombuffer(q["weights"], q["kind"]).reshape(len(places), q["width"])
    for at in range(0, len(places), COLUMNS):
        mine = places[at : at + COLUMNS]
        scores = np.ascontiguousarray(accumulate(wanted[at : at + COLUMNS], w).T)
        if q["block"] == c["block"]:
            # one more place to choose, so that the query's own can go
            scores = scores.astype(np.int64)
            scores[np.arange(len(mine)), mine] = scores.min() - 1
            top = best(scores, k)
            found = np.take_along_axis(scores, top, axis=1)
            found[top == mine[:, None]] = _OWN
        else:
            top = best(scores, k)
            found = np.take_along_axis(scores, top, axis=1).astype(np.int64)
        yield np.arange(at, at + len(mine)), ids[top], found


def search(
    df: DataFrame,
    spark: SparkSession,
    k: int = K,
    scale: int = SCALE,
    divisor: int = DIVISOR,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of every query's ``k`` best rows."""
    blocks = settled(_blocks(df, id_col, vector_col, scale), spark)
    groups = shuffle_width(spark)
    c = blocks.withColumn("grp", F.pmod(F.xxhash64("block"), F.lit(groups)).cast("int"))
    q = _queries(blocks, divisor).withColumn("grp", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    sides = [f.select("grp", *(F.col(x).alias(n + x) for x in f.columns if x != "grp")) for n, f in (("q_", q), ("c_", c))]
    pairs = sides[0].repartition(groups, "grp").join(sides[1].repartition(groups, "grp").hint("shuffle_merge"), "grp")
    names = [n for n in pairs.columns if n not in ("grp", "c_block_")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: dict | None = None
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def merged() -> pa.RecordBatch:
            ids = np.frombuffer(now["ids"], np.int64)
            places = np.frombuffer(now["places"], np.int64)
            out: dict[str, list] = {x: [] for x in ("query", "query_id", "vec_id", "score")}
            found = np.concatenate([x for x, _ in held], axis=1), np.concatenate([x for _, x in held], axis=1)
            for i, (vec, score) in enumerate(zip(*found, strict=True)):
                vec, score = vec[score != _OWN], score[score != _OWN]
                top = np.lexsort((vec, -score))[:k]
                out["query"].append(np.full(len(top), (now["block"] << 12) + places[i]))
                out["query_id"].append(np.full(len(top), ids[i]))
                out["vec_id"].append(vec[top])
                out["score"].append(score[top])
            return rows(HITS, {x: np.concatenate(v) for x, v in out.items()})

        for b in batches:
            for r in b.to_pylist():
                q_row = {x[2:]: r[x] for x in names if x[:2] == "q_"}
                c_row = {x[2:]: r[x] for x in names if x[:2] == "c_"}
                if now is None or q_row["block"] != now["block"] or len(held) >= 64:
                    if now is not None:
                        yield merged()
                    now, held = q_row, []
                _, vec, score = zip(*_scored(q_row, c_row, k), strict=True)
                held.append((np.concatenate(vec), np.concatenate(score)))
        if now is not None:
            yield merged()

    hits = pairs.select(*names).mapInArrow(run, HITS)
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), "vec_id")
    ranked = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
