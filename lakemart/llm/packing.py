"""Operator 1: best-fit packing of token sequences, certified by lower bounds.

Every document becomes its token ids and a closing id; only what is longer than a
sequence is cut, into full pieces and a last one. Full pieces fill a sequence each.
The others are dealt to groups by a hash and packed by best-fit decreasing. Bounds
from dual-feasible functions say how few sequences a group could do with; a group
that reaches its bound is done. The groups with a gap put the documents of their
unfilled sequences together, deal them anew by another hash and pack them again;
a repacking counts only if it needs fewer sequences over all.

Null text counts as empty (one closing id); repeated rows are packed each on its
own; an empty table gives an empty table; other columns are ignored. Ties between
equally full sequences are settled by the order of the hash. A null id stays null.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .byte_bpe import byte_letters
from .common import Remembered, acyclic, blocks, give_back, id_text, names, rows, settled

CAPACITY = 2048
#: Pieces that a group packs at a time, about; one task holds one group.
GROUP = 1 << 14
#: A round of exchange takes groups four times as large as the one before, up to this; then
#: it only deals the documents anew.
GROUP_MOST = 1 << 20
#: Words that a worker remembers in a generation, over its tasks; there are two.
REMEMBERED = 250_000

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, uid long"
_TRAIL = ".,!?;:#$%&*"
#: White space for Python, but not for the tokenizer, whose words may hold it.
_ODD = "\x1c\x1d\x1e\x1f"


class Words:
    """Token ids (little-endian, 4 bytes each) of texts, remembered by word.

    The tokenizer drops white space and never joins across it, so a text's ids are
    those of its words. A word of Latin-1 letters is one pre-token: the tokenizer's
    own model takes it, lower-cased, without the steps before. Marks at its end are
    a pre-token apart. All other words pass through the whole tokenizer."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # one core a task
        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = True
        self.model, self.letters = self.whole.model, byte_letters()
        self.known = Remembered(REMEMBERED)
        top = max(self.whole.get_vocab().values(), default=-1) + 1
        self.bytes_of = [n.to_bytes(4, "little") for n in range(top)]

    def packed(self, ids: list[int]) -> bytes:
        return b"".join([self.bytes_of[n] for n in ids])

    def learn(self, words: set[str]) -> dict[str, bytes]:
        """The ids of words, these among others."""
        new = self.known.lacking(words)
        known, old, longest, rest = self.known.young, self.known.old, self.known.longest, []
        bytes_of, tokenize = self.bytes_of, self.model.tokenize
        trails: dict[str, bytes] = {}
        for word in new:
            stem = word.rstrip(_TRAIL)
            if not stem.isalpha() or not (ascii_ := stem.isascii()) and max(stem) > "\xff":
                rest.append(word)
                continue
            low = stem.lower()
            ids = None if low == word else known.get(low) or old.get(low)
            if ids is None:
                text = low if ascii_ else "".join([self.letters[b] for b in low.encode()])
                ids = b"".join([bytes_of[x.id] for x in tokenize(text)])
                if low != word and len(low) <= longest:
                    known[low] = ids
            if len(stem) < len(word):
                trail = word[len(stem) :]
                if trail not in trails:
                    found = self.whole.encode(trail, add_special_tokens=False)
                    trails[trail] = self.packed(found.ids)
                ids += trails[trail]
            known[word] = ids
        for word, found in zip(rest, self.whole.encode_batch_fast(rest, add_special_tokens=False), strict=True):
            known[word] = self.packed(found.ids)
        return known

    def ids(self, texts: list[str]) -> list[bytes]:
        split = [None if any(c in t for c in _ODD) else t.split() for t in texts]
        known = self.learn(set().union(*(w for w in split if w)))
        return [
            self.packed(self.whole.encode(t, add_special_tokens=False).ids)
            if words is None
            else b"".join(map(known.__getitem__, words))
            for t, words in zip(texts, split, strict=True)
        ]


@lru_cache(2)
def words_of(path: str) -> Words:
    return Words(path)


def pieces(
    df: DataFrame,
    tokenizer_path: str,
    capacity: int = CAPACITY,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """The pieces of every document: id, number, start, length and crc32 of the ids,
    a number of its own (uid), and on request the ids themselves as binary."""
    schema = PIECES + ", ids binary" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tokens = words_of(tokenizer_path)
        uid = count(TaskContext.get().partitionId() << 36)
        step = 4 * capacity
        with acyclic():
            for b in blocks(batches):
                out: dict[str, list] = {name: [] for name in names(schema)}
                ids = tokens.ids(b.column(1).to_pylist())
                for doc, raw in zip(b.column(0).to_pylist(), ids, strict=True):
                    raw += b"\0\0\0\0"
                    for k, at in enumerate(range(0, len(raw), step)):
                        part = raw[at : at + step]
                        out["doc_id"].append(doc)
                        out["piece"].append(k)
                        out["start"].append(at // 4)
                        out["length"].append(len(part) // 4)
                        out["ids_crc32"].append(zlib.crc32(part))
                        out["uid"].append(next(uid))
                        if with_ids:
                            out["ids"].append(part)
                yield rows(schema, out)
        give_back()

    return id_text(df, id_col, text_col).mapInArrow(run, schema)


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Best-fit decreasing: the bin and the offset of each length, and the bins used.

    ``open_`` has a bit for every free space that some bin has; the lowest bit from
    the length on is the tightest fit."""
    bins = np.empty(len(lengths), dtype=np.int64)
    offsets = np.empty(len(lengths), dtype=np.int64)
    free: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_, used = 0, 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        fits = open_ >> n
        if fits:
            room = n + (fits & -fits).bit_length() - 1
            bin_ = free[room].pop()
            if not free[room]:
                open_ &= ~(1 << room)
        else:
            room, bin_, used = capacity, used, used + 1
        bins[i], offsets[i] = bin_, capacity - room
        if room > n:
            free[room - n].append(bin_)
            open_ |= 1 << (room - n)
    return bins, offsets, used


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """The largest bound that two families of dual-feasible functions give.

    A dual-feasible function maps lengths so that what fits into a bin still sums to
    at most 1; the sum over all lengths, rounded up, then bounds the bins from below.
    u_k maps x to x if x (k + 1) is whole, else to floor(x (k + 1)) / k; t_a takes
    lengths over 1 - a as whole bins and leaves out those under a."""
    if not len(lengths):
        return 0
    best = -(-int(lengths.sum()) // capacity)
    for k in range(1, 21):
        scaled = lengths * (k + 1)
        whole = scaled % capacity == 0
        # in units of 1 / (k capacity)
        value = np.where(whole, lengths * k, scaled // capacity * capacity)
        best = max(best, -(-int(value.sum()) // (k * capacity)))
    ordered = np.sort(lengths)
    sums = np.concatenate([[0], np.cumsum(ordered)])
    cuts = np.unique(ordered[ordered <= capacity // 2])
    if len(cuts):
        low = np.searchsorted(ordered, cuts, "left")
        high = np.searchsorted(ordered, capacity - cuts, "right")
        best = max(best, int((len(ordered) - high - (-(sums[high] - sums[low]) // capacity)).max()))
    return best


PLACES = "uid long, length long, grp long, bin long, offset long, used long, gap boolean, filled long"


def _packed(items: DataFrame, groups: int, turn: int, capacity: int) -> DataFrame:
    """``items`` (uid, length) packed by best-fit decreasing within groups by a hash."""

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("uid", kind="stable").reset_index(drop=True)
        lengths = part["length"].to_numpy()
        bins, offsets, used = best_fit(lengths, capacity)
        filled = np.bincount(bins, weights=lengths, minlength=used).astype(np.int64)
        return part.assign(
            bin=bins, offset=offsets, used=used, gap=used > lower_bound(lengths, capacity), filled=filled[bins]
        )

    group = F.pmod(F.xxhash64("uid", F.lit(turn)), F.lit(groups))
    dealt = items.select("uid", "length", group.alias("grp"))
    return dealt.groupBy("grp").applyInPandas(run, PLACES)


def _bins(placed: DataFrame) -> int:
    per_group = placed.groupBy("grp").agg(F.count_distinct("bin").alias("bins"))
    return per_group.agg(F.coalesce(F.sum("bins"), F.lit(0))).first()[0]


def packed(
    cut: DataFrame, spark: SparkSession, capacity: int = CAPACITY, group: int = GROUP, most: int = GROUP_MOST
) -> DataFrame:
    """Every piece with its sequence and its place there. ``cut``: from ``pieces``.

    Documents of groups with a gap are exchanged until a round saves no sequence, none has
    a gap left, or one group holds all that is loose. ``certified`` says that no packing does
    better there: the sequence is full, or its group needs as many as its lower bound."""
    cut = settled(cut, spark)
    short = cut.where(F.col("length") < capacity)
    done: list[DataFrame] = []
    rest, n, before, before_bins = short.select("uid", "length"), short.count(), None, 0
    for turn in count():
        groups = max(1, -(-n // group))
        placed = settled(_packed(rest, groups, turn, capacity), spark).withColumn("turn", F.lit(turn))
        if before is not None and _bins(placed) >= before_bins:
            done.append(before)
            break
        loose = F.col("gap") & (F.col("filled") < capacity)
        n = placed.where(loose).count()
        if not n or groups == 1:
            done.append(placed)
            break
        done.append(placed.where(~loose))
        before, rest = placed.where(loose), placed.where(loose).select("uid", "length")
        before_bins = _bins(before)
        group = max(group, min(4 * group, most))
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    number = (F.col("turn") * (1 << 24) + F.col("grp")) * (1 << 28) + F.col("bin")
    certified = ~F.col("gap") | (F.col("filled") == capacity)
    places = out.select("uid", number.alias("sequence_id"), "offset", certified.alias("certified"))
    columns = [c for c in cut.columns if c != "uid"]
    full = cut.where(F.col("length") >= capacity).select(
        *columns, (-1 - F.col("uid")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
        F.lit(True).alias("certified"),
    )
    return short.join(places, "uid").select(*columns, "sequence_id", "offset", "certified").unionByName(full)
