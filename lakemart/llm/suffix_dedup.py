"""Operator 8: exact duplicate passages by prefix-free parsing.

A byte is removed if some string of ``n`` bytes covering it also starts earlier
(smaller doc_id, or the same document and an earlier start). The corpus is parsed
into phrases that overlap: a rolling hash makes the least of each ``width`` positions
a trigger, and the strings of ``n`` bytes whose first-ranked trigger is the same
position form one phrase, the text from the first of them to the end of the last.
Equal strings hold the same trigger at the same place, so that

* a phrase whose context (the bytes after its trigger that all its strings share)
  occurs once in the corpus holds no repeated string;
* of equal phrases only the first can hold a string's first occurrence: the parse,
  a sequence of phrase classes, settles all the others as a whole;
* where one context has several phrases, the suffixes of the dictionary's phrases are
  ranked to a depth of ``n`` bytes, and with the order of the parse that gives the
  corpus order of equal strings. Ranks need to tell equal from different only, so
  they are 96-bit fingerprints of the suffixes, not their places in the alphabet.

Repeats inside a part of the corpus are settled there, so a phrase or a string goes to
the shuffle at most once from each part, however common it is. The text itself is
dealt out once, and read twice from the same exchange.

Null text counts as empty; matches never cross documents. Rows that share an id are
judged by their starts (the same string at the same start of two such rows removes
neither); null ids come before all others. Texts of any length are taken whole: long
ones are parsed in overlapping sections. An empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import blocks, give_back, rows, string_bytes

N = 100
#: Bytes that the rolling hash takes.
GRAM = 8
#: A section of a long text; bounds the tables of powers.
SECTION = 1 << 20
#: Phrases that a task gathers before it sends them: bounds its memory.
GATHER = 1 << 18
#: Bytes of text in a part of the corpus, and behind the phrases of a bucket, about.
PART_BYTES = 6 << 20
_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)
_FIRST = np.iinfo(np.int64).min

#: Strings in a row that the second step takes together.
RUN = 8
#: cnt strings of a text (doc, h) that start from lo on; the trigger is off bytes on.
PLACE = {"doc": "<i8", "h": "<u4", "lo": "<u4", "cnt": "<u2", "off": "<i2"}
ITEM = {"key": "<u8", "form": "<u8", **PLACE}
#: kind 0: all the strings are repeats; 1: they are to be told apart more finely.
SPAN = np.dtype([*PLACE.items(), ("kind", "u1")])
SENT = "bucket int, " + ", ".join(f"{name} binary" for name in ITEM) + ", spans binary"
SPANS = "part int, spans binary"
DIGESTS = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def width_for(n: int) -> int:
    """Positions among which the trigger is the least: leaves a context of over a third
    of ``n`` bytes."""
    if n < 2 * GRAM:
        raise ValueError(f"strings must have {2 * GRAM} bytes at least")
    return max(2, min(n * 16 // 25, n - GRAM + 1))


@lru_cache(1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Random codes of the bytes, powers of the base and their inverses (modulo 2**64)."""
    codes = np.random.default_rng(1).integers(0, 1 << 64, 256, dtype=np.uint64)
    inverse = _U(pow(int(_BASE), -1, 1 << 64))
    size = 2 * SECTION + (64 << 10)
    powers = np.cumprod(np.full(size, _BASE), dtype=np.uint64)
    return codes, powers, np.cumprod(np.full(size, inverse), dtype=np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> _U(29))) * _U(0xFF51AFD7ED558CCD)
    return x ^ (x >> _U(32))


class Section:
    """The bytes of some texts, one after another, with fingerprints of their strings."""

    def __init__(self, raw: np.ndarray):
        codes, powers, self.inverse = _tables()
        self.raw = raw
        self.sums = np.zeros(len(raw) + 1, dtype=np.uint64)
        np.cumsum(codes[raw] * powers[: len(raw)], out=self.sums[1:])

    def prints(self, at: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        return (self.sums[at + length] - self.sums[at]) * self.inverse[at]


def triggers(raw: np.ndarray, width: int) -> np.ndarray:
    """For each position that has ``width`` positions with whole grams from it on, the
    place of the least gram hash among them (the leftmost of equals)."""
    size = len(raw) - GRAM + 1
    if size < width:
        return np.zeros(0, dtype=np.int64)
    grams = np.empty(size, dtype=np.uint64)
    for k in range(GRAM):
        part = raw[k : k + (size - k + GRAM - 1) // GRAM * GRAM]
        part = part[: len(part) // GRAM * GRAM].view("<u8")
        grams[k::GRAM] = part[: len(grams[k::GRAM])]
    low = _U((1 << 24) - 1)
    least = _mixed(grams) & ~low
    least |= np.arange(size, dtype=np.uint64)
    span = 1
    while span * 2 <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < width:
        least = np.minimum(least[: size - width + 1], least[width - span :])
    return (least & low).astype(np.int64)


class Sections:
    """Texts cut for the kernels: short ones joined, long ones in overlapping sections.

    Each section has its bytes, the places there where its texts begin (and the end),
    and for each of them the number of the text and the place in it."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, overlap: int):
        self.raw, self.offsets, self.overlap = raw, offsets, overlap

    def __iter__(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        sizes, first = np.diff(self.offsets), 0
        for i, size in enumerate([*sizes.tolist(), None]):
            held = self.offsets[i] - self.offsets[first]
            if size is None or held + size > SECTION and i > first:
                if i > first:
                    yield self._joined(first, i)
                first = i
            if size is not None and size > SECTION:
                a, b = int(self.offsets[i]), int(self.offsets[i + 1])
                for base in range(0, size, SECTION):
                    part = self.raw[a + base : min(b, a + base + SECTION + self.overlap)]
                    yield part, np.array([0, len(part)]), np.array([i]), np.array([base])
                first = i + 1

    def _joined(self, i: int, j: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        places = self.offsets[i : j + 1]
        part = self.raw[places[0] : places[-1]]
        return part, places - places[0], np.arange(i, j), np.zeros(j - i, dtype=np.int64)


def phrases(raw: np.ndarray, starts: np.ndarray, n: int) -> dict[str, np.ndarray]:
    """The phrases of the texts that begin at ``starts`` (with the end of the last): the
    text each is in, its first string's start there, the number of its strings, how far
    the trigger is from it, and the fingerprints of its context (key) and itself (form)."""
    width = width_for(n)
    anchor = triggers(raw, width)
    change = np.zeros(len(raw) + 2, dtype=np.int32)
    long = np.diff(starts) >= n
    np.add.at(change, starts[:-1][long], 1)
    np.add.at(change, starts[1:][long] - n + 1, -1)
    valid = np.flatnonzero(np.cumsum(change)[: len(raw)])
    anchor = anchor[valid]
    new = np.ones(len(valid), dtype=bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (valid[1:] != valid[:-1] + 1)
    first = np.flatnonzero(new)
    lo, at = valid[first], anchor[first]
    cnt = np.diff(np.append(first, len(valid)))
    section = Section(raw)
    text = np.searchsorted(starts, lo, "right") - 1
    return {
        "text": text,
        "lo": lo - starts[text],
        "cnt": cnt,
        "off": at - lo,
        "key": _mixed(section.prints(at, n - width + 1)),
        "form": _mixed(section.prints(lo, cnt - 1 + n) + (at - lo).astype(np.uint64)),
    }


def finer(section: Section, at: np.ndarray, cnt: np.ndarray, off: np.ndarray, n: int, run: int) -> dict:
    """The strings from ``at`` on, ``cnt`` each, in runs of at most ``run`` that lie alike
    about the trigger; ``of`` says which entry each run is from."""
    last = (off - cnt + 1) // run  # number of the run that holds the last string
    runs = off // run - last + 1
    of = np.repeat(np.arange(len(at)), runs)
    nth = np.arange(len(of)) - np.repeat(np.cumsum(runs) - runs, runs)
    block = off[of] // run - nth
    trigger = at[of] + off[of]
    lo = np.maximum(at[of], trigger - block * run - run + 1)
    hi = np.minimum(at[of] + cnt[of] - 1, trigger - block * run)
    common = trigger - block * run
    if run == 1:
        half = n // 2
        key = section.prints(lo, n)
        form = _mixed(section.prints(lo, half)) * _BASE + section.prints(lo + half, n - half)
    else:
        key = section.prints(common, n - run + 1) + block.astype(np.uint64)
        form = section.prints(lo, hi - lo + n) + ((trigger - lo) << 16 | hi - lo).astype(np.uint64)
    return {"of": of, "lo": lo, "cnt": hi - lo + 1, "off": trigger - lo, "key": _mixed(key), "form": _mixed(form)}


def _spans(items: dict[str, np.ndarray], pick: np.ndarray, kind: int) -> np.ndarray:
    pick = np.flatnonzero(pick)
    out = np.empty(len(pick), dtype=SPAN)
    for name in PLACE:
        out[name] = items[name][pick]
    out["kind"] = kind
    return out


def settle(items: dict[str, np.ndarray], last: bool, here: bool) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """What a set of phrases says of itself: the phrases still open, and the spans decided.

    Equal phrases after their first are repeats. If ``here`` (a part of the corpus), the
    first ones stay open, but of a context with several phrases only two need to be sent
    on, to show that it has; the others are to be told apart in any case. Else (all
    phrases of their contexts) nothing stays open. Phrases of one string (``last``) need
    no telling apart."""
    order = np.lexsort([items[x] for x in ("h", "lo", "doc", "form", "key")])
    items = {k: v[order] for k, v in items.items()}
    if not len(order):
        return items, np.zeros(0, dtype=SPAN)

    def differs(*names: str) -> np.ndarray:
        out = np.ones(len(order), dtype=bool)
        out[1:] = np.logical_or.reduce([items[x][1:] != items[x][:-1] for x in names])
        return out

    new_key = differs("key")
    new_form = differs("key", "form")
    new_start = differs("key", "form", "doc", "lo")
    group = np.cumsum(new_key) - 1
    form = np.cumsum(new_form) - 1
    # a row is first if its start is the one its form begins with
    start = np.cumsum(new_start) - 1
    first = start == start[np.flatnonzero(new_form)][form]
    forms_before = form - form[np.flatnonzero(new_key)][group]
    several = np.bincount(group, weights=new_form)[group] > 1
    decided = [_spans(items, ~first, 0)]
    if here:
        known = first & several & (forms_before > 1) if not last else np.zeros(len(order), dtype=bool)
        decided.append(_spans(items, known, 1))
        keep = first & ~known & differs("key", "form", "doc", "lo", "h")
    else:
        if not last:
            decided.append(_spans(items, first & several, 1))
        keep = np.zeros(len(order), dtype=bool)
    return {k: v[keep] for k, v in items.items()}, np.concatenate(decided)


def _sent(items: dict[str, np.ndarray], spans: np.ndarray, buckets: int) -> pa.RecordBatch:
    """A row for each bucket that any of the keys falls into, columns packed; the spans
    decided go along, dealt evenly over these rows (or one, if there are no keys)."""
    bucket = ((items["key"] >> _U(40)) % _U(buckets)).astype(np.int64)
    order = np.lexsort((items["lo"], items["doc"], bucket))
    met = np.unique(bucket)
    if not len(met):
        met = np.array([int(spans["h"][0]) % buckets] if len(spans) else [], dtype=np.int64)
    cuts = np.searchsorted(bucket[order], met[1:])
    columns: dict[str, list] = {"bucket": met.astype(np.int32)}
    for name in ITEM:
        columns[name] = [x.tobytes() for x in np.split(items[name][order], cuts)][: len(met)]
    columns["spans"] = [x.tobytes() for x in np.array_split(spans, max(1, len(met)))][: len(met)]
    return rows(SENT, columns)


def _gathered(found: list[dict[str, np.ndarray]]) -> dict[str, np.ndarray]:
    return {
        name: np.concatenate([x[name] for x in found]) if found else np.zeros(0, dtype=kind)
        for name, kind in ITEM.items()
    }


def _resolved(sent: DataFrame, last: bool, parts: int) -> DataFrame:
    """All phrases of a bucket settled; the spans go to the parts of their texts."""

    def run(table: pa.Table) -> pa.Table:
        items = {
            name: np.frombuffer(b"".join(table[name].to_pylist()), dtype=kind)
            for name, kind in ITEM.items()
        }
        decided = [np.frombuffer(b"".join(table["spans"].to_pylist()), dtype=SPAN)]
        decided.append(settle(items, last, here=False)[1])
        spans = np.concatenate(decided)
        part = spans["h"] % np.uint32(parts)
        order = np.argsort(part, kind="stable")
        there = np.unique(part)
        cuts = np.searchsorted(part[order], there[1:])
        split = np.split(spans[order], cuts) if len(there) else []
        del items, decided
        give_back()
        return pa.Table.from_batches(
            [rows(SPANS, {"part": there.astype(np.int32), "spans": [x.tobytes() for x in split]})]
        )

    return sent.groupBy("bucket").applyInArrow(run, SPANS)


def merged(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted disjoint runs of the half-open intervals (touching ones joined)."""
    if not len(start):
        return start, end
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(end[order])
    new = np.ones(len(start), dtype=bool)
    new[1:] = start[1:] > reach[:-1]
    at = np.flatnonzero(new)
    return start[at], reach[np.append(at[1:], len(start)) - 1]


class Part:
    """The texts of a part, and the spans that are known of them by text."""

    def __init__(self, texts: pa.Table, spans: pa.Table):
        table = texts.combine_chunks()
        column = table["__text"].chunk(0) if table.num_rows else pa.array([], pa.string())
        self.raw, self.offsets = string_bytes(column) if table.num_rows else (np.zeros(0, np.uint8), np.zeros(1, np.int64))
        self.table = table
        known = np.frombuffer(b"".join(spans["spans"].to_pylist()), dtype=SPAN)
        doc = np.asarray(table["__doc"].to_numpy(), dtype=np.int64)
        h = np.asarray(table["__h"].to_numpy()).astype(np.uint32)
        self.doc, self.h = doc, h
        # rows alike in id and text share their spans
        key = np.rec.fromarrays([known["doc"], known["h"]], names="doc,h")
        order = np.argsort(key, order=("doc", "h"), kind="stable")
        self.known, key = known[order], key[order]
        own = np.rec.fromarrays([doc, h], dtype=key.dtype)
        self.a = np.searchsorted(key, own, "left") if len(key) else np.zeros(len(doc), int)
        self.b = np.searchsorted(key, own, "right") if len(key) else np.zeros(len(doc), int)


def _again(texts: DataFrame, spans: DataFrame, n: int, run_length: int, buckets: int) -> DataFrame:
    """The spans to be told apart, as shorter phrases; the decided ones merged."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        part = Part(left, right)
        seen, found, decided = set(), [], []
        for i, (a, b) in enumerate(zip(part.a.tolist(), part.b.tolist(), strict=True)):
            if a == b or (a, b) in seen:
                continue
            seen.add((a, b))
            known = part.known[a:b]
            done = known[known["kind"] == 0]
            lo = done["lo"].astype(np.int64)
            lo, end = merged(lo, lo + done["cnt"])
            # a span holds 65,535 strings at most
            pieces = -(-(end - lo) // 65535)
            of = np.repeat(np.arange(len(lo)), pieces)
            nth = np.arange(len(of)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            out = np.zeros(len(of), dtype=SPAN)
            out["doc"], out["h"] = part.doc[i], part.h[i]
            out["lo"] = lo[of] + nth * 65535
            out["cnt"] = np.minimum(end[of] - out["lo"], 65535)
            decided.append(out)
            todo = known[known["kind"] == 1]
            if len(todo):
                found.append(_items(part, i, todo, n, run_length))
        items, spans = settle(_gathered(found), run_length == 1, here=True)
        batch = _sent(items, np.concatenate([spans, *decided]), buckets)
        del part, found, decided, items
        give_back()
        return pa.Table.from_batches([batch])

    return texts.groupBy("__part").cogroup(spans.groupBy("part")).applyInArrow(run, SENT)


def _items(part: Part, i: int, todo: np.ndarray, n: int, run_length: int) -> dict[str, np.ndarray]:
    """The runs of one text's spans, section by section."""
    a, b = part.offsets[i], part.offsets[i + 1]
    lo = todo["lo"].astype(np.int64)
    found = []
    for base in np.unique(lo // SECTION * SECTION).tolist():
        mine = np.flatnonzero(lo // SECTION * SECTION == base)
        section = Section(part.raw[a + base : min(b, a + base + SECTION + 4 * n)])
        got = finer(section, lo[mine] - base, todo["cnt"][mine].astype(np.int64), todo["off"][mine].astype(np.int64), n, run_length)
        size = len(got["lo"])
        found.append(
            {
                "key": got["key"],
                "form": got["form"],
                "doc": np.full(size, part.doc[i], dtype=np.int64),
                "h": np.full(size, part.h[i], dtype=np.uint32),
                "lo": (got["lo"] + base).astype(np.uint32),
                "cnt": got["cnt"].astype(np.uint16),
                "off": got["off"].astype(np.int16),
            }
        )
    return _gathered(found)


def _parsed(texts: DataFrame, n: int, buckets: int) -> DataFrame:
    """The phrases of all texts, settled in gatherings of about ``GATHER``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[dict[str, np.ndarray]] = []
        held = 0
        for b in blocks(batches, text="__text"):
            doc, h = b.column(1).to_numpy(), b.column(2).to_numpy().astype(np.uint32)
            for part, starts, text, base in Sections(*string_bytes(b.column(0)), n - 1):
                p = phrases(part, starts, n)
                at = p["text"]
                found.append(
                    {
                        "key": p["key"],
                        "form": p["form"],
                        "doc": doc[text[at]],
                        "h": h[text[at]],
                        "lo": (p["lo"] + base[at]).astype(np.uint32),
                        "cnt": p["cnt"].astype(np.uint16),
                        "off": p["off"].astype(np.int16),
                    }
                )
                held += len(at)
                if held >= GATHER:
                    yield _sent(*settle(_gathered(found), last=False, here=True), buckets)
                    found, held = [], 0
                    give_back()
        if held:
            yield _sent(*settle(_gathered(found), last=False, here=True), buckets)

    return texts.select("__text", "__doc", "__h").mapInArrow(run, SENT)


def _judged(
    df: DataFrame, spark: SparkSession, n: int, id_col: str, text_col: str, others: list[str]
) -> tuple[DataFrame, DataFrame]:
    """The rows with what the steps need (and the other columns asked for), and the spans
    of repeated strings by part. All steps read the rows from one exchange."""
    text = F.coalesce(df[text_col].cast("string"), F.lit(""))
    # as many parts as the texts need, not as the shuffle has partitions; a bucket sends a
    # row to each part that it has spans for, so there are never more rows than spans
    held = df.agg(F.sum(F.octet_length(text))).first()[0] or 0
    parts = buckets = max(1, -(-held // PART_BYTES))
    doc = F.coalesce(df[id_col].cast("long"), F.lit(_FIRST))
    h = F.pmod(F.xxhash64(doc, text), F.lit(1 << 32))
    carried = [df[c].alias(f"c{i}") for i, c in enumerate(others)]
    named = df.select(
        text.alias("__text"), doc.alias("__doc"), h.alias("__h"), df[text_col].isNull().alias("__none"), *carried
    )
    texts = named.withColumn("__part", F.pmod("__h", F.lit(parts)).cast("int"))
    spans = _resolved(_parsed(texts, n, buckets), False, parts)
    for run_length in (RUN, 1):
        spans = _resolved(_again(texts, spans, n, run_length, buckets), run_length == 1, parts)
    return texts, spans


def _removed(part: Part, i: int, n: int) -> tuple[bytes, int, int]:
    """What is left of a text, the bytes removed and the runs they form."""
    known = part.known[part.a[i] : part.b[i]]
    a, b = int(part.offsets[i]), int(part.offsets[i + 1])
    lo = known["lo"].astype(np.int64)
    start, end = merged(lo, lo + known["cnt"] + (n - 1))
    raw, left, at = part.raw, [], a
    for s, e in zip(start.tolist(), end.tolist(), strict=True):
        left.append(raw[at : a + s].tobytes())
        at = a + e
    left.append(raw[at:b].tobytes())
    return b"".join(left), int((end - start).sum()), len(start)


def digests(df: DataFrame, spark: SparkSession, n: int = N, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every text."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        part = Part(left, right)
        out: dict[str, list] = {x: [] for x in ("n_bytes", "n_removed", "n_spans", "kept_sha256")}
        for i, size in enumerate(np.diff(part.offsets).tolist()):
            kept, removed, runs = _removed(part, i, n)
            for name, x in zip(out, (size, removed, runs, hashlib.sha256(kept).hexdigest()), strict=True):
                out[name].append(x)
        ids = pa.array(part.doc, mask=part.doc == _FIRST)
        return pa.Table.from_batches([rows(DIGESTS, {"doc_id": ids, **out})])

    texts, spans = _judged(df, spark, n, id_col, text_col, [])
    return texts.groupBy("__part").cogroup(spans.groupBy("part")).applyInArrow(run, DIGESTS)


def deduplicated(df: DataFrame, spark: SparkSession, n: int = N, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``df`` with the repeats taken out of its texts; a character that loses some of its
    bytes goes. Null texts stay null."""
    schema = df.schema
    others = [c for c in df.columns if c != text_col]
    at = df.columns.index(text_col)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        part = Part(left, right)
        texts = [
            None if none else _removed(part, i, n)[0].decode(errors="ignore")
            for i, none in enumerate(left["__none"].to_pylist())
        ]
        kept = part.table.select([f"c{i}" for i in range(len(others))]).rename_columns(others)
        return kept.add_column(at, text_col, pa.array(texts, pa.string()))

    texts, spans = _judged(df, spark, n, id_col, text_col, others)
    return texts.groupBy("__part").cogroup(spans.groupBy("part")).applyInArrow(run, schema)
