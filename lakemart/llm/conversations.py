"""Operator 13: repair of conversation structure by generalised LR parsing.

A conversation's roles must form ``(s?(ua)+)?``: nothing, or perhaps a system turn and
then user and assistant in turn. The grammar is C -> empty | T | s T and T -> u a | T u a.
Each row may be kept (K, 0), get the role user or assistant (R, 2) or be deleted (D, 3,
the only way for a blank or duplicate row); an empty user or assistant turn may be
inserted anywhere (I, 2); a truncated row that stays adds 1. The parser follows all
edits at once on a graph-structured stack: after each row there is one node a stack top
(empty, ``s``, ``u``, ``T``; "u a" is reduced to T at once), and of the paths that meet
in a top the one of the least (cost, audit) stays, the audit being the letters of the
edits in order. Letters inserted before a row count to that row, so of two audits up to a
row none begins the other, and the lesser one stays so whatever follows.

Rows are laid out by ranges of (conversation, turn), so one conversation may lie in many
tasks. A conversation within one partition is parsed there. One that a border cuts (at
most one a border, and any very large one) is parsed in segments: from each of the four
tops a segment may start with, the least way to each top it may end with; these ways are
then chained, and the segments edited by what was chosen. No task holds more than one
partition's rows; the digest of a cut conversation streams its rows in order, as SHA-256
is one chain.

Nulls are one space (so a null text is blank, a null role illegal); a null conversation
id is a conversation of its own; null turns come first. Rows of one turn go by role, then
text hash; repeated rows are duplicates. Empty texts are blank. Other columns are ignored,
also if their names clash; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BLOCK_BYTES, blocks, settled, shuffle_width

INSERT, REROLE, DELETE, CUT_OFF = 2, 2, 3, 1
FINE, BLANK, DUPLICATE, TRUNCATED = range(4)
NAMES = {"u": "user", "a": "assistant"}
TOPS = ("", "s", "u", "T")
#: (top, initial) -> top after the shift and, for "a", the reduction to T.
SHIFT = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("T", "u"): "u", ("u", "a"): "T"}
#: Turns to insert at the end until the roles are complete.
LACKING = {"": 0, "T": 0, "u": 1, "s": 2}
LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}
_SPACE = " \t\n\x0b\x0c\r"
_NOTHING = hashlib.sha256(b"").hexdigest()

#: (from, to) -> (cost, letters): the least way from one top to another.
Moves = dict[tuple[str, str], tuple[int, str]]

REPORT = (
    "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
)


def insertable(top: str) -> str:
    return "a" if top == "u" else "u"


@lru_cache(maxsize=None)
def row_moves(fault: int, initial: str) -> Moves:
    """The least way over one row from each top to each top; up to two turns inserted
    before it (three would lead back to a top already met)."""
    found: Moves = {}
    for top in TOPS:
        here = top
        for inserted in range(3):
            ways = [(here, DELETE, "D")]
            if fault not in (BLANK, DUPLICATE):
                extra = CUT_OFF if fault == TRUNCATED else 0
                if (here, initial) in SHIFT:
                    ways.append((SHIFT[here, initial], extra, "K"))
                ways += [(SHIFT[here, r], REROLE + extra, "R") for r in "ua" if (here, r) in SHIFT]
            for to, cost, letter in ways:
                way = (cost + INSERT * inserted, "I" * inserted + letter)
                found[top, to] = min(found.get((top, to), way), way)
            here = SHIFT[here, insertable(here)]
    return found


def chain(steps: list[Moves], start: str = "") -> tuple[dict[str, tuple[int, int]], list[dict]]:
    """The nodes (cost, rank of the audit) after all steps by top, and each step's links
    (top -> top before, letters). Rank orders the audits of the tops at one level."""
    nodes, links = {start: (0, 0)}, []
    for moves in steps:
        best: dict[str, tuple] = {}
        for (a, b), (cost, letters) in moves.items():
            if a in nodes:
                spent, rank = nodes[a]
                way = (spent + cost, rank, letters, a)
                if b not in best or way < best[b]:
                    best[b] = way
        order = sorted(best, key=lambda top: best[top][1:3])
        nodes = {top: (best[top][0], place) for place, top in enumerate(order)}
        links.append({top: (way[3], way[2]) for top, way in best.items()})
    return nodes, links


def back(links: list[dict], top: str) -> tuple[str, list[str]]:
    """The top at the start of the path that ends in ``top``, and the letters of each step."""
    letters = []
    for link in reversed(links):
        top, said = link[top]
        letters.append(said)
    return top, letters[::-1]


def accepted(nodes: dict[str, tuple[int, int]]) -> tuple[int, str]:
    """Cost and top of the least way to complete roles."""
    cost, _, top = min((c + INSERT * LACKING[t], rank, t) for t, (c, rank) in nodes.items())
    return cost, top


def edited(
    top: str, letters: list[str], rows: list[tuple[str, str]]
) -> Iterator[tuple[int, str, str]]:
    """(row number, role, text) of what stays or is inserted, from ``top`` on; further
    letters than rows are turns inserted at the end."""
    for i, said in enumerate(letters):
        for letter in said:
            if letter == "D":
                continue
            initial = rows[i][0][:1] if letter == "K" else insertable(top)
            if letter == "K":
                yield i, *rows[i]
            else:
                yield i, NAMES[initial], rows[i][1] if letter == "R" else ""
            top = SHIFT[top, initial]


def fault_of(text: str, seen: bool) -> int:
    kept = text.rstrip(_SPACE)
    if not kept:
        return BLANK
    if seen:
        return DUPLICATE
    return FINE if kept[-1] in ".!?" else TRUNCATED


class Survey:
    """Faults, illegal neighbours and turns of rows in order; segments' surveys join."""

    FIELDS = ("rows", "blank", "duplicate", "truncated", "illegal", "distinct", "first_turn", "last_turn", "first", "last")

    def __init__(self, values: list | None = None):
        given = values or [0, 0, 0, 0, 0, 0, None, None, None, None]
        for name, value in zip(self.FIELDS, given, strict=True):
            setattr(self, name, value)

    def values(self) -> list:
        return [getattr(self, name) for name in self.FIELDS]

    def add(self, turn: int | None, initial: str, fault: int) -> None:
        counts = [int(fault == f) for f in (BLANK, DUPLICATE, TRUNCATED)]
        self.join(Survey([1, *counts, 0, int(turn is not None), turn, turn, initial, initial]))

    def join(self, after: "Survey") -> None:
        if not after.rows:
            return
        if self.rows and (self.last, after.first) not in LEGAL:
            self.illegal += 1
        if self.last_turn is not None and self.last_turn == after.first_turn:
            self.distinct -= 1
        for name in self.FIELDS[:6]:
            setattr(self, name, getattr(self, name) + getattr(after, name))
        if not self.rows - after.rows:
            self.first = after.first
        self.last = after.last
        self.first_turn = after.first_turn if self.first_turn is None else self.first_turn
        self.last_turn = self.last_turn if after.last_turn is None else after.last_turn

    def report(self) -> list[int]:
        gaps = 0 if self.first_turn is None else self.last_turn - self.first_turn + 1 - self.distinct
        return [gaps, self.blank, self.duplicate, self.truncated, self.illegal]


def damaged(df: DataFrame) -> DataFrame:
    """``conversations`` with the contract's faults: by crc32(``conv_id:turn``) modulo 20 a
    row is dropped (0: marked ``gone``), emptied (1), loses its marks (2), is repeated (3)
    or gets the role user (4)."""
    space = F.lit(" ")
    key = F.concat(
        F.coalesce(df["conv_id"].cast("string"), space), F.lit(":"), F.coalesce(df["turn"].cast("string"), space)
    )
    code = F.crc32(key.cast("binary")) % 20
    role, text = F.coalesce(df["role"].cast("string"), space), F.coalesce(df["text"].cast("string"), space)
    return df.select(
        df["conv_id"],
        df["turn"].cast("long").alias("turn"),
        F.when(code == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(code == 1, F.lit("")).when(code == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        (code == 0).alias("gone"),
        F.explode(F.when(code == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    )


_ORDER = ("conv_id", "turn", "role", "tie", "copy", "uid")


class Laid:
    """Rows in order over the partitions of a checkpoint, and the conversations that the
    partitions' borders cut (at most one a border)."""

    def __init__(self, df: DataFrame, spark: SparkSession):
        space = F.lit(" ")
        rows = df.select(
            "conv_id",
            F.col("turn").cast("long").alias("turn"),
            F.coalesce(F.col("role").cast("string"), space).alias("role"),
            F.coalesce(F.col("text").cast("string"), space).alias("text"),
            F.col("gone") if "gone" in df.columns else F.lit(False).alias("gone"),
            F.col("copy") if "copy" in df.columns else F.lit(0).alias("copy"),
        )
        keyed = rows.withColumns({"tie": F.xxhash64("text"), "uid": F.monotonically_increasing_id()})
        ordered = keyed.repartitionByRange(shuffle_width(spark), *_ORDER).sortWithinPartitions(*_ORDER)
        laid = settled(ordered.drop("tie", "copy", "uid"), spark)
        self.rows = laid.withColumns({"part": F.spark_partition_id(), "pos": F.monotonically_increasing_id()})
        conv = F.struct(F.col("conv_id").isNotNull().alias("known"), "conv_id")
        ends = self.rows.groupBy("part").agg(F.min(conv).alias("low"), F.max(conv).alias("high"))
        ends = ends.orderBy("part").collect()  # one row a partition
        borders = [a.high for a, b in zip(ends, ends[1:], strict=False) if a.high == b.low]
        known = [x.conv_id for x in borders if x.known]
        cut = F.col("conv_id").isin(known) if known else F.lit(False)
        null_cut = any(not x.known for x in borders)
        self.cut = F.coalesce(cut, F.lit(null_cut))
        self.some_cut = bool(borders)


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, list[tuple]]]:
    """(conv_id, its rows that are there) of rows in order."""
    conv, held = None, None
    for batch in blocks(batches):
        for c, turn, role, text, gone in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
            if held is None or c != conv:
                if held is not None:
                    yield conv, held
                conv, held = c, []
            if not gone:
                held.append((turn, role, text))
    if held is not None:
        yield conv, held


def _whole(rows: list[tuple]) -> tuple[Survey, int, str, list[tuple[int, str, str]]]:
    """Survey, cost, audit and repaired rows of a conversation."""
    survey, steps, seen = Survey(), [], set()
    for turn, role, text in rows:
        fault = fault_of(text, (role, text) in seen)
        seen.add((role, text))
        survey.add(turn, role[:1], fault)
        steps.append(row_moves(fault, role[:1]))
    nodes, links = chain(steps)
    cost, top = accepted(nodes)
    _, letters = back(links, top)
    letters.append("I" * LACKING[top])
    pairs = [(role, text) for _, role, text in rows]
    return survey, cost, "".join(letters), list(edited("", letters, pairs))


def _digest(lines: list[tuple[int, str, str]]) -> str:
    return hashlib.sha256("\n".join(f"{role}:{text}" for _, role, text in lines).encode()).hexdigest()


def _batches(made: Iterator[tuple], schema: pa.Schema, size: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Rows as batches of about ``size`` characters of their texts."""
    held: list[tuple] = []
    room = size
    for row in made:
        held.append(row)
        room -= 64 + sum(len(x) for x in row if isinstance(x, str))
        if room < 0:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
            held, room = [], size
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)


def _fields(conv_type: str, more: str) -> tuple[str, pa.Schema]:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = f"conv_id {conv_type}, {more}"
    return schema, to_arrow_schema(StructType.fromDDL(schema))


class Segments:
    """The cut conversations, segment by segment (a segment: a conversation's rows in one
    partition): the chosen edits, and from them reports and repaired rows."""

    def __init__(self, laid: Laid, spark: SparkSession):
        rows = laid.rows.where(laid.cut)
        key = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit(""))
        rows = rows.withColumn("ckey", key)
        there = rows.where(~F.col("gone"))
        first = there.groupBy("ckey", "role", F.md5(F.col("text").cast("binary"))).agg(F.min("pos").alias("pos"))
        self.rows = there.join(first.select("pos", F.lit(True).alias("is_first")), "pos", "left")
        self.every = rows.select("conv_id", "ckey").distinct()
        self.chosen = settled(self._chosen(), spark)
        self.width = shuffle_width(spark)

    def _surveyed(self) -> DataFrame:
        def run(part: pd.DataFrame) -> pd.DataFrame:
            part = part.sort_values("pos")
            survey, steps = Survey(), []
            turns = part["turn"].astype(object).where(part["turn"].notna(), None)
            for turn, role, text, seen in zip(turns, part["role"], part["text"], part["is_first"].isna(), strict=True):
                fault = fault_of(text, seen)
                survey.add(None if turn is None else int(turn), role[:1], fault)
                steps.append(row_moves(fault, role[:1]))
            ways = []
            for start in TOPS:
                nodes, links = chain(steps, start)
                ways += [[start, end, cost, "".join(back(links, end)[1])] for end, (cost, _) in nodes.items()]
            head = part.iloc[0]
            return pd.DataFrame(
                {"ckey": [head["ckey"]], "part": [head["part"]], "survey": [json.dumps(survey.values())], "ways": [json.dumps(ways)]}
            )

        return self.rows.select("ckey", "part", "pos", "turn", "role", "text", "is_first").groupBy("ckey", "part").applyInPandas(
            run, "ckey string, part int, survey string, ways string"
        )

    def _chosen(self) -> DataFrame:
        def run(part: pd.DataFrame) -> pd.DataFrame:
            part = part.sort_values("part")
            survey, steps = Survey(), []
            for values, ways in zip(part["survey"], part["ways"], strict=True):
                survey.join(Survey(json.loads(values)))
                steps.append({(a, b): (cost, audit) for a, b, cost, audit in json.loads(ways)})
            nodes, links = chain(steps)
            cost, top = accepted(nodes)
            _, letters = back(links, top)
            starts = _starts(links, top)
            end = ["I" * LACKING[top] if i == len(letters) - 1 else "" for i in range(len(letters))]
            out = pd.DataFrame({"ckey": part["ckey"], "part": part["part"], "start": starts, "audit": letters, "ending": end})
            for name, value in zip(("gaps", "blank", "duplicate", "truncated", "illegal"), survey.report(), strict=True):
                out[name] = value
            out["cost"] = cost
            return out

        schema = "ckey string, part int, start string, audit string, ending string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long"
        return self._surveyed().groupBy("ckey").applyInPandas(run, schema)

    def repaired(self) -> DataFrame:
        """ckey, pos, k (place among the turns that stand at one row), role, text."""

        def run(rows: pd.DataFrame, chosen: pd.DataFrame) -> pd.DataFrame:
            rows = rows.sort_values("pos")
            pairs = list(zip(rows["role"], rows["text"], strict=True))
            letters = _by_row(chosen["audit"].iloc[0]) + [chosen["ending"].iloc[0]]
            places = rows["pos"].tolist()
            places.append(places[-1])
            out, k, before = [], 0, None
            for i, role, text in edited(chosen["start"].iloc[0], letters, pairs):
                k = k + 1 if places[i] == before else 0
                before = places[i]
                out.append((rows["ckey"].iloc[0], before, k, role, text))
            return pd.DataFrame(out, columns=["ckey", "pos", "k", "role", "text"])

        here = self.rows.select("ckey", "part", "pos", "role", "text").groupBy("ckey", "part")
        plan = self.chosen.select("ckey", "part", "start", "audit", "ending").groupBy("ckey", "part")
        return here.cogroup(plan).applyInPandas(run, "ckey string, pos long, k int, role string, text string")

    def reports(self, schema: str) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def made() -> Iterator[tuple]:
                key, state = None, None
                for batch in batches:
                    for ckey, role, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                        if ckey != key:
                            if state is not None:
                                yield key, state.hexdigest()
                            key, state = ckey, hashlib.sha256()
                        else:
                            state.update(b"\n")
                        state.update(f"{role}:{text}".encode())
                if state is not None:
                    yield key, state.hexdigest()

            yield from _batches(made(), pa.schema([("ckey", pa.string()), ("repaired_sha256", pa.string())]))

        order = ("ckey", "pos", "k")
        streamed = self.repaired().repartition(self.width, "ckey").sortWithinPartitions(*order)
        digests = streamed.select("ckey", "role", "text").mapInArrow(run, "ckey string, repaired_sha256 string")
        counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
        pieces = F.array_sort(F.collect_list(F.struct("part", F.concat("audit", "ending").alias("said"))))
        per = self.chosen.groupBy("ckey").agg(
            *[F.first(c).alias(c) for c in counts], F.array_join(F.transform(pieces, lambda x: x["said"]), "").alias("audit")
        )
        joined = self.every.join(per, "ckey", "left").join(digests, "ckey", "left")
        return joined.select(
            "conv_id",
            *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts],
            F.coalesce("audit", F.lit("")).alias("audit"),
            F.coalesce("repaired_sha256", F.lit(_NOTHING)).alias("repaired_sha256"),
        )


def _starts(links: list[dict], top: str) -> list[str]:
    """The top before each step on the path that ends in ``top``."""
    tops = []
    for link in reversed(links):
        top = link[top][0]
        tops.append(top)
    return tops[::-1]


def _by_row(audit: str) -> list[str]:
    """An audit cut after each row's own letter."""
    rows, at = [], 0
    for i, letter in enumerate(audit):
        if letter != "I":
            rows.append(audit[at : i + 1])
            at = i + 1
    return rows


def reports(df: DataFrame, spark: SparkSession) -> DataFrame:
    """One row a conversation: its faults, the cost and audit of the cheapest repair, and
    the SHA-256 of the repaired ``role:text`` lines. Rows marked ``gone`` only name their
    conversation."""
    laid = Laid(df, spark)
    schema, fields = _fields(laid.rows.schema["conv_id"].dataType.simpleString(), f"{REPORT}, repaired_sha256 string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made() -> Iterator[tuple]:
            for conv, rows in _conversations(batches):
                survey, cost, audit, lines = _whole(rows)
                yield conv, *survey.report(), cost, audit, _digest(lines)

        yield from _batches(made(), fields)

    here = laid.rows.where(~laid.cut).select("conv_id", "turn", "role", "text", "gone")
    found = here.mapInArrow(run, schema)
    if laid.some_cut:
        found = found.unionByName(Segments(laid, spark).reports(schema))
    return found


def repaired(df: DataFrame, spark: SparkSession) -> DataFrame:
    """The repaired conversations' rows: conv_id, place (rising within a conversation),
    role, text."""
    laid = Laid(df, spark)
    schema, fields = _fields(laid.rows.schema["conv_id"].dataType.simpleString(), "place long, role string, text string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made() -> Iterator[tuple]:
            for conv, rows in _conversations(batches):
                for place, (_, role, text) in enumerate(_whole(rows)[3]):
                    yield conv, place, role, text

        yield from _batches(made(), fields)

    found = laid.rows.where(~laid.cut).select("conv_id", "turn", "role", "text", "gone").mapInArrow(run, schema)
    if laid.some_cut:
        cut = Segments(laid, spark)
        place = F.col("pos") * 8 + F.col("k")  # a row brings five turns at most
        rows = cut.repaired().join(cut.every, "ckey").select("conv_id", place.alias("place"), "role", "text")
        found = found.unionByName(rows)
    return found
