from __future__ import annotations

import hashlib
import heapq
import itertools
import random
import re
import zlib

import pytest

from lakemart.llm import conversations as C

SCHEMA = "conv_id long, turn long, role string, text string"


def brute_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        role, text = " " if role is None else role, " " if text is None else text
        code = zlib.crc32(key.encode()) % 20
        if code == 0:
            continue
        text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
        role = "user" if code == 4 else role
        out += [(conv, turn, role, text)] * (2 if code == 3 else 1)
    return out


def brute_repair(rows):
    """The cheapest, then least audit by search over (row, roles so far); rows: (role, text,
    fault). Returns cost, audit and the repaired lines."""
    accepts = re.compile("(s?(ua)+)?")
    begins = [re.compile("s?(ua)*u?")]
    queue = [(0, "", 0, "", ())]
    while queue:
        cost, audit, i, roles, lines = heapq.heappop(queue)
        if i == len(rows) and accepts.fullmatch(roles):
            return cost, audit, list(lines)
        ways = []
        for name in ("user", "assistant"):
            ways.append((2, "I", i, name[0], (f"{name}:",)))
        if i < len(rows):
            role, text, fault = rows[i]
            ways.append((3, "D", i + 1, "", ()))
            if fault not in ("blank", "duplicate"):
                extra = fault == "truncated"
                ways.append((extra, "K", i + 1, role[:1] or "?", (f"{role}:{text}",)))
                ways += [(2 + extra, "R", i + 1, n[0], (f"{n}:{text}",)) for n in ("user", "assistant")]
        for more, letter, j, initial, added in ways:
            now = roles + initial
            if all(b.fullmatch(now) for b in begins):
                heapq.heappush(queue, (cost + more, audit + letter, j, now, lines + added))


def brute(rows):
    """conv_id -> the report, for rows whose order by (turn, role) is plain."""
    out = {}
    live = brute_damage(rows)
    for conv in {r[0] for r in rows}:
        mine = sorted((r for r in live if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2]))
        seen, faults = set(), []
        for _, _, role, text in mine:
            kept = re.sub(r"[\x20\x09-\x0D]+$", "", text)
            fault = "fine" if kept[-1:] in (".", "!", "?") else "truncated"
            fault = "duplicate" if (role, text) in seen else fault
            faults.append("blank" if not re.search(r"[^\x20\x09-\x0D]", text) else fault)
            seen.add((role, text))
        turns = [r[1] for r in mine if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        legal = ("su", "ua", "au")
        illegal = sum(a[2][:1] + b[2][:1] not in legal for a, b in itertools.pairwise(mine))
        cost, audit, lines = brute_repair([(r[2], r[3], f) for r, f in zip(mine, faults, strict=True)])
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
        out[conv] = (gaps, *counts, illegal, cost, audit, digest)
    return out


def found(spark, rows, schema=SCHEMA):
    got = C.reports(C.damaged(spark.createDataFrame(rows, schema)), spark).collect()
    assert len({r.conv_id for r in got}) == len(got)
    return {r.conv_id: tuple(r)[1:] for r in got}


def made(n, seed=3, longest=6):
    rng = random.Random(seed)
    texts = ["Fine.", "Well!", "cut off", "", "  ", "So? ", "é.", None]
    rows = []
    for conv in range(n):
        for turn in range(rng.randint(1, longest)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None, ""])
            rows.append((conv, rng.choice([turn, turn, turn + 2]) if rng.random() < 0.9 else turn, role, rng.choice(texts)))
    # one row a turn, so that the order is the contract's alone
    return [r for i, r in enumerate(rows) if not any(r[:2] == q[:2] for q in rows[:i])]


def test_reports_equal_search(spark):
    rows = made(120) + [(None, 1, "user", "Hi."), (None, 2, "assistant", "Yes."), (7000, None, "user", "No turn.")]
    assert found(spark, rows) == brute(rows)


def test_empty_repeated_and_clashing(spark):
    assert found(spark, []) == {}
    rows = [(1, 0, "user", "Hi.", "x", 1, True)] * 5 + [(2, 0, "", "", "x", None, None)]
    schema = "conv_id long, turn long, role string, text string, tie string, part int, pos boolean"
    got = found(spark, rows, schema)
    live = len(brute_damage([r[:4] for r in rows[:5]]))
    assert got[1][2] == live - 1  # all but the first
    assert got[2][1] == 1 and got[2][5:7] == (3, "D")


@pytest.mark.parametrize("n", [300])
def test_conversation_over_many_partitions(spark, n):
    """One conversation with nearly all rows is cut, and still equals the whole parse."""
    rng = random.Random(8)
    words = ["Yes.", "no", "Why?", "", "Go on!", "x"]
    rows = [(5, t, rng.choice(["user", "assistant", "assistant", "system"]), f"{rng.choice(words)}") for t in range(n)]
    rows += [(c, 0, "user", "A. B.") for c in (1, 9)]
    df = C.damaged(spark.createDataFrame(rows, SCHEMA))
    laid = C.Laid(df, spark)
    assert laid.some_cut
    got = {r.conv_id: r for r in C.reports(df, spark).collect()}
    # rows of a turn: copies only
    live = [(t, role, text) for conv, t, role, text in brute_damage(rows) if conv == 5]
    survey, cost, audit, lines = C._whole(sorted(live, key=lambda r: r[0]))
    mine = got[5]
    assert [mine.gaps, mine.blank, mine.duplicate, mine.truncated, mine.illegal] == survey.report()
    assert (mine.cost, mine.audit, mine.repaired_sha256) == (cost, audit, C._digest(lines))
    rows_out = [r for r in C.repaired(df, spark).collect() if r.conv_id == 5]
    rows_out.sort(key=lambda r: r.place)
    assert [(r.role, r.text) for r in rows_out] == [(role, text) for _, role, text in lines]


def test_all_dropped(spark):
    """A conversation of which no row is left is reported with an empty repair."""
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    got = found(spark, [(gone, 0, "user", "Hi.")])
    assert got == {gone: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_long_texts(spark):
    text = "word " * 200_000 + "."
    rows = [(1, 3, "user", text), (1, 4, "assistant", text), (1, 5, "user", text)]
    assert found(spark, rows) == brute(rows)
