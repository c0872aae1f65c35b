"""Operator 6: personal data by patterns and a semi-Markov conditional random field.

Four kinds are found by fixed patterns; those spans always stand. Around digits, at
signs and their spelled-out forms that no pattern explains, a semi-Markov CRF reads the
tokens: every segment of up to ``LONGEST`` tokens is a candidate for each kind, scored
by features of the whole span (digits, their groups, separators, check digit, shape,
what stands on either side), and dynamic programming chooses boundaries and kinds
jointly. It adds what the patterns miss, such as a phone number without its plus sign.

It learns by maximum likelihood from the patterns' spans in a bounded sample of the
texts, the same spans rewritten in other usual forms, and made-up numbers that are
nothing (dates, versions, order numbers).

Null text counts as empty. Repeated rows get the same answer each; an empty table gives
an empty table; other columns are ignored. Texts are read whole, however long.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks, id_text, rows, string_bytes

KINDS = ("email", "ip", "card", "phone")
SCHEMA = (
    "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
)
#: Tokens of the longest candidate, and tokens whose candidates are held at a time.
LONGEST = 32
STEP = 2000
#: Texts to look for examples in, and zones to learn from: bounds the work of fitting.
SAMPLE_TEXTS = 20_000
SAMPLE_ZONES = 400
#: How far a segment must stand above none (in log-odds) to be added.
MARGIN = 1.0

Span = tuple[int, int, str]

# The patterns. Where a run could be entered at every character, the part
# before it is taken at once; the matches are the same.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        n = int(c) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join([c for c in text if "0" <= c <= "9"])


def _emails(text: str) -> Iterator[Span]:
    at, free = text.find("@"), 0
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            free = m.end()
            yield start, free, "email"
        at = text.find("@", max(at + 1, free))


def found_in(text: str) -> list[Span]:
    """(start, end, kind) of what the patterns find, in order."""
    out = [*_emails(text)] if "@" in text else []
    for m in _IP.finditer(text):
        if all(len(x.lstrip("0")) <= 3 and int(x[-3:]) <= 255 for x in m[0].split(".")):
            out.append((m.start(), m.end(), "ip"))
    for m in _CARD.finditer(text):
        if 14 <= len(digits := _digits(m[0])) <= 19 and luhn(digits):
            out.append((m.start(), m.end(), "card"))
    if "+" in text:
        out += [(m.start(), m.end(), "phone") for m in _PHONE.finditer(text) if 10 <= len(_digits(m[0])) <= 15]
    return in_order(out)


def in_order(spans: list[Span]) -> list[Span]:
    return sorted(set(spans), key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


# ---- zones and candidates

_WORD = re.compile(r"\S+")
_SPELLED = r"[\[({](?:at|dot|AT|DOT|\.|@)[\])}]"
_SEED = re.compile(rf"[0-9@]|{_SPELLED}")
_TOKEN = re.compile(rf"{_SPELLED}|[A-Za-z]+|[0-9]+|\s+|[^\s0-9A-Za-z]")


def zones(text: str, base: list[Span], all_: bool = False) -> list[tuple[int, int]]:
    """Stretches of text around words with digits or at signs, three words to either side.

    Unless ``all_``, only those with an at sign or four digits outside of ``base``."""
    words = [(m.start(), m.end(), bool(_SEED.search(m[0]))) for m in _WORD.finditer(text)]
    out: list[tuple[int, int]] = []
    for k, (_, _, seed) in enumerate(words):
        if seed:
            a, b = words[max(0, k - 3)][0], words[min(len(words) - 1, k + 3)][1]
            if out and a <= out[-1][1]:
                out[-1] = (out[-1][0], b)
            else:
                out.append((a, b))
    if all_:
        return out
    covered = sorted((a, b) for a, b, _ in base)
    kept, k = [], 0
    for a, b in out:
        while k < len(covered) and covered[k][1] <= a:
            k += 1
        rest, at, j = [], a, k
        while j < len(covered) and covered[j][0] < b:
            rest.append(text[at : max(at, covered[j][0])])
            at = max(at, covered[j][1])
            j += 1
        left = " ".join([*rest, text[at:b]])
        if sum(c in "0123456789" for c in left) >= 4 or "@" in left or re.search(_SPELLED, left):
            kept.append((a, b))
    return kept


def _bucket(x: np.ndarray, edges: list[int]) -> np.ndarray:
    return np.searchsorted(edges, x, "right")


_DIGIT_EDGES = [1, 4, 7, 10, 11, 12, 13, 14, 16, 17, 20]
#: Name and number of values of each feature of a span.
FEATURES = {
    "digits": 12, "letters": 4, "at": 3, "dots": 5, "spaces": 5, "hyphens": 4, "brackets": 3,
    "ends": 25, "before": 5, "after": 5, "check": 3, "quad": 3, "groups": 7, "longest": 8,
    "others": 3, "domain": 6, "digits_groups": 84, "plus_digits": 24,
}
_OFFSETS = dict(zip(FEATURES, np.cumsum([0, *FEATURES.values()])[:-1].tolist(), strict=True))
SIZE = sum(FEATURES.values())


def _side(c: str) -> int:
    return 0 if not c or c.isspace() else 1 if c.isalpha() else 2 if c.isdigit() else 3 if c == "." else 4


@dataclass
class Candidates:
    """The candidates of a zone: first token, token after the last, feature numbers."""

    places: list[tuple[int, int]]
    first: np.ndarray
    last: np.ndarray
    features: np.ndarray


def candidates(text: str, a: int, b: int) -> Candidates:
    tokens = [(m.start(), m.end(), m[0]) for m in _TOKEN.finditer(text, a, b)]
    n = len(tokens)
    kind = np.zeros(n, dtype=np.int64)  # 0 digits, 1 letters, 2 plus, 3 open bracket, 4 other
    count: dict[str, np.ndarray] = {
        x: np.zeros(n + 1, dtype=np.int64) for x in ("digits", "letters", "at", "dots", "spaces", "hyphens", "open", "close", "others", "groups")
    }
    for k, (_, _, t) in enumerate(tokens):
        c = t[0]
        if "0" <= c <= "9":
            name, size = "digits", len(t)
            count["groups"][k + 1] = 1
        elif c.isascii() and c.isalpha():
            name, size, kind[k] = "letters", len(t), 1
        elif c.isspace():
            name, size, kind[k] = "spaces", 1, 5
        elif c == "@" or len(t) > 1 and t[1] in "aA@":
            name, size, kind[k] = "at", 1, 4
        elif c == "." or len(t) > 1:
            name, size, kind[k] = "dots", 1, 4
        elif c == "-":
            name, size, kind[k] = "hyphens", 1, 4
        elif c == "(":
            name, size, kind[k] = "open", 1, 3
        elif c == ")":
            name, size, kind[k] = "close", 1, 4
        else:
            name, size, kind[k] = "others", 1, 2 if c == "+" else 4
        count[name][k + 1] = size
    sums = {x: np.cumsum(v) for x, v in count.items()}
    first, last = np.nonzero(np.subtract.outer(np.arange(n + 1), np.arange(n)).T > 0)
    near = last - first <= LONGEST
    first, last = first[near], last[near]

    def within(name: str) -> np.ndarray:
        return sums[name][last] - sums[name][first]

    keep = (kind[first] != 5) & (kind[last - 1] != 5) & ((within("digits") >= 3) | (within("at") > 0))
    first, last = first[keep], last[keep]
    digits, groups, dots = within("digits"), within("groups"), within("dots")
    sizes = count["digits"][1:]
    longest = np.array([sizes[i:j].max() for i, j in zip(first.tolist(), last.tolist(), strict=True)], dtype=np.int64)
    check, quad = np.zeros(len(first), np.int64), np.zeros(len(first), np.int64)
    domain = np.zeros(len(first), np.int64)
    for k in np.flatnonzero((digits >= 13) & (digits <= 19)).tolist():
        run = "".join([t for _, _, t in tokens[first[k] : last[k]] if "0" <= t[0] <= "9"])
        check[k] = 1 + luhn(run)
    for k in np.flatnonzero((groups == 4) & (dots == 3) & (last - first == 7)).tolist():
        parts = [t for _, _, t in tokens[first[k] : last[k] : 2]]
        if all("0" <= p[0] <= "9" for p in parts):
            quad[k] = 1 + all(len(p) <= 3 and int(p) <= 255 for p in parts)
    at = within("at")
    tail = (kind[last - 1] == 1) & (last - first > 2)
    if len(first):
        point = np.array([t[0] == "." or len(t) > 1 and t[1] in "dD." for _, _, t in tokens], dtype=bool)
        spaced = (kind[last - 2] == 5) & (last - first > 3)
        before_tail = np.where(spaced, last - 3, last - 2)
        domain = (tail & point[before_tail]).astype(np.int64) + 2 * np.minimum(at, 2)
    left = np.array([_side(text[s - 1 : s]) for s, _, _ in tokens], dtype=np.int64)
    right = np.array([_side(text[e : e + 1]) for _, e, _ in tokens], dtype=np.int64)
    opened, closed = within("open"), within("close")
    digit_bucket, group_bucket = _bucket(digits, _DIGIT_EDGES), np.minimum(groups, 6)
    values = {
        "digits": digit_bucket,
        "letters": _bucket(within("letters"), [1, 3, 9]),
        "at": np.minimum(at, 2),
        "dots": np.minimum(dots, 4),
        "spaces": np.minimum(within("spaces"), 4),
        "hyphens": np.minimum(within("hyphens"), 3),
        "brackets": np.where(opened + closed == 0, 0, np.where(opened == closed, 1, 2)),
        "ends": np.minimum(kind[first], 4) * 5 + np.minimum(kind[last - 1], 4),
        "before": left[first] if n else first,
        "after": right[last - 1] if n else first,
        "check": check,
        "quad": quad,
        "groups": group_bucket,
        "longest": _bucket(longest, [1, 3, 4, 5, 10, 11, 14]),
        "others": np.minimum(within("others"), 2),
        "domain": domain,
        "digits_groups": digit_bucket * 7 + group_bucket,
        "plus_digits": (kind[first] == 2) * 12 + digit_bucket,
    }
    features = np.stack([values[x] + _OFFSETS[x] for x in FEATURES], axis=1).astype(np.int64)
    return Candidates([(s, e) for s, e, _ in tokens], first, last, features)


# ---- the model


def _grouped(c: Candidates) -> list[np.ndarray]:
    """The candidates that end before each token, by number."""
    order = np.argsort(c.last, kind="stable")
    cuts = np.searchsorted(c.last[order], np.arange(1, len(c.places) + 2))
    return [order[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


class SemiCRF:
    """Scores: the sum of a segment's feature weights for its kind; 0 for a token outside."""

    def __init__(self) -> None:
        self.weights = np.zeros((SIZE, len(KINDS)))

    def scores(self, c: Candidates) -> np.ndarray:
        return self.weights[c.features].sum(axis=1)

    def expected(self, c: Candidates) -> np.ndarray:
        """The probability of each candidate and kind, by forward and backward sums."""
        n, s = len(c.places), self.scores(c)
        ends = _grouped(c)
        forward = np.zeros(n + 1)
        for j in range(1, n + 1):
            e = ends[j - 1]
            terms = (forward[c.first[e]][:, None] + s[e]).ravel()
            forward[j] = np.logaddexp.reduce(np.append(terms, forward[j - 1]))
        backward = np.zeros(n + 1)
        order = np.argsort(c.first, kind="stable")
        cuts = np.searchsorted(c.first[order], np.arange(n + 1))
        for i in range(n - 1, -1, -1):
            e = order[cuts[i] : cuts[i + 1]]
            terms = (backward[c.last[e]][:, None] + s[e]).ravel()
            backward[i] = np.logaddexp.reduce(np.append(terms, backward[i + 1]))
        return np.exp(forward[c.first][:, None] + s + backward[c.last][:, None] - forward[n])

    def decode(self, c: Candidates, margin: float = MARGIN) -> list[tuple[int, int, int]]:
        """First token, token after the last, kind: the segmentation of the highest score,
        its segments of ``margin`` at least."""
        n, s = len(c.places), self.scores(c)
        best_kind = s.argmax(axis=1) if len(s) else np.zeros(0, np.int64)
        top = s.max(axis=1) if len(s) else np.zeros(0)
        ends = _grouped(c)
        score, back = np.zeros(n + 1), np.full(n + 1, -1)
        for j in range(1, n + 1):
            score[j] = score[j - 1]
            e = ends[j - 1]
            if len(e):
                totals = score[c.first[e]] + top[e]
                k = int(totals.argmax())
                if totals[k] > score[j]:
                    score[j], back[j] = totals[k], e[k]
        out, j = [], n
        while j > 0:
            if back[j] < 0:
                j -= 1
            else:
                k = back[j]
                if top[k] >= margin:
                    out.append((int(c.first[k]), int(c.last[k]), int(best_kind[k])))
                j = int(c.first[k])
        return out[::-1]


    def read(self, text: str, a: int, b: int, margin: float = MARGIN, step: int = STEP) -> list[Span]:
        """``decode`` of the zone from ``a`` to ``b`` as a whole, however long: candidates are
        made for ``step`` tokens' ends at a time and looked back from by ``LONGEST`` tokens at
        most, so scores go on over the steps; a few bytes a token are kept for the way back."""
        bounds = [m.start() for m in _TOKEN.finditer(text, a, b)] + [b]
        n = len(bounds) - 1
        score, top = np.zeros(n + 1), np.zeros(n + 1)
        size, kind = np.zeros(n + 1, np.int8), np.zeros(n + 1, np.int8)
        for at in range(0, n, step):
            low, high = max(0, at - LONGEST), min(n, at + step)
            c = candidates(text, bounds[low], bounds[high])
            s = self.scores(c)
            best, most = (s.argmax(axis=1), s.max(axis=1)) if len(s) else (s, s)
            ends = _grouped(c)
            for j in range(at + 1, high + 1):
                score[j] = score[j - 1]
                e = ends[j - low - 1]
                if len(e):
                    totals = score[c.first[e] + low] + most[e]
                    k = int(totals.argmax())
                    if totals[k] > score[j]:
                        k = e[k]
                        score[j], top[j], kind[j] = totals.max(), most[k], best[k]
                        size[j] = c.last[k] - c.first[k]
        out, j = [], n
        while j > 0:
            taken = int(size[j])
            if taken and top[j] >= margin:
                out.append((bounds[j - taken], bounds[j], KINDS[kind[j]]))
            j -= max(1, taken)
        return out[::-1]


def fit(examples: list[tuple[str, list[Span]]], rounds: int = 6, rate: float = 0.5) -> SemiCRF:
    """Maximum likelihood (with a small penalty) over short texts and their spans."""
    model, seen = SemiCRF(), np.full((SIZE, len(KINDS)), 1e-6)
    ready = []
    for text, spans in examples:
        c = candidates(text, 0, len(text))
        if not len(c.first):
            continue
        truth = np.zeros((len(c.first), len(KINDS)))
        want = {(a, b): KINDS.index(kind) for a, b, kind in spans}
        for k, (i, j) in enumerate(zip(c.first.tolist(), c.last.tolist(), strict=True)):
            if (kind := want.get((c.places[i][0], c.places[j - 1][1]))) is not None:
                truth[k, kind] = 1
        ready.append((c, truth))
    rng = random.Random(6)
    for _ in range(rounds):
        rng.shuffle(ready)
        for c, truth in ready:
            slope = truth - model.expected(c)
            change = np.zeros_like(model.weights)
            for slot in range(c.features.shape[1]):
                np.add.at(change, c.features[:, slot], slope)
            change -= 1e-4 * model.weights
            seen += change * change
            model.weights += rate * change / np.sqrt(seen)
    return model


# ---- examples


def _rewritten(kind: str, span: str, rng: random.Random) -> str:
    """The same datum in another usual form."""
    digits = _digits(span)
    if kind == "email":
        at, dot = rng.choice([("[at]", "."), (" [at] ", " [dot] "), ("(at)", "(dot)"), (" (at) ", ".")])
        local, _, host = span.partition("@")
        return local + at + host.replace(".", dot)
    if kind == "ip":
        return span.replace(".", rng.choice(["[.]", "(.)"]))
    if kind == "card":
        return rng.choice([".", "/", " - "]).join(digits[i : i + 4] for i in range(0, len(digits), 4))
    a, b, c = digits[-10:-7], digits[-7:-4], digits[-4:]
    return rng.choice([f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"({a}){b}-{c}", f"{a} {b} {c}"])


def _nothing(rng: random.Random) -> str:
    """A number that is no personal datum."""
    n = rng.randrange

    def run(k: int) -> str:
        return "".join(str(n(10)) for _ in range(k))

    failing = next(x for x in iter(lambda: run(16), None) if not luhn(x))
    return rng.choice(
        [
            f"{n(1900, 2100)}-{n(1, 13):02d}-{n(1, 29):02d}", f"{n(1, 29)}.{n(1, 13)}.{n(1900, 2100)}",
            f"{n(24)}:{n(60):02d}:{n(60):02d}", f"{n(10)}.{n(30)}.{n(30)}", f"{n(10)}.{n(999)}", run(n(4, 13)),
            f"{n(1, 999)},{n(1000):03d},{n(1000):03d}", run(n(20, 40)), failing, f"{n(1900, 2100)}-{n(1900, 2100)}",
            f"{n(300, 999)}.{n(300, 999)}.{n(300, 999)}.{n(300, 999)}", f"x{run(6)}y{run(5)}", f"@{rng.choice('abc')}{run(4)}",
            f"{n(1000, 9999)} {n(1000, 9999)}", f"{n(10, 99)} % {n(100, 999)} {n(100, 999)}", f"v{n(9)}.{n(9)}.{n(9)}.{n(9)}.{n(9)}",
        ]
    )


def examples_from(found: list[tuple[str, list[Span]]], seed: int = 1) -> list[tuple[str, list[Span]]]:
    """The zones as found, each span rewritten once, and as many with a mere number."""
    rng = random.Random(seed)
    out = []
    for text, spans in found:
        out.append((text, spans))
        for a, b, kind in spans:
            left, right = text[:a].rpartition(" ")[2], text[b:].partition(" ")[0]
            for datum, label in ((_rewritten(kind, text[a:b], rng), kind), (_nothing(rng), None)):
                head = rng.choice(["the", "und", "la", "of"]) + " " + left
                made = head + datum + right + " " + rng.choice(["and", "der", "que"])
                own = [(len(head), len(head) + len(datum), label)] if label else []
                out.append((made, own))
    return out


def learned(df: DataFrame, texts: int = SAMPLE_TEXTS, examples: int = SAMPLE_ZONES, id_col: str = "doc_id", text_col: str = "text") -> SemiCRF:
    """A model from a sample of ``df``: at most about ``texts`` rows are searched, and
    ``examples`` zones taken."""
    named = id_text(df, id_col, text_col)
    total = named.count()
    draw = F.pmod(F.xxhash64("doc_id", F.lit("pii")), F.lit(1 << 20)) / (1 << 20)
    sample = named.where(draw < min(1.0, texts / max(1, total)))
    schema = "zone string, starts array<int>, ends array<int>, kinds string, rank long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches):
            out: dict[str, list] = {x: [] for x in ("zone", "starts", "ends", "kinds", "rank")}
            kept = np.flatnonzero(_suspects(b.column(1)))
            for text in b.column(1).take(pa.array(kept)).to_pylist():
                base = found_in(text)
                for s, e in zones(text, base, all_=True):
                    if e - s > 400:
                        continue
                    inside = [x for x in base if s <= x[0] and x[1] <= e]
                    out["zone"].append(text[s:e])
                    out["starts"].append([x[0] - s for x in inside])
                    out["ends"].append([x[1] - s for x in inside])
                    out["kinds"].append(",".join(x[2] for x in inside))
                    out["rank"].append(int.from_bytes(hashlib.sha256(text[s:e].encode()).digest()[:7]))
            yield rows(schema, out)

    picked = sample.mapInArrow(run, schema).orderBy("rank", "zone").limit(examples).collect()
    found = [
        (r.zone, list(zip(r.starts, r.ends, r.kinds.split(","), strict=True)) if r.kinds else []) for r in picked
    ]
    return fit(examples_from(found))


# ---- the operator


def _suspects(column: pa.Array) -> np.ndarray:
    """Which texts hold a digit, an at sign or an opening bracket before a spelled-out one."""
    raw, offsets = string_bytes(column)
    out = np.zeros(len(column), dtype=bool)
    hit = (raw - np.uint8(ord("0")) < 10) | (raw == ord("@"))
    bracket = np.flatnonzero((raw[:-1] == ord("[")) | (raw[:-1] == ord("(")) | (raw[:-1] == ord("{")))
    hit[bracket[np.isin(raw[bracket + 1], np.frombuffer(b"aAdD.", np.uint8))]] = True
    out[np.searchsorted(offsets, np.flatnonzero(hit), "right") - 1] = True
    return out


def scan(text: str, model: SemiCRF) -> tuple[list[Span], list[Span]]:
    """The spans of the patterns, and those with what the model adds (clear of them)."""
    base = found_in(text)
    added = []
    for a, b in zones(text, base):
        added += model.read(text, a, b)
    if added:
        starts = sorted((a, b) for a, b, _ in base)
        left = np.array([a for a, _ in starts], dtype=np.int64)
        reach = np.maximum.accumulate(np.array([b for _, b in starts], dtype=np.int64))
        clear, end = [], -1
        for span in in_order(added):
            k = int(np.searchsorted(left, span[1])) - 1
            if (k < 0 or reach[k] <= span[0]) and span[0] >= end:
                clear.append(span)
                end = span[1]
        return base, in_order(base + clear)
    return base, base


def listed(spans: list[Span]) -> str:
    return ",".join([f"{kind}:{a}:{b}" for a, b, kind in spans])


def personal_data(df: DataFrame, shared: Broadcast, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the patterns' spans by kind and a digest of them, and all spans.

    ``shared``: a broadcast model (a weight a feature and kind)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches):
            texts, suspects = b.column(1).to_pylist(), _suspects(b.column(1)).tolist()
            found = [scan(t, shared.value) if s else ([], []) for t, s in zip(texts, suspects, strict=True)]
            out: dict = {"doc_id": b.column(0), "spans": [listed(all_) for _, all_ in found]}
            for kind in KINDS:
                out[f"n_{kind}"] = [sum(s[2] == kind for s in base) for base, _ in found]
            out["base_sha256"] = [hashlib.sha256(listed(base).encode()).hexdigest() for base, _ in found]
            yield rows(SCHEMA, out)

    return id_text(df, id_col, text_col).mapInArrow(run, SCHEMA)
