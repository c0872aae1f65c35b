from __future__ import annotations

import base64
import bz2
import gzip
import hashlib
import lzma
import random
import re
import zlib
from urllib.parse import quote

import pytest

from lakemart.llm import secrets

KEY = "AKIA" + "Q7" * 8
HEX = "0123456789abcdef01234567"


def plain(text):
    """The patterns as stated, one by one."""
    out = []
    word = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token", "api_?key"))
    word = word.replace("_?", "_?")
    for m in re.finditer(rf"""({word})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[2]) >= 6:
            out.append((m.start(), 0, m.end(), "assign"))
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end(), "hex") for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return [(a, b, k) for a, _, b, k in sorted(out)]


def b64(data):
    return base64.b64encode(data).decode()


WRAPS = {
    "url": lambda s: "".join(f"%{b:02X}" for b in s.encode()),
    "unicode": lambda s: "".join(f"\\u{ord(c):04x}" for c in s),
    "base64": lambda s: b64(s.encode()),
    "urlsafe": lambda s: base64.urlsafe_b64encode(s.encode()).decode().rstrip("="),
    "gzip": lambda s: b64(gzip.compress(s.encode())),
    "zlib": lambda s: b64(zlib.compress(s.encode())),
    "bz2": lambda s: b64(bz2.compress(s.encode())),
    "xz": lambda s: b64(lzma.compress(s.encode())),
    "twice": lambda s: b64(gzip.compress(zlib.compress(s.encode()))),
}


def test_base_patterns():
    rng = random.Random(1)
    parts = ["token", "Token", "API_KEY", "apikey", "ſecret", "secret", "passwd", "password", "=", ":", " ", '"', "'", "abc", "abcdef12", "AKIA", KEY, HEX, "f" * 23, "é", "\n", "toKen", "-", "."]
    for _ in range(4000):
        text = "".join(rng.choices(parts, k=rng.randint(0, 12)))
        assert secrets.found_in(text) == plain(text), text


@pytest.mark.parametrize("wrap", WRAPS)
@pytest.mark.parametrize("inner", ["url", "base64", None])
def test_nested_layers_map_back(wrap, inner):
    secret = "the token = " + HEX + "9"
    body = WRAPS[wrap](WRAPS[inner](secret) if inner else secret)
    text = "é before " + body + " after"
    base, spans = secrets.scan(text)
    kinds = {k for _, _, k in spans}
    assert {"assign", "hex"} <= kinds
    for a, b, _ in spans:
        assert 9 <= a < b <= 9 + len(body)
    if wrap in ("url", "unicode") and inner is None:
        a, b, _ = next(s for s in spans if s[2] == "hex")
        one = len(body) // len(secret)
        assert (a - 9, b - 9) == (12 * one, len(secret) * one)


def test_lines_of_base64_and_clean_text():
    raw = ("x" * 70 + " password=" + "Zz9" * 5 + " ") * 3
    text = "a\n" + base64.encodebytes(raw.encode()).decode() + "b"
    assert len([s for s in secrets.scan(text)[1] if s[2] == "assign"]) == 3
    for clean in ("100%% sure %%% $$$", "Internationalisierungen sind lang", "path\\name \\u12", "%zz %4", ""):
        assert secrets.scan(clean) == ([], [])


def test_cycles_and_bombs(monkeypatch):
    assert secrets.scan("%2525252525")[1] == []
    monkeypatch.setattr(secrets, "UNPACKED", 1000)
    bomb = b64(gzip.compress(b"password=abcdefgh " * 1000))  # scanned in pieces
    assert secrets.scan(bomb)[1] == [(0, len(bomb), "assign")]


def rows_of(doc_rows):
    rng = random.Random(7)
    out = list(doc_rows)
    for k in range(80):
        words = ["word", "tokens", "Thing"] * rng.randint(0, 20) + [rng.choice([KEY, HEX, "secret: abcdef", "ok", quote("api_key=" + HEX, safe=""), WRAPS["gzip"]("token=abcdefg")])]
        rng.shuffle(words)
        out.append((900 + k, " ".join(words)))
    out += [(2000, HEX[:12]), (2001, HEX[12:] + " "), (2002, "AAAAAAAA"), (2003, "B2345678")]
    return out


def test_query_matches_a_scan_of_every_text(spark, doc_rows):
    data = rows_of(doc_rows)
    df = spark.createDataFrame([(i, t, None) for i, t in data], "doc_id long, text string, spans string")
    got = sorted((tuple(r) for r in secrets.secrets(df).collect()), key=repr)
    want = []
    for i, t in data:
        base, spans = plain(t or ""), secrets.scan(t or "")[1]
        line = ",".join(f"{k}:{a}:{b}" for a, b, k in base)
        counts = [sum(s[2] == k for s in base) for k in secrets.KINDS]
        want.append((i, *counts, hashlib.sha256(line.encode()).hexdigest(), secrets.listed(spans)))
        assert set(base) <= set(spans)
    assert got == sorted(want, key=repr)


def test_redacted(spark, docs, doc_rows):
    df = spark.createDataFrame(rows_of(doc_rows), "doc_id long, text string")
    for r in secrets.redacted(df).collect():
        assert r.text is None or secrets.scan(r.text)[0] == []
    assert secrets.masked("ab cd", [(0, 2, "x"), (1, 2, "y")], "*") == "* cd"
    same = {r.doc_id: r.text for r in secrets.redacted(docs).collect()}
    assert same == {r.doc_id: r.text for r in docs.collect()}
    assert secrets.secrets(docs.limit(0)).count() == 0


@pytest.mark.parametrize("times", [2, 1000])
@pytest.mark.parametrize("wrap", ["base64", "gzip", "twice"])
def test_every_occurrence_of_an_encoded_secret(wrap, times):
    line = "key: " + WRAPS[wrap]("the token = " + HEX + "9") + " end\n"
    text = line * times
    spans = secrets.scan(text)[1]
    assert len({a // len(line) for a, _, k in spans if k == "assign"}) == times
    assert secrets.scan(secrets.masked(text, spans, "[SECRET]"))[1] == []


def test_wrappings_that_decode_alike():
    secret = "password=" + HEX
    text = " | ".join(WRAPS[w](secret) for w in ("base64", "gzip", "zlib", "xz", "url", "base64"))
    spans = secrets.scan(text)[1]
    assert len([s for s in spans if s[2] == "assign"]) == 6
    assert secrets.scan(secrets.masked(text, spans, "[SECRET]"))[1] == []


SECRET = b"here is token=abcdef123456 ok"


@pytest.mark.parametrize(
    "text, span",
    [
        ("https://h/path/" + b64(SECRET), None),
        ("key-" + b64(SECRET), None),
        ("a_b/" + b64(gzip.compress(SECRET)), None),
        ("bmc/dG9rZW49YWJjZGVmMTI=", (4, 23)),
        ("%E9t%E9%20" + WRAPS["url"]("token=abcdef12"), None),
        (b64(gzip.compress(b"hello") + gzip.compress(SECRET)), None),
        (b64(zlib.compress(SECRET * 50)[:-8]), None),
        (b64(bz2.compress(b"x" * 9) + bz2.compress(SECRET)), None),
        (quote(gzip.compress(SECRET)), None),
        ("".join(f"\\x{b:02x}" for b in zlib.compress(SECRET)), None),
        (b64(gzip.compress(bz2.compress(lzma.compress(SECRET)))), None),
    ],
)
def test_glued_cut_and_joined(text, span):
    """Behind a path, in a second or a cut-off stream, in bytes that are escaped."""
    found = secrets.scan(f"so {text} is")[1]
    assert [k for *_, k in found] == ["assign"], found
    a, b, _ = found[0]
    assert 3 <= a < b <= 3 + len(text)
    if span:
        assert (a - 3, b - 3) == span


def test_stream_that_unpacks_to_itself(monkeypatch):
    data = gzip.compress(b"a")
    monkeypatch.setattr(secrets, "_members", lambda d: iter([d]))
    assert list(secrets._opened(data)) == []
    assert secrets.scan(b64(data))[1] == []


def test_large_streams_in_pieces(monkeypatch):
    monkeypatch.setattr(secrets, "UNPACKED", 1000)
    monkeypatch.setattr(secrets, "OVERLAP", 100)
    rng = random.Random(2)
    for at in (10, 950, 995, 1895, 5000):
        filler = "".join(rng.choices("xyz .", k=6000))
        text = filler[:at] + " secret=hunter2x " + filler[at:]
        assert [k for *_, k in secrets.scan(b64(gzip.compress(text.encode())))[1]] == ["assign"], at
