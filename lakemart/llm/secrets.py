"""Operator 7: secrets, also inside nested encodings.

Every text is scanned for three kinds of secret. Then a worklist of layers, at first
the text itself, is worked off: URL escapes and Unicode escapes are undone all over a
layer, base64 runs are decoded one by one, and what any of them decodes to compressed data
(gzip, zlib, bzip2, xz) is unpacked: all streams that follow one another, a broken or
cut-off one as far as it goes, and streams in streams until one comes again. A base64 run
that is no text as a whole is also tried from each ``/``, ``-``, ``_`` and ``+`` on, as
behind a path. Each new layer is scanned and listed in turn, unless the
same text came from the same places before, until none is left. A finding is mapped back,
layer by layer, to the code points of the text that it came from; a text that stands
encoded at several places has its findings at each of them.

Null text counts as empty. Spans found twice are named once. Repeated rows get the same
answer each; an empty table gives an empty table; other columns are ignored. Texts are
scanned whole. A stream of over ``UNPACKED`` bytes is scanned in pieces of that size, each
beginning with the last ``OVERLAP`` bytes of the one before: what is encoded there in more
bytes than that may be read in two parts.
"""

from __future__ import annotations

import base64
import bz2
import hashlib
import lzma
import re
import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import blocks, id_text, rows, string_bytes

KINDS = ("assign", "access", "hex")
UNPACKED = 8 << 20
OVERLAP = 1 << 20
#: Bytes of a compressed stream that are unpacked at a time.
_FED = 1 << 16
SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"

# The patterns of the three kinds.
_ASSIGN = re.compile(
    r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]+")
_KEYWORDS = ("passw", "secret", "token", "api")

_URL = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_UNICODE = re.compile(r"(?:\\u[0-9A-Fa-f]{4}|\\u\{[0-9A-Fa-f]{1,6}\}|\\U[0-9A-Fa-f]{8}|\\x[0-9A-Fa-f]{2})+")
_ONE_UNICODE = re.compile(r"\\(?:u\{([0-9A-Fa-f]+)\}|u([0-9A-Fa-f]{4})|U([0-9A-Fa-f]{8})|x([0-9A-Fa-f]{2}))")
#: One run, or lines of one length each as in mail.
_BASE64 = re.compile(r"(?:[A-Za-z0-9+/_-]{60,76}\r?\n)*[A-Za-z0-9+/_-]{16,}={0,2}")
_MIXED = re.compile(r"[A-Z0-9]")
#: Letters of base64 that may end what a run is glued to, and text in decoded bytes of a
#: size that can hold a finding.
_GLUE = re.compile(r"[+/_-]+")
_TEXT = re.compile(rb"[\t\r\n\x20-\x7e\x80-\xff]{12,}")
#: Escapes of bytes that stand between letters left as they are.
_URL_BYTES = re.compile(r"%[0-9A-Fa-f]{2}(?:%[0-9A-Fa-f]{2}|[!-$&-~])+")
_HEX_BYTES = re.compile(r"\\x[0-9A-Fa-f]{2}(?:\\x[0-9A-Fa-f]{2}|[!-\[\]-~])+")
_MAGIC = (b"\x1f\x8b", b"\x78\x01", b"\x78\x5e", b"\x78\x9c", b"\x78\xda", b"BZh", b"\xfd7zXZ\x00")

Span = tuple[int, int, str]


def found_in(text: str) -> list[Span]:
    """(start, end, kind) of the secrets that stand openly in a text, in order."""
    out: list[Span] = []
    low = text.lower()
    if any(word in low for word in _KEYWORDS):
        out += [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text) if len(m[0]) >= 20]
    out += [(m.start(), m.end(), "hex") for m in _HEX.finditer(text) if m.end() - m.start() >= 24]
    return in_order(out)


def in_order(spans: list[Span]) -> list[Span]:
    return sorted(set(spans), key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


class Layer:
    """A decoded text; ``start`` and ``end`` say for each of its code points which part of
    the document it came from."""

    def __init__(self, text: str, start: np.ndarray, end: np.ndarray):
        self.text, self.start, self.end = text, start, end

    @classmethod
    def of(cls, text: str) -> Layer:
        at = np.arange(len(text))
        return cls(text, at, at + 1)

    def mapped(self, span: Span) -> Span:
        # the parts need not ascend within a mapped run
        a, b, kind = span
        return int(self.start[a:b].min()), int(self.end[a:b].max()), kind

    def key(self) -> tuple[str, bytes]:
        """Alike for layers of one text that came from the same places."""
        places = hashlib.blake2b(self.start.astype(np.int64).tobytes(), digest_size=16)
        places.update(self.end.astype(np.int64).tobytes())
        return self.text, places.digest()


def _from_bytes(data: bytes, a: np.ndarray, b: np.ndarray, latin: bool = False) -> Layer | None:
    """A layer of UTF-8 bytes that came from the parts ``a`` to ``b``, if they are text;
    on request of Latin-1 bytes, where they are no UTF-8."""
    try:
        text = data.decode()
    except UnicodeDecodeError:
        return Layer(data.decode("latin-1"), a, b) if latin else None
    if latin and text.isascii():
        return Layer(text, a, b)
    if not text or sum(c.isprintable() or c in "\t\r\n" for c in text) < 0.9 * len(text):
        return None
    sizes = np.fromiter((len(c.encode()) for c in text), np.int64, len(text))
    ends = np.cumsum(sizes)
    return Layer(text, a[ends - sizes], b[ends - 1])


def _unescaped(layer: Layer, pattern: re.Pattern, decode) -> Layer | None:
    """The whole layer with each match of ``pattern`` replaced by what it decodes to."""
    parts, starts, ends, at = [], [], [], 0
    for m in pattern.finditer(layer.text):
        got = decode(m[0])
        if got is None:
            continue
        text, left, right = got
        parts += [layer.text[at : m.start()], text]
        starts += [layer.start[at : m.start()], layer.start[m.start() + left]]
        ends += [layer.end[at : m.start()], layer.end[m.start() + right - 1]]
        at = m.end()
    if not parts:
        return None
    parts.append(layer.text[at:])
    starts.append(layer.start[at:])
    ends.append(layer.end[at:])
    return Layer("".join(parts), np.concatenate(starts), np.concatenate(ends))


def _url(run: str) -> tuple[str, np.ndarray, np.ndarray] | None:
    data = bytes.fromhex(run.replace("%", ""))
    at = np.arange(len(data)) * 3
    got = _from_bytes(data, at, at + 3, latin=True)
    return got and (got.text, got.start, got.end)


def _unicode(run: str) -> tuple[str, np.ndarray, np.ndarray] | None:
    units, left, right = [], [], []
    for m in _ONE_UNICODE.finditer(run):
        code = int(m[1] or m[2] or m[3] or m[4], 16)
        if code > 0x10FFFF:
            return None
        if units and 0xDC00 <= code < 0xE000 and 0xD800 <= units[-1] < 0xDC00:
            units[-1] = 0x10000 + (units[-1] - 0xD800 << 10) + code - 0xDC00
            right[-1] = m.end()
            continue
        units.append(code)
        left.append(m.start())
        right.append(m.end())
    if any(0xD800 <= c < 0xE000 for c in units):
        return None
    return "".join(map(chr, units)), np.array(left), np.array(right)


def _members(data: bytes) -> Iterator[bytes]:
    """What the compressed streams at the start of ``data`` hold, bit by bit; it ends where
    no further stream follows, or one breaks off."""
    at = 0
    while data.startswith(_MAGIC, at):
        began, zipped = at, data[at] in (0x1F, 0x78)
        if zipped:
            stream = zlib.decompressobj(47)
        else:
            stream = bz2.BZ2Decompressor() if data.startswith(b"BZh", at) else lzma.LZMADecompressor()
        try:
            while not stream.eof:
                chunk = stream.unconsumed_tail if zipped else b""
                if not chunk and (zipped or stream.needs_input):
                    chunk = data[at : at + _FED]
                    at += len(chunk)
                    if not chunk:
                        yield stream.flush() if zipped else b""
                        return
                yield stream.decompress(chunk, _FED)
        except (zlib.error, OSError, EOFError, lzma.LZMAError):
            return
        at -= len(stream.unused_data)
        if at <= began:
            return


def _unpacked(data: bytes) -> Iterator[bytes]:
    """What compressed data holds, in pieces of ``UNPACKED`` bytes that overlap."""
    held = bytearray()
    for part in _members(data):
        held += part
        if len(held) >= UNPACKED:
            yield bytes(held)
            del held[: -min(OVERLAP, UNPACKED // 8)]
    if held:
        yield bytes(held)


def _opened(data: bytes) -> Iterator[bytes]:
    """The innermost contents of compressed data: what is no stream itself. Contents met
    before, as in a stream that unpacks to itself, are not opened again."""
    work, seen = [data], set()
    while work:
        for piece in _unpacked(work.pop()):
            digest = hashlib.blake2b(piece, digest_size=16).digest()
            if digest in seen:
                continue
            seen.add(digest)
            if piece.startswith(_MAGIC):
                work.append(piece)
            else:
                yield piece


def _contents(data: bytes, place: Span) -> Iterator[Layer]:
    """Layers of compressed data's contents, which all stand at one place."""
    for inner in _opened(data):
        size = len(inner)
        if got := _from_bytes(inner, np.full(size, place[0]), np.full(size, place[1])):
            yield got


def _decoded(body: str) -> bytes:
    """The bytes of base64 letters; a last letter on its own holds none."""
    body = body[: len(body) - (len(body) % 4 == 1)]
    return base64.b64decode(body + "=" * (-len(body) % 4))


def _base64(layer: Layer) -> Iterator[Layer]:
    for m in _BASE64.finditer(layer.text):
        run = m[0]
        if not _MIXED.search(run):
            continue  # a word: no letters of a keyword or of a stream's head are all small
        kept = np.array([i for i, c in enumerate(run) if c not in "=\r\n"])
        body = "".join(run.splitlines()).rstrip("=").replace("-", "+").replace("_", "/")
        place = layer.mapped((m.start(), m.end(), ""))

        def parts(data: bytes, skipped: int, body_size: int = len(body), kept: np.ndarray = kept, begin: int = m.start()):
            # byte k holds bits of the letters 4k/3 and the one after it
            at = np.arange(len(data))
            left, right = skipped + at * 4 // 3, np.minimum(skipped + at * 4 // 3 + 1, body_size - 1)
            return data, layer.start[begin + kept[left]], layer.end[begin + kept[right]]

        data = _decoded(body)
        if data.startswith(_MAGIC):
            yield from _contents(data, place)
            continue
        if len(body) % 4 != 1 and (got := _from_bytes(*parts(data, 0))):
            yield got
            continue
        # glued to something: each alignment is decoded once, and read from where a part begins
        aligned: dict[int, bytes] = {}
        read_to = {a: 0 for a in range(4)}
        for glue in _GLUE.finditer(body):
            for begin in range(glue.start() + 1, glue.end() + 1):
                a = begin % 4
                if len(body) - begin < 16:
                    continue
                if a not in aligned:
                    aligned[a] = _decoded(body[a:])
                at = (begin - a) // 4 * 3
                if aligned[a].startswith(_MAGIC, at):
                    yield from _contents(aligned[a][at:], place)
                elif at >= read_to[a] and (text := _TEXT.match(aligned[a], at)):
                    read_to[a] = text.end()
                    whole = text[0].decode(errors="ignore").encode()
                    if whole and text[0].startswith(whole) and (got := _from_bytes(*parts(whole, begin))):
                        yield got


def _escaped_bytes(layer: Layer) -> Iterator[Layer]:
    """Layers of compressed data that stands as escaped bytes."""
    for pattern, sign in ((_URL_BYTES, "%"), (_HEX_BYTES, "\\x")):
        if sign in layer.text:
            for m in pattern.finditer(layer.text):
                data = re.sub(
                    rf"{re.escape(sign)}([0-9A-Fa-f]{{2}})".encode(), lambda x: bytes([int(x[1], 16)]), m[0].encode()
                )
                if data.startswith(_MAGIC):
                    yield from _contents(data, layer.mapped((m.start(), m.end(), "")))


def unwrapped(layer: Layer) -> Iterator[Layer]:
    """The layers right inside a layer."""
    if "%" in layer.text and (got := _unescaped(layer, _URL, _url)):
        yield got
    if "\\" in layer.text and (got := _unescaped(layer, _UNICODE, _unicode)):
        yield got
    yield from _escaped_bytes(layer)
    yield from _base64(layer)


def scan(text: str) -> tuple[list[Span], list[Span]]:
    """The secrets that stand openly in the text, and those of all layers with them."""
    base, whole = found_in(text), Layer.of(text)
    spans, seen, found, work = [*base], {whole.key()}, {text: base}, deque([whole])
    while work:
        for inner in unwrapped(work.popleft()):
            if (key := inner.key()) in seen:
                continue
            seen.add(key)
            if inner.text not in found:
                found[inner.text] = found_in(inner.text)
            spans += [inner.mapped(s) for s in found[inner.text]]
            work.append(inner)
    return base, in_order(spans)


def _class(letters: bytes) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[np.frombuffer(letters, dtype=np.uint8)] = True
    return out


_DIGITS, _LOWER, _UPPER = b"0123456789", bytes(range(97, 123)), bytes(range(65, 91))
_CODE, _INNER = _class(_DIGITS + _LOWER + _UPPER + b"+/_-"), _class(_DIGITS + _UPPER)
_HEXES = _class(_DIGITS + b"abcdef")


def _runs(member: np.ndarray, first: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the runs of members within a text; ``first``: where texts begin,
    and one place more."""
    starts = member.copy()
    starts[1:] &= ~member[:-1] | first[1:-1]
    ends = member.copy()
    ends[:-1] &= ~member[1:] | first[1:-1]
    start, end = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    long = end - start >= least
    return start[long], end[long]


def suspects(column: pa.Array) -> np.ndarray:
    """Which texts can hold a finding that needs more than a keyword: an escape, a long run
    of hexadecimal digits, or one of base64 letters with capitals or digits within."""
    raw, offsets = string_bytes(column)
    out = np.zeros(len(column), dtype=bool)
    if not len(raw):
        return out
    first = np.zeros(len(raw) + 1, dtype=bool)
    first[offsets] = True
    start, end = _runs(_CODE[raw], first, 16)
    inner = np.concatenate([[0], np.cumsum(_INNER[raw])])
    percent = np.flatnonzero(raw[:-2] == ord("%"))
    either = _HEXES | _class(b"ABCDEF")
    places = [
        start[inner[end] > inner[start]],
        _runs(_HEXES[raw], first, 24)[0],
        np.flatnonzero(raw == ord("\\")),
        percent[either[raw[percent + 1]] & either[raw[percent + 2]]],
    ]
    out[np.searchsorted(offsets, np.concatenate(places), "right") - 1] = True
    return out


def scanned(column: pa.Array) -> Iterator[tuple[list[Span], list[Span]]]:
    for text, suspect in zip(column.to_pylist(), suspects(column).tolist(), strict=True):
        if not suspect:
            low = text.lower()
            suspect = "AKIA" in text or any(word in low for word in _KEYWORDS)
        yield scan(text) if suspect else ([], [])


def listed(spans: list[Span]) -> str:
    return ",".join([f"{kind}:{a}:{b}" for a, b, kind in spans])


def secrets(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the open secrets by kind, a digest of their spans, and all spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches):
            found = [*scanned(b.column(1))]
            out: dict = {"doc_id": b.column(0), "spans": [listed(all_) for _, all_ in found]}
            for kind in KINDS:
                out[f"n_{kind}"] = [sum(s[2] == kind for s in base) for base, _ in found]
            out["base_sha256"] = [hashlib.sha256(listed(base).encode()).hexdigest() for base, _ in found]
            yield rows(SCHEMA, out)

    return id_text(df, id_col, text_col).mapInArrow(run, SCHEMA)


def masked(text: str, spans: list[Span], mask: str) -> str:
    parts, at = [], 0
    for a, b, _ in spans:
        if a >= at:
            parts += [text[at:a], mask]
        at = max(at, b)
    return "".join([*parts, text[at:]])


def redacted(df: DataFrame, text_col: str = "text", mask: str = "[SECRET]") -> DataFrame:
    """``df`` with every secret, however wrapped, replaced by ``mask`` (overlapping ones by
    one mask). Null texts stay null."""
    schema, at = df.schema, df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches, text=text_col):
            column = b.column(at)
            filled = column.fill_null("")
            texts = [
                masked(t, spans, mask) if spans else t
                for t, (_, spans) in zip(filled.to_pylist(), scanned(filled), strict=True)
            ]
            texts = [None if null else t for t, null in zip(texts, column.is_null().to_pylist(), strict=True)]
            yield b.set_column(at, b.schema.field(at), pa.array(texts, column.type))

    return df.mapInArrow(run, schema)
