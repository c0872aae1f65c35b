"""Operator 3: byte-level BPE by a sentencepiece model made from a rank file.

The ranks become a sentencepiece BPE model without any training: every token is
a piece whose bytes are written as one printable character each, scored by its
negative rank, under an identity normaliser. Each pre-token (a match of the
pattern) is encoded on its own; ids go back to bytes by the inverse mapping.

Null text counts as empty (no tokens, digests of the empty string); repeated rows
are encoded each on its own; an empty table gives an empty table; other columns
of the input are ignored. Texts are taken whole, however long.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import Remembered, acyclic, blocks, id_text, rows

SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
#: Pieces of text whose ids a worker remembers in a generation; there are two.
REMEMBERED = 250_000


@lru_cache(1)
def byte_letters() -> list[str]:
    """A printable character for each byte: itself where printable, else from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


def read_ranks(path: str) -> list[bytes]:
    """The tokens of a rank file, by rank."""
    with open(path, "rb") as lines:
        found = {int(r): base64.b64decode(t) for t, r in (x.split() for x in lines if x.strip())}
    return [found[r] for r in sorted(found)]


def _field(number: int, payload: bytes) -> bytes:
    size, out = len(payload), bytearray([number << 3 | 2])
    while size > 0x7F:
        out.append(size & 0x7F | 0x80)
        size >>= 7
    return bytes(out) + bytes([size]) + payload


def model_proto(tokens: list[bytes]) -> bytes:
    """A serialised sentencepiece ModelProto (type BPE) whose piece r is token r.

    Fields by number: ModelProto 1 pieces, 2 trainer_spec, 3 normalizer_spec; a
    piece has 1 text, 2 score (float), 3 type (1 normal, 2 unknown)."""
    letters = byte_letters()
    out = bytearray()
    for rank, token in enumerate(tokens):
        text = "".join(letters[b] for b in token).encode()
        out += _field(1, _field(1, text) + struct.pack("<Bf", 0x15, -float(rank)) + b"\x18\x01")
    out += _field(1, _field(1, b"<unk>") + struct.pack("<Bf", 0x15, 0.0) + b"\x18\x02")
    n = len(tokens)
    unk = bytes([n & 0x7F | 0x80, n >> 7 & 0x7F | 0x80, n >> 14])
    # trainer_spec: 3 model_type = BPE (2), 40 unk_id; 41, 42, 43 (bos, eos, pad) = -1
    off = b"\xff" * 9 + b"\x01"
    trainer = b"\x18\x02" + b"\xc0\x02" + unk + b"".join(bytes([k, 2]) + off for k in (0xC8, 0xD0, 0xD8))
    # normalizer_spec: 1 name, 3 add_dummy_prefix, 4 remove_extra_whitespaces, 5 escape_whitespaces
    normal = _field(1, b"identity") + b"\x18\x00\x20\x00\x28\x00"
    return bytes(out + _field(2, trainer) + _field(3, normal))


class Codec:
    def __init__(self, ranks_path: str, pattern: str):
        import regex
        import sentencepiece

        self.tokens = read_ranks(ranks_path)
        self.rank = {t: r for r, t in enumerate(self.tokens)}
        self.texts = [str(r) for r in range(len(self.tokens))]
        self.letters = byte_letters()
        self.matches = regex.compile(pattern).findall
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model_proto(self.tokens))
        self.known = Remembered(REMEMBERED)

    def learn(self, pieces: set[str]) -> dict[str, tuple[int, ...]]:
        """The ids of pieces of text, these among others. What isn't remembered is encoded
        pre-token by pre-token: a whole token is its own id, the rest goes through the
        model."""
        new = self.known.lacking(pieces)
        known, rank, letters, rest, parts = self.known.young, self.rank, self.letters, [], []
        for piece in new:
            if (whole := rank.get(piece.encode())) is not None and len(self.matches(piece)) == 1:
                known[piece] = (whole,)
                continue
            ids: list = []
            for word in self.matches(piece):
                raw = word.encode()
                if (whole := rank.get(raw)) is None:
                    parts.append("".join([letters[b] for b in raw]))
                    ids.append(None)
                else:
                    ids.append(whole)
            rest.append((piece, ids))
        found = iter(self.model.encode(parts, num_threads=1) if parts else ())
        for piece, ids in rest:
            known[piece] = tuple(
                chain.from_iterable([next(found) if i is None else (i,) for i in ids])
            )
        return known

    def encode(self, texts: list[str]) -> list[list[int]]:
        """The ids of each text. A match never holds a space but at its start, unless
        spaces follow each other or end the text; other texts are therefore cut at
        their spaces, and the pieces remembered."""
        split = [
            self.matches(t)
            if "  " in t or t[-1:] == " " or "\0" in t
            else t.replace(" ", "\0 ").split("\0")
            for t in texts
        ]
        known = self.learn(set().union(*split))
        return [list(chain.from_iterable([known[w] for w in words])) for words in split]

    def decode(self, ids: list[int]) -> bytes:
        tokens = self.tokens
        return b"".join([tokens[i] for i in ids])


@lru_cache(2)
def codec(ranks_path: str, pattern: str) -> Codec:
    return Codec(ranks_path, pattern)


def encoded(
    df: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, ids (array of int) and decoded (binary) of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(ranks_path, pattern)
        schema = "doc_id long, ids array<int>, decoded binary"
        with acyclic():
            for b in blocks(batches):
                ids = c.encode(b.column(1).to_pylist())
                yield rows(schema, {"doc_id": b.column(0), "ids": ids, "decoded": [c.decode(x) for x in ids]})

    return id_text(df, id_col, text_col).mapInArrow(
        run, "doc_id long, ids array<int>, decoded binary"
    )


def digests(
    df: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_tokens and the digests of the ids and of the decoded bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(ranks_path, pattern)
        texts = c.texts
        with acyclic():
            for b in blocks(batches):
                ids = c.encode(b.column(1).to_pylist())
                yield rows(
                    SCHEMA,
                    {
                        "doc_id": b.column(0),
                        "n_tokens": [len(x) for x in ids],
                        "ids_sha256": [
                            hashlib.sha256(",".join([texts[i] for i in x]).encode()).hexdigest()
                            for x in ids
                        ],
                        "decoded_sha256": [hashlib.sha256(c.decode(x)).hexdigest() for x in ids],
                    },
                )

    return id_text(df, id_col, text_col).mapInArrow(run, SCHEMA)
