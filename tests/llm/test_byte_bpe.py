from __future__ import annotations

import base64
import hashlib
from collections import Counter

import public_tokenizers
import tiktoken

from lakemart.llm import byte_bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def reference():
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, lines)}
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def test_digests_match_tiktoken(docs, doc_rows):
    enc = reference()
    want = Counter()
    for i, text in doc_rows:
        ids = enc.encode_ordinary(text or "")
        want[
            i,
            len(ids),
            hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256((text or "").encode()).hexdigest(),
        ] += 1
    got = byte_bpe.digests(docs, PATH, public_tokenizers.PATTERN).collect()
    assert Counter(tuple(r) for r in got) == want


def test_round_trip_and_spaces():
    codec, enc = byte_bpe.Codec(PATH, public_tokenizers.PATTERN), reference()
    for text in ["x\n y", "a   b", "a \n b", " \n  y", "\n ", " a", "a　 b", "\x00 \x00", " ", "'s 's  's"]:
        ids = codec.encode([text])[0]
        assert ids == enc.encode_ordinary(text), text
        assert codec.decode(ids) == text.encode()


def test_memory_of_words_starts_afresh(monkeypatch):
    monkeypatch.setattr(byte_bpe, "REMEMBERED", 3)
    codec, enc = byte_bpe.Codec(PATH, public_tokenizers.PATTERN), reference()
    for text in ["one two three four five six", "seven eight one two", "one"]:
        assert codec.encode([text])[0] == enc.encode_ordinary(text)


def test_empty_table(spark, docs):
    assert byte_bpe.digests(docs.limit(0), PATH, public_tokenizers.PATTERN).count() == 0
    assert byte_bpe.encoded(docs.limit(0), PATH, public_tokenizers.PATTERN).count() == 0
