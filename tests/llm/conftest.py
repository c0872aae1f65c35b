from __future__ import annotations

import random

import pytest

#: (doc_id, text): nulls, empty and very long texts, ties, repeated rows, odd characters.
ODD = [
    (1, None),
    (2, ""),
    (3, "   "),
    (4, "a"),
    (5, "Hello world, this is a test. Hello world, this is a test."),
    (6, "Hello world, this is a test. Hello world, this is a test."),
    (6, "Hello world, this is a test. Hello world, this is a test."),
    (7, "é ü ñ 你好 \U0001f600 \x00 \x1c x y z　 á  double  space \n\n end "),
    (8, "word " * 5000),
    (9, "你好" * 50),
    (10, "don't I'll we've <|endoftext|> <unk> 123 4567 1\x1c2\x85 3"),
    (None, "no id here"),
]


def sentences(n: int, seed: int = 5) -> list[tuple[int, str]]:
    rng = random.Random(seed)
    parts = "the and ing er re on an th st ou es Blé ñon ción uß keit, 12 7".split()
    made = []
    for i in range(n):
        words = ("".join(rng.choices(parts, k=rng.randint(1, 4))) for _ in range(rng.randint(1, 300)))
        made.append((100 + i, " ".join(words) + rng.choice(["", ".", "\n", "%%%"])))
    return made


@pytest.fixture(scope="session")
def docs(spark):
    """Odd and ordinary texts, with null and clashing further columns."""
    rows = ODD + sentences(80)
    data = [(i, t, None, None, None, None) for i, t in rows]
    schema = "doc_id long, text string, lang string, source string, grp long, length long"
    return spark.createDataFrame(data, schema).repartition(4)


@pytest.fixture(scope="session")
def doc_rows():
    return ODD + sentences(80)
