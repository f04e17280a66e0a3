from __future__ import annotations

import random

import pytest

WORDS = "the of and to in is on for with that this as by from at or an be it are was he she they we you one two".split()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed: int, n: int, stock=None) -> str:
    """n words, most of them made up, in sentences and lines."""
    draw = random.Random(seed)
    out = []
    for i in range(n):
        word = draw.choice(stock or WORDS) if draw.random() < 0.4 else "".join(draw.choice("abdeilnorstu") for _ in range(draw.randint(2, 9)))
        out.append(word + draw.choice(["", "", "", "", ".", ",", ".\n"]))
    return " ".join(out)


def odd_rows() -> list[tuple]:
    """Nulls in every column, empty and long texts, repeated rows, ties."""
    base = prose(1, 90)
    rows = [
        (0, base, "en", "a", 1), (1, base, "en", "a", 1), (2, None, "en", "b", None), (3, "", None, None, 0), (4, " \n\t ", "fr", "b", 4),
        (None, prose(2, 50), "en", "a", 9), (None, None, None, None, None), (5, "one", "en", None, 3), (6, "One  TWO", "en", "c", 8),
        (7, prose(3, 6000), "en", "a", 9), (8, prose(4, 60), None, "b", 9), (8, prose(4, 60), None, "b", 9),
        (9, "é ñ ü 你好 \U0001f600 x y", "fr", "c", 9), (10, base + " more words at the end", "en", "b", 9), (11, "a b a b a b a b a b a b a b a b", "en", "c", 9),
    ]
    near = prose(5, 80).split()
    for i in range(25):
        copy = list(near)
        for j in range(i % 5):
            copy[(7 * i + 11 * j) % 80] = f"changed{i}x{j}"
        rows.append((100 + i, " ".join(copy), "en", "abc"[i % 3], 1))
    rows += [(200 + i, prose(50 + i, 30 + 9 * i), "en", "abcd"[i % 4], 5) for i in range(12)]
    return rows


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
