"""Small corpora for the tests of the corpus operators."""

from __future__ import annotations

import random

CLASHING = ("key", "size", "hash", "fp", "score", "line", "block", "cell", "at", "rank", "chance", "copies", "row", "point")

EDGES = [
    (None, "null id one two three", "a"),
    (None, None, None),
    (1, None, "a"),
    (2, "", None),
    (3, " \t\n ", "b"),
    (4, "word " * 30000, "b"),
    (5, "tie tie tie", "a"),
    (5, "tie tie tie", "a"),
    (6, "x" * 5000, "c"),
    (7, "tie tie tie", "c"),
    (-8, "été \U0001f600 no\u00a0break", "d"),
]


def edges(spark, rows=EDGES):
    """Nulls, empty and very long texts, ties, repeated rows, and columns with clashing names."""
    schema = "doc_id long, text string, source string, " + ", ".join(f"{c} string" for c in CLASHING)
    return spark.createDataFrame([(*r, *["x"] * len(CLASHING)) for r in rows], schema)


def nothing(spark):
    return edges(spark, [])


def prose(n: int, seed: int = 1, words: int = 200, vocabulary: int = 400) -> list[tuple[int, str]]:
    """Documents of random words, among them exact copies, near copies and shared passages."""
    rng = random.Random(seed)
    known = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(vocabulary)]
    def some(count: int) -> list[str]:
        return [rng.choice(known) + rng.choice(("", "", "", ".", ".\n")) for _ in range(count)]

    passage = some(70)
    out: list[tuple[int, str]] = []
    for i in range(n):
        kind = rng.random()
        own = some(rng.randint(1, words))
        if out and kind < 0.15:
            own = rng.choice(out)[1].split(" ")
        elif out and kind < 0.3:
            own = rng.choice(out)[1].split(" ")
            own[rng.randrange(len(own))] = rng.choice(known)
        elif kind < 0.45:
            at = rng.randint(0, len(own))
            own[at:at] = passage
        out.append((i * 3, " ".join(own)))
    rng.shuffle(out)
    return out


def frame(spark, rows):
    return spark.createDataFrame([(i, t, f"s{i % 3}") for i, t in rows], "doc_id long, text string, source string")
