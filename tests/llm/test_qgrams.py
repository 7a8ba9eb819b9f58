import random

import numpy as np
from corpus import edges, nothing
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfmark.llm import qgrams
from shelfmark.llm.common import table


def least_edits(passage: str, text: str) -> int:
    """Plain table: fewest edits of the passage anywhere in the text."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(passage):
        new = [i + 1]
        for j, d in enumerate(text):
            new.append(min(row[j] + (c != d), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def plain(text: str) -> str:
    return " ".join("".join(c.lower() if c.isalnum() else " " for c in text).split())


def mutated(rng, text, edits):
    out = list(text)
    for _ in range(edits):
        at = rng.randrange(len(out))
        rng.choice((lambda: out.pop(at), lambda: out.insert(at, "q"), lambda: out.__setitem__(at, "q")))()
    return "".join(out)


def test_against_brute_force(spark):
    rng = random.Random(5)
    words = ["".join(rng.choice("aeiostr") for _ in range(rng.randint(1, 7))) for _ in range(60)]
    passages = [(i, " ".join(rng.choice(words) for _ in range(n))) for i, n in enumerate((4, 12, 18, 25, 40, 40))]
    passages += [(10, "Tiny!"), (11, ""), (12, None), (13, "...")]
    docs = []
    for i in range(80):
        text = " ".join(rng.choice(words) for _ in range(rng.randint(0, 60)))
        if i % 2:
            passage = rng.choice(passages[:7])[1]
            at = rng.randint(0, len(text))
            text = text[:at] + " " + mutated(rng, passage, rng.randint(0, 1 + len(passage) // 14)) + "\n" + text[at:]
        docs.append((i, text))
    expected = set()
    for i, text in docs:
        for j, passage in passages:
            own = plain(passage or "")
            k = qgrams.budget(len(own), qgrams.RATE)
            if not own:
                continue
            if len(own) < qgrams.Q:
                if f" {own} " in f" {plain(text)} ":  # ends of the text separate too
                    expected.add((i, j))
            elif least_edits(own, plain(text)) <= k:
                expected.add((i, j))
    rows = qgrams.contaminated(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(passages, "item_id long, text string"),
        block_chars=200,
    ).collect()
    assert {(r["doc_id"], r["item_id"]) for r in rows} == expected
    texts = dict(docs)
    for r in rows:
        span = plain(texts[r["doc_id"]][r["start"] : r["end"]])
        assert least_edits(plain(dict(passages)[r["item_id"]]), span) == r["edits"]


@settings(max_examples=60, deadline=None)
@given(st.text("ab", min_size=1, max_size=12), st.text("ab", max_size=16), st.integers(0, 3))
def test_align(passage, region, k):
    best = qgrams.align(qgrams.code_points(passage), qgrams.code_points(region), k)
    least = least_edits(passage, region)
    assert (best is None) == (least > k)
    if best is not None:
        assert best[0] == least
        assert least_edits(passage, region[best[1] : best[2]]) == least


def test_normal_keeps_places():
    points, places = qgrams.normal(qgrams.code_points("Ab--C\U0001f600 é"))
    assert "".join(map(chr, points)) == "ab c\U0001f600 é"
    assert places.tolist() == [0, 1, 2, 4, 5, 6, 7]
    assert len(qgrams.normal(np.empty(0, np.uint32))[0]) == 0


def test_every_whole_passage_is_found(spark, sf_dir):
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    expected = {(d["doc_id"], b["item_id"]) for d in docs.collect() for b in items.collect() if b["text"] in d["text"]}
    found = {(r["doc_id"], r["item_id"]) for r in qgrams.contaminated(docs, items).collect()}
    assert expected and found >= expected
    kept = {r["doc_id"] for r in qgrams.decontaminated(docs, items).collect()}
    assert kept == {r["doc_id"] for r in docs.collect()} - {d for d, _ in found}


def test_edges(spark):
    items = spark.createDataFrame([(1, "tie tie tie tie tie tie tie tie tie tie tie tie tie tie tie"), (None, "x y"), (2, None)], "item_id long, text string")
    assert qgrams.contaminated(edges(spark), items).count() == 0
    assert qgrams.decontaminated(edges(spark), items).count() == edges(spark).count()
    assert qgrams.decontaminated(edges(spark), items).columns == edges(spark).columns
    assert qgrams.contaminated(nothing(spark), items).count() == 0
    assert qgrams.contaminated(edges(spark), items.limit(0)).count() == 0
    assert qgrams.decontaminated(edges(spark), items.limit(0)).count() == edges(spark).count()


def pairs(texts, items, **options):
    found = qgrams.best_matches(texts, qgrams.index(items), qgrams.Q, qgrams.RATE)
    return {(t, items[i][0]): v for (t, i), v in found.items()}


def test_the_last_code_point_shifts_nothing():
    top = chr(0x10FFFF)
    passage = "the quick brown fox jumps over the lazy dog and then runs back to the old red barn again"
    texts = [f"{top} first {top}{top}", f"{top}{passage}", "a clean one", f"x {top} {passage} {top}", top, passage]
    found = pairs(texts, [(7, passage)])
    assert {k for k in found} == {(1, 7), (3, 7), (5, 7)}
    for (t, _), (edits, start, end) in found.items():
        assert least_edits(plain(passage), plain(texts[t][start:end])) == edits <= 1
    # A passage that holds it is found, and nothing reaches over the end of a text.
    both = f"alpha beta gamma{top} delta epsilon zeta eta theta iota kappa lambda"
    assert set(pairs([both, both[:20], both[20:], f"so {both}"], [(1, both)])) == {(0, 1), (3, 1)}


def test_short_passages_at_the_ends():
    texts = ["short one", "short one.", "a short one", "short one here", "shorter one", "ashort one", "short", "one", "Short--one! x", "", "x short one y short one"]
    found = pairs(texts, [(1, "Short one"), (2, "x")])
    assert set(found) == {(t, 1) for t in (0, 1, 2, 3, 8, 10)} | {(8, 2), (10, 2)}
    assert found[(0, 1)] == (0, 0, 9) and found[(2, 1)] == (0, 2, 11) and found[(10, 1)] == (0, 2, 11)


def test_one_repeated_character_is_searched_in_bounded_memory():
    long = "a" * 100_000
    texts = [long, "b" * 500, "a" * 1_950, "a" * 1_800, long[:50_000] + " b " + long[:50_000], "plain text"]
    found = pairs(texts, [(1, "a" * 2_000), (2, "ab " * 30)])
    assert {t for t, i in found if i == 1} == {0, 2, 4}
    assert found[(0, 1)][0] == 0 and found[(2, 1)][0] == 50


def test_halves_and_dense_bands_find_the_same(monkeypatch):
    rng = random.Random(11)
    for _ in range(30):
        letters = rng.choice(["ab", "a", "abcdefgh "])
        items = [(i, "".join(rng.choice(letters) for _ in range(rng.randint(12, 120)))) for i in range(4)]
        texts = []
        for i in range(12):
            around = "".join(rng.choice(letters) for _ in range(rng.randint(0, 200)))
            texts.append(around[:40] + mutated(rng, rng.choice(items)[1], rng.randint(0, 8)) + around[40:])
        expected = {}
        for t, text in enumerate(texts):
            for i, passage in items:
                own = plain(passage)
                least = least_edits(own, plain(text)) if len(own) >= qgrams.Q else None
                if least is not None and least <= qgrams.budget(len(own), qgrams.RATE):
                    expected[(t, i)] = least
        for limit in (4_000_000, 200, 1):
            monkeypatch.setattr(qgrams, "LIMIT", limit)
            found = {k: v[0] for k, v in pairs(texts, items).items() if len(plain(items[k[1]][1])) >= qgrams.Q}
            assert found == expected
