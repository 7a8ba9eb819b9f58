import hashlib

import numpy as np
from corpus import edges, frame, nothing, prose

from shelfmark.llm import windows


def brute_force(rows, length):
    first, split = {}, {}
    for doc_id, text in sorted(rows):
        words = split[doc_id] = text.encode().split()
        for at in range(len(words) - length + 1):
            first.setdefault(tuple(words[at : at + length]), doc_id)
    out = {}
    for doc_id, words in split.items():
        gone = [False] * len(words)
        for at in range(len(words) - length + 1):
            if first[tuple(words[at : at + length])] < doc_id:
                gone[at : at + length] = [True] * length
        kept = [w for w, g in zip(words, gone) if not g]
        out[doc_id] = (len(words), sum(gone), hashlib.sha256(b" ".join(kept)).hexdigest())
    return out


def test_against_brute_force(spark, monkeypatch):
    rows = prose(150, 7)
    expected = brute_force(rows, 50)
    assert sum(x[1] for x in expected.values()) > 1000
    for size in (windows.SLICE, 500):  # one slice, and many
        monkeypatch.setattr(windows, "SLICE", size)
        found = windows.substring_dedup(frame(spark, rows), 50).collect()
        assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in found} == expected
        for r in found:
            assert sum(x["end"] - x["start"] for x in r["removed"]) == r["n_removed"]
            assert all(a["end"] < b["start"] for a, b in zip(r["removed"], r["removed"][1:]))


def test_short_windows(spark):
    rows = prose(60, 8, words=30, vocabulary=12)
    found = windows.substring_dedup(frame(spark, rows), 3).collect()
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in found} == brute_force(rows, 3)


def test_window_hashes_are_polynomials():
    rng = np.random.default_rng(1)
    values = rng.integers(0, 2**63, 40, dtype=np.uint64)
    for length in (1, 2, 5, 7, 40, 41):
        found = windows.window_hashes(values, length)
        assert len(found) == max(0, 41 - length)
        assert len(set(found.tolist())) == len(found)
        # Equal windows at other places have equal hashes.
        again = windows.window_hashes(np.concatenate((values[::-1], values)), length)
        assert found.tolist() == again[len(again) - len(found) :].tolist()


def test_edges(spark):
    found = windows.substring_dedup(edges(spark), 50).collect()
    assert len(found) == edges(spark).count()
    by_id = {r["doc_id"]: r for r in found}
    assert by_id[1]["n_words"] == by_id[2]["n_words"] == by_id[3]["n_words"] == 0
    assert by_id[4]["n_words"] == 30000 and by_id[4]["n_removed"] == 0
    assert by_id[-8]["n_words"] == 3  # white space is ASCII's alone
    assert windows.substring_dedup(nothing(spark), 50).count() == 0
    ties = frame(spark, [(5, "a b c d"), (5, "a b c d"), (9, "x a b c d")])
    assert sorted((r["doc_id"], r["n_removed"]) for r in windows.substring_dedup(ties, 3).collect()) == [(5, 0), (5, 0), (9, 4)]
