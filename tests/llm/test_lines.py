import random
import string

from corpus import edges, frame, nothing
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfmark.llm import lines

LETTERS = string.ascii_lowercase + " "


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
        row = new
    return row[-1]


def changed(rng, text, edits):
    out = list(text)
    for _ in range(edits):
        at = rng.randrange(len(out)) if out else 0
        kind = rng.randrange(3)
        if kind == 0 or not out:
            out.insert(at, rng.choice("abc"))
        elif kind == 1:
            del out[at]
        else:
            out[at] = rng.choice("abc")
    return "".join(out)


@settings(max_examples=400, deadline=None)
@given(st.text("abc", max_size=30), st.integers(0, 5), st.integers(0, 3), st.randoms(use_true_random=False))
def test_banded_distance(a, edits, limit, rng):
    b = changed(rng, a, edits)
    assert lines.within(a, b, limit) == (distance(a, b) <= limit)


@settings(max_examples=300, deadline=None)
@given(st.text("ab", min_size=16, max_size=30), st.integers(0, 2), st.randoms(use_true_random=False))
def test_no_pair_is_missed_by_segments(a, edits, rng):
    b = changed(rng, a, edits)
    short, long = sorted((a, b), key=len)
    own = lines.segments(len(short), 2)
    assert any(long[s:e] == short[own[n][0] : own[n][1]] for n, s, e in lines.probes(len(long), len(short), 2))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text("abé\U0001f600", min_size=16, max_size=40), min_size=1, max_size=6), st.integers(0, 2), st.randoms(use_true_random=False))
def test_keys_are_those_of_segments_and_probes(known, edits, rng):
    near = [changed(rng, x, edits) for x in known]
    near = [x for x in near if len(x) >= lines.SHORTEST]
    pieces = {}
    for own, probing in ((known, False), (near, True)):
        if not own:
            continue
        plain = []
        for i, x in enumerate(own):
            if probing:
                shorter = range(max(lines.SHORTEST, len(x) - 2), len(x) + 1)
                plain += [(i, n, y, x[s:e]) for y in shorter for n, s, e in lines.probes(len(x), y, 2)]
            else:
                plain += [(i, n, len(x), x[s:e]) for n, (s, e) in enumerate(lines.segments(len(x), 2))]
        numbers, keys = lines.segment_keys(own, 2, probing)
        keys >>= lines.LOW
        assert list(numbers) == [p[0] for p in plain]
        for p, key in zip(plain, keys.tolist()):
            assert pieces.setdefault(p[1:], key) == key
    assert len(set(pieces.values())) == len(pieces)


@settings(max_examples=300, deadline=None)
@given(st.text("abcdefé\U0001f600", min_size=1, max_size=30), st.integers(0, 4), st.randoms(use_true_random=False))
def test_sketches_of_near_lines_are_near(a, edits, rng):
    b = changed(rng, a, edits) or "x"
    one, two = lines._sketches(*lines._characters([a, b])).tolist()
    assert max(one, two) < 1 << lines.PARITIES and (one ^ two).bit_count() <= 2 * distance(a, b)


def test_slices_hold_all_lines(monkeypatch):
    monkeypatch.setattr(lines, "SLICE", 50)
    known = ["x" * n for n in (10, 30, 10, 1, 200, 20, 30)]
    runs = [known[own] for own in lines._slices(known)]
    assert [x for run in runs for x in run] == known
    assert all(len(run) == 1 or sum(map(len, run)) <= 50 for run in runs) and len(runs) == 4
    assert not list(lines._slices([]))


def test_copies_far_apart_are_no_candidates(spark):
    """Lines that share a third of their text, and differ by words in the rest, are not paired up."""
    rng = random.Random(7)
    shared = "".join(rng.choice(LETTERS) for _ in range(100))
    known = [f"{shared}{i:03d}" + "".join(rng.choice(LETTERS) for _ in range(200)) + "." for i in range(150)]
    known += [changed(rng, x, 2) for x in known[:20]]
    found = lines.distinct_lines(spark.createDataFrame([(i, x) for i, x in enumerate(known)], "key long, text string"))
    near = sum(distance(known[i], x) <= 2 for i, x in enumerate(known[150:]))
    assert near == 20 and lines.near_lines(found).count() == 20
    assert lines.candidate_pairs(found).count() < 1000  # of over 11,000 pairs that share the first segment


def brute_force(rows):
    first = {}
    for doc_id, text in sorted(rows):
        for at, line in lines.lines_of(text):
            first.setdefault(line, (doc_id, at))
    known = list(first)
    near = {x: [y for y in known if x != y and min(len(x), len(y)) >= lines.SHORTEST and distance(x, y) <= lines.EDITS] for x in known}
    out = {}
    for doc_id, text in rows:
        own = lines.lines_of(text)
        gone = [at for at, x in own if first[x] < (doc_id, at) or any(first[y] < first[x] for y in near[x])]
        out[doc_id] = (len(own), len(gone), sum(len(near[x]) for _, x in own), gone, [(at, *first[x], len(near[x])) for at, x in own])
    return out


def test_against_brute_force(spark):
    rng = random.Random(4)
    known = ["".join(rng.choice("abcdef ") for _ in range(rng.randint(1, 60))) for _ in range(40)]
    rows = []
    for i in range(60):
        own = [changed(rng, rng.choice(known), rng.choice((0, 0, 1, 2, 3))) for _ in range(rng.randint(0, 6))]
        rows.append((i - 5, "\n".join(own)))
    found = {
        r["doc_id"]: (
            r["n_lines"], r["n_removed"], r["n_links"], list(r["removed"]),
            [(x["line"], x["class_doc_id"], x["class_line"], x["links"]) for x in r["classes"]],
        )
        for r in lines.line_dedup(frame(spark, rows)).collect()
    }
    expected = brute_force(rows)
    assert sum(x[2] for x in expected.values()) > 50
    assert found == expected


def test_edges(spark):
    found = lines.line_dedup(edges(spark)).collect()
    assert len(found) == edges(spark).count()
    by_id = {r["doc_id"]: r for r in found}
    assert by_id[1]["n_lines"] == by_id[2]["n_lines"] == by_id[3]["n_lines"] == 0
    assert by_id[7]["n_removed"] == 1 and by_id[4]["n_removed"] == 0
    nulls = [r for r in found if r["doc_id"] is None]
    assert len(nulls) == 2 and nulls[0]["classes"][0]["class_doc_id"] is None
    assert lines.line_dedup(nothing(spark)).count() == 0
