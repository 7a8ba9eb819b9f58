import hashlib

from corpus import edges, frame, nothing, prose
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfmark.llm import merkle


def test_against_brute_force(spark):
    rows = prose(120, 3)
    rows += [(1000, ""), (1001, "a"), (1002, "\n\n\n"), (1003, "word " * 20000)]
    by_id = sorted(rows, reverse=True)
    found = {r["doc_id"]: r for r in merkle.edit_against_next(frame(spark, rows), 2).collect()}
    assert len(found) == len(rows)
    for i, (doc_id, text) in enumerate(by_id):
        following = by_id[(i + 1) % len(by_id)][1]
        take = len(text) // 3
        changed = text[: len(text) - take] + following[:take]
        r = found[doc_id]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        trees = [merkle.grow(t) for t in (text, changed, following)]
        assert (r["fingerprint"], r["edited_fingerprint"]) == tuple(merkle.fingerprint(t) for t in trees[:2])
        assert r["near_edited"] == merkle.likeness(trees[0], trees[1])
        assert r["near_next"] == merkle.likeness(trees[0], trees[2])


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("ab .\n\u00e9\U0001f600"), max_size=900), st.text(st.sampled_from("ab .\n"), max_size=40))
def test_tree_covers_the_text(text, other):
    tree = merkle.grow(text)
    assert sum(map(sum, tree.lengths)) == len(text)
    assert merkle.parse(merkle.fingerprint(tree))[1:] == tree[1:]
    assert (merkle.grow(other).root == tree.root) == (other == text)
    assert merkle.likeness(tree, tree) == 1.0
    assert 0.0 <= merkle.likeness(tree, merkle.grow(other)) == merkle.likeness(merkle.grow(other), tree) <= 1.0


def test_differing_branches_locate_edits():
    lines = [f"Paragraph {i} says that {i * i} is a square. It goes on for a while, as they do." for i in range(60)]
    text = "\n".join(lines)
    at = text.index("Paragraph 30")
    changed = text[:at] + "PARAGRAPH" + text[at + 9 :]
    spans = merkle.edited_spans(merkle.parse(merkle.fingerprint(merkle.grow(text))), merkle.grow(changed))
    assert len(spans) == 1 and spans[0][0] <= at < spans[0][1] <= at + 120
    assert merkle.likeness(merkle.grow(text), merkle.grow(changed)) > 0.97
    moved = "\n".join(lines[40:] + lines[:40])
    assert merkle.likeness(merkle.grow(text), merkle.grow(moved)) > 0.8


def test_fingerprints_and_edges(spark):
    found = merkle.merkle_fingerprints(edges(spark)).collect()
    assert len(found) == edges(spark).count()
    assert merkle.merkle_fingerprints(nothing(spark)).count() == 0
    rows = merkle.edit_against_next(edges(spark)).collect()
    assert len(rows) == edges(spark).count()
    assert merkle.edit_against_next(nothing(spark)).count() == 0
    one = merkle.edit_against_next(frame(spark, [(5, "only one document here")])).first()
    assert one["near_next"] == 1.0
