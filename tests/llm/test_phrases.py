import random
import re
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from corpus import edges, nothing
from pyspark.sql import functions as F

from shelfmark.llm import phrases
from shelfmark.llm.common import table

CAPITALS = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def plain(rows, least, longest=5, top=2000):
    """The contract, phrase by phrase, in Python integers."""
    counts = defaultdict(Counter)
    n = Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(CAPITALS)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, longest + 1):
                for i in range(len(words) - size + 1):
                    counts[lang][tuple(words[i : i + size])] += 1
    out = []
    for lang, found in counts.items():
        kept = {p: a for p, a in found.items() if len(p) > 1 and a >= least}
        inner = {}
        for p, a in kept.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    inner[p[i : i + size]] = max(inner.get(p[i : i + size], 0), a)
        scored = []
        for p, a in kept.items():
            if 100 * inner.get(p, 0) >= 100 * a:
                continue
            score, _, left, right = min((1000 * a * n[lang] // (found[p[:k]] * found[p[k:]]), k, found[p[:k]], found[p[k:]]) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def corpus(seed, count, langs=("en", "fr", None), vocabulary=25):
    rng = random.Random(seed)
    known = ["".join(rng.choice("abcdé") for _ in range(rng.randint(1, 4))) for _ in range(vocabulary)]
    weights = [1 / (i + 1) for i in range(vocabulary)]
    rows = []
    for _ in range(count):
        words = rng.choices(known, weights, k=rng.randint(0, 60))
        for _ in range(rng.randint(0, 2)):
            at = rng.randint(0, len(words))
            words[at:at] = ["Very", "fixed", "long", "phrase", "here", "too"]
        gaps = rng.choices((" ", "  ", "\t", ". ", ",", "\n", " ", " \x0b"), (60, 5, 5, 5, 3, 2, 2, 1), k=len(words))
        rows.append((rng.choice(langs), "".join(w + g for w, g in zip(words, gaps))))
    return rows


def frame_of(spark, rows):
    return spark.createDataFrame(rows, "lang string, text string")


def result(frame):
    return sorted(tuple(r) for r in frame.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(phrases, "SLICE", 2000)
    for seed, least, top in ((1, 5, 2000), (2, 12, 7)):
        rows = corpus(seed, 300)
        found = result(phrases.collocations(frame_of(spark, rows).repartition(4), least=least, top=top))
        assert found == plain(rows, least, top=top) and len(found) > 15


def test_ties_repeats_and_runs_of_one_word(spark):
    rows = [("en", "a a a a a. b c b c b c! B C")] * 40 + [(None, "a a a")] * 40 + [("und", "a a")] * 5
    assert result(phrases.collocations(frame_of(spark, rows), least=40)) == plain(rows, 40)


def test_many_tries_give_the_same_counts(spark):
    rows = corpus(3, 200)
    docs = frame_of(spark, rows)
    words = phrases.word_counts(docs, 4)
    named = phrases.candidates(docs, words, 4)
    assert named.count() > 60
    one = {tuple(r) for r in phrases.phrase_counts(docs, named).collect()}
    many = {tuple(r) for r in phrases.phrase_counts(docs, named, trie_most=15).collect()}
    assert one == many and len(one) == named.count()


def test_no_frequent_phrase_is_missed_or_much_else_named(spark):
    rows = corpus(4, 200)
    docs = frame_of(spark, rows)
    named = {(r["lang"], r["phrase"]) for r in phrases.candidates(docs, phrases.word_counts(docs, 6), 6).collect()}
    counts = Counter()
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text.translate(CAPITALS)):
            words = re.findall(r"[^\x20\x09]+", piece)
            for size in range(2, 6):
                for i in range(len(words) - size + 1):
                    counts[lang or "und", " ".join(words[i : i + size])] += 1
    assert named == {p for p, f in counts.items() if f >= 6}  # no false bit in so small a corpus


def test_a_full_bitmap_only_adds_candidates(spark, monkeypatch):
    monkeypatch.setattr(phrases, "bitmap_of", lambda hashes: np.full(1 << phrases.BITS >> 3, 255, np.uint8))
    rows = corpus(5, 60)
    assert result(phrases.collocations(frame_of(spark, rows), least=5)) == plain(rows, 5)


def test_a_pass_holds_a_few_slices_of_a_large_batch(spark):
    rng = np.random.default_rng(1)
    words = np.array([f"w{i}" for i in range(60_000)])
    texts = [" ".join(words[rng.zipf(1.3, 30_000) % len(words)]) for _ in range(160)]
    batch = pa.RecordBatch.from_arrays([pa.array(["en"] * len(texts)), pa.array(texts)], names=["lang", "text"])
    assert batch.nbytes > 16 << 20
    bitmap = type("Sent", (), {"value": np.zeros(1 << phrases.BITS >> 3, np.uint8)})
    every = type("Sent", (), {"value": np.full(1 << phrases.BITS >> 3, 255, np.uint8)})
    named = type("Sent", (), {"value": {2: bitmap.value, 3: bitmap.value}})
    passes = (phrases._count_words(iter([batch])), phrases._count_hashes(every, 2, iter([batch])), phrases._name(named, 4, iter([batch])))
    for found in passes:
        tracemalloc.start()
        for _ in found:
            pass
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 150 << 20


def test_double_array():
    rng = random.Random(1)
    known = [f"w{i}" for i in range(60)]
    rows = sorted({(rng.choice(("en", "fr")), " ".join(rng.choices(known, k=rng.randint(2, 5)))) for _ in range(3000)})
    trie = phrases.build_trie(rows)
    assert (trie.accept >= 0).sum() == len(rows)
    for i, (lang, phrase) in enumerate(rows):
        state = np.array([trie.roots[lang]])
        for word in phrase.encode().split(b" "):
            state = phrases.step(trie, state, np.array([trie.symbols[lang][word]]))
        assert trie.accept[state[0]] == i
    used = (trie.check >= 0).sum()
    assert used < len(trie.check) < 3 * used + 3000
    assert len(phrases.build_trie([]).phrases) == 0


def test_products_beyond_64_bits(spark):
    """score = floor(1000 a n / (l r)) with a, n, l, r near 10^9."""
    wide = "cast({} as decimal(19,0))".format
    a, n, l, r = 987_654_321, 123_456_789_012, 999_999_937, 998_244_353
    row = spark.createDataFrame([(a, n, l, r)], "a long, n long, l long, r long")
    got = row.select(F.expr(f"(1000 * {wide('a')} * {wide('n')}) div ({wide('l')} * {wide('r')})")).first()[0]
    assert got == 1000 * a * n // (l * r)


def test_edges(spark):
    docs = edges(spark).withColumn("lang", F.lit("xx"))
    found = result(phrases.collocations(docs, least=3))
    assert found == plain([(r["lang"], r["text"]) for r in docs.collect()], 3) and found
    assert phrases.collocations(nothing(spark).withColumn("lang", F.lit(None).cast("string"))).count() == 0
    assert phrases.collocations(frame_of(spark, [("a", None), (None, ""), ("b", "one")])).count() == 0


def test_registered_query(spark, sf_dir):
    from shelfmark.llm import queries

    rows = [(r["lang"], r["text"]) for r in table(spark, sf_dir, "documents").collect()]
    assert result(queries.op12_phrase_tries(spark, sf_dir)) == plain(rows, 100)


def test_texts_are_cut_once_and_tries_share_a_pass(spark, monkeypatch):
    rows = corpus(6, 80)
    read = spark.sparkContext.accumulator(0)

    def seen(text):
        read.add(1)
        return text

    docs = frame_of(spark, rows).withColumn("text", F.udf(seen, "string")("text"))
    assert result(phrases.collocations(docs, least=5)) == plain(rows, 5)
    assert read.value == len(rows)
    docs = frame_of(spark, rows)
    named = phrases.candidates(docs, phrases.word_counts(docs, 5), 5)
    passes, summed = [], phrases._summed
    monkeypatch.setattr(phrases, "_summed", lambda *a: passes.append(1) or summed(*a))
    counts = phrases.phrase_counts(docs, named, trie_most=-(-named.count() // phrases.TRIES)).collect()
    assert len(passes) == 1 and len(counts) == named.count() > 30


def test_few_strange_hashes_pass_a_bitmap(spark):
    hashes = spark.range(1_000_000).select(F.xxhash64("id").alias("hash"))
    bitmap = phrases.bitmap_of(hashes)
    own = hashes.toArrow()["hash"].to_numpy().view(np.uint64)
    assert phrases._passes(bitmap, own).all()
    assert phrases._passes(bitmap, np.random.default_rng(1).integers(0, 1 << 64, 1_000_000, np.uint64)).mean() < 0.001


def test_slices_as_they_are_kept():
    for texts in ([], [b""], [b"A b. c\td e!", b"", b"b b", "\u00e9 \u00c9 a".encode()]):
        words = phrases.cut_words(texts, phrases.KINDS, lower=True)
        again = phrases._opened(*phrases._packed(words))
        assert again.distinct == words.distinct and (again.codes == words.codes).all() and len(again.pieces) == len(words.pieces)
        assert (np.diff(again.pieces).astype(bool) == np.diff(words.pieces).astype(bool)).all()


def test_wide_states_of_a_double_array():
    rng = random.Random(2)
    rows = [("en", f"a{i} b{j}") for i in range(12) for j in rng.sample(range(2000), 120 + 20 * i)]
    rows += [("fr", f"a0 b{j} c") for j in range(300)]
    trie = phrases.build_trie(rows)
    for i, (lang, phrase) in enumerate(rows):
        state = np.array([trie.roots[lang]])
        for word in phrase.encode().split(b" "):
            state = phrases.step(trie, state, np.array([trie.symbols[lang][word]]))
        assert trie.accept[state[0]] == i
    assert len(trie.check) < 8 * (trie.check >= 0).sum()
