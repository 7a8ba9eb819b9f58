import collections

import duckdb
import pytest
from corpus import edges, nothing

from shelfmark.llm import pareto
from shelfmark.llm.common import table


def test_targets_stop_at_the_cap(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 500), (None, 90), ("d", 0)], "source string, source_size long")
    found = {r["source"]: r["target"] for r in pareto.source_targets(sizes).collect()}
    # Weights: a 5, b 2, c 1, d 5, null 2; 1.5 * 1600 = 2400, of which a can hold 20 and null 180.
    assert found["a"] == 20 and found["d"] == 0 and found[None] == 180
    assert found["b"] == pytest.approx(2200 * 2 / 3) and found["c"] == pytest.approx(2200 / 3)


def test_taken_words_come_near_the_targets(spark, sf_dir):
    rows = pareto.pareto_mix(table(spark, sf_dir, "documents")).collect()
    assert len(rows) == table(spark, sf_dir, "documents").count()
    taken, largest, target = collections.Counter(), collections.Counter(), {}
    for r in rows:
        assert r["taken"] in (0, r["size"], 2 * r["size"])
        taken[r["source"]] += r["taken"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
        target[r["source"]] = r["target"]
    assert all(abs(taken[s] - target[s]) <= largest[s] / 2 + 1e-6 for s in target)
    assert rows and sorted(rows) == sorted(pareto.pareto_mix(table(spark, sf_dir, "documents")).collect())


def test_cells_change_nothing(spark, sf_dir, monkeypatch):
    """With one cell every rank is compared row by row."""
    fine = sorted(pareto.pareto_mix(table(spark, sf_dir, "documents")).collect())
    monkeypatch.setattr(pareto, "CELLS", 1)
    assert sorted(pareto.pareto_mix(table(spark, sf_dir, "documents")).collect()) == fine


def test_inclusion_follows_the_chance(spark):
    """Over many seeds every document is taken about as often as its chance says."""
    docs = spark.createDataFrame([(i, "w " * 10, "a" if i < 40 else "b") for i in range(60)], "doc_id long, text string, source string")
    counts = collections.Counter()
    for seed in range(12):
        for r in pareto.pareto_mix(docs, seed=str(seed), weights=(1, 1), share=0.5).collect():
            counts[r["source"]] += r["copies"]
    assert counts["a"] == pytest.approx(12 * 15, abs=12) and counts["b"] == pytest.approx(12 * 15, abs=12)


def test_documents_are_repeated_as_often_as_taken(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    copies = {r["doc_id"]: r["copies"] for r in pareto.pareto_mix(docs).collect() if r["size"]}
    mixed = pareto.mixed_documents(docs)
    assert mixed.columns == docs.columns
    found = collections.Counter(r["doc_id"] for r in mixed.select("doc_id", "text").collect())
    assert all(found[i] == n for i, n in copies.items())


def test_edges(spark):
    rows = pareto.pareto_mix(edges(spark)).collect()
    assert len(rows) == edges(spark).count()
    assert {r["doc_id"]: r["taken"] for r in rows}[1] == 0
    assert pareto.mixed_documents(edges(spark)).columns == edges(spark).columns
    assert pareto.pareto_mix(nothing(spark)).count() == 0
    assert pareto.mixed_documents(nothing(spark)).count() == 0


def hot_ids(spark, n=3000):
    """A third of the rows has no doc_id, a third shares one; sizes repeat."""
    ids = lambda i: None if i % 3 == 0 else 7 if i % 3 == 1 else i
    rows = [(ids(i), "w " * (1 + i % 4), "abc"[i % 7 % 3]) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(7)


def test_repeated_and_missing_ids_are_drawn_one_by_one(spark):
    docs = hot_ids(spark)
    rows = pareto.pareto_mix(docs).collect()
    taken, target = collections.Counter(), {}
    for r in rows:
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
    assert len(rows) == 3000 and all(abs(taken[s] - target[s]) <= 2 for s in target)
    order = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(rows, key=order) == sorted(pareto.pareto_mix(docs.repartition(3)).collect(), key=order)
    mixed = collections.Counter()
    for r in pareto.mixed_documents(docs).collect():
        mixed[r["source"]] += len(r["text"].split())
    assert mixed == taken
    con = duckdb.connect()
    con.register("documents", docs.toPandas().astype({"doc_id": "Int64"}))
    columns = ["doc_id", "size", "source_size", "target", "taken"]
    expected = con.sql(f"SELECT {', '.join(columns)} FROM ({pareto.SQL})").fetchall()
    key = lambda r: tuple((x is not None, round(x, 6) if x is not None else 0) for x in r)
    assert sorted(map(key, expected)) == sorted(key(tuple(r[c] for c in columns)) for r in rows)
