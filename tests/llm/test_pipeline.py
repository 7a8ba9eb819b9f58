import collections

import corpus_pipeline
from corpus import edges, nothing
from test_vptree import components

from shelfmark.llm import pareto, qgrams, ring, toxicity, vptree
from shelfmark.llm.common import table


def test_stages_against_brute_force(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    rows = sorted((tuple(r) for r in docs.collect()), key=lambda r: r[0])
    columns = docs.columns
    weights = toxicity.train(docs, table(spark, sf_dir, "labels"))
    scores = toxicity.scores([r[1] for r in rows], weights, toxicity.BITS, {})
    rows = [r for r, s in zip(rows, scores) if s < 0.5]
    kept = corpus_pipeline.toxicity_stage(spark, docs, sf_dir)
    assert kept.columns == columns and sorted(tuple(r) for r in kept.collect()) == rows

    label = components([vptree.simhash(r[1], 3) for r in rows], 3)
    rows = [r for i, r in enumerate(rows) if label[i] == i]
    kept = corpus_pipeline.near_dedup_stage(spark, kept, sf_dir)
    assert kept.columns == columns and sorted(tuple(r) for r in kept.collect()) == rows

    passages = [r["text"] for r in table(spark, sf_dir, "benchmark").collect()]
    found = qgrams.best_matches([r[1] for r in rows], qgrams.index(list(enumerate(passages))), qgrams.Q, qgrams.RATE)
    hit = {i for i, _ in found}
    assert hit >= {i for i, r in enumerate(rows) if any(p in r[1] for p in passages)}
    rows = [r for i, r in enumerate(rows) if i not in hit]
    kept = corpus_pipeline.decontaminate_stage(spark, kept, sf_dir)
    assert kept.columns == columns and sorted(tuple(r) for r in kept.collect()) == rows

    mixed = corpus_pipeline.mix_stage(spark, kept, sf_dir)
    copies = collections.Counter(r["doc_id"] for r in mixed.collect())
    assert mixed.columns == columns
    assert copies == collections.Counter({r["doc_id"]: r["copies"] for r in pareto.pareto_mix(kept).collect() if r["copies"]})

    placed = corpus_pipeline.shard_stage(spark, mixed, sf_dir).collect()
    assert collections.Counter(r["doc_id"] for r in placed) == copies
    result = corpus_pipeline.run(spark, sf_dir).collect()
    assert collections.Counter((r["doc_id"], r["shard"]) for r in result) == collections.Counter((r["doc_id"], r["shard"]) for r in placed)
    assert {r["shard"] for r in result} <= set(range(corpus_pipeline.SHARDS)) and ring.CELLS == 65536


def test_stages_take_edges(spark, sf_dir):
    for docs in (edges(spark), nothing(spark)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, sf_dir)
            out.count()
            if name != "shard":
                assert out.columns == docs.columns
