import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from corpus import edges, nothing, prose
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shelfmark.llm import tokens
from shelfmark.llm.common import table
from shelfmark.session import scratch_path

WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    "",
    " ",
    "\n\t ",
    "It's they'll  we've I'M don't",
    "á é́ ́ x ̈y Å ẛ̣ ΑΣ ΣΑΣ.Σ İstanbul ǅ",
    "<|endoftext|> a<|endoftext|>b <|startoftext|>x< |endoftext|>",
    "1234 ½ ٣٤ x2y ... ?!'s 's' 't",
    "no break  line em　wide\x1f\x1c\x85next\x0bv\x0cf\rend",
    "漢字かな交じり文 한국어 \U0001f600\U0001f468‍\U0001f469",
    "x" * 3000 + " " + "'" * 50,
]


def expected(rows, path):
    """(doc_id, start, n_tokens, ids_crc32) in ascending order, nulls first, by the plain tokenizer."""
    tokenizer = Tokenizer.from_file(path)
    out, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def written(docs, path=WORDS, **options):
    folder = scratch_path(docs.sparkSession, "tokens")
    manifest = tokens.write_shards(docs, folder, path, spaced=path == WORDS, **options)
    return folder, manifest


def test_runs_between_white_space_give_the_ids_of_whole_texts():
    plain = Tokenizer.from_file(WORDS)
    with open(WORDS, encoding="utf-8") as file:
        encoder = tokens.Encoder(file.read(), True, 2)
    rng = random.Random(5)
    letters = "ab 'sStT\n\t́̈éΣσ  漢.,<|>1½\U0001f600"
    texts = ODD + ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(400)]
    for text, ids in zip(texts, encoder.encode(texts)):
        assert ids.tolist() == [*plain.encode(text, add_special_tokens=False).ids, 2], text


def test_the_memory_of_a_task_is_bounded(monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 10)
    with open(WORDS, encoding="utf-8") as file:
        encoder = tokens.Encoder(file.read(), True, 2)
    plain = Tokenizer.from_file(WORDS)
    for part in range(5):
        texts = [f"w{part}{i} again word" for i in range(7)]
        assert [i.tolist() for i in encoder.encode(texts)] == [[*plain.encode(t).ids, 2] for t in texts]
    assert len(encoder.known) <= 20


def test_minimal_perfect_hash():
    rng = np.random.default_rng(3)
    for count in (0, 1, 2, 63, 64, 65, 5000, 60_000):
        ids = rng.choice(1 << 40, count, replace=False).astype(np.int64) - (1 << 39)
        keys = tokens.key_hash(ids, np.zeros(count, bool))
        index = tokens.build_index(keys)
        assert sorted(tokens.hash_numbers(index, keys).tolist()) == list(range(count))
        assert len(index.words) * 64 < 6 * count + 64 * 40


def test_keys_left_over_by_all_levels(monkeypatch):
    monkeypatch.setattr(tokens, "LEVELS", 1)
    keys = tokens.key_hash(np.arange(500), np.zeros(500, bool))
    index = tokens.build_index(keys)
    assert len(index.leftover) > 50
    assert sorted(tokens.hash_numbers(index, keys).tolist()) == list(range(500))
    absent = tokens.key_hash(np.arange(500, 900), np.zeros(400, bool))
    assert (tokens.hash_numbers(index, absent) < 500).all()


def test_shard_round_trip():
    rng = random.Random(2)
    keys = [-5, -5, 0, 1, 7, 7, 7, 1 << 62]
    ids = [np.array([rng.randrange(2**32) for _ in range(rng.randint(0, 9))], np.uint32) for _ in keys]
    shard = tokens.Shard(tokens.shard_bytes(ids, keys, 3, 4))
    assert (shard.part, shard.piece) == (3, 4)
    first, count = shard.find(np.array([-5, 0, 7, 1 << 62, 2, 99]), np.zeros(6, bool))
    assert first.tolist()[:4] == [0, 2, 4, 7] and count.tolist() == [2, 1, 3, 1, 0, 0]
    for i, own in enumerate(ids):
        begin, end = shard.span(i)
        assert shard.ids[begin:end].tolist() == own.tolist()
    nulls = tokens.Shard(tokens.shard_bytes(ids, [None] * len(ids), 0, 0))
    assert nulls.find(np.array([0, 0]), np.array([True, False]))[1].tolist() == [len(ids), 0]
    with pytest.raises(ValueError):
        tokens.shard_bytes(ids[:3], [1, 2, 1], 0, 0)


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_against_the_plain_tokenizer(spark, path):
    rows = [(i * 3 - 40, t) for i, t in enumerate(ODD)] + [(i + 1000, t) for i, t in prose(120, 4)] + [(5000, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    folder, manifest = written(docs, path, shard_ids=1500)
    assert manifest.count() > 10
    found = tokens.read_documents(spark, folder)
    assert sorted(tuple(r) for r in found.collect()) == sorted(expected(rows, path))
    again, _ = written(docs, path, shard_ids=10**9)
    assert sorted(tuple(r) for r in tokens.read_documents(spark, again).collect()) == sorted(expected(rows, path))


def test_files_hold_the_corpus_in_order(spark):
    rows = prose(60, 8)
    folder, manifest = written(frame_of(spark, rows), shard_ids=2000)
    files = [r["file"] for r in manifest.orderBy("part", "piece").collect()]
    stream = []
    for file in files:
        with open(f"{folder}/shards/{file}", "rb") as source:
            stream.extend(tokens.Shard(source.read()).ids.tolist())
    plain = Tokenizer.from_file(WORDS)
    assert stream == [i for _, t in sorted(rows) for i in [*plain.encode(t, add_special_tokens=False).ids, 2]]


def frame_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_keyed_access(spark, monkeypatch):
    monkeypatch.setattr(tokens, "ROUTED", 3)
    rows = prose(80, 6) + [(9, "again"), (9, "again"), (9, "other"), (None, "no id"), (None, "x")]
    folder, manifest = written(frame_of(spark, rows), shard_ids=700)
    assert manifest.count() > 8
    plain = Tokenizer.from_file(WORDS)
    keys = [9, 12, 12, 30, 77777, -1, None, rows[0][0]]
    wanted = spark.createDataFrame([(k,) for k in keys], "k long")
    found = sorted(((r["doc_id"], r["ids"]) for r in tokens.look_up(wanted, folder, "k").collect()), key=str)
    held = sorted(((i, [*plain.encode(t, add_special_tokens=False).ids, 2]) for i, t in rows if i in keys), key=str)
    assert found == held


def test_a_hot_doc_id_fills_many_parts(spark):
    rows = [(7, f"text {i} of a hot id") for i in range(500)] + [(None, "same")] * 500 + [(i, f"own {i}") for i in range(500)]
    folder, manifest = written(frame_of(spark, rows).repartition(8), shard_ids=10**9)
    docs = [r["n_docs"] for r in manifest.groupBy("part").agg(F.sum("n_docs").alias("n_docs")).collect()]
    assert len(docs) >= 4 and max(docs) < 1000
    found = sorted((tuple(r) for r in tokens.read_documents(spark, folder).collect()), key=lambda r: r[1])
    assert len(found) == 1500 and [r[0] for r in found[:500]] == [None] * 500
    ends = [s + n for _, s, n, _ in found]
    assert [s for _, s, _, _ in found] == [0, *ends[:-1]]
    assert sum(1 for r in found if r[0] == 7) == 501


def test_rewritten_shards_are_the_same(spark):
    docs = frame_of(spark, prose(50, 9)).repartition(3)
    files = []
    for _ in range(2):
        folder, manifest = written(docs, shard_ids=900)
        own = {}
        for r in manifest.collect():
            with open(f"{folder}/shards/{r['file']}", "rb") as source:
                own[r["file"]] = source.read()
        files.append(own)
    assert files[0] == files[1]


def test_edges(spark):
    docs = edges(spark)
    folder, _ = written(docs)
    found = tokens.read_documents(spark, folder).collect()
    assert len(found) == docs.count()
    assert sum(r["n_tokens"] for r in found if r["doc_id"] in (1, 2, 3)) == 3
    empty, manifest = written(nothing(spark))
    assert manifest.count() == 0 and tokens.read_documents(spark, empty).count() == 0
    assert tokens.look_up(docs, empty).count() == 0


def test_registered_query(spark, sf_dir):
    from shelfmark.llm import queries

    rows = [(r["doc_id"], r["text"]) for r in table(spark, sf_dir, "documents").collect()]
    found = queries.op13_token_shards(spark, sf_dir).select("doc_id", "start", "n_tokens", "ids_crc32")
    assert sorted(tuple(r) for r in found.collect()) == sorted(expected(rows, WORDS))
