"""Token ids of whole texts in raw binary shards, with a minimal perfect hash index per shard.

A shard file holds the documents of one doc_id range in ascending order:

    header   8 bytes ``TOKSHRD1``, then 9 little-endian 64-bit numbers: documents, ids, distinct keys,
             hash levels, words of all levels, leftover keys, shard part, shard piece, bytes per id
    ids      little-endian unsigned ids of all documents, end ids included, nothing between; 2 bytes
             each if the vocabulary allows it, else 4
    ends     per document: number of ids up to its end (int64)
    keys     per document: doc_id (int64) and a byte that is 1 for a null doc_id
    levels   bits of each hash level (int64 sizes), then the bit arrays as 64-bit words
    slots    per distinct key, in the order of its hash number: fingerprint (uint32), first document
             (int64), documents (int64); equal doc_ids are neighbours, so a run answers for a key
    leftover keys that collided on every level, sorted (uint64)

The index is a minimal perfect hash by levels: on each level the keys left are hashed to twice as
many bits; keys alone on their bit are settled there and numbered by the count of set bits before
theirs, the others go on.  A look-up tests a few bits, reads one slot, and compares the stored
fingerprint, so an absent key is taken for a present one with a chance of 2**-32.

Shards are written from the tasks to the shared folder, each under a temporary name first and then
renamed, with the same bytes on every attempt, so a repeated or a speculative task does no harm.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import per_batch, text_of
from shelfmark.llm.segments import JOINT, LOWER, numbered, slices, text_numbers

MAGIC = b"TOKSHRD1"
END_ID = 2
SHARD_IDS = 8_000_000  # a shard is closed at the first document that reaches so many ids
PART_BYTES = 64 << 20  # texts dealt to one task
LEVELS = 48
REMEMBERED = 1 << 20  # distinct words whose ids a task keeps
SLICE = 4 << 20  # bytes of text tokenized together
NULL_KEY = 0  # stored for a null doc_id; the byte beside it tells it from a real 0
ROUTED = 65_536  # shard files whose doc_id ranges are broadcast at once

# ---------------------------------------------------------------- hashing


def mixed(values: np.ndarray, seed: int) -> np.ndarray:
    """64 well-mixed bits of each 64-bit value."""
    with np.errstate(over="ignore"):
        h = values.astype(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & (2**64 - 1))
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(31))


def key_hash(ids: np.ndarray, nulls: np.ndarray) -> np.ndarray:
    """One 64-bit number per key; ``mixed`` is a bijection, so two doc_ids never share one.

    The null key has a fixed number.  It never meets a doc_id: shards hold either only null keys or none.
    """
    return np.where(nulls, np.uint64(0xD1B54A32D192ED03), mixed(ids.view(np.uint64), 0))


class Index(NamedTuple):
    sizes: np.ndarray  # bits per level
    words: np.ndarray  # bit arrays of all levels, one after the other
    leftover: np.ndarray


def build_index(keys: np.ndarray) -> Index:
    """A minimal perfect hash of distinct 64-bit ``keys``."""
    left, sizes, arrays = keys, [], []
    for level in range(LEVELS):
        if not len(left):
            break
        size = -(-2 * len(left) // 64) * 64
        at = mixed(left, level + 1) % np.uint64(size)
        alone = np.bincount(at.astype(np.int64), minlength=size) == 1
        arrays.append(np.packbits(alone, bitorder="little").view("<u8"))
        sizes.append(size)
        left = left[~alone[at.astype(np.int64)]]
    words = np.concatenate(arrays) if arrays else np.empty(0, "<u8")
    return Index(np.array(sizes, np.int64), words, np.sort(left))


def hash_numbers(index: Index, keys: np.ndarray) -> np.ndarray:
    """Number of each key, 0 to distinct keys - 1; -1 where the levels already exclude a key."""
    numbers = np.full(len(keys), -1, np.int64)
    before = np.concatenate(([0], np.cumsum(np.bitwise_count(index.words), dtype=np.int64)))
    open_ = np.arange(len(keys))
    first = 0
    for level, size in enumerate(index.sizes):
        at = (mixed(keys[open_], level + 1) % np.uint64(size)).astype(np.int64)
        word, bit = first + at // 64, (at % 64).astype(np.uint64)
        bits = index.words[word]
        there = (bits >> bit) & np.uint64(1) == 1
        lower = bits & ((np.uint64(1) << bit) - np.uint64(1))
        numbers[open_[there]] = (before[word] + np.bitwise_count(lower))[there]
        open_ = open_[~there]
        first += int(size) // 64
    if len(open_) and len(index.leftover):
        place = np.searchsorted(index.leftover, keys[open_])
        found = (place < len(index.leftover)) & (index.leftover[np.minimum(place, len(index.leftover) - 1)] == keys[open_])
        numbers[open_[found]] = before[-1] + place[found]
    return numbers


def stored_fingerprints(keys: np.ndarray) -> np.ndarray:
    return (mixed(keys, 1000) >> np.uint64(32)).astype("<u4")


# ---------------------------------------------------------------- shard files


def shard_bytes(ids: list[np.ndarray], keys: list[int | None], part: int, piece: int, width: int = 4) -> bytes:
    """A whole shard file of documents in ascending order of their keys, with ids of ``width`` bytes."""
    nulls = np.array([k is None for k in keys], bool)
    numbers = np.array([NULL_KEY if k is None else k for k in keys], np.int64)
    ends = np.cumsum([len(i) for i in ids], dtype=np.int64)
    changes = np.ones(len(keys), bool)
    changes[1:] = (numbers[1:] != numbers[:-1]) | (nulls[1:] != nulls[:-1])
    firsts = np.flatnonzero(changes)
    counts = np.diff(np.append(firsts, len(keys)))
    distinct = key_hash(numbers[firsts], nulls[firsts])
    if len(np.unique(distinct)) < len(distinct):
        raise ValueError("the doc_ids of a shard are not in order")
    index = build_index(distinct)
    place = hash_numbers(index, distinct)
    slots = [np.empty(len(firsts), t) for t in ("<u4", "<i8", "<i8")]
    for slot, values in zip(slots, (stored_fingerprints(distinct), firsts, counts)):
        slot[place] = values
    head = [len(keys), int(ends[-1]) if len(ends) else 0, len(firsts), len(index.sizes), len(index.words), len(index.leftover), part, piece, width]
    return b"".join(
        [
            MAGIC,
            np.array(head, "<i8").tobytes(),
            *(i.astype(f"<u{width}").tobytes() for i in ids),
            ends.astype("<i8").tobytes(),
            numbers.astype("<i8").tobytes(),
            nulls.astype(np.uint8).tobytes(),
            index.sizes.astype("<i8").tobytes(),
            index.words.astype("<u8").tobytes(),
            *(s.tobytes() for s in slots),
            index.leftover.astype("<u8").tobytes(),
        ]
    )


class Shard:
    """Keyed access to a shard file; nothing but its index is decoded."""

    def __init__(self, data: bytes):
        if data[:8] != MAGIC:
            raise ValueError("not a token shard")
        documents, ids, distinct, levels, words, leftover, self.part, self.piece, width = np.frombuffer(data, "<i8", 9, 8).tolist()
        at = 80

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            found = np.frombuffer(data, kind, count, at)
            at += found.nbytes
            return found

        self.ids = take(f"<u{width}", ids)
        self.ends = take("<i8", documents)
        self.keys, self.nulls = take("<i8", documents), take("u1", documents).astype(bool)
        sizes, bits = take("<i8", levels), take("<u8", words)
        self.fingerprints, self.firsts, self.counts = take("<u4", distinct), take("<i8", distinct), take("<i8", distinct)
        self.index = Index(sizes, bits, take("<u8", leftover))

    def find(self, keys: np.ndarray, nulls: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first document, documents) of each key; 0 documents where the shard has none."""
        hashed = key_hash(keys, nulls)
        number = hash_numbers(self.index, hashed)
        known = number >= 0
        slot = np.where(known, number, 0)
        if not len(self.fingerprints):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        known &= self.fingerprints[slot] == stored_fingerprints(hashed)
        return np.where(known, self.firsts[slot], 0), np.where(known, self.counts[slot], 0)

    def span(self, document: int) -> tuple[int, int]:
        return (int(self.ends[document - 1]) if document else 0), int(self.ends[document])


# ---------------------------------------------------------------- tokenizing


# Classes of bytes: white space, letters, digits, apostrophe, other ASCII, parts of longer characters.
SPACE, LETTER, DIGIT, APOSTROPHE, MARK, HIGH = range(6)
CLASS = np.full(256, MARK, np.uint8)
CLASS[128:] = HIGH
CLASS[[*range(65, 91), *range(97, 123)]] = LETTER
CLASS[48:58] = DIGIT
CLASS[39] = APOSTROPHE
CLASS[[9, 10, 11, 12, 13, 32]] = SPACE
# Where a text may be cut between two ASCII characters: CUT[6 * class before + class after].
CUT = np.zeros(36, bool)
for _before, _after in (
    (LETTER, DIGIT), (LETTER, APOSTROPHE), (LETTER, MARK), (DIGIT, LETTER), (DIGIT, DIGIT), (DIGIT, APOSTROPHE),
    (DIGIT, MARK), (APOSTROPHE, DIGIT), (MARK, LETTER), (MARK, DIGIT),
):
    CUT[6 * _before + _after] = True


class Encoder:
    """Ids of whole texts, each with an end id.

    With ``spaced``, different pieces of the texts are encoded once each and remembered.  It is for
    tokenizers that drop white space, ignore case, and split into runs of letters, single digits, runs
    of other characters, and an apostrophe with the ending after it.  Their texts may be cut at ASCII
    white space and between ASCII characters as ``CUT`` says: no token spans such a place, and Unicode
    normalisation joins nothing across it.  Pieces are lower-cased in A-Z.  A run of texts that holds a
    special token's text goes to the tokenizer as it is, and so do all without ``spaced``.
    """

    def __init__(self, definition: str, spaced: bool, end_id: int):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark has a task per core already
        from tokenizers import Tokenizer

        self.made_of = (definition, spaced, end_id)
        self.tokenizer = Tokenizer.from_str(definition)
        added = self.tokenizer.get_added_tokens_decoder()
        most = max(self.tokenizer.get_vocab_size(with_added_tokens=True), end_id + 1, *added, 1)
        self.width = 2 if most < 1 << 16 else 4
        self.kind = f"<u{self.width}"
        self.special = [t.content.encode().lower() for t in added.values()]
        self.spaced, self.end = spaced, np.array([end_id], self.kind)
        self.known: dict[bytes, bytes] = {}

    def __reduce__(self):
        # A broadcast encoder is made once per Python worker, whose tasks then share what it remembers.
        return type(self), self.made_of

    def _plain(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(f.ids, self.kind) for f in found]

    def _remember(self, pieces: list[bytes]) -> None:
        """Runs of a-z are what the model gets of them anyway, so they are spared the steps before it."""
        model, pack = self.tokenizer.model, {2: "H", 4: "I"}[self.width]
        other = []
        for piece in pieces:
            if piece.isalpha():  # of bytes: ASCII letters, and these are lower case here
                found = model.tokenize(piece.decode())
                self.known[piece] = struct.pack(f"<{len(found)}{pack}", *[t.id for t in found])
            else:
                other.append(piece)
        for at in range(0, len(other), 4096):
            some = other[at : at + 4096]
            self.known.update(zip(some, (i.tobytes() for i in self._plain([w.decode("utf-8", "surrogatepass") for w in some]))))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if self.spaced:
            raw = [t.encode("utf-8", "surrogatepass") for t in texts]
            joined = LOWER[np.frombuffer(JOINT.join(raw), np.uint8)]
            held = joined.tobytes()
            if not any(t in held for t in self.special):
                return self._by_pieces(raw, joined)
        return [np.concatenate((i, self.end)) for i in self._plain(texts)]

    def _by_pieces(self, raw: list[bytes], joined: np.ndarray) -> list[np.ndarray]:
        kind = CLASS[joined]
        inside = kind != SPACE
        first = inside.copy()
        first[1:] &= ~inside[:-1] | CUT[6 * kind[:-1] + kind[1:]]
        codes, distinct = numbered(joined, inside, first)
        fresh = [w for w in distinct if w not in self.known]
        if len(self.known) + len(fresh) > REMEMBERED:
            self.known.clear()
            fresh = distinct
        self._remember(fresh)
        runs = [self.known[w] for w in distinct]
        lengths = np.fromiter(map(len, runs), np.int64, len(runs)) // self.width
        firsts = np.cumsum(lengths) - lengths
        pool = np.frombuffer(b"".join(runs), self.kind)
        per_piece = lengths[codes]
        ends = np.cumsum(per_piece)
        total = int(ends[-1]) if len(ends) else 0
        ids = pool[np.repeat(firsts[codes] - (ends - per_piece), per_piece) + np.arange(total)]
        of_text = np.bincount(text_numbers(raw, np.flatnonzero(first)), per_piece, len(raw)).astype(np.int64)
        bounds = np.cumsum(of_text)
        return [np.concatenate((ids[b - n : b], self.end)) for b, n in zip(bounds.tolist(), of_text.tolist())]


# ---------------------------------------------------------------- writing


def filesystem(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder that all executors share, and the path in it."""
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    if "://" not in path:
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


def _store(store: fs.FileSystem, path: str, data: bytes) -> None:
    hidden = f"{os.path.dirname(path)}/_{uuid.uuid4().hex}"
    with store.open_output_stream(hidden) as out:
        out.write(data)
    store.move(hidden, path)


MANIFEST = "part int, piece int, file string, n_docs long, n_ids long, least long, most long, has_null boolean"


def _written(folder: str, shared, shard_ids: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come in order within a part; one manifest row per shard file goes out."""
    encoder = shared.value
    store, root = filesystem(folder)
    part, piece, held, ids, keys = None, 0, 0, [], []

    def close() -> pa.RecordBatch:
        nonlocal piece, held, ids, keys
        name = f"ids-{part:08d}-{piece:06d}.tok"
        _store(store, f"{root}/{name}", shard_bytes(ids, keys, part, piece, encoder.width))
        known = [k for k in keys if k is not None]
        row = (part, piece, name, len(keys), held, known[0] if known else None, known[-1] if known else None, keys[0] is None)
        kinds = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_()]
        columns = [pa.array([v], k) for v, k in zip(row, kinds)]
        piece, held, ids, keys = piece + 1, 0, [], []
        return pa.RecordBatch.from_arrays(columns, names=[c.split(" ")[0] for c in MANIFEST.split(", ")])

    for batch in batches:
        parts, doc_ids, texts = (batch.column(i) for i in range(3))
        parts, doc_ids, texts = parts.to_pylist(), doc_ids.to_pylist(), texts.to_pylist()
        at = 0
        for run in slices(texts, SLICE):  # len() of text is characters, near enough for a bound
            for offset, own in enumerate(encoder.encode(run)):
                if keys and (parts[at + offset] != part or (keys[-1] is None) != (doc_ids[at + offset] is None)):
                    yield close()
                if parts[at + offset] != part:
                    part, piece = parts[at + offset], 0
                ids.append(own)
                keys.append(doc_ids[at + offset])
                held += len(own)
                if held >= shard_ids:
                    yield close()
            at += len(run)
    if keys:
        yield close()


def write_shards(
    docs: DataFrame, folder: str, tokenizer: str, *, spaced: bool = False, end_id: int = END_ID, shard_ids: int = SHARD_IDS
) -> DataFrame:
    """Write the ids of every text to shards under ``folder``; the manifest, also kept there.

    Ids are in ascending doc_id order, null doc_ids first; rows with one doc_id go by a hash of their
    text and then by text.  A null text is an empty one.  Every row is written, repeated ones too.
    Parts are ranges of (doc_id, text hash, row number), so even one doc_id with a third of all rows
    fills many parts.  Null doc_ids have shards of their own.  ``tokenizer`` is the path of a definition for the ``tokenizers`` library; its
    text (a few MB, the size of a vocabulary) is broadcast.

    The manifest has one row per shard file and is written as a table, so a reader needs nothing else.
    """
    spark = docs.sparkSession
    with open(tokenizer, encoding="utf-8") as file:
        encoder = spark.sparkContext.broadcast(Encoder(file.read(), spaced, end_id))
    store, root = filesystem(folder)
    store.create_dir(f"{root}/shards", recursive=True)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text")).withColumn("number", F.monotonically_increasing_id())
    size = rows.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // PART_BYTES))
    order = ["doc_id", "tie", "number"]
    dealt = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    dealt = dealt.select(F.spark_partition_id().alias("part"), "doc_id", "text")
    write = per_batch(_written, f"{folder}/shards", encoder, shard_ids)
    dealt.mapInArrow(write, MANIFEST).write.mode("overwrite").parquet(f"{folder}/manifest")
    return spark.read.parquet(f"{folder}/manifest")


# ---------------------------------------------------------------- reading

DOCUMENTS = "file string, doc_id long, local long, n_tokens long, ids_crc32 long"


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every document of a shard through the index: its key's run is looked up, then its ids are cut out."""
    for batch in batches:
        for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
            shard = Shard(content.as_buffer())
            first, count = shard.find(shard.keys, shard.nulls)
            row = np.arange(len(shard.keys))
            if ((row < first) | (row >= first + count)).any():
                raise ValueError(f"the index of {path} misses a document")
            begins = np.concatenate(([0], shard.ends))[:-1]
            raw = shard.ids.astype("<u4").view(np.uint8)
            sums = [zlib.crc32(raw[4 * b : 4 * e]) for b, e in zip(begins, shard.ends)]
            columns = [
                pa.array([os.path.basename(path)] * len(row)),
                pa.array(shard.keys, mask=shard.nulls),
                pa.array(begins),
                pa.array(shard.ends - begins),
                pa.array(sums, pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[c.split(" ")[0] for c in DOCUMENTS.split(", ")])


def shard_starts(manifest: DataFrame) -> DataFrame:
    """file, begins: ids in all shard files before it.

    A running sum over one row per shard file, in two steps: over the parts of a run of files, then
    over the runs.  No step has more than 65,536 rows in a task.
    """
    run = F.floor(F.col("part") / 4096).alias("run")
    inside = Window.partitionBy("run").orderBy("part", "piece").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.select(run, "part", "piece", "file", "n_ids")
    runs = files.groupBy("run").agg(F.sum("n_ids").alias("all_ids"))
    earlier = Window.orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("run", F.coalesce(F.sum("all_ids").over(earlier), F.lit(0)).alias("runs_before"))
    own = files.withColumn("own", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)))
    return own.join(runs, "run").select("file", (F.col("own") + F.col("runs_before")).alias("begins"))


def _contents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.tok").load(f"{folder}/shards").select("path", "content")


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files alone."""
    found = _contents(spark, folder).mapInArrow(_listed, DOCUMENTS)
    starts = shard_starts(spark.read.parquet(f"{folder}/manifest"))
    start = (F.col("begins") + F.col("local")).alias("start")
    return found.join(starts, "file").select("doc_id", start, "n_tokens", "ids_crc32")


def _looked_up(folder: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    store, root = filesystem(folder)
    name, shard = None, None
    for batch in batches:
        files, wanted = batch.column(0).to_pylist(), batch.column(1)
        out_keys, out_ids = [], []
        for file in dict.fromkeys(files):
            if file != name:
                with store.open_input_file(f"{root}/{file}") as source:
                    name, shard = file, Shard(source.read())
            here = wanted.filter(pa.array([f == file for f in files]))
            nulls = here.is_null().to_numpy(zero_copy_only=False)
            first, count = shard.find(here.fill_null(NULL_KEY).to_numpy(zero_copy_only=False).astype(np.int64), nulls)
            for key, f, c in zip(here.to_pylist(), first.tolist(), count.tolist()):
                for document in range(f, f + c):
                    begin, end = shard.span(document)
                    out_keys.append(key)
                    out_ids.append(shard.ids[begin:end].astype(np.int64))
        yield pa.RecordBatch.from_arrays([pa.array(out_keys, pa.int64()), pa.array(out_ids, pa.list_(pa.int64()))], names=["doc_id", "ids"])


def _routes(files: list[str], least: np.ndarray, most: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Files whose range holds a key; ranges ascend and overlap at their ends only."""
    for batch in batches:
        keys = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
        first, last = np.searchsorted(most, keys, "left"), np.searchsorted(least, keys, "right")
        times = np.maximum(0, last - first)
        ends = np.cumsum(times)
        file = np.repeat(first - (ends - times), times) + np.arange(int(times.sum()))
        yield pa.RecordBatch.from_arrays(
            [pa.array([files[f] for f in file], pa.string()), pa.array(np.repeat(keys, times))], names=["file", "wanted"]
        )


def look_up(keys: DataFrame, folder: str, key: Column | str = "doc_id") -> DataFrame:
    """doc_id, ids of every document whose doc_id is among ``keys``; absent keys give no row.

    The doc_id ranges of the manifest, broadcast for at most 65,536 files at a time, tell the few
    files that can hold a key; in the file the index answers.  Each key is sought once, whatever its
    repeats; null is a key too.
    """
    spark = keys.sparkSession
    wanted = keys.select((F.col(key) if isinstance(key, str) else key).cast("long").alias("wanted")).distinct()
    manifest = spark.read.parquet(f"{folder}/manifest")
    named = manifest.where("NOT has_null").select("file", "least", "most")
    null_files = manifest.where("has_null").select("file", F.lit(True).alias("null"))
    probes = null_files.join(wanted.select(F.col("wanted").isNull().alias("null"), "wanted"), "null").select("file", "wanted")
    last = ""
    while rows := named.where(F.col("file") > last).orderBy("file").limit(ROUTED).collect():
        bounds = (np.array([r[c] for r in rows], np.int64) for c in ("least", "most"))
        route = per_batch(_routes, [r["file"] for r in rows], *bounds)
        probes = probes.unionByName(wanted.where("wanted IS NOT NULL").mapInArrow(route, "file string, wanted long"))
        last = rows[-1]["file"]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    probes = probes.repartitionByRange(parts, "file", "wanted").sortWithinPartitions("file", "wanted")
    return probes.mapInArrow(per_batch(_looked_up, f"{folder}/shards"), "doc_id long, ids array<long>")
