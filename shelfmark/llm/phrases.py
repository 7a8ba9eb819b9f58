"""Phrase collocations by tries over word numbers.

1. Texts are cut into words once, slice by slice; every later pass reads the words of a slice and their
   numbers.
2. Words are counted; those with at least ``least`` occurrences are frequent.
3. Level by level a k-phrase can only be frequent if both its (k-1)-phrases are (Apriori).  A pass over
   the slices hashes the phrases whose two parts pass a bitmap of the level below; Spark sums the counts
   by hash, and the hashes that reach ``least`` make the bitmap of this level.  Bitmaps have a fixed
   size, and a hash has several bits in one; a phrase that shares all its bits with frequent ones is
   only a candidate too many.
4. A pass names the phrases that pass the bitmaps: the candidates, a superset of all frequent phrases.
5. Candidates are numbered in double-array tries of bounded size, dealt by their first two words: a
   place of a text belongs to one trie.  Several tries are broadcast for a pass; every task advances the
   states of all its places in a trie together, one word further at each level, and adds up the
   accepting states by ``bincount``.  A task's counts are a few packed runs, which Spark sums.

Counts, not hashes, decide: the tries count exactly.  A text is whole in one task, in numpy arrays.
"""

from __future__ import annotations

import gc
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import cut, per_batch, small, text_of
from shelfmark.llm.segments import Words, classes, cut_words, slices
from shelfmark.session import scratch_path

KINDS = classes(b" \t", b".,;:!?\n\x0b\x0c\r")
LONGEST = 5
LEAST = 100
SLICE = 4 << 20  # bytes of text in numpy arrays together
BITS = 26  # a bitmap has 2**26 bits (8 MB) whatever the corpus
PROBES = 4  # bits of a hash in a bitmap
HASH_BITS = 40  # of a phrase's hash that are counted
TRIE_MOST = 400_000  # candidates of a trie, on average
TRIES = 4  # broadcast for one pass
CHUNK, TASKS = 8192, 64  # counts in a run, and tasks whose runs or lists are put together at once
NAMES = 4096  # phrases in a list, on average
TAG = "\t"  # between phrase and lang; no phrase has one
NO_LANG = "und"
MIX = np.uint64(0x9E3779B97F4A7C15)

# ---------------------------------------------------------------- texts to word numbers


SLICED = "lang string, words binary, codes binary"
BETWEEN = b"\n"  # between the words of a slice; none has a break


def _rows(docs: DataFrame) -> DataFrame:
    """What a pass reads: lang and text of documents, or what ``slices_of`` them has."""
    if docs.columns == ["lang", "words", "codes"]:
        return docs
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANG)).alias("lang"), text_of().alias("text"))


def _squeezed(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + pa.compress(data, "zstd", asbytes=True)


def _whole(data: bytes) -> bytes:
    return pa.decompress(data[8:], int.from_bytes(data[:8], "little"), "zstd", asbytes=True)


def _packed(words: Words) -> tuple[bytes, bytes]:
    """The different words; word numbers from 1 on, a 0 at each break: their lowest bytes, their second bytes, and so on."""
    codes = np.insert(words.codes.astype("<i4") + 1, np.flatnonzero(np.diff(words.pieces)) + 1, 0)
    return _squeezed(BETWEEN.join(words.distinct)), _squeezed(codes.view(np.uint8).reshape(-1, 4).T.tobytes())


def _opened(distinct: bytes, packed: bytes) -> Words:
    distinct, packed = _whole(distinct), _whole(packed)
    codes = np.frombuffer(packed, np.uint8).reshape(4, -1).T.copy().view("<i4").ravel()
    inside = codes > 0
    pieces = np.cumsum(~inside, dtype=np.int32)[inside]
    return Words(codes[inside].astype(np.int64) - 1, distinct.split(BETWEEN) if distinct else [], pieces, np.empty(0, np.int64))


def _sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, Words]]:
    """(lang, words) of slices of the texts of one language; only a slice's texts leave the batch at a time."""
    for batch in batches:
        if "codes" in batch.schema.names:
            for lang, distinct, packed in zip(*batch.columns):
                yield lang.as_py(), _opened(distinct.as_py(), packed.as_py())
            continue
        langs, texts = batch.column(0).dictionary_encode(), batch.column(1).cast(pa.binary())
        numbers = langs.indices.to_numpy()
        for number, lang in enumerate(langs.dictionary.to_pylist()):
            own = np.flatnonzero(numbers == number).tolist()
            for run in slices((texts[i].as_py() for i in own), SLICE):
                yield lang, cut_words(run, KINDS, lower=True)


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for lang, words in _sliced(batches):
        columns = [pa.array([lang]), *(pa.array([packed], pa.binary()) for packed in _packed(words))]
        yield pa.RecordBatch.from_arrays(columns, names=["lang", "words", "codes"])


def _let_go(spark: SparkSession) -> None:
    """Have Spark delete the shuffle files of passes that have ended; else they lie until the driver collects garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def slices_of(docs: DataFrame) -> DataFrame:
    """The texts cut into words, a row per slice, in the shared folder."""
    path = scratch_path(docs.sparkSession, "slices")
    _rows(docs).mapInArrow(_pack, SLICED).write.option("compression", "none").parquet(path)
    return docs.sparkSession.read.schema(SLICED).parquet(path)


def _phrases(words: Words, at: np.ndarray, length: int) -> pa.Array:
    """The phrases of ``length`` words that start at the positions ``at``, space-joined."""
    known = pa.array(words.distinct, pa.binary())
    columns = [known.take(pa.array(words.codes[at + i])) for i in range(length)]
    joined = columns[0] if length == 1 else pa.compute.binary_join_element_wise(*columns, pa.scalar(b" "))
    return joined.cast(pa.string())


def _fits(words: Words, length: int) -> np.ndarray:
    """Which positions have ``length`` words left in their piece."""
    count = len(words.codes)
    fits = np.zeros(count, bool)
    if count >= length:
        fits[: count - length + 1] = words.pieces[: count - length + 1] == words.pieces[length - 1 :]
    return fits


# ---------------------------------------------------------------- words


COUNTED = "lang string, phrase string, f long"


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of the words of each slice, and their sum under a null word."""
    for lang, words in _sliced(batches):
        counts = np.bincount(words.codes, minlength=len(words.distinct))
        phrases = pa.array(words.distinct + [None], pa.binary()).cast(pa.string())
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(phrases)), phrases, pa.array(np.append(counts, len(words.codes)))], names=["lang", "phrase", "f"]
        )


def word_counts(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """(lang, phrase, f) of frequent words; a null phrase has the number of all word occurrences."""
    counted = _rows(docs).mapInArrow(_count_words, COUNTED).groupBy("lang", "phrase").agg(F.sum("f").alias("f"))
    return cut(counted.where((F.col("f") >= least) | F.col("phrase").isNull()))


# ---------------------------------------------------------------- candidates


def _scrambled(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def _word_hashes(lang: str, words: list[bytes]) -> np.ndarray:
    """A 64-bit hash of each word in its language."""
    digest, seed = xxhash.xxh3_64_intdigest, xxhash.xxh3_64_intdigest(lang.encode())
    return np.fromiter((digest(w, seed) for w in words), np.uint64, len(words))


def phrase_hashes(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hash of the ``length`` words from each position on; the last positions have none."""
    return _hashes_at(hashes, np.arange(max(0, len(hashes) - length + 1)), length)


def _hashes_at(hashes: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """Hash of the ``length`` words from each of the positions ``at`` on."""
    with np.errstate(over="ignore"):
        total = hashes[at]
        for i in range(1, length):
            total = _scrambled(total * MIX + hashes[at + i])
        return total


def _passes(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether the bitmap has all bits of each hash, those that ``bitmap_of`` sets."""
    mask, shift = np.uint64((1 << BITS) - 1), np.uint64(HASH_BITS - BITS)
    left = np.arange(len(hashes))
    for probe in range(PROBES):
        own = hashes[left] & np.uint64((1 << HASH_BITS) - 1)
        bit = (own + np.uint64(probe) * (own >> shift | np.uint64(1))) & mask
        left = left[(bitmap[(bit >> np.uint64(3)).view(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1]
    passes = np.zeros(len(hashes), bool)
    passes[left] = True
    return passes


def _safe(words: Words, known: np.ndarray, bitmap: np.ndarray, length: int) -> np.ndarray:
    """Positions of phrases of ``length`` words, both of whose parts one word shorter pass the bitmap."""
    if length == 2:
        parts = _passes(bitmap, known)[words.codes]
    else:
        parts = _passes(bitmap, phrase_hashes(known[words.codes], length - 1))
    fits = np.flatnonzero(_fits(words, length))
    return fits[parts[fits] & parts[fits + 1]]


def _count_hashes(bitmap, length: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for lang, words in _sliced(batches):
        known = _word_hashes(lang, words.distinct)
        at = _safe(words, known, bitmap.value, length)
        own = _hashes_at(known[words.codes], at, length) & np.uint64((1 << HASH_BITS) - 1)
        found, counts = np.unique(own, return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(counts)], names=["hash", "f"])


def _name(bitmaps, buckets: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The different phrases of a slice that pass the bitmaps of their level, a list per bucket."""
    for lang, words in _sliced(batches):
        hashes = _word_hashes(lang, words.distinct)[words.codes]
        before = None  # which positions pass, one word shorter
        for length, bitmap in bitmaps.value.items():
            fits = _fits(words, length)
            if before is not None:
                fits[:-1] &= before[:-1] & before[1:]
            at = np.flatnonzero(fits)
            own = _hashes_at(hashes, at, length)
            passing = _passes(bitmap, own)
            at, own = at[passing], own[passing]
            before = np.zeros(len(fits), bool)
            before[at] = True
            keys = words.codes[at]
            for i in range(1, length):  # numbers of different phrases, one word longer each time
                _, keys = np.unique(keys * len(words.distinct) + words.codes[at + i], return_inverse=True)
            _, first = np.unique(keys, return_index=True)
            at, own = at[first], own[first]
            bucket = ((own >> np.uint64(32)) % np.uint64(buckets)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            bucket = bucket[order]
            tagged = pa.compute.binary_join_element_wise(_phrases(words, at[order], length), pa.scalar(lang), pa.scalar(TAG))
            starts = np.flatnonzero(np.diff(bucket, prepend=-1))
            offsets = pa.array(np.append(starts, len(bucket)).astype(np.int32))
            lists = pa.ListArray.from_arrays(offsets, tagged)
            yield pa.RecordBatch.from_arrays([pa.array(bucket[starts]), lists], names=["bucket", "phrases"])


def _unite(group: pa.Table) -> pa.Table:
    phrases = pa.compute.unique(pa.compute.list_flatten(group["phrases"]))
    part = group["part"][0].as_py() // TASKS
    columns = [group["bucket"][:1].combine_chunks(), pa.array([part], pa.int32()), pa.ListArray.from_arrays(pa.array([0, len(phrases)], pa.int32()), phrases)]
    return pa.table(columns, names=["bucket", "part", "phrases"])


def _named(rows: DataFrame, bitmaps, buckets: int) -> DataFrame:
    """(lang, phrase) of every phrase that passes, once: the lists of ``TASKS`` tasks unite in each round."""
    lists = rows.mapInArrow(per_batch(_name, bitmaps, buckets), "bucket int, phrases array<string>")
    lists = lists.select("bucket", F.spark_partition_id().alias("part"), "phrases")
    tasks = rows.rdd.getNumPartitions()
    while True:
        lists = lists.groupBy("bucket", F.floor(F.col("part") / TASKS)).applyInArrow(_unite, "bucket int, part int, phrases array<string>")
        if tasks <= TASKS:
            break
        tasks = -(-tasks // TASKS)
    parts = F.split(F.col("tagged"), TAG, 2)
    return lists.select(F.explode("phrases").alias("tagged")).select(parts[1].alias("lang"), parts[0].alias("phrase"))


def _hash_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    digest = xxhash.xxh3_64_intdigest
    for batch in batches:
        pairs = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
        found = np.array([digest(w.encode(), digest(lang.encode())) for lang, w in pairs], np.uint64)
        yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64))], names=["hash"])


def bitmap_of(hashes: DataFrame) -> np.ndarray | None:
    """``PROBES`` bits of each ``hash`` in a bitmap of fixed size, built by Spark; None without any."""
    own = F.col("hash").bitwiseAND((1 << HASH_BITS) - 1)
    step = F.shiftright(own, HASH_BITS - BITS).bitwiseOR(1)
    bits = F.array(*[(own + probe * step).bitwiseAND((1 << BITS) - 1) + 1 for probe in range(PROBES)])
    at = F.col("at")
    parts = hashes.select(F.explode(bits).alias("at")).groupBy(F.bitmap_bucket_number(at).alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits"))
    rows = parts.collect()  # at most 2**BITS / 32768 rows of 4096 bytes
    if not rows:
        return None
    bitmap = np.zeros(1 << BITS >> 3, np.uint8)
    for row in rows:
        own = np.frombuffer(row["bits"], np.uint8)
        bitmap[(row["part"] - 1) * 4096 :][: len(own)] = own
    return bitmap


def candidates(docs: DataFrame, words: DataFrame, least: int = LEAST, longest: int = LONGEST) -> DataFrame:
    """(lang, phrase): every phrase of 2 to ``longest`` words that can reach ``least`` occurrences."""
    spark, rows = docs.sparkSession, _rows(docs)
    frequent = words.where("phrase IS NOT NULL").select("lang", "phrase")
    bitmap = bitmap_of(frequent.mapInArrow(_hash_words, "hash long"))
    bitmaps: dict[int, np.ndarray] = {}
    for length in range(2, longest + 1):
        if bitmap is None:
            break
        below = spark.sparkContext.broadcast(bitmap)
        counted = rows.mapInArrow(per_batch(_count_hashes, below, length), "hash long, f long")
        bitmap = bitmap_of(counted.groupBy("hash").agg(F.sum("f").alias("f")).where(F.col("f") >= least))
        below.unpersist()
        del counted
        _let_go(spark)
        if bitmap is not None:
            bitmaps[length] = bitmap
    passing = sum(int(np.bitwise_count(b).sum(dtype=np.int64)) for b in bitmaps.values())
    named = cut(_named(rows, spark.sparkContext.broadcast(bitmaps), 1 + passing // NAMES))
    _let_go(spark)
    return named


# ---------------------------------------------------------------- tries


class Trie(NamedTuple):
    """State s goes on with symbol c to t = base[s] + c where check[t] = s; accept[t] is a phrase or -1."""

    base: np.ndarray
    check: np.ndarray
    accept: np.ndarray
    roots: dict[str, int]
    symbols: dict[str, dict[bytes, int]]  # per language, from 1
    langs: pa.Array
    phrases: pa.Array


FREE, ROOT, LEAF = -1, -2, -(1 << 40)
WIDE = 128  # children from which on a state isn't tried where larger ones didn't fit


class _Slots:
    """The slots of a double array while it is filled."""

    def __init__(self, count: int):
        self.check = np.full(count, FREE, np.int64)

    def grow(self, count: int) -> None:
        if count > len(self.check):
            self.check = np.append(self.check, np.full(count, FREE, np.int64))

    def singles(self, symbols: np.ndarray, parents: np.ndarray) -> np.ndarray:
        """Bases of states with one child each: any free slot does."""
        self.grow(int((self.check != FREE).sum()) + len(symbols))
        slots = np.flatnonzero(self.check == FREE)[: len(symbols)]
        self.check[slots] = parents
        return slots - symbols

    def several(self, symbols: np.ndarray, parent: int, cursor: int) -> tuple[int, int]:
        """Base of a state with children, the first that fits from ``cursor`` on."""
        gaps = symbols - symbols[0]
        while True:
            self.grow(cursor + 1024 + int(gaps[-1]))
            fits = np.flatnonzero(self.check[cursor : cursor + 1024] == FREE) + cursor
            for gap in gaps[1:]:
                if not len(fits):
                    break
                fits = fits[self.check[fits + gap] == FREE]
            if len(fits):
                self.check[fits[0] + gaps] = parent
                return int(fits[0] - symbols[0]), cursor
            cursor += 1024


def build_trie(rows: list[tuple[str, str]] | pa.Table) -> Trie:
    """A double array over (lang, phrase) pairs that are all different."""
    table = rows if isinstance(rows, pa.Table) else pa.table({"lang": pa.array([r[0] for r in rows], pa.string()), "phrase": pa.array([r[1] for r in rows], pa.string())})
    langs, phrases = (table[name].combine_chunks() for name in ("lang", "phrase"))
    split = pa.compute.split_pattern(phrases, " ")
    lengths = pa.compute.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
    own_langs = langs.dictionary_encode()
    numbers = own_langs.indices.to_numpy()
    places, flat = np.repeat(numbers, lengths), pa.compute.list_flatten(split).cast(pa.binary())
    symbols: dict[str, dict[bytes, int]] = {}
    codes = np.zeros((len(lengths), int(lengths.max(initial=1))), np.int64)
    inside = np.arange(codes.shape[1]) < lengths[:, None]
    for number, lang in enumerate(own_langs.dictionary.to_pylist()):
        own = flat.filter(pa.array(places == number)).dictionary_encode()
        symbols[lang] = {w: i for i, w in enumerate(own.dictionary.to_pylist(), 1)}
        codes[inside & (numbers == number)[:, None]] = own.indices.to_numpy() + 1
    roots = {lang: i for i, lang in enumerate(symbols)}
    most = max((len(own) for own in symbols.values()), default=0) + 1
    slots = _Slots(len(roots) + most + len(lengths))
    slots.check[: len(roots)] = ROOT
    base = {}  # level by level: states and their bases
    state = numbers.astype(np.int64)
    accept_at, accept_row = [], []
    for depth in range(codes.shape[1]):
        alive = np.flatnonzero(lengths > depth)
        if not len(alive):
            break
        keys, back = np.unique(state[alive] * most + codes[alive, depth], return_inverse=True)
        parents, own = keys // most, keys % most
        firsts = np.flatnonzero(np.append(True, parents[1:] != parents[:-1]))
        counts = np.diff(np.append(firsts, len(keys)))
        bases = np.empty(len(firsts), np.int64)
        cursor, before = 0, None
        for i in np.argsort(-counts, kind="stable"):
            if counts[i] == 1:
                break
            if counts[i] != before and counts[i] < WIDE:
                cursor, before = 0, counts[i]
            bases[i], cursor = slots.several(own[firsts[i] : firsts[i] + counts[i]], int(parents[firsts[i]]), cursor)
        one = np.flatnonzero(counts == 1)
        bases[one] = slots.singles(own[firsts[one]], parents[firsts[one]])
        base[depth] = (parents[firsts], bases)
        state = state.copy()
        state[alive] = (np.repeat(bases, counts) + own)[back]
        done = alive[lengths[alive] == depth + 1]
        accept_at.append(state[done])
        accept_row.append(done)
    size = len(slots.check)
    bases, accept = np.full(size, LEAF, np.int64), np.full(size, -1, np.int64)
    for states, values in base.values():
        bases[states] = values
    if accept_at:
        accept[np.concatenate(accept_at)] = np.concatenate(accept_row)
    return Trie(bases, slots.check, accept, roots, symbols, langs, phrases)


def step(trie: Trie, states: np.ndarray, symbols: np.ndarray) -> np.ndarray:
    """Next state of each, -1 where there is none."""
    to = trie.base[states] + symbols
    there = (to >= 0) & (to < len(trie.check))
    to = np.where(there, to, 0)
    return np.where(there & (trie.check[to] == states), to, -1)


class Sent(NamedTuple):
    """A trie of a pass in fewer bytes, for words numbered over the tries of the pass."""

    base: np.ndarray
    check: np.ndarray
    accept: np.ndarray
    roots: dict[str, int]
    symbols: dict[str, np.ndarray]  # of each word number; the last, 0, is of words that no trie has
    first: int  # place of the trie's first phrase among those of the pass
    count: int


def sent(tries: dict[int, Trie]) -> tuple[dict[str, pa.Array], dict[int, Sent]]:
    """(words per language, tries by their number) for a pass."""
    words = {}
    for lang in {lang for trie in tries.values() for lang in trie.symbols}:
        own = [pa.array(list(trie.symbols.get(lang, ())), pa.binary()) for trie in tries.values()]
        words[lang] = pa.concat_arrays(own).unique()
    out, first = {}, 0
    for number, trie in tries.items():
        symbols = {}
        for lang, known in trie.symbols.items():
            symbols[lang] = np.zeros(len(words[lang]) + 1, np.int32)
            at = pa.compute.index_in(pa.array(list(known), pa.binary()), value_set=words[lang])
            symbols[lang][at.to_numpy()] = np.arange(1, len(known) + 1)
        arrays = (np.maximum(trie.base, -(1 << 30)), trie.check, trie.accept)
        out[number] = Sent(*(x.astype(np.int32) for x in arrays), trie.roots, symbols, first, len(trie.phrases))
        first += len(trie.phrases)
    return words, out


def count_phrases(trie: Sent, lang: str, numbers: np.ndarray, pieces: np.ndarray, at: np.ndarray, totals: np.ndarray) -> None:
    """Add the trie's phrases that start ``at`` places of a text of word ``numbers``, all advancing together, a word a level."""
    if lang not in trie.roots:
        return
    symbols, own = trie.symbols[lang], totals[trie.first : trie.first + trie.count]
    states = step(trie, np.full(len(at), trie.roots[lang]), symbols[numbers[at]])
    length = 1
    while True:
        alive = states >= 0
        at, states = at[alive], states[alive]
        found = trie.accept[states]
        own += np.bincount(found[found >= 0], minlength=len(own))
        length += 1
        inside = at + length - 1 < len(numbers)
        at, states = at[inside], states[inside]
        inside = pieces[at] == pieces[at + length - 1]
        at, states = at[inside], states[inside]
        if not len(at):
            return
        states = step(trie, states, symbols[numbers[at + length - 1]])


def _dealt(hashes: np.ndarray, at: np.ndarray, tries: int) -> np.ndarray:
    """The number of the trie of what starts ``at`` places, by its first two words."""
    return ((_hashes_at(hashes, at, 2) >> np.uint64(32)) % np.uint64(tries)).astype(np.int32)


def _deal(tries: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    digest = xxhash.xxh3_64_intdigest
    for batch in batches:
        langs = batch.column(0).to_pylist()
        seeds = {lang: digest(lang.encode()) for lang in set(langs)}
        split = (phrase.split(b" ", 2)[:2] for phrase in batch.column(1).cast(pa.binary()).to_pylist())
        hashes = np.array([digest(w, seeds[lang]) for lang, two in zip(langs, split) for w in two], np.uint64)
        numbers = pa.array(_dealt(hashes, np.arange(0, len(hashes), 2), tries))
        yield pa.RecordBatch.from_arrays([numbers, *batch.columns], names=["trie", "lang", "phrase"])


RUNS = "chunk int, part int, places binary, counts binary"


def _run(chunk: int, part: int, counts: np.ndarray) -> pa.Table:
    """Counts of a chunk without zeros: 16-bit places and 64-bit counts."""
    seen = np.flatnonzero(counts)
    columns = [pa.array([chunk], pa.int32()), pa.array([part], pa.int32())]
    columns += [pa.array([seen.astype("<u2").tobytes()], pa.binary()), pa.array([counts[seen].astype("<i8").tobytes()], pa.binary())]
    return pa.table(columns, names=["chunk", "part", "places", "counts"])


def _count_in_tries(pass_, every: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's counts in some of ``every`` tries, as runs of ``CHUNK`` phrases; runs of zeros are left out."""
    known, tries = pass_.value
    totals = np.zeros(sum(trie.count for trie in tries.values()), np.int64)
    for lang, words in _sliced(batches):
        if lang not in known:
            continue
        found = pa.compute.index_in(pa.array(words.distinct, pa.binary()), value_set=known[lang])
        numbers = pa.compute.fill_null(found, -1).to_numpy(zero_copy_only=False)[words.codes]
        at = np.flatnonzero(_fits(words, 2))
        at = at[(numbers[at] >= 0) & (numbers[at + 1] >= 0)]
        dealt = _dealt(_word_hashes(lang, words.distinct)[words.codes], at, every)
        for number, trie in tries.items():
            count_phrases(trie, lang, numbers, words.pieces, at[dealt == number], totals)
    for chunk in range(-(-len(totals) // CHUNK)):
        own = totals[chunk * CHUNK : (chunk + 1) * CHUNK]
        if own.any():
            yield from _run(chunk, 0, own).to_batches()


def _sum_runs(group: pa.Table) -> pa.Table:
    places, counts = (np.concatenate([np.frombuffer(b.as_py(), kind) for b in group[name]]) for name, kind in (("places", "<u2"), ("counts", "<i8")))
    total = np.zeros(CHUNK, np.int64)
    np.add.at(total, places, counts)
    return _run(group["chunk"][0].as_py(), group["part"][0].as_py() // TASKS, total)


def _summed(counted: DataFrame, tasks: int) -> DataFrame:
    """One run per chunk: the runs of ``TASKS`` tasks are added in each round, 5 MB in a group."""
    runs = counted.withColumn("part", F.spark_partition_id())
    while tasks > 1:
        runs = runs.groupBy("chunk", F.floor(F.col("part") / TASKS)).applyInArrow(_sum_runs, RUNS)
        tasks = -(-tasks // TASKS)
    return runs


def _unpacked(names, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for chunk, places, counts in zip(batch["chunk"], batch["places"], batch["counts"]):
            at = pa.array(chunk.as_py() * CHUNK + np.frombuffer(places.as_py(), "<u2").astype(np.int64))
            columns = [*(names.value[name].take(at).combine_chunks() for name in ("lang", "phrase")), pa.array(np.frombuffer(counts.as_py(), "<i8"))]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "phrase", "f"])


def phrase_counts(docs: DataFrame, named: DataFrame, trie_most: int = TRIE_MOST) -> DataFrame:
    """(lang, phrase, f) of the candidates ``named``, by one pass over the texts per ``TRIES`` tries.

    A trie has about ``trie_most`` candidates, dealt by the hash of their first two words, whatever their number.
    """
    spark, rows = docs.sparkSession, _rows(docs)
    every = max(1, -(-named.count() // trie_most))
    dealt = cut(named.select("lang", "phrase").mapInArrow(per_batch(_deal, every), "trie int, lang string, phrase string"))
    path = scratch_path(spark, "phrases")
    for start in range(0, every, TRIES):
        tries = {}
        for number in range(start, min(start + TRIES, every)):
            tries[number] = build_trie(dealt.where(F.col("trie") == number).select("lang", "phrase").toArrow())
        names = pa.table({"lang": pa.concat_arrays([t.langs for t in tries.values()]), "phrase": pa.concat_arrays([t.phrases for t in tries.values()])})
        pass_, names = (spark.sparkContext.broadcast(x) for x in (sent(tries), names))
        counted = rows.mapInArrow(per_batch(_count_in_tries, pass_, every), RUNS)
        summed = _summed(counted, rows.rdd.getNumPartitions())
        summed.mapInArrow(per_batch(_unpacked, names), COUNTED).write.mode("append").parquet(path)
        pass_.unpersist()
        names.unpersist()
        del counted, summed, tries
        _let_go(spark)
    return spark.read.schema(COUNTED).parquet(path)


# ---------------------------------------------------------------- scores


def _part(first: Column, count: Column) -> Column:
    return F.array_join(F.slice("words", first, count), " ")


def collocations(docs: DataFrame, *, least: int = LEAST, longest: int = LONGEST, top: int = 2000, contained: int = 100) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's ``top`` phrases.

    Texts (a null one is empty) are lower-cased in A-Z, cut into pieces at ``. , ; : ! ?`` and line
    ends, and into words at spaces and tabs; a null lang is ``und``.  a is the number of occurrences of
    a phrase of 2 to ``longest`` words within pieces, at least ``least``; l and r those of its two
    parts at the cut with the lowest score floor(1000 a n / (l r)), n all words of the language.
    Phrases inside a longer candidate with at least ``contained`` % of their occurrences are dropped.
    Ties go by a, then by phrase in byte order.  Repeated documents count as often as they occur.
    """
    docs = slices_of(docs)
    words = word_counts(docs, least)
    _let_go(docs.sparkSession)
    known = words.where("phrase IS NOT NULL")
    totals = words.where("phrase IS NULL").select("lang", F.col("f").alias("n"))
    counted = phrase_counts(docs, candidates(docs, words, least, longest)).where(F.col("f") >= least)
    counted = cut(counted)
    every = known.unionByName(counted)
    own = counted.select("lang", "phrase", F.col("f").alias("a"), F.split("phrase", " ").alias("words"))

    places = F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k")
    cuts = own.select("lang", "phrase", "a", "words", places)
    cuts = cuts.withColumn("first", _part(F.lit(1), F.col("k"))).withColumn("rest", _part(F.col("k") + 1, F.size("words") - F.col("k")))
    left = every.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    right = every.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    scored = cuts.drop("words").join(left, ["lang", "first"]).join(right, ["lang", "rest"]).join(small(totals, 100_000), "lang")
    wide = "cast({} as decimal(19,0))".format
    score = F.expr(f"(1000 * {wide('a')} * {wide('n')}) div ({wide('l')} * {wide('r')})")
    lowest = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("lowest")
    scored = scored.groupBy("lang", "phrase").agg(F.first("a").alias("a"), F.first("n").alias("n"), lowest)

    spans = F.expr(
        "filter(flatten(transform(sequence(1, size(words) - 1), i -> "
        "transform(sequence(2, size(words)), m -> if(i + m - 1 <= size(words) and m < size(words), array_join(slice(words, i, m), ' '), null)))), "
        "x -> x is not null)"
    )
    inner = own.where(F.size("words") > 2).select("lang", F.explode(spans).alias("phrase"), "a")
    inner = inner.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = scored.join(inner, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (100 * F.col("longer") < contained * F.col("a")))
    kept = kept.select("lang", "phrase", "a", "n", "lowest.score", "lowest.l", "lowest.r")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))
