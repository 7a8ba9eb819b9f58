"""Benchmark decontamination by the q-gram lemma.

Texts are compared as lower-case letters and digits with single spaces.  If a passage of m
characters occurs in a document with at most k edits, they share at least m - q + 1 - k q of its
q-grams, on diagonals (place in the document minus place in the passage) that differ by at most k.
So shared q-grams are counted in bands of diagonals 2k wide that overlap by half, bands that reach
the bound become regions, and a banded alignment of passage and region has the last word.

The benchmark is the small side.  It is read in blocks of bounded size, each a table of q-grams
that every task gets; documents are searched where they lie, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import per_batch, text_of

Q = 12
RATE = 0.06  # edits allowed per character of a passage
SHORTEST = 48  # shorter passages have to occur without an edit
BLOCK_CHARS = 4_000_000
SLICE = 400_000  # characters searched together
FILTER_BITS = 22
LIMIT = 4_000_000  # shared places of passages held at once
WALL = np.uint32(0x110000)  # beyond Unicode, so no text holds it


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Lower case of each 16-bit code point, and whether it is a letter or digit."""
    lower = np.arange(65536, dtype=np.uint32)
    known = np.zeros(65536, bool)
    for c in range(65536):
        x = chr(c)
        known[c] = x.isalnum()
        small = x.lower()
        if len(small) == 1:
            lower[c] = ord(small)
    return lower, known


LOWER, ALNUM = _tables()
SPACE = np.uint32(32)


def normal(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(normalised code points, place of each in the input); others than letters, digits part words."""
    low = points < 65536
    index = np.where(low, points, 0)
    kept = np.where(low, ALNUM[index], True)
    values = np.where(kept, np.where(low, LOWER[index], points), SPACE)
    keep = kept.copy()
    keep[1:] |= kept[:-1]  # of a run of separators only the first stays
    places = np.flatnonzero(keep)
    return values[places], places


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def gram_hashes(points: np.ndarray, q: int) -> np.ndarray:
    """A 64-bit hash of every ``q`` consecutive code points."""
    count = len(points) - q + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    base = np.uint64(0x9E3779B97F4A7C15)
    total, start = np.zeros(count, np.uint64), 0
    power, width, step, rest = points.astype(np.uint64), 1, base, q
    with np.errstate(over="ignore"):
        while rest:
            if rest & 1:
                total = total * step + power[start : start + count]
                start += width
            rest >>= 1
            if rest:
                power = power[:-width] * step + power[width:]
                step = step * step
                width *= 2
        total = (total ^ (total >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return total


class Passages(NamedTuple):
    """A block of the benchmark: its passages and an index of their q-grams."""

    ids: list
    points: list[np.ndarray]
    grams: np.ndarray  # sorted
    owner: np.ndarray  # of each occurrence, by gram, passage and place
    place: np.ndarray
    runs: np.ndarray  # gram number times passages plus passage, sorted, for every gram a passage has
    run_first: np.ndarray  # where each run's occurrences start
    bitmap: np.ndarray


def index(items: list[tuple], q: int = Q) -> Passages:
    """Index (id, text) passages; those without a letter or digit are left out."""
    ids, points, grams, owner, place = [], [], [], [], []
    for item_id, text in items:
        own, _ = normal(code_points(text or ""))
        own = np.trim_zeros(np.where(own == SPACE, 0, own))
        own = np.where(own == 0, SPACE, own).astype(np.uint32)
        if not len(own):
            continue
        hashes = gram_hashes(own, min(q, len(own)))
        if len(own) >= q:
            grams.append(hashes)
            owner.append(np.full(len(hashes), len(ids), np.int32))
            place.append(np.arange(len(hashes), dtype=np.int32))
        ids.append(item_id)
        points.append(own)
    if not grams:
        empty = np.empty(0, np.int32)
        none = np.empty(0, np.int64)
        return Passages(ids, points, np.empty(0, np.uint64), empty, empty, none, np.zeros(1, np.int64), np.zeros(1 << FILTER_BITS, bool))
    every, owners, places = np.concatenate(grams), np.concatenate(owner), np.concatenate(place)
    order = np.argsort(every, kind="stable")
    distinct, number = np.unique(every[order], return_inverse=True)
    runs, run_first = np.unique(number.astype(np.int64) * len(ids) + owners[order], return_index=True)
    bitmap = np.zeros(1 << FILTER_BITS, bool)
    bitmap[distinct >> np.uint64(64 - FILTER_BITS)] = True
    return Passages(ids, points, distinct, owners[order], places[order], runs, np.append(run_first, len(every)), bitmap)


def budget(length: int, rate: float, shortest: int = SHORTEST) -> int:
    return int(length * rate) if length >= shortest else 0


def align(passage: np.ndarray, region: np.ndarray, k: int) -> tuple[int, int, int] | None:
    """(edits, start, end) of the best occurrence of the passage in the region with at most k edits.

    The passage must be used up, the region may have anything around it.  The region is at most a
    band of diagonals wider than the passage, so the table is one row of about that width per
    character of the passage.
    """
    width, far = len(region), len(passage) + k + 1
    cost = np.zeros(width + 1, np.int64)
    start = np.arange(width + 1)
    steps = np.arange(width + 1)
    for i, c in enumerate(passage):
        changed = cost[:-1] + (region != c)
        dropped = cost[1:] + 1
        take = changed <= dropped
        best = np.concatenate(([i + 1], np.where(take, changed, dropped)))
        begin = np.concatenate(([0], np.where(take, start[:-1], start[1:])))
        # Insertions: a running minimum of cost minus place.
        low = np.minimum.accumulate(best - steps)
        source = np.maximum.accumulate(np.where(best - steps == low, steps, 0))
        cost, start = low + steps, begin[source]
        cost = np.minimum(cost, far)
        if cost.min() > k:
            return None
    end = int(np.argmin(cost))
    return (int(cost[end]), int(start[end]), end) if cost[end] <= k else None


def matches(texts: list[str], passages: Passages, q: int = Q, rate: float = RATE) -> list[tuple[int, int, int, int, int]]:
    """(text number, passage number, start, end, edits) of passages found, in characters of the text."""
    found = []
    parts: list[np.ndarray] = []
    numbers: list[int] = []
    size = 0
    for number, text in enumerate(texts):
        parts.append(code_points(text))
        numbers.append(number)
        size += len(parts[-1]) + 1
        if size >= SLICE:
            found += _search(parts, numbers, passages, q, rate)
            parts, numbers, size = [], [], 0
    return found + (_search(parts, numbers, passages, q, rate) if parts else [])


def _regions(
    where: np.ndarray, docs: np.ndarray, at: np.ndarray, begins: np.ndarray, ends: np.ndarray, passages: Passages, q: int, rate: float
) -> Iterator[tuple[int, int, int, int, int]]:
    """(document, passage, low, high, edits allowed) of regions whose bands reach the bound.

    ``where``, ``docs`` and ``at`` are place, document and number of the grams that both sides have.
    Passages are halved until their shared places fit ``LIMIT``; one that alone has more, as repetitive
    texts do, is counted band by band.
    """
    count = len(passages.ids)
    lengths = np.array([len(p) for p in passages.points])
    budgets = np.array([budget(n, rate) for n in lengths])
    bound = lengths - q + 1 - budgets * q
    longest = int(lengths.max())
    todo = [(where, docs, at, 0, count)]
    while todo:
        where, docs, at, first, last = todo.pop()
        low, high = (np.searchsorted(passages.runs, at * count + item) for item in (first, last))
        kept = high > low
        where, docs, at, low, high = where[kept], docs[kept], at[kept], low[kept], high[kept]
        start = passages.run_first[low]
        counts = passages.run_first[high] - start
        if not len(where):
            continue
        if counts.sum() > LIMIT:
            if last - first == 1:
                k, m = int(budgets[first]), int(lengths[first])
                for doc in np.unique(docs).tolist():
                    own, begin = docs == doc, int(begins[doc])
                    for a, b in _dense(where[own] - begin, at[own], int(ends[doc]) - begin, first, passages, k, int(bound[first])):
                        yield doc, first, begin + a - k, begin + b + m + k, k
            else:
                middle = (first + last) // 2
                todo += [(where, docs, at, middle, last), (where, docs, at, first, middle)]
            continue
        spread = np.repeat(start - np.concatenate(([0], np.cumsum(counts)[:-1])), counts) + np.arange(counts.sum())
        items, offsets = passages.owner[spread], passages.place[spread]
        doc_of, place = np.repeat(docs, counts), np.repeat(where, counts)
        # Diagonals are counted from the document's start less the longest passage, so none is negative.
        cells = (place - begins[doc_of] - offsets + longest) // np.maximum(budgets[items], 1)
        most = int(cells.max()) + 3
        for shift in (0, 1):  # a band covers two cells; shifted by one, bands overlap by half
            key = (doc_of.astype(np.int64) * count + items) * most + (cells + shift) // 2
            # A place of the passage counts once in a band, however often the document has its gram.
            pair = np.unique(key * (longest + 1) + offsets)
            groups, shared = np.unique(pair // (longest + 1), return_counts=True)
            item = (groups // most) % count
            full = shared >= np.maximum(bound[item], 1)
            for g, i in zip(groups[full].tolist(), item[full].tolist()):
                doc, cell, k = g // most // count, (g % most) * 2 - shift, int(budgets[i])
                wide = max(k, 1)
                begin = int(begins[doc]) + cell * wide - longest - k
                yield doc, i, begin, begin + 2 * wide + int(lengths[i]) + 2 * k, k


def _dense(places: np.ndarray, grams: np.ndarray, length: int, item: int, passages: Passages, k: int, bound: int) -> list[list[int]]:
    """First and last diagonal of overlapping bands of one document that reach one passage's bound.

    A place of the passage is shared in a band if the document has its gram in the band's window for
    that place, which a search in the sorted (gram, place) pairs tells without listing them all.
    """
    own = np.flatnonzero(passages.owner == item)
    run = np.searchsorted(passages.run_first, own, "right") - 1
    gram, offset = passages.runs[run] // len(passages.ids), passages.place[own].astype(np.int64)
    size = length + 2
    pairs = np.sort(grams * size + places)
    wide = max(k, 1)
    starts = np.arange(-len(passages.points[item]) - wide, length + 1, wide)
    merged: list[list[int]] = []
    step = max(LIMIT // len(own), 1)
    for chunk in range(0, len(starts), step):
        window = starts[chunk : chunk + step, None] + offset
        low, high = (np.searchsorted(pairs, gram * size + np.clip(window + end, 0, size - 1)) for end in (0, 2 * wide))
        for begin in starts[chunk : chunk + step][(high > low).sum(axis=1) >= max(bound, 1)].tolist():
            if merged and begin <= merged[-1][1]:
                merged[-1][1] = begin + 2 * wide
            else:
                merged.append([begin, begin + 2 * wide])
    return merged


def _search(parts: list[np.ndarray], numbers: list[int], passages: Passages, q: int, rate: float) -> list[tuple[int, int, int, int, int]]:
    joined = np.concatenate([x for p in parts for x in (p, [WALL])]).astype(np.uint32)
    points, places = normal(joined)
    ends = np.flatnonzero(points == WALL)
    begins = np.concatenate(([0], ends[:-1] + 1))
    raw_begins = np.concatenate(([0], np.cumsum([len(p) + 1 for p in parts])[:-1]))
    out = []

    def verify(doc: int, item: int, low: int, high: int, k: int) -> None:
        low, high = max(low, begins[doc]), min(high, ends[doc])
        best = align(passages.points[item], points[low:high], k)
        if best is not None and best[2] > best[1]:
            start, end = places[low + best[1]], places[low + best[2] - 1] + 1
            out.append((numbers[doc], item, int(start - raw_begins[doc]), int(end - raw_begins[doc]), best[0]))

    hashes = gram_hashes(points, q)
    hit = np.flatnonzero(passages.bitmap[hashes >> np.uint64(64 - FILTER_BITS)])
    if len(hit) and len(passages.grams):
        at = np.minimum(np.searchsorted(passages.grams, hashes[hit]), len(passages.grams) - 1)
        same = passages.grams[at] == hashes[hit]
        hit, at = hit[same], at[same]
        for region in _regions(hit, np.searchsorted(ends, hit), at, begins, ends, passages, q, rate):
            verify(*region)
    # Too short for a q-gram: it has to occur as it is, between separators or ends of the document.
    short = [item for item, own in enumerate(passages.points) if len(own) < q]
    whole = np.concatenate(([SPACE], np.where(points == WALL, SPACE, points))).astype("<u4").tobytes() if short else b""
    for item in short:
        own = passages.points[item]
        needle = np.concatenate(([SPACE], own, [SPACE])).astype("<u4").tobytes()
        found = whole.find(needle)
        while found >= 0:
            start = found // 4
            doc = int(np.searchsorted(ends, start))
            if found % 4 == 0 and start + len(own) <= ends[doc]:
                verify(doc, item, start, start + len(own), 0)
            found = whole.find(needle, found + 4 - found % 4)
    return out


def best_matches(texts: list[str], passages: Passages, q: int, rate: float) -> dict[tuple[int, int], tuple[int, int, int]]:
    """(text, passage) to (edits, start, end) with the fewest edits, then the first."""
    best: dict[tuple[int, int], tuple[int, int, int]] = {}
    for text, item, start, end, edits in matches(texts, passages, q, rate):
        now = (edits, start, end)
        if now < best.get((text, item), (1 << 60, 0, 0)):
            best[(text, item)] = now
    return best


def _found(passages: Passages, q: int, rate: float, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "item_id", "start", "end", "edits"]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]
    for batch in batches:
        ids = batch.column(0).to_pylist()
        rows = [
            (ids[text], passages.ids[item], start, end, edits)
            for (text, item), (edits, start, end) in best_matches(batch.column(1).to_pylist(), passages, q, rate).items()
        ]
        columns = zip(*rows) if rows else ([],) * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def blocks(benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> Iterator[list[tuple]]:
    """The passages in blocks of bounded size, fetched one partition at a time."""
    block: list[tuple] = []
    size = 0
    for row in benchmark.select(F.col("item_id").cast("long"), "text").where("text IS NOT NULL").toLocalIterator():
        if size + len(row[1]) > block_chars and block:
            yield block
            block, size = [], 0
        block.append((row[0], row[1]))
        size += len(row[1])
    if block:
        yield block


SCHEMA = "doc_id long, item_id long, start int, end int, edits int"


def contaminated(docs: DataFrame, benchmark: DataFrame, *, q: int = Q, rate: float = RATE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per document and passage that occurs in it: the best occurrence and its edits.

    A passage of m normalised characters may have ``rate * m`` edits, a short one none; one under
    ``q`` characters has to stand between separators or ends of the text.  Null and
    empty texts and passages match nothing.  Every block of the benchmark reads all documents.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    found = docs.sparkSession.createDataFrame([], SCHEMA)
    for block in blocks(benchmark, block_chars):
        found = found.unionByName(rows.mapInArrow(per_batch(_found, index(block, q), q, rate), SCHEMA))
    return found


def _clean(passages: Passages, q: int, rate: float, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [t or "" for t in batch.column(batch.schema.get_field_index("text")).to_pylist()]
        hit = {text for text, _ in best_matches(texts, passages, q, rate)}
        yield batch.filter(pa.array([i not in hit for i in range(len(texts))], pa.bool_()))


def decontaminated(docs: DataFrame, benchmark: DataFrame, *, q: int = Q, rate: float = RATE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Whole rows of ``docs`` in which no passage occurs, filtered where they lie."""
    for block in blocks(benchmark, block_chars):
        docs = docs.mapInArrow(per_batch(_clean, index(block, q), q, rate), docs.schema)
    return docs
