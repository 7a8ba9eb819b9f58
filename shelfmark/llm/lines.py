"""Line deduplication: a segment-partition join of lines within an edit distance.

If a line is cut into ``edits + 1`` segments, one of them is left whole by ``edits`` edits, shifted
by at most ``edits`` places.  So every distinct line is indexed by its segments, and
probes the index with those of its substrings that can match a segment of a line of its length or
up to ``edits`` shorter (the multi-match-aware choice of start places).  Segments and substrings
meet in Spark by a hash of length, segment number and characters.  An edit changes the counts of at
most two characters, so a key carries 23 parities of such counts, and the join keeps only pairs in
which at most ``2 * edits`` of them differ.  Most lines that share a segment and are farther apart are
thus not written as pairs, though the join still compares the lines of a segment two by two.  The rest are verified by a banded bit-parallel edit distance.

Equal lines are one class from the start, combined in the scan tasks, so a line in a third of all
documents is one row per task.  A line goes if its class, or a class linked with it, occurs
earlier; earlier means a smaller (doc_id, line number).
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import cut, per_batch, text_of

EDITS = 2
SHORTEST = 16  # shorter lines have only exact copies
NO_ID = -(1 << 63)
MIXED = (1 << 64) - 1
SLICE = 1 << 17  # characters in numpy arrays together
BASE = 0x9E3779B97F4A7C15  # odd, so that its powers have inverses modulo 2**64
MIX = np.uint64(0xBF58476D1CE4E5B9)
PARITIES = 23
LOW = 1 + PARITIES  # bits of a key below its hash: the sketch, then whether a probe is one of the line's own segments


def _signed(n: int) -> int:
    return n - (1 << 64) if n >> 63 else n


def line_id(line: str) -> tuple[int, int]:
    """Two 64-bit halves of a 128-bit hash of the line."""
    digest = xxhash.xxh3_128_intdigest(line.encode("utf-8", "surrogatepass"))
    return _signed(digest >> 64), _signed(digest & MIXED)


def lines_of(text: str) -> list[tuple[int, str]]:
    """(number, line) of the lines that have more than white space, without the space around."""
    return [(i, x) for i, x in enumerate(t.strip() for t in text.split("\n")) if x]


def segments(length: int, edits: int) -> list[tuple[int, int]]:
    """(start, end) of ``edits + 1`` even segments; the last ones take the remainder."""
    parts = edits + 1
    short, extra = divmod(length, parts)
    out, at = [], 0
    for i in range(parts):
        size = short + (i >= parts - extra)
        out.append((at, at + size))
        at += size
    return out


def probes(length: int, shorter: int, edits: int) -> Iterator[tuple[int, int, int]]:
    """(segment number, start, end) of the substrings of a line of ``length`` that may equal a
    segment of a line of ``shorter`` characters.

    Of edits before and after the segment, the left ones are at most its number and the right ones
    at most the number of segments that follow; both limits shift the start.
    """
    gap = length - shorter
    parts = edits + 1
    for number, (start, end) in enumerate(segments(shorter, edits)):
        size = end - start
        low = max(start - number, start + gap - (parts - 1 - number), 0)
        high = min(start + number, start + gap + (parts - 1 - number), length - size)
        for at in range(low, high + 1):
            yield number, at, at + size


@functools.lru_cache(4096)
def _places(length: int, edits: int, probing: bool) -> np.ndarray:
    """Starts, ends, tags (length and segment number) of a line's segments, or of what it probes with, and
    whether a probe is a segment of the line itself."""
    if probing:
        shorter = range(max(SHORTEST, length - edits), length + 1)
        whole = segments(length, edits)
        own = [(start, end, x << 4 | n, x == length and start == whole[n][0]) for x in shorter for n, start, end in probes(length, x, edits)]
    else:
        own = [(start, end, length << 4 | number, 0) for number, (start, end) in enumerate(segments(length, edits))]
    return np.array(own, np.int64).reshape(-1, 4).T


def _slices(lines: list[str]) -> Iterator[slice]:
    """Runs of lines of at most ``SLICE`` characters; a longer line is a run of its own."""
    first = held = 0
    for i, line in enumerate(lines):
        if i > first and held + len(line) > SLICE:
            yield slice(first, i)
            first, held = i, 0
        held += len(line)
    if first < len(lines):
        yield slice(first, len(lines))


def _characters(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The code points of the lines one after the other, and where each line starts."""
    codes = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), np.uint32)
    return codes, np.cumsum([0] + [len(x) for x in lines])[:-1]


@functools.lru_cache(4)
def _powers(base: int, count: int) -> np.ndarray:
    """``base`` to the powers from 0 on, modulo 2**64."""
    return np.concatenate((np.ones(1, np.uint64), np.cumprod(np.full(count - 1, base, np.uint64))))


@functools.cache
def _parity_bits() -> np.ndarray:
    """The bit of each code point in a sketch: neighbours, as the letters of an alphabet are, differ."""
    return np.uint32(1) << np.arange(0x110000, dtype=np.uint32) % np.uint32(PARITIES)


def _sketches(codes: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Of each line, which of ``PARITIES`` groups of characters occur an odd number of times."""
    return np.bitwise_xor.reduceat(_parity_bits()[codes], firsts).astype(np.uint64)


def segment_keys(lines: list[str], edits: int, probing: bool) -> tuple[np.ndarray, np.ndarray]:
    """(number of the line, key) of the segments of each line, or of the substrings that it probes with.

    The high bits of a key are a hash of the substring: a difference of prefix sums, so that all of them
    cost one pass over the characters.  Then come the line's sketch and a bit for its own segments.
    """
    codes, firsts = _characters(lines)
    count = 1 << max(SLICE, len(codes) + 1).bit_length()
    values = (codes.astype(np.uint64) + np.uint64(1)) * MIX
    values ^= values >> np.uint64(32)
    values *= _powers(BASE, count)[: len(codes)]
    until = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values)))
    places = [_places(len(x), edits, probing) for x in lines]
    line = np.repeat(np.arange(len(lines)), [p.shape[1] for p in places])
    start, end, tag, whole = np.concatenate(places, axis=1)
    start, end = start + firsts[line], end + firsts[line]
    keys = (until[end] - until[start]) * _powers(pow(BASE, -1, 1 << 64), count)[start] ^ tag.astype(np.uint64) * np.uint64(BASE)
    keys = (keys ^ keys >> np.uint64(32)) * MIX >> np.uint64(LOW) << np.uint64(LOW)
    return line, (keys | _sketches(codes, firsts)[line] << np.uint64(1) | whole.astype(np.uint64)).view(np.int64)


def within(a: str, b: str, edits: int) -> bool:
    """Whether the edit distance is at most ``edits``.

    After equal ends are stripped, one word holds the band of ``2 * edits + 1`` diagonals of a row
    of the distance table as bits: the deltas between its neighbours, as in bit-parallel matching.
    """
    if abs(len(a) - len(b)) > edits:
        return False
    if len(a) > len(b):
        a, b = b, a
    start = _common(a, b)
    a, b = a[start:], b[start:]
    end = _common(a[::-1], b[::-1])
    a, b = a[: len(a) - end], b[: len(b) - end]
    if not a or not b:
        return len(a) + len(b) <= edits
    return _banded(a, b, edits) <= edits


def _common(a: str, b: str) -> int:
    """Length of the common prefix, by halving with string comparisons."""
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while low + 1 < high:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low if a[low] != b[low] else low + 1


def _banded(a: str, b: str, edits: int) -> int:
    """Edit distance of a and b if at most ``edits``, else some larger number.

    Column j of the distance table belongs to b[j].  The band keeps the 2 * edits + 1 cells around
    its diagonal, the topmost bit being the lowest cell.  While the band ends above the last row
    the score follows its lower edge, one diagonal step per column; then it follows the last row.
    """
    m, n = len(a), len(b)
    width = 2 * edits + 1
    mask, low = (1 << width) - 1, 1 << (width - 1)
    if m <= edits:  # the band covers all: a plain bit-parallel column is as short
        width, mask, low = m, (1 << m) - 1, 0
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    banded = low > 0
    plus, minus = (mask >> edits << edits, 0) if banded else (mask, 0)
    score = edits if banded else m
    row = (low >> 1) if banded else 1 << (m - 1)
    most = edits + abs(m - n) + edits
    for j in range(n):
        own = places.get(b[j], 0)
        equal = (own << edits >> j) & mask if banded else own
        down = (((equal & plus) + plus) ^ plus) | equal | minus
        right_up = minus | ~(down | plus) & mask
        right_down = plus & down
        if banded and j < m - edits:
            score += not down & low
        else:
            score += bool(right_up & row)
            score -= bool(right_down & row)
            if banded:
                row >>= 1
        if score > most + n:
            return score
        if banded:
            step = (down & mask) >> 1
            plus, minus = (right_down | ~(step | right_up)) & mask, step & right_up
        else:
            right_up = right_up << 1 | 1
            plus, minus = (right_down << 1 | ~(down | right_up)) & mask, down & right_up & mask
    return score


PLACE = 1 << 32  # a line's order: doc_id * PLACE + line number


def _distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each distinct line of a batch once, with its first place in it."""
    for batch in batches:
        first: dict[str, tuple[int, int]] = {}
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            for place, line in lines_of(text):
                at = (doc, place)
                if first.setdefault(line, at) > at:
                    first[line] = at
        ids = [line_id(x) for x in first]
        columns = [[i[0] for i in ids], [i[1] for i in ids], list(first), [a[0] for a in first.values()], [a[1] for a in first.values()]]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int32()]
        names = ["id", "id2", "line", "doc", "place"]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            rows += [(doc, place, *line_id(line)) for place, line in lines_of(text)]
        columns = zip(*rows) if rows else ([],) * 4
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["doc", "place", "id", "id2"])


def _keys(edits: int, probing: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, id) of the segments of each line, or of the substrings that it probes with."""
    for batch in batches:
        lines = batch.column(1).to_pylist()
        long = np.flatnonzero(np.fromiter((len(x) >= SHORTEST for x in lines), bool, len(lines)))
        lines = [lines[i] for i in long]
        found = [(long[own][line], keys) for own in _slices(lines) for line, keys in [segment_keys(lines[own], edits, probing)]]
        if not found:
            continue
        row, keys = (pa.array(np.concatenate(x)) for x in zip(*found))
        yield pa.RecordBatch.from_arrays([keys, batch.column(0).take(row)], names=["key", "id"])


def _verified(edits: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows without the two lines (the last columns), where these are within ``edits``."""
    for batch in batches:
        left, right = batch.column(batch.num_columns - 2).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()
        near = [within(a, b, edits) for a, b in zip(left, right)]
        kept = [batch.column(i) for i in range(batch.num_columns - 2)]
        yield pa.RecordBatch.from_arrays(kept, names=batch.schema.names[:-2]).filter(pa.array(near, pa.bool_()))


def distinct_lines(rows: DataFrame) -> DataFrame:
    """(id, id2, line, at) of every distinct line of (key, text), dealt by id; at: its first place."""
    at = F.col("doc").cast("decimal(20,0)") * F.lit(PLACE) + F.col("place")
    found = rows.mapInArrow(_distinct, "id long, id2 long, line string, doc long, place int")
    dealt = found.select("id", "id2", "line", at.cast("decimal(31,0)").alias("at")).where("id IS NOT NULL").repartition("id")
    return dealt.groupBy("id", "id2", "line").agg(F.min("at").alias("at"))


def candidate_pairs(lines: DataFrame, edits: int = EDITS) -> DataFrame:
    """(a, b) of every pair of distinct lines that share a segment and have near enough sketches, once each."""
    # All four readers of the lines need the same columns, so that one shuffle serves them.
    texts = lines.select("id", "line", "id2", "at")
    index = texts.mapInArrow(per_batch(_keys, edits, False), "key long, id long")
    probing = texts.mapInArrow(per_batch(_keys, edits, True), "probe_key long, probe long")
    shared = F.shiftright("key", LOW) == F.shiftright("probe_key", LOW)
    alike = F.bit_count(F.shiftright(F.col("key").bitwiseXOR(F.col("probe_key")), 1)) <= 2 * edits
    # Lines that share a segment of both find each other; one of the two finds is enough.
    once = (F.col("id") < F.col("probe")) | ((F.col("id") != F.col("probe")) & (F.col("probe_key").bitwiseAND(1) == 0))
    met = index.join(probing, shared & alike & once)
    return met.select(F.least("id", "probe").alias("a"), F.greatest("id", "probe").alias("b")).distinct()


def near_lines(lines: DataFrame, edits: int = EDITS) -> DataFrame:
    """(a, a2, a_at, b, b2, b_at) of every pair of distinct lines within ``edits``, once each."""
    left = lines.select(F.col("id").alias("a"), F.col("id2").alias("a2"), F.col("at").alias("a_at"), F.col("line").alias("a_line"))
    right = lines.select(F.col("id").alias("b"), F.col("id2").alias("b2"), F.col("at").alias("b_at"), F.col("line").alias("b_line"))
    both = candidate_pairs(lines, edits).join(left, "a").join(right, "b").select("a", "a2", "a_at", "b", "b2", "b_at", "a_line", "b_line")
    schema = "a long, a2 long, a_at decimal(31,0), b long, b2 long, b_at decimal(31,0)"
    return both.mapInArrow(per_batch(_verified, edits), schema)


def line_dedup(docs: DataFrame, edits: int = EDITS) -> DataFrame:
    """One row per document: its lines, their classes and links, and which of them go.

    Returns doc_id, n_lines, n_removed, n_links (over its lines), removed (line numbers), and
    classes: for each line its number, the doc_id and line number where its class first occurs,
    and with how many other classes it is linked.  Lines are compared without the white space
    around them; those with nothing else are no lines.  Lines under ``SHORTEST`` characters have
    only exact copies.  Null and empty texts have no lines.  A null doc_id comes before all others,
    and rows that share a doc_id are one document.
    """
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))
    rows = docs.select(key.alias("key"), text_of().alias("text"))
    links = cut(near_lines(distinct_lines(rows), edits))
    forth = links.select(F.col("a").alias("id"), F.col("a2").alias("id2"), F.col("b_at").alias("other"))
    back = links.select(F.col("b").alias("id"), F.col("b2").alias("id2"), F.col("a_at").alias("other"))
    linked = forth.unionByName(back).groupBy("id", "id2").agg(F.count(F.lit(1)).alias("links"), F.min("other").alias("other"))
    occurrences = rows.mapInArrow(_occurrences, "doc long, place int, id long, id2 long")
    here = F.col("doc").cast("decimal(20,0)") * F.lit(PLACE) + F.col("place")
    firsts = occurrences.groupBy("id", "id2").agg(F.min(here.cast("decimal(31,0)")).alias("at"))
    placed = occurrences.join(firsts.join(linked, ["id", "id2"], "left"), ["id", "id2"])
    earlier = (F.col("at") < here) | F.coalesce(F.col("other") < F.col("at"), F.lit(False))
    first_doc = F.floor(F.col("at") / F.lit(PLACE).cast("decimal(11,0)")).cast("long")
    line = F.struct(
        F.col("place").alias("line"),
        F.when(first_doc != NO_ID, first_doc).alias("class_doc_id"),
        F.pmod(F.col("at"), F.lit(PLACE).cast("decimal(11,0)")).cast("int").alias("class_line"),
        F.coalesce("links", F.lit(0)).cast("long").alias("links"),
        earlier.alias("removed"),
    )
    per_document = placed.select("doc", line.alias("line")).groupBy("doc").agg(F.sort_array(F.collect_list("line")).alias("lines"))
    found = F.coalesce(F.col("lines"), F.array().cast("array<struct<line:int,class_doc_id:bigint,class_line:int,links:bigint,removed:boolean>>"))
    gone = F.filter(found, lambda x: x["removed"])
    result = docs.select(F.col("doc_id").cast("long").alias("doc_id"), key.alias("doc")).join(per_document, "doc", "left")
    return result.select(
        "doc_id",
        F.size(found).cast("long").alias("n_lines"),
        F.size(gone).cast("long").alias("n_removed"),
        F.aggregate(found, F.lit(0).cast("long"), lambda total, x: total + x["links"]).alias("n_links"),
        F.transform(gone, lambda x: x["line"]).alias("removed"),
        found.alias("classes"),
    )
