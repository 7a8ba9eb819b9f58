"""Document fingerprints: a Merkle tree over sections and paragraphs.

A text is cut, without losing a character, into sections, these into paragraphs, and these into
leaves: sentences, or less at the start of a text.  A leaf's digest covers its characters, a
section's the digests of its leaves, the root those of its sections.  Equal roots mean equal texts;
where roots differ, equal sections are skipped and only the leaves of the others are compared, so a
fingerprint alone tells which characters were edited.

Paragraphs end at line ends.  A section ends at a blank line or, in running text, after a
paragraph whose digest says so (one in four), so an edit shifts no boundary but its own.

A fingerprint is ``root:section/section/...`` with ``digest=leaf,leaf,...`` for a section and nine
hexadecimal digits followed by the length in base 36 for a leaf.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import per_batch, search, text_of

PARAGRAPH = re.compile(r"[^\n]*\n+|[^\n]+")
# Leaves grow with their place in the text, so that short texts have several: pairs of characters,
# words of up to 8 characters, three words, and then sentences of up to 12 words, each with the
# space after it.  (end of the stretch, pattern)
LEAVES = (
    (12, re.compile(r"(?s)..?")),
    (64, re.compile(r"\S{1,8}\s*|\s+")),
    (400, re.compile(r"(?:\S{1,400}(?<![.!?])\s+){0,2}\S{1,400}\s*|\s+")),
    (None, re.compile(r"(?:\S{1,400}(?<![.!?])\s+){0,11}\S{1,400}\s*|\s+")),
)
DIGITS = 9
ALONE = 12  # a moved leaf counts as found again only if it has so many characters


class Tree(NamedTuple):
    root: str
    sections: list[tuple[str, list[str]]]
    lengths: list[list[int]]


def _base36(n: int) -> str:
    digits = ""
    while True:
        n, r = divmod(n, 36)
        digits = "0123456789abcdefghijklmnopqrstuvwxyz"[r] + digits
        if not n:
            return digits


_LENGTHS = [_base36(n) for n in range(4096)]


def _length(n: int) -> str:
    return _LENGTHS[n] if n < 4096 else _base36(n)


def pieces(paragraph: str, offset: int) -> list[str]:
    """The leaves of a paragraph that starts at ``offset``."""
    if offset >= LEAVES[-2][0]:
        return LEAVES[-1][1].findall(paragraph)
    found, at = [], 0
    for end, pattern in LEAVES:
        stop = len(paragraph) if end is None else min(len(paragraph), max(at, end - offset))
        found += pattern.findall(paragraph, at, stop)
        at = stop
    return found


def grow(text: str) -> Tree:
    """The tree of a text; that of an empty text has no section."""
    sections: list[tuple[str, list[str]]] = []
    lengths: list[list[int]] = []
    root = hashlib.sha256()
    leaves: list[str] = []
    sizes: list[int] = []
    inner = hashlib.sha256()

    def close() -> None:
        nonlocal leaves, sizes, inner
        digest = inner.hexdigest()
        root.update(inner.digest())
        sections.append((digest[:DIGITS], leaves))
        lengths.append(sizes)
        leaves, sizes, inner = [], [], hashlib.sha256()

    offset = 0
    for paragraph in PARAGRAPH.findall(text):
        last = b"\0"
        for piece in pieces(paragraph, offset):
            last = hashlib.blake2b(piece.encode("utf-8", "surrogatepass"), digest_size=16).digest()
            inner.update(last)
            leaves.append(last.hex()[:DIGITS])
            sizes.append(len(piece))
        offset += len(paragraph)
        if paragraph.endswith("\n\n") or last[0] & 3 == 0:
            close()
    if leaves:
        close()
    return Tree(root.hexdigest()[:32], sections, lengths)


def fingerprint(tree: Tree) -> str:
    return tree.root + ":" + "/".join(
        digest + "=" + ",".join([x + _length(n) for x, n in zip(leaves, sizes)])
        for (digest, leaves), sizes in zip(tree.sections, tree.lengths)
    )


def parse(text: str) -> Tree:
    """The tree that a fingerprint describes."""
    root, _, rest = text.partition(":")
    parts = [s.split("=", 1) for s in rest.split("/")] if rest else []
    leaves = [x.split(",") for _, x in parts]
    return Tree(
        root,
        [(digest, [x[:DIGITS] for x in own]) for (digest, _), own in zip(parts, leaves)],
        [[int(x[DIGITS:], 36) for x in own] for own in leaves],
    )


def _open(tree: Tree, known: Counter) -> tuple[list[tuple[str, int, int]], int]:
    """Leaves (digest, length, offset) outside sections found in ``known``; characters inside such."""
    rest, inside, offset = [], 0, 0
    for (digest, leaves), sizes in zip(tree.sections, tree.lengths):
        if known[digest] > 0:
            known[digest] -= 1
            size = sum(sizes)
            inside += size
            offset += size
            continue
        for leaf, size in zip(leaves, sizes):
            rest.append((leaf, size, offset))
            offset += size
    return rest, inside


def _ends(a: list[tuple[str, int, int]], b: list[tuple[str, int, int]]) -> tuple[int, int]:
    """How many leaves both share at the start, and then at the end."""
    most, head = min(len(a), len(b)), 0
    while head < most and a[head][0] == b[head][0]:
        head += 1
    tail = 0
    while tail < most - head and a[-1 - tail][0] == b[-1 - tail][0]:
        tail += 1
    return head, tail


def likeness(a: Tree, b: Tree) -> float:
    """Share of both texts, by characters, in sections and leaves that they have in common.

    1 for equal texts.  Sections count wherever they stand; leaves outside equal sections count in
    order from both ends, and in between if they have at least ``ALONE`` characters.
    """
    if a.root == b.root:
        return 1.0
    total = sum(map(sum, a.lengths)) + sum(map(sum, b.lengths))
    rest_a, inside_a = _open(a, Counter(d for d, _ in b.sections))
    rest_b, inside_b = _open(b, Counter(d for d, _ in a.sections))
    head, tail = _ends(rest_a, rest_b)
    common = inside_a + inside_b + 2 * sum(x[1] for x in rest_a[:head]) + 2 * sum(x[1] for x in rest_a[len(rest_a) - tail :])
    spare = Counter(x[0] for x in rest_b[head : len(rest_b) - tail] if x[1] >= ALONE)
    for digest, size, _ in rest_a[head : len(rest_a) - tail]:
        if size >= ALONE and spare[digest] > 0:
            spare[digest] -= 1
            common += 2 * size
    return min(1.0, common / total) if total else 1.0


def edited_spans(a: Tree, b: Tree) -> list[tuple[int, int]]:
    """[start, end) of the characters of ``a`` that ``b`` does not have, from fingerprints alone."""
    if a.root == b.root:
        return []
    rest_a, _ = _open(a, Counter(d for d, _ in b.sections))
    rest_b, _ = _open(b, Counter(d for d, _ in a.sections))
    head, tail = _ends(rest_a, rest_b)
    spare = Counter(x[0] for x in rest_b[head : len(rest_b) - tail])
    spans: list[tuple[int, int]] = []
    for digest, size, offset in rest_a[head : len(rest_a) - tail]:
        if spare[digest] > 0:
            spare[digest] -= 1
        elif spans and spans[-1][1] == offset:
            spans[-1] = (spans[-1][0], offset + size)
        else:
            spans.append((offset, offset + size))
    return spans


def _fingerprints(column: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = batch.schema.get_field_index(column)
        found = [fingerprint(grow(t or "")) for t in batch.column(at).to_pylist()]
        kept = [batch.column(i) for i in range(batch.num_columns) if i != at]
        names = [n for i, n in enumerate(batch.schema.names) if i != at]
        yield pa.RecordBatch.from_arrays([*kept, pa.array(found, pa.string())], names=[*names, "fingerprint"])


def merkle_fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fingerprint of every document; a null text is an empty one.  No shuffle."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    narrow = docs.select("doc_id", text_of().alias("text"))
    return narrow.mapInArrow(per_batch(_fingerprints, "text"), f"doc_id {kind}, fingerprint string")


ORDERED = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by (block, own, doc_id); the one before in the block is a row's next document."""
    block, before, before_tree = None, "", None
    for batch in batches:
        out: list[tuple] = []
        blocks, own, ids, texts = (batch.column(i).to_pylist() for i in range(4))
        for b, mine, doc_id, text in zip(blocks, own, ids, texts):
            if b != block:
                block, before, before_tree = b, "", None
            tree = grow(text)
            if mine:
                take = len(text) // 3
                changed = text[: len(text) - take] + before[:take]
                changed_tree = grow(changed)
                near_next = likeness(tree, before_tree) if before_tree is not None else 1.0
                digest = hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest()
                out.append(
                    (doc_id, len(text), digest, fingerprint(tree), fingerprint(changed_tree), likeness(tree, changed_tree), near_next)
                )
            before, before_tree = text, tree
        columns = list(zip(*out)) if out else [[]] * 7
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        names = [c.split(" ")[0] for c in ORDERED.split(", ")]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def edit_against_next(docs: DataFrame, blocks_per_partition: int = 8) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness.

    The edited text has its last third replaced by the start of the next document in descending
    doc_id (after the last: the first).  A null doc_id comes last; rows with one doc_id are ordered
    by a hash of their text.

    Neighbours meet by cutting the doc_ids into blocks at approximate quantiles: texts are shuffled
    once, by block, and sorted there.  Each block also gets the largest row of the block below it,
    the neighbour of its smallest.  Bounds and these rows number at most 4096, whatever the size of
    the table, so they may pass the driver and be broadcast.
    """
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = max(16, min(4096, partitions * blocks_per_partition))
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))
    keys = docs.select(key.alias("key"))
    cuts = keys.agg(F.percentile_approx("key", [i / wanted for i in range(1, wanted)], 10 * wanted).alias("cuts")).first()["cuts"]
    block = search(sorted(set(cuts or [])), F.col("key")).cast("int")
    last = keys.groupBy(block.alias("block")).agg(F.max("key").alias("key")).orderBy("block").collect()
    receivers = [(r["key"], last[(i + 1) % len(last)]["block"]) for i, r in enumerate(last)]
    lends = spark.createDataFrame(receivers, "key long, receiver int")
    rows = docs.select("doc_id", key.alias("key"), text_of().alias("text")).withColumn("block", block)
    homes = F.array(F.struct(F.col("block").alias("to"), F.lit(True).alias("own")))
    lent = F.array(F.struct(F.col("receiver").alias("to"), F.lit(False).alias("own")))
    placed = (
        rows.join(F.broadcast(lends), "key", "left")
        .withColumn("place", F.explode(F.when(F.col("receiver").isNull(), homes).otherwise(F.concat(homes, lent))))
        .select(F.col("place.to").alias("to"), F.col("place.own").alias("own"), F.col("doc_id").cast("long").alias("doc_id"), "key", "text")
    )
    return (
        placed.repartition("to")
        .sortWithinPartitions("to", "own", "key", F.xxhash64("text"), "text")
        .select("to", "own", "doc_id", "text")
        .mapInArrow(_edited, ORDERED)
    )
