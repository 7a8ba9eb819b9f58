"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns ``vnodes`` points of a ring; a row goes to the first point at or after its own.
No shard takes more than (1 + slack) times the mean load: what overflows a full shard continues
clockwise to the next points until it finds room.  Shards therefore have nearly equal bytes, and
adding one moves little beyond what it takes.

The ring is divided into ``cells`` of equal width.  Rows are summed per cell in Spark; the walk
around the ring needs only these sums, a table whose size is fixed by a parameter, and gives each
cell one shard.  Everything per row is a join with that table.
"""

from __future__ import annotations

import bisect
import hashlib

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import cut, id_text, number_repeated, position52, text_of

RING_BITS = 52
CELLS = 65536
VNODES = 256
SLACK = 0.002
OVERHEAD = 16
TOGETHER = 8  # rows of one key that go to one place of the ring; those of a larger key have one each


def _point(label: str) -> int:
    return int(hashlib.md5(label.encode()).hexdigest()[:13], 16)


def ring_points(shards: int, vnodes: int, cells: int) -> list[tuple[int, int]]:
    """(cell of the virtual node, shard), clockwise."""
    width = (1 << RING_BITS) // cells
    return sorted((_point(f"node|{s}|{v}") // width, s) for s in range(shards) for v in range(vnodes))


def walk_ring(loads: dict[int, int], shards: int, vnodes: int = VNODES, slack: float = SLACK, cells: int = CELLS) -> dict[int, int]:
    """The shard of every cell that has a load.

    First every shard keeps cells of its own arcs, clockwise, while they fit.  The others continue
    clockwise from their arc, one or more turns, to the first shard with room.  A cell larger than
    any room left goes to the emptiest shard, so nothing is dropped.
    """
    points = ring_points(shards, vnodes, cells)
    places = [p for p, _ in points]
    room = dict.fromkeys(range(shards), int(-(-sum(loads.values()) * (1 + slack) // shards)))
    found: dict[int, int] = {}
    overflow: list[tuple[int, int]] = []
    for cell in sorted(loads):
        at = bisect.bisect_left(places, cell) % len(points)
        shard = points[at][1]
        if loads[cell] <= room[shard]:
            found[cell] = shard
            room[shard] -= loads[cell]
        else:
            overflow.append((at, cell))
    for at, cell in overflow:
        tried: set[int] = set()
        while len(tried) < shards:
            at = (at + 1) % len(points)
            shard = points[at][1]
            if shard not in tried and loads[cell] <= room[shard]:
                break
            tried.add(shard)
        else:
            shard = max(room, key=lambda s: (room[s], -s))
        found[cell] = shard
        room[shard] -= loads[cell]
    return found


def ring_shards(docs: DataFrame, shards: int = 40, *, vnodes: int = VNODES, slack: float = SLACK, cells: int = CELLS) -> DataFrame:
    """doc_id, size (UTF-8 bytes plus 16), text_crc32, shard, slot (gapless within the shard).

    A row's point comes from its doc_id, or from its text where that is null.  Rows that agree in
    it are one key: up to ``TOGETHER`` of them stay together, more are dealt one by one, so that no
    key outweighs a shard.  Null texts have no bytes.  An empty table gives none.
    """
    width = (1 << RING_BITS) // cells
    key = F.when(F.col("doc_id").isNull(), F.concat(F.lit("text|"), F.md5(text_of()))).otherwise(id_text())
    keyed = cut(
        docs.select(
            "doc_id",
            (F.octet_length(text_of()) + F.lit(OVERHEAD)).cast("long").alias("size"),
            F.crc32(text_of().cast("binary")).alias("text_crc32"),
            key.alias("key"),
        )
    )
    numbered = number_repeated(keyed, ["key"], ["size", "text_crc32"], TOGETHER)
    own = F.when(F.col("number").isNull(), F.col("key")).otherwise(F.concat_ws("|", "key", "size", "text_crc32", "number"))
    placed_rows = numbered.withColumn("point", position52(F.lit("row"), own)).drop("key", "number")
    rows = cut(placed_rows.withColumn("cell", F.floor(F.col("point") / width).cast("int")))
    sums = rows.groupBy("cell").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("rows")).collect()
    found = walk_ring({r["cell"]: r["size"] for r in sums}, shards, vnodes, slack, cells)
    # At most ``cells`` rows: the offsets of the cells within their shard, clockwise.
    filled = [0] * shards
    placed = []
    for r in sorted(sums):
        shard = found[r["cell"]]
        placed.append((r["cell"], shard, filled[shard]))
        filled[shard] += r["rows"]
    cell_of = docs.sparkSession.createDataFrame(placed, "cell int, shard int, offset long")
    within = Window.partitionBy("cell").orderBy("point", F.col("doc_id").asc_nulls_first(), "text_crc32", "size")
    return (
        rows.withColumn("within", F.row_number().over(within) - 1)
        .join(F.broadcast(cell_of), "cell")
        .select("doc_id", "size", "text_crc32", "shard", (F.col("offset") + F.col("within")).alias("slot"))
    )
