"""Sharding by minimax contiguous partition.

Equal texts stay together. Texts are hashed to ``CELLS`` ordered atomic groups, whose total
sizes fit a list whatever the corpus holds. A binary search finds the smallest capacity at
which filling shards greedily, in order, needs no more shards than there are; the cuts are
put as near to equal totals as that capacity allows. The shard of a row then follows from
its cell and the cuts alone.

Slots come from counts: a cell of more than ``SLOT_ROWS`` rows (many copies of one text) is
numbered in several parts, dealt by a hash of the id, each part after the rows before it.

Defined cases: a null text is the empty text (size 8 with the overhead); more shards than
cells leave shards empty; one text that outweighs an even share fills a shard of its own
size; equal rows take neighbouring slots in any order; an empty table gives no rows; extra
columns are ignored."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .util import materialise

SHARDS = 24
OVERHEAD = 8
CELLS = 1 << 16
SLOT_ROWS = 20_000


def minimax_cuts(sizes: list[int], shards: int) -> list[int]:
    """Start positions of shards 1 .. shards-1 in the ordered ``sizes``: no contiguous
    partition has a smaller largest shard."""
    ends = [0, *accumulate(sizes)]
    total, n = ends[-1], len(sizes)

    def reach(start: int, capacity: int) -> int:
        return bisect_right(ends, ends[start] + capacity) - 1

    def feasible(capacity: int) -> bool:
        at = 0
        for _ in range(shards):
            at = reach(at, capacity)
        return at == n

    lo, hi = max([-(-total // shards), *sizes], default=0), total
    while lo < hi:
        mid = (lo + hi) // 2
        lo, hi = (lo, mid) if feasible(mid) else (mid + 1, hi)
    # the earliest start of each shard from which the shards after it still hold the rest
    least = [n] * shards + [n]
    for k in range(shards - 1, -1, -1):
        least[k] = bisect_left(ends, ends[least[k + 1]] - lo)
    cuts, at = [], 0
    for k in range(1, shards):
        even = bisect_left(ends, total * k / shards)
        if even and total * k / shards - ends[even - 1] < ends[min(even, n)] - total * k / shards:
            even -= 1
        at = max(least[k], at, min(even, reach(at, lo)))
        cuts.append(at)
    return cuts


def shard(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shards: int = SHARDS,
          cells: int = CELLS, slot_rows: int = SLOT_ROWS) -> DataFrame:
    """Per row: doc, size, text_crc32, shard, slot (gapless from 0 in each shard)."""
    body = F.coalesce(F.col(text), F.lit(""))
    rows = materialise(docs.select(
        F.col(doc_id).alias("doc"), (F.octet_length(body) + OVERHEAD).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        F.pmod(F.xxhash64(body), F.lit(cells)).cast("int").alias("cell")), "shard-rows")
    totals = rows.groupBy("cell").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
    listed = sorted((r["cell"], r["bytes"]) for r in totals.collect())   # at most ``cells`` rows
    starts = minimax_cuts([b for _, b in listed], shards)
    firsts = [listed[at][0] if at < len(listed) else cells for at in starts]
    number = (F.size(F.filter(F.lit(firsts), lambda c: c <= F.col("cell"))) if firsts
              else F.lit(0)).cast("int")
    parts = totals.select("cell", F.ceil(F.col("n") / slot_rows).alias("parts"))
    cut = (rows.join(F.broadcast(parts), "cell")                          # at most ``cells`` rows
           .withColumn("part", F.pmod(F.xxhash64("doc", "text_crc32"), F.col("parts")))
           .drop("parts"))
    before = (cut.groupBy("cell", "part").agg(F.count("*").alias("n"))
              .withColumn("shard", number)
              .withColumn("before", F.sum("n").over(
                  Window.partitionBy("shard").orderBy("cell", "part")) - F.col("n")))
    inner = F.row_number().over(Window.partitionBy("cell", "part").orderBy("doc", "text_crc32", "size"))
    return (cut.withColumn("inner", inner - 1)
            .join(before.select("cell", "part", "shard", "before"), ["cell", "part"])
            .select("doc", "size", "text_crc32", "shard",
                    (F.col("before") + F.col("inner")).cast("long").alias("slot")))
