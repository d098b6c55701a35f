"""Mixing sources to target weights by cube-method balanced sampling.

A source whose target is r times its words takes every document floor(r) times and a
balanced sample with inclusion probability r - floor(r) once more. The flight phase moves
the probabilities of three documents at a time along the null space of the two balancing
totals (documents and words) until one of them is 0 or 1, and goes on with the next; both
totals stay exactly as expected. It runs in blocks of ``BLOCK`` documents of one source, so
a source of any size is dealt over many tasks; the at most two documents a block leaves
undecided meet in the next round's blocks. The last block of a source lands: documents first
move with the word total alone, and the single one left is rounded to the nearer end, so a
source's words miss their target by half a document at most.

Defined cases: null text has size 0; size-0 documents take nothing whatever their source;
a source of no words has target 0; null is a source of its own, after all others; repeated
rows are separate documents of the sample; choices come from hashes of ids and texts, so
reruns agree; extra columns are ignored."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .util import materialise, text_key

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2.0
BLOCK = 2000
#: Up to this many sources the target list is broadcast; beyond, Spark joins it.
BROADCAST_SOURCES = 10_000


def targets(sizes: dict[str | None, int], weights: tuple[float, ...] = WEIGHTS,
            share: float = SHARE, most: float = MOST) -> dict[str | None, float]:
    """Words wanted of each source. Sources in code point order (null last) take the weights
    in turn; what a source cannot take (more than ``most`` times its words) is shared again
    by weight among the others."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: float(weights[i % len(weights)]) for i, s in enumerate(order)}
    out: dict[str | None, float] = {}
    rest, left = share * sum(sizes.values()), list(order)
    while left:
        unit = rest / sum(weight[s] for s in left)
        full = [s for s in left if weight[s] * unit > most * sizes[s]]
        if not full:
            return out | {s: weight[s] * unit for s in left}
        for s in full:
            out[s] = most * sizes[s]
            rest -= out[s]
        left = [s for s in left if s not in out]
    return out


def flight(size: np.ndarray, prob: np.ndarray, rng: np.random.Generator, land: bool) -> np.ndarray:
    """Probabilities after the flight phase (and the landing), in the given order."""
    s, p = size.tolist(), prob.tolist()
    coin = iter(rng.random(2 * len(s) + 8).tolist())
    open_, nxt = [], 0

    def move(units: list[int], u: list[float]) -> None:
        up = down = float("inf")
        for i, x in zip(units, u):
            if x > 0:
                up, down = min(up, (1 - p[i]) / x), min(down, p[i] / x)
            elif x < 0:
                up, down = min(up, p[i] / -x), min(down, (1 - p[i]) / -x)
        step = up if next(coin) * (up + down) < down else -down
        for i, x in zip(units, u):
            v = p[i] + step * x
            p[i] = 0.0 if v < 1e-9 else 1.0 if v > 1 - 1e-9 else v

    while True:
        while len(open_) < 3 and nxt < len(s):
            if 0 < p[nxt] < 1:
                open_.append(nxt)
            nxt += 1
        if len(open_) == 3:
            a, b, c = (s[i] for i in open_)
            u = [c - b, a - c, b - a]
            move(open_, u if any(u) else [1.0, -1.0, 0.0])
        elif len(open_) == 2 and s[open_[0]] == s[open_[1]]:
            move(open_, [1.0, -1.0])
        elif land and len(open_) == 2:
            move(open_, [s[open_[1]], -s[open_[0]]])
        elif land and len(open_) == 1:
            p[open_[0]] = float(p[open_[0]] >= 0.5)
        else:
            return np.array(p)
        open_ = [i for i in open_ if 0 < p[i] < 1]


def _fly(level: int):
    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("order", "ascending"), ("size", "ascending")])
        first = {c: rows.column(c)[0].as_py() for c in ("source", "block", "blocks")}
        seed = zlib.crc32(repr((first["source"], first["block"], level)).encode())
        p = flight(rows.column("size").to_numpy().astype(float), rows.column("p").to_numpy(),
                   np.random.default_rng(seed), first["blocks"] == 1)
        return rows.set_column(rows.schema.get_field_index("p"), "p", pa.array(p))
    return run


def mix_sources(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                source: str = "source", weights: tuple[float, ...] = WEIGHTS,
                share: float = SHARE, most: float = MOST, block: int = BLOCK) -> DataFrame:
    """Per document row: doc, tkey, source, size (words), source_size, target, copies."""
    spark = docs.sparkSession
    words = F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"))
    rows = materialise(docs.select(
        F.col(doc_id).alias("doc"), text_key(text).alias("tkey"),
        F.col(source).cast("string").alias("source"), words.cast("long").alias("size")), "mix-rows")
    sums = {r["source"]: (r["size"], r["n"]) for r in rows.groupBy("source").agg(
        F.sum("size").alias("size"), F.count("*").alias("n")).collect()}
    want = targets({s: x[0] for s, x in sums.items()}, weights, share, most)
    ratio = {s: want[s] / x[0] if x[0] else 0.0 for s, x in sums.items()}
    table = spark.createDataFrame(
        [(s, int(x[0]), float(want[s]), int(min(ratio[s], most)),
          float(ratio[s] - int(min(ratio[s], most)))) for s, x in sums.items()],
        "key string, source_size long, target double, base int, p double")
    if len(sums) <= BROADCAST_SOURCES:
        table = F.broadcast(table)
    state = rows.join(table, rows["source"].eqNullSafe(F.col("key"))).drop("key").withColumn(
        "order", F.xxhash64(F.lit("cube"), "doc", "tkey"))
    state = state.withColumn("p", F.when(F.col("size") > 0, F.col("p")).otherwise(F.lit(0.0)))
    state = state.where("p is not null")
    open_ = (F.col("p") > 1e-9) & (F.col("p") < 1 - 1e-9)
    done, live, level = state.where(~open_), state.where(open_), 0
    while True:
        counts = live.groupBy("source").agg(F.count("*").alias("left")).withColumn(
            "blocks", F.ceil(F.col("left") / block)).select(F.col("source").alias("key"), "blocks")
        if len(sums) <= BROADCAST_SOURCES:
            counts = F.broadcast(counts)
        dealt = (live.join(counts, live["source"].eqNullSafe(F.col("key"))).drop("key")
                 .withColumn("block", F.pmod(F.xxhash64(F.lit(level), "order"), F.col("blocks"))))
        schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in dealt.schema.fields)
        flown = materialise(dealt.groupBy("source", "block").applyInArrow(_fly(level), schema)
                            .drop("block", "blocks"), "mix-flown")
        done, live, level = done.unionByName(flown.where(~open_)), flown.where(open_), level + 1
        if live.isEmpty():
            break
    return done.select("doc", "tkey", "source", "size", "source_size", "target",
                       (F.col("base") + F.round("p").cast("int")).alias("copies"))
