"""Language ID by prediction by partial matching.

Each language has a context tree over bytes (ASCII lower-cased): how often each byte
followed each context of 0 to ``ORDER`` bytes. A byte costs -log2(n / (T + Q)) bits in the
longest context that knows it (n of T occurrences, Q different bytes), after an escape of
-log2(Q / (T + Q)) bits in every longer context that doesn't; 8 bits remain below order 0.
The trees are frozen, so a text's code length under a language is an exact sum, and the
shortest one wins; the score is its share of the sum of 2^-length over all languages.

The trees are counted in Spark over about ``per_language`` sampled documents of each
language (a documented bound: it bounds the trees, which every executor holds). Counts of
all languages are resolved into one table per order, context and byte with a cost for each
language, looked up for all bytes of a chunk at once.

Defined cases: a text that is null or has no letter is ``und`` with score 0, as is every
text when no row can be learned from; rows whose language is null teach nothing; equal
texts get equal predictions (of equal code lengths the first language by code point wins);
extra columns are ignored."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import text as T
from .util import bounded_sample, text_key

ORDER = 4
PER_LANGUAGE = 400
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


class KeyTable:
    """Positions of 64-bit keys by open addressing, looked up for whole arrays."""

    def __init__(self, keys: np.ndarray):
        bits = max(4, int(2 * len(keys)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.mask = np.int64((1 << bits) - 1)
        self.keys = np.full(1 << bits, _NONE, np.uint64)
        self.place = np.full(1 << bits, -1, np.int32)
        left = np.arange(len(keys))
        at = self._home(keys)
        while len(left):
            free = self.keys[at] == _NONE
            slot, who = np.unique(at[free], return_index=True)
            won = np.flatnonzero(free)[who]
            self.keys[slot] = keys[left[won]]
            self.place[slot] = left[won]
            rest = np.ones(len(left), bool)
            rest[won] = False
            left, at = left[rest], (at[rest] + 1) & self.mask

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        at = self._home(keys)
        got = self.keys[at]
        out = np.where(got == keys, self.place[at], np.int32(-1))
        left = np.flatnonzero((got != keys) & (got != _NONE))
        while len(left):
            at[left] = (at[left] + 1) & self.mask
            got = self.keys[at[left]]
            same = got == keys[left]
            out[left[same]] = self.place[at[left[same]]]
            left = left[~same & (got != _NONE)]
        return out


def _codes(data: np.ndarray, offsets: np.ndarray, order: int) -> Iterator[np.ndarray]:
    """For orders 0, 1, ...: each byte below its preceding bytes, the order on top. Bytes
    before the start of a document are 0."""
    low = T.LOWER[data]
    code = low.astype(np.uint64)
    inside = np.arange(len(low)) - np.repeat(offsets[:-1], np.diff(offsets))
    for d in range(order + 1):
        if d:
            back = np.zeros(len(low), np.uint64)
            back[d:] = low[:-d] if d < len(low) else 0
            back[inside < d] = 0
            code = code | (back << np.uint64(8 * d))
        yield code | (np.uint64(d + 1) << np.uint64(48))


def _count(order: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            langs = b.column("lang").to_numpy(zero_copy_only=False)
            for lang in np.unique(langs):
                mine = b.column("text").filter(pa.array(langs == lang))
                for _, _, data, off in T.doc_chunks(mine):
                    for code in _codes(data, off, order):
                        key, n = np.unique(code, return_counts=True)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(key), lang, np.int32)),
                             pa.array(key.view(np.int64)), pa.array(n.astype(np.int64))],
                            names=["lang", "key", "n"])
    return run


class Trees:
    """Resolved costs of all languages: float32 bits [key, language] for each order."""

    def __init__(self, counts: pd.DataFrame, n_langs: int, order: int):
        self.order, self.n_langs = order, n_langs
        self.symbol, self.cost, self.context, self.escape = [], [], [], []
        keys = counts["key"].to_numpy().astype(np.int64).view(np.uint64)
        lang, n = counts["lang"].to_numpy(), counts["n"].to_numpy().astype(float)
        lower = None
        for d in range(order + 1):
            of = (keys >> np.uint64(48)) == d + 1
            sym, row = np.unique(keys[of], return_inverse=True)
            count = np.zeros((len(sym), n_langs))
            count[row, lang[of]] = n[of]
            ctx, up = np.unique(sym >> np.uint64(8), return_inverse=True)
            total, kinds = np.zeros((len(ctx), n_langs)), np.zeros((len(ctx), n_langs))
            np.add.at(total, up, count)
            np.add.at(kinds, up, count > 0)
            with np.errstate(divide="ignore", invalid="ignore"):
                esc = np.where(total > 0, -np.log2(kinds / (total + kinds)), 0.0)
                seen = -np.log2(count / (total + kinds)[up])
            if d == 0:
                below = np.full((len(sym), n_langs), 8.0)
            else:
                short = (sym & np.uint64((1 << (8 * d)) - 1)) | (np.uint64(d) << np.uint64(48))
                below = self.cost[-1][np.searchsorted(lower, short)]
            self.symbol.append(sym)
            self.cost.append(np.where(count > 0, seen, esc[up] + below).astype(np.float32))
            self.context.append(ctx)
            self.escape.append(esc.astype(np.float32))
            lower = sym

    def index(self) -> None:
        self._sym = [KeyTable(k) for k in self.symbol]
        self._ctx = [KeyTable(k) for k in self.context]

    def code_lengths(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Bits of each document under each language."""
        if not hasattr(self, "_sym"):
            self.index()
        codes = list(_codes(data, offsets, self.order))
        bits = np.zeros((len(data), self.n_langs), np.float32)
        left = None                       # all
        for d in range(self.order, -1, -1):
            key = codes[d] if left is None else codes[d][left]
            at = self._sym[d].find(key)
            hit = at >= 0
            where = np.flatnonzero(hit) if left is None else left[hit]
            bits[where] += self.cost[d][at[hit]]
            key = key[~hit]
            left = np.flatnonzero(~hit) if left is None else left[~hit]
            if not len(left):
                break
            ctx = self._ctx[d].find(key >> np.uint64(8))
            known = ctx >= 0
            bits[left[known]] += self.escape[d][ctx[known]]
        if len(left):
            bits[left] += np.float32(8)
        out = np.zeros((len(offsets) - 1, self.n_langs))
        full = np.flatnonzero(np.diff(offsets) > 0)
        if len(full):
            out[full] = np.add.reduceat(bits, offsets[full], axis=0, dtype=np.float64)
        return out


def learn(docs: DataFrame, where: Column, lang: str = "lang", text: str = "text",
          order: int = ORDER, per_language: int = PER_LANGUAGE) -> tuple[list[str], Trees]:
    """Trees of the languages found among the rows of ``docs`` that satisfy ``where``."""
    rows = docs.where(where & F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(lang).alias("lang"), F.col(text).alias("text"))
    names = sorted(r["lang"] for r in rows.select("lang").distinct().collect())
    if not names:
        return [], Trees(pd.DataFrame({"key": [], "lang": np.empty(0, np.int32), "n": []}), 0, order)
    some = bounded_sample(rows, "lang", per_language, text_key("text"))
    number = F.array_position(F.lit(names), F.col("lang")).cast("int") - 1
    counts = (some.select(number.cast("int").alias("lang"), "text")
              .mapInArrow(_count(order), "lang int, key long, n long")
              .groupBy("lang", "key").agg(F.sum("n").alias("n"))).toPandas()
    return names, Trees(counts, len(names), order)


def _predict(names: list[str], model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = model.value
        for b in batches:
            rest = [c for c in b.schema.names if c not in ("_text", "_letters")]
            lang = np.full(b.num_rows, "und", object)
            score, rate = np.zeros(b.num_rows), np.zeros(b.num_rows)
            letters = b.column("_letters").to_numpy(zero_copy_only=False)
            if names:
                for i, j, data, off in T.doc_chunks(b.column("_text")):
                    bits = trees.code_lengths(data, off)
                    best = bits.argmin(axis=1)
                    low = bits.min(axis=1)
                    ok = letters[i:j]
                    share = 1 / np.exp2(-(bits - low[:, None])).sum(axis=1)
                    lang[i:j] = np.where(ok, np.array(names, object)[best], "und")
                    score[i:j] = np.where(ok, share, 0)
                    rate[i:j] = np.where(ok, low / np.maximum(np.diff(off), 1), 0)
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in rest), pa.array(lang, pa.string()), pa.array(score),
                 pa.array(rate)], names=[*rest, "lang_pred", "score", "bits_per_byte"])
    return run


def identify(docs: DataFrame, names: list[str], trees: Trees, keep: list[str],
             text: str = "text") -> DataFrame:
    """``keep`` columns, lang_pred, score and bits_per_byte of every row; only the text is
    looked at."""
    model = docs.sparkSession.sparkContext.broadcast(trees)
    rows = docs.select(*keep, F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)).alias("_letters"),
                       F.col(text).alias("_text"))
    kept = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep)
    return rows.mapInArrow(_predict(names, model),
                           f"{kept}, lang_pred string, score double, bits_per_byte double")
