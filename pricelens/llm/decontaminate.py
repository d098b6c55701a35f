"""Benchmark decontamination by winnowing.

Both sides keep, of the k-gram hashes in every window of ``span`` words, the smallest one
(the leftmost of equals). Two texts that share ``span`` words share such a window and so
keep the same k-gram of it: joining the kept fingerprints finds every shared span, and
extending each hit word by word (on the words themselves, not on hashes) confirms it.

Documents meet a fixed-size bit filter of the benchmark's fingerprints before the shuffle;
it has no false negatives, so it only saves shuffling fingerprints that cannot match.

Defined cases: a null or empty text has no words and is never hit; an item of fewer than
``span`` words is one window of its own length (the documents are winnowed once more for
each such length that the benchmark has, at most ``span - 1``); an item without words
matches nothing; equal rows get equal results; an item whose id is null counts under the
empty string; extra columns of either table are ignored."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as T
from .util import join_rows, materialise, text_key

SPAN = 13
KGRAM = 5
#: Bits of the fingerprint filter: 2 MB on every executor, whatever the benchmark's size.
FILTER_BITS = 1 << 24

_FP = "span int, fp long, pos int, lead int, context string"


def _winnow(w: T.Words, span: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the kept k-grams of all documents, and their hashes."""
    k = min(KGRAM, span)
    g = T.grams(w.hashes, k, salt=span)
    width = span - k + 1
    n = len(g) - width + 1
    if n <= 0:
        return np.empty(0, np.int64), g[:0]
    doc = np.repeat(np.arange(len(w.bounds) - 1), np.diff(w.bounds))
    best, at = g[:n].copy(), np.zeros(n, np.int64)
    for j in range(1, width):
        less = g[j:j + n] < best
        best[less] = g[j:j + n][less]
        at[less] = j
    whole = doc[:n] == doc[span - 1:span - 1 + n]
    pos = np.unique((np.arange(n) + at)[whole])
    return pos, g[pos]


def _slots(fp: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    return fp % np.uint64(bits), (fp >> np.uint64(32)) % np.uint64(bits)


def _rows(w: T.Words, span: int, pos: np.ndarray, fp: np.ndarray):
    """(document, kept position in it, words before it in the context, context)."""
    reach = span - min(KGRAM, span)
    doc = np.searchsorted(w.bounds, pos, "right") - 1
    for d, p, h in zip(doc.tolist(), pos.tolist(), fp.view(np.int64).tolist()):
        lo, hi = max(int(w.bounds[d]), p - reach), min(int(w.bounds[d + 1]), p + span)
        yield d, h, p - int(w.bounds[d]), p - lo, b" ".join(
            w.word(i) for i in range(lo, hi)).decode("utf-8", "replace")


def _normalised_items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out = []
        for i, _, data, off in T.doc_chunks(b.column("text")):
            w = T.words(data, off)
            for d in range(len(off) - 1):
                out.append(b" ".join(w.word(x) for x in range(w.bounds[d], w.bounds[d + 1]))
                           .decode("utf-8", "replace"))
        yield pa.RecordBatch.from_arrays(
            [b.column("item"), pa.array(out, pa.string())], names=["item", "words"])


def _item_fingerprints(max_span: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols: list[list] = [[] for _ in range(6)]
            for text, cls in zip(b.column("words").to_pylist(), b.column("cls").to_pylist()):
                data = np.frombuffer(text.encode(), np.uint8)
                w = T.words(data, np.array([0, len(data)]))
                span = min(max_span, len(w.starts))
                for _, h, p, lead, ctx in _rows(w, span, *_winnow(w, span)):
                    for c, v in zip(cols, (cls, span, h, p, lead, ctx)):
                        c.append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int32()),
                 pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.int32()),
                 pa.array(cols[4], pa.int32()), pa.array(cols[5], pa.string())],
                names=["cls", "span", "fp", "pos", "lead", "context"])
    return run


def _scan(spans: list[int], bits: int, filt):
    """Documents -> one row with the word count and one row per fingerprint that passes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitset = np.frombuffer(filt.value, np.uint8)
        has = lambda slot: (bitset[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1
        for b in batches:
            n = b.num_rows
            counts = np.zeros(n, np.int64)
            rows: list[tuple] = []
            for i, _, data, off in T.doc_chunks(b.column("text")):
                w = T.words(data, off)
                counts[i:i + len(off) - 1] = np.diff(w.bounds)
                for span in spans:
                    pos, fp = _winnow(w, span)
                    one, two = _slots(fp, bits)
                    ok = (has(one) & has(two)).astype(bool)
                    rows += [(i + d, span, h, p, lead, ctx)
                             for d, h, p, lead, ctx in _rows(w, span, pos[ok], fp[ok])]
            take = np.concatenate([np.arange(n), np.array([r[0] for r in rows], np.int64)])
            null = [None] * n
            field = lambda j, kind: pa.array(null + [r[j] for r in rows], kind)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc").take(pa.array(take)), b.column("tkey").take(pa.array(take)),
                 pa.array(counts[take]), field(1, pa.int32()), field(2, pa.int64()),
                 field(3, pa.int32()), field(4, pa.int32()), field(5, pa.string())],
                names=["doc", "tkey", "n_words", "span", "fp", "pos", "lead", "context"])
    return run


def _extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Joined fingerprints -> confirmed spans of document words."""
    for b in batches:
        keep, lo, hi = [], [], []
        cols = [b.column(c).to_pylist() for c in
                ("span", "pos", "lead", "context", "item_lead", "item_context")]
        for r, (span, pos, lead, ctx, ilead, ictx) in enumerate(zip(*cols)):
            x, y = ctx.split(" "), ictx.split(" ")
            left = 0
            while left < min(lead, ilead) and x[lead - 1 - left] == y[ilead - 1 - left]:
                left += 1
            right, most = 0, min(len(x) - lead, len(y) - ilead)
            while right < most and x[lead + right] == y[ilead + right]:
                right += 1
            if left + right >= span and right >= min(KGRAM, span):
                keep.append(r)
                lo.append(pos - left)
                hi.append(pos + right)
        at = pa.array(keep, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [b.column("doc").take(at), b.column("tkey").take(at), b.column("cls").take(at),
             pa.array(lo, pa.int32()), pa.array(hi, pa.int32())],
            names=["doc", "tkey", "cls", "lo", "hi"])


def _bit_filter(fps: DataFrame, bits: int) -> bytes:
    """Bytes of the filter, gathered as at most bits / 64 words."""
    one = F.pmod(F.col("fp"), F.lit(bits))
    two = F.pmod(F.shiftrightunsigned("fp", 32), F.lit(bits))
    words = (fps.select(F.explode(F.array(one, two)).alias("s"))
             .groupBy((F.col("s") / 64).cast("long").alias("w"))
             .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"),
                                           (F.col("s") % 64).cast("int"))).alias("v")))
    out = np.zeros(bits // 64, np.int64)
    for r in words.toLocalIterator():
        out[r["w"]] = r["v"]
    return out.tobytes()


def find_shared_spans(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id",
                      item_id: str = "item_id", text: str = "text", span: int = SPAN,
                      filter_bits: int = FILTER_BITS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents: doc, tkey, n_words; spans: doc, tkey, cls, lo, hi in words; item classes:
    cls, items). A class is the set of items with the same words; equal items are compared
    once. ``tkey`` is the hash of the text, see ``text_key``."""
    spark = docs.sparkSession
    norm = (items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"),
                         F.col(text).alias("text"))
            .mapInArrow(_normalised_items, "item string, words string")
            .where(F.col("words") != ""))
    norm = materialise(norm.withColumn("cls", F.md5("words")), "decon-items")
    classes = norm.groupBy("cls").agg(F.collect_set("item").alias("items"))
    fps = materialise(norm.select("cls", "words").distinct()
                      .mapInArrow(_item_fingerprints(span), "cls string, " + _FP), "decon-fps")
    spans = sorted(r["span"] for r in fps.select("span").distinct().collect())
    filt = spark.sparkContext.broadcast(_bit_filter(fps, filter_bits))
    id_type = docs.schema[doc_id].dataType.simpleString()
    scanned = materialise(
        docs.select(F.col(doc_id).alias("doc"), text_key(text).alias("tkey"),
                    F.col(text).alias("text"))
        .mapInArrow(_scan(spans, filter_bits, filt),
                    f"doc {id_type}, tkey long, n_words long, " + _FP), "decon-scan")
    base = scanned.where(F.col("fp").isNull()).select("doc", "tkey", "n_words")
    hits = scanned.where(F.col("fp").isNotNull()).drop("n_words").distinct()
    known = fps.select("span", "fp", "cls", F.col("lead").alias("item_lead"),
                       F.col("context").alias("item_context")).distinct()
    found = hits.join(known, ["span", "fp"]).mapInArrow(
        _extend, f"doc {id_type}, tkey long, cls string, lo int, hi int")
    return base, found, classes


def decontaminate(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id",
                  item_id: str = "item_id", text: str = "text", span: int = SPAN) -> DataFrame:
    """Per document row: doc, tkey, n_words, n_hit (words inside any shared span), items
    (distinct ids of items with shared spans, sorted as strings), spans (merged [lo, hi))."""
    base, found, classes = find_shared_spans(docs, items, doc_id, item_id, text, span)
    found = materialise(found.distinct(), "decon-spans")
    merged = F.expr("""aggregate(array_sort(collect_set(struct(lo, hi))),
        cast(array() as array<struct<lo:int,hi:int>>),
        (acc, x) -> if(size(acc) > 0 and x.lo <= element_at(acc, -1).hi,
            concat(slice(acc, 1, size(acc) - 1),
                   array(struct(element_at(acc, -1).lo as lo,
                                greatest(element_at(acc, -1).hi, x.hi) as hi))),
            concat(acc, array(struct(x.lo as lo, x.hi as hi)))))""")
    per_doc = found.groupBy("doc", "tkey").agg(merged.alias("spans"))
    ids = (found.select("doc", "tkey", "cls").distinct().join(classes, "cls")
           .groupBy("doc", "tkey")
           .agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items")))
    keys = ["doc", "tkey"]
    out = join_rows(base, join_rows(per_doc, ids, keys), keys, "left")
    n_hit = F.expr("aggregate(spans, 0L, (n, x) -> n + x.hi - x.lo)")
    return (out.withColumn("n_hit", F.coalesce(n_hit, F.lit(0).cast("long")))
            .withColumn("items", F.coalesce("items", F.array().cast("array<string>"))))
