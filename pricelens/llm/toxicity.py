"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

A document's features are the distinct hashes of its words, word pairs, pairs with one or
two words between, and the first ``STEMS`` bytes of longer words (inflected and compound
forms share them). A feature's value is its rate among the document's words, scaled and cut
at 1, so a long document does not collect weight from words it uses once. FTRL-proximal keeps, per coordinate, a gradient sum and a sum of
squares: rates adapt to each feature and an L1 threshold leaves most weights exactly zero,
so the model that is broadcast is a short list of (feature, weight).

Fitting uses a bounded, documented sample of ``SAMPLE`` labelled rows, dealt to ``SHARDS``
shards that train at the same time on Spark; the shards' weights are averaged and one scale
and offset is fitted on the sample's margins, which restores the probabilities.

Defined cases: a null, empty or wordless text has no features and scores the model's base
rate; equal texts score alike; without any labelled row all scores are 0.5; labels that are
null teach nothing; extra columns are ignored."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as T
from .util import hash_unit, materialise

BITS = 20
SAMPLE = 24_000
SHARDS = 8
EPOCHS = 2
ALPHA, BETA, L1, L2 = 1.0, 1.0, 0.4, 0.1
SHAPES = ((0,), (0, 1), (0, 2), (0, 3))
STEMS = (4, 5, 6, 7)
RATE = 40.0


def word_features(w: T.Words, bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(feature, document) arrays of the occurrences of each kind of feature."""
    doc = np.repeat(np.arange(len(w.bounds) - 1), np.diff(w.bounds))
    top = np.uint64(64 - bits)
    out = []
    for salt, shape in enumerate(SHAPES):
        f = (T.grams(w.hashes, shape, salt=100 + salt) >> top).astype(np.int32)
        same = doc[:len(f)] == doc[shape[-1]:shape[-1] + len(f)]
        out.append((f[same], doc[:len(f)][same]))
    for length in STEMS:
        long = np.flatnonzero(w.ends - w.starts > length)
        out.append(((T.mix(w.prefix_hashes(long, length) + np.uint64(200 + length)) >> top)
                    .astype(np.int32), doc[long]))
    return out


def _values(parts: list[tuple[np.ndarray, np.ndarray]], n_words: np.ndarray, bits: int
            ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(feature, document, value), each feature once per document, by document."""
    key, n = np.unique(np.concatenate([(d.astype(np.int64) << bits) | f for f, d in parts]),
                       return_counts=True)
    doc = (key >> bits).astype(np.int64)
    return ((key & ((1 << bits) - 1)).astype(np.int32), doc,
            np.minimum(1.0, RATE * n / n_words[doc]))


def _featurise(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, data, off in T.doc_chunks(b.column("text")):
                w = T.words(data, off)
                f, d, x = _values(word_features(w, bits), np.diff(w.bounds), bits)
                at = np.searchsorted(d, np.arange(j - i + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [b.column("label").slice(i, j - i), b.column("shard").slice(i, j - i),
                     b.column("tie").slice(i, j - i),
                     pa.ListArray.from_arrays(pa.array(at), pa.array(f)),
                     pa.ListArray.from_arrays(pa.array(at), pa.array(x.astype(np.float32)))],
                    names=["label", "shard", "tie", "features", "xs"])
    return run


def _ftrl(bits: int, epochs: int, alpha: float, beta: float, l1: float, l2: float):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["tie", "label"], kind="stable")
        z, n = np.zeros(1 << bits), np.zeros(1 << bits)
        bias_z = bias_n = 0.0
        labels, features, values = rows["label"].to_numpy(), rows["features"], rows["xs"]

        def weight(z, n, l1):
            return np.where(np.abs(z) <= l1, 0.0,
                            -(z - np.sign(z) * l1) / ((beta + np.sqrt(n)) / alpha + l2))

        for _ in range(epochs):
            for y, f, x in zip(labels, features, values):
                zf, nf = z[f], n[f]
                w = weight(zf, nf, l1)
                b = float(weight(np.float64(bias_z), np.float64(bias_n), 0.0))
                g = 1 / (1 + np.exp(-np.clip(w @ x + b, -35, 35))) - y
                gx = g * x
                step = (np.sqrt(nf + gx * gx) - np.sqrt(nf)) / alpha
                z[f] = zf + gx - step * w
                n[f] = nf + gx * gx
                bias_z += g - (np.sqrt(bias_n + g * g) - np.sqrt(bias_n)) / alpha * b
                bias_n += g * g
        w = weight(z, n, l1)
        at = np.flatnonzero(w)
        bias = float(weight(np.float64(bias_z), np.float64(bias_n), 0.0))
        return pd.DataFrame({"feature": np.append(at, -1), "weight": np.append(w[at], bias)})
    return run




def _calibrate(margin: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Scale and offset of the logistic curve, by Newton steps that never raise the loss. A
    weak pull towards the identity keeps them finite where the margins separate the labels."""
    x = np.stack([margin, np.ones_like(margin)], axis=1)
    start = np.array([1.0, 0.0])

    def loss(c: np.ndarray) -> float:
        z = x @ c
        return float(np.logaddexp(0, np.where(label > 0, -z, z)).sum() + 0.5 * ((c - start) ** 2).sum())
    c, now = start, loss(start)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ c, -35, 35)))
        grad = x.T @ (p - label) + (c - start)
        hess = (x * (p * (1 - p))[:, None]).T @ x + np.eye(2)
        step = np.linalg.solve(hess, grad)
        while np.abs(step).max() > 1e-8 and loss(c - step) > now:
            step = step / 2
        if np.abs(step).max() <= 1e-8:
            break
        c = c - step
        now = loss(c)
    return float(c[0]), float(c[1])


def sample_labelled(docs: DataFrame, labels: DataFrame, label: str, rows: int,
                    doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """label, tie, text of about ``rows`` labelled documents: the label rows are thinned by a
    hash of the id, so at most that many (plus chance) meet the documents in a broadcast."""
    known = labels.where(F.col(label).isNotNull()).select(
        F.col(doc_id).alias("lid"), F.col(label).cast("int").alias("label"))
    total = known.count()
    few = known.where(hash_unit(F.lit("fit"), F.col("lid")) < rows / max(total, 1))
    texts = docs.select(F.col(doc_id).alias("lid"), F.col(text).alias("text"))
    return texts.join(F.broadcast(few), "lid").select(
        "label", F.xxhash64(F.lit("order"), "lid").alias("tie"), "text")


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", doc_id: str = "doc_id",
        text: str = "text", sample: int = SAMPLE, shards: int = SHARDS, bits: int = BITS
        ) -> dict:
    """The sparse model: feature and weight arrays, scale and offset of the logistic curve.
    ``labels`` holds the rows that may be learned from."""
    rows = sample_labelled(docs, labels, label, sample, doc_id, text).withColumn(
        "shard", F.pmod(F.col("tie"), F.lit(shards)).cast("int"))
    feats = materialise(rows.mapInArrow(
        _featurise(bits), "label int, shard int, tie long, features array<int>, xs array<float>"), "tox-features")
    mean = (feats.groupBy("shard").applyInPandas(
        _ftrl(bits, EPOCHS, ALPHA, BETA, L1, L2), "feature long, weight double")
        .groupBy("feature").agg((F.sum("weight") / shards).alias("weight"))).toPandas()
    empty = not len(mean)
    real = mean[mean["feature"] >= 0].sort_values("feature")
    model = {"feature": real["feature"].to_numpy(np.int64), "weight": real["weight"].to_numpy(),
             "bits": bits, "scale": 1.0, "offset": 0.0, "empty": empty}
    if not empty:
        dense = np.zeros(1 << bits)
        dense[model["feature"]] = model["weight"]
        cast = docs.sparkSession.sparkContext.broadcast(dense.astype(np.float32))

        def margin(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in frames:
                yield pd.DataFrame({"label": pdf["label"], "margin": np.array(
                    [cast.value[f] @ x for f, x in zip(pdf["features"], pdf["xs"])], float)})
        m = feats.select("label", "features", "xs").mapInPandas(margin, "label int, margin double").toPandas()
        model["scale"], model["offset"] = _calibrate(m["margin"].to_numpy(), m["label"].to_numpy(float))
    return model


def _score(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        bits = m["bits"]
        dense = np.zeros(1 << bits)
        dense[m["feature"]] = m["weight"]
        for b in batches:
            margin = np.zeros(b.num_rows)
            for i, j, data, off in T.doc_chunks(b.column("_text")):
                w = T.words(data, off)
                live = [(f[k], d[k]) for f, d in word_features(w, bits) for k in [dense[f] != 0]]
                f, d, x = _values(live, np.diff(w.bounds), bits)   # only features with a weight
                margin[i:j] = np.bincount(d, dense[f] * x, j - i)
            p = 1 / (1 + np.exp(-np.clip(m["scale"] * margin + m["offset"], -35, 35)))
            if m["empty"]:
                p = np.full(b.num_rows, 0.5)
            rest = [c for c in b.schema.names if c != "_text"]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in rest), pa.array(p)],
                                             names=[*rest, "score"])
    return run


def score(docs: DataFrame, model: dict, keep: list, text: str = "text") -> DataFrame:
    """``keep`` columns and the probability of label 1 for every row, from its whole text."""
    cast = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(*keep, F.col(text).alias("_text"))
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}"
                     for f in rows.schema.fields[:-1])
    return rows.mapInArrow(_score(cast), f"{kept}, score double")
