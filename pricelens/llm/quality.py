"""Quality: random-indexing word vectors pooled per document, then a two-layer network.

Every word has a fixed sparse ternary index vector (from its hash). A word's context vector
is the sum of the index vectors of its neighbours over the whole corpus; words share
``BUCKETS`` rows by hash, so a task folds its part of the corpus into one bounded table and
Spark adds the tables up. A document is the mean and the spread of its words' vectors, the
mean step between neighbouring words, and its length.

A network with one hidden layer is fitted in numpy on a bounded, documented sample of
``SAMPLE`` labelled rows (features only); a fifth of them sets the temperature that turns
its output into probabilities.

Defined cases: a null, empty or wordless text pools to zeros and gets that point's score;
equal texts score alike; without any labelled row all scores are 0.5; null labels teach
nothing; extra columns are ignored."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as T
from .toxicity import sample_labelled

DIM = 32
BUCKETS = 1 << 14
WINDOW = 2
NONZERO = 2
SAMPLE = 16_000
HIDDEN = 32
EPOCHS = 40


def _index_entries(h: np.ndarray, dim: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(coordinate, sign) of each nonzero of the words' index vectors."""
    out = []
    for j in range(NONZERO):
        x = T.mix(h + np.uint64(0xA5A5 + j))
        out.append(((x % np.uint64(dim)).astype(np.int64),
                    1.0 - 2.0 * ((x >> np.uint64(40)) & np.uint64(1)).astype(float)))
    return out


def _bucket(h: np.ndarray, buckets: int) -> np.ndarray:
    return (h % np.uint64(buckets)).astype(np.int64)


def _contexts(dim: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets * dim)
        for b in batches:
            for _, _, data, off in T.doc_chunks(b.column("text")):
                w = T.words(data, off, T.NONSPACE)
                doc = np.repeat(np.arange(len(w.bounds) - 1), np.diff(w.bounds))
                row = _bucket(w.hashes, buckets) * dim
                entries = _index_entries(w.hashes, dim)
                cells, signs = [], []
                for o in range(1, WINDOW + 1):
                    same = doc[:-o] == doc[o:]
                    for at, sign in entries:
                        cells += [(row[:-o] + at[o:])[same], (row[o:] + at[:-o])[same]]
                        signs += [sign[o:][same], sign[:-o][same]]
                if cells:
                    total += np.bincount(np.concatenate(cells), np.concatenate(signs), buckets * dim)
        table = total.reshape(buckets, dim)
        used = np.flatnonzero(table.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(used.astype(np.int32)),
             *(pa.array(table[used, d].astype(np.int64)) for d in range(dim))],
            names=["bucket", *(f"v{d}" for d in range(dim))])
    return run


def word_vectors(docs: DataFrame, text: str = "text", dim: int = DIM,
                 buckets: int = BUCKETS) -> np.ndarray:
    """float32 [bucket, dim]: unit context vectors over all documents (at most ``buckets``
    rows reach the driver)."""
    cols = [f"v{d}" for d in range(dim)]
    schema = "bucket int, " + ", ".join(f"{c} long" for c in cols)
    sums = (docs.select(F.col(text).alias("text")).mapInArrow(_contexts(dim, buckets), schema)
            .groupBy("bucket").agg(*[F.sum(c).alias(c) for c in cols])).toPandas()
    out = np.zeros((buckets, dim), np.float32)
    out[sums["bucket"].to_numpy(np.int64)] = sums[cols].to_numpy(float)
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9).astype(np.float32)


def pooled(w: T.Words, vectors: np.ndarray) -> np.ndarray:
    """[document, 3 * dim + 2] features of each document."""
    n_docs, dim = len(w.bounds) - 1, vectors.shape[1]
    out = np.zeros((n_docs, 3 * dim + 2))
    n = np.diff(w.bounds)
    full = np.flatnonzero(n > 0)
    if len(full):
        v = vectors[_bucket(w.hashes, len(vectors))]
        starts, count = w.bounds[full], n[full][:, None]
        mean = np.add.reduceat(v, starts, axis=0, dtype=np.float64) / count
        square = np.add.reduceat(v * v, starts, axis=0, dtype=np.float64) / count
        step = np.zeros_like(v)
        np.abs(v[1:] - v[:-1], out=step[1:])
        step[starts] = 0
        out[full, :dim] = mean
        out[full, dim:2 * dim] = np.sqrt(np.maximum(square - mean * mean, 0))
        out[full, 2 * dim:3 * dim] = np.add.reduceat(step, starts, axis=0, dtype=np.float64) / count
        length = np.add.reduceat((w.ends - w.starts).astype(float), starts) / n[full]
        out[full, 3 * dim] = np.log1p(n[full])
        out[full, 3 * dim + 1] = length
    return out


def _pool_rows(vectors):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, data, off in T.doc_chunks(b.column("text")):
                x = pooled(T.words(data, off, T.NONSPACE), vectors.value).astype(np.float32)
                yield pa.RecordBatch.from_arrays(
                    [b.column("label").slice(i, j - i), b.column("tie").slice(i, j - i),
                     pa.array([r.tobytes() for r in x], pa.binary())], names=["label", "tie", "x"])
    return run


class Network:
    """x -> tanh layer -> logit, on standardised features; probability at a temperature."""

    def __init__(self, x: np.ndarray, y: np.ndarray, hidden: int, epochs: int, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.mean, self.std = x.mean(axis=0), x.std(axis=0) + 1e-6
        x = (x - self.mean) / self.std
        cut = max(1, len(x) * 4 // 5)
        self.w = [rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], hidden)), np.zeros(hidden),
                  rng.normal(0, 1 / np.sqrt(hidden), (hidden, 1)), np.zeros(1)]
        m, v, t = [np.zeros_like(a) for a in self.w], [np.zeros_like(a) for a in self.w], 0
        for _ in range(epochs):
            order = rng.permutation(cut)
            for k in range(0, cut, 128):
                xb, yb = x[order[k:k + 128]], y[order[k:k + 128]]
                h = np.tanh(xb @ self.w[0] + self.w[1])
                d = (1 / (1 + np.exp(-(h @ self.w[2] + self.w[3])[:, 0])) - yb)[:, None] / len(xb)
                dh = d @ self.w[2].T * (1 - h * h)
                t += 1
                for i, g in enumerate((xb.T @ dh + 1e-4 * self.w[0], dh.sum(0),
                                       h.T @ d + 1e-4 * self.w[2], d.sum(0))):
                    m[i] = 0.9 * m[i] + 0.1 * g
                    v[i] = 0.999 * v[i] + 0.001 * g * g
                    self.w[i] = self.w[i] - 2e-3 * (m[i] / (1 - 0.9 ** t)) / (
                        np.sqrt(v[i] / (1 - 0.999 ** t)) + 1e-8)
        self.temperature = 1.0
        rest, ry = (x[cut:], y[cut:]) if len(x) > cut else (x, y)
        logit = self._logit(rest)
        grid = np.exp(np.linspace(-1.5, 2.5, 81))
        loss = [np.logaddexp(0, np.where(ry > 0, -logit, logit) / s).mean() for s in grid]
        self.temperature = float(grid[int(np.argmin(loss))])

    def _logit(self, x: np.ndarray) -> np.ndarray:
        return (np.tanh(x @ self.w[0] + self.w[1]) @ self.w[2] + self.w[3])[:, 0]

    def probability(self, x: np.ndarray) -> np.ndarray:
        z = self._logit((x - self.mean) / self.std) / self.temperature
        return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", doc_id: str = "doc_id",
        text: str = "text", sample: int = SAMPLE) -> tuple[np.ndarray, Network | None]:
    """Word vectors of the whole corpus and the network; ``labels`` may be learned from."""
    vectors = word_vectors(docs, text)
    cast = docs.sparkSession.sparkContext.broadcast(vectors)
    rows = (sample_labelled(docs, labels, label, sample, doc_id, text)
            .mapInArrow(_pool_rows(cast), "label int, tie long, x binary")).toPandas()
    if not len(rows):
        return vectors, None
    rows = rows.sort_values(["tie", "x"], kind="stable")
    x = np.stack([np.frombuffer(r, np.float32) for r in rows["x"]]).astype(float)
    return vectors, Network(x, rows["label"].to_numpy(float), HIDDEN, EPOCHS)


def _score(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors, net = model.value
        for b in batches:
            p = np.full(b.num_rows, 0.5)
            if net is not None:
                for i, j, data, off in T.doc_chunks(b.column("_text")):
                    p[i:j] = net.probability(pooled(T.words(data, off, T.NONSPACE), vectors))
            rest = [c for c in b.schema.names if c != "_text"]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in rest), pa.array(p)],
                                             names=[*rest, "score"])
    return run


def score(docs: DataFrame, model: tuple, keep: list, text: str = "text") -> DataFrame:
    """``keep`` columns and the probability of label 1 for every row, from its whole text."""
    cast = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(*keep, F.col(text).alias("_text"))
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(_score(cast), f"{kept}, score double")
