"""Approximate nearest neighbours by multi-index hashing.

A bounded sample (``SAMPLE`` rows, by hash) trains the codes: centred principal directions,
turned by rotations that bring the components close to their signs (one rotation gives as
many bits as a vector has components, several give ``BITS``). Every row is coded. A slice of
the index holds, of its rows, the vectors, the codes, and one table for each of the 16-bit
substrings. Codes within Hamming radius r of a query agree with it in some substring but for
r // substrings bits (one less in the later ones), so probing the tables at these distances
retrieves all of them; whole codes confirm the radius and the vectors, in doubles, the order.

A probe lists the values around the query's or tests the substrings that are there,
whichever are fewer; far radii (vectors without clusters) come to the second. Each query has its own radius: its k-th cosine within the sample bounds the k-th
of all rows, and pairs of the sample tell within which Hamming distance ``KEPT`` of the pairs
lie that are this near. A first probe at a small radius tightens the bound before the full
one, so a query in a dense region asks for a small radius only.

Spark deals rows to slices of at most about ``SLICE_ROWS`` by hash and every query to every
slice, sorts a slice's rows before its queries, and keeps the best k of the slices' answers.
Of rows with one vector only the k + 1 smallest ids can answer; the rest are dropped batch by
batch before the shuffle, and again in their slice, so that copies of one vector, however
many, make no hot slice. No pair leaves a slice unless it is among the slice's best k.

Defined cases: rows with a null id, and vectors that are null, empty, zero, hold a null or a
value that is not finite, or have another number of components than most (ties: more), take
no part; rows equal in id and vector are one row; rows of one id and several vectors are
queries of their own, and as answers the nearest of them stands for the id; fewer candidates
than k give them all; equal cosines go to the smaller id; an empty table gives no rows; extra
columns are ignored."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .util import hash_unit

BITS = 256
SUB = 16
SAMPLE = 4096
KEPT = 0.98
CALIBRATION_ROWS = 512
BIN_PAIRS = 100
SLICES = 16
SLICE_ROWS = 1 << 18
LISTED = 16  # a table is listed by value where that meets less than a 16th of it
BLOCK = 1 << 20  # queries x rows of a slice looked at together
_SEEN = np.array(sorted(range(1 << SUB), key=lambda v: (v.bit_count(), v)), np.uint16)
_BALL = np.searchsorted(np.bitwise_count(_SEEN), np.arange(SUB + 1), side="right")  # values within t bits


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of each row of ``a`` with the same row of ``b``, in doubles."""
    a, b = a.astype(np.float64), b.astype(np.float64)
    dot, aa, bb = (np.einsum("ij,ij->i", x, y) for x, y in ((a, b), (a, a), (b, b)))
    return dot / (np.sqrt(aa) * np.sqrt(bb))


def _unit(v: np.ndarray) -> np.ndarray:
    v = v.astype(np.float64)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def best_of(query: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best of each query: largest score first, ties to the smaller id;
    an id that stands several times counts with its best score."""
    order = np.lexsort((-scores, ids, query))
    q, i = query[order], ids[order]
    order = order[np.concatenate([[True], (q[1:] != q[:-1]) | (i[1:] != i[:-1])])[:len(order)]]
    order = order[np.lexsort((ids[order], -scores[order], query[order]))]
    q = query[order]
    return order[np.arange(len(q)) - np.searchsorted(q, q) < k]


@dataclass
class Codes:
    """The trained codes and what the sample tells about them."""
    mean: np.ndarray
    turn: np.ndarray     # components x bits
    edges: np.ndarray    # ascending cosines
    radii: np.ndarray    # radii[i] for cosines of at least edges[i]
    ids: np.ndarray      # the sample
    vectors: np.ndarray

    def encode(self, v: np.ndarray) -> np.ndarray:
        """rows x (BITS / 16) substrings."""
        bits = (_unit(v) - self.mean) @ self.turn > 0
        return np.packbits(bits, axis=1).view(np.uint16)

    def radius(self, cosine: np.ndarray) -> np.ndarray:
        return self.radii[np.searchsorted(self.edges, cosine, side="right") - 1]

    def seeds(self, ids: np.ndarray, v: np.ndarray, k: int):
        """(query position, id, score) of the best k of the sample for each query, and the
        radius that follows from the k-th."""
        near = _unit(v) @ _unit(self.vectors).T if len(self.ids) else np.empty((len(v), 0))
        top = np.argsort(-near, axis=1, kind="stable")[:, :k + 1]
        query, at = np.repeat(np.arange(len(v)), top.shape[1]), top.ravel()
        other = (self.ids[at] != ids[query]) | (self.vectors[at] != v[query]).any(axis=1)
        query, at = query[other], at[other]
        scores = cosines(self.vectors[at], v[query])
        keep = best_of(query, self.ids[at], scores, k)
        query, at, scores = query[keep], at[keep], scores[keep]
        least = np.full(len(v), -2.0)
        count = np.bincount(query, minlength=len(v))
        np.minimum.at(filled := np.full(len(v), 2.0), query, scores)
        least[count == k] = filled[count == k]
        return query, self.ids[at], scores, self.radius(least)


def hamming(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of substrings (.. x m) each."""
    return np.bitwise_count(np.ascontiguousarray(a).view(np.uint64)
                            ^ np.ascontiguousarray(b).view(np.uint64)).sum(axis=-1, dtype=np.int64)


def train(ids: np.ndarray, vectors: np.ndarray, bits: int = BITS, rounds: int = 20, seed: int = 7) -> Codes:
    """Codes from the sample ``vectors`` (rows that differ)."""
    v = _unit(vectors)
    mean = v.mean(axis=0)
    centred = v - mean
    values, axes = np.linalg.eigh(centred.T @ centred)
    axes = axes[:, np.argsort(-values)][:, :bits]
    flat = centred @ axes
    rng = np.random.default_rng(seed)
    turns, d = [], axes.shape[1]
    while sum(t.shape[1] for t in turns) < bits:
        turn = np.linalg.qr(rng.normal(size=(d, d)))[0]
        for _ in range(rounds):
            u, _, w = np.linalg.svd(flat.T @ np.where(flat @ turn > 0, 1.0, -1.0))
            turn = u @ w
        turns.append(axes @ turn)
    codes = Codes(mean, np.hstack(turns)[:, :bits], np.array([-np.inf]), np.array([bits]), ids, vectors)
    # pairs of the sample: which distance holds KEPT of the pairs of about a cosine or more
    own = codes.encode(vectors)
    asked = np.arange(min(len(v), CALIBRATION_ROWS))
    pair = [(a, np.arange(a + 1, len(v))) for a in asked]
    cosine = np.concatenate([v[b] @ v[a] for a, b in pair])
    dist = np.concatenate([hamming(own[b], own[a]) for a, b in pair])
    step = np.floor(cosine * 50)
    order = np.lexsort((dist, step))
    step, dist = step[order], dist[order]
    edges, first, count = np.unique(step, return_index=True, return_counts=True)
    radii, largest = [bits], bits
    for e, f, n in zip(edges, first, count):
        if n >= BIN_PAIRS:  # else as its less similar neighbour
            largest = min(largest, int(dist[f + int(np.ceil(KEPT * n)) - 1]))
        radii.append(largest)
    codes.edges, codes.radii = np.concatenate([[-np.inf], edges / 50]), np.array(radii)
    return codes


class Slice:
    """Rows of a slice with one table per substring."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, codes: np.ndarray, k: int):
        # equal vectors: the k + 1 smallest ids stay
        stay = copies_kept(ids, vectors, k)
        self.ids, self.vectors, self.codes, self.k = ids[stay], vectors[stay], codes[stay], k
        self.columns = np.ascontiguousarray(self.codes.T)  # one row per substring
        self.words = np.ascontiguousarray(self.codes).view(np.uint64)
        self.tables = [(np.argsort(values, kind="stable"),
                        np.concatenate([[0], np.cumsum(np.bincount(values, minlength=1 << SUB))]))
                       for values in self.columns]

    def within(self, codes: np.ndarray, radius: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query position, row) of every code within the radius of its query."""
        m, most = codes.shape[1], int(radius.max())
        seen = np.zeros((len(codes), len(self.ids)), bool)
        for j, (order, starts) in enumerate(self.tables):
            bits = most // m - (j > most % m)
            if bits < 0:
                break
            mine = codes[:, j, None]
            if _BALL[bits] * LISTED > min(1 << SUB, len(self.ids)):
                seen |= np.bitwise_count(mine ^ self.columns[j]) <= bits
                continue
            values = (mine ^ _SEEN[:_BALL[bits]]).ravel().astype(np.int64)
            begin = starts[values]
            count = starts[values + 1] - begin
            ends = np.cumsum(count)
            at = np.arange(ends[-1]) + np.repeat(begin - ends + count, count)
            seen[np.repeat(np.repeat(np.arange(len(codes)), _BALL[bits]), count), order[at]] = True
        asked = np.ascontiguousarray(codes).view(np.uint64)
        if np.count_nonzero(seen) * LISTED > seen.size:
            apart = np.zeros(seen.shape, np.int16)
            for w in range(self.words.shape[1]):
                apart += np.bitwise_count(asked[:, w, None] ^ self.words[:, w])
            return np.nonzero(seen & (apart <= radius[:, None]))
        query, row = np.nonzero(seen)
        near = np.bitwise_count(self.words[row] ^ asked[query]).sum(axis=1, dtype=np.int64) <= radius[query]
        return query[near], row[near]

    def _scored(self, ids, vectors, codes, radius):
        """The best k within the radius of each query, its own row left out."""
        query, row = self.within(codes, radius)
        parts = []
        for at in range(0, len(row), 1 << 17):
            q, r = query[at:at + (1 << 17)], row[at:at + (1 << 17)]
            other = (self.ids[r] != ids[q]) | (self.vectors[r] != vectors[q]).any(axis=1)
            q, r = q[other], r[other]
            score = cosines(self.vectors[r], vectors[q])
            keep = best_of(q, self.ids[r], score, self.k)
            parts.append((q[keep], self.ids[r[keep]], score[keep]))
        query, found, score = (np.concatenate(x) for x in zip(*parts)) if parts else \
            (np.empty(0, np.int64), self.ids[:0], np.empty(0))
        keep = best_of(query, found, score, self.k)
        return query[keep], found[keep], score[keep]

    def search(self, ids, vectors, codes, radius, of_cosine) -> Iterator[tuple]:
        """(query position, id, score) of the best k of the slice within each radius."""
        if not len(self.ids):
            return
        order = np.argsort(radius, kind="stable")
        near = 2 * codes.shape[1] - 1  # every table within one bit
        step = max(1, BLOCK // len(self.ids))
        for at in range(0, len(order), step):
            q = order[at:at + step]
            r = radius[q].copy()
            found = self._scored(ids[q], vectors[q], codes[q], np.minimum(r, near))
            count = np.bincount(found[0], minlength=len(q))
            least = np.full(len(q), 2.0)
            np.minimum.at(least, found[0], found[2])
            full = count == self.k
            r[full] = np.minimum(r[full], of_cosine(least[full]))
            more = r > near
            if more.any():
                done = ~more[found[0]]
                yield q[found[0][done]], found[1][done], found[2][done]
                q = q[more]
                found = self._scored(ids[q], vectors[q], codes[q], r[more])
            yield q[found[0]], found[1], found[2]


def copies_kept(ids: np.ndarray, vectors: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k + 1 smallest different ids of each vector."""
    if not len(ids):
        return np.empty(0, np.int64)
    whole = np.ascontiguousarray(vectors).view(np.dtype((np.void, vectors.itemsize * vectors.shape[1]))).ravel()
    group = np.unique(whole, return_inverse=True)[1]
    order = np.lexsort((ids, group))
    g, i = group[order], ids[order]
    order = order[np.concatenate([[True], (g[1:] != g[:-1]) | (i[1:] != i[:-1])])]
    g = group[order]
    return np.sort(order[np.arange(len(g)) - np.searchsorted(g, g) <= k])


def prepared(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, v, key) of the rows that may take part; ``key`` hashes the vector."""
    usable = (F.col(id_col).isNotNull() & (F.size(vec_col) > 0)
              & F.forall(vec_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
              & F.exists(vec_col, lambda x: x != 0))
    # -0.0 + 0 is 0.0: equal vectors have equal bytes
    zero = F.lit(0).cast(df.schema[vec_col].dataType.elementType)
    return (df.where(usable).select(F.col(id_col).alias("id"), F.transform(vec_col, lambda x: x + zero).alias("v"))
            .withColumn("key", F.xxhash64("v")))


def most_frequent_size(rows: DataFrame) -> tuple[int, int]:
    """How many components most vectors have, and how many vectors those are."""
    top = (rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n"))
           .orderBy(F.desc("n"), F.desc("d")).limit(1).collect())
    return (top[0]["d"], top[0]["n"]) if top else (0, 0)


def _vectors(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def fit(rows: DataFrame, dims: int, count: int, sample: int = SAMPLE) -> Codes:
    """Train on about ``sample`` of the ``count`` rows, chosen by a hash (all, if no more)."""
    some = rows.where(hash_unit(F.lit("codes"), F.col("id")) < sample / count) if count > sample else rows
    got = some.select("id", "v").toArrow().combine_chunks()  # about ``sample`` rows
    ids = got.column("id").to_numpy()
    vectors = _vectors(got.column("v").combine_chunks(), dims) if len(ids) else np.empty((0, dims))
    stay = copies_kept(ids, vectors, len(ids))
    stay = stay[np.argsort(ids[stay], kind="stable")]
    return train(ids[stay], vectors[stay])


def search(df: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id",
           vec_col: str = "embedding", sample: int = SAMPLE) -> DataFrame:
    """(query, rank, id, score): for every row of ``queries`` (rows of ``df``) the k nearest
    found among the other rows of ``df``, nearest first."""
    rows = prepared(df, id_col, vec_col)
    id_type = rows.schema["id"].dataType.simpleString()
    dims, count = most_frequent_size(rows)
    result = f"query {id_type}, key long, id {id_type}, score double"
    if not count:
        return df.sparkSession.createDataFrame([], f"query {id_type}, rank int, id {id_type}, score double")
    rows = rows.where(F.size("v") == dims)
    asked = (prepared(queries, id_col, vec_col).where(F.size("v") == dims).dropDuplicates(["id", "key"]))
    codes = fit(rows, dims, count, sample)
    slices = max(SLICES, -(-count // SLICE_ROWS))

    def answer(names, keys, query, found, score):
        return pa.RecordBatch.from_arrays(
            [names.take(pa.array(query)), keys.take(pa.array(query)), pa.array(found, names.type),
             pa.array(score, pa.float64())], ["query", "key", "id", "score"])

    def from_sample(batches):
        for b in batches:
            v = _vectors(b.column("v"), dims)
            query, found, score, _ = codes.seeds(b.column("id").to_numpy(), v, k)
            yield answer(b.column("id"), b.column("key"), query, found, score)

    def with_radius(batches):
        for b in batches:
            v = _vectors(b.column("v"), dims)
            radius = codes.seeds(b.column("id").to_numpy(), v, k)[3]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(radius, pa.int32())],
                                             ["id", "v", "key", "radius"])

    def thinned(batches):
        for b in batches:
            yield b.take(pa.array(copies_kept(b.column("id").to_numpy(), _vectors(b.column("v"), dims), k)))

    def from_slices(batches):
        at, parts, built = None, [], None
        for b in batches:
            mark = np.stack([b.column("slice").to_numpy(), b.column("radius").is_valid().to_numpy(False)])
            cuts = np.flatnonzero((mark[:, 1:] != mark[:, :-1]).any(axis=0)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, b.num_rows]):
                if lo == hi:
                    continue
                piece = b.slice(lo, hi - lo)
                ids, v = piece.column("id").to_numpy(), _vectors(piece.column("v"), dims)
                if mark[0, lo] != at:
                    at, parts, built = mark[0, lo], [], None
                if not mark[1, lo]:
                    parts.append((ids, v))
                    continue
                if built is None:
                    ids_in, v_in = ((np.concatenate(x) for x in zip(*parts)) if parts else (ids[:0], v[:0]))
                    built, parts = Slice(ids_in, v_in, codes.encode(v_in), k), []
                radius = piece.column("radius").to_numpy()
                for query, found, score in built.search(ids, v, codes.encode(v), radius, codes.radius):
                    yield answer(piece.column("id"), piece.column("key"), query, found, score)

    kinds = f"id {id_type}, v {rows.schema['v'].dataType.simpleString()}, key long"
    dealt = rows.mapInArrow(thinned, kinds).select(
        F.pmod(F.xxhash64(F.lit("slice"), "id", "key"), F.lit(slices)).cast("int").alias("slice"),
        F.lit(None).cast("int").alias("radius"), "id", "v", "key")
    everywhere = asked.mapInArrow(with_radius, kinds + ", radius int").select(
        F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("slice"), "radius", "id", "v", "key")
    answers = (dealt.unionByName(everywhere).repartition(slices, "slice")
               .sortWithinPartitions("slice", F.col("radius").asc_nulls_first())
               .mapInArrow(from_slices, result))
    # the sample's answers stand as well: k of them at least, whatever the radius gave
    best = Window.partitionBy("query", "key").orderBy(F.desc("score"), "id")
    return (answers.unionByName(asked.mapInArrow(from_sample, result))
            .groupBy("query", "key", "id").agg(F.max("score").alias("score"))
            .withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query", "rank", "id", "score"))
