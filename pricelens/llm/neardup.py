"""Near-duplicate groups by min-max hashing.

Each hash function gives a document two signature values, the smallest and the largest hash
of its shingles; both agree between two sets with a probability equal to their similarity,
so half the evaluations fill the same signature. ``ROWS`` minima (or maxima) of different
functions make a band. Lower thresholds get shorter bands (``layout``): at 0.85 there are 40
bands of 6, at 0.80 48 bands of 5, and a pair right at the threshold misses all of them with
probability 6e-9. Before full sets are fetched, a pair passes three tests: sizes; a bitmap
of ``BITMAP`` bits per set, whose bits on one side only are members on one side only, an
exact bound; and a sketch of two bits of every signature value, which drops pairs of larger
sets that differ in more bits than a pair at the threshold does with probability 1e-7
(``most_differing``).

Documents with the same set form one class, compared once. Within a bucket of a band, all
classes are first compared with the bucket's most central class only, that which shares most
buckets with others (a star, so a bucket of n classes makes n pairs; copies that were edited
apart gather around their original). Buckets whose classes all ended in one component are
done. In the rest, classes outside the component of the next few central ones are compared
with these. What then is still open meets in blocks of ``BLOCK`` classes of one bucket:
those of different components whose sizes, bitmaps and sketches allow a link go on. Buckets have no cap, and every pair in a bucket is compared
or already connected. Every link is confirmed on full sets of 64-bit shingle hashes.

Defined cases: a text of 1 to 4 words is one shingle; null, empty or blank texts have the
empty set, link with nothing and are their own component; repeated rows are equal sets;
a null id is never the smallest of a group that has another id; extra columns are ignored."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import text as T
from .components import components
from .util import join_rows, materialise, text_key

SHINGLE = 5
ROWS = 6
GROUPS = 20                     # of ROWS hash functions each, a minimum and a maximum band
PERCENT = 85
MISS_BANDS = 6e-9               # of a pair at the threshold: sharing no band,
MISS_SKETCH = 1e-7              # and being dropped by the sketch
BITMAP = 1024
SURE_SIZE = 30                  # sets smaller than this are always compared in full
CENTRAL = (1, 4)                # most central classes of a bucket that each round compares
BLOCK = 256                     # classes of a bucket that meet in one task


def layout(percent: int) -> tuple[int, int]:
    """Rows of a band and groups of functions for a threshold: the longest bands which a pair
    at the threshold misses, all of them, with a probability of ``MISS_BANDS`` at most."""
    if not 0 < percent <= 100:
        raise ValueError(f"percent must be over 0 and at most 100, not {percent}")
    for rows in range(ROWS, 0, -1):
        groups = ROWS * GROUPS // rows
        missed = 1 - (percent / 100) ** rows
        if missed ** (2 * groups) <= MISS_BANDS:
            return rows, groups
    return 1, math.ceil(math.log(MISS_BANDS) / math.log(missed) / 2)


@cache
def most_differing(values: int, percent: int) -> int:
    """The bits in which the sketches of ``values`` signature values may differ: a pair at
    the threshold differs in more with a probability of ``MISS_SKETCH`` at most. A value
    differs with probability 1 - similarity, and then each of its two bits in half the cases."""
    apart = 1 - percent / 100
    one, chance = np.array([1 - 0.75 * apart, 0.5 * apart, 0.25 * apart]), np.ones(1)
    for _ in range(values):
        chance = np.convolve(chance, one)
    more = np.cumsum(chance[::-1])[::-1]                # of differing in so many bits or more
    return int(np.count_nonzero(more > MISS_SKETCH)) - 1


def _functions(n: int) -> tuple[np.ndarray, np.ndarray]:
    x = T.mix(np.arange(1, 2 * n + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
    return x[:n] | np.uint64(1), x[n:]


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each document."""
    w = T.words(data, offsets, T.NONSPACE)
    g = T.grams(w.hashes, k, salt=k)
    out = []
    for lo, hi in zip(w.bounds[:-1].tolist(), w.bounds[1:].tolist()):
        n = hi - lo
        if n >= k:
            out.append(np.unique(g[lo:hi - k + 1]))
        else:
            out.append(T.grams(w.hashes[lo:hi], n, salt=n) if n else g[:0])
    return out


def _bands(sets: list[np.ndarray], rows: int, groups: int) -> tuple[np.ndarray, np.ndarray]:
    """documents x (2 * groups) band hashes, and documents x words: the two lowest bits of
    all signature values, then the bitmap of the set; every set has a member."""
    u = np.concatenate(sets)
    at = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    a, b = _functions(rows * groups)
    out = np.zeros((len(sets), 2 * groups), np.uint64)
    bits = np.zeros((len(sets), -(-4 * rows * groups // 64)), np.uint64)
    for f in range(rows * groups):
        v = u * a[f]
        v += b[f]
        for side, pick in enumerate((np.minimum, np.maximum)):
            value = T.mix(pick.reduceat(v, at))
            col = 2 * (f // rows) + side
            out[:, col] = T.mix(out[:, col] * np.uint64(31) + value + np.uint64(col))
            word, shift = divmod(4 * f + 2 * side, 64)
            bits[:, word] |= (value & np.uint64(3)) << np.uint64(shift)
    maps = np.zeros((len(sets), BITMAP), bool)
    maps[np.repeat(np.arange(len(sets)), [len(s) for s in sets]),
         (u >> np.uint64(20)).astype(np.int64) % BITMAP] = True
    return out, np.hstack([bits, np.packbits(maps, axis=1).view(np.uint64)])


def _signatures(rows: int, groups: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes, cls, bands, sketch = [], [], [], []
            for _, _, data, off in T.doc_chunks(b.column("text")):
                sets = shingle_sets(data, off)
                full = [s for s in sets if len(s)]
                got = _bands(full, rows, groups) if full else ((), ())
                sig = iter([x.view(np.int64) for pair in zip(*got) for x in pair])
                for s in sets:
                    sizes.append(len(s))
                    cls.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest()
                               if len(s) else None)
                    bands.append(next(sig) if len(s) else None)
                    sketch.append(next(sig) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc"), b.column("tkey"), pa.array(sizes, pa.int64()),
                 pa.array(cls, pa.binary()), pa.array(bands, pa.list_(pa.int64())),
                 pa.array(sketch, pa.list_(pa.int64()))],
                names=["doc", "tkey", "n_shingles", "cls", "bands", "sketch"])
    return run


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for i, j, data, off in T.doc_chunks(b.column("text")):
            yield pa.RecordBatch.from_arrays(
                [b.column("cls").slice(i, j - i),
                 pa.array([s.view(np.int64) for s in shingle_sets(data, off)],
                          pa.list_(pa.int64()))], names=["cls", "shingles"])


def _possible(x, y, words: list[str], percent: int, most: int) -> Column:
    """Whether sizes, bitmaps and sketches leave room for a link. ``x`` and ``y`` give the
    columns of either side; ``spare`` is the set's size less the bits of its bitmap, so the
    bits in common and the smaller spare bound the intersection from above; sketches may
    differ in ``most`` bits."""
    common = sum((F.bit_count(x(m).bitwiseAND(y(m))) for m in words if m.startswith("m")), F.lit(0))
    room = ((100 + percent) * common >= percent * (x("n") + y("n"))
            - (100 + percent) * F.least(x("spare"), y("spare")))
    values = [w for w in words if w.startswith("k")]
    differ = sum((F.bit_count(x(k).bitwiseXOR(y(k))) for k in values), F.lit(0))
    return room & ((differ <= most) | (F.least(x("n"), y("n")) < SURE_SIZE))


def _verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose full sets are similar enough."""
    both = (pairs.join(sets.select(F.col("cls").alias("a"), F.col("shingles").alias("sa")), "a")
            .join(sets.select(F.col("cls").alias("b"), F.col("shingles").alias("sb")), "b"))
    return (both.select("a", "b", F.size(F.array_intersect("sa", "sb")).alias("c"),
                        (F.size("sa") + F.size("sb")).alias("n"))
            .where(100 * F.col("c") >= percent * (F.col("n") - F.col("c"))).select("a", "b"))


def _words(members: DataFrame) -> list[str]:
    return [c for c in members.columns if c[:1] in "km" and c[1:].isdigit()]


def _pair_test(x, y, words: list[str], percent: int, most: int) -> Column:
    return (x("comp") != y("comp")) & _possible(x, y, words, percent, most)


def _open(members: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Members of the buckets that hold two components, with their component."""
    if labels is None:
        return members.withColumn("comp", F.col("cls"))
    known = members.join(labels.withColumnRenamed("node", "cls"), "cls", "left").withColumn(
        "comp", F.coalesce("label", "cls")).drop("label")
    live = (known.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"))
            .where("lo != hi").select("key"))
    return materialise(known.join(live, "key"), "dup-open")


def _central_pairs(members: DataFrame, top: int, percent: int, most: int) -> DataFrame:
    """Possible links with the ``top`` most central classes of each bucket. Only that many
    rows of a bucket leave each map task for the ranking."""
    rank = F.row_number().over(Window.partitionBy("key").orderBy(F.desc("central"), "cls"))
    hubs = members.withColumn("rank", rank).where(F.col("rank") <= top).alias("x")
    x, y = lambda c: F.col(f"x.{c}"), lambda c: F.col(f"y.{c}")
    return (members.alias("y").join(hubs, (x("key") == y("key"))
                                    & _pair_test(x, y, _words(members), percent, most))
            .select(F.least(x("cls"), y("cls")).alias("a"), F.greatest(x("cls"), y("cls")).alias("b"))
            .distinct())


def _block_links(batch: dict[str, np.ndarray], percent: int,
                 most: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the possible links in the rows of one pair of blocks."""
    one = batch["at"] == batch["p"]
    left = np.flatnonzero(one)
    right = left if batch["p"][0] == batch["q"][0] else np.flatnonzero(~one)
    if not len(left) or not len(right):
        return left[:0], left[:0]
    n, spare, comp = batch["n"], batch["spare"], batch["comp"]
    ok = comp[left][:, None] != comp[right][None, :]
    if right is left:
        ok &= left[:, None] < right[None, :]
    common = np.zeros(ok.shape, np.int64)
    for m in batch["maps"]:
        common += np.bitwise_count(m[left][:, None] & m[right][None, :])
    total = n[left][:, None] + n[right][None, :]
    least = np.minimum(spare[left][:, None], spare[right][None, :])
    ok &= (100 + percent) * (common + least) >= percent * total
    i, j = np.nonzero(ok)
    i, j = left[i], right[j]
    differ = sum((np.bitwise_count(k[i] ^ k[j]).astype(np.int64) for k in batch["values"]),
                 np.zeros(len(i), np.int64))
    near = (differ <= most) | (np.minimum(n[i], n[j]) < SURE_SIZE)
    return i[near], j[near]


def _meet(words: list[str], percent: int, most: int):
    """Rows sorted by pair of blocks -> possible links."""
    def arrays(b: pa.RecordBatch) -> dict[str, np.ndarray]:
        num = lambda c: b.column(c).to_numpy(zero_copy_only=False)
        out = {c: num(c) for c in ("key", "p", "q", "at", "n", "spare")}
        for c in ("cls", "comp"):
            out[c] = np.frombuffer(b"".join(x.as_py() for x in b.column(c)), "V16")
        for name, first in (("maps", "m"), ("values", "k")):
            out[name] = [num(c).view(np.uint64) for c in words if c.startswith(first)]
        return out

    def cut(x: dict, lo: int, hi: int | None) -> dict:
        return {c: [w[lo:hi] for w in v] if isinstance(v, list) else v[lo:hi] for c, v in x.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for b in chain(batches, [None]):
            if b is None:
                rows, done = held, True
            else:
                rows, done = arrays(b), False
                if held is not None:
                    rows = {c: [np.concatenate(w) for w in zip(held[c], v)] if isinstance(v, list)
                            else np.concatenate([held[c], v]) for c, v in rows.items()}
            if rows is None or not len(rows["key"]):
                held = rows
                continue
            change = (np.diff(rows["key"]) != 0) | (np.diff(rows["p"]) != 0) | (np.diff(rows["q"]) != 0)
            ends = [*(np.flatnonzero(change) + 1).tolist(), len(rows["key"])]
            if not done:
                ends, last = ends[:-1], (ends[-2] if len(ends) > 1 else 0)
            found: list[tuple[np.ndarray, np.ndarray]] = []
            for lo, hi in zip([0, *ends], ends):
                i, j = _block_links(cut(rows, lo, hi), percent, most)
                if len(i):
                    x, y = rows["cls"][lo:hi][i], rows["cls"][lo:hi][j]
                    found += [(u.tobytes(), v.tobytes()) for u, v in zip(x, y)]
            held = None if done else cut(rows, last, None)
            yield pa.RecordBatch.from_arrays(
                [pa.array([min(f) for f in found], pa.binary()),
                 pa.array([max(f) for f in found], pa.binary())], names=["a", "b"])
    return run


def _open_pairs(members: DataFrame, percent: int, most: int) -> DataFrame:
    """Possible links between classes of different components that share a bucket.

    The classes of a bucket are dealt to blocks; each pair of blocks is tested as a whole in
    numpy, so a bucket of any size is spread over tasks of bounded work, and only what
    passes becomes rows."""
    words = _words(members)
    blocks = members.groupBy("key").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    full = members.join(blocks, "key").withColumn("at", F.pmod(F.xxhash64("cls"), F.col("blocks")))
    every = F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)
    dealt = full.select("key", "at", "cls", "comp", "n", "spare", *words, F.explode(every).alias("to"))
    dealt = dealt.select("key", F.least("at", "to").alias("p"), F.greatest("at", "to").alias("q"),
                         "at", "cls", "comp", "n", F.col("spare").cast("long").alias("spare"), *words)
    return (dealt.repartition("key", "p", "q").sortWithinPartitions("key", "p", "q")
            .mapInArrow(_meet(words, percent, most), "a binary, b binary").distinct())


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    percent: int = PERCENT, rows: int | None = None,
                    groups: int | None = None) -> DataFrame:
    """Per document row: doc, tkey, n_shingles, component (smallest id of the documents it
    is linked with, directly or through others; its own id if with none) and group (a digest
    that all rows of a component share; null without words).
    Documents are linked at a similarity of ``percent`` hundredths or more; bands and sketch
    follow from it (``rows`` and ``groups`` override the bands)."""
    rows, groups = rows or layout(percent)[0], groups or layout(percent)[1]
    most = most_differing(2 * rows * groups, percent)
    src = docs.select(F.col(doc_id).alias("doc"), text_key(text).alias("tkey"),
                      F.col(text).alias("text"))
    kind = src.schema["doc"].dataType.simpleString()
    sig = materialise(src.mapInArrow(
        _signatures(rows, groups),
        f"doc {kind}, tkey long, n_shingles long, cls binary, bands array<long>, "
        "sketch array<long>"), "dup-sig")
    classes = materialise(
        sig.where(F.col("cls").isNotNull()).groupBy("cls")
        .agg(F.min("doc").alias("first"), F.min(F.struct("doc", "tkey")).alias("row"),
             F.first("bands").alias("bands"), F.first("sketch").alias("sketch"),
             F.first("n_shingles").alias("n")), "dup-classes")

    member = classes.select("cls", F.explode("bands").alias("key"))
    shared = member.groupBy("key").agg(F.count("*").alias("with")).where(F.col("with") > 1)
    buckets = materialise(member.join(shared, "key"), "dup-buckets")
    names = [f"k{i}" for i in range(-(-4 * rows * groups // 64))] + [f"m{i}" for i in range(BITMAP // 64)]
    light = materialise(
        buckets.groupBy("cls").agg(F.sum("with").alias("central")).join(classes, "cls").select(
            "cls", "central", "n", "row",
            *[F.element_at("sketch", i + 1).alias(c) for i, c in enumerate(names)]), "dup-light")
    spare = F.col("n") - sum((F.bit_count(m) for m in names if m.startswith("m")), F.lit(0))
    # the full sets of the classes that share a bucket with another
    wanted = light.select("cls", F.col("row.doc").alias("doc"), F.col("row.tkey").alias("tkey"))
    sets = materialise(join_rows(src, wanted, ["doc", "tkey"]).select("cls", "text")
                       .mapInArrow(_sets, "cls binary, shingles array<long>")
                       .dropDuplicates(["cls"]), "dup-sets")

    members = buckets.select("key", "cls").join(light.drop("row").withColumn("spare", spare), "cls")
    links = labels = None
    for step in (*CENTRAL, None):
        state = _open(members, labels)
        pairs = (_open_pairs(state, percent, most) if step is None
                 else _central_pairs(state, step, percent, most))
        found = materialise(_verify(pairs, sets, percent), "dup-links")
        if labels is None or not found.isEmpty():
            links = found if links is None else links.union(found)
            labels = components(links)

    firsts = (labels.join(classes.select(F.col("cls").alias("node"), "first"), "node"))
    roots = firsts.groupBy("label").agg(F.min("first").alias("root"))
    linked = firsts.join(roots, "label").select(F.col("node").alias("cls"), "root", "label")
    owner = classes.join(linked, "cls", "left").select(
        "cls", F.when(F.col("label").isNull(), F.col("first")).otherwise(F.col("root")).alias("component"),
        F.coalesce("label", "cls").alias("group"))
    return (sig.select("doc", "tkey", "n_shingles", "cls").join(owner, "cls", "left")
            .select("doc", "tkey", "n_shingles", "group",
                    F.when(F.col("cls").isNull(), F.col("doc")).otherwise(F.col("component"))
                    .alias("component")))
