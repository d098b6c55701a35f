"""Document fingerprints as invertible Bloom lookup sketches, in DataFrame operations only.

A document is the set of its paragraphs, each a 64-bit digest: a line, or pieces of a long one
that end with a sentence or word, so that an insertion changes the pieces around it only. Short
texts are cut finer (``SCALES``), so that each has enough pieces for its likeness to mean
something; two texts are compared on the scale of the longer. In a sketch every digest falls into one cell of each of three tables;
a cell keeps a count, the xor of its digests and the xor of their checksums. Sketches of two
versions subtract cell by cell: what the versions share cancels out, and the rest is peeled.
A cell that holds a single digest gives it away; taking that digest out of the other two
tables uncovers more. One table is peeled at a time, so no digest is found twice at once.

The tables of a document have as many cells each as it has paragraphs (rounded up to a power
of two), those of a pair as many as the larger. Pairs that don't peel are tried again with
four times the cells, until all have. The digests recovered give the likeness of two texts:
shared paragraphs by all different paragraphs.

All sketches live in rows (document, cell) and every step is an aggregation by document, on
one partitioning. Nothing depends on how large a document is.

Defined cases: null is the empty text; texts without a paragraph are alike (1) and unlike
any other (0); documents go by id in its own type and order, nulls first, equal ids by a hash
of the text; with one document the next is itself; equal rows are separate documents; extra
columns are ignored."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .util import hash_unit, materialise

#: Texts of fewer characters than the first number are cut by the pattern: words (in parts of
#: at most 12 characters), runs of 24 characters up to the end of a word, and runs of 64 up to
#: the end of a sentence (or 128 more).
SCALES = ((256, r"\S{1,12}"), (1024, r"[^\n]{1,24}\S{0,24}[^\S\n]*"), (None, r"[^\n]{1,64}(?:[^\n.!?]{0,128}[.!?]?)"))
SAMPLE_PER_CUT = 64
ROUNDS = 12
BUCKETS_PER_TASK = 4
GROW = 4


def scale_of(chars: Column) -> Column:
    """Position in ``SCALES`` for a text of so many characters."""
    return F.when(chars < SCALES[0][0], 0).when(chars < SCALES[1][0], 1).otherwise(2)


def paragraphs(text: Column, scale: Column) -> Column:
    """Distinct paragraph digests of a text."""
    parts = [F.regexp_extract_all(text, F.lit(pattern), F.lit(0)) for _, pattern in SCALES]
    return F.array_distinct(F.transform(
        F.when(scale == 0, parts[0]).when(scale == 1, parts[1]).otherwise(parts[2]), lambda x: F.xxhash64(x)))


def _cell(key: Column, table: int, cells: Column) -> Column:
    """The cell of a digest in one of the three tables; tables are numbered apart."""
    return F.lit(table) * cells + F.pmod(F.xxhash64(key, F.lit(table)), cells)


def _check(key: Column) -> Column:
    return F.xxhash64(key, F.lit("check"))


def with_next(docs: DataFrame, doc_id: str, text: str, buckets: int) -> DataFrame:
    """doc, text and the text of the next document by id (after the last, the first).

    Rows are cut into ranges of (id, hash of the text), null ids first, at cuts from a sample
    of about ``SAMPLE_PER_CUT`` rows a range, so one id with many texts is several ranges; each
    range also gets a copy of the first document of the following one, so every range finds
    its own successors."""
    rows = docs.select(F.col(doc_id).alias("doc"), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn(
        "h", F.xxhash64("text"))
    share = buckets * SAMPLE_PER_CUT / max(rows.count(), 1)
    some = rows.select("doc", "h")
    if share < 1:
        some = some.where(hash_unit(F.lit("cut"), F.col("doc"), F.col("h")) < share)
    marks = sorted({(r["doc"] is not None, r["doc"], r["h"]) for r in some.collect()},
                   key=lambda m: (m[0], m[1] if m[0] else 0, m[2]))  # about the sample's rows
    cuts = sorted({len(marks) * i // buckets for i in range(1, buckets)} - {0})
    kind = rows.schema["doc"].dataType
    known, ids, hashes = (F.array(*[F.lit(marks[c][j]).cast(t) for c in cuts])
                          for j, t in enumerate(("boolean", kind, "long")))

    def reached(i: Column) -> Column:
        """The row is at or behind cut ``i``."""
        behind = F.get(hashes, i) <= F.col("h")
        return F.when(F.col("doc").isNull(), ~F.get(known, i) & behind).otherwise(
            ~F.get(known, i) | (F.get(ids, i) < F.col("doc")) | ((F.get(ids, i) == F.col("doc")) & behind))

    steps = [1 << i for i in range(len(cuts).bit_length() - 1, -1, -1)]
    # binary search of the range, in steps of falling powers of two
    bucket = F.aggregate(
        F.lit(steps), F.lit(0),
        lambda lo, s: F.when((lo + s <= len(cuts)) & F.coalesce(reached(lo + s - 1), F.lit(False)),
                             lo + s).otherwise(lo)) if cuts else F.lit(0)
    rows = rows.withColumn("bucket", bucket)
    heads = sorted(
        ((r["bucket"], r["id"], r["h"]) for r in rows.groupBy("bucket").agg(
            F.min(F.struct(F.col("doc").isNotNull().alias("known"), "doc", "h")).alias("m"))
         .select("bucket", F.col("m.doc").alias("id"), F.col("m.h").alias("h")).collect()),
        key=lambda x: x[0])                                # at most ``buckets`` rows
    if not heads:
        return rows.select("doc", "text", F.lit("").alias("next"), F.lit(0).alias("bucket"),
                           F.lit(0).alias("pos"))
    guests = [(d, h, heads[i - 1][0]) for i, (_, d, h) in enumerate(heads)]
    host = F.broadcast(docs.sparkSession.createDataFrame(guests, f"gdoc {kind.simpleString()}, gh long, host int"))
    guest = (rows.join(host, rows["doc"].eqNullSafe(F.col("gdoc")) & (rows["h"] == F.col("gh")))
             .dropDuplicates(["gdoc", "gh"])
             .select("doc", "text", "h", F.col("host").alias("bucket"), F.lit(1).alias("guest")))
    own = rows.select("doc", "text", "h", "bucket", F.lit(0).alias("guest"))
    by = Window.partitionBy("bucket").orderBy("guest", F.col("doc").asc_nulls_first(), "h")
    return (own.union(guest)
            .withColumn("next", F.lead("text").over(by))
            .withColumn("pos", F.row_number().over(by))
            .where("guest = 0").select("doc", "text", "next", "bucket", "pos"))


def _peel(cells: DataFrame, table: int) -> DataFrame:
    """Take out what single-digest cells of one table show; their digests are counted."""
    single = (F.abs("n") == 1) & (F.col("chk") == _check(F.col("key"))) & (F.col("tab") == table)
    entry = lambda tab, n, key, chk, found: F.struct(
        F.lit(tab).alias("tab") if isinstance(tab, int) else tab.alias("tab"),
        (_cell(F.col("key"), tab, F.col("cells")) if isinstance(tab, int) else F.col("cell")).alias("cell"),
        n.alias("n"), key.alias("key"), chk.alias("chk"), found.alias("found"))
    zero = F.lit(0).cast("long")
    out = [entry(t, -F.col("n"), F.col("key"), F.col("chk"), zero) for t in range(3) if t != table]
    done = F.struct(F.lit(-1).alias("tab"), F.lit(-1).cast("long").alias("cell"), zero.alias("n"),
                    zero.alias("key"), zero.alias("chk"), F.lit(1).cast("long").alias("found"))
    same = F.array(entry(F.col("tab"), F.col("n"), F.col("key"), F.col("chk"), F.col("found")))
    moved = cells.select("rid", "pair", "cells", F.explode(
        F.when(single, F.array(*out, done)).otherwise(same)).alias("e")).select(
        "rid", "pair", "cells", "e.*")
    return _sum(moved)


def _sum(cells: DataFrame) -> DataFrame:
    return (cells.groupBy("rid", "pair", "cells", "tab", "cell")
            .agg(F.sum("n").alias("n"), F.bit_xor("key").alias("key"),
                 F.bit_xor("chk").alias("chk"), F.sum("found").alias("found"))
            .where("n != 0 or key != 0 or found != 0"))


def _cells(units: DataFrame, rounds: int) -> DataFrame:
    """Peeled pairs: rid, pair, found (digests recovered), whole (nothing is left)."""
    spread = units.select("rid", "pair", "cells", "n", F.explode("keys").alias("key"))
    entry = [F.struct(F.lit(t).alias("tab"), _cell(F.col("key"), t, F.col("cells")).alias("cell"))
             for t in range(3)]
    cells = spread.select("rid", "pair", "cells", "n", "key", _check(F.col("key")).alias("chk"),
                          F.lit(0).cast("long").alias("found"),
                          F.explode(F.array(*entry)).alias("e"))
    cells = _sum(cells.select("rid", "pair", "cells", "e.tab", "e.cell", "n", "key", "chk", "found"))
    for r in range(rounds):
        cells = _peel(cells, r % 3)
    return cells.groupBy("rid", "pair").agg(
        F.sum("found").alias("found"), (F.max("tab") < 0).alias("whole"))


def _size(n: Column) -> Column:
    """The power of two at or above n."""
    return F.pow(F.lit(2.0), F.ceil(F.log2(F.greatest(n, F.lit(1)).cast("double")))).cast("long")


def fingerprint_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                          rounds: int = ROUNDS) -> DataFrame:
    """Per document row: doc, n_chars, edited_sha256, fingerprint, edited_fingerprint (digest
    of the sketch's cells), near_edited, near_next (likeness by recovered digests) and the
    number of digests recovered from either difference."""
    spark = docs.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = with_next(docs, doc_id, text, tasks * BUCKETS_PER_TASK)
    quarter = F.floor(F.char_length("text") / 4).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), F.char_length("text") - quarter),
                      F.substring(F.col("next"), F.lit(1), quarter))
    scale, pair = scale_of(F.char_length("text")), scale_of(F.greatest(F.char_length("text"), F.char_length("next")))
    base = materialise(
        ordered.withColumns({"edited": edited, "scale": scale, "pair": pair}).select(
            ((F.col("bucket").cast("long") * (1 << 40)) + F.col("pos")).alias("rid"), "doc",
            F.char_length("text").cast("long").alias("n_chars"),
            F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
            paragraphs(F.col("text"), F.col("scale")).alias("own"),
            paragraphs(F.col("edited"), F.col("scale")).alias("edit"),
            # the longer of the two may ask for a coarser scale
            F.when(F.col("pair") != F.col("scale"), paragraphs(F.col("text"), F.col("pair"))).alias("beside"),
            paragraphs(F.col("next"), F.col("pair")).alias("next")), "iblt-paragraphs")
    beside = F.coalesce("beside", "own")
    keys = base.select("rid", "own", "edit", beside.alias("beside"), "next").repartition("rid")

    # sketches of the single texts, folded to a digest of their cells
    one = keys.select("rid", F.explode(F.array(
        F.struct(F.lit("own").alias("pair"), F.col("own").alias("keys")),
        F.struct(F.lit("edit").alias("pair"), F.col("edit").alias("keys")))).alias("s")).select(
        "rid", "s.pair", "s.keys", _size(F.size("s.keys")).alias("cells"))
    spread = one.select("rid", "pair", "cells", F.explode("keys").alias("key"))
    entry = [F.struct(F.lit(t).alias("tab"), _cell(F.col("key"), t, F.col("cells")).alias("cell"))
             for t in range(3)]
    sketch = (spread.select("rid", "pair", "cells", "key", F.explode(F.array(*entry)).alias("e"))
              .groupBy("rid", "pair", "cells", "e.tab", "e.cell")
              .agg(F.count("*").alias("n"), F.bit_xor("key").alias("key"),
                   F.bit_xor(_check(F.col("key"))).alias("chk")))
    half = lambda salt: F.bit_xor(F.xxhash64("cells", "cell", "n", "key", "chk", F.lit(salt)))
    digests = sketch.groupBy("rid", "pair").agg(
        F.concat(F.lpad(F.hex(half(1)), 16, "0"), F.lpad(F.hex(half(2)), 16, "0")).alias("d"))
    prints = digests.groupBy("rid").agg(
        F.max(F.when(F.col("pair") == "own", F.lower("d"))).alias("fingerprint"),
        F.max(F.when(F.col("pair") == "edit", F.lower("d"))).alias("edited_fingerprint"))

    # differences: own minus edited, own minus next
    todo, peeled, grow = keys, None, 1
    while True:
        sides = [F.struct(F.lit(pair).alias("pair"), F.lit(sign).cast("long").alias("n"),
                          F.col(side).alias("keys"),
                          (_size(F.greatest(F.size(mine), F.size(pair))) * grow).alias("cells"))
                 for pair, mine in (("edit", "own"), ("next", "beside")) for side, sign in ((mine, 1), (pair, -1))]
        units = todo.select("rid", *([] if grow == 1 else ["open"]), F.explode(F.array(*sides)).alias("s"))
        if grow > 1:
            units = units.where(F.array_contains("open", F.col("s.pair")))
        got = materialise(_cells(units.select("rid", "s.*"), rounds), "iblt-peeled")
        peeled = got.where("whole") if peeled is None else peeled.union(got.where("whole"))
        failed = got.where(~F.col("whole")).groupBy("rid").agg(F.collect_set("pair").alias("open"))
        if failed.isEmpty():
            break
        grow *= GROW
        todo = keys.join(failed, "rid")

    found = peeled.groupBy("rid").agg(
        F.max(F.when(F.col("pair") == "edit", F.col("found"))).alias("found_edited"),
        F.max(F.when(F.col("pair") == "next", F.col("found"))).alias("found_next"))

    def likeness(mine: Column, side: str, differ: str) -> Column:
        total = (F.size(mine) + F.size(side) + F.coalesce(differ, F.lit(0).cast("long"))) / 2.0
        return F.when(total > 0, 1.0 - F.coalesce(differ, F.lit(0).cast("long")) / total).otherwise(1.0)

    blank = F.lit("0" * 32)
    return (base.join(prints, "rid", "left").join(found, "rid", "left").select(
        "doc", "n_chars", "edited_sha256", F.coalesce("fingerprint", blank).alias("fingerprint"),
        F.coalesce("edited_fingerprint", blank).alias("edited_fingerprint"),
        likeness(F.col("own"), "edit", "found_edited").alias("near_edited"),
        likeness(beside, "next", "found_next").alias("near_next"),
        F.coalesce("found_edited", F.lit(0).cast("long")).alias("found_edited"),
        F.coalesce("found_next", F.lit(0).cast("long")).alias("found_next")))
