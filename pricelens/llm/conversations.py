"""Repair of conversation structure by a bidirectional Dijkstra search of the edit lattice.

A conversation's rows, by turn, shall become a sequence of role initials ``(s?(ua)+)?``. A
node of the lattice is (rows consumed, state of that pattern); edges are the edits Keep,
Rerole, Delete and Insert with their costs. One heap searches from the first node, one
backwards from the accepting ones. When both tops together exceed the least total found, all
crossings of that total have been met, and the least concatenation of the letters before and
behind a crossing is the audit. (Letters of one node and cost are never a proper prefix of
one another: each row has one letter, and an insertion costs. So the least concatenation
consists of least parts.)

Conversations of up to ``LONG`` rows are repaired while sorted rows stream through a task.
Longer ones are cut into pieces of ``PIECE`` rows, wherever Spark's range partitions hold
them: each piece is searched between every two states, and the few costs and letters per
piece are joined in order; such conversations share no task until their letters are known.
Their repaired text is hashed while it streams by, so a task holds one row and the audit.

Faults, the first that applies to a row: blank (no character but ``[\\x20\\x09-\\x0D]``),
duplicate (role and text stand in an earlier row of the conversation), truncated (the last
such character is not one of ``.!?``).

Defined cases: null roles and texts are one space; a null conversation id is a conversation;
null turns come first; rows of one turn are ordered by role, then text; roles are known by
their first character only, so that ``User`` is another role than ``user``; extra columns
are ignored; an empty table gives no rows."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from heapq import heappop, heappush
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .util import join_rows, materialise

LONG = 2048
PIECE = 512
DELETE, INSERT, REROLE, CUT_SHORT = 2, 5, 1, 5
SPACES = " \t\n\x0b\x0c\r"

# states of (s?(ua)+)?: nothing yet, after s, after u, after a
NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
ACCEPT = (0, 3)
LEGAL = {"su", "ua", "au"}
# a row's symbol: its initial (x: none of s, u, a), upper case if truncated; B blank, D duplicate


def _row_edges(symbol: str) -> list[tuple[int, int, int, str]]:
    """(state before, state after, cost, letter) of the edits of a row."""
    edges = [(q, q, DELETE, "D") for q in range(4)]
    if symbol not in "BD":
        more = CUT_SHORT * symbol.isupper()
        for (q, role), p in NEXT.items():
            if symbol.lower() == role:
                edges.append((q, p, more, "K"))
            elif role != "s":
                edges.append((q, p, REROLE + more, "R"))
    return edges


_BY_ROW = {s: _row_edges(s) for s in "suaxSUAXBD"}
_FORWARD = {s: [[e for e in edges if e[0] == q] for q in range(4)] for s, edges in _BY_ROW.items()}
_BACKWARD = {s: [[e for e in edges if e[1] == p] for p in range(4)] for s, edges in _BY_ROW.items()}
_INSERT_FROM = [[p for (q, r), p in NEXT.items() if q == at and r != "s"] for at in range(4)]
_INSERT_TO = [[q for (q, r), p in NEXT.items() if p == at and r != "s"] for at in range(4)]


@lru_cache(maxsize=4096)
def cheapest(symbols: str, start: int = 0, goals: tuple[int, ...] = ACCEPT) -> tuple[int, str] | None:
    """Least cost and, of the edits of that cost, least letters that lead from ``start`` to
    one of ``goals`` over all rows; None where no edits do."""
    n = len(symbols)
    done: tuple[dict, dict] = {}, {}  # node -> (cost, letters), forward and reverse
    heaps: tuple[list, list] = [(0, 0, "", start)], [(0, -n, "", p) for p in goals]
    heaps[1].sort()
    best: tuple[float, str] = (float("inf"), "")

    def top(side: int) -> float:
        while heaps[side] and (abs(heaps[side][0][1]), heaps[side][0][3]) in done[side]:
            heappop(heaps[side])
        return heaps[side][0][0] if heaps[side] else float("inf")

    while True:
        tops = top(0), top(1)
        if sum(tops) > best[0] or max(tops) == best[0] == float("inf"):
            # one side has met all it can reach: nothing joins it any more
            return best if best[0] < float("inf") else None
        side = 0 if tops[0] <= tops[1] else 1
        # equal costs by rows consumed: a Keep that costs nothing leads to a later row, so all
        # letters of a node are in the heap before its least ones are taken
        cost, at, letters, q = heappop(heaps[side])
        at = abs(at)
        done[side][at, q] = (cost, letters)
        if side == 0:
            near = [(at, p, INSERT, "I") for p in _INSERT_FROM[q]]
            near += [(at + 1, p, w, c) for _, p, w, c in _FORWARD[symbols[at]][q]] if at < n else []
            if at == n and q in goals:
                best = min(best, (cost, letters))
        else:
            near = [(at, p, INSERT, "I") for p in _INSERT_TO[q]]
            near += [(at - 1, p, w, c) for p, _, w, c in _BACKWARD[symbols[at - 1]][q]] if at else []
            if at == 0 and q == start:
                best = min(best, (cost, letters))
        for i, p, w, c in near:
            path = letters + c if side == 0 else c + letters
            met = done[1 - side].get((i, p))
            if met:
                best = min(best, (cost + w + met[0], path + met[1] if side == 0 else met[1] + path))
            if (i, p) not in done[side]:
                heappush(heaps[side], (cost + w, i if side == 0 else -i, path, p))


def edited(audit: str, rows: Iterable[tuple[str, str]]) -> Iterator[tuple[str, str, str]]:
    """(edit, role, text) of every edit in order; only Delete's rows are not in the result."""
    rows = iter(rows)
    kept = sum(c != "D" for c in audit)
    place = -(kept % 2)  # an odd number begins with the row of s
    for c in audit:
        role, text = ("", "") if c == "I" else next(rows)
        if c in "IR":
            role = "assistant" if place % 2 else "user"
        yield c, role, text
        place += c != "D"


def _digest(edits: Iterable[tuple[str, str, str]]) -> str:
    out, first = hashlib.sha256(), True
    for c, role, text in edits:
        if c != "D":
            out.update(("" if first else "\n").encode() + f"{role}:{text}".encode())
            first = False
    return out.hexdigest()


def symbol_of(role: str, text: str, seen: set) -> str:
    """The row's symbol; ``seen`` holds the rows before it and gets this one."""
    known, end = (role, text) in seen, text.rstrip(SPACES)
    seen.add((role, text))
    if not end:
        return "B"
    if known:
        return "D"
    first = role[:1] if role[:1] in ("s", "u", "a") else "x"
    return first if end[-1] in ".!?" else first.upper()


def _initials(roles: Iterable[str]) -> str:
    return "".join(r[:1] if r[:1] in ("s", "u", "a") else "x" for r in roles)


def _illegal(initials: str) -> int:
    return sum(initials[i:i + 2] not in LEGAL for i in range(len(initials) - 1))


def _faults(symbols: str) -> tuple[int, int, int]:
    return symbols.count("B"), symbols.count("D"), sum(symbols.count(c) for c in "SUAX")


def _missing_turns(turns: list[int | None]) -> int:
    turns = {t for t in turns if t is not None}
    return min(max(turns) - min(turns) + 1 - len(turns), (1 << 63) - 1) if turns else 0


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Rows one by one; the first column marks the conversation and may be null."""
    for b in batches:
        yield from zip(*[c.to_pylist() for c in b.columns])


_COUNTS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _in_batches(records: Iterable[tuple], names: list[str], types: list[pa.DataType], rows: int = 4096):
    held: list[tuple] = []

    def batch():
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names)

    size = 0
    for r in records:
        held.append(r)
        size += sum(len(x) for x in r if isinstance(x, str))
        if len(held) == rows or size > 1 << 24:
            yield batch()
            held, size = [], 0
    if held:
        yield batch()


def _rows(df: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    known = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    return df.select(F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"),
                     known(role).alias("role"), known(text).alias("text"))


def _by_conversation(df: DataFrame, *more: str) -> DataFrame:
    return df.repartition("conv").sortWithinPartitions(
        "conv", *more, F.col("turn").asc_nulls_first(), "role", "text")


def _repair_short(rows: DataFrame, arrow_id: pa.DataType, id_type: str) -> DataFrame:
    names = ["conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "digest"]
    types = [arrow_id, *[pa.int64()] * 6, pa.string(), pa.string()]

    def task(batches):
        def each():
            for conv, group in groupby(_streamed(batches), key=lambda r: r[0]):
                turns, roles, texts = zip(*[r[1:] for r in group])
                seen: set = set()
                symbols = "".join(symbol_of(r, t, seen) for r, t in zip(roles, texts))
                cost, audit = cheapest(symbols)
                yield (conv, _missing_turns(turns), *_faults(symbols), _illegal(_initials(roles)), cost, audit,
                       _digest(edited(audit, zip(roles, texts))))
        yield from _in_batches(each(), names, types)

    return _by_conversation(rows).mapInArrow(task, f"conv {id_type}, {_COUNTS}, digest string")


def _with_audits(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """Every conversation's audit, then its rows in order."""
    return _by_conversation(
        audits.select("conv", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"),
                      F.lit("").alias("role"), F.lit("").alias("text"), "audit")
        .unionByName(rows.select("conv", F.lit(1).alias("kind"), "turn", "role", "text",
                                 F.lit(None).cast("string").alias("audit"))), "kind")


def _edits(batches) -> Iterator[tuple]:
    """(conversation, its edits) of the rows of ``_with_audits``; the edits must be used up
    before the next conversation."""
    for conv, group in groupby(_streamed(batches), key=lambda r: r[0]):
        audit = next(group)[5]
        yield conv, edited(audit, ((r[3], r[4]) for r in group))


def _digests(rows: DataFrame, audits: DataFrame, arrow_id: pa.DataType, id_type: str) -> DataFrame:
    def task(batches):
        yield from _in_batches(((conv, _digest(edits)) for conv, edits in _edits(batches)),
                               ["conv", "digest"], [arrow_id, pa.string()])
    return _with_audits(rows, audits).mapInArrow(task, f"conv {id_type}, digest string")


def _symbol(first: Column) -> Column:
    """``symbol_of`` as a column; ``first``: the row is the first of its role and text."""
    end = F.rtrim(F.col("text"), F.lit(SPACES))
    initial = F.col("initial")
    return (F.when(end == "", "B").when(~first, "D")
            .when(F.substring(end, -1, 1).isin(".", "!", "?"), initial).otherwise(F.upper(initial)))


def _repair_long(rows: DataFrame, arrow_id: pa.DataType, id_type: str, piece: int) -> DataFrame:
    """The columns of ``_repair_short`` for conversations of any length."""
    initial = F.substring("role", 1, 1)
    # a written total order: ids grow along it, and pieces are runs of ids within a partition
    placed = materialise(
        rows.withColumn("initial", F.when(initial.isin("s", "u", "a"), initial).otherwise("x"))
        .withColumn("same", F.sha2(F.concat_ws(":", F.char_length("role"), "role", "text").cast("binary"), 256))
        .repartitionByRange("conv", F.col("turn").asc_nulls_first(), "role", "text")
        .sortWithinPartitions("conv", F.col("turn").asc_nulls_first(), "role", "text")
        .withColumn("at", F.monotonically_increasing_id()), "conversations-placed")
    firsts = placed.groupBy("conv", "same").agg(F.min("at").alias("at")).select("at", F.lit(True).alias("first"))
    marked = (placed.join(firsts, "at", "left")
              .withColumn("symbol", _symbol(F.coalesce("first", F.lit(False)))))
    row = F.sort_array(F.collect_list(F.struct("at", "symbol", "initial")))  # at most ``piece`` rows
    pieces = (marked.groupBy("conv", F.expr(f"at div {piece}").alias("piece")).agg(row.alias("r"))
              .select("conv", "piece", F.array_join("r.symbol", "").alias("symbols"),
                      F.array_join("r.initial", "").alias("initials")))

    def between(batches):
        def each():
            for conv, at, symbols, initials in _streamed(batches):
                ways = [cheapest(symbols, q, (p,)) for q in range(4) for p in range(4)]
                yield (conv, at, initials, *_faults(symbols), [w and w[0] for w in ways], [w and w[1] for w in ways])
        yield from _in_batches(each(), names, types, 256)

    names = ["conv", "piece", "initials", "blank", "duplicate", "truncated", "costs", "letters"]
    types = [arrow_id, pa.int64(), pa.string(), *[pa.int64()] * 3, pa.list_(pa.int64()), pa.list_(pa.string())]
    searched = pieces.mapInArrow(between, f"conv {id_type}, piece long, initials string, blank long, "
                                          "duplicate long, truncated long, costs array<long>, letters array<string>")

    def joined(batches):
        def each():
            for conv, group in groupby(_streamed(batches), key=lambda r: r[0]):
                ways, last, counts, illegal = {0: (0, "")}, "", [0, 0, 0], 0
                for _, _, initials, blank, duplicate, truncated, costs, letters in group:
                    illegal += _illegal(last + initials)
                    last = initials[-1]
                    counts = [a + b for a, b in zip(counts, (blank, duplicate, truncated))]
                    ways = {p: min(found) for p in range(4) if (found := [
                        (c + costs[4 * q + p], a + letters[4 * q + p])
                        for q, (c, a) in ways.items() if costs[4 * q + p] is not None])}
                cost, audit = min(ways[p] for p in ACCEPT if p in ways)
                yield (conv, *counts, illegal, cost, audit)
        yield from _in_batches(each(), out, kinds, 16)

    out = ["conv", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
    kinds = [arrow_id, *[pa.int64()] * 5, pa.string()]
    audits = materialise(
        searched.repartition("conv").sortWithinPartitions("conv", "piece")
        .mapInArrow(joined, f"conv {id_type}, blank long, duplicate long, truncated long, illegal long, "
                            "cost long, audit string"), "conversations-audits")
    gaps = rows.groupBy("conv").agg(F.coalesce(
        F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).alias("gaps"))
    found = join_rows(join_rows(audits, gaps, ["conv"]), _digests(rows, audits, arrow_id, id_type), ["conv"])
    return found.select("conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "digest")


def repair(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
           text: str = "text", long: int = LONG, piece: int = PIECE) -> DataFrame:
    """(conv, gaps, blank, duplicate, truncated, illegal, cost, audit, digest) of every
    conversation: turns missing between its first and last, rows by fault, neighbouring roles
    that may not follow one another, cost and letters of the cheapest edits, and the SHA-256 of
    the repaired ``role:text`` lines. ``repaired_turns`` gives the lines themselves."""
    from pyspark.sql.pandas.types import to_arrow_type
    rows = _rows(df, conv, turn, role, text)
    arrow_id, id_type = to_arrow_type(rows.schema["conv"].dataType), rows.schema["conv"].dataType.simpleString()
    lengths = rows.groupBy("conv").agg(F.count("*").alias("n")).where(F.col("n") > long).select("conv")
    if lengths.isEmpty():
        return _repair_short(rows, arrow_id, id_type)
    lengths = materialise(lengths, "conversations-long")
    return _repair_short(join_rows(rows, lengths, ["conv"], "left_anti"), arrow_id, id_type).unionByName(
        _repair_long(join_rows(rows, lengths, ["conv"], "left_semi"), arrow_id, id_type, piece))


def repaired_turns(df: DataFrame, repairs: DataFrame, conv: str = "conv_id", turn: str = "turn",
                   role: str = "role", text: str = "text") -> DataFrame:
    """(conv, at, edit, role, text): the edits of ``repair`` applied, one row each in the order
    of ``at``; rows of edit D are those that the repaired conversation lacks."""
    from pyspark.sql.pandas.types import to_arrow_type
    rows = _rows(df, conv, turn, role, text)
    id_type = rows.schema["conv"].dataType
    types = [to_arrow_type(id_type), pa.int64(), pa.string(), pa.string(), pa.string()]

    def task(batches):
        yield from _in_batches(((conv, i, *e) for conv, edits in _edits(batches) for i, e in enumerate(edits)),
                               ["conv", "at", "edit", "role", "text"], types)

    return _with_audits(rows, repairs.select("conv", "audit")).mapInArrow(
        task, f"conv {id_type.simpleString()}, at long, edit string, role string, text string")
