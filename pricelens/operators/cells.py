"""Cells of an experiment and the preparation that each of them fits on its own rows
(M13, P14, T6, T7, W2, J8).

A cell is a slice of one table keyed by ``cell``. All cells are drawn in one pass, and the
preparation of all cells is one table with a row per cell: medians, means and deviations of
the numeric columns and the index of the categories."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import hash_order_key, nan_to_null
from ..session import checkpointed
from .sampling import choose_blocks, group_blocks

_HASH_SPACE = 1 << 32


@dataclass(frozen=True)
class Cell:
    cell: int
    method: str            # "random" or "spatial"
    iteration: int
    n: int                 # rows asked for
    seed: int
    groups: tuple = ()     # of a spatial cell
    rows: int = 0          # rows drawn: n, or all that there are
    whole: bool = False    # all rows of its groups (of the table) are drawn, whatever the seed
    test_rows: int = 0

    @property
    def draw(self) -> tuple:
        """Cells of one draw hold the same rows and are tested on the same rows."""
        return (self.groups, None if self.whole else (self.n, self.seed))


def plan_cells(train: DataFrame, group: str, sizes: Sequence[int], block_sizes: Sequence[int],
               repetitions: int, seed: int) -> list[Cell]:
    """The grid: per size ``repetitions`` random cells, and as many spatial ones, each of a
    block of ``block_size`` groups. Only the groups of chosen blocks reach the driver (block
    sizes x repetitions, whatever the data hold)."""
    place = checkpointed(group_blocks(train, group, 1, seed).select(group, "position"))
    cells: list[Cell] = []
    for it, (n, size) in enumerate(zip(sizes, block_sizes), start=1):
        blocks = place.withColumn("block", F.floor(F.col("position") / size).cast("int"))
        chosen = choose_blocks(blocks, repetitions, seed)
        members: dict[int, list] = {}
        for r in blocks.join(F.broadcast(chosen), "block", "left_semi").collect():
            members.setdefault(r["block"], []).append(r[group])
        for i in range(repetitions):
            own = seed * 1000 + it * 10 + i
            cells.append(Cell(len(cells), "random", it, n, own))
            if i < len(members):
                block = sorted(members)[i]
                cells.append(Cell(len(cells), "spatial", it, n, own, tuple(sorted(members[block]))))
    return cells


def _of_group(cells: Sequence[Cell], group: str, value) -> Column | None:
    """Array of (cell, value(cell)) of the cells that a row's group belongs to."""
    def entry(c: Cell) -> Column:
        return F.struct(F.lit(c.cell).alias("cell"), *[F.lit(v).alias(k) for k, v in value(c).items()])
    everywhere = [entry(c) for c in cells if not c.groups]
    by_group: dict = {}
    for c in cells:
        for g in c.groups:
            by_group.setdefault(g, []).append(entry(c))
    parts = [F.array(*everywhere)] if everywhere else []
    if by_group:
        pairs = [x for g, entries in by_group.items() for x in (F.lit(g), F.array(*entries))]
        found = F.when(F.col(group).isNotNull(), F.try_element_at(F.create_map(*pairs), F.col(group)))
        parts.append(F.coalesce(found, F.filter(F.array(entry(cells[0])), lambda _: F.lit(False))))
    return F.concat(*parts) if len(parts) > 1 else parts[0]


def rows_per_cell(df: DataFrame, cells: Sequence[Cell], group: str) -> dict[int, int]:
    """How many rows of ``df`` each cell may draw from (or is tested on)."""
    seen = df.groupBy(group).agg(F.count("*").alias("n"))  # groups, not rows
    total = seen.agg(F.sum("n")).first()[0] or 0
    named = {r[group]: r["n"] for r in seen.where(
        F.col(group).isin(sorted({g for c in cells for g in c.groups}))).collect()}
    return {c.cell: sum(named.get(g, 0) for g in c.groups) if c.groups else total for c in cells}


def draw_cells(train: DataFrame, cells: Sequence[Cell], key: str, group: str,
               oversample: float = 1.1) -> tuple[DataFrame, list[Cell]]:
    """Rows of all cells, keyed by ``cell``: of a cell's rows those of the min(n, rows)
    smallest md5(key | seed), the sample of ``exact_sample``. One pass: a row joins the
    cells under whose threshold its hash falls, sized for ~1.1 n rows and widened for cells
    that come out short, so about as many rows are sorted as are drawn."""
    pool = rows_per_cell(train, cells, group)
    limit = {c.cell: min(_HASH_SPACE, int((c.n * oversample + 64) / max(pool[c.cell], 1) * _HASH_SPACE) + 1)
             for c in cells}
    want = {c.cell: min(c.n, pool[c.cell]) for c in cells}
    while True:
        entry = F.col("_c")
        mark = F.md5(F.concat(F.col(key).cast("string"), F.lit("|"), entry["seed"].cast("string")))
        first = Window.partitionBy("cell").orderBy("_md5", key)
        drawn = (train.withColumn("_c", F.explode(_of_group(
                    cells, group, lambda c: {"seed": c.seed, "limit": limit[c.cell], "n": want[c.cell]})))
                 .withColumn("_md5", mark)
                 .where(F.conv(F.substring("_md5", 1, 8), 16, 10).cast("long") < entry["limit"])
                 .withColumn("cell", entry["cell"]).withColumn("_n", entry["n"])
                 .withColumn("_at", F.row_number().over(first)).where(F.col("_at") <= F.col("_n"))
                 .drop("_c", "_md5", "_n", "_at"))
        drawn = checkpointed(drawn)
        got = {r["cell"]: r["n"] for r in drawn.groupBy("cell").agg(F.count("*").alias("n")).collect()}
        short = [c for c in want if got.get(c, 0) < want[c] and limit[c] < _HASH_SPACE]
        if not short:
            return drawn, [replace(c, rows=got.get(c.cell, 0), whole=c.n >= pool[c.cell]) for c in cells]
        limit |= {c: min(_HASH_SPACE, limit[c] * 2) for c in short}


def test_rows(test: DataFrame, cell: Cell, group: str) -> DataFrame:
    """A random cell is tested on all rows, a spatial one on those of its groups."""
    return test.where(F.col(group).isin(list(cell.groups))) if cell.groups else test


def tested_rows(test: DataFrame, cells: Sequence[Cell], group: str) -> DataFrame:
    """The test rows of all cells, keyed by ``cell``."""
    return test.withColumn("cell", F.explode(F.transform(_of_group(cells, group, lambda c: {}), lambda x: x["cell"])))


def category(c: str, fill: str = "other") -> Column:
    return F.lower(F.coalesce(F.col(c).cast("string"), F.lit(fill)))


def fit_preparation(rows: DataFrame, numeric: Sequence[str], categorical: Sequence[str],
                    by: str = "cell") -> DataFrame:
    """One row per cell: ``medians``, ``means`` and ``deviations`` (arrays in the order of
    ``numeric``) and ``categories`` (per categorical column a map from value to position, the
    most frequent first, ties by value).

    Missing values (null, NaN) take the median of the cell's known ones; mean and deviation
    (of the population) are those after that. A column without a known value has no median
    and stands as 0 everywhere. Two aggregations for the numbers and one for the categories;
    what meets per cell is bounded by the cell's size."""
    known = {c: nan_to_null(F.col(f"`{c}`").cast("double")) for c in numeric}
    medians = rows.groupBy(by).agg(F.array(*[F.median(known[c]) for c in numeric]).alias("medians"))
    filled = rows.join(F.broadcast(medians), by)
    full = [F.coalesce(known[c], F.col("medians")[i]) for i, c in enumerate(numeric)]
    moments = filled.groupBy(by).agg(F.array(*[F.avg(x) for x in full]).alias("means"),
                                     F.array(*[F.stddev_pop(x) for x in full]).alias("deviations"))
    at = Window.partitionBy(by, "j").orderBy(F.desc("n"), "value")
    values = (rows.select(by, F.posexplode(F.array(*[category(c) for c in categorical])).alias("j", "value"))
              .groupBy(by, "j", "value").agg(F.count("*").alias("n"))
              .withColumn("at", F.row_number().over(at) - 1)
              .groupBy(by, "j").agg(F.map_from_entries(F.collect_list(F.struct("value", "at"))).alias("index"))
              .groupBy(by).agg(F.sort_array(F.collect_list(F.struct("j", F.map_entries("index").alias("e")))).alias("c"))
              .select(by, F.transform("c", lambda x: F.map_from_entries(x["e"])).alias("categories")))
    return medians.join(moments, by).join(values, by)


def _one_hot(size: Column, at: Column) -> Column:
    return F.transform(F.sequence(F.lit(0), size - 1), lambda k: F.when(k == at, 1.0).otherwise(0.0))


def apply_preparation(rows: DataFrame, preparation: DataFrame, numeric: Sequence[str],
                      categorical: Sequence[str], by: str | None = "cell", out: str = "x") -> DataFrame:
    """``rows`` with ``out``: the scaled numbers, then one-hot categories (a value that the
    cell has not seen is all zeros). ``preparation`` has one short row per cell; without
    ``by``, every cell prepares all ``rows``."""
    joined = rows.join(F.broadcast(preparation), by) if by else rows.crossJoin(F.broadcast(preparation))
    numbers = []
    for i, c in enumerate(numeric):
        value = F.coalesce(nan_to_null(F.col(f"`{c}`").cast("double")), F.col("medians")[i])
        spread = F.col("deviations")[i]
        numbers.append(F.coalesce(F.when(spread > 0, (value - F.col("means")[i]) / spread), F.lit(0.0)))
    parts = [F.array(*numbers)]
    for j, c in enumerate(categorical):
        index = F.col("categories")[j]
        at = F.coalesce(F.try_element_at(index, category(c)), F.lit(-1))
        parts.append(_one_hot(F.size(index), at))
    return joined.withColumn(out, F.concat(*parts)).drop("medians", "means", "deviations", "categories")
