"""Exact quantiles by selection: sketch bounds, count below, sort only the bracket
(A5, A7, A8, A11, A22, A27, D5, D6, W3).

The first pass takes a mergeable sketch per group; two of its values enclose each wanted
rank. The second counts the rows below that bracket and the values inside it, grouped by
value before the shuffle, so a value that a third of all rows hold is one row. A bracket
holds about 4 / ``ACCURACY`` of a group (a group of fewer rows than ``ACCURACY`` is its own
bracket); one that still holds more than ``SORTED`` values is narrowed by a sketch of its
own, so what is sorted per group is bounded whatever the group holds. The data are read two
times (more only for narrowed brackets), never sorted, and written nowhere; what is written
is the table of the brackets' values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import nan_to_null
from ..session import checkpointed

ACCURACY = 2_000
SORTED = 1 << 20
GRID = 256
MAX_BROADCAST_GROUPS = 50_000


def null_safe_on(left: DataFrame, right: DataFrame, cols: Sequence[str], prefix: str = "_k_"):
    """Equality of ``cols`` with the right side's ``prefix``-named ones, null equal to null."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & left[c].eqNullSafe(right[prefix + c])
    return cond


class Selection:
    """Quantiles (and, from the first pass, ordinary aggregates of ``_v``) per group."""

    def __init__(self, df: DataFrame, value: str | Column, by: Sequence[str] = (),
                 probs: Sequence[float] = (0.5,), aggs: Sequence[Column] = (),
                 accuracy: int = ACCURACY, sorted_rows: int = SORTED):
        self.by, self.probs = list(by), list(dict.fromkeys(float(p) for p in probs))
        self.gcols, self.accuracy, self.sorted_rows = self.by or ["_g"], accuracy, sorted_rows
        v = F.col(value) if isinstance(value, str) else value
        if df.select(v.alias("_t")).schema["_t"].dataType.simpleString() in ("double", "float"):
            v = nan_to_null(v)
        rows = df.select(*self.by, v.alias("_v")).where(F.col("_v").isNotNull())
        self.rows = rows if self.by else rows.withColumn("_g", F.lit(0))
        slack = 2.0 / accuracy  # the sketch's ranks are off by 1 / accuracy at most
        bounds = [x for p in self.probs for x in (max(p - slack, 0.0), min(p + slack, 1.0))]
        self.groups = checkpointed(self.rows.groupBy(*self.gcols).agg(  # one row per group
            F.count("_v").alias("_n"), F.min("_v").alias("_min"), F.max("_v").alias("_max"),
            F.percentile_approx("_v", bounds, accuracy).alias("_b"), *aggs))
        self._small = self.groups.count() <= MAX_BROADCAST_GROUPS

    def aggregate(self) -> DataFrame:
        out = self.groups.drop("_n", "_min", "_max", "_b")
        return out if self.by else out.drop("_g")

    def _first_brackets(self) -> DataFrame:
        whole = F.col("_n") < self.accuracy
        h = [(F.col("_n") - 1).cast("double") * p for p in self.probs]
        each = F.array(*[F.struct(
            F.lit(i).alias("i"), F.lit(p).alias("prob"),
            F.floor(h[i]).cast("long").alias("r1"), F.ceil(h[i]).cast("long").alias("r2"),
            (h[i] - F.floor(h[i])).alias("frac"),
            F.when(whole, F.col("_min")).otherwise(F.col("_b")[2 * i]).alias("lo"),
            F.when(whole, F.col("_max")).otherwise(F.col("_b")[2 * i + 1]).alias("hi"))
            for i, p in enumerate(self.probs)])
        return self.groups.select(*self.gcols, F.explode(each).alias("k")).select(*self.gcols, "k.*")

    def _marked(self, brackets: DataFrame) -> DataFrame:
        """(group, i, v) of the rows up to a bracket's end; v is null below the bracket."""
        per_group = brackets.groupBy(*self.gcols).agg(
            F.collect_list(F.struct("i", "lo", "hi")).alias("_k")).select(  # one entry per quantile
            *[F.col(c).alias("_k_" + c) for c in self.gcols], "_k")
        if self._small:
            per_group = F.broadcast(per_group)
        hit = F.explode(F.filter("_k", lambda k: F.col("_v") <= k["hi"])).alias("k")
        return (self.rows.join(per_group, null_safe_on(self.rows, per_group, self.gcols))
                .select(*self.gcols, "_v", hit)
                .select(*self.gcols, "k.i", F.when(F.col("_v") >= F.col("k.lo"), F.col("_v")).alias("v")))

    def _narrowed(self, state: DataFrame) -> DataFrame:
        """Brackets that hold too much, cut down to a few steps of a grid of their own."""
        grid = self._marked(state).where(F.col("v").isNotNull()).groupBy(*self.gcols, "i").agg(
            F.percentile_approx("v", [g / GRID for g in range(GRID + 1)], 16 * GRID).alias("grid"))
        right = grid.select(*[F.col(c).alias("_k_" + c) for c in self.gcols], F.col("i").alias("_k_i"), "grid")
        at = lambda r: F.floor((F.col(r) - F.col("below")) / F.col("inside") * GRID).cast("int")
        return state.join(right, null_safe_on(state, right, [*self.gcols, "i"])).select(
            *self.gcols, "i", "prob", "r1", "r2", "frac",
            F.col("grid")[F.greatest(at("r1") - 1, F.lit(0))].alias("lo"),
            F.col("grid")[F.least(at("r2") + 2, F.lit(GRID))].alias("hi"))

    def quantiles(self) -> DataFrame:
        """Long form ``by..., prob, quantile`` (linear interpolation)."""
        todo, done = checkpointed(self._first_brackets()), []
        keys = [*self.gcols, "i"]
        while True:
            values = checkpointed(self._marked(todo).groupBy(*keys, "v").agg(F.count("*").alias("c")))
            sums = values.groupBy(*keys).agg(
                F.coalesce(F.sum(F.when(F.col("v").isNull(), F.col("c"))), F.lit(0)).alias("below"),
                F.sum(F.when(F.col("v").isNotNull(), F.col("c"))).alias("inside"),
                F.count("v").alias("distinct"))
            right = sums.select(*[F.col(c).alias("_k_" + c) for c in keys], "below", "inside", "distinct")
            state = checkpointed(todo.join(right, null_safe_on(todo, right, keys), "left").drop(
                *["_k_" + c for c in keys]))
            missed = (F.col("inside").isNull() | (F.col("r1") < F.col("below"))
                      | (F.col("r2") >= F.col("below") + F.col("inside")))
            large = F.col("distinct") > self.sorted_rows
            done.append(self._picked(values, state.where(~missed & ~large)))
            flags = state.agg(F.bool_or(missed).alias("missed"), F.bool_or(large & ~missed).alias("large")).first()
            if not flags["missed"] and not flags["large"]:
                break
            again = []
            if flags["large"]:
                again.append(self._narrowed(state.where(large & ~missed)))
            if flags["missed"]:  # values that the sketch, in doubles, cannot tell apart
                g = self.groups.select(*[F.col(c).alias("_k_" + c) for c in self.gcols], "_min", "_max")
                lost = state.where(missed)
                again.append(lost.join(g, null_safe_on(lost, g, self.gcols)).select(
                    *self.gcols, "i", "prob", "r1", "r2", "frac", F.col("_min").alias("lo"), F.col("_max").alias("hi")))
            todo = checkpointed(again[0] if len(again) == 1 else again[0].unionByName(again[1]))
        out = done[0]
        for d in done[1:]:
            out = out.unionByName(d)
        return out if self.by else out.drop("_g")

    def _picked(self, values: DataFrame, state: DataFrame) -> DataFrame:
        keys = [*self.gcols, "i"]
        upto = F.sum("c").over(Window.partitionBy(*keys).orderBy(F.col("v").asc_nulls_first())
                               .rowsBetween(Window.unboundedPreceding, 0))
        right = state.select(*[F.col(c).alias("_k_" + c) for c in keys], "prob", "r1", "r2", "frac")
        at = values.join(F.broadcast(right) if self._small else right, null_safe_on(values, right, keys)) \
            .withColumn("upto", upto)
        holds = lambda r: (F.col(r) >= F.col("upto") - F.col("c")) & (F.col(r) < F.col("upto"))
        ends = at.where(holds("r1") | holds("r2")).groupBy(*self.gcols, "prob").agg(
            F.max(F.when(holds("r1"), F.col("v"))).alias("a"), F.max(F.when(holds("r2"), F.col("v"))).alias("b"),
            F.max("frac").alias("frac"))
        return ends.select(*self.gcols, "prob",
                           (F.col("a") + (F.col("b") - F.col("a")) * F.col("frac")).alias("quantile"))

    def quantiles_wide(self, named: Mapping[str, float]) -> DataFrame:
        aggs = [F.max(F.when(F.col("prob") == F.lit(float(p)), F.col("quantile"))).alias(name)
                for name, p in named.items()]
        q = self.quantiles()
        return q.groupBy(*self.by).agg(*aggs) if self.by else q.agg(*aggs)
