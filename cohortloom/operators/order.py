"""Exact order statistics of groups of any size, by selection in rounds.

Each round takes a sketch of the values that can still be the answer (bounded state, merged map-side) for borders that
cut them into cells of about equal size, counts the cells exactly, and goes on in the cell that holds the wanted rank.
Borders are values of the group and are counted as cells of their own, so ties end the search.  Cells of up to ``small``
values are finished by one ordered window.  No task ever holds the values of a large group.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.operators.common import join_stats
from cohortloom.session import cut_lineage

#: Values of a cell that one window may order.
SMALL = 10_000
#: Borders taken in a round.
BORDERS = 63


def at_ranks(df: DataFrame, keys: Sequence[str], value: str, ranks: Mapping[str, Column], small: int = SMALL) -> DataFrame:
    """One row per key group with the value at each of ``ranks`` (from 1, an expression of the group's count ``n``) and n.

    NULL and NaN values are not counted; a group of none has no row; NULL keys are a group; a rank outside 1..n gives NULL.
    Runs jobs while it is called: one, and one more for each round that a group larger than ``small`` needs.
    """
    if any(k in ("n", "x", *ranks) for k in keys):
        raise ValueError("keys may not be named like n, x or a result")
    if not keys:
        return at_ranks(df.withColumn("__all", F.lit(0)), ["__all"], value, ranks, small).drop("__all")
    keys = list(keys)
    x = F.col(value).cast("double")
    rows = df.filter(x.isNotNull() & ~F.isnan(x)).select(*keys, x.alias("x"))
    wanted = F.explode(F.array(*[F.struct(F.lit(name).alias("name"), c.cast("long").alias("rank")) for name, c in ranks.items()]))
    sizes = cut_lineage(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")))
    none = F.lit(None).cast("double")
    active = sizes.select(*keys, "n", wanted.alias("w")).select(*keys, "w.name", "w.rank", none.alias("lo"), none.alias("hi"), F.col("n").alias("left"))
    found = []
    while True:
        near = active.filter(F.col("left") <= small)
        cells = [*keys, "lo", "hi"]
        found.append(_finish(_inside(rows, near.select(*cells).distinct(), keys), near, cells))
        large = active.filter(F.col("left") > small)
        if not large.limit(1).count():
            break
        answers, active = _narrow(rows, cut_lineage(large), keys, cells)
        found.append(answers)
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    picked = every.groupBy(*keys).agg(*[F.max(F.when(F.col("name") == name, F.col("x"))).alias(name) for name in ranks])
    return join_stats(sizes, picked, keys)


def _inside(rows: DataFrame, cells: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows that lie between the borders of a cell of their group."""
    renamed = cells.select(*[F.col(k).alias(f"__{k}") for k in keys], "lo", "hi")
    on = (F.col("lo").isNull() | (F.col("x") > F.col("lo"))) & (F.col("hi").isNull() | (F.col("x") < F.col("hi")))
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"__{k}"))
    return rows.join(renamed.hint("merge"), on).select(*keys, "lo", "hi", "x")


def _meet(left: DataFrame, right: DataFrame, cells: Sequence[str]) -> DataFrame:
    return join_stats(left, right, cells, "inner")


def _finish(inside: DataFrame, near: DataFrame, cells: Sequence[str]) -> DataFrame:
    keys = [c for c in cells if c not in ("lo", "hi")]
    counted = inside.groupBy(*cells, "x").agg(F.count(F.lit(1)).alias("c"))
    upto = F.sum("c").over(Window.partitionBy(*cells).orderBy("x").rowsBetween(Window.unboundedPreceding, 0))
    placed = counted.withColumn("upto", upto)
    both = placed.alias("p").join(near.alias("w").hint("merge"), [F.col(f"p.{c}").eqNullSafe(F.col(f"w.{c}")) for c in cells])
    hit = both.filter((F.col("w.rank") <= F.col("p.upto")) & (F.col("w.rank") > F.col("p.upto") - F.col("p.c")))
    return hit.select(*[F.col(f"p.{k}").alias(k) for k in keys], "w.name", "p.x")


def _narrow(rows: DataFrame, large: DataFrame, keys: Sequence[str], cells: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Answers that are borders, and the wanted ranks with the smaller cells that hold them."""
    inside = cut_lineage(_inside(rows, large.select(*cells).distinct(), keys))
    points = [F.lit((i + 1) / (BORDERS + 1)) for i in range(BORDERS)]
    borders = inside.groupBy(*cells).agg(F.array_sort(F.array_distinct(F.percentile_approx("x", F.array(*points), 1000))).alias("b"))
    at = _meet(inside, borders, cells).select(*cells, "b", F.size(F.filter("b", lambda v: v < F.col("x"))).alias("i"), F.array_contains("b", F.col("x")).cast("int").alias("on"))
    counted = at.groupBy(*cells, "i", "on").agg(F.count(F.lit(1)).alias("c"), F.first("b").alias("b"))
    # Of the values between two borders come first those below the upper one, then those on it.
    upto = F.sum("c").over(Window.partitionBy(*cells).orderBy("i", "on").rowsBetween(Window.unboundedPreceding, 0))
    placed = counted.withColumn("upto", upto)
    both = placed.alias("p").join(large.alias("w").hint("merge"), [F.col(f"p.{c}").eqNullSafe(F.col(f"w.{c}")) for c in cells])
    hit = both.filter((F.col("w.rank") <= F.col("p.upto")) & (F.col("w.rank") > F.col("p.upto") - F.col("p.c")))
    low, high = F.coalesce(F.get("p.b", F.col("p.i") - 1), F.col("p.lo")), F.coalesce(F.get("p.b", F.col("p.i")), F.col("p.hi"))
    out = cut_lineage(hit.select(
        *[F.col(f"p.{k}").alias(k) for k in keys], "w.name", (F.col("w.rank") - (F.col("p.upto") - F.col("p.c"))).alias("rank"),
        low.alias("lo"), high.alias("hi"), F.col("p.c").alias("left"), (F.col("p.on") == 1).alias("done"),
    ))
    return out.filter("done").select(*keys, "name", F.col("hi").alias("x")), out.filter("NOT done").drop("done")


def exact_median(df: DataFrame, keys: Sequence[str], value: str, out: str = "median", small: int = SMALL) -> DataFrame:
    """Median of each key group: the middle value, or the mean of the two in the middle."""
    n = F.col("n")
    made = at_ranks(df, keys, value, {"__low": F.floor((n + 1) / 2), "__high": F.floor(n / 2) + 1}, small)
    return made.select(*keys, "n", ((F.col("__low") + F.col("__high")) / 2).alias(out))


def exact_percentiles(df: DataFrame, keys: Sequence[str], value: str, points: Mapping[str, float], small: int = SMALL) -> DataFrame:
    """Discrete percentiles of each key group: the least value that at least that share of the values does not exceed."""
    return at_ranks(df, keys, value, {name: F.greatest(F.ceil(F.lit(p) * F.col("n")), F.lit(1)) for name, p in points.items()}, small)
