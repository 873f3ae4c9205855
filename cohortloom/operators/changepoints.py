"""Change points of long series by binary segmentation over chunk summaries.

The split of a range [a, b) at x is judged by |S_x - S_a - (x - a)(S_b - S_a)/(b - a)| / sqrt((x - a)(b - x)/(b - a)), S being
the prefix sums.  Where this exceeds a threshold t, a convex function of the point (x, S_x) is positive (a linear function
less t times a concave one), so the best split is always a corner of the convex hull of the points.  Each chunk of a series
is therefore kept as the corners of its hull, a few dozen of thousands of points.  A round finds the best split of every
range of all series from the corners alone; only the chunks that a split cuts through get new hulls from their values.
Rounds are as many as the splits are nested.  No task holds more than one chunk's values.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from cohortloom.operators.common import join_stats, numbered, scan
from cohortloom.operators.order import SMALL, exact_median
from cohortloom.session import cut_lineage

#: Values of one chunk.
CHUNK = 4_096


def _chain(y: np.ndarray) -> list[int]:
    """Places of the corners of the lower convex hull of the points (0, y0), (1, y1), ..."""
    out: list[int] = []
    for k, v in enumerate(y.tolist()):
        while len(out) > 1 and (y[out[-1]] - y[out[-2]]) * (k - out[-2]) >= (v - y[out[-2]]) * (out[-1] - out[-2]):
            out.pop()
        out.append(k)
    return out


@F.pandas_udf(StructType([StructField("x", ArrayType(LongType())), StructField("s", ArrayType(DoubleType()))]))
def _corners(sums: pd.Series, first: pd.Series, lo: pd.Series, hi: pd.Series) -> pd.DataFrame:
    xs, ss = [], []
    for s, f, a, b in zip(sums, first, lo, hi):
        y = np.asarray(s, float)[a - f : b - f + 1]
        local = y - y[0]
        at = np.array(sorted({*_chain(local), *_chain(-local)}))
        xs.append(at + a)
        ss.append(y[at])
    return pd.DataFrame({"x": xs, "s": ss})


def _with_hull(pieces: DataFrame) -> DataFrame:
    return pieces.withColumn("hull", _corners("sums", "first", "lo", "hi")).drop("sums", "first")


def _noise(rows: DataFrame) -> DataFrame:
    """Per series its count, sum and noise: the median absolute deviation of successive differences, or the plain
    deviation where that is 0, or 1."""
    middle = exact_median(rows, ["__k"], "__d", "__mid", small=SMALL).select("__k", "__mid")
    far = join_stats(rows.select("__k", "__d"), middle, ["__k"]).withColumn("__d", F.abs(F.col("__d") - F.col("__mid")))
    spread = exact_median(far, ["__k"], "__d", "__mad", small=SMALL).select("__k", "__mad")
    sizes = rows.groupBy("__k").agg(F.count(F.lit(1)).alias("n"), F.sum("__y").alias("total"), F.stddev_pop("__y").alias("__sd"))
    positive = lambda c: F.when(c > 0, c)
    sd = F.coalesce(positive(1.4826 * F.col("__mad") / F.sqrt(F.lit(2.0))), positive(F.col("__sd")), F.lit(1.0))
    return join_stats(sizes, spread, ["__k"]).select("__k", "n", "total", sd.alias("sd"))


def _best() -> Column:
    """(score, -x, S_x) of a piece's best split; of equal ones the first."""
    m = F.col("b") - F.col("a")

    def score(x: Column, s: Column) -> Column:
        i = x - F.col("a")
        dev = F.abs((s - F.col("sa")) - i * (F.col("sb") - F.col("sa")) / m) / F.sqrt(i * (m - i) / m)
        return F.struct(dev.alias("dev"), (-x).alias("back"), s.alias("s"))

    return F.array_max(F.zip_with("hull.x", "hull.s", score))


def change_points(df: DataFrame, keys: Sequence[str], order: str, value: str, min_width: int = 2, alpha: float = 0.01, chunk: int = CHUNK) -> DataFrame:
    """One row for each change of mean: keys, ``order`` of the first value after it, and ``at``, that value's place.

    Places count from 0 over the values of a series that are neither NULL nor NaN; ``order`` must not repeat in a series (of
    equal ones any is first), NULLs are first, and NULL keys are a series.  A range is split at its best place, with
    ``min_width`` values on each side, if the score exceeds sqrt(2 ln(n / alpha)) times the noise of the whole series.
    Constant, short and empty series have no change.  Runs jobs while it is called: some for the noise, and two for each level
    of nested splits.
    """
    if min_width < 1 or chunk < 2:
        raise ValueError("min_width must be positive and chunk at least 2")
    keys, w = list(keys), F.lit(min_width)
    y = F.col(value).cast("double")
    name = F.to_json(F.struct(F.lit(1).alias("__one"), *keys), {"ignoreNullFields": "false"})
    series = df.filter(y.isNotNull() & ~F.isnan(y)).select(name.alias("__k"), F.struct(F.lit(1).alias("__one"), *keys).alias("__key"), F.col(order).alias("__o"), y.alias("__y"))
    rows = cut_lineage(numbered(series, ["__k"], ["__o"], "__at"))
    before = scan(rows.drop("__key", "__o"), ["__k"], "__at", {"__s": ("sum", F.col("__y")), "__p": ("last", F.col("__y"))}, chunk=chunk, inclusive=False)
    sums = cut_lineage(before.select("__k", "__at", "__y", F.coalesce("__s", F.lit(0.0)).alias("__s"), (F.col("__y") - F.col("__p")).alias("__d")))
    stats = _noise(sums).select("__k", "n", "total", (F.sqrt(2 * F.log(F.col("n") / alpha)) * F.col("sd")).alias("limit"))
    inside = F.array_sort(F.collect_list(F.struct("__at", "__s")))
    chunks = sums.groupBy("__k", F.floor(F.col("__at") / chunk).alias("c")).agg(F.min("__at").alias("first"), inside.alias("v"))
    chunks = cut_lineage(chunks.select("__k", "c", "first", F.col("v.__s").alias("sums")))

    last = F.col("first") + F.size("sums") - 1
    whole = join_stats(chunks, stats, ["__k"], "inner").select(
        "__k", "c", "limit", F.lit(0).cast("long").alias("a"), F.col("n").alias("b"), F.lit(0.0).alias("sa"), F.col("total").alias("sb"),
        F.greatest("first", w).cast("long").alias("lo"), F.least(last, F.col("n") - w).cast("long").alias("hi"), "first", "sums")
    pieces = cut_lineage(_with_hull(whole.filter("lo <= hi")))
    found = []
    while True:
        best = pieces.withColumn("best", _best()).groupBy("__k", "a", "limit").agg(F.max("best").alias("best"))
        cuts = cut_lineage(best.filter(F.col("best.dev") > F.col("limit")).select("__k", "a", (-F.col("best.back")).alias("x"), F.col("best.s").alias("s")))
        if not cuts.limit(1).count():
            break
        found.append(cuts.select("__k", F.col("x").alias("__at")))
        pieces = cut_lineage(_split(pieces.join(cuts, ["__k", "a"]), chunks, w))
    places = reduce(DataFrame.unionByName, found) if found else rows.select("__k", "__at").limit(0)
    hit = rows.join(places, ["__k", "__at"])
    return hit.select(*[F.col(f"__key.`{k}`").alias(k) for k in keys], F.col("__o").alias(order), F.col("__at").alias("at"))


def _split(cut: DataFrame, chunks: DataFrame, w: Column) -> DataFrame:
    """The pieces of both parts of each range that was split; one that lost a border to the split gets a new hull."""
    x, s = F.col("x"), F.col("s")
    left = F.struct(F.col("a"), x.alias("b"), F.col("sa"), s.alias("sb"), F.col("lo"), F.least(F.col("hi"), x - w).alias("hi"))
    right = F.struct(x.alias("a"), F.col("b"), s.alias("sa"), F.col("sb"), F.greatest(F.col("lo"), x + w).alias("lo"), F.col("hi"))
    parts = cut.select("__k", "c", "limit", "hull", F.struct("lo", "hi").alias("old"), F.explode(F.array(left, right)).alias("p")).filter("p.lo <= p.hi")
    same = (F.col("old.lo") == F.col("p.lo")) & (F.col("old.hi") == F.col("p.hi"))
    fields = ["__k", "c", "limit", "p.*"]
    kept = parts.filter(same).select(*fields, "hull")
    anew = parts.filter(~same).drop("hull").join(chunks, ["__k", "c"]).select(*fields, "first", "sums")
    return kept.unionByName(_with_hull(anew))


def joint_segments(df: DataFrame, keys: Sequence[str], order: str, values: Sequence[str], min_width: int = 2, alpha: float = 0.01, chunk: int = CHUNK, out: str = "seg") -> DataFrame:
    """Every row with ``out``, the number (from 1) of its segment in its series: cut wherever any of ``values`` changes.

    ``order`` is a whole number (a position) that does not repeat in a series; see ``change_points`` for the rest.
    """
    keys = list(keys)
    kinds = F.explode(F.array(*[F.struct(F.lit(i).alias("kind"), F.col(v).cast("double").alias("y")) for i, v in enumerate(values)])).alias("__v")
    stacked = df.select(*keys, F.col(order), kinds).select(*keys, order, F.col("__v.kind").alias("__kind"), F.col("__v.y").alias("__y0"))
    cuts = change_points(stacked, [*keys, "__kind"], order, "__y0", min_width, alpha, chunk).select(*keys, order).distinct()
    marked = join_stats(df, cuts.withColumn("__new", F.lit(1).cast("long")), [*keys, order])
    rows = cut_lineage(numbered(marked, keys, [order], "__row"))
    done = scan(rows, keys, "__row", {out: ("sum", F.coalesce("__new", F.lit(0).cast("long")))}, chunk=65_536)
    return done.withColumn(out, F.col(out) + 1).drop("__new", "__row")
