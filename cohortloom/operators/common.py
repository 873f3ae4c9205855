"""Building blocks shared by the operators.

Hot groups are the rule here, not the exception: one chromosome, sample or gene may hold a third of
all rows.  None of these helpers brings a whole group into one task.

* group statistics are partial aggregates joined back (AQE splits a skewed side of the join);
* first / top-n per group uses a ranked filter, which Spark cuts to n rows per group and task
  *before* the shuffle (WindowGroupLimit);
* ordered scans run in two levels: inside fixed-width position chunks, then over one summary row per
  chunk.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.session import cut_lineage, store_by, tasks_for


def null_safe(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> Column:
    return reduce(lambda a, b: a & b, [left[l].eqNullSafe(right[r]) for l, r in pairs])


def join_stats(df: DataFrame, stats: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join one-row-per-key statistics back on null-safe keys."""
    renamed = stats.select(
        *[F.col(k).alias(f"__k_{k}") for k in keys], *[c for c in stats.columns if c not in keys]
    )
    cond = null_safe(df, renamed, [(k, f"__k_{k}") for k in keys])
    return df.join(renamed, cond, how).drop(*[f"__k_{k}" for k in keys])


def with_group(df: DataFrame, keys: Sequence[str], aggs: Mapping[str, Column], whole: bool = False) -> DataFrame:
    """Add aggregates of each key group to every row of the group.

    ``whole``: no group is too large for a task (``whole_groups``), and each aggregate is one function.  Then it is a
    window, which moves rows once, or not at all where they are dealt by one of the keys.
    """
    if whole:
        w = Window.partitionBy(*keys)
        return df.select("*", *[c.over(w).alias(n) for n, c in aggs.items()])
    stats = df.groupBy(*keys).agg(*[c.alias(n) for n, c in aggs.items()])
    return join_stats(df, stats, keys)


#: Hash buckets whose rows are counted to find groups that a task should not hold.
BUCKETS = 4096
#: Rows of one key that a task may hold in any case.
WHOLE_ROWS = 50_000


def whole_groups(df: DataFrame, key: str) -> int | None:
    """Tasks to deal the groups of ``key`` to, or None if one of them may hold more than two tasks' share of the rows.

    Counts the rows of hash buckets, so a bound is proven without shuffling keys.  Runs a job that reads only the key.
    """
    n = df.groupBy(F.pmod(F.xxhash64(key), F.lit(BUCKETS)).alias("__b")).agg(F.count(F.lit(1)).alias("__n"))
    total, most = n.agg(F.coalesce(F.sum("__n"), F.lit(0)), F.coalesce(F.max("__n"), F.lit(0))).first()
    tasks = tasks_for(df.sparkSession, total)
    return tasks if most <= max(WHOLE_ROWS, 2 * total // tasks) else None


def keep(df: DataFrame, key: str, tasks: int | None) -> DataFrame:
    """Store a table, dealt by ``key`` if there are ``tasks`` to deal it to (``whole_groups``)."""
    return store_by(df, key, tasks) if tasks else cut_lineage(df)


def top_n(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1) -> DataFrame:
    """First ``n`` rows of each group in the given total order."""
    ranked = df.withColumn("__rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("__rn") <= n).drop("__rn")


def first_row(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    return top_n(df, keys, order, 1)


def grid(left: DataFrame, right: DataFrame) -> DataFrame:
    """Every pairing of two key lists (a dense matrix result needs all cells).  Runs jobs while it is called.

    Written as an equi-join on cells of a square of buckets: each left row is copied once per column of the square,
    each right row once per row, which are chosen by the stored lists' sizes so that few copies are shuffled.  Neither
    side must fit in one task, and a merge join is asked for, as Spark's size estimate does not see the copies.
    """
    left, right = cut_lineage(left), cut_lineage(right)
    tasks = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n_left, n_right = max(left.count(), 1), max(right.count(), 1)
    cols = min(max(round(math.sqrt(tasks * n_right / n_left)), 1), tasks)
    rows = -(-tasks // cols)
    dealt = lambda df, n: F.pmod(F.xxhash64(*df.columns), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    lhs = left.withColumn("__r", dealt(left, rows)).withColumn("__b", every(cols))
    rhs = right.withColumn("__b", dealt(right, cols)).withColumn("__r", every(rows))
    return lhs.join(rhs.hint("merge"), ["__r", "__b"]).drop("__r", "__b")


def later_wins(rules: Sequence[tuple[Column, Column]], default: Column) -> Column:
    """Cascade in which the last true rule decides (a true rule is never undone by NULL)."""
    out = None
    for cond, value in reversed(list(rules)):
        cond = F.coalesce(cond, F.lit(False))
        out = F.when(cond, value) if out is None else out.when(cond, value)
    return out.otherwise(default)


#: kind -> (aggregate of a set of rows, way to combine an earlier value with a later one)
def _combine(kind: str, earlier: Column, later: Column) -> Column:
    if kind == "sum":
        return F.coalesce(earlier, F.lit(0)) + F.coalesce(later, F.lit(0))
    if kind == "max":
        return F.greatest(earlier, later)
    if kind == "min":
        return F.least(earlier, later)
    if kind == "last":
        return F.coalesce(later, earlier)
    raise ValueError(kind)


def _over(kind: str, value: Column, window) -> Column:
    fn = {"sum": F.sum, "max": F.max, "min": F.min}.get(kind)
    return fn(value).over(window) if fn else F.last(value, ignorenulls=True).over(window)


def _plain_scan(df, keys, pos, specs, tie, inclusive, reverse) -> DataFrame:
    order = [F.col(c).desc() if reverse else F.col(c).asc() for c in (pos, *tie)]
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow if inclusive else -1)
    return df.select("*", *[_over(kind, value, w).alias(n) for n, (kind, value) in specs.items()])


def scan(
    df: DataFrame,
    keys: Sequence[str],
    pos: str,
    specs: Mapping[str, tuple[str, Column]],
    *,
    tie: Sequence[str] = (),
    chunk: int | None = 1_000_000,
    inclusive: bool = True,
    reverse: bool = False,
    keep_chunk: bool = False,
) -> DataFrame:
    """Running sum / max / min / last-non-null along ``pos`` inside each key group.

    ``specs`` maps a new column to (kind, value).  The window never spans more than one
    ``chunk`` of positions, so a group of any size is spread over many tasks; a second window
    runs over one summary row per chunk.  ``reverse`` scans from high to low positions.
    ``keep_chunk`` leaves the chunk column for a following scan, which then needs no new shuffle.
    ``chunk=None`` is one plain window, for groups whose size has a proven bound (such as the
    segments of one model): it reads its input once, the two-level form reads it twice.
    """
    keys = list(keys)
    names = list(specs)
    if chunk is None:
        return _plain_scan(df, keys, pos, specs, tie, inclusive, reverse)
    base = df
    if "__chunk" not in df.columns:
        base = base.withColumn("__chunk", F.floor(F.col(pos) / F.lit(chunk)).cast("long"))
    # Scan values are materialised first, so both levels see the same columns.
    base = base.select("*", *[specs[n][1].alias(f"__v_{n}") for n in names])

    def direct(c: str) -> Column:
        return F.col(c).desc() if reverse else F.col(c).asc()

    inner = Window.partitionBy(*keys, "__chunk").orderBy(direct(pos), *[direct(t) for t in tie])
    inner = inner.rowsBetween(Window.unboundedPreceding, Window.currentRow if inclusive else -1)
    outer = Window.partitionBy(*keys).orderBy(direct("__chunk")).rowsBetween(Window.unboundedPreceding, -1)

    def total(name: str) -> Column:
        kind, value = specs[name][0], F.col(f"__v_{name}")
        if kind == "last":
            best = F.min_by if reverse else F.max_by
            return best(value, F.when(value.isNotNull(), F.struct(pos, *tie)))
        return {"sum": F.sum, "max": F.max, "min": F.min}[kind](value)

    summary = base.groupBy(*keys, "__chunk").agg(*[total(n).alias(f"__t_{n}") for n in names])
    offsets = summary.select(
        *keys, "__chunk", *[_over(specs[n][0], F.col(f"__t_{n}"), outer).alias(f"__o_{n}") for n in names]
    )
    local = base.select("*", *[_over(specs[n][0], F.col(f"__v_{n}"), inner).alias(f"__l_{n}") for n in names])
    # Plain equality keeps the partitioning of the window, so this side is not shuffled again.
    both = local.join(offsets, [*keys, "__chunk"], "left")
    kept = [c for c in df.columns if c != "__chunk"] + (["__chunk"] if keep_chunk else [])
    return both.select(
        *kept, *[_combine(specs[n][0], F.col(f"__o_{n}"), F.col(f"__l_{n}")).alias(n) for n in names]
    )


def runs(
    df: DataFrame, keys: Sequence[str], pos: str, same_as_previous: Sequence[str], *, chunk: int | None = 1_000_000,
    null_is_equal: bool = False, out: str = "run",
) -> DataFrame:
    """Number maximal runs of consecutive rows whose listed columns do not change.

    The run id is the position at which the run starts.  ``pos`` must be unique in a group.
    With ``null_is_equal`` a NULL on either side counts as no change.
    """
    prev = scan(
        df, keys, pos,
        {f"__p_{c}": ("last", F.struct(F.col(c).alias("v"))) for c in same_as_previous},
        chunk=chunk, inclusive=False, keep_chunk=True,
    )

    def changed(c: str) -> Column:
        now, before = F.col(c), F.col(f"__p_{c}.v")
        return F.coalesce(now != before, F.lit(False)) if null_is_equal else ~now.eqNullSafe(before)

    flag = reduce(lambda a, b: a | b, [changed(c) for c in same_as_previous])
    first = F.col(f"__p_{same_as_previous[0]}").isNull()
    marked = prev.withColumn("__new", F.when(first | flag, F.col(pos)))
    done = scan(marked, keys, pos, {out: ("last", F.col("__new"))}, chunk=chunk)
    return done.drop("__new", *[f"__p_{c}" for c in same_as_previous])


def numbered(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str = "n") -> DataFrame:
    """Stored rows with their place (from 0) inside each key group in the given order, NULLs first.

    The rows are sorted by ranges of (keys, order), so a group of any size is spread over many tasks; only one row per
    group and range is counted together.  Rows that tie stand next to each other in any order.
    """
    by = [F.col(c).asc_nulls_first() for c in [*keys, *order]]
    rows = cut_lineage(df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("__seq", F.monotonically_increasing_id()))
    rows = rows.withColumn("__part", F.shiftright("__seq", 33))
    parts = rows.groupBy(*keys, "__part").agg(F.min("__seq").alias("__first"), F.count(F.lit(1)).alias("__n"))
    earlier = Window.partitionBy(*keys).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select(*keys, "__part", (F.coalesce(F.sum("__n").over(earlier), F.lit(0)) - F.col("__first")).alias("__shift"))
    return join_stats(rows, starts, [*keys, "__part"]).select(*df.columns, (F.col("__seq") + F.col("__shift")).alias(out))
