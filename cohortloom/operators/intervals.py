"""Interval joins and range algebra on closed, 1-based ranges (chr, start, end).

The overlap join is a binned equi-join, so Spark sorts, spills and splits skew as for any other
join.  It asks for a merge join: Spark's size estimate does not see the copies per bin, so it would
send a side of many times the estimated size through the driver as a broadcast.  Ranges up to ``max_bins`` bins long live on the fine level, longer ones on the coarse level
(bins ``max_bins`` times wider): a fine row is copied at most ``max_bins`` + 4 times, a coarse one
twice per coarse bin it spans, and a short range never meets another short one inside a coarse bin.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.operators.common import first_row, join_stats, scan

BIN = 16_384
MAX_BINS = 64


def _div(c: Column, width: int) -> Column:
    return F.floor(c / F.lit(width)).cast("long")


def _bin_rows(df: DataFrame, lo: str, hi: str, bin_width: int, max_bins: int | None, query: bool) -> DataFrame:
    """One row per (level, bin, slot) a range takes part in.  Without ``max_bins`` there is one level: a point is one row.

    Slots keep pairs apart so that each pair can meet on exactly one level: "b" both ranges belong
    to this level, "q" the query belongs here and the subject is finer, "s" the reverse.
    """
    if max_bins is None:
        first, last = _div(F.col(lo), bin_width), _div(F.col(hi), bin_width)
        at = first.alias("__bin") if lo == hi else F.explode(F.sequence(first, last)).alias("__bin")
        known = df.filter(first.isNotNull() & last.isNotNull())
        return known.select(*df.columns, F.lit(0).alias("__lvl"), at, F.lit("b").alias("__slot"))
    wide = bin_width * max_bins
    fine_n = _div(F.col(hi), bin_width) - _div(F.col(lo), bin_width)
    is_fine = fine_n < max_bins

    def cells(level: int, width: int, slot: str) -> Column:
        seq = F.sequence(_div(F.col(lo), width), _div(F.col(hi), width))
        return F.transform(
            seq, lambda b: F.struct(F.lit(level).alias("lvl"), b.alias("bin"), F.lit(slot).alias("slot"))
        )

    own, other = ("q", "s") if query else ("s", "q")
    fine = F.concat(cells(0, bin_width, "b"), cells(1, wide, other))
    coarse = F.concat(cells(1, wide, "b"), cells(1, wide, own))
    return df.withColumn("__c", F.explode(F.when(is_fine, fine).otherwise(coarse))).select(
        *df.columns, F.col("__c.lvl").alias("__lvl"), F.col("__c.bin").alias("__bin"), F.col("__c.slot").alias("__slot")
    )


def overlap_join(
    query: DataFrame,
    subject: DataFrame,
    *,
    keys: Sequence[str] = ("chr",),
    q: tuple[str, str] = ("start", "end"),
    s: tuple[str, str] = ("start", "end"),
    maxgap: int = -1,
    minoverlap: int = 0,
    strand: str | None = None,
    bin_width: int = BIN,
    max_bins: int | None = MAX_BINS,
    prefix: str = "s_",
) -> DataFrame:
    """All overlapping pairs (inner).  Subject columns come back with ``prefix``.

    ``maxgap`` accepts ranges up to that many bases apart (0 = adjacent, -1 = must overlap);
    ``minoverlap`` asks for that many shared bases; ``strand`` names the strand column, where
    ``*`` matches either side.  ``max_bins=None`` is one level of bins, for points against ranges of which none is
    much longer than ``bin_width``: points are not copied, neither for a coarse level nor at all.
    """
    sub = subject.select(*[F.col(c).alias(prefix + c) for c in subject.columns])
    reach = maxgap + 1
    # The widened query decides the bins; the exact test below uses the true ends.
    qq = query.withColumn("__lo", F.col(q[0]) - F.lit(reach)).withColumn("__hi", F.col(q[1]) + F.lit(reach))
    point = max_bins is None and q[0] == q[1] and reach == 0
    lhs = _bin_rows(qq, "__lo", "__lo" if point else "__hi", bin_width, max_bins, True)
    s_lo, s_hi = prefix + s[0], prefix + s[1]
    rhs = _bin_rows(sub, s_lo, s_hi, bin_width, max_bins, False)
    rhs = rhs.select(
        *sub.columns, F.col("__lvl").alias("__rl"), F.col("__bin").alias("__rb"), F.col("__slot").alias("__rs")
    )
    width = F.when(F.col("__lvl") == 0, F.lit(bin_width)).otherwise(F.lit(bin_width * (max_bins or 1)))
    owner = F.greatest(F.floor(F.col("__lo") / width), F.floor(F.col(s_lo) / width))
    cond = (F.col("__lvl") == F.col("__rl")) & (F.col("__bin") == F.col("__rb")) & (F.col("__slot") == F.col("__rs"))
    for k in keys:
        cond = cond & (F.col(k) == F.col(prefix + k))
    cond = cond & (F.col("__lo") <= F.col(s_hi)) & (F.col(s_lo) <= F.col("__hi")) & (F.col("__bin") == owner)
    if minoverlap > 0:
        cond = cond & (F.least(F.col(q[1]), F.col(s_hi)) - F.greatest(F.col(q[0]), F.col(s_lo)) + 1 >= minoverlap)
    if strand:
        a, b = F.col(strand), F.col(prefix + strand)
        cond = cond & ((a == b) | (a == "*") | (b == "*"))
    return lhs.join(rhs.hint("merge"), cond).select(*query.columns, *sub.columns)


def overlap_width(a: str = "start", b: str = "end", c: str = "s_start", d: str = "s_end") -> Column:
    """Shared bases of a joined pair."""
    return F.least(F.col(b), F.col(d)) - F.greatest(F.col(a), F.col(c)) + 1


def first_overlap(
    query: DataFrame, subject: DataFrame, query_key: Sequence[str], subject_order: Sequence[str], **kw
) -> DataFrame:
    """Per query row the overlapping subject that comes first; queries without one are dropped."""
    pairs = overlap_join(query, subject, **kw)
    p = kw.get("prefix", "s_")
    return first_row(pairs, query_key, [F.col(p + c).asc() for c in subject_order])


def largest_overlap(
    query: DataFrame, subject: DataFrame, query_key: Sequence[str], subject_order: Sequence[str], **kw
) -> DataFrame:
    """Per query row the subject sharing most bases; ties go to the first subject."""
    p = kw.get("prefix", "s_")
    q, s = kw.get("q", ("start", "end")), kw.get("s", ("start", "end"))
    pairs = overlap_join(query, subject, **kw).withColumn("overlap", overlap_width(*q, p + s[0], p + s[1]))
    return first_row(pairs, query_key, [F.col("overlap").desc(), *[F.col(p + c).asc() for c in subject_order]])


# ---------------------------------------------------------------- range algebra

def merge_ranges(df: DataFrame, keys: Sequence[str] = ("chr",), min_gap: int = 1, chunk: int = 1_000_000) -> DataFrame:
    """Union of overlapping or adjacent ranges: (keys, start, end).

    Equal starts are folded first, so a chunk holds at most one row per position.  Two scans over
    the same (key, chunk) partitioning find the islands; the final group is again partial.
    """
    keys = list(keys)
    tops = df.groupBy(*keys, "start").agg(F.max("end").alias("end"))
    reach = scan(tops, keys, "start", {"__top": ("max", F.col("end"))}, chunk=chunk, inclusive=False, keep_chunk=True)
    opened = reach.withColumn(
        "__open", F.when(F.col("__top").isNull() | (F.col("start") > F.col("__top") + F.lit(min_gap)), F.col("start"))
    )
    island = scan(opened, keys, "start", {"__isl": ("last", F.col("__open"))}, chunk=chunk)
    return (
        island.groupBy(*keys, "__isl").agg(F.max("end").alias("end"))
        .select(*keys, F.col("__isl").alias("start"), "end")
    )


def gaps(df: DataFrame, sizes: DataFrame, keys: Sequence[str] = ("chr",), chunk: int = 1_000_000) -> DataFrame:
    """Uncovered ranges of every sequence; ``sizes`` has the keys and ``length``.

    A sequence without any range is one gap over its whole length.
    """
    keys = list(keys)
    merged = merge_ranges(df, keys, chunk=chunk)
    # A sentinel before the first base and one after the last make all gaps inner gaps.
    edges = sizes.select(*keys, F.lit(0).cast("long").alias("start"), F.lit(0).cast("long").alias("end")).unionByName(
        sizes.select(*keys, (F.col("length") + 1).cast("long").alias("start"), (F.col("length") + 1).cast("long").alias("end"))
    )
    cast = merged.select(*keys, F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"))
    known = cast.join(sizes.select(*keys), keys, "left_semi")
    both = known.unionByName(edges)
    prev = scan(both, keys, "start", {"__prev": ("max", F.col("end"))}, tie=["end"], chunk=chunk, inclusive=False)
    out = prev.select(*keys, (F.col("__prev") + 1).alias("start"), (F.col("start") - 1).alias("end"))
    return out.filter(F.col("start") <= F.col("end"))


def disjoin(df: DataFrame, keys: Sequence[str] = ("chr",), chunk: int = 1_000_000) -> DataFrame:
    """Split the covered part at every boundary; each piece carries its ``depth``."""
    keys = list(keys)
    steps = df.select(
        *keys,
        F.explode(F.array(
            F.struct(F.col("start").cast("long").alias("p"), F.lit(1).alias("d")),
            F.struct((F.col("end") + 1).cast("long").alias("p"), F.lit(-1).alias("d")),
        )).alias("e"),
    ).groupBy(*keys, F.col("e.p").alias("start")).agg(F.sum("e.d").alias("d"))
    depth = scan(steps, keys, "start", {"depth": ("sum", F.col("d"))}, chunk=chunk, keep_chunk=True)
    nxt = scan(depth, keys, "start", {"__next": ("last", F.col("start"))}, chunk=chunk, inclusive=False, reverse=True)
    return nxt.filter(F.col("depth") > 0).select(*keys, "start", (F.col("__next") - 1).alias("end"), "depth")


def subtract(a: DataFrame, b: DataFrame, keys: Sequence[str] = ("chr",), chunk: int = 1_000_000) -> DataFrame:
    """Bases of ``a`` not in ``b`` as merged ranges, on any sequence and at any position.

    One sweep over the ends of both merged sets keeps the depth of each.
    """
    keys = list(keys)

    def ends(df: DataFrame, name: str, other: str) -> DataFrame:
        pair = lambda p, d: F.struct(p.cast("long").alias("p"), F.lit(d).alias("d"))
        e = merge_ranges(df, keys, chunk=chunk).select(*keys, F.explode(F.array(pair(F.col("start"), 1), pair(F.col("end") + 1, -1))).alias("e"))
        return e.select(*keys, F.col("e.p").alias("start"), F.col("e.d").alias(name), F.lit(0).alias(other))

    steps = ends(a, "__a", "__b").unionByName(ends(b, "__b", "__a")).groupBy(*keys, "start").agg(F.sum("__a").alias("__a"), F.sum("__b").alias("__b"))
    depth = scan(steps, keys, "start", {"__na": ("sum", F.col("__a")), "__nb": ("sum", F.col("__b"))}, chunk=chunk, keep_chunk=True)
    nxt = scan(depth, keys, "start", {"__next": ("last", F.col("start"))}, chunk=chunk, inclusive=False, reverse=True)
    return nxt.filter((F.col("__na") > 0) & (F.col("__nb") == 0)).select(*keys, "start", (F.col("__next") - 1).alias("end"))


def intersect_ranges(a: DataFrame, b: DataFrame, keys: Sequence[str] = ("chr",)) -> DataFrame:
    """Shared bases of two sets as merged ranges."""
    pairs = overlap_join(merge_ranges(a, keys), merge_ranges(b, keys), keys=keys)
    return pairs.select(*keys, F.greatest("start", "s_start").alias("start"), F.least("end", "s_end").alias("end"))


def union_ranges(a: DataFrame, b: DataFrame, keys: Sequence[str] = ("chr",)) -> DataFrame:
    cols = [*keys, "start", "end"]
    return merge_ranges(a.select(*cols).unionByName(b.select(*cols)), keys)


def resize(df: DataFrame, by: int) -> DataFrame:
    """Pad (positive) or shrink (negative) both ends; ranges that vanish are dropped."""
    out = df.withColumn("start", F.col("start") - F.lit(by)).withColumn("end", F.col("end") + F.lit(by))
    return out.filter(F.col("start") <= F.col("end"))


def tile_sequences(sizes: DataFrame, width: int) -> DataFrame:
    """Fixed-width tiling; the last tile of a sequence is cut at its length."""
    starts = sizes.select("chr", "length", F.explode(F.sequence(F.lit(1).cast("long"), F.col("length").cast("long"), F.lit(width).cast("long"))).alias("start"))
    return starts.select("chr", "start", F.least(F.col("start") + F.lit(width - 1), F.col("length").cast("long")).alias("end"))


def target_tiles(targets: DataFrame, sizes: DataFrame, centromeres: DataFrame, *, shoulder: int, min_gap: int) -> DataFrame:
    """Targets plus the shrunk off-target gaps between them (gaps on a centromere are dropped)."""
    hole = gaps(targets, sizes)
    wide = hole.filter(F.col("end") - F.col("start") + 1 > F.lit(2 * shoulder + min_gap))
    off = resize(without_overlap(wide, centromeres), -shoulder).withColumn("target", F.lit(False))
    on = targets.select("chr", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"), F.lit(True).alias("target"))
    return on.unionByName(off.select("chr", "start", "end", "target"))


# ---------------------------------------------------------------- as-of lookups

def asof_join(
    points: DataFrame,
    marks: DataFrame,
    *,
    keys: Sequence[str] = ("chr",),
    at: str = "pos",
    mark: str = "pos",
    direction: str = "backward",
    bin_width: int = 1_000_000,
    prefix: str = "m_",
) -> DataFrame:
    """Left join of each point with the nearest mark at or before it (or at or after it).

    ``marks`` must hold one row per (keys, mark).  The distinct positions of points and marks are swept
    together, in chunks of ``bin_width`` positions, so a chunk holds at most one row per position however
    many points lie there.  The points themselves are not ordered: they meet their answer in an equi-join
    on (keys, position).  No position is too high.
    """
    keys = list(keys)
    row = F.struct(*[F.col(c) for c in marks.columns])
    found = _sweep(points, keys, at, {"__row": (marks.select(*keys, F.col(mark).alias("__p"), row.alias("__row")), direction == "forward")}, bin_width)
    return _at_positions(points, found, keys, at, [F.col(f"__row.{c}").alias(prefix + c) for c in marks.columns])


def _sweep(points: DataFrame, keys: Sequence[str], at: str, marks: Mapping[str, tuple[DataFrame, bool]], chunk: int) -> DataFrame:
    """(keys, __p, one column per entry of ``marks``) for each distinct position of the points.

    An entry is (table of keys, __p and the entry's column, whether to look forward); at one position any of its rows counts.
    """
    there = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in [*keys, "__p"]])
    rows = points.select(*keys, F.col(at).alias("__p")).filter(there).distinct().withColumn("__asked", F.lit(True))
    for table, _ in marks.values():
        rows = rows.unionByName(table.filter(there), allowMissingColumns=True)
    rows = rows.groupBy(*keys, "__p").agg(F.max("__asked").alias("__asked"), *[F.first(n, ignorenulls=True).alias(n) for n in marks])
    for forward in (False, True):
        specs = {f"__at{n}": ("last", F.col(n)) for n, (_, f) in marks.items() if f == forward}
        if specs:
            rows = scan(rows, keys, "__p", specs, chunk=chunk, reverse=forward, keep_chunk=True)
    return rows.filter("__asked").select(*keys, "__p", *[F.col(f"__at{n}").alias(n) for n in marks])


def _at_positions(points: DataFrame, found: DataFrame, keys: Sequence[str], at: str, columns: Sequence[Column]) -> DataFrame:
    """Points with columns of their position's row; NULLs where keys or position are NULL."""
    names = [f"__c{i}" for i in range(len(columns))]
    aside = found.select(*[F.col(k).alias(f"__k_{k}") for k in keys], "__p", *[c.alias(n) for c, n in zip(columns, names, strict=True)])
    cond = points[at] == aside["__p"]
    for k in keys:
        cond = cond & (points[k] == aside[f"__k_{k}"])
    outs = [found.select(c).columns[0] for c in columns]
    return points.join(aside, cond, "left").select(*[points[c] for c in points.columns], *[F.col(n).alias(o) for n, o in zip(names, outs, strict=True)])


def overlap_flag(
    query: DataFrame, subject: DataFrame, flag: str, *, keys: Sequence[str] = ("chr",),
    q: tuple[str, str] = ("start", "end"),
) -> DataFrame:
    """Whether any subject overlaps, without listing pairs.

    In a merged subject a range [a,b] is hit exactly if the last range starting at or before b ends
    at or after a: one as-of lookup per query row.
    """
    merged = merge_ranges(subject, keys)
    hit = asof_join(query, merged, keys=keys, at=q[1], mark="start", prefix="__m_")
    return hit.withColumn(flag, F.coalesce(F.col("__m_end") >= F.col(q[0]), F.lit(False))).select(*query.columns, flag)


def with_overlap(query: DataFrame, subject: DataFrame, **kw) -> DataFrame:
    return overlap_flag(query, subject, "__hit", **kw).filter("__hit").drop("__hit")


def without_overlap(query: DataFrame, subject: DataFrame, **kw) -> DataFrame:
    return overlap_flag(query, subject, "__hit", **kw).filter(~F.col("__hit")).drop("__hit")


def covered_fraction(
    query: DataFrame, mask: DataFrame, name: str, *, keys: Sequence[str] = ("chr",), merge: bool = True,
) -> DataFrame:
    """Share of each (distinct) query range covered by the mask; 0 where nothing overlaps."""
    keys = list(keys)
    m = merge_ranges(mask, keys) if merge else mask.select(*keys, "start", "end")
    ranges = query.select(*keys, "start", "end").distinct()
    pairs = overlap_join(ranges, m, keys=keys)
    share = pairs.groupBy(*keys, "start", "end").agg(F.sum(overlap_width()).alias("__c"))
    out = join_stats(query, share, [*keys, "start", "end"])
    return out.withColumn(name, F.coalesce(F.col("__c"), F.lit(0)) / (F.col("end") - F.col("start") + 1)).drop("__c")


def nearest(
    points: DataFrame, subject: DataFrame, *, keys: Sequence[str] = ("chr",), pos: str = "pos",
    point_key: Sequence[str], prefix: str = "n_",
) -> DataFrame:
    """Closest range of each point (0 apart when inside); ties go to the lower start, then to the lower end.

    Three lookups in one sweep over the distinct positions: the range holding the point that starts first, the
    closest end before it, the closest start after.  Ranges holding a point are not listed: of the ranges that
    reach beyond all that start earlier, the one with the first end at or after the point is the first holder, if
    it starts in time.
    """
    keys = list(keys)
    cols = subject.columns
    pay = F.struct(*[F.col(c) for c in cols])
    ends = subject.groupBy(*keys, "end").agg(F.min_by(pay, F.col("start")).alias("r"))
    starts = subject.groupBy(*keys, "start").agg(F.min_by(pay, F.col("end")).alias("r"))
    proper = subject.filter(F.col("start") <= F.col("end"))
    tops = proper.groupBy(*keys, "start").agg(F.max("end").alias("__top"))
    earlier = scan(tops, keys, "start", {"__before": ("max", F.col("__top"))}, inclusive=False).select(*keys, "start", "__before")
    reach = proper.groupBy(*keys, "end").agg(F.min("start").alias("start"), F.min_by(pay, F.col("start")).alias("r")).join(earlier, [*keys, "start"])
    holders = reach.filter(F.col("__before").isNull() | (F.col("end") > F.col("__before")))
    marks = lambda df, p, out: df.select(*keys, F.col(p).alias("__p"), F.col("r").alias(out))
    found = _sweep(points, keys, pos, {"__in": (marks(holders, "end", "__in"), True), "__back": (marks(ends, "end", "__back"), False), "__fwd": (marks(starts, "start", "__fwd"), True)}, 1_000_000)
    p, back, fwd = F.col("__p"), F.col("__back"), F.col("__fwd")
    d_back, d_fwd = p - back["end"], fwd["start"] - p
    best = (
        F.when(F.col("__in.start") <= p, F.col("__in"))
        .when(fwd.isNull() | (d_back < d_fwd), back)
        .when(back.isNull() | (d_fwd < d_back), fwd)
        .when(back["start"] <= fwd["start"], back).otherwise(fwd)
    )
    return _at_positions(points, found.withColumn("__best", best), keys, pos, [F.col(f"__best.{c}").alias(prefix + c) for c in cols])


def pair_overlap(
    pairs: DataFrame, records: DataFrame, *, pair_key: Sequence[str], record_key: Sequence[str], maxgap: int = -1,
    strands: bool = False, both_ways: bool = False,
) -> DataFrame:
    """Pairs of positions of which both ends hit the same two-ended record.

    ``pairs``: chr1,pos1,chr2,pos2 (+strand1,strand2).  ``records``: chr1,start1,end1,chr2,start2,
    end2 (+strand1,strand2).  The first ends are joined by position; the second ends are a filter on
    the joined row, so no second interval join is needed.
    """
    q = pairs.withColumn("chr", F.col("chr1")).withColumn("__p", F.col("pos1"))
    r = records.withColumn("chr", F.col("chr1"))
    hit = overlap_join(q, r, q=("__p", "__p"), s=("start1", "end1"), maxgap=maxgap)
    g = maxgap + 1
    cond = (F.col("chr2") == F.col("s_chr2")) & (F.col("pos2") - g <= F.col("s_end2")) & (F.col("pos2") + g >= F.col("s_start2"))
    if strands:
        cond = cond & (F.col("strand1") == F.col("s_strand1")) & (F.col("strand2") == F.col("s_strand2"))
    return hit.filter(cond).drop("chr", "__p", "s_chr")
