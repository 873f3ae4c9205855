"""Genome-instability scores of every sample from its copy-number segments.

Input: id, chr, start, end, width, C, K, sC and, for the arm-based scores, arm and ``centromere``
(share of the segment inside the centromere; see ``add_references``).  Autosomes only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.operators.common import scan, with_group
from cohortloom.operators.copynumber import SEX_CHROMOSOMES, weighted_median
from cohortloom.operators.intervals import covered_fraction, first_overlap


@dataclass(frozen=True)
class Thresholds:
    """Fixed values of the published score definitions, in bases or shares."""

    arm_share: float = 0.8
    telomere: int = 10_000
    ntai_length: int = 1_000_000
    loh_length: int = 15_000_000
    lst_length: int = 10_000_000
    lst_distance: int = 3_000_000
    ai_length: int = 8_000_000
    cnloh_length: int = 4_000_000
    focal_width: int = 7_000_000
    si_max: float = 10.0
    si_step: float = 0.5


def add_references(segments: DataFrame, centromeres: DataFrame, cytobands: DataFrame) -> DataFrame:
    """Centromere share and the arm of the first cytoband."""
    out = covered_fraction(segments, centromeres, "centromere", merge=False)
    bands = cytobands.select("chr", "start", "end", F.concat("chr", F.substring("name", 1, 1)).alias("arm"))
    ranges = segments.select("chr", "start", "end").distinct()
    arm = first_overlap(ranges, bands, ["chr", "start", "end"], ["start"]).select("chr", "start", "end", F.col("s_arm").alias("arm"))
    return out.drop("arm").join(arm, ["chr", "start", "end"], "left")


def _autosomes(df: DataFrame) -> DataFrame:
    return df.filter(~F.col("chr").isin(SEX_CHROMOSOMES))


def gii(segments: DataFrame) -> DataFrame:
    """Share of the length with C other than the weighted median: genome-wide and as a mean of chromosomes."""
    s = _autosomes(segments).filter(F.col("C").isNotNull())
    m = s.join(weighted_median(s, ["id"], "C", "width", "m"), "id")
    off = F.sum(F.when(F.col("C") != F.col("m"), F.col("width")).otherwise(0))
    per = m.groupBy("id", "chr").agg(off.alias("off"), F.sum("width").alias("len"))
    return per.groupBy("id").agg((F.sum("off") / F.sum("len")).alias("gii"), F.avg(F.col("off") / F.col("len")).alias("wgii"))


def loh_portion(segments: DataFrame) -> DataFrame:
    s = _autosomes(segments).filter(F.col("K").isNotNull())
    return s.groupBy("id").agg((F.sum(F.when(F.col("K") == 0, F.col("width")).otherwise(0)) / F.sum("width")).alias("loh_portion"))


def lst(segments: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    """Large-scale transitions: after dropping short segments, close neighbours of an arm that differ in C or K."""
    long = _autosomes(segments).filter(F.col("sC").isNotNull() & (F.col("width") > t.lst_length))
    here = F.struct("start", F.col("C").alias("c"), F.col("K").alias("k"))
    nxt = scan(long, ["id", "arm"], "start", {"__n": ("last", here)}, inclusive=False, reverse=True)
    distance = F.greatest(F.col("__n.start") - F.col("end") - 1, F.lit(0))
    differs = F.coalesce((F.col("C") != F.col("__n.c")) | (F.col("K") != F.col("__n.k")), F.lit(False))
    hit = F.col("__n").isNotNull() & (distance < t.lst_distance) & differs
    ids = segments.select("id").distinct()
    return ids.join(nxt.groupBy("id").agg(F.count(F.when(hit, 1)).alias("lst")), "id", "left").fillna(0, ["lst"])


def _imbalance(segments: DataFrame, sizes: DataFrame | None, t: Thresholds) -> DataFrame:
    """Per segment: allelic imbalance, arm-level flag, telomere contact."""
    s = _autosomes(segments)
    m = s.join(weighted_median(s, ["id"], "C", "width", "m"), "id", "left")
    c, k = F.col("C"), F.col("K")
    # Balanced: equal alleles at an even median, heterozygous at the median otherwise; unknown counts as balanced.
    balanced = F.when(F.col("m") % 2 == 0, k == c - k).otherwise((k != 0) & (c == F.col("m")))
    ai = F.coalesce(~balanced, F.lit(False))
    armed = with_group(m.withColumn("ai", ai), ["id", "arm"], {"__arm": F.sum("width")})
    out = armed.withColumn("arm_level", F.col("width") / F.col("__arm") > t.arm_share).drop("__arm")
    if sizes is not None:
        out = out.join(sizes.select("chr", F.col("length").alias("__len")), "chr", "left")
        out = out.withColumn("on_telomere", (F.col("start") < t.telomere) | (F.col("__len") - t.telomere < F.col("end"))).drop("__len")
    return out


def _open_length() -> Column:
    return F.col("width") * (1 - F.col("centromere"))


def _count(cond: Column, name: str) -> Column:
    return F.count(F.when(cond, 1)).alias(name)


def ntai(segments: DataFrame, sizes: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    """Telomeric allelic imbalances that are not arm-level."""
    s = _imbalance(segments, sizes, t)
    return s.groupBy("id").agg(_count((_open_length() > t.ntai_length) & ~F.col("arm_level") & F.col("on_telomere") & F.col("ai"), "ntai"))


def nloh(segments: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    """Long losses of heterozygosity that are not arm-level."""
    s = with_group(_autosomes(segments), ["id", "arm"], {"__arm": F.sum("width")})
    hit = (F.col("K") == 0) & (F.col("C") != 0) & ~(F.col("width") / F.col("__arm") > t.arm_share) & (_open_length() > t.loh_length)
    return s.groupBy("id").agg(_count(hit, "nloh"))


def shannon(segments: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    """Shannon diversity of the sub-clonal copy number in half-open buckets."""
    s = _autosomes(segments).filter(F.col("sC").isNotNull())
    bucket = F.when((F.col("sC") >= 0) & (F.col("sC") < t.si_max), F.floor(F.col("sC") / t.si_step))
    per = s.groupBy("id", bucket.alias("b")).agg(F.count(F.lit(1)).alias("n"))
    p = with_group(per, ["id"], {"__n": F.sum("n")}).withColumn("p", F.col("n") / F.col("__n"))
    return p.groupBy("id").agg(F.coalesce(F.sum(F.when(F.col("b").isNotNull(), -F.col("p") * F.log("p"))), F.lit(0.0)).alias("si"))


def focal_gains(segments: DataFrame, meta: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    s = segments.join(meta.select("id", "ploidy"), "id")
    hit = (F.col("width") <= t.focal_width) & (F.col("C") >= F.col("ploidy") + 0.75) & (F.col("C") >= 3)
    return s.groupBy("id").agg(_count(hit, "fg"))


def imbalance_scores(segments: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    """Imbalanced, balanced and copy-neutral LOH scores."""
    s = _imbalance(segments, None, t).filter(F.col("C").isNotNull())
    ai = F.coalesce((F.col("C") > 0) & F.col("ai"), F.lit(False))
    neutral = F.coalesce((F.col("C") == F.col("m")) & (F.col("K") == 0), F.lit(False))
    share = lambda cond: F.sum(F.when(cond, F.col("width")).otherwise(0)) / F.sum("width")
    return s.groupBy("id").agg(
        (share(ai) * F.count(F.when(ai & (F.col("width") > t.ai_length) & ~F.col("arm_level"), 1))).alias("ai_cna"),
        _count(~F.col("ai") & (F.col("width") > t.ai_length), "ab_cna"),
        (share(neutral) * F.count(F.when(neutral & (F.col("width") > t.cnloh_length), 1))).alias("cn_loh"))


def all_scores(segments: DataFrame, sizes: DataFrame, meta: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    """One row per sample with any known copy number."""
    known = segments.groupBy("id").agg(F.count("C").alias("n")).filter(F.col("n") > 0).select("id")
    out = known
    for part in (gii(segments), loh_portion(segments), lst(segments, t), ntai(segments, sizes, t), nloh(segments, t), shannon(segments, t),
                 focal_gains(segments, meta, t), imbalance_scores(segments, t)):
        out = out.join(part, "id", "left")
    return out
