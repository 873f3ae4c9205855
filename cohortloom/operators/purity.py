"""Cancer-cell fraction, multiplicity and purity from variants on copy-number segments."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.functions.numeric import beta_log_kernel, cancer_cell_fraction, purity_from_fraction
from cohortloom.operators.common import first_row, join_stats, with_group
from cohortloom.operators.copynumber import SEX_CHROMOSOMES
from cohortloom.operators.intervals import first_overlap, nearest
from cohortloom.session import cut_lineage

MAX_DEPTH = 300  # fixed value: effective depth of the allele-fraction model


def segment_of_sites(variants: DataFrame, segments: DataFrame) -> DataFrame:
    """The segment of the same sample at each distinct variant position."""
    fields = [f for f in ("C", "K", "lr", "nlr", "sC", "nC", "seg") if f in segments.columns]
    site = variants.select("id", "chr", "pos").distinct()
    hit = first_overlap(site, segments.select("id", "chr", "start", "end", *fields), ["id", "chr", "pos"], ["start"], keys=("id", "chr"), q=("pos", "pos"))
    return hit.select("id", "chr", "pos", *[F.col(f"s_{f}").alias(f) for f in fields])


def variants_on_segments(variants: DataFrame, segments: DataFrame, meta: DataFrame, keep_all: bool = True, sites: DataFrame | None = None) -> DataFrame:
    """Variants with the segment of the same sample they lie on, and purity and ploidy."""
    hit = segment_of_sites(variants, segments) if sites is None else sites
    out = variants.join(hit, ["id", "chr", "pos"], "left" if keep_all else "inner")
    return out.join(meta.select("id", "purity", "ploidy"), "id", "left")


def cell_fractions(variants: DataFrame, segments: DataFrame, meta: DataFrame, max_depth: int = MAX_DEPTH) -> DataFrame:
    """Multiplicity ``m`` (most likely number of mutated copies given C) and ``ccf`` of each variant.

    The Beta likelihood of a variant has one peak, where the expected fraction equals the observed
    one, and the expected fraction grows with m.  So the best whole m in 1..C is one of the two
    neighbours of the peak; no grid of copies is built.
    """
    # The positions' segments are stored once: the variants and the samples' sex both come from them.
    sites = cut_lineage(segment_of_sites(variants, segments))
    v = variants_on_segments(variants.drop("m", "ccf"), segments, meta, sites=sites)
    male = sites.groupBy("id").agg(F.coalesce(F.bool_or(F.col("nC") == 1), F.lit(False)).alias("__male"))
    v = v.join(male, "id", "left")
    sex_copies = F.when(F.col("chr").isin(SEX_CHROMOSOMES) & F.col("__male"), 1.0).otherwise(2.0)
    p, c = F.col("purity"), F.col("C")
    n = F.least(F.col("dpt"), F.lit(max_depth))
    total = p * c + sex_copies * (1 - p)
    peak = F.col("aft") * total / F.nullif(p, F.lit(0.0))
    low = F.greatest(F.least(F.floor(peak).cast("double"), c), F.lit(1.0))
    v = v.withColumns({"__t": total, "__a": F.col("aft") * n + 1, "__b": (1 - F.col("aft")) * n + 1, "__lo": F.when(peak.isNotNull() & (c >= 1), low)})

    def kernel(m):
        ef = p * m / F.col("__t")
        # At a fraction of one the likelihood is zero unless every read is mutated.
        edge = F.when(F.col("__b") == 1, F.lit(0.0)).otherwise(F.lit(float("-inf")))
        return F.when(ef < 1, beta_log_kernel(ef, F.col("__a"), F.col("__b"))).otherwise(edge)

    high = F.least(F.col("__lo") + 1, c)
    v = v.withColumn("m", F.when(kernel(high) > kernel(F.col("__lo")), high).otherwise(F.col("__lo")).cast("int"))
    v = v.withColumn("ccf", cancer_cell_fraction(F.col("aft"), p, c, F.col("nC"), F.col("m")))
    return v.drop("__male", "__t", "__a", "__b", "__lo")


def quick_cell_fractions(variants: DataFrame, segments: DataFrame, meta: DataFrame) -> DataFrame:
    """Closed form: u = (reads/depth)/purity * (purity C + (1-purity) nC), m = max(1, round(u)), ccf = u/m."""
    v = variants_on_segments(variants.drop("m", "ccf"), segments, meta)
    u = (F.col("adt") / F.col("dpt")) / F.col("purity") * (F.col("purity") * F.col("C") + (1 - F.col("purity")) * F.col("nC"))
    return v.withColumn("__u", u).withColumn("m", F.when(F.col("__u").isNotNull(), F.greatest(F.lit(1.0), F.round("__u")))).withColumn("ccf", F.col("__u") / F.col("m")).drop("__u")


def variants_near_segments(variants: DataFrame, segments: DataFrame, meta: DataFrame) -> DataFrame:
    """Nearest segment of the same sample for each variant position."""
    site = variants.select("id", "chr", "pos").distinct()
    s = segments.select("id", "chr", "start", "end", "C", "K", "sC", "nC")
    near = nearest(site, s, keys=("id", "chr"), point_key=["id", "chr", "pos"], prefix="n_")
    near = near.select("id", "chr", "pos", *[F.col(f"n_{c}").alias(c) for c in ("C", "K", "sC", "nC")])
    return variants.join(near, ["id", "chr", "pos"]).join(meta.select("id", "purity", "ploidy"), "id", "left")


def half_sample_mode(df: DataFrame, value: str, keys: list[str], out: str = "mode") -> DataFrame:
    """Mean of the values inside the narrowest interval holding half of them.

    Equal values are counted first.  The ordered step uses ranks: an interval starting at rank r
    ends at rank r + ceil(n/2) - 1, found by a join on the rank, not by a long window frame.
    """
    n = with_group(df.filter(F.col(value).isNotNull()).select(*keys, F.col(value).alias("__x")), keys, {"__n": F.count(F.lit(1))})
    d = n.groupBy(*keys, "__n", "__x").agg(F.count(F.lit(1)).alias("__k"))
    w = Window.partitionBy(*keys).orderBy("__x").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    d = d.withColumn("__hi", F.sum("__k").over(w)).withColumn("__lo", F.col("__hi") - F.col("__k") + 1).withColumn("__sum", F.sum(F.col("__x") * F.col("__k")).over(w))
    half = F.ceil(F.col("__n") / 2).cast("bigint")
    a = d.withColumn("__end", F.col("__lo") + half - 1).withColumn("__b", F.floor(F.col("__end") / 64)).filter(F.col("__end") <= F.col("__n"))
    # Candidate ends: the distinct value whose rank range holds the end rank.
    e = d.select(*[F.col(k).alias(f"e_{k}") for k in keys], F.col("__x").alias("e_x"), F.col("__lo").alias("e_lo"), F.col("__hi").alias("e_hi"), F.col("__sum").alias("e_sum"))
    e = e.withColumn("e_b", F.explode(F.sequence(F.floor(F.col("e_lo") / 64), F.floor(F.col("e_hi") / 64))))
    cond = (F.col("__b") == F.col("e_b")) & F.col("__end").between(F.col("e_lo"), F.col("e_hi"))
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"e_{k}"))
    j = a.join(e, cond).withColumn("__w", F.col("e_x") - F.col("__x"))
    # Mean of the half sample: all values from the start rank to the end rank.
    total = F.col("e_sum") - (F.col("e_hi") - F.col("__end")) * F.col("e_x") - (F.col("__sum") - F.col("__k") * F.col("__x"))
    best = first_row(j.withColumn("__mean", total / half), keys, [F.col("__w").asc(), F.col("__x").asc()])
    return best.select(*keys, F.col("__mean").alias(out))


def purity_from_variants(variants: DataFrame, cut: float | None = None) -> DataFrame:
    """Purity of each sample from the modal allele fraction of its clonal variants.

    ``cut`` drops sub-clonal fractions at or below it; without it, variants under the sample's mean
    are dropped.
    """
    v = variants.filter(F.col("aft").isNotNull()).select("id", "aft")
    if cut is not None:
        kept = v.filter(F.col("aft") > cut)
    else:
        kept = with_group(v, ["id"], {"__m": F.avg("aft")}).filter(F.col("aft") >= F.col("__m"))
    mode = half_sample_mode(kept, "aft", ["id"], "mode")
    out = mode.withColumn("purity", purity_from_fraction(F.col("mode")))
    return variants.select("id").distinct().join(out, "id", "left")
