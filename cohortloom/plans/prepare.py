"""Sample preparation for the copy-number model: SNPs and tiles of all samples in one graph."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.operators import tiles as T
from cohortloom.operators.variants import snp_prefilter
from cohortloom.session import cut_lineage

# Each stage joins statistics of its input back to it and so reads the input more than once; the
# per-sample tables are stored between stages.


def prepare_samples(snps: DataFrame, tiles: DataFrame, masks: Mapping[str, DataFrame], par: DataFrame, o: T.TileOptions = T.TileOptions(), min_depth: int = 6, x: str = "chrX", y: str = "chrY") -> dict[str, DataFrame]:
    """Quality flags, informative SNPs, sex and normal copies.

    ``snps``: id, chr, pos, ref, alt, qual, source, type, somatic, population_af, t_/n_ gt, af, dp.
    ``tiles``: annotated tiles with t_cov_raw and n_cov_raw.  ``masks``: loose, strict, difficult.
    """
    depths = [c for c in ("t_dp", "n_dp") if c in snps.columns]
    v = snp_prefilter(snps, min_depth, depths).withColumn("population_af", F.coalesce("population_af", F.lit(0.5)))
    v = cut_lineage(T.mask_variants(v, masks["loose"], masks["strict"], masks["difficult"]))
    paired = "n_gt" in v.columns
    v = T.pass_snps(v, tiles, "pair" if paired else "tumor", o).withColumnRenamed("pass", "t_pass")
    v = cut_lineage(v)
    v = T.pass_snps(v, tiles, "normal", o).withColumnRenamed("pass", "n_pass") if paired else v.withColumn("n_pass", F.lit(False))
    for c, t in (("n_gt", "string"), ("t_gt", "string")):
        if c not in v.columns:
            v = v.withColumn(c, F.lit(None).cast(t))
    v = cut_lineage(v)
    good = T.high_quality(tiles, o)
    sex = cut_lineage(T.detect_sex(v, good, o, x, y))
    return {"snps": v, "tiles": T.normal_copies(good, sex, par, x, y), "sex": sex}


def log_ratio(tiles: DataFrame, kind: str, sex: DataFrame | None = None, pool: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Tiles with the raw ratio ``lr`` of a kind that ``tiles.choose_ratio`` names.

    ``t_lr`` and ``n_lr`` take the coverage alone, ``tn_lr`` tumor over normal; ``tp_lr`` and ``np_lr``
    need a pool (``noise`` and ``components``): the ratio to the normal, or to the median of the pool
    of the sample's sex, without the pool's components, except on noisy tiles.
    """
    if kind in ("t_lr", "n_lr"):
        return T.raw_log_ratio(tiles.withColumn("__one", F.lit(1.0)), f"{kind[0]}_cov", "__one", "lr").drop("__one")
    if kind == "tn_lr":
        return T.raw_log_ratio(tiles, "t_cov", "n_cov", "lr")
    if pool is None or sex is None:
        raise ValueError(f"{kind} needs a pool of normals and the samples' sex")
    own = tiles if kind == "tp_lr" else tiles.withColumn("t_cov", F.col("n_cov")).withColumn("n_cov", F.lit(None).cast("double"))
    median = pool["noise"].select("pool", "chr", "start", "median")
    against = own.join(sex.select("id", F.col("sex").alias("pool")), "id").join(median, ["pool", "chr", "start"], "left").withColumn("__n", F.coalesce("n_cov", "median"))
    raw = T.raw_log_ratio(against, "t_cov", "__n", "lr").select("id", "chr", "start", "lr")
    ready = cut_lineage(raw.filter(F.col("lr").isNotNull()))
    lr = T.pooled_ratio(own, pool["noise"], T.pool_denoise(ready, pool["components"]), sex).select("id", "chr", "start", "lr")
    return tiles.join(lr, ["id", "chr", "start"], "left")


def model_input(
    prepared: Mapping[str, DataFrame], sample: str = "tumor", o: T.TileOptions = T.TileOptions(), max_snps: int | None = None,
    tumor: str = "pair", normal: str = "tumor", pool: Mapping[str, DataFrame] | None = None,
) -> dict[str, DataFrame]:
    """Centred, corrected and smoothed log-ratios, tile allele fractions and noise of one side.

    ``tumor`` ("pair", "pool", else tumor alone) and ``normal`` ("pool", else normal alone) choose the
    ratio that ``tiles.choose_ratio`` names.
    """
    pick = T.choose_ratio(sample, tumor, normal)
    t = prepared["tiles"]
    for c in ("t", "n"):
        t = T.normalise_coverage(t, f"{c}_cov_raw", f"{c}_cov") if f"{c}_cov_raw" in t.columns else t.withColumn(f"{c}_cov", F.lit(None).cast("double"))
    t = cut_lineage(T.centre_log_ratio(log_ratio(cut_lineage(t), pick["lr"], prepared["sex"], pool), "lr"))
    t = cut_lineage(T.correct_bias(t, "lr", o))
    t = cut_lineage(T.smooth_outliers(t, "lr"))
    v = prepared["snps"].filter(F.col(pick["pass"])).select("id", "chr", "pos", "qual", F.col(pick["af"]).alias("af"), F.col(pick["dp"]).alias("dp"))
    placed = cut_lineage(T.snps_to_tiles(v, t, o))
    if max_snps is not None:
        placed = T.best_snps(placed, max_snps)
    t = cut_lineage(T.smooth_outliers(cut_lineage(T.tile_baf(t, placed)), "baf"))
    stats = T.noise_sd(t.filter("hq"), "lr", out="sd_lr").join(T.noise_sd(t.filter("hq"), "baf", out="sd_baf"), "id", "full").fillna(0.0)
    return {"tiles": t, "snps": placed, "stats": stats}
