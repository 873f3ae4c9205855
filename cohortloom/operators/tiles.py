"""Coverage tiles and SNPs of samples: annotation, quality, normalisation, smoothing, sex, pool of normals.

Tile tables hold id, chr, start, end, arm, target and series columns.  A tile is identified by its
range, so per-sample series are windows over (id, arm) cut into position chunks.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.functions.numeric import log2_ratio
from cohortloom.functions.text import letter_share
from cohortloom.operators.common import first_row, join_stats, top_n, with_group
from cohortloom.operators.intervals import covered_fraction, first_overlap, overlap_flag, overlap_join, resize
from cohortloom.operators.subspace import leading_components

HETEROZYGOUS = ["0/0/0/1", "0/0/1/1", "0/1/1/1", "0/1"]  # fixed values


@dataclass(frozen=True)
class TileOptions:
    """Fixed values of the default (exome pair) settings."""

    shoulder: int = 300
    min_gap: int = 50_000
    hq_max_gap: float = 0.005
    hq_min_unmasked: float = 0.25
    hq_max_blacklist: float = 0.001
    hq_max_difficult: float = 0.3
    hq_min_coverage: float = 5000
    het_range_genome: tuple[float, float] = (0.36, 0.64)
    het_range_target: tuple[float, float] = (0.40, 0.60)
    het_min_dp_genome: int = 12
    het_min_dp_target: int = 24
    cov_min_dp_genome: int = 24
    cov_min_dp_target: int = 48
    sex_snp_ratio: float = 0.25
    sex_cov_ratio: float = 0.75
    sex_y_zero: float = 0.05
    sex_min_x_snps: int = 12
    gc_range_on: tuple[float, float] = (0.2, 0.8)
    gc_range_off: tuple[float, float] | None = None
    gc_span: float = 0.5
    gc_span_off: float | None = None
    smooth_window: int = 13


def _width() -> Column:
    return F.col("end") - F.col("start") + 1


# ---------------------------------------------------------------- annotation and quality

def annotate_tiles(tiles: DataFrame, sequences: DataFrame, blacklist: DataFrame, unmasked: DataFrame, difficult: DataFrame, cytobands: DataFrame) -> DataFrame:
    """Mask shares, GC and gap content, cytoband and arm.  ``sequences``: chr, start, seq of each tile."""
    out = covered_fraction(tiles, blacklist, "blacklist")
    out = covered_fraction(out, unmasked, "unmasked", merge=False)
    out = covered_fraction(out, difficult, "difficult")
    out = out.join(sequences.select("chr", "start", "seq"), ["chr", "start"], "left")
    out = out.withColumn("gc", letter_share(F.col("seq"), "GC")).withColumn("gap", letter_share(F.col("seq"), "N")).drop("seq")
    ranges = tiles.select("chr", "start", "end").distinct()
    band = first_overlap(ranges, cytobands.select("chr", "start", "end", "name"), ["chr", "start", "end"], ["start"])
    band = band.select("chr", "start", "end", F.col("s_name").alias("cytoband"))
    out = out.join(band, ["chr", "start", "end"], "left")
    return out.withColumn("arm", F.concat("chr", F.substring("cytoband", 1, 1)))


def high_quality(tiles: DataFrame, o: TileOptions = TileOptions()) -> DataFrame:
    depth = (F.coalesce("t_cov_raw", F.lit(0.0)) + F.coalesce("n_cov_raw", F.lit(0.0))) * _width()
    ok = (
        (F.col("gap") <= o.hq_max_gap) & (F.col("unmasked") >= o.hq_min_unmasked) & (F.col("blacklist") <= o.hq_max_blacklist)
        & (F.col("difficult") <= o.hq_max_difficult) & (depth >= o.hq_min_coverage)
    )
    return tiles.withColumn("hq", ok)


def mask_variants(snps: DataFrame, loose: DataFrame, strict: DataFrame, difficult: DataFrame) -> DataFrame:
    """Mask flags of SNPs: outside the loose or strict accessible regions, inside difficult regions."""
    out = overlap_flag(snps, loose, "mask_loose", q=("pos", "pos"))
    out = overlap_flag(out, strict, "mask_strict", q=("pos", "pos"))
    out = overlap_flag(out, difficult, "mask_difficult", q=("pos", "pos"))
    return out.withColumns({"mask_loose": ~F.col("mask_loose"), "mask_strict": ~F.col("mask_strict")})


def pass_snps(snps: DataFrame, tiles: DataFrame, mode: str, o: TileOptions = TileOptions()) -> DataFrame:
    """Add ``pass``: informative heterozygous SNPs.

    ``mode``: "pair" (tumor calls with a normal), "tumor" (tumor only) or "normal".  Depth bands are
    exact percentiles per sample and source; an undecidable row does not pass.
    """
    side = "t" if mode == "tumor" else "n"
    genome = F.col("source") == "genome"
    depth = F.col(f"{side}_dp")
    keys = ["id", "source"]
    lo = F.when(F.first("source") == "genome", F.percentile(depth, F.lit(0.05))).otherwise(F.percentile(depth, F.lit(0.01)))
    hi = F.when(F.first("source") == "genome", F.percentile(depth, F.lit(0.95))).otherwise(F.percentile(depth, F.lit(0.99)))
    out = with_group(snps, keys, {"__lo": lo, "__hi": hi})
    splash = resize(tiles.filter("target").select("id", "chr", "start", "end").distinct(), o.shoulder)
    out = overlap_flag(out, splash, "__on", keys=("id", "chr"), q=("pos", "pos"))
    pick = lambda g, t: F.when(genome, g).otherwise(t)
    af = F.col("population_af")
    common = (af > pick(0.025, 0.01)) & (af < pick(0.975, 0.99))
    covered = (depth > F.col("__lo")) & (depth < F.col("__hi")) & (depth > pick(o.cov_min_dp_genome, o.cov_min_dp_target))
    strict = F.col("mask_strict") | F.col("mask_difficult")
    base = ~F.col("somatic") & (F.col("type") == "SNV") & (depth > pick(o.het_min_dp_genome, o.het_min_dp_target))
    gt = F.col(f"{side}_gt").isin(HETEROZYGOUS)
    if mode == "pair":
        lo_af, hi_af = pick(o.het_range_genome[0], o.het_range_target[0]), pick(o.het_range_genome[1], o.het_range_target[1])
        within = lambda d: (F.col("n_af") > lo_af + d) & (F.col("n_af") < hi_af - d)
        loose = F.col("mask_loose")
        het = base & gt & common & ((~strict & ~loose & within(0.0)) | (strict & ~loose & within(0.03)) | (strict & loose & within(0.06)))
    elif mode == "normal":
        het = base & gt & common & ~strict
    else:
        het = base & ~strict & ((gt & common) | ((F.col("t_af") > 0.05) & (F.col("t_af") < 0.95)))
    ok = het & covered & (genome | F.col("__on"))
    return out.withColumn("pass", F.coalesce(ok, F.lit(False))).drop("__lo", "__hi", "__on")


# ---------------------------------------------------------------- SNPs on tiles

def snps_to_tiles(snps: DataFrame, tiles: DataFrame, o: TileOptions = TileOptions(), key: Sequence[str] = ("id", "chr", "pos")) -> DataFrame:
    """Tiles of each SNP within the shoulder, among the tiles of its own sample.

    A sample with off-target tiles has its SNPs on target tiles only, one each; a sample without
    (genome-wide) has them on every tile they reach.
    """
    sites = snps.select("id", "chr", "pos").distinct()
    hit = overlap_join(sites, tiles.select("id", "chr", "start", "end", "target").distinct(), keys=("id", "chr"), q=("pos", "pos"), maxgap=o.shoulder - 1)
    panel = tiles.groupBy("id").agg(F.coalesce(F.bool_or(~F.col("target")), F.lit(False)).alias("__off"))
    hit = hit.join(panel, "id").filter(~F.col("__off") | F.col("s_target"))
    one = first_row(hit.filter("__off"), ["id", "chr", "pos"], [F.col("s_start").asc(), F.col("s_end").asc()])
    placed = one.unionByName(hit.filter(~F.col("__off"))).select("id", "chr", "pos", F.col("s_start").alias("start"), F.col("s_end").alias("end"))
    return snps.join(placed, ["id", "chr", "pos"])


def tile_baf(tiles: DataFrame, placed: DataFrame) -> DataFrame:
    """Minor-allele share, depth and SNP count of each tile; NULL and 0 where there is no SNP."""
    minor = F.round(F.when(F.col("af") < 0.5, F.col("af")).otherwise(1 - F.col("af")) * F.col("dp"))
    agg = placed.groupBy("id", "chr", "start", "end").agg((F.sum(minor) / F.sum("dp")).alias("baf"), F.sum("dp").alias("baf_depth"), F.count("af").cast("int").alias("baf_n"))
    out = tiles.join(agg, ["id", "chr", "start", "end"], "left")
    return out.withColumn("baf_n", F.coalesce("baf_n", F.lit(0)))


def best_snps(placed: DataFrame, n: int) -> DataFrame:
    """At most ``n`` SNPs of each tile by quality (a user setting; unlimited by default)."""
    return top_n(placed, ["id", "chr", "start"], [F.col("qual").desc_nulls_last(), F.col("pos").asc()], n)


# ---------------------------------------------------------------- sex

def detect_sex(snps: DataFrame, tiles: DataFrame, o: TileOptions = TileOptions(), x: str = "chrX", y: str = "chrY") -> DataFrame:
    """Sex of each sample by the best evidence it has.

    In order: het SNP density of X in the normal, X coverage in the normal, SNP density in the
    tumor, Y coverage in the tumor.
    """
    on_x, auto = F.col("chr") == x, ~F.col("chr").isin(x, y)
    n = lambda cond: F.count(F.when(cond, 1))
    sel_n = F.col("n_gt").isin("0/0/1/1", "0/1") & F.col("n_pass")
    sel_t = F.col("t_gt").isin(HETEROZYGOUS) & F.col("t_pass")
    s = snps.groupBy("id").agg(
        n(F.col("n_gt").isNotNull()).alias("has_n"), n(F.col("t_gt").isNotNull()).alias("has_t"), n(F.col("n_pass") & on_x).alias("x_n"), n(F.col("t_pass") & on_x).alias("x_t"),
        n(sel_n & on_x).alias("nx"), n(sel_n & auto).alias("na"), n(sel_t & on_x).alias("tx"), n(sel_t & auto).alias("ta"))
    clean = (F.col("blacklist") == 0) & F.col("target")
    med = lambda cond, c: F.median(F.when(clean & cond, F.col(c)))
    t = tiles.groupBy("id").agg(
        n(F.col("target") & on_x).alias("tile_x"), n(F.col("target") & auto).alias("tile_a"), med(on_x, "n_cov_raw").alias("cov_x"), med(auto, "n_cov_raw").alias("cov_a"),
        med(F.col("chr") == y, "t_cov_raw").alias("cov_y"), F.count("n_cov_raw").alias("has_cov"))
    j = t.join(s, "id", "left")
    ratio = lambda a, b: F.when(b != 0, a / b)
    density = lambda sx, sa: ratio(ratio(F.col(sx), F.col("tile_x")), ratio(F.col(sa), F.col("tile_a")))
    sexed = lambda female: F.when(female, "female").when(~female, "male")
    sex = (
        F.when((F.col("has_n") > 0) & (F.col("x_n") > o.sex_min_x_snps), sexed(density("nx", "na") > o.sex_snp_ratio))
        .when(F.col("has_cov") > 0, sexed(ratio(F.col("cov_x"), F.col("cov_a")) > o.sex_cov_ratio))
        .when((F.col("has_t") > 0) & (F.col("x_t") > o.sex_min_x_snps), sexed(density("tx", "ta") > o.sex_snp_ratio))
        .otherwise(sexed(F.col("cov_y") < o.sex_y_zero))
    )
    return j.select("id", sex.alias("sex"))


def normal_copies(tiles: DataFrame, sex: DataFrame, par: DataFrame, x: str = "chrX", y: str = "chrY") -> DataFrame:
    """Expected copies of each tile in a normal cell; the pseudo-autosomal part of X stays diploid."""
    out = overlap_flag(tiles, par, "__par").join(sex.select("id", F.col("sex").alias("__sex")), "id", "left")
    male = F.col("__sex") == "male"
    nc = (
        F.when((F.col("chr") == x) & ~F.col("__par"), F.when(male, 1).otherwise(2)).when(F.col("chr") == y, F.when(male, 1).otherwise(0)).otherwise(2)
    )
    return out.withColumn("nC", nc).drop("__par", "__sex")


def coverage_sex(contigs: DataFrame, x: str = "chrX", y: str = "chrY") -> DataFrame:
    """XX / XY from reads per base of X and Y (id, chr, length, reads)."""
    cov = lambda c: F.max(F.when(F.col("chr") == c, F.col("reads") / F.col("length")))
    r = contigs.groupBy("id").agg((cov(x) / F.nullif(cov(y), F.lit(0.0))).alias("ratio"))
    return r.withColumn("sex", F.when(F.col("ratio") > 3, "XX").when(F.col("ratio") < 1.5, "XY"))


# ---------------------------------------------------------------- coverage and log-ratio

def normalise_coverage(tiles: DataFrame, cov: str, out: str) -> DataFrame:
    """On- and off-target coverage each scaled to one million, per kilobase."""
    t = with_group(tiles, ["id", "target"], {"__t": F.sum(F.col(cov) * _width())})
    return t.withColumn(out, 1000 * (F.col(cov) * _width()) / (F.col("__t") / 1e6) / _width()).drop("__t")


def raw_log_ratio(tiles: DataFrame, a: str, b: str, out: str) -> DataFrame:
    return tiles.withColumn(out, log2_ratio(F.col(a), F.col(b)))


def centre_log_ratio(tiles: DataFrame, lr: str) -> DataFrame:
    """Subtract the width-weighted mean of high-quality tiles, per target class."""
    good = F.col("hq") & F.col(lr).isNotNull()
    t = with_group(tiles, ["id", "target"], {"__m": F.sum(F.when(good, F.col(lr) * _width())) / F.sum(F.when(good, _width()))})
    return t.withColumn(lr, F.col(lr) - F.col("__m")).drop("__m")


def choose_ratio(sample: str, tumor: str = "pair", normal: str = "pool") -> dict[str, str]:
    """Column names of a sample's log-ratio, allele fraction, depth and pass flag."""
    if sample == "tumor":
        lr = {"pool": "tp_lr", "pair": "tn_lr"}.get(tumor, "t_lr")
        return {"lr": lr, "af": "t_af", "dp": "t_dp", "pass": "t_pass"}
    return {"lr": "np_lr" if normal == "pool" else "n_lr", "af": "n_af", "dp": "n_dp", "pass": "n_pass"}


def gc_curve(tiles: DataFrame, lr: str, bias: str = "gc", span: float = 0.5, bins: int = 200) -> DataFrame:
    """Local linear trend of ``lr`` over the bias variable, per (id, target).

    Two levels: tiles are averaged into fixed bias bins (bounded by ``bins`` per group whatever the
    tile number), then each bin gets a tricube-weighted linear fit over the nearest ``span`` of the
    weight.  The fit is closed-form sums over pairs of bins.  It uses high-quality tiles, and is
    evaluated at the bins of all tiles.
    """
    keys = ["id", "target"]
    b = F.least(F.floor(F.col(bias) * bins), F.lit(bins - 1)).cast("int")
    fits = F.col("hq") & F.col(lr).isNotNull()
    known = tiles.filter(F.col(bias).isNotNull())
    at = known.groupBy(*keys, b.alias("bin")).agg(F.coalesce(F.avg(F.when(fits, F.col(bias))), F.avg(bias)).alias("x"))
    pts = known.filter(fits).groupBy(*keys, b.alias("bin")).agg(F.avg(bias).alias("x"), F.avg(lr).alias("y"), F.count(F.lit(1)).cast("double").alias("w"))
    # At most `bins` points per group: the pairs are bounded by bins squared.
    other = pts.select(*[F.col(k).alias(f"o_{k}") for k in keys], F.col("x").alias("ox"), F.col("y").alias("oy"), F.col("w").alias("ow"))
    cond = (F.col("id") == F.col("o_id")) & (F.col("target") == F.col("o_target"))
    pair = at.join(other, cond).withColumn("d", F.abs(F.col("ox") - F.col("x")))
    near = Window.partitionBy(*keys, "bin").orderBy("d", "ox")
    cum = pair.withColumn("__c", F.sum("ow").over(near.rowsBetween(Window.unboundedPreceding, -1))).withColumn("__t", F.sum("ow").over(Window.partitionBy(*keys, "bin")))
    inside = cum.filter(F.coalesce(F.col("__c"), F.lit(0.0)) < F.col("__t") * span)
    h = with_group(inside, [*keys, "bin"], {"__h": F.max("d")})
    k = F.when(F.col("__h") > 0, F.pow(1 - F.pow(F.least(F.col("d") / (F.col("__h") * 1.000001), F.lit(1.0)), 3), 3)).otherwise(1.0)
    ww = F.col("ow") * k
    dx = F.col("ox") - F.col("x")
    s = h.withColumn("__k", ww).groupBy(*keys, "bin").agg(
        F.sum("__k").alias("s0"), F.sum(F.col("__k") * dx).alias("s1"), F.sum(F.col("__k") * dx * dx).alias("s2"), F.sum(F.col("__k") * F.col("oy")).alias("t0"), F.sum(F.col("__k") * dx * F.col("oy")).alias("t1"))
    det = F.col("s0") * F.col("s2") - F.col("s1") * F.col("s1")
    fit = F.when(F.abs(det) > 1e-12, (F.col("s2") * F.col("t0") - F.col("s1") * F.col("t1")) / det).otherwise(F.col("t0") / F.col("s0"))
    return s.select(*keys, "bin", fit.alias("trend"))


def correct_bias(tiles: DataFrame, lr: str, o: TileOptions = TileOptions(), bias: str = "gc", offset: bool = True, bins: int = 200) -> DataFrame:
    """Residual of ``lr`` over the bias trend where the bias value is in range, on and off target apart.

    A group without high-quality tiles has no trend and stays as it is.

    The trend is evaluated per bin of the bias variable (an approximation of a full local
    regression; the error is the trend's change within one bin).
    """
    spans = {True: o.gc_span, False: o.gc_span_off}
    curves = [gc_curve(tiles.filter(F.col("target") == on), lr, bias, span, bins) for on, span in spans.items() if span is not None]
    curve = reduce(DataFrame.unionByName, curves)
    b = F.least(F.floor(F.col(bias) * bins), F.lit(bins - 1)).cast("int")
    out = tiles.withColumn("bin", b).join(curve, ["id", "target", "bin"], "left").withColumn("__r", F.col(lr) - F.col("trend"))
    if offset:
        out = with_group(out, ["id", "target"], {"__off": F.avg(F.when(F.col("hq"), F.col("__r")))})
        out = out.withColumn("__r", F.col("__r") - F.col("__off")).drop("__off")
    between = lambda r: (F.col(bias) > r[0]) & (F.col(bias) < r[1]) if r else F.lit(False)
    usable = F.when(F.col("target"), between(o.gc_range_on)).otherwise(between(o.gc_range_off)) & F.col("trend").isNotNull()
    return out.withColumn(lr, F.when(F.coalesce(usable, F.lit(False)), F.col("__r")).otherwise(F.col(lr))).drop("bin", "trend", "__r")


def _middle(ordered: Column) -> Column:
    """Median of a short sorted array."""
    n = F.size(ordered)
    at = lambda i: F.element_at(ordered, i.cast("int"))
    return (at(F.floor((n + 1) / 2)) + at(F.floor(n / 2) + 1)) / 2


def smooth_outliers(tiles: DataFrame, column: str, k: int = 10, far: float = 4.0, near: float = 2.0) -> DataFrame:
    """Pull single outliers back to their neighbourhood.

    A value beyond ``far`` noise units of all neighbours within ``k`` tiles moves to the
    neighbourhood median plus or minus ``near`` units.  The noise unit is the robust sd of first
    differences; on- and off-target tiles are smoothed apart.
    """
    keys = ["id", "arm", "target"]
    noise = noise_sd(tiles, column, ["id", "target"], "__sd")
    live = tiles.filter(F.col(column).isNotNull())
    w = Window.partitionBy(*keys).orderBy("start")
    around = w.rowsBetween(-k, k)
    before, after = w.rowsBetween(-k, -1), w.rowsBetween(1, k)
    x = F.col(column)
    s = join_stats(live, noise, ["id", "target"]).select(
        "id", "chr", "start", "target", x.alias("__x"), "__sd", _middle(F.array_sort(F.collect_list(x).over(around))).alias("__med"), F.greatest(F.max(x).over(before), F.max(x).over(after)).alias("__hi"),
        F.least(F.min(x).over(before), F.min(x).over(after)).alias("__lo"))
    v = F.col("__x")
    new = (
        F.when(v > F.col("__hi") + far * F.col("__sd"), F.col("__med") + near * F.col("__sd"))
        .when(v < F.col("__lo") - far * F.col("__sd"), F.col("__med") - near * F.col("__sd")).otherwise(v)
    )
    return tiles.join(s.select("id", "chr", "start", "target", new.alias("__new")), ["id", "chr", "start", "target"], "left").withColumn(column, F.col("__new")).drop("__new")


def smooth_hybrid(tiles: DataFrame, column: str, window: int = 13, keys: Sequence[str] = ("id", "arm")) -> DataFrame:
    """Median of the left mean, the centre value and the right mean; short series stay as they are."""
    half = window // 2
    w = Window.partitionBy(*keys).orderBy("start")
    left, right = F.avg(column).over(w.rowsBetween(-half, -1)), F.avg(column).over(w.rowsBetween(1, half))
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    mid = F.element_at(F.array_sort(F.array(left, F.col(column), right)), 2)
    full = (F.row_number().over(w) > half) & (F.row_number().over(w) <= n - half)
    return tiles.withColumn(column, F.when((n >= window) & full, mid).otherwise(F.col(column)))


def noise_sd(tiles: DataFrame, column: str, keys: Sequence[str] = ("id",), out: str = "sd", min_points: int = 3) -> DataFrame:
    """Robust noise sd from first differences along the genome: MAD of differences over sqrt(2)."""
    live = tiles.filter(F.col(column).isNotNull())
    order = Window.partitionBy(*dict.fromkeys([*keys, "id", "chr"])).orderBy("start")
    d = live.withColumn("__d", F.lead(column).over(order) - F.col(column)).filter(F.col("__d").isNotNull())
    m = with_group(d.select(*keys, "__d"), keys, {"__m": F.median("__d")})
    return m.groupBy(*keys).agg(
        F.when(F.count(F.lit(1)) >= min_points, 1.4826 * F.median(F.abs(F.col("__d") - F.col("__m"))) / F.sqrt(F.lit(2.0))).otherwise(0.0).alias(out))


# ---------------------------------------------------------------- pool of normals

def pool_noise(cov: DataFrame) -> DataFrame:
    """Per tile and sex over the normals: sd, median, MAD and share of zeros.

    ``cov``: id, chr, start, sex, sex_chr, value.  On sex chromosomes only samples of that sex count.
    """
    both = cov.withColumn("pool", F.explode(F.array(F.lit("male"), F.lit("female")))).filter(~F.col("sex_chr") | (F.col("sex") == F.col("pool")))
    keys = ["pool", "chr", "start"]
    m = with_group(both.select(*keys, "value"), keys, {"__m": F.median("value")})
    return m.groupBy(*keys).agg(
        F.stddev_samp("value").alias("sd"), F.max("__m").alias("median"), (1.4826 * F.median(F.abs(F.col("value") - F.col("__m")))).alias("mad"), F.avg((F.col("value") == 0).cast("double")).alias("zero_rate"))


def pool_filter(noise: DataFrame, tiles: DataFrame, hi_zero: float = 0.20, hi_noise: float = 0.95, enabled: bool = True) -> DataFrame:
    """Tiles fit for the statistical pool: on target, rarely zero, variable, quiet, high quality.

    The noise threshold is a percentile over autosomal tiles of the male pool.  Disabled, every
    target tile is kept.
    """
    t = noise.join(tiles.select("chr", "start", "target", "hq", "sex_chr").distinct(), ["chr", "start"])
    if not enabled:
        return t.withColumn("keep", F.col("target"))
    limit = t.filter((F.col("pool") == "male") & ~F.col("sex_chr")).agg(F.percentile("sd", F.lit(hi_noise))).scalar()
    ok = F.col("target") & (F.col("zero_rate") < hi_zero) & (F.col("mad") != 0) & (F.col("sd") < F.col("__lim")) & F.col("hq")
    return t.withColumn("__lim", limit).withColumn("keep", F.coalesce(ok, F.lit(False))).drop("__lim")


def sex_coverage_ratio(cov: DataFrame, tiles: DataFrame) -> DataFrame:
    """Male over female mean coverage of good autosomal targets (one row); 1 in a single-sex pool."""
    good = cov.filter(~F.col("sex_chr")).join(tiles.filter("hq and target").select("chr", "start").distinct(), ["chr", "start"], "left_semi")
    m = lambda s: F.avg(F.when(F.col("sex") == s, F.col("value")))
    return good.agg(F.coalesce(m("male") / m("female"), F.lit(1.0)).alias("ratio"))


def clamp_outliers(cov: DataFrame, noise: DataFrame, sd: float = 3.0) -> DataFrame:
    """Values beyond ``sd`` MADs of the tile median take the tile's lowest or highest inlier."""
    keys = ["chr", "start", "pool"]
    both = cov.withColumn("pool", F.explode(F.array(F.lit("male"), F.lit("female")))).join(noise.select(*keys, "median", "mad"), keys)
    z = (F.col("value") - F.col("median")) / F.nullif(F.col("mad"), F.lit(0.0))
    # The upper bound is taken after low outliers were replaced, as the order of the two clamps matters.
    ok_low, ok_high = F.coalesce(z >= -sd, F.lit(True)), F.coalesce(z <= sd, F.lit(True))
    e = with_group(both.withColumn("__z", z), keys, {"__min": F.min(F.when(ok_low, F.col("value"))), "__max": F.max(F.when(ok_high, F.col("value")))})
    zz = F.col("__z")
    out = F.when(zz < -sd, F.col("__min")).when(zz > sd, F.col("__max")).otherwise(F.col("value"))
    own = ~F.col("sex_chr") | (F.col("sex") == F.col("pool"))
    return e.withColumn("value", F.when(own, out)).drop("__min", "__max", "__z", "median", "mad")


def pool_log_ratio(cov: DataFrame, centre: bool = True) -> DataFrame:
    """log2 of value over the tile median, bounded to finite values within [-4, 4], centred by sample and chromosome.

    ``cov``: pool, chr, start, id, value.
    """
    m = with_group(cov, ["pool", "chr", "start"], {"__m": F.median("value")})
    lr = m.withColumn("__lr", log2_ratio(F.col("value"), F.col("__m")))
    lim = with_group(lr, ["pool"], {"__lo": F.greatest(F.min("__lr"), F.lit(-4.0)), "__hi": F.least(F.max("__lr"), F.lit(4.0))})
    v = (
        F.when(F.col("value").isNull() | F.col("__m").isNull() | ((F.col("value") == 0) & (F.col("__m") == 0)), 0.0).when(F.col("value") == 0, F.col("__lo")).when(F.col("__m") == 0, F.col("__hi"))
        .otherwise(F.greatest(F.least("__lr", "__hi"), F.col("__lo")))
    )
    out = lim.withColumn("lr", v).drop("__lr", "__lo", "__hi", "__m")
    if not centre:
        return out
    c = with_group(out, ["pool", "id", "chr"], {"__c": F.median("lr")})
    return c.withColumn("lr", F.col("lr") - F.col("__c")).drop("__c")


def pool_components(lr: DataFrame, n: int = 20, tol: float = 1e-10) -> DataFrame:
    """First ``n`` left singular vectors of the tiles x normals matrix, long form (chr, start, comp, u).

    Any number of normals: block Krylov steps over the cells, see ``subspace``.
    """
    return leading_components(lr, ["chr", "start"], "id", "lr", n, tol)


def pool_denoise(lr: DataFrame, components: DataFrame) -> DataFrame:
    """x - U U'x for every sample: one join and two sums."""
    j = lr.join(components, ["chr", "start"])
    score = j.groupBy("id", "comp").agg(F.sum(F.col("lr") * F.col("u")).alias("s"))
    back = j.join(score, ["id", "comp"]).groupBy("id", "chr", "start").agg(F.sum(F.col("s") * F.col("u")).alias("__fit"))
    return lr.join(back, ["id", "chr", "start"], "left").withColumn("lr", F.col("lr") - F.coalesce("__fit", F.lit(0.0))).drop("__fit")


def pooled_ratio(tiles: DataFrame, noise: DataFrame, denoised: DataFrame, sex: DataFrame, hi_noise: float = 0.95) -> DataFrame:
    """Denoised ratio, except on noisy tiles, which use the ratio to the normal or the pool median."""
    auto = noise.filter((F.col("pool") == "male") & ~F.col("sex_chr"))
    limit = auto.agg(F.percentile("sd", F.lit(hi_noise))).scalar()
    t = tiles.join(sex.select("id", F.col("sex").alias("pool")), "id").join(noise.select("pool", "chr", "start", "sd", "median"), ["pool", "chr", "start"], "left")
    t = t.join(denoised.select("id", "chr", "start", F.col("lr").alias("__pool")), ["id", "chr", "start"], "left").withColumn("__lim", limit)
    pair = log2_ratio(F.col("t_cov"), F.coalesce("n_cov", "median"))
    lr = F.when(F.col("sd") > F.col("__lim"), pair).otherwise(F.col("__pool"))
    return t.withColumn("lr", F.coalesce(lr, pair)).drop("__pool", "__lim", "sd", "median", "pool")
