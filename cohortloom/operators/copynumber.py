"""Copy-number tables: genes, arms, chromosomes, cohort bins, blocks, segment summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.operators.common import first_row, grid, join_stats, later_wins, runs, scan, with_group
from cohortloom.operators.intervals import first_overlap, largest_overlap, overlap_join, overlap_width, tile_sequences
from cohortloom.session import cut_lineage

SEX_CHROMOSOMES = ["chrX", "chrY"]


# ---------------------------------------------------------------- weighted statistics

def weighted_median(df: DataFrame, keys: Sequence[str], value: str, weight: str, out: str = "weighted_median") -> DataFrame:
    """Weighted median per key group.

    Weights are first added up per distinct value (a partial aggregate), so the ordered step sees
    distinct values only.  When half the weight is reached exactly between two values, their mean.
    """
    w = df.filter(F.col(value).isNotNull() & (F.col(weight) > 0)).groupBy(*keys, F.col(value).alias("__x")).agg(F.sum(weight).alias("__w"))
    by = Window.partitionBy(*keys)
    run = by.orderBy("__x").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    c = w.withColumn("__half", F.sum("__w").over(by) / 2).withColumn("__c", F.sum("__w").over(run))
    low = F.min(F.when(F.col("__c") >= F.col("__half"), F.col("__x")))
    high = F.min(F.when(F.col("__c") > F.col("__half"), F.col("__x")))
    return c.groupBy(*keys).agg(((low + high) / 2).alias(out))


def modal_value(df: DataFrame, keys: Sequence[str], value: str, out: str = "mode") -> DataFrame:
    """Most frequent value; the mean of all of them on a tie."""
    n = df.filter(F.col(value).isNotNull()).groupBy(*keys, F.col(value).alias("__x")).agg(F.count(F.lit(1)).alias("__n"))
    top = with_group(n, list(keys), {"__top": F.max("__n")})
    return top.filter(F.col("__n") == F.col("__top")).groupBy(*keys).agg(F.avg("__x").alias(out))


# ---------------------------------------------------------------- genes

def clip_genes(genes: DataFrame, tiles: DataFrame) -> DataFrame:
    """Cut each gene to its first and last overlapping target tile; genes without one stay whole."""
    hit = overlap_join(genes.select("chr", "start", "end", "gene_id"), tiles.filter("target").select("chr", "start", "end"), minoverlap=1)
    edge = hit.groupBy("gene_id").agg(F.min("s_start").alias("__a"), F.max("s_end").alias("__b"))
    out = join_stats(genes, edge, ["gene_id"])
    return out.withColumn("start", F.greatest("start", "__a")).withColumn("end", F.least("end", "__b")).drop("__a", "__b")


def gene_copies(segments: DataFrame, genes: DataFrame, keep_all: bool = True) -> DataFrame:
    """Copy number of every gene and sample over the segments it overlaps.

    K counts as 0 where C is 0 or 1.  With ``keep_all`` genes without a segment are present with NULLs.
    """
    s = segments.select("id", "chr", "start", "end", "C", "K", "sC")
    g = genes.select("chr", "start", "end", "gene_id", "gene_name")
    k = F.when(F.col("s_C").isin(0.0, 1.0), F.lit(0.0)).otherwise(F.col("s_K"))
    pairs = overlap_join(g, s).withColumn("__k", k)
    agg = pairs.groupBy(F.col("s_id").alias("id"), "gene_id").agg(
        F.count(F.lit(1)).cast("int").alias("nseg"), F.min("__k").alias("Kmin"), F.max("__k").alias("Kmax"),
        F.min("s_C").alias("Cmin"), F.max("s_C").alias("Cmax"), F.avg("s_sC").alias("Csub"))
    if not keep_all:
        return agg.join(g, "gene_id")
    cells = grid(segments.select("id").distinct(), g)
    return cells.join(agg, ["id", "gene_id"], "left")


def segment_gene_map(segments: DataFrame, genes: DataFrame) -> DataFrame:
    hit = overlap_join(segments.select("id", "var_id", "chr", "start", "end"), genes.select("chr", "start", "end", "gene_id"))
    return hit.select("id", "var_id", F.col("s_gene_id").alias("gene_id"))


def best_gene_segment(segments: DataFrame, genes: DataFrame) -> DataFrame:
    """The most telling segment of each (sample, gene): deletions, then losses, LOH, then high copies."""
    s = segments.select("id", "chr", "start", "end", "seg", "C", "K", F.round("sC", 4).alias("sC"), F.round("lr", 4).alias("lr"))
    hit = overlap_join(genes.select("chr", "start", "end", "gene_id"), s)
    order = [(F.col("s_C") != 0).asc_nulls_last(), (F.col("s_C") != 1).asc_nulls_last(), (F.col("s_K") != 0).asc_nulls_last(),
             F.col("s_C").desc_nulls_last(), F.col("s_seg").asc(), F.col("s_start").asc()]
    best = first_row(hit, ["s_id", "gene_id"], order)
    return best.select(F.col("s_id").alias("id"), "gene_id", *[F.col(f"s_{c}").alias(c) for c in ("seg", "C", "K", "sC", "lr")])


def all_gene_segments(segments: DataFrame, genes: DataFrame) -> DataFrame:
    """Every (sample, gene, segment) overlap."""
    s = segments.select("id", "chr", "start", "end", "seg", "C", "K", F.round("sC", 4).alias("sC"), F.round("lr", 4).alias("lr"))
    hit = overlap_join(genes.select("chr", "start", "end", "gene_id"), s)
    return hit.select(F.col("s_id").alias("id"), "gene_id", *[F.col(f"s_{c}").alias(c) for c in ("seg", "C", "K", "sC", "lr")])


def gene_tile_states(tiles: DataFrame, genes: DataFrame) -> DataFrame:
    """Distinct (C, K) of a gene's tiles; the normal state is dropped for genes that have another."""
    hit = overlap_join(tiles.select("id", "chr", "start", "end", "C", "K"), genes.select("chr", "start", "end", "gene_id"))
    states = hit.select("id", F.col("s_gene_id").alias("gene_id"), "C", "K").distinct()
    n = with_group(states, ["id", "gene_id"], {"__n": F.count(F.lit(1))})
    dull = (F.col("__n") > 1) & F.coalesce((F.col("C") == 2) & (F.col("K") == 1), F.lit(False))
    return n.filter(~dull).drop("__n")


def promoter_preferred(features: DataFrame, ref: DataFrame, payload: Sequence[str], key: Sequence[str]) -> DataFrame:
    """Reference row at the first base of each stranded feature, else the first one over its body, else NULLs."""
    f = features.withColumn("__p", F.when(F.col("strand") == "-", F.col("end")).otherwise(F.col("start")))
    cols = ["chr", "start", "end", *payload]
    r = ref.select(*cols)
    pick = lambda q: first_overlap(f.select(*key, *[c for c in ("chr", "start", "end", "__p") if c not in key]), r, key, ["start", "end"], q=q).select(
        *key, F.struct(*[F.col(f"s_{c}").alias(c) for c in payload]).alias("__hit"))
    prom, body = pick(("__p", "__p")), pick(("start", "end"))
    out = join_stats(features, prom.withColumnRenamed("__hit", "__a"), list(key))
    out = join_stats(out, body.withColumnRenamed("__hit", "__b"), list(key))
    return out.withColumn("__h", F.coalesce("__a", "__b")).select(*features.columns, *[F.col(f"__h.{c}").alias(c) for c in payload])


# ---------------------------------------------------------------- arms and chromosomes

def arm_average(segments: DataFrame, arms: DataFrame, keys: Sequence[str] = ("id",)) -> DataFrame:
    """Length-weighted mean C per arm.  Lengths are end - start here; NULL C adds length but no copies."""
    hit = overlap_join(arms.select("chr", "start", "end", "arm"), segments.select(*keys, "chr", "start", "end", "C"))
    n = F.least("end", "s_end") - F.greatest("start", "s_start")
    return hit.withColumn("__n", n).groupBy(*[F.col(f"s_{k}").alias(k) for k in keys], "arm").agg(
        (F.coalesce(F.sum(F.col("s_C") * F.col("__n")), F.lit(0.0)) / F.nullif(F.sum("__n").cast("double"), F.lit(0.0))).alias("arm_avg"))


def copy_label(c: Column, k: Column, arm: Column, arm_avg: Column, wm: Column, seg_width: Column, sex: Column) -> Column:
    """Homo-del / Amplification / Gain / LOH / None, sex-aware on X and Y; NULL where C is."""
    width = F.coalesce(seg_width.cast("double"), F.lit(-1.0))
    on_x, on_sex = arm.contains("X"), arm.rlike("X|Y")
    no = F.lit(False)
    deleted = (c == 0) & (~on_sex | F.coalesce(((sex == "female") & on_x) | (sex == "male"), no))
    loss = ((c == 1) | F.coalesce(k == 0, no)) & F.coalesce((sex == "female") | ((sex == "male") & ~on_x), no)
    return F.when(c.isNull(), None).when(deleted, "Homo-del").when((c >= 8) & (c >= arm_avg * 2), "Amplification").when(
        (c > 3) & (c > wm) & (width <= 5e6) & (width > -1), "Gain").when(loss, "LOH").otherwise("None")


def label_gene_copies(gene_copy: DataFrame, segments: DataFrame, seg_map: DataFrame, arms: DataFrame, meta: DataFrame) -> DataFrame:
    """Copy-number label of every gene and sample, with the values it rests on."""
    g = gene_copy.filter(F.col("chr").isNotNull())
    place = largest_overlap(
        g.select("chr", "start", "end", "gene_id").distinct(), arms.select("chr", "start", "end", "arm"), ["gene_id"], ["start"]
    ).select("gene_id", F.col("s_arm").alias("chr_arm"))
    avg = arm_average(segments, arms).withColumnRenamed("arm", "chr_arm")
    wm = weighted_median(segments, ["id"], "C", "width")
    # The longest of a gene's segments decides whether a gain is focal.
    longest = segments.select("id", "var_id", "width").join(seg_map, ["id", "var_id"]).groupBy("id", "gene_id").agg(F.max("width").alias("seg_width"))
    out = g.join(place, "gene_id").join(avg, ["id", "chr_arm"], "left").join(wm, "id", "left").join(longest, ["id", "gene_id"], "left").join(meta.select("id", "sex"), "id", "left")
    label = copy_label(F.col("Cmin"), F.col("Kmin"), F.col("chr_arm"), F.col("arm_avg"), F.col("weighted_median"), F.col("seg_width"), F.col("sex"))
    return out.withColumn("annotation", label).select(
        "id", "chr", "start", "end", "gene_id", "gene_name", "annotation", F.col("Cmin").alias("c_min"), F.col("Kmin").alias("k_min"), "chr_arm", "arm_avg",
        "weighted_median", "seg_width")


def call_arms(segments: DataFrame, arms: DataFrame, meta: DataFrame) -> DataFrame:
    """Gain / loss / none of each autosomal arm: the label holding at least half of its covered length."""
    auto = arms.filter(~F.col("arm").rlike("X|Y")).select("chr", "start", "end", "arm")
    # One table of lengths and counts per copy number gives the weighted median and the mode of a sample.
    long = F.when(F.col("width") > 0, F.col("width"))
    per_c = segments.filter(F.col("C").isNotNull()).groupBy("id", "C").agg(F.coalesce(F.sum(long), F.lit(0)).alias("__w"), F.count(F.lit(1)).alias("__n"))
    of = Window.partitionBy("id")
    per_c = per_c.withColumn("__half", F.sum("__w").over(of) / 2).withColumn("__c", F.sum("__w").over(of.orderBy("C").rowsBetween(Window.unboundedPreceding, Window.currentRow))).withColumn("__top", F.max("__n").over(of))
    heavy = F.col("__w") > 0
    low, high = F.min(F.when(heavy & (F.col("__c") >= F.col("__half")), F.col("C"))), F.min(F.when(heavy & (F.col("__c") > F.col("__half")), F.col("C")))
    stats = per_c.groupBy("id").agg(((low + high) / 2).alias("wm"), F.avg(F.when(F.col("__n") == F.col("__top"), F.col("C"))).alias("c_mode")).filter(F.col("wm").isNotNull())
    stats = stats.join(meta.select("id", "ploidy"), "id", "left")
    # Two arms per chromosome: the chromosome is the key and the range a test.
    s = segments.select("id", "chr", F.col("start").alias("s_start"), F.col("end").alias("s_end"), F.col("C").alias("raw"))
    hit = s.join(auto, "chr").filter((F.col("start") <= F.col("s_end")) & (F.col("s_start") <= F.col("end")))
    n = F.least("end", "s_end") - F.greatest("start", "s_start")
    seg = hit.select("id", "arm", "chr", "start", "end", n.alias("n"), F.coalesce(F.col("raw"), F.lit(-1.0)).alias("c"), "raw").join(stats, "id")
    up = (F.col("c") > F.col("wm")) & (F.col("c") > F.col("c_mode")) & (F.col("c") > F.col("ploidy") + 0.5) & (F.col("c") > 2)
    down = (F.col("c") < F.col("wm")) & (F.col("c") < F.col("c_mode")) & (F.col("c") < F.col("ploidy") - 0.5) & (F.col("c") < 4)
    seg = seg.withColumn("label", later_wins([(up, F.lit("gain")), (down, F.lit("loss"))], F.lit("none")))
    # Arms whose segments all lack C are not called.  An arm has three labels at most.
    per = seg.groupBy("id", "arm", "chr", "start", "end", "label", "wm", "ploidy").agg(F.sum("n").alias("len"), F.count("raw").alias("known"))
    arm = Window.partitionBy("id", "arm")
    tot = per.withColumn("__t", F.sum("len").over(arm)).withColumn("__k", F.sum("known").over(arm)).filter(F.col("__k") > 0)
    best = first_row(tot, ["id", "arm"], [F.col("len").desc(), F.col("label").asc()])
    # Binary rounding (0.575 is below its decimal text), as the threshold below is on the rounded share.
    share = F.floor(F.col("len") / F.nullif(F.col("__t").cast("double"), F.lit(0.0)) * 100 + 0.5) / 100
    called = best.withColumn("proportion", share).withColumn("annotation", F.when(share < 0.5, "none").otherwise(F.col("label")))
    return called.select("id", "arm", "annotation", "chr", "start", "end", "wm", "ploidy", "proportion")


def call_chromosomes(arm_calls: DataFrame) -> DataFrame:
    """A chromosome is gained or lost when both its arms are."""
    step = F.when(F.col("annotation") == "gain", 1).when(F.col("annotation") == "loss", -1).otherwise(0)
    out = arm_calls.groupBy("id", "chr").agg(
        F.sum(step).alias("__s"), F.min("start").alias("start"), F.max("end").alias("end"), F.first("wm").alias("wm"), F.first("ploidy").alias("ploidy"))
    return out.withColumn("annotation", F.when(F.col("__s") == 2, "gain").when(F.col("__s") == -2, "loss").otherwise("none")).drop("__s")


def tally_arms(arm_calls: DataFrame, ids: DataFrame) -> DataFrame:
    """Whole-chromosome, arm-only and total events per sample (zeros kept)."""
    hit = arm_calls.filter(F.col("annotation") != "none").groupBy("id", "chr", "annotation").agg(F.count_distinct("arm").alias("n"))
    whole, single = F.col("n") == 2, F.col("n") == 1
    kinds = {"": F.lit(True), "_gain": F.col("annotation") == "gain", "_loss": F.col("annotation") == "loss"}
    count = lambda cond, v=1: F.coalesce(F.sum(F.when(cond, v)), F.lit(0)).cast("int")
    aggs = []
    for suffix, kind in kinds.items():
        aggs += [count(whole & kind).alias(f"chr_whole{suffix}"), count(single & kind).alias(f"arm_only{suffix}"), count(kind, F.col("n")).alias(f"arm_total{suffix}")]
    per = hit.groupBy("id").agg(*aggs)
    return ids.select("id").join(per, "id", "left").fillna(0)


# ---------------------------------------------------------------- cohort bins

def bin_copies(segments: DataFrame, bins: DataFrame, meta: DataFrame | None = None) -> DataFrame:
    """Average C per bin and sample; doubled on X and Y for males, Y dropped for females.

    The overlap width is the weight, so segments need not be split at bin edges first.
    """
    hit = overlap_join(bins.select("chr", "start", "end", "name"), segments.select("id", "chr", "start", "end", "C", "K"))
    w = overlap_width()
    per = hit.withColumn("__w", w).groupBy("chr", "name", F.col("s_id").alias("id")).agg(
        (F.sum(F.col("s_C") * F.col("__w")) / F.sum(F.when(F.col("s_C").isNotNull(), F.col("__w")))).alias("avg_c"),
        (F.sum(F.col("s_K") * F.col("__w")) / F.sum(F.when(F.col("s_K").isNotNull(), F.col("__w")))).alias("avg_k"))
    if meta is None:
        return per
    out = per.join(meta.select("id", "sex", "ploidy"), "id")
    out = out.filter(~((F.col("chr") == "chrY") & F.coalesce(F.col("sex") == "female", F.lit(False))))
    male = F.coalesce(F.col("sex") == "male", F.lit(False)) & F.col("chr").isin(SEX_CHROMOSOMES)
    return out.withColumn("avg_c", F.when(male, F.col("avg_c") * 2).otherwise(F.col("avg_c")))


def binned_recurrence(events: DataFrame, bins: DataFrame, ends: Sequence[tuple[str, str]], labels: Sequence[str] = ()) -> DataFrame:
    """Bin both ends of two-ended events and count events with the same bins (and labels).

    Bins must not overlap, so each end is one point lookup.  Returned with its recurrence on every row.
    """
    out, bins = events, cut_lineage(bins)
    # Bins of about equal widths are one level of cells of the widest one's size: an end is one row, not one per level.
    n = F.col("end") - F.col("start") + 1
    widest, mean = bins.agg(F.max(n), F.avg(n)).first()
    cells = {"bin_width": widest, "max_bins": None} if widest is not None and 0 < widest <= 16 * mean else {}
    for i, (c, p) in enumerate(ends, start=1):
        b = bins.select(F.col("chr").alias(f"__c{i}"), "start", "end", F.col("name").alias(f"bin{i}"), ((F.col("start") + F.col("end")) / 2).alias(f"center{i}"))
        hit = overlap_join(out, b.withColumnRenamed(f"__c{i}", c), keys=(c,), q=(p, p), prefix="__h_", **cells)
        out = hit.select(*out.columns, F.col(f"__h_bin{i}").alias(f"bin{i}"), F.col(f"__h_center{i}").alias(f"center{i}"))
    key = [f"bin{i}" for i in range(1, len(ends) + 1)] + list(labels)
    out = cut_lineage(out)  # counted and joined back: the lookups are made once
    return with_group(out, key, {"recurrence": F.count(F.lit(1))})


def heatmap(segments: DataFrame, sizes: DataFrame, arms: DataFrame, meta: DataFrame, width: int = 1_000_000) -> DataFrame:
    """Tile x sample copy states with labels; tiles without segments are present for every sample."""
    tiles = tile_sequences(sizes, width).filter(~F.col("chr").contains("Y"))
    live = with_group(segments, ["id"], {"__n": F.count("C")}).filter(F.col("__n") > 0).drop("__n")
    hit = overlap_join(tiles, live.select("id", "chr", "start", "end", "C", "K")).withColumn("__w", overlap_width())
    agg = hit.groupBy("chr", "start", "end", F.col("s_id").alias("id")).agg(
        (F.coalesce(F.sum(F.col("s_C") * F.col("__w")), F.lit(0.0)) / F.sum("__w")).alias("tile_c"), F.max("s_C").alias("max_c"), F.min("s_C").alias("min_c"), F.min("s_K").alias("K"))
    bare = tiles.join(agg.select("chr", "start").distinct(), ["chr", "start"], "left_anti")
    gaps = grid(live.select("id").distinct(), bare)
    out = agg.unionByName(gaps, allowMissingColumns=True)
    place = first_overlap(tiles, arms.select("chr", "start", "end", "arm"), ["chr", "start"], ["arm"]).select("chr", "start", F.col("s_arm").alias("arm"))
    stats = weighted_median(live, ["id"], "C", "width", "wm").join(modal_value(live, ["id"], "C", "c_mode"), "id").join(meta.select("id", "ploidy", "sex"), "id", "left")
    out = out.join(place, ["chr", "start"], "left").join(stats, "id")
    c = F.col
    base = later_wins([
        ((c("min_c") < c("ploidy") - 0.5) & (c("min_c") < c("wm")) & (c("min_c") < 4) & (c("min_c") < c("c_mode")), F.lit("loss")),
        ((c("max_c") > c("ploidy") + 0.5) & (c("max_c") > c("wm")) & (c("max_c") > 2) & (c("max_c") > c("c_mode")), F.lit("gain")),
        ((c("max_c") > c("ploidy") + 3) & (c("max_c") > c("wm") + 3) & (c("max_c") > 8), F.lit("amplification")),
        (c("min_c") == 0, F.lit("homo-del")), (c("tile_c").isNull(), F.lit("missing")),
    ], F.lit("none"))
    out = out.withColumn("__b", base)
    half = lambda v: c(v) / 2
    male_x = F.coalesce((c("chr") == "chrX") & (c("sex") == "male"), F.lit(False)) & ~c("__b").isin("amplification", "homo-del", "missing")
    x_gain = (c("tile_c") > half("ploidy") + 0.5) & (c("tile_c") > half("wm")) & (c("tile_c") > 1) & (c("tile_c") > half("c_mode"))
    x_loss = (c("tile_c") < half("ploidy") - 0.5) & (c("tile_c") < half("wm")) & (c("tile_c") < 3) & (c("tile_c") < half("c_mode"))
    label = F.when(male_x, later_wins([(x_gain, F.lit("gain")), (x_loss, F.lit("loss"))], F.lit("none"))).otherwise(c("__b"))
    return out.withColumn("annotation", label).withColumn("rel_c", c("tile_c") / c("ploidy")).drop("__b")


# ---------------------------------------------------------------- blocks, repair and summaries

def blocks(segments: DataFrame, keys: Sequence[str] = ("id", "arm"), pos: str = "start") -> DataFrame:
    """Number runs of adjacent segments with equal C and K; a NULL on either side is no change."""
    return runs(segments, keys, pos, ["C", "K"], null_is_equal=True, out="block")


def block_ranges(blocked: DataFrame, keys: Sequence[str] = ("id", "arm")) -> DataFrame:
    return blocked.groupBy(*keys, "block").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.max("C").alias("C"), F.max("K").alias("K"), F.count(F.lit(1)).alias("n"))


def merge_labels(df: DataFrame, keys: Sequence[str], pos: str, label: str, values: str) -> DataFrame:
    """Merge consecutive rows of one label; their values joined by ``;`` in order."""
    r = runs(df, keys, pos, [label])
    listed = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(pos, values))), lambda e: e[values].cast("string")), ";")
    return r.groupBy(*keys, label, "run").agg(F.max("end").alias("end"), listed.alias(values)).withColumnRenamed("run", pos)


def repair_loh(model: DataFrame, keys: Sequence[str] = ("id",), pos: str = "ord", min_snps: int = 5, chunk: int | None = 1_000_000) -> DataFrame:
    """K of segments without normal pairs is 0; LOH on few SNPs takes the neighbours' K where C agrees."""
    one = lambda c: F.col(c).isin(0.0, 1.0)
    fixed = model.withColumn("K", F.when(F.coalesce(one("nC") | one("C"), F.lit(False)), F.lit(0.0)).otherwise(F.col("K")))
    both = F.struct(F.col("C").alias("c"), F.col("K").alias("k"))
    before = scan(fixed, keys, pos, {"__a": ("last", both)}, chunk=chunk, inclusive=False)
    around = scan(before, keys, pos, {"__b": ("last", both)}, chunk=chunk, inclusive=False, reverse=True)
    # Neighbours with a NULL copy number decide nothing.
    c, prev, nxt = F.col("C"), F.col("__a"), F.col("__b")
    eq_p, eq_n = c == prev["c"], c == nxt["c"]
    new = (
        F.when(eq_p & eq_n & (prev["k"] <= nxt["k"]), prev["k"]).when(eq_p & eq_n & (prev["k"] > nxt["k"]), nxt["k"])
        .when(eq_p & ~eq_n, prev["k"]).when(~eq_p & eq_n, nxt["k"])
    )
    weak = (F.coalesce(F.col("naf"), F.lit(0)) < min_snps) & F.coalesce(F.col("K") == 0, F.lit(False))
    out = around.withColumn("K", F.when(weak, new).otherwise(F.col("K")))
    out = out.withColumn("K", F.when(F.coalesce(one("nC") | one("C"), F.lit(False)), F.lit(0.0)).otherwise(F.col("K")))
    return out.drop("__a", "__b")


def segment_summary(tiles: DataFrame, keys: Sequence[str] = ("id", "seg")) -> DataFrame:
    """Per segment: lengths, counts, gap share, log-ratio and allele-fraction statistics.

    Spread and medians use high-quality tiles only.
    """
    n = F.col("end") - F.col("start") + 1
    good = lambda c: F.when(F.col("hq"), F.col(c))
    return tiles.withColumn("__n", n).groupBy(*keys).agg(
        F.min("start").alias("start"), F.max("end").alias("end"), (F.max("end") - F.min("start") + 1).alias("len"), F.count(F.lit(1)).alias("ntot"), F.count("lr").alias("nlr"),
        F.sum("baf_n").alias("naf"), F.count(F.when(F.col("hq"), 1)).alias("nhq"), (F.sum(F.col("gap") * F.col("__n")) / F.sum("__n")).alias("gap"),
        F.avg("lr").alias("lr_mean"), F.avg("baf").alias("baf_mean"), F.median(good("lr")).alias("lr_median"), F.median(good("baf")).alias("baf_median"),
        F.stddev_samp(good("lr")).alias("lr_sd"), F.stddev_samp(good("baf")).alias("baf_sd"),
        (F.count(F.when(F.col("hq"), 1)) / F.count(F.lit(1))).alias("hq"))


def major_allele_share(snps: DataFrame, keys: Sequence[str] = ("id", "seg")) -> DataFrame:
    """Reads of the larger allele over all reads, per segment."""
    major = F.when(F.col("af") > 0.5, F.col("af") * F.col("dp")).otherwise((1 - F.col("af")) * F.col("dp"))
    return snps.groupBy(*keys).agg((F.sum(major) / F.sum("dp")).alias("mzd"))


def segment_export(summary: DataFrame, value: str = "lr_median", markers: str = "ntot") -> DataFrame:
    """Segment table for recurrence tools: sample, chromosome code, start, end, markers, value."""
    from cohortloom.functions.text import chromosome_code

    return summary.select(F.col("id").alias("sample"), chromosome_code(F.col("chr")).alias("chromosome"), F.col("start").alias("start_pos"),
                          F.col("end").alias("end_pos"), F.col(markers).cast("bigint").alias("num_markers"), F.col(value).alias("seg_cn"))


def attach_segments(df: DataFrame, segments: DataFrame, key: Sequence[str], fields: Sequence[str], q: tuple[str, str] = ("start", "end"), maxgap: int = -1) -> DataFrame:
    """Fit of the first overlapping segment of the same sample; rows without one keep NULLs."""
    s = segments.select("id", "chr", "start", "end", *[f for f in fields if f not in ("id", "chr", "start", "end")])
    cols = list(dict.fromkeys([*key, "id", "chr", *q]))
    hit = first_overlap(df.select(*cols), s, list(key), ["start"], keys=("id", "chr"), q=q, maxgap=maxgap)
    return join_stats(df, hit.select(*key, *[F.col(f"s_{f}").alias(f"seg_{f}") for f in fields]), list(key))
