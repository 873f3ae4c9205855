"""Cohort views: gene hits, expression, recurrence, percentiles, integrated queries, matrices, review tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.functions.text import short_protein
from cohortloom.operators.common import first_row, grid, join_stats, later_wins, numbered, with_group
from cohortloom.operators.order import exact_median, exact_percentiles
from cohortloom.session import cut_lineage

# ---------------------------------------------------------------- hits per gene

def _union(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def event_genes(table: str, df: DataFrame, structural_pattern: str = "^ENSG") -> DataFrame:
    """(id, gene_id) once per event and touched gene side."""
    if table == "structural":
        both = df.select("id", F.explode(F.array("gene_id_1", "gene_id_2")).alias("gene_id"))
        return both.filter(F.col("gene_id").rlike(structural_pattern))
    if table == "fusion":
        sides = [f"gene_ids_{e}" for e in ("5_1", "5_2", "3_1", "3_2")]
        listed = F.flatten(F.array(*[F.split(F.coalesce(F.col(c), F.lit("")), ":") for c in sides]))
        return df.select("id", F.explode(listed).alias("gene_id")).filter(F.col("gene_id") != "")
    return df.select("id", "gene_id")


def gene_hits(
    ids: DataFrame, genes: DataFrame, tables: Mapping[str, DataFrame],
    count: Sequence[str] = ("somatic", "germline", "structural", "gene_copy"), dense: bool = False, structural_pattern: str = "^ENSG",
) -> DataFrame:
    """Hits per (sample, gene): copy loss 0/1/2, mutations 0/1/2 (2 = several), fusion 0/1, and their sum.

    NULL marks a sample without any row in that table.  All tables are stacked and aggregated once,
    rows without a countable gene under a NULL gene, so each table is read once; the samples' tables
    then follow from the cells of one sample, which are no more than its genes.  Only touched
    (sample, gene) pairs come out; ``dense`` adds the other cells, for panels of few genes.
    """
    parts = []
    for name, df in tables.items():
        kind = F.lit(name).alias("kind")
        if name == "gene_copy":
            level = F.when(F.col("Cmin") == 0, 2).when(F.col("Kmin") == 0, 1)
            parts.append(df.select("id", F.when(level.isNotNull(), F.col("gene_id")).alias("gene_id"), kind, level.alias("level")))
        elif name == "structural":
            sides = F.array(*[F.when(F.col(f"gene_id_{n}").rlike(structural_pattern), F.col(f"gene_id_{n}")) for n in "12"])
            parts.append(df.select("id", F.explode(sides).alias("gene_id"), kind, F.lit(1).alias("level")))
        else:
            parts.append(event_genes(name, df, structural_pattern).select("id", "gene_id", kind, F.lit(1).alias("level")))
    one = lambda k: F.col("kind") == k
    n = lambda k: F.count(F.when(one(k), 1))
    cells = {
        k: (F.max(F.when(one(k), F.col("level"))) if k == "gene_copy" else F.when(n(k) > 0, F.lit(1)) if k == "fusion" else F.when(n(k) > 0, F.least(n(k), F.lit(2))))
        for k in tables
    }
    plain = [k for k in tables if k != "fusion"]
    touched = _union(parts).groupBy("id", "gene_id").agg(*[c.cast("int").alias(k) for k, c in cells.items()], *[F.max(F.when(one(k), 0)).alias(f"__has_{k}") for k in plain])
    wanted = genes.select("gene_id", "gene_name").distinct()
    has = [f"__has_{k}" for k in plain]
    if dense:
        present = touched.groupBy("id").agg(*[F.max(h).alias(h) for h in has])
        base = grid(ids.select("id").distinct(), wanted).join(touched.drop(*has), ["id", "gene_id"], "left").join(present, "id", "left")
    else:
        of_sample = Window.partitionBy("id")
        base = touched.withColumns({h: F.max(h).over(of_sample) for h in has}).filter(reduce(lambda a, b: a | b, [F.col(k).isNotNull() for k in tables]))
        base = base.join(wanted, "gene_id").join(ids.select("id"), "id", "left_semi")
    value = {k: F.coalesce(F.col(k), F.lit(0) if k == "fusion" else F.col(f"__has_{k}")) for k in tables}
    out = base.select("id", "gene_id", "gene_name", *[c.alias(k) for k, c in value.items()])
    total = F.lit(0)
    for k in count:
        if k in tables:
            total = total + F.coalesce(F.col(k), F.lit(0))
    return out.withColumn("hits", total)


def genes_with_events(tables: Mapping[str, DataFrame]) -> DataFrame:
    """All (gene_id, gene_name) named by any event table."""
    parts = [t.select("gene_id", "gene_name") for t in tables.values() if {"gene_id", "gene_name"} <= set(t.columns)]
    for n in "12":
        parts += [t.select(F.col(f"gene_id_{n}").alias("gene_id"), F.col(f"gene_name_{n}").alias("gene_name")) for t in tables.values() if f"gene_id_{n}" in t.columns]
    return _union(parts).filter(F.col("gene_id").isNotNull()).distinct()


# ---------------------------------------------------------------- expression

def normalise_expression(counts: DataFrame, lengths: DataFrame, prefix: str = "t") -> DataFrame:
    """Count, counts per million and per kilobase of each sample's genes."""
    tot = with_group(counts, ["id"], {"__t": F.sum("count")})
    out = tot.join(lengths.select("gene_id", "gene_length"), "gene_id", "left")
    cpm = F.col("count") / F.col("__t") * 1e6
    return out.select("id", "gene_id", "gene_length", F.col("count").alias(f"{prefix}count"), cpm.alias(f"{prefix}cpm"),
                      (cpm / (F.col("gene_length") / 1000)).alias(f"{prefix}rpkm"))


def expression_table(tumor: DataFrame | None, normal: DataFrame | None, lengths: DataFrame, genes: DataFrame) -> DataFrame:
    """Tumor and normal expression side by side for every annotated gene of every sample."""
    parts = []
    for counts, prefix in ((tumor, "t"), (normal, "n")):
        if counts is not None:
            parts.append(normalise_expression(counts, lengths, prefix).drop("gene_length"))
    ids = _union([p.select("id") for p in parts]).distinct()
    out = grid(ids, genes.select("gene_id", "gene_name").distinct())
    for p in parts:
        out = out.join(p, ["id", "gene_id"], "left")
    for c in ("tcount", "tcpm", "trpkm", "ncount", "ncpm", "nrpkm"):
        if c not in out.columns:
            out = out.withColumn(c, F.lit(None).cast("double"))
    return out.join(lengths.select("gene_id", "gene_length"), "gene_id", "left")


def transcripts_to_genes(abundance: DataFrame, transcripts: DataFrame, keys: Sequence[str] = ("id",)) -> DataFrame:
    """Gene-level sums of transcript estimates."""
    return abundance.join(transcripts, "target_id").groupBy(*keys, "gene_id").agg(F.sum("est_counts").alias("est_counts"), F.sum("tpm").alias("tpm"))


def expression_wide(df: DataFrame, value: str, samples: Sequence[str], digits: int | None = None) -> DataFrame:
    """Genes x samples; the sample list is given, so no extra pass finds the pivot values."""
    v = F.col(value) if digits is None else F.round(value, digits)
    return df.withColumn("__v", v).groupBy("gene_id", "gene_name").pivot("id", list(samples)).agg(F.first("__v"))


def percentile_view(df: DataFrame, value: str = "rpkm", key: str = "gene_id") -> DataFrame:
    """Discrete percentiles of each gene over the cohort, by selection: no task holds a gene's values.  Runs jobs while it is called."""
    points = {"pct_20": 0.2, "pct_30": 0.3, "pct_40": 0.4, "pct_50": 0.5, "pct_75": 0.75, "pct_90": 0.9, "pct_95": 0.95, "pct_99": 0.99, "pct_999": 0.999}
    return exact_percentiles(df, [key], value, points).drop("n")


def percentile_band(value: Column) -> Column:
    """Band label of a value against the joined percentile columns."""
    steps = [("pct_20", ">20%"), ("pct_30", ">30%"), ("pct_40", ">40%"), ("pct_50", ">50%"), ("pct_75", ">75%"), ("pct_90", ">90%"), ("pct_95", ">95%"),
             ("pct_99", ">99%"), ("pct_999", ">99.9%")]
    return later_wins([(value < F.col("pct_20"), F.lit("<20%")), *[(value >= F.col(c), F.lit(label)) for c, label in steps]], F.lit(None).cast("string"))


def cohort_medians(df: DataFrame, value: str, own: Sequence[str] = (), min_samples: int = 10) -> DataFrame:
    """Median per cohort of one gene, by selection; small cohorts only if they are the sample's own.  Runs jobs while it is called."""
    sizes = df.groupBy("cohort").agg(F.count(F.lit(1)).alias("n"))
    m = join_stats(sizes, exact_median(df, ["cohort"], value).drop("n"), ["cohort"])
    mine = F.col("cohort").isin(list(own)) if own else F.lit(False)
    return m.filter(((F.col("n") > min_samples) & F.col("cohort").isNotNull()) | mine).orderBy(F.col("median").desc(), F.col("cohort").asc())


# ---------------------------------------------------------------- recurrence and integrated queries

def recurrence(df: DataFrame, key: Column | str, sample: str = "id", out: str = "key") -> DataFrame:
    """Keys seen more than once, with the number of samples in the table."""
    k = F.col(key) if isinstance(key, str) else key
    n = df.filter(k.isNotNull()).groupBy(k.alias(out)).agg(F.count(F.lit(1)).alias("recur")).filter(F.col("recur") > 1)
    return n.withColumn("total", df.agg(F.count_distinct(sample)).scalar())


def integrated_variants(variants: DataFrame, recur: DataFrame, copies: DataFrame, expression: DataFrame) -> DataFrame:
    """Variants with recurrence, copy number of their gene and its expression, for all samples at once.

    ``copies``: id, C, K, genes (array).  A variant whose gene lies on several segments appears once
    per segment.
    """
    cn = copies.select("id", F.col("C").alias("cn"), F.col("K").alias("k"), F.explode("genes").alias("gene_id"))
    gx = expression.select("id", "gene_id", "cpm", "rpkm")
    out = variants.join(recur.select("var_id", "recur"), "var_id", "left").join(cn, ["id", "gene_id"], "left").join(gx, ["id", "gene_id"], "left")
    return out.withColumn("recur", F.coalesce("recur", F.lit(0).cast("bigint")))


def most_aberrant(df: DataFrame, keys: Sequence[str], cn: str = "cn") -> DataFrame:
    """Of duplicates the row whose copy number is furthest from two; unknown copy numbers last."""
    order = [F.abs(F.col(cn) - 2).desc_nulls_last(), F.col(cn).desc_nulls_last()]
    return first_row(df, keys, order)


def sample_variants(integrated: DataFrame) -> DataFrame:
    """One row per variant: most aberrant copy number, recurrence at least 1."""
    out = most_aberrant(integrated, ["id", "var_id"]).withColumn("rpkm", F.round("rpkm", 2))
    return out.withColumn("recur", F.when(F.col("recur") == 0, 1).otherwise(F.col("recur")))


def expression_with_copies(packed: DataFrame, gene_index: DataFrame, copies: DataFrame) -> DataFrame:
    """Packed expression arrays back to rows, with gene names and copy number.

    The gene index is stored first, so that its real size is known and the cells need no shuffle to meet it.
    """
    gene_index = cut_lineage(gene_index)
    rows = packed.select("id", F.posexplode(F.arrays_zip("count", "cpm", "rpkm")).alias("__p", "__v")).select("id", (F.col("__p") + 1).alias("idx"), "__v.count", "__v.cpm", "__v.rpkm")
    cn = copies.select("id", F.col("C").alias("c"), F.explode("genes").alias("gene_id"))
    return rows.join(gene_index, "idx", "left").join(cn, ["id", "gene_id"], "left")


def gene_across_cohort(packed: DataFrame, gene_index: DataFrame, gene_id: str, groupings: DataFrame) -> DataFrame:
    """One gene's expression in every sample, picked by its index from the packed arrays."""
    idx = gene_index.filter(F.col("gene_id") == gene_id).agg(F.min("idx").cast("int")).scalar()
    at = packed.withColumn("__idx", idx)
    out = at.select("id", F.try_element_at("cpm", F.col("__idx")).alias("cpm"), F.try_element_at("rpkm", F.col("__idx")).alias("rpkm"))
    return out.join(groupings, "id", "left")


def fusions_with_recurrence(fusions: DataFrame, recur: DataFrame) -> DataFrame:
    pair = F.concat_ws("-", "gene_ids_5_1", "gene_ids_3_1")
    out = fusions.withColumn("pair", pair).join(recur.select(F.col("key").alias("pair"), "recur"), "pair", "left")
    return out.withColumn("recur", F.coalesce("recur", F.lit(1).cast("bigint")))


def feature_values(data: DataFrame, features: DataFrame, name: str | None = None) -> DataFrame:
    """Position-aligned feature arrays to rows: (id, name, feature, gene, value); negative values mean missing."""
    d, m = (data, features) if name is None else (data.filter(F.col("name") == name), features.filter(F.col("name") == name))
    v = d.select("id", "name", F.posexplode("value").alias("p", "value"))
    f = m.select("name", F.posexplode(F.arrays_zip("feature", "gene")).alias("p", "f")).select("name", "p", "f.feature", "f.gene")
    out = v.join(f, ["name", "p"], "left").drop("p")
    return out.withColumn("value", F.when(F.col("value") >= 0, F.col("value")))


def _of(df: DataFrame, ids: Sequence[str] | None) -> DataFrame:
    return df if ids is None else df.filter(F.col("id").isin(list(ids)))


def retrieve_expression(with_copies: DataFrame, ids: Sequence[str] | None = None) -> DataFrame:
    """Genes with expression and their most aberrant copy number ``c``, highest expression first."""
    one = most_aberrant(_of(with_copies, ids), ["id", "gene_id"], "c")
    return one.select("id", "gene_id", "gene_name", "rpkm", "c").orderBy("id", F.col("rpkm").desc_nulls_last(), "gene_id")


def retrieve_segments(with_genes: DataFrame, ids: Sequence[str] | None = None) -> DataFrame:
    """Segments with their genes along the genome."""
    return _of(with_genes, ids).orderBy("id", "chr", "start")


def retrieve_structural(structural: DataFrame, ids: Sequence[str] | None = None) -> DataFrame:
    """Structural variants, highest allele fraction and then quality first."""
    return _of(structural, ids).orderBy("id", F.col("aft").desc_nulls_last(), F.col("qual").desc_nulls_last())


def retrieve_fusions(fusions: DataFrame, recur: DataFrame, ids: Sequence[str] | None = None) -> DataFrame:
    """Fusions with recurrence, most supporting reads (junctions and breakpoints) first."""
    reads = F.coalesce("sum_jnc", F.lit(0)) + F.coalesce("sum_bpt", F.lit(0))
    return fusions_with_recurrence(_of(fusions, ids), recur).orderBy("id", reads.desc())


def feature_names(data: DataFrame, ids: Sequence[str] | None = None) -> DataFrame:
    """Names of the feature sets each sample has."""
    return _of(data, ids).select("id", "name").distinct()


def retrieve_features(data: DataFrame, features: DataFrame, name: str, ids: Sequence[str] | None = None) -> DataFrame:
    """One feature set as rows, highest value first; negative values mean missing."""
    return feature_values(_of(data, ids), features, name).orderBy("id", F.col("value").desc_nulls_last())


def feature_distribution(data: DataFrame, features: DataFrame, name: str, feature: str, groupings: DataFrame) -> DataFrame:
    """One feature's value in every sample that has the set, with the sample's patient and cohort."""
    places = features.filter(F.col("name") == name).select(F.array_position("feature", F.lit(feature)).cast("int").alias("p"))
    at = places.filter("p > 0").agg(F.min("p")).scalar()
    own = data.filter(F.col("name") == name).select("id", F.try_element_at("value", at).alias("value"))
    return own.join(groupings.select("id", "patient", "cohort"), "id", "left").filter(F.col("value").isNotNull())


def pack_values(df: DataFrame, index: DataFrame, columns: Sequence[str], digits: int | None = 2) -> DataFrame:
    """One row per sample with arrays in gene-index order; absent values -1.  Runs jobs while it is called.

    Only values that exist are shuffled, with their place in the arrays; what lies between them is filled in when the
    sample's row is made.
    """
    places = numbered(index.select("gene_id", "idx"), [], ["idx"], "__at")
    places = cut_lineage(with_group(places, ["idx"], {"__from": F.min("__at").cast("int"), "__to": (F.max("__at") + 1).cast("int")}))
    width = places.agg(F.count(F.lit(1)).cast("int")).scalar()
    r = lambda c: F.round(c, digits) if digits is not None else F.col(c)
    val = lambda c: F.coalesce(r(c).cast("double"), F.lit(-1.0))
    none = F.struct(*[F.lit(-1.0).alias(c) for c in columns])
    cells = df.join(places.drop("idx"), "gene_id").select("id", "__from", "__to", "__at", F.struct(*[val(c).alias(c) for c in columns]).alias("__v"))
    # Index rows of one idx are one slot: those without a value have -1, and all are in the order of the values.
    rest = F.col("__to") - F.col("__from") - F.size(F.collect_set("__at"))
    slots = cells.groupBy("id", "__from", "__to").agg(F.array_sort(F.concat(F.collect_list("__v"), F.array_repeat(none, rest))).alias("__v"))
    own = slots.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("__from", "__to", "__v"))).alias("__s"))
    s = F.col("__s")
    gap = lambda x, i: F.array_repeat(none, x["__from"] - F.when(i == 0, 0).otherwise(F.get(s, i - 1)["__to"]))
    upto = F.coalesce(F.get(s, F.size(s) - 1)["__to"], F.lit(0))
    tail = F.array_repeat(none, width - upto)
    dense = F.concat(F.coalesce(F.flatten(F.transform(s, lambda x, i: F.concat(gap(x, i), x["__v"]))), F.array().cast(f"array<struct<{', '.join(f'`{c}`: double' for c in columns)}>>")), tail)
    out = df.select("id").distinct().filter(width > 0).join(own, "id", "left").select("id", dense.alias("__l"))
    return out.select("id", *[F.col(f"__l.{c}").alias(c) for c in columns])


def genes_per_segment(segments: DataFrame, seg_map: DataFrame) -> DataFrame:
    """Segments with the sorted array of their genes; segments without genes keep an empty one."""
    g = seg_map.groupBy("id", "var_id").agg(F.array_sort(F.collect_set("gene_id")).alias("genes"))
    return segments.join(g, ["id", "var_id"], "left").withColumn("genes", F.coalesce("genes", F.array().cast("array<string>")))


def select_by_dictionary(df: DataFrame, dictionary: Sequence[Mapping], table: str, detail: bool = False) -> DataFrame:
    """Select and rename the columns a data dictionary shows."""
    flag = "show_detail" if detail else "show_table"
    rows = [r for r in dictionary if r["table"] == table and r[flag]]
    return df.select(*[F.col(r["db_name"]).alias(r["display_name"]) for r in rows])


def viewer_filter(df: DataFrame, passed: bool = False, impact: bool = False, panel: Sequence[str] | None = None, two_hit: DataFrame | None = None) -> DataFrame:
    """Viewer check boxes: passing, relevant impact, gene panel, second hit (another hit, loss or LOH)."""
    out = df
    if passed:
        out = out.filter(F.col("triage") == "pass")
    if impact:
        out = out.filter(F.col("impact").isin("HIGH", "MODERATE"))
    if panel is not None:
        out = out.filter(F.col("gene_name").isin(list(panel)))
    if two_hit is not None:
        other = two_hit.select("gene_id").distinct().withColumn("__other", F.lit(True))
        out = out.join(other, "gene_id", "left")
        out = out.filter(F.coalesce("__other", F.lit(False)) | F.coalesce(F.col("cn") < 2, F.lit(False)) | F.coalesce(F.col("k") == 0, F.lit(False))).drop("__other")
    return out


# ---------------------------------------------------------------- per-gene unification

def unify(marks: Mapping[str, tuple[DataFrame, DataFrame]], segments: tuple[DataFrame, DataFrame] | None = None,
          gene_copy: DataFrame | None = None, expression: DataFrame | None = None) -> DataFrame:
    """Everything known per (gene, sample): mark lists per event kind, segment count if above one,
    copy number and expression.

    The sources are stacked and grouped once instead of being outer-joined one after the other.
    """
    parts = []
    null = lambda t: F.lit(None).cast(t)
    shape = lambda df, kind, mark, num: df.select("gene_id", "id", F.lit(kind).alias("kind"), mark.cast("string").alias("mark"), num.cast("double").alias("num"))
    for kind, (mark, bridge) in marks.items():
        on = [c for c in ("id", "var_id", "end") if c in mark.columns and c in bridge.columns]
        parts.append(shape(bridge.join(mark, on, "left"), kind, F.col("mark"), null("double")))
    if segments is not None:
        mark, bridge = segments
        parts.append(shape(bridge.join(mark, ["id", "var_id"], "left"), "seg", null("string"), F.lit(1)))
    if gene_copy is not None:
        parts.append(shape(gene_copy, "symbol", F.col("gene_name"), null("double")))
        parts.append(shape(gene_copy, "C", null("string"), F.col("Cmin")))
        parts.append(shape(gene_copy, "K", null("string"), F.col("Kmin")))
    if expression is not None:
        parts.append(shape(expression, "exp", null("string"), F.round("trpkm", 2)))
    of = lambda k, c: F.when(F.col("kind") == k, F.col(c))
    aggs = [F.array_sort(F.collect_set(of(k, "mark"))).alias(k) for k in marks]
    if segments is not None:
        n = F.count(of("seg", "num"))
        aggs.append(F.when(n > 1, n).alias("seg"))
    if gene_copy is not None:
        aggs += [F.max(of("symbol", "mark")).alias("gene_name"), F.max(of("C", "num")).alias("C"), F.max(of("K", "num")).alias("K")]
    if expression is not None:
        aggs.append(F.max(of("exp", "num")).alias("exp"))
    return _union(parts).groupBy("gene_id", "id").agg(*aggs)


def lists_to_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.nullif(F.array_join(c, ","), F.lit("")) for c in columns})


def text_to_lists(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.split(c, ",") for c in columns})


# ---------------------------------------------------------------- matrices

def onco_matrix(annotated: DataFrame, meta: DataFrame, features: Sequence[str], kinds: Sequence[str], assay: str = "tumor_dna_sample") -> DataFrame:
    """Long feature x sample matrix: 1 hit, 0 otherwise, and whether the sample was assayed."""
    wanted = annotated.filter(F.col("annotation").isin(list(kinds)) & F.col("gene_name").isin(list(features)))
    hits = wanted.groupBy("id", "gene_name").agg(F.lit(1).alias("hit"))
    cells = meta.select("id", F.col(assay).isNotNull().alias("tested"), F.explode(F.array(*[F.lit(f) for f in features])).alias("gene_name"))
    return cells.join(hits, ["id", "gene_name"], "left").withColumn("hit", F.coalesce("hit", F.lit(0)))


def onco_wide(long: DataFrame, features: Sequence[str], value: str = "hit") -> DataFrame:
    """One row per sample, one column per feature."""
    return long.groupBy("id").pivot("gene_name", list(features)).agg(F.max(value))


def onco_scores(scores: DataFrame, meta: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Score rows of every sample, NULL where it has none."""
    return meta.select("id").join(scores.select("id", *fields), "id", "left").unpivot("id", list(fields), "field", "value")


def onco_arms(arm_calls: DataFrame, meta: DataFrame, arms: Sequence[str]) -> DataFrame:
    wide = arm_calls.filter(F.col("arm").isin(list(arms))).groupBy("id").pivot("arm", list(arms)).agg(F.first("annotation"))
    return meta.select("id").join(wide, "id", "left")


def merge_features(long: DataFrame, new: str, old: Sequence[str], value: int | None = None) -> DataFrame:
    """Replace several features by one: their sum, or a fixed value."""
    label = F.when(F.col("gene_name").isin(list(old)), new).otherwise(F.col("gene_name"))
    out = long.withColumn("gene_name", label).groupBy("id", "gene_name").agg(F.sum("hit").alias("hit"))
    if value is not None:
        out = out.withColumn("hit", F.when(F.col("gene_name") == new, F.lit(value)).otherwise(F.col("hit")))
    return out


def lollipop(df: DataFrame, by: str = "var_id", split: str | None = None, mode: str = "stack", transcript: str | None = "common") -> DataFrame:
    """Counts per position and label of one gene's variants on its most frequent transcript."""
    out = df.filter(F.col(split).isNotNull()) if split else df
    if transcript == "common":
        best = first_row(df.groupBy("gene_id", "transcript").agg(F.count(F.lit(1)).alias("n")), ["gene_id"], [F.col("n").desc(), F.col("transcript").asc()])
        out = out.join(best.select("gene_id", "transcript"), ["gene_id", "transcript"], "left_semi")
    elif transcript:
        out = out.filter(F.col("transcript") == transcript)
    if by == "hgvsp":
        out = out.filter(F.col("hgvsp").isNotNull()).withColumn("hgvsp", short_protein(F.col("hgvsp")))
    keys = ["chr", "pos", by, *([split] if split else [])]
    if mode == "stack":
        return out.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    one = out.select(*keys, F.lit(1).cast("bigint").alias("n"))
    return one.distinct() if mode == "unique" else one


# ---------------------------------------------------------------- review

def _failed(pattern: str) -> Column:
    return F.coalesce(F.col("triage").rlike(pattern), F.lit(False))


def review_variants(df: DataFrame, meta: DataFrame, gene_name: str | None, germline: bool = False) -> DataFrame:
    """Rows to review: not failed for annotation, artifact or consequence; noteworthy ones flagged."""
    out = df.filter(~_failed("artifact|consequence|annotation"))
    if gene_name is not None:
        out = out.filter(F.col("gene_name") == gene_name)
    known = F.coalesce(F.lower("clinvar").contains("path"), F.lit(False)) | F.coalesce(F.col("cosmic_cnt") > 5, F.lit(False))
    strong = (F.col("aft") > 0.2) & (F.col("afn") > 0.2) if germline else F.col("aft") > 0.02
    out = out.join(meta.select("id", "purity", "ploidy"), "id")
    return out.withColumns({"flag": F.when(known & strong, "FLAG").otherwise(""), "decision": F.lit(""), "notes": F.lit("")})


def review_structural(df: DataFrame, meta: DataFrame, gene_name: str | None) -> DataFrame:
    out = df.filter(~_failed("annotation"))
    if gene_name is not None:
        out = out.filter((F.col("gene_name_1") == gene_name) | (F.col("gene_name_2") == gene_name))
    flag = F.when((F.col("caller_filter") == "PASS") & (F.col("aft") > 0.1) & (F.col("adt") > 5), "FLAG").otherwise("")
    return out.join(meta.select("id", "purity", "ploidy"), "id").withColumns({"flag": flag, "decision": F.lit(""), "notes": F.lit("")})


def review_fusions(df: DataFrame, meta: DataFrame, gene_name: str) -> DataFrame:
    from cohortloom.operators.structural import format_fusions

    sides = [f"gene_names_{e}" for e in ("5_1", "5_2", "3_1", "3_2")]
    listed = F.flatten(F.array(*[F.split(F.coalesce(F.col(c), F.lit("")), ":") for c in sides]))
    out = format_fusions(df.filter(F.array_contains(listed, gene_name) & ~_failed("annotation")))
    flag = F.when((F.col("hq") == "yes") & (F.col("mm2_valid") == "yes") & (F.col("gmap_valid") == "yes") & (F.col("total_reads") > 5), "FLAG").otherwise("")
    return out.join(meta.select("id", "purity", "ploidy"), "id").withColumns({"flag": flag, "decision": F.lit(""), "notes": F.lit("")})


def review_order(df: DataFrame) -> DataFrame:
    return df.orderBy(F.col("triage").asc(), F.col("flag").desc(), *[F.col(c).asc() for c in ("consequence", "id", "var_id") if c in df.columns])


def review_decisions(df: DataFrame, table: str) -> DataFrame:
    """Reviewed rows to rescue decisions: pass-like words keep, fail-like words reject."""
    d = F.lower("decision")
    text = F.when(d.rlike("fail|manual|remove"), "manual").when(d.rlike("pass|keep|override"), "keep").otherwise("")
    return df.select(text.alias("triage"), "id", "var_id", F.lit(table).alias("table"), "notes")


def collapse_text(df: DataFrame, columns: Mapping[str, str], sep: str = "; ") -> DataFrame:
    """Distinct events of each (sample, gene) as parallel joined texts; NULL prints as NA."""
    rows = df.select("id", "gene_id", *[F.coalesce(F.col(c).cast("string"), F.lit("NA")).alias(n) for n, c in columns.items()]).distinct()
    listed = F.array_sort(F.collect_list(F.struct(*columns)))
    return rows.groupBy("id", "gene_id").agg(listed.alias("__l")).select("id", "gene_id", *[F.array_join(F.col(f"__l.{n}"), sep).alias(n) for n in columns])


def review_features(hits: DataFrame, somatic: DataFrame, germline: DataFrame, gene_copy: DataFrame, expression: DataFrame, meta: DataFrame) -> DataFrame:
    """Hits with the collapsed variant texts, segment count, expression, purity and ploidy.

    Kept: any hit or a split gene, but not a lone single-copy loss.
    """
    som = collapse_text(somatic, {f"som_{c}": c for c in ("hgvsp", "consequence", "aft", "ccf", "clinvar", "cosmic_cnt", "gnomad_af")})
    ger = collapse_text(germline, {f"grm_{c}": c for c in ("hgvsp", "consequence", "clinvar", "cosmic_cnt", "gnomad_af")})
    out = hits
    for part in (som, ger, gene_copy.select("id", "gene_id", "nseg"), expression.select("id", "gene_id", "trpkm")):
        out = out.join(part, ["id", "gene_id"], "left")
    out = out.join(meta.select("id", "purity", "ploidy"), "id", "left")
    lone_loss = F.coalesce((F.col("gene_copy") == 1) & (F.col("hits") == 1), F.lit(False))
    return out.filter(((F.col("hits") > 0) | F.coalesce(F.col("nseg") > 1, F.lit(False))) & ~lone_loss)


# ---------------------------------------------------------------- microsatellites

def homopolymer_instability(variants: DataFrame, homopolymers: DataFrame, targets: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Score per sample and per-length frequency.

    The score is the percentage of homopolymers of length 7 to 20 in targets that have an indel; only
    variants whose ``pass`` is the text "pass" count.
    """
    from cohortloom.operators.intervals import overlap_join, with_overlap

    sites = with_overlap(homopolymers.select("chr", "start", "end").distinct(), targets).withColumn("length", (F.col("end") - F.col("start") + 1).cast("int"))
    indel = variants.filter((F.col("pass") == "pass") & F.col("str") & F.col("str_ru").isin("A", "C", "G", "T")).select("id", "chr", "pos", (F.col("pos") + 1).alias("__e")).distinct()
    hit = overlap_join(indel, sites, q=("pos", "__e")).select("id", F.col("s_chr").alias("chr"), F.col("s_start").alias("start"), F.col("s_length").alias("length")).distinct()
    per = hit.groupBy("id", "length").agg(F.count(F.lit(1)).alias("indels"))
    n = sites.groupBy("length").agg(F.count(F.lit(1)).alias("sites"))
    freq = grid(ids.select("id").distinct(), n).join(per, ["id", "length"], "left").withColumn("indels", F.coalesce("indels", F.lit(0).cast("bigint")))
    freq = freq.withColumn("freq", F.col("indels") / F.col("sites"))
    score = freq.filter(F.col("length").between(7, 20)).groupBy("id").agg((100 * F.sum("indels") / F.sum("sites")).alias("score"))
    return score, freq
