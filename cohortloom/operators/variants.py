"""Somatic and germline variant tables: derived columns, classes, reports, phased merging."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.functions import text as X
from cohortloom.operators.common import first_row, later_wins, scan, whole_groups, with_group
from cohortloom.session import cut_lineage

# ---------------------------------------------------------------- normalisation and filters

def flatten_lists(df: DataFrame, columns: Sequence[str], sep: str = ";") -> DataFrame:
    """List columns to delimited text; an empty list is NULL."""
    return df.withColumns({c: X.blank_to_null(F.array_join(c, sep)) for c in columns})


def derived_filters(df: DataFrame) -> DataFrame:
    """Columns the evidence rules use: is_indel, strand balance and absence in population panels."""
    absent = (F.col("gnomad_af") == 0).cast("int") + F.col("pon").isNull().cast("int") + (F.col("kg_af") == 0).cast("int")
    return df.withColumns({
        "is_indel": F.length("ref") != F.length("alt"),
        "sblr": F.abs(F.log2((F.col("adt_fwd") + 1) / (F.col("adt_rev") + 1))),
        "all_pon": absent,
    })


def _rare() -> Column:
    return (F.col("gnomad_af") < 0.01) & (F.col("kg_af") < 0.01)


def _relevant() -> Column:
    return F.coalesce(F.col("impact").isin("MODERATE", "HIGH"), F.lit(False)) | F.col("clinid").isNotNull()


PREFILTERS = {
    ("somatic", False): lambda: (F.col("xfet") < 0.1) & (F.col("aft") > F.col("afn")) & (F.col("consequence") != "intron_variant"),
    ("somatic", True): lambda: (F.col("dpt") > 8) & (F.col("adt") > 3) & (F.col("consequence") != "intron_variant"),
    ("germline", False): lambda: _rare() & (F.col("adn") > 4) & (F.col("afn") > 0.1) & _relevant(),
    ("germline", True): lambda: _rare() & _relevant(),
}


def prefilter(df: DataFrame, table: str, tumor_only: bool = False) -> DataFrame:
    """Import filter of a report; structural and fusion reports pass unchanged."""
    rule = PREFILTERS.get((table, tumor_only))
    return df.filter(rule()) if rule else df


def signature_quality(df: DataFrame) -> DataFrame:
    """Rows good enough to count for mutational signatures."""
    return df.filter(
        F.col("sbs96").isNotNull() & (F.col("adt_fwd") >= 2) & (F.col("adt_rev") >= 2) & (F.col("sor") < 4)
        & (F.col("mqrs") > -3) & (F.col("mqs") > 23)
        & (((F.col("adn") == 0) & (F.col("nlod") > 6)) | (F.col("nlod") > 20))
        & (F.col("nn") == 0) & F.col("pon").isNull() & (F.col("aft") > 0.015) & (F.col("tlod") > 6)
    )


def snp_prefilter(df: DataFrame, min_depth: int, depths: Sequence[str] = ("t_dp", "n_dp")) -> DataFrame:
    """Biallelic single-base variants with a quality and enough depth in every sample."""
    cond = (F.length("ref") == 1) & (F.length("alt") == 1) & ~F.col("alt").contains(",") & F.col("qual").isNotNull()
    for d in depths:
        cond = cond & (F.col(d) > min_depth)
    return df.filter(cond)


def keep_supported(df: DataFrame) -> DataFrame:
    """Cohort-store import: more than two reads in either sample; promoter hot spots count as high impact."""
    from cohortloom.operators.rulesets import PROMOTER_HOTSPOT

    kept = df.filter((F.col("adt") > 2) | (F.col("adn") > 2))
    return kept.withColumn("impact", F.when(F.coalesce(F.expr(PROMOTER_HOTSPOT), F.lit(False)), F.lit("HIGH")).otherwise(F.col("impact")))


# ---------------------------------------------------------------- classes and projections

def mutation_class(consequence: Column) -> Column:
    return (
        F.when(consequence.rlike("frameshift|stop_gained|stop_lost|start_lost|splice"), "truncating")
        .when(consequence.rlike("missense|inframe|protein_altering_variant"), "missense")
        .when(consequence.rlike("synonymous|stop_retained_variant"), "synonymous")
        .when(consequence.rlike("UTR|stream|intergenic"), "noncoding")
        .otherwise(consequence)
    )


def annotate_mutations(df: DataFrame) -> DataFrame:
    return df.select(
        "id", "gene_id", "gene_name", mutation_class(F.col("consequence")).alias("annotation"),
        X.amino_acid_position(F.col("hgvsp")).alias("aa_pos"),
    ).distinct()


def represent_variants(df: DataFrame) -> DataFrame:
    """Compact form of a variant table."""
    return df.select(
        "var_id", "chr", "pos", "ref", "alt", "aft", "adt", "dpt", "afn", "adn", "dpn", "tlod", "nlod", "xfet", "str",
        "gene_id", F.col("transcript").alias("transcript_id"), "hgvsp", "hgvsc", "consequence", "cosmic_cnt", "gnomad_af", "clinvar",
    )


def variant_marks(df: DataFrame) -> DataFrame:
    return df.select("id", "var_id", F.coalesce("hgvsp", "hgvsc").alias("mark"))


def ccf_marks(df: DataFrame) -> DataFrame:
    return df.select("id", "var_id", F.coalesce("ccf", F.least(F.col("aft") * 2, F.lit(1.0))).alias("mark"))


def end_marks(df: DataFrame, ends: dict[str, str]) -> DataFrame:
    """One row per end: {end label: column with its consequence}."""
    cells = F.array(*[F.struct(F.lit(e).alias("end"), F.col(c).alias("mark")) for e, c in ends.items()])
    return df.select("id", "var_id", F.inline(cells))


STRUCTURAL_ENDS = {"e1": "csq1", "e2": "csq2"}
FUSION_ENDS = {"f5": "csqf5", "f3": "csqf3", "r5": "csqr5", "r3": "csqr3"}


def segment_marks(df: DataFrame) -> DataFrame:
    return df.select("id", "var_id", F.col("seg").alias("mark"))


# ---- fixed values: constant columns of the mutation-annotation export
_MAF_CONSTANTS_HEAD = {"Entrez_Gene_Id": ".", "NCBI_Build": "GRCh38", "Strand": "+"}
_MAF_CONSTANTS_TAIL = {
    "dbSNP_Val_Status": "by1000genomes", "Tumor_Validation_Allele1": ".", "Tumor_Validation_Allele2": ".",
    "Match_Norm_Validation_Allele1": ".", "Match_Norm_Validation_Allele2": ".", "Verification_Status": "Unknown",
    "Validation_Status": "Untested", "Mutation_Status": "Somatic", "Sequencing_Phase": ".", "Sequence_Source": "WXS",
    "Validation_Method": "none", "Score": ".", "BAM_File": ".", "Sequencer": "Illumina HiSeq",
    "Tumor_Sample_UUID": ".", "Normal_Sample_UUID": ".",
}
_MAF_CLASSES = [
    ("start_lost", None, "Translation_Start_Site"), ("stop_gained", None, "Nonsense_Mutation"),
    ("stop_lost", None, "Nonstop_Mutation"), ("splice_donor_variant|splice_acceptor_variant", None, "Splice_Site"),
    ("frameshift_variant", "longer", "Frame_Shift_Ins"), ("frameshift_variant", "shorter", "Frame_Shift_Del"),
    ("inframe_insertion", None, "In_Frame_Ins"), ("inframe_deletion", None, "In_Frame_Del"),
    ("missense_variant", None, "Missense_Mutation"), ("protein_altering_variant", None, "Protein_Altering"),
    ("upstream_gene_variant", None, "Missense_Mutation"),
]
_SUBSTITUTIONS = {1: "SNP", 2: "DNP", 3: "TNP"}


def to_maf(df: DataFrame, center: str = ".") -> DataFrame:
    """Mutation annotation format: one projection, no shuffle."""
    ref, alt = F.col("ref"), F.col("alt")
    lr, la = F.length(ref), F.length(alt)
    anchored = F.substring(ref, 1, 1) == F.substring(alt, 1, 1)
    rest = lambda c: F.substring(c, F.lit(2), F.length(c))

    def trimmed(allele: Column, other: Column) -> Column:
        """Allele without the anchor base; '-' when only the anchor is left."""
        indel = lr != la
        one_base = (F.length(allele) == 1) & (F.length(allele) < F.length(other))
        facing_one_base = (F.length(other) == 1) & (F.length(other) < F.length(allele))
        return (
            F.when(~indel, allele).when(one_base, F.lit("-"))
            .when(facing_one_base | anchored, rest(allele)).otherwise(allele)
        )

    csq = F.coalesce(F.col("consequence"), F.lit(""))
    klass = None
    for pattern, size, label in _MAF_CLASSES:
        cond = csq.rlike(pattern)
        if size:
            cond = cond & ((la > lr) if size == "longer" else (la < lr))
        klass = F.when(cond, label) if klass is None else klass.when(cond, label)
    kind = F.when(la > lr, "INS").when(la < lr, "DEL")
    for n, label in _SUBSTITUTIONS.items():
        kind = kind.when(lr == n, label)
    ref_allele = trimmed(ref, alt)
    parts = F.split("id", r"\.")
    const = lambda d: [F.lit(v).alias(k) for k, v in d.items()]
    return df.select(
        F.col("id").alias("Patient_ID"), F.col("gene_name").alias("Hugo_Symbol"), *const(_MAF_CONSTANTS_HEAD),
        F.lit(center).alias("Center"), F.col("chr").alias("Chromosome"),
        F.when((lr > la) & anchored, F.col("pos") + 1).otherwise(F.col("pos")).alias("Start_Position"),
        (F.col("pos") + lr - 1).alias("End_Position"),
        klass.otherwise("Silent").alias("Variant_Classification"), kind.otherwise("ONP").alias("Variant_Type"),
        ref_allele.alias("Reference_Allele"), ref_allele.alias("Tumor_Seq_Allele1"), trimmed(alt, ref).alias("Tumor_Seq_Allele2"),
        F.col("dbsnp").alias("dbSNP_RS"), F.try_element_at(parts, F.lit(2)).alias("Tumor_Sample_Barcode"),
        F.try_element_at(parts, F.lit(3)).alias("Matched_Norm_Sample_Barcode"),
        ref_allele.alias("Match_Norm_Seq_Allele1"), ref_allele.alias("Match_Norm_Seq_Allele2"), *const(_MAF_CONSTANTS_TAIL),
        F.col("hgvsc").alias("HGVSc"), F.col("hgvsp").alias("HGVSp"), X.short_protein(F.col("hgvsp")).alias("HGVSp_Short"),
        F.col("transcript").alias("Transcript_ID"), F.col("exon").alias("Exon_Number"),
        F.col("dpt").alias("t_depth"), (F.col("dpt") - F.col("adt")).alias("t_ref_count"), F.col("adt").alias("t_alt_count"),
        F.col("dpn").alias("n_depth"), (F.col("dpn") - F.col("adn")).alias("n_ref_count"), F.col("adn").alias("n_alt_count"),
        F.col("impact").alias("IMPACT"), F.col("sift").alias("SIFT"), F.col("kg_af").alias("GMAF"),
        F.col("cosmic_cnt").alias("COSMIC"), F.col("clinvar").alias("CLIN_SIG"), F.col("gnomad_af").alias("ExAC_AF"), "pon",
    )


# ---------------------------------------------------------------- allele expansion and reports

def expand_alleles(df: DataFrame, per_alt: Sequence[str] = (), per_allele: Sequence[str] = (), alt: str = "alt", csq: str | None = None) -> DataFrame:
    """One row per alternative allele.

    ``per_alt`` columns hold one element per ALT, ``per_allele`` columns one for REF and one per ALT
    (they become <name>_ref and <name>_alt, missing depths 0).  ``csq`` is an array of structs with
    ``allele_num``; only the entries of the row's allele stay.
    """
    out = df.select("*", F.posexplode(F.split(alt, ",")).alias("__i", "__alt"))
    nth = lambda c, i: F.try_element_at(F.col(c), i)
    new = {c: nth(c, F.col("__i") + 1) for c in per_alt}
    out = out.withColumns(new) if new else out
    for c in per_allele:
        out = out.withColumn(f"{c}_ref", F.coalesce(nth(c, F.lit(1)), F.lit(0))).withColumn(
            f"{c}_alt", F.coalesce(nth(c, F.col("__i") + 2), F.lit(0))).drop(c)
    if csq:
        out = out.withColumn(csq, F.filter(csq, lambda e: F.coalesce(e["allele_num"].cast("int"), F.lit(1)) == F.col("__i") + 1))
    return out.withColumn(alt, F.col("__alt")).withColumn(
        "var_id", F.concat("chr", F.lit(":"), F.col("pos").cast("string"), F.lit("_"), "ref", F.lit("/"), F.col("__alt"))
    ).drop("__i", "__alt")


def variant_report(df: DataFrame, defaults: dict[str, str] | None = None) -> DataFrame:
    """Report shape from parsed records: absent fields as typed NULLs, '' as NULL, absent rates as 0."""
    out = df
    for name, kind in (defaults or {}).items():
        if name not in out.columns:
            out = out.withColumn(name, F.lit(None).cast(kind))
    zero = [c for c in ("cosmic_cnt", "gnomad_af", "kg_af") if c in df.columns]
    out = out.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in zero}) if zero else out
    texts = {c: X.blank_to_null(F.col(c)) for c, t in out.dtypes if t == "string"}
    out = out.withColumns(texts)
    if {"qss_alt", "adt"} <= set(out.columns):
        out = out.withColumn("mqs", F.col("qss_alt") / F.nullif(F.col("adt").cast("double"), F.lit(0.0)))
    if "rpa" in out.columns:
        first, second = F.coalesce(F.try_element_at("rpa", F.lit(1)), F.lit(0)), F.coalesce(F.try_element_at("rpa", F.lit(2)), F.lit(0))
        out = out.withColumn("str_len", first).withColumn("str_diff", first - second).drop("rpa")
    return out


# ---------------------------------------------------------------- consequence picking

def impact_score() -> Column:
    """Impact class plus the most precise coding location of the consequence."""
    filled = lambda c: F.coalesce(F.col(c), F.lit("")) != ""
    coding = F.coalesce(F.col("biotype"), F.lit("")) == "protein_coding"
    base = F.when(F.col("impact") == "HIGH", 30).when(F.col("impact") == "MODERATE", 20).when(F.col("impact") == "LOW", 10).otherwise(0)
    bonus = (
        F.when(coding & filled("exon") & filled("protein_position"), 7)
        .when(coding & filled("exon") & filled("cdna_position"), 5)
        .when(coding & filled("intron"), 3).otherwise(0)
    )
    return base + bonus


#: fixed values: flags of the transcript-preference table.
PREFERENCE_FLAGS = ["known", "ccds", "lrg", "select", "basic", "appris1", "tsl1", "valid", "panel_old", "panel_new"]


def with_preferences(csq: DataFrame, preferences: DataFrame) -> DataFrame:
    """Left join of the preference flags by short transcript id; absent flags are FALSE."""
    have = [f for f in PREFERENCE_FLAGS if f in preferences.columns]
    prefs = preferences.groupBy("id_short").agg(*[F.bool_or(f).alias(f"p_{f}") for f in have])
    out = csq.join(prefs, "id_short", "left")
    return out.withColumns({f"p_{f}": F.coalesce(F.col(f"p_{f}") if f in have else F.lit(None), F.lit(False)) for f in PREFERENCE_FLAGS})


def preference_score() -> Column:
    """How much a transcript is preferred, 3 to 71; later, stronger reasons win."""
    p = lambda f: F.col(f"p_{f}")
    filled = lambda c: F.coalesce(F.col(c), F.lit("")) != ""
    canonical, picked = F.col("canonical") == "YES", F.col("pick") == "1"
    known = later_wins([
        (p("known"), F.lit(3)), (p("known") & (F.col("biotype") == "protein_coding") & ~filled("flags"), F.lit(5)),
    ], F.lit(0))
    def ladder(steps):
        """Score after the plain reasons, then the ones that need a score already reached."""
        score = later_wins(steps, known)
        score = F.when((score >= 30) & F.coalesce(picked, F.lit(False)), F.lit(50)).otherwise(score)
        score = F.when((score >= 20) & p("panel_new"), F.lit(60)).otherwise(score)
        return score

    refseq = ladder([
        (p("panel_old"), F.lit(10)), (p("ccds") | p("lrg"), F.lit(20)),
        (canonical & (p("panel_old") | p("ccds") | p("lrg")), F.lit(30)), (p("select"), F.lit(40)),
    ])
    symbol_ok = F.coalesce(F.col("symbol_source") != "Clone_based_ensembl_gene", F.lit(True))
    any_ccds = p("lrg") | p("ccds") | filled("ccds")
    ensembl = F.when(symbol_ok, ladder([
        (p("basic") | p("panel_old"), F.lit(10)), (any_ccds, F.lit(20)),
        (canonical & (p("basic") | p("panel_old") | any_ccds), F.lit(30)),
        (p("appris1") | p("tsl1") | (F.col("tsl") == "1") | p("valid"), F.lit(40)),
    ])).otherwise(known)
    mane = filled("mane_select")
    return (
        F.when(F.col("source") == "RefSeq", F.when(mane, F.lit(70)).otherwise(refseq))
        .when(F.col("source") == "Ensembl", F.when(mane, F.lit(70)).otherwise(ensembl) + 1)
        .otherwise(known)
    )


def ranked_preference_score(rank: Column) -> Column:
    """Score of a curated, ranked transcript list."""
    return F.when(rank == 1, 60).when(rank > 1, 30).otherwise(0)


def resolve_ids(csq: DataFrame) -> DataFrame:
    """Short transcript id, HGVS without its prefix, and all transcripts with the same HGVS."""
    short = later_wins([
        (F.col("consequence") == "intergenic_variant", F.concat(F.lit("intergenic_"), F.col("var_id"))),
        (F.col("source") == "RefSeq", X.blank_to_null(F.regexp_extract("feature", r"(.*)\.[0-9]+$", 1))),
        ((F.col("source") == "Ensembl") | (F.col("biotype") == "aligned_transcript"), F.col("feature")),
    ], F.lit(None).cast("string"))
    tail = lambda c: F.regexp_extract(c, "[^:]*$", 0)
    out = csq.withColumns({"id_short": short, "hgvsc_short": tail("hgvsc"), "hgvsp_short": tail("hgvsp")})
    keys = ["var_id", "hgvsc_short", "hgvsp_short"]
    return with_group(out, keys, {"hgvs_equivalent": F.array_join(F.array_sort(F.collect_list("id_short")), ";")})


def pick_consequence(csq: DataFrame, keys: Sequence[str] = ("var_id",)) -> DataFrame:
    """Best-scored consequence of each variant; unpreferred transcripts last, ties by transcript id."""
    order = [(F.col("preference_score") < 3).asc(), F.col("impact_score").desc(), F.col("preference_score").desc(), F.col("id_short").asc()]
    return first_row(csq, keys, order)


def pick_pair_consequence(csq: DataFrame, pairs: DataFrame) -> DataFrame:
    """Consequence of each breakend of a pair, transcripts seen at both ends first.

    ``csq``: var_id, symbol, id_short, impact_score, preference_score (+ payload); ``pairs``: bnd_id,
    id1, id2, proximal.
    """
    # Read several times: stored once, as is the joined table of both ends.
    csq, pairs = cut_lineage(csq), cut_lineage(pairs)
    score = csq.select("var_id", "symbol", "id_short", "impact_score", "preference_score")

    def side(n: str) -> DataFrame:
        s = score.select(*[F.col(c).alias(f"{c}_{n}" if c not in ("id_short",) else c) for c in score.columns])
        return pairs.join(s, F.col(f"id{n}") == F.col(f"var_id_{n}"), "left").drop(f"var_id_{n}")

    one = side("1").select("bnd_id", "proximal", "id_short", "symbol_1", "impact_score_1", "preference_score_1")
    two = side("2").select("bnd_id", "id_short", "symbol_2", "impact_score_2", "preference_score_2", F.col("proximal").alias("__prox2"))
    both = one.alias("a").join(
        two.alias("b"), (F.col("a.bnd_id") == F.col("b.bnd_id")) & F.col("a.id_short").eqNullSafe(F.col("b.id_short")), "full"
    ).select(
        F.coalesce("a.bnd_id", "b.bnd_id").alias("bnd_id"), F.coalesce("a.id_short", "b.id_short").alias("id_short"),
        F.coalesce("proximal", "__prox2").alias("proximal"),
        X.blank_to_null(F.col("symbol_1")).alias("symbol_1"), X.blank_to_null(F.col("symbol_2")).alias("symbol_2"),
        "impact_score_1", "preference_score_1", "impact_score_2", "preference_score_2",
    )
    both = cut_lineage(both)
    # An end has no gene when none of its preferred transcripts (first end's preference) names one.
    named = lambda c: F.bool_or(F.col(c).isNotNull() & F.coalesce(F.col("preference_score_1") >= 3, F.lit(False)))
    # Where a task can hold a pair's rows they are dealt by pair once, for this and for the join with the ends.
    flagged = with_group(both, ["bnd_id"], {"__has1": named("symbol_1"), "__has2": named("symbol_2")}, whole=bool(whole_groups(both, "bnd_id")))
    joint = F.coalesce(F.col("symbol_1") == F.col("symbol_2"), F.lit(False)) | (F.col("proximal") & (~F.col("__has1") | ~F.col("__has2")))
    paired = flagged.withColumns({
        "pair_impact": F.when(joint, F.greatest("impact_score_1", "impact_score_2")),
        "pair_preference": F.when(joint, F.greatest("preference_score_1", "preference_score_2")),
    }).select("bnd_id", "id_short", "pair_impact", "pair_preference")
    ends = pairs.select("bnd_id", F.explode(F.array("id1", "id2")).alias("var_id"))
    cand = paired.join(ends, "bnd_id").join(csq, ["var_id", "id_short"])
    order = [
        (F.col("pair_preference") < 3).asc_nulls_last(), F.col("pair_impact").desc_nulls_last(), F.col("pair_preference").desc_nulls_last(),
        (F.col("preference_score") < 3).asc_nulls_last(), F.col("impact_score").desc_nulls_last(),
        F.col("preference_score").desc_nulls_last(), F.col("id_short").asc(), F.col("bnd_id").asc(),
    ]
    return first_row(cand, ["var_id"], order)


# ---------------------------------------------------------------- phased variants

def merge_phased(variants: DataFrame, bases: DataFrame | None, maxgap: int, keys: Sequence[str] = ("id",), chunk: int = 100_000) -> DataFrame:
    """Merge phased variants at most ``maxgap`` bases apart into one multi-base variant.

    ``variants``: keys, chr, pos, ref, alt, pid.  ``bases``: chr, pos, base of the reference, used
    for the bases between merged variants.  Unphased and isolated variants pass through.  A merged
    variant is the record of its first member with new alleles.  A clump is short (a few phased
    variants), so its alleles are joined as one small sorted list.
    """
    group = [*keys, "chr", "pid"]
    loose = variants.filter(F.col("pid").isNull())
    v = variants.filter(F.col("pid").isNotNull()).withColumn("end", F.col("pos") + F.length("ref") - 1)
    # Several variants may start at one position: the clump id is found per distinct start.
    starts = v.groupBy(*group, "pos").agg(F.max("end").alias("end"))
    reach = scan(starts, group, "pos", {"__top": ("max", F.col("end"))}, chunk=chunk, inclusive=False, keep_chunk=True)
    opened = reach.withColumn("__open", F.when(F.col("__top").isNull() | (F.col("pos") > F.col("__top") + maxgap + 1), F.col("pos")))
    clump = scan(opened, group, "pos", {"clump": ("last", F.col("__open"))}, chunk=chunk).select(*group, "pos", "clump")
    tagged = v.join(clump, [*group, "pos"])
    sized = with_group(tagged, [*group, "clump"], {"__n": F.count(F.lit(1)), "__last": F.max("end")})
    single = sized.filter(F.col("__n") == 1).select(*variants.columns)
    many = sized.filter(F.col("__n") > 1)
    rest = [c for c in variants.columns if c not in (*group, "pos", "ref", "alt", "var_id")]
    payload = F.struct(*[F.col(c) for c in rest]) if rest else F.struct(F.lit(True).alias("none"))
    parts = many.select(*group, "clump", "pos", "ref", "alt", "end", payload.alias("__rest"))
    if bases is not None:
        span = many.groupBy(*group, "clump").agg(F.max("__last").alias("__last"))
        covered = many.select(*group, "clump", F.explode(F.sequence("pos", "end")).alias("pos")).distinct()
        need = span.select(*group, "clump", F.explode(F.sequence("clump", "__last")).alias("pos")).join(covered, [*group, "clump", "pos"], "left_anti")
        fill = need.join(bases, ["chr", "pos"]).select(*group, "clump", "pos", F.col("base").alias("ref"), F.col("base").alias("alt"), F.col("pos").alias("end"))
        parts = parts.unionByName(fill, allowMissingColumns=True)
    text = lambda c: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "end", "ref", "alt"))), lambda e: e[c]), "")
    first = F.min(F.when(F.col("__rest").isNotNull(), F.struct("pos", "end", "ref", "alt", "__rest"))).getField("__rest")
    merged = parts.groupBy(*group, "clump").agg(text("ref").alias("ref"), text("alt").alias("alt"), first.alias("__rest"))
    merged = merged.select(*group, F.col("clump").alias("pos"), "ref", "alt", *[F.col(f"__rest.{c}").alias(c) for c in rest])
    out = loose.unionByName(single).unionByName(merged, allowMissingColumns=True)
    return out.withColumn("var_id", F.concat("chr", F.lit(":"), F.col("pos").cast("string"), F.lit("_"), "ref", F.lit("/"), "alt"))


def add_context(variants: DataFrame, bases: DataFrame) -> DataFrame:
    """Trinucleotide context and substitution class from a (chr, pos, base) reference table.

    The neighbours are found by one equi-join: each variant position asks for pos-1 and pos+1.
    """
    sites = variants.select("chr", "pos").distinct()
    asked = sites.select("chr", F.col("pos").alias("site"), F.inline(F.array(
        F.struct((F.col("pos") - 1).alias("pos"), F.lit("b").alias("w")), F.struct((F.col("pos") + 1).alias("pos"), F.lit("a").alias("w")))))
    around = asked.join(bases, ["chr", "pos"]).groupBy("chr", F.col("site").alias("pos")).agg(
        F.max(F.when(F.col("w") == "b", F.col("base"))).alias("__b"), F.max(F.when(F.col("w") == "a", F.col("base"))).alias("__a"))
    out = variants.join(around, ["chr", "pos"], "left")
    point = F.col("ref").isin(*"ACGT") & F.col("alt").isin(*"ACGT")
    return out.withColumns({
        "context": F.when(point, F.concat("__b", "ref", "__a")),
        "sbs96": X.sbs96(F.col("__b"), F.col("ref"), F.col("alt"), F.col("__a")),
    }).drop("__b", "__a")


def signature_counts(df: DataFrame, classes: DataFrame, keys: Sequence[str] = ("id",), ids: DataFrame | None = None) -> DataFrame:
    """Variants per substitution class; every class of ``classes`` is present, zeros kept, for the
    samples of ``ids`` (default: those with a variant)."""
    from cohortloom.operators.common import grid

    counts = df.filter(F.col("sbs96").isNotNull()).groupBy(*keys, "sbs96").agg(F.count(F.lit(1)).alias("n"))
    cells = grid((df if ids is None else ids).select(*keys).distinct(), classes.select("sbs96").distinct())
    return cells.join(counts, [*keys, "sbs96"], "left").withColumn("n", F.coalesce("n", F.lit(0)).cast("long"))


# ---------------------------------------------------------------- external knowledge

def annotate_exact(variants: DataFrame, source: DataFrame, fields: Sequence[str], keys=("chr", "pos", "ref", "alt")) -> DataFrame:
    """Copy fields of a variant source by exact allele; several records keep the first by value."""
    src = source.groupBy(*keys).agg(*[F.min(f).alias(f) for f in fields])
    return variants.join(src, list(keys), "left")


def annotate_regions(variants: DataFrame, regions: DataFrame, value: str, out: str, sep: str = ",") -> DataFrame:
    """Distinct names of the regions each allele overlaps, joined; NULL when there are none."""
    from cohortloom.operators.common import join_stats
    from cohortloom.operators.intervals import overlap_join

    key = ["chr", "pos", "ref"]
    sites = variants.select(*key).distinct().withColumn("__e", F.col("pos") + F.length("ref") - 1)
    names = overlap_join(sites, regions.select("chr", "start", "end", value), q=("pos", "__e")).groupBy(*key).agg(
        F.array_join(F.array_sort(F.collect_set(f"s_{value}")), sep).alias(out))
    return join_stats(variants, names, key)


def knowledge_rollup(evidence: DataFrame, keys: Sequence[str] = ("variant_id",)) -> DataFrame:
    """Evidence per variant: diseases as ``name:n`` joined by ``|`` and one flag per evidence type."""
    per = evidence.groupBy(*keys, "disease").agg(F.count(F.lit(1)).alias("n"))
    text = per.filter(F.col("disease").isNotNull()).groupBy(*keys).agg(
        F.array_join(F.array_sort(F.collect_list(F.concat("disease", F.lit(":"), F.col("n").cast("string")))), "|").alias("diseases"))
    types = ["Diagnostic", "Predictive", "Predisposing", "Prognostic"]  # fixed values
    supports = F.col("evidence_direction") == "Supports"
    flags = evidence.groupBy(*keys).agg(
        *[F.coalesce(F.bool_or(supports & (F.col("evidence_type") == t)), F.lit(False)).alias(t.lower()) for t in types])
    return flags.join(text, list(keys), "left")
