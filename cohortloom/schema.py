"""Versioned table schemas of a cohort dataset.

Column names use underscores.  ``conform`` casts to the schema and fills absent columns with NULL;
that is how older data, empty reports and appended batches get one shape.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---- fixed values: columns of each table, "type: names" -------------------------------------

_VARIANT_HEAD = "string: triage id var_id chr; int: pos; string: ref alt context sbs96 gene_name gene_id transcript exon hgvsc hgvsp consequence impact sift warnings hgvs_equivalent; double: aft afn adt dpt adn dpn; int: adt_fwd adt_rev; "

_TABLES = {
    "somatic": _VARIANT_HEAD
    + "boolean: str; string: str_ru; int: str_len str_diff ecnt; double: tlod nlod flod xfet sor mqrs mqs oxog; "
    "int: dbsnp clinid; string: clinvar; int: cosmic_cnt; double: gnomad_af kg_af; string: pon rmsk_hit; "
    "double: sblr; string: pid vcf_filter; double: ccf; int: m; boolean: is_indel; int: all_pon",
    "germline": _VARIANT_HEAD
    + "boolean: str; string: str_ru; int: str_len str_diff; double: ecnt tlod nlod flod xfet sor mqrs mqs oxog; string: pid; "
    "int: dbsnp clinid; string: clinvar; int: cosmic_cnt; double: gnomad_af kg_af; string: pon rmsk_hit vcf_filter; "
    "double: sblr; boolean: is_indel; int: all_pon",
    "structural": "string: triage id var_id bnd_id chr1; int: pos1; string: chr2; int: pos2; string: topo insert; "
    "double: qual aft adt dpt; string: caller_filter; int: caller_score; string: caller_contig gene_name_1 gene_id_1 "
    "transcript1 exon1 intron1 strand1 end1 gene_name_2 gene_id_2 transcript2 exon2 intron2 strand2 end2 csq1 csq2 "
    "b1 b2 b12 exons1 exons2",
    "fusion": "string: triage id var_id locus_id_5_1 cyt_5_1 locus_id_3_1 cyt_3_1 locus_id_5_2 cyt_5_2 locus_id_3_2 cyt_3_2 "
    "gene_ids_5_1 gene_names_5_1 gene_ids_3_1 gene_names_3_1 gene_ids_5_2 gene_names_5_2 gene_ids_3_2 gene_names_3_2 "
    "sid chr_5; int: pos_5; string: str_5 chr_3; int: pos_3; string: str_3; int: type rep_5 rep_3; string: qname; "
    "int: seg_5_pos; string: seg_5_cig; int: seg_3_pos; string: seg_3_cig; int: clp_5_l clp_5_r clp_3_l clp_3_r; "
    "string: ftype; double: ovr_5 ovr_3 err_5 err_3 low_5 low_3; int: seg_5_as seg_5_nm seg_5_len seg_3_as seg_3_nm seg_3_len; "
    "string: seq_5 seq_3; boolean: hq_jnc; double: unq_jnc; int: sum_jnc hq_sum_jnc; double: unq_sum_jnc avg_err_5 avg_err_3 "
    "avg_low_5 avg_low_3 max_ovr_5 max_ovr_3; int: unq_ovr_5 unq_ovr_3; string: cls_5 cls_3 ss_5 ss_3; double: frm_5 frm_3; "
    "boolean: orf d2a; string: mot_5 mot_3 art_5 art_3; boolean: art; int: tx_dst tx_pos_5 tx_pos_3 gx_dst bp_dst sum_bpt; "
    "string: dst topo; boolean: hq_bpt hi_bpt hr_bpt hc_bpt; int: rec_5 unq_rec_5 rec_3 unq_rec_3; string: l1 l2 l3; "
    "int: sl_link bs_link ts_link sv_link sl_chain bs_chain ts_chain sv_chain tot_enc tot_jnc tot_sp_jnc_5 tot_sp_jnc_3 "
    "tot_jnc_5 tot_jnc_3; boolean: mm2_valid gmap_valid ts_warn; string: ctg_seq csqf5 csqf3 csqr5 csqr3",
    "segment": "string: triage id var_id chr; int: start end width; string: strand; int: seg; double: C; int: K; double: lr tL aL d anom mse; "
    "int: nlr naf len; double: sC nC; int: block",
    "gene_copy": "string: id chr; int: start end; string: gene_id gene_name; int: nseg; double: Kmin Kmax Cmin Cmax Csub",
    "gene_expression": "string: id gene_id gene_name; int: gene_length tcount; double: tcpm trpkm ncount ncpm nrpkm",
}
_MAPS = {
    "somatic": "string: id var_id gene_id",
    "germline": "string: id var_id gene_id",
    "segment": "string: id var_id gene_id",
    "structural": "string: id var_id end gene_id",
    "fusion": "string: id var_id end gene_id",
}
_META = (
    "string: id case cohort tumor_dna_sample normal_dna_sample tumor_rna_sample normal_rna_sample sex; "
    "double: purity ploidy; string: assembly"
)
_ANNO = "string: chr; int: start end; string: strand gene_id gene_name; boolean: anno_goi somatic_goi germline_goi somatic_art"

#: Columns that version 3 added to version 2.
_ADDED_IN_V3 = {"somatic": {"ccf", "m"}, "segment": {"block"}}
#: Sort keys used when a table is written.
KEYS = {
    "somatic": ["id", "var_id"], "germline": ["id", "var_id"], "structural": ["id", "var_id"],
    "fusion": ["id", "var_id"], "segment": ["id", "var_id"], "gene_copy": ["id", "gene_id"],
    "gene_expression": ["id", "gene_id"], "meta": ["id"], "anno": ["gene_id"],
}
EVENT_TABLES = ("somatic", "germline", "structural", "fusion", "segment")
GENE_TABLES = ("gene_copy", "gene_expression")
VERSIONS = ("v2", "v3")

_TYPES = {"string": T.StringType(), "int": T.IntegerType(), "double": T.DoubleType(), "boolean": T.BooleanType()}


def _build(text: str, drop: set[str] = frozenset()) -> T.StructType:
    fields = []
    for part in text.split(";"):
        kind, names = part.strip().split(":")
        fields += [T.StructField(n, _TYPES[kind]) for n in names.split() if n not in drop]
    return T.StructType(fields)


def table_schema(name: str, version: str = "v3") -> T.StructType:
    """Schema of a table, of ``meta`` or of ``anno``."""
    if version not in VERSIONS:
        raise ValueError(f"unknown version {version}")
    if name == "meta":
        return _build(_META)
    if name == "anno":
        return _build(_ANNO)
    return _build(_TABLES[name], _ADDED_IN_V3.get(name, set()) if version == "v2" else set())


def map_schema(name: str) -> T.StructType:
    return _build(_MAPS[name])


def conform(df: DataFrame, schema: T.StructType, strict: bool = False) -> DataFrame:
    """Select the schema's columns in order, cast, absent ones as NULL; others are dropped.

    With ``strict`` a column the schema does not know is an error instead.
    """
    extra = set(df.columns) - set(schema.names)
    if strict and extra:
        raise ValueError(f"unknown columns: {sorted(extra)}")
    have = set(df.columns)
    return df.select(*[
        (F.col(f"`{f.name}`") if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields
    ])


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def snapshot(df: DataFrame) -> str:
    """Schema of existing data as JSON text."""
    return df.schema.json()
