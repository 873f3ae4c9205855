"""Variant, triage and report queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortloom.functions import text as X
from cohortloom.functions.numeric import fisher_exact
from cohortloom.operators import triage as T
from cohortloom.operators import variants as V
from cohortloom.operators import rulesets as R
from queries.registry import query

DERIVED_SQL = """
  v as (select *, length(ref) <> length(alt) as is_indel, abs(log2((adt_fwd + 1) / (adt_rev + 1))) as sblr,
        cast(gnomad_af = 0 as int) + cast(pon is null as int) + cast(kg_af = 0 as int) as all_pon from variant)
"""


@query("derived_filters", f"""with {DERIVED_SQL}
select var_id, is_indel, round(sblr, 6) as sblr, all_pon, count(*) as n from v group by all""", ("variant",))
def _(d):
    return V.derived_filters(d.variant).groupBy(
        "var_id", "is_indel", F.round("sblr", 6).alias("sblr"), "all_pon").agg(F.count("*").alias("n"))


for _tab, _to, _cond in [
    ("somatic", False, "xfet < 0.1 and aft > afn and consequence <> 'intron_variant'"),
    ("somatic", True, "dpt > 8 and adt > 3 and consequence <> 'intron_variant'"),
    ("germline", False, "gnomad_af < 0.01 and kg_af < 0.01 and adn > 4 - 3 and afn > 0.1 - 0.09 and (impact in ('MODERATE','HIGH') or clinid is not null)"),
    ("germline", True, "gnomad_af < 0.01 and kg_af < 0.01 and (impact in ('MODERATE','HIGH') or clinid is not null)"),
]:
    def _run(d, tab=_tab, to=_to):
        df = d.variant
        if (tab, to) == ("germline", False):
            # The role table has few normal reads; scale them into the range of the thresholds.
            df = df.withColumn("adn", F.col("adn") + 3).withColumn("afn", F.col("afn") + 0.09)
        return V.prefilter(df, tab, to).groupBy("consequence", "impact").agg(
            F.count("*").alias("n"), F.sum("adt").alias("reads"))

    query(f"prefilter_{_tab}_{'to' if _to else 'tn'}", f"""
      select consequence, impact, count(*) as n, sum(adt) as reads from variant where {_cond if (_tab, _to) != ("germline", False) else "gnomad_af < 0.01 and kg_af < 0.01 and adn + 3 > 4 and afn + 0.09 > 0.1 and (impact in ('MODERATE','HIGH') or clinid is not null)"}
      group by all""", ("variant",))(_run)


@query("mutation_classes", r"""
select distinct id, gene_id, gene_name,
  case when regexp_matches(consequence, 'frameshift|stop_gained|stop_lost|start_lost|splice') then 'truncating'
       when regexp_matches(consequence, 'missense|inframe|protein_altering') then 'missense'
       when regexp_matches(consequence, 'synonymous|stop_retained') then 'synonymous'
       when regexp_matches(consequence, 'UTR|stream|intergenic') then 'noncoding' else consequence end as annotation,
  cast(nullif(regexp_extract(hgvsp, '^p\.[A-Za-z]{1,6}([0-9]{1,4})', 1), '') as int) as aa_pos
from variant""", ("variant",))
def _(d):
    return V.annotate_mutations(d.variant)


@query("maf_export", """
with a as (select *, length(ref) lr, length(alt) la, ref[1] = alt[1] as anch from variant)
select id as "Patient_ID", gene_name as "Hugo_Symbol", pos + case when lr > la and anch then 1 else 0 end as "Start_Position",
  pos + lr - 1 as "End_Position",
  case when consequence = 'stop_gained' then 'Nonsense_Mutation' when consequence = 'splice_donor_variant' then 'Splice_Site'
       when consequence = 'frameshift_variant' and lr < la then 'Frame_Shift_Ins' when consequence = 'frameshift_variant' and lr > la then 'Frame_Shift_Del'
       when consequence = 'inframe_deletion' then 'In_Frame_Del' when consequence = 'missense_variant' then 'Missense_Mutation'
       when consequence = 'upstream_gene_variant' then 'Missense_Mutation' else 'Silent' end as "Variant_Classification",
  case when lr < la then 'INS' when lr > la then 'DEL' when lr = 1 then 'SNP' when lr = 2 then 'DNP' when lr = 3 then 'TNP' else 'ONP' end as "Variant_Type",
  case when lr = la then ref when lr < la and lr = 1 then '-' when lr > la and la = 1 then ref[2:] when anch then ref[2:] else ref end as "Reference_Allele",
  case when lr = la then alt when lr < la and lr = 1 then alt[2:] when lr > la and la = 1 then '-' when anch then alt[2:] else alt end as "Tumor_Seq_Allele2",
  coalesce(replace(replace(replace(replace(replace(hgvsp, 'p.', ''), 'Ala', 'A'), 'Trp', 'W'), 'Lys', 'K'), 'Val', 'V'), '') as "HGVSp_Short",
  dpt - adt as t_ref_count, dpn - adn as n_ref_count, var_id
from a""", ("variant",))
def _(d):
    v = d.variant
    keep = ["Patient_ID", "Hugo_Symbol", "Start_Position", "End_Position", "Variant_Classification", "Variant_Type", "Reference_Allele",
            "Tumor_Seq_Allele2", "HGVSp_Short", "t_ref_count", "n_ref_count"]
    # var_id is carried through the transcript column of the export.
    maf = V.to_maf(v.withColumn("transcript", F.col("var_id")))
    return maf.select(*keep, F.col("Transcript_ID").alias("var_id"))


@query("variant_representation", """select var_id, chr, pos, ref, alt, aft, gene_id, transcript as transcript_id, hgvsp, consequence, clinvar
from variant""", ("variant",))
def _(d):
    return V.represent_variants(d.variant).select(
        "var_id", "chr", "pos", "ref", "alt", "aft", "gene_id", "transcript_id", "hgvsp", "consequence", "clinvar")



@query("variant_marks", "select id, var_id, coalesce(hgvsp, hgvsc) as mark from variant", ("variant",))
def _(d):
    return V.variant_marks(d.variant)


@query("ccf_marks", "select id, var_id, round(coalesce(ccf, least(aft * 2, 1.0)), 6) as mark from variant", ("variant",))
def _(d):
    return V.ccf_marks(d.variant).withColumn("mark", F.round("mark", 6))


# ---------------------------------------------------------------- triage

FLAGS_SQL = DERIVED_SQL.strip() + """,
  t as (select v.*, coalesce(g.anno_goi, false) ag, coalesce(g.somatic_goi, false) goi, coalesce(g.germline_goi, false) ggoi,
        coalesce(g.somatic_art, false) art,
        coalesce(clinvar in ('Pathogenic/Likely_pathogenic', 'Pathogenic', 'Likely_pathogenic', 'drug_response'), false) harmful,
        coalesce(clinvar in ('Benign', 'Benign/Likely_benign', 'Likely_benign'), false) benign,
        not str or str_len < 4 as short_str, not is_indel or rmsk_hit is null as no_rep,
        pid is not null and count(*) over (partition by v.id, v.gene_id, pid) > 1 as phase
     from v left join gene g on v.gene_id = g.gene_id),
  e as (select *,
    (short_str and no_rep) as clean, ((str and str_len >= 4) or (is_indel and rmsk_hit is not null)) as rep,
    case when mqrs is null then aft > 0.9 else mqrs > -3 end as mq,
    adt_fwd > 1 or (adt_fwd = 1 and adt < 10) as fw, adt_rev > 1 or (adt_rev = 1 and adt < 10) as rv,
    adt_fwd = 1 and adt <= 12 and sor < 1.5 as onefw from t),
  f as (select *,
    (clean and tlod > 12 and nlod > 18 and (flod > 9 or (adn = 0 and dpn >= 100)) and xfet < 0.01 and adt_fwd >= 6 and adt_rev >= 6 and adn <= 2 and aft > afn * 6)
    or (rep and tlod > 24 and nlod > 24 and (flod > 12 or (adn = 0 and dpn >= 100)) and xfet < 0.005 and adt_fwd >= 9 and adt_rev >= 9 and adn <= 1 and aft > afn * 8)
    or (clean and adt > 4 and (adn <= 3 or adn / (dpn + 0.1) <= 0.0066) and aft >= 0.024 and (afn < 0.012 or (afn < 0.02 and adn = 1) or (afn < 0.025 and adn = 0))
        and tlod > 6 and nlod > 6 and flod > 3 and xfet < 0.05 and (fw or onefw) and (rv or onefw) and sor < 4 and mq and mqs > 24.75)
    or (rep and adt > 9 and (adn <= 1 or adn / (dpn + 0.1) <= 0.0066) and aft >= 0.045 and afn < 0.005 and tlod > 12 and nlod > 12 and flod > 6 and xfet < 0.025
        and adt_fwd > 2 and adt_rev > 2 and sor < 3.5 and mq and mqs > 27) as data_tn,
    (clean and adt > 8 and aft >= 0.04 and fw and rv and sor < 4 and mq and mqs > 25)
    or (rep and adt > 9 and aft >= 0.05 and adt_fwd > 2 and adt_rev > 2 and sor < 3.5 and mq and mqs > 27) as data_to,
    (cosmic_cnt > 25 or goi or harmful) and (all_pon >= 3 or harmful) and (adn = 0 or (adn = 1 and afn <= 0.006) or (adn = 2 and afn <= 0.004)) and (
       (clean and ((adt > 2 and aft > 0.021) or (adt > 3 and aft > 0.019) or (adt > 4 and aft > 0.017) or (adt > 5 and aft > 0.015) or (adt > 6 and aft > 0.013) or (adt > 7 and aft > 0.011) or adt > 8)
        and tlod > 6 and nlod > 6 and adt_fwd >= 1 and adt_rev >= 1 and ((sblr < 2.5 and sor < 3.5) or sor < 1.5) and coalesce(mqrs > -2.5, false) and mqs > 26 and ecnt < 5)
       or (rep and ((adt > 5 and aft > 0.027) or (adt > 6 and aft > 0.025) or (adt > 7 and aft > 0.023) or (adt > 8 and aft > 0.021))
        and tlod > 9 and nlod > 9 and adt_fwd >= 2 and adt_rev >= 2 and ((sblr < 1.75 and sor < 3) or sor < 1.5) and coalesce(mqrs > -2, false) and mqs > 26 and ecnt < 3)) as anno_tn,
    (harmful or cosmic_cnt > 25 or goi) and (not str or str_len < 5) and no_rep and adt > 2 and aft > 0.02 and adt_fwd >= 1 and adt_rev >= 1 and sor < 2.5
       and coalesce(mqrs > -0.5, false) and mqs > 26 and gnomad_af = 0 and kg_af = 0 and pon is null as anno_to
    from e),
  som as (select id, var_id, not ag as annotation, case when adn is null then not data_to and not anno_to else not data_tn and not anno_tn end as evidence,
     impact not in ('HIGH', 'MODERATE') as consequence, not goi as goi, art as artifact, phase, false as custom, gene_id from f),
  ger as (select id, var_id, not ag as annotation,
     not (not benign and (adn is null or (afn >= 0.2 and adn >= 8 and dpn >= 40)) and ((gnomad_af <= 0.005 and kg_af <= 0.005) or harmful)) as evidence,
     impact not in ('HIGH', 'MODERATE') as consequence, not ggoi as goi, gene_id from f)
"""


def _variants(d):
    return V.derived_filters(d.variant).withColumn("triage", F.lit(None).cast("string"))


@query("triage_flags_somatic", f"with {FLAGS_SQL} select id, var_id, annotation, evidence, consequence, goi, artifact, phase from som", ("variant", "gene"))
def _(d):
    return T.triage_flags(_variants(d), "somatic", d.gene).drop("custom")


@query("triage_flags_germline", f"with {FLAGS_SQL} select id, var_id, annotation, evidence, consequence, goi from ger", ("variant", "gene"))
def _(d):
    return T.triage_flags(_variants(d), "germline", d.gene).drop("custom")


TEXT_SQL = FLAGS_SQL.strip() + """,
  somt as (select id, var_id, gene_id, array_to_string(list_filter([case when annotation then 'annotation' end, case when evidence then 'evidence' end,
     case when consequence then 'consequence' end, case when goi then 'goi' end, case when artifact then 'artifact' end, case when phase then 'phase' end], lambda x: x is not null), ';') as triage from som)
"""


@query("triage_text_somatic", f"with {TEXT_SQL} select id, var_id, triage from somt", ("variant", "gene"))
def _(d):
    return T.triage_table(_variants(d), "somatic", d.gene).select("id", "var_id", "triage")


@query("triage_filter", f"with {TEXT_SQL} select id, var_id, triage from somt where not regexp_matches(triage, 'annotation|consequence|evidence|artifact|manual|custom')", ("variant", "gene"))
def _(d):
    done = T.triage_table(_variants(d), "somatic", d.gene)
    return done.filter(T.not_failed(R.FILTER_RULES["somatic"])).select("id", "var_id", "triage")


@query("triage_structural", """
select id, var_id, not (coalesce(gene_id_1 in (select gene_id from gene), false)
   or coalesce(gene_id_2 in (select gene_id from gene), false)) as annotation, caller_filter is null as evidence from structural""", ("structural", "gene"))
def _(d):
    return T.triage_flags(d.structural, "structural", d.gene).drop("custom")


@query("triage_fusion_genes", """
with fus as (select cast(o_custkey as varchar) as id, cast(l_orderkey as varchar) as var_id, l_partkey, l_suppkey, l_quantity > 10 as hq, l_tax > 0.03 as mm2, l_discount > 0.05 as gmap, l_quantity > 45 as hi
   from lineitem l join orders o on l.l_orderkey = o.o_orderkey),
 agg as (select id, var_id, list(concat('G', l_partkey)) as g5, list(concat('G', l_suppkey * 7)) as g3, bool_or(hq) hq, bool_or(mm2) mm2, bool_and(gmap) gmap, bool_and(hi) hi from fus group by id, var_id)
select a.id, a.var_id, not exists (select 1 from (select unnest(list_concat(a.g5, a.g3)) as g) u join gene on gene.gene_id = u.g where gene.somatic_art) as annotation,
  not ((hq and (mm2 or gmap)) or hi) as evidence from agg a""", ("gene",))
def _(d):
    lo = d.lineitem.join(d.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    text = lambda c: F.array_join(F.array_sort(F.collect_set(F.concat(F.lit("G"), c.cast("string")))), ":")
    fus = lo.groupBy(F.col("o_custkey").cast("string").alias("id"), F.col("l_orderkey").cast("string").alias("var_id")).agg(
        text(F.col("l_partkey")).alias("gene_ids_5_1"), text(F.col("l_suppkey") * 7).alias("gene_ids_3_1"),
        F.bool_or(F.col("l_quantity") > 10).alias("hq_bpt"), F.bool_or(F.col("l_tax") > 0.03).alias("mm2_valid"),
        F.bool_and(F.col("l_discount") > 0.05).alias("gmap_valid"), F.bool_and(F.col("l_quantity") > 45).alias("hi_bpt"),
    ).withColumn("gene_ids_5_2", F.lit("")).withColumn("gene_ids_3_2", F.lit(""))
    return T.triage_flags(fus, "fusion", d.gene.filter("somatic_art")).drop("custom")


for _name in ("pediatric", "prostate", "tumor_only", "old_default", "old_caller", "old_pediatric"):
    def _run(d, name=_name):
        v = _variants(d).withColumn("tn", F.lit(0.0))
        return T.triage_table(v, "somatic", d.gene, T.RULE_SETS[name]).select("id", "var_id", "triage")

    if _name == "prostate":
        _sql = f"""with {FLAGS_SQL}, p as (select id, var_id, case when adn is null then not (goi and tlod > 5 and impact in ('HIGH','MODERATE') and aft >= 0.02 and adt >= 10 and (gnomad_af = 0 or (gnomad_af < 0.001 and aft > 0.025)))
          else not (tlod > 6 and nlod > 6 and flod > 1.5 and aft >= 0.02 and afn < 0.02 and adt >= 7 and adn < 7 and (xfet < 0.05 or (xfet < 0.1 and adn = 0 and tlod > 7.5 and nlod > 7.5)) and aft > afn * 10 and mqs > 23
            and (gnomad_af = 0 or (gnomad_af < 0.001 and aft > 0.025)) and impact in ('HIGH','MODERATE')) end as bad from f)
          select id, var_id, case when bad then 'custom' else '' end as triage from p"""
    elif _name == "pediatric":
        _sql = f"""with {FLAGS_SQL}, p as (select coalesce(ccf >= 0.05, true) and adt_fwd > 0 and adt_rev > 0 and sor < 4 and coalesce(mqrs > -3, false) and mqs > 23 and aft >= 0.02 and impact in ('HIGH','MODERATE')
            and (gnomad_af = 0 or (gnomad_af < 0.001 and aft > 0.025)) as base, * from f),
          q as (select id, var_id, case when adn is null then not (base and goi and tlod > 5 and adt >= 10)
            else not (base and tlod > 6 and nlod > 6 and flod > 1.5 and afn < 0.02 and adt >= 7 and adn < 7 and (xfet < 0.05 or (xfet < 0.1 and adn = 0 and tlod > 7.5 and nlod > 7.5)) and aft > afn * 10) end as bad from p)
          select id, var_id, case when bad then 'custom' else '' end as triage from q"""
    elif _name == "old_pediatric":
        _sql = f"""with {FLAGS_SQL}, p as (select coalesce(ccf >= 0.05, true) and adt_fwd > 0 and adt_rev > 0 and sor < 4 and coalesce(mqrs > -3, false) and mqs > 23 and aft >= 0.02 and impact in ('HIGH','MODERATE')
            and (gnomad_af = 0 or (gnomad_af < 0.001 and aft > 0.025)) and (nn < 0.01 or cosmic_cnt > 100) as base, * from f),
          q as (select id, var_id, case when adn is null then not (base and tlod > 5 and adt >= 10)
            else not (base and tlod > 6 and nlod > 6 and flod > 1.5 and afn < 0.02 and adt >= 7 and adn < 7 and (xfet < 0.05 or (xfet < 0.1 and adn = 0 and tlod > 7.5 and nlod > 7.5)) and aft > afn * 10) end as bad from p)
          select id, var_id, case when bad then 'custom' else '' end as triage from q"""
    elif _name == "tumor_only":
        _sql = f"""with {FLAGS_SQL}, s as (select id, var_id, not ag as a, case when adn is null then not anno_to and not (
              (clean and adt > 6 and aft >= 0.05 and fw and rv and sor < 4 and mq and mqs > 25 and gnomad_af < case when dbsnp is null then 0.01 else 0.001 end)
              or (rep and adt > 12 and tlod > 12 and aft >= 0.05 and adt_fwd > 2 and adt_rev > 2 and sor < 3.5 and case when mqrs is null then aft > 0.9 else mqrs > -2.5 end and mqs > 27 and gnomad_af < 0.01))
            else not data_tn and not anno_tn end as e, impact not in ('HIGH', 'MODERATE') as c, not goi as g, art, phase from f)
          select id, var_id, concat_ws(';', case when a then 'annotation' end, case when e then 'evidence' end, case when c then 'consequence' end, case when g then 'goi' end, case when art then 'artifact' end, case when phase then 'phase' end) as triage from s"""
    elif _name in ("old_default", "old_caller"):
        _old = _name == "old_default"
        _q1 = "and sor < 4 and case when mqrs is null then aft > 0.9 else mqrs > -3 end and mqs > 25 and fw and rv and flod > 3" if _old else "and mqrs is null and aft > 0.9"
        _q2 = "and flod > 6 and adt_fwd > 2 and adt_rev > 2 and sor < 3.5 and mq and mqs > 27" if _old else "and mqrs is null and aft > 0.9"
        _f1 = "and (flod > 9 or (adn = 0 and dpn >= 100)) and adt_fwd >= 6 and adt_rev >= 6" if _old else ""
        _f2 = "and (flod > 12 or (adn = 0 and dpn >= 120)) and adt_fwd >= 9 and adt_rev >= 9" if _old else ""
        _a1 = "and adt_fwd >= 1 and adt_rev >= 1 and sblr < 2 and sor < 3.5 and coalesce(mqrs > -2.5, false) and mqs > 26" if _old else ""
        _a2 = "and adt_fwd >= 2 and adt_rev >= 2 and sblr < 1.5 and sor < 3 and coalesce(mqrs > -2, false) and mqs > 26" if _old else ""
        _sql = f"""with {FLAGS_SQL}, o as (select *,
            (clean and tlod > 12 and nlod > 18 and xfet < 0.01 and adn <= 2 and aft > afn * 6 {_f1}) or (rep and tlod > 24 and nlod > 24 and xfet < 0.005 and adn <= 1 and aft > afn * 8 {_f2})
            or (clean and adt > 4 and (adn <= 3 or adn / (dpn + 0.1) <= 0.0066) and aft >= 0.024 and (afn < 0.012 or (afn < 0.02 and adn = 1)) and tlod > 6 and nlod > 6 and xfet < 0.05 {_q1})
            or (rep and adt > 9 and (adn <= 1 or adn / (dpn + 0.1) <= 0.0066) and aft >= 0.045 and afn < 0.005 and tlod > 12 and nlod > 12 and xfet < 0.025 {_q2}) as dt2,
            (cosmic_cnt > 25 or goi or harmful) and (all_pon >= 3 or harmful) and (adn = 0 or (adn = 1 and afn <= 0.006) or (adn = 2 and afn <= 0.004)) and (
             (clean and ((adt > 2 and aft > 0.021) or (adt > 3 and aft > 0.019) or (adt > 4 and aft > 0.017) or (adt > 5 and aft > 0.015) or (adt > 6 and aft > 0.013) or (adt > 7 and aft > 0.011) or adt > 8) and tlod > 6 and nlod > 6 and ecnt < 5 {_a1})
             or (rep and ((adt > 5 and aft > 0.027) or (adt > 6 and aft > 0.025) or (adt > 7 and aft > 0.023) or (adt > 8 and aft > 0.021)) and tlod > 9 and nlod > 9 and ecnt < 3 {_a2})) as at2,
            case impact when 'LOW' then 1 when 'MODIFIER' then 2 when 'MODERATE' then 3 when 'HIGH' then 4 end as ir from f),
          b as (select id, pid, max(row(ir, tlod, var_id)) as best from o where pid is not null group by 1, 2),
          s as (select o.id, o.var_id, case when adn is null then not data_to and not anno_to else not dt2 and not at2 end as e, impact not in ('HIGH', 'MODERATE') as c, art or ecnt >= 10 as x, coalesce(o.var_id <> struct_extract_at(b.best, 3), false) as p from o left join b on b.id = o.id and b.pid = o.pid)
          select id, var_id, concat_ws(';', case when e then 'evidence' end, case when c then 'consequence' end, case when x then 'artifact' end, case when p then 'phase' end) as triage from s"""
    else:
        _sql = None
    query(f"rule_set_{_name}", _sql, ("variant", "gene"))(_run)


@query("rescue_decisions", f"""with {TEXT_SQL}, dec as (select distinct id, var_id from variant where adt = 50)
select s.id, s.var_id, case when d.id is not null then concat_ws(';', 'keep', s.triage) else s.triage end as triage from somt s left join dec d on s.id = d.id and s.var_id = d.var_id""", ("variant", "gene"))
def _(d):
    done = T.triage_table(_variants(d), "somatic", d.gene)
    dec = d.variant.filter("adt = 50").select("id", "var_id", F.lit("keep").alias("triage"))
    return T.rescue_table(done, dec).select("id", "var_id", "triage")


@query("unknown_events", """select id, var_id from variant v where not exists (select 1 from structural s where s.id = v.id and s.var_id = v.var_id and s.aft < 0.05)""", ("variant", "structural"))
def _(d):
    return T.absent_events([d.structural.filter("aft < 0.05")], d.variant.select("id", "var_id"))


@query("update_join", """select v.var_id, coalesce(s.impact, v.impact) as impact from variant v left join (select var_id, min(topology) as impact from (select var_id, case when chr1 = chr2 then 'SAME' else 'OTHER' end as topology from structural where aft > 0.08) group by var_id) s on v.var_id = s.var_id""", ("variant", "structural"))
def _(d):
    upd = d.structural.filter("aft > 0.08").groupBy("var_id").agg(F.min(F.when(F.col("chr1") == F.col("chr2"), "SAME").otherwise("OTHER")).alias("impact"))
    return T.update_from(d.variant, upd, ["var_id"], "impact").select("var_id", "impact")


# ---------------------------------------------------------------- scalar functions

@query("fisher_read_table", """
with t as (select distinct cast(l_quantity as bigint) % 9 as a, l_partkey % 12 as b, l_suppkey % 7 as c, l_linenumber + 3 as d from lineitem),
 x as (select a, b, c, d, unnest(range(greatest(0, c - d + a - a, a + c - (a + b + c + d) + a + b), least(a + b, a + c) + 1)) as k from t),
 p as (select a, b, c, d, k, exp(lgamma(a + b + 1) + lgamma(c + d + 1) + lgamma(a + c + 1) + lgamma(b + d + 1) - lgamma(a + b + c + d + 1)
     - lgamma(k + 1) - lgamma(a + b - k + 1) - lgamma(a + c - k + 1) - lgamma(d - a + k + 1)) as p from
   (select a, b, c, d, unnest(range(greatest(0, a - d), least(a + b, a + c) + 1)) as k from t))
select cast(a as bigint) as a, cast(b as bigint) as b, cast(c as bigint) as c, cast(d as bigint) as d, round(least(1.0, sum(case when p <= obs * (1 + 1e-7) then p end)), 6) as p_value
from (select *, max(case when k = a then p end) over (partition by a, b, c, d) as obs from p) group by all""")
def _(d):
    t = d.lineitem.select((F.col("l_quantity").cast("bigint") % 9).alias("a"), (F.col("l_partkey") % 12).alias("b"),
                          (F.col("l_suppkey") % 7).alias("c"), (F.col("l_linenumber") + 3).cast("bigint").alias("d")).distinct()
    return t.withColumn("p_value", F.round(fisher_exact("a", "b", "c", "d"), 6))


@query("sequence_functions", """
with s as (select p_partkey, upper(regexp_replace(translate(p_name, 'ebirdlmxw', 'ACGTACGTA'), '[^ACGT]', '', 'g')) as seq from part)
select p_partkey, seq, reverse(translate(seq, 'ACGT', 'TGCA')) as rc, round(case when length(seq) > 0 then length(regexp_replace(seq, '[^GC]', '', 'g')) / length(seq) end, 6) as gc from s""")
def _(d):
    seq = F.upper(F.regexp_replace(F.translate("p_name", "ebirdlmxw", "ACGTACGTA"), "[^ACGT]", ""))
    return d.part.select("p_partkey", seq.alias("seq")).select(
        "p_partkey", "seq", X.reverse_complement(F.col("seq")).alias("rc"), F.round(X.letter_share(F.col("seq"), "GC"), 6).alias("gc"))


@query("low_complexity", """
with s as (select doc_id, regexp_extract_all(text, '[A-Za-z]{3,}') as words from documents), w as (select doc_id, unnest(words) as w from s),
 k as (select distinct w from w), t as (select w, unnest(range(1, length(w) - 1)) as i from k),
 c as (select w, substr(w, i, 3) as tri, count(*) as n from t group by 1, 2), r as (select w, sum(n * (n - 1) / 2) as s, sum(n) as m from c group by 1)
select w as word, round(case when m >= 2 then s / (m * (m - 1) / 2) end, 6) as score from r""")
def _(d):
    words = d.documents.select(F.explode(F.regexp_extract_all("text", F.lit("[A-Za-z]{3,}"), F.lit(0))).alias("word")).distinct()
    return words.select("word", F.round(X.low_complexity(F.col("word")), 6).alias("score"))


@query("cigar_arithmetic", """
with c as (select distinct concat(l_suppkey % 7, 'S', cast(l_quantity as int), 'M', l_linenumber, 'I', l_partkey % 50, 'N', l_suppkey, 'M', cast(l_quantity as int) % 5, 'H') as cigar, l_linestatus from lineitem)
select cigar, l_linestatus, cast(list_sum(list_transform(regexp_extract_all(cigar, '([0-9]+)[MI]', 1), lambda x: cast(x as int))) as int) as qw,
  cast(list_sum(list_transform(regexp_extract_all(cigar, '([0-9]+)[MDN]', 1), lambda x: cast(x as int))) as int) as rw,
  cast(regexp_extract(cigar, '^([0-9]+)S', 1) as int) as cl, cast(regexp_extract(cigar, '([0-9]+)H$', 1) as int) as cr,
  case when l_linestatus = 'O' then 1000 + cast(list_sum(list_transform(regexp_extract_all(cigar, '([0-9]+)[MDN]', 1), lambda x: cast(x as int))) as int) - 1 else 1000 end as first_base from c""")
def _(d):
    i = lambda c: c.cast("string")
    cig = F.concat(i(F.col("l_suppkey") % 7), F.lit("S"), i(F.col("l_quantity").cast("int")), F.lit("M"), i(F.col("l_linenumber")), F.lit("I"),
                   i(F.col("l_partkey") % 50), F.lit("N"), i(F.col("l_suppkey")), F.lit("M"), i(F.col("l_quantity").cast("int") % 5), F.lit("H"))
    c = d.lineitem.select(cig.alias("cigar"), "l_linestatus").distinct()
    g = F.col("cigar")
    return c.select("cigar", "l_linestatus", X.query_width(g).alias("qw"), X.reference_width(g).alias("rw"), X.clip_left(g).alias("cl"), X.clip_right(g).alias("cr"),
                    X.first_aligned(F.lit(1000), g, F.when(F.col("l_linestatus") == "O", "-").otherwise("+")).alias("first_base"))


@query("normalised_alleles", """select var_id, pos + case when length(ref) = length(alt) and length(ref) > 1 and ref[1] = alt[1] then 1 else 0 end as pos,
  case when length(ref) = length(alt) and length(ref) > 1 and ref[1] = alt[1] then ref[2:] else ref end as ref,
  case when length(ref) = length(alt) and length(ref) > 1 and ref[1] = alt[1] then alt[2:] else alt end as alt
from (select var_id, pos, concat(ref, 'C') as ref, concat(alt, 'T') as alt from variant)""", ("variant",))
def _(d):
    v = d.variant.select("var_id", "pos", F.concat("ref", F.lit("C")).alias("ref"), F.concat("alt", F.lit("T")).alias("alt"))
    p, r, a = X.normalise_mnv(F.col("pos"), F.col("ref"), F.col("alt"))
    return v.select("var_id", p.alias("pos"), r.alias("ref"), a.alias("alt"))


@query("metadata_json", """select event_id, cast(json_extract_string(props, '$.k') as varchar) as k from events""")
def _(d):
    return d.events.select("event_id", F.from_json("props", "map<string,string>")["k"].alias("k"))


@query("chromosome_codes", """select c, case when c = 'X' then 23 when c = 'Y' then 24 when regexp_matches(c, '^[0-9]+$') then cast(c as int) end as code, count(*) as n from
 (select case when l_suppkey % 30 = 23 then 'X' when l_suppkey % 30 = 24 then 'Y' when l_suppkey % 30 > 24 then 'Un' else cast(l_suppkey % 30 as varchar) end as c from lineitem) group by 1, 2""")
def _(d):
    k = F.col("l_suppkey") % 30
    c = F.when(k == 23, "X").when(k == 24, "Y").when(k > 24, "Un").otherwise(k.cast("string"))
    return d.lineitem.select(c.alias("c")).withColumn("code", X.chromosome_code(F.concat(F.lit("chr"), "c"))).groupBy("c", "code").agg(F.count("*").alias("n"))


# ---------------------------------------------------------------- consequences, alleles, phasing

CSQ_SQL = """csq as (select concat(l_orderkey % 4000, ':', l_linenumber) as var_id, concat('F', l_partkey % 300, '.', l_linenumber) as feature,
    case when l_suppkey % 2 = 0 then 'RefSeq' else 'Ensembl' end as source, case l_suppkey % 4 when 0 then 'HIGH' when 1 then 'MODERATE' when 2 then 'LOW' else 'MODIFIER' end as impact,
    case when l_tax > 0.02 then '1/3' else '' end as exon, case when l_discount > 0.05 then '77' else '' end as protein_position, case when l_quantity > 20 then '9' else '' end as cdna_position,
    case when l_tax <= 0.02 then '2/2' else '' end as intron, case when l_partkey % 3 > 0 then 'protein_coding' else 'lincRNA' end as biotype from lineitem)"""


def _csq(d):
    return d.spark.sql("select * from (with " + CSQ_SQL.replace("from lineitem)", "from {lineitem})") + " select * from csq)", lineitem=d.lineitem).withColumns({
        "consequence": F.lit("x"), "hgvsc": F.concat(F.lit("NM:"), "exon"), "hgvsp": F.concat(F.lit("NP:"), "protein_position")})


IMPACT_SQL = """ case impact when 'HIGH' then 30 when 'MODERATE' then 20 when 'LOW' then 10 else 0 end + case when biotype <> 'protein_coding' then 0
   when exon <> '' and protein_position <> '' then 7 when exon <> '' and cdna_position <> '' then 5 when intron <> '' then 3 else 0 end """


@query("impact_score", f"with {CSQ_SQL} select var_id, feature, {IMPACT_SQL} as score, count(*) as n from csq group by all")
def _(d):
    return _csq(d).withColumn("score", V.impact_score()).groupBy("var_id", "feature", "score").agg(F.count("*").alias("n"))


@query("hgvs_equivalents", rf"""with {CSQ_SQL}, s as (select *, case when source = 'RefSeq' then regexp_extract(feature, '(.*)\.[0-9]+$', 1) else feature end as id_short from csq)
select var_id, exon as hgvsc_short, protein_position as hgvsp_short, string_agg(id_short, ';' order by id_short) as eq from s group by 1, 2, 3""")
def _(d):
    return V.resolve_ids(_csq(d)).select("var_id", "hgvsc_short", "hgvsp_short", F.col("hgvs_equivalent").alias("eq")).distinct()


PREF_SQL = """pref as (select concat('F', p_partkey % 300) as id_short, bool_or(p_size % 2 = 0) as known, bool_or(p_size = 7) as ccds, bool_or(p_size = 9) as lrg, bool_or(p_size = 11) as "select",
   bool_or(p_size = 13) as basic, bool_or(p_size = 15) as panel_old, bool_or(p_size = 17) as panel_new, bool_or(p_size = 19) as tsl1 from part group by 1)"""


def _prefs(d):
    return d.part.groupBy(F.concat(F.lit("F"), (F.col("p_partkey") % 300).cast("string")).alias("id_short")).agg(
        F.bool_or(F.col("p_size") % 2 == 0).alias("known"), *[F.bool_or(F.col("p_size") == v).alias(n) for n, v in
        [("ccds", 7), ("lrg", 9), ("select", 11), ("basic", 13), ("panel_old", 15), ("panel_new", 17), ("tsl1", 19)]])


def _scored(d):
    c = _csq(d).withColumn("id_short", F.regexp_extract("feature", r"(.*)\.[0-9]+$", 1)).withColumns({
        "canonical": F.when(F.col("exon") != "", "YES").otherwise(""), "pick": F.when(F.col("protein_position") != "", "1").otherwise(""),
        "flags": F.lit(""), "ccds": F.lit(""), "tsl": F.lit(""), "mane_select": F.when(F.col("impact") == "HIGH", F.col("intron")).otherwise(""),
        "symbol_source": F.when(F.col("cdna_position") == "", "Clone_based_ensembl_gene").otherwise("HGNC")})
    return V.with_preferences(c, _prefs(d)).withColumn("impact_score", V.impact_score()).withColumn("preference_score", V.preference_score())


SCORE_SQL = rf"""{CSQ_SQL}, {PREF_SQL}, j as (select c.*, regexp_extract(feature, '(.*)\.[0-9]+$', 1) as id_short from csq c),
 k as (select j.*, {IMPACT_SQL} as impact_score, coalesce(known, false) known, coalesce(ccds, false) ccds, coalesce(lrg, false) lrg, coalesce("select", false) sel, coalesce(basic, false) basic, coalesce(panel_old, false) v4,
   coalesce(panel_new, false) v6, coalesce(tsl1, false) tsl1, exon <> '' as can, protein_position <> '' as pick, impact = 'HIGH' and intron <> '' as mane, cdna_position <> '' as symok from j left join pref using (id_short)),
 a as (select *, case when not known then 0 when biotype = 'protein_coding' then 5 else 3 end as base from k),
 b as (select *, case when source = 'RefSeq' then case when sel then 40 when can and (v4 or ccds or lrg) then 30 when ccds or lrg then 20 when v4 then 10 else base end
    when symok then case when tsl1 then 40 when can and (basic or v4 or lrg or ccds) then 30 when lrg or ccds then 20 when basic or v4 then 10 else base end else base end as s1, source = 'RefSeq' or symok as lad from a),
 c2 as (select *, case when lad and s1 >= 30 and pick then 50 else s1 end as s2 from b), c3 as (select *, case when lad and s2 >= 20 and v6 then 60 else s2 end as s3 from c2),
 sc as (select *, case when mane then 70 else s3 end + case when source = 'Ensembl' then 1 else 0 end as preference_score from c3)"""


@query("preference_score", f"with {SCORE_SQL} select var_id, feature, source, impact_score, preference_score, count(*) as n from sc group by all")
def _(d):
    return _scored(d).groupBy("var_id", "feature", "source", "impact_score", "preference_score").agg(F.count("*").alias("n"))


@query("pick_consequence", f"""with {SCORE_SQL} select var_id, id_short, impact_score, preference_score from
  (select *, row_number() over (partition by var_id order by preference_score < 3, impact_score desc, preference_score desc, id_short) rn from sc) where rn = 1""")
def _(d):
    return V.pick_consequence(_scored(d)).select("var_id", "id_short", "impact_score", "preference_score")


@query("expand_alleles", """
with r as (select l_orderkey, l_linenumber, string_agg(alt, ',' order by alt) as alts, list(dep order by alt) as deps, list(alt order by alt) as al from
   (select l_orderkey, l_linenumber, concat('A', l_partkey) as alt, max(cast(l_quantity as bigint)) as dep from lineitem group by all) group by 1, 2)
select concat(l_orderkey, ':', l_linenumber) as site, concat('chr', l_linenumber, ':', l_orderkey, '_A/', al[i]) as var_id, al[i] as alt, 7 as ad_ref, coalesce(deps[i], 0) as ad_alt, deps[i] as af
from (select *, unnest(range(1, len(al) + 1)) as i from r)""")
def _(d):
    one = d.lineitem.groupBy("l_orderkey", "l_linenumber", F.concat(F.lit("A"), F.col("l_partkey").cast("string")).alias("a")).agg(F.max(F.col("l_quantity").cast("bigint")).alias("q"))
    rec = one.groupBy("l_orderkey", "l_linenumber").agg(F.array_sort(F.collect_list(F.struct("a", "q"))).alias("e")).select(
        F.concat(F.col("l_orderkey").cast("string"), F.lit(":"), F.col("l_linenumber").cast("string")).alias("site"),
        F.concat(F.lit("chr"), F.col("l_linenumber").cast("string")).alias("chr"), F.col("l_orderkey").alias("pos"), F.lit("A").alias("ref"),
        F.array_join("e.a", ",").alias("alt"), F.concat(F.array(F.lit(7).cast("bigint")), F.col("e.q")).alias("ad"), F.col("e.q").alias("af"))
    out = V.expand_alleles(rec, per_alt=["af"], per_allele=["ad"])
    return out.select("site", "var_id", "alt", F.col("ad_ref").cast("int").alias("ad_ref"), "ad_alt", "af")


@query("phased_merge", """
with v as (select distinct id, chr, pid, cast(pos as bigint) as pos, ref, alt, gene_id, dpt from variant),
 ph as (select *, pos + length(ref) - 1 as e from v where pid is not null), st as (select id, chr, pid, pos, max(e) as e from ph group by all),
 op as (select *, case when pos > max(e) over (partition by id, chr, pid order by pos rows between unbounded preceding and 1 preceding) + 31 then 1 else 0 end as o from st),
 cl as (select id, chr, pid, pos, sum(o) over (partition by id, chr, pid order by pos) as c from op), j as (select ph.*, c, count(*) over w as n, min(pos) over w as p0, max(e) over w as p1 from ph join cl using (id, chr, pid, pos) window w as (partition by id, chr, pid, c)),
 gap as (select g.* from (select id, chr, pid, c, unnest(range(p0, p1 + 1)) as pos from (select distinct id, chr, pid, c, p0, p1 from j where n > 1)) g where not exists (select 1 from j where j.id = g.id and j.chr = g.chr and j.pid = g.pid and j.c = g.c and g.pos between j.pos and j.e)),
 part as (select id, chr, pid, c, pos, e, ref, alt, gene_id, dpt from j where n > 1 union all select id, chr, pid, c, pos, pos, substr('ACGT', cast(pos % 4 + 1 as int), 1), substr('ACGT', cast(pos % 4 + 1 as int), 1), null, null from gap),
 m as (select id, chr, pid, min(pos) as pos, string_agg(ref, '' order by pos, e, ref, alt) as ref, string_agg(alt, '' order by pos, e, ref, alt) as alt,
   min({'p': pos, 'e': e, 'r': ref, 'a': alt, 'g': gene_id, 'd': dpt}) filter (gene_id is not null) as f from part group by id, chr, pid, c)
select id, pid, pos, ref, alt, f.g as gene_id, f.d as dpt, concat(chr, ':', pos, '_', ref, '/', alt) as var_id from m
union all select id, pid, pos, ref, alt, gene_id, dpt, concat(chr, ':', pos, '_', ref, '/', alt) from v where pid is null union all select id, pid, pos, ref, alt, gene_id, dpt, concat(chr, ':', pos, '_', ref, '/', alt) from j where n = 1""", ("variant",))
def _(d):
    v = d.variant.select("id", "chr", "pid", "pos", "ref", "alt", "gene_id", "dpt").distinct()
    near = v.filter("pid is not null").select("chr", F.explode(F.sequence(F.col("pos"), F.col("pos") + 40)).alias("pos")).distinct()
    return V.merge_phased(v, near.withColumn("base", F.substring(F.lit("ACGT"), (F.col("pos") % 4 + 1).cast("int"), F.lit(1))), 30).select("id", "pid", "pos", "ref", "alt", "gene_id", "dpt", "var_id")


@query("substitution_classes", r"""
with base as (select distinct 'c' as chr, l_partkey as pos, substr('ACGTTGCA', cast(l_partkey * 7 % 8 + 1 as int), 1) as b from lineitem),
 v as (select distinct l_partkey as pos, substr('ACGTTGCA', cast(l_partkey * 7 % 8 + 1 as int), 1) as ref, substr('GTAC', cast(l_suppkey % 4 + 1 as int), 1) as alt from lineitem),
 j as (select v.*, p.b as pb, n.b as nb from v left join base p on p.pos = v.pos - 1 left join base n on n.pos = v.pos + 1)
select pos, ref, alt, case when pb is not null and nb is not null then pb || ref || nb end as context, case when pb is null or nb is null then null when ref in ('A', 'G')
  then translate(nb, 'ACGT', 'TGCA') || '[' || translate(ref, 'ACGT', 'TGCA') || '>' || translate(alt, 'ACGT', 'TGCA') || ']' || translate(pb, 'ACGT', 'TGCA') else pb || '[' || ref || '>' || alt || ']' || nb end as sbs96 from j""")
def _(d):
    base = F.substring(F.lit("ACGTTGCA"), (F.col("l_partkey") * 7 % 8 + 1).cast("int"), F.lit(1))
    bases = d.lineitem.select(F.lit("c").alias("chr"), F.col("l_partkey").alias("pos"), base.alias("base")).distinct()
    v = d.lineitem.select(F.lit("c").alias("chr"), F.col("l_partkey").alias("pos"), base.alias("ref"), F.substring(F.lit("GTAC"), (F.col("l_suppkey") % 4 + 1).cast("int"), F.lit(1)).alias("alt")).distinct()
    return V.add_context(v, bases).drop("chr")


@query("signature_counts", """with c as (select distinct consequence as k from variant), i as (select distinct id from variant),
 n as (select id, consequence as k, count(*) as n from variant where adt_fwd >= 2 and adt_rev >= 2 and sor < 4 and mqrs > -3 and mqs > 23 and ((adn = 0 and nlod > 6) or nlod > 20) and nn = 0 and pon is null and aft > 0.015 and tlod > 6 group by 1, 2)
select i.id, c.k as sbs96, coalesce(n.n, 0) as n from i cross join c left join n on n.id = i.id and n.k = c.k""", ("variant",))
def _(d):
    v = d.variant.withColumn("sbs96", F.col("consequence"))
    return V.signature_counts(V.signature_quality(v), v, ids=v)


@query("annotate_regions", """
with s as (select distinct chr, pos, ref from variant), h as (select s.chr, s.pos, s.ref, string_agg(distinct g.gene_id, ',' order by g.gene_id) as hits
   from s join gene g on g.chr = s.chr and g.start <= s.pos + length(s.ref) - 1 and g."end" >= s.pos group by all)
select v.var_id, h.hits from variant v left join h on h.chr = v.chr and h.pos = v.pos and h.ref = v.ref""", ("variant", "gene"))
def _(d):
    return V.annotate_regions(d.variant, d.gene, "gene_id", "hits").select("var_id", "hits")


@query("annotate_exact", """select v.var_id, min(s.gene_id_1) as known from variant v left join structural s on s.chr1 = v.chr and s.pos1 = v.pos and s.aft > 0.05 group by v.var_id, v.id, v.pos, v.gene_id, v.adt, v.sor, v.xfet, v.tlod""", ("variant", "structural"))
def _(d):
    v = d.variant.dropDuplicates(["var_id", "id", "pos", "gene_id", "adt", "sor", "xfet", "tlod"])
    src = d.structural.filter("aft > 0.05").select(F.col("chr1").alias("chr"), F.col("pos1").alias("pos"), F.col("gene_id_1").alias("known"))
    return V.annotate_exact(v, src, ["known"], keys=("chr", "pos")).select("var_id", "known")


@query("knowledge_rollup", """
with e as (select l_partkey as variant_id, l_returnflag || l_linestatus as disease, case l_suppkey % 5 when 0 then 'Diagnostic' when 1 then 'Predictive' when 2 then 'Predisposing' when 3 then 'Prognostic' else 'Functional' end as t,
    l_tax > 0.03 as sup from lineitem), c as (select variant_id, disease, count(*) as n from e group by 1, 2), x as (select variant_id, string_agg(disease || ':' || n, '|' order by disease || ':' || n) as diseases from c group by 1)
select variant_id, diseases, bool_or(sup and t = 'Diagnostic') as diagnostic, bool_or(sup and t = 'Predictive') as predictive, bool_or(sup and t = 'Predisposing') as predisposing, bool_or(sup and t = 'Prognostic') as prognostic
from e join x using (variant_id) group by 1, 2""")
def _(d):
    t = F.element_at(F.array(*[F.lit(x) for x in ("Diagnostic", "Predictive", "Predisposing", "Prognostic", "Functional")]), (F.col("l_suppkey") % 5 + 1).cast("int"))
    e = d.lineitem.select(F.col("l_partkey").alias("variant_id"), F.concat("l_returnflag", "l_linestatus").alias("disease"), t.alias("evidence_type"),
                          F.when(F.col("l_tax") > 0.03, "Supports").otherwise("Against").alias("evidence_direction"))
    return V.knowledge_rollup(e)
