"""Further operators on the role tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortloom.operators import cohort as C
from cohortloom.operators import copynumber as N
from cohortloom.operators import fusions as FU
from cohortloom.operators import genemodel as GM
from cohortloom.operators import structural as SV
from cohortloom.operators import triage as T
from cohortloom.operators import variants as V
from queries.fusion_queries import EX, _exons
from queries.registry import query

R = lambda c, n=6: F.round(c, n).alias(c)


@query("promoter_preferred", """with f as (select gene_id, chr, start, "end", case when strand = '*' then '+' else strand end as strand from gene), p as (select f.gene_id, s.var_id, row_number() over (partition by f.gene_id order by s.start, s."end") rn from f join segment s on s.chr = f.chr and case when strand_f = '-' then f."end" else f.start end between s.start and s."end"),
 b as (select f.gene_id, s.var_id, row_number() over (partition by f.gene_id order by s.start, s."end") rn from f join segment s on s.chr = f.chr and s.start <= f."end" and s."end" >= f.start)
select f.gene_id, coalesce(p.var_id, b.var_id) as var_id from f left join p on p.gene_id = f.gene_id and p.rn = 1 left join b on b.gene_id = f.gene_id and b.rn = 1""".replace("strand_f", "f.strand"), ("gene", "segment"))
def _(d):
    g = d.gene.withColumn("strand", F.when(F.col("strand") == "*", "+").otherwise(F.col("strand")))
    return N.promoter_preferred(g, d.segment, ["var_id"], ["gene_id"]).select("gene_id", "var_id")


@query("all_gene_segments", """select s.id, g.gene_id, s.seg, round(s.sC, 4) as "sC" from gene g join segment s on s.chr = g.chr and s.start <= g."end" and s."end" >= g.start""", ("gene", "segment"))
def _(d):
    return N.all_gene_segments(d.segment, d.gene).select("id", "gene_id", "seg", "sC")


@query("gene_tile_states", """with t as (select distinct s.id, g.gene_id, s.C, s.K from gene g join segment s on s.chr = g.chr and s.start <= g."end" and s."end" >= g.start) select id, gene_id, C as "C", K as "K" from (select *, count(*) over (partition by id, gene_id) as n from t) where not (n > 1 and coalesce(C = 2 and K = 1, false))""", ("gene", "segment"))
def _(d):
    return N.gene_tile_states(d.segment, d.gene).select("id", "gene_id", "C", "K")


@query("attach_segments", """select id, var_id, "seg_C" from (select v.id, v.var_id, s.C as "seg_C", row_number() over (partition by v.id, v.var_id order by s.start) rn from (select distinct id, var_id, chr, pos from variant) v left join segment s on s.id = v.id and s.chr = v.chr and v.pos between s.start - 300 and s."end" + 300) where rn = 1""", ("variant", "segment"))
def _(d):
    v = d.variant.select("id", "var_id", "chr", "pos").distinct()
    return N.attach_segments(v, d.segment, ["id", "var_id"], ["C"], q=("pos", "pos"), maxgap=299).select("id", "var_id", "seg_C")


@query("segment_export", """select id as sample, cast(substr(chr, 4) as int) as chromosome, start as start_pos, "end" as end_pos, cast(nlr as bigint) as num_markers, lr as seg_cn from segment""", ("segment",))
def _(d):
    return N.segment_export(d.segment, "lr", "nlr")


@query("major_allele_share", """select id, chr as seg, round(sum(case when aft > 0.5 then aft * dpt else (1 - aft) * dpt end) / sum(dpt), 6) as mzd from variant group by 1, 2""", ("variant",))
def _(d):
    return N.major_allele_share(d.variant.select("id", F.col("chr").alias("seg"), F.col("aft").alias("af"), F.col("dpt").alias("dp"))).select("id", "seg", R("mzd"))


@query("expression_wide", """select gene_id, cast(max(case when id = '1' then count end) as bigint) as s1, cast(max(case when id = '20' then count end) as bigint) as s20, cast(max(case when id = '300' then count end) as bigint) as s300 from expression group by 1""", ("expression",))
def _(d):
    w = C.expression_wide(d.expression.withColumn("gene_name", F.col("gene_id")), "count", ["1", "20", "300"])
    return w.select("gene_id", F.col("1").alias("s1"), F.col("20").alias("s20"), F.col("300").alias("s300"))


@query("transcripts_to_genes", """select cast(o_custkey as varchar) as id, 'B' || p_brand as gene_id, sum(l_quantity) as est_counts, round(sum(l_tax), 6) as tpm from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey group by 1, 2""")
def _(d):
    a = d.lineitem.join(d.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(F.col("o_custkey").cast("string").alias("id"), F.col("l_partkey").alias("target_id"), F.col("l_quantity").alias("est_counts"), F.col("l_tax").alias("tpm"))
    t = d.part.select(F.col("p_partkey").alias("target_id"), F.concat(F.lit("B"), "p_brand").alias("gene_id"))
    return C.transcripts_to_genes(a, t).select("id", "gene_id", "est_counts", R("tpm"))


@query("viewer_filter", """select id, var_id, gene_id from variant where impact in ('HIGH', 'MODERATE') and (gene_id in (select gene_id from gene where somatic_art) or coalesce(adn < 2, false) or coalesce(ecnt = 7, false))""", ("variant", "gene"))
def _(d):
    v = d.variant.withColumn("cn", F.col("adn")).withColumn("k", F.when(F.col("ecnt") == 7, 0).otherwise(1))
    return C.viewer_filter(v, impact=True, two_hit=d.gene.filter("somatic_art")).select("id", "var_id", "gene_id")


@query("dictionary_projection", """select gene_name as "Gene", aft as "AF", var_id as "ID" from variant""", ("variant",))
def _(d):
    rows = [{"table": "somatic", "db_name": a, "display_name": b, "show_table": c, "show_detail": True} for a, b, c in
            [("gene_name", "Gene", True), ("aft", "AF", True), ("var_id", "ID", True), ("chr", "Chr", False)]]
    return C.select_by_dictionary(d.variant, rows, "somatic")


@query("annotate_fusions", """with f as (select id, gene_id_1 g1, gene_id_2 g2, case when gene_id_1 is null and gene_id_2 is not null then chr1 else coalesce(gene_id_1, '') end as a, case when gene_id_2 is null and gene_id_1 is not null then chr2 else coalesce(gene_id_2, '') end as b, case when gene_id_1 is not null and gene_id_2 is not null then 'fusion5' when gene_id_1 is not null then 'truncation' end as c5, case when gene_id_1 is not null and gene_id_2 is not null then 'fusion3' when gene_id_2 is not null then 'start-loss' end as c3 from structural)
select distinct id, a as gene_id, c5 as annotation, case when c5 like 'fusion%' then c5 else 'structural' end || '-' || b as type_partner_gene from f where c5 is not null union select distinct id, b, c3, case when c3 like 'fusion%' then c3 else 'structural' end || '-' || a from f where c3 is not null""", ("structural",))
def _(d):
    g = lambda n: F.coalesce(F.col(f"gene_id_{n}"), F.lit(""))
    f = d.structural.select("id", g("1").alias("gene_ids_5_1"), g("1").alias("gene_names_5_1"), g("2").alias("gene_ids_3_1"), g("2").alias("gene_names_3_1"), *[F.lit("").alias(f"gene_{k}_{e}") for k in ("ids", "names") for e in ("5_2", "3_2")],
                            F.col("chr1").alias("cyt_5_1"), F.col("chr2").alias("cyt_3_1"), F.lit("").alias("cyt_5_2"), F.lit("").alias("cyt_3_2"))
    return SV.annotate_fusions(SV.fusion_consequence(f)).select("id", "gene_id", "annotation", "type_partner_gene").distinct()


@query("fusion_display", """select var_id, id, case when a <> '' then a when d <> '' then '(' || d || ')' else chr1 end as gene_5, chr1 || ':' || pos1 || ':' || strand1 as junction_5, cast(adt as bigint) + 3 as total_reads, case when qual > 50000 then 'yes' else '' end as hq from (select *, coalesce(gene_name_1, '') as a, coalesce(gene_name_2, '') as d from structural)""", ("structural",))
def _(d):
    s = d.structural
    b = lambda n: F.coalesce(F.col(f"gene_name_{n}"), F.lit(""))
    lit = {"triage": F.lit(None).cast("string"), "gene_names_5_1": b("1"), "gene_names_3_2": b("2"), "gene_names_3_1": b("2"), "gene_names_5_2": b("1"), "cyt_5_1": F.col("chr1"), "cyt_3_1": F.col("chr2"), "chr_5": F.col("chr1"), "pos_5": F.col("pos1"),
           "str_5": F.col("strand1"), "chr_3": F.col("chr2"), "pos_3": F.col("pos2"), "str_3": F.col("strand2"), "sum_jnc": F.col("adt").cast("bigint"), "l1": F.lit("spn"), "tot_enc": F.lit(3), "tot_jnc": F.col("adt").cast("bigint"), "sum_bpt": F.lit(1),
           "d2a": F.lit(True), "hq_bpt": F.col("qual") > 50000, "ts_warn": F.lit(False), "orf": F.lit(True), "dst": F.lit("gme"), "topo": F.lit("tloc"), "mm2_valid": F.lit(True), "gmap_valid": F.lit(True), "tot_jnc_5": F.lit(1), "tot_sp_jnc_5": F.lit(0),
           "tot_jnc_3": F.lit(1), "tot_sp_jnc_3": F.lit(0), "unq_rec_5": F.lit(1), "unq_rec_3": F.lit(1), "art_5": F.lit("nil"), "art_3": F.lit("nil"), "sv_chain": F.lit("x")}
    return SV.format_fusions(s.withColumns(lit)).select("var_id", "id", "gene_5", "junction_5", "total_reads", "hq")


@query("pair_consequence", """with c as (select distinct l_orderkey as k, 'T' || l_partkey as id_short, l_suppkey % 4 * 10 as imp, cast(l_quantity as int) % 60 as pref from lineitem),
 p as (select x.k, x.id_short, greatest(x.imp, y.imp) as pi, greatest(x.pref, y.pref) as pp from c x join c y on x.k = y.k and x.id_short = y.id_short), j as (select p.*, c.imp, c.pref from p join c on c.k = p.k and c.id_short = p.id_short),
 r as (select *, row_number() over (partition by k order by pp < 3, pi desc, pp desc, pref < 3, imp desc, pref desc, id_short) as rn from j)
select k || e as var_id, id_short, imp as impact_score, pref as preference_score, pi as pair_impact from r cross join (select unnest(['a', 'b']) as e) where rn = 1""")
def _(d):
    e = lambda s: F.concat(F.col("l_orderkey").cast("string"), F.lit(s))
    csq = d.lineitem.select(F.explode(F.array(e("a"), e("b"))).alias("var_id"), F.concat(F.lit("N"), F.col("l_partkey").cast("string")).alias("symbol"), F.concat(F.lit("T"), F.col("l_partkey").cast("string")).alias("id_short"),
                            (F.col("l_suppkey") % 4 * 10).alias("impact_score"), (F.col("l_quantity").cast("int") % 60).alias("preference_score")).distinct()
    pairs = d.lineitem.select(F.concat(e("a"), F.lit(":"), e("b")).alias("bnd_id"), e("a").alias("id1"), e("b").alias("id2"), (F.col("l_orderkey") % 2 == 0).alias("proximal")).distinct()
    return V.pick_pair_consequence(csq, pairs).select("var_id", "id_short", "impact_score", "preference_score", "pair_impact")


@query("coding_bounds", f"""with {EX}, o as (select *, coalesce(sum("end" - start + 1) over (partition by transcript_id order by case when strand = '-' then -start else start end rows between unbounded preceding and 1 preceding), 0) as off from ex),
 c as (select transcript_id, strand, min(start) + 20 as a, max("end") - 10 as b from ex group by 1, 2), p as (select transcript_id, case when strand = '-' then b else a end as p1, case when strand = '-' then a else b end as pn from c),
 q as (select o.transcript_id, max(case when p1 between start and "end" then off + case when strand = '-' then "end" - p1 else p1 - start end + 1 end) as cds1, max(case when pn between start and "end" then off + case when strand = '-' then "end" - pn else pn - start end + 1 end) as cdsn from o join p using (transcript_id) group by 1)
select transcript_id, cast(coalesce(cds1, 1) as bigint) as cds1, cast(coalesce(cdsn, 0) as bigint) as cdsn from q""")
def _(d):
    ex = _exons(d)
    cds = ex.groupBy("transcript_id", "chr", "strand").agg((F.min("start") + 20).alias("start"), (F.max("end") - 10).alias("end"))
    return GM.coding_bounds(cds, ex).select("transcript_id", "cds1", "cdsn")


@query("transcript_sequences", """select 'd' || (doc_id // 10) as transcript_id, string_agg(text, '' order by doc_id) as seq from documents group by 1""")
def _(d):
    ex = d.documents.select(F.concat(F.lit("d"), F.floor(F.col("doc_id") / 10).cast("string")).alias("transcript_id"), F.col("doc_id").alias("start"), F.lit("+").alias("strand"), F.col("text").alias("seq"))
    return GM.transcript_sequences(ex)


@query("transcript_distance", f"""with {EX}, o as (select *, coalesce(sum("end" - start + 1) over (partition by transcript_id order by case when strand = '-' then -start else start end rows between unbounded preceding and 1 preceding), 0) as off from ex),
 j as (select distinct l_linenumber as t, 'chr' || (l_partkey % 3 + 1) as c5, l_partkey * 500 + l_suppkey as p5, 'chr' || (l_partkey % 3 + 1) as c3, l_partkey * 500 + 500 + l_suppkey * 2 as p3 from lineitem),
 ob as (select o.*, unnest(range(start // 1000, "end" // 1000 + 1)) as bin from o),
 x5 as (select c5, p5, transcript_id, off + case when strand = '-' then "end" - (p5 - 1) else p5 - 1 - start end + 1 as t5 from (select distinct c5, p5 from j) j join ob on ob.chr = c5 and ob.bin = (p5 - 1) // 1000 where p5 - 1 between start and "end"),
 x3 as (select c3, p3, transcript_id, off + case when strand = '-' then "end" - (p3 + 1) else p3 + 1 - start end + 1 as t3 from (select distinct c3, p3 from j) j join ob on ob.chr = c3 and ob.bin = (p3 + 1) // 1000 where p3 + 1 between start and "end"),
 m as (select j.*, x5.transcript_id, t5, t3 from j join x5 on x5.c5 = j.c5 and x5.p5 = j.p5 join x3 on x3.c3 = j.c3 and x3.p3 = j.p3 and x3.transcript_id = x5.transcript_id),
 r as (select *, row_number() over (partition by t, c5, p5, c3, p3 order by abs(t5 - t3), transcript_id) rn from m)
select cast(j.t as int) as type, j.p5 as pos_5, j.p3 as pos_3, cast(-(r.t5 - r.t3) as bigint) as tx_dst, j.p5 - j.p3 as gx_dst, cast(least(abs(coalesce(r.t5 - r.t3, 2147483647)), abs(j.p5 - j.p3)) as bigint) as bp_dst from j left join r on rn = 1 and r.t = j.t and r.p5 = j.p5 and r.p3 = j.p3 and r.c5 = j.c5""")
def _(d):
    c = F.concat(F.lit("chr"), (F.col("l_partkey") % 3 + 1).cast("string"))
    b = d.lineitem.select(F.lit("s").alias("id"), F.col("l_linenumber").alias("type"), c.alias("chr_5"), (F.col("l_partkey") * 500 + F.col("l_suppkey")).alias("pos_5"), F.lit("+").alias("str_5"), c.alias("chr_3"), (F.col("l_partkey") * 500 + 500 + F.col("l_suppkey") * 2).alias("pos_3"), F.lit("+").alias("str_3")).distinct()
    return FU.transcript_distance(b, _exons(d)).select("type", "pos_5", "pos_3", "tx_dst", "gx_dst", "bp_dst")


@query("locus_splices", """with l as (select 'chr' || (p_partkey % 7 + 1) as chr, cast(p_partkey // 10 * 100000 as bigint) as start, cast(p_partkey // 10 * 100000 + 50000 as bigint) as "end", 'L' || (p_partkey // 10) || '_' || (p_partkey % 7) as locus_id from part group by all),
 j as (select cast(l_suppkey % 5 as varchar) as sid, 'chr' || l_linenumber as chr, l_orderkey * 1000 as start, l_orderkey * 1000 + l_partkey as "end", cast(l_quantity as int) as n from lineitem),
 a as (select sid, locus_id, count(*) as nsj, sum(n) as f from j join l on l.chr = j.chr and l.start <= j."end" and l."end" >= j.start group by 1, 2), g as (select s.sid, l.locus_id, coalesce(a.nsj, 0) as nsj, coalesce(a.f, 0) as f from (select distinct sid from j) s cross join l left join a on a.sid = s.sid and a.locus_id = l.locus_id)
select sid, locus_id, nsj, round(f / (sum(f) over (partition by sid) / 1e6), 4) as cspm from g""")
def _(d):
    k = F.floor(F.col("p_partkey") / 10)
    l = d.part.select(F.concat(F.lit("chr"), (F.col("p_partkey") % 7 + 1).cast("string")).alias("chr"), (k * 100000).alias("start"), (k * 100000 + 50000).alias("end"), F.lit("*").alias("strand"), F.concat(F.lit("L"), k.cast("string"), F.lit("_"), (F.col("p_partkey") % 7).cast("string")).alias("locus_id")).distinct()
    j = d.lineitem.select((F.col("l_suppkey") % 5).cast("string").alias("sid"), F.concat(F.lit("chr"), F.col("l_linenumber").cast("string")).alias("chr"), (F.col("l_orderkey") * 1000).alias("start"), (F.col("l_orderkey") * 1000 + F.col("l_partkey")).alias("end"), F.lit("+").alias("strand"), F.col("l_quantity").cast("int").alias("nfrag"))
    return GM.locus_splices(j, l).select("sid", "locus_id", "nsj", R("cspm", 4))


@query("clean_gene_model", """with t as (select 'G' || (p_partkey // 2) as gene_id, 'T' || p_partkey as tid, cast(p_partkey // 2 * 1000 + p_size * 20 as bigint) as start, cast(p_partkey // 2 * 1000 + p_size * 20 + 300 as bigint) as "end", p_partkey % 4 < 2 as coding from part),
 k as (select * from t where coding union all select * from t n where not coding and not exists (select 1 from t p where p.coding and p.start <= n."end" and p."end" >= n.start)) select gene_id, min(start) as start, max("end") as "end" from k group by 1""")
def _(d):
    g = F.concat(F.lit("G"), F.floor(F.col("p_partkey") / 2).cast("string"))
    bio = F.when(F.col("p_partkey") % 4 < 2, "protein_coding").otherwise("lincRNA")
    s = F.floor(F.col("p_partkey") / 2) * 1000 + F.col("p_size") * 20
    base = d.part.select(F.lit("chr1").alias("chr"), F.lit("x").alias("source"), F.lit("transcript").alias("type"), s.alias("start"), (s + 300).alias("end"), F.lit("+").alias("strand"), g.alias("gene_id"), bio.alias("gene_biotype"),
                         F.concat(F.lit("T"), F.col("p_partkey").cast("string")).alias("transcript_id"), bio.alias("transcript_biotype"), F.lit(None).cast("int").alias("exon_number"), F.lit("").alias("tags"), F.lit("ABC1").alias("gene_name"))
    genes = base.groupBy("chr", "source", "strand", "gene_id", "gene_biotype", "gene_name").agg(F.min("start").alias("start"), F.max("end").alias("end")).withColumns({"type": F.lit("gene"), "transcript_id": F.lit(""), "transcript_biotype": F.lit(""), "exon_number": F.lit(None).cast("int"), "tags": F.lit("")})
    return GM.clean_gene_model(base.unionByName(genes)).filter("type = 'gene'").select("gene_id", "start", "end").distinct()


@query("forest_pass", """select id, var_id, coalesce((case when tlod > 20 and adt > 20 then mqs > 22 else tlod > 10 and coalesce(pon, '') = '' and dbsnp is null end or tlod > 15 and nlod > 20 and flod > 16 and sor < 3 and xfet < 1e-4 and adt_fwd >= 5 and adt_rev >= 5 and adn <= 2)
  and impact in ('HIGH', 'MODERATE'), false) as pass from variant""", ("variant",))
def _(d):
    from pyspark.ml import PipelineModel
    from pyspark.ml.feature import SQLTransformer

    # A fixed tree stands in for the user's fitted model.
    tree = "select *, cast(case when tlod > 20 and adt > 20 then mqs > 22 else tlod > 10 and gdc_mask = 0 and in_dbsnp = 0 end as double) as prediction from __THIS__"
    v = d.variant.withColumn("oxog", F.lit(None).cast("double"))
    return T.forest_pass(PipelineModel([SQLTransformer(statement=tree)]), v, rescue=True).select("id", "var_id", "pass")
