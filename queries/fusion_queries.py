"""Fusion, gene-model, source and dataset queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortloom.operators import fusions as FU
from cohortloom.operators import genemodel as GM
from cohortloom.operators.common import keep, whole_groups, with_group
from cohortloom.session import cut_lineage
from cohortloom.sources import readers as RD
from cohortloom.sources import writers as WR
from cohortloom.streaming import incremental as INC
from queries.registry import query

R = lambda c, n=6: F.round(c, n).alias(c)
O = FU.FusionOptions(jnc_ovr=10, max_ovr=20, err=0.06, low=0.05, unq_ovr=1, sum_unq=1.0, sum_jnc=1, dst_spl=1000, chm_hi=1.0, rec_ts=2, rec_chm=2)


def _jnc(d):
    return d.junction.withColumns({"seg_5_cig": F.lit("1M"), "seg_3_cig": F.lit("1M"), "ftype": F.when(F.col("seg_5_len") % 2 == 0, "pe").otherwise("se")})


JK = "id, type, chr_5, pos_5, str_5, chr_3, pos_3, str_3"
BPT = f"""jq as (select *, 1.0 / count(*) over (partition by {JK}) as unq_jnc from junction), bpt as (select {JK}, count(*) as sum_jnc, sum(cast(hq_jnc as int)) as hq_sum_jnc, sum(unq_jnc) as unq_sum_jnc, avg(err_5) as avg_err_5, avg(low_3) as avg_low_3, max(ovr_5) as max_ovr_5, count(distinct ovr_3) as unq_ovr_3, avg(err_3) as avg_err_3, avg(low_5) as avg_low_5, max(ovr_3) as max_ovr_3, count(distinct ovr_5) as unq_ovr_5 from jq group by all)"""


def _by_sample(d):
    """Tasks to deal the samples' junctions to, or None if one sample is too large for a task."""
    if "by_sample" not in d.__dict__:
        d.by_sample = whole_groups(d.junction, "id")
    return d.by_sample


def _bpt(d):
    tasks = _by_sample(d)
    j = d.junction.repartition(tasks, "id") if tasks else cut_lineage(d.junction)
    j = with_group(j, FU.KEY, {"unq_jnc": F.count("*")}, whole=bool(tasks))
    return FU.collapse_junctions(j.withColumn("unq_jnc", 1.0 / F.col("unq_jnc")))


@query("collapse_junctions", f"with {BPT} select {JK}, sum_jnc, cast(hq_sum_jnc as bigint) as hq_sum_jnc, round(unq_sum_jnc, 6) as unq_sum_jnc, round(avg_err_5, 6) as avg_err_5, round(avg_low_3, 6) as avg_low_3, max_ovr_5, unq_ovr_3 from bpt", ("junction",))
def _(d):
    return _bpt(d).select(*FU.KEY, "sum_jnc", "hq_sum_jnc", R("unq_sum_jnc"), R("avg_err_5"), R("avg_low_3"), "max_ovr_5", "unq_ovr_3")


@query("junction_quality", """select qname, id, case when type < 0 then ovr_5 > 0.4 * seg_5_len and ovr_3 > 0.4 * seg_3_len else ovr_5 + ovr_3 > 0.4 * case when seg_5_len % 2 = 0 then seg_5_len + seg_3_len else seg_5_len end and ovr_5 > 10 and ovr_3 > 10 end
  and err_5 < 0.09 and err_3 < 0.07 + 0.02 and low_5 < 0.045 and low_3 < 0.045 as hq_jnc from junction""", ("junction",))
def _(d):
    return FU.junction_quality(_jnc(d).drop("hq_jnc"), FU.FusionOptions(jnc_ovr=10, jnc_ovr_pct=0.4, jnc_err=0.09, jnc_low=0.045)).select("qname", "id", "hq_jnc")


# Features: donor and acceptor sites and exons spread along four axes.
FEAT = """feat as (select 'chr' || (p_partkey % 4 + 1) as chr, cast(p_partkey % 100 * 1000 as bigint) as start, cast(p_partkey % 100 * 1000 + case when p_size % 5 < 2 then 0 else 600 end as bigint) as "end", case when p_size % 2 = 0 then '+' else '-' end as strand,
   case p_size % 5 when 0 then 'D' when 1 then 'A' when 2 then 'E' else 'G' end as type, case p_size % 5 when 0 then 0 when 1 then 0 when 2 then 4 else 7 end as ord from part)"""


def _feat(d):
    s = F.col("p_size") % 5
    f = d.part.select(F.concat(F.lit("chr"), (F.col("p_partkey") % 4 + 1).cast("string")).alias("chr"), (F.col("p_partkey") % 100 * 1000).alias("start"), (F.col("p_partkey") % 100 * 1000 + F.when(s < 2, 0).otherwise(600)).alias("end"),
                      F.when(F.col("p_size") % 2 == 0, "+").otherwise("-").alias("strand"), F.when(s == 0, "D").when(s == 1, "A").when(s == 2, "E").otherwise("G").alias("type"), F.when(s < 2, 0).when(s == 2, 4).otherwise(7).alias("ord"))
    w = d.part.select(F.concat(F.lit("chr"), (F.col("p_partkey") % 4 + 1).cast("string")).alias("chr")).distinct().select("chr", F.lit(0).cast("bigint").alias("start"), F.lit(10_000_000).cast("bigint").alias("end"), F.lit("*").alias("strand"), F.lit(".").alias("type"), F.lit(8).alias("ord"))
    return f.unionByName(w).distinct()


ALLF = f"""{FEAT}, af as (select distinct * from feat union select distinct chr, 0, 10000000, '*', '.', 8 from feat)"""


@query("orient_junctions", f"""with {ALLF}, pts as (select distinct c, p, s from (select chr_5 as c, pos_5 as p from junction union select chr_3, pos_3 from junction) cross join (select unnest(['+', '-']) as s)),
 cl as (select c, p, s, type from (select c, p, s, f.type, row_number() over (partition by c, p, s order by ord, f.start, f."end", f.type) rn from pts join af f on f.chr = c and f.start <= p + 2 and f."end" >= p - 2 and (f.strand = s or f.strand = '*')) where rn = 1),
 sc as (select * from (values ('D','D',1),('A','D',1),('E','D',1),('G','D',1),('.','D',1),('D','A',16),('A','A',1),('E','A',14),('G','A',12),('.','A',10),('D','E',15),('A','E',1),('E','E',9),('G','E',7),('.','E',5),('D','G',13),('A','G',1),('E','G',8),('G','G',4),('.','G',2),('D','.',11),('A','.',1),('E','.',6),('G','.',3),('.','.',0)) v(f5, f3, val)),
 j as (select x.*, v1.val as fw, v2.val as rv from junction x join cl a on a.c = chr_5 and a.p = pos_5 and a.s = str_5 join cl b on b.c = chr_3 and b.p = pos_3 and b.s = str_3 join cl c on c.c = chr_3 and c.p = pos_3 and c.s <> str_3 join cl e on e.c = chr_5 and e.p = pos_5 and e.s <> str_5
   join sc v1 on v1.f5 = a.type and v1.f3 = b.type join sc v2 on v2.f5 = c.type and v2.f3 = e.type),
 k as (select *, case when type = 1 then false when fw > rv then false when rv > fw then true when chr_5 < chr_3 then false when chr_5 > chr_3 then true when pos_5 < pos_3 then false when pos_5 > pos_3 then true when str_5 < str_3 then false when str_5 > str_3 then true else false end as sw from j)
select qname, id, case when sw then chr_3 else chr_5 end as chr_5, case when sw then pos_3 else pos_5 end as pos_5, case when sw then case when str_3 = '+' then '-' else '+' end else str_5 end as str_5, case when sw then ovr_5 else ovr_3 end as ovr_3 from k""", ("junction",))
def _(d):
    return FU.orient_junctions(_jnc(d), _feat(d)).select("qname", "id", "chr_5", "pos_5", "str_5", "ovr_3")


ENDS = """labels as (select distinct chr, start, "end", label from (select 'chr' || (p_partkey % 4 + 1) as chr, cast(p_partkey % 100 * 1000 as bigint) as start, cast(p_partkey % 100 * 1000 + 40 as bigint) as "end", case when p_type = 'ECONOMY' then 'alu' when p_type = 'PROMO' then 'sim' when p_type = 'LARGE' then 'l1' when p_type = 'MEDIUM' then 'rep' end as label from part where p_size < 6) where label is not null)"""


def _masks(d):
    lab = F.when(F.col("p_type") == "ECONOMY", "alu").when(F.col("p_type") == "PROMO", "sim").when(F.col("p_type") == "LARGE", "l1").when(F.col("p_type") == "MEDIUM", "rep")
    return d.part.filter("p_size < 6").select(F.concat(F.lit("chr"), (F.col("p_partkey") % 4 + 1).cast("string")).alias("chr"), (F.col("p_partkey") % 100 * 1000).alias("start"), (F.col("p_partkey") % 100 * 1000 + 40).alias("end"), lab.alias("label")).filter("label is not null").distinct()


ARTS = f"""{BPT}, {ENDS}, pr as (select * from (values ('rep', 1), ('l1', 4), ('alu', 16), ('sim', 25)) v(label, pr)),
 ml as (select b.*, (select max(pr) from labels l join pr using (label) where l.chr = chr_5 and l.start <= case when str_5 = '+' then pos_5 + 4 else pos_5 + 10 end and l."end" >= case when str_5 = '+' then pos_5 - 10 else pos_5 - 4 end) as m5,
   (select max(pr) from labels l join pr using (label) where l.chr = chr_3 and l.start <= case when str_3 = '+' then pos_3 + 10 else pos_3 + 4 end and l."end" >= case when str_3 = '+' then pos_3 - 4 else pos_3 - 10 end) as m3 from bpt b),
 nm as (select *, case coalesce(m5, 0) when 0 then 'nil' when 1 then 'rep' when 4 then 'l1' when 16 then 'alu' else 'sim' end as art_5, case coalesce(m3, 0) when 0 then 'nil' when 1 then 'rep' when 4 then 'l1' when 16 then 'alu' else 'sim' end as art_3 from ml),
 ar as (select *, (art_5 = 'l1' and art_3 = 'l1') or (art_5 = 'alu' and art_3 <> 'nil') or (art_3 = 'alu' and art_5 <> 'nil') or art_5 = 'sim' or art_3 = 'sim' as art from nm)"""


def _art(d):
    return FU.label_artifacts(keep(_bpt(d), "id", _by_sample(d)), _masks(d), o=O)


@query("label_artifacts", f"with {ARTS} select {JK}, art_5, art_3, art from ar", ("junction",))
def _(d):
    return _art(d).select(*FU.KEY, "art_5", "art_3", "art")


# Loci: both strands cut into stretches of 10 kb.
LOC = """ar2 as (select *, chr_5 || ':' || pos_5 // 10000 || str_5 as l51, chr_3 || ':' || pos_3 // 10000 || str_3 as l31, chr_3 || ':' || pos_3 // 10000 || case when str_3 = '+' then '-' else '+' end as r5, chr_5 || ':' || pos_5 // 10000 || case when str_5 = '+' then '-' else '+' end as r3 from ar)"""


def _loci(d):
    c = d.lineitem.select(F.concat(F.lit("chr"), (F.col("l_linenumber") % 4 + 1).cast("string")).alias("chr")).distinct()
    s = c.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(9)))).withColumn("strand", F.explode(F.array(F.lit("+"), F.lit("-"))))
    return s.select("chr", (F.col("k") * 10000).cast("bigint").alias("start"), (F.col("k") * 10000 + 9999).cast("bigint").alias("end"), "strand", F.concat("chr", F.lit(":"), F.col("k").cast("string"), "strand").alias("locus_id"))


@query("associate_loci", f"""with {ARTS}, {LOC} select {JK}, l51 as locus_id_5_1, l31 as locus_id_3_1, case when l51 = r5 and l31 = r3 then r3 else r5 end as locus_id_5_2, case when l51 = r5 and l31 = r3 then r5 else r3 end as locus_id_3_2 from ar2""", ("junction",))
def _(d):
    return FU.associate_loci(_art(d), _loci(d)).select(*FU.KEY, "locus_id_5_1", "locus_id_3_1", "locus_id_5_2", "locus_id_3_2")


TOPO = f"""{ARTS}, {LOC}, tp as (select *, case when l51 = r5 and l31 = r3 then r3 else r5 end as l52, case when l51 = r5 and l31 = r3 then r5 else r3 end as l32, case when chr_5 = chr_3 then abs(pos_5 - pos_3) else 2147483647 end as bp_dst, pos_5 // 10000 as k5, pos_3 // 10000 as k3 from ar2),
 dt as (select *, case when bp_dst < 500 then 'frg' when l51 = l31 or l51 = l52 or l31 = l32 or (l51 = l32 and l31 = l52) then 'loc' when chr_5 = chr_3 and abs(k5 - k3) = 1 then 'adj' when chr_5 = chr_3 and k5 // 3 = k3 // 3 then 'cyt' when chr_5 = chr_3 and (k5 < 5) = (k3 < 5) then 'arm' when chr_5 = chr_3 then 'chr' else 'gme' end as dst from tp),
 tt as (select *, case when dst = 'gme' then 'tloc' when str_5 <> str_3 then 'inv' when (str_5 = '+' and k5 > k3) or (str_5 = '-' and k5 < k3) or (k5 = k3) then 'dup' else 'del' end as topo, type = 1 as d2a from dt),
 lv as (select *, case when type > -1 then 'spn' else 'enc' end as l1, case when topo = 'tloc' or (topo = 'inv' and dst not in ('frg', 'loc')) or (topo in ('dup', 'del') and dst not in ('frg', 'loc', 'adj')) then 'dist' else 'prox' end as l2 from tt)"""


def _topo(d):
    loci = cut_lineage(_loci(d))
    tasks = _by_sample(d)
    b = keep(FU.associate_loci(keep(_art(d), "id", tasks), loci), "id", tasks)
    b = b.withColumn("bp_dst", F.when(F.col("chr_5") == F.col("chr_3"), F.abs(F.col("pos_5") - F.col("pos_3"))).otherwise(FU.FAR)).withColumn("d2a", F.col("type") == 1)
    k = F.floor(F.col("start") / 10000)
    cyt = loci.select("locus_id", F.concat("chr", F.floor(k / 3).cast("string")).alias("cytoband"), F.when(k < 5, "p").otherwise("q").alias("arm"))
    return keep(FU.levels(FU.topology_breakpoints(b, loci, cyt, GM.adjacent_loci(loci), O)), "id", tasks)


@query("topology_levels", f"with {TOPO} select {JK}, dst, topo, l1, l2, count(case when type > -1 then 1 end) over (partition by id, l51, l31, l52, l32) as sum_bpt from lv", ("junction",))
def _(d):
    return _topo(d).select(*FU.KEY, "dst", "topo", "l1", "l2", "sum_bpt")


HQ = """hq as (select *, art_5 <> 'aln' and art_3 <> 'aln' and ((((art_5 = 'nil' and art_3 = 'nil') or d2a) and hq_sum_jnc >= 1) or hq_sum_jnc >= 3) and ((((art_5 = 'nil' and art_3 = 'nil') or d2a) and unq_sum_jnc >= 1) or unq_sum_jnc >= 3) and ((((art_5 = 'nil' and art_3 = 'nil') or d2a) and sum_jnc >= 1) or sum_jnc >= 3)
   and (topo in ('inv', 'tloc') or bp_dst > 1000) and (((art_5 = 'nil' or d2a) and unq_ovr_5 >= 1) or unq_ovr_5 >= 3) and (((art_3 = 'nil' or d2a) and unq_ovr_3 >= 1) or unq_ovr_3 >= 3) and (((art_5 = 'nil' or d2a) and max_ovr_5 >= 20) or max_ovr_5 >= 60) and (((art_3 = 'nil' or d2a) and max_ovr_3 >= 20) or max_ovr_3 >= 60)
   and (((art_5 = 'nil' or d2a) and avg_err_5 <= 0.0605) or avg_err_5 <= 0.0605 / 3) and (((art_3 = 'nil' or d2a) and avg_err_3 <= 0.0605) or avg_err_3 <= 0.0605 / 3) and (((art_5 = 'nil' or d2a) and avg_low_5 <= 0.0405) or avg_low_5 <= 0.0405 / 3) and (((art_3 = 'nil' or d2a) and avg_low_3 <= 0.0405) or avg_low_3 <= 0.0405 / 3) as hq_bpt from lv)"""
OH = FU.FusionOptions(jnc_ovr=10, max_ovr=20, err=0.0605, low=0.0405, unq_ovr=1, sum_unq=1.0, sum_jnc=1, dst_spl=1000, chm_hi=1.0, rec_ts=2, rec_chm=2)


@query("hq_breakpoints", f"with {TOPO}, {HQ} select {JK}, hq_bpt from hq", ("junction",))
def _(d):
    return FU.high_quality(_topo(d), OH).select(*FU.KEY, "hq_bpt")


@query("hi_hc_breakpoints", f"""with {TOPO}, s as (select *, (l51 like '%:3_' or l31 like '%:3_' or l52 like '%:3_' or l32 like '%:3_') and art_5 not in ('aln', 'gtb', 'cmt') and art_3 not in ('aln', 'gtb', 'cmt') as sel, l1 = 'spn' and l2 = 'prox' and (topo = 'inv' or not d2a) as use from lv),
 g as (select *, sum(case when sel then unq_sum_jnc end) over w > 1 as a, bool_and(case when sel then dst not in ('frg', 'loc') end) over w as b, bool_or(case when sel then type > -1 and d2a end) over w as c, sum(cast(use as int)) over w as n from s window w as (partition by id, l51, l31, l52, l32))
select {JK}, sel and coalesce(a and b and c, false) as hi_bpt, use and n >= 2 as hc_bpt from g""", ("junction",))
def _(d):
    imp = _loci(d).filter(F.col("locus_id").rlike(":3.$"))
    return FU.clustered(keep(FU.high_importance(_topo(d), imp, OH), "id", _by_sample(d)), OH).select(*FU.KEY, "hi_bpt", "hc_bpt")


HR = """us as (select *, l1 = 'spn' and l2 = 'dist' and d2a and art_5 not in ('rpx', 'ret', 'cmt') and art_3 not in ('rpx', 'ret', 'cmt') as use from lv),
 rc as (select *, case when use then sum(cast(use as int)) over (partition by id, chr_5, pos_5, str_5) else 0 end as rec_5, case when use then sum(cast(use as int)) over (partition by id, chr_3, pos_3, str_3) else 0 end as rec_3 from us),
 d5 as (select id, chr_5, pos_5, str_5, count(distinct l31 || '|' || l52) as u5 from us where use group by all), d3 as (select id, chr_3, pos_3, str_3, count(distinct l51 || '|' || l32) as u3 from us where use group by all),
 ru as (select rc.*, case when rec_5 > 1 then u5 when use then 1 else 0 end as unq_rec_5, case when rec_3 > 1 then u3 when use then 1 else 0 end as unq_rec_3 from rc left join d5 using (id, chr_5, pos_5, str_5) left join d3 using (id, chr_3, pos_3, str_3)),
 hr as (select *, bool_or(unq_rec_5 >= 2 or unq_rec_3 >= 2) over (partition by id, l1, chr_5, pos_5, str_5) or bool_or(unq_rec_5 >= 2 or unq_rec_3 >= 2) over (partition by id, l1, chr_3, pos_3, str_3) as hr_bpt from ru)"""


@query("hr_breakpoints", f"with {TOPO}, {HR} select {JK}, cast(rec_5 as bigint) as rec_5, unq_rec_5, hr_bpt from hr", ("junction",))
def _(d):
    return FU.recurrent(_topo(d), OH).select(*FU.KEY, "rec_5", F.col("unq_rec_5").cast("bigint").alias("unq_rec_5"), "hr_bpt")


@query("link_and_chain")
def _(d):
    b = keep(FU.high_importance(FU.high_quality(_topo(d), OH), _loci(d).filter(F.col("locus_id").rlike(":3.$")), OH), "id", _by_sample(d))
    b = keep(FU.clustered(FU.recurrent(b, OH), OH), "id", _by_sample(d))
    return FU.chain_breakpoints(cut_lineage(FU.link_breakpoints(b))).select(*FU.KEY, "l3", "sv_link", "sv_chain", "bs_link", "bs_chain")


@query("topology_signature", f"""with {TOPO}, o as (select id, topo, dst from (select *, row_number() over (partition by id, l51, l31, l52, l32 order by topo, dst) rn from lv) where rn = 1), n as (select id, topo, dst, count(*) as n from o group by all), f as (select *, n / sum(n) over (partition by id) as f from n),
 g as (select i.id, t.t, s.s from (select distinct id from lv) i cross join (select unnest(['inv', 'dup', 'del', 'tloc']) as t) t cross join (select unnest(['adj', 'cyt', 'arm', 'chr', 'gme']) as s) s) select g.id, g.t as topo, g.s as dst, coalesce(f.n, 0) as event_n, round(coalesce(f.f, 0), 6) as event_frq from g left join f on f.id = g.id and f.topo = g.t and f.dst = g.s""", ("junction",))
def _(d):
    return FU.topology_signature(_topo(d)).select("id", "topo", "dst", "event_n", R("event_frq"))


@query("locus_counts", f"""with {TOPO}, a as (select id, l51 as locus_id, sum(case when l1 = 'spn' and l2 = 'dist' and d2a then sum_jnc end) as x from lv group by 1, 2), b as (select id, l31 as locus_id, sum(case when l1 = 'enc' and l2 = 'prox' and not d2a then sum_jnc end) as y from lv group by 1, 2),
 l as (select distinct 'chr' || (l_linenumber % 4 + 1) || ':' || k || s as locus_id from lineitem cross join (select unnest(range(0, 10)) as k) cross join (select unnest(['+', '-']) as s))
select i.id, l.locus_id, cast(coalesce(x, 0) as bigint) as spn_dist_mot_5, cast(coalesce(y, 0) as bigint) as enc_prox_lig_3 from (select distinct id from lv) i cross join l left join a on a.id = i.id and a.locus_id = l.locus_id left join b on b.id = i.id and b.locus_id = l.locus_id where l.locus_id like 'chr1%'""", ("junction",))
def _(d):
    return FU.locus_counts(_topo(d), _loci(d)).filter("locus_id like 'chr1%'").select("id", "locus_id", "spn_dist_mot_5", "enc_prox_lig_3")


@query("library_rates", f"""with {TOPO}, fr as (select id, sum(width) / 2 as n from segment group by 1), s as (select id, sum(case when art then sum_jnc end) as a, sum(case when art_5 = 'nil' and art_3 = 'nil' and l2 = 'dist' and not d2a then unq_sum_jnc end) as du, sum(case when art_5 = 'nil' and art_3 = 'nil' and l2 = 'dist' and not d2a then sum_jnc end) as dt,
   sum(case when l1 = 'spn' and l2 = 'dist' then sum_jnc end) as sd, sum(case when not art and l2 = 'dist' then sum_jnc end) as dn from lv group by 1)
select s.id, round(coalesce(a, 0) / fr.n, 6) as art_rte, round(1 - du / dt, 6) as dup_rte, round(sd / dn, 6) as s2e_dist_rte from s join fr on fr.id = s.id""", ("junction", "segment"))
def _(d):
    b = _topo(d).withColumns({"mot_5": F.lit("AAAAAAGTAAAAAA"), "mot_3": F.lit("AAAAAAAGAAAAAA")})
    fr = FU.library_fragments(d.segment.select("id", F.col("width").alias("reads")))
    return FU.library_rates(b, fr).select("id", R("art_rte"), R("dup_rte"), R("s2e_dist_rte"))


@query("best_junction", f"""select {JK}, qname from (select *, row_number() over (partition by {JK} order by case when hq_jnc then 1 else 10000 end * abs(least(ovr_5, ovr_3) / case when ovr_5 < ovr_3 then seg_5_len else seg_3_len end - 0.5), qname) rn from junction) where rn = 1""", ("junction",))
def _(d):
    return FU.best_junction(d.junction).select(*FU.KEY, "qname")


@query("splice_totals", f"""with sj as (select id, chr, start, "end", case when strand1 = '*' then '+' else strand1 end as strand, n from (select id, chr1 as chr, pos1 % 97000 // 1000 * 1000 as start, pos1 % 89000 // 1000 * 1000 as "end", strand1, cast(adt as int) as n from structural)),
 a as (select id, chr, case when strand = '+' then start else "end" end as p, strand, sum(n) as t from sj group by all) select j.qname, j.id, cast(coalesce(a.t, 0) as bigint) as tot_sp_jnc_5 from junction j left join a on a.id = j.id and a.chr = j.chr_5 and a.p = j.pos_5 and a.strand = j.str_5""", ("junction", "structural"))
def _(d):
    sj = d.structural.select("id", F.col("chr1").alias("chr"), (F.floor(F.col("pos1") % 97000 / 1000) * 1000).alias("start"), (F.floor(F.col("pos1") % 89000 / 1000) * 1000).alias("end"), F.when(F.col("strand1") == "*", "+").otherwise(F.col("strand1")).alias("strand"), F.col("adt").cast("int").alias("nfrag"))
    return FU.add_splice_totals(d.junction, sj).select("qname", "id", "tot_sp_jnc_5")


@query("pair_alignments", """with r as (select o_orderkey, l_suppkey, l_linenumber, l_partkey, l_returnflag from lineitem join orders on l_orderkey = o_orderkey), n as (select *, count(*) over (partition by o_orderkey) as n, row_number() over (partition by o_orderkey order by l_partkey, l_suppkey) as i from r)
select a.o_orderkey as contig_id, 'chr' || a.l_linenumber as x_chr_5, case when a.l_returnflag = 'A' then a.l_suppkey + 50 else a.l_suppkey end as x_pos_5, 'chr' || b.l_linenumber as x_chr_3, case when b.l_returnflag = 'A' then b.l_suppkey else b.l_suppkey + 50 end as x_pos_3 from n a join n b on a.o_orderkey = b.o_orderkey and a.i = 1 and b.i = 2 where a.n = 2""")
def _(d):
    r = d.lineitem.join(d.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_orderkey").alias("contig_id"), (F.col("l_partkey") * 1000 + F.col("l_suppkey")).alias("first_base_q"), F.concat(F.lit("chr"), F.col("l_linenumber").cast("string")).alias("rname"),
        F.when(F.col("l_returnflag") == "A", "+").otherwise("-").alias("strand"), F.lit(60).alias("mapq"), F.col("l_suppkey").alias("first_base_r"), (F.col("l_suppkey") + 50).alias("last_base_r"))
    return FU.pair_alignments(r).select("contig_id", "x_chr_5", "x_pos_5", "x_chr_3", "x_pos_3")


# ---------------------------------------------------------------- gene model

EX = """ex as (select 'T' || (p_partkey // 5) as transcript_id, 'chr' || (p_partkey // 5 % 3 + 1) as chr, cast(p_partkey * 500 + 1 as bigint) as start, cast(p_partkey * 500 + 50 + p_size * 3 as bigint) as "end", case when p_partkey // 5 % 2 = 0 then '+' else '-' end as strand from part)"""


def _exons(d):
    k = F.floor(F.col("p_partkey") / 5)
    return d.part.select(F.concat(F.lit("T"), k.cast("string")).alias("transcript_id"), F.concat(F.lit("chr"), (k % 3 + 1).cast("string")).alias("chr"), (F.col("p_partkey") * 500 + 1).alias("start"), (F.col("p_partkey") * 500 + 50 + F.col("p_size") * 3).alias("end"), F.when(k % 2 == 0, "+").otherwise("-").alias("strand"))


@query("transcript_positions", f"""with {EX}, o as (select *, coalesce(sum("end" - start + 1) over (partition by transcript_id order by case when strand = '-' then -start else start end rows between unbounded preceding and 1 preceding), 0) as off from ex)
select l.k, o.transcript_id, cast(off + case when strand = '-' then "end" - l.pos else l.pos - start end + 1 as bigint) as tx_pos from (select distinct l_orderkey * 10 + l_linenumber as k, 'chr' || (l_linenumber % 3 + 1) as chr, l_partkey * 500 + l_suppkey as pos from lineitem) l join o on o.chr = l.chr and l.pos between o.start and o."end" """)
def _(d):
    p = d.lineitem.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("k"), F.concat(F.lit("chr"), (F.col("l_linenumber") % 3 + 1).cast("string")).alias("chr"), (F.col("l_partkey") * 500 + F.col("l_suppkey")).alias("pos")).distinct()
    return GM.to_transcript(p, _exons(d), ["k", "chr", "pos"]).select("k", "transcript_id", "tx_pos")


@query("coding_frames", f"""with {EX}, c as (select *, "end" - start + 1 as n, sum("end" - start + 1) over (partition by transcript_id order by case when strand = '-' then -start else start end) as cum from ex)
select distinct chr, strand, cast(case when strand = '+' then "end" + 1 else start - 1 end as bigint) as start, cast(cum % 3 as int) as frame, 'D' as type from c union select chr, strand, cast(case when strand = '+' then start - 1 else "end" + 1 end as bigint), cast((cum - n) % 3 as int), 'A' from c""")
def _(d):
    return GM.coding_frames(_exons(d)).select("chr", "strand", "start", "frame", "type")


@query("introns", f"""with {EX}, n as (select *, lead(start) over (partition by transcript_id order by start) as nx from ex) select transcript_id, "end" + 1 as start, nx - 1 as "end" from n where nx is not null and "end" + 1 <= nx - 1""")
def _(d):
    return GM.introns(_exons(d)).select("transcript_id", "start", "end")


@query("make_loci", """with g as (select chr, strand, start, "end" from gene where strand <> '*'), o as (select *, case when start > max("end") over (partition by chr, strand order by start, "end" rows between unbounded preceding and 1 preceding) + 1 then 1 else 0 end as op from g),
 m as (select chr, strand, min(start) as start, max("end") as "end" from (select *, sum(op) over (partition by chr, strand order by start, "end") as k from o) group by chr, strand, k),
 e as (select * from m union all select chr, s, 0, 0 from sizes cross join (select unnest(['+', '-']) as s) union all select chr, s, length + 1, length + 1 from sizes cross join (select unnest(['+', '-']) as s)),
 h as (select chr, strand, lag("end") over (partition by chr, strand order by start, "end") + 1 as a, start - 1 as b from e)
select chr, strand, start, "end", true as genic from m union all select chr, strand, a, b, false from h where a <= b""", ("gene", "sizes"))
def _(d):
    return GM.make_loci(d.gene, d.sizes).select("chr", "strand", "start", "end", "genic")


@query("homopolymers", r"""with t as (select doc_id, translate(substr(text, 1, length(text)), 'eau', 'AAA') as s from documents), p as (select doc_id, s, unnest(range(1, length(s) + 1)) as i from t), c as (select doc_id, i, substr(s, i, 1) as b, substr(s, i - 1, 1) as pb from p), f as (select doc_id, i, b, case when i = 1 or b <> pb then 1 else 0 end as op from c),
 g as (select doc_id, i, b, sum(op) over (partition by doc_id order by i) as k from f) select 'd' || doc_id as chr, cast(min(i) as bigint) as start, cast(max(i) as bigint) as "end" from g where b = 'A' group by doc_id, k having count(*) >= 3""")
def _(d):
    w = 400
    t = d.documents.select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("chr"), F.translate("text", "eau", "AAA").alias("s"))
    n = F.floor((F.length("s") - 1) / w).cast("int")
    ch = t.filter(F.length("s") > 0).withColumn("chunk", F.explode(F.sequence(F.lit(0), n))).select("chr", F.col("chunk").cast("bigint").alias("chunk"), F.substring("s", F.col("chunk") * w + 1, F.lit(w)).alias("seq"))
    return GM.homopolymers(ch, w, "A", 3).select("chr", "start", "end")


@query("window_sequence", """select k, pos, substr(text, cast(pos - 7 as int), 15) as motif from (select conv_id * 1000 + turn as k, text, unnest(range(11, length(text) + 1, 32)) as pos from (select conv_id, turn, min(text) as text from conversations group by 1, 2))""")
def _(d):
    t = d.conversations.groupBy("conv_id", "turn").agg(F.min("text").alias("text")).select((F.col("conv_id") * 1000 + F.col("turn")).alias("k"), "text")
    c = t.select(F.col("k").cast("string").alias("chr"), F.explode(F.sequence(F.lit(0), F.floor((F.length("text") - 1) / 32).cast("int"))).alias("chunk"), "text")
    ch = c.select("chr", F.col("chunk").cast("bigint").alias("chunk"), F.substring("text", F.col("chunk") * 32 + 1, F.lit(32)).alias("seq"))
    p = t.filter(F.length("text") >= 11).select("k", F.col("k").cast("string").alias("chr"), F.explode(F.sequence(F.lit(11).cast("bigint"), F.length("text").cast("bigint"), F.lit(32).cast("bigint"))).alias("pos"))
    return GM.window_sequence(p, GM.with_reach(ch, 14), 32, 7).select("k", "pos", "motif")


# ---------------------------------------------------------------- sources, writers, incremental

@query("parse_variant_lines", """select l_orderkey, l_linenumber, l_partkey, l_suppkey, 'chr' || l_linenumber as chr, l_partkey as pos, case when l_suppkey % 3 = 0 then null else l_tax end as af, l_returnflag = 'R' as somatic, cast(l_quantity as int) as ad2, l_suppkey as dp, 'HIGH' as impact from lineitem""")
def _(d):
    s = lambda c: F.col(c).cast("string")
    line = F.concat_ws("\t", F.concat(F.lit("chr"), s("l_linenumber")), s("l_partkey"), F.lit("."), F.lit("A"), F.lit("T"), F.lit("50"), F.lit("PASS"),
                       F.concat(F.lit("AF="), F.when(F.col("l_suppkey") % 3 == 0, ".").otherwise(s("l_tax")), F.when(F.col("l_returnflag") == "R", ";SOMATIC").otherwise(""), F.lit(";CSQ=T|HIGH|x,T|LOW|y")),
                       F.lit("GT:AD:DP"), F.concat(F.lit("0/1:7,"), F.col("l_quantity").cast("int").cast("string"), F.lit(":"), s("l_suppkey")))
    out = RD.parse_variant_lines(d.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", line.alias("value")), ["t"], {"AF": "double", "SOMATIC": "boolean"}, {"AD": "array<int>", "DP": "bigint"}, ["Allele", "IMPACT", "Gene"])
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "chr", "pos", "af", "somatic", F.col("ad_t")[1].alias("ad2"), F.col("dp_t").alias("dp"), F.col("csq")[0]["impact"].alias("impact"))


@query("parse_gene_model", """select 'G' || p_partkey as gene_id, case when p_size % 4 = 0 then 'G' || p_partkey else p_name end as gene_name, p_partkey * 10 as start, p_type as gene_biotype from part""")
def _(d):
    s = lambda c: F.col(c).cast("string")
    at = F.concat(F.lit('gene_id "G'), s("p_partkey"), F.lit('"; '), F.when(F.col("p_size") % 4 == 0, "").otherwise(F.concat(F.lit('gene_name "'), "p_name", F.lit('"; '))), F.lit('gene_biotype "'), "p_type", F.lit('";'))
    line = F.concat_ws("\t", F.lit("chr1"), F.lit("x"), F.lit("gene"), (F.col("p_partkey") * 10).cast("string"), (F.col("p_partkey") * 10 + 5).cast("string"), F.lit("."), F.lit("+"), F.lit("."), at)
    return GM.parse_gene_model(d.part.select(line.alias("value"))).select("gene_id", "gene_name", "start", "gene_biotype")


@query("parse_config", """select l_orderkey as k, 'ID' as variable, l_shipmode as value from (select l_orderkey, min(l_returnflag || '=' || l_linestatus) as l_shipmode from lineitem group by 1)""")
def _(d):
    t = d.lineitem.groupBy(F.col("l_orderkey").alias("k")).agg(F.min(F.concat("l_returnflag", F.lit("="), "l_linestatus")).alias("v"))
    return RD.parse_config(t.select("k", F.concat(F.lit('ID="'), "v", F.lit('"')).alias("value")))


@query("alignment_tags", """with h as (select l_orderkey as q, l_linenumber as hit, min(l_partkey * 1000000 + cast(l_quantity as int) * 1000 + l_suppkey) as m from lineitem group by 1, 2), t as (select *, count(*) over (partition by q) as n, row_number() over (partition by q order by hit) as i from h)
select a.q as qname, cast(a.m // 1000 % 1000 + 2 * (a.m % 1000) as double) as ovr_5, cast(b.m // 1000 % 1000 + 2 * (b.m % 1000) as double) as ovr_3 from t a join t b on a.q = b.q and a.i = 1 and b.i = 2 where a.n = 2""")
def _(d):
    s = lambda c: c.cast("string")
    t = d.lineitem.select(F.col("l_orderkey").alias("qname"), F.col("l_linenumber").alias("hit"), F.concat(F.lit("AS:i:"), s(F.col("l_quantity").cast("int"))).alias("as_tag"), F.concat(F.lit("NM:i:"), s(F.col("l_suppkey"))).alias("nm_tag"), F.lit(50).alias("len"),
                          (F.col("l_partkey") * 1000000 + F.col("l_quantity").cast("int") * 1000 + F.col("l_suppkey")).alias("ord"))
    return RD.alignment_tags(t, keys=()).select("qname", "ovr_5", "ovr_3")


@query("splice_junctions", """select l_orderkey as start, l_partkey as "end", case l_linenumber when 1 then '+' when 2 then '-' else '*' end as strand, cast(l_quantity as int) as nfrag, count(*) as n from lineitem where l_quantity > 1 group by all""")
def _(d):
    t = d.lineitem.select(F.lit("c").alias("chr"), F.col("l_orderkey").alias("start"), F.col("l_partkey").alias("end"), F.col("l_linenumber").alias("strand_code"), F.lit(1).alias("motif"), F.col("l_quantity").cast("int").alias("unique_reads"))
    return RD.splice_junctions(t).groupBy("start", "end", "strand", "nfrag").agg(F.count("*").alias("n"))


@query("parse_metrics", """select cast(o_custkey as varchar) as id, 'N' as variable, cast(n as varchar) as value from (select o_custkey, count(*) as n from orders group by 1) union all select cast(o_custkey as varchar), 'CATEGORY', 'PAIR' from (select distinct o_custkey from orders)""")
def _(d):
    g = d.orders.groupBy(F.col("o_custkey").cast("string").alias("id")).agg(F.count("*").cast("string").alias("n"))
    lines = g.select("id", F.posexplode(F.array(F.lit("# made by"), F.lit(""), F.lit("CATEGORY\tN"), F.lit("FIRST\t0"), F.concat(F.lit("PAIR\t"), "n"))).alias("ord", "value"))
    return RD.parse_metrics(lines, category=("CATEGORY", "PAIR"))


@query("zero_based_ranges", """select distinct 'chr' || (p_partkey % 7 + 1) as chr, p_partkey * 10 as start, p_partkey * 10 + 4 as "end" from part where p_partkey % 7 < 5""")
def _(d):
    t = d.part.select((F.col("p_partkey") % 7 + 1).cast("string").alias("chr"), (F.col("p_partkey") * 10).alias("start"), (F.col("p_partkey") * 10 + 4).alias("end"))
    sizes = d.part.select(F.concat(F.lit("chr"), (F.col("p_partkey") % 5 + 1).cast("string")).alias("chr")).distinct()
    return WR.zero_based(RD.shift_ranges(t, sizes)).select("chr", "start", "end").distinct()


@query("new_groupings", """select distinct c_mktsegment, c_nationkey from customer where not exists (select 1 from customer k where k.c_acctbal > 8000 and k.c_mktsegment = customer.c_mktsegment and k.c_nationkey = customer.c_nationkey)""")
def _(d):
    cols = ("c_mktsegment", "c_nationkey")
    t = d.customer.withColumn("c_nationkey", F.col("c_nationkey").cast("string"))
    return INC.new_groupings(t, t.filter("c_acctbal > 8000"), cols).select("c_mktsegment", F.col("c_nationkey").cast("int").alias("c_nationkey"))


@query("gene_index", """select gene_id, cast(row_number() over (order by gene_id) as int) as idx from gene""", ("gene",))
def _(d):
    return INC.gene_index(d.gene).select("gene_id", "idx")


@query("merge_metadata", """select event_id, case when n is null then k else n end as k, case when n is null then null else 'x' end as z from (select event_id, json_extract_string(props, '$.k') as k, case when user_id % 3 = 0 then cast(user_id as varchar) end as n from events)""")
def _(d):
    upd = d.events.filter("user_id % 3 = 0").select("event_id", F.inline(F.array(F.struct(F.lit("k").alias("name"), F.col("user_id").cast("string").alias("value")), F.struct(F.lit("z").alias("name"), F.lit("x").alias("value")), F.struct(F.lit("w").alias("name"), F.lit("NA").alias("value")))))
    out = INC.merge_metadata(d.events.select("event_id", "props"), upd, "event_id", "props").withColumn("m", F.from_json("props", "map<string,string>"))
    return out.select("event_id", F.col("m")["k"].alias("k"), F.col("m")["z"].alias("z"))


@query("missing_rows", "select o_orderkey, o_orderpriority from orders except select o_orderkey, o_orderpriority from orders where o_totalprice > 100000")
def _(d):
    c = ["o_orderkey", "o_orderpriority"]
    return INC.missing_rows(d.orders.select(*c), d.orders.filter("o_totalprice > 100000").select(*c))


@query("dataset_subset_genes", """select id, var_id, gene_id, count(*) as n from variant where (id, var_id) in (select (id, var_id) from variant where gene_id in (select gene_id from gene where gene_name in ('N5', 'N77', 'N1001'))) group by all""", ("variant", "gene"))
def _(d):
    from cohortloom import CohortDataset

    v = d.variant
    ds = CohortDataset.build(d.spark, {"somatic": v}, {"somatic": v.select("id", "var_id", "gene_id")}, d.meta, d.gene)
    return ds.subset_genes(names=["N5", "N77", "N1001"]).table("somatic").groupBy("id", "var_id", "gene_id").agg(F.count("*").alias("n"))


@query("dataset_stack_versions", """select id, count(*) as n, count(ccf) as with_ccf from (select id, ccf from variant where adt > 30 union all select id, null from variant where adt <= 30) group by 1""", ("variant",))
def _(d):
    from cohortloom import CohortDataset

    v = d.variant
    mk = lambda t, ver: CohortDataset.build(d.spark, {"somatic": t}, {}, d.meta, d.gene, version=ver)
    ds = CohortDataset.stack([mk(v.filter("adt > 30"), "v3"), mk(v.filter("adt <= 30"), "v2").with_version("v3")])
    return ds.table("somatic").groupBy("id").agg(F.count("*").alias("n"), F.count("ccf").alias("with_ccf"))
