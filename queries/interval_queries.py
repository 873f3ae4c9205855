"""Interval join and range algebra queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortloom.operators import intervals as I
from cohortloom.operators.common import runs, scan
from queries.registry import query

OV = 's.start <= q."end" and s."end" >= q.start'


def _genes(d):
    return d.gene.select("chr", "start", "end", "strand", "gene_id")


def _segs(d):
    return d.segment.select("id", "chr", "start", "end", "strand", "var_id", "C")


@query("overlap_join", f"""select q.gene_id, s.var_id, s.id from gene q join segment s on s.chr = q.chr and {OV}""", ("gene", "segment"))
def _(d):
    return I.overlap_join(_genes(d), _segs(d)).select("gene_id", F.col("s_var_id").alias("var_id"), F.col("s_id").alias("id"))


@query("overlap_maxgap", """select q.gene_id, count(*) as n, min(s.start) as first_start from gene q join segment s on s.chr = q.chr and s.start <= q."end" + 501 and s."end" >= q.start - 501 group by 1""", ("gene", "segment"))
def _(d):
    return I.overlap_join(_genes(d), _segs(d), maxgap=500, bin_width=4096, max_bins=16).groupBy("gene_id").agg(
        F.count("*").alias("n"), F.min("s_start").alias("first_start"))


@query("overlap_minoverlap_stranded", """select q.gene_id, s.gene_id as other, least(q."end", s."end") - greatest(q.start, s.start) + 1 as w from gene q join (select chr, start - 20000 as start, "end" + 20000 as "end", strand, gene_id from gene) s
 on s.chr = q.chr and least(q."end", s."end") - greatest(q.start, s.start) + 1 >= 500 and (q.strand = s.strand or q.strand = '*' or s.strand = '*')""", ("gene",))
def _(d):
    g = _genes(d)
    wide = I.resize(g, 20000)
    return I.overlap_join(g, wide, minoverlap=500, strand="strand", bin_width=1000, max_bins=8).select(
        "gene_id", F.col("s_gene_id").alias("other"), I.overlap_width().alias("w"))


@query("overlap_by_sample", """select v.var_id, v.id, s.var_id as seg from variant v join segment s on s.id = v.id and s.chr = v.chr and v.pos between s.start and s."end" """, ("variant", "segment"))
def _(d):
    return I.overlap_join(d.variant.select("id", "chr", "pos", "var_id"), _segs(d), keys=("id", "chr"), q=("pos", "pos")).select(
        "var_id", "id", F.col("s_var_id").alias("seg"))


@query("first_overlap", f"""select gene_id, var_id from (select q.gene_id, s.var_id, row_number() over (partition by q.gene_id order by s.start, s.var_id) rn from gene q join segment s on s.chr = q.chr and {OV}) where rn = 1""", ("gene", "segment"))
def _(d):
    return I.first_overlap(_genes(d), _segs(d), ["gene_id"], ["start", "var_id"]).select("gene_id", F.col("s_var_id").alias("var_id"))


@query("largest_overlap", f"""select gene_id, var_id, w from (select q.gene_id, s.var_id, least(q."end", s."end") - greatest(q.start, s.start) + 1 as w,
  row_number() over (partition by q.gene_id order by least(q."end", s."end") - greatest(q.start, s.start) desc, s.start, s.var_id) rn from gene q join segment s on s.chr = q.chr and {OV}) where rn = 1""", ("gene", "segment"))
def _(d):
    return I.largest_overlap(_genes(d), _segs(d), ["gene_id"], ["start", "var_id"]).select(
        "gene_id", F.col("s_var_id").alias("var_id"), F.col("overlap").alias("w"))


MERGED = """mg as (select chr, min(start) as start, max("end") as "end" from (select *, sum(op) over (partition by chr order by start, "end") as k from (
   select chr, start, "end", case when start > max("end") over (partition by chr order by start, "end" rows between unbounded preceding and 1 preceding) + 1 then 1 else 0 end as op from wide)) group by chr, k)"""
WIDE = """wide as (select chr, start, start + (p * 37) % 12000 as "end" from (select 'chr' || (p_partkey % 7 + 1) as chr, cast(p_partkey * 5000 + 1 as bigint) as start, p_partkey as p from part))"""


def _wide(d):
    return d.part.select(F.concat(F.lit("chr"), (F.col("p_partkey") % 7 + 1).cast("string")).alias("chr"), (F.col("p_partkey") * 5000 + 1).alias("start"),
                         (F.col("p_partkey") * 5000 + 1 + (F.col("p_partkey") * 37) % 12000).alias("end"))


@query("merge_ranges_genes", f"with {WIDE}, {MERGED} select * from mg")
def _(d):
    return I.merge_ranges(_wide(d), chunk=20000)


SEGMERGED = MERGED.replace("from wide", "from segment")


@query("merge_ranges_segments", f"with {SEGMERGED} select * from mg", ("segment",))
def _(d):
    return I.merge_ranges(d.segment)


@query("gaps", f"""with {WIDE}, {MERGED}, e as (select chr, start, "end" from mg union all select chr, 0, 0 from sizes union all select chr, length + 1, length + 1 from sizes),
 g as (select chr, lag("end") over (partition by chr order by start, "end") + 1 as a, start - 1 as b from (select * from e where chr in (select chr from sizes)))
 select chr, cast(a as bigint) as start, cast(b as bigint) as "end" from g where a <= b""", ("sizes",))
def _(d):
    return I.gaps(_wide(d), d.sizes, chunk=100_000)


@query("disjoin", f"""with {WIDE}, p as (select chr, start as p, 1 as d from wide union all select chr, "end" + 1, -1 from wide), s as (select chr, p, sum(d) as d from p group by 1, 2),
 r as (select chr, p as start, lead(p) over (partition by chr order by p) - 1 as "end", sum(d) over (partition by chr order by p) as depth from s)
select chr, start, "end", cast(depth as bigint) as depth from r where depth > 0""")
def _(d):
    return I.disjoin(_wide(d), chunk=50_000)


@query("tiling", """select chr, cast(s as bigint) as start, cast(least(s + 999999, length) as bigint) as "end" from (select chr, length, unnest(range(1, length + 1, 1000000)) as s from sizes)""", ("sizes",))
def _(d):
    return I.tile_sequences(d.sizes, 1_000_000)


@query("covered_fraction", f"""with {WIDE}, {MERGED} select q.var_id, q.id, round(coalesce(sum(case when s.start is not null then least(q."end", s."end") - greatest(q.start, s.start) + 1 end), 0) / (q."end" - q.start + 1), 6) as share
 from segment q left join mg s on s.chr = q.chr and {OV} group by q.var_id, q.id, q.start, q."end" """, ("segment",))
def _(d):
    return I.covered_fraction(d.segment, _wide(d), "share").select("var_id", "id", F.round("share", 6).alias("share"))


@query("overlap_flag", f"""with {WIDE} select q.var_id, q.id, exists (select 1 from wide s where s.chr = q.chr and {OV}) as hit from segment q""", ("segment",))
def _(d):
    return I.overlap_flag(d.segment, _wide(d), "hit").select("var_id", "id", "hit")


@query("without_overlap", f"""select q.gene_id from gene q where not exists (select 1 from segment s where s.chr = q.chr and s.C = 5 and {OV})""", ("gene", "segment"))
def _(d):
    return I.without_overlap(d.gene, d.segment.filter("C = 5")).select("gene_id")


@query("subtract_ranges", f"""with {WIDE}, {MERGED}, sm as ({'select * from mg2'}), mg2 as (select chr, min(start) as start, max("end") as "end" from (select *, sum(op) over (partition by chr order by start, "end") as k from (
   select chr, start, "end", case when start > max("end") over (partition by chr order by start, "end" rows between unbounded preceding and 1 preceding) + 1 then 1 else 0 end as op from segment where C > 3)) group by chr, k),
 pieces as (select m.chr, m.start as ms, m."end" as me, s.start, s."end" from mg m left join mg2 s on s.chr = m.chr and s.start <= m."end" and s."end" >= m.start),
 cut as (select chr, ms, me, start, "end" from pieces where start is not null),
 l as (select chr, case when lag("end") over w is null then ms else lag("end") over w + 1 end as a, start - 1 as b from cut window w as (partition by chr, ms order by start)
   union all select chr, max("end") + 1, me from cut group by chr, ms, me union all select chr, ms, me from pieces where start is null)
select chr, cast(a as bigint) as start, cast(b as bigint) as "end" from l where a <= b""", ("segment",))
def _(d):
    return I.subtract(_wide(d), d.segment.filter("C > 3"))


@query("target_tiles", f"""with {WIDE}, {MERGED}, e as (select chr, start, "end" from mg where chr in (select chr from sizes) union all select chr, 0, 0 from sizes union all select chr, length + 1, length + 1 from sizes),
 g as (select chr, lag("end") over (partition by chr order by start, "end") + 1 as a, start - 1 as b from e),
 off as (select chr, a, b from g where b - a + 1 > 2 * 300 + 1000 and not exists (select 1 from gene s where s.somatic_art and s.chr = g.chr and s.start <= g.b and s."end" >= g.a))
select chr, cast(start as bigint) as start, cast("end" as bigint) as "end", true as target from wide union all select chr, cast(a + 300 as bigint), cast(b - 300 as bigint), false from off""", ("sizes", "gene"))
def _(d):
    return I.target_tiles(_wide(d), d.sizes, d.gene.filter("somatic_art"), shoulder=300, min_gap=1000)


@query("asof_join", """select q.event_id, m.mpos as m_pos from point q left join lateral (select max(pos) as mpos from point m where m.value > 100 and m.chr = q.chr and m.pos <= q.pos) m on true""", ("point",))
def _(d):
    marks = d.point.filter("value > 100").select("chr", "pos").distinct()
    return I.asof_join(d.point, marks, bin_width=50_000).select("event_id", "m_pos")


@query("nearest", """
with seg as (select chr, pos as start, pos + 600 as "end", event_id as sid from point where value > 60)
select event_id, n_sid from (select q.event_id, s.sid as n_sid, row_number() over (partition by q.event_id order by case when q.pos between s.start and s."end" then 0 when s."end" < q.pos then q.pos - s."end" else s.start - q.pos end, s.start, s."end") rn
  from point q join seg s on s.chr = q.chr) where rn = 1""", ("point",))
def _(d):
    seg = d.point.filter("value > 60").select("chr", F.col("pos").alias("start"), (F.col("pos") + 600).alias("end"), F.col("event_id").alias("sid"))
    return I.nearest(d.point, seg, point_key=["event_id"]).select("event_id", "n_sid")


@query("pair_overlap", """
with r as (select chr as chr1, start as start1, "end" as end1, 'chr' || (cast(substr(gene_id, 2) as int) % 5 + 1) as chr2, start - 2000000 as start2, "end" + 2000000 as end2, gene_id from gene)
select s.var_id, s.id, r.gene_id from structural s join r on r.chr1 = s.chr1 and s.pos1 between r.start1 - 101 and r.end1 + 101 and r.chr2 = s.chr2 and s.pos2 between r.start2 - 101 and r.end2 + 101""", ("structural", "gene"))
def _(d):
    r = d.gene.select(F.col("chr").alias("chr1"), F.col("start").alias("start1"), F.col("end").alias("end1"),
                      F.concat(F.lit("chr"), (F.substring("gene_id", 2, 20).cast("int") % 5 + 1).cast("string")).alias("chr2"),
                      (F.col("start") - 2000000).alias("start2"), (F.col("end") + 2000000).alias("end2"), "gene_id")
    return I.pair_overlap(d.structural, r, pair_key=["var_id"], record_key=["gene_id"], maxgap=100).select("var_id", "id", F.col("s_gene_id").alias("gene_id"))


@query("running_scan", """select event_id, round(sum(value) over (partition by chr order by pos, event_id), 4) as total, max(value) over (partition by chr order by pos, event_id) as top from point""", ("point",))
def _(d):
    return scan(d.point, ["chr"], "pos", {"total": ("sum", F.col("value")), "top": ("max", F.col("value"))}, tie=["event_id"], chunk=40_000).select(
        "event_id", F.round("total", 4).alias("total"), "top")


@query("run_lengths", """
with t as (select conv_id, turn, role from (select conv_id, turn, min(case when length(text) % 3 = 0 then 'a' else role end) as role from conversations group by 1, 2)),
 f as (select *, case when role = lag(role) over (partition by conv_id order by turn) then 0 else 1 end as op from t)
select conv_id, min(turn) as first_turn, max(turn) as last_turn, min(role) as role, count(*) as n from (select *, sum(op) over (partition by conv_id order by turn) as k from f) group by conv_id, k""")
def _(d):
    t = d.conversations.groupBy("conv_id", "turn").agg(F.min(F.when(F.length("text") % 3 == 0, "a").otherwise(F.col("role"))).alias("role"))
    r = runs(t, ["conv_id"], "turn", ["role"], chunk=4)
    return r.groupBy("conv_id", F.col("run").alias("first_turn")).agg(F.max("turn").alias("last_turn"), F.min("role").alias("role"), F.count("*").alias("n"))
