"""Cohort, structural and copy-number queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortloom.operators import cohort as C
from cohortloom.operators import copynumber as N
from cohortloom.operators import instability as S
from cohortloom.operators import structural as SV
from cohortloom.operators import triage as T
from cohortloom.operators import variants as V
from queries.registry import query
from queries.variant_queries import TEXT_SQL, _variants

ENG = "coalesce(gene_name_1, '')"

# ---------------------------------------------------------------- hits (flagship)

_PANEL = "select gene_id, gene_name from gene where somatic_goi and not somatic_art"
_COPY = "gc as (select id, gene_id, min(K) as kmin, min(C) as cmin from (select s.id, g.gene_id, case when s.C <= 1 then 0.0 else s.K end as K, s.C from gene g join segment s on s.chr = g.chr and s.start <= g.\"end\" and s.\"end\" >= g.start) group by 1, 2)"


@query("gene_hits", f"""with {TEXT_SQL}, {_COPY}, panel as ({_PANEL}),
 pass as (select id, gene_id from somt where not regexp_matches(triage, 'consequence|evidence|artifact')),
 sv as (select id, gene_id_1 as gene_id from structural where caller_filter is not null and gene_id_1 is not null union all select id, gene_id_2 from structural where caller_filter is not null and gene_id_2 is not null),
 svid as (select distinct id from structural where caller_filter is not null),
 sc as (select id, gene_id, least(count(*), 2) as n from pass group by 1, 2), vc as (select id, gene_id, least(count(*), 2) as n from sv group by 1, 2),
 cl as (select id, gene_id, case when cmin = 0 then 2 when kmin = 0 then 1 else 0 end as n from gc),
 cells as (select distinct x.id, p.gene_id, p.gene_name from (select id, gene_id from sc union all select id, gene_id from vc union all select id, gene_id from cl where n > 0) x join panel p on p.gene_id = x.gene_id where x.id in (select id from meta)),
 r as (select c.*, case when sid.id is null then null else coalesce(sc.n, 0) end as somatic, case when vid.id is null then null else coalesce(vc.n, 0) end as structural,
   case when gid.id is null then null else coalesce(cl.n, 0) end as gene_copy
  from cells c left join sc on sc.id = c.id and sc.gene_id = c.gene_id left join vc on vc.id = c.id and vc.gene_id = c.gene_id left join cl on cl.id = c.id and cl.gene_id = c.gene_id
  left join (select distinct id from pass) sid on sid.id = c.id left join svid vid on vid.id = c.id left join (select distinct id from gc) gid on gid.id = c.id)
select id, gene_id, gene_name, cast(somatic as int) as somatic, cast(structural as int) as structural, cast(gene_copy as int) as gene_copy,
  cast(coalesce(somatic, 0) + coalesce(structural, 0) + coalesce(gene_copy, 0) as int) as hits from r""", ("variant", "gene", "structural", "segment", "meta"))
def _(d):
    som = T.triage_table(_variants(d), "somatic", d.gene).filter(T.not_failed("consequence|evidence|artifact"))
    sv = d.structural.filter("caller_filter is not null")
    gc = N.gene_copies(d.segment, d.gene, keep_all=False)
    panel = d.gene.filter("somatic_goi and not somatic_art")
    return C.gene_hits(d.meta, panel, {"somatic": som, "structural": sv, "gene_copy": gc}, structural_pattern="^G")


@query("gene_hits_sparse", f"""with {_COPY}, v as (select id, gene_id, least(count(*), 2) as n from variant group by 1, 2), l as (select id, gene_id, case when cmin = 0 then 2 when kmin = 0 then 1 end as n from gc),
 u as (select coalesce(v.id, l.id) as id, coalesce(v.gene_id, l.gene_id) as gene_id, v.n as vn, l.n as ln from v full join (select * from l where n is not null) l on v.id = l.id and v.gene_id = l.gene_id)
select u.id, u.gene_id, g.gene_name, cast(coalesce(vn, 0) as int) as somatic, cast(coalesce(ln, case when u.id in (select id from gc) then 0 end) as int) as gene_copy,
 cast(coalesce(vn, 0) + coalesce(ln, 0) as int) as hits from u join gene g on g.gene_id = u.gene_id where u.id in (select id from meta)""", ("variant", "gene", "segment", "meta"))
def _(d):
    return C.gene_hits(d.meta, d.gene, {"somatic": d.variant, "gene_copy": N.gene_copies(d.segment, d.gene, keep_all=False)})


# ---------------------------------------------------------------- expression

@query("expression_table", """
with t as (select id, sum(count) as t from expression group by 1)
select e.id, e.gene_id, e.count as tcount, round(e.count / t.t * 1e6, 4) as tcpm, round(e.count / t.t * 1e6 / (p_size * 100 / 1000), 4) as trpkm
from expression e join t using (id) join part on 'G' || p_partkey = e.gene_id""", ("expression",))
def _(d):
    lengths = d.part.select(F.concat(F.lit("G"), F.col("p_partkey").cast("string")).alias("gene_id"), (F.col("p_size") * 100).alias("gene_length"))
    return C.normalise_expression(d.expression, lengths).select("id", "gene_id", "tcount", F.round("tcpm", 4).alias("tcpm"), F.round("trpkm", 4).alias("trpkm"))


@query("percentile_view", """select l_partkey as gene_id, percentile_disc(0.2) within group (order by l_extendedprice) as pct_20, percentile_disc(0.5) within group (order by l_extendedprice) as pct_50,
 percentile_disc(0.9) within group (order by l_extendedprice) as pct_90, percentile_disc(0.999) within group (order by l_extendedprice) as pct_999 from lineitem group by 1""")
def _(d):
    return C.percentile_view(d.lineitem.withColumnRenamed("l_partkey", "gene_id"), "l_extendedprice").select("gene_id", "pct_20", "pct_50", "pct_90", "pct_999")


@query("percentile_bands", """
with p as (select l_partkey, percentile_disc(0.2) within group (order by l_extendedprice) as a, percentile_disc(0.3) within group (order by l_extendedprice) as b, percentile_disc(0.4) within group (order by l_extendedprice) as c,
  percentile_disc(0.5) within group (order by l_extendedprice) as d, percentile_disc(0.75) within group (order by l_extendedprice) as e, percentile_disc(0.9) within group (order by l_extendedprice) as f,
  percentile_disc(0.95) within group (order by l_extendedprice) as g, percentile_disc(0.99) within group (order by l_extendedprice) as h, percentile_disc(0.999) within group (order by l_extendedprice) as i from lineitem group by 1)
select l_suppkey, case when x >= i then '>99.9%' when x >= h then '>99%' when x >= g then '>95%' when x >= f then '>90%' when x >= e then '>75%' when x >= d then '>50%' when x >= c then '>40%' when x >= b then '>30%' when x >= a then '>20%' else '<20%' end as band, count(*) as n
from (select l_suppkey, l_partkey, l_extendedprice * 0.9 as x from lineitem) join p using (l_partkey) group by 1, 2""")
def _(d):
    pct = C.percentile_view(d.lineitem.withColumnRenamed("l_partkey", "gene_id"), "l_extendedprice")
    x = d.lineitem.withColumnRenamed("l_partkey", "gene_id").withColumn("x", F.col("l_extendedprice") * 0.9).join(pct, "gene_id")
    return x.withColumn("band", C.percentile_band(F.col("x"))).groupBy("l_suppkey", "band").agg(F.count("*").alias("n"))


@query("cohort_medians", """select cohort, n, median from (select c_mktsegment || (c_custkey % 40) as cohort, count(*) as n, median(o_totalprice) as median from orders join customer on o_custkey = c_custkey group by 1) where n > 70 or cohort = 'BUILDING1'""")
def _(d):
    x = d.orders.join(d.customer, F.col("o_custkey") == F.col("c_custkey")).select(F.concat("c_mktsegment", (F.col("c_custkey") % 40).cast("string")).alias("cohort"), "o_totalprice")
    return C.cohort_medians(x, "o_totalprice", own=["BUILDING1"], min_samples=70)


@query("recurrence", """select gene_id as "key", count(*) as recur, (select count(distinct id) from variant) as total from variant group by 1 having count(*) > 1""", ("variant",))
def _(d):
    return C.recurrence(d.variant, "gene_id")


@query("integrated_variants", """
with r as (select var_id, count(*) as recur from variant group by 1 having count(*) > 1),
 sg as (select s.id, s.C, s.K, g.gene_id from segment s join gene g on g.chr = s.chr and s.start <= g."end" and s."end" >= g.start),
 e as (select x.id, x.gene_id, x.count / t.t * 1e6 as cpm from expression x join (select id, sum(count) t from expression group by 1) t using (id)),
 j as (select v.id, v.var_id, coalesce(r.recur, 0) as recur, sg.C as cn, sg.K as k, e.cpm from variant v left join r on r.var_id = v.var_id left join sg on sg.id = v.id and sg.gene_id = v.gene_id left join e on e.id = v.id and e.gene_id = v.gene_id),
 o as (select *, row_number() over (partition by id, var_id order by abs(cn - 2) desc nulls last, cn desc nulls last) rn from j)
select id, var_id, case when recur = 0 then 1 else recur end as recur, cn, round(cpm, 2) as rpkm from o where rn = 1""", ("variant", "segment", "gene", "expression"))
def _(d):
    v = d.variant.select("id", "var_id", "gene_id")
    recur = C.recurrence(v, "var_id").withColumnRenamed("key", "var_id")
    copies = C.genes_per_segment(d.segment, N.segment_gene_map(d.segment, d.gene))
    cpm = C.normalise_expression(d.expression, d.gene.select("gene_id", F.lit(1000).alias("gene_length"))).select("id", "gene_id", F.col("tcpm").alias("cpm"), F.col("tcpm").alias("rpkm"))
    return C.sample_variants(C.integrated_variants(v, recur, copies, cpm)).select("id", "var_id", "recur", "cn", "rpkm")


@query("pack_unpack_expression", """
with i as (select 'G' || p_partkey as gene_id, row_number() over (order by 'G' || p_partkey) as idx from part where p_size = 7), c as (select id, gene_id, sum(count) as v from expression group by 1, 2)
select ids.id, i.gene_id, coalesce(round(c.v / 7, 2), -1) as rpkm from (select distinct id from expression) ids cross join i left join c on c.id = ids.id and c.gene_id = i.gene_id""", ("expression",))
def _(d):
    from cohortloom.streaming.incremental import gene_index

    idx = gene_index(d.gene.join(d.part.filter("p_size = 7").select(F.concat(F.lit("G"), F.col("p_partkey").cast("string")).alias("gene_id")), "gene_id", "left_semi"))
    x = d.expression.withColumn("count2", F.col("count") / 7)
    packed = C.pack_values(x.select("id", "gene_id", F.col("count2").alias("rpkm")), idx, ["rpkm"])
    back = C.expression_with_copies(packed.select("id", F.col("rpkm").alias("count"), F.col("rpkm").alias("cpm"), "rpkm"), idx, d.segment.filter("1 = 0").select("id", "C", F.array(F.lit("x")).alias("genes")))
    return back.select("id", "gene_id", "rpkm")


@query("gene_across_cohort", """with c as (select id, sum(count) as v from expression where gene_id = 'G17' group by 1)
select i.id, coalesce(cast(c.v as double), -1) as cpm, m.cohort from (select distinct id from expression where gene_id in (select gene_id from gene where somatic_art)) i left join c on c.id = i.id left join meta m on m.id = i.id""".replace("where gene_id in (select gene_id from gene where somatic_art)", ""), ("expression", "gene", "meta"))
def _(d):
    from cohortloom.streaming.incremental import gene_index

    idx = gene_index(d.gene.filter("gene_id in ('G17', 'G2', 'G5')"))
    packed = C.pack_values(d.expression.withColumnRenamed("count", "cpm"), idx, ["cpm"], None).withColumn("rpkm", F.col("cpm"))
    return C.gene_across_cohort(packed, idx, "G17", d.meta.select("id", "cohort")).select("id", "cpm", "cohort")


@query("feature_values", """select cast(vec_id as varchar) as id, 'f' || i as feature, round(case when embedding[i] >= 0 then cast(embedding[i] as double) end, 5) as value from (select vec_id, embedding, unnest(range(1, len(embedding) + 1)) as i from embeddings)""")
def _(d):
    data = d.embeddings.select(F.col("vec_id").cast("string").alias("id"), F.lit("e").alias("name"), F.col("embedding").cast("array<double>").alias("value"))
    n = d.embeddings.agg(F.max(F.size("embedding")).alias("n"))
    feats = n.select(F.lit("e").alias("name"), F.transform(F.sequence(F.lit(1), "n"), lambda i: F.concat(F.lit("f"), i.cast("string"))).alias("feature"),
                     F.transform(F.sequence(F.lit(1), "n"), lambda i: F.lit("g")).alias("gene"))
    return C.feature_values(data, feats).select("id", "feature", F.round("value", 5).alias("value"))


def _features(d):
    data = d.embeddings.select(F.col("vec_id").cast("string").alias("id"), F.lit("e").alias("name"), F.col("embedding").cast("array<double>").alias("value"))
    n = d.embeddings.agg(F.max(F.size("embedding")).alias("n"))
    named = lambda i: F.concat(F.lit("f"), i.cast("string"))
    return data, n.select(F.lit("e").alias("name"), F.transform(F.sequence(F.lit(1), "n"), named).alias("feature"), F.transform(F.sequence(F.lit(1), "n"), named).alias("gene"))


@query("retrieve_features", """select cast(vec_id as varchar) as id, 'f' || i as feature, round(case when embedding[i] >= 0 then cast(embedding[i] as double) end, 5) as value from (select vec_id, embedding, unnest(range(1, len(embedding) + 1)) as i from embeddings)""")
def _(d):
    return C.retrieve_features(*_features(d), "e").select("id", "feature", F.round("value", 5).alias("value"))


@query("feature_distribution", """select cast(vec_id as varchar) as id, round(cast(embedding[5] as double), 5) as value, cohort, cohort || '-' || m.id as patient from embeddings left join meta m on m.id = cast(vec_id as varchar) where embedding[5] is not null""", ("meta",))
def _(d):
    g = d.meta.select("id", "cohort", F.concat("cohort", F.lit("-"), "id").alias("patient"))
    return C.feature_distribution(*_features(d), "e", "f5", g).select("id", F.round("value", 5).alias("value"), "cohort", "patient")


@query("feature_names", """select distinct cast(vec_id as varchar) as id, 'e' as name from embeddings""")
def _(d):
    return C.feature_names(_features(d)[0])


@query("retrieve_structural", """select id, var_id, aft, qual from structural""", ("structural",))
def _(d):
    return C.retrieve_structural(d.structural).select("id", "var_id", "aft", "qual")


@query("retrieve_expression", """
with sg as (select s.id, s.C, g.gene_id from segment s join gene g on g.chr = s.chr and s.start <= g."end" and s."end" >= g.start), e as (select id, gene_id, round(count / 7.0, 4) as rpkm from expression),
 o as (select e.*, sg.C as c, row_number() over (partition by e.id, e.gene_id order by abs(sg.C - 2) desc nulls last, sg.C desc nulls last, rpkm) rn from e left join sg on sg.id = e.id and sg.gene_id = e.gene_id)
select id, gene_id, c, max(rpkm) over (partition by id, gene_id) as rpkm from o qualify rn = 1""", ("segment", "gene", "expression"))
def _(d):
    copies = C.genes_per_segment(d.segment, N.segment_gene_map(d.segment, d.gene)).select("id", F.col("C").alias("c"), F.explode("genes").alias("gene_id"))
    x = d.expression.select("id", "gene_id", F.round(F.col("count") / 7, 4).alias("rpkm")).join(copies, ["id", "gene_id"], "left").withColumn("gene_name", F.col("gene_id"))
    return C.retrieve_expression(x).select("id", "gene_id", "c", "rpkm")


@query("retrieve_segments", """select s.id, s.var_id, s.chr, s.start, cast(count(distinct g.gene_id) as int) as n_genes from segment s left join gene g on g.chr = s.chr and s.start <= g."end" and s."end" >= g.start group by 1, 2, 3, 4""", ("segment", "gene"))
def _(d):
    return C.retrieve_segments(C.genes_per_segment(d.segment, N.segment_gene_map(d.segment, d.gene))).select("id", "var_id", "chr", "start", F.size("genes").alias("n_genes"))


@query("retrieve_fusions", """
with f as (select id, var_id, coalesce(gene_id_1, '') || '-' || coalesce(gene_id_2, '') as pair, cast(floor(qual) as bigint) as sum_jnc, cast(floor(aft * 100) as bigint) as sum_bpt from structural), r as (select pair, count(*) as n from f group by 1 having count(*) > 1)
select id, var_id, pair, coalesce(n, 1) as recur, sum_jnc, sum_bpt from f left join r using (pair)""", ("structural",))
def _(d):
    f = d.structural.select("id", "var_id", F.coalesce("gene_id_1", F.lit("")).alias("gene_ids_5_1"), F.coalesce("gene_id_2", F.lit("")).alias("gene_ids_3_1"), F.floor("qual").alias("sum_jnc"), F.floor(F.col("aft") * 100).alias("sum_bpt"))
    return C.retrieve_fusions(f, C.recurrence(f, F.concat_ws("-", "gene_ids_5_1", "gene_ids_3_1"))).select("id", "var_id", "pair", "recur", "sum_jnc", "sum_bpt")


@query("fusion_recurrence", """
with f as (select distinct id, var_id, coalesce(gene_id_1, '') as a, coalesce(gene_id_2, '') as b from structural), r as (select a || '-' || b as p, count(*) as n from f group by 1 having count(*) > 1)
select f.id, f.var_id, a || '-' || b as pair, coalesce(r.n, 1) as recur from f left join r on r.p = a || '-' || b""", ("structural",))
def _(d):
    f = d.structural.select("id", "var_id", F.coalesce("gene_id_1", F.lit("")).alias("gene_ids_5_1"), F.coalesce("gene_id_2", F.lit("")).alias("gene_ids_3_1")).distinct()
    r = C.recurrence(f, F.concat_ws("-", "gene_ids_5_1", "gene_ids_3_1"))
    return C.fusions_with_recurrence(f, r).select("id", "var_id", "pair", "recur")


@query("unify_per_gene", """
with m as (select gene_id, id, array_to_string(list_sort(list(distinct coalesce(hgvsp, hgvsc))), ',') as som from variant group by 1, 2),
 sg as (select g.gene_id, s.id, count(*) as n from segment s join gene g on g.chr = s.chr and s.start <= g."end" and s."end" >= g.start group by 1, 2),
 e as (select gene_id, id, max(round(count / 7, 2)) as e from expression group by 1, 2),
 k as (select gene_id, id from m union select gene_id, id from sg union select gene_id, id from e)
select k.gene_id, k.id, m.som, case when sg.n > 1 then sg.n end as seg, e.e as exp from k left join m using (gene_id, id) left join sg using (gene_id, id) left join e using (gene_id, id)""", ("variant", "segment", "gene", "expression"))
def _(d):
    v = d.variant
    bridge = v.select("id", "var_id", "gene_id").distinct()
    marks = V.variant_marks(v).join(v.select("id", "var_id").distinct(), ["id", "var_id"])
    seg = d.segment
    out = C.unify({"som": (marks, bridge)}, (V.segment_marks(seg), N.segment_gene_map(seg, d.gene)), None, d.expression.withColumn("trpkm", F.col("count") / 7))
    return C.lists_to_text(out, ["som"]).select("gene_id", "id", "som", "seg", "exp")


@query("onco_matrix", """select m.id, g.gene_name, m.tumor_dna_sample is not null as tested, cast(exists (select 1 from variant v where v.id = m.id and v.gene_name = g.gene_name and regexp_matches(v.consequence, 'frameshift|stop_gained|splice')) as int) as hit
from meta m cross join (select unnest(['N1', 'N2', 'N3', 'N40', 'N77', 'N100', 'N123']) as gene_name) g""", ("meta", "variant"))
def _(d):
    return C.onco_matrix(V.annotate_mutations(d.variant), d.meta, ["N1", "N2", "N3", "N40", "N77", "N100", "N123"], ["truncating"])


@query("onco_merged_features", """with c as (select m.id, g.gene_name, cast(exists (select 1 from variant v where v.id = m.id and v.gene_name = g.gene_name and v.consequence = 'missense_variant') as int) as hit
from meta m cross join (select unnest(['N1', 'N2', 'N3']) as gene_name) g) select id, case when gene_name = 'N3' then 'N3' else 'N1/N2' end as gene_name, cast(sum(hit) as bigint) as hit from c group by all""", ("meta", "variant"))
def _(d):
    m = C.onco_matrix(d.variant.withColumn("annotation", F.col("consequence")), d.meta, ["N1", "N2", "N3"], ["missense_variant"])
    return C.merge_features(m, "N1/N2", ["N1", "N2"])


@query("lollipop", """
with t as (select gene_id, transcript from (select gene_id, transcript, row_number() over (partition by gene_id order by count(*) desc, transcript) rn from variant group by 1, 2) where rn = 1)
select v.chr, v.pos, coalesce(replace(replace(replace(replace(replace(hgvsp, 'p.', ''), 'Ala', 'A'), 'Trp', 'W'), 'Lys', 'K'), 'Val', 'V'), '') as hgvsp, count(*) as n from variant v join t using (gene_id, transcript) where hgvsp is not null group by all""", ("variant",))
def _(d):
    return C.lollipop(d.variant, by="hgvsp")


@query("review_somatic", f"""with {TEXT_SQL} select s.id, s.var_id, s.triage, case when (coalesce(lower(v.clinvar) like '%path%', false) or cosmic_cnt > 5) and aft > 0.02 then 'FLAG' else '' end as flag, round(m.purity, 4) as purity
 from somt s join (select distinct id, var_id, clinvar, cosmic_cnt, aft from variant) v on v.id = s.id and v.var_id = s.var_id join meta m on m.id = s.id where not regexp_matches(s.triage, 'artifact|consequence|annotation')""", ("variant", "gene", "meta"))
def _(d):
    done = T.triage_table(_variants(d), "somatic", d.gene)
    return C.review_order(C.review_variants(done, d.meta, None)).select("id", "var_id", "triage", "flag", F.round("purity", 4).alias("purity"))


@query("review_structural", """select s.id, s.var_id, case when caller_filter = 'PASS' and aft > 0.05 and adt > 5 and aft > 0.1 - 0.001 then 'FLAG' else '' end as flag from structural s where gene_name_1 = 'N11' or gene_name_2 = 'N11'""".replace("aft > 0.05 and adt > 5 and aft > 0.1 - 0.001", "aft * 2 > 0.1 and adt > 5"), ("structural",))
def _(d):
    s = d.structural.withColumn("aft", F.col("aft") * 2).withColumn("triage", F.lit(None).cast("string"))
    return C.review_structural(s, d.meta, "N11").select("id", "var_id", "flag")


@query("review_features_text", """select id, gene_id, string_agg(som_hgvsp, '; ' order by som_hgvsp, som_consequence) as som_hgvsp, string_agg(som_consequence, '; ' order by som_hgvsp, som_consequence) as som_consequence from
 (select distinct id, gene_id, coalesce(hgvsp, 'NA') as som_hgvsp, consequence as som_consequence from variant) group by 1, 2""", ("variant",))
def _(d):
    return C.collapse_text(d.variant, {"som_hgvsp": "hgvsp", "som_consequence": "consequence"})


@query("homopolymer_instability", """
with hp as (select distinct 'chr' || (p_partkey % 7 + 1) as chr, p_partkey * 1000 + 1 as start, p_partkey * 1000 + p_size as "end" from part), st as (select *, "end" - start + 1 as len from hp h where exists (select 1 from gene g where g.chr = h.chr and g.start <= h."end" and g."end" + 3000 >= h.start)),
 iv as (select distinct id, chr, pos from variant where str and pon is null), h as (select distinct iv.id, st.chr, st.start, st.len from iv join st on st.chr = iv.chr and st.start <= iv.pos + 1 and st."end" >= iv.pos),
 n as (select sum(1) as sites from st where len between 7 and 20), i as (select id, count(*) as k from h where len between 7 and 20 group by 1)
select m.id, round(100 * coalesce(i.k, 0) / n.sites, 6) as score from meta m cross join n left join i on i.id = m.id""", ("variant", "gene", "meta"))
def _(d):
    hp = d.part.select(F.concat(F.lit("chr"), (F.col("p_partkey") % 7 + 1).cast("string")).alias("chr"), (F.col("p_partkey") * 1000 + 1).alias("start"), (F.col("p_partkey") * 1000 + F.col("p_size")).alias("end"))
    score, _freq = C.homopolymer_instability(d.variant.withColumn("pass", F.when(F.col("pon").isNull(), "pass").otherwise("fail")), hp, d.gene.withColumn("end", F.col("end") + 3000), d.meta)
    return score.withColumn("score", F.round("score", 6))


# ---------------------------------------------------------------- structural variants

_SVR = """t as (select *, case when chr1 <> chr2 then 'translocation' when bnd1 = ']' and bnd2 = '[' then 'deletion' when bnd1 = '[' and bnd2 = ']' then 'duplication' else 'inversion' end as topo,
  case when bnd1 = ']' and strand1 = '+' or bnd1 = '[' and strand1 = '-' then '5p' when strand1 <> '*' then '3p' end as end1, case when bnd2 = ']' and strand2 = '+' or bnd2 = '[' and strand2 = '-' then '5p' when strand2 <> '*' then '3p' end as end2 from structural)"""


@query("sv_topology_orientation", f"""with {_SVR}, f as (select *, case when gene_name_1 = gene_name_2 and strand1 = '-' then true when gene_name_1 = gene_name_2 and strand1 = '+' then false
   when end1 = '3p' and end2 = '5p' then true when end1 = '3p' and end2 is null then true when end1 is null and end2 = '5p' then true else false end as fl from t)
select var_id, id, topo, case when fl then chr2 else chr1 end as chr1, case when fl then pos1 else pos2 end as pos2, case when fl then end2 else end1 end as end1, case when fl then gene_id_1 else gene_id_2 end as gene_id_2 from f""", ("structural",))
def _(d):
    return SV.orient_pairs(SV.sv_topology(d.structural)).select("var_id", "id", "topo", "chr1", "pos2", "end1", "gene_id_2")


@query("sv_consequence", rf"""with {_SVR}, c as (select *, case when gene_id_1 <> gene_id_2 and end1 = '5p' and end2 = '3p' then 'fusion5' when gene_id_1 = gene_id_2 and topo <> 'translocation' then 'internal-' || topo
     when gene_id_1 is not null and end1 = '3p' then 'start-loss' when gene_id_1 is not null and end1 = '5p' then 'truncation' end as csq1,
   case when gene_id_1 <> gene_id_2 and end1 = '5p' and end2 = '3p' then 'fusion3' when gene_id_1 = gene_id_2 and topo <> 'translocation' then 'internal-' || topo
     when gene_id_2 is not null and end2 = '3p' then 'start-loss' when gene_id_2 is not null and end2 = '5p' then 'truncation' end as csq2,
   coalesce(case when exon1 <> '' then split_part(exon1, '/', 1) when end1 = '5p' and intron1 <> '' then cast(cast(split_part(intron1, '/', 1) as int) + 1 as varchar) when end1 = '3p' and intron1 <> '' then split_part(intron1, '/', 1) end, '') as b1,
   coalesce(case when exon2 <> '' then split_part(exon2, '/', 1) when intron2 <> '' then split_part(intron2, '/', 1) end, '') as b2 from t),
 s as (select *, case when b1 = b2 then b1 when b1 = '' then '--' || b2 when b2 = '' then b1 || '--' when cast(b1 as int) <= cast(b2 as int) then b1 || '--' || b2 end as b12 from c)
select var_id, id, csq1, csq2, case when csq1 in ('internal-deletion', 'internal-duplication') then b12 when csq1 in ('truncation', 'fusion5') then b1 || '--' when csq1 in ('start-loss', 'fusion3') then '--' || b1 end as exons1,
  case when csq1 in ('internal-deletion', 'internal-duplication') then b12 when csq2 in ('truncation', 'fusion5') then b2 || '--' when csq2 in ('start-loss', 'fusion3') then '--' || b2 end as exons2 from s""", ("structural",))
def _(d):
    return SV.structural_consequence(SV.sv_topology(d.structural)).select("var_id", "id", "csq1", "csq2", "exons1", "exons2")


@query("fusion_consequence", """select var_id, id, case when a <> '' and b <> '' then 'fusion5' when a <> '' then 'truncation' end as csqf5, case when a <> '' and b <> '' then 'fusion3' when b <> '' then 'start-loss' end as csqf3, case when c <> '' then 'truncation' end as csqr5
from (select var_id, id, coalesce(gene_name_1, '') a, coalesce(gene_name_2, '') b, case when qual > 50000 then 'x' else '' end c from structural)""", ("structural",))
def _(d):
    f = d.structural.select("var_id", "id", F.coalesce("gene_name_1", F.lit("")).alias("gene_names_5_1"), F.coalesce("gene_name_2", F.lit("")).alias("gene_names_3_1"),
                            F.when(F.col("qual") > 50000, "x").otherwise("").alias("gene_names_5_2"), F.lit("").alias("gene_names_3_2"))
    return SV.fusion_consequence(f).select("var_id", "id", "csqf5", "csqf3", "csqr5")


@query("annotate_structural", f"""with {_SVR}, g as (select id, gene_id_1 as gene_id, gene_name_1 as gene_name, case when gene_id_1 <> gene_id_2 and end1 = '5p' and end2 = '3p' then 'fusion5' else topo end as annotation from t
   union all select id, gene_id_2, gene_name_2, case when gene_id_1 <> gene_id_2 and end1 = '5p' and end2 = '3p' then 'fusion3' else topo end from t)
select distinct id, gene_id, gene_name, annotation, case when annotation like 'fusion%' then annotation else 'structural' end || '-' || gene_id as type_partner_gene from g where gene_id is not null""", ("structural",))
def _(d):
    t = SV.sv_topology(d.structural)
    fused = (F.col("gene_id_1") != F.col("gene_id_2")) & (F.col("end1") == "5p") & (F.col("end2") == "3p")
    t = t.withColumn("csq1", F.when(fused, "fusion5").otherwise(F.col("topo"))).withColumn("csq2", F.when(fused, "fusion3").otherwise(F.col("topo")))
    return SV.annotate_structural(t).drop("type_partner_symbol")


@query("pair_breakends", r"""
with b as (select l_orderkey as k, min(l_partkey) as p1, max(l_suppkey) as p2, min(l_linenumber) as c1, max(l_linenumber) as c2 from lineitem group by 1 having count(*) > 1)
select concat('b', k, 'a:b', k, 'b') as bnd_id, 'chr' || c1 as chr1, p1 as pos1, case when k % 2 = 0 then ']' else '[' end as bnd1, 'chr' || c2 as chr2, p2 as pos2, case when k % 2 = 0 then 'TT' else 'GG' end as insert, c1 = c2 as proximal from b""")
def _(d):
    b = d.lineitem.groupBy(F.col("l_orderkey").alias("k")).agg(F.min("l_partkey").alias("p1"), F.max("l_suppkey").alias("p2"), F.min("l_linenumber").alias("c1"), F.max("l_linenumber").alias("c2"), F.count("*").alias("n")).filter("n > 1")
    name = lambda s: F.concat(F.lit("b"), F.col("k").cast("string"), F.lit(s))
    chrom = lambda c: F.concat(F.lit("chr"), F.col(c).cast("string"))
    alt = lambda c, p: F.when(F.col("k") % 2 == 0, F.concat(F.lit("NTT]"), chrom(c), F.lit(":"), F.col(p).cast("string"), F.lit("]"))).otherwise(
        F.concat(F.lit("["), chrom(c), F.lit(":"), F.col(p).cast("string"), F.lit("[GGN")))
    rec = b.select(name("a").alias("var_id"), name("b").alias("mate_id"), chrom("c1").alias("chr1"), F.col("p1").alias("pos1"), alt("c2", "p2").alias("alt"), F.lit(1).alias("ord")).unionByName(
        b.select(name("b").alias("var_id"), name("a").alias("mate_id"), chrom("c2").alias("chr1"), F.col("p2").alias("pos1"), alt("c1", "p1").alias("alt"), F.lit(2).alias("ord")))
    return SV.pair_mates(rec).select("bnd_id", "chr1", "pos1", "bnd1", "chr2", "pos2", "insert", "proximal")


@query("match_callers", """
with a as (select distinct var_id, chr1, pos1, strand1, chr2, pos2, strand2 from structural where adt < 25), b as (select distinct chr1, pos1 + 40 as pos1, strand1, chr2, pos2 - 60 as pos2, strand2, caller_filter as f, qual from structural where adt >= 10 and caller_filter is not null),
 h as (select a.*, b.f, b.qual, abs(a.pos1 - b.pos1) + abs(a.pos2 - b.pos2) as d from a join b on a.chr1 = b.chr1 and a.chr2 = b.chr2 and abs(a.pos1 - b.pos1) <= 101 and abs(a.pos2 - b.pos2) <= 101 and a.strand1 = b.strand1 and a.strand2 = b.strand2
   and (a.chr1 <> a.chr2 or abs(abs(a.pos1 - a.pos2) - abs(b.pos1 - b.pos2)) - 1 < 0.5 * least(abs(a.pos1 - a.pos2), abs(b.pos1 - b.pos2)))),
 r as (select *, row_number() over (partition by var_id, chr1, pos1, strand1, chr2, pos2, strand2 order by d, f, qual) rn from h)
select a.var_id, r.f as caller_f, r.qual as caller_qual from a left join r on r.rn = 1 and r.var_id = a.var_id and r.chr2 = a.chr2 and r.pos2 = a.pos2 and r.pos1 = a.pos1 and r.strand1 = a.strand1 and r.strand2 = a.strand2""", ("structural",))
def _(d):
    cols = ["chr1", "pos1", "strand1", "chr2", "pos2", "strand2"]
    a = d.structural.filter("adt < 25").select("var_id", *cols).distinct()
    b = d.structural.filter("adt >= 10 and caller_filter is not null").withColumn("pos1", F.col("pos1") + 40).withColumn("pos2", F.col("pos2") - 60).select(*cols, F.col("caller_filter").alias("f"), "qual").distinct()
    return SV.match_callers(a, b, key=["var_id", *cols], payload=["f", "qual"]).select("var_id", "caller_f", "caller_qual")


@query("segment_events", """select event, count(*) as n from (select case when C >= 2 and K = 0 then 'LOH' when C = 0 then 'Hom. Deletion' when coalesce(C, -1) < 2 then 'Loss' when C > 2 then 'Gain' when K is null or C is null then 'Unknown' else 'Neutral' end as event from segment) group by 1""", ("segment",))
def _(d):
    return d.segment.select(SV.segment_event(F.col("C"), F.col("K")).alias("event")).groupBy("event").agg(F.count("*").alias("n"))


@query("sv_display_names", """select var_id, id, coalesce(gene_name_1, chr1 || ':' || pos1) as gene_name_1, coalesce(gene_name_2, chr2 || ':' || pos2) as gene_name_2 from structural""", ("structural",))
def _(d):
    return SV.sv_names(d.structural).select("var_id", "id", "gene_name_1", "gene_name_2")


# ---------------------------------------------------------------- copy number

ARMS = """arms as (select 'chr' || c as chr, 'chr' || c || p as arm, cast(case when p = 'p' then 1 else 4000001 end as bigint) as start, cast(case when p = 'p' then 4000000 else 999999999 end as bigint) as "end" from (select distinct l_linenumber as c from lineitem) cross join (select unnest(['p', 'q']) as p))"""


def _arms(d):
    c = d.lineitem.select(F.concat(F.lit("chr"), F.col("l_linenumber").cast("string")).alias("chr")).distinct()
    a = c.select("chr", F.explode(F.array(F.struct(F.lit("p").alias("p"), F.lit(1).cast("bigint").alias("start"), F.lit(4000000).cast("bigint").alias("end")),
                                         F.struct(F.lit("q").alias("p"), F.lit(4000001).cast("bigint").alias("start"), F.lit(999999999).cast("bigint").alias("end")))).alias("a"))
    return a.select("chr", F.concat("chr", "a.p").alias("arm"), "a.start", "a.end")


WM = """ws as (select id, C as x, sum(width) as w from segment where C is not null group by 1, 2), wc as (select *, sum(w) over (partition by id order by x) as c, sum(w) over (partition by id) / 2 as h from ws),
 wm as (select id, (min(case when c >= h then x end) + min(case when c > h then x end)) / 2 as wm from wc group by 1), mo as (select id, avg(x) as mode from (select id, C as x, count(*) as n, max(count(*)) over (partition by id) as t from segment where C is not null group by 1, 2) where n = t group by 1)"""


@query("weighted_median", f"with {WM} select id, wm as weighted_median from wm", ("segment",))
def _(d):
    return N.weighted_median(d.segment, ["id"], "C", "width")


@query("modal_copies", f"with {WM} select id, round(mode, 6) as mode from mo", ("segment",))
def _(d):
    return N.modal_value(d.segment, ["id"], "C").withColumn("mode", F.round("mode", 6))


_COPYAGG = """cp as (select s.id, g.gene_id, count(*) as nseg, min(case when s.C <= 1 then 0.0 else s.K end) as kmin, max(case when s.C <= 1 then 0.0 else s.K end) as kmax, min(s.C) as cmin, max(s.C) as cmax, avg(s.sC) as csub
  from gene g join segment s on s.chr = g.chr and s.start <= g."end" and s."end" >= g.start group by 1, 2)"""


@query("gene_copies", f"""with {_COPYAGG} select id, gene_id, cast(nseg as int) as nseg, kmin as "Kmin", kmax as "Kmax", cmin as "Cmin", cmax as "Cmax", round(csub, 6) as "Csub" from cp""", ("segment", "gene"))
def _(d):
    return N.gene_copies(d.segment, d.gene, keep_all=False).select("id", "gene_id", "nseg", "Kmin", "Kmax", "Cmin", "Cmax", F.round("Csub", 6).alias("Csub"))


@query("clip_genes", """
with h as (select g.gene_id, min(s.start) as a, max(s."end") as b from gene g join segment s on s.chr = g.chr and s.start <= g."end" and s."end" >= g.start and s.C > 2 group by 1)
select g.gene_id, greatest(g.start, coalesce(a, g.start)) as start, least(g."end", coalesce(b, g."end")) as "end" from gene g left join h using (gene_id)""", ("gene", "segment"))
def _(d):
    return N.clip_genes(d.gene, d.segment.withColumn("target", F.coalesce(F.col("C") > 2, F.lit(False)))).select("gene_id", "start", "end")


@query("best_gene_segment", """select id, gene_id, C, K, seg from (select s.id, g.gene_id, s.C, s.K, s.seg, row_number() over (partition by s.id, g.gene_id order by s.C <> 0 nulls last, s.C <> 1 nulls last, s.K <> 0 nulls last, s.C desc nulls last, s.seg, s.start) rn
 from gene g join segment s on s.chr = g.chr and s.start <= g."end" and s."end" >= g.start) where rn = 1""", ("gene", "segment"))
def _(d):
    return N.best_gene_segment(d.segment, d.gene).select("id", "gene_id", "C", "K", "seg")


@query("arm_average", f"""with {ARMS} select s.id, a.arm, round(coalesce(sum(s.C * (least(s."end", a."end") - greatest(s.start, a.start))), 0) / nullif(sum(least(s."end", a."end") - greatest(s.start, a.start)), 0), 6) as arm_avg
 from arms a join segment s on s.chr = a.chr and s.start <= a."end" and s."end" >= a.start group by 1, 2""", ("segment",))
def _(d):
    return N.arm_average(d.segment, _arms(d)).withColumn("arm_avg", F.round("arm_avg", 6))


ARMCALL = f"""{ARMS}, {WM}, sg as (select s.id, a.arm, least(s."end", a."end") - greatest(s.start, a.start) as n, coalesce(s.C, -1) as c, s.C as raw from arms a join segment s on s.chr = a.chr and s.start <= a."end" and s."end" >= a.start),
 lb as (select sg.*, wm.wm, m.ploidy, case when c < wm.wm and c < mode and c < m.ploidy - 0.5 and c < 4 then 'loss' when c > wm.wm and c > mode and c > m.ploidy + 0.5 and c > 2 then 'gain' else 'none' end as label from sg join wm using (id) join mo using (id) left join meta m using (id)),
 pr as (select id, arm, label, wm, ploidy, sum(n) as len, count(raw) as k from lb group by all), tt as (select *, sum(len) over (partition by id, arm) as t, sum(k) over (partition by id, arm) as kk from pr),
 rk as (select *, row_number() over (partition by id, arm order by len desc, label) as rn from tt where kk > 0),
 ac as (select id, arm, case when round(len / t, 2) < 0.5 then 'none' else label end as annotation, round(len / t, 2) as proportion from rk where rn = 1)"""


@query("arm_calls", f"with {ARMCALL} select id, arm, annotation, proportion from ac", ("segment", "meta"))
def _(d):
    return N.call_arms(d.segment, _arms(d), d.meta).select("id", "arm", "annotation", "proportion")


@query("chromosome_calls", f"""with {ARMCALL} select id, left(arm, 4) as chr, case sum(case annotation when 'gain' then 1 when 'loss' then -1 else 0 end) when 2 then 'gain' when -2 then 'loss' else 'none' end as annotation from ac group by 1, 2""", ("segment", "meta"))
def _(d):
    return N.call_chromosomes(N.call_arms(d.segment, _arms(d), d.meta)).select("id", "chr", "annotation")


@query("arm_tallies", f"""with {ARMCALL}, k as (select id, left(arm, 4) as chr, annotation, count(*) as n from ac where annotation <> 'none' group by 1, 2, 3), s as (select id, sum(case when n = 2 then 1 else 0 end) as w, sum(case when n = 1 then 1 else 0 end) as o, sum(n) as t, sum(case when n = 1 and annotation = 'loss' then 1 else 0 end) as ol from k group by 1)
select m.id, cast(coalesce(w, 0) as int) as chr_whole, cast(coalesce(o, 0) as int) as arm_only, cast(coalesce(t, 0) as int) as arm_total, cast(coalesce(ol, 0) as int) as arm_only_loss from meta m left join s using (id)""", ("segment", "meta"))
def _(d):
    return N.tally_arms(N.call_arms(d.segment, _arms(d), d.meta), d.meta).select("id", "chr_whole", "arm_only", "arm_total", "arm_only_loss")


@query("gene_copy_labels", f"""with {_COPYAGG}, {ARMS}, {WM}, av as (select s.id, a.arm, coalesce(sum(s.C * (least(s."end", a."end") - greatest(s.start, a.start))), 0) / nullif(sum(least(s."end", a."end") - greatest(s.start, a.start)), 0) as aa from arms a join segment s on s.chr = a.chr and s.start <= a."end" and s."end" >= a.start group by 1, 2),
 pl as (select g.gene_id, a.arm, row_number() over (partition by g.gene_id order by least(g."end", a."end") - greatest(g.start, a.start) desc, a.start) rn from gene g join arms a on a.chr = g.chr and a.start <= g."end" and a."end" >= g.start),
 sw as (select s.id, g.gene_id, max(s.width) as w from gene g join segment s on s.chr = g.chr and s.start <= g."end" and s."end" >= g.start group by 1, 2)
select cp.id, cp.gene_id, case when cmin is null then null when cmin = 0 then 'Homo-del' when cmin >= 8 and cmin >= aa * 2 then 'Amplification' when cmin > 3 and cmin > wm and w <= 5e6 then 'Gain' when (cmin = 1 or coalesce(kmin = 0, false)) then 'LOH' else 'None' end as annotation
 from cp join pl on pl.gene_id = cp.gene_id and rn = 1 left join av on av.id = cp.id and av.arm = pl.arm left join wm on wm.id = cp.id left join sw on sw.id = cp.id and sw.gene_id = cp.gene_id""", ("segment", "gene", "meta"))
def _(d):
    gc = N.gene_copies(d.segment, d.gene, keep_all=False)
    return N.label_gene_copies(gc, d.segment, N.segment_gene_map(d.segment, d.gene), _arms(d), d.meta).select("id", "gene_id", "annotation")


@query("bin_copies", """
with b as (select chr, unnest(range(1, length, 50000)) as start, length from sizes), bb as (select chr, start, least(start + 49999, length) as "end", chr || ':' || start as name from b)
select h.chr, h.name, h.id, round(h.c * case when h.chr = 'chrX' then 2 else 1 end, 6) as avg_c from (select b.chr, b.name, s.id, sum(s.C * (least(s."end", b."end") - greatest(s.start, b.start) + 1)) / sum(case when s.C is not null then least(s."end", b."end") - greatest(s.start, b.start) + 1 end) as c
 from bb b join (select id, case chr when 'chr7' then 'chrX' when 'chr6' then 'chr6' else chr end as chr0, chr, start, "end", C from segment) s on s.chr = b.chr and s.start <= b."end" and s."end" >= b.start group by 1, 2, 3) h""", ("segment", "sizes"))
def _(d):
    from cohortloom.operators.intervals import tile_sequences

    bins = tile_sequences(d.sizes, 50000).withColumn("name", F.concat("chr", F.lit(":"), F.col("start").cast("string")))
    return N.bin_copies(d.segment, bins, d.meta).select("chr", "name", "id", F.round("avg_c", 6).alias("avg_c"))


@query("binned_recurrence", """
with e as (select var_id, id, chr1, pos1 // 100000 as b1, chr2, pos2 // 100000 as b2, caller_filter from structural)
select var_id, id, count(*) over (partition by chr1, b1, chr2, b2, caller_filter) as recurrence from e where chr1 in (select chr from sizes) and chr2 in (select chr from sizes)""", ("structural", "sizes"))
def _(d):
    bins = d.sizes.select("chr", F.explode(F.sequence(F.lit(0).cast("bigint"), F.greatest(F.col("length"), F.lit(12_000_000)), F.lit(100000).cast("bigint"))).alias("start"))
    bins = bins.select("chr", "start", (F.col("start") + 99999).alias("end"), F.concat("chr", F.lit(":"), F.col("start").cast("string")).alias("name"))
    ev = d.structural.select("var_id", "id", "chr1", "pos1", "chr2", "pos2", "caller_filter")
    return N.binned_recurrence(ev, bins, [("chr1", "pos1"), ("chr2", "pos2")], ["caller_filter"]).select("var_id", "id", "recurrence")


@query("copy_heatmap", f"""with {ARMS}, {WM}, tl as (select chr, s as start, least(s + 999999, length) as "end" from (select chr, length, unnest(range(1, length + 1, 1000000)) as s from sizes)), lv as (select distinct id from segment where C is not null),
 h as (select t.chr, t.start, s.id, sum(s.C * (least(s."end", t."end") - greatest(s.start, t.start) + 1)) / sum(least(s."end", t."end") - greatest(s.start, t.start) + 1) as tc0, max(s.C) as mx, min(s.C) as mn from tl t join segment s on s.chr = t.chr and s.start <= t."end" and s."end" >= t.start where s.id in (select id from lv) group by 1, 2, 3),
 u as (select chr, start, id, coalesce(tc0, 0) as tc, mx, mn from h union all select t.chr, t.start, lv.id, null, null, null from tl t cross join lv where not exists (select 1 from h where h.chr = t.chr and h.start = t.start))
select u.chr, cast(u.start as bigint) as start, u.id, round(tc, 6) as tile_c, case when tc is null then 'missing' when mn = 0 then 'homo-del' when mx > ploidy + 3 and mx > wm + 3 and mx > 8 then 'amplification' when mx > ploidy + 0.5 and mx > wm and mx > 2 and mx > mode then 'gain'
   when mn < ploidy - 0.5 and mn < wm and mn < 4 and mn < mode then 'loss' else 'none' end as annotation from u join wm using (id) join mo using (id) left join meta m using (id)""", ("segment", "sizes", "meta"))
def _(d):
    return N.heatmap(d.segment, d.sizes, _arms(d), d.meta).select("chr", "start", "id", F.round("tile_c", 6).alias("tile_c"), "annotation")


@query("segment_blocks", """
with o as (select *, lag(C) over w as pc, lag(K) over w as pk, row_number() over w as rn from segment window w as (partition by id, chr order by start)),
 f as (select *, case when rn = 1 or coalesce(C <> pc, false) or coalesce(K <> pk, false) then 1 else 0 end as op from o), k as (select *, sum(op) over (partition by id, chr order by start) as b from f)
select id, chr, min(start) as start, max("end") as "end", count(*) as n, max(C) as "C" from k group by id, chr, b""", ("segment",))
def _(d):
    b = N.blocks(d.segment, ("id", "chr"))
    return N.block_ranges(b, ("id", "chr")).select("id", "chr", "start", "end", "n", "C")


@query("label_runs", """
with l as (select id, chr, start, "end", cast(coalesce(C, -1) as int) as c, case when C > 2 then 'gain' when C < 2 then 'loss' else 'none' end as label from segment), f as (select *, case when label = lag(label) over (partition by id, chr order by start) then 0 else 1 end as op from l),
 k as (select *, sum(op) over (partition by id, chr order by start) as b from f) select id, chr, label, min(start) as start, max("end") as "end", string_agg(cast(c as varchar), ';' order by start) as c from k group by id, chr, label, b""", ("segment",))
def _(d):
    l = d.segment.select("id", "chr", "start", "end", F.coalesce(F.col("C"), F.lit(-1)).cast("int").alias("c"), F.when(F.col("C") > 2, "gain").when(F.col("C") < 2, "loss").otherwise("none").alias("label"))
    return N.merge_labels(l, ["id", "chr"], "start", "label", "c").select("id", "chr", "label", "start", "end", "c")


@query("repair_loh", """
with a as (select id, start, chr, C, nC, naf, case when nC in (0, 1) or C in (0, 1) then 0.0 else K end as K from segment), w as (select *, lag(C) over o as pc, lag(K) over o as pk, lead(C) over o as nc2, lead(K) over o as nk, lag(start) over o as ps, lead(start) over o as ns from a window o as (partition by id, chr order by start)),
 n as (select *, case when C = pc and C = nc2 and pk <= nk then pk when C = pc and C = nc2 and pk > nk then nk when C = pc and C <> nc2 then pk when C <> pc and C = nc2 then nk end as new from w),
 r as (select *, case when coalesce(naf, 0) < 5 and K = 0 then new else K end as k2 from n)
select id, chr, start, case when nC in (0, 1) or C in (0, 1) then 0.0 else k2 end as "K" from r""", ("segment",))
def _(d):
    return N.repair_loh(d.segment, ("id", "chr"), "start").select("id", "chr", "start", "K")


@query("segment_summary", """select id, arm as seg, count(*) as ntot, cast(sum(naf) as bigint) as naf, round(avg(lr), 6) as lr_mean, round(median(case when hq then lr end), 6) as lr_median, round(stddev_samp(case when hq then lr end), 6) as lr_sd, round(sum(case when hq then 1 else 0 end) / count(*), 6) as hq
from (select *, C is not null and C < 5 as hq from segment) group by 1, 2""", ("segment",))
def _(d):
    t = d.segment.withColumns({"hq": F.col("C").isNotNull() & F.coalesce(F.col("C") < 5, F.lit(False)), "baf": F.col("lr"), "baf_n": F.col("naf"), "gap": F.lit(0.0), "seg": F.col("arm")})
    r = lambda c: F.round(c, 6).alias(c)
    return N.segment_summary(t).select("id", "seg", "ntot", "naf", r("lr_mean"), r("lr_median"), r("lr_sd"), r("hq"))


# ---------------------------------------------------------------- instability

_T = S.Thresholds(arm_share=0.4, telomere=2_000_000, ntai_length=350, loh_length=400, lst_length=500, lst_distance=3_000_000, ai_length=450, cnloh_length=400, focal_width=700)


def _seg7(d):
    return d.segment.withColumn("centromere", F.col("width") % 5 / 20)


@query("instability_gii", f"""with {WM}, p as (select s.id, s.chr, sum(case when C <> wm then width else 0 end) as o, sum(width) as l from segment s join wm using (id) where C is not null group by 1, 2) select id, round(sum(o) / sum(l), 6) as gii, round(avg(o / l), 6) as wgii from p group by 1""", ("segment",))
def _(d):
    return S.gii(d.segment).select("id", F.round("gii", 6).alias("gii"), F.round("wgii", 6).alias("wgii"))


@query("instability_lst", """with f as (select * from segment where sC is not null and width > 500), n as (select *, lead(start) over w as ns, lead(C) over w as nc2, lead(K) over w as nk from f window w as (partition by id, arm order by start))
select i.id, count(case when ns is not null and greatest(ns - "end" - 1, 0) < 3000000 and (coalesce(C <> nc2, false) or coalesce(K <> nk, false)) then 1 end) as lst from (select distinct id from segment) i left join n using (id) group by 1""", ("segment",))
def _(d):
    return S.lst(d.segment, _T)


_AI = WM + """, ai as (select s.*, wm, width % 5 / 20 as cen, coalesce(not case when wm % 2 = 0 then K = C - K else (K <> 0 and C = wm) end, false) as ai, width / sum(width) over (partition by s.id, arm) > 0.4 as al, start < 2000000 or z.length - 2000000 < "end" as tel from segment s left join wm using (id) left join sizes z on z.chr = s.chr)"""


@query("instability_ntai_nloh", f"""with {_AI} select id, count(case when width * (1 - cen) > 350 and not al and tel and ai then 1 end) as ntai, count(case when K = 0 and C <> 0 and not al and width * (1 - cen) > 400 then 1 end) as nloh from ai group by 1""", ("segment", "sizes"))
def _(d):
    s = _seg7(d)
    return S.ntai(s, d.sizes, _T).join(S.nloh(s, _T), "id")


@query("instability_shannon", """with b as (select id, floor(sC / 0.5) as b, count(*) as n from segment where sC is not null group by 1, 2), p as (select id, n / sum(n) over (partition by id) as p from b) select id, round(-sum(p * ln(p)), 6) + 0 as si from p group by 1""", ("segment",))
def _(d):
    return S.shannon(d.segment).select("id", (F.round("si", 6) + 0).alias("si"))


@query("instability_focal_loh", """select s.id, count(case when width <= 700 and C >= ploidy + 0.75 and C >= 3 then 1 end) as fg, round(sum(case when K = 0 then width else 0 end) / sum(case when K is not null then width end), 6) as loh_portion from segment s join meta m using (id) group by 1 having count(K) > 0""", ("segment", "meta"))
def _(d):
    return S.focal_gains(d.segment, d.meta, _T).join(S.loh_portion(d.segment), "id").withColumn("loh_portion", F.round("loh_portion", 6))


@query("instability_imbalance", f"""with {_AI}, k as (select * from ai where C is not null) select id, round(sum(case when C > 0 and ai then width else 0 end) / sum(width) * count(case when C > 0 and ai and width > 450 and not al then 1 end), 6) as ai_cna, count(case when not ai and width > 450 then 1 end) as ab_cna,
 round(sum(case when C = wm and K = 0 then width else 0 end) / sum(width) * count(case when C = wm and K = 0 and width > 400 then 1 end), 6) as cn_loh from k group by 1""", ("segment", "sizes"))
def _(d):
    return S.imbalance_scores(d.segment, _T).select("id", F.round("ai_cna", 6).alias("ai_cna"), "ab_cna", F.round("cn_loh", 6).alias("cn_loh"))
