"""Queries of smaller operators: prefilters, report shape, read totals, numeric and text helpers."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortloom.functions import numeric as M
from cohortloom.functions import text as X
from cohortloom.operators import fusions as FU
from cohortloom.operators import variants as V
from queries.fusion_queries import HR, JK, OH, TOPO, _topo
from queries.registry import query


@query("snp_prefilter", """select id, var_id from variant where length(ref) = 1 and length(alt) = 1 and nlod <> 3 and dpt > 30 and dpn > 80""", ("variant",))
def _(d):
    v = d.variant.withColumn("qual", F.when(F.col("nlod") != 3, F.col("tlod")))
    return V.snp_prefilter(v.withColumn("dpt", F.when(F.col("dpt") > 0, F.col("dpt"))), 30, ["dpt"]).filter("dpn > 80").select("id", "var_id")


@query("keep_supported", """select id, var_id, case when chr = 'chr5' and alt = 'A' and pos in (1295113, 1295135) and (gene_name = 'TERT' or pos = 1295113) then 'HIGH' else impact end as impact from variant where adt > 2 or adn > 2""", ("variant",))
def _(d):
    return V.keep_supported(d.variant).select("id", "var_id", "impact")


@query("variant_report", """select id, var_id, nullif(hgvsp, '') as hgvsp, coalesce(cosmic_cnt, 0) as cosmic_cnt, adt * 30 / nullif(adt, 0) as mqs, str_len, str_len - cast(ecnt as int) as str_diff, cast(null as int) as dbq
from (select id, var_id, case when ecnt = 2 then '' else hgvsp end as hgvsp, case when ecnt <> 3 then cosmic_cnt end as cosmic_cnt, adt, str_len, ecnt from variant)""", ("variant",))
def _(d):
    v = d.variant.select("id", "var_id", F.when(F.col("ecnt") == 2, "").otherwise(F.col("hgvsp")).alias("hgvsp"), F.when(F.col("ecnt") != 3, F.col("cosmic_cnt")).alias("cosmic_cnt"), "adt", (F.col("adt") * 30).alias("qss_alt"), F.array("str_len", F.col("ecnt").cast("int")).alias("rpa"))
    return V.variant_report(v, {"dbq": "int"}).select("id", "var_id", "hgvsp", "cosmic_cnt", "mqs", "str_len", "str_diff", "dbq")


@query("read_totals", f"""with {TOPO}, {HR}, t as (select *, sum(case when l1 = 'enc' then sum_jnc else 0 end) over c as tot_enc, sum(case when l1 = 'spn' then sum_jnc else 0 end) over c as tot_jnc,
  sum(sum_jnc) over (partition by id, chr_5, pos_5, str_5, l1) as tot_jnc_5, sum(sum_jnc) over (partition by id, chr_3, pos_3, str_3, l1) as tot_jnc_3 from hr window c as (partition by id, l51, l31, l52, l32))
select {JK}, cast(tot_enc as bigint) as tot_enc, cast(tot_jnc as bigint) as tot_jnc, cast(tot_jnc_5 as bigint) as tot_jnc_5, cast(tot_jnc_3 as bigint) as tot_jnc_3, unq_rec_5 >= 3 or unq_rec_3 >= 3 as ts_warn from t""", ("junction",))
def _(d):
    cols = ("tot_enc", "tot_jnc", "tot_jnc_5", "tot_jnc_3")
    return FU.read_totals(FU.recurrent(_topo(d), OH)).select(*FU.KEY, *[F.col(c).cast("bigint").alias(c) for c in cols], "ts_warn")


@query("group_numbers", """select l_suppkey, round(abs(median(l_quantity) - median(l_tax * 100)), 6) as gap, round(least(sum(l_quantity), sum(l_discount * 300)), 4) as low, round(median(l_extendedprice), 4) as mid from lineitem group by 1""")
def _(d):
    g = d.lineitem.groupBy("l_suppkey").agg(M.abs_median_difference(F.col("l_quantity"), F.col("l_tax") * 100).alias("gap"), M.min_of_sums(F.col("l_quantity"), F.col("l_discount") * 300).alias("low"), M.median(F.col("l_extendedprice")).alias("mid"))
    return g.select("l_suppkey", F.round("gap", 6).alias("gap"), F.round("low", 4).alias("low"), F.round("mid", 4).alias("mid"))


@query("zeroed_rounded", """select id, var_id, coalesce(adn, 0) as adn, round(coalesce(afn, 0), 3) as afn, dbsnp, clinvar from variant""", ("variant",))
def _(d):
    v = d.variant.select("id", "var_id", "adn", "afn", "dbsnp", "clinvar")
    return M.round_doubles(M.zero_nulls(v, omit=["dbsnp"]), 3)


@query("blanks_and_percents", """select event_id, nullif(k, '') as filled, coalesce(k, '') as blank, cast(cast(round(value / 500 * 100) as bigint) as varchar) || '%' as share
from (select event_id, case when event_id % 5 = 0 then '' when event_id % 7 = 0 then null else event_type end as k, floor(value) as value from events) where abs(value / 5 - floor(value / 5) - 0.5) > 0.01""")
def _(d):
    k = F.when(F.col("event_id") % 5 == 0, "").when(F.col("event_id") % 7 == 0, None).otherwise(F.col("event_type"))
    e = d.events.select("event_id", k.alias("k"), F.floor("value").alias("value")).filter("abs(value / 5 - floor(value / 5) - 0.5) > 0.01")
    return e.select("event_id", X.blank_to_null(F.col("k")).alias("filled"), X.null_to_blank(F.col("k")).alias("blank"), X.percent(F.col("value") / 500).alias("share"))
