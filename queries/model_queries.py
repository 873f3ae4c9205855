"""Tile, model, purity, identity and graph queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortloom.functions import numeric as M
from cohortloom.operators import graph as G
from cohortloom.operators import identity as ID
from cohortloom.operators import model as MO
from cohortloom.operators import purity as P
from cohortloom.operators import tiles as T
from queries.registry import query

# Hourly tiles of the event stream: one sample per user, one axis per event type.
TILE = """tile as (select cast(user_id as varchar) as id, event_type as chr, event_type || (case when h < 360 then 'p' else 'q' end) as arm, cast(h * 3600 + 1 as bigint) as start, cast(h * 3600 + 3600 as bigint) as "end", h % 4 <> 0 as target, avg(value) as cov, sum(value) as n_cov, count(*) as n, h % 5 <> 0 as hq
   from (select *, (cast(floor(extract(epoch from ts)) as bigint) - 1704067200) // 3600 as h from events) group by user_id, event_type, h)"""


def _tiles(d):
    h = F.floor((F.unix_timestamp(F.col("ts").cast("timestamp")) - 1704067200) / 3600)
    e = d.events.withColumn("h", h).groupBy("user_id", "event_type", "h").agg(F.avg("value").alias("cov"), F.sum("value").alias("n_cov"), F.count("*").alias("n"))
    return e.select(
        F.col("user_id").cast("string").alias("id"), F.col("event_type").alias("chr"), F.concat("event_type", F.when(F.col("h") < 360, "p").otherwise("q")).alias("arm"),
        (F.col("h") * 3600 + 1).alias("start"), (F.col("h") * 3600 + 3600).alias("end"), (F.col("h") % 4 != 0).alias("target"), "cov", "n_cov", "n", (F.col("h") % 5 != 0).alias("hq"))


R = lambda c, n=6: F.round(c, n).alias(c)


@query("normalise_coverage", f"""with {TILE} select id, chr, start, round(1000 * cov * 3600 / (sum(cov * 3600) over (partition by id, target) / 1e6) / 3600, 6) as cov_norm from tile""")
def _(d):
    return T.normalise_coverage(_tiles(d), "cov", "cov_norm").select("id", "chr", "start", R("cov_norm"))


_LR = "lr as (select *, log2(cov / n_cov) as lr from tile), ce as (select *, lr - sum(case when hq then lr * 3600 end) over (partition by id, target) / sum(case when hq then 3600 end) over (partition by id, target) as lrc from lr)"


@query("centred_log_ratio", f"with {TILE}, {_LR} select id, chr, start, round(lrc, 6) as lr from ce")
def _(d):
    return T.centre_log_ratio(T.raw_log_ratio(_tiles(d), "cov", "n_cov", "lr"), "lr").select("id", "chr", "start", R("lr"))


@query("high_quality_tiles", f"""with {TILE} select id, count(*) as n from tile where cov * 3600 + n_cov * 3600 >= 200000 and n % 7 / 1000.0 <= 0.005 group by 1""")
def _(d):
    t = _tiles(d).withColumns({"t_cov_raw": F.col("cov"), "n_cov_raw": F.col("n_cov"), "gap": F.col("n") % 7 / 1000.0, "unmasked": F.lit(1.0), "blacklist": F.lit(0.0), "difficult": F.lit(0.0)})
    return T.high_quality(t, T.TileOptions(hq_min_coverage=200000)).filter("hq").groupBy("id").agg(F.count("*").alias("n"))


@query("noise_sd", f"""with {TILE}, df as (select id, lead(cov) over (partition by id, chr order by start) - cov as d from tile), md as (select id, median(d) as m from df where d is not null group by 1)
select df.id, case when count(*) >= 3 then round(1.4826 * median(abs(d - m)) / sqrt(2), 6) else 0 end as sd from df join md using (id) where d is not null group by 1""")
def _(d):
    return T.noise_sd(_tiles(d), "cov").withColumn("sd", F.round("sd", 6))


@query("outlier_smoothing", f"""with {TILE}, df as (select id, target, lead(cov) over (partition by id, target, chr order by start) - cov as d from tile), md as (select id, target, median(d) as m from df where d is not null group by 1, 2),
 sd as (select df.id, df.target, case when count(*) >= 3 then 1.4826 * median(abs(d - m)) / sqrt(2) else 0 end as sd from df join md on md.id = df.id and md.target = df.target where d is not null group by 1, 2),
 w as (select t.*, sd.sd, median(cov) over (partition by t.id, arm, t.target order by start rows between 10 preceding and 10 following) as med,
   greatest(max(cov) over (partition by t.id, arm, t.target order by start rows between 10 preceding and 1 preceding), max(cov) over (partition by t.id, arm, t.target order by start rows between 1 following and 10 following)) as hi,
   least(min(cov) over (partition by t.id, arm, t.target order by start rows between 10 preceding and 1 preceding), min(cov) over (partition by t.id, arm, t.target order by start rows between 1 following and 10 following)) as lo from tile t left join sd on sd.id = t.id and sd.target = t.target)
select id, chr, start, round(case when cov > hi + 4 * sd then med + 2 * sd when cov < lo - 4 * sd then med - 2 * sd else cov end, 6) as cov from w""")
def _(d):
    return T.smooth_outliers(_tiles(d), "cov").select("id", "chr", "start", R("cov"))


@query("hybrid_smoothing", f"""with {TILE}, w as (select *, avg(cov) over (partition by id, arm order by start rows between 2 preceding and 1 preceding) as l, avg(cov) over (partition by id, arm order by start rows between 1 following and 2 following) as r, row_number() over (partition by id, arm order by start) as i, count(*) over (partition by id, arm) as nn from tile)
select id, chr, start, round(case when nn >= 5 and i > 2 and i <= nn - 2 then l + r + cov - greatest(l, r, cov) - least(l, r, cov) else cov end, 6) as cov from w""")
def _(d):
    return T.smooth_hybrid(_tiles(d), "cov", 5).select("id", "chr", "start", R("cov"))


@query("pool_noise", f"""with {TILE}, s as (select *, case when cast(id as int) % 2 = 0 then 'male' else 'female' end as sex, chr = 'error' as sc from tile), b as (select s.*, p.pool from s cross join (select unnest(['male', 'female']) as pool) p where not sc or sex = p.pool),
 m as (select pool, chr, start, median(cov) as m from b group by 1, 2, 3) select b.pool, b.chr, b.start, round(stddev_samp(cov), 6) as sd, round(max(m), 6) as median, round(1.4826 * median(abs(cov - m)), 6) as mad from b join m on m.pool = b.pool and m.chr = b.chr and m.start = b.start group by 1, 2, 3""")
def _(d):
    cov = _tiles(d).withColumns({"sex": F.when(F.col("id").cast("int") % 2 == 0, "male").otherwise("female"), "sex_chr": F.col("chr") == "error", "value": F.col("cov")})
    return T.pool_noise(cov).select("pool", "chr", "start", R("sd"), R("median"), R("mad"))


@query("pool_log_ratio", f"""with {TILE}, m as (select *, median(cov) over (partition by chr, start) as m from tile), l as (select *, greatest(least(log2(cov / m), 4), -4) as lr from m), c as (select *, greatest(least(lr, least(max(lr) over (), 4)), greatest(min(lr) over (), -4)) as l2 from l)
select id, chr, start, round(l2 - median(l2) over (partition by id, chr), 6) as lr from c""")
def _(d):
    t = _tiles(d).select(F.lit("all").alias("pool"), "chr", "start", "id", F.col("cov").alias("value"))
    return T.pool_log_ratio(t).select("id", "chr", "start", R("lr"))


@query("pool_denoise")
def _(d):
    e = d.embeddings.select(F.col("vec_id").alias("start"), F.lit("c").alias("chr"), F.posexplode("embedding").alias("id", "lr")).withColumn("id", F.col("id").cast("string")).withColumn("lr", F.col("lr").cast("double"))
    return T.pool_denoise(e, T.pool_components(e, 3)).select("id", "chr", "start", R("lr", 4))


def _deflated(n, doublings=14):
    """CTEs that take the first n components out of the Gram matrix g0: a high power of it, by squaring, is a projector."""
    out = []
    for c in range(n):
        out.append(f"p{c}_0 as materialized (select i, j, v / (select sum(v) from g{c} where i = j) as v from g{c})")
        for t in range(doublings):
            out.append(f"q{c}_{t} as materialized (select a.i, b.j, sum(a.v * b.v) as v from p{c}_{t} a join p{c}_{t} b on a.j = b.i group by 1, 2)")
            out.append(f"p{c}_{t + 1} as materialized (select i, j, v / (select sum(v) from q{c}_{t} where i = j) as v from q{c}_{t})")
        last = f"p{c}_{doublings}"
        out.append(f"g{c + 1} as materialized (select g.i, g.j, g.v - p.v * (select sum(a.v * b.v) from g{c} a join {last} b on a.i = b.i and a.j = b.j) as v from g{c} g join {last} p on g.i = p.i and g.j = p.j)")
    return ", ".join(out)


@query("pool_residuals", f"""with c as materialized (select vec_id, cast(unnest(embedding) as double) as x, generate_subscripts(embedding, 1) - 1 as id from embeddings),
 g0 as materialized (select a.id as i, b.id as j, sum(a.x * b.x) as v from c a join c b using (vec_id) group by 1, 2), {_deflated(2)}
select cast(i as varchar) as id, round(sqrt(v), 4) as residual from g2 where i = j""")
def _(d):
    e = d.embeddings.select(F.col("vec_id").alias("start"), F.lit("c").alias("chr"), F.posexplode("embedding").alias("id", "lr")).withColumn("id", F.col("id").cast("string")).withColumn("lr", F.col("lr").cast("double"))
    left = T.pool_denoise(e, T.pool_components(e, 2))
    return left.groupBy("id").agg(F.round(F.sqrt(F.sum(F.col("lr") * F.col("lr"))), 4).alias("residual"))


@query("gc_correction", f"""with {TILE}, t as (select *, (start / 3600 % 97) / 97 as gc, log2(cov) as lr, cast(least(floor((start / 3600 % 97) / 97 * 200), 199) as int) as bin from tile),
 pts as (select id, target, bin, avg(gc) as ox, avg(lr) as oy, count(*) as ow from t where hq group by 1, 2, 3), ev as (select id, target, bin, coalesce(avg(case when hq then gc end), avg(gc)) as x from t group by 1, 2, 3),
 pr as (select ev.*, ox, oy, ow, abs(ox - x) as d from ev join pts on pts.id = ev.id and pts.target = ev.target),
 cu as (select *, coalesce(sum(ow) over (partition by id, target, bin order by d, ox rows between unbounded preceding and 1 preceding), 0) as c, sum(ow) over (partition by id, target, bin) as tot from pr),
 k as (select *, max(d) over (partition by id, target, bin) as h from cu where c < tot * 0.5), w as (select *, ow * case when h > 0 then pow(1 - pow(least(d / (h * 1.000001), 1), 3), 3) else 1 end as kk, ox - x as dx from k),
 s as (select id, target, bin, sum(kk) as s0, sum(kk * dx) as s1, sum(kk * dx * dx) as s2, sum(kk * oy) as t0, sum(kk * dx * oy) as t1 from w group by 1, 2, 3),
 r as (select t.*, lr - case when abs(s0 * s2 - s1 * s1) > 1e-12 then (s2 * t0 - s1 * t1) / (s0 * s2 - s1 * s1) else t0 / s0 end as r from t left join s using (id, target, bin))
select id, chr, start, round(case when target and gc > 0.2 and gc < 0.8 and r is not null then r - avg(case when hq then r end) over (partition by id, target) else lr end, 4) as lr from r""")
def _(d):
    t = _tiles(d).withColumns({"gc": F.col("start") / 3600 % 97 / 97, "lr": F.log2("cov")})
    return T.correct_bias(t, "lr").select("id", "chr", "start", R("lr", 4))


@query("snps_to_tiles", f"""with {TILE}, tl as (select * from tile where cast(id as bigint) % 3 <> 0 or target), off as (select id, bool_or(not target) as o from tl group by 1),
 h as (select p.event_id, t.start, o, row_number() over (partition by p.event_id order by t.start) rn from point p join tl t on t.id = p.id and t.chr = p.chr and p.pos between t.start - 300 and t."end" + 300 join off on off.id = p.id where t.target or not o)
select event_id, start from h where rn = 1 or not o""", ("point",))
def _(d):
    # Every third sample is without off-target tiles.
    tiles = _tiles(d).filter((F.col("id").cast("bigint") % 3 != 0) | F.col("target"))
    return T.snps_to_tiles(d.point, tiles).select("event_id", "start")


@query("tile_baf", f"""with s as (select id, chr, pos, value / 500 as af, 20 + event_id % 30 as dp, (pos - 1) // 3600 * 3600 + 1 as start from point where pos > 0)
select id, chr, start, round(sum(round(case when af < 0.5 then af else 1 - af end * dp)) / sum(dp), 6) as baf, cast(count(*) as int) as baf_n from s group by 1, 2, 3""", ("point",))
def _(d):
    s = d.point.filter("pos > 0").withColumns({"af": F.col("value") / 500, "dp": 20 + F.col("event_id") % 30, "start": F.floor((F.col("pos") - 1) / 3600) * 3600 + 1}).withColumn("end", F.col("start") + 3599)
    t = s.select("id", "chr", "start", "end").distinct()
    return T.tile_baf(t, s).select("id", "chr", "start", R("baf"), "baf_n")


SNP = """snp as (select id, chr, pos, event_id, case when event_id % 3 = 0 then 'target' else 'genome' end as source, value / 400 as n_af, cast(10 + event_id * 7 % 90 as int) as n_dp, case when event_id % 5 = 0 then '1/1' else '0/1' end as n_gt, (event_id * 13 % 100) / 100.0e0 as population_af,
  event_id % 17 = 0 as mask_strict, event_id % 19 = 0 as mask_difficult, event_id % 23 = 0 as mask_loose from point)"""


@query("pass_snps", f"""with {SNP}, q as (select id, source, quantile_cont(n_dp, case when source = 'genome' then 0.05 else 0.01 end) as lo, quantile_cont(n_dp, case when source = 'genome' then 0.95 else 0.99 end) as hi from snp group by 1, 2),
 tg as (select id, chr, min(start) - 300 as start, max("end") + 300 as "end" from (select id, event_type as chr, h * 3600 + 1 as start, h * 3600 + 3600 as "end", h from (select distinct cast(user_id as varchar) as id, event_type, (cast(floor(extract(epoch from ts)) as bigint) - 1704067200) // 3600 as h from events) where h % 4 <> 0) group by id, chr, start, "end"),
 z as (select s.*, lo, hi, mask_strict or mask_difficult as st, s.source = 'genome' as g, exists (select 1 from tg where tg.id = s.id and tg.chr = s.chr and s.pos between tg.start and tg."end") as ont from snp s join q on q.id = s.id and q.source = s.source)
select event_id, coalesce(n_gt = '0/1' and n_dp > case when g then 12 else 24 end and n_dp > lo and n_dp < hi and n_dp > case when g then 24 else 48 end and population_af > case when g then 0.025 else 0.01 end and population_af < case when g then 0.975 else 0.99 end
  and ((not st and not mask_loose and n_af > case when g then 0.36 else 0.40 end - 0.2 and n_af < case when g then 0.64 else 0.60 end + 0.2) or (st and not mask_loose and n_af > case when g then 0.36 else 0.40 end - 0.2 + 0.03 and n_af < case when g then 0.64 else 0.60 end + 0.2 - 0.03)
   or (st and mask_loose and n_af > case when g then 0.36 else 0.40 end - 0.2 + 0.06 and n_af < case when g then 0.64 else 0.60 end + 0.2 - 0.06)) and (g or ont), false) as pass from z""".replace("quantile_cont(n_dp, case when source = 'genome' then 0.05 else 0.01 end)", "case when source = 'genome' then quantile_cont(n_dp, 0.05) else quantile_cont(n_dp, 0.01) end").replace("quantile_cont(n_dp, case when source = 'genome' then 0.95 else 0.99 end)", "case when source = 'genome' then quantile_cont(n_dp, 0.95) else quantile_cont(n_dp, 0.99) end"), ("point",))
def _(d):
    e = F.col("event_id")
    s = d.point.select("id", "chr", "pos", "event_id", F.when(e % 3 == 0, "target").otherwise("genome").alias("source"), (F.col("value") / 400).alias("n_af"), (10 + e * 7 % 90).cast("int").alias("n_dp"),
                       F.when(e % 5 == 0, "1/1").otherwise("0/1").alias("n_gt"), (e * 13 % 100 / 100.0).alias("population_af"), (e % 17 == 0).alias("mask_strict"), (e % 19 == 0).alias("mask_difficult"),
                       (e % 23 == 0).alias("mask_loose"), F.lit(False).alias("somatic"), F.lit("SNV").alias("type"))
    o = T.TileOptions(het_range_genome=(0.36 - 0.2, 0.64 + 0.2), het_range_target=(0.40 - 0.2, 0.60 + 0.2))
    return T.pass_snps(s, _tiles(d), "pair", o).select("event_id", "pass")


@query("detect_sex", """with s as (select id, chr, count(case when event_id % 3 <> 0 then 1 end) as n from point group by 1, 2), t as (select id, chr, count(distinct pos // 3600) as k from point group by 1, 2), j as (select t.id, t.chr, t.k, coalesce(s.n, 0) as n from t left join s on s.id = t.id and s.chr = t.chr)
select id, case when (sum(case when chr = 'error' then n end) * 1.0 / sum(case when chr = 'error' then k end)) / (sum(case when chr not in ('error', 'view') then n end) * 1.0 / sum(case when chr not in ('error', 'view') then k end)) > 0.95 then 'female' else 'male' end as sex from j group by 1 having sum(case when chr = 'error' then n end) > 3""", ("point",))
def _(d):
    s = d.point.withColumns({"n_gt": F.when(F.col("event_id") % 3 != 0, "0/1").otherwise("1/1"), "n_pass": F.col("event_id") % 3 != 0, "t_gt": F.lit(None).cast("string"), "t_pass": F.lit(False)})
    t = d.point.select("id", "chr", F.floor(F.col("pos") / 3600).alias("start")).distinct().withColumns({"target": F.lit(True), "blacklist": F.lit(0.0), "n_cov_raw": F.lit(None).cast("double"), "t_cov_raw": F.lit(None).cast("double")})
    return T.detect_sex(s, t, T.TileOptions(sex_snp_ratio=0.95, sex_min_x_snps=3), x="error", y="view").filter("sex is not null")


@query("coverage_sex", """select cast(o_custkey as varchar) as id, case when x / y > 3 then 'XX' when x / y < 1.5 then 'XY' end as sex from (select o_custkey, sum(case when l_linenumber = 1 then l_quantity end) as x, sum(case when l_linenumber = 2 then l_quantity end) as y from lineitem join orders on l_orderkey = o_orderkey group by 1)""")
def _(d):
    c = d.lineitem.join(d.orders, F.col("l_orderkey") == F.col("o_orderkey")).filter("l_linenumber < 3").groupBy(F.col("o_custkey").cast("string").alias("id"), F.when(F.col("l_linenumber") == 1, "chrX").otherwise("chrY").alias("chr")).agg(F.sum("l_quantity").alias("reads"))
    ids = d.orders.join(d.lineitem, F.col("l_orderkey") == F.col("o_orderkey")).select(F.col("o_custkey").cast("string").alias("id")).distinct()
    return ids.join(T.coverage_sex(c.withColumn("length", F.lit(1.0))), "id", "left").select("id", "sex")


# ---------------------------------------------------------------- purity-ploidy model

_GO = MO.ModelOptions(max_c=5, grid_max_c=5, p_lo=0.3, p_hi=0.9, p_res=0.3, ploidy_lo=1.5, ploidy_hi=4.5, max_len_per_probe=1e9)


def _model_tiles(d):
    return d.segment.filter("C is not null").select("id", F.concat("chr").alias("arm"), F.substring("chr", 4, 2).cast("int").alias("seg"), F.col("lr"), F.lit(2).alias("nC"), F.lit(True).alias("hq"), F.lit(0.4).alias("sd"))


def _model_segs(d):
    return d.segment.filter("C is not null").groupBy("id", F.substring("chr", 4, 2).cast("int").alias("seg")).agg(F.sum("width").alias("len"), F.count("*").alias("nlr"))


COPY = """pt as (select 0.3 + 0.3 * i as p, 1.5 + 1.5 * j as pl, cast(j * 3 + i as varchar) as cand from (select unnest([0, 1, 2]) as i) cross join (select unnest([0, 1, 2]) as j)),
 tl as (select id, cast(substr(chr, 4) as int) as seg, lr, width from segment where C is not null), sg as (select id, seg, sum(width) as len, count(*) as nlr from tl group by 1, 2),
 x as (select tl.id, cand, p, pl, seg, c, lr, ln(exp(-0.5 * pow((lr - log2((p * c + (1 - p) * 2) / (p * pl + (1 - p) * 2))) / 0.4, 2) - ln(0.4) - 0.5 * ln(2 * pi())) * 0.99 + 0.01 / 12) as ll from tl cross join pt cross join (select unnest(range(0, 6)) as c)),
 s as (select id, cand, p, pl, seg, c, avg(lr) as lr, sum(ll) as llik from x group by all), y as (select *, greatest(least((pow(2, lr) * (p * pl + (1 - p) * 2) - (1 - p) * 2) / p, 36), 0) as sc from s),
 b as (select * from (select *, row_number() over (partition by id, cand, seg order by llik desc, case when lr > 0 then -c else c end) as rn from y) where rn = 1),
 g as (select b.id, b.cand, p, pl, sum(llik) + sum(least(2 * abs(c - sc), 1) * nlr * ln(0.5)) as l, sum(case when sc > 5 then case when sc < 5.5 then 5 else sc end when true then c end * len) / sum(len) as p1 from b join sg on sg.id = b.id and sg.seg = b.seg group by 1, 2, 3, 4)"""


@query("grid_likelihood", f"""with {COPY.replace("least(2 * abs(c - sc), 1)", "least(2 * abs(c - sc), 1)")} select id, cand, round(l, 4) as "L", round(p1, 4) as "P1" from g""", ("segment",))
def _(d):
    t = _model_tiles(d)
    return MO.grid_search(t, _model_segs(d), MO.grid_points(t, _GO), _GO).select("id", "cand", R("L", 4), R("P1", 4))


@query("grid_local_maxima", f"""with {COPY}, k as (select *, cast(cand as int) % 3 as i, cast(cand as int) // 3 as j from g) select a.id, a.cand from k a where not exists (select 1 from k b where b.id = a.id and abs(a.i - b.i) <= 1 and abs(a.j - b.j) <= 1 and round(b.l, 9) > round(a.l, 9))""", ("segment",))
def _(d):
    t = _model_tiles(d)
    g = MO.grid_search(t, _model_segs(d), MO.grid_points(t, _GO), _GO).withColumn("L", F.round("L", 9))
    return MO.local_maxima(g, 3, 3, 0.075).select("id", "cand")


AF = """pk as (select id, seg, min(c) as c from (select id, cast(substr(chr, 4) as int) as seg, cast(C as int) as c from segment where C is not null) group by 1, 2),
 sn as (select id, cast(substr(chr, 4) as int) as seg, aft as af, dpt as dp from variant), st as (select sn.*, c, k, unnest([k, c - k]) as m from sn join pk on pk.id = sn.id and pk.seg = sn.seg cross join lateral (select unnest(range(0, c // 2 + 1)) as k) u),
 ef as (select *, (0.6 * m + 0.4) / (0.6 * c + 0.8) as ef, af * least(dp, 300) + 1 as a, (1 - af) * least(dp, 300) + 1 as b, case when k * 2 = c then 0 else ln(0.5) end as pr from st),
 ll as (select *, (a - 1) * ln(ef) + (b - 1) * ln(1 - ef) + lgamma(a + b) - lgamma(a) - lgamma(b) + pr + ln(0.999) as bl, 1 + pr + ln(0.001) as ul from ef),
 l2 as (select *, greatest(bl, ul) + ln(exp(bl - greatest(bl, ul)) + exp(ul - greatest(bl, ul))) as l from ll), mm as (select id, seg, af, dp, c, k, m, l, bl < ul as anom, count(*) over (partition by id, seg, af, dp, c, k, m) as w from l2)"""


@query("allele_likelihood", f"""with {AF}, v as (select id, seg, c, k, sum(mx * n) as ll from (select id, seg, c, k, af, dp, max(l) as mx, count(*) / 2 as n from mm group by 1, 2, 3, 4, 5, 6) group by 1, 2, 3, 4)
select id, seg, cast(c as int) as "C", cast(k as int) as "K", round(ll, 4) as "aL" from (select *, row_number() over (partition by id, seg order by round(ll, 8) desc, k) rn from v) where rn = 1""", ("variant", "segment"))
def _(d):
    seg = F.substring("chr", 4, 2).cast("int").alias("seg")
    pk = d.segment.filter("C is not null").groupBy("id", seg).agg(F.min(F.col("C").cast("int")).alias("C")).withColumns({"cand": F.lit("a"), "p": F.lit(0.6), "ploidy": F.lit(2.0)})
    sn = d.variant.select("id", seg, F.col("aft").alias("af"), F.col("dpt").alias("dp"))
    return MO.allele_states(sn, pk, _GO).select("id", "seg", F.col("C").cast("int").alias("C"), F.col("K").cast("int").alias("K"), R("aL", 4))


@query("segment_models")
def _(d):
    t = _model_tiles(d)
    pts = t.select("id").distinct().select("id", F.lit("a").alias("cand"), F.lit(0.6).alias("p"), F.lit(2.5).alias("ploidy"))
    sn = d.variant.select("id", F.substring("chr", 4, 2).cast("int").alias("seg"), F.col("aft").alias("af"), F.col("dpt").alias("dp"))
    segs = _model_segs(d).withColumn("naf", F.col("nlr") * 3)
    m = MO.segment_models(t, segs, sn, pts, _GO)
    return m.select("id", "cand", "seg", "C", "K", R("sC", 4), R("tL", 4))


@query("rank_models")
def _(d):
    t = _model_tiles(d)
    pts = MO.grid_points(t, _GO).select("id", "cand", "p", "ploidy")
    sn = d.variant.select("id", F.substring("chr", 4, 2).cast("int").alias("seg"), F.col("aft").alias("af"), F.col("dpt").alias("dp"))
    segs = _model_segs(d).withColumn("naf", F.col("nlr") * 3)
    e = MO.evaluate_models(MO.segment_models(t, segs, sn, pts, _GO), _GO)
    return MO.rank_models(e).select("id", "cand", "rank", R("cP", 4), R("ploh", 4))


@query("segment_tiles")
def _(d):
    t = _tiles(d).withColumns({"lr": F.log2("cov"), "baf": F.lit(None).cast("double"), "baf_n": F.lit(0), "nvar": F.lit(None).cast("double")})
    stats = T.noise_sd(t, "lr").select("id", F.col("sd").alias("sd_lr"), F.lit(0.1).alias("sd_baf"))
    return MO.segment_tiles(t, stats, only_target=False)


# ---------------------------------------------------------------- purity

_CCF = """vs as (select v.id, v.var_id, v.chr, v.pos, aft, adt, dpt, s.C as cn, s.nC as nc, purity as p from variant v left join segment s on s.id = v.id and s.chr = v.chr and v.pos between s.start and s."end" left join meta m on m.id = v.id)"""


@query("cell_fractions", f"""with {_CCF}, mg as (select id, var_id, aft, dpt, cn, nc, p, m, (p * m) / (p * cn + 2 * (1 - p)) as ef from (select *, unnest(range(1, cast(cn as int) + 1)) as m from vs where cn >= 1)),
 ll as (select *, row_number() over (partition by id, var_id, aft, dpt, cn, nc order by (aft * least(dpt, 300)) * ln(ef) + ((1 - aft) * least(dpt, 300)) * ln(1 - ef) desc, m) as rn from mg)
select v.id, v.var_id, cast(l.m as int) as m, round(v.aft * (v.nc * (1 - v.p) + v.cn * v.p) / (v.p * l.m), 6) as ccf from vs v left join (select distinct id, var_id, aft, dpt, cn, nc, m from ll where rn = 1) l on l.id = v.id and l.var_id = v.var_id and l.aft = v.aft and l.dpt = v.dpt and l.cn = v.cn and l.nc = v.nc""", ("variant", "segment", "meta"))
def _(d):
    return P.cell_fractions(d.variant, d.segment, d.meta).select("id", "var_id", "m", R("ccf"))


@query("quick_cell_fractions", f"""with {_CCF}, u as (select *, adt / dpt / p * (p * cn + (1 - p) * nc) as u from vs) select id, var_id, case when u is not null then greatest(1.0, round(u)) end as m, round(u / greatest(1.0, round(u)), 6) as ccf from u""".replace("greatest(1.0, round(u))", "greatest(cast(1 as double), round(u))"), ("variant", "segment", "meta"))
def _(d):
    return P.quick_cell_fractions(d.variant, d.segment, d.meta).select("id", "var_id", "m", R("ccf"))


@query("purity_from_variants", """
with v as (select id, aft as x from variant), k as (select * from (select *, avg(x) over (partition by id) as m from v) where x >= m), r as (select id, x, row_number() over (partition by id order by x) as i, count(*) over (partition by id) as n from k),
 h as (select a.id, a.i, a.x, b.x - a.x as w, a.n from r a join r b on b.id = a.id and b.i = a.i + cast(ceil(a.n / 2) as bigint) - 1), f as (select *, row_number() over (partition by id order by w, x) as rn from h),
 md as (select f.id, avg(r.x) as mode from f join r on r.id = f.id and r.i between f.i and f.i + cast(ceil(f.n / 2) as bigint) - 1 where rn = 1 group by 1)
select id, round(mode, 5) as mode, round(1 / ((1 / mode - 2) / 2 + 1), 5) as purity from md""", ("variant",))
def _(d):
    return P.purity_from_variants(d.variant).select("id", R("mode", 5), R("purity", 5))


# ---------------------------------------------------------------- identity and graph

@query("genotype_calls", """
with a as (select o_custkey as id, l_linenumber as name, sum(case when l_suppkey % 4 = 0 then 1 else 0 end) as a, sum(case when l_suppkey % 4 = 1 then 1 else 0 end) as c, sum(case when l_suppkey % 4 = 2 then 1 else 0 end) as g, sum(case when l_suppkey % 4 = 3 then 1 else 0 end) as t, count(*) as tot from lineitem join orders on l_orderkey = o_orderkey group by 1, 2)
select cast(id as varchar) as id, name, case when tot >= 13 and g >= .2 * tot and t >= .2 * tot and g + t >= .9 * tot then 'G/T' when tot >= 13 and c >= .2 * tot and t >= .2 * tot and c + t >= .9 * tot then 'C/T' when tot >= 13 and c >= .2 * tot and g >= .2 * tot and c + g >= .9 * tot then 'C/G'
  when tot >= 13 and a >= .2 * tot and t >= .2 * tot and a + t >= .9 * tot then 'A/T' when tot >= 13 and a >= .2 * tot and g >= .2 * tot and a + g >= .9 * tot then 'A/G' when tot >= 13 and a >= .2 * tot and c >= .2 * tot and a + c >= .9 * tot then 'A/C'
  when t >= 3 and t >= .8 * tot then 'T' when g >= 3 and g >= .8 * tot then 'G' when c >= 3 and c >= .8 * tot then 'C' when a >= 3 and a >= .8 * tot then 'A' else 'UNKNOWN' end as final_call from a""")
def _(d):
    k = F.col("l_suppkey") % 4
    t = d.lineitem.join(d.orders, F.col("l_orderkey") == F.col("o_orderkey")).groupBy(F.col("o_custkey").cast("string").alias("id"), F.col("l_linenumber").alias("name")).agg(
        *[F.count(F.when(k == i, 1)).alias(b) for i, b in enumerate("ACGT")], F.count("*").alias("tot"))
    return t.withColumn("final_call", ID.base_call()).select("id", "name", "final_call")


@query("match_pairs", """
with a as (select user_id as id, event_type as name, sum(case when event_id % 4 = 0 then 1 else 0 end) * 1.0 as a, sum(case when event_id % 4 = 1 then 1 else 0 end) * 1.0 as c, sum(case when event_id % 4 = 2 then 1 else 0 end) * 1.0 as g, sum(case when event_id % 4 = 3 then 1 else 0 end) * 1.0 as t, count(*) * 1.0 as n from events group by 1, 2),
 p as (select x.id as i, y.id as j, x.n + y.n as w, [(x.a + 1) / (x.n + 16), (x.c + 1) / (x.n + 16), (x.g + 1) / (x.n + 16), (x.t + 1) / (x.n + 16)] as u, [(y.a + 1) / (y.n + 16), (y.c + 1) / (y.n + 16), (y.g + 1) / (y.n + 16), (y.t + 1) / (y.n + 16)] as v from a x join a y on x.name = y.name and (y.id = x.id * 2 or y.id = x.id + 1)),
 r as (select i, j, w, cast(list_sum(u) / 4 as double) as mu, cast(list_sum(v) / 4 as double) as mv, cast(u[1] as double) u1, cast(u[2] as double) u2, cast(u[3] as double) u3, cast(u[4] as double) u4, cast(v[1] as double) v1, cast(v[2] as double) v2, cast(v[3] as double) v3, cast(v[4] as double) v4 from p),
 c as (select i, j, w, ((u1 - mu) * (v1 - mv) + (u2 - mu) * (v2 - mv) + (u3 - mu) * (v3 - mv) + (u4 - mu) * (v4 - mv)) as cov, sqrt((pow(u1 - mu, 2) + pow(u2 - mu, 2) + pow(u3 - mu, 2) + pow(u4 - mu, 2)) * (pow(v1 - mv, 2) + pow(v2 - mv, 2) + pow(v3 - mv, 2) + pow(v4 - mv, 2))) as nv from r)
select cast(i as varchar) as id_1, cast(j as varchar) as id_2, round(cast(sum(case when nv > 1e-12 then cov / nv end * w) / sum(w) as double), 5) as score, count(*) as n_snps from c group by 1, 2""")
def _(d):
    k = F.col("event_id") % 4
    t = d.events.groupBy(F.col("user_id").cast("string").alias("id"), F.col("event_type").alias("name")).agg(*[F.count(F.when(k == i, 1)).alias(b) for i, b in enumerate("ACGT")])
    u = d.events.select("user_id").distinct()
    pairs = u.select(F.col("user_id").cast("string").alias("id_1"), F.explode(F.array((F.col("user_id") * 2).cast("string"), (F.col("user_id") + 1).cast("string"))).alias("id_2"))
    return ID.match_pairs(t, t, pairs).select("id_1", "id_2", R("score", 5), "n_snps")


@query("genotype_scores", """
with s as (select p_partkey as id, translate(rpad(p_name || p_brand || p_type, 166, 'a'), 'abcdefghijklmnopqrstuvwxyz #BEMPSTDLROANGUIC0123456789', 'ACGTACGTACGTACGTACGTACGTACRMYKACGTWSACGTACGTACGTACGTACGT') as g from part),
 c as (select id, sum(case when substr(g, i, 1) = substr(repeat('ACGT', 42), i, 1) then 1 else 0 end) as sc from (select id, g, unnest(range(1, 167)) as i from s) group by 1)
select id, round(100.0 * sc / max(sc) over (), 4) as score from c""")
def _(d):
    g = F.translate(F.rpad(F.concat("p_name", "p_brand", "p_type"), 166, "a"), "abcdefghijklmnopqrstuvwxyz #BEMPSTDLROANGUIC0123456789", "ACGTACGTACGTACGTACGTACGTACRMYKACGTWSACGTACGTACGTACGTACGT")
    pop = d.part.select(F.col("p_partkey").alias("id"), g.alias("genotype"))
    return ID.genotype_scores(("ACGT" * 42)[:166], pop).select("id", R("score", 4))


@query("depth_crosstab", """
with r as (select l_partkey as k, case when q = 0 then 0 when q <= 4 then 1 when q <= 8 then 2 else 3 end * 4 + case when s = 0 then 0 when s <= 4 then 1 when s <= 8 then 2 else 3 end as c from (select l_partkey, cast(l_quantity as int) % 13 as q, l_suppkey % 11 as s from lineitem)),
 n as (select k, i, count(case when c = i then 1 end) as n from r cross join (select unnest(range(0, 16)) as i) group by 1, 2) select k, string_agg(cast(n as varchar), ':' order by i) as adx from n group by 1""")
def _(d):
    r = d.lineitem.select(F.col("l_partkey").alias("k"), (F.col("l_quantity").cast("int") % 13).alias("tumor_ad"), (F.col("l_suppkey") % 11).alias("normal_ad"))
    return ID.depth_crosstab(r, ["k"])


@query("qc_metrics", """select cast(c_custkey as varchar) as id, 'cust' as "from", 'c_nationkey' as variable, cast(c_nationkey as varchar) as value from customer union all select cast(c_custkey as varchar), 'cust', 'c_mktsegment', c_mktsegment from customer
 union all select cast(o_custkey as varchar), 'ord', 'n', cast(count(*) as varchar) from orders group by 1""")
def _(d):
    c = d.customer.select(F.col("c_custkey").cast("string").alias("id"), "c_nationkey", "c_mktsegment")
    o = d.orders.groupBy(F.col("o_custkey").cast("string").alias("id")).agg(F.count("*").alias("n"))
    return ID.merge_metrics({"cust": c, "ord": o})


@query("connected_components", """
with recursive e as (select distinct 'o' || l_orderkey as a, 'p' || l_partkey as b from lineitem), u as (select a, b from e union all select b, a from e),
 r(node, c) using key (node) as (select distinct a, a from u union select u.b, min(r.c) from r join u on u.a = r.node join recurring.r as old on old.node = u.b where r.c < old.c group by u.b) select node, c as component from r""")
def _(d):
    return G.connected_components(d.lineitem.select(F.concat(F.lit("o"), F.col("l_orderkey").cast("string")).alias("src"), F.concat(F.lit("p"), F.col("l_partkey").cast("string")).alias("dst")))


@query("log_sum_exp", """select l_suppkey, round(ln(sum(exp(l_discount * 50 - 5))) + 5, 6) as lse from lineitem group by 1""")
def _(d):
    return M.log_sum_exp(d.lineitem.withColumn("x", F.col("l_discount") * 50), ["l_suppkey"], "x", "lse").withColumn("lse", F.round("lse", 6))


@query("numeric_functions", """select l_orderkey, l_linenumber, l_partkey, l_suppkey, round(1 / (1 + exp(-(l_quantity - 25) / 15 * 5)), 6) as sig, round(lgamma(l_quantity + 0.5), 6) as lg, round(-0.5 * pow(l_discount / 0.1, 2) - ln(0.1) - 0.5 * ln(2 * pi()), 6) as nd,
 round(log2((0.6 * l_linenumber + 0.8) / (0.6 * 3 + 0.8)), 6) as er from lineitem""")
def _(d):
    q = F.col("l_quantity")
    return d.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.round(M.sigmoid(q, 40, 10), 6).alias("sig"), F.round(M.log_gamma(q + 0.5), 6).alias("lg"),
                             F.round(M.normal_log_density(F.col("l_discount"), F.lit(0.0), F.lit(0.1)), 6).alias("nd"), F.round(M.expected_ratio(F.col("l_linenumber"), F.lit(0.6), F.lit(3.0)), 6).alias("er"))
