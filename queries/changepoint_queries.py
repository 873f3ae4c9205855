"""Change points of the events' counts and sums along their values, per type; chunks are small here so that splits fall into and between many of them."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortloom.operators.changepoints import change_points, joint_segments
from queries.registry import query

# Splits of ranges as a recursive table: each step takes the best place of every range, the first of equal ones.
_SPLITS = """y as (select event_type as type, d, kind, case when kind = 0 then q else n end as y from (select event_type, cast(floor(value) as bigint) as d, cast(sum(user_id) as double) as q, cast(count(*) as double) as n from events group by 1, 2), (values (0), (1)) v(kind)),
 p as (select type, kind, d, y, row_number() over w - 1 as i, sum(y) over w - y as s, y - lag(y) over w as dif from y window w as (partition by type, kind order by d)),
 st as (select type, kind, count(*) as n, sum(y) as tot, median(dif) as md, stddev_pop(y) as sp from p group by 1, 2),
 mad as (select type, kind, 1.4826 * median(abs(dif - md)) / sqrt(2.0) as sd from p join st using (type, kind) group by 1, 2),
 rng as (select type, kind, cast(0 as bigint) as a, n as b, cast(0 as double) as sa, tot as sb, sqrt(2 * ln(n / 0.01)) * coalesce(case when sd > 0 then sd end, case when sp > 0 then sp end, 1.0) as lim from st join mad using (type, kind)
  union all
  select type, kind, case side when 0 then a else x end, case side when 0 then x else b end, case side when 0 then sa else s end, case side when 0 then s else sb end, lim
  from (select type, kind, a, b, sa, sb, lim, x, s from
    (select r.type, r.kind, r.a, r.b, r.sa, r.sb, r.lim, p.i as x, p.s, abs((p.s - r.sa) - (p.i - r.a) * (r.sb - r.sa) / (r.b - r.a)) / sqrt((p.i - r.a) * (r.b - p.i) / (r.b - r.a)) as q
     from rng r join p on p.type = r.type and p.kind = r.kind and p.i between r.a + 2 and r.b - 2)
    where q > lim qualify row_number() over (partition by type, kind, a order by q desc, x) = 1), (values (0), (1)) t(side)),
 cut as (select distinct type, kind, d, i from p join (select distinct type, kind, a as i from rng where a > 0) using (type, kind, i))"""


def _profile(d):
    step = F.floor("value").alias("d")
    return d.events.groupBy(F.col("event_type").alias("type"), step).agg(F.sum("user_id").cast("double").alias("q"), F.count("*").cast("double").alias("n"))


@query("change_points", f"with recursive {_SPLITS} select type, d, cast(i as bigint) as \"at\" from cut where kind = 0")
def _(d):
    return change_points(_profile(d), ["type"], "d", "q", chunk=32)


@query("joint_segments", f"with recursive {_SPLITS}, c as (select distinct type, d, 1 as new from cut) select type, d, cast(1 + sum(coalesce(new, 0)) over (partition by type order by d) as bigint) as seg from (select distinct type, d from y) left join c using (type, d)")
def _(d):
    return joint_segments(_profile(d), ["type"], "d", ["q", "n"], chunk=32).select("type", "d", "seg")
