"""Exact order statistics by selection; the small limit makes large groups of these tables take several rounds."""

from __future__ import annotations

from cohortloom.operators.order import exact_median, exact_percentiles
from queries.registry import query


@query("selected_medians", "select l_returnflag, count(*) as n, median(l_extendedprice) as median from lineitem group by 1")
def _(d):
    return exact_median(d.lineitem, ["l_returnflag"], "l_extendedprice", small=500)


@query("selected_percentiles", "select l_linestatus, count(*) as n, percentile_disc(0.2) within group (order by l_extendedprice) as pct_20, percentile_disc(0.999) within group (order by l_extendedprice) as pct_999 from lineitem group by 1")
def _(d):
    return exact_percentiles(d.lineitem, ["l_linestatus"], "l_extendedprice", {"pct_20": 0.2, "pct_999": 0.999}, small=500)
