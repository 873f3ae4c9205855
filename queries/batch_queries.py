"""Greedy interval batches."""

from __future__ import annotations

from cohortloom.operators.batches import batch_summary, greedy_batches
from queries.registry import query


def _batches(group: str, limit: int) -> str:
    """Batches by definition: from each beginning to the row that reaches the limit, one after the other."""
    by = f"partition by {group} " if group else ""
    cols = f"{group}, " if group else ""
    same = f"x.{group} = y.{group} and " if group else ""
    return f"""with recursive o as materialized (select *, row_number() over ({by}order by chr, start, "var_id") - 1 as rn, sum(width) over ({by}order by chr, start, "var_id" rows unbounded preceding) as running from segment),
 v as (select {cols}rn, running as at_sum, 1 as mark from o union all select {cols}rn, running - width + {limit}, 0 from o),
 nxt as materialized (select {cols}rn, n + 1 as after from (select *, sum(mark) over ({by}order by at_sum, mark rows unbounded preceding) as n from v) where mark = 0),
 begun as (select {cols}0::bigint as rn from o where o.rn = 0 union all select {'x.' + group + ', ' if group else ''}y.after::bigint from begun x join nxt y on {same}x.rn = y.rn),
 r as (select x.*, sum((y.rn is not null)::int) over ({'partition by x.' + group + ' ' if group else ''}order by x.rn rows unbounded preceding)::bigint - 1 as batch from o x left join begun y on {same}x.rn = y.rn)"""


def _segments(d):
    return d.segment.select("id", "chr", "start", "end", "width", "var_id")


# Widths are positive, so the rows whose running sum stays below a limit are those before the one that closes.
@query("interval_batches", _batches("", 1_000_000) + " select chr, start, \"end\", var_id, batch from r", ("segment",))
def _(d):
    return greedy_batches(_segments(d), ["chr", "start", "var_id"], "width", 1_000_000).select("chr", "start", "end", "var_id", "batch")


@query("interval_batch_totals", _batches("chr", 20_000) + " select chr, batch, count(*) as n, cast(sum(width) as bigint) as total from r group by 1, 2", ("segment",))
def _(d):
    return batch_summary(greedy_batches(_segments(d), ["start", "var_id"], "width", 20_000, keys=["chr"]), "width", ["chr"])
