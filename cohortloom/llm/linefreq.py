"""Quality rules from the frequency of lines across the documents of a host.

Lines are normalised (lower case, digits alike, white space joined) and hashed; for every host and line the distinct
texts that hold it are counted, copies of a text once.  A line is removed where that count is above both limits, and a
document that keeps too little is rejected.  The usual per-document measures come along.  DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.common import add, fresh, store

#: White space as the measures know it, as a class for Java's patterns.
WS = "\\\\x20\\\\x09-\\\\x0D"

RESULTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_removed_lines", "n_left_words", "base_failed", "kept")

#: Words in windows of three words that the text has twice or more.  Each window's hash and position share one number
#: (position in the lower bits, as many as the text needs), so sorting brings equal windows side by side; the words of
#: neighbours are compared in full.  The sorted positions then cover three words each, overlaps once.
_REPEATS = """
transform(array({words}), w ->
 transform(array(length(bin(size(w)))), b ->
  transform(array(sort_array(transform(slice(w, 1, greatest(size(w) - 2, 0)), (x, i) -> shiftleft(xxhash64(x, w[i + 1], w[i + 2]), b) | i))), s ->
   transform(array(sort_array(array_distinct(flatten(transform(
     filter(slice(transform(s, (x, j) -> j), 1, greatest(size(s) - 1, 0)), j -> shiftright(s[j], b) = shiftright(s[j + 1], b)),
     j -> transform(array(struct(int(s[j] & (shiftleft(1L, b) - 1)) as p, int(s[j + 1] & (shiftleft(1L, b) - 1)) as q)),
       v -> if(w[v.p] = w[v.q] and w[v.p + 1] = w[v.q + 1] and w[v.p + 2] = w[v.q + 2], array(v.p, v.q), array()))[0]))))), p ->
    struct(size(w) as n_words, aggregate(transform(p, (x, i) -> least(3, coalesce(get(p, i + 1), x + 3) - x)), 0L, (a, x) -> a + x) as n_repeat_words))[0])[0])[0])[0]
"""


def measures(text: Column | str) -> dict[str, Column]:
    """Struct ``words`` (n_words, n_repeat_words), counts of a text, and its lines' hashes and words."""
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    sql = f"coalesce(`{text}`, '')"
    lines = f"split({sql}, '\\n')"
    normal = f"split(regexp_replace(regexp_replace(lower({sql}), '[0-9]+', '0'), '[\\\\x20\\\\x09\\\\x0B-\\\\x0D]+', ' '), '\\n')"
    return {
        "words": F.expr(_REPEATS.format(words=f"regexp_extract_all({sql}, '[^{WS}]+', 0)")),
        "word_chars": F.length(F.regexp_replace(t, r"[\x20\x09-\x0D]+", "")).cast("long"),
        "n_symbols": F.length(F.regexp_replace(t, r"[^#*$%&|<>]+", "")).cast("long"),
        "n_dup_lines": F.expr(f"transform(array(filter({lines}, l -> l rlike '[^{WS}]')), l -> size(l) - size(array_distinct(l)))[0]").cast("long"),
        "lines": F.expr(f"transform({normal}, l -> transform(array(trim(l)), m -> struct(xxhash64(m) as h, if(m = '', 0, length(m) - length(replace(m, ' ', '')) + 1) as n))[0])"),
    }


def line_rules(df: DataFrame, text: str = "text", host: str = "source", min_docs: int = 20, share: float = 0.05, min_left: float = 0.5, keep_text: bool = True) -> DataFrame:
    """Every row with RESULTS and, with ``keep_text``, ``cleaned`` (the text without frequent lines).

    A line is frequent on its host if more than ``min_docs`` distinct texts and more than ``share`` of the host's hold
    it.  kept is false if base_failed (under 50 words, or over half of the words in repeated windows), or if fewer than
    ``min_left`` of the words are left.  A NULL text has no words and fails; NULL is a host of its own; lines without a
    word are never counted or removed.  Repeated rows are one text for the counts and get equal results.  Empty tables
    give empty results; input columns named like the results give way.  Without ``keep_text`` the text is dropped, and
    so not stored.
    """
    columns = [c for c in df.columns if c.lower() not in {*RESULTS, "cleaned"} and (keep_text or c != text)]
    row, own = fresh(df.columns, "row"), fresh(df.columns, "made")
    made = [m.alias(k) for k, m in measures(text).items()]
    wide = df.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias(own), F.col(f"`{host}`").cast("string").alias("host"), F.xxhash64(F.lit("text"), f"`{text}`").alias("th"), *made)
    # One measured table in the shared folder: the row numbers in it are fixed, and every later step reads only what it needs.
    rows = store(wide.withColumn(row, F.monotonically_increasing_id()))
    same = F.col("x.host").eqNullSafe(F.col("y.host"))
    once = rows.groupBy("host", "th").agg(F.min(row).alias("one"))
    hosts = once.groupBy("host").agg(F.count("*").alias("texts"))
    distinct = rows.join(once.select("one"), F.col(row) == F.col("one"), "left_semi").select("host", F.explode(F.array_distinct(F.expr("transform(filter(lines, l -> l.n > 0), l -> l.h)"))).alias("h"))
    counts = distinct.groupBy("host", "h").agg(F.count("*").alias("docs")).filter(F.col("docs") > min_docs)
    frequent = store(counts.alias("x").join(hosts.alias("y"), same & (F.col("docs") > share * F.col("texts"))).select("x.host", "h"))
    held = rows.select(row, "host", F.inline("lines"))
    lost = held.filter("n > 0").alias("x").join(frequent.alias("y"), (F.col("x.h") == F.col("y.h")) & same)
    sums = [F.count("*").alias("n_removed_lines"), F.sum("n").alias("gone")] + ([F.collect_set("x.h").alias("bad")] if keep_text else [])
    per_row = lost.groupBy(F.col(row).alias("r")).agg(*sums)
    out = rows.join(per_row, F.col(row) == F.col("r"), "left")
    n = F.col("words.n_words").cast("long")
    left = n - F.coalesce("gone", F.lit(0))
    failed = (n < 50) | (100 * F.col("words.n_repeat_words") > 50 * n)
    results = {
        "n_words": n, "word_chars": F.col("word_chars"), "n_symbols": F.col("n_symbols"), "n_dup_lines": F.col("n_dup_lines"), "n_repeat_words": F.col("words.n_repeat_words"),
        "n_removed_lines": F.coalesce("n_removed_lines", F.lit(0)), "n_left_words": left, "base_failed": failed, "kept": ~failed & (left >= min_left * n),
    }
    if keep_text:
        kept_lines = F.expr(f"array_join(transform(filter(transform(split({own}.`{text}`, '\\n'), (l, i) -> struct(l, i)), v -> not (lines[v.i].n > 0 and array_contains(bad, lines[v.i].h))), v -> v.l), '\\n')")
        results["cleaned"] = F.when(F.col("bad").isNull(), F.col(f"{own}.`{text}`")).otherwise(kept_lines)
    final = out.select(F.col(own), *[v.alias(k) for k, v in results.items()])
    return final.select(*[F.col(f"{own}.`{c}`").alias(c) for c in columns], *results)


#: The same for ``documents`` in DuckDB, lines compared as texts.
ORACLE = r"""
with d as (select doc_id, source, coalesce(text, '') t, text from documents),
m as (select *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') w, string_split(t, chr(10)) ls,
  string_split(regexp_replace(regexp_replace(lower(t), '[0-9]+', '0', 'g'), '[\x20\x09\x0B-\x0D]+', ' ', 'g'), chr(10)) nl, row_number() over () r from d),
tri as (select r, unnest(range(1, len(w) - 1)) i, w from m where len(w) >= 3),
trk as (select r, i, w[i:i + 2] k from tri),
dup as (select r, i from (select r, i, count(*) over (partition by r, k) c from trk) where c > 1),
cov as (select r, count(distinct i + o) n from dup, (values (0), (1), (2)) v(o) group by r),
ln as (select r, source, text, trim(l) l, len(regexp_extract_all(trim(l), '[^\x20\x09-\x0D]+')) n from (select r, source, text, unnest(nl) l from m) where trim(l) <> ''),
one as (select source, text, min(r) r from m group by all),
hosts as (select source, count(*) texts from one group by all),
frq as (select a.source, a.l from (select source, l, count(distinct r) docs from ln where r in (select r from one) group by all having count(distinct r) > 20) a
  join hosts h on a.source is not distinct from h.source and a.docs > 0.05 * h.texts),
lost as (select r, count(*) n_removed_lines, sum(n) gone from ln join frq on ln.l = frq.l and ln.source is not distinct from frq.source group by r),
b as (select doc_id, cast(len(w) as bigint) n_words, cast(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) as bigint) word_chars,
  cast(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) as bigint) n_symbols,
  cast(len(list_filter(ls, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]'))) - len(list_distinct(list_filter(ls, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))) as bigint) n_dup_lines,
  cast(coalesce(cov.n, 0) as bigint) n_repeat_words, cast(coalesce(n_removed_lines, 0) as bigint) n_removed_lines, cast(len(w) - coalesce(gone, 0) as bigint) n_left_words
  from m left join cov using (r) left join lost using (r))
select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words base_failed,
  not (n_words < 50 or 100 * n_repeat_words > 50 * n_words) and n_left_words >= 0.5 * n_words kept from b
"""
