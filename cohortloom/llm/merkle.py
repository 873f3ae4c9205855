"""Merkle tree over a dataset by slot pivots, with a membership proof for every row.

At each level the nodes of a group are numbered; ``fanout`` consecutive ones are the children of one parent.  Conditional
aggregates spread a parent's children into ``fanout`` columns, one for each slot; hashing the columns' concatenation is
the parent, and leaving a slot's own column out gives that child's siblings.  On the way down each node's siblings are
put before those of its parent, so a row's path grows level by level and no level is larger than the one below.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.common import fresh, ranked, store

FANOUT = 16
PATH = "array<struct<pre:string,post:string>>"

#: Results of ``manifest``, beside what is carried.
RESULTS = ("leaf", "subroot", "root", "path")


def digest(value: Column) -> Column:
    return F.sha2(value.cast("binary"), 256)


def leaf(*values: Column) -> Column:
    """Digest of the values, each '-' if NULL, else its UTF-8 length, ':' and itself."""
    texts = [v.cast("string") for v in values]
    return digest(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]))


def siblings_digest(path: Column) -> Column:
    """Digest of a path's siblings, level by level, left to right."""
    return digest(F.array_join(F.transform(path, lambda s: F.concat(s["pre"], s["post"])), ""))


def fold(start: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to."""
    return F.aggregate(path, start, lambda h, s: digest(F.concat(s["pre"], h, s["post"])))


def _slots(fanout: int) -> list[str]:
    return [f"c{i}" for i in range(fanout)]


def _climb(nodes: DataFrame, fanout: int) -> tuple[list[DataFrame], DataFrame | None]:
    """The parents of every level, and the last node of each group as (gn, gv, level, h).

    ``nodes`` has the group (gn: is NULL, gv), pos, the group's number of nodes n, the digest h and a struct k to carry.
    """
    levels, tops = [], nodes.filter("n = 1").select("gn", "gv", F.lit(0).alias("level"), "h")
    most = nodes.agg(F.max("n")).first()[0] or 0
    cur = nodes
    while most > 1:
        slot = F.col("pos") % fanout
        child = F.struct("h", "k") if not levels else F.struct("h")
        spread = [F.first(F.when(slot == i, child), ignorenulls=True).alias(c) for i, c in enumerate(_slots(fanout))]
        parents = cur.filter("n > 1").groupBy("gn", "gv", F.floor(F.col("pos") / fanout).alias("pos")).agg(F.max("n").alias("n"), *spread)
        hashed = parents.withColumn("h", digest(F.concat_ws("", *[f"{c}.h" for c in _slots(fanout)]))).withColumn("n", F.ceil(F.col("n") / fanout))
        levels.append(store(hashed))
        most = -(-most // fanout)
        cur = levels[-1].select("gn", "gv", "pos", "n", "h")
        tops = tops.unionByName(cur.filter("n = 1").select("gn", "gv", F.lit(len(levels)).alias("level"), "h"))
    return levels, tops


def _children(parents: DataFrame, fanout: int, *carry: str) -> DataFrame:
    """One row for each child: its digest and what it carries, its pos, and its siblings before those of its parent."""
    slots = _slots(fanout)

    def siblings(cols: list[str]) -> Column:
        return F.concat_ws("", *[f"{c}.h" for c in cols]) if cols else F.lit("")

    made = [F.when(F.col(c).isNotNull(), F.struct((F.col("pos") * fanout + i).alias("pos"), F.col(c).alias("c"), siblings(slots[:i]).alias("pre"), siblings(slots[i + 1 :]).alias("post"))) for i, c in enumerate(slots)]
    each = parents.select("gn", "gv", "path", *carry, F.explode(F.array_compact(F.array(*made))).alias("m"))
    return each.select("gn", "gv", F.col("m.pos").alias("pos"), *carry, F.concat(F.array(F.struct("m.pre", "m.post")).cast(PATH), "path").alias("path"), "m.c.*")


def _descend(levels: list[DataFrame], tops: DataFrame, leaves: DataFrame, fanout: int) -> DataFrame:
    """(k, h, path, subroot, root) of every leaf; ``tops`` has level, h, path and root for each group's last node."""

    def at(level: int) -> DataFrame:
        return tops.filter(F.col("level") == level).select("gn", "gv", F.lit(0).cast("long").alias("pos"), F.col("h").alias("subroot"), "root", "path")

    above = at(len(levels))
    for k in range(len(levels) - 1, -1, -1):
        below = _children(levels[k].drop("h", "n").join(above, ["gn", "gv", "pos"]), fanout, "subroot", "root")
        if k:
            above = store(below.select("gn", "gv", "pos", "subroot", "root", "path").unionByName(at(k)))
        else:
            alone = leaves.filter("n = 1").join(at(0).drop("pos"), ["gn", "gv"])
            return below.select("k", "h", "path", "subroot", "root").unionByName(alone.select("k", "h", "path", "subroot", "root"))
    return leaves.join(at(0).drop("pos"), ["gn", "gv"]).select("k", "h", "path", "subroot", "root")


def manifest(df: DataFrame, leaves: Column, group: str = "source", order: str = "doc_id", carry: dict[str, Column] | None = None, fanout: int = FANOUT) -> DataFrame:
    """Every row as a leaf: ``carry`` (default: ``order``), leaf, subroot, root and path (siblings before and after, level by level).

    Leaves of a group ascend by ``order``; while a group has several nodes, ``fanout`` consecutive ones (the last run:
    fewer, even one) become the digest of their concatenation.  What remains is the subroot.  The subroots, ordered by
    group (NULL first, bytewise), likewise give the root.  A group of one row is its own subroot, a single group's
    subroot the root.  NULL order values come first; rows that tie are ordered by their digest, and repeated rows are
    leaves of their own.  An empty table has no leaves and an empty result.  Carried columns named like a result give way.
    Only digests and what is carried leave the task that read a text.
    """
    carry = {order: F.col(f"`{order}`")} if carry is None else carry
    kept = {n: c for n, c in carry.items() if n.lower() not in RESULTS}
    slim = df.select(
        F.col(f"`{group}`").isNull().alias("a"), F.coalesce(F.col(f"`{group}`").cast("string"), F.lit("")).alias("gv"), F.col(f"`{order}`").alias("o"), leaves.alias("h"), F.struct(*[c.alias(n) for n, c in kept.items()], F.lit(0).alias(fresh(kept, "row"))).alias("k")
    ).withColumn("gn", ~F.col("a")).drop("a")  # NULL first
    placed = ranked(slim, ["gn", "gv"], ["o", "h"], "pos")
    rows = store(placed.join(placed.groupBy("gn", "gv").agg(F.count("*").alias("n")), ["gn", "gv"]).select("gn", "gv", "pos", "n", "h", "k"))
    levels, tops = _climb(rows, fanout)
    tops = store(tops)
    groups = ranked(tops.select(F.lit(True).alias("a"), "gn", "gv", "level", "h"), ["a"], ["gn", "gv"], "pos")
    nodes = groups.select(F.lit(True).alias("gn"), F.lit("").alias("gv"), "pos", F.struct("gn", "gv", "level").alias("k"), "h")
    nodes = nodes.join(nodes.groupBy("gn", "gv").agg(F.count("*").alias("n")), ["gn", "gv"])
    upper, top = _climb(nodes, fanout)
    top = top.select("*", F.col("h").alias("root"), F.array().cast(PATH).alias("path"))
    paths = store(_descend(upper, top, nodes, fanout).select("k.*", "h", "path", "root"))
    out = _descend(levels, paths, rows, fanout)
    return out.select(*[F.col(f"k.`{n}`").alias(n) for n in kept], F.col("h").alias("leaf"), "subroot", "root", "path")


def oracle(levels: int = 8) -> str:
    """SQL for the registered query: ``levels`` levels of 16 below the subroots and again below the root."""
    from cohortloom.llm.sqltext import CRC_TABLE, crc32

    def part(column: str) -> str:
        return f"coalesce(octet_length(encode(({column})::VARCHAR))::VARCHAR || ':' || ({column})::VARCHAR, '-')"

    def leaf_of(text: str) -> str:
        return "sha256(" + " || ".join(part(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"

    def tree(name: str, base: str, groups: str) -> list[str]:
        out = [f"{name}0 AS ({base})"]
        for k in range(levels):
            win = "(PARTITION BY {g}, pos // 16 ORDER BY pos ROWS BETWEEN {r})".format(g=groups, r="{r}")
            out.append(
                f"{name}s{k} AS (SELECT *, count(*) OVER (PARTITION BY {groups}) > 1 AS more, coalesce(string_agg(h, '') OVER {win.format(r='UNBOUNDED PRECEDING AND 1 PRECEDING')}, '') AS pre,"
                f" coalesce(string_agg(h, '') OVER {win.format(r='1 FOLLOWING AND UNBOUNDED FOLLOWING')}, '') AS post FROM {name}{k})"
            )
            out.append(f"{name}{k + 1} AS (SELECT {groups}, CASE WHEN any_value(more) THEN pos // 16 ELSE 0 END AS pos, CASE WHEN any_value(more) THEN sha256(string_agg(h, '' ORDER BY pos)) ELSE any_value(h) END AS h FROM {name}s{k} GROUP BY {groups}, pos // 16)")
        return out

    def path(name: str, groups: list[str]) -> list[str]:
        out = [f"{name}p{levels} AS (SELECT *, []::STRUCT(pre VARCHAR, post VARCHAR)[] AS path FROM {name}{levels})"]
        for k in range(levels - 1, -1, -1):
            on = " AND ".join(f"a.{g} = b.{g}" for g in groups)
            out.append(f"{name}p{k} AS (SELECT a.*, CASE WHEN a.more THEN list_prepend({{'pre': a.pre, 'post': a.post}}, b.path) ELSE b.path END AS path FROM {name}s{k} a JOIN {name}p{k + 1} b ON {on} AND a.pos // 16 = b.pos)")
        return out

    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    base = "SELECT g, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, leaf AS h, doc_id, start FROM leaves"
    tops = f"SELECT 1 AS one, row_number() OVER (ORDER BY g) - 1 AS pos, h, g FROM a{levels}"
    steps = [
        CRC_TABLE,
        f"leaves AS (SELECT doc_id, encode(coalesce('x' || source, '')) AS g, {leaf_of('text')} AS leaf, CASE WHEN {crc32('doc_id')} % 5 = 0 THEN {leaf_of(lowered)} ELSE {leaf_of('text')} END AS start FROM documents, crc_table)",
        *tree("a", base, "g"), *path("a", ["g"]), *tree("b", tops, "one"), *path("b", ["one"]),
        f"whole AS (SELECT a.doc_id, a.h AS leaf, a.start, t.h AS subroot, r.h AS root, list_concat(a.path, b.path) AS path FROM ap0 a JOIN a{levels} t ON a.g = t.g JOIN bp0 b ON a.g = b.g, b{levels} r)",
        "folded AS (SELECT *, list_reduce(list_prepend({'pre': start, 'post': ''}, path), lambda x, y: {'pre': sha256(y.pre || x.pre || y.post), 'post': ''}).pre AS folded_root FROM whole)",
    ]
    body = ",\n".join(steps)
    return f"WITH RECURSIVE {body}\nSELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(path, lambda p: p.pre || p.post), '')) AS proof_sha256, folded_root, folded_root = root AS verified FROM folded"
