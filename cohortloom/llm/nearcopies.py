"""Near copies by the Jaccard similarity of five-word shingles, verified exactly.

Texts with the same shingles are one node from the start.  Nodes first meet by the method of ``simhash``: one node of each
fingerprint meets the others of it, and those of fingerprints that its pivot tables find within 3 bits.  A pair may be similar
enough and differ in more bits, so the components that this leaves meet by an equality join on the keys of BANDS
bands of DEPTH minimum hashes each: a pair of similarity s shares none with probability (1 - s^DEPTH)^BANDS, 8 in a
million at 0.8 and less above.  Every link is then verified on the whole shingle sets, so none is made below 0.8.

Nodes already known to be one component need no further link.  So in each band key all nodes are first held against one
of them, a different one each round, while that joins many of them.  Nodes that still share a key with another component
then meet by prefix filtering, which is exact: of two sets that are similar enough, the rarest fifth of the shingles (and
one more) of each have one in common, at places that leave enough room behind.  So a large group of texts that share a
common part but no link makes pairs only where they share shingles that are rare in the group.
"""

from __future__ import annotations

from functools import partial, reduce
from itertools import accumulate, count

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.llm import simhash
from cohortloom.llm.common import prepare, store
from cohortloom.llm.simhash import _LOWER, pivots
from cohortloom.operators.graph import connected_components
from cohortloom.session import tasks_for

SHINGLE = 5
BANDS, DEPTH = 64, 8
_FACTORS = np.array([p & (1 << 64) - 1 | 1 for p in pivots(2 * BANDS * DEPTH)], dtype=np.uint64).reshape(2, -1)
ROWS = 256  # shingles whose hashes are mixed at once

SKETCH = "struct<n:bigint,s1:bigint,s2:bigint,keys:array<bigint>>"


def shingles_of(text: str | None) -> np.ndarray:
    """Hashes of the different word shingles in order; a shorter text is one shingle, one without words has none."""
    words = text.encode("utf-8", "surrogatepass").translate(_LOWER).split() if text else []
    if not words:
        return np.zeros(0, dtype=np.uint64)
    joined = b" ".join(words)
    ends = list(accumulate((len(w) + 1 for w in words)))
    starts = [0, *ends[:-1]]
    k = min(SHINGLE, len(words))
    digest = partial(xxhash.xxh64_intdigest, seed=42)
    return np.unique(np.array([digest(joined[a : b - 1]) for a, b in zip(starts, ends[k - 1 :], strict=False)], dtype=np.uint64))


def sketch_of(text: str | None) -> tuple[int, int, int, list[int]]:
    """Number of shingles, two hashes that name their set, and the band keys (none for a text without words)."""
    hashes = shingles_of(text)
    raw = hashes.tobytes()
    s1, s2 = (int.from_bytes(xxhash.xxh64_digest(raw, seed=s), "big", signed=True) for s in (1, 2))
    if not len(hashes):
        return 0, s1, s2, []
    least = np.full(BANDS * DEPTH, (1 << 64) - 1, dtype=np.uint64)
    for at in range(0, len(hashes), ROWS):
        mixed = (hashes[at : at + ROWS, None] ^ _FACTORS[0]) * _FACTORS[1]
        np.minimum(least, mixed.min(axis=0), out=least)
    bands = least.reshape(BANDS, DEPTH)
    return len(hashes), s1, s2, [int.from_bytes(xxhash.xxh64_digest(b.tobytes(), seed=i), "big", signed=True) for i, b in enumerate(bands)]


def sketch(text: Column) -> Column:
    @F.pandas_udf(SKETCH)
    def run(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([sketch_of(t) for t in texts], columns=["n", "s1", "s2", "keys"])

    return run(text)


def shingles(text: Column) -> Column:
    @F.pandas_udf("array<bigint>")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([shingles_of(t).view(np.int64) for t in texts])

    return run(text)


def _sizes(a: str, b: str) -> Column:
    """Sets whose sizes differ by more than a fifth are never similar enough."""
    return (5 * F.col(a) >= 4 * F.col(b)) & (5 * F.col(b) >= 4 * F.col(a))


def _close(members: DataFrame, at_most: int | None) -> DataFrame:
    """(src, dst): pairs that the fingerprints name; nodes without words name none.

    One node stands for its fingerprint, so a fingerprint that many nodes have makes one pair for each of them.
    ``at_most`` is a bound of the members, if one is known.
    """
    nodes = members.filter("n > 0").select("node", "n", "fp")
    firsts = store(nodes.groupBy("fp").agg(F.min(F.struct(F.col("node").alias("with"), F.col("n").alias("with_n"))).alias("p")).select("fp", "p.*"), at_most)
    alike = nodes.join(firsts, "fp").filter(F.col("node") != F.col("with")).select("node", "n", "with", "with_n")
    near = simhash.links(firsts.select("fp"))
    named = near.join(firsts.withColumnsRenamed({"fp": "src", "with": "node", "with_n": "n"}), "src").join(firsts.withColumnRenamed("fp", "dst"), "dst")
    pairs = alike.unionByName(named.select("node", "n", "with", "with_n")).filter(_sizes("n", "with_n"))
    return store(pairs.select(*_pair("node", "with")))


def _pair(a: str, b: str) -> list[Column]:
    return [F.least(a, b).alias("src"), F.greatest(a, b).alias("dst")]


def links(members: DataFrame, texts: DataFrame, at_most: int | None = None) -> DataFrame:
    """(node, component) of the nodes with a link: Jaccard similarity of 0.8 or more.

    ``members`` has node, n, keys and fp, once for each node (``at_most`` rows at most, if known), ``texts`` node and text, for some nodes
    several times alike.
    """
    keyed = members.select("node", "n", F.explode("keys").alias("key"))
    several = keyed.groupBy("key").agg(F.count("*").alias("c")).filter("c > 1").select("key")
    met = store(keyed.join(several, "key", "left_semi"))
    shared, close = met.count(), _close(members, at_most)
    ends = reduce(DataFrame.union, [met.select("node"), close.select("src"), close.select("dst")])
    wanted = texts.join(ends.distinct(), "node", "left_semi").dropDuplicates(["node"])
    sets = store(wanted.select("node", shingles(F.col("text")).alias("set")))

    def verified(pairs: DataFrame, at_most: int | None = None) -> DataFrame:
        """The links among pairs; ``at_most`` pairs that are narrow rows need few tasks once they are verified."""
        ends = pairs.distinct()
        for end in ("src", "dst"):
            ends = ends.join(sets.select(F.col("node").alias(end), F.col("set").alias(f"{end}_set")), end)
        same = F.size(F.array_intersect("src_set", "dst_set"))
        linked = ends.filter(9 * same >= 4 * (F.size("src_set") + F.size("dst_set"))).select("src", "dst")  # same / (all - same) >= 4 / 5
        return store(linked if at_most is None else linked.repartition(tasks_for(pairs.sparkSession, at_most)))

    def components() -> DataFrame:
        return connected_components(found, "src", "dst", at_most=found.count())

    found = verified(close, close.count())
    known = components()
    mixed_before = None
    for k in count():
        labelled = met.join(known, "node", "left").withColumn("component", F.coalesce("component", "node"))
        mixed = labelled.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo <> hi").select("key")
        rest = store(labelled.join(mixed, "key", "left_semi"), shared)
        left = rest.count()
        if not left or (mixed_before is not None and 4 * left > 3 * mixed_before):
            break
        mixed_before = left
        centre = F.min(F.struct(F.xxhash64(F.lit(k), "node").alias("h"), F.col("node").alias("with"), F.col("n").alias("with_n"), F.col("component").alias("with_component"))).alias("p")
        centres = rest.groupBy("key").agg(centre).select("key", "p.*")
        pairs = rest.join(centres, "key").filter((F.col("component") != F.col("with_component")) & _sizes("n", "with_n")).select(*_pair("node", "with"))
        found = found.unionByName(verified(pairs, left))
        known = components()
    if left:
        nodes = rest.select("node", "component").distinct()
        found = found.unionByName(verified(_rare_pairs(sets.join(nodes, "node"))))
        known = components()
    return known


def _rare_pairs(sets: DataFrame) -> DataFrame:
    """(src, dst): pairs of nodes of different components whose sets may be similar enough, by prefix and position.

    ``sets`` has node, component and set.  Every pair with a similarity of 0.8 or more is among them.
    """
    each = sets.select("node", F.explode("set").alias("s"))
    often = each.groupBy("s").agg(F.count("*").alias("f"))
    order = each.join(often, "s").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("f", "s"))).alias("o"))
    n = F.size("o")
    prefix = F.filter(F.slice(F.transform("o", lambda x, i: F.struct(x["f"].alias("f"), x["s"].alias("s"), (i + 1).alias("at"))), F.lit(1), n - F.ceil(n * 4 / 5).cast("int") + 1), lambda x: x["f"] > 1)
    rare = order.select("node", n.alias("n"), F.explode(prefix).alias("x")).join(sets.select("node", "component"), "node").select("node", "component", "n", "x.s", "x.at")
    rare = store(rare)
    a, b = rare.alias("a"), rare.alias("b")
    room = 1 + F.least(F.col("a.n") - F.col("a.at"), F.col("b.n") - F.col("b.at"))
    on = (F.col("a.s") == F.col("b.s")) & (F.col("a.node") < F.col("b.node")) & (F.col("a.component") != F.col("b.component")) & _sizes("a.n", "b.n") & (9 * room >= 4 * (F.col("a.n") + F.col("b.n")))
    return a.join(b, on).select(F.col("a.node").alias("src"), F.col("b.node").alias("dst"))


def chosen(docs: DataFrame, keys: list[str], text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``keys`` of one row of each component of near copies, one with the smallest id; ``keys`` name rows by id and text.

    NULL and empty texts are copies of each other.  An empty table gives an empty result.
    """
    prepare(docs.sparkSession)
    k1, k2 = keys
    slim = docs.select(F.col(k1).alias("k1"), F.col(k2).alias("k2"), F.col(f"`{doc_id}`").alias("id"), sketch(F.col(f"`{text}`")).alias("m"), simhash.fingerprint(F.col(f"`{text}`")).alias("fp"))
    rows = store(slim.select("k1", "k2", "id", "m.*", "fp").withColumn("row", F.monotonically_increasing_id()))  # the row numbers are fixed from here on
    best = F.min(F.struct(F.col("id").isNull().alias("a"), F.col("id").alias("b"), F.col("row").alias("c"))).alias("best")
    n = rows.count()
    nodes = store(rows.groupBy("s1", "s2").agg(F.min("row").alias("node"), best), n)
    members = rows.join(nodes.select(F.col("node").alias("row")), "row", "left_semi").withColumnRenamed("row", "node")
    places = members.select(F.col("k1").alias(k1), F.col("k2").alias(k2), "node")
    known = links(members.select("node", "n", "keys", "fp"), docs.select(k1, k2, F.col(f"`{text}`").alias("text")).join(places, [k1, k2]).select("node", "text"), n)
    joined = nodes.join(known, "node", "left").select("best", F.coalesce("component", "node").alias("root"))
    first = joined.groupBy("root").agg(F.min("best").getField("c").alias("row"))
    return rows.join(first, "row", "left_semi").select(F.col("k1").alias(k1), F.col("k2").alias(k2))
