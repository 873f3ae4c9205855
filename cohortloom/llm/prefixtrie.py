"""Prefix trie of conversations by union-find over sorted neighbours.

A conversation is cut into blocks of ``block`` turns; block j belongs to the class of what precedes it, so a class is a
small trie of its own and a long conversation is never one row.  Equal blocks of a class are one unit with a count.  Units
are sorted by ranges; each range takes the longest common prefixes (LCP) of its neighbours in descending depth and unites
them: a merge at depth d makes (or widens) the branching node at d, and the turns between it and the node below are its
chain.  That gives every node's members, children and subtree sums within the range.

Only nodes that hold the first or last unit of a range can go on in the next one.  These contracted forests are summed by
node, and each border takes back what two ranges counted twice: the path their last and first unit share.  Classes hang
together by their roots; sums over the classes below come from pointer doubling over the table of classes.

A node's sums are linear: words once for each member (a) and once for each node (w); saved_tokens is a - w.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import md5, sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.llm.common import prepare, ranked, store

BLOCK = 256
#: Conversation ids that are joined to one text before they are digested in order.
RUN = 4096
WORDS = r"[^\x20\x09-\x0D]+"
NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"

ROOT = b""  # the class of first blocks
_TURN = "array<struct<d:binary,w:bigint>>"
_PART = "kind string, id binary, parent binary, parent_low long, open boolean, level long, depth long, low long, n long, children long, leaves long, a long, w long, cls binary, turns " + _TURN + ", leaf boolean, part int"


def _hash(*parts: Column) -> Column:
    return F.unhex(F.md5(F.concat(*parts)))


def _joined(turns: Column) -> Column:
    """The digests of a block's turns, one after the other."""
    return F.unhex(F.array_join(F.transform(turns, lambda t: F.hex(t["d"])), ""))


# ---- rebuilt conversations ----------------------------------------------------------------------


def turns_of(df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, pos, t): the turns of each conversation, numbered from 0 by ``turn`` (NULL first, ties by content).

    t has the digest of (role, text) and the text's number of words; NULL role or text is empty.
    """
    r, x = F.coalesce(F.col(f"`{role}`").cast("string"), F.lit("")), F.coalesce(F.col(f"`{text}`"), F.lit(""))
    content = _hash(F.octet_length(r).cast("string").cast("binary"), F.lit(":").cast("binary"), r.cast("binary"), x.cast("binary"))
    slim = df.select(F.col(f"`{conv_id}`").cast("long").alias("conv"), F.col(f"`{turn}`").alias("turn"), F.struct(content.alias("d"), F.regexp_count(x, F.lit(WORDS)).cast("long").alias("w")).alias("t"))
    return ranked(slim.filter("conv IS NOT NULL"), ["conv"], ["turn", "t"], "pos").select("conv", "pos", "t")


def rebuilt(turns: DataFrame, own: Column, source: Column, most: int) -> DataFrame:
    """(conv, pos, len, t): the first ``own`` turns of conversation ``source`` and then a conversation's own after its first ``own``.

    ``own`` (at most ``most``) and ``source`` are expressions of conv.  A conversation without turns left has one row with pos NULL.
    """
    sizes = turns.groupBy("conv").agg(F.count("*").alias("n"))
    spread = [F.first(F.when(F.col("pos") == i, F.col("t")), ignorenulls=True).alias(f"t{i}") for i in range(most)]
    heads = turns.filter(F.col("pos") < most).groupBy("conv").agg(*spread)
    heads = heads.select(F.col("conv").alias("source"), F.array_compact(F.array(*[f"t{i}" for i in range(most)])).alias("head"))
    convs = sizes.select("conv", "n", own.cast("int").alias("own"), source.alias("source")).join(heads, "source", "left")
    convs = convs.withColumn("head", F.slice(F.coalesce("head", F.array().cast(_TURN)), F.lit(1), F.col("own")))
    convs = store(convs.select("conv", "own", "head", (F.size("head") + F.greatest(F.col("n") - F.col("own"), F.lit(0))).alias("len")))
    first = convs.select("conv", "len", F.posexplode_outer("head").alias("pos", "t")).filter("pos IS NOT NULL OR len = 0")
    after = turns.join(convs.select("conv", "own", "len", F.size("head").alias("m")), "conv").filter("pos >= own")
    return first.unionByName(after.select("conv", "len", (F.col("pos") - F.col("own") + F.col("m")).alias("pos"), "t"))


# ---- blocks and classes -------------------------------------------------------------------------


def _blocks(turns: DataFrame, block: int) -> DataFrame:
    """(conv, j, cls, turns, next, ends): the blocks of each conversation, the class of each, and that of the block after it.

    Prefix digests at block ends come from doubling: after k rounds a block's digest covers the 2^k blocks up to it, in a
    shape that depends on its number only, so equal prefixes have equal digests.
    """
    cut = turns.groupBy("conv", F.coalesce(F.floor(F.col("pos") / block), F.lit(0)).alias("j")).agg(F.max("len").alias("len"), F.sort_array(F.collect_list(F.when(F.col("pos").isNotNull(), F.struct("pos", "t")))).alias("p"))
    rows = store(cut.select("conv", "j", F.transform("p", lambda x: x["t"]).alias("turns"), (F.col("len") <= (F.col("j") + 1) * block).alias("ends")).withColumn("x", _hash(_joined(F.col("turns")))))
    last = rows.agg(F.max("j")).first()[0] or 0
    if not last:
        return rows.select("conv", "j", F.lit(ROOT).alias("cls"), "turns", F.col("x").alias("next"), "ends")
    long = store(rows.join(rows.filter("j = 1").select("conv"), "conv", "left_semi").select("conv", "j", "x"))
    step = 1
    while step <= last:
        before = long.select("conv", (F.col("j") + step).alias("j"), F.col("x").alias("y"))
        long = store(long.join(before, ["conv", "j"], "left").select("conv", "j", F.when(F.col("y").isNull(), F.col("x")).otherwise(_hash(F.col("y"), F.col("x"))).alias("x")))
        step *= 2
    named = rows.drop("x").join(long.select("conv", "j", F.col("x").alias("z")), ["conv", "j"], "left").join(long.select("conv", (F.col("j") + 1).alias("j"), F.col("x").alias("y")), ["conv", "j"], "left")
    return store(named.select("conv", "j", F.coalesce("y", F.lit(ROOT)).alias("cls"), "turns", F.coalesce("z", _hash(_joined(F.col("turns")))).alias("next"), "ends"))


# ---- one range of sorted units ------------------------------------------------------------------


class _Range:
    """Units of one class within one range, in order, and the forest that union-find makes of them."""

    def __init__(self, level: int, cls: bytes, block: int):
        self.level, self.cls, self.block = level, cls, block
        self.units: list[dict] = []
        self.lcp: list[int] = []  # with the unit before
        self.ids: list[list[bytes]] = []  # of the prefixes that are longer than lcp; the first unit has the class's root too
        self.nodes: list[dict] = []

    def add(self, unit: dict) -> None:
        digests = [t["d"] for t in unit["turns"]]
        common = 0
        if self.units:
            for a, b in zip(self.digests, digests, strict=False):
                if a != b:
                    break
                common += 1
            del self.running[common + 1 :]
        else:
            self.running = [md5(self.cls)]
        new = [] if self.units else [self.running[0].digest()]
        for d in digests[common:]:
            h = self.running[-1].copy()
            h.update(d)
            self.running.append(h)
            new.append(h.digest())
        self.digests = digests
        self.units.append(unit)
        self.lcp.append(common if len(self.units) > 1 else -1)
        self.ids.append(new)

    def _id(self, unit: int, depth: int) -> bytes:
        return self.ids[unit][depth - self.lcp[unit] - 1]

    def _close(self, part: dict, depth: int) -> int:
        """Make the nodes of a finished component from its top up to depth + 1; the last one's place."""
        turns, kids, at = self.units[part["lo"]]["turns"], part["kids"], -1
        a, w, leaves = part["a"], part["w"], part["leaves"]
        for d in range(part["top"], depth, -1):
            words = turns[d - 1]["w"] if d else 0
            a, w = a + part["n"] * words, w + words
            at = len(self.nodes)
            self.nodes.append({"lo": part["lo"], "hi": part["hi"], "depth": d, "low": part["low"], "n": part["n"], "children": len(kids), "leaves": leaves, "a": a, "w": w, "up": -1})
            for k in kids:
                self.nodes[k]["up"] = at
            kids = [at]
        part |= {"a": a, "w": w}
        return at

    def forest(self) -> list[dict]:
        """Unite neighbours in descending LCP; every component's top is the node where its units part."""
        n = len(self.units)
        boss = list(range(n))

        def find(i: int) -> int:
            while boss[i] != i:
                boss[i] = boss[boss[i]]
                i = boss[i]
            return i

        parts = [{"lo": i, "hi": i, "top": len(u["turns"]), "kids": [], "low": u["low"], "n": u["n"], "leaves": int(not u["goes_on"]), "a": 0, "w": 0, "whole": True} for i, u in enumerate(self.units)]
        for i in sorted(range(1, n), key=lambda i: -self.lcp[i]):
            d, x, y = self.lcp[i], find(i - 1), find(i)
            for p in (parts[x], parts[y]):
                if p["top"] > d:
                    p["kids"] = [self._close(p, d)]
                elif p["whole"]:
                    p["leaves"] = 0  # a unit that others go on from is no leaf
            big, small = (x, y) if len(parts[x]["kids"]) >= len(parts[y]["kids"]) else (y, x)
            p, q = parts[big], parts[small]
            p["kids"].extend(q["kids"])
            p |= {"lo": parts[x]["lo"], "hi": parts[y]["hi"], "top": d, "low": min(p["low"], q["low"]), "n": p["n"] + q["n"], "whole": False, **{k: p[k] + q[k] for k in ("leaves", "a", "w")}}
            boss[small], parts[small] = big, {}
        self._close(parts[find(0)], -1)
        return self.nodes

    def rows(self, part: int, first: bool, last: bool) -> Iterator[dict]:
        """The nodes, open if the range before or after may hold them too, and the links of units that go on."""
        nodes, n, base = self.forest(), len(self.units), self.level * self.block
        for x in nodes:
            root = not x["depth"] and self.level > 0
            x["open"] = (first and not x["lo"]) or (last and x["hi"] == n - 1) or x["depth"] == self.block or root
        for x in nodes:
            up = nodes[x["up"]] if x["up"] >= 0 else None
            yield {"kind": "node", "id": self._id(x["lo"], x["depth"]), "parent": self._parent(x, up), "parent_low": up["low"] if up and not up["open"] else None, "open": x["open"], "level": self.level, "depth": base + x["depth"], **{k: x[k] for k in ("low", "n", "children", "leaves", "a", "w")}, "cls": self.cls}
        if any(u["goes_on"] for u in self.units):
            running: list[bytes] = []
            for i, u in enumerate(self.units):
                running[self.lcp[i] + 1 :] = self.ids[i]
                if u["goes_on"]:
                    for d, x in enumerate(running):
                        yield {"kind": "link", "id": x, "parent": u["next"], "level": self.level, "depth": base + d, "cls": self.cls}

    def _parent(self, node: dict, up: dict | None) -> bytes | None:
        return None if up is None else self._id(up["lo"], up["depth"])

    def border(self, unit: dict, kind: str, part: int) -> dict:
        return {"kind": kind, "cls": self.cls, "level": self.level, "turns": unit["turns"], "leaf": not unit["goes_on"], "part": part}


def _forests(block: int):
    schema = pa.schema([("kind", pa.string()), ("id", pa.binary()), ("parent", pa.binary()), ("parent_low", pa.int64()), ("open", pa.bool_()), *[(c, pa.int64()) for c in ("level", "depth", "low", "n", "children", "leaves", "a", "w")], ("cls", pa.binary()), ("turns", pa.list_(pa.struct([("d", pa.binary()), ("w", pa.int64())]))), ("leaf", pa.bool_()), ("part", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(rows: Iterator[dict]) -> Iterator[pa.RecordBatch]:
            waiting = []
            for r in rows:
                waiting.append(r)
                if len(waiting) >= 4096:
                    yield pa.RecordBatch.from_pylist(waiting, schema)
                    waiting = []
            yield pa.RecordBatch.from_pylist(waiting, schema)

        now, first, part = None, True, None
        for batch in batches:
            for unit in batch.to_pylist():
                part = unit["part"]
                if now is None or (now.level, now.cls) != (unit["j"], unit["cls"]):
                    if now is not None:
                        yield from out(now.rows(part, first, False))
                        first = False
                    fresh_range = now is None
                    now = _Range(unit["j"], unit["cls"], block)
                    if fresh_range:
                        yield from out(iter([now.border(unit, "first", part)]))
                now.add(unit)
        if now is not None:
            yield from out(iter([now.border(now.units[-1], "last", part)]))
            yield from out(now.rows(part, first, True))

    return run


# ---- merging ------------------------------------------------------------------------------------

SUMS = ("n", "children", "leaves", "a", "w")


def _corrections(parts: DataFrame) -> DataFrame:
    """What each border between ranges counted twice: the nodes that the last unit before and the first one after share."""
    ends = parts.filter("kind IN ('first', 'last')").select("kind", "part", "level", "cls", "turns", "leaf")
    lasts = ends.filter("kind = 'last'")
    firsts = ends.filter("kind = 'first'")
    order = Window.orderBy("part")  # one row for each range
    following = firsts.select("part").withColumn("next", F.lead("part").over(order))
    met = lasts.join(following, "part").select("next", "level", "cls", "turns", "leaf").join(firsts.select(F.col("part").alias("next"), F.col("level").alias("l2"), F.col("cls").alias("c2"), F.col("turns").alias("t2")), "next")
    met = met.filter("level = l2 AND cls = c2")
    same = F.aggregate(F.arrays_zip(F.col("turns").alias("x"), F.col("t2").alias("y")), F.struct(F.lit(0).alias("k"), F.lit(True).alias("on")), lambda s, p: F.when(s["on"] & (p["x"]["d"] == p["y"]["d"]), F.struct((s["k"] + 1).alias("k"), F.lit(True).alias("on"))).otherwise(F.struct(s["k"].alias("k"), F.lit(False).alias("on"))))
    shared = met.select("level", "cls", "leaf", F.col("turns"), same["k"].alias("k"))
    each = shared.select("level", "cls", "leaf", "turns", "k", F.explode(F.sequence(F.lit(0), F.col("k"))).alias("d"))
    words = F.aggregate(F.slice("turns", F.greatest(F.col("d"), F.lit(1)), F.col("k") - F.greatest(F.col("d"), F.lit(1)) + 1), F.lit(0).cast("long"), lambda s, t: s + t["w"])
    gone = F.when(F.col("leaf") & (F.col("k") == F.size("turns")), 1).otherwise(0)
    return each.select(
        _hash(F.col("cls"), _joined(F.slice("turns", F.lit(1), F.col("d")))).alias("id"), F.lit(0).cast("long").alias("n"), F.when(F.col("d") < F.col("k"), -1).otherwise(0).cast("long").alias("children"), (-gone).cast("long").alias("leaves"), F.lit(0).cast("long").alias("a"), F.when(F.col("k") > 0, -words).otherwise(0).cast("long").alias("w"),
    )


def _class_sums(roots: DataFrame, links: DataFrame) -> DataFrame:
    """(cls, leaves, a, w) summed over each class and all classes below, by pointer doubling."""
    above = links.select(F.col("parent").alias("cls"), F.col("cls").alias("up")).distinct()
    now = store(roots.select("cls", "leaves", "a", "w").join(above, "cls", "left"))
    while now.filter("up IS NOT NULL").limit(1).count():
        given = now.filter("up IS NOT NULL").groupBy(F.col("up").alias("cls")).agg(*[F.sum(c).alias(f"{c}2") for c in ("leaves", "a", "w")])
        jump = now.select(F.col("cls").alias("up"), F.col("up").alias("further"))
        now = store(now.join(jump, "up", "left").join(given, "cls", "left").select("cls", F.col("further").alias("up"), *[(F.col(c) + F.coalesce(f"{c}2", F.lit(0))).alias(c) for c in ("leaves", "a", "w")]))
    return now.select("cls", "leaves", "a", "w")


def _digests(ends: DataFrame) -> DataFrame:
    """(id, ends_sha256): digest of the comma-joined ids that end at each node, in ascending order.

    A range of sorted (id, conv) joins its ids to texts of up to RUN; a node's texts then follow each other through one
    hash, so a node where a third of all conversations end is a few texts in a stream, never a list.
    """

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, run = None, []

        def out() -> pa.RecordBatch:
            return pa.record_batch([pa.array([node], pa.binary()), pa.array([run[0]], pa.int64()), pa.array([",".join(map(str, run))])], ["id", "first", "ids"])

        for batch in batches:
            for i, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if run and (i != node or len(run) >= RUN):
                    yield out()
                    run = []
                node = i
                run.append(c)
        if run:
            yield out()

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            ids, found = [], []
            for i, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if i == node:
                    state.update(b"," + text.encode())
                    continue
                if node is not None:
                    ids.append(node)
                    found.append(state.hexdigest())
                node, state = i, sha256(text.encode())
            yield pa.record_batch([pa.array(ids, pa.binary()), pa.array(found, pa.string())], ["id", "ends_sha256"])
        if node is not None:
            yield pa.record_batch([pa.array([node], pa.binary()), pa.array([state.hexdigest()])], ["id", "ends_sha256"])

    texts = ends.select("id", "conv").repartitionByRange("id", "conv").sortWithinPartitions("id", "conv").mapInArrow(joined, "id binary, first long, ids string")
    return texts.repartition("id").sortWithinPartitions("id", "first").mapInArrow(digested, "id binary, ends_sha256 string")


def trie(turns: DataFrame, block: int = BLOCK, salts: int = 16) -> DataFrame:
    """One row for each distinct sequence of first turns, columns NODE; ``turns`` has (conv, pos, len, t) as ``rebuilt`` makes it.

    conv_id is the smallest member, parent_conv_id that of the node one turn shorter (NULL at the root), n_convs the
    members, n_children the nodes one turn longer, n_leaves the childless nodes below or at it, saved_tokens the words of
    last turns below or at it that members after the first repeat, ends_sha256 the digest of the ids that end there.
    An empty table has no node.  Runs jobs while it is called.
    """
    prepare(turns.sparkSession)
    blocks = _blocks(turns, block)
    keyed = blocks.withColumn("h", _hash(_joined(F.col("turns"))))
    units = keyed.groupBy("j", "cls", "h").agg(F.first("turns").alias("turns"), F.first("next").alias("next"), F.count("*").alias("n"), F.min("conv").alias("low"), F.max(~F.col("ends")).alias("goes_on")).drop("h")
    by = ["j", "cls", "turns"]
    placed = units.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("part", F.spark_partition_id())
    parts = store(placed.mapInArrow(_forests(block), _PART))

    nodes = parts.filter("kind = 'node'")
    closed = nodes.filter("NOT open").select("id", "parent", "parent_low", "level", "depth", "low", *SUMS)
    found = nodes.filter("open").select("id", "parent", "parent_low", "cls", "level", "depth", "low", *SUMS)
    fixes = _corrections(parts).select("id", F.lit(None).cast("binary").alias("parent"), F.lit(None).cast("long").alias("parent_low"), F.lit(None).cast("binary").alias("cls"), F.lit(None).cast("long").alias("level"), F.lit(None).cast("long").alias("depth"), F.lit(None).cast("long").alias("low"), *SUMS)
    merged = found.unionByName(fixes).groupBy("id").agg(F.max("parent").alias("parent"), F.max("parent_low").alias("parent_low"), F.max("cls").alias("cls"), F.max("level").alias("level"), F.max("depth").alias("depth"), F.min("low").alias("low"), *[F.sum(c).alias(c) for c in SUMS])
    opened = store(merged)
    links = parts.filter("kind = 'link'")
    if links.limit(1).count():  # there are conversations of several blocks
        roots = opened.filter(F.col("level") > 0).filter(F.col("depth") == F.col("level") * block)
        total = store(_class_sums(roots, links))
        extra = links.join(total.select(F.col("cls").alias("parent"), *[F.col(c).alias(f"{c}2") for c in ("leaves", "a", "w")]), "parent").groupBy("id").agg(*[F.sum(f"{c}2").alias(f"{c}2") for c in ("leaves", "a", "w")])
        below = links.filter(F.col("depth") == (F.col("level") + 1) * block).select("id", F.col("parent").alias("cls")).distinct()
        hung = below.join(roots.select("cls", F.col("children").alias("children2"), F.col("id").alias("root")), "cls").select("id", "children2", "root")

        def completed(some: DataFrame) -> DataFrame:
            got = some.join(extra, "id", "left").join(hung.select("id", "children2"), "id", "left")
            return got.select(*[c for c in some.columns if c not in SUMS], "n", *[(F.col(c) + F.coalesce(f"{c}2", F.lit(0))).alias(c) for c in SUMS[1:]])

        opened = store(completed(opened.join(roots.select("id"), "id", "left_anti")).join(hung.select("id", "root"), "id", "left"))
        closed = completed(closed)
    else:
        opened = opened.withColumn("root", F.lit(None).cast("binary"))
    # A node whose parent is open has its parent's smallest member from the (few) open nodes; copies spread a hot parent.
    lows = opened.select(F.col("id").alias("parent"), F.col("low").alias("found")).unionByName(opened.filter("root IS NOT NULL").select(F.col("root").alias("parent"), F.col("low").alias("found")))
    spread = lows.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    every = closed.unionByName(opened.select(*closed.columns))
    named = every.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(salts)).cast("int"))
    sure = named.filter("parent_low IS NOT NULL OR parent IS NULL").drop("salt")
    asked = named.filter("parent_low IS NULL AND parent IS NOT NULL").join(spread, ["parent", "salt"]).withColumn("parent_low", F.col("found")).select(*sure.columns)
    digests = _digests(keyed.filter("ends").select(_hash(F.col("cls"), _joined(F.col("turns"))).alias("id"), "conv"))
    out = sure.unionByName(asked).join(digests, "id", "left")
    nothing = F.sha2(F.lit("").cast("binary"), 256)
    return out.select(F.col("low").alias("conv_id"), "depth", F.col("parent_low").alias("parent_conv_id"), F.col("n").alias("n_convs"), F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"), (F.col("a") - F.col("w")).alias("saved_tokens"), F.coalesce("ends_sha256", nothing).alias("ends_sha256"))


def oracle() -> str:
    """SQL for the registered query, from the nodes' definition: every prefix of every rebuilt conversation."""
    from cohortloom.llm.sqltext import CRC_TABLE, crc32

    return f"""WITH RECURSIVE {CRC_TABLE},
original AS (SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS p, md5(octet_length(encode(coalesce(role, ''))) || ':' || coalesce(role, '') || coalesce(text, '')) AS d,
  len(regexp_extract_all(coalesce(text, ''), '{WORDS}')) AS w FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT c, (SELECT 1) AS one, {crc32('c')} % 4 AS h, c - c % 20 AS s FROM (SELECT DISTINCT c FROM original), crc_table),
parts AS (SELECT v.c, 0 AS side, o.p, o.d, o.w FROM convs v JOIN original o ON o.c = v.s AND o.p <= v.h
  UNION ALL SELECT v.c, 1, o.p, o.d, o.w FROM convs v JOIN original o ON o.c = v.c AND o.p > v.h),
rebuilt AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY side, p) AS k, d, w FROM parts),
prefixes AS (SELECT c, k AS depth, sha256(string_agg(d, '') OVER (PARTITION BY c ORDER BY k)) AS id, w FROM rebuilt UNION ALL SELECT c, 0, 'root', 0 FROM convs),
steps AS (SELECT *, lag(id) OVER (PARTITION BY c ORDER BY depth) AS up, lead(id) OVER (PARTITION BY c ORDER BY depth) IS NULL AS ends FROM prefixes),
nodes AS (SELECT id, any_value(up) AS up, any_value(depth) AS depth, min(c) AS conv_id, count(*) AS n_convs, any_value(w) AS w, coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE ends), '') AS ids FROM steps GROUP BY id),
full_nodes AS (SELECT n.*, (SELECT count(*) FROM nodes m WHERE m.up = n.id) AS n_children FROM nodes n),
subtree AS (SELECT p.id, sum((n.n_convs - 1) * n.w) AS saved_tokens, sum((n.n_children = 0)::INT) AS n_leaves
  FROM full_nodes n JOIN prefixes p ON p.c = n.conv_id AND p.depth <= n.depth GROUP BY p.id)
SELECT n.conv_id, n.depth::BIGINT AS depth, u.conv_id AS parent_conv_id, n.n_convs, n.n_children, s.n_leaves::BIGINT AS n_leaves, s.saved_tokens::BIGINT AS saved_tokens, sha256(n.ids) AS ends_sha256
FROM full_nodes n JOIN subtree s USING (id) LEFT JOIN nodes u ON u.id = n.up"""
