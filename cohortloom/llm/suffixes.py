"""Exact substring dedup: repeated byte strings found by a distributed merge sort of suffixes that never re-compares.

Every ``length`` bytes long string (window) is owned by one anchor inside it: the leftmost position whose hash of the next
32 bytes is the least in the window.  That choice depends on the window's bytes alone, so equal windows have their anchor
at the same place, and only suffixes that start at anchors (about one position in 180) need sorting.  An anchor's context,
from the first window it owns to the end of the last, settles everything about its windows:

1. Equal contexts are counted (by 128-bit hash, partial sums per task).  Two or more: all their windows are repeated.
2. Different contexts with the same 32 bytes at the anchor are compared, one of each kind: sorted once by what follows the
   anchor (then by what precedes it, backwards), and once the other way round.  Neighbours in the first order share the
   longest right sides, neighbours in the second the longest left sides; a window is repeated where both sides of a
   neighbour reach far enough, and cannot be where the longest right and left sides do not.
3. The few windows between the two are looked up by hash among all windows of contexts with the same anchor bytes.

The sort is a merge sort over tasks: each sorts its strings into a run and sends it front-coded (length of the common
prefix with the string before, and the rest) to the buckets between sampled splitters; a bucket merges its runs with a
loser tree that keeps each head's common prefix with the last output, compares bytes only beyond it, and gets the common
prefixes of the sorted order for free.  Splitters are whole strings, so a passage that very many texts share is split too.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.common import add, fresh, prepare, row_key, store

GRAM = 32  # bytes at an anchor; the window must be longer
CHUNK = 1 << 19  # windows handled at once
RUN_BYTES = 24 << 20  # strings that a task sorts into one run
CUT = b"\xff"  # occurs in no UTF-8 text, so a side that ends differs from one that goes on
_U = np.uint64


def gram_hashes(b: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the GRAM bytes from each position on, by doubling."""
    x = (b.astype(_U) + _U(1)) * _U(0xD6E8FEB86659FD93)
    x ^= x >> _U(32)
    factor, step = 0x2545F4914F6CDD1D, 1
    while step < GRAM:
        y = x[:-step] * _U(factor)
        y += x[step:]
        x, factor, step = y, factor * factor % (1 << 64), step * 2
    x ^= x >> _U(29)
    x *= _U(0x9E3779B97F4A7C15)
    return x ^ x >> _U(32)


def anchors(b: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None:
    """(first window, number of windows, anchor, hash at the anchor) of each anchor; None if the text is too short."""
    windows, width = len(b) - length + 1, length - GRAM + 1
    if windows < 1:
        return None
    h, low, parts = gram_hashes(b), _U((1 << 20) - 1), []
    for at in range(0, windows, CHUNK):
        n = min(windows - at, CHUNK)
        v = h[at : at + n + width - 1] & ~low  # the upper bits order, the position in the lower ones breaks ties to the left
        v |= np.arange(len(v), dtype=_U)
        v = np.concatenate([v, np.full(-len(v) % width, ~_U(0))]).reshape(-1, width)
        upto = np.minimum.accumulate(v, axis=1).ravel()
        onward = np.minimum.accumulate(v[:, ::-1], axis=1)[:, ::-1].ravel()
        parts.append((np.minimum(onward[:n], upto[width - 1 : width - 1 + n]) & low).astype(np.int64) + at)
    a = np.concatenate(parts)
    first = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]]))
    return first, np.diff(np.concatenate([first, [windows]])), a[first], h[a[first]].view(np.int64)


def common(a: bytes, b: bytes, at: int = 0) -> int:
    """Length of the common prefix, known to be ``at`` or more."""
    n = min(len(a), len(b))
    step = 16
    while at < n and a[at : at + step] == b[at : at + step]:
        at = min(n, at + step)
        step *= 2
    hi = min(n, at + step)
    while at < hi:
        mid = (at + hi + 1) // 2
        if a[at:mid] == b[at:mid]:
            at = mid
        else:
            hi = mid - 1
    return at


class Run:
    """A front-coded sorted run, read from the front."""

    def __init__(self, lcps: bytes, sizes: bytes, tails: bytes, ids: bytes):
        self.lcps, self.sizes = np.frombuffer(lcps, "<u4").tolist(), np.frombuffer(sizes, "<u4").tolist()
        self.tails, self.ids = tails, np.frombuffer(ids, "<i8").reshape(-1, 2).tolist()
        self.i, self.at, self.head, self.lcp = -1, 0, b"", 0
        self.advance()

    def advance(self) -> None:
        self.i += 1
        if self.i >= len(self.ids):
            self.head = None
            return
        self.lcp, end = self.lcps[self.i], self.at + self.sizes[self.i]
        self.head = self.head[: self.lcp] + self.tails[self.at : end]
        self.at = end


def merge(runs: list[Run]) -> Iterator[tuple[list[int], bytes, int]]:
    """(id, string, common prefix with the one before) in sorted order, by a loser tree over the runs' heads."""
    k = 1
    while k < len(runs):
        k *= 2
    runs = runs + [None] * (k - len(runs))
    known = [0] * k  # common prefix of each head with the last output
    loser = [-1] * k

    def play(a: int, b: int) -> tuple[int, int]:
        """(winner, loser) of two heads that lost to the same last output, or met it nowhere yet."""
        x, y = runs[a].head if runs[a] else None, runs[b].head if runs[b] else None
        if x is None or y is None:
            return (a, b) if y is None else (b, a)
        if known[a] != known[b]:  # the one that agrees longer with the last output is the smaller
            return (a, b) if known[a] > known[b] else (b, a)
        n = common(x, y, known[a])
        if n == len(x) or (n < len(y) and x[n] < y[n]):
            known[b] = n
            return a, b
        known[a] = n
        return b, a

    def build(node: int) -> int:
        if node >= k:
            return node - k
        w, loser[node] = play(build(2 * node), build(2 * node + 1))
        return w

    w = build(1) if k > 1 else 0
    while runs[w] and runs[w].head is not None:
        run = runs[w]
        yield run.ids[run.i], run.head, known[w]
        run.advance()
        known[w] = run.lcp  # front coding says it without a comparison
        node = (w + k) // 2
        while node:
            w, loser[node] = play(w, loser[node])
            node //= 2


def key_of(context: bytes, off: int, forward: bool) -> bytes:
    """The string that is sorted: right side then left side backwards, or the other way round behind the anchor's bytes."""
    right, left = context[off:], context[:off][::-1]
    return right + CUT + left if forward else right[:GRAM] + left + CUT + right[GRAM:]


def sides(a: bytes, b: bytes, lcp: int, forward: bool) -> tuple[int, int]:
    """(common right side, common left side) of two anchors from their sorted strings."""
    p, q = a.index(CUT), b.index(CUT)
    first = min(lcp, p, q)
    second = lcp - p - 1 if lcp > p else common(a[p + 1 :], b[q + 1 :])
    if forward:
        return first, second
    return (GRAM + second, first - GRAM) if first >= GRAM else (0, 0)


_PAIRS = "c1 bigint, c2 bigint, r int, l int, edge int, bucket int, key binary"


def neighbours(strings: DataFrame, forward: bool) -> DataFrame:
    """(c1, c2, r, l): common right and left sides with the string before and the string behind in sorted order."""
    spark = strings.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = max(1, strings.count())
    few = strings.filter(F.pmod(F.xxhash64("c1", "c2"), F.lit(1 << 20)) < max(1, int((1 << 20) * min(1.0, 8 * buckets / n))))
    sample = sorted(key_of(bytes(r.context), r.off, forward) for r in few.select("context", "off").collect())  # about 8 per bucket
    splitters = [sample[i * len(sample) // buckets] for i in range(1, buckets)] if sample else []

    def runs(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple[bytes, int, int]] = []
        size = 0
        for part in parts:
            for context, off, c1, c2 in zip(part["context"], part["off"], part["c1"], part["c2"], strict=True):
                held.append((key_of(context, off, forward), c1, c2))
                size += len(context)
            if size >= RUN_BYTES:
                yield coded(held)
                held, size = [], 0
        if held:
            yield coded(held)

    def coded(held: list) -> pd.DataFrame:
        held.sort()
        out: dict[int, list] = {}
        before = b""
        for s, c1, c2 in held:
            b = bisect_right(splitters, s)
            if b not in out:
                out[b], before = [[], [], [], []], b""
            n = common(before, s)
            o = out[b]
            o[0].append(n)
            o[1].append(len(s) - n)
            o[2].append(s[n:])
            o[3] += (c1, c2)
            before = s
        packed = [(b, np.array(x, "<u4").tobytes(), np.array(y, "<u4").tobytes(), b"".join(t), np.array(i, "<i8").tobytes()) for b, (x, y, t, i) in out.items()]
        return pd.DataFrame(packed, columns=["bucket", "lcps", "sizes", "tails", "ids"])

    def merged(part: pd.DataFrame) -> pd.DataFrame:
        bucket = int(part["bucket"].iloc[0])
        rows, before, name = [], None, None
        for name, s, lcp in merge([Run(*x) for x in zip(part["lcps"], part["sizes"], part["tails"], part["ids"], strict=True)]):
            if before is None:
                rows.append((*name, 0, 0, 1, bucket, s))
            else:
                r, le = sides(before[1], s, lcp, forward)
                rows += [(*before[0], r, le, 0, bucket, None), (*name, r, le, 0, bucket, None)]
            before = (name, s)
        if before:
            rows.append((*before[0], 0, 0, 2, bucket, before[1]))
        return pd.DataFrame(rows, columns=["c1", "c2", "r", "l", "edge", "bucket", "key"])

    schema = "bucket int, lcps binary, sizes binary, tails binary, ids binary"
    found = store(strings.select("context", "off", "c1", "c2").mapInPandas(runs, schema).groupBy("bucket").applyInPandas(merged, _PAIRS))
    edges = sorted(found.filter("edge > 0").collect(), key=lambda r: (r.bucket, r.edge))  # two per bucket
    across = []
    for a, b in zip(edges[1::2], edges[2::2], strict=False):  # the last of a bucket and the first of the next
        x, y = bytes(a.key), bytes(b.key)
        r, le = sides(x, y, common(x, y), forward)
        across += [(a.c1, a.c2, r, le), (b.c1, b.c2, r, le)]
    inner = found.filter("edge = 0").select("c1", "c2", "r", "l")
    return inner.unionByName(spark.createDataFrame(across, "c1 bigint, c2 bigint, r int, l int"))


def _union(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Disjoint, not even touching, [start, end)."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def repeated(docs: DataFrame, length: int) -> DataFrame:
    """(k1, k2, start, end): byte ranges [start, end) of repeated windows, by the two key columns of docs; with ``text``."""

    def find(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = []
            for k1, k2, text in zip(part["k1"], part["k2"], part["text"], strict=True):
                raw = text.encode("utf-8", "surrogatepass") if text else b""
                if (got := anchors(np.frombuffer(raw, np.uint8), length)) is None:
                    continue
                for s, n, a, g in zip(*(x.tolist() for x in got), strict=True):
                    d = xxhash.xxh3_128_digest(raw[s : s + n + length - 1], seed=a - s)
                    rows.append((k1, k2, s, n, a - s, g, int.from_bytes(d[:8], "big", signed=True), int.from_bytes(d[8:], "big", signed=True)))
                if len(rows) >= 100_000:
                    yield pd.DataFrame(rows, columns=["k1", "k2", "s", "n", "off", "gram", "c1", "c2"])
                    rows = []
            if rows:
                yield pd.DataFrame(rows, columns=["k1", "k2", "s", "n", "off", "gram", "c1", "c2"])

    found = store(docs.mapInPandas(find, "k1 bigint, k2 bigint, s int, n int, off int, gram bigint, c1 bigint, c2 bigint"))
    # The columns taken by first() come from one row, whichever; contexts of one class are equal bytes.
    classes = found.groupBy("c1", "c2").agg(F.count("*").alias("times"), *[F.first(c).alias(c) for c in ("gram", "k1", "k2", "s", "n", "off")])
    classes = store(classes)
    shared = classes.groupBy("gram").agg(F.count("*").alias("kinds")).filter("kinds > 1").select("gram")
    compared = classes.join(shared, "gram", "left_semi")

    def cut(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = []
            for text, places in zip(part["text"], part["places"], strict=True):
                raw = text.encode("utf-8", "surrogatepass")
                for p in places:
                    rows.append((p["c1"], p["c2"], p["gram"], p["n"], p["off"], raw[p["s"] : p["s"] + p["n"] + length - 1]))
            if rows:
                yield pd.DataFrame(rows, columns=["c1", "c2", "gram", "n", "off", "context"])

    places = compared.groupBy("k1", "k2").agg(F.collect_list(F.struct("c1", "c2", "gram", "s", "n", "off")).alias("places"))
    strings = store(docs.join(places, ["k1", "k2"]).select("text", "places").mapInPandas(cut, "c1 bigint, c2 bigint, gram bigint, n int, off int, context binary"))
    right, left = neighbours(strings, True), neighbours(strings, False)
    pairs = right.withColumn("way", F.lit(1)).unionByName(left.withColumn("way", F.lit(0)))
    sums = pairs.groupBy("c1", "c2").agg(
        F.max(F.when(F.col("way") == 1, F.col("r"))).alias("r"), F.max(F.when(F.col("way") == 0, F.col("l"))).alias("l"), F.collect_set(F.when(F.col("r") + F.col("l") >= length, F.struct("r", "l"))).alias("pairs")
    )
    facts = strings.select("c1", "c2", "gram", "n", "off").dropDuplicates(["c1", "c2"]).join(sums, ["c1", "c2"])

    @F.pandas_udf("struct<sure:array<struct<a:int,b:int>>,open:array<struct<a:int,b:int>>>")
    def settle(n: pd.Series, off: pd.Series, r: pd.Series, le: pd.Series, pairs: pd.Series) -> pd.DataFrame:
        """Windows [a, b) of the context that are repeated for sure, and those still open, from the first one on."""
        rows = []
        for n_, off_, r_, l_, p_ in zip(n, off, r, le, pairs, strict=True):
            # A window with o bytes before the anchor is number off - o; o lies between length - r and l.
            clip = lambda lo, hi, n_=n_, off_=off_: (max(0, off_ - hi), min(n_, off_ - lo + 1))
            sure = _union([s for x in p_ if (s := clip(length - x["r"], x["l"]))[0] < s[1]])
            a, b = clip(length - r_, l_)
            left = []
            for s, e in [*sure, (b, b)]:
                if a < min(s, b):
                    left.append((a, min(s, b)))
                a = max(a, e)
            rows.append(([{"a": x, "b": y} for x, y in sure], [{"a": x, "b": y} for x, y in left]))
        return pd.DataFrame(rows, columns=["sure", "open"])

    settled = store(facts.select("c1", "c2", "gram", "n", "off", settle("n", "off", "r", "l", "pairs").alias("w")).select("c1", "c2", "gram", "off", "w.*"))
    doubtful = settled.select("gram", "off", F.inline("open")).groupBy("gram").agg(F.min(F.col("off") - F.col("b") + 1).alias("lo"), F.max(F.col("off") - F.col("a")).alias("hi"))

    def spell(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = []
            for c1, c2, n, off, context, lo, hi in part[["c1", "c2", "n", "off", "context", "lo", "hi"]].itertuples(index=False):
                for o in range(max(lo, off - n + 1), min(hi, off) + 1):
                    d = xxhash.xxh3_128_digest(context[off - o : off - o + length], seed=o)
                    rows.append((c1, c2, off - o, int.from_bytes(d[:8], "big", signed=True), int.from_bytes(d[8:], "big", signed=True)))
            yield pd.DataFrame(rows, columns=["c1", "c2", "a", "d1", "d2"])

    spelt = store(strings.join(doubtful, "gram").mapInPandas(spell, "c1 bigint, c2 bigint, a int, d1 bigint, d2 bigint"))
    twice = spelt.groupBy("d1", "d2").agg(F.count("*").alias("times")).filter("times > 1").select("d1", "d2")
    looked_up = spelt.join(twice, ["d1", "d2"]).select("c1", "c2", "a", (F.col("a") + 1).alias("b"))
    some = settled.select("c1", "c2", F.inline("sure")).unionByName(looked_up)
    all_of = classes.filter("times > 1").select("c1", "c2", F.lit(0).alias("a"), F.col("n").alias("b"))
    ranges = all_of.unionByName(some).groupBy("c1", "c2").agg(F.collect_list(F.struct("a", "b")).alias("ranges"))  # at most one per window
    hit = found.select("k1", "k2", "s", "c1", "c2").join(ranges, ["c1", "c2"])
    return hit.select("k1", "k2", "s", F.inline("ranges")).select("k1", "k2", (F.col("s") + F.col("a")).alias("start"), (F.col("s") + F.col("b") - 1 + length).alias("end"))


def dedup(df: DataFrame, text: str = "text", doc_id: str = "doc_id", length: int = 400) -> DataFrame:
    """Every row with n_bytes, n_removed, n_spans, spans (array of start, end in bytes) and kept (the remaining bytes).

    A byte goes if a ``length`` bytes long string over it also starts anywhere else, in this text or another; all strings
    are judged on the input.  A NULL text is empty, shorter texts lose nothing.  Repeated rows are texts of their own, so
    each loses what the others have; NULL ids are fine.  An empty table gives an empty result; input columns named like
    the results give way.
    """
    if length <= GRAM or length > CHUNK:
        raise ValueError(f"length must be over {GRAM} and at most {CHUNK}")
    prepare(df.sparkSession)
    k1, k2 = row_key(F.col(f"`{doc_id}`"), F.col(f"`{text}`"))
    docs = df.select(k1.alias("k1"), k2.alias("k2"), F.col(f"`{text}`").alias("text")).filter(F.col("text").isNotNull() & (F.octet_length("text") >= length))
    spans = repeated(docs, length).groupBy("k1", "k2").agg(F.collect_set(F.struct("start", "end")).alias("spans"))

    @F.pandas_udf("struct<gone:array<struct<start:int,end:int>>,stays:array<struct<start:int,end:int>>>")
    def gaps(spans: pd.Series) -> pd.DataFrame:
        rows = []
        for found in spans:
            gone = _union([(x["start"], x["end"]) for x in found])
            stays = [(a, b) for a, b in zip([0, *[e for _, e in gone]], [*[s for s, _ in gone], 2**31 - 1], strict=True) if a < b]
            rows.append(tuple([{"start": a, "end": b} for a, b in x] for x in (gone, stays)))
        return pd.DataFrame(rows, columns=["gone", "stays"])

    cuts = store(spans.select("k1", "k2", gaps("spans").alias("g")).select("k1", "k2", "g.*"))
    a, b, gone, stays = (fresh(df.columns, n) for n in ("k1", "k2", "gone", "stays"))
    named = cuts.select(F.col("k1").alias(a), F.col("k2").alias(b), F.col("gone").alias(gone), F.col("stays").alias(stays))
    raw = F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary")
    out = df.withColumns({a: k1, b: k2}).join(named, [a, b], "left")
    none = F.array().cast("array<struct<start:int,end:int>>")
    kept = F.aggregate(F.col(stays), F.lit(b""), lambda acc, g: F.concat(acc, F.substring(raw, g["start"] + 1, g["end"] - g["start"])))
    results = {
        "n_bytes": F.octet_length(raw).cast("long"),
        "n_removed": F.coalesce(F.aggregate(F.col(gone), F.lit(0).cast("long"), lambda acc, g: acc + g["end"] - g["start"]), F.lit(0)).cast("long"),
        "n_spans": F.coalesce(F.size(gone), F.lit(0)).cast("long"),
        "spans": F.coalesce(F.col(gone), none),
        "kept": F.when(F.col(gone).isNull(), raw).otherwise(kept),
    }
    return add(out, results).drop(a, b, gone, stays)


#: The contract in DuckDB: every 400-byte string of every text, counted by its digest.
ORACLE = r"""
with d as (select doc_id, row_number() over () r, encode(coalesce(text, '')) b from documents),
s as (select r, unnest(range(1, octet_length(b) - 398)) i, b from d where octet_length(b) >= 400),
h as (select r, i, md5(b[i:i + 399]) k from s),
rep as (select r, i from (select r, i, count(*) over (partition by k) c from h) where c > 1),
st as (select r, i, case when i > lag(i) over (partition by r order by i) + 400 or lag(i) over (partition by r order by i) is null then 1 else 0 end o from rep),
g as (select r, min(i) a, max(i) + 399 e from (select *, sum(o) over (partition by r order by i) n from st) group by r, n),
z as (select r, a, e, coalesce(lag(e) over (partition by r order by a), 0) pe, row_number() over (partition by r order by a desc) last from g),
k as (select d.r, string_agg(hex(b[pe + 1:a - 1]), '' order by a) || max(case when last = 1 then hex(b[e + 1:octet_length(b)]) end) kept, sum(e - a + 1) n_removed, count(*) n_spans from z join d on d.r = z.r group by d.r)
select doc_id, octet_length(b) n_bytes, cast(coalesce(n_removed, 0) as bigint) n_removed, coalesce(n_spans, 0) n_spans, sha256(case when kept is null then b else unhex(kept) end) kept_sha256 from d left join k on k.r = d.r
"""
