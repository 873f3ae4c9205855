"""SimHash near-duplicates linked through pivot distance tables.

Texts with equal fingerprints are one node from the start, so copies cost nothing.  For each node the Hamming distances
to a fixed set of reference fingerprints (pivots) are computed once; by the triangle inequality two fingerprints within
``bits`` of each other differ by at most ``bits`` in every coordinate, so a pair is discarded by its largest coordinate
difference and only survivors are verified bit by bit.

Which pairs meet at all is an equality join: the 64 bits are cut into ``bits + 2`` blocks; two fingerprints within
``bits`` agree on at least two of them, so they share the key of at least one pair of blocks.  No pair is missed and
none beyond such a group is made.
"""

from __future__ import annotations

from functools import partial, reduce
from itertools import accumulate, combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.common import add, fresh, prepare, store
from cohortloom.operators.graph import connected_components

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
ROWS = 1 << 14  # hashes whose bits are counted at once


def fingerprint_of(text: str | None, shingle: int) -> int:
    """SimHash over word shingles, repeats included; a bit is set if more than half of the hashes have it."""
    words = text.encode("utf-8", "surrogatepass").translate(_LOWER).split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate((len(w) + 1 for w in words)))
    starts = [0, *ends[:-1]]
    k = min(shingle, len(words))
    digest = partial(xxhash.xxh64_digest, seed=42)
    ones, n = np.zeros(64, dtype=np.int64), len(words) - k + 1
    for at in range(0, n, ROWS):
        stop = min(n, at + ROWS)
        raw = b"".join([digest(joined[a : b - 1]) for a, b in zip(starts[at:stop], ends[at + k - 1 : stop + k - 1], strict=True)])
        ones += np.unpackbits(np.frombuffer(raw, dtype=np.uint8)).reshape(-1, 64).sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big", signed=True)


def fingerprint(text: Column, shingle: int = 3) -> Column:
    """The fingerprint as a signed 64-bit number; 0 for NULL and for texts without words."""

    @F.pandas_udf("long")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint_of(t, shingle) for t in texts], dtype="int64")

    return run(text)


def pivots(n: int) -> list[int]:
    """Reference fingerprints: the first n numbers of a fixed 64-bit mixer, as signed numbers."""
    out, mask = [], (1 << 64) - 1
    for i in range(1, n + 1):
        z = i * 0x9E3779B97F4A7C15 & mask
        z = (z ^ z >> 30) * 0xBF58476D1CE4E5B9 & mask
        z = (z ^ z >> 27) * 0x94D049BB133111EB & mask
        z ^= z >> 31
        out.append(z - (1 << 64) if z >> 63 else z)
    return out


def _masks(bits: int) -> list[int]:
    """A mask for each pair of the bits + 2 blocks."""
    n = bits + 2
    cuts = [round(64 * i / n) for i in range(n + 1)]
    blocks = [sum(1 << b for b in range(lo, hi)) for lo, hi in zip(cuts, cuts[1:], strict=False)]
    return [m - (1 << 64) if (m := a | b) >> 63 else m for a, b in combinations(blocks, 2)]


def links(fingerprints: DataFrame, bits: int = 3, n_pivots: int = 8) -> DataFrame:
    """(src, dst): pairs of different fingerprints of column ``fp`` (distinct) that differ in 1 to ``bits`` bits."""
    fp = F.col("fp")
    table = fingerprints.select("fp", *[F.bit_count(fp.bitwiseXOR(F.lit(p))).cast("byte").alias(f"d{i}") for i, p in enumerate(pivots(n_pivots))])
    masks = _masks(bits)
    keys = F.array(*[F.struct(F.lit(i).cast("byte").alias("t"), fp.bitwiseAND(F.lit(m)).alias("k")) for i, m in enumerate(masks)])
    rows = table.select("*", F.explode(keys).alias("key")).select("fp", F.col("key.t").alias("t"), F.col("key.k").alias("k"), *[f"d{i}" for i in range(n_pivots)])
    a = rows.alias("a")
    b = rows.alias("b")
    near = reduce(lambda x, y: x & y, [F.abs(F.col(f"a.d{i}") - F.col(f"b.d{i}")) <= bits for i in range(n_pivots)])
    differ = F.col("a.fp").bitwiseXOR(F.col("b.fp"))
    # A pair that shares several keys is kept at the first of them.
    first = reduce(lambda x, im: F.when(differ.bitwiseAND(F.lit(im[1])) == 0, F.lit(im[0])).otherwise(x), list(enumerate(masks))[::-1], F.lit(len(masks)))
    met = a.join(b, (F.col("a.t") == F.col("b.t")) & (F.col("a.k") == F.col("b.k")) & (F.col("a.fp") < F.col("b.fp")) & near & (F.bit_count(differ) <= bits) & (first == F.col("a.t")))
    return met.select(F.col("a.fp").alias("src"), F.col("b.fp").alias("dst"))


def components(df: DataFrame, text: str = "text", doc_id: str = "doc_id", fp: str | None = None, shingle: int = 3, bits: int = 3, n_pivots: int = 8) -> DataFrame:
    """Every row with fingerprint (16 hex digits), component_id (the smallest id it can reach over links) and stays.

    Fingerprints link at ``bits`` or fewer differing bits; ``fp`` names a column that has them already.  ``stays`` is
    true for one row of each component, one with the smallest id.  NULL and empty texts have fingerprint zero and link
    like any other.  Repeated rows share a component and one of them stays; rows with NULL id take part, and a component
    of NULL ids only has NULL as its id.  An empty table gives an empty result.  Input columns named like the three
    results give way.
    """
    prepare(df.sparkSession)
    own = fresh(df.columns, "fp")
    row, group, kept = (fresh([*df.columns, own], n) for n in ("row", "group", "kept"))
    made = df.withColumn(own, F.col(f"`{fp}`") if fp else fingerprint(F.col(f"`{text}`"), shingle)).withColumn(row, F.monotonically_increasing_id())
    rows = store(made)  # from here on the row numbers are fixed
    ident = F.col(f"`{doc_id}`")
    nodes = store(rows.groupBy(F.col(own).alias("fp")).agg(F.min(ident).alias("low"), F.min(F.struct(ident.isNull().alias("a"), ident.alias("b"), F.col(row).alias("c"))).alias("best")))
    found = connected_components(store(links(nodes.select("fp"), bits, n_pivots)), "src", "dst")
    joined = nodes.join(found, nodes["fp"] == found["node"], "left").select("fp", "low", "best", F.coalesce("component", "fp").alias("root"))
    roots = joined.groupBy("root").agg(F.min("low").alias(group), F.min("best").getField("c").alias(kept))
    named = joined.select(F.col("fp").alias(own), "root").join(roots, "root").select(own, group, kept)
    out = rows.join(named, own)
    return add(out, {"fingerprint": F.lpad(F.lower(F.hex(F.col(own))), 16, "0"), "component_id": F.col(group), "stays": F.col(row) == F.col(kept)}).drop(own, row, group, kept)
