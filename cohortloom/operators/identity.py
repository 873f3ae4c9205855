"""Sample identity: genotype calls, pairwise matching, read-depth cross tables, QC tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.functions.text import IUPAC, iupac_call
from cohortloom.operators.common import later_wins

BASES = ["A", "C", "G", "T"]


def allele_table(calls: DataFrame, keys: Sequence[str] = ("id", "name")) -> DataFrame:
    """Reads per base of each SNP from reference and alternative counts, and the genotype call.

    A homozygous reference call counts its whole depth as reference reads.  Repeated reference
    entries of a SNP count once.
    """
    ref_ct = F.when(F.col("genotype") == "0/0", F.coalesce("depth", F.lit(0))).otherwise(F.coalesce("ref_ct", F.lit(0)))
    pair = F.array(
        F.struct(F.col("ref").alias("allele"), ref_ct.cast("bigint").alias("count")),
        F.struct(F.col("alt").alias("allele"), F.coalesce("alt_ct", F.lit(0)).cast("bigint").alias("count")))
    rows = calls.select(*keys, F.inline(pair)).distinct()
    sums = rows.groupBy(*keys).agg(*[F.coalesce(F.max(F.when(F.col("allele") == b, F.col("count"))), F.lit(0)).alias(b) for b in BASES])
    gt = calls.groupBy(*keys).agg(F.min_by("genotype", F.struct("alt", "genotype")).alias("genotype"))
    out = sums.join(gt, list(keys)).withColumn("tot", F.col("A") + F.col("C") + F.col("G") + F.col("T"))
    weak = F.when(F.col("genotype") == "0/1", F.col("tot") < 13).otherwise(F.col("tot") < 3)
    out = out.withColumn("genotype", F.when(weak, "./.").otherwise(F.col("genotype")))
    return out.withColumn("final_call", base_call())


def base_call() -> Column:
    """Homozygous: 3 reads and 80%.  Heterozygous: 13 reads, 20% each, 90% together.  Later rules win."""
    tot = F.col("tot")
    hom = [((tot >= 3) & (F.col(b) / tot >= 0.8), F.lit(b)) for b in BASES]
    het = [
        ((tot >= 13) & (F.col(a) / tot >= 0.2) & (F.col(b) / tot >= 0.2) & ((F.col(a) + F.col(b)) / tot >= 0.9), F.lit(f"{a}/{b}"))
        for i, a in enumerate(BASES) for b in BASES[i + 1:]
    ]
    return later_wins([*[(F.coalesce(tot > 0, F.lit(False)) & c, v) for c, v in hom], *[(F.coalesce(tot > 0, F.lit(False)) & c, v) for c, v in het]], F.lit("UNKNOWN"))


def genotype_string(calls: DataFrame, keys: Sequence[str] = ("id",), order: str = "name") -> DataFrame:
    """Calls of a sample as one IUPAC string in SNP order (the SNP panel is a fixed small set)."""
    s = F.array_sort(F.collect_list(F.struct(order, iupac_call(F.col("final_call")).alias("c"))))
    return calls.groupBy(*keys).agg(F.array_join(F.transform(s, lambda e: e["c"]), "").alias("genotype"))


def match_pairs(a: DataFrame, b: DataFrame, pairs: DataFrame, name: str = "name", threshold: float = 0.95) -> DataFrame:
    """Genotype agreement of the given sample pairs: depth-weighted mean correlation of base shares.

    ``a``, ``b``: id, name, A, C, G, T; ``pairs``: id_1, id_2.  Shares are smoothed by one read per
    base.  Every (sample, SNP) is reduced to a unit vector first, so a correlation is a sum of four
    products.  SNPs without reads in either sample are left out.
    """
    def unit(d: DataFrame, n: str) -> DataFrame:
        total = F.col("A") + F.col("C") + F.col("G") + F.col("T")
        t = d.select(F.col("id").alias(f"id_{n}"), F.col(name).alias("__s"), total.cast("double").alias(f"depth{n}"), *[((F.col(x) + 1) / (total + 16)).alias(f"p{x}") for x in BASES]).filter(F.col(f"depth{n}") > 0)
        mean = sum((F.col(f"p{x}") for x in BASES), F.lit(0.0)) / 4
        t = t.withColumn("__m", mean)
        norm = F.sqrt(sum(((F.col(f"p{x}") - F.col("__m")) * (F.col(f"p{x}") - F.col("__m")) for x in BASES), F.lit(0.0)))
        t = t.withColumn("__n", F.when(norm > 1e-12, norm))
        return t.select(f"id_{n}", "__s", f"depth{n}", *[((F.col(f"p{x}") - F.col("__m")) / F.col("__n")).alias(f"{x}{n}") for x in BASES])

    wanted = pairs.select("id_1", "id_2").distinct()
    j = unit(a, "1").join(wanted, "id_1").join(unit(b, "2"), ["id_2", "__s"])
    r = sum((F.col(f"{x}1") * F.col(f"{x}2") for x in BASES), F.lit(0.0))
    w = F.col("depth1") + F.col("depth2")
    out = j.groupBy("id_1", "id_2").agg((F.sum(r * w) / F.sum(w)).alias("score"), F.count(F.lit(1)).alias("n_snps"))
    return out.withColumn("match", F.col("score") > threshold)


def genotype_scores(target: str, population: DataFrame, genotype: str = "genotype", scale: str = "max") -> DataFrame:
    """Score of every IUPAC genotype string against one: positions with equal letters, ambiguous against
    plain bases never match.

    Two ambiguous letters, or N and any letter, score their share of common bases.  The score of each position comes from
    a literal map built from the target, so the comparison is one pass without a join.
    """
    sets = {v: frozenset(k) for k, v in IUPAC.items()}

    def pair(u: str, v: str) -> float:
        if u == v:
            return 1.0
        plain = [x in BASES for x in (u, v)]
        if all(plain) or (any(plain) and "N" not in (u, v)):
            return 0.0
        common = len(sets[u] & sets[v])
        return common / (len(sets[u]) * len(sets[v]))

    letters = list(sets)
    rows = {u: F.create_map(*[F.lit(x) for v in letters for x in (v, pair(u, v))]) for u in letters}
    by = F.create_map(*[x for u in letters for x in (F.lit(u), rows[u])])
    want = F.array(*[F.lit(c) for c in target])
    have = F.split(F.col(genotype), "")
    score = F.aggregate(F.zip_with(want, have, lambda u, v: F.coalesce(by[u][v], F.lit(0.0))), F.lit(0.0), lambda s, v: s + v)
    out = population.withColumn("score", score)
    if scale == "max":
        out = out.withColumn("score", 100 * F.col("score") / out.agg(F.max("score")).scalar())
    return out


def genotype_positions(a: str, b: str, spark) -> DataFrame:
    """Position-wise letters and equality of two genotype strings."""
    df = spark.range(1).select(F.posexplode(F.arrays_zip(F.split(F.lit(a), "").alias("a"), F.split(F.lit(b), "").alias("b"))).alias("pos", "p"))
    return df.select((F.col("pos") + 1).alias("pos"), "p.a", "p.b", F.coalesce((F.col("p.a") == F.col("p.b")).cast("double"), F.lit(0.0)).alias("score"))


def depth_crosstab(records: DataFrame, keys: Sequence[str], noise_lo: int = 4, noise_hi: int = 8) -> DataFrame:
    """Tumor x normal read-depth table over sample pairs as 16 numbers joined by ``:``.

    ``records``: keys, tumor_ad, normal_ad (NULL counts as 0), one row per allele and sample pair.
    """
    def band(c: str) -> Column:
        v = F.coalesce(F.col(c), F.lit(0))
        return F.when(v == 0, 0).when(v <= noise_lo, 1).when(v <= noise_hi, 2).otherwise(3)

    cell = band("tumor_ad") * 4 + band("normal_ad")
    counts = [F.count(F.when(F.col("__c") == i, 1)).cast("string") for i in range(16)]
    return records.withColumn("__c", cell).groupBy(*keys).agg(F.concat_ws(":", *counts).alias("adx"))


def melt_metrics(df: DataFrame, keys: Sequence[str], source: str) -> DataFrame:
    """One row per metric: (keys, from, variable, value as text)."""
    cols = [c for c in df.columns if c not in keys]
    text = df.select(*keys, *[F.col(c).cast("string").alias(c) for c in cols])
    return text.unpivot(list(keys), cols, "variable", "value").withColumn("from", F.lit(source)).select(*keys, "from", "variable", "value")


def merge_metrics(parts: dict[str, DataFrame], keys: Sequence[str] = ("id",)) -> DataFrame:
    out = None
    for name, df in parts.items():
        m = melt_metrics(df, keys, name)
        out = m if out is None else out.unionByName(m)
    return out


def virus_summary(hits: DataFrame, keys: Sequence[str] = ("id",), order: str = "ord") -> DataFrame:
    """Virus calls of a sample as one text: ``name (n reads, coverage)`` joined by ``;`` in file order."""
    call = F.format_string("%s (%.0f reads, %s)", F.replace("name", F.lit("SP:"), F.lit("")), F.col("reads").cast("double"), F.col("coverage").cast("string"))
    listed = F.array_sort(F.collect_list(F.struct(order, call.alias("c"))))
    return hits.groupBy(*keys).agg(F.array_join(F.transform(listed, lambda e: e["c"]), ";").alias("virus"))
