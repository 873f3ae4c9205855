"""Build a dataset of any number of samples from their raw reports."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.dataset import CohortDataset
from cohortloom.operators import cohort, copynumber, structural, variants


def event_map(df: DataFrame) -> DataFrame:
    return df.select("gene_id", "id", "var_id")


def structural_map(df: DataFrame) -> DataFrame:
    ends = F.array(*[F.struct(F.col(f"gene_id_{n}").alias("gene_id"), F.lit(f"e{n}").alias("end")) for n in "12"])
    return df.select("id", "var_id", F.inline(ends)).distinct()


def fusion_map(df: DataFrame) -> DataFrame:
    """Genes of the four colon lists, with the side they come from."""
    sides = {"f5": "5_1", "f3": "3_1", "r5": "5_2", "r3": "3_2"}
    cells = F.array(*[F.struct(F.lit(e).alias("end"), F.split(F.coalesce(F.col(f"gene_ids_{s}"), F.lit("")), ":").alias("g")) for e, s in sides.items()])
    rows = df.select("id", "var_id", F.inline(cells)).select("id", "var_id", "end", F.explode("g").alias("gene_id"))
    return rows.filter(F.col("gene_id") != "").distinct()


def fusion_name(df: DataFrame) -> DataFrame:
    end = lambda e: F.concat_ws(":", f"chr_{e}", F.col(f"pos_{e}").cast("string"), f"str_{e}")
    return df.withColumn("var_id", F.concat_ws("::", end("5"), end("3")))


def segment_name(df: DataFrame) -> DataFrame:
    return df.withColumn("var_id", F.concat(F.col("chr"), F.lit(":"), F.col("start").cast("string"), F.lit("-"), F.col("end").cast("string")))


def sample_meta(ids: DataFrame, *sources: DataFrame) -> DataFrame:
    """One row per sample; of several values for a field the first source that has one."""
    out = ids.select("id").distinct()
    seen: dict[str, list[str]] = {}
    for i, s in enumerate(sources):
        cols = [c for c in s.columns if c != "id"]
        one = s.groupBy("id").agg(*[F.max(c).alias(f"__{i}_{c}") for c in cols])
        out = out.join(one, "id", "left")
        for c in cols:
            seen.setdefault(c, []).append(f"__{i}_{c}")
    return out.select("id", *[F.coalesce(*cols).alias(c) for c, cols in seen.items()])


def build_dataset(
    spark: SparkSession, reports: Mapping[str, DataFrame], genes: DataFrame, meta: DataFrame, *, tumor_only: bool = False, qc: DataFrame | None = None, version: str = "v3",
) -> CohortDataset:
    """Maps, tables and meta of all samples from ``reports``.

    Keys: somatic, germline, structural, fusion, segment, tile, tumor_counts, normal_counts; absent
    ones give empty tables.  Import filters run first, so the filters reach the scans.
    """
    tables, maps = {}, {}
    for name in ("somatic", "germline"):
        if name in reports:
            t = variants.derived_filters(variants.prefilter(reports[name], name, tumor_only))
            tables[name], maps[name] = t, event_map(t)
    if "structural" in reports:
        t = structural.structural_consequence(reports["structural"])
        tables["structural"], maps["structural"] = t, structural_map(t)
    if "fusion" in reports:
        t = fusion_name(structural.fusion_consequence(reports["fusion"]))
        tables["fusion"], maps["fusion"] = t, fusion_map(t)
    if "segment" in reports:
        t = segment_name(reports["segment"])
        tables["segment"], maps["segment"] = t, copynumber.segment_gene_map(t, genes)
        clipped = copynumber.clip_genes(genes, reports["tile"]) if "tile" in reports else genes
        tables["gene_copy"] = copynumber.gene_copies(t, clipped)
    if "tumor_counts" in reports or "normal_counts" in reports:
        some = reports.get("tumor_counts", reports.get("normal_counts"))
        lengths = some.groupBy("gene_id").agg(F.max("gene_length").alias("gene_length"))
        tables["gene_expression"] = cohort.expression_table(reports.get("tumor_counts"), reports.get("normal_counts"), lengths, genes)
    return CohortDataset.build(spark, tables, maps, meta, genes, qc, version)
