"""Annotation of a whole cohort: all samples in one job per table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from cohortloom.dataset import CohortDataset
from cohortloom.operators import copynumber, instability, structural, variants


def annotate_dataset(ds: CohortDataset, arms: DataFrame, centromeres: DataFrame, cytobands: DataFrame, sizes: DataFrame, thresholds: instability.Thresholds = instability.Thresholds()) -> dict[str, DataFrame]:
    """Mutation classes, structural and fusion genes, copy-number labels, arm and chromosome calls, scores."""
    seg = ds.table("segment")
    arm_calls = copynumber.call_arms(seg, arms, ds.meta)
    scored = instability.all_scores(instability.add_references(seg, centromeres, cytobands), sizes, ds.meta, thresholds)
    return {
        "somatic": variants.annotate_mutations(ds.table("somatic")),
        "germline": variants.annotate_mutations(ds.table("germline")),
        "structural": structural.annotate_structural(ds.table("structural")),
        "fusion": structural.annotate_fusions(ds.table("fusion")),
        "gene_copy": copynumber.label_gene_copies(ds.table("gene_copy"), seg, ds.map("segment"), arms, ds.meta),
        "gene_expression": ds.table("gene_expression"),
        "arms": arm_calls,
        "chromosomes": copynumber.call_chromosomes(arm_calls),
        "cin": scored.join(copynumber.tally_arms(arm_calls, ds.meta), "id", "left"),
        "meta": ds.meta,
    }


def subset_annotation(annotated: dict[str, DataFrame], ids: list[str]) -> dict[str, DataFrame]:
    return {n: t.filter(t["id"].isin(ids)) for n, t in annotated.items()}
