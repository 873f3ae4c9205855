"""Writers: text exports and range files.  Datasets are written by ``CohortDataset.save``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.dataset import CohortDataset
from cohortloom.operators.intervals import resize, subtract, union_ranges
from cohortloom.operators.variants import to_maf


def write_text(df: DataFrame, path: str, header: bool = True, mode: str = "errorifexists") -> None:
    df.write.mode(mode).option("sep", "\t").option("header", header).option("emptyValue", "").csv(path)


def write_maf(somatic: DataFrame, path: str, center: str = ".", mode: str = "errorifexists") -> None:
    write_text(to_maf(somatic, center), path, mode=mode)


def write_segments(export: DataFrame, path: str, mode: str = "errorifexists") -> None:
    write_text(export, path, header=False, mode=mode)


def marker_table(tiles: DataFrame) -> DataFrame:
    """Tile midpoints as markers."""
    from cohortloom.functions.text import chromosome_code

    t = tiles.select("chr", "start", "end").distinct()
    return t.select(F.concat_ws(".", F.lit("tile"), "chr", F.col("start").cast("string")).alias("marker_name"), chromosome_code(F.col("chr")).alias("chromosome"),
                    F.floor((F.col("start") + F.col("end")) / 2).cast("bigint").alias("marker_pos"))


def zero_based(df: DataFrame) -> DataFrame:
    return df.select("chr", (F.col("start") - 1).alias("start"), "end", *[c for c in df.columns if c not in ("chr", "start", "end")])


def write_ranges(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Closed one-based ranges as zero-based half-open text."""
    write_text(zero_based(df), path, header=False, mode=mode)


def extended_annotation(old: DataFrame, targets: DataFrame, excluded: DataFrame | None = None, padding: int = 0) -> DataFrame:
    """Annotated regions plus padded new targets (outside the excluded ones), merged."""
    new = subtract(targets, excluded) if excluded is not None else targets.select("chr", "start", "end")
    return union_ranges(old, resize(new, padding))


def stack_files(spark, paths: Sequence[str], target: str, version: str = "v3", append: bool = False) -> CohortDataset:
    """One cohort store from many stored datasets: every member is one union and one write.

    Paths are opened one by one, as their layouts may differ; thousands of small datasets are best
    added in batches with ``append``.
    """
    ds = CohortDataset.stack([CohortDataset.open(spark, p, version) for p in paths])
    ds.save(target, mode="append" if append else "errorifexists")
    return CohortDataset.open(spark, target, version)
