"""cohortloom: cancer-cohort tables as lazy Spark DataFrames."""

from cohortloom.dataset import CohortDataset
from cohortloom.schema import conform, table_schema

__all__ = ["CohortDataset", "conform", "table_schema"]
