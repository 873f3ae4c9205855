"""Whole flows composed of operators: dataset building, sample preparation, cohort annotation."""
