"""Readers and writers of the text and parquet formats the cohort tables come from and go to."""
