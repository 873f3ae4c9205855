"""Training-data pipeline over ``documents``: each stage's result is written as Parquet and reread as the next one's input.

Every stage takes (spark, docs, sf_dir) and works on all its predecessor kept; all but the last return the columns of
``documents``, with ``n_chars`` following a changed text.  NULL texts count as empty and stay unless a stage's own
operator rejects them; empty tables pass through; more columns than those of ``documents`` are carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.llm import bpe, decontaminate, nearcopies, pii, quality
from cohortloom.llm.common import add, fresh, read, row_key, store
from cohortloom.llm.queries import TOKENIZER, fold


def _changed(docs: DataFrame, made: DataFrame, text: str) -> DataFrame:
    """The rows of docs with another text, and its length where docs have one."""
    out = add(made, {"text": F.col(f"`{text}`")})
    if "n_chars" in docs.columns:
        out = add(out, {"n_chars": F.length("text").cast(docs.schema["n_chars"].dataType)})
    return out.select(*[f"`{c}`" for c in docs.columns])


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; it learns from the training rows among them, as the query does."""
    learn = fold(5) != 0
    own = fresh(docs.columns, "in")
    made = quality.classify(docs.select(F.struct(*[f"`{c}`" for c in docs.columns]).alias(own), "text"), docs.filter(learn), read(spark, sf_dir, "labels").filter(learn))
    return made.filter("predicted = 1").select(f"{own}.*")


def near_copies_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (Jaccard 0.8 or more on five-word shingles), the one with the smallest id.

    Only keys and sketches are stored and grouped; texts are met by joins on rows' keys, for the sets of candidates and
    for the chosen rows.
    """
    k1, k2 = fresh(docs.columns, "k1"), fresh(docs.columns, "k2")
    keyed = docs.withColumns(dict(zip((k1, k2), row_key(F.col("doc_id"), F.col("text")), strict=True)))
    return keyed.join(nearcopies.chosen(keyed, [k1, k2]), [k1, k2], "left_semi").dropDuplicates([k1, k2]).drop(k1, k2)  # rows equal in id and text are one


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go; from the others spans of a whole window or more are cut."""
    own = fresh(docs.columns, "in")
    made = decontaminate.decontaminate(docs.select(F.struct(*[f"`{c}`" for c in docs.columns]).alias(own), "text"), read(spark, sf_dir, "benchmark"))
    kept = made.filter("not contaminated").select(f"{own}.*", F.col("cleaned").alias(new := fresh(docs.columns, "cleaned")))
    return _changed(docs, kept, new)


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind in brackets."""
    own = fresh(docs.columns, "in")
    made = pii.find(docs.select(F.struct(*[f"`{c}`" for c in docs.columns]).alias(own), "text"))
    return _changed(docs, made.select(f"{own}.*", F.col("redacted").alias(new := fresh(docs.columns, "redacted"))), new)


def tokens_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_packed (little-endian 32-bit ids) and the decoded text of every document."""
    made = bpe.encode_decode(docs.select("doc_id", "text"), TOKENIZER)
    return made.select("doc_id", "n_tokens", "ids_packed", F.col("decoded").alias("text"))


STAGES = [
    ("quality classifier", quality_stage),
    ("near-dedup", near_copies_stage),
    ("benchmark decontamination", benchmark_stage),
    ("PII", personal_data_stage),
    ("BPE encoding and decoding", tokens_stage),
]

#: A learned classifier decides in the first stage, which SQL can't express; tests compare with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order, each on the stored result of the one before."""
    docs = read(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = store(docs)
    return docs
