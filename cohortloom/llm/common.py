"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortloom.session import cut_lineage

#: Rows per Arrow batch: texts are long, and a worker holds one batch of inputs and outputs at a time.
ARROW_ROWS = 256


def prepare(spark: SparkSession) -> SparkSession:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    return spark


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{table}.parquet")


def store(df: DataFrame, at_most: int | None = None) -> DataFrame:
    """Write a table to the folder all executors share and read it back; lost executors don't matter."""
    return cut_lineage(df, at_most)


def fresh(columns: Iterable[str], stem: str) -> str:
    """A column name that no column has yet, whatever its case."""
    taken = {c.lower() for c in columns}
    name = f"__{stem}"
    while name.lower() in taken:
        name += "_"
    return name


def add(df: DataFrame, values: dict[str, Column]) -> DataFrame:
    """Add columns; one that the table has under the same name, whatever its case, gives way."""
    lower = {c.lower() for c in values}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in lower], *[v.alias(c) for c, v in values.items()])


def add_struct(df: DataFrame, made: Column, fields: Iterable[str]) -> DataFrame:
    """Add the fields of one struct-valued expression, which is evaluated once."""
    tmp = fresh(df.columns, "made")
    fields = list(fields)
    lower = {f.lower() for f in fields}
    return df.withColumn(tmp, made).select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in lower], *[F.col(f"{tmp}.{f}").alias(f) for f in fields])


def once(function):
    """A Python function that a filter on its result does not run a second time (with workers of its own) below the result."""
    return function.asNondeterministic()


def row_key(doc_id: Column, text: Column) -> list[Column]:
    """Two 64-bit numbers that name a row by its id and text, equal wherever they are evaluated.

    Repeated rows share a key, and every operator gives equal rows equal results.
    """
    return [F.xxhash64(F.lit(salt), doc_id.isNull(), doc_id.cast("string"), text) for salt in ("a", "b")]


def ranked(df: DataFrame, group: list[str], order: list[str], into: str) -> DataFrame:
    """Stored rows with ``into``, their place (from 0) in their group by ``order``; NULLs are first and a group of their own.

    The rows are sorted by ranges of (group, order), so a hot group is spread over many tasks; what is counted together is
    one row for each group and range.  Rows that tie are equal in ``order`` and stand next to each other in any order.
    """
    seq, part, first, before = (fresh([*df.columns, into], n) for n in ("seq", "part", "first", "before"))
    by = [F.col(c).asc_nulls_first() for c in [*group, *order]]
    rows = store(df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn(seq, F.monotonically_increasing_id()))
    rows = rows.withColumn(part, F.shiftright(seq, 33))
    parts = rows.groupBy(*group, part).agg(F.min(seq).alias(first), F.count("*").alias("n"))
    earlier = Window.partitionBy(*group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select(*[F.col(c).alias(f"{before}{i}") for i, c in enumerate(group)], F.col(part).alias(f"{before}p"), (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col(first)).alias(before))
    same = [F.col(c).eqNullSafe(F.col(f"{before}{i}")) for i, c in enumerate(group)]
    out = rows.join(starts, [*same, F.col(part) == F.col(f"{before}p")])
    return out.select(*df.columns, (F.col(seq) + F.col(before)).alias(into))
