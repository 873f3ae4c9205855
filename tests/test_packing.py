"""Packed expression arrays: only values that exist are shuffled, not every cell of samples and genes."""

import random

from pyspark.sql import functions as F

from cohortloom.operators import cohort as C
from cohortloom.streaming.incremental import gene_index
from tests.conftest import rows


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _packed(data, index, n_columns, digits):
    """Brute force: every sample with every index row, in the order of idx (NULL first) and values."""
    out = []
    for sample in {d[0] for d in data}:
        cells = []
        for gene, at in index:
            found = [d[2:] for d in data if d[0] == sample and d[1] == gene and None not in (sample, gene)]
            val = lambda v: -1.0 if v is None else round(v, digits)
            cells += [((at is not None, at or 0), *map(val, v)) for v in found or [(None,) * n_columns]]
        cells.sort()
        out.append((sample, *[[c[k + 1] for c in cells] for k in range(n_columns)]))
    return sorted(out, key=repr)


def test_pack_values_agrees_with_brute_force_on_odd_rows(spark):
    rnd = random.Random(5)
    index = [("g1", 1), ("g2", 2), ("g3", 3), (None, 4), ("g5", 6), ("g6", 6), ("g7", 6), ("g8", None), ("g2", 9), ("g2", 9)]
    data = [(rnd.choice(["a", "b", "c", None]), rnd.choice(["g1", "g2", "g5", "g7", "g8", "other", None]),
             rnd.choice([None, -7.25, rnd.randint(0, 99) / 8]), rnd.randint(0, 9) / 2) for _ in range(30)] + [("d", "other", 1.0, 1.0), ("e", "g1", 3.0, 4.0)]
    df = spark.createDataFrame(data, "id string, gene_id string, x double, y double")
    idx = spark.createDataFrame(index, "gene_id string, idx int")
    got = C.pack_values(df, idx, ["x", "y"], 3)
    assert rows(got) == _packed(data, index, 2, 3)
    assert C.pack_values(df, idx.limit(0), ["x"]).count() == 0


def test_pack_values_makes_no_rows_for_absent_cells(spark):
    df = spark.createDataFrame([("a", "g1", 1.0), ("b", "g2", 2.0)], "id string, gene_id string, x double")
    idx = spark.createDataFrame([("g1", 1), ("g2", 2)], "gene_id string, idx int")
    assert "Generate" not in _plan(C.pack_values(df, idx, ["x"]))  # the grid of samples and genes explodes buckets


def test_unpacked_cells_are_not_shuffled(spark):
    genes = spark.range(3000).select(F.concat(F.lit("g"), F.col("id").cast("string")).alias("gene_id"), F.lit("n").alias("gene_name"))
    idx = gene_index(genes)
    packed = spark.createDataFrame([("a", [1.0] * 3000)], "id string, count array<double>").withColumns({"cpm": F.col("count"), "rpkm": F.col("count")})
    none = spark.createDataFrame([("a", 2.0, ["x"])], "id string, C double, genes array<string>").filter("1 = 0")
    back = C.expression_with_copies(packed, idx, none)
    assert "hashpartitioning" not in _plan(back).split("Generate")[0]
    assert back.agg(F.count("*"), F.count_distinct("gene_id"), F.sum("rpkm")).first() == (3000, 3000, 3000.0)
