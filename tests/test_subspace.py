"""Leading components in long form against dense singular value decompositions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortloom.operators import subspace as S
from cohortloom.operators import tiles as T


def _long(spark, m):
    return spark.createDataFrame([(f"n{j}", "c", i, float(m[i, j])) for i in range(m.shape[0]) for j in range(m.shape[1])], "id string, chr string, start int, lr double")


def _projector(comp, rows):
    u = np.zeros((rows, comp.agg(F.max("comp")).first()[0] + 1))
    for r in comp.collect():
        u[r["start"], r["comp"]] = r["u"]
    return u


@pytest.mark.parametrize("blocks", [8, 2])
def test_steep_and_flat_spectra(spark, monkeypatch, blocks):
    monkeypatch.setattr(S, "BLOCKS", blocks)  # two blocks make the basis fold
    rng = np.random.default_rng(7)
    m = rng.normal(size=(120, 40)) * 0.1 + np.outer(rng.normal(size=120), rng.normal(size=40)) * 3 + np.outer(rng.normal(size=120), rng.normal(size=40))
    u = _projector(T.pool_components(_long(spark, m), 3), 120)
    full = np.linalg.svd(m, full_matrices=False)[0][:, :3]
    assert np.allclose(u.T @ u, np.eye(3), atol=1e-9)
    assert np.allclose(np.abs(np.sum(u * full, axis=0)), 1, atol=1e-8)


def test_low_rank_absent_cells_and_empty(spark):
    rng = np.random.default_rng(8)
    a, b = rng.normal(size=30), rng.normal(size=12)
    a[:4] = 0.0
    m = np.outer(a, b)
    cells = _long(spark, m)
    odd = spark.createDataFrame([("n0", "c", 0, None), ("n1", "c", 1, float("nan")), (None, "c", 5, 9.0), ("n2", None, 5, 9.0)], cells.schema)
    comp = T.pool_components(cells.filter("start >= 4").unionByName(odd), 5)  # rank one, zeros absent, NULL or NaN
    assert comp.agg(F.max("comp")).first()[0] == 0
    left = T.pool_denoise(cells, comp).agg(F.max(F.abs("lr"))).first()[0]
    assert left < 1e-9
    assert T.pool_components(cells.limit(0), 3).count() == 0
    assert T.pool_components(cells.withColumn("lr", F.lit(0.0)), 3).count() == 0


def test_more_normals_than_once_allowed(spark):
    rng = np.random.default_rng(9)
    m = np.outer(rng.normal(size=12), rng.normal(size=1200)) * 5 + rng.normal(size=(12, 1200)) * 0.1
    u = _projector(T.pool_components(_long(spark, m), 1), 12)
    assert abs(abs(u[:, 0] @ np.linalg.svd(m, full_matrices=False)[0][:, 0]) - 1) < 1e-9


def test_tile_sums_are_not_shuffled(spark):
    cells = S._Cells(_long(spark, np.ones((6, 3))).select("chr", "start", F.col("id").alias("sample"), F.col("lr").alias("x")), ["chr", "start"])
    v = spark.range(3).select(F.concat(F.lit("n"), "id").alias("sample"), F.array(F.lit(1.0)).alias("v"))
    plan = cells.gramian(F.broadcast(v), 1)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "hashpartitioning(sample" in plan
    cells.drop()
