"""Leading components of a tall sparse matrix kept in long form, by randomised block Krylov iteration.

The matrix has a row per tile and a column per sample, one table row per cell.  A step multiplies a thin block of sample
vectors by A'A: sums per tile, then sums per sample.  Cells are stored once, bucketed by tile, so the tile sums and their
way back to the cells need no shuffle; only thin sample vectors move.  Blocks are made orthogonal through small Gram
matrices, sums over the samples whose size depends on the number of wanted components alone: neither a row per sample nor
one per tile ever comes to the driver.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.session import cut_lineage, shared_folder

#: Vectors in a block beyond the wanted ones, and blocks kept before the basis is folded into its best vectors.
EXTRA, BLOCKS = 8, 8
#: Directions of a block shorter than this share of its largest one are rounding noise.
NOISE = 1e-11


def _times(vector: Column, matrix: np.ndarray) -> Column:
    """vector (an array) times a small matrix, as an array."""
    columns = F.array(*[F.array(*[F.lit(float(x)) for x in c]) for c in matrix.T])
    return F.transform(columns, lambda c: F.aggregate(F.zip_with(vector, c, lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x))


def _gram(table: DataFrame, left: Column, right: Column, shape: tuple[int, int]) -> np.ndarray:
    """Sum over the table's rows of left' right."""
    each = table.select(F.posexplode(left).alias("i", "x"), right.alias("r"))
    out = np.zeros(shape)
    for row in each.groupBy("i").agg(*[F.sum(F.col("x") * F.col("r")[j]).alias(f"g{j}") for j in range(shape[1])]).collect():  # shape is small
        out[row[0]] = row[1:]
    return out


def _sums(width: int, factor: str) -> list[Column]:
    return [F.sum(F.col(factor) * F.col("v")[j]).alias(f"s{j}") for j in range(width)]


def _packed(width: int) -> Column:
    return F.array(*[F.col(f"s{j}") for j in range(width)]).alias("v")


class _Cells:
    """The stored matrix: columns keys, sample, x."""

    def __init__(self, cells: DataFrame, keys: Sequence[str]):
        spark = cells.sparkSession
        self.keys, self.name = list(keys), f"cells_{uuid.uuid4().hex}"
        n = int(spark.conf.get("spark.sql.shuffle.partitions"))
        dealt = cells.repartition(n, *self.keys).write.bucketBy(n, *self.keys)
        dealt.format("parquet").option("path", f"{shared_folder(spark)}/{self.name}").saveAsTable(self.name)
        self.table = spark.table(self.name)

    def tiles(self, v: DataFrame, width: int) -> DataFrame:
        """A v: a row per tile."""
        return self.table.join(v, "sample").groupBy(*self.keys).agg(*_sums(width, "x")).select(*self.keys, _packed(width))

    def gramian(self, v: DataFrame, width: int) -> DataFrame:
        """A'A v: a row per sample."""
        back = self.table.join(self.tiles(v, width), self.keys)
        return back.groupBy("sample").agg(*_sums(width, "x")).select("sample", _packed(width))

    def drop(self) -> None:
        self.table.sparkSession.sql(f"drop table if exists {self.name}")


def _orthonormal(table: DataFrame, p: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For rows (b: p numbers, orthonormal columns; z: k numbers): M, C, R with [b|z] M orthonormal and orthogonal to b, z = b C + [b|z] M R."""
    both = F.concat("b", "z")
    m = np.vstack([np.zeros((p, k)), np.eye(k)])
    r = np.eye(k)
    c = np.zeros((p, k))
    longest = 0.0
    for turn in range(3):  # project; project and scale; project and scale again, against rounding
        width = m.shape[1]
        if not width:
            break
        g = _gram(table.select("b", _times(both, m).alias("z")), both, F.col("z"), (p + width, width))
        onto, own = g[:p], g[p:]
        c = c + onto @ r
        m = m - np.vstack([onto, np.zeros((k, width))])
        if turn == 0:
            longest = float(np.sqrt(max(np.diag(own).max(), 0.0)))
            continue
        own = own - onto.T @ onto
        size = np.sqrt(np.maximum(np.diag(own), 0.0))
        live = size > (NOISE * longest if turn == 1 else 0.5)
        scale = np.where(live, 1.0 / np.where(live, size, 1.0), 0.0)
        w, e = np.linalg.eigh(own * scale[:, None] * scale[None, :])
        good = w > 1e-13 * max(w.max(), 1e-300) if live.any() else np.zeros(width, bool)
        t = scale[:, None] * e[:, good] / np.sqrt(w[good])
        m, r = m @ t, (t.T @ own) @ r
    return m, c, r


def leading_vectors(cells: _Cells, samples: DataFrame, n: int, tol: float, max_steps: int) -> tuple[DataFrame | None, np.ndarray]:
    """The first n right singular vectors (sample, v) and the squared singular values."""
    k = n + EXTRA
    noise = F.array(*[F.xxhash64("sample", F.lit(j)) / F.lit(2.0**63) for j in range(k)])
    empty = F.array().cast("array<double>")
    start = samples.select("sample", empty.alias("b"), noise.alias("z"))
    m, _, _ = _orthonormal(start, 0, k)
    p = fresh = m.shape[1]  # columns of the basis, and those of its last block, not yet multiplied
    if not p:
        return None, np.zeros(0)
    basis = cut_lineage(start.select("sample", _times(F.col("z"), m).alias("b")))
    h = np.zeros((p, p))
    for _ in range(max_steps):
        last = basis.select("sample", F.slice("b", p - fresh + 1, fresh).alias("v"))
        made = cells.gramian(last, fresh).withColumnRenamed("v", "z")
        zeros = F.array_repeat(F.lit(0.0), fresh)
        table = cut_lineage(basis.join(made, "sample", "left").withColumn("z", F.coalesce("z", zeros)))
        m, c, r = _orthonormal(table, p, fresh)
        h[:, p - fresh :], h[p - fresh :, :] = c, c.T
        theta, y = np.linalg.eigh((h + h.T) / 2)
        theta, y = theta[::-1], y[:, ::-1]
        rest = np.linalg.norm(r @ y[p - fresh :, :n], axis=0) if r.size else np.zeros(1)
        if not m.shape[1] or rest.max() <= tol * max(theta[0], 1e-300):
            keep = theta[:n] > 1e-12 * max(theta[0], 1e-300)
            top = y[:, :n][:, keep]
            return (table.select("sample", _times(F.col("b"), top).alias("v")) if top.shape[1] else None), theta[:n][keep]
        new, both = m.shape[1], _times(F.concat("b", "z"), m)
        if p + new <= BLOCKS * k:
            kept, wide, across = F.col("b"), h, np.hstack([np.zeros((new, p - fresh)), r])
        else:  # fold the basis into its best vectors
            kept, wide, across = _times(F.col("b"), y[:, :k]), np.diag(theta[:k]), r @ y[p - fresh :, :k]
        basis = cut_lineage(table.select("sample", F.concat(kept, both).alias("b")))
        h = np.block([[wide, across.T], [across, np.zeros((new, new))]])
        p, fresh = len(h), new
    raise RuntimeError(f"components not found to {tol} in {max_steps} steps")


def leading_components(cells: DataFrame, keys: Sequence[str], sample: str, value: str, n: int, tol: float = 1e-10, max_steps: int = 200) -> DataFrame:
    """First ``n`` left singular vectors, long form: keys, comp (from 0), u.  Fewer where the rank is lower.

    An absent, NULL or NaN cell is zero; rows of the same cell add up; rows with a NULL key or sample are left out; an empty
    table gives none.  A component is found when its residual is at most ``tol`` of the largest squared singular value.
    """
    x = F.nanvl(F.coalesce(F.col(value).cast("double"), F.lit(0.0)), F.lit(0.0))
    rows = cells.select(*keys, F.col(sample).alias("sample"), x.alias("x")).dropna(subset=[*keys, "sample"])
    stored = _Cells(rows, keys)
    try:
        v, theta = leading_vectors(stored, stored.table.select("sample").distinct(), n, tol, max_steps)
        if v is None:
            return cells.select(*keys, F.lit(0).alias("comp"), F.lit(0.0).alias("u")).limit(0)
        u = stored.tiles(cut_lineage(v), len(theta))
        scaled = F.zip_with("v", F.array(*[F.lit(float(t**-0.5)) for t in theta]), lambda a, b: a * b)
        return cut_lineage(u.select(*keys, F.posexplode(scaled).alias("comp", "u")))
    finally:
        stored.drop()
