"""Greedy batches: rows in order, a batch closed by the row at which its total reaches a limit.

The total starts anew in every batch, so where a batch begins depends on all batches before it.  It is found without a
pass in order: a batch begun at row i would close at the first row whose running sum reaches that before i plus the limit
(an as-of lookup on the running sums), and the next would begin one row later.  These successor pointers are doubled:
after k rounds they skip 2^k batches, and the rows reached from the first row are the first 2^k beginnings.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.operators.common import numbered, scan
from cohortloom.operators.intervals import asof_join
from cohortloom.session import cut_lineage

#: Rows whose running sum is one window.
CHUNK = 65_536


def greedy_batches(df: DataFrame, order: Sequence[str], size: str, limit: int, keys: Sequence[str] = (), out: str = "batch") -> DataFrame:
    """Every row with ``out``, the number (from 0) of its batch in its key group.

    A batch takes rows in ``order`` up to and with the one at which its ``size`` reaches ``limit`` (whole numbers; NULL
    counts as 0, negative ones are refused by a failing job); the last batch of a group may stay below.  Rows that tie in
    ``order`` are told apart by nothing else, so give a total order.  NULL keys are a group.  Runs jobs while it is called.
    """
    if limit <= 0:
        raise ValueError("the limit must be positive")
    names = [f"__g{i}" for i in range(len(keys))] or ["__g"]
    # NULL keys become texts that no value has, so plain equality is enough from here on.
    group = [F.coalesce(F.concat(F.lit("="), F.col(k).cast("string")), F.lit("-")).alias(n) for k, n in zip(keys, names, strict=False)] or [F.lit("-").alias("__g")]
    length = F.coalesce(F.col(size).cast("long"), F.lit(0).cast("long"))
    checked = F.when(length < 0, F.raise_error(F.concat(F.lit("negative size "), length.cast("string"))).cast("long")).otherwise(length)
    rows = numbered(df.select(F.struct(*df.columns).alias("__row"), *[F.col(c).alias(f"__o{i}") for i, c in enumerate(order)], checked.alias("__len"), *group), names, [f"__o{i}" for i in range(len(order))], "__at")
    rows = cut_lineage(rows.select("__row", "__len", "__at", *names))
    sums = scan(rows.drop("__row"), names, "__at", {"__sum": ("sum", F.col("__len"))}, chunk=CHUNK)
    sums = cut_lineage(sums.select(*names, "__at", "__sum", (F.col("__sum") - F.col("__len") + F.lit(limit)).alias("__wanted")))
    closes = sums.groupBy(*names, F.col("__sum").alias("__mark")).agg(F.min("__at").alias("__end"))
    met = asof_join(sums.select(*names, "__at", "__wanted"), closes, keys=names, at="__wanted", mark="__mark", direction="forward", bin_width=limit)
    last = sums.groupBy(*names).agg(F.max("__at").alias("__last"))
    jump = cut_lineage(met.join(last, names).filter(F.col("m___end") < F.col("__last")).select(*names, "__at", (F.col("m___end") + 1).alias("__to")))
    begun = sums.filter(F.col("__at") == 0).select(*names, "__at")
    while True:
        more = cut_lineage(begun.join(jump, [*names, "__at"]).select(*names, F.col("__to").alias("__at")))
        if not more.limit(1).count():
            break
        begun = cut_lineage(begun.unionByName(more))
        further = jump.select(*names, F.col("__at").alias("__to"), F.col("__to").alias("__then"))
        jump = cut_lineage(jump.join(further, [*names, "__to"]).select(*names, "__at", F.col("__then").alias("__to")))
    marked = rows.join(begun.withColumn("__new", F.lit(1).cast("long")), [*names, "__at"], "left")
    done = scan(marked, names, "__at", {"__batch": ("sum", F.coalesce("__new", F.lit(0).cast("long")))}, chunk=CHUNK)
    return done.select("__row.*", (F.col("__batch") - 1).alias(out))


def batch_summary(df: DataFrame, size: str, keys: Sequence[str] = (), batch: str = "batch") -> DataFrame:
    """Rows and total size of each batch."""
    return df.groupBy(*keys, batch).agg(F.count(F.lit(1)).alias("n"), F.sum(size).cast("long").alias("total"))
