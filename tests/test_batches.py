"""Greedy batches against a loop over the rows."""

import random

import pytest

from cohortloom.operators.batches import batch_summary, greedy_batches
from cohortloom.operators.common import numbered


def looped(rows, limit):
    """Batch numbers of (key, at, size) by going through each key's rows in order."""
    out, state = {}, {}
    for key, at, size in sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1])):
        batch, total = state.get(key, (0, 0))
        out[key, at] = batch
        total += size or 0
        state[key] = (batch + 1, 0) if total >= limit else (batch, total)
    return out


@pytest.mark.parametrize("limit", [1, 40, 1000, 10**7])
def test_batches_equal_a_loop(spark, limit):
    r = random.Random(limit)
    rows = [("hot", i, r.choice([0, 0, 1, 3, 17, 900])) for i in range(400)]  # a hot sequence in which the total starts anew many times
    rows += [(k, i, r.choice([0, 5, None, 60])) for k in ("a", "b", None, "-") for i in range(r.randrange(1, 30))]
    r.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, at long, size long")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    got = {(x.k, x.at): x.batch for x in greedy_batches(df, ["at"], "size", limit, keys=["k"]).collect()}
    whole = {x.at: x.batch for x in greedy_batches(df.filter("k = 'hot'").drop("k"), ["at"], "size", limit).collect()}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    want = looped(rows, limit)
    assert got == want
    assert whole == {at: b for (k, at), b in want.items() if k == "hot"}


def test_edges_and_totals(spark):
    df = spark.createDataFrame([(1, 5), (2, 5), (3, 1)], "at long, size long")
    made = greedy_batches(df, ["at"], "size", 10)
    assert sorted((r.batch, r.n, r.total) for r in batch_summary(made, "size").collect()) == [(0, 2, 10), (1, 1, 1)]
    assert greedy_batches(df.limit(0), ["at"], "size", 10).collect() == []
    with pytest.raises(ValueError):
        greedy_batches(df, ["at"], "size", 0)
    with pytest.raises(Exception, match="negative size"):
        greedy_batches(spark.createDataFrame([(1, -5)], "at long, size long"), ["at"], "size", 10).collect()


def test_numbered(spark):
    rows = [(k, v) for k in (None, "x", "y") for v in range(50)]
    random.Random(1).shuffle(rows)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    got = numbered(spark.createDataFrame(rows, "k string, v long"), ["k"], ["v"]).collect()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert all(r.n == r.v for r in got) and len(got) == len(rows)
