"""Selection in rounds against sorted lists."""

import random
import statistics

from pyspark.sql import functions as F

from cohortloom.operators.order import at_ranks, exact_median, exact_percentiles


def test_selection_equals_sorting(spark):
    r = random.Random(2)
    groups = {
        "reals": [r.lognormvariate(0, 8) for _ in range(3000)],  # one group of distinct reals over many magnitudes
        "ties": [float(r.choice([1, 2, 2, 2, 3])) for _ in range(900)],
        "one": [5.0],
        None: [r.uniform(-1, 1) for _ in range(40)],
    }
    rows = [(k, v) for k, vs in groups.items() for v in vs] + [("ties", None), ("one", float("nan")), ("empty", None)]
    r.shuffle(rows)
    df = spark.createDataFrame(rows, "g string, v double")
    got = {x.g: (x.n, x.median) for x in exact_median(df, ["g"], "v", small=20).collect()}
    assert got == {k: (len(v), statistics.median(v)) for k, v in groups.items()}
    parts = {x.g: (x.a, x.b) for x in exact_percentiles(df, ["g"], "v", {"a": 0.001, "b": 0.9}, small=20).collect()}
    assert parts == {k: tuple(sorted(v)[max(1, -int(-len(v) * p // 1)) - 1] for p in (0.001, 0.9)) for k, v in groups.items()}


def test_edges(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0)], "g string, v double")
    out = at_ranks(df, ["g"], "v", {"third": F.lit(3), "first": F.lit(1)}).collect()
    assert [(r.n, r.third, r.first) for r in out] == [(2, None, 1.0)]
    assert exact_median(df.limit(0), ["g"], "v").collect() == []
