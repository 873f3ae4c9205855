"""Ends of events in bins: one row per end, whatever the bins' widths."""

import random

import pytest

from cohortloom.operators import copynumber as N
from tests.conftest import rows


@pytest.mark.parametrize("longest", [90, 90_000_000])
def test_binned_recurrence_by_definition(spark, longest):
    r = random.Random(3)
    bins, at = [], {"a": -50, "b": 0}
    for i in range(60):
        c, w = r.choice("ab"), longest if i == 30 else r.randint(5, 90)
        bins.append((c, at[c], at[c] + w - 1, f"{c}{i}"))
        at[c] += w + r.randint(0, 9)
    bins += [("a", None, 7, "n"), (None, 1, 9, "m")]
    end = lambda: (r.choice(["a", "b", None]), r.choice([None, r.randint(-60, 1500)]) if r.random() < 0.1 else r.randint(-60, 1500))
    events = [(f"v{i}", *end(), *end(), r.choice(["x", None])) for i in range(300)]
    events += events[:9]
    where = lambda c, p: next((n for d, a, b, n in bins if c is not None and p is not None and a is not None and c == d and a <= p <= b), None)
    found = [(e[0], where(*e[1:3]), where(*e[3:5]), e[5]) for e in events]
    found = [f for f in found if f[1] and f[2]]
    made = N.binned_recurrence(spark.createDataFrame(events, "var_id string, chr1 string, pos1 long, chr2 string, pos2 long, f string"), spark.createDataFrame(bins, "chr string, start long, end long, name string"), [("chr1", "pos1"), ("chr2", "pos2")], ["f"])
    assert len(found) > 50
    assert rows(made, "var_id", "bin1", "bin2", "f", "recurrence") == sorted([(*f, sum(g[1:] == f[1:] for g in found)) for f in found], key=repr)


def test_points_are_not_copied(spark):
    from cohortloom.operators.intervals import overlap_join

    points = spark.createDataFrame([("a", 5)], "chr string, pos long")
    bins = spark.createDataFrame([("a", 0, 99)], "chr string, start long, end long")
    plan = overlap_join(points, bins, q=("pos", "pos"), bin_width=100, max_bins=None)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate explode") == 1  # that of the bins
