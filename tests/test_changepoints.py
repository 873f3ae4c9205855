"""Change points from chunk hulls against plain binary segmentation."""

import numpy as np
import pytest

from cohortloom.operators import changepoints as CP
from cohortloom.operators import model as MO

SCHEMA = "id string, pos long, y double"


def _series(spark, named):
    return spark.createDataFrame([(k, i * 7 + 1, None if v is None else float(v)) for k, ys in named.items() for i, v in enumerate(ys)], SCHEMA)


def _plain(ys, min_width, alpha=0.01):
    return {i * 7 + 1 for i in MO._breaks(np.array([np.nan if v is None else v for v in ys], float), min_width, alpha)}


@pytest.mark.parametrize("chunk, min_width", [(8, 2), (8, 20), (64, 3), (4096, 2)])
def test_equal_to_plain_search(spark, chunk, min_width):
    rng = np.random.default_rng(chunk + min_width)
    steps = lambda levels, n: [float(round(v, 3)) for level in levels for v in rng.normal(level, 0.2, n)]
    named = {
        "on chunk borders": steps([0, 1, 0, 2], 64),
        "inside chunks": steps([0, 1, -1, 1.5, 0], 37),
        "spike": steps([0], 60) + [9.0, 9.1, 9.2] + steps([0], 61),
        "noise": steps([0], 150),
        "gaps": [None if i % 5 == 0 else v for i, v in enumerate(steps([0, 2, 1], 50))] + [float("nan")],
        "constant": [1.0] * 40,
        "few levels": [float(v) for v in rng.integers(0, 2, 80)] + [float(v) for v in rng.integers(3, 5, 80)],
        "one": [1.0],
    }
    got = {k: set() for k in named}
    for r in CP.change_points(_series(spark, named), ["id"], "pos", "y", min_width, chunk=chunk).collect():
        got[r.id].add(r.pos)
    assert got == {k: _plain(ys, min_width) for k, ys in named.items()}
    assert got["on chunk borders"] and (min_width > 3 or got["spike"])


def test_corners_hold_the_best_split():
    rng = np.random.default_rng(5)
    for _ in range(50):
        s = np.concatenate([[0.0], np.cumsum(rng.normal(size=60))])
        at = sorted({*CP._chain(s), *CP._chain(-s)})
        for a, b in ((0, 60), (-40, 60), (-10, 90)):
            slope, start = rng.normal(), rng.normal()
            x = np.arange(max(a + 1, 0), min(b - 1, 60) + 1)
            dev = np.abs(s[x] - start - slope * (x - a)) / np.sqrt((x - a) * (b - x) / (b - a))
            inner = [k for k in at if x[0] <= k <= x[-1]]
            if x[0] == 0 and x[-1] == 60:
                assert int(x[np.argmax(dev)]) in inner


def test_joint_segments_and_edges(spark):
    rng = np.random.default_rng(2)
    lr = np.concatenate([rng.normal(0, 0.1, 50), rng.normal(1, 0.1, 70)])
    baf = np.concatenate([rng.normal(0, 0.1, 90), rng.normal(1, 0.1, 30)])
    df = spark.createDataFrame([(k, i, float(a), float(b) if k else None) for k in ("s", None) for i, (a, b) in enumerate(zip(lr, baf))], "id string, start long, lr double, baf double")
    seg = {(r.id, r.start): r.seg for r in CP.joint_segments(df, ["id"], "start", ["lr", "baf"], chunk=16).collect()}
    assert len(seg) == 240
    for k, ys in (("s", [lr, baf]), (None, [lr])):
        cuts = set().union(*(MO._breaks(y, 2, 0.01) for y in ys))
        assert [seg[(k, i)] for i in range(120)] == [1 + sum(c <= i for c in cuts) for i in range(120)]
    assert CP.change_points(df.limit(0), ["id"], "start", "lr").collect() == []
    assert CP.joint_segments(df.limit(0), ["id"], "start", ["lr", "baf"]).collect() == []
    with pytest.raises(ValueError):
        CP.change_points(df, ["id"], "start", "lr", min_width=0)
