import random

from pyspark.sql import functions as F

from cohortloom.operators import intervals as I
from cohortloom.operators.common import first_row, later_wins, runs, scan, with_group
from tests.conftest import rows


def ranges(spark, n, seed, top=3000, wide=0.1):
    r = random.Random(seed)
    out = []
    for i in range(n):
        s = r.randint(1, top)
        w = r.randint(0, top // 2) if r.random() < wide else r.randint(0, 40)
        out.append((f"chr{r.randint(1, 2)}", s, s + w, r.choice("+-*"), f"{seed}_{i}"))
    return out, spark.createDataFrame(out, "chr string, start long, end long, strand string, name string")


def test_overlap_join_equals_naive_join_on_both_levels(spark):
    a, da = ranges(spark, 150, 1)
    b, db = ranges(spark, 150, 2)
    for gap, overlap, strand in ((-1, 0, None), (0, 0, None), (25, 0, "strand"), (-1, 5, None)):
        want = sorted(
            (x[4], y[4]) for x in a for y in b
            if x[0] == y[0] and x[1] - gap - 1 <= y[2] and y[1] <= x[2] + gap + 1 and (min(x[2], y[2]) - max(x[1], y[1]) + 1 >= overlap or overlap == 0)
            and (not strand or x[3] == y[3] or "*" in (x[3], y[3])))
        got = rows(I.overlap_join(da, db, maxgap=gap, minoverlap=overlap, strand=strand, bin_width=16, max_bins=4), "name", "s_name")
        assert got == want, (gap, overlap, strand)


def test_touching_nested_identical_and_empty(spark):
    df = spark.createDataFrame([("c", 1, 5), ("c", 6, 9), ("c", 2, 3), ("c", 2, 3), ("c", 20, 20), ("d", 4, 4)], "chr string, start long, end long")
    assert rows(I.merge_ranges(df, chunk=4), "chr", "start", "end") == [("c", 1, 9), ("c", 20, 20), ("d", 4, 4)]
    again = I.merge_ranges(I.merge_ranges(df, chunk=4), chunk=4)
    assert rows(again, "chr", "start", "end") == [("c", 1, 9), ("c", 20, 20), ("d", 4, 4)]
    sizes = spark.createDataFrame([("c", 25), ("d", 4), ("e", 3)], "chr string, length long")
    assert rows(I.gaps(df, sizes, chunk=4)) == [("c", 10, 19), ("c", 21, 25), ("d", 1, 3), ("e", 1, 3)]
    assert rows(I.merge_ranges(df.filter("1 = 0"))) == []


def test_algebra_against_base_sets(spark):
    a, da = ranges(spark, 40, 3, 400)
    b, db = ranges(spark, 40, 4, 400)
    base = lambda rs: {(r[0], p) for r in rs for p in range(r[1], r[2] + 1)}
    A, B = base(a), base(b)
    sizes = spark.createDataFrame([("chr1", 2000), ("chr2", 2000)], "chr string, length long")
    back = lambda df: {(r[0], p) for r in df.select("chr", "start", "end").collect() for p in range(r[1], r[2] + 1)}
    assert back(I.union_ranges(da, db)) == A | B
    assert back(I.intersect_ranges(da, db)) == A & B
    assert back(I.subtract(da, db)) == A - B
    pieces = I.disjoin(da, chunk=50).collect()
    assert sum(p["end"] - p["start"] + 1 for p in pieces) == len(A)
    for p in pieces:
        assert p["depth"] == sum(1 for r in a if r[0] == p["chr"] and r[1] <= p["start"] and r[2] >= p["end"])


def test_flags_coverage_and_nearest_against_brute_force(spark):
    a, da = ranges(spark, 80, 5)
    b, db = ranges(spark, 20, 6)
    hit = dict(rows(I.overlap_flag(da, db, "hit"), "name", "hit"))
    for x in a:
        assert hit[x[4]] == any(x[0] == y[0] and x[1] <= y[2] and y[1] <= x[2] for y in b)
    share = dict(rows(I.covered_fraction(da, db, "f"), "name", "f"))
    covered = {(y[0], p) for y in b for p in range(y[1], y[2] + 1)}
    for x in a:
        n = sum((x[0], p) in covered for p in range(x[1], x[2] + 1))
        assert abs(share[x[4]] - n / (x[2] - x[1] + 1)) < 1e-12
    pts = da.select("chr", F.col("start").alias("pos"), "name")
    got = dict(rows(I.nearest(pts, db, point_key=["name"]), "name", "n_start"))
    for x in a:
        cand = [y for y in b if y[0] == x[0]]
        dist = lambda y: 0 if y[1] <= x[1] <= y[2] else (x[1] - y[2] if y[2] < x[1] else y[1] - x[1])
        best = min(cand, key=lambda y: (dist(y), y[1], y[2]))
        assert got[x[4]] == best[1]


def test_no_position_is_too_high(spark):
    far = 3_000_000_000
    q = spark.createDataFrame([("c", 10, 20, "a"), ("c", far, far + 9, "b"), ("c", 2 * far, 2 * far, "x"), ("d", 5, 5, "d")], "chr string, start long, end long, name string")
    s = spark.createDataFrame([("c", 18, 30), ("c", far + 9, far + 10)], "chr string, start long, end long")
    assert dict(rows(I.overlap_flag(q, s, "hit"), "name", "hit")) == {"a": True, "b": True, "x": False, "d": False}
    pts = q.select("chr", F.col("start").alias("pos"), "name")
    assert dict(rows(I.nearest(pts, s, point_key=["name"]), "name", "n_start")) == {"a": 18, "b": far + 9, "x": far + 9, "d": None}
    marks = s.select("chr", F.col("start").alias("pos"))
    assert dict(rows(I.asof_join(pts, marks), "name", "m_pos")) == {"a": None, "b": 18, "x": far + 9, "d": None}
    assert dict(rows(I.asof_join(pts, marks, direction="forward"), "name", "m_pos")) == {"a": 18, "b": far + 9, "x": None, "d": None}
    assert rows(I.subtract(q, s)) == [("c", 10, 17), ("c", far, far + 8), ("c", 2 * far, 2 * far), ("d", 5, 5)]


def test_asof_against_brute_force(spark):
    r = random.Random(12)
    marks = sorted({r.randint(0, 5000) for _ in range(60)})
    pts = [(i, r.randint(-10, 6000)) for i in range(400)]
    m, p = spark.createDataFrame([("c", x) for x in marks], "chr string, pos long"), spark.createDataFrame([("c", x, i) for i, x in pts], "chr string, pos long, i long")
    for width in (7, 100, 10_000):
        back = dict(rows(I.asof_join(p, m, bin_width=width), "i", "m_pos"))
        ahead = dict(rows(I.asof_join(p, m, bin_width=width, direction="forward"), "i", "m_pos"))
        for i, x in pts:
            assert back[i] == max((y for y in marks if y <= x), default=None) and ahead[i] == min((y for y in marks if y >= x), default=None)


def test_tiling_covers_every_base_once(spark):
    sizes = spark.createDataFrame([("a", 25), ("b", 10)], "chr string, length long")
    assert rows(I.tile_sequences(sizes, 10)) == [("a", 1, 10), ("a", 11, 20), ("a", 21, 25), ("b", 1, 10)]


def test_scan_and_runs_do_not_depend_on_chunks(spark):
    r = random.Random(9)
    data = [("k", i, r.choice([None, 1, 2, 3]), r.choice("ab")) for i in range(0, 300, 3)]
    df = spark.createDataFrame(data, "k string, pos long, v int, lab string")
    specs = {"s": ("sum", F.col("v")), "m": ("max", F.col("v")), "l": ("last", F.col("v"))}
    for kw in ({}, {"inclusive": False}, {"reverse": True}, {"inclusive": False, "reverse": True}):
        one = rows(scan(df, ["k"], "pos", specs, chunk=None, **kw).withColumn("s", F.coalesce("s", F.lit(0))), "pos", "s", "m", "l")
        two = rows(scan(df, ["k"], "pos", specs, chunk=7, **kw), "pos", "s", "m", "l")
        assert one == two, kw
    a = rows(runs(df, ["k"], "pos", ["lab"], chunk=5), "pos", "run")
    start = None
    for i, (k, p, v, lab) in enumerate(data):
        start = p if i == 0 or data[i - 1][3] != lab else start
        assert (p, start) in a


def test_group_helpers(spark):
    df = spark.createDataFrame([("a", 1), ("a", 3), (None, 5)], "k string, v int")
    assert rows(with_group(df, ["k"], {"n": F.count("*")})) == [("a", 1, 2), ("a", 3, 2), (None, 5, 1)]
    assert rows(first_row(df, ["k"], [F.col("v").desc()])) == [("a", 3), (None, 5)]
    c = later_wins([(F.col("v") > 0, F.lit("x")), (F.col("v") > 2, F.lit("y")), (F.lit(None).cast("boolean"), F.lit("z"))], F.lit("-"))
    assert [r[0] for r in df.orderBy("v").select(c).collect()] == ["x", "y", "y"]
