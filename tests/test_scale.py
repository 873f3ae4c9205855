"""Plans and results of steps that have to grow with their input: pairings, interval joins, nearest ranges, selection."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from cohortloom.operators import copynumber as N
from cohortloom.operators import fusions as FU
from cohortloom.operators import intervals as I
from cohortloom.operators import model as MO
from cohortloom.operators import variants as V
from cohortloom.operators.common import grid
from cohortloom.operators.order import exact_percentiles


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_grid_pairs_all_without_broadcast(spark):
    left = spark.range(300).select(F.col("id").cast("string").alias("a"))
    right = spark.range(7).select(F.col("id").alias("b"), F.when(F.col("id") > 2, F.col("id")).alias("c"))
    made = grid(left, right)
    assert "Broadcast" not in plan_of(made)
    assert made.count() == 2100 and made.distinct().count() == 2100
    assert grid(left.limit(0), right).count() == 0 and grid(left, right.limit(0)).count() == 0


def test_overlap_join_sends_no_copies_through_the_driver(spark):
    g = spark.createDataFrame([("c", 1, 400, "x"), ("c", 300, 90_000, "y")], "chr string, start long, end long, name string")
    made = I.overlap_join(g, g, bin_width=100, max_bins=8)
    assert "Broadcast" not in plan_of(made)
    assert made.count() == 4


def test_percentiles_send_no_cells_through_the_driver(spark):
    df = spark.createDataFrame([(k, float(v)) for k in "ab" for v in range(10)], "k string, v double")
    made = exact_percentiles(df, ["k"], "v", {"p20": 0.2, "p50": 0.5})
    assert {r["k"]: (r["p20"], r["p50"]) for r in made.collect()} == {"a": (1.0, 4.0), "b": (1.0, 4.0)}
    joins = [x for x in plan_of(made).splitlines() if "Join" in x and "Outer" not in x]
    assert joins and not any("Broadcast" in x for x in joins)


def test_nearest_equals_plain_search_and_lists_no_pairs(spark):
    rng = random.Random(5)
    points = [(i, rng.choice("ab"), rng.randrange(400)) for i in range(300)] + [(300, "a", None), (301, None, 5), (302, "z", 5)]
    ranges = [(rng.choice("ab"), s := rng.randrange(400), s + rng.choice((0, 3, 40, 90)), i) for i in range(60)]
    p = spark.createDataFrame(points, "pid int, chr string, pos long")
    r = spark.createDataFrame(ranges, "chr string, start long, end long, name int")
    got = {x["pid"]: (x["n_start"], x["n_end"]) for x in I.nearest(p, r, point_key=["pid"]).collect()}
    for pid, chrom, pos in points:
        own = [(s, e) for c, s, e, _ in ranges if c == chrom and pos is not None]
        apart = lambda s, e, at=pos: 0 if s <= at <= e else at - e if e < at else s - at
        want = min(((apart(s, e), s, e) for s, e in own), default=(None, None, None))[1:]
        assert got[pid] == want, (pid, chrom, pos)
    plan = plan_of(I.nearest(p, r, point_key=["pid"]))
    assert "__slot" not in plan and "sequence(" not in plan


def test_asof_joins_points_by_position(spark):
    rng = random.Random(9)
    points = [(i, rng.choice("ab"), rng.randrange(200)) for i in range(200)] + [(200, None, 3), (201, "a", None)]
    marks = sorted({(rng.choice("ab"), rng.randrange(200)) for _ in range(40)})
    p = spark.createDataFrame(points, "pid int, chr string, pos long")
    m = spark.createDataFrame(marks, "chr string, pos long")
    for way in ("backward", "forward"):
        made = I.asof_join(p, m, direction=way, bin_width=16)
        got = {x["pid"]: x["m_pos"] for x in made.collect()}
        for pid, chrom, pos in points:
            near = [q for c, q in marks if c == chrom and pos is not None and (q <= pos if way == "backward" else q >= pos)]
            assert got[pid] == ((max if way == "backward" else min)(near) if near else None)
        assert "__tlo" not in plan_of(made)


def test_breakpoints_are_collapsed_without_copies_of_junctions(spark):
    key = {"id": "s", "type": 1, "chr_5": "a", "pos_5": 5, "str_5": "+", "chr_3": "b", "pos_3": 7, "str_3": None}
    rows = [{**key, "hq_jnc": i % 2 == 0, "unq_jnc": 0.5, **{f"{n}_{e}": 0.25 for n in ("err", "low") for e in "53"}, "ovr_5": o, "ovr_3": 9.0} for i, o in enumerate((3.0, 3.0, 4.0, None))]
    types = ", ".join(f"{k} {'string' if k[:3] in ('id', 'chr', 'str') else 'boolean' if k == 'hq_jnc' else 'int' if k in ('type', 'pos_5', 'pos_3') else 'double'}" for k in rows[0])
    made = FU.collapse_junctions(spark.createDataFrame([tuple(r.values()) for r in rows], types))
    got = made.collect()
    assert [(r["sum_jnc"], r["hq_sum_jnc"], r["unq_ovr_5"], r["unq_ovr_3"], r["max_ovr_5"]) for r in got] == [(4, 2, 2, 1, 4.0)]
    assert "Expand" not in plan_of(made)


def test_copy_states_are_made_behind_the_join(spark):
    tiles = spark.createDataFrame([("s", 1, 0.1 * i, 2.0, True, 0.4) for i in range(5)], "id string, seg int, lr double, nC double, hq boolean, sd double")
    points = spark.createDataFrame([("s", "a", 0.6, 2.0), ("s", "b", 0.5, 3.0)], "id string, cand string, p double, ploidy double")
    made = MO.copy_states(tiles, points, 3)
    assert made.count() == 2
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate explode") < plan.index("Join ")


def test_lookups_are_made_once_before_counting(spark):
    events = spark.createDataFrame([("v1", "a", 5, "b", 120, "x"), ("v2", "a", 7, "b", 130, "x"), ("v3", "a", 7, "b", 250, None)], "var_id string, chr1 string, pos1 long, chr2 string, pos2 long, f string")
    bins = spark.createDataFrame([(c, s, s + 99, f"{c}{s}") for c in "ab" for s in (0, 100, 200)], "chr string, start long, end long, name string")
    made = N.binned_recurrence(events, bins, [("chr1", "pos1"), ("chr2", "pos2")], ["f"])
    assert {r["var_id"]: r["recurrence"] for r in made.collect()} == {"v1": 2, "v2": 2, "v3": 1}
    assert "explode" not in plan_of(made)


def test_pair_consequence_reads_its_tables_once(spark):
    csq = spark.createDataFrame([("1a", "N", "T", 20, 5), ("1b", "N", "T", 10, 7)], "var_id string, symbol string, id_short string, impact_score int, preference_score int")
    pairs = spark.createDataFrame([("1a:1b", "1a", "1b", True)], "bnd_id string, id1 string, id2 string, proximal boolean")
    made = V.pick_pair_consequence(csq, pairs)
    assert {(r["var_id"], r["pair_impact"], r["pair_preference"]) for r in made.collect()} == {("1a", 20, 7), ("1b", 20, 7)}
    assert "ExistingRDD" not in plan_of(made)


def test_recurrent_ends_count_only_chosen_rows(spark):
    base = {"id": "s", "type": 1, "chr_5": "a", "pos_5": 5, "str_5": "+", "chr_3": "b", "str_3": "+", "l1": "spn", "l2": "dist", "d2a": True, "art_5": "nil", "art_3": "nil", "locus_id_5_1": "p", "locus_id_5_2": None, "locus_id_3_2": "q"}
    rows = [{**base, "pos_3": i, "locus_id_3_1": f"m{i}"} for i in range(3)] + [{**base, "pos_3": 9, "locus_id_3_1": "z", "l2": "prox"}, {**base, "pos_3": 10, "locus_id_3_1": "z", "l1": "enc"}, {**base, "pos_3": 11, "locus_id_3_1": "z", "d2a": None}]
    cols = list(rows[0])
    types = ", ".join(f"{c} {'boolean' if c == 'd2a' else 'int' if c in ('type', 'pos_5', 'pos_3') else 'string'}" for c in cols)
    made = FU.recurrent(spark.createDataFrame([tuple(r[c] for c in cols) for r in rows], types))
    got = {r["pos_3"]: (r["rec_5"], r["unq_rec_5"], r["hr_bpt"]) for r in made.collect()}
    assert got == {0: (3, 3, True), 1: (3, 3, True), 2: (3, 3, True), 9: (0, 0, True), 10: (0, 0, False), 11: (0, 0, True)}
    assert "Union" in plan_of(made)
