"""Breakpoints dealt by sample: the same rows as statistics joined back, without moving whole rows again."""

import random

import pytest
from pyspark.sql import functions as F

from cohortloom.operators import common as C
from cohortloom.operators import fusions as FU
from tests.conftest import rows

O = FU.FusionOptions(rec_ts=2, rec_chm=2, chm_hi=1.0, rec_ts_warn=2)
SCHEMA = "id string, type int, chr_5 string, pos_5 bigint, str_5 string, chr_3 string, pos_3 bigint, str_3 string, locus_id_5_1 string, locus_id_3_1 string, " \
    "locus_id_5_2 string, locus_id_3_2 string, sum_jnc bigint, unq_sum_jnc double, art_5 string, art_3 string, art boolean, d2a boolean, topo string, dst string, l1 string, l2 string, hq_bpt boolean"


@pytest.fixture(scope="module")
def bpt(spark):
    r = random.Random(5)
    pick = lambda *x: r.choice([*x, None]) if r.random() < 0.1 else r.choice(x)
    data = [(pick("a", "b", "c"), pick(-1, 0, 1), pick("c1", "c2"), pick(1, 2), pick("+", "-"), pick("c1", "c2"), pick(5, 6), pick("+", "-"), pick("x", "y"), pick("x", "z"), pick("x", "z"), pick("y", "z"),
             pick(1, 2, 3), pick(0.5, 1.0), pick("nil", "alu"), pick("nil", "aln"), pick(True, False), pick(True, False), pick("inv", "dup", "tloc"), pick("adj", "arm", "loc"), pick("spn", "enc"), pick("dist", "prox"), pick(True, False)) for _ in range(400)]
    return spark.createDataFrame(data + data[:20], SCHEMA)


def called(spark, bpt):
    b = FU.clustered(FU.recurrent(FU.high_importance(bpt, spark.createDataFrame([("x",), (None,)], "locus_id string"), O), O), O)
    return b, FU.read_totals(b, O), FU.topology_signature(bpt)


def test_whole_groups(spark):
    few = spark.range(100).select((F.col("id") % 10).cast("string").alias("id"))
    assert C.whole_groups(few, "id") == 1
    hot = spark.range(400_000).select(F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("id"))
    assert C.whole_groups(hot, "id") is None  # four tasks, two thirds of the rows in one sample
    assert C.whole_groups(hot.filter("id <> 'hot'"), "id") == 3


def test_both_ways_give_the_same_rows(spark, bpt, monkeypatch):
    by_sample = [rows(x) for x in called(spark, C.keep(bpt, "id", C.whole_groups(bpt, "id")))]
    monkeypatch.setattr(FU, "whole_groups", lambda *a: None)
    for a, b in zip(by_sample, [rows(x, *x.columns) for x in called(spark, bpt)], strict=True):
        assert a == b


def test_rows_dealt_by_sample_are_not_shuffled(spark, bpt):
    b, totals, signature = called(spark, C.keep(bpt, "id", 2))
    grouped = C.with_group(C.keep(bpt, "id", 2), FU.KEY, {"n": F.count("*")}, whole=True)
    for df, moves in ((totals, 1), (signature, 0), (grouped, 0)):  # recurrent puts its two parts together by one shuffle
        assert df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") <= moves


def test_links_meet_breakpoints_in_one_join(spark, bpt):
    linked = FU.link_breakpoints(FU.clustered(FU.recurrent(FU.high_importance(bpt, spark.createDataFrame([("x",)], "locus_id string"), O), O), O)).localCheckpoint()
    rules = FU._class_rules()
    for k, cond in rules.items():
        assert linked.filter(F.col(f"{k}_link").isNotNull() != F.coalesce(cond, F.lit(False))).count() == 0
    some = linked.filter("sl_link is not null or bs_link is not null or ts_link is not null or sv_link is not null")
    assert some.count() and linked.count() == bpt.count()
    # Rows of a class that share an end share the link.
    for k in rules:
        for e in ("5", "3"):
            assert linked.filter(F.col(f"{k}_link").isNotNull()).groupBy("id", f"chr_{e}", f"pos_{e}", f"str_{e}").agg(F.count_distinct(f"{k}_link").alias("n")).filter("n > 1").count() == 0
    chained = FU.chain_breakpoints(linked)
    assert chained._jdf.queryExecution().optimizedPlan().toString().count("Join LeftOuter") == 1


def test_pairs_are_dealt_once(spark, monkeypatch):
    from cohortloom.operators import variants as V

    r = random.Random(8)
    csq = spark.createDataFrame([(f"{k}{e}", r.choice(["N", "M", "", None]), r.choice(["T", "U", "W"]), r.choice([10, 20, None]), r.choice([1, 5, 7, None])) for k in range(40) for e in "ab" for _ in range(3)],
                                "var_id string, symbol string, id_short string, impact_score int, preference_score int").dropDuplicates(["var_id", "id_short"])
    pairs = spark.createDataFrame([(f"{k}", f"{k}a", f"{k}b", r.choice([True, False, None])) for k in range(40)] + [(None, "0a", "1b", True)], "bnd_id string, id1 string, id2 string, proximal boolean")
    moves = lambda df: df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        made = V.pick_pair_consequence(csq, pairs)
        few = moves(made)
        monkeypatch.setattr(V, "whole_groups", lambda *a: None)
        joined = V.pick_pair_consequence(csq, pairs)
        assert few < moves(joined)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert rows(made) == rows(joined, *made.columns)
