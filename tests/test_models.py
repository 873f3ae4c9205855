import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortloom.functions import numeric as M
from cohortloom.functions import text as X
from cohortloom.operators import copynumber as N
from cohortloom.operators import fusions as FU
from cohortloom.operators import genemodel as GM
from cohortloom.operators import graph as G
from cohortloom.operators import identity as ID
from cohortloom.operators import instability as S
from cohortloom.operators import model as MO
from cohortloom.operators import purity as P
from cohortloom.operators import tiles as T
from cohortloom.operators import variants as V
from cohortloom.settings import merge, parse_overrides, with_overrides
from tests.conftest import rows


def test_weighted_median_exact_half_and_mode(spark):
    df = spark.createDataFrame([("a", 1.0, 5), ("a", 3.0, 5), ("b", 1.0, 1), ("b", 2.0, 5), ("b", None, 9)], "id string, C double, width int")
    assert rows(N.weighted_median(df, ["id"], "C", "width")) == [("a", 2.0), ("b", 2.0)]
    assert rows(N.modal_value(df, ["id"], "C")) == [("a", 2.0), ("b", 1.5)]


def test_copy_labels(spark):
    df = spark.createDataFrame(
        [(0.0, 0.0, "chr1p", 2.0, 2.0, 100, "female", "Homo-del"), (0.0, 0.0, "chrXp", 2.0, 2.0, 100, "female", "Homo-del"), (9.0, 1.0, "chr1p", 3.0, 2.0, 100, "male", "Amplification"),
         (5.0, 1.0, "chr1p", 3.0, 2.0, 100, "male", "Gain"), (5.0, 1.0, "chr1p", 3.0, 2.0, None, "male", "None"), (1.0, 0.0, "chrXp", 1.0, 2.0, 5, "male", "None"), (2.0, 0.0, "chr1p", 2.0, 2.0, 5, "male", "LOH"),
         (None, None, "chr1p", 2.0, 2.0, 5, "male", None)], "c double, k double, arm string, aa double, wm double, w int, sex string, want string")
    lab = N.copy_label(F.col("c"), F.col("k"), F.col("arm"), F.col("aa"), F.col("wm"), F.col("w"), F.col("sex"))
    assert [r[0] for r in df.select(lab).collect()] == [r["want"] for r in df.collect()]


def test_arm_calls_and_tallies(spark):
    arms = spark.createDataFrame([("chr1", 1, 100, "chr1p"), ("chr1", 101, 200, "chr1q"), ("chrX", 1, 100, "chrXp")], "chr string, start int, end int, arm string")
    seg = spark.createDataFrame([("s", "chr1", 1, 100, 100, 5.0), ("s", "chr1", 101, 180, 80, 5.0), ("s", "chr1", 181, 200, 20, None), ("s", "chr2", 1, 900, 900, 2.0), ("s", "chr3", 1, 900, 900, 2.0), ("s", "chr4", 1, 9, 9, 2.0)],
                                "id string, chr string, start int, end int, width int, C double")
    meta = spark.createDataFrame([("s", 2.0), ("t", 2.0)], "id string, ploidy double")
    calls = N.call_arms(seg, arms, meta)
    assert rows(calls, "arm", "annotation") == [("chr1p", "gain"), ("chr1q", "gain")]
    assert rows(N.call_chromosomes(calls), "chr", "annotation") == [("chr1", "gain")]
    assert rows(N.tally_arms(calls, meta), "id", "chr_whole", "chr_whole_gain", "arm_only", "arm_total") == [("s", 1, 1, 0, 2), ("t", 0, 0, 0, 0)]


def test_lst_counts_close_changes(spark):
    seg = spark.createDataFrame([("s", "chr1", "p", 1, 100, 100, 1.0, 0.0, 1.0), ("s", "chr1", "p", 101, 105, 5, 2.0, 1.0, 2.0), ("s", "chr1", "p", 106, 200, 95, 3.0, 1.0, 3.0), ("s", "chr1", "p", 400, 500, 101, 2.0, 1.0, 2.0)],
                                "id string, chr string, arm string, start int, end int, width int, C double, K double, sC double")
    t = S.Thresholds(lst_length=50, lst_distance=30)
    assert rows(S.lst(seg, t)) == [("s", 1)]


def test_half_sample_mode_and_purity(spark):
    vals = [0.1, 0.2, 0.38, 0.4, 0.41, 0.42, 0.9]
    df = spark.createDataFrame([("s", v) for v in vals], "id string, aft double")
    half = math.ceil(len(vals) / 2)
    s = sorted(vals)
    i = min(range(len(s) - half + 1), key=lambda i: (s[i + half - 1] - s[i], s[i]))
    want = float(np.mean(s[i:i + half]))
    got = P.half_sample_mode(df, "aft", ["id"]).collect()[0]["mode"]
    assert abs(got - want) < 1e-9
    p = P.purity_from_variants(df, cut=0.15).collect()[0]
    assert 0 < p["purity"] <= 1.2


def test_cell_fraction_picks_multiplicity(spark):
    var = spark.createDataFrame([("s", "v1", "chr1", 10, 0.4, 200.0), ("s", "v2", "chr1", 20, 0.8, 200.0), ("s", "v3", "chr9", 20, 0.8, 200.0)], "id string, var_id string, chr string, pos long, aft double, dpt double")
    seg = spark.createDataFrame([("s", "chr1", 1, 100, 2.0, 0.0, 2.0)], "id string, chr string, start long, end long, C double, K double, nC double")
    meta = spark.createDataFrame([("s", 0.8, 2.0)], "id string, purity double, ploidy double")
    got = {r["var_id"]: r for r in P.cell_fractions(var, seg, meta).collect()}
    assert (got["v1"]["m"], got["v2"]["m"], got["v3"]["m"]) == (1, 2, None)
    assert abs(got["v1"]["ccf"] - 1.0) < 1e-9 and abs(got["v2"]["ccf"] - 1.0) < 1e-9


def test_segmentation_finds_steps_and_prunes(spark):
    rng = np.random.default_rng(1)
    y = np.concatenate([rng.normal(0, 0.1, 60), rng.normal(1, 0.1, 60), rng.normal(1.0, 0.1, 60)])
    df = spark.createDataFrame([("s", "chr1p", "chr1", i * 10 + 1, i * 10 + 10, float(v), None, 0, None, True, True) for i, v in enumerate(y)],
                               "id string, arm string, chr string, start long, end long, lr double, baf double, baf_n int, nvar double, hq boolean, target boolean")
    stats = spark.createDataFrame([("s", 0.1, 0.1)], "id string, sd_lr double, sd_baf double")
    seg = MO.segment_tiles(df, stats)
    first = {r["seg"]: r["m"] for r in seg.groupBy("seg").agg(F.min("start").alias("m")).collect()}
    assert set(first) == {1, 2} and abs(first[2] - 601) <= 20
    tiles = df.join(seg, ["id", "arm", "chr", "start"])
    assert MO.segment_ranges(tiles).count() == 2


def test_fine_search_recovers_purity(spark):
    p, pl, rng = 0.6, 2.2, np.random.default_rng(3)
    rowsx, segs, snps = [], [], []
    for seg, c in enumerate([2, 2, 3, 1, 2, 4], start=1):
        mean = math.log2((p * c + (1 - p) * 2) / (p * pl + (1 - p) * 2))
        for _ in range(60):
            rowsx.append(("s", seg, float(mean + rng.normal(0, 0.05)), 2, True, 0.05))
        segs.append(("s", seg, 60_000, 60, 20))
        k = {1: 0, 2: 1, 3: 1, 4: 2}[c]
        ef = (p * k + 1 - p) / (p * c + 2 * (1 - p))
        snps += [("s", seg, round(float(ef), 3), 200) for _ in range(20)]
    t = spark.createDataFrame(rowsx, "id string, seg int, lr double, nC int, hq boolean, sd double")
    s = spark.createDataFrame(segs, "id string, seg int, len long, nlr long, naf long")
    v = spark.createDataFrame(snps, "id string, seg int, af double, dp int")
    o = MO.ModelOptions(max_c=5, grid_max_c=5, fine_off=0.05, fine_res=0.05, max_iter=2)
    cand = spark.createDataFrame([("s", "1", 0.55, 2.2, 2.2)], "id string, cand string, p double, P1 double, cP1 double")
    out = {r["data"]: r for r in MO.fine_search(t, s, v, cand, o).collect()}
    assert abs(out["af"]["p"] - 0.6) < 1e-6 and abs(out["lr"]["p"] - 0.6) <= 0.0501
    m = MO.segment_models(t, s, v, spark.createDataFrame([("s", "1", 0.6, 2.2)], "id string, cand string, p double, ploidy double"), o)
    assert [r["C"] for r in m.orderBy("seg").collect()] == [2.0, 2.0, 3.0, 1.0, 2.0, 4.0]
    assert [r["K"] for r in m.orderBy("seg").collect()] == [1.0, 1.0, 1.0, 0.0, 1.0, 2.0]
    assert MO.rank_models(MO.evaluate_models(m, o)).collect()[0]["rank"] == 1


def test_pool_components_match_svd(spark):
    rng = np.random.default_rng(5)
    m = rng.normal(size=(30, 4))
    lr = spark.createDataFrame([("n%d" % j, "chr1", i, float(m[i, j])) for i in range(30) for j in range(4)], "id string, chr string, start int, lr double")
    comp = T.pool_components(lr, 2)
    got = np.zeros((30, 4))
    for r in T.pool_denoise(lr, comp).collect():
        got[r["start"], int(r["id"][1:])] = r["lr"]
    u = np.linalg.svd(m, full_matrices=False)[0][:, :2]
    assert np.allclose(got, m - u @ (u.T @ m), atol=1e-8)


def test_bias_correction_removes_a_trend(spark):
    rng = np.random.default_rng(6)
    gc = rng.uniform(0.25, 0.75, 800)
    lr = 2 * gc + rng.normal(0, 0.01, 800)
    t = spark.createDataFrame([("s", "chr1", i, i, True, True, float(gc[i]), float(lr[i])) for i in range(800)], "id string, chr string, start int, end int, target boolean, hq boolean, gc double, lr double")
    out = np.array([r["lr"] for r in T.correct_bias(t, "lr").collect()])
    assert out.std() < 0.03 and abs(out.mean()) < 0.01


def test_bias_correction_keeps_values_without_a_trend_of_their_own(spark):
    t = spark.createDataFrame([("s", "chr1", i, i, True, i < 50, 0.3 + i / 400, 1.0) for i in range(60)] + [("s", "chr1", 99, 99, False, True, 0.5, 3.0), ("n", "chr1", 1, 1, True, False, 0.4, 2.0)], "id string, chr string, start int, end int, target boolean, hq boolean, gc double, lr double")
    got = {(r["id"], r["start"]): r["lr"] for r in T.correct_bias(t, "lr").collect()}
    assert all(abs(got[("s", i)]) < 1e-9 for i in range(60)) and got[("s", 99)] == 3.0 and got[("n", 1)] == 2.0


def test_fisher_known_values(spark):
    df = spark.createDataFrame([(3, 1, 1, 3), (10, 0, 0, 10), (0, 5, 0, 5), (None, 1, 1, 1)], "a int, b int, c int, d int")
    got = [r[0] for r in df.select(M.fisher_exact("a", "b", "c", "d")).collect()]
    assert abs(got[0] - 0.4857142857) < 1e-9 and abs(got[1] - 1.0825088e-05) < 1e-10 and abs(got[2] - 1) < 1e-12 and got[3] is None


def test_text_functions(spark):
    df = spark.createDataFrame([("p.Val600Glu", "5S20M2I10N3M4H"), (None, "30M")], "h string, c string")
    r = df.select(X.short_protein(F.col("h")), X.amino_acid_position(F.col("h")), X.query_width(F.col("c")), X.reference_width(F.col("c")), X.clip_left(F.col("c")), X.clip_right(F.col("c"))).collect()
    assert tuple(r[0]) == ("V600E", 600, 25, 33, 5, 4) and tuple(r[1]) == ("", None, 30, 30, 0, 0)
    t = spark.createDataFrame([('gene_id "A"; tag "x"; tag "y";',)], "a string").select(X.collapse_tags(F.col("a"))).collect()[0][0]
    assert 'tags "x,y"' in t and 'tag "x"' not in t


def test_phased_merge_with_reference_bases(spark):
    v = spark.createDataFrame([("s", "chr1", "p", 10, "A", "T"), ("s", "chr1", "p", 12, "C", "G"), ("s", "chr1", "p", 40, "C", "G"), ("s", "chr1", None, 11, "G", "C")], "id string, chr string, pid string, pos long, ref string, alt string")
    bases = spark.createDataFrame([("chr1", i, "N") for i in range(1, 50)], "chr string, pos long, base string")
    full = V.merge_phased(v.withColumn("depth", F.col("pos") * 10), bases, 1)
    assert rows(full, "pos", "depth") == [(10, 100), (11, 110), (40, 400)]
    assert rows(V.merge_phased(v, bases, 1), "var_id") == [("chr1:10_ANC/TNG",), ("chr1:11_G/C",), ("chr1:40_C/G",)]


def test_components_with_cycle_and_hub(spark):
    e = [("a", "b"), ("b", "c"), ("c", "a"), ("x", "y")] + [("h", f"l{i}") for i in range(50)] + [(f"n{i}", f"n{i+1}") for i in range(10, 40)]
    got = dict(rows(G.connected_components(spark.createDataFrame(e, "src string, dst string"))))
    assert got["c"] == "a" and got["y"] == "x" and got["l49"] == "h" and got["n40"] == "n10"


def test_genotype_strings_and_scores(spark):
    calls = spark.createDataFrame([("s", 1, "A"), ("s", 2, "A/C"), ("s", 3, "UNKNOWN")], "id string, name int, final_call string")
    assert rows(ID.genotype_string(calls)) == [("s", "AMN")]
    pop = spark.createDataFrame([("x", "AMN"), ("y", "AAN"), ("z", "CMA")], "id string, genotype string")
    got = dict(rows(ID.genotype_scores("AMN", pop, scale="none"), "id", "score"))
    assert got == {"x": 3.0, "y": 2.0, "z": 1.25}


def test_allele_table_counts_and_call(spark):
    c = spark.createDataFrame([("s", "1", "A", "C", 7, 8, 15, "0/1"), ("s", "2", "G", "T", 0, 0, 9, "0/0")], "id string, name string, ref string, alt string, ref_ct int, alt_ct int, depth int, genotype string")
    assert rows(ID.allele_table(c), "name", "A", "C", "G", "T", "genotype", "final_call") == [("1", 7, 8, 0, 0, "0/1", "A/C"), ("2", 0, 0, 9, 0, "0/0", "G")]


def test_homopolymers_across_chunks(spark):
    seq = "CAAAAAATTTTTGGAAAAACCCCC"
    bases = spark.createDataFrame([("c", i + 1, b) for i, b in enumerate(seq)], "chr string, pos long, base string")
    for w in (3, 4, 7, 100):
        assert rows(GM.homopolymers(GM.sequence_chunks(bases, w), w, "AT", 5), "base", "start", "end") == [("A", 15, 19), ("A", 2, 7), ("T", 8, 12)]


def test_validate_contigs(spark):
    key = ("s", 1, "chr1", 10, "+", "chr2", 20, "+")
    cols = "id string, type int, chr_5 string, pos_5 int, str_5 string, chr_3 string, pos_3 int, str_3 string"
    bpt = spark.createDataFrame([key], cols)
    aln = spark.createDataFrame([(*key, "k", 1, "chr1", "+", 60, 1, 11), (*key, "k", 50, "chr2", "+", 60, 19, 80)], cols + ", contig_id string, first_base_q int, rname string, strand string, mapq int, first_base_r int, last_base_r int")
    assert FU.validate_breakpoints(bpt, aln, "ok", 3, 30).collect()[0]["ok"]
    assert not FU.validate_breakpoints(bpt, aln, "ok", 0, 30).collect()[0]["ok"]


def test_settings():
    assert parse_overrides("a:1,b:x") == {"a": 1.0, "b": "x"}
    assert with_overrides(MO.ModelOptions(), "max_c:7").max_c == 7
    with pytest.raises(KeyError):
        with_overrides(MO.ModelOptions(), "nope:1")
    assert merge({"a": {"b": 1, "c": 2}}, {"a": {"b": 5}}) == {"a": {"b": 5, "c": 2}}


def test_arms_meet_no_group_call_each(spark):
    """Arms lie over the borders of batches; each is cut as if it were alone, in one stream of rows."""
    rng = np.random.default_rng(5)
    data = []
    for k in range(23):
        n = int(rng.integers(1, 90))
        y = rng.normal(0, 0.1, n) + (np.arange(n) >= n // 2) * (k % 3)
        arm = None if k % 7 == 3 else f"a{k % 4}"
        data += [(f"s{k // 4}", arm, "c", i * 10 + 1, float(v) if i % 11 else None, float(abs(v)), i % 3, float(k % 2) * 0.2 if k % 5 else None, None if i % 13 == 5 else i % 4 > 0, i % 6 > 0) for i, v in enumerate(y)]
    df = spark.createDataFrame(data, "id string, arm string, chr string, start long, lr double, baf double, baf_n int, nvar double, hq boolean, target boolean")
    stats = spark.createDataFrame([(f"s{k}", 0.1, 0.1) for k in range(6)], "id string, sd_lr double, sd_baf double")
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "17")
        made = MO.segment_tiles(df, stats)
        got = rows(made)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    alone = []
    for arm in sorted({r[1] for r in data if r[0] == "s0"}, key=repr):
        alone += rows(MO.segment_tiles(df.filter((F.col("id") == "s0") & F.col("arm").eqNullSafe(F.lit(arm))), stats))
    assert [r for r in got if r[0] == "s0"] == sorted(alone, key=repr) and len(got) == len(data)
    assert max(r[4] for r in got) > 1
    assert "FlatMapGroupsInPandas" not in made._jdf.queryExecution().toString()


def test_components_store_what_shrinks(spark, monkeypatch):
    """A graph of many edges is stored about once: later rounds hold only edges between different trees."""
    rng = np.random.default_rng(7)
    e = sorted({(f"o{a}", f"p{b}") for a, b in zip(rng.integers(0, 1500, 6000).tolist(), rng.integers(0, 300, 6000).tolist())})
    e += [(f"q{i:04}", f"q{i + 1:04}") for i in range(300)] + [("z", "z"), ("o1", "o1")]
    root = {}
    find = lambda v: v if root.setdefault(v, v) == v else find(root[v])
    for a, b in e:
        lo, hi = sorted((find(a), find(b)))
        root[hi] = lo
    stored = []

    def counted(df):
        out = keep(df)
        stored.append(out.count())
        return out

    keep = G.cut_lineage
    monkeypatch.setattr(G, "cut_lineage", counted)
    got = dict(rows(G.connected_components(spark.createDataFrame([*e, *e[:50], (None, "x")], "src string, dst string"))))
    assert got == {v: find(v) for v in list(root)}
    assert sum(stored) < 5 * len(e), stored


def test_locus_splices_without_pairs(spark):
    """Counts equal those of all pairs, whatever strands and nulls there are; a junction over very many bins is no burden."""
    rng = np.random.default_rng(11)
    strand = lambda: [None, "+", "-", "*", "+"][rng.integers(0, 5)]
    j = [(f"s{rng.integers(0, 3)}" if i % 17 else None, f"c{rng.integers(0, 2)}" if i % 19 else None, int(a), int(a + w) if i % 23 else None, strand(), int(rng.integers(0, 9)) if i % 5 else None) for i, (a, w) in enumerate(zip(rng.integers(0, 200, 300), rng.integers(-4, 60, 300)))]
    l = [(f"c{rng.integers(0, 3)}" if i % 13 else None, int(a), int(a + w), strand(), f"L{i % 30}" if i % 11 else None) for i, (a, w) in enumerate(zip(rng.integers(0, 200, 40), rng.integers(-3, 30, 40)))]
    types = "sid string, chr string, start long, end long, strand string, nfrag int", "chr string, start long, end long, strand string, locus_id string"
    pairs = {}
    for sid, c, a, b, s, n in j:
        for d, x, y, t, name in l:
            if None not in (sid, c, a, b, d, name) and c == d and a <= y and x <= b and ("*" in (s, t) or s is not None and s == t):
                k, f = pairs.get((sid, name), (0, 0))
                pairs[sid, name] = k + 1, f + (n or 0)
    wanted = sorted([(sid, r[4], *pairs.get((sid, r[4]), (0, 0))) for sid in ("s0", "s1", "s2", None) for r in l], key=repr)
    assert any(a > b for _, _, a, b, *_ in j if b is not None) and any(r[1] > r[2] for r in l) and len(pairs) > 50
    for reverse in (False, True):  # loci that end before they start are met in pairs
        loci = l if reverse else [r for r in l if r[1] <= r[2]]
        got = rows(GM.locus_splices(spark.createDataFrame(j, types[0]), spark.createDataFrame(loci, types[1])), "sid", "locus_id", "nsj", "nsfrag")
        assert not reverse or got == wanted
        assert reverse or len(got) == 4 * len(loci)
    wide = spark.createDataFrame([("s", "c", 5, 10**16, "+", 7)], types[0])
    assert rows(GM.locus_splices(wide, spark.createDataFrame([("c", 1, 4, "*", "a"), ("c", 9, 9, "*", "b")], types[1])), "locus_id", "nsj", "cspm") == [("a", 0, 0.0), ("b", 1, 1e6)]
