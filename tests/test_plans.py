from pyspark.sql import functions as F

from cohortloom import CohortDataset
from cohortloom.operators import cohort as C
from cohortloom.operators import tiles as T
from cohortloom.operators.copynumber import gene_copies, segment_gene_map
from cohortloom.plans.annotate import annotate_dataset, subset_annotation
from cohortloom.plans.prepare import log_ratio, model_input, prepare_samples
from tests.conftest import rows


def test_annotate_whole_cohort(spark):
    genes = spark.createDataFrame([("G1", "AAA", "chr1", 10, 20, "+", True, True, True, False), ("G2", "BBB", "chr1", 150, 160, "-", True, False, False, False)],
                                  "gene_id string, gene_name string, chr string, start int, end int, strand string, anno_goi boolean, somatic_goi boolean, germline_goi boolean, somatic_art boolean")
    seg = spark.createDataFrame([("s", "a", "chr1", 1, 100, 100, 1.0, 0.0, 1.0), ("s", "b", "chr1", 101, 200, 100, 4.0, 2.0, 4.1), ("s", "c", "chr2", 1, 500, 500, 2.0, 1.0, 2.0)],
                                "id string, var_id string, chr string, start int, end int, width int, C double, K double, sC double")
    som = spark.createDataFrame([("s", "v", "G1", "AAA", "stop_gained", "p.Arg10Ter")], "id string, var_id string, gene_id string, gene_name string, consequence string, hgvsp string")
    meta = spark.createDataFrame([("s", "female", 2.2)], "id string, sex string, ploidy double")
    ds = CohortDataset.build(spark, {"segment": seg, "somatic": som, "gene_copy": gene_copies(seg, genes)}, {"segment": segment_gene_map(seg, genes)}, meta, genes)
    arms = spark.createDataFrame([("chr1", 1, 100, "chr1p"), ("chr1", 101, 200, "chr1q"), ("chr2", 1, 500, "chr2p")], "chr string, start int, end int, arm string")
    cent = spark.createDataFrame([("chr1", 95, 105)], "chr string, start int, end int")
    bands = spark.createDataFrame([("chr1", 1, 100, "p1"), ("chr1", 101, 200, "q1"), ("chr2", 1, 500, "p1")], "chr string, start int, end int, name string")
    sizes = spark.createDataFrame([("chr1", 200), ("chr2", 500)], "chr string, length long")
    out = annotate_dataset(ds, arms, cent, bands, sizes)
    assert rows(out["somatic"], "gene_name", "annotation", "aa_pos") == [("AAA", "truncating", 10)]
    assert dict(rows(out["gene_copy"], "gene_id", "annotation")) == {"G1": "LOH", "G2": "Gain"}
    assert dict(rows(out["arms"], "arm", "annotation")) == {"chr1p": "loss", "chr1q": "gain", "chr2p": "none"}
    cin = out["cin"].collect()[0]
    assert abs(cin["gii"] - 200 / 700) < 1e-9 and abs(cin["loh_portion"] - 100 / 700) < 1e-9 and cin["arm_total"] == 2 and cin["fg"] == 1
    assert subset_annotation(out, ["none"])["arms"].count() == 0
    hits = C.gene_hits(ds.ids(), genes, {"somatic": ds.table("somatic"), "gene_copy": ds.table("gene_copy")}, dense=True)
    assert dict(rows(hits, "gene_id", "hits")) == {"G1": 2, "G2": 0}


def test_prepare_samples_and_model_input(spark):
    r = []
    for chrom, n in (("chr1", 60), ("chrX", 40)):
        for i in range(n):
            r.append(("s", chrom, i * 100 + 1, i * 100 + 100, chrom + "p", i % 5 != 0, 0.0, 1.0, 0.0, 0.0, 0.4 + (i % 10) / 50, 80.0 + i % 7, 60.0 + i % 5))
    tiles = spark.createDataFrame(r, "id string, chr string, start long, end long, arm string, target boolean, gap double, unmasked double, blacklist double, difficult double, gc double, t_cov_raw double, n_cov_raw double")
    s = [("s", c, i * 100 + 50, "A", "C", 50.0, "target", "SNV", False, 0.3, "0/1", 0.5, 60 + i % 30, "0/1", 0.5, 60 + i % 30) for c, n in (("chr1", 60), ("chrX", 40)) for i in range(n)]
    s.append(("s", "chr1", 7, "AT", "C", 50.0, "target", "SNV", False, None, "0/1", 0.5, 60, "0/1", 0.5, 60))
    snps = spark.createDataFrame(s, "id string, chr string, pos long, ref string, alt string, qual double, source string, type string, somatic boolean, population_af double, t_gt string, t_af double, t_dp int, n_gt string, n_af double, n_dp int")
    whole = spark.createDataFrame([("chr1", 1, 10_000), ("chrX", 1, 10_000)], "chr string, start long, end long")
    none = whole.filter("1 = 0")
    o = T.TileOptions(hq_min_coverage=100)
    p = prepare_samples(snps, tiles, {"loose": whole, "strict": whole, "difficult": none}, none, o)
    assert p["snps"].count() == 100 and p["snps"].filter("n_pass").count() > 40
    assert rows(p["sex"]) == [("s", "female")]
    assert p["tiles"].filter("nC <> 2").count() == 0
    m = model_input(p, "tumor", o)
    t = m["tiles"]
    assert t.count() == 100 and t.filter("baf_n > 0").count() > 40
    assert abs(t.filter("hq and target").agg(F.avg("lr")).collect()[0][0]) < 0.05
    st = m["stats"].collect()[0]
    assert st["sd_lr"] > 0 and st["sd_baf"] >= 0
    # Every kind of ratio can be asked for; each equals its definition on the normalised coverage.
    t = p["tiles"]
    for c in "tn":
        t = T.normalise_coverage(t, f"{c}_cov_raw", f"{c}_cov")
    noise = t.select("chr", "start", F.explode(F.array(F.lit("male"), F.lit("female"))).alias("pool"), F.lit(0.1).alias("sd"), F.lit(2.0).alias("median"), (F.col("chr") == "chrX").alias("sex_chr"))
    none_of = t.select("chr", "start", F.lit(0).alias("comp"), F.lit(0.0).alias("u"))
    for kind, want in {"t_lr": F.log2("t_cov"), "n_lr": F.log2("n_cov"), "tn_lr": F.log2(F.col("t_cov") / F.col("n_cov")), "tp_lr": F.log2(F.col("t_cov") / F.col("n_cov")), "np_lr": F.log2(F.col("n_cov") / 2.0)}.items():
        got = log_ratio(t, kind, p["sex"], {"noise": noise, "components": none_of}).withColumn("want", want)
        assert got.count() == 100 and got.filter("abs(lr - want) > 1e-9 or lr is null").count() == 0, kind
    assert model_input(p, "tumor", o, tumor="alone")["tiles"].filter("lr is not null").count() == 100


def test_retrievals_are_sorted_by_sample(spark):
    sv = spark.createDataFrame([("s", "a", 0.1, 5.0), ("s", "b", 0.4, 1.0), ("s", "c", 0.4, 9.0), ("s", "d", None, 9.0), ("t", "e", 0.9, 1.0)], "id string, var_id string, aft double, qual double")
    assert [r["var_id"] for r in C.retrieve_structural(sv, ["s"]).collect()] == ["c", "b", "a", "d"]
    gx = spark.createDataFrame([("s", "g1", "A", 1.0, 2.0), ("s", "g1", "A", 1.0, 5.0), ("s", "g2", "B", 7.0, None), ("s", "g3", "C", None, 1.0)], "id string, gene_id string, gene_name string, rpkm double, c double")
    assert [tuple(r) for r in C.retrieve_expression(gx).collect()] == [("s", "g2", "B", 7.0, None), ("s", "g1", "A", 1.0, 5.0), ("s", "g3", "C", None, 1.0)]
    f = spark.createDataFrame([("s", "x", "g1", "g2", 1, None), ("s", "y", "g1", "g2", 2, 3)], "id string, var_id string, gene_ids_5_1 string, gene_ids_3_1 string, sum_jnc long, sum_bpt long")
    r = C.recurrence(f, F.concat_ws("-", "gene_ids_5_1", "gene_ids_3_1"))
    assert [(x["var_id"], x["recur"]) for x in C.retrieve_fusions(f, r).collect()] == [("y", 2), ("x", 2)]
    data = spark.createDataFrame([("s", "prot", [1.0, -1.0, 3.0]), ("t", "prot", [2.0, 0.5, 1.0])], "id string, name string, value array<double>")
    feats = spark.createDataFrame([("prot", ["a", "b", "c"], ["A", "B", "C"])], "name string, feature array<string>, gene array<string>")
    assert [(x["feature"], x["value"]) for x in C.retrieve_features(data, feats, "prot", ["s"]).collect()] == [("c", 3.0), ("a", 1.0), ("b", None)]
    g = spark.createDataFrame([("s", "p1", "k"), ("t", "p2", "k")], "id string, patient string, cohort string")
    assert rows(C.feature_distribution(data, feats, "prot", "a", g), "id", "value", "patient") == [("s", 1.0, "p1"), ("t", 2.0, "p2")]
    assert C.feature_distribution(data, feats, "prot", "none", g).count() == 0 and rows(C.feature_names(data)) == [("s", "prot"), ("t", "prot")]
