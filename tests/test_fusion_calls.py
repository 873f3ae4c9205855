"""Fusion calling from junctions to the report on a hand-made pair of genes."""

from pyspark.sql import functions as F

from cohortloom.operators import fusions as FU
from cohortloom.operators import genemodel as GM


def _model(spark):
    rows = []
    for c, g, at in (("chr1", "A", 1001), ("chr2", "B", 5001)):
        rows += [(c, at, at + 1099, "+", "gene", g, None), (c, at, at + 1099, "+", "transcript", g, f"T{g}")]
        for s in (at, at + 1000):
            rows += [(c, s, s + 99, "+", t, g, f"T{g}") for t in ("exon", "CDS")]
    return spark.createDataFrame(rows, "chr string, start long, end long, strand string, type string, gene_id string, transcript_id string")


def test_calls_and_report(spark):
    model = _model(spark)
    sizes = spark.createDataFrame([("chr1", 20_000), ("chr2", 20_000)], "chr string, length long")
    features = GM.typed_features(model, sizes)
    coding = model.filter("type = 'CDS'")
    exons = model.filter("type = 'exon'").select("chr", "start", "end", "strand", "transcript_id")
    loci = spark.createDataFrame([("chr1", 1001, 2100, "+", "LA"), ("chr2", 5001, 6100, "+", "LB"), ("chr1", 2101, 20_000, "+", "LC")], "chr string, start long, end long, strand string, locus_id string")
    bands = loci.select("locus_id", F.concat("chr", F.lit("p1")).alias("cytoband"), F.lit("p").alias("arm"))
    # The donor's first intron base and the acceptor's last one; four reads with different overlaps, and one poor junction.
    reads = [("s", 0, "chr1", 1101, "+", "chr2", 6000, "+", f"r{i}", True, 1.0, 0.0, 0.0, 30 + i, 50 + i, 0.0, 0.0, 80, 80) for i in range(4)]
    reads += [("s", 0, "chr1", 1500, "+", "chr2", 5500, "+", "bad", False, 0.2, 0.3, 0.3, 10, 10, 0.5, 0.5, 80, 80)]
    jnc = spark.createDataFrame(reads, "id string, type int, chr_5 string, pos_5 long, str_5 string, chr_3 string, pos_3 long, str_3 string, qname string, hq_jnc boolean, unq_jnc double, err_5 double, err_3 double, ovr_5 int, ovr_3 int, low_5 double, low_3 double, seg_5_len int, seg_3_len int")
    masks = spark.createDataFrame([("chr9", 1, 2, "alu")], "chr string, start long, end long, label string")
    none = loci.select("locus_id").limit(0)
    calls = FU.call_breakpoints(jnc, features, GM.coding_frames(coding), exons, masks, loci, bands, GM.adjacent_loci(loci), none)
    got = {r["pos_5"]: r for r in calls.collect()}
    good, bad = got[1101], got[1500]
    assert (good["l1"], good["topo"], good["dst"], good["l2"], good["d2a"], good["orf"], good["art"]) == ("spn", "tloc", "gme", "dist", True, True, False)
    assert good["sum_jnc"] == 4 and good["hq_bpt"] and good["l3"] == "sv" and good["sv_link"] and good["sv_chain"]
    assert not bad["hq_bpt"] and bad["l3"] == "nd" and bad["sv_link"] is None
    names = spark.createDataFrame([("LA", "geneA", "A"), ("LB", "geneB", "B")], "locus_id string, gene_names string, gene_ids string")
    splices = spark.createDataFrame([("s", "chr1", 1101, 2000, "+", 7), ("s", "chr1", 1101, 1900, "+", 2), ("s", "chr2", 5101, 6000, "+", 5)], "id string, chr string, start long, end long, strand string, nfrag int")
    report = FU.report_structural({"bpt": calls, "jnc": jnc}, names, bands.select("locus_id", "cytoband"), splices).collect()
    assert len(report) == 1
    r = report[0]
    assert (r["gene_names_5_1"], r["gene_names_3_1"], r["cyt_5_1"], r["tot_jnc"], r["tot_sp_jnc_5"], r["tot_sp_jnc_3"], r["qname"]) == ("geneA", "geneB", "chr1p1", 5, 9, 5, "r3")
