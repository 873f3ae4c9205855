import pytest
from pyspark.sql import functions as F

from cohortloom import CohortDataset
from cohortloom.operators import triage as T
from cohortloom.plans.build import build_dataset
from cohortloom.sources import readers, writers
from cohortloom.streaming import incremental as INC
from tests.conftest import rows

GENES = "gene_id string, gene_name string, chr string, start int, end int, strand string, anno_goi boolean, somatic_goi boolean, germline_goi boolean, somatic_art boolean"


@pytest.fixture(scope="module")
def ds(spark):
    genes = spark.createDataFrame([("G1", "AAA", "chr1", 1, 100, "+", True, True, True, False), ("G2", "BBB", "chr1", 200, 300, "-", True, False, False, True)], GENES)
    som = spark.createDataFrame(
        [("s1", "v1", "G1", "HIGH", "annotation", "p1"), ("s1", "v2", "G1", "LOW", None, "p1"), ("s2", "v3", "G2", "HIGH", "keep;evidence", None), ("s2", "v4", None, "HIGH", "", None)],
        "id string, var_id string, gene_id string, impact string, triage string, pid string")
    meta = spark.createDataFrame([("s1", "male", 0.5, 2.0), ("s2", "female", 0.7, 3.1)], "id string, sex string, purity double, ploidy double")
    return CohortDataset.build(spark, {"somatic": som}, {"somatic": som.select("id", "var_id", "gene_id")}, meta, genes)


def test_subsets_keep_schema(ds):
    assert rows(ds.subset_ids(["s1"]).table("somatic"), "var_id") == [("v1",), ("v2",)]
    assert rows(ds.subset_rows([2]).meta, "id") == [("s2",)]
    g = ds.subset_genes(names=["BBB"])
    assert rows(g.table("somatic"), "var_id") == [("v3",)] and g.meta.count() == 2
    assert rows(ds.subset_genes(gene_ids=["G1"]).table("somatic"), "var_id") == [("v1",), ("v2",)]
    only = ds.keep_tables(["fusion"])
    assert only.table("somatic").count() == 0 and only.table("somatic").columns == ds.table("somatic").columns
    assert ds.subset("pid", ["p1"]).meta.count() == 2


def test_filter_keeps_null_and_keep(ds):
    out = T.filter_dataset(ds, {"somatic": "annotation|evidence"})
    assert rows(out.table("somatic"), "var_id") == [("v2",), ("v3",), ("v4",)]
    assert rows(out.map("somatic"), "var_id") == [("v2",), ("v3",), ("v4",)]


def test_triage_flags_names_and_order(ds):
    flags = {r["var_id"]: r for r in T.triage_flags(ds.table("somatic"), "somatic", ds.anno).collect()}
    assert flags["v1"]["phase"] and flags["v2"]["phase"] and not flags["v3"]["phase"]
    assert flags["v4"]["annotation"] and flags["v4"]["goi"] and not flags["v4"]["artifact"]
    assert flags["v3"]["artifact"] and flags["v2"]["consequence"]
    text = dict(rows(T.triage_table(ds.table("somatic"), "somatic", ds.anno), "var_id", "triage"))
    assert text["v1"].startswith("annotation;") and text["v1"].endswith("phase") and text["v3"].startswith("keep;evidence;")


def test_rule_set_override(spark, ds):
    mine = T.RuleSet("mine", {"somatic": {"custom": lambda: F.col("gene_id") == "G2"}}, T.DEFAULT)
    T.register_rule_set(mine)
    out = T.triage_dataset(ds, "mine", tables=["somatic"])
    assert "custom" in dict(rows(out.table("somatic"), "var_id", "triage"))["v3"]


def test_rescue_and_inject(spark, ds):
    dec = spark.createDataFrame([("s1", "v1", "keep", "somatic")], "id string, var_id string, triage string, table string")
    out = T.rescue(ds, dec)
    assert dict(rows(out.table("somatic"), "var_id", "triage"))["v1"] == "keep;annotation"
    with pytest.raises(ValueError):
        T.rescue(ds, dec.withColumn("var_id", F.lit("nope")))
    new = spark.createDataFrame([("s1", "v1", "G1"), ("s1", "v9", "G2")], "id string, var_id string, gene_id string")
    out = T.inject(ds, "somatic", new)
    got = dict(rows(out.table("somatic"), "var_id", "triage"))
    assert got["v1"] == "keep" and got["v9"] == "keep" and len(got) == 5
    assert ("v9", "G2") in rows(out.map("somatic"), "var_id", "gene_id")


def test_stack_versions_save_open_append(spark, ds, tmp_path):
    both = CohortDataset.stack([ds, ds.subset_ids(["s1"])])
    assert both.table("somatic").count() == 6
    with pytest.raises(ValueError):
        CohortDataset.stack([ds, ds.with_version("v2")])
    assert "ccf" not in ds.with_version("v2").table("somatic").columns
    ds.check_samples(2)
    with pytest.raises(ValueError):
        ds.check_samples(1)
    a, b, out = str(tmp_path / "a"), str(tmp_path / "b"), str(tmp_path / "out")
    ds.subset_ids(["s1"]).save(a, sample_buckets=4)
    ds.subset_ids(["s2"]).save(b)
    back = writers.stack_files(spark, [a, b], out)
    assert rows(back.table("somatic"), "id", "var_id") == rows(ds.table("somatic"), "id", "var_id")
    assert back.table("fusion").count() == 0


def test_build_from_reports(spark):
    genes = spark.createDataFrame([("G1", "AAA", "chr1", 1, 100, "+", True, True, True, False)], GENES)
    seg = spark.createDataFrame([("s1", "chr1", 1, 50, 1.0, 1.0, 1.1), ("s1", "chr1", 51, 200, 3.0, 1.0, 2.9)], "id string, chr string, start int, end int, C double, K double, sC double")
    fus = spark.createDataFrame([("s1", "chr1", 5, "+", "chr2", 9, "-", "G1:G7", "", "", "G8", "AAA:X", "", "", "Y")],
                                "id string, chr_5 string, pos_5 int, str_5 string, chr_3 string, pos_3 int, str_3 string, gene_ids_5_1 string, gene_ids_3_1 string, gene_ids_5_2 string, gene_ids_3_2 string, gene_names_5_1 string, gene_names_3_1 string, gene_names_5_2 string, gene_names_3_2 string")
    meta = spark.createDataFrame([("s1", "male")], "id string, sex string")
    out = build_dataset(spark, {"segment": seg, "fusion": fus}, genes, meta)
    assert rows(out.map("fusion"), "var_id", "end", "gene_id") == [("chr1:5:+::chr2:9:-", "f5", "G1"), ("chr1:5:+::chr2:9:-", "f5", "G7"), ("chr1:5:+::chr2:9:-", "r3", "G8")]
    r = out.table("gene_copy").collect()[0]
    assert (r["nseg"], r["Kmin"], r["Cmax"]) == (2, 0.0, 3.0)
    assert rows(out.map("segment"), "var_id") == [("chr1:1-50",), ("chr1:51-200",)]
    assert out.table("fusion").select("csqf5", "csqr3").collect()[0][:] == ("truncation", "truncation")


def test_text_readers(spark, tmp_path):
    (tmp_path / "s1").mkdir()
    (tmp_path / "s1" / "x.counts").write_text("# c\nGeneid\tChr\tStart\tEnd\tStrand\tLength\tbam\nG1\tc\t1\t2\t+\t100\t7\n")
    df = readers.read_gene_counts(spark, str(tmp_path / "*" / "*.counts"), r"/([^/]+)/x\.counts$")
    assert rows(df) == [("s1", "G1", 100, 7)]
    (tmp_path / "m.txt").write_text("## head\nA\tB\n1\t\n")
    assert rows(readers.read_metrics(spark, str(tmp_path / "m.txt"), r"/([^/]+)\.txt$")) == [("m", "A", "1"), ("m", "B", None)]
    (tmp_path / "c.bed").write_text("1\t0\t10\nchr2\t5\t6\n")
    assert rows(readers.read_ranges(spark, str(tmp_path / "c.bed"), names=""), "chr", "start", "end") == [("chr1", 1, 10), ("chr2", 6, 6)]
    found = readers.discover(spark, str(tmp_path), {"counts": ".counts", "bed": ".bed"})
    assert {r["role"] for r in found.collect()} == {"counts", "bed"}
    assert readers.require_one_per_role(found, ["counts", "bed"]).count() == 2


def test_incremental_stream_reads_new_files_once(spark, tmp_path):
    src, out, ck = (str(tmp_path / n) for n in ("src", "out", "ck"))
    schema = "id string, v int"
    one = spark.createDataFrame([("a", 1)], schema)
    one.write.parquet(src)
    INC.load_new_files(spark, src, one.schema, out, ck)
    spark.createDataFrame([("b", 2)], schema).write.mode("append").parquet(src)
    INC.load_new_files(spark, src, one.schema, out, ck)
    INC.load_new_files(spark, src, one.schema, out, ck)
    assert rows(spark.read.parquet(out)) == [("a", 1), ("b", 2)]


def test_groupings_and_append(spark, tmp_path):
    cols = ("a", "b")
    known = spark.createDataFrame([("x", "y")], "a string, b string")
    sheet = spark.createDataFrame([("x", "y"), ("x", None), ("x", None)], "a string, b string")
    assert rows(INC.new_groupings(sheet, known, cols), "a", "b") == [("x", None)]
    from cohortloom.schema import table_schema

    df = spark.createDataFrame([("s", "v", 3)], "id string, `var.id` string, other int")
    INC.append_rows(df, str(tmp_path / "t"), table_schema("somatic").add("runid", "long"), F.lit(4).cast("long"))
    got = spark.read.parquet(str(tmp_path / "t"))
    assert rows(got, "id", "var_id", "runid") == [("s", "v", 4)] and "other" not in got.columns
