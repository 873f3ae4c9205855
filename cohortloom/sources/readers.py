"""Readers.  One call reads the files of any number of samples; the sample comes from the file path."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cohortloom.functions.text import blank_to_null, clip_left, clip_right
from cohortloom.operators.genemodel import parse_gene_model
from cohortloom.schema import conform, empty


def sample_from_path(pattern: str) -> Column:
    """Sample id from the file path by the first group of a pattern."""
    return F.regexp_extract(F.col("_metadata.file_path"), pattern, 1)


def discover(spark: SparkSession, folder: str, suffixes: dict[str, str]) -> DataFrame:
    """(role, sample folder, path) of the result files below a folder, by file-name suffix.

    Only the listing is read (no contents); a role without files simply has no rows.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path", "length")
    role = None
    for name, suffix in suffixes.items():
        cond = F.col("path").endswith(suffix)
        role = F.when(cond, name) if role is None else role.when(cond, name)
    out = files.withColumn("role", role).filter(F.col("role").isNotNull())
    return out.withColumn("sample", F.element_at(F.split("path", "/"), -2))


def require_one_per_role(found: DataFrame, roles: Sequence[str]) -> DataFrame:
    """Samples that do not have exactly one file of every role, with the offending counts."""
    n = [F.count(F.when(F.col("role") == r, 1)).alias(r) for r in roles]
    bad = None
    for r in roles:
        bad = (F.col(r) != 1) if bad is None else bad | (F.col(r) != 1)
    return found.groupBy("sample").agg(*n).filter(bad)


def read_parquet_or_empty(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Typed report; a report that was not written is an empty table of the same shape."""
    try:
        return conform(spark.read.parquet(path), schema)
    except AnalysisException as err:
        if "PATH_NOT_FOUND" in str(err) or "UNABLE_TO_INFER_SCHEMA" in str(err):
            return empty(spark, schema)
        raise


def _tsv(spark: SparkSession, path, columns: str, header: bool = False, comment: str | None = "#") -> DataFrame:
    r = spark.read.option("sep", "\t").option("header", header).schema(columns)
    return (r.option("comment", comment) if comment else r).csv(path)


def read_gene_counts(spark: SparkSession, path, sample: str) -> DataFrame:
    """Read counts per gene: columns 1, 6 and 7 of the counting table."""
    t = _tsv(spark, path, "gene_id string, chr string, start string, end string, strand string, gene_length string, count string")
    t = t.select(sample_from_path(sample).alias("id"), "gene_id", F.col("gene_length").try_cast("int").alias("gene_length"), F.col("count").try_cast("bigint").alias("count"))
    return t.filter(F.col("gene_length").isNotNull())


def read_count_summary(spark: SparkSession, path, sample: str) -> DataFrame:
    """Assignment summary as (id, variable, read_pairs)."""
    t = _tsv(spark, path, "variable string, read_pairs string", comment=None)
    return t.select(sample_from_path(sample).alias("id"), "variable", F.col("read_pairs").try_cast("bigint").alias("read_pairs")).filter(F.col("read_pairs").isNotNull())


def parse_config(lines: DataFrame) -> DataFrame:
    """key=value lines to (variable, value); surrounding quotes are dropped."""
    kv = F.split("value", "=", 2)
    return lines.filter(F.col("value").contains("=")).select(*[c for c in lines.columns if c != "value"], F.trim(kv[0]).alias("variable"), F.regexp_replace(F.trim(kv[1]), "^['\"]|['\"]$", "").alias("value"))


def read_config(spark: SparkSession, path, sample: str) -> DataFrame:
    return parse_config(spark.read.text(path).withColumn("id", sample_from_path(sample)))


def grouping_from_id(name: Column) -> dict[str, Column]:
    """case-tumor.normal.rna to its parts."""
    case, rest = F.split(name, "-", 2)[0], F.split(name, "-", 2)[1]
    part = lambda i: F.try_element_at(F.split(rest, r"\."), F.lit(i))
    return {"case": case, "tumor_dna_sample": part(1), "normal_dna_sample": part(2), "tumor_rna_sample": part(3)}


def read_gene_model(spark: SparkSession, path, drop: Sequence[str] = ()) -> DataFrame:
    return parse_gene_model(spark.read.text(path), drop)


def read_ranges(spark: SparkSession, path, sizes: DataFrame | None = None, names: str = "name string, score double, strand string", stranded: bool = False) -> DataFrame:
    """Zero-based half-open ranges to closed one-based ones on the known sequences."""
    t = _tsv(spark, path, f"chr string, start bigint, end bigint{', ' + names if names else ''}")
    return shift_ranges(t, sizes, stranded)


def shift_ranges(t: DataFrame, sizes: DataFrame | None = None, stranded: bool = False) -> DataFrame:
    named = F.when(F.col("chr").startswith("chr"), F.col("chr")).when(F.col("chr") == "MT", "chrM").otherwise(F.concat(F.lit("chr"), "chr"))
    out = t.withColumn("chr", named).withColumn("start", F.col("start") + 1)
    if not stranded:
        out = out.withColumn("strand", F.lit("*"))
    return out.join(sizes.select("chr"), "chr", "left_semi") if sizes is not None else out


def parse_variant_lines(lines: DataFrame, samples: Sequence[str], info: dict[str, str], formats: dict[str, str], csq_fields: Sequence[str] = ()) -> DataFrame:
    """Variant-call text lines to columns.

    ``info`` and ``formats`` map a field to its Spark type (arrays split on commas, ``boolean`` is a
    flag).  FORMAT fields become one column per sample, ``<field>_<sample>``.  ``csq_fields`` names the
    bar-separated consequence entries, returned as an array of structs.
    """
    f = F.split("value", "\t")
    t = lines.filter(~F.col("value").startswith("#") & (F.length("value") > 0)).select(*[c for c in lines.columns if c != "value"], f.alias("__f"))
    at = lambda i: F.try_element_at(F.col("__f"), F.lit(i + 1))
    dot = lambda c: F.when(c != ".", c)

    def typed(c: Column, kind: str) -> Column:
        if kind.startswith("array<"):
            inner = kind[6:-1]
            return F.transform(F.split(c, ","), lambda v: F.when(v != ".", v).try_cast(inner))
        return c.try_cast(kind) if kind != "string" else c

    t = t.withColumn("__i", F.str_to_map(at(7), F.lit(";"), F.lit("=")))
    keys = F.split(at(8), ":")
    for k, s in enumerate(samples):
        t = t.withColumn(f"__s{k}", F.map_from_arrays(keys, F.transform(F.sequence(F.lit(1), F.size(keys)), lambda i: F.try_element_at(F.split(at(9 + k), ":"), i))))
    cols = [c for c in t.columns if not c.startswith("__")]
    sel = [*cols, at(0).alias("chr"), at(1).cast("bigint").alias("pos"), dot(at(2)).alias("name"), at(3).alias("ref"), at(4).alias("alt"), dot(at(5)).try_cast("double").alias("qual"), at(6).alias("filter")]
    for name, kind in info.items():
        raw = F.col("__i")[name]
        sel.append((F.array_contains(F.map_keys("__i"), name) if kind == "boolean" else typed(dot(raw), kind)).alias(name.lower()))
    for name, kind in formats.items():
        for k, s in enumerate(samples):
            sel.append(typed(dot(F.col(f"__s{k}")[name]), kind).alias(f"{name.lower()}_{s}"))
    if csq_fields:
        entry = lambda e: F.struct(*[F.get(F.split(e, r"\|"), F.lit(i)).alias(n.lower()) for i, n in enumerate(csq_fields)])
        sel.append(F.when(F.col("__i")["CSQ"].isNotNull(), F.transform(F.split(F.col("__i")["CSQ"], ","), entry)).alias("csq"))
    return t.select(*sel)


def read_variants(spark: SparkSession, path, sample: str, samples: Sequence[str], info: dict[str, str], formats: dict[str, str], csq_fields: Sequence[str] = (), sizes: DataFrame | None = None) -> DataFrame:
    out = parse_variant_lines(spark.read.text(path).withColumn("id", sample_from_path(sample)), samples, info, formats, csq_fields)
    return out.join(sizes.select("chr"), "chr", "left_semi") if sizes is not None else out


def snp_columns(v: DataFrame, source: str, population: str | None = None) -> DataFrame:
    """SNP table shape from parsed records: allele shares, depths, population fraction (0.5 when unknown)."""
    share = lambda s: F.try_element_at(f"ad_{s}", F.lit(2)) / F.nullif(F.col(f"dp_{s}").cast("double"), F.lit(0.0))
    pop = F.coalesce(F.aggregate(F.col(population), F.lit(0.0), lambda a, x: a + F.coalesce(x, F.lit(0.0))), F.lit(0.0)) if population else F.lit(0.5)
    cols = [share(s).alias(f"{s}_af") for s in ("t", "n") if f"ad_{s}" in v.columns]
    cols += [F.col(f"dp_{s}").alias(f"{s}_dp") for s in ("t", "n") if f"dp_{s}" in v.columns] + [F.col(f"gt_{s}").alias(f"{s}_gt") for s in ("t", "n") if f"gt_{s}" in v.columns]
    return v.select("id", "chr", "pos", "ref", "alt", "qual", F.lit(source).alias("source"), F.lit("SNV").alias("type"), F.lit(False).alias("somatic"), pop.alias("population_af"), *cols)


_JUNCTION = "chr_5 string, pos_5 bigint, str_5 string, chr_3 string, pos_3 bigint, str_3 string, type int, rep_5 int, rep_3 int, qname string, seg_5_pos bigint, seg_5_cig string, seg_3_pos bigint, seg_3_cig string"


def read_junction_records(spark: SparkSession, single, paired, sample: str) -> DataFrame:
    """Chimeric junction records of single and paired reads, with clip lengths."""
    one = lambda path, kind: _tsv(spark, path, _JUNCTION, comment=None).select(sample_from_path(sample).alias("id"), "*", F.lit(kind).alias("ftype"))
    return junction_clips(one(single, "se").unionByName(one(paired, "pe")))


def junction_clips(rec: DataFrame) -> DataFrame:
    return rec.withColumns({f"clp_{e}_{s}": (clip_left if s == "l" else clip_right)(F.col(f"seg_{e}_cig")) for e in ("5", "3") for s in ("l", "r")})


def alignment_tags(rows: DataFrame, keys: Sequence[str] = ("id",)) -> DataFrame:
    """Reads with exactly two hits, pivoted to their 5' and 3' alignment.

    ``rows``: qname, hit, as_tag, nm_tag, len (tags as ``AS:i:50``).  Overlap = AS + 2 NM.
    """
    n = lambda c: F.element_at(F.split(c, ":"), -1).cast("int")
    g = [*keys, "qname"]
    first = rows.groupBy(*g, "hit").agg(F.min(F.struct("ord", n("as_tag").alias("a"), n("nm_tag").alias("m"), "len")).alias("r"))
    two = first.groupBy(*g).agg(F.array_sort(F.collect_list(F.struct("hit", "r"))).alias("h")).filter(F.size("h") == 2)
    at = lambda i, f: F.col("h")[i]["r"][f]
    out = two.select(*g, *[at(i, f).alias(f"seg_{e}_{n_}") for i, e in ((0, "5"), (1, "3")) for f, n_ in (("a", "as"), ("m", "nm"), ("len", "len"))])
    for e in ("5", "3"):
        out = out.withColumn(f"ovr_{e}", (F.col(f"seg_{e}_as") + 2 * F.col(f"seg_{e}_nm")).cast("double"))
        out = out.withColumn(f"err_{e}", F.col(f"seg_{e}_nm") / F.nullif(F.col(f"ovr_{e}"), F.lit(0.0)))
    return out


def splice_junctions(rows: DataFrame, min_reads: int = 1) -> DataFrame:
    """Splice junctions with more than ``min_reads`` unique reads; strand codes 1 and 2 are + and -.

    ``rows``: chr, start, end, strand_code, motif, unique_reads.
    """
    strand = F.when(F.col("strand_code") == 1, "+").when(F.col("strand_code") == 2, "-").otherwise("*")
    keep = [c for c in ("sid", "id") if c in rows.columns]
    return rows.filter(F.col("unique_reads") > min_reads).select(*keep, "chr", "start", "end", strand.alias("strand"), F.col("unique_reads").alias("nfrag"), F.col("motif").isin(1, 2).alias("motif"))


def read_splice_junctions(spark: SparkSession, path, sample: str) -> DataFrame:
    t = _tsv(spark, path, "chr string, start bigint, end bigint, strand_code int, motif int, annotated int, unique_reads int, multi_reads int, overhang int", comment=None)
    return splice_junctions(t.withColumn("sid", sample_from_path(sample)))


def read_abundance(spark: SparkSession, path, sample: str) -> DataFrame:
    t = spark.read.option("sep", "\t").option("header", True).schema("target_id string, length int, eff_length double, est_counts double, tpm double").csv(path)
    return t.select(sample_from_path(sample).alias("id"), "target_id", "est_counts", "tpm")


def parse_metrics(lines: DataFrame, skip: str = "^#|^$", category: tuple[str, str] | None = None) -> DataFrame:
    """First data row under the header row of a metrics file, as (id, variable, value).

    ``lines``: id, ord, value.  The header is the first line that is not skipped; with ``category``
    (column, value) the row of that category is taken.  Metrics files hold a few lines.
    """
    body = lines.filter(~F.col("value").rlike(skip))
    rows = body.groupBy("id").agg(F.transform(F.array_sort(F.collect_list(F.struct("ord", "value"))), lambda e: F.split(e["value"], "\t")).alias("r"))
    head = F.col("r")[0]
    data = F.slice("r", 2, F.size("r"))
    if category:
        i = F.array_position(head, category[0])
        data = F.filter(data, lambda x: F.try_element_at(x, i.cast("int")) == category[1])
    one = rows.select("id", head.alias("h"), F.get(data, F.lit(0)).alias("d"))
    return one.select("id", F.explode(F.arrays_zip("h", "d")).alias("x")).select("id", F.col("x.h").alias("variable"), blank_to_null(F.col("x.d")).alias("value"))


def read_metrics(spark: SparkSession, path, sample: str, **kw) -> DataFrame:
    # Whole small files, so that the line order is known wherever they are read.
    t = spark.read.text(path, wholetext=True).select(sample_from_path(sample).alias("id"), F.posexplode(F.split("value", "\n")).alias("ord", "value"))
    return parse_metrics(t, **kw)


def read_lookup(spark: SparkSession, path, schema: str) -> DataFrame:
    """Small typed lookup table (transcript preferences, clinical tables)."""
    return spark.read.option("header", True).schema(schema).csv(path)
