"""Query registry and the role mapping of the test tables.

Genomic inputs do not exist among the test tables, so the tables play roles: orders and line items
are variants and segments of customers (the samples), parts are genes, and so on.  A role is a
list of plain SQL expressions that both engines understand; the operators themselves are written
twice, with the library on Spark and by hand as oracle SQL.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
          "pages", "benchmark", "labels", "conversations")

# A line item of an order; lines with equal numbers are told apart by part and supplier.
_LINES = "lineitem l join orders o on l.l_orderkey = o.o_orderkey"

VARIANT = {
    "id": "cast(o_custkey as string)",
    "var_id": "concat(l_orderkey, ':', l_linenumber, ':', l_partkey, ':', l_suppkey)",
    "chr": "concat('chr', l_linenumber)",
    "pos": "cast(l_orderkey * 1000 + l_suppkey % 1000 + 1 as bigint)",
    "ref": "substr('ACGTACGTAC', cast(cast(l_quantity as int) % 4 + 1 as int), case when l_tax >= 0.06 then 3 else 1 end)",
    "alt": "substr('GTACCATG', cast(l_suppkey % 5 + 1 as int), case when l_discount >= 0.09 then 2 else 1 end)",
    "gene_id": "concat('G', l_partkey)",
    "gene_name": "concat('N', l_partkey)",
    "transcript": "concat('T', l_partkey % 50)",
    "exon": "concat(l_linenumber, '/9')",
    "hgvsc": "concat('c.', l_suppkey, 'A>G')",
    "hgvsp": "case when l_partkey % 4 = 0 then null else concat('p.', case when l_partkey % 3 = 0 then 'Ala' when l_partkey % 3 = 1 then 'Trp' else 'Lys' end, l_suppkey, 'Val') end",
    "consequence": "case l_suppkey % 9 when 0 then 'missense_variant' when 1 then 'frameshift_variant' when 2 then 'stop_gained' when 3 then 'synonymous_variant' when 4 then '3_prime_UTR_variant' when 5 then 'inframe_deletion' when 6 then 'splice_donor_variant' when 7 then 'intron_variant' else 'upstream_gene_variant' end",
    "impact": "case l_suppkey % 4 when 0 then 'HIGH' when 1 then 'MODERATE' when 2 then 'LOW' else 'MODIFIER' end",
    "sift": "case when l_partkey % 5 = 0 then 'tolerated' end",
    "adt": "cast(l_quantity as double)",
    "dpt": "cast(l_quantity + l_partkey % 80 + 1 as double)",
    "aft": "cast(l_quantity as double) / cast(l_quantity + l_partkey % 80 + 1 as double)",
    "adn": "case when l_partkey % 6 = 0 then null else cast(l_suppkey % 4 as double) end",
    "dpn": "case when l_partkey % 6 = 0 then null else cast(60 + l_partkey % 90 as double) end",
    "afn": "case when l_partkey % 6 = 0 then null else cast(l_suppkey % 4 as double) / cast(60 + l_partkey % 90 as double) end",
    "adt_fwd": "cast(floor(l_quantity * (l_suppkey % 5) / 4) as int)",
    "adt_rev": "cast(l_quantity as int) - cast(floor(l_quantity * (l_suppkey % 5) / 4) as int)",
    "str": "l_returnflag = 'R'",
    "str_ru": "case when l_returnflag = 'R' then substr('ACGT', cast(l_suppkey % 4 + 1 as int), 1) end",
    "str_len": "cast(l_suppkey % 8 as int)",
    "tlod": "l_extendedprice / 2000",
    "nlod": "cast(l_partkey % 31 as double)",
    "flod": "cast(l_partkey % 13 as double)",
    "xfet": "l_tax",
    "sor": "l_discount * 40",
    "mqrs": "case when l_partkey % 7 = 0 then null else cast(l_suppkey % 9 as double) - 4 end",
    "mqs": "cast(20 + l_partkey % 12 as double)",
    "ecnt": "cast(l_linenumber as int)",
    "dbsnp": "case when l_partkey % 4 = 1 then cast(l_partkey as int) end",
    "clinid": "case when l_partkey % 8 = 3 then cast(l_partkey as int) end",
    "cosmic_cnt": "cast(l_partkey % 60 as int)",
    "clinvar": "case l_suppkey % 7 when 0 then 'Benign' when 1 then 'Pathogenic' when 2 then 'Likely_benign' when 3 then 'drug_response' when 4 then 'Uncertain' end",
    "gnomad_af": "l_discount / 5",
    "kg_af": "l_tax / 8",
    "pon": "case when l_partkey % 3 = 0 then 'seen' end",
    "rmsk_hit": "case when l_suppkey % 5 = 0 then 'LINE' end",
    "pid": "case when l_tax > 0.05 then concat('P', l_suppkey % 2) end",
    "nn": "cast(l_suppkey % 2 as int)",
    "ccf": "case when l_partkey % 2 = 0 then l_discount * 8 end",
}

SEGMENT = {
    "id": "cast(min(o_custkey) as string)",
    "var_id": "concat('chr', l_linenumber, ':', l_orderkey * 1000 + 1)",
    "chr": "concat('chr', l_linenumber)",
    "start": "cast(l_orderkey * 1000 + 1 as bigint)",
    "end": "cast(l_orderkey * 1000 + 300 + min(l_partkey) % 700 as bigint)",
    "width": "cast(300 + min(l_partkey) % 700 as bigint)",
    "strand": "'*'",
    "arm": "concat('chr', l_linenumber, case when l_orderkey % 40000 < 7000 then 'p' else 'q' end)",
    "seg": "cast(l_orderkey as bigint)",
    "C": "case when min(l_partkey) % 17 = 0 then null else cast(cast(sum(l_quantity) as bigint) % 6 as double) end",
    "K": "case when min(l_partkey) % 13 = 0 then null when cast(sum(l_quantity) as bigint) % 6 <= 1 then 0.0e0 else cast(min(l_suppkey) % 2 as double) end",
    "sC": "case when min(l_partkey) % 17 = 0 then null else cast(cast(sum(l_quantity) as bigint) % 6 as double) + cast(min(l_suppkey) % 3 as double) / 4 end",
    "lr": "cast(min(l_suppkey) % 9 as double) / 4 - 1",
    "nC": "case when l_linenumber = 7 then 1.0e0 else 2.0e0 end",
    "naf": "cast(count(*) * 4 as int)",
    "nlr": "cast(count(*) * 7 as int)",
}

GENE = {
    "gene_id": "concat('G', p_partkey)",
    "gene_name": "concat('N', p_partkey)",
    "chr": "concat('chr', p_partkey % 7 + 1)",
    "start": "cast(p_partkey * 5000 + 1 as bigint)",
    "end": "cast(p_partkey * 5000 + p_size * 200 as bigint)",
    "strand": "case when p_size % 3 = 0 then '*' when p_size % 3 = 1 then '+' else '-' end",
    "anno_goi": "p_size <= 40",
    "somatic_goi": "p_size <= 25",
    "germline_goi": "p_size between 10 and 30",
    "somatic_art": "p_brand in ('Brand#1', 'Brand#2')",
}

META = {
    "id": "cast(c_custkey as string)",
    "case_id": "concat('case', c_custkey % 100)",
    "cohort": "c_mktsegment",
    "sex": "case when c_nationkey % 2 = 0 then 'male' else 'female' end",
    "purity": "0.2e0 + cast(c_custkey % 70 as double) / 100",
    "ploidy": "1.5e0 + cast(c_custkey % 30 as double) / 10",
    "tumor_dna_sample": "case when c_custkey % 5 = 0 then null else concat('T', c_custkey) end",
    "tumor_rna_sample": "case when c_custkey % 3 = 0 then null else concat('R', c_custkey) end",
}

STRUCTURAL = {
    "id": "cast(o_custkey as string)",
    "var_id": "concat(l_orderkey, ':', l_linenumber, ':', l_partkey, ':', l_suppkey)",
    "bnd_id": "concat(l_orderkey, ':', l_linenumber)",
    "chr1": "concat('chr', l_linenumber)",
    "pos1": "cast(l_orderkey * 1000 + l_suppkey % 1000 + 1 as bigint)",
    "chr2": "concat('chr', l_partkey % 7 + 1)",
    "pos2": "cast(l_partkey * 5000 + cast(l_quantity as bigint) as bigint)",
    "bnd1": "case when l_returnflag = 'R' then '[' else ']' end",
    "bnd2": "case when l_linestatus = 'O' then '[' else ']' end",
    "qual": "l_extendedprice",
    "aft": "l_discount",
    "adt": "cast(l_quantity as double)",
    "dpt": "cast(l_quantity + 30 as double)",
    "caller_filter": "case when l_partkey % 3 = 0 then null when l_partkey % 3 = 1 then 'PASS' else 'LOW' end",
    "gene_id_1": "case when l_suppkey % 5 = 0 then null else concat('G', l_partkey) end",
    "gene_name_1": "case when l_suppkey % 5 = 0 then null else concat('N', l_partkey) end",
    "gene_id_2": "case when l_suppkey % 7 = 0 then null when l_suppkey % 3 = 0 then concat('G', l_partkey) else concat('G', l_suppkey) end",
    "gene_name_2": "case when l_suppkey % 7 = 0 then null when l_suppkey % 3 = 0 then concat('N', l_partkey) else concat('N', l_suppkey) end",
    "exon1": "case when l_tax < 0.04 then concat(l_linenumber, '/9') else '' end",
    "intron1": "case when l_tax >= 0.04 then concat(l_linenumber, '/8') else '' end",
    "exon2": "case when l_discount < 0.05 then concat(cast(l_quantity as int) % 9 + 1, '/9') else '' end",
    "intron2": "case when l_discount >= 0.05 and l_partkey % 4 <> 0 then concat(cast(l_quantity as int) % 8 + 1, '/8') else '' end",
    "strand1": "case when l_partkey % 2 = 0 then '+' when l_partkey % 5 = 0 then '*' else '-' end",
    "strand2": "case when l_suppkey % 2 = 0 then '+' when l_suppkey % 9 = 0 then '*' else '-' end",
}

# Read-level chimeric junctions: several line items share a breakpoint.
JUNCTION = {
    "id": "cast(o_custkey as string)",
    "sid": "cast(o_custkey % 20 as string)",
    "qname": "concat('r', l_orderkey, ':', l_linenumber, ':', l_partkey, ':', l_suppkey)",
    "type": "case when l_returnflag = 'N' then -1 when l_returnflag = 'A' then 1 else 0 end",
    "chr_5": "concat('chr', l_linenumber % 4 + 1)",
    "pos_5": "cast(l_partkey % 97 * 1000 + l_suppkey % 2 as bigint)",
    "str_5": "case when l_linestatus = 'O' then '+' else '-' end",
    "chr_3": "concat('chr', l_linenumber % 3 + 1)",
    "pos_3": "cast(l_suppkey % 89 * 1000 + l_partkey % 2 as bigint)",
    "str_3": "case when l_suppkey % 2 = 0 then '+' else '-' end",
    "ovr_5": "l_quantity", "ovr_3": "cast(l_partkey % 60 as double)",
    "err_5": "l_discount", "err_3": "l_tax",
    "low_5": "l_discount / 2", "low_3": "l_tax / 2",
    "seg_5_len": "cast(60 + l_suppkey % 40 as int)", "seg_3_len": "cast(60 + l_partkey % 40 as int)",
    "hq_jnc": "l_quantity > 20",
}

ROLES = {
    "variant": (VARIANT, _LINES, None),
    "segment": (SEGMENT, _LINES, "l_orderkey, l_linenumber"),
    "gene": (GENE, "part", None),
    "meta": (META, "customer", None),
    "structural": (STRUCTURAL, _LINES, None),
    "junction": (JUNCTION, _LINES, None),
    # Sequence lengths of the seven line numbers.
    "sizes": ({"chr": "concat('chr', l_linenumber)", "length": "cast(max(l_orderkey + 2) * 1000 as bigint)"}, "lineitem", "l_linenumber"),
    # Points on event-type axes, in seconds.
    "point": ({"chr": "event_type", "pos": "cast(floor(extract(epoch from ts)) as bigint) - 1704067200", "event_id": "event_id",
               "id": "cast(user_id as string)", "value": "value"}, "events", None),
    # Gene expression of a sample: summed quantities.
    "expression": ({"id": "cast(o_custkey as string)", "gene_id": "concat('G', l_partkey)", "count": "cast(sum(l_quantity) as bigint)"},
                   _LINES, "o_custkey, l_partkey"),
}
_SPARK_TEXT = {"extract(epoch from ts)": "unix_micros(cast(ts as timestamp)) / 1000000"}
_DUCK_TEXT = {"as string)": "as varchar)"}


def _swap(text: str, table: dict[str, str]) -> str:
    for a, b in table.items():
        text = text.replace(a, b)
    return text


def role_sql(name: str, quote: str) -> str:
    cols, source, group = ROLES[name]
    body = ", ".join(f"{e} as {quote}{c}{quote}" for c, e in cols.items())
    return f"select {body} from {source}" + (f" group by {group}" if group else "")


class Data:
    """The test tables of one folder and the roles built on them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def role(self, name: str) -> DataFrame:
        text = _swap(role_sql(name, "`"), _SPARK_TEXT)
        frames = {t: self.table(t) for t in TABLES if f" {t} " in f" {text} "}
        for t in frames:
            text = text.replace(f" {t} ", " {" + t + "} ") if f" {t} " in text else text.replace(f" {t}", " {" + t + "}")
        return self.spark.sql(text, **frames)

    def __getattr__(self, name: str) -> DataFrame:
        if name in ROLES:
            return self.role(name)
        if name in TABLES:
            return self.table(name)
        raise AttributeError(name)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, roles: tuple[str, ...] = ()):
    """Register a query: the function gets ``Data``; ``sql`` may use the named roles as tables."""

    def wrap(fun: Callable[[Data], DataFrame]):
        QUERIES[name] = lambda spark, folder: fun(Data(spark, folder))
        if sql is not None:
            body = sql.strip()
            ctes = ", ".join(f'"{r}" as ({_swap(role_sql(r, chr(34)), _DUCK_TEXT)})' for r in roles)
            if ctes:
                # A statement of its own WITH is joined to the role tables.
                head = next((h for h in ("with recursive ", "with ") if body.lower().startswith(h)), "")
                body = f"{head}{ctes}, {body[len(head):]}" if head else f"with {ctes} {body}"
            ORACLES[name] = body
        return fun

    return wrap
