"""Structural variants and fusion display: consequences, breakend pairing, topology, caller matching."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.functions import text as X
from cohortloom.operators.common import first_row, join_stats, later_wins
from cohortloom.operators.intervals import overlap_join

NO_TEXT = lambda: F.lit(None).cast("string")


# ---------------------------------------------------------------- consequences

def structural_consequence(df: DataFrame) -> DataFrame:
    """Consequence of each end and the exons it affects."""
    same, other = F.col("gene_id_1") == F.col("gene_id_2"), F.col("gene_id_1") != F.col("gene_id_2")
    fused = other & (F.col("end1") == "5p") & (F.col("end2") == "3p")

    def csq(n: str) -> Column:
        gene, end = F.col(f"gene_id_{n}").isNotNull(), F.col(f"end{n}")
        inner = [(same & (F.col("topo") == t), F.lit(f"internal-{t}")) for t in ("duplication", "deletion", "inversion")]
        return later_wins(
            [(gene & (end == "5p"), F.lit("truncation")), (gene & (end == "3p"), F.lit("start-loss")), *inner,
             (fused, F.lit("fusion5" if n == "1" else "fusion3"))], NO_TEXT())

    def number(c: str) -> Column:
        return F.when(F.contains(F.col(c), F.lit("/")), F.substring_index(c, "/", 1).try_cast("int"))

    text = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    intron1 = F.when(F.col("end1") == "5p", number("intron1") + 1).when(F.col("end1").isNotNull(), number("intron1"))
    # Internal events span from the first end to the second, so the second end counts its intron as is.
    b1, b2 = text(F.coalesce(number("exon1"), intron1)), text(F.coalesce(number("exon2"), number("intron2")))
    out = df.withColumns({"csq1": csq("1"), "csq2": csq("2"), "b1": b1, "b2": b2})
    span = (
        F.when(F.col("b1") == F.col("b2"), F.col("b1")).when(F.col("b1") == "", F.concat(F.lit("--"), "b2"))
        .when(F.col("b2") == "", F.concat("b1", F.lit("--")))
        .when(F.col("b1").try_cast("int") <= F.col("b2").try_cast("int"), F.concat("b1", F.lit("--"), "b2"))
    )
    out = out.withColumn("b12", span)
    inside = F.col("csq1").isin("internal-deletion", "internal-duplication")

    def exons(n: str) -> Column:
        c, b = F.col(f"csq{n}"), F.col(f"b{n}")
        return (
            F.when(inside, F.col("b12")).when(c.isin("truncation", "fusion5"), F.concat(b, F.lit("--")))
            .when(c.isin("start-loss", "fusion3"), F.concat(F.lit("--"), b))
        )

    return out.withColumns({"exons1": exons("1"), "exons2": exons("2")})


def fusion_consequence(df: DataFrame) -> DataFrame:
    """Consequence of the four sides from which of them lie in genes."""
    g = {e: F.col(f"gene_names_{e}") != "" for e in ("5_1", "3_1", "5_2", "3_2")}
    return df.withColumns({
        "csqf5": F.when(g["5_1"] & g["3_1"], "fusion5").when(g["5_1"] & ~g["3_1"], "truncation"),
        "csqf3": F.when(g["5_1"] & g["3_1"], "fusion3").when(~g["5_1"] & g["3_1"], "start-loss"),
        "csqr5": F.when(g["5_2"], "truncation"),
        "csqr3": F.when(g["3_2"], "truncation"),
    })


def represent_structural(df: DataFrame) -> DataFrame:
    c = lambda a, b: F.col(a).alias(b)
    return df.select(
        c("bnd_id", "var_id"), "chr1", "pos1", c("strand1", "str1"), "chr2", "pos2", c("strand2", "str2"), "aft", "adt", "dpt", "qual",
        c("caller_score", "score"), c("caller_filter", "filter"), c("gene_id_1", "gene_id1"), c("gene_id_2", "gene_id2"),
        c("topo", "topology"), "csq1", "csq2", "exons1", "exons2", "insert", c("caller_contig", "contig"),
    )


def represent_fusion(df: DataFrame) -> DataFrame:
    c = lambda a, b: F.col(a).alias(b)
    return df.select(
        "var_id", c("chr_5", "chr5"), c("pos_5", "pos5"), c("str_5", "str5"), c("chr_3", "chr3"), c("pos_3", "pos3"), c("str_3", "str3"),
        (F.col("sum_jnc") * (F.col("l1") == "spn").cast("int")).alias("spn_reads"), c("tot_enc", "enc_reads"), c("hq_bpt", "hq"),
        c("mm2_valid", "mm2"), c("gmap_valid", "gmap"), "gene_ids_5_1", "gene_ids_3_1", "gene_ids_5_2", "gene_ids_3_2",
        c("dst", "distance"), c("topo", "topology"), c("d2a", "spliced"), c("orf", "inframe"), c("sv_chain", "chain"), c("ctg_seq", "contig"),
    )


# ---------------------------------------------------------------- breakends

_BND = r"^(.*)([\[\]])(.*):(.*)([\[\]])(.*)$"


def parse_breakends(df: DataFrame) -> DataFrame:
    """Direction, partner position and inserted bases from the bracket notation of ALT."""
    part = lambda i: F.regexp_extract("alt", _BND, i)
    lead, tail = part(1), part(6)
    bnd1 = F.when(tail != "", "[").when(lead != "", "]")
    out = df.withColumns({
        "bnd1": bnd1, "chr2": X.blank_to_null(part(3)), "pos2": X.blank_to_null(part(4)).cast("bigint"), "bnd2": X.blank_to_null(part(5)),
    })
    insert = F.when(F.col("bnd1") == "]", F.substring(lead, F.lit(2), F.length(lead))).when(
        F.col("bnd1") == "[", F.substring(tail, F.lit(1), F.length(tail) - 1))
    return out.withColumn("insert", insert)


def pair_mates(df: DataFrame, order: str = "ord") -> DataFrame:
    """One row per breakend pair: the earlier record with its mate's id.

    ``df``: var_id, mate_id, chr1, pos1, alt, <order>.  Records whose mate is absent are dropped.
    """
    parsed = parse_breakends(df).withColumnRenamed("var_id", "id1").withColumnRenamed("mate_id", "id2")
    mates = df.select(F.col("var_id").alias("id2"), F.col(order).alias("__mate_ord"))
    both = parsed.join(mates, "id2").dropna(subset=["chr1", "pos1", "bnd1", "chr2", "pos2", "bnd2", "id1", "id2"])
    both = both.withColumn("bnd_id", F.concat_ws(":", F.least("id1", "id2"), F.greatest("id1", "id2")))
    one = first_row(both, ["bnd_id"], [F.col(order).asc(), F.col("id1").asc()])
    near = (F.col("chr1") == F.col("chr2")) & (F.abs(F.col("pos1") - F.col("pos2")) < 1_000_000)
    return one.withColumn("proximal", near).drop("__mate_ord")


def sv_topology(df: DataFrame) -> DataFrame:
    """Topology and gene end of each side from bracket direction and transcript strand."""
    same = F.col("chr1") == F.col("chr2")
    b1, b2 = F.col("bnd1"), F.col("bnd2")
    topo = (
        F.when(~same, "translocation").when((b1 == "]") & (b2 == "["), "deletion").when((b1 == "[") & (b2 == "]"), "duplication").otherwise("inversion")
    )

    def end(n: str) -> Column:
        b, s = F.col(f"bnd{n}"), F.coalesce(F.col(f"strand{n}"), F.lit("*"))
        return F.when(((b == "]") & (s == "+")) | ((b == "[") & (s == "-")), "5p").when(((b == "[") & (s == "+")) | ((b == "]") & (s == "-")), "3p")

    return df.withColumns({"topo": topo, "end1": end("1"), "end2": end("2"), "strand1": F.coalesce("strand1", F.lit("*")), "strand2": F.coalesce("strand2", F.lit("*"))})


def orient_pairs(df: DataFrame, symbol: str = "gene_name") -> DataFrame:
    """Put the 5' partner first by swapping all columns of the two ends where needed."""
    same = F.col(f"{symbol}_1") == F.col(f"{symbol}_2")
    e1, e2 = F.col("end1"), F.col("end2")
    false = F.lit(False)
    flip = (
        F.when(F.coalesce(same & (F.col("strand1") == "-"), false), True).when(F.coalesce(same & (F.col("strand1") == "+"), false), False)
        .when(F.coalesce((e1 == "3p") & (e2 == "5p"), false), True).when(F.coalesce(e2.isNull() & (e1 == "3p"), false), True)
        .when(F.coalesce(e1.isNull() & (e2 == "5p"), false), True).otherwise(False)
    )
    names = set(df.columns)
    pairs = []
    for c in df.columns:
        if c.endswith("1"):
            partner = c[:-1] + "2"
            if partner in names:
                pairs.append((c, partner))
    out = df.withColumn("__flip", flip)
    swapped = {}
    for a, b in pairs:
        swapped[a] = F.when(F.col("__flip"), F.col(b)).otherwise(F.col(a))
        swapped[b] = F.when(F.col("__flip"), F.col(a)).otherwise(F.col(b))
    return out.select(*[swapped.get(c, F.col(c)).alias(c) for c in df.columns])


def mate_table(df: DataFrame, order: str = "ord") -> DataFrame:
    """Two-ended table of a caller's records: mates joined, single records as they are.

    ``df``: var_id, mate_id, chr, pos, alt, type, qual, filter, end, ord and read counts
    ref_split/alt_split (+ ref_pair/alt_pair); reads of both mates are summed when the caller
    reports them per breakend.
    """
    a = df.filter(F.col("mate_id").isNotNull())
    b = df.select(F.col("var_id").alias("mate_id"), F.col("chr").alias("chr2"), F.col("pos").alias("pos2"), F.col("alt").alias("alt2"),
                  F.col("ref_split").alias("__r2"), F.col("alt_split").alias("__a2"))
    j = a.join(b, "mate_id").withColumn("pair_id", F.concat_ws(":", F.least("var_id", "mate_id"), F.greatest("var_id", "mate_id")))
    j = first_row(j, ["pair_id"], [F.col(order).asc(), F.col("var_id").asc()])
    cols = lambda d, i, p1, a1, c2, p2, a2: d.select(
        i.alias("pair_id"), F.col("chr").alias("chr1"), F.col("pos").alias("pos1"), a1.alias("alt1"), c2.alias("chr2"), p2.alias("pos2"), a2.alias("alt2"),
        "type", "qual", "filter", F.col("ref_split").alias("ref_reads"), F.col("alt_split").alias("alt_reads"))
    mated = j.withColumn("ref_split", F.col("ref_split") + F.col("__r2")).withColumn("alt_split", F.col("alt_split") + F.col("__a2"))
    mated = cols(mated, F.col("pair_id"), None, F.col("alt"), F.col("chr2"), F.col("pos2"), F.col("alt2"))
    single = df.filter(F.col("mate_id").isNull() & F.col("end").isNotNull())
    single = cols(single, F.col("var_id"), None, F.lit("-"), F.col("chr"), F.col("end"), F.lit("-"))
    return mated.unionByName(single)


def match_callers(a: DataFrame, b: DataFrame, *, key: Sequence[str], payload: Sequence[str], maxgap: int = 100, size_margin: float = 0.5) -> DataFrame:
    """Copy a second caller's fields to the breakpoints it also reports.

    Both: chr1,pos1,strand1,chr2,pos2,strand2.  A match has both ends within ``maxgap`` on equal
    strands and similar size; of several the closest counts.
    """
    q = a.withColumn("chr", F.col("chr1")).withColumn("__p", F.col("pos1"))
    r = b.withColumn("chr", F.col("chr1")).select("chr", "pos1", "strand1", "chr2", "pos2", "strand2", *payload)
    hit = overlap_join(q, r, q=("__p", "__p"), s=("pos1", "pos1"), maxgap=maxgap)
    d2 = F.abs(F.col("pos2") - F.col("s_pos2"))
    size_a, size_b = F.abs(F.col("pos1") - F.col("pos2")), F.abs(F.col("s_pos1") - F.col("s_pos2"))
    similar = (F.col("chr1") != F.col("chr2")) | (F.abs(size_a - size_b) - 1 < size_margin * F.least(size_a, size_b))
    hit = hit.filter(
        (F.col("chr2") == F.col("s_chr2")) & (d2 <= maxgap + 1) & (F.col("strand1") == F.col("s_strand1")) & (F.col("strand2") == F.col("s_strand2")) & similar)
    best = first_row(hit, list(key), [(F.abs(F.col("pos1") - F.col("s_pos1")) + d2).asc(), *[F.col(f"s_{c}").asc() for c in payload]])
    return join_stats(a, best.select(*key, *[F.col(f"s_{c}").alias(f"caller_{c}") for c in payload]), list(key))


def read_support(split_t: Column, pair_t: Column, split_n: Column, pair_n: Column) -> Column:
    """Eight read counts (alt and ref of split and paired reads, tumor then normal); absent pairs are 0."""
    two = lambda c: [F.coalesce(F.try_element_at(c, F.lit(i)), F.lit(0)).cast("string") for i in (2, 1)]
    return F.concat_ws(",", *two(split_t), *two(pair_t), *two(split_n), *two(pair_n))


# ---------------------------------------------------------------- annotation and display

def annotate_structural(df: DataFrame) -> DataFrame:
    """(gene, annotation, type-gene) of both ends; the partner text names the gene itself."""
    ends = F.array(*[F.struct(F.col(f"gene_id_{n}").alias("gene_id"), F.col(f"gene_name_{n}").alias("gene_name"), F.col(f"csq{n}").alias("annotation")) for n in "12"])
    rows = df.select("id", F.inline(ends)).filter(F.col("gene_id").isNotNull())
    kind = F.when(F.col("annotation").isin("fusion3", "fusion5"), F.col("annotation")).otherwise("structural")
    return rows.withColumn("type_partner_gene", F.concat_ws("-", kind, "gene_id")).withColumn("type_partner_symbol", F.concat_ws("-", kind, "gene_name")).distinct()


def annotate_fusions(df: DataFrame) -> DataFrame:
    """(gene, annotation, type-partner) of the four sides; a blank gene shows its cytoband if the partner has a gene."""
    partner = {"5_1": "3_1", "3_1": "5_1", "5_2": "3_2", "3_2": "5_2"}
    csq = {"5_1": "csqf5", "3_1": "csqf3", "5_2": "csqr5", "3_2": "csqr3"}

    def shown(what: str, e: str) -> Column:
        own, other = F.col(f"{what}_{e}"), F.col(f"{what}_{partner[e]}")
        return F.when((own == "") & (other != ""), F.col(f"cyt_{e}")).otherwise(own)

    def side(e: str) -> Column:
        c = F.col(csq[e])
        kind = F.when(c.isin("fusion3", "fusion5"), c).otherwise("structural")
        label = lambda what: F.concat_ws("-", kind, shown(what, partner[e]))
        return F.struct(
            shown("gene_ids", e).alias("ids"), shown("gene_names", e).alias("names"), c.alias("annotation"),
            label("gene_ids").alias("type_partner_gene"), label("gene_names").alias("type_partner_symbol"))

    rows = df.select("id", F.inline(F.array(*[side(e) for e in partner]))).filter(F.col("annotation").isNotNull())
    both = F.arrays_zip(F.split("ids", ":").alias("gene_id"), F.split("names", ":").alias("gene_name"))
    return rows.withColumn("__g", F.explode(both)).select(
        "id", F.col("__g.gene_id").alias("gene_id"), F.col("__g.gene_name").alias("gene_name"), "annotation", "type_partner_gene", "type_partner_symbol").distinct()


def segment_event(c: Column, k: Column) -> Column:
    """Unknown / Gain / Loss / Hom. Deletion / LOH / Neutral."""
    cc, kk = F.coalesce(c, F.lit(-1.0)), F.coalesce(k, F.lit(-1.0))
    return later_wins([
        ((kk == -1) | (cc == -1), F.lit("Unknown")), (cc > 2, F.lit("Gain")), (cc < 2, F.lit("Loss")), (cc == 0, F.lit("Hom. Deletion")),
        ((cc >= 2) & (kk == 0), F.lit("LOH")),
    ], F.lit("Neutral"))


def sv_names(df: DataFrame) -> DataFrame:
    """Gene name of each end, or its position."""
    where = lambda n: F.concat_ws(":", f"chr{n}", F.col(f"pos{n}").cast("string"))
    return df.withColumns({f"gene_name_{n}": F.coalesce(f"gene_name_{n}", where(n)) for n in "12"})


def fusion_names(df: DataFrame) -> DataFrame:
    """Partner names with fall-back to the other strand's gene, then the cytobands."""
    pick = lambda e: F.coalesce(*[F.nullif(F.col(c), F.lit("")) for c in (f"gene_names_{e}_1", f"gene_names_{e}_2", f"cyt_{e}_1", f"cyt_{e}_2")], F.lit(""))
    where = lambda e: F.concat_ws(":", f"chr_{e}", F.col(f"pos_{e}").cast("string"))
    return df.withColumns({"gene_names_5_1": pick("5"), "gene_names_3_1": pick("3"), "pos_5": where("5"), "pos_3": where("3")})


def _side_label(own: str, opposite: str, band: str) -> Column:
    first = lambda c: F.regexp_extract(c, "^[^:]*", 0)
    return F.when(F.col(own) != "", first(own)).when(F.col(opposite) != "", F.concat(F.lit("("), first(opposite), F.lit(")"))).otherwise(F.col(band))


def format_fusions(df: DataFrame, yes: str = "yes", chain: str = "sv_chain") -> DataFrame:
    """Display form of fusion calls: labels, junction texts, read totals and fractions."""
    junction = lambda e: F.concat_ws(":", f"chr_{e}", F.col(f"pos_{e}").cast("string"), f"str_{e}")
    flag = lambda c: F.when(F.col(c), yes).otherwise("")
    share = lambda e: F.format_string("%.2f", F.col("sum_jnc") / F.nullif(F.col(f"tot_jnc_{e}") + F.col(f"tot_sp_jnc_{e}"), F.lit(0)))
    return df.select(
        "id", "triage", "var_id", _side_label("gene_names_5_1", "gene_names_3_2", "cyt_5_1").alias("gene_5"), junction("5").alias("junction_5"),
        _side_label("gene_names_3_1", "gene_names_5_2", "cyt_3_1").alias("gene_3"), junction("3").alias("junction_3"),
        (F.col("sum_jnc") * (F.col("l1") == "spn").cast("int")).alias("spanning_reads"), F.col("tot_enc").alias("encompassing_reads"),
        (F.col("tot_jnc") + F.col("tot_enc")).alias("total_reads"), F.col("sum_bpt").alias("breakpoints"), flag("d2a").alias("spliced"),
        flag("hq_bpt").alias("hq"), flag("ts_warn").alias("ts"), flag("orf").alias("inframe"), F.col("dst").alias("distance"),
        F.col("topo").alias("topology"), flag("mm2_valid").alias("mm2_valid"), flag("gmap_valid").alias("gmap_valid"), share("5").alias("read_fraction_5"),
        share("3").alias("read_fraction_3"), F.concat_ws(";", F.col("unq_rec_5").cast("string"), F.col("unq_rec_3").cast("string")).alias("recurrent"),
        F.concat_ws(";", "art_5", "art_3").alias("repetitive"), F.col(chain).alias("chain"),
    )
