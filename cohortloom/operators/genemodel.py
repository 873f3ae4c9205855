"""Gene models: cleaning, typed features, frames, transcript coordinates, loci, homopolymers, batches."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.functions.text import gtf_attribute, reverse_complement
from cohortloom.operators.common import first_row, grid, join_stats, scan
from cohortloom.operators.intervals import gaps, largest_overlap, merge_ranges, overlap_join, without_overlap
from cohortloom.session import cut_lineage

#: fixed values: gene names that look like read-throughs but are not, and gene classes.
_NOT_READTHROUGH = "RP11-|MT-|HLA-"
_READTHROUGH = ".*[A-Z].*-.*[A-Z].*"
_IMMUNE = "IG_[CVDJ]_gene|TR_[CVDJ]_gene"


def parse_gene_model(lines: DataFrame, drop: Sequence[str] = ()) -> DataFrame:
    """Gene-model lines (nine tab columns in ``value``) to columns; a missing gene name is the gene id."""
    f = F.split("value", "\t")
    at = F.col("__f").getItem(8)
    out = lines.filter(~F.col("value").startswith("#") & (F.length("value") > 0)).withColumn("__f", f)
    name = lambda a: gtf_attribute(at, a)
    out = out.select(
        F.col("__f")[0].alias("chr"), F.col("__f")[1].alias("source"), F.col("__f")[2].alias("type"), F.col("__f")[3].cast("bigint").alias("start"),
        F.col("__f")[4].cast("bigint").alias("end"), F.col("__f")[6].alias("strand"), name("gene_id").alias("gene_id"), name("gene_name").alias("__gn"),
        name("gene_biotype").alias("gene_biotype"), name("transcript_id").alias("transcript_id"), name("transcript_biotype").alias("transcript_biotype"),
        name("exon_number").try_cast("int").alias("exon_number"), name("tags").alias("tags"))
    out = out.withColumn("gene_name", F.when(F.col("__gn") == "", F.col("gene_id")).otherwise(F.col("__gn"))).drop("__gn")
    return out.filter(~F.col("chr").isin(list(drop))) if drop else out


def gene_annotation(model: DataFrame, anno_goi: Sequence[str], somatic_goi: Sequence[str], germline_goi: Sequence[str], somatic_art: Sequence[str]) -> DataFrame:
    """Gene rows with membership flags of four gene-name lists."""
    flag = lambda names: F.col("gene_name").isin(list(names)) if names else F.lit(False)
    return model.filter(F.col("type") == "gene").select(
        "chr", "start", "end", "strand", "gene_id", "gene_name", flag(anno_goi).alias("anno_goi"), flag(somatic_goi).alias("somatic_goi"),
        flag(germline_goi).alias("germline_goi"), flag(somatic_art).alias("somatic_art"))


def clean_gene_model(model: DataFrame, immune: bool = True) -> DataFrame:
    """Coding transcripts of coding genes without read-throughs; non-coding and immune transcripts only
    where no coding one overlaps; gene rows rebuilt from what is left."""
    tx = model.filter(F.col("type") == "transcript")
    gn, gb, tb = F.col("gene_name"), F.col("gene_biotype"), F.col("transcript_biotype")
    coding = (gb == "protein_coding") & (tb == "protein_coding") & ~gn.contains(".") & (~gn.rlike(_READTHROUGH) | gn.rlike(_NOT_READTHROUGH))
    novel = gb.rlike("pseudogene|lincRNA") | ((gb == "protein_coding") & gn.contains("."))
    prot = tx.filter(coding)
    rest = tx.filter(novel & ~coding)
    if immune:
        rest = rest.unionByName(tx.filter(tb.rlike(_IMMUNE) & ~coding & ~novel))
    # Stranded: each strand is its own axis.
    free = without_overlap(rest, prot, keys=("chr", "strand"))
    kept = prot.select("transcript_id").unionByName(free.select("transcript_id")).distinct()
    body = model.filter(F.col("transcript_id") != "").join(kept, "transcript_id", "left_semi")
    spans = body.groupBy("gene_id").agg(F.min("start").alias("__s"), F.max("end").alias("__e"))
    genes = model.filter(F.col("type") == "gene").join(spans, "gene_id").withColumn("start", F.col("__s")).withColumn("end", F.col("__e")).drop("__s", "__e")
    return genes.unionByName(body)


# ---------------------------------------------------------------- features and frames

#: fixed values: precedence of feature types where several overlap.
FEATURE_ORDER = {"D": 0, "A": 0, "C": 1, "3": 2, "5": 3, "E": 4, "I": 5, "T": 6, "G": 7, ".": 8}


def _rank(c: Column) -> Column:
    return F.create_map(*[F.lit(x) for kv in FEATURE_ORDER.items() for x in kv])[c]


def introns(exons: DataFrame) -> DataFrame:
    """Ranges between consecutive exons of a transcript (exons per transcript are few)."""
    w = Window.partitionBy("transcript_id").orderBy("start")
    out = exons.withColumn("__n", F.lead("start").over(w)).filter(F.col("__n").isNotNull())
    return out.select("chr", (F.col("end") + 1).alias("start"), (F.col("__n") - 1).alias("end"), "strand", "transcript_id").filter(F.col("start") <= F.col("end"))


def typed_features(model: DataFrame, sizes: DataFrame) -> DataFrame:
    """Splice sites, coding parts, UTRs, exons, introns, transcripts, genes and the whole sequence, typed and ranked."""
    of = lambda t: model.filter(F.col("type") == t).select("chr", "start", "end", "strand", F.col("transcript_id" if t != "gene" else "gene_id").alias("owner"))
    exons = model.filter(F.col("type") == "exon")
    ins = introns(exons)
    plus = F.col("strand") == "+"
    left = ins.select("chr", "start", F.col("start").alias("end"), "strand", F.col("transcript_id").alias("owner"), F.when(plus, "D").otherwise("A").alias("type"))
    right = ins.select("chr", F.col("end").alias("start"), "end", "strand", F.col("transcript_id").alias("owner"), F.when(plus, "A").otherwise("D").alias("type"))
    tag = lambda df, t: df.withColumn("type", F.lit(t))
    whole = sizes.select("chr", F.lit(1).cast("bigint").alias("start"), F.col("length").cast("bigint").alias("end"), F.lit("*").alias("strand"), F.col("chr").alias("owner"))
    parts = [left, right, tag(of("CDS"), "C"), tag(of("three_prime_utr"), "3"), tag(of("five_prime_utr"), "5"), tag(of("exon"), "E"),
             tag(ins.select("chr", "start", "end", "strand", F.col("transcript_id").alias("owner")), "I"), tag(of("transcript"), "T"), tag(of("gene"), "G"), tag(whole, ".")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("ord", _rank(F.col("type")))


def coding_frames(cds: DataFrame) -> DataFrame:
    """Reading frame just outside each coding exon edge: donor sites after it, acceptor sites before it."""
    n = F.col("end") - F.col("start") + 1
    forward = F.when(F.col("strand") == "-", -F.col("start")).otherwise(F.col("start"))
    w = Window.partitionBy("transcript_id").orderBy(forward)
    c = cds.withColumn("__c", F.sum(n).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    d_frame = F.pmod(F.col("__c"), F.lit(3))
    first = F.pmod(F.col("__c") - n + 1, F.lit(3))
    a_frame = F.when(first == 0, 3).otherwise(first) - 1
    plus = F.col("strand") == "+"
    after, before = F.when(plus, F.col("end") + 1).otherwise(F.col("start") - 1), F.when(plus, F.col("start") - 1).otherwise(F.col("end") + 1)
    cell = lambda p, fr, t: F.struct(p.alias("start"), fr.cast("int").alias("frame"), F.lit(t).alias("type"))
    return c.select("chr", "strand", F.inline(F.array(cell(after, d_frame, "D"), cell(before, a_frame, "A")))).withColumn("end", F.col("start")).distinct()


# ---------------------------------------------------------------- transcript coordinates

def exon_offsets(exons: DataFrame) -> DataFrame:
    """Bases of the transcript before each exon, in reading direction."""
    n = F.col("end") - F.col("start") + 1
    forward = F.when(F.col("strand") == "-", -F.col("start")).otherwise(F.col("start"))
    w = Window.partitionBy("transcript_id").orderBy(forward).rowsBetween(Window.unboundedPreceding, -1)
    return exons.withColumn("offset", F.coalesce(F.sum(n).over(w), F.lit(0)))


def to_transcript(points: DataFrame, exons: DataFrame, key: Sequence[str], pos: str = "pos") -> DataFrame:
    """(key, transcript, tx_pos) of genome positions inside exons, whatever the strand."""
    e = exon_offsets(exons).select("chr", "start", "end", "strand", "transcript_id", "offset")
    q = points.select(*key, *[c for c in ("chr", pos) if c not in key])
    hit = overlap_join(q, e, q=(pos, pos))
    inside = F.when(F.col("s_strand") == "-", F.col("s_end") - F.col(pos)).otherwise(F.col(pos) - F.col("s_start")) + 1
    return hit.select(*key, F.col("s_transcript_id").alias("transcript_id"), (F.col("s_offset") + inside).alias("tx_pos"))


def coding_bounds(cds: DataFrame, exons: DataFrame) -> DataFrame:
    """First and last coding base in transcript coordinates (1 and 0 for non-coding transcripts)."""
    ends = cds.groupBy("transcript_id", "chr", "strand").agg(F.min("start").alias("a"), F.max("end").alias("b"))
    minus = F.col("strand") == "-"
    pts = ends.select("transcript_id", "chr", F.inline(F.array(
        F.struct(F.lit("cds1").alias("which"), F.when(minus, F.col("b")).otherwise(F.col("a")).alias("pos")),
        F.struct(F.lit("cdsn").alias("which"), F.when(minus, F.col("a")).otherwise(F.col("b")).alias("pos")))))
    e = exon_offsets(exons)
    j = pts.join(e.select("transcript_id", "start", "end", "strand", "offset"), "transcript_id").filter(F.col("pos").between(F.col("start"), F.col("end")))
    tx = F.col("offset") + F.when(F.col("strand") == "-", F.col("end") - F.col("pos")).otherwise(F.col("pos") - F.col("start")) + 1
    b = j.groupBy("transcript_id").agg(F.max(F.when(F.col("which") == "cds1", tx)).alias("cds1"), F.max(F.when(F.col("which") == "cdsn", tx)).alias("cdsn"))
    return exons.select("transcript_id").distinct().join(b, "transcript_id", "left").fillna({"cds1": 1, "cdsn": 0})


def transcript_sequences(exons: DataFrame) -> DataFrame:
    """Exon sequences (plus strand) joined in reading direction."""
    minus = F.col("strand") == "-"
    seq = F.when(minus, reverse_complement(F.col("seq"))).otherwise(F.col("seq"))
    order = F.when(minus, -F.col("start")).otherwise(F.col("start"))
    parts = F.array_sort(F.collect_list(F.struct(order.alias("o"), seq.alias("s"))))
    return exons.groupBy("transcript_id").agg(F.array_join(F.transform(parts, lambda p: p["s"]), "").alias("seq"))


# ---------------------------------------------------------------- loci

def make_loci(genes: DataFrame, sizes: DataFrame) -> DataFrame:
    """Stranded merge of genes plus the gaps between them, named by place, with a genic flag."""
    keys = ["chr", "strand"]
    g = genes.filter(F.col("strand").isin("+", "-"))
    body = merge_ranges(g, keys).withColumn("genic", F.lit(True))
    strands = sizes.withColumn("strand", F.explode(F.array(F.lit("+"), F.lit("-"))))
    hole = gaps(g, strands, keys).withColumn("genic", F.lit(False))
    out = body.select(*keys, F.col("start").cast("bigint").alias("start"), F.col("end").cast("bigint").alias("end"), "genic").unionByName(hole.select(*keys, "start", "end", "genic"))
    return out.withColumn("locus_id", F.concat_ws(":", "chr", F.col("start").cast("string"), "strand"))


def locus_genes(loci: DataFrame, genes: DataFrame) -> DataFrame:
    """Gene ids and names of each locus, joined by colons."""
    hit = overlap_join(genes.select("chr", "start", "end", "strand", "gene_id", "gene_name"), loci.select("chr", "start", "end", "strand", "locus_id"), strand="strand")
    rows = F.array_sort(F.collect_set(F.struct("gene_id", "gene_name")))
    return hit.groupBy(F.col("s_locus_id").alias("locus_id")).agg(rows.alias("__g")).select(
        "locus_id", F.array_join("__g.gene_id", ":").alias("gene_ids"), F.array_join("__g.gene_name", ":").alias("gene_names"))


def locus_cytobands(loci: DataFrame, cytobands: DataFrame) -> DataFrame:
    hit = largest_overlap(loci.select("chr", "start", "end", "locus_id"), cytobands.select("chr", "start", "end", "name"), ["locus_id"], ["start"])
    return hit.select("locus_id", F.concat_ws("_", "chr", "s_name").alias("cytoband"), F.substring("s_name", 1, 1).alias("arm"))


def overlapping_loci(loci: DataFrame) -> DataFrame:
    """Pairs of different loci sharing bases on either strand."""
    l = loci.select("chr", "start", "end", "locus_id")
    return overlap_join(l, l).filter(F.col("locus_id") != F.col("s_locus_id")).select(F.col("locus_id").alias("locus_a"), F.col("s_locus_id").alias("locus_b"))


def adjacent_loci(loci: DataFrame) -> DataFrame:
    """Pairs of different loci on one strand that touch or overlap."""
    l = loci.select("chr", "start", "end", "strand", "locus_id")
    return overlap_join(l, l, keys=("chr", "strand"), maxgap=0).filter(F.col("locus_id") != F.col("s_locus_id")).select(
        F.col("locus_id").alias("locus_a"), F.col("s_locus_id").alias("locus_b"))


# ---------------------------------------------------------------- sequences and batches

def sequence_chunks(bases: DataFrame, width: int) -> DataFrame:
    """(chr, chunk, seq) text chunks from a (chr, pos, base) table."""
    c = F.floor((F.col("pos") - 1) / width).cast("bigint")
    part = F.array_sort(F.collect_list(F.struct("pos", "base")))
    return bases.groupBy("chr", c.alias("chunk")).agg(F.array_join(F.transform(part, lambda e: e["base"]), "").alias("seq"))


def with_reach(chunks: DataFrame, reach: int) -> DataFrame:
    """Append the first ``reach`` bases of the next chunk, so windows never miss bases at an edge.

    Chunks must be at least ``reach`` long.
    """
    nxt = chunks.select("chr", (F.col("chunk") - 1).alias("chunk"), F.substring("seq", 1, reach).alias("__n"))
    return chunks.join(nxt, ["chr", "chunk"], "left").withColumn("seq", F.concat("seq", F.coalesce("__n", F.lit("")))).drop("__n")


def window_sequence(points: DataFrame, chunks: DataFrame, width: int, flank: int, strand: str | None = None, out: str = "motif") -> DataFrame:
    """Bases from pos-flank to pos+flank, read on the given strand.  ``chunks`` must reach 2*flank further."""
    first = F.col("pos") - flank
    q = points.withColumn("__k", F.floor((first - 1) / width).cast("bigint"))
    c = chunks.select("chr", F.col("chunk").alias("__k"), F.col("seq").alias("__s"))
    j = q.join(c, ["chr", "__k"], "left")
    at = (first - F.col("__k") * width).cast("int")
    seq = F.substring(F.col("__s"), at, F.lit(2 * flank + 1))
    if strand:
        seq = F.when(F.col(strand) == "-", reverse_complement(seq)).otherwise(seq)
    return j.withColumn(out, seq).drop("__k", "__s")


def homopolymers(chunks: DataFrame, width: int, bases: str = "ACGT", min_length: int = 5) -> DataFrame:
    """Runs of one base at least ``min_length`` long.

    A chunk lists its own runs of any length at its edges and long ones inside; touching runs of
    one base are then merged across chunk edges.
    """
    wanted = [F.lit(b) for b in bases]
    c = chunks.filter(F.length("seq") > 0).select("chr", "chunk", F.length("seq").alias("__len"), F.split("seq", "").alias("__c"))
    at = lambda i: F.get(F.col("__c"), i - 1)
    idx = F.sequence(F.lit(1), F.col("__len"))
    mine = lambda i: at(i).isin(*wanted)
    # The n-th run of wanted bases starts at the n-th start and ends at the n-th end.
    starts = F.filter(idx, lambda i: mine(i) & ((i == 1) | ~at(i).eqNullSafe(at(i - 1))))
    ends = F.filter(idx, lambda i: mine(i) & ((i == F.col("__len")) | ~at(i).eqNullSafe(at(i + 1))))
    both = c.select("chr", "chunk", "__len", F.explode(F.arrays_zip(starts.alias("s"), F.transform(starts, at).alias("b"), ends.alias("e"))).alias("__r"))
    base = F.col("chunk") * width
    runs = both.select(
        "chr", F.col("__r.b").alias("base"), (base + F.col("__r.s")).alias("start"), (base + F.col("__r.e")).alias("end"), (F.col("__r.s") == 1).alias("__l"), (F.col("__r.e") == F.col("__len")).alias("__r"))
    kept = runs.filter(F.col("__l") | F.col("__r") | (F.col("end") - F.col("start") + 1 >= min_length))
    return merge_ranges(kept, ["chr", "base"]).filter(F.col("end") - F.col("start") + 1 >= min_length)


def locus_splices(junctions: DataFrame, loci: DataFrame) -> DataFrame:
    """Splice junctions and fragments per sample and locus, with counts per million; zeros kept.  Runs jobs while it is called.

    The junctions that overlap a locus are those that start up to its end, less those that end before its start, so both
    are running counts over positions and no pair of junction and locus is made, however many loci a junction spans.
    ``nfrag`` of a real type, whose differences would round, and ranges that end before they start meet in pairs.
    """
    j = junctions.select("sid", "chr", "start", "end", "strand", "nfrag")
    l = cut_lineage(loci.select("chr", "start", "end", "strand", "locus_id"))
    cells = cut_lineage(grid(j.select("sid").distinct(), l))
    back = F.col("start") > F.col("end")
    if dict(j.dtypes)["nfrag"] in ("tinyint", "smallint", "int", "bigint"):
        parts = [_splices_by_position(j.filter(~back), l.filter(~back), cells.filter(~back)), _splices_by_pair(j.filter(back), l)]
        if l.filter(back).limit(1).count():
            parts.append(_splices_by_pair(j.filter(~back), l.filter(back)))
    else:
        parts = [_splices_by_pair(j, l)]
    agg = cut_lineage(reduce(DataFrame.unionByName, parts).groupBy("sid", "locus_id").agg(F.sum("nsj").alias("nsj"), F.sum("nsfrag").alias("nsfrag")))
    out = cells.select("sid", "locus_id").join(agg, ["sid", "locus_id"], "left").fillna(0, ["nsj", "nsfrag"])
    total = out.groupBy("sid").agg(F.sum("nsfrag").alias("__t"))
    return join_stats(out, total, ["sid"]).withColumn("cspm", F.col("nsfrag") / F.nullif(F.col("__t") / 1e6, F.lit(0.0))).drop("__t")


def _splices_by_pair(junctions: DataFrame, loci: DataFrame) -> DataFrame:
    """sid, locus_id, nsj and nsfrag of the loci that junctions overlap."""
    hit = overlap_join(junctions, loci, strand="strand")
    return hit.groupBy("sid", F.col("s_locus_id").alias("locus_id")).agg(F.count(F.lit(1)).alias("nsj"), F.sum("nfrag").alias("nsfrag"))


def _splices_by_position(junctions: DataFrame, loci: DataFrame, cells: DataFrame) -> DataFrame:
    """The same for every cell (sample and locus row), by running counts.

    Side 0 counts starts and is asked at the end of a locus, behind the starts there; side 1 counts ends and is asked at
    the start of a locus, before the ends there.  Kind "" are all junctions, "=x" those of strand x: a locus of strand x
    asks for "=x" and "=*", one of strand * for all.
    """
    star = F.col("strand").eqNullSafe("*")
    stars, others = loci.agg(F.max(star), F.max(~star)).first()
    exact = F.concat(F.lit("="), F.col("strand"))
    kinds = [F.lit("")] * bool(stars) + [exact] * bool(others) or [F.lit("")]
    known = F.col("sid").isNotNull() & F.col("chr").isNotNull()

    def dealt(df: DataFrame, kind: Column, ends: tuple[str, str], *more: str) -> DataFrame:
        sides = F.array(*[F.struct(F.lit(i).cast("byte").alias("side"), F.col(c).alias("pos")) for i, c in enumerate(ends)])
        kept = df.filter(known).select("sid", "chr", F.explode(F.array_compact(kind)).alias("kind"), *ends, *more)
        return kept.select("sid", "chr", "kind", F.explode(sides).alias("__s"), *more).select("sid", "chr", "kind", "__s.side", "__s.pos", *more).filter("pos is not null")

    keys = ["sid", "chr", "kind", "side"]
    events = dealt(junctions, F.array(*kinds), ("start", "end"), "nfrag").groupBy(*keys, "pos").agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("nfrag"), F.lit(0).cast("long")).alias("f"))
    events = cut_lineage(events)  # the scan reads them twice
    asked = dealt(cells.filter("locus_id is not null"), F.when(star, F.array(F.lit(""))).otherwise(F.array(exact, F.lit("=*"))), ("end", "start"), "locus_id")
    no_locus, none = F.lit(None).cast(loci.schema["locus_id"].dataType).alias("locus_id"), F.lit(0).cast("long")
    steps = events.select(*keys, "pos", F.col("side").alias("turn"), "n", "f", no_locus).unionByName(asked.select(*keys, "pos", (1 - F.col("side")).cast("byte").alias("turn"), none.alias("n"), none.alias("f"), "locus_id"))
    met = scan(steps, keys, "pos", {"__n": ("sum", F.col("n")), "__f": ("sum", F.col("f"))}, tie=["turn"]).filter("locus_id is not null")
    signed = lambda c: F.sum(F.when(F.col("side") == 0, F.col(c)).otherwise(-F.col(c)))
    return met.groupBy("sid", "locus_id").agg(signed("__n").alias("nsj"), signed("__f").alias("nsfrag"))


# ---------------------------------------------------------------- clonotypes

def clonotype_flanks(clones: DataFrame, segments: DataFrame) -> DataFrame:
    """Reference bases around CDR3 of each clone.

    ``clones``: best_v, best_j, v_alignment, j_alignment (fields begin|end|length|...); ``segments``:
    name, seq, begin, end, where begin > end means the reverse strand.
    """
    minus = F.col("begin") > F.col("end")
    cut = F.when(minus, reverse_complement(F.substring("seq", F.col("end") + 1, F.col("begin") - 1 - F.col("end")))).otherwise(F.substring("seq", F.col("begin"), F.col("end") - F.col("begin") + 1))
    ref = segments.groupBy("name").agg(F.min(cut).alias("ref"))
    j = clones.join(ref.select(F.col("name").alias("best_v"), F.col("ref").alias("__v")), "best_v", "left").join(ref.select(F.col("name").alias("best_j"), F.col("ref").alias("__j")), "best_j", "left")
    field = lambda c, i: F.split(c, r"\|")[i].cast("int")
    v_keep = F.length("__v") - (field("v_alignment", 2) - field("v_alignment", 0) - 19) + 1
    v_cut = F.substring(F.col("__v"), F.lit(1), v_keep)
    j_len = field("j_alignment", 2) - field("j_alignment", 1)
    last = lambda s, n: F.substring(s, F.greatest(F.length(s) - n + 1, F.lit(1)), n)
    return j.withColumn("v_flank", last(v_cut, F.lit(40))).withColumn("j_flank", last(F.col("__j"), j_len)).drop("__v", "__j")
