"""Chimeric RNA: junctions to breakpoints, artifacts, topology, calls, chains and reports.

Tables carry the sample ``id``; a breakpoint is identified by ``KEY``, a chimera by ``CHIMERA``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.functions.text import low_complexity, reverse_complement
from cohortloom.operators.common import first_row, grid, join_stats, keep, later_wins, whole_groups, with_group
from cohortloom.operators.genemodel import to_transcript
from cohortloom.operators.graph import connected_components
from cohortloom.operators.intervals import first_overlap, overlap_join
from cohortloom.session import cut_lineage

KEY = ["id", "type", "chr_5", "pos_5", "str_5", "chr_3", "pos_3", "str_3"]
CHIMERA = ["id", "locus_id_5_1", "locus_id_3_1", "locus_id_5_2", "locus_id_3_2"]
FAR = 2_147_483_647


@dataclass(frozen=True)
class FusionOptions:
    """User-set thresholds of the fusion caller."""

    jnc_ovr: int = 20
    jnc_ovr_pct: float = 0.8
    jnc_err: float = 0.05
    jnc_low: float = 0.1
    art_pen: float = 3.0
    sum_hq: int = 1
    sum_unq: float = 2.0
    sum_jnc: int = 2
    unq_ovr: int = 2
    max_ovr: int = 30
    err: float = 0.05
    low: float = 0.1
    dst_frg: int = 500
    dst_spl: int = 100_000
    chm_hi: float = 1.0
    rec_ts: int = 3
    rec_ts_warn: int = 3
    rec_chm: int = 3


# ---------------------------------------------------------------- junctions

def merge_junctions(records: DataFrame, tags: DataFrame, sequences: DataFrame, loci: DataFrame) -> DataFrame:
    """Records with their alignment tags and both sequences, on known loci at both ends."""
    s = sequences.groupBy("qname").agg(F.max(F.when(F.col("hit") == 1, F.col("seq"))).alias("seq_5"), F.max(F.when(F.col("hit") == 2, F.col("seq"))).alias("seq_3"))
    j = records.join(tags, "qname").join(s, "qname").filter(F.col("seq_5").isNotNull() & F.col("seq_3").isNotNull())
    for e in ("5", "3"):
        ends = j.select(F.col(f"chr_{e}").alias("chr"), F.col(f"pos_{e}").alias("pos"), F.col(f"str_{e}").alias("strand")).distinct()
        ok = overlap_join(ends, loci.select("chr", "start", "end", "strand"), q=("pos", "pos"), strand="strand").select("chr", "pos", "strand").distinct()
        ok = ok.toDF(f"chr_{e}", f"pos_{e}", f"str_{e}")
        j = j.join(ok, ok.columns, "left_semi")
    return j


def dust_scores(jnc: DataFrame) -> DataFrame:
    """Low-complexity score of the aligned part of both sequences."""
    part = lambda e: F.substring(F.col(f"seq_{e}"), F.col(f"clp_{e}_l") + 1, F.length(f"seq_{e}") - F.col(f"clp_{e}_l") - F.col(f"clp_{e}_r"))
    return jnc.withColumns({f"low_{e}": F.coalesce(low_complexity(part(e)), F.lit(0.0)) for e in ("5", "3")})


def class_at(points: DataFrame, features: DataFrame, types: Sequence[str], out: str, value: str = "type") -> DataFrame:
    """Value of the first feature (by rank) within two bases of each (chr, pos, strand)."""
    q = points.select("chr", "pos", "strand").distinct().withColumn("__a", F.col("pos") - 2).withColumn("__b", F.col("pos") + 2)
    s = features.filter(F.col("type").isin(list(types))) if types else features
    cols = list(dict.fromkeys(["chr", "start", "end", "strand", "ord", value]))
    hit = first_overlap(q, s.select(*cols), ["chr", "pos", "strand"], ["ord", "start", "end", *([value] if value not in ("ord",) else [])], q=("__a", "__b"), strand="strand")
    return hit.select("chr", "pos", "strand", F.col(f"s_{value}").alias(out))


def _at_end(df: DataFrame, lookup: DataFrame, e: str, column: str, out: str, flip: bool = False) -> DataFrame:
    st = F.when(F.col(f"str_{e}") == "+", "-").otherwise("+") if flip else F.col(f"str_{e}")
    l = lookup.select(F.col("chr").alias("__c"), F.col("pos").alias("__p"), F.col("strand").alias("__s"), F.col(column).alias(out))
    j = df.withColumn("__st", st)
    return j.join(l, (j[f"chr_{e}"] == l["__c"]) & (j[f"pos_{e}"] == l["__p"]) & (j["__st"] == l["__s"]), "left").drop("__c", "__p", "__s", "__st")


def end_points(df: DataFrame, both_strands: bool = False) -> DataFrame:
    rows = df.select(F.inline(F.array(*[F.struct(F.col(f"chr_{e}").alias("chr"), F.col(f"pos_{e}").alias("pos"), F.col(f"str_{e}").alias("strand")) for e in ("5", "3")])))
    if both_strands:
        rows = rows.select("chr", "pos", F.explode(F.array(F.lit("+"), F.lit("-"))).alias("strand"))
    return rows.distinct()


# ---- fixed values: preference of a 5' class (row) for a 3' class (column)
ORIENTATION_SCORE = {
    "D": {"D": 1, "A": 1, "E": 1, "G": 1, ".": 1},
    "A": {"D": 16, "A": 1, "E": 14, "G": 12, ".": 10},
    "E": {"D": 15, "A": 1, "E": 9, "G": 7, ".": 5},
    "G": {"D": 13, "A": 1, "E": 8, "G": 4, ".": 2},
    ".": {"D": 11, "A": 1, "E": 6, "G": 3, ".": 0},
}


def _score(five: Column, three: Column) -> Column:
    flat = F.create_map(*[F.lit(x) for t, row in ORIENTATION_SCORE.items() for f, v in row.items() for x in (f + t, v)])
    return flat[F.concat(five, three)]


def orient_junctions(jnc: DataFrame, features: DataFrame, chromosome_rank: Column | None = None) -> DataFrame:
    """Canonical direction of unstranded junctions: splice motif, then feature scores, then position.

    Reversed junctions swap every pair of 5'/3' columns and flip both strands.
    """
    # Looked up four times: stored once, one row per distinct end.
    look = cut_lineage(class_at(end_points(jnc, True), features, ["D", "A", "E", "G", "."], "cls"))
    t = jnc
    for e, out, flip in (("5", "__f5", False), ("3", "__f3", False), ("3", "__r5", True), ("5", "__r3", True)):
        t = _at_end(t, look, e, "cls", out, flip)
    fwd, rev = _score(F.col("__f5"), F.col("__f3")), _score(F.col("__r5"), F.col("__r3"))
    code = lambda e: F.coalesce(F.regexp_extract(F.col(f"chr_{e}"), "([0-9]+)$", 1).try_cast("int"), F.when(F.col(f"chr_{e}") == "chrX", 23).when(F.col(f"chr_{e}") == "chrY", 24).otherwise(25))
    less = lambda a, b: F.when(a < b, False).when(a > b, True)
    plus_first = lambda e: F.when(F.col(f"str_{e}") == "+", 0).otherwise(1)
    swap = F.coalesce(
        F.when(F.col("type") == 1, False).when(F.col("type") == 2, True), less(rev, fwd), less(code("5"), code("3")), less(F.col("pos_5"), F.col("pos_3")),
        less(plus_first("5"), plus_first("3")), F.lit(False))
    t = t.withColumn("__swap", swap)
    other = lambda c: c.replace("_5", "_#").replace("_3", "_5").replace("_#", "_3")
    flipped = lambda c: F.when(F.col(c) == "+", "-").otherwise("+")
    cols = []
    for c in jnc.columns:
        o = other(c)
        if c in ("str_5", "str_3"):
            cols.append(F.when(F.col("__swap"), flipped(o)).otherwise(F.col(c)).alias(c))
        elif c == "type":
            cols.append(F.when(F.col("__swap") & (F.col("type") == 2), 1).otherwise(F.col("type")).alias("type"))
        elif o != c and o in jnc.columns:
            cols.append(F.when(F.col("__swap"), F.col(o)).otherwise(F.col(c)).alias(c))
        else:
            cols.append(F.col(c))
    return t.select(*cols)


def orient_sequences(jnc: DataFrame) -> DataFrame:
    """Both sequences in transcript direction, for paired and single reads."""
    pe, se = F.col("ftype") == "pe", F.col("ftype") == "se"
    m5, p3 = F.col("str_5") == "-", F.col("str_3") == "+"
    exchange = se & m5 & p3
    rc5, rc3 = (pe & m5) | (se & m5 & ~p3), (pe & p3) | (se & ~m5 & p3)
    five = F.when(exchange, F.col("seq_3")).when(rc5, reverse_complement(F.col("seq_5"))).otherwise(F.col("seq_5"))
    three = F.when(exchange, F.col("seq_5")).when(rc3, reverse_complement(F.col("seq_3"))).otherwise(F.col("seq_3"))
    return jnc.withColumn("__five", five).withColumn("seq_3", three).withColumn("seq_5", F.col("__five")).drop("__five")


def junction_quality(jnc: DataFrame, o: FusionOptions = FusionOptions()) -> DataFrame:
    """Uniqueness weight (1/N of equal alignments) and the high-quality flag."""
    same = ["id", "type", "chr_5", "pos_5", "str_5", "chr_3", "pos_3", "str_3", *[c for c in ("seg_5_cig", "seg_3_cig") if c in jnc.columns]]
    j = with_group(jnc, same, {"unq_jnc": 1.0 / F.count(F.lit(1))})
    c = F.col
    clean = (c("err_5") < o.jnc_err) & (c("err_3") < o.jnc_err) & (c("low_5") < o.jnc_low) & (c("low_3") < o.jnc_low)
    enc = (c("ovr_5") > o.jnc_ovr_pct * c("seg_5_len")) & (c("ovr_3") > o.jnc_ovr_pct * c("seg_3_len")) & clean
    full = F.when(c("ftype") == "pe", c("seg_5_len") + c("seg_3_len")).otherwise(c("seg_5_len"))
    spn = (c("ovr_5") + c("ovr_3") > o.jnc_ovr_pct * full) & (c("ovr_5") > o.jnc_ovr) & (c("ovr_3") > o.jnc_ovr) & clean
    return j.withColumn("hq_jnc", F.when(c("type") < 0, enc).otherwise(spn))


# ---------------------------------------------------------------- breakpoints

def collapse_junctions(jnc: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Breakpoints: read counts, qualities and distinct overlaps of their junctions.

    Overlaps are whole bases of a read, so a breakpoint has no more different ones than a read has bases: they are
    collected as a set, where counting them apart would shuffle every junction three times.
    """
    aggs = [F.count(F.lit(1)).alias("sum_jnc"), F.sum(F.coalesce(F.col("hq_jnc").cast("int"), F.lit(0))).alias("hq_sum_jnc"), F.coalesce(F.sum("unq_jnc"), F.lit(0.0)).alias("unq_sum_jnc")]
    for e in ("5", "3"):
        aggs += [F.avg(f"err_{e}").alias(f"avg_err_{e}"), F.avg(f"low_{e}").alias(f"avg_low_{e}"), F.max(f"ovr_{e}").alias(f"max_ovr_{e}"), F.size(F.collect_set(f"ovr_{e}")).cast("bigint").alias(f"unq_ovr_{e}")]
    return jnc.groupBy(*key).agg(*aggs)


def classify_breakpoints(bpt: DataFrame, features: DataFrame, frames: DataFrame) -> DataFrame:
    """Feature class, splice site and frame of both ends; in-frame and donor-acceptor flags."""
    pts = cut_lineage(end_points(bpt))
    cls = cut_lineage(class_at(pts, features, ["3", "5", "C", "E", "I", "."], "v"))
    ss = cut_lineage(class_at(pts, features, ["D", "A", "."], "v"))
    whole = features.filter(F.col("type") == ".").select("chr", "start", "end", "strand", F.lit(1).alias("ord"), F.lit(3).alias("frame"), F.lit(".").alias("type"))
    fr = frames.select("chr", "start", "end", "strand", F.lit(0).alias("ord"), "frame", "type").unionByName(whole)
    frm = cut_lineage(class_at(pts, fr, [], "v", "frame"))
    out = bpt
    for e in ("5", "3"):
        out = _at_end(_at_end(_at_end(out, cls, e, "v", f"cls_{e}"), ss, e, "v", f"ss_{e}"), frm, e, "v", f"frm_{e}")
    spanning = F.col("type") > -1
    framed = spanning & (F.col("frm_5") == F.col("frm_3")) & (F.col("frm_5") < 3)
    starts = spanning & F.col("cls_5").isin("5", "E") & F.col("cls_3").isin("5", "C")
    return out.withColumn("orf", framed | starts).withColumn("d2a", (F.col("type") == 1) | ((F.col("type") == 0) & (F.col("ss_5") == "D") & (F.col("ss_3") == "A")))


def transcript_distance(bpt: DataFrame, exons: DataFrame) -> DataFrame:
    """Smallest distance of the two ends along one transcript, and along the genome."""
    step = lambda e, up: F.when(F.col(f"str_{e}") == "+", up).otherwise(-up)
    ends = bpt.select(*KEY, (F.col("pos_5") + step("5", -1)).alias("q5"), (F.col("pos_3") + step("3", 1)).alias("q3"))
    t5 = to_transcript(ends.select(F.col("chr_5").alias("chr"), F.col("q5").alias("pos")).distinct(), exons, ["chr", "pos"])
    t3 = to_transcript(ends.select(F.col("chr_3").alias("chr"), F.col("q3").alias("pos")).distinct(), exons, ["chr", "pos"])
    a = ends.join(t5.toDF("chr_5", "q5", "transcript_id", "tx_pos_5"), ["chr_5", "q5"])
    both = a.join(t3.toDF("chr_3", "q3", "transcript_id", "tx_pos_3"), ["chr_3", "q3", "transcript_id"]).withColumn("__d", F.col("tx_pos_5") - F.col("tx_pos_3"))
    best = first_row(both, KEY, [F.abs("__d").asc(), F.col("transcript_id").asc()]).select(*KEY, "__d", "tx_pos_5", "tx_pos_3")
    sign = F.when((F.col("str_5") == "+") & (F.col("str_3") == "+"), -1).otherwise(1)
    out = join_stats(bpt, best, KEY).withColumn("tx_dst", F.col("__d") * sign).drop("__d")
    gx = F.when(F.col("chr_5") == F.col("chr_3"), F.col("pos_5") - F.col("pos_3"))
    out = out.withColumn("gx_dst", gx)
    return out.withColumn("bp_dst", F.least(F.abs(F.coalesce("tx_dst", F.lit(FAR))), F.abs(F.coalesce("gx_dst", F.lit(FAR)))))


# ---- fixed values: artifact labels from weak to strong, and their groups
ARTIFACTS = ["nil", "rep", "low", "sv", "l1", "l2", "l3", "mlt", "mer", "erv", "ltr", "igx", "rn7", "rpx", "sno", "rnu", "alu", "psi", "mtr", "alt", "seg", "aln",
             "xlw", "ret", "msr", "sim", "gtb", "cmt"]
LONG_REPEATS = ["l1", "l2", "l3", "mlt", "mer", "erv", "ltr", "igx", "sv"]
EXPRESSED = ["rn7", "rpx", "sno", "rnu"]
BAD = ["alu", "psi", "mtr", "alt"]
UGLY = ["ret", "cmt", "msr", "sim", "seg", "xlw", "gtb", "aln"]
REPEAT_NAMES = {"alu": "Alu", "msr": "MSR1", "l1": "^L1|HAL1", "l2": "^L2", "l3": "^L3", "mlt": "^MLT", "mer": "^MER", "erv": "ERV", "ltr": "LTR", "sim": r"\([AGCT]{1,2}\)n"}
GENE_NAMES = {"rn7": "^RN7S", "rpx": "^M{0,1}RP[LS][0-9AP]", "rnu": "^RNU"}


def _priority(label: Column) -> Column:
    return F.create_map(*[F.lit(x) for i, a in enumerate(ARTIFACTS) for x in (a, i)])[label]


def artifact_masks(repeats: DataFrame, genes: DataFrame, others: Mapping[str, DataFrame], o: FusionOptions = FusionOptions()) -> DataFrame:
    """One labelled mask table (chr, start, end, label) from repeats, gene classes and further masks.

    ``others`` maps a label to ranges: ret, sv, low, sno, igx, gtb, cmt, alt.  Masks apply to both strands.
    """
    n = F.col("end") - F.col("start") + 1
    base = ["chr", "start", "end"]
    labels = [F.when(F.col("name").rlike(p), F.lit(k)) for k, p in REPEAT_NAMES.items()]
    labels.append(F.when(n < 2000, F.lit("rep")))
    if "score" in repeats.columns:
        labels.append(F.when(F.col("name").rlike(r"\([AGCT]{3,}\)n") & (F.col("score") / n > 0.90), F.lit("mtr")))
    labels.append(F.when(F.col("name").rlike("^U[0-9]"), F.lit("rnu")))
    out = repeats.select(*base, F.explode(F.filter(F.array(*labels), lambda x: x.isNotNull())).alias("label"))
    gl = [F.when(F.col("gene_name").rlike(p), F.lit(k)) for k, p in GENE_NAMES.items()]
    if "gene_type" in genes.columns:
        gl.append(F.when(F.col("gene_type").contains("pseudo"), F.lit("psi")))
    out = out.unionByName(genes.select(*base, F.explode(F.filter(F.array(*gl), lambda x: x.isNotNull())).alias("label")))
    limits = {"sv": n > 20_000, "low": n >= o.jnc_ovr}
    for label, df in others.items():
        m = df.filter(limits[label]) if label in limits else df
        out = out.unionByName(m.select(*base, F.lit(label).alias("label")))
    return out


def _near_end(e: str, o: FusionOptions) -> tuple[Column, Column]:
    """Window around an end: far into the aligned side, a third of it across the break."""
    far, near = o.jnc_ovr, -(-o.jnc_ovr // 3)
    into_left = (F.col(f"str_{e}") == "+") if e == "5" else (F.col(f"str_{e}") != "+")
    p = F.col(f"pos_{e}")
    return F.when(into_left, p - far).otherwise(p - near), F.when(into_left, p + near).otherwise(p + far)


def label_artifacts(bpt: DataFrame, masks: DataFrame, segdups: DataFrame | None = None, known: DataFrame | None = None, o: FusionOptions = FusionOptions()) -> DataFrame:
    """Strongest artifact label of both ends and the joint artifact flag.

    All masks are joined at once as one labelled table.  ``segdups`` and ``known`` are pairs of ranges
    that must hold both ends.
    """
    out = bpt
    for e in ("5", "3"):
        a, b = _near_end(e, o)
        ends = bpt.select(F.col(f"chr_{e}").alias("chr"), F.col(f"pos_{e}").alias("pos"), F.col(f"str_{e}").alias("strand"), a.alias("__a"), b.alias("__b")).distinct()
        # One row per distinct end: stored, so that its true size decides how it meets the breakpoints.
        hit = cut_lineage(overlap_join(ends, masks, q=("__a", "__b")).groupBy("chr", "pos", "strand").agg(F.max(_priority(F.col("s_label"))).alias("v")))
        out = _at_end(out, hit, e, "v", f"__m{e}")
    low = lambda e: F.when(F.col(f"avg_low_{e}") > o.jnc_low * 4, F.lit(ARTIFACTS.index("xlw")))
    pair = F.lit(None).cast("int")
    for label, recs in (("seg", segdups), ("aln", known)):
        if recs is None:
            continue
        a5, b5 = _near_end("5", o)
        a3, b3 = _near_end("3", o)
        q = out.select(*KEY, F.col("chr_5").alias("chr"), a5.alias("__a"), b5.alias("__b"), a3.alias("__a3"), b3.alias("__b3"))
        r = recs.select(F.col("chr1").alias("chr"), "start1", "end1", "chr2", "start2", "end2")
        hit = overlap_join(q, r, q=("__a", "__b"), s=("start1", "end1")).filter((F.col("chr_3") == F.col("s_chr2")) & (F.col("__a3") <= F.col("s_end2")) & (F.col("__b3") >= F.col("s_start2")))
        out = join_stats(out, hit.select(*KEY).distinct().withColumn(f"__p_{label}", F.lit(True)), KEY)
        pair = F.greatest(pair, F.when(F.col(f"__p_{label}"), F.lit(ARTIFACTS.index(label))))
    name = F.array(*[F.lit(x) for x in ARTIFACTS])
    label_of = lambda e: F.element_at(name, F.coalesce(F.greatest(F.col(f"__m{e}"), low(e), pair), F.lit(0)) + 1)
    out = out.withColumn("art_5", label_of("5")).withColumn("art_3", label_of("3"))
    a, b = F.col("art_5"), F.col("art_3")
    fine = (
        ~(a.isin(LONG_REPEATS) & b.isin(LONG_REPEATS) & (a == b)) & ~(a.isin(EXPRESSED) & b.isin(EXPRESSED))
        & ~((a.isin(BAD) & (b != "nil")) | (b.isin(BAD) & (a != "nil"))) & ~(a.isin(UGLY) | b.isin(UGLY))
    )
    spliced = F.coalesce((F.col("ss_5") == "D") & (F.col("ss_3") == "A"), F.lit(False)) if "ss_5" in out.columns else F.lit(False)
    return out.withColumn("art", ~(fine | spliced)).drop("__m5", "__m3", "__p_seg", "__p_aln")


def associate_loci(bpt: DataFrame, loci: DataFrame) -> DataFrame:
    """Locus of both ends, and of the reverse-complement event, with the flip undone."""
    pts = end_points(bpt, True)
    look = first_overlap(pts, loci.select("chr", "start", "end", "strand", "locus_id"), ["chr", "pos", "strand"], ["start", "locus_id"], q=("pos", "pos"), strand="strand")
    look = cut_lineage(look.select("chr", "pos", "strand", F.col("s_locus_id").alias("v")))
    t = bpt
    for e, out, flip in (("5", "locus_id_5_1", False), ("3", "locus_id_3_1", False), ("3", "__r5", True), ("5", "__r3", True)):
        t = _at_end(t, look, e, "v", out, flip)
    flip = F.coalesce((F.col("locus_id_5_1") == F.col("__r5")) & (F.col("locus_id_3_1") == F.col("__r3")), F.lit(False))
    return t.withColumn("locus_id_5_2", F.when(flip, F.col("__r3")).otherwise(F.col("__r5"))).withColumn("locus_id_3_2", F.when(flip, F.col("__r5")).otherwise(F.col("__r3"))).drop("__r5", "__r3")


DISTANCES = ["frg", "loc", "adj", "cyt", "arm", "chr", "gme"]  # fixed values, near to far
TOPOLOGIES = ["inv", "dup", "del", "tloc"]


def distance_rank(c: Column) -> Column:
    return F.create_map(*[F.lit(x) for i, d in enumerate(DISTANCES) for x in (d, i)])[c]


def topology_breakpoints(bpt: DataFrame, loci: DataFrame, cytobands: DataFrame, adjacent: DataFrame, o: FusionOptions = FusionOptions()) -> DataFrame:
    """Distance class and topology of the two loci; nearer classes override farther ones."""
    t = with_group(bpt, CHIMERA, {"sum_bpt": F.count(F.when(F.col("type") > -1, 1))}, whole=bool(whole_groups(bpt, "id")))
    place = loci.select("locus_id", F.col("chr").alias("c"), F.col("strand").alias("s"), F.col("start").alias("b"), F.col("end").alias("e")).join(cytobands.select("locus_id", F.col("cytoband").alias("cb"), F.col("arm").alias("arm")), "locus_id", "left")
    place = cut_lineage(place)  # the tables of loci are stored: their true sizes decide how they meet the breakpoints
    for e in ("5", "3"):
        t = t.join(place.select(*[F.col(x).alias(f"__{x}{e}" if x != "locus_id" else f"locus_id_{e}_1") for x in ("locus_id", "c", "s", "b", "e", "cb", "arm")]), f"locus_id_{e}_1", "left")
    adj = cut_lineage(adjacent.select("locus_a", "locus_b").distinct())
    for mark, a, b in (("__adj1", "locus_id_5_1", "locus_id_3_1"), ("__adj2", "locus_id_5_1", "locus_id_5_2")):
        t = t.join(adj.select(F.col("locus_a").alias(a), F.col("locus_b").alias(b), F.lit(True).alias(mark)), [a, b], "left")
    c = F.col
    l51, l31, l52, l32 = c("locus_id_5_1"), c("locus_id_3_1"), c("locus_id_5_2"), c("locus_id_3_2")
    same_chr = c("__c5") == c("__c3")
    dst = later_wins([
        (same_chr, F.lit("chr")), (same_chr & (c("__arm5") == c("__arm3")), F.lit("arm")), (c("__cb5") == c("__cb3"), F.lit("cyt")),
        (F.coalesce("__adj1", "__adj2", F.lit(False)), F.lit("adj")), ((l51 == l31) | (l51 == l52) | (l31 == l32) | ((l51 == l32) & (l31 == l52)), F.lit("loc")),
        (c("bp_dst") < o.dst_frg, F.lit("frg")),
    ], F.lit("gme"))
    t = t.withColumn("dst", dst)
    same_str = c("__s5") == c("__s3")
    after = (c("__b5") > c("__b3")) | ((c("__b5") == c("__b3")) & (c("__e5") > c("__e3")))
    equal = (c("__b5") == c("__b3")) & (c("__e5") == c("__e3"))
    dup = same_str & ((same_chr & (c("__s5") == "+") & after) | (same_chr & (c("__s5") == "-") & ~after & ~equal) | (same_chr & equal))
    topo = F.when(c("dst") == "gme", "tloc").when(~same_str, "inv").when(dup, "dup").otherwise("del")
    return t.withColumn("topo", topo).select(*bpt.columns, "sum_bpt", "dst", "topo")


def levels(bpt: DataFrame) -> DataFrame:
    """Spanning or encompassing; distal or proximal."""
    r = distance_rank(F.col("dst"))
    distal = (F.col("topo") == "tloc") | ((F.col("topo") == "inv") & (r > DISTANCES.index("loc"))) | (F.col("topo").isin("dup", "del") & (r > DISTANCES.index("adj")))
    return bpt.withColumns({"l1": F.when(F.col("type") > -1, "spn").otherwise("enc"), "l2": F.when(distal, "dist").otherwise("prox"), "l3": F.lit("nd")})


def high_quality(bpt: DataFrame, o: FusionOptions = FusionOptions()) -> DataFrame:
    """Read support, distance and quality; thresholds are scaled by the artifact penalty for suspect ends."""
    c = F.col
    clean = ((c("art_5") == "nil") & (c("art_3") == "nil")) | c("d2a")
    least = lambda col, v: (clean & (c(col) >= v)) | (c(col) >= v * o.art_pen)
    own = lambda e: (c(f"art_{e}") == "nil") | c("d2a")
    low = lambda e, col, v: (own(e) & (c(col) >= v)) | (c(col) >= v * o.art_pen)
    high = lambda e, col, v: (own(e) & (c(col) <= v)) | (c(col) <= v / o.art_pen)
    ok = (c("art_5") != "aln") & (c("art_3") != "aln") & least("hq_sum_jnc", o.sum_hq) & least("unq_sum_jnc", o.sum_unq) & least("sum_jnc", o.sum_jnc)
    ok = ok & (c("topo").isin("inv", "tloc") | (c("bp_dst") > o.dst_spl))
    for e in ("5", "3"):
        ok = ok & low(e, f"unq_ovr_{e}", o.unq_ovr) & low(e, f"max_ovr_{e}", o.max_ovr) & high(e, f"avg_err_{e}", o.err) & high(e, f"avg_low_{e}", o.low)
    return bpt.withColumn("hq_bpt", F.coalesce(ok, F.lit(False)))


def high_importance(bpt: DataFrame, important: DataFrame, o: FusionOptions = FusionOptions()) -> DataFrame:
    """Chimeras on loci of interest with enough unique reads, no close distance and a spliced spanning read."""
    loc = cut_lineage(important.select(F.col("locus_id").alias("__l")).filter("__l is not null").distinct())
    t = bpt
    for i, side in enumerate(CHIMERA[1:]):
        t = t.join(loc.select(F.col("__l").alias(f"__l{i}")), F.col(side) == F.col(f"__l{i}"), "left")
    t = t.withColumn("__t", F.coalesce(*[F.col(f"__l{i}") for i in range(4)]).isNotNull()).drop(*[f"__l{i}" for i in range(4)])
    sel = F.coalesce("__t", F.lit(False)) & ~F.col("art_5").isin("aln", "gtb", "cmt") & ~F.col("art_3").isin("aln", "gtb", "cmt")
    t = t.withColumn("__sel", sel)
    far = distance_rank(F.col("dst")) >= DISTANCES.index("adj")
    chosen = lambda x: F.when(F.col("__sel"), x)  # only selected rows count
    aggs = {"__a": F.sum(chosen(F.col("unq_sum_jnc"))), "__b": F.bool_and(chosen(far)), "__c": F.bool_or(chosen((F.col("type") > -1) & F.col("d2a")))}
    whole = bool(whole_groups(bpt, "id"))
    out = with_group(t, CHIMERA, aggs, whole=True) if whole else join_stats(t, t.filter("__sel").groupBy(*CHIMERA).agg(*[c.alias(n) for n, c in aggs.items()]), CHIMERA)
    ok = (F.col("__a") > o.chm_hi) & F.col("__b") & F.col("__c")
    return out.withColumn("hi_bpt", F.col("__sel") & F.coalesce(ok, F.lit(False))).drop("__t", "__sel", "__a", "__b", "__c")


def recurrent(bpt: DataFrame, o: FusionOptions = FusionOptions()) -> DataFrame:
    """Recurrent spliced distal ends: rows and distinct partners per end; flagged rows share either end."""
    use = (F.col("l1") == "spn") & (F.col("l2") == "dist") & F.col("d2a") & ~F.col("art_5").isin("rpx", "ret", "cmt") & ~F.col("art_3").isin("rpx", "ret", "cmt")
    base = bpt.withColumn("__use", F.coalesce(use, F.lit(False)))
    if tasks := whole_groups(bpt, "id"):
        # Chosen rows are spanning, so the windows order spanning rows only.
        spanning = F.coalesce(F.col("l1") == "spn", F.lit(False))
        out = _recurrent_whole(base.filter(spanning), o).unionByName(base.filter(~spanning), allowMissingColumns=True)
        return out.repartition(tasks, "id").drop("__use").fillna(0, ["rec_5", "unq_rec_5", "rec_3", "unq_rec_3"]).fillna(False, ["hr_bpt"])
    # Only rows of the selection count, for partners as for rows, and only they have counts: the others are not shuffled.
    chosen = base.filter("__use").drop("__use")
    t = chosen
    for e, p, q in (("5", "locus_id_3_1", "locus_id_5_2"), ("3", "locus_id_5_1", "locus_id_3_2")):
        end = ["id", f"chr_{e}", f"pos_{e}", f"str_{e}"]
        partner = F.struct(F.coalesce(p, F.lit("")), F.coalesce(q, F.lit("")))
        stats = chosen.groupBy(*end).agg(F.count(F.lit(1)).alias("__n"), F.count_distinct(partner).alias("__u"))
        t = join_stats(t, stats, end)
        t = t.withColumn(f"rec_{e}", F.col("__n")).withColumn(f"unq_rec_{e}", F.when(F.col("__n") > 1, F.col("__u")).otherwise(F.lit(1))).drop("__n", "__u")
    t = t.unionByName(base.filter("NOT __use").drop("__use"), allowMissingColumns=True)
    t = cut_lineage(t)
    seed = t.filter((F.col("unq_rec_5") >= o.rec_ts) | (F.col("unq_rec_3") >= o.rec_ts))
    # Seeds are spanning, so no other row shares their ends.
    spanning = F.coalesce(F.col("l1") == "spn", F.lit(False))
    marked = t.filter(spanning)
    for e in ("5", "3"):
        end = ["id", f"chr_{e}", f"pos_{e}", f"str_{e}"]
        ends = cut_lineage(seed.select(*end).distinct())
        marked = join_stats(marked, ends.withColumn(f"__s{e}", F.lit(True)), end)
    t = marked.unionByName(t.filter(~spanning), allowMissingColumns=True)
    out = t.withColumn("hr_bpt", F.coalesce("__s5", "__s3", F.lit(False))).drop("__s5", "__s3")
    return out.fillna(0, ["rec_5", "unq_rec_5", "rec_3", "unq_rec_3"])


def _recurrent_whole(t: DataFrame, o: FusionOptions) -> DataFrame:
    """``recurrent`` where a task can hold a sample's ends: windows over each end of the spanning rows."""
    for e, p, q in (("5", "locus_id_3_1", "locus_id_5_2"), ("3", "locus_id_5_1", "locus_id_3_2")):
        end = ["id", f"chr_{e}", f"pos_{e}", f"str_{e}"]
        partner = F.when(F.col("__use"), F.struct(F.coalesce(p, F.lit("")), F.coalesce(q, F.lit(""))))
        t = with_group(t, end, {"__n": F.count(F.when(F.col("__use"), 1)), "__u": F.collect_set(partner)}, whole=True)
        n, u = F.when(F.col("__use"), F.col("__n")), F.size("__u").cast("bigint")
        t = t.withColumn(f"rec_{e}", F.coalesce(n, F.lit(0))).withColumn(f"unq_rec_{e}", F.when(n > 1, u).when(F.col("__use"), 1).otherwise(0)).drop("__n", "__u")
    seed = F.coalesce(F.col("__use") & ((F.col("unq_rec_5") >= o.rec_ts) | (F.col("unq_rec_3") >= o.rec_ts)), F.lit(False))
    t = t.withColumn("__seed", seed)
    for e in ("5", "3"):
        t = with_group(t, ["id", f"chr_{e}", f"pos_{e}", f"str_{e}"], {f"__s{e}": F.bool_or("__seed")}, whole=True)
    return t.withColumn("hr_bpt", F.col("__s5") | F.col("__s3")).drop("__seed", "__s5", "__s3")


def clustered(bpt: DataFrame, o: FusionOptions = FusionOptions()) -> DataFrame:
    """Proximal inverted or unspliced breakpoints that come in groups within one chimera."""
    use = (F.col("l1") == "spn") & (F.col("l2") == "prox") & ((F.col("topo") == "inv") | ~F.col("d2a"))
    if whole_groups(bpt, "id"):
        out = with_group(bpt, CHIMERA, {"__n": F.count(F.when(use, 1))}, whole=True)
    else:
        out = join_stats(bpt, bpt.filter(use).groupBy(*CHIMERA).agg(F.count(F.lit(1)).alias("__n")), CHIMERA)
    return out.withColumn("hc_bpt", F.coalesce(use & (F.col("__n") >= o.rec_chm), F.lit(False))).drop("__n")


CLASSES = ["sl", "bs", "ts", "sv"]  # fixed values; later classes win


def _class_rules() -> dict[str, Column]:
    c = F.col
    spn, near, far = c("l1") == "spn", c("l2") == "prox", c("l2") == "dist"
    return {
        "sl": c("hc_bpt") & ((c("topo") == "inv") | ~c("d2a")) & ~c("art") & spn & near, "bs": (c("topo") == "dup") & c("d2a") & ~c("art") & spn & near,
        "ts": c("hr_bpt") & spn & far, "sv": (c("hi_bpt") | (c("hq_bpt") & ~c("art"))) & spn & far,
    }


def link_breakpoints(bpt: DataFrame) -> DataFrame:
    """Breakpoints of a class that share ends get one link id (smallest end); ``l3`` is the last class.

    The four classes are separate graphs; they are solved together with the class in the node name.
    """
    rules = _class_rules()
    node = lambda k, e: F.concat_ws("|", F.lit(k), "id", f"chr_{e}", F.col(f"pos_{e}").cast("string"), f"str_{e}")
    edges = None
    for k, cond in rules.items():
        part = bpt.filter(cond).select(node(k, "5").alias("src"), node(k, "3").alias("dst"))
        edges = part if edges is None else edges.unionByName(part)
    comp = connected_components(edges)
    # The links of all classes meet the breakpoints in one join: whole rows move once, not once for each class.
    ends = reduce(DataFrame.unionByName, [bpt.filter(cond).select(*KEY, F.lit(k).alias("__k"), node(k, "5").alias("node")) for k, cond in rules.items()])
    of_class = lambda k: F.min(F.when(F.col("__k") == k, F.col("component"))).alias(f"{k}_link")
    links = ends.join(comp, "node").groupBy(*KEY).agg(*[of_class(k) for k in rules])
    out = join_stats(bpt, links, KEY).withColumns({f"{k}_link": F.when(cond, F.col(f"{k}_link")) for k, cond in rules.items()})
    return out.withColumn("l3", later_wins([(F.col(f"{k}_link").isNotNull(), F.lit(k)) for k in CLASSES], F.lit("nd")))


def chain_breakpoints(bpt: DataFrame) -> DataFrame:
    """Chimeras of a class connected through loci, reciprocal ends included, get one chain id."""
    obs = cut_lineage(bpt.filter(F.col("l3") != "nd").select("id", "l3", *CHIMERA[1:]).distinct())
    node = lambda c: F.when(F.col(c).isNotNull(), F.concat_ws("|", "l3", "id", c))
    l51, l31, l52, l32 = (node(c) for c in CHIMERA[1:])
    edge = lambda a, b: F.struct(a.alias("src"), b.alias("dst"))
    edges = obs.select(F.inline(F.array(edge(l51, l31), edge(l51, l32), edge(l31, l52), edge(l52, l32))))
    comp = connected_components(edges)
    seen = obs.select("id", F.col("l3").alias("__k"), "locus_id_5_1", "locus_id_3_1", l31.alias("__n")).distinct().join(comp, F.col("__n") == F.col("node")).drop("__n", "node")
    keys = ["id", "locus_id_5_1", "locus_id_3_1"]
    chains = seen.groupBy(*keys).agg(*[F.min(F.when(F.col("__k") == k, F.col("component"))).alias(f"{k}_chain") for k in CLASSES])
    return join_stats(bpt, chains, keys)


def call_breakpoints(jnc: DataFrame, features: DataFrame, frames: DataFrame, exons: DataFrame, masks: DataFrame, loci: DataFrame, cytobands: DataFrame, adjacent: DataFrame,
                     important: DataFrame, segdups: DataFrame | None = None, known: DataFrame | None = None, o: FusionOptions = FusionOptions()) -> DataFrame:
    """Junctions to called breakpoints with classes, links and chains."""
    # Every stage joins statistics of its input back to it, so it reads its input more than once:
    # the breakpoint table is stored between stages.
    b = cut_lineage(collapse_junctions(jnc))
    b = cut_lineage(transcript_distance(classify_breakpoints(b, features, frames), exons))
    b = cut_lineage(associate_loci(label_artifacts(b, masks, segdups, known, o), loci))
    tasks = whole_groups(b, "id")  # from here on stored by sample, if a task can hold one
    b = keep(levels(topology_breakpoints(b, loci, cytobands, adjacent, o)), "id", tasks)
    b = keep(clustered(recurrent(high_importance(high_quality(b, o), important, o), o), o), "id", tasks)
    return chain_breakpoints(cut_lineage(link_breakpoints(b)))


# ---------------------------------------------------------------- bundles and reports

def filter_bundle(bundle: Mapping[str, DataFrame], chosen: DataFrame) -> dict[str, DataFrame]:
    """Breakpoints and everything keyed by them, cut to the chosen breakpoints."""
    keys = chosen.select(*KEY).distinct()
    return {n: (chosen if n == "bpt" else df.join(keys, KEY, "left_semi")) for n, df in bundle.items()}


def class_bundle(bundle: Mapping[str, DataFrame], kind: str) -> dict[str, DataFrame]:
    return filter_bundle(bundle, bundle["bpt"].filter(F.col(f"{kind}_chain").isNotNull()))


def merge_bundles(bundles: Sequence[Mapping[str, DataFrame]]) -> dict[str, DataFrame]:
    out = dict(bundles[0])
    for b in bundles[1:]:
        out = {n: df.unionByName(b[n], allowMissingColumns=True) for n, df in out.items()}
    return out


def add_names(df: DataFrame, names: DataFrame) -> DataFrame:
    """Gene names and ids of the four loci; '' where a locus has no gene."""
    for s in ("5_1", "3_1", "5_2", "3_2"):
        n = names.select(F.col("locus_id").alias(f"locus_id_{s}"), F.col("gene_names").alias(f"gene_names_{s}"), F.col("gene_ids").alias(f"gene_ids_{s}"))
        df = df.join(n, f"locus_id_{s}", "left").fillna("", [f"gene_names_{s}", f"gene_ids_{s}"])
    return df


def add_cytobands(df: DataFrame, cytobands: DataFrame) -> DataFrame:
    for s in ("5_1", "3_1", "5_2", "3_2"):
        df = df.join(cytobands.select(F.col("locus_id").alias(f"locus_id_{s}"), F.col("cytoband").alias(f"cyt_{s}")), f"locus_id_{s}", "left")
    return df


def add_splice_totals(df: DataFrame, junctions: DataFrame) -> DataFrame:
    """Regular splice fragments that share an end with the breakpoint; 0 when there are none."""
    plus = F.col("strand") == "+"
    a, b = F.when(plus, F.col("start")).otherwise(F.col("end")), F.when(plus, F.col("end")).otherwise(F.col("start"))
    for e, p in (("5", a), ("3", b)):
        keys = ["id", f"chr_{e}", f"pos_{e}", f"str_{e}"]
        t = junctions.select("id", F.col("chr").alias(f"chr_{e}"), p.alias(f"pos_{e}"), F.col("strand").alias(f"str_{e}"), "nfrag").groupBy(*keys).agg(F.sum("nfrag").alias(f"tot_sp_jnc_{e}"))
        df = df.join(t, keys, "left").fillna(0, [f"tot_sp_jnc_{e}"])
    return df


def best_junction(jnc: DataFrame) -> DataFrame:
    """Most balanced high-quality junction of each breakpoint."""
    short, n = F.least("ovr_5", "ovr_3"), F.when(F.col("ovr_5") < F.col("ovr_3"), F.col("seg_5_len")).otherwise(F.col("seg_3_len"))
    penalty = F.when(F.col("hq_jnc"), 1.0).otherwise(1e4) * F.abs(short / n - 0.5)
    return first_row(jnc, KEY, [penalty.asc(), F.col("qname").asc()])


def read_totals(bpt: DataFrame, o: FusionOptions = FusionOptions()) -> DataFrame:
    """Encompassing and spanning reads of the chimera, reads per end, and the recurrence warning."""
    part = lambda k: F.sum(F.when(F.col("l1") == k, F.col("sum_jnc")).otherwise(0))
    if whole_groups(bpt, "id"):
        t = with_group(bpt, CHIMERA, {"tot_enc": part("enc"), "tot_jnc": part("spn")}, whole=True)
        for e in ("5", "3"):
            t = with_group(t, ["id", f"chr_{e}", f"pos_{e}", f"str_{e}", "l1"], {f"tot_jnc_{e}": F.sum("sum_jnc")}, whole=True)
        return t.withColumn("ts_warn", (F.col("unq_rec_5") >= o.rec_ts_warn) | (F.col("unq_rec_3") >= o.rec_ts_warn))
    # All totals are taken from the stored breakpoints, not from a table that already holds the joins before.
    base = cut_lineage(bpt)
    t = join_stats(base, base.groupBy(*CHIMERA).agg(part("enc").alias("tot_enc"), part("spn").alias("tot_jnc")), CHIMERA)
    for e in ("5", "3"):
        end = ["id", f"chr_{e}", f"pos_{e}", f"str_{e}", "l1"]
        t = join_stats(t, base.groupBy(*end).agg(F.sum("sum_jnc").alias(f"tot_jnc_{e}")), end)
    return t.withColumn("ts_warn", (F.col("unq_rec_5") >= o.rec_ts_warn) | (F.col("unq_rec_3") >= o.rec_ts_warn))


def report_structural(bundle: Mapping[str, DataFrame], names: DataFrame, cytobands: DataFrame, junctions: DataFrame, o: FusionOptions = FusionOptions(), only_spanning: bool = True, only_called: bool = True) -> DataFrame:
    """Breakpoints with their best junction, contig, names, cytobands and totals; one row per breakpoint."""
    t = read_totals(bundle["bpt"], o)
    if "ctg" in bundle:
        ctg = first_row(bundle["ctg"], KEY, [F.col("ctg_len").desc(), F.col("ctg_seq").asc()]).select(*KEY, "ctg_seq")
        t = join_stats(t, ctg, KEY)
    if only_called:
        valid = F.coalesce(F.col("gmap_valid") | F.col("mm2_valid"), F.lit(False)) if "gmap_valid" in t.columns else F.lit(False)
        order = [valid.desc(), F.col("orf").desc(), F.col("d2a").desc(), (F.col("l1") == "spn").desc(), F.col("sum_jnc").desc(), *[F.col(k).asc() for k in KEY]]
        lead = first_row(t, CHIMERA, order).select(*KEY).withColumn("__first", F.lit(True))
        t = join_stats(t, lead, KEY).filter(F.col("hq_bpt") | (F.col("hi_bpt") & F.coalesce("__first", F.lit(False)))).drop("__first")
    if only_spanning:
        t = t.filter(F.col("l1") == "spn")
    best = best_junction(bundle["jnc"])
    extra = [c for c in best.columns if c not in t.columns]
    t = join_stats(t, best.select(*KEY, *extra), KEY)
    return add_splice_totals(add_cytobands(add_names(t, names), cytobands), junctions)


def report_mini(bpt: DataFrame, names: DataFrame, cytobands: DataFrame, junctions: DataFrame, only_spliced: bool, only_spanning: bool = True) -> DataFrame:
    t = bpt.filter("d2a") if only_spliced else bpt
    t = t.filter(F.col("type") > -1) if only_spanning else t
    for e in ("5", "3"):
        t = with_group(t, ["id", f"chr_{e}", f"pos_{e}", f"str_{e}", "l1"], {f"tot_jnc_{e}": F.sum("sum_jnc")})
    return add_splice_totals(add_cytobands(add_names(t, names), cytobands), junctions)


# ---------------------------------------------------------------- contigs

def pair_alignments(aln: DataFrame, keys: Sequence[str] = ("contig_id",)) -> DataFrame:
    """The two segments of a contig as one breakpoint; contigs with other numbers are left out."""
    two = with_group(aln, keys, {"__n": F.count(F.lit(1))}).filter(F.col("__n") == 2)
    plus = F.col("strand") == "+"
    side = F.struct("first_base_q", "rname", "strand", "mapq", F.when(plus, F.col("last_base_r")).otherwise(F.col("first_base_r")).alias("out"), F.when(plus, F.col("first_base_r")).otherwise(F.col("last_base_r")).alias("into"))
    p = two.groupBy(*keys).agg(F.array_sort(F.collect_list(side)).alias("s"))
    a, b = (lambda f: F.col("s")[0][f]), (lambda f: F.col("s")[1][f])
    return p.select(*keys, a("rname").alias("x_chr_5"), a("out").alias("x_pos_5"), a("strand").alias("x_str_5"), a("mapq").alias("x_mapq_5"),
                    b("rname").alias("x_chr_3"), b("into").alias("x_pos_3"), b("strand").alias("x_str_3"), b("mapq").alias("x_mapq_3"))


def validate_breakpoints(bpt: DataFrame, aln: DataFrame, flag: str, max_dist: int, min_mapq: int) -> DataFrame:
    """Whether any contig of the breakpoint aligns back to it."""
    p = pair_alignments(aln, [*KEY, "contig_id"])
    ok = F.lit(True)
    for e in ("5", "3"):
        ok = ok & (F.col(f"chr_{e}") == F.col(f"x_chr_{e}")) & (F.col(f"str_{e}") == F.col(f"x_str_{e}")) & (F.abs(F.col(f"pos_{e}") - F.col(f"x_pos_{e}")) <= max_dist) & (F.col(f"x_mapq_{e}") >= min_mapq)
    v = p.groupBy(*KEY).agg(F.bool_or(ok).alias(flag))
    return join_stats(bpt, v, KEY).withColumn(flag, F.coalesce(flag, F.lit(False)))


def neo_junctions(contigs: DataFrame, chimeric: DataFrame, fused: DataFrame, transcripts: DataFrame) -> DataFrame:
    """Best neo-junction of each contig: in frame first, then longest RNA, then transcript tag."""
    c = contigs.filter(F.col("locus_id_5_1").isNotNull() & F.col("locus_id_3_1").isNotNull())
    x = chimeric.filter((F.col("x_rna_len_3") > -1) & (F.col("x_rna_len_5") == -1) & (F.col("x_prot_pos_3") > 1))
    j = c.join(x, ["sv_chain", "contig_id"]).join(fused, ["sv_chain", "contig_id"]).filter(F.col("transcript_id") == F.col("transcript_id_5"))
    t = lambda e: transcripts.select(F.col("transcript_id").alias(f"transcript_id_{e}"), F.col("gene_id").alias(f"gene_id_{e}"), F.col("gene_name").alias(f"gene_name_{e}"), *(["tags"] if e == "5" else []))
    j = j.join(t("5"), "transcript_id_5", "left").join(t("3"), "transcript_id_3", "left")
    rank = F.create_map(*[F.lit(v) for i, k in enumerate(["ap1", "ap2", "ap3", "rev", "cds", "nil"]) for v in (k, i)])[F.col("tags")]
    return first_row(j, ["sv_chain", "contig_id"], [F.col("inframe_3").desc_nulls_last(), F.col("x_rna_len_3").desc(), rank.asc_nulls_last(), F.col("transcript_id_5").asc(), F.col("transcript_id_3").asc()])


# ---------------------------------------------------------------- statistics

def library_rates(bpt: DataFrame, fragments: DataFrame) -> DataFrame:
    """Artifact, duplication, ligation, trans- and back-splice and stem-loop rates per sample.

    ``fragments``: id, fragments (aligned reads / 2).  One pass of conditional sums.
    """
    c = F.col
    spn, enc, far, near, nd = c("l1") == "spn", c("l1") == "enc", c("l2") == "dist", c("l2") == "prox", c("l3") == "nd"
    gtag = (F.substring("mot_5", 7, 2) == "GT") & (F.substring("mot_3", 7, 2) == "AG")
    total = lambda cond, v="sum_jnc": F.sum(F.when(cond, c(v)))
    sums = {
        "art": total(c("art")), "dup_u": total((c("art_5") == "nil") & (c("art_3") == "nil") & far & nd & ~c("d2a"), "unq_sum_jnc"), "dup_t": total((c("art_5") == "nil") & (c("art_3") == "nil") & far & nd & ~c("d2a")),
        "sd_nd": total(spn & far & nd), "d_nd": total(~c("art") & far & nd), "sp_nd": total(spn & near & nd), "p_nd": total(~c("art") & near & nd),
        "sd_lig": total(spn & far & nd & ~c("d2a")), "sp_lig": total(spn & near & nd & ~c("d2a")), "sd": total(spn & far), "ed": total(enc & far), "sd_gt": total(spn & far & gtag), "ed_gt": total(enc & far & gtag),
        "ts": total(c("l3") == "ts"), "sl": total(c("l3") == "sl"), "bs": total(spn & near & c("d2a") & (c("topo") == "dup")),
    }
    s = bpt.groupBy("id").agg(*[v.alias(f"_{k}") for k, v in sums.items()]).join(fragments.select("id", "fragments"), "id")
    x = lambda k: c(f"_{k}").cast("double")
    div = lambda a, b: a / F.nullif(b, F.lit(0.0))
    eff = c("fragments").cast("double")
    s_dist, s_prox = div(x("sd_nd"), x("d_nd")), div(x("sp_nd"), x("p_nd"))
    exp_rate, obs_rate = div(x("ed_gt"), x("ed")), div(x("sd_gt"), x("sd"))
    return s.select(
        "id", div(F.coalesce(x("art"), F.lit(0.0)), eff).alias("art_rte"), (1 - div(x("dup_u"), x("dup_t"))).alias("dup_rte"), div(div(x("sd_lig"), s_dist) + div(x("sp_lig"), s_prox), eff).alias("lig_rte"),
        div(div(F.coalesce(x("ts"), F.lit(0.0)), s_dist), eff).alias("ts_rte_lo"), div(div(F.greatest(x("sd_gt") - x("sd") * exp_rate, F.lit(0.0)), s_dist), eff).alias("ts_rte_hi"),
        F.log2(F.nullif(div(obs_rate, exp_rate), F.lit(0.0))).alias("ts_lfc"), div(div(F.coalesce(x("bs"), F.lit(0.0)), s_prox), eff).alias("bs_rte"), div(F.coalesce(x("sl"), F.lit(0.0)), eff).alias("sl_rte"),
        s_prox.alias("s2e_prox_rte"), s_dist.alias("s2e_dist_rte"))


def library_fragments(contigs: DataFrame) -> DataFrame:
    """Aligned reads over all contigs, halved."""
    return contigs.groupBy("id").agg((F.sum("reads") / 2).alias("fragments"))


def breakpoint_survey(bpt: DataFrame) -> DataFrame:
    """Counts and mean qualities per class of breakpoint."""
    keys = [F.col(k) for k in ("id", "l1", "l2", "l3", "topo", "dst", "d2a")]
    keys += [(F.col(f"cls_{e}") != ".").alias(f"gene_{e}") for e in ("5", "3")] + [(F.col(f"art_{e}") == "nil").alias(f"ok_{e}") for e in ("5", "3")]
    means = ["hq_sum_jnc", "unq_sum_jnc", "sum_jnc", *[f"{q}_{e}" for q in ("avg_err", "avg_low", "max_ovr", "unq_ovr") for e in ("5", "3")]]
    flags = ["orf", "hq_bpt", "hi_bpt"]
    return bpt.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *[F.avg(m).alias(m) for m in means], *[F.avg(F.col(f).cast("double")).alias(f) for f in flags], F.avg((F.col("type") > -1).cast("double")).alias("spn"))


LOCUS_COLUMNS = ["enc_dist_lig", "enc_prox_lig", "spn_dist_lig", "spn_dist_mot", "spn_prox_lig", "spn_prox_mot"]  # fixed values


def locus_counts(bpt: DataFrame, loci: DataFrame) -> DataFrame:
    """Reads per locus by level and splice class for both ends; loci without reads are 0."""
    kind = F.concat_ws("_", "l1", "l2", F.when(F.col("d2a"), "mot").otherwise("lig"))
    out = grid(bpt.select("id").distinct(), loci.select("locus_id"))
    for e in ("5", "3"):
        p = bpt.select("id", F.col(f"locus_id_{e}_1").alias("locus_id"), kind.alias("k"), "sum_jnc").groupBy("id", "locus_id").pivot("k", LOCUS_COLUMNS).agg(F.sum("sum_jnc"))
        p = p.select("id", "locus_id", *[F.col(c).alias(f"{c}_{e}") for c in LOCUS_COLUMNS])
        out = out.join(p, ["id", "locus_id"], "left")
    return out.fillna(0)


def topology_signature(bpt: DataFrame) -> DataFrame:
    """Chimeras per topology and distance with frequencies; empty cells are 0."""
    one = first_row(bpt, CHIMERA, [F.col("topo").asc(), F.col("dst").asc()])
    n = one.groupBy("id", "topo", "dst").agg(F.count(F.lit(1)).alias("event_n"))
    far = [d for d in DISTANCES if d not in ("frg", "loc")]
    # A sample has few cells: they are held in its row, from which the empty ones come too.
    per = n.groupBy("id").agg(F.collect_list(F.struct("topo", "dst", "event_n")).alias("__c"), F.sum("event_n").alias("__t"))
    cells = per.select("id", "__c", "__t", F.explode(F.array(*[F.lit(t) for t in TOPOLOGIES])).alias("topo")).select("*", F.explode(F.array(*[F.lit(x) for x in far])).alias("dst"))
    own = F.filter("__c", lambda x: F.col("id").isNotNull() & (x["topo"] == F.col("topo")) & (x["dst"] == F.col("dst")))
    event_n = F.coalesce(F.try_element_at(own, F.lit(1))["event_n"], F.lit(0).cast("bigint"))
    return cells.select("id", "topo", "dst", event_n.alias("event_n"), F.when(event_n > 0, event_n / F.col("__t")).otherwise(0.0).alias("event_frq"))


def chimera_signature(bpt: DataFrame) -> DataFrame:
    """Distinct chimeras per distance and topology, all cells present."""
    n = bpt.groupBy("id", "dst", "topo").agg(F.count_distinct(*[F.coalesce(c, F.lit("")) for c in CHIMERA]).alias("n"))
    cells = bpt.select("id").distinct().select("id", F.explode(F.array(*[F.lit(x) for x in DISTANCES])).alias("dst")).select("id", "dst", F.explode(F.array(*[F.lit(t) for t in TOPOLOGIES])).alias("topo"))
    return cells.join(n, ["id", "dst", "topo"], "left").fillna(0, ["n"])
