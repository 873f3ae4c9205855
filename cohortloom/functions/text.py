"""String and sequence functions as Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values ----------------------------------------------------------------------------

AMINO_ACIDS = {
    "Cys": "C", "Asp": "D", "Ser": "S", "Gln": "Q", "Lys": "K", "Ile": "I", "Pro": "P", "Thr": "T", "Phe": "F", "Asn": "N",
    "Gly": "G", "His": "H", "Leu": "L", "Arg": "R", "Trp": "W", "Ala": "A", "Val": "V", "Glu": "E", "Tyr": "Y", "Met": "M",
}
IUPAC = {
    "A": "A", "C": "C", "G": "G", "T": "T", "AC": "M", "AG": "R", "AT": "W", "CG": "S", "CT": "Y", "GT": "K",
    "ACG": "V", "ACT": "H", "AGT": "D", "CGT": "B", "ACGT": "N",
}


def lookup(table: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in table.items() for x in kv])


def reverse_complement(seq: Column) -> Column:
    return F.reverse(F.translate(seq, "ACGTacgt", "TGCAtgca"))


def letter_share(seq: Column, letters: str) -> Column:
    """Share of the letters in the sequence (NULL for an empty one)."""
    kept = F.length(F.regexp_replace(seq, f"[^{letters}]", ""))
    return F.when(F.length(seq) > 0, kept / F.length(seq))


def short_protein(hgvsp: Column) -> Column:
    """Three-letter amino acids to one letter, ``p.`` dropped; NULL becomes ''."""
    out = F.regexp_replace(hgvsp, "p[.]", "")
    for long, short in AMINO_ACIDS.items():
        out = F.replace(out, F.lit(long), F.lit(short))
    return F.coalesce(out, F.lit(""))


def amino_acid_position(hgvsp: Column) -> Column:
    found = F.regexp_extract(hgvsp, r"^(?i)p\.[A-Z]{1,6}([0-9]{1,4})", 1)
    return F.when(found != "", found.cast("int"))


def iupac_call(call: Column) -> Column:
    """Genotype call such as A/C to its IUPAC letter; UNKNOWN is N."""
    bases = F.replace(F.replace(call, F.lit("/"), F.lit("")), F.lit("UNKNOWN"), F.lit("ACGT"))
    return lookup(IUPAC)[bases]


def trinucleotide(before: Column, ref: Column, after: Column) -> Column:
    return F.concat(before, ref, after)


def sbs96(before: Column, ref: Column, alt: Column, after: Column) -> Column:
    """Substitution class with its flanks, purine references read from the other strand.

    NULL unless reference and alternative are single bases.
    """
    snv = ref.isin(*"ACGT") & alt.isin(*"ACGT")
    flip = ref.isin("A", "G")
    five = F.when(flip, reverse_complement(after)).otherwise(before)
    three = F.when(flip, reverse_complement(before)).otherwise(after)
    r = F.when(flip, reverse_complement(ref)).otherwise(ref)
    a = F.when(flip, reverse_complement(alt)).otherwise(alt)
    return F.when(snv, F.concat(five, F.lit("["), r, F.lit(">"), a, F.lit("]"), three))


def triplet_score(seq: Column) -> Column:
    """Sum over triplets of c(c-1)/2, c the count of a triplet in the sequence.

    Counts come from positions: triplets equal to one seen before add one each per earlier copy.
    """
    n = F.length(seq) - 2
    triplets = F.when(n >= 1, F.transform(F.sequence(F.lit(1), n), lambda i: F.substring(seq, i, F.lit(3))))
    kinds = F.array_distinct(triplets)

    def pairs(k: Column) -> Column:
        c = F.size(F.filter(triplets, lambda t: t == k))
        return (c * (c - 1) / 2).cast("double")

    return F.aggregate(F.transform(kinds, pairs), F.lit(0.0), lambda a, x: a + x)


def low_complexity(seq: Column) -> Column:
    """Triplet score over the most a sequence of this length can have (one repeated letter)."""
    n = F.length(seq) - 2
    return F.when(n >= 2, triplet_score(seq) / (n * (n - 1) / 2))


def cigar_sum(cigar: Column, ops: str) -> Column:
    """Total length of the given CIGAR operations (0 if none)."""
    lengths = F.regexp_extract_all(cigar, F.lit(rf"([0-9]+)[{ops}]"), F.lit(1))
    return F.aggregate(lengths, F.lit(0), lambda a, x: a + x.cast("int"))


def clip_left(cigar: Column) -> Column:
    found = F.regexp_extract(cigar, r"^([0-9]+)[SH]", 1)
    return F.when(found == "", F.lit(0)).otherwise(found.cast("int"))


def clip_right(cigar: Column) -> Column:
    found = F.regexp_extract(cigar, r"([0-9]+)[SH]$", 1)
    return F.when(found == "", F.lit(0)).otherwise(found.cast("int"))


def query_width(cigar: Column) -> Column:
    return cigar_sum(cigar, "MI=X")


def reference_width(cigar: Column) -> Column:
    return cigar_sum(cigar, "MDN=X")


def first_aligned(pos: Column, cigar: Column, strand: Column) -> Column:
    """First base in reading direction."""
    return F.when(strand == "-", pos + reference_width(cigar) - 1).otherwise(pos)


def last_aligned(pos: Column, cigar: Column, strand: Column) -> Column:
    return F.when(strand == "-", pos).otherwise(pos + reference_width(cigar) - 1)


def chromosome_code(chr_: Column) -> Column:
    """chr1 -> 1 ... chrX -> 23, chrY -> 24."""
    bare = F.regexp_replace(chr_, "^chr", "")
    return F.when(bare == "X", F.lit(23)).when(bare == "Y", F.lit(24)).when(bare.rlike("^[0-9]+$"), bare.cast("int"))


def normalise_mnv(pos: Column, ref: Column, alt: Column) -> tuple[Column, Column, Column]:
    """Drop the shared first base of equal-length multi-base alleles and move the start by one."""
    anchored = (F.length(ref) == F.length(alt)) & (F.length(ref) > 1) & (F.substring(ref, 1, 1) == F.substring(alt, 1, 1))
    tail = lambda c: F.expr("''") if c is None else F.substring(c, F.lit(2), F.length(c))
    return (
        F.when(anchored, pos + 1).otherwise(pos),
        F.when(anchored, tail(ref)).otherwise(ref),
        F.when(anchored, tail(alt)).otherwise(alt),
    )


def gtf_attribute(attributes: Column, name: str) -> Column:
    """Value of one attribute of a gene-model line, '' when absent; quotes are dropped."""
    return F.regexp_replace(F.regexp_extract(attributes, rf"(?:^|[; ]){name}[ =]([^;]+)", 1), '"', "")


def collapse_tags(attributes: Column) -> Column:
    """Repeated ``tag "x"`` entries become one ``tags "a,b"`` entry."""
    tags = F.regexp_extract_all(attributes, F.lit(r'tag "([^"]+)"'), F.lit(1))
    bare = F.regexp_replace(attributes, r'\s*tag "[^"]+";?', "")
    return F.when(F.size(tags) > 0, F.concat(bare, F.lit(' tags "'), F.array_join(tags, ","), F.lit('";'))).otherwise(attributes)


def blank_to_null(c: Column) -> Column:
    return F.when(c != "", c)


def null_to_blank(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def percent(c: Column) -> Column:
    """0.25 -> '25%'."""
    return F.format_string("%.0f%%", c * 100)
