"""Triage rule sets as data: every entry is a list of tiers, a row passes if any tier holds.

A tier is a list of SQL conditions that must all hold.  ``goi`` stands for membership of the row's
gene in the matching genes-of-interest list.  The numbers are fixed values.
"""

from __future__ import annotations

# ---- fixed values ----------------------------------------------------------------------------

LIKELY_BENIGN = ["Benign", "Benign/Likely_benign", "Likely_benign"]
UNLIKELY_BENIGN = ["Pathogenic/Likely_pathogenic", "Pathogenic", "Likely_pathogenic", "drug_response"]


def _in(column: str, values: list[str]) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return f"coalesce({column} in ({listed}), false)"


BENIGN = _in("clinvar", LIKELY_BENIGN)
HARMFUL = _in("clinvar", UNLIKELY_BENIGN)
IMPORTANT_IMPACT = _in("impact", ["HIGH", "MODERATE"])

#: Outside / inside long short-tandem repeats and repeat-masked indels.
CLEAN = "((not str or str_len < 4) and (not is_indel or rmsk_hit is null))"
CLEAN_WIDER = "((not str or str_len < 5) and (not is_indel or rmsk_hit is null))"
REPEAT = "((str and str_len >= 4) or (is_indel and rmsk_hit is not null))"

#: Positions whose variants count as high impact whatever their predicted consequence.
HOTSPOTS = [
    "(chr = 'chr5' and pos = 1295135 and alt = 'A')",
    "(chr = 'chr5' and pos = 1295113 and alt = 'A')",
    "(chr = 'chr17' and pos = 7675994)",
    "(chr = 'chr17' and pos = 7674859)",
]
PROMOTER_HOTSPOT = (
    "((gene_name = 'TERT' and chr = 'chr5' and pos = 1295135 and alt = 'A')"
    " or (chr = 'chr5' and pos = 1295113 and alt = 'A'))"
)

_MQRS = "((mqrs is null and aft > 0.9) or (mqrs is not null and mqrs > -3))"
_NORMAL_SHARE = "adn / (dpn + 0.1) <= 0.0066"
_ABSENT_IN_NORMAL = "(adn = 0 or (adn = 1 and afn <= 0.006) or (adn = 2 and afn <= 0.004))"
_FWD = "(adt_fwd > 1 or (adt_fwd = 1 and adt < 10))"
_REV = "(adt_rev > 1 or (adt_rev = 1 and adt < 10))"
_ONE_FWD_LOW_BIAS = "(adt_fwd = 1 and adt <= 12 and sor < 1.5)"


def _support(*pairs: tuple[int, float], alone: int | None = None) -> str:
    """More reads allow a lower allele fraction."""
    parts = [f"(adt > {n} and aft > {f})" for n, f in pairs]
    return "(" + " or ".join(parts + ([f"adt > {alone}"] if alone is not None else [])) + ")"


_SUPPORT_CLEAN = _support((2, 0.021), (3, 0.019), (4, 0.017), (5, 0.015), (6, 0.013), (7, 0.011), alone=8)
_SUPPORT_REPEAT = _support((5, 0.027), (6, 0.025), (7, 0.023), (8, 0.021))

SOMATIC_DATA_TN = [
    [CLEAN, "tlod > 12", "nlod > 18", "(flod > 9 or (adn = 0 and dpn >= 100))", "xfet < 1e-2", "adt_fwd >= 6",
     "adt_rev >= 6", "adn <= 2", "aft > afn * 6"],
    [REPEAT, "tlod > 24", "nlod > 24", "(flod > 12 or (adn = 0 and dpn >= 100))", "xfet < 5e-3", "adt_fwd >= 9",
     "adt_rev >= 9", "adn <= 1", "aft > afn * 8"],
    [CLEAN, "adt > 4", f"(adn <= 3 or {_NORMAL_SHARE})", "aft >= 0.024",
     "(afn < 0.012 or (afn < 0.02 and adn = 1) or (afn < 0.025 and adn = 0))", "tlod > 6", "nlod > 6", "flod > 3",
     "xfet < 0.05", f"({_FWD} or {_ONE_FWD_LOW_BIAS})", f"({_REV} or {_ONE_FWD_LOW_BIAS})", "sor < 4", _MQRS, "mqs > 24.75"],
    [REPEAT, "adt > 9", f"(adn <= 1 or {_NORMAL_SHARE})", "aft >= 0.045", "afn < 0.005", "tlod > 12", "nlod > 12",
     "flod > 6", "xfet < 0.025", "adt_fwd > 2", "adt_rev > 2", "sor < 3.5", _MQRS, "mqs > 27"],
]
SOMATIC_DATA_TO = [
    [CLEAN, "adt > 8", "aft >= 0.04", _FWD, _REV, "sor < 4", _MQRS, "mqs > 25"],
    [REPEAT, "adt > 9", "aft >= 0.05", "adt_fwd > 2", "adt_rev > 2", "sor < 3.5", _MQRS, "mqs > 27"],
]
_KNOWN = f"(cosmic_cnt > 25 or goi or {HARMFUL})"
_NOT_RECURRENT = f"(all_pon >= 3 or {HARMFUL})"
SOMATIC_ANNO_TN = [
    [_KNOWN, _NOT_RECURRENT, _ABSENT_IN_NORMAL, CLEAN, _SUPPORT_CLEAN, "tlod > 6", "nlod > 6", "adt_fwd >= 1",
     "adt_rev >= 1", "((sblr < 2.5 and sor < 3.5) or sor < 1.5)", "mqrs is not null", "mqrs > -2.5", "mqs > 26.0", "ecnt < 5"],
    [_KNOWN, _NOT_RECURRENT, _ABSENT_IN_NORMAL, REPEAT, _SUPPORT_REPEAT, "tlod > 9", "nlod > 9", "adt_fwd >= 2",
     "adt_rev >= 2", "((sblr < 1.75 and sor < 3.0) or sor < 1.5)", "mqrs is not null", "mqrs > -2.0", "mqs > 26.0", "ecnt < 3"],
]
SOMATIC_ANNO_TO = [
    [_KNOWN, CLEAN_WIDER, "adt > 2", "aft > 0.02", "adt_fwd >= 1", "adt_rev >= 1", "sor < 2.5", "mqrs is not null",
     "mqrs > -0.5", "mqs > 26", "gnomad_af = 0", "kg_af = 0", "pon is null"],
]
_RARE_OR_HARMFUL = f"((gnomad_af <= 0.005 and kg_af <= 0.005) or {HARMFUL})"
GERMLINE_TN = [[f"not {BENIGN}", "afn >= 0.2", "adn >= 8", "dpn >= 40", _RARE_OR_HARMFUL]]
GERMLINE_TO = [[f"not {BENIGN}", _RARE_OR_HARMFUL]]

#: Tumor-only assay: stricter evidence without a normal.
SOMATIC_DATA_TO_STRICT = [
    [CLEAN, "adt > 6", "aft >= 0.05", _FWD, _REV, "sor < 4", _MQRS, "mqs > 25",
     "((dbsnp is null and gnomad_af < 0.01) or (dbsnp is not null and gnomad_af < 0.001))"],
    [REPEAT, "adt > 12", "tlod > 12", "aft >= 0.05", "adt_fwd > 2", "adt_rev > 2", "sor < 3.5",
     "((mqrs is null and aft > 0.9) or (mqrs is not null and mqrs > -2.5))", "mqs > 27", "gnomad_af < 0.01"],
]

#: One custom rule replaces all others (pediatric study).
_POPULATION = "(gnomad_af = 0 or (gnomad_af < 0.001 and aft > 0.025))"
_XFET = "(xfet < 0.05 or (xfet < 0.1 and adn = 0 and tlod > 7.5 and nlod > 7.5))"
_HARD_TN = ["tlod > 6", "nlod > 6", "flod > 1.5", "aft >= 0.02", "afn < 0.02", "adt >= 7", "adn < 7", _XFET, "aft > afn * 10",
            "mqs > 23", _POPULATION]
PEDIATRIC_SOMATIC_TN = [
    [*_HARD_TN, f"({IMPORTANT_IMPACT} or {PROMOTER_HOTSPOT})", "(ccf >= 0.05 or ccf is null)", "adt_fwd > 0", "adt_rev > 0",
     "sor < 4", "mqrs is not null", "mqrs > -3.0"],
]
PEDIATRIC_SOMATIC_TO = [
    ["goi", "adn is null", "tlod > 5", f"({IMPORTANT_IMPACT} or {PROMOTER_HOTSPOT})", "aft >= 0.02", "(ccf >= 0.05 or ccf is null)",
     "adt >= 10", "adt_fwd > 0", "adt_rev > 0", "sor < 4", "mqrs is not null", "mqrs > -3", "mqs is not null", "mqs > 23", _POPULATION],
]
PEDIATRIC_GERMLINE_TN = [
    ["not isnan(aft)", "goi", f"not {BENIGN}", "adt > 2", "afn > 2", "aft > 0.1", "afn > 0.1"],
    ["not isnan(aft)", "adt > 8", "aft > 0.2", "afn >= 0.2", "adn >= 8", "dpn >= 40", f"not {BENIGN}",
     f"({HARMFUL} or gnomad_af <= 4e-5 or kg_af <= 4e-5)", IMPORTANT_IMPACT, "sor < 4",
     f"((gnomad_af < 0.005 and kg_af <= 0.005) or {HARMFUL})"],
]
PEDIATRIC_GERMLINE_TO = [
    ["goi", "adn is null", f"not {BENIGN}", f"({HARMFUL} or gnomad_af <= 0.005 or kg_af <= 0.005)", IMPORTANT_IMPACT, "aft > 0.2", "adt > 0.2"],
]
PROSTATE_SOMATIC_TN = [[*_HARD_TN, IMPORTANT_IMPACT]]
PROSTATE_SOMATIC_TO = [["goi", "adn is null", "tlod > 5", IMPORTANT_IMPACT, "aft >= 0.02", "adt >= 10", _POPULATION]]

#: Older sets: slightly other thresholds.
OLD_SOMATIC_DATA_TN = [
    SOMATIC_DATA_TN[0],
    [REPEAT, "tlod > 24", "nlod > 24", "(flod > 12 or (adn = 0 and dpn >= 120))", "xfet < 5e-3", "adt_fwd >= 9",
     "adt_rev >= 9", "adn <= 1", "aft > afn * 8"],
    [CLEAN, "adt > 4", f"(adn <= 3 or {_NORMAL_SHARE})", "aft >= 0.024", "(afn < 0.012 or (afn < 0.02 and adn = 1))", "tlod > 6",
     "nlod > 6", "flod > 3", "xfet < 0.05", _FWD, _REV, "sor < 4", _MQRS, "mqs > 25"],
    SOMATIC_DATA_TN[3],
]
OLD_SOMATIC_ANNO_TN = [
    [_KNOWN, _NOT_RECURRENT, _ABSENT_IN_NORMAL, CLEAN, _SUPPORT_CLEAN, "tlod > 6", "nlod > 6", "adt_fwd >= 1", "adt_rev >= 1",
     "sblr < 2.0", "sor < 3.5", "mqrs is not null", "mqrs > -2.5", "mqs > 26.0", "ecnt < 5"],
    [_KNOWN, _NOT_RECURRENT, _ABSENT_IN_NORMAL, REPEAT, _SUPPORT_REPEAT, "tlod > 9", "nlod > 9", "adt_fwd >= 2", "adt_rev >= 2",
     "sblr < 1.5", "sor < 3.0", "mqrs is not null", "mqrs > -2.0", "mqs > 26.0", "ecnt < 3"],
]
#: A caller that reports no strand counts or quality ranks.
CALLER_SOMATIC_DATA_TN = [
    [CLEAN, "tlod > 12", "nlod > 18", "xfet < 1e-2", "adn <= 2", "aft > afn * 6"],
    [REPEAT, "tlod > 24", "nlod > 24", "xfet < 5e-3", "adn <= 1", "aft > afn * 8"],
    [CLEAN, "adt > 4", f"(adn <= 3 or {_NORMAL_SHARE})", "aft >= 0.024", "(afn < 0.012 or (afn < 0.02 and adn = 1))", "tlod > 6",
     "nlod > 6", "xfet < 0.05", "mqrs is null", "aft > 0.9"],
    [REPEAT, "adt > 9", f"(adn <= 1 or {_NORMAL_SHARE})", "aft >= 0.045", "afn < 0.005", "tlod > 12", "nlod > 12", "xfet < 0.025",
     "mqrs is null", "aft > 0.9"],
]
CALLER_SOMATIC_ANNO_TN = [
    [_KNOWN, _NOT_RECURRENT, _ABSENT_IN_NORMAL, CLEAN, _SUPPORT_CLEAN, "tlod > 6", "nlod > 6", "ecnt < 5"],
    [_KNOWN, _NOT_RECURRENT, _ABSENT_IN_NORMAL, REPEAT, _SUPPORT_REPEAT, "tlod > 9", "nlod > 9", "ecnt < 3"],
]
_NOISE = {"tn": ["(nn < 0.010 or cosmic_cnt > 100)", "(tn < 0.023 or cosmic_cnt > 100)"],
          "to": ["(nn < 0.01 or cosmic_cnt > 100)", "(tn < 0.05 or cosmic_cnt > 100)"]}
OLD_PEDIATRIC_SOMATIC_TN = [[*PEDIATRIC_SOMATIC_TN[0], *_NOISE["tn"]]]
OLD_PEDIATRIC_SOMATIC_TO = [[*PEDIATRIC_SOMATIC_TO[0][1:], *_NOISE["to"]]]

#: Default regular expressions of ``filter_dataset``.
FILTER_RULES = {
    "somatic": "annotation|consequence|evidence|artifact|manual|custom",
    "germline": "annotation|consequence|evidence|goi|manual|custom",
    "structural": "evidence|manual|custom",
    "fusion": "evidence|manual|custom",
}
