"""Rule-based triage of event tables.

A rule is a function of no data: it returns a boolean Column, TRUE = the row fails.  Before the
rules run, ``prepare`` adds the memberships they need by joins (gene flags, repeated phase sets,
fusion gene lists); the rules of a table are then evaluated in one projection.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.dataset import CohortDataset
from cohortloom.operators import rulesets as R
from cohortloom.operators.common import join_stats

Rule = Callable[[], Column]
RULE_ORDER = {
    "somatic": ["annotation", "evidence", "consequence", "goi", "artifact", "phase", "custom"],
    "germline": ["annotation", "evidence", "consequence", "goi", "custom"],
    "structural": ["annotation", "evidence", "custom"],
    "fusion": ["annotation", "evidence", "custom"],
}


def passes(tiers: list[list[str]], goi: str = "false") -> Column:
    """Any tier whose conditions all hold.  ``goi`` is the SQL text of the gene-list membership."""
    named = [[re.sub(r"\bgoi\b", f"({goi})", cond) for cond in tier] for tier in tiers]
    text = " or ".join("(" + " and ".join(tier) + ")" for tier in named)
    return F.expr(text)


def _fails(tiers, goi="false") -> Column:
    return ~passes(tiers, goi)


def _never() -> Column:
    return F.lit(False)


def _by_normal(without_normal: Column, with_normal: Column) -> Column:
    return F.when(F.col("adn").isNull(), without_normal).otherwise(with_normal)


SOM, GER = "__somatic_goi", "__germline_goi"


def _evidence_somatic(data_tn=R.SOMATIC_DATA_TN, anno_tn=R.SOMATIC_ANNO_TN, data_to=R.SOMATIC_DATA_TO,
                      anno_to=R.SOMATIC_ANNO_TO) -> Column:
    return _by_normal(
        _fails(data_to) & _fails(anno_to, SOM), _fails(data_tn) & _fails(anno_tn, SOM)
    )


def _evidence_germline() -> Column:
    return _by_normal(_fails(R.GERMLINE_TO), _fails(R.GERMLINE_TN))


def _consequence() -> Column:
    hot = F.coalesce(F.expr(" or ".join(R.HOTSPOTS)), F.lit(False))
    return ~(hot | F.expr(R.IMPORTANT_IMPACT))


@dataclass(frozen=True)
class RuleSet:
    """Rules per table; a set inherits every rule it does not override."""

    name: str
    rules: Mapping[str, Mapping[str, Rule]] = field(default_factory=dict)
    parent: "RuleSet | None" = None

    def get(self, table: str, rule: str) -> Rule:
        own = self.rules.get(table, {}).get(rule)
        if own is not None:
            return own
        return self.parent.get(table, rule) if self.parent else _never

    def columns(self, table: str) -> dict[str, Column]:
        return {r: self.get(table, r)() for r in RULE_ORDER[table]}


DEFAULT = RuleSet("default", {
    "somatic": {
        "annotation": lambda: ~F.col("__anno_goi"),
        "evidence": _evidence_somatic,
        "consequence": _consequence,
        "goi": lambda: ~F.col(SOM),
        "artifact": lambda: F.col("__somatic_art"),
        "phase": lambda: F.col("__phase_repeat"),
    },
    "germline": {
        "annotation": lambda: ~F.col("__anno_goi"),
        "evidence": _evidence_germline,
        "consequence": _consequence,
        "goi": lambda: ~F.col(GER),
    },
    "structural": {
        "annotation": lambda: ~(F.col("__known_1") | F.col("__known_2")),
        "evidence": lambda: F.col("caller_filter").isNull(),
    },
    "fusion": {
        "annotation": lambda: ~F.col("__any_known"),
        "evidence": lambda: ~((F.col("hq_bpt") & (F.col("mm2_valid") | F.col("gmap_valid"))) | F.col("hi_bpt")),
    },
})

_OFF = {t: {r: _never for r in rules} for t, rules in RULE_ORDER.items()}
for _t in ("structural", "fusion"):
    _OFF[_t] = {"evidence": _never}

PEDIATRIC = RuleSet("pediatric", {
    **_OFF,
    "somatic": {**_OFF["somatic"], "custom": lambda: _by_normal(_fails(R.PEDIATRIC_SOMATIC_TO, SOM), _fails(R.PEDIATRIC_SOMATIC_TN))},
    # The gene list is matched by gene id (matching the name against ids would never hold).
    "germline": {**_OFF["germline"], "custom": lambda: _by_normal(_fails(R.PEDIATRIC_GERMLINE_TO, GER), _fails(R.PEDIATRIC_GERMLINE_TN, GER))},
}, DEFAULT)
PROSTATE = RuleSet("prostate", {
    **_OFF,
    "somatic": {**_OFF["somatic"], "custom": lambda: _by_normal(_fails(R.PROSTATE_SOMATIC_TO, SOM), _fails(R.PROSTATE_SOMATIC_TN))},
}, DEFAULT)
TUMOR_ONLY = RuleSet("tumor_only", {"somatic": {"evidence": lambda: _evidence_somatic(data_to=R.SOMATIC_DATA_TO_STRICT)}}, DEFAULT)
OLD_DEFAULT = RuleSet("old_default", {"somatic": {
    "evidence": lambda: _evidence_somatic(R.OLD_SOMATIC_DATA_TN, R.OLD_SOMATIC_ANNO_TN),
    "artifact": lambda: F.col("__somatic_art") | F.coalesce(F.col("ecnt") >= 10, F.lit(False)),
    "phase": lambda: F.col("__phase_lesser"),
    "annotation": _never, "goi": _never,
}}, DEFAULT)
OLD_CALLER = RuleSet("old_caller", {"somatic": {
    "evidence": lambda: _evidence_somatic(R.CALLER_SOMATIC_DATA_TN, R.CALLER_SOMATIC_ANNO_TN),
}}, OLD_DEFAULT)
OLD_PEDIATRIC = RuleSet("old_pediatric", {
    "somatic": {**_OFF["somatic"], "custom": lambda: _by_normal(_fails(R.OLD_PEDIATRIC_SOMATIC_TO), _fails(R.OLD_PEDIATRIC_SOMATIC_TN))},
}, PEDIATRIC)

RULE_SETS: dict[str, RuleSet] = {
    s.name: s for s in (DEFAULT, PEDIATRIC, PROSTATE, TUMOR_ONLY, OLD_DEFAULT, OLD_CALLER, OLD_PEDIATRIC)
}


def register_rule_set(rules: RuleSet) -> None:
    """Add a user's rule set; it is then found by name."""
    RULE_SETS[rules.name] = rules


# ---------------------------------------------------------------- preparation

def _gene_flags(df: DataFrame, anno: DataFrame) -> DataFrame:
    """Gene-list flags of each row.  A gene absent from the annotation, or NULL, is in no list."""
    flags = ["anno_goi", "somatic_goi", "germline_goi", "somatic_art"]
    genes = anno.groupBy(F.col("gene_id").alias("__g")).agg(*[F.bool_or(f).alias(f"__{f}") for f in flags])
    out = df.join(genes, F.col("gene_id") == F.col("__g"), "left").drop("__g")
    return out.withColumns({f"__{f}": F.coalesce(F.col(f"__{f}"), F.lit(False)) for f in flags})


def _known(df: DataFrame, anno: DataFrame, column: str, flag: str) -> DataFrame:
    genes = anno.select(F.col("gene_id").alias("__g")).distinct().withColumn(flag, F.lit(True))
    out = df.join(genes, F.col(column) == F.col("__g"), "left").drop("__g")
    return out.withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))


def fusion_known(fusion: DataFrame, anno: DataFrame, key=("id", "var_id")) -> DataFrame:
    """Whether any gene of the four colon lists is in the annotation."""
    lists = [f"gene_ids_{e}" for e in ("5_1", "3_1", "5_2", "3_2")]
    listed = F.flatten(F.array(*[F.split(F.coalesce(F.col(c), F.lit("")), ":") for c in lists]))
    genes = fusion.select(*key, F.explode(F.array_distinct(listed)).alias("gene_id"))
    hits = genes.join(anno.select("gene_id"), "gene_id", "left_semi").groupBy(*key).agg(F.lit(True).alias("__any_known"))
    out = join_stats(fusion, hits, list(key))
    return out.withColumn("__any_known", F.coalesce("__any_known", F.lit(False)))


def _phase(df: DataFrame) -> DataFrame:
    """Rows sharing sample, gene and phase set with another row."""
    keys = ["id", "gene_id", "pid"]
    # Only rows with a phase set are counted, so the joined side holds the few repeated sets.
    repeated = df.filter(F.col("pid").isNotNull()).groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > 1)
    return join_stats(df, repeated, keys).withColumn("__phase_repeat", F.col("__n").isNotNull()).drop("__n")


#: fixed values: impact classes from weak to strong.
_IMPACT_RANK = {"LOW": 1, "MODIFIER": 2, "MODERATE": 3, "HIGH": 4}


def _phase_lesser(df: DataFrame) -> DataFrame:
    """Every row of a (sample, phase set) but the strongest (impact, then tumor log-odds)."""
    rank = F.create_map(*[F.lit(x) for kv in _IMPACT_RANK.items() for x in kv])[F.col("impact")]
    best = F.struct(F.coalesce(rank, F.lit(0)).alias("r"), F.coalesce("tlod", F.lit(float("-inf"))).alias("t"), F.col("var_id").alias("v"))
    phased = df.filter(F.col("pid").isNotNull())
    top = phased.groupBy("id", "pid").agg(F.max(best).alias("__best"))
    out = join_stats(df, top, ["id", "pid"])
    return out.withColumn("__phase_lesser", F.coalesce(F.col("var_id") != F.col("__best.v"), F.lit(False))).drop("__best")


def prepare(df: DataFrame, table: str, anno: DataFrame, rules: RuleSet = DEFAULT) -> DataFrame:
    if table in ("somatic", "germline"):
        out = _gene_flags(df, anno)
        if table == "somatic":
            out = _phase_lesser(out) if rules.get("somatic", "phase") is OLD_DEFAULT.rules["somatic"]["phase"] else _phase(out)
        return out
    if table == "structural":
        return _known(_known(df, anno, "gene_id_1", "__known_1"), anno, "gene_id_2", "__known_2")
    return fusion_known(df, anno)


# ---------------------------------------------------------------- triage and filter

def triage_flags(df: DataFrame, table: str, anno: DataFrame, rules: RuleSet = DEFAULT) -> DataFrame:
    """Flag table (id, var_id, one boolean per rule)."""
    ready = prepare(df, table, anno, rules)
    return ready.select("id", "var_id", *[c.alias(r) for r, c in rules.columns(table).items()])


def triage_text(existing: Column, flags: Mapping[str, Column]) -> Column:
    """Existing text and the names of failing rules, joined by ``;`` ('' when there are none)."""
    return F.concat_ws(";", F.when(existing != "", existing), *[F.when(c, F.lit(r)) for r, c in flags.items()])


def triage_table(df: DataFrame, table: str, anno: DataFrame, rules: RuleSet = DEFAULT) -> DataFrame:
    ready = prepare(df, table, anno, rules)
    text = triage_text(F.col("triage"), rules.columns(table))
    return ready.withColumn("triage", text).select(*df.columns)


def triage_dataset(ds: CohortDataset, rule_set: str | RuleSet = "default", tables=("somatic", "germline", "structural", "fusion"),
                   anno: DataFrame | None = None) -> CohortDataset:
    rules = RULE_SETS[rule_set] if isinstance(rule_set, str) else rule_set
    genes = ds.anno if anno is None else anno
    for t in tables:
        ds = ds.with_table(t, triage_table(ds.table(t), t, genes, rules))
    return ds


def count_null_flags(flags: DataFrame) -> DataFrame:
    """Check: number of undecided rows per rule (one row)."""
    names = [c for c in flags.columns if c not in ("id", "var_id")]
    return flags.agg(*[F.count(F.when(F.col(n).isNull(), 1)).alias(n) for n in names])


def not_failed(rule: str, column: str = "triage") -> Column:
    """Kept: no failing rule matches, or the text says keep.  NULL text is kept."""
    text = F.coalesce(F.col(column), F.lit(""))
    return ~text.rlike(rule) | text.contains("keep")


def filter_dataset(ds: CohortDataset, rules: Mapping[str, str] | None = None) -> CohortDataset:
    """Drop failing rows and re-derive the maps from what is left."""
    for name, rule in (rules or R.FILTER_RULES).items():
        kept = ds.table(name).filter(not_failed(rule))
        ds = ds.with_table(name, kept).with_map(name, ds.map(name).join(kept, ["id", "var_id"], "left_semi"))
    return ds


# ---------------------------------------------------------------- rescue and injection

def unknown_events(ds: CohortDataset, decisions: DataFrame) -> DataFrame:
    """Decisions whose (id, var_id) is in none of the event tables."""
    return absent_events([ds.table(t) for t in RULE_ORDER], decisions)


def absent_events(tables: Sequence[DataFrame], decisions: DataFrame) -> DataFrame:
    """Rows whose (id, var_id) is in none of the tables."""
    known = reduce(DataFrame.unionByName, [t.select("id", "var_id") for t in tables])
    return decisions.join(known, ["id", "var_id"], "left_anti")


def rescue(ds: CohortDataset, decisions: DataFrame, validate: bool = True) -> CohortDataset:
    """Put each decision in front of the row's triage text (``keep`` then wins in the filter)."""
    missing = {"triage", "id", "var_id", "table"} - set(decisions.columns)
    if missing:
        raise ValueError(f"decisions lack columns: {sorted(missing)}")
    if validate:
        lost = unknown_events(ds, decisions).limit(5).collect()
        if lost:
            raise ValueError(f"events not in the dataset, e.g. {[(r['id'], r['var_id']) for r in lost]}")
    for t in RULE_ORDER:
        ds = ds.with_table(t, rescue_table(ds.table(t), decisions.filter(F.col("table") == t)))
    return ds


def rescue_table(df: DataFrame, decisions: DataFrame) -> DataFrame:
    new = decisions.groupBy("id", "var_id").agg(F.array_join(F.array_sort(F.collect_set("triage")), ";").alias("__new"))
    out = join_stats(df, new, ["id", "var_id"])
    return out.withColumn("triage", F.concat_ws(";", F.col("__new"), F.col("triage"))).select(*df.columns)


def update_from(df: DataFrame, updates: DataFrame, keys: list[str], column: str) -> DataFrame:
    """Overwrite ``column`` where a key row exists; rows without one keep their value."""
    new = updates.select(*keys, F.col(column).alias("__new"), F.lit(True).alias("__hit"))
    out = join_stats(df, new, keys)
    return out.withColumn(column, F.when(F.col("__hit"), F.col("__new")).otherwise(F.col(column))).select(*df.columns)


def inject(ds: CohortDataset, table: str, rows: DataFrame) -> CohortDataset:
    """Add events; those already present are marked ``keep`` instead of being added twice."""
    from cohortloom.schema import conform

    have = ds.table(table)
    keys = ["id", "var_id"]
    shaped = conform(rows, have.schema).withColumn("triage", F.lit("keep"))
    again = have.join(shaped.select(*keys, F.lit("keep").alias("triage")), keys, "left_semi").select(*keys, F.lit("keep").alias("triage"))
    fresh = shaped.join(have, keys, "left_anti")
    marked = update_from(have, again.distinct(), keys, "triage")
    ds = ds.with_table(table, marked.unionByName(fresh))
    return ds.with_map(table, ds.map(table).unionByName(fresh.select(*keys, "gene_id"), allowMissingColumns=True))


# ---------------------------------------------------------------- learned pass scoring

def forest_features(df: DataFrame) -> DataFrame:
    """Flags and filled numbers a pass model is trained on."""
    blank = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    flags = {
        "gdc_mask": ~blank("pon"), "is_indel": F.length("ref") != F.length("alt"), "in_dbsnp": F.col("dbsnp").isNotNull(), "is_rmsk": ~blank("rmsk_hit"),
    }
    out = df.withColumns({k: v.cast("int") for k, v in flags.items()})
    return out.fillna(0.0, ["oxog", "mqrs", "mqs", "sor"]).fillna("", ["str_ru"])


def forest_pass(model, df: DataFrame, rescue: bool = False, prediction: str = "prediction") -> DataFrame:
    """Add ``pass`` from a fitted pipeline: predicted, of relevant impact; strong evidence can rescue.

    The model is trained by the user; a row it cannot score does not pass.
    """
    out = model.transform(forest_features(df))
    relevant = F.coalesce(F.col("impact").isin("HIGH", "MODERATE"), F.lit(False))
    ok = (F.coalesce(F.col(prediction), F.lit(0.0)) > 0.5) & relevant
    if rescue:
        strong = F.expr("tlod > 15 and nlod > 20 and flod > 16 and sor < 3 and xfet < 1e-4 and adt_fwd >= 5 and adt_rev >= 5 and adn <= 2")
        ok = ok | (F.coalesce(strong, F.lit(False)) & relevant)
    return out.select(*df.columns, ok.alias("pass"))
