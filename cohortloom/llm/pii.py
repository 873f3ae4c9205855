"""Personal data: overlapping candidates from wide patterns, scored by boosted trees.

Generators propose spans: the base patterns, whose checked matches are always redacted, and wider forms (written-out
mail addresses, numbers without a plus or with other numbers after them, other separators).  Every candidate becomes a few small whole numbers about its
form and its surroundings.  Base matches that pass or fail their check label these; the labelled candidates of all texts
are counted by their numbers, which makes a small table whatever the size of the corpus, and trees are boosted on the
counts.  A score is an expression over the numbers, and a threshold per kind, calibrated on the labelled candidates,
decides which of the wider spans are redacted too.  DataFrame functions only.

Positions come from lengths: the pieces that a pattern's matches leave, and the matches, add up from the left.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortloom.llm.common import fresh, row_key, store

KINDS = ("email", "ip", "card", "phone")
RESULTS = ("n_email", "n_ip", "n_card", "n_phone", "base_spans", "spans")

#: (kind, base, what a text must have, pattern).  The base patterns match as their contract's do: quantifiers are possessive
#: where nothing could be given back, and a run is tried from its start (or a match's end), so long runs stay linear.
GENERATORS = (
    ("email", True, "@", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    ("ip", True, ".", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"),
    ("card", True, None, r"[0-9](?:[\x20-]?[0-9]){11,}+"),
    ("phone", True, "+", r"\+[0-9][\x20().0-9-]+[0-9]"),
    ("email", False, None, r"(?<![\w.%+-])[A-Za-z0-9._%+-]{1,64}+\x20?(?:[(\[{](?i:at)[)\]}]|@)\x20?[A-Za-z0-9-]{1,63}+(?:\x20?(?:[(\[{](?i:dot)[)\]}]|\.)\x20?[A-Za-z0-9-]{1,63}+){1,8}+"),
    ("ip", False, ".", r"(?<![\w.])[0-9]{1,3}(?:\[\.\]|\(\.\))[0-9]{1,3}(?:\[\.\]|\(\.\)|\.)[0-9]{1,3}(?:\[\.\]|\(\.\)|\.)[0-9]{1,3}(?![\w.])"),
    ("card", False, None, r"(?<![\w.])(?:[0-9]{12,19}|[0-9]{4}(?:[._/\x20-]{1,2}[0-9]{4}){3})(?![\w])"),
    ("phone", False, None, r"(?<![\w+(.-])(?:\+[0-9]{1,3}[.\x20-]?)?(?:\([0-9]{3}\)\x20?|[0-9]{3}[.\x20-])[0-9]{3}[.\x20-][0-9]{4}(?![\w.-])"),
)
FEATURES = ("kind", "digits", "luhn", "octets", "seps", "cue", "counter_cue", "glued", "length")
_CUES = "(?i)(mail|e-mail|contact|write|tel|phone|call|fax|mobile|card|visa|pay|host|address|addr|from|ip)[^A-Za-z0-9]{0,4}$"
_COUNTER = "(?i)(order|invoice|ref|version|serial|isbn|build|token|number|no|nr|id|v)[^A-Za-z0-9]{0,4}$"


def candidates_of(text: Column) -> Column:
    """array of struct(g: generator, i: number, gap, len, m: match, before, after) over all generators."""
    t = F.coalesce(text, F.lit(""))
    has_digit = t.rlike("[0-9]")

    def of(g: int, kind: str, base: bool, needs: str | None, pattern: str) -> Column:
        gate = t.contains(needs) if needs else (t.contains("@") | t.rlike("(?i)[(\\[{]at[)\\]}]")) if kind == "email" else has_digit
        if needs and kind != "email":
            gate = gate & has_digit
        found = F.when(gate, F.regexp_extract_all(t, F.lit(pattern), F.lit(0))).otherwise(F.array().cast("array<string>"))

        def placed(ms: Column) -> Column:
            gaps = F.when(F.size(ms) > 0, F.split(t, pattern, -1)).otherwise(F.array().cast("array<string>"))
            one = lambda gs: F.transform(ms, lambda m, i: F.struct(F.lit(g).alias("g"), i.alias("i"), F.length(gs[i]).alias("gap"), F.length(m).alias("len"), m.alias("m"), F.right(gs[i], F.lit(24)).alias("before"), F.left(gs[i + 1], F.lit(2)).alias("after")))
            return F.transform(F.array(gaps), one)[0]

        return F.transform(F.array(found), placed)[0]  # the one-element arrays hold what is needed twice

    return F.flatten(F.array(*[of(g, *x) for g, x in enumerate(GENERATORS)]))


def _may_hold(text: Column) -> Column:
    """A test that every text with a candidate passes: each generator asks for a digit, an @ or a bracketed "at"."""
    return F.coalesce(text.rlike("[0-9@]|(?i)[(\\[{]at[)\\]}]"), F.lit(False))


def _luhn(digits: Column) -> Column:
    """Do the digits pass, the last one being the check digit?"""
    back = F.reverse(digits)
    value = lambda i: F.substring(back, i, F.lit(1)).cast("int")
    doubled = lambda x: 2 * x - F.when(x > 4, 9).otherwise(0)
    terms = F.transform(F.sequence(F.lit(1), F.length(digits)), lambda i: F.when(i % 2 == 1, value(i)).otherwise(doubled(value(i))))
    return F.aggregate(terms, F.lit(0), lambda a, x: a + x) % 10 == 0


def describe(found: DataFrame) -> DataFrame:
    """Candidates with kind, base (a base pattern made it), ok (and its check holds), and FEATURES but kind as f_... ."""
    g = lambda k: F.element_at(F.array(*[F.lit(x[k]) for x in GENERATORS]), F.col("g") + 1)
    d = found.withColumns({"kind": F.element_at(F.array(*[F.lit(KINDS.index(x[0])) for x in GENERATORS]), F.col("g") + 1), "base": g(1), "d": F.regexp_replace("m", "[^0-9]+", "")})
    d = d.withColumn("nd", F.length("d"))
    d = d.withColumns(
        {
            "f_luhn": F.when(F.col("nd").between(12, 19), _luhn(F.col("d")).cast("int")).otherwise(0),
            "f_octets": F.forall(F.split(F.regexp_replace("m", r"[\[\]()]", ""), r"\."), lambda p: F.coalesce(F.try_to_number(F.when(F.length(F.ltrim(p, F.lit("0"))) <= 3, F.lpad(F.ltrim(p, F.lit("0")), 3, "0")), F.lit("999")) <= 255, F.lit(False))).cast("int"),
            "f_digits": F.least("nd", F.lit(20)),
            "f_seps": F.least(F.size(F.array_distinct(F.split(F.regexp_replace("m", "[A-Za-z0-9]+", ""), ""))), F.lit(4)),
            "f_cue": F.col("before").rlike(_CUES).cast("int"),
            "f_counter_cue": F.col("before").rlike(_COUNTER).cast("int"),
            "f_glued": (F.col("before").rlike("[A-Za-z0-9_]$") | F.col("after").rlike("^[A-Za-z0-9_]")).cast("int"),
            "f_length": F.least((F.col("len") / 8).cast("int"), F.lit(8)),
        }
    )
    passes = F.element_at(F.array(F.lit(True), F.col("f_octets") == 1, F.col("nd").between(12, 19) & (F.col("f_luhn") == 1), F.col("nd").between(9, 15)), F.col("kind") + 1)
    return d.withColumn("ok", F.col("base") & passes)


def boost(cells: list[tuple[tuple[int, ...], int, float]], rounds: int = 40, depth: int = 3, rate: float = 0.3, ridge: float = 1.0) -> tuple[float, list]:
    """Boosted trees on (numbers, label, weight): start value and trees (feature, cut, below, above) with numbers as leaves.

    The labels' logarithmic loss is followed by second-order steps; a split is at most a cut of one number.
    """
    total = sum(w for _, _, w in cells)
    share = min(max(sum(w for _, y, w in cells if y) / total, 1e-3), 1 - 1e-3)
    start = math.log(share / (1 - share))
    raw = [start] * len(cells)

    def grow(part: list[int], left: int, g: list[float], h: list[float]):
        gs, hs = sum(g[i] for i in part), sum(h[i] for i in part)
        best = (1e-6, 0, 0)
        for f in range(len(FEATURES)) if left else ():
            by: dict[int, list[float]] = {}
            for i in part:
                s = by.setdefault(cells[i][0][f], [0.0, 0.0])
                s[0] += g[i]
                s[1] += h[i]
            a = b = 0.0
            for v in sorted(by)[:-1]:
                a += by[v][0]
                b += by[v][1]
                gain = a * a / (b + ridge) + (gs - a) ** 2 / (hs - b + ridge) - gs * gs / (hs + ridge)
                best = max(best, (gain, -f, v))
        if best[0] <= 1e-6:
            return -rate * gs / (hs + ridge)
        f, cut = -best[1], best[2]
        return f, cut, grow([i for i in part if cells[i][0][f] <= cut], left - 1, g, h), grow([i for i in part if cells[i][0][f] > cut], left - 1, g, h)

    trees = []
    for _ in range(rounds):
        p = [1 / (1 + math.exp(-r)) for r in raw]
        g = [w * (q - y) for (_, y, w), q in zip(cells, p, strict=True)]
        h = [w * max(q * (1 - q), 1e-6) for (_, _, w), q in zip(cells, p, strict=True)]
        trees.append(grow(list(range(len(cells))), depth, g, h))
        raw = [r + leaf(trees[-1], c[0]) for r, c in zip(raw, cells, strict=True)]
    return start, trees


def leaf(tree, x: tuple[int, ...]) -> float:
    while isinstance(tree, tuple):
        tree = tree[2] if x[tree[0]] <= tree[1] else tree[3]
    return tree


def _column(tree) -> Column:
    if not isinstance(tree, tuple):
        return F.lit(float(tree))
    f, cut, below, above = tree
    return F.when(F.col("kind" if not f else f"f_{FEATURES[f]}") <= cut, _column(below)).otherwise(_column(above))


def fit(described: DataFrame, precision: float = 0.9) -> tuple[Column, list[float]] | None:
    """The score as a column and each kind's threshold; None where nothing or only one class is labelled.

    A threshold is the least score from which on the share of passing candidates of its kind, one failing one added, is
    at least ``precision``; above 1 if no score is.
    """
    names = ["kind", *[f"f_{f}" for f in FEATURES[1:]]]
    counts = described.filter("base").groupBy(*names, "ok").agg(F.count("*").alias("n"))
    # The numbers take few values each (see describe), so the table is bounded, and small since most combinations never occur.
    cells = sorted((tuple(int(r[c]) for c in names), int(r.ok), float(r.n)) for r in counts.collect())
    if len({y for _, y, _ in cells}) < 2:
        return None
    start, trees = boost(cells)
    thresholds = []
    for k in range(len(KINDS)):
        scored = sorted(((1 / (1 + math.exp(-start - sum(leaf(t, x) for t in trees))), y, w) for x, y, w in cells if x[0] == k), reverse=True)
        good, bad, best = 0.0, 1.0, 1.1
        for s, y, w in scored:
            good, bad = good + w * y, bad + w * (1 - y)
            if good / (good + bad) >= precision and s >= 0.5:
                best = s
        thresholds.append(best - 1e-9)
    raw = reduce(lambda a, b: a + b, [_column(t) for t in trees], F.lit(start))
    return 1 / (1 + F.exp(-raw)), thresholds


def find(df: DataFrame, text: str = "text", precision: float = 0.9, keep_text: bool = True) -> DataFrame:
    """Every row with n_email, n_ip, n_card, n_phone (base spans), base_spans, spans and, with ``keep_text``, redacted.

    Spans are struct(start, k, end), in code points, end exclusive, k the kind's place in KINDS, sorted.  A wider span is
    added if its score reaches its kind's threshold and no base span of its kind overlaps it.  In ``redacted`` each run of
    touching spans is replaced by the first one's kind in brackets.  A NULL text has no spans and stays NULL; repeated
    rows get equal results; where candidates of one class only (or none) are labelled, only base spans are found.  Empty
    tables give empty results; input columns named like the results give way.  Without ``keep_text`` the text is dropped.
    """
    columns = [c for c in df.columns if c.lower() not in {*RESULTS, "redacted"} and (keep_text or c != text)]
    own, source = fresh(df.columns, "in"), F.col(f"`{text}`")
    # Candidates go by the row's key, so neither texts nor row numbers are stored; equal rows share theirs.
    keys = row_key(F.struct(*[F.col(f"`{c}`") for c in columns if c != text]).cast("string") if set(columns) - {text} else F.lit(""), source)
    found = df.filter(_may_hold(source)).select(keys[0].alias("k1"), keys[1].alias("k2"), F.inline(candidates_of(source)))
    each = store(found).dropDuplicates(["k1", "k2", "g", "i"]).withColumn("r", F.struct("k1", "k2"))
    order = Window.partitionBy("r", "g").orderBy("i")
    placed = each.withColumn("end", F.sum(F.col("gap") + F.col("len")).over(order.rowsBetween(Window.unboundedPreceding, 0))).withColumn("start", F.col("end") - F.col("len"))
    known = store(describe(placed).select("r", "start", "end", "kind", "base", "ok", *[f"f_{f}" for f in FEATURES[1:]]))
    model = fit(known, precision)
    if model:
        value, thresholds = model
        scored = known.filter("not base").withColumn("score", value)
        extra = scored.filter(F.col("score") >= F.element_at(F.array(*[F.lit(t) for t in thresholds]), F.col("kind") + 1))
    else:
        extra = known.filter(F.lit(False))
    spans = known.filter("ok").select("r", "start", "end", "kind", F.lit(1).alias("b")).unionByName(extra.select("r", "start", "end", "kind", F.lit(0).alias("b")))
    # A wider span goes if a base span of its kind reaches into it from the left, or starts inside it.
    at = Window.partitionBy("r", "kind").orderBy("start", F.col("b").desc(), "end")
    reach = F.max(F.when(F.col("b") == 1, F.col("end"))).over(at.rowsBetween(Window.unboundedPreceding, -1))
    ahead = F.min(F.when(F.col("b") == 1, F.col("start"))).over(at.rowsBetween(1, Window.unboundedFollowing))
    own_reach = F.max("end").over(at.rowsBetween(Window.unboundedPreceding, -1))
    free = (F.coalesce(reach, F.lit(0)) <= F.col("start")) & (F.coalesce(ahead, F.col("end")) >= F.col("end")) & (F.coalesce(own_reach, F.lit(0)) <= F.col("start"))
    spans = spans.withColumn("free", free).filter("b = 1 or free")
    whole = Window.partitionBy("r").orderBy("start", "kind", "end")
    spans = spans.withColumn("first", F.col("start") >= F.coalesce(F.max("end").over(whole.rowsBetween(Window.unboundedPreceding, -1)), F.lit(-1)))
    spans = spans.withColumn("run", F.sum(F.col("first").cast("int")).over(whole.rowsBetween(Window.unboundedPreceding, 0)))
    span = F.struct("start", F.col("kind").alias("k"), "end")
    counts = [F.sum(((F.col("kind") == k) & (F.col("b") == 1)).cast("long")).alias(f"n_{name}") for k, name in enumerate(KINDS)]
    per_row = spans.groupBy("r").agg(*counts, F.sort_array(F.collect_list(F.when(F.col("b") == 1, span))).alias("base_spans"), F.sort_array(F.collect_list(span)).alias("spans"))
    per_row = per_row.select(F.col("r.k1").alias("a1"), F.col("r.k2").alias("a2"), *per_row.columns[1:])
    # Only texts that may hold a candidate are joined; the others go on as they are.
    wide = df.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias(own), source.alias("t"), keys[0].alias("k1"), keys[1].alias("k2"), _may_hold(source).alias("may"))
    some = wide.filter("may").join(per_row, (F.col("k1") == F.col("a1")) & (F.col("k2") == F.col("a2")), "left").drop("a1", "a2")
    empty = F.array().cast("array<struct<start:bigint,k:int,end:bigint>>")
    results = {**{f"n_{k}": F.coalesce(f"n_{k}", F.lit(0)) for k in KINDS}, "base_spans": F.coalesce(F.col("base_spans"), empty), "spans": F.coalesce(F.col("spans"), empty)}
    if keep_text:
        runs = spans.groupBy("r", "run").agg(F.min("start").alias("s"), F.max("end").alias("e"), F.min(F.struct("start", "kind")).getField("kind").alias("k"))
        runs = runs.groupBy("r").agg(F.sort_array(F.collect_list(F.struct("s", "e", "k"))).alias("runs")).select(F.col("r.k1").alias("b1"), F.col("r.k2").alias("b2"), "runs")
        some = some.join(runs, (F.col("k1") == F.col("b1")) & (F.col("k2") == F.col("b2")), "left").drop("b1", "b2")
        t, names = F.col("t"), F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
        def piece(v: Column, i: Column) -> Column:
            back = F.coalesce(F.get(F.col("runs"), i - 1).getField("e"), F.lit(0))
            return F.concat(F.substring(t, (back + 1).cast("int"), (v["s"] - back).cast("int")), names[v["k"]])

        tail = F.substring(t, (F.element_at("runs", -1).getField("e") + 1).cast("int"), F.length(t))
        results["redacted"] = F.when(F.col("runs").isNull(), t).otherwise(F.concat(F.array_join(F.transform("runs", piece), ""), tail))
    rest = wide.filter("not may")
    out = some.unionByName(rest, allowMissingColumns=True)
    final = out.select(F.col(own), *[v.alias(k) for k, v in results.items()])
    return final.select(*[F.col(f"{own}.`{c}`").alias(c) for c in columns], *results)


def as_text(spans: Column) -> Column:
    """kind:start:end of sorted spans, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", names[s["k"]], s["start"].cast("string"), s["end"].cast("string"))), ",")
