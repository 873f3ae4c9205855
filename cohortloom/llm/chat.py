"""Chat formatting by minimum-cost role repair.

The legal turns of a conversation are an automaton: an optional system turn first, then user and assistant in turns,
the last being the assistant's.  Each given turn is kept, relabelled, merged into the turn before it, or preceded by
empty turns that are put in, each at its cost, and dynamic programming finds the cheapest way through.

The step over one turn is a small matrix of costs (state before, state after), and steps compose by (min, +)
products.  So a conversation is cut into blocks of turns: every block's matrix is made on its own, blocks of blocks are
composed level by level, the states at block borders come back down the levels, and only then does each block choose its
turns.  No task holds more than one block, however long a conversation is.
"""

from __future__ import annotations

from itertools import product

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortloom.llm.common import prepare, store

ROLES = ("system", "user", "assistant")
#: States: nothing yet, or the role of the turn that is open.
STATES = 4
#: Which role may follow a state.
LEGAL = ((True, True, False), (False, True, False), (False, False, True), (False, True, False))
#: Costs: another role than the given one, one turn less by merging, and an empty turn put in.  A role that is none of the
#: three costs nothing to relabel.
RELABEL, MERGE, INSERT = 3, 1, 2
FAR = 1 << 40


def _edges(role: str | None) -> list[list[tuple[int, int, int, int]]]:
    """For each state before: (cost, state after, 1 if merged, bit set of roles put in before), cheapest per state after.

    At most two empty turns ever help: after them any role is legal, save system, which can only come first.
    """
    known = (role or "").strip().lower()
    out: list[list[tuple[int, int, int, int]]] = []
    for s in range(STATES):
        best: dict[int, tuple[int, int, int, int]] = {}

        def offer(e: tuple[int, int, int, int], best: dict = best) -> None:
            if e[1] not in best or e < best[e[1]]:
                best[e[1]] = e

        if s:  # merging into the open turn
            offer((MERGE + (RELABEL if known in ROLES and ROLES[s - 1] != known else 0), s, 1, 0))
        for puts in ((), *product(range(3), repeat=1), *product(range(3), repeat=2)):
            at, fine = s, True
            for r in puts:
                fine &= LEGAL[at][r]
                at = r + 1
            for r in range(3):
                if fine and LEGAL[at][r]:
                    mask = sum((p + 1) << (2 * i) for i, p in enumerate(puts))
                    offer((INSERT * len(puts) + (RELABEL if known in ROLES and ROLES[r] != known else 0), r + 1, 0, mask))
        out.append(sorted(best.values()))
    return out


_EDGES = {r: _edges(r) for r in (*ROLES, None)}
#: Ending: an open assistant turn ends, a user turn is answered by an empty one, a system turn gets both.
END = (FAR, 2 * INSERT, INSERT, 0)


def edges(role: str | None) -> list:
    known = (role or "").strip().lower()
    return _EDGES[known if known in ROLES else None]


def compose(a: list[int], b: list[int]) -> list[int]:
    """(min, +) product of two row-wise matrices."""
    return [min(a[i * STATES + k] + b[k * STATES + j] for k in range(STATES)) for i in range(STATES) for j in range(STATES)]


IDENTITY = [0 if i == j else FAR for i in range(STATES) for j in range(STATES)]


def _matrix(roles: list) -> list[int]:
    rows = [[0 if i == j else FAR for j in range(STATES)] for i in range(STATES)]
    for r in roles:
        e = edges(r)
        for row in rows:
            new = [FAR] * STATES
            for s, cost in enumerate(row):
                if cost < FAR:
                    for c, to, _, _ in e[s]:
                        new[to] = min(new[to], cost + c)
            row[:] = new
    return [c for row in rows for c in row]


def _path(roles: list, start: int, goal: int) -> list[tuple[int, int, int]]:
    """(state, merged, puts) of every turn on the cheapest way from start to goal; ties: the first in order of edges."""
    ahead = [[0 if s == goal else FAR for s in range(STATES)]]  # costs still to come, from the end backwards
    for r in reversed(roles):
        e = edges(r)
        ahead.append([min((c + ahead[-1][to] for c, to, _, _ in e[s]), default=FAR) for s in range(STATES)])
    out, s = [], start
    for n, r in enumerate(roles, 1):
        after = ahead[len(roles) - n]
        c, to, merged, puts = min((c + after[to], to, merged, puts) for c, to, merged, puts in edges(r)[s])
        out.append((to, merged, puts))
        s = to
    return out


_COST = "array<bigint>"


def repair(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", block: int = 256) -> DataFrame:
    """One row per piece of the repaired conversations: conv_id, n, sub, role, text, turn, merged, rendered.

    n counts the given turns from 0; a piece is the turn itself (sub 2) or an empty turn put in before it (sub 0, 1) or
    after the last (sub 3, 4), whose ``turn`` is NULL.  ``merged`` says that the piece goes on with the turn before it,
    on a new line.  ``rendered``, joined in the order of n and sub, is the conversation: ``<|role|>``, the text,
    ``<|end|>``, each with a line end.

    Turns are taken in the order of ``turn``, ties by role, then text; NULLs come first.  NULL conv_id is a conversation
    of its own, and repeated rows are turns of their own.  Roles are read without case and outer spaces; NULL and unknown
    ones fit anywhere.  NULL texts are empty turns.  Other columns play no part.  An empty table gives an empty result.
    Among equally cheap repairs the first in the order of states is taken, at the borders of blocks first.
    """
    prepare(turns.sparkSession)
    t = turns.select(F.col(f"`{conv_id}`").alias("conv"), F.col(f"`{turn}`").cast("long").alias("turn"), F.col(f"`{role}`").cast("string").alias("role"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    numbered = store(_numbered(t))
    blocks = numbered.select("conv", F.floor(F.col("n") / block).alias("b"), "n", "role")
    level = blocks.groupBy("conv", "b").agg(F.sort_array(F.collect_list(F.struct("n", "role"))).alias("turns"))

    @F.pandas_udf(_COST)
    def matrix(rows: pd.Series) -> pd.Series:
        return pd.Series([_matrix([x["role"] for x in r]) for r in rows])

    @F.pandas_udf(_COST)
    def product_of(rows: pd.Series) -> pd.Series:
        def one(r):
            m = IDENTITY
            for x in r:
                m = compose(m, list(x["m"]))
            return m

        return pd.Series([one(r) for r in rows])

    levels = [store(level.select("conv", "b", matrix("turns").alias("m")))]
    while levels[-1].groupBy("conv").agg(F.count("*").alias("n")).filter("n > 1").limit(1).count():
        up = levels[-1].groupBy("conv", F.floor(F.col("b") / block).alias("u")).agg(F.sort_array(F.collect_list(F.struct("b", "m"))).alias("parts"))
        levels.append(store(up.select("conv", F.col("u").alias("b"), product_of("parts").alias("m"))))

    @F.pandas_udf("struct<start:int,goal:int>")
    def whole(ms: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([(0, min(range(STATES), key=lambda s: (m[s] + END[s], s))) for m in ms], columns=["start", "goal"])

    @F.pandas_udf("array<struct<b:bigint,start:int,goal:int>>")
    def borders(parts: pd.Series, start: pd.Series, goal: pd.Series) -> pd.Series:
        def one(ps, s, g):
            ms = [list(p["m"]) for p in ps]
            ahead = [[0 if x == g else FAR for x in range(STATES)]]
            for m in reversed(ms):
                ahead.append([min(m[x * STATES + y] + ahead[-1][y] for y in range(STATES)) for x in range(STATES)])
            out = []
            for i, m in enumerate(ms):
                rest = ahead[len(ms) - i - 1]
                to = min(range(STATES), key=lambda y: (m[s * STATES + y] + rest[y], y))  # noqa: B023
                out.append({"b": ps[i]["b"], "start": s, "goal": to})
                s = to
            return out

        return pd.Series([one(*x) for x in zip(parts, start, goal, strict=True)])

    known = levels[-1].select("conv", "b", whole("m").alias("w")).select("conv", "b", "w.start", "w.goal")
    for lower in reversed(levels[:-1]):
        parts = lower.groupBy("conv", F.floor(F.col("b") / block).alias("u")).agg(F.sort_array(F.collect_list(F.struct("b", "m"))).alias("parts"))
        both = parts.alias("p").join(known.alias("k"), F.col("p.conv").eqNullSafe(F.col("k.conv")) & (F.col("p.u") == F.col("k.b")))
        known = both.select("p.conv", F.explode(borders("parts", "start", "goal")).alias("x")).select("conv", "x.b", "x.start", "x.goal")

    @F.pandas_udf("array<struct<n:bigint,state:int,merged:int,puts:int>>")
    def choose(rows: pd.Series, start: pd.Series, goal: pd.Series) -> pd.Series:
        return pd.Series([[{"n": x["n"], "state": s, "merged": m, "puts": p} for x, (s, m, p) in zip(r, _path([x["role"] for x in r], a, g), strict=True)] for r, a, g in zip(rows, start, goal, strict=True)])

    made = level.alias("l").join(known.alias("k"), F.col("l.conv").eqNullSafe(F.col("k.conv")) & (F.col("l.b") == F.col("k.b")))
    chosen = made.select(F.col("l.conv").alias("conv"), "goal", F.explode(choose("turns", "start", "goal")).alias("x")).select("conv", "goal", "x.*")
    return _render(numbered, chosen, conv_id)


def _render(numbered: DataFrame, chosen: DataFrame, conv_id: str) -> DataFrame:
    role = lambda r: F.element_at(F.array(*[F.lit(x) for x in ROLES]), r)
    both = numbered.alias("t").join(chosen.alias("c"), F.col("t.conv").eqNullSafe(F.col("c.conv")) & (F.col("t.n") == F.col("c.n")))
    ends = F.col("t.n") == F.col("size") - 1
    piece = lambda sub, r, text, turn, merged: F.struct(F.lit(sub).alias("sub"), r.alias("role"), text.alias("text"), turn.alias("turn"), merged.alias("merged"))
    none, no, first, second = F.lit(None).cast("bigint"), F.lit(False), F.col("puts") % 4, F.floor(F.col("puts") / 4).cast("int")
    put = lambda sub, r, when: F.when(when, piece(sub, r, F.lit(""), none, no))
    pieces = F.array(
        put(0, role(F.greatest(first, F.lit(1))), first > 0),
        put(1, role(F.greatest(second, F.lit(1))), second > 0),
        piece(2, role(F.col("state")), F.col("text"), F.col("turn"), F.col("merged") == 1),
        put(3, F.lit("user"), ends & (F.col("goal") == 1)),
        put(4, F.lit("assistant"), ends & F.col("goal").isin(1, 2)),
    )
    rows = both.select(F.col("t.conv").alias("conv"), F.col("t.n").alias("n"), ends.alias("ends"), F.explode(F.array_compact(pieces)).alias("p"), (F.col("puts") > 0).alias("put"), F.when(F.col("goal") == 3, 2).otherwise(4).alias("final"))
    opens = (F.col("n") == 0) & (F.col("p.sub") == F.when(F.col("put"), 0).otherwise(2))
    head = F.when(F.col("p.merged"), F.lit("\n")).otherwise(F.concat(F.when(opens, F.lit("")).otherwise(F.lit("\n<|end|>\n")), F.lit("<|"), F.col("p.role"), F.lit("|>\n")))
    tail = F.when(F.col("ends") & (F.col("p.sub") == F.col("final")), F.lit("\n<|end|>\n")).otherwise(F.lit(""))
    return rows.select(F.col("conv").alias(conv_id), "n", "p.sub", "p.role", "p.text", "p.turn", "p.merged", F.concat(head, "p.text", tail).alias("rendered"))


def _numbered(t: DataFrame) -> DataFrame:
    """Turns with their place n in the conversation, counted over range-sorted parts, not in one window per conversation."""
    rows = store(t.repartitionByRange("conv", "turn", "role", "text").withColumn("part", F.spark_partition_id()))
    here = Window.partitionBy("conv", "part").orderBy("turn", "role", "text")
    sizes = rows.groupBy("conv", "part").agg(F.count("*").alias("size"))
    before = sizes.withColumn("off", F.coalesce(F.sum("size").over(Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    placed = rows.withColumn("k", F.row_number().over(here)).alias("r").join(before.alias("o"), F.col("r.conv").eqNullSafe(F.col("o.conv")) & (F.col("r.part") == F.col("o.part")))
    totals = sizes.groupBy("conv").agg(F.sum("size").alias("size"))
    out = placed.select("r.conv", "turn", "role", "text", (F.col("off") + F.col("k") - 1).alias("n")).alias("a").join(totals.alias("b"), F.col("a.conv").eqNullSafe(F.col("b.conv")))
    return out.select("a.conv", "turn", "role", "text", "n", "size")


def oracle() -> str:
    """The repair in DuckDB: costs to come by recursion from the last turn, then choices from the first (one block)."""
    table = ", ".join(f"({r + 1 if r is not None else 0}, {s}, {c}, {to}, {m}, {p})" for r, e in ((ROLES.index(k) if k else None, v) for k, v in _EDGES.items()) for s in range(STATES) for c, to, m, p in e[s])
    return f"""
with recursive e(role, s, c, state, merged, puts) as (values {table}),
t as (select conv_id, turn, coalesce(text, '') text, coalesce(list_position(['system', 'user', 'assistant'], lower(trim(role))), 0) r,
  row_number() over (partition by conv_id order by turn nulls first, role nulls first, text nulls first) - 1 n, count(*) over (partition by conv_id) size from conversations),
a as (select conv_id, size n, s, cast(c as bigint) c from (select distinct conv_id, size from t), (values (0, {FAR}), (1, {END[1]}), (2, {END[2]}), (3, {END[3]})) x(s, c)
  union all select conv_id, n, s, min(c) from (select a.conv_id, t.n, e.s, e.c + a.c c from a join t on t.conv_id is not distinct from a.conv_id and t.n = a.n - 1 join e on e.role = t.r and e.state = a.s) group by all),
f as (select conv_id, cast(-1 as bigint) n, 0 state, 0 merged, 0 puts from t where n = 0
  union all select conv_id, n, x.b, x.m, x.p from (select t.conv_id, t.n, min({{'a': e.c + a.c, 'b': e.state, 'm': e.merged, 'p': e.puts}}) x
    from f join t on t.conv_id is not distinct from f.conv_id and t.n = f.n + 1 join e on e.role = t.r and e.s = f.state
    join a on a.conv_id is not distinct from t.conv_id and a.n = t.n + 1 and a.s = e.state group by all)),
p as (select t.*, state, merged, puts, last_value(state) over (partition by t.conv_id order by t.n rows between unbounded preceding and unbounded following) goal
  from t join f on t.conv_id is not distinct from f.conv_id and t.n = f.n),
q as (select conv_id, n, size, goal, puts, unnest(list_filter([
  case when puts % 4 > 0 then {{'sub': 0, 'r': puts % 4, 'text': '', 'turn': null::bigint, 'm': false}} end, case when puts // 4 > 0 then {{'sub': 1, 'r': puts // 4, 'text': '', 'turn': null::bigint, 'm': false}} end,
  {{'sub': 2, 'r': state, 'text': text, 'turn': turn, 'm': merged = 1}},
  case when n = size - 1 and goal = 1 then {{'sub': 3, 'r': 2, 'text': '', 'turn': null::bigint, 'm': false}} end, case when n = size - 1 and goal in (1, 2) then {{'sub': 4, 'r': 3, 'text': '', 'turn': null::bigint, 'm': false}} end], lambda v: v is not null)) v from p)
select conv_id, n, v.sub sub, ['system', 'user', 'assistant'][v.r] "role", v.text "text", v.turn turn, v.m merged,
  case when v.m then chr(10) else case when n = 0 and v.sub = case when puts > 0 then 0 else 2 end then '' else chr(10) || '<|end|>' || chr(10) end || '<|' || ['system', 'user', 'assistant'][v.r] || '|>' || chr(10) end
  || v.text || case when n = size - 1 and v.sub = case when goal = 3 then 2 else 4 end then chr(10) || '<|end|>' || chr(10) else '' end rendered
from q"""
