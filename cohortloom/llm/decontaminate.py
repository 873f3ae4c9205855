"""Benchmark decontamination with a generalised suffix automaton of the normalised test items.

The items' word sequences make one automaton; every text is streamed through it once, and the state and the length
of the longest match after each word tell which windows of an item end there.  Windows that overlap make one span.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, LongType, StringType, StructField, StructType

from cohortloom.llm.automaton import Shared, SuffixAutomaton
from cohortloom.llm.common import add_struct, fresh, once, prepare, store

#: Words of one automaton (some 60 MB in a worker) and automata of one pass over the texts; more items make more passes.
BLOCK_WORDS, BLOCKS = 100_000, 8

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")

FIELDS = StructType(
    [StructField("n_words", LongType()), StructField("n_hit", LongType()), StructField("longest_match", LongType()), StructField("item_ids", ArrayType(StringType())), StructField("contaminated", BooleanType()), StructField("cleaned", StringType())]
)

#: What passes before have found in a text: the ends of its hit spans, items and longest match.
FOUND = "struct<edges: array<bigint>, names: array<string>, longest: bigint>"
NOTHING = "named_struct('edges', cast(array() as array<bigint>), 'names', cast(array() as array<string>), 'longest', 0L)"


def words_of(text: str | None) -> list[bytes]:
    """Runs of ASCII letters and digits and of all other characters, A-Z in lower case; none if NULL."""
    return text.encode("utf-8", "surrogatepass").translate(_LOWER).split() if text else []


class Items:
    """The automaton of one block of items with what ends in its states."""

    def __init__(self, items: list[tuple[str | None, str]], window: int):
        self.window = window
        self.codes: dict[bytes, int] = {}
        sequences = [(i, [self.codes.setdefault(w, len(self.codes)) for w in words_of(t)]) for i, t in items]
        self.sam = SuffixAutomaton(s for _, s in sequences)
        self.full: dict[int, set] = {}  # state of a window -> its items
        self.short: dict[int, set] = {}  # state of a short item -> (length, item)
        for item, s in sequences:
            state = matched = 0
            for c in s:
                state, matched = self.sam.step(state, matched, c)
                if matched >= window:
                    self.full.setdefault(self.sam.holder(state, window), set()).add(item)
            if 0 < len(s) < window:
                self.short.setdefault(self.sam.holder(state, len(s)), set()).add((len(s), item))
        # Nearest state on the way up, itself included, that holds a short item.
        self.up = [-1] * len(self.sam.next)
        for s in sorted(range(len(self.up)), key=self.sam.length.__getitem__):
            self.up[s] = s if s in self.short else self.up[self.sam.link[s]] if s else -1

    def read(self, words: list[bytes]) -> tuple[list[list[int]], set, int]:
        """Hit spans [first word, after the last), items with a window in the text, longest match."""
        sam, window, full, short, up = self.sam, self.window, self.full, self.short, self.up
        arcs, link, length = sam.next, sam.link, sam.length
        spans: list[list[int]] = []
        items: set = set()
        state = matched = longest = 0
        for at, c in enumerate(map(self.codes.get, words), 1):
            if c is None:
                state = matched = 0
                continue
            to = arcs[state].get(c)
            while to is None and state:
                state = link[state]
                matched = length[state]
                to = arcs[state].get(c)
            if to is None:
                matched = 0
                continue
            state, matched = to, matched + 1
            if matched > longest:
                longest = matched
            hit = 0
            if matched >= window:
                hit = window
                items |= full[sam.holder(state, window)]
            if (s := up[state]) >= 0:
                while s >= 0:
                    for n, item in short[s]:
                        if n <= matched:
                            items.add(item)
                            hit = max(hit, n)
                    s = up[link[s]] if s else -1
            if hit:
                if spans and at - hit <= spans[-1][1]:
                    spans[-1][1] = at
                    spans[-1][0] = min(spans[-1][0], at - hit)
                    while len(spans) > 1 and spans[-1][0] <= spans[-2][1]:
                        a, b = spans.pop()
                        spans[-1] = [min(a, spans[-1][0]), b]
                else:
                    spans.append([at - hit, at])
        return spans, items, longest


def _union(spans: list[list[int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(b, out[-1][1])
        else:
            out.append([a, b])
    return out


def _without(text: str, spans: list[list[int]], at_least: int) -> str:
    """The text without the spans of that many words or more (each with the gap behind it)."""
    spans = [s for s in spans if s[1] - s[0] >= at_least]
    if not spans:
        return text
    starts = [m.start() for m in _WORD.finditer(text)] + [len(text)]
    out, at = [], 0
    for a, b in spans:
        out.append(text[at : starts[a]])
        at = starts[b]
    return "".join(out) + text[at:]


@lru_cache(maxsize=BLOCKS)
def _items(shared: Shared, window: int) -> Items:
    return Items(shared.value, window)


def _passes(items: DataFrame, item_id: str, text: str) -> Iterator[list[Shared]]:
    """The items in lists of up to BLOCKS blocks, one list at a time on the driver; at least one block."""
    rows = items.select(F.col(f"`{item_id}`").cast("string").alias("i"), F.col(f"`{text}`").alias("t")).filter(F.col("t").isNotNull())
    blocks, block, size = [], [], 0
    for r in rows.toLocalIterator():
        n = len(words_of(r.t))
        if size and size + n > BLOCK_WORDS:
            blocks.append(Shared(items.sparkSession, block))
            block, size = [], 0
            if len(blocks) == BLOCKS:
                yield blocks
                blocks = []
        block.append((r.i, r.t))
        size += n
    yield [*blocks, Shared(items.sparkSession, block)]


def _read(words: list[list[bytes]], blocks: list[Shared], window: int) -> list[tuple[list[list[int]], set, int]]:
    """Spans, items and longest match of every text, over the blocks of one pass."""
    found = [([], set(), 0)] * len(words)
    for shared in blocks:
        auto = _items(shared, window)
        for k, w in enumerate(words):
            if w:
                spans, names, longest = auto.read(w)
                found[k] = (found[k][0] + spans, found[k][1] | names, max(found[k][2], longest))
    return [(_union(spans), names - {None}, longest) for spans, names, longest in found]


def _result(text: str | None, words: list[bytes], found: tuple, share: tuple[int, int], limit: int) -> tuple:
    spans, names, longest = found
    hit = sum(b - a for a, b in spans)
    cleaned = None if text is None else _without(text, spans, limit) if spans else text
    return len(words), hit, longest, sorted(names), hit > 0 and share[1] * hit >= share[0] * len(words), cleaned


def _earlier(seen: pd.DataFrame) -> list[tuple[list[list[int]], set, int]]:
    return [([list(map(int, s)) for s in zip(e[::2], e[1::2])], set(n), int(m)) for e, n, m in zip(seen["edges"], seen["names"], seen["longest"])]


def decontaminate(df: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = 13, share: tuple[int, int] = (1, 20), remove_words: int | None = None) -> DataFrame:
    """Every row with n_words, n_hit, longest_match, item_ids, contaminated and cleaned.

    A window is ``window`` successive words of an item, or all words of a shorter item; a word of the text inside an
    occurrence of one is hit.  A text is contaminated if hit words are at least ``share`` of all; ``cleaned`` is the
    text without spans of ``remove_words`` hit words or more (default: the window).  A NULL text has no words and stays
    NULL; items with NULL text or without words match nothing, items with NULL id hit words but are not listed; equal
    items are all listed, ids once.  No items: nothing is hit.  Empty tables give empty results; input columns named
    like the results give way.

    Items of up to BLOCKS * BLOCK_WORDS words are read in one lazy pass.  More of them make more passes, which run while
    this is called: each reads the rows stored by the one before and adds what its automata find, without a shuffle, so
    neither a worker nor the driver holds more than one pass's items.
    """
    spark = prepare(items.sparkSession)
    limit = window if remove_words is None else remove_words
    passes = _passes(items, item_id, item_text)
    blocks, source = next(passes), F.col(f"`{text}`")
    following = next(passes, None)
    if following is None:

        @F.pandas_udf(FIELDS)
        def run(texts: pd.Series) -> pd.DataFrame:
            words = [words_of(t) for t in texts]
            return pd.DataFrame([_result(t, w, f, share, limit) for t, w, f in zip(texts, words, _read(words, blocks, window), strict=True)], columns=FIELDS.names)

        return add_struct(df, once(run)(source), FIELDS.names)

    tmp = fresh([*df.columns, *FIELDS.names], "found")
    rows = df.withColumn(tmp, F.lit(None).cast(FOUND))
    while blocks is not None:
        rows = store(rows.withColumn(tmp, _more(blocks, window)(source, F.coalesce(F.col(tmp), F.expr(NOTHING)))))
        for shared in blocks:
            shared.broadcast.unpersist()
        blocks, following = following, next(passes, None)

    @F.pandas_udf(FIELDS)
    def finish(texts: pd.Series, seen: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([_result(t, words_of(t), f, share, limit) for t, f in zip(texts, _earlier(seen), strict=True)], columns=FIELDS.names)

    return add_struct(rows, once(finish)(source, F.col(tmp)), FIELDS.names).drop(tmp)


def _more(blocks: list[Shared], window: int):
    """The function (text, found before) -> found with these blocks."""

    @F.pandas_udf(FOUND)
    def run(texts: pd.Series, seen: pd.DataFrame) -> pd.DataFrame:
        now = _read([words_of(t) for t in texts], blocks, window)
        both = [(_union(s + z), n | m, max(a, b)) for (s, n, a), (z, m, b) in zip(_earlier(seen), now, strict=True)]
        return pd.DataFrame([([e for span in s for e in span], sorted(n), m) for s, n, m in both], columns=["edges", "names", "longest"])

    return run


#: The contract in DuckDB: windows as lists of words, joined with every window of the texts.
ORACLE = r"""
with d as (select doc_id, row_number() over () r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w from documents),
b as (select cast(item_id as varchar) item, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w from benchmark),
win as (select distinct item, least(len(w), 13) n, w[i:i + least(len(w), 13) - 1] k from (select item, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) i from b where len(w) > 0)),
pos as (select r, p, n, w[p:p + n - 1] k from (select r, w, n, unnest(range(1, len(w) - n + 2)) p from d, (select distinct n from win) where len(w) >= n)),
hit as (select r, p, pos.n, item from pos join win on pos.n = win.n and pos.k = win.k),
words as (select r, count(distinct q) n_hit from (select r, unnest(range(p, p + n)) q from (select distinct r, p, n from hit)) group by r),
items as (select r, count(*) n_items, string_agg(item, ',' order by item) ids from (select distinct r, item from hit where item is not null) group by r)
select doc_id, cast(len(w) as bigint) n_words, coalesce(n_hit, 0) n_hit, coalesce(n_items, 0) n_items, sha256(coalesce(ids, '')) items_sha256,
  coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) contaminated
from d left join words using (r) left join items using (r)
"""
