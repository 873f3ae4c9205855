"""Language identification by cross-parsing.

A bounded sample of labelled text per language (the texts of lowest hash) is turned into a suffix automaton over characters.  A text's words, each
with a space on both sides, are parsed against it: the next phrase is the longest match from where the last one ended,
and a character that no match starts with is a phrase of its own.  The language whose automaton needs the fewest phrases
per character wins.  Phrases end with their word, so a word is parsed once for all its occurrences.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType
from pyspark.sql.window import Window

from cohortloom.llm.automaton import Shared, SuffixAutomaton
from cohortloom.llm.common import add_struct, prepare, store

_LETTERS = re.compile(r"[^\W\d_]+")
#: Words a worker remembers, characters of the longest one that is remembered, and bits of one language's sum.
MEMO, MEMO_CHARS, BITS = 200_000, 48, 40
#: Languages one model may have.
MAX_LANGUAGES = 1_000
#: Texts of a language's sample, at least, where it has so many; cells of hashes that are looked at.
TEXTS, CELLS = 20, 64

FIELDS = StructType([StructField("lang_pred", StringType()), StructField("score", DoubleType()), StructField("phrases", ArrayType(LongType()))])


def sample(docs: DataFrame, text: str, lang: str, chars: int) -> list[tuple[str, str]]:
    """(language, text): for each language its distinct texts in the order of a hash, until they have ``chars`` characters.

    One text gives at most a twentieth of ``chars`` (its beginning; longer texts still teach), so no language with a labelled
    character is left without a sample.  Sizes are taken over distinct texts, so copies do not thin the sample out.
    """
    bound = max(1, chars // TEXTS)
    t = docs.select(F.col(f"`{lang}`").alias("lang"), F.col(f"`{text}`").alias("text"), F.xxhash64(F.col(f"`{text}`")).alias("h"))
    t = t.filter(F.col("lang").isNotNull() & (F.length("text") > 0))
    # 53 bits of the hash as a place between 0 and 1.
    t = t.withColumn("at", F.shiftrightunsigned("h", 11) / F.lit(float(1 << 53)))
    # Hashes and lengths are shuffled, texts are not.
    keys = store(t.groupBy("lang", "h", "at").agg(F.least(F.max(F.length("text")), F.lit(bound)).alias("n")))
    sizes = keys.groupBy("lang").agg(F.sum("n").alias("all"))
    if sizes.limit(MAX_LANGUAGES + 1).count() > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    # The sizes (at most MAX_LANGUAGES rows) are broadcast, so that no language's hashes come together in one task.
    # Cells of about ``chars`` characters; as no text has more than a twentieth of that, the first CELLS hold enough in all
    # but one of e^1000 cases, and a language of fewer cells is there as a whole.
    cell = keys.join(F.broadcast(sizes), "lang").withColumn("cell", F.floor(F.col("at") * F.col("all") / chars)).filter(F.col("cell") < CELLS)
    order = Window.partitionBy("lang").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    before = cell.groupBy("lang", "cell").agg(F.sum("n").alias("n"), F.max("at").alias("at")).withColumn("before", F.coalesce(F.sum("n").over(order), F.lit(0)))
    last = before.filter(F.col("before") < chars).groupBy(F.col("lang").alias("l")).agg(F.max("at").alias("last"))
    few = t.join(F.broadcast(last), (F.col("lang") == F.col("l")) & (F.col("at") <= F.col("last")))  # at most MAX_LANGUAGES rows
    texts = few.groupBy("lang", "h", "at").agg(F.min(F.substring("text", 1, bound)).alias("text"))
    picked, used = [], {}
    for r in sorted(texts.collect(), key=lambda r: (r.lang, r.at, r.h)):  # bounded: a few cells of ``chars`` per language
        left = chars - used.get(r.lang, 0)
        if left > 0:
            picked.append((r.lang, r.text[:left]))
            used[r.lang] = used.get(r.lang, 0) + len(r.text)
    return sorted(picked)


class Parser:
    """One automaton per language, its arcs in one table keyed by state and character."""

    def __init__(self, texts: list[tuple[str, str]]):
        self.langs = sorted({lang for lang, _ in texts})
        self.arcs: list[dict[int, int]] = []
        for lang in self.langs:
            words = [w for name, t in texts if name == lang for w in _LETTERS.findall(t.lower())]
            sam = SuffixAutomaton([list(map(ord, " " + " ".join(words) + " "))])
            self.arcs.append({state << 21 | c: to for state, arcs in enumerate(sam.next) for c, to in arcs.items()})
        self.memo: dict[str, int] = {}

    def word(self, w: str) -> int:
        """Phrases of one word in every language, BITS bits each."""
        got = self.memo.get(w)
        if got is None:
            got, codes = 0, [32, *map(ord, w), 32]
            for k, arcs in enumerate(self.arcs):
                n = state = 0
                for c in codes:
                    to = arcs.get(state << 21 | c)
                    if to is None:
                        n += state > 0  # the phrase ends before c
                        to = arcs.get(c)
                        if to is None:
                            n += 1
                            to = 0
                    state = to
                got |= n + (state > 0) << BITS * k
            if len(w) <= MEMO_CHARS:
                if len(self.memo) >= MEMO:
                    self.memo.clear()
                self.memo[w] = got
        return got

    def predict(self, text: str | None) -> tuple[str, float, list[int]]:
        words = _LETTERS.findall(text.lower()) if text else []
        if not self.langs or not any(c.isalpha() for w in words for c in w):
            return "und", 0.0, []
        get, word = self.memo.get, self.word
        total = sum([get(w) or word(w) for w in words])
        counts = [total >> BITS * k & (1 << BITS) - 1 for k in range(len(self.langs))]
        order = np.argsort(counts, kind="stable")  # ties: the first name
        if len(order) == 1:
            return self.langs[0], 1.0, counts
        best, second = counts[order[0]], counts[order[1]]
        return self.langs[order[0]], second / (best + second), counts


@lru_cache(maxsize=1)
def _parser(shared: Shared) -> Parser:
    return Parser(shared.value)


def model(labelled: DataFrame, text: str = "text", lang: str = "lang", chars: int = 120_000) -> Column:
    """The function text -> FIELDS learnt from a bounded sample (``chars`` characters per language) of labelled rows."""
    shared = Shared(prepare(labelled.sparkSession), sample(labelled, text, lang, chars))

    @F.pandas_udf(FIELDS)
    def run(texts: pd.Series) -> pd.DataFrame:
        parser = _parser(shared)
        return pd.DataFrame([parser.predict(t) for t in texts], columns=FIELDS.names)

    return run


def identify(df: DataFrame, labelled: DataFrame, text: str = "text", label_text: str = "text", lang: str = "lang", chars: int = 120_000) -> DataFrame:
    """Every row with lang_pred, score (0.5 to 1: share of the runner-up in the phrases of both) and phrases per language.

    Languages are in the order of their names; ties go to the first.  A NULL text or one without letters is ``und`` with
    score 0; so is every text if no labelled text is there.  With one language known, it has score 1.  Rows with NULL
    label teach nothing; repeated texts teach once; of a long text the first twentieth of ``chars`` characters teaches.  Empty tables give empty results; input columns named like the
    results give way.
    """
    return add_struct(df, model(labelled, label_text, lang, chars)(F.col(f"`{text}`")), FIELDS.names)
