"""Language-model scores as marginal probabilities over all subword segmentations.

A word is every path through the lattice of pieces of an existing vocabulary.  The vocabulary's scores are ranks; a prior
that falls with the rank weights the pieces, and expected piece counts over the training words (forward-backward on each
word's lattice) sharpen it.  A word's probability is the sum over all its segmentations, by a forward recursion in log
space; a text's is the product over its words and one end symbol, which shares the piece distribution.

Words factorise a text, so the recursion runs once for each distinct word.  Frequent words (at most FREQUENT of them)
go to the tasks that read the texts; the other words meet the texts' counts in a join, whose keys are rare by then.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.common import add_struct, fresh, prepare, store

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: Words whose counts and probabilities are sent to every task: some 100 bytes each.
FREQUENT = 100_000
#: Distinct words a task counts before it hands them on.
COUNTED = 200_000
#: Weight, in pieces, of the prior against the expected counts.
PRIOR_WEIGHT = 1000.0
#: Characters (with the start mark) up to which words go many at once, and how many at once.
SHORT, TOGETHER = 24, 8192
START, END = "▁", b""

RESULTS = ("n_tokens", "n_known", "train_tokens", "base_score", "score")


def words_of(text: str | None) -> list[bytes]:
    """Words with A-Z in lower case; NULL has none."""
    return text.encode("utf-8", "surrogatepass").translate(_LOWER).split() if text else []


def vocabulary(path: str) -> dict[str, float]:
    """Log prior of the pieces: 1 / (rank + 1), normalised; the byte pieces, and the start mark if it has no rank, stand after the last.  Control pieces and those ranked out are left out."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ranks, raw = {}, []
    for i in range(model.vocab_size()):
        if model.is_byte(i):
            raw.append(model.id_to_piece(i))
        elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)) and model.get_score(i) > -1e8:
            ranks[model.id_to_piece(i)] = -model.get_score(i)
    last = max(ranks.values(), default=0.0)
    ranks |= {p: last + 1 for p in [*raw, START] if p not in ranks}
    weights = {p: 1 / (r + 1) for p, r in ranks.items()}
    total = math.fsum(weights.values())
    return {p: math.log(w / total) for p, w in weights.items()}


class Lattice:
    """Segmentations of words under log weights of pieces; a character without a piece is the run of its bytes.

    Words of up to SHORT characters go by length, many at once: one lookup for all their substrings, then the recursion
    over positions on whole columns.  Longer words, and those with a character that has no piece, go one by one.
    """

    def __init__(self, logp: dict[str, float]):
        self.logp, self.pieces = logp, list(logp)
        self.place = {p: i for i, p in enumerate(self.pieces)}
        self.single = {p for p in self.pieces if len(p) == 1}
        self.known = pa.array(self.pieces, pa.string())
        self.weights = np.array([*logp.values(), -np.inf])  # the last is that of no piece
        self.longest = max(map(len, logp), default=1)

    def _bytes(self, char: str) -> list[str]:
        return [f"<0x{b:02X}>" for b in char.encode("utf-8", "surrogatepass")]

    def _arcs(self, s: str, i: int) -> list[tuple[int, float]]:
        """(end, log weight) of the pieces that start at i."""
        get = self.logp.get
        out = [(j, w) for j in range(i + 1, min(len(s), i + self.longest) + 1) if (w := get(s[i:j])) is not None]
        if not out or out[0][0] != i + 1:
            out.append((i + 1, sum(self.logp[b] for b in self._bytes(s[i]))))
        return out

    def _forward(self, s: str) -> list[float]:
        """Log of the summed weight of all segmentations of every prefix."""
        waiting: list[list[float]] = [[] for _ in range(len(s) + 1)]
        waiting[0].append(0.0)
        alpha = []
        for i in range(len(s) + 1):
            alpha.append(_log_sum(waiting[i]))
            if i < len(s):
                for j, w in self._arcs(s, i):
                    waiting[j].append(alpha[i] + w)
            waiting[i] = []
        return alpha

    def _expected(self, s: str, times: float, into: np.ndarray) -> None:
        alpha, beta = self._forward(s), [0.0] * (len(s) + 1)
        for i in range(len(s) - 1, -1, -1):
            terms = [(j, w + beta[j]) for j, w in self._arcs(s, i)]
            beta[i] = _log_sum([t for _, t in terms])
            for j, t in terms:
                for p in [s[i:j]] if s[i:j] in self.place else self._bytes(s[i]):
                    into[self.place[p]] += times * math.exp(alpha[i] + t - alpha[-1])

    def _groups(self, words: list[str]) -> Iterator[tuple[np.ndarray, int, dict[tuple[int, int], np.ndarray]]]:
        """Words of one length, and for each pair of positions the pieces that stand there (the last index: none)."""
        sizes = np.array([len(w) for w in words])
        found, asked = [], []
        for n in sorted(set(sizes[sizes <= SHORT].tolist())):
            at = np.flatnonzero(sizes == n)
            group = pa.array([words[k] for k in at], pa.string())
            spans = [(i, j) for i in range(n) for j in range(i + 1, min(n, i + self.longest) + 1)]
            found.append((at, n, spans))
            asked += [pc.utf8_slice_codeunits(group, i, j) for i, j in spans]
        if not asked:
            return
        ids = pc.index_in(pa.concat_arrays(asked), value_set=self.known).fill_null(len(self.pieces)).to_numpy()
        start = 0
        for at, n, spans in found:
            stop = start + len(at) * len(spans)
            yield at, n, dict(zip(spans, ids[start:stop].reshape(len(spans), len(at)), strict=True))
            start = stop

    def _tables(self, n: int, arcs: dict[tuple[int, int], np.ndarray]) -> np.ndarray:
        """Log of the summed weight of all segmentations of every prefix, for words of one length."""
        alpha = np.zeros((n + 1, len(arcs[0, 1])))
        for j in range(1, n + 1):
            alpha[j] = _log_sums(np.array([alpha[i] + self.weights[arcs[i, j]] for i in range(max(0, j - self.longest), j)]))
        return alpha

    def _split(self, words: list[bytes]) -> tuple[list[str], np.ndarray]:
        """The words with their start mark, and which must go one by one."""
        strings = [START + w.decode("utf-8", "surrogatepass") for w in words]
        return strings, np.array([len(s) > SHORT or not self.single.issuperset(s) for s in strings], dtype=bool)

    def marginals(self, words: list[bytes]) -> np.ndarray:
        """Log probability of each word, summed over its segmentations."""
        strings, alone = self._split(words)
        out = np.zeros(len(words))
        many = np.flatnonzero(~alone)
        for at, n, arcs in self._groups([strings[k] for k in many]):
            out[many[at]] = self._tables(n, arcs)[n]
        for k in np.flatnonzero(alone):
            out[k] = self._forward(strings[k])[-1]
        return out

    def expect(self, words: list[bytes], times: list[int], into: np.ndarray) -> None:
        """Add the expected uses of each piece in so many copies of each word."""
        strings, alone = self._split(words)
        counts = np.array(times, dtype=float)
        many = np.flatnonzero(~alone)
        ids, uses = [], []
        for at, n, arcs in self._groups([strings[k] for k in many]):
            alpha, c = self._tables(n, arcs), counts[many[at]]
            beta = np.zeros_like(alpha)
            for i in range(n - 1, -1, -1):
                ends = range(i + 1, min(n, i + self.longest) + 1)
                terms = np.array([self.weights[arcs[i, j]] + beta[j] for j in ends])
                beta[i] = _log_sums(terms)
                uses += list(c * np.exp(terms + (alpha[i] - alpha[n])))
                ids += [arcs[i, j] for j in ends]
        if ids:
            into += np.bincount(np.concatenate(ids), np.concatenate(uses), len(into))
        for k in np.flatnonzero(alone):
            self._expected(strings[k], counts[k], into)


def _log_sum(terms: list[float]) -> float:
    top = max(terms)
    return top if len(terms) == 1 else top + math.log(sum([math.exp(t - top) for t in terms]))


def _log_sums(terms: np.ndarray) -> np.ndarray:
    top = terms.max(axis=0)
    return top + np.log(np.exp(terms - top).sum(axis=0))


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of TOGETHER rows or more, but for the last."""
    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        waiting.append(batch)
        if sum(b.num_rows for b in waiting) >= TOGETHER:
            yield pa.Table.from_batches(waiting).combine_chunks().to_batches()[0]
            waiting = []
    if sum(b.num_rows for b in waiting):
        yield pa.Table.from_batches(waiting).combine_chunks().to_batches()[0]


def _counts(texts: DataFrame) -> DataFrame:
    """(word, n, c): how often a word is in all texts and in the training texts; END counts texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: tuple[Counter, Counter] = (Counter(), Counter())

        def out() -> pa.RecordBatch:
            words = list(seen[0].keys() | seen[1].keys())
            c = [seen[1][w] for w in words]
            made = pa.record_batch([pa.array(words, pa.binary()), pa.array([seen[0][w] + k for w, k in zip(words, c, strict=True)], pa.int64()), pa.array(c, pa.int64())], ["word", "n", "c"])
            for x in seen:
                x.clear()
            return made

        for batch in batches:
            for text, learn in zip(batch.column(0), batch.column(1), strict=True):
                into = seen[bool(learn.as_py())]
                into.update(words_of(text.as_py()))
                into[END] += 1
                if len(into) > COUNTED:
                    yield out()
        yield out()

    return texts.mapInArrow(run, "word binary, n long, c long").groupBy("word").agg(F.sum("n").alias("n"), F.sum("c").alias("c"))


def learn_pieces(words: DataFrame, prior: dict[str, float], rounds: int) -> dict[str, float]:
    """Log weights of the pieces and of END after ``rounds`` rounds of expected counts over (word, c); small: the vocabulary's size."""
    logp = dict(prior)
    ends = sum(r.c for r in words.filter(F.col("word") == F.lit(END)).select("c").collect())  # one row at most
    for _ in range(rounds):
        shared = words.sparkSession.sparkContext.broadcast(logp)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            lattice = Lattice(shared.value)
            into = np.zeros(len(lattice.weights))
            for batch in _gathered(batches):
                lattice.expect(batch.column(0).to_pylist(), batch.column(1).to_pylist(), into)
            yield pa.record_batch([lattice.known, pa.array(into[:-1])], ["piece", "n"])

        made = words.filter((F.col("c") > 0) & (F.col("word") != F.lit(END))).select("word", "c").mapInArrow(run, "piece string, n double").groupBy("piece").agg(F.sum("n").alias("n"))
        counts = {r.piece: r.n for r in made.collect()}
        total = math.fsum(counts.values()) + PRIOR_WEIGHT
        logp = {p: math.log((counts.get(p, 0.0) + PRIOR_WEIGHT * math.exp(w)) / total) for p, w in prior.items()}
    pieces = math.fsum(math.exp(w) for w in logp.values())
    uses = total if rounds and ends else 1.0
    end = (ends + 1) / (uses + ends + 1) if rounds else 0.01
    return {p: w + math.log1p(-end) - math.log(pieces) for p, w in logp.items()} | {"": math.log(end)}


def _scored(words: DataFrame, logp: dict[str, float]) -> DataFrame:
    """(word, n, c, lp): with the base-10 log probability of every word and of END."""
    shared = words.sparkSession.sparkContext.broadcast(logp)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice({p: w for p, w in shared.value.items() if p})
        for batch in _gathered(batches):
            words = batch.column(0).to_pylist()
            lp = np.where([w == END for w in words], shared.value[""], lattice.marginals(words)) / math.log(10)
            yield pa.record_batch([*batch.columns, pa.array(lp)], ["word", "n", "c", "lp"])

    return words.mapInArrow(run, "word binary, n long, c long, lp double")


def _threshold(words: DataFrame, most: int) -> int:
    """The least count that at most ``most`` words reach (in steps of a quarter octave)."""
    step = F.floor(4 * F.log2("n"))
    at = words.groupBy(step.alias("b")).agg(F.count("*").alias("words"), F.min("n").alias("low")).orderBy(F.desc("b")).collect()  # at most 256 rows
    total, low = 0, (1 << 62)
    for r in at:
        total += r.words
        if total > most:
            break
        low = r.low
    return low


def score(df: DataFrame, learn: Column, vocabulary_path: str, text: str = "text", rounds: int = 2, frequent: int = FREQUENT, keep_text: bool = True) -> DataFrame:
    """Every row with RESULTS, learning from the rows where ``learn`` holds (NULL: no).

    Tokens are words and one end for each text.  n_known counts tokens that are in the training tokens, train_tokens all
    of those; base_score sums log10((c + 0.5) / (N + 0.5 * (V + 1))) over the tokens, score is the model's base-10 log
    probability of the text.  NULL, empty and blank texts are the end alone.  Repeated rows count as often as they are
    there and get equal results.  Without training texts c, N and V are 0 and the pieces keep their prior.  An empty table
    gives an empty result; input columns named like the results give way.  Without ``keep_text`` the text is dropped and
    so not stored.  Runs jobs while it is called: the counts, the pieces' weights and the partial sums are stored.
    """
    spark = prepare(df.sparkSession).sparkContext
    columns = [c for c in df.columns if c.lower() not in RESULTS and (keep_text or c != text)]
    words = store(_counts(df.select(F.col(f"`{text}`").alias("text"), F.coalesce(learn, F.lit(False)).alias("learn"))))
    size = words.agg(F.sum("c").alias("n"), F.count(F.when(F.col("c") > 0, 1)).alias("v")).first()
    n_train, total = size.n or 0, math.log10((size.n or 0) + 0.5 * (size.v + 1))
    known = store(_scored(words, learn_pieces(words, vocabulary(vocabulary_path), rounds)))
    least = _threshold(known, frequent)
    often = spark.broadcast({bytes(r.word): (r.c, r.lp) for r in known.filter(F.col("n") >= least).collect()})  # at most `frequent` rows

    kind = "struct<tokens:bigint,known:bigint,base:double,lp:double,words:array<binary>,times:array<bigint>>"

    @F.arrow_udf(kind)
    def sums(texts: pa.Array) -> pa.Array:
        tokens, known_n, base, lp, rare, times = [], [], [], [], [], []
        get = often.value.get
        for t in texts.to_pylist():
            counts = Counter(words_of(t))
            counts[END] = 1
            n, k, b, p, other = 0, 0, [], [], []
            for w, tf in counts.items():
                n += tf
                if (found := get(w)) is None:
                    other.append(w)
                else:
                    k += tf * (found[0] > 0)
                    b.append(tf * math.log10(found[0] + 0.5))
                    p.append(tf * found[1])
            for out, v in ((tokens, n), (known_n, k), (base, math.fsum(b)), (lp, math.fsum(p)), (rare, other), (times, [counts[w] for w in other])):
                out.append(v)
        types = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.list_(pa.binary()), pa.list_(pa.int64()))
        names = ("tokens", "known", "base", "lp", "words", "times")
        return pa.StructArray.from_arrays([pa.array(v, t) for v, t in zip((tokens, known_n, base, lp, rare, times), types, strict=True)], names)

    row, own = fresh(columns, "row"), fresh(columns, "own")
    made = df.select(*[f"`{c}`" for c in columns], sums(F.col(f"`{text}`")).alias(own)).withColumn(row, F.monotonically_increasing_id())
    rows = store(made)  # the row numbers are fixed from here on
    rare = rows.select(F.col(row).alias("row"), F.explode(F.arrays_zip(F.col(f"{own}.words").alias("word"), F.col(f"{own}.times").alias("times"))).alias("m")).select("row", F.col("m.word").alias("word"), F.col("m.times").alias("tf"))
    met = rare.join(known.filter(F.col("n") < least).select("word", "c", "lp"), "word")
    rest = met.groupBy("row").agg(F.sum(F.when(F.col("c") > 0, F.col("tf")).otherwise(0)).alias("k"), F.sum(F.col("tf") * F.log10(F.col("c") + 0.5)).alias("b"), F.sum(F.col("tf") * F.col("lp")).alias("p"))
    rest = rest.select(F.col("row").alias(row), F.struct("k", "b", "p").alias(rest_name := fresh([*columns, row, own], "rest")))
    joined = rows.join(rest, row, "left")
    o, r = (lambda f: F.col(f"{own}.{f}")), (lambda f: F.coalesce(F.col(f"{rest_name}.{f}"), F.lit(0)))
    results = F.struct(
        o("tokens").alias("n_tokens"), (o("known") + r("k")).alias("n_known"), F.lit(n_train).cast("long").alias("train_tokens"),
        (o("base") + r("b") - o("tokens") * F.lit(total)).alias("base_score"), (o("lp") + r("p")).alias("score"),
    )
    return add_struct(joined, results, RESULTS).drop(row, own, rest_name)
