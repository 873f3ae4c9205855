"""Quality classifier by positive-unlabelled learning.

Trusted positives and unlabelled web text are all it learns from.  A first classifier that tells the two apart gives the
class prior: above any score, the share of unlabelled texts is at least the prior times that of positives, so the least
ratio over the upper parts of the scores (with a margin for their sizes) estimates it.  The final classifier is a small
network fitted on the non-negative unbiased risk: prior * E_p[l(g)] + max(0, E_u[l(-g)] - prior * E_p[l(-g)]).
"""

from __future__ import annotations

import re
from itertools import pairwise

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.common import add, prepare

#: Rows that are sampled (by a hash of the id, so alike at every run) for fitting: positives and unlabelled.
MAX_POSITIVE, MAX_UNLABELLED = 8_000, 12_000

_KINDS = {  # byte classes whose shares are features
    "upper": range(65, 91), "lower": range(97, 123), "digit": range(48, 58), "high": range(128, 256), "space": b" \t\r\x0b\x0c", "newline": b"\n",
    "sentence": b".,;:?'", "shout": b"!", "symbol": b"#$%&*~^=+@_", "frame": b"|<>[]{}\\/", "quote": b"\"`()-",
}
_ENDS_ODD = re.compile(r"[^\w\s.,;:?!'\")\]]$")


def features(text: str | None) -> list[float]:
    """Shares and logarithms that describe a whole text's form; zeros for NULL and empty."""
    if not text:
        return [0.0] * N_FEATURES
    raw = np.bincount(np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8), minlength=256)
    n = float(raw.sum())
    shares = [raw[list(kind)].sum() / n for kind in _KINDS.values()]
    words = text.split()
    w = max(1, len(words))
    counts: dict[str, int] = {}
    for x in words:
        counts[x] = counts.get(x, 0) + 1
    pairs = set(pairwise(words))
    lines = [x for x in text.split("\n") if x.strip()]
    odd = letterless = shouting = 0
    for x, k in counts.items():
        if not x[-1].isalnum() and _ENDS_ODD.search(x):
            odd += k
        if not any(map(str.isalpha, x)):
            letterless += k
        elif len(x) > 1 and x.isupper():
            shouting += k
    letters = max(1.0, n * (shares[0] + shares[1]))
    return [
        *shares, np.log1p(len(words)), np.log1p(len(text) / max(1, len(lines))), len(text) / w / 10, raw[65:91].sum() / letters,
        len(counts) / w, max(counts.values(), default=0) / w, len(pairs) / max(1, len(words) - 1), 1 - len(set(lines)) / max(1, len(lines)), odd / w, letterless / w, shouting / w,
    ]


N_FEATURES = len(_KINDS) + 11


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


class Net:
    """One hidden layer, fitted by Adam on whole batches from a fixed start."""

    def __init__(self, n: int, hidden: int = 16, seed: int = 7):
        r = np.random.default_rng(seed)
        self.w = [r.normal(0, n**-0.5, (n, hidden)), np.zeros(hidden), r.normal(0, hidden**-0.5, hidden), np.zeros(1)]

    def out(self, x: np.ndarray) -> np.ndarray:
        return np.tanh(x @ self.w[0] + self.w[1]) @ self.w[2] + self.w[3][0]

    def fit(self, x: np.ndarray, slope, rounds: int, rate: float = 0.02, decay: float = 1e-4) -> None:
        """slope: from the outputs to the risk's derivative by each of them."""
        m, v = [np.zeros_like(p) for p in self.w], [np.zeros_like(p) for p in self.w]
        for t in range(1, rounds + 1):
            h = np.tanh(x @ self.w[0] + self.w[1])
            d = slope(h @ self.w[2] + self.w[3][0])
            back = np.outer(d, self.w[2]) * (1 - h * h)
            grads = [x.T @ back + decay * self.w[0], back.sum(0), h.T @ d + decay * self.w[2], np.array([d.sum()])]
            for p, g, a, b in zip(self.w, grads, m, v, strict=True):
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                p -= rate * (a / (1 - 0.9**t)) / (np.sqrt(b / (1 - 0.999**t)) + 1e-8)


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Least ratio of the shares above a score, over scores that a third of the positives reach, with a margin."""
    cuts = np.quantile(positive, np.linspace(0.0, 0.67, 68))
    p = 1 - np.searchsorted(np.sort(positive), cuts, side="left") / len(positive)
    u = 1 - np.searchsorted(np.sort(unlabelled), cuts, side="left") / len(unlabelled)
    margin = np.sqrt(np.log(40.0) / (2 * len(unlabelled))) + np.sqrt(np.log(40.0) / (2 * len(positive)))
    ratio = (u + margin) / np.maximum(p, 1e-9)
    best = int(np.argmin(ratio))
    return float(np.clip(u[best] / max(p[best], 1e-9), 0.01, 0.99))


def fit_arrays(positive: np.ndarray, unlabelled: np.ndarray) -> dict:
    """A fitted model from features of positives and unlabelled texts; of constant score if one of the two is absent."""
    if not len(positive) or not len(unlabelled):
        return {"constant": 0.5}
    x = np.vstack([positive, unlabelled])
    mean, scale = x.mean(0), np.maximum(x.std(0), 1e-6)
    x = np.clip((x - mean) / scale, -8, 8)
    n, m = len(positive), len(unlabelled)
    is_p = np.arange(n + m) < n
    # Each fifth is scored by a classifier that has not seen it, else memorised positives make the prior too small.
    g = np.zeros(n + m)
    fifth = np.arange(n + m) % 5
    for k in range(5):
        seen = fifth != k
        mine, p_seen, u_seen = is_p[seen], max(1, int(is_p[seen].sum())), max(1, int((~is_p[seen]).sum()))
        apart = Net(x.shape[1])
        apart.fit(x[seen], lambda g, mine=mine, a=p_seen, b=u_seen: np.where(mine, -_sigmoid(-g) / a, _sigmoid(g) / b) / 2, 60, decay=1e-2)
        g[~seen] = apart.out(x[~seen])
    prior = estimate_prior(g[:n], g[n:])

    def slope(g: np.ndarray) -> np.ndarray:
        s = _sigmoid(g)
        negative = np.logaddexp(0, g[n:]).mean() - prior * np.logaddexp(0, g[:n]).mean()
        if negative < 0:  # step back up: the estimated risk of the negatives must not fall below zero
            return np.concatenate([prior * s[:n] / n, -s[n:] / m])
        return np.concatenate([prior * (s[:n] - 1) / n - prior * s[:n] / n, s[n:] / m])

    net = Net(x.shape[1], seed=11)
    net.fit(x, slope, 300, rate=0.01, decay=1e-3)
    return {"mean": mean, "scale": scale, "w": net.w, "prior": prior}


def scores(model: dict, x: np.ndarray) -> np.ndarray:
    if "constant" in model:
        return np.full(len(x), model["constant"])
    net = Net.__new__(Net)
    net.w = model["w"]
    return _sigmoid(net.out(np.clip((x - model["mean"]) / model["scale"], -8, 8)))


def _features(text: str) -> Column:
    @F.pandas_udf("array<double>")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([features(t) for t in texts])

    return run(text)


def _some(ids: DataFrame, at_most: int) -> tuple[DataFrame, int]:
    """About ``at_most`` ids, those with a hash below the returned bound (of 2^20)."""
    bound = min(1 << 20, int((1 << 20) * at_most / max(1, ids.count())))
    return ids.filter(_hash() < bound), bound


def _hash() -> Column:
    return F.pmod(F.xxhash64("doc_id", F.lit("fit")), F.lit(1 << 20))


def fit(docs: DataFrame, labels: DataFrame, max_positive: int = MAX_POSITIVE, max_unlabelled: int = MAX_UNLABELLED) -> dict:
    """Fit on documents (doc_id, text) and labels (doc_id, quality); both should hold training rows only.

    Positives are documents with a label 1; unlabelled ones have no label at all.  Rows with NULL id or label teach
    nothing.  Counts are taken first from ids alone, so that only texts of the sample are joined.
    """
    docs = docs.select("doc_id", "text").filter(F.col("doc_id").isNotNull())
    labels = labels.select("doc_id", "quality").filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
    ids = docs.select("doc_id").distinct()
    good, p_bound = _some(labels.filter("quality = 1").select("doc_id").distinct().join(ids, "doc_id", "left_semi"), max_positive)
    free, u_bound = _some(ids.join(labels, "doc_id", "left_anti"), max_unlabelled)
    chosen = good.withColumn("p", F.lit(1)).unionByName(free.withColumn("p", F.lit(0)))
    few = docs.filter(_hash() < max(p_bound, u_bound))  # no other text can be in the sample
    rows = few.join(chosen, "doc_id").select("p", F.xxhash64("doc_id", "text").alias("h"), _features("text").alias("x")).collect()  # bounded by the two limits
    rows.sort(key=lambda r: (r.h, r.p))
    part = lambda p: np.array([r.x for r in rows if r.p == p], dtype=float).reshape(-1, N_FEATURES)
    return fit_arrays(part(1), part(0))


def score(model: dict, text: Column) -> Column:
    @F.pandas_udf("double")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(scores(model, np.array([features(t) for t in texts], dtype=float).reshape(-1, N_FEATURES)), dtype="float64")

    return run(text)


def classify(df: DataFrame, docs: DataFrame, labels: DataFrame, text: str = "text", threshold: float = 0.3, **limits) -> DataFrame:
    """Every row of df with score (0 to 1, higher: better) and predicted (1 from the threshold on, else 0).

    The model is fitted on docs and labels (see ``fit``).  NULL and empty texts are scored by their (zero) features.
    Without positives or unlabelled texts every score is 0.5.  Repeated rows get equal scores; an empty table gives an
    empty result; input columns named like the two results give way.
    """
    prepare(df.sparkSession)
    model = fit(docs, labels, **limits)
    scored = add(df, {"score": score(model, F.col(f"`{text}`"))})
    return add(scored, {"predicted": (F.col("score") >= threshold).cast("int")})
