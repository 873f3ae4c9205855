"""Break removal by the queue against a plain version that scores every break from its values each time."""

import numpy as np
import pytest

from cohortloom.operators.breaks import Segments, prune

RULES = {
    "length": lambda m: (1.5 + np.minimum(2.5 / m[:, 0], 2.5), 1.0 + np.minimum(3.0 / np.maximum(m[:, 1], 1e-9), 3.0)),
    "noise": lambda m: (1.5 + 2 * (m[:, 0] > np.median(m[:, 0])), 1.0 + 2 * (m[:, 0] > np.quantile(m[:, 0], 0.95))),
    "quality": lambda m: (3.5 - 2 * m[:, 0], 3.0 - 2 * m[:, 0]),
}


def _plain(c, cuts, sd_lr, sd_baf, kind):
    cuts = list(cuts)
    while cuts:
        edge = [0, *cuts, len(c["lr"])]
        part = lambda k, i: c[k][edge[i] : edge[i + 1]]
        med = lambda x: np.median(x[~np.isnan(x)]) if (~np.isnan(x)).any() else np.nan
        step = lambda k: np.array([np.nan_to_num(abs(med(part(k, i + 1)) - med(part(k, i)))) for i in range(len(cuts))])
        pair = lambda f, k, g: np.array([f(g(part(k, i)), g(part(k, i + 1))) for i in range(len(cuts))], float)
        seen = {"length": lambda: np.c_[pair(min, "lr", len), pair(min, "baf_n", np.sum)], "noise": lambda: np.c_[pair(max, "nvar", np.mean), pair(max, "nvar", np.mean)],
                "quality": lambda: np.c_[pair(min, "hq", np.mean), pair(min, "hq", np.mean)]}[kind]()
        lr, baf = step("lr"), step("baf")
        need_lr, need_baf = RULES[kind](seen)
        bad = [(lr[i], baf[i], i) for i in range(len(cuts)) if lr[i] <= sd_lr * need_lr[i] and baf[i] <= sd_baf * need_baf[i]]
        if not bad:
            break
        cuts.pop(min(bad)[2])
    return cuts


def _arm(rng, n):
    level = np.repeat(rng.normal(0, 0.4, n // 10 + 1), 10)[:n]
    c = {"lr": np.round(level + rng.normal(0, 0.2, n), 2), "baf": np.round(rng.uniform(0, 0.5, n), 2), "baf_n": rng.integers(0, 4, n).astype(float),
         "nvar": rng.integers(1, 64, n) / 64.0, "hq": rng.integers(0, 2, n).astype(float)}
    c["lr"][rng.random(n) < 0.1] = np.nan
    c["baf"][rng.random(n) < 0.6] = np.nan
    return c


@pytest.mark.parametrize("kind", list(RULES))
def test_queue_equals_plain_removal(kind):
    rng = np.random.default_rng(11)
    removed = 0
    for _ in range(40):
        n = int(rng.integers(2, 160))
        c = _arm(rng, n)
        cuts = sorted(rng.choice(np.arange(1, n), int(rng.integers(0, n // 2 + 1)), replace=False).tolist())
        got = prune(c, cuts, 0.1, 0.1, kind, RULES[kind])
        assert got == _plain(c, cuts, 0.1, 0.1, kind)
        removed += len(cuts) - len(got)
    assert removed > 50


def test_a_removal_scores_two_breaks(monkeypatch):
    calls = []
    step = Segments.step
    monkeypatch.setattr(Segments, "step", lambda self, c, s: calls.append(s) or step(self, c, s))
    n = 20_000
    cuts = list(range(5, n, 5))
    left = prune(_arm(np.random.default_rng(12), n), cuts, 0.5, 0.5, "length", RULES["length"])
    assert len(left) < len(cuts) // 2
    assert len(calls) <= 2 * (len(cuts) + 2 * (len(cuts) - len(left)))
