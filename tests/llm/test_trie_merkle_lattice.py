"""Prefix trie, Merkle manifest and lattice scores against plain versions, and their edges."""

import hashlib
import itertools
import math
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from cohortloom.llm import lattice, merkle, prefixtrie, queries


@pytest.fixture
def many_ranges(spark):
    """Small tables stay in several ranges, so that borders between them are met."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield spark
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def sha(x):
    return hashlib.sha256(x.encode() if isinstance(x, str) else x).hexdigest()


# ---- trie ----


def plain_trie(rows):
    """Nodes of the registered query's trie by listing every prefix; rows are (conv_id, turn, role, text) without ties."""
    own = defaultdict(list)
    for c, t, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
        own[c].append((role or "", text or ""))
    built = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = tuple(own.get(c - int(math.fmod(c, 20)), [])[:h] + own[c][h:])
    members = defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    kids = defaultdict(set)
    for p in members:
        if p:
            kids[p[:-1]].add(p)
    own_saved = {p: (len(m) - 1) * (len(p[-1][1].encode().split()) if p else 0) for p, m in members.items()}
    leaves, saved = Counter(), Counter()
    for p in members:
        for d in range(len(p) + 1):
            leaves[p[:d]] += not kids[p]
            saved[p[:d]] += own_saved[p]
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else -1, len(m), len(kids[p]), leaves[p], saved[p], sha(",".join(str(c) for c in sorted(m) if built[c] == p))) for p, m in members.items())


def trie_rows(spark, rows, block):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    own = F.crc32(F.col("conv").cast("string").cast("binary")) % 4
    made = prefixtrie.trie(prefixtrie.rebuilt(prefixtrie.turns_of(df), own, F.col("conv") - F.col("conv") % 20, 3), block=block)
    return sorted(tuple(-1 if k == "parent_conv_id" and v is None else v for k, v in r.asDict().items()) for r in made.collect())


@pytest.mark.parametrize("block, seed", [(256, 1), (3, 2), (1, 3)])
def test_trie_against_all_prefixes(many_ranges, block, seed):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-50, 400), 70):
        base = rng.choice([0, 0, 1, 3, 4, 9, 14])
        rows += [(c, t, rng.choice(["user", "bot"]) if rng.random() < 0.3 else "user", rng.choice(["a b", "c", None, "x  y\nz"]) if rng.random() < 0.4 else "same words") for t in range(base + 1)]
    rows += [(1000 + c, t, "user", "copy of all") for c in range(12) for t in range(8)]  # a group of copies
    rng.shuffle(rows)
    assert trie_rows(many_ranges, rows, block) == plain_trie(rows)


def test_trie_edges(spark):
    rows = [(None, 0, "user", "lost"), (5, None, None, None), (5, 1, "user", "b"), (7, 0, "u", "only")]
    assert trie_rows(spark, rows, 256) == plain_trie(rows)
    assert trie_rows(spark, [], 256) == []
    alone = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4)  # its one turn gives way to a conversation that isn't there
    assert trie_rows(spark, [(alone, 0, "u", "x")], 256) == [(alone, 0, -1, 1, 0, 1, 0, sha(str(alone)))]
    ties = [(20, 1, "u", "x"), (20, 1, "u", "x"), (20, 1, "a", "y"), (40, 1, "a", "y"), (40, 1, "u", "x"), (40, 1, "u", "x")]
    nodes = trie_rows(spark, ties, 256)
    assert [n[3] for n in nodes if n[0] == 20 and n[1] == 0] == [2] and max(n[1] for n in nodes) == 3  # ties by content: both are the same
    df = spark.createDataFrame([(1, 0, "u", "x", "e")], "conv_id long, turn long, role string, text string, conv string")
    assert prefixtrie.turns_of(df).count() == 1
    long = [(60, t, "u", "w" * 50_000 if t == 5 else "w") for t in range(20)]
    assert trie_rows(spark, long, 4) == plain_trie(long)


# ---- Merkle ----


def plain_manifest(rows, fanout=16):
    """Leaf, subroot, root, siblings and folded root of (doc_id, source, lang, n_chars, text), by lists."""

    def part(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    def leaf(r, text):
        return sha("".join(map(part, (*r[:4], text))))

    def tree(nodes):
        """Root of a list of digests, and each one's siblings as (before, after), level by level."""
        paths, at = [[] for _ in nodes], list(range(len(nodes)))
        while len(nodes) > 1:
            for k, i in enumerate(at):
                run = nodes[i - i % fanout : i - i % fanout + fanout]
                paths[k].append(("".join(run[: i % fanout]), "".join(run[i % fanout + 1 :])))
                at[k] = i // fanout
            nodes = [sha("".join(nodes[i : i + fanout])) for i in range(0, len(nodes), fanout)]
        return nodes[0], paths

    groups = defaultdict(list)
    for r in rows:
        groups[r[1]].append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    inner = {}
    for s in names:
        groups[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[4])))
        inner[s] = tree([leaf(r, r[4]) for r in groups[s]])
    root, outer = tree([inner[s][0] for s in names])
    out = []
    for s, up in zip(names, outer, strict=True):
        for r, path in zip(groups[s], inner[s][1], strict=True):
            text = r[4]
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and text is not None:
                text = text.translate({k: k + 32 for k in range(65, 91)})
            whole, h = path + up, leaf(r, text)
            for pre, post in whole:
                h = sha(pre + h + post)
            out.append((r[0], leaf(r, r[4]), inner[s][0], root, sha("".join(a + b for a, b in whole)), h, h == root))
    return sorted(out, key=repr)


def merkle_rows(spark, rows, monkeypatch):
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    monkeypatch.setattr(queries, "read", lambda *_: df)
    return sorted((tuple(r[c] for c in ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")) for r in queries.op12_merkle(spark, "").collect()), key=repr)


def test_manifest_against_lists(many_ranges, monkeypatch):
    rng = random.Random(5)
    rows = [(i, rng.choice(["hot"] * 8 + ["é", "z", None, ""]), rng.choice(["en", None]), rng.choice([3, None]), rng.choice(["Some Text", "ünï Ö", "", None])) for i in range(340)]
    rows += [(1000, "alone", "en", 1, "X"), (7, "hot", "en", 4, "twice"), (7, "hot", "en", 4, "twice"), (None, "z", None, None, "Q"), (2000, "long", "en", 1, "Ab" * 100_000)]
    rows += [(3000 + k, f"s{k:03d}", "en", 1, "t") for k in range(30)]
    rng.shuffle(rows)
    got = merkle_rows(many_ranges, rows, monkeypatch)
    assert got == plain_manifest(rows)
    assert {v[-1] for v in got} == {True, False}


def test_manifest_edges(spark, monkeypatch):
    assert merkle_rows(spark, [], monkeypatch) == []
    one = [(5, "s", "en", 1, "A")]
    got = merkle_rows(spark, one, monkeypatch)
    assert got == plain_manifest(one) and got[0][1] == got[0][2] == got[0][3] and got[0][4] == sha("")
    df = spark.createDataFrame([(1, "s", "a", "b"), (2, "s", "a", "b")], "doc_id long, source string, leaf string, pos string")
    made = merkle.manifest(df, merkle.leaf(F.col("doc_id")), carry={c: F.col(c) for c in df.columns})
    assert made.columns == ["doc_id", "source", "pos", "leaf", "subroot", "root", "path"] and made.count() == 2
    other = merkle.manifest(df, merkle.leaf(F.col("doc_id")), fanout=2).select(merkle.fold(F.col("leaf"), F.col("path")).alias("f"), "root").collect()
    assert all(r.f == r.root for r in other)


# ---- lattice ----


def test_marginal_is_the_sum_over_segmentations():
    prior = lattice.vocabulary(queries.PIECES)
    model = lattice.Lattice(prior)
    for word in ["the", "onhere", "queé", "a", "漢字", "͸x", "e" * 14]:
        s = lattice.START + word
        sums = []
        for cuts in itertools.product([False, True], repeat=len(s) - 1):
            at = [0, *[i + 1 for i, c in enumerate(cuts) if c], len(s)]
            logs = [prior.get(s[a:b]) if s[a:b] in prior else (sum(prior[x] for x in model._bytes(s[a])) if b == a + 1 else None) for a, b in itertools.pairwise(at)]
            if None not in logs:
                sums.append(math.exp(math.fsum(logs)))
        assert math.isclose(model.marginals([word.encode()])[0], math.log(math.fsum(sums)), rel_tol=1e-9)
    assert math.isclose(math.fsum(math.exp(w) for w in prior.values()), 1, rel_tol=1e-9)


def test_expected_counts_are_alike_in_both_ways():
    import numpy as np

    model = lattice.Lattice(lattice.vocabulary(queries.PIECES))
    words = [w.encode() for w in ["thereof", "in", "queéle", "thereof", "x" * 40, "͸"]]
    a, b = np.zeros(len(model.weights)), np.zeros(len(model.weights))
    model.expect(words, [2, 1, 1, 1, 1, 3], a)
    for w, n in zip(words, [2, 1, 1, 1, 1, 3], strict=True):
        model._expected(lattice.START + w.decode(), n, b)
    assert np.allclose(a, b)


@pytest.mark.parametrize("frequent", [50, 100_000])
def test_scores_against_counts(spark, frequent):
    rng = random.Random(3)
    words = ["The", "cat", "onhere", "é", "zz9", "　wide", "tab"] + [f"w{k}" for k in range(200)]
    rows = [(i, " ".join(rng.choices(words, k=rng.randrange(0, 40)))) for i in range(120)] + [(500, None), (501, ""), (502, " \n"), (503, "cat " * 20_000), (1, "cat cat"), (None, "cat")]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "doc_id long, text string, __row string, SCORE string")
    made = lattice.score(df, queries.fold(5) != 1, queries.PIECES, frequent=frequent)
    assert made.columns == ["doc_id", "text", "__row", *lattice.RESULTS]
    got = made.collect()
    learn = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 != 1
    tokens = lambda t: [w for w in (t or "").encode().lower().split()] + [b""]
    c = Counter(w for i, t in rows if learn(i) for w in tokens(t))
    n, v = sum(c.values()), len(c)
    assert len(got) == len(rows)
    for r in got:
        w = tokens(r.text)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(w), sum(c[x] > 0 for x in w), n)
        assert math.isclose(r.base_score, sum(math.log10((c[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w), rel_tol=1e-9)
        assert r.score < 0
    ends = {r.score for r in got if r.n_tokens == 1}
    assert len(ends) == 1
    assert lattice.score(df.limit(0), F.lit(True), queries.PIECES).collect() == []
    assert all(r.train_tokens == 0 and r.n_known == 0 for r in lattice.score(df, F.lit(None).cast("boolean"), queries.PIECES).collect())


def test_learning_helps_on_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    held = queries.fold(5) == 1
    taught, prior = (lattice.score(docs, ~held, queries.PIECES, rounds=r).filter(held).agg(F.sum("score")).first()[0] for r in (2, 0))
    assert taught > 0.8 * prior and taught < 0
