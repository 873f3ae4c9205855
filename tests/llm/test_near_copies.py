"""The pipeline's near copies against Jaccard similarities of all pairs."""

import random
from itertools import combinations

import corpus_pipeline as pipeline
from cohortloom.llm import nearcopies, simhash


def shingle_set(text):
    words = text.lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def similar(a, b):
    return 5 * len(a & b) >= 4 * len(a | b)


def made_texts(seed):
    """Groups of edited texts with similarities on both sides of 0.8, short texts, copies and a hot group."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(r.randint(2, 7)))
    texts = ["", "one", "One", "one two three four", "one two three five"]
    for size, n, edits in [(60, 12, 3), (100, 20, 3), (200, 12, 7), (25, 10, 1), (150, 60, 5)]:
        base = [word() for _ in range(size)]
        for _ in range(n):
            made = list(base)
            for _ in range(r.randint(0, edits)):
                made[r.randrange(len(made))] = word()
            texts.append(" ".join(made if r.random() < 0.7 else made[r.randint(0, size // 6) :]))
    return texts + texts[5:8]


def test_near_copies_brute_force(spark):
    texts = made_texts(1)
    sets = [shingle_set(t) for t in texts]
    root = list(range(len(texts)))
    missed = 0
    for i, j in combinations(range(len(texts)), 2):
        if similar(sets[i], sets[j]):
            missed += ((simhash.fingerprint_of(texts[i], 3) ^ simhash.fingerprint_of(texts[j], 3)) & (1 << 64) - 1).bit_count() > 3
            lo, hi = sorted((root[i], root[j]))
            root = [lo if v == hi else v for v in root]
    assert missed > 100  # such pairs are out of reach of 3 bits
    df = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(r.doc_id for r in pipeline.near_copies_stage(spark, df, "").collect()) == sorted(set(root))


def test_near_copies_of_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    sets = {i: set(nearcopies.shingles_of(t).tolist()) for i, t in texts.items()}
    assert all(len(sets[i]) == len(shingle_set(t)) for i, t in texts.items() if t.isascii())
    after = {r.doc_id for r in pipeline.near_copies_stage(spark, docs, "").collect()}
    assert not any(similar(sets[i], sets[j]) for i, j in combinations(sorted(after), 2))
    assert all(any(similar(sets[i], sets[j]) for j in sets if j != i) for i in set(sets) - after)


def test_band_keys_meet():
    """Pairs at 0.8 share a band key."""
    r = random.Random(2)
    for _ in range(150):
        words = [str(r.random()) for _ in range(104)]
        at = r.randint(0, 80)  # 100 shingles and 90 of them with 10 others in common: 90 / 110 >= 0.8
        other = words[:at] + ["x"] + words[at + 1 :]
        a, b = (" ".join(w) for w in (words, other))
        x, y = set(nearcopies.shingles_of(a).tolist()), set(nearcopies.shingles_of(b).tolist())
        if similar(x, y):
            assert set(nearcopies.sketch_of(a)[3]) & set(nearcopies.sketch_of(b)[3])


def test_rare_pairs_of_a_hot_group(spark):
    """Every pair of 0.8 or more meets; texts that share three fifths with all others and no more meet hardly ever."""
    r = random.Random(9)
    common = [f"c{k}" for k in range(120)]
    made = []
    for n in range(120):
        own = [f"o{n}x{k}" for k in range(60)]
        made.append(" ".join(common + own))
        if n % 10 == 0:
            made.append(" ".join(common + own[:-2] + [f"e{n}"]))
    r.shuffle(made)
    sets = [set(nearcopies.shingles_of(t).tolist()) for t in made]
    df = spark.createDataFrame([(i, i, [x if x < 1 << 63 else x - (1 << 64) for x in s]) for i, s in enumerate(sets)], "node long, component long, `set` array<long>")
    got = {(p.src, p.dst) for p in nearcopies._rare_pairs(df).collect()}
    wanted = {(i, j) for i, j in combinations(range(len(sets)), 2) if similar(sets[i], sets[j])}
    assert len(wanted) >= 12 and wanted <= got and len(got) < 5 * len(wanted)


def test_fingerprints_make_links(spark):
    """Nodes without a common band key are linked if the fingerprints name them and their sets are alike."""
    base = [f"w{k}" for k in range(300)]
    texts = [" ".join(base), " ".join([*base, "x"]), " ".join(["y", *base, "x"]), " ".join(base[:10])]
    sketches = [nearcopies.sketch_of(t) for t in texts]
    fps = [simhash.fingerprint_of(t, 3) for t in texts]
    assert 0 < ((fps[0] ^ fps[1]) & (1 << 64) - 1).bit_count() <= 3
    fps[2], fps[3] = fps[0], fps[0]  # one fingerprint for several nodes, one of them unlike
    members = spark.createDataFrame([(i, m[0], [], f) for i, (m, f) in enumerate(zip(sketches, fps, strict=True))], "node long, n long, keys array<long>, fp long")
    found = nearcopies.links(members, spark.createDataFrame(list(enumerate(texts)), "node long, text string"))
    assert {(r.node, r.component) for r in found.collect()} == {(0, 0), (1, 0), (2, 0)}
