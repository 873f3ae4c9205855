"""The pipeline's stages against plain versions of what they should keep and change."""

import re

import corpus_pipeline as pipeline
from cohortloom.llm import decontaminate
from cohortloom.llm.queries import TOKENIZER

SF = "/root/testdata/sf0.01"


def one_of_each(rows):
    """Smallest id of each component of texts whose five-word shingles have a Jaccard similarity of 0.8 or more."""
    sets = {}
    for i, r in rows.items():
        w = (r.text or "").encode().lower().split()
        sets[i] = frozenset(tuple(w[p : p + 5]) for p in range(max(1, len(w) - 4))) if w else frozenset()
    boss = {i: i for i in rows}

    def find(i):
        while boss[i] != i:
            i = boss[i]
        return i

    ids = sorted(rows, key=lambda i: len(sets[i]))
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            if 5 * len(sets[a]) < 4 * len(sets[b]):
                break
            same = len(sets[a] & sets[b])
            if 5 * same >= 4 * (len(sets[a]) + len(sets[b]) - same):
                lo, hi = sorted((find(a), find(b)))
                boss[hi] = lo
    return {find(i) for i in rows}


def test_stages_in_order(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    items = [decontaminate.words_of(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    windows = {tuple(w[s : s + min(13, len(w))]) for w in items if w for s in range(max(1, len(w) - 12))}
    kept = [r for r in docs.collect()]
    out = docs
    for k, (_, stage) in enumerate(pipeline.STAGES):
        before = {r.doc_id: r for r in kept}
        out = stage(spark, out, SF)
        rows = out.collect()
        after = {r.doc_id: r for r in rows}
        assert len(rows) == len(after) and set(after) <= set(before)
        if k < 4:
            assert out.columns == columns
        if k == 0:
            known = [i for i in before if i in labels]
            assert sum((i in after) == (labels[i] == 1) for i in known) >= 0.97 * len(known)
        elif k == 1:
            assert set(after) == one_of_each(before)
        elif k == 2:
            for i, r in before.items():
                w = decontaminate.words_of(r.text)
                hit = {q for n in {len(x) for x in windows} for p in range(len(w) - n + 1) if tuple(w[p : p + n]) in windows for q in range(p, p + n)}
                assert (i in after) == (not hit or 20 * len(hit) < len(w))
                assert i not in after or hit or after[i].text == r.text
        elif k == 3:
            assert set(after) == set(before) and any("[EMAIL]" in r.text for r in rows) and not any(re.search(r"[a-z0-9]@[a-z0-9-]+\.[a-z]", r.text) for r in rows)
            assert all(r.n_chars == len(r.text) for r in rows)
        else:
            assert set(after) == set(before) and all(r.text == before[r.doc_id].text and len(r.ids_packed) == 4 * r.n_tokens for r in rows)
        kept = rows


def test_nulls_repeats_and_nothing(spark):
    rows = [(1, "one two three", "en", "s", 13, "x"), (1, "one two three", "en", "s", 13, "x"), (None, None, None, None, None, "x"), (2, "", None, "s", 0, "x"), (None, "a@b.com", "en", None, 7, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, __in string")
    for _, stage in pipeline.STAGES:
        assert stage(spark, df.limit(0), SF).collect() == []
    assert pipeline.near_copies_stage(spark, df, SF).count() == 3  # copies are one, NULL and empty texts are one
    changed = {r.text for r in pipeline.personal_data_stage(spark, df, SF).collect()}
    assert changed == {"one two three", None, "", "a@b.com"} or "[EMAIL]" in changed
    assert pipeline.benchmark_stage(spark, df, SF).count() == 5 and pipeline.tokens_stage(spark, df, SF).count() == 5 and TOKENIZER
