"""Nulls, empty and long texts, repeated rows, empty tables and clashing column names, for every operator."""

import pytest

from cohortloom.llm import bpe, chat, decontaminate, langid, linefreq, pii, quality, simhash, suffixes, wrapper
from cohortloom.llm.queries import TOKENIZER

LONG = "alpha beta, gamma. " * 3000
TEXTS = [(1, "one two three four five"), (1, "one two three four five"), (2, None), (3, ""), (None, "call +1 (301) 555-0346 now"), (5, LONG), (5, LONG), (6, " \n\t"), (None, None), (7, "½ 😀 ü")]
NAMES = ["doc_id long", "text string", "lang string", "source string"]
CLASH = ["fp", "__row", "__in", "__fp", "__made", "k1", "k2", "host", "found", "words", "lines", "r", "gone", "spans", "score", "kept", "text_", "N_TOKENS"]


def frame(spark, rows, extra=CLASH):
    """Documents with a column under many names that operators use themselves."""
    full = [(i, t, "en" if n % 2 else None, None if n % 3 else "s", *["x"] * len(extra)) for n, (i, t) in enumerate(rows)]
    return spark.createDataFrame(full, ", ".join([*NAMES, *[f"`{c}` string" for c in extra]]))


def items(spark, rows=((1, "one two three"), (2, None), (None, "alpha beta gamma alpha"), (3, ""))):
    return spark.createDataFrame(list(rows), "item_id long, text string")


def labels(spark, rows=((1, 1), (3, 0), (5, 1), (None, 1), (2, None))):
    return spark.createDataFrame(list(rows), "doc_id long, quality int")


OPERATORS = {
    "bpe": lambda s, d: bpe.encode_decode(d, TOKENIZER),
    "line rules": lambda s, d: linefreq.line_rules(d),
    "line rules without text": lambda s, d: linefreq.line_rules(d, keep_text=False),
    "suffixes": lambda s, d: suffixes.dedup(d),
    "decontaminate": lambda s, d: decontaminate.decontaminate(d, items(s)),
    "quality": lambda s, d: quality.classify(d, d, labels(s)),
    "langid": lambda s, d: langid.identify(d, d),
    "simhash": lambda s, d: simhash.components(d),
    "pii": lambda s, d: pii.find(d),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_rows_stay(spark, name):
    df = frame(spark, TEXTS)
    out = OPERATORS[name](spark, df)
    lower = [c.lower() for c in out.columns]
    assert len(lower) == len(set(lower))
    dropped = {"text"} if name.endswith("without text") else set()
    assert {c.lower() for c in df.columns} - dropped <= set(lower)
    got = out.collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(i) for i, _ in TEXTS)
    by_row = {}
    for r in got:  # equal rows, equal results (but for the one that stays of a group of copies)
        by_row.setdefault((r.doc_id, r["text"] if not dropped else r["n_words"]), set()).add(str([v for k, v in r.asDict().items() if k not in ("stays", "lang", "source")]))
    assert all(len(v) == 1 for v in by_row.values())


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, name):
    assert OPERATORS[name](spark, frame(spark, [], ())).collect() == []


def test_no_items_and_no_labels(spark):
    df = frame(spark, TEXTS, ())
    assert all(r.n_hit == 0 and not r.contaminated for r in decontaminate.decontaminate(df, items(spark, ())).collect())
    assert all(r.score == 0.5 for r in quality.classify(df, df, labels(spark, ())).collect())
    assert {r.lang_pred for r in langid.identify(df, df.limit(0)).collect()} == {"und"}


def test_pages(spark):
    rows = [(1, "http://a.example/x", "<p>one<p>two &amp; 3", "x"), (1, "http://a.example/x", "<p>one<p>two &amp; 3", "x"), (2, None, "<article>x</article>", "x"), (None, "no url", None, "x"), (4, "http://b.example", "", "x"), (5, "http://b.example", "<div>" * 5000 + "deep", "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, __host string")
    got = {(r.page_id, r.url): (r.text, r.n_chars) for r in wrapper.extract(df).collect()}
    assert got[(1, "http://a.example/x")] == ("one two & 3", 11) and got[(2, None)] == ("x", 1) and got[(None, "no url")] == ("", 0) and got[(5, "http://b.example")] == ("deep", 4)
    assert wrapper.extract(df).count() == 6 and wrapper.extract(df.limit(0)).collect() == []


def test_conversations(spark):
    schema = "conv_id long, turn long, role string, text string, n long, rendered string"
    rows = [(1, 0, "User ", "a", 1, "x"), (1, 1, None, None, 1, "x"), (None, None, "bot", "c", 1, "x"), (2, 0, "system", "s", 1, "x"), (3, 0, "user", "q", 1, "x"), (3, 0, "user", "q", 1, "x")]
    df = spark.createDataFrame(rows, schema)
    out = chat.repair(df).collect()
    whole = {}
    for r in sorted(out, key=lambda r: (str(r.conv_id), r.n, r["sub"])):
        whole[r.conv_id] = whole.get(r.conv_id, "") + r.rendered
    assert whole[1] == "<|user|>\na\n<|end|>\n<|assistant|>\n\n<|end|>\n"
    assert whole[2] == "<|system|>\ns\n<|end|>\n<|user|>\n\n<|end|>\n<|assistant|>\n\n<|end|>\n"
    assert whole[3] == "<|user|>\nq\nq\n<|end|>\n<|assistant|>\n\n<|end|>\n"
    assert whole[None].startswith("<|user|>\n") and chat.repair(df.limit(0)).collect() == []
