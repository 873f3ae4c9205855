"""Each operator against a brute-force version, a round trip or held-out labels."""

import hashlib
import html as entities
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from cohortloom.llm import bpe, chat, decontaminate, langid, linefreq, pii, quality, queries, simhash, suffixes, wrapper
from cohortloom.llm.automaton import SuffixAutomaton

SF = "/root/testdata/sf0.001"


def docs(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}


def test_bpe_equals_the_library(spark):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(queries.TOKENIZER)
    texts = docs(spark)
    got = {r.doc_id: r for r in queries.op1_bpe(spark, SF).collect()}
    for i, text in texts.items():
        ids = t.encode(text or "", add_special_tokens=False).ids
        assert got[i].n_tokens == len(ids) and got[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest()


@pytest.mark.parametrize("text", ["", " ", "a  b\n\n c", "aaaa" * 99, "x<|endoftext|> y<|endoftext|>", "it's I'LL\x1c\x85", "12½ ٣ 日本語 😀 é", "z" * 5000 + "!?" * 50])
def test_bpe_odd_texts(text):
    from tokenizers import Tokenizer

    spec = bpe.load(queries.TOKENIZER)
    auto = bpe.Automaton(spec["labels"], spec["merges"], spec["special"])
    ids = Tokenizer.from_file(queries.TOKENIZER).encode(text, add_special_tokens=False).ids
    assert np.frombuffer(auto.encode(text), "<u4").tolist() == ids and auto.decode(auto.encode(text)) == text


def test_bpe_gadgets_on_small_merges():
    labels = [b"a", b"b", b"c", b"aa", b"ab", b"aab", b"bc", b"aaa"]
    merges = np.array([(0, 0, 3), (0, 1, 4), (3, 1, 5), (1, 2, 6), (3, 0, 7)])
    auto = bpe.Automaton(labels, merges, {})

    def merged(s):
        parts = [labels.index(bytes([c])) for c in s]
        for u, v, w in merges.tolist():
            out = []
            for p in parts:
                if out and out[-1] == u and p == v:
                    out[-1] = w
                else:
                    out.append(p)
            parts = out
        return parts

    r = random.Random(1)
    for _ in range(2000):
        s = bytes(r.choice(b"aabc") for _ in range(r.randint(1, 9)))
        assert auto.walk(s) == merged(s) and auto.accepts(merged(s)), s


def test_line_rules_counts(spark):
    rows = [(i, f"header line\nbody of text number {chr(97 + i // 26)}{chr(97 + i % 26)} " + "w" * i, "h") for i in range(30)] + [(99, "header line\nheader line", "h"), (98, "header line", "other")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: r for r in linefreq.line_rules(df).collect()}
    assert got[0].n_removed_lines == 1 and got[0].cleaned.startswith("body") and got[99].n_left_words == 0 and got[99].n_dup_lines == 1
    assert got[98].n_removed_lines == 0 and not got[99].kept


def test_html_against_article(spark):
    for r in wrapper.extract(spark.read.parquet(f"{SF}/pages.parquet")).collect():
        inner = re.search(r"<article>(.*)</article>", r.html, re.S)[1]
        assert r.text == " ".join(entities.unescape(re.sub(r"</?b>", "", re.sub(r"</?(?:p|h1|br)>", " ", inner))).split())


def test_wrapper_without_named_region():
    page = '<html><body><div id="menu"><a href=x>Home</a></div><div class="post"><h2>%s</h2><div>By staff</div><p>%s &amp; <i>m</i>ore<p>%s</div><div class="comments"><p>nice!</div><div>Copyright</div></body>'
    fold = None
    for w in ("one", "two", "three", "four"):
        e = wrapper.expression(page % (w, w * 3, w))
        fold = e if fold is None else wrapper.align(fold, e)
    rule = wrapper.rule(fold)
    assert rule["by"] == "text" and wrapper.main_text(page % ("one", "x y", "z"), rule) == "one x y & more z"


def brute_spans(texts, length):
    starts = {}
    for i, t in enumerate(texts):
        for s in range(len(t) - length + 1):
            starts.setdefault(t[s : s + length], []).append((i, s))
    gone = [np.zeros(len(t), bool) for t in texts]
    for places in starts.values():
        if len(places) > 1:
            for i, s in places:
                gone[i][s : s + length] = True
    return gone


@pytest.mark.parametrize("length", [40, 100])
def test_suffix_dedup_brute_force(spark, length):
    r = random.Random(length)
    passages = ["".join(r.choice("abcdé ") for _ in range(r.randint(length - 10, 3 * length))) for _ in range(6)]
    texts = ["".join(r.choice(["", r.choice(passages), r.choice(passages)[: r.randint(1, 2 * length)], "".join(r.choice("abc ") for _ in range(r.randint(0, 90)))]) for _ in range(6)) for _ in range(60)]
    texts += ["a" * 700, "a" * 300 + "b", "abab" * 200, texts[0], texts[0], ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    gone = brute_spans([t.encode() for t in texts], length)
    for row in suffixes.dedup(df, length=length).collect():
        m, raw = gone[row.doc_id], texts[row.doc_id].encode()
        assert bytes(row.kept) == bytes(c for c, g in zip(raw, m, strict=True) if not g), row.doc_id
        assert row.n_removed == m.sum() and row.n_spans == len(re.findall("1+", "".join(map(str, m.astype(int)))))


def test_loser_tree_merges_and_knows_prefixes():
    r = random.Random(3)
    strings = sorted({bytes(r.choice(b"ab") for _ in range(r.randint(1, 30))) for _ in range(400)})
    runs = []
    for k in range(7):
        part, before, cols = strings[k::7], b"", ([], [], [], [])
        for s in part:
            n = suffixes.common(before, s)
            for c, v in zip(cols, (n, len(s) - n, s[n:], (k, len(cols[0]))), strict=True):
                c.append(v)
            before = s
        runs.append(suffixes.Run(np.array(cols[0], "<u4").tobytes(), np.array(cols[1], "<u4").tobytes(), b"".join(cols[2]), np.array(cols[3], "<i8").tobytes()))
    out = list(suffixes.merge(runs))
    assert [s for _, s, _ in out] == strings
    assert all(n == suffixes.common(a, b) for (_, a, _), (_, b, n) in zip(out, out[1:], strict=False))


def test_suffix_automaton_longest_matches():
    r = random.Random(5)
    seqs = [[r.randint(0, 2) for _ in range(30)] for _ in range(5)]
    sam = SuffixAutomaton(seqs)
    joined = ["".join(map(str, s)) for s in seqs]
    text = [r.randint(0, 3) for _ in range(300)]
    state = matched = 0
    for i, c in enumerate(text):
        state, matched = sam.step(state, matched, c)
        want = next(n for n in range(i + 1, -1, -1) if any("".join(map(str, text[i + 1 - n : i + 1])) in j for j in joined))
        assert matched == want


@pytest.mark.parametrize("block_words, blocks", [(100_000, 8), (20, 8), (20, 2)])  # one block, one pass of blocks, many passes
def test_decontamination_brute_force(spark, monkeypatch, block_words, blocks):
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", block_words)
    monkeypatch.setattr(decontaminate, "BLOCKS", blocks)
    r = random.Random(2)
    vocab = ["a", "b", "c", "d", "é1"]
    items = [(i, " ".join(r.choice(vocab) for _ in range(r.choice([1, 4, 13, 20, 30])))) for i in range(12)] + [(90, None), (91, "!!")]
    texts = [(i, " ".join(r.choice([r.choice(vocab), "zz", items[r.randint(0, 11)][1].upper()]) for _ in range(25))) for i in range(40)]
    got = {x.doc_id: x for x in decontaminate.decontaminate(spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    for i, t in texts:
        words, hit, found = decontaminate.words_of(t), set(), set()
        for item, x in items:
            w = decontaminate.words_of(x)
            n = min(13, len(w))
            for s in range(len(w) - n + 1) if n else ():
                for p in range(len(words) - n + 1):
                    if words[p : p + n] == w[s : s + n]:
                        hit.update(range(p, p + n))
                        found.add(str(item))
        assert (got[i].n_words, got[i].n_hit, got[i].item_ids) == (len(words), len(hit), sorted(found))


def test_blocks_are_built_once(spark):
    blocks = [decontaminate.Shared(spark, [(str(k), f"alpha beta {k}")]) for k in range(decontaminate.BLOCKS)]
    decontaminate._items.cache_clear()
    for _ in range(10):
        found = decontaminate._read([[b"alpha", b"beta", b"3"], []], blocks, 13)
        assert found == [([[0, 3]], {"3"}, 3), ([], set(), 0)]
    assert decontaminate._items.cache_info().misses == len(blocks)


def test_chat_is_cheapest(spark):
    r = random.Random(4)
    convs = {c: [r.choice(["system", "user", "assistant", "tool", "User"]) for _ in range(r.randint(1, 9))] for c in range(60)} | {1000: [r.choice(["user", "assistant"]) for _ in range(500)]}
    df = spark.createDataFrame([(c, i, x, f"t{i}") for c, xs in convs.items() for i, x in enumerate(xs)], "conv_id long, turn long, role string, text string")

    def best(roles):
        cost = {0: 0}
        for x in roles:
            new = {}
            for s, v in cost.items():
                for c, to, _, _ in chat.edges(x)[s]:
                    new[to] = min(new.get(to, 1 << 50), v + c)
            cost = new
        return min(v + chat.END[s] for s, v in cost.items())

    for block in (4, 256):
        out, cost = {}, {}
        for x in sorted(chat.repair(df, block=block).collect(), key=lambda x: (x.conv_id, x.n, x["sub"])):
            out.setdefault(x.conv_id, []).append(x)
        for c, xs in out.items():
            roles = [x.role for x in xs if not x.merged]
            assert roles[0] in ("system", "user") and roles[-1] == "assistant" and all((a, b) in {("system", "user"), ("user", "assistant"), ("assistant", "user")} for a, b in zip(roles, roles[1:], strict=False))
            given = {x.turn: x for x in xs if x.turn is not None}
            assert len(given) == len(convs[c])
            cost[c] = sum(chat.INSERT for x in xs if x.turn is None) + sum(chat.MERGE * x.merged + chat.RELABEL * (convs[c][t].lower() in chat.ROLES and x.role != convs[c][t].lower()) for t, x in given.items())
            assert cost[c] == best(convs[c])


def test_quality_held_out(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = [r for r in queries.op7_quality(spark, sf).collect() if r.held_out and r.doc_id in truth]
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in rows)
    assert np.mean([r.predicted == truth[r.doc_id] for r in rows]) >= 0.97


def test_prior_and_risk():
    r = np.random.default_rng(0)
    pos, neg = r.normal(2, 1, (3000, quality.N_FEATURES)), r.normal(-2, 1, (3000, quality.N_FEATURES))
    model = quality.fit_arrays(pos[:1000], np.vstack([pos[1000:2800], neg[:1200]]))
    assert abs(model["prior"] - 0.6) < 0.06
    assert (quality.scores(model, pos[2800:]) > 0.5).mean() > 0.98 and (quality.scores(model, neg[1200:]) < 0.3).mean() > 0.98


def test_language_held_out(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect()}
    rows = [r for r in queries.op8_language(spark, sf).collect() if r.held_out]
    assert rows and np.mean([r.lang_pred == truth[r.doc_id] for r in rows]) >= 0.98 and all(0 <= r.score <= 1 for r in rows)


def test_language_sample_is_lowest_hashes(spark):
    """Texts of lowest hash until the limit; copies count once; no language is left out."""
    few = [(f"w{k} copied text of a small language", "copies") for k in range(20) for _ in range(400)]
    long = [("quok wibble " * 20_000, "long")]
    many = [(f"this is plain text number {k} of many", "many") for k in range(5_000)]
    df = spark.createDataFrame([*few, *long, *many, (None, "many"), ("", "many"), ("x", None), ("", "empty")], "text string, lang string")
    got = {}
    for name, text in langid.sample(df, "text", "lang", 1_000):
        got.setdefault(name, []).append(text)
    assert set(got) == {"copies", "long", "many"}
    hashed = df.select("text", "lang", F.shiftrightunsigned(F.xxhash64("text"), 11).alias("h")).filter("length(text) > 0 and lang is not null").distinct().collect()
    for name, texts in got.items():
        want, left = [], 1_000
        for r in sorted((r for r in hashed if r.lang == name), key=lambda r: r.h):
            if left > 0:
                want.append(r.text[:50][:left])
                left -= len(want[-1])
        assert sorted(want) == sorted(texts)
    asked = spark.createDataFrame([("wibble quok wibble",), ("w3 copied text",)], "text string")
    rows = {r.text: r.lang_pred for r in langid.identify(asked, df, chars=1_000).collect()}
    assert rows == {"wibble quok wibble": "long", "w3 copied text": "copies"}


def test_phrases_by_definition():
    p = langid.Parser([("x", "abc abd"), ("y", "qqq")])
    for w in ("abc", "abab", "zab", "cq"):
        text, n, i, seen = f" {w} ", 0, 0, " abc abd "
        while i < len(text):
            k = max((k for k in range(1, len(text) - i + 1) if text[i : i + k] in seen), default=1)
            n, i = n + 1, i + k
        assert p.word(w) & (1 << langid.BITS) - 1 == n, w


def test_simhash_brute_force(spark):
    texts = docs(spark)
    got = {r.doc_id: r for r in queries.op9_simhash(spark, SF).collect()}
    fps = {}
    for i, t in texts.items():
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        shingles = [" ".join(words[k : k + 3]) for k in range(len(words) - 2)] or ([" ".join(words)] if words else [])
        hs = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
        fps[i] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))
        assert got[i].fingerprint == f"{fps[i]:016x}"
    root = {i: i for i in fps}
    for i in fps:
        for j in fps:
            if i < j and (fps[i] ^ fps[j]).bit_count() <= 3:
                a, b = root[i], root[j]
                root = {k: min(a, b) if v in (a, b) else v for k, v in root.items()}
    assert {i: r.component_id for i, r in got.items()} == root


def test_simhash_links_of_dense_fingerprints(spark):
    r = random.Random(6)
    base = [r.getrandbits(64) for _ in range(5)]
    fps = {b ^ sum(1 << k for k in r.sample(range(64), r.randint(0, 5))) for b in base for _ in range(40)}
    signed = {f - (1 << 64) if f >> 63 else f for f in fps}
    got = {(x.src, x.dst) for x in simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long")).collect()}
    assert got == {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 3}


BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def base_spans(text):
    out = []
    for k, pattern in enumerate(BASE.values()):
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            luhn = sum(x if i % 2 == 0 else 2 * x - 9 * (x > 4) for i, x in enumerate(map(int, reversed(d)))) % 10 == 0
            if [True, all(int(x) <= 255 for x in m[0].split(".")) if k == 1 else True, 12 <= len(d) <= 19 and luhn, 9 <= len(d) <= 15][k]:
                out.append((m.start(), k, m.end()))
    return sorted(out)


def test_pii_base_spans(spark):
    r = random.Random(8)
    bits = ["a@b.cd", "@e.f_g@h.i", "x.y@", "1.2.3.4", ".5.6.7.8.9", "300.1.1.1", "0001.2.3.4", "4111 1111-1111 1111", "4111111111111111", "12345678901234567890", "+1 (301) 555-0346", "+4", " ", "é", "()-", "9" * 30, "word", "\n", "_", "+"]
    texts = [(i, "".join(r.choice(bits) for _ in range(r.randint(1, 12)))) for i in range(400)] + [(1000, "1 2 " * 30_000), (1001, "a" * 50_000 + "@"), (1002, "+1" + " " * 30_000)]
    for row in pii.find(spark.createDataFrame(texts, "doc_id long, text string")).collect():
        got = [(s.start, s.k, s.end) for s in row.base_spans]
        assert got == base_spans(row.text), row.text[:200]
        assert set(got) <= {(s.start, s.k, s.end) for s in row.spans}


def test_pii_adds_and_redacts(spark):
    rows = [(i, f"w {x} w") for i, x in enumerate(["+1 (301) 555-0346", "4111111111111111", "4111111111111112", "1.2.3.4", "1.2.3.400", "jo@ex.com", "+1 23"] * 40)]
    rows += [(900, "ask 4111111111111111 5500005555555559 or jane [at] mail [dot] com"), (901, "+1 (301) 555-0346 190.1.2.3")]
    got = {r.doc_id: r for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[900].redacted == "ask [CARD] [CARD] or [EMAIL]" and got[901].redacted == "[PHONE] [IP]"
    assert got[2].redacted == rows[2][1] and got[0].redacted == "w [PHONE] w"


def test_native_plans(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    for made in (linefreq.line_rules(df), pii.find(df)):
        assert not re.search("Python|Pandas|Arrow", made._jdf.queryExecution().toString())
