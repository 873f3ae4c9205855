"""HTML extraction by wrappers: union-free regular expressions inferred from the pages of a host.

A page's token stream, read as a tree, is itself such an expression: a sequence of tags and text slots.  Aligning it with
the expression so far resolves every mismatch: successive elements of one signature are one repeated group, elements that
one side lacks are optional, and texts that differ make their slot variable.  The expression is a tree of nodes
[signature, occurrences, repeated, text hash or variable, characters, children]; aligning two gives one of the same kind,
so pages are folded in per task, then per host and share of tasks, then per host, and a host with a third of all pages is
no more than a few expressions in the last step.

The wrapper tells where the main text is: in its ``article`` or ``main`` node, else in the deepest node that holds most of
the text that varies from page to page.  Outside such a node, texts that are the same on all pages are template.
"""

from __future__ import annotations

import html as entities
import json
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.common import add_struct, fresh, prepare, store

# Element names of the HTML standard by how they behave.
RAW = ("script", "style", "noscript", "template", "textarea", "title", "iframe", "svg", "math", "xmp", "noframes")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section table ul".split())
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "optgroup": {"option", "optgroup"}}
SCOPES = frozenset("ul ol dl table article main section div body html td th".split())
ASIDE = frozenset("nav footer aside form select button dialog menu head object canvas audio video datalist input".split())
ASIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner menu nav navbar navigation sidebar footer header masthead topbar toolbar breadcrumb breadcrumbs cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe subscription signup login share sharing social related recommended comment comments respond reply replies disqus discussion widget pagination pager search".split()
)

_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>{'|'.join(RAW)})\b(?:[^>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*+>.*?(?:</(?P=raw)\s*[^>]*>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*+)>|(?P<text>[^<]+|<)",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"""(?<![\w-])(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_WORDS = re.compile(r"[a-z0-9]+")
#: Nodes an expression may have; beyond it, those seen on the fewest pages, up to 16, are left out (their texts then count
#: as unknown, not as template).  Depth beyond which an expression takes elements as their parents; extraction has no limit.
MAX_NODES, MAX_DEPTH = 4_000, 60


def signature(tag: str, attrs: str) -> str:
    if not attrs or "=" not in attrs:
        return tag
    words = []
    for name, value in _ATTRIBUTE.findall(attrs):
        words += [w for w in _WORDS.findall(value.lower()) if not w.isdigit()] if name.lower() != "id" or not re.search(r"\d", value) else []
    return f"{tag}.{'.'.join(dict.fromkeys(words))}" if words else tag


def is_aside(sig: str) -> bool:
    tag, *words = sig.split(".")
    return tag in ASIDE or (tag not in ("html", "body", "article", "main") and not ASIDE_WORDS.isdisjoint(words))


def events(page: str) -> Iterator[tuple[str, str]]:
    """("open", signature), ("close", signature) and ("text", raw text) of a well-nested reading of the page."""
    stack: list[str] = []
    names: list[str] = []
    held: Counter[str] = Counter()  # open elements by name

    def close_to(n: int) -> Iterator[tuple[str, str]]:
        while len(stack) > n:
            held[names.pop()] -= 1
            yield "close", stack.pop()

    def close_last(tag: str) -> Iterator[tuple[str, str]]:
        n = len(names) - 1
        while names[n] != tag:
            n -= 1
        yield from close_to(n)

    for m in _TOKEN.finditer(page):
        if (text := m["text"]) is not None:
            yield "text", text
            continue
        if m["tag"] is None:
            continue
        tag = m["tag"].lower()
        if m["end"]:
            if held[tag]:
                yield from close_last(tag)
            continue
        if tag in CLOSES_P and held["p"]:
            yield from close_last("p")
        elif tag in SIBLINGS and any(held[t] for t in SIBLINGS[tag]):
            for i in range(len(names) - 1, -1, -1):
                if names[i] in SIBLINGS[tag]:
                    yield from close_to(i)
                    break
                if names[i] in SCOPES and not (tag in ("tr", "td", "th") and names[i] in ("td", "th")):
                    break
        sig = signature(tag, m["attrs"])
        yield "open", sig
        if tag in VOID or m["attrs"].endswith("/") and tag not in INLINE | CLOSES_P:
            yield "close", sig
        else:
            stack.append(sig)
            names.append(tag)
            held[tag] += 1
    yield from close_to(0)


def _node(sig: str) -> list:
    return [sig, 1, 0, None, 0, []]


VARIES = -1


def expression(page: str) -> list:
    """The page as an expression; inline tags are left out, and a text is held by the element around it.

    Texts below MAX_DEPTH are held by the element at that depth, but for those in asides.
    """
    root = _node("")
    path = [root]
    deeper: list[bool] = []  # open elements below MAX_DEPTH: whether they are asides or in one
    for kind, value in events(page):
        tag = value.split(".", 1)[0] if kind != "text" else ""
        if kind == "text":
            said = " ".join(value.split())
            if said and not (deeper and deeper[-1]):
                node = path[-1]
                h = zlib.crc32(said.encode("utf-8", "replace"))
                node[3] = h if node[3] is None else zlib.crc32(h.to_bytes(4, "big"), node[3]) if node[3] >= 0 else VARIES
                node[4] += len(said)
        elif tag in INLINE or tag in VOID:
            continue
        elif kind == "open":
            if len(path) > MAX_DEPTH:
                deeper.append(bool(deeper and deeper[-1]) or is_aside(value))
                continue
            node = _node(value)
            path[-1][5].append(node)
            path.append(node)
        elif deeper:
            deeper.pop()
        else:
            done = path.pop()
            done[5] = _fold(done[5])
    root[5] = _fold(root[5])
    return root


def _fold(children: list) -> list:
    """Successive elements of one signature as one repeated group."""
    out: list = []
    for c in children:
        if out and out[-1][0] == c[0]:
            out[-1] = align(out[-1], c)
            out[-1][1], out[-1][2] = 1, 1
        else:
            out.append(c)
    return out


def align(a: list, b: list) -> list:
    """One expression for what either of two matches."""
    if not b[1]:
        return a
    text = a[3] if a[3] == b[3] else VARIES
    return [a[0], a[1] + b[1], a[2] | b[2], text, a[4] + b[4], _sequence(a[5], b[5])]


def _sequence(a: list, b: list) -> list:
    """Elements of the same signature side by side, in order; the rest of either side is optional there."""
    out, i = [], 0
    for y in b:
        j = next((k for k in range(i, len(a)) if a[k][0] == y[0]), None)
        if j is None:
            at = next((k for k in range(len(out)) if out[k][0] == y[0]), None)  # met in another order: the same group again
            if at is None:
                out.append(y)
            else:
                out[at] = align(out[at], y)
        else:
            out += a[i:j]
            out.append(align(a[j], y))
            i = j + 1
    return out + a[i:]


def size(node: list) -> int:
    return 1 + sum(map(size, node[5]))


def trim(node: list, pages: int) -> list:
    if size(node) > MAX_NODES:
        for limit in (1, 2, 4, 8, 16):
            if pages > limit:
                _drop(node, limit)
            if size(node) <= MAX_NODES:
                break
    return node


def _drop(node: list, limit: int) -> None:
    node[5] = [c for c in node[5] if c[1] > limit]
    for c in node[5]:
        _drop(c, limit)


def rule(wrapper: list) -> dict:
    """What extraction needs of a wrapper: the path of the main node, and the template texts' paths with their hashes."""
    def varying(node: list) -> int:
        return 0 if is_aside(node[0]) else (node[4] if node[3] == VARIES else 0) + sum(map(varying, node[5]))

    def named(node: list, path: tuple) -> tuple | None:
        if node[0].split(".")[0] in ("article", "main") and not is_aside(node[0]):
            return path
        found = [p for c in node[5] if not is_aside(c[0]) and (p := named(c, (*path, c[0])))]
        return max(found, key=len) if len(found) == 1 else (path if found else None)

    main = named(wrapper, ())
    if main:
        return {"main": list(main), "by": "name", "template": []}
    path, node, total = (), wrapper, varying(wrapper)
    while total and (best := max(node[5], key=varying, default=None)) and varying(best) >= 0.6 * total and best[0].split(".")[0] not in ("p", "ul", "ol", "table"):
        path, node = (*path, best[0]), best
    template: list = []

    def walk(node: list, at: tuple) -> None:
        # The same text on three pages or more that differ elsewhere; a repeated group has no single text.
        if node[3] is not None and node[3] != VARIES and node[1] >= 3 and not node[2]:
            template.append(["/".join(at), node[3]])
        for c in node[5]:
            walk(c, (*at, c[0]))

    if total and path:
        walk(node, path)
    return {"main": list(path) if total else [], "by": "text", "template": template if total else []}


def main_text(page: str | None, rules: dict | None) -> str:
    """The main text of one page under its host's rule; without a match for the main node, of the whole page."""
    if not page:
        return ""
    rules = rules or {"main": [], "by": "text", "template": []}
    for path in (rules["main"], []) if rules["main"] else ([],):
        said = _collect(page, path, {(p, h) for p, h in rules["template"]})
        if said:
            return said
    return ""


def _collect(page: str, main: list[str], template: set) -> str:
    blocks: list[str] = []
    part: list[str] = []  # raw text of the block so far
    path: list[str] = []
    aside = 0

    def flush() -> None:
        said = " ".join(entities.unescape("".join(part)).split())
        if said and not (template and ("/".join(path[:MAX_DEPTH]), zlib.crc32(said.encode("utf-8", "replace"))) in template):
            blocks.append(said)
        part.clear()

    for kind, value in events(page):
        if kind == "text":
            if not aside and path[: len(main)] == main:
                part.append(value)
            continue
        tag = value.split(".", 1)[0]
        if tag in INLINE and not is_aside(value):
            continue
        if tag in VOID:
            if tag in ("br", "hr"):
                part.append(" ")
            continue
        flush()
        if kind == "open":
            if tag not in INLINE:
                path.append(value)
            aside += is_aside(value)
        else:
            if tag not in INLINE:
                path.pop()
            aside -= is_aside(value)
    flush()
    return " ".join(blocks)


def host_of(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/:?#]*)", 1), F.lit("")))


def wrappers(pages: DataFrame, url: str = "url", html: str = "html", hosts_at_once: int = 2_000, fan: int = 32) -> DataFrame:
    """(host, rule): the rule of every host's wrapper, as JSON."""
    rows = pages.select(host_of(F.col(f"`{url}`")).alias("host"), F.col(f"`{html}`").alias("html"))

    def fold(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """One expression per host of a task; a full table of hosts is passed on and begun anew."""
        held: dict[str, list] = {}
        out = lambda: pd.DataFrame({"host": list(held), "w": [json.dumps(w) for w in held.values()], "pages": [w[1] for w in held.values()]})
        for part in parts:
            for host, page in zip(part["host"], part["html"], strict=True):
                w = expression(page or "")
                held[host] = trim(align(held[host], w), held[host][1]) if host in held else trim(w, 1)
            if len(held) >= hosts_at_once:
                yield out()
                held = {}
        if held:
            yield out()

    def merged(key: tuple, part: pd.DataFrame) -> list:
        w = None
        for text in sorted(part["w"]):
            x = json.loads(text)
            w = x if w is None else trim(align(w, x), w[1])
        return w

    def join(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        w = merged(key, part)
        return pd.DataFrame({"host": [key[0]], "w": [json.dumps(w)], "pages": [w[1]]})

    def last(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"host": [key[0]], "rule": [json.dumps(rule(merged(key, part)))]})

    schema = "host string, w string, pages bigint"
    parts = rows.mapInPandas(fold, schema).withColumn("salt", F.pmod(F.xxhash64("w"), F.lit(fan)))
    shares = parts.groupBy("host", "salt").applyInPandas(join, schema)
    return shares.groupBy("host").applyInPandas(last, "host string, rule string")


def extract(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Every row with text (main text, empty if none) and n_chars, its code points.

    A NULL or empty html has no text.  A NULL url and one without a host share the host ``""``.  Repeated rows get equal
    results.  A page that lacks its host's main node is read whole, without asides.  Long pages are read whole.  An empty
    table gives an empty result; input columns named like the two results give way.
    """
    prepare(pages.sparkSession)
    host = fresh(pages.columns, "host")
    rules = store(wrappers(pages, url, html)).select(F.col("host").alias(host), F.col("rule").alias(own := fresh([*pages.columns, host], "rule")))
    joined = pages.withColumn(host, host_of(F.col(f"`{url}`"))).join(rules, host, "left")

    @F.pandas_udf("struct<text:string,n_chars:bigint>")
    def run(htmls: pd.Series, ruled: pd.Series) -> pd.DataFrame:
        known: dict[str, dict] = {}
        texts = [main_text(h, known.setdefault(r, json.loads(r)) if r else None) for h, r in zip(htmls, ruled, strict=True)]
        return pd.DataFrame({"text": texts, "n_chars": [len(t) for t in texts]})

    return add_struct(joined, run(F.col(f"`{html}`"), F.col(own)), ("text", "n_chars")).drop(host, own)
