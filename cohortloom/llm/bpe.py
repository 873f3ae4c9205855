"""BPE encoding and decoding by a tokenization automaton.

The merges are compiled into a deterministic automaton over tokens.  It starts with one state and an arc
for every byte.  The gadget of merge number i, (u, v) -> w, copies the state that u leads to, takes the arc v
out of the copy, lets u lead to the copy, and gives every state that has the path u v an arc w to where v led.
A path through the automaton is the tokenization of the string its labels spell, and every string has one.

A state differs from the one it was copied from by one cut arc, so a state is stored as its origin and that arc, and
whether it has an arc is found by going back over origins (to before the arc) and over first halves (to before the
state).  A word is walked by two tables: bytes lead through the labels to the longest arc, and (state, arc) leads to the
next state; entries of the second are computed when first met.  Decoding emits the arc labels.
"""

from __future__ import annotations

import json
import re
from array import array
from functools import lru_cache
from itertools import pairwise
from sys import byteorder

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from cohortloom.llm.common import add_struct, prepare

# The published pattern of byte-level pre-splitting, and white space as its engine knows it.
PRE_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SPACE = "\\t-\\r\\x20\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: A vocabulary is a bounded object (a few MB); a larger file than this is refused rather than broadcast.
MAX_TOKENS = 2_000_000
#: Entries a worker remembers before it starts anew, some 200 bytes each: (piece -> ids), twice, and (state, token) -> state.
MEMO = 350_000

FIELDS = StructType([StructField("n_tokens", LongType()), StructField("ids_packed", BinaryType()), StructField("decoded", StringType())])


def byte_symbols() -> dict[str, int]:
    """The printable stand-ins of byte-level vocabularies: visible Latin-1 stays, the rest moves to 256 and on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(rest)}


def load(path: str) -> dict:
    """Labels, merges and special strings of a tokenizer file, as plain arrays (the driver reads it once)."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, pre = spec["model"], spec.get("pre_tokenizer") or {}
    if model.get("type") != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or spec.get("normalizer"):
        raise ValueError("a byte-level BPE file without normalizer and prefix space is needed")
    vocab, back = model["vocab"], byte_symbols()
    special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
    size = max([*vocab.values(), *special.values()]) + 1
    if size > MAX_TOKENS:
        raise ValueError(f"{size} tokens; at most {MAX_TOKENS} are broadcast")
    labels = [b""] * size
    for token, i in vocab.items():
        labels[i] = bytes(back[c] for c in token) if token not in special else token.encode()
    for token, i in special.items():
        labels[i] = token.encode()
    pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    merges = np.array([(vocab[a], vocab[b], vocab[a + b]) for a, b in pairs], dtype=np.int32).reshape(-1, 3)
    return {"labels": labels, "merges": merges, "special": special}


class Automaton:
    """The compiled automaton, with the walk that encodes one piece of text."""

    def __init__(self, labels: list[bytes], merges: np.ndarray, special: dict[str, int]):
        self.labels, self.special = labels, special
        n = len(labels)
        self.left, self.born = [-1] * n, [-1] * n
        #: state i + 1 is made by merge i: a copy of origin[i + 1] without the arc gone[i + 1]
        self.origin, self.gone = [0], [-1]
        self.leads_to = [0] * n  # the state that each token's arc ends in
        for i, (u, v, w) in enumerate(merges.tolist()):
            if self.born[w] >= 0:
                raise ValueError("two merges make one token")
            self.left[w], self.born[w] = u, i
            self.leads_to[w] = self.leads_to[v]  # the new arc ends where v led
            self.origin.append(self.leads_to[u])
            self.gone.append(v)
            self.leads_to[u] = i + 1  # u now leads to the copy
        usable = {labels[i]: i for i in range(n) if self.born[i] >= 0 or (len(labels[i]) == 1 and labels[i] not in special)}
        self.ids = usable
        self.sizes = [len(x) for x in labels]
        #: transitions over bytes, (node, byte) -> node, and the token whose label leads to a node
        self.go: dict[int, int] = {}
        self.accept = [-1]
        for label, i in usable.items():
            node = 0
            for b in label:
                node = self.go.setdefault(node << 8 | b, len(self.accept))
                if node == len(self.accept):
                    self.accept.append(-1)
            self.accept[node] = i
        self.shorter = [-1] * n  # the longest token that is a proper prefix
        for label, i in usable.items():
            for k in range(len(label) - 1, 0, -1):
                if (j := usable.get(label[:k])) is not None:
                    self.shorter[i] = j
                    break
        #: transitions over tokens, (state, token) -> state or -1, filled as they are met
        self.table: dict[int, int] = {}
        self.whole: dict[int, bool] = {}
        self.pieces: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self._pre = regex.compile(PRE_SPLIT.replace(r"\S", f"[^{SPACE}]").replace(r"[^\s", f"[^{SPACE}").replace(r"\s", f"[{SPACE}]"))
        # No match of the pattern runs over the start of a word with its space, so this cut is safe to make first.
        self._chunk = re.compile(f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
        self._special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None

    def walk(self, piece: bytes) -> list[int]:
        """The one path that spells the piece: the longest arc that the state has first, back off where none goes on."""
        whole = self.ids.get(piece)
        if whole is not None and self.arc_is_whole(whole):
            return [whole]
        go, accept, table, shorter, sizes, n = self.go, self.accept, self.table, self.shorter, self.sizes, len(self.labels)
        path: list[int] = []
        states = [0]
        end, pos, take = len(piece), 0, -2
        dead = bytearray(end + 1)  # positions from which the end can't be reached
        while pos < end:
            if take == -2:
                take, node = -1, 0
                for k in range(pos, end):
                    node = go.get(node << 8 | piece[k])
                    if node is None:
                        break
                    if accept[node] >= 0:
                        take = accept[node]
            at = states[-1] * n
            while take >= 0:
                if not dead[pos + sizes[take]]:
                    to = table.get(at + take)
                    if to is None:
                        to = self.step(states[-1], take)
                    if to >= 0:
                        break
                take = shorter[take]
            if take >= 0:
                path.append(take)
                states.append(to)
                pos += sizes[take]
                take = -2
            else:
                dead[pos] = 1
                take = path.pop()  # never empty: every byte has an arc
                states.pop()
                pos -= sizes[take]
                take = shorter[take]
        return path

    def arc_is_whole(self, token: int) -> bool:
        """Does the token's own label lead along this one arc? (So for every token made by merges in order.)"""
        got = self.whole.get(token)
        if got is None:
            i = self.born[token]
            got = i < 0
            if not got:
                u, v = self.left[token], self.gone[i + 1]
                # Merge i took v out of the state it copied, so the path u v was there till then.
                got = self.arc_is_whole(u) and self.arc_is_whole(v) and self.has(self.origin[i + 1], v)
            self.whole[token] = got
        return got

    def step(self, state: int, token: int) -> int:
        """The state that a state's arc leads to, -1 if the arc was cut; remembered in the table."""
        if len(self.table) >= MEMO:
            self.table.clear()
        to = self.table[state * len(self.labels) + token] = self.leads_to[token] if self.has(state, token) else -1
        return to

    def has(self, state: int, y: int) -> bool:
        """Has a state the arc y?

        An arc older than the state is there if the copied state had it and the copy kept it; a younger one, made by a
        merge of two arcs, is there if its first half is.
        """
        origin, gone, born, left = self.origin, self.gone, self.born, self.left
        while state:
            if born[y] < state - 1:
                if gone[state] == y:
                    return False
                state = origin[state]
            else:
                y = left[y]
        return True

    def packed(self, chunk: str) -> bytes:
        """Ids of one run of text up to a space; recent runs are remembered in two generations."""
        got = self.older.get(chunk)
        if got is None:
            # Letters with at most a space before them are one word, and so need no pattern.
            words = (chunk,) if (chunk[1:] if chunk[0] == " " else chunk).isalpha() else self._pre.findall(chunk)
            out = []
            for word in words:
                out += self.walk(word.encode("utf-8", "surrogatepass"))
            ids = array("I", out)
            if byteorder == "big":
                ids.byteswap()
            got = ids.tobytes()
        if len(chunk) <= 64:
            if len(self.pieces) >= MEMO:
                self.older = dict(self.pieces)
                self.pieces.clear()
            self.pieces[chunk] = got
        return got

    def encode(self, text: str) -> bytes:
        """Ids as little-endian 32-bit numbers; strings of special tokens count as these tokens."""
        parts = []
        at = 0
        for m in self._special.finditer(text) if self._special and any(s in text for s in self.special) else ():
            parts += map(self.packed, self._chunk.findall(text[at : m.start()]))
            parts.append(np.array([self.special[m.group()]], dtype="<u4").tobytes())
            at = m.end()
        get, packed = self.pieces.get, self.packed
        parts += [get(c) or packed(c) for c in self._chunk.findall(text[at:] if at else text)]
        return b"".join(parts)

    def decode(self, packed: bytes) -> str:
        ids = np.frombuffer(packed, dtype="<u4").tolist()
        return b"".join(map(self.labels.__getitem__, ids)).decode("utf-8", "replace")

    def accepts(self, ids: list[int]) -> bool:
        return all(self.has(self.leads_to[a], b) for a, b in pairwise(ids))


@lru_cache(maxsize=1)
def _compiled(broadcast_id: int, handle) -> Automaton:  # one per worker process, kept between tasks until another tokenizer or session takes its place
    v = handle.value
    return Automaton(v["labels"], v["merges"], v["special"])


class _Handle:
    """Hashable holder of a broadcast, so that workers compile once per broadcast."""

    def __init__(self, broadcast, key: int):
        self.broadcast, self.key = broadcast, key

    @property
    def value(self):
        return self.broadcast.value

    def __hash__(self):
        return self.key

    def __eq__(self, other):
        return isinstance(other, _Handle) and other.key == self.key


_count = iter(range(1, 1 << 30))


def codec(spark: SparkSession, tokenizer: str) -> Column:
    """The function text -> struct(n_tokens, ids_packed, decoded) for a tokenizer file."""
    handle = _Handle(prepare(spark).sparkContext.broadcast(load(tokenizer)), next(_count))

    @F.pandas_udf(FIELDS)
    def run(texts: pd.Series) -> pd.DataFrame:
        auto = _compiled(handle.key, handle)
        packed = [auto.encode(t) if t else b"" for t in texts]
        return pd.DataFrame({"n_tokens": [len(p) // 4 for p in packed], "ids_packed": packed, "decoded": [auto.decode(p) for p in packed]})

    return run


def encode_decode(df: DataFrame, tokenizer: str, text: str = "text") -> DataFrame:
    """Every row with n_tokens, ids_packed (little-endian unsigned 32-bit ids) and decoded.

    A NULL text counts as empty: no tokens, empty ids, empty decoded text.  Repeated rows are encoded alike and
    all stay.  An empty table gives an empty result with the same columns.  Input columns named like the three
    results give way to them.  Texts and pieces of any length are walked whole; the walk is linear in the piece.
    """
    return add_struct(df, codec(df.sparkSession, tokenizer)(F.col(f"`{text}`")), FIELDS.names)
