"""BPE by a tokenization automaton.

The merges are compiled into a deterministic automaton over tokens whose accepted paths are exactly
the sequences that the merges produce. It starts with one state and a loop for each symbol. The gadget
for a merge (u, v) -> w lets every u-arc that reaches a state with a v-arc reach a copy without that
v-arc instead, and adds a w-arc beside each such u-arc, to where v led. All arcs of a token lead to one
state, so the automaton is a state for each token and, for each token, the set of states with its arc.

Encoding walks a word once, through the trie of the arcs' labels with links from each prefix to its suffixes
in the trie: the last token of a prefix is the one whose arc leaves the state reached before it. Decoding
emits the arcs' labels.
"""

from __future__ import annotations

import hashlib
import json
import pickle
import re
import unicodedata
from collections import deque
from dataclasses import dataclass, field
from functools import lru_cache
from string import ascii_lowercase
from struct import pack

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
import tokenizers
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import work
from .caches import claim


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies: bytes that print
    as themselves in Latin-1 stay, the others follow from U+0100 in order."""
    kept = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xFF and b != 0xAD]
    others = iter(range(256, 512))
    return [chr(b) if b in set(kept) else chr(next(others)) for b in range(256)]


@dataclass
class Automaton:
    """ids: label to id. state: of each id. arcs: for each id, a bit set of the states that have its arc.
    before: a `tokenizers` file of the normalizer and the splitter alone, or none."""

    labels: list[str]
    ids: dict[str, int]
    state: list[int]
    arcs: list[bytes]
    states: int
    suffix: str
    pattern: str
    specials: dict[str, int]
    symbols: list[str] = field(default_factory=byte_symbols)
    before: str = ""
    cache_words: int = 100_000

    def __getstate__(self) -> dict:
        rows = {row: i for i, row in enumerate(dict.fromkeys(self.arcs))}
        short = (zstandard.compress(b"".join(rows), 3), np.array([rows[row] for row in self.arcs], np.int32))
        return {k: v for k, v in self.__dict__.items() if k[0] != "_"} | {"arcs": short}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        flat, width = zstandard.decompress(state["arcs"][0]), (self.states + 7) // 8
        rows = [flat[i : i + width] for i in range(0, len(flat), width)]
        self.arcs = [rows[i] for i in state["arcs"][1].tolist()]  # tokens with the same arcs share them
        self.prepare()

    def prepare(self) -> Automaton:
        """Tables that follow from the automaton: the labels as a trie, with the transitions that lead from a
        prefix of a word to the next one's longest suffix in the trie (`_next`, filled in as words need
        them, from `_fail`), and the tokens that end there, longest first: a node's own in `_inside` or, at a
        word's end, `_last`, then those of the nodes that the links lead to."""
        self._split = regex.compile(self.pattern)
        self._letters = self._split.findall(ascii_lowercase) == [ascii_lowercase]
        self._known = Pieces(self)
        self._special = regex.compile("(" + "|".join(map(regex.escape, self.specials)) + ")") if self.specials else None
        self._next, self._inside, self._last, self._depth = [{}], [-1], [-1], [0]
        for label, i in self.ids.items():
            ends = bool(self.suffix) and label.endswith(self.suffix)
            node = 0
            for c in label[: -len(self.suffix)] if ends else label:
                to = self._next[node].get(c)
                if to is None:
                    to = self._next[node][c] = len(self._next)
                    self._next.append({})
                    self._inside.append(-1)
                    self._last.append(-1)
                    self._depth.append(self._depth[node] + 1)
                node = to
            if ends or not self.suffix:
                self._last[node] = i
            if not ends:
                self._inside[node] = i
        # a state as a place and a bit in the sets of arcs
        self._byte, self._bit = [x >> 3 for x in self.state], [1 << (x & 7) for x in self.state]
        self._length = [len(x.removesuffix(self.suffix)) if self.suffix else len(x) for x in self.labels]
        n = len(self._next)
        self._fail, self._inside_link, self._last_link, self._filled = [0] * n, [0] * n, [0] * n, 0
        waiting = deque([0])
        while waiting:
            node = waiting.popleft()
            for c, to in self._next[node].items():
                if node:
                    at = self._fail[node]
                    while at and c not in self._next[at]:
                        at = self._fail[at]
                    at = self._fail[to] = self._next[at].get(c, 0)
                    self._inside_link[to] = at if self._inside[at] >= 0 else self._inside_link[at]
                    self._last_link[to] = at if self._last[at] >= 0 else self._last_link[at]
                waiting.append(to)
        return self

    def _follow(self, node: int, c: str) -> int:
        """Where a symbol leads that a node's label can't be followed by: kept for the next time, up to a bound."""
        at = node
        while at and c not in self._next[at]:
            at = self._fail[at]
        to = self._next[at].get(c, 0)
        if self._filled < self.cache_words * 4:
            self._filled += 1
            self._next[node][c] = to
        return to

    def encode_word(self, word: str) -> list[int]:
        """Ids of one pre-split word, given in byte symbols: one pass from left to right.

        After each symbol, the one token whose arc leaves the state that was reached before it is the last
        of the prefix; candidates are those that end here.
        """
        n, arcs, step, depth, at_byte, at_bit = len(word), self.arcs, self._next, self._depth, self._byte, self._bit
        token, link = self._inside, self._inside_link
        places, bits, chosen, node, i = [0] * (n + 1), [0] * (n + 1), [-1] * (n + 1), 0, 0
        bits[0] = 1
        for c in word:
            i += 1
            to = step[node].get(c)
            node = self._follow(node, c) if to is None else to
            if i == n:
                token, link = self._last, self._last_link
            at = node if token[node] >= 0 else link[node]
            while at:
                t, j = token[at], i - depth[at]
                if arcs[t][places[j]] & bits[j]:
                    places[i], bits[i], chosen[i] = at_byte[t], at_bit[t], t
                    break
                at = link[at]
        if n and chosen[n] < 0:
            raise ValueError(f"no path for {word!r}")
        out, i = [], n
        while i:
            t = chosen[i]
            out.append(t)
            i -= self._length[t]
        out.reverse()
        return out

    def _piece(self, piece: str) -> list[int]:
        """Ids of a text without special tokens: composed, lower case by single characters, split."""
        out: list[int] = []
        if piece.isascii() and piece.isprintable():  # such bytes stand for themselves
            if self._letters and piece.isalpha():
                return self.encode_word(piece.lower())
            for word in self._split.findall(piece.lower()):
                out += self.encode_word(word)
            return out
        if self.before and not piece.isprintable() and unassigned().search(piece):
            rules = _rules(self.before)
            for word, _ in rules.pre_tokenizer.pre_tokenize_str(rules.normalizer.normalize_str(piece)):
                out += self.encode_word(word)
            return out
        text = unicodedata.normalize("NFC", piece)
        # only a capital sigma's lower case depends on what is around it
        text = "".join([c.lower() for c in text]) if "\u03a3" in text else text.lower()
        for word in self._split.findall(text):
            out += self.encode_word("".join([self.symbols[b] for b in word.encode("utf-8", "replace")]))
        return out

    def chunk(self, chunk: str) -> bytes:
        """Ids of a text without white space, as little-endian unsigned 32-bit integers."""
        out: list[int] = []
        if self._special and "<" in chunk:
            for part in self._special.split(chunk):
                if part in self.specials:
                    out.append(self.specials[part])
                elif part:
                    out += self._piece(part)
        else:
            out = self._piece(chunk)
        return pack(f"<{len(out)}I", *out)

    def encode(self, text: str | None) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers; nothing for a null.

        No word of the split spans white space, so ids of the pieces between it are kept for reuse.
        """
        text = text or ""
        return b"".join(map(self._known.__getitem__, _SPACE.split(text) if _ODD_SPACE.search(text) else text.split()))

    def decode(self, ids: bytes) -> str:
        """The labels of the path, with a space between them, as vocabularies without a decoder do."""
        return " ".join(map(self.labels.__getitem__, np.frombuffer(ids, "<u4").tolist()))


class Pieces(dict):
    """Ids of pieces of up to 64 characters: the last `cache_words` of them, and those seen again of as many before."""

    def __init__(self, automaton: Automaton) -> None:
        super().__init__()
        self.automaton = automaton
        self.older: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            ids = self.automaton.chunk(piece)
        if len(piece) <= 64:
            if len(self) >= self.automaton.cache_words:
                self.older = dict(self)
                self.clear()
            self[piece] = ids
        return ids


@lru_cache(maxsize=1)
def unassigned() -> re.Pattern[str]:
    """Code points that Python's Unicode tables do not assign. Those of the tokenizers library may: which of
    them are letters, and how they compose and fold, is asked there."""
    ranges, start = [], None
    for c in range(0x110001):
        odd = c < 0x110000 and unicodedata.category(chr(c)) == "Cn"
        if odd and start is None:
            start = c
        elif not odd and start is not None:
            ranges.append(f"\\U{start:08x}-\\U{c - 1:08x}")
            start = None
    return re.compile(f"[{''.join(ranges)}]")


@lru_cache(maxsize=2)
def _rules(before: str) -> tokenizers.Tokenizer:
    return tokenizers.Tokenizer.from_str(before)


#: str.split() also splits at these, which are not white space in Unicode.
_ODD_SPACE = re.compile(r"[\x1c-\x1f]")
_SPACE = regex.compile(r"[\x09-\x0d\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")


def compile_merges(vocab: dict[str, int], merges: list[tuple[str, str]], suffix: str, pattern: str, specials: dict[str, int], before: str = "") -> Automaton:
    """Builds the automaton, merge by merge, in rank order. A merge without a path left has no effect."""
    size = max([*vocab.values(), *specials.values()]) + 1
    made = {u + v for u, v in merges}
    base = [i for s, i in vocab.items() if s not in made]
    # a bit per state and token; states, of which the gadget copies one, are whole rows of eight
    arcs = np.zeros((32, size), np.uint8)
    arcs[0, base] = 1
    state, users, states = np.zeros(size, np.int64), {0: len(base) + 1}, 1
    names, known = {i: s for s, i in vocab.items()}, set(base)
    for a, b in merges:
        u, v, w = vocab[a], vocab[b], vocab[a + b]
        s = int(state[u])
        if not arcs[s >> 3, v] >> (s & 7) & 1:
            continue
        target = int(state[v])
        if users[s] == 1 and u != v:
            q = s
        else:
            q, states = states, states + 1
            if states > len(arcs) * 8:
                arcs = np.concatenate([arcs, np.zeros_like(arcs)])
            arcs[q >> 3] |= ((arcs[s >> 3] >> (s & 7)) & 1) << (q & 7)
            users[s] -= 1
            users[q] = 1
            state[u] = q
        arcs[q >> 3, v] &= ~np.uint8(1 << (q & 7))
        if w not in known:
            known.add(w)
            state[w] = target
            users[target] += 1
        width = (states + 7) // 8
        arcs[:width, w] |= arcs[:width, u]
    by_token = np.ascontiguousarray(arcs[: (states + 7) // 8].T)
    shared: dict[bytes, bytes] = {}
    rows = [shared.setdefault(r, r) for r in (by_token[i].tobytes() for i in range(size))]
    labels = [names.get(i, "") for i in range(size)]
    for text, i in specials.items():
        labels[i] = text
    return Automaton(labels, dict(vocab), state.tolist(), rows, states, suffix, pattern, dict(specials), before=before).prepare()


@lru_cache(maxsize=2)
def packed(path: str) -> bytes:
    """A compiled automaton in short form: what the driver keeps and sends to workers."""
    return pickle.dumps(load(path))


@lru_cache(maxsize=1)
def _unpacked(data: bytes) -> Automaton:
    return pickle.loads(data)


def unpacked(data: bytes) -> Automaton:
    """Once per worker process, as long as no other operator takes it over."""
    claim("bpe", _unpacked.cache_clear)
    return _unpacked(data)


def load(path: str) -> Automaton:
    """Compiles a `tokenizers` JSON file of the kind: NFC, white space, lower case; split; byte level; word ends."""
    with open(path, encoding="utf-8") as f:
        given = json.load(f)
    model = given["model"]
    merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
    split = given["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
    specials = {t["content"]: t["id"] for t in given["added_tokens"]}
    # normalizer and splitter alone, for code points that only the library knows
    before = json.dumps({k: given[k] for k in ("version", "normalizer", "pre_tokenizer")} | {"added_tokens": [], "model": {"type": "BPE", "vocab": {}, "merges": []}})
    return compile_merges(model["vocab"], merges, model["end_of_word_suffix"] or "", split, specials, before)


def encode(df: DataFrame, path: str, text: str = "text", out: str = "ids") -> DataFrame:
    """Adds the ids of each whole text as an array; a null or empty text has none. No shuffle."""
    shared = df.sparkSession.sparkContext.broadcast(packed(path))

    @F.pandas_udf("array<int>")
    def ids(texts: pd.Series) -> pd.Series:
        a = unpacked(shared.value)
        return texts.map(lambda t: np.frombuffer(a.encode(t), "<u4").astype(np.int32), na_action=None)

    return df.withColumn(out, ids(F.col(text)))


def decode(df: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Adds the decoded text of an array of ids; null where it is null. No shuffle."""
    shared = df.sparkSession.sparkContext.broadcast(packed(path))

    @F.pandas_udf("string")
    def texts(given: pd.Series) -> pd.Series:
        a = unpacked(shared.value)
        return given.map(lambda x: None if x is None else a.decode(np.asarray(x, "<u4").tobytes()), na_action=None)

    return df.withColumn(out, texts(F.col(ids)))


def digests(df: DataFrame, path: str, text: str = "text") -> DataFrame:
    """Adds n_tokens, ids_sha256 and decoded_sha256: encoded and decoded again where the text is, so
    ids and decoded texts, several times the input, never leave the worker. Columns of these names are replaced."""
    shared = df.sparkSession.sparkContext.broadcast(packed(path))

    @F.arrow_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def both(texts: pa.Array) -> pa.Array:
        a, n, ids_sha, decoded_sha = unpacked(shared.value), [], [], []
        for t in texts:  # one text at a time: a batch is not held twice
            ids = a.encode(t.as_py())
            n.append(len(ids) // 4)
            ids_sha.append(hashlib.sha256(ids).hexdigest())
            decoded_sha.append(hashlib.sha256(a.decode(ids).encode()).hexdigest())
        return pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(decoded_sha, pa.string())], ["n_tokens", "ids_sha256", "decoded_sha256"])

    got = df.withColumn("bpe__made", both(F.col(text)))
    return got.withColumns({c: F.col(f"bpe__made.{c}") for c in ("n_tokens", "ids_sha256", "decoded_sha256")}).drop("bpe__made")
