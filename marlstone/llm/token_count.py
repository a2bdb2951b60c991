"""Token counts by rank-synchronous array merging.

A text is normalised and split into pre-tokens as the vocabulary file says. Pre-tokens not seen before are held as one
ragged numpy array (symbols end to end, with the owner of each); every round finds each sequence's lowest-rank pair and
merges all its occurrences in all sequences at once, until no sequence has a pair to merge. The surviving symbols are the
count. A worker keeps counts of pre-tokens it has met, up to ``CACHE`` of them. Documents stay in their partitions.

Defined results: null and empty texts have no tokens; special tokens' strings inside a text count one token each, as the
tokenizer's defaults have it; equal rows get equal counts; a text of any length is counted whole, in its own row; an empty
table gives an empty result; input columns with the names of the added ones are replaced, all others pass through.
"""

from __future__ import annotations

import json
import unicodedata

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from ._shared import annotate, slices, text_buffers

CACHE = 300_000
NONE = np.int64(1 << 40)


def load_vocabulary(path: str) -> dict:
    """What counting needs of a tokenizers file with word ends: symbols of bytes, merges as arrays, pattern, specials."""
    with open(path, encoding="utf-8") as f:
        j = json.load(f)
    model, vocab = j["model"], j["model"]["vocab"]
    suffix = model.get("end_of_word_suffix") or ""
    pieces = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    # The usual printable stand-ins of bytes: printable Latin-1 is itself, the others count up from 256 in order.
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    stand_in = {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(x for x in range(256) if x not in set(printable))}
    a = np.array([vocab[x] for x, _ in pieces], np.int64)
    b = np.array([vocab[y] for _, y in pieces], np.int64)
    made = np.array([vocab[x + y] for x, y in pieces], np.int64)
    size = max(vocab.values()) + 1
    key = a * size + b
    order = np.argsort(key, kind="stable")
    steps = j["pre_tokenizer"]["pretokenizers"]
    return {
        "inner": np.array([vocab[stand_in[i]] for i in range(256)], np.int64),
        "last": np.array([vocab[stand_in[i] + suffix] for i in range(256)], np.int64),
        "size": size, "key": key[order], "rank": order.astype(np.int64), "made": made[order],
        "pattern": next(s["pattern"]["Regex"] for s in steps if s["type"] == "Split"),
        "special": sorted((t["content"] for t in j["added_tokens"]), key=len, reverse=True),
    }


def merge_counts(tokens: list[bytes], v: dict) -> np.ndarray:
    """Surviving symbols of each pre-token (none of them empty)."""
    length = np.array([len(t) for t in tokens], np.int64)
    out = length.copy()
    data = np.frombuffer(b"".join(tokens), np.uint8)
    ends = np.cumsum(length)
    sym = v["inner"][data]
    sym[ends - 1] = v["last"][data[ends - 1]]
    owner = np.repeat(np.arange(len(tokens)), length)
    while len(sym):
        starts = np.flatnonzero(np.diff(owner, prepend=-1))
        rank = np.full(len(sym), NONE)
        made = np.zeros(len(sym), np.int64)
        if len(sym) > 1:
            pair = np.flatnonzero(owner[1:] == owner[:-1])
            key = sym[pair] * v["size"] + sym[pair + 1]
            at = np.minimum(np.searchsorted(v["key"], key), len(v["key"]) - 1)
            hit = v["key"][at] == key
            rank[pair[hit]] = v["rank"][at[hit]]
            made[pair[hit]] = v["made"][at[hit]]
        least = np.minimum.reduceat(rank, starts)
        size = np.diff(starts, append=len(sym))
        out[owner[starts]] = size
        live = np.repeat(least < NONE, size)
        pick = live & (rank == np.repeat(least, size))
        # A run of picks is one symbol repeated: every other one merges, from the left.
        at = np.flatnonzero(pick)
        run = np.flatnonzero(np.diff(at, prepend=-2) != 1)
        odd = (at - np.repeat(at[run], np.diff(run, append=len(at)))) % 2 == 1
        at = at[~odd]
        sym[at] = made[at]
        live[at + 1] = False
        sym, owner = sym[live], owner[live]
    return out


class Counter:
    """Counts tokens of texts under one vocabulary, with a bounded memory of pre-tokens."""

    def __init__(self, v: dict):
        self.v, self.known = v, {}
        self.find = regex.compile(v["pattern"]).findall
        self.space = regex.compile(r"\s+")
        self.special = regex.compile("|".join(map(regex.escape, v["special"]))) if v["special"] else None

    def pre_tokens(self, text: str) -> list[str]:
        if not text.isascii():
            # Lower case knows no context here, and two capitals are younger than Python's tables.
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ").replace("\ua7cb", "\u0264").replace("\ua7dc", "\u019b")
        return self.find(self.space.sub(" ", text).lower())

    def count(self, texts: list[str]) -> list[int]:
        if len(self.known) > CACHE:
            self.known.clear()
        split, extra = [], []
        for text in texts:
            found, n = [], 0
            if self.special is not None and "<|" in text:
                n = len(self.special.findall(text))
                for part in self.special.split(text):
                    found += self.pre_tokens(part)
            else:
                found = self.pre_tokens(text)
            split.append(found)
            extra.append(n)
        known = self.known
        new = list(set().union(*split) - known.keys()) if split else []
        if new:
            known.update(zip(new, merge_counts([t.encode("utf-8", "surrogatepass") for t in new], self.v).tolist(), strict=True))
        return [n + sum(map(known.__getitem__, found)) for n, found in zip(extra, split, strict=True)]


_counters: dict = {}


def count_tokens(docs: DataFrame, vocabulary: str, text: str = "text", limit: int = 2048, carry: list[str] | None = None) -> DataFrame:
    """``docs`` (or its ``carry`` columns) with n_bytes (UTF-8), n_tokens and over_limit (more than ``limit`` tokens)."""
    shared = docs.sparkSession.sparkContext.broadcast(load_vocabulary(vocabulary))

    def run(columns: list[pa.Array]) -> list[pa.Array]:
        counter = _counters.get(vocabulary)
        if counter is None:
            counter = _counters[vocabulary] = Counter(shared.value)
        _, off, _ = text_buffers(columns[0])
        tokens: list[int] = []
        for lo, hi in slices(off):
            tokens += counter.count([x or "" for x in columns[0].slice(lo, hi - lo).to_pylist()])
        n = pa.array(tokens, pa.int64())
        return [pa.array(np.diff(off), pa.int64()), n, pa.array(np.array(tokens, np.int64) > limit)]

    return annotate(docs, run, "n_bytes long, n_tokens long, over_limit boolean", [text], carry)
