"""Language identification by prediction by partial matching (PPM).

For each language a context tree over bytes is learned from labelled documents: how often each byte follows each context
of 0 to ``order`` bytes. Coding a byte starts at the longest context; a byte not seen there costs an escape (method C:
distinct / (total + distinct)) and the next shorter context is asked, without the bytes already ruled out (full
exclusion), down to a uniform choice among bytes never seen. With frozen statistics a byte's code length depends only on
the byte and the ``order`` bytes before it, so the lengths of all learned (order + 1)-byte strings are worked out once and
looked up in a hash table; other strings are worked out when met. The language with the shortest code wins.

Languages are independent of each other: any number of them is learned, in groups of ``GROUP`` that share one table, some two
megabytes a language.

Defined results: ``und`` with score 0 for null texts and texts without a letter; ties go to the language that sorts first;
with nothing to learn from (an empty table too), every text is ``und``; an empty table of documents gives an empty result;
the score is the winner's posterior probability under equal priors; equal rows get equal results; a text of any length is
read whole; input columns named lang_pred or score are replaced, all others pass through. Learning reads a bounded sample:
per language the ``sample_docs`` ids with the smallest hashes (fewer where that would be more than ``sample_total`` in all,
one at least), of each the text with the smallest hash; rows with a null id count as one id.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ._shared import SLICE_BYTES, annotate, sized, slices, text_buffers

PAD = 10
#: Languages that share a table of strings.
GROUP = 48


def grams(data: np.ndarray, off: np.ndarray, order: int) -> np.ndarray:
    """Each byte with the ``order`` bytes before it, packed in 64 bits; a document starts after a row of line ends."""
    out = np.zeros(len(data), np.uint64)
    wide = data.astype(np.uint64)
    for j in range(order + 1):
        out[j:] |= wide[: len(wide) - j] << np.uint64(8 * j)
    lengths = np.diff(off)
    for i in range(order):  # the i-th byte of a document has order - i line ends before it
        at = off[:-1][lengths > i] + i
        g = np.zeros(len(at), np.uint64)
        for j in range(order + 1):
            g |= (wide[at - j] if j <= i else np.uint64(PAD)) << np.uint64(8 * j)
        out[at] = g
    return out


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(keys, wanted), max(len(keys) - 1, 0))
    return at, (keys[at] == wanted) if len(keys) else np.zeros(len(wanted), bool)


class Ppm:
    """Frozen per-language context trees; order-``order`` code lengths in bits."""

    def __init__(self, texts: dict[str, list[bytes]], order: int = 3):
        self.langs, self.order = sorted(texts), order
        size = len(self.langs)
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        for docs in (texts[k] for k in self.langs):
            found, count = np.zeros(0, np.uint64), np.zeros(0)
            lo = 0
            while lo < len(docs):  # bounded pieces, then one sum
                hi, room = lo + 1, SLICE_BYTES - len(docs[lo])
                while hi < len(docs) and room > 0:
                    room -= len(docs[hi])
                    hi += 1
                off = np.cumsum([0, *map(len, docs[lo:hi])])
                k, n = np.unique(grams(np.frombuffer(b"".join(docs[lo:hi]), np.uint8), off, order), return_counts=True)
                found, at = np.unique(np.concatenate([found, k]), return_inverse=True)
                count = np.bincount(at, np.concatenate([count, n]), len(found))
                lo = hi
            parts.append((found, count))
        full = np.unique(np.concatenate([k for k, _ in parts]) if parts else np.zeros(0, np.uint64))
        counts = np.zeros((len(full), size))
        for i, (k, n) in enumerate(parts):
            counts[np.searchsorted(full, k), i] = n
        #: By order: strings of order + 1 bytes with counts; contexts with totals, distinct followers, ruled-out counts.
        self.tree = []
        for k in range(order, -1, -1):
            low = full & np.uint64((1 << 8 * (k + 1)) - 1)
            keys, at = np.unique(low, return_inverse=True)
            n = np.stack([np.bincount(at, counts[:, i], len(keys)) for i in range(size)], 1) if size else np.zeros((len(keys), 0))
            ctx, back = np.unique(keys >> np.uint64(8), return_inverse=True)
            fold = lambda x, back=back, m=len(ctx): np.stack([np.bincount(back, x[:, i], m) for i in range(size)], 1) if size else np.zeros((m, 0))
            self.tree.append({"keys": keys, "n": n, "ctx": ctx, "fold": fold, "total": fold(n), "distinct": fold(n > 0)})
        for upper, lower in zip(self.tree, self.tree[1:], strict=False):
            at, _ = _find(lower["keys"], upper["keys"] & np.uint64((1 << 8 * (order - self.tree.index(upper))) - 1))
            upper["ruled"] = upper["fold"](np.where(upper["n"] > 0, lower["n"][at], 0)) if len(lower["keys"]) else upper["total"]
        for level in self.tree:
            level.pop("fold")
            level.setdefault("ruled", np.zeros_like(level["total"]))
        self.keys = full
        self.bits = self.lengths(full).astype(np.float32)
        # Direct-mapped table: the most frequent strings come first to a slot, the others are found by binary search.
        self.shift = np.uint64(64 - max(10, int(np.ceil(np.log2(max(1, len(full)) * 4)))))
        self.slot_key = np.full(1 << (64 - int(self.shift)), np.uint64(0xFFFFFFFFFFFFFFFF))
        self.slot_at = np.zeros(len(self.slot_key), np.int32)
        by = np.argsort(counts.sum(1), kind="stable")  # later writes win
        slot = self._slot(full[by])
        self.slot_key[slot], self.slot_at[slot] = full[by], by
        self.columns = [np.ascontiguousarray(self.bits[:, i]) for i in range(size)]

    def _slot(self, g: np.ndarray) -> np.ndarray:
        return (g * np.uint64(0x9E3779B97F4A7C15)) >> self.shift

    def lengths(self, g: np.ndarray) -> np.ndarray:
        """Code length in bits of the last byte of each packed string, by language."""
        cost = np.zeros((len(g), len(self.langs)))
        done = np.zeros(cost.shape, bool)
        out_n, out_d = np.zeros(cost.shape), np.zeros(cost.shape)
        for k, level in zip(range(self.order, -1, -1), self.tree, strict=True):
            own = g & np.uint64((1 << 8 * (k + 1)) - 1)
            ca, there = _find(level["ctx"], own >> np.uint64(8))
            ka, known = _find(level["keys"], own)
            pick = lambda name, at, ok, level=level: np.where(ok[:, None], level[name][at], 0) if len(level[name]) else np.zeros(cost.shape)
            total, distinct = pick("total", ca, there), pick("distinct", ca, there)
            n = pick("n", ka, known)
            left, kinds = total - out_n, distinct - out_d
            asked = ~done & (left > 0)
            seen = asked & (n > 0)
            with np.errstate(divide="ignore", invalid="ignore"):
                cost += np.where(seen, np.log2((left + kinds) / n), np.where(asked, np.log2((left + kinds) / kinds), 0))
            done |= seen
            out_n, out_d = pick("ruled", ca, there), distinct
        return cost + np.where(done, 0, np.log2(np.maximum(1, 256 - out_d)))

    def score(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Bits each language takes for each document."""
        out = np.zeros((len(off) - 1, len(self.langs)))
        g = grams(data, off, self.order)
        if not len(g):
            return out
        slot = self._slot(g)
        at = self.slot_at[slot]
        missed = np.flatnonzero(self.slot_key[slot] != g)
        if len(missed):
            ka, known = _find(self.keys, g[missed])
            at[missed[known]] = ka[known]
            missed = missed[~known]
        new, back = np.unique(g[missed], return_inverse=True)
        own = self.lengths(new).astype(np.float32)
        some = np.flatnonzero(np.diff(off) > 0)
        for i, column in enumerate(self.columns):
            bits = column[at] if len(column) else np.zeros(len(g), np.float32)
            bits[missed] = own[back, i]
            out[some, i] = np.add.reduceat(bits, off[some], dtype=np.float64)
        return out


class Models:
    """Trees of all languages, in groups."""

    def __init__(self, texts: dict[str, list[bytes]], order: int = 3):
        self.langs = sorted(texts)
        self.groups = [Ppm({k: texts[k] for k in self.langs[i : i + GROUP]}, order) for i in range(0, len(self.langs), GROUP)]

    def score(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Bits each language takes for each document."""
        return np.concatenate([np.zeros((len(off) - 1, 0)), *[g.score(data, off) for g in self.groups]], 1)


def learn(train: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang", order: int = 3, sample_docs: int = 300, sample_total: int = 20_000) -> Models:
    """Context trees from the rows of ``train`` with a text and a language: a bounded sample, whole texts."""
    spark, h = train.sparkSession, F.xxhash64(F.col(id).cast("string"))
    rows = train.filter(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).alias("l"), h.alias("h"), F.col(text).alias("t"))
    todo = {r["l"]: r["count"] for r in rows.groupBy("l").count().collect()}  # a row for each language
    wanted, spread, last = max(1, min(sample_docs, sample_total // max(1, len(todo)))), 4, {}

    def limits(most: dict) -> DataFrame:
        kind = train.schema[lang].dataType.simpleString()
        return sized(spark.createDataFrame(list(most.items()), f"bl {kind}, most long"), len(most))

    while todo:
        # Hashes below a limit that some times the wanted ids should have; a wider one where many rows share an id.
        most = {k: min((1 << 63) - 1, spread * wanted * (1 << 64) // n - (1 << 63)) for k, n in todo.items()}
        ids = rows.select("l", "h").join(limits(most), F.col("l") == F.col("bl")).filter("h <= most").select("l", "h").distinct()
        kth = ids.withColumn("k", F.row_number().over(Window.partitionBy("l").orderBy("h"))).filter(F.col("k") <= wanted)
        found = {r["l"]: r for r in kth.groupBy("l").agg(F.max("h").alias("h"), F.max("k").alias("k")).collect()}
        for k in list(todo):
            if k in found and (found[k]["k"] == wanted or most[k] == (1 << 63) - 1):
                last[k] = found[k]["h"]
                del todo[k]
        spread *= 64
    texts: dict[str, list[bytes]] = {k: [] for k in last}
    if last:
        within = rows.join(limits(last), F.col("l") == F.col("bl")).filter("h <= most")
        one = within.groupBy("l", "h").agg(F.min(F.struct(F.xxhash64("t").alias("th"), F.col("t"))).alias("d"))
        for r in sorted(one.select("l", "h", "d.t").toLocalIterator(), key=lambda r: (r["l"], r["h"])):
            texts[r["l"]].append(r["t"].encode())
    return Models(texts, order)


def identify(docs: DataFrame, model: Models, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """``docs`` (or its ``carry`` columns) with lang_pred and score; whole texts, no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(columns: list[pa.Array]) -> list[pa.Array]:
        model = shared.value
        data, off, _ = text_buffers(columns[0])
        pred, score = [], []
        for lo, hi in slices(off):
            bits = model.score(data[off[lo] : off[hi]], off[lo : hi + 1] - off[lo])
            texts = columns[0].slice(lo, hi - lo)
            for b, t in zip(bits, texts, strict=True):
                t = t.as_py()
                if not model.langs or t is None or not any(c.isalpha() for c in t):
                    pred.append("und")
                    score.append(0.0)
                    continue
                k = int(b.argmin())
                pred.append(model.langs[k])
                score.append(float(1 / np.exp2(np.maximum(b[k] - b, -1000)).sum()))
        return [pa.array(pred, pa.string()), pa.array(score, pa.float64())]

    return annotate(docs, run, "lang_pred string, score double", [text], carry)
