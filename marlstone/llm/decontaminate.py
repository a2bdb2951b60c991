"""Benchmark decontamination: a broadcast hash set of the benchmark's n-grams meets every window of every document.

Benchmark items become windows of ``n`` consecutive words (an item of fewer words, but not none, is one window). The
windows are broadcast as arrays: sorted 64-bit hashes, the place of the words in the normalised items, the items that have
them. Items are dealt into blocks of ``block_bytes`` of text at most (of equal texts one counts; an item that is longer is
a block by itself), for there is one broadcast of some six times that at a time. Documents are scanned in their own
partitions as byte arrays: words by a byte table, word and window hashes by prefix sums, a bit table to dismiss most
windows, then a comparison of the very words.

One block takes one pass without a shuffle. Where there are more, documents are numbered and written once, every pass reads
their texts and gives finds alone, and the finds of all passes are joined to the documents.

Defined results: null and empty texts have no words and are never contaminated; a text of any length is scanned whole;
null item ids count as the empty text, items with a null text not at all; items with equal texts are all found where one is;
equal rows get equal results; an empty benchmark hits nothing, an empty table of documents gives an empty result; input
columns with the names of the added ones are replaced, all others pass through (filtering keeps all as they are).
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import ALNUM, annotate, gram_hashes, materialize, mix, release, sized, slices, text_buffers, word_hashes, words

#: Bytes of benchmark text in one broadcast block, and in one of the bins that blocks are made of.
BLOCK_BYTES, BIN_BYTES = 32 << 20, 1 << 20
SPANS = "decon_words long, decon_spans array<struct<start: long, end: long>>, decon_items array<string>"


class Windows:
    """The windows of a block of items, by length."""

    def __init__(self, items: list[tuple[list[str], str]], n: int):
        self.ids = [ids for ids, _ in items]
        texts = [t.encode() for _, t in items]
        off = np.cumsum([0, *map(len, texts)])
        low, starts, ends, woff = words(np.frombuffer(b"".join(texts), np.uint8), off, ALNUM)
        del texts
        h, count = word_hashes(low, starts, ends), np.diff(woff)
        self.by_size = {}
        for size in sorted(set(np.minimum(count, n).tolist()) - {0}):
            own = count >= n if size == n else count == size
            first = np.repeat(own, count)
            last = np.repeat(woff[1:], count)
            at = np.flatnonzero(first & (np.arange(len(h)) + size <= last))
            self.by_size[size] = self._table(h, at, size, woff)
        self.raw, self.starts, self.ends = low.tobytes(), starts.astype(np.uint32 if len(low) < 1 << 32 else np.int64), ends.astype(np.uint32 if len(low) < 1 << 32 else np.int64)

    @staticmethod
    def _table(h: np.ndarray, at: np.ndarray, size: int, woff: np.ndarray) -> tuple:
        """Sorted hashes of distinct windows, a place of each, and the items of each: from, and numbers."""
        g = gram_hashes(h, size)[at]
        g2 = gram_hashes(mix(h ^ np.uint64(0x6A09E667F3BCC909)), size)[at]  # tells apart windows that share a hash
        item = (np.searchsorted(woff, at, "right") - 1).astype(np.int32)
        order = np.lexsort((item, g2, g))
        g, g2, item, at = g[order], g2[order], item[order], at[order]
        new = np.ones(len(g), bool)
        new[1:] = (g[1:] != g[:-1]) | (g2[1:] != g2[:-1])
        keep = new.copy()
        keep[1:] |= item[1:] != item[:-1]
        start = np.flatnonzero(new[keep])
        return g[new], at[new].astype(np.int64), np.append(start, keep.sum()).astype(np.int64), item[keep]

    def table(self, size: int) -> tuple[np.ndarray, np.uint64]:
        """A bit table of the hashes' leading bits; made where it is used, once."""
        made = self.__dict__.setdefault("_tables", {})
        if size not in made:
            hashes = self.by_size[size][0]
            bits = int(np.clip(np.ceil(np.log2(8 * max(1, len(hashes)))), 12, 26))
            table, shift = np.zeros(1 << bits, bool), np.uint64(64 - bits)
            table[hashes >> shift] = True
            made[size] = table, shift
        return made[size]

    def words_at(self, i: int, n: int) -> bytes:
        return _key(self.raw, self.starts, self.ends, i, n)


def _key(raw: bytes, starts, ends, i: int, n: int) -> bytes:
    return b" ".join(raw[starts[j] : ends[j]] for j in range(i, i + n))


def scan(data: np.ndarray, off: np.ndarray, windows: Windows) -> tuple[np.ndarray, dict]:
    """Words of each document; hits by document: (first word, words, item numbers)."""
    low, starts, ends, woff = words(data, off, ALNUM)
    hits: dict = defaultdict(list)
    if windows.by_size and len(starts):
        h, raw = word_hashes(low, starts, ends), None
        for n, (hashes, place, first, item) in windows.by_size.items():
            table, shift = windows.table(n)
            g = gram_hashes(h, n)
            at = np.flatnonzero(table[g >> shift])
            k = np.searchsorted(hashes, g[at])
            same = hashes[np.minimum(k, len(hashes) - 1)] == g[at]
            at, k = at[same], k[same]
            doc = np.searchsorted(woff, at, "right") - 1
            inside = at + n <= woff[doc + 1]
            for i, d, j in zip(at[inside].tolist(), doc[inside].tolist(), k[inside].tolist(), strict=True):
                raw = low.tobytes() if raw is None else raw
                own = _key(raw, starts, ends, i, n)
                while j < len(hashes) and hashes[j] == g[i]:  # one, but for windows that share a hash
                    if windows.words_at(int(place[j]), n) == own:
                        hits[d].append((i - int(woff[d]), n, item[first[j] : first[j + 1]]))
                    j += 1
    return np.diff(woff), hits


def _merged(spans: list[tuple[int, int]]) -> list[dict]:
    out: list[dict] = []
    for a, b in sorted(spans):
        if out and a <= out[-1]["end"]:
            out[-1]["end"] = max(out[-1]["end"], b)
        else:
            out.append({"start": a, "end": b})
    return out


def _blocks(items: DataFrame, block_bytes: int) -> list:
    """Conditions that deal distinct texts into blocks of at most so many bytes: bins by hash, packed in order."""
    total = items.agg(F.sum("size")).first()[0] or 0
    if total <= block_bytes:
        return [F.lit(True)]
    bins = -(-total // max(1, min(BIN_BYTES, block_bytes // 8)))
    at = F.pmod(F.xxhash64("t"), F.lit(bins))
    # A row for each bin, in their order; one that is too large is only so by a single text that is.
    sizes = items.groupBy(at.alias("bin")).agg(F.sum("size").alias("size")).orderBy("bin")
    out, low, held = [], 0, 0
    for r in sizes.toLocalIterator():
        if held and held + r["size"] > block_bytes:
            out.append(at.between(low, r["bin"] - 1))
            low, held = r["bin"], 0
        held += r["size"]
    return [*out, at >= low]


def _finds(rows: DataFrame, windows: Windows, text: str, carry: list[str]) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(windows)

    def run(columns: list[pa.Array]) -> list[pa.Array]:
        windows = shared.value
        data, off, _ = text_buffers(columns[0])
        counts, spans, found = [], [], []
        for lo, hi in slices(off):
            number, hits = scan(data[off[lo] : off[hi]], off[lo : hi + 1] - off[lo], windows)
            counts.append(number)
            for d in range(hi - lo):
                own = hits.get(d, ())
                spans.append(_merged([(i, i + w) for i, w, _ in own]))
                items = np.unique(np.concatenate([x for _, _, x in own])).tolist() if own else ()
                found.append(sorted({i for k in items for i in windows.ids[k]}))
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        number = np.concatenate(counts) if counts else np.zeros(0, np.int64)
        return [pa.array(number, pa.int64()), pa.array(spans, kind), pa.array(found, pa.list_(pa.string()))]

    return annotate(rows, run, SPANS, [text], carry)


def _joined(finds: DataFrame) -> DataFrame:
    """The finds of several passes as one row for each document that has any: __r, __spans, __items."""
    both = finds.groupBy("__row").agg(F.flatten(F.collect_list("decon_spans")).alias("x"), F.flatten(F.collect_list("decon_items")).alias("y"))

    def run(columns: list[pa.Array]) -> list[pa.Array]:
        spans = [_merged([(x["start"], x["end"]) for x in own]) for own in columns[0].to_pylist()]
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        return [pa.array(spans, kind), pa.array([sorted(set(own)) for own in columns[1].to_pylist()], pa.list_(pa.string()))]

    out = annotate(both, run, "__spans array<struct<start: long, end: long>>, __items array<string>", ["x", "y"], ["__row"])
    return out.withColumnRenamed("__row", "__r")


def find_contamination(docs: DataFrame, benchmark: DataFrame, n: int = 13, text: str = "text", item_id: str = "item_id", item_text: str = "text", carry: list[str] | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` (or its ``carry`` columns) with decon_words, decon_spans (ranges of words inside benchmark windows, merged),
    decon_items (ids of the items with occurring windows, sorted) and decon_hit (words inside the spans)."""
    named = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("i"), F.col(item_text).alias("t")).filter("t is not null")
    items = named.groupBy("t").agg(F.array_sort(F.collect_set("i")).alias("ids")).withColumn("size", F.octet_length(F.concat("t", F.array_join("ids", ""))).cast("long"))
    items = materialize(items, "decon-items")
    carry = [c for c in (docs.columns if carry is None else carry) if c.lower() not in ("decon_words", "decon_spans", "decon_items", "decon_hit")]
    blocks = _blocks(items, block_bytes)
    block = lambda k: Windows([(r["ids"], r["t"]) for r in items.filter(blocks[k]).toLocalIterator()], n)
    if len(blocks) == 1:
        out = _finds(docs, block(0), text, carry)
    else:
        kept = F.struct(*[F.col(f"`{c}`") for c in carry], F.lit(0).alias("__0")).alias("__doc")
        rows = materialize(docs.select(kept, F.col(text).alias("__text"), F.monotonically_increasing_id().alias("__row")), "decon-rows")
        first = materialize(_finds(rows, block(0), "__text", ["__row"]), "decon-pass")
        passes = [first.filter(F.size("decon_items") > 0).select("__row", "decon_spans", "decon_items")]
        for k in range(1, len(blocks)):
            hit = _finds(rows, block(k), "__text", ["__row"]).filter(F.size("decon_items") > 0)
            passes.append(materialize(hit.select("__row", "decon_spans", "decon_items"), "decon-pass"))
        finds = passes[0]
        for p in passes[1:]:
            finds = finds.unionByName(p)
        found = materialize(_joined(finds), "decon-finds")
        for p in passes[1:]:
            release(p)
        count = first.select(F.col("__row").alias("__w"), "decon_words")
        out = rows.join(count.hint("merge"), F.col("__row") == F.col("__w")).join(sized(found), F.col("__row") == F.col("__r"), "left")
        none = lambda c, t: F.coalesce(c, F.expr(f"cast(array() as {t})"))
        out = out.select(*[F.col(f"__doc.`{c}`") for c in carry], "decon_words", none("__spans", "array<struct<start: long, end: long>>").alias("decon_spans"), none("__items", "array<string>").alias("decon_items"))
    hit = F.aggregate("decon_spans", F.lit(0).cast("long"), lambda a, x: a + x["end"] - x["start"])
    return out.withColumn("decon_hit", hit)


def decontaminate(docs: DataFrame, benchmark: DataFrame, n: int = 13, share: float = 0.05, text: str = "text", **names) -> DataFrame:
    """The rows of ``docs``, as they are, of whose words less than ``share`` lie inside benchmark windows."""
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__doc"), F.col(text).alias("__text"))
    found = find_contamination(packed, benchmark, n, "__text", carry=["__doc"], **names)
    hit = (F.col("decon_hit") > 0) & (F.col("decon_hit") >= F.lit(share) * F.col("decon_words"))
    return found.filter(~hit).select("__doc.*")
