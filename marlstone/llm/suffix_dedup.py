"""Passages that repeat across documents, by a sparse suffix array over words.

Of the suffixes of all documents only those at minimisers are kept: word positions whose 4-word gram has the smallest
hash in some window of ``window`` grams, a choice that depends on the words alone. Two documents that share ``min_words``
words share a kept position among the first ``window`` of them, and from there on at least ``min_words - window + 1``
words: the depth to which suffixes are first told apart, by a 128-bit hash. Kept suffixes that agree to that depth in two
documents are sorted by what follows and compared with their neighbours, which gives each its longest common continuation;
sorted by what goes before, read backwards, they give the longest extension to the left. Only rows of other documents count
as neighbours: over the rows of one document the common length is carried along. Sorting is by range with the document and
position among the sort columns, so a passage that a third of all documents share is split over many tasks, each read as a
stream; for the first and last run of every part a small job by key finds the neighbours in other parts.

The result covers every passage of ``min_words`` or more words that occurs in two documents, in full, and each of its words
lies in a passage of at least ``min_words - window + 1`` words that does. Spans that overlap are joined; joined spans of fewer
than ``min_words`` words are dropped. Words are runs of anything but white space, without regard to the case of A-Z; they are
compared by 64-bit hashes, keys by 128 bits, and a document is named by a 64-bit hash of id and text.

Defined results: null and empty texts have no words; rows with equal id and text are one document, rows that share an id
alone are several; a passage that repeats only inside one document is left alone; where several documents tie as the
longest match all give the same span; a text of any length is read whole, in one task; other columns, whatever their names,
are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ._shared import NOT_SPACE, annotate, gram_hashes, importable, materialize, mix, release, settle, sized, slices, text_buffers, word_hashes, words

GRAM = 4
U = np.uint64


def _sliding(x: np.ndarray, n: int, pick) -> np.ndarray:
    """pick (minimum or maximum) over n consecutive values, by doubling."""
    done, out = 1, x
    while done < n:
        step = min(done, n - done)
        out = pick(out[: len(out) - step], out[step:])
        done += step
    return out


def kept_positions(h: np.ndarray, woff: np.ndarray, window: int) -> np.ndarray:
    """Word positions of minimisers; windows that cross documents don't count."""
    g = gram_hashes(h, GRAM) | U(1)
    if len(g) < window:
        return np.zeros(0, np.int64)
    least = _sliding(g, window, np.minimum)
    start = np.arange(len(least))
    doc = np.searchsorted(woff, start, "right") - 1
    least = np.where(start + window + GRAM - 1 <= woff[doc + 1], least, U(0))
    pad = np.zeros(window - 1, U)
    best = _sliding(np.concatenate([pad, least, pad]), window, np.maximum)
    return np.flatnonzero(best[: len(g)] == g)


def suffixes(data: np.ndarray, off: np.ndarray, window: int, depth: int):
    """Kept positions with their keys of ``depth`` words; by document."""
    low, starts, ends, woff = words(data, off, NOT_SPACE)
    h = word_hashes(low, starts, ends)
    at = kept_positions(h, woff, window)
    k = gram_hashes(h, depth)
    k2 = gram_hashes(mix(h ^ U(0x2545F4914F6CDD1D)), depth)
    doc = np.searchsorted(woff, at, "right") - 1
    inside = at + depth <= woff[doc + 1]
    at, doc = at[inside], doc[inside]
    return h, woff, at, doc, k[at], k2[at]


def _list(values: np.ndarray, cut: np.ndarray, kind) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(cut.astype(np.int32)), pa.array(values, kind))


def _positions(docs: DataFrame, text: str, window: int, depth: int) -> DataFrame:
    """(id, h, pos, k1, k2) of every kept suffix."""

    def run(columns: list[pa.Array]) -> list[pa.Array]:
        data, off, _ = text_buffers(columns[0])
        pos, k1, k2, counts = [], [], [], [np.zeros(1, np.int64)]
        for lo, hi in slices(off):
            _, woff, at, doc, a, b = suffixes(data[off[lo] : off[hi]], off[lo : hi + 1] - off[lo], window, depth)
            pos.append(at - woff[doc])
            k1.append(a.view(np.int64))
            k2.append(b.view(np.int64))
            counts.append(np.bincount(doc, minlength=hi - lo))
        cut = np.cumsum(np.concatenate(counts))
        cat = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
        return [_list(cat(pos).astype(np.int32), cut, pa.int32()), _list(cat(k1), cut, pa.int64()), _list(cat(k2), cut, pa.int64())]

    found = annotate(docs, run, "pos array<int>, k1 array<long>, k2 array<long>", [text], ["id", "h"])
    return found.select("id", "h", F.explode(F.arrays_zip("pos", "k1", "k2")).alias("x")).select("id", "h", "x.pos", "x.k1", "x.k2")


def _contexts(docs: DataFrame, wanted: DataFrame, text: str, window: int, depth: int) -> DataFrame:
    """For each wanted suffix the hashes of the words before it (nearest first) and after its key, 8 bytes a word."""
    side = window - 1
    wanted = wanted.groupBy("id", "h").agg(F.array_sort(F.collect_set(F.struct("pos", "k1", "k2"))).alias("want"))
    wanted = materialize(wanted.withColumnsRenamed({"id": "__i", "h": "__h"}), "suffix-wanted")
    rows = docs.join(wanted.hint("merge"), F.col("id").eqNullSafe(F.col("__i")) & (F.col("h") == F.col("__h")))

    def run(columns: list[pa.Array]) -> list[pa.Array]:
        data, off, _ = text_buffers(columns[0])
        want = columns[1]
        cut = np.asarray(want.offsets)
        pos = np.asarray(want.values.field(0))[cut[0] : cut[-1]].astype(np.int64)
        cut = (cut - cut[0]).astype(np.int64)
        before, after = [], []
        for lo, hi in slices(off):
            low, starts, ends, woff = words(data[off[lo] : off[hi]], off[lo : hi + 1] - off[lo], NOT_SPACE)
            h = np.concatenate([word_hashes(low, starts, ends) | U(1), np.zeros(1, U)])
            n = np.diff(cut[lo : hi + 1])
            first, last = np.repeat(woff[:-1], n), np.repeat(woff[1:], n)
            p = pos[cut[lo] : cut[hi]] + first
            step = np.arange(side)
            # Outside the document a word is zero: it equals no other, see _common.
            left = p[:, None] - 1 - step
            right = p[:, None] + depth + step
            before.append(np.where(left >= first[:, None], h[np.maximum(left, 0)], U(0)))
            after.append(np.where(right < last[:, None], h[np.minimum(right, len(h) - 1)], U(0)))
        pack = lambda x: pa.array([r.tobytes() for r in np.concatenate(x).astype(">u8")] if x else [], pa.binary())
        lists = lambda x: pa.ListArray.from_arrays(pa.array(cut.astype(np.int32)), x)
        return [lists(pack(before)), lists(pack(after))]

    found = annotate(rows, run, "before array<binary>, after array<binary>", [text, "want"], ["id", "h", "want"])
    out = found.select("id", "h", F.explode(F.arrays_zip("want", "before", "after")).alias("x"))
    return out.select("id", "h", "x.want.pos", "x.want.k1", "x.want.k2", "x.before", "x.after")


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Words that rows of hashes have in common from the start; zeros are the end of a document."""
    same = (a == b) & (a != 0)
    return np.cumprod(same, axis=1).sum(1)


#: Stands for "as far as the context goes", until the row beyond an end of the part is known; for "another key".
OPEN, NONE = 1 << 10, -1


def _least(values: np.ndarray, breaks: np.ndarray) -> np.ndarray:
    """The smallest of ``values`` from the last break (itself included) up to each place."""
    level = np.cumsum(breaks) * (4 * OPEN)
    return np.minimum.accumulate(values - level) + level


class Neighbours:
    """Longest common contexts with the nearest rows of other documents, from rows in sorted order, batch by batch.

    Two rows have in common what every two adjacent rows between them have, so over a run of one document's rows the
    smallest of these numbers is carried along, downwards and upwards. Rows of the first and the last run of a part may
    have their neighbour in another part: they are given with what the run leaves of it (``up``, ``down``).
    """

    def __init__(self):
        self.last = None  # h, k1, k2, ctx and ``up`` of the row before
        self.in_head = True  # no break yet: all rows so far are of the part's first run
        self.waiting: list[list] = []  # the run that may go on: payload, up, head and what it leaves downwards
        self.ends: list[tuple] = []  # (role, h, k1, k2, ctx): 0 first row, 1 after its run, 2 before the last run, 3 last row
        self.before = None

    def add(self, payload, h: np.ndarray, k1: np.ndarray, k2: np.ndarray, ctx: np.ndarray):
        """Rows that are settled by a batch: (payload, up, head, down, tail) with whole or open numbers."""
        n = len(h)
        row = lambda i: (h[i], k1[i], k2[i], ctx[i])
        adj, other = np.full(n, NONE, np.int64), np.ones(n, bool)
        alike = (k1[1:] == k1[:-1]) & (k2[1:] == k2[:-1])
        adj[1:] = np.where(alike, _common(ctx[1:], ctx[:-1]), NONE)
        other[1:] = ~alike | (h[1:] != h[:-1])
        if self.last is None:
            self.ends.append((0, *row(0)))
            adj[0] = OPEN
        else:
            ph, p1, p2, pc, carried = self.last
            if p1 == k1[0] and p2 == k2[0]:
                adj[0], other[0] = _common(ctx[:1], pc[None])[0], ph != h[0]
        first = adj.copy()
        if self.last is not None and not other[0]:
            first[0] = min(first[0], carried)
        up = _least(first, other)
        breaks = np.flatnonzero(other[1:]) + 1
        if self.last is not None and other[0]:
            breaks = np.r_[0, breaks]
        head = np.zeros(n, bool)
        if self.in_head:
            head[: breaks[0] if len(breaks) else n] = True
            if len(breaks):
                self.in_head = False
                if adj[breaks[0]] >= 0:
                    self.ends.append((1, *row(breaks[0])))
        if len(breaks):
            b = breaks[-1]
            self.before = None if adj[b] < 0 else (row(b - 1) if b else self.last[:4])
        # Downwards: what row i has in common with i + 1, and so on to the run's end.
        below, end = np.r_[adj[1:], OPEN], np.r_[other[1:], True]
        down = _least(below[::-1], end[::-1])[::-1]
        whole = breaks[-1] if len(breaks) else 0  # rows from here on are of a run that may go on
        out = []
        if self.waiting:
            beyond = adj[0] if other[0] else min(adj[0], down[0])
            for w in self.waiting:
                w[3] = np.minimum(w[3], beyond)
            if len(breaks):
                out += [(*w, False) for w in self.waiting]
                self.waiting = []
        if whole:
            out.append((payload(0, whole), up[:whole], head[:whole], down[:whole], False))
        self.waiting.append([payload(whole, n), up[whole:], head[whole:], down[whole:]])
        self.last = (*row(n - 1), up[-1])
        return out

    def finish(self):
        """The rows of the last run."""
        if self.last is None:
            return []
        if self.before is not None:
            self.ends.append((2, *self.before))
        self.ends.append((3, *self.last[:4]))
        return [(*w, True) for w in self.waiting]


def _words_alike(a, b, side: int):
    """_common for two columns of packed contexts."""
    word = lambda c, i: F.substring(c, i * 8 + 1, F.lit(8))
    differ = F.transform(F.sequence(F.lit(0), F.lit(side - 1)), lambda i: (word(a, i) != word(b, i)) | (word(a, i) == F.lit(bytes(8))))
    at = F.array_position(differ, True).cast("int")
    return F.when(at == 0, side).otherwise(at - 1)


def _beyond_parts(ends: DataFrame, side: int) -> DataFrame:
    """(bp, above, below): what the first row of a part has in common with the nearest row of another document in the
    parts before, and its last row with the nearest in those after. By key, over at most four rows of each part."""
    from pyspark.sql.window import WindowSpec

    def nearest(df: DataFrame, w: WindowSpec, name: str) -> DataFrame:
        df = df.withColumn("__c", F.when(F.lag("h").over(w) != F.col("h"), F.lag("ctx").over(w)))
        return df.withColumn(name, F.last("__c", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("__c")

    key = Window.partitionBy("k1", "k2")
    ends = nearest(nearest(ends, key.orderBy("part", "role"), "a"), key.orderBy(F.desc("part"), F.desc("role")), "b")
    common = lambda c, role: F.max(F.when((F.col("role") == role) & F.col(c).isNotNull(), _words_alike(F.col("ctx"), F.col(c), side)))
    return ends.groupBy(F.col("part").alias("bp")).agg(common("a", 0).alias("above"), common("b", 3).alias("below"))


NEIGHBOUR = "id {}, h long, pos int, ext int, part int, up int, down int, role int, k1 long, k2 long, ctx binary"
#: Rows of a part of the sorted order; parts are read as streams, so this bounds a task's time, not its memory.
PART_ROWS = 500_000


def _neighbours(rows: DataFrame, column: str, side: int) -> DataFrame:
    """(id, h, pos, ext): the longest run of words of ``column`` in common with a row of another document that has the
    same key. In sorted order that is one of the two nearest such rows."""
    n = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // PART_ROWS))
    order = ["k1", "k2", "ctx", "id", "h", "pos"]
    ordered = rows.select("id", "h", "pos", "k1", "k2", F.col(column).alias("ctx"))
    ordered = ordered.repartitionByRange(n, *order).sortWithinPartitions(*order)

    def run(batches):
        part, found, kind = TaskContext.get().partitionId(), Neighbours(), None

        def give(settled):
            for (ids, hs, pos), up, head, down, tail in settled:
                if not len(hs):
                    continue
                ext = np.maximum(0, np.maximum(np.where(head, 0, up), 0 if tail else down))
                ints = lambda x, ok: pa.array(np.where(ok, x, 0).astype(np.int32), mask=~np.broadcast_to(ok, len(hs)))
                here, last = np.full(len(hs), part), np.full(len(hs), tail)
                empty = [pa.nulls(len(hs), t) for t in (pa.int32(), pa.int64(), pa.int64(), pa.binary())]
                yield pa.RecordBatch.from_arrays([ids, hs, pos, pa.array(ext.astype(np.int32)), ints(here, head | last), ints(up, head), ints(down, last), *empty], names=NAMES)

        for b in batches:
            if not b.num_rows:
                continue
            kind = b.column("id").type
            h, k1, k2 = (np.asarray(b.column(c)) for c in ("h", "k1", "k2"))
            ctx = np.frombuffer(b"".join(b.column("ctx").to_pylist()), ">u8").reshape(-1, side)
            # What waits is copied: a slice would hold its whole batch, contexts and all.
            cut = lambda lo, hi, b=b: [b.column(c).take(pa.array(np.arange(lo, hi))) for c in ("id", "h", "pos")]
            yield from give(found.add(cut, h, k1, k2, ctx))
        yield from give(found.finish())
        if found.ends:
            role, h, k1, k2, ctx = zip(*found.ends, strict=True)
            m = len(role)
            longs, ints = (lambda x: pa.array(map(int, x), pa.int64())), lambda x: pa.array(x, pa.int32())
            yield pa.RecordBatch.from_arrays([
                pa.nulls(m, kind), longs(h), *[pa.nulls(m, pa.int32())] * 2, ints([part] * m), *[pa.nulls(m, pa.int32())] * 2, ints(role), longs(k1), longs(k2),
                pa.array([c.tobytes() for c in ctx], pa.binary()),
            ], names=NAMES)

    importable(rows.sparkSession)
    found = materialize(ordered.mapInArrow(run, NEIGHBOUR.format(rows.schema["id"].dataType.simpleString())), "suffix-neighbours")
    ends = found.filter("role is not null").select("part", "role", "h", "k1", "k2", "ctx")
    beyond = materialize(_beyond_parts(ends, side), "suffix-parts")
    out = found.filter("role is null").join(sized(beyond), F.col("part") == F.col("bp"), "left")
    reach = lambda run, far: F.when(F.col(run).isNotNull() & F.col(far).isNotNull(), F.least(run, far))
    return out.select("id", "h", "pos", F.greatest("ext", reach("up", "above"), reach("down", "below")).alias("ext"))


NAMES = ["id", "h", "pos", "ext", "part", "up", "down", "role", "k1", "k2", "ctx"]


def _once(docs: DataFrame, id: str, text: str) -> DataFrame:
    """(id, h, t): one row for each id and text; h is a hash of both and names the document."""
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(id).alias("id"), F.xxhash64(F.col(id).cast("string"), body).alias("h"), body.alias("t"))
    again = materialize(rows.groupBy("id", "h").count().filter("count > 1").select(F.col("id").alias("ri"), F.col("h").alias("rh")), "suffix-repeated")
    if not again.limit(1).count():
        return rows
    hit, again = F.col("id").eqNullSafe(F.col("ri")) & (F.col("h") == F.col("rh")), sized(again)
    one = rows.join(again, hit, "left_semi").groupBy("id", "h").agg(F.first("t").alias("t"))
    return materialize(rows.join(again, hit, "left_anti").unionByName(one), "suffix-documents")


def repeated_passages(docs: DataFrame, id: str = "doc_id", text: str = "text", min_words: int = 50, window: int = 20) -> DataFrame:
    """(id, h, n_repeated, spans) of each document with repeated passages: spans are ranges of words, start to end."""
    return settle(lambda: _repeated(docs, id, text, min_words, window), "suffix-spans")


def _repeated(docs: DataFrame, id: str, text: str, min_words: int, window: int) -> DataFrame:
    depth = min_words - window + 1
    rows = _once(docs, id, text)
    every = materialize(_positions(rows, "t", window, depth), "suffix-positions")
    keys = every.groupBy("k1", "k2").agg(F.min("h").alias("lo"), F.max("h").alias("hi")).filter("lo < hi")
    keys = materialize(keys.select(F.col("k1").alias("a1"), F.col("k2").alias("a2")), "suffix-keys")
    # Both grow with the corpus: always a shuffle join, whose hot keys adaptive execution splits.
    shared = every.join(keys.hint("merge"), (F.col("k1") == F.col("a1")) & (F.col("k2") == F.col("a2")), "left_semi")
    # Runs of kept positions whose keys touch. A passage's first kept suffix lies less than ``window`` words inside it; if it
    # is not covered by a run that begins before the passage, it lies as near to the run's begin; likewise at the end. Which
    # of the suffixes there other documents keep differs from one document to the next, so all of them are extended.
    doc = Window.partitionBy("id", "h").orderBy("pos")
    ends = shared.withColumn("begins", F.coalesce(F.col("pos") - F.lag("pos").over(doc) > depth, F.lit(True)))
    ends = ends.withColumn("finishes", F.coalesce(F.lead("pos").over(doc) - F.col("pos") > depth, F.lit(True)))
    near = lambda lo, hi: doc.rangeBetween(lo, hi)
    edges = F.max("begins").over(near(1 - window, 0)) | F.max("finishes").over(near(0, window - 1))
    shared = materialize(ends.withColumn("edge", edges), "suffix-shared")
    release(every)
    edge = materialize(shared.filter("edge").select(F.col("k1").alias("e1"), F.col("k2").alias("e2")).distinct(), "suffix-edges")
    wanted = shared.join(sized(edge), (F.col("k1") == F.col("e1")) & (F.col("k2") == F.col("e2")), "left_semi").select("id", "h", "pos", "k1", "k2")
    around = materialize(_contexts(rows, wanted, "t", window, depth), "suffix-contexts")
    left = _neighbours(around, "before", window - 1).withColumnsRenamed({"id": "li", "h": "lh", "pos": "lp", "ext": "left"})
    right = _neighbours(around, "after", window - 1).withColumnsRenamed({"id": "ri", "h": "rh", "pos": "rp", "ext": "right"})
    run = shared.filter("edge")
    on = lambda i, h, p: F.col("id").eqNullSafe(F.col(i)) & (F.col("h") == F.col(h)) & (F.col("pos") == F.col(p))
    run = run.join(left, on("li", "lh", "lp"), "left").join(right, on("ri", "rh", "rp"), "left")
    span = lambda s, e: F.struct(s.cast("long").alias("start"), e.cast("long").alias("end"))
    end = F.col("pos") + depth
    # A run's first row gives where it starts, its last row where it ends; both in order, they pair up.
    pieces = run.groupBy("id", "h").agg(
        F.array_sort(F.collect_list(F.when(F.col("begins"), F.col("pos")))).alias("s"), F.array_sort(F.collect_list(F.when(F.col("finishes"), end))).alias("e"),
        F.collect_list(span(F.col("pos") - F.coalesce("left", F.lit(0)), end + F.coalesce("right", F.lit(0)))).alias("x"),
    )
    one = F.array_sort(F.concat(F.zip_with("s", "e", span), "x"))
    none = F.expr("cast(array() as array<struct<start: long, end: long>>)")

    def join(acc, x):
        last = F.element_at(acc, -1)
        merged = F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(F.struct(last["start"].alias("start"), F.greatest(last["end"], x["end"]).alias("end"))))
        return F.when((F.size(acc) > 0) & (x["start"] <= F.try_element_at(acc, F.lit(-1))["end"]), merged).otherwise(F.concat(acc, F.array(x)))

    spans = F.filter(F.aggregate(one, none, join), lambda x: x["end"] - x["start"] >= min_words)
    total = F.aggregate("spans", F.lit(0).cast("long"), lambda a, x: a + x["end"] - x["start"])
    out = pieces.select("id", "h", spans.alias("spans")).filter(F.size("spans") > 0)
    return out.select(F.col("id").alias(id), "h", total.alias("n_repeated"), "spans")
