"""Exact Jaccard self-join on word shingles by universe partitioning.

A document's set holds the 64-bit hashes of its distinct shingles. Sets whose Jaccard similarity reaches the threshold
differ in at most H = (1 - t) / (1 + t) * (sum of sizes) elements. Sizes fall into bands such that linked sets are in one
band or in neighbouring ones; a set of band k takes part in the instances k and k + 1. An instance deals the universe of
shingles into m segments by hash; what a set has in a segment is its subset there, named by a hash. By the pigeonhole
principle linked sets agree in some segment, if levels add up to more than H:

* level 1, the subset is indexed: finds segments that are equal;
* level 2, also the subset less any one element (its one-deletion neighbourhood): finds segments that differ by one;
* level 0, left out: empty subsets, and subsets that very many sets share (known only from the index).

m and the level of an instance come from a cost model: entries to index against the chance that a set falls short of H
once empty segments are left out. Left-out segments are accounted for set by set: a set that still has more than H
levels loses nothing, since its linked sets meet it elsewhere. Sets that fall short are met in the left-out groups too,
with each other. So nothing is capped, and nothing is lost. Groups that many sets share never meet in one task: a task that
indexes documents sorts a million entries at a time, and of a hash that more than ``MANY`` of them have it sends its bucket
a mark instead: with different labels the members go their own way, with one label they are told later, if another label
turns up elsewhere (rows of labelled documents are then indexed once more, for those hashes alone). More than that, linked sets must meet as often as a set has
levels to spare beyond H (less what was left out of it), which dismisses most chance meetings before any text moves.

Copies and clusters must not cost pairs: equal sets are one node; a first round with a few segments of each instance
offers every node the one leader it shares most with, and components of the verified links become labels; the full index
then only yields pairs with different labels. Every link is verified on the texts themselves.

Defined results: null and empty texts have no shingles and no links; a text with fewer words than a shingle is one
shingle; rows with a null id link others but give no id (a component of such rows alone has a null id); equal rows are
one node; rows of one id with different texts are nodes of their own; of ties for the smallest id there is but one value;
a text of any length is one row's work; other columns, whatever their names, are not read (or pass through, where rows are
kept); an empty table gives an empty result.
"""

from __future__ import annotations

import math
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import NOT_SPACE, annotate, gram_hashes, importable, materialize, mix, release, settle, sized, slices, text_buffers, trim, word_hashes, words
from .components import connected_components

#: Index entries a bucket should hold, nodes of a group from which on it counts as shared by very many, first-round segments.
BUCKET_ENTRIES, MANY, FIRST = 2_000_000, 16, 8
#: What an entry of one shingle costs in the cost model, in entries.
LONE = 20
SLICE, SLICE_DOCS = 2 << 20, 50_000
#: Nodes of a block when large groups are counted, leaders offered to a node in the first round.
BLOCK, OFFERS = 256, 3
#: Parts in which a bucket's entries are grouped.
PASSES = 8
#: Index entries that a task holds before it sorts and sends them.
FLUSH = 1_000_000
HEAD = [("id", "<u8"), ("label", "<u8"), ("slack", "<i4"), ("turn", "u1")]
BODY = [("sig", "<u4"), ("at", "<u4")]
MARK = [("sig", "<u4"), ("label", "<u8"), ("differ", "u1")]
MEMBER = [*HEAD, ("sig", "<i8"), ("loss", "u1")]
U = np.uint64


def shingle_sets(data: np.ndarray, off: np.ndarray, n: int = 5) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each document."""
    low, starts, ends, woff = words(data, off, NOT_SPACE)
    h = word_hashes(low, starts, ends)
    g = gram_hashes(h, n)
    count = np.diff(woff)
    short = {k: gram_hashes(h, k) for k in range(1, n) if (count == k).any()}
    out = []
    for a, c in zip(woff[:-1].tolist(), count.tolist(), strict=True):
        out.append(np.unique(g[a : a + c - n + 1]) if c >= n else short[c][a : a + 1] if c else np.zeros(0, U))
    return out


def node_name(s: np.ndarray) -> bytes:
    """128 bits for a set; empty for the empty set."""
    if not len(s):
        return b""
    a, b = int(mix(s ^ U(0x5851F42D4C957F2D)).sum()), int(mix(s * U(0x9E3779B97F4A7C15) + U(len(s))).sum())
    return a.to_bytes(8, "big") + b.to_bytes(8, "big")


@cache
def bands(percent: int, largest: int) -> tuple[tuple[int, int], ...]:
    out, low = [], 1
    while low <= largest:
        high = low * 100 // percent
        out.append((low, high))
        low = high + 1
    return tuple([*out, (low, low * 100 // percent)])


def most_apart(x: int, y: int, percent: int) -> int:
    """How many elements sets of these sizes may differ in and still link."""
    return (x + y) * (100 - percent) // (100 + percent)


@cache
def allocation(low: int, high: int, percent: int) -> tuple[int, int]:
    """Segments and level of the instance whose larger sets have ``low`` to ``high`` elements: the cheapest."""
    best = None
    for level in (1, 2):
        least = most_apart(high, high, percent) // level + 1
        for m in sorted({math.ceil(least * f / 20) for f in range(20, 61)}):
            short = 0.0
            for size in {low, high}:
                need, a = most_apart(size, min(high, size * 100 // percent), percent), size / m
                p0, p1 = math.exp(-a), a * math.exp(-a)
                if level == 1:
                    mean, var = m * (1 - p0), m * p0 * (1 - (1 + a) * p0)
                else:
                    mean = m * (2 - 2 * p0 - p1)
                    var = m * (4 * (1 - p0 - p1) + p1) - mean * mean / m
                short = max(short, 0.5 * math.erfc((mean - need - 0.5) / math.sqrt(2 * max(var, 1e-9))))
            # A lone shingle may be a stock phrase that many sets share: such entries count more.
            a = high / m
            lone = m * a * math.exp(-a) * (1 if level == 1 else 1 + a)
            cost = m + (high if level == 2 else 0) + LONE * lone + 100 * high * short
            if best is None or cost < best[0]:
                best = (cost, m, level)
    return best[1], best[2]


def instances(size: int, percent: int) -> list[tuple[int, int, int, int]]:
    """(instance, segments, level, H) in which a set of this size takes part."""
    table = bands(percent, 1 << 44)
    k = next(i for i, (_, high) in enumerate(table) if size <= high)
    out = []
    for i in (k, k + 1):
        low, high = table[i]
        out.append((i, *allocation(low, high, percent), most_apart(size, min(high, size * 100 // percent), percent)))
    return out


instances = cache(instances)


def index_entries(sets: list[np.ndarray], percent: int, first: int | None = None):
    """Entries of all sets: hash, owner (set * 2 + instance's turn), loss (levels that go if the entry is left out);
    and each owner's spare levels beyond H. ``first``: only that many segments of each instance."""
    tokens, seg, start, who, levels, salt = [], [], [], [], [], []
    slack = np.zeros(2 * len(sets), np.int64)
    m_of = np.zeros(2 * len(sets), np.int64)
    for d, s in enumerate(sets):
        if not len(s):
            continue
        for turn, (k, m, level, h) in enumerate(instances(len(s), percent)):
            tokens.append(s)
            salt.append(k)
            levels.append(level)
            who.append(2 * d + turn)
            start.append(len(s))
            slack[2 * d + turn] = -h
            m_of[2 * d + turn] = m
    if not tokens:
        return np.zeros(0, U), np.zeros(0, np.int64), np.zeros(0, np.int64), slack
    start, who, salt = np.array(start), np.array(who), np.array(salt, U)
    t = np.concatenate(tokens)
    row = np.repeat(np.arange(len(who)), start)
    seg = ((mix(t + salt[row] * U(0xD1342543DE82EF95)) >> U(32)) * m_of[who][row].astype(U)) >> U(32)
    x = mix(t ^ U(0xA0761D6478BD642F))
    if first is not None:
        few = seg < U(first)
        row, seg, x = row[few], seg[few], x[few]
    order = np.argsort((row.astype(np.int64) << 36) | seg.astype(np.int64), kind="stable")
    row, seg, x = row[order], seg[order], x[order]
    lead = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (seg[1:] != seg[:-1])])) if len(row) else np.zeros(0, np.int64)
    total = np.add.reduceat(x, lead) if len(lead) else x[:0]
    size = np.diff(lead, append=len(row))
    level = np.array(levels)
    place = mix((salt[row[lead]] << U(40)) ^ seg[lead]) if len(lead) else x[:0]
    own = mix(total + place)
    worth = np.where(level[row[lead]] == 2, np.minimum(size, 2), 1)
    np.add.at(slack, who[row[lead]], worth)
    if first is not None:
        return own, who[row[lead]], worth, slack
    deep = np.repeat((level[row[lead]] == 2) & (size > 1), size)
    less = mix((np.repeat(total + place, size) - x)[deep])
    out = [(own, who[row[lead]], worth), (less, who[row][deep], np.ones(int(deep.sum()), np.int64))]
    # Sets that fall short of H also index their empty subsets (and one-element subsets less that element).
    for r in np.flatnonzero(slack[who] <= 0).tolist():
        mine = row[lead] == r
        filled = seg[lead][mine]
        empty = np.setdiff1d(np.arange(m_of[who[r]]).astype(U), filled[size[mine] > 1] if levels[r] == 2 else filled)
        out.append((mix(mix((salt[r] << U(40)) ^ empty)), np.full(len(empty), who[r]), np.zeros(len(empty), np.int64)))
    return (*(np.concatenate(c) for c in zip(*out, strict=True)), slack)


def _pieces(off: np.ndarray, most: int = SLICE):
    for lo, hi in slices(off, most):
        for a in range(lo, hi, SLICE_DOCS):
            yield a, min(hi, a + SLICE_DOCS)


def describe(docs: DataFrame, id: str, text: str, n: int, percent: int) -> DataFrame:
    """Per row: its columns but the text, set size, node name and first-round index entries."""

    def run(columns: list[pa.Array]) -> list[pa.Array]:
        data, off, _ = text_buffers(columns[0])
        size, name, first = [], [], []
        for lo, hi in _pieces(off):
            sets = shingle_sets(data[off[lo] : off[hi]], off[lo : hi + 1] - off[lo], n)
            size += map(len, sets)
            name += map(node_name, sets)
            sig, who, _, _ = index_entries(sets, percent, FIRST)
            by = np.argsort(who >> 1, kind="stable")
            cut = np.searchsorted((who >> 1)[by], np.arange(len(sets) + 1))
            first += np.split(sig[by].view(np.int64), cut[1:-1]) if sets else []
        values = np.concatenate(first) if first else np.zeros(0, np.int64)
        offsets = np.cumsum([0, *map(len, first)]).astype(np.int32)
        return [pa.array(size, pa.int64()), pa.array(name, pa.binary()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))]

    return annotate(docs, run, "n_shingles long, node binary, first array<long>", [text], [c for c in docs.columns if c != text])


def _texts(docs: DataFrame, nodes: DataFrame, id: str, text: str, n: int, repeated: bool) -> DataFrame:
    """(node, text) of the nodes asked for: (node, rep, th), the id and text hash of a row of theirs. ``repeated``: rows may
    share both."""
    rows = docs.select(F.col(f"`{id}`").alias("__rep"), F.col(f"`{text}`").alias("text"), _text_hash(text).alias("__h"))
    asked = sized(nodes.select(F.col("rep").alias("__r"), F.col("th").alias("__th"), F.col("node").alias("asked")))
    got = rows.join(asked, (F.col("__h") == F.col("__th")) & F.col("__rep").eqNullSafe(F.col("__r"))).select("asked", "text")
    if repeated:
        got = got.groupBy("asked").agg(F.first("text").alias("text")).select("asked", "text")

    def run(columns: list[pa.Array]) -> list[pa.Array]:
        data, off, _ = text_buffers(columns[0])
        name = []
        for lo, hi in _pieces(off):
            name += map(node_name, shingle_sets(data[off[lo] : off[hi]], off[lo : hi + 1] - off[lo], n))
        return [pa.array(name, pa.binary())]

    named = annotate(got, run, "node binary", ["text"])
    return named.filter("node = asked").select("node", "text")


def verify(pairs: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs (a, b) of nodes whose texts' shingle sets are similar enough."""
    one = texts.select(F.col("node").alias("__b"), F.col("text").alias("tb"))
    two = texts.select(F.col("node").alias("__a"), F.col("text").alias("ta"))
    rows = pairs.join(one, pairs["b"] == one["__b"]).select("a", "b", "tb")
    rows = rows.join(two, rows["a"] == two["__a"]).select("a", "b", "ta", "tb")

    def run(columns: list[pa.Array]) -> list[pa.Array]:
        (da, oa, _), (db, ob, _) = text_buffers(columns[0]), text_buffers(columns[1])
        out = np.zeros(len(oa) - 1, bool)
        for lo, hi in _pieces(oa + ob, SLICE // 2):
            sa = shingle_sets(da[oa[lo] : oa[hi]], oa[lo : hi + 1] - oa[lo], n)
            sb = shingle_sets(db[ob[lo] : ob[hi]], ob[lo : hi + 1] - ob[lo], n)
            for i, (x, y) in enumerate(zip(sa, sb, strict=True)):
                if len(x) * 100 >= percent * len(y) and len(y) * 100 >= percent * len(x):
                    both = np.concatenate([x, y])
                    both.sort()
                    same = int((both[1:] == both[:-1]).sum())
                    out[lo + i] = 100 * same >= percent * (len(both) - same) and same > 0
        return [pa.array(out)]

    return annotate(rows, run, "linked boolean", ["ta", "tb"], ["a", "b"]).filter("linked").select("a", "b")


def _first_round(nodes: DataFrame) -> DataFrame:
    """For each node the leaders that it shares most first-round entries with. A group's leader is its smallest node in
    one of four orders, chosen by the group, so that members of a loose cluster meet several of it."""
    entries = nodes.select("node", F.explode("first").alias("sig"))
    order = F.xxhash64(F.pmod("sig", F.lit(4)), "node")
    groups = entries.groupBy("sig").agg(F.min(order).alias("lead"), F.max(order).alias("last")).filter("lead != last")
    groups = materialize(groups.select(F.col("sig").alias("g"), "lead"), "jaccard-leaders")
    met = entries.withColumn("own", order).join(sized(groups), F.col("sig") == F.col("g"))
    # Leaders are known by their hash in an order; the rows that have it tell their names.
    names = materialize(met.filter("own = lead").select(F.col("lead").alias("l"), F.col("node").alias("leader")).distinct(), "jaccard-names")
    count = met.filter("own != lead").groupBy("node", "lead").count()
    named = count.join(sized(names), F.col("lead") == F.col("l")).filter("node != leader")
    best = named.groupBy("node").agg(F.slice(F.sort_array(F.collect_list(F.struct("count", "leader")), asc=False), 1, OFFERS).alias("top"))
    pairs = best.select("node", F.explode("top.leader").alias("leader"))
    return pairs.select(F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b")).distinct()


class Entries:
    """Index entries of some documents, and their owners."""

    def __init__(self):
        self.heads, self.sig, self.own, self.loss, self.held, self.size = [], [], [], [], 0, 0

    def add(self, sets: list[np.ndarray], label: list, percent: int) -> None:
        names = np.array([int.from_bytes(node_name(s)[:8], "big") for s in sets], U)
        labels = np.array([names[i] if x is None else x & 0xFFFFFFFFFFFFFFFF for i, x in enumerate(label)], U)
        sig, who, loss, slack = index_entries(sets, percent)
        if not len(sig):
            return
        level = np.array([k for s in sets for k in ([x[2] for x in instances(len(s), percent)] if len(s) else [0, 0])])
        head = np.zeros(2 * len(sets), HEAD)
        turn = np.arange(2 * len(sets))
        head["id"], head["label"], head["slack"], head["turn"] = names[turn >> 1], labels[turn >> 1], slack, (turn & 1) | level << 1
        self.heads.append(head)
        self.sig.append(sig)
        self.own.append(who + self.held)
        self.loss.append(loss.astype(np.uint8))
        self.held += len(head)
        self.size += len(sig)

    def arrays(self, count: int):
        """Owners; for each entry its key (bucket and 32 bits of the hash), owner and loss, in the order of keys. Of equal
        sets, which are one node, one counts."""
        head, sig, own, loss = (np.concatenate(x) for x in (self.heads, self.sig, self.own, self.loss))
        first = np.zeros(len(head), bool)
        first[np.unique(np.stack([head["id"], head["turn"].astype(U)], 1), axis=0, return_index=True)[1]] = True
        keep = first[own]
        sig, own, loss = sig[keep], own[keep], loss[keep]
        key = (((sig >> U(32)) * U(count)) >> U(32)) << U(32) | (sig & U(0xFFFFFFFF))
        order = np.argsort(key, kind="stable")
        return head, key[order].view(np.int64), own[order], loss[order]


def _binary(data: np.ndarray, cut: np.ndarray) -> pa.Array:
    """Pieces of an array of records, as bytes."""
    offsets = (cut * data.dtype.itemsize).astype(np.int64)
    whole = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(cut) - 1, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data.tobytes())])
    return whole.cast(pa.binary())


def _sent(entries: Entries, count: int, number: int) -> pa.RecordBatch:
    """What a task sends: by bucket, owners, entries and marks. A group of hashes that is large already here does not go
    to its bucket but for a mark: if its labels differ, its members go along, to no particular task; if they don't, none
    does, until another label turns up."""
    head, key, own, loss = entries.arrays(count)
    start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    size, label = np.diff(start, append=len(key)), head["label"][own]
    low, high = np.minimum.reduceat(label, start), np.maximum.reduceat(label, start)
    large = size > MANY
    mark = np.zeros(int(large.sum()), MARK)
    mark["sig"], mark["label"], mark["differ"] = (key[start[large]] & 0xFFFFFFFF).astype(np.uint32), low[large], low[large] != high[large]
    mark_bucket = key[start[large]] >> 32
    gone, out = np.repeat(large, size), np.repeat(large & (low != high), size)
    member = np.zeros(int(out.sum()), MEMBER)
    for c in ("id", "label", "slack", "turn"):
        member[c] = head[c][own[out]]
    member["sig"], member["loss"] = key[out], loss[out]
    key, own, loss = key[~gone], own[~gone], loss[~gone]

    bucket, rank = np.unique(np.concatenate([key >> 32, mark_bucket]), return_inverse=True)
    rank, mark_rank = rank[: len(key)], rank[len(key) :]
    pair, back = np.unique(rank << 32 | own, return_inverse=True)
    cuts = lambda r: np.searchsorted(r, np.arange(len(bucket) + 1))
    head_cut = cuts(pair >> 32)
    body = np.zeros(len(key), BODY)
    body["sig"], body["at"] = (key & 0xFFFFFFFF).astype(np.uint32), (back - head_cut[rank]) << 2 | loss
    columns = [_binary(head[pair & 0xFFFFFFFF], head_cut), _binary(body, cuts(rank)), _binary(mark, cuts(mark_rank)), pa.array([b""] * len(bucket), pa.binary())]
    if len(member):  # below zero: no bucket of hashes
        columns = [pa.concat_arrays([c, pa.array([x], pa.binary())]) for c, x in zip(columns, (b"", b"", b"", member.tobytes()), strict=True)]
        bucket = np.append(bucket, -1 - number)
    return pa.RecordBatch.from_arrays([pa.array(bucket, pa.int64()), *columns], names=["bucket", "heads", "body", "marks", "members"])


def _indexed(batches, n: int, percent: int):
    """The entries of a task's documents, some at a time."""
    held = Entries()
    for b in batches:
        data, off, _ = text_buffers(b.column("t"))
        label, skip = b.column("label"), np.asarray(b.column("skip").fill_null(False))
        for lo, hi in _pieces(off):
            sets = shingle_sets(data[off[lo] : off[hi]], off[lo : hi + 1] - off[lo], n)
            held.add([s[:0] if skip[lo + i] else s for i, s in enumerate(sets)], label.slice(lo, hi - lo).to_pylist(), percent)
            if held.size >= FLUSH:
                yield held
                held = Entries()
        trim()
    if held.size:
        yield held


def _buckets(docs: DataFrame, text: str, n: int, percent: int, count: int) -> DataFrame:
    """The full index in compact form: rows of buckets, see _sent."""

    def run(batches):
        part = TaskContext.get().partitionId()
        for i, held in enumerate(_indexed(batches, n, percent)):
            yield _sent(held, count, part << 20 | i)

    importable(docs.sparkSession)
    return docs.select(F.col(text).alias("t"), "label", "skip").mapInArrow(run, "bucket long, heads binary, body binary, marks binary, members binary")


def _members(docs: DataFrame, text: str, n: int, percent: int, count: int) -> DataFrame:
    """All entries of the documents as rows of large groups' members."""

    def run(batches):
        for held in _indexed(batches, n, percent):
            head, key, own, loss = held.arrays(count)
            for lo in range(0, len(key), 100_000):
                at, k = own[lo : lo + 100_000], key[lo : lo + 100_000]
                columns = [head["id"][at].view(np.int64), head["label"][at].view(np.int64), head["turn"][at].astype(np.int64), head["slack"][at].astype(np.int64), k, loss[lo : lo + 100_000].astype(np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["a", "label", "ta", "sa", "sig", "n"])

    importable(docs.sparkSession)
    return docs.select(F.col(text).alias("t"), "label", "skip").mapInArrow(run, "a long, label long, ta long, sa long, sig long, n long")


def _rows(kind: int, **columns) -> pd.DataFrame:
    size = max(map(len, columns.values()))
    names = ("a", "b", "label", "ta", "tb", "sa", "sb", "sig", "n")
    given = {c: (v.view(np.int64) if v.dtype == U else v.astype(np.int64)) for c, v in columns.items()}
    return pd.DataFrame({"kind": np.full(size, kind, np.int32), **{c: given.get(c, np.zeros(size, np.int64)) for c in names}})


def _meet(pdf: pd.DataFrame) -> pd.DataFrame:
    """Pairs with different labels in a bucket's small groups; the members of its large groups with different labels; and
    the hashes of those of which members with one label are still to be told."""
    bucket, whole = int(pdf["bucket"].iloc[0]), lambda c, kind: np.frombuffer(b"".join(pdf[c]), kind)
    if bucket < 0:
        m = whole("members", MEMBER)
        return _rows(1, a=m["id"].copy(), label=m["label"].copy(), ta=m["turn"], sa=m["slack"], sig=m["sig"].copy(), n=m["loss"])
    head, body, mark = whole("heads", HEAD), whole("body", BODY), whole("marks", MARK)
    per = lambda c, kind: pdf[c].map(len).to_numpy() // np.dtype(kind).itemsize
    owners, base = per("heads", HEAD), np.zeros(len(pdf), np.int64)
    base[1:] = np.cumsum(owners)[:-1]
    every = body["sig"]
    place = (body["at"] + np.repeat(base << 2, per("body", BODY))).astype(np.uint32 if len(head) < 1 << 30 else np.int64)
    turn = head["turn"].astype(np.int64)
    name = lambda sig: np.int64(bucket) << 32 | sig.astype(np.int64)
    met, large, told = [np.zeros((0, 2), np.int64)], [np.zeros((0, 3), np.int64)], [np.zeros(0, np.int64)]
    for q in range(PASSES):  # a part of the hashes at a time: little memory beside the entries themselves
        part = np.flatnonzero(every // np.uint32((1 << 32) // PASSES) == q)
        part = part[np.argsort(every[part], kind="stable")]
        sig, at = every[part], place[part].astype(np.int64)
        owner = at >> 2
        # Marks by hash: least and greatest label, and whether labels differ in one of them.
        m = mark[mark["sig"] // np.uint32((1 << 32) // PASSES) == q]
        m = m[np.argsort(m["sig"], kind="stable")]
        m_start = np.flatnonzero(np.concatenate([[True], m["sig"][1:] != m["sig"][:-1]])[: len(m)])
        m_sig = m["sig"][m_start]
        m_low, m_high, m_differ = (f.reduceat(m[c], m_start) if len(m) else m[c] for f, c in ((np.minimum, "label"), (np.maximum, "label"), (np.maximum, "differ")))
        m_differ = (m_differ > 0) | (m_low != m_high)
        if len(part):
            start = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]]))
            size = np.diff(start, append=len(sig))
            label = head["label"][owner]
            low, high = np.minimum.reduceat(label, start), np.maximum.reduceat(label, start)
            at_mark = np.minimum(np.searchsorted(m_sig, sig[start]), max(len(m_sig) - 1, 0))
            marked = m_sig[at_mark] == sig[start] if len(m_sig) else np.zeros(len(start), bool)
            differ = low != high
            if marked.any():
                k = at_mark[marked]
                differ[marked] |= m_differ[k] | (np.minimum(low[marked], m_low[k]) != np.maximum(high[marked], m_high[k]))
                m_differ[k] |= differ[marked]
            for k in range(2, MANY + 1):
                runs = start[differ & ~marked & (size == k)]
                if len(runs):
                    i, j = np.triu_indices(k, 1)
                    a, b = owner[(runs[:, None] + i).ravel()], owner[(runs[:, None] + j).ravel()]
                    apart = head["label"][a] != head["label"][b]
                    a, b = a[apart], b[apart]
                    swap = head["id"][a] > head["id"][b]
                    met.append(np.stack([np.where(swap, b, a), np.where(swap, a, b)], 1))
            big = np.repeat(differ & (marked | (size > MANY)), size)
            large.append(np.stack([owner[big], name(sig[big]), at[big] & 3], 1))
        alike = m["differ"] == 0  # groups of one label whose members were not sent
        alike = np.isin(m_sig, m["sig"][alike])
        told.append(name(m_sig[alike & m_differ]))
    pair, times = np.unique(np.concatenate(met), axis=0, return_counts=True)
    a, b = pair[:, 0], pair[:, 1]
    large, told = np.concatenate(large), np.concatenate(told)
    own = large[:, 0]
    out = pd.concat([
        _rows(0, a=head["id"][a], b=head["id"][b], ta=turn[a], tb=turn[b], sa=head["slack"][a], sb=head["slack"][b], n=times * np.maximum(turn[a] >> 1, turn[b] >> 1)),
        _rows(1, a=head["id"][own], label=head["label"][own], ta=turn[own], sa=head["slack"][own], sig=large[:, 1], n=large[:, 2]),
        _rows(2, sig=told),
    ])
    trim()
    return out


#: Kind 0, a pair: nodes, turns, spare levels and how often they met. 1, a member of a large group: its label, group and
#: what it loses. 2, a large group some of whose members, of one label, were not sent.
MEET = "kind int, a long, b long, label long, ta long, tb long, sa long, sb long, sig long, n long"


def _met(rows: DataFrame, tasks: int) -> DataFrame:
    """What meets in the buckets. Buckets are dealt by number, not by hash: each task gets as many as any other."""
    names = ["kind", "a", "b", "label", "ta", "tb", "sa", "sb", "sig", "n"]
    kind = pa.schema([(c, pa.int32() if c == "kind" else pa.int64()) for c in names])

    def give(held):
        out = _meet(pd.concat(held, ignore_index=True))
        for lo in range(0, len(out), 100_000):
            yield pa.RecordBatch.from_pandas(out.iloc[lo : lo + 100_000], kind, preserve_index=False)

    def run(batches):
        held, last = [], None
        for b in batches:
            bucket = np.asarray(b.column("bucket"))
            cut = [*np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])[: len(bucket)]).tolist(), len(bucket)]
            for lo, hi in zip(cut, cut[1:], strict=False):
                if held and bucket[lo] != last:
                    yield from give(held)
                    held = []
                last = bucket[lo]
                held.append(b.slice(lo, hi - lo).to_pandas())
        if held:
            yield from give(held)

    dealt = rows.repartitionById(tasks, F.pmod("bucket", F.lit(tasks)).cast("int")).sortWithinPartitions("bucket")
    return dealt.mapInArrow(run, MEET)


def _link_blocks(n: int, percent: int):
    """For a pair of blocks: exact intersections of all their sets as a product of incidence matrices, and of the links
    between different labels a spanning forest. Pairs neither leave nor enter; a block has a fixed number of sets."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        nodes = pdf.drop_duplicates(["a"]).sort_values(["blk", "a"]).reset_index(drop=True)
        texts = [t.encode() for t in nodes["text"]]
        off = np.cumsum([0, *map(len, texts)])
        data = np.frombuffer(b"".join(texts), np.uint8)
        sets: list[np.ndarray] = []
        for lo, hi in _pieces(off):
            sets += shingle_sets(data[off[lo] : off[hi]], off[lo : hi + 1] - off[lo], n)
        size = np.array([len(x) for x in sets], np.int64)
        token, count = np.unique(np.concatenate(sets), return_inverse=False, return_counts=True)
        token = token[count > 1]  # what only one set has is in no intersection
        both = np.zeros((len(sets), len(sets)), np.float32)
        ranks = [np.searchsorted(token, x) for x in sets]
        ranks = [r[(r < len(token)) & (token[np.minimum(r, len(token) - 1)] == x)] if len(token) else r[:0] for r, x in zip(ranks, sets, strict=True)]
        for lo in range(0, len(token), 4096):
            m = np.zeros((len(sets), 4096), np.float32)
            for i, r in enumerate(ranks):
                m[i, r[np.searchsorted(r, lo) : np.searchsorted(r, lo + 4096)] - lo] = 1
            both += m @ m.T
        both = both.astype(np.int64)
        linked = (100 * both >= percent * (size[:, None] + size[None] - both)) & (both > 0)
        label, block, name = (nodes[c].to_numpy() for c in ("label", "blk", "a"))
        if len(set(block)) > 1:
            linked &= block[:, None] != block[None]
        same = label[:, None] == label[None]
        linked &= ~same
        left, out = set(range(len(sets))), []
        while left:
            todo = [left.pop()]
            while todo:
                i = todo.pop()
                for j in np.flatnonzero(linked[i] | same[i]).tolist():
                    if j in left:
                        left.discard(j)
                        todo.append(j)
                        if not same[i, j]:
                            out.append((min(name[i], name[j]), max(name[i], name[j])))
        trim()
        return pd.DataFrame(out, columns=["a", "b"]).astype("int64")

    return run


def _large_groups(left: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """Verified links (a, b) between sets that fall short, out of the large groups' members ``left``; enough of them for
    the components. ``texts``: k and text of those sets.

    Sets that meet in no large group, even by way of others, are in different families; a family is dealt into blocks, of
    one label where a label has many sets, and blocks that may hold different labels are compared with each other.
    """
    star = left.groupBy(F.col("sig").alias("g")).agg(F.min("a").alias("low"))
    star = materialize(star, "jaccard-stars")
    links = left.select("sig", "a").join(sized(star), F.col("sig") == F.col("g")).select(F.col("low").alias("a"), F.col("a").alias("b")).distinct()
    family = connected_components(links).select(F.col("node").alias("fn"), F.col("root").alias("fam"))
    member = left.select("a", "label").distinct().join(family, F.col("a") == F.col("fn"), "left")
    member = materialize(member.select("a", "label", F.coalesce("fam", "a").alias("fam")), "jaccard-member")
    many = member.groupBy("fam", "label").count().withColumn("own", F.col("count") >= BLOCK)
    pool = many.filter("not own").groupBy(F.col("fam").alias("pf")).agg(F.sum("count").alias("pool"))
    many = many.join(pool, F.col("fam") == F.col("pf"), "left").select(F.col("fam").alias("mf"), F.col("label").alias("ml"), "own", F.when(F.col("own"), F.col("count")).otherwise(F.col("pool")).alias("total"))
    many = materialize(many, "jaccard-labels")
    dealt = F.pmod(F.xxhash64("a"), F.ceil(F.col("total") / BLOCK))
    member = member.join(sized(many), (F.col("fam") == F.col("mf")) & (F.col("label") == F.col("ml")))
    pure = F.when(F.col("own"), F.col("label"))
    member = member.select("a", "fam", pure.alias("pure"), F.xxhash64("fam", F.coalesce(pure, F.lit(0)), "own", dealt).alias("blk"))
    member = materialize(member, "jaccard-dealt")
    blocks = member.select("fam", "blk", "pure").distinct()
    other = blocks.select(F.col("fam").alias("f2"), F.col("blk").alias("k2"), F.col("pure").alias("p2"))
    wanted = blocks.join(other, (F.col("fam") == F.col("f2")) & (F.col("blk") <= F.col("k2")) & ~F.coalesce(F.col("pure") == F.col("p2"), F.lit(False)))
    wanted = materialize(wanted.select(F.col("blk").alias("b1"), F.col("k2").alias("b2")), "jaccard-blocks")
    owner = member.select(F.col("a").alias("ma"), "blk", "fam")
    ends = wanted.union(wanted.filter("b1 != b2").select("b2", "b1")).select(F.col("b1").alias("mine"), F.least("b1", "b2").alias("b1"), F.greatest("b1", "b2").alias("b2"))
    ends = materialize(ends, "jaccard-ends")
    rows = left.select("a", "label").distinct().join(sized(owner), F.col("a") == F.col("ma")).join(sized(ends), F.col("blk") == F.col("mine"))
    rows = rows.select("b1", "b2", "a", "label", "blk").join(texts.hint("merge"), F.col("a") == F.col("k")).select("b1", "b2", "a", "label", "blk", "text")
    importable(left.sparkSession)
    tasks = max(int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-wanted.count() // 16))
    return rows.repartition(tasks, "b1", "b2").groupBy("b1", "b2").applyInPandas(_link_blocks(n, percent), "a long, b long").distinct()


def jaccard_classes(docs: DataFrame, id: str = "doc_id", text: str = "text", n: int = 5, percent: int = 75) -> DataFrame:
    """One row per input row: id, n_shingles, component_id (the smallest id that links reach)."""
    return settle(lambda: _classes(docs, id, text, n, percent), "jaccard-classes").select(id, "n_shingles", "component_id")


def _text_hash(text: str):
    return F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit("")))


def _classes(docs: DataFrame, id: str, text: str, n: int, percent: int) -> DataFrame:
    rows = materialize(describe(docs.select(F.col(f"`{id}`").alias("__id"), F.col(f"`{text}`").alias("__t"), _text_hash(text).alias("__th")), "__id", "__t", n, percent), "jaccard-rows")
    real = rows.filter(F.length("node") > 0)
    # A node's row: the smallest id that isn't null, and the text that this row has.
    row = F.min(F.struct(F.col("__id").isNull().alias("none"), F.col("__id").alias("rep"), F.col("__th").alias("th"))).alias("row")
    nodes = real.groupBy("node").agg(row, F.first("first").alias("first"), F.max("n_shingles").alias("n"))
    nodes = materialize(nodes.select("node", "row.rep", "row.th", "first", "n"), "jaccard-nodes")
    repeated = rows.groupBy("__id", "__th").count().filter("count > 1").limit(1).count() > 0
    offered = materialize(_first_round(nodes), "jaccard-offered")
    asked = offered.select(F.col("a").alias("node")).union(offered.select(F.col("b").alias("node"))).distinct()
    asked = materialize(nodes.join(sized(materialize(asked, "jaccard-asked")), "node").select("node", "rep", "th"), "jaccard-asked")
    texts = materialize(_texts(docs, asked, id, text, n, repeated), "jaccard-texts")
    links = materialize(verify(offered, texts, n, percent), "jaccard-links")
    release(texts)
    found = connected_components(links)

    # Labels for the full index: of rows in a component, and rows that repeat a node that another row stands for.
    name = lambda c: F.conv(F.hex(F.substring(c, 1, 8)), 16, -10).cast("long")
    comp = found.select(F.col("node").alias("__n"), "root")
    known = real.select("__id", "node").join(sized(nodes.select(F.col("node").alias("__m"), "rep")), F.col("node") == F.col("__m"))
    known = known.join(sized(comp), F.col("node") == F.col("__n"), "left")
    known = known.select("__id", name("root").alias("label"), (F.col("__id") != F.col("rep")).alias("skip"), "node")
    marks = known.groupBy("__id").agg(F.min("label").alias("label"), F.min("skip").alias("skip"), F.min("node").alias("lo"), F.max("node").alias("hi"))
    # An id with several texts gets no mark: its rows go through the index unlabelled.
    marks = materialize(marks.filter("lo = hi and __id is not null and (label is not null or skip)").select("__id", "label", "skip"), "jaccard-marks")
    entries = (nodes.agg(F.sum("n")).first()[0] or 0) * 0.9
    count = max(8, math.ceil(entries / BUCKET_ENTRIES))
    marked = docs.select(F.col(id).alias("__d"), text).join(sized(marks), F.col("__d") == F.col("__id"), "left")
    # As many tasks as buckets, whatever the session's number is: a task's share does not grow with the corpus.
    tasks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), count)
    met = _met(_buckets(marked, text, n, percent, count), tasks)
    met = materialize(met, "jaccard-met")
    large = met.filter("kind = 1").select("sig", "a", "label", "ta", "sa", "n")
    told = materialize(met.filter("kind = 2").select(F.col("sig").alias("again")).distinct(), "jaccard-told")
    if told.limit(1).count():
        labelled = _members(marked.filter("label is not null"), text, n, percent, count)
        more = labelled.join(sized(told), F.col("sig") == F.col("again"), "left_semi").select("sig", "a", "label", "ta", "sa", "n")
        large = materialize(large.unionByName(more).dropDuplicates(["sig", "a", "ta"]), "jaccard-large")
    lost = large.groupBy("a", "ta").agg(F.sum("n").alias("lost"), F.min("sa").alias("spare"))
    lost = materialize(lost.select(F.col("a").alias("l_id"), F.col("ta").alias("l_turn"), "lost", (F.col("spare") <= F.col("lost")).alias("short")), "jaccard-lost")
    short = materialize(lost.filter("short").select(F.col("l_id").alias("s_id"), F.col("l_turn").alias("s_turn")), "jaccard-short")
    left = large.join(sized(short), (F.col("a") == F.col("s_id")) & (F.col("ta") == F.col("s_turn")), "left_semi").select("sig", "a", "label", "ta", "sa")
    mixed = left.groupBy("sig").agg(F.min("label").alias("x"), F.max("label").alias("y")).filter("x != y").select(F.col("sig").alias("ms"))
    left = materialize(left.join(sized(materialize(mixed, "jaccard-mixed")), F.col("sig") == F.col("ms"), "left_semi"), "jaccard-left")
    # Small groups' ids compare as unsigned numbers, everything from here on as signed ones.
    small = met.filter("kind = 0").select("a", "b", "ta", "tb", "sa", "sb", "n")
    turned = F.col("a") > F.col("b")
    pick = lambda x, y, name: F.when(turned, F.col(y)).otherwise(F.col(x)).alias(name)
    small = small.select(*[pick(x, y, x) for x, y in (("a", "b"), ("b", "a"), ("ta", "tb"), ("tb", "ta"), ("sa", "sb"), ("sb", "sa"))], "n")
    often = small.groupBy("a", "b", "ta", "tb").agg(F.sum("n").alias("n"), F.max("sa").alias("sa"), F.max("sb").alias("sb"))
    side = lambda x: sized(lost.select(F.col("l_id").alias(f"{x}i"), F.col("l_turn").alias(f"{x}t"), F.col("lost").alias(f"{x}l"), F.col("short").alias(f"{x}s")))
    often = often.join(side("x"), (F.col("a") == F.col("xi")) & (F.col("ta") == F.col("xt")), "left").join(side("y"), (F.col("b") == F.col("yi")) & (F.col("tb") == F.col("yt")), "left")
    # Two sets that both fall short and share a large group are compared there; for others nothing is missing.
    whole = F.coalesce("xs", F.lit(False)) & F.coalesce("ys", F.lit(False))
    gone = lambda c: F.when(whole, 0).otherwise(F.coalesce(c, F.lit(0)))
    enough = (F.col("n") >= F.col("sa") - gone("xl")) & (F.col("n") >= F.col("sb") - gone("yl"))
    pairs = materialize(often.filter(enough).select("a", "b").distinct(), "jaccard-pairs")
    ends = pairs.select(F.col("a").alias("e")).union(pairs.select(F.col("b").alias("e"))).distinct()
    ends = materialize(ends, "jaccard-ends")
    by_name = nodes.select("node", "rep", "th", name("node").alias("k"))
    wanted = materialize(by_name.join(sized(ends), F.col("k") == F.col("e")).select("node", "rep", "th", "k"), "jaccard-wanted")
    one, two = wanted.select(F.col("node").alias("na"), F.col("k").alias("ka")), wanted.select(F.col("node").alias("nb"), F.col("k").alias("kb"))
    full = pairs.join(sized(one), F.col("a") == F.col("ka")).join(sized(two), F.col("b") == F.col("kb")).select(F.col("na").alias("a"), F.col("nb").alias("b"))
    texts = materialize(_texts(docs, wanted, id, text, n, repeated), "jaccard-texts")
    more = materialize(verify(full, texts, n, percent), "jaccard-links")
    release(texts)
    few = left.select(F.col("a").alias("e")).distinct()
    wanted = materialize(by_name.join(sized(materialize(few, "jaccard-few")), F.col("k") == F.col("e")).select("node", "rep", "th", "k"), "jaccard-wanted")
    texts = _texts(docs, wanted, id, text, n, repeated).withColumn("k", name("node")).select("k", "text")
    cross = materialize(_large_groups(left, materialize(texts, "jaccard-texts"), n, percent), "jaccard-cross")
    one, two = wanted.select(F.col("node").alias("na"), F.col("k").alias("ka")), wanted.select(F.col("node").alias("nb"), F.col("k").alias("kb"))
    cross = cross.join(sized(one), F.col("a") == F.col("ka")).join(sized(two), F.col("b") == F.col("kb")).select(F.col("na").alias("a"), F.col("nb").alias("b"))
    release(met)
    final = connected_components(links.union(more).union(cross))
    final = final.select(F.col("node").alias("__f"), "root")
    owner = nodes.select("node", "rep").join(sized(final), F.col("node") == F.col("__f"))
    low = owner.groupBy("root").agg(F.min("rep").alias("component"))
    low = materialize(low.withColumnRenamed("root", "__r"), "jaccard-low")
    member = materialize(final.join(sized(low), F.col("root") == F.col("__r")).select("__f", "component"), "jaccard-member")
    alone = nodes.select(F.col("node").alias("__m"), "rep")
    out = rows.select("__id", "__th", "n_shingles", "node").join(sized(alone), F.col("node") == F.col("__m"), "left")
    out = out.join(sized(member), F.col("node") == F.col("__f"), "left")
    return out.select(F.col("__id").alias(id), "n_shingles", F.coalesce("component", "rep", "__id").alias("component_id"), "__th")


def keep_one_per_class(docs: DataFrame, id: str = "doc_id", text: str = "text", n: int = 5, percent: int = 75) -> DataFrame:
    """The rows of ``docs``, as they are, less those that link, directly or not, to a row with a smaller id.

    It is the text that links: of rows that share an id those go whose own text does. Rows with a null id stay.
    """
    classes = settle(lambda: _classes(docs.select(id, text), id, text, n, percent), "jaccard-classes")
    gone = classes.filter(F.col(id) > F.col("component_id")).select(F.col(id).alias("__gone"), "__th").distinct()
    gone = materialize(gone, "jaccard-gone")
    return docs.join(sized(gone), (F.col(f"`{id}`") == F.col("__gone")) & (_text_hash(text) == F.col("__th")), "left_anti")
