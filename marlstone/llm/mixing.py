"""Mixing sources to target weights by Pfair scheduling, with DataFrame functions only.

Every source's documents are cut into blocks. The ideal mix, which knows no blocks, serves all sources at once, at rates in
the proportion of their target weights; when one is used up, the others go on, faster in the same proportion. A block is
released in the slot in which the ideal mix begins it and due by the end of the slot in which the ideal mix ends it; in
every slot the released block with the earliest deadline goes out. The ideal mix serves one block a slot in all, so there
is a schedule that keeps all windows, and this one does: after every slot each source is less than one block away from its
share, to the end of the mix. Windows are worked out in whole numbers from the exact weights, without rounding.

The driver gets one row for each source (its size) and works out the schedule: some three millionths of a second a block,
a few kilobytes a source at once. It writes the slots in pieces of ``PIECE`` blocks to a table, some eight bytes a block,
which documents join by source and piece. ``block_docs`` sets the number of blocks: a corpus of billions of documents wants larger
blocks than 16.

Documents are numbered inside their source by (hash bucket, hash), the hash being of the id and all other columns: buckets
split a source of any size over many tasks, also one whose ids are all null or the same. Where a bucket is overfull, equal
rows are the cause; they are first counted by partial aggregates, numbered as one, and dealt out again. The offsets
come from the counts of the buckets, of which a source has 2^20 at most.

Defined results: every row gets exactly one place; a null source is a source of its own; null ids are an id like any other;
equal rows take neighbouring places; an empty table gives an empty result; texts of any length pass through unread but for
the hash; input columns named mix_slot, mix_offset or mix_position are replaced, all others pass through, whatever their
names.
"""

from __future__ import annotations

import heapq
import json
import uuid
from array import array
from collections.abc import Iterator
from fractions import Fraction
from itertools import chain
from math import gcd, lcm

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ._shared import materialize, note, shared_dir, sized

#: Blocks in a row of the table of slots; slots that the driver holds before it writes them; slots that are broadcast.
PIECE, WRITE, BROADCAST_SLOTS = 1024, 1 << 18, 1 << 22
#: Equal rows that one task deals out at a time.
DEAL = 1 << 16
SLOTS = "ps string, piece long, slots array<long>"
ADDED = ("mix_slot", "mix_offset", "mix_position")


def exact_weights(weights: dict) -> dict:
    """Positive weights as the smallest integers in exactly their ratios."""
    exact = {k: Fraction(w) for k, w in weights.items()}
    if any(w <= 0 for w in exact.values()):
        raise ValueError("weights must be positive")
    scale = lcm(*(w.denominator for w in exact.values()))
    whole = {k: int(w * scale) for k, w in exact.items()}
    common = gcd(*whole.values())
    return {k: w // common for k, w in whole.items()}


class Ideal:
    """The mix without blocks. At virtual time v a source has given min(weight * v, size) blocks; all of them together
    have given as many as slots have passed."""

    def __init__(self, blocks: dict, weights: dict):
        exact = exact_weights({k: weights[k] for k, n in blocks.items() if n > 0})
        self.names = sorted(exact, key=lambda k: (k is None, str(k)))
        self.w, self.n = [exact[k] for k in self.names], [blocks[k] for k in self.names]
        order = sorted(range(len(self.names)), key=lambda j: Fraction(self.n[j], self.w[j]))
        self.end_n, self.end_w = [self.n[j] for j in order], [self.w[j] for j in order]
        #: By the number of sources that are used up: their blocks, and the weight of the others.
        self.given, self.rate = [0], [sum(self.w)]
        for n, w in zip(self.end_n, self.end_w, strict=True):
            self.given.append(self.given[-1] + n)
            self.rate.append(self.rate[-1] - w)

    def used_up(self, least: int, i: int, w: int) -> int:
        """How many sources are used up at virtual time i / w; ``least`` is known to be."""
        if least == len(self.end_n) or self.end_n[least] * w > i * self.end_w[least]:
            return least
        lo, hi = least + 1, len(self.end_n)
        while lo < hi:
            mid = (lo + hi) // 2
            if self.end_n[mid] * w <= i * self.end_w[mid]:
                lo = mid + 1
            else:
                hi = mid
        return lo

    def slots(self, s: int, i: int, w: int) -> tuple[int, int]:
        """Slots that have passed at virtual time i / w, as a fraction, when ``s`` sources are used up."""
        return self.given[s] * w + i * self.rate[s], w


def pfair(ideal: Ideal) -> Iterator[int]:
    """The source of every slot: earliest deadline first among released blocks."""
    waiting: list[tuple[int, int, int]] = []
    ready: list[tuple[int, int]] = []
    done, used = [0] * len(ideal.names), [0] * len(ideal.names)

    def window(j: int) -> tuple[int, int]:
        """Release and deadline of a source's next block."""
        i, w = done[j], ideal.w[j]
        begin, unit = ideal.slots(used[j], i, w)
        used[j] = ideal.used_up(used[j], i + 1, w)
        end, _ = ideal.slots(used[j], i + 1, w)
        return begin // unit, -(-end // unit)

    for j in range(len(ideal.names)):
        heapq.heappush(ready, (window(j)[1], j))
    for t in range(ideal.given[-1]):
        while waiting and waiting[0][0] <= t:
            _, due, j = heapq.heappop(waiting)
            heapq.heappush(ready, (due, j))
        _, j = heapq.heappop(ready)
        yield j
        done[j] += 1
        if done[j] < ideal.n[j]:
            release, due = window(j)
            heapq.heappush(waiting, (release, due, j))


def pieces(ideal: Ideal) -> Iterator[tuple]:
    """(source, piece, slots): the slots of up to PIECE consecutive blocks of a source."""
    open_, number = [array("q") for _ in ideal.names], [0] * len(ideal.names)
    for t, j in enumerate(pfair(ideal)):
        open_[j].append(t)
        if len(open_[j]) == PIECE:
            yield ideal.names[j], number[j], open_[j].tolist()
            open_[j], number[j] = array("q"), number[j] + 1
    for j, left in enumerate(open_):
        if left:
            yield ideal.names[j], number[j], left.tolist()


def _schedule(spark: SparkSession, blocks: dict, weights: dict) -> DataFrame:
    """The table of slots: lines of JSON that the driver writes to the shared folder, a bounded part at a time."""
    path, lines, held, files = f"{shared_dir(spark)}/marlstone/mix-slots-{uuid.uuid4().hex}", [], 0, 0
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(folder)
    for row in chain(pieces(Ideal(blocks, weights)), [None]):
        if row:
            lines.append(json.dumps(dict(zip(("ps", "piece", "slots"), row, strict=True)), separators=(",", ":")))
            held += len(row[2])
        if lines and (held >= WRITE or not row):
            out = fs.create(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{files:06d}.json"), True)
            out.write(bytearray("\n".join(lines).encode()))
            out.close()
            lines, held, files = [], 0, files + 1
    return note(spark.read.schema(SLOTS).json(path), path)


def _dealt(rows: DataFrame) -> DataFrame:
    """A row for each of the ``__copies`` of a row, numbered from __n on, a bounded number in one task."""
    last = F.col("__n") + F.col("__copies") - 1
    parts = rows.withColumn("__n", F.col("__n").cast("long")).filter("__copies > 1").withColumn("__last", last).withColumn("__n", F.explode(F.sequence("__n", last, F.lit(DEAL).cast("long"))))
    return parts.repartition("__h", "__n").withColumn("__n", F.explode(F.sequence("__n", F.least("__last", F.col("__n") + DEAL - 1)))).drop("__copies", "__last")


def mix_sources(
    docs: DataFrame, weights: dict | None = None, block_docs: int = 16, id: str = "doc_id", source: str = "source",
    alpha: float = 0.5, seed: int = 7, bucket_rows: int = 500,
) -> DataFrame:
    """All rows of ``docs`` with mix_slot, mix_offset and mix_position, the place in the mixed order.

    ``weights`` maps sources, as text, to positive target weights (sources that it lacks get the smallest of them); without
    it a source's weight is its number of documents to the power ``alpha``. ``block_docs`` documents fill a block;
    mix_position = mix_slot * block_docs + mix_offset grows along the mix and is unique.
    """
    spark = docs.sparkSession
    s = F.col(f"`{source}`").cast("string")
    sizes = {r["s"]: r["count"] for r in docs.groupBy(s.alias("s")).count().collect()}  # a row for each source
    if weights:
        weights = {k: weights.get(k, min(weights.values())) for k in sizes}
    else:
        weights = {k: n**alpha for k, n in sizes.items()}
    blocks = {k: -(-n // block_docs) for k, n in sizes.items()}
    slots = _schedule(spark, blocks, weights)

    buckets = min(1 << 20, max(8, -(-max(sizes.values(), default=1) // bucket_rows)))
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}
    # Maps and variants have no hash of their own.
    hashed = [F.to_json(F.struct(F.col(f"`{c}`"))) if "map<" in kind or "variant" in kind else F.col(f"`{c}`") for c, kind in kinds.items()]
    struct = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__doc")
    rows = docs.select(struct, s.alias("__s"), F.xxhash64(F.lit(seed), F.col(f"`{id}`").cast("string"), *hashed).alias("__h"))
    rows = rows.withColumn("__b", F.pmod(F.shiftright("__h", 7), F.lit(buckets)))
    per = rows.groupBy("__s", "__b").count()
    before = Window.partitionBy("__s").orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per.select(F.col("__s").alias("__os"), F.col("__b").alias("__ob"), "count", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__before"))
    offsets = materialize(offsets, "mix-offsets")

    inside = Window.partitionBy("__s", "__b").orderBy("__h")
    here = lambda x, y: F.col("__s").eqNullSafe(F.col(x)) & (F.col("__b") == F.col(y))
    over = materialize(offsets.filter(F.col("count") > 8 * bucket_rows).select(F.col("__os").alias("__fs"), F.col("__ob").alias("__fb")), "mix-overfull")
    if over.limit(1).count():
        # Rows that share a hash are equal and interchangeable: they are counted, numbered as one, and dealt out again.
        heavy = rows.select("__s", "__b", "__h").join(sized(over), here("__fs", "__fb"), "left_semi").groupBy("__s", "__h").count().filter(F.col("count") > bucket_rows)
        heavy = sized(materialize(heavy.select(F.col("__s").alias("__hs"), F.col("__h").alias("__hh")), "mix-heavy"))
        same = F.col("__s").eqNullSafe(F.col("__hs")) & (F.col("__h") == F.col("__hh"))
        many = rows.join(heavy, same, "left_semi").groupBy("__s", "__b", "__h").agg(F.first("__doc").alias("__doc"), F.count("*").alias("__copies"))
        rows = rows.join(heavy, same, "left_anti").withColumn("__copies", F.lit(1).cast("long")).unionByName(many)
        rows = rows.withColumn("__n", F.sum("__copies").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("__copies"))
        ranked = rows.filter("__copies = 1").drop("__copies").unionByName(_dealt(rows))
    else:
        ranked = rows.withColumn("__n", F.row_number().over(inside) - 1)
    placed = ranked.join(sized(offsets.drop("count")), here("__os", "__ob")).withColumn("__k", F.col("__before") + F.col("__n"))
    block = F.floor(F.col("__k") / block_docs).cast("long")
    on = F.col("__s").eqNullSafe(F.col("ps")) & (F.floor(block / PIECE).cast("long") == F.col("piece"))
    out = placed.join(F.broadcast(slots) if sum(blocks.values()) <= BROADCAST_SLOTS else slots.hint("merge"), on)
    slot, offset = F.get("slots", (block % PIECE).cast("int")), F.col("__k") % block_docs
    kept = [F.col(f"__doc.`{c}`") for c in docs.columns if c.lower() not in ADDED]
    return out.select(*kept, slot.alias("mix_slot"), offset.cast("long").alias("mix_offset"), (slot * block_docs + offset).cast("long").alias("mix_position"))
