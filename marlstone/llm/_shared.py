"""Helpers shared by the corpus operators: durable intermediate tables, size-checked joins, byte-level words."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes (on disk, compressed) a broadcast side may have.
BROADCAST_ROWS, BROADCAST_BYTES = 500_000, 32 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir. Where that is unset and all executors run on the driver's own
    machine (tests), a temporary one; a cluster without a shared folder is an error."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        at = "file://" + tempfile.mkdtemp(prefix="marlstone-")
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


#: Tables written inside each ``settle`` that is under way.
_open: list[list[str]] = []


def note(df: DataFrame, path: str) -> DataFrame:
    """Remember where a frame's files are, so that they can be deleted."""
    df._marlstone_path = path
    if _open:
        _open[-1].append(path)
    return df


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and return a frame that reads it: lineage ends here, lost executors don't matter."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/marlstone/{name}-{uuid.uuid4().hex}"
    trim()
    df.write.parquet(path)
    return note(spark.read.schema(df.schema).parquet(path), path)


def settle(make: Callable[[], DataFrame], name: str) -> DataFrame:
    """What ``make`` gives, written; the tables that were written on the way are deleted."""
    _open.append([])
    try:
        out = materialize(make(), name)
    finally:
        written = _open.pop()
    for path in written:
        if path != out._marlstone_path:
            _delete(out.sparkSession, path)
    return note(out, out._marlstone_path)


def _delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def release(df: DataFrame) -> None:
    """Delete a materialized frame's files once nothing will read them again."""
    path = getattr(df, "_marlstone_path", None)
    if path:
        _delete(df.sparkSession, path)


def clear(spark: SparkSession) -> None:
    """Delete all written intermediate tables: once the results that read them are written themselves."""
    _delete(spark, f"{shared_dir(spark)}/marlstone")


def sized(df: DataFrame, rows: int | None = None, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast a narrow written frame if its rows and its files are within bounds; beyond that the join shuffles.

    ``rows`` is for frames of known small rows, whose number alone counts.
    """
    n = df.count() if rows is None else rows
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) if rows is None else 0
    return F.broadcast(df) if n <= limit and size <= BROADCAST_BYTES else df.hint("merge")


# ---- bytes, words and hashes (numpy) ---------------------------------------------------------------------------

#: Bytes of text handled at once in a Python worker; one longer document forms a slice of its own.
SLICE_BYTES = 1 << 20
#: Words are [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing A-Z: digits, letters, everything beyond ASCII.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[97:123] = ALNUM[128:] = True
#: Words are [^\x20\x09-\x0D]+: everything but white space.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[32, 9, 10, 11, 12, 13]] = False

_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_R = np.uint64(0x9E3779B97F4A7C15)
_RINV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_pow = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_pow["up"]) < n:
        m = max(n, SLICE_BYTES + 1)
        for k, r in (("up", _R), ("down", _RINV)):
            a = np.full(m, r, np.uint64)
            a[0] = 1
            _pow[k] = np.multiply.accumulate(a)
    return _pow["up"][:n], _pow["down"][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (xor-shift and multiply)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, n + 1 offsets and the null mask of a string column, without making Python strings."""
    n = len(column)
    nulls = np.asarray(column.is_null()) if column.null_count else np.zeros(n, bool)
    column = column.cast(pa.large_string()) if column.type != pa.large_string() else column
    column = column.fill_null("") if column.null_count else column
    off = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[off[0] : off[-1]] if n else data[:0], (off - off[0]) if n else np.zeros(1, np.int64), nulls


def slices(off: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of documents that hold about ``most`` bytes each."""
    lo, n = 0, len(off) - 1
    while lo < n:
        hi = int(np.searchsorted(off, off[lo] + most, "right")) - 1
        hi = min(n, max(hi, lo + 1))
        yield lo, hi
        lo = hi


def words(data: np.ndarray, off: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes, start and end of each word, and offsets of each document's words (n + 1)."""
    low = LOWER[data]
    mask = is_word[low]
    edge = np.flatnonzero(mask[1:] != mask[:-1]) + 1 if len(mask) else np.zeros(0, np.int64)
    cuts = off[1:-1]
    inner = cuts[(cuts > 0) & (cuts < len(mask))]
    inner = np.unique(inner[mask[inner] & mask[inner - 1]]) if len(inner) else inner
    first = [0] if len(mask) and mask[0] else []
    last = [len(mask)] if len(mask) and mask[-1] else []
    starts = np.concatenate([first, edge[mask[edge]], inner]).astype(np.int64)
    ends = np.concatenate([edge[~mask[edge]], last, inner]).astype(np.int64)
    if len(inner):
        starts.sort()
        ends.sort()
    return low, starts, ends, np.searchsorted(starts, off)


def word_hashes(low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes, from prefix sums."""
    up, down = _powers(len(low) + 1)
    total = np.zeros(len(low) + 1, np.uint64)
    np.cumsum(_BYTE[low] * up[: len(low)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def gram_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of each run of ``n`` consecutive word hashes (runs may cross documents: the caller masks)."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    m = len(h) - n + 1
    out = h[:m].copy()
    for j in range(1, n):
        out *= _R
        out += h[j : j + m]
    return mix(out + np.uint64(n))


def crc_mod(column: str, n: int):
    """crc32 of a column's text, modulo n (null ids count as the empty text)."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % n


#: Rows of a batch handled and given back at once.
PIECE_ROWS = 1024

# ---- Arrow batches ----------------------------------------------------------------------------------------------


def trim() -> None:
    """Give freed memory back to the system: workers live on, and share their executor's limit with the JVM."""
    import ctypes

    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):
        ctypes.CDLL(None).malloc_trim(0)


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it, and get Arrow batches of a few MB: unless the
    session has a size of its own, batches of up to 64 MB would be held several times over."""
    import os

    size = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(size, None) in (None, "67108864b", "64MB"):
        spark.conf.set(size, "4m")

    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(":"):
        env["PYTHONPATH"] = ":".join(filter(None, [env.get("PYTHONPATH"), root]))


def annotate(docs: DataFrame, fn, added: str, inputs: list[str], carry: list[str] | None = None) -> DataFrame:
    """``carry`` columns (all, unless named) and the columns of the DDL text ``added``, which ``fn`` makes for each Arrow
    batch from the columns ``inputs``: a function from a list of arrays to a list of arrays. No shuffle. A carried column
    whose name is among the added ones is replaced."""
    from pyspark.sql.types import StructField, StructType

    importable(docs.sparkSession)
    new = StructType.fromDDL(added)
    taken = {f.name.lower() for f in new}
    carry = [c for c in (docs.columns if carry is None else carry) if c.lower() not in taken]
    names = list(dict.fromkeys([*carry, *inputs]))
    kinds = {c: docs.schema[c].dataType for c in names}
    packed = docs.select(F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)]).alias("d"))
    back = StructType([StructField(f"c{i}", kinds[c]) for i, c in enumerate(names) if c in carry])
    schema = StructType(([StructField("d", back)] if carry else []) + list(new))
    at, keep = [names.index(c) for c in inputs], [i for i, c in enumerate(names) if c in carry]
    labels = [f.name for f in schema]

    def run(batches):
        for whole in batches:
            for lo in range(0, whole.num_rows, PIECE_ROWS):  # what is made of a few rows may be large
                d = whole.slice(lo, PIECE_ROWS).column(0)
                out = fn([d.field(i) for i in at])
                if keep:
                    out = [pa.StructArray.from_arrays([d.field(i) for i in keep], names=[f"c{i}" for i in keep]), *out]
                yield pa.RecordBatch.from_arrays(out, names=labels)
            trim()

    out = packed.mapInArrow(run, schema)
    return out.select(*[F.col(f"d.c{i}").alias(names[i]) for i in keep], *[F.col(f.name) for f in new])
