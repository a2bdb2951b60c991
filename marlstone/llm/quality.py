"""Quality classifier: a byte-level convolutional network in numpy.

Bytes get learned vectors; learned filters of 8 bytes move over the text 4 bytes at a time; each filter's greatest answer
is taken in every chunk of 512 bytes, chunks overlapping by half and covering the whole document (the last is padded with
zero bytes). A dense layer turns a chunk's maxima into features, and their mean and maximum over all chunks give one
probability. Training runs on the driver over a bounded sample of labelled rows, whole texts, the same number of each
label where there are enough.

Defined results: null and empty texts are one chunk of padding and get a score as any other text; a text of any length is
read whole; equal texts get equal scores; without labels of both kinds (an empty table of labels too) every score is 1 (one
kind of label 0: 0); labels of a document that contradict each other count as 0, labels without an id or a mark not at all;
of rows that share a labelled id the one with the smallest text hash is learned from; an empty table of documents gives an
empty result; input columns named score or predicted are replaced, all others pass through (filtering keeps all as they are).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import annotate, slices, text_buffers, trim

WIDTH, STRIDE, BLOCK = 8, 4, 64  # bytes of a filter, bytes of a step, steps of half a chunk
BYTES = BLOCK * STRIDE


def layout(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes with every document padded to whole half chunks (one at least), and the half chunks of each document."""
    size = np.diff(off)
    blocks = np.maximum(1, -(-size // BYTES))
    start = np.concatenate([[0], np.cumsum(blocks)[:-1]]) * BYTES
    out = np.zeros(int(blocks.sum()) * BYTES + STRIDE, np.uint8)
    out[np.arange(len(data)) + np.repeat(start - off[:-1], size)] = data
    return out, blocks


class Cnn:
    """Weights of the network; ``forward`` keeps what ``backward`` needs."""

    def __init__(self, dims: int = 6, filters: int = 64, hidden: int = 24, seed: int = 11):
        r = np.random.default_rng(seed)
        n = lambda *shape, scale: (r.standard_normal(shape) * scale).astype(np.float32)
        self.w = {
            "e": n(256, dims, scale=0.5), "f": n(WIDTH * dims, filters, scale=(1 / (WIDTH * dims)) ** 0.5), "fb": np.zeros(filters, np.float32),
            "h": n(filters + 1, hidden, scale=(2 / filters) ** 0.5), "hb": np.zeros(hidden, np.float32), "o": n(2 * hidden, scale=0.2), "ob": np.zeros(1, np.float32),
        }

    def forward(self, data: np.ndarray, off: np.ndarray, keep: bool = False):
        w, (b, blocks) = self.w, layout(data, off)
        dims = w["e"].shape[1]
        quad = w["e"][b].reshape(-1, STRIDE * dims)
        half = len(w["f"]) // 2
        z = quad[:-1] @ w["f"][:half] + quad[1:] @ w["f"][half:]
        z = z.reshape(-1, BLOCK, z.shape[1])
        ends = np.cumsum(blocks)
        z[ends - 1, -1] = -1e30  # half of this filter would lie in the next document
        top = z.max(1)
        first = ends - blocks
        # Chunk i joins half chunks i and i + 1 of a document; a document of one half chunk is one chunk.
        left = np.delete(np.arange(len(top)), (ends - 1)[blocks > 1])
        last = np.zeros(len(top), bool)
        last[ends - 1] = True
        right = np.where(last[left], left, left + 1)
        m = np.maximum(top[left], top[right])
        number = left - np.repeat(first, np.maximum(1, blocks - 1))
        room = np.repeat(np.diff(off), np.maximum(1, blocks - 1)) - number * BYTES
        full = np.minimum(1, room / (2 * BYTES)).astype(np.float32)  # share of the chunk that is text
        x = np.concatenate([np.maximum(m + w["fb"], 0), full[:, None]], 1)
        h = np.maximum(x @ w["h"] + w["hb"], 0)
        chunks = np.maximum(1, blocks - 1)
        start = np.cumsum(chunks) - chunks
        mean, most = np.add.reduceat(h, start) / chunks[:, None], np.maximum.reduceat(h, start)
        doc = np.concatenate([mean, most], 1)
        logit = doc @ w["o"] + w["ob"]
        if not keep:
            return logit
        return logit, (b, quad, z, top, left, right, m, x, h, chunks, start, most, doc, first)

    def backward(self, d: np.ndarray, kept) -> dict:
        """Gradients from those of the logits."""
        w = self.w
        b, quad, z, top, left, right, m, x, h, chunks, start, most, doc, _ = kept
        g = {"o": doc.T @ d, "ob": np.array([d.sum()])}
        dd = d[:, None] * w["o"]
        n = h.shape[1]
        of = np.repeat(np.arange(len(chunks)), chunks)
        dh = (dd[:, :n] / chunks[:, None])[of]
        hit = h == most[of]
        ties = np.add.reduceat(hit, start, dtype=np.float32)
        dh = (dh + hit * (dd[:, n:] / ties)[of]) * (h > 0)
        g["h"], g["hb"] = x.T @ dh, dh.sum(0)
        dm = (dh @ w["h"].T[:, :-1]) * (x[:, :-1] > 0)
        g["fb"] = dm.sum(0)
        block = np.where(top[left] >= m, left[:, None], right[:, None])
        filters = np.broadcast_to(np.arange(dm.shape[1]), dm.shape)
        use = np.flatnonzero(dm.ravel())
        block, filters, dz = block.ravel()[use], filters.ravel()[use], dm.ravel()[use]
        step = block * BLOCK + z.argmax(1)[block, filters]
        dims, half = w["e"].shape[1], len(w["f"]) // 2
        g["f"] = np.zeros_like(w["f"])
        order = np.argsort(filters, kind="stable")
        block, filters, dz, step = block[order], filters[order], dz[order], step[order]
        cut = np.searchsorted(filters, np.arange(w["f"].shape[1] + 1))
        for k in range(w["f"].shape[1]):
            s = slice(cut[k], cut[k + 1])
            g["f"][:half, k] = dz[s] @ quad[step[s]]
            g["f"][half:, k] = dz[s] @ quad[step[s] + 1]
        de = (w["f"].T[filters] * dz[:, None]).reshape(-1, WIDTH, dims)
        at = b[(step * STRIDE)[:, None] + np.arange(WIDTH)].ravel()
        g["e"] = np.stack([np.bincount(at, de[:, :, k].ravel(), 256) for k in range(dims)], 1)
        return g

    def probability(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.forward(data, off).astype(np.float64), -50, 50)))


class Constant:
    def __init__(self, p: float):
        self.p = p

    def probability(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        return np.full(len(off) - 1, self.p)


def fit(texts: list[bytes], labels: list[int], epochs: int = 16, batch: int = 24, rate: float = 0.004, seed: int = 5):
    """Adam on the cross-entropy, classes weighted to count alike."""
    if len(set(labels)) < 2:
        return Constant(float(labels[0]) if labels else 1.0)
    net, r, y = Cnn(), np.random.default_rng(seed), np.array(labels, np.float32)
    weight = np.where(y > 0, 0.5 / y.mean(), 0.5 / (1 - y.mean())).astype(np.float32)
    m, v, t = {k: 0.0 for k in net.w}, {k: 0.0 for k in net.w}, 0
    epochs = max(epochs, min(120, -(-150 * batch // len(texts))))
    steps = epochs * -(-len(texts) // batch)
    for _ in range(epochs):
        trim()
        order = r.permutation(len(texts))
        for lo in range(0, len(order), batch):
            pick = order[lo : lo + batch]
            off = np.cumsum([0, *(len(texts[i]) for i in pick)])
            logit, kept = net.forward(np.frombuffer(b"".join(texts[i] for i in pick), np.uint8), off, keep=True)
            p = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
            g = net.backward((weight[pick] * (p - y[pick]) / len(pick)).astype(np.float32), kept)
            t += 1
            lr = rate * min(1.0, 2 * (1 - t / (steps + 1)))
            for k in net.w:
                m[k] = 0.9 * m[k] + 0.1 * g[k]
                v[k] = 0.999 * v[k] + 0.001 * g[k] ** 2
                net.w[k] -= (lr * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)).astype(np.float32)
    return net


def learn(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "quality", per_label: int = 1500):
    """A network fitted to ``labels`` rows of ``docs``: of each label the ``per_label`` ids with the smallest hashes."""
    marks = labels.filter(F.col(label).isNotNull() & F.col(id).isNotNull()).groupBy(F.col(id).alias("i")).agg(F.min(label).cast("int").alias("y"))
    h = F.xxhash64(F.col("i").cast("string"))
    picked = [marks.filter(F.col("y") == k).orderBy(h, "i").limit(per_label) for k in (0, 1)]
    sample = {r["i"]: r["y"] for p in picked for r in p.collect()}  # 2 * per_label rows at most
    if not sample:
        return fit([], [])
    ids = docs.sparkSession.createDataFrame([(i,) for i in sample], docs.select(F.col(id).alias("i")).schema)
    rows = docs.select(F.col(id).alias("i"), F.coalesce(F.col(text), F.lit("")).alias("t")).join(F.broadcast(ids), "i", "left_semi")
    # However many rows share an id, one of them comes.
    rows = rows.groupBy("i").agg(F.min(F.struct(F.xxhash64("t").alias("th"), F.col("t"))).alias("d")).select("i", "d.t")
    found = sorted((r["i"], r["t"]) for r in rows.toLocalIterator())
    net = fit([t.encode() for _, t in found], [sample[i] for i, _ in found])
    del found
    trim()
    return net


def score_quality(docs: DataFrame, model, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """``docs`` (or its ``carry`` columns) with score (0 to 1, higher is better) and predicted (1 from 0.5 on)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(columns: list[pa.Array]) -> list[pa.Array]:
        data, off, _ = text_buffers(columns[0])
        parts = [shared.value.probability(data[off[lo] : off[hi]], off[lo : hi + 1] - off[lo]) for lo, hi in slices(off, 1 << 19)]
        p = np.concatenate(parts) if parts else np.zeros(0)
        return [pa.array(p, pa.float64()), pa.array((p >= 0.5).astype(np.int32))]

    return annotate(docs, run, "score double, predicted int", [text], carry)


def filter_quality(docs: DataFrame, model, text: str = "text") -> DataFrame:
    """The rows of ``docs``, as they are, that the model does not reject."""
    cols = docs.columns
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("__doc"), F.col(text).alias("__text"))
    return score_quality(packed, model, "__text", ["__doc"]).filter("predicted = 1").select("__doc.*")
