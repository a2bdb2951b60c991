"""Language identification and quality: held-out accuracy and exact arithmetic."""

import zlib

import numpy as np
from pyspark.sql import functions as F

from marlstone.llm import langid, quality
from marlstone.llm.queries import op3_ppm_langid, op8_cnn_quality

BIG = "/root/testdata/sf0.1"


def test_ppm_code_lengths_are_a_code():
    m = langid.Ppm({"a": [b"abracadabra abracadabra"], "b": [b"the cat sat on the mat"]}, 3)
    for ctx in (b"abr", b"zzz", b"e c", b"\n\n\n"):
        high = np.uint64(int.from_bytes(ctx, "big") << 8)
        bits = m.lengths(high | np.arange(256, dtype=np.uint64))
        assert np.allclose((2.0**-bits).sum(0), 1)
    plain = np.frombuffer(b"abracadabra", np.uint8)
    s = m.score(plain, np.array([0, len(plain)]))
    g = langid.grams(plain, np.array([0, len(plain)]), 3)
    assert np.allclose(s[0], m.lengths(g).sum(0), rtol=1e-5) and s[0, 0] < s[0, 1]


def test_grams_see_no_other_document():
    a = langid.grams(np.frombuffer(b"abxyz", np.uint8), np.array([0, 2, 5]), 3)
    b = langid.grams(np.frombuffer(b"xyz", np.uint8), np.array([0, 3]), 3)
    assert (a[2:] == b).all()


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{BIG}/documents.parquet")
    got = op3_ppm_langid(spark, BIG)
    assert got.columns == ["doc_id", "held_out", "lang_pred", "score"] and got.count() == docs.count()
    rows = got.join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 for r in rows)
    assert np.mean([r["lang_pred"] == r["lang"] for r in rows]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_of_odd_rows(odd, none):
    model = langid.learn(odd)
    rows = langid.identify(odd, model).collect()
    assert len(rows) == odd.count()
    for r in rows:
        if not r["text"] or not any(c.isalpha() for c in r["text"]):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        else:
            assert r["lang_pred"] in ("de", "en", "fr")
    assert langid.identify(none, model).count() == 0
    assert {r["lang_pred"] for r in langid.identify(odd, langid.learn(none)).collect()} == {"und"}


def test_gradients():
    r = np.random.default_rng(0)
    docs = [bytes(r.integers(0, 256, n, dtype=np.uint8)) for n in (0, 5, 700, 1500)]
    off = np.cumsum([0, *map(len, docs)])
    data = np.frombuffer(b"".join(docs), np.uint8)
    net = quality.Cnn(dims=3, filters=5, hidden=4)
    net.w = {k: v.astype(np.float64) for k, v in net.w.items()}
    d = r.standard_normal(len(docs))
    loss = lambda: float((net.forward(data, off) * d).sum())
    _, kept = net.forward(data, off, keep=True)
    g = net.backward(d, kept)
    for k, w in net.w.items():
        for at in [np.unravel_index(i, w.shape) for i in r.integers(0, w.size, 6)]:
            old, eps = w[at], 1e-6
            w[at] = old + eps
            up = loss()
            w[at] = old - eps
            down = loss()
            w[at] = old
            assert abs((up - down) / (2 * eps) - g[k][at]) < 1e-4 * max(1, abs(g[k][at])), k


def test_scores_don_t_depend_on_neighbours():
    net = quality.Cnn()
    docs = [b"abc" * 300, b"", b"hello there", b"z" * 513]
    off = np.cumsum([0, *map(len, docs)])
    whole = net.probability(np.frombuffer(b"".join(docs), np.uint8), off)
    for i, t in enumerate(docs):
        assert np.allclose(net.probability(np.frombuffer(t, np.uint8), np.array([0, len(t)])), whole[i], atol=1e-6)


def test_quality_held_out_accuracy(spark):
    labels = spark.read.parquet(f"{BIG}/labels.parquet")
    got = op8_cnn_quality(spark, BIG)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = got.join(labels, "doc_id").filter("held_out").collect()
    assert np.mean([r["predicted"] == r["quality"] for r in rows]) > 0.95
    assert all(r["predicted"] == int(r["score"] >= 0.5) and 0 <= r["score"] <= 1 for r in rows)


def test_quality_of_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(1, 1), (4, 0), (4, 1), (None, 1), (8, None), (9, 0)], "doc_id long, quality int")
    model = quality.learn(odd, labels)
    out = quality.score_quality(odd, model)
    assert out.count() == odd.count() and out.filter("score is null or score < 0 or score > 1").count() == 0
    kept = quality.filter_quality(odd, model)
    assert kept.columns == odd.columns and {r["score"] for r in kept.collect()} <= {0.5}
    assert quality.score_quality(none, model).count() == 0
    assert quality.filter_quality(odd, quality.learn(odd, labels.limit(0))).count() == odd.count()
    same = quality.score_quality(odd.filter("doc_id = 6"), model).select("score").distinct().count()
    assert same == 1 and quality.learn(odd, labels.filter("quality = 0")).p == 0.0
    assert out.filter(F.col("text").isNull()).count() == 2


def plain_bits(texts, text, order=3):
    """PPM with full exclusion, method C, by dictionaries: bits of ``text`` after learning ``texts``."""
    from collections import Counter, defaultdict
    from math import log2

    seen = defaultdict(Counter)
    for t in texts:
        padded = b"\n" * order + t
        for i in range(len(t)):
            for k in range(order + 1):
                seen[padded[i + order - k : i + order]][padded[i + order]] += 1
    bits, padded = 0.0, b"\n" * order + text
    for i, c in enumerate(text):
        out = set()
        for k in range(order, -1, -1):
            left = {b: n for b, n in seen[padded[i + order - k : i + order]].items() if b not in out}
            total, kinds = sum(left.values()), len(left)
            if c in left:
                bits += log2((total + kinds) / left[c])
                break
            if total:
                bits += log2((total + kinds) / kinds)
            out |= set(left)
        else:
            bits += log2(max(1, 256 - len(out)))
    return bits


def test_code_lengths_equal_a_plain_version(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").filter("text is not null and lang is not null and n_chars < 3000").orderBy("doc_id").collect()
    texts = {k: [r["text"].encode() for r in rows if r["lang"] == k][:6] for k in sorted({r["lang"] for r in rows})}
    model = langid.Models(texts)
    probe = [r["text"].encode()[:600] for r in rows[-25:]] + [b"x", "日本 \x00\xff?".encode(), b"\n\n\n"]
    off = np.cumsum([0, *map(len, probe)])
    got = model.score(np.frombuffer(b"".join(probe), np.uint8), off)
    for i, t in enumerate(probe):
        assert np.allclose(got[i], [plain_bits(texts[k], t) for k in model.langs], rtol=1e-5, atol=1e-3)


def test_any_number_of_languages(spark):
    from .conftest import passage

    rows = [(1000 * k + i, f"lang{k:03}", f"{passage(k, 12)} word{k}x{i} {passage(k, 5)}") for k in range(201) for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    model = langid.learn(docs)
    assert len(model.langs) == 201 and len(model.groups) == -(-201 // langid.GROUP)
    got = langid.identify(docs, model).collect()
    assert np.mean([r["lang_pred"] == r["lang"] for r in got]) > 0.95
    texts = {k: [t.encode() for _, lang, t in rows if lang == k] for k in ("lang000", "lang150")}
    some = [r[2].encode() for r in rows[:4]]
    bits = model.score(np.frombuffer(b"".join(some), np.uint8), np.cumsum([0, *map(len, some)]))
    for k, mine in texts.items():
        assert np.allclose(bits[:, model.langs.index(k)], [plain_bits(mine, t) for t in some], rtol=1e-5, atol=1e-3)


def test_repeated_ids_count_once(spark):
    """5000 rows of one id take one place of the sample, and the same text is taken every time."""
    rows = [(1, "en", f"the cat number {i}") for i in range(5000)] + [(i, "en", f"a dog of {i} years") for i in range(2, 40)] + [(i, "de", f"der Hund Nummer {i}") for i in range(50, 80)]
    rows += [(None, "de", f"ohne Nummer {i}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    for sample in (30, 10):
        one, two = langid.learn(docs.repartition(7), sample_docs=sample), langid.learn(docs.repartition(3), sample_docs=sample)
        a, b = (m.score(np.frombuffer(b"the dog der Hund", np.uint8), np.array([0, 16])) for m in (one, two))
        assert (a == b).all()
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 40)], "doc_id long, quality int")
    nets = [quality.learn(docs.repartition(k), labels, per_label=5) for k in (3, 7)]
    text = np.frombuffer(b"the dog number", np.uint8)
    assert nets[0].probability(text, np.array([0, 14])) == nets[1].probability(text, np.array([0, 14]))


def plain_logit(net, t):
    """The network's answer for one text, chunk by chunk and step by step."""
    w, half = net.w, quality.BYTES
    blocks = max(1, -(-len(t) // half))
    padded = t + bytes(blocks * half - len(t))
    answers = []  # of every filter at every step that lies inside the padded text
    for s in range(0, len(padded) - quality.WIDTH + 1, quality.STRIDE):
        answers.append(np.concatenate([w["e"][c] for c in padded[s : s + quality.WIDTH]]) @ w["f"])
    hidden, steps = [], half // quality.STRIDE
    for c in range(max(1, blocks - 1)):
        top = np.max(answers[c * steps : (c + 2) * steps], axis=0)
        full = min(1, (len(t) - c * half) / (2 * half))
        hidden.append(np.maximum(np.append(np.maximum(top + w["fb"], 0), full) @ w["h"] + w["hb"], 0))
    return np.concatenate([np.mean(hidden, 0), np.max(hidden, 0)]) @ w["o"] + w["ob"][0]


def test_forward_pass_equals_loops():
    r = np.random.default_rng(3)
    net = quality.Cnn(dims=3, filters=5, hidden=4)
    net.w = {k: r.standard_normal(v.shape) for k, v in net.w.items()}
    half = quality.BYTES
    docs = [bytes(r.integers(1, 256, n, dtype=np.uint8)) for n in (0, 1, 7, half - 1, half, half + 1, 2 * half - 1, 2 * half, 2 * half + 3, 5 * half + 100)]
    off = np.cumsum([0, *map(len, docs)])
    got = net.forward(np.frombuffer(b"".join(docs), np.uint8), off)
    for i, t in enumerate(docs):
        want = plain_logit(net, t)
        assert abs(got[i] - want) < 1e-5 * max(1, abs(want))
