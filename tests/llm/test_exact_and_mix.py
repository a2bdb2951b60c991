from collections import Counter
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marlstone.llm import mixing
from marlstone.llm.exact_dedup import exact_dedup, exact_groups
from marlstone.llm.queries import op5_pfair_mix


def test_groups_of_odd_rows(odd):
    rows = exact_groups(odd).collect()
    assert len(rows) == odd.count()
    by = Counter(r["text_sha256"] for r in rows)
    for r in rows:
        assert r["group_size"] == by[r["text_sha256"]]
    assert Counter(r["text_sha256"] for r in rows if r["kept"]) == Counter(dict.fromkeys(by, 1)), "one row of each text stays, ties too"
    empty = [r for r in rows if r["group_size"] == 3 and r["keep_id"] == 3]
    assert {r["doc_id"] for r in empty} == {2, 3, None}
    assert {r["keep_id"] for r in rows if r["doc_id"] in (1, 6)} == {6}


def test_dedup_keeps_one_whole_row_of_each_text(odd, none):
    kept = exact_dedup(odd)
    assert kept.columns == odd.columns
    texts = [r["text"] or "" for r in kept.collect()]
    assert len(texts) == len(set(texts)) == odd.select(F.coalesce("text", F.lit(""))).distinct().count()
    assert exact_dedup(none).count() == exact_groups(none).count() == 0


def test_collisions_are_split_by_bytes(odd, monkeypatch):
    from marlstone.llm import exact_dedup as m

    monkeypatch.setattr(m, "_md5", lambda text: F.unhex(F.lit("00")))
    rows = exact_groups(odd).collect()
    by = Counter(r["text_sha256"] for r in rows)
    assert all(r["group_size"] == by[r["text_sha256"]] for r in rows)
    assert exact_dedup(odd).count() == len(by)


def shares(blocks, weights, slots):
    """What each source should have had after so many slots, as fractions: by serving all at once, step by step."""
    w, left, had = {k: Fraction(weights[k]) for k in blocks}, {k: Fraction(n) for k, n in blocks.items()}, dict.fromkeys(blocks, Fraction(0))
    out, t = [dict(had)], Fraction(0)
    while len(out) <= slots:
        active = {k for k in blocks if left[k] > 0}
        if not active:
            break
        total = sum(w[k] for k in active)
        step = min([len(out) - t] + [left[k] * total / w[k] for k in active])
        for k in active:
            had[k] += step * w[k] / total
            left[k] -= step * w[k] / total
        t += step
        if t == len(out):
            out.append(dict(had))
    return out


def plain_schedule(blocks, weights):
    """Earliest deadline first with windows looked up slot by slot."""
    names = sorted((k for k in blocks if blocks[k]), key=str)
    total = sum(blocks.values())
    had = shares({k: blocks[k] for k in names}, weights, total)
    windows = {}
    for k in names:
        for i in range(blocks[k]):
            release = max(t for t in range(total) if had[t][k] <= i)
            due = min(t for t in range(total + 1) if had[t][k] >= i + 1)
            windows[(k, i)] = (release, due)
    done, out = dict.fromkeys(names, 0), []
    for t in range(total):
        ready = [(windows[(k, done[k])][1], n, k) for n, k in enumerate(names) if done[k] < blocks[k] and windows[(k, done[k])][0] <= t]
        due, _, k = min(ready)
        assert due > t, "a deadline is missed"
        out.append(k)
        done[k] += 1
    return out


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.sampled_from("abcdefg"), st.tuples(st.integers(0, 40), st.floats(0.01, 100)), min_size=1, max_size=6))
def test_schedule_equals_a_plain_one_and_stays_within_one_block(sources):
    blocks, weights = {k: n for k, (n, _) in sources.items()}, {k: w for k, (_, w) in sources.items()}
    ideal = mixing.Ideal(blocks, weights)
    got = [ideal.names[j] for j in mixing.pfair(ideal)]
    assert got == plain_schedule(blocks, weights)
    had, done = shares({k: n for k, n in blocks.items() if n}, weights, len(got)), Counter()
    for t, k in enumerate(got, 1):
        done[k] += 1
        assert all(abs(done[x] - had[t][x]) < 1 for x in had[t])


def test_a_long_schedule_stays_within_one_block():
    """A million slots, weights that no short pattern repeats, sources that are used up on the way."""
    blocks = {"big": 700_000, "mid": 260_000, "small": 40_000, "one": 1}
    weights = {"big": 61_000_000**0.5, "mid": 20_000_000**0.5, "small": 7_000_000**0.5, "one": 0.0004}
    ideal = mixing.Ideal(blocks, weights)
    w, n, done = ideal.w, ideal.n, [0] * 4
    ends = sorted(range(4), key=lambda j: Fraction(n[j], w[j]))
    gone, at, had, active = 0, 0, [Fraction(0)] * 4, set(range(4))
    for t, j in enumerate(mixing.pfair(ideal), 1):
        done[j] += 1
        while True:  # the phase of the ideal mix that slot t ends in
            total = sum(w[x] for x in active)
            if gone == 3 or (t - at) * w[ends[gone]] < (n[ends[gone]] - had[ends[gone]]) * total:
                break
            step = (n[ends[gone]] - had[ends[gone]]) * total / w[ends[gone]]
            for x in active:
                had[x] += step * w[x] / total
            at += step
            active.discard(ends[gone])
            gone += 1
        if t % 61 == 0 or t < 2000:
            for x in range(4):
                share = had[x] + ((t - at) * w[x] / Fraction(total) if x in active else 0)
                assert abs(done[x] - share) < 1
    assert done == n


def test_pieces_hold_every_block_once():
    blocks = {f"s{i}": 1 + i * 37 % 3000 for i in range(1001)}
    rows = list(mixing.pieces(mixing.Ideal(blocks, {k: n**0.5 for k, n in blocks.items()})))
    assert Counter({k: sum(len(s) for x, _, s in rows if x == k) for k in ("s3", "s900")}) == {k: blocks[k] for k in ("s3", "s900")}
    assert sorted(t for _, _, s in rows for t in s) == list(range(sum(blocks.values())))
    assert all(len(s) == mixing.PIECE or number == blocks[k] // mixing.PIECE for k, number, s in rows)
    with pytest.raises(ValueError):
        mixing.Ideal({"a": 1, "b": 1}, {"a": 1, "b": 0})


def test_mix_is_whole_and_fair(spark, data):
    rows = op5_pfair_mix(spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == 1000 == len({r["mix_position"] for r in rows})
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = mixing.mix_sources(docs, {"src0": 3.0, "src1": 1.0}, block_docs=1).select("source", "mix_slot").orderBy("mix_slot").collect()
    got = [r["source"] for r in out]
    size = Counter(got)
    assert got == plain_schedule(size, {s: {"src0": 3.0}.get(s, 1.0) for s in size})


def test_mix_of_odd_rows(odd, none, tmp_path):
    mixing.mix_sources(odd, block_docs=2).write.parquet(str(tmp_path / "mix"))  # columns that clash would not be written
    out = odd.sparkSession.read.parquet(str(tmp_path / "mix"))
    assert sorted(out.columns) == sorted([*odd.columns, "mix_offset", "mix_position"])
    assert out.count() == odd.count() == out.select("mix_position").distinct().count()
    assert mixing.mix_sources(none).count() == 0


def test_mix_of_equal_rows_and_many_sources(spark, monkeypatch):
    """Null ids, one id for all, and copies of whole rows: every row has a place, whatever holds a third of them."""
    monkeypatch.setattr(mixing, "DEAL", 16)
    rows = [(None, "a", i % 50) for i in range(900)] + [(7, "a", 1)] * 700 + [(7, "b", i) for i in range(300)] + [(i, f"s{i}", 0) for i in range(1001)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, x int").withColumn("m", F.create_map(F.lit("k"), F.col("x")))
    out = mixing.mix_sources(docs, block_docs=3, bucket_rows=20).collect()
    assert Counter((r["doc_id"], r["source"], r["x"], r["m"]["k"]) for r in out) == Counter((*r, r[2]) for r in rows)
    by = {}
    for r in out:
        by.setdefault(r["mix_slot"], []).append(r)
    assert len({r["mix_position"] for r in out}) == len(rows)
    assert all(len({r["source"] for r in b}) == 1 and sorted(r["mix_offset"] for r in b) == list(range(len(b))) for b in by.values())
    assert sorted(by) == list(range(len(by)))
