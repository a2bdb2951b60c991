"""Jaccard join and repeated passages against brute force, components, and the pipeline."""

import random
import re
from collections import defaultdict

import numpy as np
import pytest

from marlstone.llm import jaccard_join as J
from marlstone.llm import suffix_dedup as S
from marlstone.llm.components import connected_components
from marlstone.llm.jaccard_join import jaccard_classes, keep_one_per_class
from marlstone.llm.queries import op6_suffix_dedup, op9_jaccard_join
from marlstone.llm.suffix_dedup import repeated_passages

from .conftest import passage

ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile("[^\x20\x09-\x0d]+")


def words(t):
    return WORD.findall((t or "").translate(ASCII_LOWER))


def shingles(t):
    w = words(t)
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def classes(docs):
    """doc_id -> (set size, smallest id reachable) by all pairs that share a shingle."""
    sets = [(d, shingles(t)) for d, t in docs]
    at = defaultdict(list)
    for i, (_, s) in enumerate(sets):
        for x in s:
            at[x].append(i)
    up = list(range(len(sets)))

    def root(i):
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    for i, (_, s) in enumerate(sets):
        same = defaultdict(int)
        for x in s:
            for j in at[x]:
                same[j] += j < i
        for j, n in same.items():
            if n and 100 * n >= 75 * (len(s) + len(sets[j][1]) - n):
                up[root(i)] = root(j)
    low = {}
    for i, (d, _) in enumerate(sets):
        r = root(i)
        low[r] = d if low.get(r) is None else low[r] if d is None else min(low[r], d)
    return sorted(((d, len(s), low[root(i)]) for i, (d, s) in enumerate(sets)), key=repr)


def test_join_equals_brute_force(spark, duck, data):
    got = op9_jaccard_join(spark, data)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == classes(duck.sql("SELECT doc_id, text FROM documents").fetchall())


@pytest.mark.parametrize("many", [16, 2])
def test_families_around_the_threshold(spark, many, monkeypatch):
    """Near copies in chains, of all sizes, with large groups forced by a small limit."""
    monkeypatch.setattr(J, "MANY", many)
    monkeypatch.setattr(J, "BLOCK", 8)
    r, docs = random.Random(many), []
    for size in (1, 3, 5, 6, 8, 12, 20, 33, 60, 110, 260):
        base = passage(size, size).split()
        for _ in range(14):
            w = list(base)
            for _ in range(r.randint(0, max(1, size // 14))):
                w[r.randrange(len(w))] = f"edit{r.randrange(40)}"
            docs.append((len(docs), " ".join(w) + (" tail" * r.randint(0, 2))))
    got = jaccard_classes(spark.createDataFrame(docs, "doc_id long, text string"))
    assert sorted((tuple(x) for x in got.collect()), key=repr) == classes(docs)


def test_join_of_odd_rows(odd, none):
    want = classes([(r["doc_id"], r["text"]) for r in odd.collect()])
    assert sorted((tuple(x) for x in jaccard_classes(odd).collect()), key=repr) == want
    assert jaccard_classes(none).count() == 0
    kept = keep_one_per_class(odd)
    assert kept.columns == odd.columns and {r["doc_id"] for r in kept.collect()} == {d for d, _, c in want if d is None or d == c}


def test_allocation_uses_both_levels_and_covers_the_distance():
    levels = set()
    for low, high in J.bands(75, 5000):
        m, level = J.allocation(low, high, 75)
        levels.add(level)
        assert m * level > J.most_apart(high, high, 75)
    assert levels == {1, 2}


def test_linked_sets_meet_in_the_index():
    r = random.Random(5)
    for size in (4, 9, 30, 80, 200):
        for _ in range(20):
            a = np.unique(np.array([r.getrandbits(60) for _ in range(size)], np.uint64))
            b = np.unique(np.concatenate([a[: int(len(a) * 0.9) + 1], np.array([r.getrandbits(60) for _ in range(size // 20)], np.uint64)]))
            same = len(np.intersect1d(a, b))
            if 100 * same >= 75 * (len(a) + len(b) - same):
                sig, who, _, _ = J.index_entries([a, b], 75)
                assert set(sig[who < 2].tolist()) & set(sig[who >= 2].tolist())


def test_hot_hashes_are_split_before_they_are_gathered(spark, monkeypatch):
    """Boilerplate in half of the documents, a cluster of near copies, and documents that share most of its segments: with
    small buffers every way is taken that a large group can take."""
    monkeypatch.setattr(J, "FLUSH", 1500)
    monkeypatch.setattr(J, "MANY", 4)
    monkeypatch.setattr(J, "BLOCK", 16)
    r, docs = random.Random(9), []
    licence, base = passage(60_000, 40), passage(60_001, 70).split()
    for _ in range(300):
        docs.append((len(docs), f"{passage(61_000 + len(docs), r.randint(3, 60))} {licence if len(docs) % 2 else ''}"))
    for _ in range(150):  # near copies of one text
        w = list(base)
        w[67 + r.randrange(3)] = f"edit{r.randrange(60)}"
        docs.append((len(docs), " ".join(w)))
    for k in range(60):  # more or less of it
        w = base[: r.randint(20, 70)] + passage(62_000 + k, r.randint(0, 40)).split()
        docs.append((len(docs), " ".join(w)))
    docs += [(9000 + i, " ".join(base)) for i in range(40)] + [(None, " ".join(base))] * 30 + [(9100, " ".join(base[:69]))] * 20
    docs += [(None, f"{passage(63_000 + i // 2, 30)} null{i}") for i in range(40)] + [(9200, f"{passage(64_000 + i // 3, 30)} same{i}") for i in range(30)]
    kinds = set()
    keep = J.materialize
    monkeypatch.setattr(J, "materialize", lambda df, name: (lambda out: (name == "jaccard-met" and kinds.update(x["kind"] for x in out.select("kind").distinct().collect()), out)[1])(keep(df, name)))
    got = jaccard_classes(spark.createDataFrame(docs, "doc_id long, text string"))  # in this order: near copies meet in a buffer of their own
    assert sorted((tuple(x) for x in got.collect()), key=repr) == classes(docs)
    assert kinds == {0, 1, 2}


def test_no_bucket_gathers_a_hot_hash():
    """20,000 sets, half with the same 30 elements: a buffer sends a bucket a bounded number of entries for each hash."""
    r = np.random.default_rng(4)
    common, flushes, entries, members, sent = r.integers(1, 1 << 62, 30, dtype=np.uint64), 0, 0, 0, 0
    held = J.Entries()
    for i in range(0, 20_000, 1000):
        own = r.integers(1, 1 << 62, (1000, 12), dtype=np.uint64)
        held.add([np.unique(np.concatenate([x, common] if k % 2 else [x])) for k, x in enumerate(own)], [None] * 1000, 75)
        if i % 5000 == 4000:
            entries += held.size
            batch = J._sent(held, 4, flushes).to_pydict()
            held, flushes = J.Entries(), flushes + 1
            for bucket, body, mark, member in zip(batch["bucket"], batch["body"], batch["marks"], batch["members"]):
                sig, hits = np.unique(np.frombuffer(body, J.BODY)["sig"], return_counts=True)
                assert not len(hits) or hits.max() <= J.MANY
                assert not np.intersect1d(sig, np.frombuffer(mark, J.MARK)["sig"]).size
                members, sent = members + len(member) // np.dtype(J.MEMBER).itemsize, sent + int(hits.sum())
                assert (bucket < 0) == bool(member)
    assert members > 10_000 and members + sent == entries


def test_rows_of_one_id_go_by_their_texts(spark):
    a, b = passage(71, 60), passage(72, 60)
    docs = spark.createDataFrame([(1, a), (5, a + " more"), (5, b), (6, b + " x")], "doc_id long, text string")
    assert sorted(tuple(r) for r in keep_one_per_class(docs).collect()) == [(1, a), (5, b)]


def test_components(spark):
    r = random.Random(1)
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(r.randrange(200, 240), r.randrange(200, 240)) for _ in range(25)]
    got = {x["node"]: x["root"] for x in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    group = {}
    for a, b in links:
        if a != b:
            group.setdefault(a, {a}).update(group.setdefault(b, {b}))
            for x in group[a]:
                group[x] = group[a]
    assert set(got) == set(group)
    assert all((got[a] == got[b]) == (group[a] is group[b]) for a in group for b in group)
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def cover(docs, n):
    """(doc_id, text) -> word positions inside windows of n words that another document has too."""
    first, shared, out = {}, set(), {}
    for d in docs:
        w = words(d[1])
        for j in range(len(w) - n + 1):
            k = tuple(w[j : j + n])
            if first.setdefault(k, d) != d:
                shared.add(k)
    for d in docs:
        w = words(d[1])
        out[d] = {x for j in range(len(w) - n + 1) if tuple(w[j : j + n]) in shared for x in range(j, j + n)}
    return out


def check(rows, docs, min_words=50, window=20):
    got = defaultdict(set)
    for r in rows:
        assert r["n_repeated"] == sum(s["end"] - s["start"] for s in r["spans"]) >= min_words
        for s in r["spans"]:
            got[(r["doc_id"], r["h"])].update(range(s["start"], s["end"]))
    most, least = cover(docs, min_words), cover(docs, min_words - window + 1)
    by_id = defaultdict(list)
    for (d, _), s in got.items():
        by_id[d].append(s)
    for d in set(docs):
        if most[d]:
            assert any(most[d] <= s <= least[d] for s in by_id[d[0]]), d[0]
    assert sum(bool(most[d]) for d in set(docs)) == len(got), "clean documents are left alone"
    return got


def test_passages_equal_brute_force(spark, duck):
    docs = duck.sql("SELECT doc_id, text FROM '/root/testdata/sf0.01/documents.parquet' WHERE doc_id < 600").fetchall()
    rows = repeated_passages(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert check(rows, docs)


def test_planted_passages_are_found_whole(spark):
    docs = []
    for k in range(12):
        p = passage(1000 + k, 50 + 3 * k)
        for c in range(2 + k % 3):
            docs.append((len(docs), f"{passage(50 * k + c, 40 + c)} {p} {passage(70 * k + c + 5, 30)}"))
    docs += [(900 + i, passage(5000 + i, 120)) for i in range(20)]
    docs += [(950 + i, f"{passage(6000 + i, 30)} {passage(42, 29)} {passage(7000 + i, 30)}") for i in range(4)]
    got = check(repeated_passages(spark.createDataFrame(docs, "doc_id long, text string")).collect(), docs)
    assert {d for d, _ in got} == {d for d, _ in docs if d < 900}


def test_nested_and_shifted_passages_are_found_whole(spark):
    """Third copies that start or stop inside the passage: the suffixes kept at its edges differ by document."""
    docs = []
    for k in range(150):
        n, cut = 50 + k % 30, 1 + k % 19
        p, q = passage(2000 + k, n), passage(3000 + k, n).split()
        part, tail = p.split()[cut:], q[: n - cut]
        shared = ([p, p, " ".join(part)], [" ".join(q), " ".join(q), " ".join(tail)], [p, " ".join(part), p])[k % 3]
        for c, x in enumerate(shared):
            docs.append((len(docs), f"{passage(9000 + 10 * k + c, 30 + c)} {x} {passage(20000 + 10 * k + c, 30)}"))
    check(repeated_passages(spark.createDataFrame(docs, "doc_id long, text string")).collect(), docs)


def test_repeats_inside_a_document_are_no_neighbours(spark):
    """A passage of 42 words is too short, though one document has it twice in the same surroundings."""
    x, k, y = passage(31, 19), passage(32, 42), passage(33, 19)
    docs = [(1, " ".join([passage(34, 20), x, k, y, passage(35, 31), x, k, y])), (2, f"{passage(36, 30)} {k} {passage(37, 30)}")]
    assert repeated_passages(spark.createDataFrame(docs, "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("part_rows", [7, 500_000])
def test_passages_and_internal_repeats(spark, part_rows, monkeypatch):
    """Shared passages beside repeats inside documents: all of every long passage, nothing that is in no shared one."""
    monkeypatch.setattr(S, "PART_ROWS", part_rows)
    r, docs = random.Random(part_rows), []
    pool = [passage(40_000 + i, r.choice([20, 31, 42, 49, 50, 55, 70, 120])) for i in range(60)]
    for d in range(120):
        own = [passage(50_000 + 10 * d + j, r.randint(5, 60)) for j in range(3)]
        own += [f"{a} {b} {c}" for a, b, c in [(own[0], r.choice(pool), own[1])]] * r.randint(0, 2)
        pieces = [r.choice(own) if r.random() < 0.5 else r.choice(pool) for _ in range(r.randint(1, 9))]
        docs.append((d, " ".join(pieces)))
    docs += [docs[0], docs[3], (5, docs[6][1])]
    got = defaultdict(set)
    for row in repeated_passages(spark.createDataFrame(docs, "doc_id long, text string")).collect():
        for s in row["spans"]:
            got[(row["doc_id"], row["h"])].update(range(s["start"], s["end"]))
    most, least = cover(docs, 50), cover(docs, 31)
    by_id = defaultdict(list)
    for (d, _), s in got.items():
        by_id[d].append(s)
    for d in set(docs):
        assert not most[d] or any(most[d] <= s for s in by_id[d[0]]), d[0]
    for d, spans in by_id.items():
        assert all(any(s <= least[x] for x in set(docs) if x[0] == d) for s in spans), d


def test_neighbours_in_a_stream():
    """Against all rows of the same key, with any cut into parts and batches."""
    for trial in range(400):
        r = random.Random(trial)
        rows = sorted((r.randrange(2), tuple(r.randrange(3) for _ in range(4)), r.randrange(3), i) for i in range(r.randint(1, 25)))
        cuts = sorted({0, len(rows), *[r.randrange(len(rows) + 1) for _ in range(2)]})
        got = {}
        for lo, hi in zip(cuts, cuts[1:]):
            found, settled, i = S.Neighbours(), [], lo
            while i < hi:
                b = rows[i : min(hi, i + r.randint(1, 5))]
                key, ctx, h = (np.array([x[j] for x in b]) for j in (0, 1, 2))
                settled += found.add(lambda a, z, b=b: [x[3] for x in b[a:z]], h, key, key, ctx.astype(np.uint64))
                i += len(b)
            for ids, up, head, down, tail in [*settled, *found.finish()]:
                got.update({q: (u, e, d, tail, lo, hi) for q, u, e, d in zip(ids, up, head, down)})
        assert len(got) == len(rows)
        for n, (key, ctx, h, q) in enumerate(rows):
            up, head, down, tail, lo, hi = got[q]
            for at, value, far in ((range(n - 1, lo - 1, -1), up, head), (range(n + 1, hi), down, tail)):
                first = next((m for m in at if rows[m][0] != key or rows[m][2] != h), None)
                assert (first is None) == bool(far)
                if first is not None:
                    same = S._common(np.array([ctx], np.uint64), np.array([rows[first][1]], np.uint64))[0]
                    assert value == (same if rows[first][0] == key else S.NONE)


def test_passages_of_odd_rows(spark, odd, none):
    rows = repeated_passages(odd).collect()
    assert {r["doc_id"] for r in rows} == {1, 4, 5, 6}
    assert repeated_passages(none).count() == 0
    a = f"{passage(21, 30)} {passage(22, 60)} {passage(23, 30)}"
    rows = [(1, a), (1, a), (2, f"{passage(24, 15)} {passage(22, 60)} {passage(25, 40)}")]
    found = repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: [(s["start"], s["end"]) for s in r["spans"]] for r in found} == {1: [(30, 90)], 2: [(15, 75)]}
    twice = spark.createDataFrame([(1, passage(1, 60) + " " + passage(1, 60)), (2, passage(9, 90))], "doc_id long, text string")
    assert repeated_passages(twice).count() == 0
    assert set(op6_suffix_dedup(spark, "/root/testdata/sf0.001").columns) == {"doc_id", "n_repeated", "spans"}


def test_pipeline_stages(spark, tmp_path):
    """Every stage against a brute-force version of its operator, each on what the one before kept."""
    import corpus_pipeline as cp
    from marlstone.llm import queries

    from .test_exact_and_mix import plain_schedule
    from .test_learned import plain_logit
    from .test_text_scans import brute

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, frames = docs.columns, []
    for i, (name, stage) in enumerate(cp.STAGES):
        out = stage(spark, docs, sf)
        if i < len(cp.STAGES) - 1:
            assert out.columns == columns, name
        out.write.parquet(str(tmp_path / name))
        frames.append((docs, spark.read.parquet(str(tmp_path / name))))
        docs = frames[-1][1]
    text = lambda df: [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
    ids = lambda df: {r["doc_id"] for r in df.select("doc_id").collect()}
    before, after = frames[0]
    model = queries.quality_model(before, spark.read.parquet(f"{sf}/labels.parquet"))
    logit = {d: plain_logit(model, (t or "").encode()) for d, t in text(before)}
    assert {d for d, x in logit.items() if x > 1e-4} <= ids(after) <= {d for d, x in logit.items() if x > -1e-4} and len(ids(after)) < len(logit)
    before, after = frames[1]
    last = {}
    for d, t in text(before):
        last[t] = max(d, last.get(t, -1))
    assert ids(after) == set(last.values())
    before, after = frames[2]
    assert ids(after) == {d for d, _, c in classes(text(before)) if d == c}
    before, after = frames[3]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    assert ids(after) == {r[0] for r in brute(text(before), items) if not r[-1]}
    before, after = frames[4]
    rows = after.orderBy("mix_position").collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(ids(before)) and len({r["mix_position"] for r in rows}) == len(rows)
    size = defaultdict(int)
    for r in rows:
        size[r["source"]] += 1
    blocks = {k: -(-n // 16) for k, n in size.items()}
    by_slot = {r["mix_slot"]: r["source"] for r in rows}
    assert [by_slot[t] for t in range(len(by_slot))] == plain_schedule(blocks, {k: n**0.5 for k, n in size.items()})
    whole = cp.run(spark, sf)
    assert {(r["doc_id"], r["mix_position"]) for r in whole.collect()} == {(r["doc_id"], r["mix_position"]) for r in rows}


def test_pipeline_of_odd_and_empty_tables(spark, odd, none, tmp_path):
    import corpus_pipeline as cp

    labels = spark.createDataFrame([(1, 1), (4, 0), (None, 1), (9, None)], "doc_id long, quality int")
    bench = spark.createDataFrame([("a", passage(3, 20)), (None, None), ("b", "")], "item_id string, text string")
    for name, docs in (("odd", odd), ("none", none)):
        for table, df in (("documents", docs), ("labels", labels), ("benchmark", bench), ("labels", labels.limit(0)), ("benchmark", bench.limit(0))):
            df.write.mode("overwrite").parquet(f"{tmp_path}/{name}/{table}.parquet")
        out = cp.run(spark, f"{tmp_path}/{name}")
        assert set(out.columns) == {*docs.columns, "mix_slot", "mix_offset", "mix_position"}
        got = out.collect()
        assert len({r["mix_position"] for r in got}) == len(got)
        # Without labels nothing is rejected, without a benchmark nothing is contaminated: copies alone go.
        texts = {r["text"] or "" for r in docs.collect()}
        near = {c for _, _, c in classes([(r["doc_id"], r["text"]) for r in docs.collect()])}
        assert {r["text"] or "" for r in got} <= texts and (len(got) > 0) == (len(near) > 0)
