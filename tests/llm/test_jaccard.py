"""The Jaccard join against all pairs, its band plan against random sets, and the components."""

import random

import numpy as np
import pyarrow as pa
import pytest

import wideflow.llm.common as common
import wideflow.llm.jaccard as jaccard
from data import SCHEMA, rows, shingles
from wideflow.llm.components import components
from wideflow.llm.jaccard import plan_for, sketch, similar_components
from wideflow.llm.shingles import shingle_sets


def brute(docs, k, num, den):
    """Smallest id reachable by links, per id; rows that repeat an id are one node with the links of each."""
    sets = [(i, shingles(t, k)) for i, t in docs if i is not None]
    parent = {i: i for i, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (i, x) in enumerate(sets):
        for j, y in sets[:a]:
            shared = len(x & y)
            if shared and shared * den >= num * (len(x) + len(y) - shared):
                u, v = sorted((root(i), root(j)))
                parent[v] = u
    return {i: root(i) for i in parent}


def check(spark, docs, k, num, den, parts=5):
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(parts)
    got = similar_components(df, words=k, similarity=(num, den)).collect()
    want = brute(docs, k, num, den)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_shingles, r.component_id) for r in got) == \
        sorted((i is None, i or 0, len(shingles(t, k)), want.get(i)) for i, t in docs)


@pytest.mark.parametrize(("num", "den"), [(85, 100), (4, 5)])
def test_plan_never_misses_a_similar_pair(num, den):
    plan, rng = plan_for(num, den), np.random.default_rng(3)
    similar = 0
    for trial in range(1500):
        n = int(rng.integers(1, 30 if trial % 2 else 500))
        a = np.unique(rng.integers(0, 2 ** 64, n, dtype=np.uint64))
        b = a[rng.permutation(len(a))[int(rng.integers(0, max(1, n // 6))):]]
        b = np.unique(np.r_[b, rng.integers(0, 2 ** 64, int(rng.integers(0, max(1, n // 10))), dtype=np.uint64)])
        shared = len(np.intersect1d(a, b))
        if len(b) and plan.similar(shared, len(a), len(b)):
            similar += 1
            shared_sigs = np.intersect1d(plan.entries(a), plan.entries(b))
            # Whatever heavy signatures each side leaves in a band, one is left in some band.
            left = 0
            for band in np.unique(shared_sigs & np.uint64(jaccard.SCHEMES - 1)):
                n_shared = (shared_sigs & np.uint64(jaccard.SCHEMES - 1) == band).sum()
                left += max(0, n_shared - 2 * plan.bands[int(band)][3])
            assert left > 0
            x, y = (np.frombuffer(sketch(s), np.uint8)[None] for s in (a, b))
            width = min(x.shape[1], y.shape[1])
            assert jaccard._apart(jaccard._folded(x, width), jaccard._folded(y, width))[0] <= len(a) + len(b) - 2 * shared
    assert similar > 500


def test_shingle_sets_have_the_sizes_of_word_runs():
    import pyarrow as pa
    texts = [r[1] or "" for r in rows()] + ["a b c", "A B\tc\n", "a b c d", " a  b c d e "]
    for k in (1, 4, 5):
        got = list(shingle_sets(pa.array(texts), k))
        assert [len(s) for s in got] == [len(shingles(t, k)) for t in texts]
    a, b, c, d = list(shingle_sets(pa.array(texts[-4:]), 4))
    assert a.tolist() == b.tolist() and a.tolist() != c.tolist() and set(c) < set(d)


@pytest.mark.parametrize("block", [2_000, 7])
def test_components_equal_those_of_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    rnd = random.Random(block)
    vocabulary = [f"w{i}" for i in range(2000)]
    texts = []
    for copies in (1, 40, 3, 1, 40, 40):
        base = [rnd.choice(vocabulary) for _ in range(rnd.choice([6, 30, 80, 400]))]
        for _ in range(copies):
            t = list(base)
            for _ in range(rnd.choice([0, 1, len(t) // 50, len(t) // 20])):
                t[rnd.randrange(len(t))] = rnd.choice(vocabulary)
            texts.append(" ".join(t))
    passage = [rnd.choice(vocabulary) for _ in range(50)]
    texts += [" ".join([rnd.choice(vocabulary) for _ in range(rnd.choice([2, 20, 60]))] + passage) for _ in range(40)]
    rnd.shuffle(texts)
    check(spark, list(enumerate(texts)), 4, 85, 100)


@pytest.mark.parametrize(("num", "den"), [(85, 100), (4, 5), (19, 20)])
def test_similar_sets_keep_a_shared_signature(spark, num, den):
    """Whatever the common order of signatures, of those that two similar sets share one is kept by both."""
    plan, rng, cases = plan_for(num, den), np.random.default_rng(4), []
    mark = np.uint64(jaccard.SCHEMES - 1)
    for _ in range(600):
        a = np.unique(rng.integers(0, 2 ** 64, int(rng.integers(50, 900)), dtype=np.uint64))
        most = len(a) * (den - num) // (den + num)  # as different as may be, by exchanged elements or by size
        b = a[rng.permutation(len(a))[int(rng.integers(0, 2 * most + 2)):]]
        b = np.unique(np.r_[b, rng.integers(0, 2 ** 64, int(rng.integers(0, most + 2)), dtype=np.uint64)])
        if len(b) and plan.similar(len(np.intersect1d(a, b)), len(a), len(b)):
            cases.append((a, b))
    assert len(cases) > 60
    wanted = sorted({(len(s), int(e)) for pair in cases for s in pair for e in np.unique(plan.entries(s) & mark)})
    wanted += [(None, b) for b in range(min(len(plan.bands), jaccard.SCHEMES))]
    df = spark.createDataFrame(wanted, "n long, band long").select("n", "band", plan.leave().alias("leave"))
    leave = {(r.n, r.band): r.leave for r in df.collect()}
    for b, (_, two, _, heavy) in enumerate(plan.bands[:jaccard.SCHEMES]):
        assert leave[None, b] <= (heavy if two else 2 * heavy)
        assert all(v >= leave[None, b] for (n, e), v in leave.items() if e == b and n is not None)
    for a, b in cases:
        x, y = plan.entries(a), plan.entries(b)
        band = max(set((x & mark).tolist()) & set((y & mark).tolist()))
        if plan.bands[band][1]:
            continue  # the other test's
        x, y = set(x[x & mark == np.uint64(band)].tolist()), set(y[y & mark == np.uint64(band)].tolist())
        # Worst: all that they share is more frequent than the rest.
        order = sorted(x & y) + sorted(x ^ y)
        left = [set([s for s in order if s in z][leave[len(c), band]:]) for z, c in ((x, a), (y, b))]
        assert left[0] & left[1]


def test_documents_that_share_passages_only_are_not_compared(spark, monkeypatch):
    """Three of six passages in each of many documents: few of their signatures come to the blocks of all pairs."""
    rnd = random.Random(8)
    passages = [" ".join(f"p{i}w{j}" for j in range(25)) for i in range(6)]
    docs = [(i, " ".join([f"d{i}u{j}" for j in range(120)] + rnd.sample(passages, 3) + [f"d{i}v{j}" for j in range(120)])) for i in range(150)]
    docs += [(1000 + i, docs[7][1].replace(f"d7u{i}", "x")) for i in range(0, 100, 9)]
    looked, across = spark.sparkContext.accumulator(0), jaccard._across

    def counted(*args):
        run = across(*args)

        def watched(batches):
            def passed():
                for b in batches:
                    looked.add(b.num_rows)
                    yield b
            yield from run(passed())
        return watched

    monkeypatch.setattr(jaccard, "_across", counted)
    check(spark, docs, 5, 4, 5)
    assert looked.value < 2 * len(docs)


def test_hard_rows(spark):
    check(spark, [(r[0], r[1]) for r in rows()], 5, 4, 5)


def test_empty_table_and_clashing_columns(spark):
    assert similar_components(spark.createDataFrame([], SCHEMA)).collect() == []
    got = similar_components(spark.createDataFrame(rows(n=12), SCHEMA))
    assert got.columns == ["doc_id", "n_shingles", "component_id"] and got.count() == 22


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (None, 3), (500, 501), (501, 500)]
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, **{i: 100 for i in range(100, 160)}, 500: 500, 501: 500}


def test_hot_ids_and_components(spark, monkeypatch):
    """A hub with a third of all links, and components relabelled while one holds most rows, by the way for hot keys."""
    monkeypatch.setattr(common, "HOT_ROWS", 20)
    rnd = random.Random(5)
    edges = [(9000, i) for i in range(400)] + [(3, 1000 + i) for i in range(300)] + [(2000 + rnd.randrange(600), 2000 + rnd.randrange(600)) for _ in range(500)]
    used = []
    join = common.join_unique
    monkeypatch.setattr("wideflow.llm.components.join_unique", lambda *a, **k: used.append(join(*a, **k)) or used[-1])
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x
    for a, b in edges:
        if a != b:
            u, v = sorted((root(a), root(b)))
            parent[v] = u
    assert got == {x: root(x) for x in parent} and got[9000] == got[1000] == 0
    assert any("Union" in d._jdf.queryExecution().optimizedPlan().toString() and "broadcast" in d._jdf.queryExecution().optimizedPlan().toString()
               for d in used)
    words = [f"w{i}" for i in range(60)]
    docs = [(i, " ".join([*words, f"x{i % 40}"])) for i in range(120)] + [(500 + i, " ".join(f"{i}y{j}" for j in range(20))) for i in range(40)]
    check(spark, docs, 5, 4, 5)


def test_unique_join_equals_the_plain_one(spark, monkeypatch):
    rows_ = spark.createDataFrame([(i % 3 and 7, i) for i in range(90)] + [(None, 1), (8, 2), (9, 3)], "k long, v long")
    side = spark.createDataFrame([(7, "a"), (8, "b"), (10, "c")], "k long, w string")
    for how in ("inner", "left"):
        want = sorted(map(str, rows_.join(side, "k", how).collect()))
        for least in (10, 1000):
            monkeypatch.setattr(common, "HOT_ROWS", least)
            assert sorted(map(str, common.join_unique(rows_, side, "k", how).collect())) == want


def test_long_words_that_collide_modulo_powers_of_two_differ():
    """Thue-Morse words have equal polynomial hashes modulo 2**64 whatever the base."""
    a = "".join("ab"[bin(i).count("1") % 2] for i in range(1024))
    b = a.translate(str.maketrans("ab", "ba"))
    x, y = shingle_sets(pa.array([f"{a} one two three four", f"{b} one two three four"]), 4)
    assert len(np.intersect1d(x, y)) == 1 and len(x) == len(y) == 2
    x, y = shingle_sets(pa.array([f"{a} one two three four", f"{a.upper()}  one two three four"]), 4)
    assert (x == y).all()
