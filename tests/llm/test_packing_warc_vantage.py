"""Packing and token counts against the library, WARC packages by round trip, neighbours against all pairs."""

import array
import collections
import hashlib
import io
import random
import zipfile
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from data import SCHEMA, rows
from wideflow.llm import warc_zip
from wideflow.llm.packing import CapacityTree, best_fit_decreasing, cut_short, pack
from wideflow.llm.pretokens import IdEncoder, PretokenCache, id_bytes
from wideflow.llm.token_counts import count_tokens
from wideflow.llm.vantage import VantageTree, nearest
from wideflow.llm.warc_zip import ZipReader, read_packages, write_packages

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", " ", "   x", "a  b", "a \n b\n\n  c", "\t\ttab", "it's isn't WE'LL", "x" * 3000, " " * 2000 + "y", "中文 日本語 한국어", "é x y　z",
       "\x00 a\x1c b\x85 c", "a <|endoftext|> b", "1234 5,678.90", "trail ", "a.b, c. d,e", "👍🏽 ok", "٣٤ ½ ²", "word,, word.. (word)"]


@pytest.fixture(scope="module")
def library():
    tok = Tokenizer.from_file(PATH)
    return lambda t: tok.encode(t or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def docs(spark):
    more = [(5000 + i, t, "a", 1, "x", "y", "z", "r") for i, t in enumerate(ODD)]
    return spark.createDataFrame(rows() + more, SCHEMA).repartition(3)


def test_encoders_equal_the_library(library):
    texts = ODD + [r[1] for r in rows()]
    quick, cache = IdEncoder(PATH), PretokenCache(PATH, id_bytes, max_kept=50)
    assert quick.quick is not None
    assert [quick(t) for t in texts] == [id_bytes(library(t)) for t in texts]
    for _ in range(2):
        assert [b for i in range(0, len(texts), 7) for b in cache.texts(texts[i:i + 7], b"".join)] == [id_bytes(library(t)) for t in texts]


def test_token_counts(docs, library, spark):
    got = count_tokens(docs, PATH, limit=50).collect()
    want = collections.Counter((r.doc_id, len((r.text or "").encode()), len(library(r.text)), len(library(r.text)) > 50) for r in docs.collect())
    assert collections.Counter((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in got) == want
    assert count_tokens(spark.createDataFrame([], SCHEMA), PATH).collect() == []


def test_capacity_tree_finds_the_tightest_window():
    rnd, tree, held = random.Random(1), CapacityTree(100), []
    for step in range(2000):
        if rnd.random() < 0.5:
            c = rnd.randint(1, 100)
            tree.put(c, step)
            held.append(c)
        else:
            need = rnd.randint(1, 100)
            got, want = tree.take(need), min((c for c in held if c >= need), default=None)
            assert (got and got[0]) == want
            if want:
                held.remove(want)


def test_best_fit_decreasing_and_cuts():
    rnd = random.Random(2)
    lengths = [rnd.choice([1, 5, 100, 1000, 1024, 1025, 5000]) for _ in range(300)]
    packed = best_fit_decreasing(lengths, 1024)
    assert all(sum(p[2] for p in s) <= 1024 for s in packed)
    cut = [c for s in packed for c in cut_short(s, 1024, 16)]
    for plan in (packed, cut):
        places = collections.Counter((d, x) for s in plan for d, a, n in s for x in range(a, a + n))
        assert places == collections.Counter((d, x) for d, n in enumerate(lengths) for x in range(n))
    assert all(1024 - n <= 16 or n & (n - 1) == 0 for n in (sum(p[2] for p in s) for s in cut))


def test_packing_round_trip(docs, library, spark):
    got = pack(docs, PATH, window=64, max_padding=4).collect()
    sequences, pieces = collections.defaultdict(list), collections.defaultdict(list)
    for r in got:
        assert len(r.ids) == 4 * r.length and 0 < r.length <= 64
        sequences[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id].append((r.start, bytes(r.ids), r.doc_tokens))
    for s in sequences.values():
        at = 0
        for offset, n in sorted(s):
            assert offset == at
            at += n
        assert 60 <= at <= 64 or at & (at - 1) == 0
    texts = collections.defaultdict(list)
    for r in docs.collect():
        texts[r.doc_id].append(id_bytes([*library(r.text), 0]))
    assert pieces.keys() == texts.keys()
    for i, whole in texts.items():
        assert sum(len(p[1]) for p in pieces[i]) == sum(map(len, whole))
        if len(whole) == 1:
            assert b"".join(p[1] for p in sorted(pieces[i])) == whole[0]
            assert {p[2] for p in pieces[i]} == {len(whole[0]) // 4}
    assert zlib.crc32(array.array("I", library("a b")).tobytes()) == zlib.crc32(IdEncoder(PATH)("a b"))
    assert pack(spark.createDataFrame([], SCHEMA), PATH).collect() == []


PAGES = [(1, "http://a/1", "<p>" + "x" * 200), (2, "http://a/2", "<p>" + "x" * 200), (3, None, "<p>" + "x" * 200), (4, "http://a/4", "short"), (5, "u", "short"),
         (6, "http://é/\r\nX: y", "é中" * 60), (7, "u7", None), (8, "u8", ""), (None, "n", "<p>" + "x" * 200), (9, "u9", "WARC/1.1\r\n\r\n" * 40), (1, "again", "<p>" + "x" * 200),
         (10, "a", "z" * 99), (11, "b", "z" * 99), (12, "a", "z" * 100), (13, "b", "z" * 100), (None, "n2", "only null ids " * 10), (None, "n3", "only null ids " * 10)]


def test_warc_round_trip(spark, monkeypatch):
    monkeypatch.setattr(warc_zip, "PACKAGE_BYTES", 700)
    df = spark.createDataFrame([(*p, "x", 7) for p in PAGES], "page_id long, url string, html string, digest string, first int").repartition(3)
    manifest = write_packages(df)
    assert manifest.agg({"records": "sum"}).first()[0] == len(PAGES) and manifest.count() >= 3
    got = read_packages(manifest).collect()
    first = {}
    for i, _, h in PAGES:
        if i is not None and len((h or "").encode()) >= 100:
            first[h] = min(first.get(h, i), i)
    want = collections.Counter()
    for i, u, h in PAGES:
        b = (h or "").encode()
        to = first.get(h)
        revisit = to is not None and to != i
        # A payload without a record that has an id has nothing to refer to.
        want[(i, u, "revisit" if revisit else "response", None if revisit else b, len(b), hashlib.sha256(b).hexdigest(), to if revisit else None)] += 1
    assert collections.Counter((r.page_id, r.url, r.record_type, None if r.payload is None else bytes(r.payload), r.payload_bytes, r.payload_digest, r.refers_to) for r in got) == want
    assert read_packages(write_packages(df.limit(0))).collect() == []


@pytest.mark.parametrize("zip64", [False, True])
def test_zip_reader_finds_stored_members(zip64, monkeypatch):
    if zip64:  # all offsets and counts then go to the ZIP64 records
        monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 10)
        monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for n in range(4):
            z.writestr(f"dir/é{n}.txt", bytes([65 + n]) * (n * 50 + 20))
        z.writestr("packed", b"y" * 500, zipfile.ZIP_DEFLATED)
        z.comment = b"PK a comment"
    raw = out.getvalue()
    assert (b"PK\x06\x07" in raw) == zip64
    r = ZipReader(lambda n, at: raw[at:at + n], len(raw))
    for n in range(4):
        at, size = r.place(f"dir/é{n}.txt")
        assert raw[at:at + size] == bytes([65 + n]) * (n * 50 + 20)
    with pytest.raises(ValueError, match="not stored"):
        r.place("packed")
    with pytest.raises(ValueError, match="no end"):
        ZipReader(lambda n, at: b"x" * n, 100)


def test_neighbours_equal_all_pairs(spark, monkeypatch):
    import wideflow.llm.vantage as vantage
    monkeypatch.setattr(vantage, "SHARD_ROWS", 150)
    monkeypatch.setattr(vantage, "BLOCK_ROWS", 10)
    monkeypatch.setattr(vantage, "LEAF", 16)
    rng = np.random.default_rng(3)
    v = rng.normal(size=(600, 8)).astype(np.float32)
    v[100:300] = v[100]  # a large group of copies
    data = [(i, [float(x) for x in row], 1, "x") for i, row in enumerate(v)]
    bad = [(700, None, 1, "x"), (701, [], 1, "x"), (720, [0.0] * 8, 1, "x"), (740, [float("nan")] * 8, 1, "x"), (741, [float("inf")] + [1.0] * 7, 1, "x"),
           (742, [None] + [1.0] * 7, 1, "x"), (None, [1.0] * 8, 1, "x"), (760, [1.0, 2.0], 1, "x"), data[20], data[120]]
    df = spark.createDataFrame(data + bad, "vec_id long, embedding array<float>, shard int, id string").repartition(4)
    got = nearest(df, df.where("vec_id % 20 = 0"), k=7).collect()
    want = []
    for q in range(0, 600, 20):
        s = np.zeros(600)
        for d in range(8):
            s += v[q, d].astype(np.float64) * v[:, d].astype(np.float64)
        best = sorted((-x, i) for i, x in enumerate(s) if i != q)[:7]
        want += [(q, n + 1, i, -x) for n, (x, i) in enumerate(best)]
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == sorted(want)
    few = df.where("vec_id IN (20, 21, 22)")
    assert sorted((r.query_id, r["rank"]) for r in nearest(few, few.where("vec_id = 20"), k=7).collect()) == [(20, 1), (20, 2)]
    assert nearest(df.limit(0), df.limit(0)).collect() == []


def test_neighbours_are_exact_for_norms_of_any_size_and_many_ties(spark, monkeypatch):
    import wideflow.llm.vantage as vantage
    monkeypatch.setattr(vantage, "SHARD_ROWS", 200)
    monkeypatch.setattr(vantage, "LEAF", 16)
    rng = np.random.default_rng(8)
    v = rng.normal(size=(500, 6))
    v /= np.sqrt((v * v).sum(1))[:, None]
    v[::7] *= 10.0 ** rng.integers(0, 13, len(v[::7]))[:, None]
    v[3] *= 1e150
    v[200:400, 1:] = rng.integers(-2, 3, (200, 5))
    v[200:400, 0] = 1.0
    v[420:440] = 0.0
    v[420:440, 0] = [2.0 ** n for n in range(20)]  # ties of 200 different vectors with the queries among these
    df = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(v)] + [(7, [1e200] * 6), (7, v[7].tolist())],
                               "vec_id long, embedding array<double>").repartition(3)
    got = nearest(df, df.where("vec_id % 20 = 0"), k=20).collect()
    want = []
    for q in range(0, 500, 20):
        s = np.zeros(500)
        for d in range(6):
            s += v[q, d] * v[:, d]
        best = sorted((-x, i) for i, x in enumerate(s) if i != q)[:20]
        want += [(q, n + 1, i, -x) for n, (x, i) in enumerate(best)]
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == sorted(want)


def test_larger_factor_prunes_more_and_one_is_exact():
    rng = np.random.default_rng(5)
    points, q = rng.normal(size=(2000, 3)), rng.normal(size=(40, 3))
    tree, visited = VantageTree(points, leaf=20), []
    distance = tree._distance

    def counted(x, index):
        visited.append(len(x) * len(index))
        return distance(x, index)

    tree._distance = counted
    want = [set(np.argsort(((points - x) ** 2).sum(1))[:5]) for x in q]
    recall, work = [], []
    for factor in (1.0, 3.0):
        visited.clear()
        _, found = tree.search(q, 5, factor)
        recall.append(np.mean([len(set(f) & w) / 5 for f, w in zip(found, want)]))
        work.append(sum(visited))
    assert recall[0] == 1 and recall[1] < 1 and work[1] < work[0] < 40 * 2000 / 2
