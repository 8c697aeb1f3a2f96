"""Word-table BPE against the library, vector codes and Merkle manifests against plain versions."""

import array
import collections
import hashlib
import math
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from data import SCHEMA, rows
from wideflow.llm import vector_codes, word_table_bpe
from wideflow.llm.merkle import folded, leaf_digest, proof, prove
from wideflow.llm.vector_codes import Bounds, books_digest, compress, squared_to_all, with_label_errors
from wideflow.llm.word_table_bpe import WordIndex, Words, decode, encode, with_ids, word_table

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["", " ", "It's WE'LL they'Re", "a  b\n\n c", "x" * 3000, "İstanbul ΑΣ ΑΣ. ẖ H̱ 각 각", "<|endoftext|>a<|startoftext|>", "<|ENDOFTEXT|> <|endoftext|",
       "中文 日本語 ٣٤ ½ ² ①", "é é naïve ﬁn 👍🏽", "\x00 a\x1c b\x85 c\xa0d", "Ɓɓ Ⱥ ß ẞ ſ K", "1234 5,678.90", "_____ ====" * 50]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([*rows(), *((5000 + i, t, "a", 1, "x", "y", "z", "r") for i, t in enumerate(ODD))], SCHEMA).repartition(3)


def test_words_equal_the_library():
    words, rnd = Words(PATH), random.Random(4)
    pool = [chr(c) for c in range(0x180)] + list("  'sStTmM") * 9 + ["<|endoftext|>", "Σ", "é", "́", "가", "각", "İ", "Ɓ", "👍"]
    texts = ODD + ["".join(rnd.choices(pool, k=rnd.randrange(1, 25))) for _ in range(3000)] + [f"ab{chr(c)}cd {chr(c)} 1{chr(c)}" for c in range(0x250)]
    for t in texts:
        assert [i for w in words.split(t) for i in words.ids(w)] == words.tok.encode(t, add_special_tokens=False).ids, t


@pytest.mark.parametrize("size", [80_000_000, 3_000, 1])
def test_ids_and_texts_equal_the_library(docs, size, monkeypatch):
    """With all repeated words broadcast, with some, and with none; with few words at hand."""
    monkeypatch.setattr(word_table_bpe, "AT_HAND", 50)
    tok = Words(PATH).tok
    want = collections.Counter()
    for r in docs.collect():
        ids = tok.encode(r.text or "", add_special_tokens=False).ids
        want[r.doc_id, array.array("I", ids).tobytes(), tok.decode(ids, skip_special_tokens=False)] += 1
    got = decode(encode(docs, PATH, broadcast_bytes=size), PATH)
    assert got.columns == ["doc_id", "ids", "text"]
    assert collections.Counter((r.doc_id, bytes(r.ids), r.text) for r in got.collect()) == want


def test_each_word_is_in_the_table_once(docs, spark):
    words = Words(PATH)
    want = collections.Counter(w for r in docs.collect() for w in words.split(r.text))
    got = word_table(docs, PATH).collect()
    assert len(got) == len(want) and {r.word: r.n for r in got} == want
    assert all(array.array("H", bytes(r.ids)).tolist() == words.ids(r.word) for r in with_ids(word_table(docs, PATH), PATH, "H").collect())
    assert decode(encode(docs.limit(0), PATH), PATH).collect() == []


def test_index_tells_words_with_equal_hashes_apart(monkeypatch):
    monkeypatch.setattr(word_table_bpe.xxhash, "xxh3_64_intdigest", lambda w: len(w) % 2)
    words, ids = ["a", "bb", "c", "dddd", "é", ""], [bytes([i] * i) for i in range(6)]
    index = WordIndex(pa.table({"word": words, "n": [1, 5, 3, 2, 9, 4], "ids": ids, "hash": [len(w) % 2 for w in words]}), 2)
    assert index.find([*words, "x", "yy"]) == [*ids, None, None] and index.find([]) == []
    assert {index.at(i)[0].decode() for i in index.often} == {"é", "bb"}


def test_decoding_leaves_out_unknown_ids_and_keeps_columns(spark):
    ids = array.array("I", [49407, 5, 60000, 1000, 4_000_000_000]).tobytes()
    got = decode(spark.createDataFrame([(1, ids, "old"), (2, None, "old"), (3, b"", None)], "k int, ids binary, text string"), PATH).collect()
    tok = Words(PATH).tok
    assert [(r.k, r.text) for r in sorted(got)] == [(1, tok.decode([49407, 5, 1000], skip_special_tokens=False)), (2, ""), (3, "")]


def plain_codes(data, parts, entries, rounds):
    """Rows ``(id, code, error, label_error)`` and codebooks, by comparing everything with everything in Python's integers."""
    ok = []
    for i, v, label in data:
        if v and len(v) % parts == 0 and all(x is not None and math.isfinite(x) for x in v):
            ok.append((i, v, [n * 1024 // d for n, d in (float(x).as_integer_ratio() for x in v)], label))
    ok.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    ok = [r for r in ok if len(r[1]) == len(ok[0][1])]
    size = len(ok[0][1]) // parts
    cut = [[q[p * size:(p + 1) * size] for p in range(parts)] for _, _, q, _ in ok]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]
    for done in range(rounds + 1):
        best = [[min((sum((a - b) ** 2 for a, b in zip(c[p], e, strict=True)), j) for j, e in enumerate(books[p])) for p in range(parts)] for c in cut]
        if done < rounds:
            for p in range(parts):
                for j in {b[p][1] for b in best}:
                    mine = [c[p] for c, b in zip(cut, best, strict=True) if b[p][1] == j]
                    books[p][j] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    error = [sum(d for d, _ in b) for b in best]
    total = collections.defaultdict(list)
    for r, e in zip(ok, error, strict=True):
        total[r[3]].append(e)

    def fit(*e):
        return sum(e) if max(e) < 1 << 63 and sum(e) < 1 << 63 else None
    return [(r[0], "".join(f"{j:02x}" for _, j in b), fit(e), fit(*total[r[3]])) for r, b, e in zip(ok, best, error, strict=True)], books


def vectors(n=400, dims=8, seed=2):
    rnd = random.Random(seed)
    centres = [[rnd.gauss(0, 1) for _ in range(dims)] for _ in range(12)]
    out = [(i, [x + rnd.gauss(0, 0.2) for x in rnd.choice(centres)], rnd.choice([None, 1, 1, 1, 2])) for i in range(n)]
    out += [(i, out[5][1], 1) for i in range(n, n + 30)]  # copies
    out += [(n + 40 + i, [float(rnd.choice([-1, 0, 1])) for _ in range(dims)], 3) for i in range(60)]  # many ties
    return out + [(7, out[9][1], 2), (7, out[9][1], 2), (None, out[3][1], None), (None, [0.0] * dims, 1), (1, None, 1), (2, [None] * dims, 1),
                  (3, [math.nan] * dims, 1), (4, [math.inf] * dims, 1), (5, [], 1), (6, [1.0] * (dims - 1), 1), (6, [1.0] * (dims * 2), 1)]


@pytest.mark.parametrize("near,entries,factor", [(12, 64, 1.0), (1, 64, 1.0), (3, 16, 1e12), (3, 20, 1e300), (2, 1, 1.0), (200, 256, 1e-4)])
def test_codes_equal_the_plain_version(spark, near, entries, factor):
    data = [(i, v and [x and x * factor for x in v], label) for i, v, label in vectors()]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>, label int").withColumn("id", F.lit("x")).withColumn("v", F.lit(1)).repartition(3)
    codes, books = compress(df, entries=entries, near=near)
    want, want_books = plain_codes(data, 4, entries, 4)
    got = with_label_errors(codes).select("id", F.lower(F.hex("codes")), "error", "label_error").collect()
    assert collections.Counter(map(tuple, got)) == collections.Counter(want)
    assert [b.tolist() for b in books] == want_books
    assert books_digest(books) == hashlib.sha256(",".join(str(c) for b in want_books for e in b for c in e).encode()).hexdigest()


def test_codes_of_nothing_and_label_totals_by_join(spark, monkeypatch):
    df = spark.createDataFrame([(1, None, 1)], "vec_id long, embedding array<float>, label int")
    codes, _ = compress(df)
    assert with_label_errors(codes).collect() == []
    codes = spark.createDataFrame([(i, 1 if i % 3 else None if i % 2 else i, b"", i) for i in range(60)], "id long, label int, codes binary, error long")
    want = sorted(map(tuple, with_label_errors(codes).select("id", "label_error").collect()))
    monkeypatch.setattr(vector_codes, "BROADCAST_LABELS", 1)
    monkeypatch.setattr(vector_codes, "HOT_LABELS", 4)
    assert sorted(map(tuple, with_label_errors(codes).select("id", "label_error").collect())) == want


def test_bounds_spare_most_distances():
    rng = np.random.default_rng(1)
    x = np.floor(1000 * (rng.normal(size=(40, 16))[rng.integers(0, 40, 4000)] + 0.05 * rng.normal(size=(4000, 16)))).astype(np.int64)
    book = x[:64].copy()
    state = Bounds.scan(x, book, 8)
    for _ in range(4):
        new = book.copy()
        for j in np.unique(state.of):
            new[j] = x[state.of == j].sum(0) // (state.of == j).sum()
        drift = np.sqrt(((new - book) ** 2).sum(1)) * (1 + 1e-9)
        book = new
        state.moved(drift)
        state.settle(x, book)
        assert (state.of == squared_to_all(x, book).argmin(1)).all()
    assert (state.depth == 0).mean() > 0.5 and (state.depth > 8).mean() < 0.2


FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def plain_manifest(data):
    """Rows ``(doc_id, leaf, subroot, root, proof, folded)`` of dictionaries, by building whole trees in lists."""
    def h(*parts):
        return hashlib.sha256("".join(parts).encode()).hexdigest()

    def leaf(r, text):
        return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in [*(r[c] for c in FIELDS[:-1]), text]))

    def tree(nodes):
        at, paths = list(range(len(nodes))), [[] for _ in nodes]
        while len(nodes) > 1:
            for k, i in enumerate(at):
                run = nodes[i // 3 * 3:i // 3 * 3 + 3]
                paths[k].append((run[:i % 3], run[i % 3 + 1:]))
                at[k] = i // 3
            nodes = [h(*nodes[i:i + 3]) for i in range(0, len(nodes), 3)]
        return nodes[0], paths

    groups = collections.defaultdict(list)
    for r in data:
        groups[r["source"]].append((r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"]), r))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = [(sorted(groups[s], key=lambda x: x[:3]), *tree([x[2] for x in sorted(groups[s], key=lambda x: x[:3])])) for s in order]
    root, above = tree([t[1] for t in trees])
    out = []
    for (members, subroot, paths), up in zip(trees, above, strict=True):
        for (_, _, own, r), path in zip(members, paths, strict=True):
            node = own
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0:
                node = leaf(r, None if r["text"] is None else r["text"].replace("\n", ""))
            for before, after in path + up:
                node = h(*before, node, *after)
            out.append((r["doc_id"], own, subroot, root, h(*(x for b, a in path + up for x in b + a)), node))
    return out


def manifest(docs):
    fields = [F.col(c) for c in FIELDS[:-1]]
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, leaf_digest(*fields, F.translate("text", "\n", "")))
    p = prove(docs.select("doc_id", "source", "root", leaf_digest(*fields, F.col("text")).alias("leaf"), tampered.alias("tampered")))
    return p.select("doc_id", "leaf", "subroot", "root", proof(F.col("path")), folded(F.coalesce("tampered", "leaf"), F.col("path")))


@pytest.mark.parametrize("which", ["hard", "large", "one source", "many sources", "one row"])
def test_manifest_equals_the_plain_version(spark, which):
    data = [{"doc_id": r[0], "source": r[2], "lang": r[4], "n_chars": r[3], "text": r[1]} for r in rows()]
    if which == "large":  # trees of several buckets of levels, one of them of 3 ** 7 rows, and a large group of equal rows
        data = [{"doc_id": i, "source": "a" if i < 2187 else "é" if i < 2500 else None, "lang": "x", "n_chars": 1, "text": f"{i}\n"} for i in range(2600)]
        data += [data[3]] * 300
    elif which == "one source":
        data = [{**r, "source": None} for r in data]
    elif which == "many sources":
        data = [{**data[i % 90], "source": f"s{i}"} for i in range(800)]
    elif which == "one row":
        data = data[:1]
    df = spark.createDataFrame([tuple(r[c] for c in FIELDS) for r in data], "doc_id long, source string, lang string, n_chars int, text string")
    got = manifest(df.withColumn("root", F.lit("clash")).repartition(3)).collect()
    assert collections.Counter(map(tuple, got)) == collections.Counter(plain_manifest(data))


def test_manifest_of_nothing(spark):
    df = spark.createDataFrame([], "doc_id long, source string, lang string, n_chars int, text string, root string")
    assert manifest(df).collect() == []
