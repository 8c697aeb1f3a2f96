"""BPE encoding and decoding of whole texts through a table of distinct words.

For tokenizers that never merge across the words of their pre-tokenizer. A first scan splits texts into words and
counts them in a written table ``(word, n)``. Each distinct word is encoded once: the most frequent words, as many as
``BROADCAST_BYTES`` hold, into a compact index that is broadcast. A second scan splits again and puts ids in place of words.
Where the index holds every word that occurs twice, a word that it lacks occurs nowhere else and is encoded where it
stands. Otherwise the words that it lacks leave their position open and travel as ``(row, position, word)`` to a join
with the rest of the table, encoded; their ids come back to the row and are spliced in by position. Rows with open positions are
shuffled as compressed ids, texts never. No word of the join is hot, as all that are more frequent fill the index. Decoding joins
ids with the pieces of the vocabulary, which is broadcast as it is as small as the tokenizer's file, and joins the
pieces as the library does.

Defined cases: a null or empty text, or one of white space alone, has no tokens and decodes to an empty text; null
ids and repeated rows give a row each; added strings of the tokenizer inside a text become their own ids, as the
library's default; texts of any length are encoded whole; an empty table gives no rows; when decoding, ids outside
the vocabulary are left out, as the library does; columns other than the id and the text are not read.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import find_package, staged, text_slices

#: Of the broadcast index, as a bound: three for each UTF-8 byte of a word (a byte has one id at most) and 16 for the word.
BROADCAST_BYTES = 80_000_000
#: Distinct words that a task counts before it hands them on, and words whose ids a worker holds at hand.
COUNTED, AT_HAND = 100_000, 50_000
#: Characters of text that a task splits and encodes at a time.
SLICE_CHARS = 400_000

#: The normalizer and word pattern whose quick form is known here.
QUICK_NORMALIZER = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
QUICK_WORDS = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
#: The quick form serves texts below this code point: letters there are composed already and so are their lower cases.
QUICK_BELOW = 0x180


class Words:
    """The words of texts as a tokenizer file's normalizer and pre-tokenizer make them, and the ids of a word.

    Texts of plain Latin letters are split by an equivalent pattern; all others by the library itself.
    An added string is a word of its own; no other word can equal it, as it would be split.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.tok = Tokenizer.from_file(path)
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        if any(t[k] for t in spec.get("added_tokens", []) for k in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError("added strings with rules of their own are not supported")
        steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
        if [s["type"] for s in steps] != ["Split", "ByteLevel"] or steps[1]["use_regex"] or steps[1]["add_prefix_space"] or spec.get("post_processor"):
            raise ValueError("needs a split into words followed by a plain byte level")
        self.spaced = spec.get("decoder") is None
        self.at_added = re.compile("(" + "|".join(map(re.escape, self.added)) + ")") if self.added else None
        self.byte_level = ByteLevel(add_prefix_space=False, use_regex=False)
        plain = (spec.get("normalizer") or {}).get("normalizers") == QUICK_NORMALIZER and steps[0] == {
            "type": "Split", "pattern": {"Regex": QUICK_WORDS}, "behavior": "Removed", "invert": True}
        self.quick = self._quick() if plain else None
        self.outside = re.compile(f"[^\\x00-{chr(QUICK_BELOW - 1)}]")

    @staticmethod
    def _quick() -> re.Pattern:
        def kind(initial: str) -> str:
            return "".join(re.escape(chr(c)) for c in range(QUICK_BELOW) if unicodedata.category(chr(c))[0] == initial)
        letters, numbers = kind("L"), kind("N")
        space = r"\x09-\x0d\x20\x85\xa0"
        return re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|[^{space}{letters}{numbers}]+")

    def _of_segment(self, text: str) -> list[str]:
        if self.quick is not None and (text.isascii() or not self.outside.search(text)):
            return self.quick.findall(text.lower())
        normal = self.tok.normalizer.normalize_str(text) if self.tok.normalizer else text
        return [normal[a:b] for _, (a, b) in self.tok.pre_tokenizer.pre_tokenize_str(normal)]

    def split(self, text: str | None) -> list[str]:
        if not text:
            return []
        if not any(map(text.__contains__, self.added)):
            return self._of_segment(text)
        out = []
        for i, part in enumerate(self.at_added.split(text)):
            out += [part] if i % 2 else self._of_segment(part) if part else []
        return out

    def ids(self, word: str) -> list[int]:
        if word in self.added:
            return [self.added[word]]
        return [t.id for piece, _ in self.byte_level.pre_tokenize_str(word) for t in self.tok.model.tokenize(piece)]

    def pieces(self) -> list[str | None]:
        """The piece of each id; None where there is none."""
        vocab = self.tok.get_vocab(with_added_tokens=True)
        out: list[str | None] = [None] * (max(vocab.values(), default=-1) + 1)
        for piece, i in vocab.items():
            out[i] = piece
        return out


_LOADED: dict[str, Words] = {}


def _words(path: str) -> Words:
    """Once per worker."""
    if path not in _LOADED:
        _LOADED[path] = Words(path)
    return _LOADED[path]


def word_table(docs: DataFrame, tokenizer_path: str, text: str = "text") -> DataFrame:
    """``(word, n)``: each distinct word of all texts and its occurrences."""
    find_package(docs)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, n = _words(tokenizer_path).split, Counter()

        def hand_on() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(n.keys(), pa.string()), pa.array(n.values(), pa.int64())], names=["word", "n"])
        for b in batches:
            for t in b.column(0).to_pylist():
                n.update(split(t))
                if len(n) >= COUNTED:
                    yield hand_on()
                    n.clear()
        yield hand_on()

    counted = docs.select(F.col(text).alias("t")).mapInArrow(count, "word string, n long")
    return staged(counted.groupBy("word").agg(F.sum("n").alias("n")), "bpe-words")


def with_ids(words: DataFrame, tokenizer_path: str, code: str) -> DataFrame:
    """``(word, n, ids, hash)``: the packed ids and a hash of each word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = _words(tokenizer_path).ids
        for b in batches:
            names = b.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([array(code, ids(w)).tobytes() for w in names], pa.binary()),
                 pa.array(np.fromiter(map(xxhash.xxh3_64_intdigest, names), np.uint64, len(names)).view(np.int64))], names=["word", "n", "ids", "hash"])
    return words.select("word", "n").mapInArrow(run, "word string, n long, ids binary, hash long")


def _class() -> Column:
    """Words are taken by classes of about equal frequency, 16 to a doubling: a thousand classes at most."""
    return F.floor(F.log2("n") * 16)


def _least_class(table: DataFrame, most: int) -> int:
    """The least class so that its words and all of higher ones take ``most`` bytes at the utmost."""
    size = F.sum(3 * F.octet_length("word") + 16)
    left, least = most, 1 << 20
    for r in sorted(table.groupBy(_class().alias("class")).agg(size.alias("size")).collect(), reverse=True):
        left -= r["size"]
        if left < 0:
            break
        least = r["class"]
    return least


class WordIndex:
    """Ids of words, packed: sorted hashes, words and ids in one buffer each, and the places of the most frequent words."""

    def __init__(self, words: pa.Table, at_hand: int):
        hashes = words["hash"].to_numpy().view(np.uint64)
        order = np.argsort(hashes, kind="stable")
        self.hashes, take = hashes[order], pa.array(order)
        self.names, self.name_ends = self._joined(words["word"], take)
        self.ids, self.id_ends = self._joined(words["ids"], take)
        n = words["n"].to_numpy()[order]
        self.often = np.argpartition(-n, at_hand)[:at_hand] if at_hand < len(n) else np.arange(len(n))

    @staticmethod
    def _joined(column: pa.ChunkedArray, take: pa.Array) -> tuple[bytes, np.ndarray]:
        column = column.cast(pa.large_binary()).combine_chunks().take(take)
        ends = np.concatenate([[0], np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False))]).astype(np.int64)
        data = column.buffers()[2]
        return data.to_pybytes()[:ends[-1]] if data is not None else b"", ends

    def at(self, i: int) -> tuple[bytes, bytes]:
        """A word and its ids."""
        return self.names[self.name_ends[i]:self.name_ends[i + 1]], self.ids[self.id_ends[i]:self.id_ends[i + 1]]

    def find(self, words: list[str]) -> list[bytes | None]:
        """The packed ids of each word; None where the index does not hold it."""
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
        first = np.searchsorted(self.hashes, hashes)
        held = np.append(self.hashes, 0)[first] == hashes
        held &= first < len(self.hashes)
        out: list[bytes | None] = [None] * len(words)
        for k in np.flatnonzero(held).tolist():
            i, name = int(first[k]), words[k].encode()
            while i < len(self.hashes) and self.hashes[i] == hashes[k]:  # other words may share a hash
                word, ids = self.at(i)
                if word == name:
                    out[k] = ids
                    break
                i += 1
        return out


_KNOWN: dict = {}


def _known(key: int, sent) -> tuple[dict[str, bytes], WordIndex]:
    """The most frequent words with their ids, and the index; once per worker and broadcast."""
    if _KNOWN.get("key") != key:
        index = sent.value
        _KNOWN.update(key=key, words={w.decode(): ids for w, ids in map(index.at, index.often.tolist())}, index=index)
    return _KNOWN["words"], _KNOWN["index"]


def encode(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text: str = "text",
           broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``(id_col, ids)`` of every row: its token ids as little-endian unsigned 32-bit integers."""
    find_package(docs)
    spark = docs.sparkSession
    table = word_table(docs, tokenizer_path, text)
    # Ids travel packed: in two bytes each where the vocabulary allows.
    code, kind = ("H", "<u2") if len(_words(tokenizer_path).pieces()) <= 1 << 16 else ("I", "<u4")
    least = _least_class(table, broadcast_bytes)
    whole = least <= 16  # log2(2) * 16: all words that occur twice
    least = max(least, 16) if whole else least
    kept = with_ids(table.where(_class() >= least), tokenizer_path, code)
    sent = spark.sparkContext.broadcast(WordIndex(kept.toArrow(), AT_HAND))
    key = sent._jbroadcast.id() if sent._jbroadcast is not None else 0

    def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        """``(batch, first row, last, words of the texts, their ids)`` for slices of the texts in the second column."""
        words_of, (at_hand, index) = _words(tokenizer_path), _known(key, sent)
        for b in batches:
            texts = b.column(1).to_pylist()
            for i, j in text_slices(texts, SLICE_CHARS):
                words = [words_of.split(t) for t in texts[i:j]]
                rare = list(set().union(*words).difference(at_hand))
                found = index.find(rare)
                if whole:  # the only place of each
                    found = [array(code, words_of.ids(w)).tobytes() if f is None else f for w, f in zip(rare, found, strict=True)]
                at_hand.update(zip(rare, found, strict=True))
                got = [list(map(at_hand.__getitem__, w)) for w in words]
                for w in rare:
                    del at_hand[w]
                yield b, i, j, words, got

    def four_bytes(packed: bytes) -> bytes:
        return np.frombuffer(packed, kind).astype("<u4").tobytes()

    def put_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, i, j, _, got in slices(batches):
            yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), pa.array([four_bytes(b"".join(g)) for g in got], pa.binary())], names=["id", "ids"])

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row, small = TaskContext.get().partitionId() << 33, zstandard.ZstdCompressor(1)
        for b, i, j, words, found in slices(batches):
            packed, opened = [], []
            for here, got in zip(words, found, strict=True):
                places, at = [], 0
                for p, g in enumerate(got):
                    if g is None:
                        places.append({"at": at, "word": here[p]})
                        got[p] = b""
                    else:
                        at += len(g)
                packed.append(small.compress(b"".join(got)))
                opened.append(places or None)
            n = j - i
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(row, row + n), pa.int64()), b.column(0).slice(i, n), pa.array(packed, pa.binary()),
                 pa.array(opened, pa.list_(pa.struct([("at", pa.int32()), ("word", pa.string())])))], names=["row", "id", "packed", "open"])
            row += n

    def splice(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = zstandard.ZstdDecompressor()
        for b in batches:
            out = []
            for packed, filled in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                packed = whole.decompress(packed)
                if filled:
                    parts, end = [], 0
                    for f in filled:  # in the order of their places
                        parts += [packed[end:f["at"]], f["ids"]]
                        end = f["at"]
                    packed = b"".join([*parts, packed[end:]])
                out.append(four_bytes(packed))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary())], names=["id", "ids"])

    source = docs.select(F.col(id_col).alias("id"), F.col(text).alias("t"))
    id_kind = source.schema["id"].dataType.simpleString()
    if whole:
        return source.mapInArrow(put_all, f"id {id_kind}, ids binary").withColumnRenamed("id", id_col)
    rows = staged(source.mapInArrow(put, f"row long, id {id_kind}, packed binary, open array<struct<at:int,word:string>>"), "bpe-rows")
    # ``nth`` orders the open words of a row that share a place.
    wanted = rows.select("row", F.posexplode("open").alias("nth", "o")).select("row", "nth", "o.at", "o.word")
    rest = with_ids(table.where(_class() < least), tokenizer_path, code).select("word", "ids")
    found = wanted.join(rest.hint("merge"), "word").groupBy("row").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("nth", "at", "ids"))), lambda x: F.struct(x["at"].alias("at"), x["ids"].alias("ids"))).alias("filled"))
    filled = rows.where("open IS NOT NULL").select("row", "id", "packed").join(found.hint("merge"), "row").select("id", "packed", "filled")
    closed = rows.where("open IS NULL").select("id", "packed", F.lit(None).cast(found.schema["filled"].dataType).alias("filled"))
    return filled.unionByName(closed).mapInArrow(splice, f"id {id_kind}, ids binary").withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, tokenizer_path: str, ids: str = "ids", text: str = "text") -> DataFrame:
    """All columns of ``encoded`` and ``text``: the pieces of the ids, joined as the library does without a decoder."""
    find_package(encoded)
    if not _words(tokenizer_path).spaced:
        raise ValueError("needs a tokenizer whose pieces are joined by spaces")
    vocabulary = encoded.sparkSession.sparkContext.broadcast(_words(tokenizer_path).pieces())

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pa.array(vocabulary.value, pa.large_string())
        for b in batches:
            column = b.column(b.schema.get_field_index(ids))
            # Slices bound the text that is held at a time.
            for i, j in text_slices([range(n or 0) for n in pc.binary_length(column).to_pylist()], 1_000_000):
                numbers = [np.frombuffer(x or b"", "<u4") for x in column.slice(i, j - i).to_pylist()]
                numbers = [x[x < len(pieces)] for x in numbers]
                ends = np.cumsum([0, *map(len, numbers)])
                found = pieces.take(pa.array(np.concatenate(numbers).astype(np.int64)))
                if found.null_count:
                    there = np.concatenate([[0], np.cumsum(found.is_valid().to_numpy(zero_copy_only=False))])
                    ends, found = there[ends], found.drop_null()
                joined = pc.binary_join(pa.LargeListArray.from_arrays(pa.array(ends, pa.int64()), found), pa.scalar(" ", pa.large_string())).cast(pa.string())
                yield pa.RecordBatch.from_arrays([*(c.slice(i, j - i) for c in b.columns), joined], names=[*b.schema.names, "_decoded"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema.fields)
    got = encoded.mapInArrow(join, f"{kinds}, _decoded string")
    return got.drop(text).withColumnRenamed("_decoded", text)
