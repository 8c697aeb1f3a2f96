"""Exact Jaccard similarity join on word shingles, with the components of its links.

Partition of the universe: two sets of size r and s with Jaccard similarity of at
least num / den differ in at most H = (r + s)(den - num) / (den + num) elements. When the
hash space is cut into m segments, some segment of the two must then agree. Sizes fall into
bands; a band fixes m for its sets, and larger sets that may pair with them are cut
by that band's m as well. A segment can be indexed
 * not at all (level 0),
 * by its content (level 1: a pair is found unless the segment differs), or
 * by its content and each content with one element left out (level 2: a pair is found
   unless the segment differs in two elements or more).
A pair is never missed when the levels sum to H + 1 or more. The allocation is chosen for
each band by estimated cost: index entries against the candidates that light segments
bring. Each set skips its ``skip`` lightest segments (empty ones first), and may later
leave its ``heavy`` most frequent ones; the sum pays for both twice, once for each side.

Candidates: index entries are first grouped within each map task: one representative per
signature goes to the shuffle, the others are noted under it, so a signature that many
documents share arrives once per task and never as all its documents. Each
signature thus becomes a star (or a star of stars) of pairs (centre, other).

Verification is exact. Sizes and a parity sketch (a bit for each of about as many cells as
the set has elements; two sketches never differ in more bits than their sets do in elements) rule out
most pairs; sets with equal fingerprints need no look; the rest compare whole sets, made
anew from the whole texts. Members of a signature whose star links all hold are connected,
whatever their other links. Only for signatures with members in different components, pairs across
components are looked at too, where each set first leaves its most frequent signatures
(passages that many documents share), as many as its size allows (``Plan.leave``): in blocks of members, by their sketches, and
only those that pass become rows, after a round for each component's closest pairs alone has connected most. So the components equal those of all links without making all pairs.

Defined cases: texts without words, null texts included, have an empty set and no links;
rows with a null id are returned with a null component and link with nothing; rows that
repeat an id are one node with the links of each; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import bisect
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import find_package, join_unique, small_enough, staged, text_or_empty
from .components import components
from .shingles import mix, shingle_sets

_U = np.uint64
#: Index entries that a map task groups at a time.
GROUPED = 800_000
#: Sets whose fingerprints a map task remembers to find copies early.
REMEMBERED = 200_000
#: Ids of up to so many documents are broadcast to fetch their texts; beyond it the documents are shuffled.
BROADCAST_IDS = 300_000
#: Members of a signature that are compared with as many others in one block.
BLOCK = 2_000
#: Most frequent signatures that a member may leave there, in each band; and how many bands a signature tells apart.
MOST_HEAVY, SCHEMES = 16, 128
#: Smallest signatures that each member carries along there.
LOW = 4
#: Cost of the candidates that a segment of no elements would bring, in index entries.
LIGHT_COST = 400.0
_DOC, _COPY, _ENTRY, _STAR = 0, 1, 2, 3


class Plan:
    """Bands of set sizes and the allocation of levels in each, for a similarity of num / den."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den
        self.low = [1]
        while self.low[-1] < 2 ** 31:
            self.low.append(max(self.low[-1] + 1, self.low[-1] * den * den // (num * num)))
        self.bands = [self._allocate(a, b - 1) for a, b in zip(self.low[:-1], self.low[1:], strict=True)]

    def _allocate(self, low: int, high: int) -> tuple[int, int, int, int]:
        """(segments, of them at level 2, skipped ones, heavy ones) of least cost for a band."""
        differ = (high + high * self.den // self.num) * (self.den - self.num) // (self.den + self.num)
        size, best = (low + high) / 2, None
        heavy = min(MOST_HEAVY, differ // 5)
        for skip in range(0, 9):
            for two in range(0, 4):
                m = differ + 1 + 2 * (skip + heavy) - two
                if m < 1 or two > m or 2 * (skip + heavy) > m - two:
                    continue
                mean = size / m
                # Segments with none, one or two elements are light; the skipped ones are the lightest.
                light = sum(math.exp(-mean) * mean ** j / math.factorial(j) * LIGHT_COST * 0.1 ** j for j in range(3))
                rest = max(0.0, 1 - skip / max(1e-9, (m - two) * math.exp(-mean) * (1 + mean)))
                cost = (m - two - skip) * (1 + light * rest) + two * (2 + mean) * (1 + light)
                if best is None or cost < best[0]:
                    best = cost, (m, two, skip, heavy)
        return best[1]

    def schemes(self, n: int) -> list[int]:
        """The bands by whose segments a set of n elements is cut: its own and those of smaller partners."""
        own = bisect.bisect_right(self.low, n) - 1
        least = -(-n * self.num // self.den)
        b = own
        while b > 0 and self.low[b] - 1 >= least:
            b -= 1
        return list(range(b, own + 1))

    def leave(self, divide: int = 1) -> Column:
        """How many of its signatures of a band (columns ``n``, ``band``) a member may leave, or a part of them; the fixed number for a null ``n``.

        Similar sets differ in at most H elements, so without level 2 they share m - 2 * skip - H signatures of their band or more. All members
        order signatures alike, the most frequent first, and so a side that leaves fewer than these still has the
        last of them. H is least for small sets, also within a band. Bands with level 2, or with the mark of another band, have a fixed number.
        """
        fixed, spare, high = [], [], []
        for b in range(min(len(self.bands), SCHEMES)):
            marked = self.bands[b::SCHEMES]
            m, two, skip, _ = marked[0]
            fixed.append(min(h if t else 2 * h for _, t, _, h in marked))
            spare.append("NULL" if two or len(marked) > 1 else m - 2 * skip - 1)
            high.append(self.low[b + 1] - 1)
        of_band = ["element_at(array({}), cast(band + 1 AS int))".format(", ".join(f"cast({x} AS bigint)" for x in xs)) for xs in (fixed, spare, high)]
        differ = f"(n + if(n <= {of_band[2]}, n * {self.den} div {self.num}, {of_band[2]})) * {self.den - self.num} div {self.den + self.num}"
        return F.expr(f"coalesce({of_band[1]} - {differ}, {of_band[0]}) div {divide}")

    def similar(self, shared: int, r: int, s: int) -> bool:
        return shared > 0 and shared * self.den >= self.num * (r + s - shared)

    def entries(self, s: np.ndarray) -> np.ndarray:
        """The signatures of a sorted set; their lowest bits tell the band by whose segments it was cut."""
        inner = mix(s + _U(0x632BE59BD9B4E019))
        sums = np.zeros(len(s) + 1, _U)
        np.cumsum(inner, out=sums[1:])
        out = []
        for b in self.schemes(len(s)):
            m, two, skip, _ = self.bands[b]
            # Segments are equal ranges of the hash space, so those of a sorted set are contiguous.
            cuts = np.searchsorted(s, _edges(m))
            content = sums[cuts[1:]] - sums[cuts[:-1]]
            tag = mix(np.arange(m, dtype=_U) + _U((b + 1) << 32))
            keep = np.ones(m, bool)
            if skip:
                sizes = np.diff(cuts)
                keep[two + np.argsort(sizes[two:], kind="stable")[:skip]] = False
            mark = _U(b % SCHEMES)
            out.append(mix(content[keep] * _U(0x9FB21C651E98DF25) + tag[keep]) & ~_U(SCHEMES - 1) | mark)
            if two:
                seg = np.repeat(np.arange(two), np.diff(cuts[:two + 1]))
                less = content[seg] - inner[:len(seg)]
                out.append(mix(less * _U(0x9FB21C651E98DF25) + tag[seg]) & ~_U(SCHEMES - 1) | mark)
        return np.concatenate(out)


@lru_cache(maxsize=256)
def _edges(m: int) -> np.ndarray:
    """m + 1 bounds that cut the 64-bit space into m ranges (the last bound is not reached by any cut)."""
    return np.array([(i << 64) // m for i in range(m)] + [2 ** 64 - 1], _U)


@lru_cache(maxsize=8)
def plan_for(num: int, den: int) -> Plan:
    return Plan(num, den)


_KINDS = [pa.int8(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
_NAMES = ["kind", "key", "id", "centre", "sig", "n", "info"]
_SCHEMA = "kind byte, key long, id long, centre long, sig long, n int, info binary"


def _rows(kind: int, size: int, **columns) -> pa.RecordBatch:
    arrays = [pa.array(np.full(size, kind, np.int8))]
    for name, k in zip(_NAMES[1:], _KINDS[1:], strict=True):
        c = columns.get(name)
        arrays.append(pa.nulls(size, k) if c is None else c if isinstance(c, pa.Array) else pa.array(c, k))
    return pa.RecordBatch.from_arrays(arrays, names=_NAMES)


def _stars(sig: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Signatures with their smallest ids; then (signature, centre, other) of the further ids."""
    order = np.lexsort((ids, sig))
    sig, ids = sig[order], ids[order]
    new = np.r_[True, sig[1:] != sig[:-1]]
    first = np.flatnonzero(new)
    centre = ids[first][np.cumsum(new) - 1]
    other = ~new & (ids != np.r_[ids[:1], ids[:-1]]) & (ids != centre)
    return sig[first], ids[first], sig[other], centre[other], ids[other]


def _index(k: int, num: int, den: int):
    """Documents -> their sizes and sketches, copies found early, index entries, stars found early."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan, copies = plan_for(num, den), {}
        held: list[np.ndarray] = []
        owners: list[int] = []
        size = 0

        def grouped():
            sig = np.concatenate(held).view(np.int64)
            ids = np.repeat(np.array(owners, np.int64), [len(h) for h in held])
            s, i, star, centre, other = _stars(sig, ids)
            for at in range(0, len(s), 200_000):
                x = slice(at, at + 200_000)
                yield _rows(_ENTRY, len(s[x]), key=s[x], id=i[x])
            for at in range(0, len(star), 200_000):
                x = slice(at, at + 200_000)
                yield _rows(_STAR, len(star[x]), key=mix(other[x].view(_U)).view(np.int64), id=other[x], centre=centre[x], sig=star[x])

        for b in batches:
            ids = b.column(0).to_pylist()
            n, info, same = [], [], []
            for doc, s in zip(ids, shingle_sets(b.column(1), k), strict=True):
                mark = xxhash.xxh3_128_digest(s)
                n.append(len(s))
                info.append(mark + sketch(s))
                if not len(s) or doc is None:
                    continue
                if mark in copies:
                    if copies[mark] != doc:
                        same.append((copies[mark], doc))
                    continue
                if len(copies) >= REMEMBERED:
                    copies.clear()
                copies[mark] = doc
                held.append(plan.entries(s))
                owners.append(doc)
                size += len(held[-1])
                if size >= GROUPED:
                    yield from grouped()
                    held.clear()
                    owners.clear()
                    size = 0
            key = np.array([0 if x is None else x for x in ids], np.int64)
            key = mix(key.view(_U)).view(np.int64)
            for at in range(0, len(ids), 5_000):
                x = slice(at, at + 5_000)
                yield _rows(_DOC, len(ids[x]), key=key[x], id=ids[x], n=n[x], info=info[x])
            if same:
                a, c = np.array(same, np.int64).T
                yield _rows(_COPY, len(a), key=mix(c.copy().view(_U)).view(np.int64), id=c, centre=a)
        if held:
            yield from grouped()
    return run


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by kind, key and id: the entries of a signature become a star, other rows pass."""
    key = centre = None
    for b in batches:
        kinds = b.column(0).to_numpy()
        at = kinds == _ENTRY
        if not at.all():
            yield b.filter(pa.array(~at))
        if not at.any():
            continue
        e = b.filter(pa.array(at))
        sig, ids = e.column(1).to_numpy(), e.column(2).to_numpy()
        new = np.r_[key is None or key != sig[0], sig[1:] != sig[:-1]]
        first = np.r_[[0 if centre is None else centre], ids[new]][np.cumsum(new)]
        key, centre = sig[-1], first[-1]
        other = ~new & (ids != first) & np.r_[True, (ids[1:] != ids[:-1]) | (sig[1:] != sig[:-1])]
        if other.any():
            yield _rows(_STAR, int(other.sum()), key=sig[other], id=ids[other], centre=first[other], sig=sig[other])


def sketch(s: np.ndarray) -> bytes:
    """A bit for each cell: whether an odd number of elements fall into it; cells are a power of two."""
    cells = max(256, 1 << max(0, len(s) - 1).bit_length())
    odd = np.bincount((s & _U(cells - 1)).astype(np.int64), minlength=cells) & 1
    return np.packbits(odd.astype(bool), bitorder="little").tobytes()


def _folded(x: np.ndarray, width: int) -> np.ndarray:
    """Sketches (rows of bytes) as those of fewer cells."""
    return np.bitwise_xor.reduce(x.reshape(len(x), -1, width), axis=1)


def _apart(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """In how many bits the rows differ; widths are multiples of 8."""
    return np.bitwise_count(x.view(_U) ^ y.view(_U)).sum(1, dtype=np.int64)


def _sketched(num: int, den: int):
    """Pairs with both sizes and infos -> those that may be similar; ``same`` where the sets are equal."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            r, s = (b.column(i).to_numpy().astype(np.int64) for i in (2, 3))
            x, y = (b.column(i).to_pylist() for i in (4, 5))
            same = np.array([u[:16] == v[:16] for u, v in zip(x, y, strict=True)])
            apart = np.zeros(len(r), np.int64)
            widths = np.array([(len(u) - 16, len(v) - 16) for u, v in zip(x, y, strict=True)])
            for w in np.unique(widths, axis=0):
                at = np.flatnonzero((widths == w).all(1))
                u, v = (np.frombuffer(b"".join(z[i][16:] for i in at), np.uint8).reshape(len(at), -1) for z in (x, y))
                apart[at] = _apart(_folded(u, w.min()), _folded(v, w.min()))
            may = same | (apart * (den + num) <= (r + s) * (den - num))
            yield pa.RecordBatch.from_arrays([b.column(0).filter(pa.array(may)), b.column(1).filter(pa.array(may)), pa.array(same[may])],
                                             names=["a", "b", "same"])
    return run


def _across(num: int, den: int, only_best: bool, at_once: int = 100_000):
    """Sorted members (sig, i, j, part, id, c, n, info, low) of blocks -> pairs (a, b) of different components that
    sizes and sketches leave possible; with ``only_best``, of those looked at together each component's
    closest pair alone. A block (i, j) has parts i and j of a signature's members. ``low`` has a member's
    smallest signatures: a pair that shares a smaller one than this is left to that one's block."""
    def pairs_of(part: np.ndarray, i: int, j: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        if i == j:
            left = right = np.arange(len(part))
        else:
            left, right = np.flatnonzero(part == i), np.flatnonzero(part == j)
        step = max(1, at_once // max(1, len(right)))
        for k in range(0, len(left), step):
            x, y = np.repeat(left[k:k + step], len(right)), np.tile(right, len(left[k:k + step]))
            yield (x[x < y], y[x < y]) if i == j else (x, y)

    def checked(rows: list, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ids, c, n, info, low, sig = rows
        fine = (c[x] != c[y]) & (ids[x] != ids[y]) & (np.minimum(n[x], n[y]) * den >= np.maximum(n[x], n[y]) * num)
        x, y = x[fine], y[fine]
        elsewhere = np.zeros(len(x), bool)
        for k in range(LOW):
            mine = low[x, k]
            elsewhere |= (mine < sig[x]) & (low[y] == mine[:, None]).any(1)
        x, y = x[~elsewhere], y[~elsewhere]
        width = np.array([len(z) for z in info])
        far = np.full(len(x), np.inf)  # of the sketches, against the sizes
        for w in np.unique(np.c_[width[x], width[y]], axis=0) if len(x) else ():
            at = np.flatnonzero((width[x] == w[0]) & (width[y] == w[1]))
            width_now = w.min() - 16
            sides = []
            for side, wide in ((x[at], w[0]), (y[at], w[1])):
                used, where = np.unique(side, return_inverse=True)
                raw = np.frombuffer(b"".join(info[k][16:] for k in used), np.uint8).reshape(len(used), wide - 16)
                sides.append((_folded(raw, width_now), where))
            for k in range(0, len(at), at_once):
                u, v = (m[q[k:k + at_once]] for m, q in sides)
                size = n[x[at[k:k + at_once]]] + n[y[at[k:k + at_once]]]
                far[at[k:k + at_once]] = _apart(u, v) * (den + num) / (size * (den - num))
        keep = np.flatnonzero(far <= 1)
        if only_best and len(keep):
            keep = keep[np.argsort(far[keep], kind="stable")]
            keep = keep[np.unique(np.r_[np.unique(c[x[keep]], return_index=True)[1], np.unique(c[y[keep]], return_index=True)[1]])]
        return np.minimum(ids[x[keep]], ids[y[keep]]), np.maximum(ids[x[keep]], ids[y[keep]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()

        def block(parts: list[pa.RecordBatch]) -> list[pa.RecordBatch]:
            """Whole blocks, together: their pairs are made and looked at in steps."""
            t = pa.Table.from_batches(parts)
            sig, i, j, part, ids, c, n = (t.column(k).to_numpy() for k in range(7))
            low = np.full((len(sig), LOW), np.iinfo(np.int64).max)
            for k, v in enumerate(t.column(8).to_pylist()):
                low[k, :len(v)] = v
            rows = ids, c, n.astype(np.int64), t.column(7).to_pylist(), low, sig
            start = np.flatnonzero(np.r_[True, (sig[1:] != sig[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])])
            out, xs, ys, held = [], [], [], 0

            def flush():
                a, d = checked(rows, np.concatenate(xs), np.concatenate(ys))
                new = [p for p in set(zip(a.tolist(), d.tolist(), strict=True)) if p not in seen]
                if len(seen) > 100_000:
                    seen.clear()
                seen.update(new)
                if new:
                    a, d = zip(*new, strict=True)
                    out.append(pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(d, pa.int64())], names=["a", "b"]))

            for lo, hi in zip(start, np.r_[start[1:], len(sig)], strict=True):
                for x, y in pairs_of(part[lo:hi], i[lo], j[lo]):
                    xs.append(x + lo)
                    ys.append(y + lo)
                    held += len(x)
                    if held >= 3 * at_once:
                        flush()
                        xs, ys, held = [], [], 0
            if xs:
                flush()
            return out

        held: list[pa.RecordBatch] = []
        for b in batches:
            # The last block of a batch may go on in the next one.
            sig, i, j = (b.column(k).to_numpy() for k in range(3))
            ends = np.flatnonzero((sig[1:] != sig[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1]))
            if held and b.num_rows:
                last = held[-1]
                if any(last.column(k)[-1].as_py() != b.column(k)[0].as_py() for k in range(3)):
                    yield from block(held)
                    held = []
            if len(ends):
                cut = int(ends[-1]) + 1
                yield from block([*held, b.slice(0, cut)])
                held = [b.slice(cut)]
            elif b.num_rows:
                held.append(b)
        if held:
            yield from block(held)
    return run


def _verified(k: int, num: int, den: int):
    """Pairs with both texts -> the similar ones."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = plan_for(num, den)
        for b in batches:
            hold = [plan.similar(len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y))
                    for x, y in zip(shingle_sets(b.column(2), k), shingle_sets(b.column(3), k), strict=True)]
            yield b.select([0, 1]).filter(pa.array(hold, pa.bool_()))
    return run


def similar_components(docs: DataFrame, id_col: str = "doc_id", text: str = "text", words: int = 5,
                       similarity: tuple[int, int] = (4, 5)) -> DataFrame:
    """``(id_col, n_shingles, component_id)`` of each row of ``docs``.

    Two documents are linked when the Jaccard similarity of their sets of ``words``-word
    shingles is at least ``similarity`` (numerator, denominator); ``component_id`` is the
    smallest id that links reach.
    """
    find_package(docs)
    num, den = similarity
    texts = docs.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text).alias("t"))
    found = staged(texts.mapInArrow(_index(words, num, den), _SCHEMA).repartition("key")
                   .sortWithinPartitions("kind", "key", "id").mapInArrow(_gather, _SCHEMA), "jaccard-found")
    infos = found.where(F.col("kind") == _DOC).select("id", "n", "info")
    known = infos.where("id IS NOT NULL")
    copies = found.where(F.col("kind") == _COPY).select(F.col("centre").alias("a"), F.col("id").alias("b"))
    stars = found.where(F.col("kind") == _STAR).select("sig", "centre", "id")

    def verify(pairs: DataFrame) -> DataFrame:
        """The similar ones of distinct pairs (a, b), written."""
        sized = (pairs.join(known.select(F.col("id").alias("a"), F.col("n").alias("r"), F.col("info").alias("x")), "a")
                 .join(known.select(F.col("id").alias("b"), F.col("n").alias("s"), F.col("info").alias("y")), "b")
                 .where(f"least(r, s) * {den} >= greatest(r, s) * {num}").select("a", "b", "r", "s", "x", "y"))
        maybe = staged(sized.mapInArrow(_sketched(num, den), "a long, b long, same boolean"), "jaccard-maybe")
        open_pairs = maybe.where("NOT same").select("a", "b").distinct()
        ids = staged(open_pairs.select(F.col("a").alias("id")).union(open_pairs.select(F.col("b").alias("id"))).distinct(), "jaccard-ids")
        side = F.broadcast(ids) if small_enough(ids, BROADCAST_IDS) else ids
        needed = texts.join(side, "id", "left_semi")
        both = (open_pairs.join(needed.select(F.col("id").alias("a"), F.col("t").alias("p")), "a")
                .join(needed.select(F.col("id").alias("b"), F.col("t").alias("q")), "b").select("a", "b", "p", "q"))
        links = both.mapInArrow(_verified(words, num, den), "a long, b long").union(maybe.where("same").select("a", "b"))
        return staged(links, "jaccard-links")

    def labelled(pairs: DataFrame, labels: DataFrame) -> DataFrame:
        """``pairs`` with the components ``ca`` and ``cb`` of their sides."""
        for side in "ab":
            to = labels.select(F.col("id").alias(side), F.col("component").alias(f"c{side}"))
            pairs = pairs.join(to, side, "left").withColumn(f"c{side}", F.coalesce(f"c{side}", side))
        return pairs

    def merged(labels: DataFrame, links: DataFrame) -> DataFrame:
        """Components after further links: those of the graph whose nodes are the components so far."""
        to = components(labelled(links, labels).select(F.col("ca").alias("a"), F.col("cb").alias("b")))
        to = to.select(F.col("id").alias("component"), F.col("component").alias("to"))
        old = join_unique(labels, to, "component", "left").select("id", F.coalesce("to", "component").alias("component"))
        new = to.select(F.col("component").alias("id"), F.col("to").alias("component")).join(labels, "id", "left_anti")
        return staged(old.union(new), "jaccard-labels")

    # First the centre that shares most signatures with a document; that settles most groups.
    pairs = staged(stars.groupBy(F.col("centre").alias("a"), F.col("id").alias("b")).agg(F.count("*").alias("shared")), "jaccard-pairs")
    tried = staged(pairs.groupBy("b").agg(F.max(F.struct("shared", -F.col("a"))).alias("m"))
                   .select((-F.col("m.col2")).alias("a"), "b"), "jaccard-first")
    links = copies.union(verify(tried))
    labels = staged(components(links), "jaccard-labels")
    # Then the other star pairs that are not connected yet.
    rest = staged(labelled(pairs.join(tried, ["a", "b"], "left_anti").select("a", "b"), labels).where("ca <> cb").select("a", "b"), "jaccard-rest")
    if not rest.isEmpty():
        labels = merged(labels, verify(rest))
    # Then pairs across components of the signatures whose members are in several: first, for a part of the
    # signatures, each component's closest, which settles most; then all that are left, for all signatures.
    tried = pairs.select("a", "b")
    for only_best in (True, False):
        near = stars.where(F.pmod(F.shiftright("sig", 7), F.lit(8)) == 0) if only_best else stars  # above the band
        loose = staged(labelled(pairs.select("a", "b"), labels).where("ca <> cb").select("a", "b"), "jaccard-loose")
        split = staged(near.join(loose, (F.col("centre") == F.col("a")) & (F.col("id") == F.col("b"))).select("sig").distinct(), "jaccard-split")
        if split.isEmpty():
            continue
        # By signature: its members, once each, and their number.
        members = (near.join(split.hint("merge"), "sig", "left_semi").select("sig", F.explode(F.array("centre", "id")).alias("id"))
                   .dropDuplicates(["sig", "id"]).withColumn("k", F.count("*").over(Window.partitionBy("sig"))))
        # By member: it leaves its most frequent signatures of each band (the plan's levels allow for that), and
        # gets its smallest ones of the others. An id of several sizes leaves what any size may.
        sizes = known.groupBy("id").agg(F.when(F.min("n") == F.max("n"), F.min("n").cast("long")).alias("n"))
        rank = F.row_number().over(Window.partitionBy("id", "band").orderBy(F.desc("k"), "sig"))
        own = Window.partitionBy("id").orderBy("sig").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        members = (members.join(sizes, "id").withColumn("band", F.col("sig").bitwiseAND(SCHEMES - 1))
                   .withColumn("rank", rank).where(F.col("rank") > plan_for(num, den).leave(8 if only_best else 1))
                   .withColumn("low", F.array_compact(F.array(*[F.nth_value("sig", n + 1).over(own) for n in range(LOW)]))))
        members = staged(members.select("sig", "id", "low"), "jaccard-members")
        # Signatures that several members keep: those members with their components, sizes and sketches.
        several = members.groupBy("sig").agg(F.count("*").alias("k")).where("k > 1")
        members = (join_unique(members, several, "sig").join(known, "id").join(labels, "id", "left")
                   .withColumn("c", F.coalesce("component", "id")))
        # By block: parts of a signature's members against each other.
        parts = F.ceil(F.col("k") / BLOCK).cast("int")
        parted = (members.withColumn("part", F.pmod(F.xxhash64("id"), parts).cast("int"))
                  .withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1))))
        across = (parted.select("sig", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "part", "id", "c", "n", "info", "low")
                  .repartition("sig", "i", "j").sortWithinPartitions("sig", "i", "j", "id")
                  .mapInArrow(_across(num, den, only_best), "a long, b long")
                  .distinct().join(tried, ["a", "b"], "left_anti"))
        across = staged(across, "jaccard-across")
        if not across.isEmpty():
            labels = merged(labels, verify(across))
            tried = tried.union(across)
    return (infos.join(labels, "id", "left")
            .select(F.col("id").alias(id_col), F.col("n").cast("long").alias("n_shingles"),
                    F.coalesce("component", "id").alias("component_id")))
