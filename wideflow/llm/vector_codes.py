"""Vector code compression: one codebook per part of the vectors, learned in a fixed number of exact integer rounds.

Each component x becomes the integer floor(scale * x); vectors are cut into equal consecutive parts, and each part gets
the index of its codebook's nearest entry. Every round is one job over the vectors and one small aggregate.

Most distances are never computed. With each part's assignment a round writes an upper bound of the distance to the
assigned entry, the b closest other entries with ordered lower bounds, and one outer lower bound for all the
rest. When entries move, the upper bound grows by the assigned entry's move, each lower bound shrinks by its
entry's, and the outer one by the greatest move. Where the upper bound stays strictly below all lower ones the assignment holds;
else the listed entries up to the first certain one are compared, or all if the outer bound fails too. Bounds are rounded
outwards and only rule entries out; what they leave open, ties included, is decided by integer
squared distances. b adapts: after each round it falls to the depth that served nearly all parts that the list settled.

Codebooks (entries * length numbers) pass through the driver, vectors never do. Of a round's files only the newest are kept.

Defined cases: a null vector and one with a null, NaN or infinite component are dropped, and so are empty vectors, those whose
length the parts do not divide, and those not as long as the first kept one's; null ids are kept, after all others in
order; rows that repeat an id are rows each, in the order of their vectors; with fewer rows than entries there are
fewer entries; components of any finite size are exact (integers without bound where 64 bits do not hold the distances); an
error or a label's sum that a long cannot hold is null; an empty table gives no rows; columns other than id, vector and label are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wideflow.session import fresh_path, remove_path

from .common import find_package, small_enough, staged

#: Listed entries at first and at least; the share of settled parts that the next list must serve.
NEAR, LEAST_NEAR, SERVED = 12, 2, 0.99
#: Parts whose distances to all entries are held at a time.
BLOCK = 4096
#: Relative error that bounds allow for.
SLACK = 1e-12
#: Totals of up to so many labels are broadcast; beyond, those of labels with a share above 1 / HOT_LABELS of the rows.
BROADCAST_LABELS, HOT_LABELS = 200_000, 1_000
#: 32-bit digits of a sum, where components do not fit 64-bit arithmetic.
DIGITS = 40


def quantized(v: np.ndarray, scale: int, wide: bool) -> np.ndarray:
    """floor(scale * x) of each component, as 64-bit integers or, if ``wide``, as Python's."""
    if not wide:
        return np.floor(v * scale).astype(np.int64)
    out = np.empty(v.shape, object)
    flat = out.reshape(-1)
    for i, x in enumerate(v.reshape(-1).tolist()):
        n, d = x.as_integer_ratio()
        flat[i] = n * scale // d
    return out


def squared(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows to entries of their own, ``entries[i]`` being a row's list."""
    d = x[:, None, :] - entries
    return (d * d).sum(2)


def squared_to_all(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows to all entries."""
    if x.dtype != object and len(x):
        most = max(abs(int(x.min())), abs(int(x.max())), abs(int(book.min())), abs(int(book.max())))
        if 8 * x.shape[1] * most * most < 2 ** 53:  # every sum is an integer that a double holds
            f, g = x.astype(np.float64), book.astype(np.float64)
            return ((f * f).sum(1)[:, None] - 2 * (f @ g.T) + (g * g).sum(1)[None, :]).astype(np.int64)
    out = np.empty((len(x), len(book)), x.dtype)
    for i in range(0, len(x), 128):
        out[i:i + 128] = squared(x[i:i + 128], book[None, :, :])
    return out


def _root(d2: np.ndarray) -> np.ndarray:
    if d2.dtype != object:
        return np.sqrt(d2.astype(np.float64))

    def one(v: int) -> float:
        try:
            return float(math.isqrt(v))
        except OverflowError:
            return math.inf
    return np.array([one(int(v)) for v in d2.reshape(-1)], np.float64).reshape(d2.shape)


def above(d2: np.ndarray) -> np.ndarray:
    """Distances, rounded up."""
    return (_root(d2) + (1 if d2.dtype == object else 0)) * (1 + SLACK)


def below(d2: np.ndarray) -> np.ndarray:
    """Distances, rounded down."""
    return np.minimum(_root(d2), np.finfo(np.float64).max) * (1 - SLACK)


class Bounds:
    """Assignments of one part's rows with their bounds.

    ``of``: assigned entry; ``upper``: bound of its distance; ``near``: the closest other entries in order;
    ``lower``: their bounds, and in the last column the outer one for all entries not listed.
    """

    def __init__(self, of: np.ndarray, upper: np.ndarray, near: np.ndarray, lower: np.ndarray):
        self.of, self.upper, self.near, self.lower = of, upper, near, lower
        #: How far down the list each row had to look in the last round (more than its length: all entries were compared).
        self.depth = np.full(len(of), near.shape[1] + 1, np.int64)

    @staticmethod
    def scan(x: np.ndarray, book: np.ndarray, near: int) -> Bounds:
        """By the distances to all entries."""
        near = min(near, len(book) - 1)
        of, upper = np.empty(len(x), np.int64), np.empty(len(x))
        names, lower = np.empty((len(x), near), np.int64), np.full((len(x), near + 1), np.inf)
        for i in range(0, len(x), BLOCK):
            d2 = squared_to_all(x[i:i + BLOCK], book)
            rows, at = np.arange(len(d2)), d2.argmin(1)  # the lowest index of equal ones
            of[i:i + BLOCK], upper[i:i + BLOCK] = at, above(d2[rows, at])
            d = below(d2)
            d[rows, at] = np.inf
            listed = min(near + 1, len(book) - 1)  # and one more, for the outer bound
            if listed:
                first = np.argpartition(d, listed - 1, axis=1)[:, :listed]
                first = np.take_along_axis(first, np.argsort(np.take_along_axis(d, first, 1), axis=1, kind="stable"), 1)
                names[i:i + BLOCK] = first[:, :near]
                lower[i:i + BLOCK, :listed] = np.take_along_axis(d, first, 1)
        return Bounds(of, upper, names, lower)

    def moved(self, drift: np.ndarray) -> None:
        """Loosens the bounds after entry j moved by at most ``drift[j]``."""
        with np.errstate(invalid="ignore"):
            self.upper = (self.upper + drift[self.of]) * (1 + SLACK)
            loss = np.concatenate([drift[self.near], np.full((len(self.of), 1), drift.max())], 1)
            lower = self.lower - loss
            lower -= SLACK * (np.abs(self.lower) + loss)
            lower[np.isinf(self.lower) & np.isinf(loss) | np.isnan(lower)] = -np.inf
        # An entry's bound also holds for all that follow it, so order is restored from the end.
        self.lower = np.minimum.accumulate(lower[:, ::-1], 1)[:, ::-1]

    def shortened(self, near: int) -> None:
        """Leaves a shorter list; the outer bound takes in the rest."""
        if near < self.near.shape[1]:
            self.near, self.lower = self.near[:, :near], self.lower[:, :near + 1]

    def settle(self, x: np.ndarray, book: np.ndarray) -> None:
        """Exact assignments for the book as it is now."""
        n = self.near.shape[1]
        self.depth = np.zeros(len(x), np.int64)
        open_ = np.flatnonzero(~(self.upper < self.lower[:, 0]))
        if not len(open_):
            return
        own = squared(x[open_], book[self.of[open_]][:, None, :])[:, 0]
        self.upper[open_] = above(own)
        depth = (~(self.upper[open_, None] < self.lower[open_])).sum(1)
        self.depth[open_] = depth
        cap = 1
        while cap < 2 * n:
            here = min(cap, n)
            at = np.flatnonzero((depth > cap // 2) & (depth <= here))
            cap *= 2
            if len(at):
                self._compare(open_[at], x[open_[at]], own[at], book, here)
        rest = open_[depth > n]
        if len(rest):
            new = Bounds.scan(x[rest], book, n)
            self.of[rest], self.upper[rest], self.near[rest], self.lower[rest] = new.of, new.upper, new.near, new.lower

    def _compare(self, rows: np.ndarray, x: np.ndarray, own: np.ndarray, book: np.ndarray, listed: int) -> None:
        """The assigned entry against the first listed ones, by integers."""
        names = np.concatenate([self.of[rows, None], self.near[rows, :listed]], 1)
        d2 = np.concatenate([own[:, None], squared(x, book[names[:, 1:]])], 1)
        best = d2.min(1)
        winner = np.where(d2 == best[:, None], names, len(book)).min(1)
        lower = below(d2)
        lower[names == winner[:, None]] = -np.inf  # the winner first
        order = np.argsort(lower, axis=1, kind="stable")
        self.of[rows], self.upper[rows] = winner, above(best)
        self.near[rows, :listed] = np.take_along_axis(names, order, 1)[:, 1:]
        self.lower[rows, :listed] = np.take_along_axis(lower, order, 1)[:, 1:]

    def packed(self) -> list[np.ndarray]:
        return [self.of.astype(np.uint8)[:, None], self.near.astype(np.uint8), self.upper[:, None], self.lower,
                np.minimum(self.depth, 255).astype(np.uint8)[:, None]]


def _usable(v: Column) -> Column:
    return v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def _numbers(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _bytes(rows: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in np.ascontiguousarray(rows)], pa.binary())


_STATE = ("of", "near", "upper", "lower", "depth")


def compress(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", parts: int = 4,
             entries: int = 256, rounds: int = 4, scale: int = 1024, near: int = NEAR) -> tuple[DataFrame, list[np.ndarray]]:
    """``(id, label, codes, error)`` of every kept vector, and the final codebooks by part.

    ``codes`` has a byte for each part, ``error`` is the sum of the parts' squared distances to their entries. At most 256 ``entries``.
    """
    find_package(vectors)
    spark = vectors.sparkSession
    if not 1 <= entries <= 256:
        raise ValueError("codes are bytes: 1 to 256 entries")
    v = F.col(vector_col)
    fine = vectors.where(F.coalesce(_usable(v), F.lit(False)) & (F.size(v) > 0) & (F.size(v) % parts == 0))
    kept = staged(fine.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), v.cast("array<double>").alias("v")), "codes-vectors")
    order = (F.col("id").asc_nulls_last(), F.col("v"))
    first = kept.orderBy(*order).limit(1).collect()
    size = len(first[0]["v"]) if first else parts
    kept = kept.where(F.size("v") == size)
    length = size // parts
    most = kept.agg(F.max(F.array_max(F.transform("v", lambda x: F.abs(x))))).first()[0] or 0.0
    # Twice the greatest component, squared and summed over a part, must leave room in 64 bits.
    wide = scale * most + 1 > math.isqrt(2 ** 59 // length)

    start = [r["v"] for r in kept.orderBy(*order).limit(entries).collect()]
    whole = quantized(np.array(start, np.float64).reshape(len(start), size), scale, wide)
    books = [whole[:, p * length:(p + 1) * length].copy() for p in range(parts)]

    id_kind, label_kind = (kept.schema[c].dataType.simpleString() for c in ("id", "label"))
    kinds = f"id {id_kind}, label {label_kind}, v array<double>, " + ", ".join(f"{c} binary" for c in _STATE)

    def assign(books: list[np.ndarray], drifts: list[np.ndarray] | None, held: int, listed: int):
        """A round: from nothing, or from the last round's state with lists of ``held`` entries, of which ``listed`` are kept."""
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if not b.num_rows:
                    continue
                x = quantized(_numbers(b.column(2)), scale, wide)
                old = None
                if drifts is not None:
                    def read(k: int, kind: str, width: int) -> np.ndarray:
                        return np.frombuffer(b"".join(b.column(3 + k).to_pylist()), kind).reshape(b.num_rows, parts, width)
                    old = read(0, "u1", 1), read(1, "u1", held), read(2, "<f8", 1), read(3, "<f8", held + 1)
                packed = []
                for p in range(parts):
                    mine = x[:, p * length:(p + 1) * length]
                    if old is None:
                        state = Bounds.scan(mine, books[p], listed)
                    else:
                        state = Bounds(old[0][:, p, 0].astype(np.int64), old[2][:, p, 0].copy(), old[1][:, p].astype(np.int64), old[3][:, p].copy())
                        state.moved(drifts[p])
                        state.shortened(listed)
                        state.settle(mine, books[p])
                    packed.append(state.packed())
                columns = [_bytes(np.concatenate([s[k] for s in packed], 1)) for k in range(len(_STATE))]
                yield pa.RecordBatch.from_arrays([*b.columns[:3], *columns], names=["id", "label", "v", *_STATE])
        return run

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """``(part, entry, n, sums)`` of a task's rows, sums by digits where they are wide; part -1 counts depths."""
        total = np.zeros((parts, entries, length), object if wide else np.int64)
        n, depths = np.zeros((parts, entries), np.int64), np.zeros(256, np.int64)
        for b in batches:
            if not b.num_rows:
                continue
            x = quantized(_numbers(b.column(0)), scale, wide)
            of = np.frombuffer(b"".join(b.column(1).to_pylist()), np.uint8).reshape(-1, parts)
            depths += np.bincount(np.frombuffer(b"".join(b.column(2).to_pylist()), np.uint8), minlength=256)
            for p in range(parts):
                np.add.at(total[p], of[:, p], x[:, p * length:(p + 1) * length])
                n[p] += np.bincount(of[:, p], minlength=entries)
        rows = [(p, e, int(n[p, e]), digits(total[p, e])) for p in range(parts) for e in range(entries) if n[p, e]]
        rows += [(-1, d, int(c), []) for d, c in enumerate(depths) if c]
        yield pa.RecordBatch.from_pylist([dict(zip(("part", "entry", "n", "sums"), r, strict=True)) for r in rows], schema=pa.schema(
            [("part", pa.int32()), ("entry", pa.int32()), ("n", pa.int64()), ("sums", pa.list_(pa.int64()))]))

    def digits(values: np.ndarray) -> list[int]:
        if not wide:
            return values.tolist()
        out = []
        for s in values:
            for _ in range(DIGITS - 1):
                s, r = divmod(s, 1 << 32)
                out.append(r)
            out.append(s)
        return out

    def moved(state: DataFrame) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
        """The next codebooks, how far their entries moved at most, and the parts by depth."""
        found = state.select("v", "of", "depth").mapInArrow(sums, "part int, entry int, n long, sums array<long>")
        # At most parts * entries rows, each of a codebook entry's numbers.
        digit = found.select("part", "entry", "n", F.posexplode_outer("sums").alias("at", "s"))
        rows = digit.groupBy("part", "entry", "at").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect()
        new, depths, step = [b.copy() for b in books], np.zeros(256, np.int64), DIGITS if wide else 1
        total: dict = {}
        for r in rows:
            if r["part"] < 0:
                depths[r["entry"]] = r["n"]
            else:
                k = (r["part"], r["entry"], r["at"] // step)
                total[k] = total.get(k, 0) + (r["s"] << (32 * (r["at"] % step)))
                total[k[:2]] = r["n"]
        for k, s in total.items():
            if len(k) == 3:
                new[k[0]][k[1], k[2]] = s // total[k[:2]]
        return new, [above(squared(a, b[:, None, :])[:, 0]) for a, b in zip(new, books, strict=True)], depths

    def write(df: DataFrame, name: str) -> tuple[DataFrame, str]:
        path = fresh_path(spark, name)
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path), path

    if not start:
        return kept.select("id", "label", F.lit(None).cast("binary").alias("codes"), F.lit(None).cast("long").alias("error")).limit(0), books
    listed = held = min(near, len(start) - 1)
    state, path = write(kept.mapInArrow(assign(books, None, held, listed), kinds), "codes-round")
    for _ in range(rounds):
        books, drifts, depths = moved(state)
        settled = depths[:held + 1].cumsum()
        if settled[-1]:
            listed = min(held, max(LEAST_NEAR, int(np.searchsorted(settled, SERVED * settled[-1]))))
        newer, newer_path = write(state.mapInArrow(assign(books, drifts, held, listed), kinds), "codes-round")
        remove_path(spark, path)
        state, path, held = newer, newer_path, listed

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = quantized(_numbers(b.column(2)), scale, wide)
            of = np.frombuffer(b"".join(b.column(3).to_pylist()), np.uint8).reshape(-1, parts)
            error = np.zeros(len(x), object)
            for p in range(parts):
                error += squared(x[:, p * length:(p + 1) * length], books[p][of[:, p]][:, None, :])[:, 0]
            fits = [int(e) if e < 1 << 63 else None for e in error]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(3), pa.array(fits, pa.int64())], names=["id", "label", "codes", "error"])

    codes = state.select("id", "label", "v", "of").mapInArrow(finish, f"id {id_kind}, label {label_kind}, codes binary, error long")
    return staged(codes, "codes"), books


def with_label_errors(codes: DataFrame) -> DataFrame:
    """``codes`` with ``label_error``: the error summed over all rows of equal label, nulls together."""
    total = F.when(F.count("error") == F.count(F.lit(1)), F.try_sum("error"))
    totals = codes.groupBy("label").agg(total.alias("label_error"), F.count(F.lit(1)).alias("n"))
    totals = staged(totals.withColumnRenamed("label", "_l"), "codes-labels")
    same = F.col("label").eqNullSafe(F.col("_l"))
    few = totals.drop("n")
    if small_enough(totals, BROADCAST_LABELS):
        return codes.join(F.broadcast(few), same).drop("_l")
    often = (F.col("n") * HOT_LABELS) > codes.count()
    hot = F.broadcast(totals.where(often).drop("n"))
    return codes.join(hot, same).unionByName(
        codes.join(hot, same, "left_anti").join(totals.where(~often).drop("n").hint("merge"), same)).drop("_l")


def books_digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all components, as decimal integers by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(str(c) for b in books for e in b.tolist() for c in e).encode()).hexdigest()
