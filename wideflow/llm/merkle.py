"""Merkle manifest of a table: a hash tree over each source's rows, and one over the sources' roots.

Rows are ranked within their source, and every node of a tree is labelled with the interval ``[lo, hi)`` of leaf ranks
that it covers. Levels are bucketed: a bucket of levels cuts a tree into blocks of ``SPAN`` nodes, each block being one
subtree. A block's inner nodes come from its members by runs of ``ARITY``; its top is a member of a block of the next
bucket. Ancestors are attached from the top bucket down by containment joins: a block meets the one
node of the bucket above whose interval holds its own (equal bucket number, then the interval test), so both
sides of a join hold a key once and a large source is no hot key. Within a block a leaf's
siblings at each level are the parent's nodes outside its own interval: those that end before
it starts, and those that start after it ends.

Ranks are distributed: rows are range-partitioned by source, order and hash (and place in the scan, so that equal rows
spread), and a window over the row counts of (source, partition) gives each partition's start.

Defined cases: null values are hashed as ``-``; a null source is a tree of its own, before all others; null ids order
before others; rows with equal ids are leaves each, in the order of their hashes, so repeated rows and ties give one
result however the table is split; texts of any length are hashed whole; a source of one row has that leaf as its
root, and so has a table of one source; an empty table gives no rows; other columns are carried or not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import computed_once, small_enough, staged

ARITY = 3
#: Levels in a bucket, and nodes of a block.
LEVELS = 5
SPAN = ARITY ** LEVELS
#: Up to so many starts of (source, partition) are broadcast.
BROADCAST_STARTS = 200_000

_PATH = "array<struct<before:string,after:string>>"


def digest(parts: Column) -> Column:
    return F.sha2(parts, 256)


def leaf_digest(*values: Column) -> Column:
    """Hash of a row: each value's UTF-8 byte count, a colon and the value; ``-`` for null."""
    def field(v: Column) -> Column:
        s = v.cast("string")
        return F.when(v.isNull(), "-").otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))
    return digest(F.concat(*[field(v) for v in values]))


def ranked(rows: DataFrame, tree: Column, order: list[Column]) -> DataFrame:
    """``rows`` with ``_tree`` (number of the tree in order, null first), ``_rank`` within it and ``_total``, its rows.

    ``order`` must tell all rows apart that are to keep an order on a rerun; the rest are put in scan order.
    """
    d = staged(rows.withColumn("_mk_tree", tree), "merkle-rows")
    key = [F.col("_mk_tree").asc_nulls_first(), *[c.asc_nulls_first() for c in order], F.col("_mk_tie")]
    placed = d.withColumn("_mk_tie", F.monotonically_increasing_id()).repartitionByRange(*key).sortWithinPartitions(*key)
    # Its upper bits are the partition, its lower ones the place there.
    d = staged(placed.drop("_mk_tie").withColumn("_mk_at", F.monotonically_increasing_id()), "merkle-sorted")
    d = d.withColumn("_mk_part", F.shiftright("_mk_at", 33))
    counts = staged(d.groupBy("_mk_tree", "_mk_part").agg(F.count(F.lit(1)).alias("n"), F.min("_mk_at").alias("first")), "merkle-counts")
    own = Window.partitionBy("_mk_tree")
    before = F.sum("n").over(own.orderBy("_mk_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("_mk_tree", "_mk_part", "first", F.coalesce(before, F.lit(0)).alias("before"), F.sum("n").over(own).alias("_total"))
    trees = counts.groupBy("_mk_tree").agg(F.min("_mk_part").alias("part"), F.min("first").alias("first"))
    # Trees lie in order, so the place of a tree's first row orders them; a partition counts its own.
    in_part = Window.partitionBy("part")
    trees = trees.withColumns({"nth": F.row_number().over(in_part.orderBy("first")), "of": F.count(F.lit(1)).over(in_part)})
    parts = trees.groupBy("part").agg(F.max("of").alias("of"))
    parts = parts.select("part", F.coalesce(F.sum("of").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("trees_before"))
    trees = trees.join(parts, "part").select(F.col("_mk_tree").alias("_t"), (F.col("trees_before") + F.col("nth") - 1).alias("_tree"))
    starts = starts.join(trees, F.col("_mk_tree").eqNullSafe(F.col("_t"))).select(
        F.col("_mk_tree").alias("_t"), F.col("_mk_part").alias("_p"), "first", "before", "_total", "_tree")
    starts = starts.hint("broadcast" if small_enough(counts, BROADCAST_STARTS) else "merge")
    return (d.join(starts, F.col("_mk_tree").eqNullSafe(F.col("_t")) & (F.col("_mk_part") == F.col("_p")))
            .withColumn("_rank", F.col("before") + F.col("_mk_at") - F.col("first"))
            .drop("_mk_tree", "_mk_part", "_mk_at", "_t", "_p", "first", "before"))


def _parents(level: str) -> Column:
    """The level above ``level``: the nodes of its runs."""
    return F.expr(f"""transform(sequence(0, CAST((size({level}) - 1) DIV {ARITY} AS INT)), i -> named_struct(
        'lo', {level}[i * {ARITY}].lo, 'hi', {level}[least(i * {ARITY} + {ARITY}, size({level})) - 1].hi,
        'digest', sha2(concat_ws('', transform(slice({level}, i * {ARITY} + 1, {ARITY}), k -> k.digest)), 256)))""")


def _with_levels(blocks: DataFrame) -> DataFrame:
    """Blocks with ``_l0`` (their members as nodes), ``_l1`` ... as far as the block's ``_steps`` go, null beyond."""
    d = blocks.withColumn("_l0", computed_once(F.expr("transform(_members, m -> named_struct('lo', m.lo, 'hi', m.hi, 'digest', m.digest))")))
    for i in range(LEVELS):
        # Each level is a column of its own: inlined, it would be made anew for each use.
        d = d.withColumn(f"_l{i + 1}", computed_once(F.when(F.col("_steps") > i, _parents(f"_l{i}"))))
    return d


def _climb(items: DataFrame, most: int) -> tuple[list[DataFrame], DataFrame]:
    """The written blocks of each bucket of levels, lowest first, and the tops ``(_tree, digest)`` of all trees.

    ``items``: ``(_tree, _rank, _total, lo, hi, digest, row)``; ``most`` is the greatest ``_total``.
    """
    buckets, tops = [], None
    while True:
        members = F.sort_array(F.collect_list(F.struct("_rank", "lo", "hi", "digest", "row")))
        blocks = (items.groupBy("_tree", F.floor(F.col("_rank") / SPAN).alias("_block"))
                  .agg(F.max("_total").alias("_total"), members.alias("_members")))
        steps = " + ".join(f"IF(_total > {ARITY ** i}, 1, 0)" for i in range(LEVELS))
        blocks = staged(blocks.withColumn("_steps", F.expr(steps)), f"merkle-blocks-{len(buckets)}")
        buckets.append(blocks)
        top = F.get(F.coalesce(*[F.col(f"_l{i}") for i in range(LEVELS, -1, -1)]), F.lit(0))
        done = _with_levels(blocks).select("_tree", "_block", "_total", top.alias("top"))
        ended = done.where(F.col("_total") <= SPAN).select("_tree", "top.digest")
        tops = ended if tops is None else tops.unionByName(ended)
        if most <= SPAN:
            return buckets, staged(tops, "merkle-tops")
        items = done.where(F.col("_total") > SPAN).select(
            "_tree", F.col("_block").alias("_rank"), F.ceil(F.col("_total") / SPAN).alias("_total"), "top.lo", "top.hi", "top.digest",
            F.lit(None).cast("string").alias("row"))
        most = -(-most // SPAN)


def _member_paths() -> Column:
    """The block's members, each with its siblings at every level of the block, by intervals, and the path above."""
    def joined(level: int, test: str) -> str:
        run = f"slice(_l{level}, CAST((m._rank % {SPAN}) DIV {ARITY ** (level + 1)} AS INT) * {ARITY} + 1, {ARITY})"
        return f"concat_ws('', transform(filter({run}, k -> {test}), k -> k.digest))"
    at = ", ".join(f"""IF(_steps > {i}, named_struct('before', {joined(i, "k.hi <= m.lo")}, 'after', {joined(i, "k.lo >= m.hi")}), NULL)"""
                   for i in range(LEVELS))
    return F.expr(f"""transform(_members, m -> named_struct('_rank', m._rank, 'lo', m.lo, 'hi', m.hi, 'row', m.row,
        'path', concat(filter(array({at}), p -> p IS NOT NULL), path)))""")


def _descend(buckets: list[DataFrame], anchors: DataFrame) -> DataFrame:
    """``(_tree, row, path, ...)`` of every leaf; ``anchors`` has each tree's ``path`` above its top, and what leaves inherit."""
    inherited = [c for c in anchors.columns if c not in ("_tree", "path")]
    above = None
    for blocks in reversed(buckets):
        blocks = blocks.selectExpr("*", "_members[0].lo AS _lo", "element_at(_members, -1).hi AS _hi")
        held = blocks.where(F.col("_total") <= SPAN).join(anchors, "_tree")
        if above is not None:
            up = above.select("_tree", F.col("_rank").alias("_block"), F.col("lo").alias("_up_lo"), F.col("hi").alias("_up_hi"), "path", *inherited)
            inside = blocks.where(F.col("_total") > SPAN).join(up, ["_tree", "_block"]).where("_up_lo <= _lo AND _hi <= _up_hi")
            held = held.unionByName(inside.drop("_up_lo", "_up_hi"))
        above = _with_levels(held).select("_tree", *inherited, F.explode(_member_paths()).alias("_m")).select("_tree", *inherited, "_m.*")
    return above


def prove(leaves: DataFrame, tree: str = "source", order: str = "doc_id", leaf: str = "leaf") -> DataFrame:
    """All columns of ``leaves`` (orderable types) with ``subroot``, ``root`` and ``path``.

    ``path`` has, for each level from the leaf to the root, the joined digests ``before`` and ``after`` the node in its
    run. ``leaf`` names the column of the leaf's digest. Columns already named like the new ones are replaced.
    """
    new = ("subroot", "root", "path")
    rows = leaves.select(F.struct(*[F.col(c) for c in leaves.columns if c not in new]).alias("row"), F.col(tree).alias("_tree_of"),
                         F.col(order).alias("_order"), F.col(leaf).alias("digest"))
    items = ranked(rows, F.col("_tree_of"), [F.col("_order"), F.col("digest")]).select(
        "_tree", "_rank", "_total", F.col("_rank").alias("lo"), (F.col("_rank") + 1).alias("hi"), "digest", "row")
    items = staged(items, "merkle-items")
    most, trees = items.agg(F.max("_total"), F.max("_tree") + 1).first()
    buckets, tops = _climb(items, most or 0)
    upper = tops.select(F.lit(0).cast("long").alias("_tree"), F.col("_tree").alias("_rank"), F.lit(trees or 0).cast("long").alias("_total"),
                        F.col("_tree").alias("lo"), (F.col("_tree") + 1).alias("hi"), "digest", F.col("digest").alias("row"))
    upper_buckets, root = _climb(upper, trees or 0)
    top_anchor = root.select("_tree", F.col("digest").alias("root"), F.array().cast(_PATH).alias("path"))
    anchors = _descend(upper_buckets, top_anchor).select(F.col("_rank").alias("_tree"), F.col("row").alias("subroot"), "root", "path")
    return _descend(buckets, staged(anchors, "merkle-anchors")).select("row.*", "subroot", "root", "path")


def proof(path: Column) -> Column:
    """Hash of all siblings, level by level, left to right."""
    return digest(F.concat_ws("", F.transform(path, lambda p: F.concat(p["before"], p["after"]))))


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf's digest leads to along a path."""
    return F.aggregate(path, leaf, lambda own, p: digest(F.concat(p["before"], own, p["after"])))
