"""Merkle manifest of a dataset with proofs by recomputation (operator 12).

Rows are the leaves of one tree per value of a column; the trees' roots, in
order, are the leaves of a top tree whose root stands for the table.  A run of
``arity`` consecutive nodes becomes one node while a tree has several.

Only every ``stride``-th level is written.  A proof is taken from the top
down: each aligned subtree (at most arity ** stride stored nodes) rebuilds its
missing levels from the stored ones, hands every stored node its siblings
behind the path of the subtree's own root, and forgets the rest.  So a task
holds one small subtree at every size of the table, and one tree may hold any
share of the rows.

Digests are lower-case hex SHA-256 of joined texts, digests as hex text.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import cut_lineage, discard

ARITY = 8
STRIDE = 3
PATH = "array<struct<left:string,right:string>>"
_PATH = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))


def digest(*texts: str) -> str:
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def field_text(col: Column) -> Column:
    """A field as it is hashed: ``-`` if null, else its UTF-8 bytes' number, a colon, and itself."""
    text = col.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*fields: Column) -> Column:
    return F.sha2(F.concat(*map(field_text, fields)).cast("binary"), 256)


def numbered(df: DataFrame, tree: str, order: list[str], tag: str) -> DataFrame:
    """``df`` with ``idx`` (from 0 within the tree, by ``order``) and ``total`` (the tree's rows).

    Rows are sorted by ranges, so a tree spreads over many tasks; each task's
    place in a tree follows from the counts of the tasks before it.  Rows equal
    in every sort column are told apart by their place in the input, which lets
    a range end among them.  The sorted rows are written once.
    """
    keys = [F.col(tree).asc_nulls_first(), *[F.col(c).asc_nulls_first() for c in order], F.col("_place")]
    rows = df.withColumn("_place", F.monotonically_increasing_id())
    rows = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_place")
    rows = cut_lineage(rows.withColumn("_at", F.monotonically_increasing_id()), tag)
    part = F.shiftright("_at", 33).alias("_part")
    runs = rows.groupBy(F.col(tree).alias("_of"), part).agg(F.min("_at").alias("_from"), F.count("*").alias("_n"))
    whole = Window.partitionBy("_of")
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).withColumn("total", F.sum("_n").over(whole))
    out = rows.withColumn("_p", F.shiftright("_at", 33)).join(
        runs, F.col(tree).eqNullSafe(F.col("_of")) & (F.col("_p") == F.col("_part")))
    return out.withColumn("idx", F.col("_at") - F.col("_from") + F.col("_before")) \
        .drop("_at", "_p", "_of", "_part", "_from", "_n", "_before")


def levels_of(nodes: list[str], total: int, arity: int, stride: int) -> list[list[str]]:
    """The levels of an aligned subtree, its stored nodes first; ``total``: nodes of the whole tree on that level."""
    levels = [nodes]
    while total > 1 and len(levels) <= stride:
        below = levels[-1]
        levels.append([digest(*below[i:i + arity]) for i in range(0, len(below), arity)])
        total = -(-total // arity)
    return levels


def _raise_levels(nodes: DataFrame, tree: str, arity: int, stride: int) -> DataFrame:
    """The next stored level: one node per aligned subtree; a finished tree's root stays."""
    kind = nodes.schema[tree].dataType.simpleString()

    def run(table: pa.Table) -> pa.Table:
        total, idx = table.column("total")[0].as_py(), table.column("idx").to_pylist()
        at = sorted(range(len(idx)), key=idx.__getitem__)
        hashes = table.column("node").to_pylist()
        top = levels_of([hashes[i] for i in at], total, arity, stride)[-1][0]
        for _ in range(stride):
            total = -(-total // arity)
        return pa.table({tree: table.column(tree).slice(0, 1), "idx": pa.array([idx[0] // arity ** stride], pa.int64()),
                         "total": pa.array([total], pa.int64()), "node": [top]})

    chunk = F.expr(f"idx div {arity ** stride}").alias("_chunk")
    return nodes.select(tree, "idx", "total", "node").groupBy(tree, chunk).applyInArrow(
        run, f"`{tree}` {kind}, idx long, total long, node string")


def stored_levels(leaves: DataFrame, tree: str, arity: int, stride: int, tag: str) -> list[DataFrame]:
    """Every ``stride``-th level, written, from ``leaves`` (tree, idx, total, node) to the one where each tree is one node."""
    levels = [leaves]
    while (levels[-1].agg(F.max("total")).first()[0] or 0) > 1:
        levels.append(cut_lineage(_raise_levels(levels[-1], tree, arity, stride), f"{tag}-{len(levels) * stride}"))
    return levels


def _with_paths(nodes: DataFrame, above: DataFrame, tree: str, arity: int, stride: int, carry: list[str]) -> DataFrame:
    """``nodes`` of a stored level with path and subroot, from those of the stored level above (tree, idx, path, subroot)."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return left.append_column("path", pa.array([], _PATH)).append_column("subroot", pa.array([], pa.string()))
        idx = left.column("idx").to_pylist()
        at = sorted(range(len(idx)), key=idx.__getitem__)
        hashes = left.column("node").to_pylist()
        levels = levels_of([hashes[i] for i in at], left.column("total")[0].as_py(), arity, stride)
        rest = right.column("path")[0].as_py()
        paths = [None] * len(idx)
        for place, i in enumerate(at):
            own, p = [], place
            for level in levels[:-1]:
                first = p - p % arity
                run_ = level[first:first + arity]
                own.append({"left": "".join(run_[:p - first]), "right": "".join(run_[p - first + 1:])})
                p //= arity
            paths[i] = own + rest
        subroot = pa.array([right.column("subroot")[0].as_py()] * len(idx), pa.string())
        return left.append_column("path", pa.array(paths, _PATH)).append_column("subroot", subroot)

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in nodes.select(tree, "idx", "total", "node", *carry).schema)
    below = nodes.select(tree, "idx", "total", "node", *carry, F.expr(f"idx div {arity ** stride}").alias("_chunk"))
    higher = above.select(tree, F.col("idx").alias("_chunk"), "path", "subroot")
    return below.groupBy(tree, "_chunk").cogroup(higher.groupBy(tree, "_chunk")) \
        .applyInArrow(lambda a, b: run(a.drop_columns("_chunk"), b), f"{kinds}, path {PATH}, subroot string")


def paths(levels: list[DataFrame], tree: str, roots: DataFrame, arity: int, stride: int, carry: list[str]) -> DataFrame:
    """(tree, idx, total, node, ``carry``, path, subroot) of every leaf; ``roots``: (tree, idx 0, path, subroot) of the trees' roots."""
    above = roots
    for level in levels[:0:-1]:
        above = cut_lineage(_with_paths(level, above, tree, arity, stride, []), "merkle-paths")
    return _with_paths(levels[0], above, tree, arity, stride, carry)


@dataclass
class Manifest:
    """Stored levels of the trees (``levels``) and of the top tree (``top``), and the table's ``root``."""
    tree: str
    levels: list[DataFrame]
    top: list[DataFrame]
    root: str | None
    arity: int
    stride: int

    def discard(self) -> None:
        """Delete the written levels."""
        for level in (*self.levels, *self.top):
            discard(level)


def manifest(rows: DataFrame, tree: str, order: list[str], leaf: str, carry: list[str] = (),
             arity: int = ARITY, stride: int = STRIDE) -> Manifest:
    """Build the trees over ``rows``: one tree per value of ``tree``, leaves by ``order``, then by ``leaf``.

    ``leaf`` holds each row's digest; ``carry`` columns (without any, the digest) stay with the leaves.
    Null trees and nulls in ``order`` come first and count like other values;
    repeated rows are leaves of their own; an empty table has no root.
    """
    names = {"_tree": F.col(f"`{tree}`"), "node": F.col(f"`{leaf}`")}
    names |= {f"_o{i}": F.col(f"`{c}`") for i, c in enumerate(order)}
    inner = rows.select(*[c.alias(n) for n, c in names.items()], F.struct(*[F.col(f"`{c}`") for c in carry or [leaf]]).alias("row"))
    leaves = numbered(inner, "_tree", [*[f"_o{i}" for i in range(len(order))], "node"], "merkle-sorted")
    leaves = cut_lineage(leaves.select("_tree", "idx", "total", "node", "row"), "merkle-0")
    levels = stored_levels(leaves, "_tree", arity, stride, "merkle")
    roots = levels[-1].select(F.lit(0).alias("_all"), F.col("_tree").alias("_name"), "node")
    top = stored_levels(cut_lineage(numbered(roots, "_all", ["_name"], "merkle-roots"), "merkle-top-0"), "_all", arity, stride, "merkle-top")
    found = top[-1].select("node").first()
    return Manifest(tree, levels, top, found[0] if found else None, arity, stride)


def proofs(made: Manifest) -> DataFrame:
    """(row struct of the carried columns, leaf, subroot, root, path) of every leaf.

    ``path`` goes from the leaf's run to the root's: per level the siblings to
    the left and to the right, each joined.
    """
    spark = made.levels[0].sparkSession
    start = spark.range(1).select(F.lit(0).alias("_all"), F.lit(0).cast("long").alias("idx"),
                                  F.array().cast(PATH).alias("path"), F.lit(None).cast("string").alias("subroot"))
    top = paths(made.top, "_all", start, made.arity, made.stride, ["_name"])
    roots = cut_lineage(top.select(F.col("_name").alias("_tree"), F.lit(0).cast("long").alias("idx"), "path",
                                   F.col("node").alias("subroot")), "merkle-subroots")
    out = paths(made.levels, "_tree", roots, made.arity, made.stride, ["row"])
    return out.select("row", F.col("node").alias("leaf"), "subroot", F.lit(made.root).alias("root"), "path")


def siblings_digest(path: Column) -> Column:
    """Digest of a proof: its siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), "").cast("binary"), 256)


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and a proof give."""
    return F.aggregate(path, leaf, lambda acc, s: F.sha2(F.concat(s["left"], acc, s["right"]).cast("binary"), 256))
