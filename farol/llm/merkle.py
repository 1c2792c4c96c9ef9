"""Merkle manifest of a table as a tree of SHA-256 midstates.

A parent's hash is that of its children's hex digests, 64 bytes each, so every child is one block of the hash function. While a
parent hashes its children it keeps a copy of the state before each slot. A changed child is folded by resuming the state before
its slot with the replacement and the siblings to its right; what is left of it isn't hashed again.

Leaves are numbered within their tree in key order, and every ARITY**DEPTH consecutive ones form a block, a subtree that one task
builds and folds. The tops of blocks are the next pass's leaves. Paths go down again pass by pass: a block gets the path of its top,
so a task holds one block and one path however large the tree is. A tree in which one key holds most rows is many blocks.

Null fields hash as `-`. Rows with equal ids are ordered by leaf; a null id comes first and counts as any other. A table with one
row has that row's leaf as subroot and root; an empty table gives an empty table.
"""

from __future__ import annotations

from functools import reduce
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from farol.functions.storage import written

#: Children of a node; levels of a block.
ARITY, DEPTH = 2, 12

PATH = "array<struct<state: binary, left: binary, right: binary, kids: int>>"
BLOCK = "tree string, block bigint, n bigint, levels int, nodes binary, states binary, digest binary"


def _primes(n: int) -> list[int]:
    found: list[int] = []
    x = 2
    while len(found) < n:
        if all(x % p for p in found):
            found.append(x)
        x += 1
    return found


def _cube_root(x: int) -> int:
    low, high = 0, 1 << (x.bit_length() // 3 + 1)
    while low < high:
        mid = (low + high + 1) >> 1
        low, high = (mid, high) if mid ** 3 <= x else (low, mid - 1)
    return low


# The hash function's constants by its own rule: fractional parts of square and cube roots of the first primes.
START = np.array([isqrt(p << 64) & 0xFFFFFFFF for p in _primes(8)], np.uint32)
ROUNDS = [np.uint32(_cube_root(p << 96) & 0xFFFFFFFF) for p in _primes(64)]
_HEX = np.frombuffer("".join(f"{i:02x}" for i in range(256)).encode(), np.uint8).reshape(256, 2)


def _turn(x: np.ndarray, n: int) -> np.ndarray:
    return (x >> np.uint32(n)) | (x << np.uint32(32 - n))


def compress(states: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """SHA-256 over one 64-byte block per row: (n, 8) states and (n, 64) bytes -> (n, 8) states."""
    out = np.empty_like(states)
    for at in range(0, len(states), 4096):
        before = np.ascontiguousarray(states[at:at + 4096].T)
        w = list(np.ascontiguousarray(np.ascontiguousarray(blocks[at:at + 4096]).view(">u4").astype(np.uint32).T))
        a, b, c, d, e, f, g, h = before
        for i, k in enumerate(ROUNDS):
            if i >= 16:
                x, y = w[i - 15], w[i - 2]
                w.append(w[i - 16] + w[i - 7] + (_turn(x, 7) ^ _turn(x, 18) ^ (x >> np.uint32(3))) + (_turn(y, 17) ^ _turn(y, 19) ^ (y >> np.uint32(10))))
            t = h + (_turn(e, 6) ^ _turn(e, 11) ^ _turn(e, 25)) + (g ^ (e & (f ^ g))) + k + w[i]
            u = (_turn(a, 2) ^ _turn(a, 13) ^ _turn(a, 22)) + ((a & b) | (c & (a | b)))
            a, b, c, d, e, f, g, h = t + u, a, b, c, d + t, e, f, g
        out[at:at + 4096] = (before + np.stack([a, b, c, d, e, f, g, h])).T
    return out


def hex_block(digests: np.ndarray) -> np.ndarray:
    """(n, 32) digests as (n, 64) bytes of hex text."""
    return _HEX[digests].reshape(len(digests), 64)


def finish(states: np.ndarray, kids: np.ndarray) -> np.ndarray:
    """States after `kids` whole blocks -> (n, 32) digests."""
    ends = np.zeros((len(kids), 64), np.uint8)
    ends[:, 0] = 0x80
    ends[:, 56:] = (np.asarray(kids, np.uint64) * np.uint64(512)).astype(">u8").view(np.uint8).reshape(-1, 8)
    return compress(states, ends).astype(">u4").view(np.uint8).reshape(-1, 32)


def depth_of(n: int, arity: int, depth: int) -> int:
    """Levels of a block in a tree of n nodes: all of them if the block is the whole tree."""
    if n > arity ** depth:
        return depth
    levels = 0
    while n > 1:
        n, levels = -(-n // arity), levels + 1
    return levels


def build(digests: np.ndarray, levels: int, arity: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Nodes of each level from the leaves to the top, and for each parent the states before its slots, (parents, arity, 8)."""
    nodes, states = [digests], []
    for _ in range(levels):
        below = nodes[-1]
        parents = -(-len(below) // arity)
        kids = np.full(parents, arity)
        kids[-1] = len(below) - (parents - 1) * arity
        now, kept = np.tile(START, (parents, 1)), np.empty((parents, arity, 8), np.uint32)
        for slot in range(arity):
            kept[:, slot] = now
            has = np.flatnonzero(kids > slot)
            now[has] = compress(now[has], hex_block(below[has * arity + slot]))
        nodes.append(finish(now, kids))
        states.append(kept)
    return nodes, states


def _unpacked(row: dict, arity: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """The nodes and states of a block as `build` made them."""
    flat, held = np.frombuffer(row["nodes"], np.uint8).reshape(-1, 32), np.frombuffer(row["states"], np.uint32).reshape(-1, arity, 8)
    # The number of leaves follows from the number of nodes of all levels, which grows with it.
    low, high = 1, len(flat)
    count = lambda m: sum(-(-m // arity ** i) for i in range(row["levels"] + 1))
    while low < high:
        mid = (low + high) // 2
        low, high = (low, mid) if count(mid) >= len(flat) else (mid + 1, high)
    nodes, states, at, to = [], [], 0, 0
    for i in range(row["levels"] + 1):
        m = -(-low // arity ** i)
        nodes.append(flat[at:at + m])
        at += m
        if i:
            states.append(held[to:to + m])
            to += m
    return nodes, states


class Fold:
    """Replaced leaves on their way to the root, and the running hash of their siblings."""

    def __init__(self, values: np.ndarray):
        self.value = values
        self.proof, self.seen = np.tile(START, (len(values), 1)), np.zeros(len(values), np.int64)

    def _sibling(self, rows: np.ndarray, blocks: np.ndarray) -> None:
        self.proof[rows] = compress(self.proof[rows], blocks)
        self.seen[rows] += 1

    def through_block(self, at: np.ndarray, nodes: list[np.ndarray], states: list[np.ndarray], arity: int) -> None:
        for below, kept in zip(nodes, states):
            parent, slot = at // arity, at % arity
            kids = np.minimum(arity, len(below) - parent * arity)
            now = compress(kept[parent, slot], hex_block(self.value))
            for other in range(arity):
                rows = np.flatnonzero((other != slot) & (other < kids))
                blocks = hex_block(below[parent[rows] * arity + other])
                self._sibling(rows, blocks)
                right = other > slot[rows]
                now[rows[right]] = compress(now[rows[right]], blocks[right])
            self.value, at = finish(now, kids), parent

    def along(self, path: list[dict]) -> None:
        """The levels above the block, the same ones for all its leaves."""
        every = np.arange(len(self.value))
        for step in path:
            now = compress(np.tile(np.frombuffer(step["state"], np.uint32), (len(every), 1)), hex_block(self.value))
            for side in ("left", "right"):
                for sibling in hex_block(np.frombuffer(step[side], np.uint8).reshape(-1, 32)):
                    blocks = np.tile(sibling, (len(every), 1))
                    self._sibling(every, blocks)
                    if side == "right":
                        now = compress(now, blocks)
            self.value = finish(now, np.full(len(every), step["kids"]))

    def proof_digests(self) -> np.ndarray:
        return finish(self.proof, self.seen)


def _digests(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, 32)


def _blocks(leaves: DataFrame, arity: int, depth: int) -> DataFrame:
    """(tree, pos, n, digest) -> one row of BLOCK per subtree."""

    def make(group: pa.Table) -> pa.Table:
        group = group.sort_by("pos")
        n = group.column("n")[0].as_py()
        levels = depth_of(n, arity, depth)
        nodes, states = build(_digests(group.column("digest")), levels, arity)
        row = [group.column("tree")[0].as_py(), group.column("block")[0].as_py(), n, levels, np.concatenate(nodes).tobytes(),
               b"".join(s.tobytes() for s in states), nodes[-1][0].tobytes()]
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
        return pa.table([pa.array([v], k) for v, k in zip(row, kinds)], names=["tree", "block", "n", "levels", "nodes", "states", "digest"])

    block = F.floor(F.col("pos") / F.lit(arity ** depth)).cast("bigint").alias("block")
    return leaves.select("tree", "pos", "n", "digest", block).groupBy("tree", "block").applyInArrow(make, BLOCK)


def grow(leaves: DataFrame, arity: int = ARITY, depth: int = DEPTH) -> list[DataFrame]:
    """The tables of blocks, pass by pass; a tree's top is the one block of its last pass."""
    size, passes = arity ** depth, []
    while True:
        passes.append(written(_blocks(leaves, arity, depth), "merkle-blocks"))
        more = passes[-1].where(F.col("n") > size)
        if more.isEmpty():
            return passes
        leaves = more.select("tree", F.col("block").alias("pos"), F.ceil(F.col("n") / F.lit(size)).cast("bigint").alias("n"), "digest")


def tops(passes: list[DataFrame], arity: int, depth: int) -> DataFrame:
    """(tree, digest) of each tree's root."""
    done = [p.where(F.col("n") <= arity ** depth).select("tree", "digest") for p in passes]
    return reduce(DataFrame.unionByName, done)


def _paths(blocks: DataFrame, arity: int, depth: int) -> DataFrame:
    """Blocks with the path of their top -> (tree, pos, path) of their leaves."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                nodes, states = _unpacked(row, arity)
                first, out = row["block"] * len_of, []
                for i in range(len(nodes[0])):
                    path, at = [], i
                    for below, kept in zip(nodes, states):
                        parent, slot = divmod(at, arity)
                        kids = below[parent * arity:(parent + 1) * arity]
                        path.append({"state": kept[parent, slot].tobytes(), "left": kids[:slot].tobytes(), "right": kids[slot + 1:].tobytes(), "kids": len(kids)})
                        at = parent
                    out.append((row["tree"], first + i, path + row["path"]))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=["tree", "pos", "path"])

    step = pa.struct([("state", pa.binary()), ("left", pa.binary()), ("right", pa.binary()), ("kids", pa.int32())])
    kinds, len_of = (pa.string(), pa.int64(), pa.list_(step)), arity ** depth
    return blocks.select("tree", "block", "levels", "nodes", "states", "path").mapInArrow(run, f"tree string, pos bigint, path {PATH}")


def with_paths(passes: list[DataFrame], above: DataFrame, arity: int, depth: int) -> DataFrame:
    """The first pass's blocks, each with the path from its top to the end of `above`, (tree, path) per tree."""
    last = None
    for blocks in reversed(passes):
        path = above.select("tree", F.lit(0).cast("bigint").alias("block"), "path")
        ends = blocks.where(F.col("n") <= arity ** depth).join(path, ["tree", "block"])
        if last is not None:
            inner = last.withColumnRenamed("pos", "block")
            ends = ends.unionByName(blocks.where(F.col("n") > arity ** depth).join(inner, ["tree", "block"]))
        last, found = _paths(ends, arity, depth), ends
    return found


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """Adds pos, the place within `tree` by `order`, which tells all rows apart, and n, the rows of the tree.

    Rows are sorted by range; a row's place is its place in its range and the rows of the tree in earlier ranges.
    """
    own = Window.partitionBy("tree").orderBy("part")
    ranged = rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    placed = written(ranged.select("*", F.monotonically_increasing_id().alias("__id")), "merkle-order")
    placed = placed.withColumn("part", F.shiftright("__id", 33)).withColumn("seq", F.col("__id").bitwiseAND(F.lit((1 << 33) - 1)))
    counts = placed.groupBy("tree", "part").agg(F.count(F.lit(1)).alias("c"), F.min("seq").alias("first"))
    counts = counts.withColumn("before", F.sum("c").over(own) - F.col("c")).withColumn("n", F.sum("c").over(Window.partitionBy("tree")))
    return placed.join(counts.drop("c"), ["tree", "part"]).withColumn("pos", F.col("before") + F.col("seq") - F.col("first")).select(*rows.columns, "pos", "n")


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def manifest(leaves: DataFrame, arity: int = ARITY, depth: int = DEPTH) -> DataFrame:
    """(key, order, leaf, replaced) -> (order, leaf, subroot, root, proof_sha256, folded_root, verified).

    A tree per key, its leaves in the order of `order` and then of leaf; the roots of the trees, in the order of their keys, make one
    more tree. `leaf` and `replaced` are hex digests; folded_root is the root with `replaced` (null: the leaf) in the leaf's place.
    """
    tree = F.coalesce(F.concat(F.lit("="), F.col("key")), F.lit("-"))
    rows = written(leaves.select(tree.alias("tree"), "order", F.unhex("leaf").alias("digest"), F.unhex(F.coalesce("replaced", "leaf")).alias("value"),
                                 F.monotonically_increasing_id().alias("uid")), "merkle-leaves")
    # Equal leaves with equal order can take each other's place; the number of the written row tells them apart.
    places = numbered(rows, ["order", "digest", "uid"])
    passes = grow(places, arity, depth)
    subroots = tops(passes, arity, depth).select(F.lit("").alias("tree"), F.col("tree").alias("under"), "digest")
    top_places = written(numbered(subroots, ["under"]), "merkle-subroots")
    top_passes = grow(top_places, arity, depth)
    none = top_places.limit(1).select("tree", F.expr(f"CAST(array() AS {PATH})").alias("path"))
    top_blocks = with_paths(top_passes, none, arity, depth)
    above = top_places.select(F.col("tree").alias("t"), "pos", "under").join(_paths(top_blocks, arity, depth).withColumnRenamed("tree", "t"), ["t", "pos"])
    subs = tops(passes, arity, depth).select("tree", F.lower(F.hex("digest")).alias("subroot"))
    blocks = with_paths(passes, above.select(F.col("under").alias("tree"), "path"), arity, depth).join(subs, "tree")
    root, size = tops(top_passes, arity, depth).select(F.lower(F.hex("digest"))).first(), arity ** depth

    def fold(key, group: pa.Table, block: pa.Table) -> pa.Table:
        row = block.to_pylist()[0]
        nodes, states = _unpacked(row, arity)
        moved = Fold(_digests(group.column("value")))
        moved.through_block(group.column("pos").to_numpy() % size, nodes, states, arity)
        moved.along(row["path"])
        hexes = [pa.array([bytes(h).decode() for h in hex_block(d)], pa.string()) for d in (moved.proof_digests(), moved.value)]
        subroot = pa.array([row["subroot"]] * group.num_rows, pa.string())
        return pa.table([group.column("order"), group.column("digest"), subroot, *hexes], names=["order", "digest", "subroot", "proof_sha256", "folded_root"])

    kind = leaves.schema["order"].dataType.simpleString()
    mine = places.select("tree", "order", "pos", "digest", "value", F.floor(F.col("pos") / F.lit(size)).cast("bigint").alias("block"))
    folded = mine.groupBy("tree", "block").cogroup(blocks.groupBy("tree", "block")).applyInArrow(
        fold, f"order {kind}, digest binary, subroot string, proof_sha256 string, folded_root string")
    whole = F.lit(root[0] if root else None).cast("string")
    return folded.select("order", F.lower(F.hex("digest")).alias("leaf"), "subroot", whole.alias("root"), "proof_sha256", "folded_root",
                         (F.col("folded_root") == whole).alias("verified"))


def document_leaves(docs: DataFrame, replaced: Column) -> DataFrame:
    """The leaves of documents for `manifest`, a tree per lang in the order of doc_id. Where `replaced` holds, one is added to n_chars in the
    replacement; a null n_chars stays."""
    leaf = lambda n: F.sha2(F.concat(*[field(c) for c in (F.col("doc_id"), F.col("source"), F.col("lang"), n, F.col("text"))]), 256)
    more = (F.col("n_chars").cast("decimal(38,0)") + 1)
    return docs.select(F.col("lang").cast("string").alias("key"), F.col("doc_id").alias("order"), leaf(F.col("n_chars")).alias("leaf"),
                       F.when(F.coalesce(replaced, F.lit(False)), leaf(more)).alias("replaced"))
