"""Exact k nearest neighbours as a Spark join.

Reference rows go down a tree of pivots, at each node to the nearest child, and cells are split until they are no larger than
a block. Distances to the pivots give every query an upper bound for its k-th neighbour and a lower bound for every node, so a
query descends only into nodes, and is sent only to cells, that can hold one of its neighbours (triangle inequality: nothing
is missed). The tree is the one thing every task holds; TREE_BYTES bounds it. Cells it has no room to split, or that cannot be
split, and large groups of queries are dealt over several tasks by hash, so that one task never holds more than a block of each
side, however the data clump.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from farol.functions.keys import keyed_unit
from farol.functions.storage import written

#: Children of a node at most, levels at most, bytes of pivots and inner distances at most.
FAN, DEPTH, TREE_BYTES = 256, 12, 32 << 20
REFERENCE_BLOCK = 20_000
QUERY_BLOCK = 20_000
CHUNK_CELLS = 4_000_000


def distances(a: np.ndarray, b: np.ndarray, p: int) -> np.ndarray:
    """Pairwise Minkowski distances, in chunks of bounded memory, from differences so that equal rows are at 0."""
    out = np.empty((len(a), len(b)))
    step = max(1, CHUNK_CELLS // max(1, b.size))
    for at in range(0, len(a), step):
        gap = a[at:at + step, None, :] - b[None, :, :]
        out[at:at + step] = np.abs(gap).sum(axis=2) if p == 1 else np.sqrt((gap * gap).sum(axis=2))
    return out


def _estimates(a: np.ndarray, b: np.ndarray, p: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairwise distances (squared for p = 2) by a product of matrices or in single precision, and for each row of `a` a bound of their error."""
    if p == 2:
        own, other = (a * a).sum(axis=1), (b * b).sum(axis=1)
        return own[:, None] + other - 2.0 * (a @ b.T), 1e-15 * (a.shape[1] + 8) * (own + other.max())
    out = np.empty((len(a), len(b)), dtype=np.float32)
    x, y = a.astype(np.float32), np.ascontiguousarray(b.T.astype(np.float32))
    for at in range(0, len(a), 32):
        for start in range(0, len(b), 4096):  # a piece stays in the processor's cache for all dimensions
            some, cut = x[at:at + 32], y[:, start:start + 4096]
            total, gap = np.zeros((len(some), cut.shape[1]), dtype=np.float32), np.empty((len(some), cut.shape[1]), dtype=np.float32)
            for j in range(len(cut)):
                np.subtract(some[:, j, None], cut[j], out=gap)
                np.abs(gap, out=gap)
                total += gap
            out[at:at + 32, start:start + 4096] = total
    return out, 2.5e-7 * (a.shape[1] + 8) * (np.abs(a).sum(axis=1) + np.abs(b).sum(axis=1).max())


def nearest_rows(a: np.ndarray, b: np.ndarray, k: int, p: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions in `b` and distances of the k nearest rows for each row of `a`, ties to the first; k is at most the rows of `b`.

    Estimates rule out the rows that cannot be among them, whatever the rounding; the rest are measured as in `distances`.
    """
    odd, whole = np.isnan(a).any(axis=1), ~np.isnan(b).any(axis=1)
    if odd.any() and not odd.all():  # a row with a gap is at no distance from any other
        at, d = np.empty((len(a), k), dtype=int), np.empty((len(a), k))
        for part in (odd, ~odd):
            at[part], d[part] = nearest_rows(a[part], b, k, p)
        return at, d
    if not odd.any() and not whole.all() and whole.sum() >= k:  # rows with a gap come last
        at, d = nearest_rows(a, b[whole], k, p)
        return np.flatnonzero(whole)[at], d
    big = np.maximum(np.abs(a).max(initial=0.0), np.abs(b).max(initial=0.0))
    rows = None
    if big < 1e15 and a.shape[1]:  # beyond, single precision may overflow; not so for a value that is not a number either
        rough, error = _estimates(a, b, p)
        cut = np.partition(rough, k - 1, axis=1)[:, k - 1] + 2.0 * error
        rows, at = np.nonzero(rough <= cut[:, None])
    if rows is None or len(rows) * a.shape[1] > CHUNK_CELLS:
        d = distances(a, b, p)
        order = np.argsort(d, axis=1, kind="stable")[:, :k]
        return order, np.take_along_axis(d, order, axis=1)
    gap = a[rows] - b[at]
    d = np.abs(gap).sum(axis=1) if p == 1 else np.sqrt((gap * gap).sum(axis=1))
    order = np.lexsort((at, d, rows))
    first = np.searchsorted(rows, np.arange(len(a)))  # rows ascend, and so they do in `order`
    chosen = order[first[:, None] + np.arange(k)]
    return at[chosen], d[chosen]


def _stack(column: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=float) for v in column]) if len(column) else np.empty((0, 0))


def _first_copies(reference: DataFrame, k: int) -> DataFrame:
    """Of equal rows only the k smallest ids can be among k neighbours; the rest are dropped before the join.

    The limit runs before the shuffle, so a row with very many copies does not meet in one task.
    """
    place = F.row_number().over(Window.partitionBy("x").orderBy("id"))
    return reference.withColumn("__place", place).where(F.col("__place") <= k).drop("__place")


@dataclass
class PivotTree:
    """Nodes in the order they were made, the root first and without a pivot; the children of a node follow one another."""

    p: int
    pivots: np.ndarray
    children: dict[int, range] = field(default_factory=dict)
    near: np.ndarray | None = None
    far: np.ndarray | None = None
    closest: np.ndarray | None = None

    def split(self, node: int, pivots: np.ndarray) -> None:
        self.children[node] = range(len(self.pivots), len(self.pivots) + len(pivots))
        self.pivots = np.concatenate([self.pivots, pivots])

    def paths(self, x: np.ndarray) -> tuple[list[list[int]], list[list[float]]]:
        """The nodes each row comes through below the root, and its distances to their pivots."""
        path, gaps = [[] for _ in x], [[] for _ in x]
        stack = [(0, np.arange(len(x)))]
        while stack:
            node, rows = stack.pop()
            if node not in self.children or not len(rows):
                continue
            kids = self.children[node]
            d = distances(x[rows], self.pivots[kids.start:kids.stop], self.p)
            best = d.argmin(axis=1)
            for row, to, gap in zip(rows.tolist(), best.tolist(), d[np.arange(len(d)), best].tolist()):
                path[row].append(kids.start + to)
                gaps[row].append(gap)
            stack += [(kids.start + int(to), rows[best == to]) for to in np.unique(best)]
        return path, gaps

    def reachable(self, x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) of every leaf that can hold one of a row's k nearest.

        First the way to the nearest leaf: k members of the children met at one step lie within the k-th least sum of the
        distance to a child and of its members' distances to it. Then all ways that this bound leaves open.
        """
        bound, stack = np.full(len(x), np.inf), [(0, np.arange(len(x)))]
        while stack:
            node, rows = stack.pop()
            if node not in self.children or not len(rows):
                continue
            kids = self.children[node]
            d = distances(x[rows], self.pivots[kids.start:kids.stop], self.p)
            reach = (d[:, :, None] + self.closest[None, kids.start:kids.stop, :]).reshape(len(d), -1)
            bound[rows] = np.minimum(bound[rows], np.partition(reach, k - 1, axis=1)[:, k - 1] * (1 + 1e-9) + 1e-12)
            best = d.argmin(axis=1)
            stack += [(kids.start + int(to), rows[best == to]) for to in np.unique(best)]
        found_rows, found_leaves, stack = [], [], [(0, np.arange(len(x)))]
        while stack:
            node, rows = stack.pop()
            if node not in self.children:
                found_rows.append(rows)
                found_leaves.append(np.full(len(rows), node))
                continue
            kids = self.children[node]
            d = distances(x[rows], self.pivots[kids.start:kids.stop], self.p)
            least = np.maximum(0.0, np.maximum(d - self.far[kids.start:kids.stop], self.near[kids.start:kids.stop] - d)) * (1 - 1e-9)
            open_ = least <= bound[rows, None]
            stack += [(kids.start + int(to), rows[open_[:, to]]) for to in np.nonzero(open_.any(axis=0))[0]]
        return np.concatenate(found_rows), np.concatenate(found_leaves)


def _down(rows: DataFrame, tree: PivotTree) -> DataFrame:
    """Adds `path` and `gaps`; the last node of the path is the row's cell, the root (0) if there is no path."""

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            path, gaps = tree.paths(_stack(pdf["x"]))
            yield pdf.assign(path=path, gaps=gaps)

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInPandas(place, f"{fields}, path array<int>, gaps array<double>").withColumn(
        "cell", F.coalesce(F.try_element_at("path", F.lit(-1)), F.lit(0)))


def _grown(reference: DataFrame, rows: int, k: int, p: int, block: int) -> tuple[PivotTree, dict[int, int]]:
    """A tree whose cells hold at most `block` rows as far as TREE_BYTES goes, and the cells' sizes.

    A level takes one job for the sizes and one for the pivots: the rows of each large cell with the smallest digests, of which only
    some eight times the wanted number leave their tasks. Cells whose chosen rows are all alike stay as they are.
    """
    first = reference.select("x").head()
    tree, sizes, whole = PivotTree(p, np.zeros((1, len(first["x"]) if first else 0))), {0: rows}, set()
    room = max(1, TREE_BYTES // (8 * (len(tree.pivots[0]) + k + 2)))
    for depth in range(DEPTH):
        wanted = {c: min(FAN, max(2, math.isqrt(n) // 4 if depth == 0 else math.ceil(2 * n / block))) for c, n in sizes.items()
                  if c not in whole and (n > block or depth == 0 and n >= 64)}
        left = room - len(tree.pivots)
        for cell in sorted(wanted, key=lambda c: -sizes[c]):  # the largest cells first when room is short
            wanted[cell] = min(wanted[cell], max(0, left))
            left -= wanted[cell]
        wanted = {c: n for c, n in wanted.items() if n > 1}
        if not wanted:
            break
        shares = [(c, n, min(1.0, (8 * n + 32) / sizes[c])) for c, n in sorted(wanted.items())]
        table = F.broadcast(reference.sparkSession.createDataFrame(shares, "cell int, wanted int, share double"))
        place = F.row_number().over(Window.partitionBy("cell").orderBy("order", "id"))
        drawn = _down(reference.select("id", "x"), tree).withColumn("order", keyed_unit("pivot", F.col("id"))).join(table, "cell").where("order <= share")
        picked: dict[int, list] = {}
        for r in drawn.withColumn("place", place).where("place <= wanted").select("cell", "x").collect():
            picked.setdefault(r["cell"], []).append(r["x"])
        for cell in wanted:
            pivots = np.unique(np.array(picked.get(cell, []), dtype=float).reshape(-1, len(tree.pivots[0])), axis=0)
            if len(pivots) > 1:
                tree.split(cell, pivots)
            else:
                whole.add(cell)
        sizes = {r["cell"]: r["count"] for r in _down(reference.select("id", "x"), tree).groupBy("cell").count().collect()}
    return tree, sizes


def nearest_neighbours(queries: DataFrame, reference: DataFrame, k: int, p: int = 2, reference_block: int = REFERENCE_BLOCK,
                       query_block: int = QUERY_BLOCK) -> DataFrame:
    """(id, neighbour, distance, label, rank) for the k nearest reference rows of every query, ties to the smaller id.

    `queries` has (id, x array<double>), `reference` also a label; ids keep their types, query ids are unique. Two small jobs per level
    of the tree and two for its nodes run before the join.
    """
    n_reference = reference.count()
    if k > n_reference:
        raise ValueError(f"k = {k} but the reference holds {n_reference} rows")
    reference = written(_first_copies(reference.select("id", "label", "x"), k), "reference-rows")
    asked, known = (d.schema["id"].dataType.simpleString() for d in (queries, reference))
    spark = queries.sparkSession
    tree, sizes = _grown(reference, n_reference, k, p, reference_block)
    placed = _down(reference.select("id", F.col("label").cast("double").alias("label"), "x"), tree)
    on_way = placed.select(F.explode(F.arrays_zip("path", "gaps")).alias("at")).select(F.col("at.path").alias("node"), F.col("at.gaps").alias("d"))
    tree.near, tree.far, tree.closest = np.zeros(len(tree.pivots)), np.zeros(len(tree.pivots)), np.full((len(tree.pivots), k), np.inf)
    for r in on_way.groupBy("node").agg(F.min("d").alias("near"), F.max("d").alias("far")).collect():
        tree.near[r["node"]], tree.far[r["node"]] = r["near"], r["far"]
    inner = on_way.withColumn("place", F.row_number().over(Window.partitionBy("node").orderBy("d"))).where(F.col("place") <= k)
    for r in inner.collect():
        tree.closest[r["node"], r["place"] - 1] = r["d"]
    cells = sorted(sizes)
    blocks = {c: max(1, math.ceil(sizes[c] / reference_block)) for c in cells}

    def to_visits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for at in range(0, len(pdf), 1024):
                part = pdf.iloc[at:at + 1024]
                row, cell = tree.reachable(_stack(part["x"]), k)
                yield pd.DataFrame({"id": part["id"].to_numpy()[row], "x": part["x"].to_numpy()[row], "cell": cell.astype("int32")})

    visits = queries.select("id", "x").mapInPandas(to_visits, f"id {asked}, x array<double>, cell int")
    groups = {r["cell"]: math.ceil(r["count"] / query_block) for r in visits.groupBy("cell").count().collect()}
    plan = spark.createDataFrame([(c, blocks[c], groups.get(c, 1)) for c in cells], "cell int, blocks int, groups int")
    spread = lambda salt, n: F.pmod(F.xxhash64(F.lit(salt), F.col("id")), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = visits.join(F.broadcast(plan), "cell").select("id", "x", "cell", spread("q", "groups").alias("group"), every("blocks").alias("block"))
    right = placed.join(F.broadcast(plan), "cell").select("id", "x", "label", "cell", spread("r", "blocks").alias("block"), every("groups").alias("group"))

    def best_in_block(q: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
        if q.empty or r.empty:
            return pd.DataFrame({"id": [], "neighbour": [], "distance": [], "label": []})
        r = r.sort_values("id")
        ids, labels, rx, qx = r["id"].to_numpy(), r["label"].to_numpy(), _stack(r["x"]), _stack(q["x"])
        take, found, at_once = min(k, len(r)), [], max(1, CHUNK_CELLS // len(r))
        for at in range(0, len(q), at_once):
            order, d = nearest_rows(qx[at:at + at_once], rx, take, p)
            found.append(pd.DataFrame({"id": np.repeat(q["id"].to_numpy()[at:at + at_once], take), "neighbour": ids[order].ravel(),
                                       "distance": d.ravel(), "label": labels[order].ravel()}))
        return pd.concat(found)

    keys = ["cell", "block", "group"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(
        best_in_block, f"id {asked}, neighbour {known}, distance double, label double")
    rank = F.row_number().over(Window.partitionBy("id").orderBy("distance", "neighbour"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def neighbour_scores(neighbours: DataFrame, weights: str = "uniform") -> DataFrame:
    """M3: share of positive neighbours; with `distance` weighted by 1/d, where neighbours at distance 0 decide alone."""
    if weights == "uniform":
        return neighbours.groupBy("id").agg(F.avg("label").alias("score"))
    zero = F.col("distance") == 0
    inverse = F.when(~zero, F.lit(1.0) / F.col("distance"))
    sums = neighbours.groupBy("id").agg(F.count_if(zero).alias("same"), F.sum(F.when(zero, F.col("label"))).alias("same_positive"),
                                        F.sum(inverse).alias("w"), F.sum(inverse * F.col("label")).alias("wy"))
    return sums.select("id", F.when(F.col("same") > 0, F.col("same_positive") / F.col("same")).otherwise(F.try_divide("wy", "w")).alias("score"))
