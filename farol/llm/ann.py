"""Approximate nearest neighbours by largest inner product: inverted lists scanned in blocks of rotated columns.

An extra column makes all candidates equally long, so the largest inner product is the smallest distance. Vectors are then
turned by a random rotation, after which the distance over the first d columns, scaled up, estimates the whole distance with an
error that falls with the root of d. In each probed list a candidate is left as soon as that estimate rejects, beyond a
stated significance, that it lies within the query's radius: the distance to its k-th nearest vector in a bounded sample.
What is left is measured again on the original vectors in double precision.

Centres, rotation and radii come from a sample of at most SAMPLE rows; every row is indexed. The number of probed lists is the
smallest that finds RECALL of the sample's own neighbours at the depth that corresponds to k in the whole table.

Vectors that are null, zero or hold null or non-finite numbers take no part, nor do those of another length than most
(the shorter of equally frequent ones), nor rows without an id. A query never finds a row of its own id. Repeated rows are
candidates each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from farol.functions.storage import written
from farol.llm import kit

#: Bound of the sample, sought recall on it, significance of the test, columns looked at between two tests.
SAMPLE, RECALL, SIGNIFICANCE, COLUMNS = 4096, 0.97, 2.1, 16
#: Most lists; rows of candidates that a task keeps, queries it treats at a time.
LISTS, BLOCK, QUERIES = 1024, 131072, 64
#: Groups of candidates at least; each returns k rows per query that probes it, so their number follows the rows, not the session.
GROUPS = 12


def usable(vector: Column) -> Column:
    number = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & number & F.exists(vector, lambda x: x != 0)


def _matrix(vectors) -> np.ndarray:
    return np.array(vectors, np.float64).reshape(len(vectors), -1)


class Index:
    """Rotation, centres, the common length, and how many lists a query probes."""

    def __init__(self, sample: np.ndarray, longest: float, rows: int, k: int):
        rng = np.random.default_rng(7)
        d = sample.shape[1] + 1
        self.longest = longest
        self.rotation = np.linalg.qr(rng.standard_normal((d, d)))[0].astype(np.float32)
        self.sample = self.place(sample)
        n = int(min(LISTS, max(1, np.sqrt(rows) / 2), max(1, len(sample) // 8)))
        self.centres = self._centres(self.sample, n, rng)
        self.probes = self._probes(sample, rows, k)

    def place(self, x: np.ndarray) -> np.ndarray:
        """Candidates: padded to the common length, then rotated."""
        pad = np.sqrt(np.maximum(self.longest**2 - (x * x).sum(axis=1), 0.0))
        return (np.column_stack([x, pad]).astype(np.float32)) @ self.rotation

    def turn(self, q: np.ndarray) -> np.ndarray:
        """Queries: the extra column is zero."""
        return np.column_stack([q, np.zeros(len(q))]).astype(np.float32) @ self.rotation

    def distances(self, q: np.ndarray, x: np.ndarray) -> np.ndarray:
        return (q * q).sum(axis=1)[:, None] + (x * x).sum(axis=1)[None, :] - 2.0 * q @ x.T

    def _centres(self, x: np.ndarray, n: int, rng) -> np.ndarray:
        distinct = np.unique(x, axis=0)
        centres = distinct[rng.choice(len(distinct), min(n, len(distinct)), replace=False)]
        for _ in range(8):
            home = self.distances(x, centres).argmin(axis=1)
            sums = np.zeros_like(centres)
            np.add.at(sums, home, x)
            count = np.bincount(home, minlength=len(centres))[:, None]
            centres = np.where(count > 0, sums / np.maximum(count, 1), centres).astype(np.float32)
        return centres

    def _probes(self, sample: np.ndarray, rows: int, k: int) -> int:
        some = sample[:256]
        depth = max(1, round(k * len(sample) / max(rows, 1)))
        truth = some @ sample.T
        np.fill_diagonal(truth, -np.inf)
        near = np.argsort(-truth, axis=1)[:, :depth]
        home = self.distances(self.sample, self.centres).argmin(axis=1)
        order = np.argsort(self.distances(self.turn(some), self.centres), axis=1, kind="stable")
        place = np.argsort(order, axis=1)
        needed = np.sort(np.take_along_axis(place, home[near], axis=1).ravel())
        return int(needed[min(len(needed) - 1, int(np.ceil(RECALL * len(needed))))]) + 1

    def radius(self, turned: np.ndarray, q: np.ndarray, k: int) -> np.ndarray:
        """Squared distance to the k-th nearest of the sample; one more is asked for, as the query itself may be in it."""
        if len(self.sample) <= k:
            return np.full(len(q), np.inf)
        return np.partition(self.distances(turned, self.sample), k, axis=1)[:, k]

    def probed(self, turned: np.ndarray) -> np.ndarray:
        """One byte per list, 1 if the query probes it."""
        near = np.argsort(self.distances(turned, self.centres), axis=1, kind="stable")[:, :self.probes]
        out = np.zeros((len(turned), len(self.centres)), np.uint8)
        np.put_along_axis(out, near, 1, axis=1)
        return out


def rebuilt(parts: dict) -> Index:
    """An index from the arrays that were sent."""
    index = Index.__new__(Index)
    index.__dict__.update(parts)
    return index


def scan(turned: np.ndarray, probed: np.ndarray, radius: np.ndarray, placed: np.ndarray, lists: np.ndarray, longest: float, k: int) -> list[np.ndarray]:
    """For each query the candidates that no test has rejected, column block by column block. A test that would leave fewer than k is void."""
    alive = probed[:, lists].astype(bool)
    columns = np.flatnonzero(alive.any(axis=0))
    alive, d = alive[:, columns], turned.shape[1]
    partial = np.zeros(alive.shape, np.float32)
    slack = 1e-5 * ((turned * turned).sum(axis=1) + longest**2) + 1e-12
    for start in range(0, d, COLUMNS):
        end = min(d, start + COLUMNS)
        q, x = turned[:, start:end], placed[columns, start:end]
        partial += (q * q).sum(axis=1)[:, None] + (x * x).sum(axis=1)[None, :] - 2.0 * q @ x.T
        allowed = (1.0 + SIGNIFICANCE / np.sqrt(end)) ** 2 if end < d else 1.0
        kept = alive & (partial * (d / end) <= (allowed * radius + slack)[:, None])
        alive = np.where((kept.sum(axis=1) >= k)[:, None], kept, alive)
        left = alive.any(axis=0)
        if not left.all():
            columns, alive, partial = columns[left], alive[:, left], partial[:, left]
    return [columns[a] for a in alive]


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, sample: int = SAMPLE) -> DataFrame:
    """(vec_id, embedding) both -> (query_id, rank, vec_id, score): the k nearest found, ties to the smaller vec_id.

    Candidates are dealt by list into groups of at most about BLOCK rows, a large list into several; a task keeps one group and streams past it the
    queries that probe one of its lists.
    """
    spark = vectors.sparkSession
    # Scores are of the original numbers: singles stay singles, everything else is read as doubles. Only rotated copies are rounded.
    singles = isinstance(vectors.schema["embedding"].dataType.elementType, FloatType)
    kind, number = ("float", np.float32) if singles else ("double", np.float64)
    clean = lambda df: df.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast(f"array<{kind}>").alias("v")).where(
        F.col("vec_id").isNotNull() & usable(F.col("v")))
    empty = spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    length = clean(vectors).groupBy(F.size("v").alias("d")).agg(
        F.count(F.lit(1)).alias("n"), F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x)).alias("m")).orderBy(F.desc("n"), "d").first()
    if length is None:
        return empty
    d, rows = length["d"], length["n"]
    fitting = lambda df: clean(df).where(F.size("v") == d)
    picked = [r["v"] for r in fitting(kit.sample_by_id(vectors, "vec_id", sample)).orderBy("vec_id").limit(2 * sample).toLocalIterator()]
    index = Index(_matrix(picked) if picked else np.zeros((1, d)), float(np.sqrt(length["m"])), rows, k)
    shared = spark.sparkContext.broadcast(vars(index))

    def placing():
        at = rebuilt(shared.value)

        def work(columns):
            x = _matrix(columns[1])
            placed = at.place(x)
            home = at.distances(placed, at.centres).argmin(axis=1)
            return [columns[0], home.tolist(), [p.tobytes() for p in placed], [v.astype(number).tobytes() for v in x]]

        return work

    listed = written(kit.map_rows(fitting(vectors), "vec_id bigint, list int, placed binary, v binary", placing, 2048), "lists")
    groups = max(GROUPS, -(-rows // BLOCK))
    # Lists laid end to end and cut into equal groups: (list, first row) of at most LISTS lists.
    sizes = {r["list"]: r["count"] for r in listed.groupBy("list").count().collect()}
    # Any choice of lists holds k rows besides the query.
    index.probes = max(index.probes, min(len(sizes), 1 + int(np.searchsorted(np.cumsum(sorted(sizes.values())), k + 1))) + len(index.centres) - len(sizes))
    per, at, spread = max(1, -(-rows // groups)), 0, []
    for name in sorted(sizes):
        spread.append((name, at // per, (at + sizes[name] - 1) // per))
        at += sizes[name]
    span = {name: (a, b) for name, a, b in spread}
    table = spark.createDataFrame(spread, "list int, first int, last int")
    salt = F.pmod(F.xxhash64("vec_id"), F.col("last") - F.col("first") + 1).cast("int")
    candidates = listed.join(F.broadcast(table), "list").select((F.col("first") + salt).alias("part"), F.lit(0).alias("kind"), "vec_id", "list", "placed", "v", F.lit(0.0).alias("radius"))

    probing = spark.sparkContext.broadcast(vars(index))

    def asking():
        at = rebuilt(probing.value)

        def work(columns):
            q = _matrix(columns[1])
            turned = at.turn(q)
            probed, radius = at.probed(turned), at.radius(turned, q, k)
            out = [[], [], [], [], [], [], []]
            for i in range(len(q)):
                parts = sorted({p for name in np.flatnonzero(probed[i]) if name in span for p in range(span[name][0], span[name][1] + 1)})
                packed = turned[i].tobytes() + probed[i].tobytes()
                for c, value in zip(out, (parts, [1] * len(parts), [columns[0][i]] * len(parts), [-1] * len(parts), [packed] * len(parts),
                                          [q[i].astype(number).tobytes()] * len(parts), [float(radius[i])] * len(parts))):
                    c += value
            return out

        return work

    asked = kit.map_rows(fitting(queries), "part int, kind int, vec_id bigint, list int, placed binary, v binary, radius double", asking, 256)
    met = candidates.unionByName(asked).repartition(groups, "part").sortWithinPartitions("part", "kind")
    width, longest = d + 1, index.longest

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, block, waiting = None, None, []

        def gathered():
            ids = np.concatenate([b[0] for b in waiting])
            return ids, np.concatenate([b[1] for b in waiting]), *[
                np.frombuffer(b"".join(x for b in waiting for x in b[c]), t).reshape(len(ids), -1) for c, t in ((2, np.float32), (3, number))]

        for batch in batches:
            parts, kinds = batch.column("part").to_numpy(), batch.column("kind").to_numpy()
            cuts = np.flatnonzero((np.diff(parts) != 0) | (np.diff(kinds) != 0)) + 1
            for a, b in zip([0, *cuts], [*cuts, len(parts)]):
                piece = batch.slice(a, b - a)
                if parts[a] != part:
                    part, block, waiting = parts[a], None, []
                ids, packed, raw = piece.column("vec_id").to_numpy(), piece.column("placed").to_pylist(), piece.column("v").to_pylist()
                if kinds[a] == 0:
                    waiting.append((ids, piece.column("list").to_numpy(), packed, raw))
                    continue
                if block is None and waiting:
                    block, waiting = gathered(), []
                if block is None:
                    continue
                names, lists, placed, vectors_ = block
                radius = piece.column("radius").to_numpy()
                out: list[tuple] = []
                for s in range(0, len(ids), QUERIES):
                    few = range(s, min(len(ids), s + QUERIES))
                    turned = np.array([np.frombuffer(packed[i], np.float32, width) for i in few])
                    probed = np.array([np.frombuffer(packed[i], np.uint8, offset=4 * width) for i in few])
                    for i, found in zip(few, scan(turned, probed, radius[list(few)], placed, lists, longest, k + 1)):
                        found = found[names[found] != ids[i]]
                        exact = (vectors_[found].astype(np.float64) * np.frombuffer(raw[i], number).astype(np.float64)).sum(axis=1)  # equal rows, equal sums
                        best = np.lexsort((names[found], -exact))[:k]
                        out += [(int(ids[i]), int(names[found[j]]), float(exact[j])) for j in best]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.float64()))], names=["query_id", "vec_id", "score"])

    found = met.mapInArrow(search, "query_id bigint, vec_id bigint, score double")
    order = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", order).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
