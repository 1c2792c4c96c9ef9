"""Product codes of vectors, fitted in whole numbers by Lloyd rounds over resident members.

Vectors are cut into equal consecutive parts. The members of a codebook's entry live with its owners: a partition of blocks by
(position, entry, salt), where the salt is a run of rows, so that an owner has a bounded number of members however many an entry has. In each round the owners add up
their resident members, the sums of all owners (a row per position and entry) make the new codebooks, and each owner assigns its
members anew. Those that keep their entry stay where they are; only those that change it migrate, in that round's one shuffle. The
union of both has the partitioning of the residents, so the residents themselves are never shuffled again.

Rows take no part if the vector is null, is empty, holds a null or non-finite component, or has another length than that of the
smallest kept vec_id or one that the number of parts does not divide. Null ids count as the largest. Equal ids are ordered by their
vectors; each repeated row is a row of its own. With fewer rows than entries each row seeds one. A table without such rows gives an
empty table. Numbers too large for 64 bits are added up exactly; an error that does not fit into a long is null.
"""

from __future__ import annotations

import hashlib
import math
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farol.functions.storage import written

#: Most members of an owner, whose salt is a run of so many rows; members of a partition that are aimed at.
OWNER, PARTITION = 4096, 1 << 18
#: Largest number whose squared differences add up in 64 bits for parts of up to 32 components.
SMALL = 1 << 27


def whole_numbers(values: list[float], scale: int) -> list[int]:
    """floor(scale * x) of every component, exactly, also where the product leaves the range of doubles."""
    return [math.floor(x * scale) if abs(x) < 1e290 else int(x) * scale for x in values]


def packed(values: np.ndarray) -> np.ndarray:
    """Machine numbers where squared differences add up in 64 bits, else Python's own."""
    return values.astype(np.int32) if values.size and abs(values).max() < SMALL and values.shape[-1] <= 32 else values.astype(object)


def nearest(parts: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(entry, squared distance) of every part: the smallest distance, ties to the lower entry."""
    kind = np.int64 if parts.dtype == book.dtype == np.int32 else object
    parts, book = parts.astype(kind), book.astype(kind)
    entry = np.zeros(len(parts), np.int64)
    best = ((parts - book[0]) ** 2).sum(axis=1)
    for e in range(1, len(book)):
        off = ((parts - book[e]) ** 2).sum(axis=1)
        closer = off < best
        entry[closer], best[closer] = e, off[closer]
    return entry, best


def _owner_number(key: tuple[int, int, int]) -> int:
    """A number per (position, entry, salt) that is the same in every process."""
    position, entry, salt = key
    x = (salt * 0x9E3779B97F4A7C15 + position * 0xBF58476D1CE4E5B9 + entry * 0x94D049BB133111EB + 1) & 0xFFFFFFFFFFFFFFFF
    x ^= x >> 31
    x = x * 0xD6E8FEB86659FD93 & 0xFFFFFFFFFFFFFFFF
    return x >> 33


Member = tuple[tuple[int, int, int], tuple[np.ndarray, np.ndarray]]


def _split(position: int, salt: int, rows: np.ndarray, parts: np.ndarray, entry: np.ndarray) -> Iterator[Member]:
    """A block per entry."""
    order = np.argsort(entry, kind="stable")
    cuts = np.flatnonzero(np.diff(entry[order])) + 1
    for own in np.split(order, cuts):
        if len(own):
            yield (position, int(entry[own[0]]), salt), (rows[own], parts[own])


def _merged(blocks: Iterator[Member]) -> Iterator[Member]:
    """One block per owner of a partition."""
    held: dict[tuple, list] = {}
    for key, block in blocks:
        held.setdefault(key, []).append(block)
    for key, several in held.items():
        parts = [p for _, p in several]
        kind = object if any(p.dtype == object for p in parts) else np.int32
        yield key, (np.concatenate([r for r, _ in several]), np.concatenate([p.astype(kind, copy=False) for p in parts]))


def usable(rows: DataFrame, parts: int) -> tuple[DataFrame, int]:
    """Rows (uid, vec_id, label, v) that take part, written, and the length of their vectors (0 if there are none)."""
    v = F.col("v")
    fine = F.expr("forall(v, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity'))")
    whole = rows.where(v.isNotNull() & (F.size(v) > 0) & fine & (F.size(v) % parts == 0))
    kept = written(whole.withColumn("uid", F.monotonically_increasing_id()), "vectors")
    first = kept.orderBy(F.col("vec_id").asc_nulls_last(), "v").select(F.size("v")).first()
    width = first[0] if first else 0
    return kept.where(F.size("v") == width), width


def seeds(kept: DataFrame, parts: int, entries: int, scale: int) -> list[np.ndarray]:
    """The starting codebook of every position, from the rows with the smallest ids (at most `entries` rows reach the driver)."""
    rows = [whole_numbers(r[0], scale) for r in kept.orderBy(F.col("vec_id").asc_nulls_last(), "v").select("v").limit(entries).collect()]
    table = np.array(rows, object)
    return [packed(p) for p in np.split(table, parts, axis=1)]


def _first_members(kept: DataFrame, books: list[np.ndarray], scale: int) -> RDD:
    """Blocks of the first assignment, not yet with their owners. Arrow brings a batch of rows, which leaves as a few binary blocks."""
    parts = len(books)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            uid, lists = batch.column(0).to_numpy(), batch.column(1)
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(uid), -1)
            if abs(flat).max(initial=0) * scale < SMALL:
                table = np.floor(flat * scale).astype(np.int64)
            else:
                table = np.array([whole_numbers(r, scale) for r in flat.tolist()], object)
            out, salt = [], uid // OWNER
            for p, own in enumerate(np.split(table, parts, axis=1)):
                own = packed(own)
                entry, _ = nearest(own, books[p])
                for s in np.unique(salt):
                    mine = salt == s
                    out += [pickle.dumps(b, pickle.HIGHEST_PROTOCOL) for b in _split(p, int(s), uid[mine], own[mine], entry[mine])]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["block"])

    return kept.select("uid", F.col("v")).mapInArrow(cut, "block binary").rdd.map(lambda r: pickle.loads(bytes(r[0])))


def _sums(residents: RDD, books: list[np.ndarray]) -> list[np.ndarray]:
    """New codebooks from the owners' sums. An entry without members stays; a row per position and entry reaches the driver."""

    def own(blocks: Iterator[Member]) -> Iterator[tuple]:
        for (position, entry, _), (rows, parts) in blocks:
            yield (position, entry), ([int(x) for x in parts.astype(np.int64 if parts.dtype == np.int32 else object).sum(axis=0)], len(rows))

    added = residents.mapPartitions(own).reduceByKey(lambda a, b: ([x + y for x, y in zip(a[0], b[0])], a[1] + b[1])).collect()
    new = [book.astype(object) for book in books]
    for (position, entry), (total, count) in added:
        new[position][entry] = [x // count for x in total]
    return [packed(book) for book in new]


def _moved(residents: RDD, books: list[np.ndarray], partitions: int) -> RDD:
    """The members under new codebooks: those that keep their entry stay in place, the others go to their new owners."""

    def stayers(blocks: Iterator[Member]) -> Iterator[Member]:
        for (position, entry, salt), (rows, parts) in blocks:
            stay = nearest(parts, books[position])[0] == entry
            if stay.any():
                yield (position, entry, salt), (rows[stay], parts[stay])

    def movers(blocks: Iterator[Member]) -> Iterator[Member]:
        for (position, entry, salt), (rows, parts) in blocks:
            now, _ = nearest(parts, books[position])
            go = now != entry
            if go.any():
                yield from _split(position, salt, rows[go], parts[go], now[go])

    arriving = residents.mapPartitions(movers).partitionBy(partitions, _owner_number)
    return residents.mapPartitions(stayers, preservesPartitioning=True).union(arriving).mapPartitions(_merged, preservesPartitioning=True)


def fit(kept: DataFrame, books: list[np.ndarray], rounds: int, scale: int) -> tuple[RDD, list[np.ndarray]]:
    """Members with their owners after the last assignment, and the final codebooks."""
    spark = kept.sparkSession
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-kept.count() * len(books) // PARTITION))
    residents = _first_members(kept, books, scale).partitionBy(partitions, _owner_number).mapPartitions(_merged, preservesPartitioning=True)
    residents.persist(StorageLevel.MEMORY_AND_DISK)
    for _ in range(rounds):
        books = _sums(residents, books)
        before, residents = residents, _moved(residents, books, residents.getNumPartitions())
        residents.persist(StorageLevel.MEMORY_AND_DISK).count()
        before.unpersist()
    return residents, books


def digest(books: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(int(x)) for book in books for entry in book for x in entry).encode()).hexdigest()


def product_codes(vectors: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> DataFrame:
    """(vec_id, embedding, label) -> (vec_id, code, error, label_error, codebooks_sha256) for every row that takes part.

    `code` has two hex digits per part. `error` is the sum of the final squared distances, `label_error` its sum over equal labels,
    nulls together. The codebooks hold parts * entries rows, whatever the table's size.
    """
    kept, width = usable(vectors.select("vec_id", "label", F.col("embedding").alias("v")), parts)
    identity = {f.name: f.dataType.simpleString() for f in vectors.schema.fields}
    if not width:
        return vectors.sparkSession.createDataFrame(
            [], f"vec_id {identity['vec_id']}, code string, error bigint, label_error bigint, codebooks_sha256 string")
    residents, books = fit(kept, seeds(kept, parts, entries, scale), rounds, scale)

    def coded(blocks: Iterator[Member]) -> Iterator[tuple]:
        for (position, entry, _), (uid, own) in blocks:
            off = nearest(own, books[position])[1]
            yield bytearray(uid.astype(np.int64).tobytes()), position, entry, [str(x) for x in off.tolist()]

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uid, position, entry, off in zip(*(c.to_pylist() for c in batch.columns)):
                ids = np.frombuffer(uid, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array([position] * len(ids), pa.int32()), pa.array([entry] * len(ids), pa.int32()),
                                                  pa.array(off, pa.string())], names=["uid", "position", "entry", "off"])

    blocks = vectors.sparkSession.createDataFrame(residents.mapPartitions(coded), "uid binary, position int, entry int, off array<string>", verifySchema=False)
    each = written(blocks.mapInArrow(rows_of, "uid bigint, position int, entry int, off string"), "vector-codes")
    residents.unpersist()
    total: Column = F.sum(F.col("off").cast("decimal(38,0)"))
    code = F.concat_ws("", F.transform(F.array_sort(F.collect_list(F.struct("position", "entry"))), lambda s: F.lower(F.lpad(F.hex(s["entry"]), 2, "0"))))
    codes = each.groupBy("uid").agg(code.alias("code"), total.alias("exact"))
    full = written(kept.select("uid", "vec_id", "label").join(codes, "uid"), "coded-vectors")
    by_label = full.groupBy(F.col("label").alias("l")).agg(F.sum("exact").alias("sum"))
    return full.join(by_label, F.col("label").eqNullSafe(F.col("l"))).select(
        "vec_id", "code", F.col("exact").try_cast("bigint").alias("error"), F.col("sum").try_cast("bigint").alias("label_error"),
        F.lit(digest(books)).alias("codebooks_sha256"))
