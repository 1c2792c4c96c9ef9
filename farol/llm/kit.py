"""Small helpers that the operators share: Arrow batches in and out, hashed character n-grams, connected components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

from farol.functions.storage import written

Rows = Callable[[list[list]], list[list]]


def arrow_schema(schema: str) -> pa.Schema:
    """The Arrow form of a schema text."""
    parsed = _parse_datatype_string(schema)
    assert isinstance(parsed, StructType)
    return to_arrow_schema(parsed)


def map_rows(df: DataFrame, schema: str, make: Callable[[], Rows], rows: int = 512) -> DataFrame:
    """Columns of Python values in, columns out, at most `rows` rows at a time.

    `make()` runs once per task and returns the function, so tables and caches live as long as the task.
    """
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                columns = [c.to_pylist() for c in batch.slice(start, rows).columns]
                out = work(columns)
                if len(out[0]):
                    yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(out, arrow)], schema=arrow)

    return df.mapInArrow(run, schema)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)


def gram_buckets(codes: np.ndarray, n: int, bits: int) -> np.ndarray:
    """A bucket in [0, 2**bits) for each run of n code points, in the order of the text."""
    if len(codes) < n:
        return np.empty(0, np.uint32)
    h = codes[:len(codes) - n + 1] + np.uint32(n * 0x51ED)
    for i in range(1, n):
        h = h * np.uint32(0x9E3779B1) + codes[i:len(codes) - n + 1 + i]
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x85EBCA6B)
    return h >> np.uint32(32 - bits)


def crc_mod(column: str, k: int):
    """crc32 of the id as text, modulo k; a null id gives 0 of an empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")), F.lit(k))


def sample_by_id(df: DataFrame, id_column: str, most: int) -> DataFrame:
    """About `most` rows at most, chosen by a hash of the id; all rows if there are fewer. For fitting a classifier only."""
    n = df.count()
    if n <= most:
        return df
    return df.where(F.pmod(F.xxhash64(F.lit("sample"), F.col(id_column)), F.lit(1 << 30)) < int((1 << 30) * most / n))


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(a, b) links -> (node, root): root is the smallest node that can be reached. Nodes without a link are not returned.

    Alternating stars: each round hangs the larger neighbours of every node under the smallest one, then the smaller ones.
    Only minima are gathered per node, with partial sums, and each round is written to the shared folder.
    """
    edges = written(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "links")
    state = None
    for _ in range(rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = written(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "links")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == now:
            return edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        state = now
    raise RuntimeError("the links did not settle")
