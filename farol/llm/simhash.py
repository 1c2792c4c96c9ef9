"""SimHash near-duplicates by covering locality-sensitive hashing.

Every bit position carries a non-zero vector over GF(2) of `radius` + 1 bits. A mask v keeps the positions whose vector has
an odd product with v. Two fingerprints that differ in at most `radius` positions differ in vectors that span at most
`radius` dimensions, so some v is orthogonal to all of them: under that mask the two are equal. The 2**(radius+1) - 1 masks
therefore miss no pair within the radius.

Nulls count as empty texts; an empty text has fingerprint zero and is linked like any other. Copies collapse to one
fingerprint before any bucket is made, and a bucket returns a spanning forest of its links, never its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farol.functions.storage import written
from farol.llm import kit

#: Fingerprints of one bucket that a task compares among themselves; larger buckets are taken apart first.
BUCKET = 4096
_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def shingle_hashes(text: str | None, words: int) -> np.ndarray:
    """XXH64 with seed 42 of every run of `words` words, repeats included; A-Z lower-cased, words parted by ASCII white space."""
    w = (text or "").encode("utf-8", "replace").lower().split()
    if not w:
        return np.empty(0, np.uint64)
    runs = map(b" ".join, zip(*(w[i:] for i in range(words)))) if len(w) >= words else [b" ".join(w)]
    return np.fromiter(map(partial(xxhash.xxh64_intdigest, seed=42), runs), np.uint64)


def _majority(h: np.ndarray) -> int:
    """Bits that are set in more than half of the hashes."""
    octets, bits = h.view(np.uint8).reshape(-1, 8), 0
    for k in range(8):
        counts = np.bincount(octets[:, k], minlength=256) @ _BITS
        for j in np.flatnonzero(counts * 2 > len(h)):
            bits |= 1 << int(8 * k + j)
    return bits


def fingerprints_of(text: str | None, words: int, views: int) -> list[int]:
    """One fingerprint per view as signed 64-bit numbers; the first view takes the shingles' hashes as they are."""
    return _views(shingle_hashes(text, words), views)


def _views(h: np.ndarray, views: int) -> list[int]:
    out = []
    for view in range(views):
        if view:
            h = (h ^ (h >> np.uint64(29))) * (_SPREAD + np.uint64(2 * view))
            h ^= h >> np.uint64(32)
        bits = _majority(h) if len(h) else 0
        out.append(bits - (1 << 64) if bits >> 63 else bits)
    return out


def fingerprints(docs: DataFrame, words: int = 3, views: int = 1) -> DataFrame:
    """(doc_id, fp array<bigint>) for every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return kit.map_rows(docs.select("doc_id", "text"), f"doc_id {kind}, fp array<bigint>",
                        lambda: lambda c: [c[0], [fingerprints_of(t, words, views) for t in c[1]]])


def masks(radius: int, bits: int = 64) -> list[int]:
    """The covering masks as signed numbers."""
    top = (1 << (radius + 1)) - 1
    step = next(s for s in range(max(1, top // 3), top + 1) if np.gcd(s, top) == 1)
    vectors = [1 + (i * step) % top for i in range(bits)]
    out = [sum(1 << i for i, m in enumerate(vectors) if (m & v).bit_count() & 1) for v in range(1, top + 1)]
    return [m - (1 << bits) if m >> (bits - 1) else m for m in out]


def forest(nodes: np.ndarray, fps: np.ndarray, view: int, radius: int, total: int) -> list[tuple[int, int]]:
    """Links that connect what is near: each found set of neighbours hangs under the one that found it.

    Near means `radius` bits in one view and `total` bits in all of them; fps has a row per node, a column per view.
    """
    links, front, unseen = [], [0], np.arange(1, len(nodes))
    while len(unseen):
        if not front:
            front, unseen = [unseen[0]], unseen[1:]
        x = front.pop()
        off = np.bitwise_count((fps[unseen] ^ fps[x]).view(np.uint64))
        near = (off[:, view] <= radius) & (off.sum(axis=1) <= total)
        if near.any():
            found, unseen = unseen[near], unseen[~near]
            links += [(int(nodes[x]), int(nodes[y])) for y in found]
            front += list(found)
    return links


def _bucket_links(rows: DataFrame, radius: int, total: int, most: int) -> DataFrame:
    """(bucket, view, node, fp) -> (a, b, bucket). A task streams its buckets and holds one at a time; what exceeds `most` members
    is passed on as rows without a partner, for the bucket to be taken apart."""
    dealt = rows.select("bucket", "view", "node", "fp").repartition("bucket").sortWithinPartitions("bucket")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, view, held, nodes, fps = None, 0, 0, [], []
        out: tuple[list, list, list] = ([], [], [])

        def close():
            if held > 1:
                for a, b in forest(np.concatenate(nodes), np.concatenate(fps), view, radius, total):
                    for c, v in zip(out, (a, b, name)):
                        c.append(v)

        def ready():
            batch = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=["a", "b", "bucket"])
            for c in out:
                c.clear()
            return batch

        for batch in batches:
            b, v, n = (batch.column(i).to_numpy() for i in range(3))
            f = batch.column(3).flatten().to_numpy().reshape(len(b), -1)
            cuts = np.flatnonzero(np.diff(b)) + 1
            for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(b)]):
                if b[lo] != name:
                    close()
                    name, view, held, nodes, fps = int(b[lo]), int(v[lo]), 0, [], []
                fit = min(hi, lo + most - held)
                if fit > lo:
                    nodes.append(n[lo:fit])
                    fps.append(f[lo:fit])
                    held += fit - lo
                for k in range(max(lo, fit), hi):
                    for c, x in zip(out, (int(n[k]), None, name)):
                        c.append(x)
            if out[0]:
                yield ready()
        close()
        if out[0]:
            yield ready()

    return dealt.mapInArrow(run, "a bigint, b bigint, bucket bigint")


def _flips(fps: DataFrame) -> DataFrame:
    """Links within two bits of any number of fingerprints: both are one flip or less from a common value, and whatever shares such
    a value is within two bits. Each value keeps its smallest fingerprint, so 65 rows a fingerprint are all there is."""
    values = [F.col("node"), *[F.col("node").bitwiseXOR(F.lit((1 << i) if i < 63 else -(1 << 63))) for i in range(64)]]
    near = fps.select("node", F.explode(F.array(*values)).alias("value"))
    low = near.groupBy("value").agg(F.min("node").alias("a"), F.max("node").alias("z")).where("a <> z")
    return near.join(low, "value").where("node <> a").select("a", F.col("node").alias("b"))


def _block_pairs(members: DataFrame, radius: int, total: int, most: int) -> DataFrame:
    """Buckets beyond `most`, in general: members are dealt into blocks by hash and every two blocks of a bucket meet in one task."""
    sizes = members.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / F.lit(max(1, most // 4))).cast("int").alias("blocks"))
    dealt = members.join(sizes, "bucket").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    met = dealt.select("view", "node", "fp", F.explode(F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.xxhash64(
        "bucket", F.least("block", o), F.greatest("block", o)))).alias("bucket"))
    return _bucket_links(met, radius, total, 1 << 31)


def links(nodes: DataFrame, radius: int, views: int = 1, total: int = 64, most: int | None = None) -> DataFrame:
    """(node, fp array) distinct -> (a, b): links that connect all that is connected by pairs within the radius in some view.

    With one view and a radius up to 2 the node has to be the fingerprint itself.
    """
    tables = [F.struct(F.lit(v).alias("view"), F.xxhash64(F.lit(v), F.lit(t), F.col("fp")[v].bitwiseAND(F.lit(m))).alias("bucket"))
              for v in range(views) for t, m in enumerate(masks(radius))]
    return _linked(nodes, tables, radius, total, most or BUCKET, views == 1 and radius <= 2)


def _linked(nodes: DataFrame, tables: list, radius: int, total: int, most: int, flips: bool) -> DataFrame:
    rows = nodes.select("node", "fp", F.explode(F.array(*tables)).alias("t")).select("t.bucket", "t.view", "node", "fp")
    found = written(_bucket_links(rows, radius, total, most), "bucket-links")
    out, crowded = found.where("b IS NOT NULL").select("a", "b"), found.where("b IS NULL").select("bucket").distinct()
    if not crowded.isEmpty():
        hot = rows.join(crowded, "bucket", "left_semi")
        out = out.unionByName(_flips(hot.select("node").distinct()) if flips else _block_pairs(hot, radius, total, most).select("a", "b"))
    return out.distinct()


def _rooted(each: DataFrame, radius: int, bucket: int | None) -> DataFrame:
    """(doc_id, fp) -> (fp, component_id) per distinct fingerprint."""
    first = written(each.groupBy("fp").agg(F.min("doc_id").alias("low")), "distinct-fingerprints")
    roots = kit.components(links(first.select(F.col("fp").alias("node"), F.array("fp").alias("fp")), radius, most=bucket))
    rooted = first.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    low = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    return rooted.join(low, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, words: int = 3, radius: int = 2, bucket: int | None = None) -> DataFrame:
    """(doc_id, fingerprint, component_id): component_id is the smallest doc_id reachable over links within the radius.

    A null doc_id gets a fingerprint and a component like any row but is never the smallest one; a component with null ids only
    has a null component_id. An empty table gives an empty table.
    """
    each = written(fingerprints(docs, words).select("doc_id", F.col("fp")[0].alias("fp")), "fingerprints")
    return each.join(_rooted(each, radius, bucket), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, words: int = 3, radius: int = 2, bucket: int | None = None) -> DataFrame:
    """The documents without near-duplicates: of each component of `near_duplicates` the row with the smallest doc_id stays.

    A null doc_id comes after all others; of rows with the same id the one whose text has the smallest sha256 stays, of repeated rows one.
    """
    name = F.coalesce(F.concat(F.lit("="), F.col("doc_id").cast("string")), F.lit("-"))
    key = F.concat(F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")), 256), name)
    kind = docs.schema["doc_id"].dataType.simpleString()
    made = kit.map_rows(docs.select("doc_id", "text", key.alias("key")), f"doc_id {kind}, fp bigint, key string",
                        lambda: lambda c: [c[0], [fingerprints_of(t, words, 1)[0] for t in c[1]], c[2]])
    each = written(made, "fingerprints")
    first = each.join(_rooted(each, radius, bucket), "fp").groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "key")).alias("m"))
    stay = first.select(F.col("m.key").alias("__key"))
    kept = docs.withColumn("__key", key).join(stay, "__key", "left_semi")
    return kept.dropDuplicates(["__key"]).select(*[F.col(f"`{c}`") for c in docs.columns])
