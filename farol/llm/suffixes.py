"""Removal of repeated byte strings by difference-cover suffix sorting.

A string of `window` bytes that starts at two places, in one text or two, is repeated; every byte under a repeated string goes.

1. Narrowing, exact. Among the hashes of the GRAM-byte strings inside a window the smallest, leftmost, is its anchor. Equal
   windows have equal anchors, so only windows whose anchor occurs twice can repeat. The windows of one anchor at one place
   are a run of starts, a zone; equal zones are counted, not copied. Anchors that occur once end here.
2. Suffix sorting of the distinct zones that share an anchor, each with an end mark of its own: the suffixes at two of three
   places are sorted by triples, triples become names, the names' string is sorted by recursion, the remaining suffixes are
   merged in, and neighbours in the order are compared over `window` bytes. Spark deals the zones by anchor.
3. Repeated starts go back to all places of their zone, and each text loses the bytes they cover.

An anchor with more than CROWD distinct zones would be too much for one task: its windows are counted one by one by two
64-bit hashes, with partial sums, instead. A null text is an empty text. Copies of a text share one result. Nothing depends on doc_id but the
choice of the copy that is read, so null and repeated ids, and tables with a single row or none, give what the rule says.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farol.functions.storage import written

#: Bytes of an anchor, most distinct zones of an anchor that one task sorts, bytes sorted in one go.
GRAM, CROWD, TOGETHER = 48, 32768, 1 << 18
#: Bytes of a text that are hashed at a time, and the base of the polynomial hash.
SLICE, BASE = 1 << 19, 0x9E3779B97F4A7C15
_POWER = np.cumprod(np.full(SLICE + 4096, BASE, np.uint64), dtype=np.uint64)
_INVERSE = np.cumprod(np.full(SLICE + 4096, pow(BASE, -1, 1 << 64), np.uint64), dtype=np.uint64)


def text_key(sha: Column) -> Column:
    """60 bits of a text's sha256."""
    return F.conv(F.substring(sha, 1, 15), 16, 10).cast("bigint")


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def _sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every run of w values: prefix and suffix minima of blocks of w."""
    n = len(x)
    blocks = np.full(-(-n // w) * w, np.iinfo(np.uint64).max, np.uint64)
    blocks[:n] = x
    blocks = blocks.reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()[w - 1:n]
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()[:n - w + 1]
    return np.minimum(ahead, back)


def zones(data: bytes, window: int) -> tuple[np.ndarray, ...]:
    """(anchor, zone, first start, starts) of each zone; anchor and zone are hashes of their bytes."""
    parts, gram = [], min(GRAM, window)
    grams = window - gram + 1
    for begin in range(0, max(0, len(data) - window + 1), SLICE):
        piece = np.frombuffer(data, np.uint8, min(SLICE + window - 1, len(data) - begin), begin).astype(np.uint64) + np.uint64(1)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(piece * _POWER[:len(piece)], dtype=np.uint64)])
        hashes = _mixed((sums[gram:] - sums[:-gram]) * _INVERSE[:len(sums) - gram])
        low = np.uint64((1 << 20) - 1)
        owner = (_sliding_min((hashes & ~low) | np.arange(len(hashes), dtype=np.uint64), grams) & low).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        n = np.diff(np.append(first, len(owner)))
        end = first + n + window - 1
        whole = _mixed((sums[end] - sums[first]) * _INVERSE[first] + (n.astype(np.uint64) << np.uint64(32)) + (owner[first] - first).astype(np.uint64))
        parts.append((hashes[owner[first]].view(np.int64), whole.view(np.int64), first + begin, n))
    return tuple(np.concatenate(x) for x in zip(*parts)) if parts else tuple(np.empty(0, np.int64) for _ in range(4))


def zone_rows(docs: DataFrame, window: int) -> DataFrame:
    """(anchor, zone, tid, at, n) of every zone of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                columns = batch.slice(start, 256)
                out = []
                for tid, text in zip(columns.column(0).to_pylist(), columns.column(1).to_pylist()):
                    z = zones((text or "").encode("utf-8", "replace"), window)
                    out.append((z[0], z[1], np.full(len(z[0]), tid, np.int64), z[2], z[3].astype(np.int32)))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out)], names=["anchor", "zone", "tid", "at", "n"])

    return docs.select("tid", "text").mapInArrow(run, "anchor bigint, zone bigint, tid bigint, at bigint, n int")


def _triples(a: np.ndarray, b: np.ndarray, c: np.ndarray, most: int) -> np.ndarray:
    """Keys that sort like the triples; numbers that are too large for one word are first replaced by the rank of their pair."""
    if most < 1 << 21:
        return (a << 42) | (b << 21) | c
    _, pair = np.unique((a << 31) | b, return_inverse=True)
    return (pair << 31) | c


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Places of the suffixes of s (positive numbers below 2**31) in order, by a difference cover modulo 3."""
    n = len(s)
    if n < 3:
        return np.array(sorted(range(n), key=lambda i: s[i:].tolist()), np.int64)
    t = np.concatenate([s.astype(np.int64), np.zeros(3, np.int64)])
    places = np.arange(n + (n % 3 == 1))
    ones, twos, zeros = places[places % 3 == 1], places[places % 3 == 2], np.arange(0, n, 3)
    sample = np.concatenate([ones, twos])
    # Sort the sampled triples and name them.
    keys = _triples(t[sample], t[sample + 1], t[sample + 2], int(t.max()) + 1)
    order = np.argsort(keys, kind="stable")
    names = np.empty(len(sample), np.int64)
    names[order] = np.cumsum(np.concatenate([[1], keys[order][1:] != keys[order][:-1]]))
    # Recurse on the names unless they tell all sampled suffixes apart.
    if names.max() < len(sample):
        order = suffix_array(names)
    rank = np.zeros(n + 3, np.int64)
    rank[sample[order]] = np.arange(1, len(sample) + 1)
    # The remaining suffixes by their first number and the rank of what follows.
    rest = zeros[np.argsort((t[zeros] << 31) | rank[zeros + 1], kind="stable")]
    # Merge: a remaining suffix comes after as many sampled ones as are smaller, of each of the two kinds.
    ordered = sample[order]
    one, two = ordered[ordered % 3 == 1], ordered[ordered % 3 == 2]
    before = np.searchsorted((t[one] << 31) | rank[one + 1], (t[rest] << 31) | rank[rest + 1])
    both = np.concatenate([two, rest])
    keys = _triples(t[both], t[both + 1], rank[both + 2], max(int(t.max()), len(sample)) + 1)
    before = before + np.searchsorted(keys[:len(two)], keys[len(two):])
    skipped = int(n % 3 == 1)  # the place past the end is sampled too, and comes first
    out = np.empty(n, np.int64)
    at = np.arange(len(rest)) + before - skipped
    free = np.ones(n, bool)
    free[at] = False
    out[at], out[free] = rest, ordered[skipped:]
    return out


def repeated_starts(texts: list[bytes], window: int) -> list[np.ndarray]:
    """For each text a flag per start: its `window` bytes start elsewhere too, in this text or another."""
    lengths = np.array([len(x) for x in texts])
    firsts = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]])
    joined = np.frombuffer(b"\0".join([*texts, b"\0" * 8]), np.uint8)
    s = joined[:int(lengths.sum()) + len(texts)].astype(np.int64) + 1
    s[firsts + lengths] = 257 + np.arange(len(texts))
    order = suffix_array(s)
    valid = np.zeros(len(s), bool)
    for first, length in zip(firsts, lengths):
        valid[first:first + max(0, length - window + 1)] = True
    order = order[valid[order]]
    # Compare neighbours eight bytes at a time, pairs that differ drop out.
    words = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(joined, 8)).view(np.uint64).ravel()
    pair = np.arange(len(order) - 1)
    for offset in [*range(0, window - 7, 8), *([window - 8] if window % 8 and window >= 8 else [])]:
        pair = pair[words[order[pair] + offset] == words[order[pair + 1] + offset]]
    if window < 8:
        for offset in range(window):
            pair = pair[s[order[pair] + offset] == s[order[pair + 1] + offset]]
    hit = np.zeros(len(s), bool)
    hit[order[pair]] = hit[order[pair + 1]] = True
    return [hit[first:first + max(0, length - window + 1)] for first, length in zip(firsts, lengths)]


def _runs(flags: np.ndarray) -> list[tuple[int, int]]:
    edge = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return list(zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()))


def _sorted_zones(rows: DataFrame, window: int, parts: int) -> DataFrame:
    """(anchor, zone, bytes) -> (anchor, zone, lo, hi): repeated starts of a zone. Zones of an anchor meet in one task, a few anchors are sorted at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[tuple] = []
        size = 0

        def sort() -> Iterator[pa.RecordBatch]:
            found = [(a, z, lo, hi) for (a, z, _), flags in zip(group, repeated_starts([b for *_, b in group], window)) for lo, hi in _runs(flags)]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], names=["anchor", "zone", "lo", "hi"])

        for batch in batches:
            for anchor, zone, data in zip(*(c.to_pylist() for c in batch.columns)):
                if group and size >= TOGETHER and anchor != group[-1][0]:
                    yield from sort()
                    group, size = [], 0
                group.append((anchor, zone, data))
                size += len(data)
        if group:
            yield from sort()

    dealt = rows.select("anchor", "zone", "bytes").repartition(parts, "anchor").sortWithinPartitions("anchor")
    return dealt.mapInArrow(run, "anchor bigint, zone bigint, lo bigint, hi bigint")


def _counted_windows(rows: DataFrame, window: int) -> DataFrame:
    """The same for crowded anchors: windows one by one, counted by two hashes."""
    starts = F.sequence(F.lit(0).cast("bigint"), F.octet_length("bytes").cast("bigint") - window)
    each = rows.select("anchor", "zone", "bytes", F.explode(starts).alias("lo"))
    piece = F.substring(F.col("bytes"), F.col("lo").cast("int") + 1, F.lit(window))
    each = each.select("anchor", "zone", "lo", F.xxhash64(piece).alias("h"), F.xxhash64(F.lit(1), piece).alias("g"))
    twice = each.groupBy("h", "g").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("h", "g")
    return each.join(twice, ["h", "g"]).select("anchor", "zone", "lo", (F.col("lo") + 1).alias("hi"))


def keyed(docs: DataFrame) -> DataFrame:
    """Adds sha256 and tid; a null text becomes empty."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.withColumn("text", text).withColumn("sha256", F.sha2(text, 256)).withColumn("tid", text_key(F.col("sha256")))


def repeats(rows: DataFrame, window: int = 200, crowd: int | None = None) -> DataFrame:
    """(tid, doc_id, text) of `keyed` -> (tid, spans): starts of repeated windows as array<struct<lo, hi>> per distinct text that has any."""
    spark = rows.sparkSession
    crowd = crowd or CROWD
    every = written(zone_rows(rows, window), "zones")
    shared = every.groupBy("anchor").agg(F.count(F.lit(1)).alias("c"), F.min("zone").alias("z"), F.max("zone").alias("y")).where("c > 1")
    # Both written, as a join whose sides come straight from a shuffle can be split at a common anchor; an aggregate between would forbid it.
    anchors = written(shared.select("anchor", (F.col("z") == F.col("y")).alias("alike")), "anchors")
    # Places of candidate zones, once per distinct text.
    candidates = written(every.join(anchors, "anchor"), "candidates")
    places = written(candidates.groupBy("anchor", "zone", "tid", "at", "n", "alike").agg(F.count(F.lit(1)).alias("c")), "places")
    differing = written(places.where("NOT alike").groupBy("anchor", "zone").agg(
        F.sum("c").alias("c"), F.min(F.struct("tid", "at", "n")).alias("p")).select("anchor", "zone", "c", "p.*"), "distinct-zones")
    crowded = written(differing.groupBy("anchor").count().where(F.col("count") > crowd).select("anchor"), "crowded-anchors")
    # One copy of each text that holds the first place of a distinct zone.
    asked = differing.select("tid").distinct()
    copy = rows.select("tid", "doc_id").join(asked, "tid", "left_semi").groupBy("tid").agg(F.min("doc_id").alias("doc_id"))
    chosen = differing.join(copy, "tid")
    read = chosen.alias("z").join(rows.select("tid", "doc_id", "text").alias("d"), (F.col("z.tid") == F.col("d.tid")) & F.col("z.doc_id").eqNullSafe(F.col("d.doc_id")))
    cut = F.substring(F.col("d.text").cast("binary"), F.col("z.at").cast("int") + 1, F.col("z.n") + window - 1)
    bytes_of = written(read.select("z.anchor", "z.zone", cut.alias("bytes")).dropDuplicates(["anchor", "zone"]), "zone-bytes")
    size = bytes_of.agg(F.sum(F.octet_length("bytes"))).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(size >> 23))
    few = bytes_of.join(crowded, "anchor", "left_anti")
    found = _sorted_zones(few, window, parts)
    if not crowded.isEmpty():
        found = found.unionByName(_counted_windows(bytes_of.join(crowded, "anchor", "left_semi"), window))
    whole = differing.where("c > 1").select("anchor", "zone", F.lit(0).cast("bigint").alias("lo"), F.col("n").cast("bigint").alias("hi"))
    hits = written(found.unionByName(whole), "repeated-starts")
    back = places.where("NOT alike").select("anchor", "zone", "tid", "at").join(hits, ["anchor", "zone"]).select(
        "tid", (F.col("at") + F.col("lo")).alias("lo"), (F.col("at") + F.col("hi")).alias("hi"))
    alike = places.where("alike").select("tid", F.col("at").alias("lo"), (F.col("at") + F.col("n")).alias("hi"))
    return back.unionByName(alike).distinct().groupBy("tid").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))


def _without(data: bytes, spans: list[dict], window: int) -> tuple[int, int, bytes]:
    """(bytes removed, maximal runs, what is left)."""
    edge = np.zeros(len(data) + 1, np.int64)
    for s in spans:
        edge[s["lo"]] += 1
        edge[s["hi"] + window - 1] -= 1
    gone = np.cumsum(edge[:-1]) > 0
    return int(gone.sum()), len(_runs(gone)), np.frombuffer(data, np.uint8)[~gone].tobytes()


def cut_repeats(rows: DataFrame, window: int = 200, texts: bool = False, crowd: int | None = None) -> DataFrame:
    """(tid, n_removed, n_spans, kept_sha256[, kept]) per distinct text that loses bytes, from the rows of `keyed`.

    `kept` is the remaining text; where a cut goes through a character its other bytes are left out.
    """
    spans = written(repeats(rows, window, crowd), "spans")
    copy = rows.select("tid", "doc_id").join(spans.select("tid"), "tid", "left_semi").groupBy("tid").agg(F.min("doc_id").alias("doc_id"))
    wanted = spans.join(copy, "tid").alias("s")
    read = wanted.join(rows.select("tid", "doc_id", "text").alias("d"), (F.col("s.tid") == F.col("d.tid")) & F.col("s.doc_id").eqNullSafe(F.col("d.doc_id")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                out = []
                for tid, found, text in zip(*(c.to_pylist() for c in batch.slice(start, 64).columns)):
                    removed, runs, left = _without(text.encode("utf-8", "replace"), found, window)
                    out.append((tid, removed, runs, hashlib.sha256(left).hexdigest(), *([left.decode("utf-8", "ignore")] if texts else [])))
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

    names = ["tid", "n_removed", "n_spans", "kept_sha256", *(["kept"] if texts else [])]
    schema = "tid bigint, n_removed bigint, n_spans bigint, kept_sha256 string" + ", kept string" * texts
    return read.select("s.tid", "s.spans", "d.text").mapInArrow(run, schema).dropDuplicates(["tid"])


def dedup(docs: DataFrame, window: int = 200, crowd: int | None = None) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) for every row."""
    rows = keyed(docs.select("doc_id", "text"))
    cut = cut_repeats(rows, window, crowd=crowd)
    narrow = rows.select("doc_id", "tid", "sha256", F.octet_length("text").cast("bigint").alias("n_bytes"))
    zero = F.lit(0).cast("bigint")
    return narrow.join(cut, "tid", "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", zero).alias("n_removed"), F.coalesce("n_spans", zero).alias("n_spans"),
        F.coalesce("kept_sha256", "sha256").alias("kept_sha256"))


def without_repeats(docs: DataFrame, window: int = 200) -> DataFrame:
    """The documents with repeated strings cut out of `text`, all columns kept; a column n_chars counts the new text. Null texts stay null."""
    rows = keyed(docs.select("doc_id", "text"))
    cut = cut_repeats(rows, window, texts=True).select(F.col("tid").alias("__tid"), F.col("kept").alias("__kept"))
    sha = F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")), 256)
    joined = docs.withColumn("__tid", text_key(sha)).join(cut, "__tid", "left")
    new = {"text": F.coalesce("__kept", "text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col("__kept").isNotNull(), F.char_length("__kept")).otherwise(F.col("n_chars"))
    return joined.select(*[new[c].cast(docs.schema[c].dataType).alias(c) if c in new else F.col(f"`{c}`") for c in docs.columns])
